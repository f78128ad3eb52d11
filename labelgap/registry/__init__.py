"""Every query by name, with the SQL it must agree with."""

from labelgap.registry.catalog import ORACLES, QUERIES, load

__all__ = ["ORACLES", "QUERIES", "load"]
