"""What a Python worker keeps between its tasks.

Task functions travel with the job, so a module's own variables are new in
every task. Loaded vocabularies and what was learnt about their pieces are
kept in a module that lives as long as the worker process.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

_STORE = "_labelgap_worker_store"


def kept(key: tuple, build: Callable):
    """The value under ``key`` in this process, built at the first call."""
    store = sys.modules.setdefault(_STORE, types.ModuleType(_STORE)).__dict__
    if key not in store:
        store[key] = build()
    return store[key]
