"""Synthetic against original rows: distributions, correlations, discriminators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from labelgap.fixed_values import KEY_PAIRS, MODEL_NUTRIENTS
from labelgap.operators import correlation, detector, drift
from labelgap.operators.sampling import ROW_ID, with_row_id
from labelgap.plans.config import Config
from labelgap.session import written


def validate(
    original: DataFrame, synthetic: DataFrame, columns: Sequence[str] = MODEL_NUTRIENTS, config: Config | None = None,
    pairs: Sequence[tuple[str, str]] = KEY_PAIRS,
) -> dict[str, DataFrame]:
    """All three validations by name, in order; one that fails ends the chain.

    Each table is read once: its rows are numbered and written, only with the columns compared, and all three start from there. One aggregate
    gives both correlation matrices, and one table of distinct values all statistics. ``skipped``
    names the variables that nothing here covers, and why.
    """
    config = config or Config()
    present = [c for c in columns if c in original.columns and c in synthetic.columns]
    marked = drift.label_sides(original.select(*present), synthetic.select(*present))
    both = with_row_id(marked)
    counts = written(drift.value_counts(drift.side_values(both, present)), "counts")
    report = written(drift.report_of(counts), "report")  # a row per variable, which the summary reads again
    skipped = drift.skipped_variables(counts, columns, original.columns, synthetic.columns)
    # A variable without values on a side leaves no complete row there.
    empty = {row["variable"] for row in skipped.collect()}  # a row per variable
    usable = [c for c in present if c not in empty]
    matrix = written(correlation.correlation_differences(both, usable), "matrix")
    predictions, importance = detector.discriminator_predictions(both, usable, ROW_ID, n_trees=config.n_trees, seed=config.seed)
    results = {
        "statistics": report,
        "summary": drift.report_summary(report),
        "skipped": skipped,
        "correlations": matrix,
        "key_pairs": correlation.key_pairs_of(matrix, usable, pairs),
        **detector.discriminator_results(predictions),
        "importance": importance,
    }
    if config.output is not None:
        for name, table in results.items():
            table.write.mode("overwrite").csv(f"{config.output}/{name}", header=True, escape='"')
    return results
