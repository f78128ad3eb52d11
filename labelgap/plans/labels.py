"""Draft labels for candidates, parse them and report."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from labelgap.fixed_values import LABEL_JOIN_COLUMNS
from labelgap.operators import joins, label_content
from labelgap.operators.journal import complete_once
from labelgap.plans.config import Config, kept, stage


def draft_labels(
    gap: DataFrame,
    preprocessed: DataFrame,
    complete: Callable[[Sequence[str]], Sequence[str]] | None = None,
    k: int | None = 5,
    config: Config | None = None,
    journal: str | None = None,
) -> dict[str, DataFrame]:
    """Parsed labels, and what was lost on the way: failed completions and unreadable JSON.

    Without ``complete`` a label is a template filled from the columns. With ``journal``, a folder, no prompt is sent twice, over all runs.
    """
    config = config or Config()
    joined = joins.left_join(gap, preprocessed, "code", LABEL_JOIN_COLUMNS)
    candidates = label_content.label_candidates(joined, k=k)
    if complete is None:
        completed = label_content.template_labels(candidates, compat=config.compat)
    elif journal is None:
        completed = label_content.complete_labels(label_content.add_prompt(candidates, config.compat), complete)
    else:
        completed = complete_once(label_content.add_prompt(candidates, config.compat), journal, complete)
    # Completions may cost money or differ from call to call: they are written once and read from there.
    completed = kept(completed, config, "completions")
    labels, rejects = label_content.parse_labels(completed.filter("error is null"))
    return {
        "labels": stage(labels, config, "labels"),
        "failed": stage(completed.filter("error is not null").select("code", "error"), config, "failed"),
        "rejected": stage(rejects, config, "rejected"),
    }


def report_labels(labels: DataFrame, config: Config | None = None) -> dict[str, DataFrame]:
    """The flat table of all labels, the short report, and the label cards."""
    config = config or Config()
    flat = label_content.lists_as_text(label_content.flatten_json(labels))
    if config.output is not None:
        flat.write.mode("overwrite").csv(f"{config.output}/label_report", header=True, escape='"')
    cards = label_content.wrap_statement(label_content.label_card(labels))
    return {"flat": flat, "report": label_content.label_report(labels), "cards": cards}
