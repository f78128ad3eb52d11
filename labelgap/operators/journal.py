"""Completions that are paid for once: a journal of answers, keyed by the digest of what was asked.

Prompts that the journal answers are not sent again, whichever product or run they come from. What a task received
lies in the journal as soon as that task has ended, even if its job fails later, so a run that is started again sends the rest only.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgap.operators.label_content import answered
from labelgap.session import folder_names, written

JOURNAL = "digest string, text string, error string, asked_at timestamp"
#: Prompts that one task sends before its answers are in the journal, and thus the most that a lost task sends again.
PROMPTS_PER_TASK = 200

# Each task's files are moved to the journal when the task commits, not when the job does, so they outlive a job that fails.
_BY_TASK = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """All entries of the journal; none if nothing was asked yet."""
    if all(name.startswith(("_", ".")) for name in folder_names(spark, path)):
        return spark.createDataFrame([], JOURNAL)
    return spark.read.schema(JOURNAL).parquet(path)


def answers(spark: SparkSession, path: str) -> DataFrame:
    """``digest, text, error``: a row per digest; an answer wins over an error, the least text over others, the last error over earlier ones.

    A task that was repeated may have left a digest twice.
    """
    best = read_journal(spark, path).groupBy("digest").agg(F.min("text").alias("text"), F.max_by("error", "asked_at").alias("error"))
    return best.withColumn("error", F.when(F.col("text").isNull(), F.col("error")))


def complete_once(
    df: DataFrame, path: str, complete: Callable[[Sequence[str]], Sequence[str]], key: str = "code", prompt: str = "prompt", model: str = "",
    per_task: int = PROMPTS_PER_TASK,
) -> DataFrame:
    """``(key, text, error)`` per row, like ``complete_labels``, but no prompt is sent that the journal at ``path`` answers.

    Equal prompts are one prompt. ``model`` names what answers: another model is asked anew. Prompts that failed are sent
    again by the next run; a null prompt is not sent and has an error. One run at a time may use a journal.
    """
    spark = df.sparkSession
    # Written, since forming a prompt costs more than reading it: digests, filter and joins would each form it anew.
    formed = written(df.select(F.col(key), F.col(prompt).alias("_prompt")), "asked")
    digest = F.when(F.col("_prompt").isNotNull(), F.sha2(F.concat(F.lit(f"{model}\n"), F.col("_prompt")), 256))
    asked = formed.withColumn("digest", digest)
    known = answers(spark, path).filter("text IS NOT NULL").select("digest")
    wanted = asked.filter("digest IS NOT NULL").groupBy("digest").agg(F.first("_prompt").alias("prompt"))
    rest = written(wanted.join(known, "digest", "left_anti"), "prompts")
    n_rest = rest.count()
    if n_rest:
        # Not by the digest: a task's share must have this many prompts at most, so rows are dealt in turn.
        dealt = rest.repartition(math.ceil(n_rest / per_task))
        given = answered(dealt, complete, "digest", "prompt").withColumn("asked_at", F.current_timestamp())
        given.write.mode("append").options(**_BY_TASK).parquet(path)
    found = answers(spark, path)
    joined = asked.join(found, "digest", "left")
    error = F.when(F.col("digest").isNull(), F.lit("no prompt")).otherwise(F.col("error"))
    return joined.select(key, "text", error.alias("error"))
