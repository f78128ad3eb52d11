"""Score lines of numbers as they arrive in a folder."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labelgap.fixed_values import MODEL_NUTRIENTS
from labelgap.functions.scoring import line_status, line_words, word_number
from labelgap.operators.detector import score_products
from labelgap.streaming.sink import committed_sink

Batch = Callable[[DataFrame, int], None]
#: Reasons for which a line is kept aside.
REJECTED = ["number_error", "count_error"]


def parse_lines(lines: DataFrame, line: str = "value", fields: Sequence[str] = MODEL_NUTRIENTS) -> DataFrame:
    """``status`` and a double per field for each line; the doubles are null unless ``ok``. Works on a batch and on a stream alike."""
    # Generated columns are computed once per row; plain ones would be split again for every output.
    split = lines.select("*", F.inline(F.array(F.struct(line_words(F.col(line)).alias("_words")))))
    judged = split.select("*", F.inline(F.array(F.struct(line_status(F.col(line), F.col("_words"), len(fields)).alias("status")))))
    numbers = {f: F.when(F.col("status") == "ok", word_number(F.col("_words"), i)) for i, f in enumerate(fields)}
    return judged.withColumns(numbers).drop("_words")


def score_line_stream(
    spark: SparkSession,
    input_folder: str,
    model: Model,
    scored_folder: str,
    rejected_folder: str,
    checkpoint: str,
    fields: Sequence[str] = MODEL_NUTRIENTS,
    available_now: bool = True,
    max_files_per_trigger: int = 1000,
    sink: Callable[[Batch], Batch] = lambda write: write,
) -> StreamingQuery:
    """Start the stream. Well-formed lines are scored, the others are kept with the reason.

    ``checkpoint`` names the folder, shared by all machines, that holds how far the stream came. Every line counts
    once, whatever ends the stream and however often it is started again; see ``committed_rows`` for reading.
    ``sink`` may wrap the function that takes each micro-batch.
    """
    good = F.col("status") == "ok"
    outputs = {
        scored_folder: lambda parsed: score_products(model, parsed.filter(good), fields, ["value"]),
        rejected_folder: lambda parsed: parsed.filter(F.col("status").isin(REJECTED)).select("value", "status"),
    }
    write = sink(committed_sink(lambda batch: parse_lines(batch, "value", fields), outputs, checkpoint))
    lines = spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(input_folder)
    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
