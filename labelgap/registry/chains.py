"""The composed jobs as wholes, over the given tables."""

from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap import plans
from labelgap.fixed_values import (
    ALLERGEN_PATTERNS,
    BROAD_MARKET_PATTERN,
    CASE_GAP,
    LABEL_PATTERNS,
    MODEL_NUTRIENTS,
    NUTRIENT_SOURCES,
    STRICT_MARKET_PATTERN,
)
from labelgap.operators import cleaning, detector, synthesis
from labelgap.registry.catalog import query
from labelgap.registry.drift import _MATRICES_SQL, _MOMENT_COLUMNS, _MOMENT_SELECT, _MOMENTS_SQL, _PSI_SQL, _STEPS_SQL
from labelgap.registry.features import _ALLERGEN_SQL, _LABEL_SQL, _TEXT_SQL, _TOP_SQL
from labelgap.registry.language import _CONFIG as GAP_CONFIG
from labelgap.registry.models import _LINES_SQL, score_lines
from labelgap.registry.preparation import MERGED_SQL, merged, nutrient_rows
from labelgap.registry.views import NUTRIENTS_SQL, PRODUCTS_SQL, SIDE_COLUMNS, SIDES_SQL, ingredients, products, sides
from labelgap.session import scratch_folder
from labelgap.streaming import committed_rows, score_line_stream
from labelgap.streaming.scoring import REJECTED, parse_lines

_NUTRIENTS = list(NUTRIENT_SOURCES)
_FLAGS = [*ALLERGEN_PATTERNS, *LABEL_PATTERNS]
_MEASURES = "stage string, name string, measure string, value double"


def measures(stage: str, rows: DataFrame, values: dict) -> DataFrame:
    """``stage, name, measure, value`` out of aggregates, one row each, rounded to six digits."""
    wide = rows.agg(*[F.round(value, 6).cast("double").alias(f"{name}|{measure}") for (name, measure), value in values.items()])
    cells = [F.struct(F.lit(stage).alias("stage"), F.lit(n).alias("name"), F.lit(m).alias("measure"), F.col(f"`{n}|{m}`").alias("value")) for n, m in values]
    return wide.select(F.inline(F.array(*cells)))


def row_counts(spark, done) -> DataFrame:
    return spark.createDataFrame([(name, "", "rows", float(stage.n_rows)) for name, stage in done.items()], _MEASURES)


def union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- preprocessing -------------------------------------------------------------


_RAW_SQL = PRODUCTS_SQL.replace("products AS (", "all_products AS (", 1) + f""",
products AS (SELECT * FROM all_products
  WHERE COALESCE(len(list_filter(countries_tags, lambda t: regexp_matches(lower(t), '{BROAD_MARKET_PATTERN}'))) > 0, false))"""

# The categorical table, split in the order of digests; many keys are the text of a missing one.
PREPROCESSED_SQL = f"""
{_RAW_SQL}, {NUTRIENTS_SQL}, {_TEXT_SQL}, {_TOP_SQL},
flagged AS (SELECT o_orderkey, category_top, {_ALLERGEN_SQL}, {_LABEL_SQL} FROM tops),
categorical AS (
  SELECT trim(COALESCE(code, 'None'), ' ' || chr(9)) AS code, {', '.join(_NUTRIENTS)}, category_top,
    COALESCE(nutriscore_grade, 'missing') AS nutriscore_grade, {', '.join(_FLAGS)}
  FROM nutrients JOIN flagged USING (o_orderkey)),
placed AS (SELECT *, row_number() OVER (ORDER BY md5(code || '|42')) AS place, count(*) OVER () AS n FROM categorical),
split AS (SELECT *, place <= ceil(0.2::DOUBLE * n) AS is_test FROM placed),
scaler AS ({' UNION ALL '.join(f"SELECT '{c}' AS name, avg({c}) AS center, stddev_pop({c}) AS scale FROM split WHERE NOT is_test" for c in _NUTRIENTS)}),
codes AS ({' UNION ALL '.join(
    f"SELECT '{c}' AS col, value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT {c} AS value FROM split)"
    for c in ("category_top", "nutriscore_grade"))})
"""


def _scaled_sql(part: str, condition: str) -> str:
    scaled = " UNION ALL ".join(
        f"SELECT '{part}', '{c}', 'mean', round(avg(({c} - center) / scale), 6) FROM split, scaler WHERE scaler.name = '{c}' AND {condition}" for c in _NUTRIENTS
    )
    coded = " UNION ALL ".join(
        f"SELECT '{part}', '{c}', 'codes', sum(codes.code)::DOUBLE FROM split JOIN codes ON col = '{c}' AND value = {c} WHERE {condition}"
        for c in ("category_top", "nutriscore_grade")
    )
    flags = " UNION ALL ".join(f"SELECT '{part}', '{c}', 'set', count_if({c})::DOUBLE FROM split WHERE {condition}" for c in _FLAGS)
    return f"{scaled} UNION ALL {coded} UNION ALL {flags}"


_CHAIN_SQL = f"""WITH {PREPROCESSED_SQL},
sizes(stage, n) AS (
  SELECT unnest(['raw', 'preprocessed', 'categorical', 'split']), count(*) FROM split
  UNION ALL SELECT 'train', count_if(NOT is_test) FROM split UNION ALL SELECT 'test', count_if(is_test) FROM split
  UNION ALL SELECT 'scaler_params', count(*) FROM scaler UNION ALL SELECT 'encoder_map', count(*) FROM codes
  UNION ALL SELECT 'feature_roles', {len(_NUTRIENTS) + len(_FLAGS) + 3}),
reported(stage, name, measure, value) AS (
  SELECT stage, '', 'rows', n::DOUBLE FROM sizes
  UNION ALL SELECT 'scaler_params', name, 'center', round(center, 6) FROM scaler
  UNION ALL SELECT 'scaler_params', name, 'scale', round(scale, 6) FROM scaler
  UNION ALL SELECT 'encoder_map', col || '=' || value, 'code', code::DOUBLE FROM codes
  UNION ALL {_scaled_sql('train', 'NOT is_test')} UNION ALL {_scaled_sql('test', 'is_test')})
SELECT stage, name, measure, CASE WHEN value = 0 THEN 0.0 ELSE value END AS value FROM reported
"""


def preprocessing_measures(spark, done) -> DataFrame:
    """Rows of every stage, the fitted parameters, and what they make of both parts."""
    params, codes = done["scaler_params"].table, done["encoder_map"].table
    fitted = [
        params.select(F.lit("scaler_params").alias("stage"), F.col("column").alias("name"), F.lit(c).alias("measure"), F.round(c, 6).alias("value"))
        for c in ("center", "scale")
    ]
    named = F.concat("column", F.lit("="), "value")
    coded = codes.select(F.lit("encoder_map").alias("stage"), named.alias("name"), F.lit("code").alias("measure"), F.col("code").cast("double").alias("value"))
    values = {(c, "mean"): F.avg(c) for c in _NUTRIENTS} | {(c, "codes"): F.sum(c) for c in ("category_top", "nutriscore_grade")}
    values |= {(c, "set"): F.count_if(F.col(c)) for c in _FLAGS}
    parts = [measures(part, done[part].table, values) for part in ("train", "test")]
    found = union([row_counts(spark, done), *fitted, coded, *parts])
    return found.withColumn("value", F.col("value") + F.lit(0.0))  # -0.0 becomes 0.0


@query("preprocess_chain", _CHAIN_SQL)
def preprocess_chain(spark, folder):
    """The chain in a folder of its own, run twice: the second run makes nothing, and its tables are what is reported."""
    source, place = products(spark, folder), scratch_folder(spark, "chain")
    plans.preprocess_chain(source, place)
    done = plans.preprocess_chain(source, place)
    if not all(stage.found for stage in done.values()):
        raise RuntimeError("a stage that was whole has been made again")
    return preprocessing_measures(spark, done)


# -- gap analysis --------------------------------------------------------------------

_STRICT_SQL = f"COALESCE(len(list_filter(countries_tags, lambda t: regexp_matches(lower(t), '{STRICT_MARKET_PATTERN}'))) > 0, false)"


@query(
    "gap_chain",
    f"""WITH {MERGED_SQL.replace("gap AS (", "all_gap AS (", 1)
        .replace("right_side AS (", f"gap AS (SELECT * FROM all_gap WHERE {_STRICT_SQL}), right_side AS (", 1)},
    crosstab AS (SELECT category_top, count_if(language_case = '{CASE_GAP}') AS n_gap, count(*) AS total FROM gap GROUP BY category_top
      ORDER BY total DESC, category_top LIMIT 10),
    cases AS (SELECT language_case, count(*) AS n FROM gap GROUP BY language_case),
    reported(stage, name, measure, value) AS (
      SELECT unnest(['gap', 'merged']), '', 'rows', unnest([(SELECT count(*) FROM gap), (SELECT count(*) FROM merged)])::DOUBLE
      UNION ALL SELECT unnest(['crosstab', 'percent', 'gap_ratio']), '', 'rows', count(*)::DOUBLE FROM crosstab
      UNION ALL SELECT 'cases', '', 'rows', count(*)::DOUBLE FROM cases
      UNION ALL SELECT 'categories', '', 'rows', least(15, count(DISTINCT category_top))::DOUBLE FROM gap
      UNION ALL SELECT 'cases', language_case, 'n', n::DOUBLE FROM cases
      UNION ALL SELECT 'gap_ratio', category_top, 'gap_pct', round(n_gap * 100.0::DOUBLE / total, 6) FROM crosstab
      UNION ALL SELECT 'merged', c, 'found', n::DOUBLE FROM (UNPIVOT (SELECT {', '.join(f'count({c}) AS {c}' for c in _NUTRIENTS)} FROM merged)
        ON {', '.join(_NUTRIENTS)} INTO NAME c VALUE n)
      UNION ALL SELECT 'merged', 'energy_100g', 'sum', round(sum(energy_100g), 3) FROM merged)
    SELECT stage, name, measure, CASE WHEN value = 0 THEN 0.0 ELSE value END AS value FROM reported""",
)
def gap_chain(spark, folder):
    """Rows of every stage, the cases, the gap per category, and what the join found."""
    done = plans.gap_chain(ingredients(spark, folder), nutrient_rows(spark, folder), scratch_folder(spark, "gap"), GAP_CONFIG)
    row = lambda stage, name, measure, value: done[stage].table.select(
        F.lit(stage).alias("stage"), F.col(name).alias("name"), F.lit(measure).alias("measure"), value.cast("double").alias("value")
    )
    found = {(c, "found"): F.count(c) for c in _NUTRIENTS}
    total = done["merged"].table.agg(F.round(F.sum("energy_100g"), 3).alias("value"))
    return union([
        row_counts(spark, done), row("cases", "language_case", "n", F.col("n")), row("gap_ratio", "category_top", "gap_pct", F.round("gap_pct", 6)),
        measures("merged", done["merged"].table, found),
        total.select(F.lit("merged").alias("stage"), F.lit("energy_100g").alias("name"), F.lit("sum").alias("measure"), "value"),
    ])


# -- scoring as a stream -----------------------------------------------------------


def line_model(spark, folder):
    """A forest over the five nutrients of the products, which tells fat ones from the others."""
    rows = cleaning.add_nutrients(products(spark, folder)).withColumn("target", (F.col("fat_100g") > 25).cast("int"))
    return detector.train_detector(rows, MODEL_NUTRIENTS, n_trees=10)


_LINE_COLUMNS = ["value", "status", *MODEL_NUTRIENTS]


@query(
    "score_stream",
    f"""WITH {_LINES_SQL} SELECT value, status,
    {', '.join(f"CASE WHEN status = 'ok' THEN n[{i}] + 0.0 END AS {c}" for i, c in enumerate(MODEL_NUTRIENTS, 1))},
    count(*) AS n, true AS as_in_batch FROM parsed WHERE status <> 'quit' GROUP BY ALL""",
)
def score_stream(spark, folder):
    """The lines of all events as files, scored by a stream that is cut off inside a batch and started again.

    The cut comes when the second batch has written its rows and before it is committed. Counts are those of what the stream committed; the
    mark says that a batch job over the same lines gives every row, score included, as often.
    """
    place, model = scratch_folder(spark, "stream"), line_model(spark, folder)
    score_lines(spark, folder).select("value").repartition(8).write.text(f"{place}/lines")
    folders = [f"{place}/{name}" for name in ("scored", "rejected", "checkpoint")]

    def cut_off(write):
        def run(batch, batch_id):
            if batch_id == 1:
                parse_lines(batch).filter("status = 'ok'").write.mode("overwrite").parquet(f"{folders[0]}/batch=1")
                raise InterruptedError("the driver is lost in the second batch")
            write(batch, batch_id)

        return run

    stream = lambda **more: score_line_stream(spark, f"{place}/lines", model, *folders, max_files_per_trigger=3, **more)
    try:
        stream(sink=cut_off).awaitTermination()
    except StreamingQueryException:
        stream().awaitTermination()
    scored, rejected = (committed_rows(spark, f, folders[2]) for f in folders[:2])
    streamed = scored.withColumn("status", F.lit("ok")).unionByName(rejected, allowMissingColumns=True)

    parsed = parse_lines(spark.read.text(f"{place}/lines"))
    good = detector.score_products(model, parsed.filter("status = 'ok'"), MODEL_NUTRIENTS, ["value"]).withColumn("status", F.lit("ok"))
    batch = good.unionByName(parsed.filter(F.col("status").isin(REJECTED)).select("value", "status"), allowMissingColumns=True)
    columns = [*_LINE_COLUMNS, "risk_score", "band"]
    both = streamed.select(*columns, F.lit(1).alias("n"), F.lit(1).alias("more")).unionByName(batch.select(*columns, F.lit(0).alias("n"), F.lit(-1).alias("more")))
    counted = both.groupBy(*columns).agg(F.sum("n").alias("n"), F.sum("more").alias("more"))
    return counted.select(*_LINE_COLUMNS[:2], *[(F.col(c) + 0.0).alias(c) for c in MODEL_NUTRIENTS], "n", (F.col("more") == 0).alias("as_in_batch"))


# -- validation ----------------------------------------------------------------------

_STATISTICS = ["ks_statistic", "ks_pvalue", "wasserstein", "psi", *_MOMENT_COLUMNS]
_PAIRS = [("l_quantity", "l_extendedprice"), ("l_discount", "l_tax")]
_MODELS = ["Logistic Regression", "Random Forest", "Gradient Boosting"]


@query(
    "validate_chain",
    f"""WITH {_STEPS_SQL}, {_PSI_SQL}, {_MOMENTS_SQL}, {_MATRICES_SQL.removeprefix(SIDES_SQL).lstrip(', ')},
    statistics AS (SELECT variable, round(d.ks_statistic, 6) AS ks_statistic, round(ks_pvalue, 6) AS ks_pvalue, round(wasserstein, 6) AS wasserstein,
      round(psi, 6) AS psi, {_MOMENT_SELECT}
      FROM distances d JOIN tested USING (variable) JOIN stability USING (variable) JOIN moments USING (variable)),
    cells AS (SELECT var_a || ' - ' || var_b AS name, round(o.r, 6) AS o, round(s.r, 6) AS s, round(o.r - s.r, 6) AS d
      FROM original o JOIN synthetic s USING (var_a, var_b)),
    smaller AS (SELECT min(n) AS n FROM (SELECT count(*) AS n FROM sides GROUP BY is_synthetic)),
    reported(part, name, measure, value) AS (
      SELECT 'statistics', variable, measure, value FROM (UNPIVOT statistics ON {', '.join(_STATISTICS)} INTO NAME measure VALUE value)
      UNION ALL SELECT 'summary', variable, 'psi', round(psi, 4) FROM stability
      UNION ALL SELECT 'skipped', unnest(['l_tax_rate', 'l_comment']), unnest(['not in the synthetic', 'not in the original']), NULL
      UNION ALL SELECT 'correlations', name, 'original', o FROM cells UNION ALL SELECT 'correlations', name, 'synthetic', s FROM cells
      UNION ALL SELECT 'correlations', name, 'difference', d FROM cells
      UNION ALL SELECT 'key_pairs', name, 'difference', abs(d) FROM cells WHERE name IN ({', '.join(f"'{a} - {b}'" for a, b in _PAIRS)})
      UNION ALL SELECT 'auroc', unnest({_MODELS}), 'in range', 1
      UNION ALL SELECT 'confusion', '', 'rows', ceil(0.3::DOUBLE * 2 * n) FROM smaller)
    SELECT part, name, measure, CASE WHEN value = 0 THEN 0.0::DOUBLE ELSE value::DOUBLE END AS value FROM reported""",
)
def validate_chain(spark, folder):
    """All results of the validation as one table; of the discriminators what holds for any model."""
    original = sides(spark, folder).filter("is_synthetic = 0").drop("is_synthetic").withColumn("l_tax_rate", F.col("l_tax") * 100)
    synthetic = sides(spark, folder).filter("is_synthetic = 1").drop("is_synthetic")
    wanted = [*SIDE_COLUMNS, "l_tax_rate", "l_comment"]
    results = plans.validate(original, synthetic, wanted, plans.Config(n_trees=5), _PAIRS)

    def part(name, key, values):
        cells = [F.struct(F.lit(m).alias("measure"), v.cast("double").alias("value")) for m, v in values.items()]
        return results[name].select(F.lit(name).alias("part"), key.alias("name"), F.inline(F.array(*cells)))

    cells = F.concat_ws(" - ", "var_a", "var_b")
    found = union([
        part("statistics", F.col("variable"), {c: F.round(c, 6) for c in _STATISTICS}),
        part("summary", F.col("variable"), {"psi": F.col("psi")}),
        results["skipped"].select(F.lit("skipped").alias("part"), F.col("variable").alias("name"), F.col("reason").alias("measure"), F.lit(None).cast("double").alias("value")),
        part("correlations", cells, {c: F.round(c, 6) for c in ("original", "synthetic", "difference")}),
        part("key_pairs", F.col("variable_pair"), {"difference": F.round("difference", 6)}),
        part("auroc", F.col("model"), {"in range": F.col("auroc").between(0, 1)}),
        results["confusion"].agg(F.sum("n").cast("double").alias("value")).select(F.lit("confusion").alias("part"), F.lit("").alias("name"), F.lit("rows").alias("measure"), "value"),
    ])
    return found.withColumn("value", F.col("value") + F.lit(0.0))


# -- synthesis that fails ------------------------------------------------------------------


@query(
    "synthesis_fallback",
    f"""WITH {MERGED_SQL} SELECT contains(language_case, 'Gap')::INT AS target, 0 AS is_synthetic, count(*) AS n, true AS is_reported, true AS is_judged
    FROM merged WHERE {' AND '.join(f'{c} IS NOT NULL' for c in MODEL_NUTRIENTS)} AND category_top IS NOT NULL GROUP BY 1""",
)
def synthesis_fallback(spark, folder):
    """The rows a detector is trained on when the job that makes synthetic rows fails in one of its tasks."""

    def failing(spark, model, n, seed):
        broken = F.udf(lambda value: 1 / 0 if value is not None else value, "double")  # nothing happens before a task runs
        return synthesis.generate(spark, model, n, seed).withColumn("fat_100g", broken("fat_100g"))

    result = plans.synthesis_and_detector(merged(spark, folder), config=plans.Config(n_trees=3, n_synthetic=500), generate=failing)
    is_reported = result["synthetic"] is None and "ZeroDivisionError" in (result["error"] or "")
    is_judged = result["quality"].first()["accuracy"] is not None
    counted = result["augmented"].groupBy("target", "is_synthetic").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumns({"is_reported": F.lit(is_reported), "is_judged": F.lit(is_judged)})
