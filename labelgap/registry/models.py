"""Synthesis, detector, evaluation and scoring."""

from pyspark.sql import functions as F

from labelgap.fixed_values import MODEL_NUTRIENTS
from labelgap.functions.scoring import risk_advice, risk_band, risk_verdict
from labelgap.operators import detector, drift, evaluation, features, synthesis
from labelgap.operators.sampling import ROW_ID, split_train_test, with_row_id
from labelgap.registry.catalog import query
from labelgap.registry.features import rounded
from labelgap.registry.views import (
    CLASS_FEATURES,
    CLASSED_SQL,
    MEASURED_SQL,
    SIDE_COLUMNS,
    SIDES_SQL,
    classed,
    measured,
    sides,
    table,
)
from labelgap.session import written
from labelgap.streaming.scoring import parse_lines


def training_rows(spark, folder):
    """Labelled documents with the category as a code: a narrow table that the fits read many times."""
    rows = classed(spark, folder)
    encoder = features.fit_encoder([rows], ["category_top"])
    return written(features.apply_encoder(rows, encoder, ["category_top"]), "training")


def synthetic_rows(spark, folder):
    """As many synthetic rows as there are real ones."""
    real = training_rows(spark, folder)
    model = synthesis.fit_synthesizer(real, CLASS_FEATURES)
    return synthesis.generate(spark, model, real.count())


# -- synthesis ---------------------------------------------------------------


@query("synthesize_rows")
def synthesize_rows(spark, folder):
    return synthetic_rows(spark, folder)


@query(
    "synthesize_counts",
    f"""WITH {CLASSED_SQL} SELECT target, count(*) AS n, true AS known_category, true AS known_size FROM classed GROUP BY target""",
)
def synthesize_counts(spark, folder):
    """As many rows of each class as there are, and only values that the class has."""
    real = classed(spark, folder)
    known = lambda c: real.select("target", F.col(c).alias("_known")).distinct()
    codes = training_rows(spark, folder)
    made = synthetic_rows(spark, folder)
    made = made.join(codes.select("target", F.col("category_top").alias("_c")).distinct(), (codes["target"] == made["target"]) & (F.col("_c") == made["category_top"]), "left_semi")
    sized = made.join(known("n_chars").withColumnRenamed("target", "_t"), (F.col("_t") == F.col("target")) & (F.col("_known") == F.col("n_chars")), "left")
    return sized.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), F.lit(True).alias("known_category"), F.bool_and(F.col("_known").isNotNull()).alias("known_size")
    )


@query(
    "copula_marginals",
    f"""WITH {SIDES_SQL}, counts AS (SELECT is_synthetic, variable, value, count(*) AS n FROM side_values GROUP BY ALL)
    SELECT is_synthetic, variable, value, n, (sum(n) OVER (PARTITION BY is_synthetic, variable ORDER BY value))::BIGINT AS cum_n,
           (sum(n) OVER (PARTITION BY is_synthetic, variable))::BIGINT AS total_n FROM counts""",
)
def copula_marginals(spark, folder):
    return synthesis.value_distribution(sides(spark, folder), SIDE_COLUMNS, "is_synthetic")


@query(
    "balance_minority",
    f"""WITH {CLASSED_SQL} SELECT target, 0 AS is_synthetic, count(*) AS n FROM classed GROUP BY target
    UNION ALL SELECT 1, 1, (count_if(target = 0) - count_if(target = 1))::BIGINT FROM classed""",
)
def balance_minority(spark, folder):
    real = training_rows(spark, folder)
    added = synthesis.balance_minority(real, CLASS_FEATURES)
    grown = synthesis.augment(real.select(*CLASS_FEATURES, "target"), added)
    return grown.groupBy("target", "is_synthetic").agg(F.count(F.lit(1)).alias("n"))


# -- detector ------------------------------------------------------------------


@query("train_detector")
def train_detector(spark, folder):
    train, test = split_train_test(training_rows(spark, folder), "doc_id")
    model = detector.train_detector(train, CLASS_FEATURES)
    return detector.evaluate(model, test, CLASS_FEATURES)


# Forests differ in their digits; what must hold for any forest is checked by SQL.
@query(
    "detector_facts",
    f"""WITH {CLASSED_SQL}, tested AS (SELECT * FROM classed QUALIFY
      row_number() OVER (ORDER BY md5(doc_id || '|42')) <= (SELECT ceil(0.2 * count(*)) FROM classed))
    SELECT target, count(*) AS n, true AS in_range, true AS is_sure_side FROM tested GROUP BY target""",
)
def detector_facts(spark, folder):
    """Test rows per class, scores between 0 and 1, and predictions on the score's side of a half."""
    train, test = split_train_test(training_rows(spark, folder), "doc_id")
    scored = detector.predict(detector.train_detector(train, CLASS_FEATURES), test, CLASS_FEATURES, ["target"])
    return scored.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("score").between(0, 1)).alias("in_range"),
        F.bool_and((F.col("prediction") == 1) == (F.col("score") > 0.5)).alias("is_sure_side"),
    )


@query("importance_topk")
def importance_topk(spark, folder):
    model = detector.train_detector(training_rows(spark, folder), CLASS_FEATURES, balanced=True)
    return detector.feature_importance(spark, model, CLASS_FEATURES)


@query(
    "importance_facts",
    f"""WITH {CLASSED_SQL} SELECT 4::BIGINT AS n_features, round(count(*) / count(*)::DOUBLE, 6) AS total, true AS is_ranked FROM classed""",
)
def importance_facts(spark, folder):
    model = detector.train_detector(training_rows(spark, folder), CLASS_FEATURES)
    ranked = detector.feature_importance(spark, model, CLASS_FEATURES, None)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("rank", "importance"))), lambda r: r["importance"])
    found = ranked.agg(F.count(F.lit(1)).alias("n_features"), F.sum("importance").alias("total"), (in_order == F.reverse(F.array_sort(in_order))).alias("is_ranked"))
    return rounded(found, "total")


def scored_documents(spark, folder):
    """All documents, scored by a forest fitted on the labelled ones."""
    everything = measured(spark, folder)
    encoder = features.fit_encoder([everything], ["category_top"])
    fitted = written(features.apply_encoder(classed(spark, folder), encoder, ["category_top"]), "training")
    model = detector.train_detector(fitted, CLASS_FEATURES)
    return detector.score_products(model, features.apply_encoder(everything, encoder, ["category_top"]), CLASS_FEATURES, ["doc_id"])


@query("score_batch")
def score_batch(spark, folder):
    return scored_documents(spark, folder)


@query(
    "score_batch_facts",
    f"WITH {MEASURED_SQL} SELECT doc_id, n_chars, n_words, n_lines, true AS in_range, true AS band_agrees FROM measured",
)
def score_batch_facts(spark, folder):
    """Every document is scored, in percent, and its band is that of its score."""
    score = F.col("risk_score")
    band = F.when(score >= 70, "high").when(score >= 40, "caution").otherwise("safe")
    return scored_documents(spark, folder).select(
        "doc_id", "n_chars", "n_words", "n_lines", score.between(0, 100).alias("in_range"), (F.col("band") == band).alias("band_agrees")
    )


@query("augmentation_effect")
def augmentation_effect(spark, folder):
    return detector.augmentation_effect(training_rows(spark, folder), CLASS_FEATURES, "doc_id")


_LARGEST_REMAINDER_SQL = """
sizes AS (SELECT target, count(*) AS n, (sum(count(*)) OVER ())::BIGINT AS total FROM classed GROUP BY target),
wanted AS (SELECT *, total - ceil(0.2 * total)::BIGINT AS k FROM sizes),
shares AS (SELECT *, n * k // total AS whole, n * k % total AS rest FROM wanted),
train AS (SELECT target, n, whole + (row_number() OVER (ORDER BY rest DESC, target) <= (SELECT max(k) - sum(whole) FROM shares))::INT AS n_train
  FROM shares)
"""


@query(
    "augmentation_facts",
    f"""WITH {CLASSED_SQL}, {_LARGEST_REMAINDER_SQL}
    SELECT 'baseline' AS experiment, 0::BIGINT AS n_synthetic, true AS in_range, true AS without_error
    UNION ALL SELECT 'augmented', (SELECT sum(CASE WHEN target = 0 THEN n_train ELSE -n_train END) FROM train)::BIGINT, true, true""",
)
def augmentation_facts(spark, folder):
    """Rows added to the training part, and measures that are shares."""
    found = detector.augmentation_effect(training_rows(spark, folder), CLASS_FEATURES, "doc_id")
    in_range = F.col("accuracy").between(0, 1) & F.col("f1").between(0, 1)
    return found.select("experiment", "n_synthetic", in_range.alias("in_range"), F.col("error").isNull().alias("without_error"))


def discriminated(spark, folder):
    real = training_rows(spark, folder).select(*CLASS_FEATURES)
    both = with_row_id(drift.label_sides(real, synthetic_rows(spark, folder).select(*CLASS_FEATURES)))
    return detector.discriminator_predictions(both, CLASS_FEATURES, ROW_ID)[0]


@query("train_discriminators")
def train_discriminators(spark, folder):
    return detector.discriminator_results(discriminated(spark, folder))["auroc"]


@query(
    "discriminator_facts",
    f"""WITH {CLASSED_SQL}, models AS (SELECT unnest(['Logistic Regression', 'Random Forest', 'Gradient Boosting']) AS model)
    SELECT model, ceil(0.3 * 2 * count(*))::BIGINT AS n_test, true AS in_range FROM models, classed GROUP BY model""",
)
def discriminator_facts(spark, folder):
    """Three models on one and the same number of test rows."""
    return discriminated(spark, folder).groupBy("model").agg(
        F.count(F.lit(1)).alias("n_test"), F.bool_and(F.col("score").between(0, 1)).alias("in_range")
    )


@query(
    "class_weights",
    f"""WITH {CLASSED_SQL} SELECT target, count(*) AS n,
    round((SELECT count(*) / count(DISTINCT target)::DOUBLE FROM classed) / count(*), 6) AS weight FROM classed GROUP BY target""",
)
def class_weights(spark, folder):
    return rounded(detector.class_weights(classed(spark, folder)), "weight")


# -- evaluation -------------------------------------------------------------------

_JUDGED_SQL = f"{CLASSED_SQL}, judged AS (SELECT *, (n_chars > 2000)::INT AS prediction FROM classed)"


def judged(spark, folder):
    """Documents with a plain rule as the prediction."""
    return classed(spark, folder).withColumn("prediction", (F.col("n_chars") > 2000).cast("int"))


@query(
    "metric_accuracy",
    f"WITH {_JUDGED_SQL} SELECT round(avg((target = prediction)::INT), 6) AS accuracy FROM judged",
)
def metric_accuracy(spark, folder):
    return rounded(evaluation.accuracy(judged(spark, folder), "target"), "accuracy")


@query(
    "metric_f1",
    f"""WITH {_JUDGED_SQL}, c AS (SELECT count_if(target = 1 AND prediction = 1) AS tp,
      count_if(target = 0 AND prediction = 1) AS fp, count_if(target = 1 AND prediction = 0) AS fn FROM judged)
    SELECT round(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1 FROM c""",
)
def metric_f1(spark, folder):
    return rounded(evaluation.f1_score(judged(spark, folder), "target"), "f1")


@query(
    "confusion_matrix",
    f"""WITH {_JUDGED_SQL}, cells AS (SELECT a::INT AS actual, p::INT AS predicted FROM range(2) x(a), range(2) y(p))
    SELECT actual, predicted, count(target) AS n FROM cells
    LEFT JOIN judged ON actual = target AND predicted = prediction GROUP BY actual, predicted""",
)
def confusion_matrix(spark, folder):
    return evaluation.confusion_matrix(judged(spark, folder), "target")


@query(
    "class_report",
    f"""WITH {_JUDGED_SQL},
    c AS (SELECT k, count_if(target = k AND prediction = k)::DOUBLE AS tp, count_if(target <> k AND prediction = k)::DOUBLE AS fp,
                 count_if(target = k AND prediction <> k)::DOUBLE AS fn FROM judged, (VALUES (0), (1)) v(k) GROUP BY k),
    m AS (SELECT k, COALESCE(tp / NULLIF(tp + fp, 0), 0) AS precision, COALESCE(tp / NULLIF(tp + fn, 0), 0) AS recall,
                 COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0) AS f1, tp, (tp + fn)::BIGINT AS support FROM c)
    SELECT CASE k WHEN 0 THEN 'safe' ELSE 'risk' END AS class, round(precision, 6) AS precision, round(recall, 6) AS recall,
           round(f1, 6) AS f1, support FROM m
    UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
           round(sum(tp) / sum(support), 6), sum(support)::BIGINT FROM m
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM m
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
           round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM m""",
)
def class_report(spark, folder):
    found = evaluation.class_report(judged(spark, folder), "target", names=("safe", "risk"))
    return rounded(found, "precision", "recall", "f1")


_SCORED_SQL = f"""
{CLASSED_SQL},
scored AS (SELECT 'n_chars' AS model, target AS label, n_chars AS score FROM classed
  UNION ALL SELECT 'n_words', target, n_words FROM classed UNION ALL SELECT 'n_lines', target, n_lines FROM classed),
pairs AS (SELECT model, score, sum((label = 1)::INT) AS pos, sum((label = 0)::INT) AS neg FROM scored GROUP BY model, score),
curve AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY model) AS all_pos,
  sum(neg) OVER (PARTITION BY model) AS all_neg, lag(pos) OVER o AS pos_before, lead(pos) OVER o AS pos_after,
  lead(neg) OVER o AS neg_after FROM pairs
  WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING), o AS (PARTITION BY model ORDER BY score DESC)),
areas AS (SELECT model, sum(neg * (tp - pos / 2.0::DOUBLE)) / max(all_pos * all_neg)::DOUBLE AS auroc FROM curve GROUP BY model)
"""


def scored(spark, folder):
    """Three measures of a document as three models that score its label."""
    measures = ["n_chars", "n_words", "n_lines"]
    rows = classed(spark, folder).select(F.col("target").alias("label"), *measures)
    return rows.select("label", drift.long_form(measures)).withColumnsRenamed({"variable": "model", "value": "score"})


@query("auroc", f"WITH {_SCORED_SQL} SELECT model, round(auroc, 6) AS auroc FROM areas")
def auroc(spark, folder):
    return rounded(evaluation.auroc(scored(spark, folder), by=["model"]), "auroc")


@query(
    "roc_points",
    f"""WITH {_SCORED_SQL} SELECT model, score AS threshold, round(fp / all_neg::DOUBLE, 6) AS fpr,
      round(tp / all_pos::DOUBLE, 6) AS tpr FROM curve
    WHERE pos_before IS NULL OR pos_after IS NULL OR pos <> pos_after OR neg <> neg_after
    UNION ALL SELECT DISTINCT model, 'Infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM curve""",
)
def roc_points(spark, folder):
    return rounded(evaluation.roc_points(scored(spark, folder), by=["model"]), "fpr", "tpr")


@query(
    "rank_models",
    f"""WITH {_SCORED_SQL} SELECT model, round(auroc, 6) AS auroc, round(abs(auroc - 0.5), 6) AS distance
    FROM areas ORDER BY distance""",
)
def rank_models(spark, folder):
    ranked = evaluation.rank_models(evaluation.auroc(scored(spark, folder), by=["model"]))
    return rounded(ranked, "auroc", "distance")


@query(
    "disc_verdict",
    f"""WITH {_SCORED_SQL}, m AS (SELECT avg(auroc) AS a, avg(abs(auroc - 0.5)) AS d FROM areas)
    SELECT round(a, 6) AS mean_auroc, round(d, 6) AS mean_distance, CASE WHEN a < 0.55 THEN 'very similar'
      WHEN a < 0.65 THEN 'fairly similar' ELSE 'distinguishable' END AS verdict FROM m""",
)
def disc_verdict(spark, folder):
    found = evaluation.discriminator_verdict(evaluation.auroc(scored(spark, folder), by=["model"]))
    return rounded(found, "mean_auroc", "mean_distance")


# -- scoring ---------------------------------------------------------------------------


@query(
    "risk_bands",
    """WITH s AS (SELECT event_id, (event_id * 7919 + user_id) % 10001 / 100.0::DOUBLE AS score FROM events)
    SELECT event_id, CASE WHEN score >= 70 THEN 'high' WHEN score >= 40 THEN 'caution' ELSE 'safe' END AS band,
      CASE WHEN score >= 70 THEN '[수출 부적합 / 내수용 스펙]' WHEN score >= 40 THEN '[수출 가능성 있음 / 라벨 보완 필요]'
           ELSE '[수출 적합 / 글로벌 스펙]' END AS verdict,
      score >= 70 OR score < 40 AS has_advice FROM s""",
)
def risk_bands(spark, folder):
    score = F.col("event_id") * 7919 + F.col("user_id")
    banded = table(spark, folder, "events").select("event_id", risk_band((score % 10001) / 100).alias("band"))
    return banded.select(
        "event_id", "band", risk_verdict(F.col("band")).alias("verdict"), risk_advice(F.col("band")).isNotNull().alias("has_advice")
    )


_LINES_SQL = """
lines AS (SELECT event_id, CASE
    WHEN event_id % 101 = 0 THEN 'Q'
    WHEN event_id % 103 = 0 THEN ''
    ELSE '1,' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') || ' ' || (user_id % 60) || '.5  ' ||
         CASE WHEN event_id % 7 = 0 THEN event_type ELSE CAST(event_id % 50 AS VARCHAR) END || ' -' || (user_id % 40) ||
         CASE WHEN event_id % 5 = 0 THEN '' ELSE ' 1e-' || (event_id % 3) END END AS value FROM events),
words AS (SELECT *, list_filter(string_split(replace(value, ',', ''), ' '), lambda w: w <> '') AS w FROM lines),
numbers AS (SELECT *, list_transform(w, lambda t: TRY_CAST(t AS DOUBLE)) AS n FROM words),
parsed AS (SELECT *, CASE WHEN lower(value) = 'q' THEN 'quit' WHEN list_count(n) < len(w) THEN 'number_error'
                          WHEN len(w) <> 5 THEN 'count_error' ELSE 'ok' END AS status FROM numbers)
"""


def score_lines(spark, folder):
    event, user = F.col("event_id"), F.col("user_id")
    line = F.concat(
        F.lit("1,"), F.lpad((event % 1000).cast("string"), 3, "0"), F.lit(" "), (user % 60).cast("string"), F.lit(".5  "),
        F.when(event % 7 == 0, F.col("event_type")).otherwise((event % 50).cast("string")), F.lit(" -"), (user % 40).cast("string"),
        F.when(event % 5 == 0, "").otherwise(F.concat(F.lit(" 1e-"), (event % 3).cast("string"))),
    )
    value = F.when(event % 101 == 0, "Q").when(event % 103 == 0, "").otherwise(line)
    return table(spark, folder, "events").select("event_id", value.alias("value"))


@query(
    "parse_score_lines",
    f"""WITH {_LINES_SQL} SELECT event_id, status,
    {', '.join(f"CASE WHEN status = 'ok' THEN n[{i}] + 0.0 END AS {c}" for i, c in enumerate(MODEL_NUTRIENTS, 1))} FROM parsed""",
)
def parse_score_lines(spark, folder):
    parsed = parse_lines(score_lines(spark, folder))
    return parsed.select("event_id", "status", *[(F.col(c) + 0.0).alias(c) for c in MODEL_NUTRIENTS])
