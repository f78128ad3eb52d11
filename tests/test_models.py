"""Synthesis, detector, discriminators and streaming, with small forests."""

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from labelgap.operators import correlation, detector, drift, synthesis
from labelgap.operators.sampling import ROW_ID, with_row_id
from labelgap.session import remove_folder
from labelgap.streaming import committed_rows, commits, score_line_stream

TREES = 10
NUTRIENTS = ["energy_100g", "fat_100g", "sugars_100g", "proteins_100g", "sodium_100g"]


@pytest.fixture(scope="module")
def products(spark):
    """Zero-heavy nutrients; one product in 20 is at risk and has more fat."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(1200):
        risk = int(i % 20 == 0)
        empty = rng.random() < 0.4
        fat = 0.0 if empty else float(rng.gamma(2, 5) + 25 * risk)
        energy = 0.0 if empty else fat * 9 + float(rng.gamma(3, 40))
        rows.append((str(i), energy, fat, float(rng.gamma(1, 6)), float(rng.integers(0, 20)), 0.5, int(rng.integers(0, 4)), risk))
    schema = "code string, " + ", ".join(f"{c} double" for c in NUTRIENTS) + ", category_top int, target int"
    return spark.createDataFrame(rows, schema).cache()


FEATURES = [*NUTRIENTS, "category_top"]


def test_synthetic_rows_resemble_the_real_ones(spark, products):
    model = synthesis.fit_synthesizer(products, FEATURES)
    made = synthesis.generate(spark, model, 3000, seed=5)
    assert made.columns == [*FEATURES, "target"] and made.schema["category_top"].dataType.simpleString() == "int"
    assert made.count() == 3000 and made.filter("target = 1").count() == 150
    both = drift.label_sides(products.select(*FEATURES), made.select(*FEATURES))
    report = {r["variable"]: r for r in drift.statistical_report(both, FEATURES).collect()}
    assert all(r["ks_statistic"] < 0.1 for r in report.values())
    zero = lambda df: df.filter("energy_100g = 0").count() / df.count()
    assert abs(zero(products) - zero(made)) < 0.05
    assert made.filter("sodium_100g <> 0.5").count() == 0
    real_r, made_r = (df.select(F.corr("energy_100g", "fat_100g")).first()[0] for df in (products, made))
    assert abs(real_r - made_r) < 0.15


def test_rare_values_keep_their_frequency(spark):
    """Five far values in 20,000 rows come out as often as they go in, and the spread with them."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 4000 == 7, 1_000_000.0 + F.col("id") % 5).otherwise((F.col("id") % 100).cast("double")).alias("x"),
        (F.col("id") % 3).cast("int").alias("category_top"), F.lit("only").alias("target"),
    )
    model = synthesis.fit_synthesizer(rows, ["x", "category_top"])
    made = synthesis.generate(spark, model, 400_000, seed=3)
    real, drawn = (df.agg(F.stddev("x").alias("s"), F.max("x").alias("m"), F.avg((F.col("x") > 1000).cast("int")).alias("p")).first() for df in (rows, made))
    assert made.count() == 400_000 and drawn["m"] >= 1_000_000 and abs(drawn["p"] / real["p"] - 1) < 0.4
    assert abs(drawn["s"] / real["s"] - 1) < 0.2
    shares = {r["category_top"]: r["count"] for r in made.groupBy("category_top").count().collect()}
    assert set(shares) == {0, 1, 2} and all(abs(n / 400_000 - 1 / 3) < 0.01 for n in shares.values())


def test_many_classes_and_categories_stay_in_their_class(spark):
    rows = spark.range(4000).select(
        (F.col("id") % 200).cast("int").alias("target"), ((F.col("id") % 200) * 10 + F.col("id") % 3).cast("int").alias("category_top"),
        (F.col("id") * 37 % 1000).cast("double").alias("x"), (F.col("id") * 37 % 1000 + F.col("id") % 5).cast("double").alias("y"),
    )
    made = synthesis.generate(spark, synthesis.fit_synthesizer(rows, ["x", "y", "category_top"]), 2000, seed=1)
    assert made.groupBy("target").count().filter("count = 10").count() == 200
    assert made.filter("category_top div 10 <> target").count() == 0
    assert made.select(F.corr("x", "y")).first()[0] > 0.9


def test_generation_depends_on_the_seed_only(spark, products):
    model = synthesis.fit_synthesizer(products, FEATURES)
    rows = lambda seed: sorted(map(tuple, synthesis.generate(spark, model, 50, seed).collect()))
    assert rows(1) == rows(1) and rows(1) != rows(2)
    longer = {tuple(r) for r in synthesis.generate(spark, model, 0).collect()}
    assert longer == set()


def test_minority_is_brought_to_half(spark, products):
    made = synthesis.balance_minority(products, FEATURES)
    assert made.count() == 1140 - 60 and made.filter("target <> 1").count() == 0
    assert made.agg(F.avg("fat_100g")).first()[0] > 10
    grown = synthesis.augment(products.select(*FEATURES, "target"), made)
    assert {tuple(r) for r in grown.groupBy("target").count().collect()} == {(0, 1140), (1, 1140)}
    assert synthesis.balance_minority(grown, FEATURES) is None


def test_synthesis_of_nothing(spark, products):
    with pytest.raises(ValueError):
        synthesis.fit_synthesizer(products.limit(0), FEATURES)


def test_detector_scores(spark, products):
    model = detector.train_detector(products, NUTRIENTS, n_trees=TREES, balanced=True)
    quality = detector.evaluate(model, products, NUTRIENTS).first()
    assert quality["accuracy"] > 0.9 and quality["is_good"]
    importance = detector.feature_importance(spark, model, NUTRIENTS).collect()
    assert [r["rank"] for r in importance] == [1, 2, 3] and importance[0]["feature"] in ("fat_100g", "energy_100g")
    scored = detector.score_products(model, products, NUTRIENTS, ["code"])
    assert scored.count() == 1200
    wrong = "(band = 'high') <> (risk_score >= 70) OR (band = 'safe') <> (risk_score < 40) OR (advice IS NULL) <> (band = 'caution')"
    assert scored.filter(wrong).count() == 0


def test_forests_fit_on_no_more_partitions_than_cores(spark, products, monkeypatch):
    seen, fit = [], RandomForestClassifier.fit

    def watched(estimator, rows):
        seen.append((rows.rdd.getNumPartitions(), estimator.getCacheNodeIds()))
        return fit(estimator, rows)

    monkeypatch.setattr(RandomForestClassifier, "fit", watched)
    cores = spark.sparkContext.defaultParallelism
    scattered = products.repartition(3 * cores)
    model = detector.train_detector(scattered, NUTRIENTS, n_trees=TREES)
    both = with_row_id(drift.label_sides(scattered.select(*NUTRIENTS), scattered.select(*NUTRIENTS)))
    detector.discriminator_predictions(both, NUTRIENTS, ROW_ID, n_trees=2)
    assert len(seen) == 2 and all(n <= cores and cached for n, cached in seen)
    assert detector.evaluate(model, products, NUTRIENTS).first()["accuracy"] > 0.9


def test_trees_of_a_large_table_are_shared_out(spark, products, monkeypatch):
    """Fits at once, each on fewer partitions than cores, whose trees are one forest."""
    seen, fit = [], RandomForestClassifier.fit

    def watched(estimator, rows):
        seen.append((rows.rdd.getNumPartitions(), estimator.getNumTrees(), estimator.getSeed()))
        return fit(estimator, rows)

    monkeypatch.setattr(RandomForestClassifier, "fit", watched)
    monkeypatch.setattr(detector, "SHARE_TREES_FROM", 1000)
    cores = spark.sparkContext.defaultParallelism
    model = detector.train_detector(products.repartition(cores), NUTRIENTS, n_trees=11, balanced=True)
    n_fits = min(11, cores)
    assert len(seen) == n_fits and {n for n, _, _ in seen} == {1} and sum(t for _, t, _ in seen) == 11 == model.getNumTrees
    assert len({s for _, _, s in seen}) == n_fits
    assert detector.evaluate(model, products, NUTRIENTS).first()["accuracy"] > 0.9
    importance = model.featureImportances.toArray()
    assert importance.sum() == pytest.approx(1) and importance[:2].sum() > 0.5
    # Every tree has one vote.
    scored = model.transform(detector._assembled(products, NUTRIENTS, ["code"])).select("code", vector_to_array("probability")[1], "prediction")
    found = {r[0]: r[1:] for r in scored.collect()}
    votes = dict.fromkeys(found, 0.0)
    for part in model.parts:
        for code, score in detector.predict(part, products, NUTRIENTS, ["code"]).select("code", "score").collect():
            votes[code] += score * part.getNumTrees / 11
    assert all(found[c][0] == pytest.approx(votes[c]) and (found[c][1] == 1) == (found[c][0] > 0.5) for c in votes)
    monkeypatch.setattr(detector, "ROWS_PER_PARTITION", 500)
    seen.clear()
    detector.train_detector(products.repartition(cores), NUTRIENTS, n_trees=11)
    assert all(n <= 3 for n, _, _ in seen) and len(seen) == max(1, min(11, cores // 3))


def test_class_weights(spark, products):
    found = {r["target"]: r["weight"] for r in detector.class_weights(products).collect()}
    assert found == {0: pytest.approx(1200 / (2 * 1140)), 1: pytest.approx(1200 / (2 * 60))}


def test_augmentation_effect(spark, products, monkeypatch):
    rows = {r["experiment"]: r for r in detector.augmentation_effect(products, FEATURES, "code", n_trees=TREES).collect()}
    assert rows["augmented"]["n_synthetic"] == 912 - 48 and rows["augmented"]["error"] is None

    def fail(*args, **kwargs):
        raise RuntimeError("no generator")

    monkeypatch.setattr(detector, "balance_minority", fail)
    rows = {r["experiment"]: r for r in detector.augmentation_effect(products, FEATURES, "code", n_trees=2).collect()}
    assert rows["augmented"]["f1"] == rows["baseline"]["f1"] and "no generator" in rows["augmented"]["error"]
    with pytest.raises(RuntimeError):
        detector.augmentation_effect(products, FEATURES, "code", n_trees=2, on_synth_error="raise")


def test_discriminators(spark, products):
    real = products.select(*NUTRIENTS)
    shifted = real.withColumn("sugars_100g", F.col("sugars_100g") + 30)
    both = with_row_id(drift.label_sides(real, shifted.limit(700)))
    predictions, importance = detector.discriminator_predictions(both, [*NUTRIENTS, "absent"], ROW_ID, n_trees=3)
    results = detector.discriminator_results(predictions)
    found = {r["model"]: r["auroc"] for r in results["auroc"].collect()}
    assert set(found) == {"Logistic Regression", "Random Forest", "Gradient Boosting"}
    assert min(found.values()) > 0.95 and predictions.filter("model = 'Random Forest'").count() == 420
    assert results["verdict"].first()["verdict"] == "distinguishable"
    assert results["confusion"].agg(F.sum("n")).first()[0] == 420 and results["report"].count() == 5
    assert importance.first()["feature"] == "sugars_100g" and results["roc"].filter("fpr = 0").count() >= 3


def test_stream_scores_and_rejects(spark, products, tmp_path):
    model = detector.train_detector(products, NUTRIENTS, n_trees=TREES)
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "one.txt").write_text("450 12 30 5 0.5\n1,000 2 3 4 5\n1 2 3 4\na 2\n\nq\n")

    def run():
        query = score_line_stream(
            spark, str(folder), model, str(tmp_path / "good"), str(tmp_path / "bad"), str(tmp_path / "checkpoint")
        )
        query.awaitTermination(120)
        assert query.exception() is None
        good, bad = spark.read.parquet(str(tmp_path / "good")), spark.read.parquet(str(tmp_path / "bad"))
        return sorted(r["energy_100g"] for r in good.collect()), sorted(r["status"] for r in bad.collect())

    assert run() == ([450.0, 1000.0], ["count_error", "count_error", "number_error"])
    (folder / "two.txt").write_text("7 1 1 1 1\n")
    assert run()[0] == [7.0, 450.0, 1000.0]


@pytest.mark.parametrize("lost", ["before", "between outputs", "before commit", "after commit"])
def test_lines_count_once_whenever_the_stream_is_lost(spark, products, tmp_path, lost):
    model = detector.train_detector(products, NUTRIENTS, n_trees=TREES)
    lines = [f"{i} 1 2 3 4" if i % 3 else f"{i} x" for i in range(60)]
    spark.createDataFrame([(v,) for v in lines], "value string").repartition(4).write.text(str(tmp_path / "lines"))
    good, bad, checkpoint = (str(tmp_path / n) for n in ("good", "bad", "checkpoint"))

    def losing(write):
        def run(batch, batch_id):
            if batch_id == 1 and lost == "between outputs":
                batch.write.mode("overwrite").parquet(f"{good}/batch=1")  # rows that never become part of the result
            if batch_id == 1 and lost == "before commit":
                write(batch, batch_id)
                remove_folder(spark, f"{checkpoint}/sink/batch=1")
            if batch_id == 1 and lost == "after commit":
                write(batch, batch_id)
            if batch_id == 1:
                raise InterruptedError
            write(batch, batch_id)

        return run

    def start(**more):
        score_line_stream(spark, str(tmp_path / "lines"), model, good, bad, checkpoint, max_files_per_trigger=1, **more).awaitTermination(120)

    def committed(folder):
        return sorted(r["value"] for r in committed_rows(spark, folder, checkpoint).collect())

    with pytest.raises(StreamingQueryException):
        start(sink=losing)
    part = committed(good) + committed(bad)
    assert len(part) < 60 and set(part) <= set(lines)  # whole batches only
    assert committed_rows(spark, good, checkpoint).select("batch").distinct().count() == (2 if lost == "after commit" else 1)
    start()
    start()  # nothing is left to do
    assert committed(good) + committed(bad) == sorted(v for v in lines if "x" not in v) + sorted(v for v in lines if "x" in v)
    rows = {(r.output, r.batch): r.n_rows for r in commits(spark, checkpoint).collect()}
    assert len(rows) == 8 and sum(rows.values()) == 60


def test_nothing_committed(spark, tmp_path):
    assert commits(spark, str(tmp_path / "checkpoint")).count() == 0
    with pytest.raises(FileNotFoundError):
        committed_rows(spark, str(tmp_path / "good"), str(tmp_path / "checkpoint"))


def test_rank_correlations_with_ties(spark):
    rng = np.random.default_rng(5)
    n = 900
    a = np.where(rng.random(n) < 0.6, 0.0, rng.gamma(2, 3, n))  # most rows have one value
    b = np.round(a + rng.normal(0, 2, n))
    c = np.full(n, 7.0)
    group = rng.integers(0, 3, n)
    rows = [(int(g), float(x), float(y), float(z), "x") for g, x, y, z in zip(group, a, b, c)]
    rows += [(0, None, 1.0, 1.0, "x"), (1, float("nan"), 2.0, 2.0, "x"), rows[0], rows[0], (None, 1.0, 2.0, 7.0, "x"), (None, 2.0, 1.0, 7.0, "x")]
    df = spark.createDataFrame(rows, "g int, a double, b double, c double, n_rows string").repartition(4)
    found = {(r.g, r.var_a, r.var_b): (r.n_rows, r.r) for r in correlation.rank_correlations(df, ["a", "b", "c"], ["g"]).collect()}

    def ranks(values):
        order = np.sort(values)
        return (np.searchsorted(order, values, "left") + np.searchsorted(order, values, "right") + 1) / 2

    for g in range(3):
        taken = [r[1:4] for r in rows if r[0] == g and r[1] is not None and not np.isnan(r[1])]
        x, y, _ = np.array(taken).T
        assert found[g, "a", "b"] == (len(taken), pytest.approx(np.corrcoef(ranks(x), ranks(y))[0, 1]))
        assert found[g, "a", "c"] == (len(taken), None)
    whole = correlation.rank_correlations(df, ["a", "b"]).collect()
    assert len(whole) == 1 and whole[0].n_rows == sum(r[1] is not None and not np.isnan(r[1]) for r in rows)
    assert correlation.rank_correlations(df.limit(0), ["a", "b"], ["g"]).count() == 0


def test_generated_rows_keep_rank_correlations(spark, products):
    model = synthesis.fit_synthesizer(products, NUTRIENTS)
    made = synthesis.generate(spark, model, 3000)
    sides = drift.label_sides(products.select(*NUTRIENTS), made.select(*NUTRIENTS))
    found = {(r.is_synthetic, r.var_a, r.var_b): r.r for r in correlation.rank_correlations(sides, NUTRIENTS, ["is_synthetic"]).collect()}
    for (side, a, b), r in found.items():
        if side == 0 and r is not None:
            assert abs(found[1, a, b] - r) < 0.12, (a, b, r, found[1, a, b])


def test_a_generating_job_that_fails(spark, products):
    from labelgap import plans

    merged = products.withColumns({"language_case": F.when(F.col("target") == 1, "Gap (내수용)").otherwise("English Only"), "category_top": F.lit("Snacks")}).drop("target")

    def failing(spark, model, n, seed):
        broken = F.udf(lambda v: [][1] if v is not None else v, "double")
        return synthesis.generate(spark, model, n, seed).withColumn("fat_100g", broken("fat_100g"))

    config = plans.Config(n_trees=3, n_synthetic=50)
    result = plans.synthesis_and_detector(merged, config=config, generate=failing)
    assert result["synthetic"] is None and "IndexError" in result["error"] and result["augmented"].filter("is_synthetic = 1").count() == 0
    assert result["augmented"].count() == products.count() and result["quality"].first()["accuracy"] > 0.5
    with pytest.raises(Exception, match="IndexError"):
        plans.synthesis_and_detector(merged, config=config, on_synth_error="raise", generate=failing)
    assert plans.synthesis_and_detector(merged, config=config)["error"] is None
