"""Operators against brute force and known values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelgap.operators import (
    cleaning,
    correlation,
    drift,
    evaluation,
    features,
    frequency,
    joins,
    population,
    prefix,
    sampling,
)


# -- population and cleaning ---------------------------------------------------


def test_project_reports_missing(spark):
    df, missing = population.project_available(spark.createDataFrame([(1, 2)], "code int, x int"), ["code", "brands"])
    assert df.columns == ["code"] and missing == ["brands"]


def test_filter_on_tag_text(spark):
    df = spark.createDataFrame([("en:KR,en:x",), ("fr",), (None,)], "countries_tags string")
    assert [r[0] for r in population.filter_by_tag(df).collect()] == ["en:KR,en:x"]


def test_null_profile_skips_full_columns(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, "a", float("nan"))], "a int, b string, c double")
    assert {tuple(r) for r in population.null_profile(df).collect()} == {("b", 50.0), ("c", 50.0)}


def test_selectivity_of_empty_frame(spark):
    row = population.filter_selectivity(spark.createDataFrame([], "countries_tags array<string>")).first()
    assert tuple(row) == (0, 0, None)


def test_absent_columns_get_defaults(spark):
    df = spark.createDataFrame([("1",)], "code string")
    row = cleaning.fill_grade(cleaning.add_allergen_flags(cleaning.add_top_category(df))).first()
    assert row["category_top"] == "missing" and row["has_milk"] is False and row["nutriscore_grade"] == "missing"


def test_fill_and_text(spark):
    df = spark.createDataFrame([(float("nan"), None, None, 5)], "fat_100g double, labels_tags array<string>, brands_tags string, countries_tags int")
    row = cleaning.tags_as_text(cleaning.fill_categorical(cleaning.fill_numeric(df))).first()
    assert tuple(row) == (0.0, "missing", "missing", "5")


def test_impute_falls_back_to_the_column_mean(spark):
    rows = [("a", 1.0), ("a", None), ("b", None), (None, 5.0), (None, None)]
    found = cleaning.impute_group_mean(spark.createDataFrame(rows, "g string, x double"), ["x"], "g").collect()
    assert sorted((r["g"] or "", r["x"]) for r in found) == [("", 5.0), ("", 5.0), ("a", 1.0), ("a", 1.0), ("b", 3.0)]


def test_sparse_columns_go(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "a int, b string")
    assert cleaning.drop_sparse_columns(df, 0.6).columns == ["a"]
    assert cleaning.drop_sparse_columns(df, 0.7).columns == ["a", "b"]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (500.0,), (9000.0,)], "energy_100g double")
    assert [r[0] for r in cleaning.clip_range(df).collect()] == [None, 0.0, 500.0, 900.0]


# -- joins -------------------------------------------------------------------------


def _sides(spark):
    left = spark.createDataFrame([(None, 1), ("k", 2), (" k", 3), ("x", 4)], "code string, a int")
    right = spark.createDataFrame([(None, 9), ("k", 8), ("k\t", 7)], "code string, b int")
    return left, right


def test_null_keys_match_as_text(spark):
    left, right = _sides(spark)
    found = {tuple(r) for r in joins.left_join(left, right, null_keys="match").collect()}
    assert found == {("None", 1, 9), ("k", 2, 8), ("k", 2, 7), ("k", 3, 8), ("k", 3, 7), ("x", 4, None)}


def test_null_keys_never_match(spark):
    left, right = _sides(spark)
    found = {tuple(r) for r in joins.left_join(left, right).collect()}
    assert found == {(None, 1, None), ("k", 2, 8), ("k", 2, 7), ("k", 3, 8), ("k", 3, 7), ("x", 4, None)}
    with pytest.raises(ValueError):
        joins.left_join(left, right, null_keys="maybe")


def test_overlapping_columns_come_from_the_right(spark):
    left = spark.createDataFrame([("1", 5, 6)], "code string, x int, y int")
    right = spark.createDataFrame([("1", 50, 60)], "code string, x int, y int")
    assert tuple(joins.left_join(left, right, "code", ["x", "absent"]).select("code", "x", "y").first()) == ("1", 50, 6)


def _skewed(spark):
    keys = ["hot"] * 300 + [f"k{i % 40}" for i in range(200)] + [None] * 90
    left = spark.createDataFrame([(k, i % 7) for i, k in enumerate(keys)], "code string, a int")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4), ("other", 5)], "code string, b int")
    return left, right


def test_hot_keys_do_not_change_the_result(spark, monkeypatch):
    left, right = _skewed(spark)
    plain = sorted(map(repr, joins.left_join(left, right).collect()))
    assert [tuple(r) for r in joins.hot_keys(left, "code", 50).collect()] == [("hot", 6)]
    split = sorted(map(repr, joins.left_join(left, right, hot_key_rows=50).collect()))
    assert split == plain and len(plain) == 300 * 2 + 200 + 90
    many = sorted(map(repr, joins.left_join(left, right, hot_key_rows=2).collect()))  # more hot keys than any list would hold
    assert many == plain


def test_copies_of_a_hot_key_are_spread(spark):
    left = spark.createDataFrame([("hot", 1)] * 400, "code string, a int").coalesce(1)
    hot = joins.hot_keys(left, "code", 100)
    salted = joins._salted_left_join(left, spark.createDataFrame([("hot", 2)], "code string, b int"), "code", hot)
    assert salted.count() == 400 and hot.first()["parts"] == 4


def test_nulls_cost_no_pairs(spark):
    left = spark.createDataFrame([(None, i) for i in range(300)] + [("1", 1)], "code string, a int")
    right = spark.createDataFrame([(None, i % 2) for i in range(200)] + [("1", 5)], "code string, b int")
    assert joins.left_join(left, right).count() == 301
    assert joins.left_join(left, right, null_keys="match").count() == 300 * 2 + 1


def test_broadcast_only_if_measured_small(spark):
    df = spark.range(100).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert joins.fits_broadcast(df)
    assert not joins.fits_broadcast(df, max_rows=50)
    assert not joins.fits_broadcast(df, max_bytes=10_000)


def test_enrich_only_if_absent(spark):
    df = spark.createDataFrame([("1", "kept")], "code string, language_case string")
    assert joins.enrich_if_absent(df, spark.createDataFrame([], "code string")).first()[1] == "kept"


# -- frequencies -----------------------------------------------------------------------


def test_frequency_counts_nulls_in_the_total_only(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    assert [tuple(r) for r in frequency.frequency_table(df, "x").collect()] == [("a", 2, 50.0), ("b", 1, 25.0)]
    assert frequency.frequency_table(df, "x", 1).count() == 1


def test_case_counts_add_up(spark):
    df = spark.createDataFrame([("a", "English Only"), ("a", "Gap (내수용)"), ("b", "English Only")], "category_top string, language_case string")
    table = frequency.case_crosstab(df)
    assert table.agg(F.sum("total")).first()[0] == 3
    ratio = {r["category_top"]: r["gap_pct"] for r in frequency.gap_ratio(table).collect()}
    assert ratio == {"a": 50.0, "b": 0.0}
    assert frequency.gap_ratio(table.drop("Gap (내수용)")).first()["gap_pct"] == 0


# -- running totals ---------------------------------------------------------------------


@pytest.mark.parametrize("buckets", [1, 2, 5, 16, 100])
def test_running_totals_by_group(spark, buckets):
    rng = random.Random(buckets)
    values = {g: sorted({round(rng.choice([rng.gauss(0, 1), rng.gauss(50, 0.1)]), 3) for _ in range(n)}) for g, n in (("a", 200), ("b", 3))}
    rows = [(g, x, rng.randrange(9)) for g, xs in values.items() for x in xs]
    df = spark.createDataFrame(rows, "g string, x double, n long").repartition(5)
    found = {(r["g"], r["x"]): r for r in prefix.running_totals(df, "x", ["n"], ["g"], ["x", "n"], buckets).collect()}
    assert len(found) == len(rows)
    for g in values:
        ordered = sorted((r for r in rows if r[0] == g), key=lambda r: r[1])
        running = 0
        for i, (_, x, n) in enumerate(ordered):
            running += n
            row = found[g, x]
            after = ordered[i + 1] if i + 1 < len(ordered) else (None, None, None)
            assert (row["cum_n"], row["total_n"]) == (running, sum(r[2] for r in ordered))
            assert (row["next_x"], row["next_n"]) == (after[1], after[2])


@pytest.mark.parametrize("buckets", [1, 4, 30])
def test_running_totals_of_text(spark, buckets):
    words = sorted({"".join(random.Random(i).choices("ab가é", k=i % 90 + 1)) for i in range(500)})
    df = spark.createDataFrame([(w, 1) for w in words], "w string, one int").repartition(6)
    found = prefix.running_totals(df, "w", ["one"], buckets=buckets).orderBy("cum_one").collect()
    assert [(r["w"], r["cum_one"]) for r in found] == [(w, i) for i, w in enumerate(words, 1)]


def test_running_totals_of_text_by_group(spark):
    """Values that share a long beginning are spread over ranges, in every group."""
    words = {g: [f"{'https://example.org/a/long/way/to/the/same/folder/of/many/pages/':s}{g}{i:05d}" for i in range(3000)] for g in "ab"}
    df = spark.createDataFrame([(g, w, 1) for g, ws in words.items() for w in ws], "g string, w string, one int")
    cuts = {r["g"]: r["_cuts"] for r in prefix._text_cuts(df, "w", ["g"], 8).collect()}
    assert all(len(set(c)) >= 7 for c in cuts.values())
    found = {(r["g"], r["w"]): r["cum_one"] for r in prefix.running_totals(df, "w", ["one"], ["g"], buckets=8).collect()}
    assert found == {(g, w): i for g, ws in words.items() for i, w in enumerate(ws, 1)}


def test_running_totals_without_groups_or_rows(spark):
    df = spark.createDataFrame([(2.0, 1), (1.0, 4)], "x double, n long")
    assert sorted((r["x"], r["cum_n"]) for r in prefix.running_totals(df, "x", ["n"]).collect()) == [(1.0, 4), (2.0, 5)]
    assert prefix.running_totals(df.limit(0), "x", ["n"]).count() == 0


# -- splits and samples -----------------------------------------------------------------------


@pytest.mark.parametrize("n, size", [(1, 0.2), (7, 0.2), (1000, 0.2), (1001, 0.3), (5000, 0.5), (0, 0.2)])
def test_split_sizes_are_exact_and_disjoint(spark, n, size):
    df = spark.range(n)
    train, test = sampling.split_train_test(df, "id", size)
    a, b = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
    assert len(b) == math.ceil(size * n) and not a & b and a | b == set(range(n))


def test_split_does_not_depend_on_partitions(spark):
    one = {r[0] for r in sampling.split_train_test(spark.range(0, 500, 1, 1), "id")[1].collect()}
    many = {r[0] for r in sampling.split_train_test(spark.range(0, 500, 1, 9).repartition(7), "id")[1].collect()}
    assert one == many
    other = {r[0] for r in sampling.split_train_test(spark.range(500), "id", seed=7)[1].collect()}
    assert one != other


def test_split_of_copies_is_exact(spark):
    # One key holds most rows, and these are exact copies of each other.
    df = spark.createDataFrame([("same", 1)] * 700 + [(str(i), i) for i in range(300)], "code string, x int")
    for stratify in (None, "x"):
        small = df if stratify is None else df.withColumn("x", F.col("x") % 2)
        train, test = sampling.split_train_test(small, "code", 0.2, stratify=stratify)
        assert (train.count(), test.count()) == (800, 200)
        assert train.columns == ["code", "x"]


def test_stratified_split_keeps_shares(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") % 25 == 0).cast("int"))
    train, test = sampling.split_train_test(df, "id", 0.2, stratify="y")
    assert {tuple(r) for r in test.groupBy("y").count().collect()} == {(0, 192), (1, 8)}
    assert train.count() == 800


def test_class_allocation():
    assert sampling.class_allocation({"a": 1, "b": 1, "c": 1}, 2) == {"a": 1, "b": 1, "c": 0}
    assert sampling.class_allocation({0: 39, 1: 2454}, 3000) == {0: 47, 1: 2953}


def test_many_classes(spark):
    df = spark.range(6000).withColumn("y", F.when(F.col("id") % 501 < 500, (F.col("id") % 501).cast("string")))
    sizes = {r["g"]: r["n"] for r in sampling.group_sizes(df, "y").collect()}
    assert len(sizes) == 501 and None in sizes
    drawn = {r["g"]: r["drawn"] for r in sampling.allocated(sampling.group_sizes(df, "y"), 4801).collect()}
    assert sum(drawn.values()) == 4801 and all(abs(drawn[g] - 4801 * n / 6000) < 1 for g, n in sizes.items())
    train, test = sampling.split_train_test(df, "id", 0.2, stratify="y")
    assert (train.count(), test.count()) == (4800, 1200)
    assert sampling.balanced_sample(df, "y", "id").groupBy("y").count().select("count").distinct().collect() == [(11,)]


def test_split_reads_its_rows_three_times(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(frames):
        for frame in frames:
            reads.add(len(frame))
            yield frame

    for classes in (None, "y"):
        before = reads.value
        df = spark.range(3000).withColumn("y", F.col("id") % 7).mapInPandas(counted, "id long, y long")
        assert sampling.mark_split(df, "id", stratify=classes).filter("is_test").count() == 600
        assert reads.value - before <= 4 * 3000  # sizes, prefixes, digests under the cut, and the result


def test_balanced_sample(spark):
    df = spark.range(900).withColumn("side", (F.col("id") >= 600).cast("int"))
    sample = sampling.balanced_sample(df, "side", "id")
    assert {tuple(r) for r in sample.groupBy("side").count().collect()} == {(0, 300), (1, 300)}
    assert sample.distinct().count() == 600


# -- scaling and encoding -----------------------------------------------------------------------


def test_standard_scaling(spark):
    train = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    test = spark.createDataFrame([(7.0, 7.0)], "a double, b double")
    scaler = features.fit_scaler(train, ["a", "b"])
    assert scaler.scale["a"] == pytest.approx(1.247219, abs=1e-6) and scaler.scale["b"] == 1.0
    assert [r["b"] for r in features.apply_scaler(train, scaler).collect()] == [0, 0, 0]
    assert features.apply_scaler(test, scaler).first()["b"] == 2.0
    back = features.unscale(features.apply_scaler(train, scaler), scaler)
    assert [r["a"] for r in back.collect()] == pytest.approx([1, 2, 4])


def test_minmax_scaling_and_errors(spark):
    train = spark.createDataFrame([(1.0, 3.0), (5.0, 3.0)], "a double, b double")
    scaler = features.fit_scaler(train, ["a", "b"], "minmax")
    assert [tuple(r) for r in features.apply_scaler(train, scaler).collect()] == [(0.0, 0.0), (1.0, 0.0)]
    assert features.apply_scaler(spark.createDataFrame([(9.0, 3.0)], "a double, b double"), scaler).first()["a"] == 2.0
    assert features.fit_scaler(train, []) is None and features.apply_scaler(train, None) is train
    with pytest.raises(ValueError):
        features.fit_scaler(train, ["a"], "robust")


def test_encoding_round_trip_and_saved_tables(spark, tmp_path):
    train = spark.createDataFrame([("b", 1.0), ("a", 2.0)], "c string, x_100g double")
    test = spark.createDataFrame([("가", 3.0), ("Z", 4.0), (None, 5.0)], "c string, x_100g double")
    train_codes, test_codes, encoder = features.encode_categorical(train, test, ["c", "absent"])
    assert {r["value"]: r["code"] for r in encoder.collect()} == {"Z": 0, "a": 1, "b": 2, "가": 3}
    assert sorted(r["c"] for r in train_codes.collect()) == [1, 2]
    assert sorted(map(repr, features.decode(test_codes, encoder, ["c"]).collect())) == sorted(map(repr, test.collect()))

    scaler = features.fit_scaler(train, ["x_100g"])
    roles = features.feature_roles(train.withColumns({"has_x": F.lit(True), "is_synthetic": F.lit(0)}))
    assert roles.continuous == ["x_100g"] and roles.boolean == ["has_x"]
    features.save_artifacts(features.artifact_tables(spark, scaler, encoder, roles), str(tmp_path / "artifacts"))
    assert features.load_scaler(spark, str(tmp_path / "artifacts")) == scaler
    assert features.load_encoder(spark, str(tmp_path / "artifacts")).count() == 4


# -- drift -----------------------------------------------------------------------------------------


def _two_sides(spark, a, b):
    rows = [(0, x) for x in a] + [(1, x) for x in b]
    return spark.createDataFrame([(s, None if x is None else float(x)) for s, x in rows], "is_synthetic int, x double")


def _share_upto(values, limit):
    return sum(v <= limit for v in values) / len(values)


def _brute(a, b):
    """Distances by plain counting: shares up to every value, and shares in ten equal ranges."""
    a, b = [float(v) for v in a], [float(v) for v in b]
    seen = sorted({*a, *b})
    gaps = [abs(_share_upto(a, v) - _share_upto(b, v)) for v in seen]
    area = sum(gap * (after - at) for gap, at, after in zip(gaps, seen, seen[1:]))
    low, step = seen[0], (seen[-1] - seen[0]) / 10
    index = 0.0
    for i in range(10):
        inside = [
            sum((low + i * step <= v or i == 0) and (v < low + (i + 1) * step or i == 9) for v in side) / len(side) or 0.0001 for side in (a, b)
        ]
        index += (inside[0] - inside[1]) * math.log(inside[0] / inside[1])
    return max(gaps), area, index


@pytest.mark.parametrize("seed", [1, 2])
def test_distances_match_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    a = np.where(rng.random(400) < 0.6, 0.0, rng.exponential(3, 400))
    b = np.round(rng.normal(2, 2, 300), 1)
    row = drift.statistical_report(_two_sides(spark, [*a, None, float("nan")], b), ["x", "absent"]).first()
    assert (row["ks_statistic"], row["wasserstein"], row["psi"]) == pytest.approx(_brute(a, b), abs=1e-9)
    assert row["original_std"] == pytest.approx(a.std(ddof=1)) and row["mean_diff"] == pytest.approx(abs(a.mean() - b.mean()))


def test_equal_constant_and_empty_sides(spark):
    same = drift.statistical_report(_two_sides(spark, [1, 2, 3], [1, 2, 3]), ["x"]).first()
    assert (same["ks_statistic"], same["wasserstein"], same["psi"], same["ks_pvalue"]) == (0, 0, 0, 1)
    flat = _two_sides(spark, [4, 4], [4])
    assert drift.psi(flat, ["x"]).first()["psi"] == 0 and drift.wasserstein(flat, ["x"]).first()["wasserstein"] == 0
    half = _two_sides(spark, [1, 2], [None])
    assert math.isnan(drift.psi(half, ["x"]).first()["psi"])
    assert drift.statistical_report(half, ["x"]).count() == 0
    with pytest.raises(ValueError):
        drift.side_values(flat, ["absent"])


def test_bands(spark):
    df = spark.createDataFrame([(0.09,), (0.1,), (0.25,), (0.26,)], "v double")
    assert [r[0] for r in df.select(drift.psi_band(F.col("v"))).collect()] == [
        "very stable", "slight drift", "slight drift", "large drift",
    ]
    verdicts = spark.createDataFrame([(0.549,), (0.55,), (0.65,), (0.8423,)], "v double").select(drift.auroc_verdict(F.col("v")))
    assert [r[0] for r in verdicts.collect()] == ["very similar", "fairly similar", "distinguishable", "distinguishable"]


def test_correlations(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 3))
    x[:, 1] += x[:, 0]
    rows = [(i % 2, *map(float, r)) for i, r in enumerate(x)] + [(0, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "is_synthetic int, a double, b double, c double").withColumn("k", F.lit(1.0))
    found = {(r["var_a"], r["var_b"]): r for r in correlation.correlation_differences(df, ["a", "b", "c"]).collect()}
    original, synthetic = np.corrcoef(x[::2].T), np.corrcoef(x[1::2].T)
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            assert found[a, b]["original"] == pytest.approx(original[i, j])
            assert found[a, b]["difference"] == pytest.approx(original[i, j] - synthetic[i, j], abs=1e-12)
    pairs = correlation.key_pair_comparison(df, ["a", "b"], [("b", "a"), ("a", "z")]).collect()
    assert [(r["variable_pair"], r["difference"] >= 0) for r in pairs] == [("b - a", True)]
    assert correlation.key_pair_comparison(df, ["a"], [("a", "z")]).count() == 0


# -- evaluation --------------------------------------------------------------------------------------


def _auc(labels, scores):
    pairs = [(p > n) + 0.5 * (p == n) for p, lp in zip(scores, labels) if lp for n, ln in zip(scores, labels) if not ln]
    return sum(pairs) / len(pairs)


def test_auroc_and_curve(spark):
    rng = random.Random(5)
    labels = [rng.randrange(2) for _ in range(300)]
    scores = [round(rng.random() * 0.7 + 0.3 * y, 1) for y in labels]
    df = spark.createDataFrame(list(zip(labels, scores)), "label int, score double")
    area = evaluation.auroc(df, buckets=5).first()["auroc"]
    assert area == pytest.approx(_auc(labels, scores))
    assert evaluation.auroc(df.withColumn("score", -F.col("score"))).first()["auroc"] == pytest.approx(1 - area)
    for drop in (True, False):
        points = evaluation.roc_points(df, drop_intermediate=drop).orderBy("fpr", "tpr").collect()
        curve = sum((b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(points, points[1:]))
        assert curve == pytest.approx(area)
        assert points[0]["threshold"] == float("inf") and points[-1]["tpr"] == points[-1]["fpr"] == 1.0


def test_curve_drops_points_on_a_line(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (0, 0.5)], "label int, score double")
    kept = sorted(r["threshold"] for r in evaluation.roc_points(df).collect())
    assert kept == [0.5, 0.7, 0.9, float("inf")]
    assert evaluation.roc_points(df, drop_intermediate=False).count() == 6


def test_one_class_has_no_auroc(spark):
    df = spark.createDataFrame([(1, 0.9)], "label int, score double")
    assert evaluation.auroc(df).first()["auroc"] is None


def test_zero_division(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    assert evaluation.f1_score(df).first()[0] == 0 and evaluation.accuracy(df).first()[0] == 1
    report = {r["class"]: r for r in evaluation.class_report(df).collect()}
    assert report["synthetic"]["precision"] == 0 and report["synthetic"]["support"] == 0
    assert report["original"]["f1"] == 1 and report["macro avg"]["f1"] == 0.5
    assert sorted(r["n"] for r in evaluation.confusion_matrix(df).collect()) == [0, 0, 0, 2]


def test_published_ranking(spark):
    rows = [("Random Forest", 0.9627), ("Gradient Boosting", 0.9602), ("Logistic Regression", 0.6042)]
    df = spark.createDataFrame(rows, "model string, auroc double")
    assert [r["model"] for r in evaluation.rank_models(df).collect()][0] == "Logistic Regression"
    assert evaluation.discriminator_verdict(df).first()["verdict"] == "distinguishable"


@pytest.mark.parametrize("sorted_digests", [1_000_000, 2])
def test_few_and_many_groups_are_cut_alike(spark, monkeypatch, sorted_digests):
    monkeypatch.setattr(sampling, "_SORTED_DIGESTS", sorted_digests)
    rows = [(i, None if i % 17 == 0 else f"g{i % 5}" if i % 3 else "big") for i in range(3000)] + [(1, "copies")] * 40
    df = spark.createDataFrame(rows, "k int, g string").repartition(3)

    def results():
        split = sampling.mark_split(df.filter("g IS NULL OR g <> 'copies'"), "k", 0.3, stratify="g")
        sample = sampling.balanced_sample(df.filter("g <> 'copies'"), "g", "k")
        copies = sampling.mark_split(df, "k", 0.25, stratify="g").groupBy("g").agg(F.count_if("is_test").alias("n")).collect()
        return sorted(map(str, split.collect())), sorted(map(str, sample.collect())), sorted((str(r.g), r.n) for r in copies)

    few = results()
    monkeypatch.setattr(sampling, "_FEW_COUNTS", 10)
    many = results()
    assert few == many and dict(few[2])["copies"] == 10
    assert sum("is_test=True" in r for r in few[0]) == 900
    assert sampling.mark_split(df.limit(0), "k", 0.3, stratify="g").count() == 0
