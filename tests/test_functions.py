"""Edge rows of the column expressions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelgap.functions import labels, language, nutrients, scoring, stats, tags, text
from labelgap.fixed_values import STRICT_MARKET_PATTERN
from labelgap.streaming.scoring import parse_lines


def one(spark, schema, values, *columns):
    """Apply column expressions to single-column rows and return the rows in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {schema}")
    rows = df.select("i", *[c.alias(f"c{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    found = [tuple(r)[1:] for r in rows]
    return [f[0] for f in found] if len(columns) == 1 else found


def v():
    return F.col("v")


def test_market_patterns(spark):
    values = [["en:south-korea"], ["en:ukraine"], ["en:north-korea"], ["EN:KR"], None, []]
    broad = one(spark, "array<string>", values, tags.tag_matches(v(), "korea|kr"))
    strict = one(spark, "array<string>", values, tags.tag_matches(v(), STRICT_MARKET_PATTERN))
    assert broad == [True, True, True, True, False, False]
    assert strict == [True, False, False, True, False, False]


def test_nutrients(spark):
    nan = float("nan")
    schema = "array<struct<name:string,`100g`:float,unit:string>>"
    values = [
        [("fat", 1.0, "g"), ("fat", 2.0, "g")],
        [("energy", 418.4, "g")],
        [("energy-kcal", nan, "g"), ("energy", 418.4, "g")],
        None,
        [("fat", None, "g")],
        [None, ("fat", 3.0, "g")],
        [("", 5.0, "g"), (None, 5.0, "g")],
        [("energy-kcal", 10.0, "g"), ("energy", 418.4, "g"), ("salt", 0.5, "g")],
    ]
    wanted = nutrients.nutrient_columns(nutrients.usable_entries(v()))
    found = one(spark, schema, values, wanted["energy_100g"], wanted["fat_100g"], wanted["salt_100g"])
    assert [f[1] for f in found] == [2, 0, 0, 0, 0, 3, 0, 0]
    assert found[1][0] == pytest.approx(99.99999854)
    assert [f[0] for f in found[2:]] == [0, 0, 0, 0, 0, 10]
    assert found[-1][2] == 0.5


def test_tags_to_text(spark):
    assert one(spark, "array<string>", [[], None, ["a", None, "b"]], tags.tags_to_text(v())) == ["missing", "missing", "a,None,b"]


@pytest.mark.parametrize(
    "value, expected",
    [
        (None, "missing"), ("", "missing"), ("missing", "missing"), ("nan", "missing"), ("en:snacks", "snacks"),
        ("en:snacks,en:chips", "snacks"), ("en:chicken-soups", "chicksoups"), (" , ,en:teas", "teas"),
        ("fr:soupes", "fr:soupes"), ("en:", "missing"), ("123", "missing"), ("None", "missing"), ("True", "missing"),
        ("['en:a']", "a"), ('["en:b"]', "b"), ("[]", "missing"), (",", "missing"), ("007", "007"), ("'x'", "missing"),
        ("1.5", "missing"), ("snack bars", "snack bars"),
    ],
)
def test_top_category_text(spark, value, expected):
    assert one(spark, "string", [value], tags.top_category_text(v())) == [expected]


def test_top_category_without_compat(spark):
    found = one(spark, "string", ["en:chicken-soups", "x-en:y"], tags.top_category_text(v(), compat=False))
    assert found == ["chicken-soups", "x-en:y"]


def test_top_category_array(spark):
    assert one(spark, "array<string>", [None, [], ["en:teas", "b"]], tags.top_category(v())) == ["missing", "missing", "teas"]


GROUPS = [
    (None, "Unknown"), (["en:"], "Unknown"), (["en:salty-snacks"], "Snacks"),
    (["en:plant-based-foods-and-beverages"], "Beverages"), (["en:chicken-ramen"], "Instant Noodles"),
    (["en:meats-and-their-products"], "Meat Products"), (["en:frozen-foods"], "Frozfoods"),
    (["fr:soupes-froides"], "Fr:Soupes-Froides"), (["children's cereals"], "Children'S Cereals"),
    (["ko:과자abc"], "Ko:과자Abc"), ([], "Unknown"),
]


def test_category_group(spark):
    found = one(spark, "array<string>", [v for v, _ in GROUPS], tags.category_group(v()))
    assert found == [e for _, e in GROUPS]


def test_category_group_text(spark):
    values = ["missing", "nan", None, "", "en:sauces,en:x", " , en:x"]
    assert one(spark, "string", values, tags.category_group_text(v())) == ["Unknown"] * 4 + ["Sauces", "Unknown"]


def test_flags(spark):
    def flags_of(value, build):
        columns = build(v())
        found = one(spark, "string", [value], *columns.values())[0]
        return {name for name, flag in zip(columns, found) if flag}

    assert flags_of("en:coconut", tags.allergen_flags) == {"has_nuts"}
    assert flags_of("en:shellfish", tags.allergen_flags) == {"has_fish", "has_shellfish"}
    assert flags_of("en:crustaceans", tags.allergen_flags) == {"has_shellfish"}
    assert flags_of("en:veggie-patty", tags.allergen_flags) == {"has_eggs"}
    assert flags_of("EN:WHEAT", tags.allergen_flags) == {"has_gluten"}
    assert flags_of("en:probiotic", tags.label_flags) == {"is_bio"}
    assert flags_of("en:fair_trade", tags.label_flags) == {"is_fair_trade"}
    assert flags_of("missing", tags.allergen_flags) == set()
    assert flags_of(None, tags.label_flags) == set()


def test_presence_in_array(spark):
    values = [
        [("ko", "x"), (None, "y"), ("en", "z")],
        [("fr", "가"), ("EN", "q")],
        [None, ("en", "q")],
        [],
        None,
        [("KR", None)],
    ]
    found = one(spark, "array<struct<lang:string,text:string>>", values, *language.presence_in_array(v()))
    assert found == [(True, False), (True, True), (False, True), (False, False), (False, False), (True, False)]
    nonstop = one(spark, "array<struct<lang:string,text:string>>", values[:1], *language.presence_in_array(v(), stop_at_unnamed=False))
    assert nonstop == [(True, True)]


def test_presence_in_struct_and_text(spark):
    found = one(spark, "struct<lang:string,text:string>", [("Korean", "x"), ("fr", "가"), (None, "x"), None], *language.presence_in_struct(v()))
    assert found == [(True, False), (False, False), (False, False), (False, False)]
    assert one(spark, "string", ["가a", "é", "", None], *language.presence_in_text(v())) == [
        (True, True), (False, False), (False, False), (False, False),
    ]


def test_cases_and_target(spark):
    df = spark.createDataFrame([(True, False), (True, True), (False, False), (False, True)], "k boolean, e boolean")
    case = language.language_case(F.col("k"), F.col("e"))
    found = df.select(case.alias("c"), language.risk_target(case).alias("t")).collect()
    assert [tuple(r) for r in found] == [
        ("Gap (내수용)", 1), ("Compliant (수출/글로벌용)", 0), ("No Data (데이터 부족)", 0), ("English Only", 0),
    ]
    assert one(spark, "string", [None], language.risk_target(v())) == [0]


def test_language_columns():
    assert language.language_columns(["ingredients_text", "ingredients_ko", "x"]) == {
        "ko": ["ingredients_ko"], "en": ["ingredients_text", "ingredients_ko"],
    }


def test_key_and_numbers(spark):
    assert one(spark, "string", [" a\t\n", None, "b"], text.normalise_key(v())) == ["a", "None", "b"]
    assert one(spark, "string", [None], text.normalise_key(v(), None)) == [None]
    values = [12.0, 1e-5, 12345678.0, 0.0005, 1.5e16, 0.1, None, float("nan"), 123456789.125, -3e-7, 1e22]
    expected = ["nan" if v is None or math.isnan(v) else repr(v) for v in values]
    assert one(spark, "double", values, text.float_text(v())) == expected
    assert one(spark, "double", [2.5, 3.5, 500.0, None], text.whole_number_text(v())) == ["2", "4", "500", "nan"]


def test_score_lines(spark):
    lines = ["450 12 30 5 0.5", "1,000 2 3 4 5", "1 2 3 4", "a 2", "", "q", "Q", "1 2 3 4 5d", "1_0 .5 5. +1e2 -inf", "nan 1 1 1 1"]
    rows = parse_lines(spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, value string")).orderBy("i").collect()
    found = [(r["status"], r["energy_100g"], r["sodium_100g"]) for r in rows]
    assert [f[0] for f in found] == [
        "ok", "ok", "count_error", "number_error", "count_error", "quit", "quit", "number_error", "ok", "ok",
    ]
    assert found[0][1:] == (450.0, 0.5)
    assert found[1][1] == 1000.0
    assert found[2][1] is None
    assert found[8][1] == 10.0 and found[8][2] == float("-inf")
    assert math.isnan(found[9][1])


def test_risk_bands(spark):
    assert one(spark, "double", [70.0, 69.99, 40.0, 39.99], scoring.risk_band(v())) == ["high", "caution", "caution", "safe"]


def test_product_names(spark):
    printed = ["[{'lang': 'main', 'text': 'X'}]", "plain", None, '[{"lang": "a", "text": "it\'s"}]', "[no entry]"]
    assert one(spark, "string", printed, labels.product_name_text(v())) == ["X", "plain", "None", "it's", "[no entry]"]
    typed = [[("main", "it's"), ("en", "b")], None, []]
    assert one(spark, "array<struct<lang:string,text:string>>", typed, labels.product_name(v())) == ["it's", "None", "None"]
    unknown = one(spark, "array<struct<lang:string,text:string>>", [None], labels.product_name(v(), compat=False))
    assert unknown == ["Unknown Snack"]


def test_allergen_text(spark):
    values = ["en:milk,en:tree-nuts", "missing", None, ""]
    assert one(spark, "string", values, labels.allergen_text(v())) == ["milk, tree nuts"] + ["Unknown (Infer from name)"] * 3


def test_json_rescue_and_lists(spark):
    texts = ['```json\n{"a": {"b": 1}}\n``` trailing', "  no braces ", '} {', '{"a": 1']
    assert one(spark, "string", texts, labels.json_rescue(v())) == ['{"a": {"b": 1}}', "no braces", "} {", '{"a": 1']
    lists = [["a", "b"], [], None, ["it's"], ['say "it\'s"'], [None, "a\\b"]]
    expected = [str(v) if v is not None else None for v in lists]
    assert one(spark, "array<string>", lists, labels.list_to_text(v())) == expected


def test_card_fields(spark):
    assert one(spark, "string", ["102 kcal", "5 Calories", None], labels.card_calories(v())) == ["102", "5", "N/A"]
    assert one(spark, "string", ["x" * 36, "x" * 35, None], labels.card_name(v())) == ["x" * 32 + "...", "x" * 35, "Unknown Product"]


# Published p-values of a comparison of 2,493 with 3,000 rows.
@pytest.mark.parametrize(
    "d, p",
    [
        (0.0856470116325712, 3.8383977861880264e-09),
        (0.2147581227436823, 1.804032453568551e-55),
        (0.2669482551143201, 8.036411650981886e-86),
        (0.18000361010830324, 5.1271243352383356e-39),
        (0.1533906939430405, 2.0500308381691903e-28),
    ],
)
def test_ks_pvalue_exact(d, p):
    assert stats.ks_two_sample_p(d, 2493, 3000) == pytest.approx(p, rel=1e-9)


def test_ks_pvalue_methods(spark):
    one = spark.createDataFrame([(0.03, 4000, 5000), (0.0, 10, 10)], "d double, n long, m long")
    exact, limit = (
        [r[0] for r in one.select(stats.ks_pvalue(F.col("d"), F.col("n"), F.col("m"), method)).collect()] for method in ("exact", "limit")
    )
    assert limit == pytest.approx(exact, rel=0.02) and limit[1] == 1
    with pytest.raises(ValueError):
        stats.ks_pvalue(F.col("d"), F.col("n"), F.col("m"), "other")


def test_ks_pvalue_small_and_large():
    # By hand: two samples of one row each always have D = 1; of two and one, D is 1 in two of three orders.
    assert stats.ks_two_sample_p(1.0, 1, 1) == pytest.approx(1.0)
    assert stats.ks_two_sample_p(1.0, 2, 1) == pytest.approx(2 / 3)
    assert stats.ks_two_sample_p(0.5, 2, 1) == pytest.approx(1.0)
    assert math.isnan(stats.ks_two_sample_p(0.1, 0, 5))


def test_normal_cdf_and_uniform(spark):
    found = one(spark, "double", [0.0, 1.959963985, -1.959963985, 8.0], stats.normal_cdf(v()))
    assert found == pytest.approx([0.5, 0.975, 0.025, 1.0], abs=2e-7)
    rows = spark.range(20000).select(
        stats.uniform(F.col("id"), 1, 0).alias("u"), stats.standard_normal(F.col("id"), 1, 0).alias("z")
    )
    mean, low, high, z, s = rows.agg(F.avg("u"), F.min("u"), F.max("u"), F.avg("z"), F.stddev("z")).first()
    assert abs(mean - 0.5) < 0.01 and 0 < low < high < 1 and abs(z) < 0.03 and abs(s - 1) < 0.03


def test_task_functions_need_no_package(tmp_path):
    """Executors without the package can run what a job sends them."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(stats.ks_two_sample_p))
    code = "import pickle; print(pickle.load(open('f.pkl', 'rb'))(1.0, 2, 1))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert float(done.stdout) == pytest.approx(2 / 3), done.stderr


def _ks_by_all_cells(d, n, m):
    cells = np.zeros((n + 1, m + 1))
    for i in range(n + 1):
        for j in range(m + 1):
            if abs(i / n - j / m) >= d - 1e-9:
                cells[i, j] = 1.0
            elif i + j:
                cells[i, j] = ((cells[i - 1, j] * i if i else 0) + (cells[i, j - 1] * j if j else 0)) / (i + j)
    return cells[n, m]


def test_exact_pvalue_in_a_band():
    rng = np.random.default_rng(3)
    for _ in range(150):
        n, m = rng.integers(1, 25, 2)
        steps = [abs(i / n - j / m) for i in range(n + 1) for j in range(m + 1)]
        for d in (float(rng.choice(steps)), float(rng.random()), 0.0, 1.0):
            assert stats.ks_two_sample_p(d, int(n), int(m)) == pytest.approx(_ks_by_all_cells(d, n, m), abs=1e-12), (d, n, m)


def test_exact_pvalue_of_large_samples():
    # Where the limit holds, both agree; the whole lattice would have 2.5e9 cells.
    n = m = 50_000
    for z in (0.6, 1.0, 1.6):
        d = round(z * (2 / n) ** 0.5 * n) / n
        root = (n / 2) ** 0.5
        corrected = root * d + 1 / (6 * root) + (root * d - 1) / (4 * root * root)
        limit = 2 * sum((-1) ** (k - 1) * np.exp(-2 * (k * corrected) ** 2) for k in range(1, 50))
        assert stats.ks_two_sample_p(d, n, m) == pytest.approx(limit, rel=0.01)
