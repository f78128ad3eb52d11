"""Exact, repeatable splits and samples by key digest.

Rows are ordered by the md5 digest of their key and a seed. One pass counts
rows per class and digest prefix, which tells the prefix in which the first k
rows of a class end; a second pass stages the digests under that prefix, and
the cut is found among them. A split is then a comparison with a table of one
cut per class: no sort and no shuffle of the rows, any number of classes, and the
same result on every retry.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelgap.fixed_values import SEED
from labelgap.operators.joins import broadcast_if_small
from labelgap.session import written

_HEX_STEP = 3
_DIGEST_CHARS = 32
#: Digests of one group that are put in order by one task; where a prefix holds more, it is divided again.
_SORTED_DIGESTS = 1_000_000
#: Counts per group and prefix that the driver takes at once; with more, tables are written instead.
_FEW_COUNTS = 1 << 17
#: Classes whose shares are worked out on the driver.
_FEW_CLASSES = 10_000
ROW_ID = "_row"


class TiedKeys(ValueError):
    """Several rows with the same key meet at the cut."""


def with_row_id(df: DataFrame, output: str = ROW_ID) -> DataFrame:
    """Add a unique row number, written to the shared folder with the rows so that it never changes again."""
    return written(df.withColumn(output, F.monotonically_increasing_id()), "numbered")


def key_digest(keys: Sequence[str], seed: int = SEED) -> Column:
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def _as_list(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def group_sizes(df: DataFrame, group: str) -> DataFrame:
    """``g, n``: rows per group."""
    return df.groupBy(F.col(group).alias("g")).agg(F.count(F.lit(1)).alias("n"))


def _where_it_ends(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``g, prefix, remaining, n``: the prefix in which the first ``remaining`` rows of each group end, and what remains inside it.

    ``counts`` has at most 4,096 rows per group.
    """
    running = F.sum("n").over(Window.partitionBy("g").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumn("upto", running).join(wanted.withColumnRenamed("g", "_g"), F.col("g").eqNullSafe(F.col("_g")))
    ends = placed.filter((F.col("upto") - F.col("n") < F.col("remaining")) & (F.col("remaining") <= F.col("upto")))
    return ends.select("g", "prefix", (F.col("remaining") - F.col("upto") + F.col("n")).alias("remaining"), "n")


def _cut_in_order(rows: DataFrame) -> DataFrame:
    """``g, cut`` among the few digests under each group's prefix: that of the row at place ``remaining``."""
    found = written(_placed(rows, F.col("remaining")), "cuts")
    if not found.filter("tied").isEmpty():
        raise TiedKeys("the key is not unique: equal digests meet at the cut")
    return found.select("g", "cut")


def _placed(rows: DataFrame, remaining: Column) -> DataFrame:
    """The row at place ``remaining`` of each group by digest, and whether its digest goes on behind it."""
    order = Window.partitionBy("g").orderBy("d")
    placed = rows.withColumn("place", F.row_number().over(order)).withColumn("upto", F.count(F.lit(1)).over(order))
    return placed.filter(F.col("place") == remaining).select("g", F.col("d").alias("cut"), (F.col("upto") > remaining).alias("tied"))


def single_cut(df: DataFrame, digest: Column, wanted: int) -> str:
    """The last digest among the first ``wanted`` rows; the driver gets at most 4,096 counts a round."""
    if wanted <= 0:
        return ""
    rows, remaining = df.select(F.lit(None).cast("string").alias("g"), digest.alias("d")), wanted
    for length in range(_HEX_STEP, _DIGEST_CHARS + _HEX_STEP, _HEX_STEP):
        counts = rows.groupBy(F.substring("d", 1, length).alias("prefix")).agg(F.count(F.lit(1)).alias("n")).collect()
        for prefix, n in sorted((r["prefix"], r["n"]) for r in counts):
            if remaining <= n:
                break
            remaining -= n
        else:
            raise ValueError("there are fewer rows than wanted")
        if remaining == n:
            return prefix + "~"
        rows = rows.filter(F.col("d").startswith(prefix))
        if n <= _SORTED_DIGESTS or length >= _DIGEST_CHARS:
            break
        rows = written(rows, "digests")
    found = _placed(rows, F.lit(remaining)).first()
    if found["tied"]:
        raise TiedKeys("the key is not unique: equal digests meet at the cut")
    return found["cut"]


def digest_cuts(df: DataFrame, digest: Column, wanted: DataFrame, group: str) -> DataFrame:
    """``g, cut``: the last digest among the first ``remaining`` rows of each group of ``wanted`` (``g, remaining``).

    Reads ``df`` twice, whatever its size and number of groups: once to count, once for the digests under
    the prefix that holds the cut. A group that needs no rows is left out.
    """
    rows = df.select(F.col(group).alias("g"), digest.alias("d"))
    wanted = wanted.filter("remaining > 0").select("g", "remaining")
    cuts = None
    for length in range(_HEX_STEP, _DIGEST_CHARS + _HEX_STEP, _HEX_STEP):
        counts = rows.groupBy("g", F.substring("d", 1, length).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
        ends = written(_where_it_ends(counts, wanted), "cuts")
        # A prefix that is taken whole is a cut: the sign behind it sorts after every hex digit.
        done = ends.filter("remaining = n").select("g", F.concat("prefix", F.lit("~")).alias("cut"))
        cuts = done if cuts is None else cuts.unionByName(done)
        left = ends.filter("remaining < n")
        most = left.agg(F.max("n")).first()[0]
        if most is None:
            return cuts
        inside = broadcast_if_small(left.select(F.col("g").alias("_g"), "prefix", "remaining"))
        under = F.col("g").eqNullSafe(F.col("_g")) & (F.substring("d", 1, length) == F.col("prefix"))
        if most <= _SORTED_DIGESTS or length >= _DIGEST_CHARS:
            return cuts.unionByName(_cut_in_order(rows.join(inside, under)))
        rows = written(rows.join(inside, under, "left_semi"), "digests")
        wanted = left.select("g", "remaining")
    return cuts


def few_cuts(df: DataFrame, digest: Column, group: str, wanted: Callable[[dict], dict]) -> dict | None:
    """The cut of each group, where the groups are few: one job counts rows per group and prefix, one puts the digests under the cuts in order.

    ``wanted`` gives the rows wanted of each group out of the sizes of all. The driver gets at most ``_FEW_COUNTS`` counts; None where
    there are more, or where so many digests lie under a prefix that it has to be divided again: then see ``digest_cuts``.
    """
    rows = df.select(F.col(group).alias("g"), digest.alias("d"))
    prefix = F.substring("d", 1, _HEX_STEP).alias("prefix")
    counts = rows.groupBy("g", prefix).agg(F.count(F.lit(1)).alias("n")).limit(_FEW_COUNTS + 1).collect()
    if len(counts) > _FEW_COUNTS:
        return None
    sizes: dict = {}
    for r in counts:
        sizes[r["g"]] = sizes.get(r["g"], 0) + r["n"]
    remaining = {g: k for g, k in wanted(sizes).items() if k > 0}
    cuts, under = {}, []
    for g, p, n in sorted(((r["g"], r["prefix"], r["n"]) for r in counts), key=lambda r: r[1]):
        left = remaining.get(g, 0)
        if left > n:
            remaining[g] = left - n
        elif left:
            if left == n:
                cuts[g] = p + "~"  # taken whole: the sign behind it sorts after every hex digit
            else:
                under.append((g, p, left, n))
            del remaining[g]
    if any(n > _SORTED_DIGESTS for *_, n in under):
        return None
    if under:
        schema = T.StructType([T.StructField("_g", df.schema[group].dataType)]).add("_prefix", "string").add("remaining", "long")
        few = F.broadcast(df.sparkSession.createDataFrame([(g, p, left) for g, p, left, _ in under], schema))  # a row per group
        inside = rows.join(few, F.col("g").eqNullSafe(F.col("_g")) & (F.substring("d", 1, _HEX_STEP) == F.col("_prefix")))
        found = _placed(inside, F.col("remaining")).collect()
        if any(r["tied"] for r in found):
            raise TiedKeys("the key is not unique: equal digests meet at the cut")
        cuts |= {r["g"]: r["cut"] for r in found}
    return cuts


def class_allocation(sizes: Mapping, n_draws: int) -> dict:
    """``n_draws`` rows shared out over classes in proportion, by largest remainder."""
    total = sum(sizes.values())
    shares = {g: divmod(n * n_draws, total) for g, n in sizes.items()}
    drawn = {g: whole for g, (whole, _) in shares.items()}
    by_remainder = sorted(shares, key=lambda g: (-shares[g][1], g is not None, str(g)))
    for g in by_remainder[: n_draws - sum(drawn.values())]:
        drawn[g] += 1
    return drawn


def allocated(sizes: DataFrame, n_draws: Column | int, output: str = "drawn") -> DataFrame:
    """``class_allocation`` for a table ``g, n`` of any number of classes; a few are shared out on the driver."""
    few = sizes.limit(_FEW_CLASSES + 1).collect() if isinstance(n_draws, int) else []
    if 0 < len(few) <= _FEW_CLASSES:
        drawn = class_allocation({r["g"]: r["n"] for r in few}, n_draws)
        return sizes.sparkSession.createDataFrame([(r["g"], r["n"], drawn[r["g"]]) for r in few], T.StructType(list(sizes.schema.fields)).add(output, "long"))
    n_draws = F.lit(n_draws) if isinstance(n_draws, int) else n_draws
    totals = sizes.agg(F.sum("n").alias("total"))
    shared = sizes.join(F.broadcast(totals), how="cross")  # one row
    shared = shared.withColumn("_product", F.col("n").cast("decimal(38,0)") * n_draws.cast("decimal(19,0)"))
    shared = shared.withColumn(output, F.call_function("div", "_product", F.col("total").cast("decimal(38,0)")).cast("long"))
    shared = written(shared.withColumn("_rest", F.col("_product") - F.col(output) * F.col("total")), "shares")
    left = shared.agg((F.max(n_draws) - F.sum(output)).alias("k")).first()["k"] or 0
    first = shared.orderBy(F.desc("_rest"), F.col("g").cast("string")).limit(left).select(F.col("g").alias("_g"), F.lit(1).alias("_more"))
    more = shared.join(first, F.col("g").eqNullSafe(F.col("_g")), "left")
    return more.select("g", "n", (F.col(output) + F.coalesce("_more", F.lit(0))).alias(output))


def _first_rows(
    df: DataFrame, keys: Sequence[str], seed: int, wanted: int | Callable[[dict], dict], group: str | None, output: str,
    wanted_of: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The frame with a mark on the first ``wanted`` rows of all, or of each group, as ``wanted`` says of a few groups' sizes and ``wanted_of`` of a table of them."""

    def cut(frame: DataFrame, digest: Column):
        if group is None:
            return single_cut(frame, digest, wanted)
        found = few_cuts(frame, digest, group, wanted)
        if found is None:
            return digest_cuts(frame, digest, wanted_of(written(group_sizes(frame, group), "sizes")), group)
        schema = T.StructType([T.StructField("g", frame.schema[group].dataType)]).add("cut", "string")
        return frame.sparkSession.createDataFrame(list(found.items()), schema)

    columns, digest = df.columns, key_digest(keys, seed)
    try:
        cuts = cut(df, digest)
    except TiedKeys:
        df = with_row_id(df)
        digest = key_digest([*keys, ROW_ID], seed)
        cuts = cut(df, digest)
    if group is None:
        return df.select(*columns, (digest <= F.lit(cuts)).alias(output))
    cuts = broadcast_if_small(cuts.withColumnRenamed("g", "_g"))  # a row per group
    marked = df.join(cuts, F.col(group).eqNullSafe(F.col("_g")), "left")
    return marked.select(*columns, F.coalesce(digest <= F.col("cut"), F.lit(False)).alias(output))


def mark_split(
    df: DataFrame, key: str | Sequence[str], test_size: float = 0.2, seed: int = SEED, stratify: str | None = None,
    output: str = "is_test",
) -> DataFrame:
    """Add a boolean that marks exactly ``ceil(test_size * n)`` rows as test rows.

    ``stratify`` keeps the class shares: the train rows are shared out over the
    classes by largest remainder and the rest of each class is for testing. Reads
    the rows twice before they are marked: counts per digest prefix, and the digests under the prefix of the cut.
    Where rows with one and the same key meet at the cut they are numbered first, see ``with_row_id``.
    """
    if stratify is None:
        return _first_rows(df, _as_list(key), seed, math.ceil(test_size * df.count()), None, output)

    def of_few(sizes: dict) -> dict:
        n = sum(sizes.values())
        drawn = class_allocation(sizes, n - math.ceil(test_size * n)) if n else {}
        return {g: size - drawn[g] for g, size in sizes.items()}

    def of_many(sizes: DataFrame) -> DataFrame:
        n = sizes.agg(F.sum("n")).first()[0] or 0
        shared = allocated(sizes, n - math.ceil(test_size * n))
        return shared.select("g", (F.col("n") - F.col("drawn")).alias("remaining"))

    return _first_rows(df, _as_list(key), seed, of_few, stratify, output, of_many)


def split_train_test(
    df: DataFrame, key: str | Sequence[str], test_size: float = 0.2, seed: int = SEED, stratify: str | None = None
) -> tuple[DataFrame, DataFrame]:
    marked = mark_split(df, key, test_size, seed, stratify, "_is_test")
    return marked.filter(~F.col("_is_test")).drop("_is_test"), marked.filter("_is_test").drop("_is_test")


def split_report(df: DataFrame, mark: str = "is_test") -> DataFrame:
    """Rows and share in percent of the train and the test part."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    part = F.when(F.col(mark), "test").otherwise("train")
    counts = df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.col("n") / total * 100)


def balanced_sample(
    df: DataFrame, side: str, key: str | Sequence[str], seed: int = SEED
) -> DataFrame:
    """Down-sample every side, without replacement, to the size of the smallest."""

    def of_many(sizes: DataFrame) -> DataFrame:
        smallest = sizes.agg(F.min("n")).first()[0] or 0
        return sizes.select("g", F.lit(smallest).alias("remaining"))

    of_few = lambda sizes: dict.fromkeys(sizes, min(sizes.values(), default=0))
    return _first_rows(df, _as_list(key), seed, of_few, side, "_chosen", of_many).filter("_chosen").drop("_chosen")


def shuffled(df: DataFrame, key: str | Sequence[str], seed: int = SEED) -> DataFrame:
    """Rows in a repeatable random order; only of use right before an export."""
    return df.orderBy(key_digest(_as_list(key), seed), *_as_list(key))
