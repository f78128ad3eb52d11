"""Forests and boosted trees over more rows than executors can keep as objects.

A value counts by its bin only, so a training row is a byte per feature. Rows are written in blocks, equal rows of a block as one with
its counts. A level of all trees costs one pass that sums each block into counts per node, feature and bin. A node with few rows gets no more passes:
its rows go to one task, which grows all that lies below it. Trees are plain arrays, and so is what a task sends. What is fitted is what Spark ML's
forests and boosted trees fit: the same draws, criteria, stops and pruning, with the same defaults.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.session import scratch_folder

#: Rows of a block before equal ones are folded.
BLOCK_ROWS = 1_000_000
#: Drawn rows of a node from which one task grows the rest.
LOCAL_ROWS = 1_000_000
#: A bin is a byte.
MAX_BINS = 256
#: Parquet looks at its buffers after so many rows only, by default 100; a block is some MB.
_BLOCK_OPTIONS = {"parquet.block.size": 16 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
_BLOCK_SCHEMA = "part int, place int, bins binary, n_0 binary, n_1 binary"
#: Gains below this share of a node's rows are rounding.
_NO_GAIN = 1e-12


class Tree(NamedTuple):
    """An entry per node, the root first."""

    feature: np.ndarray  # -1 at a leaf
    cut: np.ndarray  # the last bin that goes left
    left: np.ndarray  # the child on the left; the other one comes next
    value: np.ndarray  # mean of the rows
    gain: np.ndarray  # of the split, times the rows


class Block(NamedTuple):
    key: tuple[int, int]
    bins: np.ndarray  # a row per feature
    n_0: np.ndarray
    n_1: np.ndarray


def route(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The leaf of each column of ``bins``."""
    node = np.zeros(bins.shape[1], np.int64)
    moving = np.arange(len(node)) if tree.feature[0] >= 0 else node[:0]
    while len(moving):
        at = node[moving]
        at = tree.left[at] + (bins[tree.feature[at], moving] > tree.cut[at])
        node[moving] = at
        moving = moving[tree.feature[at] >= 0]
    return node


def pruned(tree: Tree) -> Tree:
    """A classifying tree without the splits whose two leaves say the same class."""
    feature = tree.feature.copy()
    risk = tree.value > 0.5
    while True:
        split = np.flatnonzero(feature >= 0)
        low, high = tree.left[split], tree.left[split] + 1
        idle = split[(feature[low] < 0) & (feature[high] < 0) & (risk[low] == risk[high])]
        if not len(idle):
            break
        feature[idle] = -1
    reached, level = np.zeros(len(feature), bool), np.zeros(1, np.int64)
    while len(level):
        reached[level] = True
        low = tree.left[level[feature[level] >= 0]].astype(np.int64)
        level = np.concatenate([low, low + 1])
    places = np.cumsum(reached) - 1  # siblings stay together
    left = np.where(feature >= 0, places[tree.left], 0).astype(tree.left.dtype)
    return Tree(*[x[reached] for x in (feature, tree.cut, left, tree.value, np.where(feature >= 0, tree.gain, 0).astype(tree.gain.dtype))])


# -- blocks ------------------------------------------------------------------------


def bin_edges(df: DataFrame, features: Sequence[str], max_bins: int) -> list[np.ndarray]:
    """Per feature the values that end a bin, at even shares of all rows; with few distinct values each is a bin."""
    if max_bins > MAX_BINS:
        raise ValueError(f"more than {MAX_BINS} bins")
    shares = [i / max_bins for i in range(1, max_bins)]
    found = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares).alias(f"c{i}") for i, c in enumerate(features)]).first()
    return [np.unique(np.array(values if values is not None else [], dtype=float)) for values in found]


def binned(columns: Sequence[np.ndarray], edges: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, "left").astype(np.uint8) for c, e in zip(columns, edges)])


def _folded(bins: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal columns of ``bins`` as one, in order, with the sums of their counts."""
    lanes = []
    for i in range(0, len(bins), 8):
        lane = np.zeros((bins.shape[1], 8), np.uint8)
        lane[:, : len(bins[i : i + 8])] = bins[i : i + 8].T
        lanes.append(lane.view(np.uint64).ravel())
    order = np.argsort(lanes[0]) if len(lanes) == 1 else np.lexsort(lanes)
    change = np.ones(len(order), bool)
    change[1:] = np.any([lane[order[1:]] != lane[order[:-1]] for lane in lanes], axis=0)
    first = np.flatnonzero(change)
    return bins[:, order[first]], *[np.add.reduceat(n[order], first) for n in counts]


def _doubles(batch: pa.RecordBatch, n_features: int) -> list[np.ndarray]:
    return [batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_features)]


def written_blocks(df: DataFrame, features: Sequence[str], label: str, edges: Sequence[np.ndarray]) -> DataFrame:
    """The complete rows of ``df`` in blocks, with the number of rows of class 0 and of class 1 that each row stands for."""
    n_features, block_rows = len(features), BLOCK_ROWS

    def run(batches):
        part, place, held, n = TaskContext.get().partitionId(), 0, [], 0

        def block():
            bins, labels = np.concatenate([b for b, _ in held], axis=1), np.concatenate([y for _, y in held])
            bins, n_0, n_1 = _folded(bins, (labels != 1).astype(np.uint32), (labels == 1).astype(np.uint32))
            data = [bins.tobytes(), n_0.astype(np.uint32).tobytes(), n_1.astype(np.uint32).tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([place], pa.int32()), *[pa.array([x], pa.binary()) for x in data]], ["part", "place", "bins", "n_0", "n_1"]
            )

        for batch in batches:
            if batch.num_rows:
                held.append((binned(_doubles(batch, n_features), edges), batch.column(n_features).to_numpy(zero_copy_only=False)))
                n += batch.num_rows
            if n >= block_rows:
                yield block()
                place, held, n = place + 1, [], 0
        if held:
            yield block()

    spark = df.sparkSession
    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(features)], F.col(label).cast("int").alias("label"))
    path = scratch_folder(spark, "blocks")
    rows.coalesce(spark.sparkContext.defaultParallelism).mapInArrow(run, _BLOCK_SCHEMA).write.options(**_BLOCK_OPTIONS).parquet(path)
    return spark.read.schema(_BLOCK_SCHEMA).parquet(path)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for i in range(batch.num_rows):
            part, place, *data = (batch.column(k)[i] for k in range(5))
            bins, n_0, n_1 = (np.frombuffer(x.as_buffer(), kind) for x, kind in zip(data, (np.uint8, np.uint32, np.uint32)))
            yield Block((part.as_py(), place.as_py()), bins.reshape(-1, len(n_0)), n_0, n_1)


# -- growing -------------------------------------------------------------------------


def _choices(rng: np.random.Generator, n_nodes: int, n_features: int, n_chosen: int) -> np.ndarray:
    """The features that each node may split by."""
    return rng.random((n_nodes, n_features)).argsort(axis=1)[:, :n_chosen]


def _cells(keys: np.ndarray, n_keys: int, *sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order, and the sums over each: by counting where the keys are few, else by sorting."""
    if n_keys <= 4 * len(keys):
        found = np.flatnonzero(np.bincount(keys, minlength=n_keys))
        return found, *[np.bincount(keys, s, n_keys)[found] for s in sums]
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], *[np.add.reduceat(s[order], first) for s in sums]


def _best_cuts(keys: np.ndarray, w: np.ndarray, v: np.ndarray, n_nodes: int, n_bins: int) -> tuple[np.ndarray, ...]:
    """Per node the best gain and its cut, and the sums of ``w`` and ``v`` on its left, from cells ``node * n_bins + bin`` in order.

    ``w`` counts rows, ``v`` sums what they have. The gain is the fall of the squared error; of a class, the fall of the Gini impurity is twice that.
    """
    node = keys // n_bins
    first = np.searchsorted(node, np.arange(n_nodes))
    upto_w, upto_v = np.cumsum(w), np.cumsum(v)
    whole_w, whole_v = np.bincount(node, w, n_nodes), np.bincount(node, v, n_nodes)
    inner = np.flatnonzero(node[:-1] == node[1:])  # cuts behind the last cell leave nothing on the right
    owner = node[inner]
    left_w, left_v = upto_w[inner] - (upto_w - w)[first[owner]], upto_v[inner] - (upto_v - v)[first[owner]]
    right_w, right_v = whole_w[owner] - left_w, whole_v[owner] - left_v
    gain = left_v**2 / left_w + right_v**2 / right_w - whole_v[owner] ** 2 / whole_w[owner]
    best, cut, w_left, v_left = np.zeros(n_nodes), np.zeros(n_nodes, np.int64), np.zeros(n_nodes), np.zeros(n_nodes)
    if len(inner):
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        most = np.maximum.reduceat(gain, starts)
        hit = np.flatnonzero(gain == np.repeat(most, np.diff([*starts, len(gain)])))
        hit = hit[np.concatenate([[True], owner[hit][1:] != owner[hit][:-1]])]  # the first of equal ones
        at = owner[hit]
        best[at], cut[at], w_left[at], v_left[at] = gain[hit], keys[inner[hit]] % n_bins, left_w[hit], left_v[hit]
        best[best <= _NO_GAIN * whole_w] = 0
    return best, cut, w_left, v_left


def _best_splits(cells_of: Callable, chosen: np.ndarray, n_nodes: int, n_bins: int) -> tuple[np.ndarray, ...]:
    """``_best_cuts`` over the chosen features, with the feature; -1 where no cut gains anything. ``cells_of`` gives the cells of the i-th choice."""
    best, cut, w_left, v_left = np.zeros(n_nodes), np.zeros(n_nodes, np.int64), np.zeros(n_nodes), np.zeros(n_nodes)
    feature = np.full(n_nodes, -1)
    for i in range(chosen.shape[1]):
        gain, *found = _best_cuts(*cells_of(i), n_nodes, n_bins)
        better = gain > best
        best[better], feature[better] = gain[better], chosen[better, i]
        for into, values in zip((cut, w_left, v_left), found):
            into[better] = values[better]
    return feature, best, cut, w_left, v_left


def grow(bins: np.ndarray, w: np.ndarray, v: np.ndarray, depth: int, n_chosen: int, n_bins: int, rng: np.random.Generator) -> Tree:
    """A classifying tree over rows in memory; ``v`` of the ``w`` rows are of class 1."""
    bins, w, v = _folded(bins, w.astype(float), v.astype(float))
    levels, total, n_nodes = [], 1, 1
    node = np.zeros(len(w), np.int64)
    while n_nodes:
        whole_w, whole_v = np.bincount(node, w, n_nodes), np.bincount(node, v, n_nodes)
        feature, cut, left, gains = np.full(n_nodes, -1), np.zeros(n_nodes, np.int64), np.zeros(n_nodes, np.int64), np.zeros(n_nodes)
        mixed = (whole_v > 0) & (whole_v < whole_w) & (depth > 0)
        if mixed.any():
            n_mixed, keep = int(mixed.sum()), mixed[node]
            bins, w, v, node = bins[:, keep], w[keep], v[keep], (np.cumsum(mixed) - 1)[node[keep]]
            chosen, rows = _choices(rng, n_mixed, len(bins), n_chosen), np.arange(len(w))
            cells_of = lambda i: _cells(node * n_bins + bins[chosen[node, i], rows], n_mixed * n_bins, w, v)  # noqa: E731, B023
            found, gain, cuts, *_ = _best_splits(cells_of, chosen, n_mixed, n_bins)
            split = found >= 0
            feature[mixed], cut[mixed], gains[mixed] = found, cuts, gain
            children = int(2 * split.sum())
            left[np.flatnonzero(mixed)[split]] = total + np.arange(0, children, 2)
            keep = split[node]
            bins, w, v, node = bins[:, keep], w[keep], v[keep], node[keep]
            node = 2 * (np.cumsum(split) - 1)[node] + (bins[found[node], np.arange(len(w))] > cuts[node])
        else:
            children = 0
        levels.append((feature, cut, left, whole_v / whole_w, gains))
        total, n_nodes, depth = total + children, children, depth - 1
    return pruned(Tree(*[np.concatenate(x) for x in zip(*levels)]))


class _Growing:
    """A tree while its levels are grown over all blocks."""

    def __init__(self):
        self.nodes = [[-1, 0, 0, 0.0, 0.0]]
        self.depths = [0]
        self.open, self.small = [0], []

    def tree(self) -> Tree:
        return Tree(*[np.array(x, kind) for x, kind in zip(zip(*self.nodes), (int, int, int, float, float))])

    def places(self, nodes: Sequence[int]) -> np.ndarray:
        """By node, its place among ``nodes``; -1 elsewhere."""
        places = np.full(len(self.nodes), -1)
        places[nodes] = np.arange(len(nodes))
        return places

    def split(self, sums: np.ndarray, chosen: np.ndarray, depth: int, local_rows: int) -> None:
        """Split the open nodes by ``sums`` per node, choice, bin, and rows or values."""
        n_nodes, _, n_bins, _ = sums.shape
        whole_w, whole_v = sums[:, 0, :, 0].sum(axis=1), sums[:, 0, :, 1].sum(axis=1)

        def cells_of(i):
            w, v = (sums[:, i, :, k].ravel() for k in (0, 1))
            full = np.flatnonzero(w)
            return full, w[full], v[full]

        feature, gain, cut, w_left, v_left = _best_splits(cells_of, chosen, n_nodes, n_bins)
        following = []
        for i, node in enumerate(self.open):
            self.nodes[node][3] = float(whole_v[i] / whole_w[i]) if whole_w[i] else 0.0
            if feature[i] < 0:
                continue
            self.nodes[node][:3], self.nodes[node][4] = (int(feature[i]), int(cut[i]), len(self.nodes)), float(gain[i])
            for w, v in ((w_left[i], v_left[i]), (whole_w[i] - w_left[i], whole_v[i] - v_left[i])):
                if self.depths[node] + 1 < depth:
                    (following if w > local_rows else self.small).append(len(self.nodes))
                self.nodes.append([-1, 0, 0, float(v / w), 0.0])
                self.depths.append(self.depths[node] + 1)
        self.open = following


def _sums(blocks: DataFrame, weigh: Callable, states: dict, n_bins: int) -> dict[int, np.ndarray]:
    """One pass: per tree the rows and values by open node, choice and bin. ``weigh(tree, block)`` says what each row of a block counts and has."""

    def run(batches):
        found = {t: np.zeros((*chosen.shape, n_bins, 2)) for t, (_, _, chosen) in states.items()}
        for block in _blocks(batches):
            for t, (tree, places, chosen) in states.items():
                w, v = weigh(t, block)
                node = places[route(tree, block.bins)]
                rows = np.flatnonzero((node >= 0) & (w > 0))
                node, w, v = node[rows], w[rows], v[rows]
                for i in range(chosen.shape[1]):
                    keys = node * n_bins + block.bins[chosen[node, i], rows]
                    for k, values in enumerate((w, v)):
                        found[t][:, i, :, k] += np.bincount(keys, values, len(chosen) * n_bins).reshape(-1, n_bins)
        part = TaskContext.get().partitionId()
        for t, sums in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([part], pa.int32()), pa.array([sums.tobytes()], pa.binary())], ["tree", "part", "data"])

    def add(table):
        table = table.sort_by("part")  # sums don't hang on what came first
        total = sum(np.frombuffer(x.as_buffer()) for x in table.column("data"))
        return pa.table([table.column("tree").slice(0, 1), pa.array([total.tobytes()], pa.binary())], ["tree", "data"])

    rows = blocks.coalesce(blocks.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, "tree int, part int, data binary")
    sums = rows.groupBy("tree").applyInArrow(add, "tree int, data binary").collect()  # a row per tree
    return {r["tree"]: np.frombuffer(r["data"]).reshape(*states[r["tree"]][2].shape, n_bins, 2) for r in sums}


def _grow_wide(blocks: DataFrame, weigh: Callable, trees: list[_Growing], n_features: int, depth: int, n_chosen: int, n_bins: int, local_rows: int, seed: int) -> None:
    """Grow all trees level by level until they are whole or their nodes have no more than ``local_rows`` rows."""
    while growing := {t: g for t, g in enumerate(trees) if g.open}:
        rngs = {t: np.random.default_rng([seed, t, len(g.nodes)]) for t, g in growing.items()}
        states = {t: (g.tree(), g.places(g.open), _choices(rngs[t], len(g.open), n_features, n_chosen)) for t, g in growing.items()}
        sums = _sums(blocks, weigh, states, n_bins)
        for t, g in growing.items():
            g.split(sums[t], states[t][2], depth, local_rows)


def _grown_below(blocks: DataFrame, weigh: Callable, trees: list[_Growing], n_features: int, depth: int, n_chosen: int, n_bins: int, seed: int) -> list[Tree]:
    """The trees with all that lies below their small nodes, each grown by one task."""
    tops, places, depths = [g.tree() for g in trees], [g.places(g.small) for g in trees], [g.depths for g in trees]
    small = [g.small for g in trees]

    def deal(batches):
        for block in _blocks(batches):
            for t, (top, place) in enumerate(zip(tops, places)):
                w, v = weigh(t, block)
                node = place[route(top, block.bins)]
                rows = np.flatnonzero((node >= 0) & (w > 0))
                rows = rows[np.argsort(node[rows], kind="stable")]
                found, first = np.unique(node[rows], return_index=True)
                cells = []
                for some in np.split(rows, first[1:]) if len(rows) else []:
                    cells.append(block.bins[:, some].tobytes() + w[some].astype(np.uint32).tobytes() + v[some].astype(np.uint32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t] * len(found), pa.int32()), pa.array([small[t][i] for i in found], pa.int32()), pa.array(cells, pa.binary())], ["tree", "node", "data"]
                )

    def below(key, table):
        t, node = (k.as_py() for k in key)
        bins, counts = [], []
        for x in table.column("data"):
            data = np.frombuffer(x.as_buffer(), np.uint8)
            n = len(data) // (n_features + 8)
            bins.append(data[: n * n_features].reshape(n_features, n))
            counts.append(np.frombuffer(data[n * n_features :].tobytes(), np.uint32).reshape(2, n))
        w, v = np.concatenate(counts, axis=1)
        # Equal rows are folded in order first, so the tree doesn't hang on which rows came first.
        tree = grow(np.concatenate(bins, axis=1), w, v, depth - depths[t][node], n_chosen, n_bins, np.random.default_rng([seed, t, node, 1]))
        data = [pa.array([x.astype(kind).tobytes()], pa.binary()) for x, kind in zip(tree, _KINDS)]
        return pa.table([pa.array([t], pa.int32()), pa.array([node], pa.int32()), *data], names)

    names = ["tree", "node", *Tree._fields]
    dealt = blocks.coalesce(blocks.sparkSession.sparkContext.defaultParallelism).mapInArrow(deal, "tree int, node int, data binary")
    schema = "tree int, node int, " + ", ".join(f"{c} binary" for c in names[2:])
    parts: list[list] = [[] for _ in trees]
    if any(small):
        for r in sorted(dealt.groupBy("tree", "node").applyInArrow(below, schema).collect(), key=lambda r: (r["tree"], r["node"])):  # the model, some bytes a node
            parts[r["tree"]].append((r["node"], Tree(*[np.frombuffer(r[c], kind) for c, kind in zip(Tree._fields, _KINDS)])))
    return [pruned(_joined(top, below_it)) for top, below_it in zip(tops, parts)]


_KINDS = (np.int16, np.uint8, np.int32, np.float32, np.float32)


def _joined(top: Tree, parts: Sequence[tuple[int, Tree]]) -> Tree:
    """``top`` with a tree in place of each of the nodes named; roots take the node's place, other nodes follow behind."""
    pieces, total = [Tree(*[x.astype(kind) for x, kind in zip(top, _KINDS)])], len(top.feature)
    for node, tree in parts:
        left = np.where(tree.feature >= 0, tree.left + (total - 1), 0).astype(np.int32)
        moved = Tree(tree.feature, tree.cut, left, tree.value, tree.gain)
        for into, values in zip(pieces[0], moved):
            into[node] = values[0]
        pieces.append(Tree(*[x[1:] for x in moved]))
        total += len(tree.feature) - 1
    return Tree(*[np.concatenate(x) for x in zip(*pieces)])


# -- models ---------------------------------------------------------------------------


class Forest:
    """The mean of what trees say of class 1."""

    def __init__(self, trees: Sequence[Tree], n_features: int):
        self.trees, self.shares = list(trees), [1 / len(trees)] * len(trees)
        gains = [np.bincount(t.feature[t.feature >= 0], t.gain[t.feature >= 0], n_features) for t in trees]
        each = [g / g.sum() for g in gains if g.sum() > 0]
        total = sum(each, np.zeros(n_features))
        self.featureImportances: DenseVector = Vectors.dense(total / total.sum() if each else total)

    @staticmethod
    def score(sums: np.ndarray) -> np.ndarray:
        return sums


class Boosted:
    """Half the logarithm of the odds of class 1, as a sum over trees."""

    def __init__(self, trees: Sequence[Tree], shares: Sequence[float]):
        self.trees, self.shares = list(trees), list(shares)

    @staticmethod
    def score(sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-2 * sums))


def fit_forest(blocks: DataFrame, n_features: int, n_chosen: int, n_trees: int, depth: int, n_bins: int, seed: int) -> Forest:
    """Each tree counts a row as often as a Poisson number of mean 1 says, and looks at ``n_chosen`` features a node; nodes end when they are pure."""

    def drawn(t: int, block: Block) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([seed, t, *block.key])  # the same in each pass
        n_1, n_0 = rng.poisson(block.n_1), rng.poisson(block.n_0)  # a sum of such numbers is one with the sum of their means
        return n_0 + n_1, n_1

    trees = [_Growing() for _ in range(n_trees)]
    _grow_wide(blocks, drawn, trees, n_features, depth, n_chosen, n_bins, LOCAL_ROWS, seed)
    return Forest(_grown_below(blocks, drawn, trees, n_features, depth, n_chosen, n_bins, seed), n_features)


def fit_boosting(blocks: DataFrame, n_features: int, n_trees: int, depth: int, step: float, n_bins: int, seed: int) -> Boosted:
    """The first tree fits labels of -1 and 1, each later one the negative gradient of the logistic loss."""
    trees: list[Tree] = []
    for _ in range(n_trees):
        before = Boosted(trees, [1.0, *[step] * len(trees)][: len(trees)])

        def residuals(_, block, before=before):
            sums = summed(before.trees, before.shares, block.bins)
            up, down = (4 / (1 + np.exp(2 * sums)), -4 / (1 + np.exp(-2 * sums))) if before.trees else (1.0, -1.0)
            return block.n_0 + block.n_1, block.n_1 * up + block.n_0 * down

        growing = _Growing()
        _grow_wide(blocks, residuals, [growing], n_features, depth, n_features, n_bins, 0, seed)
        trees.append(growing.tree())
    return Boosted(trees, [1.0, *[step] * n_trees][:n_trees])


def summed(trees: Sequence[Tree], shares: Sequence[float], bins: np.ndarray) -> np.ndarray:
    total = np.zeros(bins.shape[1])
    for tree, share in zip(trees, shares):
        total += share * tree.value[route(tree, bins)]
    return total


def predictions(df: DataFrame, models: dict[str, Forest | Boosted], features: Sequence[str], label: str, edges: Sequence[np.ndarray]) -> DataFrame:
    """``model, label, score, prediction`` of each model for every row."""
    n_features, links = len(features), {name: model.score for name, model in models.items()}
    # Plain tuples: workers need not have this package to read them. Gains stay here.
    bare = {name: [(*t[:-1], t.gain[:0]) for t in model.trees] for name, model in models.items()}
    sent = df.sparkSession.sparkContext.broadcast({name: (bare[name], model.shares) for name, model in models.items()})

    def run(batches):
        held = {name: ([Tree(*t) for t in trees], shares) for name, (trees, shares) in sent.value.items()}
        for batch in batches:
            bins = binned(_doubles(batch, n_features), edges)
            for name, (trees, shares) in held.items():
                score = links[name](summed(trees, shares, bins))
                columns = [pa.array([name] * len(score), pa.string()), batch.column(n_features), pa.array(score, pa.float64()), pa.array((score > 0.5).astype(np.int32), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["model", "label", "score", "prediction"])

    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(features)], F.col(label).cast("int").alias("label"))
    return rows.mapInArrow(run, "model string, label int, score double, prediction int")
