"""Random forests over binned features: every task adds up histograms, whole levels grow at once.

Spark's own forest visits all trees for one row at a time, so its histograms, some megabytes a tree,
never stay in a cache. Here the binned rows are written once, a byte a feature, and a task takes
one tree after the other over its rows. The rest is the same method: a Poisson bootstrap of all
rows, 32 bins a feature, a random subset of the features for each node, Gini or variance.

Regression trees of more than ten levels, or of any number, are grown so only until a node has few rows. These are
then brought together by tree and node, and each node's subtree is finished in a task; the subtrees are a table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame, functions as F

from opsight.session import materialise

BINS = 32
#: Rows of a block of the binned table, and bytes of the blocks that one task holds.
BLOCK_ROWS, TASK_BYTES = 1 << 15, 96 << 20
#: Beyond these a level's histograms grow large, and Spark's own forest or subtrees are used.
MOST_FEATURES, MOST_DEPTH = 256, 10
#: Rows that a subtree is finished from, about, and bytes that are dealt to subtrees at once.
SUBTREE_ROWS, ROUND_BYTES = 1 << 18, 4 << 30


@dataclass
class Trees:
    """Complete binary trees as arrays (tree, node); the children of node i are 2i + 1 and 2i + 2, a leaf has feature -1."""

    feature: np.ndarray
    cut: np.ndarray
    #: Summed class weights, or (rows, sum, sum of squares) of the centred label, per node.
    stats: np.ndarray | None = None
    gain: np.ndarray | None = None

    def leaves(self, tree: int, flat: np.ndarray, width: int, rows: np.ndarray, levels: int) -> np.ndarray:
        """The node that each of the ``rows`` has come to after so many levels, from cells by feature, ``width`` rows each."""
        feature, number = self.feature[tree], np.arange(self.feature.shape[1])
        split = feature >= 0
        start, child = np.where(split, feature, 0).astype(np.intp) * width, np.where(split, 2 * number + 1, number)
        cut = np.where(split, self.cut[tree], 255).astype(np.uint8)  # no bin lies right of 255: a leaf is kept
        at = np.zeros(len(rows), np.intp)
        for _ in range(levels):
            right = flat.take(start.take(at) + rows) > cut.take(at)
            at = child.take(at)
            at += right
        return at


def thresholds(rows: DataFrame, size: int) -> list[np.ndarray]:
    """Up to 31 ascending cuts per feature; a value goes right of the cuts below it.

    Between all values of a feature that has few, at quantiles of the others.
    """
    grid = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    x = [F.col("x")[i] for i in range(size)]
    seen = rows.agg(*[F.struct(F.percentile_approx(c, grid, F.lit(10_000)).alias("q"), F.min(c).alias("lo"), F.max(c).alias("hi"),
                               F.approx_count_distinct(c).alias("n")).alias(f"c{i}") for i, c in enumerate(x)]).first()
    few = [i for i in range(size) if seen[i]["n"] <= 2 * BINS]
    values: dict[int, list[float]] = {i: [] for i in few}
    if few:
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), x[i].alias("v")) for i in few]))
        for r in rows.select(pairs.alias("p")).select("p.i", "p.v").distinct().collect():
            values[r["i"]].append(r["v"])
    cuts = []
    for i in range(size):
        v = np.unique(values[i]) if i in few else np.zeros(0)
        if i in few and len(v) <= BINS:
            cuts.append((v[:-1] + v[1:]) / 2)
        else:
            edges = np.unique(np.array([seen[i]["lo"], *(seen[i]["q"] or [])], float))
            cuts.append(edges[edges < seen[i]["hi"]][-(BINS - 1):])
    return cuts


def binned(matrix: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """(feature, row) numbers of bins of a (row, feature) matrix."""
    found = np.empty((matrix.shape[1], matrix.shape[0]), np.uint8)
    for i, c in enumerate(cuts):
        found[i] = np.searchsorted(c, matrix[:, i], "left")
    return found


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def blocks_of(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """The binned rows as numbered blocks."""
    size = len(cuts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, number = [], 0, TaskContext.get().partitionId() << 32

        def block() -> pa.RecordBatch:
            cells, y = (np.concatenate(p, axis=-1) for p in zip(*held))
            return pa.RecordBatch.from_pydict({
                "number": pa.array([number], pa.int64()), "rows": pa.array([len(y)], pa.int32()),
                "cells": pa.array([cells.tobytes()], pa.binary()), "labels": pa.array([y.tobytes()], pa.binary())})

        for batch in batches:
            if batch.num_rows:
                held.append((binned(_matrix(batch.column("x"), size), cuts), batch.column("y").to_numpy(zero_copy_only=False)))
                n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block()
                held, n, number = [], 0, number + 1
        if n:
            yield block()

    return rows.mapInArrow(pack, "number long, rows int, cells binary, labels binary")


#: Poisson(1) by a 16 bit draw.
_POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]),
                           (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def draws(seed: int, tree: int, number: int, rows: int) -> np.ndarray:
    """How often each row of a block is in the bootstrap of a tree, the same at every level and retry."""
    return _POISSON[np.random.default_rng([seed, tree, number]).integers(0, 1 << 16, rows, np.uint16)]


def subsets(seed: int, tree: int, level: int, size: int, take: int) -> np.ndarray:
    """The features that each node of a level may be split by."""
    return np.random.default_rng([seed, tree, level]).random((1 << level, size)).argsort(axis=1)[:, :take].astype(np.int32)


@dataclass(frozen=True)
class Plan:
    size: int
    take: int
    leaf: int
    seed: int
    #: Weights of the classes, or None for a regression.
    weights: tuple[float, ...] | None

    @property
    def parts(self) -> int:
        """Numbers kept for a bin: rows of each class, or rows, sum and sum of squares."""
        return len(self.weights) if self.weights else 3


def _histograms(plan: Plan, sent, level: int, trees: int):
    """Bins of every node of a level, one row per tree, from all blocks of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for number, n, cells, y in zip(*(batch.column(c).to_pylist() for c in ("number", "rows", "cells", "labels"))):
                held.append((number, np.frombuffer(cells, np.uint8), np.frombuffer(y)))
        grown, first, nodes = sent.value, (1 << level) - 1, 1 << level
        for tree in range(trees if held else 0):
            asked = subsets(plan.seed, tree, level, plan.size, plan.take)
            total = np.zeros((plan.take, plan.parts, nodes * BINS))
            for number, cells, y in held:
                width, drawn = len(y), draws(plan.seed, tree, number, len(y))
                rows = np.flatnonzero(drawn)
                node = grown.leaves(tree, cells, width, rows, level) - first
                if node.size and node.min() < 0:  # leaves of levels above
                    rows, node = rows[node >= 0], node[node >= 0]
                times, label, base = drawn.take(rows).astype(float), y.take(rows), node * BINS
                if plan.weights:
                    base += label.astype(np.intp) * (nodes * BINS)
                else:
                    sums = times * label
                    squares = sums * label
                for slot in range(plan.take):
                    start = asked[:, slot].astype(np.intp) * width
                    place = base + cells.take(start.take(node) + rows)
                    if plan.weights:
                        total[slot] += np.bincount(place, times, plan.parts * nodes * BINS).reshape(plan.parts, -1)
                    else:
                        for part, weight in enumerate((times, sums, squares)):
                            total[slot, part] += np.bincount(place, weight, nodes * BINS)
            yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "bins": pa.array([total.tobytes()], pa.binary())})

    return run


def impurity(plan: Plan, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weight, impurity) of stats (part, ...)."""
    if plan.weights:
        total = stats.sum(axis=0)
        share = np.divide(stats, total, out=np.zeros_like(stats), where=total > 0)
        return total, np.where(total > 0, 1 - (share**2).sum(axis=0), 0.0)
    n = stats[0]
    mean = np.divide(stats[1], n, out=np.zeros_like(n), where=n > 0)
    return n, np.maximum(np.divide(stats[2], n, out=np.zeros_like(n), where=n > 0) - mean**2, 0.0)


def _best(plan: Plan, level: int):
    """The best split of every node of a tree's level, from the histograms of all tasks."""
    def run(table: pa.Table) -> pa.Table:
        tree, nodes = table.column("tree")[0].as_py(), 1 << level
        bins = sum(np.frombuffer(v) for v in table.column("bins").to_pylist()).reshape(plan.take, plan.parts, nodes, BINS)
        bins = bins.transpose(1, 2, 0, 3)  # part, node, slot, bin
        rows = bins.sum(axis=0) if plan.weights else bins[0]
        stats = bins * np.array(plan.weights)[:, None, None, None] if plan.weights else bins
        left, left_rows = stats.cumsum(axis=3), rows.cumsum(axis=2)
        whole, all_rows = left[..., -1:], left_rows[..., -1:]
        (wl, il), (wr, ir), (w, i) = (impurity(plan, s) for s in (left, whole - left, whole))
        gain = np.where(w > 0, i - np.divide(wl * il + wr * ir, w, out=np.zeros_like(wl), where=w > 0), 0.0)
        gain = np.where((left_rows >= plan.leaf) & (all_rows - left_rows >= plan.leaf), gain, -1.0).reshape(nodes, -1)
        best = gain.argmax(axis=1)
        top, node = gain[np.arange(nodes), best], np.arange(nodes)
        asked = subsets(plan.seed, tree, level, plan.size, plan.take)
        split = top > 1e-12
        both = np.stack([left[:, node, best // BINS, best % BINS], whole[:, node, 0, 0]], axis=1)  # part, (left, whole), node
        return pa.table({"tree": pa.array([tree], pa.int32()),
                         "feature": pa.array([np.where(split, asked[node, best // BINS], -1).tolist()], pa.list_(pa.int32())),
                         "cut": pa.array([(best % BINS).tolist()], pa.list_(pa.int32())),
                         "gain": pa.array([np.where(split, top * w[:, 0, 0], 0.0).tolist()], pa.list_(pa.float64())),
                         "stats": pa.array([both.ravel().tolist()], pa.list_(pa.float64()))})

    return run


def grow(blocks: DataFrame, plan: Plan, trees: int, depth: int) -> Trees:
    """All trees, level by level. The driver holds the trees alone: the splits of a level come back, not its histograms."""
    count = (1 << (depth + 1)) - 1
    grown = Trees(np.full((trees, count), -1, np.int32), np.zeros((trees, count), np.int32),
                  np.zeros((trees, count, plan.parts)), np.zeros((trees, count)))
    context = blocks.sparkSession.sparkContext
    for level in range(depth):
        first, nodes = (1 << level) - 1, 1 << level
        sent = context.broadcast(Trees(grown.feature, grown.cut))
        counted = blocks.mapInArrow(_histograms(plan, sent, level, trees), "tree int, bins binary")
        best = counted.groupBy("tree").applyInArrow(
            _best(plan, level), "tree int, feature array<int>, cut array<int>, gain array<double>, stats array<double>").toArrow()
        sent.destroy()
        here, below = slice(first, first + nodes), slice(2 * first + 1, 2 * first + 1 + 2 * nodes)
        for tree, feature, cut, gain, stats in zip(*(best.column(c).to_pylist() for c in ("tree", "feature", "cut", "gain", "stats"))):
            left, whole = np.array(stats).reshape(plan.parts, 2, nodes).transpose(1, 2, 0)
            grown.feature[tree, here], grown.cut[tree, here], grown.gain[tree, here] = feature, cut, gain
            grown.stats[tree, here] = whole
            grown.stats[tree, below] = np.stack([left, whole - left], axis=1).reshape(2 * nodes, plan.parts)
        if not (grown.feature[:, here] >= 0).any():
            break
    return grown


def _route(plan: Plan, sent, level: int, trees: range, train: bool):
    """The rows of every block, one piece for each tree and node they have come to; in training those of the bootstrap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grown, last = sent.value, ("labels", "times") if train else ("places",)
        for batch in batches:
            held = [batch.column(c).to_pylist() for c in ("number", "rows", "cells", "labels" if train else "rows")]
            for number, n, flat, y in zip(*held):
                flat = np.frombuffer(flat, np.uint8)
                for tree in trees:
                    drawn = draws(plan.seed, tree, number, n) if train else None
                    rows = np.flatnonzero(drawn) if train else np.arange(n)
                    node = grown.leaves(tree, flat, n, rows, level)
                    order = np.argsort(node, kind="stable")
                    pieces = np.split(rows[order], np.flatnonzero(np.diff(node[order])) + 1) if len(rows) else []
                    own = [[np.frombuffer(y)[p].tobytes(), drawn[p].tobytes()] if train else [p.astype(np.int32).tobytes()]
                           for p in pieces]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([tree] * len(pieces), pa.int32()), pa.array(np.unique(node), pa.int32()),
                        pa.array([number] * len(pieces), pa.int64()),
                        pa.array([flat.reshape(plan.size, n)[:, p].tobytes() for p in pieces], pa.binary()),
                        *(pa.array([x[i] for x in own], pa.binary()) for i in range(len(last)))],
                        names=["tree", "node", "number", "cells", *last])

    return run


def _sums(key: np.ndarray, most: int, weights: tuple[np.ndarray, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The keys that occur, ascending, and the sums of the weights of each."""
    if most <= 2 * len(key):
        sums = [np.bincount(key, w, most) for w in weights]
        found = np.flatnonzero(sums[0])
        return found, [s[found] for s in sums]
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], [np.add.reduceat(w[order], first) for w in weights]


def subtree(plan: Plan, cells: np.ndarray, y: np.ndarray, times: np.ndarray, levels: float, draw: np.random.Generator) -> dict:
    """A regression tree of (feature, row) cells, level by level: as arrays by node, the children of a node side by side.

    A node is a leaf where no feature can split it, not only none of those drawn for it, as otherwise no tree grows out.
    """
    feature, cut, child, value, gains = [], [], [], [], np.zeros(plan.size)
    rows, node, nodes, known, level = np.arange(len(y)), np.zeros(len(y), np.intp), 1, 1, 0
    while nodes:
        w = times[rows]
        n = np.bincount(node, w, nodes)
        mean = np.bincount(node, w * y[rows], nodes) / n
        off = y[rows] - mean[node]
        spread = np.bincount(node, w * off * off, nodes) / n
        here = np.full(nodes, -1, np.int16), np.zeros(nodes, np.uint8), np.zeros(nodes, np.int32)
        # Only nodes that may be split go on, numbered anew.
        open_ = (n >= 2 * plan.leaf) & (spread > 1e-12) & (level < levels)
        old, number = np.flatnonzero(open_), np.cumsum(open_) - 1
        stay = open_[node]
        rows, node, w, off = rows[stay], number[node[stay]], w[stay], off[stay]
        top, total = np.zeros((3, len(old))), n[old]
        asked = draw.random((len(old), plan.size)).argsort(axis=1)
        for slot in range(plan.size if len(old) else 0):
            at, r, ww, moves = node, rows, w, off
            # Nodes that none of their features can split look on in the others.
            todo = np.flatnonzero(top[0] <= (np.inf if slot < plan.take else 1e-12) * total)
            if not len(todo):
                break
            if len(todo) < len(old):
                number = np.full(len(old), -1)
                number[todo] = np.arange(len(todo))
                stay = np.flatnonzero(number[node] >= 0)
                at, r, ww, moves = number[node[stay]], rows[stay], w[stay], off[stay]
            found, (left, moved) = _sums(at * BINS + cells[asked[todo[at], slot], r], len(todo) * BINS, (ww, ww * moves))
            owner = found // BINS
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            left, moved = (c - np.concatenate([[0], c])[first][owner] for c in (left.cumsum(), moved.cumsum()))
            right = total[todo][owner] - left
            may = (left >= plan.leaf) & (right >= plan.leaf)
            # Deviations from the mean add up to zero, so the other side's sum is the negative of this one's.
            gain = np.where(may, moved**2 * (1 / left + 1 / np.where(may, right, 1)), -1.0)
            most = np.maximum.reduceat(gain, first)
            cuts = np.flatnonzero(gain == most[owner])
            cuts = cuts[np.unique(owner[cuts], return_index=True)[1]]
            better = most > top[0, todo]
            top[:, todo[better]] = most[better], asked[todo[better], slot], found[cuts[better]] % BINS
        split = top[0] > 1e-12 * total
        parents = old[split]
        here[0][parents], here[1][parents] = top[1, split], top[2, split]
        here[2][parents] = known + 2 * np.arange(len(parents))
        gains += np.bincount(top[1, split].astype(np.intp), top[0, split], plan.size)
        for held, new in zip((feature, cut, child, value), (*here, mean)):
            held.append(new)
        stay = split[node]
        rows, node = rows[stay], node[stay]
        right = cells[top[1].astype(np.intp)[node], rows] > top[2][node]
        node = 2 * (np.cumsum(split) - 1)[node] + right
        nodes, level = 2 * len(parents), level + 1
        known += nodes
    return {"feature": np.concatenate(feature), "cut": np.concatenate(cut), "child": np.concatenate(child),
            "value": np.concatenate(value), "gains": gains}


def _finish(plan: Plan, depth: float):
    """The subtree of one tree's node, from its rows of all blocks."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        tree, node = (table.column(c)[0].as_py() for c in ("tree", "node"))
        cells, y, times = (table.column(c).to_pylist() for c in ("cells", "labels", "times"))
        cells = np.concatenate([np.frombuffer(c, np.uint8).reshape(plan.size, -1) for c in cells], axis=1)
        above = (node + 1).bit_length() - 1
        grown = subtree(plan, cells, np.frombuffer(b"".join(y)), np.frombuffer(b"".join(times), np.uint8).astype(float),
                        depth - above, np.random.default_rng([plan.seed, tree, above, node]))
        return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int32()),
                         **{c: pa.array([grown[c].tobytes()], pa.binary()) for c in ("feature", "cut", "child", "value")},
                         "gains": pa.array([grown["gains"].tolist()], pa.list_(pa.float64()))})

    return run


def _descend(size: int):
    """Values of the leaves that the rows of one tree's node come to, by block."""
    def run(asked: pa.Table, grown: pa.Table) -> pa.Table:
        if grown.num_rows:
            feature, cut, child, value = (np.frombuffer(grown.column(c)[0].as_py(), kind) for c, kind in (
                ("feature", np.int16), ("cut", np.uint8), ("child", np.int32), ("value", np.float64)))
        found = []
        for cells in asked.column("cells").to_pylist():
            cells = np.frombuffer(cells, np.uint8).reshape(size, -1)
            at, rows = np.zeros(cells.shape[1], np.intp), np.arange(cells.shape[1])
            while grown.num_rows and len(rows := rows[feature[at[rows]] >= 0]):
                here = at[rows]
                at[rows] = child[here] + (cells[feature[here], rows] > cut[here])
            found.append((value[at] if grown.num_rows else np.zeros(len(at))).tobytes())
        return asked.select(["number", "places"]).append_column("found", pa.array(found, pa.binary()))

    return run


def _add_up(table: pa.Table) -> pa.Table:
    """Sums over all trees of a block's rows, by their places."""
    places, found = (b"".join(table.column(c).to_pylist()) for c in ("places", "found"))
    total = np.bincount(np.frombuffer(places, np.int32), np.frombuffer(found))
    return pa.table({"number": table.column("number").slice(0, 1), "total": pa.array([total.tobytes()], pa.binary())})


def _means(centre: float, trees: int):
    """Numbers of rows and their predictions, from the sums of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for totals, numbers in zip(batch.column("totals").to_pylist(), batch.column("labels").to_pylist()):
                value = centre + sum(np.frombuffer(t) for t in totals) / trees
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(numbers).astype(np.int64)), pa.array(value)],
                                                 names=["_row", "prediction"])

    return run


def rounds(count: int, plan: Plan, trees: int) -> list[range]:
    """Trees whose rows are dealt at once: the shuffled bytes are bounded, whatever the rows and trees."""
    step = max(1, ROUND_BYTES // max(1, count * (plan.size + 9)))
    return [range(a, min(a + step, trees)) for a in range(0, trees, step)]


def finished(blocks: DataFrame, top: Trees, plan: Plan, level: int, depth: float, count: int, trees: int) -> DataFrame:
    """The subtrees below the ``top`` levels as a table, one row for each tree and node."""
    parts, sent = [], blocks.sparkSession.sparkContext.broadcast(Trees(top.feature, top.cut))
    for some in rounds(count, plan, trees):
        dealt = blocks.mapInArrow(_route(plan, sent, level, some, True),
                                  "tree int, node int, number long, cells binary, labels binary, times binary")
        parts.append(materialise(dealt.groupBy("tree", "node").applyInArrow(
            _finish(plan, depth),
            "tree int, node int, feature binary, cut binary, child binary, value binary, gains array<double>")))
    sent.destroy()
    return reduce(DataFrame.unionByName, parts)


class Forest(Estimator):
    """A forest of ``trees`` trees over the column ``features``: of the classes 0 .. k - 1, balanced, or of a number.

    Without a ``depth`` trees of a number grow until no node can be split. Wide vectors, and trees of classes beyond the
    bound above, go to ``wide``, Spark's forest of the same parameters.
    """

    def __init__(self, wide: Estimator, label: str, trees: int, depth: int | None, leaf: int = 1, seed: int = 42,
                 classes: bool = False):
        super().__init__()
        self.wide, self.label, self.trees, self.depth = wide, label, trees, depth
        self.leaf, self.seed, self.classes = leaf, seed, classes

    def _fit(self, df: DataFrame) -> Model:
        head = df.select("features").first()
        depth = math.inf if self.depth is None else self.depth
        if head is None or not 1 <= depth <= (MOST_DEPTH if self.classes else math.inf) or head[0].size > MOST_FEATURES:
            return self.wide.fit(df)
        size, centre, weights = head[0].size, 0.0, None
        known = df.filter(F.col(self.label).isNotNull())
        rows = materialise(known.select(vector_to_array("features").alias("x"), F.col(self.label).cast("double").alias("y")))
        if self.classes:
            found = {int(r["y"]): r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
            count = sum(found.values())
            weights = tuple(count / (len(found) * found[c]) if c in found else 0.0 for c in range(max(2, max(found) + 1)))
            take = math.ceil(math.sqrt(size))
        else:
            count, centre = rows.agg(F.count(F.lit(1)), F.avg("y")).first()
            take = math.ceil(size / 3)
        cuts = thresholds(rows, size)
        # One part per core, more where a task would hold too much.
        parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-count * (size + 8) // TASK_BYTES))
        blocks = blocks_of(rows.withColumn("y", F.col("y") - F.lit(centre)), cuts).repartition(parts).persist()
        plan = Plan(size, take, self.leaf, self.seed, weights)
        try:
            if depth > MOST_DEPTH:
                level = min(MOST_DEPTH, max(0, math.ceil(math.log2(max(1, count) / SUBTREE_ROWS)) + 1))
                top = grow(blocks, plan, self.trees, level)
                below = finished(blocks, top, plan, level, depth, count, self.trees)
                return DeepForestModel(top, below, plan, cuts, centre, level)
            return ForestModel(grow(blocks, plan, self.trees, self.depth), plan, cuts, centre, self.depth)
        finally:
            blocks.unpersist()


class ForestModel(Model):
    def __init__(self, trees: Trees, plan: Plan, cuts: list[np.ndarray], centre: float, depth: int):
        super().__init__()
        self.trees, self.plan, self.cuts, self.centre, self.depth = trees, plan, cuts, centre, depth

    @property
    def featureImportances(self) -> DenseVector:
        """Weighted gains by feature, each tree's adding up to one, as Spark's forests have them."""
        total = np.zeros(self.plan.size)
        for feature, gain in zip(self.trees.feature, self.trees.gain):
            one = np.bincount(feature[feature >= 0], gain[feature >= 0], self.plan.size)
            total += one / one.sum() if one.sum() > 0 else 0
        return Vectors.dense(total / total.sum() if total.sum() > 0 else total)

    def _values(self) -> np.ndarray:
        """(tree, node, class) shares, or (tree, node, 1) means."""
        stats = self.trees.stats
        if self.plan.weights:
            total = stats.sum(axis=2, keepdims=True)
            return np.divide(stats, total, out=np.zeros_like(stats), where=total > 0)
        n = stats[..., :1]
        return self.centre + np.divide(stats[..., 1:2], n, out=np.zeros_like(n), where=n > 0)

    def _mean(self, features: Column) -> Column:
        trees, cuts, depth, values = self.trees, self.cuts, self.depth, self._values()

        @F.pandas_udf("array<double>")
        def mean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                cells = binned(np.stack(x.to_numpy()), cuts).ravel() if len(x) else np.zeros(0, np.uint8)
                rows = np.arange(len(x))
                total = np.zeros((len(x), values.shape[2]))
                for tree in range(len(values)):
                    total += values[tree][trees.leaves(tree, cells, len(x), rows, depth)]
                yield pd.Series(list(total / max(len(values), 1)))

        return mean(features)

    def _transform(self, df: DataFrame) -> DataFrame:
        scored = df.withColumn("_mean", self._mean(vector_to_array("features")))
        if not self.plan.weights:
            return scored.withColumn("prediction", F.col("_mean")[0]).drop("_mean")
        return scored.withColumn("probability", array_to_vector("_mean")).withColumn(
            "prediction", (F.array_position("_mean", F.array_max("_mean")) - 1).cast("double")).drop("_mean")


class DeepForestModel(Model):
    """A regression forest whose trees go on below ``level`` levels in the table ``below``."""

    def __init__(self, top: Trees, below: DataFrame, plan: Plan, cuts: list[np.ndarray], centre: float, level: int):
        super().__init__()
        self.top, self.below, self.plan, self.cuts, self.centre, self.level = top, below, plan, cuts, centre, level

    @property
    def featureImportances(self) -> DenseVector:
        """Weighted gains by feature, each tree's adding up to one."""
        gains = np.zeros((len(self.top.feature), self.plan.size))
        for tree, (feature, gain) in enumerate(zip(self.top.feature, self.top.gain)):
            gains[tree] = np.bincount(feature[feature >= 0], gain[feature >= 0], self.plan.size)
        each = self.below.select("tree", F.posexplode("gains")).groupBy("tree", "pos").agg(F.sum("col").alias("gain"))
        for r in each.collect():
            gains[r["tree"], r["pos"]] += r["gain"]
        whole = gains.sum(axis=1, keepdims=True)
        total = np.divide(gains, whole, out=np.zeros_like(gains), where=whole > 0).sum(axis=0)
        return Vectors.dense(total / total.sum() if total.sum() > 0 else total)

    def _transform(self, df: DataFrame) -> DataFrame:
        rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()))
        # The number of a row goes where a label would be; doubles hold it exactly for 2^20 partitions.
        each = rows.select(vector_to_array("features").alias("x"), F.col("_row").cast("double").alias("y"))
        blocks, trees, parts = materialise(blocks_of(each, self.cuts)), len(self.top.feature), []
        sent = df.sparkSession.sparkContext.broadcast(Trees(self.top.feature, self.top.cut))
        for some in rounds(rows.count(), self.plan, trees):
            asked = blocks.mapInArrow(_route(self.plan, sent, self.level, some, False),
                                      "tree int, node int, number long, cells binary, places binary")
            grown = self.below.drop("gains").filter(F.col("tree").between(some[0], some[-1]))
            found = asked.groupBy("tree", "node").cogroup(grown.groupBy("tree", "node")).applyInArrow(
                _descend(self.plan.size), "number long, places binary, found binary")
            parts.append(materialise(found.groupBy("number").applyInArrow(_add_up, "number long, total binary")))
        sent.destroy()
        sums = reduce(DataFrame.unionByName, parts).groupBy("number").agg(F.collect_list("total").alias("totals"))
        mean = sums.join(blocks.select("number", "labels"), "number").mapInArrow(
            _means(self.centre, trees), "_row long, prediction double")
        return rows.join(mean, "_row", "left").drop("_row")
