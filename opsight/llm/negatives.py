"""Hard negatives by maximum inner product in STR-packed R-trees, best box first.

1. Components become floor(scale * x), so that scores are whole numbers and ties are real ones. Rows are dealt by ranges of
   (label, first component, key) into slots, and cut into tiles of one label and at most TILE rows: the first cut of
   sort-tile-recursive packing. A hot label thus has many tiles, also where all its vectors are equal.
2. A tile is packed further by the next components into leaves of LEAF rows, and FANOUT boxes make the box above. For an
   anchor, a box gives an interval of inner products, the sum of the intervals of its components.
3. A queue takes the box of the highest bound first. A box is left out where it lies outside every score window still open
   or strictly below the kth best of each, or at it with larger keys only.
4. Anchors meet tiles by (slot, chunk of anchors): first those of their own label, for the positives, then those of others
   with one window per positive. The best of each tile are merged by Spark.

Defined cases: a row without key, label or vector, or with a NULL or non-finite component, takes no part. A shorter vector is
read with zeros at its end; empty ones score 0. Rows that repeat a key are rows of their own, but none is a positive of an
anchor with that key; an anchor that comes twice is asked twice. Ties go to the smaller key. An empty table gives no rows. Only
the three named columns are read, so other names do not matter. Scores must fit 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heappop, heappush, heapreplace
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from opsight.session import materialise

SCALE = 256
TILE, LEAF, FANOUT, CHUNK = 8192, 128, 16, 2048
POSITIVES, NEGATIVES = 5, 3
#: The window of a negative's score, in percent of the positive's.
LOW, HIGH = 50, 95
NEVER = 1 << 62


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as a matrix of 64-bit integers, filled with zeros at the end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    found = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    found[np.arange(found.shape[1]) < sizes[:, None]] = values
    return found


def packed_order(ids: np.ndarray, vectors: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort-tile-recursive order of the rows, and the places where leaves begin."""
    order, starts, done = [], [], 0
    todo = [(np.arange(len(ids)), 0)]
    while todo:
        rows, axis = todo.pop()
        pages = -(-len(rows) // leaf)
        if pages <= 1:
            order.append(rows)
            starts.append(done)
            done += len(rows)
            continue
        last = vectors.shape[1] - axis <= 1
        slabs = pages if last else int(np.ceil(pages ** (1 / (vectors.shape[1] - axis))))
        size = -(-pages // slabs) * leaf
        by = vectors[rows, axis] if vectors.shape[1] else ids[rows]
        rows = rows[np.lexsort((ids[rows], by))]
        cuts = [rows[i:i + size] for i in range(0, len(rows), size)]
        todo += [(cut, axis if last else axis + 1) for cut in reversed(cuts)]
    return np.concatenate(order), np.array(starts)


class Tree:
    """Boxes over packed rows, a level per step: least and greatest components and the least key of each box."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, fanout: int = FANOUT):
        order, starts = packed_order(ids, vectors, leaf)
        self.ids, self.vectors = ids[order], vectors[order]
        edges = np.append(starts, len(ids))
        lo, hi, least = (f.reduceat(x, starts, axis=0) for f, x in
                         ((np.minimum, self.vectors), (np.maximum, self.vectors), (np.minimum, self.ids)))
        self.levels = [(edges, lo, hi, least)]
        while len(lo) > 1:
            starts = np.arange(0, len(lo), fanout)
            edges = np.append(starts, len(lo))
            lo, hi, least = (f.reduceat(x, starts, axis=0) for f, x in ((np.minimum, lo), (np.maximum, hi), (np.minimum, least)))
            self.levels.append((edges, lo, hi, least))

    def search(self, anchor: np.ndarray, windows: list[tuple[int, int]], k: int, own: int) -> list[list[tuple[int, int]]]:
        """For each window of scores the k best rows as (score, key), best first; rows with the key `own` are left out."""
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        # A heap per window, the worst of the best on top: (score, -key).
        best: list[list[tuple[int, int]]] = [[] for _ in windows]

        def wanted(j: int, low: int, high: int, least: int) -> bool:
            a, b = windows[j]
            high = min(high, b)
            if high < a or low > b:
                return False
            return len(best[j]) < k or (high, -least) > best[j][0]

        def boxes(level: int, first: int, end: int) -> Iterator[tuple[int, int, int, int, int]]:
            _, lo, hi, least = self.levels[level]
            highs, lows = hi[first:end] @ up + lo[first:end] @ down, lo[first:end] @ up + hi[first:end] @ down
            for i, (high, low) in enumerate(zip(highs.tolist(), lows.tolist()), first):
                yield -int(high), int(least[i]), int(low), level, i

        queue = list(boxes(len(self.levels) - 1, 0, 1))
        while queue:
            high, least, low, level, i = heappop(queue)
            high = -high
            open_ = [j for j in range(len(windows)) if wanted(j, low, high, least)]
            if not open_:
                continue
            edges = self.levels[level][0]
            first, end = int(edges[i]), int(edges[i + 1])
            if level:
                for box in boxes(level - 1, first, end):
                    if any(wanted(j, box[2], -box[0], box[1]) for j in open_):
                        heappush(queue, box)
                continue
            scores, ids = self.vectors[first:end] @ anchor, self.ids[first:end]
            for j in open_:
                a, b = windows[j]
                floor = max(a, best[j][0][0]) if len(best[j]) == k else a
                on = np.flatnonzero((scores >= floor) & (scores <= b) & (ids != own))
                if len(on) > k:
                    on = on[np.lexsort((ids[on], -scores[on]))[:k]]
                for score, key in zip(scores[on].tolist(), ids[on].tolist()):
                    if len(best[j]) < k:
                        heappush(best[j], (int(score), -key))
                    elif (int(score), -key) > best[j][0]:
                        heapreplace(best[j], (int(score), -key))
        return [[(s, -key) for s, key in sorted(found, reverse=True)] for found in best]


def exact(*sides: np.ndarray) -> type:
    """Floats where no sum of products can leave their 53 bits, whole numbers otherwise."""
    widest = sides[0].shape[1]
    for side in sides:
        widest *= int(np.abs(side).max(initial=1)) + 1
    return np.float64 if widest < 1 << 53 else np.int64


def tiles(rows: DataFrame, slots: int) -> DataFrame:
    """Tiles: slot, label, ids (64 bit), width and cells (numbers of the type `kind`)."""
    dealt = rows.repartitionByRange(slots, "label", F.get("v", F.lit(0)), "key") \
        .sortWithinPartitions("label", F.get("v", F.lit(0)), "key")
    label_kind = dict(rows.dtypes)["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, held, label, shape = TaskContext.get().partitionId(), [], None, None

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            cells = matrix(table.column("v"))
            kind = np.result_type(*(np.min_scalar_type(x) for x in (cells.min(initial=-1), cells.max(initial=0))))
            ids = table.column("key").to_numpy().astype("<i8")
            return pa.RecordBatch.from_arrays(
                [pa.array([slot], pa.int32()), pa.array([label], shape), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([cells.shape[1]], pa.int32()), pa.array([cells.astype(kind).tobytes()], pa.binary()),
                 pa.array([kind.str])], names=["slot", "label", "ids", "width", "cells", "kind"])

        count = 0
        for batch in batches:
            shape = batch.schema.field("label").type
            at = 0
            for value, group in groupby(batch.column("label").to_pylist()):
                end = at + sum(1 for _ in group)
                while at < end:
                    if held and (value != label or count >= TILE):
                        yield flush()
                        held, count = [], 0
                    label, size = value, min(end - at, TILE - count)
                    held.append(batch.slice(at, size))
                    at, count = at + size, count + size
        if held:
            yield flush()

    return dealt.mapInArrow(run, f"slot int, label {label_kind}, ids binary, width int, cells binary, kind string")


def _answers(same: bool, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Best rows of the tiles of a slot for the anchors of a chunk: (q, j, id, score), j the number of the window."""

    def run(held: pa.Table, asked: pa.Table) -> pa.Table:
        found: dict[tuple[int, int], list[tuple[int, int]]] = {}
        q, own, label, windows = (asked.column(c).to_pylist() for c in ("q", "key", "label", "windows"))
        anchors = matrix(asked.column("v"))
        for tile in held.to_batches(max_chunksize=1):
            row = {c: tile.column(c)[0].as_py() for c in tile.schema.names}
            on = [i for i in range(len(q)) if (label[i] == row["label"]) == same]
            if not on:
                continue
            ids = np.frombuffer(row["ids"], "<i8")
            cells = np.frombuffer(row["cells"], row["kind"]).reshape(len(ids), row["width"]).astype(np.int64)
            kind = exact(cells, anchors[:, :row["width"]])
            tree = Tree(ids, cells.astype(kind))
            narrow = np.zeros((len(q), row["width"]), kind)
            both = min(row["width"], anchors.shape[1])
            narrow[:, :both] = anchors[:, :both]
            for i in on:
                bounds = [(w["low"], w["high"]) for w in windows[i]]
                for j, best in enumerate(tree.search(narrow[i], bounds, k, own[i])):
                    if best:
                        found.setdefault((q[i], j), []).extend((-s, key) for s, key in best)
        rows = [(*ask, key, -s) for ask, best in found.items() for s, key in sorted(best)[:k]]
        cols = zip(*rows) if rows else [[]] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        return pa.table({c: pa.array(v, t) for c, v, t in zip(("q", "j", "id", "score"), cols, kinds)})

    return run


def _best(held: DataFrame, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """The k best of all tiles for each anchor and window: q, j, rank, id, score."""
    part = held.groupBy("slot", "chunk").cogroup(asked.groupBy("slot", "chunk")) \
        .applyInArrow(_answers(same, k), "q long, j int, id long, score long")
    order = Window.partitionBy("q", "j").orderBy(F.desc("score"), "id")
    return part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding",
                   label: str = "label", scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the best rows of other labels with a score in the window.

    `is_anchor` is a condition on the table's columns. Columns: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    cells = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale))
    rows = embeddings.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull()
                             & F.forall(F.col(vector), lambda x: finite(x.cast("double")))) \
        .select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), cells.alias("v"),
                F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    packed = materialise(tiles(rows.select("key", "label", "v"), max(1, -(-rows.count() // TILE))))
    anchors = materialise(rows.filter("anchor").select(F.monotonically_increasing_id().alias("q"), "key", "label", "v"))
    chunks = max(1, -(-anchors.count() // CHUNK))
    anchors = anchors.withColumn("chunk", F.pmod(F.xxhash64("q"), F.lit(chunks)).cast("int"))
    slots = packed.agg(F.max("slot")).first()[0] or 0
    held = packed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    window = lambda a, b: F.struct(a.cast("long").alias("low"), b.cast("long").alias("high"))

    own = packed.select("label", F.col("slot").alias("of")).distinct().withColumnRenamed("of", "slot")
    asked = anchors.join(own, "label").withColumn("windows", F.array(window(F.lit(-NEVER), F.lit(NEVER))))
    found = _best(held, asked, True, positives).select("q", "rank", F.col("id").alias("positive_id"),
                                                       F.col("score").alias("positive_score"))
    # 100 s >= low p and 100 s <= high p; hundreds are divided without a rest, so that no rounding enters.
    p, hundreds = F.col("positive_score"), lambda x: (x - F.pmod(x, F.lit(100))) / 100
    pairs = materialise(found.withColumn("w", window(-hundreds(-p * low), hundreds(p * high))))
    listed = pairs.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("rank", "w"))).alias("windows")) \
        .select("q", F.col("windows.w").alias("windows"))
    asked = anchors.join(listed, "q").withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots))))
    best = _best(held, asked, False, negatives).withColumnsRenamed({"rank": "place", "id": "negative_id", "score": "negative_score"})
    return best.join(pairs.select("q", (F.col("rank") - 1).alias("j"), "positive_id", "positive_score"), ["q", "j"]) \
        .join(anchors.select("q", F.col("key").alias("anchor_id")), "q") \
        .select("anchor_id", "positive_id", F.col("place").alias("rank"), "negative_id", "positive_score", "negative_score")
