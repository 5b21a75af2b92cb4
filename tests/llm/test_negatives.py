"""Hard negatives against sorting all pairs; the tree's pruning against all rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsight.llm import negatives, queries
from tests.conftest import SF_DIR
from tests.oracle import compare, connect

SHAPE = "vec_id long, embedding array<float>, label int"


def brute(rows, anchors):
    """(anchor, positive, rank, negative, scores) of rows (key, label, whole numbers), all pairs sorted."""
    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for key, label, v in (r for r in rows if r[0] in anchors):
        scored = sorted((-dot(v, w), k, m) for k, m, w in rows if k != key)
        for p, k in [(-s, k) for s, k, m in scored if m == label][:5]:
            fit = [(k2, -s) for s, k2, m in scored if m != label and 50 * p <= -100 * s <= 95 * p]
            out += [(key, k, i, n, p, s) for i, (n, s) in enumerate(fit[:3], 1)]
    return sorted(out)


def found(spark, rows, anchors):
    docs = spark.createDataFrame([(k, [x / 256 for x in v], m) for k, m, v in rows], SHAPE).repartition(3, "vec_id")
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted(tuple(r[c] for c in names) for r in
                  negatives.hard_negatives(docs, F.col("vec_id").isin(list(anchors))).collect())


def test_query_equals_sql(spark):
    verdict, detail = compare(queries.QUERIES["op12_negatives"](spark, SF_DIR), connect(SF_DIR),
                              queries.ORACLE_SQL["op12_negatives"])
    assert verdict == "exact", detail


@pytest.mark.parametrize("seed,spread,dims", [(1, 3, 2), (2, 40, 3), (3, 1, 1), (4, 300, 6)])
def test_small_tiles_ties_and_hot_labels(spark, monkeypatch, seed, spread, dims):
    """Few different scores, a third of all rows equal, one label on half of the rows, several tiles, chunks and leaves."""
    for name, value in (("TILE", 17), ("LEAF", 3), ("FANOUT", 2), ("CHUNK", 4)):
        monkeypatch.setattr(negatives, name, value)
    r = random.Random(seed)
    rows = [(k, 0 if k % 2 else r.randrange(4), [1] * dims if k % 3 == 0 else [r.randint(-spread, spread) for _ in range(dims)])
            for k in r.sample(range(1000), 120)]
    anchors = {k for k, _, _ in rows[::9]}
    assert found(spark, rows, anchors) == brute(rows, anchors)


def test_tree_prunes_and_finds(monkeypatch):
    r = np.random.default_rng(5)
    centres = r.integers(-500, 500, (30, 4))
    vectors = (centres[r.integers(0, 30, 3000)] + r.integers(-10, 10, (3000, 4))).astype(np.int64)
    tree = negatives.Tree(np.arange(3000), vectors, leaf=16, fanout=4)
    edges = tree.levels[0][0]
    assert edges[-1] == 3000 and (np.diff(edges) > 0).all() and sorted(tree.ids.tolist()) == list(range(3000))
    seen = []

    class Rows(np.ndarray):
        def __matmul__(self, other):
            seen.append(len(self))
            return np.asarray(self) @ other

    tree.vectors = tree.vectors.view(Rows)
    for anchor in vectors[::300]:
        scores = vectors @ anchor
        windows = [(-negatives.NEVER, negatives.NEVER), (int(scores.max() * 0.5), int(scores.max() * 0.95))]
        seen.clear()
        for (a, b), best in zip(windows, tree.search(anchor, windows, 5, own=-1)):
            fit = sorted((-int(s), k) for k, s in enumerate(scores.tolist()) if a <= s <= b)[:5]
            assert best == [(-s, k) for s, k in fit]
        assert sum(seen) < 1500  # most boxes are never opened


def test_rows_that_take_no_part_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(50, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.7, 0.7], 2), (3, [nan, 1.0], 2), (4, [1.0, None], 2), (5, None, 2),
            (6, [inf, 0.0], 1), (7, [0.6, 0.6], None), (None, [0.7, 0.7], 2), (8, [0.9], 3), (9, [], 4), (100, [-1.0], 9)]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SHAPE + ", key int, slot string, q int")
    assert negatives.hard_negatives(docs.limit(0), F.col("vec_id") == 50).collect() == []
    got = negatives.hard_negatives(docs, F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(r) for r in got) == [(50, 1, 1, 2, 2 * 65536, 2 * 256 * 179)]


def test_repeated_rows(spark):
    rows = [(50, [1.0], 1), (50, [1.0], 1), (1, [1.0], 1), (2, [0.75], 2), (2, [0.75], 2)]
    docs = spark.createDataFrame(rows, SHAPE)
    got = sorted(tuple(r) for r in negatives.hard_negatives(docs, F.col("vec_id") == 50).collect())
    assert got == sorted([(50, 1, 1, 2, 65536, 49152), (50, 1, 2, 2, 65536, 49152)] * 2)


def test_large_numbers_stay_whole():
    v = np.array([[1 << 30, 3], [1 << 30, 2]], np.int64)
    assert negatives.exact(v, v) is np.int64
    tree = negatives.Tree(np.array([1, 2]), v)
    assert tree.search(v[0], [(-negatives.NEVER, negatives.NEVER)], 2, -1)[0] == [((1 << 60) + 9, 1), ((1 << 60) + 6, 2)]
