"""Vector search and multi-pattern lookup against brute force."""

import random
import re

import numpy as np
import pytest

from opsight.operators import joins as J, retrieval as V
from tests.conftest import SF_DIR

SHAPE = "vec_id long, embedding array<double>"


def exact(queries, base, k):
    """{query id: [(id, distance)]} by all pairs; rows of one query id are ranked together."""
    out = {}
    for q, v in queries:
        for b, w in base:
            n = np.linalg.norm(v) * np.linalg.norm(w)
            out.setdefault(q, []).append((round(1.0 - (np.dot(v, w) / n if n else 0.0), 9), b))
    return {q: [b for _, b in sorted(found)[:k]] for q, found in out.items()}


def ranked(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out


@pytest.fixture(scope="module")
def crowd(spark):
    """A third of the base is one vector; ids of queries repeat and one is NULL."""
    r = np.random.default_rng(3)
    base = [(i, (r.normal(size=6) if i % 3 else np.ones(6)).tolist()) for i in range(300)]
    queries = [(q, r.normal(size=6).tolist()) for q in (5, 5, None, 7, 8, 9)] + [(10, [1.0] * 6), (11, [0.0] * 6)]
    return (queries, base, spark.createDataFrame(queries, "query_id long, embedding array<double>").repartition(3),
            spark.createDataFrame(base, SHAPE).repartition(4, "vec_id"))


@pytest.mark.parametrize("query_block,base_block", [(2, 60), (1, 1000), (1000, 50)])
def test_blocks_give_the_exact_neighbours(crowd, monkeypatch, query_block, base_block):
    monkeypatch.setattr(V, "AT_ONCE", 16)
    queries, base, asked, held = crowd
    assert ranked(V.vector_topk(asked, held, 4, query_block=query_block, base_block=base_block)) == exact(queries, base, 4)


def test_plan_does_not_grow_with_queries(crowd):
    _, _, asked, held = crowd
    size = lambda n: V.vector_topk(asked, held, 4, query_block=n)._jdf.queryExecution().analyzed().toString().count("\n")
    assert size(1) == size(1000)


def test_cells_all_asked_are_exact(crowd):
    queries, base, asked, held = crowd
    centres = V.vector_cells(held, cells=8)
    assert ranked(V.vector_topk_near(asked, held, 4, centres, probe=1.0, query_block=3, base_block=20)) == exact(queries, base, 4)


def test_recall_of_the_cells(spark):
    e = spark.read.parquet(f"{SF_DIR.rsplit('/', 1)[0]}/sf0.1/embeddings.parquet")
    asked = e.filter("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding")
    want = ranked(V.vector_topk(asked, e, 5))
    got = ranked(V.vector_topk_near(asked, e, 5, V.vector_cells(e)))
    assert len(want) > 50
    assert np.mean([len(set(want[q]) & set(got[q])) / 5 for q in want]) >= 0.9


def test_rows_without_whole_vectors(spark):
    base = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [1.0])], SHAPE)
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "query_id long, embedding array<double>")
    assert ranked(V.vector_topk(asked, base, 5)) == {1: [1, 4]}
    assert V.vector_topk(asked, base.limit(0), 5).collect() == V.vector_topk(asked.limit(0), base, 5).collect() == []
    assert V.vector_topk_near(asked, base.limit(0), 5, V.vector_cells(base.limit(0))).collect() == []


def like(text, pattern):
    # Percent signs at the ends add nothing to a search, and would make it quadratic.
    rule = "".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in pattern.strip("%"))
    return re.search(rule, text, re.DOTALL) is not None


PATTERNS = ["disk_full", "100%", "a%b%c", "_", "%", "", "__%__", "ring", "r_ng", "ri%g", "a.b", "(x", "é_", "%full%disk", "zzz_",
            "_disk", "disk_", "b%_c", "\\d", "disk full"]


def test_like_patterns_by_brute_force(spark):
    r = random.Random(4)
    texts = [(i, "".join(r.choices("abc xrig.d(é\n%_", k=r.randint(0, 14)))) for i in range(250)]
    texts += [(900, "disk full"), (901, "disk-full at 100%"), (902, "full then disk"), (903, "a.b (x \\d"), (904, "ring"), (905, None),
              (906, "x" * 1_000_000 + " disk full " + "y" * 1000)]
    got = {}
    held = spark.createDataFrame(texts, "id long, text string").repartition(3)
    wanted = spark.createDataFrame([(p,) for p in PATTERNS], "pattern string")
    for row in J.first_mentions(held, wanted, 5, block_chars=200_000, block_patterns=6).collect():
        got.setdefault(row["pattern"], set()).add(row["id"])
    for p in PATTERNS:
        fit = [i for i, t in sorted(texts) if t is not None and like(t, p)]
        assert set(fit[:5]) <= got.get(p, set()) <= set(fit), p


def test_runbooks_with_wildcards(spark):
    books = spark.createDataFrame([(i, f"svc{i % 4}", s) for i, s in enumerate(
        ["Disk full", "disk-full", "at 100 percent", "100% cpu", None, "net", "disk  full"])],
        "runbook_id long, service_name string, symptoms string")
    asks = spark.createDataFrame([(1, "none", "disk_full"), (2, "none", "100%"), (3, "SVC2", "zzz"), (4, "none", None)],
                                 "request_id long, service_guess string, category string")
    got = {}
    for row in J.match_runbooks(asks, books).collect():
        got.setdefault(row["request_id"], {})[row["runbook_rank"]] = row["runbook_id"]
    assert got == {1: {1: 0, 2: 1}, 2: {1: 2, 2: 3}, 3: {1: 2, 2: 6}, 4: {1: 0, 2: 1, 3: 2, 4: 3, 5: 5}}


def test_a_task_holds_few_distances_at_once():
    """A worker's memory follows the largest table of distances, of which it holds several copies."""
    assert V.QUERY_BLOCK * V.AT_ONCE * 8 <= 1 << 22
