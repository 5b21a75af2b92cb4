"""Periodic runs against a scan of every period."""

import re
import zlib
from fractions import Fraction
from hashlib import sha256

import pytest
from hypothesis import given, settings, strategies as st

from opsight.llm import queries, runs
from opsight.llm.common import table
from tests.conftest import SF_DIR


def brute(w):
    """Runs by comparing words q apart, for every period q."""
    least = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                least.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((*ends, q) for ends, q in least.items())


def expected(key, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(key).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    return (len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


NAMES = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_query_by_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF_DIR, "documents").collect()}
    rows = queries.QUERIES["op13_runs"](spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert tuple(r[c] for c in NAMES) == expected(r["doc_id"], texts[r["doc_id"]])
    assert sum(r["n_runs"] for r in rows) > 5


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 4), st.integers(0, 150), st.lists(st.tuples(st.integers(0, 140), st.integers(1, 20), st.integers(10, 120)),
                                                         max_size=4), st.randoms(use_true_random=False))
def test_random_sequences(letters, n, copies, r):
    w = [r.randrange(letters) for _ in range(n)]
    for start, period, length in copies:
        for i in range(start + period, min(n, start + length)):
            w[i] = w[i - period]
    assert runs.runs(w) == brute(w)


@pytest.mark.parametrize("w", [[0] * 24, [0] * 23, [0] * 500, [0, 1] * 12, [0, 1, 1] * 8, [0, 0, 1] * 40 + [0, 1] * 30,
                               ([0] * 9 + [1]) * 4, list(range(24)) * 3, [*list(range(40)) * 3][:-1], [7] * 30 + [8] * 30])
def test_shapes(w):
    assert runs.runs(w) == brute(w)


def test_long_sequences_are_quick():
    """One word repeated, a phrase between ever new words, and the word of all squares; none is quadratic."""
    n = 60_000
    assert runs.runs([1] * n) == [(0, n, 1)]
    assert runs.runs([f"new{i}" if i % 17 == 0 else i % 17 for i in range(n)]) == []
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    found = runs.runs(b[:n])
    assert len(found) > 1000 and all(m >= 3 * q for _, m, q in found)


def test_floor_of_pairs():
    assert runs.floor_of_pairs() == 16 and runs.floor_of_pairs(10, 3) == min(max(10 - q, 2 * q) for q in range(1, 11))


def test_edges(spark):
    block = " ".join(f"w{i}" for i in range(10))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, f"x {block} {block} {block} y"), (4, f"x {block} {block} {block} y"),
            (None, f"{block}\n{block}\t{block}"), (5, "a " * 100_000)]
    docs = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "doc_id long, text string, key int, start int, words string")
    assert runs.find(docs.limit(0)).collect() == []
    got = {r["doc_id"]: r for r in runs.find(docs, prepare=runs.periodic).collect()}
    empty = sha256(b"").hexdigest()
    for k in (1, 2, 3):
        assert tuple(got[k][c] for c in NAMES) == (0, None, None, None, None, empty, empty)
    assert tuple(got[4][c] for c in NAMES[:5]) == (1, 1, 30, 10, 3000)
    assert got[4]["collapsed_sha256"] == sha256(f"x {block} y".encode()).hexdigest()
    assert tuple(got[None][c] for c in NAMES[:5]) == (1, 0, 30, 10, 3000)
    assert tuple(got[5][c] for c in NAMES[:4]) == (1, 0, 100_000, 1)
    assert len(runs.find(docs).collect()) == len(rows)


def test_odd_keys():
    words = [str(i) for i in range(50)]
    assert runs.periodic(words, None) is words and runs.periodic([], 1) == []
    assert any(runs.periodic(words, k) != words for k in range(40))
    assert runs.longest_power([(5, 30, 10), (9, 60, 20), (20, 40, 10), (30, 80, 20)]) == (20, 40, 10)
