"""Language-model scores against counts and probabilities worked out in plain Python."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opsight.llm import queries, scoring
from opsight.llm.common import table
from tests.conftest import SF_DIR


def tokens_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return ["<start>", *re.findall(r"[^\x20\x09-\x0D]+", lowered), "<end>"]


class Model:
    """The same model from dictionaries, by recursion over shorter histories."""

    def __init__(self, texts, order):
        self.order, self.counts = order, Counter()
        for text in texts:
            w = tokens_of(text)
            for n in range(1, order + 1):
                self.counts.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
        self.words = {g[0]: n for g, n in self.counts.items() if len(g) == 1 and g[0] != "<start>"}
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.once = 1 + sum(n == 1 for n in self.words.values())

    def p(self, history, word):
        if not history:
            return (self.words.get(word, 0) or self.once) / (self.n + self.once)
        shorter, seen = self.p(history[1:], word), self.counts[history]
        if not seen:
            return shorter
        s = scoring.SCALE * seen ** scoring.POWER
        return (self.counts[(*history, word)] + s * shorter) / (seen + s)

    def row(self, text):
        w = tokens_of(text)
        return (len(w) - 1, sum(x in self.words for x in w[1:]), self.n,
                sum(math.log10((self.words.get(x, 0) + 1) / (self.n + self.v + 1)) for x in w[1:]),
                sum(math.log10(self.p(tuple(w[max(0, i - self.order + 1):i]), w[i])) for i in range(1, len(w))))


def check(rows, texts, model):
    assert len(rows) == len(texts)
    for r in rows:
        n_tokens, n_known, n, base, score = model.row(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-12)
        assert r["score"] == pytest.approx(score, rel=1e-9, abs=1e-12)


def test_query_by_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF_DIR, "documents").collect()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    rows = queries.QUERIES["op11_scoring"](spark, SF_DIR).collect()
    check(rows, texts, Model([t for k, t in texts.items() if not held[k]], scoring.ORDER))
    assert all(r["held_out"] == held[r["doc_id"]] for r in rows) and any(held.values())
    unseen = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_orders_batches_and_shards(spark, monkeypatch, order):
    """Many small batches and shards give the same model; failures go down several states at once."""
    monkeypatch.setattr(scoring, "BATCH", 200)
    monkeypatch.setattr(scoring, "SHARD", 300)
    texts = {i: " ".join("abcdefgh"[(i * j + j * j // (i + 1)) % 8] for j in range(20 + 3 * i)) for i in range(30)}
    texts |= {100: None, 101: "", 102: "A b  c\nzz\x1czz", 103: "A b  c\nzz\x1czz"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3, "doc_id")
    rows = scoring.score(docs, F.col("doc_id") % 3 != 0, order=order).collect()
    check(rows, texts, Model([t for k, t in texts.items() if k % 3], order))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_of_a_state_sum_to_one(order):
    model = Model(["a b a c a", "b b a", "", None, "c a b c"], order)
    for history in [(), ("a",), ("b", "a"), ("<start>",), ("x",), ("<start>", "b")]:
        history = history[-(order - 1):] if order > 1 else ()
        assert sum(model.p(history, w) for w in [*model.words, "unknown"]) == pytest.approx(1)


def test_nothing_learnt(spark):
    docs = spark.createDataFrame([(1, "some words"), (None, None)], "doc_id long, text string")
    rows = scoring.score(docs, F.lit(None).cast("boolean")).collect()
    assert {(r["doc_id"], r["n_tokens"], r["score"], r["base_score"], r["train_tokens"]) for r in rows} == {
        (1, 3, 0.0, 0.0, 0), (None, 1, 0.0, 0.0, 0)}


def test_empty_table_and_clashing_names(spark):
    shape = "doc_id long, text string, key int, batch int, words int, k int, shard int, totals int, learnt int"
    rows = [(1, "a b a", 1, 1, 1, 1, 1, 1, 1), (1, "a b a", 2, 2, 2, 2, 2, 2, 2), (2, "b", None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, shape)
    assert scoring.score(docs.limit(0), F.lit(True)).collect() == []
    found = scoring.score(docs, F.lit(True)).collect()
    check(found[:0], {}, None)
    assert [(r["doc_id"], r["n_tokens"]) for r in sorted(found)] == [(1, 4), (1, 4), (2, 2)]
    assert len({r["score"] for r in found if r["doc_id"] == 1}) == 1
