"""Language-model scores of texts by a weighted backoff automaton over smoothed word n-grams.

The model: words are `[^\\x20\\x09-\\x0D]+` with A-Z lowered, a text is its words and one end, and its first word follows a
start, which is itself never predicted. With the counts c of all n-grams of the learning rows, N tokens, V distinct ones and U - 1 of them seen once,
    p(w)     = c(w) / (N + U), and U / (N + U) for the unknown word
    p(w | h) = (c(hw) + s p(w | h')) / (c(h) + s)      where c(h) > 0, else p(w | h'); h' is h without its first word
which sums to 1 over the V tokens and the unknown word. The share of the shorter history follows the number of words that
come after h, which grows as a power of its count: s = SCALE * c(h) ** POWER. Nothing is cut: every n-gram seen counts.

The automaton: each history of up to `order` - 1 words that was seen is a state. A seen n-gram hw is an arc from h with weight
p(w | h) to the longest suffix of hw that is a state; a failure arc leads from h to h' with weight s / (c(h) + s). A text
is read once from left to right: at each word the automaton takes the arc, or fails until there is one; the weights' logarithms
add up to the score.

The work on Spark:
1. Texts are cut into words and numbered in batches of about BATCH bytes. A batch is written as one row: its distinct words'
   hashes and its texts as numbers of words.
2. From each batch the distinct n-grams go, with their learning counts, to shards by ranges of their hash, a block for each
   (batch, shard). So no n-gram has more rows than there are batches, however common it is.
3. A shard adds up the counts and sends every block back with totals in place of counts.
4. A batch meets its totals, builds the part of the automaton that its n-grams can reach and reads its texts.
The data moved are the distinct n-grams of the batches; the driver gets N, V and U.

Words are told apart by 64-bit hashes, longer n-grams by their shard and 48 more bits.

Defined cases: a NULL, empty or blank text is the end alone. Rows that repeat a key are learnt from and scored one by one.
Without learning rows every token has the probability 1. A row whose learning flag is NULL is not learnt from. Very long texts
are held whole by a task. An empty table gives no rows. Only named columns are read, so the names of others do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from opsight.llm.common import mix, raw, slices, word_hashes
from opsight.session import materialise

ORDER = 2
SCALE, POWER = 4.0, 0.75
BATCH, SHARD = 4 << 20, 8 << 20
START, END = np.uint64(1), np.uint64(2)
STEP = np.uint64(0xD6E8FEB86659FD93)


def planes(values: np.ndarray, width: int) -> bytes:
    """The low `width` bytes of the values, all first bytes, then all second ones: equal high bytes pack well."""
    wide = np.ascontiguousarray(values).astype("<u8").view(np.uint8).reshape(-1, 8)
    return np.ascontiguousarray(wide[:, :width].T).tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    part = np.frombuffer(data, np.uint8).reshape(width, -1)
    wide = np.zeros((part.shape[1], 8), np.uint8)
    wide[:, :width] = part.T
    return wide.reshape(-1).view("<u8")


def strength(totals: np.ndarray) -> np.ndarray:
    """How much the shorter history counts for histories seen so often."""
    return SCALE * totals ** POWER


def shard_of(grams: np.ndarray, shards: int) -> np.ndarray:
    """Ranges of the hash, so that sorted n-grams lie in the order of their shards."""
    return ((grams >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


@dataclass
class Grams:
    """The distinct n-grams of one order in a batch, sorted by hash, and where they are.

    at: number of the n-gram that ends at each token, -1 where the text has too few before it.
    one: a token at which each n-gram ends.
    """

    hashes: np.ndarray
    at: np.ndarray
    one: np.ndarray


def grams_of(vocabulary: np.ndarray, words: np.ndarray, places: np.ndarray, order: int) -> list[Grams]:
    """N-grams of orders 1 to `order`; `places` counts tokens from each text's start."""
    levels = [Grams(vocabulary, words, np.zeros(0, np.int64))]
    running = vocabulary[words]
    levels[0].one = np.zeros(len(vocabulary), np.int64)
    levels[0].one[words] = np.arange(len(words))
    plain = running
    for k in range(2, order + 1):
        longer = np.zeros(len(plain), np.uint64)
        longer[1:] = mix(running[:-1] * STEP + plain[1:] + np.uint64(k))
        running, inside = longer, np.flatnonzero(places >= k - 1)
        hashes, one, number = np.unique(running[inside], return_index=True, return_inverse=True)
        at = np.full(len(plain), -1, np.int64)
        at[inside] = number
        levels.append(Grams(hashes, at, inside[one]))
    return levels


class Automaton:
    """The states, arcs and failure arcs that a batch's texts can reach.

    A state is a seen n-gram of fewer than `order` words, named by its order and number. Arcs are named by the n-gram that
    they complete: `weight[k]` has those of order k + 1, `back[k]` the failure arcs of the states of order k + 1. At a token,
    the arc of order k exists where the n-gram of that order which ends there was seen, so no search is needed.
    """

    def __init__(self, levels: list[Grams], totals: list[np.ndarray], tokens: int, once: int):
        """`totals` are the learning counts of each order's n-grams; N = `tokens` and U = `once` + 1."""
        p = np.where(totals[0] > 0, totals[0], once + 1) / (tokens + once + 1)
        self.at, self.weight = [g.at for g in levels], [np.log10(p)]
        for k in range(1, len(levels)):
            grams, shorter = levels[k], levels[k - 1]
            on = np.flatnonzero(totals[k] > 0)
            end = grams.one[on]
            history = totals[k - 1][shorter.at[end - 1]]
            s, q = strength(history), np.ones(len(grams.hashes))
            q[on] = (totals[k][on] + s * p[shorter.at[end]]) / (history + s)
            self.weight.append(np.log10(q))
            p = q
        self.back = []
        for counts in totals[:-1]:
            s = strength(np.maximum(counts, 1))
            self.back.append(np.log10(s / (counts + s)))
        # How many words the longest seen n-gram that ends at each token has; those it ends with were seen too.
        self.depth = sum((np.append(counts > 0, False)[g.at].astype(np.int64) for g, counts in zip(levels, totals)))

    def read(self, first: int, end: int) -> float:
        """The log10 probability of the tokens after `first`, where the start stands, to before `end`."""
        most = len(self.at) - 1
        weight = [[], *(w[a[first:end]].tolist() for w, a in zip(self.weight, self.at))]
        back = [[], *(b[a[first:end]].tolist() for b, a in zip(self.back, self.at))]
        depth = self.depth[first:end].tolist()
        total, state = 0.0, min(depth[0], most)
        for i in range(1, len(depth)):
            k, seen = state + 1, depth[i]
            while k > 1 and k > seen:
                k -= 1
                total += back[k][i - 1]
            total += weight[k][i]
            state = seen if seen < most else most
        return total


def numbered(docs: DataFrame, learn: Column, key: str, text: str) -> DataFrame:
    """One row per batch: batch, keys, learnt, sizes (tokens with start and end), vocabulary (hashes), words (numbers)."""
    read = docs.select(F.col(key).alias("key"), F.coalesce(learn, F.lit(False)).alias("learnt"), F.col(text).alias("text"))
    kind = dict(read.dtypes)["key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() << 32) - 1
        keys, learnt, hashes, sizes, held, shape = [], [], [], [], 0, pa.int64()

        def flush() -> pa.RecordBatch:
            counts = np.concatenate(sizes)
            ends = np.cumsum(counts + 2)
            flat = np.zeros(int(ends[-1]), np.uint64)
            inside = np.ones(len(flat), bool)
            inside[ends - 1] = inside[ends - counts - 2] = False
            flat[inside] = np.concatenate(hashes)
            flat[ends - counts - 2], flat[ends - 1] = START, END
            vocabulary, words = np.unique(flat, return_inverse=True)
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([pa.array(keys, shape).to_pylist()], pa.list_(shape)),
                 pa.array([learnt], pa.list_(pa.bool_())), pa.array([(counts + 2).tolist()], pa.list_(pa.int64())),
                 pa.array([vocabulary.tobytes()], pa.binary()), pa.array([planes(words, 4)], pa.binary())],
                names=["batch", "keys", "learnt", "sizes", "vocabulary", "words"])

        for part in slices(batches):
            if not part.num_rows:
                continue
            texts = raw(part)
            found, counts = word_hashes([t.lower() for t in texts])  # bytes.lower() changes A-Z only
            shape = part.schema.field("key").type
            keys += part.column("key").to_pylist()
            learnt += part.column("learnt").to_pylist()
            hashes.append(np.where(found <= END, found + END, found))  # keeps the two marks free
            sizes.append(counts)
            held += sum(map(len, texts))
            if held >= BATCH:
                number += 1
                yield flush()
                keys, learnt, hashes, sizes, held = [], [], [], [], 0
        if keys:
            number += 1
            yield flush()

    return read.mapInArrow(run, f"batch long, keys array<{kind}>, learnt array<boolean>, sizes array<long>, "
                                "vocabulary binary, words binary")


def batch_grams(row: dict, order: int) -> tuple[list[Grams], np.ndarray]:
    """The n-grams of a batch's row and its words."""
    sizes = np.array(row["sizes"], np.int64)
    words = from_planes(row["words"], 4).astype(np.int64)
    first = np.cumsum(sizes) - sizes
    places = np.arange(len(words)) - np.repeat(first, sizes)
    return grams_of(np.frombuffer(row["vocabulary"], np.uint64), words, places, order), words


def requests(batches: DataFrame, order: int, shards: int) -> DataFrame:
    """Blocks (shard, k, batch, grams, counts) of the distinct n-grams of each batch."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                row = {c: part.column(c)[i].as_py() for c in part.schema.names}
                levels, _ = batch_grams(row, order)
                learnt = np.repeat(np.array(row["learnt"], bool), row["sizes"])
                for k, grams in enumerate(levels, 1):
                    used = grams.at[learnt & (grams.at >= 0)]
                    counts = np.bincount(used, minlength=len(grams.hashes))
                    edges = np.searchsorted(shard_of(grams.hashes, shards), np.arange(shards + 1)).tolist()
                    blocks = [(s, a, b) for s, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]
                    width = 8 if k == 1 else 6
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s for s, _, _ in blocks], pa.int64()), pa.array([k] * len(blocks), pa.int32()),
                         pa.array([row["batch"]] * len(blocks), pa.int64()),
                         pa.array([planes(grams.hashes[a:b], width) for _, a, b in blocks], pa.binary()),
                         pa.array([planes(counts[a:b], 4) for _, a, b in blocks], pa.binary())],
                        names=["shard", "k", "batch", "grams", "counts"])

    return batches.drop("keys").mapInArrow(run, "shard long, k int, batch long, grams binary, counts binary")


def _added(table: pa.Table) -> pa.Table:
    """The blocks of one shard and order with totals; the first row has the shard's N, V and words seen once."""
    k = table.column("k")[0].as_py()
    blocks = [from_planes(v, 8 if k == 1 else 6) for v in table.column("grams").to_pylist()]
    counts = np.concatenate([from_planes(v, 4) for v in table.column("counts").to_pylist()]).astype(np.int64)
    grams, number = np.unique(np.concatenate(blocks), return_inverse=True)
    totals = np.zeros(len(grams), np.int64)
    np.add.at(totals, number, counts)
    real = totals[grams != START] if k == 1 else totals[:0]
    edges = np.cumsum([0, *map(len, blocks)]).tolist()
    found, n = totals[number], len(blocks)
    width = 4 if found.max() < 1 << 32 else 8
    return pa.table({
        "batch": table.column("batch"), "k": table.column("k"), "shard": table.column("shard"),
        "width": pa.array([width] * n, pa.int32()),
        "totals": pa.array([planes(found[a:b], width) for a, b in zip(edges, edges[1:])], pa.binary()),
        "tokens": pa.array([int(real.sum())] + [0] * (n - 1), pa.int64()),
        "types": pa.array([int((real > 0).sum())] + [0] * (n - 1), pa.int64()),
        "once": pa.array([int((real == 1).sum())] + [0] * (n - 1), pa.int64())})


def score(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """Per row: key, learnt, n_tokens, n_known, train_tokens, base_score (counts plus one, no history) and score.

    The model learns from the rows for which the condition `learn` holds.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(1, -(-size // SHARD))
    batches = materialise(numbered(docs, learn, key, text), "zstd")
    totals = materialise(requests(batches, order, shards).groupBy("shard", "k").applyInArrow(
        _added, "batch long, k int, shard long, width int, totals binary, tokens long, types long, once long"), "zstd")
    tokens, types, once = totals.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types", "once"))).first()
    kind = dict(docs.select(F.col(key).alias("key")).dtypes)["key"]

    def run(mine: pa.Table, found: pa.Table) -> pa.Table:
        row = {c: mine.column(c)[0].as_py() for c in mine.schema.names if c != "keys"}
        levels, words = batch_grams(row, order)
        counts = []
        for k in range(1, order + 1):
            part = found.filter(pa.compute.equal(found.column("k"), k)).sort_by("shard")
            blocks = [from_planes(v, w) for v, w in zip(part.column("totals").to_pylist(), part.column("width").to_pylist())]
            counts.append(np.concatenate([*blocks, np.zeros(0, np.uint64)]).astype(np.int64))
        automaton = Automaton(levels, counts, tokens, once)
        base = np.log10((counts[0] + 1) / (tokens + types + 1))
        rows, end = [], 0
        for n in row["sizes"]:
            first, end = end, end + n
            text = words[first:end]
            rows.append((n - 1, int((counts[0][text[1:]] > 0).sum()), tokens, math.fsum(base[text[1:]].tolist()),
                         automaton.read(first, end)))
        cols = list(zip(*rows))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        names = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
        return pa.table({"key": mine.column("keys").combine_chunks().flatten(),
                         "learnt": mine.column("learnt").combine_chunks().flatten(),
                         **{c: pa.array(v, t) for c, v, t in zip(names, cols, kinds)}})

    shape = f"key {kind}, learnt boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return batches.groupBy("batch").cogroup(totals.select("batch", "k", "shard", "width", "totals").groupBy("batch")) \
        .applyInArrow(run, shape).withColumnRenamed("key", key)
