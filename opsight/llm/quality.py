"""Quality rules: repetition and symbol counts of whole texts, then a calibrated logistic regression on hashed n-grams.

Words are runs of [^\\x20\\x09-\\x0D]. The model sees a text's words, word pairs and 4-grams of its code points, hashed into
2^BITS columns each and divided by the number of words and of code points. It is trained on a bounded sample of labelled rows,
calibrated on a part of them kept out of training (Platt), and scored in Arrow batches against the fixed threshold KEEP.

Defined cases: a NULL or empty text has zero counts, fails the base rule and gets the prior as its score. Rows without
label or with a label other than 0 and 1 are not learnt from; without labelled rows of both kinds the score is 0.5 or the
only label and the base rule alone decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from opsight.llm.common import raw, slices, window_hashes, word_hashes
from opsight.llm.linear import Sparse, fit, platt, sigmoid

BITS = 20
COLUMNS = 3 << BITS  # words, word pairs, 4-grams of code points
#: The bounded sample: labelled rows, of which every fifth calibrates.
SAMPLE_ROWS = 2_000
STEPS = 40
L2 = 1e-6
SCALE = 8.0
KEEP = 0.5
#: Fixed values of the base rule.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def features(texts: list[bytes], hashes: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(column, text number) of every word, of every pair of neighbouring words and of every 4-gram of code points."""
    drop = np.uint64(64 - BITS)
    owner = np.repeat(np.arange(len(texts)), counts)
    pair, at = window_hashes(hashes, counts, 2)
    # The line end after each text counts as its last code point.
    joined = b"\n".join(texts) + b"\n"
    whole = np.frombuffer(joined.decode().encode("utf-32-le"), "<u4").astype(np.uint64)
    starts = np.cumsum((np.frombuffer(joined, np.uint8) & 0xC0) != 0x80)  # code points up to each byte
    ends = starts[np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))) - 1]
    chars = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    four = whole[:-3]
    for i in range(1, 4):
        four = (four << np.uint64(13)) ^ whole[i:len(whole) - 3 + i]
    inside = chars[:-3] == chars[3:]
    gram = (four[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    return [((hashes >> drop).astype(np.int64), owner), ((pair >> drop).astype(np.int64) + (1 << BITS), owner[at]),
            (gram.astype(np.int64) + (2 << BITS), chars[:-3][inside])]


def repeated_words(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """By text, the words that lie in some 5-word window found at two places or more of that text."""
    windows, at = window_hashes(hashes, counts, WINDOW)
    owner = np.repeat(np.arange(len(counts)), counts)
    keyed = windows ^ (owner[at].astype(np.uint64) << np.uint64(44)) ^ owner[at].astype(np.uint64)
    order = np.argsort(keyed, kind="stable")
    same = keyed[order][1:] == keyed[order][:-1]
    same &= owner[at[order[1:]]] == owner[at[order[:-1]]]
    first = np.zeros(len(hashes), bool)
    first[at[order[1:][same]]] = True
    first[at[order[:-1][same]]] = True
    covered = first.copy()
    for i in range(1, WINDOW):
        covered[i:] |= first[:-i]
    return np.bincount(owner[covered], minlength=len(counts))


def repeated_lines(text: bytes) -> int:
    if b"\n" not in text:
        return 0
    seen, twice = set(), 0
    for line in text.split(b"\n"):
        if line in seen:
            twice += bool(line.strip())  # bytes.strip() takes off the same six separators
        else:
            seen.add(line)
    return twice


@dataclass
class Model:
    weights: np.ndarray  # float32, one for each column
    bias: float
    slope: float = 1.0
    shift: float = 0.0


def _featurise(text: str, label: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, text):
        texts = raw(part, text)
        hashes, counts = word_hashes(texts)
        cols, vals = [[] for _ in texts], [[] for _ in texts]
        for column, owner in features(texts, hashes, counts):
            found, n = np.unique(owner * COLUMNS + column, return_counts=True)
            size = np.maximum(1, np.bincount(owner, minlength=len(texts)))
            edge = np.searchsorted(found, np.arange(len(texts) + 1) * COLUMNS)
            for i in range(len(texts)):
                cols[i].append((found[edge[i]:edge[i + 1]] % COLUMNS).astype(np.int32))
                vals[i].append((n[edge[i]:edge[i + 1]] / size[i]).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [part.column("key"), part.column(label).cast(pa.int32()),
             pa.array([np.concatenate(c) for c in cols], pa.list_(pa.int32())),
             pa.array([np.concatenate(v) for v in vals], pa.list_(pa.float32()))],
            names=["key", "y", "cols", "vals"])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """At most `rows` labelled documents, by the hash of their key: key, the label (0 or 1) and the text."""
    chosen = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()) \
        .select(F.col(key).alias("key"), F.col(label).alias(label)).groupBy("key").agg(F.max(label).alias(label)) \
        .orderBy(F.xxhash64("key"), "key").limit(rows)
    # At most `rows` keys are broadcast, whatever the size of the tables.
    return docs.select(F.col(key).alias("key"), F.col(text)).join(F.broadcast(chosen), "key").select("key", label, text)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text",
          rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most `rows` labelled rows, whose features (not texts) come to the driver."""
    sample = labelled_sample(docs, labels, label, rows, key, text)
    shape = f"key {dict(sample.dtypes)['key']}, y int, cols array<int>, vals array<float>"
    found = sample.mapInArrow(partial(_featurise, text, label), shape).toArrow().sort_by("key")
    y = found.column("y").to_numpy().astype(float)
    sizes = pc.list_value_length(found.column("cols")).to_numpy().astype(np.int64)
    x = Sparse(np.repeat(np.arange(len(y), dtype=np.int32), sizes), pc.list_flatten(found.column("cols")).to_numpy(),
               pc.list_flatten(found.column("vals")).to_numpy() * np.float32(SCALE), len(y), COLUMNS)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(COLUMNS, np.float32), 0.0 if not len(y) else float(8 * (2 * y[0] - 1)))
    used, x.cols = np.unique(x.cols, return_inverse=True)
    x.n_cols = len(used)
    later = np.arange(len(y)) % 5 == 4
    w, b = fit(x.take(~later), y[~later], L2, STEPS)
    slope, shift = platt(x.dot(w)[later] + b, y[later])
    weights = np.zeros(COLUMNS, np.float32)
    weights[used] = w * SCALE
    return Model(weights, b, slope, shift)


def assess(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's base counts, base_failed, quality_score (0 to 1) and kept."""
    read = docs.select(F.col(key), F.col(text).alias("t"))
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)  # COLUMNS floats, whatever the data
    bias, slope, shift = model.bias, model.slope, model.shift

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for part in slices(batches, "t"):
            texts = raw(part, "t")
            hashes, n_words = word_hashes(texts)
            n_chars = pc.fill_null(pc.utf8_length(part.column("t")), 0).to_numpy(zero_copy_only=False)
            z = np.full(len(texts), bias)
            for column, owner in features(texts, hashes, n_words):
                size = np.maximum(1, np.bincount(owner, minlength=len(texts)))
                z += np.bincount(owner, w[column], len(texts)) / size
            p = sigmoid(slope * z + shift)
            repeats = repeated_words(hashes, n_words)
            failed = (n_words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * n_words)
            gaps = np.array([sum(map(t.count, SPACES)) for t in texts], np.int64)
            symbols = np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64)
            counts = (n_words, n_chars - gaps, symbols, np.array([repeated_lines(t) for t in texts], np.int64), repeats)
            yield pa.RecordBatch.from_arrays(
                [part.column(key), *(pa.array(np.asarray(c), pa.int64()) for c in counts), pa.array(failed), pa.array(p),
                 pa.array(~failed & (p >= KEEP))],
                names=[key, *COUNTS, "base_failed", "quality_score", "kept"])

    shape = read.select(key).schema
    for c in COUNTS:
        shape = shape.add(c, "long")
    return read.mapInArrow(run, shape.add("base_failed", "boolean").add("quality_score", "double").add("kept", "boolean"))
