"""Periodic runs in word sequences by maximal pairs of the LCP-interval tree.

A run is a stretch of at least max(LEAST, EXPONENT * period) words with that smallest period which no neighbouring word
extends. Two equal stretches of L words at distance q <= L that can be extended neither to the left nor to the right (a
maximal pair) span a maximal stretch of L + q words of period q. A run's pair has L >= (EXPONENT - 1) * q, hence at least
`floor_of_pairs()` words, and q <= L / (EXPONENT - 1); no extension is needed.

1. Only texts in which some window of that many words occurs twice can hold such a pair; windows are compared by hash, which
   can let a text through for nothing, never the other way.
2. A text's suffixes are sorted by prefix doubling, common prefixes of neighbours counted, and the LCP-interval tree is
   walked bottom-up. Each interval keeps the sorted places of its suffixes with the class of the word on their left; the
   smaller list is looked up in the larger one, so a place moves at most log2(n) times.
3. Places of an interval of depth L that lie within L / 2 of each other continue one period, so all of them but the first
   have the same word on their left, and all but the last the same on their right. For a place, only the first place of
   the reach to its left and the places to its right that have another class can thus make a maximal pair, and no class
   is listed in full.
4. A stretch of period q also pairs at multiples of q, with the same ends; the least distance is its period.

Defined cases: a NULL or empty text has no words, no runs, and the digests of the empty text. Rows that repeat a key are
done one by one. A row without key is never made periodic by `periodic`. Other columns are not read, so their names do not
matter; an empty table gives no rows. A text is held whole by one task, about 100 bytes a word while it is searched.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsight.llm.common import raw, slices, window_hashes, word_hashes

#: Least number of words of a run, and of its periods. The bounds on places in step 3 need three periods or more.
LEAST, EXPONENT = 24, 3
FIELDS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def floor_of_pairs(least: int = LEAST, exponent: int = EXPONENT) -> int:
    """The fewest words that both sides of a run's pair have: L >= (exponent - 1) q and L + q >= least."""
    return min(max(least - q, (exponent - 1) * q) for q in range(1, least + 1))


def suffixes(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling."""
    n, width = len(symbols), 1
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.zeros(n, np.int64)
        after[:n - width] = rank[width:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[1:] = np.cumsum(np.diff(key[order]) != 0)
        rank = np.empty(n, np.int64)
        rank[order] = new
        width *= 2
        if new[-1] == n - 1 or width >= n:
            return order


def common_prefixes(symbols: list[int], order: list[int]) -> list[int]:
    """Length of the common prefix of each suffix, in order, with the one before it; 0 for the first."""
    n = len(symbols)
    before, found, h = [-1] * n, [0] * n, 0
    for left, right in zip(order, order[1:]):
        before[right] = left
    for i in range(n):
        j = before[i]
        if j < 0:
            h = 0
            continue
        while i + h < n and j + h < n and symbols[i + h] == symbols[j + h]:
            h += 1
        found[i] = h
        h = max(0, h - 1)
    return [found[i] for i in order]


def near_pairs(few: list[int], many: list[int], left: list[int], reach: int) -> Iterator[tuple[int, int]]:
    """Pairs of places, one of each sorted list, within reach of each other and with different words on their left."""
    for p in few:
        at = bisect_left(many, p - reach)
        if at < len(many) and many[at] < p and left[many[at]] != left[p]:
            yield many[at], p
        at = bisect_right(many, p)
        while at < len(many) and many[at] <= p + reach and left[many[at]] != left[p]:
            yield p, many[at]
            at += 1


def maximal_pairs(symbols: list[int], floor: int, ratio: int) -> Iterator[tuple[int, int, int]]:
    """(first place, distance, length L) of the maximal pairs with L >= floor and distance <= L / ratio, for a ratio >= 2."""
    order = suffixes(np.array(symbols)).tolist()
    depths = common_prefixes(symbols, order)
    left = [-1, *symbols[:-1]]
    # Open intervals, outermost first, with the sorted places seen so far; those of depth below the floor are not kept.
    stack: list[tuple[int, list[int]]] = []
    for k, depth in enumerate([*depths[1:], 0]):
        places = [order[k]]
        while stack and stack[-1][0] > depth:  # the suffix belongs to the top interval, which ends here
            top, held = stack.pop()
            yield from _joined(held, places, left, top, ratio)
            places = _merged(held, places)
        if depth < floor:
            continue
        if stack and stack[-1][0] == depth:
            held = stack[-1][1]
            yield from _joined(held, places, left, depth, ratio)
            stack[-1] = (depth, _merged(held, places))
        else:
            stack.append((depth, places))


def _joined(a: list[int], b: list[int], left: list[int], depth: int, ratio: int) -> Iterator[tuple[int, int, int]]:
    few, many = (a, b) if len(a) < len(b) else (b, a)
    for p, q in near_pairs(few, many, left, depth // ratio):
        yield p, q - p, depth


def _merged(a: list[int], b: list[int]) -> list[int]:
    few, many = (a, b) if len(a) < len(b) else (b, a)
    if 16 * len(few) < len(many):
        for p in few:
            insort(many, p)
    else:
        many += few
        many.sort()
    return many


def runs(words: list, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence, by start and period."""
    if len(words) < least:
        return []
    numbers: dict = {}
    symbols = [numbers.setdefault(w, len(numbers)) for w in words]
    periods: dict[tuple[int, int], int] = {}
    for start, q, length in maximal_pairs(symbols, floor_of_pairs(least, exponent), exponent - 1):
        if length + q >= least:
            ends = (start, length + q)
            periods[ends] = min(q, periods.get(ends, q))
    return sorted((*ends, q) for ends, q in periods.items())


def longest_power(found: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The run with the greatest length / period, then the least start and period."""
    best = found[0]
    for run in found[1:]:
        if run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words without those that lie in a run after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, q in found:
        keep[start + q:start + length] = False
    return [w for w, k in zip(words, keep.tolist()) if k] if found else words


def periodic(words: list, key) -> list:
    """The sequence of a key whose crc32 ends in 0, made periodic from a place on; any other as it is."""
    h = None if key is None else zlib.crc32(str(key).encode())
    if h is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def repeats(sequences: list[list[bytes]], size: int) -> np.ndarray:
    """Whether some window of `size` words occurs twice in the sequence; also True for a few by chance."""
    hashes, counts = word_hashes([b" ".join(s) for s in sequences])
    found, at = window_hashes(hashes, counts, size)
    owner = np.repeat(np.arange(len(counts)), counts)[at]
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    twice = (owner[1:] == owner[:-1]) & (found[1:] == found[:-1])
    return np.bincount(owner[1:][twice], minlength=len(sequences)) > 0


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", prepare=None) -> DataFrame:
    """Key, number of runs, the run of greatest exponent (NULL without runs), digests of all runs and of the kept words.

    Words are `[^\\x20\\x09-\\x0D]+`. `prepare(words, key)` may change a sequence first.
    """
    read = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keys = part.column("key").to_pylist()
            sequences = [t.split() for t in raw(part)]
            if prepare:
                sequences = [prepare(s, k) for s, k in zip(sequences, keys)]
            rows = []
            for words, may in zip(sequences, repeats(sequences, floor_of_pairs()).tolist()):
                found = runs(words) if may else []
                start, length, q = longest_power(found) if found else (None, None, None)
                listed = "".join(f"{s},{n},{p}\n" for s, n, p in found)
                rows.append((len(found), start, length, q, 1000 * length // q if found else None,
                             sha256(listed.encode()).hexdigest(), sha256(b" ".join(collapsed(words, found))).hexdigest()))
            cols = zip(*rows) if rows else [[]] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), *(pa.array(c, t) for c, t in zip(cols, kinds))],
                names=["key", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return read.mapInArrow(run, f"key {dict(read.dtypes)['key']}, {FIELDS}").withColumnRenamed("key", key)
