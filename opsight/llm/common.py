"""Helpers shared by the training-data operators: table access, folds, Arrow batches, word hashes, bounded memos."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROWS_PER_SLICE, BYTES_PER_SLICE = 2_000, 1 << 20
MEMO_WORDS = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(key: Column, parts: int, part: int) -> Column:
    """crc32 of the key's text falls on `part` of `parts`; a NULL key falls on none."""
    return F.coalesce(F.crc32(key.cast("string")) % parts == part, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", rows: int = ROWS_PER_SLICE,
           size: int = BYTES_PER_SLICE) -> Iterator[pa.RecordBatch]:
    """Short slices of about `size` bytes of text (one row at least), so that a task holds little beside the batch."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if i > start and (held + n > size or i - start >= rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if batch.num_rows > start or not batch.num_rows:
            yield batch.slice(start)


def strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column's texts; NULL reads as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def raw(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column's UTF-8 bytes; NULL reads as empty. `bytes.split()` cuts at exactly [ \\t-\\r]."""
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


SPACE = re.compile(rb"[\x20\x09-\x0d]")
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_POWERS: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BYTES_PER_SLICE + 4096)
        _POWERS[:] = [np.multiply.accumulate(np.append(np.uint64(1), np.full(size - 1, b, np.uint64)))
                      for b in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(part: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of the bytes from `first` to before `last`.

    Every byte adds its own constant times a power of an odd base, so that sums between two places of a running total give
    a span's polynomial, whatever lies before it.
    """
    up, down = _powers(len(part))
    total = np.zeros(len(part) + 1, np.uint64)
    np.cumsum(mix(np.arange(1, 257, dtype=np.uint64))[part] * up, out=total[1:])
    return mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))


def parts_of(whole: bytes, size: int = BYTES_PER_SLICE) -> Iterator[tuple[int, int]]:
    """(start, end) of consecutive parts of about `size` bytes, cut at white space."""
    at = 0
    while at < len(whole):
        stop = at + size
        if stop < len(whole):
            found = SPACE.search(whole, stop)
            stop = found.start() if found else len(whole)
        yield at, min(stop, len(whole))
        at = stop


def word_spans(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words `[^\\x20\\x09-\\x0D]+` begin and end."""
    gap = np.concatenate([[True], _GAP[part], [True]])
    return np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words `[^\\x20\\x09-\\x0D]+` of the texts in order, and the number of words of each text."""
    whole = b"\n".join(texts)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    hashes, starts = [], []
    for at, stop in parts_of(whole):
        part = np.frombuffer(whole[at:stop], np.uint8)
        first, last = word_spans(part)
        hashes.append(span_hashes(part, first, last))
        starts.append(first + at)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    upto = np.searchsorted(np.concatenate(starts), ends)
    return np.concatenate(hashes), np.diff(upto, prepend=0)


def window_hashes(hashes: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each `size`-word window that lies within one text, and the number of the window's first word."""
    n = max(0, len(hashes) - size + 1)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = (h + hashes[i:i + n]) * np.uint64(0xD6E8FEB86659FD93)
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = owner[:n] == owner[size - 1:]
    return mix(h[inside]), np.flatnonzero(inside)


class Memo(dict):
    """Value of a word, worked out once per worker; forgets everything when it holds too many words."""

    def __init__(self, make: Callable, limit: int = MEMO_WORDS):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.make(word)
        return value
