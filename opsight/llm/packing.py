"""Retrieval packing: documents that share rare words fill one another's training windows.

1. Documents are encoded once and written. What fills whole windows is cut from the front of each; the rest is searched.
2. BM25 statistics of the rests (document frequencies of token ids, number, mean length) are counted over all documents.
3. A rest's place comes from its QUERY_TERMS heaviest terms that other rests have too: the two of them that come first in
   a fixed mixed order (min-hashes), then the document's hash, so rests that share heavy terms lie near one another
   whatever the size of the corpus. The line of places is cut into shards of about SHARD_CHARS code points; a term that
   is in more rests than a shard holds is thus cut by the second term, and then by hash.
4. A shard's task builds an inverted index of its rests, weighted with the statistics of all. Each seed in turn asks the
   index with its heaviest terms; the best unused neighbours fill its window. The neighbour that does not fit is cut, and
   what is left of it is the next seed, so that only a shard's last sequence is short; that one is cut at powers of two,
   which need no padding.

A document is its token ids and then the id END. Defined cases: a NULL or empty text is the single id END; rows that
repeat a document are packed one by one; an empty table gives no pieces. Equal scores go to the earlier row of the
shard's order (place, hash, document id), so that a task run again gives the same pieces.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from opsight.llm.common import mix, parts_of, raw, slices, span_hashes, word_spans
from opsight.session import materialise

WINDOW, END = 2048, 1
SHARD_CHARS, SHARD_TOKENS = 6_000_000, 6_000_000
#: What a document weighs in a shard beside its text, so that many short or empty ones are also dealt out.
DOC_CHARS, DOC_TOKENS = 100, 25
QUERY_TERMS, TOP = 24, 64
K1, B = 1.2, 0.75
#: Places read for each shard to find where the line is cut.
SAMPLES = 50
IDS = np.dtype("<u4")


#: What a byte can be: white space, a letter of A-Z in either case, a sign, or anything else.
GAP, LETTER, SIGN, OTHER = range(4)


def _byte_table() -> tuple[np.ndarray, np.ndarray]:
    kind, lower = np.full(256, OTHER, np.uint8), np.arange(256, dtype=np.uint8)
    kind[[9, 10, 11, 12, 13, 32]] = GAP
    for c in range(33, 127):
        if chr(c).isalpha():
            kind[c], lower[c] = LETTER, ord(chr(c).lower())
        elif not chr(c).isdigit() and chr(c) != "'":  # an apostrophe joins some endings, so it stays with its word
            kind[c] = SIGN
    return kind, lower


KIND, LOWER = _byte_table()
#: Two-byte letters of Latin-1: their first byte, and the second bytes of the two signs among them.
LATIN, LATIN_SIGNS = 0xC3, (0x97, 0xB7)


class Encoder:
    """Token ids of texts, worked out once for each piece of a word.

    The tokenizer lowers case, drops white space and cuts between letters and signs, so the ids of a text are those of its
    pieces in turn. A word of Latin letters and signs is cut into runs of either; any other word is one piece. The runs of
    letters still unknown are encoded in one go: each ends with the one token that carries the end mark. Known pieces are
    kept under 64-bit hashes, sorted, with the place of their ids in a pool that starts with END.
    """

    #: Pieces kept, pieces encoded at once, bytes cut at once.
    PIECES, AT_ONCE, PART = 2_000_000, 5_000, 1 << 20

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        self.last[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.kind = np.dtype("<u2") if len(self.last) <= 1 << 16 else IDS
        self._forget()

    def _forget(self) -> None:
        self.known, self.place, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.full(1 << 16, END, self.kind), 1

    def _pieces(self, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The part's bytes in lower case, where its pieces begin and end, and which are runs of letters."""
        kind, lower = KIND[part], LOWER[part]
        pair = np.flatnonzero((part[:-1] == LATIN) & ~np.isin(part[1:], LATIN_SIGNS))
        kind[pair] = kind[pair + 1] = LETTER
        high = pair[part[pair + 1] < 0x9F] + 1
        lower[high] += 0x20
        first, last = word_spans(part)
        other = np.concatenate([[0], np.cumsum(kind == OTHER, dtype=np.int32)])
        whole = other[last] > other[first]
        # Within the other words a run begins where the kind changes.
        owner = np.zeros(len(part) + 1, np.int8)
        owner[first], owner[last] = 1, -1
        inside = np.cumsum(owner, dtype=np.int8)[:-1] > 0
        mixed = np.zeros(len(part) + 1, np.int8)
        mixed[first[whole]], mixed[last[whole]] = 1, -1
        change = np.zeros(len(part), bool)
        change[1:] = (kind[1:] != kind[:-1]) & inside[1:] & inside[:-1] & (np.cumsum(mixed, dtype=np.int8)[1:-1] == 0)
        cut = np.flatnonzero(change)
        begin, end = np.sort(np.concatenate([first, cut])), np.sort(np.concatenate([last, cut]))
        return lower, begin, end, (kind[begin] == LETTER) & (np.cumsum(mixed, dtype=np.int8)[begin] == 0)

    def _learn(self, hashes: np.ndarray, pieces: list[bytes], letters: np.ndarray) -> None:
        """Adds unknown pieces, given in the order of their hashes."""
        found: list = [None] * len(pieces)
        plain = np.flatnonzero(letters).tolist()
        for start in range(0, len(plain), self.AT_ONCE):
            some = plain[start:start + self.AT_ONCE]
            ids = np.array(self.tokenizer.encode(b" ".join([pieces[i] for i in some]).decode(), add_special_tokens=False).ids,
                           self.kind)
            edge = [0, *(np.flatnonzero(self.last[ids]) + 1).tolist()]
            if len(edge) != len(some) + 1 or edge[-1] != len(ids):
                raise ValueError("the tokenizer does not end every word with one end mark")
            for i, a, b in zip(some, edge, edge[1:]):
                found[i] = ids[a:b]
        rest = np.flatnonzero(~letters).tolist()
        for i, got in zip(rest, self.tokenizer.encode_batch_fast([pieces[i].decode() for i in rest], add_special_tokens=False)):
            found[i] = np.array(got.ids, self.kind)
        size = np.fromiter(map(len, found), np.int64, len(found))
        need = self.used + int(size.sum())
        if need > len(self.pool):
            self.pool = np.concatenate([self.pool[:self.used], np.zeros(2 * need - self.used, self.kind)])
        self.pool[self.used:need] = np.concatenate([np.zeros(0, self.kind), *found])
        at = np.searchsorted(self.known, hashes)
        self.known, self.place, self.size = (np.insert(a, at, b) for a, b in (
            (self.known, hashes), (self.place, self.used + np.cumsum(size) - size), (self.size, size)))
        self.used = need

    def _numbers(self, lower: np.ndarray, begin: np.ndarray, end: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, ...]:
        """Place in the pool and number of ids of each piece."""
        hashes, one, number = np.unique(span_hashes(lower, begin, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, hashes)
        new = np.flatnonzero(np.append(self.known, np.uint64(0))[at] != hashes) if len(self.known) else np.arange(len(hashes))
        if len(new):
            data = lower.tobytes()
            self._learn(hashes[new], [data[a:b] for a, b in zip(begin[one[new]].tolist(), end[one[new]].tolist())],
                        letters[one[new]])
            at = np.searchsorted(self.known, hashes)
        return self.place[at][number], self.size[at][number]

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text and END."""
        whole = b"\n".join(texts)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        starts, places, sizes, out = [np.zeros(0, np.int64)], [], [], []
        if len(self.known) > self.PIECES:
            self._forget()
        for at, stop in parts_of(whole, self.PART):
            lower, begin, end, letters = self._pieces(np.frombuffer(whole[at:stop], np.uint8))
            place, size = self._numbers(lower, begin, end, letters)
            starts.append(begin + at)
            places.append(place)
            sizes.append(size)
        upto = np.searchsorted(np.concatenate(starts), ends)
        place = np.insert(np.concatenate([np.zeros(0, np.int64), *places]), upto, 0)
        size = np.insert(np.concatenate([np.zeros(0, np.int64), *sizes]), upto, 1)
        edge = np.cumsum(size)
        ids = self.pool[np.repeat(place - (edge - size), size) + np.arange(edge[-1] if len(edge) else 0)]
        cuts = edge[upto + np.arange(len(upto))]
        for a, b in zip([0, *cuts.tolist()], cuts.tolist()):
            out.append(ids[a:b])
        return out


@lru_cache(maxsize=1)
def encoder(content: str) -> Encoder:
    """One for each worker process; the words it knows serve its later tasks."""
    return Encoder(content)


@dataclass
class Statistics:
    """BM25 statistics of a collection: its document frequencies by token id, its number of pieces, their mean length."""

    df: np.ndarray
    n: int
    mean: float

    @classmethod
    def of(cls, pieces: list[np.ndarray]) -> Statistics:
        _, term, _ = postings(pieces)
        return cls(np.bincount(term), len(pieces), sum(map(len, pieces)) / max(1, len(pieces)))

    def weights(self, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        df = self.df[term]
        norm = K1 * (1 - B + B * sizes / max(1.0, self.mean))
        return (np.log1p((self.n - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + norm[doc])).astype(np.float32)


def postings(pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, term, frequency) of the distinct terms of each piece, ordered by term and piece."""
    flat = np.concatenate(pieces).astype(np.int64) if pieces else np.zeros(0, np.int64)
    key, tf = np.unique((flat << 32) | np.repeat(np.arange(len(pieces)), [len(p) for p in pieces]), return_counts=True)
    return key & 0xFFFFFFFF, key >> 32, tf


def places(pieces: list[np.ndarray], hashes: np.ndarray, known: Statistics) -> np.ndarray:
    """Where each piece lies on the line that is cut into shards: 16 bits for each of two terms and 31 of its hash."""
    doc, term, tf = postings(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    weight = known.weights(doc, term, tf, sizes)
    shared = known.df[term] > 1
    doc, term, weight = doc[shared], term[shared], weight[shared]
    order = np.lexsort((term, -weight, doc))
    doc, term = doc[order], term[order]
    heavy = np.arange(len(doc)) - np.searchsorted(doc, doc) < QUERY_TERMS
    doc, term = doc[heavy], term[heavy]
    code = (mix(term.astype(np.uint64) + np.uint64(1)) >> np.uint64(48)).astype(np.int64)
    order = np.lexsort((code, doc))
    doc, code = doc[order], code[order]
    rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
    found = hashes & 0x7FFFFFFF
    for i, bits in enumerate((47, 31)):
        on = rank == i
        found[doc[on]] |= code[on] << bits
    return found


class Index:
    """BM25 postings of a shard's pieces over token ids, weighted with the statistics of the whole collection."""

    def __init__(self, pieces: list[np.ndarray], known: Statistics):
        self.doc, term, tf = postings(pieces)
        self.terms, self.first, df = np.unique(term, return_index=True, return_counts=True)
        self.last = self.first + df
        self.weight = known.weights(self.doc, term, tf, np.fromiter(map(len, pieces), np.int64, len(pieces)))
        slot = np.repeat(np.arange(len(self.terms)), df)
        # A piece's own terms, heaviest first.
        order = np.lexsort((slot, -self.weight, self.doc))
        self.own = slot[order]
        self.edge = np.searchsorted(self.doc[order], np.arange(len(pieces) + 1))
        self.n = len(pieces)

    def scores(self, piece: int) -> np.ndarray:
        total = np.zeros(self.n, np.float32)
        for t in self.own[self.edge[piece]:min(self.edge[piece + 1], self.edge[piece] + QUERY_TERMS)]:
            a, b = self.first[t], self.last[t]
            total[self.doc[a:b]] += self.weight[a:b]
        return total


def fill(sizes: list[int], index: Index, window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (piece, start within it, length); every place of every piece lies in exactly one."""
    left = dict.fromkeys(i for i, n in enumerate(sizes) if n)  # unused pieces in order
    unused = np.array([n > 0 for n in sizes], bool)
    seed, at = None, 0
    while left or seed is not None:
        if seed is None:
            seed, at = next(iter(left)), 0
            del left[seed]
            unused[seed] = False
        parts = [(seed, at, sizes[seed] - at)]
        room, asked, seed = window - parts[0][2], parts[0][0], None
        while room and left:
            ranked = np.where(unused, index.scores(asked), -1.0)
            top = np.argpartition(-ranked, TOP)[:TOP] if len(ranked) > TOP else np.arange(len(ranked))
            for other in top[np.lexsort((top, -ranked[top]))].tolist():
                if not room or not unused[other]:
                    break
                del left[other]
                unused[other] = False
                size = min(room, sizes[other])
                parts.append((other, 0, size))
                room -= size
                if size < sizes[other]:
                    seed, at = other, size
        yield parts


def cut(parts: list[tuple[int, int, int]], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """A full window as it is; a short one as sequences whose lengths are falling powers of two."""
    total = sum(p[2] for p in parts)
    if total == window:
        yield parts
        return
    parts, bit = list(parts), 1 << (max(total, 1).bit_length() - 1)
    while parts:
        while not total & bit:
            bit >>= 1
        out, room = [], bit
        while room:
            piece, start, size = parts.pop(0)
            used = min(size, room)
            out.append((piece, start, used))
            if used < size:
                parts.insert(0, (piece, start + used, size - used))
            room -= used
        total -= bit
        yield out


def rest(ids: np.ndarray, window: int) -> np.ndarray:
    return ids[len(ids) // window * window:]


def pack_shard(docs: list[np.ndarray], known: Statistics, window: int = WINDOW) -> Iterator[list[tuple[int, int, int]]]:
    """Sequences of a shard as lists of (document, start, length)."""
    heads = [len(d) // window * window for d in docs]
    for i, head in enumerate(heads):
        for start in range(0, head, window):
            yield [(i, start, window)]
    rests = [rest(d, window) for d in docs]
    for parts in fill([len(r) for r in rests], Index(rests, known), window):
        for out in cut(parts, window):
            yield [(i, heads[i] + start, size) for i, start, size in out]


def encoded(docs: DataFrame, tokenizer: str, key: str, text: str) -> DataFrame:
    """key, h (hash of key and text), n (ids of the document) and ids (two bytes each where all fit, else four)."""
    # The hash takes in the text, so that only rows equal in both could meet by more than chance.
    read = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("h", F.xxhash64("key", "text"))
    content = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(content.value)
        for part in slices(batches):
            found = encode(raw(part))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("h"), pa.array(map(len, found), pa.int64()),
                 pa.array([f.tobytes() for f in found], pa.binary())], names=["key", "h", "n", "ids"])

    return read.mapInArrow(run, read.select("key", "h").schema.add("n", "long").add("ids", "binary"))


def token_ids(part: pa.RecordBatch, kind: np.dtype) -> list[np.ndarray]:
    return [np.frombuffer(v, kind) for v in part.column("ids").to_pylist()]


def statistics(rows: DataFrame, kind: np.dtype, terms: int, window: int) -> Statistics:
    """Counted over all rows; at most one number for each token id comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(terms, np.int64)
        for part in slices(batches, "ids"):
            df += np.bincount(postings([rest(d, window) for d in token_ids(part, kind)])[1], minlength=terms)
        on = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(df[on])], names=["term", "df"])

    found = rows.select("ids").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(terms, np.int64)
    df[found.column("term").to_numpy()] = found.column("df").to_numpy()
    n, mean = rows.agg(F.count("*"), F.avg(F.col("n") % window)).first()
    return Statistics(df, n, mean or 0.0)


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Pieces of all documents: key, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    `tokenizer` is the content of a tokenizers file; it is of fixed size and sent to every executor.
    """
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.coalesce(F.length(text), F.lit(0)) + DOC_CHARS)).first()[0] or 0
    shards = int(max(1, -(-chars // SHARD_CHARS)))
    terms, kind = len(encoder(tokenizer).last), encoder(tokenizer).kind
    rows = materialise(encoded(docs, tokenizer, key, text))
    known = spark.sparkContext.broadcast(statistics(rows, kind, terms, window))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "ids"):
            found = places([rest(d, window) for d in token_ids(part, kind)], part.column("h").to_numpy(), known.value)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], names=[*part.schema.names, "place"])

    def placed(some: DataFrame) -> DataFrame:
        return some.mapInArrow(place, some.select("*").schema.add("place", "long"))

    # About SAMPLES documents a shard, chosen by hash, say where the line holds equal shares of all tokens.
    step = max(1, known.value.n // (SAMPLES * shards))
    sample = placed(rows.filter(F.pmod(F.xxhash64("h"), F.lit(step)) == 0)).select("place", "n").toArrow() \
        .sort_by([("place", "ascending"), ("n", "ascending")])
    upto = np.cumsum(sample.column("n").to_numpy() + DOC_TOKENS)
    share = np.searchsorted(upto, np.arange(1, shards) * (upto[-1] / shards)) if len(upto) else np.zeros(0, np.int64)
    bounds = sample.column("place").to_numpy()[share]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in place(batches):
            found = np.searchsorted(bounds, part.column("place").to_numpy()).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], names=[*part.schema.names, "shard"])

    dealt = rows.mapInArrow(deal, rows.select("*").schema.add("place", "long").add("shard", "integer")).repartitionById(shards, F.col("shard")) \
        .sortWithinPartitions("shard", "place", "h", "key").select("key", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = (TaskContext.get().partitionId() << 32) - 1
        keys, held = [], []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = []
            for parts in pack_shard(held, known.value, window):
                number, offset = number + 1, 0
                for i, start, size in parts:
                    rows.append((i, start, size, held[i][start:start + size].astype(IDS).tobytes(), len(held[i]), number,
                                 offset))
                    offset += size
                if len(rows) >= 1000:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            i, *cols = zip(*rows)
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([keys[k] for k in i], key_kind), *(pa.array(c, t) for c, t in zip(cols, kinds))],
                names=["key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        key_kind, tokens = pa.int64(), 0
        for part in slices(batches, "ids"):
            key_kind = part.schema.field("key").type
            keys += part.column("key").to_pylist()
            found = token_ids(part, kind)
            held += found
            tokens += sum(map(len, found))
            if tokens >= SHARD_TOKENS:  # a shard that came out too large is packed in parts
                yield from flush()
                keys, held, tokens = [], [], 0
        if held:
            yield from flush()

    shape = dealt.select("key").schema.add("start", "long").add("length", "long").add("ids", "binary") \
        .add("doc_tokens", "long").add("sequence_id", "long").add("offset", "long")
    return dealt.mapInArrow(run, shape).withColumnRenamed("key", key)
