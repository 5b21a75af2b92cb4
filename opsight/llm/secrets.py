"""Secret scans: fixed patterns, and values in a credential's place that are costly to guess.

Base kinds (leftmost, non-overlapping for each kind): `assign`, `access` and `hex` below. The method's kind `guess` marks
values after a credential word and a separator whose guess cost reaches STRONG. The cost, in powers of ten, is that of
the cheapest way to cut the value into dictionary words, dates, repeats, keyboard walks and brute-force spans, found by
dynamic programming over the value's places. Every rule looks at spans of bounded length, so a value takes linear time.

Spans are (kind, start, end) in code points, end exclusive, by start and then by kind in the order of KINDS. Defined
cases: NULL and empty texts have no spans; equal spans of different kinds are all kept; a value found twice is one span.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log10

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from opsight.llm.common import Memo, slices, strings

KINDS = ("assign", "access", "hex", "guess")
#: Fixed patterns of the base kinds. Longer-than-needed runs match from their start, so lengths can stand in the pattern.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
#: Words that put a value in a credential's place, and the value: quoted, or up to a blank or closing sign.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth(?:orization)?"""
    r"""|credentials?|bearer)["']?\x20*(?:[:=]>?|\x20is\x20|=>)\x20*(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"'<>,;(){}\[\]]+))""",
    re.I | re.A)
HINTS = ("pass", "pwd", "secret", "token", "key", "auth", "credential", "bearer")
STRONG = 10.0
REDACTED = "[SECRET]"

#: A few passwords that are guessed first; the other words come as a ranked list.
COMMON = ("password", "123456", "12345678", "qwerty", "abc123", "letmein", "admin", "welcome", "login", "master",
          "changeme", "secret", "token", "example", "test", "default", "none", "null", "guest", "root", "dragon")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "qwertzuiop", "azertyuiop")
SHIFTED = str.maketrans("!@#$%^&*()", "1234567890")
LEET = str.maketrans("4@310!5$7", "aaeioisst")
LONGEST_WORD, LONGEST_UNIT = 24, 8
DATE = re.compile(r"(?:(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01]))?"
                  r"|(?:0?[1-9]|[12]\d|3[01])[-/._](?:0?[1-9]|1[0-2])[-/._](?:19|20)?\d\d)")
NEXT = {a + b for row in ROWS for pair in zip(row, row[1:]) for a, b in (pair, pair[::-1])}


class Guesser:
    """Guess costs with a ranked word list; the list's size bounds the memory."""

    def __init__(self, words: list[str]):
        self.rank: dict[str, int] = {}
        for word in (*COMMON, *words):
            if len(word) >= 3:
                self.rank.setdefault(word, len(self.rank) + 1)
        self.lengths = sorted({len(w) for w in self.rank if len(w) <= LONGEST_WORD})

    def spans(self, value: str, at: int) -> Iterator[tuple[int, float]]:
        """(end, cost) of what is cheaper to guess than symbol by symbol, from place `at` on."""
        low, n = self.low, len(value)
        for size in self.lengths:
            if at + size > n:
                break
            part = low[at:at + size]
            rank = self.rank.get(part)
            extra = 0.0
            if rank is None:
                rank, extra = self.rank.get(self.plain[at:at + size]), log10(4)
            if rank:
                raw = value[at:at + size]
                if raw != part:
                    extra += log10(2) if raw[1:] == part[1:] or raw.isupper() else log10(size + 2)
                yield at + size, log10(rank + 1) + extra
        if found := DATE.match(value, at):
            yield found.end(), log10(365 * 100) if found.end() - at > 4 else 2.0
        for unit in range(1, LONGEST_UNIT + 1):
            # Repeats of a unit; a run is entered at its start only, where the unit before differs.
            piece = value[at:at + unit]
            if value[at + unit:at + 2 * unit] != piece or at and value[at - 1:at - 1 + unit] == piece[-1:] + piece[:-1]:
                continue
            end = at + 2 * unit
            while value.startswith(piece, end):
                end += unit
            if end - at >= 3:
                yield end, unit * 1.0 + log10((end - at) / unit)
        keys = self.keys
        if keys[at:at + 2] in NEXT and not (at and keys[at - 1:at + 1] in NEXT):
            end = at + 2
            while keys[end - 1:end + 1] in NEXT:
                end += 1
            if end - at >= 3:
                yield end, log10(len(ROWS) * 10) + log10(2) * (end - at - 1) / 2

    def cost(self, value: str) -> float:
        """Least sum of costs over all ways to cut the value, as a power of ten."""
        self.low = value.lower() if value.isascii() else "".join(c.lower() if c.isascii() else c for c in value)
        self.plain, self.keys = self.low.translate(LEET), self.low.translate(SHIFTED)
        best = [0.0] + [float("inf")] * len(value)
        for at in range(len(value)):
            here = best[at]
            if here + 1 < best[at + 1]:  # brute force: ten guesses a symbol
                best[at + 1] = here + 1
            for end, cost in self.spans(value, at):
                if here + cost < best[end]:
                    best[end] = here + cost
        return best[-1]


def scan(text: str, guess: Memo) -> list[tuple[str, int, int]]:
    """All spans of one text; `guess` gives the cost of a value."""
    low = text.lower()
    spans = []
    if any(h in low for h in HINTS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
        for m in CONTEXT.finditer(text):
            if guess[m[m.lastindex]] >= STRONG:
                spans.append(("guess", *m.span(m.lastindex)))
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every stretch that spans cover, joined where they overlap, put out of sight."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join([*out, text[at:]])


SPANS = T.ArrayType(T.StructType().add("kind", "string").add("start", "long").add("end", "long"))
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def find(docs: DataFrame, words: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and the spans of every whole text, as an array of kind, start and end."""
    read = docs.select(F.col(key), F.col(text).alias("t"))
    sent = docs.sparkSession.sparkContext.broadcast(list(words))  # a word list of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guess = Memo(Guesser(sent.value).cost, 50_000)
        for part in slices(batches, "t"):
            found = [[dict(zip(("kind", "start", "end"), s)) for s in scan(t, guess)] for t in strings(part, "t")]
            yield pa.RecordBatch.from_arrays([part.column(key), pa.array(found, pa.list_(SPAN))], names=[key, "spans"])

    return read.mapInArrow(run, read.select(key).schema.add("spans", SPANS))


def mask(docs: DataFrame, words: list[str], text: str = "text") -> DataFrame:
    """The same rows and columns, with secrets in `text` replaced; NULL stays NULL."""
    sent = docs.sparkSession.sparkContext.broadcast(list(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guess = Memo(Guesser(sent.value).cost, 50_000)
        for part in slices(batches, text):
            old = part.column(text).to_pylist()
            new = [t and redact(t, scan(t, guess)) for t in old]
            at = part.schema.get_field_index(text)
            cols = [pa.array(new, pa.string()) if i == at else part.column(i) for i in range(part.num_columns)]
            yield pa.RecordBatch.from_arrays(cols, names=part.schema.names)

    return docs.mapInArrow(run, docs.schema)


def joined(spans, kinds: tuple[str, ...] | None = None):
    """Spans as kind:start:end, joined by commas; of `kinds` only, if given."""
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
