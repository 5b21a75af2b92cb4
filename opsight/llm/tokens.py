"""Greedy word-piece lengths by one pass of an automaton over each word.

The vocabulary is a trie. Where a text leaves the trie, a failure link leads to the node of what is left after the
longest pieces have been taken off the front, and the number of pieces taken off is stored with the link; so a word's
pieces are counted in time linear in its length and none is built. Words are cut at white space and begin with the
vocabulary's word mark, as its pieces do. Like word-piece encoders, a word that the pieces cannot spell is one unknown
token.

Defined cases: a NULL, empty or blank text has no words and no tokens; an empty vocabulary makes every word unknown.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsight.llm.common import Memo, slices, strings

MARK = "▁"
STUCK = -1


class Automaton:
    """Trie nodes are numbers; 0 is the root. `link` is the node after popping `popped` pieces, or STUCK."""

    def __init__(self, pieces: tuple[str, ...]):
        self.child: list[dict[str, int]] = [{}]
        ends = [False]
        for piece in pieces:
            node = 0
            for c in piece:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    ends.append(False)
                node = self.child[node][c]
            ends[node] = node != 0
        self.link, self.popped = [STUCK] * len(self.child), [0] * len(self.child)
        row = [0]
        while row:  # breadth first: links lead to shorter strings
            for node in row:
                for c, child in self.child[node].items():
                    if ends[child]:
                        self.link[child], self.popped[child] = 0, 1
                        continue
                    at, count = self.link[node], self.popped[node]
                    while at != STUCK and c not in self.child[at]:
                        count += self.popped[at]
                        at = self.link[at]
                    if at != STUCK:
                        self.link[child], self.popped[child] = self.child[at][c], count
            row = [child for node in row for child in self.child[node].values()]

    def count(self, word: str) -> int:
        """Pieces of the greedy segmentation, or STUCK if there is none."""
        child, link, popped = self.child, self.link, self.popped
        node, total = 0, 0
        for c in word:
            while c not in child[node]:
                total += popped[node]
                node = link[node]
                if node == STUCK:
                    return STUCK
            node = child[node][c]
        while node:
            total += popped[node]
            node = link[node]
            if node == STUCK:
                return STUCK
        return total


@lru_cache(maxsize=1)
def word_sizes(pieces: tuple[str, ...]) -> Memo:
    """Pieces by word, for all tasks of a worker process."""
    machine = Automaton(pieces)
    return Memo(lambda word: machine.count(MARK + word))


def count_tokens(docs: DataFrame, pieces: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, n_words, n_tokens and n_unknown (words that are one unknown token) of every whole text.

    The vocabulary, of fixed size, is sent to every executor.
    """
    read = docs.select(F.col(key), F.col(text).alias("t"))
    sent = docs.sparkSession.sparkContext.broadcast(tuple(pieces))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = word_sizes(sent.value)
        for part in slices(batches, "t"):
            rows = []
            for t in strings(part, "t"):
                counts = list(map(sizes.__getitem__, t.split()))
                unknown = counts.count(STUCK)
                rows.append((len(counts), sum(counts) + 2 * unknown, unknown))
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([part.column(key), *(pa.array(c, pa.int64()) for c in cols)],
                                             names=[key, "n_words", "n_tokens", "n_unknown"])

    shape = read.select(key).schema.add("n_words", "long").add("n_tokens", "long").add("n_unknown", "long")
    return read.mapInArrow(run, shape)
