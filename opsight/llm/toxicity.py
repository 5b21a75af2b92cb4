"""Toxicity: a logistic classifier that is held to the same score when a sentence names another group.

Features are the words a text has (\\w+ in lower case, each counted once). Words kept are those of at least MIN_TEXTS
sampled rows whose share of toxic rows departs from chance (EVIDENCE), and those of the swaps below. Every sentence of the sampled rows that names a group of people is rewritten with the names of the other
groups of its family, and the squared difference of the two scores is added to the loss with weight BALANCE. A word that
only names a group thus cannot raise a score by itself, which spares neutral mentions.

Defined cases: NULL and empty texts get the score of a text without known words. Rows without label, or with a label
other than 0 and 1, teach nothing; without rows of both labels every score is the share of toxic rows (0.5 without rows).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsight.llm.common import slices, strings
from opsight.llm.linear import Sparse, fit, sigmoid
from opsight.llm.quality import labelled_sample

#: The bounded sample of labelled rows.
SAMPLE_ROWS = 8_000
MIN_TEXTS = 8
#: A word is a feature if its count in toxic and other rows departs from chance by this likelihood ratio (G squared).
EVIDENCE = 15.0
L2 = 1e-4
BALANCE = 5.0
THRESHOLD = 0.7
WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[.!?\n]+")
#: Families of words that name groups of people; any may take another's place.
GROUPS = (
    ("women", "men", "girls", "boys", "femmes", "hommes", "frauen", "männer", "mujeres", "hombres"),
    ("woman", "man", "girl", "boy", "femme", "homme", "frau", "mann", "mujer", "hombre"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indian", "indigenous"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer", "heterosexual"),
    ("immigrant", "immigrants", "refugee", "refugees", "native", "natives", "foreigner", "foreigners"),
    ("old", "young", "elderly", "teenage"),
    ("blind", "deaf", "disabled", "autistic"),
)


@dataclass
class Model:
    weights: dict[str, float]
    bias: float


def swaps(text: str, groups: tuple[tuple[str, ...], ...] = GROUPS) -> list[tuple[list[str], list[str]]]:
    """(words, words with another group's name) of each sentence, once for each other name of the family."""
    family = {w: g for g in groups for w in g}
    found = []
    for sentence in SENTENCE.split(text.lower()):
        words = WORD.findall(sentence)
        for named in {w for w in words if w in family}:
            for other in family[named]:
                if other != named:
                    found.append((words, [other if w == named else w for w in words]))
    return found


def evidence(hits: int, n: int, all_hits: int, rows: int) -> float:
    """G squared of the 2 x 2 table of having the word and being toxic."""
    cells = ((hits, n, all_hits), (n - hits, n, rows - all_hits), (all_hits - hits, rows - n, all_hits),
             (rows - n - all_hits + hits, rows - n, rows - all_hits))
    return 2 * sum(seen * log(seen * rows / (a * b)) for seen, a, b in cells if seen > 0)


def learn(rows: list[tuple[str, int]], groups=GROUPS, balance: float = BALANCE, l2: float = L2,
          min_texts: int = MIN_TEXTS) -> Model:
    """Fit on (text, label) rows of the bounded sample."""
    sets = [sorted(set(WORD.findall(t.lower()))) for t, _ in rows]
    y = np.array([label for _, label in rows], float)
    if not len(y):
        return Model({}, 0.0)
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    if y.min() == y.max():
        return Model({}, float(np.log(share / (1 - share))))
    # Only the words in which a pair differs enter the penalty; equal differences are one row with its count.
    pairs = Counter((tuple(sorted(set(a) - set(b))), tuple(sorted(set(b) - set(a))))
                    for t, _ in rows for a, b in swaps(t, groups))
    df = Counter(w for s in sets for w in s)
    toxic = Counter(w for s, label in zip(sets, y) if label for w in s)
    words = sorted({w for w, n in df.items() if n >= min_texts and evidence(toxic[w], n, int(y.sum()), len(y)) >= EVIDENCE}
                   | {w for p in pairs for side in p for w in side})
    number = {w: i for i, w in enumerate(words)}

    def sparse(parts: list[list[tuple[str, float]]]) -> Sparse:
        flat = [(r, number[w], v) for r, part in enumerate(parts) for w, v in part if w in number]
        r, c, v = zip(*flat) if flat else ((), (), ())
        return Sparse(np.array(r, np.int64), np.array(c, np.int64), np.array(v, float), len(parts), len(words))

    # The penalty is a mean over rows of squares, so this factor makes it the mean over all pairs.
    factor = {p: (n * len(pairs) / pairs.total()) ** 0.5 for p, n in pairs.items()}
    diffs = [[(w, v) for w in a] + [(w, -v) for w in b] for (a, b), v in factor.items()]
    w, b = fit(sparse([[(x, 1.0) for x in s] for s in sets]), y, l2, steps=250, pairs=sparse(diffs), pair_weight=balance)
    return Model({word: float(v) for word, v in zip(words, w) if abs(v) > 1e-9}, b)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text",
          rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most `rows` labelled rows, whose distinct words come to the driver; pass only rows to learn from."""
    sample = labelled_sample(docs, labels, label, rows, key, text)
    known = sorted({w for g in GROUPS for w in g})
    named = F.lower(F.col(text)).rlike(r"(?<!\w)(" + "|".join(known) + r")(?!\w)")
    # A text that names no group is only needed as its set of words, in any order.
    parts = F.when(named, F.col(text)).otherwise(F.array_join(F.array_distinct(
        F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"(?U)(\w+)"))), " "))
    found = sample.select("key", F.col(label).alias("y"), F.coalesce(parts, F.lit("")).alias("t")).collect()
    return learn([(r["t"], r["y"]) for r in sorted(found, key=lambda r: r["key"])])


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """Key, the columns `keep`, toxicity score (0 to 1) and predicted (1 from THRESHOLD on) of every whole text."""
    read = docs.select(F.col(key), *keep, F.col(text).alias("_whole_text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most the sample's words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value.weights, sent.value.bias
        for part in slices(batches, "_whole_text"):
            # A fixed order of summands, so that equal texts have equal scores in every process.
            z = [bias + sum(sorted(map(weights.__getitem__, weights.keys() & set(WORD.findall(t.lower())))))
                 for t in strings(part, "_whole_text")]
            p = sigmoid(np.array(z, float))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in (key, *keep)), pa.array(p), pa.array((p >= THRESHOLD).astype(np.int32))],
                names=[key, *keep, "score", "predicted"])

    return read.mapInArrow(run, read.drop("_whole_text").schema.add("score", "double").add("predicted", "integer"))
