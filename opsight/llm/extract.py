"""Main-text extraction by a linear-chain conditional random field over the leaf blocks of a page.

A page is cut into leaf blocks: stretches of text between tags that are not inline. Each block has features of its
ancestors (tag names, and the words of their class, id and role attributes) and of its text (length, links, marks,
sentences). A chain of two labels, article or other, is fitted on labelled pages by gradient ascent on the conditional
likelihood (forward-backward), and a page is decoded by Viterbi. Blocks of the article are joined in page order.

Labelled pages are HTML whose elements carry `data-main="1"` or `"0"`; the nearest such ancestor labels a block. A fixed
set of layouts is in `labelled_pages`; `train` takes any other.

Defined cases: a NULL or empty page, or one without article blocks, gives an empty text. Scripts, styles, templates and
comments are never blocks; unclosed tags end where an outer element ends; character references are decoded, unknown ones
stay as they are. White space inside a block becomes one space. Nothing is dropped from or cut off an article block.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from opsight.llm.common import Memo, slices, strings
from opsight.llm.labelled_pages import PAGES

#: Fixed values of HTML: elements that do not break a block, never have content, or hold no text for readers.
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub "
                   "sup time tt u var wbr label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = ("script", "style", "template", "noscript", "svg", "textarea", "title", "iframe")
#: Elements that an opening tag of the same kind, or of a block kind, closes.
LOOSE = frozenset("p li dt dd tr td th option".split())
CLOSES_P = frozenset("p div article section aside header footer nav ul ol dl table form h1 h2 h3 h4 h5 h6 blockquote pre "
                     "main figure address fieldset hr".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(HIDDEN) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role|data-main|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
NAME = re.compile(r"[a-z]+")
STEPS, RATE, L2 = 120, 0.1, 1e-3
LABELS = 2


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]  # (tag, words of its attributes) from the outside in
    main: int | None = None
    linked: int = 0  # characters inside links


@dataclass
class Node:
    tag: str
    words: tuple[str, ...] = ()
    main: int | None = None


def attributes(found: str) -> tuple[tuple[str, ...], int | None]:
    words, main = [], None
    if found and not found.isspace():
        for name, *values in ATTRIBUTE.findall(found):
            value = "".join(values)
            if name.lower() == "data-main":
                main = int(value == "1")
            elif "hidden" in name.lower():
                words.append("hidden")
            else:
                words += NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
    return tuple(words), main


def blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order; blank ones are left out."""
    out: list[Block] = []
    stack: list[Node] = []
    parts: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                main = next((n.main for n in reversed(stack) if n.main is not None), None)
                out.append(Block(text, tuple((n.tag, n.words) for n in stack), main, linked))
        parts, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if links:
                linked += len(text)

    at = 0
    for m in TOKEN.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        if m[3] is None:
            continue
        tag = m[3].lower()
        if tag in INLINE:
            if tag == "a":
                links = 0 if m[2] else 1
            continue
        if tag == "br" or tag in VOID:
            if tag in ("br", "hr"):
                parts.append(" ")
            continue
        flush()
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            links = 0
            continue
        if stack and (tag == stack[-1].tag and tag in LOOSE or stack[-1].tag == "p" and tag in CLOSES_P):
            stack.pop()
        stack.append(Node(tag, *attributes(m[4])))
    add(page[at:])
    flush()
    return out


def bucket(n: int) -> int:
    return min(n, 4095).bit_length()


def text_features(block: Block) -> list[str]:
    t = block.text
    return [f"len{bucket(len(t))}", f"words{bucket(t.count(' '))}", f"links{10 * block.linked // (len(t) + 1) // 3}",
            "sentence" if t[-1] in ".!?\"”" else "open", "copyright" if "©" in t else "plain",
            "pipes" if " | " in t else "nopipes"]


def path_features(path: tuple[tuple[str, tuple[str, ...]], ...]) -> list[str]:
    found = {"bias", f"in-{path[-1][0] if path else 'none'}"}
    for tag, words in path:
        found.add(f"tag-{tag}")
        found.update(f"word-{w}" for w in words)
    return sorted(found)


@dataclass
class Model:
    number: dict[str, int]
    emit: np.ndarray  # features x labels
    step: np.ndarray = field(default_factory=lambda: np.zeros((LABELS, LABELS)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(LABELS))


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(pages: list[str] | tuple[str, ...] = PAGES) -> Model:
    """Fit on labelled pages; blocks without a label count as other."""
    cut = [blocks(p) for p in pages]
    feats = [[text_features(b) + path_features(b.path) for b in page] for page in cut if page]
    truth = [np.array([int(b.main == 1) for b in page]) for page in cut if page]
    number = {f: i for i, f in enumerate(sorted({f for page in feats for b in page for f in b}))}
    rows = []
    for page in feats:
        x = np.zeros((len(page), len(number)))
        for i, b in enumerate(page):
            x[i, [number[f] for f in b]] = 1
        rows.append(x)
    model = Model(number, np.zeros((len(number), LABELS)))
    cells = [model.emit, model.step, model.start]
    first, second = [np.zeros_like(c) for c in cells], [np.zeros_like(c) for c in cells]
    for step in range(1, STEPS + 1):
        grads = [-L2 * c for c in cells]
        for x, y in zip(rows, truth):
            e, n = x @ model.emit, len(y)
            fwd, bwd = np.zeros((n, LABELS)), np.zeros((n, LABELS))
            fwd[0] = model.start + e[0]
            for i in range(1, n):
                fwd[i] = e[i] + _log_sum(fwd[i - 1][:, None] + model.step, 0)
            for i in range(n - 2, -1, -1):
                bwd[i] = _log_sum(model.step + (e[i + 1] + bwd[i + 1])[None, :], 1)
            z = _log_sum(fwd[-1], 0)
            off = np.eye(LABELS)[y] - np.exp(fwd + bwd - z)
            grads[0] = grads[0] + x.T @ off / len(rows)
            grads[2] = grads[2] + off[0] / len(rows)
            for i in range(1, n):
                both = np.exp(fwd[i - 1][:, None] + model.step + (e[i] + bwd[i])[None, :] - z)
                both[y[i - 1], y[i]] -= 1
                grads[1] = grads[1] - both / len(rows)
        for c, g, m, v in zip(cells, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            c += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return model


class Decoder:
    """Viterbi for one worker; what a path of ancestors or a kind of text adds is worked out once."""

    def __init__(self, model: Model):
        self.number, self.emit = model.number, model.emit.tolist()
        self.step, self.start = model.step.tolist(), model.start.tolist()
        self.paths = Memo(lambda path: self.sum(path_features(path)), 20_000)
        self.marks = Memo(self.sum, 20_000)

    def sum(self, names) -> tuple[float, float]:
        on = [self.emit[self.number[f]] for f in names if f in self.number]
        return sum(e[0] for e in on), sum(e[1] for e in on)

    def labels(self, page: list[Block]) -> list[int]:
        back, (s0, s1), ((t00, t01), (t10, t11)) = [], self.start, self.step
        for i, block in enumerate(page):
            (p0, p1), (m0, m1) = self.paths[block.path], self.marks[tuple(text_features(block))]
            if not i:
                a, b = s0 + p0 + m0, s1 + p1 + m1
                continue
            to0, to1 = (a + t00, b + t10), (a + t01, b + t11)
            back.append((to0[1] > to0[0], to1[1] > to1[0]))
            a, b = max(to0) + p0 + m0, max(to1) + p1 + m1
        if not page:
            return []
        out = [int(b > a)]
        for choice in reversed(back):
            out.append(int(choice[out[-1]]))
        return out[::-1]

    def __call__(self, page: str) -> str:
        found = blocks(page)
        return " ".join(b.text for b, label in zip(found, self.labels(found)) if label)


def extract(pages: DataFrame, model: Model, page: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns `keep` with the main text and its code points."""
    read = pages.select(*keep, F.col(page).alias("_whole_text"))
    sent = pages.sparkSession.sparkContext.broadcast(model)  # as large as the labelled set's features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = Decoder(sent.value)
        for part in slices(batches, "_whole_text"):
            texts = [decode(p) for p in strings(part, "_whole_text")]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in keep), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*keep, "text", "n_chars"])

    return read.mapInArrow(run, read.drop("_whole_text").schema.add("text", "string").add("n_chars", "long"))
