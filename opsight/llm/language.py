"""Language identification by compression: the dictionary that encodes a text in the fewest bytes names its language.

Every language has a zstandard raw-content dictionary, made of a bounded sample of its learning rows. A text is encoded
whole with each dictionary, in blocks of BLOCK bytes that each start from the dictionary alone, as a dictionary saves only
a bounded number of bytes in one piece; a language's size is the sum over all blocks, so that the margin does not shrink
with the length. The score is the share of bytes the best dictionary saves over the second best, from 0 to 1; a text is
rejected when it has no letter or when that margin is narrower than `MARGIN`.

Defined cases: a NULL or empty text, or one without a letter, is `und` with score 0 and rejected. Equal sizes go to the
language with more learning text, then to the first in the alphabet. Letters are compared in lower case. With one learned language the score is 1, with none every text is `und`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from opsight.llm.common import slices, strings

#: Encoder level, and that of texts up to SHORT bytes, where finding every match of three bytes matters.
LEVEL, SHORT, SHORT_LEVEL = 7, 200, 19
#: The bounded sample: as many whole texts of a language's first ROWS rows as fit into BYTES, in the order of a hash.
ROWS, BYTES = 400, 200_000
MARGIN = 0.004
#: Bytes encoded from a fresh dictionary; a shorter last block counts with the one before it.
BLOCK = 50_000
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
FIELDS = {"lang_pred": pa.string(), "score": pa.float64(), "rejected": pa.bool_()}


def learn(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, bytes]:
    """Raw-content dictionaries by language, from whole texts of at most BYTES bytes together.

    Rows are taken in the order of their key's hash; texts of more than BYTES bytes are passed over. The first ROWS rows of a
    language are chosen on key and language alone; only the texts that fit are sent to the driver.
    """
    rows = rows.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    order = F.xxhash64(F.col(key))
    rank = F.row_number().over(Window.partitionBy("l").orderBy("h", "k"))
    chosen = rows.select(F.col(lang).alias("l"), order.alias("h"), F.col(key).alias("k")).withColumn("r", rank) \
        .filter(F.col("r") <= ROWS).select("k").distinct()
    # Every text is followed by a line end in the dictionary.
    size = F.octet_length(F.lower(F.col(text))) + 1
    upto = F.sum("n").over(Window.partitionBy("l").orderBy("h", "t").rowsBetween(Window.unboundedPreceding, 0))
    sample = rows.join(F.broadcast(chosen), rows[key] == chosen["k"], "left_semi") \
        .select(F.col(lang).alias("l"), F.col(text).alias("t"), order.alias("h"), size.alias("n")).filter(F.col("n") <= BYTES) \
        .withColumn("upto", upto).filter(F.col("upto") <= BYTES).select("l", "t", "h")
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in sample.collect():
        texts.setdefault(r["l"], []).append((r["h"], r["t"]))
    # The end of a dictionary is the cheapest to refer to; equal samples give equal dictionaries.
    return {
        name: "\n".join(t.lower() for _, t in sorted(found)).encode()
        for name, found in sorted(texts.items()) if any(LETTER.search(t) for _, t in found)
    }


class Judge:
    """Encoders for one worker."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.encoders = [
            [(rank, name, self.encoder(content, level)) for rank, (name, content) in
             enumerate(sorted(dictionaries.items(), key=lambda d: (-len(d[1]), d[0])))]
            for level in (SHORT_LEVEL, LEVEL)]

    @staticmethod
    def encoder(content: bytes, level: int) -> zstandard.ZstdCompressor:
        own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own.precompute_compress(level=level)
        return zstandard.ZstdCompressor(level=level, dict_data=own, write_content_size=False, write_checksum=False,
                                        write_dict_id=False)

    def __call__(self, text: str) -> tuple[str, float, bool]:
        if not self.encoders[0] or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        data = text.lower().encode()
        edges = [*range(0, max(1, len(data) // BLOCK) * BLOCK, BLOCK), len(data)]
        blocks = [data[a:b] for a, b in zip(edges, edges[1:])]
        sizes = sorted((sum(len(e.compress(b)) for b in blocks), rank, name)
                       for rank, name, e in self.encoders[len(data) > SHORT])
        margin = 1 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0
        return sizes[0][2], margin, margin < MARGIN


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text",
             keep: tuple[str, ...] = ("doc_id",), only_accepted: bool = False) -> DataFrame:
    """The columns `keep` with lang_pred, score and rejected; with `only_accepted` just `keep` of the accepted rows."""
    read = docs.select(*keep, *([] if text in keep else [text]))
    names = list(keep) if only_accepted else [*keep, *FIELDS]
    shape = read.select(*keep).schema
    if not only_accepted:
        shape = shape.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(dictionaries)
        for part in slices(batches, text):
            found = [judge(t) for t in strings(part, text)]
            if only_accepted:
                part = part.filter(pa.array([not f[2] for f in found], pa.bool_()))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep], names=names)
            else:
                more = [pa.array(v, t) for v, t in zip(zip(*found), FIELDS.values())]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + more, names=names)

    return read.mapInArrow(run, shape)
