"""One-permutation MinHash fingerprints, in DataFrame functions only.

A text's 5-word shingles (words `[^\\x20\\x09-\\x0D]+`; fewer words are one shingle) are hashed once. The high bits of a
hash choose one of BINS bins, and the least hash of each bin is kept: after sorting, that is the first of each run of
equal bins. An empty bin takes the value of the bin that its own sequence of universal hashes hits first among the filled
ones (optimal densification); a sequence walks all bins, so it always ends at a filled one. Of every value the low LOW bits are stored, two hex digits a bin. Likeness is the share of
equal bins, corrected for the chance 2^-LOW that unequal values agree.

Defined cases: NULL reads as empty; a text without words has the empty fingerprint, of likeness 1 with another such text
and 0 with any other. Equal texts have equal fingerprints. Rows that repeat both key and text are one document; rows with
one key and different texts are ordered by the hash of their text; a NULL key comes last. A single document is its own
next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from opsight.session import materialise

BINS, LOW, SHINGLE = 128, 8, 5
SHIFT = 64 - (BINS - 1).bit_length()
GAPS = " \t\n\x0b\f\r"


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, SHIFT)


def _probe(b: Column, t: int) -> Column:
    """The t-th bin that bin b asks: from a place and with an odd stride that are both hashes of b, so t < BINS asks all."""
    start, stride = ((b * F.lit(factor) + F.lit(offset)) % 8191 for factor, offset in ((2347, 1021), (5471, 3371)))
    return (start + stride.bitwiseOR(1) * F.lit(t)).cast("int").bitwiseAND(BINS - 1)


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the fingerprint of the column `text` as the string column `out`."""
    names = {n: f"_{out}_{n}" for n in ("words", "hash", "sorted", "first", "bins", "dense")}
    c = {k: F.col(v) for k, v in names.items()}
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(GAPS))
    df = df.withColumn(names["words"], F.split(trimmed, r"[ \t-\r]+"))
    df = df.withColumn(names["hash"], F.transform(c["words"], lambda w: F.xxhash64(w)))
    size = F.size(c["words"])
    shingles = F.when((size == 1) & (F.element_at(c["words"], 1) == ""), F.array().cast("array<bigint>")) \
        .when(size < SHINGLE, F.array(F.xxhash64(F.array_join(c["words"], " ")))) \
        .otherwise(F.transform(F.sequence(F.lit(0), size - SHINGLE),
                               lambda i: F.xxhash64(*[c["hash"][i + k] for k in range(SHINGLE)])))
    df = df.withColumn(names["sorted"], F.sort_array(shingles))
    df = df.withColumn(names["first"], F.filter(
        c["sorted"], lambda h, i: (i == 0) | (_bin(h) != _bin(c["sorted"][F.greatest(i - 1, F.lit(0))]))))
    df = df.withColumn(names["bins"], F.transform(c["first"], lambda h: _bin(h).cast("int")))
    df = df.withColumn(names["dense"], F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.try_element_at(
        c["first"], F.nullif(F.array_position(c["bins"], b), F.lit(0)).cast("int"))))
    digits = F.array(*[F.lit(f"{v:02x}") for v in range(1 << LOW)])
    filled = F.transform(c["dense"], lambda v, b: digits[F.coalesce(
        v, *(c["dense"][_probe(b, t)] for t in range(BINS))).bitwiseAND((1 << LOW) - 1).cast("int")])
    return df.withColumn(out, F.when(F.size(c["first"]) == 0, F.lit("")).otherwise(F.array_join(filled, ""))) \
        .drop(*names.values())


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two fingerprints, from 0 to 1."""
    same = F.aggregate(F.sequence(F.lit(0), F.lit(BINS - 1)), F.lit(0), lambda n, i: n + F.when(
        F.substr(a, i * 2 + 1, F.lit(2)) == F.substr(b, i * 2 + 1, F.lit(2)), 1).otherwise(0))
    chance = 2.0 ** -LOW
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0) \
        .otherwise(F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance)))


def chain(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, tie, half, next_id, next_tie): each document with the one after it in descending order of the key.

    Ranges of keys are numbered by their partition and written; the step from one range to the next needs one row of each.
    """
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("tie"),
                       F.floor(F.length(F.coalesce(F.col(text), F.lit(""))) / 2).cast("int").alias("half")) \
        .dropDuplicates(["id", "tie"])
    down = [F.col("id").desc_nulls_last(), F.col("tie").desc()]
    rows = materialise(rows.repartitionByRange(*down).withColumn("part", F.spark_partition_id()))
    ahead = F.lead(F.struct("id", "tie")).over(Window.partitionBy("part").orderBy(*down))
    # One row for each range of keys: its first in the order; -part makes the last range lead back to the first.
    heads = rows.groupBy("part").agg(F.max_by(F.struct("id", "tie"), F.struct(F.col("id").isNotNull(), "id", "tie")).alias("head"))
    by_part = Window.orderBy("part")
    heads = heads.select("part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(
        by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("then"))
    found = rows.withColumn("ahead", ahead).join(heads, "part").withColumn("n", F.coalesce("ahead", "then"))
    return found.select("id", "tie", "half", F.col("n.id").alias("next_id"), F.col("n.tie").alias("next_tie"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the document with its last half replaced by as much of the front of the next one. Every text moves
    twice: to the row that names who needs its front, then its front to that document.
    """
    links = materialise(chain(docs, key, text))
    # A NULL key gets a name, so that rows are matched by plain equality and the deduplicated texts need not move again.
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    own = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"), F.xxhash64(text).alias("tie")) \
        .withColumn("name", name("id")).dropDuplicates(["name", "tie"])
    own = with_fingerprint(own, "t", "f").withColumn("f", F.unhex("f"))
    asked = links.select(name("next_id").alias("name"), F.col("next_tie").alias("tie"), F.col("id").alias("to_id"),
                         F.col("tie").alias("to_tie"), F.col("half").alias("wanted"))
    met = own.join(asked, ["name", "tie"])
    n = F.length("t")
    halves = met.select(F.explode(F.array(
        F.struct("id", "tie", F.lit(True).alias("own"), n.alias("n"), F.col("f"),
                 F.substring("t", F.lit(1), (n - F.floor(n / 2)).cast("int")).alias("p")),
        F.struct(F.col("to_id").alias("id"), F.col("to_tie").alias("tie"), F.lit(False).alias("own"), n.alias("n"), F.col("f"),
                 F.substring("t", F.lit(1), F.col("wanted")).alias("p")))).alias("r")).select("r.*")
    # Two rows for each document meet: its own front half and the front of the next.
    pick = lambda c, side: F.max(F.when(F.col("own") == side, F.col(c)))
    pairs = halves.groupBy("id", "tie").agg(
        pick("n", True).alias("n_chars"), F.lower(F.hex(pick("f", True))).alias("fingerprint"), F.lower(F.hex(pick("f", False))).alias("then"),
        pick("p", True).alias("p"), pick("p", False).alias("q")).withColumn("edited", F.concat("p", "q"))
    done = with_fingerprint(pairs, "edited", "edited_fingerprint")
    return done.select(
        F.col("id").alias(key), F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("then")).alias("near_next"))
