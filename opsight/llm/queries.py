"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

import json
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opsight.llm import (extract, fingerprint, language, mixing, near, negatives, packing, quality, runs, scoring, secrets,
                         tokens, toxicity)
from opsight.llm.common import in_fold, table

ORACLE_SQL: dict[str, str] = {}


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; learns from the labelled ones outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = in_fold(F.col("doc_id"), 3, 1)
    model = toxicity.train(docs, labels.filter(~held))
    return toxicity.score(docs.select("doc_id", held.alias("held_out"), "text"), model, keep=("held_out",))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.assess(docs, quality.train(docs, labels))


def word_list(tokenizer: str | None = None, words: int = 40_000) -> list[str]:
    """Whole words of a public vocabulary, the commonest first, for guess costs; a fixed list."""
    vocabulary = json.loads(Path(tokenizer or public_tokenizers.path("word_bpe_49k.json")).read_text())["model"]["vocab"]
    found = sorted((rank, w[:-4]) for w, rank in vocabulary.items() if w.endswith("</w>") and w[:-4].isalpha())
    return [w for _, w in found if len(w) >= 3][:words]


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"), word_list())
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in secrets.KINDS),
        F.sha2(secrets.joined(F.col("spans"), secrets.KINDS[:3]), 256).alias("base_sha256"),
        secrets.joined(F.col("spans")).alias("spans"))


def op4_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.classes(table(spark, sf_dir, "documents"), percent=85)


def op5_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"), extract.train())


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents; learns from those outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    held = in_fold(F.col("doc_id"), 4, 2)
    dictionaries = language.learn(docs.filter(~held))
    return language.identify(docs.select("doc_id", held.alias("held_out"), "text"), dictionaries,
                             keep=("doc_id", "held_out"))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece lengths of all documents with the pieces of a public vocabulary."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return tokens.count_tokens(table(spark, sf_dir, "documents"), pieces)


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(packing.pack(table(spark, sf_dir, "documents"), tokenizer()))


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def tokenizer(path: str | None = None) -> str:
    return Path(path or public_tokenizers.path("word_bpe_49k.json")).read_text()


def mix_levels() -> dict[str, Column]:
    """The tree of the documents: sources in five domains by their number, languages, sources."""
    digits = F.regexp_extract("source", r"(\d+)$", 1)
    return {"domain": F.when(digits != "", F.concat(F.lit("domain"), digits.cast("long") % 5)).otherwise("other"),
            "lang": F.col("lang"), "source": F.col("source")}


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tokens there are, drawn anew to weights that temper the supplies, from two epochs at most."""
    return mixing.mix(table(spark, sf_dir, "documents"), mix_levels())


def op11_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; learns from those outside the held-out fold."""
    held = in_fold(F.col("doc_id"), 7, 2)
    return scoring.score(table(spark, sf_dir, "documents"), ~held).withColumn("held_out", ~F.col("learnt")).drop("learnt")


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th row; labels of every seventh are moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 50 == 0)


ORACLE_SQL["op12_negatives"] = """
WITH e AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.other) <= 3
"""


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs in all documents, of which those whose key's crc32 ends in 0 are made periodic first."""
    return runs.find(table(spark, sf_dir, "documents"), prepare=runs.periodic)


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_quality, op3_secrets, op4_near, op5_extract, op6_language, op7_tokens,
                                   op8_fingerprint, op9_packing, op10_mixing, op11_scoring, op12_negatives, op13_runs)}
