"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opsight.llm import (extract, fingerprint, language, mixing, near, negatives, packing, quality, queries, runs, scoring,
                         secrets, tokens, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id string, t int, spans int"
LONG = " ".join(f"word{i % 977}" for i in range(40_000))
TEXTS = [(1, "Warm rain fell on the old town all night"), (2, None), (3, ""), (4, " \t\n"), (5, LONG), (6, LONG + " end"),
         (7, "same text here"), (8, "same text here"), (8, "same text here"), (9, "123 !!!"), (10, "ab\x1ccd   e"),
         (11, 'password = "hunter2hunter2"'), (None, "no key at all")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en" if (k or 0) % 2 else None, None if k == 1 else "src1", None, 1.0, "x", 1, 2) for k, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def words():
    return ["rain", "town", "password", "hunter"]


RUNS = {
    "language": lambda d: language.identify(d, language.learn(d)),
    "quality": lambda d: quality.assess(d, quality.train(d, d.select("doc_id", F.lit(1).alias("quality")))),
    "toxicity": lambda d: toxicity.score(d, toxicity.train(d, d.select("doc_id", F.lit(0).alias("toxic")))),
    "secrets": lambda d: secrets.find(d, words()),
    "near": near.classes,
    "tokens": lambda d: tokens.count_tokens(d, ["▁", "▁w", "o", "r", "d", "a", "e"]),
    "packing": lambda d: packing.pack(d, queries.tokenizer()),
    "mixing": lambda d: mixing.mix(d, queries.mix_levels()),
    "fingerprint": fingerprint.fingerprints,
    "scoring": lambda d: scoring.score(d, F.lit(True)),
    "runs": lambda d: runs.find(d, prepare=runs.periodic),
    "negatives": lambda d: negatives.hard_negatives(
        d.withColumn("v", F.array(F.lit(1.0))), F.lit(True), key="doc_id", vector="v", label="t"),
    "extract": lambda d: extract.extract(d, extract.train(extract.PAGES[:3]), page="text", keep=("doc_id", "t")),
}


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(none, name):
    assert RUNS[name](none).collect() == []


@pytest.mark.parametrize("name", ["language", "quality", "toxicity", "secrets", "near", "tokens", "extract", "scoring", "runs"])
def test_every_row_comes_back(docs, name):
    found = [r["doc_id"] for r in RUNS[name](docs).collect()]
    assert sorted(found, key=str) == sorted((k for k, _ in TEXTS), key=str)


def test_stages_keep_columns(spark, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
    assert len(near.keep_one(docs).filter("doc_id = 8 OR doc_id = 7").collect()) == 1


def test_unknown_language(docs):
    found = {r["doc_id"]: r for r in RUNS["language"](docs).collect()}
    assert all(found[k]["lang_pred"] == "und" and found[k]["rejected"] for k in (2, 3, 4, 9))
    assert found[1]["lang_pred"] == "en"


def test_packing_covers_all(docs):
    rows = RUNS["packing"](docs).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 2) == 1
    assert sum(r["length"] for r in rows if r["doc_id"] == 8) == 2 * sum(r["length"] for r in rows if r["doc_id"] == 7)


def test_fingerprints_of_repeats(docs):
    found = {r["doc_id"]: r for r in RUNS["fingerprint"](docs).collect()}
    assert len(found) == 12 and found[7]["fingerprint"] == found[8]["fingerprint"] and found[3]["fingerprint"] == ""
    assert found[3]["near_next"] == 1.0  # the next one is the NULL text of document 2


def test_mixing_without_budget(docs):
    assert mixing.mix(docs, queries.mix_levels(), total=0).collect() == []
    rows = mixing.mix(docs, queries.mix_levels(), total=1e12).collect()
    assert len(rows) == 2 * len(TEXTS)


def test_mixing_keeps_clashing_columns(spark, docs):
    """Columns named as those used inside come back as they went in."""
    named = docs.withColumns({c: F.lit(i) for i, c in enumerate(
        ("mix_text", "mix_key", "mix_left", "mix_end", "mix_times", "mix_full", "tokens", "row", "part", "h", "supply"))})
    found = mixing.mix(named, queries.mix_levels(), total=1e12, report=False)
    assert found.columns == named.columns
    rows = found.collect()
    assert len(rows) == 2 * len(TEXTS) and {(r["mix_text"], r["mix_left"], r["tokens"], r["row"]) for r in rows} == {(0, 2, 6, 7)}


def test_clashing_names_inside(spark, docs):
    named = docs.withColumns({c: F.lit("x") for c in ("_whole_text", "key", "t2", "ids", "place", "shard", "name", "tie", "word", "bits")})
    for name in ("toxicity", "packing", "fingerprint", "near", "scoring", "runs", "tokens", "language", "quality", "secrets"):
        assert len(RUNS[name](named).collect()) >= 12, name


def test_pipeline_of_an_empty_table(spark, none, tmp_path):
    none.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_string_key_named_null(spark):
    docs = spark.createDataFrame([("null", "a b c d e f"), (None, "x y z"), ("k", "a b c d e f g")], "doc_id string, text string")
    found = {r["doc_id"]: r for r in fingerprint.fingerprints(docs).collect()}
    assert set(found) == {"null", None, "k"} and found["null"]["n_chars"] == 11 and found[None]["n_chars"] == 5
