"""Document chunks, exact and approximate vector search, and the context and audit rows of a query."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from opsight.functions.scalar import stable_id
from opsight.functions.text import chunk_text, infer_tags, redact


def chunk_documents(
    df: DataFrame, key: str = "doc_id", text: str = "content", max_chars: int = 1200, overlap: int = 200
) -> DataFrame:
    """One row per chunk with its index; the whole text is cut, none of it is left out."""
    chunks = chunk_text(text, max_chars, overlap)
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.posexplode(chunks).alias("chunk_index", text))


def build_chunk_table(
    df: DataFrame,
    vocabulary: Sequence[str],
    key: str = "doc_id",
    title: str = "title",
    text: str = "content",
    sensitivity: str = "internal",
    embeddings: DataFrame | None = None,
) -> DataFrame:
    """Chunk rows with content ids, tags and, when given, their embeddings joined by chunk id."""
    chunks = chunk_documents(df.withColumn(text, redact(text)), key, text)
    table = chunks.withColumns(
        {
            "chunk_id": stable_id(key, "chunk_index", text, length=20),
            "tags_json": F.to_json(infer_tags(F.concat_ws(" ", title, text), vocabulary)),
            "sensitivity": F.lit(sensitivity),
        }
    )
    return table if embeddings is None else table.join(embeddings, "chunk_id", "left")


#: Rows of a block of queries and of a block of the base, and how many base rows are multiplied at once: four megabytes of
#: distances, of which a task holds several copies.
QUERY_BLOCK, BASE_BLOCK, AT_ONCE = 2048, 16_384, 256
#: Distances are compared to this many digits, so that equal vectors are ties wherever they lie.
DIGITS = 12


def vector_topk(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    query_id: str = "query_id",
    base_id: str = "vec_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    base_block: int = BASE_BLOCK,
) -> DataFrame:
    """Exact nearest vectors of each query by cosine distance; a zero vector has distance 1.

    Queries and base are dealt into blocks by hash, and every block of queries meets every block
    of the base through a keyed join, so the plan is the same for any number of queries and no
    task holds more than two blocks. Each pair of blocks keeps its best ``k`` per query for the
    final ranking. Rows without a vector, or with a NULL in it, take no part; query rows that
    share an id, NULL included, are ranked together. Ties go to the smaller base id.
    """
    asked, held = _sides(queries, base, query_id, base_id, vector)
    blocks, parts = _blocks(asked, query_block), _blocks(held, base_block)
    asked = _dealt(asked, "qid", "block", blocks).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    held = _dealt(held, "bid", "part", parts).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return _ranked(asked, held, ["block", "part"], k, base_id)


def vector_cells(base: DataFrame, base_id: str = "vec_id", vector: str = "embedding", cells: int = 64,
                 sample: int = 10_000, rounds: int = 10) -> np.ndarray:
    """Unit centres of ``cells`` cells, by spherical k-means over at most ``sample`` rows in the order of a hash of their id."""
    _, held = _sides(base, base, base_id, base_id, vector)
    rows = held.orderBy(F.xxhash64("bid"), "bid").limit(sample).toArrow()
    if not rows.num_rows:
        return np.zeros((1, 1))
    vectors = _unit(_matrix(rows.column("v")))
    centres = vectors[:: -(-len(vectors) // cells)].copy()
    for _ in range(rounds):
        nearest = (vectors @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, nearest, vectors)
        centres = np.where(np.linalg.norm(total, axis=1, keepdims=True) > 0, _unit(total), centres)
    return centres


def vector_topk_near(
    queries: DataFrame,
    base: DataFrame,
    k: int,
    centres: np.ndarray,
    probe: float = 0.65,
    query_id: str = "query_id",
    base_id: str = "vec_id",
    vector: str = "embedding",
    query_block: int = QUERY_BLOCK,
    base_block: int = BASE_BLOCK,
) -> DataFrame:
    """Nearest vectors among the cells that lie closest to each query, the share ``probe`` of all cells.

    Every base row lies in the cell of its closest centre; a full cell is split into blocks of
    about ``base_block`` rows. Distances and ranks are those of :func:`vector_topk` over the
    cells asked, so ``probe=1`` gives its result. The centres have a fixed number of rows, which
    bounds what the tasks are sent.
    """
    asked, held = _sides(queries, base, query_id, base_id, vector)
    blocks, most = _blocks(asked, query_block), max(1, round(probe * len(centres)))
    held = _celled(held, centres, 1)
    parts = held.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / base_block).cast("int").alias("parts"))
    held = held.withColumn("_n", F.monotonically_increasing_id()).join(F.broadcast(parts), "cell") \
        .withColumn("part", F.pmod(F.xxhash64("bid", "_n"), F.col("parts")).cast("int")) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).drop("parts", "_n")
    asked = _celled(_dealt(asked, "qid", "block", blocks), centres, most).join(F.broadcast(parts), "cell") \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return _ranked(asked, held, ["cell", "part", "block"], k, base_id)


def _sides(queries: DataFrame, base: DataFrame, query_id: str, base_id: str, vector: str) -> tuple[DataFrame, DataFrame]:
    """(qid, v) and (bid, v) of the rows with whole vectors."""
    whole = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull())
    return tuple(df.filter(whole).select(F.col(i).alias(name), F.col(vector).cast("array<double>").alias("v"))
                 for df, i, name in ((queries, query_id, "qid"), (base, base_id, "bid")))


def _blocks(df: DataFrame, rows: int) -> int:
    return max(1, -(-df.count() // rows))


def _dealt(df: DataFrame, key: str, name: str, blocks: int) -> DataFrame:
    """Numbered blocks; rows that share a key are spread as well."""
    return df.withColumn("_n", F.monotonically_increasing_id()) \
        .withColumn(name, F.pmod(F.xxhash64(key, "_n"), F.lit(blocks)).cast("int")).drop("_n")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors as rows, filled with zeros to the longest."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    found = np.zeros((len(sizes), int(sizes.max(initial=0))))
    found[np.arange(found.shape[1]) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return found


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm != 0)


def _fit(m: np.ndarray, width: int) -> np.ndarray:
    return m[:, :width] if m.shape[1] >= width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def _celled(df: DataFrame, centres: np.ndarray, cells: int) -> DataFrame:
    """Each row with each of its ``cells`` closest cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            close = np.argsort(-(_fit(_matrix(batch.column("v")), centres.shape[1]) @ centres.T), axis=1, kind="stable")[:, :cells]
            rows = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), cells)))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(close.reshape(-1), pa.int32())],
                                             names=[*rows.schema.names, "cell"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType())]))


def _ranked(asked: DataFrame, held: DataFrame, place: list[str], k: int, base_id: str) -> DataFrame:
    """The best ``k`` of each query over all places where its rows meet base rows."""
    def score(queries: pa.Table, base: pa.Table) -> pa.Table:
        order = base.sort_by("bid")
        m, q = _matrix(order.column("v")), _matrix(queries.column("v"))
        width = max(m.shape[1], q.shape[1])
        q, row, at, distance = _unit(_fit(q, width)), *(np.zeros(0, t) for t in (np.int64, np.int64, float))
        for start in range(0, len(m) if len(q) else 0, AT_ONCE):
            d = np.round(1.0 - q @ _unit(_fit(m[start:start + AT_ONCE], width)).T, DIGITS)
            last = np.partition(d, k - 1, axis=1)[:, k - 1:k] if d.shape[1] > k else np.full((len(d), 1), np.inf)
            r, c = np.nonzero(d <= last)
            row, at, distance = (np.concatenate(x) for x in ((row, r), (at, c + start), (distance, d[r, c])))
            best = np.lexsort((at, distance, row))
            best = best[np.arange(len(best)) - np.searchsorted(row[best], row[best]) < k]
            row, at, distance = row[best], at[best], distance[best]
        return pa.table([queries.column("qid").take(pa.array(row)), order.column("bid").take(pa.array(at)), pa.array(distance)],
                        names=["query_id", base_id, "distance"])

    schema = T.StructType([T.StructField("query_id", asked.schema["qid"].dataType),
                           T.StructField(base_id, held.schema["bid"].dataType), T.StructField("distance", T.DoubleType())])
    asked = asked.select("qid", "v", *(F.col(c).alias(f"_{c}") for c in place))  # both sides may come from one table
    scored = asked.groupBy(*(f"_{c}" for c in place)).cogroup(held.groupBy(*place)).applyInArrow(score, schema)
    w = Window.partitionBy("query_id").orderBy("distance", base_id)
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def retrieval_context(hits: DataFrame, query_id: str = "query_id", rank: str = "rank") -> DataFrame:
    """Numbered source blocks of each query, best first; at most ``k`` rows per query."""
    show = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    block = F.concat(
        F.lit("[SOURCE "), F.col(rank).cast("string"), F.lit("]\ndoc_id: "), show("doc_id"), F.lit("\nchunk_id: "),
        show("chunk_id"), F.lit("\ntitle: "), show("title"), F.lit("\ncontent:\n"), show("content"),
    )
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), block.alias("b"))))
    return hits.groupBy(query_id).agg(F.array_join(F.transform(ordered, lambda s: s["b"]), "\n").alias("context"))


def query_audit(
    hits: DataFrame,
    answers: DataFrame,
    as_of: Column,
    top_k: int,
    query_id: str = "query_id",
    rank: str = "rank",
    digits: int = 6,
) -> DataFrame:
    """Audit row per question: sources used, confidence and review flag."""
    source = F.struct(
        F.col(rank).alias("rank"), F.col("doc_id").cast("string").alias("doc_id"),
        F.col("chunk_id").cast("string").alias("chunk_id"), F.round("distance", digits).alias("distance"),
    )
    sources = hits.groupBy(query_id).agg(F.to_json(F.array_sort(F.collect_list(source))).alias("retrieved_sources_json"))
    confidence = F.coalesce(F.col("confidence").cast("double"), F.lit(0.0))
    return answers.join(sources, query_id, "left").select(
        stable_id("question", as_of.cast("string"), length=20).alias("audit_id"),
        query_id,
        as_of.alias("created_at"),
        redact("question").alias("question"),
        F.lit(top_k).alias("top_k"),
        confidence.alias("confidence"),
        ((confidence < 0.65) | F.coalesce(F.col("needs_human_review"), F.lit(True))).alias("needs_human_review"),
        F.coalesce("retrieved_sources_json", F.lit("[]")).alias("retrieved_sources_json"),
    )
