"""Supervised models and clustering on Spark ML pipelines.

Fitting reads its input once per stage and iteration, so each training function first writes
the rows it was given (see :func:`opsight.session.materialise`).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import (
    IDF,
    Imputer,
    IndexToString,
    NGram,
    Normalizer,
    OneHotEncoder,
    RegexTokenizer,
    SQLTransformer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F, types as T

from opsight.functions.scalar import bin_label, lookup
from opsight.operators.forest import Forest
from opsight.operators.metrics import regression_metrics
from opsight.operators.ordered import positions
from opsight.operators.quality import class_weights
from opsight.operators.terms import TermCounts
from opsight.operators.windows import tail_per_key
from opsight.session import collecting, discard, materialise


@dataclass(frozen=True)
class Features:
    """Columns of a model. Every term counts: terms are hashed into ``terms`` columns, none is dropped."""

    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    text: str | None = None
    label: str | None = None
    #: Rows that a term must be in; the weight of a rarer one is 0.
    min_df: int = 2
    terms: int = 1 << 18
    #: Language whose stop words are left out before words are paired.
    stop_words: str | None = None


def fill_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, by one aggregate per column over its value counts."""
    modes = {}
    for c in columns:
        top = df.filter(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), c).limit(1).collect()
        if top:
            modes[c] = top[0][0]
    return modes


def text_stages(spec: Features) -> list[Transformer]:
    """Counts of words and word pairs, from the text at once; the words as such are worked out only where their columns are read."""
    words, stop = "txt__words" if spec.stop_words else "txt__one", []
    stages = [RegexTokenizer(inputCol=spec.text, outputCol=words, pattern=r"(?U)\b\w\w+\b", gaps=False)]
    if spec.stop_words:
        stop = StopWordsRemover.loadDefaultStopWords(spec.stop_words)
        stages.append(StopWordsRemover(inputCol=words, outputCol="txt__one", stopWords=stop))
    return [
        *stages,
        NGram(n=2, inputCol="txt__one", outputCol="txt__two"),
        SQLTransformer(statement="SELECT *, concat(txt__one, txt__two) AS txt__all FROM __THIS__"),
        TermCounts(inputCol=spec.text, outputCol="txt__tf", numFeatures=spec.terms, stopWords=stop),
    ]


def feature_stages(spec: Features, scale: bool = True, modes: dict[str, str] | None = None) -> list:
    """Median imputation and scaling, one-hot categories, TF-IDF of words and word pairs at unit length.

    ``modes`` fill missing categories in training and scoring alike.
    """
    stages, parts = [], []
    if spec.numeric:
        imputed = [f"{c}__imp" for c in spec.numeric]
        stages += [
            Imputer(strategy="median", inputCols=list(spec.numeric), outputCols=imputed),
            VectorAssembler(inputCols=imputed, outputCol="num__raw"),
        ]
        if scale:
            stages.append(StandardScaler(inputCol="num__raw", outputCol="num__vec", withMean=True, withStd=True))
        parts.append("num__vec" if scale else "num__raw")
    if spec.categorical:
        index = [f"{c}__ix" for c in spec.categorical]
        hot = [f"{c}__hot" for c in spec.categorical]
        filled = {c: f"{c}__fill" if c in (modes or {}) else c for c in spec.categorical}
        if modes:
            text = {c: str(m).replace("\\", "\\\\").replace("'", "\\'") for c, m in modes.items()}
            added = ", ".join(f"coalesce(`{c}`, '{m}') AS `{c}__fill`" for c, m in text.items())
            stages.append(SQLTransformer(statement=f"SELECT *, {added} FROM __THIS__"))
        # Unknown values go to an extra slot, which one-hot then drops: all zeros.
        stages += [
            StringIndexer(inputCols=list(filled.values()), outputCols=index, handleInvalid="keep"),
            OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True),
        ]
        parts += hot
    if spec.text:
        stages += [
            *text_stages(spec),
            IDF(inputCol="txt__tf", outputCol="txt__idf", minDocFreq=spec.min_df),
            Normalizer(inputCol="txt__idf", outputCol="txt__vec", p=2.0),
        ]
        parts.append("txt__vec")
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def featured(df: DataFrame, spec: Features, keep: Sequence[str] = ()) -> tuple[PipelineModel, DataFrame]:
    """The feature stages fitted to the rows, and the rows' columns ``keep`` with their features, written as a table.

    Every fit and iteration that follows reads vectors; a text is taken apart once, for its counts.
    """
    first: list[str] = []
    with collecting(first):
        wanted = dict.fromkeys([*keep, *spec.numeric, *spec.categorical])
        if spec.text:
            df = text_stages(spec)[-1].transform(df)
            wanted["txt__tf"] = None
        df = materialise(df.select(*wanted))
    stages, apart = feature_stages(spec, modes=fill_modes(df, spec.categorical)), []
    if spec.text:
        apart = [x for x in stages if isinstance(x, (RegexTokenizer, StopWordsRemover, NGram, TermCounts))
                 or isinstance(x, SQLTransformer) and "txt__" in x.getStatement()]
    fitted = Pipeline(stages=[x for x in stages if x not in apart]).fit(df)
    # Without the assembler's name for every column: ten megabytes in each file and plan for 262,144 of them.
    vectors = fitted.transform(df)
    ready = materialise(vectors.select(*keep, F.col("features").alias("features", metadata={})))
    discard(df.sparkSession, first)
    return PipelineModel(stages=[*apart, *fitted.stages]), ready


WORK = ("__imp", "__fill", "__raw", "__vec", "__ix", "__hot", "txt__", "features", "rawPrediction")


def tidy(df: DataFrame) -> DataFrame:
    """Without the working columns of a pipeline."""
    return df.drop(*[c for c in df.columns if any(w in c for w in WORK)])


def weighted(df: DataFrame, label: str) -> DataFrame:
    """Balanced class weight per row; the table of one row per class is broadcast, so no class gathers in one task."""
    return df.join(F.broadcast(class_weights(df, label).select(label, "class_weight")), label)


def stratified_split(
    df: DataFrame, label: str, row_id: str, test_fraction: float = 0.25, seed: int = 42, out: str = "split"
) -> DataFrame:
    """Train/test labels with the same share of every class.

    Rows are ordered by a seeded hash within their class; places come from per-bucket counts,
    so a class holding most of the rows is ranked by many tasks and any retry agrees.
    """
    hashed = df.withColumn("_h", F.xxhash64(F.col(row_id), F.lit(seed)))
    bucket = F.shiftright("_h", 54)
    placed = positions(hashed, [label], ["_h", row_id], bucket=bucket)
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_size"))
    return (
        # One row a class: broadcast, so no class gathers in one task.
        placed.join(F.broadcast(sizes), label)
        .withColumn(out, F.when(F.col("_pos") < F.round(F.col("_size") * test_fraction), "test").otherwise("train"))
        .drop("_h", "_pos", "_size")
    )


def train_classifier(
    df: DataFrame, spec: Features, trees: int = 250, depth: int = 6, seed: int = 42
) -> PipelineModel:
    """Balanced random forest over a 0/1 label."""
    wide = RandomForestClassifier(
        labelCol=spec.label, featuresCol="features", weightCol="class_weight", numTrees=trees, maxDepth=depth, seed=seed
    )
    forest = Forest(wide, spec.label, trees, depth, seed=seed, classes=True)
    df = materialise(df)
    stages = feature_stages(spec, scale=False, modes=fill_modes(df, spec.categorical))
    return Pipeline(stages=[*stages, forest]).fit(weighted(df, spec.label))


#: Rows of a partition that an iterative model keeps.
TRAIN_ROWS = 250_000


def dealt(df: DataFrame) -> DataFrame:
    """The rows in partitions of bounded size: a model keeps them and every iteration's tasks read them whole.

    Rows are counted by partition, as the splits of a file may be many and one of them hold its only row group.
    """
    held = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    rows, most = held.agg(F.sum("n"), F.max("n")).first()
    if (most or 0) <= TRAIN_ROWS:
        return df
    return df.repartition(max(-(-rows // TRAIN_ROWS), df.rdd.getNumPartitions()))


def train_logistic(df: DataFrame, spec: Features, iterations: int = 10_000) -> PipelineModel:
    """Logistic regression with balanced class weights, run until it converges."""
    df = dealt(materialise(df))
    model = LogisticRegression(labelCol=spec.label, weightCol="class_weight", maxIter=iterations)
    stages = feature_stages(spec, modes=fill_modes(df, spec.categorical))
    return Pipeline(stages=[*stages, model]).fit(weighted(df, spec.label))


def score_risk(model: Model, df: DataFrame, out: str = "failure_probability") -> DataFrame:
    """Probability of the positive class as a plain column."""
    scored = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    return tidy(scored).drop("probability")


def train_text_classifier(df: DataFrame, spec: Features, iterations: int = 1_000) -> PipelineModel:
    """Text, category and number features into a multiclass logistic model over string labels."""
    features, df = featured(df, spec, [spec.label])
    df = weighted(df, spec.label)
    labels = StringIndexer(inputCol=spec.label, outputCol="label__ix").fit(df)
    model = LogisticRegression(labelCol="label__ix", weightCol="class_weight", maxIter=iterations)
    names = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels.labels)
    # Scoring needs no label: keep the fitted label indexer out of the scoring pipeline.
    return PipelineModel(stages=[*features.stages, model.fit(labels.transform(df)), names])


def classify_text(model: Model, df: DataFrame, routing: dict[str, str] | None = None) -> DataFrame:
    """Predicted label, confidence (highest probability) and the team it routes to."""
    scored = model.transform(df).withColumn("confidence", F.array_max(vector_to_array("probability")))
    if routing:
        scored = scored.withColumn("routing_team", lookup("predicted_label", routing))
    return tidy(scored).drop("probability", "prediction")


def cluster_sweep(df: DataFrame, spec: Features, ks: Sequence[int] = range(2, 8), seed: int = 42) -> DataFrame:
    """Silhouette for each number of clusters; features are computed once."""
    _, features = featured(df, spec)
    judge = ClusteringEvaluator(featuresCol="features", metricName="silhouette")
    rows = [(k, float(judge.evaluate(means(k, seed).fit(features).transform(features)))) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, silhouette double")


def means(k: int, seed: int, out: str = "prediction", iterations: int = 300) -> KMeans:
    """K-means run until the centres rest, which measures whole blocks of sparse rows against all centres in one product."""
    return KMeans(k=k, seed=seed, maxIter=iterations, featuresCol="features", predictionCol=out, solver="block")


def train_clusters(df: DataFrame, spec: Features, k: int = 5, seed: int = 42) -> PipelineModel:
    """Stages that give any rows, those of the fit or later ones, their features and the nearest centre."""
    fitted, features = featured(df, spec)
    return PipelineModel(stages=[*fitted.stages, means(k, seed, "cluster_id").fit(features)])


def cluster_rows(df: DataFrame, spec: Features, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Key and cluster of the rows that the clusters are found on."""
    return assign_clusters(train_clusters(df, spec, k, seed), df).select(key, "cluster_id")


def assign_clusters(model: Model, df: DataFrame) -> DataFrame:
    return tidy(model.transform(df))


def reduce_2d(df: DataFrame, spec: Features, key: str) -> DataFrame:
    """Key and the two coordinates of a truncated singular value decomposition of the features, which are not centred."""
    return truncated_svd(featured(df, spec, [key])[1], "features", 2).select(
        key, F.col("coordinates")[0].alias("pc_1"), F.col("coordinates")[1].alias("pc_2"))


def truncated_svd(df: DataFrame, vector: str, k: int, extra: int = 14, rounds: int = 60, tolerance: float = 1e-9,
                  seed: int = 7) -> DataFrame:
    """The columns of ``df`` but ``vector``, and ``coordinates`` on the first ``k`` right singular vectors.

    Subspace iteration from a random basis of ``k + extra`` vectors: each round reads the sparse
    rows once, every task adds up its part of ``A'(A Q)`` and sends it in blocks of columns, which
    are summed by block. The driver holds that matrix alone, vector length times ``k + extra``,
    and stops once the wanted vectors stay within the tolerance. Signs make the largest weight of
    each vector positive.
    """
    rest = [c for c in df.columns if c != vector]
    sparse = F.unwrap_udt(vector)
    dense = F.transform(sparse["values"], lambda _, i: i)
    rows = materialise(df.select(*rest, sparse["size"].alias("_size"), sparse["values"].alias("_values"),
                                 F.coalesce(sparse["indices"], dense).alias("_places")))
    size = rows.agg(F.max(F.coalesce("_size", F.size("_values")))).first()[0] or 0
    width = min(k + extra, size)
    if not size:
        return rows.select(*rest, F.array().cast("array<double>").alias("coordinates"))
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, width)))[0]
    context = df.sparkSession.sparkContext
    for _ in range(rounds):
        sent = context.broadcast(basis)
        parts = rows.select("_places", "_values").mapInArrow(_spread_back(sent, size, width), "block int, cells binary")
        summed = parts.groupBy("block").applyInArrow(_sum_blocks, "block int, cells binary").toArrow().sort_by("block")
        image = np.concatenate([np.frombuffer(v) for v in summed.column("cells").to_pylist()]).reshape(size, width)
        sent.destroy()
        values, turn = np.linalg.eigh(basis.T @ image)
        found = basis @ turn[:, ::-1][:, :k]
        # A vector of the space is right where A'A only stretches it.
        off = np.linalg.norm(image @ turn[:, ::-1][:, :k] - found * values[::-1][:k], axis=0)
        if (off <= tolerance * max(values[-1], 1e-300)).all():
            break
        basis = np.linalg.qr(image)[0]
    top = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
    sent = context.broadcast(top)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values, owner = _cells(batch)
            at = np.stack([np.bincount(owner, values * c, batch.num_rows) for c in sent.value[places].T], axis=1)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(at.tolist(), pa.list_(pa.float64()))],
                                             names=[*rest, "coordinates"])

    shape = T.StructType([*rows.select(*rest).schema.fields, T.StructField("coordinates", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(project, shape)


#: Columns of a matrix that travel in one row.
BLOCK = 1 << 15


def _cells(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column, value and row number of every cell of sparse rows."""
    places, values = batch.column("_places"), batch.column("_values")
    sizes = np.diff(values.offsets.to_numpy())
    return (places.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy(),
            np.repeat(np.arange(batch.num_rows), sizes))


def _spread_back(sent, size: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, total = sent.value, np.zeros((size, width))
        for batch in batches:
            places, values, owner = _cells(batch)
            if not len(places):
                continue
            used, number = np.unique(places, return_inverse=True)
            for c in range(width):
                image = np.bincount(owner, values * basis[places, c], batch.num_rows)
                total[used, c] += np.bincount(number, values * image[owner], len(used))
        edges = range(0, size, BLOCK)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(edges)), pa.int32()), pa.array([total[a:a + BLOCK].tobytes() for a in edges], pa.binary())],
            names=["block", "cells"])

    return run


def _sum_blocks(table: pa.Table) -> pa.Table:
    cells = sum(np.frombuffer(v) for v in table.column("cells").to_pylist())
    return pa.table({"block": table.column("block").slice(0, 1), "cells": pa.array([cells.tobytes()], pa.binary())})


def regressor(kind: str, label: str, trees: int = 300, depth: int | None = 6, leaf: int = 2, seed: int = 42):
    if kind == "linear_regression":
        return LinearRegression(labelCol=label, featuresCol="features")
    if kind == "random_forest":
        # Spark's own trees, for wide vectors, have 30 levels at most; an unlimited tree maps to that there.
        wide = RandomForestRegressor(labelCol=label, featuresCol="features", numTrees=trees,
                                     maxDepth=30 if depth is None else depth, minInstancesPerNode=leaf, seed=seed)
        return Forest(wide, label, trees, depth, leaf, seed)
    raise ValueError(f"unknown model type {kind}")


def train_regressor(df: DataFrame, spec: Features, kind: str = "random_forest", **params) -> PipelineModel:
    stages = feature_stages(spec, scale=kind == "linear_regression")
    return Pipeline(stages=[*stages, regressor(kind, spec.label, **params)]).fit(materialise(df))


# Latency bands of a prediction and their actions.
LATENCY_EDGES, LATENCY_LABELS = (0, 300, 700, float("inf")), ("low", "medium", "high")
LATENCY_ACTION = {"low": "none", "medium": "review_trend", "high": "raise_predictive_alert"}


def predict_regression(model: Model, df: DataFrame, label: str | None = None, edges=LATENCY_EDGES) -> DataFrame:
    """Prediction, risk band, action and, when the truth is known, the absolute error."""
    out = tidy(model.transform(df)).withColumn("risk_level", bin_label("prediction", edges, LATENCY_LABELS, right=False))
    out = out.withColumn("recommended_action", lookup("risk_level", LATENCY_ACTION))
    return out.withColumn("absolute_error", F.abs(F.col(label) - F.col("prediction"))) if label else out


def forecast_next(
    model: Model, prepared: DataFrame, keys: Sequence[str], ts: str, tiebreak: str, step: str = "5 MINUTES",
    edges=LATENCY_EDGES,
) -> DataFrame:
    """Prediction for the step after the newest row of each series."""
    last = tail_per_key(prepared, keys, [F.desc(ts), F.desc(tiebreak)], 1).drop("recency")
    return predict_regression(model, last, edges=edges).withColumn("forecast_for", F.col(ts) + F.expr(f"INTERVAL {step}"))


# The model variants compared.
EXPERIMENTS = (
    {"run_name": "rf-n100-depth4-leaf1", "kind": "random_forest", "trees": 100, "depth": 4, "leaf": 1},
    {"run_name": "rf-n300-depth6-leaf2", "kind": "random_forest", "trees": 300, "depth": 6, "leaf": 2},
    {"run_name": "rf-n500-depth8-leaf2", "kind": "random_forest", "trees": 500, "depth": 8, "leaf": 2},
    {"run_name": "rf-n300-depth-none-leaf2", "kind": "random_forest", "trees": 300, "depth": None, "leaf": 2},
    {"run_name": "linear-regression-baseline", "kind": "linear_regression", "trees": 0, "depth": 0, "leaf": 0},
)


def experiment_grid(train: DataFrame, test: DataFrame, spec: Features, runs: Sequence[dict] = EXPERIMENTS) -> DataFrame:
    """Error metrics of each variant on the test rows, one row per run.

    The variants share one fitted feature stage. Trees ignore scaling, so it serves them too.
    """
    results = None
    train, test = materialise(train), materialise(test)
    features = Pipeline(stages=feature_stages(spec)).fit(train)
    # Written, not kept in memory: the scores below are read when the caller asks for them.
    ready, held = (materialise(features.transform(d).select("features", spec.label)) for d in (train, test))
    for run in runs:
        params = {k: v for k, v in run.items() if k not in ("run_name", "kind")} if run["kind"] == "random_forest" else {}
        model = regressor(run["kind"], spec.label, **params).fit(ready)
        scores = regression_metrics(model.transform(held), spec.label, "prediction").select(
            F.lit(run["run_name"]).alias("run_name"), F.lit(run["kind"]).alias("model_type"), "n", "mae", "rmse", "r2"
        )
        results = scores if results is None else results.unionByName(scores)
    return results


def feature_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Importance by feature name, from the fitted forest and the vector's own metadata."""
    fitted: Transformer = model.stages[-1]
    attrs = model.transform(df.limit(1)).schema["features"].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    rows = [(names[i].replace("num__raw_", "").replace("__imp", ""), float(v))
            for i, v in enumerate(fitted.featureImportances.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")
