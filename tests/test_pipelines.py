"""Sources, sinks, streams and models."""

import json
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsight.operators import isolation as I, models as M
from opsight.plans.streams import stream
from opsight.sources import files as FS, tables as T
from opsight.streaming import pipelines as S
from tests.conftest import SF_DIR


def test_csv_refuses_missing_columns(spark, tmp_path):
    (tmp_path / "e.csv").write_text("a,b\n1,x\n")
    with pytest.raises(ValueError, match="c"):
        FS.read_events_csv(spark, str(tmp_path / "e.csv"), "a int, b string", ["a", "c"])
    rows = FS.read_events_csv(spark, str(tmp_path / "e.csv"), "b string, a int", ["a"]).collect()
    assert rows == [(1, "x")]


def test_jsonl_appends_and_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    FS.append_jsonl(df, str(tmp_path / "log"))
    FS.append_jsonl(df, str(tmp_path / "log"))
    lines = [l for p in (tmp_path / "log").glob("*.json") for l in p.read_text().splitlines()]
    assert [json.loads(l) for l in lines] == [{"a": 1, "b": None}] * 2


def test_documents_have_titles(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "run_book.md").write_text("intro\n## Disk full ##\nbody password=x")
    (tmp_path / "plain_note.txt").write_text("no heading")
    (tmp_path / "skip.pdf").write_text("# no")
    got = {r["title"]: r["content"] for r in FS.read_documents(spark, str(tmp_path)).collect()}
    assert set(got) == {"Disk full ##", "Plain Note"}
    assert got["Disk full ##"].endswith("password=[REDACTED_PASSWORD]")


def test_typed_overwrite_refuses_missing_required(spark):
    with pytest.raises(ValueError):
        T.as_schema(spark.range(1), "id bigint not null, name string not null")


def test_a_retried_batch_leaves_no_duplicates(spark, tmp_path):
    from opsight.sources.messages import split_writer

    write = split_writer({"all": lambda d: d, "even": lambda d: d.filter("id % 2 = 0")}, str(tmp_path))
    for batch in (0, 1, 1):
        write(spark.range(10), batch)
    assert spark.read.parquet(str(tmp_path / "all")).count() == 20
    assert spark.read.parquet(str(tmp_path / "even")).count() == 10


def test_restart_from_checkpoint_processes_each_file_once(spark, tables, tmp_path):
    for _ in range(2):
        S.parse_split(stream(tables, "messages"), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    events = spark.read.parquet(str(tmp_path / "out" / "events")).count()
    dead = spark.read.parquet(str(tmp_path / "out" / "dead")).count()
    assert events + dead == tables.messages.count()


def test_stream_equals_batch(spark, tables):
    from opsight.operators.decisions import score_events

    cols = ["event_id", "incident_probability", "final_priority"]
    streamed = S.run_to_end(S.score_stream(stream(tables, "enriched")), "t").select(cols)
    batch = score_events(tables.enriched).select(cols)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_bad_numbers_go_to_the_dead_letters(spark):
    from opsight.streaming.parse import dead_letters, normalised, parse_messages

    rows = [('{"jsonPayload":{"service_name":"s","event_type":"e","latency_ms":"abc"}}',),
            ('{"jsonPayload":{"service_name":"s","event_type":"e","aiops_candidate":"false","latency_ms":12.9}}',),
            ('{"jsonPayload":{"service_name":"","event_type":"e"}}',)]
    parsed = parse_messages(spark.createDataFrame(rows, "raw string"), "raw")
    assert [r["error_message"] for r in dead_letters(parsed).collect()] == [
        "invalid number: latency_ms or error_rate", "missing mandatory field: service_name or event_type"]
    good = normalised(parsed).collect()[0]
    assert (good["aiops_candidate"], good["latency_ms"], good["environment"]) == (False, 12, "unknown")


def test_isolation_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 2))
    x[:12] += 8
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id long, a double, b double")
    out = I.isolation_forest(df, ["a", "b"], "id", trees=50, contamination=0.02).cache()
    flagged = {r["id"] for r in out.filter("is_anomaly").collect()}
    assert len(flagged) == 12 and len(flagged & set(range(12))) >= 11
    again = I.isolation_forest(df.repartition(5), ["a", "b"], "id", trees=50, contamination=0.02)
    assert {r["id"] for r in again.filter("is_anomaly").collect()} == flagged


def classes(spark, n=400):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.25)
        rows.append((i, float(rng.normal(3 * y)), "a" if rng.random() < 0.3 + 0.5 * y else "b",
                     "error timeout database" if y else "all good today", y, "bad" if y else "ok"))
    return spark.createDataFrame(rows, "id long, v double, c string, t string, y int, label string")


def test_classifiers_learn(spark):
    df = M.stratified_split(classes(spark), "y", "id", 0.3)
    spec = M.Features(numeric=["v"], categorical=["c"], label="y")
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    for model in (M.train_classifier(train, spec, trees=10), M.train_logistic(train, spec)):
        r = M.score_risk(model, test).agg(F.avg((F.col("prediction") == F.col("y")).cast("int")).alias("acc")).collect()[0]
        assert r["acc"] > 0.85
    unseen = test.withColumn("c", F.lit("never seen"))
    assert M.score_risk(model, unseen).filter("failure_probability is null").count() == 0


def test_text_classifier_scores_without_label(spark):
    df = classes(spark)
    spec = M.Features(numeric=["v"], categorical=["c"], text="t", label="label")
    model = M.train_text_classifier(df, spec, iterations=10)
    out = M.classify_text(model, df.drop("label"), {"bad": "sre"}).collect()
    assert {r["predicted_label"] for r in out} == {"bad", "ok"}
    assert {r["routing_team"] for r in out} == {"sre", None} and min(r["confidence"] for r in out) >= 0.5


def test_stratified_split_is_stable_and_proportional(spark):
    df = classes(spark)
    a = M.stratified_split(df, "y", "id", 0.25)
    b = M.stratified_split(df.repartition(7), "y", "id", 0.25)
    assert a.select("id", "split").exceptAll(b.select("id", "split")).count() == 0
    for y, n in df.groupBy("y").count().collect():
        assert a.filter((F.col("y") == y) & (F.col("split") == "test")).count() == int(n * 0.25 + 0.5)


def test_feature_importance_names_columns(spark):
    df = classes(spark)
    spec = M.Features(numeric=["v"], categorical=["c"], label="y")
    got = {r["feature"]: r["importance"] for r in M.feature_importance(M.train_classifier(df, spec, trees=5), df).collect()}
    assert "v" in got and abs(sum(got.values()) - 1) < 1e-6


@pytest.mark.parametrize("files", [1, 6])
def test_suppression_is_the_same_in_one_batch_or_many(spark, tmp_path, files):
    minutes = [0, 0, 20, 60, 61, 70, 121, 122, 300, 359, 361, 500]
    step = len(minutes) // files
    for i in range(files):
        part = minutes[i * step:(i + 1) * step]
        rows = [(k, m) for m in part for k in ("a", "b")]
        (spark.createDataFrame(rows, "k string, m int").coalesce(1)
         .select("k", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("m") * 60).alias("ts"))
         .write.mode("append").parquet(str(tmp_path / "in")))
    items = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    sent = S.run_to_end(S.suppress_stream(items, ["k"], "ts"), "suppress")
    got = sent.select("k", ((F.unix_seconds("ts") - 1_700_000_000) / 60).cast("int").alias("m")).collect()
    assert sorted(map(tuple, got)) == [(k, m) for k in ("a", "b") for m in (0, 61, 122, 300, 361, 500)]


def test_scoring_fills_missing_categories_with_the_training_mode(spark):
    rows = [(i, float(i % 7), "it's" if i % 4 else "rare", i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, x double, kind string, label int")
    spec = M.Features(numeric=["x"], categorical=["kind"], label="label")
    model = M.train_classifier(df, spec, trees=5)
    one = spark.createDataFrame([(1, 3.0, None), (2, 3.0, "it's")], "id int, x double, kind string")
    got = {r["id"]: r["failure_probability"] for r in M.score_risk(model, one).collect()}
    assert got[1] == got[2]


def test_text_vectors_have_unit_length_and_no_stop_words(spark):
    df = spark.createDataFrame([(1, "the disk is full and the disk fails"), (2, "the network is down")], "id int, t string")
    fitted = M.Pipeline(stages=M.feature_stages(M.Features(text="t", min_df=1, stop_words="english"))).fit(df)
    norms = fitted.transform(df).select(M.vector_to_array("txt__vec").alias("v")).collect()
    assert [round(sum(x * x for x in r["v"]), 9) for r in norms] == [1.0, 1.0]
    terms = {t for r in fitted.transform(df).select("txt__all").collect() for t in r[0]}
    assert "disk full" in terms and not {"the", "is", "and"} & terms


def test_truncated_svd_equals_numpy(spark):
    """Coordinates on the first two right singular vectors, up to sign, of all terms' weights, not centred."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source", F.col("n_chars").cast("double"))
    spec = M.Features(numeric=["n_chars"], categorical=["source"], text="text", min_df=1, terms=1 << 12)
    fitted = M.Pipeline(stages=M.feature_stages(spec)).fit(docs)
    rows = fitted.transform(docs).select("doc_id", M.vector_to_array("features").alias("v")).orderBy("doc_id").collect()
    a = np.array([r["v"] for r in rows])
    v = np.linalg.svd(a, full_matrices=False)[2][:2].T
    want = a @ v
    got = np.array([(r["pc_1"], r["pc_2"]) for r in M.reduce_2d(docs, spec, "doc_id").orderBy("doc_id").collect()])
    assert np.abs(np.abs(got) - np.abs(want)).max() < 1e-6


def test_truncated_svd_of_little(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(1, Vectors.dense(2.0, 0.0)), (2, Vectors.sparse(2, [1], [1.0])), (3, Vectors.sparse(2, [], []))],
                               ["id", "f"])
    got = {r["id"]: [round(x, 9) for x in r["coordinates"]] for r in M.truncated_svd(df, "f", 2).collect()}
    assert got == {1: [2.0, 0.0], 2: [0.0, 1.0], 3: [0.0, 0.0]}
    assert M.truncated_svd(df.limit(0), "f", 2).collect() == []


def test_level_shifts_are_found_on_their_day(spark):
    """Planted shifts of two series, one of which rises and falls; a flat series has none."""
    from datetime import date, timedelta

    from opsight.operators.forecast import adjust_steps, step_changes

    rng = np.random.default_rng(2)
    rows, start = [], date(2024, 1, 1)
    for day in range(200):
        noise = rng.normal(size=3)
        rows += [("up", start + timedelta(day), float(10 + 8 * (day >= 70) + noise[0])),
                 ("both", start + timedelta(day), float(20 + 9 * (day >= 50) - 15 * (day >= 140) + noise[1])),
                 ("flat", start + timedelta(day), float(noise[2])), ("short", start, 1.0)]
    df = spark.createDataFrame(rows + [(None, start, 1.0), ("up", None, 99.0), ("flat", start, None)], "k string, d date, y double")
    got = sorted((r["k"], (r["changed_at"] - start).days, round(r["level_after"] - r["level_before"]))
                 for r in step_changes(df, "k", "d", "y", penalty=6.0).filter("k <> 'short'").collect())
    assert got == [("both", 50, 9), ("both", 140, -15), ("up", 70, 8)]
    level = adjust_steps(df, "k", "d", "y", penalty=6.0).filter("k = 'both'").toPandas().sort_values("d")["y"].to_numpy()
    assert abs(level[:50].mean() - 14) < 0.6 and abs(level[50:140].mean() - 14) < 0.6


def test_forest_fits_as_well_as_sparks_own(spark):
    """On a label that needs two features together, and on a number."""
    from opsight.operators import forest as FO

    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 3))
    rows = [(i, float(a), float(b), float(c), int(a * b > 0), float(3 * a - b)) for i, (a, b, c) in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, label int, y double")
    spec = M.Features(numeric=["a", "b", "c"], label="label")
    model = M.train_classifier(df, spec, trees=20)
    assert isinstance(model.stages[-1], FO.ForestModel)
    scored = M.score_risk(model, df)
    assert scored.filter("prediction = label").count() > 3700
    importance = {r["feature"]: r["importance"] for r in M.feature_importance(model, df).collect()}
    assert importance["c"] < 0.1 and abs(sum(importance.values()) - 1) < 1e-9
    number = M.train_regressor(df, M.Features(numeric=["a", "b", "c"], label="y"), trees=20, depth=8)
    error = number.transform(df).agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0]
    assert error < 0.6
    own = M.RandomForestRegressor(labelCol="y", numTrees=20, maxDepth=8, minInstancesPerNode=2, seed=42)
    stages = M.feature_stages(M.Features(numeric=["a", "b", "c"]), scale=False)
    theirs = M.Pipeline(stages=[*stages, own]).fit(df).transform(df)
    assert abs(theirs.agg(F.sqrt(F.avg((F.col("prediction") - F.col("y")) ** 2))).first()[0] - error) < 0.1


def test_forest_takes_the_best_split():
    """The cut with the least variance left, among those of both features."""
    from opsight.operators import forest as FO

    cells = np.array([[0, 1, 2, 3, 0, 1, 2, 3], [0, 0, 0, 0, 1, 1, 1, 1]], np.uint8)
    y = np.array([1.0, 1, 5, 5, 1, 1, 5, 6])
    stats = np.zeros((2, 3, 1, FO.BINS))  # slot, part, node, bin
    plan = FO.Plan(2, 2, 1, 0, None)
    asked = FO.subsets(0, 0, 0, 2, 2)[0]
    for slot, f in enumerate(asked):
        for part, weight in enumerate((np.ones(8), y, y * y)):
            stats[slot, part, 0] = np.bincount(cells[f], weight, FO.BINS)
    import pyarrow as pa
    best = FO._best(plan, 0)(pa.table({"tree": [0], "bins": [stats.tobytes()]})).to_pylist()[0]
    assert (best["feature"], best["cut"]) == ([0], [1])


def test_sliding_volume_equals_spark_windows_over_batches(spark, tmp_path):
    """Counts of every closed window, once, however the input is cut; an event far behind the watermark is dropped."""
    t0 = 1_700_000_000
    rng = np.random.default_rng(5)
    seconds = np.sort(rng.integers(0, 6 * 3600, 900))
    rows = [(f"u{int(rng.integers(0, 4))}", t0 + int(s)) for s in seconds] + [(None, t0 + 60)]
    cuts = [rows[:300] + [(None, t0 + 60)], rows[300:500], rows[500:900] + [("u0", t0 + 100), ("late", t0 + 30)]]
    for n, part in enumerate(cuts):
        spark.createDataFrame(part, "principal string, s long").select("principal", F.timestamp_seconds("s").alias("event_ts")) \
            .coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = "principal string, event_ts timestamp"
    base = spark.createDataFrame([("u1", 3.0)], "principal string, baseline_event_count double")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = S.run_to_end(S.sliding_volume(stream, base, ratio=2.0), "slide").collect()
    closed = t0 + int(seconds[-1]) - 600
    want = {}
    for who, s in rows[:900] + [(None, t0 + 60)]:
        for i in range(12):
            start = s // 300 * 300 - 300 * i
            if start + 3600 <= closed:
                want[who, start] = want.get((who, start), 0) + 1
    assert len(got) == len(want)
    assert {(r["principal"], int(r["window_start"].timestamp())): r["event_count"] for r in got} == want
    assert all(abs(r["volume_ratio"] - r["event_count"] / (3 if r["principal"] == "u1" else 1)) < 1e-12 for r in got)


def test_class_weights_do_not_shuffle_the_rows_by_class(spark):
    """Few classes hold all rows, so dealing rows by their class would leave most tasks without any."""
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = M.weighted(df, "label")
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert {(r["label"], round(r["class_weight"], 9)) for r in rows.collect()} == {(1, 5.0), (0, round(1000 / 1800, 9))}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert M.dealt(spark.range(4 * M.TRAIN_ROWS + 1, numPartitions=1)).rdd.getNumPartitions() == 5


def test_term_counts_are_those_of_sparks_stages(spark):
    """Odd characters, one long word, stop words, batches of many sizes; a missing text has no terms."""
    from opsight.operators import terms as TC

    odd = ["", "a", "ab", "ÄÖ straße ŞİIı ΣΑΣ x² ½half été na\u200dive हिन्दी 漢字 кот_кот ⓐⓑ 𝔘𝔫 don't the the  the dog-dog 12 3 45.6 ",
           "x" * 5000 + " yy zz " + "é" * 33, "a‿b ‿‿ ①② ٣٤"]
    texts = spark.createDataFrame(list(enumerate(odd)), "id long, t string").unionByName(
        spark.read.parquet(f"{SF_DIR}/documents.parquet").select((F.col("doc_id") + 100).alias("id"), F.col("text").alias("t")))
    for size, stop in ((1 << 16, None), (1000, "english")):
        spec = M.Features(text="t", terms=size, stop_words=stop)
        *apart, counts = M.text_stages(spec)
        from pyspark.ml.feature import HashingTF
        own = HashingTF(inputCol="txt__all", outputCol="want", numFeatures=size)
        both = M.PipelineModel(stages=[*apart, own, counts]).transform(texts).select("id", "want", "txt__tf").collect()
        assert len(both) > 200 and [r["id"] for r in both if r["want"] != r["txt__tf"]] == []
    assert counts.transform(spark.createDataFrame([(None,)], "t string")).first()["txt__tf"].numNonzeros() == 0
    import pyarrow as pa
    rows = pa.array(["ab " * (1 << 20), None, "cd", "ef " * (1 << 20), "gh"])
    assert [b - a for a, b in TC._slices(rows)] == [3, 2]


def test_clusters_of_rows_read_each_text_once_and_take_missing_ones(spark):
    docs = spark.createDataFrame([(i, "disk full on host" if i % 2 else "network link down", float(i % 3)) for i in range(40)]
                                 + [(40, None, 1.0)], "id int, t string, n double")
    spec = M.Features(numeric=["n"], text="t", min_df=1, terms=1 << 10)
    got = {r["id"]: r["cluster_id"] for r in M.cluster_rows(docs, spec, "id", 3).collect()}
    assert len(got) == 41
    model = M.train_clusters(docs.filter("t is not null"), spec, 2)
    assert M.assign_clusters(model, docs.filter("t is not null")).count() == 40
    scored = M.cluster_sweep(docs, spec, [2, 3]).collect()
    assert [r["k"] for r in scored] == [2, 3] and all(-1 <= r["silhouette"] <= 1 for r in scored)


def test_class_sizes_are_broadcast(spark):
    """Joined by a shuffle, all rows of a class land in one task."""
    from contextlib import redirect_stdout
    from io import StringIO

    shown = StringIO()
    with redirect_stdout(shown):
        M.stratified_split(classes(spark), "y", "id").explain()
    assert "hashpartitioning(y#" not in "".join(
        line for line in shown.getvalue().splitlines() if "Exchange" in line and "_pos" in line) and "BroadcastHashJoin [y#" in shown.getvalue()


def test_rows_of_one_row_group_and_of_two_classes_are_dealt_to_many_tasks(spark, tmp_path, monkeypatch):
    """A file has more splits than row groups, and few of many shuffle partitions have a class: neither may gather rows."""
    monkeypatch.setattr(M, "TRAIN_ROWS", 100)
    spark.range(1000, numPartitions=1).select("id", (F.col("id") % 10 == 0).cast("int").alias("label")).write.parquet(
        path := str(tmp_path / "rows"))
    changed = {"spark.sql.files.maxPartitionBytes": "128b", "spark.sql.files.openCostInBytes": "1b",
               "spark.sql.shuffle.partitions": "100", "spark.sql.autoBroadcastJoinThreshold": "1b"}
    held = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        rows = spark.read.parquet(path)
        assert rows.rdd.getNumPartitions() >= 10
        assert rows.select(F.spark_partition_id().alias("p")).distinct().count() == 1
        got = M.weighted(M.dealt(rows), "label").select("id", F.spark_partition_id().alias("p")).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert sorted(r["id"] for r in got) == list(range(1000))
    assert max(Counter(r["p"] for r in got).values()) <= 101
    assert M.dealt(spark.range(0)).count() == 0


def test_clusters_rest_and_rows_are_assigned_by_the_fitted_model(spark, tables, monkeypatch):
    """Evenly spread rows need more than 20 rounds; the query scores its rows with the model, as those that come later are."""
    df = spark.range(2000).select("id", F.col("id").cast("double").alias("x"))
    got = M.cluster_rows(df, M.Features(numeric=["x"]), "id", 5).toPandas().sort_values("id")
    centres = got.groupby("cluster_id")["id"].mean()
    nearest = np.abs(got["id"].to_numpy()[:, None] - centres.to_numpy()).argmin(axis=1)
    assert len(got) == 2000 and (centres.index.to_numpy()[nearest] != got["cluster_id"].to_numpy()).sum() <= 4
    from opsight.plans import models as P

    seen, assign = [], M.assign_clusters
    monkeypatch.setattr(M, "assign_clusters", lambda model, rows: seen.append(model) or assign(model, rows))
    assert P.cluster_events(tables).filter("cluster_id between 0 and 4").count() == tables.documents.count()
    assert len(seen) == 1 and isinstance(seen[0].stages[-1].clusterCenters(), list)


def test_experiment_grid_runs_every_variant(monkeypatch):
    """Also the one of unlimited depth."""
    from types import SimpleNamespace

    from opsight.plans import models as P

    asked = []
    split = SimpleNamespace(filter=lambda _: None)
    monkeypatch.setattr(P, "lagged", lambda t: None)
    monkeypatch.setattr(P.W, "temporal_split", lambda *a, **k: split)
    monkeypatch.setattr(M, "regression_metrics", None)
    monkeypatch.setattr(M, "experiment_grid", lambda train, test, spec, runs=M.EXPERIMENTS: asked.extend(runs))
    P.experiment_grid(None)
    assert [r["depth"] for r in asked] == [4, 6, 8, None, 0]


def leaves_of(grown, cells):
    at = np.zeros(cells.shape[1], int)
    for _ in range(200):
        here = at.copy()
        go = grown["feature"][here] >= 0
        right = cells[grown["feature"][here[go]], np.flatnonzero(go)] > grown["cut"][here[go]]
        at[go] = grown["child"][here[go]] + right
    return at


def test_a_subtree_grows_until_no_node_can_be_split():
    """Against a search of all cuts, node by node; leaves of one row where all cells differ."""
    from opsight.operators import forest as FO

    rng = np.random.default_rng(4)
    cells, y = rng.integers(0, 32, (3, 400)).astype(np.uint8), rng.normal(size=400)
    times = rng.integers(1, 4, 400).astype(float)
    for leaf in (1, 3):
        grown = FO.subtree(FO.Plan(3, 3, leaf, 0, None), cells, y, times, np.inf, np.random.default_rng(0))
        at = leaves_of(grown, cells)
        n = np.bincount(at, times)
        assert n[n > 0].min() >= leaf
        mean = np.bincount(at, times * y) / np.where(n > 0, n, 1)
        assert np.allclose(grown["value"][at], mean[at])
        for node in np.unique(at):  # no leaf has a cut that both sides allow
            r = at == node
            for f in range(3):
                for c in np.unique(cells[f, r]):
                    a = times[r & (cells[f] <= c)].sum()
                    assert not (a >= leaf and times[r].sum() - a >= leaf and np.ptp(y[r]) > 1e-9)
    root, best = None, -1.0
    for f in range(3):
        for c in range(31):
            a = cells[f] <= c
            left, right = times[a].sum(), times[~a].sum()
            if min(left, right) >= 3:
                m = (times * y).sum() / times.sum()
                gain = left * (np.average(y[a], weights=times[a]) - m) ** 2 + right * (np.average(y[~a], weights=times[~a]) - m) ** 2
                root, best = ((f, c), gain) if gain > best + 1e-9 else (root, best)
    assert (grown["feature"][0], grown["cut"][0]) == root
    flat = FO.subtree(FO.Plan(3, 3, 1, 0, None), cells, np.ones(400), times, np.inf, np.random.default_rng(0))
    assert flat["feature"].tolist() == [-1] and flat["value"].tolist() == [1.0]


def test_unlimited_trees_fit_what_shallow_ones_cannot(spark, monkeypatch):
    """As one subtree a tree and as many below levels of histograms, with rows dealt in one round and in several."""
    from opsight.operators import forest as FO

    rng = np.random.default_rng(6)
    x = rng.integers(0, 30, size=(3000, 2))
    noise = rng.normal(size=(30, 30)) * 10  # one level a cell: only a tree of hundreds of leaves has it
    rows = [(i, float(a), float(b), float(noise[a, b])) for i, (a, b) in enumerate(x)]
    df = spark.createDataFrame(rows + [(3000, None, 1.0, None)], "id int, a double, b double, y double")
    spec = M.Features(numeric=["a", "b"], label="y")
    shallow = M.train_regressor(df, spec, trees=30, depth=6, leaf=1)

    def error(model):
        out = model.transform(df).select("id", "y", "prediction").collect()
        assert sorted(r["id"] for r in out) == list(range(3001)) and all(r["prediction"] is not None for r in out)
        return np.sqrt(np.mean([(r["y"] - r["prediction"]) ** 2 for r in out if r["y"] is not None]))

    assert error(shallow) > 6
    for most, at_once in ((1 << 18, 4 << 30), (400, 300_000)):
        monkeypatch.setattr(FO, "SUBTREE_ROWS", most)
        monkeypatch.setattr(FO, "ROUND_BYTES", at_once)
        deep = M.train_regressor(df, spec, trees=30, depth=None, leaf=1)
        assert isinstance(deep.stages[-1], FO.DeepForestModel) and deep.stages[-1].level == (0 if most > 3000 else 4)
        assert error(deep) < 3
        importance = deep.stages[-1].featureImportances.toArray()
        assert abs(importance.sum() - 1) < 1e-9 and abs(importance[0] - 0.5) < 0.1
    capped = M.train_regressor(df, spec, trees=5, depth=11, leaf=1).stages[-1]
    for r in capped.below.collect():
        feature, child = np.frombuffer(r["feature"], np.int16), np.frombuffer(r["child"], np.int32)
        depth = {0: 0}
        for i in np.flatnonzero(feature >= 0):
            depth[child[i]] = depth[child[i] + 1] = depth[i] + 1
        assert max(depth.values()) + int(np.log2(r["node"] + 1)) <= 11


def test_documents_are_read_as_the_text_source_reads_them(spark, tmp_path):
    """Whatever the bytes; many small files make few tasks."""
    from opsight.functions.text import redact

    for i, raw in enumerate((b"\xef\xbb\xbfa\r\nb\r", "ä\u2028ö".encode(), b"\xff\xfe\x00broken", b"\n", b"x" * 70_000)):
        (tmp_path / f"f{i}.txt").write_bytes(raw)
    whole = spark.read.text(str(tmp_path), wholetext=True).select(F.md5(redact("value")).alias("m"))
    got = FS.read_documents(spark, str(tmp_path)).select(F.md5("content").alias("m"))
    assert got.count() == 5 and sorted(got.collect()) == sorted(whole.collect())
    for i in range(5000):
        (tmp_path / f"g{i}.md").write_bytes(b"# g")
    many = FS.read_documents(spark, str(tmp_path))
    assert many.count() == 5005 and many.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("scheme", ["file", "other"])
def test_every_document_is_written_as_a_file_of_its_own(spark, tmp_path, monkeypatch, scheme):
    """By the tasks, and by Spark's writer where they do not see the files; keys may come twice or be missing."""
    from types import SimpleNamespace

    find = FS.file_system
    if scheme != "file":
        there = SimpleNamespace(mkdirs=lambda _: None, getUri=lambda: SimpleNamespace(getScheme=lambda: scheme))
        monkeypatch.setattr(FS, "file_system", lambda s, f: (find(s, f)[0], there))
    monkeypatch.setattr(FS, "FOLDER_FILES", 2)
    rows = [(1, "a"), (2, None), (1, "b"), (-3, "ä\nc"), (None, "n")]
    FS.write_documents(spark.createDataFrame(rows, "k long, t string").repartition(2) if scheme == "file" else
                       spark.createDataFrame(rows[1:], "k long, t string"), str(tmp_path / "d"))
    got = FS.read_documents(spark, str(tmp_path / "d")).select(
        F.regexp_extract("source_path", r"/doc=(-?\d+)[./]", 1).try_cast("bigint"), "content").collect()
    want = rows if scheme == "file" else rows[1:]
    assert sorted(map(str, map(tuple, got))) == sorted(str((k, f"{t or ''}\n")) for k, t in want)
    if scheme == "file":
        assert not list((tmp_path / "d").glob("_*")) and max(len(list(p.iterdir())) for p in (tmp_path / "d").glob("*/*")) <= 2
