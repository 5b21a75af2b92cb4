"""Rules on hand-made rows: nulls, ties, masks, policies, documents."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from opsight.functions import audit as U, nested as N, scalar as S, text as X
from opsight.operators import anomalies as A, drift as R, governance as G, metrics as M, quality as Q, retrieval as V
from opsight.operators import kpi as K, security as Z
from opsight.operators.decisions import mitigation, score_events


def one(spark, expr, schema="x int", row=(1,)):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).collect()[0]["v"]


@pytest.mark.parametrize("value,want", [("12.9", 12), ("-3.7", -3), ("", 0), ("abc", 0), (None, 0), ("1e3", 1000), ("NaN", 0)])
def test_to_int_or(spark, value, want):
    assert one(spark, S.to_int_or("x"), "x string", (value,)) == want


@pytest.mark.parametrize("value,want", [(0.35, "low"), (0.36, "medium"), (1.01, "high"), (1.02, None), (-0.01, None)])
def test_right_closed_bins(spark, value, want):
    assert one(spark, S.bin_label("x", [-0.01, 0.35, 0.7, 1.01], ["low", "medium", "high"]), "x double", (value,)) == want


def test_left_closed_bins(spark):
    edges, labels = [0, 300, 700, float("inf")], ["low", "medium", "high"]
    assert one(spark, S.bin_label("x", edges, labels, right=False), "x double", (300.0,)) == "medium"


def test_ratio_of_zero_denominator(spark):
    assert one(spark, S.safe_ratio(F.lit(1), F.lit(0))) is None
    assert one(spark, S.safe_ratio(F.lit(1), F.lit(0), 0)) == 0.0


def test_nan_never_exceeds_a_threshold(spark):
    c = S.finite_or_null(F.lit(float("nan")))
    assert one(spark, S.is_true(c > 1)) is False


@pytest.mark.parametrize("address,want", [
    ("a@x.com", "a***@x.com"), ("ab@x.com", "a***@x.com"), ("abc@x.com", "a***c@x.com"),
    ("first.last+tag@sub.example.org", "f***g@sub.example.org")])
def test_email_mask(spark, address, want):
    assert one(spark, X.protect_text("x"), "x string", (f"to {address}.",)) == f"to {want}."


def test_secrets_are_masked_before_addresses(spark):
    text = ("Authorization: Bearer abc.def password=hunter2&x=1 api_key: k9; 10.20.30.40 "
            "eyJhbGciOi.eyJzdWIi.sig-1 me@corp.io")
    got = one(spark, X.protect_text("x"), "x string", (text,))
    assert got == ("Authorization: Bearer [REDACTED] password=[REDACTED]&x=1 api_key=[REDACTED]; 10.20.x.x "
                   "[JWT_REDACTED] m***@corp.io")
    assert one(spark, X.risk_points("x"), "x string", (text,)) == 23


def test_unicode_boundaries_follow_python(spark):
    text = "née@x.com é12@y.org"
    pattern = X.PATTERNS["email"]
    got = one(spark, X.finding_counts("x")["n_email"], "x string", (text,))
    assert got == len(re.findall(pattern, text))


def test_pseudonym_normalises(spark):
    want = hashlib.sha256(b"s|ann@x.com").hexdigest()[:16]
    assert one(spark, X.pseudonym("x", "s"), "x string", (" Ann@X.com\t",)) == want
    assert one(spark, X.pseudonym("x", "s"), "x string", ("",)) == ""


def test_log_template(spark):
    line = "  POST status=500 latency_ms=2380 trace_id=abc123 Request-ID:r.1 at 2024-01-01T10:00:00Z id 1234567 \n"
    assert one(spark, X.log_template("x"), "x string", (line,)) == (
        "POST status=<STATUS> latency_ms=<NUMBER> trace_id=<TRACE_ID> request_id=<REQUEST_ID> at <TIMESTAMP> id <NUMBER>")


def packed(text, size=1200, overlap=200):
    """Brute-force chunker used only to check the fold."""
    step, closed, current = size - overlap, [], ""
    for p in (q.strip() for q in re.split(r"\n\s*\n", text)):
        if not p:
            continue
        if len(current) + len(p) + 2 <= size:
            current = p if not current else current + "\n\n" + p
            continue
        closed += [current] if current else []
        current = p
        if len(p) > size:
            closed += [p[i:i + size] for i in range(0, len(p), step)]
            current = ""
    closed += [current] if current else []
    return [c if i == 0 or not overlap else closed[i - 1][-overlap:] + "\n\n" + c for i, c in enumerate(closed)]


@pytest.mark.parametrize("text", [
    "", "short", "a\n\nb\n \n c ", "x" * 5000, "\n\n".join("word " * n for n in (10, 300, 5, 230, 240, 1)),
    "é" * 1201 + "\n\n" + "tail", "p" * 1198 + "\n\n" + "q"])
def test_chunks_equal_brute_force(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id int, content string")
    got = [r["content"] for r in V.chunk_documents(df).orderBy("chunk_index").collect()]
    assert got == packed(text)
    plain = V.chunk_documents(df, max_chars=100, overlap=0).orderBy("chunk_index").collect()
    assert [r["content"] for r in plain] == packed(text, 100, 0)


def test_overlapping_keywords_add_up(spark):
    assert one(spark, U.keyword_score("x", U.RESOURCE_TOKENS), "x string", ("PRODUCTION-secrets",)) == 90


@pytest.mark.parametrize("principal,want", [
    (None, "UNKNOWN"), ("", "UNKNOWN"), ("service-1@gcp-sa-x.iam.gserviceaccount.com", "SERVICE_AGENT"),
    ("a@p.iam.gserviceaccount.com", "SERVICE_ACCOUNT"), ("u@x.io", "USER"), ("principal://p", "FEDERATED"), ("x", "OTHER")])
def test_principals(spark, principal, want):
    assert one(spark, U.classify_principal("x"), "x string", (principal,)) == want


def test_map_diff_marks_undefined(spark):
    got = one(spark, N.map_diff("b", "a"), "b map<string,string>, a map<string,string>", ({"k": "1", "z": "s"}, {"m": "2", "z": "s"}))
    assert got == ["k: 1 -> <undefined>", "m: <undefined> -> 2"]


def test_json_pick_tolerates_bad_json(spark):
    assert one(spark, N.json_pick("x", ["b", "a"]), "x string", ('{"a":1,"b":2,"c":3}',)) == '{"b":"2","a":"1"}'
    assert one(spark, N.json_pick("x", ["a"]), "x string", ("{oops",)) == "{}"


def test_message_round_trip(spark):
    df = spark.createDataFrame([("s", 1.5)], "service string, score double").select(N.encode_message("service", "score").alias("d"))
    assert df.select(N.decode_message("d", "service string, score double").alias("m")).collect()[0]["m"] == ("s", 1.5)


def test_money(spark):
    df = spark.range(1).select(F.struct(F.lit("12").alias("units"), F.lit(500_000_000).alias("nanos")).alias("m"))
    assert df.select(S.money_to_double("m").alias("v")).collect()[0]["v"] == 12.5


def test_ranking_metrics_with_ties_and_single_class(spark):
    rows = [("a", 1, 0.9), ("a", 0, 0.9), ("a", 1, 0.4), ("a", 0, 0.1), ("b", 1, 0.3), ("b", 1, 0.2)]
    df = spark.createDataFrame(rows, "g string, y int, score double")
    got = {r["g"]: (r["roc_auc"], r["pr_auc"]) for r in M.ranking_metrics(df, by=["g"]).collect()}
    assert got["a"][0] == pytest.approx((0.5 + 1 + 0 + 1) / 4)
    assert got["a"][1] == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3)
    assert got["b"] == (None, None)


def test_sweep_uses_the_double_grid(spark):
    df = spark.createDataFrame([(1, 0.15), (0, 0.15000000000000002)], "y int, score double")
    row = {r["threshold"]: r for r in M.threshold_sweep(df).collect()}[0.15]
    assert (row["tp"], row["fp"]) == (0, 1)


def test_metrics_of_an_empty_side_are_zero(spark):
    df = spark.createDataFrame([(0, 0.1)], "y int, score double")
    r = M.binary_metrics(df).collect()[0]
    assert (r["precision"], r["recall"], r["f1"], r["false_negative_rate"]) == (0, 0, 0, 0)


def test_psi_of_few_edges_and_of_an_empty_side(spark):
    base = spark.createDataFrame([(1.0, 1.0)] * 9 + [(2.0, 1.0)], "a double, b double")
    got = {r["feature"]: r["psi"] for r in R.psi(base, base, ["a", "b"]).collect()}
    assert got["b"] == 0.0
    none = R.psi(base, base.limit(0), ["a"]).collect()
    assert none[0]["psi"] is None


def test_psi_keeps_out_of_range_rows_in_the_denominator(spark):
    base = spark.createDataFrame([(float(i),) for i in range(100)], "a double")
    cur = spark.createDataFrame([(float(i),) for i in range(50)] + [(1000.0,)] * 50, "a double")
    import numpy as np

    x, y = np.arange(100.0), np.array([float(i) for i in range(50)] + [1000.0] * 50)
    edges = np.unique(np.quantile(x, np.linspace(0, 1, 11)))
    pb, pc = np.histogram(x, edges)[0] / 100, np.histogram(y, edges)[0] / 100
    pb, pc = np.where(pb == 0, 1e-4, pb), np.where(pc == 0, 1e-4, pc)
    assert R.psi(base, cur, ["a"]).collect()[0]["psi"] == pytest.approx(float(np.sum((pc - pb) * np.log(pc / pb))))


def test_quality_report_fails_on_each_hard_check(spark):
    df = spark.createDataFrame([(1, "x", 5.0, 1), (1, "x", 200.0, 0)], "id int, s string, v double, y int")
    spec = Q.DatasetSpec(expected=["id", "s", "v", "y", "gone"], target="y", keys=["id", "s"], ranges={"v": (0, 100)})
    rows = {(r["check"], r["column"]): r for r in Q.quality_report(df, spec).collect()}
    assert rows[("duplicate_keys", "id,s")]["value"] == 1 and rows[("out_of_range", "v")]["passed"] is False
    assert rows[("missing_column", "gone")]["passed"] is False and rows[("passed", "*")]["passed"] is False


def test_dummy_columns_take_any_number_of_values(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("c")).unionByName(
        spark.createDataFrame([(None,)], "c string"))
    got = Q.dummy_columns(df, ["c"])
    assert len(got.columns) == 301
    assert got.select(F.expr("c"), F.col("c_7")).filter("c_7 = 1 OR c IS NULL").count() == 2


def test_executive_summary_text(spark):
    saved = spark.createDataFrame([(12345.678,)], "gross_savings double")
    got = {r["metric"]: r["value_text"] for r in K.executive_summary(saved).collect()}
    assert got["gross_savings"] == "12,345.68" and got["roi"] == "0.37x"


def test_no_mitigation_outside_production(spark):
    df = spark.createDataFrame([("dev", "ERROR_SPIKE", "CRITICAL", 99.0, 1.0, 1.0)],
                               "environment string, anomaly_type string, severity string, anomaly_score double, "
                               "latency_ms double, error_rate double")
    assert mitigation(df).collect()[0]["action"] == "LOG_ONLY"


def test_maintenance_demotes_and_non_production_is_never_p1(spark):
    rows = [("prod", "CRITICAL", True), ("dev", "CRITICAL", False), ("prod", "CRITICAL", False)]
    df = spark.createDataFrame(rows, "environment string, severity string, maintenance_window boolean").withColumns({
        "service_tier": F.lit("critical"), "customer_facing": F.lit(True), "latency_ms": F.lit("900"),
        "error_rate": F.lit("0.9"), "expected_latency_ms": F.lit("100"), "max_error_rate": F.lit("0.1")})
    assert [r["final_priority"] for r in score_events(df).collect()] == ["P2", "P2", "P1"]


def test_vector_topk_zero_vector_ties_and_query_blocks(spark):
    base = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, [-1.0, 0.0])],
                                 "vec_id long, embedding array<double>")
    asks = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(5)], "query_id long, embedding array<double>")
    for block in (2, 512):
        got = V.vector_topk(asks, base, 3, query_block=block, base_block=7).orderBy("query_id", "rank").collect()
        assert [(r["query_id"], r["vec_id"]) for r in got] == [(q, v) for q in range(5) for v in (1, 2, 3)]
        assert got[2]["distance"] == 1.0


def test_change_blockers(spark):
    schema = ("change_id string, title string, environment string, change_type string, requested_by string, "
              "owner_functional string, owner_technical string, reason string, affected_resources array<string>, "
              "before map<string,string>, after map<string,string>, test_plan array<string>, rollback_plan array<string>, "
              "approvals array<string>, evidence array<string>")
    row = ("C", "t", "prod", "iam", "r", "f", "t", "why", ["x"], {"action": "alert_only", "threshold": "0.8"},
           {"action": "automatic_remediation", "threshold": "0.9"}, ["p"], [], ["owner_functional"], [])
    r = G.change_control(spark.createDataFrame([row], schema)).collect()[0]
    assert r["risk_points"] == 17 and r["calculated_risk"] == "critical" and r["decision"] == "blocked"
    assert r["blockers"] == ["missing field: rollback_plan", "rollback plan required", "production change needs evidence",
                             "operations approval required", "security approval required"]
    assert r["warnings"] == ["threshold change: check alert volume"]


def test_explanations_follow_reason_order(spark):
    df = spark.createDataFrame([(float(i), float(i), float(i), float(i), float(i)) for i in range(100)],
                               "l double, e double, t double, c double, m double").withColumn("flag", F.col("l") > 90)
    got = A.explain_anomalies(df, "flag", {"latency": "l", "errors": "e", "traffic": "t", "cpu": "c", "memory": "m"})
    top = got.filter("l = 99").collect()[0]
    assert top["anomaly_reason"] == "high_latency, high_error_rate, high_cpu, high_memory"
    assert top["recommended_action"] == "check_logs_and_deployments"
    assert got.filter("l = 91").collect()[0]["anomaly_reason"] == "odd_combination"


def test_audit_entry_with_absent_parts(spark):
    df = spark.createDataFrame([('{"protoPayload": {"methodName": "SetIamPolicy"}}',)], "j string")
    entry = df.select(F.from_json("j", Z.AUDIT_ENTRY).alias("e")).select("e.*")
    r = Z.audit_risk(entry).collect()[0]
    assert (r["principal"], r["status_code"], r["risk_score"], r["denied_permissions"]) == ("UNKNOWN", 0, 40, "")


def test_topk_searches_repeated_and_null_ids(spark):
    """Queries that share an id across a block's edge are all searched, and NULL ids do not stop the search from ending."""
    from opsight.operators.retrieval import vector_topk

    unit = lambda i: [float(i == j) for j in range(4)]
    base = spark.createDataFrame([(i, unit(i)) for i in range(4)], "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(q, unit(i)) for i, q in enumerate([2, 2, None, 5])],
                                    "query_id long, embedding array<double>").coalesce(1)
    found = vector_topk(queries, base, 2, query_block=2, base_block=3).filter("distance < 0.5").collect()
    assert {(r["query_id"], r["vec_id"]) for r in found} == {(2, 0), (2, 1), (None, 2), (5, 3)}


def test_exact_ks_over_all_arrangements():
    """P(D >= d) by counting every order of 5 and 6 values, and of some other sizes."""
    from itertools import combinations
    from math import comb

    from opsight.operators.drift import paths_beyond

    for n, m in ((5, 6), (1, 1), (1, 4), (4, 4), (6, 3)):
        reached = []
        for places in combinations(range(n + m), n):
            i = j = most = 0
            for at in range(n + m):
                i, j = (i + 1, j) if at in places else (i, j + 1)
                most = max(most, abs(i * m - j * n))
            reached.append(most)
        for d in range(0, n * m + 1):
            assert abs(paths_beyond(n, m, d) - sum(x >= d for x in reached) / comb(n + m, n)) < 1e-12
    assert 0.9 < paths_beyond(3000, 2500, 100_000) <= 1.0 and paths_beyond(3000, 2500, 3000 * 2500) < 1e-9


def test_ks_is_exact_for_small_sides_and_asymptotic_beyond(spark):
    from opsight.operators.drift import ks_2samp

    base = spark.createDataFrame([(float(i),) for i in range(5)], "x double")
    cur = spark.createDataFrame([(float(i) + 2.5,) for i in range(6)], "x double")
    r = ks_2samp(base, cur, ["x"]).collect()[0]
    # All of the base and two of six lie at or below 4: D = 20 / 30.
    assert r["ks_statistic"] == pytest.approx(2 / 3) and r["ks_pvalue"] == pytest.approx(R.paths_beyond(5, 6, 20))
    far = ks_2samp(base, cur, ["x"], exact=5).collect()[0]
    assert far["ks_statistic"] == r["ks_statistic"] and far["ks_pvalue"] != r["ks_pvalue"]


def test_latency_quantiles_are_exact_in_large_groups(spark):
    """A sketch is off by some ranks beyond 10,000 rows; NULL groups and groups without a value stay."""
    from opsight.operators.slo import daily_slo, latency_quantiles

    df = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("service_name"),
        F.lit("2024-01-01 10:00:00").cast("timestamp").alias("event_ts"), F.lit(200).alias("status_code"),
        ((F.col("id") * 7919) % 100_003).alias("latency_ms"))
    df = df.union(spark.sql("SELECT 'none', TIMESTAMP '2024-01-01 10:00:00', 200, CAST(NULL AS BIGINT)"))
    want = {}
    for r in df.filter("latency_ms IS NOT NULL").groupBy("service_name").agg(F.sort_array(F.collect_list("latency_ms")).alias("v")).collect():
        want[r[0]] = tuple(r["v"][-(-len(r["v"]) * p // 100) - 1] for p in (95, 99))
    want["none"] = (None, None)
    got = latency_quantiles(df, ["service_name"], "latency_ms", {"a": 0.95, "b": 0.99}).collect()
    assert {r["service_name"]: (r["a"], r["b"]) for r in got} == want
    daily = daily_slo(df).collect()
    assert {r["service_name"]: (r["latency_p95_ms"], r["latency_p99_ms"]) for r in daily} == want
    assert {r["service_name"]: r["total_requests"] for r in daily} == {None: 20_000, "s1": 20_000, "s2": 20_000, "none": 1}


def test_texts_that_cannot_match_are_not_searched(spark):
    """The regex stands behind a search for bytes, and finds what it finds alone, in any case and beyond ASCII."""
    texts = ["", None, "BeArEr abc", "bearer\u00a0x", "pa\u017fsword=x", "PWD = y", "x-api-\u212aey: z", "\u017fecret=1", "client_secret:q",
             "a@b.co", "1.2.3.4", "\u0661.2.3.4", "eyJa.b.c", "EYJa.b.c", "a = b", "note: c", "bearer", "secret", "\u0130 bearer t"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    alone = {k: F.regexp_count(F.coalesce("t", F.lit("")), F.lit(X.unicode_aware(p))).alias(f"n_{k}") for k, p in X.PATTERNS.items()}
    points = sum((F.when(c > 0, X.RISK_POINTS[k]).otherwise(0) for k, c in alone.items()), F.lit(0))
    want = df.select("id", *alone.values(), points.alias("p")).orderBy("id").collect()
    assert df.select("id", *[c.alias(n) for n, c in X.finding_counts("t").items()], X.risk_points("t").alias("p")).orderBy("id").collect() == want
    plan = df.select(X.risk_points("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(" in plan
