"""Chunked windows, carried values and sessions against brute force."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from opsight.operators import joins as J, ordered as O, windows as W
from opsight.operators.ordered import over_frames, positions, running_sum, session_numbers
from opsight.operators.quantiles import cumulate, distinct_counts, exact_quantiles

START = datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, ts timestamp, id long, v double")


def series(n=400, seed=0, keys=("hot", "b", "c")):
    rng = np.random.default_rng(seed)
    # One key holds most rows; times repeat.
    key = rng.choice(keys, n, p=[0.8, 0.1, 0.1])
    minute = rng.integers(0, n // 2, n)
    return [(str(k), START + timedelta(minutes=int(m)), i, float(v))
            for i, (k, m, v) in enumerate(zip(key, minute, rng.normal(size=n).round(3)))]


def pandas_of(rows):
    return pd.DataFrame(rows, columns=["k", "ts", "id", "v"]).sort_values(["k", "ts", "id"])


def test_positions_number_rows_of_a_hot_key(spark):
    rows = series()
    got = positions(frame(spark, rows), ["k"], ["ts", "id"], "10 minutes").toPandas().set_index("id")["_pos"]
    want = pandas_of(rows).assign(p=lambda d: d.groupby("k").cumcount()).set_index("id")["p"]
    pd.testing.assert_series_equal(got.sort_index(), want.sort_index(), check_names=False, check_dtype=False)


@pytest.mark.parametrize("chunk", [11, 64, 20_000])
def test_rolling_over_small_chunks_equals_pandas(spark, chunk):
    rows = series()
    out = W.rolling(frame(spark, rows), ["k"], ["ts", "id"], "v", 10, 4, bucket="30 minutes", chunk=chunk)
    got = out.toPandas().set_index("id").sort_index()
    p = pandas_of(rows)
    roll = p.groupby("k")["v"].rolling(10, min_periods=4)
    want = pd.DataFrame({"m": roll.mean().droplevel(0), "s": roll.std().droplevel(0)}).assign(id=p["id"])
    want = want.set_index("id").sort_index()
    np.testing.assert_allclose(got["v_rolling_mean"].astype(float), want["m"], atol=1e-9)
    np.testing.assert_allclose(got["v_rolling_std"].astype(float), want["s"], atol=1e-9)
    assert len(got) == len(rows)


def test_rolling_quantile_over_small_chunks_equals_pandas(spark):
    rows = series()
    out = W.rolling_quantile(frame(spark, rows), ["k"], ["ts", "id"], {"q": ("v", 0.95)}, 20, chunk=37)
    got = out.toPandas().set_index("id").sort_index()["q"].astype(float)
    p = pandas_of(rows)
    want = p.assign(q=p.groupby("k")["v"].rolling(20).quantile(0.95).droplevel(0)).set_index("id").sort_index()["q"]
    np.testing.assert_allclose(got, want, atol=1e-9)


def test_forward_frames_cross_chunks(spark):
    rows = [("a", START + timedelta(minutes=i), i, float(i == 25)) for i in range(40)]
    out = W.future_label(frame(spark, rows).withColumn("v", F.col("v").cast("int")), ["k"], ["ts", "id"], "v", 10, chunk=13)
    got = {r["id"]: r["future_label"] for r in out.collect()}
    assert [i for i, x in got.items() if x] and {i for i, x in got.items() if x} == set(range(16, 26))


def test_tail_without_a_full_horizon_is_zero(spark):
    rows = [("a", START + timedelta(minutes=i), i, 1.0) for i in range(20)]
    out = W.future_label(frame(spark, rows).withColumn("v", F.lit(1)), ["k"], ["ts", "id"], "v", 10)
    got = {r["id"]: r["future_label"] for r in out.collect()}
    assert [got[i] for i in range(20)] == [1] * 11 + [0] * 9


def test_running_sum_crosses_buckets(spark):
    rows = series()
    got = running_sum(frame(spark, rows), ["k"], ["ts", "id"], F.lit(1), "n", "7 minutes").toPandas().set_index("id")["n"]
    want = pandas_of(rows).assign(n=lambda d: d.groupby("k").cumcount() + 1).set_index("id")["n"]
    assert (got.sort_index() == want.sort_index()).all()


def test_gap_of_exactly_ten_minutes_stays_in_the_session(spark):
    minutes = [0, 10, 20, 31, 31, 41, 52]
    rows = [("a", START + timedelta(minutes=m), i, 0.0) for i, m in enumerate(minutes)]
    for bucket in ("1 minute", "15 minutes", "1 hour"):
        got = session_numbers(frame(spark, rows), "ts", 10, "s", bucket=bucket).orderBy("id").collect()
        assert [r["s"] for r in got] == [1, 1, 1, 2, 2, 2, 3], bucket


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(minutes=st.lists(st.integers(0, 300), min_size=1, max_size=40))
def test_sessions_match_pandas(spark, minutes):
    rows = [("a", START + timedelta(minutes=m), i, 0.0) for i, m in enumerate(minutes)]
    got = session_numbers(frame(spark, rows), "ts", 10, "s", bucket="20 minutes").toPandas().set_index("id")["s"]
    p = pandas_of(rows).sort_values("ts")
    want = (p["ts"].diff().dt.total_seconds().div(60).fillna(0) > 10).cumsum() + 1
    assert dict(zip(p["id"], want)) == got.to_dict()


def test_asof_is_inclusive_and_takes_the_last_of_a_tie(spark):
    left = spark.createDataFrame([("a", START, 1), ("a", START + timedelta(days=3), 2), ("b", START, 3)],
                                 "k string, ts timestamp, id long")
    right = spark.createDataFrame(
        [("a", START, 1, "old"), ("a", START, 2, "new"), ("a", START + timedelta(days=9), 3, "late")],
        "k string, cts timestamp, no long, what string")
    out = J.asof_join(left, right, ["k"], "ts", "cts", ["what"], "id", "no", bucket="1 hour")
    assert {r["id"]: r["what"] for r in out.collect()} == {1: "new", 2: "new", 3: None}


def test_temporal_split_truncates(spark):
    rows = [("a", START + timedelta(minutes=i // 3), i, 0.0) for i in range(101)]
    out = W.temporal_split(frame(spark, rows), "ts", "id").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in out} == {"training": 70, "validation": 15, "test": 16}


def test_exact_quantiles_with_one_value_holding_a_third(spark):
    rng = np.random.default_rng(5)
    values = np.concatenate([np.full(300, 7.0), rng.exponential(10, 600)])
    df = spark.createDataFrame([("g", float(v)) for v in values], "k string, x double")
    qs = [0.0, 0.05, 0.31, 0.5, 0.95, 1.0]
    got = exact_quantiles(df, ["k"], "x", qs).collect()[0]["quantiles"]
    np.testing.assert_allclose(got, np.quantile(values, qs))
    got = exact_quantiles(df, [], "x", qs).collect()[0]["quantiles"]
    np.testing.assert_allclose(got, np.quantile(values, qs))


def test_cumulate_is_the_running_total_by_value(spark):
    df = spark.createDataFrame([("a", float(i % 50)) for i in range(500)], "k string, x double")
    got = {r["x"]: r["cum__n"] for r in cumulate(distinct_counts(df, ["k"], "x"), ["k"], "x", ["_n"], splits=8).collect()}
    assert got == {float(i): 10 * (i + 1) for i in range(50)}


def test_alert_needs_consecutive_periods(spark):
    minutes = [0, 1, 2, 5, 9, 10]
    rows = [("a", START + timedelta(minutes=m), i, 5.0) for i, m in enumerate(minutes)]
    out = W.sustained_alert(frame(spark, rows), ["k"], "ts", "v", 1.0, consecutive=2).orderBy("alert_start").collect()
    assert [r["periods"] for r in out] == [3, 2]


def test_runbook_lookup_equals_the_or_join(spark):
    books = spark.createDataFrame([(i, f"svc{i % 3}", s) for i, s in enumerate(
        ["disk full", "cpu high", "disk slow", "network", "cpu and disk", "other", "disk", "DISK io"])],
        "runbook_id long, service_name string, symptoms string")
    asks = spark.createDataFrame([(1, "SVC0", "disk"), (2, "none", "cpu"), (3, None, None), (4, "svc1", "zzz")],
                                 "request_id long, service_guess string, category string")
    got = J.match_runbooks(asks, books)
    table = books.collect()
    for ask in asks.collect():
        s, c = (ask[1] or "").lower(), (ask[2] or "").lower()
        want = [b[0] for b in table if b[1].lower() == s or c in b[2].lower()][:5]
        mine = [r["runbook_id"] for r in got.filter(F.col("request_id") == ask[0]).orderBy("runbook_rank").collect()]
        assert mine == want


def test_bucket_width_follows_the_densest_series(spark):
    from opsight.operators.ordered import suggest_bucket

    rows = [("a", START + timedelta(seconds=i), i, 0.0) for i in range(600)] + [("b", START, 1000, 0.0)]
    df = frame(spark, rows)
    assert suggest_bucket(df, ["k"], "ts") == "1 day"
    assert suggest_bucket(df, ["k"], "ts", rows=100) == "1 minute"


def test_asof_with_a_short_index_is_the_same(spark):
    left = frame(spark, series(200))
    right = frame(spark, series(60, seed=9)).select("k", F.col("ts").alias("cts"), F.col("id").alias("no"))
    args = (["k"], "ts", "cts", ["no"], "id", "no")
    a, b = J.asof_join(left, right, *args), J.asof_join(left, right, *args, index=left.select("k", "ts"))
    assert a.count() == 200 and a.exceptAll(b).count() == 0


def test_rows_without_a_time_come_last(spark):
    rows = [("a", None, 9, 5.0), *[("a", START + timedelta(hours=i), i, float(i)) for i in range(3)]]
    df = frame(spark, rows)
    got = {r["id"]: r["v_lag_1"] for r in W.lags(df, ["k"], ["ts", "id"], "v", [1]).collect()}
    assert got == {0: None, 1: 0.0, 2: 1.0, 9: 2.0}
    sums = {r["id"]: r["s"] for r in running_sum(df, ["k"], ["ts", "id"], F.col("v"), "s").collect()}
    assert sums == {0: 0.0, 1: 1.0, 2: 3.0, 9: 8.0}
    hits = J.asof_join(df, df.select("k", F.col("ts").alias("seen"), "id", F.col("v").alias("w")), ["k"], "ts", "seen",
                       ["w"], "id", "id")
    assert {r["id"]: r["w"] for r in hits.collect()} == {0: 0.0, 1: 1.0, 2: 2.0, 9: None}


def test_frames_wider_than_a_chunk(spark):
    rows = series(300)
    total = lambda w: {"total": F.round(F.sum("v").over(w.rowsBetween(-40, 30)), 6)}
    got = over_frames(frame(spark, rows), ["k"], ["ts", "id"], total, before=40, after=30, chunk=10)
    want = {}
    for _, part in pandas_of(rows).groupby("k"):
        v = part["v"].to_numpy()
        want |= {i: round(float(v[max(0, at - 40):at + 31].sum()), 6) for at, i in enumerate(part["id"])}
    assert {r["id"]: r["total"] for r in got.collect()} == pytest.approx(want)


@pytest.fixture
def dense(monkeypatch):
    """Small buckets: more than 60 rows at one place of a series are cut."""
    monkeypatch.setattr(O, "DENSE", 60)
    monkeypatch.setattr(O, "SAMPLES", 4)


def crowded(spark, n=1800):
    """A third of the rows at one instant, a third without a time, the rest spread; all of one hot key but a few."""
    rows = []
    for i in range(n):
        ts = START if i % 3 == 0 else None if i % 3 == 1 else START + timedelta(seconds=37 * i)
        rows.append(("hot" if i % 50 else "cold", ts, (i * 7919) % n, float((i * 31) % 17) if i % 4 else None))
    return frame(spark, rows), rows


def in_order(rows, key):
    late = START + timedelta(days=9999)
    return sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, r[1] or late, r[2]))


def test_no_piece_of_a_crowded_instant_is_large(spark, dense):
    df, rows = crowded(spark)
    placed = O._placer(df, ["k"], ["ts", "id"], "1 hour")[0](df)
    sizes = [r["count"] for r in placed.groupBy("k", O.BUCKET, O.PIECE).count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 4 * O.DENSE and len(sizes) > len(rows) / (4 * O.DENSE)


def test_positions_of_a_crowded_instant(spark, dense):
    df, rows = crowded(spark)
    got = {(r["k"], r["id"]): r["_pos"] for r in O.positions(df, ["k"], ["ts", "id"]).collect()}
    want = {(key, r[2]): i for key in ("hot", "cold") for i, r in enumerate(in_order(rows, key))}
    assert got == want


def test_carried_values_and_sums_of_a_crowded_instant(spark, dense):
    df, rows = crowded(spark)
    carried = O.carry_last(df, ["k"], ["ts", "id"], F.col("v"), "last")
    got = {(r["k"], r["id"]): (r["last"], r["total"])
           for r in O.running_sum(carried, ["k"], ["ts", "id"], F.col("v"), "total").collect()}
    for key in ("hot", "cold"):
        last, total = None, 0.0
        for r in in_order(rows, key):
            last, total = (last, total) if r[3] is None else (r[3], total + r[3])
            assert got[key, r[2]] == (last, pytest.approx(total))


def test_frames_of_a_crowded_instant(spark, dense):
    df, rows = crowded(spark)
    out = O.over_frames(df, ["k"], ["ts", "id"], lambda w: {"n": F.sum("id").over(w.rowsBetween(-4, 0))}, before=4, chunk=50)
    got = {(r["k"], r["id"]): r["n"] for r in out.collect()}
    for key in ("hot", "cold"):
        ties = [r[2] for r in in_order(rows, key)]
        assert all(got[key, t] == sum(ties[max(0, i - 4):i + 1]) for i, t in enumerate(ties))


def test_rows_equal_in_the_whole_order_stay_whole(spark, dense):
    """What the order cannot tell apart is one piece; nothing is lost."""
    df = frame(spark, [("k", START, 1, 1.0)] * 500 + [("k", START, 2, 1.0)] * 500)
    assert sorted(r["_pos"] for r in O.positions(df, ["k"], ["ts", "id"]).collect()) == list(range(1000))


def test_dense_buckets_of_a_column(spark, dense):
    from opsight.operators.models import stratified_split

    df = spark.range(4000).select("id", F.when(F.col("id") % 10 == 0, "a").otherwise("b").alias("label"))
    out = stratified_split(df, "label", "id", 0.25).groupBy("label", "split").count().collect()
    assert {(r["label"], r["split"]): r["count"] for r in out} == {
        ("a", "test"): 100, ("a", "train"): 300, ("b", "test"): 900, ("b", "train"): 2700}
