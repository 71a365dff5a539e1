"""Nothing is cut: depth, size of numbers, lost messages, readings without a baseline, calendars, zone changes."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from plantlake.operators import analytics, expand, graph, quantile, shifts

ROWS = "Subject string, Timestamp timestamp, Name string, Value string"
DAY = dt.datetime(2024, 1, 5)


def test_paths_of_any_depth(spark):
    chain = spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(21)], "parent string, child string")
    assert graph.hierarchy_paths(chain).count() == 22
    loop = chain.unionByName(spark.createDataFrame([("n21", "n3")], chain.schema))
    assert graph.hierarchy_paths(loop).count() == 22


def test_large_and_small_numbers(spark):
    rows = [("1", DAY, "FaultyTime", v) for v in ("1000000000000000", "5", "0.00004", "x")]
    got = analytics.fault_time(spark.createDataFrame(rows, ROWS), ["Subject"]).first()["faulty_ms"]
    assert got == pytest.approx(1000000000000005.00004)
    steps = [("1", DAY + dt.timedelta(hours=k), "NumberOfManufacturedProducts", v) for k, v in enumerate(("0", "1e15", "0.00004", "0.00009"))]
    got = analytics.counter_delta_safe(spark.createDataFrame(steps, ROWS)).first()["increase"]
    assert got == pytest.approx(1e15 + 0.00009)


def test_no_message_is_lost_unreported(spark):
    documents = [
        '{"DataSetWriterId":"1","Timestamp":"2024-01-05T08:00:00Z"}',
        '{"DataSetWriterId":"2","Timestamp":"2024-01-05T08:00:00Z","Payload":null}',
        '[7,{"DataSetWriterId":"3","Timestamp":"2024-01-05T08:00:00Z","Payload":{"A":{"Value":1},"B":2}},null]',
        "not json{",
        None,
    ]
    raw = spark.createDataFrame([(d,) for d in documents], "payload string")
    assert [(r["Subject"], r["Name"], r["Value"]) for r in expand.expand_telemetry(raw).collect()] == [("3", "A", "1")]
    rejects = {(r["Subject"], r["Name"], r["reason"]) for r in expand.telemetry_rejects(raw).collect()}
    assert ("1", None, "message has no payload") in rejects and ("2", None, "message has no payload") in rejects
    assert (None, None, "element is not a message") in rejects and ("3", "B", "payload field is not an object") in rejects
    assert (None, None, "not a message or an array of messages") in rejects


def test_every_reading_has_a_row_and_the_rolling_score(spark):
    series = [(DAY + dt.timedelta(hours=5 * k), 1e9 + (k * 37 % 11)) for k in range(18)]
    rows = [("1", t, "Pressure", str(v)) for t, v in series]
    got = analytics.anomaly_zscore(spark.createDataFrame(rows, ROWS), "Pressure").orderBy("Timestamp").collect()
    assert len(got) == 18
    for (t, v), r in zip(series, got, strict=True):
        past = [x for s, x in series if t - dt.timedelta(days=1) <= s < t]
        if len(past) < 3:
            assert r["zscore"] is None
        else:
            assert r["zscore"] == pytest.approx((v - statistics.mean(past)) / statistics.stdev(past), rel=1e-6)


@pytest.mark.parametrize("margin", [0.001, 0.0])
def test_median_of_a_null_bucket_and_a_missed_bracket(spark, monkeypatch, margin):
    monkeypatch.setattr(quantile, "MARGIN", margin or 1e-9)
    monkeypatch.setattr(quantile, "ACCURACY", 10_000 if margin else 2)
    rows = [(k % 2 or None, float(k * 7919 % 997)) for k in range(800)]
    got = quantile.exact_median(spark.createDataFrame(rows, "k int, v double"), ["k"], "v").collect()
    want = {k: statistics.median(v for b, v in rows if b == k) for k in (1, None)}
    assert {r["k"]: r["median"] for r in got} == want


def test_a_long_calendar_in_its_order(spark):
    rows = [(f"s{k}", k, k + 1, 300 - k) for k in range(200)]
    calendar = spark.createDataFrame(rows, "shift string, start_min int, end_min int, position int")
    assert [r[0] for r in shifts.calendar_rows(calendar)] == [f"s{k}" for k in reversed(range(200))]


def test_a_zone_that_changed_by_a_day(spark):
    times = [(dt.datetime(2011, 12, 29) + dt.timedelta(hours=k),) for k in range(72)]
    df = spark.createDataFrame(times, "Timestamp timestamp").withColumn("tz", F.lit("Pacific/Apia"))
    near = shifts.with_windows(df, "Timestamp", "tz").where("start_ts < Timestamp AND Timestamp < end_ts")
    windows = shifts.shift_windows(spark.createDataFrame([("a", "Pacific/Apia")], "Site string, tz string"), "2011-12-25", "2012-01-05")
    want = df.join(windows, (F.col("start_ts") < F.col("Timestamp")) & (F.col("Timestamp") < F.col("end_ts")))
    assert near.select("Timestamp", "shift").distinct().count() == want.select("Timestamp", "shift").distinct().count()
