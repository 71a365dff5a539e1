"""Ordered work in pieces against the plain window over whole series, with one hot series."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plantlake.operators import analytics, browse, lkv, monitor
from plantlake.operators.carry import carry_forward
from plantlake.operators.quantile import exact_median
from plantlake.schemas import TELEMETRY_SCHEMA

UTC = dt.timezone.utc
BASE = dt.datetime(2024, 1, 1, tzinfo=UTC)


def readings(spark, name, n=3000, values=1000, seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        subject = "hot" if rng.random() < 0.4 else str(rng.randrange(8))
        ts = BASE + dt.timedelta(seconds=rng.randrange(20_000) * (3 if rng.random() < 0.5 else 1))
        rows.append((subject, ts, name, str(rng.randrange(values))))
    return spark.createDataFrame(rows, TELEMETRY_SCHEMA)


@pytest.mark.parametrize("grain", ["minute", "hour", "day"])
def test_safe_delta(spark, rows_of, grain):
    rows = readings(spark, "NumberOfManufacturedProducts")
    w = Window.partitionBy("Subject").orderBy("Timestamp")
    plain = (
        rows.groupBy("Subject", "Timestamp").agg(F.max(F.col("Value").cast("int")).alias("v"))
        .withColumn("n", F.lead("v").over(w)).where("n IS NOT NULL")
        .groupBy("Subject").agg(F.sum(F.expr("CASE WHEN n >= v THEN n - v ELSE n END")).cast("double").alias("increase"))
    )
    got = analytics.counter_delta_safe(rows, grain=grain).withColumn("increase", F.col("increase").cast("double"))
    assert rows_of(got) == rows_of(plain)


@pytest.mark.parametrize("grain", ["minute", "day"])
def test_state_durations(spark, rows_of, grain):
    rows = readings(spark, "Status", values=5)
    w = Window.partitionBy("Subject").orderBy("Timestamp")
    plain = (
        rows.groupBy("Subject", "Timestamp").agg(F.max(F.col("Value").cast("int")).alias("state"))
        .withColumn("n", F.lead("Timestamp").over(w)).where("n IS NOT NULL")
        .groupBy("Subject", "state").agg(F.sum(F.unix_millis("n") - F.unix_millis("Timestamp")).alias("ms"))
    )
    assert rows_of(analytics.state_durations(rows, grain)) == rows_of(plain)


@pytest.mark.parametrize("grain", ["minute", "hour", "day"])
def test_carry_forward(spark, rows_of, grain):
    rows = (
        readings(spark, "x").groupBy("Subject", "Timestamp")
        .agg(F.max(F.when(F.col("Value").cast("int") < 150, F.col("Value"))).alias("serial"))
    )
    w = Window.partitionBy("Subject").orderBy("Timestamp").rowsBetween(Window.unboundedPreceding, 0)
    plain = rows.withColumn("serial", F.last("serial", ignorenulls=True).over(w))
    got = carry_forward(rows, ["Subject"], "serial", grain=grain).select(*plain.columns)
    assert rows_of(got) == rows_of(plain)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 10, 999, 1000, 1001, 20_001])
def test_median(spark, n):
    rng = random.Random(n)
    values = [float(rng.choice([rng.randrange(5), rng.randrange(100_000)])) for _ in range(n)]
    df = spark.createDataFrame([("g", v) for v in values] + [("h", None), ("h", 2.5)], "k STRING, v DOUBLE")
    got = {r["k"]: r["median"] for r in exact_median(df, ["k"], "v").collect()}
    assert got == {"g": statistics.median(values), "h": 2.5}


@pytest.mark.parametrize("draw", ["ties", "spread", "powers"])
def test_median_without_a_sort_of_a_group(spark, monkeypatch, draw):
    """Hostile values, with a sketch so rough that several rounds are needed, and no window over values."""
    from plantlake.operators import quantile

    monkeypatch.setattr(quantile, "ACCURACY", 20)
    rng = random.Random(5)
    made = {
        "ties": lambda: float(rng.choice([1, 1, 1, rng.randrange(3000)])),
        "spread": lambda: rng.uniform(-1, 1),
        "powers": lambda: rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 300),
    }[draw]
    values = {k: [made() for _ in range(n)] for k, n in (("hot", 20_000), ("odd", 4_001), ("two", 2))}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "k string, v double")
    got = {r["k"]: r["median"] for r in exact_median(df, ["k"], "v").collect()}
    assert got == {k: statistics.median(vs) for k, vs in values.items()}


@pytest.mark.parametrize("grain", ["minute", "hour", "day"])
def test_smoothed_forecast(spark, grain):
    from plantlake.operators.analytics import forecast_smoothed

    rng = random.Random(4)
    times = sorted(rng.sample(range(200_000), 900))
    rows = [("1", BASE + dt.timedelta(seconds=t), "P", str(rng.uniform(0, 9))) for t in times]
    extra = [("1", rows[5][1], "P", "4.5"), ("1", rows[7][1], "P", "none"), ("2", BASE, "P", "2.0"), ("3", BASE, "P", None)]
    at: dict = {}
    for _, ts, _, v in rows + extra[:1]:
        at.setdefault(ts, []).append(float(v))
    level = None
    for ts in sorted(at):
        v = statistics.mean(at[ts])
        level = v if level is None else 0.3 * v + 0.7 * level
    df = spark.createDataFrame(rows + extra, TELEMETRY_SCHEMA)
    got = {r["Subject"]: (r["n"], r["forecast"]) for r in forecast_smoothed(df, "P", ["Subject"], grain=grain).collect()}
    assert set(got) == {"1", "2"} and got["2"] == (1, pytest.approx(2.0))
    assert got["1"] == (len(at), pytest.approx(level))


def test_latest_values_prefer_the_greatest_of_equal_times(spark):
    rows = spark.createDataFrame(
        [("1", BASE, "A", "1"), ("1", BASE, "A", "2"), ("1", BASE - dt.timedelta(1), "A", "9"), ("2", BASE, "A", None)],
        TELEMETRY_SCHEMA,
    )
    got = {r["Subject"]: (r["Value"], r["Quality"]) for r in lkv.latest_values(rows).collect()}
    assert got == {"1": ("2", "Good"), "2": (None, "Bad")}


def test_history_defaults(spark):
    rows = spark.createDataFrame([("1", BASE + dt.timedelta(minutes=m), "A", str(m)) for m in range(0, 300, 10)], TELEMETRY_SCHEMA)
    ids = spark.createDataFrame([("p/A", "1", "A")], "ElementId STRING, Subject STRING, Name STRING")
    as_of = "2024-01-01T04:00:00Z"
    got = sorted(int(r["Value"]) for r in browse.value_history(rows, ids, as_of).collect())
    assert got == list(range(180, 250, 10))
    got = browse.value_history(rows, ids, as_of, start="2024-01-01T00:00:00Z", end="2024-01-01T00:30:00Z")
    assert got.count() == 4
    assert browse.value_history(rows, ids.limit(0), as_of).count() == 0


def test_repeated_alerts_match_copies(spark):
    from test_oee import metadata, telemetry

    md = metadata(spark, [("1", "assembly", "munich", 1), ("1", "assembly", "munich", 2)])
    tel = telemetry(spark, [("1", "2024-01-05 09:00:00", "FaultyTime", "5"), ("1", "2024-01-05 09:00:00", "FaultyTime", "0")])
    alert = monitor.fault_alerts(tel, md, "2024-01-06T00:00:00Z").first()
    assert alert["copies"] == 4
    assert alert["message"].startswith("**assembly.line1.building1.munich.contoso** has a **FaultyTime** of **5")
    assert monitor.fault_alerts(tel, md, "2024-01-06T00:00:00Z", repeat=True).count() == 4
