import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from plantlake.operators import shifts

UTC = dt.timezone.utc


def assigned(spark, local_times, zone):
    df = spark.createDataFrame([(t,) for t in local_times], "local STRING").withColumns(
        {"tz": F.lit(zone), "Timestamp": F.to_utc_timestamp(F.to_timestamp("local"), zone)}
    )
    return {r["local"]: (r["shift"], str(r["shift_day"])) for r in shifts.assign_shift(df).collect()}


@pytest.mark.parametrize("zone,day", [("Europe/Berlin", "2024-03-31"), ("America/Los_Angeles", "2024-03-10"), ("UTC", "2024-05-05")])
def test_edges(spark, zone, day):
    before = str(dt.date.fromisoformat(day) - dt.timedelta(days=1))
    times = {
        f"{day} 07:00:00": ("Morning", day),
        f"{day} 14:00:00": ("Morning", day),
        f"{day} 14:30:00": (None, "None"),
        f"{day} 23:00:00": (None, "None"),
        f"{day} 23:30:00": ("Night", day),
        f"{day} 05:59:00": ("Night", before),
        f"{day} 06:00:00": ("Night", before),
        f"{day} 06:30:00": (None, "None"),
    }
    assert assigned(spark, list(times), zone) == times


@pytest.mark.parametrize("zone,day,hours", [("Europe/Berlin", "2024-03-30", 6), ("Europe/Berlin", "2024-10-26", 8), ("Europe/Berlin", "2024-06-01", 7)])
def test_night_over_a_clock_change(spark, zone, day, hours):
    sites = spark.createDataFrame([("s", zone)], "Site STRING, tz STRING")
    night = shifts.shift_windows(sites, day, day).where("shift = 'Night'").first()
    assert (night["end_ts"] - night["start_ts"]) == dt.timedelta(hours=hours)


def test_window_join_equals_brute_force(spark):
    rng = random.Random(3)
    base = dt.datetime(2024, 1, 1, tzinfo=UTC)
    rows = [("ab"[i % 2], base + dt.timedelta(minutes=rng.randrange(10_000))) for i in range(500)]
    windows = []
    for i in range(40):
        start = base + dt.timedelta(minutes=rng.randrange(10_000))
        windows.append(("ab"[i % 2], i, start, start + dt.timedelta(minutes=rng.randrange(1, 4000))))
    df = spark.createDataFrame(rows, "k STRING, Timestamp TIMESTAMP")
    w = spark.createDataFrame(windows, "k STRING, id INT, start_ts TIMESTAMP, end_ts TIMESTAMP")
    got = sorted((r["k"], r["id"], r["Timestamp"]) for r in shifts.join_windows(df, w, ["k"]).collect())
    want = sorted(
        (k, i, t.replace(tzinfo=None)) for k, t in rows for wk, i, s, e in windows if k == wk and s < t < e
    )
    assert got == want


def test_near_windows_hold_every_match(spark):
    """`with_windows` never leaves out a window that contains the instant."""
    zones = ["Europe/Berlin", "America/Los_Angeles", "Asia/Tokyo", "Australia/Lord_Howe", "Asia/Kathmandu"]
    sites = spark.createDataFrame([(z, z) for z in zones], "Site STRING, tz STRING")
    calendar = (("Early", 90, 150), ("Late", 600, 1439), ("Wrap", 1400, 200))
    step = F.expr("sequence(TIMESTAMP '2024-03-09', TIMESTAMP '2024-04-08', INTERVAL 13 MINUTE)")
    df = sites.select("Site", "tz", F.explode(step).alias("Timestamp"))
    keys = ["Site", "Timestamp", "shift", "shift_day"]
    near = shifts.with_windows(df, "Timestamp", shifts=calendar).where(
        "start_ts < Timestamp AND Timestamp < end_ts"
    ).select(*keys)
    windows = shifts.shift_windows(sites, "2024-03-07", "2024-04-10", calendar).drop("tz")
    joined = shifts.join_windows(df, windows, ["Site"]).select(*keys)
    assert near.count() > 1000
    assert near.exceptAll(joined).count() == 0 and joined.exceptAll(near).count() == 0


def test_calendar_lines(spark, rows_of):
    lines = spark.createDataFrame([("Morning,07:00,14:00",), ("bad,1",), ("Night,23:00,06:30",), ("a,b,c,d",)], "value STRING")
    calendar = shifts.parse_calendar(lines)
    assert rows_of(calendar) == [("Morning", 420, 840), ("Night", 1380, 390)]
    assert sorted(shifts.calendar_rows(calendar)) == [("Morning", 420, 840), ("Night", 1380, 390)]


def test_breaks(spark):
    start, end = dt.datetime(2024, 1, 1, 5, 30, 20, tzinfo=UTC), dt.datetime(2024, 1, 2, 5, 45, 20, tzinfo=UTC)
    spans = spark.createDataFrame([("x", start, end, 60, 1.0)], "id STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, offset_min INT, band DOUBLE")
    got = sorted(r["Timestamp"] for r in shifts.shift_break(spans).collect())
    want, t = [], start.replace(tzinfo=None)
    while t <= end.replace(tzinfo=None):
        if (t + dt.timedelta(hours=1)).hour in (14, 6):
            want.append(t)
        t += dt.timedelta(minutes=1)
    assert got == want
