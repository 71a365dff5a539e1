"""The index of zone offsets against Spark's zone functions, and calendars of any length looked up by it."""

import pytest
from pyspark.sql import functions as F

from plantlake.operators import shifts, zones

ZONES = ["Europe/Berlin", "America/Los_Angeles", "Australia/Lord_Howe", "Asia/Kathmandu", "Pacific/Apia", "America/Recife",
         "Africa/Casablanca", "Africa/El_Aaiun", "Asia/Gaza", "UTC"]


@pytest.fixture(scope="module")
def index(spark):
    return zones.zone_index(spark.createDataFrame([(z,) for z in ZONES], "tz string")).persist()


def test_instants_and_walls_around_every_change(index):
    """Up to four days around each change, where the wall clock is read and where it is turned back."""
    around = F.explode(F.expr("sequence(-350000L, 350000L, 7013L)"))
    change = index.where(F.col("_change_1") != zones.NEVER).select("tz", "_change_1", around.alias("s"))
    times = change.select("tz", F.timestamp_micros(F.col("_change_1") + F.col("s") * zones.SECOND).alias("ts"))
    exact = index.where(F.col("_change_1") != zones.NEVER).select("tz", F.timestamp_micros("_change_1").alias("ts"))
    times = times.unionByName(exact).unionByName(exact.withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 SECOND")))
    micros = "unix_micros(ts)"
    found = zones.with_zone(times, index, micros).withColumns({
        "own": F.expr(f"{micros} + {zones.offset_at(micros)}"),
        "want": F.unix_micros(F.from_utc_timestamp("ts", F.col("tz"))),
    })
    for hours in (-30, 0, 1, 48):
        wall = F.col("want") + F.lit(hours * 3600 * zones.SECOND).cast("long")
        instant = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros(wall), F.col("tz")))
        found = found.withColumn("wall", wall).withColumn(f"bad{hours}", F.expr(zones.instant_of("wall")) != instant).drop("wall")
    bad = " OR ".join(["own IS NULL", "own <> want", *(f"`bad{h}`" for h in (-30, 0, 1, 48))])
    assert found.count() > 100_000 and found.where(bad).count() == 0


def test_changes_are_further_apart_than_a_cell(spark):
    """What the index rests on, for all zones of the tz database that the JVM has."""
    ids = spark._jvm.java.time.ZoneId
    instant = spark._jvm.java.time.Instant
    for name in ZONES:
        rules, at, before = ids.of(name).getRules(), instant.ofEpochSecond(0), None
        while (step := rules.nextTransition(at)) is not None and step.getInstant().getEpochSecond() < 4_102_444_800:
            at = step.getInstant()
            assert before is None or at.getEpochSecond() - before > 1 << zones.CELL_BITS
            before = at.getEpochSecond()


def test_rows_convert_no_zones(spark, index, tmp_path):
    """Zone functions stand in the plan of the index alone, never above the readings."""
    spark.range(10).select(F.timestamp_seconds("id").alias("Timestamp"), F.lit("UTC").alias("tz")).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    sites = spark.createDataFrame([("UTC",)], "tz string")
    for found in (
        shifts.assign_shift(rows, zones=zones.zone_index(sites)),
        shifts.with_windows(rows, "Timestamp", zones=zones.zone_index(sites)),
        shifts.with_windows(rows, "Timestamp", zones=index),
    ):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        lines = [line for line in plan.splitlines() if "utc_timestamp" in line]
        # The index is built from the cells; a line that reads the rows' time would be a conversion per row.
        assert not [line for line in lines if "Timestamp#" in line.replace("utc_timestamp", "")]
        assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_calendar_of_a_thousand_shifts_is_a_table(spark, index):
    """Overlapping and wrapping shifts; the first by position is assigned, all of them have windows."""
    rows = [(f"s{k}", k * 37 % 1440, k * 91 % 1440, (k * 7) % 1000) for k in range(1000)]
    calendar = spark.createDataFrame(rows, "shift string, start_min int, end_min int, position int")
    step = F.expr("sequence(TIMESTAMP '2024-03-30 20:00:30', TIMESTAMP '2024-03-31 06:00:00', INTERVAL 55 MINUTE)")
    times = spark.createDataFrame([("Europe/Berlin",)], "tz string").select("tz", F.explode(step).alias("Timestamp"))
    times = times.unionByName(times.withColumn("Timestamp", F.date_trunc("minute", "Timestamp")))
    order = sorted(rows, key=lambda r: r[3])

    def first(wall):
        tod = wall.hour * 60 + wall.minute + wall.second / 60
        for name, start, end, _ in order:
            if end >= start and start <= tod <= end:
                return name, 0
            if end < start and tod > start:
                return name, 0
            if end < start and tod <= end:
                return name, 1
        return None, 0

    got = shifts.assign_shift(times, shifts=calendar, zones=index)
    got = got.withColumn("wall", F.from_utc_timestamp("Timestamp", F.col("tz"))).collect()
    for r in got:
        name, back = first(r["wall"])
        assert r["shift"] == name and (r["wall"].date() - r["shift_day"]).days == back
    near = shifts.with_windows(times, "Timestamp", shifts=calendar, zones=index)
    near = near.where("start_ts < Timestamp AND Timestamp < end_ts").select("Timestamp", "shift", "shift_day", "start_ts", "end_ts")
    windows = shifts.shift_windows(spark.createDataFrame([("a", "Europe/Berlin")], "Site string, tz string"), "2024-03-28", "2024-04-02", calendar)
    joined = shifts.join_windows(times.withColumn("Site", F.lit("a")), windows, ["Site"]).select(*near.columns)
    assert near.count() > 5000 and near.exceptAll(joined).count() == 0 and joined.exceptAll(near).count() == 0
