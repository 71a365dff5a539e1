import datetime as dt

import pytest

from plantlake.functions import sqlfuncs
from plantlake.operators import lkv, oee, shifts
from plantlake.schemas import METADATA_SCHEMA, TELEMETRY_SCHEMA

UTC = dt.timezone.utc
NAME = "assembly.line1.building1.munich.contoso;nsu=http://example.org/UA/S/;i=385"


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


def metadata(spark, writers):
    rows = []
    for subject, station, site, version in writers:
        name = f"{station}.line1.building1.{site}.contoso;nsu=http://example.org/UA/S/;i=385"
        for field in ("Status", "Pressure"):
            rows.append(
                (subject, at("2024-01-01 00:00:00"), name, version, 0, field, 1, "i=1", -1, "t", field,
                 station, "line1", "building1", site, "contoso", "http://example.org/UA/S/", "i=385")
            )
    return spark.createDataFrame(rows, METADATA_SCHEMA)


def telemetry(spark, rows):
    return spark.createDataFrame([(s, at(t), n, v) for s, t, n, v in rows], TELEMETRY_SCHEMA)


HAND = [
    ("1", "2024-01-05 07:00:01", "NumberOfManufacturedProducts", "10"),
    ("1", "2024-01-05 13:59:59", "NumberOfManufacturedProducts", "3010"),
    ("1", "2024-01-05 08:00:00", "NumberOfDiscardedProducts", "0"),
    ("1", "2024-01-05 09:00:00", "NumberOfDiscardedProducts", "100"),
    ("1", "2024-01-05 09:00:00", "FaultyTime", "600000"),
    ("1", "2024-01-05 10:00:00", "FaultyTime", "600000"),
    ("1", "2024-01-05 10:00:00", "FaultyTime", "[Future]"),
    # On the bounds, so outside of the open window.
    ("1", "2024-01-05 07:00:00", "NumberOfManufacturedProducts", "0"),
    ("1", "2024-01-05 14:00:00", "NumberOfManufacturedProducts", "9999"),
]
WINDOW = ("2024-01-05T07:00:00Z", "2024-01-05T14:00:00Z")


def station(spark, tel, md, **kw):
    last = lkv.metadata_lkv(md)
    return oee.oee_station(tel, last, "assembly", "munich", 6000, *WINDOW, **kw).first()


def test_by_hand(spark):
    row = station(spark, telemetry(spark, HAND), metadata(spark, [("1", "assembly", "munich", 1)]))
    assert row["availability"] == pytest.approx(0.952381, abs=1e-6)
    assert row["performance"] == pytest.approx(0.775, abs=1e-9)
    assert row["quality"] == pytest.approx(0.967742, abs=1e-6)
    assert row["oee"] == pytest.approx(0.714286, abs=1e-6)


def test_repeated_metadata_changes_nothing(spark):
    once = metadata(spark, [("1", "assembly", "munich", 1)])
    twice = once.unionByName(metadata(spark, [("1", "assembly", "munich", 2)]))
    tel = telemetry(spark, HAND)
    assert station(spark, tel, once) == station(spark, tel, twice)


def test_no_rows_is_zero(spark):
    md = metadata(spark, [("1", "assembly", "munich", 1)])
    row = station(spark, telemetry(spark, HAND[:1]).limit(0), md)
    assert (row["oee"], row["availability"], row["performance"]) == (0.0, 1.0, 0.0)
    assert station(spark, telemetry(spark, HAND), md.limit(0))["oee"] == 0.0


def test_line_is_the_lowest_station(spark):
    md = metadata(spark, [("1", "assembly", "munich", 1), ("2", "test", "munich", 1), ("3", "mes", "munich", 1)])
    tel = telemetry(spark, HAND)
    last = lkv.metadata_lkv(md)
    assert oee.oee_line(tel, last, "munich", 6000, *WINDOW).first()["oee"] == 0.0
    more = tel.unionByName(telemetry(spark, [("2",) + r[1:] for r in HAND]))
    assert oee.oee_line(more, last, "munich", 6000, *WINDOW).first()["oee"] == pytest.approx(0.714286, abs=1e-6)


def test_empty_workcell_is_no_station(spark):
    md = metadata(spark, [("1", "assembly", "munich", 1), ("2", "", "munich", 1)])
    stations = oee.production_stations(lkv.metadata_lkv(md), "munich").collect()
    assert [r["station"] for r in stations] == ["assembly"]


def test_one_plan_at_every_size(spark):
    md = lkv.metadata_lkv(metadata(spark, [("1", "assembly", "munich", 1)]))
    plan = oee.oee_station(telemetry(spark, HAND), md, "assembly", "munich", 6000, *WINDOW)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower() and "LocalLimit" not in plan


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/Los_Angeles"])
def test_shift_rows_equal_single_calls(spark, zone):
    rows = []
    for i in range(400):
        ts = at("2024-03-29 00:00:00") + dt.timedelta(minutes=17 * i, seconds=i % 3)
        name = ("NumberOfManufacturedProducts", "NumberOfDiscardedProducts", "FaultyTime")[i % 3]
        rows.append((str(1 + i % 2), ts, name, str(i * 7 % 900)))
    # Readings exactly on shift bounds, in every zone.
    for hour in range(24):
        rows.append(("1", at("2024-03-30 00:00:00") + dt.timedelta(hours=hour), "FaultyTime", "1000"))
    tel = spark.createDataFrame(rows, TELEMETRY_SCHEMA)
    last = lkv.metadata_lkv(metadata(spark, [("1", "assembly", "munich", 1), ("2", "test", "munich", 1)]))
    sites = spark.createDataFrame([("munich", zone, 6000)], "Site STRING, tz STRING, ideal_cycle_ms BIGINT")
    by_shift = oee.oee_by_shift(tel, last, sites).collect()
    assert len(by_shift) > 10
    windows = {
        (r["shift_day"], r["shift"]): (r["start_ts"], r["end_ts"])
        for r in shifts.shift_windows(sites, "2024-03-28", "2024-04-04").collect()
    }
    from pyspark.sql import functions as F

    for row in by_shift[::4]:
        start, end = windows[(row["shift_day"], row["shift"])]
        assert (row["start_ts"], row["end_ts"]) == (start, end)
        single = oee.oee_station(tel, last, row["Workcell"], "munich", 6000, F.lit(start), F.lit(end)).first()
        assert single["oee"] == pytest.approx(row["oee"], abs=1e-12)


def test_sql_functions(spark):
    telemetry(spark, HAND).createOrReplaceTempView("t_tel")
    metadata(spark, [("1", "assembly", "munich", 1)]).createOrReplaceTempView("t_md")
    sqlfuncs.create_lkv_view(spark, "t_md", "t_lkv")
    sqlfuncs.create_functions(spark, "t_tel", "t_lkv")
    window = f"TIMESTAMP '{WINDOW[0]}', TIMESTAMP '{WINDOW[1]}'"
    row = spark.sql(f"SELECT oee_station('assembly', 'munich', 6000, {window}) a, oee_line('munich', 6000, {window}) b").first()
    assert row["a"] == pytest.approx(0.714286, abs=1e-6) and row["b"] == row["a"]
    breaks = spark.sql(f"SELECT * FROM shift_break({window}, 2.5, 60)").collect()
    assert len(breaks) == 60 and {r["Break"] for r in breaks} == {2.5}
    assert spark.sql("SELECT * FROM faulty_assets(TIMESTAMP '2024-01-06T00:00:00Z', 3)").count() == 2
    assert spark.sql(f"SELECT * FROM value_history('1', 'FaultyTime', {window})").count() == 3
