"""Streams that keep state: shift counters that go after their shift, and metadata without true repeats."""

import datetime as dt
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_oee import metadata

from plantlake.operators import lkv, oee
from plantlake.schemas import METADATA_SCHEMA
from plantlake.streaming import jobs

READING = "Subject STRING, Timestamp TIMESTAMP, Name STRING, Value STRING"


def at(day, hour, minute=0):
    return dt.datetime(2024, 1, day, hour, minute, tzinfo=dt.timezone.utc)


def readings(spark, rows):
    return spark.createDataFrame([("1", t, "NumberOfManufacturedProducts", str(v)) for t, v in rows], READING)


def test_counters_go_after_their_shift_and_survive_a_restart(spark, tmp_path):
    """A week of shifts, one file a day and a new start each day: the state holds the last shifts, the figures all of them."""
    md = metadata(spark, [("1", "assembly", "munich", 1)])
    sites = spark.createDataFrame([("munich", "Europe/Berlin", 6000)], "Site STRING, tz STRING, ideal_cycle_ms BIGINT")
    source, root, all_rows, held = str(tmp_path / "tel"), str(tmp_path / "sink"), [], []
    for day in range(2, 9):
        rows = [(at(day, hour, 5), 1000 * day + 100 * hour) for hour in (7, 10, 15, 20, 23)]
        # A reading of the day before that comes late.
        rows += [(at(day - 1, 12, 30), 1000 * day - 1)] if day > 2 else []
        all_rows += rows
        readings(spark, rows).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.telemetry_stream(spark, source)
        query = jobs.run_oee_alerts(stream, md, sites, root, once=True, late="1 day", compact_every=3)
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress)
        assert dropped == 0
    keys = ["Site", "Workcell", "shift_day", "shift"]
    figures = [*keys, F.round("oee", 9).alias("oee"), "good"]
    want = oee.oee_by_shift(readings(spark, all_rows), lkv.metadata_lkv(md), sites).select(*figures)
    got = jobs.read_figures(spark, root).select(*figures)
    assert want.count() > 15 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert max(held) < 12 and held[-1] <= held[3]


def test_late_and_changed_descriptions_pass_and_repeats_do_not(spark, tmp_path):
    source, out = str(tmp_path / "md"), str(tmp_path / "out")
    base = {"Subject": "1", "DataSetName": "a.b", "MajorVersion": 1, "MinorVersion": 1, "Name": "Pressure", "BuiltInType": 11}

    def send(*rows):
        names = [f.name for f in spark.createDataFrame([], METADATA_SCHEMA).schema]
        full = [tuple({**base, **row}.get(name) for name in names) for row in rows]
        spark.createDataFrame(full, METADATA_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.without_repeats(jobs.read_table_stream(spark, source, METADATA_SCHEMA))
        jobs.write_append(stream, out, str(tmp_path / "checkpoint"), once=True).awaitTermination()
        return spark.read.parquet(out).count()

    big = (1 << 62) + 1
    assert send({"Timestamp": at(5, 12)}) == 1
    # A repeat, in the same batch and later ones.
    assert send({"Timestamp": at(5, 12, 5)}, {"Timestamp": at(5, 12, 5)}) == 1
    # New descriptions at 13:00 and, an hour late, at 11:00; one within the version; a null field.
    assert send({"Timestamp": at(5, 13), "DataType": "x"}) == 2
    assert send({"Timestamp": at(5, 11), "MajorVersion": big}) == 3
    assert send({"Timestamp": at(5, 14), "MajorVersion": None}) == 4
    # What held before holds again: no repeat, as something else held meanwhile.
    assert send({"Timestamp": at(5, 15), "DataType": "x"}) == 5
    assert send({"Timestamp": at(5, 15, 5), "DataType": "x"}, {"Timestamp": None}, {"Timestamp": None}) == 6
    # Another field, and two descriptions of one instant; the repeat after it is none any more.
    assert send({"Timestamp": at(5, 15), "Name": "Status"}, {"Timestamp": at(5, 15), "DataType": "y"}) == 9
    assert send({"Timestamp": at(5, 15), "DataType": "y"}, {"Timestamp": at(5, 15), "DataType": "x"}) == 9
    assert [str(r[0])[11:16] for r in spark.read.parquet(out).where("DataType = 'x'").select("Timestamp").orderBy("Timestamp").collect()] == [
        "13:00", "15:00", "15:05"]
    kept = spark.read.parquet(out)
    assert kept.where(F.col("MajorVersion") == big).count() == 1 and kept.where("MajorVersion IS NULL").count() == 1
    everything = lkv.metadata_lkv(spark.read.parquet(source).where("Timestamp IS NOT NULL"))
    last = lkv.metadata_lkv(kept.where("Timestamp IS NOT NULL"))
    described = [c for c in everything.columns if c != "Timestamp"]
    assert sorted(map(str, last.select(described).distinct().collect())) == sorted(map(str, everything.select(described).distinct().collect()))


def test_a_writer_of_many_fields_has_few_states(spark, tmp_path):
    """Forty fields, sent twice and again after a restart: each description passes once and as it was sent."""
    source, out, md = str(tmp_path / "md"), str(tmp_path / "out"), spark.createDataFrame([], METADATA_SCHEMA)
    odd = [None, "", "a\x1fb", "\x1e", "\x1e0\x1f", "\x1e1", '"{,}', "\u00e4"]
    rows = [
        {"Subject": "1", "Timestamp": at(5, 12 + k % 2), "Name": f"f{k}", "DataSetName": odd[k % 8], "MajorVersion": [k, None][k % 2],
         "Type": odd[k // 8], "NodeId": odd[(k + 1) % 8]}
        for k in range(40)
    ]
    sent = spark.createDataFrame([tuple(row.get(name) for name in md.columns) for row in rows], METADATA_SCHEMA)
    for again in range(2):
        sent.unionByName(sent).write.mode("append").parquet(source)
        stream = jobs.without_repeats(jobs.read_table_stream(spark, source, METADATA_SCHEMA))
        query = jobs.write_append(stream, out, str(tmp_path / "checkpoint"), once=True)
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= jobs.FIELD_GROUPS, again
        assert sorted(map(str, spark.read.parquet(out).collect())) == sorted(map(str, sent.collect()))


def test_packed_descriptions_hold_any_type(spark):
    table = spark.sql("""SELECT * FROM VALUES ('a', 1, array('x\\u001fy', NULL), 1.5D, DATE '2024-01-01', true),
        (NULL, NULL, NULL, NULL, NULL, NULL) t(s, n, list, d, day, b)""")
    fields = table.schema.fields
    values = table.select(F.split(jobs._packed(fields), jobs.SEPARATOR, -1).alias("values"))
    back = values.select(*[c.alias(name) for name, c in jobs._unpacked(F.col("values"), fields).items()])
    assert back.dtypes == table.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))


def test_what_passes_has_the_last_known_descriptions_in_any_order():
    """Rows in any order of arrival: the last instant of what passed describes what the last instant of all rows does."""
    draw = random.Random(6)
    for _ in range(500):
        rows = [(draw.randrange(12), draw.choice("ab")) for _ in range(draw.randint(1, 15))]
        known, passed = jobs.Descriptions(), []
        for k, row in enumerate(rows):
            passed += known.add(*row)
            ends = max(rows[: k + 1])[0], max(passed)[0]
            assert {d for t, d in rows[: k + 1] if t == ends[0]} == {d for t, d in passed if t == ends[1]}
        assert set(passed) <= set(rows) and len(passed) == len(set(passed))


def test_commands_follow_changed_metadata(spark, tmp_path):
    """A writer that is renamed between two batches counts under its new name at once."""
    source, root = str(tmp_path / "tel"), str(tmp_path / "sink")
    names = ["test", "assembly"]
    for k in range(2):
        rows = [("1", at(5, 8 + k), "Pressure", "9000")]
        spark.createDataFrame(rows, READING).coalesce(1).write.mode("append").parquet(source)
    known = [metadata(spark, [("1", name, "munich", 1)]) for name in names]
    calls = []

    def read():
        calls.append(1)
        return known[len(calls) - 1]

    stream = jobs.telemetry_stream(spark, source, {"maxFilesPerTrigger": "1"})
    jobs.run_pressure_commands(stream, read, "assembly", "munich", 2520, root, once=True).awaitTermination()
    assert len(calls) == 2 and spark.read.parquet(f"{root}/commands").count() == 1


def test_failed_jobs_go_on_from_their_checkpoint(spark, tmp_path):
    """A job that fails twice is started again and loses no batch; one that fails for ever ends all."""
    source, root, seen = str(tmp_path / "tel"), str(tmp_path / "sink"), []
    for k in range(3):
        readings(spark, [(at(5, 8 + k), k)]).coalesce(1).write.mode("append").parquet(source)

    def alerts(batch):
        seen.append(1)
        if len(seen) in (1, 3):
            raise RuntimeError("broken")
        return batch

    def start(function, name):
        stream = jobs.telemetry_stream(spark, source, {"maxFilesPerTrigger": "1"})
        return lambda: jobs.run_alerts(stream, function, f"{root}/{name}", once=True)

    jobs.keep_running(spark, {"a": start(alerts, "a"), "b": start(lambda batch: batch, "b")}, f"{root}/failures")
    for name in "ab":
        assert spark.read.parquet(f"{root}/{name}/alerts").count() == 3
    failed = spark.read.parquet(f"{root}/failures").collect()
    assert [(r["job"], r["restarted"], "broken" in r["message"]) for r in failed] == [("a", True, True)] * 2

    def never(batch):
        raise RuntimeError("gone")

    with pytest.raises(StreamingQueryException, match="gone"):
        jobs.keep_running(spark, {"c": start(never, "c")}, restarts=1)
