import json

import pytest
from pyspark.sql import functions as F

from plantlake.operators import lkv, monitor
from plantlake.operators.expand import expand_telemetry
from plantlake.operators.timerange import between_open
from plantlake.schemas import METADATA_SCHEMA, TABLES, TELEMETRY_SCHEMA
from plantlake.session import checkpoint, scratch, shared_root
from plantlake.sources import files, tables
from plantlake.streaming import jobs


def message(writer, minute, value):
    return json.dumps(
        {"DataSetWriterId": f"{writer}/t", "Timestamp": f"2024-01-05T08:{minute:02d}:00Z", "Payload": {"Pressure": {"Value": value}}}
    )


def write_lines(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_tables_are_created_once(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS plant_t")
    spark.catalog.setCurrentDatabase("plant_t")
    try:
        assert tables.missing_tables(spark, list(TABLES)) == list(TABLES)
        assert tables.create_tables(spark) == list(TABLES)
        assert tables.create_tables(spark) == []
        assert spark.table("metadata").schema.simpleString().startswith("struct<Subject:string,Timestamp:timestamp")
        rows = spark.createDataFrame([("1", None, "A", "x")], TELEMETRY_SCHEMA)
        tables.append_table(rows.select("Value", "Name", "Timestamp", "Subject"), "telemetry")
        tables.append_table(rows, "telemetry")
        assert spark.table("telemetry").where("Value = 'x'").count() == 2
        assert [c.name for c in spark.catalog.listColumns("telemetry") if c.isPartition] == ["date"]
        tables.append_table(rows, "fresh")
        tables.overwrite_table(rows, "fresh")
        assert spark.table("fresh").count() == 1
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_layout_prunes_dates(spark, tmp_path):
    rows = spark.range(100).select(
        (F.col("id") % 3).cast("string").alias("Subject"),
        F.expr("TIMESTAMP '2024-01-01' + (id % 10) * INTERVAL 1 DAY").alias("Timestamp"),
        F.lit("Pressure").alias("Name"), F.col("id").cast("string").alias("Value"),
    )
    path = str(tmp_path / "tel")
    tables.write_telemetry(rows, path)
    stored = tables.read_telemetry(spark, path)
    some = between_open(stored, "2024-01-03T00:00:00Z", "2024-01-04T00:00:00Z")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "GreaterThan(Timestamp" in plan
    assert between_open(stored, "2024-01-02T12:00:00Z", "2024-01-04T12:00:00Z").count() == 20


def test_partition_overwrite_is_repeatable(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    path = str(tmp_path / "p")
    tables.overwrite_partitions(df, path, ["k"])
    tables.overwrite_partitions(df.where("k = 1").withColumn("v", F.lit("z")), path, ["k"])
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, "z"), (2, "b")]


def test_landing_survives_restart(spark, tmp_path, rows_of):
    topic, root = tmp_path / "topic", str(tmp_path / "root")
    first = [message(1, m, m) for m in range(5)]
    write_lines(topic, "a.txt", first)

    def run():
        jobs.land(spark, "text", str(topic), root, "telemetry_raw", once=True).awaitTermination()
        jobs.expand(spark, root, "telemetry", once=True).awaitTermination()

    run()
    run()
    second = ["[" + ",".join(message(2, m, m) for m in range(5)) + "]", "not json{"]
    write_lines(topic, "b.txt", second)
    run()
    raw = spark.createDataFrame([(m,) for m in first + second], "payload STRING")
    assert rows_of(spark.read.parquet(f"{root}/telemetry").drop("date")) == rows_of(expand_telemetry(raw))
    assert spark.read.parquet(f"{root}/telemetry_raw").count() == 7


def test_four_jobs(spark, tmp_path):
    for kind in ("telemetry", "metadata"):
        write_lines(tmp_path / kind, "a.txt", [message(1, 0, 1)] if kind == "telemetry" else [
            json.dumps({"DataSetWriterId": "1", "Timestamp": "2024-01-05T08:00:00Z", "MetaData": {"Name": "assembly-munich-asset", "Fields": [{"Name": "Pressure"}]}})
        ])
    root = str(tmp_path / "root")
    topics = {k: str(tmp_path / k) for k in ("telemetry", "metadata")}
    assert len(jobs.start_all(spark, "text", topics, root, once=True)) == 4
    assert spark.read.parquet(f"{root}/telemetry").count() == 1
    assert spark.read.parquet(f"{root}/metadata").first()["Site"] == "munich"


def test_repeated_batch_replaces_itself(spark, tmp_path):
    df = spark.createDataFrame([("x",)], "payload STRING")
    for _ in range(2):
        jobs._replace_batch(df, 7, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


@pytest.mark.parametrize("compact_every", [2, 100])
def test_streamed_lkv_equals_batch(spark, tmp_path, rows_of, compact_every):
    from test_oee import metadata

    md = metadata(spark, [("1", "assembly", "munich", v) for v in range(4)] + [("2", "test", "munich", 1)])
    source = str(tmp_path / "md")
    md.repartition(5).write.parquet(source)
    stream = jobs.read_table_stream(spark, source, METADATA_SCHEMA, options={"maxFilesPerTrigger": "1"})
    root = str(tmp_path / "lkv")
    jobs.maintain_lkv(stream, root, compact_every=compact_every, once=True).awaitTermination()
    assert rows_of(jobs.read_lkv(spark, root)) == rows_of(lkv.metadata_lkv(md, ties=False))


def test_empty_lkv(spark, tmp_path):
    assert jobs.read_lkv(spark, str(tmp_path / "none")).count() == 0


def test_shared_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "a") != scratch(spark, "a")
    assert checkpoint(spark.range(3)).count() == 3


def test_file_sources(spark, tmp_path, rows_of):
    (tmp_path / "shifts.csv").write_text("Morning,07:00,14:00\nbroken\n")
    assert rows_of(files.read_shift_calendar(spark, str(tmp_path / "shifts.csv"))) == [("Morning", 420, 840)]
    (tmp_path / "tags.csv").write_text("NodeID,TagName,QueueSize,ObservabilityMode,Sampling Interval Milliseconds\nns=1;i=4,pressure,1,none,500\n")
    assert rows_of(files.read_tag_list(spark, str(tmp_path / "tags.csv"))) == [("ns=1;i=4", "pressure", 1, "none", 500)]


def test_ingest_health(spark):
    counts = tables.row_counts({"a": spark.range(2), "b": spark.range(0)})
    required = spark.createDataFrame([("a",), ("b",), ("c",)], "table_name STRING")
    got = {r["table_name"]: (r["present"], r["has_rows"]) for r in monitor.ingest_health(counts, required).collect()}
    assert got == {"a": (True, True), "b": (True, False), "c": (False, False)}


def test_name_and_date_filters_reach_the_scan(spark, tmp_path):
    from test_oee import HAND, metadata, telemetry

    from plantlake.operators.oee import oee_station

    path = str(tmp_path / "tel")
    tables.write_telemetry(telemetry(spark, HAND), path)
    md = metadata(spark, [("1", "assembly", "munich", 1), ("2", "test", "munich", 1)])
    result = oee_station(
        tables.read_telemetry(spark, path), lkv.metadata_lkv(md), "assembly", "munich", 6000,
        "2024-01-05T07:00:00Z", "2024-01-05T14:00:00Z",
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = result._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line and "Value" in line)
    assert "PartitionFilters: [isnotnull(date" in scan
    assert "IsNotNull(Subject)" in scan and "In(Name" in scan


def test_merged_batches_are_removed(spark, tmp_path, rows_of):
    rows = spark.range(60).select(
        (F.col("id") % 4).cast("string").alias("Subject"),
        F.expr("TIMESTAMP '2024-01-01' + (id * 7 % 11) * INTERVAL 1 DAY").alias("Timestamp"),
        F.lit("Pressure").alias("Name"), F.col("id").cast("string").alias("Value"),
    )
    source, root = str(tmp_path / "tel"), str(tmp_path / "last")
    rows.repartition(7).write.parquet(source)
    stream = jobs.telemetry_stream(spark, source, {"maxFilesPerTrigger": "1"})
    jobs.maintain_values(stream, root, compact_every=2, once=True).awaitTermination()
    assert rows_of(jobs.read_values(spark, root)) == rows_of(lkv.newest_values(rows))
    # Merges at batches 1, 3 and 5: the base before the last one stays for readers that have chosen it.
    assert sorted(jobs._batches(spark, f"{root}/base")) == [3, 5]
    assert min(jobs._batches(spark, f"{root}/deltas")) == 4


def test_tables_without_their_checkpoint_are_refused(spark, tmp_path):
    topic, root = tmp_path / "topic", str(tmp_path / "root")
    write_lines(topic, "a.txt", [message(1, 0, 5)])
    raw = jobs.read_topic(spark, "text", str(topic))
    for _ in range(2):
        jobs.land_and_expand(spark, raw, root, once=True).awaitTermination()
    stored = spark.read.parquet(f"{root}/telemetry")
    assert stored.count() == 1 and {"date", "batch_id"} <= set(stored.columns)
    old = str(tmp_path / "old")
    jobs._replace_batch(raw_rows(spark), 0, f"{old}/telemetry_raw")
    with pytest.raises(ValueError, match="checkpoint"):
        jobs.land_and_expand(spark, raw, old, once=True)


def raw_rows(spark):
    return spark.createDataFrame([("x",)], "payload STRING")


def test_alerts_follow_a_shift_over_batches(spark, tmp_path):
    """Good parts of a second batch end the alert that the first one raised; empty batches raise none."""
    from test_oee import metadata

    md = metadata(spark, [("1", "assembly", "munich", 1)])
    sites = spark.createDataFrame([("munich", "UTC", 6000)], "Site STRING, tz STRING, ideal_cycle_ms BIGINT")
    source, root = str(tmp_path / "tel"), str(tmp_path / "sink")

    def send(*readings):
        at = [("1", f"2024-01-05 {t}", n, v) for t, n, v in readings]
        df = spark.createDataFrame(at, "Subject STRING, Timestamp STRING, Name STRING, Value STRING")
        df.withColumn("Timestamp", F.to_timestamp("Timestamp")).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.telemetry_stream(spark, source)
        jobs.run_oee_alerts(stream, md, sites, root, once=True).awaitTermination()

    send(("08:00:10", "NumberOfManufacturedProducts", "0"), ("08:10:00", "NumberOfManufacturedProducts", "10"))
    send(("13:00:10", "NumberOfManufacturedProducts", "4000"))
    alerts = [(r["batch_id"], r["shift"], r["good"]) for r in spark.read.parquet(f"{root}/alerts").collect()]
    assert alerts == [(0, "Morning", 10.0)]


def test_other_zones_are_refused(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            tables.write_telemetry(spark.createDataFrame([], TELEMETRY_SCHEMA), str(tmp_path / "t"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_broker_options():
    """The options a broker's reader gets, seen by a stand-in for the session."""
    seen = {}

    class Reader:
        def format(self, fmt):
            seen["format"] = fmt
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self, *path):
            seen["path"] = path
            return self

        def selectExpr(self, text):
            seen["select"] = text
            return self

    class Session:
        readStream = Reader()

    jobs.read_topic(Session(), "kafka", "data", {"kafka.bootstrap.servers": "b:9092"})
    assert seen == {
        "format": "kafka", "subscribe": "data", "startingOffsets": "earliest", "failOnDataLoss": "false",
        "kafka.bootstrap.servers": "b:9092", "path": (), "select": "CAST(value AS STRING) AS payload",
    }
