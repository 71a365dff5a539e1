"""Steps whose cost must not grow faster than their input: how they are dealt, and that their rows stay the same."""

import re
from datetime import datetime

from pyspark.sql import functions as F

from plantlake.functions import sqlfuncs
from plantlake.operators import lkv, ontology, shifts
from plantlake.plans.q_streaming import _topic as topic
from plantlake.plans.q_streaming import fed
from plantlake.schemas import METADATA_SCHEMA, TELEMETRY_SCHEMA
from plantlake.session import set_within
from plantlake.streaming import jobs


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def spans(spark):
    rows = [
        ("a", datetime(2024, 1, 1, 5, 30, 20), datetime(2024, 1, 2, 14, 10, 20), 0),
        ("b", datetime(2024, 1, 1, 5, 30, 20), datetime(2024, 1, 2, 14, 10, 20), 90),
        ("c", datetime(2024, 1, 1, 5, 30, 20), datetime(2024, 1, 2, 14, 10, 20), 90),
        ("d", datetime(2024, 1, 1, 6, 59, 59), datetime(2024, 1, 1, 6, 59, 59), 0),
        ("e", None, None, 0),
    ]
    return spark.createDataFrame(rows, "Subject STRING, start_ts TIMESTAMP, end_ts TIMESTAMP, offset_min INT")


def test_shift_break_of_many_rows_is_no_join(spark, rows_of):
    spark.createDataFrame([], TELEMETRY_SCHEMA).createOrReplaceTempView("breaks_telemetry")
    spark.createDataFrame([], METADATA_SCHEMA).createOrReplaceTempView("breaks_metadata")
    sqlfuncs.create_functions(spark, "breaks_telemetry", "breaks_metadata")
    table = spans(spark)
    table.createOrReplaceTempView("spans")
    got = spark.sql("SELECT s.Subject, b.Timestamp, b.Break FROM spans s, LATERAL shift_break(s.start_ts, s.end_ts, 1.5D, s.offset_min) b")
    assert "Join" not in plan_of(got)
    every = table.where("start_ts IS NOT NULL").withColumn(
        "Timestamp", F.explode(F.expr("sequence(start_ts, end_ts, INTERVAL 1 MINUTE)"))
    )
    want = every.where("hour(Timestamp + make_dt_interval(0, 0, offset_min)) IN (14, 6)").select("Subject", "Timestamp", F.lit(1.5))
    assert rows_of(got) == rows_of(want)
    breaks = shifts.shift_break(table.withColumn("band", F.lit(1.5)).coalesce(1))
    assert rows_of(breaks) == rows_of(want)
    assert breaks.rdd.getNumPartitions() > 1


def test_streamed_tables_are_fed_where_their_rows_are_made(spark, tmp_path, rows_of):
    rows = spark.range(0, 1000, 1, 12).withColumn("text", F.col("id").cast("string"))
    path = str(tmp_path / "fed")
    options = fed(rows, path, 4)
    files = spark.read.parquet(path).inputFiles()
    assert len(files) == 12 and options == {"maxFilesPerTrigger": "3"}
    assert rows_of(spark.read.parquet(path)) == rows_of(rows)
    one = fed(rows.coalesce(1), str(tmp_path / "one"), 4)
    assert len(spark.read.parquet(str(tmp_path / "one")).inputFiles()) == 4 and one == {"maxFilesPerTrigger": "1"}
    assert fed(rows.limit(0), str(tmp_path / "none"), 4) == {"maxFilesPerTrigger": "1"}


def test_topics_are_packed(spark, tmp_path, rows_of):
    documents = spark.createDataFrame([('{"a":1}',), ("",), ("x",)], "value STRING")
    path = topic(documents, str(tmp_path), "topic")
    assert all(name.endswith(".gz") for name in spark.read.text(path).inputFiles())
    assert rows_of(spark.read.text(path)) == rows_of(documents)


def test_topics_of_lists_are_written_by_small_tasks(spark, tmp_path):
    texts = F.concat(*[F.sha2(F.concat("id", F.lit(str(k))), 512) for k in range(4)])
    rows = spark.range(0, 60_000, 1, 8).withColumn("text", texts).repartition(8)
    lists = rows.groupBy((F.col("id") / 2).cast("long").alias("key")).agg(F.to_json(F.collect_list("text")).alias("value"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    usual = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", size: "64m"}
    with set_within(spark, usual):
        path = topic(lists.select("value"), str(tmp_path), "topic")
        assert spark.conf.get(size) == "64m"
    assert len(spark.read.text(path).inputFiles()) > 2 and spark.read.text(path).count() == 30_000


def test_settings_of_a_block_come_back_after_an_error(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        with set_within(spark, {key: "1m", "plantlake.test": "x"}):
            assert (spark.conf.get(key), spark.conf.get("plantlake.test")) == ("1m", "x")
            raise ValueError("stop")
    except ValueError:
        pass
    assert spark.conf.get(key) == before and spark.conf.get("plantlake.test", None) is None


def test_landed_documents_are_packed(spark, tmp_path, rows_of):
    documents = [('{"a":%d}' % n,) for n in range(50)] + [("",), ("x",)]
    source, root = topic(spark.createDataFrame(documents, "value STRING"), str(tmp_path), "topic"), str(tmp_path / "root")
    jobs.land(spark, "text", source, root, "metadata_raw", once=True).awaitTermination()
    jobs.land_and_expand(spark, jobs.read_topic(spark, "text", source), root, once=True).awaitTermination()
    for table in ("metadata_raw", "telemetry_raw"):
        landed = spark.read.parquet(f"{root}/{table}")
        assert all(name.endswith(".zstd.parquet") for name in landed.inputFiles())
        assert rows_of(landed.select("payload")) == sorted(documents)


def test_facts_are_dealt_before_they_are_counted(spark, rows_of):
    fact = "id STRING, fact STRING, name STRING, target STRING"
    a = spark.createDataFrame([("1", "type", "", ""), ("2", "type", "", ""), ("2", "type", "", "")], fact)
    b = spark.createDataFrame([("1", "type", "", ""), ("2", "type", "", ""), ("3", "type", "", "")], fact)
    found = ontology.parity(a, b)
    assert "RepartitionByExpression" in plan_of(found)
    assert rows_of(found) == [("2", "type", "", "", "a", 1), ("3", "type", "", "", "b", 1)]


def described(spark, rows):
    names = [f.name for f in spark.createDataFrame([], METADATA_SCHEMA).schema]
    full = [tuple(row.get(name) for name in names) for row in rows]
    return spark.createDataFrame(full, METADATA_SCHEMA)


def test_names_are_reduced_before_the_latest_are_looked_up(spark, rows_of):
    day = [datetime(2024, 1, k) for k in (1, 2, 3)]
    rows = [
        {"Subject": s, "Timestamp": t, "Name": f, "DataSetName": n, "Site": "munich", "Workcell": w, "MajorVersion": v}
        for s, t, f, n, w in [
            ("1", day[0], "a", "old-munich-x", "old"), ("1", day[1], "a", "new-munich-x", "new"),
            ("1", day[1], "a", "tie-munich-x", None), ("1", day[0], "b", "left-munich-x", "left"),
            ("2", None, "a", "never-munich-x", "never"), ("3", None, "a", "no-munich-x", "no"), ("3", day[2], "a", None, ""),
            (None, day[2], "a", "none-munich-x", "none"), ("4", day[2], None, "none-munich-x", "none"),
        ]
        for v in range(300)
    ]
    md = described(spark, rows).repartition(3)
    got = lkv.last_names(md, *sqlfuncs.NAMES)
    want = lkv.metadata_lkv(md).select("Subject", *sqlfuncs.NAMES).distinct()
    assert rows_of(got) == rows_of(want) and got.count() == 4
    # Both sides of the join read one row per series and names.
    assert len(re.findall(r"Aggregate \[Subject#\d+, Name#\d+, DataSetName#", plan_of(got))) == 2


def test_functions_read_the_names_view(spark, rows_of):
    md = described(spark, [
        {"Subject": "1", "Timestamp": datetime(2024, 1, 1), "Name": "a", "DataSetName": "cut-munich-x", "Site": "munich", "Workcell": "cut"},
        {"Subject": "2", "Timestamp": datetime(2024, 1, 1), "Name": "a", "DataSetName": "mes-munich-x", "Site": "munich", "Workcell": "mes"},
    ])
    made = [("1", datetime(2024, 1, 1, 0, k), "NumberOfManufacturedProducts", str(k)) for k in (1, 5)]
    spark.createDataFrame(made, TELEMETRY_SCHEMA).createOrReplaceTempView("names_telemetry")
    md.createOrReplaceTempView("names_metadata")
    sqlfuncs.create_lkv_view(spark, "names_metadata", "names_lkv")
    sqlfuncs.create_names_view(spark, "names_metadata", "names_last")
    window = "6000, TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 01:00:00'"
    asked = f"SELECT oee_station('cut', 'munich', {window}), oee_line('munich', {window}), oee_line('oslo', {window})"
    found = []
    for names in (None, "names_last"):
        sqlfuncs.create_functions(spark, "names_telemetry", "names_lkv", names)
        found.append(rows_of(spark.sql(asked)))
    assert found[0] == found[1] and [round(v, 9) if v is not None else v for v in found[0][0]] == [round(24 / 3600, 9), round(24 / 3600, 9), None]
    # A station without a writer of its name has no products.
    alone = described(spark, [{"Subject": "9", "Timestamp": datetime(2024, 1, 1), "Name": "a", "DataSetName": "z", "Site": "munich", "Workcell": "saw"}])
    md.unionByName(alone).createOrReplaceTempView("names_metadata")
    sqlfuncs.create_names_view(spark, "names_metadata", "names_last")
    sqlfuncs.create_functions(spark, "names_telemetry", "names_lkv", "names_last")
    assert spark.sql(f"SELECT oee_line('munich', {window})").first()[0] == 0.0
