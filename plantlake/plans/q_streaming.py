"""Queries that run a streaming job to its end over files derived from the given tables.

Each job reads what Spark wrote to a new folder below the shared scratch root, processes all of
it, stops, and its sink is read back as a table.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.operators import monitor, oee
from plantlake.plans.fixtures import Plant
from plantlake.plans.messages import batched_messages, metadata_messages, single_messages
from plantlake.plans.q_monitor import COMMANDS, FAULTS, LOW_SHIFTS, MD
from plantlake.plans.registry import query
from plantlake.schemas import METADATA_SCHEMA, TELEMETRY_SCHEMA
from plantlake.session import scratch, set_within
from plantlake.streaming import jobs


# Lists of described fields are some 13 times their size in a shuffle when a task sorts them by message, so that a task of the
# usual 64 MB spills.
LISTS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"}


def _topic(raw, root: str, name: str) -> str:
    """Raw documents as a folder of packed text files, one document per line; every field's name is in every document."""
    path = f"{root}/{name}"
    with set_within(raw.sparkSession, LISTS):
        raw.write.option("compression", "gzip").text(path)
    return path


def fed(rows: DataFrame, path: str, batches: int) -> dict[str, str]:
    """Writes a table by the tasks that make its rows, and gives the options by which a stream reads it in `batches` or more.

    No row is moved for it: a file has at most its share of the rows, and a batch as many files as make up a share.
    """
    share = max(1, -(-rows.count() // batches))
    rows.write.option("maxRecordsPerFile", share).parquet(path)
    files = len(rows.sparkSession.read.parquet(path).inputFiles())
    return {"maxFilesPerTrigger": str(max(1, files // batches))}


@query(
    "stream_raw_ingest",
    """SELECT '{"DataSetWriterId":"' || user_id || '","Payload":{"n":{"Value":' || event_id || '}}}' AS payload FROM events""",
)
def stream_raw_ingest(p: Plant):
    root = scratch(p.spark, "land")
    raw = p.table("events").select(
        F.format_string(
            '{"DataSetWriterId":"%s","Payload":{"n":{"Value":%s}}}', F.col("user_id"), F.col("event_id")
        ).alias("value")
    )
    topic = _topic(raw, root, "topic")
    jobs.land(p.spark, "text", topic, root, "telemetry_raw", once=True).awaitTermination()
    return p.spark.read.parquet(f"{root}/telemetry_raw")


@query("stream_expand", "SELECT Subject, Timestamp, Name, Value FROM tel UNION ALL SELECT Subject, Timestamp, Name, Value FROM big", "tel", "big")
def stream_expand(p: Plant):
    """Land, then expand from the landed table: two jobs with a checkpoint each."""
    root = scratch(p.spark, "expand")
    topic = _topic(single_messages(p).unionByName(batched_messages(p)), root, "topic")
    jobs.land(p.spark, "text", topic, root, "telemetry_raw", once=True).awaitTermination()
    jobs.expand(p.spark, root, "telemetry", once=True).awaitTermination()
    return p.spark.read.parquet(f"{root}/telemetry").drop("date")


@query("stream_expand_metadata", f"SELECT {MD} FROM md", "md")
def stream_expand_metadata(p: Plant):
    root = scratch(p.spark, "expand")
    topic = _topic(metadata_messages(p), root, "topic")
    jobs.land(p.spark, "text", topic, root, "metadata_raw", once=True).awaitTermination()
    jobs.expand(p.spark, root, "metadata", once=True).awaitTermination()
    return p.spark.read.parquet(f"{root}/metadata")


@query("stream_land_and_expand", "SELECT Subject, Timestamp, Name, Value FROM tel", "tel")
def stream_land_and_expand(p: Plant):
    """Both tables from one batch, as an update policy fills them."""
    root = scratch(p.spark, "both")
    topic = _topic(single_messages(p), root, "topic")
    raw = jobs.read_topic(p.spark, "text", topic)
    jobs.land_and_expand(p.spark, raw, root, once=True).awaitTermination()
    return p.spark.read.parquet(f"{root}/telemetry").drop("date", "batch_id")


@query("mirror_parquet", "SELECT Subject, Timestamp, Name, Value, CAST(CAST(Timestamp AS DATE) AS VARCHAR) AS date FROM tel", "tel")
def mirror_parquet(p: Plant):
    root = scratch(p.spark, "mirror")
    p.tel.write.parquet(f"{root}/telemetry")
    jobs.mirror(p.spark, f"{root}/telemetry", TELEMETRY_SCHEMA, root, "mirror", once=True).awaitTermination()
    return p.spark.read.parquet(f"{root}/mirror").withColumn("date", F.col("date").cast("string"))


@query("stream_lkv", f"SELECT {MD} FROM lkv_one", "lkv_one")
def stream_lkv(p: Plant):
    """Last known metadata kept up batch by batch, with a merge on the way."""
    root = scratch(p.spark, "lkv")
    options = fed(p.md, f"{root}/metadata", 4)
    source = jobs.read_table_stream(p.spark, f"{root}/metadata", METADATA_SCHEMA, options=options)
    jobs.maintain_lkv(source, f"{root}/lkv", compact_every=3, once=True).awaitTermination()
    return jobs.read_lkv(p.spark, f"{root}/lkv")


@query(
    "stream_throughput",
    """, w AS (SELECT Subject, CAST(time_bucket(INTERVAL 6 HOUR, Timestamp, TIMESTAMP '2000-01-01 00:00:00') AS TIMESTAMP) AS window_start,
         max(TRY_CAST(Value AS DOUBLE)) - min(TRY_CAST(Value AS DOUBLE)) AS produced, count(*) AS readings
       FROM big WHERE Name = 'NumberOfManufacturedProducts' GROUP BY 1, 2)
     SELECT * FROM w WHERE window_start + INTERVAL 6 HOUR <= (SELECT max(Timestamp) FROM big) - INTERVAL 10 MINUTE""",
    "big",
)
def stream_throughput(p: Plant):
    """Windows the watermark has closed by the end of the data."""
    root = scratch(p.spark, "throughput")
    p.big.write.parquet(f"{root}/telemetry")
    windows = jobs.stream_throughput(jobs.telemetry_stream(p.spark, f"{root}/telemetry"), ["Subject"], "6 hours")
    jobs.write_append(windows, f"{root}/out", f"{root}/_checkpoint", once=True).awaitTermination()
    return p.spark.read.parquet(f"{root}/out")


@query("stream_alerts", FAULTS, "tel", "md")
def stream_alerts(p: Plant):
    root = scratch(p.spark, "alerts")
    p.tel.write.parquet(f"{root}/telemetry")
    metadata = p.md

    def alerts(batch):
        return monitor.fault_alerts(batch, metadata, "2024-01-20T12:00:00Z")

    source = jobs.telemetry_stream(p.spark, f"{root}/telemetry")
    jobs.run_alerts(source, alerts, f"{root}/sink", once=True).awaitTermination()
    return p.spark.read.parquet(f"{root}/sink/alerts").drop("batch_id")


@query(
    "stream_values",
    """SELECT Subject, Name, Timestamp, Value FROM (SELECT *, row_number() OVER (PARTITION BY Subject, Name
         ORDER BY Timestamp DESC, Value DESC) AS rn FROM big) r WHERE rn = 1""",
    "big",
)
def stream_values(p: Plant):
    """Last reading per series kept up batch by batch, with merges and removals on the way."""
    root = scratch(p.spark, "values")
    source = jobs.telemetry_stream(p.spark, f"{root}/telemetry", fed(p.big, f"{root}/telemetry", 6))
    jobs.maintain_values(source, f"{root}/last", compact_every=2, once=True).awaitTermination()
    return jobs.read_values(p.spark, f"{root}/last")


@query("stream_oee_alert", LOW_SHIFTS, "big", "lkv", "sites")
def stream_oee_alert(p: Plant):
    """The shifts that are low by their last figure. Readings come in any order within the month they are of."""
    root = scratch(p.spark, "oee")
    options = fed(p.big, f"{root}/telemetry", 3)
    p.lkv.write.parquet(f"{root}/lkv")
    source = jobs.telemetry_stream(p.spark, f"{root}/telemetry", options)
    last_known = p.spark.read.parquet(f"{root}/lkv")
    jobs.run_oee_alerts(
        source, last_known, p.sites, f"{root}/sink", once=True, late="31 days", compact_every=2
    ).awaitTermination()
    alerts = oee.low_oee_alerts(jobs.read_figures(p.spark, f"{root}/sink"))
    return alerts.select(
        "Site", "Workcell", F.col("shift_day").cast("string").alias("shift_day"), "shift", "oee_pct"
    )


@query("stream_pressure_trigger", COMMANDS, "tel", "lkv")
def stream_pressure_trigger(p: Plant):
    root = scratch(p.spark, "pressure")
    p.tel.write.parquet(f"{root}/telemetry")
    source = jobs.telemetry_stream(p.spark, f"{root}/telemetry")
    jobs.run_pressure_commands(
        source, lambda: p.lkv, "assembly", "europe", 2520, f"{root}/sink", once=True, topic_root="plant/"
    ).awaitTermination()
    return p.spark.read.parquet(f"{root}/sink/commands").drop("batch_id")


@query("stream_metadata_dedup", "SELECT DISTINCT Subject, DataSetName, Name, MajorVersion, MinorVersion FROM md", "md")
def stream_metadata_dedup(p: Plant):
    """Every description sent twice, kept once."""
    root = scratch(p.spark, "dedup")
    # Descriptions pack so well that a task's file would be read by a single task.
    p.md.unionByName(p.md).write.option("maxRecordsPerFile", 500_000).parquet(f"{root}/metadata")
    stream = jobs.without_repeats(jobs.read_table_stream(p.spark, f"{root}/metadata", METADATA_SCHEMA))
    jobs.write_append(stream, f"{root}/out", f"{root}/_checkpoint", once=True).awaitTermination()
    out = p.spark.read.parquet(f"{root}/out")
    return out.select("Subject", "DataSetName", "Name", "MajorVersion", "MinorVersion")
