"""Queries over messages, names and predicates."""

from pyspark.sql import functions as F

from plantlake.functions import sqlfuncs, text
from plantlake.operators import endpoints, expand, monitor, timerange
from plantlake.plans.fixtures import Plant
from plantlake.plans.messages import ISO, batched_messages, metadata_messages, single_messages
from plantlake.plans.registry import query
from plantlake.schemas import NON_PRODUCTION_WORKCELLS, TABLES
from plantlake.session import scratch
from plantlake.sources import tables

MD_COLUMNS = (
    "Subject, Timestamp, DataSetName, MajorVersion, MinorVersion, Name, BuiltInType, DataType, ValueRank, "
    "Type, DisplayName, Workcell, Line, Area, Site, Enterprise, NamespaceUri, NodeId"
)


@query(
    "telemetry_expand",
    "SELECT Subject, Timestamp, Name, Value FROM tel UNION ALL SELECT Subject, Timestamp, Name, Value FROM big",
    "tel", "big",
)
def telemetry_expand(p: Plant):
    return expand.expand_telemetry(single_messages(p).unionByName(batched_messages(p)))


@query("metadata_expand", f"SELECT {MD_COLUMNS} FROM md", "md")
def metadata_expand(p: Plant):
    return expand.expand_metadata(metadata_messages(p))


@query(
    "telemetry_rejects",
    """SELECT CAST(l_suppkey AS VARCHAR) AS Subject, CASE WHEN l_returnflag = 'A' THEN NULL ELSE 'Bad' END AS Name,
         CASE WHEN l_returnflag = 'A' THEN 'payload is neither an object nor an array of objects'
              ELSE 'payload field is not an object' END AS reason, count(*) AS n
       FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1, 2, 3
       UNION ALL SELECT NULL, NULL, 'not a message or an array of messages', count(*) FROM lineitem
       WHERE l_returnflag NOT IN ('A', 'R')""",
)
def telemetry_rejects(p: Plant):
    """Line items as broken documents: by return flag a text payload, one bad field, or no JSON."""
    subject = F.col("l_suppkey").cast("string")
    raw = p.table("lineitem").select(
        F.when(
            F.col("l_returnflag") == "A",
            F.format_string('{"DataSetWriterId":"%s","Timestamp":"x","Payload":"text"}', subject),
        )
        .when(
            F.col("l_returnflag") == "R",
            F.format_string('[{"DataSetWriterId":"%s/t","Payload":{"Bad":7,"Good":{"Value":1}}}]', subject),
        )
        .otherwise(F.lit("not json{"))
        .alias("payload")
    )
    rejects = expand.telemetry_rejects(raw)
    return rejects.groupBy("Subject", "Name", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "metadata_rejects",
    """SELECT CASE WHEN c_acctbal < 0 THEN 'not json ' || c_custkey
         ELSE '{"DataSetWriterId":"' || c_custkey || '","MetaData":{"Name":"bare"}}' END AS payload,
         'no field descriptions' AS reason FROM customer""",
)
def metadata_rejects(p: Plant):
    """Customers as documents without fields or without JSON, among all good descriptions."""
    key = F.col("c_custkey")
    broken = p.table("customer").select(
        F.when(F.col("c_acctbal") < 0, F.format_string("not json %s", key))
        .otherwise(F.format_string('{"DataSetWriterId":"%s","MetaData":{"Name":"bare"}}', key))
        .alias("payload")
    )
    return expand.metadata_rejects(metadata_messages(p).unionByName(broken))


@query(
    "sql_expand",
    "SELECT Subject, Timestamp, Name, Value FROM tel UNION ALL SELECT Subject, Timestamp, Name, DataType FROM md",
    "tel", "md",
)
def sql_expand(p: Plant):
    """Both expansions as SQL table functions."""
    single_messages(p).createOrReplaceTempView("plant_telemetry_raw")
    metadata_messages(p).createOrReplaceTempView("plant_metadata_raw")
    sqlfuncs.create_expansions(p.spark, "plant_telemetry_raw", "plant_metadata_raw")
    return p.sql(
        """SELECT Subject, Timestamp, Name, Value FROM telemetry_expand()
           UNION ALL SELECT Subject, Timestamp, Name, DataType FROM metadata_expand()"""
    )


@query(
    "table_append",
    "SELECT Subject, Timestamp, Name, Value, CAST(CAST(Timestamp AS DATE) AS VARCHAR) AS date FROM (SELECT * FROM tel UNION ALL SELECT * FROM big) a",
    "tel", "big",
)
def table_append(p: Plant):
    """Catalog tables created, appended to twice, copied, and the copy overwritten with the whole."""
    root = scratch(p.spark, "catalog")
    base = "plant_" + root.rpartition("-")[2]
    p.spark.sql(f"CREATE DATABASE {base} LOCATION '{root}'")
    tables.create_tables(p.spark, tables={f"{base}.{name}": ddl for name, ddl in TABLES.items()})
    tables.append_table(p.tel, f"{base}.telemetry")
    tables.append_table(p.spark.table(f"{base}.telemetry"), f"{base}.copy")
    tables.append_table(p.big, f"{base}.telemetry")
    tables.overwrite_table(p.spark.table(f"{base}.telemetry"), f"{base}.copy")
    return p.spark.table(f"{base}.copy").withColumn("date", F.col("date").cast("string"))


@query(
    "raw_variant",
    """SELECT 'object' AS kind, Subject AS first_subject, Name AS first_name, count(*) AS n FROM tel GROUP BY 1, 2, 3
       UNION ALL SELECT 'array', NULL, NULL, count(DISTINCT l_orderkey) FROM lineitem""",
    "tel",
)
def raw_variant(p: Plant):
    """Documents landed as VARIANT, read back by path without a schema."""
    singles = p.tel.select(
        F.to_json(
            F.struct(F.col("Subject").alias("DataSetWriterId"), F.struct("Name", "Value").alias("Payload"))
        ).alias("payload")
    )
    docs = expand.as_variant(singles.unionByName(batched_messages(p)))
    return (
        docs.select(
            "kind",
            F.try_variant_get("document", "$.DataSetWriterId", "string").alias("first_subject"),
            F.try_variant_get("document", "$.Payload.Name", "string").alias("first_name"),
        )
        .groupBy("kind", "first_subject", "first_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("envelope_wrap", "SELECT Subject, Timestamp, Name, Value FROM tel UNION ALL SELECT Subject, NULL, Name, DataType FROM md", "tel", "md")
def envelope_wrap(p: Plant):
    """Edge events wrapped under Payload and MetaData, then read by the normal expansion."""
    time = F.date_format("Timestamp", ISO)
    body = F.from_json(
        F.to_json(F.create_map(F.col("Name"), F.struct("Value"))),
        "struct<ProductSerialNumber:struct<Value:string>,NumberOfManufacturedProducts:struct<Value:string>,"
        "NumberOfDiscardedProducts:struct<Value:string>,OverallRunningTime:struct<Value:string>,"
        "FaultyTime:struct<Value:string>,Status:struct<Value:string>,EnergyConsumption:struct<Value:string>,"
        "IdealCycleTime:struct<Value:string>,ActualCycleTime:struct<Value:string>,Pressure:struct<Value:string>>",
    )
    events = p.tel.select(F.concat("Subject", F.lit("/telemetry")).alias("subject"), time.alias("time"), body.alias("b"))
    flat = events.select("subject", "time", "b.*")
    names = [c for c in flat.columns if c not in ("subject", "time")]
    telemetry = expand.expand_telemetry(expand.envelope_wrap(flat, "Payload", names))
    described = p.md.select(
        F.col("Subject").alias("subject"),
        F.lit(None).cast("string").alias("time"),
        F.array(F.struct("Name", "DataType")).alias("Fields"),
    )
    metadata = expand.expand_metadata(expand.envelope_wrap(described, "MetaData", ["Fields"]))
    return telemetry.unionByName(
        metadata.select("Subject", "Timestamp", "Name", F.col("DataType").alias("Value"))
    )


@query(
    "subject_normalise",
    """SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS Subject,
         CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderdate END AS Timestamp, count(*) AS n
       FROM orders GROUP BY 1, 2""",
)
def subject_normalise(p: Plant):
    """Writer ids with topic suffixes, and ISO timestamps with an offset or none at all."""
    key = F.col("o_custkey").cast("string")
    ids = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("/"), key))
        .when(F.col("o_orderpriority") == "5-LOW", key)
        .otherwise(F.concat(key, F.lit("/telemetry/x")))
    )
    stamp = F.when(F.col("o_orderstatus") == "F", F.lit("not a time")).otherwise(
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 2 HOUR"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    )
    return (
        p.table("orders")
        .select(text.writer_id(ids).alias("Subject"), text.timestamp(stamp).alias("Timestamp"))
        .groupBy("Subject", "Timestamp")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "isa95_parse",
    """SELECT Workcell, Line, Area, Site, Enterprise, NamespaceUri, NodeId, count(*) AS n
       FROM orders JOIN writers w ON w.writer = o_custkey % (SELECT count(*) FROM supplier) GROUP BY ALL""",
    "writers",
)
def isa95_parse(p: Plant):
    senders = p.sql("SELECT o_custkey % (SELECT count(*) FROM supplier) AS writer FROM orders")
    names = senders.join(p.writers.select("writer", "DataSetName"), "writer")
    parsed = text.parse_isa95(names.select("DataSetName"))
    levels = ["Workcell", "Line", "Area", "Site", "Enterprise", "NamespaceUri", "NodeId"]
    return parsed.groupBy(*levels).agg(F.count(F.lit(1)).alias("n"))


@query(
    "isa95_lenient",
    "SELECT Workcell, Line, Site, NodeId, count(*) AS n FROM orders JOIN writers w ON w.writer = o_custkey % (SELECT count(*) FROM supplier) GROUP BY ALL",
    "writers",
)
def isa95_lenient(p: Plant):
    """Asset names that end after the location, next to server names."""
    senders = p.sql("SELECT o_custkey % (SELECT count(*) FROM supplier) AS writer FROM orders")
    short = F.replace("DataSetName", F.lit("-asset_telemetry"), F.lit(""))
    names = senders.join(p.writers.select("writer", short.alias("DataSetName")), "writer")
    parsed = text.parse_isa95(names.select("DataSetName"), lenient=True)
    return parsed.groupBy("Workcell", "Line", "Site", "NodeId").agg(F.count(F.lit(1)).alias("n"))


@query(
    "endpoint_parse",
    """SELECT 'opc.tcp://Cust_' || c_custkey || '.' || lower(c_mktsegment) AS Raw,
         'Cust_' || c_custkey || '.' || lower(c_mktsegment) AS Host, 'cust_' || c_custkey AS Station,
         'cust-' || c_custkey || '-' || lower(c_mktsegment) AS SafeName,
         'opc.tcp://Cust_' || c_custkey || '.' || lower(c_mktsegment)
           || CASE WHEN c_acctbal > 0 THEN ':4841' ELSE ':4840' END AS Address
       FROM customer""",
)
def endpoint_parse(p: Plant):
    raw = F.format_string("opc.tcp://Cust_%s.%s", F.col("c_custkey"), F.lower("c_mktsegment"))
    urls = p.table("customer").select(
        raw.alias("Raw"),
        F.when(F.col("c_acctbal") > 0, F.concat(raw, F.lit(":4841/")))
        .otherwise(F.concat(raw, F.lit("/path")))
        .alias("EndpointUrl"),
    )
    return text.parse_endpoint(urls, "EndpointUrl").select("Raw", "Host", "Station", "SafeName", "Address")


@query(
    "tag_naming",
    """SELECT CAST(l_orderkey AS VARCHAR) AS Endpoint,
         CASE WHEN l_returnflag = 'A' THEN 'nsu=http://example.org/;i=' || l_partkey ELSE 'nsu=http://example.org/;s=x' || l_partkey END AS NodeId,
         CASE WHEN l_returnflag = 'A' THEN coalesce(replace(p_name, ' ', ''), '?') ELSE '?' END AS name,
         CASE WHEN l_linestatus = 'F' THEN 500 ELSE 1000 END AS sampling_ms, count(*) AS n
       FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND p_size > 10 GROUP BY ALL""",
)
def tag_naming(p: Plant):
    """Orders as endpoints, line items as nodes, and large parts as known browse names."""
    item = F.struct(
        F.when(F.col("l_returnflag") == "A", F.format_string("nsu=http://example.org/;i=%s", F.col("l_partkey")))
        .otherwise(F.format_string("nsu=http://example.org/;s=x%s", F.col("l_partkey")))
        .alias("Id"),
        F.when(F.col("l_linestatus") == "F", 500).alias("OpcSamplingInterval"),
    )
    nodes = p.table("lineitem").groupBy("l_orderkey").agg(F.collect_list(item).alias("OpcNodes"))
    docs = nodes.select(
        F.to_json(
            F.array(
                F.struct(
                    F.format_string("opc.tcp://%s.plant:4840", F.col("l_orderkey")).alias("EndpointUrl"), "OpcNodes"
                )
            )
        ).alias("value")
    )
    names = p.table("part").where("p_size > 10").select(
        F.format_string("ns=1;i=%s", F.col("p_partkey")).alias("NodeId"),
        F.concat(F.lit("1:"), F.replace("p_name", F.lit(" "), F.lit(""))).alias("BrowseName"),
    )
    named = endpoints.name_tags(endpoints.parse_endpoints(docs), names, ["Station"])
    # Line items of an order have no order of their own, so the position in a fallback name is masked.
    return (
        named.withColumn("name", F.regexp_replace("name", r"^node-[0-9]+$", "?"))
        .withColumnRenamed("Station", "Endpoint")
        .groupBy("Endpoint", "NodeId", "name", "sampling_ms")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("match_contains_ci", "SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'the_') OR contains(lower(text), 'the ')")
def match_contains_ci(p: Plant):
    docs = p.table("documents")
    return docs.where(text.contains_ci("text", "The_") | text.contains_ci("text", "THE ")).select("doc_id", "lang")


@query("match_like", "SELECT doc_id, lang FROM documents WHERE text LIKE '%of_the%' AND NOT contains(text, 'of_the')")
def match_like(p: Plant):
    docs = p.table("documents")
    return docs.where(
        text.contains_like("text", "of_the") & ~text.contains_like("text", "of_the", literal=True)
    ).select("doc_id", "lang")


@query(
    "range_open",
    "SELECT Subject, Timestamp, Name, Value FROM big WHERE Timestamp > TIMESTAMP '2024-01-05 00:00:00' AND Timestamp < TIMESTAMP '2024-01-12 00:00:00'",
    "big",
)
def range_open(p: Plant):
    return timerange.between_open(p.big, "2024-01-05T00:00:00Z", "2024-01-12T00:00:00Z")


@query(
    "range_closed",
    "SELECT Subject, Timestamp, Name, Value FROM big WHERE Timestamp BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'",
    "big",
)
def range_closed(p: Plant):
    return timerange.between_closed(p.big, "2024-01-05T00:00:00Z", "2024-01-12T00:00:00Z")


@query(
    "last_hour",
    "SELECT Subject, Timestamp, Name, Value FROM big WHERE Timestamp > TIMESTAMP '2024-01-20 11:00:00' AND Timestamp < TIMESTAMP '2024-01-20 12:00:00'",
    "big",
)
def last_hour(p: Plant):
    return timerange.last(p.big, "2024-01-20T12:00:00Z", "1 HOUR")


@query(
    "exclude_stations",
    "SELECT DISTINCT Subject, Workcell, Site FROM md WHERE Workcell NOT IN ('publisher', 'mes', 'commander')",
    "md",
)
def exclude_stations(p: Plant):
    kept = p.md.where(~F.col("Workcell").isin(*NON_PRODUCTION_WORKCELLS))
    return kept.select("Subject", "Workcell", "Site").distinct()


@query(
    "ingest_health",
    """SELECT t.table_name, t.n IS NOT NULL AS present, coalesce(t.n, 0) AS n_rows, coalesce(t.n, 0) > 0 AS has_rows
       FROM (SELECT 'telemetry' AS table_name, count(*) AS n FROM big UNION ALL SELECT 'metadata', count(*) FROM md
             UNION ALL SELECT 'late', count(*) FROM big WHERE Timestamp > TIMESTAMP '2030-01-01 00:00:00'
             UNION ALL SELECT 'absent', NULL) t""",
    "big", "md",
)
def ingest_health(p: Plant):
    counts = tables.row_counts(
        {
            "telemetry": p.big,
            "metadata": p.md,
            "late": p.big.where("Timestamp > TIMESTAMP '2030-01-01 00:00:00'"),
        }
    )
    required = p.spark.createDataFrame([(n,) for n in ("telemetry", "metadata", "late", "absent")], "table_name STRING")
    return monitor.ingest_health(counts, required)
