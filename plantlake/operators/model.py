"""Information models: downloaded node sets to variables, placeholders and graphs.

A download is one JSON document (title, contributor.name, nodeset.nodesetXml). Documents spread
over the tasks; each one is parsed on its own.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.functions.nested import unfold
from plantlake.functions.text import contains_ci, not_empty
from plantlake.operators.spread import spread_join
from plantlake.schemas import METADATA_COLUMNS, MODEL_ENTERPRISE, PLACEHOLDER

DOWNLOAD = "struct<title:string,contributor:struct<name:string>,nodeset:struct<nodesetXml:string>>"
_NODE = (
    "_NodeId:string,_BrowseName:string,_DataType:string,_ParentNodeId:string,"
    "DisplayName:array<struct<_VALUE:string,_Locale:string>>,"
    "References:struct<Reference:array<struct<_VALUE:string,_ReferenceType:string>>>"
)
NODESET = (
    "struct<NamespaceUris:struct<Uri:array<string>>,"
    f"UAVariable:array<struct<{_NODE}>>,UAObject:array<struct<{_NODE}>>>"
)


def parse_downloads(downloads: DataFrame, json_col: str = "value") -> DataFrame:
    """Title, Contributor, NamespaceUri (the model's own, listed first) and the parsed node set."""
    doc = downloads.select(F.from_json(json_col, DOWNLOAD).alias("d"))
    parsed = doc.select(
        F.coalesce("d.title", F.lit("")).alias("Title"),
        F.coalesce("d.contributor.name", F.lit("")).alias("Contributor"),
        F.from_xml(F.col("d.nodeset.nodesetXml"), NODESET, {"rowTag": "UANodeSet"}).alias("nodeset"),
    )
    return parsed.withColumn(
        "NamespaceUri", F.coalesce(F.get("nodeset.NamespaceUris.Uri", F.lit(0)), F.lit(""))
    )


def _nodes(parsed: DataFrame, kind: str) -> DataFrame:
    def text(name: str) -> Column:
        return F.coalesce(F.col(f"n.{name}"), F.lit(""))

    references = F.coalesce(F.col("n.References.Reference"), F.array())
    keep = ("Title", "Contributor", "NamespaceUri")
    return unfold(parsed, F.col(f"nodeset.{kind}"), "n", *keep).select(
        "Title",
        "Contributor",
        "NamespaceUri",
        text("_NodeId").alias("NodeId"),
        F.coalesce(F.get("n.DisplayName", F.lit(0))["_VALUE"], F.lit("")).alias("DisplayName"),
        text("_BrowseName").alias("BrowseName"),
        text("_DataType").alias("DataType"),
        F.col("n._ParentNodeId").alias("ParentNodeId"),
        F.exists(
            references,
            lambda r: contains_ci(F.concat_ws(" ", r["_ReferenceType"], r["_VALUE"]), "HasModellingRule"),
        ).alias("has_rule"),
    )


def model_variables(parsed: DataFrame) -> DataFrame:
    return _nodes(parsed, "UAVariable")


def model_objects(parsed: DataFrame) -> DataFrame:
    return _nodes(parsed, "UAObject")


def information_model(variables: DataFrame) -> DataFrame:
    """The lookup table: Title, Contributor, NodeId, DisplayName, BrowseName, DataType."""
    return variables.select("Title", "Contributor", "NodeId", "DisplayName", "BrowseName", "DataType")


def future_metadata(variables: DataFrame, ts: Column, enterprise: str = MODEL_ENTERPRISE) -> DataFrame:
    """Metadata rows for variables a model announces, before any station publishes them."""
    future, none = F.lit(PLACEHOLDER), F.lit("")
    return (
        variables.where(not_empty("DisplayName"))
        .withColumns(
            {
                "Subject": F.col("NodeId"),
                "Timestamp": ts.cast("timestamp"),
                "DataSetName": F.col("Title"),
                "MajorVersion": F.lit(0).cast("bigint"),
                "MinorVersion": F.lit(0).cast("bigint"),
                "Name": F.col("DisplayName"),
                "BuiltInType": F.lit(0),
                "ValueRank": F.lit(-1),
                "Type": none,
                "Workcell": F.col("Title"),
                "Line": future,
                "Area": future,
                "Site": future,
                "Enterprise": F.lit(enterprise),
            }
        )
        .select(*METADATA_COLUMNS)
    )


def future_telemetry(variables: DataFrame, ts: Column) -> DataFrame:
    """Placeholder telemetry for the same variables."""
    return variables.where(not_empty("DisplayName")).select(
        F.col("NodeId").alias("Subject"),
        ts.cast("timestamp").alias("Timestamp"),
        F.col("DisplayName").alias("Name"),
        F.lit(PLACEHOLDER).alias("Value"),
    )


def model_graph(variables: DataFrame, objects: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the instances of a model: declarations with a modelling rule and method
    arguments are left out. A node id in both lists takes the variable's columns first."""
    key = ["Title", "NodeId"]

    def instances(df: DataFrame, side: str) -> DataFrame:
        return df.where(~F.col("has_rule")).select(
            *key,
            F.col("ParentNodeId").alias(f"{side}_parent"),
            F.col("DisplayName").alias(f"{side}_name"),
        )

    kept = variables.where(F.col("DisplayName") != "InputArguments")
    nodes = (
        instances(kept, "v")
        .join(instances(objects, "o"), key, "full")
        .select(
            "Title",
            F.col("NodeId").alias("source"),
            F.coalesce("v_parent", "o_parent").alias("target"),
            F.coalesce("v_name", "o_name").alias("name"),
        )
    )
    return nodes, nodes.where(not_empty("target")).select("Title", "source", "target")


def model_lookup(rows: DataFrame, model: DataFrame, by: str = "DisplayName") -> DataFrame:
    """Telemetry or metadata enriched with the imported model, matched on a name or node id.

    `by='DisplayName'` matches the row's Name, `by='NodeId'` its NodeId. Plants have few field names, so the rows
    of one name are spread.
    """
    left = "Name" if by == "DisplayName" else "NodeId"
    info = model.select(
        F.col(by).alias(left),
        *[
            F.col(c).alias(f"Model{c}")
            for c in ("Title", "NodeId", "BrowseName", "DataType")
            if c != by
        ],
    )
    return spread_join(rows, info, [left])
