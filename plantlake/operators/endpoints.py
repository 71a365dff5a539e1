"""Plant server lists: endpoints, their stations and the names of their tags."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.functions.nested import unfold
from plantlake.functions.text import NUMERIC_NODE_ID, parse_endpoint
from plantlake.operators.spread import spread_join

ENDPOINTS = (
    "array<struct<EndpointUrl:string,OpcAuthenticationMode:string,"
    "OpcNodes:array<struct<Id:string,OpcSamplingInterval:int>>>>"
)


def parse_endpoints(documents: DataFrame, text_col: str = "value", excluded=("commander", "mes")) -> DataFrame:
    """Endpoint documents to one row per endpoint, without the excluded stations."""
    rows = unfold(documents, F.from_json(text_col, ENDPOINTS), "e").select(
        F.col("e.EndpointUrl").alias("EndpointUrl"),
        F.coalesce("e.OpcAuthenticationMode", F.lit("Anonymous")).alias("AuthenticationMode"),
        F.col("e.OpcNodes").alias("OpcNodes"),
    )
    return parse_endpoint(rows, "EndpointUrl").where(~F.col("Station").isin(*excluded))


def name_tags(endpoints: DataFrame, browse_names: DataFrame, keys: list[str]) -> DataFrame:
    """One row per node with its tag name: the browse name of its numeric id, else node-<index>.

    `browse_names` has NodeId and BrowseName (with or without a namespace prefix). If an id is
    listed more than once, the greatest name counts.
    """
    names = (
        browse_names.select(
            F.regexp_extract("NodeId", NUMERIC_NODE_ID, 1).alias("node"),
            F.regexp_replace("BrowseName", r"^[^:]*:", "").alias("browse"),
        )
        .where(F.col("node") != "")
        .groupBy("node")
        .agg(F.max("browse").alias("browse"))
    )
    nodes = endpoints.select(*keys, F.posexplode("OpcNodes").alias("index", "n")).select(
        *keys,
        "index",
        F.col("n.Id").alias("NodeId"),
        F.regexp_extract("n.Id", NUMERIC_NODE_ID, 1).alias("node"),
        F.coalesce("n.OpcSamplingInterval", F.lit(1000)).alias("sampling_ms"),
    )
    # Every station has the same few ids, and those without a number share one key: all are spread.
    return spread_join(nodes, names, ["node"]).select(
        *keys,
        "NodeId",
        F.coalesce("browse", F.concat(F.lit("node-"), F.col("index").cast("string"))).alias("name"),
        "sampling_ms",
    )
