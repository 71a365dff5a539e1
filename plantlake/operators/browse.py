"""Browsing the plant: namespaces, types, objects, relations, current and historical values.

The element id of an asset is its hierarchy path, levels joined by '/' with empty ones left out; a
variable adds its name. Nodes and edges both come from the last known metadata.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.functions.text import element_path, not_empty, type_id
from plantlake.operators.lkv import latest_values
from plantlake.operators.timerange import between_closed, utc

LEVELS = ["Enterprise", "Site", "Area", "Line", "Workcell"]


def namespaces(lkv: DataFrame) -> DataFrame:
    return lkv.where(not_empty("NamespaceUri")).select("NamespaceUri").distinct()


def object_types(lkv: DataFrame, namespace: str | None = None) -> DataFrame:
    """Distinct type ids, of one namespace if given."""
    typed = lkv.where(not_empty("NamespaceUri"))
    if namespace is not None:
        typed = typed.where(F.col("NamespaceUri") == namespace)
    return typed.select(
        type_id("NamespaceUri", "Type").alias("TypeId"), "NamespaceUri", "Type"
    ).distinct()


def uns_graph(lkv: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the unified namespace: Enterprise, Site, Area, Line, Workcell, variable.

    nodes: ElementId, DisplayName, Level, ParentId. edges: parent, child, rel. Each metadata row
    unfolds into its own path; distinct combines partially before it shuffles.
    """
    names = LEVELS + ["Variable"]
    source = lkv.withColumn("Variable", F.col("Name"))
    # The parent of a level is the path above it, so missing levels close up.
    steps = F.array(
        *[
            F.struct(
                element_path(*names[: i + 1]).alias("ElementId"),
                F.coalesce(F.col(names[i]), F.lit("")).alias("DisplayName"),
                F.lit(names[i]).alias("Level"),
                element_path(*names[:i]).alias("ParentId"),
            )
            for i in range(len(names))
        ]
    )
    nodes = source.select(F.inline(steps)).where(F.col("DisplayName") != "").distinct()
    edges = nodes.where(F.col("ParentId") != "").select(
        F.col("ParentId").alias("parent"), F.col("ElementId").alias("child"), F.lit("contains").alias("rel")
    )
    return nodes, edges


def root_objects(nodes: DataFrame, edges: DataFrame, include_metadata: bool = False) -> DataFrame:
    """Nodes that are nobody's child."""
    children = edges.select(F.col("child").alias("ElementId")).distinct()
    tops = nodes.join(children, "ElementId", "left_anti")
    return tops if include_metadata else tops.select("ElementId", "DisplayName")


def variables(lkv: DataFrame) -> DataFrame:
    """Variables with their element, type, namespace and the writer that sends them."""
    return lkv.select(
        element_path(*LEVELS, "Name").alias("ElementId"),
        F.col("Name").alias("DisplayName"),
        type_id("NamespaceUri", "Type").alias("TypeId"),
        "NamespaceUri",
        "Subject",
        "Name",
    ).distinct()


def objects_of_type(objects: DataFrame, type_element_id: str, include_metadata: bool = False) -> DataFrame:
    found = objects.where(F.col("TypeId") == type_element_id)
    return found if include_metadata else found.select("ElementId", "DisplayName").distinct()


def related(ids: DataFrame, edges: DataFrame, rel: str | None = None) -> DataFrame:
    """Neighbours of the given elements in both directions: ElementId, RelatedId, rel, direction."""
    wanted = ids.select("ElementId").distinct()
    if rel is not None:
        edges = edges.where(F.col("rel") == rel)
    both = edges.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("parent").alias("ElementId"), F.col("child").alias("RelatedId"),
                    F.col("rel"), F.lit("child").alias("direction"),
                ),
                F.struct(
                    F.col("child").alias("ElementId"), F.col("parent").alias("RelatedId"),
                    F.col("rel"), F.lit("parent").alias("direction"),
                ),
            )
        )
    )
    return both.join(wanted, "ElementId")


def current_values(telemetry: DataFrame, ids: DataFrame) -> DataFrame:
    """Latest value, quality and timestamp of the given variables (ElementId, Subject, Name)."""
    wanted = ids.select("ElementId", "Subject", "Name").distinct()
    readings = telemetry.join(wanted.select("Subject", "Name").distinct(), ["Subject", "Name"], "left_semi")
    return latest_values(readings, wanted).select("ElementId", "Value", "Quality", "Timestamp")


def value_history(
    telemetry: DataFrame, ids: DataFrame, as_of, start=None, end=None, default_window: str = "1 HOUR"
) -> DataFrame:
    """All values of the given variables in a closed range.

    A missing end is `as_of`; a missing start is `default_window` before the end.
    """
    end = utc(end if end is not None else as_of)
    start = utc(start) if start is not None else end - F.expr(f"INTERVAL {default_window}")
    wanted = ids.select("ElementId", "Subject", "Name").distinct()
    return (
        between_closed(telemetry, start, end)
        .join(wanted, ["Subject", "Name"])
        .select(
            "ElementId",
            "Timestamp",
            "Value",
            F.when(F.col("Value").isNotNull(), "Good").otherwise("Bad").alias("Quality"),
        )
    )
