"""File sources: calendars, tag lists, JSON documents, model downloads, node sets."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.operators.model import NODESET
from plantlake.operators.shifts import parse_calendar

TAG_LIST = (
    "NodeID STRING, TagName STRING, QueueSize INT, ObservabilityMode STRING, "
    "`Sampling Interval Milliseconds` INT"
)


def read_shift_calendar(spark: SparkSession, path: str) -> DataFrame:
    """(shift, start_min, end_min) from lines `name,HH:mm,HH:mm`.

    Read as text, since a CSV reader would pad or cut lines that are no calendar lines.
    """
    return parse_calendar(spark.read.text(path))


def read_tag_list(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("header", True)
        .schema(TAG_LIST)
        .csv(path)
        .withColumnRenamed("Sampling Interval Milliseconds", "SamplingMs")
    )


def read_documents(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Whole JSON files below a folder, one row each: value, path."""
    return (
        spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
        .select("value", F.col("_metadata.file_path").alias("path"))
    )


def read_nodesets(spark: SparkSession, path: str) -> DataFrame:
    """Bare node set XML files in the shape of parsed downloads, titled by their file name."""
    return (
        spark.read.text(path, wholetext=True)
        .select(
            F.regexp_extract("_metadata.file_name", r"^([^.]+)", 1).alias("Title"),
            F.lit("").alias("Contributor"),
            F.from_xml(F.col("value"), NODESET, {"rowTag": "UANodeSet"}).alias("nodeset"),
        )
        .withColumn("NamespaceUri", F.coalesce(F.get("nodeset.NamespaceUris.Uri", F.lit(0)), F.lit("")))
    )
