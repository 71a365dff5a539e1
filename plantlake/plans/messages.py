"""Raw JSON documents built from the derived tables, so that parsing has an independent check."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.plans.fixtures import BIG, Plant

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _payload(name: Column, value: Column) -> Column:
    return F.create_map(name, F.struct(value.alias("Value")))


def single_messages(plant: Plant) -> DataFrame:
    """One document per reading of `tel`: writers with and without a topic suffix, payloads as an
    object or as an array of objects."""
    suffix = F.when(F.col("Name") == "Pressure", F.concat("Subject", F.lit("/telemetry"))).otherwise(F.col("Subject"))
    head = [suffix.alias("DataSetWriterId"), F.date_format("Timestamp", ISO).alias("Timestamp")]
    field = _payload(F.col("Name"), F.col("Value"))
    as_object = F.to_json(F.struct(*head, field.alias("Payload")))
    as_array = F.to_json(F.struct(*head, F.array(field).alias("Payload")))
    return plant.tel.select(
        F.when(F.col("Name") == "Status", as_array).otherwise(as_object).alias("payload")
    )


def batched_messages(plant: Plant) -> DataFrame:
    """One document per order: the array of messages of its line items in `big`."""
    rows = _big_with_order(plant)
    message = F.struct(
        F.col("Subject").alias("DataSetWriterId"),
        F.date_format("Timestamp", ISO).alias("Timestamp"),
        _payload(F.col("Name"), F.col("Value")).alias("Payload"),
    )
    # An order has a handful of line items, so the list stays small.
    return rows.groupBy("l_orderkey").agg(F.to_json(F.collect_list(message)).alias("payload")).select("payload")


def _big_with_order(plant: Plant) -> DataFrame:
    return plant.sql(BIG.replace("SELECT CAST(l_suppkey", "SELECT l_orderkey, CAST(l_suppkey", 1))


def metadata_messages(plant: Plant) -> DataFrame:
    """One document per order's metadata message, its ten fields in one list."""
    fields = F.collect_list(
        F.struct(
            "Name",
            F.col("Type").alias("Description"),
            "BuiltInType",
            "DataType",
            "ValueRank",
        )
    )
    return (
        plant.md.groupBy("Subject", "Timestamp", "DataSetName", "MajorVersion", "MinorVersion")
        .agg(fields.alias("Fields"))
        .select(
            F.to_json(
                F.struct(
                    F.col("Subject").alias("DataSetWriterId"),
                    F.date_format("Timestamp", ISO).alias("Timestamp"),
                    F.struct(
                        F.col("DataSetName").alias("Name"),
                        F.struct("MajorVersion", "MinorVersion").alias("ConfigurationVersion"),
                        "Fields",
                    ).alias("MetaData"),
                )
            ).alias("payload")
        )
    )
