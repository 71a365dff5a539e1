"""Tables: creation, appends, partitioned telemetry, ingestion checks."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.schemas import TABLES
from plantlake.session import require_utc

# Tables that are partitioned by the UTC date of their timestamp, which the time range functions prune on.
DATED = ("telemetry",)


def create_tables(spark: SparkSession, fmt: str = "parquet", tables: dict[str, str] = TABLES) -> list[str]:
    """Create the missing tables, of the current database or the one in their names; returns the created names."""
    created = []
    for name, ddl in tables.items():
        if not spark.catalog.tableExists(name):
            dated = name.split(".")[-1] in DATED
            columns = f"{ddl}, date DATE" if dated else ddl
            spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} {'PARTITIONED BY (date)' if dated else ''}")
            created.append(name)
    return created


def missing_tables(spark: SparkSession, required: list[str]) -> list[str]:
    return [name for name in required if not spark.catalog.tableExists(name)]


def append_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """Append to a table, creating it on first use; a table by date gets its rows laid out by date."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        if "date" in spark.table(name).columns and "date" not in df.columns:
            df = laid_out(df)
        df.select(*spark.table(name).columns).write.insertInto(name)
    else:
        df.write.format(fmt).saveAsTable(name)


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("overwrite").saveAsTable(name)


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace only the partitions `df` has rows for; repeating it changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def laid_out(telemetry: DataFrame) -> DataFrame:
    """Telemetry as it is stored: by UTC date, and sorted by name and writer within a file.

    Filters on time then skip folders, and filters on name or writer skip row groups. Rebalancing
    gives files of even size: a date that is far larger than others is split.
    """
    require_utc(telemetry.sparkSession)
    return (
        telemetry.withColumn("date", F.to_date("Timestamp"))
        .hint("rebalance", "date")
        .sortWithinPartitions("date", "Name", "Subject", "Timestamp")
    )


def write_telemetry(telemetry: DataFrame, path: str, mode: str = "append") -> None:
    laid_out(telemetry).write.mode(mode).partitionBy("date").parquet(path)


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    """Telemetry with its `date` column, by which the time range functions prune folders."""
    return spark.read.parquet(path)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) of the given tables."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    return counted
