"""Condition monitoring: series, panels, alerts and the pressure feedback loop."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.functions.text import (
    alert_text,
    asset_name,
    matches,
    number,
    relief_topic,
    whole_number,
)
from plantlake.operators.lkv import latest_values, writers_of
from plantlake.operators.spread import spread_join
from plantlake.operators.timerange import between_closed, between_open, last, utc
from plantlake.schemas import FAULTY_TIME, PRESSURE, RELIEF_METHOD, RELIEF_OBJECT, STATUS


def station_rows(
    telemetry: DataFrame, lkv: DataFrame, station: str, location: str, how: str = "like"
) -> DataFrame:
    """Telemetry of the writers of a station, each row once."""
    return telemetry.join(writers_of(lkv, station, location, how), "Subject", "left_semi")


def station_series(
    telemetry: DataFrame,
    lkv: DataFrame,
    station: str,
    location: str,
    name: str,
    start,
    end,
    how: str = "like",
    dedupe: bool = False,
) -> DataFrame:
    """Timestamp and Value of one field of a station in an open window.

    As in a plain join with the last known metadata, each reading comes once per field its
    writer describes. `dedupe=True` gives each reading once.
    """
    counted = counted_series(telemetry, lkv, station, location, name, start, end, how)
    if not dedupe:
        counted = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return counted.select("Timestamp", "Value")


def counted_series(
    telemetry: DataFrame, lkv: DataFrame, station: str, location: str, name: str, start, end, how: str = "like"
) -> DataFrame:
    """A station series with each reading once, and in `copies` the number of fields its writer describes.

    A station has few writers, so the readings of one are spread.
    """
    readings = between_open(telemetry.where(F.col("Name") == name), start, end).select(
        "Subject", "Timestamp", "Value"
    )
    writers = (
        lkv.where(matches("DataSetName", station, how) & matches("DataSetName", location, how))
        .groupBy("Subject")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    return spread_join(readings, writers, ["Subject"], "inner").select("Timestamp", "Value", "copies")


def numeric_series(series: DataFrame, as_int: bool = False) -> DataFrame:
    """(Timestamp, NodeValue) for charts."""
    value = whole_number("Value") if as_int else number("Value")
    return series.select("Timestamp", value.alias("NodeValue"))


def newest_first(series: DataFrame) -> DataFrame:
    return series.orderBy(F.col("Timestamp").desc(), *[c for c in series.columns if c != "Timestamp"])


def status_of_station(
    telemetry: DataFrame,
    lkv: DataFrame,
    station: str,
    location: str,
    as_of,
    length: str = "1 HOUR",
    name: str = STATUS,
    how: str = "like",
) -> DataFrame:
    """Readings of the window that ends at `as_of`, with the station's names."""
    fields = lkv.where(
        matches("DataSetName", station, how) & matches("DataSetName", location, how)
    ).select("Subject", "DataSetName", "DisplayName", "Workcell", "Line")
    readings = last(telemetry.where(F.col("Name") == name), as_of, length).select(
        "Subject", "Timestamp", "Value"
    )
    return fields.join(readings, "Subject").drop("Subject")


def panel_max(series: DataFrame) -> DataFrame:
    """Highest whole number of a series: the counter panels."""
    return series.agg(F.max(whole_number("Value")).alias("num_prod"))


def panel_average(series: DataFrame) -> DataFrame:
    """Mean of a counted series times 1000, rounded to two places: the energy panel.

    Each reading weighs as much as the rows it has in a plain join.
    """
    value = number("Value")
    weight = F.sum(F.when(value.isNotNull(), F.col("copies")))
    return series.agg(F.round(F.sum(value * F.col("copies")) / weight * 1000, 2).alias("average"))


def asset_list(telemetry: DataFrame, metadata: DataFrame) -> DataFrame:
    """Distinct assets that have telemetry.

    Both sides shrink to distinct writers before they meet.
    """
    seen = telemetry.select("Subject").distinct()
    return (
        metadata.select("Subject", "DataSetName")
        .distinct()
        .join(seen, "Subject", "left_semi")
        .select(asset_name("DataSetName").alias("AssetName"))
        .distinct()
    )


def fault_alerts(
    telemetry: DataFrame, metadata: DataFrame, as_of, days: int = 3, repeat: bool = False
) -> DataFrame:
    """Positive fault times of the last days with their asset and an alert text.

    A join with the full metadata history would return each reading once per metadata row of
    its writer and asset. Here `copies` holds that number instead, and `repeat=True`
    turns it back into rows.
    """
    as_of = utc(as_of)
    start = as_of - F.make_dt_interval(days=F.lit(days))
    faults = between_closed(telemetry.where(F.col("Name") == FAULTY_TIME), start, as_of).where(
        number("Value") > 0
    )
    assets = (
        metadata.groupBy("Subject", "DataSetName")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("Subject", asset_name("DataSetName").alias("AssetName"))
        .agg(F.sum("n").alias("copies"))
    )
    alerts = faults.join(assets, "Subject").select(
        "AssetName",
        "Name",
        "Value",
        "Timestamp",
        alert_text("AssetName", "Name", "Value").alias("message"),
        "copies",
    )
    if repeat:
        alerts = alerts.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copy", "copies")
    return alerts


def pressure_trigger(
    telemetry: DataFrame,
    lkv: DataFrame,
    station: str,
    location: str,
    threshold: float,
    how: str = "like",
    topic_root: str = "",
) -> DataFrame:
    """One command row per pressure reading of a station above the threshold."""
    high = station_rows(telemetry.where(F.col("Name") == PRESSURE), lkv, station, location, how).where(
        number("Value") > threshold
    )
    return high.select(
        "Subject",
        "Timestamp",
        number("Value").alias("pressure"),
        F.lit(RELIEF_OBJECT).alias("object_id"),
        F.lit(RELIEF_METHOD).alias("method_id"),
        relief_topic(F.lit(f"{station}-{location}-asset"), topic_root).alias("topic"),
    )


def high_now(
    telemetry: DataFrame, lkv: DataFrame, station: str, location: str, name: str, threshold: float, how: str = "like"
) -> DataFrame:
    """Writers of a station whose latest value of a field is above the threshold."""
    readings = station_rows(telemetry.where(F.col("Name") == name), lkv, station, location, how)
    return latest_values(readings).where(number("Value") > threshold)


def ingest_health(counts: DataFrame, required: DataFrame) -> DataFrame:
    """Required tables (table_name) against counted ones (table_name, n_rows)."""
    return required.join(counts, "table_name", "left").select(
        "table_name",
        F.col("n_rows").isNotNull().alias("present"),
        F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
        (F.coalesce("n_rows", F.lit(0)) > 0).alias("has_rows"),
    )
