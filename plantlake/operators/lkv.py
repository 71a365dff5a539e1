"""Last known values of metadata and telemetry."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.functions.text import matches

SERIES = ["Subject", "Name"]


def metadata_lkv(metadata: DataFrame, ties: bool = True) -> DataFrame:
    """Latest metadata row per (Subject, Name).

    With `ties` all rows at the latest timestamp stay, as a view over the table would show
    them. Without, one row stays: highest timestamp, then highest versions. Rows with a NULL
    key are left out either way.
    """
    keyed = metadata.where(F.col("Subject").isNotNull() & F.col("Name").isNotNull())
    # A first pass hashes three narrow columns; the wide rows are then filtered by its result. Where
    # that is a shuffle it is one by series and timestamp, so that a series resent a billion times still
    # spreads over all tasks.
    latest = keyed.groupBy(*SERIES).agg(F.max("Timestamp").alias("Timestamp"))
    tied = keyed.join(latest, [*SERIES, "Timestamp"], "left_semi").select(
        *metadata.columns
    )
    return tied if ties else newest(tied)


def last_names(metadata: DataFrame, *names: str) -> DataFrame:
    """The distinct Subject and `names` of the last known metadata, ties included.

    Rows are reduced to one per series and names, with its latest time, where they are read: what is shuffled and joined
    grows with the series, not with the descriptions sent.
    """
    sent = metadata.groupBy(*SERIES, *names).agg(F.max("Timestamp").alias("Timestamp"))
    return metadata_lkv(sent).select("Subject", *names).distinct()


def newest(metadata: DataFrame) -> DataFrame:
    """One row per (Subject, Name) in a single pass, for inputs as small as a batch."""
    rest = [c for c in metadata.columns if c not in SERIES]
    order = F.struct("Timestamp", "MajorVersion", "MinorVersion")
    return (
        metadata.where(F.col("Subject").isNotNull() & F.col("Name").isNotNull())
        .groupBy(*SERIES)
        .agg(F.max_by(F.struct(*rest), order).alias("row"))
        .select(*SERIES, "row.*")
        .select(*metadata.columns)
    )


def newest_values(telemetry: DataFrame) -> DataFrame:
    """The last reading of every series, of equal timestamps the one with the greatest value."""
    return (
        telemetry.where(F.col("Timestamp").isNotNull())
        .groupBy(*SERIES)
        .agg(F.max(F.struct("Timestamp", "Value")).alias("last"))
        .select("Subject", "last.Timestamp", "Name", "last.Value")
    )


def latest_values(telemetry: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Latest value, timestamp and quality per series; of equal timestamps the greatest value.

    `ids` (ElementId, Subject, Name) limits and labels the series. `telemetry` is the history or, at scale, the
    last readings that the streaming job keeps.
    """
    quality = F.when(F.col("Value").isNotNull(), "Good").otherwise("Bad")
    latest = newest_values(telemetry).select(*SERIES, "Timestamp", "Value", quality.alias("Quality"))
    # Joined after the aggregation: the join sees one row per series, not the history.
    return latest if ids is None else ids.join(latest, SERIES)


def writers_of(
    lkv: DataFrame, station: str, location: str, how: str = "like"
) -> DataFrame:
    """Distinct Subjects whose data set name matches a station and a location."""
    return (
        lkv.where(matches("DataSetName", station, how) & matches("DataSetName", location, how))
        .select("Subject")
        .distinct()
    )
