"""Time predicates that also prune date partitions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.session import require_utc


def utc(value) -> Column:
    """A timestamp literal from a Column or ISO-8601 text (UTC unless it has an offset)."""
    return value if isinstance(value, Column) else F.to_timestamp(F.lit(value))


def _prune(df: DataFrame, start: Column | None, end: Column | None) -> DataFrame:
    # A table written by `write_telemetry` is partitioned by the UTC date of Timestamp; that
    # predicate is stated because it does not follow from the one on Timestamp by itself.
    if "date" in df.columns:
        require_utc(df.sparkSession)
        if start is not None:
            df = df.where(F.col("date") >= F.to_date(start))
        if end is not None:
            df = df.where(F.col("date") <= F.to_date(end))
    return df


def between_open(df: DataFrame, start, end, ts: str = "Timestamp") -> DataFrame:
    """Rows strictly between two instants."""
    start, end = utc(start), utc(end)
    return _prune(df, start, end).where((F.col(ts) > start) & (F.col(ts) < end))


def between_closed(df: DataFrame, start, end, ts: str = "Timestamp") -> DataFrame:
    """Rows between two instants, both included."""
    start, end = utc(start), utc(end)
    return _prune(df, start, end).where(F.col(ts).between(start, end))


def last(df: DataFrame, as_of, length: str, ts: str = "Timestamp") -> DataFrame:
    """Rows in the open window of `length` (such as '1 HOUR') that ends at `as_of`."""
    as_of = utc(as_of)
    return between_open(df, as_of - F.expr(f"INTERVAL {length}"), as_of, ts)
