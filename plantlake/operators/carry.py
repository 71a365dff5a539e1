"""Ordered per-series work in bounded pieces.

A window over a whole series puts that series into one task, and one series may hold a third
of all rows. The functions here cut a series into time pieces: the window runs inside a piece,
and what must cross a piece boundary (its first and last row) travels in a summary with one row
per piece. Rows of one instant are merged first, so a piece of one minute has at most as many
rows as a minute has microseconds, however hot the series is.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = "piece"


def with_piece(df: DataFrame, ts: str = "Timestamp", grain: str = "minute") -> DataFrame:
    return df.withColumn(PIECE, F.date_trunc(grain, F.col(ts)))


def in_piece(keys: list[str], ts: str = "Timestamp"):
    """Window over the rows of a piece in time order."""
    return Window.partitionBy(*keys, PIECE).orderBy(ts)


def across_pieces(keys: list[str]):
    """Window over the piece summaries of a series in time order."""
    return Window.partitionBy(*keys).orderBy(PIECE)


def carry_forward(
    df: DataFrame, keys: list[str], value: str, ts: str = "Timestamp", grain: str = "minute"
) -> DataFrame:
    """Replace `value` by the last non-NULL one at or before each row of the series.

    `df` must hold one row per (keys, ts).
    """
    pieces = with_piece(df, ts, grain)
    known = pieces.where(F.col(value).isNotNull())
    carry = (
        known.groupBy(*keys, PIECE)
        .agg(F.max(F.struct(ts, value)).alias("_last"))
        .select(*keys, PIECE, F.col(f"_last.{value}").alias("_carry"))
    )
    # Every piece with rows needs the value carried into it; pieces without a value of
    # their own look further back.
    touched = pieces.select(*keys, PIECE).distinct()
    before = across_pieces(keys).rowsBetween(Window.unboundedPreceding, -1)
    incoming = touched.join(carry, [*keys, PIECE], "left").select(
        *keys, PIECE, F.last("_carry", ignorenulls=True).over(before).alias("_in")
    )
    so_far = in_piece(keys, ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        pieces.withColumn(value, F.last(value, ignorenulls=True).over(so_far))
        .join(incoming, [*keys, PIECE])
        .withColumn(value, F.coalesce(value, "_in"))
        .drop("_in", PIECE)
    )


def step_sums(
    df: DataFrame,
    keys: list[str],
    steps: dict[str, tuple[Column, str]],
    ts: str = "Timestamp",
    grain: str = "minute",
    by: str | None = None,
) -> DataFrame:
    """Sums over the steps between neighbouring rows of each series.

    `df` must hold one row per (keys, ts). `steps` maps an output column to an expression over
    the row's own columns (the earlier row) and those of its successor, prefixed `next_`, and
    the type it is summed in. `by` names a column of the earlier row to split the sums by. The
    last row of a series has no step.
    """
    cols = [c for c in df.columns if c not in keys]
    following = [f"next_{c}" for c in cols]
    pieces = with_piece(df, ts, grain)
    inner = in_piece(keys, ts)
    row = F.struct(*cols)

    def flat(d: DataFrame, here: str, there: str) -> DataFrame:
        return d.select(
            *keys,
            *[F.col(f"{here}.{c}").alias(c) for c in cols],
            *[F.col(f"{there}.{c}").alias(n) for c, n in zip(cols, following)],
        )

    def sums(d: DataFrame) -> DataFrame:
        group = [*keys, by] if by else keys
        return d.groupBy(*group).agg(*[F.sum(e.cast(t)).alias(n) for n, (e, t) in steps.items()])

    within = (
        pieces.withColumn("_here", row)
        .withColumn("_there", F.lead("_here").over(inner))
        .where(F.col("_there").isNotNull())
    )
    ordered = F.struct(ts, *[c for c in cols if c != ts])
    edges = pieces.groupBy(*keys, PIECE).agg(
        F.min(ordered).alias("_first"), F.max(ordered).alias("_last")
    )
    between = edges.withColumn("_next", F.lead("_first").over(across_pieces(keys))).where(
        F.col("_next").isNotNull()
    )
    both = sums(flat(within, "_here", "_there")).unionByName(sums(flat(between, "_last", "_next")))
    group = [*keys, by] if by else keys
    return both.groupBy(*group).agg(*[F.sum(n).cast(t).alias(n) for n, (_, t) in steps.items()])
