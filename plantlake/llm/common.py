"""Helpers shared by the operators: stored tables, Arrow batches in and out, numbering over many tasks."""

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantlake.session import scratch

RANGES = 4096


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the folder that all executors share and read again; later steps do not depend on its lineage.

    Executors keep the shuffle files of a finished job until the driver's JVM has collected its plan. The table makes
    them useless, so the driver collects now rather than whenever its heap fills.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """A function of an iterator of batches, as `mapInArrow` wants it, from a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield out

    return run


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose `column` holds about `most` bytes; a longer text is a part of its own."""
    values = batch.column(column)
    values = values if pa.types.is_binary(values.type) else values.cast(pa.large_string())
    sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
    first, held = 0, 0
    for k, size in enumerate(sizes):
        if k > first and held + size > most:
            yield batch.slice(first, k - first)
            first, held = k, 0
        held += size
    if first < batch.num_rows:
        yield batch.slice(first)


def spread(*keys: Column | str) -> Column:
    """One of `RANGES` equal ranges of the hash of `keys`."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 64 - RANGES.bit_length() + 1)


def running(df: DataFrame, group: list[str], part: str, order: list, amount: Column, into: str) -> DataFrame:
    """Adds as `into` the sum of `amount` over all rows of `group` that come earlier by (`part`, `order`).

    A group is dealt out by its parts: each part is summed before the shuffle, only the sums of the parts are added up
    in one place, and a window runs inside a part alone. So a group with most of the rows still keeps all tasks busy.
    Null group keys form a group of their own.
    """
    whole = df.withColumn("_amount", amount)
    sums = whole.groupBy(*group, part).agg(F.sum("_amount").alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(g).alias(f"_g{k}") for k, g in enumerate(group)],
        F.col(part).alias("_part"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = whole.withColumn("_inner", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
    same = [F.col(g).eqNullSafe(F.col(f"_g{k}")) for k, g in enumerate(group)] + [F.col(part) == F.col("_part")]
    joined = inner.join(sums, reduce(and_, same))
    return joined.withColumn(into, F.col("_before") + F.col("_inner")).drop(
        "_amount", "_inner", "_before", "_part", *[f"_g{k}" for k in range(len(group))]
    )
