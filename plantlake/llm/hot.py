"""Joins whose hot keys are split over tasks in proportion to their counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than one in so many rows is hot, so there are fewer hot keys than this.
SHARES = 1000


def split_join(many: DataFrame, one: DataFrame, key: list[str], by: Column, how: str = "inner") -> DataFrame:
    """`many` joined to `one` on the columns `key`; rows of `many` under a hot key are dealt over parts by the hash of `by`.

    A key gets as many parts as it has thousandths of the rows, and the rows of `one` under it are repeated for each part.
    Only the hot keys are broadcast, fewer than `SHARES` rows. `many` is counted first, so it should be a stored table.
    Null keys join nothing. `how` is inner or left.
    """
    total = many.count()
    hot = many.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > total // SHARES)
    parts = F.ceil(F.col("_n") * SHARES / max(total, 1)).cast("int")
    hot = F.broadcast(hot.select(*key, parts.alias("_parts")))
    dealt = many.join(hot, key, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")).cast("int"), F.lit(0)))
    repeats = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    copied = one.join(hot, key, "left").withColumn("_part", F.explode(repeats))
    return dealt.drop("_parts").join(copied.drop("_parts"), [*key, "_part"], how).drop("_part")
