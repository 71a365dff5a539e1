"""Joins whose keys may be few: rows of a frequent key are dealt over several tasks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is frequent if it has more than one in so many rows; it is dealt over as many parts as it has such shares.
SHARES = 200


#: Rows up to which a lookup counts as small.
SMALL = 50_000


def is_small(lookup: DataFrame, most: int = SMALL) -> bool:
    """Whether a lookup has at most `most` rows; no more than these are counted, now."""
    return lookup.limit(most + 1).count() <= most


def small(lookup: DataFrame, most: int = SMALL) -> DataFrame:
    """A narrow lookup marked for broadcast if it is small; else itself, joined plainly.

    For lookups that are themselves joins, whose size Spark would overestimate and shuffle the other side for.
    """
    return F.broadcast(lookup) if is_small(lookup, most) else lookup


def spread_join(rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left", most: int = SMALL, shares: int = SHARES) -> DataFrame:
    """`rows` joined with `lookup`, the smaller side, on columns of the same names.

    A small lookup is broadcast, so no row of the other side moves. Beyond that rows are counted per key first, which
    reads the key columns alone. A row of a frequent key goes to one of the key's
    parts by the hash of its values, so a task that is run again deals alike, and the lookup rows of such a key are
    repeated in each part. A key with a third of all rows is then the work of a third of `shares` tasks, whatever the size of
    the table, and other keys are joined plainly. The frequent keys, fewer than `shares`, are broadcast.
    """
    if is_small(lookup, most):
        return rows.join(F.broadcast(lookup), keys, how)
    plain = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    share = F.floor(F.col("_n") * shares / total).cast("int")
    frequent = F.broadcast(counts.select(*keys, share.alias("_parts")).where("_parts > 1"))
    part = F.coalesce(F.pmod(F.xxhash64(*plain), F.col("_parts")).cast("int"), F.lit(0))
    dealt = rows.join(frequent, keys, "left").withColumn("_part", part).drop("_parts")
    copies = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    copied = lookup.join(frequent, keys, "left").withColumn("_part", F.explode(copies)).drop("_parts")
    return dealt.join(copied, [*keys, "_part"], how).drop("_part")
