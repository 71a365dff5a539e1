"""Unfolding of collections that are costly to compute."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unfold(df: DataFrame, collection: Column, item: str, *keep, pos: str | None = None) -> DataFrame:
    """`keep` columns with one row per non-null item of a collection.

    A plain explode makes the optimizer test its argument for emptiness below the columns that
    compute it, so that a document would be parsed for the test and again for the result. The outer
    form has no such test.
    """
    if pos is None:
        generated = F.explode_outer(collection).alias(item)
    else:
        generated = F.posexplode_outer(collection).alias(pos, item)
    return df.select(*keep, generated).where(F.col(item).isNotNull())
