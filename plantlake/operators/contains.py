"""Which of many texts contain which of many patterns, by an inverted index of their pieces."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.functions.text import matches

#: Lengths of the pieces that texts are indexed by, of those the ones that patterns ask for.
SIZES = (1, 2, 4, 8, 16)
#: What stands between the literal parts of a LIKE pattern: wildcards and escaped characters.
BETWEEN = r"\\.|[%_]"


def _pieces(text: Column, size: Column) -> Column:
    """All pieces of a text of one size; of size 0 the empty one."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda start: F.substring(text, start, size))


def _key(parts: Column) -> Column:
    """The end of the longest literal part, of the largest size that it has; empty if there is none."""
    longest = F.array_max(F.transform(parts, lambda part: F.struct(F.length(part).alias("n"), part.alias("part"))))["part"]
    size = F.lit(0)
    for at in SIZES:
        size = F.when(F.length(longest) >= at, F.lit(at)).otherwise(size)
    return F.when(size > 0, F.right(longest, size)).otherwise(F.lit(""))


def containing(texts: DataFrame, text: str, patterns: DataFrame, pattern: str, how: str = "like") -> DataFrame:
    """Distinct (text, pattern) of the texts that a pattern matches anywhere, as `matches` has it.

    A pattern is looked up by the end of its longest literal part, up to 16 characters, where names that are numbered
    differ. Texts are indexed by all their pieces of the sizes that patterns ask for, and only what meets there is matched. A
    pattern without a literal character meets every text.
    """
    fold = F.lower if how == "contains_ci" else (lambda c: c)
    held = texts.select(F.col(text).alias("_text")).where("_text IS NOT NULL").distinct()
    parts = F.split("_pattern", BETWEEN) if how == "like" else F.array(fold(F.col("_pattern")))
    wanted = patterns.select(F.col(pattern).alias("_pattern")).where("_pattern IS NOT NULL").distinct()
    wanted = wanted.withColumn("_key", _key(parts))
    sizes = wanted.agg(F.collect_set(F.length("_key"))).scalar()
    whole = fold(F.col("_text"))
    keys = F.array_distinct(F.flatten(F.transform("_sizes", lambda size: _pieces(whole, size))))
    met = held.withColumn("_sizes", sizes).select("_text", F.explode(keys).alias("_key")).join(wanted, "_key")
    met = met.where(matches(F.col("_text"), F.col("_pattern"), how))
    return met.select(F.col("_text").alias(text), F.col("_pattern").alias(pattern))
