"""Mixing sources to target weights, in whole words, exactly to each source's budget.

Each document draws a hash-random key. Within a source the documents stand by key, dealt out over equal key ranges; prefix
sums of their words run inside the ranges and are carried from range to range. A source whose budget is above its size is
taken whole once or more, then the rest of the budget cuts the next pass at the exact word.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlake.llm import words
from plantlake.llm.common import running, spread, stored

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3


def _count(column: pa.Array) -> pa.Array:
    data, offsets = words.flat(column)
    counts = np.zeros(len(offsets) - 1, np.int64)
    for a, b in words.blocks(data, offsets):
        part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        _, _, text = words.spans(words.IS_WORD[part], cuts)
        counts[a:b] = np.bincount(text, minlength=b - a)
    return pa.array(counts, pa.int64())


def word_count(text: Column | str) -> Column:
    """Words between ASCII white space in a whole text; 0 for null."""
    return F.arrow_udf(_count, "long")(text)


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target of `sizes` (source, source_size): one row a source.

    Sources by code point, null last, take `weights` in turn and share the sum of all sizes by them; no target exceeds
    `most` times its source's size, and what is above is shared by weight among the others. That is one common level:
    sources are ordered by the level at which they fill up, and the first one not full at the level left to it sets it.
    """
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("_rank", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    turn = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("_weight", turn[(F.col("_rank") % len(weights)).cast("int")])
    ranked = ranked.withColumn("_cap", F.col("source_size") * float(most)).withColumn("_full", F.col("_cap") / F.col("_weight"))
    up = everything.orderBy("_full", "_rank")
    down = everything.orderBy(F.col("_full").desc(), F.col("_rank").desc())
    total = F.sum("source_size").over(everything).cast("double")
    full = F.coalesce(F.sum("_cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("_weight").over(down.rowsBetween(Window.unboundedPreceding, 0))
    ranked = ranked.withColumn("_level", (total - full) / open_weight)
    first = F.min_by("_level", F.when(F.col("_full") >= F.col("_level"), F.struct("_full", "_rank")))
    ranked = ranked.withColumn("_level", first.over(everything))
    target = F.least(F.col("_cap"), F.col("_level") * F.col("_weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def _sized(df: DataFrame, seed: int) -> DataFrame:
    return df.select("doc_id", "source", word_count("text").alias("size")).withColumn(
        "_key", F.xxhash64("doc_id", F.lit(seed))
    )


def _place(seed: int) -> Column:
    """What documents of a source stand by: range of the key, key, id."""
    key = F.xxhash64("doc_id", F.lit(seed))
    return F.struct(spread("doc_id", F.lit(seed)).alias("range"), key.alias("key"), F.col("doc_id").alias("id"))


def _budgets(sized: DataFrame) -> DataFrame:
    """One row a source: its target, how often it is taken whole, and the words left for the last pass."""
    goals = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    return goals.select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        epochs.alias("epochs"),
        (budget - epochs * F.col("source_size")).alias("rest"),
    )


def _placed(sized: DataFrame, seed: int) -> DataFrame:
    """`sized` with the words of its source that stand before each document."""
    ranged = sized.withColumn("_range", spread("doc_id", F.lit(seed)))
    return running(ranged, ["source"], "_range", ["_key", "doc_id", "size"], F.col("size"), "_earlier")


def mixed(df: DataFrame, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, epochs of each row of `df` (doc_id, text, source).

    `taken` counts the words the mix takes of the document, all passes together; the sum over a source is its target
    rounded to a word. A null source is a source; a null or empty text has size 0 and nothing is taken of it. Repeated
    rows are documents of their own. An empty table gives no rows.
    """
    sized = stored(_sized(df, seed), "sizes")
    goals = _budgets(sized)
    rows = _placed(sized, seed).join(goals, F.col("source").eqNullSafe(F.col("_source")))
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("_earlier")))
    taken = (F.col("epochs") * F.col("size") + last).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "epochs")


def drawn(df: DataFrame, seed: int = 17) -> DataFrame:
    """The rows of `df` as the mix takes them: whole documents, one row for each time a document is taken.

    The document at which a source's budget is cut is taken if at least half of it fits, so each source is within one
    document of its target. Only one row a source is joined to the documents; texts are not shuffled.
    Documents without words are kept once.
    """
    sized = stored(_sized(df, seed), "sizes")
    goals = stored(_budgets(sized), "budgets")
    rows = _placed(sized, seed).join(goals, F.col("source").eqNullSafe(F.col("_source")))
    fits = (F.col("size") > 0) & (F.col("rest") > 0) & (F.col("_earlier") + F.col("size") / 2 <= F.col("rest"))
    cuts = rows.where(fits).groupBy("_source").agg(F.max(_place(seed)).alias("_cut"))
    cuts = cuts.withColumnRenamed("_source", "_cut_source")
    plan = goals.join(cuts, F.col("_source").eqNullSafe(F.col("_cut_source")), "left")
    plan = stored(plan.select("_source", F.col("epochs").alias("_epochs"), "_cut"), "cuts")
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    inside = F.coalesce(_place(seed) <= F.col("_cut"), F.lit(False))
    copies = F.when(wordless, 1).otherwise(F.col("_epochs") + inside.cast("long")).cast("int")
    joined = df.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_copies", copies)
    again = F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")
    return joined.where("_copies > 0").select(*df.columns, again).drop("_copy")
