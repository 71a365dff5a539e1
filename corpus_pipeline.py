"""A corpus from raw documents: identify languages, keep one of each near copy, drop benchmark leaks, mix, shard.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result as Parquet to the shared folder and
reads it again for the next. Languages are learned from the documents that a stage gets, benchmark items come from `sf_dir`.
All stages but the last return the columns of the documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.llm import decontaminate, jaccard, langid, mixing, shard_tree
from plantlake.llm.common import stored, table

#: Learned models and edit distances have no SQL form.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; null texts, texts without letters and unsure ones go."""
    return langid.accepted(docs, langid.train(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one with the smallest id; rows without an id stay.

    Of rows that repeat an id only one stays, the one with the smallest hash of its text.
    """
    groups = jaccard.grouped(docs).where("doc_id IS NOT NULL").groupBy("doc_id")
    marks = groups.agg(F.count("*").alias("_rows"), F.max(F.expr("doc_id <> component_id")).alias("_copy"))
    marks = marks.where("_rows > 1 OR _copy").withColumnRenamed("doc_id", "_id")
    marks = stored(marks, "marks")
    kept = docs.join(marks, docs["doc_id"] == F.col("_id"), "left").where("_copy IS NULL").select(*docs.columns)
    many = marks.where("NOT _copy").select("_id")
    if many.isEmpty():
        return kept
    repeated = docs.join(many, docs["doc_id"] == F.col("_id")).select("_id", F.struct(*docs.columns).alias("_row"))
    first = repeated.groupBy("_id").agg(F.min_by("_row", F.xxhash64("_row.text")).alias("_row"))
    return kept.unionByName(first.select("_row.*"))


def no_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.drawn(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their region, rack and shard, and the shard they have after one more is added."""
    placed = shard_tree.place(docs, shard_tree.tree(), F.col("doc_id"))
    larger = shard_tree.grown(shard_tree.tree())
    return shard_tree.place(placed, larger, F.col("doc_id"), "grown_").drop("grown_region", "grown_rack")


STAGES = [
    ("language", language),
    ("near_copies", near_copies),
    ("no_leaks", no_leaks),
    ("mix", mix),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of `sf_dir`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
