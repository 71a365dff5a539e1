"""The operators as registered queries over the given tables, and the SQL that some of them agree with."""

from pyspark.sql import DataFrame, SparkSession

from plantlake.llm import (
    alignment,
    bpe_count,
    chat,
    compression,
    decontaminate,
    jaccard,
    langid,
    minhash,
    mixing,
    orc_ids,
    repair,
    shard_tree,
    toxicity,
)
from plantlake.llm.common import table
from plantlake.session import scratch

VOCABULARY = "byte_bpe_50k.json"
OTHER_VOCABULARY = "piece_bpe_32k.model"


def vocabulary(name: str = VOCABULARY) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_shard_tree(spark: SparkSession, folder: str) -> DataFrame:
    """All documents on 40 shards of a weighted hash tree."""
    return shard_tree.sharded(table(spark, folder, "documents"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents."""
    return bpe_count.token_counts(table(spark, folder, "documents"), vocabulary())


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of all documents."""
    documents = table(spark, folder, "documents")
    return langid.identified(documents, langid.train(documents))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mixed(table(spark, folder, "documents"))


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items found in documents."""
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op6_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """All messages in reply order without quotes."""
    return chat.formatted(table(spark, folder, "conversations"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of all documents."""
    documents = table(spark, folder, "documents")
    return toxicity.scored(documents, toxicity.train(documents, table(spark, folder, "labels")))


def op8_compression(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts and compression verdict of all documents."""
    return compression.judged(table(spark, folder, "documents"))


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near copies among all documents."""
    return jaccard.grouped(table(spark, folder, "documents"))


def op10_orc_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The token ids of all documents, written as ORC and read back."""
    path = scratch(spark, "token-ids")
    orc_ids.write(table(spark, folder, "documents"), vocabulary(), path)
    return orc_ids.contents(spark, path)


def op11_circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Components of near copies at 0.85 among all documents, and the document that each keeps."""
    return minhash.grouped(table(spark, folder, "documents"))


def op12_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults and the cheapest repair of all conversations, after damage."""
    return repair.conversations(table(spark, folder, "conversations"))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """How the tokens of two vocabularies meet in all documents, and how common their id pairs are."""
    return alignment.aligned(table(spark, folder, "documents"), vocabulary(), vocabulary(OTHER_VOCABULARY))


QUERIES = {
    f.__name__: f
    for f in (
        op1_shard_tree,
        op2_token_counts,
        op3_language,
        op4_mixing,
        op5_decontamination,
        op6_conversations,
        op7_toxicity,
        op8_compression,
        op9_jaccard,
        op10_orc_ids,
        op11_circulant_minhash,
        op12_repair,
        op13_alignment,
    )
}

#: Shingle sets, pairs that share a shingle, links, and the smallest id within reach.
JACCARD_SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM worded),
sized AS (SELECT doc_id, len(s) AS n, s FROM sets),
tokens AS (SELECT doc_id, n, unnest(s) AS t FROM sized),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS n_both
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * n_both >= 75 * (na + nb - n_both)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM sides UNION SELECT reach.a, sides.b FROM reach JOIN sides ON reach.b = sides.a)
SELECT sized.doc_id, CAST(n AS BIGINT) AS n_shingles, least(sized.doc_id, coalesce(min(reach.b), sized.doc_id)) AS component_id
FROM sized LEFT JOIN reach ON reach.a = sized.doc_id GROUP BY sized.doc_id, n
"""

#: The same at 0.85, with the kept document of each component.
MINHASH_SQL = f"SELECT *, doc_id = component_id AS kept FROM ({JACCARD_SQL.replace('>= 75 *', '>= 85 *')})"

ORACLES = {"op9_jaccard": JACCARD_SQL, "op11_circulant_minhash": MINHASH_SQL}
