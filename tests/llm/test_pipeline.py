"""The pipeline's stages: what each keeps, its columns, and edge cases."""

from collections import Counter

import corpus_pipeline as pipeline
import pytest

from plantlake.llm import decontaminate, jaccard, queries
from plantlake.llm.common import stored

FOLDER = "/root/testdata/sf0.001"


def test_stages_by_plain_rules(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    languages = pipeline.language(spark, docs, FOLDER)
    assert languages.columns == docs.columns and languages.count() >= 0.99 * docs.count()
    languages = stored(languages, "t")
    single = stored(pipeline.near_copies(spark, languages, FOLDER), "t")
    groups = {r["doc_id"]: r["component_id"] for r in jaccard.grouped(languages).collect()}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(set(groups.values()))
    clean = stored(pipeline.no_leaks(spark, single, FOLDER), "t")
    found = {r["doc_id"] for r in decontaminate.leaks(single, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
    assert {r["doc_id"] for r in single.collect()} - found == {r["doc_id"] for r in clean.collect()}
    mixed = stored(pipeline.mix(spark, clean, FOLDER), "t")
    assert mixed.columns == docs.columns
    assert max(Counter(r["doc_id"] for r in mixed.collect()).values()) <= 3
    last = pipeline.shard(spark, mixed, FOLDER)
    assert last.columns[:5] == docs.columns and last.count() == mixed.count()


def test_pipeline_runs_again_alike(spark):
    first, second = (pipeline.run(spark, FOLDER).collect() for _ in range(2))
    assert Counter(map(tuple, first)) == Counter(map(tuple, second)) and first


@pytest.mark.parametrize("name", ["edges", "nothing"])
def test_stages_take_any_rows(request, spark, name):
    docs = request.getfixturevalue(name)
    for stage, function in pipeline.STAGES:
        out = function(spark, docs, FOLDER)
        kept = out.count()
        assert set(docs.columns) <= set(out.columns), stage
        if stage == "near_copies" and name == "edges":
            assert kept == docs.where("doc_id IS NULL").count() + len({0, 1, 2, 3, 5, 7, 9, 10, 11, 12, 13, 14})


def test_queries_are_named_by_number():
    assert [int(name.split("_")[0][2:]) for name in queries.QUERIES] == list(range(1, len(queries.QUERIES) + 1))
