"""Hierarchies by doubled walks, names by an index of their characters, and joins on frequent keys."""

import random
import re
import time
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from plantlake.operators import graph, ontology
from plantlake.operators.contains import containing
from plantlake.operators.spread import spread_join

EDGES = "parent STRING, child STRING"


def frame(spark, pairs):
    return spark.createDataFrame(list(pairs), EDGES)


def test_a_chain_of_20000_levels(spark):
    names = [f"n{k}" for k in range(20_001)]
    edges = frame(spark, pairwise(names)).repartition(4)
    assert sum(1 for _ in graph.jumps(edges)) <= 15
    started = time.time()
    found = graph.ancestry(edges)
    assert found.count() == 20_001
    assert found.where("root <> 'n0' OR node <> concat('n', depth) OR parent <> concat('n', depth - 1)").count() == 0
    assert time.time() - started < 120


def test_inherited_members_of_a_chain_of_10000_types(spark):
    """Few names over many levels: the nearest definition wins, and no table of all pairs is made."""
    names = [f"t{k:05}" for k in range(10_001)]
    edges = frame(spark, pairwise(names)).repartition(4)
    own = [(names[k], f"m{k % 3}", str(k)) for k in range(0, 10_001, 1000)]
    members = spark.createDataFrame(own, "id STRING, name STRING, schema STRING")
    found = ontology.inherited_members(members, edges.select("child", "parent"))
    rows = {(r["id"], r["name"]): (r["distance"], r["defined_in"], r["schema"]) for r in found.collect()}
    want = {}
    for k, name in enumerate(names):
        for at in range(0, k + 1, 1000):
            want[name, f"m{at % 3}"] = (k - at, names[at], str(at))
    assert rows == want


@pytest.mark.parametrize("seed", range(3))
def test_inherited_members_equal_those_by_all_ancestors(spark, seed):
    """Several parents, cycles, repeated and null names."""
    draw = random.Random(seed)
    pairs = {(f"t{draw.randrange(14)}", f"t{draw.randrange(14)}") for _ in range(16 + 4 * seed)}
    edges = frame(spark, pairs)
    own = [(f"t{draw.randrange(14)}", draw.choice(["a", "b", "c", None]), draw.choice("xy")) for _ in range(18)]
    members = spark.createDataFrame(own, "id STRING, name STRING, schema STRING")
    got = ontology.inherited_members(members, edges)
    want = ontology.effective_members(members, graph.closure(edges)).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("seed", range(3))
def test_paths_of_any_graph(spark, seed):
    draw = random.Random(seed)
    pairs = {(f"n{draw.randrange(9)}", f"n{draw.randrange(9)}") for _ in range(8 + 3 * seed)}
    children = {c for _, c in pairs}
    want, todo = [], [(p,) for p in {p for p, _ in pairs} - children]
    while todo:
        path = todo.pop()
        want.append((path[-1], len(path) - 1, "/".join(path)))
        todo += [(*path, c) for p, c in pairs if p == path[-1] and c not in path]
    got = graph.hierarchy_paths(frame(spark, pairs)).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_forests_and_wanted_paths(spark):
    """Random forests with a cycle beside them, which no root leads to."""
    draw = random.Random(1)
    parent = {k: draw.randrange(k) for k in range(3, 200)}
    pairs = [(f"n{p}", f"n{k}") for k, p in parent.items()] + [("c1", "c2"), ("c2", "c1"), ("c2", "c3")]
    edges = frame(spark, pairs)

    def path(k):
        return [k] if k not in parent else [*path(parent[k]), k]

    inner = {k for k in range(200) if k in parent or k in parent.values()}
    rows = {r["node"]: (r["parent"], r["root"], r["depth"]) for r in graph.ancestry(edges).collect()}
    assert rows == {
        f"n{k}": (f"n{parent[k]}" if k in parent else None, f"n{path(k)[0]}", len(path(k)) - 1) for k in inner
    }
    wanted = spark.createDataFrame([(f"n{k}",) for k in (0, 57, 199)], "node STRING")
    got = {r["node"]: r["path"] for r in graph.path_texts(wanted, edges).collect()}
    assert got == {f"n{k}": "/".join(f"n{x}" for x in path(k)) for k in (0, 57, 199)}


PATTERNS = ["assembly", "as%ly", "a_s", "%", "", "_", "ly.l", "x\\_y", "é", "MUNICH", "zzz", "ab", "l%l%l", None]


@pytest.mark.parametrize("how", ["like", "contains_ci", "literal"])
def test_names_by_index_equal_names_by_trying_all(spark, how):
    draw = random.Random(2)
    names = ["assembly.line1.munich", "x_y", "xay", "", "é", "Ab", "as%ly", "%", "_", None, "munich"]
    names += ["".join(draw.choices("aslyné._%", k=draw.randint(1, 12))) for _ in range(200)]
    texts, patterns = (spark.createDataFrame([(v,) for v in values], "v STRING") for values in (names, PATTERNS))
    got = containing(texts.withColumnRenamed("v", "name"), "name", patterns.withColumnRenamed("v", "pattern"), "pattern", how)

    def inside(name, pattern):
        if how == "literal":
            return pattern in name
        if how == "contains_ci":
            return pattern.lower() in name.lower()
        parts = re.findall(r"\\.|.", pattern, re.S)
        plain = "".join({"%": ".*", "_": "."}.get(p, re.escape(p[-1])) for p in parts)
        return re.fullmatch(f".*{plain}.*", name, re.S) is not None

    want = {(n, p) for n in names for p in PATTERNS if n is not None and p is not None and inside(n, p)}
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_frequent_keys_are_dealt_and_nothing_is_lost(spark, how):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("5", 3), (None, 4), ("none", 5)], "k STRING, v INT")
    want = rows.join(lookup, "k", how)
    for most in (0, 100):
        got = spread_join(rows, lookup, ["k"], how, most)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
