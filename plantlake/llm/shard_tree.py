"""Sharding by a weighted hash tree: a row descends from regions to racks to shards by weighted hash draws.

At each node every child draws -ln(u) / weight, where u is a hash of the row's key and the child's name; the smallest draw
wins. A child's weight is the sum of the shard weights below it. Each child draws for itself, so a changed weight moves rows
only into or out of the child whose weight changed, at its level, and the rows of all other subtrees stay. `grown` adds a
shard as a region of its own: it then takes rows only into itself.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.llm.common import running, spread

Topology = list[list[list[float]]]


def tree(regions: int = 4, racks: int = 2, shards: int = 5, weight: float = 1.0) -> Topology:
    """Equal shards: `regions` times `racks` times `shards` of them."""
    return [[[weight] * shards for _ in range(racks)] for _ in range(regions)]


def grown(topology: Topology, weight: float = 1.0) -> Topology:
    """The tree with one more shard, in a region and rack of its own; it gets the next number."""
    return [*topology, [[weight]]]


def _draw(key: Column, name: str, weight: float) -> Column:
    """An exponential draw of rate `weight`; never chosen if the weight is not positive."""
    if weight <= 0:
        return F.lit(float("inf"))
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.ln(uniform) / weight


def _chosen(key: Column, prefix: str, weights: list[float]) -> Column:
    """Number of the child with the smallest draw; the first of equal ones."""
    if len(weights) == 1:
        return F.lit(0)
    draws = [F.struct(_draw(key, f"{prefix}/{k}", w).alias("d"), F.lit(k).alias("k")) for k, w in enumerate(weights)]
    return F.least(*draws)["k"]


def _branch(chosen: Column, options: list[Column]) -> Column:
    out = F.when(chosen == 0, options[0])
    for k, option in enumerate(options[1:], 1):
        out = out.when(chosen == k, option)
    return out


def place(df: DataFrame, topology: Topology, key: Column, prefix: str = "") -> DataFrame:
    """Adds `{prefix}region`, `{prefix}rack` (within the region) and `{prefix}shard` (over all), all int. A narrow step.

    The key and the topology alone decide; rows with equal keys, or a null key, go to the same shard.
    """
    names = [f"{prefix}{n}" for n in ("region", "rack", "shard")]
    df = df.withColumn("_key", key)
    key = F.col("_key")
    df = df.withColumn(names[0], _chosen(key, "", [sum(map(sum, region)) for region in topology]))
    racks = [_chosen(key, f"/{r}", [sum(rack) for rack in region]) for r, region in enumerate(topology)]
    df = df.withColumn(names[1], _branch(F.col(names[0]), racks))
    first, shards = 0, []
    for r, region in enumerate(topology):
        inside = []
        for k, rack in enumerate(region):
            inside.append(_chosen(key, f"/{r}/{k}", rack) + first)
            first += len(rack)
        shards.append(_branch(F.col(names[1]), inside))
    df = df.withColumn(names[2], _branch(F.col(names[0]), shards))
    return df.withColumns({n: F.col(n).cast("int") for n in names}).drop("_key")


def numbered(df: DataFrame, shard: str = "shard", order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Adds `slot`, 0, 1, ... within each shard, by hash range of `order`, then `order`. No shard is held by one task."""
    df = df.withColumn("_range", spread(*order))
    return running(df, [shard], "_range", list(order), F.lit(1).cast("long"), "slot").drop("_range")


def sharded(df: DataFrame, topology: Topology | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, region and rack of each row of `df` (doc_id, text).

    A null text counts as empty: size 16, checksum 0. Null ids share one shard. Repeated rows each get a slot of their
    own; rows of equal id stand by their checksum. An empty table gives no rows, and other columns are not read.
    """
    topology = topology or tree()
    rows = df.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = place(rows, topology, F.col("doc_id"))
    rows = place(rows, grown(topology), F.col("doc_id"), "grown_").drop("grown_region", "grown_rack")
    rows = numbered(rows, "shard", ("doc_id", "text_crc32"))
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "region", "rack")
