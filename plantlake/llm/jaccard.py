"""N-gram Jaccard join by pigeonhole over a partition of the universe of shingles.

Two sets of sizes r <= s with Jaccard similarity of 3/4 differ in at most (r + s) / 7 <= r / 3 shingles. For each band of sizes
the shingles are hashed into m segments. Budgets of 1 (the segment is equal) and 2 (it differs by one shingle at most) are
handed to the segments of the smaller set; if they add up to more than r / 3, one of them must hold. The larger set indexes
each segment and, for every fourth segment, its one-deletion neighbourhood, in its own band and the one below. The smaller
set looks up what its allocation asks for. The allocation takes the cheapest units: an empty segment costs most, a segment
whose shingles all are frequent costs their frequency, and a second unit costs its extra look-ups.

Before that, sets without any chance are left out by the same argument with one part of the universe: a set of which more
than a quarter of its shingles stand in no other document cannot be linked.

Documents with equal sets are one node. Looked-up segments make buckets; bucket members are first compared with the least
and the largest member, which joins up nearly all of a group in as many comparisons as it has members, and after that all
pairs of a bucket that are not yet in one component. Every link found is verified on the whole sets.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantlake.llm import components, words
from plantlake.llm.common import stored

#: Similarity as a fraction, and words of a shingle.
OVER, UNDER = 3, 4
WIDTH = 5
#: Part of the universe in which shingles are counted.
COUNTED = 0.375
BAND_STEP = 1.5
#: One segment in so many indexes its one-deletion neighbourhood.
EVERY = 4
FREQUENT_IN_BATCH = 8
#: Bound of the table of frequent shingles. It steers costs only; results do not depend on it.
FREQUENT_ROWS = 100_000
SEARCH_TEXTS = 512

INDEX, PROBE = 1, 2
#: Words of 64 bits in the parity sketch of a set.
SKETCH = 16


def bands(largest: int) -> np.ndarray:
    """Smallest size of each band, up to the band after `largest`."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, int(np.ceil(out[-1] * BAND_STEP))))
    return np.array(out, np.int64)


BANDS = bands(1 << 40)


def budget(size: int) -> int:
    """Most shingles in which a set of this size and a linked one of at least this size can differ."""
    return size * (UNDER - OVER) // OVER


def highest(band: int) -> int:
    """Largest set that can be linked to a set of this band."""
    return int(BANDS[band + 1] - 1) * UNDER // OVER


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are at least 3/4 similar."""
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if not small or UNDER * small < OVER * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return UNDER * both >= OVER * (len(a) + len(b) - both)


class Segments:
    """One set, cut into the segments of one band."""

    def __init__(self, tokens: np.ndarray, band: int):
        self.m = budget(int(BANDS[band + 1] - 1)) + 1
        scrambled = words.mix(tokens + np.uint64(band))
        place = (scrambled % np.uint64(self.m)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        self.tokens, self.place, self.hashed = tokens[order], place[order], words.mix(scrambled[order])
        self.sizes = np.bincount(place, minlength=self.m)
        self.begins = np.cumsum(self.sizes) - self.sizes
        with np.errstate(over="ignore"):
            total = np.r_[np.uint64(0), np.cumsum(self.hashed)]
            self.sums = total[self.begins + self.sizes] - total[self.begins]
            self.names = words.mix(np.arange(self.m, dtype=np.uint64) + np.uint64((band + 1) << 40))
        self.open = np.arange(self.m) % EVERY == 0

    def equal(self, chosen: np.ndarray) -> np.ndarray:
        """Signatures of whole segments."""
        with np.errstate(over="ignore"):
            return words.mix(self.sums[chosen] + self.names[chosen])

    def shorter(self, chosen: np.ndarray) -> np.ndarray:
        """Signatures of the segments without one of their shingles, for each shingle."""
        at = chosen[self.place]
        with np.errstate(over="ignore"):
            return words.mix(self.sums[self.place[at]] - self.hashed[at] + self.names[self.place[at]])


def deletion(signatures: np.ndarray) -> np.ndarray:
    """Signatures in a space of their own: what a set has after a deletion meets whole segments only."""
    return words.mix(signatures ^ np.uint64(0xD1B54A32D192ED03))


def indexed(tokens: np.ndarray, band: int) -> np.ndarray:
    """What a set can be found by in a band: whole segments, and the deletions of the open ones."""
    cut = Segments(tokens, band)
    return np.concatenate([cut.equal(np.ones(cut.m, dtype=bool)), deletion(cut.shorter(cut.open))])


def allocate(cut: Segments, units: int, frequency: np.ndarray) -> np.ndarray:
    """Budget of each segment, `units` in all, at the least cost.

    `frequency` estimates in how many sets each shingle of the cut stands. The rarest one of a segment bounds what the
    segment can meet.
    """
    never = 1e12
    rare = np.full(cut.m, never)
    np.minimum.at(rare, cut.place, frequency)
    first = rare.copy()
    second_least = np.full(cut.m, never)
    is_rarest = frequency <= rare[cut.place]
    np.minimum.at(second_least, cut.place[~is_rarest], frequency[~is_rarest])
    count_rarest = np.bincount(cut.place[is_rarest], minlength=cut.m)
    without = np.where(count_rarest > 1, rare, second_least)
    second = np.where(cut.open, (cut.sizes + 1) * np.minimum(np.maximum(first, without), never), np.inf)
    second = np.maximum(second, first)
    costs = np.r_[first, second]
    order = np.argsort(costs, kind="stable")[:units]
    return np.bincount(order % cut.m, minlength=cut.m)


def probes(tokens: np.ndarray, band: int, frequency: np.ndarray) -> np.ndarray:
    """What a set looks up in its own band."""
    cut = Segments(tokens, band)
    share = allocate(cut, budget(len(tokens)) + 1, frequency[_order(cut, tokens)])
    two = share == 2
    whole = cut.equal(share > 0)
    return np.concatenate([whole, deletion(cut.equal(two)), cut.shorter(two)])


def _order(cut: Segments, tokens: np.ndarray) -> np.ndarray:
    return np.searchsorted(tokens, cut.tokens)


def entries(tokens: np.ndarray, known: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of one set, each once, and what it is there for: `INDEX`, `PROBE` or both."""
    size = len(tokens)
    home = int(np.searchsorted(BANDS, size, side="right")) - 1
    at = np.minimum(np.searchsorted(known, tokens), max(len(known) - 1, 0))
    frequency = np.ones(size)
    if len(known):
        frequency = np.where(known[at] == tokens, counts[at], 1.0)
    index = [indexed(tokens, home)]
    if home and size <= highest(home - 1):
        index.append(indexed(tokens, home - 1))
    found = np.concatenate([*index, asked := probes(tokens, home, frequency)])
    roles = np.r_[np.full(len(found) - len(asked), INDEX), np.full(len(asked), PROBE)]
    signatures, inverse = np.unique(found, return_inverse=True)
    role = np.zeros(len(signatures), np.int64)
    np.bitwise_or.at(role, inverse, roles)
    return signatures, role


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _set(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint64)


def _parts(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    for first in range(0, batch.num_rows, most):
        yield batch.slice(first, most)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, doc_id) for each shingle in the counted part of the universe."""
    bound = np.uint64(int(COUNTED * 2**64))
    for batch in batches:
        for part in _parts(batch, SEARCH_TEXTS):
            ids = part.column(0).to_numpy(zero_copy_only=False)
            sets = [s[: np.searchsorted(s, bound)] for s in words.shingle_sets(*words.flat(part.column(1)), WIDTH)]
            sizes = [len(s) for s in sets]
            columns = [_signed(np.concatenate(sets)), pa.array(np.repeat(ids, sizes))]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "doc_id"])


PROFILE = "doc_id long, n_shingles long, print_a long, print_b long, shingles binary"


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and fingerprint of each set; the set itself where it can be linked."""
    for batch in batches:
        for part in _parts(batch, SEARCH_TEXTS):
            ids = part.column(0)
            sets = words.shingle_sets(*words.flat(part.column(1)), WIDTH)
            own = part.column(2).fill_null(0).to_pylist()
            sizes = np.array([len(s) for s in sets], np.int64)
            possible = [
                s.tobytes() if i is not None and len(s) and UNDER * u <= (UNDER - OVER) * len(s) else None
                for s, i, u in zip(sets, ids.to_pylist(), own, strict=True)
            ]
            prints = [np.array([words.mix(s ^ np.uint64(k)).sum() for s in sets], np.uint64) for k in (1, 2)]
            columns = [ids, pa.array(sizes), *map(_signed, prints), pa.array(possible, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in PROFILE.split(", ")])


def profiles(df: DataFrame) -> DataFrame:
    """One row for each row of `df` (doc_id, text); `shingles` is null where the row certainly has no link."""
    rows = df.select(df["doc_id"].cast("long").alias("doc_id"), df["text"].alias("text"))
    several = rows.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("x"), F.max(F.xxhash64("text")).alias("y"))
    several = several.where("x <> y").select("doc_id")
    tokens = rows.where("doc_id IS NOT NULL").mapInArrow(_counted, "token long, doc_id long").repartition("token")
    alone = tokens.groupBy("token").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("other"))
    alone = alone.where("doc_id = other").groupBy("doc_id").agg(F.count("*").alias("own"))
    alone = stored(alone.join(several, "doc_id", "left_anti"), "own-shingles")
    # A shuffle at every size: the counts grow with the documents, and texts need not be sorted for a hash join.
    counted = rows.join(alone.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "own")
    return stored(counted.mapInArrow(_profiles, PROFILE), "sets")


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tokens = np.concatenate([_set(v) for v in batch.column(1).to_pylist()])
        tokens, counts = np.unique(tokens, return_counts=True)
        often = counts >= FREQUENT_IN_BATCH
        yield pa.RecordBatch.from_arrays([_signed(tokens[often]), pa.array(counts[often])], names=["token", "n"])


def frequent(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles and their counts; a bounded table that the allocation's costs come from."""
    rows = nodes.mapInArrow(_frequent, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    top = rows.orderBy(F.desc("n"), "token").limit(FREQUENT_ROWS).toArrow()
    tokens = top.column(0).to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top.column(1).to_numpy()[order]


def buckets(nodes: DataFrame) -> DataFrame:
    """signature, node, role, low, high of the entries that share their signature with another node."""
    shared = nodes.sparkSession.sparkContext.broadcast(frequent(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        for batch in batches:
            for part in _parts(batch, SEARCH_TEXTS):
                found = [entries(_set(v), known, counts) for v in part.column(1).to_pylist()]
                sizes = [len(s) for s, _ in found]
                ids = np.repeat(part.column(0).to_numpy(), sizes)
                roles = np.concatenate([r for _, r in found]).astype(np.int8)
                columns = [_signed(np.concatenate([s for s, _ in found])), pa.array(ids), pa.array(roles)]
                yield pa.RecordBatch.from_arrays(columns, names=["signature", "node", "role"])

    rows = nodes.mapInArrow(run, "signature long, node long, role byte").repartition("signature")
    met = rows.groupBy("signature").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.bit_or("role").alias("roles")
    )
    met = met.where(f"low <> high AND roles = {INDEX | PROBE}").drop("roles")
    return stored(rows.join(met, "signature"), "buckets")


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        yes = pa.array([linked(_set(x), _set(y)) for x, y in pairs], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(yes)


def verified(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    left = nodes.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = nodes.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return full.mapInArrow(_check, "a long, b long").distinct()


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and parity sketch of each set: a bit tells whether an odd number of its shingles fall on it."""
    for batch in batches:
        sets = [_set(v) for v in batch.column(1).to_pylist()]
        rows = [np.bincount((words.mix(s) % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) for s in sets]
        bits = np.packbits(np.array(rows, np.uint8) & 1, axis=1).view(np.int64)
        columns = [batch.column(0), pa.array([len(s) for s in sets], pa.int64())]
        columns += [pa.array(np.ascontiguousarray(bits[:, k])) for k in range(SKETCH)]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "n", *(f"s{k}" for k in range(SKETCH))])


def sketches(nodes: DataFrame) -> DataFrame:
    schema = ", ".join(["node long", "n long", *(f"s{k} long" for k in range(SKETCH))])
    return stored(nodes.mapInArrow(_sketched, schema), "sketches")


def _may_link(a: str, b: str) -> str:
    """SQL: sizes fit, and the sketches differ in no more bits than linked sets of these sizes can.

    Two sets differ in at least as many shingles as their sketches in bits, so no link is lost.
    """
    differ = " + ".join(f"bit_count({a}.s{k} ^ {b}.s{k})" for k in range(SKETCH))
    sizes = f"{UNDER} * least({a}.n, {b}.n) >= {OVER} * greatest({a}.n, {b}.n)"
    return f"{sizes} AND {UNDER + OVER} * ({differ}) <= {UNDER - OVER} * ({a}.n + {b}.n)"


def _sorted_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _possible(pairs: DataFrame, drawn: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches allow a link; the sets themselves are not read."""
    joined = pairs.join(drawn.alias("x"), F.expr("a = x.node")).join(drawn.alias("y"), F.expr("b = y.node"))
    return joined.where(_may_link("x", "y")).select("a", "b")


def _across(met: DataFrame, drawn: DataFrame) -> DataFrame:
    """Pairs of a bucket, one looking up and one indexed, whose labels differ and whose sketches allow a link."""
    # Dealt by signature once, for both roles.
    sides = met.select("signature", "node", "role", "label").join(drawn, "node").repartition("signature")
    asks = sides.where(F.col("role").bitwiseAND(F.lit(PROBE)) > 0).alias("x")
    has = sides.where(F.col("role").bitwiseAND(F.lit(INDEX)) > 0).alias("y")
    both = asks.join(has, F.expr(f"x.signature = y.signature AND x.label <> y.label AND {_may_link('x', 'y')}"))
    return _sorted_pairs(both.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))


def _nodes(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, shingles) of the distinct sets that can be linked, and (print_a, print_b, node) of each of them."""
    possible = sets.where("shingles IS NOT NULL")
    named = possible.groupBy("print_a", "print_b").agg(F.min("doc_id").alias("node"))
    same = ["print_a", "print_b"]
    nodes = possible.withColumnRenamed("doc_id", "node").join(named, [*same, "node"]).select(*same, "node", "shingles")
    return stored(nodes.dropDuplicates([*same, "node"]).select("node", "shingles"), "nodes"), named


def links(df: DataFrame) -> DataFrame:
    """All links (a, b), a < b, between documents with different sets, each set named by its smallest doc_id."""
    nodes, _ = _nodes(profiles(df))
    met = buckets(nodes).withColumn("label", F.col("node"))
    return verified(_across(met, sketches(nodes)), nodes)


def grouped(df: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of each row of `df` (doc_id, text).

    Texts without words have no shingles and no links: they are their own component. Equal sets are linked. Rows that
    repeat an id are one document: its texts' links are all its links, and every row is returned. A row without an id has
    its size but no component. An empty table gives no rows; other columns are not read.
    """
    sets = profiles(df)
    nodes, named = _nodes(sets)
    met = buckets(nodes)
    stars = met.select(F.col("low").alias("a"), F.col("node").alias("b"))
    stars = stars.unionByName(met.select(F.col("node").alias("a"), F.col("high").alias("b")))
    drawn = sketches(nodes)
    found = stored(verified(_possible(_sorted_pairs(stars), drawn), nodes), "links")
    label = components.labels(found)
    # The least and the largest member of a bucket have been compared with all others.
    inner = met.where("node <> low AND node <> high").join(label, "node", "left")
    inner = inner.select("signature", "node", "role", F.coalesce("label", "node").alias("label"))
    bucket = Window.partitionBy("signature")
    mixed = inner.withColumns({"x": F.min("label").over(bucket), "y": F.max("label").over(bucket)}).where("x <> y")
    rest = stored(mixed.drop("x", "y"), "inner")
    rest = stored(verified(_across(rest, drawn), nodes), "links")
    member = sets.where("shingles IS NOT NULL").join(named, ["print_a", "print_b"]).select("doc_id", "node")
    again = member.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    label = components.labels(found.unionByName(rest).unionByName(again.select("a", "b")))
    own = member.groupBy("doc_id").agg(F.min("node").alias("node")).join(label, "node", "left")
    own = own.select("doc_id", F.coalesce("label", "node").alias("component_id"))
    alone = sets.where("shingles IS NULL").select("doc_id", "n_shingles")
    rows = sets.where("shingles IS NOT NULL").select("doc_id", "n_shingles").join(own, "doc_id")
    several = own.join(alone.select("doc_id").distinct(), "doc_id").withColumnRenamed("component_id", "_c")
    alone = alone.join(several, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("_c", "doc_id").alias("component_id"))
    return rows.unionByName(alone)
