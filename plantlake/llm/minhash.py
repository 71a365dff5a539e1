"""Circulant MinHash: near copies by signatures from two permutations, one of which is shifted around its universe.

The universe are the 2^32 cells that shingle hashes fall on. A first permutation scatters the cells of a set, which breaks
any structure they have; the second, shifted by k places around the universe, orders them for coordinate k of the signature:
the smallest place that a cell of the set has. So all coordinates come from one permutation, at distances of one cell.

Coordinates make bands of eight. Two sets of similarity s meet in a band with a chance of s^8, and in none of the bands with
a chance of (1 - s^8)^40: 3 in a million at 0.85, less above. Sets of one band meet in a bucket. Its members are compared with
the least and the largest of them, which joins up nearly all of a group in as many comparisons as it has members. What stays
apart in a bucket (texts of one template, say) is compared through its rarest shingles: of two linked sets, the rarest 15 %
of the one and of the other have one in common, in any order of rarity. That is exact, and members that share only what is
frequent never meet. Every link is verified on the full sets.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm import components, words
from plantlake.llm.common import slices, stored
from plantlake.llm.hot import split_join

#: Similarity as a fraction, and words of a shingle.
OVER, UNDER = 85, 100
WIDTH = 5
BANDS, ROWS = 40, 8
#: Fixed odd factors of the shifted permutation.
FIRST, SECOND = 0x9E3779B1, 0x85EBCA6B
#: Shingles that a pass over the shifts works on, so that they stay in a processor's cache.
PASS = 1 << 15
BATCH_BYTES = 4 << 20
#: Words of 64 bits in the parity sketch of a set.
SKETCH = 16


def scattered(tokens: np.ndarray) -> np.ndarray:
    """Cells of the universe after the first permutation, times the first factor of the second one."""
    cells = (words.mix(tokens) >> np.uint64(32)).astype(np.uint32)
    return cells * np.uint32(FIRST)


def shifted(cells: np.ndarray, by: int, out: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """Places of the cells in the second permutation, shifted by `by` cells around the universe."""
    # (cell + by) * FIRST, with the product of the cells at hand.
    np.add(cells, np.uint32(by * FIRST & 0xFFFFFFFF), out=out)
    np.right_shift(out, np.uint32(15), out=spare)
    np.bitwise_xor(out, spare, out=out)
    np.multiply(out, np.uint32(SECOND), out=out)
    np.right_shift(out, np.uint32(13), out=spare)
    return np.bitwise_xor(out, spare, out=out)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The coordinates of each set, one column a set; no set is empty."""
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    cells = scattered(np.concatenate(sets)) if sets else np.zeros(0, np.uint32)
    out = np.empty((BANDS * ROWS, len(sets)), np.uint32)
    first = 0
    while first < len(sets):
        begin = ends[first] - sizes[first]
        last = max(first + 1, int(np.searchsorted(ends, begin + PASS, side="right")))
        part, starts = cells[begin : ends[last - 1]], ends[first:last] - sizes[first:last] - begin
        places, spare = np.empty_like(part), np.empty_like(part)
        for k in range(len(out)):
            out[k, first:last] = np.minimum.reduceat(shifted(part, k, places, spare), starts)
        first = last
    return out


def banded(coordinates: np.ndarray) -> np.ndarray:
    """One hash of each band and its number, a row for each set."""
    steps = words.odd(ROWS, 7)[None, :, None]
    with np.errstate(over="ignore"):
        sums = (coordinates.reshape(BANDS, ROWS, -1).astype(np.uint64) * steps).sum(axis=1, dtype=np.uint64)
        return words.mix(sums + words.odd(BANDS, 8)[:, None]).T


def prints(sets: list[np.ndarray]) -> list[np.ndarray]:
    """Two hashes of each whole set."""
    with np.errstate(over="ignore"):
        return [np.array([words.mix(s ^ np.uint64(k)).sum() for s in sets], np.uint64) for k in (11, 12)]


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are similar enough."""
    small, large = min(len(a), len(b)), max(len(a), len(b))
    if not small or UNDER * small < OVER * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return UNDER * both >= OVER * (len(a) + len(b) - both)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _set(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint64)


SIGNED = "doc_id long, n_shingles long, print_a long, print_b long, bands array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", BATCH_BYTES):
            sets = words.shingle_sets(*words.flat(part.column(1)), WIDTH)
            sizes = np.array([len(s) for s in sets], np.int64)
            full = [s for s in sets if len(s)]
            counts = np.where(sizes > 0, BANDS, 0)
            offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            bands = pa.ListArray.from_arrays(offsets, _signed(banded(signatures(full)).ravel()))
            columns = [part.column(0), pa.array(sizes), *map(_signed, prints(sets)), bands]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SIGNED.split(", ")])


def signed(df: DataFrame) -> DataFrame:
    """Set size, two hashes of the set and the bands of its signature for each row of `df` (doc_id, text)."""
    rows = df.select(df["doc_id"].cast("long").alias("doc_id"), df["text"].alias("text"))
    return stored(rows.mapInArrow(_sign, SIGNED), "signed")


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles and parity sketch of the rows whose set is the wanted one."""
    for batch in batches:
        for part in slices(batch, "text", BATCH_BYTES):
            sets = words.shingle_sets(*words.flat(part.column(1)), WIDTH)
            wanted = zip(*(part.column(k).to_numpy(zero_copy_only=False) for k in (2, 3)), strict=True)
            found = zip(*(p.view(np.int64) for p in prints(sets)), strict=True)
            right = [k for k, (w, f) in enumerate(zip(wanted, found, strict=True)) if w == f]
            if right:
                own = [sets[k] for k in right]
                places = [(words.mix(s) % np.uint64(64 * SKETCH)).astype(np.int64) for s in own]
                odd = np.array([np.bincount(p, minlength=64 * SKETCH) for p in places], np.uint8) & 1
                bits = np.packbits(odd, axis=1).view(np.int64)
                columns = [part.column(0).take(pa.array(right)), pa.array([len(s) for s in own], pa.int64())]
                columns += [part.column(k).take(pa.array(right)) for k in (2, 3)]
                columns += [pa.array([s.tobytes() for s in own], pa.binary())]
                columns += [pa.array(np.ascontiguousarray(bits[:, k])) for k in range(SKETCH)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in FULL.split(", ")])


DRAWN = ["n", *(f"s{k}" for k in range(SKETCH))]
FULL = ", ".join(
    ["node long, n long, print_a long, print_b long, shingles binary", *(f"s{k} long" for k in range(SKETCH))]
)


def _may_link(a: str, b: str) -> str:
    """SQL: sizes fit, and the sketches differ in no more bits than linked sets of these sizes can; no link is lost."""
    differ = " + ".join(f"bit_count({a}s{k} ^ {b}s{k})" for k in range(SKETCH))
    sizes = f"{UNDER} * least({a}n, {b}n) >= {OVER} * greatest({a}n, {b}n)"
    return f"{sizes} AND {UNDER + OVER} * ({differ}) <= {UNDER - OVER} * ({a}n + {b}n)"


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        yes = pa.array([linked(_set(x), _set(y)) for x, y in pairs], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(yes)


def verified(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """The distinct pairs (a, b) whose sets are similar enough; sketches rule most of the others out before sets move."""
    pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = stored(pairs, f"{name}-pairs")
    for side in ("a", "b"):
        other = F.col("b" if side == "a" else "a")
        drawn = sets.select(F.col("node").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in DRAWN))
        pairs = split_join(pairs, drawn, [side], other)
    pairs = stored(pairs.where(_may_link("a_", "b_")).select("a", "b").distinct(), f"{name}-possible")
    full = split_join(pairs, sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), ["b"], F.col("a"))
    full = split_join(full, sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), ["a"], F.col("b"))
    return stored(full.select("a", "b", "x", "y").mapInArrow(_check, "a long, b long").distinct(), f"{name}-links")


BLOCKS = "block long, node long, shingles binary, tokens array<long>, held array<long>"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets in numbered blocks, and one more row a block: how many of its sets hold each of its shingles."""
    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        for part in slices(batch, "shingles", BATCH_BYTES):
            n = part.num_rows
            tokens, held = np.unique(np.concatenate([_set(v) for v in part.column(1).to_pylist()]), return_counts=True)
            offsets = pa.array(np.r_[np.zeros(n + 1), len(tokens)].astype(np.int32))
            columns = [
                pa.array(np.full(n + 1, block)),
                *(pa.concat_arrays([part.column(k), pa.nulls(1, part.column(k).type)]) for k in (0, 1)),
                pa.ListArray.from_arrays(offsets, _signed(tokens)),
                pa.ListArray.from_arrays(offsets, pa.array(held)),
            ]
            block += 1
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in BLOCKS.split(", ")])


def _rarest(sets: pa.Table, shared: pa.Table) -> pa.Table:
    """Of the rarest shingles of each set in a block those that stand among the `shared` ones, which have their counts."""
    known = shared.column("token").to_numpy()
    order = np.argsort(known.view(np.uint64))
    known, held = known.view(np.uint64)[order], shared.column("held").to_numpy()[order]
    nodes, found = [], []
    for node, value in zip(sets.column("node").to_pylist(), sets.column("shingles").to_pylist(), strict=True):
        own = _set(value)
        at = np.searchsorted(known, own)
        at[at == len(known)] = 0
        times = np.where(known[at] == own, held[at], 1) if len(known) else np.ones(len(own), np.int64)
        # Its size less what a linked set must share of it, and one.
        most = len(own) + OVER * len(own) // -UNDER + 1
        first = np.lexsort((own, times))[:most]
        first = first[times[first] > 1]
        found.append(own[first])
        nodes += [node] * len(first)
    tokens = np.concatenate(found) if found else np.zeros(0, np.uint64)
    return pa.table({"token": _signed(tokens), "node": pa.array(nodes, pa.int64())})


def by_rare_shingles(sets: DataFrame) -> DataFrame:
    """token, node: for each of `sets` (node, shingles) those of its rarest shingles that another set holds too.

    Rarest is what the fewest of `sets` hold; ties go by the shingle's hash, so the order is one for all sets. Shingles are
    counted in blocks of sets first, and only the counts of a block are shuffled and brought back to it.
    """
    rows = stored(sets.select("node", "shingles").mapInArrow(_blocks, BLOCKS), "blocks")
    dictionary = rows.where("node IS NULL").select(F.col("block").alias("of"), F.explode(F.arrays_zip("tokens", "held")).alias("t"))
    dictionary = dictionary.select("of", F.col("t.tokens").alias("token"), F.col("t.held").alias("here"))
    counts = dictionary.groupBy("token").agg(F.sum("here").alias("held")).where("held > 1")
    shared = dictionary.select("of", "token").join(counts, "token")
    blocks = rows.where("node IS NOT NULL").select("block", "node", "shingles")
    return blocks.groupBy("block").cogroup(shared.groupBy("of")).applyInArrow(_rarest, "token long, node long")


def _buckets(nodes: DataFrame) -> DataFrame:
    """signature, node, low, high for each band of a node that another node shares."""
    rows = stored(nodes.select(F.explode("bands").alias("signature"), F.col("doc_id").alias("node")), "bands")
    met = rows.groupBy("signature").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    return stored(split_join(rows, met, ["signature"], F.col("node")), "buckets")


def _named(rows: DataFrame) -> DataFrame:
    """`rows` with the node of each: the smallest doc_id that has the same set."""
    same = ["print_a", "print_b"]
    several = rows.groupBy(*same).agg(F.min("doc_id").alias("node"), F.count("*").alias("_rows")).where("_rows > 1")
    joined = split_join(rows, several.drop("_rows"), same, F.col("doc_id"), "left")
    return joined.withColumn("node", F.coalesce("node", "doc_id"))


def grouped(df: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of `df` (doc_id, text).

    Texts without words have no shingles and no links: they are their own component. Equal sets are linked. Rows that
    repeat an id are one document: its texts' links are all its links, and every row is returned. A row without an id has
    its size, no component, and is kept. An empty table gives no rows; other columns are not read.
    """
    rows = signed(df)
    full = stored(_named(rows.where("doc_id IS NOT NULL AND n_shingles > 0")), "named")
    met = _buckets(full.where("doc_id = node"))
    near = full.where("doc_id = node").select("node", "print_a", "print_b").join(met.select("node").distinct(), "node").distinct()
    texts = df.select(df["doc_id"].cast("long").alias("node"), df["text"].alias("text")).where("node IS NOT NULL")
    # A shuffle at every size, as the nodes grow with the documents; texts need not be sorted for a hash join.
    wanted = texts.join(near.hint("shuffle_hash"), "node").select("node", "text", "print_a", "print_b")
    sets = stored(wanted.mapInArrow(_full_sets, FULL).dropDuplicates(["node", "print_a", "print_b"]), "sets")
    stars = met.select(F.col("low").alias("a"), F.col("node").alias("b"))
    stars = stars.unionByName(met.select(F.col("node").alias("a"), F.col("high").alias("b")))
    found = verified(stars, sets, "star")
    label = components.labels(found)
    # The least and the largest member of a bucket have been compared with all others.
    inner = met.where("node <> low AND node <> high").select("signature", "node").join(label, "node", "left")
    inner = stored(inner.select("signature", "node", F.coalesce("label", "node").alias("label")), "inner")
    mixed = inner.groupBy("signature").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    apart = stored(split_join(inner, mixed, ["signature"], F.col("node")).select("node", "label").distinct(), "apart")
    rare = by_rare_shingles(sets.join(apart.select("node"), "node", "left_semi"))
    rare = stored(rare.distinct().join(apart, "node"), "rare")
    several = rare.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    drawn = sets.select("node", *DRAWN).join(apart.select("node"), "node", "left_semi")
    sides = stored(split_join(rare, several, ["token"], F.col("node")).select("token", "node", "label").join(drawn, "node"), "sides")
    ask = sides.select("token", *(F.col(c).alias(f"a_{c}") for c in ("node", "label", *DRAWN)))
    has = sides.select("token", *(F.col(c).alias(f"b_{c}") for c in ("node", "label", *DRAWN)))
    across = split_join(ask, has, ["token"], F.col("a_node")).where(f"a_node < b_node AND a_label <> b_label AND {_may_link('a_', 'b_')}")
    rest = verified(across.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), sets, "rest")
    member = full.select("doc_id", "node")
    again = member.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    label = components.labels(found.unionByName(rest).unionByName(again.select("a", "b")))
    own = member.groupBy("doc_id").agg(F.min("node").alias("node")).join(label, "node", "left")
    own = own.select("doc_id", F.coalesce("label", "node").alias("component_id"))
    out = rows.select("doc_id", "n_shingles").join(own, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
