"""Cross-tokenizer alignment by interval coalescing, and how often ids of two vocabularies stand for the same bytes.

Tokens are intervals of bytes. Those of both tokenizers are sorted by their starts; a running maximum of their ends tells
where a group is over: at a start that reaches it. Inside the groups the overlapping pairs of tokens are expanded.

Texts are aligned in blocks of about a megabyte, each of which gives its documents, as numbers of id pairs and how often they
occur, and one dictionary of its distinct pairs. Only dictionaries are counted over the corpus and joined with the counts;
each comes back to the documents of its block. So a pair that stands in every document is shuffled once for a block, and
what meets in a task is bounded by a block.
"""

import hashlib
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.bpe_count import byte_letters
from plantlake.llm.common import slices, stored
from plantlake.llm.orc_ids import Encoder
from plantlake.llm.pretokens import Splitter

#: Text of a block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20


class Bytewise(Encoder):
    """Ids of a byte-level vocabulary (tokenizers library); special strings inside texts are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.special, self.splitter = {}, Splitter([])
        library = _library(path)
        values = byte_letters()
        entries = {i: entry for entry, i in library.get_vocab(with_added_tokens=False).items()}
        added = {i: t.content.encode() for i, t in library.get_added_tokens_decoder().items()}
        self.pieces = [b""] * (max(entries | added) + 1)
        for i, entry in entries.items():
            self.pieces[i] = added[i] if i in added else bytes(values[letter] for letter in entry)
        for i, entry in added.items():
            self.pieces[i] = entry

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of a space and each text."""
        return [np.frombuffer(b"".join(map(self.__getitem__, self.splitter.split(" " + t))), np.int32) for t in texts]


def _library(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


class Pieces:
    """Ids of a sentencepiece vocabulary, which adds the space in front of a text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.pieces = [
            bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode()
            for i, n in enumerate(names)
        ]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(i, np.int32) for i in self.model.encode(texts, num_threads=1)]


def coalesced(starts_a, ends_a, starts_b, ends_b) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B; tokens are non-empty intervals, ascending on each side.

    Groups are numbered from 0 in order. A group ends where the next start reaches the largest end so far.
    """
    starts, ends = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    side = np.repeat(np.array([0, 1], np.int8), [len(starts_a), len(starts_b)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    fresh = np.ones(len(order), np.int64)
    fresh[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return group[: len(starts_a)], group[len(starts_a) :]


def overlaps(starts_a, ends_a, starts_b, ends_b) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of A and of B in each pair of overlapping ones, in order."""
    first = np.searchsorted(ends_b, starts_a, side="right")
    count = np.searchsorted(starts_b, ends_a, side="left") - first
    before = np.cumsum(count) - count
    a = np.repeat(np.arange(len(starts_a)), count)
    return a, np.arange(len(a)) + np.repeat(first - before, count)


class Aligner:
    """Two tokenizers and what is needed to write their groups."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = Bytewise(path_a), Pieces(path_b)
        self.sizes = [np.array([len(p) for p in side.pieces], np.int64) for side in (self.a, self.b)]
        self.bits = len(self.b.pieces).bit_length()
        # Each id with what may follow it, those of B after those of A.
        both = [i for side in (self.a, self.b) for i in range(len(side.pieces))]
        self.names = [f"{i}{mark}" for i in both for mark in (",", "|", ";", "")]

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Ids of both sides, and whether both give the bytes of a space and the text."""
        right = np.ones(len(texts), bool)
        whole = [(" " + t).encode() for t in texts]
        wanted = np.array([len(w) for w in whole], np.int64)
        out = []
        for side, sizes in zip((self.a, self.b), self.sizes, strict=True):
            ids = side.ids(texts)
            flat = np.concatenate(ids)
            given = b"".join(map(side.pieces.__getitem__, flat.tolist()))
            doc = np.repeat(np.arange(len(texts)), [len(i) for i in ids])
            lengths = np.bincount(doc, sizes[flat], len(texts)).astype(np.int64)
            if given != b"".join(whole) or (lengths != wanted).any():
                ends = np.cumsum(lengths)
                right &= [given[e - n : e] == w for e, n, w in zip(ends, lengths, whole, strict=True)]
            out.append(ids)
        return *out, right

    def written(self, group_a, group_b, a, b, doc_a, doc_b, n: int) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` for each of `n` documents."""
        last = group_a[-1] + 1
        first_a, first_b = (np.searchsorted(g, np.arange(last + 1)) for g in (group_a, group_b))
        codes = np.empty(len(a) + len(b), np.int64)
        at_a = np.arange(len(a)) + first_b[group_a]
        at_b = np.arange(len(b)) + first_a[group_b + 1]
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[first_a[1:] - 1] = 1
        mark_b[first_b[1:] - 1] = 2
        ends = np.cumsum(np.bincount(doc_b, minlength=n))
        mark_b[ends[np.r_[ends[:1] > 0, ends[1:] > ends[:-1]]] - 1] = 3
        codes[at_a] = 4 * a + mark_a
        codes[at_b] = 4 * (b + len(self.a.pieces)) + mark_b
        cuts = np.r_[0, np.cumsum(np.bincount(doc_a, minlength=n) + np.bincount(doc_b, minlength=n))].tolist()
        words = list(map(self.names.__getitem__, codes.tolist()))
        return ["".join(words[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]

    def align(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of A, of B and groups of each text; its groups written out; and (text, id pair, occurrences) of its links.

        An id pair is one number, the id of B in the lower bits. Texts that are null, empty or given differently by a
        tokenizer have nothing.
        """
        n = len(texts)
        some = [k for k, t in enumerate(texts) if t]
        counts, written = [np.zeros(n, np.int64) for _ in range(3)], [""] * n
        none = np.zeros(0, np.int64)
        if not some:
            return counts, written, none, none, none
        ids_a, ids_b, right = self.tokens([texts[k] for k in some])
        kept = [k for k in range(len(some)) if right[k]]
        if not kept:
            return counts, written, none, none, none
        docs = np.array(some)[kept]
        sides = []
        for ids, sizes, count in zip((ids_a, ids_b), self.sizes, counts, strict=False):
            flat = np.concatenate([ids[k] for k in kept]).astype(np.int64)
            count[docs] = [len(ids[k]) for k in kept]
            doc = np.repeat(np.arange(len(kept)), count[docs])
            ends = np.cumsum(sizes[flat])
            sides.append((flat, doc, ends - sizes[flat], ends))
        (a, doc_a, *spans_a), (b, doc_b, *spans_b) = sides
        group_a, group_b = coalesced(*spans_a, *spans_b)
        fresh = np.r_[True, group_a[1:] != group_a[:-1]]
        counts[2][docs] = np.bincount(doc_a[fresh], minlength=len(kept))
        for k, text in zip(docs, self.written(group_a, group_b, a, b, doc_a, doc_b, len(kept)), strict=True):
            written[k] = text
        ia, ib = overlaps(*spans_a, *spans_b)
        width = self.bits + len(self.a.pieces).bit_length()
        keys = np.sort(docs[doc_a[ia]] << width | a[ia] << self.bits | b[ib])
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        times = np.diff(np.r_[new, len(keys)])
        return counts, written, keys[new] >> width, keys[new] & ((1 << width) - 1), times


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One for each worker and pair of vocabularies, kept over its tasks."""
    return Aligner(path_a, path_b)


BLOCKS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
    "places array<int>, times array<int>, pairs array<long>, docs array<int>"
)
NAMES = [f.split()[0] for f in BLOCKS.split(", ")]


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(values, kind))


def blocks(df: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The aligned documents of `df` (doc_id, text) in blocks; one more row a block holds its dictionary of id pairs.

    `places` are the places of a document's distinct pairs in the dictionary of its block, `times` their occurrences in it,
    `docs` how many documents of the block hold each pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                n = part.num_rows
                counts, written, doc, pair, times = aligner(path_a, path_b).align(part.column(1).to_pylist())
                pairs, place = np.unique(pair, return_inverse=True)
                sizes = np.r_[np.bincount(doc, minlength=n), 0]
                hashes = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
                one = np.r_[np.zeros(n, np.int64), len(pairs)]
                is_doc = pa.array(np.r_[np.ones(n, bool), False])
                columns = [
                    pa.array(np.full(n + 1, block)),
                    pa.concat_arrays([part.column(0), pa.nulls(1, pa.int64())]),
                    *(pa.array([*c.tolist(), None], pa.int64()) for c in counts),
                    pa.array([*hashes, None], pa.string()),
                    _lists(place, sizes, pa.int32()),
                    _lists(times, sizes, pa.int32()),
                    _lists(pairs, one, pa.int64()),
                    _lists(np.bincount(place, minlength=len(pairs)), one, pa.int32()),
                ]
                block += 1
                yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    rows = df.select(df["doc_id"].cast("long").alias("doc_id"), df["text"].alias("text"))
    return rows.mapInArrow(run, BLOCKS)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count: how many documents of the corpus hold an id pair linked; `aligned` as `blocks` gives it."""
    held = aligned.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select("p.pairs", "p.docs")
    return held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("count"))


OUT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _totals(docs: pa.Table, dictionary: pa.Table) -> pa.Table:
    """The digests of the documents of one block from the counts of its dictionary."""
    docs, n = docs.combine_chunks(), docs.num_rows
    place = dictionary.column("place").to_numpy()
    counts, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    counts[place] = dictionary.column("count").to_numpy()
    best[place] = dictionary.column("best").to_numpy().astype(np.int64)
    sums = [np.zeros(n, np.int64) for _ in range(3)]
    for k in range(n):
        at = docs.column("places")[k].values.to_numpy()
        times = docs.column("times")[k].values.to_numpy().astype(np.int64)
        sums[0][k], sums[1][k], sums[2][k] = times.sum(), (times * best[at]).sum(), (times * counts[at]).sum()
    columns = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")}
    columns |= dict(zip(("n_links", "n_best", "count_sum"), map(pa.array, sums), strict=True))
    return pa.table(columns | {"groups_sha256": docs.column("groups_sha256")})


def aligned(df: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of `df` (doc_id, text).

    A is a byte-level vocabulary and gets a space and the text, B a sentencepiece model and gets the text. A link is a pair
    of an A and a B token whose byte ranges overlap; the count of its ids is the number of rows of `df` that hold them linked,
    and it is best if no other B id has a higher count with the same A id. Texts that are null, empty, or which a tokenizer
    does not give back byte by byte have zeros and an empty hash. Each row counts as a document of its own, also where ids are
    null or repeat; an empty table gives no rows; other columns are not read. Both files must be readable by the executors.
    """
    rows = stored(blocks(df, path_a, path_b), "aligned")
    shift = F.shiftright("pair", aligner(path_a, path_b).bits)
    counts = stored(pair_counts(rows).withColumn("id_a", shift), "pair-counts")
    # One row for each id of A, so no more than its vocabulary has.
    highest = F.broadcast(counts.groupBy("id_a").agg(F.max("count").alias("highest")))
    ranked = counts.join(highest, "id_a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    held = rows.where("n_a IS NULL").select(F.col("block").alias("of"), F.posexplode("pairs").alias("place", "pair"))
    dictionary = held.join(ranked, "pair").select("of", "place", "count", "best")
    docs = rows.where("n_a IS NOT NULL").drop("pairs", "docs")
    return docs.groupBy("block").cogroup(dictionary.groupBy("of")).applyInArrow(_totals, OUT)
