"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may occur in a document with up to k = floor(rate * n) edits. Cut into k + 1 pieces, at least
one piece must then stand in the document unchanged. All pieces of a block of items are searched in one pass with an
Aho-Corasick automaton; a hit fixes where the item would have to lie, and Myers' bit-parallel algorithm measures the least
edit distance of the item to any stretch of the text there. An item too short for an edit is its own only piece and must
stand between word boundaries.

Items come in blocks of bounded size, one pass over the documents for each block, so what is sent to the executors does not
grow with the benchmark.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm import words
from plantlake.llm.common import per_batch

ERROR_RATE = 0.08
#: An item shorter than this, in normalised bytes, is not searched: it is empty.
LEAST_BYTES = 1
#: An item shorter than this may be part of a word by chance, so without an edit to spend it must stand between word boundaries.
SHORT_BYTES = 24
BLOCK_CHARS = 2_000_000
TEXT_BYTES = 1 << 20

KEEPS = np.zeros(256, dtype=bool)
KEEPS[list(b"abcdefghijklmnopqrstuvwxyz0123456789")] = True
KEEPS[0x80:] = True


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts as bytes and offsets, every run of other ASCII characters than letters and digits one space."""
    data, offsets = words.flat(pc.utf8_lower(column.cast(pa.large_string())))
    if not len(data):
        return data, offsets
    keep = KEEPS[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    gap = ~keep
    gap[1:] &= keep[:-1]
    gap &= ~first[:-1]
    stays = keep | gap
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(stays, out=total[1:])
    return np.where(keep, data, 32).astype(np.uint8)[stays], total[offsets]


def texts_of(column: pa.Array) -> list[str]:
    """Normalised texts, each byte one character."""
    data, offsets = normalised(column)
    raw = data.tobytes().decode("latin-1")
    return [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


#: What continues a word: any letter, digit or mark, but for scripts that are written without spaces.
IN_WORD = regex.compile(
    r"(?V1)[[\p{L}\p{M}\p{N}]--[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]]"
)
MARK = regex.compile(r"\p{M}")


def inside_word(text: str, at: int) -> bool:
    """Whether place `at` of a normalised text, where a character begins, has the same word on both sides."""
    if not 0 < at < len(text):
        return False
    if text[at - 1] < "\x80" and text[at] < "\x80":
        return text[at - 1] != " " and text[at] != " "
    left = text[max(0, at - 4) : at].encode("latin-1").decode("utf-8", "ignore")[-1:]
    right = text[at : at + 4].encode("latin-1").decode("utf-8", "ignore")[:1]
    return bool(MARK.match(right) or (IN_WORD.match(left) and IN_WORD.match(right)))


def nearest(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of `pattern` to any stretch of `text`, and where the first such stretch ends.

    Myers' column update: one bit of an integer for each place of the pattern.
    """
    n = len(pattern)
    masks: dict[str, int] = {}
    for k, letter in enumerate(pattern):
        masks[letter] = masks.get(letter, 0) | 1 << k
    every, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = every, 0, n
    best, end = n, 0
    for at, letter in enumerate(text, 1):
        match = masks.get(letter, 0)
        diagonal = (((match & plus) + plus) ^ plus) | match | minus
        up = minus | ~(diagonal | plus) & every
        down = plus & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & every
        down = down << 1 & every
        plus = down | ~((match | minus) | up) & every
        minus = up & (match | minus)
        if score < best:
            best, end = score, at
    return best, end


def cut(item: str, errors: int) -> list[tuple[int, str]]:
    """`errors` + 1 consecutive pieces of nearly equal length, with their places."""
    edges = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        items = [(i, t if len(t) >= SHORT_BYTES else t.rstrip(" ")) for i, t in items]
        self.items = [(i, t, int(rate * len(t))) for i, t in items if len(t) >= LEAST_BYTES]
        self.automaton = None

    def _build(self) -> None:
        import ahocorasick

        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, item, errors) in enumerate(self.items):
            for at, piece in cut(item, errors):
                places.setdefault(piece, []).append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def find(self, text: str, first_only: bool = False) -> list[tuple[int, int, int]]:
        """(number of the item, distance, end) for each item within its error budget, at its best place."""
        if not self.items:
            return []
        if self.automaton is None:
            self._build()
        done: dict[int, int] = {}
        best: dict[int, tuple[int, int]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for k, at in where:
                _, item, errors = self.items[k]
                if k in best and best[k][0] == 0:
                    continue
                begin = end + 1 - size - at
                if not errors and len(item) < SHORT_BYTES:
                    if not (inside_word(text, begin) or inside_word(text, end + 1)):
                        best[k] = (0, end + 1)
                        if first_only:
                            return [(k, *best[k])]
                    continue
                # An earlier look at the same item has covered this place if it began close by.
                if k in done and abs(begin - done[k]) <= errors and k in best:
                    continue
                done[k] = begin
                low = max(0, begin - errors)
                distance, stop = nearest(item, text[low : begin + len(item) + errors])
                if distance <= errors and (k not in best or distance < best[k][0]):
                    best[k] = (distance, low + stop)
                    if first_only:
                        return [(k, *best[k])]
        return [(k, *v) for k, v in best.items()]


def blocks_of(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items with a text in blocks of about `block_chars` characters, one block at a time on the driver."""
    items = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for k in range(n):
        rows = items.where(block == k).distinct().orderBy("item_id", "text").collect()
        texts = texts_of(pa.array([r["text"] for r in rows], pa.string()))
        yield [(r["item_id"], t) for r, t in zip(rows, texts, strict=True)]


SCHEMA = "doc_id long, item_id long, distance int, budget int, text_end long"


def leaks(df: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """doc_id, item_id, distance, budget and text_end for each document of `df` and item of `benchmark` found in it.

    `text_end` is where the best match ends in the normalised text. Null texts and items and those without a letter or digit
    match nothing. Items with equal texts are found alike; a repeated row of `df` gives its rows again, a repeated row of
    `benchmark` nothing more. With an empty table on either side there are no rows.
    """
    rows = df.select(df["doc_id"].cast("long").alias("doc_id"), "text")
    found = [rows.mapInArrow(_search(df, block, rate), SCHEMA) for block in blocks_of(benchmark)]
    out = df.sparkSession.createDataFrame([], SCHEMA) if not found else found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _search(df: DataFrame, block: list[tuple[int, str]], rate: float) -> Callable:
    shared = df.sparkSession.sparkContext.broadcast(Matcher(block, rate))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        matcher, out = shared.value, []
        for doc_id, text in zip(batch.column(0).to_pylist(), _parts(batch.column(1)), strict=True):
            for k, distance, end in matcher.find(text):
                item, _, errors = matcher.items[k]
                out.append((doc_id, item, distance, errors, end))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])

    return per_batch(run)


def _parts(column: pa.Array) -> Iterator[str]:
    """Normalised texts, a few at a time."""
    sizes = pc.fill_null(pc.binary_length(column.cast(pa.large_string())), 0).to_numpy(zero_copy_only=False)
    offsets = np.r_[0, np.cumsum(sizes)]
    for a, b in words.blocks(offsets, offsets, TEXT_BYTES):
        yield from texts_of(column.slice(a, b - a))


def _free(shared) -> Callable[[pa.Array], pa.Array]:
    def free(column: pa.Array) -> pa.Array:
        return pa.array([not shared.value.find(t, first_only=True) for t in _parts(column)], pa.bool_())

    return free


def clean(df: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """The rows of `df` in which no item of `benchmark` is found, with all their columns; a narrow step for each block."""
    for block in blocks_of(benchmark):
        shared = df.sparkSession.sparkContext.broadcast(Matcher(block, rate))
        df = df.where(F.arrow_udf(_free(shared), "boolean")("text"))
    return df
