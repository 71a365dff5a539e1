"""Token counts of byte-pair vocabularies by rank-synchronous merging of many words at once.

Texts are cut into pre-tokens by the vocabulary's pattern. The distinct pre-tokens of a batch that are not known yet are
held as one ragged array of symbols. In every round each sequence finds its lowest-rank pair and merges all places of that
pair, from the left; sequences without a pair drop out. What survives is counted. Counts of known pre-tokens are kept in a
dictionary of bounded size, which is only a memory of results and never changes one.
"""

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlake.llm.pretokens import Memory, Splitter

LIMIT = 512
TEXTS = 500


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """Merge rules as sorted arrays: a pair of symbols gives its rank and the symbol that replaces it."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        letters = byte_letters()
        self.of_byte = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.of_byte[byte] = vocabulary[letter]
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        self.width = max(vocabulary.values()) + 1
        keys = left * self.width + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order
        self.becomes = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.special = [t["content"] for t in spec["added_tokens"] if not t.get("normalized") and t["content"]]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or a number above all ranks."""
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.rank[at], len(self.keys))

    def count(self, sequences: list[bytes]) -> np.ndarray:
        """Number of symbols that each sequence of bytes is merged to."""
        sizes = np.array([len(s) for s in sequences], np.int64)
        out = sizes.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(sequences), np.uint8)]
        owner = np.repeat(np.arange(len(sequences)), sizes)
        none = len(self.keys)
        while len(symbols) > 1:
            rank = np.full(len(symbols), none, np.int64)
            joined = owner[1:] == owner[:-1]
            rank[:-1][joined] = self.ranks(symbols[:-1][joined], symbols[1:][joined])
            heads = np.flatnonzero(np.r_[True, ~joined])
            least = np.minimum.reduceat(rank, heads)
            spread = np.repeat(least, np.diff(np.r_[heads, len(symbols)]))
            hit = (rank == spread) & (spread < none)
            # Places of one pair that overlap, as in a run of one letter: every second from the left counts.
            start = hit & ~np.r_[False, hit[:-1]]
            index = np.arange(len(hit))
            hit &= (index - np.maximum.accumulate(np.where(start, index, 0))) % 2 == 0
            symbols = np.where(hit, self.becomes[np.minimum(rank, none - 1)], symbols)
            alive = spread < none
            stay = ~np.r_[False, hit[:-1]]
            out -= np.bincount(owner[~stay], minlength=len(out))
            symbols, owner = symbols[stay & alive], owner[stay & alive]
        return out


class Counter:
    """Counts tokens of texts; a worker keeps one for all its tasks."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.splitter = Splitter(self.merges.special)
        self.memory = Memory(self._counts)

    def _counts(self, tokens: list[str]) -> list[int]:
        special = set(self.merges.special)
        counts = self.merges.count([t.encode() for t in tokens]).tolist()
        return [1 if t in special else n for t, n in zip(tokens, counts, strict=True)]

    def count(self, texts: list[str | None]) -> list[int]:
        split = [self.splitter.split(t or "") for t in texts]
        known = self.memory.of(split).__getitem__
        return [sum(map(known, tokens)) for tokens in split]


@cache
def counter(path: str) -> Counter:
    return Counter(path)


SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(df: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each row of `df` (doc_id, text), for the vocabulary file at `path`.

    Counts equal those of the vocabulary's own library without begin, end or added tokens; a special string inside a text
    is one token. A null text is empty: 0 bytes, 0 tokens. Every row gives one row, whatever its id; an empty table gives
    none. `path` must be readable on the executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, TEXTS):
                part = batch.slice(first, TEXTS)
                n = np.array(counter(path).count(part.column(2).to_pylist()), np.int64)
                columns = [part.column(0), part.column(1), pa.array(n), pa.array(n > limit)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = df.select(df["doc_id"].cast("long").alias("doc_id"), size.alias("n_bytes"), "text")
    return rows.mapInArrow(run, SCHEMA)
