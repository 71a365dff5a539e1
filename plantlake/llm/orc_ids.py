"""Token ids in ORC files: stripes of run-length encoded integers, row indexes, Bloom filters on the document ids.

Files hold disjoint ascending ranges of document ids, sorted, so that the statistics of files, stripes and row groups prune
a search for a range of ids, and the Bloom filter one for single ids. Spark reads the stripes of a file in parallel.
"""

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlake.llm.bpe_count import byte_letters
from plantlake.llm.common import per_batch, running, slices, stored
from plantlake.llm.pretokens import KNOWN_WORDS, Splitter

STRIPE_BYTES = 32 << 20
ROW_GROUP = 2000
BATCH_BYTES = 1 << 20
END_ID = 2

#: `file` and `place` order the rows: the files by number, the rows inside a file by place.
SCHEMA = "doc_id long, file int, place long, ids array<int>"
OPTIONS = {
    "orc.stripe.size": str(STRIPE_BYTES),
    "orc.row.index.stride": str(ROW_GROUP),
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "zstd",
}


class Encoder(dict):
    """Ids of texts by the tokenizers library; the ids of the first `KNOWN_WORDS` pre-tokens are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        library = Tokenizer.from_file(path)
        self.special = {t.content: i for i, t in library.get_added_tokens_decoder().items()}
        self.splitter = Splitter(list(self.special))
        self.model = library.model
        self.letters = {byte: letter for letter, byte in byte_letters().items()}

    def __missing__(self, token: str) -> bytes:
        if token in self.special:
            ids = [self.special[token]]
        else:
            letters = token.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.model.tokenize(letters)]
        out = array("i", ids).tobytes()
        if len(self) < KNOWN_WORDS:
            self[token] = out
        return out

    def encode(self, texts: list[str | None], end_id: int) -> pa.Array:
        """A list of ids for each text, the end id last."""
        end = array("i", [end_id]).tobytes()
        raw = [b"".join(map(self.__getitem__, self.splitter.split(t or ""))) for t in texts]
        offsets = np.cumsum([0, *(len(r) // 4 + 1 for r in raw)]).astype(np.int32)
        flat = np.frombuffer(b"".join(x for r in raw for x in (r, end)), np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


@cache
def encoder(path: str) -> Encoder:
    """One for each worker and vocabulary, kept over its tasks."""
    return Encoder(path)


def write(df: DataFrame, tokenizer: str, path: str, end_id: int = END_ID) -> None:
    """Writes the ids of every whole text of `df` (doc_id, text), each closed with `end_id`, in ascending order of doc_id.

    The texts are range-partitioned by id before they are encoded, so only they are shuffled and each task encodes and
    writes its range. A null text is empty: its row holds the end id alone. Null ids come first; rows of equal id stand by
    a hash of their text. `tokenizer` is a vocabulary file that the executors can read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                n = part.num_rows
                columns = [
                    part.column(0),
                    pa.array(np.full(n, number, np.int32)),
                    pa.array(np.arange(place, place + n)),
                    encoder(tokenizer).encode(part.column(1).to_pylist(), end_id),
                ]
                place += n
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "file", "place", "ids"])

    rows = df.select(df["doc_id"].cast("long").alias("doc_id"), df["text"].alias("text"))
    ranged = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ranged.mapInArrow(run, SCHEMA).write.options(**OPTIONS).orc(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """doc_id and ids of some documents; the filter reaches the files' statistics and Bloom filters."""
    return read(spark, path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "ids")


def _digest(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids = batch.column(3)
    offsets = ids.offsets.to_numpy()
    flat = ids.values.to_numpy().astype("<u4")
    sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    columns = [*batch.columns[:3], pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "file", "place", "n_tokens", "ids_crc32"])


def contents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each row of the files: `start` counts the ids of all rows before it."""
    rows = read(spark, path).mapInArrow(
        per_batch(_digest), "doc_id long, file int, place long, n_tokens long, ids_crc32 long"
    )
    placed = running(stored(rows, "orc-digests"), [], "file", ["place"], F.col("n_tokens"), "start")
    return placed.select("doc_id", F.col("start").cast("long").alias("start"), "n_tokens", "ids_crc32")
