"""Language identification: averaged hashed subword embeddings with a linear softmax, trained in numpy by gradient descent.

A text is the mean of the embeddings of its hashed byte n-grams; a linear softmax on the mean gives the languages. After
training on a bounded sample the two layers are folded into one table of n-gram logits, so a text costs one look-up for each
n-gram. The temperature of the softmax and the rejection threshold are set on a part of the sample kept out of training.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.llm import words
from plantlake.llm.common import per_batch

BUCKET_BITS = 15
ORDERS = (2, 3, 4)
DIM = 16
EPOCHS = 4
RATE = 0.5
SEED = 7
#: Bound of the sample that a model is fitted on: rows of each language, in expectation, and rows in all.
PER_LANGUAGE = 1000
SAMPLE_ROWS = 8000
#: Share of rightly identified calibration texts that rejection may lose, and the highest threshold.
LOSS, HIGHEST = 0.001, 0.4
UNKNOWN = "und"

STEPS = (words.odd(8, 9) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte n-grams of one order, and for each text the first n-gram that starts in or after it."""
    n = len(data) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    total = np.zeros(n, np.uint32)
    for k in range(order):
        total += data[k : k + n] * STEPS[k]
    total = (total ^ (total >> np.uint32(15))) * STEPS[order]
    return total >> np.uint32(32 - BUCKET_BITS), np.minimum(offsets, n)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the lower-cased texts, each closed with a space so that no n-gram is of two texts alone."""
    lowered = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    return words.flat(pc.binary_join_element_wise(lowered, pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())))


@dataclass
class Model:
    """Logits of each bucket and language, the temperature, and the score below which a text is rejected."""

    languages: list[str]
    logits: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def raw(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean logits of each text of a block."""
        n = len(offsets) - 1
        total, found = np.zeros((n, len(self.languages))), np.zeros(n)
        for order in ORDERS:
            buckets, cuts = grams(data, offsets, order)
            sizes = np.diff(cuts)
            full = np.flatnonzero(sizes)
            if len(full):
                rows = self.logits[buckets[: cuts[-1]]]
                total[full] += np.add.reduceat(rows, cuts[:-1][full], axis=0)
                found += sizes
        return total / np.maximum(found, 1)[:, None]

    def scores(self, raw: np.ndarray) -> np.ndarray:
        scaled = raw / self.temperature
        odds = np.exp(scaled - scaled.max(axis=1, keepdims=True))
        return odds / odds.sum(axis=1, keepdims=True)

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and rejection of each text."""
        text = column.cast(pa.large_string())
        letters = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not self.languages:
            n = len(text)
            return [UNKNOWN] * n, np.zeros(n), np.ones(n, dtype=bool)
        data, offsets = features(text)
        parts = [np.zeros((0, len(self.languages)))]
        for a, b in words.blocks(data, offsets, 1 << 20):
            parts.append(self.raw(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
        odds = self.scores(np.concatenate(parts))
        best = odds.argmax(axis=1)
        score = np.where(letters, odds[np.arange(len(best)), best], 0.0)
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), letters.tolist(), strict=True)]
        return names, score, ~letters | (score < self.threshold)


def fit(texts: list[str | None], labels: list[str]) -> Model:
    """A model of the labels that occur. One text in five is kept out for temperature and threshold."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((1 << BUCKET_BITS, 0), np.float32))
    wanted = np.array([languages.index(x) for x in labels])
    counted = []
    for text in texts:
        data, offsets = features(pa.array([text], pa.string()))
        counts = np.zeros(1 << BUCKET_BITS, np.float32)
        for order in ORDERS:
            buckets, _ = grams(data, offsets, order)
            counts += np.bincount(buckets, minlength=len(counts)).astype(np.float32)
        ids = np.flatnonzero(counts)
        counted.append((ids, counts[ids] / max(counts.sum(), 1)))
    held = np.arange(len(texts)) % 5 == 4
    if held.all() or not held.any():
        held[:] = False
    random = np.random.default_rng(SEED)
    embed = random.normal(0, 1 / DIM, (1 << BUCKET_BITS, DIM)).astype(np.float32)
    out = np.zeros((DIM, len(languages)), np.float32)
    order = np.flatnonzero(~held)
    share = np.bincount(wanted[order], minlength=len(languages)) * len(languages) / max(len(order), 1)
    steps = EPOCHS * len(order)
    done = 0
    for _ in range(EPOCHS):
        random.shuffle(order)
        for k in order:
            rate = RATE * (1 - done / steps) / max(share[wanted[k]], 0.1)
            done += 1
            ids, weight = counted[k]
            hidden = weight @ embed[ids]
            logit = hidden @ out
            odds = np.exp(logit - logit.max())
            error = odds / odds.sum()
            error[wanted[k]] -= 1
            back = out @ error
            out -= rate * np.outer(hidden, error).astype(np.float32)
            embed[ids] -= (rate * 50 * weight)[:, None] * back.astype(np.float32)
    model = Model(languages, np.ascontiguousarray((embed @ out).astype(np.float32)))
    raw = np.array([weight @ model.logits[ids] for ids, weight in counted]).reshape(len(texts), -1)
    check = held if held.any() else ~held
    _calibrate(model, raw[check], wanted[check])
    return model


def _calibrate(model: Model, raw: np.ndarray, wanted: np.ndarray) -> None:
    """The temperature of the least log loss; the threshold that at most `LOSS` of the right answers fall below."""
    rows = np.arange(len(wanted))

    def loss(temperature: float) -> float:
        model.temperature = temperature
        return -np.log(np.maximum(model.scores(raw)[rows, wanted], 1e-12)).mean()

    model.temperature = min((float(t) for t in np.geomspace(0.05, 20, 60)), key=loss)
    odds = model.scores(raw)
    right = np.sort(odds[rows, wanted][odds.argmax(axis=1) == wanted])
    if len(right):
        model.threshold = min(HIGHEST, float(right[int(LOSS * len(right))]))


def sample(df: DataFrame, label: str, usable: Column, per_label: int, most: int) -> tuple[list, list]:
    """Texts and labels of a bounded sample of the usable labelled rows, drawn by a hash of the id within each label."""
    rows = df.where(usable & F.col(label).isNotNull() & F.col("text").isNotNull())
    found = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not found:
        return [], []
    share = F.lit(0.0)
    for value, n in found.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, per_label / n))).otherwise(share)
    key = F.xxhash64("doc_id", "text")
    drawn = rows.where(F.pmod(key, F.lit(1 << 30)) < share * (1 << 30))
    picked = drawn.select("text", F.col(label).alias("label"), key.alias("key")).orderBy("key").limit(most).collect()
    return [r["text"] for r in picked], [r["label"] for r in picked]


def held_out(modulus: int, remainder: int) -> Column:
    """Whether a row's crc32 of its id as text has this remainder; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def train(df: DataFrame, per_language: int = PER_LANGUAGE, most: int = SAMPLE_ROWS) -> Model:
    """Learns from rows of `df` (doc_id, text, lang) outside the held-out fold."""
    return fit(*sample(df.select("doc_id", "text", "lang"), "lang", ~held_out(3, 1), per_language, most))


SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"


def identified(df: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of each row of `df` (doc_id, text).

    A null text and one without letters are `und` with score 0 and rejected. With no language learned everything is.
    Only the text decides; rows are independent, so repeated rows, null ids and extra columns need no rule. An empty table
    gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score, rejected = shared.value.predict(batch.column(2))
        columns = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score", "rejected"])

    rows = df.select(df["doc_id"].cast("long").alias("doc_id"), held_out(3, 1).alias("held_out"), "text")
    return rows.mapInArrow(per_batch(run), SCHEMA)


def accepted(df: DataFrame, model: Model) -> DataFrame:
    """The rows of `df` that are not rejected, with all their columns."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def keep(text: pa.Array) -> pa.Array:
        return pa.array(~shared.value.predict(text)[2])

    return df.where(F.arrow_udf(keep, "boolean")("text"))
