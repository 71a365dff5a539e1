"""Quality rules from compression: zstandard ratios of whole texts and fixed chunks, with limits by length.

The ratio is bytes over compressed bytes. It grows with the length of ordinary prose, since a longer text repeats more of
itself, so the limits belong to bands of length. A text above its band's upper limit repeats itself; one below its lower
limit is random or encoded data. Chunks catch a part of a text that the whole hides.

Each band has two pairs of limits, and a text must keep to both. One pair is learned from the corpus: the quartiles of the
log ratios of all different texts of the band that pass the base rule, widened by `SPREADS` times their distance and `SLACK`.
The other is fixed, for corpora of which a band holds few texts or mostly bad ones.

Fixed lower limits lie between the highest ratio of random alphanumeric words, the encoded text that packs best (base64 and base85
are lower), and the lowest of prose. Below 256 bytes the two overlap. Hexadecimal digits pack like prose (1.9) and pass.
Encoded text is ASCII, and short prose in scripts of three bytes a letter packs no better than it, so a text with many other
bytes has lower limits that only raw noise falls below.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantlake.llm import words
from plantlake.llm.common import per_batch, stored

#: (bytes from, lowest ratio, lowest with many bytes above 127, highest ratio); a text below the first band is too short to judge.
BANDS = (
    (64, 0.70, 0.70, 2.4),
    (256, 1.17, 1.02, 2.5),
    (320, 1.20, 1.02, 2.5),
    (384, 1.25, 1.02, 2.5),
    (512, 1.28, 1.02, 2.5),
    (640, 1.31, 1.02, 2.5),
    (768, 1.34, 1.02, 2.5),
    (1024, 1.36, 1.15, 2.9),
    (1280, 1.37, 1.15, 2.9),
    (1536, 1.39, 1.15, 2.9),
    (2048, 1.41, 1.15, 2.9),
    (3072, 1.42, 1.15, 2.9),
    (4096, 1.50, 1.25, 3.2),
    (16384, 1.55, 1.30, 3.6),
    (65536, 1.60, 1.30, 4.2),
)
#: Share of bytes above 127 that counts as many.
MANY_HIGH = 1 / 3
CHUNK_BYTES = 2048
#: The lowest ratio of a chunk is that of a text of its length.
CHUNK_HIGHEST = 4.0
#: Share of a text's chunks that may break the chunk limits.
BAD_CHUNKS = 0.25
#: Learned limits: distances between the quartiles, and natural logs of the ratio, that a text may lie beyond a quartile.
SPREADS, SLACK = 3.0, 0.2
#: Bins of a log ratio of one, in the histograms that quartiles are taken from.
BINS = 400
LEVEL = 3

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
HIGH = bytes(range(128, 256))
LEADS = np.ones(256, dtype=bool)
LEADS[0x80:0xC0] = False


def _repeats(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """True where the same hash occurs more than once within its owner."""
    order = np.lexsort((hashes, owner))
    same = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(hashes), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    out = np.empty(len(hashes), dtype=bool)
    out[order] = twice
    return out


def _later(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """True where an equal hash of the same owner stands earlier."""
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    out = np.zeros(len(hashes), dtype=bool)
    out[order[1:]] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return out


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text of a block."""
    n = len(offsets) - 1
    inside = words.IS_WORD[data]
    first, last, text = words.spans(inside, offsets)
    out = {"n_words": np.bincount(text, minlength=n)}

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(flags)]
        return total[offsets[1:]] - total[offsets[:-1]]

    out["word_chars"] = per_text(inside & LEADS[data])
    out["n_symbols"] = per_text(SYMBOLS[data])
    hashes = words.run_hashes(data, first, last)
    found, at = words.windows(hashes, text, 3)
    covered = np.zeros(len(hashes) + 2, dtype=bool)
    twice = at[_repeats(found, text[at])]
    for k in range(3):
        covered[twice + k] = True
    out["n_repeat_words"] = np.bincount(text[covered[: len(text)]], minlength=n)
    begin, end, line_text = words.spans(data != 10, offsets)
    total = np.r_[0, np.cumsum(inside)]
    worded = total[end] > total[begin]
    begin, end, line_text = begin[worded], end[worded], line_text[worded]
    again = _later(words.run_hashes(data, begin, end), line_text)
    out["n_dup_lines"] = np.bincount(line_text[again], minlength=n)
    return out


def ratio(text: bytes, press: zstandard.ZstdCompressor) -> float:
    return len(text) / len(press.compress(text)) if text else 0.0


def chunks(text: bytes) -> Iterator[bytes]:
    """Fixed chunks of a text; a last one of less than half a chunk joins the one before."""
    n = max(1, (len(text) + CHUNK_BYTES // 2) // CHUNK_BYTES)
    for k in range(n):
        yield text[k * CHUNK_BYTES : (k + 1) * CHUNK_BYTES if k < n - 1 else len(text)]


def many_high(text: bytes) -> bool:
    return not text.isascii() and len(text) - len(text.translate(None, HIGH)) > MANY_HIGH * len(text)


def limits(text: bytes) -> tuple[float, float] | None:
    """Fixed lowest and highest ratio of a text, by its length and kind of bytes."""
    band = next((b for b in reversed(BANDS) if b[0] <= len(text)), None)
    if band is None:
        return None
    return band[2 if many_high(text) else 1], band[3]


def in_bands(text: bytes, press: zstandard.ZstdCompressor) -> tuple[float, float, bool, list[float]]:
    """Ratio of the whole, share of chunks outside the fixed limits, the fixed limits' verdict, ratios of two or more chunks."""
    whole = ratio(text, press)
    band = limits(text)
    if band is None:
        return whole, 0.0, True, []
    fine = band[0] <= whole <= band[1]
    parts = list(chunks(text))
    if len(parts) < 2:
        return whole, 0.0, fine, []
    packed = [ratio(c, press) for c in parts]
    bad = [not limits(c)[0] <= r <= CHUNK_HIGHEST for c, r in zip(parts, packed, strict=True)]
    share = sum(bad) / len(bad)
    return whole, share, fine and share <= BAD_CHUNKS, packed


MEASURED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "n_bytes long, many_high boolean, ratio double, fixed_bad_chunks double, chunk_ratios array<double>"
)


def _batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = words.flat(batch.column(1))
    parts = []
    for a, b in words.blocks(data, offsets):
        parts.append(counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
    c = {k: np.concatenate([p[k] for p in parts]).astype(np.int64) for k in parts[0]}
    press = zstandard.ZstdCompressor(level=LEVEL)
    raw = data.tobytes()
    texts = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    judged = [in_bands(t, press) for t in texts]
    failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    columns = [batch.column(0), *(pa.array(c[k]) for k in names), pa.array(failed)]
    columns += [pa.array(np.diff(offsets).astype(np.int64)), pa.array([many_high(t) for t in texts], pa.bool_())]
    kinds = ((0, pa.float64()), (1, pa.float64()), (3, pa.list_(pa.float64())))
    columns += [pa.array([j[k] for j in judged], kind) for k, kind in kinds]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in MEASURED.split(", ")])


def measured(df: DataFrame) -> DataFrame:
    """Base counts, ratios and the chunks outside the fixed limits of each row of `df` (doc_id, text), from one pass over the texts."""
    return df.select(df["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(per_batch(_batch), MEASURED)


def band(n_bytes: Column) -> Column:
    """The number of the band that a length belongs to, NULL below the first."""
    at = F.lit(None).cast("int")
    for k, (least, *_) in enumerate(BANDS):
        at = F.when(n_bytes >= least, F.lit(k)).otherwise(at)
    return at


def learned(rows: DataFrame) -> DataFrame:
    """Limits of log ratios by kind of bytes and band, of whole texts and (band -1) of chunks, from all `measured` rows.

    Texts that fail the base rule are no model of good prose and are left out; copies, which have equal length and ratio, count
    once, so a large group of them does not move the quartiles. Histograms of log ratios are merged before quartiles are taken;
    the result has at most two rows for each band.
    """
    good = rows.where(~F.col("base_failed") & (F.col("n_bytes") >= BANDS[0][0]))
    texts = good.groupBy("many_high", "n_bytes", "ratio").agg(F.any_value("chunk_ratios").alias("chunk_ratios"))
    pieces = F.array_append(
        F.transform("chunk_ratios", lambda r: F.struct(F.lit(-1).alias("band"), r.alias("ratio"))),
        F.struct(band(F.col("n_bytes")).alias("band"), F.col("ratio").alias("ratio")),
    )
    found = texts.select("many_high", F.explode(pieces).alias("_piece"))
    binned = found.groupBy("many_high", F.col("_piece.band").alias("band"), _bin(F.col("_piece.ratio")).alias("_bin")).count()
    quartiles = binned.groupBy("many_high", "band").agg(F.percentile("_bin", [0.25, 0.75], F.col("count")).alias("_q"))
    beyond = SPREADS * (F.col("_q")[1] - F.col("_q")[0]) / BINS + SLACK
    return quartiles.select(
        "many_high", "band", (F.col("_q")[0] / BINS - beyond).alias("lowest"), (F.col("_q")[1] / BINS + beyond).alias("highest")
    )


def _bin(ratio: Column) -> Column:
    return F.round(F.log(ratio) * BINS).cast("int")


def judged(df: DataFrame) -> DataFrame:
    """The base counts, the compression figures and the verdict of each row of `df` (doc_id, text).

    `in_bands` is the bands' verdict on any text, failed by the base rule or not, and `reason` what broke it: `repetitive` or
    `incompressible` for the whole text, `chunks` for too many chunks outside their limits. `kept` asks for the base rule too.

    A null or empty text has no words and so fails the base rule; one below the first band is in bands. Texts are taken whole;
    equal texts get equal rows. Repeated rows, null ids and extra columns are passed by as they are: every row gives one row.
    An empty table gives none.
    """
    rows = stored(measured(df), "compression")
    found = learned(rows)
    whole = found.where("band >= 0").select(
        F.col("many_high").alias("_kind"), F.col("band").alias("_band"), F.col("lowest").alias("_low"), F.col("highest").alias("_high")
    )
    parts = found.where("band < 0").select(
        F.col("many_high").alias("_part_kind"), F.col("lowest").alias("_part_low"), F.col("highest").alias("_part_high")
    )
    # Two rows a band at most: both sides are tables of fixed size.
    at = band(F.col("n_bytes"))
    joined = rows.join(F.broadcast(whole), (F.col("many_high") == F.col("_kind")) & (at == F.col("_band")), "left")
    joined = joined.join(F.broadcast(parts), F.col("many_high") == F.col("_part_kind"), "left")
    outside = F.filter("chunk_ratios", lambda r: ~F.log(r).between(F.col("_part_low"), F.col("_part_high")))
    share = F.when(F.size("chunk_ratios") > 0, F.size(outside) / F.size("chunk_ratios")).otherwise(0.0)
    bad_chunks = F.greatest("fixed_bad_chunks", share)
    ratio = F.log("ratio")
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for k, (_, least, least_high, most) in enumerate(BANDS):
        low = F.when(at == k, F.when(F.col("many_high"), F.lit(least_high)).otherwise(F.lit(least))).otherwise(low)
        high = F.when(at == k, F.lit(most)).otherwise(high)
    reason = (
        F.when((F.col("ratio") > high) | (ratio > F.col("_high")), "repetitive")
        .when((F.col("ratio") < low) | (ratio < F.col("_low")), "incompressible")
        .when(at.isNotNull() & (bad_chunks > BAD_CHUNKS), "chunks")
    )
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return joined.select(
        *names,
        (~F.col("base_failed") & reason.isNull()).alias("kept"),
        "ratio",
        bad_chunks.alias("bad_chunks"),
        reason.isNull().alias("in_bands"),
        reason.alias("reason"),
    )
