"""Words, lines and word shingles of whole batches of texts as numpy arrays.

A batch is the bytes of its texts one after another plus the offsets of the texts; a null text is empty. White space is
the six ASCII separators, each one byte in UTF-8, so working on bytes gives the same words as working on characters.
Hashes are 64 bits wide: two different shingles meet with a chance of 2^-64, which the operators accept as exact.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20
SPACES = b" \t\n\x0b\x0c\r"

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[list(SPACES)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd(n: int, seed: int) -> np.ndarray:
    """`n` fixed odd multipliers."""
    return mix(np.arange(n, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


BYTE_VALUES = odd(256, 1)
WORD_STEPS = odd(5, 2)


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the offsets of its texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about `most` bytes together; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run of true bytes; no run crosses a text."""
    n = len(inside)
    if n == 0:
        return (np.zeros(0, np.int64),) * 3
    fresh = np.zeros(n + 1, dtype=bool)
    fresh[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | fresh[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | fresh[1:n]
    first = np.flatnonzero(starts)
    return first, np.flatnonzero(ends) + 1, np.searchsorted(offsets, first, side="right") - 1


def run_hashes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each run; runs are in order and do not overlap."""
    if len(first) == 0:
        return np.zeros(0, np.uint64)
    sizes = last - first
    begins = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(begins, sizes)
    at = place + np.repeat(first, sizes)
    with np.errstate(over="ignore"):
        parts = BYTE_VALUES[data[at]] * odd(int(sizes.max()), 3)[place]
        return mix(np.add.reduceat(parts, begins) + sizes.astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word."""
    first, last, text = spans(IS_WORD[data], offsets)
    return run_hashes(LOWER[data] if lower else data, first, last), text


def windows(hashes: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of `width` words, and the number of its first word."""
    if len(hashes) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(hashes) - width + 1
    steps = odd(width, 2)
    with np.errstate(over="ignore"):
        total = np.zeros(n, np.uint64)
        for k in range(width):
            total += hashes[k : k + n] * steps[k]
    whole = np.flatnonzero(text[:n] == text[width - 1 :])
    return mix(total[whole]), whole


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """The sorted distinct word shingles of each text, lower-cased in A-Z.

    A text of fewer words than `width` has its whole sequence as its only shingle; one without words has none.
    """
    out: list[np.ndarray] = []
    for a, b in blocks(data, offsets):
        part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        hashes, text = word_hashes(part, cuts, lower=True)
        found, at = windows(hashes, text, width)
        ends = np.searchsorted(text[at], np.arange(b - a + 1))
        word_ends = np.searchsorted(text, np.arange(b - a + 1))
        for k in range(b - a):
            own = found[ends[k] : ends[k + 1]]
            if len(own):
                own = np.sort(own)
                out.append(own[np.r_[True, own[1:] != own[:-1]]])
                continue
            few = hashes[word_ends[k] : word_ends[k + 1]]
            with np.errstate(over="ignore"):
                out.append(mix(np.array([(few * odd(width, 2)[: len(few)]).sum() + np.uint64(len(few))]))[: len(few)])
    return out
