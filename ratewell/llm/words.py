"""Words of whole Arrow text columns as numpy arrays.

A column is one buffer of UTF-8 bytes and a list of offsets, so all texts of a
batch are cut into words and hashed together.  Work goes through the buffer in
tiles of bounded size; only one number per word is kept for a whole chunk.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TILE = 1 << 20
#: Texts are handled in chunks of about so many bytes; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20
PRIME = 0x9E3779B97F4A7C15

# A-Z become a-z, all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes that words consist of.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
PLAIN = np.zeros(256, dtype=bool)
PLAIN[0x30:0x3A] = PLAIN[0x61:0x7B] = PLAIN[0x80:] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chunks(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, lower-cased bytes, offsets) for chunks of texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = column.fill_null("").cast(pa.large_string())
    at = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + column.offset + 1)[column.offset :]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK_BYTES, side="right")) - 1)
        last = min(last, len(column))
        yield first, last, LOWER[data[at[first] : at[last]]], at[first : last + 1] - at[first]
        first = last


def spans(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words and, per text, the number of the first word (one more entry than texts).

    A word never crosses the border between two texts.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    word = inside[data]
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    borders = at[1:-1]
    before[borders[borders < len(data)]] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    inner = borders[borders > 0] - 1
    after[inner] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, at)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word: a polynomial of its bytes, scrambled together with its length."""
    out = np.zeros(len(starts), dtype=np.uint64)
    if not len(starts):
        return out
    longest = int((ends - starts).max())
    powers = np.cumprod(np.full(min(longest, TILE), PRIME, dtype=np.uint64))
    cuts = [0]
    while cuts[-1] < len(starts):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, starts[cuts[-1]] + TILE, side="right"))))
    for a, b in zip(cuts, cuts[1:], strict=False):
        lo, hi = int(starts[a]), int(ends[b - 1])
        if b - a == 1 and hi - lo > TILE:  # one huge word
            out[a] = _huge(data[lo:hi], powers)
            continue
        length = ends[a:b] - starts[a:b]
        first = np.cumsum(length) - length
        place = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(first, length)
        byte = data[np.repeat(starts[a:b], length) + place].astype(np.uint64)
        byte += np.uint64(1)
        byte *= powers[place]
        out[a:b] = np.add.reduceat(byte, first)
    return mixed(out + mixed((ends - starts).astype(np.uint64)))


def _huge(data: np.ndarray, powers: np.ndarray) -> np.uint64:
    total, scale = np.uint64(0), np.uint64(1)
    with np.errstate(over="ignore"):
        for lo in range(0, len(data), TILE):
            part = data[lo : lo + TILE].astype(np.uint64) + np.uint64(1)
            total += np.add.reduce(part * powers[: len(part)]) * scale
            scale *= powers[-1]
    return total


def word_hashes(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a chunk, and per text the number of its first word."""
    starts, ends, first = spans(data, at, inside)
    return hashes(data, starts, ends), first


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of runs of `size` words of one text, sorted; all words as one run when there are fewer."""
    if not len(words):
        return np.zeros(0, dtype=np.uint64)
    size = min(size, len(words))
    runs = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        runs *= np.uint64(PRIME)
        runs += words[k : len(words) - size + 1 + k]
    runs = np.sort(mixed(runs))
    return runs[np.concatenate(([True], runs[1:] != runs[:-1]))]
