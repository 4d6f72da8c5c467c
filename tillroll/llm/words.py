"""Words of many texts at once, as numpy arrays over the bytes of an Arrow batch.

Everything works on UTF-8 bytes: only A-Z are lower-cased and all separators are single bytes, so no text is
decoded. Hashes depend on nothing but the bytes, so every task and every retry computes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
# Text bytes that are worked on at once; the arrays beside them take some forty times as much.
CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit (SplitMix64's finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=U64) + U64(seed) * U64(1_000_003)) * U64(_BASE))


_BYTE_VALUES = stream(1, 256)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(pattern: str) -> np.ndarray:
    """Table of the 256 bytes that a class such as ``a-z0-9`` names; bytes of longer characters as given by ``\\x80-\\xff``."""
    table = np.zeros(256, bool)
    i = 0
    while i < len(pattern):
        last = pattern[i + 2] if pattern[i + 1 : i + 2] == "-" and i + 2 < len(pattern) else pattern[i]
        table[ord(pattern[i]) : ord(last) + 1] = True
        i += 3 if pattern[i + 1 : i + 2] == "-" and i + 2 < len(pattern) else 1
    return table


# Words between white space, and words of letters and digits.
NOT_SPACE = ~byte_class(" \t-\r")
ALPHANUMERIC = byte_class("0-9a-z\x80-\xff")


class _Powers:
    """Powers of the hash base and of its inverse, extended on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            self.up = np.cumprod(np.concatenate([np.ones(1, U64), np.full(size - 1, _BASE, U64)]), dtype=U64)
            self.down = np.cumprod(np.concatenate([np.ones(1, U64), np.full(size - 1, _INVERSE, U64)]), dtype=U64)
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Words:
    """Words of ``n_texts`` texts: byte positions in ``data``, and the text each belongs to, in order."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray

    @property
    def n_texts(self) -> int:
        return len(self.offsets) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.n_texts)

    def firsts(self) -> np.ndarray:
        """Index of each text's first word; one more entry at the end."""
        return np.concatenate([[0], np.cumsum(self.counts())])

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: a polynomial over its bytes, mixed."""
        out = np.empty(len(self.start), U64)
        first = 0
        while first < len(out):
            # Pieces end with a word, so that memory follows the piece and not the text.
            last = max(first + 1, int(np.searchsorted(self.end, self.start[first] + CHUNK_BYTES, "right")))
            low, high = int(self.start[first]), int(self.end[last - 1])
            up, down = _POWERS.upto(high - low + 1)
            sums = np.zeros(high - low + 1, U64)
            np.cumsum(_BYTE_VALUES[self.data[low:high]] * up[: high - low], out=sums[1:])
            s, e = self.start[first:last] - low, self.end[first:last] - low
            out[first:last] = (sums[e] - sums[s]) * down[s]
            first = last
        return mix(out + (self.end - self.start).astype(U64))


def words_of(texts: pa.Array, word_bytes: np.ndarray = NOT_SPACE) -> Words:
    """The lower-cased words of an array of texts; a null has none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    data = _LOWER[np.frombuffer(data, np.uint8)[low:high]] if high > low else np.zeros(0, np.uint8)
    offsets = offsets - low
    inside = word_bytes[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return Words(data, offsets, start, end, np.searchsorted(offsets, start, "right") - 1)


def chunks(batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``size`` bytes of text each, or one row; empty batches are left out."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0)
        total = np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))])
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(total, total[first] + size, "right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def segment_starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    changed = np.ones(len(keys[0]), bool)
    if len(changed):
        changed[1:] = False
        for key in keys:
            changed[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(changed)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
