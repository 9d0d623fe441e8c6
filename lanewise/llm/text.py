"""Words, shingles and windows of Arrow string columns, computed on whole buffers.

Texts stay UTF-8 bytes: every separator that the operators use is ASCII, so splitting bytes
splits characters. A word is known by a 64-bit hash of its bytes; a run of words by a hash of
its word hashes. Hashes depend on nothing but the bytes, so tasks agree on them. Two different
words, shingles or windows collide with probability of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text of one step; arrays of its words take some fifty times as much for a moment.
CHUNK_BYTES = 1 << 19

U64 = np.uint64
_MASK = (1 << 64) - 1


def _stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers (a splitmix64 sequence)."""
    return mix(U64(seed) + np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = _stream(1, 256)
_PLACE = _stream(2, 1 << 12) | U64(1)
_STEP = _stream(3, 64) | U64(1)


def _places(n: int) -> np.ndarray:
    return _PLACE[:n] if n <= len(_PLACE) else _stream(2, n) | U64(1)


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of bytes, true for those inside the given ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Words are runs of other bytes than these.
WHITE = separators((0x20, 0x20), (0x09, 0x0D))
#: After lower-casing: ASCII letters, digits and all non-ASCII characters make words.
NOT_ALNUM = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Texts:
    """The bytes of some texts: text i is ``data[bounds[i]:bounds[i + 1]]``."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def lower(self) -> Texts:
        """A-Z as a-z."""
        return Texts(_LOWER[self.data], self.bounds)

    def count(self, table: np.ndarray) -> np.ndarray:
        """How many bytes of each text the table holds."""
        before = np.zeros(len(self.data) + 1, dtype=np.int64)
        np.cumsum(table[self.data], out=before[1:])
        return before[self.bounds[1:]] - before[self.bounds[:-1]]


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """A string column's buffers; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return Texts(np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64))
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(held[bounds[0]:bounds[-1]], bounds - bounds[0])


def chunks(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batches in slices of about ``size`` bytes of text; a longer text is a slice alone."""
    for batch in batches:
        texts = texts_of(batch.column(batch.schema.get_field_index(column)))
        start, n = 0, len(texts)
        while start < n:
            end = int(np.searchsorted(texts.bounds, texts.bounds[start] + size, side="right")) - 1
            end = min(max(end, start + 1), n)
            low, high = texts.bounds[start], texts.bounds[end]
            yield batch.slice(start, end - start), Texts(
                texts.data[low:high], texts.bounds[start:end + 1] - low
            )
            start = end
        # Else the pool of a worker that is used again keeps what its largest batch took.
        del batch, texts
        pa.default_memory_pool().release_unused()


@dataclass
class Words:
    """Words in text order. ``first[i]:first[i + 1]`` are those of text i."""

    text: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.hash)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(texts: Texts, separator: np.ndarray) -> Words:
    """The maximal runs of bytes that are no separators; none crosses the end of a text."""
    inside = ~separator[texts.data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    heads = texts.bounds[:-1][texts.bounds[:-1] < texts.bounds[1:]]
    opens[heads] = inside[heads]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    tails = heads[1:] - 1
    closes[tails] = inside[tails]
    tails = texts.bounds[-1:][: len(heads)] - 1
    closes[tails] = inside[tails]
    start = np.flatnonzero(opens)
    end = np.flatnonzero(closes) + 1
    first = np.searchsorted(start, texts.bounds)
    text = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(first))
    return Words(text, _hashes(texts.data, inside, start, end), start, end, first)


def _hashes(data: np.ndarray, inside: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.zeros(0, dtype=U64)
    length = end - start
    held = data[inside]
    before = np.cumsum(length) - length
    place = np.arange(len(held), dtype=np.int64) - np.repeat(before, length)
    parts = _BYTE[held] * _places(int(length.max()))[place]
    return mix(np.add.reduceat(parts, before) + length.astype(U64))


def spans_hash(texts: Texts, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of whole byte spans that follow each other without overlap."""
    inside = np.zeros(len(texts.data) + 1, dtype=np.int8)
    np.add.at(inside, start, 1)
    np.add.at(inside, end, -1)
    return _hashes(texts.data, np.cumsum(inside)[:-1].astype(bool), start, end)


def windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every ``size`` consecutive words of one text."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=U64)
    total = words.hash[:n] * _STEP[0]
    for k in range(1, size):
        total += words.hash[k:n + k] * _STEP[k % 64]
    at = np.flatnonzero(words.text[:n] == words.text[size - 1:])
    return at, mix(total[at] + U64(size))


def short_windows(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash of all words) of the texts with 1 to ``size`` - 1 words."""
    counts = words.counts
    texts = np.flatnonzero((counts > 0) & (counts < size))
    at, n = words.first[:-1][texts], counts[texts]
    total = np.zeros(len(texts), dtype=U64)
    for k in range(size - 1):
        more = n > k
        total[more] += words.hash[at[more] + k] * _STEP[k % 64]
    return at, mix(total + n.astype(U64))


def shingle_sets(words: Words, size: int) -> list[np.ndarray]:
    """Of each text the sorted distinct shingles; a shorter one is its only shingle."""
    at, hashes = windows(words, size)
    short, alone = short_windows(words, size)
    if len(short):
        order = np.argsort(np.concatenate([at, short]), kind="stable")
        at = np.concatenate([at, short])[order]
        hashes = np.concatenate([hashes, alone])[order]
    bounds = np.searchsorted(at, words.first)
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def code_points(texts: Texts) -> np.ndarray:
    """Code points before each byte position, and in all at the end."""
    before = np.zeros(len(texts.data) + 1, dtype=np.int64)
    np.cumsum((texts.data & 0xC0) != 0x80, out=before[1:])
    return before
