"""Token ids of whole texts, by a vocabulary of the tokenizers library.

A byte-level vocabulary splits a text into pieces before it merges bytes, and a piece's ids
depend on the piece alone. So the pieces of plain texts are found on whole buffers, and each
different piece is encoded by the library once per worker, as long as it is remembered. Texts
with anything unusual (apostrophes, marks of special tokens, controls, characters beyond Latin
letters) are encoded by the library as a whole. Other kinds of vocabulary always are.
"""

from __future__ import annotations

import os
import unicodedata

import numpy as np

from lanewise.llm.text import Texts, _hashes, separators

#: Places for pieces that a worker remembers, and ids it holds for them before it starts anew.
PLACES, HELD_IDS = 1 << 19, 1 << 21

_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
_SPECIAL = separators((0x00, 0x08), (0x0E, 0x1F), (0x27, 0x27), (0x7F, 0x7F), (0xCA, 0xFF))


def _kind(point: int) -> int:
    if point == 0x20 or 0x09 <= point <= 0x0D:
        return _SPACE
    category = unicodedata.category(chr(point))[0]
    return {"L": _LETTER, "N": _NUMBER}.get(category, _OTHER)


_KINDS = np.array([_kind(p) for p in range(0x280)], dtype=np.int8)


def plain(texts: Texts) -> np.ndarray:
    """Of each text: whether all its characters are of the range that ``pieces`` handles."""
    data = texts.data
    odd = _SPECIAL[data]
    odd[1:] |= (data[:-1] == 0xC2) & (data[1:] < 0xA1)
    odd[1:] |= (data[:-1] == 0xC9) & (data[1:] > 0x8F)
    odd[1:] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    before = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(odd, out=before[1:])
    return before[texts.bounds[1:]] == before[texts.bounds[:-1]]


def pieces(texts: Texts) -> np.ndarray:
    """Where each piece of plain texts starts: runs of letters, numbers or other characters, each
    with one blank before it; of white space before them all but the last character; a last
    one that is no blank."""
    data, bounds = texts.data, texts.bounds
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    point = data.astype(np.int16)
    lead = np.flatnonzero(data >= 0xC0)
    point[lead] = ((point[lead] & 31) << 6) | (point[lead + 1] & 63)
    point[lead + 1] = point[lead]
    kind = _KINDS[point]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    opens = edge[:-1].copy()
    opens[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(opens)
    end = np.append(run[1:], len(data))
    white = kind[run] == _SPACE
    starts = np.zeros(len(data), dtype=bool)
    solid = run[~white]
    blank = ~edge[solid] & (data[solid - 1] == 0x20)
    starts[solid - blank] = True
    run, end = run[white], end[white]
    closing = edge[end]
    several = end - run > 1
    starts[run[closing | several | (data[run] != 0x20)]] = True
    starts[end[~closing & several & (data[end - 1] != 0x20)] - 1] = True
    return np.flatnonzero(starts)


def _byte_letters() -> str:
    """The character by which a byte-level vocabulary writes each byte: itself if it is a visible
    one of Latin-1, else the next one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in visible else next(hidden)) for b in range(256))


class Memory:
    """Ids by the hash of a piece: each hash has one place, where a later piece ousts an earlier."""

    def __init__(self) -> None:
        self.keys = np.zeros(PLACES, dtype=np.uint64)
        self.first = np.zeros(PLACES, dtype=np.int64)
        self.size = np.zeros(PLACES, dtype=np.int64)
        self.ids = np.zeros(HELD_IDS, dtype=np.uint32)
        self.used = 0

    def place(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - PLACES.bit_length() + 1)).astype(np.int64)

    def add(self, hashes: np.ndarray, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each piece are held from now on: (first, number)."""
        size = np.array([len(x) for x in ids], dtype=np.int64)
        total = int(size.sum())
        if self.used + total > len(self.ids):
            self.keys[:] = 0
            self.used = 0
            if total > len(self.ids):
                self.ids = np.zeros(total, dtype=np.uint32)
        first = self.used + np.cumsum(size) - size
        self.ids[self.used:self.used + total] = np.fromiter(
            (x for piece in ids for x in piece), dtype=np.uint32, count=total)
        self.used += total
        at = self.place(hashes)
        self.keys[at], self.first[at], self.size[at] = hashes, first, size
        return first, size


class Encoder:
    """Encodes texts with a vocabulary file; one per task, remembering over a worker's tasks."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import __main__
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        kind = self.tokenizer.pre_tokenizer
        self.by_piece = isinstance(kind, pre_tokenizers.ByteLevel) and (
            not kind.add_prefix_space and kind.use_regex and self.tokenizer.normalizer is None
        )
        # The worker's main module outlives its tasks, which get their functions anew.
        held = vars(__main__).setdefault("remembered_pieces", {})
        if path not in held:
            held[path] = Memory()
        self.memory = held[path]
        self.letters = _byte_letters()

    @property
    def width(self) -> int:
        """Bytes an id needs."""
        return 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4

    def encode(self, texts: Texts) -> list[np.ndarray]:
        """The ids of each text."""
        simple = plain(texts) if self.by_piece else np.zeros(len(texts), dtype=bool)
        out: list[np.ndarray] = [None] * len(texts)
        odd = np.flatnonzero(~simple)
        strings = [
            texts.data[texts.bounds[i]:texts.bounds[i + 1]].tobytes().decode() for i in odd
        ]
        for i, ids in zip(odd, self._ids(strings), strict=True):
            out[i] = ids
        own = np.flatnonzero(simple)
        if len(own) == len(texts):
            part = texts
        else:
            spans = [texts.data[texts.bounds[i]:texts.bounds[i + 1]] for i in own]
            part = Texts(
                np.concatenate(spans) if spans else texts.data[:0],
                np.cumsum([0, *(len(s) for s in spans)]),
            )
        for i, ids in zip(own, self._by_piece(part), strict=True):
            out[i] = ids
        return out

    def _ids(self, strings: list[str]) -> list[np.ndarray]:
        return [
            np.array(e.ids, dtype=np.uint32)
            for e in self.tokenizer.encode_batch(strings, add_special_tokens=False)
        ]

    def _piece_ids(self, piece: bytes) -> list[int]:
        letters = piece.decode("latin-1").translate(self.letters)
        return [token.id for token in self.tokenizer.model.tokenize(letters)]

    def _by_piece(self, texts: Texts) -> list[np.ndarray]:
        start = pieces(texts)
        end = np.append(start[1:], len(texts.data))[:len(start)]
        hashes = _hashes(texts.data, np.ones(len(texts.data), dtype=bool), start, end)
        memory = self.memory
        place = memory.place(hashes)
        missing = np.flatnonzero(memory.keys[place] != hashes)
        different, at, inverse = np.unique(
            hashes[missing], return_index=True, return_inverse=True)
        data = texts.data.tobytes()
        fresh = [
            self._piece_ids(data[a:b])
            for a, b in zip(start[missing[at]].tolist(), end[missing[at]].tolist(), strict=True)
        ]
        # Read what is remembered before new pieces take places, or the memory starts anew.
        first, size = memory.first[place], memory.size[place]
        flat = memory.ids
        full = memory.used + sum(map(len, fresh)) > len(flat)
        if full:
            flat = flat[:memory.used].copy()
        new_first, new_size = memory.add(different, fresh)
        if full:
            new_first = new_first + len(flat)
            flat = np.concatenate([flat, memory.ids[:memory.used]])
        first[missing], size[missing] = new_first[inverse], new_size[inverse]
        before = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.arange(before[-1]) + np.repeat(first - before[:-1], size)]
        bounds = before[np.searchsorted(start, texts.bounds)]
        return [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
