"""BPE encoding and decoding of whole texts, word by word, over a trie of the distinct words.

The tokens of a word's prefix, but for the last one, are the tokens of a shorter prefix. So one
token per prefix is all that needs to be known: the last. The distinct words of a step are put
into a trie, and a depth-first walk finds the last token of each node from those of its
ancestors; what words share at their start is computed once. A word's ids are read off backwards
along its path.

Which token is last follows from one test of neighbours: two tokens may stand side by side if
no rule that joins them, or parts at their common border, applies before each part has gone
into a larger one. Exactly one token that spells the end of a prefix passes the test against the
last token of what stands before it.

Texts are lower-cased and split on whole buffers where they hold Latin letters, digits and
marks only; the library's own normalizer and splitter prepare all others. Distinct words
are remembered over the steps of a task, in arrays of a fixed size.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.text import Texts, _hashes, chunks
from lanewise.llm.tokens import Memory, _byte_letters

#: The normalizer and splitter that whole buffers can stand in for. Fixed values of the format.
NORMALIZER = {
    "type": "Sequence",
    "normalizers": [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
        {"type": "Lowercase"},
    ],
}
SPLITTER = {
    "type": "Sequence",
    "pretokenizers": [
        {
            "type": "Split",
            "pattern": {
                "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
            },
            "behavior": "Removed",
            "invert": True,
        },
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

#: The last character of a word is another symbol than the same one inside.
LAST = 0x200
#: A byte that UTF-8 never has stands before the number of a special token.
MARK = 0xFF

_LETTER, _NUMBER, _SPACE, _OTHER = range(4)
#: Characters below 0x250 stay as they are under NFC; in lower case they are below 0x300, but for
#: three that change their length.
_LONGER = (0x130, 0x23A, 0x23E)


def _kind(point: int) -> int:
    if point in (0x20, 0x85, 0xA0) or 0x09 <= point <= 0x0D:
        return _SPACE
    return {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(point))[0], _OTHER)


_KINDS = np.array([_kind(p) for p in range(0x300)], dtype=np.int8)
_LOWER = np.array(
    [p if p in _LONGER else ord(chr(p).lower()) for p in range(0x250)], dtype=np.int16
)


class Vocabulary:
    """The tables of a byte-level BPE vocabulary file of the tokenizers library.

    Its rules must be in the order in which they were learned (each part of a rule is a single
    symbol or made by an earlier rule, and no token is made twice), as trained vocabularies are.
    Others are refused, as are models with dropout, unknown tokens or continuing prefixes.
    """

    def __init__(self, text: str) -> None:
        config = json.loads(text)
        model = config["model"]
        for option in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback",
                       "ignore_merges"):
            if model.get(option):
                raise ValueError(f"a vocabulary with {option} isn't supported")
        if config.get("decoder"):
            raise ValueError("a vocabulary with a decoder isn't supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]
               for t in config["added_tokens"]):
            raise ValueError("special tokens that match by other rules than their text")
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.whole_buffers = (
            config["normalizer"] == NORMALIZER and config["pre_tokenizer"] == SPLITTER
            and all("<|" in token for token in self.special)
        )
        self.bare = json.dumps(config | {
            "model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": [],
            "truncation": None, "padding": None,
        })
        self.suffix = model.get("end_of_word_suffix") or ""
        by_id = {i: token for token, i in (self.ids | self.special).items()}
        self.tokens = [by_id.get(i, "") for i in range(max(by_id, default=-1) + 1)]
        rules = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        self._rules(rules)

    def _rules(self, rules: list[tuple[str, str]]) -> None:
        spelled, self.rank, self.parts = {}, {}, {}
        for letter in _byte_letters():
            spelled[self.ids[letter]] = letter
            last = self.ids[letter + self.suffix]
            if self.suffix:
                spelled[last] = chr(ord(letter) + LAST)
        for k, (left, right) in enumerate(rules):
            a, b, made = self.ids[left], self.ids[right], self.ids[left + right]
            if a not in spelled or b not in spelled or made in spelled:
                raise ValueError(f"rule {k} is out of order: {left} {right}")
            spelled[made] = spelled[a] + spelled[b]
            self.rank[a, b], self.parts[made] = k, (a, b)
        self.never = len(rules)
        #: What a token ends or starts with, each with the rank of the rule that takes it in.
        self.ends: dict[int, list[tuple[int, int]]] = {}
        self.starts: dict[int, list[tuple[int, int]]] = {}
        for token in spelled:
            self.ends[token] = self._border(token, 1)
            self.starts[token] = self._border(token, 0)
        #: Tokens that the rules really make out of their spelling.
        self.by_spelling = {
            s: token for token, s in spelled.items()
            if token not in self.parts or self._made(token)
        }
        by_end: dict[str, set[int]] = {}
        for spelling in self.by_spelling:
            if len(spelling) > 2:
                by_end.setdefault(spelling[-3:], {1, 2}).add(len(spelling))
        #: The lengths of tokens by their last three symbols, longest first; all may have 1 or 2.
        self.lengths = {end: tuple(sorted(found)[::-1]) for end, found in by_end.items()}

    def _border(self, token: int, side: int) -> list[tuple[int, int]]:
        found, until = [(token, self.never)], self.never
        while token in self.parts:
            until = self.rank[self.parts[token]]
            token = self.parts[token][side]
            found.append((token, until))
        return found

    def _joined(self, left: int, right: int, before: int) -> bool:
        """Whether some rule with a rank below ``before`` applies across the border of two tokens."""
        rank = self.rank
        for a, a_until in self.ends[left]:
            for b, b_until in self.starts[right]:
                k = rank.get((a, b), before)
                # Of one rule at two places, the left one is applied first.
                if k < before and k < a_until and k <= b_until:
                    return True
        return False

    def _made(self, token: int) -> bool:
        left, right = self.parts[token]
        return not self._joined(left, right, self.rank[left, right])

    def neighbours(self, left: int, right: int) -> bool:
        return not self._joined(left, right, self.never)


class Trie:
    """Encodes distinct words along a trie of them."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.letters = _byte_letters()
        self.suffix = bool(vocabulary.suffix)
        self.allowed = functools.lru_cache(maxsize=1 << 17)(vocabulary.neighbours)

    def symbols(self, word: bytes) -> str:
        spelled = word.decode("latin-1").translate(self.letters)
        return spelled[:-1] + chr(ord(spelled[-1]) + LAST) if self.suffix else spelled

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word; none is empty.

        The trie is its words in order, each with the length of the path that it shares with
        the one before: in this order a depth-first walk meets its nodes. ``last[d]`` is the
        last token of the path's first d + 1 symbols, so memory is bounded by the longest word.
        """
        by_spelling, allowed = self.vocabulary.by_spelling, self.allowed
        lengths, short = self.vocabulary.lengths, (2, 1)
        spelled = [self.symbols(word) for word in words]
        out: list[list[int]] = [[]] * len(words)
        path, last, size = "", [], []
        for k in sorted(range(len(words)), key=spelled.__getitem__):
            word = spelled[k]
            shared = _shared(path, word)
            del last[shared:], size[shared:]
            for depth in range(shared, len(word)):
                end = depth + 1
                for length in lengths.get(word[end - 3:end], short) if end > 2 else short:
                    if length > end:
                        continue
                    token = by_spelling.get(word[end - length:end])
                    if token is not None and (
                        length == end or allowed(last[depth - length], token)
                    ):
                        last.append(token)
                        size.append(length)
                        break
                else:
                    raise AssertionError("each prefix has a last token")
            path, depth, ids = word, len(word) - 1, []
            while depth >= 0:
                ids.append(last[depth])
                depth -= size[depth]
            out[k] = ids[::-1]
        return out


def _shared(a: str, b: str) -> int:
    """How many symbols two words have in common at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        middle = (low + n) // 2
        low, n = (middle, n) if a[low:middle] == b[low:middle] else (low, middle)
    return low


def simple(texts: Texts) -> np.ndarray:
    """Of each text: whether whole buffers can prepare it."""
    data = texts.data
    odd = data > 0xC9
    odd[:-1] |= (data[:-1] == 0xC9) & (data[1:] > 0x8F)
    for point in _LONGER:
        a, b = chr(point).encode()
        odd[:-1] |= (data[:-1] == a) & (data[1:] == b)
    odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
    before = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(odd, out=before[1:])
    return before[texts.bounds[1:]] == before[texts.bounds[:-1]]


def lowered(texts: Texts) -> Texts:
    """Simple texts in lower case."""
    data = texts.data.copy()
    upper = (data >= 0x41) & (data <= 0x5A)
    data[upper] += 32
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        point = _LOWER[((data[lead].astype(np.int16) & 31) << 6) | (data[lead + 1] & 63)]
        # They stay characters of two bytes.
        data[lead], data[lead + 1] = 0xC0 | (point >> 6), 0x80 | (point & 63)
    return Texts(data, texts.bounds)


def split(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, inside) of the words of lower-case simple texts; ``inside`` marks their bytes.

    A word is a run of letters, one number, a run of other characters, or an apostrophe with s,
    t, re, ve, m, ll or d after it, unless another character than a letter, number or white
    space comes before.
    """
    data, bounds = texts.data, texts.bounds
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    point = data.astype(np.int16)
    lead = np.flatnonzero(data >= 0xC0)
    point[lead] = ((point[lead] & 31) << 6) | (point[lead + 1] & 63)
    point[lead + 1] = point[lead]
    kind = _KINDS[point]
    edge = np.zeros(n + 3, dtype=bool)
    edge[bounds] = True
    opens = edge[:n].copy()
    opens[1:] |= kind[1:] != kind[:-1]
    opens |= (kind == _NUMBER) & ((data & 0xC0) != 0x80)
    quote = np.flatnonzero(data == 0x27)
    if len(quote):
        quote = quote[edge[quote] | (kind[quote - 1] != _OTHER)]
        follow = np.concatenate([data, np.zeros(2, dtype=np.uint8)])
        one, two = follow[quote + 1], follow[quote + 2]
        short = np.isin(one, [0x73, 0x74, 0x6D, 0x64]) & ~edge[quote + 1]
        long = ((two == 0x65) & ((one == 0x72) | (one == 0x76))) | ((one == 0x6C) & (two == 0x6C))
        long &= ~edge[quote + 1] & ~edge[quote + 2]
        opens[quote[short | long] + 1] = False
        after = np.concatenate([quote[short] + 2, quote[long] + 3])
        opens[after[after < n]] = True
    inside = kind != _SPACE
    run = np.flatnonzero(opens)
    end = np.append(run[1:], n)
    words = inside[run]
    return run[words], end[words], inside


class Encoder:
    """Ids of texts; one per task."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.trie = Trie(vocabulary)
        self.memory = Memory()
        self.bytes = {ord(c): chr(b) for b, c in enumerate(_byte_letters())}
        self.special = re.compile("|".join(
            f"({re.escape(s)})" for s in sorted(vocabulary.special, key=len, reverse=True)
        )) if vocabulary.special else None

    @functools.cached_property
    def library(self):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        return Tokenizer.from_str(self.vocabulary.bare)

    def _odd_words(self, text: str) -> list[bytes]:
        """The words of any text, prepared by the library; a special token is a marked word."""
        out: list[bytes] = []
        parts = self.special.split(text) if self.special else [text]
        for part in filter(None, parts):
            if part in self.vocabulary.special:
                out.append(bytes([MARK]) + str(self.vocabulary.special[part]).encode())
                continue
            normal = self.library.normalizer
            plain = normal.normalize_str(part) if normal else part
            for word, _ in self.library.pre_tokenizer.pre_tokenize_str(plain):
                out.append(word.translate(self.bytes).encode("latin-1"))
        return out

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text's)."""
        easy = simple(texts) if self.vocabulary.whole_buffers else np.zeros(len(texts), bool)
        if easy.all():
            return self._words(texts)
        spans = [texts.data[a:b] for a, b in zip(texts.bounds[:-1], texts.bounds[1:], strict=True)]
        out: list[np.ndarray] = [None] * len(texts)
        own, odd = np.flatnonzero(easy), np.flatnonzero(~easy)
        part = Texts(
            np.concatenate([spans[k] for k in own] or [texts.data[:0]]),
            np.cumsum([0, *(len(spans[k]) for k in own)]),
        )
        words = [self._odd_words(spans[k].tobytes().decode()) for k in odd]
        size = np.array([len(w) for of in words for w in of], dtype=np.int64)
        data = np.frombuffer(b"".join(w for of in words for w in of), dtype=np.uint8)
        end = np.cumsum(size)
        first = np.cumsum([0, *map(len, words)])
        for places, (ids, bounds) in (
            (own, self._words(part)),
            (odd, self._ids(data, end - size, end, np.ones(len(data), bool), first)),
        ):
            for k, low, high in zip(places, bounds[:-1], bounds[1:], strict=True):
                out[k] = ids[low:high]
        return np.concatenate(out), np.cumsum([0, *map(len, out)])

    def _words(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        texts = lowered(texts)
        start, end, inside = split(texts)
        return self._ids(texts.data, start, end, inside, np.searchsorted(start, texts.bounds))

    def _fresh(self, words: list[bytes]) -> list[list[int]]:
        marked = [w[:1] == bytes([MARK]) for w in words]
        ids = iter(self.trie.encode([w for w, m in zip(words, marked, strict=True) if not m]))
        return [
            [int(w[1:])] if m else next(ids) for w, m in zip(words, marked, strict=True)
        ]

    def _ids(
        self, data: np.ndarray, start: np.ndarray, end: np.ndarray, inside: np.ndarray,
        first: np.ndarray,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that follow each other; ``first`` has the bounds of texts, in words."""
        hashes = _hashes(data, inside, start, end)
        memory = self.memory
        place = memory.place(hashes)
        known = memory.keys[place] == hashes
        missing = np.flatnonzero(~known)
        different, at, inverse = np.unique(
            hashes[missing], return_index=True, return_inverse=True)
        # What is remembered is copied before new words may oust it.
        size, where = memory.size[place], memory.first[place]
        fresh = self._fresh([
            data[a:b].tobytes()
            for a, b in zip(start[missing[at]].tolist(), end[missing[at]].tolist(), strict=True)
        ])
        fresh_size = np.array([len(x) for x in fresh], dtype=np.int64)
        flat = np.concatenate([
            memory.ids[:memory.used],
            np.fromiter((i for x in fresh for i in x), np.uint32, int(fresh_size.sum())),
        ])
        size[missing] = fresh_size[inverse]
        where[missing] = (memory.used + np.cumsum(fresh_size) - fresh_size)[inverse]
        memory.add(different, fresh)
        before = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.arange(before[-1]) + np.repeat(where - before[:-1], size)]
        return ids, before[first]


def vocabulary_of(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded string) of each row's whole ``text``.

    ``vocabulary`` is the path of a vocabulary file that the driver can read; tasks get its
    tables, which have a fixed size. Ids are those of the tokenizers library without added
    special tokens, padding or truncation; marks of special tokens in a text give their ids, as
    there. ``decoded`` is made from the ids: the strings of their tokens, joined by one space.

    A null text is empty and has no ids; so has one of white space only. Rows keep their doc_id,
    null or repeated; other columns aren't read. No rows give no rows. Texts don't meet, so no
    row is shuffled. Two different words are taken for one with a chance of 2^-64 per pair.
    """
    tables = docs.sparkSession.sparkContext.broadcast(vocabulary_of(vocabulary))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tables.value)
        strings = pa.array(encoder.vocabulary.tokens)
        for batch, texts in chunks(batches):
            ids, bounds = encoder.encode(texts)
            offsets = pa.array(bounds, pa.int32())
            listed = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
            spelled = pa.ListArray.from_arrays(offsets, strings.take(pa.array(ids)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), listed, pc.binary_join(spelled, " ")],
                names=["doc_id", "ids", "decoded"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        rows, f"doc_id {kind}, ids array<int>, decoded string")


def word_trie(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``encode``: digests of ids and text."""
    return encode(docs, vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
