"""Vector codes against plain rounds; encoding along a trie against the library."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lanewise.llm import queries, vector_codes, word_trie
from lanewise.llm.text import texts_of
from tests.llm.fixtures import awkward, documents


def brute_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(vec_id, code, error, label_error, sha) of (vec_id, vector, label), by Python's integers."""
    kept = [
        (i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    if not kept:
        return []
    size = len(kept[0][1]) // parts
    cut = [[v[p * size:(p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    first = {}
    for (i, v, _), c in sorted(zip(kept, cut, strict=True),
                               key=lambda z: (z[0][0] is None, z[0][0] or 0, z[0][1])):
        first.setdefault(i, c)
    start = list(first.values())[:entries]
    books = [[c[p] for c in start] for p in range(parts)]

    def nearest():
        return [
            [min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), k)
                 for k, e in enumerate(books[p])) for p in range(parts)]
            for c in cut
        ]

    for _ in range(rounds):
        found = nearest()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, found, strict=True) if f[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = nearest()
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    sha = hashlib.sha256(flat.encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, _, label), e in zip(kept, errors, strict=True):
        total[label] = total.get(label, 0) + e
    return sorted(
        [(i, "".join(f"{k:02x}" for _, k in f), e, total[label], sha)
         for (i, _, label), f, e in zip(kept, found, errors, strict=True)], key=str)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, n long, error long"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def test_vector_codes_are_those_of_plain_rounds(spark):
    dice = random.Random(3)
    rows = [
        (k * 7 % 500, [dice.choice([-1.0, 0.0, 0.5]) + dice.gauss(0, 0.2 * (k % 3))
                       for _ in range(8)], [0, 1, None][k % 3])
        for k in range(500)
    ]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    rows += rows[:40]
    rows += [(900, None, 1), (901, [1.0] * 7 + [None], 1), (902, [float("nan")] * 8, 1),
             (903, [1.0] * 7 + [float("-inf")], 1), (None, [0.25] * 8, None), (-5, [0.0] * 8, 7),
             (-5, [-0.25] * 8, 7)]
    found = sorted(map(tuple, vector_codes.vector_codes(vectors(spark, rows)).collect()), key=str)
    assert found == brute_codes(rows)


def test_few_or_no_vectors(spark):
    assert vector_codes.vector_codes(vectors(spark, [(1, None, 1)])).collect() == []
    assert vector_codes.vector_codes(vectors(spark, [])).collect() == []
    rows = [(4, [1.0, 2.0, 3.0, -4.0], None), (4, [1.0, 2.0, 3.0, -4.0], None), (None, [0.5] * 4, 1)]
    found = sorted(map(tuple, vector_codes.vector_codes(vectors(spark, rows)).collect()), key=str)
    assert found == brute_codes(rows)
    other = vectors(spark, [*rows, (1, [1.0], 1), (2, [0.0] * 8, 1)])
    assert vector_codes.vector_codes(other).count() == 3


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 12), st.integers(1, 4), st.integers(0, 10**6),
       st.sampled_from([3, 1000, 1 << 26]))
def test_moved_entries_are_enough(n, entries, size, seed, most):
    dice = np.random.default_rng(seed)
    parts = dice.integers(-most, most, (n, size))
    book = dice.integers(-most, most, (entries, size))
    book[dice.integers(0, entries, entries // 3)] = book[0]
    everything = np.ones(entries, dtype=bool)
    code, distance = vector_codes.assign(parts, book, everything, None, None)
    moved = dice.random(entries) < 0.3
    book[moved] = dice.integers(-most, most, (int(moved.sum()), size))
    after = vector_codes.assign(parts, book, moved, code.astype(np.uint8), distance)
    plain = vector_codes.assign(parts, book, everything, None, None)
    exact = ((parts[:, None, :].astype(object) - book[None].astype(object)) ** 2).sum(2)
    assert (after[0] == plain[0]).all() and (after[1] == plain[1]).all()
    assert (exact.argmin(1) == plain[0]).all() and (exact.min(1) == plain[1]).all()


def test_too_large_components_are_refused():
    with pytest.raises(ArithmeticError):
        vector_codes.scaled(np.array([1e30]), 4)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.word_vocabulary())


@pytest.fixture(scope="module")
def encoder():
    return word_trie.Encoder(word_trie.vocabulary_of(queries.word_vocabulary()))


def encoded(encoder, texts):
    ids, bounds = encoder.encode(texts_of(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


SNIPPETS = [
    "'s", "'re", "'ll", "'", "''", "'d", " ", "\n", "the", "ing", "a", "É", "ß", "İ", "Ⱥ", "ɓ", "Ɓ",
    "1", "23", "²", "!", "!!", "漢字", "é", "<|endoftext|>", "<|", "<|startoftext|>", "\x00", "\x85",
    "\xa0", "Σ", "ΑΣ", "😀", "٣", "s", "ve", "tion", "</w>", "ª",
]


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(
    st.lists(st.sampled_from(SNIPPETS) | st.text(max_size=3), max_size=12).map("".join),
    max_size=5))
def test_ids_are_the_library_s(encoder, library, texts):
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoded(encoder, texts) == expected


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.text(alphabet="aehinorst", max_size=60), max_size=4))
def test_ids_of_words_with_many_merges(encoder, library, texts):
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoded(encoder, texts) == expected


def test_every_character(encoder, library):
    points = [chr(p) for p in [*range(0xD800), *range(0xE000, 0x30000, 7)]]
    texts = [f"a{c}b1{c}'s {c}" for c in points]
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoded(encoder, texts) == expected


def test_a_memory_that_overflows_forgets_nothing_needed(library, monkeypatch):
    from lanewise.llm import tokens

    monkeypatch.setattr(tokens, "PLACES", 8)
    monkeypatch.setattr(tokens, "HELD_IDS", 16)
    small = word_trie.Encoder(word_trie.vocabulary_of(queries.word_vocabulary()))
    for seed in range(20):
        dice = random.Random(seed)
        texts = [" ".join("".join(dice.choices("aeinst", k=3)) for _ in range(30))] * 2
        expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert encoded(small, texts) == expected


def test_prefixes_are_shared(encoder):
    trie = word_trie.Trie(encoder.vocabulary)
    asked = []
    trie.allowed = lambda a, b: asked.append((a, b)) or encoder.vocabulary.neighbours(a, b)
    trie.encode([b"internationalization"])
    alone = len(asked)
    trie.encode([b"internationalization", b"internationalizations", b"internationalized"])
    assert len(asked) - alone < 2 * alone


def test_word_trie_query(spark, library):
    rows = awkward()
    found = word_trie.word_trie(documents(spark, rows), queries.word_vocabulary()).collect()
    expected = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((
            i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    nothing = documents(spark, [])
    assert word_trie.word_trie(nothing, queries.word_vocabulary()).collect() == []


def test_another_vocabulary_without_word_ends(spark):
    from tokenizers import Tokenizer

    encoder = word_trie.Encoder(word_trie.vocabulary_of(queries.word_vocabulary()))
    with pytest.raises(ValueError):
        word_trie.Vocabulary('{"model": {"dropout": 0.1}, "added_tokens": []}')
    assert encoder.vocabulary.whole_buffers
    whole = Tokenizer.from_file(queries.word_vocabulary())
    encoder.vocabulary.whole_buffers = False
    texts = ["Plain words by the library's own splitter.", ""]
    expected = [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]
    assert encoded(encoder, texts) == expected
