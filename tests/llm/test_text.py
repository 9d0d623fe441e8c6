from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lanewise.llm.statistics import COUNTS, statistics
from lanewise.llm.text import (
    NOT_ALNUM, WHITE, chunks, shingle_sets, texts_of, windows, words_of,
)

TEXTS = st.lists(st.one_of(st.none(), st.text(
    alphabet=st.sampled_from(list("abAB .,\n\t\r\x0b9é日#!")), max_size=40)), max_size=6)


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(texts, pa.string())
    for separator, pattern in ((WHITE, r"[^\x20\x09-\x0D]+"),
                               (NOT_ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        held = texts_of(column).lower()
        words = words_of(held, separator)
        found = [held.data[a:b].tobytes().decode() for a, b in zip(words.start, words.end)]
        low = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
        assert found == [w for t in low for w in re.findall(pattern, t)]
        assert words.counts.tolist() == [len(re.findall(pattern, t)) for t in low]


@given(TEXTS)
@settings(max_examples=100, deadline=None)
def test_equal_windows_have_equal_hashes(texts):
    held = texts_of(pa.array(texts, pa.string()))
    words = words_of(held, WHITE)
    named = [held.data[a:b].tobytes() for a, b in zip(words.start, words.end)]
    at, hashes = windows(words, 3)
    runs = [tuple(named[k:k + 3]) for k in at]
    assert len(set(runs)) == len(set(hashes.tolist())) == len(set(zip(runs, hashes.tolist())))
    sets = shingle_sets(words, 3)
    for k, s in enumerate(sets):
        own = [tuple(named[words.first[k]:words.first[k + 1]])] if 0 < words.counts[k] < 3 else [
            r for r, x in zip(runs, at) if words.text[x] == k]
        assert len(s) == len(set(own))


@given(TEXTS)
@settings(max_examples=150, deadline=None)
def test_statistics_equal_brute_force(texts):
    got = dict(zip(COUNTS, statistics(texts_of(pa.array(texts, pa.string())))))
    for k, text in enumerate(texts):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        runs = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
        inside = {i + j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(8)}
        assert got["n_words"][k] == len(words)
        assert got["word_chars"][k] == sum(map(len, words))
        assert got["n_symbols"][k] == len(re.findall(r"[#*$%&|<>]", text))
        assert got["n_lines"][k] == len(lines)
        assert got["n_dup_lines"][k] == len(lines) - len(set(lines))
        assert got["n_repeat_words"][k] == len(inside)
        assert got["n_distinct_words"][k] == len(set(words))
        assert got["longest_word"][k] == max(map(len, words), default=0)


def test_repeats_and_slices():
    text = "a b c d e f g h a b c d e f g h i"
    held = texts_of(pa.array([None, text, text]).slice(1))
    got = dict(zip(COUNTS, statistics(held)))
    assert got["n_repeat_words"].tolist() == [16, 16]
    batch = pa.RecordBatch.from_pydict({"text": pa.array([text, None, text, "", text])})
    parts = list(chunks([batch], size=40))
    assert [len(t) for _, t in parts] == [2, 2, 1]
    assert np.concatenate([words_of(t, WHITE).counts for _, t in parts]).tolist() == [
        17, 0, 17, 0, 17]
