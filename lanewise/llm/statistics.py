"""Counts over whole texts, a row per document, from one pass over the text buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.text import (
    U64, WHITE, Texts, Words, chunks, code_points, mix, separators, windows, words_of,
)

REPEAT_WINDOW = 8

NEWLINE = separators((0x0A, 0x0A))


def _bytes_of(characters: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(characters.encode())] = True
    return table


SYMBOLS = _bytes_of("#*$%&|<>")
UPPER = _bytes_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTERS = _bytes_of("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
DIGITS = _bytes_of("0123456789")
MARKS = _bytes_of("!?")
STOPS = _bytes_of(".,;:")
NON_ASCII = separators((0xC0, 0xFF))

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct_words", "n_upper", "n_letters", "n_digits", "n_marks", "n_stops", "n_non_ascii",
    "longest_word",
)
SCHEMA = "doc_id long, lang string, " + ", ".join(f"{c} long" for c in COUNTS)

#: Shares that don't depend on a text's length, as SQL over the counts; 0 for a text of no words.
SHARES = {
    "word_length": "word_chars / n_words",
    "symbol_share": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "distinct_share": "n_distinct_words / n_words",
    "upper_share": "n_upper / n_letters",
    "digit_share": "n_digits / word_chars",
    "mark_share": "n_marks / n_words",
    "stop_share": "n_stops / n_words",
    "line_words": "n_words / n_lines",
}


def share_columns() -> dict[str, F.Column]:
    out = {}
    for name, formula in SHARES.items():
        above, below = formula.split(" / ")
        out[name] = F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(0.0)
    return out


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), dtype=bool)
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[place] == keys


def _by_text(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Hashes that differ between texts."""
    return mix(hashes + mix(text.astype(U64)))


def duplicate_lines(texts: Texts, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Of each text: its lines with a word, and those of them that equal an earlier one."""
    lines = words_of(texts, NEWLINE)
    filled = np.searchsorted(words.start, lines.start) < np.searchsorted(words.start, lines.end)
    text = lines.text[filled]
    keys = _by_text(lines.hash[filled], text)
    _, firsts = np.unique(keys, return_index=True)
    n = np.bincount(text, minlength=len(texts))
    return n, n - np.bincount(text[firsts], minlength=len(texts))


def repeated_words(texts: Texts, words: Words, size: int = REPEAT_WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of ``size`` words found twice in the text."""
    at, hashes = windows(words, size)
    at = at[_repeated(_by_text(hashes, words.text[at]))]
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + size, -1)
    inside = np.cumsum(cover)[:-1] > 0
    return np.bincount(words.text[inside], minlength=len(texts))


def statistics(texts: Texts) -> list[np.ndarray]:
    """The columns of ``COUNTS``."""
    words = words_of(texts, WHITE)
    points = code_points(texts)
    length = points[words.end] - points[words.start]
    n = len(texts)
    longest = np.zeros(n, dtype=np.int64)
    np.maximum.at(longest, words.text, length)
    n_lines, n_dup = duplicate_lines(texts, words)
    _, firsts = np.unique(_by_text(words.hash, words.text), return_index=True)
    return [
        words.counts,
        np.bincount(words.text, weights=length, minlength=n).astype(np.int64),
        texts.count(SYMBOLS), n_lines, n_dup, repeated_words(texts, words),
        np.bincount(words.text[firsts], minlength=n),
        texts.count(UPPER), texts.count(LETTERS), texts.count(DIGITS), texts.count(MARKS),
        texts.count(STOPS), texts.count(NON_ASCII), longest,
    ]


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang and ``COUNTS`` of each row of ``docs``; a null text counts as empty."""
    kept = docs.select("doc_id", F.col("lang") if "lang" in docs.columns
                       else F.lit(None).cast("string").alias("lang"), "text")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in chunks(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()),
                 *(pa.array(c, pa.int64()) for c in statistics(texts))],
                names=["doc_id", "lang", *COUNTS],
            )

    return kept.mapInArrow(rows, SCHEMA)


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """(doc_id, label) with one row per document; among several labels the least counts."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(name).alias("label"))
        .filter("doc_id is not null and label is not null")
        .groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    )
