"""Benchmark passages in documents: a prefix-filtered join of word windows.

An item counts as its windows of ``WINDOW`` consecutive words; a shorter item is one window. A
window is a sequence of shingles that must all occur for it to occur, so any one of them will do
as its prefix token: the one that is rarest among the documents. Documents are searched for
these tokens only. A match at a position tells where the window would begin; it must fit into
the document (length and positional bounds), and then all its words are compared.

Shingles, counts and tokens of the benchmark are broadcast in blocks of at most about
``BLOCK_BYTES`` of its text; a larger benchmark takes several passes over the documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.staging import written
from lanewise.llm.text import (
    NOT_ALNUM, U64, Words, chunks, mix, short_windows, texts_of, windows, words_of,
)

WINDOW = 10
SHINGLE = 5
BLOCK_BYTES = 8 << 20


@dataclass
class Block:
    """Distinct windows of some items, sorted by the number of words.

    ``words[w, :length[w]]`` are hashes; ``items[item_first[w]:item_first[w + 1]]`` its items.
    """

    words: np.ndarray
    length: np.ndarray
    items: np.ndarray
    item_first: np.ndarray


def item_windows(ids: list[str], column: pa.Array, size: int) -> Block:
    texts = texts_of(column).lower()
    words = words_of(texts, NOT_ALNUM)
    at, hashes = windows(words, size)
    short, short_hashes = short_windows(words, size)
    at, hashes = np.concatenate([at, short]), np.concatenate([hashes, short_hashes])
    length = np.minimum(size, words.first[1:] - words.first[:-1])[words.text[at]]
    _, one, window = np.unique(hashes, return_index=True, return_inverse=True)
    rows = np.zeros((len(one), size), dtype=U64)
    for k in range(size):
        has = length[one] > k
        rows[has, k] = words.hash[at[one[has]] + k]
    pairs = np.unique(np.stack([window, words.text[at]], axis=1), axis=0) if len(at) else (
        np.zeros((0, 2), dtype=np.int64))
    return Block(
        rows, length[one], np.array(ids, dtype=object)[pairs[:, 1]],
        np.searchsorted(pairs[:, 0], np.arange(len(one) + 1)),
    )


def block_shingles(block: Block, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, number of words, window, offset) of the shingles of each window."""
    out = []
    for n in np.unique(block.length):
        own = np.flatnonzero(block.length == n)
        k = int(min(size, n))
        flat = block.words[own, :n].reshape(-1)
        text = np.repeat(np.arange(len(own), dtype=np.int32), n)
        words = Words(text, flat, text, text, np.arange(len(own) + 1) * n)
        at, hashes = windows(words, k)
        out.append((hashes, np.full(len(at), k), own[text[at]], at % n))
    if not out:
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(U64), empty, empty, empty
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``wanted``, places in the sorted ``keys``) of the values that both have."""
    if not len(keys) or not len(wanted):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    bits = np.zeros(1 << 20, dtype=bool)
    bits[(keys >> U64(44)).astype(np.int64)] = True
    some = np.flatnonzero(bits[(wanted >> U64(44)).astype(np.int64)])
    place = np.minimum(np.searchsorted(keys, wanted[some]), len(keys) - 1)
    equal = keys[place] == wanted[some]
    return some[equal], place[equal]


def occurrences(docs: DataFrame, keys: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """How often each shingle of the benchmark occurs in the documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros(len(x), dtype=np.int64) for k, x in keys.items()}
        for _, texts in chunks(batches):
            words = words_of(texts.lower(), NOT_ALNUM)
            for k, known in keys.items():
                _, place = _find(known, windows(words, k)[1])
                total[k] += np.bincount(place, minlength=len(known))
        for k, counts in total.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), k), pa.int32()), pa.array(some, pa.int64()),
                 pa.array(counts[some], pa.int64())], names=["k", "place", "n"],
            )

    found = (
        docs.select("text").mapInArrow(rows, "k int, place long, n long")
        .groupBy("k", "place").agg(F.sum("n").alias("n")).toArrow()
    )
    out = {k: np.zeros(len(x), dtype=np.int64) for k, x in keys.items()}
    size = found.column("k").to_numpy()
    for k in out:
        own = size == k
        out[k][found.column("place").to_numpy()[own]] = found.column("n").to_numpy()[own]
    return out


Tokens = dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def prefix_tokens(docs: DataFrame, block: Block, size: int) -> Tokens:
    """By number of words: sorted tokens, and for each match the windows and offsets to try.

    A window whose rarest shingle occurs nowhere is left out; so can't occur itself.
    """
    hashes, words, window, offset = block_shingles(block, size)
    keys = {int(k): np.unique(hashes[words == k]) for k in np.unique(words)}
    counts = occurrences(docs, keys)
    often = np.zeros(len(hashes), dtype=np.int64)
    for k, known in keys.items():
        own = words == k
        often[own] = counts[k][np.searchsorted(known, hashes[own])]
    order = np.lexsort((hashes, often, window))
    first = order[np.concatenate([[True], np.diff(window[order]) > 0])[:len(order)]]
    first = first[often[first] > 0]
    out = {}
    for k in keys:
        own = first[words[first] == k]
        own = own[np.argsort(hashes[own], kind="stable")]
        tokens, start = np.unique(hashes[own], return_index=True)
        out[k] = (tokens, np.append(start, len(own)), window[own], offset[own])
    return out


def _spread(first: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place its whole range in a list of ranges: (which place, entry)."""
    n = first[place + 1] - first[place]
    which = np.repeat(np.arange(len(place)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + first[place][which]


def search(words: Words, block: Block, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every occurrence."""
    starts, found = [], []
    for k, (known, first, window, offset) in tokens.items():
        at, hashes = windows(words, k)
        some, place = _find(known, hashes)
        which, entry = _spread(first, place)
        begin, candidate = at[some][which] - offset[entry], window[entry]
        text = words.text[at[some][which]]
        length = block.length[candidate]
        fits = (begin >= words.first[text]) & (begin + length <= words.first[text + 1])
        begin, candidate, length = begin[fits], candidate[fits], length[fits]
        same = np.ones(len(begin), dtype=bool)
        for j in range(block.words.shape[1]):
            more = np.flatnonzero(same & (length > j))
            same[more] = words.hash[begin[more] + j] == block.words[candidate[more], j]
        starts.append(begin[same])
        found.append(candidate[same])
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(starts), np.concatenate(found)


HITS = "doc_id long, text_key long, n_words long, hits array<int>, items array<string>"


def _hits(docs: DataFrame, block: Block, tokens: Tokens, every: bool) -> DataFrame:
    """The words hit in each document, as [from, to, from, to ...], and the items that occur."""
    held = docs.sparkSession.sparkContext.broadcast(
        ((block.words, block.length, block.items, block.item_first), tokens)
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, tokens = held.value
        block = Block(*parts)
        for batch, texts in chunks(batches):
            words = words_of(texts.lower(), NOT_ALNUM)
            start, window = search(words, block, tokens)
            cover = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(cover, start, 1)
            np.add.at(cover, start + block.length[window], -1)
            hit = np.cumsum(cover)[:-1] > 0
            text = words.text[start]
            items: list[list[str]] = [[] for _ in range(len(texts))]
            which, entry = _spread(block.item_first, window)
            for t, item in set(zip(text[which].tolist(), block.items[entry], strict=True)):
                items[t].append(item)
            ranges: list[list[int]] = [[] for _ in range(len(texts))]
            for t in np.unique(text):
                low, high = words.first[t], words.first[t + 1]
                edges = np.diff(np.concatenate([[False], hit[low:high], [False]]).astype(np.int8))
                ranges[t] = np.flatnonzero(edges).tolist()
            keys = [0] * len(texts) if every else _text_keys(words, len(texts))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(keys, pa.int64()), pa.array(words.counts, pa.int64()),
                pa.array(ranges, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string())),
            ], names=[x.split()[0] for x in HITS.split(", ")])

    return docs.mapInArrow(rows, HITS)


def _text_keys(words: Words, n: int) -> list[int]:
    """A number of each text's words: rows of one id and equal words have equal hits."""
    place = np.arange(len(words), dtype=np.int64) - words.first[words.text]
    out = np.zeros(n, dtype=U64)
    np.add.at(out, words.text, mix(words.hash + mix(place.astype(U64))))
    return out.view(np.int64).tolist()


RESULT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
    "contaminated boolean, hits array<int>, items array<string>"
)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Which words of each row of ``docs`` lie in an occurrence of a window of an item.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text; other columns are ignored.
    Words are runs of ASCII letters and digits, A-Z lower-cased, and non-ASCII characters.
    Returns doc_id, n_words, n_hit, n_items, items_sha256 (of the ids as strings, sorted and
    comma-joined; of the empty string without any), contaminated (n_hit > 0), and hits (word
    ranges [from, to, ...]) and items. A null text has no words, and an item without words no
    window. Items of one id count once, as do those with a null id, which the list of ids leaves out.
    Repeated rows stay.
    An empty benchmark hits nothing; empty documents give an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter(
        "text is not null"
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total / block_bytes) + 1
    parts = []
    for k in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).toArrow()
        block = item_windows(own.column(0).to_pylist(), own.column(1), size)
        parts.append(_hits(docs, block, prefix_tokens(docs, block, SHINGLE), n == 1))
    hits = parts[0]
    if n > 1:
        found = written(_union(parts), "hits").filter("size(hits) > 0").groupBy(
            "doc_id", "text_key"
        ).agg(F.flatten(F.collect_list("hits")).alias("hits"),
              F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
        hits = parts[0].drop("hits", "items").join(
            found.withColumnRenamed("doc_id", "found_id").withColumnRenamed("text_key", "found_key"),
            F.expr("doc_id <=> found_id and text_key = found_key"), "left",
        ).select("doc_id", "text_key", "n_words", "hits", "items")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = [_merged(x or []) for x in batch.column(3).to_pylist()]
            items = [sorted(set(x or []), key=lambda i: (i is None, i)) for x in batch.column(4).to_pylist()]
            n_hit = [sum(x[1::2]) - sum(x[::2]) for x in merged]
            listed = [",".join(i for i in x if i is not None) for x in items]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), pa.array(n_hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed]),
                pa.array([x > 0 for x in n_hit], pa.bool_()),
                pa.array(merged, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string())),
            ], names=[x.split()[0] for x in RESULT.split(", ")])

    return hits.mapInArrow(rows, RESULT)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.union(frame)
    return out


def _merged(ranges: list[int]) -> list[int]:
    """Ranges [from, to, ...] joined where they meet or overlap."""
    out: list[int] = []
    for low, high in sorted(zip(ranges[::2], ranges[1::2], strict=True)):
        if out and low <= out[-1]:
            out[-1] = max(out[-1], high)
        else:
            out += [low, high]
    return out


ORACLE_SQL = """
WITH doc_words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
    list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
    array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM item_words WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS t
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM doc_words, sizes WHERE len(w) >= size)
), found AS (
  SELECT d.doc_id, d.i, d.size, m.item_id
  FROM doc_windows d JOIN item_windows m ON d.t = m.t AND d.size = m.size
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
  coalesce(n.n_items, 0) AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
