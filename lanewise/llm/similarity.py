"""Exact Jaccard links inside groups of candidate sets, tile by tile."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.staging import shuffle_width
from lanewise.llm.text import U64, mix

#: Members of one side of a tile, and their tokens; a larger group is dealt to several tiles.
TILE, TILE_TOKENS = 1024, 500_000
#: Salts of the token orders that a pair has to pass before it is verified.
ORDERS = (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0xCBBB9D5DC1059ED8)
_COLUMNS = 4096


def prefix_length(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Of any order of its tokens, how many first ones a set must share one of to link."""
    return n - -(-n * percent // 100) + 1


def _overlaps(left: Sequence[np.ndarray], right: Sequence[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as products of 0/1 matrices over some columns at a time."""
    sets = [*left, *right]
    sizes = [len(s) for s in sets]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    if not sum(sizes):
        return out
    tokens, column, seen = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    row = np.repeat(np.arange(len(sets)), sizes)
    shared = seen[column] > 1
    row, column = row[shared], column[shared]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    dense = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]])) if len(column) else column
    for start in range(0, int(dense[-1]) + 1 if len(dense) else 0, _COLUMNS):
        a, b = np.searchsorted(dense, [start, start + _COLUMNS])
        some = np.zeros((len(sets), _COLUMNS), dtype=np.float32)
        some[row[a:b], dense[a:b] - start] = 1
        out += some[:len(left)] @ some[len(left):].T
    return out


def linked(
    left: Sequence[np.ndarray], right: Sequence[np.ndarray], percent: int
) -> np.ndarray:
    """Which pairs have 100 * intersection >= percent * union.

    A pair is a candidate only if it shares a prefix token under each of several token orders;
    overlaps are then counted between sets that have a candidate.
    """
    n = np.array([len(s) for s in left], dtype=np.int64)[:, None]
    m = np.array([len(s) for s in right], dtype=np.int64)[None, :]
    may = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (n > 0) & (m > 0)
    for salt in ORDERS:
        if not may.any():
            return may
        may &= _overlaps(
            [_prefix(s, salt, percent) for s in left], [_prefix(s, salt, percent) for s in right]
        ) > 0
    rows, columns = np.flatnonzero(may.any(axis=1)), np.flatnonzero(may.any(axis=0))
    if not len(rows):
        return may
    common = np.zeros(may.shape, dtype=np.int64)
    common[np.ix_(rows, columns)] = _overlaps([left[i] for i in rows], [right[j] for j in columns])
    return may & (100 * common >= percent * (n + m - common))


def _prefix(tokens: np.ndarray, salt: int, percent: int) -> np.ndarray:
    keep = prefix_length(len(tokens), percent)
    if keep >= len(tokens):
        return tokens
    return tokens[np.argpartition(mix(tokens ^ U64(salt)), keep)[:keep]]


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Links (row, column) that connect what all links of a square matrix connect."""
    fresh = np.ones(len(links), dtype=bool)
    out = []
    for root in range(len(links)):
        if not fresh[root]:
            continue
        fresh[root] = False
        reached = [root]
        while reached:
            at = reached.pop()
            more = np.flatnonzero(links[at] & fresh)
            fresh[more] = False
            out += [(at, int(x)) for x in more]
            reached += more.tolist()
    return out


LINK_SCHEMA = "a long, b long, links long"


def with_parts(
    members: DataFrame, tile: int = TILE, tile_tokens: int = TILE_TOKENS
) -> DataFrame:
    """``members`` (group, set_size, ...) with the number of parts their group is dealt into."""
    groups = members.groupBy("group").agg(
        F.greatest(
            F.lit(1), F.ceil(F.count("*") / F.lit(tile)),
            F.ceil(F.sum("set_size") / F.lit(tile_tokens)),
        ).cast("int").alias("parts")
    )
    return members.join(groups, "group")


def verified_links(sets: DataFrame, percent: int) -> DataFrame:
    """Links within groups: ``sets`` has group, parts (of the group), key, size, tokens.

    Returns (a, b, null) rows that span each tile's links and (a, null, links) rows that count
    the rows a key links with (``size`` each). Keys are distinct within a group. A group of
    several parts is dealt into them by a hash of the key, and each pair of parts is a tile;
    every pair of members meets in exactly one tile.
    """
    part = F.pmod(F.xxhash64("key", F.lit(11)), F.col("parts")).cast("int")
    dealt = (
        sets.withColumn("part", part)
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .select(
            "group", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
            "part", "key", "size", "tokens",
        )
    )

    def one_tile(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy()
        size = table.column("size").to_numpy()
        part = table.column("part").to_numpy()
        tokens = [np.frombuffer(x.as_py(), dtype=U64) for x in table.column("tokens")]
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        a, b = np.flatnonzero(part == i), np.flatnonzero(part == j)
        links = linked([tokens[x] for x in a], [tokens[x] for x in b], percent)
        square = np.zeros((len(keys), len(keys)), dtype=bool)
        square[np.ix_(a, b)] = links
        square |= square.T
        np.fill_diagonal(square, False)
        spans = forest(square)
        counts = square @ size
        some = np.flatnonzero(counts)
        return pa.table({
            "a": pa.array([*(keys[x] for x, _ in spans), *keys[some]], pa.int64()),
            "b": pa.array([*(keys[y] for _, y in spans), *[None] * len(some)], pa.int64()),
            "links": pa.array([*[None] * len(spans), *counts[some]], pa.int64()),
        })

    # A tile's work goes with the square of its rows, so tasks aren't merged by their bytes.
    dealt = dealt.repartition(shuffle_width(dealt), "group", "i", "j")
    return dealt.groupBy("group", "i", "j").applyInArrow(one_tile, LINK_SCHEMA)
