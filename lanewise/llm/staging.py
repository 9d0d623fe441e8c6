"""Intermediate tables in the shared folder, key filters of fixed size, connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewise.operators.sharing import new_folder

FILTER_BITS = 1 << 23


def scratch(spark: SparkSession, name: str) -> str:
    """A new path on storage that the driver and all executors share; ``release`` removes it."""
    return new_folder(spark, name)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Executors delete the shuffle files of each step that ends in here, as its result is a
    table; else they stay until the driver's memory is cleaned, next to those of all later steps."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``written``, and the path for ``remove``."""
    path = scratch(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, read by any executor."""
    return written_at(df, name)[0]


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Bits of a key filter for each key, and of the largest filter (16 MB).
KEY_BITS, MOST_BITS = 16, 1 << 27


def key_bits(keys: DataFrame, column: str) -> np.ndarray:
    """A bitmap of a table's keys, which are hashes, for tasks to tell most other keys by.

    It has ``KEY_BITS`` bits for each key, at most ``MOST_BITS`` in all, a power of two. With far
    more keys it tells fewer apart; a join must follow in any case. Bits are set by a shuffle, so
    the driver gets the bitmap and not the keys.
    """
    n = keys.count()
    bits = min(MOST_BITS, 1 << max(16, (KEY_BITS * n - 1).bit_length() if n else 0))
    slot = F.col(column).bitwiseAND(F.lit(bits - 1))
    found = (
        keys.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).cast("int").alias("place"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("word")).toArrow()
    )
    out = np.zeros(bits >> 6, dtype=np.int64)
    out[found.column("place").to_numpy()] = found.column("word").to_numpy()
    return out.view(np.uint64)


def has_bit(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Of each 64-bit key: false only if it is none of the bitmap's keys."""
    slot = keys.view(np.uint64) & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(
        1) == 1


def maybe_keys(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Most rows of ``df`` whose key isn't in ``keys`` go, before they are shuffled; no other.

    A bitmap of hashed keys is broadcast as a table of at most ``FILTER_BITS`` / 64 rows of 64
    bits, whatever the number of keys. A join must follow, for the keys that only share a bit;
    with many more keys than bits the bitmap drops less, and that join does the rest.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))
    bits = (
        keys.select(slot.alias("slot"))
        .groupBy((F.col("slot") / 64).cast("int").alias("filter_word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("filter_bits"))
    )
    return (
        df.withColumn("filter_slot", slot)
        .withColumn("filter_word", (F.col("filter_slot") / 64).cast("int"))
        .join(F.broadcast(bits), "filter_word")
        .filter(F.expr("shiftrightunsigned(filter_bits, cast(filter_slot % 64 as int)) & 1 = 1"))
        .select(*df.columns)
    )


def _state(links: DataFrame) -> tuple[int, int | None]:
    """How many links there are, and a hash of the set of them."""
    return tuple(links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that the links (a, b) lead to; both sides are long.

    Large-star and small-star rounds: each node's neighbours move to the smallest one, which
    keeps components and shortens paths, in about log(n) rounds. A node's own edges are only
    counted and reduced to a minimum, never gathered in one row. Each round is written to the
    shared folder. Raises an error if ``max_rounds`` don't settle it.
    """
    links, last = written_at(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v").distinct(), "links",
    )
    state = _state(links)
    for _ in range(max_rounds):
        # Large star: larger neighbours of a node go to the least of the node and its neighbours.
        both = links.select("u", "v").union(links.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            links.select(F.col("v").alias("u"), F.col("u").alias("w"))
            .join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("v"))
        )
        # Small star: a node and its smaller neighbours go to the least of these.
        large = large.filter("u <> v").distinct()
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(floor, "u")
        small = (
            star.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(star.select("u", F.col("m")))
            .filter("u <> v").distinct()
        )
        after, path = written_at(small, "links")
        # A round needs the links of the one before only.
        remove(links.sparkSession, last)
        links, last, before, state = after, path, state, _state(after)
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
