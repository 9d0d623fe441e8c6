"""Mixing sources to target weights: raking of token masses, then sampling by document.

Documents fall into cells of source, language and topic. Iterative proportional fitting scales
the cells' token masses to target shares of each source, language and topic in turn until all
three hold. A cell's weight is its fitted mass over its tokens; each document is drawn with a
probability in proportion to it, so the expected tokens of the sample have the target marginals
as far as no probability reaches 1.

A topic is a cell of the space of word profiles: the signs of ``TOPIC_BITS`` sums, in which each
longer word counts for or against by a bit of its hash. It needs no training and is the same for
a text everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.llm.staging import written
from lanewise.llm.text import NOT_ALNUM, chunks, words_of

DIMENSIONS = ("source", "lang", "topic")
TOPIC_BITS = 3
TOPIC_WORD_BYTES = 4
#: Target shares go with a power of the present ones: 1 keeps them, 0 makes all levels equal.
POWERS = {"source": 0.7, "lang": 0.7, "topic": 0.5}
KEEP = 0.8
TOLERANCE, CYCLES = 1e-9, 200
#: Cells up to which a join broadcasts them; more are shuffled.
BROADCAST_ROWS = 50_000
ONE_TASK_CELLS = 200_000


def _profile(text: pa.Array) -> pa.Array:
    """Words of each text, and its topic."""
    counts, topics = [], []
    for _, texts in chunks([pa.RecordBatch.from_arrays([text], names=["text"])]):
        words = words_of(texts.lower(), NOT_ALNUM)
        long = words.end - words.start >= TOPIC_WORD_BYTES
        topic = np.zeros(len(texts), dtype=np.int64)
        for bit in range(TOPIC_BITS):
            sign = ((words.hash[long] >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) * 2 - 1
            total = np.bincount(words.text[long], weights=sign, minlength=len(texts))
            topic += (total > 0).astype(np.int64) << bit
        counts.append(words.counts.astype(np.int64))
        topics.append(topic)
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate(counts) if counts else [], pa.int64()),
         pa.array(np.concatenate(topics) if topics else [], pa.int64())],
        names=["n_tokens", "topic"],
    )


def profiled(docs: DataFrame) -> DataFrame:
    """row (all columns of ``docs``), source, lang ('' for null), topic, n_tokens."""
    measure = F.arrow_udf(_profile, "struct<n_tokens: long, topic: long>")
    level = {
        c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("")
        for c in ("source", "lang")
    }
    return docs.select(
        F.struct(*docs.columns).alias("row"), level["source"].alias("source"),
        level["lang"].alias("lang"), measure("text").alias("measured"),
    ).select("row", "source", "lang", F.col("measured.topic").cast("string").alias("topic"),
             "measured.n_tokens")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast behind a count; a larger side is left to a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """(level, target): shares that go with a power of the present ones."""
    levels = cells.groupBy(dimension).agg(F.pow(F.sum("tokens"), power).alias("size"))
    whole = levels.agg(F.sum("size").alias("whole")).scalar()
    return levels.select(dimension, (F.col("size") / whole).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``cells`` (source, lang, topic, tokens > 0) with mass: fitted shares of all tokens.

    ``targets`` has (level, target) for each dimension. Levels without a target or with a target
    of 0 get no mass. Targets of a dimension are scaled to those levels that have tokens. Where
    the targets contradict each other on the cells there are, the fit ends after ``CYCLES``.

    Cells are a summary of the corpus: up to ``ONE_TASK_CELLS`` are fitted in one task, more by
    a shuffle for each step. Both give the same masses.
    """
    wanted = cells
    for d in DIMENSIONS:
        here = targets[d].join(cells.select(d).distinct(), d, "left_semi").filter("target > 0")
        whole = here.agg(F.sum("target").alias("whole")).scalar()
        wanted = wanted.join(here.select(d, (F.col("target") / whole).alias(f"target_{d}")), d)
    wanted = written(wanted.withColumn("mass", F.col("tokens").cast("double")), "cells")
    if wanted.count() <= ONE_TASK_CELLS:
        fitted = wanted.repartition(1).mapInArrow(_fit, wanted.schema)
    else:
        fitted = _fit_by_shuffles(wanted)
    return fitted.drop(*(f"target_{d}" for d in DIMENSIONS))


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [batch for batch in batches if batch.num_rows]
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    mass = table.column("mass").to_numpy().copy()
    sides = []
    for d in DIMENSIONS:
        _, first, level = np.unique(
            np.array(table.column(d).to_pylist(), dtype=object).astype(str),
            return_index=True, return_inverse=True)
        sides.append((level, table.column(f"target_{d}").to_numpy()[first]))
    for _ in range(CYCLES):
        for level, target in sides:
            mass *= (target / np.bincount(level, weights=mass))[level]
        if max(np.abs(np.bincount(level, weights=mass) - t).max() for level, t in sides) < TOLERANCE:
            break
    place = table.column_names.index("mass")
    yield from table.set_column(place, "mass", pa.array(mass)).to_batches()


def _fit_by_shuffles(wanted: DataFrame) -> DataFrame:
    fitted = wanted
    for _ in range(CYCLES):
        for d in DIMENSIONS:
            now = fitted.groupBy(d).agg(F.sum("mass").alias("now"))
            fitted = fitted.join(now, d).withColumn(
                "mass", F.col("mass") * F.col(f"target_{d}") / F.col("now")).drop("now")
        fitted = written(fitted, "cells")
        gaps = [
            fitted.groupBy(d).agg(F.abs(F.sum("mass") - F.first(f"target_{d}")).alias("gap"))
            for d in DIMENSIONS
        ]
        gap = reduce(DataFrame.unionByName, (g.select("gap") for g in gaps))
        if (gap.agg(F.max("gap")).first()[0] or 0.0) < TOLERANCE:
            break
    return fitted.select(*wanted.columns)


def probabilities(cells: DataFrame, keep: float) -> DataFrame:
    """``cells`` with weight and probability, min(1, scale * weight).

    The scale is the one by which the expected tokens are a share ``keep`` of all; it is found
    by leaving out, again and again, the cells that reach 1, which only grow in number.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    cells = cells.withColumn("weight", F.col("mass") * F.lit(float(total)) / F.col("tokens"))
    scale = 0.0
    while True:
        full = F.col("weight") * scale >= 1
        spent, open_ = cells.agg(
            F.sum(F.when(full, F.col("tokens")).otherwise(0)),
            F.sum(F.when(full, 0).otherwise(F.col("tokens") * F.col("weight"))),
        ).first()
        after = (keep * total - (spent or 0)) / open_ if open_ else scale
        if after <= scale * (1 + 1e-12):
            break
        scale = after
    return cells.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * scale))


def mix(
    docs: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    keep: float = KEEP,
    seed: int = 5,
) -> DataFrame:
    """row (all columns of ``docs``), source, lang, topic, n_tokens, weight, probability, selected.

    ``docs`` has doc_id and text, source and lang (absent or null: the level ''). Without
    ``targets`` (a table of level and target share for each of source, lang and topic), shares
    go with ``POWERS`` of the present ones. Tokens are counted as words. A document without
    words carries no mass and isn't selected, with probability 0. Whether a row is drawn depends
    on a hash of its doc_id and text, so repeated rows are drawn alike, and a rerun draws the
    same. Empty tables give an empty result.
    """
    rows = profiled(docs)
    cells = written(
        rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")).filter("tokens > 0"),
        "cells",
    )
    if targets is None:
        targets = {d: tempered(cells, d, POWERS[d]) for d in DIMENSIONS}
    weights = written(probabilities(rake(cells, targets), keep), "weights").select(
        *(F.col(d).alias(f"cell_{d}") for d in DIMENSIONS), "weight", "probability"
    )
    chance = F.shiftrightunsigned(
        F.xxhash64("row.doc_id", "row.text", F.lit(seed)), 11
    ) / F.lit(float(1 << 53))
    own = (F.col("n_tokens") > 0)
    for d in DIMENSIONS:
        own = own & (F.col(d) == F.col(f"cell_{d}"))
    return rows.join(_small(weights), own, "left").select(
        "row", *DIMENSIONS, "n_tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"),
        F.coalesce("probability", F.lit(0.0)).alias("probability"),
    ).withColumn("selected", chance < F.col("probability"))
