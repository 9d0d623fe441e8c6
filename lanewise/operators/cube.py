"""Whole-day counts of many groupings from one scan of the rows.

A stage has a dozen tables over the same few columns. Each row is listed once per grouping and
counted in its task, so only one row per (grouping, keys, day) is shuffled and kept, as files in
a folder per grouping. Tables then read the folder of their grouping. The number of counts is
bounded by the keys and the calendar, not by the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.functions.expressions import sql_name
from lanewise.operators.sharing import kept

Grouping = tuple[str, ...]


@dataclass(frozen=True)
class DayCube:
    """Counts ``(grouping, key_0, key_1, ..., day, n)``; keys of the cube are text."""

    counts: DataFrame
    groupings: Mapping[Grouping, int]
    types: Mapping[str, T.DataType]
    days: str

    def rows(self, *keys: str) -> DataFrame:
        """``(keys, days, n)``: the rows as counts, unknown keys and days included.

        Operators take it in place of the rows themselves, with ``weight="n"``.
        """
        own = self.counts.where(F.col("grouping") == self.groupings[keys])
        return own.select(
            *[F.col(f"key_{i}").cast(self.types[key]).alias(key) for i, key in enumerate(keys)],
            F.col("day").cast(self.types[self.days]).alias(self.days), "n",
        )

    def known(self, key: str) -> DataFrame:
        """``(key, days, n)`` of rows whose key and day are known, as ``metrics.day_counts``."""
        return self.rows(key).where(
            F.col(sql_name(key)).isNotNull() & F.col(sql_name(self.days)).isNotNull())

    def stacked(self) -> DataFrame:
        """``(segment, days, n)`` of the cube's segments."""
        own = self.counts.where(F.col("grouping") == len(self.groupings))
        return own.select(F.col("key_0").alias("segment"), F.col("day").alias("days"), "n")


def day_cube(
    df: DataFrame,
    groupings: Sequence[Grouping],
    days: str = "delay_days",
    segments: Sequence[str] = (),
    keys: Mapping[str, Column] | None = None,
) -> DayCube:
    """Counts of ``days`` (whole days) under each grouping, and of each segment's own days.

    A grouping is a tuple of columns of simple types; the empty one counts all rows. ``keys``
    replaces a column by an expression, such as a month in place of a date. Unknown keys and days
    are counted too, but for segments. An empty table gives empty counts.
    """
    named = df.select(*[
        (keys[name] if name in (keys or {}) else F.col(sql_name(name))).alias(name)
        for name in dict.fromkeys([*(k for g in groupings for k in g), days, *segments])
    ])
    width = max([1, *map(len, groupings)])

    def listed(number: int, values: Sequence[Column], day: Column) -> Column:
        texts = [v.cast("string") for v in values]
        texts += [F.lit(None).cast("string")] * (width - len(texts))
        return F.struct(
            F.lit(number).alias("grouping"), day.cast("int").alias("day"),
            *[text.alias(f"key_{i}") for i, text in enumerate(texts)],
        )

    day = F.col(sql_name(days))
    entries = [
        listed(number, [F.col(sql_name(key)) for key in grouping], day)
        for number, grouping in enumerate(groupings)
    ]
    entries += [
        listed(len(groupings), [F.lit(segment)], F.col(sql_name(segment))) for segment in segments
    ]
    names = ["grouping", *[f"key_{i}" for i in range(width)], "day"]
    counts = (
        named.select(F.inline(F.array(*entries)))
        .where((F.col("grouping") < len(groupings)) | F.col("day").isNotNull())
        .groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    )
    return DayCube(
        kept(counts, "day-cube", by=["grouping"]),
        {tuple(grouping): number for number, grouping in enumerate(groupings)},
        {field.name: field.dataType for field in named.schema.fields}, days,
    )
