"""Exact global order statistics, ranks and running totals without a one-task sort.

Values are split into buckets at approximate quantiles. A bucket is a pure function of the
value, so results never depend on how good the cuts are; only the balance of tasks does.
Each cut also gets a bucket of its own: a value that holds a large part of the rows sits
alone in an odd-numbered bucket, where order does not matter and rows can be spread freely.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewise.functions.expressions import sql_name
from lanewise.operators.sharing import kept, materialize

#: Most buckets of a column; their number goes with the rows, about ``ROWS_PER_BUCKET`` each.
BUCKETS = 1 << 16
MIN_BUCKETS = 8
ROWS_PER_BUCKET = 50_000
#: Rows that cuts are sought among; of more, a random share. Cuts decide balance, not results.
SAMPLE_ROWS = 5_000_000
_EVERYTHING = "_all"


def numeric_rows(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value is a number; ``value`` becomes double with one form of zero.

    Null and NaN both fail the comparison, which names the value only once: the filter is
    pushed down together with the expression the value is made of.
    """
    number = F.col(value).cast("double")
    return df.where(number <= F.lit(math.inf)).withColumn(value, number + F.lit(0.0))


def cut_points(df: DataFrame, value: str, buckets: int = BUCKETS) -> list[float]:
    """At most ``buckets - 1`` finite, distinct approximate quantiles, for ``n`` rows.

    The sketch is merged in one task, so it is taken of at most about ``SAMPLE_ROWS`` rows.
    """
    n = df.agg(F.count(value)).first()[0]
    buckets = min(buckets, max(MIN_BUCKETS, n // ROWS_PER_BUCKET))
    if n > SAMPLE_ROWS:
        df = df.sample(SAMPLE_ROWS / n, seed=1)
    steps = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    found = df.agg(
        F.expr(f"percentile_approx({sql_name(value)}, array({steps}), {10 * buckets})")
    ).first()[0]
    cuts: list[float] = []
    for cut in sorted({c for c in found or [] if math.isfinite(c)}):
        if not cuts or cut > math.nextafter(cuts[-1], math.inf):
            cuts.append(cut)
    return cuts or [0.0]


def with_bucket(df: DataFrame, value: str, cuts: Sequence[float]) -> DataFrame:
    """Add ``_bucket``: odd buckets hold exactly one value, even ones the gaps between cuts."""
    splits = [-math.inf]
    for cut in cuts:
        splits += [cut, math.nextafter(cut, math.inf)]
    placed = Bucketizer(
        splits=splits + [math.inf], inputCol=value, outputCol="_bucket", handleInvalid="keep"
    ).transform(df)
    return placed.withColumn("_bucket", F.col("_bucket").cast("int"))


def _is_single() -> Column:
    return F.col("_bucket") % 2 == 1


def with_spread(df: DataFrame, total: str) -> DataFrame:
    """Add ``_spread``: rows of a one-value bucket go to many tasks, others stay together.

    The more rows its ``total`` says, the more tasks.
    """
    tasks = F.greatest(F.lit(1), F.ceil(F.col(total) / F.lit(ROWS_PER_BUCKET))).cast("long")
    scattered = F.pmod(F.xxhash64(*df.columns), tasks)
    return df.withColumn("_spread", F.when(_is_single(), scattered).otherwise(F.lit(0)))


def _before(total: str, over) -> Column:
    earlier = over.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(total).over(earlier), F.lit(0))


def order_statistics(
    df: DataFrame,
    value: str,
    positions: Mapping[str, Column],
    by: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Exact order statistics per group, with n, mean, min and max from the same pass.

    ``positions`` maps an output name to a 0-based rank, written as an expression over the
    group size ``n``. ``sums`` are row expressions to add up per group. Rows without a
    number, or with a null key, are left out.

    The input is read once: keys, values and sums are kept, and later passes read those. Only
    counts per (group, bucket) and the rows of buckets that contain a wanted rank are
    shuffled. The cuts are global, so one group's share of one bucket is small even when
    the group holds most of the rows.
    """
    sums = dict(sums or {})
    keys = list(by) or [_EVERYTHING]
    rows = numeric_rows(df, value)
    for key in by:
        rows = rows.where(F.col(key).isNotNull())
    if not by:
        rows = rows.withColumn(_EVERYTHING, F.lit(0))
    rows = kept(
        rows.select(*keys, F.col(value).alias("_v"), *[c.alias(a) for a, c in sums.items()]),
        codec="zstd",
    )
    rows = with_bucket(rows, "_v", cut_points(rows, "_v", buckets))

    group = Window.partitionBy(*keys)
    counted = rows.groupBy(*keys, "_bucket").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_v").alias("_sum"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        *[F.sum(a).alias(a) for a in sums],
    )
    counted = kept(
        counted.select("*", F.sum("_n").over(group).alias("n"), _before("_n", group).alias("_start"))
    )
    summary = counted.groupBy(*keys).agg(
        F.sum("_n").alias("n"),
        (F.sum("_sum") / F.sum("_n")).alias("mean"),
        F.min("_min").alias("min"),
        F.max("_max").alias("max"),
        *[F.sum(a).alias(a) for a in sums],
    )

    asked = F.array(*[
        F.struct(F.lit(name).alias("name"), at.cast("long").alias("at"))
        for name, at in positions.items()
    ])
    start, count = F.col("_start"), F.col("_n")
    wanted = kept(
        counted.withColumn(
            "_asked",
            F.filter(asked, lambda a: (a["at"] >= start) & (a["at"] < start + count)),
        ).where(F.size("_asked") > 0).select(*keys, "_bucket", "_start", "_asked")
    )
    place = [*keys, "_bucket"]
    near = (
        rows.select(*place, "_v").join(wanted.select(*place), place, "left_semi")
        .groupBy(*place, "_v").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.sum("_n").over(Window.partitionBy(*place).orderBy("_v")))
        .join(wanted, place)
        .withColumn("_end", F.col("_start") + F.col("_upto"))
    )
    first, end = F.col("_end") - F.col("_n"), F.col("_end")
    found = near.select(
        *keys, "_v",
        F.explode(F.filter("_asked", lambda a: (a["at"] >= first) & (a["at"] < end))).alias("_hit"),
    ).groupBy(*keys).agg(*[
        F.max(F.when(F.col("_hit.name") == name, F.col("_v"))).alias(name) for name in positions
    ])
    result = summary.join(found, keys)
    return result if by else result.drop(_EVERYTHING)


def value_summary(
    df: DataFrame,
    value: str,
    quantiles: Mapping[str, float],
    by: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    buckets: int = BUCKETS,
    accuracy: int | None = None,
) -> DataFrame:
    """Per group: n, mean, min, max and exact linearly interpolated quantiles.

    With an ``accuracy`` the quantiles are Spark's approximate ones, off by a rank share of
    1 / ``accuracy`` at most, from a single pass.
    """
    if accuracy is not None:
        rows = numeric_rows(df, value)
        for key in by:
            rows = rows.where(F.col(key).isNotNull())
        rows = rows.select(*by, F.col(value).alias("_v"),
                           *[c.alias(a) for a, c in (sums or {}).items()])
        return rows.groupBy(*by).agg(
            F.count("_v").alias("n"), F.avg("_v").alias("mean"), F.min("_v").alias("min"),
            F.max("_v").alias("max"), *[F.sum(a).alias(a) for a in sums or {}],
            *[F.percentile_approx("_v", float(share), accuracy).alias(name)
              for name, share in quantiles.items()],
        )
    positions, interpolated = {}, []
    for name, share in quantiles.items():
        exact = F.lit(float(share)) * (F.col("n") - 1)
        low, high = f"_low_{name}", f"_high_{name}"
        positions[low], positions[high] = F.floor(exact), F.ceil(exact)
        weight = exact - F.floor(exact)
        # Equal neighbours are returned as they are; infinite ones must not meet 0 * inf.
        interpolated.append(
            F.when(F.col(low) == F.col(high), F.col(low))
            .otherwise(F.col(low) * (1 - weight) + F.col(high) * weight).alias(name)
        )
    found = order_statistics(df, value, positions, by, sums, buckets)
    return found.select(*by, "n", "mean", "min", "max", *(sums or {}), *interpolated)


def bucket_totals(
    df: DataFrame, value: str, cuts: Sequence[float], weight: str | None = None
) -> DataFrame:
    """``(_bucket, _total, _start)``: at most ``2 * len(cuts) + 1`` rows for any input."""
    total = F.sum(weight) if weight else F.count(F.lit(1))
    totals = with_bucket(df, value, cuts).groupBy("_bucket").agg(total.alias("_total"))
    return totals.withColumn("_start", _before("_total", Window.partitionBy(F.lit(0))))


def average_ranks(
    df: DataFrame,
    value: str,
    weight: str,
    rank: str = "avg_rank",
    ties: str = "tie_size",
    buckets: int = BUCKETS,
    cuts: Sequence[float] | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Average rank and tie size of each row's value, a row standing for ``weight`` copies.

    Count equal rows first, so that repeated values are merged before the shuffle. Pass
    ``cuts`` and ``totals`` if they were already found on cheaper rows.
    """
    rows = numeric_rows(df, value)
    if cuts is None:
        cuts = cut_points(rows, value, buckets)
    if totals is None:
        totals = bucket_totals(rows, value, cuts, weight)
    # Two rows per cut at most.
    rows = with_bucket(rows, value, cuts).join(F.broadcast(totals), "_bucket")
    rows = with_spread(rows, "_total")
    inside = Window.partitionBy("_bucket", "_spread").orderBy(value)
    upto = F.sum(weight).over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    equal = F.sum(weight).over(inside.rangeBetween(Window.currentRow, Window.currentRow))
    rows = rows.withColumns({"_upto": upto, "_equal": equal})
    size = F.when(_is_single(), F.col("_total")).otherwise(F.col("_equal"))
    last = F.when(_is_single(), F.col("_total")).otherwise(F.col("_upto"))
    return rows.select(
        *df.columns,
        (F.col("_start") + last - (size - 1) / F.lit(2.0)).alias(rank),
        size.alias(ties),
    )


def value_ranks(df: DataFrame, value: str, buckets: int = BUCKETS) -> DataFrame:
    """One row per distinct number: how often it occurs and its average rank.

    ``df`` is computed once: its counts are kept, and cuts are sought among them.
    """
    rows = numeric_rows(df, value)
    counted = kept(rows.groupBy(value).agg(F.count(F.lit(1)).alias("n")), "counted")
    cuts = cut_points(counted, value, buckets)
    return average_ranks(counted, value, "n", cuts=cuts).drop("tie_size")


def running_total(
    df: DataFrame,
    order: Sequence[Column],
    weights: Mapping[str, Column],
    wholes: Mapping[str, str] | None = None,
) -> DataFrame:
    """Running sums down a global order, e.g. a row number or a cumulative amount.

    ``wholes`` maps a weight to a column for its sum over all rows.

    Spark's range-partitioned sort splits ties on the later order columns, so equal leading
    values do not pile up in a task. The sorted rows are kept, because partition numbers
    must be the same for the per-partition totals and for the rows they are added to.
    """
    rows = df.select("*", *[w.alias(f"_w_{name}") for name, w in weights.items()])
    rows = materialize(rows.sort(*order).withColumn("_seq", F.monotonically_increasing_id()))
    rows = rows.withColumn("_part", F.shiftright("_seq", 33))
    # One row per sort partition.
    parts = rows.groupBy("_part").agg(
        *[F.sum(f"_w_{name}").alias(f"_p_{name}") for name in weights]
    )
    earlier = (
        Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    parts = parts.select("_part", *[
        F.coalesce(F.sum(f"_p_{name}").over(earlier), F.lit(0)).alias(f"_p_{name}")
        for name in weights
    ], *[
        F.sum(f"_p_{name}").over(Window.partitionBy(F.lit(0))).alias(whole)
        for name, whole in (wholes or {}).items()
    ])
    inside = (
        Window.partitionBy("_part").orderBy("_seq")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.join(F.broadcast(parts), "_part").select(
        *df.columns,
        *[
            (F.col(f"_p_{name}") + F.sum(f"_w_{name}").over(inside)).alias(name)
            for name in weights
        ],
        *(wholes or {}).values(),
    )


def running_share(
    df: DataFrame, value: str, key: str, out: str = "cum_share", position: str | None = None
) -> DataFrame:
    """Cumulative share of the total, largest value first, ties by key; one row per key."""
    amount = F.coalesce(F.col(value).cast("decimal(28,6)"), F.lit(0).cast("decimal(28,6)"))
    weights = {out: amount}
    if position:
        weights[position] = F.lit(1).cast("long")
    order = [F.col(value).desc_nulls_last(), F.col(key)]
    rows = running_total(df, order, weights, {out: "_whole"})
    whole = F.col("_whole").cast("double")
    return rows.withColumn(out, F.try_divide(F.col(out).cast("double"), whole)).drop("_whole")


def row_position(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """1-based row number in a global order."""
    return running_total(df, order, {out: F.lit(1).cast("long")})


def winsorize(
    df: DataFrame,
    columns: Mapping[str, str],
    limit: float = 0.01,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Replace the ``floor(limit * n)`` lowest and highest values by the next order statistic.

    ``columns`` maps an input column to its output column. Nulls do not count towards n.
    """
    names = list(columns)
    stacked = df.select(*[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        [], names, "_column", "_value"
    )
    trimmed = F.floor(F.lit(float(limit)) * F.col("n"))
    bounds = order_statistics(
        stacked, "_value",
        {"low": trimmed, "high": F.col("n") - trimmed - 1},
        by=["_column"], buckets=buckets,
    )
    # One row per column.
    found = {row["_column"]: row for row in bounds.collect()}
    for source, target in columns.items():
        number = F.nanvl(F.col(source).cast("double"), F.lit(None))
        if source in found:
            bounded = F.least(F.greatest(number, F.lit(found[source]["low"])),
                              F.lit(found[source]["high"]))
            number = F.when(number.isNotNull(), bounded)
        df = df.withColumn(target, number)
    return df
