"""Rank tests between groups, multiple-test correction, rank correlation.

Rows are first reduced to counts per (group, value); only those take part in ranking, and
everything after the rank sums is one row per group, pair or test.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewise.functions.expressions import clip
from lanewise.functions.tails import chi2_p, normal_p, t_p
from lanewise.operators.features import collapse_rare
from lanewise.operators.metrics import day_counts
from lanewise.operators.ordering import (
    BUCKETS,
    average_ranks,
    bucket_totals,
    cut_points,
    numeric_rows,
    row_position,
    with_bucket,
    with_spread,
)
from lanewise.operators.sharing import kept

ALPHA = 0.05
#: Columns of these types have few values; others only if they are declared to be days.
FEW_VALUES = ("smallint", "tinyint", "date")
#: Groups of a pairwise test: k groups give k * (k - 1) / 2 pairs.
MAX_GROUPS = 20_000


def _ranks_by_day(counts: DataFrame, day: str) -> DataFrame:
    """``counts`` with the average rank of each day and how many rows tie there.

    Days are first added up over the groups: one row per day, as many as the calendar has.
    """
    totals = counts.where(F.col(day).isNotNull()).groupBy(day).agg(F.sum("n").alias("tie_size"))
    upto = F.sum("tie_size").over(Window.partitionBy(F.lit(0)).orderBy(day))
    ranks = totals.select(day, "tie_size", (upto - (F.col("tie_size") - 1) / 2).alias("avg_rank"))
    return counts.join(ranks, day)


def rank_sums(
    df: DataFrame,
    group: str,
    value: str = "delay_days",
    min_n: int = 30,
    collapse: bool = True,
    buckets: int = BUCKETS,
    counts: DataFrame | None = None,
    whole_days: bool = False,
) -> DataFrame:
    """``(grp, n, mean_rank, n_total, tie_sum)`` per group, from average ranks over all rows.

    Pass ``counts`` if ``day_counts`` of the same columns is at hand, and ``whole_days`` if the
    calendar bounds the values, so that one task can rank them.
    """
    if counts is None:
        counts = kept(day_counts(df, group, value))
    if collapse:
        counts = collapse_rare(counts, group, min_n, weight="n")
    if whole_days or dict(counts.dtypes)[value] in FEW_VALUES:
        ranked = _ranks_by_day(counts, value)
    else:
        ranked = average_ranks(counts.where(F.col(value).isNotNull()), value, "n", buckets=buckets)
    n, size = F.col("n").cast("double"), F.col("tie_size").cast("double")
    sums = ranked.groupBy(F.col(group).alias("grp")).agg(
        F.sum("n").alias("n"),
        F.sum(F.col("avg_rank") * n).alias("_ranks"),
        F.sum(n * (size * size - 1)).alias("_ties"),
    )
    sums = kept(sums)
    return sums.select(
        "grp", "n",
        (F.col("_ranks") / F.col("n")).alias("mean_rank"),
        sums.agg(F.sum("n").alias("n")).scalar().alias("n_total"),
        sums.agg(F.sum("_ties").alias("n")).scalar().alias("tie_sum"),
    )


def kruskal_wallis(sums: DataFrame) -> DataFrame:
    """One row ``(h, df, n_total, p)``: tie-corrected H and its chi-square tail.

    With fewer than two groups, or one value everywhere, H and p are null.
    """
    n, n_total = F.col("n").cast("double"), F.col("n_total").cast("double")
    off_centre = F.col("mean_rank") - (n_total + 1) / 2
    whole = sums.agg(
        F.max(n_total).alias("_n"),
        F.max("tie_sum").alias("_ties"),
        (F.count(F.lit(1)) - 1).alias("df"),
        F.sum(n * off_centre * off_centre).alias("_between"),
    )
    size = F.col("_n")
    untied = size * size * size - size - F.col("_ties")
    h = F.try_divide(12 * F.col("_between") * (size - 1), untied)
    tested = whole.select(
        F.when((F.col("df") >= 1) & (untied > 0), h).alias("h"),
        "df", size.cast("long").alias("n_total"),
    )
    return tested.withColumn("p", chi2_p("h", F.col("df").cast("double")))


def group_pairs(groups: DataFrame, name: str = "grp") -> DataFrame:
    """All unordered pairs of groups, columns suffixed ``_a`` and ``_b``, ``a`` before ``b``.

    Groups are numbered by name and each lists the numbers after its own, so the pairs come
    from an equi-join on the number. More than ``MAX_GROUPS`` groups are refused: their pairs
    would be useless as well as many.
    """
    last = groups.count()
    if last > MAX_GROUPS:
        raise ValueError(f"{last} groups have too many pairs; pool the rare ones first")
    numbered = row_position(groups, [F.col(name)], "_no").withColumn("_last", F.lit(last))
    left = numbered.where(F.col("_no") < F.col("_last")).select(
        *[F.col(c).alias(f"{c}_a") for c in groups.columns],
        F.explode(F.sequence(F.col("_no") + 1, F.col("_last").cast("long"))).alias("_no"),
    )
    right = numbered.select("_no", *[F.col(c).alias(f"{c}_b") for c in groups.columns])
    return left.join(right, "_no").drop("_no")


def dunn_pairs(sums: DataFrame) -> DataFrame:
    """``(grp_a, grp_b, z, p)`` per pair of groups, two-sided, tie-corrected."""
    total = F.col("n_total_a").cast("double")
    variance = total * (total + 1) / 12 - F.try_divide(F.col("tie_sum_a"), 12 * (total - 1))
    spread = F.sqrt(variance * (1 / F.col("n_a") + 1 / F.col("n_b")))
    z = F.try_divide(F.col("mean_rank_a") - F.col("mean_rank_b"), spread)
    pairs = group_pairs(sums).select("grp_a", "grp_b", z.alias("z"))
    return pairs.withColumn("p", normal_p("z"))


def bh_fdr(
    df: DataFrame,
    p: str = "p",
    test: str | None = None,
    out: str = "q",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Benjamini-Hochberg q-values, separately per ``test``; rows without p are left out.

    The step-up rule is a running count upwards and a running minimum downwards. Both are
    taken inside buckets of p and joined with per-bucket totals, so a test may have any
    number of p-values.
    """
    keys = [test] if test else ["_test"]
    rows = numeric_rows(df, p)
    if not test:
        rows = rows.withColumn("_test", F.lit(0))
    rows = kept(rows)
    rows = with_bucket(rows, p, cut_points(rows, p, buckets))
    single = F.col("_bucket") % 2 == 1

    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    totals = totals.select(
        *keys, "_bucket", "_n",
        F.sum("_n").over(group).alias("_m"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(*keys, "_bucket", "_spread")
    upwards = inside.orderBy(p).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    downwards = inside.orderBy(F.col(p).desc()).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    place = F.col("_start") + F.when(single, F.col("_n")).otherwise(
        F.count(F.lit(1)).over(upwards)
    )
    rows = kept(
        with_spread(rows.join(kept(totals), [*keys, "_bucket"]), "_n")
        .withColumn("_step", F.col(p) * F.col("_m") / place)
        .withColumn("_within", F.min("_step").over(downwards))
    )
    later = group.orderBy("_bucket").rowsBetween(1, Window.unboundedFollowing)
    above = rows.groupBy(*keys, "_bucket").agg(F.min("_step").alias("_least"))
    above = above.select(*keys, "_bucket", F.min("_least").over(later).alias("_above"))
    q = F.least(F.col("_within"), F.col("_above"), F.lit(1.0))
    return rows.join(kept(above), [*keys, "_bucket"]).select(*df.columns, q.alias(out))


def significant_pairs(pairs: DataFrame, threshold: float = ALPHA) -> DataFrame:
    return pairs.where(F.col("q") < threshold).orderBy("grp_a", "grp_b")


def kruskal_dunn(
    df: DataFrame,
    group: str,
    value: str = "delay_days",
    min_n: int = 30,
    collapse: bool = True,
    alpha: float = ALPHA,
    buckets: int = BUCKETS,
    counts: DataFrame | None = None,
    whole_days: bool = False,
) -> dict[str, DataFrame]:
    """The overall test, and the corrected pairs - none unless the overall p is below alpha."""
    sums = rank_sums(df, group, value, min_n, collapse, buckets, counts, whole_days)
    test = kruskal_wallis(sums)
    overall = test.select("p").first()["p"]
    pairs = dunn_pairs(sums)
    if overall is None or overall >= alpha:
        pairs = pairs.limit(0)
    return {"test": test, "pairs": bh_fdr(pairs, "p", buckets=buckets)}


def spearman(
    df: DataFrame, x: str = "line_value", y: str = "insurance", buckets: int = BUCKETS
) -> DataFrame:
    """One row ``(rho, n, p)`` over rows with both numbers; two-sided p from t, n - 2 df."""
    rows = kept(numeric_rows(numeric_rows(df, x), y).select(x, y))
    x_cuts, y_cuts = cut_points(rows, x, buckets), cut_points(rows, y, buckets)
    counted = rows.groupBy(x, y).agg(F.count(F.lit(1)).alias("n"))
    ranked = average_ranks(counted, x, "n", "_rx", "_tx", cuts=x_cuts,
                           totals=bucket_totals(rows, x, x_cuts))
    ranked = average_ranks(ranked, y, "n", "_ry", "_ty", cuts=y_cuts,
                           totals=bucket_totals(rows, y, y_cuts))
    centre = (rows.agg(F.count(F.lit(1)).alias("n")).scalar() + 1) / 2
    n, dx, dy = F.col("n").cast("double"), F.col("_rx") - centre, F.col("_ry") - centre
    sums = ranked.agg(
        F.sum("n").alias("n"),
        F.sum(n * dx * dx).alias("_xx"),
        F.sum(n * dy * dy).alias("_yy"),
        F.sum(n * dx * dy).alias("_xy"),
    )
    rho = F.try_divide(F.col("_xy"), F.sqrt(F.col("_xx") * F.col("_yy")))
    rho = clip(rho, -1.0, 1.0)
    freedom = (F.col("n") - 2).cast("double")
    t = F.when(F.abs("rho") == 1, F.lit(float("inf"))).otherwise(
        F.col("rho") * F.sqrt(freedom / ((1 - F.col("rho")) * (1 + F.col("rho"))))
    )
    found = sums.select(rho.alias("rho"), "n")
    return found.withColumn("p", t_p(F.when(freedom > 0, t), freedom))
