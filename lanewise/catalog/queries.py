"""``name -> (spark, folder) -> DataFrame`` for every operator.

Results are unrounded in the operators; here doubles are rounded to six places so that two
engines agree on them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewise.catalog.tables import (
    EXTREME_UNIT_FREIGHT,
    ROLES,
    delivery_lines,
    raw_lines,
    scratch_folder,
)
from lanewise.functions.expressions import clip, sql_name
from lanewise.operators import chartdata, crosstab, metrics, ordering, quality, scoring, stats
from lanewise.operators.features import (
    collapse_rare,
    freight_share,
    insurance_rate,
    late_delay,
    log_features,
    month_start,
    with_numeric_freight,
)
from lanewise.operators.regression import Fit, coef_order, ols_drivers
from lanewise.operators.sharing import kept
from lanewise.plans.prepare import parse, prepared
from lanewise.plans.timeliness import timeliness_cube
from lanewise.schema import OUTLIER_COLUMNS
from lanewise.sources.delivery import read_cleaned, read_raw, write_cleaned

Query = Callable[[SparkSession, str], DataFrame]

# Thresholds that split the fixture's groups; the defaults would keep all of them.
MIN_COUNTRY_ROWS = 2300
MIN_VENDOR_ROWS = 600
MIN_LATE_ROWS = 300
MIN_CELL_ROWS = 470
GROUPS = ("mode", "product", "country", "terms")
PRODUCTS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
COST = ["mode", "line_value", "freight_numeric", "insurance", "freight_flag"]
SCORE = ["vendor", "asn", "delay_days", "line_value"]

_QUERIES: dict[str, Query] = {}


def _tidy(df: DataFrame, places: int | None = 6) -> DataFrame:
    out = []
    for field in df.schema.fields:
        column = F.col(sql_name(field.name))
        if isinstance(field.dataType, T.DoubleType):
            if places is not None:
                column = F.round(column, places)
            column = column + F.lit(0.0)
        elif isinstance(field.dataType, T.IntegerType):
            column = column.cast("long")
        out.append(column.alias(field.name))
    return df.select(*out)


def _query(name: str, places: int | None = 6):
    """Register a query; ``places=None`` leaves values that are exact in any engine alone."""

    def register(function: Query) -> Query:
        _QUERIES[name] = lambda spark, folder: _tidy(function(spark, folder), places)
        return function

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _stack(label: str, parts: dict[str, DataFrame]) -> DataFrame:
    """The same result for several keys, labelled."""
    return reduce(DataFrame.unionByName, [
        part.withColumn(label, F.lit(name)) for name, part in parts.items()
    ])


def _by(spark, folder, measure, groups=GROUPS, columns=("delay_days",)) -> DataFrame:
    """One measure for several grouping columns, as ``(grouping, grp, ...)``."""
    return _stack("grouping", {
        group: measure(delivery_lines(spark, folder, [group, *columns]), group)
        .withColumnRenamed(group, "grp")
        for group in groups
    })


def _day_counts(spark, folder) -> dict[str, DataFrame]:
    """Rows by day of every grouping, from one pass over the order lines."""
    return metrics.all_day_counts(
        delivery_lines(spark, folder, [*GROUPS, "delay_days"]), list(GROUPS))


def _min_rows(group: str) -> int:
    return MIN_COUNTRY_ROWS if group == "country" else 30


# ---- sources, profiling -------------------------------------------------------------


@_query("read_raw")
def read_raw_csv(spark, folder):
    path = scratch_folder(spark)
    raw_lines(spark, folder).write.option("header", True).option("escape", '"').csv(
        path, compression="gzip")
    return read_raw(spark, path)


@_query("read_cleaned", places=None)
def read_cleaned_parquet(spark, folder):
    path = scratch_folder(spark)
    write_cleaned(_prepared(spark, folder, by_year=True).cleaned, path, cluster=False)
    return read_cleaned(spark, path)


@_query("write_cleaned", places=None)
def write_cleaned_csv(spark, folder):
    path = scratch_folder(spark)
    write_cleaned(_prepared(spark, folder).cleaned, path, fmt="csv", compression="gzip")
    return read_cleaned(spark, path, fmt="csv")


def _prepared(spark, folder, by_year=False):
    staging = scratch_folder(spark)
    return prepared(raw_lines(spark, folder), staging, EXTREME_UNIT_FREIGHT, by_year=by_year)


@_query("profile")
def profile(spark, folder):
    raw = raw_lines(spark, folder)
    table = quality.staged(raw)
    cleaned = parse(quality.dedup_full_row(raw, table), EXTREME_UNIT_FREIGHT)
    rows = table.agg(F.count(F.lit(1)).alias("n")).scalar()
    return quality.profile(cleaned, raw_rows=rows)


@_query("value_counts")
def value_counts(spark, folder):
    columns = ["product", "subclass", "delivery_year", "freight_flag", "mode"]
    return quality.value_counts(delivery_lines(spark, folder, columns), columns)


@_query("quantile_table")
def quantile_table(spark, folder):
    lines = delivery_lines(spark, folder, ["delay_days", "unit_freight"])
    return _stack("measure", {
        "delay_days": quality.quantile_table(
            lines, "delay_days", [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]),
        "unit_freight": quality.quantile_table(
            lines, "unit_freight", [0.5, 0.75, 0.9, 0.95, 0.99, 0.999]),
    })


@_query("decision_log")
def decision_log(spark, folder):
    return _prepared(spark, folder).decision_log()


# ---- cleaning -----------------------------------------------------------------------


@_query("dup_counts")
def dup_counts(spark, folder):
    return quality.dup_counts(raw_lines(spark, folder))


@_query("dedup_full_row")
def dedup_full_row(spark, folder):
    return quality.dedup_full_row(raw_lines(spark, folder))


def _parsed(spark, folder, *columns):
    return parse(raw_lines(spark, folder), EXTREME_UNIT_FREIGHT).select(*columns)


@_query("sentinel_flag")
def sentinel_flag(spark, folder):
    rows = _parsed(spark, folder, "pq_flag", "po_flag")
    return rows.groupBy("pq_flag", "po_flag").agg(F.count(F.lit(1)).alias("n"))


@_query("parse_date_lenient")
def parse_date_lenient(spark, folder):
    return _parsed(spark, folder, "ID", "Item Description", "pq_date", "po_date",
                   "scheduled_date", "delivered_date", "recorded_date")


@_query("bad_date_count")
def bad_date_count(spark, folder):
    rows = _parsed(spark, folder, "pq_flag", "pq_date", "po_flag", "po_date")
    return quality.count_where(rows, {
        "pq": quality.bad_date("pq_flag", "pq_date"), "po": quality.bad_date("po_flag", "po_date")
    })


@_query("year_range_check")
def year_range_check(spark, folder):
    dates = ["pq_date", "po_date", "scheduled_date", "delivered_date", "recorded_date"]
    rows = _parsed(spark, folder, *dates)
    return quality.count_where(rows, {d: quality.implausible_year(d) for d in dates})


@_query("text_number_split", places=None)
def text_number_split(spark, folder):
    return _parsed(spark, folder, "ID", "Item Description", "freight_flag", "freight_numeric")


@_query("weight_clean", places=None)
def weight_clean(spark, folder):
    return _parsed(spark, folder, "ID", "Item Description", "weight_numeric",
                   "flag_weight_reference", "flag_weight_not_positive")


@_query("to_numeric", places=None)
def to_numeric(spark, folder):
    return _parsed(spark, folder, "ID", "Item Description", "qty", "line_value", "pack_price",
                   "unit_price", "insurance", "uom")


@_query("zero_flag")
def zero_flag(spark, folder):
    rows = _parsed(spark, folder, "flag_zero_value")
    return rows.groupBy("flag_zero_value").agg(F.count(F.lit(1)).alias("n"))


@_query("iqr_outlier_flags")
def iqr_outlier_flags(spark, folder):
    rows = _prepared(spark, folder).cleaned
    return quality.count_where(rows, {c: F.col(f"flag_{c}_outlier") for c in OUTLIER_COLUMNS})


@_query("iqr_fences")
def iqr_fences(spark, folder):
    columns = ["qty", "line_value", "unit_price", "weight_numeric", "freight_numeric", "insurance"]
    return quality.iqr_fences(delivery_lines(spark, folder, columns), columns)


# ---- derived features ---------------------------------------------------------------


@_query("delay_features")
def delay_features(spark, folder):
    return delivery_lines(spark, folder, ["id", "delay_days", "ot_bool", "early_bool"])


@_query("cycle_features")
def cycle_features(spark, folder):
    return delivery_lines(spark, folder, [
        "id", "c1_pq2po", "c2_po2sched", "c3_sched2deliv", "c_total", "flag_negative_cycle"])


@_query("unit_freight", places=None)
def unit_freight(spark, folder):
    return delivery_lines(spark, folder, ["id", "unit_freight", "flag_unit_freight_extreme"])


@_query("calendar")
def calendar(spark, folder):
    rows = delivery_lines(spark, folder, ["id", "delivery_year", "delivery_month"])
    return rows.withColumn("month_start", month_start())


@_query("late_delay")
def late_delays(spark, folder):
    return late_delay(delivery_lines(spark, folder, ["id", "delay_days"]))


@_query("log_features")
def log_feature_columns(spark, folder):
    rows = delivery_lines(spark, folder, [
        "id", "unit_freight", "weight_numeric", "line_value", "delivery_year"])
    return log_features(rows).select("id", "log_uf", "log_weight", "log_value", "year_c")


@_query("ratio_features")
def ratio_features(spark, folder):
    rows = delivery_lines(spark, folder, ["id", *COST[1:]])
    rate = rows.where(F.col("insurance").isNotNull() & (F.col("line_value") > 0)).select(
        "id", F.lit("insurance_rate").alias("ratio"), insurance_rate().alias("share"))
    with_ = with_numeric_freight(rows).select(
        "id", F.lit("with_insurance").alias("ratio"), freight_share().alias("share"))
    without = with_numeric_freight(rows, insurance=None).select(
        "id", F.lit("without_insurance").alias("ratio"),
        freight_share(insurance=None).alias("share"))
    return rate.unionByName(with_).unionByName(without)


@_query("collapse_rare")
def collapse_rare_categories(spark, folder):
    rows = delivery_lines(spark, folder, ["country"])
    pooled = collapse_rare(rows, "country", MIN_COUNTRY_ROWS)
    return pooled.groupBy("country").agg(F.count(F.lit(1)).alias("n"))


@_query("clip")
def clip_bounds(spark, folder):
    rows = delivery_lines(spark, folder, ["id", "delay_days"])
    return rows.select("id", clip(F.col("delay_days"), -140, 160).alias("clipped"))


# ---- global order -------------------------------------------------------------------


@_query("winsorize")
def winsorize(spark, folder):
    rows = delivery_lines(spark, folder, ["id", "freight_numeric", "insurance"])
    return ordering.winsorize(rows, {"freight_numeric": "freight_w", "insurance": "insurance_w"}
                              ).select("id", "freight_w", "insurance_w")


@_query("avg_rank")
def avg_rank(spark, folder):
    rows = kept(delivery_lines(spark, folder, ["insurance", "delay_days"]), "measures")
    return _stack("measure", {
        name: ordering.value_ranks(rows, name).withColumnRenamed(name, "value")
        for name in ("insurance", "delay_days")
    })


@_query("running_share")
def running_share(spark, folder):
    rows = delivery_lines(spark, folder, ["vendor", "line_value"])
    totals = rows.groupBy("vendor").agg(
        F.sum(F.col("line_value").cast("decimal(28,6)")).cast("double").alias("value"))
    return ordering.running_share(totals, "value", "vendor", position="position")


# ---- aggregations -------------------------------------------------------------------


@_query("delay_overview")
def delay_overview(spark, folder):
    return metrics.delay_overview(delivery_lines(spark, folder, ["delay_days"]))


@_query("delay_by_group")
def delay_by_group(spark, folder):
    counts = _day_counts(spark, folder)
    return _stack("grouping", {
        group: metrics.delay_by_group(
            None, group, min_n=_min_rows(group), collapse=group != "product",
            counts=counts[group],
        ).withColumnRenamed(group, "grp")
        for group in GROUPS
    })


@_query("late_by_vendor")
def late_by_vendor(spark, folder):
    rows = delivery_lines(spark, folder, ["vendor", "delay_days"])
    return metrics.late_by_vendor(rows, "vendor", min_n=MIN_LATE_ROWS)


@_query("monthly_trend")
def monthly_trend(spark, folder):
    return metrics.monthly_trend(delivery_lines(spark, folder, ["delivered_date", "delay_days"]))


_SEGMENTS = ["c1_pq2po", "c2_po2sched", "c3_sched2deliv", "c_total"]


@_query("day_cube", places=None)
def day_cube_counts(spark, folder):
    """The day counts of all groupings of the timeliness stage."""
    rows = delivery_lines(
        spark, folder, [*GROUPS, "vendor", "delivered_date", "delay_days", *_SEGMENTS])
    cube = timeliness_cube(rows, ROLES)
    names = F.create_map(*[
        F.lit(x) for keys, number in cube.groupings.items()
        for x in (number, ", ".join(keys) or "all")
    ], F.lit(len(cube.groupings)), F.lit("segment"))
    return cube.counts.select(
        names[F.col("grouping")].alias("grouping"), "key_0", "key_1", "day", "n")


@_query("cycle_segments")
def cycle_segments(spark, folder):
    return metrics.cycle_segments(delivery_lines(spark, folder, _SEGMENTS))


@_query("cycle_segments_ordered")
def cycle_segments_ordered(spark, folder):
    rows = delivery_lines(spark, folder, [*_SEGMENTS, "po_flag"])
    return metrics.cycle_segments(rows, keep=F.col("po_flag") == "date")


@_query("freight_overview")
def freight_overview(spark, folder):
    rows = delivery_lines(spark, folder, ["freight_numeric"])
    return metrics.freight_overview(quality.iqr_flags(rows, ["freight_numeric"]))


@_query("unit_freight_by")
def unit_freight_by(spark, folder):
    return _by(spark, folder, metrics.unit_freight_by, ("mode", "terms"), ("unit_freight",))


@_query("insurance_summary")
def insurance_summary(spark, folder):
    return metrics.insurance_summary(delivery_lines(spark, folder, ["line_value", "insurance"]))


@_query("freight_share_by_mode")
def freight_share_by_mode(spark, folder):
    return metrics.freight_share_by_mode(delivery_lines(spark, folder, COST), "mode")


@_query("yearly_cost_composition")
def yearly_cost_composition(spark, folder):
    return metrics.yearly_cost_composition(
        delivery_lines(spark, folder, ["delivery_year", *COST[1:]]))


def _vendor_metrics(spark, folder):
    return metrics.vendor_metrics(delivery_lines(spark, folder, SCORE), "vendor", "asn")


@_query("vendor_metrics")
def vendor_metrics(spark, folder):
    return _vendor_metrics(spark, folder)


@_query("score_split")
def score_split(spark, folder):
    scored, watch = metrics.score_split(_vendor_metrics(spark, folder), MIN_VENDOR_ROWS)
    return _stack("list", {"scored": scored, "watch": watch}).groupBy("list").agg(
        F.count(F.lit(1)).alias("vendors"), F.sum("lines").alias("lines"))


@_query("abc_summary")
def abc_summary(spark, folder):
    return scoring.abc_summary(scoring.abc_class(_vendor_metrics(spark, folder), "vendor"))


# ---- scorecard ----------------------------------------------------------------------


def _scorecard(spark, folder):
    return scoring.scorecard(
        delivery_lines(spark, folder, SCORE), "vendor", "asn", min_lines=MIN_VENDOR_ROWS)


@_query("minmax_norm")
def minmax_norm(spark, folder):
    normed = scoring.minmax(
        kept(_vendor_metrics(spark, folder)),
        {"avg_late": "late_norm", "value": "value_norm"}, inverted=["avg_late"])
    return normed.select("vendor", "late_norm", "value_norm")


@_query("weighted_score")
def weighted_score(spark, folder):
    parts = scoring.score_parts(kept(_vendor_metrics(spark, folder)))
    return scoring.weighted_score(parts).select("vendor", "score")


@_query("score_rank")
def score_rank(spark, folder):
    return _scorecard(spark, folder)["scored"].select("rank", "vendor", "score")


@_query("abc_class")
def abc_class(spark, folder):
    classes = scoring.abc_class(_vendor_metrics(spark, folder), "vendor")
    return classes.select("vendor", "value", "cum_share", "ABC")


@_query("row_share")
def row_share(spark, folder):
    rows = delivery_lines(spark, folder, ["country", "product", "line_value"])
    wide = crosstab.cross_table(rows, "country", "product", "line_value", PRODUCTS)
    return crosstab.row_share(crosstab.cross_long(wide, "country", "product"), "country")


@_query("scorecard")
def scorecard(spark, folder):
    return _scorecard(spark, folder)["scored"]


@_query("watch_list")
def watch_list(spark, folder):
    return _scorecard(spark, folder)["watch"]


# ---- joins, cross tables ------------------------------------------------------------


@_query("abc_lookup")
def abc_lookup(spark, folder):
    classes = scoring.abc_class(_vendor_metrics(spark, folder), "vendor")
    scored = classes.where(F.col("lines") >= MIN_VENDOR_ROWS)
    rows = delivery_lines(spark, folder, ["id", "vendor"])
    return crosstab.abc_lookup(rows, scored, "vendor")


@_query("semi_top_n")
def semi_top_n(spark, folder):
    rows = delivery_lines(spark, folder, ["id", "country"])
    return crosstab.semi_top_n(rows, crosstab.most_frequent(rows, "country", 5), "country")


@_query("cell_mask")
def cell_mask(spark, folder):
    rows = delivery_lines(spark, folder, ["terms", "product", "delay_days"])
    cells = rows.groupBy("terms", "product").agg(
        F.count(F.lit(1)).alias("n"), F.percentile("delay_days", F.lit(0.5)).alias("median"))
    return crosstab.cell_mask(cells, "median", min_n=1660)


@_query("group_pairs")
def group_pairs(spark, folder):
    rows = delivery_lines(spark, folder, ["country", "delay_days"])
    sums = stats.rank_sums(rows, "country", collapse=False, whole_days=True)
    return stats.group_pairs(sums.select("grp", "n", "mean_rank"))


@_query("country_mode_heatmap")
def country_mode_heatmap(spark, folder):
    rows = delivery_lines(spark, folder, ["country", "mode", "delay_days"])
    return crosstab.country_mode_heatmap(rows, "country", "mode", min_n=MIN_CELL_ROWS)


@_query("vendor_product_cross")
def vendor_product_cross(spark, folder):
    rows = delivery_lines(spark, folder, ["vendor", "product", "line_value"])
    ranked = _scorecard(spark, folder)["scored"]
    return crosstab.vendor_product_cross(
        rows, ranked, "vendor", "product", levels=PRODUCTS)


@_query("top_bottom")
def top_bottom(spark, folder):
    ranked = _scorecard(spark, folder)["scored"].select("rank", "vendor", "score")
    return _stack("part", {
        "top": crosstab.top_rows(ranked, [F.col("rank")], 20),
        "bottom": crosstab.bottom_rows(ranked, 10),
    })


@_query("top_n_by_count")
def top_n_by_count(spark, folder):
    return crosstab.top_n_by_count(
        delivery_lines(spark, folder, ["country", "delay_days"]), "country")


@_query("segments_union")
def segments_union(spark, folder):
    rows = metrics.segment_rows(delivery_lines(spark, folder, _SEGMENTS))
    return rows.groupBy("segment", "days").agg(F.count(F.lit(1)).alias("n"))


# ---- tests and models ---------------------------------------------------------------


@_query("kruskal_wallis")
def kruskal_wallis(spark, folder):
    return _stack("grouping", {
        group: stats.kruskal_wallis(stats.rank_sums(
            None, group, min_n=_min_rows(group), collapse=group != "product", counts=counts,
            whole_days=True))
        for group, counts in _day_counts(spark, folder).items()
    })


@_query("dunn_posthoc")
def dunn_posthoc(spark, folder):
    rows = delivery_lines(spark, folder, ["country", "delay_days"])
    return stats.dunn_pairs(stats.rank_sums(
        rows, "country", min_n=MIN_COUNTRY_ROWS, whole_days=True))


@_query("dunn_gated")
def dunn_gated(spark, folder):
    """Pairs only where the overall test is significant, value by discount level."""
    rows = delivery_lines(spark, folder, ["product", "unit_price"])
    return stats.kruskal_dunn(rows, "product", "unit_price", alpha=0.9999)["pairs"]


@_query("dunn_gate_closed")
def dunn_gate_closed(spark, folder):
    """No pairs where the overall test is not significant."""
    rows = delivery_lines(spark, folder, ["product", "unit_price"])
    return stats.kruskal_dunn(rows, "product", "unit_price", alpha=1e-12)["pairs"]


def _p_values(spark, folder):
    """A p-like number per line, with ties, tested per country."""
    rows = delivery_lines(spark, folder, ["id", "item", "country", "insurance", "qty"])
    p = F.col("insurance") / 12000 * F.col("qty") / 50
    return rows.select("id", "item", F.col("country").alias("test_id"), p.alias("p"))


@_query("bh_fdr", places=None)
def bh_fdr(spark, folder):
    return stats.bh_fdr(_p_values(spark, folder), "p", "test_id")


@_query("bh_fdr_single", places=None)
def bh_fdr_single(spark, folder):
    return stats.bh_fdr(_p_values(spark, folder).drop("test_id"), "p")


@_query("significant_pairs")
def significant_pairs(spark, folder):
    rows = delivery_lines(spark, folder, ["country", "delay_days"])
    pairs = stats.dunn_pairs(stats.rank_sums(rows, "country", collapse=False, whole_days=True))
    return stats.significant_pairs(stats.bh_fdr(pairs), 0.9)


def _fit(spark, folder) -> Fit:
    rows = delivery_lines(spark, folder, [
        "mode", "terms", "product", "weight_numeric", "line_value", "unit_freight",
        "delivery_year", "freight_flag"])
    return ols_drivers(
        rows, ("mode", "1-URGENT"), ("terms", "AF"), ("product", "ECONOMY"),
        extreme=EXTREME_UNIT_FREIGHT)


@_query("ols_drivers")
def ols_drivers_coefficients(spark, folder):
    return _fit(spark, folder).coefficients


@_query("ols_drivers_summary")
def ols_drivers_summary(spark, folder):
    return _fit(spark, folder).summary.drop("rss", "tss")


@_query("spearman")
def spearman(spark, folder):
    rows = delivery_lines(spark, folder, ["line_value", "insurance"])
    return stats.spearman(rows.where(F.col("line_value") > 0))


@_query("coef_order")
def coefficient_order(spark, folder):
    ordered = coef_order(_fit(spark, folder).coefficients)
    place = F.row_number().over(Window.orderBy("coef", "term"))
    return ordered.withColumn("place", place)


# ---- chart data ---------------------------------------------------------------------


@_query("histogram")
def histogram(spark, folder):
    return chartdata.histogram(delivery_lines(spark, folder, ["delay_days"]))


@_query("box_stats")
def box_stats_delay(spark, folder):
    return _by(spark, folder, chartdata.box_stats_days, ("mode", "country"))


@_query("box_stats_top_countries")
def box_stats_top_countries(spark, folder):
    rows = delivery_lines(spark, folder, ["country", "delay_days"])
    top = crosstab.most_frequent(rows, "country", 10)
    return chartdata.box_stats_days(crosstab.semi_top_n(rows, top, "country"), "country")


@_query("box_stats_segments")
def box_stats_segments(spark, folder):
    rows = metrics.segment_rows(delivery_lines(spark, folder, _SEGMENTS))
    return chartdata.box_stats_days(rows, "segment", "days")


@_query("box_stats_unit_freight")
def box_stats_unit_freight(spark, folder):
    return _by(spark, folder, lambda rows, group: chartdata.box_stats(rows, group, "unit_freight"),
               ("mode", "terms"), ("unit_freight",))


@_query("log_density")
def log_density(spark, folder):
    rows = delivery_lines(spark, folder, ["mode", "weight_numeric", "freight_numeric"])
    return chartdata.log_density(rows, "weight_numeric", "freight_numeric", "mode")


@_query("log_density_insurance")
def log_density_insurance(spark, folder):
    rows = delivery_lines(spark, folder, ["line_value", "insurance"])
    return chartdata.log_density(rows, "line_value", "insurance")


@_query("bubble_points")
def bubble_points(spark, folder):
    return chartdata.bubble_points(_scorecard(spark, folder)["scored"], "vendor")


@_query("radar_points")
def radar_points(spark, folder):
    return chartdata.radar_points(_scorecard(spark, folder)["scored"], "vendor")


# ---- summary pivots -----------------------------------------------------------------


@_query("otd_by_mode")
def otd_by_mode(spark, folder):
    rows = delivery_lines(spark, folder, ["mode", "delay_days"])
    return metrics.otd_by(rows, "mode", with_mean=True)


@_query("otd_by_product")
def otd_by_product(spark, folder):
    return metrics.otd_by(delivery_lines(spark, folder, ["product", "delay_days"]), "product")


@_query("otd_by_country")
def otd_by_country(spark, folder):
    rows = delivery_lines(spark, folder, ["country", "delay_days"])
    return metrics.otd_by(rows, "country", min_n=MIN_COUNTRY_ROWS + 50)


@_query("unit_freight_pivot")
def unit_freight_pivot(spark, folder):
    return metrics.unit_freight_pivot(
        delivery_lines(spark, folder, ["mode", "unit_freight"]), "mode")


@_query("cycle_pivot")
def cycle_pivot(spark, folder):
    return metrics.cycle_pivot(delivery_lines(spark, folder, _SEGMENTS))


@_query("supplier_summary")
def supplier_summary(spark, folder):
    rows = delivery_lines(spark, folder, ["vendor", "delay_days", "line_value"])
    return metrics.supplier_summary(rows, "vendor", min_lines=MIN_VENDOR_ROWS)


@_query("freight_share_pivot")
def freight_share_pivot(spark, folder):
    return metrics.freight_share_pivot(delivery_lines(spark, folder, COST), "mode")
