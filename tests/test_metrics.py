"""Grouped measures: what counts, what is left out, what ties do."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanewise.operators import chartdata, crosstab, features, metrics, quality, scoring
from lanewise.plans.pivots import pivot_sheets, rounded
from lanewise.schema import Columns


def collect(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


@pytest.fixture(scope="module")
def lines(spark):
    rows = (
        [("Air", "V1", f"S{i % 4}", d, 10.0) for i, d in enumerate([-1, 0, 3, None] * 3)]
        + [("Sea", "V2", "S1", d, 20.0) for d in (-2, 0)]
        + [(None, "V3", None, 7, None), ("N/A", "V4", "S9", 1, 0.0)]
    )
    return spark.createDataFrame(
        rows, "mode string, vendor string, asn string, delay_days int, line_value double")


def test_unknown_delays_stay_in_the_denominator(lines):
    row = collect(metrics.otd_by(lines, "mode", with_mean=True), "mode")
    assert set(row) == {"Air", "Sea", "N/A"}          # null keys dropped, "N/A" kept
    assert row["Air"]["n"] == 12 and row["Air"]["otd_pct"] == 50.0
    assert row["Air"]["mean_delay"] == pytest.approx(2 / 3)
    overview = metrics.delay_overview(lines).first()
    assert overview["otd_pct"] == pytest.approx(100 * 8 / 16)
    assert (overview["on_time_n"], overview["delay_n"], overview["late_n"]) == (8, 13, 5)
    # The group table leaves unknown delays out first.
    table = collect(metrics.delay_by_group(lines, "mode", collapse=False), "mode")
    assert table["Air"]["n"] == 9 and table["Air"]["otd_pct"] == pytest.approx(200 / 3)


def test_group_table_order_and_label(lines):
    rows = metrics.delay_by_group(lines, "mode", min_n=3).collect()
    assert [r["mode"] for r in rows] == ["Air", "Other (<3)"]
    assert [r["n"] for r in rows] == [9, 3]
    rows = metrics.otd_by(lines, "mode", min_n=2).collect()
    assert [r["mode"] for r in rows] == ["Sea", "Air"]


def test_collapse_threshold_is_inclusive(spark):
    df = spark.createDataFrame([("a",)] * 30 + [("b",)] * 29 + [(None,)], "c string")
    counts = collect(features.collapse_rare(df, "c").groupBy("c").count(), "c")
    assert {k: r["count"] for k, r in counts.items()} == {"a": 30, "Other (<30)": 29, None: 1}


def test_collapse_by_shuffle_gives_the_same(spark, nothing_small):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)], "c string")
    counts = collect(features.collapse_rare(df, "c", 2).groupBy("c").count(), "c")
    assert {k: r["count"] for k, r in counts.items()} == {"a": 3, "Other (<2)": 1}


def test_vendor_metrics(lines):
    row = collect(metrics.vendor_metrics(lines, "vendor", "asn"), "vendor")
    assert (row["V1"]["lines"], row["V1"]["asn"], row["V1"]["late_n"]) == (12, 4, 3)
    assert row["V1"]["otd"] == 50.0 and row["V1"]["avg_late"] == 3.0
    assert row["V2"]["avg_late"] == 0.0                # never late
    assert row["V3"]["asn"] == 0 and row["V3"]["value"] == 0.0
    pivot = collect(metrics.supplier_summary(lines, "vendor", min_lines=1), "vendor")
    assert pivot["V2"]["avg_late_days"] is None
    assert pivot["V3"]["value"] == 0.0


def test_late_by_vendor_cut(spark):
    rows = [("a", d) for d in range(1, 31)] + [("b", 1)] * 29 + [("c", -1)] * 99
    df = spark.createDataFrame(rows, "vendor string, delay_days int")
    found = metrics.late_by_vendor(df, "vendor").collect()
    assert [(r["vendor"], r["late_n"], r["late_median"], r["late_p90"]) for r in found] == [
        ("a", 30, 15.5, 27.1)]


def test_segments_leave_out_negative_and_huge_values(spark):
    df = spark.createDataFrame([(0, -1, 1999, None), (10, 5, 2000, 7)],
                               "c1_pq2po int, c2_po2sched int, c3_sched2deliv int, c_total int")
    row = collect(metrics.cycle_segments(df), "segment")
    assert {s: r["n"] for s, r in row.items()} == {
        "c1_pq2po": 2, "c2_po2sched": 1, "c3_sched2deliv": 1, "c_total": 1}
    assert row["c1_pq2po"]["median"] == 5.0
    kept = metrics.cycle_segments(df, keep=F.col("c1_pq2po") > 0)
    assert collect(kept, "segment")["c1_pq2po"]["n"] == 1


def test_monthly_trend(spark):
    df = spark.createDataFrame(
        [(dt.date(2010, 3, 5), 1), (dt.date(2010, 3, 31), 0), (dt.date(2010, 4, 1), None)],
        "delivered_date date, delay_days int")
    rows = metrics.monthly_trend(df).collect()
    assert [(r["month"], r["n"], r["otd_pct"]) for r in rows] == [(dt.date(2010, 3, 1), 2, 50.0)]


@pytest.fixture(scope="module")
def costs(spark):
    rows = [
        ("Air", "numeric", 90.0, 10.0, 0.0), ("Air", "numeric", 50.0, 25.0, 25.0),
        ("Air", "numeric", 0.0, 0.0, 0.0),          # undefined share, still counted
        ("Air", "numeric", 10.0, 10.0, None),       # only without insurance
        ("Air", "included", 10.0, 10.0, 1.0), ("Air", "numeric", -1.0, 10.0, 1.0),
        (None, "numeric", 30.0, 10.0, 0.0),
    ]
    return spark.createDataFrame(
        [(*r, 2010) for r in rows],
        "mode string, freight_flag string, line_value double, freight_numeric double, "
        "insurance double, delivery_year int")


def test_two_freight_shares(costs):
    row = collect(metrics.freight_share_by_mode(costs, "mode"), "mode")
    assert row["Air"]["n"] == 3 and row["Air"]["median"] == pytest.approx(0.175)
    assert row[None]["n"] == 4 and row[None]["median"] == pytest.approx(0.25)
    row = collect(metrics.freight_share_pivot(costs, "mode"), "mode")
    assert set(row) == {"Air"} and row["Air"]["n"] == 4
    assert row["Air"]["median_pct"] == pytest.approx(100 / 3)


def test_cost_composition_and_insurance(costs):
    row = metrics.yearly_cost_composition(costs).first()
    assert (row["commodity"], row["freight"], row["insurance"]) == (170.0, 45.0, 25.0)
    row = metrics.insurance_summary(costs).first()
    assert (row["nonzero_n"], row["zero_n"]) == (2, 2)
    assert row["median_rate"] == pytest.approx(0.05)


def test_zero_division_is_null(spark):
    df = spark.createDataFrame([(5.0, 0.0), (5.0, 2.0), (30001.0, 3.0)],
                               "freight_numeric double, weight_numeric double")
    rows = features.unit_freight(df).collect()
    assert [r["unit_freight"] for r in rows] == [None, 2.5, 10000 + 1 / 3]
    assert [r["flag_unit_freight_extreme"] for r in rows] == [False, False, True]


def test_outlier_flags_keep_rows(spark):
    df = spark.createDataFrame([(float(v), None) for v in [1, 2, 3, 4, 100]] + [(None, None)],
                               "a double, b double")
    rows = quality.iqr_flags(df, ["a", "b"]).collect()
    assert [r["flag_a_outlier"] for r in rows] == [False] * 4 + [True, False]
    assert not any(r["flag_b_outlier"] for r in rows)


VENDORS = "Vendor string, lines long, asn long, otd double, avg_late double, late_n long, value double"


def test_abc_borders(spark):
    def classes(values):
        rows = [(f"v{i}", 10, 1, 50.0, 0.0, 0, float(v)) for i, v in enumerate(values)]
        found = scoring.abc_class(spark.createDataFrame(rows, VENDORS)).collect()
        return {r["Vendor"]: r["ABC"] for r in found}

    assert classes([70, 20, 10]) == {"v0": "A", "v1": "B", "v2": "C"}
    # A vendor above the first limit on its own leaves class A empty.
    assert classes([71, 19, 10]) == {"v0": "B", "v1": "B", "v2": "C"}
    # Ties go by name.
    assert classes([25, 25, 25, 25]) == {"v0": "A", "v1": "A", "v2": "B", "v3": "C"}


def test_scores(spark):
    rows = [("a", 10, 1, 80.0, 0.0, 0, 100.0), ("b", 30, 1, 40.0, 4.0, 3, 300.0),
            ("c", 20, 1, 80.0, 2.0, 1, 200.0)]
    df = spark.createDataFrame(rows, VENDORS)
    parts = collect(scoring.weighted_score(scoring.score_parts(df)), "Vendor")
    assert parts["a"]["score"] == pytest.approx(0.4 * 80 + 0.3 * 100)
    assert parts["b"]["score"] == pytest.approx(0.4 * 40 + 20 + 10)
    assert parts["c"]["score"] == pytest.approx(0.4 * 80 + 15 + 10 + 5)
    flat = scoring.minmax(df, {"asn": "n"}).collect()
    assert [r["n"] for r in flat] == [100.0] * 3
    ranked = scoring.score_rank(df.withColumn("score", F.col("otd"))).collect()
    assert {r["Vendor"]: r["rank"] for r in ranked} == {"a": 1, "c": 2, "b": 3}
    summary = collect(scoring.abc_summary(scoring.abc_class(df)), "ABC")
    assert sum(r["value_share"] for r in summary.values()) == pytest.approx(1.0)


def test_scorecard(lines):
    card = scoring.scorecard(lines, "vendor", "asn", min_lines=2)
    assert len(card["scored"].columns) == 14 and len(card["watch"].columns) == 7
    assert {r["vendor"] for r in card["watch"].collect()} == {"V3", "V4"}
    assert {r["ABC"] for r in card["watch"].collect()} == {"C"}
    ranks = [r["rank"] for r in card["scored"].orderBy("rank").collect()]
    assert ranks == [1, 2]


def test_heatmap_masks_and_ranks_by_all_rows(spark):
    rows = [("A", "Air", 1)] * 2 + [("A", "Air", None)] + [("B", "Air", 5)] * 2 + [("C", "Sea", 9)]
    df = spark.createDataFrame(rows, "country string, mode string, delay_days int")
    found = collect(crosstab.country_mode_heatmap(df, "country", "mode", min_n=3, top=2),
                    "country", "mode")
    assert set(found) == {("A", "Air"), ("B", "Air")}
    assert found["A", "Air"]["median_delay"] == 1.0 and found["A", "Air"]["n"] == 3
    assert found["B", "Air"]["median_delay"] is None


def test_cross_table_fills_and_shares(lines):
    wide = crosstab.cross_table(lines, "vendor", "mode", "line_value")
    assert sorted(wide.columns) == ["Air", "N/A", "Sea", "vendor"]
    row = collect(wide, "vendor")
    assert (row["V1"]["Air"], row["V1"]["Sea"]) == (120.0, 0.0)
    shares = collect(crosstab.row_share(crosstab.cross_long(wide, "vendor", "mode"), "vendor"),
                     "vendor", "mode")
    assert shares["V1", "Air"]["share"] == 1.0 and shares["V4", "Air"]["share"] is None


def test_lookup_and_tails(spark):
    classes = spark.createDataFrame([("a", "A")], "Vendor string, ABC string")
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "Vendor string, rank int")
    found = collect(crosstab.abc_lookup(df, classes), "Vendor")
    assert found["a"]["ABC"] == "A" and found["b"]["ABC"] is None
    assert [r["rank"] for r in crosstab.bottom_rows(df, 2).collect()] == [2, 3]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(-500,), (-140,), (-136,), (0,), (155,), (160,), (999,), (None,)],
                               "delay_days int")
    bins = {r["start"]: r["n"] for r in chartdata.histogram(df).collect()}
    assert len(bins) == 60 and sum(bins.values()) == 7
    assert (bins[-140], bins[0], bins[155]) == (3, 1, 3)


@pytest.mark.parametrize("exact_days", [True, False])
def test_box_stats(spark, exact_days):
    df = spark.createDataFrame([("g", d) for d in [1, 2, 3, 4, 5, 50, -40]], "g string, d int")
    found = (chartdata.box_stats_days(df, "g", "d") if exact_days
             else chartdata.box_stats(df, "g", "d")).first()
    assert (found["q1"], found["median"], found["q3"]) == (1.5, 3.0, 4.5)
    assert (found["whisker_low"], found["whisker_high"], found["outlier_n"]) == (1.0, 5.0, 2)


def test_log_density(spark):
    df = spark.createDataFrame([(1.0, 10.0, "a"), (1.1, 10.1, "a"), (0.0, 5.0, "a")],
                               "x double, y double, g string")
    found = chartdata.log_density(df, "x", "y", "g").collect()
    assert [(r["x_cell"], r["y_cell"], r["n"], r["group_n"]) for r in found] == [(0, 10, 2, 2)]


def test_rounding_is_for_views(spark):
    df = spark.createDataFrame([(0.125, 0.375)], "a double, b double")
    assert tuple(rounded(df).first()) == (0.12, 0.38)
    names = Columns(mode="mode", product="mode", country="mode", vendor="vendor")
    rows = [("Air", "V", 1, 5.0, 2.0, 1.0, "numeric", 1, 1, 1, 1)] * 12
    table = spark.createDataFrame(
        rows, "mode string, vendor string, delay_days int, line_value double, "
        "unit_freight double, freight_numeric double, freight_flag string, c1_pq2po int, "
        "c2_po2sched int, c3_sched2deliv int, c_total int")
    sheets = pivot_sheets(table, names)
    assert len(sheets) == 7
    assert sheets["supplier_summary"].first()["value"] == 60.0
