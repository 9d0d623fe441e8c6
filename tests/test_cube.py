"""Tables read from the day counts equal those of the rows, and leave the rows alone."""

import datetime

import pytest
from pyspark.sql import functions as F

from lanewise.operators import chartdata, crosstab, metrics
from lanewise.operators.cube import day_cube
from lanewise.plans.pivots import pivot_sheets
from lanewise.plans.timeliness import timeliness_cube, timeliness_sheets
from lanewise.schema import Columns

ROLES = Columns(vendor="vendor", country="country", mode="mode", terms="terms", product="product")
SCHEMA = (
    "vendor string, country string, mode string, terms string, product string, "
    "delivered_date date, delay_days int, c1_pq2po int, c2_po2sched int, c3_sched2deliv int, "
    "c_total int, line_value double, freight_numeric double, freight_flag string, "
    "unit_freight double, grouping string, n long, day int, key_0 string"
)


def lines():
    """600 rows with unknown keys, days and dates, a hot vendor, and columns of clashing names."""
    out = []
    for i in range(600):
        day = None if i % 17 == 0 else i * 7 % 41 - 20
        out.append((
            "V0" if i % 3 == 0 else f"V{i % 5}", None if i % 29 == 0 else f"C{i * i % 6}",
            None if i % 13 == 0 else f"M{i % 3}", f"T{i % 2}", f"P{i * i % 4}",
            None if i % 11 == 0 else datetime.date(2024, 1 + i % 12, 1 + i % 27), day,
            i % 50, None if i % 7 == 0 else i % 90, day, i % 2500,
            float(i), float(i % 10), "numeric" if i % 4 else "included", i / 7, "x", i, i, "y",
        ))
    return out


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cube") / "lines")
    spark.createDataFrame(lines(), SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def content(df):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()),
        key=repr)


def test_tables_of_counts_equal_those_of_rows(rows):
    cube = timeliness_cube(rows, ROLES)
    modes, countries = cube.rows("mode"), cube.rows("country")
    pairs = [
        (metrics.delay_overview(rows), metrics.delay_overview(cube.rows(), weight="n")),
        (chartdata.histogram(rows), chartdata.histogram(cube.rows(), weight="n")),
        (metrics.monthly_trend(rows),
         metrics.monthly_trend(cube.rows("delivered_date"), weight="n")),
        (metrics.late_by_vendor(rows, "vendor", min_n=5),
         metrics.late_by_vendor(cube.rows("vendor"), "vendor", min_n=5, weight="n")),
        (metrics.otd_by(rows, "mode", with_mean=True),
         metrics.otd_by(modes, "mode", with_mean=True, weight="n")),
        (metrics.cycle_segments(rows), metrics.segment_table(
            metrics.in_cycle(cube.stacked()), "n")),
        (metrics.cycle_pivot(rows), metrics.segment_pivot(
            metrics.in_cycle(cube.stacked()), "n")),
        (chartdata.box_stats_days(rows, "mode"),
         chartdata.box_stats_days(modes, "mode", weight="n")),
        (crosstab.most_frequent(rows, "country", 3),
         crosstab.most_frequent(countries, "country", 3, "n")),
        (crosstab.top_n_by_count(rows, "country", top=3),
         crosstab.top_n_by_count(countries, "country", top=3, weight="n")),
        (crosstab.country_mode_heatmap(rows, "country", "mode", min_n=20, top=4),
         crosstab.country_mode_heatmap(
             cube.rows("country", "mode"), "country", "mode", min_n=20, top=4, weight="n")),
        (metrics.day_counts(rows, "terms"), cube.known("terms")),
        (metrics.delay_by_group(rows, "country", min_n=100),
         metrics.delay_by_group(rows, "country", min_n=100, counts=cube.known("country"))),
    ]
    for own, counted in pairs:
        assert content(own) and content(own) == content(counted)
        assert own.columns == counted.columns
        assert [t for _, t in own.dtypes] == [t for _, t in counted.dtypes]


def test_a_stage_reads_the_rows_once(rows):
    source = set(rows.inputFiles())
    cube = timeliness_cube(rows, ROLES)
    for name, sheet in timeliness_sheets(rows, ROLES, cube).items():
        assert not source & set(sheet.inputFiles()), name
    sheets = pivot_sheets(rows, ROLES, cube)
    for name in ("otd_by_mode", "otd_by_product", "otd_by_country", "cycle_pivot"):
        assert not source & set(sheets[name].inputFiles()), name
    assert content(sheets["otd_by_mode"]) == content(metrics.otd_by(rows, "mode", with_mean=True))


def test_unknown_keys_and_days_are_counted(rows):
    cube = day_cube(rows, [("mode",), ("vendor", "delivered_date")], segments=["c2_po2sched"])
    assert cube.rows("mode").agg(F.sum("n")).first()[0] == 600
    unknown = cube.rows("mode").where("mode is null").agg(F.sum("n")).first()[0]
    assert unknown == rows.where("mode is null").count()
    pairs = cube.rows("vendor", "delivered_date")
    assert dict(pairs.dtypes) == {
        "vendor": "string", "delivered_date": "date", "delay_days": "int", "n": "bigint"}
    assert content(pairs) == content(
        rows.groupBy("vendor", "delivered_date", "delay_days").count())
    assert cube.stacked().agg(F.sum("n")).first()[0] == rows.where(
        "c2_po2sched is not null").count()


def test_an_empty_table(rows):
    cube = timeliness_cube(rows.limit(0), ROLES)
    assert cube.rows().count() == 0 and cube.stacked().count() == 0
    assert metrics.delay_overview(cube.rows(), weight="n").first()["n"] == 0
