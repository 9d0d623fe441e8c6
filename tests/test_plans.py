"""The stages end to end on the star-schema tables."""

import os

import pytest

from lanewise.catalog.tables import EXTREME_UNIT_FREIGHT, ROLES, delivery_lines
from lanewise.plans.cost import cost_sheets
from lanewise.plans.supplier import supplier_sheets
from lanewise.plans.timeliness import timeliness_sheets

FOLDER = "/root/testdata/sf0.001"
COLUMNS = [
    "id", "asn", "vendor", "country", "mode", "terms", "product", "delivered_date", "delay_days",
    "c1_pq2po", "c2_po2sched", "c3_sched2deliv", "c_total", "line_value", "freight_numeric",
    "freight_flag", "insurance", "weight_numeric", "unit_freight", "delivery_year",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def lines(spark):
    return delivery_lines(spark, FOLDER, COLUMNS).cache()


def test_timeliness(lines):
    sheets = timeliness_sheets(lines, ROLES)
    table = {r["mode"]: r for r in sheets["delay_by_mode"].collect()}
    assert sum(r["n"] for r in table.values()) == sheets["kruskal_mode"].first()["n_total"]
    groups = sheets["kruskal_country"].first()["df"] + 1
    pairs = sheets["dunn_country"].count()
    assert pairs in (0, groups * (groups - 1) // 2)
    assert sheets["delay_histogram"].count() == 60


def test_cost(lines):
    sheets = cost_sheets(lines.withColumn("flag_freight_numeric_outlier", lines["mode"].isNull()),
                         ROLES, "1-URGENT", "AF", "ECONOMY", EXTREME_UNIT_FREIGHT)
    assert sheets["drivers"].count() == 19
    median = {r["share"]: r["value"] for r in sheets["unit_freight_quantiles"].collect()}[0.5]
    low, high = [f([r["median"] for r in sheets["unit_freight_by_terms"].collect()])
                 for f in (min, max)]
    assert low <= median <= high


def test_supplier(lines):
    sheets = supplier_sheets(lines, ROLES)
    vendors = lines.select("vendor").distinct().count()
    assert sheets["scorecard"].count() + sheets["watch_list"].count() == vendors
    assert sum(r["vendors"] for r in sheets["abc_summary"].collect()) == vendors
    for r in sheets["vendor_product_share"].groupBy("vendor").sum("share").collect():
        assert r[1] == pytest.approx(1.0)
    assert sheets["radar"].count() == 4 * min(6, vendors)
