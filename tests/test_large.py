"""What wide and many rows cost: nothing but keys, hashes and marks moves."""

import datetime
import re

import pytest

from lanewise.catalog.queries import all_queries
from lanewise.catalog.tables import raw_lines
from lanewise.operators import ordering, quality
from lanewise.plans.prepare import parse, prepared
from lanewise.schema import RAW
from lanewise.sources.delivery import OPEN_FILES, wide_rows, write_by
from tests.test_parsing import BASE, watched


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


@pytest.fixture
def copies(spark):
    rows = [{**BASE, "ID": str(i % 40)} for i in range(60)]
    return spark.createDataFrame([[r[n] for n in RAW.names] for r in rows], RAW).repartition(3)


def test_wide_rows_stay_where_they_are(copies, nothing_small):
    once = quality.dedup_full_row(copies)
    assert "SortMergeJoin" not in plan(once) and once.count() == 40


def test_rows_are_found_by_number(spark, tmp_path, monkeypatch):
    table = quality.staged(spark.range(0, 20000, 1, 3))
    numbers = table.where("id % 7 = 3 or id between 5000 and 9999").select(quality.ROW)
    wanted = {i for i in range(20000) if i % 7 == 3 or 5000 <= i < 10000}
    for most in (quality.MARKED_CHUNKS, 0):
        monkeypatch.setattr(quality, "MARKED_CHUNKS", most)
        found = {r["id"] for r in quality.by_number(table, numbers, True).collect()}
        rest = {r["id"] for r in quality.by_number(table, numbers, False).collect()}
        assert found == wanted and rest == set(range(20000)) - wanted


def test_one_hash_of_a_row_is_stored(copies):
    assert len(quality.staged(copies).columns) == len(copies.columns) + 2


def test_rows_of_other_hashes_are_not_shuffled(spark, nothing_small, monkeypatch):
    table = quality.staged(spark.range(0, 4000, 1, 3).selectExpr("id % 3990 AS a"))
    alike = {}
    monkeypatch.setattr(
        quality, "by_number", lambda table, numbers, listed: alike.setdefault("numbers", numbers))
    assert quality.alike_rows(table).count() == 20
    # The marks meet the rows below the shuffle for the comparison with the repeated hashes.
    shown = plan(alike["numbers"])
    assert shown.index(f"Exchange hashpartitioning({quality.HASH}#") < shown.index("getbit")


@pytest.mark.parametrize("bits", [1, 13, 26])
def test_hashes_of_one_prefix_are_told_apart(spark, monkeypatch, bits):
    monkeypatch.setattr(quality, "PREFIX_BITS", bits)
    df = spark.range(0, 3000, 1, 3).selectExpr("cast(id % 2000 as string) a", "null b")
    df = df.withColumn("b", df["b"].cast("string"))
    once = quality.dedup_full_row(df)
    assert sorted(int(r["a"]) for r in once.collect()) == list(range(2000))
    assert quality.alike_rows(quality.staged(df)).count() == 2000


def test_duplicates_are_counted_from_one_computation(copies, tmp_path):
    found = quality.dup_counts(watched(copies, tmp_path / "seen")).collect()
    assert {r["field"]: r["n"] for r in found} == {"ID": 20, "business key": 59, "full row": 20}
    assert len(list((tmp_path / "seen").iterdir())) == 3


def test_preparation_leaves_rows_in_their_tasks(copies, tmp_path):
    found = prepared(copies, str(tmp_path / "staging"))
    tasks = found.table.selectExpr("shiftright(_row, 33) AS task").distinct().count()
    assert tasks == 3 and found.cleaned.count() == 40


@pytest.mark.parametrize("by_year", [True, False])
def test_raw_rows_are_staged_as_they_came(copies, tmp_path, by_year):
    found = prepared(copies, str(tmp_path / "staging"), by_year=by_year)
    stored = copies.sparkSession.read.parquet(str(tmp_path / "staging")).columns
    # What can be parsed again is neither written nor read.
    assert set(stored) - {"_year"} == {*RAW.names, quality.HASH, quality.ROW}
    assert ("_year" in stored) == by_year
    assert found.cleaned.count() == 40 and "_year" not in found.cleaned.columns + found.table.columns


def test_parsing_copies_wide_rows_twice(copies):
    shown = parse(copies)._jdf.queryExecution().optimizedPlan().toString()
    assert shown.count("Project [") == 2


def test_settings_of_wide_writes_are_put_back(spark, copies, tmp_path):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), wide_rows(spark):
        assert spark.conf.get(name) == "8000"
        1 / 0
    assert spark.conf.get(name) == before


def test_ranks_compute_rows_once(spark, tmp_path):
    df = spark.range(0, 300, 1, 3).selectExpr("cast(id % 50 as double) v")
    ranks = ordering.value_ranks(watched(df, tmp_path / "seen"), "v").collect()
    assert {r["v"]: (r["n"], r["avg_rank"]) for r in ranks} == {
        float(i): (6, 6 * i + 3.5) for i in range(50)}
    assert len(list((tmp_path / "seen").iterdir())) == 3


def test_many_values_are_written_by_value(spark, tmp_path):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    rows = spark.range(0, 1000, 1, 2).selectExpr("id", f"id % {3 * OPEN_FILES} AS year")
    write_by(rows, str(tmp_path / "out"), "year", cluster=False)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    assert spark.conf.get(name) == before


@pytest.fixture
def star(spark, tmp_path):
    day = datetime.datetime(2006, 3, 1)
    tables = {
        "nation": ([(0, "X")], "n_nationkey int, n_name string"),
        "customer": ([(1, 0), (2, 0)], "c_custkey long, c_nationkey int"),
        "supplier": ([(1, "S")], "s_suppkey long, s_name string"),
        "part": ([(1, "p", "b", "t")], "p_partkey long, p_name string, p_brand string, p_type string"),
        "orders": ([(1, 1, day, "1-URGENT"), (2, 2, day, "2-HIGH"), (3, None, day, "2-HIGH"),
                    (None, 1, day, "1-URGENT")],
                   "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string"),
        "lineitem": ([(k, 1, 1, 1, 2.0, 10.0, 0.1, 0.1, "A", "F", day) for k in (1, 1, 2, 3, None)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                     "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                     "l_returnflag string, l_linestatus string, l_shipdate timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_lines_are_not_shuffled_for_customers(spark, star, nothing_small):
    rows = raw_lines(spark, star)
    assert sorted(r["ID"] for r in rows.collect()) == ["1-1", "1-1", "2-1"]
    depth = {
        key: re.search(rf"^(\W*)Exchange hashpartitioning\({key}#", plan(rows), re.M).end(1)
        for key in ("o_custkey", "l_orderkey")
    }
    assert depth["o_custkey"] > depth["l_orderkey"]


def test_lines_meet_orders_last_and_stay_for_suppliers(spark, star, nothing_small):
    rows = raw_lines(spark, star)
    shown = plan(rows)
    depth = {
        key: re.search(rf"^(\W*)Exchange hashpartitioning\({key}#", shown, re.M).end(1)
        for key in ("l_partkey", "l_orderkey")
    }
    assert depth["l_partkey"] > depth["l_orderkey"]
    assert "hashpartitioning(l_suppkey" not in shown and "BroadcastHashJoin" in shown
    assert {(r["Vendor"], r["Vendor INCO Term"], r["Scheduled Delivery Date"])
            for r in rows.collect()} == {("S", "AF", "1-Mar-06")}


def test_many_suppliers_are_left_to_spark(spark, star, nothing_small, monkeypatch):
    few = sorted(map(tuple, raw_lines(spark, star).collect()))
    monkeypatch.setattr("lanewise.catalog.tables.NARROW_ROWS", 0)
    rows = raw_lines(spark, star)
    assert "hashpartitioning(l_suppkey" in plan(rows)
    assert sorted(map(tuple, rows.collect())) == few


def test_text_is_stored_compressed(spark, star):
    for name in ("read_raw", "write_cleaned"):
        rows = all_queries()[name](spark, star)
        assert rows.count() == (3 if name == "read_raw" else 2)
        assert all(f.endswith(".csv.gz") for f in rows.inputFiles())
