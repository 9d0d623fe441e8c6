"""Text cells: sentinels, centuries, numbers, and the raw file itself."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lanewise.functions import parsing
from lanewise.functions.expressions import clip, flag, fraction_true
from lanewise.operators import quality
from lanewise.plans.prepare import parse, prepare, prepare_sheets, prepared
from lanewise.schema import CLEANED, RAW_COLUMNS
from lanewise.sources.delivery import read_cleaned, read_raw, write_cleaned, write_sheets


def column(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_slash_dates(spark):
    found = column(spark, ["6/2/85", "06/02/06", "2/29/96", "1/1/68", "1/1/69", "13/45/99", "",
                           None, "6/2/2006"],
                   lambda c: parsing.parse_date_lenient(c, parsing.SLASH_DATE))
    assert found == [dt.date(1985, 6, 2), dt.date(2006, 6, 2), dt.date(1996, 2, 29),
                     dt.date(2068, 1, 1), dt.date(1969, 1, 1), None, None, None, None]


def test_month_name_dates(spark):
    found = column(spark, ["2-Jun-06", "02-JUN-06", "31-Jun-06", "2-June-06", None],
                   lambda c: parsing.parse_date_lenient(c, parsing.MONTH_NAME_DATE))
    assert found == [dt.date(2006, 6, 2), dt.date(2006, 6, 2), None, None, None]


def test_numbers(spark):
    found = column(spark, ["1.5", "-2", "1e3", ".5", " 7 ", "1.5d", "1f", "NaN", "x", "", None,
                           "inf"], parsing.to_number)
    assert found == [1.5, -2.0, 1000.0, 0.5, 7.0, None, None, None, None, None, None,
                     float("inf")]


def test_sentinels_and_text_numbers(spark):
    texts = ["Pre-PQ Process", "Date Not Captured", "date not captured", "", None]
    assert column(spark, texts, lambda c: parsing.sentinel_flag(c, parsing.PQ_SENTINELS)) == [
        "pre_pq", "not_captured", "date", "date", "date"]
    texts = ["12.5", "Freight Included in Commodity Cost", "Invoiced Separately",
             "See ASN-1", "see x", "", None]
    assert column(spark, texts, parsing.text_number_flag) == [
        "numeric", "included", "invoiced", "reference", "numeric", "numeric", "numeric"]


def test_unknown_comparisons_are_false(spark):
    df = spark.createDataFrame([(-1,), (0,), (3,), (None,)], "d int")
    assert df.agg(fraction_true(F.col("d") <= 0)).first()[0] == 0.5
    assert df.where(~flag(F.col("d") <= 0)).count() == 2
    assert [r[0] for r in df.select(clip(F.col("d"), 0, 2)).collect()] == [0, 0, 2, None]


BASE = dict.fromkeys(RAW_COLUMNS)
BASE.update({
    "ID": "1", "PO / SO #": "P1", "Item Description": "tablet, 30", "Vendor": "V",
    "Country": "C", "Shipment Mode": "N/A", "Product Group": "G",
    "PQ First Sent to Client Date": "1/5/10", "PO Sent to Vendor Date": "1/15/10",
    "Scheduled Delivery Date": "1-Mar-10", "Delivered to Client Date": "5-Mar-10",
    "Delivery Recorded Date": "5-Mar-10", "Line Item Quantity": "10", "Line Item Value": "100",
    "Pack Price": "10", "Unit Price": "1", "Unit of Measure (Per Pack)": "30",
    "Weight (Kilograms)": "2", "Freight Cost (USD)": "50", "Line Item Insurance (USD)": "1",
})
CASES = [
    {},
    {},                                                    # exact duplicate
    {"Item Description": "other"},                         # same ID
    {"ID": "2", "PQ First Sent to Client Date": "Pre-PQ Process"},
    {"ID": "3", "PQ First Sent to Client Date": None},     # empty counts as unreadable
    {"ID": "4", "PQ First Sent to Client Date": "6/2/85"},
    {"ID": "5", "PO Sent to Vendor Date": "N/A - From RDC"},
    {"ID": "6", "PO Sent to Vendor Date": "1/1/10"},       # ordered before quoted
    {"ID": "7", "Delivered to Client Date": "31-Jun-06"},
    {"ID": "8", "Delivered to Client Date": None},
    {"ID": "9", "Freight Cost (USD)": "See ASN-1"},
    {"ID": "10", "Freight Cost (USD)": "1.5d"},
    {"ID": "11", "Weight (Kilograms)": "-3"},
    {"ID": "12", "Weight (Kilograms)": "See DN-1"},
    {"ID": "13", "Line Item Value": "0"},
    {"ID": "14", "Line Item Value": "100000"},             # far outside the fences
    {"ID": "15", "Freight Cost (USD)": "20001"},           # just above 10,000 per kg
    {"ID": "16", "Freight Cost (USD)": "20000"},
    {"ID": "17", "Freight Cost (USD)": "NaN"},
]


@pytest.fixture(scope="module")
def raw(spark):
    rows = [tuple({**BASE, **case}[name] for name in RAW_COLUMNS) for case in CASES]
    schema = ", ".join(f"`{name}` string" for name in RAW_COLUMNS)
    return spark.createDataFrame(rows, schema)


def test_prepare(spark, raw, tmp_path):
    cleaned = prepare(raw, str(tmp_path / "staging"))
    rows = {(r["ID"], r["Item Description"]): r for r in cleaned.collect()}
    assert len(rows) == len(CASES) - 1
    row = {r["ID"]: r for r in rows.values() if r["Item Description"] == "tablet, 30"}
    assert row["1"]["delay_days"] == 4 and row["1"]["c1_pq2po"] == 10
    assert row["1"]["c_total"] == 59 and row["1"]["delivery_month"] == "2010-03"
    assert row["1"]["Shipment Mode"] == "N/A" and not row["1"]["flag_bad_date"]
    assert row["2"]["pq_flag"] == "pre_pq" and row["2"]["pq_date"] is None
    assert row["3"]["pq_flag"] == "date" and row["3"]["flag_bad_date"]
    assert row["4"]["pq_date"] == dt.date(1985, 6, 2) and row["4"]["flag_bad_date"]
    assert row["5"]["po_flag"] == "from_rdc" and row["5"]["c1_pq2po"] is None
    assert row["6"]["flag_negative_cycle"] and not row["1"]["flag_negative_cycle"]
    for key in ("7", "8"):
        assert row[key]["delay_days"] is None and row[key]["ot_bool"] is False
    assert row["7"]["flag_bad_date"] and not row["8"]["flag_bad_date"]
    assert row["9"]["freight_flag"] == "reference" and row["9"]["freight_numeric"] is None
    assert row["10"]["freight_flag"] == "numeric" and row["10"]["freight_numeric"] is None
    assert row["11"]["weight_numeric"] is None and row["11"]["unit_freight"] is None
    assert row["12"]["flag_weight_reference"] and not row["11"]["flag_weight_reference"]
    assert row["13"]["flag_zero_value"]
    assert row["14"]["flag_line_value_outlier"] and not row["1"]["flag_line_value_outlier"]
    assert row["15"]["flag_unit_freight_extreme"] and not row["16"]["flag_unit_freight_extreme"]
    # A NaN text is no number, so it cannot exceed a threshold.
    assert row["17"]["freight_numeric"] is None and not row["17"]["flag_unit_freight_extreme"]

    sheets = prepare_sheets(raw, cleaned)
    log = {(r["field"], r["issue"]): r["n"] for r in sheets["decision_log"].collect()}
    assert len(log) == 28  # 27 standing rules and one implausible year
    assert log["ID", "repeated key"] == 2
    assert log["full row", "exact duplicate"] == 1
    assert log["business key", "repeated business key"] == len(CASES) - 2
    assert log["PQ First Sent to Client Date", "unreadable date"] == 1
    assert log["PQ Date", "year outside the plausible range"] == 1
    assert log["Delivered to Client Date", "unreadable date"] == 1
    assert log["Weight (Kilograms)", "number <= 0"] == 1
    profile = sheets["profile"].first()
    assert (profile["n_raw"], profile["n_rows"]) == (len(CASES), len(CASES) - 1)
    assert profile["delay_n"] == len(CASES) - 3

    write_cleaned(cleaned, str(tmp_path / "parquet"), cluster=False)
    write_cleaned(cleaned, str(tmp_path / "csv"), fmt="csv")
    names = [f.name for f in CLEANED.fields]
    assert len(names) == 70
    expected = sorted(map(repr, cleaned.select(*names).collect()))
    for fmt in ("parquet", "csv"):
        back = read_cleaned(spark, str(tmp_path / fmt), fmt)
        assert [f.dataType for f in back.select(*names).schema] == [
            f.dataType for f in CLEANED.fields]
        assert sorted(map(repr, back.select(*names).collect())) == expected


def watched(df, folder):
    """``df``, leaving a file in ``folder`` each time one of its partitions is computed."""
    folder.mkdir()

    def rows(batches):
        import uuid

        (folder / uuid.uuid4().hex).touch()
        yield from batches

    return df.mapInArrow(rows, df.schema)


def test_raw_rows_are_computed_once(raw, tmp_path):
    copies = raw.union(raw.where("ID in ('3', '13')")).union(raw.where("ID = '13'")).coalesce(2)
    found = prepared(watched(copies, tmp_path / "a"), str(tmp_path / "staging"))
    log = sorted(map(tuple, found.decision_log().collect()))
    rows = found.cleaned.collect()
    assert len(list((tmp_path / "a").iterdir())) == 2
    assert len(rows) == len(CASES) - 1 and found.raw_rows == len(CASES) + 3
    # The same lines as from the two tables at rest, whose counts are taken from all rows.
    assert log == sorted(map(tuple, quality.decision_log(copies, found.cleaned).collect()))
    assert dict((x[:2], x[3]) for x in log)["full row", "exact duplicate"] == 4
    assert found.sheets()["profile"].first()["n_raw"] == len(CASES) + 3

    once = quality.dedup_full_row(watched(copies, tmp_path / "b"))
    assert sorted(map(repr, once.collect())) == sorted(map(repr, raw.distinct().collect()))
    assert len(list((tmp_path / "b").iterdir())) == 2
    assert once.columns == raw.columns


def test_equal_hashes_of_different_rows_stay(spark, monkeypatch):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (None, None)] * 3, "a int, b int")
    monkeypatch.setattr(quality.F, "xxhash64", lambda *columns: F.lit(5).cast("long"))
    assert quality.dedup_full_row(df).count() == 3
    counts = {r["field"]: r["n"] for r in quality.dup_counts(df, "a", ["a", "b"]).collect()}
    assert counts == {"ID": 10, "business key": 9, "full row": 9}


def test_prepare_without_rows(raw, tmp_path):
    nothing = prepared(raw.limit(0), str(tmp_path / "staging"))
    assert nothing.cleaned.count() == 0 and nothing.raw_rows == 0
    assert {r["n"] for r in nothing.decision_log().collect()} == {0}


def test_parse_without_fences_needs_no_shuffle(raw):
    assert "Exchange" not in parse(raw)._jdf.queryExecution().executedPlan().toString()


def test_read_raw(spark, tmp_path):
    path = tmp_path / "raw.csv"
    cells = {**BASE, "Dosage": "", "Item Description": 'say ""hi"", now'}
    line = ",".join(f'"{cells[n]}"' if cells[n] else "" for n in RAW_COLUMNS)
    header = ",".join(f'"{n}"' for n in RAW_COLUMNS)
    path.write_text("﻿" + header + "\n" + line + "\n", encoding="utf-8")
    row = read_raw(spark, str(path)).first()
    assert row["ID"] == "1" and row["Shipment Mode"] == "N/A" and row["Dosage"] is None
    assert row["Item Description"] == 'say "hi", now'


def test_write_sheets(spark, tmp_path):
    write_sheets({"a": spark.range(3), "b": spark.range(2)}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 3


def test_nulls_are_equal_for_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (None, None)], "a int, b int")
    assert quality.dup_count(df, ["a", "b"], "both").first()["n"] == 1
    assert quality.dup_count(df, ["a"], "a").first()["n"] == 2
    assert quality.dedup_full_row(df).count() == 3


def test_read_raw_by_name_and_malformed(spark, tmp_path):
    from pyspark.errors import PySparkException
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("ID", "Country", "X")])

    def folder(name, text, encoding="utf-8"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.csv").write_text(text, encoding=encoding)
        return str(tmp_path / name)

    permuted = folder("permuted", 'Country,ID,X\nFR,1,a\nDE,2,"b ""q"""\n', "utf-8-sig")
    rows = [tuple(r) for r in read_raw(spark, permuted, schema).collect()]
    assert rows == [("1", "FR", "a"), ("2", "DE", 'b "q"')]
    broken = folder("broken", "Country,ID,X\nFR,1,a,surplus\nDE,2\nES,3,c\n")
    for act in (lambda d: d.count(), lambda d: d.select("ID").collect()):
        with pytest.raises(Exception):
            act(read_raw(spark, broken, schema))
    marked = read_raw(spark, broken, schema, malformed="keep")
    assert tuple(marked.agg(F.count("_corrupt_record"), F.count("ID")).first()) == (2, 3)
    with pytest.raises(ValueError, match="lacks"):
        read_raw(spark, folder("short", "Country,ID\nFR,1\n"), schema)
    lines = folder("lines", 'Country,ID,X\nFR,1,"a\nb"\n')
    assert read_raw(spark, lines, schema, multiline=True).first()["X"] == "a\nb"
    with pytest.raises((PySparkException, Exception)):
        read_raw(spark, lines, schema).collect()
