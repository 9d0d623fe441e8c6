"""Duplicate counts, outlier flags, profile, frequency and quantile tables, decision log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewise.functions.expressions import flag, percentile_weighted
from lanewise.operators.metrics import per_day
from lanewise.operators.ordering import BUCKETS, value_summary
from lanewise.operators.sharing import kept
from lanewise.schema import OUTLIER_COLUMNS

FIRST_PLAUSIBLE_YEAR, LAST_PLAUSIBLE_YEAR = 2000, 2025


def dup_count(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """One row: how many rows repeat an earlier one in ``columns``; nulls are equal.

    Copies are merged before the shuffle, so a heavily repeated key costs one row per task.
    """
    copies = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    return copies.agg(
        F.lit(name).alias("field"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).cast("long").alias("n"),
    )


def narrow_dup_counts(df: DataFrame, keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(field, n, rows)`` of several keys from one pass over their columns."""
    width = max(map(len, keys.values()))
    listed = F.array(*[
        F.struct(F.lit(name).alias("field"), *[
            (F.col(columns[i]) if i < len(columns) else F.lit(None)).cast("string").alias(f"k{i}")
            for i in range(width)
        ])
        for name, columns in keys.items()
    ])
    copies = (
        df.select(F.inline(listed)).groupBy("field", *[f"k{i}" for i in range(width)])
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    return copies.groupBy("field").agg(
        F.sum(F.col("_rows") - 1).cast("long").alias("n"), F.sum("_rows").alias("rows")
    )


#: A 64-bit hash of a whole row, and a number that no other row of the table has.
HASH, ROW = "_hash", "_row"
#: Leading bits of a hash by which most rows are told from the repeated ones: 16,384 chunks.
PREFIX_BITS = 26
#: Most chunks of 4,096 row numbers that are broadcast, about 1 KB each at most.
MARKED_CHUNKS = 1 << 17


def hashed(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with a 64-bit hash of ``columns`` (all by default); equal rows have equal ones.

    Rows with equal hashes are compared whole later on, so one hash is enough: among a billion
    different rows it is expected to repeat less than once.
    """
    return df.withColumn(HASH, F.xxhash64(*(df.columns if columns is None else columns)))


def numbered(df: DataFrame) -> DataFrame:
    """Rows with a number each. Write them before use: recomputed rows get other numbers."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


def staged(df: DataFrame) -> DataFrame:
    """``df`` hashed, numbered and kept as a table: its one scan. Later passes read a few of
    the table's columns, or the few rows whose hashes repeat."""
    return kept(numbered(hashed(df)), "staged", codec="zstd")


def marks(numbers: DataFrame, number: Column) -> DataFrame:
    """``(_chunk, _words)``: ``number`` of all rows as a bit each, 64 words of 64 bits a chunk."""
    spread = numbers.select(number.alias("_number")).select(
        F.shiftright("_number", 12).alias("_chunk"),
        F.shiftright("_number", 6).bitwiseAND(F.lit(63)).cast("int").alias("_word"),
        F.expr("shiftleft(1L, cast(_number & 63 as int))").alias("_bit"),
    )
    words = spread.groupBy("_chunk", "_word").agg(F.bit_or("_bit").alias("_bits"))
    chunks = words.groupBy("_chunk").agg(
        F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_words"))
    return kept(chunks, "marks")


def marked(df: DataFrame, number: Column, bits: DataFrame, listed: bool) -> DataFrame:
    """The rows whose ``number`` is among the ``bits`` of ``marks``, or isn't."""
    word = F.shiftright(number, 6).bitwiseAND(F.lit(63)).cast("int")
    found = F.getbit(F.try_element_at("_words", word), number.bitwiseAND(F.lit(63)).cast("int"))
    rows = df.withColumn("_chunk", F.shiftright(number, 12)).join(
        bits, "_chunk", "inner" if listed else "left")
    return rows.where(F.coalesce(found, F.lit(0)) == int(listed)).select(*df.columns)


def by_number(table: DataFrame, numbers: DataFrame, listed: bool) -> DataFrame:
    """The rows of a staged table whose number is in ``numbers``, or isn't.

    A bit a row is small enough to be broadcast for hundreds of millions of rows, so the wide
    rows stay where they are; beyond ``MARKED_CHUNKS`` chunks Spark chooses the join.
    """
    bits = marks(numbers, F.col(ROW))
    if bits.count() <= MARKED_CHUNKS:
        bits = F.broadcast(bits)
    return marked(table, F.col(ROW), bits, listed)


def repeated_hashes(table: DataFrame) -> DataFrame:
    copies = table.groupBy(HASH).agg(F.count(F.lit(1)).alias("_rows"))
    return copies.where(F.col("_rows") > 1).select(HASH)


def alike_rows(table: DataFrame) -> DataFrame:
    """The rows of a staged table whose hash another row has too.

    The prefixes of repeated hashes are broadcast as bits, at most 2 ** ``PREFIX_BITS`` of them.
    Rows without such a prefix aren't shuffled to be compared with the repeated hashes.
    """
    repeated = kept(repeated_hashes(table), "repeated")
    prefix = F.shiftrightunsigned(HASH, 64 - PREFIX_BITS)
    numbers = marked(
        table.select(HASH, ROW), prefix, F.broadcast(marks(repeated, prefix)), listed=True
    ).join(repeated, HASH)  # unique; Spark would move a semi join before the marks
    return by_number(table, numbers, listed=True)


def surplus_rows(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``_row`` and ``columns`` of the rows of a staged table that repeat another one.

    Only hashes are shuffled to find candidates, and whole rows only where hashes repeat. Of equal rows the one of the least number isn't returned. The rest are removed by their
    numbers, which are unique, so a row with any number of copies makes no hot key.
    """
    alike = kept(alike_rows(table).select(ROW, *columns), "alike", codec="zstd")
    first = alike.groupBy(*columns).agg(F.min(ROW).alias(ROW)).select(ROW)
    return alike.join(first, ROW, "left_anti")


def without(table: DataFrame, surplus: DataFrame) -> DataFrame:
    """The rows of a staged table that aren't surplus, without the columns of staging."""
    rows = by_number(table, surplus.select(ROW), listed=False)
    return rows.drop(HASH, ROW)


def dup_counts(
    df: DataFrame,
    row_id: str = "ID",
    business_key: Sequence[str] = ("PO / SO #", "Item Description"),
) -> DataFrame:
    """Surplus rows by ID, by the full row, and by the business key.

    ``df`` is computed once; of the kept rows, those whose hashes repeat are compared whole.
    """
    table = staged(df)
    empty = reduce(DataFrame.unionByName, [
        df.limit(0).agg(F.lit(name).alias("field"), F.count(F.lit(1)).alias("n"))
        for name in ("ID", "business key")
    ])
    narrow = narrow_dup_counts(table, {"ID": [row_id], "business key": list(business_key)})
    both = empty.unionByName(narrow.select("field", "n")).groupBy("field").agg(
        F.sum("n").alias("n"))
    return both.unionByName(dup_count(alike_rows(table), df.columns, "full row"))


def dedup_full_row(df: DataFrame, table: DataFrame | None = None) -> DataFrame:
    """One of each different row. ``df`` is computed once; whole rows are only compared, and
    shuffled, where their hashes repeat. Pass ``table`` if ``df`` has been staged already."""
    table = staged(df) if table is None else table
    return without(table, surplus_rows(table, df.columns)).select(*df.columns)


def bad_date(flag_column: str, date: str, state: str = "date") -> Column:
    """The flag promises a date, but parsing gave none."""
    return (F.col(flag_column) == state) & F.col(date).isNull()


def unparsed(text: str, date: str) -> Column:
    """There is a text, but parsing gave no date."""
    return F.col(text).isNotNull() & F.col(date).isNull()


def implausible_year(
    date: str, first: int = FIRST_PLAUSIBLE_YEAR, last: int = LAST_PLAUSIBLE_YEAR
) -> Column:
    return flag(~F.year(date).between(first, last))


def count_where(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(field, n)`` for every rule, all counted in one pass."""
    counted = df.agg(*[F.count_if(rule).alias(f"r{i}") for i, rule in enumerate(rules.values())])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("field"), F.col(f"r{i}").alias("n"))
        for i, name in enumerate(rules)
    ])))


def iqr_fences(
    df: DataFrame,
    columns: Sequence[str] = tuple(OUTLIER_COLUMNS),
    k: float = 1.5,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``(column, q1, q3, low, high)`` for all columns in one stacked computation."""
    stacked = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "_value"
    )
    quartiles = value_summary(stacked, "_value", {"q1": 0.25, "q3": 0.75}, ["column"],
                              buckets=buckets)
    reach = F.lit(float(k)) * (F.col("q3") - F.col("q1"))
    return quartiles.select(
        "column", "q1", "q3",
        (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"),
    )


def iqr_flags(
    df: DataFrame,
    columns: Sequence[str] = tuple(OUTLIER_COLUMNS),
    k: float = 1.5,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Mark values outside the Tukey fences; rows are never dropped."""
    # One row per column.
    fences = {row["column"]: row for row in iqr_fences(df, columns, k, buckets).collect()}
    marks = {}
    for name in columns:
        outside = F.lit(False)
        if name in fences:
            low, high = fences[name]["low"], fences[name]["high"]
            number = F.col(name)
            outside = flag(~F.isnan(number) & ((number < low) | (number > high)))
        marks[f"flag_{name}_outlier"] = outside
    return df.withColumns(marks)


def profile(
    cleaned: DataFrame,
    country: str = "Country",
    vendor: str = "Vendor",
    delay: str = "delay_days",
    unit: str = "unit_freight",
    raw_rows: int | Column | None = None,
) -> DataFrame:
    """One row: sizes, distinct counts, delay mean and median, non-null counts."""
    measures = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(country).alias("countries"),
        F.count_distinct(vendor).alias("vendors"),
        F.count(delay).alias("delay_n"),
        F.avg(delay).alias("delay_mean"),
        F.count(unit).alias("unit_freight_n"),
    ]
    days = per_day(cleaned, delay).agg(percentile_weighted(delay, 0.5, "_n").alias("m"))
    out = cleaned.agg(*measures).withColumn("delay_median", days.scalar())
    out = out.select(*out.columns[:-2], "delay_median", "unit_freight_n")
    if raw_rows is not None:
        out = out.select(F.lit(raw_rows).cast("long").alias("n_raw"), "*")
    return out


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(field, category, n)`` of several columns from one scan, nulls left out."""
    stacked = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "field", "category"
    )
    return (
        stacked.where(F.col("category").isNotNull())
        .groupBy("field", "category").agg(F.count(F.lit(1)).alias("n"))
        .orderBy("field", F.col("n").desc(), "category")
    )


def quantile_table(
    df: DataFrame, column: str, shares: Sequence[float], buckets: int = BUCKETS
) -> DataFrame:
    """``(share, value)`` rows of one column."""
    names = {f"q{i}": share for i, share in enumerate(shares)}
    wide = value_summary(df.select(column), column, names, buckets=buckets)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(float(share)).alias("share"), F.col(name).alias("value"))
        for name, share in names.items()
    ])))


def _log_rules() -> list[tuple[str, str, str, Column]]:
    """(field, issue, treatment, condition) of the rules counted on deduplicated rows."""
    pq, po = "PQ First Sent to Client Date", "PO Sent to Vendor Date"
    freight, weight = "Freight Cost (USD)", "Weight (Kilograms)"
    date_null = "date set to null, row flagged"
    rules = [
        (pq, "not yet in the quotation process", "pq_flag = pre_pq, date null",
         F.col("pq_flag") == "pre_pq"),
        (pq, "date not captured", "pq_flag = not_captured, date null",
         F.col("pq_flag") == "not_captured"),
        (po, "shipped from a distribution centre, no vendor order",
         "po_flag = from_rdc, date null", F.col("po_flag") == "from_rdc"),
        (po, "date not captured", "po_flag = not_captured, date null",
         F.col("po_flag") == "not_captured"),
        (pq, "unreadable date", date_null, bad_date("pq_flag", "pq_date")),
        (po, "unreadable date", date_null, bad_date("po_flag", "po_date")),
    ]
    rules += [
        (text, "unreadable date", "date null, counted", unparsed(text, date))
        for text, date in (
            ("Scheduled Delivery Date", "scheduled_date"),
            ("Delivered to Client Date", "delivered_date"),
            ("Delivery Recorded Date", "recorded_date"))
    ]
    rules += [
        (freight, f"text marker {kind}", "freight_flag set, number null",
         F.col("freight_flag") == kind)
        for kind in ("included", "invoiced", "reference")
    ]
    rules += [
        (weight, "text reference", "number null, flag_weight_reference",
         F.col("flag_weight_reference")),
        (weight, "number <= 0", "number null", F.col("flag_weight_not_positive")),
        ("Line Item Value", "value is 0", "kept, flag_zero_value", F.col("flag_zero_value")),
    ]
    rules += [
        (name, "outside the Tukey fences", f"flag_{name}_outlier, kept",
         F.col(f"flag_{name}_outlier"))
        for name in OUTLIER_COLUMNS
    ]
    rules += [
        ("cycle segments", "negative cycle", "flag_negative_cycle", F.col("flag_negative_cycle")),
        ("unit_freight", "above the extreme threshold",
         "flag_unit_freight_extreme, not used in regression", F.col("flag_unit_freight_extreme")),
    ]
    return rules


@dataclass(frozen=True)
class Rule:
    """A line of the decision log: what is wrong with which rows, and what is done to them."""

    field: str
    issue: str
    treatment: str
    condition: Column
    #: A rule that isn't standing is listed only if some row breaks it.
    standing: bool = True


def row_rules() -> list[Rule]:
    """Rules that a parsed row breaks by itself."""
    outliers = {f"flag_{name}_outlier, kept" for name in OUTLIER_COLUMNS}
    return [Rule(*rule) for rule in _log_rules() if rule[2] not in outliers] + [
        Rule(f"{name} Date", "year outside the plausible range", "flag_bad_date, value kept",
             implausible_year(date), False)
        for name, date in (("PQ", "pq_date"), ("PO", "po_date"), ("Scheduled", "scheduled_date"),
                           ("Delivered", "delivered_date"), ("Recorded", "recorded_date"))
    ]


def outlier_rules() -> list[Rule]:
    """Rules about values outside the fences, which take all rows to tell."""
    outliers = {f"flag_{name}_outlier, kept" for name in OUTLIER_COLUMNS}
    return [Rule(*rule) for rule in _log_rules() if rule[2] in outliers]


def rule_counts(rules: Sequence[Rule]) -> list[Column]:
    """Aggregates, all in one pass: the number of rows, and of those that break each rule."""
    return [F.count(F.lit(1)).alias("rows")] + [
        F.coalesce(F.sum(rule.condition.cast("long")), F.lit(0)).alias(f"r{i}")
        for i, rule in enumerate(rules)
    ]


def duplicate_rules(id_copies: int, row_copies: int, key_copies: int) -> list[tuple]:
    return [
        ("ID", "repeated key", "counted only", id_copies),
        ("full row", "exact duplicate", "first copy kept", row_copies),
        ("business key", "repeated business key", "counted only", key_copies),
    ]


LOG = "field string, issue string, treatment string, n long"


def log_lines(rules: Sequence[Rule], counts: Mapping[str, int]) -> list[tuple]:
    return [
        (rule.field, rule.issue, rule.treatment, counts[f"r{i}"])
        for i, rule in enumerate(rules) if rule.standing or counts[f"r{i}"]
    ]


def copies_of(table: DataFrame, keys: Mapping[str, Sequence[str]]) -> dict[str, int]:
    """How many rows repeat an earlier one in each key, from one pass over the keys."""
    found = {r["field"]: r["n"] for r in narrow_dup_counts(table, keys).collect()}
    return {name: found.get(name, 0) for name in keys}


def decision_log(
    raw: DataFrame,
    cleaned: DataFrame,
    row_id: str = "ID",
    business_key: Sequence[str] = ("PO / SO #", "Item Description"),
) -> DataFrame:
    """``(field, issue, treatment, n)``: 27 standing rules, and a row per date column that
    has implausible years.

    This is for two tables at rest; ``plans.prepare.prepared`` counts the same while it makes
    the second one. Every rule over the cleaned rows is counted in the same pass. ``cleaned``
    must be the deduplicated ``raw``: exact duplicates are the difference of the row counts.
    """
    rules = [*row_rules(), *outlier_rules()]
    counts = cleaned.agg(*rule_counts(rules)).first().asDict()
    # One narrow pass over the raw rows for both keys and the number of rows.
    keys = {"ID": [row_id], "business key": list(business_key)}
    found = {r["field"]: r for r in narrow_dup_counts(raw, keys).collect()}
    copies = {field: found[field]["n"] if field in found else 0 for field in keys}
    raw_rows = found["ID"]["rows"] if found else 0
    lines = duplicate_rules(copies["ID"], raw_rows - counts["rows"], copies["business key"])
    return raw.sparkSession.createDataFrame(lines + log_lines(rules, counts), LOG)
