"""Stage 1: raw text rows to the typed, flagged, feature-rich table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewise.functions.expressions import flag
from lanewise.functions.parsing import (
    MONTH_NAME_DATE,
    PO_SENTINELS,
    PQ_SENTINELS,
    SLASH_DATE,
    is_reference,
    parse_date_lenient,
    sentinel_flag,
    text_number_flag,
    to_number,
)
from lanewise.operators.features import calendar, cycle_features, delay_features, unit_freight
from lanewise.operators.ordering import BUCKETS
from lanewise.operators.quality import (
    LOG,
    Rule,
    bad_date,
    copies_of,
    decision_log,
    duplicate_rules,
    hashed,
    implausible_year,
    iqr_flags,
    log_lines,
    numbered,
    outlier_rules,
    profile,
    row_rules,
    rule_counts,
    surplus_rows,
    unparsed,
    value_counts,
    without,
)
from lanewise.operators.sharing import kept, new_folder
from lanewise.sources.delivery import write_by

NUMBER_COLUMNS = {
    "qty": "Line Item Quantity",
    "line_value": "Line Item Value",
    "pack_price": "Pack Price",
    "unit_price": "Unit Price",
    "insurance": "Line Item Insurance (USD)",
    "uom": "Unit of Measure (Per Pack)",
}
DELIVERY_DATES = {
    "scheduled_date": "Scheduled Delivery Date",
    "delivered_date": "Delivered to Client Date",
    "recorded_date": "Delivery Recorded Date",
}


def parse_dates(df: DataFrame) -> DataFrame:
    """State flags and dates; order dates are read only where no sentinel stands.

    ``flag_bad_date`` marks rows with an unreadable date or an implausible year; the
    parsed value is kept in the second case.
    """
    pq = F.coalesce(F.col("PQ First Sent to Client Date"), F.lit(""))
    po = F.coalesce(F.col("PO Sent to Vendor Date"), F.lit(""))
    pq_flag, po_flag = sentinel_flag(pq, PQ_SENTINELS), sentinel_flag(po, PO_SENTINELS)
    df = df.withColumns({
        "pq_flag": pq_flag,
        "po_flag": po_flag,
        "pq_date": parse_date_lenient(F.when(pq_flag == "date", pq), SLASH_DATE),
        "po_date": parse_date_lenient(F.when(po_flag == "date", po), SLASH_DATE),
        **{name: parse_date_lenient(F.col(text), MONTH_NAME_DATE)
           for name, text in DELIVERY_DATES.items()},
    })
    bad = bad_date("pq_flag", "pq_date") | bad_date("po_flag", "po_date")
    for name, text in DELIVERY_DATES.items():
        bad = bad | unparsed(text, name)
    for name in ("pq_date", "po_date", *DELIVERY_DATES):
        bad = bad | implausible_year(name)
    return df.withColumn("flag_bad_date", bad)


def parse_freight(df: DataFrame, text: str = "Freight Cost (USD)") -> DataFrame:
    """``freight_flag`` and the number; empty or unreadable text stays ``numeric`` with null."""
    kind = text_number_flag(F.col(text))
    number = F.when(kind == "numeric", to_number(F.col(text)))
    return df.withColumns({"freight_flag": kind, "freight_numeric": number})


def parse_weight(df: DataFrame, text: str = "Weight (Kilograms)") -> DataFrame:
    """Weight above zero or null; reference texts and non-positive numbers are flagged."""
    number = to_number(F.col(text))
    return df.withColumns({
        "flag_weight_reference": is_reference(F.col(text)),
        "flag_weight_not_positive": flag(number <= 0),
        "weight_numeric": F.when(number > 0, number),
    })


def parse_numbers(df: DataFrame, columns: dict[str, str] | None = None) -> DataFrame:
    columns = NUMBER_COLUMNS if columns is None else columns
    return df.withColumns({name: to_number(F.col(text)) for name, text in columns.items()})


def zero_flag(df: DataFrame, value: str = "line_value", out: str = "flag_zero_value") -> DataFrame:
    return df.withColumn(out, flag(F.col(value) == 0))


def parse(raw: DataFrame, extreme_unit_freight: float = 10_000) -> DataFrame:
    """Everything that needs one row at a time; no shuffle.

    What is read from texts comes first and what follows from it second, so that Spark copies
    the wide rows twice, not once for each of the steps.
    """
    df = parse_dates(parse_numbers(parse_weight(parse_freight(raw))))
    df = calendar(cycle_features(delay_features(zero_flag(df))))
    return unit_freight(df, extreme=extreme_unit_freight)


@dataclass(frozen=True)
class Prepared:
    """A prepared table, and what it was made of."""

    cleaned: DataFrame
    raw_rows: int
    #: Staged rows, surplus ones included, parsed as they are read, and those of them that
    #: repeat another row.
    table: DataFrame
    surplus: DataFrame

    @cached_property
    def counts(self) -> dict[str, int]:
        """Rows, and those that break each of the rules, by name of the aggregate, of different
        rows. Counted when they are first asked for, in one pass that reads what they look at."""
        return self.cleaned.agg(*rule_counts(self.rules)).first().asDict()

    @cached_property
    def rules(self) -> list[Rule]:
        return [*row_rules(), *outlier_rules()]

    def decision_log(
        self, row_id: str = "ID", business_key: Sequence[str] = ("PO / SO #", "Item Description")
    ) -> DataFrame:
        """``(field, issue, treatment, n)``, as ``operators.quality.decision_log`` gives it.

        The raw rows aren't computed again: two narrow passes over the staged table, one for the
        keys, one for what the rules look at.
        """
        copies = copies_of(self.table, {"ID": [row_id], "business key": list(business_key)})
        lines = duplicate_rules(
            copies["ID"], self.raw_rows - self.counts["rows"], copies["business key"])
        lines += log_lines(self.rules, self.counts)
        return self.cleaned.sparkSession.createDataFrame(lines, LOG)

    def sheets(self) -> dict[str, DataFrame]:
        """Decision log, profile and frequency tables."""
        return {
            "decision_log": self.decision_log(),
            "profile": profile(self.cleaned, raw_rows=self.raw_rows),
            "value_counts": value_counts(self.cleaned, FREQUENCIES),
        }


#: Staged rows may lie in a folder per year of delivery.
YEAR = "_year"
FREQUENCIES = ["Product Group", "Sub Classification", "delivery_year", "freight_flag"]


def prepared(
    raw: DataFrame,
    staging: str | None = None,
    extreme_unit_freight: float = 10_000,
    buckets: int = BUCKETS,
    by_year: bool = True,
) -> Prepared:
    """Deduplicate, parse, derive, flag outliers; ``raw`` is computed once.

    All rows are written as they came, with hashes and numbers of theirs, where they are: no row
    is shuffled. They go to ``staging``, or to a folder beside the session's
    checkpoints that ``sharing.release`` removes. Rows that repeat others are then found by
    their hashes and left out by number when the table is read. Rows are parsed as they are read:
    a pass parses the columns it looks at, which costs less than to write and read the parsed
    ones. Fences need a pass over the numbers before values can be flagged.
    Rows of a delivery year lie together, so ``write_cleaned(..., cluster=False)`` needs no
    shuffle; without ``by_year`` they lie in any order, which takes less than half the time to
    write and is enough for sheets, flags and CSV files.
    """
    spark, columns = raw.sparkSession, raw.columns
    staging = staging or new_folder(spark, "staging")
    rows = numbered(hashed(raw, columns))
    if by_year:
        delivered = parse_date_lenient(F.col(DELIVERY_DATES["delivered_date"]), MONTH_NAME_DATE)
        rows = rows.withColumn(YEAR, F.year(delivered))
        write_by(rows, staging, YEAR, cluster=False)
    else:
        rows.write.parquet(staging, compression="zstd")
    staged = spark.read.schema(rows.schema).parquet(staging)
    surplus = kept(surplus_rows(staged, columns), "surplus")
    different = without(staged, surplus).drop(YEAR)
    cleaned = iqr_flags(parse(different, extreme_unit_freight), buckets=buckets)
    table = parse(staged, extreme_unit_freight).drop(YEAR)
    # Footers tell the number of rows.
    return Prepared(cleaned, staged.count(), table, surplus)


def prepare(
    raw: DataFrame,
    staging: str | None = None,
    extreme_unit_freight: float = 10_000,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The cleaned rows of ``prepared``."""
    return prepared(raw, staging, extreme_unit_freight, buckets).cleaned


def prepare_sheets(raw: DataFrame, cleaned: DataFrame) -> dict[str, DataFrame]:
    """The sheets of ``Prepared`` for two tables at rest."""
    raw_rows = raw.agg(F.count(F.lit(1)).alias("n")).scalar()
    return {
        "decision_log": decision_log(raw, cleaned),
        "profile": profile(cleaned, raw_rows=raw_rows),
        "value_counts": value_counts(cleaned, FREQUENCIES),
    }
