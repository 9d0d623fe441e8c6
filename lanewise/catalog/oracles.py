"""The queries' reference SQL, written independently of the operators."""

from __future__ import annotations

from lanewise.catalog.queries import (
    MIN_CELL_ROWS,
    MIN_COUNTRY_ROWS,
    MIN_LATE_ROWS,
    MIN_VENDOR_ROWS,
    PRODUCTS,
)
from lanewise.catalog.tables import EXTREME_UNIT_FREIGHT
from lanewise.schema import CLEANED, OUTLIER_COLUMNS, RAW_COLUMNS

# ---- the tables as delivery lines ---------------------------------------------------

_BASE = """
star AS (
  SELECT l.*, o.*, p.*, s_name, n_name, CAST(o_orderdate AS DATE) AS od,
         CAST(l_shipdate AS DATE) AS sd
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
  JOIN part p ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
placed AS (
  SELECT l_orderkey || '-' || l_linenumber AS id, 'ASN-' || l_orderkey AS asn, s_name AS vendor,
    n_name AS country, l_returnflag || l_linestatus AS terms, p_type AS product,
    p_brand AS subclass, p_name AS item,
    CASE WHEN l_partkey % 31 = 0 THEN NULL WHEN l_partkey % 37 = 0 THEN 'N/A'
         ELSE o_orderpriority END AS mode,
    CASE WHEN l_orderkey % 11 = 0 THEN 'pre_pq' WHEN l_orderkey % 13 = 0 THEN 'not_captured'
         ELSE 'date' END AS pq_flag,
    CASE WHEN l_suppkey % 7 = 0 THEN 'from_rdc' WHEN l_partkey % 17 = 0 THEN 'not_captured'
         ELSE 'date' END AS po_flag,
    CASE WHEN l_orderkey % 11 <> 0 AND l_orderkey % 13 <> 0 AND l_partkey % 61 <> 0
          AND l_partkey % 59 <> 0 THEN od - CAST(30 + l_partkey % 90 AS INTEGER) END AS pq_date,
    CASE WHEN l_suppkey % 7 <> 0 AND l_partkey % 17 <> 0
         THEN od - CAST(l_suppkey % 100 AS INTEGER) END AS po_date,
    od AS scheduled_date,
    CASE WHEN l_orderkey % 41 <> 0 AND l_orderkey % 67 <> 0 THEN sd END AS delivered_date,
    CASE WHEN l_orderkey % 7 = 0 THEN 'included' WHEN l_partkey % 23 = 0 THEN 'invoiced'
         WHEN l_suppkey % 5 = 0 THEN 'reference' ELSE 'numeric' END AS freight_flag,
    CASE WHEN l_orderkey % 7 <> 0 AND l_partkey % 23 <> 0 AND l_suppkey % 5 <> 0
          AND l_orderkey % 29 <> 0 THEN l_extendedprice * l_tax END AS freight_numeric,
    CASE WHEN l_partkey % 19 <> 0 AND l_partkey % 21 <> 0 AND l_partkey % 25 <> 0
          AND l_partkey % 27 <> 0 THEN l_quantity END AS weight_numeric,
    l_quantity AS qty,
    CASE WHEN l_partkey % 43 = 0 THEN NULL WHEN l_partkey % 47 = 0 THEN 0
         WHEN l_partkey % 53 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS line_value,
    l_extendedprice / l_quantity AS unit_price,
    CASE WHEN l_orderkey % 59 <> 0 THEN l_extendedprice * l_discount END AS insurance
  FROM star),
lines AS (
  SELECT *, delivered_date - scheduled_date AS delay_days, po_date - pq_date AS c1_pq2po,
    scheduled_date - po_date AS c2_po2sched, delivered_date - scheduled_date AS c3_sched2deliv,
    delivered_date - pq_date AS c_total, freight_numeric / weight_numeric AS unit_freight,
    year(delivered_date) AS delivery_year, strftime(delivered_date, '%Y-%m') AS delivery_month
  FROM placed)"""

_RAW_CELLS = {
    "ID": "l_orderkey || '-' || l_linenumber",
    "Project Code": "'PC-' || o_custkey",
    "PQ #": "'PQ-' || l_partkey",
    "PO / SO #": "'PO-' || l_orderkey",
    "ASN/DN #": "'ASN-' || l_orderkey",
    "Country": "n_name",
    "Managed By": "'Central Office'",
    "Fulfill Via": "CASE WHEN l_suppkey % 7 = 0 THEN 'From RDC' ELSE 'Direct Drop' END",
    "Vendor INCO Term": "l_returnflag || l_linestatus",
    "Shipment Mode": """CASE WHEN l_partkey % 31 = 0 THEN NULL WHEN l_partkey % 37 = 0 THEN 'N/A'
        ELSE o_orderpriority END""",
    "PQ First Sent to Client Date": """CASE WHEN l_orderkey % 11 = 0 THEN 'Pre-PQ Process'
        WHEN l_orderkey % 13 = 0 THEN 'Date Not Captured' WHEN l_partkey % 61 = 0 THEN '13/45/99'
        WHEN l_partkey % 59 = 0 THEN NULL
        ELSE strftime(od - CAST(30 + l_partkey % 90 AS INTEGER), '%-m/%-d/%y') END""",
    "PO Sent to Vendor Date": """CASE WHEN l_suppkey % 7 = 0 THEN 'N/A - From RDC'
        WHEN l_partkey % 17 = 0 THEN 'Date Not Captured'
        ELSE strftime(od - CAST(l_suppkey % 100 AS INTEGER), '%m/%d/%y') END""",
    "Scheduled Delivery Date": """CASE WHEN l_linenumber % 2 = 0
        THEN upper(strftime(od, '%-d-%b-%y')) ELSE strftime(od, '%-d-%b-%y') END""",
    "Delivered to Client Date": """CASE WHEN l_orderkey % 41 = 0 THEN NULL
        WHEN l_orderkey % 67 = 0 THEN '31-Jun-06' ELSE strftime(sd, '%-d-%b-%y') END""",
    "Delivery Recorded Date":
        "CASE WHEN l_orderkey % 41 <> 0 THEN strftime(sd + l_linenumber, '%-d-%b-%y') END",
    "Product Group": "p_type",
    "Sub Classification": "p_brand",
    "Vendor": "s_name",
    "Item Description": "p_name",
    "Molecule/Test Type": "p_name",
    "Brand": "p_brand",
    "Dosage": "CASE WHEN l_partkey % 3 = 0 THEN 'N/A' END",
    "Dosage Form": "'Tablet'",
    "Unit of Measure (Per Pack)": "CAST(l_linenumber * 10 AS VARCHAR)",
    "Line Item Quantity": "CAST(l_quantity AS VARCHAR)",
    "Line Item Value": """CASE WHEN l_partkey % 43 = 0 THEN NULL WHEN l_partkey % 47 = 0 THEN '0.0'
        WHEN l_partkey % 53 = 0 THEN CAST(-l_extendedprice AS VARCHAR)
        ELSE CAST(l_extendedprice AS VARCHAR) END""",
    "Pack Price": """CASE WHEN l_partkey % 33 = 0 THEN 'n/a' WHEN l_partkey % 35 = 0 THEN '1.5d'
        ELSE CAST(l_extendedprice / l_quantity * l_linenumber AS VARCHAR) END""",
    "Unit Price": "CAST(l_extendedprice / l_quantity AS VARCHAR)",
    "Manufacturing Site": "s_name",
    "First Line Designation": "CASE WHEN l_linenumber % 3 = 0 THEN 'No' ELSE 'Yes' END",
    "Weight (Kilograms)": """CASE WHEN l_partkey % 19 = 0 THEN 'See DN-' || l_orderkey
        WHEN l_partkey % 21 = 0 THEN '0' WHEN l_partkey % 25 = 0 THEN '-5'
        WHEN l_partkey % 27 = 0 THEN 'Weight Captured Separately'
        ELSE CAST(l_quantity AS VARCHAR) END""",
    "Freight Cost (USD)": """CASE WHEN l_orderkey % 7 = 0 THEN 'Freight Included in Commodity Cost'
        WHEN l_partkey % 23 = 0 THEN 'Invoiced Separately'
        WHEN l_suppkey % 5 = 0 THEN 'See ASN-' || l_orderkey WHEN l_orderkey % 29 = 0 THEN NULL
        ELSE CAST(l_extendedprice * l_tax AS VARCHAR) END""",
    "Line Item Insurance (USD)":
        "CASE WHEN l_orderkey % 59 <> 0 THEN CAST(l_extendedprice * l_discount AS VARCHAR) END",
}


def _q(name: str) -> str:
    return '"' + name + '"'


_RAW = (
    ",\nonce AS (SELECT "
    + ",\n".join(f"{_RAW_CELLS[name]} AS {_q(name)}" for name in RAW_COLUMNS)
    + ", l_orderkey AS k FROM star),\n"
    "raw AS (SELECT * EXCLUDE k FROM once UNION ALL "
    "SELECT * EXCLUDE k FROM once WHERE k % 97 = 0),\n"
    "dedup AS (SELECT DISTINCT * FROM raw)"
)


def _number(name: str) -> str:
    return f"TRY_CAST({_q(name)} AS DOUBLE)"


def _day(name: str) -> str:
    return f"CAST(try_strptime({_q(name)}, '%d-%b-%y') AS DATE)"


def _parsed(source: str) -> str:
    """CTEs ``cells`` and ``parsed``: the typed columns of raw text rows."""
    return f""",
cells AS (SELECT *,
  CASE "PQ First Sent to Client Date" WHEN 'Pre-PQ Process' THEN 'pre_pq'
    WHEN 'Date Not Captured' THEN 'not_captured' ELSE 'date' END AS pq_flag,
  CASE "PO Sent to Vendor Date" WHEN 'N/A - From RDC' THEN 'from_rdc'
    WHEN 'Date Not Captured' THEN 'not_captured' ELSE 'date' END AS po_flag,
  CAST(try_strptime("PQ First Sent to Client Date", '%m/%d/%y') AS DATE) AS pq_date,
  CAST(try_strptime("PO Sent to Vendor Date", '%m/%d/%y') AS DATE) AS po_date,
  {_day("Scheduled Delivery Date")} AS scheduled_date,
  {_day("Delivered to Client Date")} AS delivered_date,
  {_day("Delivery Recorded Date")} AS recorded_date,
  CASE WHEN "Freight Cost (USD)" = 'Freight Included in Commodity Cost' THEN 'included'
    WHEN "Freight Cost (USD)" = 'Invoiced Separately' THEN 'invoiced'
    WHEN "Freight Cost (USD)" LIKE 'See %' THEN 'reference' ELSE 'numeric' END AS freight_flag,
  {_number("Freight Cost (USD)")} AS freight_numeric,
  {_number("Weight (Kilograms)")} AS weight_any,
  coalesce("Weight (Kilograms)" LIKE 'See %', false) AS flag_weight_reference,
  {_number("Line Item Quantity")} AS qty, {_number("Line Item Value")} AS line_value,
  {_number("Pack Price")} AS pack_price, {_number("Unit Price")} AS unit_price,
  {_number("Line Item Insurance (USD)")} AS insurance,
  {_number("Unit of Measure (Per Pack)")} AS uom
  FROM {source}),
typed AS (SELECT * EXCLUDE weight_any,
  CASE WHEN weight_any > 0 THEN weight_any END AS weight_numeric,
  coalesce(weight_any <= 0, false) AS flag_weight_not_positive,
  coalesce(line_value = 0, false) AS flag_zero_value,
  delivered_date - scheduled_date AS delay_days, po_date - pq_date AS c1_pq2po,
  scheduled_date - po_date AS c2_po2sched, delivered_date - scheduled_date AS c3_sched2deliv,
  delivered_date - pq_date AS c_total, year(delivered_date) AS delivery_year,
  strftime(delivered_date, '%Y-%m') AS delivery_month
  FROM cells),
parsed AS (SELECT *, coalesce(delay_days <= 0, false) AS ot_bool,
  coalesce(delay_days < 0, false) AS early_bool,
  coalesce(c1_pq2po < 0, false) OR coalesce(c2_po2sched < 0, false)
    OR coalesce(c_total < 0, false) AS flag_negative_cycle,
  freight_numeric / weight_numeric AS unit_freight,
  coalesce(freight_numeric / weight_numeric > {EXTREME_UNIT_FREIGHT}, false)
    AS flag_unit_freight_extreme
  FROM typed)"""


_FLAGGED = (
    ",\nfences AS (SELECT "
    + ", ".join(
        f"quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3"
        for c in OUTLIER_COLUMNS)
    + " FROM parsed),\nprepared AS (SELECT parsed.*, "
    + ", ".join(
        f"coalesce({c} < {c}_1 - 1.5 * ({c}_3 - {c}_1) OR {c} > {c}_3 + 1.5 * ({c}_3 - {c}_1),"
        f" false) AS flag_{c}_outlier" for c in OUTLIER_COLUMNS)
    + " FROM parsed, fences)"
)


def _lines(body: str, *ctes: str) -> str:
    return f"WITH {_BASE}{''.join(',' + c for c in ctes)}\n{body}"


def _from_raw(body: str) -> str:
    return f"WITH {_BASE}{_RAW}\n{body}"


def _from_parsed(body: str, source: str = "raw") -> str:
    return f"WITH {_BASE}{_RAW}{_parsed(source)}\n{body}"


def _from_prepared(body: str) -> str:
    return f"WITH {_BASE}{_RAW}{_parsed('dedup')}{_FLAGGED}\n{body}"


def _r(expression: str, alias: str | None = None) -> str:
    return f"round({expression}, 6) AS {alias or expression}"


def _pct(condition: str) -> str:
    return f"100 * avg(CASE WHEN {condition} THEN 1.0 ELSE 0.0 END)"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(f"({part})" for part in parts)


def _big(expression: str, alias: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {alias}"


_MONEY = "DECIMAL(28,6)"


def _money(column: str) -> str:
    return f"coalesce(CAST(sum(CAST({column} AS {_MONEY})) AS DOUBLE), 0)"


def _typed_select() -> str:
    out = []
    for field in CLEANED.fields:
        kind = field.dataType.typeName()
        if kind == "integer":
            out.append(_big(_q(field.name), _q(field.name)))
        else:
            out.append(_q(field.name))
    return ", ".join(out)


# ---- tails of distributions, as power series ----------------------------------------


def _chi2_tail(x: str, df: str) -> str:
    """1 - regularised lower incomplete gamma of (df/2, x/2)."""
    return f"""CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= 0 THEN 1 ELSE greatest(0, 1 - list_sum(list_transform(range(0, 3000),
      lambda i: exp(({df} / 2.0 + i) * ln({x} / 2.0) - {x} / 2.0 - lgamma({df} / 2.0 + i + 1))))) END"""


def _t_two_sided(t: str, df: str) -> str:
    """1 - regularised incomplete beta of (1/2, df/2) at t^2 / (df + t^2)."""
    x = f"({t} * {t} / ({df} + {t} * {t}))"
    return f"""CASE WHEN abs({t}) > 38 THEN 0 WHEN {t} = 0 THEN 1 ELSE greatest(0, 1 - list_sum(
      list_transform(range(0, 6000), lambda i: exp((0.5 + i) * ln({x}) + {df} / 2.0 * ln(1 - {x})
        + lgamma(0.5 + {df} / 2.0 + i) - lgamma(1.5 + i) - lgamma({df} / 2.0))))) END"""


# ---- groups and ranks ---------------------------------------------------------------


def _pooled(group: str, min_n: int | None, value: str = "delay_days") -> str:
    """CTE ``g``: (grp, v) with small groups pooled."""
    known = f"{group} IS NOT NULL AND {value} IS NOT NULL"
    if min_n is None:
        return f"g AS (SELECT {group} AS grp, {value} AS v FROM lines WHERE {known})"
    return f"""g AS (SELECT CASE WHEN count(*) OVER (PARTITION BY {group}) >= {min_n}
      THEN {group} ELSE 'Other (<{min_n})' END AS grp, {value} AS v FROM lines WHERE {known})"""


_RANKED = """ranked AS (SELECT grp, v, rank() OVER (ORDER BY v)
    + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS r, count(*) OVER (PARTITION BY v) AS t FROM g),
sums AS (SELECT grp, count(*) AS n, avg(r) AS mean_rank FROM ranked GROUP BY grp),
whole AS (SELECT CAST(count(*) AS DOUBLE) AS nn,
    sum(CAST(t AS DOUBLE) * t - 1) AS ties FROM ranked)"""
_H = """test AS (SELECT CASE WHEN count(*) > 1 THEN 12 * sum(n * (mean_rank - (nn + 1) / 2) ** 2)
    * (nn - 1) / nullif(nn ** 3 - nn - ties, 0) END AS h, count(*) - 1 AS df, nn FROM sums, whole GROUP BY nn, ties)"""
_PAIRS = """pairs AS (SELECT a.grp AS grp_a, b.grp AS grp_b, (a.mean_rank - b.mean_rank)
    / sqrt((nn * (nn + 1) / 12 - ties / (12 * (nn - 1))) * (1.0 / a.n + 1.0 / b.n)) AS z
    FROM sums a JOIN sums b ON a.grp < b.grp, whole)"""
_PAIR_P = f"tested AS (SELECT *, {_chi2_tail('(z * z)', '1')} AS p FROM pairs)"


def _bh(source: str, partition: str = "") -> str:
    """CTE ``adjusted``: step-up q-values of ``source.p``."""
    part = f"PARTITION BY {partition}" if partition else ""
    return f"""steps AS (SELECT *, p * count(*) OVER ({part})
      / count(*) OVER ({part} ORDER BY p RANGE UNBOUNDED PRECEDING) AS step FROM {source}),
adjusted AS (SELECT * EXCLUDE step, least(1, min(step) OVER ({part} ORDER BY p
      RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS q FROM steps)"""


_GROUPS = {"mode": 30, "product": None, "country": MIN_COUNTRY_ROWS, "terms": 30}


def _nested(ctes: str, body: str) -> str:
    return f"SELECT * FROM (WITH {ctes} {body})"


def _kruskal() -> str:
    return _lines(_union([
        _nested(
            f"{_pooled(group, min_n)}, {_RANKED}, {_H}",
            f"SELECT '{group}' AS grouping, {_r('h')}, {_big('df', 'df')}, "
            f"{_big('nn', 'n_total')}, {_r(_chi2_tail('h', 'df'), 'p')} FROM test",
        ) for group, min_n in _GROUPS.items()
    ]))


def _delay_by_group() -> str:
    return _lines(_union([
        _nested(
            _pooled(group, min_n),
            f"""SELECT '{group}' AS grouping, grp, count(*) AS n,
            {_r('quantile_cont(v, 0.5)', 'median')}, {_r('avg(v)', 'mean')},
            {_r('quantile_cont(v, 0.25)', 'p25')}, {_r('quantile_cont(v, 0.75)', 'p75')},
            {_r(_pct('v <= 0'), 'otd_pct')} FROM g GROUP BY grp""",
        ) for group, min_n in _GROUPS.items()
    ]))


# ---- vendor table, scorecard --------------------------------------------------------

_VENDORS = f"""vendors AS (SELECT vendor, count(*) AS lines, count(DISTINCT asn) AS asn,
    {_pct('delay_days <= 0')} AS otd,
    coalesce(avg(CASE WHEN delay_days > 0 THEN delay_days END), 0) AS avg_late,
    count(CASE WHEN delay_days > 0 THEN 1 END) AS late_n, {_money('line_value')} AS value
    FROM lines WHERE vendor IS NOT NULL GROUP BY vendor)"""
_CLASSES = f"""shares AS (SELECT *, CAST(sum(CAST(value AS {_MONEY})) OVER (
      ORDER BY value DESC, vendor ROWS UNBOUNDED PRECEDING) AS DOUBLE)
      / CAST(sum(CAST(value AS {_MONEY})) OVER () AS DOUBLE) AS cum_share FROM vendors),
classes AS (SELECT *, CASE WHEN cum_share <= 0.70 THEN 'A' WHEN cum_share <= 0.90 THEN 'B'
      ELSE 'C' END AS ABC FROM shares)"""


def _scaled(column: str, invert: bool = False) -> str:
    low, high = f"min({column}) OVER ()", f"max({column}) OVER ()"
    offset = f"({high} - {column})" if invert else f"({column} - {low})"
    return f"CASE WHEN {high} > {low} THEN {offset} / ({high} - {low}) * 100 ELSE 100 END"


def _scores(source: str) -> str:
    return f"""parts AS (SELECT *, otd AS s_otd, {_scaled('avg_late', True)} AS s_delay,
    {_scaled('value')} AS s_value, {_scaled('lines')} AS s_freq FROM {source}),
scores AS (SELECT *, 0.40 * s_otd + 0.30 * s_delay + 0.20 * s_value + 0.10 * s_freq AS score
    FROM parts),
scored AS (SELECT *, row_number() OVER (ORDER BY score DESC, vendor) AS rank FROM scores)"""


_BIG_VENDORS = f"big AS (SELECT * FROM classes WHERE lines >= {MIN_VENDOR_ROWS})"
_CARD = f"{_VENDORS}, {_CLASSES}, {_BIG_VENDORS}, {_scores('big')}"

_SEGMENTS = ["c1_pq2po", "c2_po2sched", "c3_sched2deliv", "c_total"]


def _segments(where: str = "true") -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{s}' AS segment, {s} AS days FROM lines WHERE {where}" for s in _SEGMENTS)
    return f"seg AS (SELECT * FROM ({rows}) WHERE days >= 0 AND days < 2000)"


_SEGMENT_TABLE = f"""SELECT segment, count(*) AS n, {_r('quantile_cont(days, 0.5)', 'median')},
  {_r('avg(days)', 'mean')}, {_r('quantile_cont(days, 0.25)', 'p25')},
  {_r('quantile_cont(days, 0.75)', 'p75')} FROM seg GROUP BY segment"""


def _boxes(group: str, value: str, source: str) -> str:
    return f"""SELECT {group}, count(*) AS n, {_r('any_value(q1)', 'q1')},
      {_r('any_value(q2)', 'median')}, {_r('any_value(q3)', 'q3')},
      {_r('least(min(v) FILTER (v >= lo AND v <= hi), any_value(q1))', 'whisker_low')},
      {_r('greatest(max(v) FILTER (v >= lo AND v <= hi), any_value(q3))', 'whisker_high')},
      count(*) FILTER (v < lo OR v > hi) AS outlier_n
      FROM (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
        FROM (SELECT {group}, CAST({value} AS DOUBLE) AS v,
          quantile_cont({value}, 0.25) OVER w AS q1, quantile_cont({value}, 0.5) OVER w AS q2,
          quantile_cont({value}, 0.75) OVER w AS q3 FROM {source}
          WHERE {group} IS NOT NULL AND {value} IS NOT NULL WINDOW w AS (PARTITION BY {group})))
      GROUP BY {group}"""


def _boxes_by(groups: list[str], value: str) -> str:
    return _lines(_union([
        f"SELECT '{g}' AS grouping, {g} AS grp, * EXCLUDE ({g}) FROM ({_boxes(g, value, 'lines')})"
        for g in groups
    ]))


_COST_ROWS = """comp AS (SELECT *, freight_numeric
    / nullif(line_value + freight_numeric + insurance, 0) AS share FROM lines
    WHERE freight_flag = 'numeric' AND line_value >= 0 AND freight_numeric IS NOT NULL
      AND insurance IS NOT NULL)"""

# ---- regression ---------------------------------------------------------------------

_MODES = ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "N/A"]
_TERMS = ["AO", "NF", "NO", "RF", "RO"]
_TERM_NAMES = (
    ["Intercept"] + [f"mode[{m}]" for m in _MODES] + [f"terms[{t}]" for t in _TERMS]
    + [f"product[{p}]" for p in PRODUCTS[1:]] + ["log_weight_w", "log_value_w", "year_c"]
)
_P = len(_TERM_NAMES)


def _regression() -> str:
    """CTEs up to ``coefs`` and ``fit``: normal equations solved by the sweep operator."""
    design = (
        ["1.0"] + [f"CAST(mode = '{m}' AS INTEGER)" for m in _MODES]
        + [f"CAST(terms = '{t}' AS INTEGER)" for t in _TERMS]
        + [f"CAST(product = '{p}' AS INTEGER)" for p in PRODUCTS[1:]]
        + ["lw", "lv", "yc", "y"]
    )
    names = ", ".join(f"'{name}'" for name in _TERM_NAMES)
    order = "list_sort(list(x) FILTER (x IS NOT NULL))"
    return f"""
sample AS (SELECT mode, terms, product, ln(1 + unit_freight) AS y,
    ln(greatest(weight_numeric, 1e-6)) AS w0,
    CASE WHEN line_value IS NOT NULL THEN ln(1 + greatest(line_value, 0)) END AS v0,
    delivery_year - 2006 AS yc FROM lines WHERE freight_flag = 'numeric'
    AND weight_numeric IS NOT NULL AND unit_freight <= {EXTREME_UNIT_FREIGHT}),
ends AS (SELECT {order.replace('x', 'w0')} AS ws, {order.replace('x', 'v0')} AS vs FROM sample),
cuts AS (SELECT ws[1 + len(ws) // 100] AS wl, ws[len(ws) - len(ws) // 100] AS wh,
    vs[1 + len(vs) // 100] AS vl, vs[len(vs) - len(vs) // 100] AS vh FROM ends),
trimmed AS (SELECT mode, terms, product, y, CAST(yc AS DOUBLE) AS yc,
    least(greatest(w0, wl), wh) AS lw, least(greatest(v0, vl), vh) AS lv FROM sample, cuts
    WHERE mode IS NOT NULL AND yc IS NOT NULL AND v0 IS NOT NULL),
design AS (SELECT [{', '.join(f'CAST({d} AS DOUBLE)' for d in design)}] AS x FROM trimmed),
gram AS (SELECT i, j, sum(x[i] * x[j]) AS v FROM design, range(1, {_P + 2}) a(i),
    range(1, {_P + 2}) b(j) GROUP BY i, j),
sweep AS (SELECT 0 AS k, i, j, v FROM gram UNION ALL
  SELECT a.k + 1, a.i, a.j, CASE WHEN a.i = a.k + 1 AND a.j = a.k + 1 THEN 1 / d.v
      WHEN a.i = a.k + 1 THEN a.v / d.v WHEN a.j = a.k + 1 THEN -a.v / d.v
      ELSE a.v - r.v * c.v / d.v END
  FROM sweep a JOIN sweep d ON d.i = a.k + 1 AND d.j = a.k + 1
  JOIN sweep r ON r.i = a.i AND r.j = a.k + 1 JOIN sweep c ON c.i = a.k + 1 AND c.j = a.j
  WHERE a.k < {_P}),
solved AS (SELECT * FROM sweep WHERE k = {_P}),
sizes AS (SELECT max(v) FILTER (i = 1 AND j = 1) AS n,
    max(v) FILTER (i = {_P + 1} AND j = {_P + 1})
      - max(v) FILTER (i = 1 AND j = {_P + 1}) ** 2 / max(v) FILTER (i = 1 AND j = 1) AS tss
    FROM gram),
fit AS (SELECT n, tss, v AS rss, n - {_P} AS nu FROM solved, sizes
    WHERE i = {_P + 1} AND j = {_P + 1}),
normal AS (SELECT 1.959963984540054 AS z),
reach AS (SELECT z + (z**3 + z) / (4 * nu) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * nu**2)
    AS tq FROM fit, normal),
coefs AS (SELECT list_extract([{names}], CAST(b.i AS INTEGER)) AS term, b.v AS coef,
    sqrt(inv.v * rss / nu) AS std_err, nu, tq
    FROM solved b JOIN solved inv ON inv.i = b.i AND inv.j = b.i, fit, reach
    WHERE b.j = {_P + 1} AND b.i <= {_P})"""


def _lines_recursive(body: str, ctes: str) -> str:
    return f"WITH RECURSIVE {_BASE},{ctes}\n{body}"


_SPEARMAN = """xy AS (SELECT rank() OVER (ORDER BY line_value)
      + (count(*) OVER (PARTITION BY line_value) - 1) / 2.0 AS rx,
    rank() OVER (ORDER BY insurance) + (count(*) OVER (PARTITION BY insurance) - 1) / 2.0 AS ry
    FROM lines WHERE line_value > 0 AND insurance IS NOT NULL),
rho AS (SELECT corr(rx, ry) AS rho, count(*) AS n, count(*) - 2 AS nu FROM xy),
rho_t AS (SELECT *, rho * sqrt(nu / ((1 - rho) * (1 + rho))) AS t FROM rho)"""

_P_VALUES = """pv AS (SELECT id, item, country AS test_id,
    insurance / 12000 * qty / 50 AS p FROM lines WHERE insurance IS NOT NULL)"""


def _winsorized(column: str) -> str:
    return f"""least(greatest({column}, {column}_s[1 + len({column}_s) // 100]),
      {column}_s[len({column}_s) - len({column}_s) // 100])"""


def _quantiles(measure: str, shares: list[float]) -> str:
    return _union([
        f"SELECT '{measure}' AS measure, CAST({s} AS DOUBLE) AS share, "
        f"{_r(f'quantile_cont({measure}, {s})', 'value')} FROM lines" for s in shares
    ])


def _counts(column: str) -> str:
    return (f"SELECT '{column}' AS field, CAST({column} AS VARCHAR) AS category, count(*) AS n "
            f"FROM lines WHERE {column} IS NOT NULL GROUP BY ALL")


def _rules(rules: list[tuple[str, str, str, str]], source: str) -> str:
    return _union([
        f"SELECT '{field}' AS field, '{issue}' AS issue, '{treatment}' AS treatment, "
        f"count(*) AS n FROM {source} WHERE {condition}"
        for field, issue, treatment, condition in rules
    ])


def _decision_log() -> str:
    pq, po = "PQ First Sent to Client Date", "PO Sent to Vendor Date"
    freight, weight = "Freight Cost (USD)", "Weight (Kilograms)"
    dates = {"Scheduled Delivery Date": "scheduled_date",
             "Delivered to Client Date": "delivered_date",
             "Delivery Recorded Date": "recorded_date"}
    rules = [
        (pq, "not yet in the quotation process", "pq_flag = pre_pq, date null",
         "pq_flag = 'pre_pq'"),
        (pq, "date not captured", "pq_flag = not_captured, date null",
         "pq_flag = 'not_captured'"),
        (po, "shipped from a distribution centre, no vendor order",
         "po_flag = from_rdc, date null", "po_flag = 'from_rdc'"),
        (po, "date not captured", "po_flag = not_captured, date null",
         "po_flag = 'not_captured'"),
        (pq, "unreadable date", "date set to null, row flagged",
         "pq_flag = 'date' AND pq_date IS NULL"),
        (po, "unreadable date", "date set to null, row flagged",
         "po_flag = 'date' AND po_date IS NULL"),
        *[(text, "unreadable date", "date null, counted",
           f"{_q(text)} IS NOT NULL AND {d} IS NULL") for text, d in dates.items()],
        *[(freight, f"text marker {kind}", "freight_flag set, number null",
           f"freight_flag = '{kind}'") for kind in ("included", "invoiced", "reference")],
        (weight, "text reference", "number null, flag_weight_reference", "flag_weight_reference"),
        (weight, "number <= 0", "number null", "flag_weight_not_positive"),
        ("Line Item Value", "value is 0", "kept, flag_zero_value", "flag_zero_value"),
        *[(c, "outside the Tukey fences", f"flag_{c}_outlier, kept", f"flag_{c}_outlier")
          for c in OUTLIER_COLUMNS],
        ("cycle segments", "negative cycle", "flag_negative_cycle", "flag_negative_cycle"),
        ("unit_freight", "above the extreme threshold",
         "flag_unit_freight_extreme, not used in regression", "flag_unit_freight_extreme"),
    ]
    years = [(f"{name} Date", "year outside the plausible range", "flag_bad_date, value kept",
              f"year({d}) NOT BETWEEN 2000 AND 2025")
             for name, d in (("PQ", "pq_date"), ("PO", "po_date"),
                             ("Scheduled", "scheduled_date"), ("Delivered", "delivered_date"),
                             ("Recorded", "recorded_date"))]
    return _from_prepared(_union([
        _DUPLICATES.format(issue_id="'repeated key' AS issue, 'counted only' AS treatment,",
                           issue_row="'exact duplicate' AS issue, 'first copy kept' AS treatment,",
                           issue_key="'repeated business key' AS issue, 'counted only' AS treatment,"),
        _rules(rules, "prepared"),
        f"SELECT * FROM ({_rules(years, 'prepared')}) WHERE n > 0",
    ]))


_DUPLICATES = """SELECT 'ID' AS field, {issue_id} CAST(sum(n - 1) AS BIGINT) AS n
  FROM (SELECT count(*) AS n FROM raw GROUP BY "ID")
UNION ALL SELECT 'full row', {issue_row} CAST(sum(n - 1) AS BIGINT)
  FROM (SELECT count(*) AS n FROM raw GROUP BY ALL HAVING true)
UNION ALL SELECT 'business key', {issue_key} CAST(sum(n - 1) AS BIGINT)
  FROM (SELECT count(*) AS n FROM raw GROUP BY "PO / SO #", "Item Description")""".replace(
    "FROM raw GROUP BY ALL HAVING true",
    "FROM raw GROUP BY " + ", ".join(_q(c) for c in RAW_COLUMNS),
)

_FENCE_COLUMNS = ["qty", "line_value", "unit_price", "weight_numeric", "freight_numeric",
                  "insurance"]


def all_oracles() -> dict[str, str]:
    heads = {}
    heads["read_raw"] = _from_raw("SELECT * FROM raw")
    heads["read_cleaned"] = heads["write_cleaned"] = _from_prepared(
        f"SELECT {_typed_select()} FROM prepared")
    heads["profile"] = _from_parsed(f"""SELECT (SELECT count(*) FROM raw) AS n_raw,
      count(*) AS n_rows, count(DISTINCT "Country") AS countries,
      count(DISTINCT "Vendor") AS vendors, count(delay_days) AS delay_n,
      {_r('avg(delay_days)', 'delay_mean')},
      {_r('quantile_cont(delay_days, 0.5)', 'delay_median')},
      count(unit_freight) AS unit_freight_n FROM parsed""", "dedup")
    heads["value_counts"] = _lines(_union(
        [_counts(c) for c in ("product", "subclass", "delivery_year", "freight_flag", "mode")]))
    heads["quantile_table"] = _lines(_union([
        _quantiles("delay_days", [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]),
        _quantiles("unit_freight", [0.5, 0.75, 0.9, 0.95, 0.99, 0.999]),
    ]))
    heads["decision_log"] = _decision_log()

    heads["dup_counts"] = _from_raw(_DUPLICATES.format(issue_id="", issue_row="", issue_key=""))
    heads["dedup_full_row"] = _from_raw("SELECT * FROM dedup")
    heads["sentinel_flag"] = _from_parsed(
        "SELECT pq_flag, po_flag, count(*) AS n FROM parsed GROUP BY ALL")
    heads["parse_date_lenient"] = _from_parsed("""SELECT "ID", "Item Description", pq_date,
      po_date, scheduled_date, delivered_date, recorded_date FROM parsed""")
    heads["bad_date_count"] = _from_parsed("""SELECT 'pq' AS field, count(*) AS n FROM parsed
      WHERE pq_flag = 'date' AND pq_date IS NULL UNION ALL
      SELECT 'po', count(*) FROM parsed WHERE po_flag = 'date' AND po_date IS NULL""")
    heads["year_range_check"] = _from_parsed(_union([
        f"SELECT '{d}' AS field, count(*) AS n FROM parsed "
        f"WHERE year({d}) NOT BETWEEN 2000 AND 2025"
        for d in ("pq_date", "po_date", "scheduled_date", "delivered_date", "recorded_date")]))
    heads["text_number_split"] = _from_parsed(
        'SELECT "ID", "Item Description", freight_flag, freight_numeric FROM parsed')
    heads["weight_clean"] = _from_parsed(
        'SELECT "ID", "Item Description", weight_numeric, flag_weight_reference, '
        "flag_weight_not_positive FROM parsed")
    numbers = ("qty", "line_value", "pack_price", "unit_price", "insurance", "uom")
    heads["to_numeric"] = _from_parsed(
        'SELECT "ID", "Item Description", ' + ", ".join(numbers) + " FROM parsed")
    heads["zero_flag"] = _from_parsed(
        "SELECT flag_zero_value, count(*) AS n FROM parsed GROUP BY ALL")
    heads["iqr_outlier_flags"] = _from_prepared(_union([
        f"SELECT '{c}' AS field, count(*) AS n FROM prepared WHERE flag_{c}_outlier"
        for c in OUTLIER_COLUMNS]))
    heads["iqr_fences"] = _lines(_union([
        f"""SELECT '{c}' AS "column", {_r('q1')}, {_r('q3')},
        {_r('q1 - 1.5 * (q3 - q1)', 'low')}, {_r('q3 + 1.5 * (q3 - q1)', 'high')}
        FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM lines)"""
        for c in _FENCE_COLUMNS]))

    heads["delay_features"] = _lines(f"""SELECT id, {_big('delay_days', 'delay_days')},
      coalesce(delay_days <= 0, false) AS ot_bool, coalesce(delay_days < 0, false) AS early_bool
      FROM lines""")
    heads["cycle_features"] = _lines(
        "SELECT id, " + ", ".join(_big(s, s) for s in _SEGMENTS)
        + """, coalesce(least(c1_pq2po, c2_po2sched, c_total) < 0, false) AS flag_negative_cycle
        FROM lines""")
    heads["unit_freight"] = _lines(f"""SELECT id, unit_freight,
      coalesce(unit_freight > {EXTREME_UNIT_FREIGHT}, false) AS flag_unit_freight_extreme
      FROM lines""")
    heads["calendar"] = _lines(f"""SELECT id, {_big('delivery_year', 'delivery_year')},
      delivery_month, CAST(date_trunc('month', delivered_date) AS DATE) AS month_start
      FROM lines""")
    heads["late_delay"] = _lines(f"""SELECT id, {_big('delay_days', 'delay_days')},
      {_big('CASE WHEN delay_days > 0 THEN delay_days END', 'late_delay')} FROM lines""")
    heads["log_features"] = _lines(f"""SELECT id, {_r('ln(1 + unit_freight)', 'log_uf')},
      {_r('CASE WHEN weight_numeric IS NOT NULL THEN ln(greatest(weight_numeric, 1e-6)) END',
          'log_weight')},
      {_r('CASE WHEN line_value IS NOT NULL THEN ln(1 + greatest(line_value, 0)) END',
          'log_value')}, {_big('delivery_year - 2006', 'year_c')} FROM lines""")
    heads["ratio_features"] = _lines(f"""
      SELECT id, 'insurance_rate' AS ratio, {_r('insurance / line_value', 'share')}
      FROM lines WHERE insurance IS NOT NULL AND line_value > 0 UNION ALL
      SELECT id, 'with_insurance', {_r('share')} FROM comp UNION ALL
      SELECT id, 'without_insurance',
        {_r('freight_numeric / nullif(line_value + freight_numeric, 0)', 'share')} FROM lines
      WHERE freight_flag = 'numeric' AND line_value >= 0 AND freight_numeric IS NOT NULL""",
      _COST_ROWS)
    heads["collapse_rare"] = _lines(f"""SELECT CASE WHEN n >= {MIN_COUNTRY_ROWS} THEN country
      ELSE 'Other (<{MIN_COUNTRY_ROWS})' END AS country, CAST(sum(n) AS BIGINT) AS n
      FROM (SELECT country, count(*) AS n FROM lines GROUP BY country) GROUP BY 1""")
    heads["clip"] = _lines(f"""SELECT id, {_big('''CASE WHEN delay_days IS NOT NULL
      THEN least(greatest(delay_days, -140), 160) END''', 'clipped')} FROM lines""")

    heads["winsorize"] = _lines(
        f"""SELECT id, CASE WHEN freight_numeric IS NOT NULL
          THEN round({_winsorized('freight_numeric')}, 6) END AS freight_w,
        CASE WHEN insurance IS NOT NULL THEN round({_winsorized('insurance')}, 6) END
          AS insurance_w FROM lines, ends""",
        """ends AS (SELECT
          list_sort(list(freight_numeric) FILTER (freight_numeric IS NOT NULL)) AS freight_numeric_s,
          list_sort(list(insurance) FILTER (insurance IS NOT NULL)) AS insurance_s FROM lines)""")
    heads["avg_rank"] = _lines(_union([
        f"""SELECT '{c}' AS measure, round(CAST({c} AS DOUBLE), 6) AS value, count(*) AS n,
        round(sum(count(*)) OVER (ORDER BY {c}) - (count(*) - 1) / 2.0, 6) AS avg_rank
        FROM lines WHERE {c} IS NOT NULL GROUP BY {c}""" for c in ("insurance", "delay_days")]))
    heads["running_share"] = _lines(
        f"""SELECT vendor, {_r('value')}, {_r('cum_share')},
        row_number() OVER (ORDER BY value DESC, vendor) AS position FROM shares""",
        _VENDORS, _CLASSES)

    heads["delay_overview"] = _lines(f"""SELECT count(*) AS n, count(delay_days) AS delay_n,
      count(*) FILTER (delay_days <= 0) AS on_time_n, {_r(_pct('delay_days <= 0'), 'otd_pct')},
      {_r('avg(delay_days)', 'mean_delay')},
      {_r('quantile_cont(delay_days, 0.5)', 'median_delay')},
      count(*) FILTER (delay_days < 0) AS early_n, {_r(_pct('delay_days < 0'), 'early_pct')},
      count(*) FILTER (delay_days > 0) AS late_n,
      {_r('quantile_cont(delay_days, 0.5) FILTER (delay_days > 0)', 'late_median')},
      {_r('quantile_cont(delay_days, 0.95) FILTER (delay_days > 0)', 'late_p95')},
      {_r('quantile_cont(delay_days, 0.99) FILTER (delay_days > 0)', 'late_p99')} FROM lines""")
    heads["delay_by_group"] = _delay_by_group()
    heads["late_by_vendor"] = _lines(f"""SELECT vendor, count(*) AS late_n,
      {_r('quantile_cont(delay_days, 0.5)', 'late_median')},
      {_r('quantile_cont(delay_days, 0.9)', 'late_p90')} FROM lines WHERE delay_days > 0
      GROUP BY vendor HAVING count(*) >= {MIN_LATE_ROWS} ORDER BY late_n DESC, vendor LIMIT 10""")
    heads["monthly_trend"] = _lines(f"""SELECT
      CAST(date_trunc('month', delivered_date) AS DATE) AS month, count(*) AS n,
      {_r(_pct('delay_days <= 0'), 'otd_pct')}, {_r('quantile_cont(delay_days, 0.5)', 'median')}
      FROM lines WHERE delay_days IS NOT NULL GROUP BY 1""")
    heads["cycle_segments"] = _lines(_SEGMENT_TABLE, _segments())
    heads["cycle_segments_ordered"] = _lines(_SEGMENT_TABLE, _segments("po_flag = 'date'"))
    heads["freight_overview"] = _lines(f"""SELECT count(freight_numeric) AS n,
      {_r('any_value(q2)', 'median')}, {_r('avg(freight_numeric)', 'mean')},
      {_r('any_value(q95)', 'p95')}, {_r('max(freight_numeric)', 'max')},
      count(*) FILTER (freight_numeric < q1 - 1.5 * (q3 - q1)
        OR freight_numeric > q3 + 1.5 * (q3 - q1)) AS outlier_n FROM lines, f""",
      """f AS (SELECT quantile_cont(freight_numeric, 0.25) AS q1,
        quantile_cont(freight_numeric, 0.5) AS q2, quantile_cont(freight_numeric, 0.75) AS q3,
        quantile_cont(freight_numeric, 0.95) AS q95 FROM lines)""")
    heads["unit_freight_by"] = _lines(_union([
        f"""SELECT '{g}' AS grouping, {g} AS grp, count(*) AS n,
        {_r('quantile_cont(unit_freight, 0.5)', 'median')}, {_r('avg(unit_freight)', 'mean')},
        {_r('quantile_cont(unit_freight, 0.9)', 'p90')} FROM lines
        WHERE unit_freight IS NOT NULL AND {g} IS NOT NULL GROUP BY {g}"""
        for g in ("mode", "terms")]))
    heads["insurance_summary"] = _lines(f"""SELECT count(*) FILTER (insurance > 0) AS nonzero_n,
      count(*) FILTER (insurance = 0) AS zero_n,
      {_r('quantile_cont(insurance / line_value, 0.5)', 'median_rate')} FROM lines
      WHERE line_value > 0 AND insurance IS NOT NULL""")
    share = f"{_r('quantile_cont(share, 0.5)', 'median')}, {_r('avg(share)', 'mean')}"
    heads["freight_share_by_mode"] = _lines(f"""
      SELECT mode, count(*) AS n, {share} FROM comp WHERE mode IS NOT NULL GROUP BY mode
      UNION ALL SELECT NULL, count(*), {share} FROM comp""", _COST_ROWS)
    heads["yearly_cost_composition"] = _lines(f"""SELECT
      {_big('delivery_year', 'delivery_year')}, {_r(_money('line_value'), 'commodity')},
      {_r(_money('freight_numeric'), 'freight')}, {_r(_money('insurance'), 'insurance')}
      FROM comp WHERE delivery_year IS NOT NULL GROUP BY delivery_year""", _COST_ROWS)
    vendor_columns = f"""vendor, lines, asn, {_r('otd')}, {_r('avg_late')}, late_n,
      {_r('value')}"""
    heads["vendor_metrics"] = _lines(f"SELECT {vendor_columns} FROM vendors", _VENDORS)
    heads["score_split"] = _lines(f"""SELECT CASE WHEN lines >= {MIN_VENDOR_ROWS} THEN 'scored'
      ELSE 'watch' END AS list, count(*) AS vendors, CAST(sum(lines) AS BIGINT) AS lines
      FROM vendors GROUP BY 1""", _VENDORS)
    heads["abc_summary"] = _lines(f"""SELECT ABC, count(*) AS vendors,
      {_r(_money('value'), 'value')}, CAST(sum(lines) AS BIGINT) AS lines,
      round({_money('value')} / (SELECT {_money('value')} FROM classes), 6) AS value_share
      FROM classes GROUP BY ABC""", _VENDORS, _CLASSES)

    heads["minmax_norm"] = _lines(f"""SELECT vendor, {_r(_scaled('avg_late', True), 'late_norm')},
      {_r(_scaled('value'), 'value_norm')} FROM vendors""", _VENDORS)
    heads["weighted_score"] = _lines(
        f"SELECT vendor, {_r('score')} FROM scored", _VENDORS, _scores("vendors"))
    heads["score_rank"] = _lines(f"SELECT rank, vendor, {_r('score')} FROM scored", _CARD)
    heads["abc_class"] = _lines(
        f"SELECT vendor, {_r('value')}, {_r('cum_share')}, ABC FROM classes", _VENDORS, _CLASSES)
    heads["row_share"] = _lines(f"""SELECT country, product, {_r('value')},
      round(value / nullif(sum(value) OVER (PARTITION BY country), 0), 6) AS share FROM (
      SELECT country, product, {_money('line_value')} AS value FROM lines GROUP BY ALL)""")
    heads["scorecard"] = _lines(f"""SELECT rank, ABC, {vendor_columns}, {_r('s_otd')},
      {_r('s_delay')}, {_r('s_value')}, {_r('s_freq')}, {_r('score')} FROM scored""", _CARD)
    heads["watch_list"] = _lines(f"""SELECT vendor, ABC, lines, asn, {_r('otd')},
      {_r('avg_late')}, {_r('value')} FROM classes WHERE lines < {MIN_VENDOR_ROWS}""",
      _VENDORS, _CLASSES)

    heads["abc_lookup"] = _lines(f"""SELECT id, lines.vendor, ABC FROM lines LEFT JOIN
      (SELECT vendor, ABC FROM classes WHERE lines >= {MIN_VENDOR_ROWS}) c
      ON lines.vendor = c.vendor""", _VENDORS, _CLASSES)
    heads["semi_top_n"] = _lines("""SELECT id, country FROM lines WHERE country IN (
      SELECT country FROM lines GROUP BY country ORDER BY count(*) DESC, country LIMIT 5)""")
    heads["cell_mask"] = _lines(f"""SELECT terms, product, count(*) AS n, CASE WHEN
      count(*) >= 1660 THEN round(quantile_cont(delay_days, 0.5), 6) END AS median
      FROM lines GROUP BY terms, product""")
    heads["group_pairs"] = _lines(f"""SELECT a.grp AS grp_a, a.n AS n_a,
      {_r('a.mean_rank', 'mean_rank_a')}, b.grp AS grp_b, b.n AS n_b,
      {_r('b.mean_rank', 'mean_rank_b')} FROM sums a JOIN sums b ON a.grp < b.grp""",
      _pooled("country", None), _RANKED)
    heads["country_mode_heatmap"] = _lines(f"""SELECT country, mode, n,
      CASE WHEN n >= {MIN_CELL_ROWS} THEN round(m, 6) END AS median_delay FROM cells
      WHERE country IN (SELECT country FROM cells GROUP BY country
        ORDER BY sum(n) DESC, country LIMIT 15)""",
      """cells AS (SELECT country, mode, count(*) AS n, quantile_cont(delay_days, 0.5) AS m
      FROM lines WHERE mode IS NOT NULL GROUP BY country, mode)""")
    heads["vendor_product_cross"] = _lines(
        "SELECT vendor, " + ", ".join(
            f"round(coalesce(CAST(sum(CAST(line_value AS {_MONEY})) FILTER (product = '{p}') "
            f'AS DOUBLE), 0), 6) AS "{p}"' for p in PRODUCTS)
        + " FROM lines WHERE vendor IN (SELECT vendor FROM scored WHERE rank <= 8) "
        "GROUP BY vendor", _CARD)
    heads["top_bottom"] = _lines(f"""SELECT 'top' AS part, rank, vendor, {_r('score')}
      FROM scored WHERE rank <= 20 UNION ALL SELECT 'bottom', rank, vendor, {_r('score')}
      FROM scored WHERE rank > (SELECT count(*) FROM scored) - 10""", _CARD)
    month = "strftime(date_trunc('month', delivered_date), '%Y-%m-%d')"
    parts = [
        ("all", "NULL", "NULL", "delay_days"), ("mode", "mode", "NULL", "delay_days"),
        ("product", "product", "NULL", "delay_days"), ("country", "country", "NULL", "delay_days"),
        ("terms", "terms", "NULL", "delay_days"), ("vendor", "vendor", "NULL", "delay_days"),
        ("delivered_date", month, "NULL", "delay_days"),
        ("country, mode", "country", "mode", "delay_days"),
    ] + [("segment", f"'{s}'", "NULL", s) for s in (
        "c1_pq2po", "c2_po2sched", "c3_sched2deliv", "c_total")]
    heads["day_cube"] = _lines(
        "SELECT grouping, key_0, key_1, day, count(*) AS n FROM listed "
        "WHERE grouping <> 'segment' OR day IS NOT NULL GROUP BY ALL",
        "listed AS (" + " UNION ALL ".join(
            f"SELECT '{name}' AS grouping, CAST({a} AS VARCHAR) AS key_0, "
            f"CAST({b} AS VARCHAR) AS key_1, CAST({day} AS BIGINT) AS day FROM lines"
            for name, a, b, day in parts) + ")")
    heads["top_n_by_count"] = _lines(f"""SELECT country, count(*) AS n,
      {_r('quantile_cont(delay_days, 0.5)', 'median')} FROM lines GROUP BY country
      ORDER BY n DESC, country LIMIT 10""")
    heads["segments_union"] = _lines(
        f"SELECT segment, {_big('days', 'days')}, count(*) AS n FROM seg GROUP BY segment, days",
        _segments())

    heads["kruskal_wallis"] = _kruskal()
    pair = f"grp_a, grp_b, {_r('z')}, {_r('p')}"
    heads["dunn_posthoc"] = _lines(
        f"SELECT {pair} FROM tested", _pooled("country", MIN_COUNTRY_ROWS), _RANKED, _PAIRS,
        _PAIR_P)
    heads["dunn_gated"] = _lines(
        f"SELECT {pair}, {_r('q')} FROM adjusted, test "
        f"WHERE {_chi2_tail('h', 'df')} < 0.9999",
        _pooled("product", 30, "unit_price"), _RANKED, _H, _PAIRS, _PAIR_P, _bh("tested"))
    heads["dunn_gate_closed"] = heads["dunn_gated"].replace("< 0.9999", "< 1e-12")
    heads["significant_pairs"] = _lines(
        f"SELECT {pair}, {_r('q')} FROM adjusted WHERE q < 0.9", _pooled("country", None),
        _RANKED, _PAIRS, _PAIR_P, _bh("tested"))
    heads["bh_fdr"] = _lines("SELECT id, item, test_id, p, q FROM adjusted",
                             _P_VALUES, _bh("pv", "test_id"))
    heads["bh_fdr_single"] = _lines("SELECT id, item, p, q FROM adjusted",
                                    _P_VALUES, _bh("pv"))
    interval = "coef - tq * std_err", "coef + tq * std_err"
    heads["ols_drivers"] = _lines_recursive(f"""SELECT term, {_r('coef')}, {_r('std_err')},
      {_r('coef / std_err', 't')}, {_r(_t_two_sided('(coef / std_err)', 'nu'), 'p')},
      {_r(interval[0], 'ci_low')}, {_r(interval[1], 'ci_high')}, {_r('exp(coef)', 'exp_coef')}
      FROM coefs""", _regression())
    heads["ols_drivers_summary"] = _lines_recursive(f"""SELECT {_big('n', 'n')},
      {_big(str(_P), 'terms')}, {_big(str(_P), 'rank')}, false AS collinear,
      {_big(str(_P - 1), 'df_model')}, {_big('nu', 'df_resid')}, {_r('1 - rss / tss', 'r2')},
      {_r('1 - rss / tss * (n - 1) / nu', 'adj_r2')},
      {_r(f'(tss - rss) / {_P - 1} / (rss / nu)', 'f')},
      CASE WHEN (tss - rss) / {_P - 1} / (rss / nu) > 100 THEN CAST(0 AS DOUBLE) END AS f_p
      FROM fit""", _regression())
    heads["coef_order"] = _lines_recursive(f"""SELECT term, {_r('coef')},
      {_r('tq * std_err', 'below')}, {_r('tq * std_err', 'above')},
      row_number() OVER (ORDER BY coef, term) AS place FROM coefs""", _regression())
    heads["spearman"] = _lines(
        f"SELECT {_r('rho')}, n, {_r(_t_two_sided('t', 'nu'), 'p')} FROM rho_t", _SPEARMAN)

    heads["histogram"] = _lines("""SELECT CAST(b.bin AS BIGINT) AS bin,
      CAST(-140 + 5 * b.bin AS BIGINT) AS start, count(c.bin) AS n FROM range(0, 60) b(bin)
      LEFT JOIN (SELECT least((least(greatest(delay_days, -140), 160) + 140) // 5, 59) AS bin
        FROM lines WHERE delay_days IS NOT NULL) c ON b.bin = c.bin GROUP BY b.bin""")
    heads["box_stats"] = _boxes_by(["mode", "country"], "delay_days")
    heads["box_stats_top_countries"] = _lines(_boxes("country", "delay_days", "top"),
        """top AS (SELECT * FROM lines WHERE country IN (SELECT country FROM lines
        GROUP BY country ORDER BY count(*) DESC, country LIMIT 10))""")
    heads["box_stats_segments"] = _lines(_boxes("segment", "days", "seg"), _segments())
    heads["box_stats_unit_freight"] = _boxes_by(["mode", "terms"], "unit_freight")
    cell = "CAST(floor(log10({}) * 10) AS BIGINT) AS {}_cell"
    heads["log_density"] = _lines(f"""SELECT mode, {cell.format('weight_numeric', 'x')},
      {cell.format('freight_numeric', 'y')}, count(*) AS n,
      CAST(sum(count(*)) OVER (PARTITION BY mode) AS BIGINT) AS group_n FROM lines
      WHERE mode IS NOT NULL AND weight_numeric > 0 AND freight_numeric > 0 GROUP BY 1, 2, 3""")
    heads["log_density_insurance"] = _lines(f"""SELECT {cell.format('line_value', 'x')},
      {cell.format('insurance', 'y')}, count(*) AS n,
      CAST(sum(count(*)) OVER () AS BIGINT) AS group_n FROM lines
      WHERE line_value > 0 AND insurance > 0 GROUP BY 1, 2""")
    heads["bubble_points"] = _lines(f"""SELECT vendor, {_r('otd')}, {_r('value')},
      greatest(lines, 10) AS size, {_r('score')}, score < 50 AS highlight FROM scored""", _CARD)
    heads["radar_points"] = _lines(_union([
        f"SELECT rank, vendor, '{s}' AS part, {_r(s, 'score')} FROM scored WHERE rank <= 6"
        for s in ("s_otd", "s_delay", "s_value", "s_freq")]), _CARD)

    otd = f"""count(*) AS n, {_r(_pct('delay_days <= 0'), 'otd_pct')},
      {_r('quantile_cont(delay_days, 0.5)', 'median_delay')}"""
    heads["otd_by_mode"] = _lines(f"""SELECT mode, {otd}, {_r('avg(delay_days)', 'mean_delay')}
      FROM lines WHERE mode IS NOT NULL GROUP BY mode""")
    heads["otd_by_product"] = _lines(f"SELECT product, {otd} FROM lines GROUP BY product")
    heads["otd_by_country"] = _lines(f"""SELECT country, {otd} FROM lines GROUP BY country
      HAVING count(*) >= {MIN_COUNTRY_ROWS + 50}""")
    heads["unit_freight_pivot"] = _lines(f"""SELECT mode, count(*) AS n,
      {_r('quantile_cont(unit_freight, 0.5)', 'median_usd_kg')},
      {_r('quantile_cont(unit_freight, 0.9)', 'p90_usd_kg')} FROM lines
      WHERE unit_freight IS NOT NULL AND mode IS NOT NULL GROUP BY mode""")
    heads["cycle_pivot"] = _lines(
        f"SELECT segment, n, median, mean FROM ({_SEGMENT_TABLE})", _segments())
    heads["supplier_summary"] = _lines(f"""SELECT vendor, count(*) AS lines,
      {_r(_pct('delay_days <= 0'), 'otd_pct')},
      {_r('avg(CASE WHEN delay_days > 0 THEN delay_days END)', 'avg_late_days')},
      {_r(_money('line_value'), 'value')} FROM lines GROUP BY vendor
      HAVING count(*) >= {MIN_VENDOR_ROWS}""")
    heads["freight_share_pivot"] = _lines(f"""SELECT mode, count(*) AS n,
      {_r('quantile_cont(100 * freight_numeric / nullif(line_value + freight_numeric, 0), 0.5)',
          'median_pct')} FROM lines WHERE freight_flag = 'numeric' AND line_value >= 0
      AND freight_numeric IS NOT NULL AND mode IS NOT NULL GROUP BY mode""")
    return heads
