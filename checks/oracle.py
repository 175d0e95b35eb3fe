"""The registered queries as SQL for DuckDB, written stage by stage and apart from the jobs."""

from stipend import fixed_values as fixed

_RECORDS = """
SELECT CAST(o_custkey AS VARCHAR) AS pernr, o_orderpriority AS lgart,
  CAST(o_orderdate AS DATE) AS begda, CAST(o_orderkey % 31 AS VARCHAR) AS anzhl, 'H' AS ptzeinh,
  printf('%.2f', o_totalprice) AS betrg, 'MXN' AS waers, CAST(o_orderdate AS DATE) AS estdt,
  CAST(o_orderkey AS VARCHAR) AS zuord,
  CAST(date_trunc('{unit}', CAST(o_orderdate AS DATE)) AS DATE) AS datum,
  lpad(CAST(o_orderkey % {hours} AS VARCHAR), 2, '0') || ':00:00' AS zutimer,
  CASE WHEN o_orderstatus = 'O' THEN 'N' ELSE o_orderstatus END AS zstat,
  '' AS zfproc, '' AS zutime, '' AS zuproc, '' AS zdescst, '15' AS zinfotipo
FROM orders
"""

# Derived inputs and payout stages: name -> (inputs it reads, SQL).
_TABLES = {
    "pay_records": ([], _RECORDS.format(unit="year", hours=24)),
    "wage_records": (["pay_records"], """
SELECT * REPLACE (['115K', '118A', '110F', '118B', '116W'][CAST(substr(lgart, 1, 1) AS INTEGER)] AS lgart)
FROM pay_records
"""),
    "pay_records_fine": ([], _RECORDS.format(unit="month", hours=12)),
    "items": ([], """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem
"""),
    "numbered_items": (["items"], """
SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS row_no FROM items
"""),
    "pairs": ([], """
SELECT s_suppkey AS store_a, (s_suppkey + 1) % (SELECT count(*) FROM supplier) AS store_b,
  make_date(1999, m, 1) AS begda, last_day(make_date(1999, m, 1)) AS endda,
  'W' || CAST(s_suppkey % 3 AS VARCHAR) AS wage_type, s_nationkey % 3 + 1 AS case_id,
  CASE WHEN s_suppkey % 10 = 9 THEN 0 ELSE 1 END AS ids
FROM supplier, (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS m)
"""),
    "store_sales": ([], """
SELECT l_suppkey AS store, max(CAST(l_shipdate AS DATE)) AS sale_date,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DECIMAL(14,2)) AS amount, 1 AS status
FROM lineitem GROUP BY l_suppkey, date_trunc('month', l_shipdate)
"""),
    "store_focus": ([], """
SELECT s_suppkey AS store, begda,
  CASE WHEN s_suppkey % 11 <> 3
    THEN substr('EICDX', CAST((s_suppkey + month(begda)) % 5 + 1 AS INTEGER), 1) END AS focus
FROM supplier,
  (SELECT CAST(DATE '1998-12-01' + to_months(CAST(unnest(range(0, 12)) AS INTEGER)) AS DATE) AS begda)
"""),
    "tariff": ([], """
SELECT c AS case_id, f AS focus, b AS band,
  CAST(100 * b + 10 * f + c AS DECIMAL(14,2)) AS pay_leader,
  CAST(80 * b + 5 * f + c AS DECIMAL(14,2)) AS pay_manager,
  CAST(20 * b + 2 * f + c AS DECIMAL(14,2)) AS pay_leader_focus
FROM (SELECT unnest(range(1, 4)) AS c), (SELECT unnest(range(0, 5)) AS f),
  (SELECT unnest(range(1, 8)) AS b)
WHERE NOT (c = 3 AND f = 0)
"""),
    "fixed_inflation": ([], """
SELECT CAST(0.0450 AS DECIMAL(14,4)) AS rate, DATE '1995-01-01' AS begda, DATE '2005-12-31' AS endda
"""),
    "inflation": ([], """
SELECT CAST(CAST(count(*) % 900 AS DECIMAL(14,4)) / 10000 AS DECIMAL(14,4)) AS rate,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS begda,
  last_day(CAST(date_trunc('month', l_shipdate) AS DATE)) AS endda
FROM lineitem GROUP BY date_trunc('month', l_shipdate)
"""),
    "history": ([], """
WITH base AS (
  SELECT c_custkey AS payee, c_custkey % (SELECT count(*) FROM supplier) AS store,
    CASE c_mktsegment WHEN 'MACHINERY' THEN 'L1' WHEN 'BUILDING' THEN 'L2'
      WHEN 'AUTOMOBILE' THEN 'E1' WHEN 'FURNITURE' THEN 'E2' ELSE 'X' END AS role,
    CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 1 END AS status,
    DATE '1998-06-01' + CAST(c_custkey * 37 % 500 AS INTEGER) AS date_start,
    DATE '1998-06-01' + CAST(c_custkey * 37 % 500 AS INTEGER)
      + CAST(c_custkey * 13 % 300 AS INTEGER) AS date_end,
    CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS area
  FROM customer)
SELECT * FROM base
UNION ALL
SELECT payee, store, role, status, date_start - 30, date_end + 30, area FROM base WHERE payee % 5 = 0
UNION ALL
SELECT * FROM base WHERE payee % 6 = 0
"""),
    "absences": ([], """
SELECT o_custkey AS payee, CAST(o_orderdate AS DATE) AS start_date, 1 + o_orderkey % 3 AS days,
  o_orderpriority AS type
FROM orders
"""),
    "absence_types": ([], """
SELECT DISTINCT o_orderpriority AS type,
  CASE WHEN o_orderpriority LIKE '5%' THEN 0 ELSE 1 END AS status
FROM orders
"""),
    "stores": (["pairs"], "SELECT store_b AS store FROM pairs UNION SELECT store_a FROM pairs"),
    "pair_sales": (["pairs", "store_sales"], """
SELECT p.*, s.amount AS sales, v.amount AS prior_sales,
  coalesce(CAST(s.amount AS DOUBLE) / nullif(CAST(v.amount AS DOUBLE), 0), 0) - 1 AS growth
FROM pairs p
LEFT JOIN store_sales s ON s.store = p.store_b AND s.status = 1
  AND date_trunc('month', s.sale_date) = date_trunc('month', p.begda)
LEFT JOIN store_sales v ON v.store = p.store_b AND v.status = 1
  AND date_trunc('month', v.sale_date) = date_trunc('month', p.begda - INTERVAL 1 YEAR)
"""),
    "pair_codes": (["pair_sales", "store_focus"], """
SELECT p.*,
  CASE a.focus WHEN 'E' THEN 1 WHEN 'I' THEN 2 WHEN 'C' THEN 3 WHEN 'D' THEN 4 ELSE 0 END AS focus_a,
  CASE b.focus WHEN 'E' THEN 1 WHEN 'I' THEN 2 WHEN 'C' THEN 3 WHEN 'D' THEN 4 ELSE 0 END AS focus_b
FROM pair_sales p
LEFT JOIN store_focus b ON b.store = p.store_b
  AND date_trunc('month', b.begda) = date_trunc('month', p.begda - INTERVAL 1 MONTH)
LEFT JOIN store_focus a ON a.store = p.store_a
  AND date_trunc('month', a.begda) = date_trunc('month', p.begda - INTERVAL 1 MONTH)
"""),
    "bands": (["fixed_inflation"], """
SELECT CAST(CASE WHEN k = 1 THEN 0 ELSE rate + CAST(0.01 AS DECIMAL(14,4)) * (k - 2) END
    AS DECIMAL(14,4)) AS low,
  CAST(CASE WHEN k = 1 THEN rate - CAST(0.0001 AS DECIMAL(14,4)) WHEN k = 7 THEN 2000
    ELSE rate + CAST(0.01 AS DECIMAL(14,4)) * (k - 2) + CAST(0.0099 AS DECIMAL(14,4)) END
    AS DECIMAL(14,4)) AS high,
  CAST(k AS INTEGER) AS band
FROM fixed_inflation, (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS k)
"""),
    "tariff_stage": (["pair_codes", "bands", "tariff"], """
WITH banded AS (
  SELECT p.*, CASE WHEN growth > 0 THEN
    (SELECT d.band FROM bands d WHERE growth BETWEEN CAST(d.low AS DOUBLE) AND CAST(d.high AS DOUBLE))
    ELSE 1 END AS band
  FROM pair_codes p WHERE ids = 1)
SELECT x.store_a, x.store_b, x.begda, x.endda, x.wage_type, coalesce(x.sales, 0) AS sales,
  coalesce(x.prior_sales, 0) AS prior_sales, x.growth, x.case_id, x.band, x.focus_a, x.focus_b,
  coalesce(b.pay_manager, 0) AS pay_manager_b, coalesce(b.pay_leader, 0) AS pay_leader_sales_b,
  coalesce(b.pay_leader_focus, 0) AS pay_leader_focus_b, coalesce(a.pay_manager, 0) AS pay_manager_a
FROM banded x
LEFT JOIN tariff b ON b.case_id = x.case_id AND b.focus = x.focus_b AND b.band = x.band
LEFT JOIN tariff a ON a.case_id = x.case_id AND a.focus = x.focus_a AND a.band = x.band
"""),
}


def _role_stages(tag: str, prefix: str, side: str, area: str, rates: list[str]) -> dict:
    """Employees of one role tag: joined and made distinct, with absences, rolled up."""
    def paid(share):
        return " + ".join(f"({share}) * CAST({r} AS DOUBLE)" for r in rates)

    low = tag.lower()
    return {
        f"{low}_staff": (["tariff_stage", "history"], f"""
SELECT DISTINCT t.*, h.payee, h.date_start AS raw_start, h.date_end AS raw_end, h.area AS raw_area
FROM tariff_stage t JOIN history h ON h.store = t.store_{side} AND h.role LIKE '{prefix}%'
  AND h.status = 1 AND h.date_start <= t.endda AND h.date_end >= t.begda
"""),
        f"{low}_paid": ([f"{low}_staff"], f"""
WITH clipped AS (
  SELECT * EXCLUDE (raw_start, raw_end, raw_area), '{tag}' AS role,
    datediff('day', greatest(begda, raw_start), least(endda, raw_end)) + 1 AS days,
    CAST(day(last_day(begda)) AS DECIMAL(16,2)) AS month_days,
    greatest(begda, raw_start) AS date_start, least(endda, raw_end) AS date_end,
    coalesce(raw_area, '{area}') AS area
  FROM {low}_staff),
shared AS (SELECT *, CAST(days AS DOUBLE) / CAST(month_days AS DOUBLE) AS share FROM clipped)
SELECT *, {paid("share")} AS pay FROM shared
"""),
        f"{low}_absent": ([f"{low}_paid", "absences"], f"""
SELECT p.*, CAST(coalesce(a.days, 0) AS DOUBLE) AS absence_days,
  {paid("CAST(coalesce(a.days, 0) AS DOUBLE) / CAST(month_days AS DOUBLE)")} AS absence_pay
FROM {low}_paid p LEFT JOIN absences a
  ON a.payee = p.payee AND a.start_date BETWEEN p.date_start AND p.date_end
"""),
        f"{low}_total": ([f"{low}_absent"], f"""
SELECT * EXCLUDE (absence_days, absence_pay), sum(absence_days) AS absence_days,
  sum(absence_pay) AS absence_pay
FROM {low}_absent GROUP BY ALL
"""),
    }


for _stages in (
    _role_stages("L", "L", "a", "NP", ["pay_leader_sales_b", "pay_leader_focus_b"]),
    _role_stages("EA", "E", "a", "NP", ["pay_manager_a"]),
    _role_stages("EB", "E", "b", "3781", ["pay_manager_b"]),
):
    _TABLES.update(_stages)
_TABLES["detail"] = (["l_total", "ea_total", "eb_total"], """
SELECT *, pay - absence_pay AS final_pay FROM (
  SELECT * FROM l_total UNION ALL SELECT * FROM ea_total UNION ALL SELECT * FROM eb_total)
""")


def _with(sql: str, *needs: str) -> str:
    """`sql` with the derived tables it needs, and those they need, in front."""
    ordered: dict[str, str] = {}

    def add(name):
        reads, body = _TABLES[name]
        for other in reads:
            add(other)
        ordered.setdefault(name, body.strip())

    for need in needs:
        add(need)
    tables = ",\n".join(f"{name} AS (\n{body}\n)" for name, body in ordered.items())
    return f"WITH {tables}\n{sql.strip()}" if ordered else sql.strip()


def _iso(*columns: str) -> str:
    return ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c.split('.')[-1]}" for c in columns)


_RECORD = (
    'pernr AS "PERNR", lgart AS "LGART", strftime(begda, \'%Y-%m-%d\') AS "BEGDA", '
    'anzhl AS "ANZHL", ptzeinh AS "PTZEINH", betrg AS "BETRG", waers AS "WAERS", '
    'strftime(estdt, \'%Y-%m-%d\') AS "ESTDT", zuord AS "ZUORD", '
    'strftime(datum, \'%Y-%m-%d\') AS "DATUM", zutimer AS "ZUTIMER", zstat AS "ZSTAT", '
    'zfproc AS "ZFPROC", zutime AS "ZUTIME", zuproc AS "ZUPROC", zdescst AS "ZDESCST", '
    'zinfotipo AS "ZINFOTIPO"'
)


def _latest(table: str, category: str | None, strict: bool) -> str:
    scope = f"lgart = '{category}'" if category else "TRUE"
    newest_date = f"(SELECT max(datum) FROM {table} WHERE zstat = 'N' AND {scope})"
    run_status = "zstat = 'N'" if strict else "TRUE"
    return _with(f"""
SELECT {_RECORD} FROM {table}
WHERE zstat = 'N' AND {scope} AND datum = {newest_date}
  AND zutimer = (SELECT max(zutimer) FROM {table}
    WHERE datum = {newest_date} AND {scope} AND {run_status})
""", table)


def _latest_by(table: str, strict: bool) -> str:
    run_status = "r.zstat = 'N'" if strict else "TRUE"
    return _with(f"""
SELECT {_RECORD} FROM {table} o
WHERE zstat = 'N'
  AND datum = (SELECT max(d.datum) FROM {table} d WHERE d.zstat = 'N' AND d.lgart = o.lgart)
  AND zutimer = (SELECT max(r.zutimer) FROM {table} r WHERE r.lgart = o.lgart
    AND r.datum = o.datum AND {run_status})
""", table)


_ITEM = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
_STAGE = (
    "store_a, store_b, " + _iso("begda", "endda") + ", wage_type, CAST(sales AS DOUBLE) AS sales, "
    "CAST(prior_sales AS DOUBLE) AS prior_sales, round(growth, 6) + 0.0 AS growth, "
    "case_id, band, focus_a, focus_b, CAST(pay_manager_b AS DOUBLE) AS pay_manager_b, "
    "CAST(pay_leader_sales_b AS DOUBLE) AS pay_leader_sales_b, "
    "CAST(pay_leader_focus_b AS DOUBLE) AS pay_leader_focus_b, "
    "CAST(pay_manager_a AS DOUBLE) AS pay_manager_a"
)
_STAFF = (
    "payee, role, CAST(days AS BIGINT) AS days, CAST(month_days AS DOUBLE) AS month_days, "
    + _iso("date_start", "date_end") + ", round(share, 6) + 0.0 AS share, "
    "round(pay, 4) + 0.0 AS pay, area"
)
_ABSENT = "absence_days, round(absence_pay, 4) + 0.0 AS absence_pay"
_WORKED = """
SELECT p.store_a, p.store_b, p.begda, p.endda, h.payee, h.role, h.date_start, h.date_end, h.area
FROM pairs p JOIN history h ON h.store = p.store_a AND h.status = 1
  AND h.date_start <= p.endda AND h.date_end >= p.begda
"""
_WORKED_TEXT = "store_a, store_b, payee, role, area, " + _iso("begda", "endda", "date_start", "date_end")
_CLIP = (
    "greatest(begda, date_start) AS clip_start, least(endda, date_end) AS clip_end"
)
_NUMBER_TEXT = (
    "CAST(o_orderkey // 1000 AS VARCHAR) || '.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')"
)

_RECORD_IN_FILE = (
    '"PERNR", "LGART", "BEGDA", printf(\'%.2f\', CAST("ANZHL" AS DOUBLE)) AS "ANZHL", "PTZEINH", '
    '"BETRG", "WAERS", "ESTDT", "ZUORD", "DATUM", "ZUTIMER", "ZSTAT", nullif("ZFPROC", \'\') AS "ZFPROC", '
    'nullif("ZUTIME", \'\') AS "ZUTIME", nullif("ZUPROC", \'\') AS "ZUPROC", '
    'nullif("ZDESCST", \'\') AS "ZDESCST", "ZINFOTIPO"'
)
_TWO_DECIMALS = 'printf(\'%.2f\', CAST("ANZHL" AS DOUBLE)) AS "ANZHL"'
_PROFILE_ROWS = """
SELECT {cells}, '{name}' AS profile,
  '{prefix}-' || CAST((row_no - 1) // {size} + 1 AS VARCHAR) || '.{ext}' AS file
FROM (SELECT *, row_number() OVER (ORDER BY "PERNR", "LGART", "BEGDA", "ANZHL", "PTZEINH", "BETRG",
  "WAERS", "ESTDT", "ZUORD") AS row_no FROM ({newest}))
"""
_NAMES = fixed.PLACE_NAMES + fixed.DIVISION_NAMES
_OLD_NAMES = "[" + ", ".join(f"'{old}'" for old, _ in _NAMES) + "]"


def _renamed() -> str:
    """The new name of each old one; no new name is an old one."""
    return "CASE name " + " ".join(f"WHEN '{old}' THEN '{new}'" for old, new in _NAMES) + " ELSE name END"


_RECODED = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'MACHINES' WHEN 'BUILDING' THEN 'HOUSES'
    WHEN 'FURNITURE' THEN 'Furniture and fittings' ELSE c_mktsegment END AS c_mktsegment
FROM customer
""".strip()

_PROFILE = """
SELECT '{name}' AS profile, (row_no - 1) // {size} + 1 AS batch_no, count(*) AS rows,
  arg_min("PERNR", row_no) AS "first_PERNR", arg_max("PERNR", row_no) AS "last_PERNR",
  any_value('{prefix}-' || CAST((row_no - 1) // {size} + 1 AS VARCHAR) || '.{ext}') AS file
FROM (SELECT *, row_number() OVER (ORDER BY "PERNR") AS row_no FROM ({newest})) GROUP BY 2
"""

_ITEM_COLUMNS = [*_ITEM.split(", "), "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_ITEM_TEXT_DATE = f"{', '.join(_ITEM_COLUMNS[:-1])}, {_iso('l_shipdate')}"

QUERIES = {
    "project_17": _with(f"SELECT {_RECORD} FROM pay_records", "pay_records"),
    "filter_status": _with(f"SELECT {_RECORD} FROM pay_records WHERE zstat = 'N'", "pay_records"),
    "paged_read": _with(
        f"SELECT {_ITEM_TEXT_DATE}, row_no, (row_no - 1) // 10000 + 1 AS page_no FROM numbered_items",
        "numbered_items"),
    "page_at_offset": _with(
        f"SELECT {_ITEM_TEXT_DATE}, row_no FROM numbered_items ORDER BY row_no LIMIT 2500 OFFSET 3000",
        "numbered_items"),
    "latest_batch_strict": _latest("pay_records", "5-LOW", True),
    "latest_batch_loose": _latest("pay_records_fine", "1-URGENT", False),
    "latest_batch_all": _latest("pay_records", None, True),
    "latest_batch_by_category": _latest_by("pay_records", True),
    "latest_batch_by_category_loose": _latest_by("pay_records_fine", False),
    "batch_count": _with("SELECT count(*) AS row_count FROM items", "items"),
    "batch_manifest": _with("""
SELECT (row_no - 1) // 8000 + 1 AS batch_no, count(*) AS rows,
  arg_min(l_orderkey, row_no) AS first_l_orderkey, arg_min(l_linenumber, row_no) AS first_l_linenumber,
  arg_max(l_orderkey, row_no) AS last_l_orderkey, arg_max(l_linenumber, row_no) AS last_l_linenumber
FROM numbered_items GROUP BY 1
""", "numbered_items"),
    "export_batches": _with(
        f"SELECT {_ITEM_TEXT_DATE}, row_no, (row_no - 1) // 8000 + 1 AS batch_no FROM numbered_items",
        "numbered_items"),
    "sales_same_month": _with(f"""
SELECT p.store_a, p.store_b, {_iso("p.begda")}, p.ids, CAST(s.amount AS DOUBLE) AS sales
FROM pairs p LEFT JOIN store_sales s ON s.store = p.store_b
  AND date_trunc('month', s.sale_date) = date_trunc('month', p.begda)
""", "pairs", "store_sales"),
    "sales_prior_year": _with(f"""
SELECT p.store_a, p.store_b, {_iso("p.begda")}, p.ids, CAST(s.amount AS DOUBLE) AS prior_sales
FROM pairs p LEFT JOIN store_sales s ON s.store = p.store_b
  AND date_trunc('month', s.sale_date) = date_trunc('month', p.begda - INTERVAL 1 YEAR)
""", "pairs", "store_sales"),
    "sales_growth": _with(f"""
SELECT store_a, store_b, {_iso("begda")}, CAST(sales AS DOUBLE) AS sales,
  CAST(prior_sales AS DOUBLE) AS prior_sales, round(growth, 6) + 0.0 AS growth
FROM pair_sales
""", "pair_sales"),
    "focus_prior_month": _with(f"""
SELECT p.store_a, p.store_b, {_iso("p.begda")}, f.focus
FROM pairs p LEFT JOIN store_focus f ON f.store = p.store_b
  AND date_trunc('month', f.begda) = date_trunc('month', p.begda - INTERVAL 1 MONTH)
""", "pairs", "store_focus"),
    "focus_code": _with(
        f"SELECT store_a, store_b, {_iso('begda')}, focus_a, focus_b FROM pair_codes",
        "pair_codes"),
    "month_shift": """
SELECT o_orderkey, strftime(CAST(d - INTERVAL 1 MONTH AS DATE), '%Y-%m-%d') AS month_back,
  strftime(CAST(d - INTERVAL 1 YEAR AS DATE), '%Y-%m-%d') AS year_back,
  strftime(CAST(date_trunc('month', d) AS DATE), '%Y-%m-%d') AS month_start,
  CAST(day(last_day(d)) AS BIGINT) AS month_days
FROM (SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS d FROM orders)
""".strip(),
    "band_table": _with(f"""
SELECT {_iso("begda")}, CAST(rate AS DOUBLE) AS rate, CAST(band AS INTEGER) AS band,
  CAST(CASE WHEN band = 1 THEN 0 ELSE rate + CAST(0.01 AS DECIMAL(14,4)) * (band - 2) END AS DOUBLE)
    AS low,
  CAST(CASE WHEN band = 1 THEN rate - CAST(0.0001 AS DECIMAL(14,4)) WHEN band = 7 THEN 2000
    ELSE rate + CAST(0.01 AS DECIMAL(14,4)) * (band - 2) + CAST(0.0099 AS DECIMAL(14,4)) END
    AS DOUBLE) AS high
FROM inflation, (SELECT CAST(unnest(range(1, 8)) AS INTEGER) AS band)
""", "inflation"),
    "band_lookup": _with(f"""
SELECT store_a, store_b, {_iso("begda")}, round(growth, 6) + 0.0 AS growth,
  CASE WHEN growth > 0 THEN (SELECT d.band FROM bands d
    WHERE growth BETWEEN CAST(d.low AS DOUBLE) AND CAST(d.high AS DOUBLE)) ELSE 1 END AS band
FROM pair_sales
""", "pair_sales", "bands"),
    "value_as_of": _with("""
SELECT strftime(as_of, '%Y-%m-%d') AS as_of,
  (SELECT CAST(rate AS DOUBLE) FROM inflation WHERE as_of BETWEEN begda AND endda) AS rate
FROM (SELECT CAST(max(CAST(o_orderdate AS DATE)) - INTERVAL 1 MONTH AS DATE) AS as_of FROM orders)
""", "inflation"),
    "tariff_lookup": _with(f"SELECT {_STAGE} FROM tariff_stage", "tariff_stage"),
    "null_defaults": _with("""
SELECT payee, store, role, status, date_start_text, coalesce(area, 'NP') AS area_store_a,
  coalesce(area, '3781') AS area_store_b
FROM (SELECT *, strftime(date_start, '%Y-%m-%d') AS date_start_text FROM history)
""", "history"),
    "store_union": _with("SELECT store FROM stores ORDER BY store", "stores"),
    "history_semi_join": _with(f"""
SELECT payee, store, role, status, {_iso("date_start", "date_end")}, area FROM history
WHERE store IN (SELECT store FROM stores)
""", "history", "stores"),
    "role_prefix_filter": _with(f"""
SELECT payee, store, role, status, {_iso("date_start", "date_end")}, area FROM history
WHERE role LIKE 'L%' OR role LIKE 'E%'
""", "history"),
    "history_dedup": _with(f"""
SELECT DISTINCT {_WORKED_TEXT.replace("role, ", "")} FROM ({_WORKED} AND h.role LIKE 'L%')
""", "pairs", "history"),
    "interval_overlap_join": _with(f"SELECT {_WORKED_TEXT} FROM ({_WORKED})", "pairs", "history"),
    "proration": _with(f"""
SELECT {_WORKED_TEXT}, strftime(clip_start, '%Y-%m-%d') AS clip_start,
  strftime(clip_end, '%Y-%m-%d') AS clip_end,
  CAST(datediff('day', clip_start, clip_end) + 1 AS BIGINT) AS days,
  CAST(day(last_day(begda)) AS BIGINT) AS month_days,
  round(CAST(datediff('day', clip_start, clip_end) + 1 AS DOUBLE)
    / CAST(day(last_day(begda)) AS DOUBLE), 6) AS share
FROM (SELECT *, {_CLIP} FROM ({_WORKED}))
""", "pairs", "history"),
    "absence_join": _with(f"""
SELECT {_WORKED_TEXT}, CAST(a.days AS BIGINT) AS days, a.type,
  strftime(a.start_date, '%Y-%m-%d') AS start_date
FROM (SELECT *, {_CLIP} FROM ({_WORKED})) w LEFT JOIN absences a
  ON a.payee = w.payee AND a.start_date BETWEEN w.clip_start AND w.clip_end
""".replace("store_b, payee,", "store_b, w.payee,"), "pairs", "history", "absences"),
    "absence_rollup": _with(f"SELECT {_STAGE}, {_STAFF}, {_ABSENT} FROM l_total", "l_total"),
    "active_absences": _with(f"""
SELECT payee, {_iso("start_date")}, CAST(days AS BIGINT) AS days, type FROM absences
WHERE type IN (SELECT type FROM absence_types WHERE status = 1)
""", "absences", "absence_types"),
    "payout_detail": _with(
        f"SELECT {_STAGE}, {_STAFF}, {_ABSENT}, round(final_pay, 4) + 0.0 AS final_pay FROM detail",
        "detail"),
    "payout_summary": _with("SELECT count(*) AS records FROM detail", "detail"),
    "duplicate_keys": _with("""
SELECT store, date_start_text AS date_start, payee, count(*) AS rows
FROM (SELECT *, strftime(date_start, '%Y-%m-%d') AS date_start_text FROM history)
GROUP BY ALL HAVING count(*) > 1
""", "history"),
    "money_format": f"""
SELECT o_orderkey, number_text,
  printf('%.2f', round_even(CAST(number_text AS DOUBLE) * 100, 0) / 100) AS money_text
FROM (SELECT o_orderkey, {_NUMBER_TEXT} AS number_text FROM orders)
""".strip(),
    "int_truncate": f"""
SELECT o_orderkey, CAST(trunc(CAST(number_text AS DOUBLE)) AS BIGINT) AS whole,
  CAST(trunc(CAST('-' || number_text AS DOUBLE)) AS BIGINT) AS negative_whole
FROM (SELECT o_orderkey, {_NUMBER_TEXT} AS number_text FROM orders)
""".strip(),
    "cast_date": """
SELECT o_orderkey, strftime(TRY_CAST(date_text AS DATE), '%Y-%m-%d') AS as_date,
  CAST(CAST(o_totalprice AS DECIMAL(14,4)) AS DOUBLE) AS as_decimal,
  CAST(o_custkey AS VARCHAR) AS as_text
FROM (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END
  AS date_text FROM orders)
""".strip(),
    "date_text": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders
""".strip(),
    "exported_files": _with(f"""
SELECT {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in _ITEM_COLUMNS)},
  'items-' || CAST((row_no - 1) // 8000 + 1 AS VARCHAR) || '.txt' AS file
FROM numbered_items
""", "numbered_items"),
    "published_files": _with(f"""
SELECT {_RECORD_IN_FILE}, 'ReplicaICMEP-' || CAST((row_no - 1) // 8000 + 1 AS VARCHAR) || '.csv' AS file
FROM (SELECT *, row_number() OVER (ORDER BY "PERNR", "LGART", "BEGDA", "ANZHL", "PTZEINH", "BETRG",
  "WAERS", "ESTDT", "ZUORD") AS row_no FROM ({_latest("pay_records", None, True)}))
"""),
    "recoded_file": _RECODED,
    "value_recode": _RECODED,
    "value_recode_parts": """
SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name,
  CASE p_brand WHEN 'Brand#1' THEN 'Brand#One' ELSE p_brand END AS p_brand,
  CASE p_type WHEN 'ECONOMY' THEN 'BASIC' WHEN 'PROMO' THEN 'BASIC' ELSE p_type END AS p_type,
  CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
FROM part
""".strip(),
    "newest_snapshot": """
SELECT event_id, event_type, user_id, value, props, strftime(ts, '%Y-%m-%d %H') AS run FROM events e
WHERE strftime(ts, '%Y-%m-%d %H') = (SELECT max(strftime(n.ts, '%Y-%m-%d %H')) FROM events n
  WHERE n.event_type = e.event_type)
""".strip(),
    "published_profiles": "UNION ALL".join(
        _PROFILE.format(name=name, size=size, prefix=prefix, ext=ext,
                        newest=_latest("wage_records", category, strict))
        for name, category, strict, size, _, _, prefix, ext in fixed.PROFILES),
    "published_profile_rows": "UNION ALL".join(
        _PROFILE_ROWS.format(
            name=name, size=size, prefix=prefix, ext=ext, newest=_latest("wage_records", category, strict),
            cells=_RECORD_IN_FILE if formatted else _RECORD_IN_FILE.replace(_TWO_DECIMALS, '"ANZHL"'))
        for name, category, strict, size, _, formatted, prefix, ext in fixed.PROFILES),
    "recoded_names": f"""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, {_renamed()} AS name,
  'said "' || c_mktsegment || '",' || chr(10) || CAST(c_custkey AS VARCHAR) || chr(10) AS note
FROM (SELECT *, ({_OLD_NAMES})[c_custkey % {len(_NAMES) + 1} + 1] AS name FROM customer)
""".strip(),
    "typed_csv_breaks": """
SELECT o_orderkey, o_orderpriority || chr(10) || '5,' || o_orderstatus || '"' || chr(10) AS note, o_totalprice
FROM orders
""".strip(),
    "long_intervals": f"""
SELECT "group", o_orderkey, {_iso("ordered", "closed")}, count(*) AS items,
  CAST(sum(l_orderkey) AS BIGINT) AS order_sum, strftime(min(sent), '%Y-%m-%d') AS first_sent
FROM (SELECT o_custkey % 100 AS "group", o_orderkey, CAST(o_orderdate AS DATE) AS ordered,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS closed FROM orders) o
JOIN (SELECT l_suppkey % 100 AS g, l_orderkey, CAST(l_shipdate AS DATE) AS sent,
    CAST(l_shipdate AS DATE) + l_linenumber AS arrived FROM lineitem) i
  ON g = "group" AND ordered <= arrived AND closed >= sent
GROUP BY 1, 2, ordered, closed
""".strip(),
    "hot_key_join": f"""
SELECT n_nationkey, n_name, {_iso("first_day", "last_day")}, count(l_orderkey) AS items,
  CAST(sum(l_orderkey) AS BIGINT) AS order_sum, round(sum(l_quantity), 2) AS quantity
FROM (SELECT *, CASE WHEN n_nationkey % 2 = 0 THEN 0 ELSE n_nationkey END AS k,
    DATE '1994-01-01' + 100 * n_nationkey AS first_day,
    DATE '1994-01-01' + 100 * n_nationkey + n_regionkey * 30 AS last_day FROM nation) n
LEFT JOIN lineitem ON k = CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_suppkey END
  AND CAST(l_shipdate AS DATE) BETWEEN first_day AND last_day
GROUP BY 1, 2, first_day, last_day
""".strip(),
    "kept_pages": "UNION ALL".join(f"""
SELECT {_ITEM}, l_discount, l_tax, l_returnflag, l_linestatus, {_iso("l_shipdate")}, row_no
FROM (SELECT *, row_number() OVER (
  ORDER BY {_ITEM}, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS row_no FROM lineitem)
WHERE {page}
""" for page in ("row_no BETWEEN 3001 AND 5500", "row_no > (SELECT count(*) FROM lineitem) - 700")),
    "typed_csv": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_iso("o_orderdate")}, o_orderpriority
FROM orders
""".strip(),
    "refreshed_tables": "SELECT * FROM customer",
    "published_snapshot": f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {_iso("o_orderdate")}, o_orderpriority
FROM orders
""".strip(),
}
