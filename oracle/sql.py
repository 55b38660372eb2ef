"""Independent SQL for every registered query, written for DuckDB.

The statements use the plain shape of the calculation - every row against every
forecast day with a CASE - and none of the shortcuts of the Spark plans.
"""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

AS_OF = "1998-06-01 12:00:00"
MIDNIGHT = "1998-06-01 00:00:00"
EARLIER = "1998-05-25 12:00:00"
LATE = "1998-11-01 12:00:00"

MODEL = """
business_unit_reference AS (
  SELECT 'BU_' || n_nationkey AS business_unit_id, n_name AS business_unit_name,
         CASE n_nationkey % 4 WHEN 0 THEN 'Treasury' WHEN 1 THEN 'Trading'
              WHEN 2 THEN 'Investment Banking' ELSE 'Wealth Management' END AS business_unit_type,
         r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey),
counterparty_data AS (
  SELECT CAST(c_custkey AS VARCHAR) AS counterparty_id, c_name AS counterparty_name,
         c_mktsegment AS counterparty_type,
         CASE c_custkey % 5 WHEN 0 THEN 'AAA' WHEN 1 THEN 'AA' WHEN 2 THEN 'A'
              WHEN 3 THEN 'BBB' ELSE 'BB' END AS credit_rating,
         r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey),
asset_classifications AS (
  SELECT security_type, hqla_level, CAST(h AS DECIMAL(5,2)) AS haircut_percent
  FROM (VALUES ('ECONOMY', 'Level 1', '0'), ('STANDARD', 'Level 1', '0'),
               ('MEDIUM', 'Level 2A', '15'), ('LARGE', 'Level 2B', '25'),
               ('SMALL', 'Level 2B', '50')) v(security_type, hqla_level, h)),
positions AS (
  SELECT l_orderkey || '-' || l_linenumber AS position_id,
         'BU_' || s_nationkey AS business_unit_id,
         CAST(l_partkey AS VARCHAR) AS security_id, p_type AS security_type,
         CASE WHEN l_returnflag = 'R' THEN 'Short' ELSE 'Long' END AS position_type,
         CAST(l_quantity AS DECIMAL(20,4)) AS quantity,
         CAST(l_extendedprice AS DECIMAL(20,2)) AS position_value_usd,
         CAST(l_shipdate AS DATE) AS position_date,
         CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS maturity_date
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
cash_inflows AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS inflow_id, 'BU_' || c_nationkey AS business_unit_id,
         CAST(o_custkey AS VARCHAR) AS counterparty_id, o_orderpriority AS inflow_type,
         CAST(CAST(o_totalprice AS DECIMAL(20,2)) * 0.195 AS DECIMAL(20,2)) AS inflow_amount_usd,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS maturity_date,
         CAST(o_orderdate AS DATE) AS position_date
  FROM orders JOIN customer ON o_custkey = c_custkey),
cash_outflows AS (
  SELECT l_orderkey || '-' || l_linenumber AS outflow_id,
         'BU_' || c_nationkey AS business_unit_id,
         CAST(o_custkey AS VARCHAR) AS counterparty_id, l_returnflag AS outflow_type,
         CAST(CAST(l_extendedprice AS DECIMAL(20,2)) * 0.195 AS DECIMAL(20,2)) AS outflow_amount_usd,
         CASE WHEN l_linestatus = 'O' AND l_linenumber = 2 THEN NULL
              ELSE CAST(l_shipdate AS DATE) END AS maturity_date,
         CAST(l_shipdate AS DATE) AS position_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
rules AS (
  SELECT * FROM (VALUES
    ('1', 'DOWNTURN', 'POSITIONS', 'ASSET_CLASSIFICATIONS', 'SECURITY_TYPE', 'LARGE', -0.22::DOUBLE),
    ('1', 'DOWNTURN', 'POSITIONS', 'ASSET_CLASSIFICATIONS', 'SECURITY_TYPE', 'LARGE', -0.22),
    ('1', 'DOWNTURN', 'CASH_OUTFLOWS', 'BUSINESS_UNIT_REFERENCE', 'REGION', 'AMERICA', 0.08),
    ('1', 'DOWNTURN', 'CASH_OUTFLOWS', 'BUSINESS_UNIT_REFERENCE', 'BUSINESS_UNIT_TYPE', 'Wealth Management', 0.03),
    ('1', 'DOWNTURN', 'COUNTERPARTY_DATA', 'COUNTERPARTY_DATA', 'COUNTERPARTY_TYPE', 'MACHINERY', -0.17),
    ('1', 'DOWNTURN', 'CASH_INFLOWS', 'BUSINESS_UNIT_REFERENCE', 'REGION', 'MIDDLE EAST', -0.26),
    ('1', 'DOWNTURN', 'CASH_INFLOWS', 'BUSINESS_UNIT_REFERENCE', 'REGION', 'NOWHERE', -0.5),
    ('2', 'REGIONAL', 'COUNTERPARTY_DATA', 'COUNTERPARTY_DATA', 'REGION', 'AFRICA', -0.31),
    ('2', 'REGIONAL', 'COUNTERPARTY_DATA', 'COUNTERPARTY_DATA', 'REGION', 'HOUSEHOLD', -0.07),
    ('2', 'REGIONAL', 'CASH_INFLOWS', 'BUSINESS_UNIT_REFERENCE', 'BUSINESS_UNIT_TYPE', 'Investment Banking', -0.12),
    ('2', 'REGIONAL', 'POSITIONS', 'BUSINESS_UNIT_REFERENCE', 'REGION', 'EUROPE', -0.06),
    ('2', 'REGIONAL', 'POSITIONS', 'BUSINESS_UNIT_REFERENCE', 'BUSINESS_UNIT_TYPE', 'Trading', -0.06)
  ) v(what_if_id, what_if_name, ref_tbl, tbl, col, val, factor)
  UNION ALL SELECT '3', 'MARKETWIDE', 'COUNTERPARTY_DATA', 'COUNTERPARTY_DATA', 'REGION', r_name,
                   (r_regionkey + 1) * -0.01::DOUBLE FROM region
  UNION ALL SELECT DISTINCT '3', 'MARKETWIDE', 'COUNTERPARTY_DATA', 'COUNTERPARTY_DATA',
                   'COUNTERPARTY_TYPE', c_mktsegment, -0.02::DOUBLE FROM customer
  UNION ALL SELECT DISTINCT '3', 'MARKETWIDE', 'POSITIONS', 'ASSET_CLASSIFICATIONS',
                   'SECURITY_TYPE', p_type, -0.03::DOUBLE FROM part)"""

UNIT = ("business_unit_reference", "business_unit_id", ("region", "business_unit_type"))
KINDS = {
    "inflow_unit": ("CASH_INFLOWS", *UNIT),
    "outflow_unit": ("CASH_OUTFLOWS", *UNIT),
    "position_unit": ("POSITIONS", *UNIT),
    "counterparty": ("COUNTERPARTY_DATA", "counterparty_data", "counterparty_id",
                     ("region", "counterparty_type")),
    "security_type": ("POSITIONS", "asset_classifications", "security_type", ("security_type",)),
}
FACTS = {
    "positions": ("position_value_usd", ("position_unit", "security_type")),
    "cash_inflows": ("inflow_amount_usd", ("counterparty", "inflow_unit")),
    "cash_outflows": ("outflow_amount_usd", ("counterparty", "outflow_unit")),
}


def factors(kind: str, ids: tuple[str, ...]) -> str:
    ref_tbl, table, key, columns = KINDS[kind]
    match = " OR ".join(f"a.{c} = b.val" for c in columns)
    wanted = ", ".join(f"'{i}'" for i in ids)
    return f"""
      SELECT b.what_if_id, a.{key},
             CAST(ROUND(product(CAST(CAST(b.factor + 1 AS DECIMAL(12,2)) AS DOUBLE)), 12)
                  AS DECIMAL(17,12)) AS factor
      FROM {table} a JOIN rules b ON {match}
      WHERE b.what_if_id IN ({wanted}) AND b.ref_tbl = '{ref_tbl}' AND b.tbl = '{table.upper()}'
      GROUP BY 1, 2"""


def stressed(fact: str, ids: tuple[str, ...]) -> str:
    amount, (one, two) = FACTS[fact]
    k1, k2 = KINDS[one][2], KINDS[two][2]
    return f"""
      SELECT s.what_if_id, f.* REPLACE (CAST(f.{amount}
               * CAST(COALESCE(a.factor, 1.0) * COALESCE(b.factor, 1.0) AS DECIMAL(17,12))
               AS DECIMAL(20,2)) AS {amount})
      FROM {fact} f
      CROSS JOIN (SELECT unnest([{", ".join(f"'{i}'" for i in ids)}]) AS what_if_id) s
      LEFT JOIN ({factors(one, ids)}) a ON a.what_if_id = s.what_if_id AND a.{k1} = f.{k1}
      LEFT JOIN ({factors(two, ids)}) b ON b.what_if_id = s.what_if_id AND b.{k2} = f.{k2}"""


def curve(decay: str, n: int) -> list[Decimal]:
    step = Decimal(1).scaleb(-16)
    return [(Decimal(decay) ** i).quantize(step, ROUND_HALF_UP) for i in range(n)]


def days(n: int, decay: str) -> str:
    rows = ", ".join(
        f"({i + 1}, CAST('{d}' AS DECIMAL(17,16)))" for i, d in enumerate(curve(decay, n))
    )
    return f"(SELECT * FROM (VALUES {rows}) v(day_number, decay))"


def detail(as_of: str, source: str = "positions", extra: str = "") -> str:
    return f"""
      SELECT {extra} p.maturity_date,
             CAST(p.position_value_usd * (1 - h.haircut_percent * 0.01) AS DECIMAL(20,6)) AS total_hqla_usd
      FROM {source} p JOIN asset_classifications h ON p.security_type = h.security_type
      WHERE p.position_type = 'Long'
        AND (p.maturity_date IS NULL OR p.maturity_date >= CAST(TIMESTAMP '{as_of}' AS DATE))"""


def instant(as_of: str) -> str:
    return f"TIMESTAMP '{as_of}' + (day_number - 1) * INTERVAL 1 DAY"


def hqla(as_of: str, n: int = 150, decay: str = "0.9999", source: str = "positions", by: str = "") -> str:
    extra = f"p.{by}," if by else ""
    lead = f"{by}," if by else ""
    return f"""
      SELECT {lead} day_number,
             SUM(CASE WHEN CAST(maturity_date AS TIMESTAMP) <= {instant(as_of)} THEN 0
                      ELSE CAST(total_hqla_usd * decay AS DECIMAL(38,2)) END) AS total_hqla_usd
      FROM ({detail(as_of, source, extra)}) d CROSS JOIN {days(n, decay)} s
      GROUP BY {lead} day_number"""


def flow(side: str, as_of: str, n: int = 150, source: str = "", by: str = "") -> str:
    lead = f"{by}," if by else ""
    return f"""
      SELECT {lead} day_number,
             SUM(CASE WHEN CAST(maturity_date AS TIMESTAMP) < {instant(as_of)} THEN 0
                      ELSE {side}_amount_usd END) AS total_{side}
      FROM (SELECT * FROM {source or f'cash_{side}s'}
            WHERE maturity_date IS NULL OR CAST(maturity_date AS TIMESTAMP) >= TIMESTAMP '{as_of}') f
      CROSS JOIN (SELECT unnest(range(1, {n + 1})) AS day_number) s
      GROUP BY {lead} day_number"""


def net(as_of: str, n: int = 150, sources: tuple[str, str] = ("", ""), by: str = "") -> str:
    keys = f"{by}, day_number" if by else "day_number"
    return f"""
      SELECT {keys}, COALESCE(total_inflow, 0) AS total_inflow,
             COALESCE(total_outflow, 0) AS total_outflow,
             COALESCE(total_inflow, 0) + COALESCE(total_outflow, 0) AS net_position,
             ABS(COALESCE(total_inflow, 0) + COALESCE(total_outflow, 0)) AS abs_net_position
      FROM ({flow('inflow', as_of, n, sources[0], by)}) i
      FULL JOIN ({flow('outflow', as_of, n, sources[1], by)}) o USING ({keys})"""


def ratio(as_of: str, n: int = 150, decay: str = "0.9999", sources: tuple[str, str, str] = ("positions", "", ""), by: str = "") -> str:
    keys = f"{by}, day_number" if by else "day_number"
    return f"""
      SELECT {keys}, abs_net_position AS total_net_cash_outflows, total_hqla_usd AS hqla,
             ROUND(CAST(total_hqla_usd AS DOUBLE) / CAST(abs_net_position AS DOUBLE), 8) AS lcr
      FROM ({net(as_of, n, sources[1:], by)}) a JOIN ({hqla(as_of, n, decay, sources[0], by)}) b USING ({keys})"""


def what_if(as_of: str, ids: tuple[str, ...], n: int = 150) -> str:
    sources = tuple(f"({stressed(f, ids)})" for f in ("positions", "cash_inflows", "cash_outflows"))
    return ratio(as_of, n, "0.99", sources, "what_if_id")


def query(select: str, *ctes: str) -> str:
    """WITH the model tables and further CTEs, then the select."""
    return "WITH " + ",\n".join([MODEL, *ctes]) + "\n" + select


def dbl(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in columns)


SERIES = f"CAST(day_number AS INTEGER) AS day_number, {dbl('total_net_cash_outflows', 'hqla', 'lcr')}"
BASE = f"base AS ({ratio(AS_OF)})"
# Two runs are in the history; the newest one is the run at AS_OF.
HISTORY = f"""history AS (
  SELECT TIMESTAMP '{EARLIER}' AS created_timestamp, * FROM ({ratio(EARLIER)})
  UNION ALL SELECT TIMESTAMP '{AS_OF}', * FROM ({ratio(AS_OF)})),
base AS (SELECT * FROM history
         WHERE created_timestamp IN (SELECT max(created_timestamp) FROM history))"""
SCENARIO_HISTORY = f"""scenario_history AS (
  SELECT TIMESTAMP '{EARLIER}' AS created_timestamp, * FROM ({what_if(EARLIER, ('1', '3'))})
  UNION ALL SELECT TIMESTAMP '{AS_OF}', * FROM ({what_if(AS_OF, ('1', '2'))})),
latest AS (SELECT h.* FROM scenario_history h
           JOIN (SELECT what_if_id, max(created_timestamp) AS m FROM scenario_history GROUP BY 1) n
             ON n.what_if_id = h.what_if_id AND n.m = h.created_timestamp)"""


NOW = f"latest AS ({what_if(AS_OF, ('1', '2', '3'))})"


def _wide_days(n: int, as_of: str) -> list[tuple[int, str]]:
    start = dt.datetime.fromisoformat(as_of)
    return [(i + 1, f"TIMESTAMP '{start + dt.timedelta(days=i)}'") for i in range(n)]


def _wide_hqla(n: int) -> str:
    factor = curve("0.9999", n)
    columns = ", ".join(
        f"CAST(CASE WHEN CAST(maturity_date AS TIMESTAMP) <= {at} THEN 0 ELSE"
        f" CAST(total_hqla_usd * CAST('{factor[day - 1]}' AS DECIMAL(17,16)) AS DECIMAL(38,2)) END"
        f" AS DOUBLE) AS day_{day}_total_hqla_usd"
        for day, at in _wide_days(n, AS_OF)
    )
    return query(
        f"SELECT CAST(maturity_date AS VARCHAR) AS maturity_date, {dbl('total_hqla_usd')}, {columns}"
        f" FROM ({detail(AS_OF)})"
    )


def _wide_flow(side: str, n: int) -> str:
    columns = ", ".join(
        f"CAST(CASE WHEN CAST(maturity_date AS TIMESTAMP) < {at} THEN 0 ELSE {side}_amount_usd END"
        f" AS DOUBLE) AS day_{day}_{side}_stock"
        for day, at in _wide_days(n, AS_OF)
    )
    return query(
        f"SELECT {side}_id, business_unit_id, counterparty_id, {side}_type, {dbl(f'{side}_amount_usd')},"
        f" CAST(maturity_date AS VARCHAR) AS maturity_date, CAST(position_date AS VARCHAR) AS position_date,"
        f" {columns} FROM cash_{side}s WHERE maturity_date IS NULL"
        f" OR CAST(maturity_date AS TIMESTAMP) >= TIMESTAMP '{AS_OF}'"
    )


def _stressed(fact: str) -> str:
    doubles = [FACTS[fact][0], *(["quantity"] if fact == "positions" else [])]
    shown = ", ".join(
        [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles]
        + [f"CAST({c} AS VARCHAR) AS {c}" for c in ("maturity_date", "position_date")]
    )
    return query(f"SELECT * REPLACE ({shown}) FROM ({stressed(fact, ('1', '2', '3'))})")


def _flows(side: str, key: str, name: str, join: str = "") -> str:
    return (
        f"SELECT '{side}' AS direction, {key} AS {name}, COUNT(*) AS n_flows,"
        f" CAST(SUM({side}_amount_usd) AS DOUBLE) AS amount_usd FROM cash_{side}s f {join} GROUP BY 2"
    )


def _both(key: str, name: str, join: str = "") -> str:
    return query(
        " UNION ALL ".join(
            _flows(side, key.format(side=side), name, join) for side in ("inflow", "outflow")
        )
    )


_BUCKET = f"""CASE WHEN maturity_date IS NULL THEN 'open'
  WHEN maturity_date - DATE '{AS_OF[:10]}' < 0 THEN 'matured'
  WHEN maturity_date - DATE '{AS_OF[:10]}' < 90 THEN '0-89'
  WHEN maturity_date - DATE '{AS_OF[:10]}' < 180 THEN '90-179'
  WHEN maturity_date - DATE '{AS_OF[:10]}' < 365 THEN '180-364' ELSE '365+' END"""

_HEADLINE = f"""SELECT CAST(day_number AS INTEGER) AS day_number, {dbl('lcr', 'hqla', 'total_net_cash_outflows')},
  CASE WHEN lcr >= 1 THEN 'Compliant' ELSE 'Non-Compliant' END AS status,
  ROUND(lcr - 1, 8) AS headroom FROM base WHERE day_number = 1"""

_CHANGES = """SELECT {keys} CAST(day_number AS INTEGER) AS day_number,
  CAST(hqla AS DOUBLE) AS hqla, CAST(total_net_cash_outflows AS DOUBLE) AS total_net_cash_outflows, lcr,
  CAST(hqla - LAG(hqla) OVER w AS DOUBLE) AS hqla_change,
  CAST(total_net_cash_outflows - LAG(total_net_cash_outflows) OVER w AS DOUBLE) AS outflows_change,
  ROUND(lcr - LAG(lcr) OVER w, 8) AS lcr_change
  FROM {table} WHERE day_number <= 150 WINDOW w AS ({partition} ORDER BY day_number)"""

_COMPARE = """SELECT s.what_if_id, CAST(s.day_number AS INTEGER) AS day_number, b.lcr AS baseline_lcr,
  s.lcr AS scenario_lcr, ROUND(s.lcr - b.lcr, 8) AS lcr_difference
  FROM latest s JOIN base b ON s.day_number = b.day_number"""

_ORPHANS = [
    ("inflow_counterparty", "cash_inflows", "counterparty_data", "counterparty_id"),
    ("outflow_business_unit", "cash_outflows", "business_unit_reference", "business_unit_id"),
    ("outflow_counterparty", "cash_outflows", "counterparty_data", "counterparty_id"),
    ("positions_to_asset_security_type", "positions", "asset_classifications", "security_type"),
    ("position_business_unit", "positions", "business_unit_reference", "business_unit_id"),
]


def _orphans() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS relationship, COUNT(*) FILTER (r.{key} IS NULL) AS orphan_count,"
        f" COUNT(*) AS row_count,"
        f" ROUND(100.0::DOUBLE * COUNT(*) FILTER (r.{key} IS NULL) / COUNT(*), 4) AS orphan_percent"
        f" FROM {left} l LEFT JOIN {right} r ON l.{key} = r.{key}"
        for name, left, right, key in _ORPHANS
    )


_NULLS = {
    "positions": ("position_id", "business_unit_id", "security_id", "security_type", "position_type",
                  "quantity", "position_value_usd", "position_date", "maturity_date"),
    "cash_inflows": ("inflow_id", "business_unit_id", "counterparty_id", "inflow_type",
                     "inflow_amount_usd", "maturity_date", "position_date"),
    "cash_outflows": ("outflow_id", "business_unit_id", "counterparty_id", "outflow_type",
                      "outflow_amount_usd", "maturity_date", "position_date"),
    "asset_classifications": ("security_type", "hqla_level", "haircut_percent"),
    "counterparty_data": ("counterparty_id", "counterparty_name", "counterparty_type", "credit_rating", "region"),
    "business_unit_reference": ("business_unit_id", "business_unit_name", "business_unit_type", "region"),
    "what_if_definitions_lookup": ("what_if_id", "what_if_name", "ref_tbl", "tbl", "col", "val", "factor"),
}


def _nulls() -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, COUNT(*) AS row_count,"
        f" COUNT(*) FILTER ({c} IS NULL) AS null_count FROM {'rules' if table.startswith('what_if') else table}"
        for table, columns in _NULLS.items()
        for c in columns
    )


def _by_row(rows: str, gone: str, value: str) -> str:
    """Totals by day, each from all the rows that are alive on it."""
    return f"""
      SELECT day_number, COALESCE(SUM({value}) FILTER (maturity_date IS NULL
             OR NOT CAST(maturity_date AS TIMESTAMP) {gone} {instant(AS_OF)}), 0) AS total
      FROM ({rows}) r CROSS JOIN {days(150, '0.9999')} s GROUP BY day_number"""


def _reconcile() -> str:
    parts = [("hqla", _by_row(detail(AS_OF), "<=", "CAST(total_hqla_usd * decay AS DECIMAL(38,2))"),
              f"SELECT day_number, total_hqla_usd AS total FROM ({hqla(AS_OF)})")]
    for side in ("inflow", "outflow"):
        live = (f"SELECT * FROM cash_{side}s WHERE maturity_date IS NULL"
                f" OR CAST(maturity_date AS TIMESTAMP) >= TIMESTAMP '{AS_OF}'")
        parts.append((side, _by_row(live, "<", f"{side}_amount_usd"),
                      f"SELECT day_number, total_{side} AS total FROM ({flow(side, AS_OF)})"))
    return query(" UNION ALL ".join(
        f"""SELECT '{name}' AS object, CAST(day_number AS INTEGER) AS day_number,
          CAST(r.total AS DOUBLE) AS row_total, CAST(d.total AS DOUBLE) AS day_total,
          CAST(r.total - d.total AS DOUBLE) AS difference,
          CASE WHEN r.total = d.total THEN 'PASS' ELSE 'FAIL' END AS status
          FROM ({by_row}) r FULL JOIN ({daily}) d USING (day_number)"""
        for name, by_row, daily in parts))


_DRIVERS = f"""ends AS (
  SELECT CAST(max(total_hqla_usd) FILTER (day_number = 1) AS DOUBLE) AS h0,
         CAST(max(total_hqla_usd) FILTER (day_number = 150) AS DOUBLE) AS h1,
         CAST(max(total_inflow) FILTER (day_number = 1) AS DOUBLE) AS i0,
         CAST(max(total_inflow) FILTER (day_number = 150) AS DOUBLE) AS i1,
         CAST(max(total_outflow) FILTER (day_number = 1) AS DOUBLE) AS o0,
         CAST(max(total_outflow) FILTER (day_number = 150) AS DOUBLE) AS o1
  FROM ({net(AS_OF)}) n JOIN ({hqla(AS_OF)}) h USING (day_number))"""

_LISTING = "what_if_id, what_if_name, ref_tbl, {tbl} col, val, ROUND(factor, 6) AS factor"

# Checks of the semantic model that only read schemas: (table, missing, extra).
_COLUMN_CHECKS = [
    ("asset_classifications", "created_date, description, regulatory_basis", ""),
    ("business_unit_reference", "created_date, is_active", ""),
    ("cash_inflows", "created_date", ""),
    ("cash_outflows", "created_date", ""),
    ("counterparty_data", "created_date, is_active", ""),
    ("positions", "created_date", ""),
    ("what_if_definitions_lookup", "created_date", ""),
    ("hqla_summary", "", ""),
    ("lcr", "", "run_id"),
    ("what_if_lcr", "", "run_id"),
]


def _report() -> str:
    counts = {
        "asset_classifications": "asset_classifications",
        "business_unit_reference": "business_unit_reference",
        "cash_inflows": "cash_inflows",
        "cash_outflows": "cash_outflows",
        "counterparty_data": "counterparty_data",
        "hqla_summary": f"({hqla(AS_OF)})",
        "lcr": "history",
        "positions": "positions",
        "what_if_definitions_lookup": "rules",
        "what_if_lcr": "scenario_history",
    }
    parts = [
        f"SELECT 'table' AS \"check\", '{name}' AS object, CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'WARN' END AS status,"
        f" CAST(COUNT(*) AS DOUBLE) AS metric, CASE WHEN COUNT(*) > 0 THEN 'has rows' ELSE 'empty' END AS detail FROM {source}"
        for name, source in counts.items()
    ]
    parts += [
        f"SELECT 'column', '{name}', '{'FAIL' if missing else 'PASS'}',"
        f" {len(missing.split(', ')) if missing else 0}::DOUBLE, 'missing: {missing}; extra: {extra}'"
        for name, missing, extra in _COLUMN_CHECKS
    ]
    parts.append(
        "SELECT 'relationship', relationship, CASE WHEN orphan_count = 0 THEN 'PASS' ELSE 'WARN' END,"
        " CAST(orphan_count AS DOUBLE), orphan_count || ' of ' || row_count || ' rows'"
        f" FROM ({_orphans()})"
    )
    parts += [
        f"SELECT 'verified query', '{name}', CASE WHEN COUNT(*) > 0 THEN 'PASS' ELSE 'WARN' END,"
        " CAST(LEAST(COUNT(*), 1) AS DOUBLE), CASE WHEN COUNT(*) > 0 THEN 'returns rows' ELSE 'no rows' END"
        " FROM base"
        for name in (
            "What is the liquidity coverage ratio trend over time?",
            "What is contributing to the increase in LCR over the next 150 days?",
        )
    ]
    return " UNION ALL ".join(parts)


_KEYS = {
    "asset_classifications": "security_type",
    "business_unit_reference": "business_unit_id",
    "cash_inflows": "inflow_id",
    "cash_outflows": "outflow_id",
    "counterparty_data": "counterparty_id",
    "positions": "position_id",
    "what_if_definitions_lookup": "what_if_id",
}


def _keys() -> str:
    sources = {"what_if_definitions_lookup": "rules"}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{key}' AS key_columns, COUNT(*) AS row_count, COUNT(DISTINCT {key}) AS distinct_keys,"
        f" COUNT({key}) - COUNT(DISTINCT {key}) AS duplicate_rows, COUNT(*) - COUNT({key}) AS null_keys,"
        f" CASE WHEN COUNT(*) = COUNT(DISTINCT {key}) THEN 'PASS' ELSE 'FAIL' END AS status FROM {sources.get(name, name)}"
        for name, key in _KEYS.items()
    )


def statements() -> dict[str, str]:
    """SQL by query name."""
    series = f"SELECT {SERIES} FROM base"
    return {
        # Projection, netting, ratio
        "hqla_detail": query(
            f"SELECT CAST(maturity_date AS VARCHAR) AS maturity_date, {dbl('total_hqla_usd')}"
            f" FROM ({detail(AS_OF)})"
        ),
        "hqla_projection_wide": _wide_hqla(150),
        "hqla_summary": query(
            f"SELECT CAST(day_number AS INTEGER) AS day_number, {dbl('total_hqla_usd')} FROM ({hqla(AS_OF)})"
        ),
        "hqla_summary_from_wide": query(
            f"SELECT CAST(day_number AS INTEGER) AS day_number, {dbl('total_hqla_usd')} FROM ({hqla(AS_OF)})"
        ),
        "hqla_summary_by_level": query(
            f"""SELECT hqla_level, CAST(day_number AS INTEGER) AS day_number,
                CAST(SUM(CASE WHEN CAST(maturity_date AS TIMESTAMP) <= {instant(AS_OF)} THEN 0
                         ELSE CAST(total_hqla_usd * decay AS DECIMAL(38,2)) END) AS DOUBLE) AS total_hqla_usd
                FROM ({detail(AS_OF, extra='h.hqla_level,')}) CROSS JOIN {days(150, '0.9999')}
                GROUP BY 1, 2"""
        ),
        "cash_inflow_projection_wide": _wide_flow("inflow", 150),
        "cash_outflow_projection_wide": _wide_flow("outflow", 150),
        "cash_inflow_daily": query(
            f"SELECT CAST(day_number AS INTEGER) AS day_number, {dbl('total_inflow')}"
            f" FROM ({flow('inflow', AS_OF)})"
        ),
        "cash_outflow_daily": query(
            f"SELECT CAST(day_number AS INTEGER) AS day_number, {dbl('total_outflow')}"
            f" FROM ({flow('outflow', AS_OF)})"
        ),
        "cash_outflow_from_wide": query(
            f"SELECT CAST(day_number AS INTEGER) AS day_number, {dbl('total_outflow')}"
            f" FROM ({flow('outflow', AS_OF)})"
        ),
        "net_cashflow": query(
            "SELECT CAST(day_number AS INTEGER) AS day_number,"
            f" {dbl('total_inflow', 'total_outflow', 'net_position', 'abs_net_position')}"
            f" FROM ({net(AS_OF)})"
        ),
        "lcr_baseline": query(series, BASE),
        "lcr_baseline_midnight": query(series, f"base AS ({ratio(MIDNIGHT)})"),
        "lcr_baseline_with_units": query(series, BASE),
        "cash_outflow_daily_by_counterparty": query(
            f"SELECT counterparty_id, CAST(day_number AS INTEGER) AS day_number, {dbl('total_outflow')}"
            f" FROM ({flow('outflow', AS_OF, by='counterparty_id')})"
        ),
        # Tables, stored and read
        "sql_text": "SELECT o_orderpriority AS priority, COUNT(*) AS n_orders,"
        " CAST(SUM(CAST(o_totalprice AS DECIMAL(20,2))) AS DOUBLE) AS price_usd FROM orders"
        " WHERE o_orderstatus = 'F' AND o_totalprice >= 1000 GROUP BY 1",
        "fetched_report": _both("business_unit_id", "business_unit_id"),
        "flows_in_a_snapshot": query(
            "SELECT inflow_type AS flow_type, COUNT(*) AS n_flows, CAST(SUM(inflow_amount_usd) AS DOUBLE) AS amount_usd"
            " FROM cash_inflows GROUP BY 1"
        ),
        "late_outflows_of_a_clustered_table": query(
            f"SELECT CAST(day_number AS INTEGER) AS day_number, {dbl('total_outflow')} FROM ({flow('outflow', LATE)})"
        ),
        "stressed_outflows_of_a_bucketed_table": query(
            "SELECT what_if_id, COUNT(*) AS n_flows, CAST(SUM(outflow_amount_usd) AS DOUBLE) AS outflow_usd"
            f" FROM ({stressed('cash_outflows', ('1', '2', '3'))}) GROUP BY 1"
        ),
        "units_and_counterparties": query(
            "SELECT business_unit_id, counterparty_id FROM cash_inflows"
            " UNION SELECT business_unit_id, counterparty_id FROM cash_outflows"
        ),
        "positions_beside_their_day": query(
            "SELECT p.position_id, CAST(p.position_date AS VARCHAR) AS position_date, CAST(p.position_value_usd AS DOUBLE) AS position_value_usd,"
            " CAST(t.usd AS DOUBLE) AS day_usd FROM positions p JOIN (SELECT security_id, position_date, SUM(position_value_usd) AS usd"
            " FROM positions GROUP BY 1, 2) t ON p.security_id = t.security_id AND p.position_date = t.position_date"
        ),
        "security_price_days": "SELECT 'SEC_' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS security_id,"
        f" CAST(DATE '{AS_OF[:10]}' - CAST(back AS INTEGER) AS VARCHAR) AS market_date,"
        " CAST(CAST(CAST(p_retailprice AS DECIMAL(20,4)) * (1000 - back) * 0.001 AS DECIMAL(20,4)) AS DOUBLE) AS price_usd"
        " FROM part CROSS JOIN (SELECT CAST(unnest(range(0, 30)) AS DECIMAL(4,0)) AS back) d",
        "inflow_notices": query(
            "SELECT 'CP_' || lpad(counterparty_id, 6, '0') AS counterparty, 'IN_' || lpad(inflow_id, 10, '0') AS inflow,"
            " CAST(maturity_date - 30 AS VARCHAR) AS notice_date, CAST(maturity_date + 2 AS VARCHAR) AS settled_by"
            " FROM cash_inflows WHERE maturity_date IS NOT NULL"
        ),
        # Scenarios
        **{
            f"factors_{kind}": query(
                f"SELECT what_if_id, {KINDS[kind][2]}, {dbl('factor')} FROM ({factors(kind, ('1', '2', '3'))})"
            )
            for kind in KINDS
        },
        "stressed_inflows": _stressed("cash_inflows"),
        "stressed_outflows": _stressed("cash_outflows"),
        "stressed_positions": _stressed("positions"),
        "lcr_what_if": query(f"SELECT what_if_id, {SERIES} FROM ({what_if(AS_OF, ('1',))})"),
        "lcr_what_if_all": query(f"SELECT what_if_id, {SERIES} FROM ({what_if(AS_OF, ('1', '2', '3'))})"),
        # History
        "appended_runs": query(
            "SELECT CASE WHEN created_timestamp = (SELECT max(created_timestamp) FROM history) THEN 'second' ELSE 'first' END AS run_id,"
            " COUNT(*) AS n_days, CAST(MIN(lcr) AS DOUBLE) AS least_lcr, CAST(MAX(lcr) AS DOUBLE) AS most_lcr, COUNT(*) AS n_rows"
            " FROM history GROUP BY 1",
            HISTORY,
        ),
        "latest_lcr": query(series, HISTORY),
        "latest_what_if_lcr": query(f"SELECT what_if_id, {SERIES} FROM latest WHERE what_if_id = '1'", SCENARIO_HISTORY),
        "lcr_change_analysis": query(_CHANGES.format(keys="", table="base", partition=""), HISTORY),
        "what_if_change_analysis": query(
            _CHANGES.format(keys="what_if_id,", table="latest", partition="PARTITION BY what_if_id"), SCENARIO_HISTORY
        ),
        "latest_of_equal_stamps": query(
            _CHANGES.format(keys="", table="base", partition=""), f"base AS ({ratio(EARLIER)})"
        ),
        "headline": query(_HEADLINE, HISTORY),
        # Scenario definitions
        "scenario_definitions": query(f"SELECT DISTINCT {_LISTING.format(tbl='')} FROM rules"),
        "scenario_listing": query(f"SELECT {_LISTING.format(tbl='tbl,')} FROM rules"),
        "scenario_ids": query("SELECT DISTINCT what_if_id FROM rules"),
        "scenario_rules": query(f"SELECT DISTINCT {_LISTING.format(tbl='')} FROM rules WHERE what_if_id = '3'"),
        # Business questions
        "lcr_trend_30_days": query(series + " WHERE day_number <= 30", HISTORY),
        "days_below_floor": query(series + " WHERE lcr < 1", HISTORY),
        "lcr_next_90_days": query(series + " WHERE day_number <= 90", HISTORY),
        "lcr_at_7_and_30_days": query(series + " WHERE day_number IN (7, 30)", HISTORY),
        "hqla_by_security_type": query(
            "SELECT security_type, CAST(CAST(SUM(total_hqla_usd) AS DECIMAL(38,2)) AS DOUBLE) AS hqla_usd"
            f" FROM ({detail(AS_OF, extra='p.security_type,')}) GROUP BY 1"
        ),
        "hqla_by_level": query(
            "SELECT hqla_level, CAST(CAST(SUM(total_hqla_usd) AS DECIMAL(38,2)) AS DOUBLE) AS hqla_usd"
            f" FROM ({detail(AS_OF, extra='h.hqla_level,')}) GROUP BY 1"
        ),
        "top_unit_by_hqla": query(
            "SELECT business_unit_id, business_unit_name,"
            " CAST(CAST(SUM(total_hqla_usd) AS DECIMAL(38,2)) AS DOUBLE) AS hqla_usd"
            f" FROM ({detail(AS_OF, extra='p.business_unit_id,')}) JOIN business_unit_reference USING (business_unit_id)"
            " GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 1"
        ),
        "largest_outflows_by_counterparty": query(
            "SELECT f.counterparty_id, counterparty_name, counterparty_type,"
            " CAST(SUM(outflow_amount_usd) AS DOUBLE) AS outflow_usd"
            " FROM cash_outflows f LEFT JOIN counterparty_data c USING (counterparty_id)"
            " GROUP BY 1, 2, 3 ORDER BY SUM(outflow_amount_usd) DESC, 1 LIMIT 10"
        ),
        "inflow_versus_outflow": query(
            f"SELECT CAST(day_number AS INTEGER) AS day_number, {dbl('total_inflow', 'total_outflow')}"
            f" FROM ({net(AS_OF)})"
        ),
        "net_outflow_by_unit": query(
            "SELECT business_unit_id, CAST(COALESCE(i, 0) AS DOUBLE) AS inflow_usd,"
            " CAST(COALESCE(o, 0) AS DOUBLE) AS outflow_usd,"
            " CAST(COALESCE(o, 0) - COALESCE(i, 0) AS DOUBLE) AS net_outflow_usd"
            " FROM (SELECT business_unit_id, SUM(inflow_amount_usd) AS i FROM cash_inflows GROUP BY 1) a"
            " FULL JOIN (SELECT business_unit_id, SUM(outflow_amount_usd) AS o FROM cash_outflows GROUP BY 1) b"
            " USING (business_unit_id)"
        ),
        "baseline_versus_scenarios": query(_COMPARE, BASE, NOW),
        "scenario_impact_day_30": query(_COMPARE + " WHERE s.day_number = 30", BASE, NOW),
        "positions_of_type": query(
            "SELECT position_id, security_id, security_type, position_type,"
            f" {dbl('position_value_usd')}, CAST(maturity_date AS VARCHAR) AS maturity_date"
            " FROM positions WHERE security_type LIKE 'ECONOMY%'"
        ),
        "largest_positions": query(
            f"SELECT position_id, security_id, security_type, {dbl('position_value_usd')}"
            " FROM positions ORDER BY positions.position_value_usd DESC, position_id, security_id LIMIT 10"
        ),
        "exposure_by_security_type": query(
            "SELECT security_type, COUNT(*) AS n_positions,"
            " CAST(SUM(CASE WHEN position_type = 'Long' THEN position_value_usd ELSE 0 END) AS DOUBLE) AS long_usd,"
            " CAST(SUM(CASE WHEN position_type = 'Short' THEN position_value_usd ELSE 0 END) AS DOUBLE) AS short_usd,"
            " CAST(SUM(position_value_usd) AS DOUBLE) AS exposure_usd FROM positions GROUP BY 1"
        ),
        "lcr_drivers": query(
            "SELECT cause, ROUND(effect, 8) AS effect FROM ("
            " SELECT 'hqla' AS cause, h1 / (i0 + o0) - h0 / (i0 + o0) AS effect FROM ends"
            " UNION ALL SELECT 'inflow', h1 / (i1 + o0) - h1 / (i0 + o0) FROM ends"
            " UNION ALL SELECT 'outflow', h1 / (i1 + o1) - h1 / (i1 + o0) FROM ends)",
            _DRIVERS,
        ),
        "counterparties_by_type": query(
            "SELECT counterparty_type, COUNT(*) AS n_counterparties FROM counterparty_data GROUP BY 1"
        ),
        "hqla_first_30_days": query(
            "SELECT CAST(SUM(total_hqla_usd) AS DOUBLE) AS total_hqla_usd, COUNT(*) AS n_days"
            f" FROM ({hqla(AS_OF)}) WHERE day_number <= 30"
        ),
        "flows_by_unit": _both("business_unit_id", "business_unit_id"),
        "flows_by_counterparty_type": _both(
            "c.counterparty_type", "counterparty_type", "LEFT JOIN counterparty_data c USING (counterparty_id)"
        ),
        "flows_by_type": _both("{side}_type", "flow_type"),
        "flows_by_maturity_bucket": _both(_BUCKET, "maturity_bucket"),
        # Semantic model and data quality
        "semantic_inflows_by_counterparty": query(
            "SELECT c.counterparty_type, c.region, f.inflow_type,"
            " CAST(SUM(inflow_amount_usd) AS DOUBLE) AS inflow_amount_usd"
            " FROM cash_inflows f LEFT JOIN counterparty_data c USING (counterparty_id)"
            " WHERE c.credit_rating IN ('AAA', 'AA') GROUP BY 1, 2, 3"
        ),
        "semantic_outflows_by_region": query(
            "SELECT b.region AS business_unit_reference_region, c.region AS counterparty_data_region,"
            " CAST(SUM(outflow_amount_usd) AS DOUBLE) AS outflow_amount_usd"
            " FROM cash_outflows f LEFT JOIN business_unit_reference b USING (business_unit_id)"
            " LEFT JOIN counterparty_data c USING (counterparty_id) GROUP BY 1, 2"
        ),
        "semantic_positions_by_level": query(
            "SELECT a.hqla_level, p.position_type, CAST(SUM(position_value_usd) AS DOUBLE) AS position_value_usd,"
            " CAST(SUM(quantity) AS DOUBLE) AS quantity"
            " FROM positions p LEFT JOIN asset_classifications a USING (security_type)"
            " WHERE p.position_date >= DATE '1998-01-01' GROUP BY 1, 2"
        ),
        "relationship_orphans": query(_orphans()),
        "unclassified_positions": query(
            "SELECT position_id, security_type, CAST(position_value_usd AS DOUBLE) AS position_value_usd"
            " FROM positions WHERE security_type NOT IN (SELECT security_type FROM asset_classifications)"
        ),
        "duplicate_keys": query(_keys()),
        "semantic_flows_and_positions_by_region": query(
            "SELECT region, i.usd AS inflow_amount_usd, o.usd AS outflow_amount_usd, p.usd AS position_value_usd FROM ("
            " SELECT c.region, CAST(SUM(inflow_amount_usd) AS DOUBLE) AS usd FROM cash_inflows LEFT JOIN counterparty_data c USING (counterparty_id) GROUP BY 1) i"
            " FULL JOIN (SELECT c.region, CAST(SUM(outflow_amount_usd) AS DOUBLE) AS usd FROM cash_outflows LEFT JOIN counterparty_data c USING (counterparty_id) GROUP BY 1) o USING (region)"
            " FULL JOIN (SELECT b.region, CAST(SUM(position_value_usd) AS DOUBLE) AS usd FROM positions LEFT JOIN business_unit_reference b USING (business_unit_id) GROUP BY 1) p USING (region)"
        ),
        "missing_fields": query(_nulls()),
        "reconciliation": _reconcile(),
        "quality_report": query(_report(), HISTORY, SCENARIO_HISTORY),
        "quality_summary": query(
            "SELECT \"check\", COUNT(*) FILTER (status = 'PASS') AS passed, COUNT(*) AS total,"
            " CASE WHEN COUNT(*) FILTER (status = 'PASS') = COUNT(*) THEN 'PASS' ELSE 'FAIL' END AS result"
            f" FROM ({_report()}) GROUP BY 1",
            HISTORY,
            SCENARIO_HISTORY,
        ),
    }
