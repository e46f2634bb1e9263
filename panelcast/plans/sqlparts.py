"""SQL fragments for the DuckDB oracle: the test-panel recipe as CTEs.

These mirror ``sources.testpanel`` exactly (same keys, same exact-cents
sums) so every oracle query starts from the same panel the Spark query
builds. Only the driver's base tables are visible to the oracle.
"""

from __future__ import annotations

from ..functions.calendar import HOLIDAY_ISO_WEEKS, REFERENCE_HOLIDAYS
from ..sources.testpanel import DEPT_CODES, PRIORITY_MARKDOWN, TEST_WEEKS, UNSEEN_SERIES

_WEEKS = ", ".join(str(w) for _, w in HOLIDAY_ISO_WEEKS)


def _dept_case(col: str = "p.p_type") -> str:
    arms = " ".join(f"WHEN '{n}' THEN {c}" for n, c in DEPT_CODES)
    return f"CAST(CASE {col} {arms} END AS INTEGER)"


def friday(col: str) -> str:
    return f"(CAST(date_trunc('week', {col}) AS DATE) + 4)"


def panel_cte(grain: str = "nation", name: str = "panel") -> str:
    if grain == "region":
        store = "CAST(n.n_regionkey AS INTEGER)"
        supp = "supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"
    else:
        store = "CAST(s.s_nationkey AS INTEGER)"
        supp = "supplier s"
    dept = ("CAST(split_part(p.p_brand, '#', 2) AS INTEGER)" if grain == "brand" else _dept_case())
    return f"""{name}_raw AS (
  SELECT {store} AS store, {dept} AS dept, {friday('l.l_shipdate')} AS date,
         CAST(SUM(CAST(ROUND(l.l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS weekly_sales
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
       JOIN {supp} ON l.l_suppkey = s.s_suppkey
  GROUP BY 1, 2, 3
), {name} AS (
  SELECT store, dept, date, weekly_sales, week(date) IN ({_WEEKS}) AS is_holiday FROM {name}_raw
)"""


def features_cte(grain: str = "nation", name: str = "features") -> str:
    if grain == "region":
        cust = ("(SELECT c.c_custkey, c.c_acctbal, CAST(n.n_regionkey AS INTEGER) AS store "
                "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)")
    else:
        cust = "(SELECT c_custkey, c_acctbal, CAST(c_nationkey AS INTEGER) AS store FROM customer)"
    md = ",\n         ".join(
        f"CAST(SUM(CASE WHEN o.o_orderpriority = '{p}' THEN CAST(ROUND(o.o_totalprice * 100) AS BIGINT) END)"
        f" AS DOUBLE) / 100.0 AS markdown{k}" for p, k in PRIORITY_MARKDOWN)
    return f"""{name}_raw AS (
  SELECT c.store AS store, {friday('o.o_orderdate')} AS date,
         CAST(SUM(CAST(ROUND(o.o_totalprice * 100) AS BIGINT)) AS DOUBLE) / (100.0 * COUNT(*)) AS temperature,
         CAST(COUNT(*) AS DOUBLE) AS fuel_price,
         CAST(SUM(CAST(ROUND(c.c_acctbal * 100) AS BIGINT)) AS DOUBLE) / (100.0 * COUNT(*)) AS cpi,
         CAST(SUM(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS unemployment,
         {md}
  FROM orders o JOIN {cust} c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2
), {name} AS (
  SELECT *, week(date) IN ({_WEEKS}) AS is_holiday FROM {name}_raw
)"""


def stores_cte(grain: str = "nation", name: str = "stores") -> str:
    key = "n.n_regionkey" if grain == "region" else "n.n_nationkey"
    return f"""{name} AS (
  SELECT CAST({key} AS INTEGER) AS store, MIN(r.r_name) AS type,
         CAST(COALESCE(SUM(sc.n_supp), 0) AS INTEGER) AS size
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
       LEFT JOIN (SELECT s_nationkey, COUNT(*) AS n_supp FROM supplier GROUP BY 1) sc
         ON n.n_nationkey = sc.s_nationkey
  GROUP BY 1
)"""


def split_ctes(panel: str = "panel", unseen: bool = True) -> str:
    """Train (last TEST_WEEKS weeks removed, with ``unseen`` one series dropped) and test (target withheld)."""
    s, d = UNSEEN_SERIES
    return f"""cut AS (SELECT MAX(date) - {7 * TEST_WEEKS} AS c FROM {panel}),
train AS (
  SELECT p.* FROM {panel} p, cut WHERE p.date <= cut.c{f" AND NOT (p.store = {s} AND p.dept = {d})" if unseen else ""}
), test AS (
  SELECT p.store, p.dept, p.date, p.is_holiday FROM {panel} p, cut WHERE p.date > cut.c
)"""


def holiday_list_sql(holidays=REFERENCE_HOLIDAYS) -> str:
    return "[" + ", ".join(f"DATE '{d}'" for _, d in holidays) + "]"


def nearest_holiday_sql(date_col: str, holidays=REFERENCE_HOLIDAYS) -> str:
    """Signed days to the nearest holiday, first-in-list on ties (correlated subquery)."""
    lst = holiday_list_sql(holidays)
    return (f"(SELECT CAST(h - {date_col} AS INTEGER) FROM (SELECT unnest({lst}) AS h, "
            f"unnest(range(1, {len(holidays) + 1})) AS i) "
            f"ORDER BY abs(h - {date_col}), i LIMIT 1)")


def det_sql(m: list[list[str]]) -> str:
    """Determinant of a small symbolic matrix by cofactor expansion (SQL text)."""
    if len(m) == 1:
        return m[0][0]
    terms = []
    for j in range(len(m)):
        minor = [row[:j] + row[j + 1:] for row in m[1:]]
        sign = "+" if j % 2 == 0 else "-"
        terms.append(f"{sign} ({m[0][j]}) * ({det_sql(minor)})")
    return "(" + " ".join(terms) + ")"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
