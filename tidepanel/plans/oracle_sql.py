"""DuckDB SQL for the oracle side of every registered query.

The SQL is written independently of the Spark plans (different join
shapes, ``quantile_cont`` for quantiles, ``round_even`` for rounding) over
the same parquet tables.  Shared building blocks are CTE strings.
"""

from __future__ import annotations

# Fixed parameters, equal to the Spark side.
ORDER_METRICS = ("avg_price", "order_count", "avg_qty", "avg_extprice", "urgent_price")
SHOCK_METRICS = ("shock_count", "shock_max_price", "shock_min_discount", "shock_total")


def _entity_expr(entity: str) -> str:
    return {"nation": "n.n_name", "segment": "c.c_mktsegment",
            "customer": "CAST(o.o_custkey AS VARCHAR)"}[entity]


def order_panel_ctes(entity: str = "nation", prefix: str = "p") -> str:
    """CTEs ``{prefix}_wide`` and ``{prefix}_long`` for an order panel."""
    e = _entity_expr(entity)
    return f"""
{prefix}_o AS (
  SELECT o.o_orderkey, o.o_totalprice, o.o_orderpriority, {e} AS entity,
         last_day(CAST(o.o_orderdate AS DATE)) AS date
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey),
{prefix}_oa AS (
  SELECT entity, date, avg(o_totalprice) AS avg_price, CAST(count(*) AS DOUBLE) AS order_count,
         avg(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS urgent_price
  FROM {prefix}_o GROUP BY entity, date),
{prefix}_la AS (
  SELECT o.entity, o.date, avg(l.l_quantity) AS avg_qty, avg(l.l_extendedprice) AS avg_extprice
  FROM {prefix}_o o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.entity, o.date),
{prefix}_wide AS (
  SELECT a.entity, a.date, a.avg_price, a.order_count, b.avg_qty, b.avg_extprice, a.urgent_price
  FROM {prefix}_oa a LEFT JOIN {prefix}_la b ON a.entity = b.entity AND a.date = b.date),
{prefix}_long AS (
  {" UNION ALL ".join(f"SELECT entity, date, '{m}' AS metric, {m} AS value FROM {prefix}_wide WHERE {m} IS NOT NULL" for m in ORDER_METRICS)})"""


def shock_ctes() -> str:
    """CTEs ``shock`` (year, 4 measures) and ``shock_long``."""
    return f"""
shock AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(count(*) AS DOUBLE) AS shock_count,
         max(l_extendedprice) AS shock_max_price, min(l_discount) AS shock_min_discount,
         sum(l_extendedprice) / 1e6 AS shock_total
  FROM lineitem WHERE l_returnflag = 'R'
  GROUP BY 1),
shock_long AS (
  {" UNION ALL ".join(f"SELECT year, '{m}' AS metric, {m} AS value FROM shock" for m in SHOCK_METRICS)})"""


def winsor_ctes(src: str, out: str) -> str:
    return f"""
{out}_b AS (
  SELECT metric, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi, count(value) AS n
  FROM {src} GROUP BY metric),
{out} AS (
  SELECT s.entity, s.date, s.metric,
         CASE WHEN b.n >= 10 THEN least(greatest(s.value, b.lo), b.hi) ELSE s.value END AS value
  FROM {src} s JOIN {out}_b b ON s.metric = b.metric)"""


def balanced_ctes(src: str, out: str) -> str:
    return f"""
{out}_d AS (
  SELECT date FROM {src} GROUP BY date
  HAVING count(DISTINCT entity) = (SELECT count(DISTINCT entity) FROM {src})),
{out} AS (SELECT * FROM {src} WHERE date IN (SELECT date FROM {out}_d))"""


def enriched_ctes(entity: str = "segment", balance: bool = True) -> str:
    """CTEs ending in ``enr_long`` and ``enr_wide`` (the Spark enriched panel)."""
    bal = balanced_ctes("enr_w", "enr_b") if balance else "\nenr_b AS (SELECT * FROM enr_w)"
    metrics = list(ORDER_METRICS) + list(SHOCK_METRICS)
    grid_vals = ", ".join(f"('{m}')" for m in SHOCK_METRICS)
    pivots = ",\n         ".join(f"max(CASE WHEN metric = '{m}' THEN value END) AS {m}" for m in metrics)
    return f"""{order_panel_ctes(entity, "ep")},{shock_ctes()},{winsor_ctes("ep_long", "enr_w")},{bal},
enr_years AS (SELECT DISTINCT CAST(year(date) AS INTEGER) AS year FROM enr_b),
enr_annual AS (
  SELECT g.year, g.metric, coalesce(s.value, 0.0) AS value
  FROM (SELECT y.year, m.metric FROM enr_years y, (VALUES {grid_vals}) m(metric)) g
  LEFT JOIN shock_long s ON s.year = g.year AND s.metric = g.metric),
enr_keys AS (SELECT DISTINCT entity, date FROM enr_b),
enr_long AS (
  SELECT entity, date, metric, value FROM enr_b
  UNION ALL
  SELECT k.entity, k.date, a.metric, a.value FROM enr_keys k JOIN enr_annual a ON year(k.date) = a.year),
enr_wide AS (
  SELECT entity, date,
         {pivots}
  FROM enr_long GROUP BY entity, date)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes)


def r6(expr: str) -> str:
    return f"round_even({expr}, 6)"


def track_ctes() -> str:
    """CTE ``tp``: the track points the text parser must produce, computed
    straight from the tables (plus ``tp_loc`` with distance and year)."""
    return """
tp_src AS (
  SELECT 'AL' || CASE WHEN o.o_orderkey < 10000000 THEN lpad(CAST(o.o_orderkey AS VARCHAR), 8, '0') ELSE CAST(o.o_orderkey AS VARCHAR) END AS storm_id, c.c_name AS storm_name,
         l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_discount, l.l_returnflag,
         l.l_linestatus, l.l_shipdate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE l.l_linenumber <> 7 AND NOT (l.l_linenumber = 5 AND l.l_partkey % 3 = 0)),
tp AS (
  SELECT storm_id, storm_name,
    CASE WHEN l_linenumber = 6 THEN CAST(year(l_shipdate) AS VARCHAR) || '1345'
         ELSE strftime(l_shipdate, '%Y%m%d') END AS date,
    lpad(CAST(l_linenumber * 100 AS VARCHAR), 4, '0') AS time,
    CASE WHEN l_returnflag = 'R' THEN 'L' ELSE '' END AS record_id,
    l_linestatus AS status,
    (CASE WHEN l_partkey % 5 <> 0 THEN 1.0 ELSE -1.0 END)
      * CAST(CAST(l_partkey % 60 AS VARCHAR) || '.' || CAST(l_suppkey % 10 AS VARCHAR) AS DOUBLE) AS lat,
    (CASE WHEN l_suppkey % 4 <> 0 THEN -1.0 ELSE 1.0 END)
      * CAST(CAST(l_suppkey % 100 AS VARCHAR) || '.' || CAST(l_partkey % 10 AS VARCHAR) AS DOUBLE) AS lon,
    CASE WHEN l_quantity < 6 THEN NULL ELSE CAST(floor(l_quantity * 3) AS INTEGER) END AS max_wind,
    CASE WHEN l_discount = 0 THEN NULL ELSE 1010 - CAST(floor(l_discount * 100) AS INTEGER) END AS min_pressure
  FROM tp_src),
tp_loc AS (
  SELECT *, 2 * 3440.065 * asin(sqrt(pow(sin((radians(27.8) - radians(lat)) / 2), 2)
            + cos(radians(lat)) * cos(radians(27.8)) * pow(sin((radians(-81.7) - radians(lon)) / 2), 2))) AS dist,
         CAST(substr(date, 1, 4) AS INTEGER) AS yr
  FROM tp)"""


def z6(expr: str) -> str:
    """round half-even to 9 and then to 6 places (as the Spark side) and fold -0.0 into 0.0"""
    return f"(round_even(round_even({expr}, 9), 6) + 0.0)"


ORDER_LONG_COLS = "entity, date, metric, " + z6("value") + " AS value"
