"""Oracle SQL per registered key (DuckDB dialect, same column names)."""

from __future__ import annotations

from .oracle_sql import (ORDER_LONG_COLS, ORDER_METRICS, SHOCK_METRICS, balanced_ctes, enriched_ctes,
                         order_panel_ctes, shock_ctes, track_ctes, winsor_ctes, with_, z6)

ORACLES: dict[str, str] = {}

PROFILE_COLS = ("avg_price", "order_count", "urgent_price", "shock_count", "shock_total")


def _profile_select(src: str, cols, decimals: int = 1) -> str:
    parts = []
    for c in cols:
        parts += [f"round_even(avg({c}), {decimals}) AS {c}_mean",
                  f"round_even(stddev_samp({c}), {decimals}) AS {c}_std",
                  f"round_even(min({c}), {decimals}) AS {c}_min",
                  f"round_even(max({c}), {decimals}) AS {c}_max"]
    return f"SELECT entity, {', '.join(parts)} FROM {src} GROUP BY entity"


ORACLES["entity_profile"] = with_(enriched_ctes("segment")) + "\n" + _profile_select("enr_wide", PROFILE_COLS)


# ---------------------------------------------------------------------------

PN = order_panel_ctes("nation", "pn")
PN_WIDE_COLS = "entity, date, " + ", ".join(f"{z6(m)} AS {m}" for m in ORDER_METRICS)
EVENTS_SQL = "(VALUES ('e1_1999_02', DATE '1999-02-01'), ('e2_tie_1997_06', DATE '1997-06-15'), ('e3_empty_2010', DATE '2010-01-01')) ev(event, event_date)"
STATE = "state AS (SELECT date, avg(avg_price) AS value FROM pn_wide WHERE avg_price IS NOT NULL GROUP BY date)"
BP_X = ("avg_qty", "avg_extprice", "order_count", "urgent_price")


def _swept(src: str, out: str, y: str) -> list:
    """CTEs that take the regressors out of ``y`` and of each other, one after the other (each step with a constant)."""
    ctes, cur, left = [], src, list(BP_X)
    while left:
        x, step = left.pop(0), f"{out}{len(BP_X) - len(left)}"
        cols = [*left, y]
        ctes.append(f"{step}_c AS (SELECT " + ", ".join(f"regr_slope({c}, {x}) AS b_{c}, regr_intercept({c}, {x}) AS a_{c}" for c in cols) + f" FROM {cur})")
        ctes.append(f"{step} AS (SELECT entity, date, " + ", ".join(f"t.{c} - a_{c} - b_{c} * t.{x} AS {c}" for c in cols) + f" FROM {cur} t, {step}_c)")
        cur = step
    return ctes


def _bp_ctes() -> list:
    """Breusch-Pagan: squared residuals of avg_price on the regressors, regressed on them again (R^2 in ``bp_r2``)."""
    some = " AND ".join(f"{c} IS NOT NULL" for c in ("avg_price", *BP_X))
    return [f"bp AS (SELECT entity, date, avg_price, {', '.join(BP_X)} FROM pn_wide WHERE {some})", *_swept("bp", "bp_u", "avg_price"),
            f"bp_sq AS (SELECT bp.entity, bp.date, {', '.join('bp.' + c for c in BP_X)}, pow(u.avg_price, 2) AS u2 FROM bp JOIN bp_u{len(BP_X)} u USING (entity, date))",
            *_swept("bp_sq", "bp_v", "u2"),
            f"bp_r2 AS (SELECT 1 - (SELECT sum(u2 * u2) FROM bp_v{len(BP_X)}) / (SELECT var_pop(u2) * count(*) FROM bp_sq) AS r2, (SELECT count(*) FROM bp_sq) AS n)"]


YEARS = ("yrs AS (SELECT CAST(unnest(range(min(year(o_orderdate)) - 1, max(year(o_orderdate)) + 2)) AS INTEGER) AS year "
         "FROM orders)")
SHOCK_GRID = ", ".join(f"('{m}')" for m in SHOCK_METRICS)

ORACLES.update({
    "scan_wide_dates": with_(PN) + f"\nSELECT {ORDER_LONG_COLS} FROM pn_long",
    "scan_header_detail": with_(track_ctes()) +
        "\nSELECT storm_id, storm_name, date, time, record_id, status, " + z6("lat") + " AS lat, " +
        z6("lon") + " AS lon, max_wind, min_pressure FROM tp",
    "scan_nested_json": """
SELECT event_type AS name,
       CAST(strftime(ts, '%Y') AS INTEGER) AS year,
       CASE WHEN event_id % 13 = 0 THEN strftime(ts, '%Y%m') ELSE strftime(ts, '%Y%m%d') END AS begin_date,
       strftime(ts, '%Y%m%d') AS end_date,
       """ + z6("CASE WHEN event_id % 7 <> 0 THEN coalesce(value, 0.0) ELSE 0.0 END") + """ AS cost,
       coalesce(CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS deaths
FROM events""",
    "scan_typed_long": with_(PN) + f"\nSELECT {ORDER_LONG_COLS} FROM pn_long",
    "schema_contract": with_(PN) + f"\nSELECT entity, date, {z6('avg_price')} AS avg_price, {z6('urgent_price')} AS urgent_price FROM pn_wide",
    "sink_long": with_(PN) + f"\nSELECT {ORDER_LONG_COLS} FROM pn_long",
    "sink_long_csv": with_(PN) + """
, r AS (SELECT row_number() OVER (ORDER BY entity, date, metric) - 1 AS row_no, * FROM pn_long)
SELECT n.name, row_no, """ + ORDER_LONG_COLS + """ FROM r, (VALUES ('master'), ('panel')) n(name)""",
    "dataset_metadata": with_(PN) + """
SELECT count(DISTINCT entity) AS n_entities, count(DISTINCT date) AS n_periods, count(*) AS n_obs,
       min(date) AS time_min, max(date) AS time_max, count(DISTINCT metric) AS n_variables,
       (SELECT count(*) FROM (SELECT DISTINCT entity, date FROM pn_long)) AS n_cells,
       CASE WHEN (SELECT min(c) = max(c) FROM (SELECT count(DISTINCT date) AS c FROM pn_long GROUP BY entity))
            THEN 'balanced' ELSE 'unbalanced' END AS panel_type
FROM pn_long""",
    "column_dictionary": with_(PN) + "\n" + " UNION ALL ".join(
        [f"SELECT 'nation_panel' AS dataset, '{c}' AS column, '{t}' AS dtype, 'key' AS role, "
         f"{z6(f'sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*)')} AS null_pct, "
         f"count(DISTINCT {c}) AS n_distinct, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max FROM pn_wide"
         for c, t in (("entity", "string"), ("date", "date"))] +
        [f"SELECT 'nation_panel', '{m}', 'double', 'measure', "
         f"{z6(f'sum(CASE WHEN {m} IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*)')}, count(DISTINCT {m}), "
         f"{z6(f'min({m})')}, {z6(f'max({m})')} FROM pn_wide" for m in ORDER_METRICS]),
    "filter_equality_and": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F'",
    "drop_empty_key": """
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE line IS NOT NULL AND trim(line, ' ') <> '' GROUP BY doc_id""",
    "tolerant_cast": with_(PN) + f"\nSELECT entity, date, {z6('urgent_price')} AS urgent_price FROM pn_wide WHERE urgent_price IS NOT NULL",
    "sentinel_to_null": with_(track_ctes()) + """
SELECT storm_id, count(max_wind) AS n_wind, count(min_pressure) AS n_pressure, max(max_wind) AS max_wind,
       min(min_pressure) AS min_pressure, count(*) AS n_points FROM tp GROUP BY storm_id""",
    "signed_coordinate": with_(track_ctes()) + f"""
SELECT storm_id, {z6('min(lat)')} AS min_lat, {z6('max(lat)')} AS max_lat, {z6('min(lon)')} AS min_lon,
       {z6('max(lon)')} AS max_lon FROM tp GROUP BY storm_id""",
    "parse_date_coerce": with_(track_ctes()) + """
SELECT storm_id, time, CAST(try_strptime(date, '%Y%m%d') AS DATE) AS date FROM tp
WHERE try_strptime(date, '%Y%m%d') IS NOT NULL""",
    "drop_null_measure": with_(PN) + f"\nSELECT {ORDER_LONG_COLS} FROM pn_long",
    "complete_cases": with_(PN) + f"\nSELECT {PN_WIDE_COLS} FROM pn_wide WHERE avg_price IS NOT NULL AND urgent_price IS NOT NULL",
    "filter_year_range": with_(PN) + f"\nSELECT {ORDER_LONG_COLS} FROM pn_long WHERE year(date) BETWEEN 1996 AND 2000",
    "exclude_window": with_(PN) + f"\nSELECT {ORDER_LONG_COLS} FROM pn_long WHERE NOT (date BETWEEN DATE '1997-03-01' AND DATE '1997-05-31')",
    "project_rename_drop": with_(PN) + f"""
SELECT entity AS region, date AS period, {z6('avg_price')} AS avg_price, {z6('order_count')} AS orders,
       {z6('urgent_price')} AS urgent_price FROM pn_wide""",
    "zero_fill": with_(PN) + f"""
SELECT entity, date, {z6('avg_price')} AS avg_price, {z6('order_count')} AS order_count, {z6('avg_qty')} AS avg_qty,
       {z6('avg_extprice')} AS avg_extprice, {z6('coalesce(urgent_price, 0.0)')} AS urgent_price FROM pn_wide""",
    "winsorize": with_(PN, winsor_ctes("pn_long", "wz")) + f"""
SELECT w.entity, w.date, w.metric, {z6('w.value')} AS value, (w.value <> p.value) AS clipped
FROM wz w JOIN pn_long p ON w.entity = p.entity AND w.date = p.date AND w.metric = p.metric""",
    "cleaning_audit": with_(PN, winsor_ctes("pn_long", "wz")) + """
, raw AS (""" + " UNION ALL ".join(f"SELECT entity, date, '{m}' AS metric, {m} AS value FROM pn_wide" for m in ORDER_METRICS) + """)
""" + " UNION ALL ".join(
        f"SELECT '{st}' AS stage, count(*) AS n_rows, CAST(sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS value_missing, "
        f"{z6('sum(CASE WHEN value IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*)')} AS value_missing_pct, "
        f"count(*) - count(DISTINCT (entity, date, metric)) AS n_duplicates, {clip} AS n_clipped FROM {src}"
        for st, src, clip in (("raw", "raw", "0"), ("non_null", "pn_long", "0"), ("deduped", "pn_long", "0"),
                              ("winsorized", "wz", "(SELECT count(*) FROM wz w JOIN pn_long p USING (entity, date, metric) WHERE w.value <> p.value)"))),
    "cleaning_audit_orders": f"""
WITH o AS (SELECT c_nationkey AS entity, last_day(CAST(o_orderdate AS DATE)) AS date, o_orderkey, o_totalprice AS price,
             CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END AS urgent
           FROM orders JOIN customer ON o_custkey = c_custkey),
raw AS (SELECT entity, date, o_orderkey, 'price' AS metric, price AS value FROM o UNION ALL SELECT entity, date, o_orderkey, 'urgent', urgent FROM o),
nn AS (SELECT * FROM raw WHERE value IS NOT NULL),
dd AS (SELECT entity, date, metric, min(o_orderkey) AS o_orderkey, arg_min(value, o_orderkey) AS value FROM nn GROUP BY entity, date, metric),
q AS (SELECT metric, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi, count(*) AS n FROM dd GROUP BY metric),
wz AS (SELECT dd.* EXCLUDE (value), value AS was, CASE WHEN n >= 10 THEN least(greatest(value, lo), hi) ELSE value END AS value FROM dd JOIN q USING (metric)),
st AS (
  SELECT 'raw' AS stage, count(*) AS n_rows, count(*) - count(value) AS value_missing, count(*) - count(DISTINCT (entity, date, metric)) AS n_duplicates, 0 AS n_clipped FROM raw
  UNION ALL SELECT 'non_null', count(*), 0, count(*) - count(DISTINCT (entity, date, metric)), 0 FROM nn
  UNION ALL SELECT 'deduped', count(*), 0, 0, 0 FROM dd
  UNION ALL SELECT 'winsorized', count(*), 0, 0, CAST(sum(CASE WHEN was <> value THEN 1 ELSE 0 END) AS BIGINT) FROM wz)
SELECT stage, n_rows, value_missing, {z6('value_missing * 100.0 / n_rows')} AS value_missing_pct, n_duplicates, n_clipped,
  (SELECT CAST(sum(o_orderkey) AS BIGINT) FROM wz) AS keys_kept, (SELECT {z6('avg(value)')} FROM wz) AS mean_kept FROM st""",
    "key_not_null_check": with_(PN) + f"\nSELECT {ORDER_LONG_COLS} FROM pn_long",
    "threshold_category": with_(PN) + f"""
, per AS (SELECT entity, avg(avg_price) AS m FROM pn_wide GROUP BY entity)
SELECT entity, {z6('m')} AS avg_price_mean,
       CASE WHEN m >= (SELECT quantile_cont(m, 0.5) FROM per) THEN 'Sensitive' ELSE 'Resilient' END AS category
FROM per""",
    "join_name_year": with_(track_ctes()) + """
, storms AS (SELECT DISTINCT t.storm_id, t.storm_name, CAST(year(o.o_orderdate) AS INTEGER) AS year
             FROM tp t JOIN orders o ON CAST(substr(t.storm_id, 3) AS BIGINT) = o.o_orderkey),
ev AS (
  SELECT CASE c.c_custkey % 3 WHEN 0 THEN 'Hurricane ' WHEN 1 THEN 'Tropical Storm ' ELSE '' END
           || c.c_name || ' (' || CAST(year(l.l_shipdate) AS VARCHAR) || ')' AS event_name,
         upper(c.c_name) AS name_key, CAST(year(l.l_shipdate) AS INTEGER) AS year,
         sum(l.l_extendedprice) AS cost, count(*) AS deaths
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE l.l_returnflag = 'R' GROUP BY ALL)
SELECT s.storm_id, s.storm_name, s.year, e.event_name, """ + z6("e.cost") + """ AS cost, e.deaths
FROM storms s JOIN ev e ON upper(trim(s.storm_name)) = e.name_key AND s.year = e.year""",
    "left_join_zero": with_(shock_ctes(), YEARS) + "\nSELECT y.year, " + ", ".join(
        f"{z6(f'coalesce(s.{m}, 0.0)')} AS {m}" for m in SHOCK_METRICS) + " FROM yrs y LEFT JOIN shock s ON y.year = s.year",
    "scaffold_left_join": with_(shock_ctes(), YEARS) + f"""
SELECT y.year, m.metric, {z6('coalesce(s.value, 0.0)')} AS value
FROM yrs y CROSS JOIN (VALUES {SHOCK_GRID}) m(metric) LEFT JOIN shock_long s ON s.year = y.year AND s.metric = m.metric""",
    "cross_scaffold": with_(YEARS) + f"\nSELECT y.year, m.metric FROM yrs y CROSS JOIN (VALUES {SHOCK_GRID}) m(metric)",
    "expand_period": with_(PN, shock_ctes()) + f"""
, keys AS (SELECT DISTINCT entity, date FROM pn_long),
grid AS (SELECT y.year, m.metric FROM (SELECT DISTINCT CAST(year(date) AS INTEGER) AS year FROM keys) y,
                (VALUES {SHOCK_GRID}) m(metric)),
annual AS (SELECT g.year, g.metric, coalesce(s.value, 0.0) AS value FROM grid g
           LEFT JOIN shock_long s ON s.year = g.year AND s.metric = g.metric)
SELECT k.entity, k.date, a.metric, {z6('a.value')} AS value FROM keys k JOIN annual a ON year(k.date) = a.year""",
    "balanced_semi_join": with_(PN, balanced_ctes("pn_long", "bal")) + f"\nSELECT {ORDER_LONG_COLS} FROM bal",
    "balanced_dates": with_(PN, balanced_ctes("pn_long", "bal")) + "\nSELECT date FROM bal_d",
    "subsample_semi_join": with_(PN) + f"""
, med AS (SELECT entity, quantile_cont(avg_price, 0.5) AS m FROM pn_wide GROUP BY entity),
high AS (SELECT entity FROM med WHERE m >= (SELECT quantile_cont(m, 0.5) FROM med))
SELECT {ORDER_LONG_COLS} FROM pn_long WHERE entity IN (SELECT entity FROM high)""",
    "range_join_window": with_(PN, STATE) + f"""
SELECT ev.event, s.date, {z6('s.value')} AS value FROM state s, {EVENTS_SQL}
WHERE s.date BETWEEN ev.event_date - INTERVAL 24 MONTH AND ev.event_date + INTERVAL 24 MONTH""",
    "nearest_asof_orders": with_(PN) + f"""
, ev AS (SELECT o_orderkey AS event, n_name AS entity, CAST(o_orderdate AS DATE) AS event_date
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
near AS (SELECT event, event_date, date, avg_price,
           row_number() OVER (PARTITION BY event ORDER BY abs(date - event_date), date DESC) AS rn
         FROM ev JOIN pn_wide p ON p.entity = ev.entity AND abs(p.date - ev.event_date) <= 10 AND avg_price IS NOT NULL)
SELECT ev.event, ev.event_date, {z6('avg_price')} AS base_value, date AS base_date
FROM ev LEFT JOIN near ON near.event = ev.event AND rn = 1""",
    "nearest_asof": with_(PN, STATE) + f"""
, win AS (SELECT ev.event, ev.event_date, s.date, s.value FROM state s, {EVENTS_SQL}
          WHERE s.date BETWEEN ev.event_date - INTERVAL 24 MONTH AND ev.event_date + INTERVAL 24 MONTH),
ranked AS (SELECT *, row_number() OVER (PARTITION BY event ORDER BY abs(date - event_date), date DESC) AS rn FROM win)
SELECT event, {z6('value')} AS base_value, date AS base_date FROM ranked WHERE rn = 1""",
})


# ---------------------------------------------------------------------------
# 2.4 - 2.7
# ---------------------------------------------------------------------------
QUAL = """
qual_ids AS (SELECT storm_id FROM tp_loc GROUP BY storm_id
             HAVING min(CASE WHEN yr BETWEEN 1996 AND 2000 THEN dist END) <= 600.0),
qual AS (SELECT * FROM tp_loc WHERE storm_id IN (SELECT storm_id FROM qual_ids)),
storms AS (
  SELECT storm_id, arg_min(storm_name, date || '|' || time) AS storm_name, arg_min(yr, date || '|' || time) AS year,
         max(max_wind) AS max_wind, min(min_pressure) AS min_pressure, bool_or(record_id = 'L') AS has_landfall,
         round_even(min(CASE WHEN yr BETWEEN 1996 AND 2000 THEN dist END), 1) AS closest_distance
  FROM qual GROUP BY storm_id)"""
W_ENT = "OVER (PARTITION BY entity ORDER BY date)"
NMAP = ("avg_price", "order_count", "avg_qty", "avg_extprice", "urgent_price")


def _describe(m: str) -> str:
    return (f"SELECT '{m}' AS column, count({m}) AS count, {z6(f'avg({m})')} AS mean, {z6(f'stddev_samp({m})')} AS std, "
            f"{z6(f'min({m})')} AS min, {z6(f'max({m})')} AS max, "
            f"{z6(f'sum(CASE WHEN {m} IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*)')} AS missing_pct, "
            f"{z6(f'quantile_cont({m}, 0.25)')} AS p25, {z6(f'quantile_cont({m}, 0.5)')} AS p50, "
            f"{z6(f'quantile_cont({m}, 0.75)')} AS p75 FROM pn_wide")


CORR_PAIRS = [(a, b) for i, a in enumerate(NMAP) for b in NMAP[: i + 1]]

ORACLES.update({
    "min_distance_qualify": with_(track_ctes(), QUAL) + f"\nSELECT storm_id, date, time, {z6('dist')} AS dist FROM qual",
    "storm_summary": with_(track_ctes(), QUAL) + "\nSELECT * FROM storms",
    "annual_exposure": with_(track_ctes(), QUAL) + """
SELECT year, count(*) AS n, max(max_wind) AS max_wind, min(min_pressure) AS min_pressure,
       min(closest_distance) AS closest_distance FROM storms GROUP BY year""",
    "annual_cost": f"""
SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year, {z6('sum(l.l_extendedprice / 1e6)')} AS total_cost_m, count(*) AS total_deaths
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
WHERE l.l_returnflag = 'R' GROUP BY 1""",
    "haversine": """
WITH g AS (SELECT c_custkey, CAST(((c_custkey * 7) % 181) - 90 AS DOUBLE) AS lat,
                  CAST(((c_custkey * 13) % 361) - 180 AS DOUBLE) AS lon FROM customer)
SELECT c_custkey, """ + z6("2 * 3440.065 * asin(sqrt(pow(sin((radians(27.8) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(27.8)) * pow(sin((radians(-81.7) - radians(lon)) / 2), 2)))") + " AS dist_nm FROM g",
    "panel_shape": with_(PN) + """
, pe AS (SELECT entity, count(DISTINCT date) AS c FROM pn_long GROUP BY entity),
pem AS (SELECT entity, metric, count(*) AS c FROM pn_long GROUP BY entity, metric)
SELECT (SELECT count(DISTINCT entity) FROM pn_long) AS n_entities,
       (SELECT count(DISTINCT date) FROM pn_long) AS n_periods,
       (SELECT count(*) FROM pn_long) AS n_obs,
       (SELECT min(c) FROM pe) AS min_obs_entity, (SELECT max(c) FROM pe) AS max_obs_entity,
       (SELECT min(c) FROM pem) AS min_obs_entity_metric, (SELECT max(c) FROM pem) AS max_obs_entity_metric,
       (SELECT min(c) = max(c) FROM pe) AS balanced,
       (SELECT min(c) FROM pe) = (SELECT count(DISTINCT date) FROM pn_long) AS complete""",
    "metric_profile": with_(PN) + "\n" + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {z6(f'avg({m})')} AS mean, {z6(f'stddev_samp({m})')} AS std, {z6(f'min({m})')} AS min, "
        f"{z6(f'max({m})')} AS max, CAST(sum(CASE WHEN {m} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing, "
        f"{z6(f'sum(CASE WHEN {m} IS NULL THEN 1 ELSE 0 END) * 100.0 / count(*)')} AS missing_pct FROM pn_wide" for m in NMAP),
    "describe_columns": with_(PN) + "\n" + " UNION ALL ".join(_describe(m) for m in NMAP),
    "period_mean": with_(PN) + "\nSELECT CAST(year(date) AS INTEGER) AS year, " + ", ".join(
        f"round_even(round_even(avg({m}), 9), 1) AS {m}_mean" for m in NMAP) + " FROM pn_wide GROUP BY 1",
    "missing_pct": with_(PN) + "\nSELECT " + ", ".join(
        f"{z6(f'avg(CASE WHEN {m} IS NULL THEN 1.0 ELSE 0.0 END) * 100.0')} AS {m}_missing_pct" for m in NMAP) + " FROM pn_wide",
    "grouped_median_split": with_(PN) + f"""
, med AS (SELECT entity, quantile_cont(avg_price, 0.5) AS m FROM pn_wide GROUP BY entity),
cut AS (SELECT quantile_cont(m, 0.5) AS c FROM med)
SELECT entity, {z6('m')} AS entity_median, {z6('c')} AS cutoff, CASE WHEN m >= c THEN 'high' ELSE 'low' END AS "group"
FROM med, cut""",
    "corr_matrix": with_(PN) + "\n" + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {z6(f'CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END')} AS r FROM pn_wide"
        for a, b in CORR_PAIRS),
    "pairwise_corr": with_(PN) + f"""
SELECT entity, {z6('CASE WHEN isnan(corr(avg_price, urgent_price)) THEN NULL ELSE corr(avg_price, urgent_price) END')} AS r,
       count(CASE WHEN avg_price IS NOT NULL AND urgent_price IS NOT NULL THEN 1 END) AS n
FROM pn_wide GROUP BY entity""",
    "linear_fit": with_(PN) + f"""
SELECT entity, {z6('regr_slope(avg_extprice, avg_qty)')} AS slope, {z6('regr_intercept(avg_extprice, avg_qty)')} AS intercept,
       {z6('min(CASE WHEN avg_extprice IS NOT NULL THEN avg_qty END)')} AS x_min,
       {z6('max(CASE WHEN avg_extprice IS NOT NULL THEN avg_qty END)')} AS x_max
FROM pn_wide GROUP BY entity""",
    "fit_line_grid": with_(PN) + f"""
, fits AS (SELECT entity, regr_slope(avg_extprice, avg_qty) AS slope, regr_intercept(avg_extprice, avg_qty) AS intercept,
                 min(avg_qty) AS x_min, max(avg_qty) AS x_max FROM pn_wide GROUP BY entity)
SELECT entity, CAST(i AS INTEGER) AS i, {z6('x_min + i * ((x_max - x_min) / 99.0)')} AS x,
       {z6('intercept + slope * (x_min + i * ((x_max - x_min) / 99.0))')} AS y_fit
FROM fits, range(0, 100) r(i) WHERE slope IS NOT NULL""",
    "time_range_total": with_(PN) + f"\nSELECT min(date) AS time_min, max(date) AS time_max, {z6('sum(order_count)')} AS total FROM pn_wide",
    "time_quantile_split": with_(PN) + """
, cut AS (SELECT quantile_cont(CAST(epoch_us(CAST(date AS TIMESTAMP)) AS DOUBLE), 0.8) AS c FROM pn_long)
SELECT entity, date, metric, CASE WHEN CAST(epoch_us(CAST(date AS TIMESTAMP)) AS DOUBLE) <= c THEN 'train' ELSE 'test' END AS split
FROM pn_long, cut""",
    "dedupe_keep_first": f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {z6('l_quantity')} AS l_quantity, {z6('l_extendedprice')} AS l_extendedprice,
       {z6('l_discount')} AS l_discount, {z6('l_tax')} AS l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
             l_quantity NULLS FIRST, l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST,
             l_returnflag NULLS FIRST, l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn FROM lineitem) WHERE rn = 1""",
    "log_diff": with_(PN) + f"""
, lg AS (SELECT entity, date, CASE WHEN avg_price > 0 THEN ln(avg_price) END AS lx FROM pn_wide)
SELECT entity, date, {z6(f'lx - lag(lx, 1) {W_ENT}')} AS price_growth FROM lg""",
    "pct_change": with_(PN) + f"""
, pd AS (SELECT entity, date, last_value(urgent_price IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS px FROM pn_wide),
pv AS (SELECT entity, date, px, lag(px, 1) {W_ENT} AS prev FROM pd)
SELECT entity, date, {z6('px / CASE WHEN prev <> 0 THEN prev END - 1.0')} AS urgent_growth FROM pv""",
    "lag_features": with_(PN) + f"""
SELECT entity, date, lag(order_count, 1) {W_ENT} AS order_count_l1, lag(order_count, 2) {W_ENT} AS order_count_l2,
       lag(order_count, 3) {W_ENT} AS order_count_l3 FROM pn_wide""",
    "lead_features": with_(PN) + "\nSELECT entity, date, " + ", ".join(
        f"{z6(f'lead(avg_price, {k}) {W_ENT}')} AS avg_price_f{k}" for k in range(13)) + " FROM pn_wide",
    "interaction_feature": with_(PN) + f"""
SELECT entity, date, {z6(f'lag(order_count, 1) {W_ENT} * CASE WHEN avg_qty > 0 THEN ln(avg_qty) END')} AS count_x_qty_l1 FROM pn_wide""",
    "ffill_limit": with_(PN) + f"""
, rn AS (SELECT entity, date, urgent_price, row_number() {W_ENT} AS r FROM pn_wide),
lastv AS (SELECT *, last_value(urgent_price IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv,
                 last_value(CASE WHEN urgent_price IS NOT NULL THEN r END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lr
          FROM rn)
SELECT entity, date, {z6('CASE WHEN urgent_price IS NOT NULL THEN urgent_price WHEN r - lr <= 3 THEN lv END')} AS urgent_filled FROM lastv""",
    "centered_ma": with_(PN) + f"""
, mv AS (SELECT entity, date,
         sum(avg_price) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS s,
         count(avg_price) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS c,
         lag(avg_price, 6) {W_ENT} AS a, lead(avg_price, 6) {W_ENT} AS b FROM pn_wide)
SELECT entity, date, {z6('CASE WHEN c = 13 THEN (s - 0.5 * (a + b)) / 12.0 END')} AS trend FROM mv""",
    "normalize_to_base": with_(PN, STATE) + f"""
, win AS (SELECT ev.event, ev.event_date, s.date, s.value FROM state s, {EVENTS_SQL}
          WHERE s.date BETWEEN ev.event_date - INTERVAL 24 MONTH AND ev.event_date + INTERVAL 24 MONTH),
base AS (SELECT event, value AS b FROM (SELECT *, row_number() OVER (PARTITION BY event ORDER BY abs(date - event_date), date DESC) AS rn FROM win) WHERE rn = 1)
SELECT w.event, w.date, {z6('w.value / b.b * 100.0')} AS normalized FROM win w JOIN base b ON w.event = b.event""",
    "relative_month": with_(PN, STATE) + f"""
SELECT ev.event, s.date, CAST(round_even((s.date - ev.event_date) / 30.44, 0) AS INTEGER) AS rel_month FROM state s, {EVENTS_SQL}
WHERE s.date BETWEEN ev.event_date - INTERVAL 24 MONTH AND ev.event_date + INTERVAL 24 MONTH""",
    "sort_keys": with_(PN) + f"\nSELECT {ORDER_LONG_COLS} FROM pn_long",
    "head_n": with_(PN) + f"\nSELECT {ORDER_LONG_COLS} FROM pn_long ORDER BY entity, date, metric LIMIT 10",
    "topk_by_count": with_(PN) + "\nSELECT entity, count(urgent_price) AS n_obs FROM pn_wide GROUP BY entity ORDER BY n_obs DESC, entity LIMIT 3",
    "rank_by_measure": with_(PN) + f"""
, v AS (SELECT entity, {z6('stddev_samp(avg_price)')} AS price_std FROM pn_wide GROUP BY entity)
SELECT row_number() OVER (ORDER BY price_std DESC, entity) AS rank, entity, price_std FROM v""",
    "union_all_long": with_(PN, shock_ctes()) + f"""
, keys AS (SELECT DISTINCT entity, date FROM pn_long),
grid AS (SELECT y.year, m.metric FROM (SELECT DISTINCT CAST(year(date) AS INTEGER) AS year FROM keys) y, (VALUES {SHOCK_GRID}) m(metric)),
annual AS (SELECT g.year, g.metric, coalesce(s.value, 0.0) AS value FROM grid g LEFT JOIN shock_long s ON s.year = g.year AND s.metric = g.metric)
SELECT {ORDER_LONG_COLS} FROM pn_long
UNION ALL SELECT k.entity, k.date, a.metric, {z6('a.value')} FROM keys k JOIN annual a ON year(k.date) = a.year""",
    "distinct_keys": with_(PN) + "\nSELECT DISTINCT entity, date FROM pn_long",
    "normalize_event_name": """
SELECT CASE c.c_custkey % 3 WHEN 0 THEN 'Hurricane ' WHEN 1 THEN 'Tropical Storm ' ELSE '' END
         || c.c_name || ' (' || CAST(year(l.l_shipdate) AS VARCHAR) || ')' AS event_name,
       CAST(year(l.l_shipdate) AS INTEGER) AS year, upper(trim(c.c_name)) AS name_key
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
WHERE l.l_returnflag = 'R' GROUP BY c.c_custkey, c.c_name, year(l.l_shipdate)""",
    "upper_trim_key": "SELECT p_partkey, upper(trim(p_name)) AS name_key FROM part",
    "short_name": """
SELECT c_custkey, c_name || '-' || c_mktsegment || ', ' || CAST(c_nationkey AS VARCHAR) AS full_name,
       trim(split_part(split_part(c_name || '-' || c_mktsegment || ', ' || CAST(c_nationkey AS VARCHAR), ',', 1), '-', 1)) AS short_name
FROM customer""",
    "slug": "SELECT p_partkey, replace(replace(lower(p_name || '. ' || p_type), ' ', '_'), '.', '') AS slug FROM part",
    "date_parts": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       strftime(o_orderdate, '%Y-%m') AS year_month, strftime(o_orderdate, '%Y-%m-%d') AS iso_date FROM orders""",
    "unit_round": with_(shock_ctes()) + """
SELECT year, round_even(shock_total * 1000.0 / 1000.0, 2) AS total_billion, round_even(shock_max_price, 1) AS max_price_1dp FROM shock""",
    "log_transform": f"SELECT l_orderkey, l_linenumber, {z6('CASE WHEN l_discount > 0 THEN ln(l_discount) END')} AS ln_discount FROM lineitem",
    "sig_stars": """
SELECT CASE WHEN l_discount IS NULL THEN '' WHEN l_discount < 0.01 THEN '***' WHEN l_discount < 0.05 THEN '**'
            WHEN l_discount < 0.10 THEN '*' ELSE '' END AS stars, count(*) AS n FROM lineitem GROUP BY 1""",
})


# ---------------------------------------------------------------------------
# 2.8 linear models: closed forms on the balanced events panel (k = 1)
# ---------------------------------------------------------------------------
EP = """
ep AS (SELECT event_type AS entity, CAST(ts AS DATE) AS date, avg(value) AS y, CAST(count(*) AS DOUBLE) AS x
       FROM events GROUP BY 1, 2),
em AS (SELECT *, y - avg(y) OVER (PARTITION BY entity) - avg(y) OVER (PARTITION BY date) + avg(y) OVER () AS yy,
              x - avg(x) OVER (PARTITION BY entity) - avg(x) OVER (PARTITION BY date) + avg(x) OVER () AS xx,
              y - avg(y) OVER (PARTITION BY entity) AS ye, x - avg(x) OVER (PARTITION BY entity) AS xe FROM ep),
eb AS (SELECT sum(xx * yy) / sum(xx * xx) AS beta, sum(xx * xx) AS sxx, count(*) AS n,
              count(DISTINCT entity) AS ne, count(DISTINCT date) AS nt FROM em),
eu AS (SELECT em.*, yy - beta * xx AS u, ye - beta * xe AS uw FROM em, eb),
es AS (SELECT sum(u * u) AS ssr, sum(yy * yy) AS tss, sum(uw * uw) AS ssr_w, sum(ye * ye) AS tss_w FROM eu),
ec AS (SELECT sum(s * s) AS bsum FROM (SELECT entity, sum(xx * u) AS s FROM eu GROUP BY entity)),
edf AS (SELECT n - 1 - (ne + nt - 1) AS df FROM eb)"""

ORACLES.update({
    "fe_twoway": with_(EP) + f"\nSELECT 'n_events' AS variable, {z6('beta')} AS coef, n AS nobs, ne AS n_entities, nt AS n_periods, df AS df_resid FROM eb, edf",
    "fe_unadjusted_se": with_(EP) + f"\nSELECT 'n_events' AS variable, {z6('beta')} AS coef, {z6('sqrt(ssr / df / sxx)')} AS se FROM eb, es, edf",
    "fe_clustered_se": with_(EP) + f"\nSELECT 'n_events' AS variable, {z6('beta')} AS coef, {z6('sqrt(n / df * bsum / (sxx * sxx))')} AS se_clustered FROM eb, ec, edf",
    "fe_fit_stats": with_(EP) + f"""
SELECT n AS nobs, df AS df_resid, {z6('1 - ssr / tss')} AS r2, {z6('1 - ssr_w / tss_w')} AS r2_within,
       {z6('1 - (ssr_w / tss_w) * (n - 1) / (n - 2)')} AS r2_within_adj FROM eb, es, edf""",
    "resid_fitted": with_(EP) + f"\nSELECT entity, date, {z6('u')} AS resid, {z6('beta * x')} AS fitted FROM eu, eb",
    "pooled_ols": with_(PN) + f"""
, c AS (SELECT covar_pop(avg_qty, avg_qty) AS s11, covar_pop(avg_extprice, avg_extprice) AS s22,
               covar_pop(avg_qty, avg_extprice) AS s12, covar_pop(avg_qty, avg_price) AS s1y,
               covar_pop(avg_extprice, avg_price) AS s2y, avg(avg_qty) AS m1, avg(avg_extprice) AS m2,
               avg(avg_price) AS my, count(*) AS n
        FROM pn_wide WHERE avg_qty IS NOT NULL AND avg_extprice IS NOT NULL AND avg_price IS NOT NULL),
b AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1,
             (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2 FROM c),
fit AS (SELECT 1 - sum(pow(p.avg_price - (b.my - b.b1 * b.m1 - b.b2 * b.m2) - b.b1 * p.avg_qty - b.b2 * p.avg_extprice, 2))
                   / sum(pow(p.avg_price - b.my, 2)) AS r2
        FROM pn_wide p, b WHERE p.avg_qty IS NOT NULL AND p.avg_extprice IS NOT NULL AND p.avg_price IS NOT NULL)
SELECT v.variable, {z6('v.coef')} AS coef, {z6('fit.r2')} AS r2, b.n AS nobs
FROM b, fit, (SELECT 'const' AS variable, my - b1 * m1 - b2 * m2 AS coef FROM b
              UNION ALL SELECT 'avg_qty', b1 FROM b UNION ALL SELECT 'avg_extprice', b2 FROM b) v""",
    "breusch_pagan": with_(PN) + ", " + ", ".join(_bp_ctes()) + f"""
SELECT {z6('n * r2')} AS lm, {z6('exp(-n * r2 / 2) * (1 + n * r2 / 2)')} AS lm_pvalue, {z6('f')} AS f,
  {z6('pow(z, (n - 5) / 2.0) * (1 + (n - 5) / 2.0 * (1 - z))')} AS f_pvalue, n AS nobs
FROM (SELECT *, (n - 5) / (n - 5 + 4 * f) AS z FROM (SELECT *, (r2 / 4) / ((1 - r2) / (n - 5)) AS f FROM bp_r2))""",
    "vif": with_(PN) + f"""
, g AS (SELECT sum(avg_qty * avg_qty) AS a11, sum(avg_extprice * avg_extprice) AS a22, sum(avg_qty * avg_extprice) AS a12
        FROM pn_wide WHERE avg_qty IS NOT NULL AND avg_extprice IS NOT NULL)
SELECT 'avg_qty' AS variable, {z6('a11 * a22 / (a11 * a22 - a12 * a12)')} AS vif FROM g
UNION ALL SELECT 'avg_extprice', {z6('a11 * a22 / (a11 * a22 - a12 * a12)')} FROM g""",
})


GROWTH = """
pn_g AS (SELECT entity, date, CASE WHEN avg_price > 0 THEN ln(avg_price) END
                - lag(CASE WHEN avg_price > 0 THEN ln(avg_price) END, 1) OVER (PARTITION BY entity ORDER BY date) AS y
         FROM pn_wide),
gs AS (SELECT entity AS series, date, y FROM pn_g WHERE y IS NOT NULL
       UNION ALL SELECT 'ALL', date, avg(y) FROM pn_g WHERE y IS NOT NULL GROUP BY date),
gr AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY date DESC) AS rd FROM gs),
nv AS (SELECT t.series, t.date, t.y AS actual, l.y AS naive FROM gr t
       JOIN (SELECT series, arg_max(y, date) AS y FROM gr WHERE rd > 12 GROUP BY series) l ON t.series = l.series
       WHERE t.rd <= 12)"""

ORACLES.update({
    "naive_forecast": with_(PN, GROWTH) + f"\nSELECT series, date, {z6('actual')} AS actual, {z6('naive')} AS naive FROM nv",
    "forecast_eval": with_(PN, GROWTH) + f"\nSELECT series, {z6('sqrt(avg((actual - naive) * (actual - naive)))')} AS rmse_naive, {z6('1 - sum((actual - naive) * (actual - naive)) / (sum(actual * actual) - sum(actual) * sum(actual) / count(*))')} AS r2, count(*) AS n FROM nv GROUP BY series",
})


# ---------------------------------------------------------------------------
# series analytics
# ---------------------------------------------------------------------------
def _regular(col: str, out: str) -> str:
    return f"""
{out}_m AS (SELECT entity, CAST(date_trunc('month', date) AS DATE) AS m, {col} AS v FROM pn_wide WHERE {col} IS NOT NULL),
{out}_cal AS (SELECT entity, CAST(unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS DATE) AS m
              FROM {out}_m GROUP BY entity),
{out}_j AS (SELECT c.entity, c.m, x.v, row_number() OVER (PARTITION BY c.entity ORDER BY c.m) AS r
            FROM {out}_cal c LEFT JOIN {out}_m x ON c.entity = x.entity AND c.m = x.m),
{out}_f AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY entity ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv,
                   last_value(CASE WHEN v IS NOT NULL THEN r END IGNORE NULLS) OVER (PARTITION BY entity ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lr
            FROM {out}_j),
{out} AS (SELECT entity, m AS date, CASE WHEN v IS NOT NULL THEN v WHEN r - lr <= 3 THEN lv END AS v FROM {out}_f
          WHERE v IS NOT NULL OR r - lr <= 3)"""


NAT = enriched_ctes("nation")
LAGS = range(13)
XC = f"""
xc_b AS (SELECT entity, date, shock_total AS x,
                (avg_price / CASE WHEN lag(avg_price) OVER (PARTITION BY entity ORDER BY date) <> 0
                                  THEN lag(avg_price) OVER (PARTITION BY entity ORDER BY date) END - 1.0) * 100.0 AS pct
         FROM enr_wide WHERE avg_price IS NOT NULL),
xc_l AS (SELECT entity, x, {", ".join(f"lead(pct, {k}) OVER (PARTITION BY entity ORDER BY date) AS f{k}" for k in LAGS)} FROM xc_b),
xc_r AS (SELECT entity, {", ".join(f"CASE WHEN count(CASE WHEN x IS NOT NULL AND f{k} IS NOT NULL THEN 1 END) >= 2 AND NOT isnan(corr(x, f{k})) THEN corr(x, f{k}) END AS r{k}" for k in LAGS)}
         FROM xc_l GROUP BY entity)"""

ORACLES.update({
    "regular_series": with_(PN, _regular("urgent_price", "rs")) + f"\nSELECT entity, date, {z6('v')} AS urgent_price FROM rs",
    "seasonal_decompose": with_(PN, _regular("avg_price", "rs")) + f"""
, sd AS (SELECT entity, date, v, count(*) OVER (PARTITION BY entity) AS n,
                CAST((row_number() OVER (PARTITION BY entity ORDER BY date) - 1) % 12 AS INTEGER) AS phase,
                sum(v) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS s,
                count(v) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING) AS c,
                lag(v, 6) OVER (PARTITION BY entity ORDER BY date) AS a, lead(v, 6) OVER (PARTITION BY entity ORDER BY date) AS b
         FROM rs),
tr AS (SELECT *, CASE WHEN c = 13 THEN (s - 0.5 * (a + b)) / 12.0 END AS trend FROM sd WHERE n >= 24),
ph AS (SELECT entity, phase, avg(v - trend) AS pm FROM tr GROUP BY entity, phase),
ps AS (SELECT entity, phase, pm - avg(pm) OVER (PARTITION BY entity) AS seasonal FROM ph)
SELECT t.entity, t.date, t.phase, {z6('t.v')} AS observed, {z6('t.trend')} AS trend, {z6('p.seasonal')} AS seasonal,
       {z6('t.v - t.trend - p.seasonal')} AS resid
FROM tr t JOIN ps p ON t.entity = p.entity AND t.phase = p.phase""",
    "event_study": with_(PN, STATE) + f"""
, win AS (SELECT ev.event, ev.event_date, s.date, s.value FROM state s, {EVENTS_SQL}
          WHERE s.date BETWEEN ev.event_date - INTERVAL 24 MONTH AND ev.event_date + INTERVAL 24 MONTH),
base AS (SELECT event, value AS base_value, date AS base_date FROM
         (SELECT *, row_number() OVER (PARTITION BY event ORDER BY abs(date - event_date), date DESC) AS rn FROM win) WHERE rn = 1)
SELECT w.event, w.event_date, w.date, {z6('w.value')} AS value, b.base_date, {z6('b.base_value')} AS base_value,
       {z6('w.value / b.base_value * 100.0')} AS normalized,
       CAST(round_even((w.date - w.event_date) / 30.44, 0) AS INTEGER) AS rel_month
FROM win w JOIN base b ON w.event = b.event""",
    "cross_correlation": with_(NAT, XC) + "\nSELECT lag, " + z6("avg(r)") + " AS mean_corr, count(r) AS n_entities FROM (" + " UNION ALL ".join(
        f"SELECT entity, {k} AS lag, r{k} AS r FROM xc_r" for k in LAGS) + ") GROUP BY lag",
    "segmentation": with_(NAT) + f"""
, sb AS (SELECT entity, shock_total,
                avg_price / CASE WHEN lag(avg_price) OVER (PARTITION BY entity ORDER BY date) <> 0
                                 THEN lag(avg_price) OVER (PARTITION BY entity ORDER BY date) END - 1.0 AS pct
         FROM enr_wide WHERE avg_price IS NOT NULL),
per AS (SELECT entity, stddev_samp(pct) * 100.0 AS volatility, avg(shock_total) AS avg_exposure FROM sb GROUP BY entity)
SELECT entity, {z6('volatility')} AS volatility, {z6('avg_exposure')} AS avg_exposure,
       CASE WHEN volatility >= (SELECT quantile_cont(volatility, 0.5) FROM per) THEN 'Sensitive' ELSE 'Resilient' END AS category
FROM per""",
})


ORACLES.update({
    "unpivot_long": with_(PN) + "\n" + " UNION ALL ".join(
        f"SELECT entity, date, '{m}' AS metric, {z6(m)} AS value FROM pn_wide" for m in NMAP),
    "pivot_first": with_(PN) + f"\nSELECT {PN_WIDE_COLS} FROM pn_wide",
})
