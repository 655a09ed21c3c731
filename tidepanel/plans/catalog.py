"""Registered queries: one Spark plan per operator key of the survey.

Each entry is ``(spark, sf_dir) -> DataFrame`` over the whole driver
tables.  Floating outputs are rounded half-even to 6 decimals (the oracle
does the same with ``round_even``) so engines that sum in a different
order still agree.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as _np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import aggregates as A
from ..operators import clean as C
from ..operators import forecast as FC
from ..operators import joins as J
from ..operators import learn as ML
from ..operators import linear as L
from ..operators import reshape as R
from ..operators import series as SE
from ..operators import windows as W
from ..operators.quantile import global_rank
from ..session import scratch_path
from ..sources import long as SL
from ..sources import nested as SN
from ..sources import sinks as SK
from ..sources import wide as SW
from .inputs import (MAX_NM, ORDER_METRICS, REF_LAT, REF_LON, SHOCK_METRICS, event_documents,
                     events_panel_wide, named_events, order_panel_long, order_panel_wide, padded,
                     shock_by_year, table, track_points)
from .panels import (MODEL_CONTROLS, MODEL_Y, enriched_wide, exposure_rows, model_frame,
                     shock_annual_long)

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# Values exactly on a half unit of the 6th decimal are common here (cents
# divided by powers of two), and engines that sum in another order land an ulp
# either side of them.  Rounding to 9 places first puts both on the same side
# and changes no published digit of a value that is not within 5e-10 of a tie.
def six_places(c: Column, scale: int = 6) -> Column:
    nine, unit = F.rint(c.cast("double") * F.lit(1e9)) / F.lit(1e9), F.lit(10.0 ** scale)
    return F.rint(nine * unit) / unit


def r6(c) -> Column:
    return six_places(F.col(c) if isinstance(c, str) else c)


def round_doubles(df: DataFrame, scale: int = 6) -> DataFrame:
    """Round every DOUBLE column half-even (output hygiene for comparison)."""
    return df.select(*[six_places(F.col(f.name), scale).alias(f.name)
                       if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                       for f in df.schema.fields])


PROFILE_COLS = ("avg_price", "order_count", "urgent_price", "shock_count", "shock_total")


@register("entity_profile")
def q_entity_profile(spark: SparkSession, d: str) -> DataFrame:
    """Flagship: segment panel -> winsorize -> balance -> + yearly shock ->
    pivot -> per-entity profile (1 decimal)."""
    wide = enriched_wide(spark, d, "segment")
    return A.entity_profile(wide, PROFILE_COLS)


# ---------------------------------------------------------------------------
# shared sub-plans
# ---------------------------------------------------------------------------

EXCLUDE_START, EXCLUDE_END = "1997-03-01", "1997-05-31"
YEAR_LO, YEAR_HI = 1996, 2000


def pn_wide(spark, d):
    return order_panel_wide(spark, d, "nation")


def pn_long(spark, d):
    return order_panel_long(spark, d, "nation")


def state_series(spark, d, metric="avg_price"):
    """Cross-entity mean per date (the state-average role)."""
    return A.period_mean(pn_wide(spark, d).where(F.col(metric).isNotNull()), ["date"], [metric]) \
        .withColumnRenamed(f"{metric}_mean", "value")


def order_years(spark, d):
    """Calendar scaffold: the years of the orders and one more at either end, quiet if nothing was returned in them."""
    span = table(spark, d, "orders").agg(F.min(F.year("o_orderdate")).alias("lo"), F.max(F.year("o_orderdate")).alias("hi"))
    return span.select(F.explode(F.sequence(F.col("lo") - 1, F.col("hi") + 1)).alias("year"))


def located_points(spark, d):
    tp = track_points(spark, d)
    return tp.withColumn("dist", S.haversine_nm("lat", "lon", F.lit(REF_LAT), F.lit(REF_LON))) \
        .withColumn("yr", F.substring("date", 1, 4).cast("int")) \
        .withColumn("in_range", F.col("yr").between(YEAR_LO, YEAR_HI))


# ---------------------------------------------------------------------------
# 2.1 scans, sources, sinks
# ---------------------------------------------------------------------------
@register("scan_wide_dates")
def q_scan_wide_dates(spark, d):
    """Every order metric as wide CSV files (a row per entity, a column per month, each file with the months it has)
    and back by one text scan of all of them."""
    path = scratch_path(spark, "wide")
    wide_csv_lines(pn_long(spark, d)).repartition("metric", "part").sortWithinPartitions("metric", "part", "at") \
        .select("metric", "part", "line").write.partitionBy("metric", "part").text(path)
    return SW.read_wide_files(spark, path).withColumn("value", r6("value"))


def wide_csv_lines(long):
    """(metric, part, at, line): the lines of wide CSV files, one file a metric and part of the entities; the header comes first."""
    spark = long.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = long.withColumn("part", F.pmod(F.xxhash64("entity"), F.lit(parts)).cast("int"))
    heads = rows.groupBy("metric", "part").agg(F.sort_array(F.collect_set("date")).alias("dates"))  # the calendar of a file

    def quoted(c):
        return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))

    cells = (rows.groupBy("metric", "part", "entity").agg(F.map_from_entries(F.collect_list(F.struct("date", F.col("value").cast("string")))).alias("m"))
             .join(heads, ["metric", "part"])
             .select("metric", "part", F.lit(1).alias("at"), F.concat_ws(",", quoted(F.col("entity")), F.lit("nation"), F.transform(
                 "dates", lambda t: F.coalesce(F.try_element_at("m", t), F.lit("")))).alias("line")))
    return cells.unionByName(heads.select("metric", "part", F.lit(0).alias("at"), F.concat_ws(
        ",", F.lit("RegionName"), F.lit("RegionType"), F.transform("dates", lambda t: t.cast("string"))).alias("line")))


@register("scan_header_detail")
def q_scan_header_detail(spark, d):
    return round_doubles(track_points(spark, d))


@register("scan_nested_json")
def q_scan_nested_json(spark, d):
    path = scratch_path(spark, "event-documents")
    event_documents(spark, d).select("json").write.text(path)
    return round_doubles(SN.read_nested_json(spark, path, one_per_line=True))


@register("scan_typed_long")
def q_scan_typed_long(spark, d):
    text = pn_long(spark, d).select(F.col("entity"), F.date_format("date", "yyyy-MM-dd").alias("date"),
                                    "metric", F.col("value").cast("string").alias("value"))
    path = scratch_path(spark, "typed-long")
    text.write.option("header", True).csv(path)
    return SL.read_typed_long(spark, path).withColumn("value", r6("value"))


@register("schema_contract")
def q_schema_contract(spark, d):
    return round_doubles(SL.schema_contract(pn_wide(spark, d), ["entity", "date", "avg_price"],
                                            ["urgent_price", "median_price"], "nation panel"))


@register("sink_long")
def q_sink_long(spark, d):
    path = scratch_path(spark, "sink_long")
    SK.sink_long(pn_long(spark, d), path)
    back = spark.read.parquet(path)
    return back.select("entity", "date", "metric", r6("value").alias("value"))


@register("sink_long_csv")
def q_sink_long_csv(spark, d):
    """The sorted CSV and its alias, published together and read back by name: each row with its place in the file order."""
    root = scratch_path(spark, "published")
    SK.publish_long(pn_long(spark, d).select("entity", "date", "metric", "value"), root, "master", "panel", ["entity", "date", "metric"])
    out = None
    for name in ("master", "panel"):
        back = SK.read_published(spark, root, name).withColumn("_at", F.struct("_file", "_place"))
        ranked = global_rank(back, [], "_at")
        part = ranked.select(F.lit(name).alias("name"), F.col("_rank").alias("row_no"), "entity", "date", "metric", r6("value").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


@register("dataset_metadata")
def q_dataset_metadata(spark, d):
    return SK.dataset_metadata(pn_long(spark, d))


@register("column_dictionary")
def q_column_dictionary(spark, d):
    return round_doubles(SK.column_dictionary(pn_wide(spark, d), "nation_panel", ["entity", "date"]))


# ---------------------------------------------------------------------------
# 2.2 projections, filters, cleaning
# ---------------------------------------------------------------------------
@register("filter_equality_and")
def q_filter_equality_and(spark, d):
    li = table(spark, d, "lineitem")
    return C.filter_equality_and(li, {"l_returnflag": "R", "l_linestatus": "F"}) \
        .select("l_orderkey", "l_linenumber", "l_extendedprice")


def doc_lines(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@register("drop_empty_key")
def q_drop_empty_key(spark, d):
    """Whole documents split into lines; blank lines dropped; lines kept per doc."""
    kept = C.drop_empty_key(doc_lines(spark, d), "line")
    return kept.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"),
                                      F.sum(F.length("line")).alias("n_chars"))


@register("tolerant_cast")
def q_tolerant_cast(spark, d):
    w = pn_wide(spark, d).select("entity", "date", F.coalesce(F.col("urgent_price").cast("string"),
                                                              F.lit("n/a")).alias("urgent_price"))
    return C.tolerant_cast(w, "urgent_price").withColumn("urgent_price", r6("urgent_price"))


@register("sentinel_to_null")
def q_sentinel_to_null(spark, d):
    tp = track_points(spark, d)
    return tp.groupBy("storm_id").agg(F.count("max_wind").alias("n_wind"), F.count("min_pressure").alias("n_pressure"),
                                      F.max("max_wind").alias("max_wind"), F.min("min_pressure").alias("min_pressure"),
                                      F.count(F.lit(1)).alias("n_points"))


@register("signed_coordinate")
def q_signed_coordinate(spark, d):
    tp = track_points(spark, d)
    return tp.groupBy("storm_id").agg(r6(F.min("lat")).alias("min_lat"), r6(F.max("lat")).alias("max_lat"),
                                      r6(F.min("lon")).alias("min_lon"), r6(F.max("lon")).alias("max_lon"))


@register("parse_date_coerce")
def q_parse_date_coerce(spark, d):
    tp = track_points(spark, d).select("storm_id", "time", "date")
    return C.parse_date_coerce(tp, "date", "yyyyMMdd")


@register("drop_null_measure")
def q_drop_null_measure(spark, d):
    with_nulls = R.unpivot_long(pn_wide(spark, d), ["entity", "date"], list(ORDER_METRICS))
    return C.drop_null_measure(with_nulls).withColumn("value", r6("value"))


@register("complete_cases")
def q_complete_cases(spark, d):
    return round_doubles(C.complete_cases(pn_wide(spark, d), ["avg_price", "urgent_price"]))


@register("filter_year_range")
def q_filter_year_range(spark, d):
    return C.filter_year_range(pn_long(spark, d), "date", YEAR_LO, YEAR_HI).withColumn("value", r6("value"))


@register("exclude_window")
def q_exclude_window(spark, d):
    return C.exclude_window(pn_long(spark, d), "date", EXCLUDE_START, EXCLUDE_END).withColumn("value", r6("value"))


@register("project_rename_drop")
def q_project_rename_drop(spark, d):
    out = C.project_rename_drop(pn_wide(spark, d), rename={"entity": "region", "date": "period",
                                                          "order_count": "orders"}, drop=["avg_qty", "avg_extprice"])
    return round_doubles(out)


@register("zero_fill")
def q_zero_fill(spark, d):
    return round_doubles(C.zero_fill(pn_wide(spark, d), ["urgent_price"]))


@register("winsorize")
def q_winsorize(spark, d):
    return C.winsorize(pn_long(spark, d), flag="clipped").withColumn("value", r6("value"))


@register("cleaning_audit")
def q_cleaning_audit(spark, d):
    raw = R.unpivot_long(pn_wide(spark, d), ["entity", "date"], list(ORDER_METRICS))
    return round_doubles(C.audited_clean(raw, ["entity", "date", "metric"], ["value"])[1])


@register("cleaning_audit_orders")
def q_cleaning_audit_orders(spark, d):
    """The audit of order-level observations, where keys repeat: of a nation, month and metric the first order stays."""
    o = (table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
         .select(F.col("c_nationkey").alias("entity"), F.last_day("o_orderdate").alias("date"), "o_orderkey",
                 F.col("o_totalprice").alias("price"), F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).alias("urgent")))
    raw = R.unpivot_long(o, ["entity", "date", "o_orderkey"], ["price", "urgent"])
    clean, audit = C.audited_clean(raw, ["entity", "date", "metric"], ["o_orderkey"])
    total = clean.agg(F.sum("o_orderkey").alias("keys_kept"), F.avg("value").alias("mean_kept"))
    return round_doubles(J.attach_scalar(audit, total))


@register("key_not_null_check")
def q_key_not_null_check(spark, d):
    return C.key_not_null_check(pn_long(spark, d), ["entity", "date"]).withColumn("value", r6("value"))


@register("threshold_category")
def q_threshold_category(spark, d):
    per = A.period_mean(pn_wide(spark, d), ["entity"], ["avg_price"])
    return C.threshold_category(per, "avg_price_mean").withColumn("avg_price_mean", r6("avg_price_mean"))


# ---------------------------------------------------------------------------
# 2.3 joins
# ---------------------------------------------------------------------------
@register("join_name_year")
def q_join_name_year(spark, d):
    storms = track_points(spark, d).select("storm_id", "storm_name").distinct() \
        .join(table(spark, d, "orders").select(F.concat(F.lit("AL"), padded(F.col("o_orderkey"))).alias("storm_id"),
                                               F.year("o_orderdate").alias("year")), ["storm_id"])
    ev = named_events(spark, d).withColumn("event_key", S.normalize_event_name("event_name"))
    out = J.join_name_year(storms, ev, "storm_name", "event_key", "year", ["event_name", "cost", "deaths"])
    return out.withColumn("cost", r6("cost"))


@register("left_join_zero")
def q_left_join_zero(spark, d):
    return round_doubles(J.left_join_zero(order_years(spark, d), shock_by_year(spark, d), ["year"], list(SHOCK_METRICS)))


@register("scaffold_left_join")
def q_scaffold_left_join(spark, d):
    return shock_annual_long(spark, d, order_years(spark, d)).withColumn("value", r6("value"))


@register("cross_scaffold")
def q_cross_scaffold(spark, d):
    return J.cross_scaffold(order_years(spark, d), list(SHOCK_METRICS))


@register("expand_period")
def q_expand_period(spark, d):
    long = pn_long(spark, d)
    years = long.select(F.year("date").alias("year")).distinct()
    return exposure_rows(long, shock_annual_long(spark, d, years)).withColumn("value", r6("value"))


@register("balanced_semi_join")
def q_balanced_semi_join(spark, d):
    return J.balanced_semi_join(pn_long(spark, d)).withColumn("value", r6("value"))


@register("balanced_dates")
def q_balanced_dates(spark, d):
    return J.balanced_dates(pn_long(spark, d))


@register("subsample_semi_join")
def q_subsample_semi_join(spark, d):
    long = pn_long(spark, d)
    wide = pn_wide(spark, d)
    groups = A.grouped_median_split(wide, "entity", "avg_price").where(F.col("group") == "high")
    return J.subsample_semi_join(long, groups).withColumn("value", r6("value"))


# Fixed event list of the event study: a plain date, one half-way between two
# month-ends (a tie), and one with no data within 24 months.
EVENTS = (("e1_1999_02", "1999-02-01"), ("e2_tie_1997_06", "1997-06-15"), ("e3_empty_2010", "2010-01-01"))


def event_table(spark):
    return spark.createDataFrame([(k, v) for k, v in EVENTS], "event string, event_date string") \
        .withColumn("event_date", F.to_date("event_date"))


@register("range_join_window")
def q_range_join_window(spark, d):
    win = J.range_join_window(state_series(spark, d), event_table(spark))
    return win.select("event", "date", r6("value").alias("value"))


@register("nearest_asof")
def q_nearest_asof(spark, d):
    win = J.range_join_window(state_series(spark, d), event_table(spark))
    return J.nearest_asof(win, "value").withColumn("base_value", r6("base_value"))


@register("nearest_asof_orders")
def q_nearest_asof_orders(spark, d):
    """Each order with its nation's average price at the month end nearest to it."""
    o = (table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
         .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
         .select(F.col("o_orderkey").alias("event"), F.col("n_name").alias("entity"), F.to_date("o_orderdate").alias("event_date")))
    near = J.asof_merge(o, pn_wide(spark, d).select("entity", "date", F.col("avg_price").alias("value")), ["entity"], max_days=10)
    return near.select("event", "event_date", r6("base_value").alias("base_value"), "base_date")


# ---------------------------------------------------------------------------
# 2.4 aggregations
# ---------------------------------------------------------------------------
def qualifying_points(spark, d):
    return A.min_distance_qualify(located_points(spark, d), "storm_id", "dist", MAX_NM, "in_range")


def storms(spark, d):
    pts = qualifying_points(spark, d).withColumn("_order", F.struct("date", "time")) \
        .withColumn("landfall", F.col("record_id") == "L")
    return A.storm_summary(pts, "storm_id", "_order", "storm_name", "yr", "max_wind", "min_pressure",
                           "landfall", "dist", "in_range")


@register("min_distance_qualify")
def q_min_distance_qualify(spark, d):
    return qualifying_points(spark, d).select("storm_id", "date", "time", r6("dist").alias("dist"))


@register("storm_summary")
def q_storm_summary(spark, d):
    return storms(spark, d)


@register("annual_exposure")
def q_annual_exposure(spark, d):
    return A.annual_exposure(storms(spark, d), "year", {"max_wind": ("max", "max_wind"),
                                                        "min_pressure": ("min", "min_pressure"),
                                                        "closest_distance": ("min", "closest_distance")})


@register("annual_cost")
def q_annual_cost(spark, d):
    ev = named_events(spark, d).withColumn("cost_m", F.col("cost") / 1e6)
    return round_doubles(A.annual_sum(ev, "year", {"total_cost_m": "cost_m", "total_deaths": "deaths"}))


@register("haversine")
def q_haversine(spark, d):
    c = table(spark, d, "customer")
    lat = (F.pmod(F.col("c_custkey") * 7, F.lit(181)) - 90).cast("double")
    lon = (F.pmod(F.col("c_custkey") * 13, F.lit(361)) - 180).cast("double")
    return c.select("c_custkey", r6(S.haversine_nm(lat, lon, F.lit(REF_LAT), F.lit(REF_LON))).alias("dist_nm"))


@register("panel_shape")
def q_panel_shape(spark, d):
    return A.panel_shape(pn_long(spark, d))


@register("metric_profile")
def q_metric_profile(spark, d):
    long = R.unpivot_long(pn_wide(spark, d), ["entity", "date"], list(ORDER_METRICS))
    return round_doubles(A.metric_profile(long))


@register("describe_columns")
def q_describe_columns(spark, d):
    return round_doubles(A.describe_columns(pn_wide(spark, d), list(ORDER_METRICS)))


@register("period_mean")
def q_period_mean(spark, d):
    w = pn_wide(spark, d).withColumn("year", F.year("date"))
    return A.period_mean(w, ["year"], list(ORDER_METRICS), decimals=1)


@register("missing_pct")
def q_missing_pct(spark, d):
    return round_doubles(A.missing_pct(pn_wide(spark, d), list(ORDER_METRICS)))


@register("grouped_median_split")
def q_grouped_median_split(spark, d):
    return round_doubles(A.grouped_median_split(pn_wide(spark, d), "entity", "avg_price"))


@register("corr_matrix")
def q_corr_matrix(spark, d):
    return A.corr_matrix(pn_wide(spark, d), list(ORDER_METRICS)).withColumn("r", r6("r"))


@register("pairwise_corr")
def q_pairwise_corr(spark, d):
    return A.pairwise_corr(pn_wide(spark, d), "avg_price", "urgent_price", ["entity"]).withColumn("r", r6("r"))


@register("linear_fit")
def q_linear_fit(spark, d):
    return round_doubles(A.linear_fit(pn_wide(spark, d), "avg_extprice", "avg_qty", ["entity"]))


@register("fit_line_grid")
def q_fit_line_grid(spark, d):
    fits = A.linear_fit(pn_wide(spark, d), "avg_extprice", "avg_qty", ["entity"])
    return round_doubles(A.fit_line_grid(fits, 100, ["entity"]))


@register("time_range_total")
def q_time_range_total(spark, d):
    return round_doubles(A.time_range_total(pn_wide(spark, d), "date", "order_count"))


@register("time_quantile_split")
def q_time_quantile_split(spark, d):
    return A.time_quantile_split(pn_long(spark, d), "date", 0.8).select("entity", "date", "metric", "split")


# ---------------------------------------------------------------------------
# 2.5 windows (over nation x month panel cells)
# ---------------------------------------------------------------------------


@register("dedupe_keep_first")
def q_dedupe_keep_first(spark, d):
    li = table(spark, d, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    order = [c for c in li.columns if c not in keys]
    return round_doubles(C.dedupe_keep_first(li, keys, order))


@register("log_diff")
def q_log_diff(spark, d):
    return W.log_diff(pn_wide(spark, d), "avg_price", "price_growth").select("entity", "date", r6("price_growth").alias("price_growth"))


@register("pct_change")
def q_pct_change(spark, d):
    out = W.pct_change(pn_wide(spark, d), "urgent_price", "urgent_growth")
    return out.select("entity", "date", r6("urgent_growth").alias("urgent_growth"))


@register("lag_features")
def q_lag_features(spark, d):
    out = W.lag_features(pn_wide(spark, d), "order_count", [1, 2, 3])
    return out.select("entity", "date", "order_count_l1", "order_count_l2", "order_count_l3")


@register("lead_features")
def q_lead_features(spark, d):
    out = W.lead_features(pn_wide(spark, d), "avg_price", list(range(13)))
    return round_doubles(out.select("entity", "date", *[f"avg_price_f{k}" for k in range(13)]))


@register("interaction_feature")
def q_interaction_feature(spark, d):
    w = W.lag_features(pn_wide(spark, d), "order_count", [1]).withColumn("qty_log", S.safe_ln("avg_qty"))
    out = W.interaction_feature(w, "order_count_l1", "qty_log", "count_x_qty_l1")
    return out.select("entity", "date", r6("count_x_qty_l1").alias("count_x_qty_l1"))


@register("ffill_limit")
def q_ffill_limit(spark, d):
    out = W.ffill_limit(pn_wide(spark, d), "urgent_price", 3, out="urgent_filled")
    return out.select("entity", "date", r6("urgent_filled").alias("urgent_filled"))


@register("centered_ma")
def q_centered_ma(spark, d):
    out = W.centered_ma(pn_wide(spark, d), "avg_price", "trend")
    return out.select("entity", "date", r6("trend").alias("trend"))


@register("normalize_to_base")
def q_normalize_to_base(spark, d):
    from ..operators.series import event_study
    es = event_study(state_series(spark, d), event_table(spark), "value")
    return es.select("event", "date", r6("normalized").alias("normalized"))


@register("relative_month")
def q_relative_month(spark, d):
    win = J.range_join_window(state_series(spark, d), event_table(spark))
    return win.select("event", "date", W.relative_month("date", "event_date").alias("rel_month"))


# ---------------------------------------------------------------------------
# 2.6 sorts, limits, top-k, set operations
# ---------------------------------------------------------------------------
@register("sort_keys")
def q_sort_keys(spark, d):
    return R.sort_keys(pn_long(spark, d), ["entity", "date", "metric"]).withColumn("value", r6("value"))


@register("head_n")
def q_head_n(spark, d):
    return R.head_n(pn_long(spark, d), ["entity", "date", "metric"], 10).withColumn("value", r6("value"))


@register("topk_by_count")
def q_topk_by_count(spark, d):
    return R.topk_by_count(pn_wide(spark, d), "entity", "urgent_price", 3)


@register("rank_by_measure")
def q_rank_by_measure(spark, d):
    vol = pn_wide(spark, d).groupBy("entity").agg(r6(F.stddev_samp("avg_price")).alias("price_std"))
    return R.rank_by_measure(vol, "price_std", "entity")


@register("union_all_long")
def q_union_all_long(spark, d):
    long = pn_long(spark, d)
    years = long.select(F.year("date").alias("year")).distinct()
    return R.union_all_long(long, exposure_rows(long, shock_annual_long(spark, d, years))).withColumn("value", r6("value"))


@register("distinct_keys")
def q_distinct_keys(spark, d):
    return R.distinct_keys(pn_long(spark, d), ["entity", "date"])


# ---------------------------------------------------------------------------
# 2.7 scalar functions
# ---------------------------------------------------------------------------
@register("normalize_event_name")
def q_normalize_event_name(spark, d):
    ev = named_events(spark, d)
    return ev.select("event_name", "year", S.normalize_event_name("event_name").alias("name_key"))


@register("upper_trim_key")
def q_upper_trim_key(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", S.upper_trim(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("name_key"))


@register("short_name")
def q_short_name(spark, d):
    c = table(spark, d, "customer")
    full = F.concat(F.col("c_name"), F.lit("-"), F.col("c_mktsegment"), F.lit(", "), F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", full.alias("full_name"), S.short_name(full).alias("short_name"))


@register("slug")
def q_slug(spark, d):
    p = table(spark, d, "part")
    label = F.concat(F.col("p_name"), F.lit(". "), F.col("p_type"))
    return p.select("p_partkey", S.slug(label).alias("slug"))


@register("date_parts")
def q_date_parts(spark, d):
    o = table(spark, d, "orders")
    parts = S.date_parts("o_orderdate")
    return o.select("o_orderkey", *[v.alias(k) for k, v in parts.items()])


@register("unit_round")
def q_unit_round(spark, d):
    s = shock_by_year(spark, d)
    return s.select("year", S.millions_to_billions(F.col("shock_total") * 1000.0).alias("total_billion"),
                    S.round_half_even("shock_max_price", 1).alias("max_price_1dp"))


@register("log_transform")
def q_log_transform(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", r6(S.safe_ln("l_discount")).alias("ln_discount"))


@register("sig_stars")
def q_sig_stars(spark, d):
    li = table(spark, d, "lineitem")
    return li.groupBy(S.sig_stars("l_discount").alias("stars")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# 2.8 analytics: linear models
# ---------------------------------------------------------------------------


E_Y, E_X = "avg_value", "n_events"


def _e_fit(spark, d):
    return L.fe_twoway(events_panel_wide(spark, d), E_Y, [E_X])


def _num(v):
    return None if v is None or not _np.isfinite(v) else float(v)


@register("fe_twoway")
def q_fe_twoway(spark, d):
    f = _e_fit(spark, d)
    rows = [(n, _num(f.coef[j]), f.nobs, f.n_entities, f.n_periods, f.df_resid) for j, n in enumerate(f.names)]
    return round_doubles(spark.createDataFrame(rows, "variable string, coef double, nobs long, n_entities long, "
                                                     "n_periods long, df_resid long"))


@register("fe_unadjusted_se")
def q_fe_unadjusted_se(spark, d):
    f = _e_fit(spark, d)
    rows = [(n, _num(f.coef[j]), _num(f.se[j])) for j, n in enumerate(f.names)]
    return round_doubles(spark.createDataFrame(rows, "variable string, coef double, se double"))


@register("fe_clustered_se")
def q_fe_clustered_se(spark, d):
    f = _e_fit(spark, d)
    rows = [(n, _num(f.coef[j]), _num(f.se_clustered[j])) for j, n in enumerate(f.names)]
    return round_doubles(spark.createDataFrame(rows, "variable string, coef double, se_clustered double"))


@register("fe_fit_stats")
def q_fe_fit_stats(spark, d):
    f = _e_fit(spark, d)
    return round_doubles(spark.createDataFrame([(f.nobs, f.df_resid, _num(f.r2), _num(f.r2_within), _num(f.r2_within_adj))],
                                               "nobs long, df_resid long, r2 double, r2_within double, r2_within_adj double"))


@register("resid_fitted")
def q_resid_fitted(spark, d):
    f = _e_fit(spark, d)
    return round_doubles(f.frame.select("entity", "date", "resid", "fitted"))


def _ols_table(spark, fit):
    rows = [(n, _num(c), _num(s)) for n, c, s in zip(fit.names, fit.coef, fit.se)]
    return spark.createDataFrame(rows, "variable string, coef double, se double")


@register("pooled_ols")
def q_pooled_ols(spark, d):
    fit = L.pooled_ols(pn_wide(spark, d), "avg_price", ["avg_qty", "avg_extprice"])
    t = _ols_table(spark, fit).select("variable", "coef")
    return round_doubles(t.withColumn("r2", F.lit(float(fit.r2))).withColumn("nobs", F.lit(fit.nobs).cast("long")))


BP_REGRESSORS = ("avg_qty", "avg_extprice", "order_count", "urgent_price")


@register("breusch_pagan")
def q_breusch_pagan(spark, d):
    """LM and F statistics with their p-values, on four regressors."""
    bp = L.breusch_pagan(pn_wide(spark, d), "avg_price", BP_REGRESSORS)
    cols = ("lm", "lm_pvalue", "f", "f_pvalue")
    return round_doubles(spark.createDataFrame([(*[float(bp[c]) for c in cols], int(bp["nobs"]))],
                                               ", ".join(f"{c} double" for c in cols) + ", nobs long"))


@register("vif")
def q_vif(spark, d):
    return round_doubles(spark.createDataFrame(L.vif(pn_wide(spark, d), ["avg_qty", "avg_extprice"]),
                                               "variable string, vif double"))


@register("qq_points")
def q_qq_points(spark, d):
    f = L.fe_twoway(model_frame(spark, d), MODEL_Y, ["drv_l1", *MODEL_CONTROLS])
    return L.qq_points(f.frame, "resid")


ROBUST_CHECKS = (
    ("clustered_vs_unadjusted_se", "drv_l1", None),
    ("alternative_lag", "drv_l1", None),
    ("alternative_lag", "drv_l2", None),
    ("alternative_lag", "drv_l3", None),
    ("exclude_window", "drv_l1", "exclude"),
    ("subsample_high", "drv_l1", "high"),
    ("subsample_low", "drv_l1", "low"),
)


def robustness_rows(spark, d):
    """Every spec is a subsample (and driver lag) of the model frame;
    the specs are stacked with a spec column and fitted together, so the
    whole sweep shares one set of passes.  Unadjusted and clustered errors
    come out of the same fit."""
    mf = model_frame(spark, d)   # materialised once, read by every spec
    split = A.grouped_median_split(pn_wide(spark, d), "entity", "avg_qty")
    specs = {}
    for check, drv, variant in ROBUST_CHECKS:
        specs.setdefault((drv, variant), f"s{len(specs)}")
    parts = []
    for (drv, variant), sid in specs.items():
        frame = mf
        if variant == "exclude":
            frame = C.exclude_window(mf, "date", EXCLUDE_START, EXCLUDE_END)
        elif variant in ("high", "low"):
            frame = J.subsample_semi_join(mf, split.where(F.col("group") == variant))
        parts.append(frame.select(F.lit(sid).alias("spec"), "entity", "date", MODEL_Y,
                                  F.col(drv).alias("driver"), *MODEL_CONTROLS))
    fits = L.fe_twoway_specs(R.union_all_long(*parts), MODEL_Y, ["driver", *MODEL_CONTROLS], "spec")
    out = []
    for check, drv, variant in ROBUST_CHECKS:
        f = fits[specs[(drv, variant)]]
        out.append((check, drv, _num(f.coef[0]), _num(f.se[0]), _num(f.coef[0]), _num(f.se_clustered[0]),
                    _num(f.pvalue_clustered[0]), f.nobs))
    return out


@register("robustness_sweep")
def q_robustness_sweep(spark, d):
    return spark.createDataFrame(robustness_rows(spark, d),
                                 "check string, driver string, coef_unadjusted double, se_unadjusted double, "
                                 "coef_clustered double, se_clustered double, pvalue_clustered double, nobs long")


@register("regression_table")
def q_regression_table(spark, d):
    """A row per variable, and coefficient / SE / p-value / stars of each
    model beside each other; N and adjusted within R^2 as rows."""
    mf = model_frame(spark, d)
    xs = ["drv_l1", *MODEL_CONTROLS]
    stacked = R.union_all_long(
        mf.select(F.lit("base").alias("spec"), "entity", "date", MODEL_Y, *xs),
        C.exclude_window(mf, "date", EXCLUDE_START, EXCLUDE_END)
        .select(F.lit("exclude_window").alias("spec"), "entity", "date", MODEL_Y, *xs))
    fits = L.fe_twoway_specs(stacked, MODEL_Y, xs, "spec")
    rows = []
    for name in ("base", "exclude_window"):
        f = fits[name]
        for label, se, p in (("unadjusted", f.se, f.pvalue), ("clustered", f.se_clustered, f.pvalue_clustered)):
            if name == "exclude_window" and label == "unadjusted":
                continue
            m = f"{name}_{label}"
            for j, v in enumerate(f.names):
                rows.append((m, v, _num(f.coef[j]), _num(se[j]), _num(p[j])))
            rows.append((m, "N", float(f.nobs), None, None))
            rows.append((m, "adj_within_r2", _num(f.r2_within_adj), None, None))
    return L.models_side_by_side(spark.createDataFrame(rows, "model string, variable string, coef double, se double, pvalue double"),
                                 ["base_unadjusted", "base_clustered", "exclude_window_clustered"], [*xs, "N", "adj_within_r2"])


# ---------------------------------------------------------------------------
# 2.8 analytics: tests and forecasts over many series
# ---------------------------------------------------------------------------

HOLDOUT = 12


def growth_series(spark, d):
    """(series, date, y): monthly log growth of avg_price per nation, plus
    the cross-nation mean growth as series 'ALL' (the state-mean role)."""
    g = W.log_diff(pn_wide(spark, d), "avg_price", "y").where(F.col("y").isNotNull())
    per = g.select(F.col("entity").alias("series"), "date", "y")
    allm = g.groupBy("date").agg(F.avg("y").alias("y")).select(F.lit("ALL").alias("series"), "date", "y")
    return per.unionByName(allm)


@register("adf_stat")
def q_adf_stat(spark, d):
    return FC.adf_test(growth_series(spark, d), "series", "date", "y")


@register("grouped_forecast")
def q_grouped_forecast(spark, d):
    return FC.grouped_forecast(growth_series(spark, d), "series", "date", "y", HOLDOUT)


@register("naive_forecast")
def q_naive_forecast(spark, d):
    return round_doubles(FC.naive_forecast(growth_series(spark, d), "series", "date", "y", HOLDOUT))


@register("forecast_eval")
def q_forecast_eval(spark, d):
    nv = FC.naive_forecast(growth_series(spark, d), "series", "date", "y", HOLDOUT)
    return round_doubles(FC.forecast_eval(nv, "actual", "naive", ["series"]).withColumnRenamed("rmse", "rmse_naive"))


@register("forecast_scores")
def q_forecast_scores(spark, d):
    """Model against naive over the holdout (the other half of M15)."""
    return FC.forecast_scores(growth_series(spark, d), "series", "date", "y", HOLDOUT)


# ---------------------------------------------------------------------------
# 2.8 analytics: learning
# ---------------------------------------------------------------------------

ML_FEATURES = ("ext_growth", "qty_log", "count_growth", "drv_l1", "shock_total_l1")


def _ml_frame(spark, d):
    """Complete rows of the model features (materialised once per session)."""
    from .materialize import materialized
    return materialized(spark, ("ml_frame", d),
                        lambda: model_frame(spark, d).select("date", MODEL_Y, *ML_FEATURES).dropna())


_FORESTS: dict = {}


def _forest(spark, d):
    """The forest fitted on the model frame's time split, once per session
    (forest_regression, feature_importance and ml_compare share it)."""
    from ..session import session_key
    key = (session_key(spark), d)
    if key not in _FORESTS:
        train, test = ML.time_split(_ml_frame(spark, d), MODEL_Y, ML_FEATURES)
        _FORESTS[key] = (ML.forest_regression(train, MODEL_Y, ML_FEATURES) if train.limit(1).count() else None, test)
    return _FORESTS[key]


@register("forest_regression")
def q_forest_regression(spark, d):
    """Forest predictions on the test split (time-ordered 80/20)."""
    from pyspark.ml.feature import VectorAssembler
    model, test = _forest(spark, d)
    if model is None:  # nothing to learn from, nothing to predict
        return test.select("date", F.col(MODEL_Y).alias("actual"), F.lit(None).cast("double").alias("predicted"))
    vec = VectorAssembler(inputCols=list(ML_FEATURES), outputCol="_features").transform(test)
    return model.transform(vec).select("date", F.col(MODEL_Y).alias("actual"), F.col("_pred").alias("predicted"))


@register("feature_importance")
def q_feature_importance(spark, d):
    model, _ = _forest(spark, d)
    return spark.createDataFrame([] if model is None else ML.feature_importance(model, ML_FEATURES), "feature string, importance double")


@register("ml_compare")
def q_ml_compare(spark, d):
    model = _forest(spark, d)[0]
    rows = [] if model is None else ML.ml_compare(_ml_frame(spark, d), MODEL_Y, ML_FEATURES, model=model)[0]
    return spark.createDataFrame(rows, "model string, r2 double, rmse double, n_train long, n_test long")


# ---------------------------------------------------------------------------
# 2.8 analytics: series (decomposition, event study, cross-correlation, segments)
# ---------------------------------------------------------------------------


@register("regular_series")
def q_regular_series(spark, d):
    return SE.regular_series(pn_wide(spark, d), "urgent_price").withColumn("urgent_price", r6("urgent_price"))


@register("seasonal_decompose")
def q_seasonal_decompose(spark, d):
    reg = SE.regular_series(pn_wide(spark, d), "avg_price")
    return round_doubles(SE.seasonal_decompose(reg, "avg_price"))


@register("event_study")
def q_event_study(spark, d):
    return round_doubles(SE.event_study(state_series(spark, d), event_table(spark), "value"))


@register("cross_correlation")
def q_cross_correlation(spark, d):
    wide = enriched_wide(spark, d, "nation")
    return round_doubles(SE.cross_correlation(wide, "shock_total", "avg_price", 12))


@register("segmentation")
def q_segmentation(spark, d):
    wide = enriched_wide(spark, d, "nation")
    return round_doubles(SE.segmentation(wide, "avg_price", "shock_total"))


# ---------------------------------------------------------------------------
# reshape keys
# ---------------------------------------------------------------------------
@register("unpivot_long")
def q_unpivot_long(spark, d):
    """Wide -> long keeping NULL cells (melt)."""
    out = R.unpivot_long(pn_wide(spark, d), ["entity", "date"], list(ORDER_METRICS))
    return out.withColumn("value", r6("value"))


@register("pivot_first")
def q_pivot_first(spark, d):
    """Long -> wide, first non-null value per (entity, date, metric)."""
    return round_doubles(R.pivot_first(pn_long(spark, d), ["entity", "date"], list(ORDER_METRICS)))
