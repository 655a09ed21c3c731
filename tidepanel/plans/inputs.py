"""Panels derived from the driver tables, playing the reference's roles.

* order panels: entity (nation / market segment / customer) x month-end,
  metrics from orders and lineitem — the housing panel's role;
* the yearly shock table from returned lineitems — the annual exposure role;
* the events panel: event type x day, balanced.

All of them are plain aggregations over the whole tables, so their work
grows with the data.  Lineitem is pre-aggregated per order before it meets
orders (one partial aggregate, keyed like the join), and dimension tables
are broadcast only behind a row-count check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from ..operators.reshape import unpivot_long

ORDER_METRICS = ("avg_price", "order_count", "avg_qty", "avg_extprice", "urgent_price")
EVENT_METRICS = ("n_events", "avg_value", "n_users", "max_value")
SHOCK_METRICS = ("shock_count", "shock_max_price", "shock_min_discount", "shock_total")
# Shock role: returned items, by ship year.
SHOCK_FLAG = "R"
URGENT = "1-URGENT"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders_with_entity(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
    if entity == "customer":
        return orders.select("*", F.col("o_custkey").cast("string").alias("entity"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    o = orders.join(cust, orders.o_custkey == cust.c_custkey)
    if entity == "segment":
        return o.withColumn("entity", F.col("c_mktsegment"))
    nation = broadcast_if_small(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), 10_000)
    return o.join(nation, o.c_nationkey == nation.n_nationkey).withColumn("entity", F.col("n_name"))


def order_panel_wide(spark: SparkSession, sf_dir: str, entity: str = "nation") -> DataFrame:
    """(entity, date, avg_price, order_count, avg_qty, avg_extprice, urgent_price).

    ``date`` is the month-end of the order date.  ``urgent_price`` only
    exists in months with an urgent order, so it carries real gaps.
    Built once per session (see ``materialize``).
    """
    from .materialize import materialized
    return materialized(spark, ("order_panel", sf_dir, entity),
                        lambda: _order_panel_wide(spark, sf_dir, entity))


def _order_panel_wide(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    o = _orders_with_entity(spark, sf_dir, entity).withColumn(
        "date", F.last_day(F.to_date("o_orderdate")))
    li = (table(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.sum("l_quantity").alias("sq"), F.sum("l_extendedprice").alias("se"),
               F.count(F.lit(1)).alias("nl")))
    joined = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    return (joined.groupBy("entity", "date")
            .agg(F.avg("o_totalprice").alias("avg_price"),
                 F.count(F.lit(1)).cast("double").alias("order_count"),
                 F.try_divide(F.sum("sq"), F.sum("nl")).alias("avg_qty"),
                 F.try_divide(F.sum("se"), F.sum("nl")).alias("avg_extprice"),
                 F.avg(F.when(F.col("o_orderpriority") == URGENT, F.col("o_totalprice"))).alias("urgent_price")))


def order_panel_long(spark: SparkSession, sf_dir: str, entity: str = "nation") -> DataFrame:
    """Long ``(entity, date, metric, value)``; missing cells are absent rows."""
    wide = order_panel_wide(spark, sf_dir, entity)
    return unpivot_long(wide, ["entity", "date"], list(ORDER_METRICS), drop_nulls=True)


def events_panel_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event type x day, balanced: (entity, date, n_events, avg_value, n_users, max_value)."""
    from .materialize import materialized
    return materialized(spark, ("events_panel", sf_dir), lambda: _events_panel_wide(spark, sf_dir))


def _events_panel_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev.groupBy(F.col("event_type").alias("entity"), F.to_date("ts").alias("date"))
            .agg(F.count(F.lit(1)).cast("double").alias("n_events"),
                 F.avg("value").alias("avg_value"),
                 F.count_distinct("user_id").cast("double").alias("n_users"),
                 F.max("value").alias("max_value")))


def shock_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual exposure role: per ship year, count / max / min / total (millions)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.where(F.col("l_returnflag") == SHOCK_FLAG)
            .groupBy(F.year("l_shipdate").alias("year"))
            .agg(F.count(F.lit(1)).cast("double").alias("shock_count"),
                 F.max("l_extendedprice").alias("shock_max_price"),
                 F.min("l_discount").alias("shock_min_discount"),
                 (F.sum("l_extendedprice") / F.lit(1e6)).alias("shock_total")))


# ---------------------------------------------------------------------------
# Text, JSON, names and geo derived from the tables (rules, not samples).
# Every order is a "storm": a header line, then one detail line per lineitem.
# Rules put the format's edge cases into the text: sentinel wind/pressure,
# southern/eastern hemispheres, a bad latitude, a short line and a bad date.
# ---------------------------------------------------------------------------
LINE_SLOTS = 64         # positions per order: header and its lines


def _detail_fields() -> dict:
    l_ = F.col
    date = F.when(l_("l_linenumber") == 6,
                  F.concat(F.year("l_shipdate").cast("string"), F.lit("1345"))) \
        .otherwise(F.date_format("l_shipdate", "yyyyMMdd"))
    lat_txt = F.concat(F.pmod(l_("l_partkey"), F.lit(60)).cast("string"), F.lit("."),
                       F.pmod(l_("l_suppkey"), F.lit(10)).cast("string"))
    lat = F.when((l_("l_linenumber") == 5) & (F.pmod(l_("l_partkey"), F.lit(3)) == 0),
                 F.concat(F.lit("?"), lat_txt, F.lit("N"))) \
        .otherwise(F.concat(lat_txt, F.when(F.pmod(l_("l_partkey"), F.lit(5)) != 0, F.lit("N"))
                            .otherwise(F.lit("S"))))
    lon = F.concat(F.pmod(l_("l_suppkey"), F.lit(100)).cast("string"), F.lit("."),
                   F.pmod(l_("l_partkey"), F.lit(10)).cast("string"),
                   F.when(F.pmod(l_("l_suppkey"), F.lit(4)) != 0, F.lit("W")).otherwise(F.lit("E")))
    wind = (F.when(l_("l_quantity") < 3, F.lit("-99")).when(l_("l_quantity") < 5, F.lit(""))
            .when(l_("l_quantity") < 6, F.lit("x"))
            .otherwise((l_("l_quantity") * 3).cast("int").cast("string")))
    pres = F.when(l_("l_discount") == 0, F.lit("-999")) \
        .otherwise((F.lit(1010) - (l_("l_discount") * 100).cast("int")).cast("string"))
    return {"date": date,
            "time": F.lpad((l_("l_linenumber") * 100).cast("string"), 4, "0"),
            "record_id": F.when(l_("l_returnflag") == "R", F.lit("L")).otherwise(F.lit("")),
            "status": l_("l_linestatus"), "lat": lat, "lon": lon, "wind": wind, "pressure": pres}


def padded(key):
    """The key with leading zeros to 8 digits; longer keys stay whole."""
    text = key.cast("string")
    return F.when(F.length(text) < 8, F.lpad(text, 8, "0")).otherwise(text)


ORDERS_PER_FILE = 1 << 15   # order keys per generated text file
LINES_PER_TASK = 1 << 19    # detail lines that a task sorts into files, on average


def track_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, pos, line): header/detail text for every order.

    Files hold consecutive order-key ranges and go by the range's number, so a
    detail line finds its file from its own order key (no join back to orders)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    oc = o.join(c, o.o_custkey == c.c_custkey)

    def file_of(key):
        return F.floor(key / F.lit(ORDERS_PER_FILE))

    head = oc.select(file_of(F.col("o_orderkey")).alias("file"), (F.col("o_orderkey") * LINE_SLOTS).alias("pos"),
                     F.concat(F.lit("AL"), padded(F.col("o_orderkey")), F.lit(", "),
                              F.col("c_name"), F.lit(", "), F.year("o_orderdate").cast("string"),
                              F.lit(",")).alias("line"))
    li = table(spark, sf_dir, "lineitem")
    f = _detail_fields()
    full = F.concat_ws(", ", *[f[k] for k in ("date", "time", "record_id", "status", "lat", "lon", "wind", "pressure")])
    short = F.concat_ws(", ", *[f[k] for k in ("date", "time", "record_id", "status", "lat", "lon")])
    det = li.select(file_of(F.col("l_orderkey")).alias("file"),
                    (F.col("l_orderkey") * LINE_SLOTS + F.col("l_linenumber")).alias("pos"),
                    F.when(F.col("l_linenumber") == 7, short).otherwise(full).alias("line"))
    return head.unionByName(det)


def track_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track points read back from text files (built once per session)."""
    from ..session import scratch_path
    from ..sources.text import parse_header_detail, read_lines
    from .materialize import materialized

    def build() -> DataFrame:
        path = scratch_path(spark, "tracks")
        lines = track_lines(spark, sf_dir).select("file", "pos", "line")
        # a file's lines go to one task, in order; the tasks grow in number with the lines, so none sorts more than fits
        tasks = 1 + table(spark, sf_dir, "lineitem").count() // LINES_PER_TASK
        (lines.repartition(tasks, "file").sortWithinPartitions("file", "pos").select("file", F.col("line").alias("value"))
         .write.partitionBy("file").text(path))
        return parse_header_detail(read_lines(spark, path), in_order=True)
    return materialized(spark, ("track_points", sf_dir), build)


def event_documents(spark: SparkSession, sf_dir: str, per_doc: int = 64) -> DataFrame:
    """JSON documents ``{"data": [...]}``, each holding at most ``per_doc``
    consecutive events (bounded documents; null fields are omitted)."""
    ev = table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyyMMdd").cast("long")
    rec = F.struct(F.col("event_type").alias("name"),
                   F.when(F.col("event_id") % 13 == 0, F.floor(day / 100)).otherwise(day).alias("begDate"),
                   day.alias("endDate"),
                   F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("adjCost"),
                   F.get_json_object("props", "$.k").cast("int").alias("deaths"))
    return (ev.groupBy(F.floor(F.col("event_id") / per_doc).alias("doc"))
            .agg(F.to_json(F.struct(F.collect_list(rec).alias("data"))).alias("json")))


NAME_PREFIX_RULE = ("Hurricane ", "Tropical Storm ", "")


def named_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per customer and ship year of returned items: a labelled event
    (prefix by rule + customer name + '(year)'), cost and count."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == SHOCK_FLAG)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == F.col("c_custkey"))
    g = j.groupBy("c_custkey", "c_name", F.year("l_shipdate").alias("year")).agg(
        F.sum("l_extendedprice").alias("cost"), F.count(F.lit(1)).alias("deaths"))
    k = F.pmod(F.col("c_custkey"), F.lit(3))
    prefix = F.when(k == 0, F.lit(NAME_PREFIX_RULE[0])).when(k == 1, F.lit(NAME_PREFIX_RULE[1])).otherwise(F.lit(""))
    return g.select(F.concat(prefix, F.col("c_name"), F.lit(" ("), F.col("year").cast("string"), F.lit(")")).alias("event_name"),
                    "year", "cost", "deaths")


# Fixed reference point and radius of the geo filter (the coast role).
REF_LAT, REF_LON, MAX_NM = 27.8, -81.7, 600.0
