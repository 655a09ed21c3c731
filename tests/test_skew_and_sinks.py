"""Skew handling claims and the sinks."""
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidepanel.operators.clean import dedupe_keep_first
from tidepanel.operators.quantile import global_rank
from tidepanel.sources.sinks import column_dictionary, dataset_metadata, sink_long


def test_hot_group_is_split_across_partitions(spark):
    rng = np.random.default_rng(0)
    n = 20000
    g = np.where(np.arange(n) % 3 == 0, "cold", "hot")          # the hot key holds 2/3 of the rows
    pdf = pd.DataFrame({"g": g, "v": rng.normal(size=n)})
    # at this size AQE would rightly merge everything into one partition;
    # switch coalescing off to see the split a large hot group gets
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = global_rank(spark.createDataFrame(pdf), ["g"], "v").withColumn("pid", F.spark_partition_id())
        parts = ranked.where("g = 'hot'").select("pid").distinct().count()
        pr = ranked.toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts > 1                                             # no single task sorts the hot group
    # ranks are a permutation 0..n_g-1 per group, in value order
    for key, grp in pr.groupby("g"):
        assert sorted(grp._rank) == list(range(len(grp)))
        assert (grp.sort_values("_rank").v.diff().dropna() >= 0).all()


def test_dedupe_hot_key_keeps_first(spark):
    rows = [("k", i % 50, float(i)) for i in range(5000)] + [("j", 1, 7.0)]
    df = spark.createDataFrame(rows, "k string, o int, x double")
    out = {r.k: (r.o, r.x) for r in dedupe_keep_first(df, ["k"], ["o", "x"]).collect()}
    assert out == {"k": (0, 0.0), "j": (1, 7.0)}


def test_sink_long_roundtrip_and_metadata(spark, tmp_path):
    rows = [("a", "2020-01-31", "m1", 1.0), ("a", "2020-02-29", "m1", 2.0), ("b", "2020-01-31", "m2", 3.0)]
    long = spark.createDataFrame(rows, "entity string, date string, metric string, value double") \
        .withColumn("date", F.to_date("date"))
    path = str(tmp_path / "long")
    sink_long(long, path)
    back = spark.read.parquet(path)
    assert sorted((r.entity, str(r.date), r.metric, r.value) for r in back.collect()) == \
        sorted((e, d, m, v) for e, d, m, v in rows)
    assert sorted(p.name for p in (tmp_path / "long").iterdir() if p.name.startswith("metric=")) == ["metric=m1", "metric=m2"]
    meta = dataset_metadata(long).first()
    assert (meta.n_entities, meta.n_periods, meta.n_obs, meta.panel_type) == (2, 2, 3, "unbalanced")
    d = {r.column: r for r in column_dictionary(long, "t", ["entity", "date"]).collect()}
    assert d["value"].n_distinct == 3 and d["value"].min == 1.0 and d["entity"].role == "key"
    approx = {r.column: r for r in column_dictionary(long, "t", approx_distinct=True).collect()}
    assert approx["value"].n_distinct == 3
