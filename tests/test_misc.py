"""Small paths: stacked wide files with a metric column; cluster sizing."""
from tidepanel.session import cluster_conf
from tidepanel.sources.wide import wide_to_long


def test_wide_to_long_metric_from_column(spark):
    rows = [("A", "msa", "zhvi_like", "1", "2"), ("A", "msa", "rent_like", "3", None), ("", "msa", "x", "5", "6")]
    df = spark.createDataFrame(rows, "RegionName string, RegionType string, metric string, "
                                     "`2020-01-31` string, `2020-02-29` string")
    got = sorted((r.entity, str(r.date), r.metric, r.value) for r in wide_to_long(df, metric_col="metric").collect())
    assert got == [("A", "2020-01-31", "rent_like", 3.0), ("A", "2020-01-31", "zhvi_like", 1.0),
                   ("A", "2020-02-29", "zhvi_like", 2.0)]


def test_cluster_conf_sizes_partitions():
    c = cluster_conf(100 * 2 ** 40, 4000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(1 << 20, 16)["spark.sql.shuffle.partitions"] == "32"
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
