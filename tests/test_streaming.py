"""Incremental wide-file ingest: two triggers over new files, same results as batch."""
from tidepanel.streaming import stream_wide_ingest, wide_schema

HEADER = "RegionID,SizeRank,RegionName,RegionType,StateName,2020-01-31,2020-02-29\n"


def test_stream_ingest_two_batches(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text(HEADER + "1,1,Alpha,msa,FL,100,110\n2,2,Beta,msa,FL,abc,200\n")
    schema = wide_schema(["2020-01-31", "2020-02-29"])
    sink, ckpt = str(tmp_path / "long"), str(tmp_path / "ckpt")
    q = stream_wide_ingest(spark, str(src), "price_index", schema, sink, ckpt, filters={"StateName": "FL"})
    q.awaitTermination(120)
    first = spark.read.parquet(sink)
    assert sorted((r.entity, str(r.date), r.value) for r in first.collect()) == [
        ("Alpha", "2020-01-31", 100.0), ("Alpha", "2020-02-29", 110.0), ("Beta", "2020-02-29", 200.0)]
    (src / "b.csv").write_text(HEADER + "3,3,Gamma,msa,FL,5,\n4,4,Delta,msa,GA,7,8\n")
    q = stream_wide_ingest(spark, str(src), "price_index", schema, sink, ckpt, filters={"StateName": "FL"})
    q.awaitTermination(120)
    allrows = spark.read.parquet(sink)
    assert allrows.count() == 4 and allrows.where("entity = 'Gamma'").first().value == 5.0
    assert allrows.select("epoch").distinct().count() == 2
