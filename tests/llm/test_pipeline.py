import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from test_plans_and_oracles import TABLES, _digest
from tidepanel.llm import order_minhash, pii, rules
from tidepanel.llm.oracles import ORACLES
from tidepanel.llm.queries import REGISTRY
from conftest import SF, SF2


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_queries_against_sql(spark, key):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, res = REGISTRY[key](spark, SF), con.execute(ORACLES[key])
    assert sorted(df.columns) == sorted(d[0] for d in res.description)
    assert _digest(df.columns, [tuple(r) for r in df.collect()]) == _digest([d[0] for d in res.description], res.fetchall())


def test_every_operator_has_a_query():
    assert {int(k[2:].split("_")[0]) for k in REGISTRY} == set(range(1, 14))


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet").cache()
    cols = docs.columns
    steps = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "tokens"]

    good = steps["quality"](spark, docs, SF2)
    model = rules.fit_quality(docs, spark.read.parquet(f"{SF2}/labels.parquet"))
    want = {r["doc_id"] for r in rules.score_quality(docs, model).filter("predicted = 1").collect()}
    assert good.columns == cols and {r["doc_id"] for r in good.collect()} == want and len(want) < docs.count()

    once = steps["near_duplicates"](spark, good, SF2)
    classes = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicate_classes(good).collect()}
    assert once.columns == cols and sorted(r["doc_id"] for r in once.collect()) == sorted(set(classes.values()))

    clean = steps["personal_data"](spark, once, SF2).cache()
    texts = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == cols and all(not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in texts.values())
    before = {r["doc_id"]: r["text"] for r in once.collect()}
    assert all(texts[d]["text"] == t for d, t in before.items() if not pii.TRIGGER.search(t))

    mixed = steps["mixing"](spark, clean, SF2)
    assert mixed.columns == cols and {r["doc_id"] for r in mixed.collect()} == set(texts)

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in steps["tokens"](spark, clean.limit(60), SF2).collect():
        assert r["ids"] == lib.encode(texts[r["doc_id"]]["text"], add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])


def test_run(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids"] and out.count() > 100


def test_stages_on_edge_rows(spark, tmp_path):
    rows = [(1, None, "en", None, None), (2, "", "en", "a", 0), (3, "some words here", None, "a", 15), (3, "some words here", None, "a", 15), (None, "x@y.zz", "en", "b", 6)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    sf = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    out = {r["doc_id"]: r["n_tokens"] for r in P.run(spark, sf).collect()}
    assert set(out) == {1, 3, None} and out[1] == 0
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    assert P.run(spark, empty).collect() == []


def test_columns_of_any_name_come_through(spark):
    """Dots, backticks and the operators' own working names: each stage hands the values on unchanged."""
    odd = ["x.y", "a`b", "_q_n", "_q_text", "_q_upper", "_q_score", "score", "predicted", "_omh_text", "_omh_d", "mix_epoch", "mix_weight", "_mix_s", "t", "col0_", "h"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wide = docs.select("*", *[spark_lit(i, c) for i, c in enumerate(odd)])
    for name, stage in P.STAGES:
        out = stage(spark, wide, SF)
        rows = out.limit(40).collect()
        assert rows and (out.columns == wide.columns if name != "tokens" else out.columns[:-2] == [c for c in wide.columns if c != "text"]), name
        assert all(r[c] == f"{i}:{r['doc_id']}" for r in rows for i, c in enumerate(odd)), name


def spark_lit(i, name):
    from pyspark.sql import functions as F
    return F.concat(F.lit(f"{i}:"), F.col("doc_id").cast("string")).alias(name)
