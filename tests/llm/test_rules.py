import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.llm import rules
from conftest import SF2


def test_column_equals_the_model(spark):
    rng = np.random.default_rng(1)
    x = rng.random((600, len(rules.FEATURES)))
    y = ((x[:, 3] > 0.5) & (x[:, 5] < 0.7)).astype(float)
    m = rules.fit_rules(x, y)
    assert 0 < len(m.rules) < 100
    z = m.bias + sum(w * rules.holds(r, x) for r, w in zip(m.rules, m.weights))
    want = 1 / (1 + np.exp(-z))
    assert ((want > 0.5) == (y > 0)).mean() > 0.97
    df = spark.createDataFrame([[float(v) for v in r] for r in x], [f"_q_{f}" for f in rules.FEATURES])
    assert np.allclose(sorted(r[0] for r in df.select(m.column()).collect()), sorted(want))


def test_enough_rules_for_many_statistics():
    rng = np.random.default_rng(0)
    x = rng.random((4000, len(rules.FEATURES)))
    s = sum(np.sin(5 * x[:, j] + j) for j in range(8))
    y = (s > np.median(s)).astype(float)
    m = rules.fit_rules(x[:2000], y[:2000])
    z = m.bias + sum(w * rules.holds(r, x[2000:]) for r, w in zip(m.rules, m.weights))
    assert ((z > 0) == (y[2000:] > 0)).mean() > 0.905  # 20 trees and a penalty of 3e-3: 0.8945


def test_lasso_drops_noise():
    rng = np.random.default_rng(0)
    m = rng.normal(size=(500, 20)).astype(np.float32)
    y = (m[:, 0] > 0).astype(np.float32)
    _, w = rules.lasso_logistic(m, y, 0.05)
    assert w[0] > 0.3 and (np.abs(w[1:]) < 1e-6).sum() >= 17


def test_held_out_accuracy_and_no_labels_among_inputs(spark):
    docs, labels = spark.read.parquet(f"{SF2}/documents.parquet"), spark.read.parquet(f"{SF2}/labels.parquet")
    model = rules.fit_quality(docs, labels)
    got = rules.score_quality(docs.select("doc_id", "text"), model).join(labels, "doc_id").toPandas()
    held = got[[zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id]]
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.95
    # flipping the labels of the held-out fold changes nothing
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rules.fit_quality(docs, flipped) == model


def test_edge_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (2, "", 5), (None, "word " * 30000, 5), (4, "THE!! " * 20, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = rules.fit_quality(docs, labels)
    got = rules.score_quality(docs, model).collect()
    assert len(got) == 5 and all(r["score"] == 0.5 and r["predicted"] == 0 for r in got)
    assert rules.score_quality(docs.limit(0), model).collect() == []
    f = {r["doc_id"]: r for r in rules.with_features(docs).collect()}
    assert f[1]["_q_upper"] == 0 and f[4]["_q_exclaims"] == 2 and f[4]["_q_repeated"] == pytest.approx(19 / 20)
    assert f[None]["_q_distinct"] == pytest.approx(1 / 30000)
