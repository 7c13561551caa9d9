from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from helpers import awkward, empty

from kiln.llm import additive_model as m
from kiln.llm.q07 import op7_quality_classifier

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op7_quality_classifier(spark, SF).toPandas()
    docs, labels = (pd.read_parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    assert sorted(got.doc_id) == sorted(docs.doc_id) and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    x = got[got.held_out].merge(labels, on="doc_id")
    assert (x.predicted == x.quality).mean() > 0.95


def test_tables_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = m.AdditiveModel().fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9
    assert {0, 1} in [set(p[:2]) for p in model.pairs]


def test_edge_rows(spark):
    labels = spark.createDataFrame([(9002, 1), (9003, 0), (9003, 1), (9005, None), (None, 1)], "doc_id long, quality int")
    got = m.quality_scores(awkward(spark), labels).collect()
    assert len(got) == 10 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    none = m.quality_scores(awkward(spark), labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert m.quality_scores(empty(spark), labels).count() == 0
