from __future__ import annotations

import random
import re

import pandas as pd
from helpers import awkward, corpus, empty
from pyspark.sql import functions as F
from test_parity_join import shingles

import corpus_pipeline as cp
from kiln.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_another(spark, tmp_path):
    docs, seen = table(spark, SF, "documents"), {}
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        seen[name] = docs.toPandas()
        if k < len(cp.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    names = list(seen)
    assert all(set(seen[b].doc_id) <= set(seen[a].doc_id) for a, b in zip(names, names[1:], strict=False))
    bench = [" ".join(re.findall(r"\w+", t.lower())) for t in pd.read_parquet(f"{SF}/benchmark.parquet").text]
    clean = seen["benchmark decontamination"]
    assert not any(b in " ".join(re.findall(r"\w+", t.lower())) for t in clean.text for b in bench)
    masked = seen["secret scans"]
    assert set(masked.doc_id) == set(clean.doc_id) and not masked.text.str.contains(r"[0-9a-f]{24,}").any()
    assert set(seen["packing"].doc_id) == set(masked.doc_id)
    direct = cp.run(spark, SF).toPandas()
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, direct[cols].to_numpy())) == sorted(map(tuple, seen["packing"][cols].to_numpy()))


def _rows(df):
    return sorted((repr(tuple(r)) for r in df.collect()))


def _linked(a, b):
    both = len(a & b)
    return bool(a and b) and 100 * both >= 75 * (len(a) + len(b) - both)


def test_jaccard_stage_matches_brute_force(spark):
    """Repeated and null ids with copies, near copies and texts of their own; repeated rows."""
    rng = random.Random(21)
    rows = corpus(seed=21, n=48)
    texts = [t for _, t in rows]
    own = lambda k: " ".join(f"own{k}x{rng.randrange(10**6)}" for _ in range(70))
    rows += [(3, own(1)), (7, own(2)), (None, own(3)), (None, own(3)), (None, texts[0]), (None, texts[9]), (60, texts[12]), (60, own(4)),
             (60, texts[12]), (61, own(5)), (61, own(5) + " tail")]
    df = awkward(spark, rows).withColumn("meta", F.create_map(F.lit("k"), F.col("lang")))
    have = [tuple(r) for r in df.collect()]
    sets, group = [shingles(r[1]) for r in have], list(range(len(have)))
    for i in range(len(have)):
        for j in range(i):
            if group[i] != group[j] and _linked(sets[i], sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    want, order = [], lambda r: (r[0] is None, r[0] or 0)
    for g in set(group):
        mine = [r for r, h, s in zip(have, group, sets, strict=True) if h == g and s]
        want.append({(r[0], r[1]) for r in mine if order(r) == min(map(order, mine))})
    got = cp.jaccard_join(spark, df, SF)
    assert got.dtypes == df.dtypes
    got = [tuple(r) for r in got.collect()]
    worded = [r for r in got if shingles(r[1])]
    assert len(worded) == sum(map(bool, want)) and len(got) - len(worded) == sum(not s for s in sets)
    for stays in filter(None, want):                     # one row, of the smallest id
        assert sum((r[0], r[1]) in stays for r in worded) == 1
    assert all(r in have for r in got)


def test_decontamination_stage_judges_rows_with_repeated_and_null_ids(spark, tmp_path):
    rng = random.Random(5)
    plain = [" ".join(f"p{rng.randrange(4000)}" for _ in range(120)) for _ in range(40)]
    items = [" ".join(f"q{k}b{rng.randrange(10**6)}" for _ in range(14)) for k in range(6)]
    spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = list(enumerate(plain))
    rows += [(1, f"{plain[1]} {items[0]} {plain[2]}"), (None, f"{items[1]} {plain[3]}"), (None, plain[4] + " end"), (90, items[2]), (90, items[2]), (91, plain[5])]
    df = awkward(spark, rows)
    got = cp.benchmark_decontamination(spark, df, str(tmp_path))
    assert got.dtypes == df.dtypes
    assert _rows(got) == sorted(repr(tuple(r)) for r in df.collect() if not any(i in (r["text"] or "") for i in items))


def test_empty_table_gives_no_rows(spark):
    for _, stage in cp.STAGES:
        assert stage(spark, empty(spark), SF).count() == 0
