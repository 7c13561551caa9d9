from __future__ import annotations

import collections

from helpers import awkward, corpus, empty
from pyspark.sql import functions as F

from kiln.llm import sharding as sh


def test_law_slots_and_whole_records(spark):
    df = awkward(spark, corpus())
    got = sh.sharded(df, shards=24)
    rows = got.collect()
    key = lambda r: repr((r["doc_id"], r["text"], r["lang"], r["source"], r["kept"]))
    assert collections.Counter(map(key, rows)) == collections.Counter(map(key, df.collect()))
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    sizes = [len(slots.get(i, [])) for i in range(24)]
    assert max(sizes) - min(sizes) <= 1
    assert sh.sharded(empty(spark)).count() == 0


def test_equal_seeds_repeat_and_others_differ(spark):
    df = spark.createDataFrame(corpus(), "doc_id long, text string").coalesce(1)
    order = lambda seed, **k: [r[0] for r in sh.shuffled(df, seed, **k).orderBy("_position").select("_row.doc_id").collect()]
    assert order(1, bucket_rows=7) == order(1, bucket_rows=7) != order(2, bucket_rows=7)
    assert sorted(order(3, bucket_rows=7)) == list(range(60))


def test_fisher_yates_permutes_evenly(spark):
    places = spark.range(4000).select(sh._fisher_yates(F.lit(4), 9, F.col("id")).alias("p"))
    seen = collections.Counter(tuple(r["p"]) for r in places.collect())
    assert len(seen) == 24 and all(sorted(p) == [0, 1, 2, 3] for p in seen)
    assert min(seen.values()) > 100


def test_written_shards(spark, tmp_path):
    sh.write_shards(spark.createDataFrame(corpus(), "doc_id long, text string"), str(tmp_path / "out"), shards=5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 60 and back.select("shard").distinct().count() == 5


def test_several_writers_of_a_shard_keep_slot_order(spark, tmp_path):
    path = str(tmp_path / "out")
    sh.write_shards(spark.createDataFrame(corpus(), "doc_id long, text string"), path, shards=2, file_rows=5)
    back = spark.read.parquet(path).withColumn("file", F.input_file_name()).withColumn("at", F.col("_metadata.row_index"))
    rows = back.select("shard", "slot", "file", "at").collect()
    assert {(r["shard"], r["slot"]) for r in rows} == {(s, i) for s in (0, 1) for i in range(30)}
    files = collections.defaultdict(list)
    for r in rows:
        files[r["file"]].append((r["at"], r["slot"]))
    assert all([slot for _, slot in sorted(f)] == sorted(slot for _, slot in f) for f in files.values())


def test_columns_that_cannot_be_compared_and_few_bucket_files(spark):
    df = awkward(spark, corpus()).withColumn("meta", F.create_map(F.lit("k"), F.col("lang")))
    spark.conf.set("spark.sql.sources.bucketing.maxBuckets", "3")
    try:
        tables = len(spark.catalog.listTables())
        got = sh.shuffled(df, bucket_rows=4).select("_position", "_row.doc_id", "_row.meta").collect()
        assert len(spark.catalog.listTables()) == tables
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.maxBuckets")
    assert sorted(r["_position"] for r in got) == list(range(70))
    assert all(set(r["meta"]) == {"k"} for r in got)
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r["doc_id"] for r in df.collect())
