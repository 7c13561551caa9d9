"""Sharding: a two-pass external shuffle of whole records.

Pass 1 scatters the records uniformly into buckets by a seeded hash of the record and its row number,
and writes them to a bucketed table in the shared folder: one file per partition, the buckets in it
one after another (64 MB each, until the session's most files of a bucketed table are reached; beyond
that files grow). The number of buckets follows from the records' bytes and rows, so that a bucket
holds about ``BUCKET_BYTES`` and at most some ``BUCKET_ROWS`` records; a task holds only the buckets
that are open. Pass 2 reads each bucket where it lies – without another exchange –, puts its records
in the order of their hash and applies a Fisher-Yates shuffle with draws from the seed, the bucket and
the step (the inside-out form: step i puts record i at a random place j <= i and moves the record
there to the end). A record's global position is its bucket's first position plus its place.

Law ``rows``: position p goes to shard p mod n, slot p div n, so that shards' counts differ by at
most one and slots have no gaps. First positions are running sums of bucket counts, within groups of
``GROUP`` buckets and over the groups, so no window sees all buckets.

Everything is SQL expressions, aggregates and windows. Copies of a text, equal ids and null ids
spread evenly, since the row number takes part in the hash; it is fixed by the table that pass 1
writes before anything depends on it.

Defined results: null texts have size 8 and the checksum of no bytes (0); repeated rows are records of
their own; an empty table gives no rows; fewer records than shards leave the last shards empty; extra
columns of any type travel with the record.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import scratch_path, stored, whole_row

BUCKET_BYTES = 1 << 20
BUCKET_ROWS = 1_000
GROUP = 4_096
FILE_ROWS = 100_000     # records of a shard that are written one after another


def record_size(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 8


def _fisher_yates(n: Column, seed: int, bucket: Column) -> Column:
    """A random permutation of 0..n-1 as an array, drawn from the seed, the bucket and each step."""
    start = F.array().cast("array<int>")

    def step(acc: Column, i: Column) -> Column:
        j = F.pmod(F.xxhash64(F.lit(seed), bucket, i), i + 1).cast("int")
        return F.when(j == i, F.concat(acc, F.array(i))).otherwise(
            F.concat(F.slice(acc, F.lit(1), j), F.array(i), F.slice(acc, j + 2, i - j - 1), F.array(F.get(acc, j))))

    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), start, step)).otherwise(start)


def shuffled(docs: DataFrame, seed: int = 42, bucket_bytes: int = BUCKET_BYTES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """All records as ``_row`` with their random global position ``_position`` (0 to n-1)."""
    spark = docs.sparkSession
    rows, size = docs.agg(F.count("*"), F.sum(record_size())).first()
    buckets = max(-(-rows // bucket_rows), -(-(size or 0) // bucket_bytes), 1)
    files = min(buckets, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // (64 << 20))),
                int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets")))

    scatter = docs.select(whole_row(docs), F.monotonically_increasing_id().alias("_number"))
    scatter = scatter.withColumn("_key", F.xxhash64(F.lit(seed), "_number", "_row.doc_id"))
    scatter = scatter.withColumn("_bucket", F.pmod(F.xxhash64("_key", F.lit(seed)), F.lit(buckets)))
    name = f"scatter_{uuid.uuid4().hex}"
    (scatter.repartition(files, "_bucket").sortWithinPartitions("_bucket").write
     .bucketBy(files, "_bucket").sortBy("_bucket").option("path", scratch_path(spark, name)).saveAsTable(name))
    scatter = spark.table(name)
    spark.sql(f"DROP TABLE {name}")          # the files stay, the plan has their place and buckets

    count = scatter.groupBy("_bucket").agg(F.count("*").alias("n")).withColumn("_group", F.floor(F.col("_bucket") / GROUP))
    groups = count.groupBy("_group").agg(F.sum("n").alias("n"))
    ahead = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("_group", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_ahead"))
    within = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = count.select("_group", "_bucket", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("_in"))
    first = stored(first.join(groups, "_group").select("_bucket", (F.col("_ahead") + F.col("_in")).alias("_first")), "shard-first")

    held = scatter.groupBy("_bucket").agg(F.collect_list(F.struct("_key", "_number", "_row")).alias("_records"))
    held = held.join(first, "_bucket")
    # records need not be comparable: their places are sorted; the one-element array binds the sorted
    # list to a name so that it is built once
    order = F.sort_array(F.transform("_records", lambda r, i: F.struct(r["_key"], r["_number"], i.alias("i"))))
    places = _fisher_yates(F.size("_records"), seed, F.col("_bucket"))
    held = held.select("_first", F.get(F.transform(F.array(order), lambda o: F.transform(
        places, lambda j: F.get("_records", F.get(o, j)["i"])["_row"])), F.lit(0)).alias("_shuffled"))
    # (the outer form keeps the optimiser from evaluating the shuffle once more in a filter)
    return held.select((F.posexplode_outer("_shuffled").alias("_at", "_row")), "_first").select(
        "_row", (F.col("_first") + F.col("_at")).alias("_position"))


def sharded(docs: DataFrame, shards: int = 24, seed: int = 42) -> DataFrame:
    """Every record with law, shard and slot; its own columns unchanged (a clashing name gives way)."""
    out = shuffled(docs, seed).select("_row", F.lit("rows").alias("law"),
                                      (F.col("_position") % shards).cast("int").alias("shard"),
                                      F.expr(f"_position div {shards}").alias("slot"))
    own = [c for c in docs.columns if c not in ("law", "shard", "slot")]
    return out.select(*[F.col("_row").getField(c).alias(c) for c in own], "law", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = 24, seed: int = 42, file_rows: int = FILE_ROWS) -> None:
    """Writes the records as Parquet below ``path``, one folder per shard. Each run of ``file_rows`` slots
    of a shard goes to a task by its hash, so a shard has many writers; files are in slot order."""
    out = sharded(docs, shards, seed)
    out = out.repartition("shard", F.floor(F.col("slot") / file_rows)).sortWithinPartitions("shard", "slot")
    out.write.partitionBy("shard").parquet(path)
