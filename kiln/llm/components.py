"""Connected components by alternating star contractions, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import stored


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) of longs -> (node, component) for every node that has an edge; the
    component is the smallest node. Each round links every node's larger neighbours to its
    smallest one, then its smaller ones likewise, until nothing changes. Minima are combined
    before the shuffle and hubs are joined back by a join that adaptive execution can split."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e = stored(e, "cc-start")
    seen = None
    for i in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        e = small.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        e = stored(e.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), f"cc-{i}")
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if seen == tuple(state):
            break
        seen = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    tops = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)
