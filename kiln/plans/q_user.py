"""User-function surface queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from kiln.operators import metrics as M
from kiln.operators.analyze import analyze
from kiln.operators.split import splits_of
from kiln.operators.user import Callback, elementwise, row_parse, run_callbacks, write_routed
from kiln.plans.fixtures import ORDERS_SPLIT_SQL, LAPTOP_RAW_SQL, laptop_raw, orders_split, read
from kiln.plans.q_features import SQLX
from kiln.plans.q_metrics import PROBS_SQL, SINCE_BEST_SQL, history, scored
from kiln.plans.present import rnd
from kiln.plans.registry import query
from kiln.session import scratch_path


# ------------------------------------------------------------------------------ user_preprocess

def orders_fn(i, ctx):
    """A user preprocessing function: z-scored price, priority id, top-50 clerk id."""
    return {"price_z": ctx.zscore(i["o_totalprice"]),
            "priority_id": ctx.vocab(i["o_orderpriority"]),
            "clerk_id": ctx.vocab(i["o_clerk"], top_k=50)}


@query("user_preprocess", "WITH " + ORDERS_SPLIT_SQL + """,
st AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM osplit WHERE split = 'train'),
vp AS (SELECT term, row_number() OVER (ORDER BY cnt DESC, term DESC) - 1 AS id FROM
       (SELECT o_orderpriority AS term, count(*) AS cnt FROM osplit WHERE split = 'train' GROUP BY 1)),
vc AS (SELECT term, row_number() OVER (ORDER BY cnt DESC, term DESC) - 1 AS id FROM
       (SELECT o_clerk AS term, count(*) AS cnt FROM osplit WHERE split = 'train' GROUP BY 1
        ORDER BY cnt DESC, term DESC LIMIT 50))
SELECT o.o_orderkey, round(round((o.o_totalprice - st.m) / st.s, 9), 6) AS price_z, coalesce(vp.id, -1) AS priority_id,
       coalesce(vc.id, -1) AS clerk_id
FROM osplit o CROSS JOIN st LEFT JOIN vp ON o.o_orderpriority = vp.term LEFT JOIN vc ON o.o_clerk = vc.term
WHERE o.split = 'eval'""")
def q_user_preprocess(spark, sf):
    parts = splits_of(orders_split(spark, sf))
    tf = analyze(parts["train"], orders_fn, keep=["o_orderkey"])
    out = tf.apply(parts["eval"])
    return out.select("o_orderkey", rnd("price_z", 6).alias("price_z"), "priority_id", "clerk_id")


# ------------------------------------------------------------------------------ user_row_parse

def split_lines(pdf: pd.DataFrame) -> pd.DataFrame:
    """User row function: one output row per non-blank line of a conversation turn."""
    lines = pdf.assign(line=pdf["text"].fillna("").str.split("\n")).explode("line", ignore_index=True)
    lines["line_no"] = lines.groupby(["conv_id", "turn"], sort=False).cumcount() + 1
    return lines.loc[lines["line"].str.strip(" ") != "", ["conv_id", "turn", "line_no", "line"]]


@query("user_row_parse", """
SELECT conv_id, turn, line_no, line FROM (
  SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
         CAST(generate_subscripts(string_split(text, chr(10)), 1) AS BIGINT) AS line_no FROM conversations)
WHERE trim(line) <> ''""")
def q_user_row_parse(spark, sf):
    conv = read(spark, sf, "conversations").select("conv_id", "turn", "text")
    return row_parse(conv, split_lines, "conv_id long, turn long, line_no long, line string")


# ------------------------------------------------------------------------------ user_elementwise

def storage_udf(memory: pd.Series) -> pd.DataFrame:
    """A user's vectorised storage parser with a declared struct output; null has no parts, so zeros."""
    memory = memory.reset_index(drop=True)
    parts = memory.fillna("").str.lower().str.split(" + ", regex=False).explode()
    size = pd.to_numeric(parts.str.extract(r"([0-9.]+)", expand=False), errors="coerce").fillna(0.0)
    size = size.where(~parts.str.contains("tb", regex=False), size * 1024.0)
    kinds = {f"{k}_gb": size.where(parts.str.contains(k, regex=False), 0.0) for k in ("ssd", "hdd", "flash")}
    return pd.DataFrame(kinds).groupby(level=0).sum().reindex(memory.index, fill_value=0.0)


@query("user_elementwise", "WITH " + LAPTOP_RAW_SQL + f"""
SELECT Unname, {SQLX['ssd']} AS ssd_gb, {SQLX['hdd']} AS hdd_gb, {SQLX['flash']} AS flash_gb FROM laptop""")
def q_user_elementwise(spark, sf):
    f = elementwise(storage_udf, "ssd_gb double, hdd_gb double, flash_gb double")
    return laptop_raw(spark, sf).select("Unname", f("Memory").alias("s")).select("Unname", "s.*")


# ------------------------------------------------------------------------------ user_partition

def price_band(c):
    return F.when(c["o_totalprice"] < 100000, 0).when(c["o_totalprice"] < 250000, 1).otherwise(2)


@query("user_partition", """
SELECT CASE WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice < 250000 THEN 1 ELSE 2 END AS route,
       count(*) AS n, round(round(sum(o_totalprice), 9), 2) AS total FROM orders GROUP BY 1""")
def q_user_partition(spark, sf):
    path = scratch_path(spark, "routed")
    write_routed(read(spark, sf, "orders"), price_band, path)
    return (spark.read.parquet(path).groupBy("route")
            .agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total")))


# ------------------------------------------------------------------------------ user_metric

RMSE_PER_CLASS = M.UserMetric(
    name="rmse",
    state={"sq": lambda: M.onehot_sq_error("probs", "label"), "n": lambda: F.lit(1.0)},
    result=lambda s: F.sqrt(s["sq"] / s["n"]),
)


@query("user_metric", "WITH " + PROBS_SQL + """
SELECT label, round(round(sqrt(sum(power(CASE WHEN j = label THEN 1.0 ELSE 0.0 END - prob, 2)) / count(DISTINCT vec_id)), 9), 6) AS rmse
FROM q GROUP BY label""")
def q_user_metric(spark, sf):
    r = RMSE_PER_CLASS.evaluate(scored(spark, sf), by=["label"])
    return r.select("label", rnd("rmse", 6).alias("rmse"))


AUC = M.auc_metric("prob", "hit", bins=500)


@query("user_metric_auc", "WITH " + PROBS_SQL + """,
b AS (SELECT j, least(CAST(floor(prob * 500) AS BIGINT), 499) AS bin, count(*) FILTER (WHERE j = label) AS p, count(*) FILTER (WHERE j <> label) AS n FROM q GROUP BY 1, 2),
c AS (SELECT *, sum(n) OVER (PARTITION BY j ORDER BY bin) - n / 2 AS below, sum(p) OVER (PARTITION BY j) AS ps, sum(n) OVER (PARTITION BY j) AS ns FROM b)
SELECT CAST(j AS INTEGER) AS class, round(round(sum(p * below) / (any_value(ps) * any_value(ns)), 9), 6) AS auc FROM c GROUP BY j""")
def q_user_metric_auc(spark, sf):
    """A user metric whose state is no sum of columns: two score histograms per class, one class against the rest."""
    rows = scored(spark, sf).select("label", F.posexplode("probs").alias("class", "prob"))
    rows = rows.select("class", "prob", (F.col("class") == F.col("label")).cast("int").alias("hit"))
    return AUC.evaluate(rows, by=["class"]).select("class", rnd("auc", 6).alias("auc"))


# ------------------------------------------------------------------------------ user_callback

class CheckpointOnBest(Callback):
    name = "checkpoint"

    def on_epoch_end(self, history):
        return M.best_checkpoint(history, "epoch", "val_loss").select("epoch", F.col("val_loss").alias("value"))


class StopOnPlateau(Callback):
    name = "early_stop"

    def on_epoch_end(self, history):
        e = M.early_stop(history, "epoch", "val_loss", patience=2)
        return e.where(F.col("stop_epoch").isNotNull()).select(F.col("stop_epoch").alias("epoch"),
                                                               F.col("best_value").alias("value"))


@query("user_callback", SINCE_BEST_SQL + """
SELECT epoch, 'checkpoint' AS callback, round(round(val_loss, 9), 6) AS value FROM h3 WHERE improved
UNION ALL
SELECT min(epoch), 'early_stop', round(round((SELECT min(val_loss) FROM hist), 9), 6) FROM h3 WHERE since_best >= 2
HAVING count(*) > 0""")
def q_user_callback(spark, sf):
    out = run_callbacks(history(spark, sf), [CheckpointOnBest(), StopOnPlateau()])
    return out.select("epoch", "callback", rnd("value", 6).alias("value"))
