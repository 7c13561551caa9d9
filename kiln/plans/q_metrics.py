"""Loss, metric and training-history queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import vectors as VX
from kiln.functions.vectors import one_hot
from kiln.operators import metrics as M
from kiln.plans.fixtures import EVENTS_HISTORY_SQL, events_epoch_rows, events_history_rows, read
from kiln.operators.products import dot_products
from kiln.plans.q_vectors import CENTROIDS_SQL, MAX_CENTROIDS, UNNEST, _centroids, dense_weights
from kiln.plans.present import rnd
from kiln.plans.registry import query
from kiln.session import scratch_path
from kiln.sources import sinks as SK


def _r(c, d=6):
    return rnd(F.col(c), d).alias(c)


# ------------------------------------------------------------------------------ scored vectors

PROBS_SQL = f"""
u AS ({UNNEST}),
w AS (SELECT i, j, 0.1 * sin(10 * i + j) AS w FROM range(64) t(i), range(10) s(j)),
z AS (SELECT u.vec_id, w.j, sum(u.x::DOUBLE * w.w) + 0.01 * w.j AS z FROM u JOIN w ON u.pos = w.i GROUP BY u.vec_id, w.j),
p AS (SELECT vec_id, j, exp(z - max(z) OVER (PARTITION BY vec_id)) AS e FROM z),
q AS (SELECT q0.vec_id, q0.j, q0.e / sum(q0.e) OVER (PARTITION BY q0.vec_id) AS prob, e.label
      FROM p q0 JOIN embeddings e ON q0.vec_id = e.vec_id),
pr AS (SELECT vec_id, j AS pred FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY prob DESC, j) AS rk FROM q)
       WHERE rk = 1),
scored AS (SELECT e.vec_id, e.label, pr.pred FROM embeddings e JOIN pr ON e.vec_id = pr.vec_id)
"""


def scored(spark, sf):
    """Embeddings scored by the fixed dense softmax layer: probs (array of 10), pred, label."""
    emb = read(spark, sf, "embeddings")
    w, b = dense_weights()
    s = emb.select("vec_id", "label", VX.dense_forward("embedding", w, b, "softmax").alias("probs"))
    return s.withColumn("pred", VX.argmax("probs"))


@query("metric_accuracy", "WITH " + PROBS_SQL + " SELECT round(round(avg(CAST(pred = label AS DOUBLE)), 9), 6) AS accuracy FROM scored")
def q_metric_accuracy(spark, sf):
    return M.accuracy(scored(spark, sf), "pred", "label").select(_r("accuracy"))


@query("metric_confusion", "WITH " + PROBS_SQL + " SELECT label, CAST(pred AS INTEGER) AS pred, count(*) AS count FROM scored GROUP BY ALL")
def q_metric_confusion(spark, sf):
    return M.confusion(scored(spark, sf), "label", "pred")


@query("metric_rmse_onehot", "WITH " + PROBS_SQL + """
SELECT round(round(sqrt(sum(power(CASE WHEN j = label THEN 1.0 ELSE 0.0 END - prob, 2)) / count(DISTINCT vec_id)), 9), 6) AS rmse FROM q""")
def q_metric_rmse_onehot(spark, sf):
    return M.rmse_onehot(scored(spark, sf), "probs", "label").select(_r("rmse"))


@query("loss_scce", "WITH " + PROBS_SQL + """
SELECT round(round(-avg(ln(least(greatest(prob, 1e-7), 1 - 1e-7))), 9), 6) AS loss FROM q WHERE j = label""")
def q_loss_scce(spark, sf):
    return M.loss_scce(scored(spark, sf), "probs", "label").select(_r("loss"))


@query("loss_cce", "WITH " + PROBS_SQL + """
SELECT round(round(-avg(ln(least(greatest(prob, 1e-7), 1 - 1e-7))), 9), 6) AS loss FROM q WHERE j = label""")
def q_loss_cce(spark, sf):
    s = scored(spark, sf).withColumn("onehot", one_hot("label", 10))
    return M.loss_cce(s, "probs", "onehot").select(_r("loss"))


@query("error_reduction", "WITH " + PROBS_SQL + ", " + CENTROIDS_SQL.replace("u AS (" + UNNEST + "),", "", 1) + """,
d AS (SELECT u.vec_id, cent.centroid, sum(u.x::DOUBLE * cent.c) AS dot FROM u JOIN cent ON u.pos = cent.pos
      GROUP BY u.vec_id, cent.centroid),
nc AS (SELECT vec_id, centroid FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dot DESC, centroid) AS rk FROM d)
       WHERE rk = 1),
errs AS (SELECT avg(CAST(s.pred <> s.label AS DOUBLE)) AS err_dense, avg(CAST(nc.centroid <> s.label AS DOUBLE)) AS err_centroid
         FROM scored s JOIN nc ON s.vec_id = nc.vec_id)
SELECT round(round(err_dense, 9), 6) AS err_dense, round(round(err_centroid, 9), 6) AS err_centroid,
       round(round((err_dense - err_centroid) / err_dense, 9), 6) AS reduction FROM errs""")
def q_error_reduction(spark, sf):
    emb = read(spark, sf, "embeddings")
    cents = _centroids(emb)
    rows = cents.orderBy("label").limit(MAX_CENTROIDS + 1).collect()     # one vector per class
    labels = [r["label"] for r in rows]
    if len(rows) > MAX_CENTROIDS:
        nc = dot_products(emb, "vec_id", "embedding", cents, "label", "c", k=1).select(F.col("a").alias("vec_id"), F.col("b").alias("centroid"))
    else:
        d = VX.dot_rows(emb.select("vec_id", "embedding"), "embedding", [r["c"] for r in rows])
        nc = d.select("vec_id", F.element_at(F.array(*[F.lit(v) for v in labels]), VX.argmax("dots") + 1).alias("centroid"))
    s = scored(spark, sf).join(nc, "vec_id")
    e = s.agg(F.avg((F.col("pred") != F.col("label")).cast("double")).alias("err_dense"),
              F.avg((F.col("centroid") != F.col("label")).cast("double")).alias("err_centroid"))
    return e.select(_r("err_dense"), _r("err_centroid"),
                    rnd(M.error_reduction(F.col("err_dense"), F.col("err_centroid")), 6).alias("reduction"))


# ------------------------------------------------------------------------------ regression / binary

@query("metric_mse", "SELECT round(round(avg(power((900 + p_size * 2.0) - p_retailprice, 2)), 9), 6) AS mse FROM part")
def q_metric_mse(spark, sf):
    p = read(spark, sf, "part")
    return M.mse(p, F.lit(900.0) + F.col("p_size") * F.lit(2.0), "p_retailprice").select(_r("mse"))


@query("metric_mae", "SELECT round(round(avg(abs((900 + p_size * 2.0) - p_retailprice)), 9), 6) AS mae FROM part")
def q_metric_mae(spark, sf):
    p = read(spark, sf, "part")
    return M.mae(p, F.lit(900.0) + F.col("p_size") * F.lit(2.0), "p_retailprice").select(_r("mae"))


BIN_SQL = """
b AS (SELECT d.doc_id, l.quality, l.toxic,
             1.0 / (1.0 + exp(-((d.n_chars - 2000) / 1000.0))) AS p_quality,
             1.0 / (1.0 + exp(-((1000 - d.n_chars) / 500.0))) AS p_toxic
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
t AS (SELECT *, -(quality * ln(least(greatest(p_quality, 1e-7), 1 - 1e-7))
                  + (1 - quality) * ln(1 - least(greatest(p_quality, 1e-7), 1 - 1e-7))) AS l_quality,
                -(toxic * ln(least(greatest(p_toxic, 1e-7), 1 - 1e-7))
                  + (1 - toxic) * ln(1 - least(greatest(p_toxic, 1e-7), 1 - 1e-7))) AS l_toxic FROM b)
"""


def _binary(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", "n_chars")
    lab = read(spark, sf, "labels")
    x = d.join(lab, "doc_id")
    return (x.withColumn("p_quality", F.lit(1.0) / (F.lit(1.0) + F.exp(-((F.col("n_chars") - 2000) / F.lit(1000.0)))))
            .withColumn("p_toxic", F.lit(1.0) / (F.lit(1.0) + F.exp(-((F.lit(1000) - F.col("n_chars")) / F.lit(500.0))))))


@query("loss_bce", "WITH " + BIN_SQL + " SELECT round(round(avg(l_quality), 9), 6) AS bce FROM t")
def q_loss_bce(spark, sf):
    return M.loss_bce(_binary(spark, sf), "p_quality", "quality").select(_r("bce"))


@query("loss_multi", "WITH " + BIN_SQL + """
SELECT round(round(avg(l_quality), 9), 6) AS quality_loss, round(round(avg(l_toxic), 9), 6) AS toxic_loss,
       round(round(avg(l_quality) + avg(l_toxic), 9), 6) AS loss FROM t""")
def q_loss_multi(spark, sf):
    b = _binary(spark, sf)
    agg = b.agg(F.avg(M.bce_term("p_quality", "quality")).alias("quality_loss"),
                F.avg(M.bce_term("p_toxic", "toxic")).alias("toxic_loss"))
    return agg.select(_r("quality_loss"), _r("toxic_loss"),
                      rnd(F.col("quality_loss") + F.col("toxic_loss"), 6).alias("loss"))


# ------------------------------------------------------------------------------ history

H = "WITH " + EVENTS_HISTORY_SQL


def _summary(spark, sf):
    return M.batch_summary(events_history_rows(spark, sf), "epoch", "batch", "loss", "correct", role="role")


HIST_SQL = H + """,
hist AS (SELECT epoch,
                sum(loss) FILTER (WHERE role = 'train') / count(*) FILTER (WHERE role = 'train') AS loss,
                sum(correct) FILTER (WHERE role = 'train') / count(*) FILTER (WHERE role = 'train') AS accuracy,
                sum(loss) FILTER (WHERE role = 'val') / count(*) FILTER (WHERE role = 'val') AS val_loss,
                sum(correct) FILTER (WHERE role = 'val') / count(*) FILTER (WHERE role = 'val') AS val_accuracy
         FROM evb GROUP BY epoch)
"""


def _epochs(spark, sf):
    return M.epoch_summary(events_epoch_rows(spark, sf), "epoch", "loss", "correct", role="role")


def history(spark, sf):
    return M.history_epoch(_epochs(spark, sf), "epoch", "role")


def _hist_out(h):
    return h.select("epoch", _r("loss"), _r("accuracy"), _r("val_loss"), _r("val_accuracy"))


@query("metric_running", H + """,
bs AS (SELECT epoch, batch, sum(loss) AS ls, sum(correct) AS cs, count(*) AS n FROM evb WHERE role = 'train'
       GROUP BY epoch, batch)
SELECT epoch, batch,
       round(round(sum(ls) OVER w / sum(n) OVER w, 9), 6) AS running_loss,
       round(round(sum(cs) OVER w / sum(n) OVER w, 9), 6) AS running_accuracy
FROM bs WINDOW w AS (PARTITION BY epoch ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def q_metric_running(spark, sf):
    s = _summary(spark, sf).where("role = 'train'").drop("role")
    r = M.running_metric(s, "epoch", "batch")
    return r.select("epoch", "batch", _r("running_loss"), _r("running_accuracy"))


@query("metric_eval_loop", H + """
SELECT epoch, round(round(avg(loss), 9), 6) AS val_loss, round(round(avg(correct), 9), 6) AS val_accuracy FROM evb WHERE role = 'val'
GROUP BY epoch""")
def q_metric_eval_loop(spark, sf):
    s = _epochs(spark, sf).where("role = 'val'")
    return s.select("epoch", rnd(F.col("loss_sum") / F.col("n"), 6).alias("val_loss"),
                    rnd(F.col("correct_sum") / F.col("n"), 6).alias("val_accuracy"))


@query("history_epoch", HIST_SQL + """
SELECT epoch, round(round(loss, 9), 6) AS loss, round(round(accuracy, 9), 6) AS accuracy, round(round(val_loss, 9), 6) AS val_loss,
       round(round(val_accuracy, 9), 6) AS val_accuracy FROM hist""")
def q_history_epoch(spark, sf):
    return _hist_out(history(spark, sf))


@query("history_batch_loss", H + """
SELECT epoch, batch, round(round(avg(loss), 9), 6) AS loss, count(*) AS n FROM evb WHERE role = 'train' GROUP BY epoch, batch""")
def q_history_batch_loss(spark, sf):
    s = _summary(spark, sf).where("role = 'train'")
    return s.select("epoch", "batch", rnd(F.col("loss_sum") / F.col("n"), 6).alias("loss"), "n")


SINCE_BEST_SQL = HIST_SQL + """,
h1 AS (SELECT *, min(val_loss) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best FROM hist),
h2 AS (SELECT *, prev_best IS NULL OR val_loss < prev_best AS improved FROM h1),
h3 AS (SELECT *, epoch - max(CASE WHEN improved THEN epoch END)
                     OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since_best FROM h2)
"""


@query("early_stop", SINCE_BEST_SQL + """
SELECT (SELECT min(epoch) FROM h3 WHERE since_best >= 2) AS stop_epoch,
       (SELECT epoch FROM hist ORDER BY val_loss, epoch LIMIT 1) AS best_epoch,
       (SELECT round(round(min(val_loss), 9), 6) FROM hist) AS best_value""")
def q_early_stop(spark, sf):
    e = M.early_stop(history(spark, sf), "epoch", "val_loss", patience=2)
    return e.select("stop_epoch", "best_epoch", _r("best_value"))


@query("best_checkpoint", SINCE_BEST_SQL + """
SELECT epoch, round(round(val_loss, 9), 6) AS val_loss, row_number() OVER (ORDER BY val_loss, epoch) = 1 AS is_best
FROM h3 WHERE improved""")
def q_best_checkpoint(spark, sf):
    b = M.best_checkpoint(history(spark, sf), "epoch", "val_loss")
    return b.select("epoch", _r("val_loss"), "is_best")


MAX_SQL = HIST_SQL + """,
h1 AS (SELECT *, max(val_accuracy) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_best FROM hist),
h2 AS (SELECT *, prev_best IS NULL OR val_accuracy > prev_best AS improved FROM h1),
h3 AS (SELECT *, epoch - max(CASE WHEN improved THEN epoch END)
                     OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since_best FROM h2)
"""


@query("early_stop_max", MAX_SQL + """
SELECT (SELECT min(epoch) FROM h3 WHERE since_best >= 2) AS stop_epoch,
       (SELECT epoch FROM hist ORDER BY val_accuracy DESC, epoch LIMIT 1) AS best_epoch,
       (SELECT round(round(max(val_accuracy), 9), 6) FROM hist) AS best_value""")
def q_early_stop_max(spark, sf):
    """The monitored value is an accuracy: higher is better."""
    e = M.early_stop(history(spark, sf), "epoch", "val_accuracy", patience=2, mode="max")
    return e.select("stop_epoch", "best_epoch", _r("best_value"))


@query("best_checkpoint_max", MAX_SQL + """
SELECT epoch, round(round(val_accuracy, 9), 6) AS val_accuracy, row_number() OVER (ORDER BY val_accuracy DESC, epoch) = 1 AS is_best
FROM h3 WHERE improved""")
def q_best_checkpoint_max(spark, sf):
    b = M.best_checkpoint(history(spark, sf), "epoch", "val_accuracy", mode="max")
    return b.select("epoch", _r("val_accuracy"), "is_best")


@query("lr_plateau", SINCE_BEST_SQL + """
SELECT epoch, round(round(val_loss, 9), 6) AS val_loss, CAST(since_best AS INTEGER) AS epochs_since_best,
       round(0.01 * power(0.5, sum(CASE WHEN since_best > 0 AND since_best % 2 = 0 THEN 1 ELSE 0 END)
             OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 9) AS lr_next
FROM h3""")
def q_lr_plateau(spark, sf):
    lr = M.lr_plateau(history(spark, sf), "epoch", "val_loss", lr0=0.01, factor=0.5, patience=2)
    return lr.select("epoch", _r("val_loss"), "epochs_since_best", rnd("lr_next", 9).alias("lr_next"))


@query("overfit_gap", HIST_SQL + """
SELECT epoch, round(round(accuracy - val_accuracy, 9), 6) AS accuracy_gap, round(round(val_loss - loss, 9), 6) AS loss_gap,
       row_number() OVER (ORDER BY val_loss, epoch) = 1 AS lowest_val_loss FROM hist""")
def q_overfit_gap(spark, sf):
    g = M.overfit_gap(history(spark, sf), "epoch")
    return g.select("epoch", _r("accuracy_gap"), _r("loss_gap"), "lowest_val_loss")


@query("sink_metric_log", HIST_SQL + """
SELECT epoch, round(round(loss, 9), 6) AS loss, round(round(accuracy, 9), 6) AS accuracy, round(round(val_loss, 9), 6) AS val_loss,
       round(round(val_accuracy, 9), 6) AS val_accuracy FROM hist""")
def q_sink_metric_log(spark, sf):
    logged = SK.write_metric_log(_hist_out(history(spark, sf)), scratch_path(spark, "metric-log"))
    return logged
