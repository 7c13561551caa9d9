"""Queries of the epoch-wise training: the dense networks of the inventory with their histories.

Each has a SQL twin that repeats every step of the training (``net_sql``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import text as TX
from kiln.functions import vectors as VX
from kiln.operators import training as TR
from kiln.operators.position import hash_int
from kiln.operators.split import holdout_head, holdout_tail
from kiln.plans.fixtures import read
from kiln.plans.net_sql import training_sql
from kiln.plans.present import rnd
from kiln.plans.q_text import ENC_SQL, _encoded
from kiln.plans.registry import query

DIM = 10_000
SHORT = 1_000            # words that the joint network distinguishes
TITLE = 8                # leading words that play the title
TAGS = 100


def _r(name: str) -> str:
    return f"round(round({name}, 9), 6) AS {name}"


def _batch_sql(key: str, batches: int, seed: int) -> str:
    return f"CAST((('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8))::BIGINT) % {batches} AS INTEGER) AS batch"


def _history_cols(net: TR.Network) -> list[str]:
    return [f"{p}{h.name}_{m}" for h in net.heads for m in ("loss", "metric") for p in ("", "val_")]


def _history_sql(net: TR.Network) -> str:
    return "SELECT CAST(epoch AS INTEGER) AS epoch, " + ", ".join(_r(c) for c in _history_cols(net)) + " FROM hist"


def _history(spark, done: TR.Fit):
    return done.history(spark).select("epoch", *[rnd(c, 6).alias(c) for c in _history_cols(done.net)])


# ------------------------------------------------------------------------------ binary, on multi-hot words

BINARY = TR.Network(DIM, (TR.Head("quality", "binary", "quality"),), hidden=(16, 16), sparse=True)
BINARY_RUN = {"epochs": 4, "batches": 3, "rate": 0.01}
BINARY_SQL = "WITH " + ENC_SQL + f""",
ny AS MATERIALIZED (SELECT doc_id AS rid, quality, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < CAST(floor(count(*) OVER () * 0.2::DOUBLE) AS BIGINT)
                    THEN 'val' ELSE 'train' END AS role, {_batch_sql('doc_id', 3, 42)} FROM labels WHERE doc_id IN (SELECT doc_id FROM documents)),
nx AS MATERIALIZED (SELECT DISTINCT rid, j, 1.0::DOUBLE AS v FROM (SELECT doc_id AS rid, id AS j FROM ids UNION ALL SELECT doc_id, 1 FROM documents) WHERE rid IN (SELECT rid FROM ny)),
""" + training_sql(BINARY, BINARY_RUN["epochs"], BINARY_RUN["batches"], BINARY_RUN["rate"], True)


def _binary(spark, sf):
    # the holdout needs the labelled ids only, so it is settled before any text is encoded
    labelled = read(spark, sf, "labels").join(read(spark, sf, "documents").select("doc_id"), "doc_id", "left_semi")
    roles = holdout_head(labelled.select("doc_id"), "doc_id", fraction=0.2)
    rows = _encoded(spark, sf).join(labelled.select("doc_id", "quality"), "doc_id").join(roles, "doc_id")
    rows = rows.select("doc_id", TX.multi_hot("sequence").alias("features"), "quality", "role")
    val = rows.where("role = 'val'")
    return TR.fit(BINARY, rows.where("role = 'train'"), "doc_id", val, **BINARY_RUN), val


@query("fit_binary", BINARY_SQL + """
SELECT p.rid AS doc_id, y.quality AS label, round(round(p.p, 9), 6) AS prob, CAST(p.p > 0.5 AS INTEGER) AS pred
FROM p_quality p JOIN ny y ON p.rid = y.rid WHERE y.role = 'val'""")
def q_fit_binary(spark, sf):
    """Two hidden relu layers of 16 on multi-hot words; the validation rows with their probability."""
    done, val = _binary(spark, sf)
    out = done.predict(val.withColumnRenamed("quality", "label"), ["doc_id", "label"])
    return out.select("doc_id", "label", rnd("quality", 6).alias("prob"), (F.col("quality") > 0.5).cast("int").alias("pred"))


@query("fit_binary_history", BINARY_SQL + "\n" + _history_sql(BINARY))
def q_fit_binary_history(spark, sf):
    return _history(spark, _binary(spark, sf)[0])


# ------------------------------------------------------------------------------ ten classes, on 64 values

CLASSES = TR.Network(64, (TR.Head("digit", "classes", "label", 10),), hidden=(64,))
CLASSES_RUN = {"epochs": 4, "batches": 3, "rate": 0.01}
CLASSES_SQL = f"""WITH
ny AS MATERIALIZED (SELECT vec_id AS rid, label, CASE WHEN row_number() OVER (ORDER BY vec_id) - 1 >= count(*) OVER () - CAST(floor(count(*) OVER () * 0.2::DOUBLE) AS BIGINT)
                    THEN 'val' ELSE 'train' END AS role, {_batch_sql('vec_id', 3, 42)} FROM embeddings),
nx AS MATERIALIZED (SELECT vec_id AS rid, unnest(range(64)) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
""" + training_sql(CLASSES, CLASSES_RUN["epochs"], CLASSES_RUN["batches"], CLASSES_RUN["rate"], True)


def _classes(spark, sf):
    rows = holdout_tail(read(spark, sf, "embeddings"), "vec_id", fraction=0.2)
    rows = rows.select("vec_id", "label", "role", F.col("embedding").cast("array<double>").alias("features"))
    return TR.fit(CLASSES, rows.where("role = 'train'"), "vec_id", rows.where("role = 'val'"), **CLASSES_RUN), rows


@query("fit_multiclass", CLASSES_SQL + """
SELECT y.rid AS vec_id, y.label, y.role, CAST(arg_max(p.c, p.p) AS INTEGER) AS pred FROM p_digit p JOIN ny y ON p.rid = y.rid GROUP BY y.rid, y.label, y.role""")
def q_fit_multiclass(spark, sf):
    """K-way dense network on the 64-value vectors (64 → 64 relu → 10 softmax), 20% tail holdout."""
    done, rows = _classes(spark, sf)
    out = done.predict(rows, ["vec_id", "label", "role"])
    return out.select("vec_id", "label", "role", (F.array_position("digit", F.array_max("digit")) - 1).cast("int").alias("pred"))


@query("fit_multiclass_history", CLASSES_SQL + "\n" + _history_sql(CLASSES))
def q_fit_multiclass_history(spark, sf):
    return _history(spark, _classes(spark, sf)[0])


# ------------------------------------------------------------------------------ three inputs, two outputs

JOINT = TR.Network(2 * SHORT + TAGS, (TR.Head("priority", "unit", "priority"), TR.Head("department", "classes", "department", 4)), hidden=(16,), sparse=True)
JOINT_RUN = {"epochs": 3, "batches": 2, "rate": 0.005}
DEPARTMENTS = ["en", "de", "fr", "es"]
JOINT_SQL = "WITH " + ENC_SQL + f""",
ny AS MATERIALIZED (SELECT doc_id AS rid, least(n_chars / 4000::DOUBLE, 1.0) AS priority,
                           CASE lang {' '.join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(DEPARTMENTS))} END AS department,
                           CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < CAST(floor(count(*) OVER () * 0.2::DOUBLE) AS BIGINT) THEN 'val' ELSE 'train' END AS role,
                           {_batch_sql('doc_id', 2, 42)} FROM documents),
nx AS MATERIALIZED (SELECT DISTINCT rid, j, 1.0::DOUBLE AS v FROM (
    SELECT doc_id AS rid, CASE WHEN id < {SHORT} THEN id ELSE 2 END + CASE WHEN pos <= {TITLE} THEN 0 ELSE {SHORT} END AS j FROM ids
    UNION ALL SELECT doc_id, {2 * SHORT} + (('0x' || substr(md5(source || '|42'), 1, 8))::BIGINT) % {TAGS} FROM documents WHERE source IS NOT NULL)),
""" + training_sql(JOINT, JOINT_RUN["epochs"], JOINT_RUN["batches"], JOINT_RUN["rate"], True)


def _joint(spark, sf):
    docs = read(spark, sf, "documents")
    roles = holdout_head(docs.select("doc_id"), "doc_id", fraction=0.2)
    words = lambda seq, shift: F.transform(seq, lambda i: F.when(i < SHORT, i).otherwise(2) + shift)
    enc = _encoded(spark, sf).select("doc_id", words(F.slice("sequence", 2, TITLE), 0).alias("title"),
                                     words(F.slice("sequence", F.lit(TITLE + 2), F.greatest(F.size("sequence"), F.lit(1))), SHORT).alias("body"))
    tag = F.when(F.col("source").isNotNull(), F.array((F.lit(2 * SHORT) + F.pmod(hash_int("source", 42), F.lit(TAGS))).cast("int"))).otherwise(F.array().cast("array<int>"))
    place = F.array_position(F.array(*[F.lit(x) for x in DEPARTMENTS]), F.col("lang"))
    docs = docs.select("doc_id", tag.alias("tags"), F.least(F.col("n_chars") / F.lit(4000.0), F.lit(1.0)).alias("priority"),
                       F.when(place > 0, place - 1).cast("int").alias("department"))
    rows = docs.join(enc, "doc_id").join(roles, "doc_id")
    rows = rows.select("doc_id", TX.multi_hot(F.concat("title", "body", "tags")).alias("features"), "priority", "department", "role")
    return TR.fit(JOINT, rows.where("role = 'train'"), "doc_id", rows.where("role = 'val'"), **JOINT_RUN), rows


@query("fit_joint", JOINT_SQL + """
SELECT a.rid AS doc_id, round(round(a.p, 9), 6) AS priority, CAST(arg_max(b.c, b.p) AS INTEGER) AS department, round(round(max(b.p), 9), 6) AS department_prob
FROM p_priority a JOIN p_department b ON a.rid = b.rid GROUP BY a.rid, a.p""")
def q_fit_joint(spark, sf):
    """Title, body and tags in; a regressed priority and one of four departments out, under one summed
    loss over a shared hidden layer; every document gets both."""
    done, rows = _joint(spark, sf)
    out = done.predict(rows, ["doc_id"])
    top = F.array_max("department")
    return out.select("doc_id", rnd("priority", 6).alias("priority"), (F.array_position("department", top) - 1).cast("int").alias("department"),
                      rnd(top, 6).alias("department_prob"))


@query("fit_joint_history", JOINT_SQL + "\n" + _history_sql(JOINT))
def q_fit_joint_history(spark, sf):
    return _history(spark, _joint(spark, sf)[0])


@query("fit_joint_eval", JOINT_SQL + " " + " UNION ALL ".join(
    f"""SELECT '{h}' AS output, n, round(round(loss / n, 9), 6) AS loss, round(round(metric / n, 9), 6) AS metric FROM val{JOINT_RUN['epochs']}_e_{h}"""
    for h in ("priority", "department")))
def q_fit_joint_eval(spark, sf):
    """Evaluation per output on the validation rows: mean squared and absolute error, cross-entropy and accuracy."""
    done, rows = _joint(spark, sf)
    got = done.evaluate(rows.where("role = 'val'"))
    out = spark.createDataFrame([(k, m["n"], m["loss"], m["metric"]) for k, m in got.items()], "output string, n long, loss double, metric double")
    return out.select("output", "n", rnd("loss", 6).alias("loss"), rnd("metric", 6).alias("metric"))


# ------------------------------------------------------------------------------ two labels that cover some documents

WIDE = DIM + 100
TWO = TR.Network(WIDE, (TR.Head("quality", "binary", "quality"), TR.Head("toxic", "binary", "toxic")), hidden=(16,), sparse=True)
TWO_RUN = {"epochs": 3, "batches": 2, "rate": 0.01}


@query("fit_multi_output", "WITH " + ENC_SQL + f""",
ny AS MATERIALIZED (SELECT d.doc_id AS rid, l.quality, l.toxic, 'train' AS role, {_batch_sql('d.doc_id', 2, 42)} FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
nx AS MATERIALIZED (SELECT DISTINCT rid, j, 1.0::DOUBLE AS v FROM (SELECT doc_id AS rid, id AS j FROM ids UNION ALL SELECT doc_id, 1 FROM documents
                    UNION ALL SELECT doc_id, {DIM} + least(n_chars // 1000, 99) FROM documents WHERE n_chars IS NOT NULL)),
""" + training_sql(TWO, TWO_RUN["epochs"], TWO_RUN["batches"], TWO_RUN["rate"], True) + " " + " UNION ALL ".join(
    f"SELECT rid AS doc_id, '{t}' AS target, round(round(p, 9), 6) AS prob FROM p_{t}" for t in ("quality", "toxic")))
def q_fit_multi_output(spark, sf):
    """Words and length in, two labels out, under one summed loss over a shared hidden layer: each label's
    part of it is the mean over the documents that have the label. Every document is scored."""
    length = F.array((F.lit(DIM) + F.least(F.floor(F.col("n_chars") / 1000), F.lit(99))).cast("int"))
    docs = read(spark, sf, "documents").select("doc_id", F.when(F.col("n_chars").isNotNull(), length).otherwise(F.array().cast("array<int>")).alias("length"))
    rows = _encoded(spark, sf).join(docs, "doc_id").join(read(spark, sf, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    rows = rows.select("doc_id", TX.multi_hot(F.concat("sequence", "length")).alias("features"), "quality", "toxic")
    out = TR.fit(TWO, rows, "doc_id", **TWO_RUN).predict(rows, ["doc_id"])
    each = F.array(*[F.struct(F.lit(t).alias("target"), rnd(t, 6).alias("prob")) for t in ("quality", "toxic")])
    return out.select("doc_id", F.inline(each))


# ------------------------------------------------------------------------------ noise channels beside zeros

NOISE = TR.Network(128, (TR.Head("digit", "classes", "label", 10),), hidden=(32,))


def _noise_sql(variant: str, extra: str) -> str:
    return f"""SELECT * FROM (WITH
ny AS MATERIALIZED (SELECT vec_id AS rid, label, CASE WHEN row_number() OVER (ORDER BY vec_id) - 1 >= count(*) OVER () - CAST(floor(count(*) OVER () * 0.2::DOUBLE) AS BIGINT)
                    THEN 'val' ELSE 'train' END AS role, {_batch_sql('vec_id', 3, 42)} FROM embeddings),
nx AS MATERIALIZED (SELECT vec_id AS rid, unnest(range(64)) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings{extra}),
{training_sql(NOISE, CLASSES_RUN['epochs'], CLASSES_RUN['batches'], CLASSES_RUN['rate'], True)}
SELECT '{variant}' AS variant, round(round(val_digit_metric, 9), 6) AS val_accuracy, round(round(val_digit_loss, 9), 6) AS val_loss
FROM hist WHERE epoch = {CLASSES_RUN['epochs']})"""


@query("fit_noise_check", _noise_sql("noise", """
    UNION ALL SELECT vec_id, 64 + i, ('0x' || substr(md5(CAST(vec_id AS VARCHAR) || ':' || CAST(i AS VARCHAR) || '|3'), 1, 8))::BIGINT / 4294967296.0
    FROM embeddings, range(64) t(i)""") + " UNION ALL " + _noise_sql("zeros", ""))
def q_fit_noise_check(spark, sf):
    """Same network on real + noise channels and on real + zero channels; validation accuracy and loss."""
    emb = read(spark, sf, "embeddings")
    noise = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: hash_int(F.concat_ws(":", F.col("vec_id").cast("string"), i.cast("string")), 3) / F.lit(4294967296.0))
    rows = []
    for variant, extra in (("noise", noise), ("zeros", VX.zeros(64))):
        x = emb.select("vec_id", "label", VX.vec_concat("embedding", extra).alias("features"))
        x = holdout_tail(x, "vec_id", fraction=0.2)
        last = TR.fit(NOISE, x.where("role = 'train'"), "vec_id", x.where("role = 'val'"), **CLASSES_RUN).rows[-1]
        rows.append((variant, last["val_digit_metric"], last["val_digit_loss"]))
    out = spark.createDataFrame(rows, "variant string, val_accuracy double, val_loss double")
    return out.select("variant", rnd("val_accuracy", 6).alias("val_accuracy"), rnd("val_loss", 6).alias("val_loss"))


# ------------------------------------------------------------------------------ one layer; a stored model

PLAIN = TR.Network(64, (TR.Head("digit", "classes", "label", 10),), hidden=())


def _plain_sql(role: str) -> str:
    return f"""WITH
ny AS MATERIALIZED (SELECT vec_id AS rid, label, {role} AS role, {_batch_sql('vec_id', 3, 42)} FROM embeddings),
nx AS MATERIALIZED (SELECT vec_id AS rid, unnest(range(64)) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
""" + training_sql(PLAIN, CLASSES_RUN["epochs"], CLASSES_RUN["batches"], CLASSES_RUN["rate"], True)


@query("predict_proba", _plain_sql("'train'") + " SELECT rid AS vec_id, CAST(c AS INTEGER) AS class, round(round(p, 9), 6) AS prob FROM p_digit")
def q_predict_proba(spark, sf):
    rows = read(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("features"))
    out = TR.fit(PLAIN, rows, "vec_id", **CLASSES_RUN).predict(rows, ["vec_id"])
    return out.select("vec_id", F.posexplode("digit").alias("class", "p")).select("vec_id", "class", rnd("p", 6).alias("prob"))


@query("sink_model", _plain_sql("""CASE WHEN row_number() OVER (ORDER BY vec_id) - 1 >= count(*) OVER () - CAST(floor(count(*) OVER () * 0.2::DOUBLE) AS BIGINT)
                    THEN 'val' ELSE 'train' END""") + f"""
SELECT round(round(metric / n, 9), 6) AS val_accuracy, n AS n_val FROM val{CLASSES_RUN['epochs']}_e_digit""")
def q_sink_model(spark, sf):
    """The weights as they are stored after the last epoch, read back and evaluated."""
    rows = holdout_tail(read(spark, sf, "embeddings"), "vec_id", fraction=0.2)
    rows = rows.select("vec_id", "label", "role", F.col("embedding").cast("array<double>").alias("features"))
    path = TR.fit(PLAIN, rows.where("role = 'train'"), "vec_id", **CLASSES_RUN).path
    weights, _, _ = TR.load_epoch(spark, path, PLAIN, CLASSES_RUN["epochs"])
    got = TR.Fit(PLAIN, weights).evaluate(rows.where("role = 'val'"))["digit"]
    return spark.createDataFrame([(got["metric"], got["n"])], "a double, n_val long").select(rnd("a", 6).alias("val_accuracy"), "n_val")
