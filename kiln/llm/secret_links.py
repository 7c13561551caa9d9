"""Secret scans: multipart credential linking.

Seven patterns mark parts of credentials in the whole text, leftmost and non-overlapping per kind.
Three kinds are reported wherever they stand: ``assign`` (a secret's name, an assignment and a
value of six or more characters), ``access`` (access-key identifiers) and ``hex`` (24 or more
lower-case hexadecimal digits). Four weak kinds are reported only when a complementary part lies
near: ``id`` (user names, client ids, mail addresses) next to a secret, ``endpoint`` (addresses,
hosts) next to a secret, ``key`` (looser secret names) and ``opaque`` (20 or more mixed letters and
digits) next to an identifier or an endpoint. Near means: in the same scope – the stretch between
two blank lines – and at most ``REACH`` code points apart.

The link is an interval join done as running windows per scope: a part of the wanted role exists
within reach exactly if the largest end among those that start no later, or the smallest start
among the later ones, is within reach. So it costs one sort per document and never lists pairs.
Everything is SQL expressions, windows and grouped aggregates.

Defined results: null text counts as empty (no spans); positions are code points, ends exclusive;
repeated rows (same doc_id and text) each get a row; an empty table gives no rows; extra columns are
ignored, or carried by ``redacted``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REACH = 160
_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
#: kind, role, pattern; in the order in which spans with equal starts are listed.
KINDS = [
    ("assign", "secret", r"(?i:(password|passwd|secret|token|api_?key))" + _VALUE + r"([A-Za-z0-9+/_.=-]+)"),
    ("access", "identifier", r"AKIA[A-Z0-9]{16,}"),
    ("hex", "secret", r"[0-9a-f]{24,}"),
    ("id", "identifier", r"(?i:\b(user_?name|user|login|client_?id|account_?id|key_?id))" + _VALUE
     + r"[A-Za-z0-9+/_.@-]{3,}|[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("endpoint", "endpoint", r"(?i:https?://)[^\x00-\x20\"'<>]+|\b[0-9]{1,3}(\.[0-9]{1,3}){3}\b(:[0-9]{1,5})?"
     + r"|(?i:\b(host|server|endpoint))" + _VALUE + r"[A-Za-z0-9._:/-]{3,}"),
    ("key", "secret", r"(?i:\b(pass|pwd|pass_?phrase|auth|bearer|credential|private_?key|signature))" + _VALUE
     + r"[A-Za-z0-9+/_.=-]{4,}"),
    ("opaque", "secret", r"[A-Za-z0-9+/_-]{20,}"),
]
BASE = ("assign", "access", "hex")
SCOPE = r"\n[\x20\t\r]*\n\s*"
#: for each weak kind, the roles that complete it
NEEDS = {"id": ["secret"], "endpoint": ["secret"], "key": ["identifier", "endpoint"], "opaque": ["identifier", "endpoint"]}


def _matches(no: int, pattern: str, group: int = 0, ok: Callable[[Column, Column], Column] | None = None) -> Column:
    """Matches of a pattern as (no, pos, gap before it, length, ok) in the text's order; the start
    is the sum of the gaps and lengths before. ``ok`` judges (match, group). The one-element array
    binds the lists to a name, so that each is made once; most texts end at the first test."""
    text = F.col("_text")
    bound = F.array(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
                             F.split(text, pattern, -1).alias("gaps"),
                             F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v")))

    def rows(b: Column) -> Column:
        return F.transform(b["m"], lambda x, i: F.struct(
            F.lit(no).alias("no"), i.alias("pos"), F.length(F.get(b["gaps"], i)).alias("gap"), F.length(x).alias("len"),
            (ok(x, F.get(b["v"], i)) if ok else F.lit(True)).alias("ok")))

    none = F.array().cast("array<struct<no:int,pos:int,gap:int,len:int,ok:boolean>>")
    return F.when(text.rlike(pattern), F.flatten(F.transform(bound, rows))).otherwise(none)


def spans(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per distinct (doc_id, text): doc_id, ``_hash`` of the text, ``copies`` and ``found``, the
    sorted array of (start, no, end)."""
    t = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    tests = {"assign": lambda m, value: F.length(value) >= 6, "opaque": lambda m, _: m.rlike("[0-9]") & m.rlike("[A-Za-z]")}
    parts = [_matches(no, p, 2 if kind == "assign" else 0, tests.get(kind)) for no, (kind, _, p) in enumerate(KINDS)]
    own = F.array(F.struct(F.lit(-1).alias("no"), F.lit(0).alias("pos"), F.lit(0).alias("gap"), F.lit(0).alias("len"), F.lit(True).alias("ok")))
    breaks = _matches(len(KINDS), SCOPE)
    t = t.select("doc_id", F.xxhash64("_text").alias("_hash"), F.concat(own, *parts).alias("_found"),
                 breaks.alias("_breaks"))
    # scopes matter only where a weak part was found
    weak = F.exists("_found", lambda x: x["no"] >= len(BASE))
    t = t.select("doc_id", "_hash", F.explode(F.when(weak, F.concat("_found", "_breaks")).otherwise(F.col("_found"))).alias("x"))
    t = t.groupBy("doc_id", "_hash", "x").agg(F.count("*").alias("copies")).select("doc_id", "_hash", "copies", "x.*")

    doc = ["doc_id", "_hash"]
    before = Window.partitionBy(*doc, "no").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(before)).filter("ok")
    t = t.withColumn("start", F.col("end") - F.col("len"))
    order = Window.partitionBy(*doc).orderBy("start")
    t = t.withColumn("_scope", F.sum((F.col("no") == len(KINDS)).cast("int")).over(order.rangeBetween(Window.unboundedPreceding, 0)))
    t = t.filter(F.col("no") < len(KINDS))

    # an opaque run that overlaps another part is that part, not a second one
    past = Window.partitionBy(*doc, "_scope").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    coming = Window.partitionBy(*doc, "_scope").orderBy("start").rangeBetween(0, Window.unboundedFollowing)
    opaque = len(KINDS) - 1
    other = (F.col("no") >= 0) & (F.col("no") != opaque)
    t = t.withColumns({"_e": F.max(F.when(other, F.col("end"))).over(past), "_s": F.min(F.when(other, F.col("start"))).over(coming)})
    t = t.filter(~((F.col("no") == opaque) & ((F.coalesce("_e", F.lit(-1)) > F.col("start")) | (F.coalesce("_s", F.col("end")) < F.col("end")))))
    near = {}
    for role in ("identifier", "secret", "endpoint"):
        mine = F.col("no").isin([i for i, k in enumerate(KINDS) if k[1] == role])
        near[role] = ((F.coalesce(F.max(F.when(mine, F.col("end"))).over(past), F.lit(-reach - 1)) >= F.col("start") - reach)
                      | (F.coalesce(F.min(F.when(mine, F.col("start"))).over(coming), F.col("end") + reach + 1) <= F.col("end") + reach))
    t = t.withColumns({f"_{r}": c for r, c in near.items()})
    keep = F.col("no") < len(BASE)
    for no, (kind, _, _p) in enumerate(KINDS):
        for role in NEEDS.get(kind, []):
            keep = keep | ((F.col("no") == no) & F.col(f"_{role}"))
    t = t.filter(keep)
    return t.groupBy(*doc).agg(
        F.max(F.when(F.col("no") == -1, F.col("copies"))).alias("copies"),
        F.sort_array(F.collect_list(F.when(F.col("no") >= 0, F.struct("start", "no", "end")))).alias("found"))


def _joined(found: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(names, x["no"]), x["start"], x["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """Per document row: counts per base kind, the digest of the base spans, all spans."""
    s = spans(docs)
    base = F.filter("found", lambda x: x["no"] < len(BASE))
    count = lambda no: F.size(F.filter("found", lambda x: x["no"] == no)).cast("long")
    return s.select("doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE)],
                    F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"),
                    F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")


def redacted(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The documents with every reported span replaced by ``mask``; texts without one stay as they
    are (null too), ``n_chars`` (where there is one) follows the text. All columns stay, and all rows."""
    found = spans(docs).select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"), F.explode("found").alias("x"))
    # overlapping spans become one cut
    w = Window.partitionBy("_id", "_h").orderBy("x")
    found = found.withColumn("_e", F.max("x.end").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    found = found.withColumn("_n", F.sum((F.col("_e").isNull() | (F.col("x.start") >= F.col("_e"))).cast("int")).over(w))
    found = (found.groupBy("_id", "_h", "_n").agg(F.struct(F.min("x.start").alias("s"), F.max("x.end").alias("e")).alias("c"))
             .groupBy("_id", "_h").agg(F.sort_array(F.collect_list("c")).alias("_cut")))
    d = docs.join(found, docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("_h")), "left")
    rest = F.transform("_cut", lambda c, i: F.substr(docs["text"], F.when(i > 0, F.get("_cut", i - 1)["e"]).otherwise(0) + 1,
                                                     c["s"] - F.when(i > 0, F.get("_cut", i - 1)["e"]).otherwise(0)))
    tail = F.substr(docs["text"], F.element_at("_cut", -1)["e"] + 1)
    clean = F.when(F.col("_cut").isNull(), docs["text"]).otherwise(F.concat_ws(mask, rest, F.array(tail)))
    out = d.withColumn("_clean", clean)
    cols = {"text": F.col("_clean"), **({"n_chars": F.when(F.col("_cut").isNull(), F.col("n_chars")).otherwise(F.length("_clean"))}
                                        if "n_chars" in docs.columns else {})}
    return out.select(*[cols[c].cast(docs.schema[c].dataType).alias(c) if c in cols else docs[c] for c in docs.columns])
