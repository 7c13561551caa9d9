"""License scans with a positional rare-token index.

The index holds, per licence word, the templates and places in which it stands, and its inverse
document frequency over all documents. A file's words are looked up; a template can only match if the
words that the file has carry ``SHARE`` of its IDF weight, which few files pass. For those, the
template's highest-IDF words – so many that no match can miss all of them, as they carry more than
1 - ``SHARE`` of the weight – give the relative positions (place in the file minus place in the
template). At each relative position the postings are intersected: the weight of the template's words
that stand at their place is the score, and the mandatory key phrases must stand there whole.

Fixed phrases with labels are counted beside it, at all places. All of it is per-row SQL expressions:
after the pass that counts documents per licence word there is no shuffle.

Defined results: null text has no words; a file without licence has empty labels, null places and
score 0; overlapping places all count; repeated rows get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases and the labels that they give.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
# Notices as they are commonly given, label and mandatory key phrases.
TEMPLATES = [
    ("released under the mit license", "mit", ["mit license"]),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit",
     ["permission is hereby granted", "free of charge"]),
    ("licensed under the apache license version 2 0", "apache-2", ["apache license"]),
    ("licensed under cc by nc 4 0", "cc-by-nc", ["cc by nc"]),
    ("licensed under the gnu general public license version 3", "gpl-3", ["gnu general public license", "version 3"]),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd",
     ["source and binary forms"]),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2", ["mozilla public license"]),
]
SHARE = 0.7
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def key_places(template: str, phrases: list[str]) -> list[int]:
    """Places of the template's words that belong to a key phrase."""
    words, out = template.split(), set()
    for p in phrases:
        w = p.split()
        out |= {i + k for i in range(len(words)) if words[i:i + len(w)] == w for k in range(len(w))}
    return sorted(out)


def vocabulary(templates=TEMPLATES, phrases=PHRASES) -> list[str]:
    return sorted({w for t in [*templates, *phrases] for w in t[0].split()})


def _words(docs: DataFrame) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def word_weights(docs: DataFrame, words: list[str]) -> dict[str, float]:
    """IDF of the licence words over all documents; the words' count bounds the result."""
    some = docs.select(F.explode(F.concat(F.array_intersect(_words(docs), _strings(words)), F.array(F.lit("")))).alias("w"))
    df = {r["w"]: r["n"] for r in some.groupBy("w").agg(F.count("*").alias("n")).collect()}
    return {w: math.log((df.get("", 0) + 1) / (df.get(w, 0) + 1)) + 0.01 for w in words}


def license_report(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, share: float = SHARE) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    known = vocabulary(templates, phrases)
    idf = word_weights(docs, known)
    d = docs.select("doc_id", _words(docs).alias("_w"))
    d = d.withColumn("_known", F.array_intersect("_w", _strings(known)))
    w, places = F.col("_w"), F.sequence(F.lit(0), F.size("_w") - 1)
    has = lambda word: F.array_contains("_known", word)
    stands = lambda text, at: [F.get(w, at + k) == x for k, x in enumerate(text.split())]

    def both(conditions: list[Column]) -> Column:
        out = conditions[0]
        for c in conditions[1:]:
            out = out & c
        return out

    def phrase_places(text: str) -> Column:
        return F.filter(places, lambda i: both(stands(text, i)))

    def best_alignment(words: list[str], weights: list[float], rare: list[str], must: set[int]) -> Column:
        """Best score over the relative positions at which the words of ``must`` stand."""
        total = sum(weights)
        posting = F.create_map(*[c for x in rare for c in (F.lit(x), F.array(*[F.lit(k) for k, y in enumerate(words) if y == x]))])
        rare_places = F.filter(places, lambda i: F.array_contains(_strings(rare), F.get(w, i)))
        relative = F.array_distinct(F.flatten(F.transform(
            rare_places, lambda i: F.transform(F.try_element_at(posting, F.get(w, i)), lambda k: i - k))))
        verified = F.filter(relative, lambda o: both([F.get(w, o + k) == words[k] for k in sorted(must)]))
        return F.array_max(F.transform(verified, lambda o: F.round(sum(
            (F.when(F.get(w, o + k) == x, F.lit(v)).otherwise(0.0) for k, (x, v) in enumerate(zip(words, weights, strict=True))),
            F.lit(0.0)) / total, 6)))

    no_places, cols = F.array().cast("array<int>"), {}
    for n, (text, _) in enumerate(phrases):
        cols[f"_p{n}"] = F.when(both([has(x) for x in dict.fromkeys(text.split())]), phrase_places(text)).otherwise(no_places)
    for n, (text, _, keys) in enumerate(templates):
        words = text.split()
        weights = [idf[x] for x in words]
        total, rare, have = sum(weights), [], 0.0
        for x in sorted(set(words), key=lambda x: (-idf[x], x)):
            if have > (1 - share) * total + 1e-9:
                break
            rare.append(x)
            have += idf[x] * words.count(x)
        present = sum((F.when(has(x), F.lit(idf[x] * words.count(x))).otherwise(0.0) for x in sorted(set(words))), F.lit(0.0))
        best = best_alignment(words, weights, rare, set(key_places(text, keys)))
        cols[f"_t{n}"] = F.when((F.size("_w") > 0) & (present >= share * total - 1e-9), F.coalesce(best, F.lit(0.0))).otherwise(0.0)
    d = d.select("doc_id", F.size("_w").cast("long").alias("n_words"), *[c.alias(k) for k, c in cols.items()])
    all_places = F.concat(*[F.col(f"_p{n}") for n in range(len(phrases))])
    some = lambda found: F.filter(F.array(*found), lambda x: x.isNotNull())
    base = some([F.when(F.size(f"_p{n}") > 0, label) for n, (_, label) in enumerate(phrases)])
    own = some([F.when(F.col(f"_t{n}") >= share, label) for n, (_, label, _) in enumerate(templates)])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    scores = [F.when(F.col(f"_t{n}") >= share, F.col(f"_t{n}")).otherwise(0.0) for n in range(len(templates))]
    return d.select("doc_id", "n_words", F.size(all_places).cast("long").alias("n_base"),
                    F.array_min(all_places).cast("long").alias("first_word"), F.array_max(all_places).cast("long").alias("last_word"),
                    joined(base).alias("base_labels"), joined(F.concat(base, own)).alias("labels"),
                    F.round(F.greatest(F.when(F.size(all_places) > 0, 1.0).otherwise(0.0), *scores), 4).alias("score"))
