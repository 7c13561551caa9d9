from __future__ import annotations

import random
import re

from helpers import awkward, corpus, empty, words

from kiln.llm import latent_search as s


def test_leaks_and_paraphrases_are_found_and_clean_texts_left(spark):
    rng = random.Random(4)
    items = [(i, " ".join(words(rng, rng.randrange(16, 60), 4000))) for i in range(30)]
    rows, leaks = [(i, t) for i, t in corpus(seed=4, n=80)], set()
    for i, t in items:
        w = words(rng, 300, 6000)
        w[130 + i:130 + i] = t.split()
        rows.append((1000 + i, " ".join(w)))
        leaks.add((1000 + i, i))
        w, para = words(rng, 200, 6000), t.split()
        para[3], para[9:11] = "other", ["put", "in", "here"]       # changed, replaced and inserted words
        w[60:60] = para
        rows.append((2000 + i, " ".join(w)))
        leaks.add((2000 + i, i))
    items += [(77, "too short"), (78, None), (None, "an item without an id is no item at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = s.contaminated(awkward(spark, rows), bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == leaks
    assert s.contaminated(empty(spark), bench).count() == 0
    assert s.contaminated(awkward(spark), bench.limit(0)).count() == 0


def test_items_in_blocks(spark, monkeypatch):
    rng = random.Random(6)
    items = [(i, " ".join(words(rng, 30, 4000))) for i in range(9)]
    docs = spark.createDataFrame([(i, " ".join(words(rng, 90, 4000)) + " " + t) for i, t in items], "doc_id long, text string")
    monkeypatch.setattr(s, "ITEMS", 4)
    got = s.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == {(i, i) for i in range(9)}


def test_latent_candidates_without_the_signature_are_not_compared_word_by_word():
    import numpy as np
    rng = random.Random(8)
    common = [f"c{k}" for k in range(12)]

    def prose(n, rare):
        return [rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(rare)}" for _ in range(n)]

    wanted = [prose(rng.randrange(8, 70), 3000) for _ in range(20)]
    texts = [prose(rng.randrange(1, 400), 3000) for _ in range(40)]
    for k, ws in enumerate(wanted):
        texts[k][rng.randrange(len(texts[k])):0] = changed(rng, ws, rng.choice([0.0, 0.3, 0.4]))
    (_, h, first), = s.hashed_words([" ".join(t).encode() for t in texts])
    hashed = [next(s.hashed_words([" ".join(ws).encode()]))[1] for ws in wanted]
    items = [(k, [int(x) for x in ws], [int(x) for x in ws[-3:]]) for k, ws in enumerate(hashed)]
    hashes = np.unique(np.concatenate(hashed))
    at, term = s.Terms(hashes).find(h)
    block, first_block = s._blocks(first, at)
    own, _ = s._passage_sums(np.zeros((len(at), 1), np.float32), block, first_block)
    marks = s.Signatures(items, hashes, np.bincount(term, minlength=len(hashes)))
    p, i = (x.ravel() for x in np.indices((len(own), len(items))))
    held = marks.possible(list(marks.find(term, block, first_block)), first_block, own, p, i)
    matches = np.zeros(len(p), bool)
    for n, (a, b) in enumerate(zip(p.tolist(), i.tolist(), strict=True)):
        doc = int(np.searchsorted(first_block, own[a], side="right")) - 1
        start, ws = int(first[doc] + (own[a] - first_block[doc]) * s.BLOCK), items[b][1]
        around = h[max(start - len(ws), first[doc]):min(start + s.SPAN * s.BLOCK + len(ws), first[doc + 1])].tolist()
        matches[n] = s.lcs_length(s._places(ws), around) >= s.LCS_PARAPHRASE * len(ws)
    assert matches.sum() >= 20 and held[matches].all()               # no match is lost
    assert held.sum() < 0.3 * len(held)                              # and most pairs are ruled out


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert s.lcs_length(s._places(a), b) == table[-1][-1]


def test_singular_vectors_match_a_direct_decomposition():
    import numpy as np
    rng = np.random.default_rng(0)
    a = rng.normal(size=(200, 8)) @ rng.normal(size=(8, 60))
    omega = rng.standard_normal((60, 20))
    v = s.singular_vectors(a.T @ (a @ omega), omega, 8)
    direct = np.linalg.svd(a)[2][:8].T
    assert np.allclose(v @ v.T, direct @ direct.T, atol=1e-6)


def changed(rng, ws, share):
    """The words with exactly ``share`` of them replaced."""
    at = set(rng.sample(range(len(ws)), int(share * len(ws))))
    return [f"other{rng.randrange(10**6)}" if k in at else w for k, w in enumerate(ws)]


def _brute_force(docs, items, cosine=s.COSINE):
    """(doc_id, item_id) by the rules on the words, over every passage and every item. Cosines are
    those of the full space: the latent one only adds what the truncation rates too high."""
    import numpy as np
    texts = {i: re.findall(r"\w+", t.lower()) for i, t in docs}
    wanted = {i: re.findall(r"\w+", t.lower()) for i, t in items}
    number = {w: k for k, w in enumerate(sorted({w for ws in wanted.values() for w in ws}))}
    df, total = np.zeros(len(number)), 0
    for ws in texts.values():
        for b in range(0, len(ws), s.BLOCK):
            total += 1
            df[[number[w] for w in set(ws[b:b + s.BLOCK]) if w in number]] += 1
    idf, sure, second = np.log((1 + total) / (1 + df)) + 1, set(), set()
    places = {i: (s._places(ws), s._places(ws[len(ws) - max(3, int(len(ws) * s.ANSWER)):])) for i, ws in wanted.items()}
    for d, ws in texts.items():
        blocks = -(-len(ws) // s.BLOCK)
        for i, iw in wanted.items():
            for b in range(blocks):
                if b and b + s.SPAN > blocks:
                    break
                at = b * s.BLOCK
                around = ws[max(at - len(iw), 0):at + s.SPAN * s.BLOCK + len(iw)]
                found, answer = s.lcs_length(places[i][0], around), places[i][1]
                if found >= s.LCS_SURE * len(iw):
                    sure.add((d, i))
                elif found >= s.LCS_PARAPHRASE * len(iw) and s.lcs_length(answer, around) >= s.LCS_SURE * answer[-1]:
                    passage = np.array([number[w] for w in ws[at:at + s.SPAN * s.BLOCK] if w in number], int)
                    if s.full_cosine(passage, np.array([number[w] for w in iw]), idf) >= cosine:
                        second.add((d, i))
    return sure | second


def test_exact_candidates_equal_brute_force_whatever_the_rank(spark, monkeypatch):
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, rng.randrange(6, 90), 60 if i % 5 == 0 else 900))) for i in range(60)]
    docs = []
    for d in range(150):
        w = words(rng, rng.randrange(1, 700), 900)
        for _ in range(2):
            at = rng.randrange(len(w))
            w[at:at] = changed(rng, items[rng.randrange(60)][1].split(), rng.choice((0, 0.1, 0.2, 0.3, 0.4)))
        docs.append((d, " ".join(w)))
    want = _brute_force(docs, items)
    assert len(want) > 150
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for expanded in (s.MAX_EXPANDED, 500):
        monkeypatch.setattr(s, "MAX_EXPANDED", expanded)
        got = s.contaminated(*frames, rank=24)
        pairs = {(r["doc_id"], r["item_id"]) for r in got.collect()}
        assert want <= pairs
        # the rest are second-rule matches that the truncated space rates high
        assert all(s.LCS_PARAPHRASE <= r["lcs"] < s.LCS_SURE for r in got.collect() if (r["doc_id"], r["item_id"]) not in want)


def test_recall_at_several_thousand_items(spark):
    rng = random.Random(12)
    items = [(i, " ".join(words(rng, rng.randrange(16, 60), 20_000))) for i in range(4000)]
    docs, leaks = [], set()
    for k, (i, t) in enumerate(rng.sample(items, 600)):
        w = words(rng, 300, 20_000)
        at = rng.randrange(300)
        w[at:at] = changed(rng, t.split(), 0.2 if k % 2 else 0)
        docs.append((k, " ".join(w)))
        leaks.add((k, i))
    got = s.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == leaks


def test_scattered_frequent_words_are_no_match(spark):
    rng = random.Random(13)
    frequent = "the of and to in is that was".split()
    docs = [(i, " ".join(x for w in words(rng, 200, 3000) for x in (w, rng.choice(frequent)))) for i in range(300)]
    item = "the w1z of and w2z to in w3z is that w4z was the of w5z and w6z to"
    w = docs[0][1].split()
    w[100:100] = [x for word in item.split() if not word.endswith("z") for x in (word, "other")]
    docs.append((1000, " ".join(w)))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert s.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).count() == 0


def test_items_that_the_latent_space_does_not_represent(spark):
    """300 items in 8 dimensions; each text is one passage, a quarter of it an item's words."""
    rng = random.Random(15)
    items = [(i, " ".join(words(rng, 18, 6000))) for i in range(300)]
    known = [w for _, t in items for w in t.split()]
    docs = []
    for i, t in items:
        w = [rng.choice(known) for _ in range(54)]
        w[i % 54:i % 54] = changed(rng, t.split(), 0.2 if i % 2 else 0)
        docs.append((i, " ".join(w)))
    got = s.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), rank=8)
    found = {(r["doc_id"], r["item_id"]) for r in got.collect()}
    print("found", sum((i, i) in found for i in range(0, 300, 2)), sum((i, i) in found for i in range(1, 300, 2)), "of 150 and 150")
    assert {(i, i) for i in range(300)} <= found


def test_items_whose_few_rare_words_were_changed(spark):
    """6,000 blocks, so that the share rule governs: the items keep 4 weighted words, and lose them."""
    rng = random.Random(14)
    frequent = [f"f{k}q" for k in range(150)]
    docs = [(i, " ".join(rng.choice(frequent) if rng.random() < 0.7 else w for w in words(rng, 240, 30_000))) for i in range(600)]
    items, leaks = [], set()
    for i in range(40):
        t = [rng.choice(frequent) for _ in range(24)]
        for k in rng.sample(range(24), 4):
            t[k] = f"rare{i}x{k}"
        items.append((i, " ".join(t)))
        t = [f"other{rng.randrange(10**6)}" if w.startswith("rare") else w for w in t]
        w = docs[i][1].split()
        w[100:100] = t
        docs[i] = (i, " ".join(w))
        leaks.add((i, i))
    got = s.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r["doc_id"], r["item_id"]) for r in got.collect()}
    assert leaks <= found
    assert not {x for x in found - leaks if x[0] >= 40}
