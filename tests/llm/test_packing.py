from __future__ import annotations

import collections
import random
import sys
import zlib
from array import array

import pytest
from helpers import awkward, corpus, empty

from kiln.llm import packing as p
from kiln.llm.q06 import tokenizer_paths


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tokenizer_paths()[0])


def test_ids_equal_the_tokenizers_file(whole):
    enc = p.Encoder(*tokenizer_paths())
    texts = ["", " ", "a", " a", "a ", "a  b", "a   b", "a\n b", "a\n\n  b ", "x  y", "x  y", "tab\t end", "it's they'll I'M", "123 45,6 7", "é漢😀 ñ",
             "<|endoftext|> a", "word.\nNext line here.", "a\r\nb c\x0b d", " lead", "a" * 3000, "b " * 500, "　x y", "a  b"]
    rng = random.Random(0)
    texts += ["".join(rng.choice("ab '.\n\té1_ ") for _ in range(rng.randrange(1, 30))) for _ in range(1500)]
    for t in texts:
        assert enc.encode(t) == array("I", whole.encode(t, add_special_tokens=False).ids).tobytes(), repr(t)


def check(rows, texts, whole, length):
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    for doc_id, text in texts:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(array("I", ids[at:at + r["length"]]).tobytes())
            at += r["length"]
        assert at == len(ids)
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for x in sequences.values():
        at = 0
        for offset, size in sorted(x):
            assert offset == at
            at += size
        assert at <= length


def test_pieces_and_sequences(spark, whole):
    rows = corpus()
    check(p.packed_sequences(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_paths(), 256).collect(), rows, whole, 256)


def test_edge_rows(spark):
    got = p.packed_sequences(awkward(spark), tokenizer_paths()).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 9005) == 2 * next(r["doc_tokens"] for r in got if r["doc_id"] == 9005)
    assert sorted(r["doc_tokens"] for r in got if r["doc_id"] in (9001, 9002)) == [1, 1, 1]
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    assert p.packed_sequences(empty(spark), tokenizer_paths()).count() == 0


def test_histogram_packs_hold_every_length_once():
    rng = random.Random(1)
    for _ in range(30):
        counts = {rng.randrange(1, 101): rng.randrange(1, 500) for _ in range(rng.randrange(1, 60))}
        packs = p.pack_histogram(counts, 100)
        used = collections.Counter()
        for lengths, n in packs:
            assert sum(lengths) <= 100 and n > 0
            for x in lengths:
                used[x] += n
        assert used == counts
        # like any such packing: at most one more than twice the least number of packs
        assert sum(n for _, n in packs) <= 2 * -(-sum(k * v for k, v in counts.items()) // 100) + 1


def test_word_cache_is_bounded_by_bytes_and_keeps_no_long_word(whole, monkeypatch):
    monkeypatch.setattr(p, "CACHE_BYTES", 20_000)
    enc, rng = p.Encoder(*tokenizer_paths()), random.Random(3)
    unspaced = ["".join(rng.choice("漢字仮名交文abcXYZ019+/") for _ in range(4000)) for _ in range(6)]
    spaced = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(300)) for _ in range(6)]
    for t in [*unspaced, *spaced, f"{unspaced[0]} {unspaced[1]}"]:
        assert enc.encode(t) == array("I", whole.encode(t, add_special_tokens=False).ids).tobytes()
        assert all(len(w) <= p.CACHED_WORD for w in enc.words)
        assert enc.words.held == sum(sys.getsizeof(w) + sys.getsizeof(i) for w, i in enc.words.items()) <= 20_000
    assert len(enc.words) > 0
