from __future__ import annotations

import base64
import hashlib

from kiln.llm import arc_warc as a

SCHEMA = "page_id long, url string, html string, record_type string, payload_digest string"


def test_round_trip_with_edge_rows(spark):
    html = ["<p>é漢😀</p>", "", None, "WARC/1.1\r\n\r\nWARC-Type: x\r\n\r\n", "http://x 0.0.0.0 20240101000000 text/html 5\nabcde\n", "x" * 300_000, "\n\n", "<p>é漢😀</p>", ""]
    rows = [(i, f"http://h/{i} a\nb" if i % 2 else None, h, "k", None) for i, h in enumerate(html)]
    rows += [(None, None, "<p>é漢😀</p>", None, None), (None, "http://n/", "only", None, None), (50, "u", "twice", None, None), (50, "u", "twice", None, None)]
    got = a.archived(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
    first = {}
    for i, _, h, _, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(h or "", i)
    for i, _, h, _, _ in rows:
        want = base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
        mine = [r for r in by[i] if r["payload_digest"] == want]
        assert mine and all(r["payload_bytes"] == len((h or "").encode()) for r in mine)
        if i == 50:
            assert sorted((r["record_type"], r["refers_to"]) for r in mine) == [("response", None), ("revisit", 50)]
        elif first[h or ""] == i:
            assert [(r["record_type"], r["refers_to"]) for r in mine] == [("response", None)]
        else:
            assert [(r["record_type"], r["refers_to"]) for r in mine] == [("revisit", first[h or ""])]
    assert a.archived(spark.createDataFrame([], SCHEMA)).count() == 0


def test_versions_and_lines_that_are_no_header():
    one = b"1 0 x\n" + a.ARC_FIELDS[1].encode() + b"\n"
    two = b"2 0 x\n" + a.ARC_FIELDS[2].encode() + b"\n"
    data = (f"filedesc://a 0.0.0.0 20240101000000 text/plain {len(one)}\n".encode() + one + b"\nnoise\nhttp://a 1.2.3.4 20240102030405 text/html 3\nx\ny\n"
            + f"filedesc://b 0.0.0.0 20240101000000 text/plain 200 - - 0 b {len(two)}\n".encode() + two
            + b"\nhttp://b 1.2.3.4 20240102030405 text/html 200 - - 7 b 2\nhi\n")
    assert [(v, f[0], d) for v, _, f, d in a.arc_records(data)][1::2] == [(1, "http://a", b"x\ny"), (2, "http://b", b"hi")]
