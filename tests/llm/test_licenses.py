from __future__ import annotations

import re

from helpers import awkward, empty

from kiln.llm import licenses as lic


def test_phrases_templates_and_edge_rows(spark):
    filler = " filler words of a text that says nothing of it" * 3
    rows = [(1, "Released under the MIT License." + filler), (2, filler + "\nLicensed under the Apache License, Version 2.0"),
            (3, "Licensed under CC BY-NC 4.0. cc by nc cc BY nc"), (4, "This work is licensed under the GNU General Public License, version 3." + filler),
            (5, "license the of and under license license"), (6, "under the mit licensee"), (7, "Permission is hereby granted, free of charge, to any person obtaining "
             "one copy of this software" + filler), (8, "under the MİT license"), (9, "released under some mit license under the mit license")]
    rows += [(100 + i, filler) for i in range(40)]
    got = {r["doc_id"]: r for r in lic.license_report(awkward(spark, rows)).collect()}
    for i, text in rows:
        w = re.findall(lic.WORD, text.translate({c: c + 32 for c in range(65, 91)}))
        places = sorted((k, label) for p, label in lic.PHRASES for k in range(len(w)) if w[k:k + len(p.split())] == p.split())
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(places))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert got[4]["labels"] == "gpl-3" and got[7]["labels"] == "mit" and got[7]["base_labels"] == ""
    assert got[5]["labels"] == got[6]["labels"] == got[8]["labels"] == got[100]["labels"] == ""
    assert got[9001]["n_words"] == 0 and got[9001]["first_word"] is None
    assert lic.license_report(awkward(spark)).count() == 10
    assert lic.license_report(empty(spark)).count() == 0
