import re

import numpy as np

from rollbook.llm import QUERIES
from rollbook.llm.licenses import TEMPLATES, aligned, license_spans, winnowed

from .conftest import prose


def words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())


def test_notices_in_documents_are_all_found(spark, data, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    got = {(r.doc_id, r.license) for r in QUERIES["op8_license_spans"](spark, data).collect()}
    for id, text in texts.items():
        line = " " + " ".join(words(text)) + " "
        for name, template in TEMPLATES.items():
            if " " + " ".join(words(template)) + " " in line:
                assert (id, name) in got
    for r in QUERIES["op8_license_spans"](spark, data).collect():
        assert set(words(texts[r.doc_id][r.start : r.stop])) & set(words(TEMPLATES[r.license]))
        assert r.coverage >= 0.8


def test_spans_and_edited_notices(spark):
    mit = TEMPLATES["MIT permission"]
    changed = mit.replace("free of charge", "without any fee").replace("software", "SOFTWARE")
    rows = [
        (1, f"é {prose(1, 30)}\n{mit}\n{prose(2, 30)}"),
        (2, f"{prose(3, 500)} {changed} {prose(4, 10)} {mit}"),
        (3, " ".join(mit.split()[:15])),
        (4, prose(5, 300)),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = license_spans(df, templates={"mit": mit}).collect()
    by_doc = {i: [r for r in found if r.row.doc_id == i] for i, _ in rows}
    (one,) = by_doc[1]
    assert rows[0][1][one.start : one.stop] == mit and one.coverage == 1
    assert [r.coverage == 1 for r in sorted(by_doc[2], key=lambda r: r.start)] == [False, True]
    assert by_doc[3] == [] and by_doc[4] == []


def test_alignment():
    assert aligned([1, 2, 3], [9, 1, 2, 8, 3, 9]) == (3, 1, 5)
    assert aligned([1, 2, 3], [7, 7, 7])[0] == 0
    assert aligned([1, 2, 3, 4], [1, 2, 4]) == (3, 0, 3)


def test_any_long_enough_run_has_a_fingerprint():
    values = np.random.default_rng(0).integers(0, 1000, 200)
    kept = set(winnowed(values, 4))
    assert all(kept & set(range(i, i + 4)) for i in range(197))
    assert winnowed(values[:2], 4) == [int(np.argmin(values[:2]))] and winnowed(values[:0], 4) == []


def test_odd_rows_and_empty_table(odd):
    assert license_spans(odd).collect() == [] and license_spans(odd.limit(0)).collect() == []
    assert license_spans(odd, templates={}).collect() == [] and license_spans(odd, templates={"a": "b"}).collect() == []


def test_copies_on_neighbouring_lines_are_a_match_each(spark):
    notices = [TEMPLATES[n] for n in ("All rights reserved", "MIT", "CC-BY-NC-4.0", "Apache-2.0", "BSD redistribution")]
    rows = sorted({(times, notice, between.join([notice] * times)) for notice in notices for times in (1, 2, 3, 4, 9, 40) for between in ("\n", "\nand ")})
    df = spark.createDataFrame(rows, "times int, notice string, text string")
    spans = {}
    for r in license_spans(df, templates={n: n for n in notices}).collect():
        if r.license == r.row.notice:
            spans.setdefault((r.row.notice, r.row.text), []).append((r.start, r.stop))
    for times, notice, text in rows:
        places = [m.start() for m in re.finditer(re.escape(notice.rstrip(".")), text)]
        assert len(places) == times
        assert sorted(spans[notice, text]) == [(p, p + len(notice.rstrip("."))) for p in places]


def test_edited_copies_beside_whole_ones(spark):
    whole = TEMPLATES["MIT"]
    changed = whole.replace("License", "terms")
    texts = [[changed, whole], [whole, changed], [changed, whole, changed, whole]]
    df = spark.createDataFrame([("\n".join(t), [4 if x == changed else 5 for x in t]) for t in texts], "text string, matched array<int>")
    found = license_spans(df, templates={"mit": whole}).collect()
    for text in texts:
        own = sorted((r for r in found if r.row.text == "\n".join(text)), key=lambda r: r.start)
        assert own and [r.matched for r in own] == own[0].row.matched


def test_headers_of_common_licenses(spark):
    cases = [
        ("This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
         "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.", "GNU program notice"),
        ("This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n"
         " * License as published by the Free Software Foundation; either", "GNU program notice"),
        ("// SPDX-License-Identifier: BSD-3-Clause", "SPDX identifier"),
        ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n"
         " * file, You can obtain one at https://mozilla.org/MPL/2.0/. */", "MPL-2.0 header"),
        (TEMPLATES["MIT disclaimer"] + " IN NO EVENT SHALL THE AUTHORS", "MIT disclaimer"),
        (TEMPLATES["BSD disclaimer"].replace("HOLDERS AND CONTRIBUTORS", "OWNER"), "BSD disclaimer"),
        (TEMPLATES["ISC permission"].replace("and/or", "and"), "ISC permission"),
        (TEMPLATES["Unlicense"], "Unlicense"),
    ]
    df = spark.createDataFrame([(f"{prose(1, 20)}\n{t}\n{prose(2, 20)}", n) for t, n in cases], "text string, name string")
    found = [(r.row.name, r.license) for r in license_spans(df).collect()]
    assert sorted(found) == sorted((n, n) for _, n in cases)
