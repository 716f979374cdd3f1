"""License scans: winnowed template fingerprints pick candidates, a banded alignment measures them."""

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .words import Chunk, CHUNK_BYTES

#: Words of a fingerprint, and window of fingerprints of which the smallest is kept: any four words in a row
#: of a template that a text repeats are found.
GRAM, WINNOW = 3, 2
#: How far an alignment may drift from its diagonal, and the covered share of a template from which it is reported.
BAND, COVERAGE = 6, 0.8
#: Templates may have so many words in all, because each executor holds their index.
LARGEST = 1_000_000

# Short notices as they stand in documents, and headers, grants and disclaimers as their publishers word
# them. What several licenses share has a name for all of them, so that no version or relative is named wrongly.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "MIT": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "BSD redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "All rights reserved": "All rights reserved.",
    "GNU program notice": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation"
    ),
    "GNU program warranty": (
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "MPL-2.0 header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "ISC permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
    "MIT disclaimer": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "BSD disclaimer": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED."
    ),
    "SPDX identifier": "SPDX-License-Identifier:",
}

#: A to Z in lower case; letters, digits and all bytes of other characters are words, the rest is space.
_WORDS = bytes(
    b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def _grams(chunk):
    """(first word, hash) of the runs of GRAM words."""
    return chunk.windows(chunk.hashes(), GRAM)


def winnowed(values, window=WINNOW):
    """Places of the smallest value (the last of equal ones) of each window of neighbours."""
    n = len(values) - window + 1
    if n <= 0:
        return [int(np.argmin(values))] if len(values) else []
    kept = set()
    for i in range(n):
        part = values[i : i + window]
        kept.add(i + window - 1 - int(np.argmin(part[::-1])))
    return sorted(kept)


class TemplateIndex:
    """Word hashes of each template, and an inverted index of its winnowed fingerprints.

    A template with fewer than GRAM words is left out: it has no fingerprint.
    """

    def __init__(self, templates):
        self.names, self.words, postings = [], [], defaultdict(list)
        with np.errstate(over="ignore"):
            for name, text in templates.items():
                chunk = Chunk([text.encode().translate(_WORDS)])
                at, value = _grams(chunk)
                if not len(at):
                    continue
                for i in winnowed(value):
                    postings[int(value[i])].append((len(self.names), int(at[i])))
                self.names.append(name)
                self.words.append(chunk.hashes())
        self.postings = dict(postings)
        self.keys = np.sort(np.fromiter(self.postings, np.uint64, len(self.postings)))

    def places(self, values):
        """Numbers of the values that are in the index."""
        if not len(self.keys):
            return np.zeros(0, np.int64)
        near = np.searchsorted(self.keys, values)
        near[near == len(self.keys)] = 0
        return np.flatnonzero(self.keys[near] == values)


def aligned(template, words, band=BAND):
    """(matched words, first, behind the last matched word) of the best alignment of a template in a window of words.

    Cells more than ``band`` off the diagonals that the window leaves room for are not looked at. A match counts 1; of equal
    counts, the alignment over fewer words of the window is taken. Words left out on either side cost nothing.
    """
    n, m = len(template), len(words)
    slack = band + max(m - n, 0)
    none = (0, 0, 0)
    # the best is (matches, minus words spanned); each cell also keeps where its first match is
    before = [none] * (m + 1)
    best = none
    for i in range(1, n + 1):
        row = [none] * (m + 1)
        for j in range(max(1, i - band), min(m, i + slack) + 1):
            here = max(before[j], row[j - 1], key=lambda c: (c[0], c[1]))
            if template[i - 1] == words[j - 1]:
                count, first, _ = before[j - 1]
                start = first if count else j - 1
                hit = (count + 1, start, j)
                if (hit[0], hit[1]) > (here[0], here[1]):
                    here = hit
            row[j] = here
        before = row
        best = max([best, *row], key=lambda c: (c[0], c[1] - c[2]))
    return best


def matches_by(template, hits, hashes, low, high, least):
    """(matched words, first word, word behind the last) of the matches of a template between two words, in order.

    ``hits`` are sorted (diagonal, word) of the template's fingerprints; ``least`` words have to match.
    """
    found = []
    i = 0
    while i < len(hits):
        # diagonals close to one another are one candidate
        j = i
        while j + 1 < len(hits) and hits[j + 1][0] - hits[i][0] <= BAND:
            j += 1
        a, b = max(hits[i][0] - BAND, low), min(hits[j][0] + len(template) + BAND, high)
        matched, first, end = aligned(template, hashes[a:b].tolist()) if a < b else (0, 0, 0)
        if not matched or matched < least:
            i = j + 1
            continue
        first, end = a + first, a + end
        # neighbouring copies share a candidate: less alike ones before the match are looked for in front of it,
        # and hits behind the match go on as candidates
        before = [h for h in hits[i : j + 1] if h[1] + GRAM <= first]
        found += matches_by(template, before, hashes, low, first, least)
        found.append((matched, first, end))
        low = end
        behind = [h for h in hits[i : j + 1] if h[1] >= end]
        i = j + 1 - len(behind)
        hits[i : j + 1] = behind
    return found


def scan(index, chunk, coverage=COVERAGE):
    """(text, template, matched words, first byte, byte behind the last) of the templates that a chunk's texts hold."""
    hashes = chunk.hashes()
    at, value = chunk.windows(hashes, GRAM)
    hits = defaultdict(list)
    for i in index.places(value):
        for number, place in index.postings[int(value[i])]:
            word = int(at[i])
            hits[int(chunk.doc[word]), number].append((word - place, word))
    found = []
    for (doc, number), own in sorted(hits.items()):
        template = index.words[number].tolist()
        low, high = int(chunk.first[doc]), int(chunk.first[doc + 1])
        for matched, first, end in matches_by(template, sorted(own), hashes, low, high, coverage * len(template)):
            found.append((doc, number, matched, int(chunk.starts[first] - chunk.at[doc]), int(chunk.ends[end - 1] - chunk.at[doc])))
    return found


MATCHES = "array<struct<license: string, matched: int, coverage: double, start: int, stop: int>>"


def _matches(templates, coverage):
    def matches(text: pa.Array) -> pa.Array:
        index = TemplateIndex(templates)
        out = [[] for _ in range(len(text))]
        batch, size, start = [], 0, 0

        def flush():
            with np.errstate(over="ignore"):
                chunk = Chunk([t.translate(_WORDS) for t in batch])
                for doc, number, matched, a, b in scan(index, chunk, coverage):
                    before = batch[doc][:a].decode("utf-8", "replace")
                    inside = batch[doc][a:b].decode("utf-8", "replace")
                    out[start + doc].append(
                        {
                            "license": index.names[number],
                            "matched": matched,
                            "coverage": matched / len(index.words[number]),
                            "start": len(before),
                            "stop": len(before) + len(inside),
                        }
                    )

        for i in range(len(text)):
            data = text[i].as_py() or b""
            if batch and size + len(data) > CHUNK_BYTES:
                flush()
                batch, size, start = [], 0, i
            batch.append(data)
            size += len(data) + 1
        if batch:
            flush()
        kind = pa.struct(
            [("license", pa.string()), ("matched", pa.int32()), ("coverage", pa.float64()), ("start", pa.int32()), ("stop", pa.int32())]
        )
        return pa.array(out, pa.list_(kind))

    return matches


def license_spans(df, text="text", templates=None, coverage=COVERAGE, carry=None):
    """``row`` (struct of the columns ``carry``, all by default) and a match per row: ``license``, ``matched`` (words of the
    template found in order), ``coverage`` (their share), ``start`` and ``stop`` (code points of the text).

    Words are runs of letters, digits and other characters, A to Z in lower case; punctuation and case don't count. The text's
    runs of GRAM words are looked up among the winnowed fingerprints of the templates, each hit names a template and a diagonal, and the words
    about it are aligned with the template within BAND words. A match has at least ``coverage`` of the template; matches of
    one template don't overlap, and copies next to each other are a match each. The whole text is read. NULL and empty texts match nothing; equal texts have equal matches.
    """
    templates = TEMPLATES if templates is None else templates
    if sum(len(t.split()) for t in templates.values()) > LARGEST:
        raise ValueError("the templates are too large to be sent to every executor")
    row = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)])
    found = F.arrow_udf(_matches(templates, coverage), MATCHES)(F.col(text).cast("binary"))
    return df.select(row.alias("row"), F.inline(found))
