import random
import re

import numpy as np
import pytest

from rollbook.llm import QUERIES
from rollbook.llm.label_model import fit
from rollbook.llm.quality import BASE, posteriors, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = {}
    for i, w in enumerate(windows):
        seen.setdefault(w, []).append(i)
    covered = {i + j for at in seen.values() if len(at) > 1 for i in at for j in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def check(rows, texts):
    for r in rows:
        base = base_counts(texts[r.doc_id])
        assert tuple(r[c] for c in BASE) == base
        assert r.base_failed == (base[0] < 20 or 100 * base[4] > 30 * base[0])
        assert not (r.kept and r.base_failed)


def test_base_counts_equal_brute_force(spark, data, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = QUERIES["op10_quality_rules"](spark, data).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_verdict_follows_the_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op10_quality_rules"](spark, folder).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    bad = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(r.kept for r in bad) <= 0.05 * len(bad)


def test_odd_rows(odd):
    out = quality(odd).select("row.*", *[f"`{c}`" for c in BASE], "base_failed", "kept").collect()
    assert len(out) == odd.count() and out[0].asDict().keys() > set(odd.columns)
    for r in out:
        assert tuple(r[c] for c in BASE) == base_counts(r.text)


def test_verdict_does_not_hang_on_length(spark):
    """One word over and over gets the same votes at any length, and prose the same as a tenth of it."""
    same = [(n, "word " * n) for n in (1000, 1999, 2000, 2001, 40_000)]
    r = random.Random(5)
    prose = [" ".join(str(r.randrange(5000)) + "th" for _ in range(n)) for n in (1000, 2000, 2001, 10_000)]
    df = spark.createDataFrame([(i, t) for i, t in same] + [(-i, t) for i, t in enumerate(prose, 1)], "doc_id bigint, text string")
    rows = quality(df).select("row.doc_id", "posterior").collect()
    for sign in (True, False):
        assert len({x.posterior for x in rows if (x.doc_id > 0) == sign}) == 1


def test_empty_table(odd):
    assert quality(odd.limit(0)).collect() == []


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    right = [0.95, 0.9, 0.8, 0.7]
    votes = np.stack([np.where(rng.random(len(truth)) < a, truth, ~truth) + 1 for a in right], axis=1)
    votes[rng.random(votes.shape) < 0.2] = 0
    votes = np.concatenate((votes, votes[:, 3:4]), axis=1)  # a voter that repeats the worst one
    start = np.where((votes == 2).sum(axis=1) > (votes == 1).sum(axis=1), 0.8, 0.2)
    model = fit(votes, np.ones(len(votes)), start)
    assert model.prior == pytest.approx(0.3, abs=0.05)
    assert model.parent[4] == 3
    assert model.accuracies()[:4] == pytest.approx(right, abs=0.05)
    guess = model.posterior(votes) > 0.5
    assert (guess == truth).mean() > 0.93


def test_posteriors_without_rows():
    assert posteriors([]) == []
