import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rollbook.llm import QUERIES
from rollbook.llm.mixing import copies, mix, numbered, pivotal, shares, targets


def expected_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        want = {s: most * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and want[s] > most * sizes[s]}
        if not over:
            return want
        capped |= over


def check(rows, docs):
    sizes = defaultdict(int)
    for text, source in docs.values():
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want, taken, largest = expected_targets(sizes), Counter(), Counter()
    for r in rows:
        text, source = docs[r.doc_id]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)


def test_documents(spark, data, documents):
    docs = {r.doc_id: (r.text, r.source) for r in documents.collect()}
    rows = QUERIES["op9_pivotal_mix"](spark, data).collect()
    assert len(rows) == len(docs)
    check(rows, docs)
    assert sorted(rows) == sorted(QUERIES["op9_pivotal_mix"](spark, data).collect())


def test_capped_sources_and_a_hot_one(spark):
    """One source holds nearly all words, others are cut at three times their size."""
    texts = [(i, "w " * (i % 40 + 1), "hot") for i in range(6000)] + [(10_000 + i, "w w w", s) for i, s in enumerate("abcde")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, source string")
    rows = [r for r in shares(copies(df)).collect()]
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
    assert all(sum(r.copies for r in by_source[s]) == 3 for s in "abcde")
    hot = by_source["hot"]
    assert abs(sum(r.copies * r.size for r in hot) - hot[0].target) <= 40


def test_targets_without_words(spark):
    df = spark.createDataFrame([(None, 0), ("a", 0)], "source string, size bigint")
    assert [r.target for r in targets(df).collect()] == [0.0, 0.0]


def test_odd_rows(odd):
    units = copies(odd)
    rows = shares(units).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r.copies <= 3 for r in rows)
    mixed = mix(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.copies for r in rows)


def test_repeated_rows_are_shared_out(spark):
    df = spark.createDataFrame([(1, "a b c", "s")] * 5000 + [(2, "a b", "t")], "doc_id bigint, text string, source string")
    rows = shares(copies(df)).collect()
    assert len(rows) == 5001
    assert abs(sum(r.copies * r.size for r in rows if r.source == "s") - rows[0].target) <= 3 or rows[0].source == "t"
    assert mix(df).count() == sum(r.copies for r in rows)


def test_empty_table(odd):
    assert copies(odd.limit(0)).collect() == [] and mix(odd.limit(0)).collect() == []


def test_numbered_is_a_gapless_order(spark):
    df = spark.createDataFrame([(str(i * 37 % 500),) for i in range(500)], "source string")
    got = {r.source: r.place for r in numbered(df, "source", "numbered").collect()}
    assert [got[s] for s in sorted(got)] == list(range(500))


def test_pivotal_trades_between_two_rows_at_a_time():
    """A pair's mass stays in it; the last row stays open, or none."""
    for seed in range(50):
        out, left = pivotal(np.array([0.5, 0.25]), np.array([4.0, 2.0]), np.random.default_rng(seed))
        assert (list(out), left) in [([0.625, 0.0], 0), ([0.125, 1.0], 0)]
    assert pivotal(np.array([0.0, 0.3, 1.0]), np.ones(3), np.random.default_rng(0))[1] == 1
    assert pivotal(np.array([0.5, 0.5]), np.ones(2), np.random.default_rng(0))[1] == -1


def test_null_text_and_null_source_are_told_apart(spark):
    df = spark.createDataFrame([(1, "x", None), (1, None, "x")], "doc_id bigint, text string, source string")
    assert copies(df).count() == 2


def test_pivotal_keeps_the_sum_and_the_means():
    rng = np.random.default_rng(0)
    size = np.sort(rng.integers(1, 100, 30))[::-1].astype(float)
    p = rng.random(30)
    seen = np.zeros(30)
    for _ in range(4000):
        out, left = pivotal(p, size, rng)
        assert out @ size == pytest.approx(p @ size)
        assert all(x in (0, 1) for i, x in enumerate(out) if i != left)
        seen += out
    assert seen / 4000 == pytest.approx(p, abs=0.04)
