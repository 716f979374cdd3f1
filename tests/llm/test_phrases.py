import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollbook.llm.phrases import Pieces, Tries, collocations, frequent_phrases

from .conftest import prose


def brute(rows, longest, least, covered, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)))
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", low):
            w = tuple(re.findall(rb"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, w[i : i + k]) for i in range(len(w) - k + 1))
    cands = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, w), a in cands.items():
        inside = lambda v: any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))  # noqa: B023, E731
        if any(o == lang and len(v) > len(w) and 100 * b >= covered * a and inside(v) for (o, v), b in cands.items()):
            continue
        cuts = [(1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, l, r = min(cuts)
        out.setdefault(lang, []).append((-score, -a, b" ".join(w), l, r))
    return [
        (lang, i + 1, phrase.decode(), -a, l, r, n[lang], -score)
        for lang, own in out.items() for i, (score, a, phrase, l, r) in enumerate(sorted(own)[:top])
    ]


def mixture(seed, words):
    r = np.random.default_rng(seed)
    vocabulary = ["a", "b", "the", "Über", "x y", "c", "d", "e", "f", "."]
    return "".join(vocabulary[i] + r.choice([" ", " ", " ", "\t", ", ", "\n", "  "]) for i in r.zipf(1.5, words) % len(vocabulary))


ROWS = [*[("en" if i % 3 else "de", mixture(i, 60)) for i in range(40)], (None, mixture(99, 300)), ("und", mixture(98, 300)), ("en", None), (None, ""), ("fr", "one two")]
ROWS += [("en", prose(1, 12) + " end")] * 12


@pytest.mark.parametrize(("longest", "least", "trie_bytes"), [(3, 10, 1 << 20), (3, 3, 200), (4, 5, 1 << 20), (2, 1, 5000)])
def test_equals_brute_force(spark, longest, least, trie_bytes):
    df = spark.createDataFrame(ROWS, "lang string, text string").repartition(3)
    df = df.withColumns({c: F.lit("own") for c in ("word", "n", "id", "phrase", "key", "h0")})
    got = collocations(df, longest=longest, least=least, top=50, trie_bytes=trie_bytes)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(ROWS, longest, least, 50, 50))


def test_double_array_has_every_edge():
    r = np.random.default_rng(3)
    words = [f"w{i}".encode() for i in range(300)]
    phrases = sorted({b" ".join(words[j] for j in np.minimum(r.zipf(1.2, r.integers(2, 5)), 299)) for _ in range(20_000)})
    langs = [["x", "y"][i % 2] for i in range(len(phrases))]
    tries = Tries(langs, phrases)
    counts = np.zeros(len(phrases), np.int64)
    chosen = r.integers(0, len(phrases), 500)
    for lang in ("x", "y", "z"):
        p = Pieces([lang] * len(chosen), [phrases[i] for i in chosen])
        tries.count(p, 4, counts)
    expected = Counter()
    for i in chosen:
        w = phrases[i].split(b" ")
        expected.update(b" ".join(w[a:b]) for a in range(len(w)) for b in range(a + 2, len(w) + 1))
    # every phrase belongs to one of the two languages, and each text was counted in both
    assert all(n == expected[phrase] for phrase, n in zip(phrases, counts))


def test_counts_are_exact_beyond_64_bits(spark):
    row = spark.createDataFrame([(3_000_000_000_000_000, 4_000_000_000_000_000)], "a bigint, l bigint")
    got = row.selectExpr("(CAST(a AS DECIMAL(38, 0)) * a * 1000000) div (CAST(l AS DECIMAL(38, 0)) * l) AS s").first().s
    assert got == 1_000_000 * 3**2 // 4**2


def test_odd_rows_and_empty_table(spark, odd):
    df = odd.withColumn("lang", F.col("source"))
    words, phrases = frequent_phrases(df, least=2)
    assert {r.lang for r in words.collect()} == {"a", "b", "c", "und"}
    assert phrases.filter("a < 2").count() == 0
    empty = collocations(df.limit(0))
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and empty.collect() == []
