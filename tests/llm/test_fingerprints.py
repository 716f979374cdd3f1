import hashlib
import re

import pytest
from pyspark.sql import functions as F

from rollbook.llm import QUERIES
from rollbook.llm.fingerprints import PIECE_WORDS, digests, edited, fingerprint, stored_difference, with_difference, with_likeness, with_next

PIECE = re.compile(r"(?:[^\x20\x09-\x0D]+[\x20\x09\x0B-\x0D]*){1,%d}" % PIECE_WORDS)


def likeness(a, b):
    a, b = set(PIECE.findall(a)), set(PIECE.findall(b))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_documents_equal_brute_force(spark, data, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    ids = sorted(texts, reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    rows = QUERIES["op3_paragraph_sketches"](spark, data).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        text, other = texts[r.doc_id], texts[after[r.doc_id]]
        third = len(text) // 3
        new = text[: len(text) - third] + other[:third]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.near_edited == pytest.approx(likeness(text, new))
        assert r.near_next == pytest.approx(likeness(text, other))
    by_text = {}
    for r in rows:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
    assert len(set(by_text.values())) == len(by_text)


def test_larger_sketches_where_much_differs(spark):
    """From nothing in common to all, with up to 2,000 paragraphs that differ."""
    cases = []
    for n in (1, 10, 40, 300, 2000):
        for shared in (0, n // 2, n):
            left = [f"line {i} {n}" for i in range(n)]
            right = left[:shared] + [f"other {i}" for i in range(n - shared)]
            cases.append(("\n".join(left), "\n".join(right), shared / (2 * n - shared)))
    df = spark.createDataFrame(cases, "a string, b string, like double")
    df = df.select("like", digests(F.col("a")).alias("x"), digests(F.col("b")).alias("y"))
    for r in with_likeness(df, "x", "y", "found").collect():
        assert r.found == pytest.approx(r.like)


def test_odd_rows(odd):
    out = with_next(odd.filter("length(coalesce(text, '')) < 50000"))
    out = out.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    out = with_likeness(out, "values", "next_values", "like").withColumn("mark", fingerprint("values"))
    rows = out.collect()
    assert len(rows) == odd.filter("length(coalesce(text, '')) < 50000").count()
    assert all(r.next_text is not None and r.like == pytest.approx(likeness(r.text, r.next_text)) for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, r.mark) == r.mark


def test_no_rows_and_one_row(spark, odd):
    assert with_next(odd.limit(0)).collect() == []
    one = spark.createDataFrame([(1, "a b c")], "doc_id bigint, text string")
    assert with_next(one).first().next_text == "a b c"


def test_next_over_many_runs(spark):
    df = spark.range(5000).select((F.col("id") * 7 % 5000 * 3).alias("doc_id"), F.concat(F.lit("t"), (F.col("id") * 7 % 5000 * 3).cast("string")).alias("text"))
    for r in with_next(df).select("id", "next_text").collect():
        assert r.next_text == f"t{(r.id - 3) % 15000}"


def test_an_edit_at_the_end_leaves_pieces_of_a_short_text(spark):
    words = [f"w{i:02}" for i in range(47)]
    cases = [(" ".join(words[:n]), " ".join(["other"] * 60)) for n in range(26, 48)]
    df = spark.createDataFrame(cases, "a string, b string").withColumn("b", edited(F.col("a"), F.col("b")))
    df = df.select("a", digests(F.col("a")).alias("x"), digests(F.col("b")).alias("y"))
    assert all(r.near > 0 for r in with_likeness(df, "x", "y", "near").collect())


def lines(names):
    return "\n".join(names)


def test_differing_digests_of_each_side(spark):
    cases = []
    for n in (0, 1, 9, 70, 600):
        for gone, new in ((0, 0), (1, 0), (0, 3), (n // 2, n // 3), (n, n)):
            left = [f"line {i} of {n}" for i in range(n)]
            cases.append((lines(left), lines(left[gone:] + [f"new {i}" for i in range(new)])))
    df = spark.createDataFrame(cases, "a string, b string")
    df = df.select(digests(F.col("a")).alias("x"), digests(F.col("b")).alias("y"))
    rows = with_difference(df, "x", "y", "d").collect()
    assert len(rows) == len(cases)
    for r in rows:
        assert sorted(r.d.left_only) == sorted(set(r.x) - set(r.y)) and sorted(r.d.right_only) == sorted(set(r.y) - set(r.x))


def test_query_returns_the_differing_digests(spark, data):
    for r in QUERIES["op3_paragraph_sketches"](spark, data).collect():
        assert bool(r.from_edited.left_only or r.from_edited.right_only) == (r.near_edited < 1)
        assert bool(r.from_next.left_only or r.from_next.right_only) == (r.near_next < 1)


def test_stored_fingerprints_are_subtracted(spark):
    """Also of texts with more than 255 lines in a cell."""
    cases = []
    for n in (0, 5, 300, 5000):
        left = [f"line {i} of {n}" for i in range(n)]
        cases += [(lines(left), lines(left)), (lines(left), lines(left[2:] + ["new 1", "new 2", "new 3"])), (lines([*left, "old"]), lines(left))]
    cases.append((lines(f"one {i}" for i in range(500)), lines(f"two {i}" for i in range(500))))
    df = spark.createDataFrame(cases, "a string, b string")
    df = df.select("a", digests(F.col("a")).alias("x"), digests(F.col("b")).alias("y"))
    df = df.withColumn("p", fingerprint("x")).withColumn("q", fingerprint("y"))
    rows = df.withColumn("d", stored_difference("p", "q")).collect()
    assert [r.d.whole for r in rows] == [not r.a.startswith("one") for r in rows]
    for r in rows:
        if r.d.whole:
            assert sorted(r.d.left_only) == sorted(set(r.x) - set(r.y)) and sorted(r.d.right_only) == sorted(set(r.y) - set(r.x))
