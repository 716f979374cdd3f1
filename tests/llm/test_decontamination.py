import re

from pyspark.sql import functions as F

from rollbook.llm.decontamination import benchmark_hits, decontaminate, hit_words

from .conftest import prose

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))


def brute(text, items, window=10):
    own, hit, named = words(text), set(), set()
    for item, other in items:
        w = words(other)
        k = min(window, len(w))
        for j in range(len(w) - k + 1) if k else ():
            for i in range(len(own) - k + 1):
                if own[i : i + k] == w[j : j + k]:
                    hit.update(range(i, i + k))
                    named.add(str(item))
    return len(own), sorted(hit), sorted(named)


P = [prose(i, 40) for i in range(6)]
ITEMS = [(1, P[0]), (2, "Short ITEM, of five words"), (3, "word"), (4, ""), (5, None), (6, P[0]), (7, "äö üß"), (None, P[1]), (10, P[2] + " " + P[0])]
TEXTS = [
    (1, P[0]), (2, "x " + P[0].upper().replace(" ", " ... ") + " y"), (3, P[3] + " short item of FIVE words! " + P[4]),
    (4, "a word"), (5, None), (6, ""), (7, P[1]), (8, " ".join(P[0].split()[:9])), (8, "Äö üß äö üß"), (9, "äö üß"), (9, P[2] * 50),
    (10, P[5] + " " + " ".join(P[0].split()[5:25]) + " word " + P[5] + " " + P[2]), (None, "\x00 word\x00word"),
]
SCHEMA = "doc_id bigint, text string"


def tables(spark):
    docs = spark.createDataFrame(TEXTS, SCHEMA)
    return docs.withColumns({c: F.lit(c) for c in ("row", "at", "h", "runs", "items", "words")}), spark.createDataFrame(ITEMS, "item_id bigint, text string")


def places(runs):
    return [p for r in runs for p in range(r["first"], r["first"] + r["size"])]


def test_equals_brute_force_in_one_and_in_many_blocks(spark):
    docs, items = tables(spark)
    known = [x for x in ITEMS if x[0] is not None]
    expected = sorted(map(str, [(i, *brute(t, known)) for i, t in TEXTS]))
    for size in (1 << 20, 300):
        found = benchmark_hits(docs, items, sent_bytes=size).collect()
        assert sorted(str((r.row.doc_id, r.n_words, places(r.runs), r["items"])) for r in found) == expected
        assert found[0].row.at == "at"


def test_runs_are_cut_out_and_documents_dropped(spark):
    docs, items = tables(spark)
    out = decontaminate(docs, items)
    assert out.columns == docs.columns and out.count() == len(TEXTS)
    texts = {r.text for r in out.collect()}
    assert {"", None, "x  y", "a ", P[3] + " ! " + P[4], P[1]} <= texts
    assert all(not brute(t, [x for x in ITEMS if x[0] in (1, 2, 3)])[1] for t in texts)
    kept = decontaminate(docs, items, drop_above=0)
    assert {r.text for r in kept.collect()} == {t for _, t in TEXTS if not brute(t, [x for x in ITEMS if x[0]])[1]}
    assert decontaminate(docs, items, drop_above=0.5).filter("doc_id = 10").count() == 1


def test_odd_rows_and_empty_tables(spark, odd):
    items = spark.createDataFrame([(1, "some words here"), (2, "one")], "item_id bigint, text string")
    found = benchmark_hits(odd, items).withColumn("n", hit_words())
    rows = found.collect()
    assert len(rows) == odd.count()
    known = [(1, "some words here"), (2, "one")]
    assert all((r.n_words, places(r.runs), r["items"]) == brute(r.row.text, known) and r.n == len(places(r.runs)) for r in rows)
    assert benchmark_hits(odd, items.limit(0)).filter(F.size("runs") > 0).count() == 0
    assert benchmark_hits(odd.limit(0), items).collect() == []
