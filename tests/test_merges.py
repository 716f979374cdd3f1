"""Conflict rules, repeats and idempotence."""

import random

from pyspark.sql import functions as F

from rollbook.operators import (
    add_parents,
    drop_exact,
    insert_new,
    largest_absolute,
    merge_maps,
    pivot_facts,
    relabel_all_or_none,
    replace_documents,
    signed_extreme,
    upsert,
    upsert_largest,
)
from tests.conftest import rows


def test_insert_new_first_wins_and_twice_is_once(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    src = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "k string, v int")
    once = insert_new(target, src, "k", F.col("v"))
    assert rows(once) == [("a", 1), ("b", 2)]
    assert rows(insert_new(once, src, "k", F.col("v"))) == rows(once)


def test_upsert_named_columns_only(spark):
    target = spark.createDataFrame([("a", "old", "UK"), ("b", "old", "UK")], "k string, n string, o string")
    src = spark.createDataFrame([("a", None, "FR"), ("c", "new", "FR")], target.schema)
    once = upsert(target, src, "k", ["n"], ["o"])
    assert rows(once) == sorted([("a", None, "UK"), ("b", "old", "UK"), ("c", "new", "FR")], key=str)
    assert rows(upsert(once, src, "k", ["n"], ["o"])) == rows(once)


def test_largest_absolute_rule_against_brute_force(spark):
    rng = random.Random(11)
    values = ["5", "-5", "-29951", "29949", "text", "1,000", "other", "0", "5.0"]
    data = [(rng.randrange(30), rng.choice(values), i) for i in range(400)]
    expected = {}
    for k, v, _ in data:
        if k not in expected:
            expected[k] = v
            continue
        try:
            new, old = (abs(float(x.replace(",", ""))) for x in (v, expected[k]))
        except ValueError:
            continue
        if new > old:
            expected[k] = v
    df = spark.createDataFrame(data, "k int, v string, seq int").repartition(5)
    got = largest_absolute(df, "k", "v", F.col("seq"))
    assert {r.k: r.v for r in got.collect()} == expected


def test_upsert_largest_target_first(spark):
    target = spark.createDataFrame([("a", "10", 5), ("t", "word", 5)], "k string, v string, seq int")
    src = spark.createDataFrame([("a", "-10", 1), ("a", "-11", 2), ("t", "9", 1)], target.schema)
    got = upsert_largest(target, src, "k", "v", F.col("seq")).select("k", "v")
    assert rows(got) == [("a", "-11"), ("t", "word")]


def test_signed_extreme(spark):
    df = spark.createDataFrame([("a", 2), ("a", -29951), ("a", -29949), ("b", 7), ("b", -3)], "k string, v int")
    got = df.groupBy("k").agg(signed_extreme(F.col("v")).alias("v"))
    assert rows(got) == [("a", -29951), ("b", 7)]


def test_pivot_has_one_row_per_key(spark):
    facts = spark.createDataFrame(
        [("1", "d", "Equity", "2", 0), ("1", "d", "Equity", "-29,951", 1),
         ("1", "d", "Name of entity accountants", "B", 3), ("1", "d", "Name of entity accountants", "A", 2),
         ("2", "d", "Balance sheet date", "2021-05-31", 0), ("2", "d", "Unknown", "x", 1)],
        "company_number string, end_date string, label string, value string, seq int",
    )
    got = pivot_facts(facts, ["company_number", "end_date"])
    got = got.select("company_number", F.col("equity").cast("int"), "accountants", F.col("balance_sheet_date").cast("string"))
    assert rows(got) == sorted([("1", -29951, "A", None), ("2", None, None, "2021-05-31")], key=str)


def test_other_merges(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    src = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert rows(replace_documents(target, src, "k", F.col("v"))) == [("a", 1), ("b", 2), ("c", 2)]
    assert rows(add_parents(src, target, "k")) == [("a", 1), ("b", 1), ("c", None)]
    maps = merge_maps(
        spark.createDataFrame([("x", "1"), ("y", "1")], "key string, value string"),
        spark.createDataFrame([("y", "2"), ("z", "2")], "key string, value string"),
    )
    assert rows(maps) == [("x", "1"), ("y", "2"), ("z", "2")]
    twice = target.unionByName(target)
    assert rows(drop_exact(twice, ["k", "v"], F.col("v"))) == rows(drop_exact(drop_exact(twice, ["k", "v"], F.col("v")), ["k", "v"], F.col("v")))


def test_relabel_rejects_whole_documents(spark):
    docs = spark.createDataFrame(
        [("good", 0, {"n:A": "m:X", "n:B": "None"}), ("good", 1, None),
         ("bad", 0, {"n:A": "m:X"}), ("bad", 1, {"n:A": "m:missing"}), ("worse", 0, {"n:C": "m:X"})],
        "document string, position int, dimensions map<string,string>",
    )
    dims = spark.createDataFrame(
        [("A", "(via targetRole) x-Alpha [dimension]"), ("B", "Beta [dimension]"), ("C", "no label"), ("X", "Member X")],
        "key string, value string",
    )
    good, bad = relabel_all_or_none(docs, dims)
    assert {(r.document, r.position): r.additional_info for r in good.collect()} == {
        ("good", 0): {"Alpha": "Member X", "Beta": "None"},
        ("good", 1): None,
    }
    assert rows(bad) == [("bad",), ("worse",)]
