"""Operators on data in which one key holds a third of all rows, against brute force."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rollbook.fixed_values import REGISTERED_NUMBER_LABEL
from rollbook.operators import (
    append_values,
    band_join,
    distinct_values,
    list_values,
    nest_facts,
    only_values,
    rolling_count,
    rolling_mean,
    running_mean,
    value_map,
    with_first_seen,
    with_position,
    with_previous,
)
from rollbook.plans import account_officers, wide_accounts
from tests.conftest import rows

N = 900


@pytest.fixture(scope="module")
def data_rows():
    rng = random.Random(5)
    out = []
    for i in range(N):
        key = "hot" if i < N // 3 else f"k{rng.randrange(40)}"
        out.append((key, i, rng.randrange(2000), rng.choice(["a", "b", None, "c"])))
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def skewed(spark, data_rows):
    df = spark.createDataFrame(data_rows, "k string, at bigint, v bigint, s string")
    return df.withColumn("ts", F.timestamp_seconds(F.col("at") * 7)).repartition(6)


def by_key(data_rows):
    groups = defaultdict(list)
    for r in sorted(data_rows, key=lambda r: r[1]):
        groups[r[0]].append(r)
    return groups


def segment():
    return F.floor(F.col("at") / 10)


def test_with_previous(skewed, data_rows):
    expected = []
    for k, group in by_key(data_rows).items():
        before = None
        for r in group:
            expected.append((k, r[1], before is not None, *(before or (None, None))))
            before = (r[2], r[3])
    got = with_previous(skewed, "k", "at", ["v", "s"], segment())
    got = got.select("k", "at", "has_previous", "previous_v", "previous_s")
    assert rows(got) == sorted(expected, key=str)


def test_with_first_seen_keeps_a_null(skewed, data_rows):
    expected = [(r[1], group[0][3]) for group in by_key(data_rows).values() for r in group]
    got = with_first_seen(skewed, "k", "at", ["s"]).select("at", "first_s")
    assert rows(got) == sorted(expected, key=str)


def test_position(skewed, data_rows):
    expected = [(r[1], i) for group in by_key(data_rows).values() for i, r in enumerate(group)]
    got = with_position(skewed, "k", "at", segment()).select("at", "position")
    assert rows(got) == sorted(expected, key=str)


@pytest.mark.parametrize("n", [1, 5, 60])
def test_rolling_mean(skewed, data_rows, n):
    expected = {}
    for group in by_key(data_rows).values():
        for i, r in enumerate(group):
            part = [x[2] for x in group[max(0, i - n + 1) : i + 1]]
            expected[r[1]] = sum(part) / len(part)
    got = rolling_mean(skewed, "k", "at", "v", n, segment(), block=7).collect()
    assert len(got) == N
    assert all(abs(r.rolling_mean - expected[r["at"]]) < 1e-9 for r in got)


def test_rolling_count(skewed, data_rows):
    expected = {}
    for group in by_key(data_rows).values():
        for r in group:
            expected[r[1]] = sum(1 for x in group if 0 <= (r[1] - x[1]) * 7 <= 70)
    got = rolling_count(skewed, "k", "ts", 70, block=9).collect()
    assert {r["at"]: r.rolling_count for r in got} == expected


def test_rolling_count_of_rows_without_key_or_time(spark, data_rows):
    """A third of the rows have no key, some no time; also with two keys."""
    cases = [(None if r[0] == "hot" else r[0], r[1], None if r[1] % 50 == 0 else r[1] * 7, r[3]) for r in data_rows]
    df = spark.createDataFrame(cases, "k string, at bigint, t bigint, s string")
    df = df.withColumn("ts", F.timestamp_seconds("t")).repartition(6)
    for key in (["k"], ["k", "s"]):
        groups = defaultdict(list)
        for r in cases:
            groups[(r[0], r[3])[: len(key)]].append(r[2])
        expected = {}
        for r in cases:
            group = groups[(r[0], r[3])[: len(key)]]
            inside = [t for t in group if (t is None if r[2] is None else t is not None and 0 <= r[2] - t <= 70)]
            expected[r[1]] = len(inside)
        got = rolling_count(df, key, "ts", 70, block=9).collect()
        assert len(got) == N and {r["at"]: r.rolling_count for r in got} == expected


def test_lists_of_rows_without_key(spark, data_rows):
    cases = [(None if r[0] == "hot" else r[0], REGISTERED_NUMBER_LABEL, str(r[2])) for r in data_rows]
    df = spark.createDataFrame(cases, "k string, label string, value string").repartition(6)
    for got, kind in ((list_values(df, ["k"], "value"), list), (distinct_values(df, ["k"], REGISTERED_NUMBER_LABEL, "value"), set)):
        expected = [(k, i, v) for k in {c[0] for c in cases} for i, v in enumerate(sorted(kind(c[2] for c in cases if c[0] == k)))]
        assert rows(got) == sorted(expected, key=str)


def test_running_mean(skewed, data_rows):
    expected = {}
    for group in by_key(data_rows).values():
        total = 0
        for i, r in enumerate(group):
            total += r[2]
            expected[r[1]] = total / (i + 1)
    got = running_mean(skewed, "k", "at", "v", segment()).collect()
    assert len(got) == N
    assert all(abs(r.running_mean - expected[r["at"]]) < 1e-9 for r in got)


def test_band_join(spark, skewed, data_rows):
    scans = [("hot", i * 50) for i in range(1, 40)] + [("k1", 10), ("gone", 5)]
    b = spark.createDataFrame(scans, "k string, c bigint").withColumn(
        "seen", F.timestamp_seconds("c")
    )
    expected = [
        (r[0], r[1], c)
        for r in data_rows
        for k, c in scans
        if k == r[0] and abs(r[1] * 7 - c) <= 3
    ]
    for width in (3, 6, 60, 100_000):
        got = band_join(skewed, b, "k", "ts", "seen", 3, width).select("k", "at", "c")
        assert rows(got) == sorted(expected, key=str)
    plan = band_join(skewed, b, "k", "ts", "seen", 3)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_lists_of_a_hot_key(skewed, data_rows):
    got = list_values(skewed, ["k"], "at")
    seen = defaultdict(list)
    for r in got.collect():
        seen[r.k].append((r.position, r.value))
    assert {k: sorted(v) for k, v in seen.items()} == {
        k: list(enumerate(sorted(r[1] for r in g))) for k, g in by_key(data_rows).items()
    }


def test_lists_keep_repeats_and_drop_nulls(skewed, data_rows):
    got = list_values(skewed, ["k"], "s")
    seen = defaultdict(list)
    for r in got.collect():
        seen[r.k].append((r.position, r.value))
    assert {k: sorted(v) for k, v in seen.items()} == {
        k: list(enumerate(sorted(r[3] for r in g if r[3] is not None)))
        for k, g in by_key(data_rows).items()
        if any(r[3] is not None for r in g)
    }


def test_append_values(spark):
    target = spark.createDataFrame([("a", 0, "x")], "k string, o int, v string")
    src = spark.createDataFrame([("a", 2, "z"), ("a", 1, "y"), ("b", 1, "n")], target.schema)
    got = append_values(target, src, "k", "v", "o")
    assert rows(got) == [("a", 0, "x", 0), ("a", 1, "y", 1), ("a", 2, "z", 1), ("b", 1, "n", 1)]


def test_nested_documents_of_any_size(spark):
    facts = spark.range(95).select(
        F.lit("d").alias("document"), F.col("id").alias("position"), F.col("id").alias("value")
    )
    documents, nested = nest_facts(facts, ["document"])
    assert rows(documents) == [("d", 95)]
    assert sorted((r.position, r.value) for r in nested.collect()) == [(i, i) for i in range(95)]


def test_one_wide_row_for_a_filing_with_very_many_officers(spark):
    many = spark.range(120_000).select(
        F.lit("00000001").alias("company_number"), F.lit("2020-01-31").alias("end_date"),
        F.lit("Name of entity officer").alias("label"), F.concat(F.lit("P"), "id").alias("value"),
        F.col("id").alias("seq"),
    )
    few = spark.createDataFrame(
        [("00000001", "2020-01-31", "Equity", "5", -1),
         ("00000001", "2020-01-31", REGISTERED_NUMBER_LABEL, "00000001", -2),
         ("00000002", "2020-01-31", "Equity", "7", -3)],
        "company_number string, end_date string, label string, value string, seq bigint",
    )
    facts = many.unionByName(few)
    companies = spark.createDataFrame([("00000001", "AB1")], "number string, postcode string")
    (wide,) = wide_accounts(facts, companies).collect()
    assert (wide.company_number, int(wide.equity), wide.post_code) == ("00000001", 5, "AB1")
    officers = account_officers(facts)
    assert officers.count() == 120_000 and officers.agg(F.max("position")).first()[0] == 119_999


def test_value_map_last_wins(spark):
    facts = spark.createDataFrame(
        [("d", "Equity", "2021", 0, "2"), ("d", "Equity", "2021", 1, "-29951"),
         ("d", "Equity", "2021", 2, "-29949"), ("d", "Equity", "2020", 3, "7")],
        "document string, label string, end_date string, position int, value string",
    )
    assert rows(value_map(facts, "document").drop("document", "label")) == [("2020", "7"), ("2021", "-29949")]


@pytest.mark.parametrize(
    "dates, expected",
    [(["2021"], "v0"), (["2021", "2020"], None), (["2022", "2020"], "v0"), ([None], "v0"), ([None, "2021"], None)],
)
def test_only_value(spark, dates, expected):
    """The accounts are of 2022; no date at all is a date of its own."""
    facts = spark.createDataFrame(
        [("d", "Equity", d, i, f"v{i}") for i, d in enumerate(dates)],
        "document string, label string, end_date string, position int, value string",
    )
    accounts = spark.createDataFrame([("d", "2022")], "document string, accounts_date string")
    assert only_values(facts, accounts, "document").first().value == expected


def test_distinct_values_of_a_large_filing(spark):
    facts = spark.range(500).select(
        F.lit("c").alias("company_number"),
        F.lit("Name of entity officer").alias("label"),
        F.concat(F.lit("P"), F.col("id") % 100).alias("value"),
    )
    got = distinct_values(facts, ["company_number"]).collect()
    assert sorted((r.position, r.officer) for r in got) == list(enumerate(sorted(f"P{i}" for i in range(100))))


def test_windows_take_null_as_a_key(spark, data_rows):
    """All five window operators: a third of the rows has no key, and they are a group like any other."""
    unkeyed = [(None if r[0] == "hot" else r[0], *r[1:]) for r in data_rows]
    df = spark.createDataFrame(unkeyed, "k string, at bigint, v bigint, s string").repartition(6)
    groups = by_key(unkeyed)
    before, first, place, mean, rolling = {}, {}, {}, {}, {}
    for own in groups.values():
        for i, r in enumerate(own):
            before[r[1]] = own[i - 1][2] if i else None
            first[r[1]], place[r[1]] = own[0][2], i
            mean[r[1]] = sum(x[2] for x in own[: i + 1]) / (i + 1)
            window = [x[2] for x in own[max(0, i - 3) : i + 1]]
            rolling[r[1]] = sum(window) / len(window)
    got = {r.at: r.previous_v for r in with_previous(df, "k", "at", ["v"], segment()).collect()}
    assert got == before
    assert {r.at: r.first_v for r in with_first_seen(df, "k", "at", ["v"]).collect()} == first
    assert {r.at: r.position for r in with_position(df, "k", "at", segment()).collect()} == place
    found = {r.at: r.rolling_mean for r in rolling_mean(df, "k", "at", "v", 4, segment(), block=10).collect()}
    assert found.keys() == rolling.keys() and all(abs(found[a] - rolling[a]) < 1e-9 for a in found)
    found = {r.at: r.running_mean for r in running_mean(df, "k", "at", "v", segment()).collect()}
    assert found.keys() == mean.keys() and all(abs(found[a] - mean[a]) < 1e-9 for a in found)
