"""The stored wide accounts: equal to the full pivot after any deliveries, from the new facts alone."""

import random

import pytest

from rollbook.fixed_values import REGISTERED_NUMBER_LABEL, WIDE_ACCOUNTS
from rollbook.operators import merge_partials, partial_facts, pivot_facts, pivot_partials, read_refreshed, refresh
from rollbook.plans import read_wide_accounts, refresh_wide_accounts, wide_accounts
from rollbook.sources import current_version
from tests.conftest import rows

SCHEMA = "company_number string, end_date string, label string, value string, seq bigint"


def some_facts(seed, n):
    r = random.Random(seed)
    labels = [label for _, label, _ in WIDE_ACCOUNTS] + [REGISTERED_NUMBER_LABEL, "other"]
    values = ["1", "-2", "3,000.5", "text", None, "", "2020-02-01", "c1", "c2"]
    return [(r.choice(["c1", "c2", None]), r.choice(["2020-01-01", None]), r.choice(labels), r.choice(values), seed * 10_000 + i) for i in range(n)]


@pytest.mark.parametrize("consistent", [None, (REGISTERED_NUMBER_LABEL, "company_number")])
def test_merged_partials_equal_the_pivot(spark, consistent):
    keys = ["company_number", "end_date"]
    parts = [spark.createDataFrame(some_facts(seed, 150), SCHEMA) for seed in range(3)]
    partials = [partial_facts(p, keys, consistent=consistent) for p in parts]
    both = partials[0].unionByName(partials[1])
    every = merge_partials(both, keys).unionByName(partials[2])
    expected = pivot_facts(parts[0].unionByName(parts[1]).unionByName(parts[2]), keys, consistent=consistent)
    assert rows(pivot_partials(every, keys, consistent=bool(consistent))) == rows(expected)


def test_a_refresh_reads_the_new_facts_only(spark, tmp_path):
    folder, facts, companies = str(tmp_path / "view"), [], spark.createDataFrame([("c1", "PC1")], "number string, postcode string")
    for n in range(12):
        new = some_facts(n, 40)
        facts += new
        delivered = spark.createDataFrame(new, SCHEMA)
        assert refresh_wide_accounts(spark, folder, delivered, f"d{n}") == n
        # the same delivery again is known
        assert refresh_wide_accounts(spark, folder, delivered, f"d{n}") == n
        parts = current_version(spark, folder)[1]
        sizes = [p.n_rows for p in parts if p.kind == "partials"]
        # what a refresh stores comes from its own facts, and parts are merged so that they stay few
        assert next(p.n_rows for p in parts if p.part == f"d{n}") <= len(new) and len(sizes) <= 8
    everything = spark.createDataFrame(facts, SCHEMA)
    for short in (True, False):
        assert rows(read_wide_accounts(spark, folder, companies, short)) == rows(wide_accounts(everything, companies, short))


def test_refresh_never_overwrites(spark, tmp_path):
    folder = str(tmp_path / "stored")
    old = refresh(spark.createDataFrame([(1,)], "n int"), folder)
    new = refresh(spark.createDataFrame([(2,), (3,)], "n int"), folder)
    assert rows(old) == [(1,)] and rows(new) == [(2,), (3,)] == rows(read_refreshed(spark, folder, new.schema))
