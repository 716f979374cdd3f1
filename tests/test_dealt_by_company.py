"""Facts that are dealt out by company: no shuffle of facts behind that, and the same results."""

import pytest
from pyspark.sql import functions as F

from rollbook.operators import drop_exact, join_facts, largest_absolute, not_processed, with_position
from rollbook.operators.joins import join_near
from rollbook.registered import QUERIES, adapters


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def lines(spark, folder, rows):
    columns = (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    made = [(k, k, n % 3, n % 7, 1.0, 100.0 + n, 0.1, 0.2, "N", "O") for n, k in enumerate(rows)]
    df = spark.createDataFrame(made, columns.rsplit(",", 1)[0])
    df = df.withColumn("l_shipdate", F.timestamp_seconds(F.lit(800_000_000) + F.col("l_extendedprice") * 86400))
    df.write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_groupings_by_company_shuffle_no_facts(spark, tmp_path):
    folder = lines(spark, tmp_path, [1, 1, 2, 2, 3, None, None, 4])
    rows = adapters.facts(spark, folder, ["company_number"])
    # the one exchange is that of the lines
    assert exchanges(drop_exact(rows, ["company_number", "label", "value"], F.col("seq"))) == 1
    assert exchanges(largest_absolute(rows, ["company_number", "label"], "value", F.col("seq"))) == 1
    placed = with_position(rows.select("company_number", "position"), "company_number", "position", F.floor(F.col("position") / 100), "at")
    assert exchanges(placed) == 2
    assert sorted(r.at for r in placed.collect() if r.company_number is None) == list(range(46))


def test_large_orders_are_spread(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(adapters, "LINES", 3)
    folder = lines(spark, tmp_path, [1, 1, 1, 1, 1, 1, 1, 2])
    assert adapters.line_parts(spark, folder, ["company_number"]) == (3, [])
    rows = adapters.facts(spark, folder, ["company_number"])
    assert rows.count() == 8 * 23
    assert rows.filter("label = 'Debtors'").select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_parts_do_not_change_the_facts(spark, tmp_path, monkeypatch):
    folder = lines(spark, tmp_path, [1, 2, 2, None, 3, 3, 3, 5])
    plain = sorted(map(str, adapters.facts(spark, folder).collect()))
    monkeypatch.setattr(adapters, "LINES", 4)
    assert adapters.line_parts(spark, folder, ["company_number"]) == (2, ["company_number"])
    assert sorted(map(str, adapters.facts(spark, folder, ["company_number"]).collect())) == plain


def test_no_lines(spark, tmp_path):
    folder = lines(spark, tmp_path, [1])
    spark.read.parquet(f"{folder}/lineitem.parquet").limit(0).write.parquet(f"{folder}/none/lineitem.parquet")
    assert adapters.facts(spark, f"{folder}/none", ["company_number"]).count() == 0


def test_not_processed_near_a_key(spark):
    kinds = "c string, d string, n int"
    rows = spark.createDataFrame([("a", "1", 1), ("a", "1", 2), ("a", None, 3), (None, "1", 4), (None, None, 5), ("b", "1", 6), ("a", "2", 7)], kinds)
    done = spark.createDataFrame([("a", "1"), ("a", "1"), ("a", None), (None, "1"), (None, None), ("c", "1")], "c string, d string")
    plain = not_processed(rows, done, ["c", "d"])
    near = not_processed(rows, done, ["c", "d"], "c")
    assert near.columns == rows.columns
    assert sorted(r.n for r in near.collect()) == sorted(r.n for r in plain.collect()) == [3, 4, 5, 6, 7]
    dealt = not_processed(rows.repartition(3, "c"), done.hint("merge"), ["c", "d"], "c").groupBy("c", "d").count()
    assert "hashpartitioning(c#" in dealt._jdf.queryExecution().executedPlan().toString()


def test_places_without_a_segment(spark):
    rows = spark.createDataFrame([("a", None), ("a", 5), (None, 7), (None, 8), ("a", 6)], "k string, at int")
    placed = with_position(rows, "k", "at", F.col("at"), "place")
    assert placed.columns == ["k", "at", "place"]
    assert sorted(tuple(r) for r in placed.collect() if r.k) == [("a", 5, 1), ("a", 6, 2)]
    assert sorted(tuple(r)[1:] for r in placed.collect() if not r.k) == [(7, 0), (8, 1)]


def shuffled_facts(df):
    """The exchanges that facts pass behind that of the lines of orders, before they are aggregated."""
    plan = [(len(line) - len(line.lstrip(" :+-*(0123456789)")), line) for line in df._jdf.queryExecution().executedPlan().toString().split("\n")]
    found = []
    for at, (depth, line) in enumerate(plan):
        below = plan[at + 1 :]
        end = next((n for n, (d, _) in enumerate(below) if d <= depth), len(below))
        inside = [other for _, other in below[:end]]
        aggregated = any("Aggregate(" in x and "partial_" not in x and "functions=[]" not in x for x in inside)
        if "Exchange" in line and "REPARTITION_BY_NUM" not in line and any("Generate" in x for x in inside) and not aggregated:
            found.append(line.strip(" :+-"))
    return found


@pytest.fixture
def orders(spark, tmp_path, monkeypatch):
    """Lines of orders in two parts, and companies, without broadcasts."""
    monkeypatch.setattr(adapters, "LINES", 4)
    folder = lines(spark, tmp_path, [1, 1, 2, 2, 3, None, None, 4])
    customers = [(n, f"C{n}", n % 2, 1.0, "BUILDING") for n in (1, 2, 3)]
    spark.createDataFrame(customers, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(0, "N0", 0), (1, "N1", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(0, "R0")], "r_regionkey int, r_name string").write.parquet(f"{folder}/region.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield folder
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


DEALT = [
    "jb08c_profiles_added_to_stored_ones",
    "ag15_value_map",
    "ag16_only_value",
    "ag17_financial_profile",
    "jb09_wide_accounts",
    "jb08_profile_rows",
    "ag19_largest_absolute",
    "ag22_dated_summary",
    "jn04_join_facts",
]


@pytest.mark.parametrize("name", DEALT)
def test_queries_shuffle_no_facts(spark, orders, name):
    assert not shuffled_facts(QUERIES[name](spark, orders))


def test_join_near_a_key(spark):
    a = spark.createDataFrame([("x", "1", 1), ("x", "1", 2), ("x", "2", 3), ("x", None, 4), (None, "1", 5), ("y", "1", 6)], "k string, d string, n int")
    b = spark.createDataFrame([("x", "1", "p"), ("x", "1", "q"), ("x", None, "r"), (None, "1", "s"), ("y", "2", "t")], "k string, d string, m string")
    near = join_near(a, b, ["k", "d"], "k")
    assert near.columns == ["k", "d", "n", "m"]
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, a.join(b, ["k", "d"]).collect()))
    plain, facts = join_facts(b, a, ["k", "d"]), join_facts(b, a, ["k", "d"], "k")
    assert facts.columns == plain.columns and sorted(map(tuple, facts.collect())) == sorted(map(tuple, plain.collect()))


def test_large_orders_give_the_same_rows(spark, orders, monkeypatch):
    """An order of more lines than a part has is spread, so joins and aggregates shuffle facts as before."""
    dealt = {name: sorted(map(str, QUERIES[name](spark, orders).collect())) for name in ("ag16_only_value", "ag22_dated_summary", "jn04_join_facts")}
    monkeypatch.setattr(adapters, "LINES", 1)
    for name, rows in dealt.items():
        assert sorted(map(str, QUERIES[name](spark, orders).collect())) == rows
