from pyspark.sql import functions as F

from rollbook.operators import dated_summary, hits_and_keys, pivot_facts
from rollbook.registered import adapters
from rollbook.registered.sources import write_csv
from rollbook.sources import read_fact_csv, write_documents

from .conftest import rows

COLUMNS = "company_number string, label string, value string, seq bigint"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_come_in_parts_of_some_lines(spark, data, monkeypatch):
    monkeypatch.setattr(adapters, "LINES", 1 << 40)
    whole = adapters.facts(spark, data)
    monkeypatch.setattr(adapters, "LINES", 1000)
    parts = adapters.facts(spark, data)
    sizes = [r["count"] for r in parts.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) >= 6 and max(sizes) <= 2 * 1000 * len(adapters.FACT_LABELS)
    assert whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()


def test_accounts_are_counted_without_making_facts(spark, data):
    found = adapters.accounts(spark, data)
    assert not {"Generate", "SortAggregate"} & set(_plan(found).replace("(", " ").split())
    expected = (
        adapters.facts(spark, data)
        .groupBy("company_number")
        .agg(F.max("end_date").alias("accounts_date"), F.count("*").alias("number_of_facts"))
        .withColumn("document", F.col("company_number"))
    )
    assert found.dtypes == expected.dtypes and rows(found) == rows(expected)


def test_only_hits_and_a_row_per_key_are_sorted(spark):
    facts = [("a", "Creditors", "1", 1), ("a", "other", "2", 2), ("a", "other", "3", 3), ("b", "other", "4", 4), (None, "other", "5", 5)]
    wanted = hits_and_keys(spark.createDataFrame(facts, COLUMNS), ["company_number"], F.col("label") == "Creditors")
    assert rows(wanted) == sorted([facts[0], *[(k, None, None, None) for k in ("a", "b", None)]], key=str)


def test_dated_summary_sends_no_facts_into_the_join(spark):
    facts = [
        ("a", "2020-01-01", "Creditors", "1", 2), ("a", "2020-01-01", "Creditors", "2", 1), ("a", "2021-01-01", "Creditors", "3", 0),
        ("a", "2020-01-01", "Debtors", None, 3), ("b", "2020-01-01", "other", "4", 4), ("c", "2020-01-01", "Bank borrowings 2", "5", 5),
        ("c", None, "Creditors", "6", 6), ("d", "2020-01-01", None, "7", 7), ("e", "2019-01-01", "Creditors", "8", 8),
    ]
    facts = spark.createDataFrame(facts, "document string, end_date string, label string, value string, position bigint")
    dates = [(d, "2020-01-01") for d in "abcde"] + [("a", "2021-01-01"), ("a", "2020-01-01")]
    found = dated_summary(facts, spark.createDataFrame(dates, "document string, accounts_date string"))
    assert rows(found.select("document", "creditors", "debtors", "borrowings")) == sorted(
        [("a", "3", None, None), ("b", None, None, None), ("c", None, None, "5"), ("d", None, None, None)], key=str
    )
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # the facts are aggregated below the join
    assert "Aggregate" in plan[plan.index("Join") :]


def test_texts_of_facts_that_are_left_out_are_not_made(spark, data):
    found = adapters.facts(spark, data)
    plan = found.filter(F.col("label") == "Debtors").groupBy("company_number").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "format_number" in found._jdf.queryExecution().optimizedPlan().toString()
    assert "format_number" not in plan


def test_pivot_compares_the_text_of_a_label_once(spark):
    facts = [
        ("a", "Debtors", "1,000", 1), ("a", "Debtors", "x", 0), ("a", "Debtors", "-2", 2), ("a", None, "5", 3),
        (None, "Debtors", "-1", 1), (None, "Creditors", "7", 1), ("b", "own", "b", 1), ("b", "Debtors", None, 2), ("c", "other", "1", 1),
    ]
    facts = spark.createDataFrame(facts, COLUMNS)
    spec = [("first", "Debtors", "text"), ("debtors", "Debtors", "signed"), ("most", "Debtors", "max"), ("day", "Creditors", "date")]
    found = pivot_facts(facts, ["company_number"], spec)
    plain = found.select("company_number", "first", F.col("debtors").cast("int"), F.col("most").cast("int"), "day")
    assert rows(plain) == sorted([("a", "x", 1000, 1000, None), (None, "-1", -1, -1, None), ("b", None, None, None, None)], key=str)
    own = pivot_facts(facts, ["company_number"], spec, consistent=("own", "company_number"))
    assert rows(own.select("company_number", "first")) == [("b", None)]
    aggregate = found._jdf.queryExecution().optimizedPlan().toString().split("\n")[0]
    assert "label" not in aggregate


def test_lines_of_files_are_not_shuffled_for_their_headers(spark, tmp_path):
    lines = ["Label,Value", "Debtors,1"], ["Value,Label", '"2\n3",Creditors']
    for n, text in enumerate(lines):
        (tmp_path / f"0000000{n}_2020-01-01.csv").write_text("\n".join(text) + "\n")
    found = read_fact_csv(spark, str(tmp_path))
    assert rows(found.select("file_company", "label", "value")) == [("00000000", "Debtors", "1"), ("00000001", "Creditors", "2\n3")]
    assert "Exchange hashpartitioning" not in _plan(found)


def test_landed_files_are_compressed(spark, tmp_path):
    df = spark.range(3).select(F.col("id").cast("string").alias("a"))
    write_csv(df, str(tmp_path / "csv"))
    write_documents(df.withColumn("b", F.lit("x")), str(tmp_path / "json"), "a", "gzip")
    assert list((tmp_path / "csv").glob("*.csv.gz")) and list((tmp_path / "json").rglob("*.json.gz"))
