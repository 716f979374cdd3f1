"""Facts are read once each when they are loaded."""

from pyspark.sql import functions as F

from rollbook.operators import drop_exact, largest_absolute
from rollbook.plans.accounts import _split_new, clean_facts, load_facts
from rollbook.sources.headed import raw_reader, with_file

from .conftest import rows

COLUMNS = "company_number string, name string, value string, seq bigint"
FACTS = "file_name string, file_company string, file_date string, name string, label string, context_ref string, text string, start_date string, end_date string, unit string, decimals string, seq bigint"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def fact_lines(spark):
    """Facts whose value is made by ``upper``, so that plans tell how often it is made."""
    texts = ["1,000", "x", None, "", "(reported)", " 7 ", "a" * 2500, "1,000"]
    made = [(f"0000000{n % 2}_2020-01-01.csv", f"0000000{n % 2}", "2020-01-01", "n", "L", "c", text, None, "2020-01-01", None, "INF", n) for n, text in enumerate(texts)]
    made.append(("odd", None, None, "n", "L", "c", "1", None, None, None, None, 99))
    return spark.createDataFrame(made, FACTS).withColumn("value", F.upper("text")).drop("text")


def test_the_text_of_a_fact_is_made_once(spark):
    clean = clean_facts(fact_lines(spark))
    found = clean.filter(F.length("value") + F.length("label") < 2000)
    assert rows(found.select("company_number", "value", "decimals")) == sorted(
        [("00000000", "1000", "0"), ("00000001", "X", "0"), ("00000001", "7", "0"), ("00000000", "(REPORTED)", "0"), ("00000001", "1000", "0")], key=str
    )
    # file names without a company are dropped in front of it
    assert optimized(found).count("upper(") == 1


def test_numbers_are_read_once_for_the_largest(spark):
    made = [
        ("a", "n", "-5", 2), ("a", "n", "3", 1), ("a", "n", "x", 3), ("b", "n", "x", 1), ("b", "n", "9", 2), ("c", "n", None, 1), ("c", "n", "4", 2),
        ("d", "n", "2", None), ("e", "n", "1", 1), ("e", "n", "-1", 2), (None, "n", "8", 1),
    ]
    df = spark.createDataFrame(made, COLUMNS)
    found = largest_absolute(df, ["company_number"], "value", F.col("seq"))
    assert rows(found) == rows(largest_absolute(df, ["company_number"], "value", "seq")) == sorted(
        [("a", "n", "-5", 1), ("b", "n", "x", 1), ("c", "n", None, 1), ("d", None, None, None), ("e", "n", "1", 1), (None, "n", "8", 1)], key=str
    )
    # a pattern tells numbers, once a row
    assert optimized(found).count("RLIKE") == 1


def test_exact_repeats_of_a_flag_are_hashed(spark):
    made = [("a", True), ("a", False), ("a", None), ("b", None), (None, True), (None, True), ("c", True)]
    df = spark.createDataFrame(made, "k string, flag boolean")
    found = drop_exact(df, ["k"], F.col("flag"))
    assert rows(found) == sorted([("a", False), ("b", None), (None, True), ("c", True)], key=str)
    assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_the_audit_reads_facts_once(spark, tmp_path):
    fact_lines(spark).write.parquet(f"{tmp_path}/facts")
    lines = spark.read.parquet(f"{tmp_path}/facts")
    scanned = spark.createDataFrame([], "company_number string, accounts_date string")
    *_, audit, rejected = _split_new(lines, scanned, "2024-01-31")
    assert rows(audit.select("company_number", "number_of_facts", "number_of_long_facts")) == [("00000000", 2, 1), ("00000001", 3, 0)]
    assert [r.file_name for r in rejected.collect()] == ["odd"]
    assert optimized(audit).count("parquet") == 1


def test_companies_of_facts_are_read_once(spark, tmp_path):
    fact_lines(spark).write.parquet(f"{tmp_path}/facts")
    lines = spark.read.parquet(f"{tmp_path}/facts")
    none = lines.withColumn("company_number", F.col("file_company")).limit(0)
    companies = spark.createDataFrame([("00000001", "known"), ("9", "other")], "number string, name string")
    scanned = spark.createDataFrame([], "company_number string, accounts_date string")
    found = load_facts(lines, scanned, companies, none, none, "2024-01-31")["companies"]
    assert rows(found) == sorted([("00000000", None), ("00000001", "known"), ("9", "other")], key=str)
    assert optimized(found).count("parquet") == 1


def test_short_lines_are_no_errors_to_the_reader(spark, tmp_path):
    """The parser would raise and catch an error for each; with FAILFAST it ends the job."""
    texts = ["A,B", "1", '"2\n""3""",4', ",5", "1,2,3"]
    (tmp_path / "short.csv").write_text("\n".join(texts) + "\n")
    for multiline in (True, False):
        path = str(tmp_path / "short.csv")
        lines = with_file(raw_reader(spark.read, 4, multiline=multiline, mode="FAILFAST").csv(path))
        cells = [[c for c in r._cells if c is not None] for r in lines.collect()]
        if multiline:
            assert cells == [["A", "B"], ["1"], ['2\n"3"', "4"], ["5"], ["1", "2", "3"]]
        assert len(cells) == (5 if multiline else 6)
