import duckdb
from pyspark.sql import functions as F

from rollbook.llm import QUERIES, SQL
from rollbook.llm.fixity import audit, warc_records


def test_pages_equal_sql(spark, data):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{data}/pages.parquet'")
    expected = con.execute(SQL["op1_merkle_fixity"]).fetchall()
    got = [tuple(r) for r in QUERIES["op1_merkle_fixity"](spark, data).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str) and got


def records(spark, rows):
    df = spark.createDataFrame(rows, "file string, offset bigint, record string")
    return df.withColumn("record", F.col("record").cast("binary"))


def test_damage_in_a_large_file_is_found(spark):
    """200,000 records in one file, over several levels; three of them damaged, and a file only one side has."""
    base = spark.range(200_000).select(
        F.lit("big.warc").alias("file"), (F.col("id") * 900).alias("offset"), F.col("id").cast("string").cast("binary").alias("record")
    )
    other = base.filter("offset != 900 * 77777").withColumn(
        "record", F.when(F.col("offset").isin(0, 900 * 123456), F.lit("bad").cast("binary")).otherwise(F.col("record"))
    )
    extra = records(spark, [("new.warc", 0, "x"), ("new.warc", 5, None)])
    got = sorted(tuple(r)[:3] for r in audit(base, other.unionByName(extra)).collect())
    assert got == [
        ("big.warc", 0, "changed"),
        ("big.warc", 900 * 77777, "missing"),
        ("big.warc", 900 * 123456, "changed"),
        ("new.warc", 0, "extra"),
        ("new.warc", 5, "extra"),
    ]


def test_equal_replicas_and_empty_tables(spark):
    some = records(spark, [("a", 0, "x"), ("a", 1, None), (None, 0, "y"), ("b", None, "z")])
    assert audit(some, some.repartition(3)).collect() == []
    assert audit(some.limit(0), some.limit(0)).collect() == []
    assert {r.damage for r in audit(some, some.limit(0)).collect()} == {"missing"}


def test_records_of_odd_pages(spark):
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, None, "<p>"), (10**12, "v", "é")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("offset", F.lit(-1)).withColumn("file", F.lit("own"))
    out = warc_records(df).collect()
    assert len(out) == len(rows)
    by_file = {}
    for r in sorted(out, key=lambda r: r.offset):
        assert r.offset == by_file.get(r.file, 0)
        by_file[r.file] = r.offset + len(r.record)
    assert warc_records(df.limit(0)).collect() == []
