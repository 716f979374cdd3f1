"""Small lookup lists."""

from pyspark.sql import functions as F

from ..fixed_values import ENUMERATION_PATTERN


def read_lookup(spark, path, schema, key):
    """A header-line CSV list with one row per key; the smallest row of a key is kept."""
    df = spark.read.option("header", True).schema(schema).csv(path)
    rest = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.min(F.struct(*rest)).alias("row"))
        .select(key, *[F.col(f"row.{c}").alias(c) for c in rest])
    )


def key_values(lines, order):
    """Key/value rows from enumeration lines (column ``value``); the first of a key counts."""
    rows = lines.filter(F.col("value").rlike(ENUMERATION_PATTERN)).select(
        F.trim(F.regexp_extract("value", ENUMERATION_PATTERN, 1)).alias("key"),
        F.replace(
            F.regexp_extract("value", ENUMERATION_PATTERN, 2), F.lit("''"), F.lit("'")
        ).alias("text"),
        order.alias("ord"),
    )
    return rows.groupBy("key").agg(F.min_by("text", "ord").alias("value"))


def read_key_values(spark, path):
    """Enumeration file with lines ``  'key': "text"``."""
    lines = spark.read.text(path).withColumn("file", F.col("_metadata.file_path"))
    lines = lines.withColumn("at", F.col("_metadata.file_block_start"))
    return key_values(lines, F.struct("file", "at", F.monotonically_increasing_id()))
