import zlib

import pytest
from pyspark.sql import functions as F

from rollbook.llm import QUERIES
from rollbook.llm.sharding import shard_rows


def gapless(rows):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    return all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_documents(spark, data, documents):
    texts = {r.doc_id: (r.text or "").encode() for r in documents.collect()}
    rows = QUERIES["op5_histogram_shards"](spark, data).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r.size == len(texts[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id]) for r in rows)
    assert {r.shard for r in rows} <= set(range(16)) and gapless(rows)
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    by_shard = {}
    for r in rows:
        by_shard[r.shard] = by_shard.get(r.shard, 0) + r.size
    longest = max(r.size for r in rows)
    mean = sum(r.size for r in rows) / 16
    assert all(abs(b - mean) <= longest for b in by_shard.values())


def test_a_hot_text_is_cut_and_stays_together(spark):
    """Half of all rows have one text: it fills neighbouring shards, and slots follow the order of the key."""
    df = spark.range(40_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("text_key"),
        F.lit(10).cast("long").alias("size"),
    )
    rows = shard_rows(df, ["text_key", "doc_id"], "size").collect()
    assert gapless(rows)
    counts = [sum(1 for r in rows if r.shard == s) for s in range(16)]
    assert max(counts) - min(counts) <= 40
    hot = sorted({r.shard for r in rows if r.text_key == 0})
    assert hot == list(range(hot[0], hot[-1] + 1)) and 8 <= len(hot) <= 9


def test_reruns_agree_and_partitions_do_not_matter(spark, documents):
    df = documents.select("doc_id", F.length("text").cast("long").alias("size"))
    first = shard_rows(df, ["doc_id"], "size").collect()
    again = shard_rows(df.repartition(7), ["doc_id"], "size").collect()
    assert sorted(first) == sorted(again)


@pytest.mark.parametrize("shards", [1, 3])
def test_odd_rows(odd, shards):
    df = odd.withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)) + 1)
    rows = shard_rows(df, ["text", "doc_id"], "bytes", shards).collect()
    assert len(rows) == df.count() and gapless(rows)
    assert set(rows[0].asDict()) == {*df.columns, "shard", "slot"}


def test_empty_table(odd):
    assert shard_rows(odd.withColumn("bytes", F.lit(1)).limit(0), ["doc_id"], "bytes").collect() == []
