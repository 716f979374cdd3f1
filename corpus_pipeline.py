"""A training corpus from ``documents``: clean, harmless, without near-copies, mixed to weights, tokenised."""

from pyspark.sql import functions as F

from rollbook.llm.byte_bpe import encode
from rollbook.llm.mixing import mix
from rollbook.llm.near_duplicates import keep_one
from rollbook.llm.quality import quality
from rollbook.llm.queries import gpt_vocabulary, toxicity_model
from rollbook.llm.registry import ship
from rollbook.llm.tables import written
from rollbook.llm.toxicity import THRESHOLD, score


def good_quality(spark, docs, sf_dir):
    """Documents that the quality rules keep."""
    ship(spark)
    return quality(docs).filter("kept").select("row.*")


def harmless(spark, docs, sf_dir):
    """Documents that the toxicity classifier, learnt from the labels of these documents, lets pass."""
    ship(spark)
    return score(docs, toxicity_model(spark, docs, sf_dir)).filter(F.col("score") < THRESHOLD).select("row.*")


def without_near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more)."""
    ship(spark)
    return keep_one(docs)


def mixed(spark, docs, sf_dir):
    """Documents as often as the mix takes them: none to three times each."""
    ship(spark)
    return mix(docs)


def tokens(spark, docs, sf_dir):
    """Token ids of each document."""
    ship(spark)
    ids = encode(gpt_vocabulary(spark), F.col("text"))
    out = docs.select("doc_id", "lang", "source", ids.alias("ids"))
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", good_quality),
    ("toxicity", harmless),
    ("near duplicates", without_near_duplicates),
    ("mix", mixed),
    ("tokens", tokens),
]

#: The label models, the classifier and the random rounding are not SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order, each one written as Parquet and read by the next."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
