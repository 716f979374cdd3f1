from pyspark.sql import functions as F

from rollbook.llm import QUERIES
from rollbook.llm.toxicity import held_out, learn, score


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    out = QUERIES["op2_toxicity"](spark, folder)
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert out.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_held_out_labels_are_not_learnt_from(spark):
    df = spark.range(2000).withColumnRenamed("id", "doc_id")
    import zlib

    held = {r.doc_id for r in df.filter(held_out("doc_id")).collect()}
    assert held == {i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 == 2}


def small_model(spark):
    texts = [(i, f"fine words number {chr(97 + i % 26) * 4} here", 0) for i in range(300)]
    texts += [(1000 + i, f"you gobbel{chr(97 + i % 26) * 3} nasty {chr(97 + i % 26) * 5}", 1) for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, toxic int")
    return learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))


def test_beginnings_of_words_carry_over(spark):
    model = small_model(spark)
    df = spark.createDataFrame([(1, "a gobbelxyz appears"), (2, "nothing of the kind")], "doc_id bigint, text string")
    got = {r.row.doc_id: r.score for r in score(df, model).collect()}
    assert got[1] > 0.5 > 0.3 > got[2]


def test_forms_of_one_text_are_not_many_texts(spark):
    """Two toxic texts full of forms of a word are too little to take the word for toxic."""
    forms = " ".join("gobbel" + 2 * c for c in "abcdefghijklmnop")
    texts = [(i, f"fine words number {chr(97 + i % 26) * 4} here", 0) for i in range(50)]
    texts += [(100 + i, f"{forms} {chr(97 + i) * 6}", 1) for i in range(2)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, toxic int")
    model = learn(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert model.parts == [] and all(r.score < 0.3 for r in score(df, model).collect())


def test_odd_rows_and_empty_tables(spark, odd):
    model = small_model(spark)
    out = score(odd, model).select("row.*", F.col("score").alias("own_score")).collect()
    assert len(out) == odd.count()
    by_text = {}
    for r in out:
        assert by_text.setdefault(r.text or "", r.own_score) == r.own_score
    assert score(odd.limit(0), model).collect() == []
    labels = spark.createDataFrame([(1, None), (None, 1), (5, 1), (5, 0)], "doc_id bigint, toxic int")
    for given in (labels, labels.limit(0)):
        got = score(odd, learn(odd, given)).select("score").distinct().collect()
        assert all(0 <= r.score <= 1 for r in got)
