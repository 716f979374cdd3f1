"""The stages against what they promise, each on the output of the one before."""

import base64

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from rollbook.llm.quality import quality
from rollbook.llm.tables import written

from .test_mixing import expected_targets
from .test_near_duplicates import expected as expected_components
from .test_quality import WORD, base_counts


@pytest.fixture(scope="module")
def outputs(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, data), "stage")
        out.append(docs)
    return out


def test_columns_stay(outputs):
    assert all(o.columns == outputs[0].columns for o in outputs[:-1])
    assert outputs[-1].columns == ["doc_id", "lang", "source", "n_tokens", "ids"]


def test_quality_stage(outputs):
    kept = {r.doc_id for r in outputs[1].collect()}
    judged = quality(outputs[0]).select("row.doc_id", "row.text", "kept").collect()
    assert kept == {r.doc_id for r in judged if r.kept}
    for r in judged:
        n, _, _, _, repeats = base_counts(r.text)
        assert not r.kept or (n >= 20 and 100 * repeats <= 30 * n)


def test_toxicity_stage_keeps_clean_documents(outputs, spark, data):
    clean = {r.doc_id for r in spark.read.parquet(f"{data}/labels.parquet").filter("toxic = 0").collect()}
    before, after = ({r.doc_id for r in o.collect()} for o in outputs[1:3])
    assert after <= before and before & clean <= after


def test_near_duplicate_stage(outputs):
    rows = [(r.doc_id, r.text) for r in outputs[2].collect()]
    assert sorted(r.doc_id for r in outputs[3].collect()) == sorted(i for i, _, _, kept in expected_components(rows, 5) if kept)


def test_mix_stage(outputs):
    sizes, taken = {}, {}
    for o, counts in ((outputs[3], sizes), (outputs[4], taken)):
        for r in o.collect():
            counts[r.source] = counts.get(r.source, 0) + len(WORD.findall(r.text))
    longest = max(len(WORD.findall(r.text)) for r in outputs[3].collect())
    for source, want in expected_targets(sizes).items():
        assert abs(taken.get(source, 0) - want) <= longest
    copies = {}
    for r in outputs[4].collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 3


def test_token_stage(outputs):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file.read().splitlines())}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in outputs[4].collect()}
    rows = outputs[5].collect()
    assert len(rows) == outputs[4].count()
    assert all(r.ids == other.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) for r in rows)


def test_run_is_all_stages(outputs, spark, data):
    got = sorted((r.doc_id, r.n_tokens) for r in entry.queries()["pipeline"](spark, data).collect())
    assert got == sorted((r.doc_id, r.n_tokens) for r in outputs[5].collect())


def test_stages_take_an_empty_table(outputs, spark, data):
    docs = outputs[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, data).collect() == []
