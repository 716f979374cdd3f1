import base64
import hashlib
import struct

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollbook.llm import QUERIES
from rollbook.llm.byte_bpe import ByteBpe, Tokens, decode, encode, encode_and_decode, packed
from rollbook.llm.queries import gpt_vocabulary

FILES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]
CUT = regex.compile(public_tokenizers.PATTERN)


def both(name):
    with open(public_tokenizers.path(name), "rb") as file:
        content = file.read()
    ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in content.splitlines() if line)}
    return ByteBpe(content), Tokens(content), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


SPACES = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u200b", "\x00"]
TEXTS = st.one_of(
    st.text(max_size=60),
    st.lists(st.sampled_from([*SPACES, "a", "é", "\u0301", "ß", "中", "\U0001f600", "'s", "'", "1", "²", ".", "the"]), max_size=20).map("".join),
)
LOADED = {name: both(name) for name in FILES}


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_any_texts(name, texts):
    own, tokens, other = LOADED[name]
    expected = [other.encode_ordinary(t) for t in texts]
    assert [own.encode(t, CUT) for t in texts] == expected
    ids = np.array([i for e in expected for i in e], np.int64)
    assert tokens.decode(ids)[0].tobytes() == "".join(texts).encode()


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdefinorst", min_size=1, max_size=60))
def test_long_words(name, text):
    own, _, other = LOADED[name]
    assert own.encode(text, CUT) == other.encode_ordinary(text)


def test_a_very_long_word_and_special_text():
    own, _, other = LOADED[FILES[0]]
    for text in ("a" * 100_000, "ab" * 50_000, "<|endoftext|> x", "é" * 3000, "\U0001f600" * 1000):
        assert own.encode(text, CUT) == other.encode_ordinary(text)


def test_documents(spark, data, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in QUERIES["op6_byte_bpe"](spark, data).collect():
        ids = LOADED[FILES[0]][2].encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows_and_empty_table(spark, odd):
    vocabulary = gpt_vocabulary(spark)
    out = odd.select("text", encode(vocabulary, F.col("text")).alias("ids"))
    out = out.withColumn("back", decode(vocabulary, F.col("ids"))).withColumn("packed", packed(F.col("ids")))
    for r in out.collect():
        assert bytes(r.back) == (r.text or "").encode()
        assert bytes(r.packed) == struct.pack(f"<{len(r.ids)}I", *r.ids)
    assert out.limit(0).collect() == []


def test_every_byte_must_be_a_token():
    with pytest.raises(ValueError):
        ByteBpe(base64.b64encode(b"a") + b" 0\n")


def test_encoded_once(spark, data, odd):
    vocabulary = gpt_vocabulary(spark)
    plan = QUERIES["op6_byte_bpe"](spark, data)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("both(text") >= 1 and "encoded(" not in plan and plan.count("ArrowEvalPython [") == 1
    out = odd.select("text", encode(vocabulary, F.col("text")).alias("ids"), encode_and_decode(vocabulary, F.col("text")).alias("t"))
    for r in out.collect():
        assert bytes(r.t.decoded) == (r.text or "").encode() and r.t.n_tokens == len(r.ids)
        assert bytes(r.t.packed) == struct.pack(f"<{len(r.ids)}I", *r.ids)
