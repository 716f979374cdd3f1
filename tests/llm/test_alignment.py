import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rollbook.llm import QUERIES
from rollbook.llm.alignment import Aligner, PairCounts, align, cells_of, minimal_hash, tokenizers

from .conftest import prose

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
LETTERS = {}
for _b in range(256):
    _plain = 0x21 <= _b <= 0x7E or 0xA1 <= _b <= 0xAC or 0xAE <= _b
    LETTERS[chr(_b) if _plain else chr(0x100 + sum(1 for x in LETTERS.values() if not (0x21 <= x <= 0x7E or 0xA1 <= x <= 0xAC or 0xAE <= x)))] = _b
TOKENS_A = {i: bytes(LETTERS[c] for c in t) for t, i in json.load(open(PATHS[0]))["model"]["vocab"].items()}


def piece(i):
    p = B.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()


def whole(text):
    """Groups of a text, tokenized as a whole; None if it has no tokens."""
    if not text:
        return None
    ids = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    parts = [TOKENS_A[i] for i in ids[0]], [piece(i) for i in ids[1]]
    if any(b"".join(p) != (" " + text).encode() for p in parts):
        return None
    ends = [np.cumsum([len(t) for t in p]).tolist() for p in parts]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    return [tuple([i for i, e in zip(ids[s], ends[s]) if low < e <= high] for s in (0, 1)) for low, high in zip([0, *cuts], cuts)]


def brute(texts):
    groups = [whole(t) or [] for t in texts]
    links = [[(a, b) for ga, gb in g for a in ga for b in gb] for g in groups]
    count = Counter(p for own in links for p in set(own))
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    return [
        (
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(own), sum(count[p] == best[p[0]] for p in own),
            sum(count[p] for p in own), "|".join(",".join(map(str, a)) + ";" + ",".join(map(str, b)) for a, b in g),
        )
        for g, own in zip(groups, links)
    ]


LOADED = Aligner(tuple(open(p, "rb").read() for p in PATHS))
SPACES = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "​", "\x00", "▁", "   "]
TEXTS = st.one_of(
    st.text(max_size=40),
    st.lists(st.sampled_from([*SPACES, "a", "the", "é", "́", "ß", "中文", "\U0001f600", "'s", "'", "12", ".", "<s>", "<|endoftext|>", "<0x0A>", "“"]), max_size=20).map("".join),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_segments_equal_whole_texts(texts):
    for text, own in zip(texts, LOADED.align(texts)):
        groups = whole(text)
        expected = "" if groups is None else "|".join(",".join(map(str, a)) + ";" + ",".join(map(str, b)) for a, b in groups)
        assert "|".join(e[4] for e in own) == expected


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 100_000])
def test_minimal_hash_has_a_cell_for_each_key(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 40, n))
    seeds = minimal_hash(keys)
    assert sorted(cells_of(keys, seeds, len(keys)).tolist()) == list(range(len(keys)))


def test_a_strange_pair_has_no_count():
    keys = np.arange(100, 200)
    seeds = minimal_hash(keys)
    stored = np.empty_like(keys)
    stored[cells_of(keys, seeds, 100)] = keys
    counts = PairCounts("x", 1, [{"shard": 0, "seeds": seeds.tobytes(), "pairs": stored.tobytes(), "vector": (stored * 2).tobytes()}], np.full(9, 300))
    assert [x.tolist() for x in counts.find(np.array([150, 99, 200, 101]), np.array([1, 1, 1, 1]))] == [[300, 0, 0, 202], [1, 0, 0, 0]]


@pytest.mark.parametrize(("shard_pairs", "vector_rows", "sent_bytes"), [(1 << 20, 1 << 20, 1 << 20), (30, 20, 1000)])
def test_equals_brute_force(spark, shard_pairs, vector_rows, sent_bytes):
    texts = [
        prose(1, 30), prose(2, 30), prose(1, 30), None, "", " ", "x", "The cat. The dog! 123 456", "▁ no", "  two  spaces ", "é中\x00",
        "y" * 3000, "The cat\n\nand  a dog", *[prose(i, 8) for i in range(10)],
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(3)
    df = df.withColumns({c: F.lit("own") for c in ("row", "at", "pair", "n_a", "groups", "shard")})
    got = align(df, tokenizers(spark, *PATHS), shard_pairs=shard_pairs, vector_rows=vector_rows, sent_bytes=sent_bytes).collect()
    expected = brute(texts)
    assert len(got) == len(texts) and got[0].row.pair == "own"
    for r in got:
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == expected[r.row.doc_id]


def test_documents_equal_brute_force(spark, data, documents):
    rows = documents.select("doc_id", "text").collect()
    expected = {r.doc_id: e for r, e in zip(rows, brute([r.text for r in rows]))}
    got = QUERIES["op13_tokenizer_alignment"](spark, data).collect()
    assert len(got) == len(rows)
    for r in got:
        *sums, groups = expected[r.doc_id]
        assert [r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum] == sums
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_odd_rows_and_empty_table(spark, odd):
    both = tokenizers(spark, *PATHS)
    out = align(odd, both)
    rows = out.collect()
    assert len(rows) == odd.count()
    assert all((r.n_a, r.groups) == (0, "") for r in rows if not r.row.text)
    assert align(odd.limit(0), both).collect() == []


def test_digest_has_groups_apart_by_semicolons(spark, tmp_path):
    texts = ["The cat. The dog! 123 456", "Alignment of tokenizers", "x", None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["op13_tokenizer_alignment"](spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        groups = whole(text)
        joined = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups or ())
        assert got[i].groups_sha256 == (hashlib.sha256(joined.encode()).hexdigest() if groups else "")


def test_distinct_pairs_and_their_times():
    from rollbook.llm.alignment import _times_by_text

    texts = ["the cat and the cat the", "", "x", "y" * 3000, "the the the"]
    pairs, times, sizes = _times_by_text(LOADED.align(texts), 1 << 40)
    pairs, times = iter(pairs.tolist()), iter(times.tolist())
    for text, n in zip(texts, sizes.tolist()):
        got = {next(pairs): next(times) for _ in range(n)}
        assert got == Counter(a * LOADED.width + b for ga, gb in whole(text) or [] for a in ga for b in gb)


def test_texts_are_aligned_once(spark, tmp_path, monkeypatch):
    """What is left for the result reads the written alignment and no text."""
    path = str(tmp_path / "texts")
    spark.createDataFrame([(i, prose(i, 30)) for i in range(20)], "doc_id bigint, text string").write.parquet(path)
    out = align(spark.read.parquet(path), tokenizers(spark, *PATHS), carry=["doc_id"])
    plan = out._jdf.queryExecution().toString()
    assert "llm-aligned" in plan and path not in plan
