"""The operators of this subpackage as queries over the given tables."""

from pyspark.sql import functions as F

from .alignment import align, tokenizers
from .byte_bpe import Vocabulary, encode_and_decode
from .decontamination import benchmark_hits, hit_words
from .fingerprints import digests, edited, fingerprint, likeness, with_difference, with_next
from .fixity import audit, warc_records
from .licenses import license_spans
from .mixing import copies, shares
from .near_duplicates import near_duplicates
from .phrases import collocations
from .quality import BASE, quality
from .registry import query
from .sharding import shard_rows
from .tables import documents_of, written
from .token_counts import piece_scores, token_counts
from .toxicity import THRESHOLD, held_out, learn, score


@query("op10_quality_rules")
def op10(spark, folder):
    """Base counts and verdict of every document."""
    judged = quality(documents_of(spark, folder, "doc_id", "text"), carry=["doc_id"])
    return judged.select(F.col("row.doc_id").alias("doc_id"), *BASE, "base_failed", "kept", "posterior")


@query("op7_minhash_near_dedup")
def op7(spark, folder):
    """Component of every document by its two-word shingles."""
    return near_duplicates(documents_of(spark, folder, "doc_id", "text"), k=2).drop("text_key")


def toxicity_model(spark, docs, folder):
    """Learnt from the labelled documents that are not held out."""
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    return learn(docs, labels.filter(~held_out("doc_id")))


@query("op2_toxicity")
def op2(spark, folder):
    """Score of every document."""
    docs = documents_of(spark, folder, "doc_id", "text")
    scored = score(docs, toxicity_model(spark, docs, folder), carry=["doc_id"])
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(held_out("row.doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


@query("op9_pivotal_mix")
def op9(spark, folder):
    """Words that the mix takes of every document."""
    taken = shares(copies(documents_of(spark, folder, "doc_id", "text", "source")))
    return taken.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def gpt_vocabulary(spark):
    """The 50k byte-level ranks of the public tokenizers, and their pattern."""
    import public_tokenizers

    return Vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op6_byte_bpe")
def op6(spark, folder):
    """Digests of every document's token ids and of the bytes they decode to."""
    vocabulary = gpt_vocabulary(spark)
    docs = documents_of(spark, folder, "doc_id", "text").select("doc_id", encode_and_decode(vocabulary, F.col("text")).alias("t"))
    return docs.select(
        "doc_id", "t.n_tokens", F.sha2("t.packed", 256).alias("ids_sha256"), F.sha2("t.decoded", 256).alias("decoded_sha256")
    )


@query("op5_histogram_shards")
def op5(spark, folder):
    """Shard and slot of every document; shards have near equal bytes."""
    docs = documents_of(spark, folder, "doc_id", "text")
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64("text").alias("text_key"),
    )
    placed = shard_rows(rows, ["text_key", "doc_id"], "size")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op3_paragraph_sketches")
def op3(spark, folder):
    """Sketch of every document and of its edited text, the digests in which they and the next one differ, and how alike they are."""
    docs = with_next(documents_of(spark, folder, "doc_id", "text"))
    docs = docs.withColumn("edited", edited(F.col("text"), F.col("next_text")))
    docs = docs.withColumn("edited_values", digests(F.col("edited")))
    docs = with_difference(docs, "values", "edited_values", "from_edited")
    docs = with_difference(docs, "values", "next_values", "from_next")
    return docs.select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("values").alias("fingerprint"),
        fingerprint("edited_values").alias("edited_fingerprint"),
        likeness("values", "edited_values", "from_edited").alias("near_edited"),
        likeness("values", "next_values", "from_next").alias("near_next"),
        "from_edited",
        "from_next",
    )


#: What the replica of the audit suffers, by a hash of the page: the numbers of ``damaged``.
REPLICA_SQL = """
WITH p AS (
  SELECT page_id, ('0x' || substr(md5(page_id::VARCHAR), 1, 4))::INT % 50 AS d,
    'pages-' || (page_id // 200) || '.warc' AS file,
    strlen('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
      || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
      || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, ''))
      || chr(13) || chr(10) || chr(13) || chr(10)) + strlen(coalesce(html, '')) + 4 AS length
  FROM pages),
o AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS offset_
  FROM p)
SELECT file, offset_::BIGINT AS "offset", 'changed' AS damage, length::BIGINT AS length,
  (CASE WHEN d = 2 THEN length - 1 ELSE length END)::BIGINT AS replica_length FROM o WHERE d IN (0, 2)
UNION ALL
SELECT file, offset_::BIGINT, 'missing', length::BIGINT, NULL FROM o WHERE d = 1
UNION ALL
SELECT file, offset_::BIGINT + 1, 'extra', NULL, 5 FROM o WHERE d = 3
"""


def damaged(records):
    """A replica of the records with changed, lost, cut and stray ones."""
    kind = F.conv(F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 4), 16, 10).cast("int") % 50
    records = records.withColumn("kind", F.coalesce(kind, F.lit(-1)))
    size = F.octet_length("record")
    flipped = F.concat(F.expr("substring(record, 1, octet_length(record) - 1)"), F.lit("?").cast("binary"))
    cut = F.expr("substring(record, 1, octet_length(record) - 1)")
    record = F.when(F.col("kind") == 0, flipped).when((F.col("kind") == 2) & (size > 0), cut).otherwise(F.col("record"))
    left = records.filter("kind != 1").select("file", "offset", record.alias("record"))
    stray = records.filter("kind = 3").select("file", (F.col("offset") + 1).alias("offset"), F.lit("stray").cast("binary").alias("record"))
    return left.unionByName(stray)


@query("op1_merkle_fixity", REPLICA_SQL)
def op1(spark, folder):
    """Damage of a replica of the pages' WARC files."""
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html")
    records = written(warc_records(pages), "warc")
    return audit(records, damaged(records))


@query("op4_trie_token_counts")
def op4(spark, folder):
    """Words and unigram tokens of every document, by the pieces and scores of the public 32k model."""
    import public_tokenizers

    scores = piece_scores(public_tokenizers.path("piece_bpe_32k.model"))
    counted = token_counts(documents_of(spark, folder, "doc_id", "text"), scores, carry=["doc_id"])
    return counted.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_tokens")


@query("op8_license_spans")
def op8(spark, folder):
    """License notices in every document."""
    found = license_spans(documents_of(spark, folder, "doc_id", "text"), carry=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), "license", "matched", "coverage", "start", "stop")


#: Every window of 10 words of an item (or all words of a shorter one) wherever a document has it.
WINDOWS_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS s
  FROM (SELECT *, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (
  SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, ks WHERE len(w) >= k)),
hits AS (SELECT doc_id, item_id, i, dw.k FROM dw JOIN bw ON dw.k = bw.k AND dw.s = bw.s),
places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op12_benchmark_decontamination", WINDOWS_SQL)
def op12(spark, folder):
    """Words of every document that lie in a window of a benchmark item, and these items."""
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text")
    found = benchmark_hits(documents_of(spark, folder, "doc_id", "text"), benchmark, carry=["doc_id"])
    n_hit = hit_words()
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


#: Counts of all phrases of one to three words, scored in 128-bit numbers.
PHRASES_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM w, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= 10),
halves AS MATERIALIZED (
  SELECT lang, phrase, a, i AS cut, array_to_string(list_slice(ws, 1, i), ' ') AS lp, array_to_string(list_slice(ws, i + 1, k), ' ') AS rp
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS i FROM c)),
cuts AS (
  SELECT h.lang, h.phrase, h.a, cut, l.a AS l, r.a AS r, (1000000::HUGEINT * h.a * h.a) // (l.a::HUGEINT * r.a) AS score
  FROM halves AS h JOIN f AS l ON l.lang = h.lang AND l.phrase = lp JOIN f AS r ON r.lang = h.lang AND r.phrase = rp),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (
  SELECT lang, array_to_string(list_slice(ws, i, i + 1), ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, ws, a, unnest([1, 2]) AS i FROM c WHERE k = 3) GROUP BY ALL),
kept AS (
  SELECT weakest.* FROM weakest LEFT JOIN inner_ USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) JOIN n USING (lang)
WHERE rank <= 2000
"""


@query("op11_phrase_collocations", PHRASES_SQL)
def op11(spark, folder):
    """The 2000 strongest phrases of two or three words of each language."""
    return collocations(documents_of(spark, folder, "lang", "text"))


@query("op13_tokenizer_alignment")
def op13(spark, folder):
    """Tokens of two public tokenizers in every document, what they share, and how usual their pairs are."""
    import public_tokenizers

    both = tokenizers(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    # the contract wants a|b;a|b
    aligned = align(documents_of(spark, folder, "doc_id", "text"), both, carry=["doc_id"], marks="|;")
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return aligned.select(F.col("row.doc_id").alias("doc_id"), *columns, digest.alias("groups_sha256"))
