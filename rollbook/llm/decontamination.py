"""Benchmark passages in training texts: windows of words that a benchmark item also has.

The windows of the items are put into a hash set that is sent to the executors, in blocks of bounded size. A task
hashes all windows of its texts, looks them up, and compares the words of each hit, so a hash alone decides nothing.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .tables import written
from .words import CHUNK_BYTES, LOWER, Chunk, mixed

#: Words of a window, and bytes of windows that are sent to the executors at once.
WINDOW, SENT_BYTES = 10, 32 << 20
#: What an entry of the hash set takes besides its words.
ENTRY_BYTES = 64
#: Bytes that belong to a word: 0 to 9, a to z (A to Z are lowered before) and all beyond ASCII.
GAP = np.ones(256, bool)
GAP[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


class Words(Chunk):
    """Some whole texts, lower-cased, and their words of letters, digits and bytes beyond ASCII."""

    def __init__(self, texts):
        self.data = LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.n = len(texts)
        self.at = np.concatenate(([0], np.cumsum(sizes + 1)))
        edge = np.flatnonzero(np.diff(np.concatenate(([True], GAP[self.data])).astype(np.int8)))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.at)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))

    def joined(self, first, k):
        """The words ``first`` to ``first + k - 1``, one space between two."""
        span = zip(self.starts[first : first + k], self.ends[first : first + k])
        return b" ".join([self.data[a:b].tobytes() for a, b in span])


def _chunks(column):
    texts, size, at = [], 0, 0
    for i in range(len(column)):
        text = column[i].as_py() or b""
        if texts and size + len(text) > CHUNK_BYTES:
            yield at, Words(texts)
            texts, size, at = [], 0, i
        texts.append(text)
        size += len(text) + 1
    if texts:
        yield at, Words(texts)


def item_windows(benchmark, text="text", item_id="item_id", window=WINDOW):
    """Distinct (item, words, n): the windows of ``window`` words of each item; of a shorter one all its words.

    ``words`` are bytes, lower-cased and one space apart. Items without a word or without an id have no window.
    """

    def windows(batches):
        for batch in batches:
            items, words, sizes = [], [], []
            for at, chunk in _chunks(batch.column(1)):
                for i in range(chunk.n):
                    a, b = chunk.first[i], chunk.first[i + 1]
                    k = min(window, b - a)
                    own = {chunk.joined(j, k) for j in range(a, b - k + 1)} if k else ()
                    items += [batch.column(0)[at + i].as_py()] * len(own)
                    words += own
                    sizes += [k] * len(own)
            yield pa.record_batch([pa.array(items, pa.string()), pa.array(words, pa.binary()), pa.array(sizes, pa.int32())], ["item", "words", "n"])

    named = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("binary").alias("text"))
    return named.filter("item IS NOT NULL").mapInArrow(windows, "item string, words binary, n int").distinct()


class Windows:
    """A block of (item, words, n) by the hash of the words, for the lookups of a task."""

    def __init__(self, table):
        words = table.column("words").combine_chunks()
        n = table.column("n").to_numpy()
        texts = words.to_pylist()
        keys = np.zeros(len(texts), np.uint64)
        for k in np.unique(n):
            rows = np.flatnonzero(n == k)
            # every text is its own window of k words
            chunk = Words([texts[i] for i in rows])
            keys[rows] = chunk.windows(chunk.hashes(), int(k))[1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.sizes = keys[order], sorted(int(k) for k in np.unique(n))
        self.words = [texts[i] for i in order]
        self.items = table.column("item").take(pa.array(order)).to_pylist()
        # a bit for the upper half of each key: most windows of a text end here
        self.bits = max(10, min(24, 4 + len(texts).bit_length()))
        self.seen = np.zeros(1 << self.bits, bool)
        self.seen[(self.keys >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def found(self, chunk):
        """(first word, number of words, items) of each window of the chunk that an item of this block has."""
        hashes = chunk.hashes()
        for k in self.sizes:
            first, keys = chunk.windows(hashes, k)
            near = np.flatnonzero(self.seen[(keys >> np.uint64(64 - self.bits)).astype(np.int64)])
            first, keys = first[near], keys[near]
            low, high = np.searchsorted(self.keys, keys), np.searchsorted(self.keys, keys, "right")
            for i in np.flatnonzero(high > low):
                own = chunk.joined(first[i], k)
                items = [self.items[j] for j in range(low[i], high[i]) if self.words[j] == own]
                if items:
                    yield int(first[i]), k, items


_FOUND = "struct<n_words: bigint, first: array<int>, size: array<int>, items: array<string>>"
_loaded = {}


def _once(sent):
    """The block of a broadcast, made ready once per Python worker."""
    if sent not in _loaded:
        _loaded.clear()
        with pa.ipc.open_stream(sent.value) as stream:
            _loaded[sent] = Windows(stream.read_all())
    return _loaded[sent]


def _scan(sent):
    """A function of a text column to the windows found: merged runs of words, and items."""

    def scan(column: pa.Array) -> pa.Array:
        block = _once(sent) if sent is not None else None
        rows = []
        for _, chunk in _chunks(column):
            hit = np.zeros(len(chunk.starts) + 1, np.int64)
            items = [set() for _ in range(chunk.n)]
            for first, k, named in block.found(chunk) if block else ():
                hit[first] += 1
                hit[first + k] -= 1
                items[chunk.doc[first]].update(named)
            inside = np.cumsum(hit)[:-1] > 0
            for i in range(chunk.n):
                a, b = chunk.first[i], chunk.first[i + 1]
                edge = np.flatnonzero(np.diff(np.concatenate(([0], inside[a:b], [0])).astype(np.int8)))
                rows.append({"n_words": int(b - a), "first": edge[0::2].tolist(), "size": (edge[1::2] - edge[0::2]).tolist(), "items": sorted(items[i])})
        kinds = [("n_words", pa.int64()), ("first", pa.list_(pa.int32())), ("size", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))]
        return pa.array(rows, pa.struct(kinds))

    return scan


def _sent_blocks(windows, bytes_at_once):
    """Broadcasts of the windows, each of at most about ``bytes_at_once`` bytes."""
    windows = written(windows, "windows")
    size = windows.agg(F.sum(F.octet_length("words") + F.octet_length("item") + ENTRY_BYTES).alias("b")).first().b or 0
    blocks = max(1, math.ceil(size / bytes_at_once))
    for k in range(blocks):
        part = windows.filter(F.pmod(F.xxhash64("words", "item"), F.lit(blocks)) == k) if blocks > 1 else windows
        table = part.toArrow()
        if not len(table):
            continue
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        yield windows.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())


def benchmark_hits(df, benchmark, text="text", item_text="text", item_id="item_id", window=WINDOW, carry=None, sent_bytes=SENT_BYTES):
    """``row`` (struct of the columns ``carry``, all by default), ``n_words``, ``runs`` and ``items`` of each text.

    ``runs`` are the words that lie in a window of an item, as (first word, number of words), in order, apart from one
    another; ``items`` are the ids, as text and in order, of the items that have one of these windows.

    One block of windows is one pass over the texts without any exchange. More windows than ``sent_bytes`` come in
    several blocks: the texts then get a number and are written once, each block is a pass, and only the hits are
    brought together. NULL and empty texts have no words; equal texts have equal hits; an empty benchmark hits nothing.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)]).alias("row")
    named = df.select(row, F.col(f"`{text}`").cast("binary").alias("text"))
    blocks = list(_sent_blocks(item_windows(benchmark, item_text, item_id, window), sent_bytes)) or [None]
    runs = F.arrays_zip(F.col("h.first").alias("first"), F.col("h.size").alias("size")).alias("runs")
    if len(blocks) == 1:
        found = named.select("row", F.arrow_udf(_scan(blocks[0]), _FOUND)(F.col("text")).alias("h"))
        return found.select("row", "h.n_words", runs, "h.items")
    placed = written(named.withColumn("at", F.monotonically_increasing_id()), "texts")
    hits = None
    for sent in blocks:
        one = placed.select("at", F.arrow_udf(_scan(sent), _FOUND)(F.col("text")).alias("h")).select("at", "h.n_words", runs, "h.items")
        one = written(one, "hits")
        hits = one if hits is None else hits.unionByName(one)
    # a text has as many rows here as there are blocks
    merged = hits.groupBy("at").agg(
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    joined = placed.select("at", "row").join(merged, "at")
    return joined.select("row", "n_words", F.arrow_udf(_united, "array<struct<first: int, size: int>>")(F.col("runs")).alias("runs"), "items")


def _united(runs: pa.Array) -> pa.Array:
    """Sorted runs that may meet or overlap, as runs that are apart."""
    out = []
    for row in runs:
        own = []
        for r in row.as_py():
            end = r["first"] + r["size"]
            if own and r["first"] <= own[-1][1]:
                own[-1][1] = max(own[-1][1], end)
            else:
                own.append([r["first"], end])
        out.append([{"first": a, "size": b - a} for a, b in own])
    return pa.array(out, pa.list_(pa.struct([("first", pa.int32()), ("size", pa.int32())])))


def hit_words(runs="runs"):
    """Number of words in the runs."""
    return F.aggregate(runs, F.lit(0).cast("bigint"), lambda n, r: n + r["size"])


def _without(text: pa.Array, runs: pa.Array) -> pa.Array:
    out = []
    for i in range(len(text)):
        data, own = text[i].as_py(), runs[i].as_py()
        if not own:
            out.append(data)
            continue
        chunk = Words([data])
        kept, at = [], 0
        for r in own:
            kept.append(data[at : chunk.starts[r["first"]]])
            at = chunk.ends[r["first"] + r["size"] - 1]
        out.append(b"".join([*kept, data[at:]]))
    return pa.array(out, pa.binary())


def decontaminate(df, benchmark, text="text", drop_above=None, **options):
    """``df`` without what it shares with the benchmark; see ``benchmark_hits`` for windows and ``options``.

    The words of each run are cut out of the text, from the first one's beginning to the last one's end, so a run may
    leave two gaps side by side. With ``drop_above`` documents in which more than that share of the words is hit are
    dropped whole (0: every document with a hit). Columns and all other rows stay as they are, NULL texts too.
    """
    found = benchmark_hits(df, benchmark, text, **options)
    if drop_above is not None:
        found = found.filter(hit_words() <= F.col("n_words") * F.lit(float(drop_above)))
    own = F.col(f"row.`{text}`")
    clean = F.arrow_udf(_without, "binary")(own.cast("binary"), F.col("runs")).cast("string")
    clean = F.when(F.size("runs") > 0, clean).otherwise(own)
    return found.select(*[(clean if c == text else F.col(f"row.`{c}`")).alias(c) for c in df.columns])
