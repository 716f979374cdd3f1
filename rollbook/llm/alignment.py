"""Which tokens of two tokenizers cover the same bytes, and how usual each such pair is in a corpus.

Documents are aligned once and written with their distinct pairs of ids and how often each of them is linked. Over these it is
counted in how many documents each pair is linked. The distinct pairs get a minimal perfect hash, built shard by shard; the
counts are vectors with one cell per pair and no gap, added up in a tree. Then the counts are looked up for the written
pairs; the pair itself is stored in its cell, so that a strange one is never taken for another.
"""

import json
import math
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import written
from .words import mixed

#: Pairs in a shard of the hash, and pairs in a bucket of a shard, on average.
SHARD_PAIRS, BUCKET_PAIRS = 200_000, 2
#: Rows of counts in one dense vector's task, vectors that are added at once, and bytes of the table sent at once.
VECTOR_ROWS, FAN, SENT_BYTES = 1_000_000, 16, 96 << 20
#: Bytes of text worked on at a time, segments remembered in each of two generations, pairs counted before they are combined, and
#: pairs looked up at a time.
CHUNK_BYTES, SEGMENTS, HELD_PAIRS, FOUND_PAIRS = 1 << 20, 150_000, 2_000_000, 500_000
#: Bytes of a row group of the written alignment: its writer and reader hold one, beside the tokenizers.
GROUP_BYTES = 16 << 20
#: Links of a group from which on its pairs are formed from distinct ids.
WIDE = 10_000
#: What is written between the ids A and B of a group, and between groups.
MARKS = ";", "|"
_STEP = np.uint64(0x9E3779B97F4A7C15)
SPACE = "▁"
#: Fixed value: how a byte-level model cuts texts before it merges bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters():
    """Letter -> byte of the byte-level alphabet: printable Latin-1 stands for itself, all other bytes for U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + i): b for i, b in enumerate(other)}}


class Aligner:
    """Two tokenizers, and what they make of segments of text.

    A segment begins with a space and ends before a space that follows a visible ASCII or alphanumeric character. No
    token of either tokenizer goes over such a border, so segments are tokenized, aligned and remembered by themselves. If the
    piece model has a piece that could go over it, the whole text is one segment.
    """

    def __init__(self, contents, marks=MARKS):
        import sentencepiece
        from tokenizers import Tokenizer

        content_a, content_b = contents
        model = json.loads(content_a)
        letters = _byte_letters()
        vocabulary = model["model"]["vocab"]
        self.bytes_a = {i: bytes(letters.get(c, 0) for c in token) for token, i in vocabulary.items()}
        self.ranks = _ranks(model, self.bytes_a)
        if self.ranks:
            # the same merges, several times faster
            import tiktoken

            self.encode_a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens={}).encode_ordinary
        else:
            own = Tokenizer.from_str(content_a.decode("utf-8"))
            own.encode_special_tokens = True
            self.encode_a = lambda text: own.encode(text, add_special_tokens=False).ids
        self.b = sentencepiece.SentencePieceProcessor(model_proto=content_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        most = max(self.bytes_a) + 1
        self.sizes_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(most)], np.int64)
        self.sizes_b = np.array(list(map(len, self.bytes_b)), np.int64)
        # how an id is written, by what comes behind it
        self.written_a = [[f"{i}{c}" for i in range(most)] for c in (",", marks[0])]
        self.written_b = [[f"{i}{c}" for i in range(len(pieces))] for c in (",", marks[1], "")]
        self.width = len(pieces)
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.front = len(self.b.encode("a"))
        self.newer, self.older = {}, {}

    def cut(self, text):
        """The segments of a text, without the space each of them begins with."""
        if not self.apart:
            return [text]
        out, open_ = [], None
        for part in text.split(" "):
            open_ = part if open_ is None else f"{open_} {part}"
            if open_ and ("!" <= open_[-1] <= "~" or open_[-1].isalnum()):
                out.append(open_)
                open_ = None
        return out if open_ is None else [*out, open_]

    def segments(self, texts):
        """Entries of the segments of each text; what is new is tokenized together."""
        newer, older = self.newer, self.older
        cut = [self.cut(t) for t in texts]
        new = {s for own in cut for s in own if s not in newer}
        known = {s: older[s] for s in new if s in older}
        new.difference_update(known)
        known.update(zip(new, self._entries(list(new))))
        found = [[newer.get(s) or known[s] for s in own] for own in cut]
        if len(newer) + len(known) > SEGMENTS:
            self.older, self.newer = newer, {}
        for s, entry in known.items():
            if len(s) < 100:
                self.newer[s] = entry
        return found

    def _ids(self, segments):
        """Ids A and B of each segment."""
        ids_a = [self.encode_a(f" {s}") for s in segments]
        if not self.apart:
            return ids_a, self.b.encode(segments, num_threads=1)
        # behind another word, as a lone space would be nothing
        return ids_a, [ids[self.front :] for ids in self.b.encode([f"a {s}" for s in segments], num_threads=1)]

    def _fits(self, data, ids_a, ids_b):
        return b"".join([self.bytes_a[i] for i in ids_a]) == data and b"".join([self.bytes_b[i] for i in ids_b]) == data

    def _entries(self, segments):
        """(tokens A, tokens B, groups, links, groups as text, pairs, times of each pair or None) of each segment;
        (None, ids A, ids B) if the bytes differ."""
        ids_a, ids_b = self._ids(segments)
        good = [i for i, s in enumerate(segments) if self._fits(f" {s}".encode(), ids_a[i], ids_b[i])]
        made = self._aligned([ids_a[i] for i in good], [ids_b[i] for i in good])
        out = [(None, a, b) for a, b in zip(ids_a, ids_b)]
        for i, entry in zip(good, made):
            out[i] = entry
        return out

    def _aligned(self, ids_a, ids_b):
        """Entries of segments whose tokens have the same bytes, all at once: ends are places in their joined bytes."""
        if not ids_a:
            return []
        flat_a, flat_b = (np.fromiter((i for own in ids for i in own), np.int64) for ids in (ids_a, ids_b))
        per_a, per_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (ids_a, ids_b))
        ends_a, ends_b = np.cumsum(self.sizes_a[flat_a]), np.cumsum(self.sizes_b[flat_b])
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        in_a, in_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        # segments end where groups end
        last = np.searchsorted(cuts, ends_a[np.cumsum(per_a) - 1]) + 1
        first = np.concatenate(([0], last[:-1]))
        segment = np.repeat(np.arange(len(ids_a)), last - first)
        links = np.diff(np.concatenate(([0], np.cumsum(in_a * in_b)))[np.concatenate(([0], last))])
        keys, times, own = self._pairs(flat_a, flat_b, group_a, group_b, in_a, in_b, segment)
        edge = np.searchsorted(own, np.arange(len(ids_a) + 1)).tolist()
        # every id with what is written behind it, group by group, A before B
        ends_group = np.concatenate((group_a[1:] != group_a[:-1], [True])).tolist(), np.concatenate((group_b[1:] != group_b[:-1], [True]))
        behind_b = np.where(ends_group[1], 1, 0)
        behind_b[np.cumsum(per_b) - 1] = 2
        words = [self.written_a[c][i] for i, c in zip(flat_a.tolist(), ends_group[0])] + [self.written_b[c][i] for i, c in zip(flat_b.tolist(), behind_b.tolist())]
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable").tolist()
        words = [words[i] for i in order]
        stops = np.cumsum(per_a + per_b).tolist()
        keys, times, out, at = keys.tolist(), times.tolist(), [], 0
        for i, (n_a, n_b, n, m) in enumerate(zip(per_a.tolist(), per_b.tolist(), (last - first).tolist(), links.tolist())):
            k, own_times = tuple(keys[edge[i] : edge[i + 1]]), None
            if len(k) != m:
                own_times = tuple(times[edge[i] : edge[i + 1]])
            out.append((n_a, n_b, n, m, "".join(words[at : stops[i]]), k, own_times))
            at = stops[i]
        return out

    def _pairs(self, flat_a, flat_b, group_a, group_b, in_a, in_b, segment):
        """(pair, times, segment) of the distinct pairs of each segment, in its order."""
        first_b = np.cumsum(in_b) - in_b
        wide = in_a * in_b > WIDE
        each = np.where(wide, 0, in_b)[group_a]
        place = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
        group = np.repeat(group_a, each)
        pair = np.repeat(flat_a, each) * self.width + flat_b[first_b[group] + place]
        pairs, segments, times = [pair], [segment[group]], [np.ones(len(pair), np.int64)]
        for g in np.flatnonzero(wide):
            # many tokens that share no end: by distinct ids
            (a, n), (b, m) = (np.unique(flat[group == g], return_counts=True) for flat, group in ((flat_a, group_a), (flat_b, group_b)))
            pairs.append((a[:, None] * self.width + b).ravel())
            times.append((n[:, None] * m).ravel())
            segments.append(np.full(len(pairs[-1]), segment[g]))
        pair, own, times = np.concatenate(pairs), np.concatenate(segments), np.concatenate(times)
        order = np.lexsort((pair, own))
        pair, own, times = pair[order], own[order], times[order]
        new = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (own[1:] != own[:-1])))) if len(pair) else np.zeros(0, np.int64)
        return pair[new], np.add.reduceat(times, new) if len(new) else times, own[new]

    def align(self, texts):
        """Entries of each text; no entry if there is no text or the joined tokens are not its bytes."""
        out = []
        for text, own in zip(texts, self.segments([t or "" for t in texts])):
            if not text:
                own = ()
            elif any(e[0] is None for e in own):
                ids = [[i for part in parts for i in part] for parts in self._ids(self.cut(text))]
                own = ()
                if self._fits(f" {text}".encode(), *ids):
                    own = self._aligned(*[[i] for i in ids])
            out.append(own)
        return out


def _ranks(model, tokens):
    """Bytes -> id of a byte-level model whose ids are the order of its merges and which cuts texts by PATTERN; else None."""
    before = model.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if not plain or model.get("normalizer") or model["model"].get("dropout") or model["model"].get("ignore_merges"):
        return None
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["model"]["merges"]]
    ids = [model["model"]["vocab"][token] for token in merged]
    if any(a >= b for a, b in zip(ids, ids[1:])):
        return None
    special = {t["id"] for t in model.get("added_tokens", ())}
    return {token: i for i, token in tokens.items() if i not in special}


_loaded = {}


def _once(contents, marks):
    """An aligner, made once per Python worker."""
    key = (contents.value[0][:64], len(contents.value[0]), len(contents.value[1]), marks)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Aligner(contents.value, marks)
    return _loaded[key]


def _unload():
    """A worker that has aligned texts needs its memory for the counts now."""
    if _loaded:
        _loaded.clear()
        pa.default_memory_pool().release_unused()


def _slices(column):
    """(first row, texts) of a column, about CHUNK_BYTES at a time."""
    texts, size, at = [], 0, 0
    for i in range(len(column)):
        text = column[i].as_py()
        if texts and size + len(text or "") > CHUNK_BYTES:
            yield at, texts
            texts, size, at = [], 0, i
        texts.append(text)
        size += len(text or "")
    if texts:
        yield at, texts


def _parts_of(values, sizes):
    """Rows of bytes: the next ``sizes`` of the values each."""
    offsets = np.concatenate(([0], np.cumsum(sizes))) * values.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary())


def _times_by_text(made, limit):
    """(pairs, times, how many per text) of the distinct linked pairs of texts, from their entries."""
    flat, sizes, more = [], [], []
    for i, own in enumerate(made):
        before = len(flat)
        flat.extend(chain.from_iterable([e[5] for e in own]))
        sizes.append(len(flat) - before)
        more.extend([(i * limit + pair, n - 1) for e in own if e[6] for pair, n in zip(e[5], e[6]) if n > 1])
    keys = np.fromiter(flat, np.int64, len(flat)) + np.repeat(np.arange(len(sizes)) * limit, sizes)
    keys, times = np.unique(keys, return_counts=True)
    if more:
        both = np.array(more, np.int64)
        np.add.at(times, np.searchsorted(keys, both[:, 0]), both[:, 1])
    return keys % limit, times, np.diff(np.searchsorted(keys, np.arange(len(sizes) + 1) * limit))


def _align_texts(contents, marks, limit, kind):
    """The rows of a task with the alignment of their texts, their distinct pairs and the times of each."""

    def rows(batches):
        aligner = _once(contents, marks)
        for batch in batches:
            for at, texts in _slices(batch.column(1)):
                made = aligner.align(texts)
                sums = [[sum([e[i] for e in own]) for own in made] for i in range(4)]
                groups = [marks[1].join([e[4] for e in own]) for own in made]
                pairs, times, sizes = _times_by_text(made, limit)
                # as few bytes as the largest takes; a reader knows them by the length of the row
                times = times.astype(np.min_scalar_type(int(times.max(initial=0))))
                columns = [*[pa.array(c, pa.int64()) for c in sums], pa.array(groups, pa.string()), _parts_of(pairs.astype(kind), sizes), _parts_of(times, sizes)]
                yield pa.record_batch([batch.column(0).slice(at, len(texts)), *columns], ["row", *[name for name, _ in _ALIGNED]])

    return rows


def _pairs_in(column, kind):
    """(pairs, how many per row) of a column of written pairs."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // kind.itemsize
    return np.frombuffer(b"".join(column.to_pylist()), kind).astype(np.int64), sizes


def _count_pairs(kind):
    """(pair, n): in how many texts of a task a pair is linked."""

    def count(batches):
        _unload()
        held, sums = [], []

        def combine():
            keys, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.int64), return_counts=True)
            held.clear()
            sums.append((keys, n))
            if len(sums) > 1:
                both, place = np.unique(np.concatenate([s[0] for s in sums]), return_inverse=True)
                total = np.bincount(place, np.concatenate([s[1] for s in sums]), len(both)).astype(np.int64)
                sums[:] = [(both, total)]

        for batch in batches:
            held.append(_pairs_in(batch.column(0), kind)[0])
            if sum(map(len, held)) > HELD_PAIRS:
                combine()
                if len(sums[0][0]) > HELD_PAIRS:
                    yield pa.record_batch([pa.array(c) for c in sums.pop()], ["pair", "n"])
        combine()
        yield pa.record_batch([pa.array(c) for c in sums.pop()], ["pair", "n"])

    return count


def minimal_hash(keys):
    """Seeds of a minimal perfect hash of distinct 64-bit keys: one per bucket.

    A seed d >= 0 sends the keys of a bucket to the cells ``mixed(hash + d * STEP) % n``; -1 - c says that the only key of the
    bucket is in cell c. Buckets with many keys are placed first; all buckets of one size try a seed at once.
    """
    n = len(keys)
    hashes = mixed(keys.view(np.uint64))
    buckets = max(1, -(-n // BUCKET_PAIRS))
    bucket = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=buckets)
    first = np.cumsum(sizes) - sizes
    seeds, free = np.zeros(buckets, np.int32), np.ones(n, bool)
    owner = np.empty(n, np.int64)
    for size in range(int(sizes.max(initial=0)), 1, -1):
        left, seed = np.flatnonzero(sizes == size), 0
        while len(left):
            own = hashes[order[first[left][:, None] + np.arange(size)]]
            cells = (mixed(own + np.array([seed], np.uint64) * _STEP) % np.uint64(n)).astype(np.int64)
            number = np.broadcast_to(np.arange(len(left))[:, None], cells.shape)
            owner[cells] = number
            won = free[cells].all(1) & (owner[cells] == number).all(1)
            # two keys of one bucket in one cell
            won[won] = (np.diff(np.sort(cells[won], 1), axis=1) > 0).all(1)
            seeds[left[won]] = seed
            free[cells[won]] = False
            left, seed = left[~won], seed + 1
    single = np.flatnonzero(sizes == 1)
    seeds[single] = -1 - np.flatnonzero(free)
    return seeds


def cells_of(keys, seeds, n):
    """Cell of each key; any cell for a key that the hash was not made for."""
    hashes = mixed(keys.view(np.uint64))
    seed = seeds[(hashes % np.uint64(len(seeds))).astype(np.int64)]
    cell = (mixed(hashes + np.maximum(seed, 0).astype(np.uint64) * _STEP) % np.uint64(n)).astype(np.int64)
    return np.where(seed < 0, -1 - seed, cell)


def _build(key, table):
    """A shard of the hash: its seeds, and the pair of each cell."""
    keys = table.column("pair").to_numpy()
    seeds = minimal_hash(keys)
    stored = np.empty_like(keys)
    stored[cells_of(keys, seeds, len(keys))] = keys
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "seeds": [seeds.tobytes()], "pairs": [stored.tobytes()]})


def _dense(key, counts, shard):
    """The counts of a branch of a shard as a vector over its cells."""
    seeds = np.frombuffer(shard.column("seeds")[0].as_py(), np.int32)
    n = len(shard.column("pairs")[0].as_py()) // 8
    cells = cells_of(counts.column("pair").to_numpy(), seeds, n)
    vector = np.zeros(n, np.int64)
    np.add.at(vector, cells, counts.column("n").to_numpy())
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "branch": pa.array([key[1].as_py()], pa.int32()), "vector": [vector.tobytes()]})


def _added(key, table):
    """The sum of some vectors of a shard."""
    total = 0
    for v in table.column("vector"):
        total = total + np.frombuffer(v.as_py(), np.int64)
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "branch": pa.array([key[1].as_py()], pa.int32()), "vector": [total.tobytes()]})


def _best_of(width):
    """(id, best) of the ids A in the shards of a task."""

    def best(batches):
        for batch in batches:
            for pairs, vector in zip(batch.column(0), batch.column(1)):
                ids = np.frombuffer(pairs.as_py(), np.int64) // width
                counts = np.frombuffer(vector.as_py(), np.int64)
                order = np.argsort(ids, kind="stable")
                own, first = np.unique(ids[order], return_index=True)
                yield pa.record_batch([pa.array(own), pa.array(np.maximum.reduceat(counts[order], first))], ["id", "best"])

    return best


class PairCounts:
    """Some shards of the hash with the counts of their pairs, and the highest count of each id A."""

    def __init__(self, name, shards, rows, best):
        self.name, self.shards, self.best = name, shards, best
        sizes = np.zeros(shards, np.int64)
        widths = np.zeros(shards, np.int64)
        for r in rows:
            sizes[r["shard"]], widths[r["shard"]] = len(r["pairs"]) // 8, len(r["seeds"]) // 4
        rows = sorted(rows, key=lambda r: r["shard"])
        self.sizes, self.first = sizes, np.cumsum(sizes) - sizes
        self.widths, self.start = widths, np.cumsum(widths) - widths
        self.seeds = np.frombuffer(b"".join([r["seeds"] for r in rows]), np.int32)
        self.pairs = np.frombuffer(b"".join([r["pairs"] for r in rows]), np.int64)
        self.counts = np.frombuffer(b"".join([r["vector"] for r in rows]), np.int64)

    def find(self, keys, ids):
        """(count, whether it is the highest of the id) of each pair; 0 for a pair that is in no shard here."""
        hashes = mixed(keys.view(np.uint64))
        shard = _shard_of(keys, self.shards)
        here = np.flatnonzero(self.sizes[shard] > 0)
        hashes, shard = hashes[here], shard[here]
        seed = self.seeds[self.start[shard] + (hashes % self.widths[shard].astype(np.uint64)).astype(np.int64)]
        cell = (mixed(hashes + np.maximum(seed, 0).astype(np.uint64) * _STEP) % self.sizes[shard].astype(np.uint64)).astype(np.int64)
        cell = self.first[shard] + np.where(seed < 0, -1 - seed, cell)
        same = self.pairs[cell] == keys[here]
        counts, top = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        counts[here[same]] = self.counts[cell[same]]
        top[(counts > 0) & (counts == self.best[np.minimum(ids, len(self.best) - 1)])] = 1
        return counts, top


def _shard_of(keys, shards):
    """The shard of each pair, by other bits than its bucket."""
    return (mixed(keys.view(np.uint64) * _STEP + np.uint64(1)) % np.uint64(shards)).astype(np.int64)


def _with_shard(shards):
    """A column function: the shard of a pair."""

    def shard(pairs: pa.Array) -> pa.Array:
        return pa.array(_shard_of(pairs.to_numpy(zero_copy_only=False), shards).astype(np.int32))

    return F.arrow_udf(shard, "int")(F.col("pair"))


def pair_table(aligned, kind, shard_pairs=SHARD_PAIRS, vector_rows=VECTOR_ROWS):
    """(shards, table): the distinct pairs of the column ``pairs`` as shards of a minimal perfect hash, a row each
    with its ``seeds``, the ``pairs`` by cell and the ``vector`` of counts."""
    partial = written(aligned.select("pairs").mapInArrow(_count_pairs(kind), "pair bigint, n bigint"), "pair-counts")
    distinct = written(partial.select("pair").distinct(), "pairs")
    rows, n = partial.count(), distinct.count()
    shards = max(1, math.ceil(n / shard_pairs))
    hashed = distinct.withColumn("shard", _with_shard(shards)).groupBy("shard").applyInArrow(_build, "shard int, seeds binary, pairs binary")
    hashed = written(hashed, "minimal-hash")
    branches = max(1, math.ceil(rows / shards / vector_rows))
    schema = "shard int, branch int, vector binary"
    spread = partial.withColumn("shard", _with_shard(shards)).withColumn("branch", F.pmod(F.spark_partition_id(), F.lit(branches)).cast("int"))
    copies = hashed.withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(branches - 1))))
    vectors = spread.groupBy("shard", "branch").cogroup(copies.groupBy("shard", "branch")).applyInArrow(_dense_or_none, schema)
    while branches > 1:
        branches = -(-branches // FAN)
        vectors = vectors.withColumn("branch", F.expr(f"branch div {FAN}").cast("int")).groupBy("shard", "branch").applyInArrow(_added, schema)
    return shards, written(hashed.join(vectors.select("shard", "vector"), "shard"), "pair-table")


def _dense_or_none(key, counts, shard):
    if len(counts):
        return _dense(key, counts, shard)
    return pa.table({"shard": pa.array([], pa.int32()), "branch": pa.array([], pa.int32()), "vector": pa.array([], pa.binary())})


def _blocks(shards, table, width, sent_bytes):
    """Broadcasts of the table, some shards at a time, each of about ``sent_bytes`` at most."""
    context = table.sparkSession.sparkContext
    best = table.select("pairs", "vector").mapInArrow(_best_of(width), "id bigint, best bigint").groupBy("id").agg(F.max("best").alias("best"))
    # a row per id of the vocabulary at most
    best = best.toArrow()
    ids = best.column("id").to_numpy()
    highest = np.zeros(int(ids.max(initial=0)) + 1, np.int64)
    highest[ids] = best.column("best").to_numpy()
    size = table.agg(F.sum(F.octet_length("seeds") + F.octet_length("pairs") + F.octet_length("vector")).alias("b")).first().b or 0
    blocks = max(1, math.ceil(size / sent_bytes))
    for k in range(blocks):
        rows = table.filter(F.col("shard") % blocks == k).collect()
        if rows or not k:
            yield context.broadcast(PairCounts(k, shards, rows, highest))


#: Columns of the written alignment, and what is looked up for them.
_ALIGNED = [
    ("n_a", "bigint"), ("n_b", "bigint"), ("n_groups", "bigint"), ("n_links", "bigint"), ("groups", "string"), ("pairs", "binary"), ("times", "binary"),
]
_FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


def _look_up(sent, kind, width):
    """What the counts of the links of a row sum up to, from its ``pairs`` and ``times``."""

    def sums(pairs, times, counts):
        keys, sizes = _pairs_in(pairs, kind)
        n = [np.frombuffer(t, f"u{len(t) // m}") for t, m in zip(times.to_pylist(), sizes.tolist()) if m]
        n = np.concatenate(n).astype(np.int64) if n else np.zeros(0, np.int64)
        count, best = counts.find(keys, keys // width)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        return [np.diff(np.concatenate(([0], np.cumsum(x)))[ends]) for x in (n * best, n * count)]

    def look_up(pairs: pa.Array, times: pa.Array) -> pa.Array:
        _unload()
        sizes = pc.binary_length(pairs).to_numpy(zero_copy_only=False).astype(np.int64) // kind.itemsize
        # whole rows, about FOUND_PAIRS pairs at a time
        edges = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // FOUND_PAIRS)) + 1).tolist(), len(pairs)]
        parts = [sums(pairs[low:high], times[low:high], sent.value) for low, high in zip(edges, edges[1:])]
        return pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], ["n_best", "count_sum"])

    return F.arrow_udf(look_up, "struct<n_best: bigint, count_sum: bigint>")("pairs", "times").alias("found")


def _width(content):
    """Number of pieces of a piece model."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=content).get_piece_size()


def tokenizers(spark, byte_level, pieces):
    """A byte-level tokenizer (JSON) and a piece model, read by the driver and ready to be sent to the executors."""
    contents = []
    for path in (byte_level, pieces):
        with open(path, "rb") as file:
            contents.append(file.read())
    return spark.sparkContext.broadcast(tuple(contents))


def align(df, contents, text="text", carry=None, shard_pairs=SHARD_PAIRS, vector_rows=VECTOR_ROWS, sent_bytes=SENT_BYTES, marks=MARKS):
    """``row`` (struct of the columns ``carry``, all by default) and the alignment of each text by two ``tokenizers`` A and B.

    A takes a space and the text, B the text, which gets the space by itself. Places where tokens of both end cut them into
    groups; ``groups`` has their ids A, the first of the ``marks``, and their ids B, and the second mark between groups: ``a1,a2;b1|a3;b2``. A link is a token of A and
    one of B in a group; the count of its pair of ids says in how many texts that pair is linked. ``n_best`` links have the
    highest count that their id A has anywhere, ``count_sum`` adds up the counts of all links.

    NULL and empty texts, and those whose joined tokens differ from space and text, have no tokens: zeros and ''. Repeated
    rows count each time. The alignment is written once, with a number per row. A table of pairs larger than ``sent_bytes`` comes
    in blocks: each block is a pass over the written pairs whose sums are added.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)]).alias("row")
    named = df.select(row, F.col(f"`{text}`").cast("string").alias("text"))
    width = _width(contents.value[1])
    limit = (max(json.loads(contents.value[0])["model"]["vocab"].values()) + 1) * width
    kind = np.dtype(np.uint32 if limit < 1 << 32 else np.int64)
    types = {"bigint": T.LongType(), "string": T.StringType(), "binary": T.BinaryType()}
    schema = T.StructType([named.schema["row"], *[T.StructField(name, types[of]) for name, of in _ALIGNED]])
    aligned = named.mapInArrow(_align_texts(contents, tuple(marks), limit, kind), schema).withColumn("at", F.monotonically_increasing_id())
    aligned = written(aligned, "aligned", group_bytes=GROUP_BYTES)
    blocks = list(_blocks(*pair_table(aligned, kind, shard_pairs, vector_rows), width, sent_bytes))
    own = ["row", "n_a", "n_b", "n_groups", "n_links", "groups"]
    if len(blocks) == 1:
        return aligned.select(*own, _look_up(blocks[0], kind, width)).select(*own, "found.*").select("row", *_FIELDS)
    parts = [aligned.select("at", _look_up(sent, kind, width)).select("at", "found.*") for sent in blocks]
    sums = parts[0]
    for p in parts[1:]:
        sums = sums.unionByName(p)
    sums = written(sums.groupBy("at").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")), "sums")
    return aligned.select("at", *own).join(sums, "at").select("row", *_FIELDS)
