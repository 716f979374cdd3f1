"""Phrase collocations: counts of all frequent phrases, and how much more often they come than their parts.

Candidates grow word by word: a phrase can only be frequent if all phrases within it are, so only those go on. Which
phrases of the texts are candidates is found by hashes, which may let too many through but never too few. They are put
into double-array tries, each of bounded size, that are sent to the executors; there numpy moves the states of all
text positions at once, one level of the trie after the other, and counts the accepting ones.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from .tables import written
from .words import LOWER, mixed, span_hashes

#: Bytes of text that are worked on at a time, rows of counts that a task holds, and bytes of phrases in one trie.
CHUNK_BYTES, HELD_ROWS, TRIE_BYTES = 2 << 20, 1_000_000, 8 << 20
#: Bits of the largest filter of hashes (32 MB).
MOST_BITS = 28
NO_LANG = "und"
GAP, BREAK = np.zeros(256, bool), np.zeros(256, bool)
GAP[[0x20, 0x09]] = True
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_known = {}


def _lang_hash(lang):
    if lang not in _known:
        _known[lang] = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
    return _known[lang]


class Pieces:
    """Some whole texts, lower-cased, their words, and which words lie in one piece."""

    def __init__(self, langs, texts):
        self.langs = sorted(set(langs))
        data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        at = np.concatenate(([0], np.cumsum(sizes + 1)))
        ends_piece = BREAK[data]
        word = ~(GAP[data] | ends_piece)
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False])).astype(np.int8)))
        self.data, self.starts, self.ends = data, edge[0::2], edge[1::2]
        self.bytes = data[word]
        piece = np.cumsum(ends_piece, dtype=np.int32)[self.starts]
        # joined[i]: the words i and i + 1 lie in one piece
        self.joined = piece[1:] == piece[:-1]
        code = {lang: i for i, lang in enumerate(self.langs)}
        per_text = np.fromiter((code[lang] for lang in langs), np.int32, len(langs))
        self.lang = np.repeat(per_text, np.diff(np.searchsorted(self.starts, at)))

    def words(self):
        """The words as an Arrow array of bytes."""
        offsets = np.concatenate(([0], np.cumsum(self.ends - self.starts))).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(self.starts), [None, pa.py_buffer(offsets), pa.py_buffer(self.bytes)])

    def hashes(self):
        return span_hashes(self.data, self.starts, self.ends)

    def lang_hashes(self):
        return np.array([_lang_hash(lang) for lang in self.langs], np.uint64)

    def lang_column(self, rows):
        return pa.DictionaryArray.from_arrays(pa.array(self.lang[rows]), pa.array(self.langs, pa.string())).cast(pa.string())

    def within(self, k):
        """Whether the k words from each word on lie in one piece; for all but the last k - 1 words."""
        n = max(0, len(self.starts) - k + 1)
        out = np.ones(n, bool)
        for i in range(k - 1):
            out &= self.joined[i : i + n]
        return out


def _pieces(batches):
    """Pieces of the batches (lang, text), whole texts of about CHUNK_BYTES at a time."""
    langs, texts, size = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            data = text.as_py() or b""
            if texts and size + len(data) > CHUNK_BYTES:
                yield Pieces(langs, texts)
                langs, texts, size = [], [], 0
            langs.append(lang.as_py())
            texts.append(data)
            size += len(data) + 1
    if texts:
        yield Pieces(langs, texts)


class Counted:
    """Counts of rows of a task, combined before they are given on; at most about HELD_ROWS at once."""

    def __init__(self, keys):
        self.keys, self.parts, self.rows = keys, [], 0

    def add(self, columns):
        table = pa.table(columns, self.keys)
        self.parts.append(table.group_by(self.keys, use_threads=False).aggregate([([], "count_all")]).rename_columns([*self.keys, "n"]))
        self.rows += len(self.parts[-1])
        if self.rows > HELD_ROWS:
            self._combine()
            # what doesn't combine well goes out
            if self.rows > HELD_ROWS // 2:
                yield from self.flush()

    def _combine(self):
        if len(self.parts) > 1:
            table = pa.concat_tables(self.parts)
            self.parts = [table.group_by(self.keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*self.keys, "n"])]
            self.rows = len(self.parts[0])

    def flush(self):
        self._combine()
        for table in self.parts:
            yield from table.combine_chunks().to_batches(max_chunksize=100_000)
        self.parts, self.rows = [], 0


def _count_words(batches):
    """Words of each language; all of a language together have NULL as the word."""
    counted, totals = Counted(["lang", "word"]), {}
    for p in _pieces(batches):
        for code, n in enumerate(np.bincount(p.lang, minlength=len(p.langs))):
            totals[p.langs[code]] = totals.get(p.langs[code], 0) + int(n)
        yield from counted.add([p.lang_column(slice(None)), p.words()])
    yield from counted.flush()
    yield pa.record_batch([pa.array(totals.keys(), pa.string()), pa.nulls(len(totals), pa.binary()), pa.array(totals.values(), pa.int64())], ["lang", "word", "n"])


def _key(lang_hashes, hashes, first, k):
    """Hash of the k words from each of the words ``first`` on, and their language."""
    total = lang_hashes.copy()
    for i in range(k):
        total = total * _STEP + hashes[first + i]
    return mixed(total)


def _word_hash(lang: pa.Array, word: pa.Array) -> pa.Array:
    """Hash of a word, and of the word in its language, as the tasks compute them."""
    sizes = np.fromiter(map(len, word.to_pylist()), np.int64, len(word))
    data = np.frombuffer(b"".join(word.to_pylist()), np.uint8)
    ends = np.cumsum(sizes)
    hashes = span_hashes(data, ends - sizes, ends)
    langs = np.fromiter(map(_lang_hash, lang.to_pylist()), np.uint64, len(lang))
    keys = _key(langs, hashes, np.arange(len(hashes)), 1)
    return pa.StructArray.from_arrays([pa.array(hashes.view(np.int64)), pa.array(keys.view(np.int64))], ["h", "key"])


def _phrase_key(lang: pa.Array, hashes: pa.Array) -> pa.Array:
    """The key of a phrase from the hashes of its words, which are as many in every row."""
    flat = hashes.flatten().to_numpy().view(np.uint64)
    k = len(flat) // max(1, len(lang))
    langs = np.fromiter(map(_lang_hash, lang.to_pylist()), np.uint64, len(lang))
    return pa.array(_key(langs, flat, np.arange(len(lang)) * k, k).view(np.int64))


class Filter:
    """Bits of the hashes that may go on, one bit each; others may share it."""

    def __init__(self, bits, places, words):
        self.shift = np.uint64(64 - bits)
        self.words = np.zeros(1 << (bits - 6), np.uint64)
        self.words[places] = words.view(np.uint64)

    def has(self, keys):
        place = keys >> self.shift
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _filter(frequent):
    """A Filter of the column ``key`` of a written table, put together from 64 bits a row, and sent."""
    bits = max(12, min(MOST_BITS, 4 + frequent.count().bit_length()))
    place = F.shiftrightunsigned("key", 64 - bits)
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(key, {64 - bits}) & 63 AS INT))")
    table = frequent.groupBy(F.shiftright(place, 6).alias("place")).agg(F.bit_or(bit).alias("word")).toArrow()
    made = Filter(bits, table.column("place").to_numpy(), table.column("word").to_numpy())
    return frequent.sparkSession.sparkContext.broadcast(made)


def _grow(k, sent):
    """Counts of the phrases of k words whose two phrases of k - 1 words pass the filter."""
    names = ["lang", *[f"h{i}" for i in range(k)]]

    def grow(batches):
        counted, passes = Counted(names), sent.value
        for p in _pieces(batches):
            hashes, langs = p.hashes(), p.lang_hashes()[p.lang]
            shorter = np.flatnonzero(p.within(k - 1))
            good = np.zeros(len(hashes) + 1, bool)
            good[shorter] = passes.has(_key(langs[shorter], hashes, shorter, k - 1))
            whole = p.within(k)
            first = np.flatnonzero(whole & good[: len(whole)] & good[1 : len(whole) + 1])
            yield from counted.add([p.lang_column(first), *[pa.array(hashes[first + i].view(np.int64)) for i in range(k)]])
        yield from counted.flush()

    return grow


class Tries:
    """A double array with one trie per language. A word is two steps, by the upper and the lower half of its number.

    ``base`` and ``check`` hold the edges: from state s the symbol c leads to t = base[s] + c if check[t] = s.
    ``accept`` has the number of the phrase that ends in a state, or -1.
    """

    def __init__(self, langs, phrases):
        coded = pa.array(langs, pa.string()).dictionary_encode()
        self.langs = coded.dictionary.to_pylist()
        data = np.frombuffer(b"\n".join(phrases) + b"\n", np.uint8)
        ends = np.flatnonzero((data == 0x20) | (data == 0x0A))
        last = np.flatnonzero(data[ends] == 0x0A)
        sizes = np.diff(last, prepend=-1)
        offsets = np.concatenate(([0], np.cumsum(np.diff(ends, prepend=-1) - 1))).astype(np.int32)
        own = data[(data != 0x20) & (data != 0x0A)]
        words = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(own)]).dictionary_encode()
        self.words = words.dictionary
        self.half = max(1, (len(self.words).bit_length() + 1) // 2)
        numbers, first = words.indices.to_numpy().astype(np.int64), np.cumsum(sizes) - sizes
        node = coded.indices.to_numpy().astype(np.int64)
        nodes, symbols = len(self.langs), 1 << self.half
        parents, edges, accepts = [], [], []
        for level in range(int(sizes.max())):
            rows = np.flatnonzero(sizes > level)
            number = numbers[first[rows] + level]
            for symbol in (number >> self.half, number & (symbols - 1)):
                pairs, inverse = np.unique(node[rows] * symbols + symbol, return_inverse=True)
                parents.append(pairs // symbols)
                edges.append(pairs % symbols)
                node[rows] = nodes + inverse
                nodes += len(pairs)
            ended = rows[sizes[rows] == level + 1]
            accepts.append((node[ended], ended))
        self._pack(nodes, np.concatenate(parents), np.concatenate(edges), symbols)
        self.accept = np.full(len(self.check), -1, np.int32)
        for nodes_, rows in accepts:
            self.accept[self.place[nodes_]] = rows
        del self.place

    def _pack(self, nodes, parent, symbol, symbols):
        """A base for each node such that the edges of all nodes take different cells; nodes with many edges come first."""
        roots = len(self.langs)
        begin = np.searchsorted(parent, np.arange(nodes + 1))
        degree = np.diff(begin)
        free = np.ones(max(4 * symbols, int(1.3 * len(parent)) + symbols) + roots, bool)
        free[:roots] = False
        base, random, top = np.zeros(nodes, np.int64), np.random.default_rng(1), roots

        def grown(free, size):
            return free if len(free) >= size else np.concatenate((free, np.ones(max(size, len(free) * 5 // 4) - len(free), bool)))

        order = np.argsort(-degree, kind="stable")
        large = order[degree[order] > 32]
        for s in large:
            own = symbol[begin[s] : begin[s + 1]]
            # the first fit just before and behind what is taken
            free = grown(free, top + 2 * symbols + 2)
            low = max(roots, top - symbols)
            tries = np.arange(low, top + 1)
            fits = free[tries[:, None] + own].all(1)
            base[s] = tries[np.argmax(fits)]
            free[base[s] + own] = False
            top = max(top, int(base[s] + own[-1]) + 1)
        for d in range(32, 1, -1):
            left = np.flatnonzero(degree == d)
            rounds = 0
            while len(left):
                own = symbol[begin[left][:, None] + np.arange(d)]
                tries = random.integers(roots, len(free) - symbols, len(left))
                cells = tries[:, None] + own
                owner = np.full(len(free), -1, np.int64)
                number = np.arange(len(left))
                owner[cells] = number[:, None]
                won = free[cells].all(1) & (owner[cells] == number[:, None]).all(1)
                base[left[won]] = tries[won]
                free[cells[won]] = False
                left, rounds = left[~won], rounds + 1
                if rounds % 40 == 0:
                    free = grown(free, len(free) * 5 // 4)
        single = np.flatnonzero(degree == 1)
        cells = np.flatnonzero(free[symbols:]) + symbols
        if len(cells) < len(single):
            cells = np.concatenate((cells, len(free) + np.arange(len(single) - len(cells))))
        base[single] = cells[: len(single)] - symbol[begin[single]]
        place = np.empty(nodes, np.int64)
        place[:roots] = np.arange(roots)
        # nodes are numbered level by level, in the order of their edges
        place[roots:] = base[parent] + symbol
        size = int(max(place.max(), base.max())) + symbols + 1
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.base[place] = base
        self.check[place[roots:]] = place[parent]
        self.place = place

    def count(self, p, longest, into):
        """Add to ``into`` how often each phrase comes in the pieces."""
        number = pc.index_in(p.words(), value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False)
        code = {lang: i for i, lang in enumerate(self.langs)}
        roots = np.array([code.get(lang, -1) for lang in p.langs], np.int32)
        state = roots[p.lang] if len(p.lang) else np.zeros(0, np.int32)
        at = np.flatnonzero((number >= 0) & (state >= 0))
        state = state[at]
        high, low = number >> self.half, number & ((1 << self.half) - 1)
        for level in range(longest):
            for symbol in (high, low):
                to = self.base[state] + symbol[at]
                good = self.check[to] == state
                at, state = at[good], to[good]
            accepted = self.accept[state]
            into += np.bincount(accepted[accepted >= 0], minlength=len(into))
            # on to the next word, if it is in the same piece
            inside = at < len(p.joined)
            inside[inside] = p.joined[at[inside]] & (number[at[inside] + 1] >= 0)
            at, state = at[inside] + 1, state[inside]


def _count_phrases(sent, longest):
    """(id, n) of the phrases of a trie in the texts of a task."""

    def count(batches):
        ids, tries = sent.value
        counts = np.zeros(len(ids), np.int64)
        for p in _pieces(batches):
            tries.count(p, longest, counts)
        found = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(ids[found]), pa.array(counts[found])], ["id", "n"])

    return count


def _exact(named, candidates, longest, trie_bytes):
    """(lang, phrase, a): how often each candidate comes, from one pass over the texts for each trie."""
    spark = candidates.sparkSession
    size = candidates.agg(F.sum(F.octet_length("phrase")).alias("b")).first().b or 0
    blocks = math.ceil(size / trie_bytes)
    counts = spark.createDataFrame([], "id bigint, n bigint")
    for k in range(blocks):
        part = candidates.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).toArrow()
        if not len(part):
            continue
        tries = Tries(part.column("lang").to_pylist(), part.column("phrase").cast(pa.binary()).to_pylist())
        sent = spark.sparkContext.broadcast((part.column("id").to_numpy(), tries))
        one = named.mapInArrow(_count_phrases(sent, longest), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
        counts = counts.unionByName(written(one, "phrase-counts"))
    return candidates.join(counts, "id").select("lang", "phrase", F.col("n").alias("a"))


def frequent_phrases(df, lang="lang", text="text", longest=3, least=10, trie_bytes=TRIE_BYTES):
    """(words, phrases): (lang, word, f) and (lang, phrase, a) that come ``least`` times or more, and the words NULL with
    the number of all words of each language. Both are written tables; words of a phrase are one space apart.

    Texts are lower-cased (A to Z) and cut into pieces at ``.,;:!?`` and 0x0A to 0x0D, and these into words at
    spaces and tabs; a phrase lies within a piece and counts wherever it begins. NULL as a language is NO_LANG.
    """
    named = df.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(f"`{text}`").cast("binary").alias("text"))
    words = named.mapInArrow(_count_words, "lang string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("f"))
    words = written(words.filter((F.col("f") >= least) | F.col("word").isNull()), "words")
    known = words.filter("word IS NOT NULL").select("lang", "word", F.arrow_udf(_word_hash, "struct<h: bigint, key: bigint>")("lang", "word").alias("x"))
    known = written(known.select("lang", "word", "x.h", "x.key"), "word-hashes")
    candidates, shorter = None, known
    for k in range(2, longest + 1):
        names = [f"h{i}" for i in range(k)]
        schema = ", ".join(["lang string", *[f"{h} bigint" for h in names], "n bigint"])
        # the tasks have combined their counts, so the rows are dealt out as they are
        counts = named.mapInArrow(_grow(k, _filter(shorter)), schema).repartition("lang", *names)
        grown = counts.groupBy("lang", *names).agg(F.sum("n").alias("n"))
        key = F.arrow_udf(_phrase_key, "bigint")("lang", F.array(*names)).alias("key")
        shorter = written(grown.filter(F.col("n") >= least).select("lang", *names, key), f"grown-{k}")
        phrase = shorter
        for h in names:
            phrase = phrase.join(known.select("lang", F.col("h").alias(h), F.col("word").alias(f"w{h}")), ["lang", h])
        phrase = phrase.select("lang", F.concat_ws(" ", *[F.col(f"w{h}").cast("string") for h in names]).alias("phrase"))
        candidates = phrase if candidates is None else candidates.unionByName(phrase)
    candidates = written(candidates.withColumn("id", F.monotonically_increasing_id()), "candidates")
    phrases = _exact(named, candidates, longest, trie_bytes)
    return words.withColumn("word", F.col("word").cast("string")), written(phrases.filter(F.col("a") >= least), "phrases")


def collocations(df, lang="lang", text="text", longest=3, least=10, covered=50, top=2000, trie_bytes=TRIE_BYTES):
    """The ``top`` phrases of 2 to ``longest`` words of each language: lang, rank, phrase, a, l, r, n, score.

    Of the phrases that come ``least`` times or more (``frequent_phrases``), a phrase with a occurrences that is cut into
    parts with l and r scores floor(1000000 * a * a / (l * r)) at its weakest cut, of equal ones the first. It is dropped if
    a longer frequent phrase that contains it has ``covered`` percent of its occurrences or more. Order: score, then a, both
    descending, then the phrase by its bytes. ``n`` counts all words of the language.

    NULL and empty texts have no words; a language without a phrase has no row; repeated rows count each time.
    """
    words, phrases = frequent_phrases(df, lang, text, longest, least, trie_bytes)
    totals = words.filter("word IS NULL").select("lang", F.col("f").alias("n"))
    parts = words.filter("word IS NOT NULL").select("lang", F.col("word").alias("phrase"), F.col("f").alias("a")).unionByName(phrases)
    split = phrases.withColumn("w", F.split("phrase", " "))
    cuts = split.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"), "w")
    left, right = F.expr("array_join(slice(w, 1, k), ' ')"), F.expr("array_join(slice(w, k + 1, size(w)), ' ')")
    cuts = cuts.select("lang", "phrase", "a", "k", left.alias("left"), right.alias("right"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    # 38 digits take the products of counts up to 10^16; div gives whole numbers
    wide = "CAST({} AS DECIMAL(38, 0))"
    score = F.expr(f"({wide.format('a')} * a * 1000000) div ({wide.format('l')} * r)")
    weakest = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    # every phrase within a longer one, with the most that a longer one has
    inner = split.filter(F.size("w") > 2).select("a", "lang", "w", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("size"))
    inner = inner.select("a", "lang", "w", "size", F.explode(F.expr("sequence(1, size(w) - size + 1)")).alias("at"))
    inner = inner.select("lang", F.expr("array_join(slice(w, at, size), ' ')").alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(F.col("longer") * 100 < F.col("a") * covered, F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    rows = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
