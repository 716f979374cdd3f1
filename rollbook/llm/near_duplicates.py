"""MinHash near-duplicates, candidates verified sequentially by posterior similarity, then exactly."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .components import components
from .tables import scratch, small, written
from .words import chunks, mixed

#: A pair of similarity 0.8 shares none of the bands with probability (1 - 0.8^5)^32 = 3e-6.
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Signatures are compared in batches of this many hashes.
BATCH = 20
#: A pair is dropped once its similarity reaches the limit with less than this probability.
MISS = 1e-6
#: Members of a bucket that all of it is compared with, before what is left is compared.
HUBS = 3
#: Classes of a bucket that one task compares with as many others, and shingles that these have.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
_rng = np.random.default_rng(7)
_FACTOR = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_SALT = np.uint64(0xA0761D6478BD642F)


def _sets(chunk, k):
    """(text, value) of the distinct shingles of a chunk, in order of text and value. A text with
    fewer than k words has its whole word sequence as one shingle."""
    words = chunk.hashes()
    at, value = chunk.windows(words, k)
    doc = chunk.doc[at]
    size = np.diff(chunk.first)
    for i in np.flatnonzero((size > 0) & (size < k)):
        one = words[chunk.first[i] : chunk.first[i + 1]]
        total = np.uint64(len(one))
        for w in one:
            total = mixed((total ^ w) * _SALT + np.uint64(1))
        doc, value = np.append(doc, i), np.append(value, total)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


PROFILE = "struct<n: bigint, class: bigint, signature: binary>"


def _profile(k):
    """Size, number of the set, and signature of each text; NULL number and signature without words."""

    def profile(text: pa.Array) -> pa.Array:
        sizes, classes, signatures = [], [], []
        with np.errstate(over="ignore"):
            for _, chunk in chunks(text, lower=True):
                doc, value = _sets(chunk, k)
                n = np.bincount(doc, minlength=chunk.n)
                sizes.append(n)
                filled = np.flatnonzero(n)
                number, lowest = np.zeros(chunk.n, np.int64), np.zeros((chunk.n, HASHES), np.uint32)
                if len(filled):
                    first = (np.cumsum(n) - n)[filled]
                    total = mixed(np.add.reduceat(mixed(value ^ _SALT), first) + n[filled].astype(np.uint64) * _SALT)
                    number[filled] = total.view(np.int64)
                    for j in range(HASHES):
                        least = np.minimum.reduceat(value * _FACTOR[j] + _SHIFT[j], first)
                        lowest[filled, j] = least >> np.uint64(32)
                classes.append(np.ma.array(number, mask=n == 0))
                signatures += [row.tobytes() if m else None for row, m in zip(lowest, n)]
        n = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
        number = np.ma.concatenate(classes) if classes else np.ma.zeros(0, np.int64)
        columns = [
            pa.array(n.astype(np.int64)),
            pa.array(number.data, mask=np.ma.getmaskarray(number)),
            pa.array(signatures, pa.binary()),
        ]
        return pa.StructArray.from_arrays(columns, ["n", "class", "signature"])

    return profile


def _matrix(signatures):
    return np.frombuffer(b"".join(signatures.to_pylist()), np.uint32).reshape(len(signatures), HASHES)


def _band_numbers(signatures):
    """A number for each band of each signature, a row for each signature."""
    rows = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _SALT, rows.shape[:2])
    for i in range(ROWS):
        key = mixed(key * _FACTOR[0] + rows[:, :, i])
    return key.view(np.int64)


def _bands(signature: pa.Array) -> pa.Array:
    offsets = np.arange(0, BANDS * (len(signature) + 1), BANDS, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(_band_numbers(_matrix(signature)).ravel()))


def least_matches(similarity, miss=MISS):
    """(hashes compared, fewest matches with which a pair stays) per batch.

    With a uniform prior, after m matches among n hashes the similarity follows Beta(m+1, n-m+1); it
    is at least t with the probability that n+1 draws of chance t give at most m hits.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, 0
        while True:
            below += math.comb(n + 1, m) * similarity**m * (1 - similarity) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def _alive(left, right, steps):
    """Numbers of the rows (pairs of signatures) that are still in the running after all batches."""
    alive, hits = np.arange(len(left)), np.zeros(len(left), np.int64)
    for n, least in steps:
        part = slice(n - BATCH, n)
        hits = hits + (left[alive, part] == right[alive, part]).sum(axis=1)
        going = hits >= least
        alive, hits = alive[going], hits[going]
    return alive


def _may_match(similarity):
    """Whether a pair of signatures is still in the running after all batches."""
    steps = least_matches(similarity)

    def may_match(a: pa.Array, b: pa.Array) -> pa.Array:
        out = np.zeros(len(a), bool)
        out[_alive(_matrix(a), _matrix(b), steps)] = True
        return pa.array(out)

    return may_match


def _running(table, percent, steps):
    """(an asking class, the classes it is in the running with) of a block, as row numbers.

    Only classes of different components are compared. A pair belongs to the bucket of the first band
    that it shares, and where both ask, to the question of the smaller number: so it comes up once.
    """
    number, component, n = (table[c].to_numpy() for c in ("class", "component", "n"))
    asks, minor = (table[c].to_numpy() for c in ("asks", "minor"))
    signatures = _matrix(table["signature"].combine_chunks())
    bands, bucket = _band_numbers(signatures), table["bucket"][0].as_py()
    other = np.flatnonzero(~asks)
    for i in np.flatnonzero(asks):
        own = (component[other] != component[i]) & (~minor[other] | (number[i] < number[other]))
        rest = other[own & (100 * np.minimum(n[other], n[i]) >= percent * np.maximum(n[other], n[i]))]
        first = (bands[rest] == bands[i]).argmax(axis=1)
        rest = rest[bands[i][first] == bucket]
        hit = rest[_alive(np.broadcast_to(signatures[i], (len(rest), HASHES)), signatures[rest], steps)]
        if len(hit):
            yield i, hit


MEMBER = "bucket bigint, one bigint, other bigint, class bigint, component bigint, n bigint, asks boolean, minor boolean"


def _block_members(percent):
    """The rows of a block that are in the running with another, without their signatures."""
    steps = least_matches(percent / 100)

    def block_members(table: pa.Table) -> pa.Table:
        running = np.zeros(len(table), bool)
        for i, hit in _running(table, percent, steps):
            running[i] = running[hit] = True
        return table.select([c.split()[0] for c in MEMBER.split(", ")]).filter(pa.array(running))

    return block_members


def _block_links(percent):
    """Links (a, b) by full sets that join the components of a block, none of them needless."""
    steps = least_matches(percent / 100)

    def block_links(table: pa.Table) -> pa.Table:
        number, n = table["class"].to_numpy(), table["n"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
        root = np.unique(table["component"].to_numpy(), return_inverse=True)[1]
        a, b = [], []
        for i, hit in _running(table, percent, steps):
            hit = hit[root[hit] != root[i]]
            if not len(hit):
                continue
            values = np.concatenate([sets[j] for j in hit])
            place = np.searchsorted(sets[i], values)
            place[place == len(sets[i])] = 0
            starts = np.cumsum(n[hit]) - n[hit]
            shared = np.add.reduceat((sets[i][place] == values).astype(np.int64), starts)
            for j in hit[100 * shared >= percent * (n[i] + n[hit] - shared)]:
                if root[j] != root[i]:
                    root[root == root[j]] = root[i]
                    a.append(number[i])
                    b.append(number[j])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return block_links


def _shingles(k):
    def shingles(text: pa.Array) -> pa.Array:
        out = []
        with np.errstate(over="ignore"):
            for _, chunk in chunks(text, lower=True):
                doc, value = _sets(chunk, k)
                cut = np.searchsorted(doc, np.arange(chunk.n + 1))
                out += [value[cut[i] : cut[i + 1]].tobytes() for i in range(chunk.n)]
        return pa.array(out, pa.binary())

    return shingles


def _shared(a: pa.Array, b: pa.Array) -> pa.Array:
    """Shingles that two sets have in common."""
    out = np.zeros(len(a), np.int64)
    for i in range(len(a)):
        x, y = (np.frombuffer(side[i].as_buffer(), np.uint64) for side in (a, b))
        if len(x) > len(y):
            x, y = y, x
        place = np.searchsorted(y, x)
        place[place == len(y)] = 0
        out[i] = (y[place] == x).sum() if len(y) else 0
    return pa.array(out)


def near_duplicates(df, id="doc_id", text="text", k=5, percent=80):
    """Component of each text under the links "shingle sets are at least ``percent`` % similar".

    Words are runs without space and 0x09 to 0x0D, A to Z in lower case; a shingle is ``k`` words.
    Returns ``id``, ``n_shingles``, ``component_id`` (smallest id that links reach), ``kept`` (id
    is the component's) and ``text_key`` (hash of the text), a row for each row of ``df``.

    Texts with equal sets are one class, and only one text of a class takes part. Classes that share
    a band of their signatures are candidates. Not all pairs of a bucket are made: the members are first
    compared with HUBS of them, and only classes that are then still in different components of a bucket
    are compared with the rest of it, block by block, each pair in the bucket of its first shared band. A pair is pruned
    batch by batch with miss probability MISS; survivors are verified on full sets, those of a block inside it,
    and a block gives out the links that join components, never its pairs. Sets and classes are compared by 64-bit hashes.

    Texts without words (and NULL) have no shingles and are linked with nothing. NULL ids never become a
    component's id unless all its ids are NULL. Repeated rows are in one class; rows that share an
    id but not the text are classes of their own. An empty table gives an empty result. Other columns
    are not read.
    """
    docs = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    with scratch(df.sparkSession):
        named = written(_named(docs, k, percent), "named", keep=True)
    return named.select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        "text_key",
    )


def _named(docs, k, percent):
    """(id, text_key, n, component_id) of all rows."""
    profile = F.arrow_udf(_profile(k), PROFILE)(F.col("text").cast("binary"))
    profiles = written(docs.select("id", "text_key", profile.alias("p")).select("id", "text_key", "p.*"), "profiles")
    classes = written(
        profiles.filter(F.col("class").isNotNull())
        .groupBy("class")
        .agg(
            F.min("id").alias("id"),
            F.coalesce(F.min_by("text_key", "id"), F.min("text_key")).alias("text_key"),
            F.min("n").alias("n"),
            F.any_value("signature").alias("signature"),
        ),
        "classes",
    )
    labels = _linked(docs, classes, k, percent)
    numbered = classes.select("class", "id").join(labels, F.col("node") == F.col("class"), "left")
    numbered = numbered.select("class", "id", F.coalesce("component", "class").alias("component"))
    first = numbered.groupBy("component").agg(F.min("id").alias("component_id"))
    named = numbered.join(first, "component").select("class", "component_id")
    out = profiles.select("id", "text_key", "n", "class").join(named, "class", "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "text_key", "n", component.alias("component_id"))


def _members(classes):
    """(bucket, class) of the buckets that hold two classes or more."""
    bands = F.arrow_udf(_bands, "array<bigint>")(F.col("signature"))
    buckets = classes.select("class", F.explode(bands).alias("bucket"))
    shared = (
        buckets.groupBy("bucket")
        .agg(F.min("class").alias("least"), F.max("class").alias("most"))
        .filter(F.col("least") != F.col("most"))
        .select("bucket")
    )
    return written(buckets.join(shared, "bucket").select("bucket", "class"), "buckets")


def _linked(docs, classes, k, percent):
    """(node, component) of the classes that have links."""
    members = _members(classes)
    signatures = written(classes.join(members.select("class").distinct(), "class", "left_semi"), "signatures")
    found = _verified(docs, signatures, _hub_survivors(members, signatures, percent), k, percent)
    labels = components(found)
    left = _open_buckets(members, labels)
    if left.isEmpty():
        return labels
    more = _rest_links(docs, left, signatures, k, percent)
    return labels if more.isEmpty() else components(found.unionByName(more), labels)


def _open_buckets(members, labels):
    """(bucket, class, component) of the buckets whose classes are in several components."""
    named = members.join(labels.withColumnRenamed("node", "class"), "class", "left")
    named = written(named.select("bucket", "class", F.coalesce("component", "class").alias("component")), "members")
    mixed_up = (
        named.groupBy("bucket")
        .agg(F.min("component").alias("least"), F.max("component").alias("most"))
        .filter(F.col("least") != F.col("most"))
        .select("bucket")
    )
    return written(named.join(mixed_up, "bucket"), "members")


def _hub_survivors(members, signatures, percent):
    """Pairs in the running of each class with the hubs of its buckets, which are drawn by hash."""
    drawn = [F.min_by("class", F.xxhash64("class", F.lit(turn))) for turn in range(HUBS)]
    hubs = members.groupBy("bucket").agg(F.array_distinct(F.array(*drawn)).alias("hubs"))
    pairs = members.join(written(hubs, "hubs"), "bucket").select("class", F.explode("hubs").alias("hub"))
    pairs = pairs.filter(F.col("class") != F.col("hub"))
    pairs = pairs.select(F.least("hub", "class").alias("a"), F.greatest("hub", "class").alias("b")).distinct()
    side = lambda name: signatures.select(
        F.col("class").alias(name), F.col("signature").alias(f"signature_{name}"), F.col("n").alias(f"n_{name}")
    )
    may = F.arrow_udf(_may_match(percent / 100), "boolean")(F.col("signature_a"), F.col("signature_b"))
    size = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(size)
    return written(both.filter(may).select("a", "b", "n_a", "n_b"), "survivors")


def _rest_links(docs, members, signatures, k, percent):
    """Links among the classes of a bucket that are in different components, enough to join them.

    Classes outside the bucket's largest component ask, all classes answer. Both are dealt to
    blocks by hash, and each block of the one meets each block of the other in a task, so no
    task gets more than about two blocks. Blocks are compared by signatures first; the classes left in the
    running meet again with their sets. No pair is a row unless it is a link that joins components.
    """
    rows = members.join(signatures.select("class", "n"), "class")
    sizes = rows.groupBy("bucket", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("shingles"))
    sizes = sizes.withColumn("size", F.struct("rows", "component", "shingles"))
    buckets = sizes.groupBy("bucket").agg(F.max("size").alias("most"), F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles"))
    blocks = lambda rows, shingles: F.ceil(F.greatest(rows / BLOCK, shingles / BLOCK_SHINGLES))
    buckets = buckets.select(
        "bucket",
        F.col("most.component").alias("largest"),
        blocks(F.col("rows") - F.col("most.rows"), F.col("shingles") - F.col("most.shingles")).alias("askers"),
        blocks(F.col("rows"), F.col("shingles")).alias("answerers"),
    )
    rows = rows.join(written(buckets, "blocks"), "bucket").withColumn("minor", F.col("component") != F.col("largest"))
    own = lambda n: F.pmod(F.xxhash64("class"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    asking = rows.filter("minor").withColumn("one", own("askers")).withColumn("other", every("answerers"))
    answering = rows.withColumn("other", own("answerers")).withColumn("one", every("askers"))
    both = asking.withColumn("asks", F.lit(True)).unionByName(answering.withColumn("asks", F.lit(False)))
    both = both.drop("largest", "askers", "answerers").join(signatures.select("class", "signature"), "class")
    block = ["bucket", "one", "other"]
    running = written(both.groupBy(*block).applyInArrow(_block_members(percent), MEMBER), "running")
    sets = _sets_of(docs, signatures, running.select("class").distinct(), k)
    full = running.join(sets, "class").join(signatures.select("class", "signature"), "class")
    return written(full.groupBy(*block).applyInArrow(_block_links(percent), "a bigint, b bigint"), "links")


def _sets_of(docs, signatures, wanted, k):
    """(class, shingles): the full sets of the ``wanted`` classes, shingles in order."""
    texts = signatures.join(wanted, "class", "left_semi")
    texts = written(texts.select("class", F.col("id").alias("own_id"), F.col("text_key").alias("own_key")), "ends")
    same = (F.col("text_key") == F.col("own_key")) & F.col("id").eqNullSafe(F.col("own_id"))
    shingles = F.arrow_udf(_shingles(k), "binary")(F.col("text").cast("binary"))
    sets = docs.join(small(texts), same).select("class", shingles.alias("shingles"))
    return written(sets.groupBy("class").agg(F.any_value("shingles").alias("shingles")), "sets")


def _verified(docs, signatures, survivors, k, percent):
    """The pairs (a, b) whose full sets are similar enough."""
    ends = survivors.select(F.col("a").alias("class")).union(survivors.select("b")).distinct()
    sets = _sets_of(docs, signatures, ends, k)
    of = lambda name: sets.select(F.col("class").alias(name), F.col("shingles").alias(f"set_{name}"))
    shared = F.arrow_udf(_shared, "bigint")(F.col("set_a"), F.col("set_b"))
    both = survivors.join(of("a"), "a").join(of("b"), "b").select("a", "b", "n_a", "n_b", shared.alias("shared"))
    exact = 100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))
    return written(both.filter(exact).select("a", "b"), "links")


def keep_one(df, id="doc_id", text="text", k=5, percent=80):
    """The rows of ``df`` (all columns) with one row of each group of near-duplicates.

    The row with the group's smallest id stays. Where ids repeat or are NULL, the rows that would stay
    are told apart by their text, and one of those that agree in id and text stays.
    """
    found = near_duplicates(df, id, text, k, percent)
    counted = found.filter("kept").agg(F.count("*").alias("n"), F.countDistinct(id).alias("ids")).first()
    dropped = found.filter("not kept").select(F.col(id).alias("dropped_id"), F.col("text_key").alias("dropped_key")).distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(whole.alias("row"), F.col(id).alias("id"), F.xxhash64(text).alias("key"))
    same = F.col("id").eqNullSafe(F.col("dropped_id")) & (F.col("key") == F.col("dropped_key"))
    out = rows.join(small(dropped), same, "left_anti")
    out = out if counted.n == counted.ids else out.dropDuplicates(["id", "key"])
    return out.select("row.*")
