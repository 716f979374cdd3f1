"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .tables import scratch, small, written

#: No source is repeated more often than this.
MOST = 3
WEIGHTS = (1, 2, 3)
#: Rows of a source that one task rounds at a time, and remainders that one task combines.
LEAF, FAN = 512, 64
WORD = r"[^\x20\x09-\x0D]+"
#: Copies of one text that one task writes out at a time.
RUN = 1024
_PLACE = (1 << 33) - 1


def numbered(df, order, name):
    """``df`` with ``place``, 0, 1, 2, ... in ``order`` (a column), without one task for all rows."""
    ranged = df.repartitionByRange(order).sortWithinPartitions(order)
    ranged = written(ranged.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    # a row per partition
    counts = ranged.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn("place", F.col("_before") + F.col("_at").bitwiseAND(_PLACE)).drop("_at", "_part", "_before")


def targets(sources, weights=WEIGHTS, most=MOST):
    """Sources (source, size) with ``place`` by code point (NULL last), ``weight`` (repeating by place)
    and ``target``: the weight's share of all sizes, but ``most`` times the size of the source at the highest;
    what is cut off goes to the others by weight, until no target is cut.

    Each round is one aggregate over the sources; only the common factor of the weights comes back.
    """
    listed = numbered(sources, F.col("source").asc_nulls_last(), "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    listed = written(listed.withColumn("weight", weight), "weights")
    cap, factor, cut = most * F.col("size").cast("double"), 0.0, -1
    while True:
        capped = F.col("weight") * factor >= cap
        got = listed.agg(
            F.sum("size").alias("all"),
            F.coalesce(F.sum(F.when(capped, cap)), F.lit(0.0)).alias("capped"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).alias("open"),
            F.coalesce(F.sum(capped.cast("long")), F.lit(0)).alias("n"),
        ).first()
        if got.n == cut or not got.open or not got.all:
            break
        factor, cut = (got.all - got.capped) / got.open, got.n
    return listed.withColumn("target", F.least(cap, F.col("weight") * factor))


def _uniform(key, level):
    """A number from 0 to 1 for each key, the same on every run."""
    x = key ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2**53


def pivotal(p, size, rng):
    """Round probabilities ``p`` (between 0 and 1) so that the sum of ``p * size`` stays as it is.

    Rows are in order of size, the largest first. Two open rows are paired: mass goes from one to the other,
    the direction drawn so that expected values stay what they were, until one of them is 0 or 1. The row that is still open
    is paired with the next. Partners are of about the same size, so a large row is soon settled and
    the one that stays open at last is a small one, unless one is larger than all others together.
    Returns p with one open row at most, and that row (or -1).
    """
    p, i = p.copy(), -1
    for j in np.flatnonzero((p > 0) & (p < 1)):
        if i < 0:
            i = j
            continue
        mass, room = p[[i, j]] * size[[i, j]], (1 - p[[i, j]]) * size[[i, j]]
        up, down = min(room[0], mass[1]), min(mass[0], room[1])
        if rng.random() * (up + down) < down:
            p[i] = 1.0 if room[0] <= mass[1] else min(p[i] + up / size[i], 1.0)
            p[j] = 0.0 if mass[1] <= room[0] else max(p[j] - up / size[j], 0.0)
        else:
            p[i] = 0.0 if mass[0] <= room[1] else max(p[i] - down / size[i], 0.0)
            p[j] = 1.0 if room[1] <= mass[0] else min(p[j] + down / size[j], 1.0)
        i = next((row for row in (i, j) if 0 < p[row] < 1), -1)
    return p, int(i)


def _rounder(level, last):
    def rounded(table: pa.Table) -> pa.Table:
        key = table["key"].to_numpy().view(np.uint64)
        size = table["size"].to_numpy().astype(float)
        order = np.lexsort((_uniform(key, 1000 + level), -size))
        p = table["p"].to_numpy()[order]
        rng = np.random.default_rng([level, int(np.bitwise_xor.reduce(key))])
        p, left = pivotal(np.clip(p, 0.0, 1.0), size[order], rng)
        if last and left >= 0:
            p[left] = 1.0 if _uniform(key, 2000)[order][left] < p[left] else 0.0
        done = np.empty_like(p)
        done[order] = p
        return table.set_column(table.column_names.index("p"), "p", pa.array(done))

    return rounded


def _key(id, text, source):
    """Hash of the three, in which NULL is a value of its own."""
    return F.xxhash64(id, text, source, F.isnull(text), F.isnull(source))


def copies(df, id="doc_id", text="text", source="source", weights=WEIGHTS, most=MOST):
    """How often each row is taken so that the words of the sources come to their targets.

    Size is the number of words of a text (NULL: 0). A source's rows are wanted target / size times
    each; the whole part is given to all, the rest are copy probabilities, which are rounded in leaves of
    about LEAF rows of a source, chosen by hash. Trades keep the words of a source as they are, so
    all that a leaf leaves is at most one open row; these are combined FAN leaves at a time, up to one per source, which
    is drawn. Words taken differ from the target by one text of the source at most, as a rule a small one. Everything random comes
    from hashes of id, text and source: reruns agree, and a lost task gives the same again.

    Returns a row per distinct (id, text, source): ``id``, ``key`` (hash of the three), ``rows`` (how many
    rows repeat it), ``size``, ``source_size``, ``target`` and ``copies`` (of all those rows together). Repeated rows are
    one unit whose copies are shared out by ``shares``; NULL ids, texts and sources are values like others.
    Texts without words have no mass: the rest of theirs is drawn by hash. An empty table gives an empty result.
    """
    key = _key(id, text, source)
    units = df.select(
        F.col(id).alias("id"),
        F.col(source).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        key.alias("key"),
    )
    units = written(units.groupBy("id", "source", "size", "key").agg(F.count("*").alias("rows")), "units")
    total = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("size"), F.count("*").alias("units"))
    wanted = written(targets(total, weights, most).withColumnRenamed("size", "source_size"), "targets")
    ratio = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(1.0)
    joined = units.join(
        small(wanted.withColumnRenamed("source", "_source")), F.col("source").eqNullSafe(F.col("_source"))
    ).drop("_source", "weight")
    leaves = F.ceil(F.col("units") / LEAF)
    open_rows = (
        joined.withColumn("mean", ratio * F.col("rows"))
        .withColumn("whole", F.floor("mean"))
        .withColumn("p", F.col("mean") - F.col("whole"))
        .withColumn("leaf", F.pmod(F.xxhash64("key", F.lit(1)), leaves))
        .drop("mean", "units")
    )
    largest = wanted.agg(F.coalesce(F.max(F.ceil(F.col("units") / LEAF)), F.lit(0)).alias("n")).first().n
    weightless = F.col("size") == 0
    drawn = F.pmod(F.xxhash64("key", F.lit(2)), F.lit(1 << 30)) / float(1 << 30) < F.col("p")
    parts = [open_rows.filter(weightless).withColumn("p", drawn.cast("double"))]
    level, rest = 0, open_rows.filter(~weightless)
    while True:
        last = largest <= 1
        done = rest.groupBy("place", "leaf").applyInArrow(_rounder(level, last), rest.schema)
        done = written(done, "rounded")
        settled = (F.col("p") == 0) | (F.col("p") == 1)
        parts.append(done.filter(settled))
        if last:
            break
        rest = done.filter(~settled).withColumn("leaf", F.floor(F.col("leaf") / FAN))
        level, largest = level + 1, -(-largest // FAN)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        "id", "key", "source", "rows", "size", "source_size", "target", (F.col("whole") + F.col("p")).cast("long").alias("copies")
    )


def shares(units):
    """``copies`` units as one row per row of the table: each of a unit's rows gets an equal share, the
    first ones one copy more. Units of very many rows are written out RUN rows at a time."""
    one = units.filter("rows = 1")
    many = units.filter("rows > 1")
    if many.isEmpty():
        return one
    run = F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / RUN))).alias("run")
    many = many.select("*", run).repartition(F.xxhash64("key", "run"))
    row = F.explode(F.sequence(F.col("run") * RUN, F.least((F.col("run") + 1) * RUN, F.col("rows")) - 1)).alias("row")
    many = many.select("*", row)
    more = F.when(F.col("row") < F.col("copies") % F.col("rows"), 1).otherwise(0)
    many = many.withColumn("copies", F.floor(F.col("copies") / F.col("rows")) + more)
    return one.unionByName(many.drop("run", "row"))


def mix(df, id="doc_id", text="text", source="source", weights=WEIGHTS, most=MOST):
    """The mix itself: rows of ``df`` (all columns), each as often as ``copies`` takes it.

    Rows that agree in id, text and source are copies of one another; one of them stands for all.
    """
    with scratch(df.sparkSession):
        units = written(copies(df, id, text, source, weights, most), "copies", keep=True)
    taken = units.filter("copies > 0").select(F.col("key").alias("taken_key"), "copies")
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    docs = df.select(whole.alias("row"), _key(id, text, source).alias("key"))
    repeated = not units.filter("rows > 1").isEmpty()
    if repeated:
        docs = docs.dropDuplicates(["key"])
    out = docs.join(taken, F.col("key") == F.col("taken_key"))
    run = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / RUN)))
    if repeated:
        out = out.withColumn("run", run).repartition("key", "run")
        out = out.withColumn("copies", F.least(F.col("copies") - F.col("run") * RUN, F.lit(RUN)))
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
