"""Shards of near equal bytes by histogram sort: counts between probes first, one exchange at the end."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .tables import written

#: Keys are KEY_BITS long. The first histogram has 2^FIRST cells, each refinement cuts a cell in 2^MORE.
KEY_BITS, FIRST, MORE = 62, 12, 8
#: A splitter may be off by this share of a shard's bytes.
TOLERANCE = 0.001
#: Cells with more rows are cut further, and at most so many cells have more, so both the histograms on
#: the driver and the rows that one task numbers are bounded for any table.
CELLS = 4096


def _shift(level):
    return max(KEY_BITS - FIRST - level * MORE, 0)


def _cell(level, key="key"):
    """First key of the cell of a row at a level."""
    shift = _shift(level)
    return F.shiftleft(F.shiftright(key, shift), shift)


def _splitters(cells, total, shards):
    """(first key, rows, bytes) cells in key order -> for each inner border of the shards, the cell it lies in, and
    by how many bytes the nearer end of that cell misses it."""
    out, below, j = [], 0, 1
    for first, _, size in cells:
        while j < shards and below + size > (want := total * j / shards):
            out.append((first, min(want - below, below + size - want)))
            j += 1
        below += size
    return out


def _histogram(keys, shards, tolerance):
    """Leaf cells {first key: (rows, bytes)} and their refined ancestors per level.

    Level by level, the cells in which a border lies that no cell's end meets, and those with too many
    rows for one task, are counted again in smaller cells; the others stay as they are.
    """
    rows, total = keys.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    most = max(rows // CELLS, CELLS)
    leaves, refined, level = {}, [], 0
    here = keys
    while True:
        counted = here.groupBy(_cell(level).alias("first")).agg(F.count("*").alias("rows"), F.sum("size").alias("size"))
        for r in counted.collect():
            leaves[r.first] = (r.rows, r.size)
        if _shift(level) == 0:
            break
        width = 1 << _shift(level)
        cells = sorted((k, *v) for k, v in leaves.items())
        again = {k for k, miss in _splitters(cells, total, shards) if miss > tolerance * total / shards}
        again |= {k for k, n, _ in cells if n > most}
        # only cells of this level can be cut at the next one
        again = sorted(k for k in again if k % width == 0 and k in leaves and (level == 0 or _parent(k, level) in refined[-1]))
        if not again:
            break
        for k in again:
            del leaves[k]
        refined.append(frozenset(again))
        here = here.filter(_cell(level).isin(again))
        level += 1
    return leaves, refined, total


def _parent(key, level):
    shift = _shift(level - 1)
    return key >> shift << shift


def _borders(leaves, total, shards):
    """(first key, shard, rows before it in the shard) of each leaf: a border is put at the nearer end of its cell."""
    out, below, shard, before = [], 0, 0, 0
    for first, (rows, size) in sorted(leaves.items()):
        middle = below + size / 2
        place = min(int(middle * shards / total), shards - 1) if total else 0
        while shard < place:
            shard, before = shard + 1, 0
        out.append((first, shard, before))
        before += rows
        below += size
    return out


def shard_rows(df, order, size, shards=16, tolerance=TOLERANCE, name="keys"):
    """``df`` (all columns) with ``shard`` and ``slot``, by key, so that shards have near equal sums of ``size``.

    ``order``: columns of which the sort key is made: 31 bits of the hash of the first column, then 31
    bits of the hash of all. Rows that agree in the first column are neighbours, and a group of any size can still be cut.
    The key's range is split into cells whose rows and bytes are counted exactly, in passes over the keys
    alone; only cells in which a border lies, or with too many rows, are counted again more finely, until
    every border is within ``tolerance`` of a shard's share (or at one key, which is not cut). Then the rows
    are exchanged once, by cell, and numbered there: slot 0, 1, 2, ... within the shard, in key order.

    Sizes must not be NULL; NULL in ``order`` is a value. Rows that repeat in all of ``order`` stay together. Fewer
    rows than shards leave shards empty. An empty table gives an empty result. Columns of ``df`` keep their names;
    those that are added are ``shard`` and ``slot``, so these two names are taken.
    """
    spark = df.sparkSession
    half = KEY_BITS // 2
    part = lambda *c: F.shiftrightunsigned(F.xxhash64(*c), 64 - half)
    key = F.shiftleft(part(order[0]), half).bitwiseOR(part(*order, F.lit(1)))
    keyed = written(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(size).cast("long").alias("size"), key.alias("key")), name)
    leaves, refined, total = _histogram(keyed.select("key", "size"), shards, tolerance)
    cell = _cell(0)
    for level, cells in enumerate(refined):
        cell = F.when(_cut(refined, level), _cell(level + 1)).otherwise(cell)
    # as many rows as the histograms have cells
    table = spark.createDataFrame(_borders(leaves, total, shards), "cell bigint, shard int, before bigint")
    placed = keyed.withColumn("cell", cell).join(F.broadcast(table), "cell")
    within = Window.partitionBy("cell").orderBy("key", *[F.col(f"row.`{c}`") for c in order])
    slot = F.col("before") + F.row_number().over(within) - 1
    return placed.select("row.*", "shard", slot.cast("long").alias("slot"))


def _cut(refined, level):
    """Rows whose cells were cut at each level up to this one."""
    out = F.lit(True)
    for at in range(level + 1):
        out = out & _cell(at).isin(sorted(refined[at]))
    return out
