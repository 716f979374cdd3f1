"""Row-order logic per key, spread over time.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task. The functions
here cut the time line of a key into segments. ``segment`` is a column that never falls as
the order rises (the hour of the event, or the sequence number divided by a width). Rows
are ordered within (key, segment); what a segment needs from the earlier ones comes from a
summary with one row per segment, or from copies of the few rows just before it.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .lists import in_order


def _names(x):
    return [x] if isinstance(x, str) else list(x)


def _keyed(df, key):
    """``df`` with its keys as the struct ``_key``, which is never NULL: rows with NULL as a key are a group, and join."""
    return df.withColumn("_key", F.struct(*_names(key)))


def with_previous(df, key, order, cols, segment, prefix="previous_", first=(), per_key=None):
    """Add ``previous_<col>`` from the row before, per key; NULL for the first row.

    ``order`` must tell the rows of a key apart. The flag ``has_previous`` is False for
    the first row of a key. ``first`` names columns whose first value of the key is added
    as ``first_<col>``. ``per_key`` is a table with one row per key whose other columns
    are added. Both go through the summary of the segments, so the rows themselves are
    shuffled once, by key and segment.
    """
    names, cols, first = _names(key), _names(cols), list(first)
    values = F.struct(*cols)
    rows, keys = _keyed(df, key).withColumn("_segment", segment), ["_key"]
    ends = [F.max_by(values, order).alias("_last")]
    time_line = Window.partitionBy(*keys).orderBy("_segment")
    carried = [F.lag("_last").over(time_line).alias("_carry")]
    if first:
        ends.append(F.min_by(F.struct(*first), order).alias("_start"))
        carried.append(F.first("_start").over(time_line).alias("_first"))
    carry = rows.groupBy(*keys, "_segment").agg(*ends).select(*keys, "_segment", *carried)
    added = []
    if per_key is not None:
        added = [c for c in per_key.columns if c not in names]
        carry = carry.join(_keyed(per_key, key).drop(*names), keys, "left")
    in_segment = Window.partitionBy(*keys, "_segment").orderBy(order)
    before = F.coalesce(F.col("_before"), F.col("_carry"))
    return (
        rows.withColumn("_before", F.lag(values).over(in_segment))
        .join(carry, [*keys, "_segment"], "left")
        .withColumn("_before", before)
        .select(
            *df.columns,
            F.col("_before").isNotNull().alias("has_previous"),
            *[F.col(f"_before.{c}").alias(prefix + c) for c in cols],
            *[F.col(f"_first.{c}").alias("first_" + c) for c in first],
            *added,
        )
    )


def with_first_seen(df, key, order, cols, prefix="first_"):
    """Add the values that the key had first. One aggregate with a map-side combine."""
    cols, rows = _names(cols), _keyed(df, key)
    first = rows.groupBy("_key").agg(F.min_by(F.struct(*cols), order).alias("_first"))
    return rows.join(first, "_key", "left").select(
        *df.columns, *[F.col(f"_first.{c}").alias(prefix + c) for c in cols]
    )


def latest_per_key(df, key, order):
    """The first row per key under ``order`` (a list of sort columns).

    Spark keeps one row per key on the map side before the shuffle (window group limit).
    """
    w = Window.partitionBy(*_names(key)).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def with_position(df, key, order, segment, name="position"):
    """Add the place of the row within its key, from 0. Rows without a segment are counted, as the first ones, and left out."""
    keys = _names(key)
    rows = df.withColumn("_segment", segment)
    sizes = rows.groupBy(*keys, "_segment").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        *keys, "_segment", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    # the offset of a segment is its first row: no join, so rows that lie together by key stay where they are
    both = rows.unionByName(offsets, allowMissingColumns=True)
    in_segment = Window.partitionBy(*keys, "_segment").orderBy(F.col("_offset").isNull(), order)
    return (
        both.withColumns({"_row": F.row_number().over(in_segment), "_start": F.max("_offset").over(in_segment)})
        .filter(F.col("_offset").isNull() & F.col("_segment").isNotNull())
        .withColumn(name, (F.col("_start") + F.col("_row") - 2).cast("bigint"))
        .drop("_segment", "_row", "_offset", "_start")
    )


def rolling_mean(df, key, order, col, n, segment, name="rolling_mean", block=10_000):
    """Mean of this row and the n - 1 rows before it, per key.

    Blocks of rows are handled on their own; each also gets copies of the n - 1 rows
    before it.
    """
    keys = _names(key)
    block = max(block, n)
    placed = with_position(df, key, order, segment, "_at")
    copies = placed.withColumn("_own", F.floor(F.col("_at") / block)).withColumn(
        "_block", F.explode(F.sequence("_own", F.floor((F.col("_at") + n - 1) / block)))
    )
    w = Window.partitionBy(*keys, "_block").orderBy("_at").rowsBetween(-(n - 1), 0)
    return (
        copies.withColumn(name, F.avg(col).over(w))
        .filter(F.col("_block") == F.col("_own"))
        .drop("_at", "_own", "_block")
    )


def rolling_count(df, key, ts, seconds, name="rolling_count", block=10_000):
    """Rows of the key in the last ``seconds`` up to and including this one's time.

    Rows are counted per moment first. The count of a span is the difference of two running counts, at
    its end and just before its start; the running count goes over blocks of ``block`` moments, so no task
    gets more of a key, however many rows fall into one hour. Rows with NULL as a key are a group, and rows of a
    key without a time are counted together, as a window does.
    """
    # structs are never NULL, so that keys and moments which are join too
    moment = F.struct(*_names(key), "_t").alias("_moment")
    keys = ["_key"]
    df = df.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
    counts = df.groupBy(F.struct(*_names(key)).alias("_key"), "_t").agg(F.count("*").alias("_n"))
    ends = counts.select(*keys, "_t", F.col("_t").alias("_at"), F.lit(1).alias("_end"), "_n")
    # the start of a span sorts before the rows of the same moment, which are inside
    starts = counts.select(
        *keys, "_t", (F.col("_t") - seconds * 1_000_000).alias("_at"), F.lit(0).alias("_end"), F.lit(0).alias("_n")
    )
    placed = in_order(ends.unionByName(starts), keys, ["_at", "_end"], "_place")
    placed = placed.withColumn("_block", F.floor(F.col("_place") / block))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*keys, "_block").agg(F.sum("_n").alias("_sum"))
    offsets = offsets.select(*keys, "_block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    so_far = Window.partitionBy(*keys, "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumn("_so_far", F.sum("_n").over(so_far)).join(offsets, [*keys, "_block"])
    total = F.col("_before") + F.col("_so_far")
    spans = running.groupBy(F.struct(*[F.col("_key")[k].alias(k) for k in _names(key)], "_t").alias("_moment")).agg(
        (F.max(F.when(F.col("_end") == 1, total)) - F.max(F.when(F.col("_end") == 0, total))).alias(name)
    )
    return df.withColumn("_moment", moment).join(spans, "_moment").select(*[c for c in df.columns if c != "_t"], name)


def running_mean(df, key, order, col, segment, name="running_mean"):
    """Mean of all rows of the key so far. Sums are kept as decimals, so they are exact."""
    keys = ["_key"]
    rows = _keyed(df, key).withColumn("_segment", segment).withColumn("_x", F.col(col).cast("decimal(20,6)"))
    totals = rows.groupBy(*keys, "_segment").agg(
        F.sum("_x").alias("_sum"), F.count("_x").alias("_count")
    )
    earlier = Window.partitionBy(*keys).orderBy("_segment").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = totals.select(
        *keys,
        "_segment",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum0"),
        F.coalesce(F.sum("_count").over(earlier), F.lit(0)).alias("_count0"),
    )
    so_far = Window.partitionBy(*keys, "_segment").orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    total = F.col("_sum0") + F.coalesce(F.sum("_x").over(so_far), F.lit(0))
    count = F.col("_count0") + F.count("_x").over(so_far)
    return (
        rows.join(offsets, [*keys, "_segment"])
        .withColumn(name, F.try_divide(total.cast("double"), count.cast("double")))
        .drop("_key", "_segment", "_x", "_sum0", "_count0")
    )
