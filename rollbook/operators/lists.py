"""The values of a group as ordered rows: (keys, position, value), whatever the group's size.

An array or a joined text would have to fit into one row of one task. Here a group of any size has
one shape, a row per value with its place in the group, from 0.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .merge import stored

_ROW = (1 << 33) - 1


def in_order(df, keys, order, name="position"):
    """Add the place of each row within its keys, by the columns ``order``; rows with NULL as a key are a group too.

    The rows are sorted by keys and order over all tasks, so a large group lies in several of them;
    places come from the number of rows per task and the first place of each key.
    """
    columns = [*keys, *order]
    ranged = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    ranged = ranged.withColumn("_at", F.monotonically_increasing_id())
    rows = stored(ranged, shared_folder(df.sparkSession, "ordered"))
    part = F.shiftright("_at", 33)
    # a struct is never NULL, so that keys which are join too
    rows = rows.withColumns({"_run": F.struct(part.alias("part"), *keys), "_at": F.col("_at").bitwiseAND(_ROW)})
    # a row per key and task that holds some of it, with the rows of the key in the tasks before
    firsts = rows.groupBy("_run").agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(*[F.col(f"_run.{k}") for k in keys]).orderBy("_run.part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = firsts.select("_run", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_from")).alias("_offset"))
    placed = rows.join(offsets, "_run").withColumn(name, (F.col("_at") + F.col("_offset")).cast("bigint"))
    return placed.select(*df.columns, name)


def list_values(df, keys, value, order=(), name="value"):
    """Child rows (keys, ``position``, ``name``) of the values that are not NULL, in value order or in ``order``."""
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias(name), *order)
    return in_order(rows, keys, [*order, name] if order else [name]).select(*keys, "position", name)
