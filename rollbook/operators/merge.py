"""Keyed merges. Each returns the new state of the table; writing it is up to the caller.

Parquet has no update in place: a job reads one version and writes the next.
"""

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..functions import to_decimal
from ..sources.versions import Part, current_version, publish, read_parts, write_part


def _names(x):
    return [x] if isinstance(x, str) else list(x)


def _first_by(df, keys, order):
    rest = [c for c in df.columns if c not in keys]
    if len(rest) == 1:
        # a number or flag by itself is aggregated by hashing, a struct by sorting
        return df.groupBy(*keys).agg(F.min_by(rest[0], order).alias(rest[0])).select(*df.columns)
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), order).alias("_row"))
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


def insert_new(target, src, key, order):
    """Rows of ``src`` with keys that ``target`` lacks are added; the first of a key, by ``order``, counts."""
    keys = _names(key)
    new = _first_by(src, keys, order)
    return target.unionByName(new.join(target.select(*keys), keys, "left_anti"))


def upsert(target, src, key, update, keep=(), order=None):
    """Insert new keys, overwrite ``update`` of known keys (also by NULL), leave ``keep``.

    ``order`` picks the row of ``src`` that counts if a key comes more than once.
    """
    keys = _names(key)
    if order is not None:
        src = _first_by(src, keys, order)
    old = target.withColumn("_old", F.lit(True)).alias("old")
    new = src.withColumn("_new", F.lit(True)).alias("new")
    on = reduce(lambda a, b: a & b, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys])
    both = old.join(new, on, "full_outer")
    out = [F.coalesce(f"old.{k}", f"new.{k}").alias(k) for k in keys]
    for c in target.columns:
        if c in keys:
            continue
        if c not in src.columns:
            out.append(F.col(f"old.{c}").alias(c))
        elif c in update:
            out.append(
                F.when(F.col("_new"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            )
        else:
            out.append(
                F.when(F.col("_old"), F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c)
            )
    return both.select(*out).select(*target.columns)


def largest_absolute(df, keys, value, order):
    """One row per key; ``value`` is the number with the largest absolute value.

    The first row of a key (by ``order``) gives all other columns. If its value is text it
    stays; a later text never replaces a number; of equally large numbers the first counts.
    """
    keys = _names(keys)
    rest = [c for c in df.columns if c not in [*keys, value]]
    # the number is read once per row, below the aggregate
    sized = df.withColumns({"_order": F.col(order) if isinstance(order, str) else order, "_size": F.abs(to_decimal(F.col(value)))})
    is_number = F.col("_size").isNotNull()
    kept = sized.groupBy(*keys).agg(
        F.min_by(F.struct(value, *rest, is_number.alias("_is_number")), "_order").alias("_first"),
        F.min_by(F.when(is_number, F.col(value)), F.when(is_number, F.struct(-F.col("_size"), "_order"))).alias("_largest"),
    )
    first = F.col("_first")
    result = F.when(first["_is_number"], F.col("_largest")).otherwise(first[value])
    return kept.select(*keys, result.alias(value), *[first[c].alias(c) for c in rest]).select(*df.columns)


def upsert_largest(target, src, key, value, order):
    """Merge by ``largest_absolute``; rows of the target come before those of ``src``."""
    both = target.withColumn("_age", F.lit(0)).unionByName(src.withColumn("_age", F.lit(1)))
    merged = largest_absolute(both, key, value, F.struct("_age", order))
    return merged.select(*target.columns)


def append_values(target, src, key, value, order):
    """Child rows (key, ``order``, ``value``, ``age``) of a key: its old values, then the new ones in ``order``.

    ``age`` is 0 for what ``target`` had and 1 for what is added; nothing stored is rewritten.
    """
    keys = _names(key)
    old = target.select(*keys, order, value, F.lit(0).alias("age"))
    return old.unionByName(src.select(*keys, order, value, F.lit(1).alias("age")))


def drop_exact(df, cols, order):
    """One row per combination of the columns, the first one by ``order``."""
    if set(df.columns) <= set(cols):
        return df.distinct()
    return _first_by(df, list(cols), order)


def replace_documents(target, src, key, order):
    """Documents of ``src`` (the first of a key, by ``order``) replace those of ``target`` as a whole."""
    keys = _names(key)
    new = _first_by(src, keys, order)
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new)


def add_parents(child, parent, key, child_key=None):
    """Stub parents (all other columns NULL) for the keys that only children have."""
    keys = child.select(F.col(child_key or key).alias(key)).distinct()
    missing = keys.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")
    return parent.unionByName(missing, allowMissingColumns=True)


def unique(df, col):
    return df.select(col).distinct()


def merge_maps(old, new, key="key", value="value"):
    """Key/value rows; a new value replaces the old one."""
    both = old.select(key, value, F.lit(0).alias("_age")).unionByName(
        new.select(key, value, F.lit(1).alias("_age"))
    )
    return both.groupBy(key).agg(F.max_by(value, F.struct("_age", value)).alias(value))


def stored(df, path):
    """Write a table to a new folder and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh(df, folder):
    """Replace a stored result and read it back.

    The new result is written next to the old one, and then a new version names it: a reader finds the old or the new result
    as a whole, also when the job fails in between.
    """
    spark = df.sparkSession
    version, _ = current_version(spark, folder)
    name = f"result/{uuid.uuid4().hex}"
    part = Part("result", name, write_part(df, folder, name))
    publish(spark, folder, 0 if version is None else version + 1, [part])
    return read_refreshed(spark, folder, df.schema)


def read_refreshed(spark, folder, schema):
    """The result that ``refresh`` has stored last."""
    _, parts = current_version(spark, folder)
    return read_parts(spark, folder, parts, schema).drop("age")
