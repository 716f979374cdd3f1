"""Order, limits and top-k. A limit stands only where it is the feature."""

from pyspark.sql import functions as F


def high_water_mark(df, col):
    return df.agg(F.max(col).alias(col))


def work_list(df, key, order, n, pending=None):
    """Distinct keys among the first n rows that are still open (distinct after the limit)."""
    rows = df.filter(F.col(pending).isNull()) if pending else df
    return rows.orderBy(*order).limit(n).select(key).distinct()


def page(df, order, offset, n):
    """One page of the rows in order. A full pass over a table needs no pages."""
    return df.orderBy(*order).offset(offset).limit(n)


def newest_first(df, col, *ties):
    return df.orderBy(F.desc(col), *ties)


def top_labels(df, n, ascending=False, label="label", count="n"):
    first = F.asc(count) if ascending else F.desc(count)
    return df.orderBy(first, F.asc(label)).limit(n)


def shuffled(df, cols, seed=0):
    """Pseudo-random order that only depends on the row and the seed.

    The sort key is a hash of columns, not ``rand``: a lost executor that computes its rows
    again gets the same order.
    """
    return df.orderBy(F.xxhash64(F.lit(seed), *cols), *cols)


def ordered_report(df, cols):
    return df.orderBy(*cols)
