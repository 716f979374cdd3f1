"""Filters, required fields, routing and point lookups."""

from functools import reduce

from pyspark.sql import functions as F

from ..fixed_values import EMPTY_FACT_TOKENS


def rename_case(df, style="camel"):
    """Rename all columns between ``snake_case`` and ``camelCase``."""

    def camel(name):
        head, *rest = name.split("_")
        return head + "".join(w[:1].upper() + w[1:] for w in rest)

    def snake(name):
        return "".join("_" + ch.lower() if ch.isupper() else ch for ch in name).lstrip("_")

    change = camel if style == "camel" else snake
    return df.withColumnsRenamed({c: change(c) for c in df.columns})


def lookup(df, key, values):
    """Rows for the wanted keys with ``matches``: 1 found, 0 not found, more is an error.

    ``values`` is one key, a short list of keys, or a DataFrame that has the key column.
    """
    if hasattr(values, "columns"):
        wanted = values.select(key).distinct()
    else:
        keys = values if isinstance(values, (list, tuple)) else [values]
        wanted = df.sparkSession.createDataFrame([(k,) for k in keys], f"{key} string")
    rows = df.join(wanted, key, "left_semi")
    found = rows.groupBy(key).agg(F.count("*").alias("matches"))
    return (
        wanted.join(found, key, "left")
        .join(rows, key, "left")
        .withColumn("matches", F.coalesce("matches", F.lit(0)))
    )


def lookup_misses(keys, df, key):
    """Wanted keys that the table does not have."""
    return keys.select(key).distinct().join(df, key, "left_anti")


def time_range(df, ts, start=None, end=None):
    """``start < ts < end``; either bound may be left out."""
    out = df
    if start is not None:
        out = out.filter(F.col(ts) > start)
    if end is not None:
        out = out.filter(F.col(ts) < end)
    return out


def above(df, col, n, limit=None, order=None):
    rows = df.filter(F.col(col) > n)
    if limit is None:
        return rows
    return rows.orderBy(*(order or [F.desc(col)])).limit(limit)


def unresolved(df, col):
    return df.filter(F.col(col).isNull())


def in_values(df, col, values):
    return df.filter(F.col(col).isin(list(values)))


def self_consistent(facts, label, key, keys):
    """Distinct ``keys`` of the facts in which the fact ``label`` repeats the column ``key``."""
    return (
        facts.filter((F.col("label") == label) & (F.col("value") == F.col(key)))
        .select(*keys)
        .distinct()
    )


def require(df, cols, tokens=()):
    """Rows in which none of the columns is missing, blank or one of the ``tokens``."""
    conditions = [F.length(c) > 0 for c in cols]
    if tokens:
        conditions += [~F.col(c).isin(list(tokens)) for c in cols]
    return df.filter(reduce(lambda a, b: a & b, conditions))


def null_sentinels(df, cols, tokens=tuple(EMPTY_FACT_TOKENS), decimals=None):
    """Sentinel texts to NULL; in the column ``decimals`` the text INF becomes 0."""
    out = df.withColumns({c: F.when(~F.col(c).isin(list(tokens)), F.col(c)) for c in cols})
    if decimals:
        value = F.col(decimals)
        out = out.withColumn(decimals, F.when(value == "INF", F.lit("0")).otherwise(value))
    return out


def is_long(cols, n):
    """Whether the texts together have ``n`` characters or more."""
    return reduce(lambda a, b: a + b, [F.length(F.coalesce(F.col(c), F.lit(""))) for c in cols]) >= n


def route_by_length(df, cols, n):
    """(short, long): rows whose texts together have fewer than ``n`` characters, the others."""
    return df.filter(~is_long(cols, n)), df.filter(is_long(cols, n))


def match_name(df, col, pattern):
    """(rows whose name has the pattern, the others)."""
    ok = F.coalesce(F.col(col).rlike(pattern), F.lit(False))
    return df.filter(ok), df.filter(~ok)


def complete_groups(rows, declared, key, n):
    """(complete, incomplete) declarations: ``n`` is the declared number of rows per key."""
    counted = rows.groupBy(key).agg(F.count("*").alias("found"))
    checked = declared.join(counted, key, "left").withColumn(
        "found", F.coalesce("found", F.lit(0))
    )
    ok = F.col("found") == F.col(n)
    return checked.filter(ok), checked.filter(~F.coalesce(ok, F.lit(False)))


def recent(df, date_col, as_of, interval="1 DAY"):
    """Rows dated later than ``as_of`` minus the interval."""
    floor = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {interval}")
    return df.filter(F.col(date_col).cast("timestamp") > floor)
