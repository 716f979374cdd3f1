"""Counts, frequencies and profiles."""

from pyspark.sql import functions as F

from ..functions import bucket, dow0, hour_of


def key_list(df, keys):
    return df.select(*keys).distinct()


def count_summary(df, key):
    """One row: all rows with a key, and distinct keys."""
    return df.agg(
        F.count(key).alias("total"), F.count_distinct(key).alias("unique_keys")
    )


def groups_over(df, key, n):
    """Keys with more than n rows."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > n)


def frequency(df, ts, unit, name="n"):
    """Rows per time bucket (a row without a time falls into the NULL bucket)."""
    return df.groupBy(bucket(F.col(ts), unit).alias("bucket")).agg(F.count("*").alias(name))


def non_null_frequency(df, ts, unit, name="n"):
    """Like ``frequency`` but a row without a time counts nothing."""
    return df.groupBy(bucket(F.col(ts), unit).alias("bucket")).agg(F.count(ts).alias(name))


def time_profile(a, b, ts, names=("filing", "company")):
    """Per day of the week and hour: rounded mean, maximum, 95th and 5th percentile.

    Both series are first counted per hour. The exact percentiles then work on one row per
    hour of history, whatever the number of events.
    """
    left, right = names
    hours = frequency(a, ts, "hour", left).join(
        frequency(b, ts, "hour", right), "bucket", "full_outer"
    )
    measures = []
    for name in names:
        measures += [
            F.round(F.avg(name)).alias(f"avg_{name}_events"),
            F.max(name).alias(f"max_{name}_events"),
            F.round(F.percentile(name, F.lit(0.95))).alias(f"{name}_95th"),
            F.round(F.percentile(name, F.lit(0.05))).alias(f"{name}_5th"),
        ]
    return hours.groupBy(
        dow0(F.col("bucket")).alias("day_of_week"), hour_of(F.col("bucket")).alias("hour")
    ).agg(*measures)


def latest_buckets(a, b, ts, unit, names=("filing", "company"), k=None):
    """Both series side by side for their newest k buckets.

    A NULL bucket sorts first in each series, so it uses up one of the k places before it is
    dropped. k is 1000 for minutes, 48 for longer units.
    """
    k = k or (1000 if unit == "minute" else 48)
    left, right = [
        non_null_frequency(df, ts, unit, name).orderBy(F.desc_nulls_first("bucket")).limit(k)
        for df, name in zip((a, b), names)
    ]
    return left.join(right, "bucket", "full_outer").filter(F.col("bucket").isNotNull())


def label_document_frequency(facts, document, label="label", start="start_date"):
    """Documents per label, period and instant facts apart; a label counts once a document."""
    kind = F.when(F.col(start).isNotNull(), F.lit("period")).otherwise(F.lit("instant"))
    return (
        facts.select(document, label, kind.alias("kind"))
        .distinct()
        .groupBy("kind", label)
        .agg(F.count("*").alias("documents"))
    )


def counter(df, label, amount, starting_value=0):
    """Net total per label; decreases are negative amounts."""
    return df.groupBy(label).agg((F.sum(amount) + starting_value).alias("n"))


def load_audit(df, file, is_long, error=None):
    """Per file: facts loaded, long facts loaded, and the first error if there is one."""
    flag = F.coalesce(is_long, F.lit(False))
    bad = error if error is not None else F.lit(None).cast("string")
    return df.groupBy(file).agg(
        F.count(F.when(~flag & bad.isNull(), 1)).alias("number_of_facts"),
        F.count(F.when(flag & bad.isNull(), 1)).alias("number_of_long_facts"),
        F.min(bad).alias("errors"),
    )


def record_totals(df, file, kind):
    return df.groupBy(file, kind).agg(F.count("*").alias("n"))
