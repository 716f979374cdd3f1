"""Officer snapshot: fixed-width head, delimited tail, trailer record with a count."""

from pyspark.sql import functions as F

from ..fixed_values import (
    OFFICER_HEADER_PREFIX,
    OFFICER_LAYOUT,
    OFFICER_TAIL_PREFIX,
)


def parse_fixed_width(lines, layout=OFFICER_LAYOUT):
    """Cut the column ``value`` into the fields of ``layout`` (name, start from 1, length)."""
    cut = [
        (
            F.substring("value", start, length)
            if length
            else F.expr(f"substring(value, {int(start)})")
        ).alias(name)
        for name, start, length in layout
    ]
    rest = [c for c in lines.columns if c != "value"]
    return lines.select(*rest, F.col("value").alias("line"), *cut)


def read_fixed_width(spark, path, layout=OFFICER_LAYOUT):
    """Record lines of fixed-width files, header and trailer lines left out."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    records = lines.filter(
        ~F.col("value").startswith(OFFICER_HEADER_PREFIX)
        & ~F.col("value").startswith(OFFICER_TAIL_PREFIX)
        & (F.length("value") > 0)
    )
    return parse_fixed_width(records, layout)


def reconcile_counts(
    lines, tail_prefix=OFFICER_TAIL_PREFIX, header_prefix=OFFICER_HEADER_PREFIX, file="file"
):
    """Per file: records read, records the trailer promises, and whether they agree.

    ``lines`` has the columns ``value`` and ``file``. A file without a trailer has a NULL
    promise and does not agree.
    """
    is_tail = F.col("value").startswith(tail_prefix)
    is_header = F.col("value").startswith(header_prefix)
    is_record = ~is_tail & ~is_header & (F.length("value") > 0)
    promise = F.substring("value", len(tail_prefix) + 1, 8).try_cast("bigint")
    return (
        lines.groupBy(file)
        .agg(
            F.count(F.when(is_record, 1)).alias("records"),
            F.max(F.when(is_tail, promise)).alias("expected"),
        )
        .withColumn("agrees", F.coalesce(F.col("records") == F.col("expected"), F.lit(False)))
    )


def split_quarantine(df, rules):
    """(good rows, bad rows with ``error``): the first broken rule names the error.

    ``rules`` maps an error text to the condition that a good row meets.
    """
    errors = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(text)) for text, ok in rules.items()]
    marked = df.withColumn("error", F.coalesce(*errors))
    return marked.filter(F.col("error").isNull()).drop("error"), marked.filter(
        F.col("error").isNotNull()
    )
