"""Envelope streams: framing, parsing, duplicates, meters. All work on batches as well."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import STREAM_IDS
from ..functions import instant
from ..schemas import TOPICS


def read_lines(spark, folder, max_files=None):
    """Text lines of a landing folder as a stream."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def repair_frames(df):
    """One JSON object per row: objects that share a line are cut apart, heartbeats dropped."""
    framed = F.regexp_replace("value", r"\}\}\s*\{", "}}\n{")
    return df.select(F.explode(F.split(framed, "\n")).alias("value")).filter(
        F.length(F.trim("value")) > 1
    )


def parse_or_quarantine(df, schema):
    """(events, unreadable lines): a line that is not JSON never stops the run."""
    corrupt = "_corrupt_record"
    with_corrupt = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType(), True)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    # filters do not move below a generator, so each line is parsed once and not per filter
    parsed = df.select(
        "value", F.explode(F.array(F.from_json("value", with_corrupt, options))).alias("e")
    )
    bad = F.col("e").isNull() | F.col(f"e.{corrupt}").isNotNull()
    events = parsed.filter(~bad).select(*[F.col(f"e.{n}").alias(n) for n in schema.names])
    return events, parsed.filter(bad).select("value")


def with_event_key(events, topic):
    """Add the identifier of the topic's events and the time they were published."""
    return events.withColumns(
        {
            "event_key": F.col(STREAM_IDS[topic]),
            "published": instant(F.col("event.published_at")),
        }
    )


def read_events(spark, topic, folder, max_files=None):
    """(readable events, unreadable lines) of one topic as streams."""
    lines = repair_frames(read_lines(spark, folder, max_files))
    events, bad = parse_or_quarantine(lines, TOPICS[topic])
    return with_event_key(events, topic), bad


def dedupe_events(df, id="event_key", ts="published", delay=None):
    """One event per id, however late a repeat comes.

    A stream keeps the ids it has seen in its state store. With ``delay`` it forgets an id
    that long after its event was published: the state is then bounded by the rate of the
    topic, but events later than that are dropped. ``save_new_events`` needs no state store at all. Events without
    an id are no repeats of one another, they all stay.
    """
    alone = df.withColumn("_alone", F.when(F.col(id).isNull(), F.expr("uuid()")))
    if df.isStreaming and delay:
        alone = alone.withWatermark(ts, delay).dropDuplicatesWithinWatermark([id, "_alone"])
    else:
        alone = alone.dropDuplicates([id, "_alone"])
    return alone.drop("_alone")


def resume_after(df, hwm, col="timepoint"):
    """Events after the last timepoint that was stored (None: all)."""
    return df if hwm is None else df.filter(F.col(col) > hwm)


def event_rate(df, ts="published", width="5 minutes"):
    """Events and events per second in each window of time, for a batch; of a stream see ``store_rates``."""
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    return (
        df.groupBy(F.window(ts, width).alias("window"))
        .agg(F.count("*").alias("events"))
        .select(
            F.col("window.start").alias("window_start"),
            "events",
            (F.col("events") / seconds).alias("events_per_second"),
        )
    )


def store_rates(events, folder, ts="published", width="5 minutes"):
    """A writer that stores how many events of each batch fall into each window of time.

    A batch adds a row for each window that it touches, and nothing is rewritten, so late events count too and no state
    is kept. ``read_rates`` adds the rows up.
    """

    def save(batch, batch_id):
        counted = batch.groupBy(F.window(ts, width).alias("window")).agg(F.count("*").alias("events"))
        rows = counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "events")
        rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id:010d}")

    return events.writeStream.foreachBatch(save)


def read_rates(spark, folder):
    """Events and events per second in each window, out of all batches of ``store_rates``."""
    stored = spark.read.schema("window_start timestamp, window_end timestamp, events bigint").parquet(folder)
    seconds = F.unix_timestamp("window_end") - F.unix_timestamp("window_start")
    summed = stored.groupBy("window_start", "window_end").agg(F.sum("events").alias("events"))
    return summed.select("window_start", "events", (F.col("events") / seconds).alias("events_per_second"))


def backlog_age(df, published="published", ingested="ingested_at"):
    """Add ``backlog_seconds``: how late an event was taken in."""
    late = F.unix_micros(F.col(ingested)) - F.unix_micros(F.col(published))
    return df.withColumn("backlog_seconds", late / F.lit(1_000_000))


def unknown_codes(df, templates, code="description_code"):
    """Codes without a template and how often they came; missing ones and legacy are known."""
    named = df.filter((F.length(code) > 0) & (F.col(code) != "legacy"))
    counted = named.groupBy(code).agg(F.count("*").alias("n"))
    return counted.join(templates.select(F.col("key").alias(code)), code, "left_anti")


def mark_deleted(df, kind="event.type"):
    """Add ``deleted``: the event says that its resource is gone."""
    return df.withColumn("deleted", F.coalesce(F.col(kind) == "deleted", F.lit(False)))
