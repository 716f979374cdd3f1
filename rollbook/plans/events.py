"""Landed event files to stored events, as a stream that stops when it is up to date.

The lines are read once. Each batch stores what is no event next to the events, drops repeats by the stored ids, and hands the
new events on; a batch that runs again replaces all that it has written.
"""

from ..schemas import TOPICS
from ..streaming import (
    describe_flat,
    flatten_company,
    flatten_filing,
    new_events,
    parse_or_quarantine,
    read_companies,
    read_lines,
    repair_frames,
    run_until_current,
    store_companies,
    with_event_key,
)


def _store_events(spark, topic, landing, folder, store, max_files):
    """Run ``store(new events, batch id)`` over the landed files; returns the lines that are not events."""

    def process(batch, batch_id):
        batch.persist()
        events, bad = parse_or_quarantine(batch, TOPICS[topic])
        bad.write.mode("overwrite").parquet(f"{folder}/unreadable/batch={batch_id:010d}")
        keyed = with_event_key(events, topic).persist()
        fresh, finish = new_events(keyed, batch_id, f"{folder}/seen")
        fresh.persist()
        store(fresh, batch_id)
        finish(fresh)
        fresh.unpersist()
        keyed.unpersist()
        batch.unpersist()

    lines = repair_frames(read_lines(spark, landing, max_files))
    run_until_current(lines.writeStream.foreachBatch(process), f"{folder}/checkpoint")
    return spark.read.schema("value string, batch int").parquet(f"{folder}/unreadable").select("value")


def load_company_events(spark, landing, folder, max_files=None, segment=None, **options):
    """(company events, companies, unreadable lines) stored below ``folder`` after all landed files; ``options`` are those
    of the change log that holds the companies."""

    def store(events, batch_id):
        store_companies(flatten_company(events), batch_id, folder, segment, **options)

    bad = _store_events(spark, "companies", landing, folder, store, max_files)
    return spark.read.parquet(f"{folder}/events").drop("batch"), read_companies(spark, folder), bad


def load_filing_events(spark, landing, folder, templates, companies=None, max_files=None):
    """(described filing events, unreadable lines) stored below ``folder`` after all landed files."""

    def store(events, batch_id):
        described = describe_flat(flatten_filing(events), templates, companies)
        described.write.mode("overwrite").parquet(f"{folder}/events/batch={batch_id:010d}")

    bad = _store_events(spark, "filings", landing, folder, store, max_files)
    return spark.read.parquet(f"{folder}/events").drop("batch"), bad
