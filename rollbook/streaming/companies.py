"""Company events: what did each event change in the company?"""

from pyspark.sql import functions as F

from ..fixed_values import HOME_COUNTRY
from ..functions import change_map, company_type, instant
from ..operators.windows import with_previous
from .change_log import ChangeLog

# compared in this order; the origin and the date of a company are never updated
COMPARED = [
    ("name", "text"),
    ("number", "text"),
    ("streetaddress", "prefix"),
    ("county", "text"),
    ("country", "text"),
    ("postcode", "text"),
    ("category", "text"),
    ("origin", "text"),
    ("status", "text"),
]
KEPT = ["origin", "date"]
STATE = ["name", "streetaddress", "county", "country", "postcode", "category", "status"]
COMPANY_COLUMNS = [
    "number", "name", "streetaddress", "county", "country", "postcode", "category", "origin",
    "status", "date", "timepoint",
]


def flatten_company(ev):
    """Company event envelopes to one flat row per event; a missing address part is blank."""
    address = "data.registered_office_address"

    def part(name):
        return F.coalesce(F.col(f"{address}.{name}"), F.lit(""))

    foreign = F.col("data.foreign_company_details")
    return ev.select(
        F.col("resource_id").alias("id"),
        F.col("data.company_name").alias("name"),
        F.col("data.company_number").alias("number"),
        part("address_line_1").alias("streetaddress"),
        part("region").alias("county"),
        part("country").alias("country"),
        part("postal_code").alias("postcode"),
        company_type(F.col("data.type")).alias("category"),
        F.when(foreign.isNotNull(), foreign["originating_registry"]["country"])
        .otherwise(F.lit(HOME_COUNTRY))
        .alias("origin"),
        F.col("data.company_status").alias("status"),
        F.try_to_date(F.col("data.date_of_creation"), "yyyy-MM-dd").alias("date"),
        instant(F.col("event.published_at")).alias("published"),
        F.col("event.timepoint").alias("timepoint"),
    )


def timepoint_block(timepoint="timepoint", width=10_000):
    """Time line segment of an event: a block of consecutive timepoints, so it is bounded."""
    return F.expr(f"{timepoint} div {int(width)}")


def diff_companies(ev, state=None, segment=None):
    """(company events, companies after them) for flat events, in timepoint order per company.

    ``state`` has the companies before these events. An event of a company that is new
    says so and has no changes. Otherwise it is compared with the company as the event
    before left it; the origin is compared with the one first seen. A timepoint older than
    the stored one does not change the stored company.
    """
    segment = segment if segment is not None else timepoint_block()
    if state is None:
        state = ev.select(*COMPANY_COLUMNS).limit(0)
    stored = state.select(
        "number",
        F.lit(True).alias("_stored"),
        *[F.col(c).alias(f"_stored_{c}") for c in [*STATE, *KEPT, "timepoint"]],
    )
    rows = with_previous(
        ev, "number", "timepoint", STATE, segment, first=KEPT, per_key=stored
    )
    is_stored = F.coalesce("_stored", F.lit(False))
    known = F.col("has_previous") | is_stored

    def old(name):
        if name == "number":
            return F.col("number")
        if name in KEPT:
            return F.when(is_stored, F.col(f"_stored_{name}")).otherwise(F.col(f"first_{name}"))
        return F.when(F.col("has_previous"), F.col(f"previous_{name}")).otherwise(
            F.col(f"_stored_{name}")
        )

    changes = change_map([(name, F.col(name), old(name), mode) for name, mode in COMPARED])
    events = rows.select(
        "id",
        F.col("number").alias("company_number"),
        F.when(known, changes).alias("fields_changed"),
        "published",
        (~known).alias("new"),
        "timepoint",
    )
    newest = ev.groupBy("number").agg(
        F.max_by(F.struct(*STATE, "timepoint"), "timepoint").alias("_last"),
        F.min_by(F.struct(*KEPT), "timepoint").alias("_first"),
    )
    return events, _apply(state, newest)


def _apply(state, newest):
    old = state.withColumn("_old", F.lit(True)).alias("old")
    both = old.join(newest.alias("new"), "number", "full_outer")
    fresh = F.col("new._last").isNotNull() & (
        F.col("_old").isNull() | (F.col("new._last.timepoint") > F.col("old.timepoint"))
    )
    columns = {"number": F.col("number")}
    for c in [*STATE, "timepoint"]:
        columns[c] = F.when(fresh, F.col(f"new._last.{c}")).otherwise(F.col(f"old.{c}"))
    for c in KEPT:
        columns[c] = F.when(F.col("_old"), F.col(f"old.{c}")).otherwise(F.col(f"new._first.{c}"))
    return both.select(*[columns[c].alias(c) for c in COMPANY_COLUMNS])


COMPANY_SCHEMA = ", ".join(f"{c} {dict(date='date', timepoint='bigint').get(c, 'string')}" for c in COMPANY_COLUMNS)


def company_log(spark, folder, **options):
    """The stored companies of ``store_companies``, as a change log."""
    return ChangeLog(spark, f"{folder}/companies", "number", COMPANY_SCHEMA, **options)


def read_companies(spark, folder):
    """The companies as they were stored last."""
    return company_log(spark, folder).read()


def store_companies(batch, batch_id, folder, segment=None, **options):
    """Store the company events of a batch and the companies that it changes.

    Only the companies of the batch are read and appended to the change log, as version ``batch_id``. A batch that runs
    again reads the same state and replaces its own output. No executor holds state between batches.
    """
    log = company_log(batch.sparkSession, folder, **options)
    # no more rows than the batch has companies
    state = log.read(batch.select("number"), batch_id).persist()
    out, companies = diff_companies(batch, state, segment)
    out.write.mode("overwrite").parquet(f"{folder}/events/batch={batch_id:010d}")
    log.append(companies, batch_id)
    state.unpersist()


def start_company_stream(events, folder, segment=None, **options):
    """A writer that stores the company events and the companies of each batch, see ``store_companies``."""

    def process(batch, batch_id):
        # the batch is read several times, but its source only once
        batch.persist()
        store_companies(batch, batch_id, folder, segment, **options)
        batch.unpersist()

    return events.writeStream.foreachBatch(process)
