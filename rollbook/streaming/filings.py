"""Filing events: which filing, of which company, described in words."""

from pyspark.sql import functions as F

from ..functions import instant, uri_company
from ..operators.joins import describe, enrich_stream


def flatten_filing(ev):
    """Filing event envelopes to flat rows; an event with another kind of URI is dropped."""
    return ev.select(
        F.col("resource_id").alias("id"),
        F.col("data.category").alias("category"),
        F.col("data.description").alias("description_code"),
        F.col("data.description_values").alias("description_values"),
        F.col("data.date").alias("filing_date"),
        F.col("event.timepoint").alias("timepoint"),
        instant(F.col("event.published_at")).alias("published"),
        F.col("data.barcode").alias("barcode"),
        F.col("data.type").alias("type"),
        uri_company(F.col("resource_uri")).alias("company_number"),
    ).filter(F.col("company_number").isNotNull())


def describe_filings(ev, templates, companies=None):
    """Filing event envelopes with their description; an unknown code drops the event."""
    return describe_flat(flatten_filing(ev), templates, companies)


def describe_flat(filings, templates, companies=None):
    """The same for flat filing events, with the company profile next to each if given."""
    described = describe(filings, templates, "inner")
    return described if companies is None else enrich_stream(described, companies)
