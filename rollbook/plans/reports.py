"""Wide accounts and the reports on them; event frequency reports."""

from pyspark.sql import functions as F

from ..fixed_values import (
    ACCOUNTANTS_LABEL,
    EMPLOYEES_LABEL,
    REGISTERED_NUMBER_LABEL,
    WIDE_ACCOUNTS,
)
from ..functions import day_name, dow0, hour24
from ..operators import (
    client_counts,
    distinct_values,
    frequency,
    groups_over,
    in_region,
    join_facts,
    list_values,
    pivot_facts,
    scalar_lookup,
    self_consistent,
    time_range,
)

KEYS = ["company_number", "end_date"]


def wide_accounts(facts, companies, short_list=True):
    """One wide row per company and date, with the postcode.

    With ``short_list`` only filings count that name their own company number.
    """
    own = (REGISTERED_NUMBER_LABEL, "company_number") if short_list else None
    wide = pivot_facts(facts, KEYS, consistent=own)
    return scalar_lookup(
        wide,
        companies.select("number", F.col("postcode").alias("post_code")),
        "company_number",
        "post_code",
        "number",
    )


def account_officers(facts, short_list=True):
    """Officers of the filings in the wide accounts, as child rows (keys, position, officer)."""
    if short_list:
        keys = self_consistent(facts, REGISTERED_NUMBER_LABEL, "company_number", KEYS)
        facts = facts.join(keys, KEYS, "left_semi")
    return distinct_values(facts, KEYS)


def regional_accounts(facts, companies, postcodes, counties):
    """Adviser, software and employees of the filings in some counties."""
    keys = self_consistent(facts, REGISTERED_NUMBER_LABEL, "company_number", KEYS)
    local = in_region(keys, companies, postcodes, counties)
    columns = {"accountants": "text", "accounting_software": "text"}
    spec = [row for row in WIDE_ACCOUNTS if row[0] in columns]
    spec.append(("employees", EMPLOYEES_LABEL, "max"))
    return pivot_facts(join_facts(local, facts), KEYS, spec)


def adviser_report(regional, facts, over=5):
    """(report, software) of the advisers with more than ``over`` regional filings: name and number of clients,
    and the software that they used as child rows (name, position, software)."""
    named = regional.filter(F.col("accountants").isNotNull())
    busy = groups_over(named, "accountants", over).select(F.col("accountants").alias("name"))
    used = named.select(F.col("accountants").alias("name"), F.col("accounting_software").alias("software"))
    software = list_values(used.join(busy, "name", "left_semi"), ["name"], "software", name="software")
    return client_counts(busy, facts, ACCOUNTANTS_LABEL), software


def _frequencies(filings, companies, unit, ts):
    return frequency(filings, ts, unit, "filing_events").join(
        frequency(companies, ts, unit, "company_events"), "bucket", "full_outer"
    )


def daily_frequency(filings, companies, since, ts="published"):
    """Events per day, with the day of the week."""
    days = _frequencies(time_range(filings, ts, since), time_range(companies, ts, since), "day", ts)
    return days.select(
        F.col("bucket").cast("date").alias("date"),
        dow0(F.col("bucket")).alias("day_of_week"),
        "filing_events",
        "company_events",
    )


def hourly_frequency(filings, companies, until, ts="published"):
    """Events per hour up to ``until``, with the names of day and hour."""
    hours = _frequencies(
        time_range(filings, ts, None, until), time_range(companies, ts, None, until), "hour", ts
    )
    return hours.select(
        "bucket",
        day_name(F.col("bucket")).alias("day_of_week"),
        hour24(F.col("bucket")).alias("hour"),
        "filing_events",
        "company_events",
    )
