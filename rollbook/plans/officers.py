"""Officer snapshot to the officers table, with the lines that could not be read."""

from pyspark.sql import functions as F

from ..fixed_values import (
    OFFICER_COLUMNS,
    OFFICER_HEADER_PREFIX,
    OFFICER_TAIL_PREFIX,
    OFFICER_VARIABLE_FIELDS,
)
from ..functions import (
    appointment_type,
    birth_date,
    count_char,
    null_if_empty,
    repair_century,
    yes_flag,
)
from ..operators import record_totals
from ..sources import parse_fixed_width, reconcile_counts, split_quarantine


def person_rules():
    """What a readable record looks like; company records (type 1) only need their type."""
    is_company = F.col("record_type") == "1"
    return {
        "unknown record type": F.col("record_type").isin("1", "2"),
        "unreadable appointment": is_company
        | (
            F.col("appointment_type").rlike(r"^\d{2}$")
            & F.col("person_number").rlike(r"^\S{12}$")
            & (F.length("appointment_date_origin") == 1)
        ),
        "unreadable dates": is_company
        | (
            F.col("appointment_date").rlike("^[0-9 ]{8}$")
            & F.col("resignation_date").rlike("^[0-9 ]{8}$")
            & F.col("partial_birth_date").rlike("^[0-9 ]{8}$")
            & F.col("full_birth_date").rlike("^[0-9 ]{8}$")
            & F.col("post_code").rlike("^[0-9 A-Z]{8}$")
            & F.col("variable_length").rlike("^[0-9]{4}$")
        ),
        "wrong number of fields": is_company
        | (count_char(F.col("variable_data"), "<") == len(OFFICER_VARIABLE_FIELDS)),
    }


def officer_rows(persons):
    """Columns of the officers table from readable person records."""
    born, is_exact = birth_date(F.col("full_birth_date"), F.col("partial_birth_date"))
    parts = F.split("variable_data", "<", -1)
    blank = F.col("post_code").startswith(" ")
    columns = {
        "company_number": F.col("company_number"),
        "appointment_type": appointment_type(F.col("appointment_type")),
        "person_number": F.col("person_number"),
        "is_corporate_body": yes_flag(F.col("corporate_indicator")),
        "appointment_date": repair_century(F.col("appointment_date")),
        "resignation_date": repair_century(F.col("resignation_date")),
        "post_code": F.when(blank, F.lit("")).otherwise(F.rtrim("post_code")),
        "birth_date": born,
        "birth_date_is_accurate": is_exact,
        **{name: F.get(parts, F.lit(i)) for i, name in enumerate(OFFICER_VARIABLE_FIELDS)},
    }
    flags = ("is_corporate_body", "birth_date_is_accurate")
    return persons.select(
        *[
            (columns[c] if c in flags else null_if_empty(columns[c])).alias(c)
            for c in OFFICER_COLUMNS
        ]
    )


def load_officers(lines):
    """(officers, quarantined lines, totals per record type, count check per file).

    ``lines`` has the columns ``value`` and ``file``.
    """
    records = parse_fixed_width(
        lines.filter(
            ~F.col("value").startswith(OFFICER_HEADER_PREFIX)
            & ~F.col("value").startswith(OFFICER_TAIL_PREFIX)
            & (F.length("value") > 0)
        )
    )
    good, bad = split_quarantine(records, person_rules())
    persons = good.filter(F.col("record_type") == "2")
    kind = (
        F.when(F.col("record_type") == "1", "company")
        .when(F.col("record_type") == "2", "person")
        .otherwise("unknown")
    )
    totals = record_totals(records.withColumn("kind", kind), "file", "kind")
    return officer_rows(persons), bad.select("file", "line", "error"), totals, reconcile_counts(lines)
