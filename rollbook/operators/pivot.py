"""Facts, one per row, to one wide row per filing."""

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from ..fixed_values import (
    DATED_SUMMARY,
    OFFICER_LABEL,
    PROFILE_DATES,
    PROFILE_LABELS,
    PROFILE_NUMBERS,
    WIDE_ACCOUNTS,
)
from ..functions import to_decimal
from .joins import join_near
from .lists import list_values


def signed_extreme(v):
    """The largest value if the values are positive on the whole, else the smallest.

    The sum has the sign of the mean and needs no division.
    """
    return F.when(F.sum(v) > 0, F.max(v)).otherwise(F.min(v))


def first_for(label, value, order, label_col="label"):
    """Value of the first fact with the label, in ``order``."""
    is_label = F.col(label_col) == label
    return F.min_by(F.when(is_label, value), F.when(is_label, order))


def max_for(label, v, label_col="label"):
    return F.max(F.when(F.col(label_col) == label, v))


def hits_and_keys(facts, keys, hit):
    """The rows that ``hit``, and one row of NULLs for each of the ``keys``, so that an aggregate keeps keys without a hit.

    Aggregates of texts are sorted before the shuffle; here that is only what can count.
    """
    return facts.filter(hit).unionByName(facts.select(*keys).distinct(), allowMissingColumns=True)


def distinct_values(facts, keys, label=OFFICER_LABEL, name="officer"):
    """Distinct values of a label per key, as child rows (keys, position, ``name``) in value order."""
    values = facts.filter(F.col("label") == label).select(*keys, "value").distinct()
    return list_values(values, keys, "value", name=name)


def pivot_facts(facts, keys, spec=tuple(WIDE_ACCOUNTS), order=None, consistent=None):
    """One row per ``keys`` with one column per (column, label, rule) of ``spec``.

    With ``consistent`` (a label and a column), only keys with a fact of that label that repeats the column
    are kept; the aggregate itself finds out, the facts are read once.

    All columns come out of one aggregate with one shuffle. Only facts with a wanted label
    are read, and each map task combines its facts before the shuffle, so that a filing
    with a large share of all facts arrives as one row per task.
    """
    order = order if order is not None else F.col("seq")
    number_labels = [label for _, label, rule in spec if rule in ("signed", "max")]
    number = F.when(F.col("label").isin(number_labels), to_decimal(F.col("value")))
    read = list(dict.fromkeys([label for _, label, _ in spec] + ([consistent[0]] if consistent else [])))
    # every column looks at every fact: at the place of its label, a number, and not at the text
    place = reduce(lambda found, i: found.when(F.col("label") == read[i], i), range(1, len(read)), F.when(F.col("label") == read[0], 0))
    wanted = facts.filter(F.col("label").isin(read)).withColumns({"_number": number, "_place": place})
    aggregates = []
    for column, label, rule in spec:
        at = read.index(label)
        if rule == "signed":
            value = signed_extreme(F.when(F.col("_place") == at, F.col("_number")))
        elif rule == "max":
            value = max_for(at, F.col("_number"), "_place")
        else:
            value = first_for(at, F.col("value"), order, "_place")
            if rule == "date":
                value = F.try_to_date(value, "yyyy-MM-dd")
        aggregates.append(value.alias(column))
    if consistent is None:
        return wanted.groupBy(*keys).agg(*aggregates)
    repeats = (F.col("_place") == read.index(consistent[0])) & (F.col("value") == F.col(consistent[1]))
    flagged = wanted.groupBy(*keys).agg(*aggregates, F.bool_or(repeats).alias("_consistent"))
    return flagged.filter("_consistent").drop("_consistent")


def value_map(facts, document, label="label", key="end_date", order="position"):
    """Entries end date -> value per document and label, a row each; of several values the last counts."""
    return facts.groupBy(document, label, key).agg(F.max_by("value", F.col(order)).alias("value"))


def only_values(facts, accounts, document):
    """(document, label) -> the value at the accounts date, else the value if there is one date only.

    No date at all is a date of its own.
    """
    dated = facts.join(accounts.select(document, "accounts_date"), document)
    at_date = F.col("end_date") == F.col("accounts_date")
    dates = F.count_if(F.col("end_date").isNull())
    return (
        dated.groupBy(document, "label")
        .agg(
            F.max(at_date).alias("_has"),
            F.max_by(F.when(at_date, F.col("value")), F.when(at_date, F.col("position"))).alias(
                "_at"
            ),
            F.max_by("value", "position").alias("_last"),
            F.min("end_date").alias("_from"),
            F.max("end_date").alias("_to"),
            (dates > 0).alias("_undated"),
        )
        .select(
            document,
            "label",
            F.when(F.col("_has"), F.col("_at"))
            .when(
                F.when(F.col("_undated"), F.col("_from").isNull()).otherwise(
                    F.col("_from") == F.col("_to")
                ),
                F.col("_last"),
            )
            .alias("value"),
        )
    )


def financial_profile(facts, accounts, document="document", labels=tuple(PROFILE_LABELS)):
    """One row per filing with the profile columns, by the only-value rule.

    ``facts`` has document, label, value, end_date and position; ``accounts`` has document
    and accounts_date. No map is built: the rule needs a few combinable aggregates. Numbers are
    DECIMAL, dates DATE, texts that are neither NULL. Officers, of which a filing may have any number,
    are child rows: ``distinct_values(facts, [document])``.
    """
    wanted = facts.filter(F.col("label").isin([label for _, label in labels]))
    only = only_values(wanted, accounts, document)
    columns = []
    for column, label in labels:
        value = F.max(F.when(F.col("label") == label, F.col("value")))
        if column == "dormant":
            value = F.lower(value) == "true"
        elif column in PROFILE_NUMBERS:
            value = to_decimal(value)
        elif column in PROFILE_DATES:
            value = F.try_to_date(value, "yyyy-MM-dd")
        columns.append(value.alias(column))
    return only.groupBy(document).agg(*columns)


def nest_facts(facts, keys, position="position", fields=None):
    """(documents, their facts): keys and ``number_of_facts`` of each document, and its facts as child rows
    (keys, position, fields), which take a document of any size."""
    fields = fields or [c for c in facts.columns if c not in [*keys, position]]
    documents = facts.groupBy(*keys).agg(F.count("*").alias("number_of_facts"))
    return documents, facts.select(*keys, position, *fields)


def dated_summary(facts, accounts, document="document", labels=tuple(DATED_SUMMARY)):
    """Per filing the first value of each label at the filing's own date."""
    hits = [F.col("label").rlike(label) if kind == "pattern" else F.col("label") == label for _, label, kind in labels]
    wanted = hits_and_keys(facts.select(document, "end_date", "label", "value", "position"), [document, "end_date"], reduce(or_, hits))
    value = F.struct("value", "position")
    # one row per filing and date, before the filing's own date is looked up
    first = [F.min_by(F.when(hit, value), F.when(hit, F.col("position"))).alias(c) for (c, _, _), hit in zip(labels, hits)]
    dated = wanted.groupBy(document, "end_date").agg(*first)
    own = join_near(dated, accounts.select(document, F.col("accounts_date").alias("end_date")), [document, "end_date"], document)
    return own.groupBy(document).agg(*[F.min_by(F.col(c)["value"], F.col(c)["position"]).alias(c) for c, _, _ in labels])
