"""Code texts and change detection for companies and officers."""

from itertools import chain

from pyspark.sql import functions as F

from ..fixed_values import APPOINTMENT_TYPES, COMPANY_TYPES


def _code_map(codes):
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(codes.items())])


def company_type(c):
    """Text of a company type code, NULL for an unknown code."""
    return F.try_element_at(_code_map(COMPANY_TYPES), c)


def appointment_type(c):
    """Text of an appointment type code, blank for an unknown code."""
    return F.coalesce(F.try_element_at(_code_map(APPOINTMENT_TYPES), c.try_cast("int")), F.lit(""))


def optional_struct(cond, **fields):
    """A struct that is NULL as a whole unless ``cond`` holds."""
    return F.when(cond, F.struct(*[c.alias(name) for name, c in fields.items()]))


def changed(new, old, mode="text"):
    """Did a field change? Letter case never counts.

    ``prefix``: a new value that only extends the old one is no change.
    """
    if mode == "prefix":
        return ~F.startswith(
            F.upper(F.coalesce(new, F.lit(""))), F.upper(F.coalesce(old, F.lit("")))
        )
    return ~F.upper(new).eqNullSafe(F.upper(old))


def change_map(pairs):
    """``{field: {new, old}}`` of the changed fields; pairs are (name, new, old, mode)."""
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("key"),
                F.struct(new.alias("new"), old.alias("old")).alias("value"),
                changed(new, old, mode).alias("is_changed"),
            )
            for name, new, old, mode in pairs
        ]
    )
    kept = F.filter(entries, lambda e: e["is_changed"])
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"], e["value"])))
