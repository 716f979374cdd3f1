"""Arrays and maps that belong to one row."""

from pyspark.sql import functions as F

from ..fixed_values import NO_SIC
from .dates import ch_date


def previous_names(cols):
    """Array of (name, date) from struct columns with CompanyName and CONDATE, blanks dropped."""
    named = F.filter(
        F.array(*cols), lambda p: F.length(F.coalesce(p["CompanyName"], F.lit(""))) > 0
    )
    return F.transform(
        named,
        lambda p: F.struct(p["CompanyName"].alias("name"), ch_date(p["CONDATE"]).alias("date")),
    )


def sic_array(cols):
    """Activity codes from texts such as ``62090 - Other``; empty if none are supplied."""
    codes = F.filter(F.array(*cols), lambda s: F.length(F.coalesce(s, F.lit(""))) > 0)
    trimmed = F.transform(codes, lambda s: F.trim(F.element_at(F.split(s, "-", 2), 1)))
    return F.when(cols[0] == NO_SIC, F.array().cast("array<string>")).otherwise(trimmed)


def map_values_with(m, f):
    return F.transform_values(m, lambda k, v: f(v))


def snake_keys(m):
    """camelCase or dashed map keys to snake_case."""
    return F.transform_keys(
        m,
        lambda k, v: F.lower(
            F.regexp_replace(
                F.regexp_replace(k, r"([a-z0-9])([A-Z])", "$1_$2"), r"[-\s.]+", "_"
            )
        ),
    )


def only_value(m, key):
    """The value at ``key``; else the sole value of the map; else NULL."""
    return F.when(F.map_contains_key(m, key), F.try_element_at(m, key)).when(
        F.size(m) == 1, F.element_at(F.map_values(m), 1)
    )


def chunk(arr, size):
    """Array of consecutive slices with at most ``size`` elements."""
    starts = F.when(
        F.size(arr) > 0, F.sequence(F.lit(1), F.size(arr), F.lit(size))
    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(arr, i, size))


def drop_null_fields(df):
    """One JSON text per row in which fields without a value do not appear."""
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "true"})
