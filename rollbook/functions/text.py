"""Text clean-up, templates and patterns."""

from pyspark.sql import functions as F

from ..fixed_values import (
    BULK_FILE_PATTERN,
    DIMENSION_LABEL_PATTERN,
    FILING_URI_PATTERN,
    PLACEHOLDER_PATTERN,
)


def null_if_empty(c):
    return F.nullif(c, F.lit(""))


def pad_number(c):
    """Company number as eight characters; longer numbers are left alone."""
    text = c.cast("string")
    return F.when(F.length(text) < 8, F.lpad(text, 8, "0")).otherwise(text)


def fill_template(template, values):
    """Replace every ``{name}`` by ``values[name]``, or by nothing if the name is missing.

    One pass over the template: inserted text is never expanded again. Only lower-case
    names with underscores count, any other brace text stays.
    """
    pieces = F.split(template, PLACEHOLDER_PATTERN, -1)
    names = F.regexp_extract_all(template, F.lit(PLACEHOLDER_PATTERN), F.lit(1))
    filled = F.transform(names, lambda n: F.coalesce(F.try_element_at(values, n), F.lit("")))
    joined = F.zip_with(pieces, filled, lambda p, v: F.concat(p, F.coalesce(v, F.lit(""))))
    return F.array_join(joined, "")


def camel_case(c):
    """``some-code_name`` to ``someCodeName``."""
    words = F.filter(F.split(F.lower(c), "[-_ .]+"), lambda w: w != "")
    cased = F.transform(words, lambda w, i: F.when(i == 0, w).otherwise(F.initcap(w)))
    return F.array_join(cased, "")


def bold_html(c):
    """Leading ``**`` to ``<b>``, then the next ``**`` to ``</b>``."""
    opened = F.regexp_replace(c, r"^\*\*", "<b>")
    return F.regexp_replace(opened, r"(?s)^(.*?)\*\*", "$1</b>")


def bold_title(html, default):
    """The text in bold, or ``default`` if there is none."""
    return F.coalesce(null_if_empty(F.regexp_extract(html, "<b>(.+)</b>", 1)), default)


def uri_company(c):
    """Company number from the URI of a filing, NULL if the URI has another form."""
    return null_if_empty(F.regexp_extract(c, FILING_URI_PATTERN, 1))


def parse_path(c):
    """Parts of a bulk accounts path as a struct; all fields are NULL for other paths."""

    def part(n):
        return null_if_empty(F.regexp_extract(c, BULK_FILE_PATTERN, n))

    return F.struct(
        part(1).alias("bulk_month"),
        part(2).alias("bulk_year"),
        part(3).alias("company_number"),
        F.try_to_date(F.concat_ws("-", part(4), part(5), part(6)), "yyyy-MM-dd").alias(
            "accounts_date"
        ),
        part(7).alias("extension"),
    )


def strip_prefix(c):
    """``namespace:name`` to ``name``."""
    return F.regexp_replace(c, "^.*:", "")


def clean_label(c):
    """Bare name of a dimension label such as ``(via targetRole) x-Name [dimension]``."""
    return null_if_empty(F.regexp_extract(c, DIMENSION_LABEL_PATTERN, 1))


def count_char(c, ch):
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def yes_flag(c):
    return c == "Y"


def json_field(c, field):
    """Top-level field of a JSON text, as text."""
    return F.get_json_object(c, f"$.{field}")


def outer_key(a, b):
    """Key of a full outer join: the left one, or the right one where the left is missing."""
    return F.coalesce(a, b)
