"""Numbers that arrive as text."""

from pyspark.sql import functions as F

DECIMAL = "decimal(38,6)"
NUMERIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _looks_numeric(bare):
    """A look at the text first: a failed cast raises inside, which is slow on many names."""
    return bare.rlike(NUMERIC)


def to_decimal(c, decimal_type=DECIMAL):
    """Numeric text with or without thousands commas to DECIMAL, otherwise NULL."""
    bare = F.replace(F.trim(c), F.lit(","), F.lit(""))
    return F.when(_looks_numeric(bare), bare.try_cast(decimal_type))


def clean_number(c):
    """Drop thousands commas and blanks from numeric text; other text is kept as it is."""
    bare = F.trim(F.replace(c, F.lit(","), F.lit("")))
    return F.when(_looks_numeric(bare), bare).otherwise(c)


def int_or_text(c):
    """(number, text): integer-looking text goes to the first, all else to the second."""
    is_int = c.rlike(r"^-?\d+$")
    return F.when(is_int, c.try_cast("decimal(38,0)")), F.when(~is_int, c)


def round_half_up(c, digits=0):
    return F.round(c, digits)


def safe_cast(c, type_name):
    """Cast that gives NULL instead of failing the job."""
    return c.try_cast(type_name)
