"""Register snapshots: CSV with dotted headers, mapped CSV, JSON lines, delimited text."""

from pyspark.sql import functions as F

from .headed import MOST_COLUMNS, cell, header_names, raw_reader, with_file, with_header


def _lines(spark, path, columns=MOST_COLUMNS, **options):
    """All columns as text: company numbers such as 00012345 must not become numbers."""
    return with_header(with_file(raw_reader(spark.read, columns, **options).csv(path)))


def nest_dotted(df):
    """Columns named ``a.b`` become field ``b`` of struct ``a``; names are trimmed."""
    fields = {}
    for raw in df.columns:
        name = raw.strip()
        parent, _, child = name.partition(".")
        fields.setdefault(parent, []).append((child, F.col(f"`{raw}`")))
    out = []
    for parent, members in fields.items():
        if members[0][0] == "":
            out.append(members[0][1].alias(parent))
        else:
            out.append(F.struct(*[c.alias(child) for child, c in members]).alias(parent))
    return df.select(*out)


def read_snapshot_csv(spark, path, schema=None, place=None, **options):
    """CSV files with dotted headers as nested text columns, each file by its own header.

    With ``schema`` (a StructType) the result has exactly those columns; one that the files
    lack is NULL. ``place`` names a column to add: the place of the row, older files first.
    ``multiline=True`` allows line breaks in values; a file is then read by one task. ``columns`` is the
    greatest width: a line with more cells ends the job.
    """
    lines = _lines(spark, path, **options)
    names = header_names(lines)
    flat = lines.select(*[cell(name).alias(name) for name in names], *([F.col("seq").alias(place)] if place else []))
    df = nest_dotted(flat)
    if schema is None:
        return df
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_json_lines(spark, path, schema):
    return spark.read.schema(schema).json(path)


def read_mapped_csv(spark, path, header_map, place=None, **options):
    """Keep and rename the headers in ``header_map``, each file by its own header; see ``read_snapshot_csv``."""
    lines = _lines(spark, path, **options)
    names = set(header_names(lines))
    kept = [cell(raw).alias(name) for raw, name in header_map.items() if raw in names]
    return lines.select(*kept, *([F.col("seq").alias(place)] if place else []))


def read_delimited(spark, path, sep="<"):
    """Delimited text with a header line and no quoting."""
    lines = _lines(spark, path, sep=sep, quote="")
    return lines.select(*[cell(name).alias(name) for name in header_names(lines)])
