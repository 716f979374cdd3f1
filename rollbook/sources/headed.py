"""CSV files that each have a header line of their own, possibly in different orders."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder

#: Columns that a file may have at most; with more, reading fails.
MOST_COLUMNS = 128


def raw_reader(reader, columns=MOST_COLUMNS, multiline=False, **options):
    """A reader of all lines, header lines too, as text columns ``_c0``, ``_c1``, ...

    There is one column more than allowed, by which ``with_file`` tells that a file is too wide, and one behind that which
    nothing reads: the parser then takes columns by their place, and a line with fewer cells is no error to it. Such an error
    is raised and caught for each line, which costs far more than the line.
    """
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(columns + 2)])
    reader = reader.schema(schema).option("escape", '"').option("multiLine", multiline).option("columnPruning", True)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader


def with_file(lines):
    """Lines as an array of cells, with the file they are from and where it begins. A line with more cells
    than the reader allows ends the job: else its last cells would be lost."""
    *columns, behind, _ = [c for c in lines.columns if c.startswith("_c")]
    path = F.col("_metadata.file_path")
    wide = F.raise_error(F.concat(F.lit(f"more than {len(columns)} columns in "), path))
    return lines.select(
        F.when(F.col(behind).isNull(), F.array(*columns)).otherwise(wide).alias("_cells"),
        path.alias("file_path"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def with_header(lines):
    """Lines of ``with_file`` with the header of their file (``_head``, trimmed) and ``seq``, their place among
    all lines: older files first, then by path, then as they stand. Header lines are left out.

    The first line of each file is found by an aggregate with a row per file and joined back, so files
    need not agree in the order or number of their columns. These lines are stored first: by the size of their table Spark
    sees whether the join has to shuffle all lines.
    """
    lines = lines.withColumn("row", F.monotonically_increasing_id())
    heads = lines.groupBy("file_path").agg(
        F.min_by("_cells", F.struct("block_start", "row")).alias("_first")
    )
    path = shared_folder(lines.sparkSession, "heads")
    heads = heads.withColumn("_head", F.transform("_first", lambda c: F.trim(c)))
    heads.write.parquet(path)
    heads = lines.sparkSession.read.schema(heads.schema).parquet(path)
    named = lines.join(heads, "file_path").filter(~F.col("_cells").eqNullSafe(F.col("_first")))
    seq = F.struct("modified", "file_path", F.col("block_start").alias("at"), "row")
    return named.withColumn("seq", seq).drop("_first", "row", "block_start", "modified")


def cell(name):
    """The cell below a header, NULL where the file has no such header."""
    place = F.array_position("_head", name)
    return F.when(place > 0, F.element_at("_cells", F.greatest(place, F.lit(1)).cast("int")))


def header_names(named):
    """All header names of the files, those of the first file first. One row per name comes to the driver."""
    names = named.select(F.posexplode("_head").alias("at", "name"), "file_path")
    names = names.filter(F.col("name").isNotNull() & (F.col("name") != "")).groupBy("name")
    found = names.agg(F.min(F.struct("file_path", "at")).alias("first")).collect()
    return [r.name for r in sorted(found, key=lambda r: tuple(r.first))]
