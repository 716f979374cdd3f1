"""Tables that a job writes on the way, and joins whose small side is checked before it is sent."""

from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import functions as F

from ..session import shared_folder

#: Rows of two or three numbers that may be sent to every executor (about 64 MB).
SENT_ROWS = 2_000_000


_scope = ContextVar("scope", default=None)


@contextmanager
def scratch(spark):
    """Tables ``written`` inside are deleted at the end, but those with ``keep``, which belong to the
    scope around, if any. What leaves the block must not read the deleted ones."""
    outer, inside = _scope.get(), []
    token = _scope.set((inside, outer))
    try:
        yield
    finally:
        _scope.reset(token)
        for path in inside:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def written(df, name, keep=False, group_bytes=None):
    """``df`` written to the shared folder and read back: lineage ends here, and a lost executor
    costs only its running tasks. ``group_bytes`` are those of a row group, for wide rows."""
    path = shared_folder(df.sparkSession, f"llm-{name}")
    scope = _scope.get()
    if scope and keep:
        scope = scope[1]
    if scope:
        scope[0].append(path)
    writer = df.write.option("parquet.block.size", group_bytes) if group_bytes else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df, rows=SENT_ROWS):
    """``df`` (narrow rows of a written table) marked for broadcast if it has at most ``rows``
    rows; else as it is, and the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def documents_of(spark, folder, *columns):
    """The named columns of ``documents``; the scan reads no other."""
    return spark.read.parquet(f"{folder}/documents.parquet").select(*columns)
