"""Where the queries of this subpackage are registered, and how its code reaches the executors."""

import os
import tempfile
import zipfile
from functools import wraps

QUERIES = {}
SQL = {}


def ship(spark):
    """Send the package to the executors' Python workers, once per application.

    Where the cluster has the package installed this changes nothing. Only the driver reads the
    zip file; Spark's file server hands it on.
    """
    context = spark.sparkContext
    if getattr(context, "_rollbook_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="rollbook-"), "rollbook-code.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    context._rollbook_shipped = True


def query(name, sql=None):
    """Register a function (spark, folder) -> DataFrame, with the SQL that gives the same."""

    def add(function):
        @wraps(function)
        def run(spark, folder):
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            ship(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return add
