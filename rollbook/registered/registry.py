"""Where queries are registered."""

from functools import wraps

QUERIES = {}
SQL = {}


def query(name, sql=None):
    """Register a function (spark, folder) -> DataFrame, with the SQL that gives the same."""

    def add(function):
        if name in QUERIES:
            raise ValueError(f"query {name} exists already")

        @wraps(function)
        def run(spark, folder):
            # buckets and dates are those of UTC, whatever session the query is given
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return function

    return add
