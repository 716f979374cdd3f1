"""Windows, sorts, limits and top-k."""

from pyspark.sql import functions as F

from ..operators import (
    counter,
    high_water_mark,
    latest_buckets,
    latest_per_key,
    newest_first,
    ordered_report,
    page,
    rolling_count,
    rolling_mean,
    running_mean,
    shuffled,
    time_profile,
    top_labels,
    with_first_seen,
    with_previous,
    work_list,
)
from ..sources import latest_snapshot, ordered_scan, pending
from ..streaming import timepoint_block
from .adapters import company_events, facts, filing_events, register_events, stamp, table, with_sql
from .registry import query


@query(
    "wn01_with_previous",
    with_sql(
        "register_events",
        """SELECT id, company_number, kind, lag(kind) OVER w AS previous_kind,
                  lag(k) OVER w AS previous_k, lag(id) OVER w IS NOT NULL AS has_previous
           FROM register_events
           WINDOW w AS (PARTITION BY company_number ORDER BY timepoint)""",
    ),
)
def wn01(spark, folder):
    ev = register_events(spark, folder)
    rows = with_previous(ev, "company_number", "timepoint", ["kind", "k"], timepoint_block())
    return rows.select("id", "company_number", "kind", "previous_kind", "previous_k", "has_previous")


@query(
    "wn02_with_first_seen",
    with_sql(
        "register_events",
        """SELECT id, first_value(kind) OVER w AS first_kind, first_value(k) OVER w AS first_k
           FROM register_events
           WINDOW w AS (PARTITION BY company_number ORDER BY timepoint)""",
    ),
)
def wn02(spark, folder):
    rows = with_first_seen(
        register_events(spark, folder), "company_number", "timepoint", ["kind", "k"]
    )
    return rows.select("id", "first_kind", "first_k")


@query(
    "wn03_latest_per_key",
    with_sql(
        "facts",
        """, r AS (SELECT company_number, end_date, label, value,
                          row_number() OVER (PARTITION BY company_number
                                             ORDER BY end_date DESC, position DESC) AS n
                   FROM facts)
           SELECT company_number, end_date, label, value FROM r WHERE n = 1""",
    ),
)
def wn03(spark, folder):
    newest = latest_per_key(
        facts(spark, folder), "company_number", [F.desc("end_date"), F.desc("position")]
    )
    return newest.select("company_number", "end_date", "label", "value")


@query(
    "wn04_rolling_mean",
    with_sql(
        "register_events",
        """SELECT id, ROUND(AVG(value) OVER (PARTITION BY company_number ORDER BY timepoint
                                             ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6)
                      AS rolling_mean
           FROM register_events""",
    ),
)
def wn04(spark, folder):
    rows = rolling_mean(
        register_events(spark, folder), "company_number", "timepoint", "value", 5, timepoint_block()
    )
    return rows.select("id", F.round("rolling_mean", 6).alias("rolling_mean"))


@query(
    "wn05_rolling_count",
    with_sql(
        "register_events",
        """SELECT id, COUNT(*) OVER (PARTITION BY company_number ORDER BY published
                                     RANGE BETWEEN INTERVAL 600 MINUTE PRECEDING AND CURRENT ROW)
                      AS rolling_count
           FROM register_events""",
    ),
)
def wn05(spark, folder):
    rows = rolling_count(register_events(spark, folder), "company_number", "published", 36000)
    return rows.select("id", "rolling_count")


@query(
    "wn06_running_mean",
    with_sql(
        "register_events",
        """SELECT id, ROUND(CAST(SUM(CAST(value AS DECIMAL(20,6))) OVER w AS DOUBLE)
                            / COUNT(value) OVER w, 6) AS running_mean
           FROM register_events
           WINDOW w AS (PARTITION BY company_number ORDER BY timepoint)""",
    ),
)
def wn06(spark, folder):
    rows = running_mean(
        register_events(spark, folder), "company_number", "timepoint", "value", timepoint_block()
    )
    return rows.select("id", F.round("running_mean", 6).alias("running_mean"))


def _latest_sql(unit, k):
    def side(shape, name):
        return f"""SELECT date_trunc('{unit}', p) AS bucket, COUNT(p) AS {name}
                   FROM (SELECT CASE WHEN value < 90 THEN published END AS p FROM {shape}) AS x
                   GROUP BY ALL ORDER BY bucket DESC NULLS FIRST LIMIT {k}"""

    return with_sql(
        "filing_events company_events",
        f""", f AS ({side("filing_events", "filing")}), c AS ({side("company_events", "company")})
            SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, filing, company
            FROM f FULL JOIN c USING (bucket) WHERE bucket IS NOT NULL""",
    )


def _latest(unit):
    def run(spark, folder):
        # late values have no time of publication, so a NULL bucket comes up
        sides = [
            side(spark, folder).withColumn(
                "published", F.when(F.col("value") < 90, F.col("published"))
            )
            for side in (filing_events, company_events)
        ]
        rows = latest_buckets(*sides, "published", unit).orderBy("bucket")
        return rows.select(stamp("bucket"), "filing", "company")

    return run


for _unit in ("minute", "hour", "day", "month"):
    query(
        f"sl01_latest_buckets_{_unit}", _latest_sql(_unit, 1000 if _unit == "minute" else 48)
    )(_latest(_unit))


@query("sl02_high_water_mark", "SELECT MAX(event_id) AS event_id FROM events")
def sl02(spark, folder):
    return high_water_mark(table(spark, folder, "events"), "event_id")


@query(
    "sl03_work_list",
    """SELECT DISTINCT o_custkey FROM
         (SELECT o_custkey FROM orders WHERE nullif(o_orderstatus, 'O') IS NULL
          ORDER BY o_orderdate, o_orderkey LIMIT 600) AS first_rows""",
)
def sl03(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "transaction_id", F.nullif("o_orderstatus", F.lit("O"))
    )
    return work_list(orders, "o_custkey", ["o_orderdate", "o_orderkey"], 600, "transaction_id")


@query(
    "sl04_page",
    """SELECT o_orderkey, o_totalprice FROM orders
       ORDER BY o_orderdate, o_orderkey LIMIT 1000 OFFSET 500""",
)
def sl04(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return page(orders, ["o_orderdate", "o_orderkey"], 500, 1000).drop("o_orderdate")


@query(
    "sl05_newest_first",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS end_date FROM orders
       ORDER BY o_orderdate DESC, o_orderkey""",
)
def sl05(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("end_date")
    )
    return newest_first(orders, "end_date", "o_orderkey")


@query(
    "sl06_top_labels",
    """SELECT p_brand AS label, CAST(COUNT(*) AS BIGINT) AS n FROM lineitem
       JOIN part ON l_partkey = p_partkey GROUP BY p_brand ORDER BY n DESC, label LIMIT 10""",
)
def sl06(spark, folder):
    items = table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    counts = counter(items.withColumnRenamed("p_brand", "label"), "label", F.lit(1))
    return top_labels(counts, 10)


@query("sl07_shuffled", "SELECT o_orderkey, o_custkey FROM orders")
def sl07(spark, folder):
    return shuffled(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 7)


@query(
    "sl08_ordered_report",
    with_sql(
        "register_events",
        """, h AS (SELECT date_trunc('hour', published) AS b, COUNT(*) AS n FROM register_events
                   GROUP BY ALL)
           SELECT CAST(dayofweek(b) AS BIGINT) AS day_of_week, CAST(hour(b) AS BIGINT) AS hour,
                  MAX(n) AS busiest
           FROM h GROUP BY ALL ORDER BY ALL""",
    ),
)
def sl08(spark, folder):
    ev = register_events(spark, folder)
    rows = time_profile(ev, ev, "published", ("one", "other"))
    return ordered_report(
        rows.select("day_of_week", "hour", F.col("max_one_events").alias("busiest")),
        ["day_of_week", "hour"],
    )


@query(
    "sc13_pending",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
       ORDER BY o_orderkey""",
)
def sc13(spark, folder):
    done = table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "A")
    return pending(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey"),
        done.withColumnRenamed("l_orderkey", "o_orderkey"),
        "o_orderkey",
    )


@query(
    "sc14_latest_snapshot",
    """SELECT o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS snapshot
       FROM orders
       WHERE date_trunc('month', o_orderdate) =
             (SELECT MAX(date_trunc('month', o_orderdate)) FROM orders
              WHERE date_trunc('month', o_orderdate) IN (DATE '1997-03-01', DATE '1997-02-01'))""",
)
def sc14(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.trunc("o_orderdate", "month").alias("snapshot")
    )
    rows = latest_snapshot(orders, "snapshot", "1997-03-03")
    return rows.select("o_orderkey", F.col("snapshot").cast("string").alias("snapshot"))


@query(
    "sc16_ordered_scan",
    """SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS accounts_date FROM orders
       ORDER BY o_orderdate DESC, o_custkey""",
)
def sc16(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("accounts_date")
    )
    return ordered_scan(orders, [F.desc("accounts_date"), F.asc("o_custkey")])
