"""Dedupe and keyed merges."""

from pyspark.sql import functions as F

from ..operators import (
    add_parents,
    append_values,
    drop_exact,
    insert_new,
    merge_maps,
    refresh,
    replace_documents,
    unique,
    upsert,
    upsert_largest,
)
from ..session import shared_folder
from .adapters import companies, facts, incoming, stamp, table, with_sql
from .registry import query

COLUMNS = "number, name, streetaddress, county, country, postcode, category, origin, status"
UPDATED = ["name", "streetaddress", "county", "country", "postcode", "category", "status"]


@query(
    "mg01_insert_new",
    with_sql(
        "companies incoming",
        f"""SELECT {COLUMNS} FROM companies UNION ALL
            SELECT {COLUMNS} FROM incoming WHERE number NOT IN (SELECT number FROM companies)""",
    ),
)
def mg01(spark, folder):
    return insert_new(companies(spark, folder), incoming(spark, folder), "number", F.col("name"))


@query(
    "mg02_upsert",
    with_sql(
        "companies incoming",
        f"""SELECT coalesce(n.number, c.number) AS number,
                   {", ".join(f"CASE WHEN n.number IS NULL THEN c.{x} ELSE n.{x} END AS {x}"
                              for x in UPDATED)},
                   coalesce(c.origin, n.origin) AS origin
            FROM companies c FULL JOIN incoming n ON c.number = n.number""",
    ),
)
def mg02(spark, folder):
    return upsert(
        companies(spark, folder), incoming(spark, folder), "number", UPDATED, ["origin"], F.col("name")
    )


FILINGS = """, t AS (SELECT o_orderkey AS id, o_orderstatus AS category, 'old' AS description,
                            o_orderpriority AS description_values FROM orders),
              s AS (SELECT l_orderkey AS id, 'new' AS category,
                           MIN(l_returnflag) AS description, MIN(l_linestatus) AS description_values
                    FROM lineitem WHERE l_returnflag <> 'N' GROUP BY l_orderkey)"""


@query(
    "mg03_upsert_description",
    "WITH "
    + FILINGS[1:]
    + """ SELECT coalesce(t.id, s.id) AS id, coalesce(t.category, s.category) AS category,
                 CASE WHEN s.id IS NULL THEN t.description ELSE s.description END AS description,
                 CASE WHEN s.id IS NULL THEN t.description_values ELSE s.description_values END
                     AS description_values
          FROM t FULL JOIN s ON t.id = s.id""",
)
def mg03(spark, folder):
    target = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("category"),
        F.lit("old").alias("description"),
        F.col("o_orderpriority").alias("description_values"),
    )
    lines = table(spark, folder, "lineitem").filter(F.col("l_returnflag") != "N")
    src = lines.groupBy(F.col("l_orderkey").alias("id")).agg(
        F.lit("new").alias("category"),
        F.min("l_returnflag").alias("description"),
        F.min("l_linestatus").alias("description_values"),
    )
    return upsert(target, src, "id", ["description", "description_values"])


@query(
    "mg04_upsert_flags",
    """SELECT coalesce(c_custkey, o_custkey) AS company_number,
              CASE WHEN o_custkey IS NULL THEN FALSE ELSE shipped END AS csv_scanned,
              CASE WHEN o_custkey IS NULL THEN FALSE ELSE TRUE END AS in_postgres,
              coalesce(c_mktsegment, 'none') AS bulk_month
       FROM customer FULL JOIN (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS shipped
                                FROM orders GROUP BY o_custkey) AS o ON c_custkey = o_custkey""",
)
def mg04(spark, folder):
    target = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("company_number"),
        F.lit(False).alias("csv_scanned"),
        F.lit(False).alias("in_postgres"),
        F.col("c_mktsegment").alias("bulk_month"),
    )
    src = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("company_number"))
        .agg(
            F.bool_or(F.col("o_orderstatus") == "F").alias("csv_scanned"),
            F.lit(True).alias("in_postgres"),
            F.lit("none").alias("bulk_month"),
        )
    )
    return upsert(target, src, "company_number", ["csv_scanned", "in_postgres"])


@query(
    "mg05_upsert_largest",
    with_sql(
        "facts",
        """, n AS (SELECT company_number, label, value,
                          TRY_CAST(REPLACE(value, ',', '') AS DECIMAL(38,6)) AS number,
                          CASE WHEN batch = 'O' THEN 0 ELSE 1 END AS age, seq
                   FROM facts),
             r AS (SELECT *, row_number() OVER k AS nth, first_value(number) OVER k AS first_number,
                          row_number() OVER (PARTITION BY company_number, label
                                             ORDER BY abs(number) DESC NULLS LAST, age, seq) AS big
                   FROM n WINDOW k AS (PARTITION BY company_number, label ORDER BY age, seq))
           SELECT company_number, label,
                  MAX(CASE WHEN first_number IS NULL AND nth = 1 THEN value
                           WHEN first_number IS NOT NULL AND big = 1 THEN value END) AS value
           FROM r GROUP BY ALL""",
    ),
)
def mg05(spark, folder):
    rows = facts(spark, folder, ["company_number"]).select("company_number", "label", "value", "seq", "batch")
    old = rows.filter(F.col("batch") == "O").drop("batch")
    new = rows.filter(F.col("batch") != "O").drop("batch")
    return upsert_largest(old, new, ["company_number", "label"], "value", F.col("seq")).drop("seq")


@query(
    "mg06_replace_documents",
    with_sql(
        "companies incoming",
        f"""SELECT {COLUMNS} FROM incoming UNION ALL
            SELECT {COLUMNS} FROM companies WHERE number NOT IN (SELECT number FROM incoming)""",
    ),
)
def mg06(spark, folder):
    return replace_documents(
        companies(spark, folder), incoming(spark, folder), "number", F.col("name")
    )


@query(
    "mg07_drop_exact",
    with_sql(
        "facts",
        """SELECT company_number, COUNT(*) AS n, MIN(value) AS low, MAX(value) AS high
           FROM (SELECT DISTINCT company_number, end_date, label, value FROM facts) AS d
           GROUP BY company_number""",
    ),
)
def mg07(spark, folder):
    rows = drop_exact(facts(spark, folder, ["company_number"]), ["company_number", "end_date", "label", "value"], F.col("seq"))
    return rows.groupBy("company_number").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


@query(
    "mg08_add_parents",
    with_sql(
        "companies",
        """SELECT number, name, county FROM companies UNION ALL
           SELECT DISTINCT lpad(l_orderkey::VARCHAR, 8, '0') AS number, NULL, NULL FROM lineitem
           WHERE lpad(l_orderkey::VARCHAR, 8, '0') NOT IN (SELECT number FROM companies)""",
    ),
)
def mg08(spark, folder):
    child = table(spark, folder, "lineitem").select(
        F.lpad(F.col("l_orderkey").cast("string"), 8, "0").alias("company_number")
    )
    parents = companies(spark, folder).select("number", "name", "county")
    return add_parents(child, parents, "number", "company_number")


@query("mg09_unique", "SELECT DISTINCT p_brand FROM part")
def mg09(spark, folder):
    return unique(table(spark, folder, "part"), "p_brand")


@query(
    "mg10_merge_maps",
    """, o AS (SELECT n_name AS key, MAX(c_name) AS value FROM customer
               JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name),
         n AS (SELECT 'NATION_' || (s_nationkey + 3) AS key, MAX(s_name) AS value
               FROM supplier GROUP BY s_nationkey)
       SELECT coalesce(n.key, o.key) AS key, coalesce(n.value, o.value) AS value
       FROM o FULL JOIN n ON o.key = n.key""".replace(", o AS", "WITH o AS", 1),
)
def mg10(spark, folder):
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    old = customers.groupBy(F.col("n_name").alias("key")).agg(F.max("c_name").alias("value"))
    name = F.concat(F.lit("NATION_"), (F.col("s_nationkey") + 3).cast("string"))
    new = table(spark, folder, "supplier").groupBy(name.alias("key")).agg(
        F.max("s_name").alias("value")
    )
    return merge_maps(old, new)


@query(
    "mg11_append_values",
    """WITH b AS (SELECT c_custkey AS k, -1 AS o, c_mktsegment AS v FROM customer UNION ALL
                  SELECT o_custkey, o_orderkey, o_orderstatus FROM orders)
       SELECT k, o, v, CASE WHEN o = -1 THEN 0 ELSE 1 END AS age FROM b""",
)
def mg11(spark, folder):
    target = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("k"), F.lit(-1).cast("bigint").alias("o"), F.col("c_mktsegment").alias("v")
    )
    src = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("o"), F.col("o_orderstatus").alias("v")
    )
    return append_values(target, src, "k", "v", "o")


@query(
    "mg12_refresh",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS day, event_type,
              COUNT(*) AS n FROM events GROUP BY ALL""",
)
def mg12(spark, folder):
    days = (
        table(spark, folder, "events")
        .groupBy(stamp(F.date_trunc("day", "ts"), "day"), "event_type")
        .agg(F.count("*").alias("n"))
    )
    return refresh(days, shared_folder(spark, "daily"))
