"""Joins."""

from pyspark.sql import functions as F

from ..operators import (
    band_join,
    client_counts,
    describe,
    enrich_stream,
    frequency,
    in_region,
    join_buckets,
    join_facts,
    join_json_field,
    key_list,
    not_processed,
    relabel_all_or_none,
    scalar_lookup,
    update_from,
    with_area,
    with_exists_flag,
)
from .adapters import (
    SEQ,
    companies,
    company_events,
    documents,
    facts,
    filing_events,
    line_parts,
    postcodes,
    register_events,
    stamp,
    table,
    templates,
    with_sql,
)
from .registry import query


@query(
    "jn01_join_buckets",
    with_sql(
        "filing_events company_events",
        """, f AS (SELECT date_trunc('hour', published) AS bucket, COUNT(*) AS filing
                   FROM filing_events GROUP BY ALL),
             c AS (SELECT date_trunc('hour', published) AS bucket, COUNT(*) AS company
                   FROM company_events GROUP BY ALL)
           SELECT strftime(bucket, '%Y-%m-%d %H:%M:%S') AS bucket, filing, company
           FROM f FULL JOIN c USING (bucket)""",
    ),
)
def jn01(spark, folder):
    both = join_buckets(
        frequency(filing_events(spark, folder), "published", "hour", "filing"),
        frequency(company_events(spark, folder), "published", "hour", "company"),
        "bucket",
    )
    return both.select(stamp("bucket"), "filing", "company")


@query(
    "jn02_with_area",
    with_sql(
        "companies postcodes",
        """SELECT c.postcode AS post_code, c.number, c.name, p.built_up_area AS area
           FROM companies c JOIN postcodes p ON c.postcode = p.postcode
           WHERE p.county = 'NATION_4'""",
    ),
)
def jn02(spark, folder):
    rows = companies(spark, folder).select(F.col("postcode").alias("post_code"), "number", "name")
    return with_area(rows, postcodes(spark, folder), "NATION_4")


@query(
    "jn03_in_region",
    """SELECT DISTINCT lpad(o_custkey::VARCHAR, 8, '0') AS company_number,
              strftime(o_orderdate, '%Y-%m-%d') AS end_date
       FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       WHERE n_name IN ('NATION_1', 'NATION_2', 'NATION_3')""",
)
def jn03(spark, folder):
    keys = key_list(
        table(spark, folder, "orders").select(
            F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("company_number"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("end_date"),
        ),
        ["company_number", "end_date"],
    )
    counties = ["NATION_1", "NATION_2", "NATION_3"]
    return in_region(keys, companies(spark, folder), postcodes(spark, folder), counties)


@query(
    "jn04_join_facts",
    with_sql(
        "facts",
        """, k AS (SELECT DISTINCT company_number, end_date FROM facts
                   WHERE label = 'UK Companies House registered number'
                     AND value = company_number)
           SELECT f.company_number, f.end_date, COUNT(*) AS n, MAX(value) AS high
           FROM k JOIN facts f ON f.company_number = k.company_number AND f.end_date = k.end_date
           GROUP BY ALL""",
    ),
)
def jn04(spark, folder):
    parts = line_parts(spark, folder, ["company_number"])
    rows = facts(spark, folder, parts=parts)
    keys = rows.filter(
        (F.col("label") == "UK Companies House registered number")
        & (F.col("value") == F.col("company_number"))
    )
    joined = join_facts(
        key_list(keys, ["company_number", "end_date"]), rows, near="company_number" if parts[1] else None
    )
    return joined.groupBy("company_number", "end_date").agg(
        F.count("*").alias("n"), F.max("value").alias("high")
    )


@query(
    "jn05_scalar_lookup",
    with_sql(
        "companies",
        """SELECT o_orderkey, lpad(o_custkey::VARCHAR, 8, '0') AS company_number, postcode
           FROM orders LEFT JOIN companies ON lpad(o_custkey::VARCHAR, 8, '0') = number""",
    ),
)
def jn05(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("company_number")
    )
    return scalar_lookup(orders, companies(spark, folder), "company_number", "postcode", "number")


@query(
    "jn06_band_join",
    """SELECT l_orderkey AS orderkey, l_partkey, l_linenumber, l_suppkey,
              strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        AND l_shipdate BETWEEN o_orderdate - INTERVAL 60 DAY AND o_orderdate + INTERVAL 60 DAY""",
)
def jn06(spark, folder):
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_partkey", "l_linenumber", "l_suppkey", "l_shipdate"
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), "o_orderdate"
    )
    pairs = band_join(items, orders, "orderkey", "l_shipdate", "o_orderdate", 60 * 86400)
    return pairs.drop("o_orderdate").withColumn("l_shipdate", stamp("l_shipdate"))


@query(
    "jn07_join_json_field",
    with_sql(
        "register_events",
        """, f AS (SELECT company_number, k::VARCHAR AS made_up, MIN(timepoint) AS timepoint,
                          ARG_MIN(kind, timepoint) AS kind
                   FROM register_events GROUP BY ALL)
           SELECT lpad(o_custkey::VARCHAR, 8, '0') AS company_number, o_orderkey,
                  dayofyear(o_orderdate)::VARCHAR AS accounts_date, timepoint, kind
           FROM orders LEFT JOIN f ON lpad(o_custkey::VARCHAR, 8, '0') = company_number
                                  AND dayofyear(o_orderdate)::VARCHAR = made_up""",
    ),
)
def jn07(spark, folder):
    accounts = table(spark, folder, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 8, "0").alias("company_number"),
        F.col("o_orderkey"),
        F.dayofyear("o_orderdate").cast("string").alias("accounts_date"),
    )
    filings = register_events(spark, folder).select(
        "company_number",
        "timepoint",
        "kind",
        F.create_map(F.lit("made_up_date"), F.col("k").cast("string")).alias("description_values"),
    )
    return join_json_field(
        accounts, filings, "company_number", "made_up_date", "accounts_date", "timepoint"
    ).select("company_number", "o_orderkey", "accounts_date", "timepoint", "kind")


@query(
    "jn08_describe",
    """SELECT p_partkey, CASE WHEN p_size > 40 THEN lower(p_type) || 'WithSize'
                              ELSE '**' || p_type || '** by ' || p_brand || ', size ' || p_size
                                   || ' {charge number}' END AS description
       FROM part""",
)
def jn08(spark, folder):
    parts = table(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_size") > 40, F.concat(F.lower("p_type"), F.lit("-with-size")))
        .otherwise(F.col("p_type"))
        .alias("description_code"),
        F.create_map(
            F.lit("brand"), F.col("p_brand"), F.lit("size"), F.col("p_size").cast("string")
        ).alias("description_values"),
    )
    return describe(parts, templates(spark, folder), "left").select("p_partkey", "description")


@query(
    "jn09_not_processed",
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def jn09(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    done = table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    return not_processed(orders, done.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"])


@query(
    "jn10_with_exists_flag",
    """SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
                  AS in_postgres
       FROM customer""",
)
def jn10(spark, folder):
    orders = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "P")
    return with_exists_flag(
        table(spark, folder, "customer").select("c_custkey"),
        orders.select(F.col("o_custkey").alias("c_custkey")),
        ["c_custkey"],
        "in_postgres",
    )


@query(
    "jn11_update_from",
    """SELECT c_custkey, coalesce(latest, 'none') AS transaction_id
       FROM customer LEFT JOIN (SELECT o_custkey, MAX(o_orderkey::VARCHAR) AS latest FROM orders
                                WHERE o_orderstatus = 'F' GROUP BY o_custkey) AS n
            ON c_custkey = o_custkey""",
)
def jn11(spark, folder):
    target = table(spark, folder, "customer").select(
        "c_custkey", F.lit("none").alias("transaction_id")
    )
    src = table(spark, folder, "orders").filter(F.col("o_orderstatus") == "F")
    src = src.select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_orderkey").cast("string").alias("transaction_id"),
    )
    return update_from(target, src, ["c_custkey"], "transaction_id")


@query(
    "jn12_enrich_stream",
    with_sql(
        "register_events companies",
        """SELECT e.id, e.company_number, c.name, c.county
           FROM register_events e LEFT JOIN companies c ON e.company_number = c.number""",
    ),
)
def jn12(spark, folder):
    ev = register_events(spark, folder).select("id", "company_number")
    out = enrich_stream(ev, companies(spark, folder))
    return out.select("id", "company_number", "company_profile.name", "company_profile.county")


@query(
    "jn13_relabel_all_or_none",
    f"""SELECT l_orderkey::VARCHAR AS document, {SEQ} AS position,
              'Flag ' || l_returnflag AS dimension, s_name AS member
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
       WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem JOIN supplier
                                ON l_suppkey = s_suppkey WHERE s_acctbal < 0)""",
)
def jn13(spark, folder):
    items = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("document"),
        F.expr(SEQ).alias("position"),
        "l_suppkey",
        F.create_map(
            F.concat(F.lit("uk-bus:"), F.col("l_returnflag")),
            F.concat(F.lit("uk-geo:"), F.col("l_suppkey").cast("string")),
        ).alias("dimensions"),
    )
    flags = table(spark, folder, "lineitem").select("l_returnflag").distinct()
    names = flags.select(
        F.col("l_returnflag").alias("key"),
        F.concat(F.lit("(via targetRole) x-Flag "), "l_returnflag", F.lit(" [dimension]")).alias(
            "value"
        ),
    )
    solvent = table(spark, folder, "supplier").filter(F.col("s_acctbal") >= 0)
    members = solvent.select(
        F.col("s_suppkey").cast("string").alias("key"), F.col("s_name").alias("value")
    )
    good, _ = relabel_all_or_none(items, names.unionByName(members))
    return good.select(
        "document", "position", F.explode("additional_info").alias("dimension", "member")
    )


@query(
    "jn14_client_counts",
    with_sql(
        "facts",
        """, c AS (SELECT value AS name, COUNT(DISTINCT company_number) AS number_of_clients
                   FROM facts WHERE label = 'Name of entity accountants' GROUP BY value)
           SELECT 'Adviser ' || p_partkey AS name, coalesce(number_of_clients, 0) AS number_of_clients
           FROM part LEFT JOIN c ON 'Adviser ' || p_partkey = c.name""",
    ),
)
def jn14(spark, folder):
    advisers = table(spark, folder, "part").select(
        F.concat(F.lit("Adviser "), F.col("p_partkey").cast("string")).alias("name")
    )
    return client_counts(advisers, documents(spark, folder))
