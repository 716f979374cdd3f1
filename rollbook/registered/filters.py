"""Projections, filters and predicates."""

from pyspark.sql import functions as F

from ..fixed_values import REGISTERED_NUMBER_LABEL
from ..operators import (
    above,
    complete_groups,
    in_values,
    lookup,
    lookup_misses,
    match_name,
    null_sentinels,
    recent,
    rename_case,
    require,
    route_by_length,
    self_consistent,
    time_range,
    unresolved,
)
from ..plans import company_document, warehouse_company
from ..sources import nest_dotted
from ..streaming import flatten_company, parse_or_quarantine
from ..schemas import COMPANY_EVENT
from .adapters import (
    companies,
    facts,
    postcodes,
    stamp,
    table,
    with_sql,
)
from .registry import query
from .shapes import COMPANY_FLAT, company_event_json, snapshot_rows


@query(
    "pf01_flatten_company",
    with_sql(
        "register_events",
        f"""SELECT id, name, number, streetaddress, county, country, postcode, category, origin,
                   status, date, strftime(published, '%Y-%m-%d %H:%M:%S') AS published, timepoint
            FROM ({COMPANY_FLAT}) AS flat""",
    ),
)
def pf01(spark, folder):
    envelopes, _ = parse_or_quarantine(company_event_json(spark, folder), COMPANY_EVENT)
    flat = flatten_company(envelopes)
    return flat.withColumns({"date": F.col("date").cast("string"), "published": stamp("published")})


@query(
    "pf02_company_document",
    """SELECT lpad(c_custkey::VARCHAR, 8, '0') AS number, c_name AS name,
              n_name AS county, CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
                                     ELSE c_mktsegment END AS account_category,
              CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE '2021-03-31' END AS made_up_to,
              CASE WHEN c_acctbal >= 0 AND c_nationkey > 0 THEN c_nationkey END AS mortgages,
              '1999-05-' || lpad((c_nationkey + 1)::VARCHAR, 2, '0') AS incorporated,
              CASE WHEN c_acctbal >= 0 THEN NULL ELSE '2022-01-31' END AS statement_due,
              CASE WHEN c_nationkey > 20 THEN '' WHEN c_nationkey > 10 THEN 'Old ' || c_name
                   ELSE 'Old ' || c_name || '|Older ' || c_name END AS previous_names,
              CASE WHEN c_mktsegment = 'BUILDING' THEN ''
                   ELSE (41000 + c_nationkey)::VARCHAR END AS sic_codes,
              c_nationkey AS limited_partners
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def pf02(spark, folder):
    document = company_document(nest_dotted(snapshot_rows(spark, folder)))
    return document.select(
        F.col("companyNumber").alias("number"),
        "name",
        F.col("address.county").alias("county"),
        F.col("accounts.accountCategory").alias("account_category"),
        F.col("accounts.lastMadeUpTo").cast("string").alias("made_up_to"),
        F.col("mortgages.mortgageCharges").alias("mortgages"),
        F.col("incorporationDate").cast("string").alias("incorporated"),
        F.col("confirmationStatement.nextDueDate").cast("string").alias("statement_due"),
        F.array_join(F.transform("previousNames", lambda p: p["name"]), "|").alias(
            "previous_names"
        ),
        F.array_join("sicCodes", "|").alias("sic_codes"),
        F.col("limitedPartnerships.limitedPartners").alias("limited_partners"),
    )


@query(
    "pf03_optional_struct",
    """SELECT COUNT(*) AS companies,
              COUNT(*) FILTER (WHERE c_mktsegment <> 'MACHINERY') AS with_accounts,
              COUNT(*) FILTER (WHERE c_acctbal >= 0 AND c_nationkey > 0) AS with_mortgages,
              COUNT(*) FILTER (WHERE c_acctbal < 0) AS with_statement,
              COUNT(*) FILTER (WHERE c_nationkey > 12) AS with_returns
       FROM customer""",
)
def pf03(spark, folder):
    document = company_document(nest_dotted(snapshot_rows(spark, folder)))
    return document.agg(
        F.count("*").alias("companies"),
        F.count("accounts").alias("with_accounts"),
        F.count("mortgages").alias("with_mortgages"),
        F.count("confirmationStatement").alias("with_statement"),
        F.count("returns").alias("with_returns"),
    )


@query(
    "pf04_rename_case",
    """SELECT c_custkey AS "cCustkey", c_name AS "cName", c_mktsegment AS "cMktsegment"
       FROM customer""",
)
def pf04(spark, folder):
    return rename_case(table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment"))


@query(
    "pf05_lookup",
    with_sql(
        "companies",
        """, wanted AS (SELECT DISTINCT lpad(p_partkey::VARCHAR, 8, '0') AS number FROM part)
           SELECT w.number, c.name, c.county, CASE WHEN c.number IS NULL THEN 0 ELSE 1 END AS matches
           FROM wanted w LEFT JOIN companies c ON w.number = c.number""",
    ),
)
def pf05(spark, folder):
    wanted = table(spark, folder, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("number")
    )
    found = lookup(companies(spark, folder), "number", wanted)
    return found.select("number", "name", "county", F.col("matches").cast("int").alias("matches"))


@query(
    "pf06_lookup_misses",
    with_sql(
        "companies",
        """SELECT DISTINCT lpad(p_partkey::VARCHAR, 8, '0') AS number FROM part
           WHERE lpad(p_partkey::VARCHAR, 8, '0') NOT IN (SELECT number FROM companies)""",
    ),
)
def pf06(spark, folder):
    wanted = table(spark, folder, "part").select(
        F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("number")
    )
    return lookup_misses(wanted, companies(spark, folder), "number")


@query(
    "pf07_time_range",
    """SELECT event_id, user_id FROM events
       WHERE ts > TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-31' - INTERVAL 7 DAYS""",
)
def pf07(spark, folder):
    end = F.expr("TIMESTAMP_NTZ '2024-01-31' - INTERVAL 7 DAYS")
    events = table(spark, folder, "events")
    return time_range(events, "ts", F.expr("TIMESTAMP_NTZ '2024-01-08'"), end).select(
        "event_id", "user_id"
    )


@query(
    "pf08_above",
    """SELECT doc_id, n_chars FROM documents WHERE n_chars > 100
       ORDER BY n_chars DESC, doc_id LIMIT 50""",
)
def pf08(spark, folder):
    rows = table(spark, folder, "documents").select("doc_id", "n_chars")
    return above(rows, "n_chars", 100, 50, [F.desc("n_chars"), F.asc("doc_id")])


@query(
    "pf09_unresolved",
    """SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       WHERE l.quality IS NULL""",
)
def pf09(spark, folder):
    labelled = table(spark, folder, "documents").join(
        table(spark, folder, "labels"), "doc_id", "left"
    )
    return unresolved(labelled, "quality").select("doc_id", "lang")


@query(
    "pf10_in_values",
    with_sql(
        "postcodes",
        """SELECT postcode, county, built_up_area FROM postcodes
           WHERE county = 'NATION_3' OR county = 'NATION_7' OR county = 'NATION_11'""",
    ),
)
def pf10(spark, folder):
    return in_values(postcodes(spark, folder), "county", ["NATION_3", "NATION_7", "NATION_11"])


@query(
    "pf11_self_consistent",
    with_sql(
        "facts",
        f"""SELECT DISTINCT company_number, end_date FROM facts
            WHERE label = '{REGISTERED_NUMBER_LABEL}' AND value = company_number""",
    ),
)
def pf11(spark, folder):
    return self_consistent(
        facts(spark, folder), REGISTERED_NUMBER_LABEL, "company_number", ["company_number", "end_date"]
    )


@query(
    "pf12_require",
    """SELECT page_id FROM pages
       WHERE length(regexp_extract(url, '[?](.*)', 1)) > 0 AND length(html) > 0""",
)
def pf12(spark, folder):
    pages = table(spark, folder, "pages").withColumn("query", F.regexp_extract("url", "[?](.*)", 1))
    return require(pages, ["query", "html"]).select("page_id")


@query(
    "pf13_null_sentinels",
    """SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'P') THEN NULL ELSE o_orderstatus END
                              AS status,
              CASE WHEN o_orderpriority = '5-LOW' THEN '0' ELSE o_orderpriority END AS decimals
       FROM orders""",
)
def pf13(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "INF")
        .otherwise(F.col("o_orderpriority"))
        .alias("decimals"),
    )
    return null_sentinels(orders, ["status"], ["F", "P"], "decimals")


@query(
    "pf14_route_by_length",
    """SELECT doc_id, length(text) AS n, CASE WHEN length(text) + length(lang) < 2000
                                              THEN 'short' ELSE 'long' END AS route
       FROM documents""",
)
def pf14(spark, folder):
    texts = table(spark, folder, "documents")
    short, long = route_by_length(texts, ["text", "lang"], 2000)
    both = short.withColumn("route", F.lit("short")).unionByName(
        long.withColumn("route", F.lit("long"))
    )
    return both.select("doc_id", F.length("text").cast("bigint").alias("n"), "route")


@query(
    "pf15_match_name",
    r"""SELECT page_id, regexp_matches(url, '^https://[a-z.]+/[a-z]{2}/\d+') AS matched
        FROM pages""",
)
def pf15(spark, folder):
    ok, bad = match_name(table(spark, folder, "pages"), "url", r"^https://[a-z.]+/[a-z]{2}/\d+")
    both = ok.withColumn("matched", F.lit(True)).unionByName(bad.withColumn("matched", F.lit(False)))
    return both.select("page_id", "matched")


@query(
    "pf16_complete_groups",
    """SELECT o_orderkey, CAST(length(o_orderpriority) AS BIGINT) AS declared,
              COUNT(l_orderkey) AS found, COUNT(l_orderkey) = MIN(length(o_orderpriority)) AS complete
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
       GROUP BY o_orderkey, o_orderpriority""",
)
def pf16(spark, folder):
    declared = table(spark, folder, "orders").select(
        "o_orderkey", F.length("o_orderpriority").cast("bigint").alias("declared")
    )
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    ok, bad = complete_groups(lines, declared, "o_orderkey", "declared")
    return ok.withColumn("complete", F.lit(True)).unionByName(
        bad.withColumn("complete", F.lit(False))
    )


@query(
    "pf17_recent",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
       WHERE ts > TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 DAY""",
)
def pf17(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    return recent(events, "ts", "2024-01-30 12:00:00").select("event_id", stamp("ts"))


@query(
    "pf18_warehouse_company",
    """SELECT lpad(c_custkey::VARCHAR, 8, '0') AS company_number, c_name AS company_name,
              'PC' || c_nationkey AS postcode, (c_custkey + 1)::VARCHAR || ' High Street'
                  AS address_line_1,
              '1999-05-' || lpad((c_nationkey + 1)::VARCHAR, 2, '0') AS incorporation_date,
              CASE WHEN c_acctbal >= 0 AND c_nationkey > 0 THEN c_nationkey END AS mortgages_charges
       FROM customer""",
)
def pf18(spark, folder):
    rows = warehouse_company(nest_dotted(snapshot_rows(spark, folder)))
    return rows.select(
        "company_number",
        "company_name",
        "postcode",
        "address_line_1",
        F.col("incorporation_date").cast("string").alias("incorporation_date"),
        F.col("mortgages_charges").cast("int").alias("mortgages_charges"),
    )
