"""Whole jobs."""

from pyspark.sql import functions as F

from ..fixed_values import (
    ACCOUNTANTS_LABEL,
    FACT_BUNDLE_HEADER,
    FACT_HEADERS,
    OFFICER_LABEL,
    REGISTERED_NUMBER_LABEL,
    WIDE_ACCOUNTS,
)
from ..operators import in_order, with_position
from ..plans import (
    account_officers,
    account_documents_from_facts,
    account_documents_from_json,
    adviser_report,
    backfill_filings,
    build_tracker,
    companies_and_sic,
    company_documents,
    daily_frequency,
    hourly_frequency,
    load_company_events,
    load_fact_stream,
    load_facts,
    load_filing_events,
    load_officers,
    profile_rows,
    read_wide_accounts,
    refresh_wide_accounts,
    regional_accounts,
    sic_codes,
    wide_accounts,
)
from ..plans.accounts import FACT_COLUMNS
from ..session import shared_folder
from ..sources import pending, write_documents
from .adapters import (
    accounts,
    companies,
    company_events,
    dbl,
    documents,
    documents_and_accounts,
    facts,
    filing_events,
    line_parts,
    postcodes,
    stamp,
    table,
    with_sql,
)
from .aggregates import VALUE_MAPS, plain_profile, profile_sql
from .registry import SQL, query
from .scalars import bulk_path
from .shapes import (
    COMPANY_FLAT,
    company_event_json,
    filing_event_json,
    kind_templates,
    officer_lines,
    snapshot_rows,
)
from .sources import fact_json_documents, write_csv
from .streams import landed

C = F.col


def _snapshot(spark, folder):
    path = shared_folder(spark, "snapshot")
    write_csv(snapshot_rows(spark, folder), path)
    return path


def _pad(c):
    return F.lpad(c.cast("string"), 8, "0")


@query(
    "jb01_company_documents",
    """SELECT lpad(c_custkey::VARCHAR, 8, '0') AS number, c_name AS name,
              '1999-05-' || lpad((c_nationkey + 1)::VARCHAR, 2, '0') AS incorporated,
              CASE WHEN c_acctbal >= 0 THEN NULL ELSE '2022-01-31' END AS statement_due,
              CASE WHEN c_nationkey > 20 THEN 0 WHEN c_nationkey > 10 THEN 1 ELSE 2 END AS old_names,
              CASE WHEN c_nationkey > 12 THEN '2017-02-01' END AS returns_due
       FROM customer""",
)
def jb01(spark, folder):
    return company_documents(spark, _snapshot(spark, folder)).select(
        C("companyNumber").alias("number"),
        "name",
        C("incorporationDate").cast("string").alias("incorporated"),
        C("confirmationStatement.nextDueDate").cast("string").alias("statement_due"),
        F.size("previousNames").alias("old_names"),
        C("returns.nextDueDate").cast("string").alias("returns_due"),
    )


@query(
    "jb02_companies_and_sic",
    """SELECT c_custkey::VARCHAR AS number, c_name AS name,
              '1999-05-' || lpad((c_nationkey + 1)::VARCHAR, 2, '0') AS date,
              CASE WHEN c_mktsegment <> 'BUILDING' THEN (41000 + c_nationkey)::VARCHAR END AS sic_code
       FROM customer""",
)
def jb02(spark, folder):
    flat, codes = companies_and_sic(spark, _snapshot(spark, folder))
    joined = flat.join(codes, flat.number == codes.company_number, "left")
    return joined.select("number", "name", C("date").cast("string").alias("date"), "sic_code")


@query(
    "jb02b_activity_codes",
    """SELECT DISTINCT (41000 + n_nationkey)::VARCHAR AS code,
              CASE WHEN n_regionkey = 0 THEN 'kept' ELSE n_name || ', other "n.e.c."' END AS description
       FROM customer JOIN nation ON c_nationkey = n_nationkey
       UNION SELECT (41000 + n_nationkey)::VARCHAR, 'kept' FROM nation WHERE n_regionkey = 0""",
)
def jb02b(spark, folder):
    """A code file with a line per customer on top of a list that holds the codes of one region."""
    nation = table(spark, folder, "nation").withColumn("code", (C("n_nationkey") + 41000).cast("string"))
    lines = table(spark, folder, "customer").join(nation, C("c_nationkey") == C("n_nationkey"))
    path = shared_folder(spark, "activity-codes")
    text = F.concat("n_name", F.lit(', other "n.e.c."'))
    write_csv(lines.select(text.alias("Description"), C("c_name").alias("Other"), C("code").alias("SIC Code")), path)
    stored = nation.filter("n_regionkey = 0").select("code", F.lit("kept").alias("description"))
    return sic_codes(spark, path, stored)


def _fact_files(spark, folder):
    """Facts of an order and year as the rows of one fact file, texts as files of their own."""
    year = F.trunc(C("end_date").cast("date"), "year").cast("string")
    parts, by = line_parts(spark, folder, ["company_number"])
    of_orders = facts(spark, folder, parts=(parts, by)).select(
        C("company_number").alias("file_company"),
        year.alias("file_date"),
        "label",
        F.when(
            (C("batch") == "O") & (C("label") == "Name of production software"), "(reported)"
        )
        .otherwise(C("value"))
        .alias("value"),
        "seq",
    )
    of_texts = table(spark, folder, "documents").select(
        F.concat(F.lit("T"), F.lpad(C("doc_id").cast("string"), 7, "0")).alias("file_company"),
        F.lit("2024-01-01").alias("file_date"),
        F.concat(F.lit("Note in "), "lang").alias("label"),
        C("text").alias("value"),
        C("doc_id").alias("seq"),
    )
    if by:
        # in the same parts as the facts, so that all rows lie together by company
        of_texts = of_texts.repartition(max(1, parts), "file_company")
    text = F.lit(None).cast("string")
    return of_orders.unionByName(of_texts).select(
        "*",
        F.concat("file_company", F.lit("_"), "file_date", F.lit(".csv")).alias("file_name"),
        C("label").alias("name"),
        F.lit("period").alias("context_ref"),
        text.alias("start_date"),
        C("file_date").alias("end_date"),
        text.alias("unit"),
        F.lit("INF").alias("decimals"),
    )


def _scanned(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .filter(C("l_linenumber") == 7)
        .select(
            _pad(C("l_orderkey")).alias("company_number"),
            F.date_format(F.trunc("l_shipdate", "year"), "yyyy-MM-dd").alias("accounts_date"),
            F.lit(0).cast("bigint").alias("number_of_facts"),
        )
        .distinct()
    )


def _loaded(spark, folder):
    rows = _fact_files(spark, folder)
    empty = rows.withColumn("company_number", C("file_company")).select(*FACT_COLUMNS).limit(0)
    return load_facts(
        rows,
        _scanned(spark, folder),
        companies(spark, folder).select("number", "name"),
        empty,
        empty,
        "2024-01-31",
    )


LOADED = """, f AS (SELECT company_number,
                           strftime(date_trunc('year', end_date::DATE), '%Y-%m-%d') AS day, label,
                           CASE WHEN batch = 'O' AND label = 'Name of production software'
                                THEN '(reported)' ELSE value END AS value, seq FROM facts
                    UNION ALL
                    SELECT 'T' || lpad(doc_id::VARCHAR, 7, '0'), '2024-01-01', 'Note in ' || lang,
                           text, doc_id FROM documents),
              scanned AS (SELECT DISTINCT lpad(l_orderkey::VARCHAR, 8, '0') AS company_number,
                                 strftime(date_trunc('year', l_shipdate), '%Y-%m-%d') AS day
                          FROM lineitem WHERE l_linenumber = 7),
              v AS (SELECT company_number, day, label, seq,
                           CASE WHEN TRY_CAST(replace(value, ',', '') AS DOUBLE) IS NULL THEN value
                                ELSE replace(value, ',', '') END AS value,
                           length(value) + length(label) < 2000 AS short
                    FROM f WHERE value NOT IN ('', '(reported)')
                     AND NOT EXISTS (SELECT 1 FROM scanned s
                                     WHERE s.company_number = f.company_number AND s.day = f.day)),
              u AS (SELECT company_number, day, label, value, short, MIN(seq) AS seq
                    FROM v GROUP BY ALL)"""


@query(
    "jb03_load_facts",
    with_sql(
        "facts",
        LOADED
        + """, n AS (SELECT *, TRY_CAST(value AS DECIMAL(38,6)) AS number FROM u WHERE short),
               r AS (SELECT *, row_number() OVER k AS nth, first_value(number) OVER k AS one,
                            row_number() OVER (PARTITION BY company_number, day, label
                                               ORDER BY abs(number) DESC NULLS LAST, seq) AS big
                     FROM n WINDOW k AS (PARTITION BY company_number, day, label ORDER BY seq))
             SELECT company_number, COUNT(*) AS n, MIN(value) AS low, MAX(value) AS high
             FROM r WHERE (one IS NULL AND nth = 1) OR (one IS NOT NULL AND big = 1)
             GROUP BY company_number""",
    ),
)
def jb03(spark, folder):
    rows = _loaded(spark, folder)["facts"]
    return rows.groupBy("company_number").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )


@query(
    "jb03b_load_audit",
    with_sql(
        "facts",
        LOADED
        + """ SELECT company_number, day AS accounts_date,
                     COUNT(*) FILTER (WHERE short) AS number_of_facts,
                     COUNT(*) FILTER (WHERE NOT short) AS number_of_long_facts
              FROM u GROUP BY ALL
              UNION ALL SELECT company_number, day, 0, NULL FROM scanned""",
    ),
)
def jb03b(spark, folder):
    return _loaded(spark, folder)["scanned"].drop("errors")


@query(
    "jb03c_long_facts_and_parents",
    with_sql(
        "facts companies",
        LOADED
        + """ SELECT 'long facts' AS stored, COUNT(*) AS n FROM u WHERE NOT short
              UNION ALL
              SELECT 'companies', COUNT(*) FROM (SELECT number FROM companies UNION
                                                 SELECT company_number FROM u) AS c""",
    ),
)
def jb03c(spark, folder):
    out = _loaded(spark, folder)
    return (
        out["long_facts"]
        .select(F.lit("long facts").alias("stored"))
        .unionByName(out["companies"].select(F.lit("companies").alias("stored")))
        .groupBy("stored")
        .agg(F.count("*").alias("n"))
    )


def _streamed(spark, folder):
    """Tables of ``load_fact_stream`` after three deliveries of fact files, one per supplier and year, which land in bundles.
    The second one brings files of the first again, with other values."""
    year = F.trunc("l_shipdate", "year")
    old = {v: k for k, v in FACT_HEADERS.items()}
    text = F.lit(None).cast("string")
    lines = table(spark, folder, "lineitem").select(
        _pad(C("l_suppkey")).alias("company_number"),
        C("l_linestatus").alias("name"),
        F.concat(F.lit("Line status "), "l_linestatus").alias("label"),
        C("l_returnflag").alias("context_ref"),
        (C("l_partkey") * 10 + C("l_linenumber")).alias("number"),
        text.alias("start_date"),
        year.cast("string").alias("end_date"),
        text.alias("unit"),
        F.lit("INF").alias("decimals"),
        (F.year("l_shipdate") % 3).alias("delivery"),
    )
    again = lines.filter((C("delivery") == 0) & (C("company_number").cast("int") % 2 == 0))
    again = again.withColumns({"delivery": F.lit(1), "number": C("number") * 1000})
    lines = lines.unionByName(again).withColumn("value", F.format_number("number", 0))
    landing, target = shared_folder(spark, "fact-landing"), shared_folder(spark, "fact-tables")
    parts, _ = line_parts(spark, folder)
    for n in range(3):
        part = lines.filter(C("delivery") == n).select(
            F.concat("company_number", F.lit("_"), "end_date", F.lit(".csv")).alias(FACT_BUNDLE_HEADER),
            *[C(c).alias(header) for c, header in old.items()],
        )
        # a fact file is in one bundle as a whole
        part = part.repartition(-(-parts // 2) or 1, FACT_BUNDLE_HEADER).write.option("compression", "gzip")
        part.option("header", True).option("escape", '"').csv(f"{landing}/delivery-{n}")
        out = load_fact_stream(spark, f"{landing}/*", target)
    return out


STREAMED = """WITH f AS (SELECT lpad(l_suppkey::VARCHAR, 8, '0') AS company_number, l_linestatus AS name,
                                l_returnflag AS context_ref, l_partkey * 10 + l_linenumber AS number,
                                strftime(date_trunc('year', l_shipdate), '%Y-%m-%d') AS end_date FROM lineitem)"""


@query(
    "jb03d_fact_files_as_a_stream",
    STREAMED
    + """ SELECT company_number, name, context_ref, end_date, MAX(number)::VARCHAR AS value
          FROM f GROUP BY ALL""",
)
def jb03d(spark, folder):
    return _streamed(spark, folder)["facts"].select("company_number", "name", "context_ref", "end_date", "value")


@query(
    "jb03e_audit_of_the_stream",
    STREAMED
    + """ SELECT company_number, end_date AS accounts_date, COUNT(*) AS number_of_facts
          FROM (SELECT DISTINCT * FROM f) AS d GROUP BY ALL""",
)
def jb03e(spark, folder):
    return _streamed(spark, folder)["scanned"].select("company_number", "accounts_date", "number_of_facts")


def _tracked_orders(spark, folder):
    return table(spark, folder, "orders").select(
        _pad(C("o_custkey")).alias("company_number"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("accounts_date"),
        C("o_orderkey").cast("string").alias("id"),
        C("o_orderstatus").alias("status"),
        C("o_orderpriority").alias("priority"),
        bulk_path().alias("path"),
    )


@query(
    "jb04_build_tracker",
    """WITH o AS (SELECT lpad(o_custkey::VARCHAR, 8, '0') AS company_number,
                         strftime(o_orderdate, '%Y-%m-%d') AS accounts_date,
                         strftime(o_orderdate, '%B') AS m, strftime(o_orderdate, '%Y') AS y,
                         o_orderkey::VARCHAR AS id, o_orderstatus AS status,
                         o_orderpriority AS priority FROM orders),
            old AS (SELECT DISTINCT company_number, accounts_date FROM o WHERE status = 'P')
       SELECT company_number, accounts_date, ANY_VALUE(y) AS bulk_year, ANY_VALUE(m) AS bulk_month,
              CASE WHEN (company_number, accounts_date) IN (SELECT * FROM old) THEN NULL
                   ELSE MIN(id) FILTER (WHERE status = 'F') END AS transaction_id,
              bool_or(priority IN ('1-URGENT', '2-HIGH'))
                  AND (company_number, accounts_date) NOT IN (SELECT * FROM old) AS csv_scanned,
              bool_or(priority = '2-HIGH')
                  AND (company_number, accounts_date) NOT IN (SELECT * FROM old) AS in_postgres
       FROM o GROUP BY company_number, accounts_date""",
)
def jb04(spark, folder):
    orders = _tracked_orders(spark, folder)
    keys = ["company_number", "accounts_date"]
    day = C("accounts_date").cast("date")
    tracker = (
        orders.filter(C("status") == "P")
        .select(
            *keys,
            F.lit(False).alias("csv_scanned"),
            F.lit(None).cast("string").alias("transaction_id"),
            F.lit(False).alias("in_postgres"),
            F.date_format(day, "yyyy").alias("bulk_year"),
            F.date_format(day, "MMMM").alias("bulk_month"),
        )
        .distinct()
    )
    filings = orders.filter(C("status") == "F").select(
        "company_number",
        "id",
        F.create_map(F.lit("made_up_date"), "accounts_date").alias("description_values"),
    )
    return build_tracker(
        orders.select("path"),
        tracker,
        filings,
        orders.filter(C("priority") == "1-URGENT").select(*keys),
        orders.filter(C("priority") == "2-HIGH").select(*keys),
    )


def _backfill(spark, folder):
    orders = _tracked_orders(spark, folder)
    text = F.lit(None).cast("string")
    items = orders.select(
        "company_number",
        C("id").alias("transaction_id"),
        C("priority").alias("category"),
        F.when(C("status") == "P", "not-in-the_list").otherwise(C("status")).alias("description"),
        F.create_map(
            F.lit("made_up_date"), C("accounts_date"), F.lit("paperFiled"), C("priority")
        ).alias("description_values"),
        C("accounts_date").alias("date"),
        C("accounts_date").alias("action_date"),
        text.alias("barcode"),
        F.lit("AA").alias("type"),
    )
    declared = table(spark, folder, "customer").select(
        _pad(C("c_custkey")).alias("company_number"), C("c_nationkey").alias("total_count")
    )
    filings = orders.filter(C("priority") == "5-LOW").select(
        "id",
        F.lit("kept").alias("category"),
        F.lit("old").alias("description_code"),
        F.create_map(F.lit("a"), F.lit("b")).alias("description_values"),
        F.lit("old").alias("description"),
        C("accounts_date").alias("filing_date"),
        F.lit(1).cast("bigint").alias("timepoint"),
        C("accounts_date").cast("timestamp").alias("published"),
        text.alias("barcode"),
        text.alias("type"),
        "company_number",
    )
    tracker = orders.select("company_number", "accounts_date", text.alias("transaction_id")).distinct()
    listed = orders.filter(C("status") != "P").select("status").distinct()
    listed = listed.select(
        C("status").alias("key"),
        F.concat(F.lit("**"), "status", F.lit("** made up to {made_up_date}{paperFiled}")).alias("value"),
    )
    return backfill_filings(items, declared, filings, tracker, listed)


@query(
    "jb05_backfill_filings",
    """SELECT o_orderkey::VARCHAR AS id,
              CASE WHEN o_orderpriority = '5-LOW' THEN 'kept' ELSE o_orderpriority END AS category,
              CASE WHEN o_orderstatus = 'P' THEN 'notInTheList'
                   ELSE '**' || o_orderstatus || '** made up to '
                        || strftime(o_orderdate, '%Y-%m-%d') || '{paperFiled}' END AS description,
              o_orderpriority AS paper_filed,
              CASE WHEN o_orderpriority = '5-LOW' THEN 1 END AS timepoint
       FROM orders""",
)
def jb05(spark, folder):
    filings, _, _ = _backfill(spark, folder)
    return filings.select(
        "id",
        "category",
        "description",
        C("description_values")["paper_filed"].alias("paper_filed"),
        C("timepoint").cast("int").alias("timepoint"),
    )


@query(
    "jb05b_backfill_tracker",
    """SELECT lpad(o_custkey::VARCHAR, 8, '0') AS company_number,
              strftime(o_orderdate, '%Y-%m-%d') AS accounts_date,
              MAX(o_orderkey::VARCHAR) AS transaction_id
       FROM orders GROUP BY ALL""",
)
def jb05b(spark, folder):
    return _backfill(spark, folder)[1]


@query(
    "jb05c_incomplete_histories",
    """SELECT lpad(c_custkey::VARCHAR, 8, '0') AS company_number, c_nationkey AS total_count,
              COUNT(o_orderkey) AS found
       FROM customer LEFT JOIN orders ON c_custkey = o_custkey
       GROUP BY c_custkey, c_nationkey HAVING COUNT(o_orderkey) <> c_nationkey""",
)
def jb05c(spark, folder):
    return _backfill(spark, folder)[2]


@query(
    "jb06_account_documents_from_facts",
    """WITH own AS (SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS d,
                           COUNT(*) AS n, list(l_returnflag || l_quantity::INT
                                               ORDER BY l_linenumber, l_partkey) AS facts
                    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
                     AND date_trunc('year', o_orderdate) = date_trunc('year', l_shipdate)
                    GROUP BY ALL)
       SELECT lpad(o_orderkey::VARCHAR, 8, '0') AS company_number, d AS accounts_date,
              'F' || o_orderkey AS id, n AS number_of_facts,
              unnest(range(n)) AS place, unnest(facts) AS fact
       FROM own WHERE n = CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AND o_orderstatus <> 'P'""",
)
def jb06(spark, folder):
    orders = table(spark, folder, "orders").select(
        _pad(C("o_orderkey")).alias("company_number"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("accounts_date"),
        F.when(C("o_orderstatus") == "F", 2).otherwise(1).alias("number_of_facts"),
        # scanned one second after the facts were captured
        (F.date_trunc("year", "o_orderdate") + F.expr("INTERVAL 1 SECOND")).alias("csv_scanned"),
        C("o_orderstatus").alias("status"),
        "o_orderkey",
    )
    lines = table(spark, folder, "lineitem").select(
        _pad(C("l_orderkey")).alias("company_number"),
        (C("l_linenumber").cast("bigint") * 1_000_000_000 + C("l_partkey")).alias("at"),
        C("l_returnflag").alias("label"),
        C("l_quantity").cast("int").cast("string").alias("value"),
        F.lit(None).cast("string").alias("start_date"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("end_date"),
        F.date_trunc("year", "l_shipdate").alias("captured"),
    )
    placed = with_position(lines, "company_number", "at", F.floor(C("at") / 1_000_000_000)).drop("at")
    text = F.lit(None).cast("string")
    filings = orders.filter(C("status") != "P").select(
        "company_number",
        F.concat(F.lit("F"), C("o_orderkey").cast("string")).alias("id"),
        text.alias("description_code"),
        text.alias("description"),
        F.create_map(F.lit("made_up_date"), "accounts_date").alias("description_values"),
        text.alias("filing_date"),
        text.alias("barcode"),
        text.alias("type"),
    )
    built, nested = account_documents_from_facts(orders.drop("status", "o_orderkey"), placed, filings)
    keys = ["company_number", "accounts_date"]
    told = F.concat("label", "value").alias("fact")
    rows = in_order(nested.select(*keys, "position", told), keys, ["position"], "place")
    return built.select(*keys, "id", "number_of_facts").join(rows.drop("position"), keys)


@query(
    "jb07_account_documents_from_json",
    """WITH l AS (SELECT lpad(l_orderkey::VARCHAR, 8, '0') AS company_number, l_linestatus,
                         strftime(l_shipdate, '%Y-%m-%d') AS accounts_date, l_partkey, s_acctbal
                  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
       SELECT company_number, accounts_date,
              'F' || MIN(l_partkey) FILTER (WHERE l_linestatus = 'F') AS id,
              2 * COUNT(*) AS number_of_facts, COUNT(*) AS with_info
       FROM l GROUP BY ALL
       HAVING bool_and(s_acctbal >= 0) AND bool_or(l_linestatus = 'F')""",
)
def jb07(spark, folder):
    files = fact_json_documents(spark, folder).select("file_name", "content")
    built, nested, _ = account_documents_from_json(files, *_dimensions_and_filings(spark, folder))
    return _with_info(built, nested)


def _with_info(built, nested):
    keys = ["company_number", "accounts_date"]
    informed = nested.groupBy(*keys).agg(F.count("additional_info").alias("with_info"))
    return built.select(*keys, "id", "number_of_facts").join(informed, keys)


def _dimensions_and_filings(spark, folder):
    lines = table(spark, folder, "lineitem")
    names = lines.select("l_returnflag").distinct().select(
        C("l_returnflag").alias("key"),
        F.concat(F.lit("x-Flag "), "l_returnflag", F.lit(" [dimension]")).alias("value"),
    )
    solvent = table(spark, folder, "supplier").filter(C("s_acctbal") >= 0)
    members = solvent.select(C("s_suppkey").cast("string").alias("key"), C("s_name").alias("value"))
    text = F.lit(None).cast("string")
    filings = (
        lines.filter(C("l_linestatus") == "F")
        .groupBy(
            _pad(C("l_orderkey")).alias("company_number"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        )
        .agg(F.concat(F.lit("F"), F.min("l_partkey").cast("string")).alias("id"))
        .select(
            "company_number",
            "id",
            text.alias("description_code"),
            text.alias("description"),
            F.create_map(F.lit("made_up_date"), "day").alias("description_values"),
            text.alias("filing_date"),
            text.alias("barcode"),
            text.alias("type"),
        )
    )
    return names.unionByName(members), filings


@query("jb07b_json_files_to_written_documents", SQL["jb07_account_documents_from_json"])
def jb07b(spark, folder):
    """The same from landed files to written documents, in two deliveries of which the second holds all files; those
    done before are skipped."""
    landing, target = shared_folder(spark, "json-landing"), shared_folder(spark, "json-documents")
    dims, filings = _dimensions_and_filings(spark, folder)
    rendered = fact_json_documents(spark, folder)
    kind = "file_name string, content string"
    done = spark.createDataFrame([], "file_name string")
    for n, part in enumerate((rendered.filter(C("l_orderkey") % 2 == 0), rendered)):
        part.select("file_name", "content").write.option("compression", "gzip").json(f"{landing}/{n}")
        files = pending(spark.read.schema(kind).json(f"{landing}/{n}"), done, "file_name")
        built, nested, _ = account_documents_from_json(files, dims, filings)
        for name, rows in (("documents", built), ("facts", nested)):
            year = F.left("accounts_date", F.lit(4)).alias("accounts_year")
            write_documents(rows.select("*", year), f"{target}/{name}/delivery={n}", "accounts_year", "gzip")
        done = done.union(files.select("file_name").distinct())
    read = lambda name, rows: spark.read.schema(rows.schema).json(f"{target}/{name}")
    return _with_info(read("documents", built), read("facts", nested))


@query(
    "jb08_profile_rows",
    with_sql(
        "accounts",
        VALUE_MAPS
        + f""", o AS (SELECT m.document, label,
                     CASE WHEN MAX(CASE WHEN end_date = accounts_date THEN 1 END) = 1
                          THEN MAX(CASE WHEN end_date = accounts_date THEN value END)
                          WHEN COUNT(*) = 1 THEN MAX(value) END AS value
              FROM m JOIN accounts a ON m.document = a.document
              WHERE number_of_facts > 100 GROUP BY ALL)
              SELECT document, {profile_sql()} FROM o GROUP BY document""",
    ),
)
def jb08(spark, folder):
    rows, _, _ = profile_rows(*documents_and_accounts(spark, folder))
    return plain_profile(rows)


@query(
    "jb08c_profiles_added_to_stored_ones",
    f"""WITH p AS ({SQL["jb08_profile_rows"]}),
             s AS (SELECT * REPLACE ('stored' AS company_name) FROM p WHERE document::INT % 2 = 0),
             n AS (SELECT *, row_number() OVER (PARTITION BY company_number ORDER BY document) AS nth FROM p
                   WHERE company_number IS NOT NULL
                     AND company_number NOT IN (SELECT company_number FROM s WHERE company_number IS NOT NULL))
        SELECT * FROM s UNION ALL SELECT * EXCLUDE (nth) FROM n WHERE nth = 1""",
)
def jb08c(spark, folder):
    """Profiles of half of the documents are stored, under another name; known companies stay as they are."""
    given = documents_and_accounts(spark, folder)
    half = profile_rows(given[0], given[1].filter(C("document").cast("int") % 2 == 0))[0]
    stored = half.withColumn("company_name", F.lit("stored"))
    return plain_profile(profile_rows(*given, companies=stored)[0])


@query(
    "jb08b_profile_officers",
    with_sql(
        "accounts",
        f"""SELECT document, value AS officer,
                   row_number() OVER (PARTITION BY document ORDER BY value) - 1 AS position
            FROM (SELECT DISTINCT document, value FROM facts
                  JOIN accounts USING (company_number)
                  WHERE number_of_facts > 100 AND label = '{OFFICER_LABEL}') AS d""",
    ),
)
def jb08b(spark, folder):
    return profile_rows(documents(spark, folder), accounts(spark, folder))[2]


def _wide_sql():
    columns = []
    for column, label, rule in WIDE_ACCOUNTS:
        hit = f"FILTER (WHERE label = '{label}')"
        if rule == "signed":
            columns.append(
                f"CAST(CASE WHEN SUM(number) {hit} > 0 THEN MAX(number) {hit} "
                f"ELSE MIN(number) {hit} END AS DOUBLE) AS {column}"
            )
        else:
            columns.append(f"ARG_MIN(value, seq) {hit} AS {column}")
    return ", ".join(columns)


@query(
    "jb09_wide_accounts",
    with_sql(
        "numbers companies",
        f""", k AS (SELECT DISTINCT company_number, end_date FROM numbers
                    WHERE label = '{REGISTERED_NUMBER_LABEL}' AND value = company_number),
              w AS (SELECT n.company_number, n.end_date, {_wide_sql()}
                    FROM numbers n JOIN k ON n.company_number = k.company_number
                                         AND n.end_date = k.end_date GROUP BY ALL)
            SELECT w.*, c.postcode AS post_code FROM w LEFT JOIN companies c
                   ON w.company_number = c.number""",
    ),
)
def jb09(spark, folder):
    wide = wide_accounts(facts(spark, folder, ["company_number"]), companies(spark, folder))
    return wide.select(
        "company_number",
        "end_date",
        *[
            dbl(c) if rule == "signed" else C(c).cast("string").alias(c)
            for c, _, rule in WIDE_ACCOUNTS
        ],
        "post_code",
    )


@query("jb09f_refreshed_accounts", SQL["jb09_wide_accounts"])
def jb09f(spark, folder):
    """The same out of a stored view that is refreshed after each of three deliveries of facts, of which one comes twice."""
    target = shared_folder(spark, "accounts-view")
    rows = facts(spark, folder, ["company_number"]).withColumn("delivery", F.pmod(C("seq"), F.lit(3)))
    for n in (0, 1, 1, 2):
        refresh_wide_accounts(spark, target, rows.filter(C("delivery") == n), f"delivery {n}")
    wide = read_wide_accounts(spark, target, companies(spark, folder))
    return wide.select(
        "company_number",
        "end_date",
        *[dbl(c) if rule == "signed" else C(c).cast("string").alias(c) for c, _, rule in WIDE_ACCOUNTS],
        "post_code",
    )


@query(
    "jb09d_account_officers",
    with_sql(
        "facts",
        f"""SELECT company_number, end_date, value AS officer,
                   row_number() OVER (PARTITION BY company_number, end_date ORDER BY value) - 1 AS position
            FROM (SELECT DISTINCT company_number, end_date, value FROM facts
                  WHERE label = '{OFFICER_LABEL}' AND (company_number, end_date) IN
                        (SELECT (company_number, end_date) FROM facts
                         WHERE label = '{REGISTERED_NUMBER_LABEL}' AND value = company_number)) AS d""",
    ),
)
def jb09d(spark, folder):
    return account_officers(facts(spark, folder))


COUNTIES = ["NATION_1", "NATION_2", "NATION_3"]
REGIONAL = f""", k AS (SELECT DISTINCT company_number, end_date FROM numbers
                       WHERE label = '{REGISTERED_NUMBER_LABEL}' AND value = company_number
                         AND company_number IN (SELECT number FROM companies
                                                JOIN postcodes USING (postcode)
                                                WHERE postcodes.county IN
                                                      ('NATION_1', 'NATION_2', 'NATION_3'))),
                 r AS (SELECT n.company_number, n.end_date,
                              ARG_MIN(value, seq) FILTER (WHERE label = '{ACCOUNTANTS_LABEL}')
                                  AS accountants,
                              ARG_MIN(value, seq)
                                  FILTER (WHERE label = 'Name of production software')
                                  AS accounting_software,
                              MAX(number) FILTER (WHERE label =
                                  'Average number of employees during the period')::DOUBLE
                                  AS employees
                       FROM numbers n JOIN k ON n.company_number = k.company_number
                                            AND n.end_date = k.end_date GROUP BY ALL)"""


def _regional(spark, folder):
    return regional_accounts(
        facts(spark, folder), companies(spark, folder), postcodes(spark, folder), COUNTIES
    )


@query(
    "jb09b_regional_accounts",
    with_sql("numbers companies postcodes", REGIONAL + " SELECT * FROM r"),
)
def jb09b(spark, folder):
    rows = _regional(spark, folder)
    return rows.withColumn("employees", C("employees").cast("double"))


@query(
    "jb09c_adviser_report",
    with_sql(
        "numbers companies postcodes",
        REGIONAL
        + f""" SELECT accountants AS name,
                      (SELECT COUNT(DISTINCT company_number) FROM numbers f
                       WHERE f.label = '{ACCOUNTANTS_LABEL}' AND f.value = accountants)
                          AS number_of_clients
               FROM r GROUP BY accountants HAVING COUNT(*) > 5""",
    ),
)
def jb09c(spark, folder):
    return adviser_report(_regional(spark, folder), facts(spark, folder))[0]


@query(
    "jb09e_adviser_software",
    with_sql(
        "numbers companies postcodes",
        REGIONAL
        + """ SELECT accountants AS name, accounting_software AS software,
                     row_number() OVER (PARTITION BY accountants ORDER BY accounting_software) - 1 AS position
              FROM r WHERE accounting_software IS NOT NULL AND accountants IN
                   (SELECT accountants FROM r GROUP BY accountants HAVING COUNT(*) > 5)""",
    ),
)
def jb09e(spark, folder):
    return adviser_report(_regional(spark, folder), facts(spark, folder))[1]


@query(
    "jb10_load_officers",
    """SELECT lpad(s_suppkey::VARCHAR, 8, '0') AS company_number,
              CASE s_nationkey WHEN 0 THEN 'Secretary' WHEN 1 THEN 'Director'
                   WHEN 4 THEN 'Non-designated LLP Member' WHEN 5 THEN 'Designated LLP Member'
                   WHEN 11 THEN 'Judicial Factor'
                   WHEN 12 THEN 'Receiver or Manager appointed under the Charities Act'
                   WHEN 13 THEN 'Manager appointed under the CAICE Act'
                   WHEN 17 THEN 'SE Member of Administrative Organ'
                   WHEN 18 THEN 'SE Member of Supervisory Organ'
                   WHEN 19 THEN 'SE Member of Management Organ' END AS appointment_type,
              s_nationkey > 12 AS is_corporate_body,
              CASE WHEN s_nationkey < 5 THEN '20060514' ELSE '20200514' END AS appointment_date,
              CASE WHEN s_nationkey > 20 THEN '20210101' END AS resignation_date,
              'PC' || s_nationkey AS post_code,
              CASE WHEN s_nationkey > 18 THEN '19750321'
                   WHEN s_nationkey > 10 THEN '19750301' END AS birth_date,
              s_nationkey > 18 AS birth_date_is_accurate, s_name AS surname,
              'ENGLAND' AS usual_residential_country
       FROM supplier WHERE s_acctbal > 0""",
)
def jb10(spark, folder):
    path = landed(spark, folder, officer_lines, "officers")
    lines = spark.read.text(path).withColumn("file", F.lit("officers"))
    officers, _, _, _ = load_officers(lines)
    return officers.select(
        "company_number",
        "appointment_type",
        "is_corporate_body",
        "appointment_date",
        "resignation_date",
        "post_code",
        "birth_date",
        "birth_date_is_accurate",
        "surname",
        "usual_residential_country",
    )


@query(
    "jb11_load_company_events",
    with_sql(
        "register_events",
        f"""SELECT number, ARG_MAX(name, timepoint) AS name, ARG_MAX(status, timepoint) AS status,
                   ARG_MIN(origin, timepoint) AS origin, ARG_MIN(date, timepoint) AS date,
                   MAX(timepoint) AS timepoint
            FROM ({COMPANY_FLAT}) AS flat GROUP BY number""",
    ),
)
def jb11(spark, folder):
    landing = landed(spark, folder, _with_broken_lines, "company-events")
    _, state, _ = load_company_events(spark, landing, shared_folder(spark, "company-state"))
    return state.select(
        "number", "name", "status", "origin", C("date").cast("string").alias("date"), "timepoint"
    )


def _with_broken_lines(spark, folder):
    """All events, and those of deletions once more as lines that are not JSON."""
    rows = company_event_json(spark, folder)
    deleted = rows.filter(C("value").contains('"type":"deleted"'))
    return rows.unionByName(deleted.select(F.concat(F.lit("?"), "value").alias("value")))


@query(
    "jb11b_stored_and_unreadable",
    """SELECT 'stored' AS outcome, COUNT(*) AS n FROM events UNION ALL
       SELECT 'unreadable', COUNT(*) FROM events WHERE event_type = 'error'""",
)
def jb11b(spark, folder):
    landing = landed(spark, folder, _with_broken_lines, "company-events")
    events, _, bad = load_company_events(spark, landing, shared_folder(spark, "company-state"))
    outcomes = events.select(F.lit("stored").alias("outcome")).unionByName(
        bad.select(F.lit("unreadable").alias("outcome"))
    )
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    "jb12_load_filing_events",
    """SELECT event_id::VARCHAR AS id, event_id AS timepoint, 'B' || event_id AS barcode,
              strftime(ts, '%Y-%m-%d') AS filing_date
       FROM events WHERE event_type IN ('click', 'view', 'purchase')""",
)
def jb12(spark, folder):
    def twice(spark, folder):
        rows = filing_event_json(spark, folder)
        # repeats, and lines that break off
        return rows.unionByName(rows).unionByName(rows.select(F.substring("value", 1, 30).alias("value")))

    rows, _ = load_filing_events(
        spark,
        landed(spark, folder, twice, "filing-events"),
        shared_folder(spark, "filing-events-stored"),
        kind_templates(spark, folder),
    )
    return rows.select("id", "timepoint", "barcode", "filing_date")


def _series(unit, where):
    return f""", f AS (SELECT date_trunc('{unit}', published) AS b, COUNT(*) AS filing_events
                       FROM filing_events WHERE {where} GROUP BY ALL),
                 c AS (SELECT date_trunc('{unit}', published) AS b, COUNT(*) AS company_events
                       FROM company_events WHERE {where} GROUP BY ALL)"""


@query(
    "jb13_daily_frequency",
    with_sql(
        "filing_events company_events",
        _series("day", "published > TIMESTAMP '2024-01-05'")
        + """ SELECT strftime(b, '%Y-%m-%d') AS date, CAST(dayofweek(b) AS BIGINT) AS day_of_week,
                     filing_events, company_events FROM f FULL JOIN c USING (b)""",
    ),
)
def jb13(spark, folder):
    days = daily_frequency(
        filing_events(spark, folder),
        company_events(spark, folder),
        F.expr("TIMESTAMP_NTZ '2024-01-05'"),
    )
    return days.withColumn("date", C("date").cast("string"))


@query(
    "jb13b_hourly_frequency",
    with_sql(
        "filing_events company_events",
        _series("hour", "published < TIMESTAMP '2024-01-31' - INTERVAL 7 DAY")
        + """ SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS bucket,
                     rpad(strftime(b, '%A'), 9, ' ') AS day_of_week, strftime(b, '%H') AS hour,
                     filing_events, company_events FROM f FULL JOIN c USING (b)""",
    ),
)
def jb13b(spark, folder):
    hours = hourly_frequency(
        filing_events(spark, folder),
        company_events(spark, folder),
        F.expr("TIMESTAMP_NTZ '2024-01-31' - INTERVAL 7 DAYS"),
    )
    return hours.withColumn("bucket", stamp("bucket"))
