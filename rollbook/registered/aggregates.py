"""Aggregations."""

from pyspark.sql import functions as F

from ..fixed_values import (
    DATED_SUMMARY,
    OFFICER_LABEL,
    PROFILE_DATES,
    PROFILE_LABELS,
    PROFILE_NUMBERS,
    WIDE_ACCOUNTS,
)
from ..functions import to_decimal
from ..operators import (
    count_summary,
    counter,
    dated_summary,
    distinct_values,
    financial_profile,
    first_for,
    frequency,
    groups_over,
    hits_and_keys,
    key_list,
    label_document_frequency,
    largest_absolute,
    load_audit,
    max_for,
    list_values,
    nest_facts,
    only_values,
    non_null_frequency,
    pivot_facts,
    record_totals,
    signed_extreme,
    time_profile,
    value_map,
    with_position,
)
from .adapters import (
    company_events,
    dbl,
    documents,
    documents_and_accounts,
    facts,
    filing_events,
    stamp,
    table,
    with_sql,
)
from .registry import query

KEYS = ["company_number", "end_date"]


def _pivot_sql(spec=WIDE_ACCOUNTS):
    columns = []
    for column, label, rule in spec:
        hit = f"FILTER (WHERE label = '{label}')"
        if rule == "signed":
            columns.append(
                f"CAST(CASE WHEN AVG(number) {hit} > 0 THEN MAX(number) {hit} "
                f"ELSE MIN(number) {hit} END AS DOUBLE) AS {column}"
            )
        else:
            columns.append(f"ARG_MIN(value, seq) {hit} AS {column}")
    return ",\n".join(columns)


@query(
    "ag01_pivot_facts",
    with_sql(
        "numbers",
        f"SELECT company_number, end_date, {_pivot_sql()} FROM numbers GROUP BY ALL",
    ),
)
def ag01(spark, folder):
    wide = pivot_facts(facts(spark, folder), KEYS)
    return wide.select(
        *KEYS,
        *[
            dbl(c) if rule == "signed" else F.col(c).cast("string").alias(c)
            for c, _, rule in WIDE_ACCOUNTS
        ],
    )


@query(
    "ag02_signed_extreme",
    with_sql(
        "numbers",
        """SELECT company_number, label,
                  CAST(CASE WHEN AVG(number) > 0 THEN MAX(number) ELSE MIN(number) END AS DOUBLE)
                      AS extreme
           FROM numbers WHERE number IS NOT NULL GROUP BY ALL""",
    ),
)
def ag02(spark, folder):
    # behind a generator, so that the filter does not read the number a second time
    number = F.inline(F.array(F.struct(to_decimal(F.col("value")).alias("number"))))
    numbers = facts(spark, folder).select("company_number", "label", "value").select("company_number", "label", number)
    return (
        numbers.filter(F.col("number").isNotNull())
        .groupBy("company_number", "label")
        .agg(signed_extreme(F.col("number")).cast("double").alias("extreme"))
    )


@query(
    "ag03_first_for",
    with_sql(
        "facts",
        """SELECT company_number,
                  ARG_MIN(value, seq) FILTER (WHERE label = 'Name of entity accountants')
                      AS accountants,
                  ARG_MIN(value, seq) FILTER (WHERE label = 'Name of production software')
                      AS software
           FROM facts GROUP BY company_number""",
    ),
)
def ag03(spark, folder):
    value, order = F.col("value"), F.col("seq")
    named = F.col("label").isin("Name of entity accountants", "Name of production software")
    rows = facts(spark, folder).select("company_number", "label", "value", "seq")
    return (
        hits_and_keys(rows, ["company_number"], named)
        .groupBy("company_number")
        .agg(
            first_for("Name of entity accountants", value, order).alias("accountants"),
            first_for("Name of production software", value, order).alias("software"),
        )
    )


@query(
    "ag04_distinct_values",
    with_sql(
        "facts",
        f"""SELECT company_number, value AS officer,
                   row_number() OVER (PARTITION BY company_number ORDER BY value) - 1 AS position
            FROM (SELECT DISTINCT company_number, value FROM facts
                  WHERE label = '{OFFICER_LABEL}') AS d""",
    ),
)
def ag04(spark, folder):
    return distinct_values(facts(spark, folder), ["company_number"])


@query(
    "ag05_max_for",
    with_sql(
        "numbers",
        """SELECT company_number, CAST(MAX(number) AS DOUBLE) AS employees FROM numbers
           WHERE label = 'Average number of employees during the period'
           GROUP BY company_number""",
    ),
)
def ag05(spark, folder):
    label = "Average number of employees during the period"
    return (
        facts(spark, folder)
        .filter(F.col("label") == label)
        .groupBy("company_number")
        .agg(max_for(label, to_decimal(F.col("value"))).cast("double").alias("employees"))
    )


@query(
    "ag06_key_list",
    with_sql("facts", "SELECT DISTINCT company_number, end_date FROM facts"),
)
def ag06(spark, folder):
    return key_list(facts(spark, folder), KEYS)


@query(
    "ag07_count_summary",
    with_sql(
        "facts",
        """SELECT COUNT(company_number) AS total, COUNT(DISTINCT company_number) AS unique_keys
           FROM facts""",
    ),
)
def ag07(spark, folder):
    return count_summary(facts(spark, folder), "company_number")


@query(
    "ag08_concat_values",
    """SELECT 'Customer ' || o_custkey AS name, o_orderpriority,
              row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) - 1 AS position
       FROM orders""",
)
def ag08(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "name", F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"))
    )
    return list_values(orders, ["name"], "o_orderpriority", name="o_orderpriority")


@query(
    "ag09_groups_over",
    "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 12",
)
def ag09(spark, folder):
    return groups_over(table(spark, folder, "orders"), "o_custkey", 12)


@query(
    "ag10_frequency",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket, COUNT(*) AS n
       FROM events GROUP BY ALL""",
)
def ag10(spark, folder):
    return frequency(table(spark, folder, "events"), "ts", "hour").select(stamp("bucket"), "n")


@query(
    "ag11_time_profile",
    with_sql(
        "filing_events company_events",
        """, f AS (SELECT date_trunc('hour', published) AS b, COUNT(*) AS filing
                   FROM filing_events GROUP BY ALL),
             c AS (SELECT date_trunc('hour', published) AS b, COUNT(*) AS company
                   FROM company_events GROUP BY ALL)
           SELECT CAST(dayofweek(b) AS BIGINT) AS day_of_week, CAST(hour(b) AS BIGINT) AS hour,
                  ROUND(AVG(filing)) AS avg_filing_events,
                  ROUND(AVG(company)) AS avg_company_events,
                  MAX(filing) AS max_filing_events, MAX(company) AS max_company_events,
                  ROUND(quantile_cont(filing, 0.95)) AS filing_95th,
                  ROUND(quantile_cont(filing, 0.05)) AS filing_5th,
                  ROUND(quantile_cont(company, 0.95)) AS company_95th,
                  ROUND(quantile_cont(company, 0.05)) AS company_5th
           FROM f FULL JOIN c USING (b) GROUP BY ALL""",
    ),
)
def ag11(spark, folder):
    return time_profile(
        filing_events(spark, folder), company_events(spark, folder), "published"
    ).orderBy("day_of_week", "hour")


@query(
    "ag12_non_null_frequency",
    """SELECT strftime(date_trunc('day', p), '%Y-%m-%d %H:%M:%S') AS bucket, COUNT(p) AS n
       FROM (SELECT CASE WHEN event_type <> 'error' THEN ts END AS p FROM events) AS e
       GROUP BY ALL""",
)
def ag12(spark, folder):
    events = table(spark, folder, "events").withColumn(
        "published", F.when(F.col("event_type") != "error", F.col("ts"))
    )
    return non_null_frequency(events, "published", "day").select(stamp("bucket"), "n")


@query(
    "ag13_label_document_frequency",
    with_sql(
        "facts",
        """SELECT CASE WHEN start_date IS NULL THEN 'instant' ELSE 'period' END AS kind, label,
                  COUNT(DISTINCT company_number) AS documents
           FROM facts GROUP BY ALL""",
    ),
)
def ag13(spark, folder):
    return label_document_frequency(documents(spark, folder), "document")


@query(
    "ag14_counter",
    """SELECT p_type, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END)
                           AS DOUBLE) AS n
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type
       ORDER BY n DESC""",
)
def ag14(spark, folder):
    items = table(spark, folder, "lineitem").join(
        table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    amount = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(
        F.col("l_quantity")
    )
    return counter(items, "p_type", amount).select("p_type", dbl("n")).orderBy(F.desc("n"))


VALUE_MAPS = """, m AS (SELECT company_number AS document, label, end_date,
                               ARG_MAX(value, position) AS value
                        FROM facts GROUP BY ALL)"""


@query(
    "ag15_value_map",
    with_sql(
        "facts",
        VALUE_MAPS
        + """ SELECT document, end_date, COUNT(*) AS labels, MIN(value) AS low, MAX(value) AS high
              FROM m GROUP BY ALL""",
    ),
)
def ag15(spark, folder):
    entries = value_map(documents(spark, folder, ["company_number"]), "document")
    return entries.groupBy("document", "end_date").agg(
        F.count("*").alias("labels"), F.min("value").alias("low"), F.max("value").alias("high")
    )


@query(
    "ag16_only_value",
    with_sql(
        "accounts",
        VALUE_MAPS
        + """ SELECT m.document, label,
                     CASE WHEN MAX(CASE WHEN end_date = accounts_date THEN 1 END) = 1
                          THEN MAX(CASE WHEN end_date = accounts_date THEN value END)
                          WHEN COUNT(*) = 1 THEN MAX(value) END AS value
              FROM m JOIN accounts a ON m.document = a.document GROUP BY ALL""",
    ),
)
def ag16(spark, folder):
    return only_values(*documents_and_accounts(spark, folder), "document")


def profile_sql():
    columns = []
    for column, label in PROFILE_LABELS:
        value = f"MAX(value) FILTER (WHERE label = '{label}')"
        if column == "dormant":
            value = f"LOWER({value}) = 'true'"
        elif column in PROFILE_NUMBERS:
            value = f"CAST(TRY_CAST(replace({value}, ',', '') AS DECIMAL(38,6)) AS DOUBLE)"
        columns.append(value)
        columns[-1] += f" AS {column}"
    return ", ".join(columns)


@query(
    "ag17_financial_profile",
    with_sql(
        "accounts",
        VALUE_MAPS
        + f""", o AS (SELECT m.document, label,
                     CASE WHEN MAX(CASE WHEN end_date = accounts_date THEN 1 END) = 1
                          THEN MAX(CASE WHEN end_date = accounts_date THEN value END)
                          WHEN COUNT(*) = 1 THEN MAX(value) END AS value
              FROM m JOIN accounts a ON m.document = a.document GROUP BY ALL)
              SELECT document, {profile_sql()} FROM o GROUP BY document""",
    ),
)
def ag17(spark, folder):
    return plain_profile(financial_profile(*documents_and_accounts(spark, folder)))


def plain_profile(rows):
    """Profile rows with decimals as doubles and dates as texts, the same in both engines."""
    kinds = dict(rows.dtypes)
    plain = {c: "double" for c in PROFILE_NUMBERS} | {c: "string" for c in PROFILE_DATES}
    assert all(kinds[c].startswith("decimal") for c in PROFILE_NUMBERS)
    return rows.withColumns({c: F.col(c).cast(kind) for c, kind in plain.items()})


@query(
    "ag18_nest_facts",
    with_sql(
        "facts",
        """SELECT company_number AS document, COUNT(*) AS number_of_facts,
                  ARG_MIN(label || '=' || value, position) AS first_fact,
                  ARG_MAX(label || '=' || value, position) AS last_fact,
                  CAST(SUM(place * length(label || value)) AS BIGINT) AS checksum
           FROM (SELECT *, row_number() OVER (PARTITION BY company_number ORDER BY position) - 1
                           AS place FROM facts) AS f
           GROUP BY company_number""",
    ),
)
def ag18(spark, folder):
    placed = with_position(
        documents(spark, folder, ["company_number"]).select("document", F.col("position").alias("at"), "label", "value"),
        "document",
        "at",
        F.floor(F.col("at") / 100),
    )
    found, nested = nest_facts(placed, ["document"], fields=["label", "value"])
    told = F.concat("label", F.lit("="), "value")
    summary = nested.groupBy("document").agg(
        F.min_by(told, "position").alias("first_fact"),
        F.max_by(told, "position").alias("last_fact"),
        F.sum(F.col("position") * F.length(F.concat("label", "value"))).alias("checksum"),
    )
    return found.join(summary, "document")


@query(
    "ag19_largest_absolute",
    with_sql(
        "numbers",
        """, r AS (SELECT *, row_number() OVER (PARTITION BY company_number, label
                                                ORDER BY seq) AS n,
                          first_value(number) OVER (PARTITION BY company_number, label
                                                    ORDER BY seq) AS first_number,
                          row_number() OVER (PARTITION BY company_number, label
                                             ORDER BY abs(number) DESC NULLS LAST, seq) AS big
                   FROM numbers)
           SELECT company_number, label,
                  MAX(CASE WHEN first_number IS NULL AND n = 1 THEN value
                           WHEN first_number IS NOT NULL AND big = 1 THEN value END) AS value
           FROM r GROUP BY ALL""",
    ),
)
def ag19(spark, folder):
    rows = facts(spark, folder, ["company_number"]).select("company_number", "label", "value", "seq")
    return largest_absolute(rows, ["company_number", "label"], "value", F.col("seq")).drop("seq")


@query(
    "ag20_load_audit",
    """SELECT source AS file, COUNT(*) FILTER (WHERE length(text) < 2000) AS number_of_facts,
              COUNT(*) FILTER (WHERE length(text) >= 2000) AS number_of_long_facts
       FROM documents GROUP BY source""",
)
def ag20(spark, folder):
    texts = table(spark, folder, "documents").withColumnRenamed("source", "file")
    return load_audit(texts, "file", F.length("text") >= 2000).drop("errors")


@query(
    "ag21_record_totals",
    """SELECT lang AS file, CASE WHEN n_chars > 500 THEN 'company' ELSE 'person' END AS kind,
              COUNT(*) AS n FROM documents GROUP BY ALL""",
)
def ag21(spark, folder):
    kind = F.when(F.col("n_chars") > 500, "company").otherwise("person")
    texts = table(spark, folder, "documents").select(F.col("lang").alias("file"), kind.alias("kind"))
    return record_totals(texts, "file", "kind")


def _summary_sql():
    columns = []
    for column, label, kind in DATED_SUMMARY:
        hit = f"regexp_matches(label, '{label}')" if kind == "pattern" else f"label = '{label}'"
        columns.append(f"ARG_MIN(value, position) FILTER (WHERE {hit}) AS {column}")
    return ", ".join(columns)


@query(
    "ag22_dated_summary",
    with_sql(
        "accounts",
        f"""SELECT f.company_number AS document, {_summary_sql()}
            FROM facts f JOIN accounts a ON f.company_number = a.document
            WHERE f.end_date = a.accounts_date GROUP BY f.company_number""",
    ),
)
def ag22(spark, folder):
    return dated_summary(*documents_and_accounts(spark, folder))
