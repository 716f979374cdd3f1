"""The given tables in the shapes of the register: DataFrames, and the same as SQL.

``with_sql`` puts the SQL of the named shapes in front of a statement.
"""

from pyspark.sql import functions as F

# Fact labels with their text made of a line item. The third entry is the SQL for
# DuckDB where the two dialects differ; the last says whether the fact is a period's.
PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"


def _text(expression):
    return f"CAST({expression} AS STRING)"


FACT_LABELS = [
    ("Balance sheet date", _text("CAST(l_shipdate AS DATE)"), None, False),
    (
        "End date for period covered by report",
        _text("LAST_DAY(CAST(l_shipdate AS DATE))"),
        None,
        True,
    ),
    (
        "Start date for period covered by report",
        _text("CAST(DATE_TRUNC('year', l_shipdate) AS DATE)"),
        None,
        True,
    ),
    ("Entity current legal or registered name", f"'Company ' || {_text('l_orderkey')}", None, True),
    ("Name of entity accountants", f"'Adviser ' || {_text('l_suppkey')}", None, True),
    ("Name of production software", "'Software ' || l_returnflag", None, True),
    (
        "Average number of employees during the period",
        _text("CAST(l_quantity AS INT)"),
        None,
        True,
    ),
    (
        "Current assets",
        "format_number(l_extendedprice, 2)",
        "format('{:,.2f}', l_extendedprice)",
        False,
    ),
    ("Cash at bank and on hand", _text("CAST(l_tax * 10000 AS DECIMAL(18,2))"), None, False),
    ("Debtors", _text("CAST(l_discount * 10000 AS DECIMAL(18,2))"), None, False),
    ("Creditors", _text(f"{PRICE} - 20000"), None, False),
    ("Fixed assets", _text("CAST(l_quantity * 100 AS DECIMAL(18,2))"), None, False),
    ("Net assets (liabilities)", _text(f"{PRICE} - 60000"), None, False),
    ("Total assets less current liabilities", _text(f"{PRICE} + 1000"), None, False),
    ("Equity", _text(f"{PRICE} - 50000"), None, False),
    ("Turnover / revenue", _text("CAST(l_extendedprice * 2 AS DECIMAL(18,2))"), None, True),
    ("Profit (loss)", _text(f"{PRICE} - 90000"), None, True),
    ("Name of entity officer", f"'Officer ' || {_text('l_partkey')}", None, True),
    (
        "UK Companies House registered number",
        f"CASE WHEN l_returnflag = 'R' THEN 'other' ELSE LPAD({_text('l_orderkey')}, 8, '0') END",
        None,
        True,
    ),
    ("Bank borrowings and overdrafts", _text("CAST(l_quantity * 10 AS INT)"), None, False),
    ("Postal Code / Zip", f"'PC' || {_text('l_suppkey')}", None, True),
    (
        "Entity is dormant [true/false]",
        "CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'false' END",
        None,
        True,
    ),
    ("Net current assets (liabilities)", _text(f"{PRICE} - 30000"), None, False),
]

# tells the lines of an order apart: line number, day and price in pence
SEQ = (
    "(CAST(l_linenumber AS BIGINT) * 10000000 + YEAR(l_shipdate) * 1000 + DAYOFYEAR(l_shipdate))"
    " * 100000000 + CAST(ROUND(l_extendedprice * 100) AS BIGINT)"
)

_LABELS = ", ".join(f"'{label}'" for label, *_ in FACT_LABELS)
_VALUES = ", ".join(duck or spark for _, spark, duck, _ in FACT_LABELS)
_PERIODS = ", ".join("TRUE" if period else "FALSE" for *_, period in FACT_LABELS)
_PLACES = ", ".join(str(i) for i in range(len(FACT_LABELS)))

K = "CAST(REGEXP_EXTRACT(props, '([0-9]+)', 1) AS INT)"

SHAPES = {
    "companies": """
        SELECT LPAD(CAST(c_custkey AS STRING), 8, '0') AS number, c_name AS name,
               CAST(c_custkey + 1 AS STRING) || ' High Street' AS streetaddress,
               n_name AS county, r_name AS country, 'PC' || CAST(n_nationkey AS STRING) AS postcode,
               c_mktsegment AS category, 'United Kingdom' AS origin,
               CASE WHEN c_acctbal < 0 THEN 'dormant' ELSE 'active' END AS status
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey""",
    "incoming": """
        SELECT LPAD(CAST(p_partkey AS STRING), 8, '0') AS number, p_name AS name,
               CAST(p_size AS STRING) || ' Mill Lane' AS streetaddress,
               p_brand AS county, 'IMPORT' AS country, 'PC' || CAST(p_size AS STRING) AS postcode,
               p_type AS category, 'Elsewhere' AS origin,
               CASE WHEN p_size > 25 THEN 'active' END AS status
        FROM part""",
    "postcodes": """
        SELECT 'PC' || CAST(n_nationkey AS STRING) AS postcode, n_name AS county,
               r_name AS built_up_area
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "register_events": f"""
        SELECT CAST(event_id AS STRING) AS id, event_id AS timepoint,
               LPAD(CAST(user_id AS STRING), 8, '0') AS company_number, ts AS published,
               event_type AS kind, {K} AS k, value
        FROM events""",
    "filing_events": "SELECT * FROM register_events WHERE kind IN ('click', 'view')",
    "company_events": "SELECT * FROM register_events WHERE kind NOT IN ('click', 'view')",
    "templates": """
        SELECT DISTINCT p_type AS key,
               '**' || p_type || '** by {brand}, size {size}{other} {charge number}' AS value
        FROM part""",
    "facts": f"""
        SELECT LPAD(CAST(l_orderkey AS STRING), 8, '0') AS company_number,
               CAST(CAST(DATE_TRUNC('month', l_shipdate) AS DATE) AS STRING) AS end_date,
               label, value,
               CASE WHEN is_period
                    THEN CAST(CAST(DATE_TRUNC('year', l_shipdate) AS DATE) AS STRING)
               END AS start_date,
               l_linestatus AS batch, seq, seq * 100 + place AS position
        FROM (SELECT l_orderkey, l_shipdate, l_linestatus, {SEQ} AS seq,
                     unnest([{_LABELS}]) AS label, unnest([{_VALUES}]) AS value,
                     unnest([{_PERIODS}]) AS is_period, unnest([{_PLACES}]) AS place
              FROM lineitem) AS stacked""",
    "accounts": """
        SELECT company_number, company_number AS document, MAX(end_date) AS accounts_date,
               COUNT(*) AS number_of_facts
        FROM facts GROUP BY company_number""",
    "numbers": """
        SELECT company_number, end_date, label, seq, value,
               TRY_CAST(REPLACE(TRIM(value), ',', '') AS DECIMAL(38,6)) AS number
        FROM facts""",
}
NEEDS = {
    "filing_events": ["register_events"],
    "company_events": ["register_events"],
    "accounts": ["facts"],
    "numbers": ["facts"],
}


def with_sql(shapes, statement):
    """The statement with the SQL of its shapes in front; it may start with ``, x AS (...)``."""
    wanted = []
    for name in shapes.split():
        for needed in [*NEEDS.get(name, []), name]:
            if needed not in wanted:
                wanted.append(needed)
    head = ",\n".join(f"{name} AS ({SHAPES[name]})" for name in wanted)
    body = statement.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {head},\n{body[len('WITH RECURSIVE'):]}"
    if body.startswith(","):
        return f"WITH {head}{body}"
    return f"WITH {head}\n{body}"


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _view(spark, folder, name, *tables):
    """The shape's SQL run by Spark: table names become DataFrame arguments."""
    sql = SHAPES[name].replace("{", "{{").replace("}", "}}")
    for t in tables:
        for word in ("FROM", "JOIN"):
            sql = sql.replace(f"{word} {t}", f"{word} {{{t}}}")
    return spark.sql(sql, **{t: table(spark, folder, t) for t in tables})


def companies(spark, folder):
    return _view(spark, folder, "companies", "customer", "nation", "region")


def incoming(spark, folder):
    return _view(spark, folder, "incoming", "part")


def postcodes(spark, folder):
    return _view(spark, folder, "postcodes", "nation", "region")


def register_events(spark, folder):
    return _view(spark, folder, "register_events", "events")


def filing_events(spark, folder):
    return register_events(spark, folder).filter(F.col("kind").isin("click", "view"))


def company_events(spark, folder):
    return register_events(spark, folder).filter(~F.col("kind").isin("click", "view"))


def templates(spark, folder):
    return table(spark, folder, "part").select("p_type").distinct().select(
        F.col("p_type").alias("key"),
        F.concat(
            F.lit("**"), "p_type", F.lit("** by {brand}, size {size}{other} {charge number}")
        ).alias("value"),
    )


#: Lines of orders in a task that makes facts of them.
LINES = 50_000


def line_parts(spark, folder, by=()):
    """(number of parts, columns) to deal the lines of orders out by. The columns are ``by``, none if an order has more than ``LINES``
    lines, so that no part gets a large order as a whole."""
    items = table(spark, folder, "lineitem")
    if not by:
        return -(-items.count() // LINES), []
    sizes = items.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    n, most = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    return -(-n // LINES), list(by) if most <= LINES else []


def _lines(spark, folder, parts, by):
    """The lines of orders in parts of about ``LINES``, by the columns ``by``, or lines of an order next to each other.

    A line becomes one fact per label: a task over a whole split of a large file would have to sort gigabytes of facts
    for each aggregate of texts. Without ``by`` an order with many lines is spread by their dates.
    """
    lines = table(spark, folder, "lineitem").selectExpr(
        "*",
        "LPAD(CAST(l_orderkey AS STRING), 8, '0') AS company_number",
        "CAST(CAST(DATE_TRUNC('month', l_shipdate) AS DATE) AS STRING) AS end_date",
        "CAST(CAST(DATE_TRUNC('year', l_shipdate) AS DATE) AS STRING) AS year_start",
    )
    if by:
        return lines.repartition(max(1, parts), *by)
    return lines.repartitionByRange(parts, "l_orderkey", "l_shipdate", "l_partkey") if parts > 1 else lines


def facts(spark, folder, by=(), parts=None):
    """The lines of orders as long account facts, all labels next to each other.

    A line is joined to its labels first and the text of a fact is computed behind that, from the place of its label: facts
    that a query filters out, and columns that it does not read, cost nothing.

    ``by``, ``["company_number"]``, deals the lines out by these columns (see ``line_parts``): grouping the facts by them and others
    then needs no shuffle of the facts, which are 23 times as many. ``parts`` is what ``line_parts`` gave for it, if known.
    """
    lines = _lines(spark, folder, *(parts or line_parts(spark, folder, by))).selectExpr("*", f"{SEQ} AS seq")
    labels = ", ".join(
        f"STRUCT('{label}' AS label, {str(period).upper()} AS is_period, {place} AS place)"
        for place, (label, _, _, period) in enumerate(FACT_LABELS)
    )
    values = " ".join(f"WHEN {place} THEN {expression}" for place, (_, expression, *_) in enumerate(FACT_LABELS))
    return lines.selectExpr("*", f"INLINE(ARRAY({labels}))").selectExpr(
        "company_number",
        "end_date",
        "label",
        f"CASE place {values} END AS value",
        "CASE WHEN is_period THEN year_start END AS start_date",
        "l_linestatus AS batch",
        "seq",
        "seq * 100 + place AS position",
    )


def accounts(spark, folder):
    """The newest month and the number of facts of each company, from its lines: a date is aggregated by hashing, while the
    greatest of texts would sort all facts."""
    lines = table(spark, folder, "lineitem").selectExpr(
        "LPAD(CAST(l_orderkey AS STRING), 8, '0') AS company_number",
        "CAST(DATE_TRUNC('month', l_shipdate) AS DATE) AS month",
    )
    found = lines.groupBy("company_number").agg(F.max("month").alias("month"), F.count("*").alias("n"))
    return found.select(
        "company_number",
        F.col("month").cast("string").alias("accounts_date"),
        (F.col("n") * len(FACT_LABELS)).alias("number_of_facts"),
        F.col("company_number").alias("document"),
    )


def documents(spark, folder, by=(), parts=None):
    """Facts with the company as their document."""
    return facts(spark, folder, by, parts).withColumn("document", F.col("company_number"))


def documents_and_accounts(spark, folder):
    """``documents`` and ``accounts``, dealt out by company alike, so that joining them shuffles no facts (see ``facts``)."""
    n, by = parts = line_parts(spark, folder, ["company_number"])
    own = accounts(spark, folder)
    return documents(spark, folder, parts=parts), own.repartition(max(1, n), "document") if by else own


def big(name, alias=None):
    return F.col(name).cast("bigint").alias(alias or name)


def dbl(name, alias=None):
    return F.col(name).cast("double").alias(alias or name)


def stamp(name, alias=None):
    """A point in time as text, the same in both engines."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(alias or name)
