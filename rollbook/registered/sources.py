"""Sources and sinks: whole tables are written in a format and read back by the reader."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import FACT_HEADERS, OFFICER_COLUMNS
from ..plans import load_officers, person_rules
from ..session import shared_folder
from ..sources import (
    explode_fact_json,
    key_values,
    parse_fixed_width,
    read_delimited,
    read_fact_csv,
    read_fixed_width,
    read_json_lines,
    read_key_values,
    read_lookup,
    read_mapped_csv,
    read_snapshot_csv,
    reconcile_counts,
    split_quarantine,
    write_delimited,
    write_documents,
)
from .adapters import facts, postcodes, table, templates, with_sql
from .registry import query
from .shapes import officer_lines, snapshot_rows


def write_csv(df, path):
    """Compressed, as landed files are: as plain text they take several times the place of the tables."""
    df.write.option("compression", "gzip").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


@query(
    "sc01_read_snapshot_csv",
    """SELECT c_custkey::VARCHAR AS number, c_name AS name, n_name AS county, r_name AS country,
              'PC' || n_nationkey AS postcode,
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'None Supplied'
                   ELSE (41000 + c_nationkey) || ' - Other work, n.e.c.' END AS sic,
              CASE WHEN c_nationkey <= 20 THEN 'Old ' || c_name END AS previous
       FROM customer JOIN nation ON c_nationkey = n_nationkey
                     JOIN region ON n_regionkey = r_regionkey""",
)
def sc01(spark, folder):
    path = shared_folder(spark, "snapshot")
    write_csv(snapshot_rows(spark, folder), path)
    return read_snapshot_csv(spark, path).select(
        F.col("CompanyNumber").alias("number"),
        F.col("CompanyName").alias("name"),
        F.col("RegAddress.County").alias("county"),
        F.col("RegAddress.Country").alias("country"),
        F.col("RegAddress.PostCode").alias("postcode"),
        F.col("SICCode.SicText_1").alias("sic"),
        F.col("PreviousName_1.CompanyName").alias("previous"),
    )


@query("sc02_read_json_lines", "SELECT conv_id, turn, role, text FROM conversations")
def sc02(spark, folder):
    path = shared_folder(spark, "json")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows.write.json(path)
    return read_json_lines(spark, path, rows.schema)


@query(
    "sc03_read_mapped_csv",
    """SELECT c_custkey::VARCHAR AS number, c_name AS name, c_mktsegment AS category
       FROM customer""",
)
def sc03(spark, folder):
    path = shared_folder(spark, "mapped")
    write_csv(snapshot_rows(spark, folder), path)
    mapping = {"CompanyNumber": "number", "CompanyName": "name", "CompanyCategory": "category"}
    return read_mapped_csv(spark, path, mapping)


@query(
    "sc04_read_delimited",
    """SELECT p_partkey::VARCHAR AS number, '"' || p_name || '", ' || p_brand AS name FROM part""",
)
def sc04(spark, folder):
    path = shared_folder(spark, "delimited")
    rows = table(spark, folder, "part").select(
        F.col("p_partkey").alias("number"),
        F.concat(F.lit('"'), "p_name", F.lit('", '), "p_brand").alias("name"),
    )
    write_delimited(rows, path)
    return read_delimited(spark, path)


@query(
    "sc05_read_lookup",
    with_sql("postcodes", "SELECT postcode, county, built_up_area FROM postcodes"),
)
def sc05(spark, folder):
    path = shared_folder(spark, "lookup")
    rows = postcodes(spark, folder)
    write_csv(rows.unionByName(rows), path)
    return read_lookup(spark, path, rows.schema, "postcode")


def _landed_officers(spark, folder):
    path = shared_folder(spark, "officers")
    officer_lines(spark, folder).write.text(path)
    return path


@query(
    "sc06_read_fixed_width",
    """SELECT lpad(s_suppkey::VARCHAR, 8, '0') AS company_number,
              CASE WHEN s_acctbal < -500 THEN '7' ELSE '2' END AS record_type,
              lpad(s_suppkey::VARCHAR, 12, '1') AS person_number,
              CASE WHEN s_nationkey > 12 THEN 'Y' ELSE ' ' END AS corporate_indicator,
              CASE WHEN s_nationkey < 5 THEN '00060514' ELSE '20200514' END AS appointment_date
       FROM supplier UNION ALL
       SELECT lpad(c_custkey::VARCHAR, 8, '0'), '1', repeat(' ', 12), ' ', '00010020'
       FROM customer""",
)
def sc06(spark, folder):
    rows = read_fixed_width(spark, _landed_officers(spark, folder))
    return rows.select(
        "company_number",
        "record_type",
        "person_number",
        "corporate_indicator",
        "appointment_date",
    )


@query(
    "sc07_reconcile_counts",
    """SELECT n AS records, n AS expected, TRUE AS agrees
       FROM (SELECT (SELECT COUNT(*) FROM supplier) + (SELECT COUNT(*) FROM customer) AS n) AS t""",
)
def sc07(spark, folder):
    lines = spark.read.text(_landed_officers(spark, folder)).withColumn("file", F.lit("officers"))
    return reconcile_counts(lines).drop("file")


@query(
    "sc08_split_quarantine",
    """SELECT CASE WHEN s_acctbal < -500 THEN 'unknown record type'
                   WHEN s_acctbal <= 0 THEN 'wrong number of fields' ELSE 'good' END AS outcome,
              COUNT(*) AS n FROM supplier GROUP BY ALL
       UNION ALL SELECT 'good company', COUNT(*) FROM customer""",
)
def sc08(spark, folder):
    records = parse_fixed_width(officer_lines(spark, folder)).filter(
        ~F.col("line").startswith("DDDDSNAP") & ~F.col("line").startswith("99999999")
    )
    good, bad = split_quarantine(records, person_rules())
    kind = F.when(F.col("record_type") == "1", "good company").otherwise("good")
    outcomes = good.select(kind.alias("outcome")).unionByName(
        bad.select(F.col("error").alias("outcome"))
    )
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n"))


@query(
    "sc09_write_delimited",
    """SELECT lpad(s_suppkey::VARCHAR, 8, '0') AS company_number,
              lpad(s_suppkey::VARCHAR, 12, '1') AS person_number, s_name AS surname,
              CASE WHEN s_nationkey > 12 THEN 'true' ELSE 'false' END AS is_corporate_body,
              s_suppkey || ' ROAD' AS address_line_1
       FROM supplier WHERE s_acctbal > 0""",
)
def sc09(spark, folder):
    lines = officer_lines(spark, folder).withColumn("file", F.lit("officers"))
    officers, _, _, _ = load_officers(lines)
    path = shared_folder(spark, "officers-out")
    write_delimited(officers.select(*OFFICER_COLUMNS), path)
    return read_delimited(spark, path).select(
        "company_number", "person_number", "surname", "is_corporate_body", "address_line_1"
    )


@query(
    "sc10_read_key_values",
    with_sql("templates", "SELECT key, value FROM templates"),
)
def sc10(spark, folder):
    path = shared_folder(spark, "enumeration")
    line = F.concat(
        F.lit("    '"), "key", F.lit("' : \""), "value",
        F.when(F.length("key") > 7, '" # a remark').otherwise('"'),
    )
    templates(spark, folder).select(line.alias("value")).write.text(path)
    return read_key_values(spark, path)


@query(
    "sc10b_first_key_wins",
    """SELECT p_brand AS key, ARG_MIN(p_name, p_partkey) AS value FROM part GROUP BY p_brand""",
)
def sc10b(spark, folder):
    lines = table(spark, folder, "part").select(
        "p_partkey",
        F.concat(F.lit("  "), "p_brand", F.lit(": '"), "p_name", F.lit("'")).alias("value"),
    )
    return key_values(lines, F.col("p_partkey"))


def fact_json_documents(spark, folder):
    """One JSON fact list per line item, with its file name."""

    def item(label, value, *more):
        body = F.to_json(F.struct(F.lit(label).alias("label"), value.alias("value"), *more))
        return F.concat(F.lit('["item",{"name":"core:'), F.lit(label), F.lit('"},'), body, F.lit("]"))

    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    dimensions = F.create_map(
        F.concat(F.lit("uk-bus:"), "l_returnflag"),
        F.concat(F.lit("uk-geo:"), F.col("l_suppkey").cast("string")),
    )
    items = F.array_join(
        F.array(
            item("Quantity", F.col("l_quantity").cast("int").cast("string"), day.alias("endInstant")),
            item(
                "Status",
                F.col("l_linestatus"),
                day.alias("endInstant"),
                F.lit("1990-01-01").alias("start"),
                dimensions.alias("dimensions"),
            ),
        ),
        ",",
    )
    number = F.lpad(F.col("l_orderkey").cast("string"), 8, "0")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey",
        F.concat(number, F.lit("_"), day, F.lit(".json")).alias("file_name"),
        F.concat(F.lit('{"factList":['), items, F.lit("]}")).alias("content"),
    )


@query(
    "sc11_read_fact_json",
    """SELECT lpad(l_orderkey::VARCHAR, 8, '0') AS company_number,
              strftime(l_shipdate, '%Y-%m-%d') AS accounts_date, unnest([0, 1]) AS position,
              unnest(['Quantity', 'Status']) AS label,
              unnest([l_quantity::INT::VARCHAR, l_linestatus]) AS value,
              unnest([NULL, '1990-01-01']) AS start_date,
              unnest([NULL, 'uk-bus:' || l_returnflag || '=uk-geo:' || l_suppkey]) AS dimensions
       FROM lineitem""",
)
def sc11(spark, folder):
    path = shared_folder(spark, "fact-json")
    fact_json_documents(spark, folder).select("file_name", "content").write.option("compression", "gzip").json(path)
    landed = read_json_lines(
        spark,
        path,
        T.StructType(
            [T.StructField("file_name", T.StringType()), T.StructField("content", T.StringType())]
        ),
    )
    pairs = F.transform(
        F.map_entries("dimensions"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return explode_fact_json(landed).select(
        "company_number",
        "accounts_date",
        "position",
        "label",
        "value",
        "start_date",
        F.array_join(pairs, ",").alias("dimensions"),
    )


@query(
    "sc12_read_fact_csv",
    with_sql(
        "facts",
        """SELECT company_number, COUNT(*) AS n,
                  MIN(CASE WHEN label = 'Name of production software'
                           THEN value || chr(10) || 'second, line' ELSE value END) AS low,
                  MAX(label) AS high, COUNT(start_date) AS periods,
                  CAST(SUM(length(label || end_date)
                           + length(CASE WHEN label = 'Name of production software'
                                         THEN value || chr(10) || 'second, line' ELSE value END))
                       AS BIGINT) AS characters
           FROM facts GROUP BY company_number""",
    ),
)
def sc12(spark, folder):
    """Two sets of files, with the columns in opposite orders and line breaks in values."""
    path = shared_folder(spark, "fact-csv")
    back = {v: k for k, v in FACT_HEADERS.items()}
    columns = ["label", "value", "company_number", "start_date", "end_date"]
    broken = F.concat("value", F.lit("\nsecond, line"))
    rows = facts(spark, folder).withColumn(
        "value", F.when(F.col("label") == "Name of production software", broken).otherwise(F.col("value"))
    )
    for name, batch, order in (("one", "O", columns), ("two", "F", columns[::-1])):
        part = rows.filter(F.col("batch") == batch).select(*[F.col(c).alias(back[c]) for c in order])
        write_csv(part, f"{path}/{name}")
    read = read_fact_csv(spark, f"{path}/*")
    return read.groupBy("company_number").agg(
        F.count("*").alias("n"),
        F.min("value").alias("low"),
        F.max("label").alias("high"),
        F.count("start_date").alias("periods"),
        F.sum(F.length(F.concat("label", "end_date")) + F.length("value")).alias("characters"),
    )


@query(
    "sc15_write_documents",
    """SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
              strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS accounts_date FROM orders""",
)
def sc15(spark, folder):
    path = shared_folder(spark, "documents")
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.trunc("o_orderdate", "month").cast("string").alias("accounts_date"),
    )
    write_documents(rows, path, "accounts_date")
    return spark.read.schema(rows.schema).json(path)
