"""Scalar functions, each over a whole table."""

from pyspark.sql import functions as F

from ..functions import (
    appointment_type,
    birth_date,
    bold_html,
    bold_title,
    bucket,
    camel_case,
    ch_date,
    change_map,
    changed,
    chunk,
    clean_label,
    clean_number,
    company_type,
    count_char,
    day_name,
    dow0,
    drop_null_fields,
    fill_template,
    hour24,
    hour_of,
    int_or_text,
    json_field,
    map_values_with,
    null_if_empty,
    outer_key,
    pad_number,
    parse_path,
    previous_names,
    repair_century,
    round_half_up,
    safe_cast,
    sic_array,
    snake_keys,
    strip_prefix,
    to_decimal,
    uri_company,
    yes_flag,
)
from ..fixed_values import APPOINTMENT_TYPES, COMPANY_TYPES
from ..operators import explode_sic, flatten_tree
from .adapters import facts, register_events, stamp, table, with_sql
from .registry import query

C = F.col


def _case(codes, column, otherwise):
    whens = "".join(
        f" WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in codes.items()
    )
    return f"CASE {column}{whens} ELSE {otherwise} END"


@query(
    "sf01_ch_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END
              AS d FROM orders""",
)
def sf01(spark, folder):
    text = F.when(C("o_orderstatus") == "P", "").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return table(spark, folder, "orders").select("o_orderkey", ch_date(text).cast("string").alias("d"))


@query("sf02_null_if_empty", "SELECT page_id, nullif(regexp_extract(url, '[?](.*)', 1), '') AS q FROM pages")
def sf02(spark, folder):
    q = null_if_empty(F.regexp_extract("url", "[?](.*)", 1))
    return table(spark, folder, "pages").select("page_id", q.alias("q"))


@query(
    "sf03_pad_number",
    """SELECT o_orderkey, CASE WHEN length(o_orderpriority) < 8 THEN lpad(o_orderpriority, 8, '0')
                               ELSE o_orderpriority END AS padded FROM orders""",
)
def sf03(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", pad_number(C("o_orderpriority")).alias("padded")
    )


@query(
    "sf04_previous_names",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN p_name || '@1999-05-07' ELSE '' END AS names
       FROM part""",
)
def sf04(spark, folder):
    def name(c):
        return F.struct(F.lit("07/05/1999").alias("CONDATE"), c.alias("CompanyName"))

    shown = F.when(C("p_size") > 25, C("p_name")).otherwise("")
    names = previous_names([name(F.lit("")), name(shown), name(F.lit(""))])
    text = F.transform(names, lambda n: F.concat(n["name"], F.lit("@"), n["date"].cast("string")))
    return table(spark, folder, "part").select("p_partkey", F.array_join(text, "|").alias("names"))


def _sic(spark, folder):
    first = F.when(C("p_size") < 10, "None Supplied").otherwise(
        F.concat((C("p_size") + 62000).cast("string"), F.lit(" - Other - works"))
    )
    second = F.when(C("p_size") > 30, F.concat(F.lit("4321"), C("p_brand"))).otherwise("")
    return table(spark, folder, "part").select(
        "p_partkey",
        F.lpad(C("p_partkey").cast("string"), 8, "0").alias("number"),
        first.alias("sic_text_1"),
        second.alias("sic_text_2"),
        F.lit("").alias("sic_text_3"),
        F.lit("99999 - Dormant").alias("sic_text_4"),
    )


@query(
    "sf05_sic_array",
    """SELECT p_partkey, CASE WHEN p_size < 10 THEN ''
                              ELSE (p_size + 62000) || '|'
                                   || CASE WHEN p_size > 30 THEN '4321' || p_brand || '|' ELSE '' END
                                   || '99999' END AS codes FROM part""",
)
def sf05(spark, folder):
    codes = sic_array([C(f"sic_text_{i}") for i in range(1, 5)])
    return _sic(spark, folder).select("p_partkey", F.array_join(codes, "|").alias("codes"))


@query(
    "sf06_explode_sic",
    """SELECT DISTINCT lpad(p_partkey::VARCHAR, 8, '0') AS company_number, unnest(
                  CASE WHEN p_size < 10 THEN ['99999']
                       ELSE [(p_size + 62000)::VARCHAR, '99999'] END) AS sic_code FROM part""",
)
def sf06(spark, folder):
    return explode_sic(_sic(spark, folder))


@query(
    "sf07_fill_template",
    """SELECT p_partkey, '**' || p_brand || '** {other name} of  and {brand}' AS text FROM part""",
)
def sf07(spark, folder):
    # an inserted text that looks like a placeholder must stay as it is
    values = F.create_map(
        F.lit("brand"), C("p_brand"), F.lit("next"), F.lit("{brand}"), F.lit("UPPER"), F.lit("x")
    )
    template = F.lit("**{brand}** {other name} of {missing} and {next}")
    return table(spark, folder, "part").select(
        "p_partkey", fill_template(template, values).alias("text")
    )


@query(
    "sf08_camel_case",
    """SELECT o_orderkey, 'accountsWithType' || upper(o_orderstatus) || lower(split_part(
                  replace(o_orderpriority, ' ', ''), '-', 1)) AS code FROM orders""",
)
def sf08(spark, folder):
    code = F.concat_ws(
        "-",
        F.lit("accounts-with_type"),
        F.concat(C("o_orderstatus"), F.split("o_orderpriority", "-")[0]),
    )
    return table(spark, folder, "orders").select("o_orderkey", camel_case(code).alias("code"))


@query(
    "sf09_bold_html",
    """SELECT p_partkey,
              CASE WHEN p_size > 20 THEN '<b>' || p_type || '</b> of **' || p_brand || '**'
                   ELSE 'of ' || p_brand END AS html,
              CASE WHEN p_size > 20 THEN p_type ELSE p_name END AS title FROM part""",
)
def sf09(spark, folder):
    text = F.when(
        C("p_size") > 20, F.concat(F.lit("**"), "p_type", F.lit("** of **"), "p_brand", F.lit("**"))
    ).otherwise(F.concat(F.lit("of "), "p_brand"))
    html = bold_html(text)
    return table(spark, folder, "part").select(
        "p_partkey", html.alias("html"), bold_title(html, C("p_name")).alias("title")
    )


@query(
    "sf10_uri_company",
    with_sql(
        "register_events",
        """SELECT id, CASE WHEN kind <> 'error' THEN company_number END AS number
           FROM register_events""",
    ),
)
def sf10(spark, folder):
    uri = F.concat(
        F.lit("/company/"),
        F.when(C("kind") == "error", F.lower(F.lit("ABC"))).otherwise(C("company_number")),
        F.lit("/filing-history/"),
        "id",
    )
    return register_events(spark, folder).select("id", uri_company(uri).alias("number"))


@query(
    "sf11_parse_path",
    """SELECT o_orderkey, strftime(o_orderdate, '%B') AS bulk_month,
              strftime(o_orderdate, '%Y') AS bulk_year,
              lpad(o_custkey::VARCHAR, 8, '0') AS company_number,
              strftime(o_orderdate, '%Y-%m-%d') AS accounts_date,
              CASE WHEN o_orderstatus = 'F' THEN 'xml' ELSE 'html' END AS extension
       FROM orders""",
)
def sf11(spark, folder):
    parts = parse_path(bulk_path())
    out = table(spark, folder, "orders").select("o_orderkey", parts.alias("p")).select("o_orderkey", "p.*")
    return out.withColumn("accounts_date", C("accounts_date").cast("string"))


def bulk_path():
    """Path of a bulk accounts file for an order."""
    return F.concat(
        F.lit("/bulk/Accounts_Monthly_Data-"),
        F.date_format("o_orderdate", "MMMMyyyy"),
        F.lit("/Prod223_1234_"),
        F.lpad(C("o_custkey").cast("string"), 8, "0"),
        F.lit("_"),
        F.date_format("o_orderdate", "yyyyMMdd"),
        F.when(C("o_orderstatus") == "F", ".xml").otherwise(".html"),
    )


@query(
    "sf12_clean_number",
    with_sql(
        "facts",
        """SELECT company_number, MIN(v) AS low, MAX(v) AS high, SUM(length(v))::BIGINT AS characters
           FROM (SELECT company_number,
                        CASE WHEN TRY_CAST(replace(value, ',', '') AS DOUBLE) IS NULL THEN value
                             ELSE replace(value, ',', '') END AS v FROM facts) AS c
           GROUP BY company_number""",
    ),
)
def sf12(spark, folder):
    clean = facts(spark, folder).select("company_number", clean_number(C("value")).alias("v"))
    return clean.groupBy("company_number").agg(
        F.min("v").alias("low"),
        F.max("v").alias("high"),
        F.sum(F.length("v")).cast("bigint").alias("characters"),
    )


@query(
    "sf13_to_decimal",
    with_sql(
        "numbers",
        """SELECT company_number, COUNT(number) AS n, SUM(number)::DOUBLE AS total,
                  MAX(number)::DOUBLE AS high
           FROM numbers GROUP BY company_number""",
    ),
)
def sf13(spark, folder):
    numbers = facts(spark, folder).select("company_number", to_decimal(C("value")).alias("number"))
    return numbers.groupBy("company_number").agg(
        F.count("number").alias("n"),
        F.sum("number").cast("double").alias("total"),
        F.max("number").cast("double").alias("high"),
    )


@query(
    "sf14_int_or_text",
    with_sql(
        "facts",
        r"""SELECT company_number,
                   SUM(CASE WHEN regexp_matches(value, '^-?\d+$') THEN value::DOUBLE END) AS total,
                   MAX(CASE WHEN NOT regexp_matches(value, '^-?\d+$') THEN value END) AS high
            FROM facts GROUP BY company_number""",
    ),
)
def sf14(spark, folder):
    number, text = int_or_text(C("value"))
    rows = facts(spark, folder).select("company_number", number.alias("n"), text.alias("t"))
    return rows.groupBy("company_number").agg(
        F.sum("n").cast("double").alias("total"), F.max("t").alias("high")
    )


@query(
    "sf15_bucket",
    """SELECT event_id, """
    + ", ".join(
        f"strftime(date_trunc('{u}', ts), '%Y-%m-%d %H:%M:%S') AS {u}_start"
        for u in ("minute", "hour", "day", "month")
    )
    + " FROM events",
)
def sf15(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        *[stamp(bucket(C("ts"), u), f"{u}_start") for u in ("minute", "hour", "day", "month")],
    )


@query("sf16_dow0", "SELECT event_id, CAST(dayofweek(ts) AS BIGINT) AS dow FROM events")
def sf16(spark, folder):
    return table(spark, folder, "events").select("event_id", dow0(C("ts")).alias("dow"))


@query("sf17_hour_of", "SELECT event_id, CAST(hour(ts) AS BIGINT) AS hour FROM events")
def sf17(spark, folder):
    return table(spark, folder, "events").select("event_id", hour_of(C("ts")).alias("hour"))


@query(
    "sf18_day_name",
    "SELECT event_id, rpad(strftime(ts, '%A'), 9, ' ') AS day, strftime(ts, '%H') AS hour FROM events",
)
def sf18(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", day_name(C("ts")).alias("day"), hour24(C("ts")).alias("hour")
    )


@query(
    "sf19_outer_key",
    """SELECT coalesce(c_custkey, p_partkey) AS key, c_name, p_name
       FROM customer FULL JOIN part ON c_custkey = p_partkey""",
)
def sf19(spark, folder):
    both = table(spark, folder, "customer").join(
        table(spark, folder, "part"), C("c_custkey") == C("p_partkey"), "full_outer"
    )
    return both.select(outer_key(C("c_custkey"), C("p_partkey")).alias("key"), "c_name", "p_name")


@query("sf20_round_half_up", "SELECT event_id, round(value) AS whole, round(value, 1) AS tenth FROM events")
def sf20(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        round_half_up(C("value")).alias("whole"),
        round_half_up(C("value"), 1).alias("tenth"),
    )


@query(
    "sf21_safe_cast",
    with_sql(
        "facts",
        """SELECT company_number, position, TRY_CAST(value AS DATE)::VARCHAR AS d FROM facts
        """,
    ),
)
def sf21(spark, folder):
    return facts(spark, folder).select(
        "company_number", "position", safe_cast(C("value"), "date").cast("string").alias("d")
    )


@query(
    "sf22_changed",
    """SELECT o_orderkey, upper(o_orderpriority) IS DISTINCT FROM upper(nullif(lower(c_mktsegment),
                                                                              'building')) AS text,
              NOT starts_with(upper(o_orderpriority), upper(left(o_orderpriority, 2) || CASE WHEN
                  o_orderstatus = 'F' THEN '' ELSE '~' END)) AS street
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def sf22(spark, folder):
    rows = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), C("o_custkey") == C("c_custkey")
    )
    old = F.concat(
        F.lower(F.substring("o_orderpriority", 1, 2)),
        F.when(C("o_orderstatus") == "F", "").otherwise("~"),
    )
    segment = F.nullif(F.lower("c_mktsegment"), F.lit("building"))
    return rows.select(
        "o_orderkey",
        changed(C("o_orderpriority"), segment).alias("text"),
        changed(C("o_orderpriority"), old, "prefix").alias("street"),
    )


@query(
    "sf23_change_map",
    """SELECT p_partkey, unnest(CASE WHEN p_brand <> p_type THEN ['brand', 'size'] ELSE ['size'] END)
                  AS field,
              unnest(CASE WHEN p_brand <> p_type THEN [p_brand, '-1'] ELSE ['-1'] END) AS new,
              unnest(CASE WHEN p_brand <> p_type THEN [p_type, p_size::VARCHAR]
                          ELSE [p_size::VARCHAR] END) AS old
       FROM part""",
)
def sf23(spark, folder):
    changes = change_map(
        [
            ("name", F.upper("p_name"), C("p_name"), "text"),
            ("brand", C("p_brand"), C("p_type"), "text"),
            ("size", F.lit("-1"), C("p_size").cast("string"), "text"),
        ]
    )
    rows = table(spark, folder, "part").select("p_partkey", F.explode(changes).alias("field", "v"))
    return rows.select("p_partkey", "field", "v.new", "v.old")


TYPE_CODES = list(COMPANY_TYPES)


@query(
    "sf24_company_type",
    f"""SELECT p_partkey, {_case(COMPANY_TYPES, "code", "NULL")} AS text
        FROM (SELECT p_partkey, ([{", ".join(f"'{c}'" for c in TYPE_CODES)}])[p_size] AS code
              FROM part) AS coded""",
)
def sf24(spark, folder):
    code = F.get(F.array(*[F.lit(c) for c in TYPE_CODES]), C("p_size") - 1)
    return table(spark, folder, "part").select("p_partkey", company_type(code).alias("text"))


@query(
    "sf25_appointment_type",
    f"""SELECT c_custkey, {_case(APPOINTMENT_TYPES, "c_nationkey::VARCHAR", "''")} AS text
        FROM customer""",
)
def sf25(spark, folder):
    code = F.lpad(C("c_nationkey").cast("string"), 2, "0")
    return table(spark, folder, "customer").select("c_custkey", appointment_type(code).alias("text"))


@query(
    "sf26_repair_century",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN ''
                               WHEN o_orderstatus = 'F' THEN '20' || strftime(o_orderdate, '%y%m%d')
                               ELSE strftime(o_orderdate, '%Y%m%d') END AS d FROM orders""",
)
def sf26(spark, folder):
    short = F.concat(F.lit("00"), F.date_format("o_orderdate", "yyMMdd"))
    text = (
        F.when(C("o_orderstatus") == "P", " " * 8)
        .when(C("o_orderstatus") == "F", short)
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    return table(spark, folder, "orders").select("o_orderkey", repair_century(text).alias("d"))


@query(
    "sf27_birth_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d')
                               WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y%m') || '01'
                               ELSE '' END AS born, o_orderstatus = 'F' AS accurate
       FROM orders""",
)
def sf27(spark, folder):
    full = F.when(C("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyyMMdd")).otherwise(" " * 8)
    month = F.when(
        C("o_orderstatus") == "O", F.rpad(F.date_format("o_orderdate", "yyyyMM"), 8, " ")
    ).otherwise(" " * 8)
    born, accurate = birth_date(full, month)
    return table(spark, folder, "orders").select(
        "o_orderkey", born.alias("born"), accurate.alias("accurate")
    )


@query("sf28_yes_flag", "SELECT o_orderkey, o_orderstatus = 'F' AS flag FROM orders")
def sf28(spark, folder):
    text = F.when(C("o_orderstatus") == "F", "Y").otherwise(" ")
    return table(spark, folder, "orders").select("o_orderkey", yes_flag(text).alias("flag"))


@query(
    "sf29_count_char",
    """SELECT page_id, CAST(length(html) - length(replace(html, '<', '')) AS BIGINT) AS n
       FROM pages""",
)
def sf29(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", count_char(C("html"), "<").cast("bigint").alias("n")
    )


@query("sf30_json_field", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def sf30(spark, folder):
    return table(spark, folder, "events").select("event_id", json_field(C("props"), "k").alias("k"))


@query(
    "sf31_map_values_with",
    """SELECT p_partkey, unnest(['brand', 'type']) AS key,
              unnest([upper(p_brand), upper(p_type)]) AS value FROM part""",
)
def sf31(spark, folder):
    m = F.create_map(F.lit("brand"), C("p_brand"), F.lit("type"), C("p_type"))
    return table(spark, folder, "part").select(
        "p_partkey", F.explode(map_values_with(m, F.upper)).alias("key", "value")
    )


@query(
    "sf32_snake_keys",
    """SELECT p_partkey, unnest(['made_up_date', 'part_name', 'p_type']) AS key,
              unnest([p_brand, p_name, p_type]) AS value FROM part""",
)
def sf32(spark, folder):
    m = F.create_map(
        F.lit("madeUpDate"), C("p_brand"), F.lit("part-name"), C("p_name"), F.lit("p_type"), C("p_type")
    )
    return table(spark, folder, "part").select(
        "p_partkey", F.explode(snake_keys(m)).alias("key", "value")
    )


@query(
    "sf33_strip_prefix",
    "SELECT page_id, regexp_replace(url, '^.*:', '') AS bare FROM pages",
)
def sf33(spark, folder):
    return table(spark, folder, "pages").select("page_id", strip_prefix(C("url")).alias("bare"))


@query(
    "sf34_clean_label",
    "SELECT p_partkey, CASE WHEN p_size > 10 THEN p_name END AS label FROM part",
)
def sf34(spark, folder):
    text = (
        F.when(C("p_size") > 30, F.concat(F.lit("(via targetRole) x-"), "p_name", F.lit(" [dimension]")))
        .when(C("p_size") > 10, F.concat("p_name", F.lit(" [axis]")))
        .otherwise(C("p_name"))
    )
    return table(spark, folder, "part").select("p_partkey", clean_label(text).alias("label"))


def concept_trees(spark, folder):
    """One tree per part: type -> (brand -> size), name."""

    def node(*pieces):
        return F.concat(F.lit("["), F.concat_ws(",", *pieces), F.lit("]"))

    def concept(prefix, c, *children):
        # the names and labels of the table hold no character that JSON escapes
        head = F.to_json(
            F.struct(
                F.concat(F.lit(prefix + ":"), c.cast("string")).alias("name"),
                F.concat(F.lit("Label "), c.cast("string")).alias("label"),
            )
        )
        return node(F.lit('"concept"'), head, F.lit('{"usable":"false"}'), *children)

    brand = concept("uk-bus", C("p_brand"), concept("uk-geo", C("p_size")))
    role = node(
        F.lit('"linkRole"'),
        F.lit('{"role":"r","definition":"d"}'),
        F.lit("{}"),
        concept("core", C("p_type"), brand, concept("core", C("p_name"))),
        concept("core", C("p_retailprice")),
    )
    return table(spark, folder, "part").select(
        "p_partkey", F.concat(F.lit('{"dimensions":['), role, F.lit("]}")).alias("tree")
    )


@query(
    "sf35_flatten_tree",
    """SELECT p_partkey, unnest([1, 2, 3, 2, 1]) AS level,
              unnest([p_type, p_brand, p_size::VARCHAR, p_name, p_retailprice::VARCHAR]) AS name,
              'Label ' || unnest([p_type, p_brand, p_size::VARCHAR, p_name, p_retailprice::VARCHAR])
                  AS label
       FROM part""",
)
def sf35(spark, folder):
    return flatten_tree(concept_trees(spark, folder), "tree", ["p_partkey"])


@query(
    "sf36_chunk",
    """SELECT doc_id, CAST(i AS BIGINT) AS chunk,
              array_to_string(list_slice(words, 20 * i + 1, 20 * i + 20), ' ') AS words
       FROM (SELECT doc_id, words, unnest(range(0, (len(words) + 19) // 20)) AS i
             FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents) AS w) AS c""",
)
def sf36(spark, folder):
    pieces = chunk(F.split("text", " ", -1), 20)
    return (
        table(spark, folder, "documents")
        .select("doc_id", F.posexplode(pieces).alias("chunk", "words"))
        .select("doc_id", C("chunk").cast("bigint").alias("chunk"), F.array_join("words", " ").alias("words"))
    )


@query(
    "sf37_drop_null_fields",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '{"o_orderkey":' || o_orderkey || '}'
                               ELSE '{"o_orderkey":' || o_orderkey || ',"status":"' || o_orderstatus
                                    || '"}' END AS json
       FROM orders""",
)
def sf37(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status")
    )
    return orders.select("o_orderkey", drop_null_fields(orders).alias("json"))
