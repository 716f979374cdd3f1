"""The given tables rendered as the files and messages that the readers expect."""

from pyspark.sql import functions as F

from ..fixed_values import COMPANY_TYPES
from .adapters import register_events, table


def snapshot_rows(spark, folder):
    """Customers as rows of the 55-column company snapshot, with its dotted headers."""
    base = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    text = F.col("c_custkey").cast("string")
    nation = F.col("c_nationkey").cast("string")
    blank = F.lit("")
    solvent = F.col("c_acctbal") >= 0

    def old_name(word, below):
        return F.when(F.col("c_nationkey") <= below, F.concat(F.lit(word), "c_name")).otherwise("")

    columns = {
        "CompanyName": F.col("c_name"),
        " CompanyNumber": text,
        "RegAddress.CareOf": blank,
        "RegAddress.POBox": blank,
        "RegAddress.AddressLine1": F.concat(
            (F.col("c_custkey") + 1).cast("string"), F.lit(" High Street")
        ),
        " RegAddress.AddressLine2": blank,
        "RegAddress.PostTown": F.concat(F.lit("Town "), nation),
        "RegAddress.County": F.col("n_name"),
        "RegAddress.Country": F.col("r_name"),
        "RegAddress.PostCode": F.concat(F.lit("PC"), nation),
        "CompanyCategory": F.col("c_mktsegment"),
        "CompanyStatus": F.when(solvent, "active").otherwise("dormant"),
        "CountryOfOrigin": F.lit("United Kingdom"),
        "DissolutionDate": blank,
        "IncorporationDate": F.concat(
            F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), F.lit("/05/1999")
        ),
        "Accounts.AccountRefDay": F.lit("31"),
        "Accounts.AccountRefMonth": F.lit("3"),
        "Accounts.NextDueDate": F.lit("31/12/2022"),
        "Accounts.LastMadeUpDate": F.lit("31/03/2021"),
        "Accounts.AccountCategory": F.when(
            F.col("c_mktsegment") == "MACHINERY", "NO ACCOUNTS FILED"
        ).otherwise(F.col("c_mktsegment")),
        "Returns.NextDueDate": F.when(F.col("c_nationkey") > 12, "01/02/2017").otherwise(""),
        "Returns.LastMadeUpDate": blank,
        "Mortgages.NumMortCharges": F.when(solvent, nation).otherwise("0"),
        "Mortgages.NumMortOutstanding": F.lit("0"),
        "Mortgages.NumMortPartSatisfied": F.lit("0"),
        "Mortgages.NumMortSatisfied": F.lit("0"),
        "SICCode.SicText_1": F.when(
            F.col("c_mktsegment") == "BUILDING", "None Supplied"
        ).otherwise(
            F.concat(
                (F.col("c_nationkey") + 41000).cast("string"), F.lit(" - Other work, n.e.c.")
            )
        ),
        "SICCode.SicText_2": blank,
        "SICCode.SicText_3": blank,
        "SICCode.SicText_4": blank,
        "LimitedPartnerships.NumGenPartners": F.lit("0"),
        "LimitedPartnerships.NumLimPartners": nation,
        "URI": F.concat(F.lit("http://example.org/"), text),
    }
    for i in range(1, 11):
        named = {1: old_name("Old ", 20), 2: old_name("Older ", 10)}.get(i, blank)
        columns[f"PreviousName_{i}.CONDATE"] = F.when(named != "", "03/04/2001").otherwise("")
        columns[f" PreviousName_{i}.CompanyName"] = named
    columns["ConfStmtNextDueDate"] = F.when(~solvent, "31/01/2022").otherwise("")
    columns[" ConfStmtLastMadeUpDate"] = blank
    return base.select(*[c.alias(name) for name, c in columns.items()])


# What the envelopes below say, as SQL over register_events.
COMPANY_FLAT = f"""
    SELECT id, 'Company ' || company_number || CASE WHEN value > 50 THEN ' LTD' ELSE ' ltd' END
               AS name,
           company_number AS number,
           CASE WHEN kind = 'error' THEN ''
                ELSE CAST(k // 10 AS STRING) || ' High Street'
                     || CASE WHEN value > 80 THEN ', Floor 1' ELSE '' END END AS streetaddress,
           CASE WHEN kind = 'view' THEN '' ELSE 'County ' || CAST(k // 50 AS STRING) END AS county,
           'United Kingdom' AS country, 'PC' || CAST(k // 25 AS STRING) AS postcode,
           CASE kind WHEN 'click' THEN '{COMPANY_TYPES["ltd"]}'
                     WHEN 'view' THEN '{COMPANY_TYPES["plc"]}'
                     WHEN 'purchase' THEN '{COMPANY_TYPES["llp"]}' END AS category,
           CASE WHEN kind = 'purchase' THEN 'FRANCE' ELSE 'United Kingdom' END AS origin,
           CASE WHEN k > 60 THEN 'active' ELSE 'dissolved' END AS status,
           CAST(CAST(published AS DATE) AS STRING) AS date, published, timepoint
    FROM register_events"""


def company_event_json(spark, folder, ev=None):
    """Events as JSON texts of company envelopes (column ``value``)."""
    ev = register_events(spark, folder) if ev is None else ev
    kind, k = F.col("kind"), F.col("k")
    no_text = F.lit(None).cast("string")
    address = F.struct(
        F.when(
            kind != "error",
            F.concat(
                F.floor(k / 10).cast("string"),
                F.lit(" High Street"),
                F.when(F.col("value") > 80, ", Floor 1").otherwise(""),
            ),
        ).alias("address_line_1"),
        F.when(
            kind != "view", F.concat(F.lit("County "), F.floor(k / 50).cast("string"))
        ).alias("region"),
        F.lit("United Kingdom").alias("country"),
        F.concat(F.lit("PC"), F.floor(k / 25).cast("string")).alias("postal_code"),
    )
    foreign = F.when(
        kind == "purchase", F.struct(F.struct(F.lit("FRANCE").alias("country")).alias("originating_registry"))
    )
    code = (
        F.when(kind == "click", "ltd")
        .when(kind == "view", "plc")
        .when(kind == "purchase", "llp")
        .when(kind == "signup", "unheard-of")
        .otherwise(no_text)
    )
    data = F.struct(
        F.concat(
            F.lit("Company "),
            F.col("company_number"),
            F.when(F.col("value") > 50, " LTD").otherwise(" ltd"),
        ).alias("company_name"),
        F.col("company_number"),
        F.when(k > 60, "active").otherwise("dissolved").alias("company_status"),
        code.alias("type"),
        address.alias("registered_office_address"),
        foreign.alias("foreign_company_details"),
        F.col("published").cast("date").cast("string").alias("date_of_creation"),
        F.col("id").alias("etag"),
    )
    return ev.select(
        F.to_json(
            F.struct(
                F.lit("company-profile").alias("resource_kind"),
                F.col("id").alias("resource_id"),
                F.concat(F.lit("/company/"), "company_number").alias("resource_uri"),
                data.alias("data"),
                F.struct(
                    F.col("timepoint"),
                    F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"),
                    F.when(kind == "error", "deleted").otherwise("changed").alias("type"),
                ).alias("event"),
            )
        ).alias("value")
    )


def filing_event_json(spark, folder):
    """Events as JSON texts of filing envelopes (column ``value``).

    Codes are the event kinds; the template list of ``kind_templates`` lacks two of them.
    """
    ev = register_events(spark, folder)
    data = F.struct(
        F.concat(F.lit("B"), "id").alias("barcode"),
        F.lit("accounts").alias("category"),
        F.col("published").cast("date").cast("string").alias("date"),
        F.when(F.col("kind") == "error", "legacy").otherwise(F.col("kind")).alias("description"),
        F.create_map(
            F.lit("made_up_date"),
            F.col("published").cast("date").cast("string"),
            F.lit("amount"),
            F.col("k").cast("string"),
        ).alias("description_values"),
        F.lit("AA").alias("type"),
    )
    return ev.select(
        F.to_json(
            F.struct(
                F.lit("filing-history").alias("resource_kind"),
                F.col("id").alias("resource_id"),
                F.concat(
                    F.lit("/company/"), "company_number", F.lit("/filing-history/"), "id"
                ).alias("resource_uri"),
                data.alias("data"),
                F.struct(
                    F.col("timepoint"),
                    F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"),
                    F.lit("changed").alias("type"),
                ).alias("event"),
            )
        ).alias("value")
    )


def kind_templates(spark, folder):
    """Templates for three of the five event kinds."""
    return (
        register_events(spark, folder)
        .filter(F.col("kind").isin("click", "view", "purchase"))
        .select("kind")
        .distinct()
        .select(
            F.col("kind").alias("key"),
            F.concat(
                F.lit("**"), "kind", F.lit("** of {amount} made up to {made_up_date}{nothing}")
            ).alias("value"),
        )
    )


def officer_lines(spark, folder):
    """Suppliers as officer person records, customers as company records, with their totals.

    A negative balance makes a broken record: too few fields, or an unknown record type.
    """
    text = F.col("s_suppkey").cast("string")
    kind = F.when(F.col("s_acctbal") < -500, "7").otherwise("2")
    names = F.array_join(
        F.array(
            F.lit("MR"), F.concat(F.lit("FORE "), text), F.col("s_name"), *[F.lit("")] * 3,
            F.concat(text, F.lit(" ROAD")), *[F.lit("")] * 4, F.lit("DIRECTOR"), F.lit("BRITISH"),
            F.when(F.col("s_acctbal").between(-500, 0), "").otherwise("ENGLAND<"),
        ),
        "<",
    )
    persons = table(spark, folder, "supplier").select(
        F.concat(
            F.lpad(text, 8, "0"),
            kind,
            F.lit("3"),
            F.lpad(F.col("s_nationkey").cast("string"), 2, "0"),
            F.lpad(text, 12, "1"),
            F.when(F.col("s_nationkey") > 12, "Y").otherwise(" "),
            F.lit(" " * 7),
            F.when(F.col("s_nationkey") < 5, "00060514").otherwise("20200514"),
            F.when(F.col("s_nationkey") > 20, "20210101").otherwise(" " * 8),
            F.rpad(F.concat(F.lit("PC"), F.col("s_nationkey").cast("string")), 8, " "),
            F.when(F.col("s_nationkey") > 10, "197503  ").otherwise(" " * 8),
            F.when(F.col("s_nationkey") > 18, "19750321").otherwise(" " * 8),
            F.lpad(F.length(names).cast("string"), 4, "0"),
            names,
        ).alias("value")
    )
    firms = table(spark, folder, "customer").select(
        F.concat(
            F.lpad(F.col("c_custkey").cast("string"), 8, "0"),
            F.lit("1"),
            F.lit(" " * 23),
            F.lit("00010020"),
            F.col("c_name"),
        ).alias("value")
    )
    records = persons.unionByName(firms)
    tail = records.agg(
        F.concat(F.lit("99999999"), F.lpad(F.count("*").cast("string"), 8, "0")).alias("value")
    )
    head = tail.select(F.lit("DDDDSNAP289820210421").alias("value"))
    return records.unionByName(tail).unionByName(head)

