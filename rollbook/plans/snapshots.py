"""Company snapshot to company documents, and to the companies table with its code bridge."""

from pyspark.sql import functions as F

from ..fixed_values import NO_ACCOUNTS, SIC_HEADERS, SNAPSHOT_HEADERS
from ..functions import (
    ch_date,
    null_if_empty,
    optional_struct,
    pad_number,
    previous_names,
    safe_cast,
    sic_array,
)
from ..operators import drop_exact, explode_sic, insert_new, replace_documents
from ..sources import read_mapped_csv, read_snapshot_csv


def _filled(*names):
    """Does any of the text columns hold something?"""
    return F.length(F.concat(*[F.coalesce(F.col(n), F.lit("")) for n in names])) > 0


def _count(name):
    return F.coalesce(safe_cast(F.col(name), "int"), F.lit(0))


def company_document(raw, keep=()):
    """One nested document per row of the snapshot (nested text columns), with the columns ``keep``."""
    number = pad_number(F.col("CompanyNumber"))
    mortgages = {
        "mortgageCharges": _count("Mortgages.NumMortCharges"),
        "mortgagesOutstanding": _count("Mortgages.NumMortOutstanding"),
        "mortgagesPartSatisfied": _count("Mortgages.NumMortPartSatisfied"),
        "mortgagesSatisfied": _count("Mortgages.NumMortSatisfied"),
    }
    address = {
        "addressLine1": F.col("RegAddress.AddressLine1"),
        "addressLine2": null_if_empty(F.col("RegAddress.AddressLine2")),
        "careOf": null_if_empty(F.col("RegAddress.CareOf")),
        "poBox": null_if_empty(F.col("RegAddress.POBox")),
        "country": null_if_empty(F.col("RegAddress.Country")),
        "county": null_if_empty(F.col("RegAddress.County")),
        "postCode": F.col("RegAddress.PostCode"),
        "postTown": null_if_empty(F.col("RegAddress.PostTown")),
    }
    statement = ("ConfStmtLastMadeUpDate", "ConfStmtNextDueDate")
    returns = ("Returns.LastMadeUpDate", "Returns.NextDueDate")
    return raw.select(
        *keep,
        number.alias("_key"),
        number.alias("companyNumber"),
        F.col("CompanyName").alias("name"),
        F.col("CompanyCategory").alias("companyCategory"),
        F.col("CompanyStatus").alias("companyStatus"),
        F.col("CountryOfOrigin").alias("countryOfOrigin"),
        ch_date(F.col("IncorporationDate")).alias("incorporationDate"),
        ch_date(F.col("DissolutionDate")).alias("dissolutionDate"),
        F.struct(*[c.alias(n) for n, c in address.items()]).alias("address"),
        optional_struct(
            ~F.col("Accounts.AccountCategory").eqNullSafe(F.lit(NO_ACCOUNTS)),
            accountCategory=F.col("Accounts.AccountCategory"),
            accountingReference=F.struct(
                F.col("Accounts.AccountRefDay").alias("day"),
                F.col("Accounts.AccountRefMonth").alias("month"),
            ),
            lastMadeUpTo=ch_date(F.col("Accounts.LastMadeUpDate")),
            nextDueDate=ch_date(F.col("Accounts.NextDueDate")),
        ).alias("accounts"),
        optional_struct(
            _filled(*statement),
            lastMadeUpTo=ch_date(F.col(statement[0])),
            nextDueDate=ch_date(F.col(statement[1])),
        ).alias("confirmationStatement"),
        optional_struct(
            _filled(*returns),
            lastMadeUpTo=ch_date(F.col(returns[0])),
            nextDueDate=ch_date(F.col(returns[1])),
        ).alias("returns"),
        optional_struct(sum(mortgages.values(), F.lit(0)) > 0, **mortgages).alias("mortgages"),
        F.struct(
            _count("LimitedPartnerships.NumGenPartners").alias("generalPartners"),
            _count("LimitedPartnerships.NumLimPartners").alias("limitedPartners"),
        ).alias("limitedPartnerships"),
        previous_names([F.col(f"PreviousName_{i}") for i in range(1, 11)]).alias("previousNames"),
        sic_array([F.col(f"SICCode.SicText_{i}") for i in range(1, 5)]).alias("sicCodes"),
    )


def warehouse_company(raw):
    """The snapshot columns of the warehouse companies table."""
    doc = company_document(raw)
    return doc.select(
        F.current_timestamp().alias("last_updated"),
        F.col("name").alias("company_name"),
        F.col("companyNumber").alias("company_number"),
        F.col("address.postCode").alias("postcode"),
        F.col("address.addressLine1").alias("address_line_1"),
        F.col("companyCategory").alias("category"),
        F.col("companyStatus").alias("status"),
        F.col("countryOfOrigin").alias("origin_country"),
        F.col("incorporationDate").alias("incorporation_date"),
        F.col("dissolutionDate").alias("dissolution_date"),
        F.transform("previousNames", lambda p: p["name"]).alias("previous_names"),
        F.col("accounts.accountCategory").alias("accounts_category"),
        safe_cast(F.col("accounts.accountingReference.day"), "smallint").alias("accounts_ref_day"),
        safe_cast(F.col("accounts.accountingReference.month"), "smallint").alias(
            "accounts_ref_month"
        ),
        F.col("accounts.nextDueDate").alias("accounts_next_due"),
        F.col("accounts.lastMadeUpTo").alias("accounts_last_made_up"),
        F.col("returns.nextDueDate").alias("returns_next_due"),
        F.col("returns.lastMadeUpTo").alias("returns_last_made_up"),
        F.col("confirmationStatement.nextDueDate").alias("confirmation_statement_next_due"),
        F.col("confirmationStatement.lastMadeUpTo").alias("confirmation_statement_last_made_up"),
        F.col("sicCodes").alias("sic_codes"),
        F.col("mortgages.mortgageCharges").cast("smallint").alias("mortgages_charges"),
        F.col("mortgages.mortgagesOutstanding").cast("smallint").alias("mortgages_outstanding"),
        F.col("mortgages.mortgagesPartSatisfied")
        .cast("smallint")
        .alias("mortgages_part_satisfied"),
        F.col("mortgages.mortgagesSatisfied").cast("smallint").alias("mortgages_satisfied"),
        F.col("limitedPartnerships.generalPartners").cast("smallint").alias("gen_partners"),
        F.col("limitedPartnerships.limitedPartners").cast("smallint").alias("limited_partners"),
    )


def company_documents(spark, path, stored=None):
    """Documents of a snapshot; they replace the stored ones with the same key."""
    rows = read_snapshot_csv(spark, path, place="_place")
    # of several rows of a company the first counts
    new = drop_exact(company_document(rows, keep=["_place"]), ["_key"], F.col("_place")).drop("_place")
    return new if stored is None else replace_documents(stored, new, "_key", F.col("_key"))


def sic_codes(spark, path, stored=None):
    """The list of activity codes (code, description) after its CSV file; known codes keep their description."""
    rows = read_mapped_csv(spark, path, SIC_HEADERS, place="_place").filter(F.col("code").isNotNull())
    # of several rows of a code the first counts
    new = drop_exact(rows, ["code"], F.col("_place")).drop("_place")
    return new if stored is None else insert_new(stored, new, "code", F.col("description"))


def companies_and_sic(spark, path, companies=None, sic=None):
    """(companies, activity code bridge) after a snapshot; known companies stay as they are."""
    rows = read_mapped_csv(spark, path, SNAPSHOT_HEADERS, place="_place")
    flat = rows.drop(*[f"sic_text_{i}" for i in range(1, 5)]).withColumn(
        "date", ch_date(F.col("date"))
    )
    codes = explode_sic(rows.drop("_place"))
    # of several rows of a company the first counts
    new_companies = drop_exact(flat, ["number"], F.col("_place")).drop("_place")
    return (
        new_companies if companies is None else insert_new(companies, new_companies, "number", F.col("number")),
        codes if sic is None else insert_new(sic, codes, ["company_number", "sic_code"], F.col("sic_code")),
    )
