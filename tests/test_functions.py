"""Column functions on hand-made values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rollbook import functions as R


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items()) or "x int"
    row = tuple(v for _, v in values.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column.alias("out")).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("07/05/1999", dt.date(1999, 5, 7)),
        ("", None),
        ("  ", None),
        ("1999-05-07", None),
        ("31/02/1999", None),
        (None, None),
    ],
)
def test_ch_date(spark, text, expected):
    assert one(spark, R.ch_date(F.col("c")), c=("string", text)) == expected


@pytest.mark.parametrize(
    "number, expected", [("12", "00000012"), ("FC029410", "FC029410"), ("123456789", "123456789")]
)
def test_pad_number_never_cuts(spark, number, expected):
    assert one(spark, R.pad_number(F.col("c")), c=("string", number)) == expected


@pytest.mark.parametrize(
    "template, values, expected",
    [
        ("no placeholder", {"a": "1"}, "no placeholder"),
        ("{a} and {b}", {"a": "{b}", "b": "2"}, "{b} and 2"),
        ("{a}{missing}", {"a": "1"}, "1"),
        ("{charge number} of {a}", {"a": "1", "charge number": "9"}, "{charge number} of 1"),
        ("director's {a}", None, "director's "),
        ("{a}", {"a": "$1 \\1"}, "$1 \\1"),
    ],
)
def test_fill_template(spark, template, values, expected):
    column = R.fill_template(F.col("t"), F.col("m"))
    assert one(spark, column, t=("string", template), m=("map<string,string>", values)) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("1,234,567", "1234567"),
        (" -4974 ", "-4974"),
        ("12 High Street, Town", "12 High Street, Town"),
        ("0.50", "0.50"),
    ],
)
def test_clean_number(spark, value, expected):
    assert one(spark, R.clean_number(F.col("c")), c=("string", value)) == expected


def test_to_decimal(spark):
    assert one(spark, R.to_decimal(F.col("c")), c=("string", "-4,974")) == Decimal(-4974)
    assert one(spark, R.to_decimal(F.col("c")), c=("string", "n/a")) is None


def test_bold(spark):
    html = R.bold_html(F.col("c"))
    assert one(spark, html, c=("string", "**A** of **B**")) == "<b>A</b> of **B**"
    assert one(spark, html, c=("string", "plain")) == "plain"
    title = R.bold_title(html, F.lit("other"))
    assert one(spark, title, c=("string", "**A** x")) == "A"
    assert one(spark, title, c=("string", "plain")) == "other"


def test_codes(spark):
    assert one(spark, R.company_type(F.col("c")), c=("string", "llp")) == (
        "Limited liability partnership"
    )
    assert one(spark, R.company_type(F.col("c")), c=("string", "nope")) is None
    assert one(spark, R.appointment_type(F.col("c")), c=("string", "04")) == (
        "Non-designated LLP Member"
    )
    assert one(spark, R.appointment_type(F.col("c")), c=("string", "99")) == ""


def test_uri_and_paths(spark):
    assert one(spark, R.uri_company(F.col("c")), c=("string", "/company/SC123456/filing-history/x")) == "SC123456"
    assert one(spark, R.uri_company(F.col("c")), c=("string", "/company/sc1/filing-history/x")) is None
    path = "/d/Accounts_Monthly_Data-March2021/Prod223_2431_01234567_20201231.html"
    assert tuple(one(spark, R.parse_path(F.col("c")), c=("string", path))) == (
        "March", "2021", "01234567", dt.date(2020, 12, 31), "html",
    )
    assert one(spark, R.parse_path(F.col("c"))["company_number"], c=("string", "x.html")) is None


@pytest.mark.parametrize(
    "new, old, mode, expected",
    [
        ("ABC ltd", "abc LTD", "text", False),
        (None, None, "text", False),
        (None, "a", "text", True),
        ("1 High Street, Floor 2", "1 HIGH STREET", "prefix", False),
        ("1 High Street", "1 High Street, Floor 2", "prefix", True),
        ("anything", "", "prefix", False),
    ],
)
def test_changed(spark, new, old, mode, expected):
    column = R.changed(F.col("n"), F.col("o"), mode)
    assert one(spark, column, n=("string", new), o=("string", old)) is expected


def test_dates_of_officers(spark):
    assert one(spark, R.repair_century(F.col("c")), c=("string", "00060514")) == "20060514"
    assert one(spark, R.repair_century(F.col("c")), c=("string", " " * 8)) == ""
    born, exact = R.birth_date(F.col("f"), F.col("p"))
    values = {"f": ("string", " " * 8), "p": ("string", "197503  ")}
    assert one(spark, born, **values) == "19750301"
    assert one(spark, exact, **values) is False


def test_sic_and_names(spark):
    cols = [F.lit("62090 - Other - work"), F.lit(""), F.lit("Dormant"), F.lit(None).cast("string")]
    assert one(spark, R.sic_array(cols)) == ["62090", "Dormant"]
    assert one(spark, R.sic_array([F.lit("None Supplied"), *cols[1:]])) == []
    names = [
        F.struct(F.lit(d).alias("CONDATE"), F.lit(n).alias("CompanyName"))
        for d, n in (("01/02/2003", "OLD"), ("", ""), ("", "OLDER"))
    ]
    assert [tuple(x) for x in one(spark, R.previous_names(names))] == [
        ("OLD", dt.date(2003, 2, 1)),
        ("OLDER", None),
    ]


@pytest.mark.parametrize(
    "values, day, expected",
    [
        ({"2021-05-31": "1", "2020-05-31": "2"}, "2021-05-31", "1"),
        ({"2020-05-31": "2"}, "2021-05-31", "2"),
        ({"2020-05-31": "2", "2019-05-31": "3"}, "2021-05-31", None),
        ({}, "2021-05-31", None),
    ],
)
def test_only_value(spark, values, day, expected):
    column = R.only_value(F.col("m"), F.col("d"))
    assert one(spark, column, m=("map<string,string>", values), d=("string", day)) == expected


def test_chunk_snake_camel(spark):
    assert one(spark, R.chunk(F.col("a"), 2), a=("array<int>", [1, 2, 3])) == [[1, 2], [3]]
    assert one(spark, R.chunk(F.col("a"), 2), a=("array<int>", [])) == []
    m = {"madeUpDate": "1", "made_up": "2", "paper-filed": "3"}
    assert one(spark, R.snake_keys(F.col("m")), m=("map<string,string>", m)) == {
        "made_up_date": "1", "made_up": "2", "paper_filed": "3",
    }
    assert one(spark, R.camel_case(F.col("c")), c=("string", "accounts-with_type x")) == "accountsWithTypeX"
    assert one(spark, R.camel_case(F.col("c")), c=("string", "")) == ""


def test_instant_reads_both_forms(spark):
    expected = dt.datetime(2021, 3, 22, 14, 15, 20)
    assert one(spark, R.instant(F.col("c")).cast("timestamp_ntz"), c=("string", "2021-03-22T14:15:20")) == expected
    assert one(spark, R.instant(F.col("c")).cast("timestamp_ntz"), c=("string", "1616422520000")) == expected


def test_calendar(spark):
    sunday = ("timestamp_ntz", dt.datetime(2024, 1, 7, 5, 30))
    assert one(spark, R.dow0(F.col("t")), t=sunday) == 0
    assert one(spark, R.day_name(F.col("t")), t=sunday) == "Sunday   "
    assert one(spark, R.hour24(F.col("t")), t=sunday) == "05"
    with pytest.raises(ValueError):
        R.bucket(F.col("t"), "century")


def test_clean_label(spark):
    for text, expected in [
        ("(via targetRole) x-Share classes [dimension]", "Share classes"),
        ("Countries and regions [heading]", "Countries and regions"),
        ("no brackets", None),
    ]:
        assert one(spark, R.clean_label(F.col("c")), c=("string", text)) == expected
