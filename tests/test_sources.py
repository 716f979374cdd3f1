"""Readers on files with hand-made, invented content."""

import json
import os

import pytest
from pyspark.sql import functions as F

from rollbook.operators import drop_exact
from rollbook.plans import company_document, load_fact_stream, load_facts, load_officers
from rollbook.plans.accounts import FACT_COLUMNS
from rollbook.schemas import SIC_MAP
from rollbook.sources import (
    latest_snapshot,
    pending,
    read_delimited,
    read_fact_csv,
    read_fact_json,
    read_fixed_width,
    read_key_values,
    read_lookup,
    read_mapped_csv,
    read_snapshot_csv,
    reconcile_counts,
    write_delimited,
    write_documents,
)
from tests.conftest import rows

FACT_HEADER = " Label,Name,contextRef,Value,EntityIdentifier,Start,End/Instant,unitRef,Dec,Extra\n"


@pytest.fixture
def fact_folder(tmp_path):
    folder = tmp_path / "facts"
    folder.mkdir()
    (folder / "00012345_2021-05-31.csv").write_text(
        FACT_HEADER
        + "Equity,core:Equity,c1,2,x,,2021-05-31,GBP,INF,e\n"
        + "Equity,core:Equity,c1,\"-29,951\",x,,2021-05-31,GBP,0,e\n"
        + "Equity,core:Equity,c1,-29949,x,,2021-05-31,GBP,0,e\n"
        + "Equity,core:Equity,c1,-29949,x,,2021-05-31,GBP,0,e\n"
        + "Officer,core:Officer,c1,ANN OTHER,x,2020-06-01,2021-05-31,,,e\n"
        + "Officer,core:Officer,c1,BEN OTHER,x,2020-06-01,2021-05-31,,,e\n"
        + "Empty,core:Empty,c1,,x,,2021-05-31,,,e\n"
        + "Said,core:Said,c1,(reported),x,,2021-05-31,,,e\n"
        + ",core:Nameless,c1,7,x,,2021-05-31,,,e\n"
        + "Long,core:Long,c1," + "y" * 1996 + ",x,,2021-05-31,,,e\n"
        + "Fits,core:Fits,c1," + "y" * 1995 + ",x,,2021-05-31,,,e\n"
    )
    (folder / "00099999_2020-01-01.csv").write_text(
        FACT_HEADER + "Equity,core:Equity,c1,5,x,,2020-01-01,GBP,0,e\n"
    )
    (folder / "badname.csv").write_text(FACT_HEADER + "Equity,core:Equity,c1,5,x,,2020-01-01,GBP,0,e\n")
    return str(folder)


def test_load_facts(spark, fact_folder):
    files = read_fact_csv(spark, fact_folder)
    empty = files.withColumn("company_number", F.lit("")).select(*FACT_COLUMNS).limit(0)
    scanned = spark.createDataFrame(
        [("00099999", "2020-01-01", 1)],
        "company_number string, accounts_date string, number_of_facts bigint",
    )
    companies = spark.createDataFrame([("00099999", "KNOWN")], "number string, name string")
    out = load_facts(files, scanned, companies, empty, empty, "2024-01-01")
    stored = {r.name: r for r in out["facts"].collect()}
    assert {k: v.value for k, v in stored.items() if k != "core:Fits"} == {
        "core:Equity": "-29951", "core:Officer": "ANN OTHER", "core:Nameless": "7",
    }
    assert stored["core:Equity"].decimals == "0"
    assert stored["core:Officer"].start_date == "2020-06-01"
    assert stored["core:Nameless"].label is None
    assert stored["core:Nameless"].company_number == "00012345"
    assert [len(r.value) for r in out["long_facts"].collect()] == [1996]
    assert rows(out["companies"]) == [("00012345", None), ("00099999", "KNOWN")]
    audit = out["scanned"].filter("company_number = '00012345'").first()
    assert (audit.number_of_facts, audit.number_of_long_facts, audit.errors) == (7, 1, None)
    assert rows(out["rejected"]) == [("badname.csv",)]
    # the same files again change nothing
    again = load_facts(
        files, out["scanned"].select(*scanned.columns), out["companies"], out["facts"],
        out["long_facts"], "2024-01-01",
    )
    assert rows(again["facts"]) == rows(out["facts"])
    assert again["scanned"].count() == out["scanned"].count()


def test_fact_files_as_a_stream(spark, fact_folder, tmp_path):
    folder = str(tmp_path / "out")
    one = load_fact_stream(spark, fact_folder, folder)
    stored = {(r.company_number, r.name): r.value for r in one["facts"].collect()}
    assert stored[("00012345", "core:Equity")] == "-29951"
    assert stored[("00012345", "core:Officer")] == "ANN OTHER"
    assert stored[("00099999", "core:Equity")] == "5"
    assert one["long_facts"].count() == 1
    # the next run takes only the new file; a scanned filing is left out
    with open(f"{fact_folder}/00012345_2020-05-31.csv", "w") as f:
        f.write(FACT_HEADER + "Equity,core:Equity,c1,-30000,x,,2021-05-31,GBP,0,e\n")
        f.write("Equity,core:Equity,c2,4,x,,2020-05-31,GBP,0,e\n")
    with open(f"{fact_folder}/000999992020-01-01.csv", "w") as f:
        f.write(FACT_HEADER + "Equity,core:Equity,c1,900,x,,2020-01-01,GBP,0,e\n")
    two = load_fact_stream(spark, fact_folder, folder)
    values = {(r.company_number, r.context_ref): r.value for r in two["facts"].collect() if r.name == "core:Equity"}
    assert values == {("00012345", "c1"): "-30000", ("00012345", "c2"): "4", ("00099999", "c1"): "5"}
    assert two["scanned"].count() == 3


def test_files_wider_than_allowed_fail(spark, tmp_path):
    """A cell behind the last column that is read must not be lost."""
    path = tmp_path / "wide"
    path.mkdir()
    names = [f"h{i}" for i in range(130)]
    (path / "a.csv").write_text(",".join(names) + "\n" + ",".join(str(i) for i in range(130)) + "\n")
    with pytest.raises(Exception, match="more than 128 columns"):
        read_mapped_csv(spark, str(path), {"h129": "last"}).collect()
    got = read_mapped_csv(spark, str(path), {"h129": "last", "h0": "first"}, columns=130).collect()
    assert [tuple(r) for r in got] == [("129", "0")]
    facts = tmp_path / "facts"
    facts.mkdir()
    (facts / "00012345.csv").write_text(FACT_HEADER.strip() + "," * 20 + "\n" + "a," * 29 + "b\n")
    with pytest.raises(Exception, match="more than 24 columns"):
        read_fact_csv(spark, str(facts)).collect()


def test_fact_files_written_as_folders(spark, tmp_path):
    for folder in ("00012345_2020-05-31.csv", "file_name=000999992020-01-01.csv", "other"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "part-0.csv").write_text(FACT_HEADER + "Equity,core:Equity,c1,5,x,,2020-05-31,GBP,0,e\n")
    got = read_fact_csv(spark, f"{tmp_path}/*").orderBy("file_name").collect()
    assert [(r.file_name, r.file_company, r.file_date, r.value) for r in got] == [
        ("00012345_2020-05-31.csv", "00012345", "2020-05-31", "5"),
        ("000999992020-01-01.csv", "00099999", "2020-01-01", "5"),
        ("part-0.csv", None, None, "5"),
    ]


def test_fact_json(spark, tmp_path):
    folder = tmp_path / "json"
    folder.mkdir()
    document = {
        "factList": [
            ["item", {"name": "core:A"}, {"label": "Equity", "value": "5", "endInstant": "2021-05-31"}],
            ["item", {"name": "core:B"}, {"label": "Name, with \"marks\"", "value": "x", "start": "2020-06-01",
                                          "endInstant": "2021-05-31", "dimensions": {"a:B": "c:D"}}],
        ]
    }
    (folder / "00012345_2021-05-31.json").write_text(json.dumps(document, indent=2))
    (folder / "other.json").write_text(json.dumps(document))
    got = read_fact_json(spark, str(folder)).orderBy("document", "position").collect()
    assert [(r.company_number, r.accounts_date, r.position, r.label, r.start_date) for r in got] == [
        ("00012345", "2021-05-31", 0, "Equity", None),
        ("00012345", "2021-05-31", 1, 'Name, with "marks"', "2020-06-01"),
        (None, None, 0, "Equity", None),
        (None, None, 1, 'Name, with "marks"', "2020-06-01"),
    ]
    assert got[1].dimensions == {"a:B": "c:D"} and got[0].dimensions is None


def test_enumeration(spark, tmp_path):
    path = tmp_path / "descriptions.yml"
    path.write_text(
        "---\n'description':\n    'one-code' : \"**Plain** text\"\n"
        "    'two-code': \"made up to {made_up_date}\" # remark\n"
        "    'three' : 'director''s {charge number}'\n    'one-code' : \"second\"\n"
    )
    assert dict(rows(read_key_values(spark, str(path)))) == {
        "one-code": "**Plain** text",
        "two-code": "made up to {made_up_date}",
        "three": "director's {charge number}",
    }


def officer_line(company, kind, variable, appointed="20100128", born=" " * 8, full=" " * 8):
    return (
        f"{company}{kind}301123456789012 {' ' * 7}{appointed}{' ' * 8}DO2 CT85{born}{full}"
        f"{len(variable):04d}{variable}"
    )


def test_officers(spark, tmp_path):
    fields = "<".join(
        ["MRS", "ANN", "OTHER", "", "", "", "1 ROAD", "", "TOWN", "", "", "CLERK", "BRITISH", "ENGLAND", ""]
    )
    lines = [
        "DDDDSNAP289820210421",
        "FC0294101" + " " * 23 + "00010022SOME FIRM LIMITED<",
        officer_line("FC029410", "2", fields, "00060128", "195803  "),
        officer_line("FC029411", "2", fields, " " * 8, full="19580312"),
        officer_line("FC029412", "2", fields + "MORE<"),
        officer_line("FC029413", "2", "MRS<ANN<"),
        officer_line("FC029414", "5", fields),
        officer_line("FC029415", "2", fields, "2010X128"),
        "9999999900000007",
    ]
    path = tmp_path / "officers.dat"
    path.write_text("\n".join(lines) + "\n")
    text = spark.read.text(str(path)).withColumn("file", F.lit("officers.dat"))
    officers, bad, totals, check = load_officers(text)
    got = {r.company_number: r for r in officers.collect()}
    assert set(got) == {"FC029410", "FC029411"}
    first, second = got["FC029410"], got["FC029411"]
    assert (first.appointment_type, first.surname, first.honours) == ("Director", "OTHER", None)
    assert (first.appointment_date, first.birth_date, first.birth_date_is_accurate) == (
        "20060128", "19580301", False,
    )
    assert (second.appointment_date, second.birth_date, second.birth_date_is_accurate) == (
        None, "19580312", True,
    )
    assert first.usual_residential_country == "ENGLAND" and first.post_code == "DO2 CT85"
    assert {r.line[:8]: r.error for r in bad.collect()} == {
        "FC029412": "wrong number of fields",
        "FC029413": "wrong number of fields",
        "FC029414": "unknown record type",
        "FC029415": "unreadable dates",
    }
    assert {r.kind: r.n for r in totals.collect()} == {"company": 1, "person": 5, "unknown": 1}
    assert rows(check) == [("officers.dat", 7, 7, True)]
    assert read_fixed_width(spark, str(path)).count() == 7
    out = str(tmp_path / "officers.csv")
    write_delimited(officers, out)
    back = read_delimited(spark, out)
    assert back.columns == officers.columns
    assert rows(back.select("company_number", "surname")) == rows(officers.select("company_number", "surname"))


def test_reconcile_reports_a_missing_or_wrong_trailer(spark):
    lines = spark.createDataFrame(
        [("a", "000000011x"), ("b", "000000011x"), ("b", "9999999900000002")], "file string, value string"
    )
    assert rows(reconcile_counts(lines)) == [("a", 1, None, False), ("b", 1, 2, False)]


def test_snapshot_documents(spark, tmp_path):
    names = ["CompanyName", " CompanyNumber"]
    names += [f"RegAddress.{c}" for c in ("CareOf", "POBox", "AddressLine1", " AddressLine2".strip(), "PostTown", "County", "Country", "PostCode")]
    names += ["CompanyCategory", "CompanyStatus", "CountryOfOrigin", "DissolutionDate", "IncorporationDate"]
    names += [f"Accounts.{c}" for c in ("AccountRefDay", "AccountRefMonth", "NextDueDate", "LastMadeUpDate", "AccountCategory")]
    names += ["Returns.NextDueDate", "Returns.LastMadeUpDate"]
    names += [f"Mortgages.NumMort{c}" for c in ("Charges", "Outstanding", "PartSatisfied", "Satisfied")]
    names += [f"SICCode.SicText_{i}" for i in range(1, 5)]
    names += ["LimitedPartnerships.NumGenPartners", "LimitedPartnerships.NumLimPartners", "URI"]
    for i in range(1, 11):
        names += [f"PreviousName_{i}.CONDATE", f" PreviousName_{i}.CompanyName"]
    names += ["ConfStmtNextDueDate", " ConfStmtLastMadeUpDate"]
    assert len(names) == 55

    def line(**given):
        return ",".join('"' + given.get(n.strip().replace(".", "_"), "") + '"' for n in names)

    path = tmp_path / "snapshot.csv"
    path.write_text(
        ",".join(names)
        + "\n"
        + line(
            CompanyName='THE ""BEST"", LTD', CompanyNumber="345", IncorporationDate="07/05/1999",
            Accounts_AccountCategory="NO ACCOUNTS FILED", SICCode_SicText_1="None Supplied",
            ConfStmtNextDueDate="01/02/2022", Mortgages_NumMortCharges="0",
        )
        + "\n"
        + line(
            CompanyName="OTHER", CompanyNumber="SC123456", Accounts_AccountCategory="FULL",
            Accounts_LastMadeUpDate="31/03/2021", SICCode_SicText_1="62090 - Other",
            Mortgages_NumMortCharges="2", PreviousName_1_CompanyName="OLD", PreviousName_1_CONDATE="01/01/2001",
            LimitedPartnerships_NumLimPartners="4", Returns_LastMadeUpDate="01/01/2016",
        )
        + "\n"
    )
    docs = {r.companyNumber: r for r in company_document(read_snapshot_csv(spark, str(path))).collect()}
    one, two = docs["00000345"], docs["SC123456"]
    assert one.name == 'THE "BEST", LTD' and str(one.incorporationDate) == "1999-05-07"
    assert one.accounts is None and one.mortgages is None and one.returns is None
    assert one.sicCodes == [] and one.previousNames == [] and one.dissolutionDate is None
    assert str(one.confirmationStatement.nextDueDate) == "2022-02-01"
    assert str(two.accounts.lastMadeUpTo) == "2021-03-31" and two.incorporationDate is None
    assert two.mortgages.mortgageCharges == 2 and two.sicCodes == ["62090"]
    assert two.previousNames[0].name == "OLD" and two.limitedPartnerships.limitedPartners == 4
    assert str(two.returns.lastMadeUpTo) == "2016-01-01" and two.confirmationStatement is None
    mapped = read_mapped_csv(spark, str(path), {"CompanyNumber": "number", "Nothing": "x"})
    assert rows(mapped) == [("345",), ("SC123456",)]


def test_lists_and_files(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text("code,description\n01110,Growing\n01110,Growing of crops\n01120,Rice\n")
    assert rows(read_lookup(spark, str(path), SIC_MAP, "code")) == [("01110", "Growing"), ("01120", "Rice")]
    inputs = spark.createDataFrame([("a",), ("b",), ("c",)], "f string")
    done = spark.createDataFrame([("b",), ("b",)], "f string")
    assert rows(pending(inputs, done, "f")) == [("a",), ("c",)]
    assert rows(pending(inputs, done, "f", 1)) == [("a",)]


@pytest.mark.parametrize(
    "as_of, expected", [("2021-03-20", "2021-03-01"), ("2021-04-03", "2021-03-01"), ("2021-04-09", None)]
)
def test_latest_snapshot(spark, as_of, expected):
    df = spark.createDataFrame([("2021-02-01",), ("2021-03-01",)], "d string").select(F.col("d").cast("date"))
    got = [str(r.d) for r in latest_snapshot(df, "d", as_of).collect()]
    assert got == ([expected] if expected else [])


def test_documents_leave_out_missing_fields(spark, tmp_path):
    df = spark.createDataFrame([("2021", "a", None), ("2021", "b", "x"), ("2022", "c", None)], "y string, k string, v string")
    write_documents(df, str(tmp_path / "docs"), "y")
    text = sorted(r.value for r in spark.read.text(str(tmp_path / "docs")).collect())
    assert text == ['{"k":"a"}', '{"k":"b","v":"x"}', '{"k":"c"}']
    back = spark.read.schema("y string, k string, v string").json(str(tmp_path / "docs"))
    assert rows(back.select("y", "k", "v")) == rows(df)


def test_fact_files_with_line_breaks_and_their_own_headers(spark, tmp_path):
    """The older file counts first, however small; values go by the header of their own file."""
    folder = tmp_path / "landing"
    folder.mkdir()
    old, new = folder / "00012345_2020-05-31.csv", folder / "00012345_2019-05-31.csv"
    old.write_text(
        'Value,Label,contextRef,Name,End/Instant\n"line one\nline two, tail",Note,c1,core:Note,2020-05-31\n'
    )
    new.write_text(FACT_HEADER + "Note,core:Note,c1,later,x,,2020-05-31,,,e\n" * 50)
    os.utime(old, (1_000_000, 1_000_000))
    files = read_fact_csv(spark, str(folder))
    first = files.filter("file_date = '2020-05-31'").collect()
    assert [(r.value, r.label, r.name, r.context_ref, r.end_date, r.start_date) for r in first] == [
        ("line one\nline two, tail", "Note", "core:Note", "c1", "2020-05-31", None)
    ]
    assert files.filter("file_date = '2019-05-31'").count() == 50
    empty = files.withColumn("company_number", F.lit("")).select(*FACT_COLUMNS).limit(0)
    scanned = spark.createDataFrame([], "company_number string, accounts_date string, number_of_facts bigint")
    companies = spark.createDataFrame([], "number string, name string")
    stored = load_facts(files, scanned, companies, empty, empty, "2024-01-01")["facts"].collect()
    assert [r.value for r in stored] == ["line one\nline two, tail"]


def test_snapshots_with_their_own_headers_and_repeated_companies(spark, tmp_path):
    folder = tmp_path / "snapshot"
    folder.mkdir()
    one, two = folder / "part1.csv", folder / "part2.csv"
    one.write_text(" CompanyNumber,CompanyName, CompanyCategory\n1,FIRST,A\n")
    two.write_text("CompanyName,CompanyNumber\nSECOND,1\nOTHER,2\n")
    os.utime(one, (1_000_000, 1_000_000))
    mapped = read_mapped_csv(spark, str(folder), {"CompanyNumber": "number", "CompanyName": "name", "CompanyCategory": "kind"})
    assert rows(mapped) == [("1", "FIRST", "A"), ("1", "SECOND", None), ("2", "OTHER", None)]
    placed = read_mapped_csv(spark, str(folder), {"CompanyNumber": "number", "CompanyName": "name"}, place="_place")
    kept = drop_exact(placed, ["number"], F.col("_place"))
    assert rows(kept.select("number", "name")) == [("1", "FIRST"), ("2", "OTHER")]


def test_bundled_fact_files_equal_single_ones(spark, fact_folder, tmp_path):
    """Lines of many fact files in one landed file count as those of their own files, also in a later delivery."""
    header = "factFile," + FACT_HEADER
    line = "{},Equity,core:Equity,c1,{},x,,2021-05-31,GBP,0,e\n"
    landing = tmp_path / "landing"
    (landing / "one").mkdir(parents=True)
    files = ("00000001_2021-05-31.csv", "00000002.csv", "badname.csv", "")
    (landing / "one" / "a.csv").write_text(header + "".join(line.format(f, n) for n, f in enumerate(files)))
    read = read_fact_csv(spark, str(landing / "one"))
    assert rows(read.select("file_company", "file_date", "value")) == sorted(
        [("00000001", "2021-05-31", "0"), ("00000002", None, "1"), (None, None, "2"), (None, None, "3")], key=str
    )
    out = load_fact_stream(spark, f"{landing}/*", str(tmp_path / "out"))
    assert rows(out["facts"].select("company_number", "value")) == [("00000001", "0"), ("00000002", "1")]
    (landing / "two").mkdir()
    again = ("00000001_2021-05-31.csv", "00000003.csv")
    (landing / "two" / "a.csv").write_text(header + "".join(line.format(f, 900) for f in again))
    out = load_fact_stream(spark, f"{landing}/*", str(tmp_path / "out"))
    assert rows(out["facts"].select("company_number", "value")) == [
        ("00000001", "0"), ("00000002", "1"), ("00000003", "900")
    ]
    assert out["scanned"].count() == 3


def test_fact_files_of_a_delivery_land_in_few_files(spark, data, tmp_path_factory, monkeypatch):
    """Not a file and a folder for each supplier and year."""
    import glob

    from rollbook.registered import QUERIES, jobs

    base = str(tmp_path_factory.mktemp("stream"))
    monkeypatch.setattr(jobs, "shared_folder", lambda spark, name: f"{base}/{name}")
    assert QUERIES["jb03e_audit_of_the_stream"](spark, data).count() > 60
    assert len(glob.glob(f"{base}/fact-landing/**/*.csv*", recursive=True)) <= 3
