"""Streams: repeats, order, restarts, and the same result as the batch."""

import datetime as dt
import json

import pytest

from rollbook.plans import load_company_events, load_filing_events
from rollbook.schemas import COMPANY_EVENT, TOPICS
from rollbook.sources import current_version
from rollbook.streaming import (
    ChangeLog,
    SeenIds,
    dedupe_events,
    diff_companies,
    flatten_company,
    new_events,
    parse_or_quarantine,
    read_events,
    read_rates,
    repair_frames,
    run_until_current,
    save_each_batch,
    store_rates,
    with_event_key,
)
from tests.conftest import rows


def event(point, number="00000001", etag=None, address=None, foreign=None, **data):
    body = {
        "company_name": "ONE LTD", "company_number": number, "company_status": "active", "type": "ltd",
        "date_of_creation": "2001-02-03", "etag": etag or f"e{point}",
        "registered_office_address": {"address_line_1": "1 High Street", **(address or {})}, **data,
    }
    if foreign:
        body["foreign_company_details"] = {"originating_registry": {"country": foreign}}
    return json.dumps(
        {
            "resource_kind": "company-profile",
            "resource_id": f"r{point}",
            "resource_uri": f"/company/{number}",
            "data": body,
            "event": {"timepoint": point, "published_at": f"2024-01-01T00:00:{point % 60:02d}", "type": "changed"},
        }
    )


EVENTS = [
    event(1),
    event(2, company_name="One Ltd"),
    event(3, address={"address_line_1": "1 high street, floor 2"}),
    event(4, address={"address_line_1": "1 HIGH STREET"}),
    event(5, type="unheard-of", foreign="FRANCE"),
    event(6, number="00000002", address={"region": "SOMERSET"}),
    event(7, type="other-unheard-of"),
    event(8, number="00000002"),
]


def changes(df):
    return {
        r.timepoint: (r.new, None if r.fields_changed is None else {k: (v.old, v.new) for k, v in r.fields_changed.items()})
        for r in df.collect()
    }


EXPECTED = {
    1: (True, None),
    2: (False, {}),
    3: (False, {}),
    4: (False, {"streetaddress": ("1 high street, floor 2", "1 HIGH STREET")}),
    5: (False, {"category": ("Private limited company", None), "origin": ("United Kingdom", "FRANCE")}),
    6: (True, None),
    7: (False, {}),
    8: (False, {"county": ("SOMERSET", "")}),
}


def batch(spark, lines):
    text = spark.createDataFrame([(x,) for x in lines], "value string")
    return flatten_company(parse_or_quarantine(text, COMPANY_EVENT)[0])


def test_diff(spark):
    events, companies = diff_companies(batch(spark, EVENTS))
    assert changes(events) == EXPECTED
    state = {r.number: r for r in companies.collect()}
    assert state["00000001"].timepoint == 7 and state["00000001"].origin == "United Kingdom"
    assert state["00000001"].date == dt.date(2001, 2, 3)


@pytest.mark.parametrize("width", [1, 3])
def test_diff_in_segments(spark, width):
    from pyspark.sql import functions as F

    events, _ = diff_companies(batch(spark, EVENTS), None, F.floor(F.col("timepoint") / width))
    assert changes(events) == EXPECTED


@pytest.mark.parametrize("cuts", [[8], [1, 2, 3, 4, 5, 6, 7, 8], [2, 5, 8]])
def test_stream_equals_batch_across_restarts(spark, tmp_path, cuts):
    landing = tmp_path / "landing"
    landing.mkdir()
    start = 0
    for n, end in enumerate(cuts):
        # repeats of old events arrive again with the new ones
        (landing / f"{n}.json").write_text("\n".join(EVENTS[max(0, start - 2) : end]) + "\n")
        events, companies, _ = load_company_events(spark, str(landing), str(tmp_path / "out"))
        start = end
    assert changes(events) == EXPECTED
    _, expected = diff_companies(batch(spark, EVENTS))
    assert rows(companies) == rows(expected)


def test_older_event_does_not_undo_a_newer_state(spark):
    _, companies = diff_companies(batch(spark, [event(5, company_status="dissolved")]))
    events, after = diff_companies(batch(spark, [event(3)]), companies)
    assert after.first().status == "dissolved" and after.first().timepoint == 5
    assert changes(events)[3][0] is False


def test_frames_and_unreadable_lines(spark):
    lines = spark.createDataFrame(
        [(EVENTS[0] + EVENTS[1] + EVENTS[2],), ("\n",), ("",), ("{broken",), (EVENTS[3] + "\n" + EVENTS[4],)],
        "value string",
    )
    good, bad = parse_or_quarantine(repair_frames(lines), COMPANY_EVENT)
    assert sorted(r.event.timepoint for r in good.collect()) == [1, 2, 3, 4, 5]
    assert rows(bad) == [("{broken",)]


@pytest.mark.parametrize("topic", sorted(TOPICS))
def test_topics_read_and_dedupe(spark, tmp_path, topic):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text("\n".join([event(1, etag="x"), event(1, etag="x"), event(2, etag="y")]) + "\n")
    events = dedupe_events(read_events(spark, topic, str(landing))[0]).select("event_key")
    writer = save_each_batch(events, str(tmp_path / "rows"))
    run_until_current(writer, str(tmp_path / "check"))
    # the same events again in a later file
    (landing / "b.json").write_text(event(1, etag="x") + "\n")
    run_until_current(writer, str(tmp_path / "check"))
    keys = [r.event_key for r in spark.read.parquet(str(tmp_path / "rows")).collect()]
    assert sorted(keys) == (["x", "y"] if topic in ("companies", "insolvency-cases") else ["r1", "r2"])


def test_batch_dedupe(spark):
    text = spark.createDataFrame([(event(1, etag="x"),), (event(1, etag="x"),)], "value string")
    parsed, _ = parse_or_quarantine(text, COMPANY_EVENT)
    assert dedupe_events(with_event_key(parsed, "companies")).count() == 1


def test_filings(spark, tmp_path):
    def filing(n, code, values, uri="/company/SC000001/filing-history/x"):
        return json.dumps(
            {
                "resource_kind": "filing-history", "resource_id": f"f{n}", "resource_uri": uri,
                "data": {"category": "accounts", "description": code, "description_values": values,
                         "date": "2021-05-31", "type": "AA", "barcode": "X"},
                "event": {"timepoint": n, "published_at": "2024-01-01T00:00:00", "type": "changed"},
            }
        )

    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(
        "\n".join(
            [
                filing(1, "known", {"made_up_date": "2021-05-31"}),
                filing(1, "known", {"made_up_date": "2021-05-31"}),
                filing(2, "unknown", None),
                filing(3, "known", None),
                filing(4, None, None),
                filing(5, "known", {}, "/company/too-long-number/filing-history/x"),
                "{broken",
            ]
        )
        + "\n"
    )
    templates = spark.createDataFrame([("known", "**Accounts** made up to {made_up_date}")], "key string, value string")
    companies = spark.createDataFrame([("SC000001", "ONE")], "number string, name string")
    out, bad = load_filing_events(spark, str(landing), str(tmp_path / "out"), templates, companies)
    assert rows(bad) == [("{broken",)]
    assert rows(out.select("id", "company_number", "description", "company_profile.name")) == [
        ("f1", "SC000001", "**Accounts** made up to 2021-05-31", "ONE"),
        ("f3", "SC000001", "**Accounts** made up to ", "ONE"),
    ]


def test_a_batch_writes_the_companies_it_changes(spark, tmp_path):
    landing, out = tmp_path / "landing", tmp_path / "out"
    landing.mkdir()
    (landing / "0.json").write_text("\n".join(event(n, number=f"{n:08d}") for n in range(1, 300)) + "\n")
    load_company_events(spark, str(landing), str(out))
    (landing / "1.json").write_text(event(500, number="00000007") + "\n{broken\n")
    _, companies, bad = load_company_events(spark, str(landing), str(out))
    assert companies.count() == 299 and rows(bad) == [("{broken",)]
    logs = sorted((out / "companies" / "log").iterdir())
    assert [spark.read.parquet(str(p)).count() for p in logs] == [299, 1]


def log_of(spark, tmp_path, **options):
    return ChangeLog(spark, str(tmp_path / "log"), "id", "id string, a int, b string", **options)


def test_change_log_equals_a_dict_and_writes_what_changes(spark, tmp_path):
    log, expected, written = log_of(spark, tmp_path, most_logs=2, share=0.5, range_rows=20), {}, []
    for version in range(9):
        changed = [(f"k{(version * 7 + i * 3) % 50}", version, None if i % 2 else f"v{i}") for i in range(50 if version == 0 else 6)]
        changed = list({r[0]: r for r in changed}.values())
        expected.update({r[0]: r for r in changed})
        for _ in range(2):
            # a batch that runs again changes nothing
            log.append(spark.createDataFrame(changed, log.schema), version)
            assert rows(log.read()) == sorted(expected.values(), key=str)
        parts = current_version(spark, log.folder)[1]
        written.append((sum(p.kind == "base" for p in parts), sum(p.kind == "log" for p in parts)))
        keys = spark.createDataFrame([("k1",), ("k2",), ("none",), (None,)], "id string")
        assert rows(log.read(keys)) == sorted([r for k, r in expected.items() if k in ("k1", "k2")], key=str)
    # compactions have happened, and few parts are left at any time
    assert any(b for b, _ in written) and all(n <= 3 for _, n in written)


def test_a_reader_keeps_its_version(spark, tmp_path):
    log = log_of(spark, tmp_path, most_logs=0, share=0)
    log.append(spark.createDataFrame([("x", 1, "old")], log.schema), 0)
    before = log.read()
    log.append(spark.createDataFrame([("x", 2, "new")], log.schema), 1)
    assert rows(before) == [("x", 1, "old")] and rows(log.read()) == [("x", 2, "new")]
    assert rows(log.read(before=1)) == [("x", 1, "old")]


def test_seen_ids_across_merges_and_without_ids(spark, tmp_path):
    store, known = SeenIds(spark, str(tmp_path / "seen"), most_parts=2), set()
    for version in range(6):
        ids = {f"id{i}" for i in range(version * 20, version * 20 + 30)}
        table = spark.createDataFrame([(i,) for i in sorted(ids)], "id string")
        assert {r.id for r in store.seen(table).collect()} == ids & known
        assert {r.id for r in store.seen(table, version).collect()} == ids & known
        store.add(spark.createDataFrame([(i,) for i in sorted(ids - known)], "id string"), version)
        known |= ids
    assert len(current_version(spark, store.folder)[1]) <= 3
    batch = spark.createDataFrame([("id1", 1), ("new", 2), ("new", 2), (None, 3), (None, 3)], "event_key string, n int")
    found, finish = new_events(batch, 6, store.folder, most_parts=2)
    assert rows(found) == [("new", 2), (None, 3), (None, 3)]
    finish(found)
    assert rows(new_events(batch, 7, store.folder)[0]) == [(None, 3), (None, 3)]
    # the same batch again finds what it found before
    assert rows(new_events(batch, 6, store.folder)[0]) == [("new", 2), (None, 3), (None, 3)]


def test_no_state_store_and_filters_spare_reads(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "0.json").write_text("\n".join(event(n) for n in range(1, 20)) + "\n")
    load_company_events(spark, str(landing), str(tmp_path / "out"))
    assert not (tmp_path / "out" / "checkpoint" / "state").exists()
    store = SeenIds(spark, str(tmp_path / "ids"))
    store.add(spark.range(10_000).selectExpr("concat('a', id) AS id"), 0)
    part = current_version(spark, store.folder)[1][0]
    strange = spark.range(10_000).selectExpr("concat('b', id) AS id")
    assert store._maybe(strange, part).count() < 500
    assert store._maybe(spark.range(10_000).selectExpr("concat('a', id) AS id"), part).count() == 10_000


def test_events_without_an_id_stay(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 2)], "event_key string, n int")
    assert dedupe_events(df).filter("event_key IS NULL").count() == 2 and dedupe_events(df).count() == 3


def test_rates_add_up_over_batches(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()
    for n, points in enumerate([[1, 2], [3], [2, 61]]):
        (landing / f"{n}.json").write_text("\n".join(event(p) for p in points) + "\n")
        run_until_current(store_rates(read_events(spark, "companies", str(landing))[0], out), str(tmp_path / "check"))
    assert [tuple(r)[1:] for r in read_rates(spark, out).collect()] == [(5, 5 / 300)]
