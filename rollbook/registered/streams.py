"""Streams over landed event files; each stops when all files are done and is read back."""

from pyspark.sql import functions as F

from ..operators import high_water_mark
from ..plans import load_company_events, load_filing_events
from ..schemas import COMPANY_EVENT, TOPICS
from ..session import shared_folder
from ..streaming import (
    backlog_age,
    dedupe_events,
    diff_companies,
    flatten_company,
    flatten_filing,
    mark_deleted,
    parse_or_quarantine,
    read_events,
    read_lines,
    read_rates,
    repair_frames,
    resume_after,
    run_continuous,
    run_until_current,
    save_each_batch,
    save_new_events,
    store_rates,
    unknown_codes,
    with_event_key,
)
from .adapters import companies, register_events, stamp, table, with_sql
from .registry import query
from .shapes import COMPANY_FLAT, company_event_json, filing_event_json, kind_templates


def landed(spark, folder, render, name):
    path = shared_folder(spark, name)
    render(spark, folder).write.text(path)
    return path


def stored(spark, df, name, mode="append"):
    """Run a stream to its end and read what it stored."""
    path = shared_folder(spark, name)
    run_until_current(save_each_batch(df, f"{path}/rows", mode), f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/rows")


TOPIC_OF_KIND = {
    "click": "companies",
    "view": "filings",
    "purchase": "charges",
    "signup": "officers",
    "error": "insolvency-cases",
}


@query(
    "st01_read_events",
    """SELECT event_type AS kind, COUNT(*) AS n, MAX(event_id) AS last,
              COUNT(*) AS keyed FROM events GROUP BY event_type""",
)
def st01(spark, folder):
    """Each kind of event is one topic; all are read by the same reader."""
    out = None
    for kind, topic in TOPIC_OF_KIND.items():
        path = shared_folder(spark, f"topic-{topic}")
        of_kind = register_events(spark, folder).filter(F.col("kind") == kind)
        company_event_json(spark, folder, of_kind).write.text(path)
        events = read_events(spark, topic, path)[0].select(
            F.lit(kind).alias("kind"), F.col("event.timepoint").alias("timepoint"), "event_key"
        )
        rows = stored(spark, events, f"stored-{topic}")
        counted = rows.groupBy("kind").agg(
            F.count("*").alias("n"),
            F.max("timepoint").alias("last"),
            F.count("event_key").alias("keyed"),
        )
        out = counted if out is None else out.unionByName(counted)
    return out


@query(
    "st02_repair_frames",
    "SELECT kind, n FROM (SELECT 'company-profile' AS kind, COUNT(*) AS n FROM events) AS a "
    "UNION ALL SELECT 'filing-history', COUNT(*) FROM events",
)
def st02(spark, folder):
    def glued(spark, folder):
        one = company_event_json(spark, folder).select(
            F.get_json_object("value", "$.resource_id").alias("id"), "value"
        )
        other = filing_event_json(spark, folder).select(
            F.get_json_object("value", "$.resource_id").alias("id"), F.col("value").alias("more")
        )
        both = one.join(other, "id").select(F.concat("value", "more").alias("value"))
        return both.unionByName(both.select(F.lit(" ").alias("value")))

    lines = repair_frames(read_lines(spark, landed(spark, folder, glued, "glued")))
    rows = stored(spark, lines, "repaired")
    kind = F.get_json_object("value", "$.resource_kind")
    return rows.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query(
    "st03_parse_or_quarantine",
    """SELECT CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS outcome,
              COUNT(*) AS n FROM events GROUP BY ALL""",
)
def st03(spark, folder):
    def broken(spark, folder):
        text = F.col("value")
        is_bad = text.contains('"type":"deleted"')
        return company_event_json(spark, folder).select(
            F.when(is_bad, F.concat(F.lit("?"), text)).otherwise(text).alias("value")
        )

    path = landed(spark, folder, broken, "broken")
    good, bad = parse_or_quarantine(repair_frames(read_lines(spark, path)), COMPANY_EVENT)
    good = stored(spark, good.select("resource_id"), "good").select(F.lit("good").alias("outcome"))
    bad = stored(spark, bad, "bad").select(F.lit("bad").alias("outcome"))
    return good.unionByName(bad).groupBy("outcome").agg(F.count("*").alias("n"))


def _twice(spark, folder):
    rows = company_event_json(spark, folder)
    return rows.unionByName(rows)


@query("st04_dedupe_events", "SELECT event_id::VARCHAR AS event_key FROM events")
def st04(spark, folder):
    events, _ = read_events(spark, "companies", landed(spark, folder, _twice, "twice"))
    return stored(spark, dedupe_events(events).select("event_key"), "once").select("event_key")


@query(
    "st04b_dedupe_by_stored_ids",
    """SELECT event_id::VARCHAR AS event_key, 1::BIGINT AS n FROM events WHERE event_type <> 'error'
       UNION ALL SELECT NULL, 4 * COUNT(*) FROM events WHERE event_type = 'error'""",
)
def st04b(spark, folder):
    """Every event comes twice, in four deliveries and again after them; errors have no id, and none of them is a repeat."""
    landing, target = shared_folder(spark, "repeats"), shared_folder(spark, "new-events")
    ev = register_events(spark, folder)
    quarter = F.pmod(F.col("timepoint"), F.lit(4))
    for part in [quarter == 0, quarter.isin(0, 1), quarter.isin(1, 2, 3), quarter.isin(2, 3)]:
        _without_error_ids(company_event_json(spark, folder, ev.filter(part))).write.mode("append").text(landing)
        events, _ = read_events(spark, "companies", landing)
        run_until_current(save_new_events(events, target, most_parts=2), f"{target}/checkpoint")
    # once more in one batch
    _without_error_ids(_twice(spark, folder)).write.mode("append").text(landing)
    run_until_current(save_new_events(read_events(spark, "companies", landing)[0], target), f"{target}/checkpoint")
    rows = spark.read.parquet(f"{target}/rows")
    return rows.groupBy("event_key").agg(F.count("*").alias("n"))


def _without_error_ids(lines):
    """The events of deletions lose their etag, by which company events are told apart."""
    gone = F.regexp_replace("value", '"etag":"[^"]*"', '"etag":null')
    return lines.select(F.when(F.col("value").contains('"type":"deleted"'), gone).otherwise(F.col("value")).alias("value"))


@query(
    "st05_resume_after",
    """SELECT event_id FROM events WHERE event_id > (SELECT MAX(event_id) FROM events
                                                    WHERE event_type = 'signup')""",
)
def st05(spark, folder):
    ev = table(spark, folder, "events")
    done = high_water_mark(ev.filter(F.col("event_type") == "signup"), "event_id").first()[0]
    return resume_after(ev, done, "event_id").select("event_id")


def _old(name):
    if name == "origin":
        return "first_value(origin) OVER w"
    return f"lag({name}) OVER w"


COMPARED = ["name", "streetaddress", "county", "country", "postcode", "category", "origin", "status"]


def _diff_sql():
    pieces = []
    for c in COMPARED:
        test = f"upper({c}) IS DISTINCT FROM upper(old_{c})"
        if c == "streetaddress":
            test = f"NOT starts_with(upper({c}), upper(old_{c}))"
        pieces.append(
            f"CASE WHEN {test} THEN '{c}:' || coalesce(old_{c}, '?') || '>' "
            f"|| coalesce({c}, '?') END"
        )
    return with_sql(
        "register_events",
        f""", flat AS ({COMPANY_FLAT}),
              d AS (SELECT *, {", ".join(f"{_old(c)} AS old_{c}" for c in COMPARED)},
                           row_number() OVER w AS nth
                    FROM flat WINDOW w AS (PARTITION BY number ORDER BY timepoint))
              SELECT id, number AS company_number, nth = 1 AS new,
                     CASE WHEN nth > 1 THEN concat_ws(';', {", ".join(pieces)}) END AS changes
              FROM d""",
    )


def changes_text(events):
    """The change map as one text, for comparison."""
    entry = F.transform(
        F.map_entries("fields_changed"),
        lambda e: F.concat(
            e["key"],
            F.lit(":"),
            F.coalesce(e["value"]["old"], F.lit("?")),
            F.lit(">"),
            F.coalesce(e["value"]["new"], F.lit("?")),
        ),
    )
    return events.select("id", "company_number", "new", F.array_join(entry, ";").alias("changes"))


@query("st06_diff_companies", _diff_sql())
def st06(spark, folder):
    """All events as one batch."""
    envelopes, _ = parse_or_quarantine(company_event_json(spark, folder), COMPANY_EVENT)
    events, _ = diff_companies(flatten_company(envelopes))
    return changes_text(events)


@query("st06b_diff_companies_stream", _diff_sql())
def st06b(spark, folder):
    """The same from landed files, in several micro-batches in order of the timepoint."""
    landing = shared_folder(spark, "companies-in-order")
    target = shared_folder(spark, "companies-stored")
    ev = register_events(spark, folder)
    third = F.least(F.floor((F.dayofmonth("published") - 1) / 10), F.lit(2))
    for n in range(3):
        # the files of the next ten days arrive, the stream takes up where it stopped
        company_event_json(spark, folder, ev.filter(third == n)).write.mode("append").text(landing)
        events, _, _ = load_company_events(spark, landing, target)
    return changes_text(events)


@query(
    "st06c_company_log",
    with_sql(
        "register_events",
        f"""SELECT number, ARG_MAX_NULL(name, timepoint) AS name, ARG_MAX_NULL(streetaddress, timepoint) AS streetaddress,
                   ARG_MAX_NULL(category, timepoint) AS category, ARG_MAX_NULL(status, timepoint) AS status,
                   ARG_MIN(origin, timepoint) AS origin, MAX(timepoint) AS timepoint
            FROM ({COMPANY_FLAT}) AS flat GROUP BY number""",
    ),
)
def st06c(spark, folder):
    """The companies after five deliveries; their log is put together several times in between."""
    landing = shared_folder(spark, "companies-by-days")
    target = shared_folder(spark, "companies-log")
    ev = register_events(spark, folder)
    days = F.least(F.floor((F.dayofmonth("published") - 1) / 6), F.lit(4))
    for n in range(5):
        company_event_json(spark, folder, ev.filter(days == n)).write.mode("append").text(landing)
        _, state, _ = load_company_events(spark, landing, target, most_logs=1, share=1.5)
    return state.select("number", "name", "streetaddress", "category", "status", "origin", "timepoint")


FILING_TEXT = """'**' || event_type || '** of ' || regexp_extract(props, '([0-9]+)', 1)
                 || ' made up to ' || strftime(ts, '%Y-%m-%d')"""


@query(
    "st07_describe_filings",
    f"""SELECT event_id::VARCHAR AS id, lpad(user_id::VARCHAR, 8, '0') AS company_number,
               event_type AS description_code, {FILING_TEXT} AS description, c_name AS company
        FROM events LEFT JOIN customer ON user_id = c_custkey
        WHERE event_type IN ('click', 'view', 'purchase')""",
)
def st07(spark, folder):
    path = landed(spark, folder, filing_event_json, "filings")
    rows, _ = load_filing_events(
        spark,
        path,
        shared_folder(spark, "filings-stored"),
        kind_templates(spark, folder),
        companies(spark, folder),
    )
    return rows.select(
        "id",
        "company_number",
        "description_code",
        "description",
        F.col("company_profile.name").alias("company"),
    )


@query("st08_run_until_current", "SELECT event_id AS timepoint FROM events")
def st08(spark, folder):
    path = landed(spark, folder, company_event_json, "current")
    events = read_events(spark, "companies", path)[0].select(F.col("event.timepoint").alias("timepoint"))
    return stored(spark, events, "current-stored").select("timepoint")


@query("st09_run_continuous", "SELECT event_id AS timepoint FROM events")
def st09(spark, folder):
    landing = landed(spark, folder, company_event_json, "steady")
    events = read_events(spark, "companies", landing)[0].select(
        F.col("event.timepoint").alias("timepoint")
    )
    path = shared_folder(spark, "steady-stored")
    running = run_continuous(save_each_batch(events, f"{path}/rows"), f"{path}/check", "1 second")
    running.processAllAvailable()
    running.stop()
    return spark.read.parquet(f"{path}/rows").select("timepoint")


@query(
    "st10_event_rate",
    """SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
              COUNT(*) AS events, round(COUNT(*) / 300.0::DOUBLE, 6) AS events_per_second
       FROM events GROUP BY ALL""",
)
def st10(spark, folder):
    """Three deliveries, of which each has events of all windows; a window's rows are added up on reading."""
    landing, target = shared_folder(spark, "rate"), shared_folder(spark, "rate-stored")
    ev = register_events(spark, folder)
    for n in range(3):
        company_event_json(spark, folder, ev.filter(F.pmod(F.col("timepoint"), F.lit(3)) == n)).write.mode("append").text(landing)
        events, _ = read_events(spark, "companies", landing)
        run_until_current(store_rates(events, f"{target}/rows"), f"{target}/checkpoint")
    return read_rates(spark, f"{target}/rows").select(
        stamp("window_start"), "events", F.round("events_per_second", 6).alias("events_per_second")
    )


@query(
    "st11_backlog_age",
    """SELECT event_id, (epoch_us(date_trunc('day', ts) + INTERVAL 1 DAY) - epoch_us(ts))::DOUBLE
                  / 1000000 AS backlog_seconds FROM events""",
)
def st11(spark, folder):
    ev = table(spark, folder, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("published"),
        (F.date_trunc("day", F.col("ts").cast("timestamp")) + F.expr("INTERVAL 1 DAY")).alias(
            "ingested_at"
        ),
    )
    return backlog_age(ev).select("event_id", "backlog_seconds")


@query(
    "st12_unknown_codes",
    """SELECT event_type AS description_code, COUNT(*) AS n FROM events
       WHERE event_type = 'signup' GROUP BY event_type""",
)
def st12(spark, folder):
    envelopes, _ = parse_or_quarantine(filing_event_json(spark, folder), TOPICS["filings"])
    return unknown_codes(flatten_filing(envelopes), kind_templates(spark, folder))


@query(
    "st13_mark_deleted",
    "SELECT event_id::VARCHAR AS id, event_type = 'error' AS deleted FROM events",
)
def st13(spark, folder):
    envelopes, _ = parse_or_quarantine(company_event_json(spark, folder), COMPANY_EVENT)
    return mark_deleted(with_event_key(envelopes, "companies")).select(
        F.col("resource_id").alias("id"), "deleted"
    )
