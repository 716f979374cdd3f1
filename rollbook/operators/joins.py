"""Joins. The join method is left to Catalyst and AQE, which check sizes at run time."""

from pyspark.sql import functions as F

from ..fixed_values import ACCOUNTANTS_LABEL
from ..functions import camel_case, clean_label, fill_template, strip_prefix


def join_buckets(a, b, key):
    """Two series side by side: full outer on the time bucket."""
    return a.join(b, key, "full_outer")


def with_area(df, postcodes, county, left_key="post_code"):
    """Rows whose postcode lies in the county, with the built-up area."""
    local = postcodes.filter(F.col("county") == county).select(
        F.col("postcode").alias(left_key), F.col("built_up_area").alias("area")
    )
    return df.join(local, left_key)


def in_region(keys, companies, postcodes, counties):
    """Keys of the companies whose postcode lies in one of the counties."""
    local = postcodes.filter(F.col("county").isin(list(counties))).select("postcode").distinct()
    numbers = (
        companies.join(local, "postcode", "left_semi")
        .select(F.col("number").alias("company_number"))
        .distinct()
    )
    return keys.join(numbers, "company_number", "left_semi")


def join_near(a, b, keys, near):
    """The inner join of ``a`` and ``b`` on ``keys``, planned by the key ``near`` alone: rows that lie together by it are not shuffled.

    A value of ``near`` should have no more than some thousand rows in ``b``.
    """
    named = {k: f"_{k}" for k in keys}
    b = b.withColumnsRenamed(named)
    # for Spark two bounds are no key of the join
    same = [(F.col(k) >= F.col(own)) & (F.col(k) <= F.col(own)) for k, own in named.items() if k != near]
    return a.join(b, [F.col(near) == F.col(named[near]), *same]).drop(*named.values())


def join_facts(keys, facts, on=("company_number", "end_date"), near=None):
    """The facts of the keys; ``near``, one of ``on``, says by which one the facts lie together (see ``join_near``)."""
    if near is None:
        return keys.join(facts, list(on))
    rest = [c for c in [*keys.columns, *facts.columns] if c not in on]
    return join_near(facts, keys, on, near).select(*on, *rest)


def scalar_lookup(df, dim, key, col, dim_key=None):
    """Add ``col`` of the at most one row of ``dim`` that has the key; NULL if there is none."""
    side = dim.select(F.col(dim_key or key).alias(key), col)
    return df.join(side, key, "left")


def band_join(a, b, key, ts, at, seconds, width=None):
    """Pairs with the same key and ``a.ts`` within ``at`` +- ``seconds`` (bounds included).

    Time is cut into slots. A row of ``b`` goes to every slot that its band touches (at
    most three, as a slot is never narrower than the band's half width), a row of ``a`` to
    its own slot, and the join is on key and slot. A key that holds much of the data is
    thus spread over its time line, and each pair comes up once.
    """
    width = width or max(2 * seconds, 60)
    if width < seconds:
        raise ValueError("a slot must not be narrower than the band")
    moment = F.unix_micros(F.col(ts).cast("timestamp"))
    centre = F.unix_micros(F.col(at).cast("timestamp"))
    band = seconds * 1_000_000
    slot = width * 1_000_000
    left = a.withColumns({"_t": moment, "_slot": F.floor(moment / slot)})
    right = b.withColumn("_c", centre).withColumn(
        "_slot",
        F.explode(
            F.sequence(
                F.floor((F.col("_c") - band) / slot), F.floor((F.col("_c") + band) / slot)
            )
        ),
    )
    return (
        left.join(right, [key, "_slot"])
        .filter(F.col("_t").between(F.col("_c") - band, F.col("_c") + band))
        .drop("_t", "_c", "_slot")
    )


def join_json_field(a, b, key, field, date, order):
    """Left join to the first row of ``b`` (by ``order``) with the key and field = ``a.date``.

    ``field`` is the name of an entry of the map column ``description_values``. The first
    row is found by an aggregate, so a key with many rows is combined map-side.
    """
    rest = [c for c in b.columns if c != key]
    first = (
        b.withColumn(date, F.try_element_at("description_values", F.lit(field)))
        .filter(F.col(date).isNotNull())
        .groupBy(key, date)
        .agg(F.min_by(F.struct(*rest), order).alias("_first"))
    )
    return a.join(first, [key, date], "left").select(
        *a.columns, *[F.col(f"_first.{c}").alias(c) for c in rest if c != date]
    )


def describe(df, templates, how="inner", code="description_code", values="description_values"):
    """Add ``description``: the template of the code, filled from the row's value map.

    ``inner`` drops rows with an unknown code, ``left`` names them by the code itself.
    """
    if how not in ("inner", "left"):
        raise ValueError(how)
    side = templates.select(F.col("key").alias(code), F.col("value").alias("_template"))
    text = fill_template(F.col("_template"), F.col(values))
    fallback = camel_case(F.coalesce(F.col(code), F.lit("")))
    return (
        df.join(side, code, how)
        .withColumn("description", F.when(F.col("_template").isNotNull(), text).otherwise(fallback))
        .drop("_template")
    )


def not_processed(df, done, keys, near=None):
    """Rows with keys that ``done`` lacks; NULL equals nothing.

    With ``near``, one of the keys, what is done is gathered by it and joined by it alone: rows that lie together by that key, for
    the steps around this one, need no shuffle of their own. A value of ``near`` should have no more than some thousand others.
    """
    if near is None:
        return df.join(done.select(*keys).distinct(), list(keys), "left_anti")
    own = F.struct(*[k for k in keys if k != near])
    gathered = done.dropna(subset=list(keys)).groupBy(near).agg(F.collect_set(own).alias("_done"))
    known = F.coalesce(F.array_contains("_done", own), F.lit(False))
    return df.join(gathered, near, "left").filter(~known).select(*df.columns)


def with_exists_flag(df, other, keys, name):
    """Add a flag that says whether ``other`` has the keys; no row is repeated or lost."""
    flag = other.select(*keys).distinct().withColumn(name, F.lit(True))
    return df.join(flag, list(keys), "left").withColumn(name, F.coalesce(name, F.lit(False)))


def update_from(target, src, keys, col):
    """Overwrite ``col`` from the matching row of ``src``; of several the largest counts."""
    new = src.groupBy(*keys).agg(F.max(col).alias("_new"))
    return (
        target.join(new, list(keys), "left")
        .withColumn(col, F.coalesce("_new", F.col(col)))
        .drop("_new")
        .select(*target.columns)
    )


def enrich_stream(ev, companies):
    """Optional company profile next to each event; also for a stream on the left."""
    profile = companies.select(
        F.col("number").alias("company_number"),
        F.struct(*[c for c in companies.columns if c != "number"]).alias("company_profile"),
    )
    return ev.join(profile, "company_number", "left")


def relabel_all_or_none(docs, dims, document="document", position="position", col="dimensions"):
    """(facts with relabelled dimensions, documents with an unknown dimension).

    Names and members lose their namespace and are replaced from ``dims(key, value)``; the
    member None stays. One unknown name or member rejects its whole document.
    """
    entries = docs.select(document, position, F.explode(col).alias("name", "member")).withColumns(
        {"name_key": strip_prefix(F.col("name")), "member_key": strip_prefix(F.col("member"))}
    )
    names = dims.select(F.col("key").alias("name_key"), clean_label(F.col("value")).alias("_name"))
    members = dims.select(F.col("key").alias("member_key"), F.col("value").alias("_member"))
    looked = entries.join(names, "name_key", "left").join(members, "member_key", "left")
    missing = F.col("_name").isNull() | (F.col("_member").isNull() & (F.col("member") != "None"))
    pair = F.struct("_name", F.coalesce("_member", F.col("member_key")).alias("_member"))
    # all entries of a group come from the map of one fact, so the group is small
    info = looked.groupBy(document, position).agg(
        F.bool_or(missing).alias("_missing"),
        F.array_sort(F.collect_list(F.when(F.col("_name").isNotNull(), pair))).alias("_pairs"),
    )
    bad = info.filter("_missing").select(document).distinct()
    next_name = lambda i: F.get(F.col("_pairs"), i + 1)["_name"]
    unique = F.filter("_pairs", lambda p, i: ~p["_name"].eqNullSafe(next_name(i)))
    info = info.filter(~F.col("_missing")).select(
        document, position, F.map_from_entries(unique).alias("additional_info")
    )
    good = docs.drop(col).join(bad, document, "left_anti")
    return good.join(info, [document, position], "left"), bad


def client_counts(advisers, facts, label=ACCOUNTANTS_LABEL):
    """Distinct client companies per adviser name; 0 for an adviser nobody names."""
    clients = (
        facts.filter(F.col("label") == label)
        .groupBy(F.col("value").alias("name"))
        .agg(F.count_distinct("company_number").alias("number_of_clients"))
    )
    return advisers.join(clients, "name", "left").withColumn(
        "number_of_clients", F.coalesce("number_of_clients", F.lit(0))
    )
