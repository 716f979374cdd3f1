import itertools
import random
from pathlib import Path

import rollbook.llm.near_duplicates as near_module
from rollbook.llm import QUERIES
from rollbook.llm.components import components
from rollbook.llm.near_duplicates import HASHES, keep_one, least_matches, near_duplicates
from rollbook.session import shared_folder

from .conftest import prose


def shingles(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def expected(rows, k, percent=80):
    """(n_shingles, component) of each row by comparing all pairs."""
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            up[root(j)] = root(i)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = []
    for i, (id, _) in enumerate(rows):
        ids = [rows[j][0] for j in groups[root(i)] if rows[j][0] is not None]
        component = id if not sets[i] else min(ids, default=None)
        out.append((id, len(sets[i]), component, id == component))
    return sorted(out, key=str)


def found(df, k):
    return sorted((tuple(r)[:4] for r in near_duplicates(df, k=k).collect()), key=str)


def test_documents_equal_all_pairs(spark, data, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = sorted((tuple(r) for r in QUERIES["op7_minhash_near_dedup"](spark, data).collect()), key=str)
    assert got == expected(rows, 2)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd, 5) == expected(rows, 5)


def test_empty_table(odd):
    assert near_duplicates(odd.limit(0)).collect() == [] and keep_one(odd.limit(0)).collect() == []


def test_group_whose_links_go_through_some_members_only(spark):
    """Copies that drift away from the first: neighbours are linked, far ones are not."""
    words = prose(5, 120).split()
    rows = []
    for i in range(60):
        rows.append((100 + i, " ".join(words)))
        words[(7 * i) % 120] = f"new{i}"
        words[(7 * i + 50) % 120] = f"also{i}"
    rows += [(i, prose(100 + i, 80)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = found(df, 2)
    assert got == expected(rows, 2)
    assert sum(1 for r in got if r[2] == 100) == 60


def test_pairs_that_are_nearly_links_are_never_rows(spark, monkeypatch):
    """Many texts at a similarity of about 0.7 to one another, and some links among them."""
    base = prose(9, 150).split()
    rows = []
    for i in range(300):
        r, words = random.Random(i), list(base)
        for at in r.sample(range(150), 8 if i % 10 else 3):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    sizes, write = {}, near_module.written

    def counted(df, name, **how):
        out = write(df, name, **how)
        sizes.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(near_module, "written", counted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(df, 2) == expected(rows, 2)
    assert sizes["links"][-1] < 300


def test_tables_on_the_way_are_deleted(spark):
    df = spark.createDataFrame([(i, prose(i // 2, 40)) for i in range(20)], "doc_id bigint, text string")
    folder = Path(shared_folder(spark, "any").removeprefix("file:")).parent
    before = set(folder.iterdir())
    assert near_duplicates(df).filter("kept").count() == 10
    assert ["named" in p.name for p in set(folder.iterdir()) - before] == [True]


def test_keep_one_keeps_columns_and_one_row_of_a_group(odd):
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    got = sorted(((r.doc_id, len(r.text or "")) for r in kept.collect()), key=str)
    # 4 copies 3, 6 and the second 5 copy the first 5, 10 is 9 in capitals, 12 is nearly 11
    assert [i for i, _ in got if i is not None] == sorted([1, 11, 13, 2, 3, 5, 7, 8, 9], key=str)
    assert sum(1 for i, _ in got if i is None) == 2


def test_a_pair_at_the_limit_is_hardly_ever_pruned():
    steps = least_matches(0.8)
    assert [n for n, _ in steps] == list(range(20, HASHES + 1, 20))
    assert all(m < 0.8 * n for n, m in steps) and steps[-1][1] > 0.5 * HASHES


def test_components_of_a_chain_a_star_and_a_pair(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(1000, 999)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 100 for i in range(100, 161))
    assert all(got[i] == 1 for i in range(1, 40))
    assert got[1000] == got[999] == 999
