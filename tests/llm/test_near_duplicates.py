import random

import numpy as np
import pytest

from quire.llm import near_duplicates as nd
from quire.llm.components import components

from .plain import components as plain_components, odd_rows, shingles, vocabulary


def report(df, **kw):
    return nd.near_duplicates(df, **kw).collect()


@pytest.mark.parametrize("size", [2, 5])
def test_odd_rows(odd, size):
    rows = report(odd, shingle=size)
    texts = [(r[0], r[1]) for r in odd_rows()]
    least = plain_components([t for t in texts if t[0] is not None], size)
    assert len(rows) == len(texts)
    want = sorted((i is None, i or 0, len(shingles(t, size)), least.get(i)) for i, t in texts)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in rows)
    assert got == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)


def test_empty_table(empty):
    assert report(empty) == []
    assert nd.drop_near_duplicates(empty).columns == empty.columns


def test_groups_that_straddle_the_limit_equal_all_pairs(spark):
    """Copies of one text with 0 to 30 changed words: some linked to many, some
    to a few, some to none."""
    rng = random.Random(3)
    some, rows = vocabulary(3000), []
    for base in range(6):
        words = [rng.choice(some) for _ in range(140)]
        for _ in range(60):
            copy = list(words)
            for at in rng.sample(range(140), rng.choice([0, 1, 2, 4, 8, 12, 20, 30])):
                copy[at] = rng.choice(some)
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in report(df, shingle=2)}
    assert got == plain_components(rows, 2)


def test_the_rest_pass_finds_links_that_stars_miss(spark):
    """With a hub that is like neither, two members are linked only directly."""
    rng = random.Random(8)
    some, rows = vocabulary(5000), []
    for base in range(30):
        words = [rng.choice(some) for _ in range(200)]
        for version in range(4):
            copy = list(words)
            for at in range(version * 18, version * 18 + 18):
                copy[at] = rng.choice(some)
            rows.append((base * 10 + version, " ".join(copy)))
        rows.append((base * 10 + 9, " ".join(copy[:199] + ["last"])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in report(df, shingle=2)}
    assert got == plain_components(rows, 2)


def near_copies(n, changed, seed, words=200):
    """Copies of one text with `changed` of its words replaced."""
    rng = random.Random(seed)
    some = vocabulary(100_000)
    base, rows = [rng.choice(some) for _ in range(words)], []
    for i in range(n):
        copy = list(base)
        for at in rng.sample(range(words), changed):
            copy[at] = rng.choice(some)
        rows.append((i * 7919 % 104729, " ".join(copy)))
    return rows


def fast_components(rows, size):
    """As the plain version, by set intersections of numbers."""
    sets = [(i, np.array(sorted(hash(s) for s in shingles(t, size)), np.int64)) for i, t in rows]
    values = np.unique(np.concatenate([s for _, s in sets]))
    first = np.cumsum([0, *(len(s) for _, s in sets)])
    flat = np.searchsorted(values, np.concatenate([s for _, s in sets]))
    n, least = np.diff(first), np.array([i for i, _ in sets])
    links = []
    for k in range(len(sets)):
        marked = np.zeros(len(values), bool)
        marked[flat[first[k] : first[k + 1]]] = True
        common = np.add.reduceat(marked[flat], first[:-1])
        links.append(np.flatnonzero(100 * common >= 80 * (n[k] + n - common)))
    changed = True
    while changed:
        new = np.array([least[x].min() for x in links])
        changed = bool((new != least).any())
        least = new
    return {i: int(c) for (i, _), c in zip(sets, least)}


@pytest.mark.parametrize("changed", [4, 6])
def test_many_near_copies_make_few_links(spark, monkeypatch, changed):
    """5,000 copies of 0.85 and of 0.78 likeness (those have pairs above and below
    the limit): the same components as all pairs, and few links."""
    rows, seen = near_copies(5000, changed, changed), []
    joined = nd._joined
    monkeypatch.setattr(nd, "_joined", lambda labels, links, *more: seen.append(links.count()) or joined(labels, links, *more))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    got = {r.doc_id: r.component_id for r in report(df, shingle=2)}
    assert got == fast_components(rows, 2)
    assert sum(seen) <= 3 * len(rows)


def test_small_tiles_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(nd, "TILE_DOCS", 7)
    monkeypatch.setattr(nd, "TILE_ROWS", 30)
    monkeypatch.setattr(nd, "AT_ONCE", 2000)
    rows = near_copies(300, 11, 1, 150) + [(200_000 + i, t) for i, t in near_copies(200, 13, 2, 150)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert {r.doc_id: r.component_id for r in report(df, shingle=2)} == fast_components(rows, 2)


def test_rows_of_one_id_with_different_texts(spark):
    rng = random.Random(2)
    one, two = (" ".join(f"{p}{rng.randrange(900)}" for _ in range(80)) for p in "xy")
    rows = [(1, one), (1, two), (5, one + " more"), (9, two + " more"), (3, "apart " + one[:100])]
    got = sorted((r.doc_id, r.component_id) for r in report(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle=2))
    assert got == [(1, 1), (1, 1), (3, 3), (5, 1), (9, 1)]


def test_signature_agreement_estimates_the_similarity():
    rng = np.random.default_rng(1)
    for n, common in ((400, 320), (20, 16), (5, 4)):
        hits = []
        for _ in range(60):
            both = rng.integers(0, 2**63, n + (n - common), dtype=np.uint64)
            x, y = np.sort(both[:n]), np.sort(both[n - common : 2 * n - common])
            a, b = (nd.signatures(s, np.array([0, len(s)]))[0] for s in (x, y))
            hits.append((a == b).mean())
        assert abs(np.mean(hits) - common / (2 * n - common)) < 0.05


def test_one_document_of_each_group_stays(spark):
    rows = [(3, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "q r s t u v w x")]
    kept = nd.drop_near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(300, 200)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.component for r in components(df)[0].collect()}
    assert all(got[i] == 1 for i in range(1, 41))
    assert all(got[100 + i] == 100 for i in range(30))
    assert got[300] == got[200] == 200
