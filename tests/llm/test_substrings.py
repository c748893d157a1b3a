import hashlib
import random

import pytest

from quire.llm import substrings as sb

from .plain import odd_rows, vocabulary, without_repeats


def key(r):
    return (r[0] is None, r[0] or 0, r[1:])


def expected(rows, width=13):
    return sorted(((i, len(w), len(w) - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest())
                   for i, w, k in without_repeats(rows, width)), key=key)


def test_odd_rows(odd):
    got = sorted((tuple(r) for r in sb.substring_report(odd).collect()), key=key)
    assert got == expected([r[:2] for r in odd_rows()])


def test_empty_table(empty):
    assert sb.substring_report(empty).collect() == []
    assert sb.drop_repeats(empty).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_at_all_offsets_equal_brute_force(spark, seed, monkeypatch):
    """Passages of lengths around the window, at random places, in few words."""
    rng = random.Random(seed)
    some = vocabulary(40)
    passages = [[rng.choice(some) for _ in range(n)] for n in (12, 13, 14, 19, 20, 26, 60)]
    rows = []
    for i in range(150):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += [rng.choice(some) for _ in range(rng.randint(0, 15))]
            text += rng.choice(passages)
        rows.append((i * 37 % 151, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted((tuple(r) for r in sb.substring_report(df).collect()), key=key)
    assert got == expected(rows)


def test_a_full_filter_changes_nothing(spark):
    rows = [(i, r[1]) for i, r in enumerate(odd_rows())]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    few = sb.repeated_windows(df, filter_bits=64).collect()
    many = sb.repeated_windows(df).collect()
    assert sorted(few) == sorted(many) and few


@pytest.mark.parametrize("period", range(1, 30))
def test_covers_have_every_difference(period):
    cover = sb.difference_cover(period)
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_texts_keep_their_other_columns(odd):
    got = sb.drop_repeats(odd)
    assert got.columns == odd.columns
    kept = {r.doc_id: r.text for r in got.where("doc_id is not null").collect()}
    want = {i: " ".join(k) if len(k) < len(w) else None for i, w, k in without_repeats([r[:2] for r in odd_rows()]) if i is not None}
    originals = {r[0]: r[1] for r in odd_rows()}
    assert kept == {i: originals[i] if want[i] is None else want[i] for i in originals if i is not None}


@pytest.mark.parametrize("parts", [1, 5])
def test_one_id_with_two_texts(spark, parts):
    """A long and a short text, and a clean one behind them in the same slice."""
    some = vocabulary(400)
    rng = random.Random(3)
    make = lambda n: [rng.choice(some) for _ in range(n)]
    passage, other = make(20), make(30)
    texts = [(1, passage + make(10) + other), (5, make(60) + passage + make(5)), (5, other + make(3)), (5, make(14)),
             (6, make(40)), (7, passage + make(2)), (7, make(30) + passage), (7, make(30) + passage), (8, make(13)), (9, make(20))]
    rows = [(i, " ".join(t)) for i, t in texts]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    got = sorted((tuple(r) for r in sb.substring_report(df).collect()), key=key)
    assert got == expected(rows)
    kept = sorted((r.doc_id, len(r.text.split())) for r in sb.drop_repeats(df).collect())
    assert kept == sorted((i, len(k)) for i, _, k in without_repeats(rows, 13))
