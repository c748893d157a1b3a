import random

import pytest
from pyspark.sql import functions as F

from quire.llm import mixing

from .plain import odd_rows, words


def water_fill(sizes, weights, share, most):
    """Targets by clamping full sources and resharing, until all fit."""
    total, full = share * sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in full]
        left = total - sum(most * sizes[i] for i in full)
        level = left / sum(weights[i] for i in free) if free else 0
        over = [i for i in free if weights[i] * level > most * sizes[i]]
        if not over:
            return [most * s if i in full else min(weights[i] * level, most * s) for i, s in enumerate(sizes)]
        full.update(over)


def result(df):
    return mixing.mixing_report(df).collect()


def test_odd_rows(odd):
    rows = odd_rows()
    names = sorted({r[3] for r in rows if r[3] is not None}) + [None]
    sizes = [sum(len(words(t)) for _, t, _, s in rows if s == name) for name in names]
    targets = dict(zip(names, water_fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2.0)))
    got = mixing.mix(odd, "m").select("doc_id", "text", "source", "m.*").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["size"] == len(words(r.text))
        assert r.source_size == sizes[names.index(r.source)]
        assert r.target == pytest.approx(targets[r.source])
        assert r.taken == r["size"] * r.repeats and 0 <= r.repeats <= 2
    again = mixing.mix(odd.repartition(7), "m").select("doc_id", "text", "source", "m.*").collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_empty_table(empty):
    assert result(empty) == []


@pytest.mark.parametrize("seed", range(3))
def test_targets_are_the_filled_levels_and_sources_meet_them(spark, seed, monkeypatch):
    monkeypatch.setattr(mixing, "PER_SLICE", 50)
    rng = random.Random(seed)
    rows = []
    for s in range(rng.randint(1, 7)):
        for _ in range(rng.choice([1, 30, 400])):
            rows.append((len(rows), " ".join(["w"] * rng.choice([0, 1, 10, 40])), f"s{s}"))
    got = result(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    names = sorted({r[2] for r in rows})
    sizes = [sum(len(words(t)) for _, t, s in rows if s == n) for n in names]
    want = water_fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5, 2.0)
    by_id = {r.doc_id: r for r in got}
    for name, target in zip(names, want):
        mine = [by_id[i] for i, _, s in rows if s == name]
        assert all(r.target == pytest.approx(target) for r in mine)
        assert abs(sum(r.taken for r in mine) - target) <= 21
        assert all(r.taken <= 2 * r["size"] for r in mine)


def test_own_weights(spark):
    rows = [(i, "a b c d", "xy"[i % 2]) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    weight = F.when(F.col("source") == "x", 3.0).otherwise(1.0)
    got = mixing.mix(df, "m", weight=weight, share=0.5, most_epochs=4.0).select("source", "m.target").distinct().collect()
    assert {r.source: r.target for r in got} == {"x": 150.0, "y": 50.0}


def test_texts_of_one_doc_id_are_taken_apart(spark):
    """A doc_id that holds most of a source's words doesn't move its target."""
    rows = [(7, " ".join([f"w{i}"] * 20), "a") for i in range(300)] + [(1000 + i, "x y z v " * 5, "a") for i in range(200)]
    rows += [(5000 + i, "b " * 10, "b") for i in range(100)]
    got = result(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    for size in (10_000, 1000):
        mine = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 20
