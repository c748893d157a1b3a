import random

from quire.llm import decontamination as dc

from .plain import contamination, odd_rows, vocabulary

ITEMS = "item_id bigint, text string"


def run(spark, docs, items, **kw):
    bench = spark.createDataFrame(items, ITEMS)
    rows = dc.mark_contamination(docs.select("doc_id", "text"), bench, "found", **kw).collect()
    return sorted(((r.doc_id, r.found.n_words, r.found.n_hit, r.found.item_ids) for r in rows), key=repr)


def plain(rows, items):
    return sorted(((i, *contamination(t, items)) for i, t in rows), key=repr)


def test_odd_rows(spark, odd):
    rows = [r[:2] for r in odd_rows()]
    long_text = rows[5][1]
    items = [(1, " ".join(long_text.split()[20:45])), (2, "ONE"), (3, None), (4, ""), (None, "one"), (5, "c a"),
             (6, " ".join(long_text.split()[20:45])), (7, "你好"), (7, "été")]
    want = plain(rows, items)
    assert run(spark, odd, items) == want
    # The same in many passes over small parts of the benchmark.
    assert run(spark, odd, items, block_bytes=40) == want


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(4)
    some = vocabulary(12)
    rows = [(i, " ".join(rng.choice(some) for _ in range(rng.choice([0, 1, 9, 10, 11, 700])))) for i in range(40)]
    items = [(i, " ".join(rng.choice(some) for _ in range(n))) for i, n in enumerate([1, 2, 3, 4, 5, 9, 10, 11, 30])]
    for i, at in ((100, 3), (101, 200)):
        words = rows[5][1].split() or ["w0"]
        rows.append((i, " ".join(words + items[8][1].split()[at % 15 : at % 15 + 12] + words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert run(spark, df, items) == plain(rows, items)


def test_empty_tables(spark, odd, empty):
    assert run(spark, empty, [(1, "a b")]) == []
    assert all(n == 0 and not ids for _, _, n, ids in run(spark, odd, []))


def test_documents_go_and_columns_stay(spark, odd):
    bench = spark.createDataFrame([(1, "ONE")], ITEMS)
    kept = dc.drop_contaminated(odd, bench)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in odd.collect()} - {r.doc_id for r in kept.collect()} == {4, 5}
