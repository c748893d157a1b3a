import random

import pytest

from quire.operators import packing as pk


def plain_shards(n, shards):
    small, more = divmod(n, shards)
    edges = [i * small + min(i, more) for i in range(shards + 1)]
    return [list(range(a, b)) for a, b in zip(edges, edges[1:])]


def plain_blocks(rows, block, shards, batch):
    """{(split, shard, batch): blocks} from ordered (split, ids)."""
    out = {}
    for split in {s for s, _ in rows}:
        seqs = [ids for s, ids in rows if s == split]
        for shard, at in enumerate(plain_shards(len(seqs), shards)):
            for b in range(0, len(at), batch):
                flat = [t for i in at[b : b + batch] for t in seqs[i]]
                end = len(flat) // block * block if len(flat) >= block else len(flat)
                out[split, shard, b // batch] = [flat[i : i + block] for i in range(0, end, block)]
    return {k: v for k, v in out.items() if v}


def run(spark, rows, block, shards, batch, **options):
    df = spark.createDataFrame(
        [(s, i, ids) for i, (s, ids) in enumerate(rows)], "split string, k int, input_ids array<int>"
    ).repartition(3)
    placed = pk.assign_batches(df, ["k"], shards, batch, **options)
    got = {}
    for r in pk.pack_blocks(placed, ["k"], block).orderBy("block").collect():
        got.setdefault((r.split, r.shard, r.batch), []).append(r.input_ids)
        assert r.label == r.input_ids and r.attention_mask == [1] * len(r.input_ids)
    return got


def test_remainder_short_block_and_two_batches(spark):
    five = [("a", [3 * i, 3 * i + 1, 3 * i + 2]) for i in range(5)]
    assert run(spark, five, 4, 1, 1000) == {("a", 0, 0): [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9, 10, 11]]}
    assert run(spark, [("a", [7, 8, 9])], 4, 1, 1000) == {("a", 0, 0): [[7, 8, 9]]}
    two = run(spark, five, 4, 1, 3)
    assert sum(len(b) for b in two.values()) == 3 and sum(len(x) for b in two.values() for x in b) == 12
    assert run(spark, [("a", [])], 4, 1, 3) == {} == run(spark, [], 4, 1, 3)


def test_three_rows_five_shards(spark):
    got = run(spark, [("a", [i]) for i in range(3)], 4, 5, 1000)
    assert got == {("a", s, 0): [[s]] for s in range(3)}


@pytest.mark.parametrize("seed,chunks", [(0, 65536), (1, 3), (2, 1), (3, 7)])
def test_packing_equals_the_plain_rule(spark, seed, chunks):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["train"] * 5 + ["test"]), [rng.randrange(99)] * rng.choice([0, 1, 3, 9, 200]))
        for _ in range(150)
    ]
    for block, shards, batch in ((8, 5, 10), (64, 2, 7), (1, 3, 1000)):
        got = run(spark, rows, block, shards, batch, max_chunks=chunks)
        assert got == plain_blocks(rows, block, shards, batch)


def test_one_sequence_holds_most_tokens(spark):
    rows = [("a", [i]) for i in range(20)] + [("a", list(range(5000)))]
    assert run(spark, rows, 16, 1, 1000) == plain_blocks(rows, 16, 1, 1000)


def test_global_packing_drops_only_the_end(spark):
    rng = random.Random(9)
    rows = [("ab"[i % 2], i, [i] * rng.randrange(12)) for i in range(80)]
    df = spark.createDataFrame(rows, "split string, k int, input_ids array<int>").repartition(4)
    got = pk.pack_global(df, ["k"], 16).orderBy("split", "block").collect()
    for split in "ab":
        flat = [t for s, _, ids in rows if s == split for t in ids]
        kept = [t for r in got if r.split == split for t in r.input_ids]
        assert kept == flat[: len(flat) // 16 * 16]


def test_report(spark):
    df = spark.createDataFrame(
        [("a", 0, [1] * 10), ("a", 1, [1] * 3)], "split string, k int, input_ids array<int>"
    )
    row = pk.pack_report(pk.assign_batches(df, ["k"], 1), 4).first()
    assert (row.num_rows, row.tokens_in, row.tokens_kept, row.tokens_dropped, row.blocks) == (2, 13, 12, 1, 3)
