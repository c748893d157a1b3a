import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from quire.operators import batches as bt


def plain_order(keys, seed, epoch):
    digest = lambda k: hashlib.md5(f"{seed}:{epoch}:{k}".encode()).hexdigest()
    return sorted(keys, key=lambda k: (digest(k), k))


def plain_ranks(order, world):
    slots = math.ceil(len(order) / world) * world
    padded = (order * (slots // len(order) + 1))[:slots]
    return {r: padded[r::world] for r in range(world)}


@pytest.mark.parametrize("rows,world,size", [(10, 4, 2), (5, 1, 2), (3, 8, 1), (29, 3, 4)])
def test_order_ranks_and_batches(spark, rows, world, size):
    df = bt.expand_epochs(spark.range(rows), 1.5)
    placed = bt.shard_ranks(bt.epoch_shuffle(df, ["id"], 7), world).cache()
    train = bt.make_batches(placed, size, True).collect()
    full = bt.make_batches(placed, size, False).collect()
    for epoch in (0, 1):
        want = plain_ranks(plain_order(range(rows), 7, epoch), world)
        for rank, ids in want.items():
            mine = sorted((r for r in full if (r.epoch, r.rank) == (epoch, rank)),
                          key=lambda r: (r.batch, r.slot))
            assert [r.id for r in mine] == ids
            assert max(r.batch for r in mine) + 1 == math.ceil(len(ids) / size)
            kept = [r for r in train if (r.epoch, r.rank) == (epoch, rank)]
            assert len(kept) == len(ids) // size * size


@pytest.mark.parametrize(
    "rows,world,size,chunks", [(10, 4, 2, 9), (3, 8, 1, 9), (97, 3, 4, 2), (64, 4, 4, 99), (1, 5, 2, 1), (0, 2, 2, 9)]
)
@pytest.mark.parametrize("drop_last", [True, False])
def test_one_move_gives_the_same_batches(spark, rows, world, size, chunks, drop_last):
    df = bt.expand_epochs(spark.range(rows).repartition(3), 2)
    steps = bt.make_batches(
        bt.shard_ranks(bt.epoch_shuffle(df, ["id"], 5), world), size, drop_last
    )
    once = bt.place_batches(df, ["id"], world, size, drop_last, 5, max_chunks=chunks)
    columns = ["epoch", "rank", "batch", "slot", "id", "rank_rows", "rank_position"]
    assert sorted(steps.select(columns).collect()) == sorted(once.select(columns).collect())
    spread = once.groupBy("epoch", "rank", "batch").agg(F.count_distinct("chunk").alias("n"))
    assert not spread.where("n > 1").count()


def test_wrapped_rows_and_fixed_eval_order(spark):
    one = bt.epoch_shuffle(spark.range(10), ["id"], 3, epoch=0)
    two = bt.epoch_shuffle(spark.range(10), ["id"], 3, epoch=0)
    assert sorted(one.collect()) == sorted(two.collect())
    ranks = bt.shard_ranks(one, 4)
    assert ranks.count() == 12
    twice = ranks.groupBy("id").count().where("count = 2").collect()
    first = one.where("position < 2").collect()
    assert {r.id for r in twice} == {r.id for r in first}


def test_padding(spark):
    rows = [(0, 0, 0, s, list(range(1, n + 1)), [-100] * (n - 1) + [n]) for s, n in ((1, 4), (0, 2))]
    df = spark.createDataFrame(
        rows, "epoch int, rank int, batch int, slot int, input_ids array<int>, labels array<int>"
    )
    row = bt.collate_padded(df, pad_id=0).first()
    assert row.input_ids == [[1, 2, 0, 0], [1, 2, 3, 4]]
    assert row.labels == [[-100, 2, -100, -100], [-100, -100, -100, 4]]
    assert row.attention_mask == [[True, True, False, False], [True] * 4]
    with pytest.raises(TypeError):
        bt.collate_padded(df)


def test_fixed_stacking_keeps_slot_order(spark):
    rows = [(0, 0, 0, s, [s], [1], [s]) for s in (3, 1, 0, 2)]
    df = spark.createDataFrame(
        rows, "epoch int, rank int, batch int, slot int, input_ids array<int>, "
        "attention_mask array<int>, label array<int>"
    )
    row = bt.collate_fixed(df).first()
    assert row.input_ids == [[0], [1], [2], [3]] == row.label and row.attention_mask == [[1]] * 4


def test_step_plan(spark):
    df = spark.createDataFrame([("train",)] * 101 + [("validation",)] * 3, "split string")
    rows = {r.split: r for r in bt.step_plan(df, 2, 3, 4, 2.5).collect()}
    assert rows["train"][1:] == (101, 51, 17, 4, 10)
    assert rows["validation"][1:] == (3, 2, 0, 0, 3)
    capped = bt.step_plan(df, 2, 3, 4, 2.5, max_steps=7).first()
    assert capped.total_steps == 7
    later = {r.split: r for r in bt.step_plan(df, 2, 3, 4, 2.5, False, epochs_done=1).collect()}
    assert later["train"].total_steps == 6 and later["validation"].batches == 1


def test_no_epochs_leave_no_rows(spark):
    df = spark.range(3)
    assert bt.expand_epochs(df, 0).count() == 0 and bt.expand_epochs(df, 0).columns == ["id", "epoch"]
    assert bt.expand_epochs(df, 0.1).count() == 3
    with pytest.raises(ValueError):
        bt.expand_epochs(df, -1)
