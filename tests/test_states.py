import random

import pytest

from quire.operators import metrics as mt
from quire.session import new_path
from quire.streaming import states, streams

LOSSES = "rank int, epoch int, batch_idx int, loss double"
ROWS = [(r, e, b, random.Random(r * 100 + e * 10 + b).random()) for r in range(3) for e in range(3) for b in range(7 + r)]


def put(spark, path, rows, schema):
    for part in rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)


def rounded(rows):
    return sorted((r["rank"], r["step"], r["epoch"], round(r["loss"], 9)) for r in rows)


def test_losses_go_on_in_an_open_window(spark):
    """Two starts, cut in the middle of windows and epochs, and one file a trigger."""
    source, out = new_path(spark, "t"), new_path(spark, "t")
    for low, cuts in ((0, [(0, 3), (0, 9)]), (1, [(1, 4), (9, 9)])):
        before = (low, 0) if low else (-1, 0)
        parts = []
        for cut in cuts:
            parts.append([x for x in ROWS if before <= (x[1], x[2]) < cut])
            before = cut
        put(spark, source, [p for p in parts if p], LOSSES)
        stream = streams.read_stream(spark, source, LOSSES, files_per_trigger=1)
        states.append_stream(states.rolled_losses(stream, 4), out).awaitTermination()
    want = mt.loss_rollup(spark.createDataFrame(ROWS, LOSSES), 4).collect()
    assert rounded(spark.read.parquet(out).collect()) == rounded(want)


def test_late_rows(spark):
    source = new_path(spark, "t")
    rows = [(0, 0, b, float(b)) for b in range(6)]
    put(spark, source, [rows[:2] + rows[3:4], rows[2:3] + rows[4:]], LOSSES)
    stream = lambda: streams.read_stream(spark, source, LOSSES, files_per_trigger=1)
    out = new_path(spark, "t")
    states.append_stream(states.rolled_losses(stream(), 5), out).awaitTermination()
    assert rounded(spark.read.parquet(out).collect()) == [(0, 1, 0, round(sum(x[3] for x in rows if x[2] != 2) / 5, 9))]
    with pytest.raises(Exception, match="late rows"):
        states.append_stream(states.rolled_losses(stream(), 5, late="fail"), new_path(spark, "t")).awaitTermination()
    with pytest.raises(ValueError):
        states.rolled_losses(stream(), 5, late="keep")


def test_log_keeps_its_highest_step(spark):
    schema = "n bigint, run string, step bigint, note string"
    rng = random.Random(4)
    rows = [(i, rng.choice("ab"), None if i % 17 == 5 else i // 3 + rng.randrange(-4, 5), f"x{i}") for i in range(120)]
    source, out = new_path(spark, "t"), new_path(spark, "t")
    for part in ([rows[:30], rows[30:31]], [rows[31:90], rows[90:]]):
        put(spark, source, part, schema)
        stream = streams.read_stream(spark, source, schema, files_per_trigger=1)
        states.append_stream(states.monotonic_rows(stream, ["n"], ["run"]), out).awaitTermination()
    want = mt.monotonic_log(spark.createDataFrame(rows, schema), ["n"], ["run"]).collect()
    got = spark.read.parquet(out).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)
