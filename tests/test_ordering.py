import random

import pytest
from pyspark.sql import functions as F

from quire.operators.ordering import (
    ROWS_PER_BUCKET, hex_buckets, run_rows, running_before, with_global_index,
)
from quire.operators.packing import assign_batches


def test_positions_follow_a_composite_key_over_many_buckets(spark):
    rows = [(g, k) for g in ("a", "b", "c") for k in range(400)]
    rows += [("hot", k) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, k long").repartition(7)
    got = with_global_index(df, ["g", "k"], buckets=13, total="n").collect()
    assert {(r.g, r.k): r.position for r in got} == {p: i for i, p in enumerate(sorted(rows))}
    assert {r.n for r in got} == {len(rows)}


@pytest.mark.parametrize("buckets", [1, 2, 9])
def test_running_sum_and_max_within_groups(spark, buckets):
    rng = random.Random(3)
    rows = [(g, k, rng.randrange(50)) for g in "xy" for k in range(200)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    sums = running_before(df, ["k"], F.col("v"), "s", ["g"], buckets=buckets, total="t").collect()
    tops = running_before(df, ["k"], F.col("v"), "s", ["g"], "max", buckets=buckets).collect()
    by = {(g, k): [v for h, j, v in rows if h == g and j < k] for g, k, _ in rows}
    assert all(r.s == sum(by[r.g, r.k]) for r in sums)
    assert all(r.t == sum(v for g, _, v in rows if g == r.g) for r in sums)
    assert all(r.s == max(by[r.g, r.k], default=None) for r in tops)


def test_digest_order_needs_no_sample(spark):
    df = spark.range(500).withColumn("d", F.md5(F.col("id").cast("string")))
    got = with_global_index(df, ["d"], bucket=hex_buckets("d", 37)).collect()
    assert [r.d for r in sorted(got, key=lambda r: r.position)] == sorted(r.d for r in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "k long")
    assert with_global_index(df, ["k"]).count() == 0


KEYS = {
    "timestamp": ("timestamp", lambda i: f"timestamp_micros({1_700_000_000_000_000 + i})"),
    "ntz": ("timestamp_ntz", lambda i: f"timestamp_ntz'2024-01-01 00:00:00.{i:06d}'"),
    "decimal": ("decimal(30,3)", lambda i: f"cast('123456789012345678901234{i:03d}.{i % 1000:03d}' as decimal(30,3))"),
    "string": ("string", lambda i: f"'k \"{i:04d}\\\\ ü'"),
    "date": ("date", lambda i: f"date_add(date'1990-01-01', {i})"),
    "double": ("double", lambda i: f"double({i} / 7.0)"),
    "binary": ("binary", lambda i: f"unhex('{i:06X}FF')"),
    "long": ("bigint", lambda i: f"{9_007_199_254_740_993 + i}"),
    "null first": ("int", lambda i: "cast(null as int)" if i == 0 else str(i)),
}


@pytest.mark.parametrize("name", KEYS)
def test_batches_are_exact_for_any_key_type(spark, name):
    kind, value = KEYS[name]
    n, shards, batch = 600, 3, 10
    values = ", ".join(f"({i}, {value(i)})" for i in random.Random(1).sample(range(n), n))
    df = spark.sql(f"SELECT 'train' AS split, i, cast(k AS {kind}) AS k FROM VALUES {values} AS t(i, k)").repartition(5)
    placed = assign_batches(df, ["k"], shards, batch).collect()
    size = n // shards
    assert {r.i: (r.shard, r.batch, r.row_in_shard) for r in placed} == {
        i: (i // size, i % size // batch, i % size) for i in range(n)
    }


def test_a_composite_key_with_nulls_and_time_zones(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        # The hour that clocks repeat in autumn: local times don't tell its halves apart.
        start = 1_698_537_600_000_000
        rows = [(g, i) for g in (None, "a", "b") for i in range(200)]
        df = spark.createDataFrame(rows, "g string, i int").selectExpr(
            "'train' AS split", "g", "i", f"timestamp_micros({start} + bigint(i) * 60000001) AS k")
        placed = assign_batches(df, ["g", "k"], 2, 7).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    place = {(r.g, r.i): (r.shard, r.row_in_shard) for r in placed}
    assert place == {row: (at // 300, at % 300) for at, row in enumerate(rows)}


def test_a_key_that_repeats_is_refused(spark):
    df = spark.createDataFrame([("train", i // 7) for i in range(700)], "split string, k int")
    with pytest.raises(ValueError, match="unique"):
        assign_batches(df, ["k"], 5, 10)


def test_runs_follow_the_rows_of_a_task_not_the_batch(spark):
    df = spark.range(10)
    width = spark.sparkContext.defaultParallelism
    for rows, unit in ((100_000, 8), (100_000, 1000), (50_000_000, 8)):
        run = run_rows(rows, unit, df)
        assert run % unit == 0
        assert -(-rows // run) <= max(4 * width, -(-rows // ROWS_PER_BUCKET)) + 1
