"""Epoch order, rank shards, batches and padding.

Every rule is arithmetic on a row's position in the epoch's order, so ranks and
batches need no grouping until the rows of a batch are finally put together.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .ordering import (
    MAX_BUCKETS, bucket_count, hex_buckets, lookup, place_in_runs, run_rows, with_global_index,
)


def expand_epochs(df: DataFrame, epochs: float) -> DataFrame:
    """Repeat the table once per started epoch; no epochs leave no rows."""
    if epochs < 0:
        raise ValueError("epochs must not be negative")
    passes = -int(-epochs // 1)
    if not passes:
        return df.withColumn("epoch", F.lit(0)).where(F.lit(False))
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))


def _mixed(df: DataFrame, key: list[str], seed: int, epoch) -> DataFrame:
    """Add `epoch` if it is fixed here, and the digest that orders the rows."""
    if epoch is not None:
        df = df.withColumn("epoch", F.lit(epoch) if isinstance(epoch, int) else epoch)
    text = F.concat_ws(":", F.lit(seed), "epoch", *key)
    return df.withColumn("_digest", F.md5(text))


def epoch_shuffle(
    df: DataFrame, key: list[str], seed: int = 0, epoch: Column | int | None = None,
    within: list[str] = ("epoch",), buckets: int | None = None,
) -> DataFrame:
    """Add `position` and `total` in a repeatable random order per epoch.

    Rows are ordered by a digest of seed, epoch and key. Digests spread evenly,
    so their leading digits split the order into equal ranges with no sampling.
    An evaluation table passes `epoch=0` to keep one order.
    """
    mixed = _mixed(df, key, seed, epoch)
    buckets = buckets or bucket_count(mixed.select("epoch").count(), df)
    return with_global_index(
        mixed, ["_digest", *key], list(within), "position", "total",
        bucket=hex_buckets("_digest", buckets),
    ).drop("_digest")


def shard_ranks(df: DataFrame, world_size: int) -> DataFrame:
    """Deal positions to ranks in turn, repeating rows from the start until
    every rank has equally many. Adds `rank`, `rank_position`, `rank_rows`."""
    rank_rows = F.ceil(F.col("total") / world_size)
    slots = F.sequence(F.col("position"), rank_rows * world_size - 1, F.col("total"))
    return (
        df.withColumn("rank_rows", rank_rows)
        .withColumn("_slot", F.explode(slots))
        .withColumn("rank", F.pmod("_slot", F.lit(world_size)).cast("int"))
        .withColumn("rank_position", F.floor(F.col("_slot") / world_size))
        .drop("_slot", "position", "total")
    )


def make_batches(df: DataFrame, batch_size: int, drop_last: bool) -> DataFrame:
    """Consecutive rows of a rank form a batch; training drops a short last one."""
    placed = df.withColumn("batch", F.floor(F.col("rank_position") / batch_size)).withColumn(
        "slot", F.pmod("rank_position", F.lit(batch_size)).cast("int")
    )
    if drop_last:
        placed = placed.where((F.col("batch") + 1) * batch_size <= F.col("rank_rows"))
    return placed


BATCH_GROUP = ("epoch", "rank", "batch")


def place_batches(
    df: DataFrame, key: list[str], world_size: int, batch_size: int, drop_last: bool,
    seed: int = 0, epoch: Column | int | None = None, max_chunks: int = MAX_BUCKETS,
) -> DataFrame:
    """Epoch order, ranks and batches in one move of the full rows.

    The same rows as `make_batches(shard_ranks(epoch_shuffle(...)))`. Batches of
    all ranks with the same number come from one stretch of the epoch's order.
    A pass over the keys finds where runs of such stretches ("chunks") begin;
    rows then go straight to their chunk and are numbered there. Collating by
    `CHUNK_GROUP` needs no second move.
    """
    mixed = _mixed(df, key, seed, epoch)
    rows = mixed.select("epoch").count()
    stretch = world_size * batch_size
    run = run_rows(rows, stretch, df, max_chunks)
    order = ["_digest", *key]
    # Ranks get equally many rows: the first `short` rows of an epoch are used
    # once more than the others.
    short = lambda total: F.pmod(F.ceil(total / world_size) * world_size, total)
    starts_run = lambda p, n: (F.pmod(p, F.lit(run)) == 0) | (p == short(n))
    chunk, starts = place_in_runs(
        mixed, order, ["epoch"], starts_run, rows, {"epoch": F.col("epoch")}, "_digest"
    )
    position = [s["_position"] for s in starts]
    total = [s["_total"] for s in starts]
    slots = [-(-n // world_size) * world_size for n in total]
    uses = [m // n + (p < m % n) for m, n, p in zip(slots, total, position)]
    # A start that is no multiple of `run` splits a chunk only to count uses.
    first = [i if p % run == 0 else i - 1 for i, p in enumerate(position)]
    last = {s["epoch"]: first[i] for i, s in enumerate(starts)}
    ends = [last[s["epoch"]] for s in starts]
    at = F.col("_start")
    used = (
        mixed.withColumn("_start", chunk)
        .withColumn("_use", F.explode(F.sequence(F.lit(0).cast("bigint"), lookup(uses, at) - 1)))
        .withColumn(
            "chunk", F.when(F.col("_use") == 0, lookup(first, at)).otherwise(lookup(ends, at))
        )
    )
    # Rows used again follow the last row of the epoch, in order.
    in_chunk = F.row_number().over(W.partitionBy("chunk").orderBy("_use", *order)) - 1
    slot = lookup(position, F.col("chunk")) + in_chunk
    placed = (
        used.withColumn("_slot", slot)
        .withColumn("rank_rows", lookup([m // world_size for m in slots], F.col("chunk")))
        .withColumn("rank", F.pmod("_slot", F.lit(world_size)).cast("int"))
        .withColumn("rank_position", F.floor(F.col("_slot") / world_size))
        .drop("_start", "_use", "_slot", "_digest")
    )
    return make_batches(placed, batch_size, drop_last)


CHUNK_GROUP = ("chunk", *BATCH_GROUP)


def collate_fixed(
    df: DataFrame, columns=("input_ids", "attention_mask", "label"), group=BATCH_GROUP
) -> DataFrame:
    """Stack equally long rows of a batch, in slot order."""
    rows = F.array_sort(F.collect_list(F.struct("slot", *columns))).alias("_rows")  # batch_size
    return df.groupBy(*group).agg(rows).select(
        *group, *[F.col(f"_rows.{c}").alias(c) for c in columns]
    )


def collate_padded(
    df: DataFrame, pad_id: int, ignore: int = -100, ids="input_ids", labels="labels",
    group=BATCH_GROUP,
) -> DataFrame:
    """Pad ids and labels on the right to the batch's longest row.

    The mask is true where the padded id is not the padding id.
    """
    rows = F.array_sort(F.collect_list(F.struct("slot", ids, labels)))  # batch_size rows
    stacked = df.groupBy(*group).agg(rows.alias("_rows"), F.max(F.size(ids)).alias("_longest"))

    def pad(column, value):
        return F.transform(
            f"_rows.{column}",
            lambda a: F.concat(a, F.array_repeat(F.lit(value), F.col("_longest") - F.size(a))),
        )

    padded = stacked.select(*group, pad(ids, pad_id).alias(ids), pad(labels, ignore).alias(labels))
    mask = F.transform(ids, lambda row: F.transform(row, lambda x: x != pad_id))
    return padded.withColumn("attention_mask", mask)


def step_plan(
    df: DataFrame, world_size: int, batch_size: int, accumulation: int, epochs: float,
    drop_last: bool = True, max_steps: int = 0, epochs_done: float = 0,
) -> DataFrame:
    """Per split: rows, rows and batches per rank, updates per epoch and in all."""
    rank_rows = F.ceil(F.col("num_rows") / world_size)
    batches = (F.floor if drop_last else F.ceil)(F.col("rank_rows") / batch_size)
    updates = F.floor(F.col("batches") / accumulation)
    planned = F.ceil((F.lit(float(epochs)) - epochs_done) * F.greatest("updates_per_epoch", F.lit(1)))
    return (
        df.groupBy("split")
        .agg(F.count("*").alias("num_rows"))
        .withColumn("rank_rows", rank_rows)
        .withColumn("batches", batches)
        .withColumn("updates_per_epoch", updates)
        .withColumn("total_steps", F.lit(max_steps).cast("bigint") if max_steps > 0 else planned)
    )
