"""Packing token sequences into fixed-length blocks.

Rows are grouped as a batched map over contiguous shards groups them: shards
of a split differ by at most one row, and batches never cross a shard. Inside a
batch all sequences are joined and cut; the rest of the batch is dropped, but a
batch shorter than one block stays as one short block.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import arrays as ar
from .ordering import MAX_BUCKETS, lookup, place_in_runs, run_rows, running_before

NUM_SHARDS, BATCH_ROWS, BLOCK_SIZE = 5, 1000, 512  # Fixed values: default sizes


def _shard_of(position: Column, total: Column, num_shards: int) -> tuple[Column, Column]:
    """Shard and row within the shard, for near-equal contiguous shards."""
    small = F.floor(total / num_shards)
    bigger = F.pmod(total, F.lit(num_shards))  # shards holding one row more
    big_rows = bigger * (small + 1)
    step = F.greatest(small, F.lit(1))
    in_big, after = position < big_rows, position - big_rows
    shard = F.when(in_big, F.floor(position / (small + 1))).otherwise(
        bigger + F.floor(after / step)
    )
    row = F.when(in_big, F.pmod(position, small + 1)).otherwise(F.pmod(after, step))
    return shard.cast("int"), row.cast("bigint")


def assign_batches(
    df: DataFrame,
    order_by: list[str],
    num_shards: int = NUM_SHARDS,
    batch_rows: int = BATCH_ROWS,
    max_chunks: int = MAX_BUCKETS,
) -> DataFrame:
    """Add `chunk`, `shard`, `batch` (per shard) and `row_in_shard`, by `split`.

    A first pass over the key columns alone finds the keys where runs of whole
    batches ("chunks") begin. Full rows are then moved once, by chunk, and the
    batches of a chunk are numbered in place. Grouping by `BATCH_KEYS`
    afterwards needs no further shuffle.
    """
    rows = df.select("split").count()
    run = run_rows(rows, batch_rows, df, max_chunks)

    def shard(position, total):
        return _shard_of(position, total, num_shards)[0]

    def row(position, total):
        return _shard_of(position, total, num_shards)[1]

    place = F.col("_position"), F.col("_total")
    chunk, starts = place_in_runs(
        df, order_by, ["split"], lambda p, n: F.pmod(row(p, n), F.lit(run)) == 0, rows,
        {"shard": shard(*place), "row": row(*place)},
    )
    at = F.col("chunk")
    in_chunk = F.row_number().over(W.partitionBy("chunk").orderBy(*order_by)) - 1
    return (
        df.withColumn("chunk", chunk.cast("int"))
        .withColumn("row_in_shard", lookup([s["row"] for s in starts], at) + in_chunk)
        .withColumn("shard", lookup([s["shard"] for s in starts], at).cast("int"))
        .withColumn("batch", F.floor(F.col("row_in_shard") / batch_rows).cast("int"))
    )


BATCH_KEYS = ["chunk", "split", "shard", "batch"]


def _fragments(ids: str, before: str, block_size: int) -> Column:
    """Parts of one sequence, one per block it reaches into."""
    end = F.col(before) + F.size(ids)
    first, last = F.floor(F.col(before) / block_size), F.floor((end - 1) / block_size)

    def part(block):
        low = F.greatest(block * block_size, F.col(before))
        high = F.least((block + 1) * block_size, end)
        return F.struct(
            block.alias("block"),
            low.alias("at"),
            F.slice(ids, (low - F.col(before) + 1).cast("int"), (high - low).cast("int")).alias("ids"),
        )

    return F.when(F.size(ids) > 0, F.transform(F.sequence(first, last), part))


def _blocks(placed: DataFrame, keys: list[str], ids: str, block_size: int) -> DataFrame:
    kept = F.greatest(F.floor(F.col("_tokens") / block_size), F.lit(1))
    parts = placed.select(
        *keys, kept.alias("_kept"), F.explode(_fragments(ids, "_before", block_size)).alias("_part")
    ).where(F.col("_part.block") < F.col("_kept"))
    joined = parts.groupBy(*keys, F.col("_part.block").alias("block")).agg(
        # At most block_size parts: each holds one token or more.
        F.array_sort(F.collect_list(F.struct("_part.at", "_part.ids"))).alias("_parts")
    )
    ids_out = F.flatten(F.col("_parts.ids"))
    return joined.select(*keys, F.col("block").cast("int").alias("block"), ids_out.alias("input_ids"))


def with_labels(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("attention_mask", ar.ones_mask(F.col("input_ids"))).withColumn(
        "label", F.col("input_ids")
    )


def _in_batch(df: DataFrame, order_by, ids: str) -> DataFrame:
    batch = W.partitionBy(*BATCH_KEYS)
    upto = batch.orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1)
    size = F.size(ids).cast("bigint")
    return df.select(
        *BATCH_KEYS,
        ids,
        F.coalesce(F.sum(size).over(upto), F.lit(0)).alias("_before"),
        F.sum(size).over(batch).alias("_tokens"),
    )


def pack_blocks(
    df: DataFrame, order_by: list[str], block_size: int = BLOCK_SIZE, ids: str = "input_ids"
) -> DataFrame:
    """Blocks of `block_size` per batch, from rows that `assign_batches` placed.

    Works on one row per (sequence, block) rather than one per token.
    """
    return with_labels(_blocks(_in_batch(df, order_by, ids), BATCH_KEYS, ids, block_size))


def pack_global(
    df: DataFrame, order_by: list[str], block_size: int = BLOCK_SIZE, ids: str = "input_ids"
) -> DataFrame:
    """One running sequence per split: only the very last tokens are dropped.

    Sequence lengths are read in an earlier pass, so store tokens first if
    making them is costly.
    """
    size = F.size(ids).cast("bigint")
    placed = running_before(
        df.select("split", *order_by, ids), order_by, size, "_before", ["split"], total="_tokens"
    )
    return with_labels(_blocks(placed, ["split"], ids, block_size))


def pack_report(df: DataFrame, block_size: int = BLOCK_SIZE, ids: str = "input_ids") -> DataFrame:
    """Per batch: rows, tokens in, tokens kept, tokens dropped, blocks."""
    tokens = F.col("tokens_in")
    whole = F.floor(tokens / block_size) * block_size
    kept = F.when(tokens >= block_size, whole).otherwise(tokens)
    return (
        df.groupBy(*BATCH_KEYS)
        .agg(F.count("*").alias("num_rows"), F.sum(F.size(ids)).alias("tokens_in"))
        .select(
            "split", "shard", "batch", "num_rows", "tokens_in",
            kept.alias("tokens_kept"),
            (tokens - kept).alias("tokens_dropped"),
            F.ceil(kept / block_size).alias("blocks"),
        )
    )
