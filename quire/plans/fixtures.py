"""How the given tables stand in for corpora, records, losses and predictions."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.tokenize import cut_runs
from ..operators.vocab import top_word_vocab, word_counts
from ..session import cut_lineage, shared_folder
from ..sources.processed import reuse_or_compute


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark, sf_dir, *columns, name="documents") -> DataFrame:
    """Text columns, dealt out over the cores when the table has fewer files
    than that. Tables of many files stay as they lie and move nothing."""
    rows = table(spark, sf_dir, name).select(*columns)
    width = spark.sparkContext.defaultParallelism
    return rows.repartition(width) if len(rows.inputFiles()) < width else rows


def split_of(key):
    digit = F.pmod(key, F.lit(10))
    return F.when(digit == 0, "validation").when(digit == 1, "test").otherwise("train")


def documents(spark, sf_dir) -> DataFrame:
    docs = texts(spark, sf_dir, "doc_id", "text")
    return docs.withColumn("split", split_of(F.col("doc_id")))


def stored_vocabulary(spark, name, settings, compute) -> DataFrame:
    """A vocabulary computed once per application and read again afterwards."""
    context = spark.sparkContext
    folder = f"{shared_folder(spark)}/quire/{context.applicationId}/{name}"
    stored = reuse_or_compute(
        spark, folder, settings, lambda: compute().withColumn("split", F.lit("all"))
    )
    return stored.drop("split")


def word_vocabulary(spark, sf_dir, vocab_size=30000) -> DataFrame:
    def compute():
        counts = cut_lineage(word_counts(texts(spark, sf_dir, "text"), "text"))
        return top_word_vocab(counts, vocab_size)

    settings = {"sf_dir": sf_dir, "vocab_size": vocab_size}
    return stored_vocabulary(spark, "words", settings, compute)


def instruction_records(spark, sf_dir) -> DataFrame:
    """User turn and the assistant turn after it; a system turn just before is
    the input.

    Each turn is sent to the number of the user turn it can belong to, so the
    groups are single records even when one conversation holds most turns.
    """
    turns = table(spark, sf_dir, "conversations")
    role, text = F.col("role"), F.col("text")
    shift = F.when(role == "assistant", -1).when(role == "system", 1).otherwise(0)
    return (
        turns.groupBy("conv_id", (F.col("turn") + shift).alias("turn"))
        .agg(
            F.max(F.when(role == "user", text)).alias("instruction"),
            F.max(F.when(role == "system", text)).alias("input"),
            F.max(F.when(role == "assistant", text)).alias("output"),
        )
        .where(F.col("instruction").isNotNull() & F.col("output").isNotNull())
    )


def batch_losses(spark, sf_dir) -> DataFrame:
    """Event values as batch losses of 4 ranks and 3 epochs."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.pmod("event_id", F.lit(4)).cast("int").alias("rank"),
        F.pmod(F.floor(F.col("event_id") / 4), F.lit(3)).cast("int").alias("epoch"),
        F.floor(F.col("event_id") / 12).cast("int").alias("batch_idx"),
        F.col("value").alias("loss"),
    )


#: Bytes of text whose characters are numbered at once.
SLICE_BYTES = 4 << 20
_LABELS = "struct<y_pred:array<int>,y_true:array<int>>"


def _labels(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Code points of texts, and their mixed copy: every third place has its own
    point, the others have the next one (0 behind the last)."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch), 0).to_numpy(zero_copy_only=False)
        for start, stop in cut_runs(sizes, SLICE_BYTES):
            texts = batch.slice(start, stop - start)
            rows = [np.frombuffer((t or "").encode("utf-32-le"), "<i4") for t in texts.to_pylist()]
            rows = [r[r > 0] for r in rows]
            n = np.array([len(r) for r in rows], np.int64)
            true = np.concatenate([*rows, np.zeros(1, np.int32)])
            ends = np.cumsum(n)
            following = true[1:].copy()
            following[ends[n > 0] - 1] = 0
            place = np.arange(len(following)) - np.repeat(ends - n, n)
            pred = np.where(place % 3 == 0, true[:-1], following)
            offsets = pa.array(np.append(0, ends).astype(np.int32))
            mask = texts.is_null() if texts.null_count else None
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32()), mask=mask) for x in (pred, true[:-1])]
            yield pa.StructArray.from_arrays(lists, ["y_pred", "y_true"])


def predictions(spark, sf_dir) -> DataFrame:
    """Document characters as labels, a mixed copy as predictions, 8 rows a batch."""
    docs = texts(spark, sf_dir, "doc_id", "text")
    rows = docs.select("doc_id", F.arrow_udf(_labels, _LABELS)(F.col("text")).alias("labels"))
    batch_id = F.floor(F.col("doc_id") / 16).cast("int")
    return rows.select(
        F.pmod("doc_id", F.lit(2)).cast("int").alias("rank"), batch_id.alias("batch_id"), "doc_id",
        "labels.y_pred", "labels.y_true", (batch_id % 7 + 0.5).alias("loss"),
    )
