"""The same operators on unbounded tables.

Sentence cutting, rendering and tokenizing are row-wise and accept a stream as
they are. Counts keep state; packing works on each micro-batch.

What a stream has read is noted in its checkpoint folder. It belongs to the
output: by default it lies beside it, as `<path>.checkpoint`, so a second start
goes on where the first one ended.
"""

from pyspark.sql import DataFrame, SparkSession

from ..operators.packing import assign_batches, pack_blocks
from ..operators.sentences import split_sentences
from ..operators.vocab import word_counts
from ..sources.files import _exists, _file_system


def read_stream(spark: SparkSession, folder: str, schema, fmt="parquet", pattern="*",
                files_per_trigger: int | None = None) -> DataFrame:
    """New files of a folder as a stream, oldest first, so many in a micro-batch.

    A path that names one file streams that file of its folder.
    """
    system, path = _file_system(spark, folder)
    if system.exists(path) and not system.getFileStatus(path).isDirectory():
        folder, pattern = folder.rstrip("/").rsplit("/", 1)
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def _beside(path: str, checkpoint: str | None) -> str:
    return checkpoint or f"{path.rstrip('/')}.checkpoint"


def stream_sentences(stream: DataFrame, path: str, checkpoint: str | None = None, **options):
    """Append sentences of arriving texts to `path`; ends when all is read."""
    return (
        split_sentences(stream, **options)
        .writeStream.format("parquet")
        .option("checkpointLocation", _beside(path, checkpoint))
        .trigger(availableNow=True)
        .start(path)
    )


def stream_word_counts(stream: DataFrame, path: str, col="sentence", checkpoint: str | None = None):
    """Running word counts; each trigger replaces the table at `path`."""

    def save(table, batch_id):
        table.write.mode("overwrite").parquet(path)

    return (
        word_counts(stream, col)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", _beside(path, checkpoint))
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )


def stream_blocks(
    stream: DataFrame, path: str, order_by: list[str], block_size: int,
    checkpoint: str | None = None, **batches,
):
    """Pack each micro-batch of token rows on its own and append its blocks.

    A micro-batch writes its own folder, so one that is repeated after a failure
    replaces itself. Blocks without the checkpoint they were written under are
    another run's, and an error.
    """
    noted = _beside(path, checkpoint)
    if _exists(stream.sparkSession, f"{path}/micro_batch=*") and not _exists(stream.sparkSession, f"{noted}/*"):
        raise ValueError(f"{path} holds blocks that were not written under {noted}")

    def save(rows, batch_id):
        # The micro-batch is read by several jobs, so it is stored while they run.
        stored = rows.persist()
        placed = assign_batches(stored, order_by, **batches)
        blocks = pack_blocks(placed, order_by, block_size)
        blocks.write.mode("overwrite").parquet(f"{path}/micro_batch={batch_id}")
        stored.unpersist()

    return (
        stream.writeStream.option("checkpointLocation", noted)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )
