"""Vocabulary files: one `piece<TAB>score` per line, id = line number."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.vocab import check_size



def read_vocab(spark: SparkSession, path: str, origin: str = "base") -> DataFrame:
    """Lines end at a newline only: pieces may hold carriage returns and quotes.

    A vocabulary is one small file. It is read whole so that line numbers hold
    whatever the split size.
    """
    text = spark.read.text(path, wholetext=True)
    if len(text.inputFiles()) != 1:
        raise ValueError("a vocabulary is one file: line numbers are its ids")
    body = F.regexp_replace("value", "\n\\z", "")
    lines = text.select(F.posexplode(F.split(body, "\n")).alias("id", "line"))
    return lines.select(
        F.col("id").cast("int").alias("id"),
        F.regexp_replace("line", r"(?s)\t[^\t]*\z", "").alias("piece"),
        F.substring_index("line", "\t", -1).cast("double").alias("score"),
        F.lit(origin).alias("origin"),
    )


def write_vocab(vocab: DataFrame, path: str) -> None:
    """Write in id order as one file, the form other tools read."""
    line = F.concat_ws("\t", "piece", F.col("score").cast("string"))
    check_size(vocab).coalesce(1).sortWithinPartitions("id").select(line).write.text(path)
