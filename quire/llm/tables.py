"""Small Spark helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of text in the whole table."""
    return df.select(F.sum(F.octet_length(column))).first()[0] or 0


def fresh(df: DataFrame, name: str) -> str:
    """A column name like `name` that `df` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def buckets_for(spark: SparkSession, size: int, per_bucket: int, per_task: int = 2) -> int:
    """Hash buckets of at most about `per_bucket` each, some for each task."""
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(per_task * tasks, -(-size // per_bucket))
