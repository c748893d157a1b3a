"""Debug subsets, counts and column removal."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

SAMPLE_SIZES = {"train": 20, "validation": 10}  # Fixed values: default debug subset


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def head_per_split(df: DataFrame, order_by: list[str], sizes=None) -> DataFrame:
    """First rows of each named split; each is a distributed top-n."""
    sizes = SAMPLE_SIZES if sizes is None else sizes
    parts = [
        df.where(F.col("split") == name).orderBy(*order_by).limit(n) for name, n in sizes.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("num_rows"))
