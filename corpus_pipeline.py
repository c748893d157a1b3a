"""From raw documents to a training mix, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's documents. All but the last return
the columns of documents; the last adds how often each document is taken.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from quire.llm import decontamination, mixing, near_duplicates, quality_rules, substrings
from quire.llm.tables import fresh
from quire.session import drop_stored, store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words,
    similarity 0.8 or more, the least doc_id stays."""
    return near_duplicates.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 13 words and more that an earlier document
    holds; n_chars follows the text."""
    cut = substrings.drop_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with their size, their source's size and
    target, and how often (repeats) and with how many words (taken) they enter."""
    name = fresh(docs, "mix")
    rows = mixing.mix(docs, name)
    fields = ("size", "source_size", "target", "repeats", "taken")
    return rows.where(F.col(name)["repeats"] > 0).select(
        *docs.columns, *(F.col(name)[f].alias(fresh(docs, f)) for f in fields))


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_dedup),
    ("substrings", substring_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
]

#: The posterior of the quality rules isn't expressible in SQL; the stages are
#: tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of the table of documents."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs, path = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:
            drop_stored(spark, before)
        before = path
    return docs
