"""Vocabulary tables: counting, coverage, merging, reports.

A vocabulary is (id INT, piece STRING, score DOUBLE, origin STRING). Ids are
token ids of a model, so the table is limited by `MAX_PIECES`; operators that
hold one in memory check that first.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions import text as tx

MAX_PIECES = 1_000_000
MAX_PIECE_BYTES = 64_000_000
UNKNOWN_CHAR = "▅"  # Fixed value: stands for characters outside the coverage
SPECIAL_PIECES = ["<unk>", "<s>", "</s>"]  # Fixed values, ids 0 to 2
FIRST_BYTE_ID = 3  # Fixed value: id of <0x00>; the 256 byte pieces are consecutive
FIRST_WORD_ID = FIRST_BYTE_ID + 256


def check_size(vocab: DataFrame, limit: int = MAX_PIECES) -> DataFrame:
    """The vocabulary, or ValueError when it is too large to hold."""
    size = vocab.agg(F.count("*").alias("n"), F.sum(F.octet_length("piece")).alias("bytes")).first()
    if size.n > limit or (size.bytes or 0) > MAX_PIECE_BYTES:
        raise ValueError(f"vocabulary of {size.n} pieces, {size.bytes} bytes is too large to hold")
    return vocab


def check_bounded(vocab: DataFrame, limit: int = MAX_PIECES) -> list:
    return check_size(vocab, limit).collect()


def most_common(counts: DataFrame, k: int, count: str = "count", name: str = "word") -> DataFrame:
    """The `k` rows with the highest counts, ties by name.

    Sorting would bring the best k of every partition to one task. How often
    each count occurs gives the k-th count first, so only rows that can be among
    the k best are sorted. `counts` is read twice; store it before.
    """
    if k <= 0:
        return counts.limit(0)
    how_often = counts.groupBy(count).agg(F.count("*").alias("_rows"))
    through = F.sum("_rows").over(W.orderBy(F.desc(count)))  # distinct counts, few
    last = (
        how_often.orderBy(F.desc(count)).limit(k)
        .select(count, (through - F.col("_rows")).alias("_above"))
        .where(F.col("_above") < k)
        .agg(F.min(count)).first()[0]
    )
    if last is None:
        return counts.limit(0)
    return counts.where(F.col(count) >= last).orderBy(F.desc(count), name).limit(k)


def reserved_pieces(spark: SparkSession) -> DataFrame:
    """Special and byte pieces, which every vocabulary here starts with."""
    special = F.element_at(F.array(*[F.lit(p) for p in SPECIAL_PIECES]), F.col("id").cast("int") + 1)
    byte = F.format_string("<0x%02X>", F.col("id") - FIRST_BYTE_ID)
    return spark.range(FIRST_WORD_ID).select(
        F.col("id").cast("int").alias("id"),
        F.when(F.col("id") < FIRST_BYTE_ID, special).otherwise(byte).alias("piece"),
        F.lit(0.0).alias("score"),
        F.lit("reserved").alias("origin"),
    )


def within_bytes(sentences: DataFrame, max_bytes: int = 6000, col="sentence") -> DataFrame:
    """Leave out sentences longer than `max_bytes` UTF-8 bytes."""
    return sentences.where(F.octet_length(col) <= max_bytes)


def word_counts(df: DataFrame, col="sentence") -> DataFrame:
    """(word, count); hot words are folded before the shuffle."""
    return (
        df.select(F.explode(tx.words(F.col(col))).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("count"))
    )


def char_counts(words: DataFrame, mark_start: bool = True) -> DataFrame:
    """Character counts from (word, count); with `mark_start` each word also
    counts one word-start mark."""
    text = F.concat(F.lit(tx.SPACE_MARK), "word") if mark_start else F.col("word")
    return (
        words.select(F.explode(tx.characters(text)).alias("char"), "count")
        .groupBy("char")
        .agg(F.sum("count").alias("count"))
    )


def char_coverage(chars: DataFrame, coverage: float = 0.9995) -> DataFrame:
    """Add `kept`: true until the characters before hold `coverage` of all.

    The window runs over distinct characters, at most the size of Unicode.
    """
    order = W.orderBy(F.desc("count"), "char").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("count").over(order), F.lit(0))
    total = F.sum("count").over(W.partitionBy())
    return chars.select("char", "count", (before < total * coverage).alias("kept"))


def top_word_vocab(counts: DataFrame, vocab_size: int = 30000) -> DataFrame:
    """Reserved pieces, then the most frequent words up to `vocab_size` pieces.

    `counts` (word, count) is read twice; store it before.
    """
    reserved = F.col("word").isin(SPECIAL_PIECES) | F.col("word").rlike("^<0x[0-9A-F]{2}>$")
    fresh = counts.where(~reserved)
    top = most_common(fresh, vocab_size - FIRST_WORD_ID)
    rank = F.row_number().over(W.orderBy(F.desc("count"), "word"))  # at most vocab_size rows
    ranked = top.select(
        (rank + FIRST_WORD_ID - 1).cast("int").alias("id"),
        F.col("word").alias("piece"),
        (-(rank - 1)).cast("double").alias("score"),
        F.lit("word").alias("origin"),
    )
    return reserved_pieces(counts.sparkSession).unionByName(ranked)


def merge_vocab(base: DataFrame, extra: DataFrame, max_pieces: int = MAX_PIECES) -> DataFrame:
    """Append the pieces of `extra` that `base` lacks, in `extra`'s order, score 0.

    Ids of `base` stay. Both must have unique pieces and ids 0..n-1.
    """
    for name, vocab in (("base", base), ("extra", extra)):
        facts = vocab.agg(
            F.count("*").alias("n"),
            F.count_distinct("piece").alias("pieces"),
            F.max("id").alias("last"),
        ).first()
        if facts.n != facts.pieces:
            raise ValueError(f"{name} vocabulary repeats pieces")
        if facts.n > max_pieces:
            raise ValueError(f"{name} vocabulary has more than {max_pieces} pieces")
        if name == "base":
            size = facts.n
            if size and facts.last != size - 1:
                raise ValueError("base ids must run from 0 without gaps")
    fresh = extra.join(base.select("piece"), "piece", "left_anti")
    rank = F.row_number().over(W.orderBy("id"))  # bounded by max_pieces above
    appended = fresh.select(
        (rank + (size - 1)).cast("int").alias("id"),
        "piece",
        F.lit(0.0).alias("score"),
        F.lit("extra").alias("origin"),
    )
    return base.select("id", "piece", "score", F.lit("base").alias("origin")).unionByName(appended)


def vocab_report(vocab: DataFrame) -> DataFrame:
    """Size and the special pieces with their ids, as rows of (name, value)."""
    sizes = vocab.agg(
        F.count("*").alias("pieces"),
        F.count_distinct("piece").alias("distinct pieces"),
        F.count_if(F.col("origin") == "extra").alias("added pieces"),
    ).unpivot([], ["pieces", "distinct pieces", "added pieces"], "name", "value")
    special = vocab.where(F.col("piece").isin(SPECIAL_PIECES)).select(
        F.col("piece").alias("name"), F.col("id").cast("bigint").alias("value")
    )
    return sizes.unionByName(special)


def piece_or_bytes(piece: Column, found: Column) -> Column:
    """The piece itself if the vocabulary has it, else its byte pieces."""
    return F.when(found, F.array(piece)).otherwise(tx.byte_pieces(piece))
