"""Sentence table: cut, filter, strip, number."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import text as tx
from ..session import cut_lineage
from .ordering import running_before

#: Keys of picked sentences that may travel to every task.
SENT_PICKS = 100_000
SPLIT_ORDER = ("train", "validation", "test")  # Fixed values: order of concatenation


def concat_splits(frames: dict[str, DataFrame], order=SPLIT_ORDER) -> DataFrame:
    """One table of all splits; `split_ord` keeps the order they are joined in."""
    parts = [
        frames[name].withColumn("split", F.lit(name)).withColumn("split_ord", F.lit(i))
        for i, name in enumerate(order)
        if name in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def kept_sentences(text, delimiters=tx.DELIMITERS, min_chars=2, keep_tail=False):
    """Array of sentences of one text. Length is measured before stripping."""
    cut = tx.sentence_array(tx.as_text(text), delimiters, keep_tail)
    long_enough = F.filter(cut, lambda s: F.length(s) >= min_chars)
    return F.transform(long_enough, tx.strip)


def split_sentences(
    df: DataFrame, text="text", delimiters=tx.DELIMITERS, min_chars=2, keep_tail=False
) -> DataFrame:
    """One row per kept sentence, `pos` counting from 0 within its text."""
    others = [c for c in df.columns if c != text]
    return df.select(
        *others,
        F.posexplode(kept_sentences(text, delimiters, min_chars, keep_tail)).alias(
            "pos", "sentence"
        ),
    )


def sample_every(
    df: DataFrame, order_by: list[str], n: int = 30000, text="text", **sentence_options
) -> DataFrame:
    """Every n-th kept sentence of the whole table, in key order.

    Positions come from a running count per text, so one text holding most of
    the sentences is a single row there. Only keys and counts move for that.
    The keys that hold a picked position go to the texts if they are counted
    few, so no text moves; else both are joined by a shuffle.
    """
    others = [c for c in df.columns if c != text]
    cut = kept_sentences(text, **sentence_options)
    counts = df.select(*order_by, F.size(cut).cast("bigint").alias("_n"))
    numbered = running_before(counts, order_by, F.col("_n"), "_before")
    first = F.pmod(-F.col("_before"), F.lit(n))
    picks = numbered.where(first < F.col("_n")).select(
        *order_by, "_before", F.sequence(first, F.col("_n") - 1, F.lit(n).cast("bigint")).alias("_at")
    )
    picks = cut_lineage(picks)
    few = picks.limit(SENT_PICKS + 1).count() <= SENT_PICKS
    found = df.join(F.broadcast(picks) if few else picks.hint("shuffle_merge"), order_by).withColumn("_cut", cut)
    picked = F.transform(
        "_at",
        lambda i: F.struct(
            (F.col("_before") + i).alias("position"), F.get("_cut", i.cast("int")).alias("sentence")
        ),
    )
    return found.select(*others, F.inline(picked))
