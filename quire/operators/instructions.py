"""Instruction records to masked training sequences."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import arrays as ar
from .tokenize import Vocabulary, load_vocabulary, tokenize_with

# Prompt text, end text, ignore ids and length limit.
PROMPT = "下面是一条说明任务的指令。写出一个能适当完成请求的回复。\n\n### 指令：\n{instruction}\n\n### 回复："
EOS_TEXT = "</s>"
IGNORE_ID = -100
PARITY_IGNORE_ID = 100
MAX_SEQ_LENGTH = 512


def _has_input() -> Column:
    return F.col("input").isNotNull() & (F.col("input") != "")


def _renders() -> Column:
    return F.col("instruction").isNotNull() | ~_has_input()


def render_prompt(df: DataFrame, template: str = PROMPT) -> DataFrame:
    """Add `source`. A null instruction reads as the word None; with an input
    there is nothing to put it after, and the row is left out.

    Only the placeholder itself is replaced; braces inside the data stay.
    """
    head, tail = template.split("{instruction}")
    asked = F.when(_has_input(), F.concat("instruction", F.lit("\n"), "input")).otherwise(
        F.coalesce("instruction", F.lit("None"))
    )
    return df.where(_renders()).withColumn("source", F.concat(F.lit(head), asked, F.lit(tail)))


def render_target(df: DataFrame, eos_text: str = EOS_TEXT, drop_null_output=False) -> DataFrame:
    """Add `target`; a null output reads as the word None unless dropped."""
    if drop_null_output:
        df = df.where(F.col("output").isNotNull())
    return df.withColumn(
        "target", F.concat(F.coalesce("output", F.lit("None")), F.lit(eos_text))
    )


def dropped_records(df: DataFrame) -> DataFrame:
    """How many records `render_prompt` leaves out."""
    return df.agg(
        F.count_if(~_renders()).alias("dropped"), F.count("*").alias("records")
    )


def join_source_target(
    source: Column, target: Column, max_len: int = MAX_SEQ_LENGTH, ignore: int = IGNORE_ID
) -> tuple[Column, Column]:
    """Input ids and labels: labels hide the source; both cut on the right."""
    hidden = F.array_repeat(F.lit(ignore), F.size(source))
    cut = lambda ids: F.slice(ids, 1, max_len)
    return cut(F.concat(source, target)), cut(F.concat(hidden, target))


def encode_instructions(
    df: DataFrame,
    vocab,
    mode: str = "bpe",
    max_len: int = MAX_SEQ_LENGTH,
    ignore: int = IGNORE_ID,
    template: str = PROMPT,
    eos_text: str = EOS_TEXT,
    eos_id: bool = False,
    drop_null_output: bool = False,
) -> DataFrame:
    """Render, tokenize both sides on their own, join, cut and mask.

    The source starts with <s>; the target does not. In `bpe` mode the end
    text becomes its id by itself; other modes take `eos_id=True` with an empty
    `eos_text`.
    """
    vocabulary = vocab if isinstance(vocab, Vocabulary) else load_vocabulary(vocab, mode)
    rendered = render_target(render_prompt(df, template), eos_text, drop_null_output)
    both = tokenize_with(rendered, vocabulary, "source", mode, bos=True, out="_s")
    both = tokenize_with(both, vocabulary, "target", mode, bos=False, eos=eos_id, out="_t")
    ids, labels = join_source_target(F.col("_s"), F.col("_t"), max_len, ignore)
    others = [c for c in df.columns if c not in ("instruction", "input", "output")]
    return both.select(*others, ids.alias("input_ids"), labels.alias("labels"))


def sequence_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("sequences"))
