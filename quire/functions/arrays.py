"""Column expressions on token id arrays."""

from pyspark.sql import Column, functions as F

UNK, BOS, EOS = 0, 1, 2  # Fixed values: ids of <unk>, <s>, </s>


def with_special(ids: Column, bos: bool = True, eos: bool = False) -> Column:
    parts = [F.array(F.lit(BOS))] if bos else []
    parts.append(ids)
    if eos:
        parts.append(F.array(F.lit(EOS)))
    return F.concat(*parts)


def ones_mask(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def clamp_length(requested: int | None, maximum: float) -> int:
    """The smaller of the asked length and the tokenizer's; must end up finite."""
    length = maximum if requested is None else min(requested, maximum)
    if not 0 < length < 2**31:
        raise ValueError("a finite positive length is needed")
    return int(length)


def joined(ids: Column) -> Column:
    """Ids as one string, for reports and comparisons."""
    return F.array_join(ids.cast("array<string>"), " ")
