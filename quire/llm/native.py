"""Word expressions on text columns, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SPACE_RUN = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Runs without ASCII whitespace; none for a null text."""
    return F.coalesce(F.array_remove(F.split(text, SPACE_RUN), ""), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("bigint")


def let(value: Column, use) -> Column:
    """`use(value)` with `value` computed once, however often `use` names it."""
    return F.transform(F.array(value), use)[0]
