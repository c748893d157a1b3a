"""Column expressions on text. All are stateless, so they work on streams too."""

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# The characters str.strip() removes, and the sentence delimiters.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
DELIMITERS = "?？。!！;；"

SPACE_MARK = "▁"


def char_class(characters: str) -> str:
    return "[" + "".join("\\x{%x}" % ord(c) for c in characters) + "]"


def as_text(value) -> Column:
    """Text of any column. Null stays null; it has no sentence either way."""
    return F.col(value).cast("string") if isinstance(value, str) else value.cast("string")


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WHITESPACE))


# What the usual trainer does to characters before NFKC. Control
# characters go, zero-width and odd ones become spaces, the wide tilde stays.
DROPPED = "".join(map(chr, [*range(0x01, 0x09), 0x0B, *range(0x0E, 0x20), 0x7F, 0x8F, 0x9F]))
SPACED = "".join(map(chr, [
    0x09, 0x0A, 0x0C, 0x0D, 0x1680, 0x200B, 0x200C, 0x200E, 0x200F, 0x2028, 0x2029, 0x2581, 0xFEFF, 0xFFFD]))
WIDE_TILDE, KEPT_TILDE = "\uff5e", "\U0010fffe"  # the second is no character


def compatible(text: Column) -> Column:
    """Full-width and other compatibility forms as plain ones (NFKC), a batch at
    a time, and runs of white space as one space; before that the rules of
    `DROPPED`, `SPACED` and the wide tilde."""
    ruled = F.translate(text, SPACED + WIDE_TILDE + DROPPED, " " * len(SPACED) + KEPT_TILDE)

    def normalized(texts: pa.Array) -> pa.Array:
        return pc.replace_substring(pc.utf8_normalize(texts, form="NFKC"), KEPT_TILDE, WIDE_TILDE)

    plain = F.arrow_udf(normalized, "string")(ruled)
    return strip(F.regexp_replace(plain, char_class(WHITESPACE) + "+", " "))


def sentence_array(text: Column, delimiters: str = DELIMITERS, keep_tail: bool = False) -> Column:
    """Cut after each delimiter. What follows the last one is dropped unless
    `keep_tail`; a zero-width cut keeps this linear in the text length."""
    parts = F.split(text, f"(?<={char_class(delimiters)})")
    if keep_tail:
        return F.filter(parts, lambda s: s != "")
    return F.slice(parts, 1, F.size(parts) - 1)


def words(text: Column) -> Column:
    """Pieces between runs of white space (the characters of `WHITESPACE`)."""
    return F.filter(F.split(text, r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")


def characters(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def byte_pieces(text: Column) -> Column:
    """One <0xHH> piece per UTF-8 byte."""
    return F.transform(
        F.regexp_extract_all(F.hex(F.encode(text, "UTF-8")), F.lit("(..)"), F.lit(1)),
        lambda h: F.concat(F.lit("<0x"), h, F.lit(">")),
    )
