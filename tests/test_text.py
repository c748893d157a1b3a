import re

from pyspark.sql import functions as F

from quire.functions import arrays as ar, text as tx
from quire.operators import sentences as sn, subsets
import pytest


def plain_sentences(text, marks="?？。!！;；"):
    if text is None:
        return []
    parts = re.split("([" + re.escape(marks) + "])", text)
    joined = [a + b for a, b in zip(parts[0::2], parts[1::2])]
    return [s.strip() for s in joined if len(s) >= 2]


EDGES = [
    "A？B。C", "no delimiter", "", None, "A！！", "A！ ！", "　a b\xa0。", "\n\x1cx\n y ! z;",
    "a?b?", "?", "??ab?", "\U0001f600。x。", "tab\t。　　。",
]


def test_sentences_equal_the_plain_rule(spark):
    df = spark.createDataFrame(list(enumerate(EDGES)), "i int, text string")
    got = {}
    for r in sn.split_sentences(df).orderBy("i", "pos").collect():
        got.setdefault(r.i, []).append(r.sentence)
    assert got == {i: plain_sentences(t) for i, t in enumerate(EDGES) if plain_sentences(t)}
    assert got[0] == ["A？", "B。"] and got[4] == ["A！"] and got[5] == ["A！", "！"]


def test_keep_tail_loses_nothing(spark):
    df = spark.createDataFrame([(t,) for t in EDGES if t], "text string")
    rows = df.select("text", F.array_join(tx.sentence_array(F.col("text"), keep_tail=True), "").alias("j"))
    assert all(r.text == r.j for r in rows.collect())


def test_strip_knows_every_unicode_space(spark):
    spaces = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    df = spark.createDataFrame([(spaces + "a" + spaces + "b" + spaces,)], "s string")
    assert df.select(tx.strip(F.col("s"))).first()[0] == "a" + spaces + "b"


def test_byte_pieces(spark):
    df = spark.createDataFrame([("卵",), ("é",), ("a",), ("\U0001f600",)], "c string")
    got = [r[0] for r in df.select(tx.byte_pieces(F.col("c"))).collect()]
    assert got[0] == ["<0xE5>", "<0x8D>", "<0xB5>"]
    assert got == [[f"<0x{b:02X}>" for b in c.encode()] for c in ("卵", "é", "a", "\U0001f600")]


def test_every_nth_sentence_with_one_text_holding_most(spark):
    texts = ["x!" * k for k in (3, 0, 900, 1, 5, 0, 41)]
    texts = ["".join(f"{i}.{j}!" for j in range(t.count("!"))) for i, t in enumerate(texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    flat = [s for t in texts for s in plain_sentences(t)]
    got = sn.sample_every(df, ["k"], 7).orderBy("position").collect()
    assert [(r.position, r.sentence) for r in got] == list(enumerate(flat))[::7]


def test_splits_join_in_order_and_heads(spark):
    frames = {s: spark.range(n).toDF("k") for s, n in (("test", 3), ("train", 30), ("validation", 4))}
    joined = sn.concat_splits(frames)
    order = joined.select("split", "split_ord").distinct().orderBy("split_ord").collect()
    assert [r.split for r in order] == ["train", "validation", "test"]
    heads = subsets.head_per_split(joined, ["k"]).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in heads} == {"train": 20, "validation": 4}
    assert "k" not in subsets.drop_columns(joined, "k").columns


def test_length_clamp():
    assert ar.clamp_length(512, 1e30) == 512
    assert ar.clamp_length(None, 2048) == 2048
    assert ar.clamp_length(4096, 2048) == 2048
    for requested, most in ((None, 1e30), (0, 10)):
        with pytest.raises(ValueError):
            ar.clamp_length(requested, most)


def test_compatible_forms_follow_the_trainers_rules(spark):
    cases = {
        "a\x01b\x0bc\x1fd\x7fe\x8ff\x9fg": "abcdefg",
        "a\u200bb\u200cc\u200ed\u200fe\ufefff\ufffdg": "a b c d e f g",
        "a\tb\nc\x0cd\re\u1680f\u2028g\u2029h▁i": "a b c d e f g h i",
        "a\u200db": "a\u200db",  # the joiner stays
        "ＡＢ１～ﬁ①": "AB1～fi1",
        "\u200b \ufeff": "", "": "", None: None,
    }
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    got = {r.t: r.c for r in df.select("t", tx.compatible(F.col("t")).alias("c")).collect()}
    assert got == cases
