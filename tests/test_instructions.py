import pytest

from quire.operators import instructions as ins
from tests.test_tokenize import make

RECORDS = "k int, instruction string, input string, output string"


def test_rendering(spark):
    rows = [(0, "do {x}", None, "out"), (1, "do", "", "o"), (2, "do", "with {y}", None), (3, None, "z", "o")]
    df = spark.createDataFrame(rows, RECORDS)
    got = ins.render_target(ins.render_prompt(df, "<{instruction}>")).orderBy("k").collect()
    assert [(r.source, r.target) for r in got] == [
        ("<do {x}>", "out</s>"), ("<do>", "o</s>"), ("<do\nwith {y}>", "None</s>")
    ]
    assert ins.dropped_records(df).first().dropped == 1
    assert ins.render_target(df, drop_null_output=True).count() == 3
    assert ins.render_prompt(df).first().source.endswith("### 回复：")


@pytest.mark.parametrize("ignore", [ins.IGNORE_ID, ins.PARITY_IGNORE_ID])
def test_masking_and_cutting(spark, ignore):
    df = spark.createDataFrame([(0, "ab", None, "cd"), (1, "a" * 20, None, "c")], RECORDS)
    vocab = make(spark, list("abcd"))
    got = ins.encode_instructions(
        df, vocab, "char", 6, ignore, "{instruction}", "", eos_id=True
    ).orderBy("k").collect()
    assert got[0].input_ids == [1, 259, 260, 261, 262, 2]
    assert got[0].labels == [ignore] * 3 + [261, 262, 2]
    assert got[1].input_ids == [1] + [259] * 5 and got[1].labels == [ignore] * 6
    assert set(got[0].asDict()) == {"k", "input_ids", "labels"}


def test_each_side_has_its_own_start_and_end_text_is_one_id(spark):
    vocab = make(spark, ["▁a", "▁b", "a", "b", "▁"])
    df = spark.createDataFrame([(0, "a", None, "b")], RECORDS)
    row = ins.encode_instructions(df, vocab, template="{instruction}").first()
    assert row.input_ids == [1, 259, 260, 2] and row.labels == [-100, -100, 260, 2]
    assert ins.sequence_count(df).first().sequences == 1
