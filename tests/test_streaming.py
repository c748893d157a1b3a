import pytest

from quire.operators import instructions as ins, sentences as sn, tokenize as tk
from quire.session import new_path
from quire.streaming import streams
from tests.test_tokenize import make

SCHEMA = "k int, split string, text string"
ROWS = [(i, "train", f"w{i % 3}. x y {'z ' * i}.") for i in range(12)]


def folder(spark):
    path = new_path(spark, "t")
    for half in (ROWS[:6], ROWS[6:]):
        spark.createDataFrame(half, SCHEMA).write.mode("append").parquet(path)
    return path


def test_stateless_operators_take_streams(spark):
    stream = streams.read_stream(spark, folder(spark), SCHEMA)
    path = new_path(spark, "t")
    streams.stream_sentences(stream, path, delimiters=".").awaitTermination()
    batch = sn.split_sentences(spark.createDataFrame(ROWS, SCHEMA), delimiters=".")
    assert sorted(spark.read.parquet(path).select(*batch.columns).collect()) == sorted(batch.collect())


def test_running_counts(spark):
    path = new_path(spark, "t")
    stream = streams.read_stream(spark, folder(spark), SCHEMA)
    streams.stream_word_counts(stream, path, "text").awaitTermination()
    got = {r.word: r["count"] for r in spark.read.parquet(path).collect()}
    assert got["x"] == 12 and got["z"] == sum(range(12)) and got["w0."] == 4


def test_blocks_per_micro_batch_and_rendered_stream(spark):
    path = new_path(spark, "t")
    stream = streams.read_stream(spark, folder(spark), SCHEMA)
    tokens = tk.tokenize(stream, make(spark, ["x", "y", "z"]), mode="whitespace")
    streams.stream_blocks(
        tokens.select("split", "k", "input_ids"), path, ["k"], 4, num_shards=1
    ).awaitTermination()
    assert all(len(r.input_ids) == 4 for r in spark.read.parquet(path).collect())
    records = stream.selectExpr("text as instruction", "split as input", "text as output")
    assert ins.render_target(ins.render_prompt(records)).isStreaming


MORE = [(i, "train", f"w{i % 3}. x y z z z z.") for i in range(12, 18)]


def test_a_second_start_goes_on_where_the_first_ended(spark):
    source, path = folder(spark), new_path(spark, "t")
    read = lambda: streams.read_stream(spark, source, SCHEMA)
    counts, blocks = new_path(spark, "t"), new_path(spark, "t")

    def run():
        streams.stream_sentences(read(), path, delimiters=".").awaitTermination()
        streams.stream_word_counts(read(), counts, "text").awaitTermination()
        tokens = tk.tokenize(read(), make(spark, ["x", "y", "z"]), mode="whitespace")
        streams.stream_blocks(
            tokens.select("split", "k", "input_ids"), blocks, ["k"], 4, num_shards=1
        ).awaitTermination()
        return spark.read.parquet(path).count(), spark.read.parquet(blocks).count()

    first, first_blocks = run()
    spark.createDataFrame(MORE, SCHEMA).write.mode("append").parquet(source)
    second, second_blocks = run()
    every = spark.createDataFrame(ROWS + MORE, SCHEMA)
    assert first < second == sn.split_sentences(every, delimiters=".").count()
    assert second_blocks > first_blocks
    assert {r.word: r["count"] for r in spark.read.parquet(counts).collect()}["x"] == 18
    assert run() == (second, second_blocks)


def test_blocks_of_another_run_are_not_overwritten(spark):
    path = new_path(spark, "t")
    spark.range(3).write.parquet(f"{path}/micro_batch=0")
    stream = streams.read_stream(spark, folder(spark), SCHEMA)
    tokens = tk.tokenize(stream, make(spark, ["x"]), mode="whitespace").select("split", "k", "input_ids")
    with pytest.raises(ValueError, match="not written under"):
        streams.stream_blocks(tokens, path, ["k"], 4)


def test_streamed_documents_may_be_a_file_or_a_folder_of_files(spark, tmp_path):
    from quire.plans import queries_training as queries

    rows = [(i, f"One {i}. Two words.") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.repartition(3).write.parquet(f"{tmp_path}/many/documents.parquet")
    (tmp_path / "one").mkdir()
    docs.toPandas().to_parquet(tmp_path / "one" / "documents.parquet", index=False)
    for name in ("many", "one"):
        folder = f"{tmp_path}/{name}"
        assert queries.stream_sentences(spark, folder).count() == 40
        assert {r.word: r["count"] for r in queries.stream_word_counts(spark, folder).collect()}["words."] == 20
        assert {r.split for r in queries.stream_blocks(spark, folder).collect()} == {"train", "validation", "test"}
