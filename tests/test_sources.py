import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quire.session import new_path
from quire.sources import files, processed, vocab_file

TEXTS = ['plain', 'quote " and, comma', 'two\nlines', "back\\slash", "ünï 卵"]


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_files_per_split(spark, fmt):
    folder = new_path(spark, "t")
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    for split in ("train", "validation"):
        writer = df.write
        if fmt == "csv":
            writer.csv(f"{folder}/{split}", header=True, escape='"')
        else:
            writer.json(f"{folder}/{split}")
    table = files.load_source(
        spark, train_file=f"{folder}/train", eval_file=f"{folder}/validation", file_type=fmt,
        multi_line=True,
    )
    got = table.groupBy("split").agg(F.sort_array(F.collect_list("text")).alias("t")).collect()
    assert {r.split: r.t for r in got} == {s: sorted(TEXTS) for s in ("train", "validation")}


def test_text_files_and_named_subsets(spark):
    folder = new_path(spark, "t")
    spark.createDataFrame([("a",), ("b",)], "v string").write.text(f"{folder}/pretrain/train.txt")
    for fmt in ("txt", "text"):
        table = files.read_dataset(spark, folder, "pretrain", fmt)
        assert sorted(r.text for r in table.collect()) == ["a", "b"]
        assert table.select("split").distinct().collect()[0][0] == "train"
    with pytest.raises(ValueError):
        files.read_dataset(spark, folder, "finetune", "txt")


def test_columns_missing_from_one_split(spark):
    folder = new_path(spark, "t")
    spark.createDataFrame([("i", "o")], "instruction string, output string").write.json(f"{folder}/a")
    spark.createDataFrame([("i", "x", "o")], "instruction string, input string, output string").write.json(f"{folder}/b")
    table = files.read_splits(spark, {"train": f"{folder}/a", "validation": f"{folder}/b"}, "json")
    assert {r.split: r.input for r in table.collect()} == {"train": None, "validation": "x"}


def test_source_settings_are_checked():
    assert files.check_source("d", "t", "e", "json") == "dataset"
    assert files.check_source(None, "t", "e", "txt") == "files"
    for settings in ((None, "t", None, "json"), (None, "t", "e", None), (None, None, None, None),
                     (None, "t", "e", "parquet")):
        with pytest.raises(ValueError):
            files.check_source(*settings)


def test_processed_data(spark):
    path = new_path(spark, "t")
    df = spark.createDataFrame([("train", [1, 2]), ("validation", [3])], "split string, ids array<int>")
    processed.write_processed(df, path)
    with pytest.raises(AnalysisException):
        processed.write_processed(df, path)
    processed.write_processed(df, path, overwrite=True)
    assert processed.read_processed(spark, path, "train").first().ids == [1, 2]


def test_reuse_depends_on_parameters(spark):
    path, calls = new_path(spark, "t"), []

    def compute():
        calls.append(1)
        return spark.createDataFrame([("train", len(calls))], "split string, n int")

    for settings in ({"block": 4}, {"block": 4}, {"block": 8}):
        last = processed.reuse_or_compute(spark, path, settings, compute).first().n
    assert len(calls) == 2 and last == 2


def test_vocabulary_file_keeps_odd_pieces(spark):
    pieces = ["<unk>", "a\rb", '"', 'q"q', "\\", "\\n", "▁▁", "a\tb", "\r", "é", " "]
    rows = [(i, p, -float(i), "base") for i, p in enumerate(pieces)]
    path = new_path(spark, "t")
    vocab = spark.createDataFrame(rows, "id int, piece string, score double, origin string")
    vocab_file.write_vocab(vocab.repartition(3), path)
    got = vocab_file.read_vocab(spark, path).orderBy("id").collect()
    assert [(r.id, r.piece, r.score) for r in got] == [r[:3] for r in rows]


def test_lines(spark):
    path = new_path(spark, "t")
    df = spark.createDataFrame([("a b",), ("卵。",)], "sentence string")
    files.write_lines(df, path)
    assert sorted(r[0] for r in spark.read.text(path).collect()) == ["a b", "卵。"]


def write_lines_of(spark, path, texts):
    spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1).write.json(path)


def test_split_names(spark):
    folder = new_path(spark, "t")
    for name, text in (("train_notes.json", "a"), ("valid_notes.json", "b"), ("test_notes.json", "c"), ("training-2.json", "d")):
        write_lines_of(spark, f"{folder}/{name}", [text])
    got = files.read_dataset(spark, folder, None).collect()
    assert sorted((r.split, r.text) for r in got) == [("test", "c"), ("train", "a"), ("train", "d"), ("validation", "b")]
    for name in ("val.json", "dev-00001.json"):
        other = new_path(spark, "t")
        write_lines_of(spark, f"{other}/{name}", ["x"])
        assert files.read_dataset(spark, other, None).first().split == "validation"


def test_files_of_no_split_are_an_error_unless_named(spark):
    folder = new_path(spark, "t")
    write_lines_of(spark, f"{folder}/train.json", ["a"])
    write_lines_of(spark, f"{folder}/trainer_log.json", ["z"])
    with pytest.raises(ValueError, match="trainer_log"):
        files.read_dataset(spark, folder, None)
    got = files.read_dataset(spark, folder, None, splits={"train": "train.json", "extra": ["trainer*"]}).collect()
    assert sorted((r.split, r.text) for r in got) == [("extra", "z"), ("train", "a")]
    with pytest.raises(ValueError, match="no files"):
        files.read_dataset(spark, folder, None, splits={"validation": "valid*"})


def test_rows_are_numbered_in_file_order(spark):
    folder = new_path(spark, "t")
    texts = {"train_1": [f"a{i}" for i in range(300)], "train_2": [f"b{i}" for i in range(50)], "valid": ["v0", "v1"]}
    for name in ("train_2", "valid", "train_1"):
        write_lines_of(spark, f"{folder}/{name}.json", texts[name])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        table = files.read_dataset(spark, folder, None, schema="text string", file_order=True)
        got = files.with_row_ids(table).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = texts["train_1"] + texts["train_2"] + texts["valid"]
    assert [r.text for r in sorted(got, key=lambda r: r.row_id)] == want
    assert set(got[0].asDict()) == {"text", "split", "row_id"}


def test_changed_input_is_computed_again(spark):
    source, path = new_path(spark, "t"), new_path(spark, "t")
    df = lambda n: spark.range(n).withColumn("split", F.lit("train"))
    count = lambda: processed.reuse_or_compute(spark, path, {}, lambda: spark.read.parquet(source), [source]).count()
    df(3).write.parquet(source)
    assert count() == 3
    df(10).write.mode("overwrite").parquet(source)
    assert count() == 10
    df(5).write.mode("append").parquet(source)
    assert count() == 15 == count()


def test_listed_files_keep_the_order_given(spark):
    folder, texts = new_path(spark, "t"), {}
    for name in ("c", "a", "b b"):
        texts[name] = [f"{name}{i}" for i in range(4)]
        write_lines_of(spark, f"{folder}/{name}", texts[name])
    given = [f"{folder}/{n}" for n in ("c", "a", "b b")]
    rows = files.read_splits(spark, {"train": given, "validation": given[:0:-1]}, "json", "text string", file_order=True)
    got = [r.text for r in files.with_row_ids(rows).orderBy("row_id").collect()]
    assert got == texts["c"] + texts["a"] + texts["b b"] + texts["b b"] + texts["a"]
    # A folder or pattern in the list stands for its files by name.
    mixed = [f"{folder}/c", f"{folder}/[ab]*"]
    rows = files.read_splits(spark, {"train": mixed}, "json", "text string", file_order=True)
    assert [r.text for r in files.with_row_ids(rows).orderBy("row_id").collect()] == texts["c"] + texts["a"] + texts["b b"]


def numbered(spark, *values):
    return spark.createDataFrame([("train", v) for v in values], "split string, n int")


def test_two_writers_never_mix(spark):
    """The second one publishes while the first is still computing."""
    path, seen = new_path(spark, "t"), {}

    def slow():
        seen["inner"] = processed.reuse_or_compute(spark, path, {}, lambda: numbered(spark, 1, 2))
        return numbered(spark, 7, 8, 9)

    seen["outer"] = processed.reuse_or_compute(spark, path, {}, slow)
    seen["later"] = processed.reuse_or_compute(spark, path, {}, lambda: 1 / 0)
    for table in seen.values():
        assert sorted(r.n for r in table.collect()) == [1, 2]


def test_a_dead_run_leaves_nothing_behind_that_is_read(spark):
    path = new_path(spark, "t")
    half = numbered(spark, 1, 2).selectExpr("split", "n + int(assert_true(n < 2)) as n")
    with pytest.raises(Exception):
        processed.reuse_or_compute(spark, path, {}, lambda: half)
    table = processed.reuse_or_compute(spark, path, {}, lambda: numbered(spark, 5))
    assert [r.n for r in table.collect()] == [5]
