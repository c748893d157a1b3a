import random
from collections import Counter

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from quire.operators import pairs, vocab as vb
from quire.plans import queries_text
from quire.plans.registry import SQL

SCHEMA = "id int, piece string, score double, origin string"


def as_vocab(spark, pieces, score=-1.0):
    return spark.createDataFrame([(i, p, score, "x") for i, p in enumerate(pieces)], SCHEMA)


def test_reserved_pieces(spark):
    rows = vb.reserved_pieces(spark).orderBy("id").collect()
    assert [r.piece for r in rows[:4]] == ["<unk>", "<s>", "</s>", "<0x00>"]
    assert rows[258].piece == "<0xFF>" and len(rows) == 259


def test_merge_keeps_base_and_appends_in_order(spark):
    base, extra = as_vocab(spark, "ab"), as_vocab(spark, "bdc")
    got = vb.merge_vocab(base, extra).orderBy("id").collect()
    assert [(r.id, r.piece, r.score) for r in got] == [
        (0, "a", -1.0), (1, "b", -1.0), (2, "d", 0.0), (3, "c", 0.0)
    ]
    again = vb.merge_vocab(vb.merge_vocab(base, extra), extra)
    assert again.count() == 4
    report = {r.name: r.value for r in vb.vocab_report(vb.merge_vocab(base, extra)).collect()}
    assert report == {"pieces": 4, "distinct pieces": 4, "added pieces": 2}


def test_merge_rejects_repeats_gaps_and_too_many(spark):
    good = as_vocab(spark, "ab")
    with pytest.raises(ValueError):
        vb.merge_vocab(good, as_vocab(spark, "cc"))
    with pytest.raises(ValueError):
        vb.merge_vocab(as_vocab(spark, "ab").withColumn("id", F.col("id") + 5), good)
    with pytest.raises(ValueError):
        vb.merge_vocab(good, as_vocab(spark, "xyz"), max_pieces=2)
    with pytest.raises(ValueError):
        vb.check_bounded(good, 1)


def test_coverage_keeps_the_character_that_crosses(spark):
    chars = spark.createDataFrame([("a", 90), ("b", 9), ("c", 1)], "char string, count long")
    kept = lambda c: {r.char for r in vb.char_coverage(chars, c).where("kept").collect()}
    assert kept(0.9) == {"a"} and kept(0.91) == {"a", "b"} and kept(1.0) == {"a", "b", "c"}


def test_words_that_look_reserved_stay_out(spark):
    counts = spark.createDataFrame(
        [("<s>", 9), ("<0x41>", 8), ("x", 1), ("y", 2)], "word string, count long"
    )
    got = vb.top_word_vocab(counts, 260).where("id >= 259").collect()
    assert [(r.id, r.piece) for r in got] == [(259, "y")]


def plain_merges(words, merges, made, longest=16):
    """One merge at a time over Counter of tuples of symbols."""
    made, learned = set(made), []
    while len(learned) < merges:
        counts = Counter()
        for word, n in words.items():
            for a, b in zip(word, word[1:]):
                counts[a, b] += n
        best = sorted(
            (p for p in counts if len(p[0] + p[1]) <= longest and p[0] + p[1] not in made),
            key=lambda p: (-counts[p], len(p[0] + p[1]), p[0] + p[1], len(p[0])),
        )
        if not best:
            break
        a, b = best[0]
        learned.append(((a, b), counts[a, b]))
        made.add(a + b)
        after = Counter()
        for word, n in words.items():
            out, i = [], 0
            while i < len(word):
                if i + 1 < len(word) and (word[i], word[i + 1]) == (a, b):
                    out.append(a + b)
                    i += 2
                else:
                    out.append(word[i])
                    i += 1
            after[tuple(out)] += n
        words = after
    return learned


def symbol_table(spark, words):
    rows = [(list(w), n) for w, n in words.items()]
    return spark.createDataFrame(rows, "symbols array<string>, count long").repartition(3)


@pytest.mark.parametrize("most_symbols", [1 << 21, 40, 0])
@pytest.mark.parametrize(
    "seed,watched,longest,merges", [(0, 20000, 16, 25), (1, 12, 16, 20), (2, 3, 4, 8), (3, 1, 16, 6)]
)
def test_rounds_equal_one_merge_at_a_time(spark, seed, watched, longest, merges, most_symbols):
    """Few letters make ties, repeats and equal pieces from different pairs."""
    rng = random.Random(seed)
    words = Counter()
    for _ in range(60):
        words["".join(rng.choice("abc") for _ in range(rng.randint(2, 9)))] += rng.randint(1, 4)
    want = plain_merges({tuple(w): n for w, n in words.items()}, merges, "abc", longest)
    got = pairs.learn_merges(symbol_table(spark, words), merges, set("abc"), longest, watched=watched, most_symbols=most_symbols)
    assert got == want


def test_rounds_are_few_where_words_are_few(spark, caplog):
    """Hundreds of merges a round, and the same ones as one at a time."""
    rng = random.Random(5)
    syllables = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(60)]
    words = Counter()
    for _ in range(1500):
        words["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))] += rng.randint(1, 30)
    letters = set("".join(words))
    want = plain_merges({tuple(w): n for w, n in words.items() if len(w) > 1}, 400, letters, 16)
    with caplog.at_level("INFO", logger="quire.operators.pairs"):
        got = pairs.learn_merges(symbol_table(spark, words), 400, letters, 16)
    assert got == want
    assert int(caplog.messages[-1].split()[-2]) < 40


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcd", min_size=2, max_size=8), min_size=1, max_size=25))
def test_safe_merges_agree_with_single_steps(words):
    """Every round's leading pairs are what single steps would take."""
    table = Counter(tuple(w) for w in words)
    made, left = set("abcd"), 12
    want = plain_merges(dict(table), left, made)
    got, words = [], dict(table)
    while len(got) < left:
        counts = Counter()
        for word, n in words.items():
            for a, b in zip(word, word[1:]):
                counts[a, b] += n
        best = sorted(counts.items(), key=pairs._order)
        fresh = pairs.safe_merges(best, made, left - len(got))
        if not fresh:
            break
        for (a, b), n in fresh:
            got.append(((a, b), n))
            made.add(a + b)
            after = Counter()
            for word, k in words.items():
                text = "".join(f"<{s}>" for s in word).replace(f"<{a}><{b}>", f"<{a}{b}>")
                after[tuple(text[1:-1].split("><"))] += k
            words = after
    assert got == want


def test_training_cuts_at_scripts_and_rare_characters(spark):
    lines = ["ab12ab 卵巢ab。"] * 30 + ["aЖb"] * 5 + ["zzq"]
    df = spark.createDataFrame([(t,) for t in lines], "sentence string")
    vocab = pairs.train_bpe(df, 400, coverage=0.9999, layout="bytes", normalize=False).collect()
    pieces = {r.piece for r in vocab if r.id >= 259}
    assert "ab" in pieces and "▁ab" in pieces and "12" in pieces and "▁卵巢" in pieces
    assert not pieces & {"b1", "巢a", "b。", "aЖ"}
    few = {r.piece for r in pairs.train_bpe(df, 400, coverage=0.97, layout="bytes").collect() if r.id >= 259}
    assert "q" not in few and "zz" not in few
    ids = sorted(r.id for r in vocab)
    assert ids == list(range(len(vocab)))
    assert all(r.score == -(r.id - 259) for r in vocab if r.id >= 259)


def test_vocabulary_size_and_long_lines(spark):
    df = spark.createDataFrame([("abab abab cd",), ("x" * 50,)], "sentence string")
    vocab = pairs.train_bpe(df, 259 + 5 + 2, coverage=1.0, max_bytes=20, layout="bytes")
    assert vocab.count() == 266
    assert not vocab.where("piece like '%x%' and id >= 259").count()


def test_characters_beyond_the_first_plane(spark):
    df = spark.createDataFrame([("\U00020000\U00020001 " * 3,)], "sentence string")
    pieces = {r.piece for r in pairs.train_bpe(df, 300, coverage=1.0, layout="bytes").collect() if r.id >= 259}
    assert "\U00020000" in pieces and "▁\U00020000\U00020001" in pieces


def test_layouts_and_sizes(spark):
    df = spark.createDataFrame([("abab abab cd ef ghgh",)], "sentence string")
    for layout, head in (("none", 0), ("special", 3), ("bytes", 259)):
        rows = pairs.train_bpe(df, head + 12, coverage=1.0, layout=layout).orderBy("id").collect()
        assert [r.id for r in rows] == list(range(head + 12))
        assert [r.piece for r in rows[:3]] == (["<unk>", "<s>", "</s>"] if head else [r.piece for r in rows[:3]])
        assert rows[head].score == 0.0
    with pytest.raises(ValueError):
        pairs.train_bpe(df, 20, layout="all")


def test_training_sees_compatible_forms(spark):
    df = spark.createDataFrame([("ＡＢ１２ ＡＢ１２　AB12",)] * 3, "sentence string")
    pieces = {r.piece for r in pairs.train_bpe(df, 20, coverage=1.0).collect()}
    assert "AB" in pieces or "▁AB" in pieces
    assert not any("Ａ" in p or "１" in p for p in pieces)
    raw = {r.piece for r in pairs.train_bpe(df, 20, coverage=1.0, normalize=False).collect()}
    assert any("Ａ" in p for p in raw)


def test_a_trained_vocabulary_appended_to_a_base(spark):
    """Size after merging: base + trained - pieces that both have."""
    base = pairs.train_bpe(spark.createDataFrame([("one two three",)], "sentence string"), 300, coverage=1.0, layout="bytes")
    extra = pairs.train_bpe(spark.createDataFrame([("two three four",)], "sentence string"), 30, coverage=1.0)
    both = base.join(extra.select("piece"), "piece").count()
    assert vb.merge_vocab(base, extra).count() == base.count() + extra.count() - both


def test_merges_in_order_are_made_by_rank():
    import numpy as np
    from quire.operators.pairs import _join

    flat = np.array([-1, 1, 1, 1, 2, -1, 2, 1, 1, 2, 1, -1, 3, -1], np.int32)
    assert _join(flat, [(1, 1, 10), (10, 1, 11), (11, 2, 12), (1, 2, 13)]).tolist() == [-1, 12, -1, 2, 10, 2, 1, -1, 3, -1]
    assert _join(flat, []).tolist() == flat.tolist() and _join(flat[:0], [(1, 1, 10)]).size == 0


def test_what_training_sends_to_the_driver_is_bounded(spark, monkeypatch):
    """Where many words hold the best pairs, rounds bring changes of counts, not words."""
    from quire.operators import pairs

    rows = [([chr(97 + i % 7), chr(97 + i % 11), chr(97 + i % 5), chr(97 + i % 13)], 1 + i % 9) for i in range(400)]
    words = spark.createDataFrame(rows, "symbols array<string>, count bigint")
    want = pairs.learn_merges(words, 30)
    asked, held = [], pairs.held_words

    def watch(*a):
        asked.append(held(*a))
        return asked[-1]

    monkeypatch.setattr(pairs, "held_words", watch)
    assert pairs.learn_merges(words, 30, most_symbols=1) == want
    vain = len(asked)
    assert not any(asked) and vain < 10  # words aren't asked for in every round


def test_words_with_many_symbols_merge_by_segments(spark, caplog):
    """Too many symbols to bring the words, few once cut at rare pairs: the
    merges are those of a run that brings all words, in few rounds."""
    rng = random.Random(5)
    syllables = ["ka", "lo", "mi", "tu", "ne", "sar", "aaa"]
    rows = [("".join(rng.choice(syllables) + rng.choice("qxzvwyj") for _ in range(4)), rng.randrange(1, 9)) for _ in range(3000)]
    words = pairs.start_symbols(spark.createDataFrame(rows, "word string, count bigint"))
    whole = pairs.learn_merges(words, 9)
    with caplog.at_level("INFO", pairs.__name__):
        assert pairs.learn_merges(words, 9, most_symbols=9000) == whole
    rounds = int(caplog.messages[-1].split(" in ")[1].split()[0])
    assert len(whole) == 9 and rounds <= 4


def test_words_in_one_task_equal_one_merge_at_a_time():
    """A task with all words makes the merges by itself, a batch at a time."""
    import numpy as np
    import pyarrow as pa

    for seed in range(150):
        rng, words = random.Random(seed), Counter()
        letters = rng.choice(["ab", "abc", "abcdefgh"])
        for _ in range(rng.randint(1, 60)):
            words["".join(rng.choice(letters) for _ in range(rng.randint(2, 12)))] += rng.choice([1, 1, rng.randint(1, 40)])
        merges, longest, watched = rng.randint(1, 60), rng.choice([16, 4]), rng.choice([1, 3, 12, 20_000])
        column = pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())
        cells = pairs._Cells([[c.slice(0, 7) for c in column], [c.slice(7) for c in column]], merges)
        watch = pairs._Watch(cells.letters, merges, set(letters), longest, watched)
        pairs._learn(cells, watch, None)
        assert [((a, b), n) for a, b, n in watch.learned] == plain_merges({tuple(w): n for w, n in words.items()}, merges, letters, longest)


def test_thousands_of_merges_are_one_job(spark, caplog, monkeypatch):
    """Many words with all kinds of pairs: learned in one task, or by tasks that
    tell one another, in place of a job for every few merges."""
    rng = random.Random(9)
    words = Counter("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(4000))
    table = symbol_table(spark, words)
    with caplog.at_level("INFO", logger="quire.operators.pairs"):
        alone = pairs.learn_merges(table, 2000, most_symbols=100)
        assert caplog.messages[-1] == "2000 merges by 1 tasks in 1 rounds"
        monkeypatch.setattr(pairs, "ALONE", 0)
        assert pairs.learn_merges(table, 8) == alone[:8]
        assert " by 4 tasks in " in caplog.messages[-1]
    assert alone[:40] == plain_merges({tuple(w): n for w, n in words.items()}, 40, set())


@pytest.mark.parametrize("most_symbols,watched,merges", [(1 << 21, 20000, 25), (40, 20000, 25), (0, 12, 12), (0, 1, 4)])
def test_words_that_tasks_cannot_hold_merge_by_jobs(spark, most_symbols, watched, merges):
    rng = random.Random(0)
    words = Counter("".join(rng.choice("abc") for _ in range(rng.randint(2, 9))) for _ in range(60))
    got = pairs.learn_merges(symbol_table(spark, words), merges, set("abc"), 16, watched=watched, most_symbols=most_symbols, most_held=0)
    assert got == plain_merges({tuple(w): n for w, n in words.items()}, merges, "abc", 16)


def test_the_query_learns_as_many_pieces_as_a_real_run(spark, tmp_path):
    """Asked for 30,000 pieces, a small table gives all it has; so does the SQL."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(250)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(40)) + ".") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("en")).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries_text.train_bpe(spark, str(tmp_path)).orderBy("id").collect()
    counts = Counter(w for _, text in rows for w in text.split())
    parts = Counter()
    for w, n in counts.items():  # the stop is no letter, so a word is cut there
        for part in ["▁" + w.rstrip("."), *(["."] if w.endswith(".") else [])]:
            parts[tuple(part)] += n
    letters = set("▁" + "".join(counts))
    want = [a + b for (a, b), _ in plain_merges(parts, 30_000, letters)]
    assert len(want) > 420 and [r.piece for r in got[259 : 259 + len(want)]] == want
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert sorted(db.execute(SQL["train_bpe"]).fetchall()) == sorted(tuple(r) for r in got)


def counted_rows(df):
    """`df`, and a counter of its rows each time they are read."""
    read = df.sparkSession.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), read


def test_training_reads_words_for_characters_once_and_sizes_them_unread(spark, monkeypatch):
    """Words are read for their characters and for their parts; stored parts once, to learn."""
    rows = [("abab", 5), ("abc", 3), ("zab", 1), ("é", 1), (None, 2)]
    words, read = counted_rows(spark.createDataFrame(rows, "word string, count bigint"))
    stored, store = [], pairs.store

    def counting(df, name):
        kept, path = store(df, name)
        counted, reads = counted_rows(kept)
        stored.append((kept.count(), reads))
        return counted, path

    monkeypatch.setattr(pairs, "store", counting)
    vocab = pairs.train_bpe(words.limit(0).select(F.col("word").alias("sentence")), 20, coverage=0.9, layout="none", words=words)
    pieces = [r.piece for r in vocab.orderBy("id").collect()]
    assert pieces[:2] == ["ab", "▁ab"] and "z" not in pieces and "é" not in pieces
    assert read.value == 2 * len(rows)
    assert [(n, reads.value) for n, reads in stored] == [(3, 3)]


def test_training_of_no_words(spark):
    none = spark.createDataFrame([], "symbols array<string>, count bigint")
    assert pairs.learn_merges(none, 10) == []
    assert pairs.learn_merges(none, 10, most_held=0) == []
    text = spark.createDataFrame([("",), (None,)], "sentence string")
    assert [r.piece for r in pairs.train_bpe(text, 20).orderBy("id").collect()] == ["<unk>", "<s>", "</s>"]
