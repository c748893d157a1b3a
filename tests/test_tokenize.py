import random

import pytest
from pyspark.sql import functions as F

from quire.operators import tokenize as tk, vocab as vb
from quire.operators.vocab import FIRST_WORD_ID

SCHEMA = "id int, piece string, score double, origin string"
# A sentence with its pieces under a base and an extended vocabulary.
SENTENCE = "卵巢肌瘤会有什么症状？卵巢肌瘤是妇科常见病之一"
BASE = ["▁", "会", "有", "么", "状", "？", "是", "科", "常", "之", "一"]
ADDED = [
    "卵巢", "▁卵巢", "肌瘤", "会有", "什么", "症状", "会有什么", "会有什么症状", "妇科", "是妇科",
    "常见", "常见病", "之一", "卵", "巢", "肌", "瘤", "什", "症", "妇", "见", "病",
]
EXTENDED = ["▁卵巢", "肌瘤", "会有什么症状", "？", "卵巢", "肌瘤", "是妇科", "常见病", "之一"]


def make(spark, pieces, scores=None):
    scores = scores or [-float(i) for i in range(len(pieces))]
    rows = [(FIRST_WORD_ID + i, p, s, "x") for i, (p, s) in enumerate(zip(pieces, scores))]
    return vb.reserved_pieces(spark).unionByName(spark.createDataFrame(rows, SCHEMA))


def run(spark, texts, vocab, mode="bpe", bos=False, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    got = tk.tokenize(df, vocab, mode=mode, bos=bos, **options).orderBy("i").collect()
    names = {r.id: r.piece for r in vocab.collect()}
    return [[names[t] for t in r.input_ids] for r in got]


def test_base_vocabulary_gives_fifty_pieces(spark):
    got = run(spark, [SENTENCE], make(spark, BASE))[0]
    want = ["▁"]
    for c in SENTENCE:
        want += [c] if c in BASE else [f"<0x{b:02X}>" for b in c.encode()]
    assert got == want and len(got) == 50


def test_extended_vocabulary_gives_nine_pieces(spark):
    base = make(spark, BASE)
    extra = spark.createDataFrame([(i, p, -1.0, "y") for i, p in enumerate(ADDED)], SCHEMA)
    assert run(spark, [SENTENCE], vb.merge_vocab(base, extra))[0] == EXTENDED


def plain_bpe(text, scores):
    """Best-scored neighbours first, leftmost on ties, over the whole text."""
    parts = list("▁" + text.replace(" ", "▁")) if text else []
    while True:
        best = None
        for i in range(len(parts) - 1):
            s = scores.get(parts[i] + parts[i + 1])
            if s is not None and (best is None or s > best[0]):
                best = (s, i)
        if best is None:
            break
        i = best[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    out = []
    for p in parts:
        out += [p] if p in scores else [f"<0x{b:02X}>" for b in p.encode()]
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_merging_equals_the_plain_rule(spark, seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcé") for _ in range(rng.randint(1, n)))
    pieces = list(dict.fromkeys(["▁", "▁▁", "a", "b"] + [
        rng.choice(["", "▁"]) + word(4) for _ in range(40)]))
    scores = [float(rng.choice([0, -1, -2, -3, -50])) for _ in pieces]
    texts = ["  ".join(word(9) for _ in range(rng.randint(0, 6))) for _ in range(30)]
    texts += [word(9) * 30 + "卵" + word(9) * 30 for _ in range(5)]
    texts += [" lead", "trail  ", "   ", "", "a\nb\tc", "abcabc" * 200]
    table = dict(zip(pieces, scores))
    assert run(spark, texts, make(spark, pieces, scores)) == [plain_bpe(t, table) for t in texts]


def test_piece_across_words_turns_off_cutting(spark):
    pieces = ["a▁b", "a▁", "▁a", "b"]
    texts = ["a b", "b a b a b"]
    table = dict(zip(pieces, [0.0, 0.0, -9.0, -9.0]))
    got = run(spark, texts, make(spark, pieces, list(table.values())))
    assert got == [plain_bpe(t, table) for t in texts] and "a▁b" in got[0]


def test_special_pieces_inside_text(spark):
    vocab = make(spark, ["▁x", "▁", "x", "▁▁"])
    got = run(spark, ["x</s>", "<s>x</s>x", "</s></s>", "x </s>", "x</s> x"], vocab)
    assert got == [
        ["▁x", "</s>"], ["<s>", "▁x", "</s>", "▁x"], ["</s>", "</s>"],
        ["▁x", "▁", "</s>"], ["▁x", "</s>", "▁", "▁x"],
    ]


def test_reserved_names_spelled_out_are_text(spark):
    vocab = make(spark, ["▁", "<", "0", "x", "4", "1", ">"])
    assert run(spark, ["<0x41>"], vocab)[0] == ["▁", "<", "0", "x", "4", "1", ">"]


def test_options_and_missing_text(spark):
    df = spark.createDataFrame([(0, "x y"), (1, None), (2, "")], "i int, text string")
    rows = tk.tokenize(
        df, make(spark, ["x", "y"]), mode="whitespace", eos=True, mask=True
    ).orderBy("i").collect()
    assert [r.input_ids for r in rows] == [[1, 259, 260, 2], [1, 2], [1, 2]]
    assert [r.attention_mask for r in rows] == [[1] * 4, [1] * 2, [1] * 2]
    with pytest.raises(ValueError):
        tk.tokenize(df, make(spark, ["x"]), mode="words")
    with pytest.raises(ValueError):
        tk.tokenize(df, make(spark, ["x"]), max_pieces=10)


@pytest.mark.parametrize("mode", ["whitespace", "char"])
@pytest.mark.parametrize("hot", [0, 2, 1000])
def test_join_gives_the_same_ids_with_a_hot_unit(spark, mode, hot):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["hot", "hot", "hot", "é", f"w{rng.randrange(50)}"])
                      for _ in range(rng.randint(0, 30))) for _ in range(60)] + [None, "", "卵"]
    vocab = make(spark, ["hot", "w1", "w2", "h", "o", " "])
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    a = tk.tokenize(df, vocab, mode=mode).orderBy("i").collect()
    b = tk.tokenize_by_join(df, vocab, ["i"], mode=mode, hot_units=hot).orderBy("i").collect()
    assert [r.input_ids for r in a] == [r.input_ids for r in b]


def test_bytes_decode_back(spark):
    texts = ["ünï 卵", "\U0001f600 x", "a"]
    got = run(spark, texts, make(spark, ["zz"]), mode="char")
    assert [bytes(int(p[3:5], 16) for p in row).decode() for row in got] == texts


def test_comparison_counts(spark):
    df = spark.createDataFrame([("a", "x y"), ("a", "zz")], "lang string, text string")
    base = make(spark, ["x", "y"])
    merged = make(spark, ["x", "y", "zz"])
    row = tk.compare_tokenizers(df, base, merged, mode="whitespace", by=["lang"]).first()
    assert (row.texts, row.base_tokens, row.merged_tokens) == (2, 4, 3)
    assert row.base_byte_share == 0.5 and row.merged_byte_share == 0.0


def test_texts_without_spaces_stay_out_of_the_cache(spark):
    """Long units are coded each time; what a worker keeps stays small."""
    vocab = tk.Vocabulary([(i, p, -float(i)) for i, p in enumerate("ab")] + [(2, "ab", -0.0)])
    for i in range(200):
        vocab.merge("ab" * 3000 + "a" * i)
    info = vocab._cached.cache_info()
    assert info.maxsize == tk.CACHED_UNITS and info.currsize <= 2
    assert vocab.merge("abab" * 20) == [2] * 40


def test_a_worker_gets_a_vocabulary_by_its_entries():
    import pickle

    vocab = tk.Vocabulary([(0, "x", 0.0), (1, "y", -1.0)])
    again = pickle.loads(pickle.dumps(vocab))
    assert again.entries == vocab.entries and again.merge("xy") == [0, 1]


def test_char_mode_codes_any_character(spark):
    rows = [(1, "ab\U0001f600é b"), (2, ""), (3, None)]
    df = spark.createDataFrame(rows, "k int, text string")
    got = {r.k: r.input_ids for r in tk.tokenize(df, make(spark, ["a", "é"]), mode="char", bos=False).collect()}
    byte = lambda c: [3 + b for b in c.encode()]
    assert got[1] == [259] + byte("b") + byte("\U0001f600") + [260] + byte(" ") + byte("b")
    assert got[2] == []


@pytest.mark.parametrize("mode", ["whitespace"])
def test_join_with_one_long_unit_in_every_row(spark, mode, monkeypatch):
    """A unit of 10 KB is joined by its key, spread over salts, and its text doesn't travel with each row."""
    vocab = make(spark, ["a", "b"])
    long_ = "é" * 5000
    rows = [(i, f"a {long_} b {'x' * (70 + i % 3)}") for i in range(60)] + [(60, None), (61, long_)]
    df = spark.createDataFrame(rows, "i int, text string").repartition(4)
    want = {r.i: r.input_ids for r in tk.tokenize(df, vocab, mode=mode).collect()}
    monkeypatch.setattr(tk, "LONG_UNITS", 2)
    joined = tk.tokenize_by_join(df, vocab, ["i"], mode=mode, hot_units=1)
    assert {r.i: r.input_ids for r in joined.collect()} == want
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan


def test_large_batches_are_coded_in_parts(spark, monkeypatch):
    """Rows of many units are spread a few at a time, with the same ids."""
    rows = [(i, " ".join(["ab", "x", "zz"][(i + k) % 3] for k in range(i % 5 * 10)) if i % 7 else None) for i in range(40)]
    rows = spark.createDataFrame(rows, "k int, text string").coalesce(1)
    vocab = make(spark, ["ab", "x"])
    get = lambda mode: {r.k: r.input_ids for r in tk.tokenize(rows, vocab, mode=mode).collect()}
    want = {mode: get(mode) for mode in ("whitespace", "char")}
    found, sizes = tk._spread, []
    import pyarrow as pa

    texts = pa.array(["ab x"] * 100 + [None, ""])
    monkeypatch.setattr(tk, "SLICE_UNITS", 8)
    monkeypatch.setattr(tk, "_spread", lambda *a: sizes.append(len(a[3])) or found(*a))
    monkeypatch.setattr(tk.F, "arrow_udf", lambda run, kind: run)
    sent = type("Sent", (), {"value": tk.load_vocabulary(vocab)})
    parts = list(tk.char_encoder(sent)(iter([texts])))
    listed = pa.array([t.split() if t is not None else None for t in texts.to_pylist()])
    words = list(tk.encoder(sent, "whitespace")(iter([listed])))
    assert max(sizes) <= 8 and len(parts) > 10 and len(words) > 10
    assert pa.concat_arrays(parts).to_pylist()[0] == want_ids(sent.value, "ab x") and len(pa.concat_arrays(parts)) == 102
    assert pa.concat_arrays(words).to_pylist() == [sent.value.lookup("ab") + sent.value.lookup("x")] * 100 + [None, []]
    assert want["whitespace"][0] == want["char"][0]


def want_ids(vocab, text):
    return [t for c in text for t in vocab.lookup(c)]


def test_callers_frames_are_of_bounded_size(spark):
    from quire.operators import userfn

    rows = spark.createDataFrame([(i, "word " * 20_000) for i in range(100)], "k int, text string").coalesce(1)
    sizes = userfn.map_batches(rows, lambda f: f.assign(n=int(f["text"].str.len().sum()))[["k", "n"]], "k int, n bigint")
    assert sizes.count() == 100 and max(r.n for r in sizes.collect()) <= userfn.FRAME_BYTES


def test_join_moves_no_places_of_units(spark, monkeypatch):
    """A group of rows asks for a unit once; rows that share a key, and those of
    a null key, come out as before."""
    vocab = make(spark, ["hot", "a"])
    monkeypatch.setattr(tk, "GROUP_BYTES", 200)
    rows = [(i, "k", "hot a z " * (i % 9)) for i in range(80)] + [(5, "k", "z hot"), (None, "k", "a"), (90, None, "a")]
    df = spark.createDataFrame(rows, "i int, j string, text string").repartition(3)
    joined = tk.tokenize_by_join(df, vocab, ["i", "j"], hot_units=1, bos=False)
    code = {"hot": [259], "a": [260], "z": [3 + ord("z")]}
    got = {}
    for r in joined.collect():
        got.setdefault((r.i, r.j), []).append(r.input_ids)
    for i in range(80):
        if i != 5:
            assert got[i, "k"] == [[t for w in "hot a z".split() * (i % 9) for t in code[w]]]
    first, second = "hot a z".split() * 5, ["z", "hot"]
    both = sorted((p, code[w]) for words in (first, second) for p, w in enumerate(words))
    assert got[5, "k"] == [[t for _, ids in both for t in ids]] * 2
    assert got[None, "k"] == [[]] and got[90, None] == [[]]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "posexplode" not in plan


def test_join_asks_for_pieces_only_and_deals_texts_once(spark, monkeypatch):
    """Units that are no piece are never asked for, and both steps read one exchange
    of the texts; a piece that comes twice, or has no id, is coded as before."""
    monkeypatch.setattr(tk, "GROUP_BYTES", 500)
    long_ = "p" * 100
    vocab = make(spark, ["hot", "a", long_, "a"]).union(spark.createDataFrame([(None, "z", 0.0, "x")], "id int, piece string, score double, origin string").select(*make(spark, []).columns))
    rows = [(i, f"hot a {long_} z x{i} y{i * 7}" if i % 5 else None, [i]) for i in range(120)]
    df = spark.createDataFrame(rows, "i long, text string, other array<int>").repartition(3)
    joined = tk.tokenize_by_join(df, vocab, ["i"], hot_units=1, bos=False)
    byte = lambda u: [3 + b for b in u.encode()]
    got = joined.collect()
    assert joined.columns == ["i", "text", "other", "input_ids"] and len(got) == 120
    for r in got:
        want = [259, 260, 262, 261, *byte("z"), *byte(f"x{r.i}"), *byte(f"y{r.i * 7}")] if r.i % 5 else []
        assert r.input_ids == want and r.other == [r.i]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    import pyarrow as pa

    sent = type("Sent", (), {"value": (tk.piece_filter(vocab.selectExpr("unhex(md5(piece)) AS _unit")), {tk._digest("hot"): [259]})})
    batch = pa.record_batch([pa.array([1, 1, 2]), pa.array([["hot", "a", "none"], ["a", "z"], ["a"]])], ["_group", "_units"])
    told = [(g, u) for b in tk._asked(sent)(iter([batch, batch.slice(2)])) for g, u in zip(*(c.to_pylist() for c in b.columns))]
    assert sorted(told) == sorted([(1, tk._digest("a")), (1, tk._digest("z")), (2, tk._digest("a"))])


def test_units_coded_at_once_equal_one_by_one():
    """Best pair first, leftmost among equal scores, bytes where nothing fits."""
    import numpy as np

    reserved = [(i, p, 0.0) for i, p in enumerate(vb.SPECIAL_PIECES + [f"<0x{b:02X}>" for b in range(256)])]
    for seed in range(80):
        rng = random.Random(seed)
        letters = rng.choice(["ab", "abc▁", "abcdé卵▁"])
        pieces = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 25))})
        scores = [rng.choice([0.0, -float(i), -float(rng.randint(0, 5))]) for i in range(len(pieces))]
        vocab = tk.Vocabulary(reserved + [(259 + i, p, x) for i, (p, x) in enumerate(zip(pieces, scores))])
        units = ["".join(rng.choice(letters + "x ") for _ in range(rng.choice([1, 2, 3, 8, 30, 60]))) for _ in range(rng.randint(0, 40))]
        ids, sizes = vocab.merge_all(units)
        ends = np.cumsum(sizes)
        assert [ids[e - n : e].tolist() for e, n in zip(ends, sizes)] == [vocab.merge(u) for u in units]


def test_encoding_codes_short_units_together(spark, monkeypatch):
    """Short units of a batch are one call, with special and long ones beside them."""
    import pyarrow as pa

    vocab = make(spark, ["ab", "▁ab", "x"])
    sent = type("Sent", (), {"value": tk.load_vocabulary(vocab)})
    monkeypatch.setattr(tk.F, "arrow_udf", lambda run, kind: run)
    asked, found = [], tk.Vocabulary.merge_all
    monkeypatch.setattr(tk.Vocabulary, "merge_all", lambda self, units: asked.append(len(units)) or found(self, units))
    units = [" ab", "x", "</s>", "ab" * 50, " abé"]
    got = pa.concat_arrays(list(tk.encoder(sent, "bpe")(iter([pa.array([units, None, [], units[::-1]])])))).to_pylist()
    want = [sent.value.merge(u) for u in units]
    assert got == [[t for x in want for t in x], None, [], [t for x in want[::-1] for t in x]] and asked == [3]
    monkeypatch.setattr(tk, "TABLE_PIECES", 1)
    plain = type("Sent", (), {"value": tk.load_vocabulary(vocab)})
    assert pa.concat_arrays(list(tk.encoder(plain, "bpe")(iter([pa.array([units])])))).to_pylist() == got[:1]
