import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.llm import collocations as co

from .plain import LOWER, odd_rows


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def plain(rows, least, keep, longest=5, share=100):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase."""
    counts, out = {}, []
    for lang, text in rows:
        for w in pieces(text):
            for m in range(1, longest + 1):
                for i in range(len(w) - m + 1):
                    counts.setdefault(lang or "und", Counter())[tuple(w[i : i + m])] += 1
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        rows = []
        for p, a in candidates.items():
            inside = lambda q: len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            if any(100 * c >= share * a and inside(q) for q, c in candidates.items()):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:keep], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def seen(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def text_of(rng, words, n):
    return "".join(rng.choice(words) + rng.choice([" ", " ", " ", " ", "  \t", ". ", "\n", ","]) for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    bound = ["new york city", "a b a b a", "x x x x x x", "one two three four five six", "Été du Nord"]
    rows = []
    for i in range(60):
        lang = rng.choice(["en", "en", "de", None, "und"])
        weights = words[:8] * 6 + words
        rows.append((lang, text_of(rng, weights, 150) + " ".join(rng.choice(bound) for _ in range(rng.randrange(6)))))
    return rows


@pytest.mark.parametrize("seed, least, keep, first", [(1, 3, 2000, 20_000), (2, 3, 5, 3), (3, 2, 12, 1), (4, 6, 1, 4)])
def test_equals_counting_everything(spark, seed, least, keep, first):
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "lang string, text string, phrase string, n string").repartition(3)
    assert seen(co.mine_phrases(df, least=least, keep=keep, first_words=first)) == plain(rows, least, keep)


def test_waves_leave_frequent_words_closed(spark, monkeypatch):
    """With few phrases wanted, the second wave takes no word below the bound."""
    rows, asked = corpus(5), []
    count = co._Corpus.count
    monkeypatch.setattr(co._Corpus, "count", lambda self, rows, lengths: asked.append((rows.where(f"kind = {co.AFTER}").collect(), self)) or count(self, rows, lengths))
    df = spark.createDataFrame(rows, "lang string, text string")
    assert seen(co.mine_phrases(df, least=3, keep=2, first_words=30)) == plain(rows, 3, 2)
    grown = {(r.lang, r.phrase) for part, _ in asked for r in part if " " not in r.phrase}
    words = {(lang or "und", w) for lang, t in rows for p in pieces(t) for w in p}
    assert 0 < len(grown) < len(words)


def test_share_below_all_and_short_phrases(spark):
    rows = corpus(6)
    df = spark.createDataFrame(rows, "lang string, text string")
    assert seen(co.mine_phrases(df, least=3, keep=50, longest=3, share=60)) == plain(rows, 3, 50, 3, 60)


def test_odd_rows_and_languages(spark, odd):
    rows = [(r[2], r[1]) for r in odd_rows()]
    assert seen(co.mine_phrases(odd, least=20, keep=40)) == plain(rows, 20, 40)


def test_empty_table_and_no_candidates(spark, empty):
    assert co.mine_phrases(empty).collect() == []
    one = spark.createDataFrame([("en", "a b"), ("en", None), (None, "")], "lang string, text string")
    assert co.mine_phrases(one).collect() == []


def test_tiny_filter_and_many_passes_change_nothing(spark, monkeypatch):
    """A full filter counts more, never less."""
    rows = corpus(7)
    monkeypatch.setattr(co, "LEAST_BITS", co.PART_BITS)
    monkeypatch.setattr(co, "MOST_BITS", co.PART_BITS)
    monkeypatch.setattr(co, "_fold_bits", lambda rows, size: rows.count() * 0 + co.np.full(size // 8, 255, co.np.uint8))
    df = spark.createDataFrame(rows, "lang string, text string")
    assert seen(co.mine_phrases(df, least=4, keep=10, first_words=10)) == plain(rows, 4, 10)


def test_scores_pass_64_bits(spark):
    big = [(3_000_000_000_017, 9_000_000_000_000_011, 3_000_000_000_019, 4_000_000_000_037), (100, 10**15, 100, 100), (100, 700, 100, 107)]
    df = spark.createDataFrame(big, "f bigint, n bigint, l bigint, r bigint").withColumn("score", F.expr(co.SCORE))
    assert [r.score for r in df.collect()] == [1000 * a * n // (l * r) for a, n, l, r in big]


def test_word_counts_are_folded_in_the_task(monkeypatch):
    import numpy as np
    import pyarrow as pa

    slices = [("en", 5, ["a", "b"], np.array([2, 3]), None), ("de", 4, ["a"], np.array([4]), None), ("en", 9, [], np.array([]), None),
              ("en", 3, ["b", "c"], np.array([1, 2]), None)]
    monkeypatch.setattr(co, "_unpacked", lambda batches: iter(slices * 50))
    for held in (co.HELD, 4, 1):
        monkeypatch.setattr(co, "HELD", held)
        rows = pa.Table.from_batches(list(co._word_rows(None))).to_pylist()
        total = Counter()
        for r in rows:
            total[r["lang"], r["phrase"], r["m"]] += r["n"]
        assert total == {("en", "a", 1): 100, ("en", "b", 1): 200, ("en", "c", 1): 100, ("de", "a", 1): 200,
                         ("en", "", 0): 850, ("de", "", 0): 200}
        assert held < 10 or len(rows) == 6


def test_slices_stay_compressed_until_their_turn():
    """An Arrow batch holds all of a task's slices: the codes of a text of few
    words take less than their 4 bytes each, and come back unchanged."""
    import pyarrow as pa

    class All:
        value = co.np.full(1 << 13, 255, co.np.uint8)

    texts = pa.RecordBatch.from_arrays([pa.array(["en", "de", "en"]), pa.array(["a b c " * 2000 + ". d", "x", None])], ["lang", "text"])
    [rows] = [pa.Table.from_batches(list(co._store_runs(All)([texts])))]
    seen = {lang: (total, words, counts.tolist(), codes) for lang, total, words, counts, codes in co._unpacked(rows.to_batches())}
    total, words, counts, codes = seen["en"]
    assert (total, dict(zip(words, counts))) == (6001, {"a": 2000, "b": 2000, "c": 2000, "d": 1})
    assert [words[c - 1] for c in codes[1:]] == ["a", "b", "c"] * 2000 and codes[0] == 0
    assert seen["de"][:3] == (1, ["x"], [1]) and not len(seen["de"][3])
    assert rows.column("codes").nbytes < 4 * len(codes) / 10


def test_only_what_is_asked_of_a_length_is_looked_up(monkeypatch):
    """Neighbours of single words are looked up once for each word, other phrases
    where their length and kind are asked for; the rows are those of the filter."""
    import pyarrow as pa

    class All:
        value = co.np.full(1 << 13, 255, co.np.uint8)

    texts = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(["a b c d " * 500])], ["lang", "text"])
    runs = list(co._store_runs(All)([texts]))
    looked, holds = [], co._Filter.holds
    monkeypatch.setattr(co._Filter, "holds", lambda self, h, kind: looked.append((kind, len(h))) or holds(self, h, kind))

    def counted(kinds):
        looked.clear()
        rows = pa.Table.from_batches(list(co._count(All, kinds)(runs)), co._FRAME).to_pylist()
        return Counter({r["phrase"]: r["n"] for r in rows})

    words = "a b c d".split() * 500
    every = lambda m: Counter(" ".join(words[i : i + m]) for i in range(len(words) - m + 1))
    assert counted({2: [co.AFTER, co.BEFORE]}) == every(2)
    assert sorted(looked) == [(co.AFTER, 5), (co.BEFORE, 5)]
    assert counted({2: [co.ITSELF], 4: [co.AFTER]}) == every(2) + every(4)
    assert looked == [(co.ITSELF, 1999), (co.AFTER, 1997)]
    assert counted({}) == Counter() and not looked
