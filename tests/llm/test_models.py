"""Learned operators: held-out accuracy, plain versions of their parts, odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import importance, languages, toxicity

from .plain import odd_rows, vocabulary

TWO = {"aa": "bcdfg", "bb": "äöüßk", "cc": "éèçrl"}


def invented(rng, letters, n):
    return " ".join("".join(rng.choice(letters + "aeiou") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(7)
    names = sorted(TWO)
    rows = [(i, invented(rng, TWO[names[i % 3]], rng.choice([3, 20, 300])), names[i % 3]) for i in range(600)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string").cache()


def test_held_out_languages(texts):
    got = languages.language_report(texts).join(texts.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 100
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_code_switched_words(texts, spark):
    """Half of the words in one language, half in another: shares say so."""
    rng = random.Random(1)
    mixed = [(1, invented(rng, TWO["aa"], 200) + " " + invented(rng, TWO["cc"], 200), None)]
    rows = texts.union(spark.createDataFrame(mixed, texts.schema).withColumn("doc_id", F.lit(-1).cast("bigint")))
    score = languages.language_report(rows).where("doc_id = -1").first().score
    assert 0.4 < score < 0.65


def test_each_word_of_a_mixed_text_has_its_language(texts, spark):
    rng = random.Random(6)
    order = ["aa", "cc", "bb", "aa"]
    mixed = [(-1, " ".join(invented(rng, TWO[n], 150) for n in order), None), (-2, " 12 34 ", None), (-3, None, None)]
    rows = texts.union(spark.createDataFrame(mixed, texts.schema))
    got = languages.language_runs(rows, F.lit(False)).where("doc_id < 0").orderBy("start").collect()
    assert {r.doc_id for r in got} == {-1}
    assert [r.start for r in got] == [0, *(r.end for r in got[:-1])] and got[-1].end == 600
    assert all(a.language != b.language for a, b in zip(got, got[1:])) and all(0 < r.probability <= 1 for r in got)
    of_words = [r.language for r in got for _ in range(r.start, r.end)]
    assert np.mean([w == order[i // 150] for i, w in enumerate(of_words)]) > 0.95
    none = languages.language_runs(rows.withColumn("lang", F.lit(None).cast("string")), F.lit(False))
    assert none.collect() == []


def test_languages_are_learned_from_whole_texts(spark):
    """Long texts that begin alike, or with spaces, whatever their language."""
    rng = random.Random(4)
    menu = " ".join(rng.choice(["home", "menu", "login"]) for _ in range(400))
    rows = []
    for i in range(240):
        name = ("bb", "cc")[i % 2]
        begin = "" if i % 3 == 1 else (menu + " ", " " * 400)[i % 5 == 0]
        rows.append((i, begin + invented(rng, TWO[name], 30 if i % 3 == 1 else 1200), name))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = languages.identify(docs, F.col("doc_id") % 3 == 1, words_per_row=200, rounds=4)
    got = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) == 80 and np.mean([r.lang_pred == r.lang for r in got]) > 0.95


def test_drawn_words_are_as_many_as_asked_for():
    words = languages.Words(pa.array(["a " * 1000, "b " * 7, "", "c " * 35]))
    keep = languages._drawn(words, np.array([5, 6, 7, 8]), 33)
    assert [int(keep[i:j].sum()) for i, j in zip(words.first[:-1], words.first[1:])] == [33, 7, 0, 33]
    assert keep[500:1000].any() and keep[:500].any()


def test_language_of_odd_rows(odd, empty):
    got = languages.language_report(odd).collect()
    assert len(got) == len(odd_rows())
    by_text = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by_text[i].lang_pred == "und" and by_text[i].score == 0 for i in (1, 2, 3))
    assert by_text[10].lang_pred in {"en", "de", "fr"}
    assert languages.language_report(empty).collect() == []
    none = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in languages.language_report(none).collect()} == {"und"}


def test_forward_backward_equals_sums_over_all_paths():
    rng = np.random.default_rng(2)
    scores, move = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3))
    valid = np.array([[1, 1, 1, 1], [1, 1, 1, 0]], bool)
    share = languages.forward_backward(scores, move, valid)[0]
    for s, length in ((0, 4), (1, 3)):
        want = np.zeros((length, 3))
        for path in np.ndindex(*[3] * length):
            p = np.exp(sum(scores[s, t, k] for t, k in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            for t, k in enumerate(path):
                want[t, k] += p
        assert np.allclose(share[s, :length], want / want.sum(1, keepdims=True))


def test_toxic_documents_are_found_and_clean_ones_left(spark):
    rng = random.Random(3)
    some = vocabulary(800, "word")
    bad = ["idiot", "moron", "worthless", "stupid", "pathetic"]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % 5 == 0
        text = [rng.choice(some) for _ in range(rng.choice([20, 200, 2000]))]
        for _ in range(3 if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text)))
        if i % 3:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = toxicity.toxicity_report(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    unseen = [r for r in got if r.doc_id % 3 == 0]
    assert np.mean([r.toxic for r in unseen if r.doc_id % 5 == 0]) > 0.95
    assert np.mean([r.toxic for r in unseen if r.doc_id % 5]) < 0.01
    assert len(got) == 1500


def test_earlier_probabilities_of_training_rows_are_out_of_fold():
    """A row's earlier probability comes from the model of its own fold."""
    model = toxicity.Model(0)
    model.rest[:, 0] = [-3.0, 0.0, 3.0, 9.0]
    fold = np.array([0, 1, 2, 0])
    none = np.zeros(0, np.int64)
    before = toxicity._before_out_of_fold([model], none, none, fold)
    assert np.allclose(before[:, 0], toxicity.sigmoid(np.array([-3.0, 0.0, 3.0, -3.0])))


def test_unrelated_texts_with_a_common_word_pair_are_no_copies(spark):
    """All texts begin with one pair whose hash is less than any other's."""
    rng = random.Random(11)
    some, bad = vocabulary(3000, "word"), ["idiot", "moron", "worthless", "stupid", "pathetic"]
    pairs = [f"pair{i} common" for i in range(200000)]
    pair = pairs[int(np.argmin(toxicity.twins(toxicity.Words(pa.array(pairs), toxicity.ALNUM, lower=True))))]
    rows = []
    for i in range(600):
        text = [rng.choice(some) for _ in range(30)] + ([rng.choice(bad) for _ in range(3)] if i % 4 == 0 else [])
        rng.shuffle(text)
        rows.append((i, " ".join([pair, *text])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600) if i % 3], "doc_id bigint, toxic int")
    got = [r for r in toxicity.toxicity_report(docs, labels).collect() if r.doc_id % 3 == 0]
    assert np.mean([r.toxic for r in got if r.doc_id % 4 == 0]) > 0.9
    assert np.mean([r.toxic for r in got if r.doc_id % 4]) < 0.02


def test_near_copies_are_told_from_texts_with_common_pairs():
    rng = random.Random(2)
    some = vocabulary(500, "word")
    text = [rng.choice(some) for _ in range(400)]
    close, other = [*text[:200], "new", *text[200:]], text[:100] + [rng.choice(some) for _ in range(300)]
    column = pa.array([" ".join(t) for t in (text, other, close, text)] + ["", "one", "two"])
    signs = toxicity.signatures(toxicity.Words(column, toxicity.ALNUM, lower=True))
    assert sorted(toxicity.near_copies([0] * 7, signs)) == [2, 3]
    assert toxicity.near_copies([0, 1, 2, 3, 0, 0, 0], signs) == []


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(6, 1), (8, 0), (None, 1), (999, 0), (9, None)], "doc_id bigint, toxic int")
    assert toxicity.toxicity_report(odd, labels).count() == len(odd_rows())
    assert toxicity.toxicity_report(empty, labels).collect() == []
    assert not any(r.toxic for r in toxicity.toxicity_report(odd, labels.limit(0)).collect())


def test_resampling_prefers_text_like_the_target(spark):
    rng = random.Random(5)
    good, junk = vocabulary(300, "good"), vocabulary(300, "junk")
    rows = [(i, " ".join(rng.choice(good if i % 4 else junk) for _ in range(60))) for i in range(800)]
    labels = [(i, int(bool(i % 4))) for i in range(0, 800, 3)]
    got = importance.quality_selection(
        spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()
    share = np.mean([q for _, q in labels])
    assert sum(r.kept for r in got) == round(share * 800)
    assert np.mean([r.kept for r in got if r.doc_id % 4]) > 0.97
    assert np.mean([r.kept for r in got if not r.doc_id % 4]) < 0.05


@pytest.mark.parametrize("k", [0, 1, 7, 500, 999, 1000])
def test_the_last_place_is_the_kth_largest(spark, k, monkeypatch):
    monkeypatch.setattr(importance, "RANGES", 8)
    rng = random.Random(k)
    values = [rng.gauss(0, 100) ** 3 for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "place double")
    want = float("inf") if k == 0 else sorted(values, reverse=True)[k - 1]
    assert importance._last_place(df, k) == want


def test_resampling_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(6, 1), (8, 0), (None, 1)], "doc_id bigint, quality int")
    got = importance.quality_selection(odd, labels).collect()
    assert len(got) == len(odd_rows())
    assert importance.quality_selection(empty, labels).collect() == []
    assert not any(r.kept for r in importance.quality_selection(odd, labels.limit(0)).collect())
