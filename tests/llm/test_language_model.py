import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from quire.llm import language_model as lm

from .plain import low_words, odd_rows, vocabulary


def tokens(text):
    return low_words(text) + ["\n"]


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def plain(rows):
    c = Counter(t for i, text in rows if not held_out(i) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    score = lambda text: sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(text))
    return [(i, held_out(i), len(tokens(t)), sum(c[x] > 0 for x in tokens(t)), n, score(t)) for i, t in rows]


def check_base(df, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in lm.score_texts(df, rounds=2).collect()), key=key)
    want = sorted(plain(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])


def test_base_of_odd_rows(odd):
    check_base(odd, [r[:2] for r in odd_rows()])


def test_empty_table_and_no_training_rows(spark, empty):
    assert lm.score_texts(empty).collect() == []
    only = next(i for i in range(100) if held_out(i))
    row = lm.score_texts(spark.createDataFrame([(only, "a b")], "doc_id bigint, text string")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert row.score < 0


def test_shares_of_a_history_add_up():
    rng = np.random.default_rng(0)
    weights = lm.Weights(rng.integers(0, 50, lm.CLASSES))
    weights.near += rng.normal(size=weights.near.shape)
    weights.both += rng.normal(size=weights.both.shape)
    assert np.allclose(np.exp(weights.log_share()).sum(2), 1)


def test_held_out_texts_are_likelier_than_under_the_base(spark):
    """Two sorts of texts with words of their own: the history tells which. Each
    pair of neighbours is seen some twenty times, so the prior gives way."""
    rng = random.Random(1)
    sorts = [vocabulary(40, "aa"), vocabulary(40, "zz")]
    rows = [(i, " ".join(rng.choice(sorts[i % 2]) + "xyz"[i % 2] for _ in range(80))) for i in range(400)]
    got = lm.score_texts(spark.createDataFrame(rows, "doc_id bigint, text string")).where("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got) * 0.97
    assert np.mean([r.score > r.base_score for r in got]) > 0.9


def test_slots_grow_with_the_text():
    sizes = [0, 1 << 20, 100 << 20, 10 << 30]
    slots = [lm.slots_for(s) for s in sizes]
    assert slots[0] == lm.NEAR and all(n & (n - 1) == 0 for n in slots)
    assert all(n * lm.NEAR_BYTES >= s for n, s in zip(slots, sizes)) and slots[-1] > 256 * lm.NEAR


def test_shares_of_a_bucket_add_up_and_are_told_in_order():
    """All classes of two histories are asked for by two groups, by hand."""
    n_slots, n_parts = 2 * lm.NEAR, 16
    classes = np.arange(lm.CLASSES)
    asked = [np.sort(np.concatenate([(slot * lm.FAR + far) * lm.CLASSES + classes for slot, far in pairs]))
             for pairs in ([(0, 1), (3, 0)], [(3, 0), (90, 2)])]
    rows = lm._table(lm._ASKED, [(-6, g, lm._deltas(a), None, lm._planes((a % 3).astype(np.uint64), 4)) for g, a in enumerate(asked)])

    class Sent:
        value = lm.Weights(np.ones(lm.CLASSES))

    got = lm._shares(Sent, n_slots, n_parts, 3)((lm.pa.scalar(-6),), rows).to_pylist()
    for told, a in zip(got, asked):
        share = np.frombuffer(told["uses"], "<f4")
        assert np.frombuffer(told["words"], np.int64).tolist() == [5] and len(share) == len(a)
        assert np.allclose((10.0 ** share).reshape(2, -1).sum(1), 1, atol=1e-4)
    one, two = (np.frombuffer(t["uses"], "<f4") for t in got)
    assert (one[lm.CLASSES:] == two[: lm.CLASSES]).all() and not np.allclose(one[: lm.CLASSES], one[lm.CLASSES:])


def test_second_word_before_tells_words_apart(spark):
    """The word after `x` follows the word before it, one of 24: eight slots
    for it would put three of them together."""
    rng = random.Random(4)
    heads, tails = vocabulary(24, "h"), [f"t{i}" + a + b for i, (a, b) in enumerate((a, b) for a in "abcdef" for b in "wxyz")]
    rows = []
    for i in range(400):
        picks = [rng.randrange(24) for _ in range(60)]
        rows.append((i, " ".join(f"{heads[p]} x {tails[p]}" for p in picks)))
    got = lm.score_texts(spark.createDataFrame(rows, "doc_id bigint, text string")).where("held_out").collect()
    gain = sum(r.score - r.base_score for r in got) / sum(r.n_tokens for r in got)
    assert gain > 0.5
