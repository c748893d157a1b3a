import numpy as np
import pyarrow as pa
from hypothesis import given, strategies as st

from quire.llm.words import ALNUM, NON_SPACE, Words, slices, windows, within

from .plain import alnum_words, low_words, words

texts = st.lists(st.one_of(st.none(), st.text(max_size=60)), max_size=8)


def listed(w):
    cut = [w.data[s:e].tobytes().decode("utf-8") for s, e in zip(w.starts, w.ends)]
    return [cut[i:j] for i, j in zip(w.first[:-1], w.first[1:])]


@given(texts)
def test_words_are_those_of_the_pattern(some):
    some = [None if t is None else t.encode("utf-8", "ignore").decode() for t in some]
    column = pa.array(some, pa.string())
    assert listed(Words(column)) == [words(t) for t in some]
    assert listed(Words(column, NON_SPACE, lower=True)) == [low_words(t) for t in some]
    assert listed(Words(column, ALNUM, lower=True)) == [alnum_words(t) for t in some]


@given(texts)
def test_a_sliced_column_gives_the_same_words(some):
    some = [None if t is None else t.encode("utf-8", "ignore").decode() for t in some]
    column = pa.array(["before it", *some, "after"], pa.string()).slice(1, len(some))
    assert listed(Words(column)) == [words(t) for t in some]


def test_equal_words_have_equal_hashes_and_others_do_not():
    w = Words(pa.array(["a bb a abcdefgh abcdefghi abcdefghijklmnopq abcdefghijklmnopr", "bb"]))
    h = w.hashes()
    cut = [x for text in listed(w) for x in text]
    for i in range(len(cut)):
        for j in range(len(cut)):
            assert (h[i] == h[j]) == (cut[i] == cut[j])


def test_windows_stay_in_one_text():
    w = Words(pa.array(["a b c", "", "d e", "f g h i"]))
    assert within(w.first, 3).tolist() == [0, 5, 6]
    assert len(windows(w.hashes(), 3)) == 7


def test_slices_are_bounded():
    column = pa.array(["x" * 10] * 10 + ["y" * 100] + [None, ""])
    parts = list(slices(column, 25))
    assert parts[0] == (0, 2) and parts[-1][1] == 13
    assert all(b == c for (_, b), (c, _) in zip(parts, parts[1:]))
    assert (10, 11) in parts or any(a <= 10 < b for a, b in parts)
    assert np.all(np.diff([a for a, _ in parts]) > 0)
