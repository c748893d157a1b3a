import hashlib
import random
from bisect import bisect_left
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from quire.llm import alignment as al
from quire.llm.queries import TOKENIZERS

from .plain import odd_rows


def tools():
    files = [open(f"{TOKENIZERS}/{n}", "rb").read() for n in (al.FILE_A, al.FILE_B)]
    return al.Tokenizers(*files)


@pytest.fixture(scope="module")
def both():
    return tools()


def whole(both, text):
    """Ids and token bytes of both sides, coded in one piece; none if bytes differ."""
    if not text:
        return None
    a = both.a.encode(" " + text, add_special_tokens=False).ids
    b = both.b.encode(text)
    letters = al.byte_letters()
    bytes_a = [bytes(letters[c] for c in both.a.id_to_token(i)) for i in a]
    bytes_b = []
    for i in b:
        piece = both.b.id_to_piece(i)
        bytes_b.append(bytes([int(piece[3:5], 16)]) if both.b.is_byte(i) else piece.replace("▁", " ").encode())
    want = (" " + text).encode()
    return (a, b, bytes_a, bytes_b) if b"".join(bytes_a) == want == b"".join(bytes_b) else None


def plain(both, rows):
    """What the report says, by walking over bytes."""
    seen, docs, highest = [], Counter(), {}
    for doc, text in rows:
        coded = whole(both, text)
        links, groups = [], []
        if coded:
            a, b, bytes_a, bytes_b = coded
            owner_a = [k for k, x in enumerate(bytes_a) for _ in x]
            owner_b = [k for k, x in enumerate(bytes_b) for _ in x]
            pairs = sorted(set(zip(owner_a, owner_b)))
            links = [(a[i], b[j]) for i, j in pairs]
            here = ([], [])
            for p, (i, j) in enumerate(zip(owner_a, owner_b)):
                last_a = p + 1 == len(owner_a) or owner_a[p + 1] != i
                last_b = p + 1 == len(owner_b) or owner_b[p + 1] != j
                if last_a:
                    here[0].append(a[i])
                if last_b:
                    here[1].append(b[j])
                if last_a and last_b:
                    groups.append(here)
                    here = ([], [])
        docs.update(set(links))
        seen.append((doc, coded, links, groups))
    for (a, _), n in docs.items():
        highest[a] = max(highest.get(a, 0), n)
    out = []
    for doc, coded, links, groups in seen:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, len(coded[0]) if coded else 0, len(coded[1]) if coded else 0, len(groups), len(links),
                    sum(docs[p] == highest[p[0]] for p in links), sum(docs[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if coded else ""))
    return sorted(out, key=repr), docs


ODD = [
    "word", " two  spaces ", "end ", "   ", "▁bar ▁ x▁y", "a b  c 　d", "tab\tand\nline\r\n end\n",
    "<|endoftext|> <s> </s> <unk> <0x41>", "don't we'll it's ' s", "ﬁ café café 你好 \U0001f600", "\x00nul \x1c fs",
    "12345 6,7.8 !!! ...\t", "x" * 5000, "- - - -- — ’s", "the the the the",
]


def rows_of():
    rng = random.Random(3)
    rows = [(r[0], r[1] if r[0] != 12 else "x" * 3000) for r in odd_rows() if r[0] != 11]
    rows += [(200 + i, t) for i, t in enumerate(ODD)]
    rows += [(300 + i, " ".join(rng.choice(ODD) for _ in range(4))) for i in range(30)]
    return rows


def seen(df):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_report_equals_walk_over_bytes(spark, both):
    rows = rows_of()
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, n_a string").repartition(3)
    want, pairs = plain(both, rows)
    assert seen(al.alignment_report(df, TOKENIZERS)) == want
    got = {(r.a, r.b): r.n_docs for r in al.id_pairs(df, TOKENIZERS).collect()}
    assert got == dict(pairs)


def test_small_groups_and_slices_change_nothing(spark, both, monkeypatch):
    rows = rows_of()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    monkeypatch.setattr(al, "slices", lambda column, limit: ((i, min(i + 3, len(column))) for i in range(0, len(column), 3)))
    tasks = al._encode(type("Sent", (), {"value": [open(f"{TOKENIZERS}/{n}", "rb").read() for n in (al.FILE_A, al.FILE_B)]}), 7)
    batches = [b for b in df.toArrow().to_batches()]
    monkeypatch.setattr(al, "GROUP_PAIRS", 40)
    stored = [r for b in tasks(batches) for r in b.to_pylist()]
    assert len({r["group"] for r in stored}) > 10
    import pyarrow as pa

    asked = {}
    for r in stored:
        if r["bucket"] is not None:
            asked.setdefault(r["bucket"], []).append(r)
    answers = [r for b, part in asked.items() for r in al._answer(b, pa.Table.from_pylist(part)).to_pylist()]
    met = [dict.fromkeys(("docs", "cuts", "stats", "links", "numbers")) | r for r in answers]
    met += [dict.fromkeys(("counts", "best", "places")) | {k: r[k] for k in ("group", "docs", "cuts", "stats", "links", "numbers")}
            for r in stored if r["bucket"] is None]
    met.sort(key=lambda r: (r["group"], r["counts"] is None))
    batches = pa.Table.from_pylist(met).to_batches(max_chunksize=2)
    got = [tuple(r.values()) for out in al._finish(batches) for r in out.to_pylist()]
    assert sorted(got, key=repr) == plain(both, rows)[0]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert seen(al.alignment_report(empty, TOKENIZERS)) == []
    assert al.align_tokens(empty, TOKENIZERS).collect() == al.id_pairs(empty, TOKENIZERS).collect() == []


def test_aligned_tokens(spark, both):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(99, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for r in al.align_tokens(df, TOKENIZERS).collect():
        coded = whole(both, dict(rows)[r.doc_id])
        assert (r.a_ids, r.b_ids) == ((coded[0], coded[1]) if coded else ([], []))
        if coded:
            sizes = [[0, *np.cumsum([len(x) for x in side]).tolist()] for side in coded[2:]]
            assert [sizes[0][c] for c in r.a_cuts] == [sizes[1][c] for c in r.b_cuts]
            assert [sizes[0][c] for c in r.a_cuts] == sorted(set(sizes[0][1:]) & set(sizes[1][1:]))


@given(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400)), st.sampled_from([1, 2, 7, 64]))
@settings(max_examples=200, deadline=None)
def test_gallop_finds_ranks(x, y, lane):
    short, long = (np.array(sorted(v), np.int64) for v in (x, y))
    assert al.gallop(short, long, max(2, lane)).tolist() == [bisect_left(sorted(y), v) for v in sorted(x)]


@given(st.lists(st.text(alphabet=st.sampled_from(" \t\nab'.,1 　▁é你́ﬁ\x00\x85s"), max_size=30), max_size=8))
@settings(max_examples=150, deadline=None)
def test_pieces_code_as_whole_texts(texts):
    both = tools() if not hasattr(test_pieces_code_as_whole_texts, "kept") else test_pieces_code_as_whole_texts.kept
    test_pieces_code_as_whole_texts.kept = both
    coded = al.Coded(al._Known(both), texts)
    got = {int(r): (coded.a[coded.first_a[t] : coded.first_a[t + 1]].tolist(), coded.b[coded.first_b[t] : coded.first_b[t + 1]].tolist())
           for t, r in enumerate(coded.rows)}
    want = {i: whole(both, t)[:2] for i, t in enumerate(texts) if whole(both, t)}
    assert got == want
