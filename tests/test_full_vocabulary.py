"""Training, merging and packing with as many pieces as a real run learns."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quire.operators import pairs, tokenize as tk, vocab as vb
from quire.plans import queries_more as more
from tests.test_vocab import plain_merges

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


def test_training_to_the_end_equals_one_merge_at_a_time(spark):
    """Asked for 30,000 pieces, a small corpus gives all it has."""
    rng = random.Random(12)
    syllables = ["".join(rng.choice("abcdefghij") for _ in range(2)) for _ in range(30)]
    words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(120)]
    lines = [" ".join(rng.choice(words) for _ in range(12)) for _ in range(60)]
    df = spark.createDataFrame([(x,) for x in lines], "sentence string").repartition(3)
    got = pairs.train_bpe(df, 30_000, layout="none", split_scripts=False, coverage=1.0).orderBy("id").collect()
    counts = Counter(w for x in lines for w in x.split())
    letters = set("▁" + "".join(counts))
    want = plain_merges({tuple("▁" + w): n for w, n in counts.items()}, 30_000, letters)
    assert [r.piece for r in got[: len(want)]] == [a + b for (a, b), _ in want]
    assert {r.piece for r in got[len(want) :]} == letters and len(got) == len(want) + len(letters)


def plain_tokens(text, score):
    """Best-scored neighbours joined, leftmost first, until none is a piece."""
    parts = list("▁" + text.replace(" ", "▁"))
    while True:
        known = [(-score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]
        if not known:
            return parts
        _, i = min(known)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


@needs_data
def test_merged_size_and_tokens(spark):
    vocab = more.full_vocabulary(spark, DATA)
    base = more.word_vocabulary(spark, DATA)
    sizes = {r.name: r.value for r in more.vocab_report_full(spark, DATA).collect()}
    known = {r.piece for r in base.collect()}
    learned = [r for r in vocab.orderBy("id").collect()]
    overlap = sum(r.piece in known for r in learned)
    assert 20_000 < len(learned) <= 30_000
    assert sizes["pieces"] == sizes["distinct pieces"] == len(known) + len(learned) - overlap
    assert sizes["added pieces"] == len(learned) - overlap
    score = {r.piece: r.score for r in learned if r.origin == "trained"}
    number = {r.piece: r.id for r in learned}
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where(F.col("doc_id") < 12).select(
        "doc_id", F.substring("text", 1, 200).alias("text"))
    for r in tk.tokenize(docs, vocab, bos=False).collect():
        want = []
        for part in plain_tokens(r.text, score):
            want += [number[part]] if part in number else [number[f"<0x{b:02X}>"] for b in part.encode()]
        assert r.input_ids == want


@needs_data
def test_packed_and_compared(spark):
    blocks = more.packed_blocks_full(spark, DATA)
    assert blocks.where("n_tokens > 512").count() == 0 and blocks.count() > 0
    both = more.compare_tokenizers_full(spark, DATA).collect()
    assert all(r.merged_tokens < r.base_tokens for r in both)
