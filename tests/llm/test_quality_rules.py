import math
import random

import pytest
from pyspark.sql import functions as F

from quire.llm import quality_rules as qr

from .plain import odd_rows, quality_counts, vocabulary

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def counted(df):
    return df.select("doc_id", "text", qr.counts(F.col("text")).alias("c")).select("doc_id", "text", "c.*").collect()


def test_counts_of_odd_rows(odd):
    rows = counted(odd)
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert tuple(r[n] for n in NAMES) == quality_counts(r.text), r.doc_id


def test_counts_of_random_texts(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab#$ \n\tÉ|") for _ in range(rng.randint(0, 200))) for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for r in counted(df):
        assert tuple(r[n] for n in NAMES) == quality_counts(r.text)


def plain_em(patterns):
    """(share of good, votes' shares) by the same steps in plain Python."""
    names, total = list(qr.RULES), sum(patterns.values())
    p = {v: 0.1 if min(v) < 0 else 0.9 for v in patterns}
    for _ in range(qr.ROUNDS):
        good = sum(n * p[v] for v, n in patterns.items())
        prior = (good + 9) / (total + 10)
        shares = []
        for i in range(len(names)):
            share = {"good": {}, "bad": {}}
            for c, right in (("good", 1), ("bad", -1)):
                weight = {v: n * (p[v] if c == "good" else 1 - p[v]) for v, n in patterns.items()}
                whole = sum(weight.values())
                for vote in (-1, 0, 1):
                    share[c][vote] = (sum(w for v, w in weight.items() if v[i] == vote) + (2 if vote == right else 1)) / (whole + 4)
            share["good"][-1] = min(share["good"][-1], qr.MOST_FALSE)
            shares.append(share)
        odds = {v: math.log(prior / (1 - prior)) + sum(math.log(s["good"][x] / s["bad"][x]) for x, s in zip(v, shares)) for v in patterns}
        p = {v: 1 / (1 + math.exp(-o)) for v, o in odds.items()}
    return prior, p


def test_em_equals_the_plain_steps(spark):
    rng = random.Random(6)
    patterns = {}
    for _ in range(60):
        patterns[tuple(rng.choice([-1, 0, 1, 1, 1]) for _ in qr.RULES)] = rng.randint(1, 500)
    df = spark.createDataFrame([(*v, n) for v, n in patterns.items()], [*qr.RULES, "n"])
    model = qr.fit(df)
    prior, p = plain_em(patterns)
    assert model[0] == pytest.approx(prior)
    votes = [F.col(n) for n in qr.RULES]
    got = df.select(*votes, (1 / (1 + F.exp(-qr._log_odds(votes, model)))).alias("p")).collect()
    for r in got:
        assert r.p == pytest.approx(p[tuple(r[n] for n in qr.RULES)])


def test_rules_tell_junk_from_prose(spark):
    rng = random.Random(9)
    some = vocabulary(2000, "word")
    prose = lambda: " ".join(rng.choice(some) for _ in range(120))
    rows = [(i, prose()) for i in range(300)]
    rows += [(300 + i, " ".join(w + "$$$" for w in prose().split())) for i in range(20)]
    rows += [(320 + i, prose().upper()) for i in range(20)]
    rows += [(340 + i, "again " * 100) for i in range(20)]
    rows += [(360, "too short"), (361, None), (362, "")]
    got = {r.doc_id: r for r in qr.quality_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert all(got[i].kept for i in range(300))
    assert not any(got[i].kept for i in range(300, 363))
    assert got[360].base_failed and got[361].base_failed and got[345].base_failed and not got[305].base_failed


def test_empty_table_and_columns(empty, odd):
    assert qr.quality_report(empty).collect() == []
    kept = qr.keep_good(odd)
    assert kept.columns == odd.columns
    assert {6, 8, 9, 13} <= {r.doc_id for r in kept.collect()}


def test_no_python_on_the_executors(odd):
    plan = qr.keep_good(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_windows_with_equal_bits_are_compared_by_words(spark, monkeypatch):
    """However bad the hash, only windows of the same words repeat."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice(vocabulary(n)) for _ in range(80)) for n in (3, 6, 12, 40, 500) for _ in range(4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    hashed = F.xxhash64
    monkeypatch.setattr(qr.F, "xxhash64", lambda *c: F.pmod(hashed(*c), F.lit(3)))
    for r in counted(df):
        assert tuple(r[n] for n in NAMES) == quality_counts(r.text)


def test_every_model_runs_the_same_code(spark):
    """Spark keeps the code that it generates by its text; a model's numbers in
    it would make it compile anew for each round of EM and each table."""
    names = list(qr.RULES)
    shares = lambda x: [{c: {-1: x, 0: 0.5 - x / 2, 1: 0.5 - x / 2} for c in ("good", "bad")} for _ in names]
    df, texts = spark.range(9).select(*(F.pmod(F.col("id") + i, F.lit(3)).cast("int").alias(n) for i, n in enumerate(names))), []
    for prior, share in ((0.9, 0.001), (0.7, 0.2)):
        p = 1 / (1 + F.exp(-qr._log_odds([F.col(n) - 1 for n in names], (prior, shares(share)))))
        plan = df.select(p.alias("p"))._jdf.queryExecution().executedPlan()
        found = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
        texts.append([found.apply(i)._2() for i in range(found.size())])
    assert texts[0] and texts[0] == texts[1]
