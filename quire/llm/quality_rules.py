"""Quality by weak supervision: rules that vote or abstain, weighed by EM.

Each rule looks at counts of the text and votes good, bad, or abstains.
Expectation-maximisation over the whole table's vote patterns estimates, for
good and for bad documents, how often each rule votes which way; the posterior
probability that a document is good then takes every vote with the weight it
has earned. A document is kept when that is over one half and it doesn't fail
one of the two base limits.

Counting is one pass of column expressions over the texts, inside one row, so
nothing is exploded and nothing moves but vote patterns, of which there are at
most 3 to the power of the number of rules. The EM steps are aggregations over
that table; parameters travel as literals.

Repeated windows are found by sorting one long for each window: the upper bits
of its hash, with its place in the lower bits, as many as the text needs.
Windows whose bits occur twice are then compared word by word.

Defined cases: a null or empty text has no words, fails the base limits and is
not kept; repeated rows vote each on their own; rows without doc_id are judged
like any other; very long texts are counted whole, in the memory of one row; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .native import let, words

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS, MOST_REPEATED = 50, 50
ROUNDS = 15
#: A rule calls at most this share of good documents bad. Without it, a kind of
#: junk that only one rule sees would be taken for a kind of good document.
MOST_FALSE = 0.001
#: Words of a window that may repeat.
WINDOW = 3

#: name: (bad when, good when), of a struct of counts; a rule abstains when
#: neither holds.
RULES = {
    "repeats": (lambda c: 100 * c["n_repeat_words"] > 40 * c["n_words"],
                lambda c: 100 * c["n_repeat_words"] < 20 * c["n_words"]),
    "lines": (lambda c: c["n_dup_lines"] >= 3, lambda c: c["n_dup_lines"] == 0),
    "symbols": (lambda c: 10 * c["n_symbols"] > c["n_words"], lambda c: 50 * c["n_symbols"] < c["n_words"]),
    "capitals": (lambda c: 3 * c["n_upper"] > c["word_chars"], lambda c: 5 * c["n_upper"] < c["word_chars"]),
    "word_length": (lambda c: ~c["word_chars"].between(2 * c["n_words"], 20 * c["n_words"]),
                    lambda c: c["word_chars"].between(3 * c["n_words"], 12 * c["n_words"])),
}


def _without(text: Column, characters: str) -> Column:
    """How many of these ASCII characters a text has."""
    return (F.octet_length(text) - F.octet_length(F.translate(text, characters, ""))).cast("bigint")


def _repeat_words(found: Column) -> Column:
    """Words in windows that occur twice or more, from a struct of the words
    `w` and the number of low bits `b` that hold a place."""
    w, b = found["w"], found["b"]
    mask = F.expr("bigint(1)")
    places = F.sequence(F.lit(0).cast("bigint"), (F.size(w) - WINDOW).cast("bigint"))
    hashed = F.transform(places, lambda i: F.call_function(
        "shiftleft", F.xxhash64(*(F.get(w, (i + k).cast("int")) for k in range(WINDOW))), b).bitwiseOR(i))
    top = lambda x: F.call_function("shiftright", x, b)

    def repeated(keys):
        twice = F.filter(keys, lambda x, i: F.coalesce(top(x) == top(F.get(keys, i - 1)), F.lit(False))
                         | F.coalesce(top(x) == top(F.get(keys, i + 1)), F.lit(False)))
        low = F.call_function("shiftleft", mask, b) - 1
        return F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(low)))

    def equal(at):
        """Of places whose windows' bits occur twice, those whose words do."""
        windows = F.sort_array(F.transform(at, lambda p: F.struct(
            F.concat_ws(" ", *(F.get(w, (p + k).cast("int")) for k in range(WINDOW))).alias("s"), p.alias("p"))))
        same = lambda all_, x, i: F.coalesce(x["s"] == F.get(all_, i)["s"], F.lit(False))
        return let(windows, lambda all_: F.sort_array(F.transform(
            F.filter(all_, lambda x, i: same(all_, x, i - 1) | same(all_, x, i + 1)), lambda x: x["p"])))

    def covered(at):
        reach = F.transform(at, lambda p, i: F.least(F.lit(WINDOW).cast("bigint"), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW).cast("bigint"))))
        return F.aggregate(reach, F.lit(0).cast("bigint"), lambda total, x: total + x)

    return let(F.sort_array(hashed), lambda keys: let(let(repeated(keys), equal), covered))


def counts(text: Column) -> Column:
    """A struct of the counts that rules look at."""

    def of(found):
        w = found["w"]
        n = F.size(w).cast("bigint")
        lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            n.alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            F.coalesce(_without(text, SYMBOLS), F.lit(0).cast("bigint")).alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            F.when(n >= WINDOW, _repeat_words(found)).otherwise(F.lit(0).cast("bigint")).alias("n_repeat_words"),
            F.coalesce(_without(text, UPPER), F.lit(0).cast("bigint")).alias("n_upper"),
        )

    pair = let(words(text), lambda w: F.struct(w.alias("w"), F.length(F.bin(F.size(w).cast("bigint"))).alias("b")))
    return let(pair, of)


def _votes(c: Column) -> list[Column]:
    """1, -1 or 0 of each rule for a struct of counts."""
    return [F.when(bad(c), -1).when(good(c), 1).otherwise(0).alias(name) for name, (bad, good) in RULES.items()]


def _log_odds(votes: list[Column], model) -> Column:
    """The model's numbers are looked up in arrays by vote. As literals inside the
    expression they would stand in the code that Spark generates, and the driver
    would compile and keep that anew for each round and each table."""
    prior, shares = model
    odds = math.log(prior / (1 - prior))
    for vote, share in zip(votes, shares):
        step = [math.log(share["good"][v] / share["bad"][v]) for v in (-1, 0, 1)]
        if not isinstance(odds, Column):
            odds = F.get(F.array(*(F.lit(odds + s) for s in step)), vote + 1)
        else:
            odds = odds + F.get(F.array(*map(F.lit, step)), vote + 1)
    return odds


def fit(patterns: DataFrame, rounds: int = ROUNDS):
    """(share of good documents, for each rule the share of each vote among
    good and bad ones) from a table of vote patterns and their counts `n`."""
    names = list(RULES)
    votes = [F.col(name) for name in names]
    # To begin with, a document that any rule calls bad is probably bad.
    posterior = F.when(F.least(*votes) < 0, 0.1).otherwise(0.9)
    model = (0.9, [{c: {v: 1 / 3 for v in (-1, 0, 1)} for c in ("good", "bad")} for _ in names])
    for _ in range(rounds):
        good, bad = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
        sums = {"good": F.sum(good), "bad": F.sum(bad)}
        for name in names:
            for v in (-1, 0, 1):
                sums[f"good {name} {v}"] = F.sum(F.when(F.col(name) == v, good).otherwise(0.0))
                sums[f"bad {name} {v}"] = F.sum(F.when(F.col(name) == v, bad).otherwise(0.0))
        row = patterns.withColumn("p", posterior).agg(*(c.alias(k) for k, c in sums.items())).first()
        if row["good"] is None:
            break
        prior = (row["good"] + 9) / (row["good"] + row["bad"] + 10)
        # Rules are taken to be better than chance: a little is added to agreement.
        model = prior, [
            {c: {v: (row[f"{c} {name} {v}"] + (2 if v == right else 1)) / (row[c] + 4) for v in (-1, 0, 1)}
             for c, right in (("good", 1), ("bad", -1))}
            for name in names
        ]
        for share in model[1]:
            share["good"][-1] = min(share["good"][-1], MOST_FALSE)
        posterior = 1 / (1 + F.exp(-_log_odds(votes, model)))
    return model


def _failed(c: Column) -> Column:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])


def _probability(c: Column, model) -> Column:
    return 1 / (1 + F.exp(-_log_odds(_votes(c), model)))


def _learned(rows: DataFrame, counted: Column):
    """The model of a table whose struct of counts is `counted`."""
    # One struct for each row, so that the counts are made once for each row.
    ballots = rows.select(let(counted, lambda c: F.struct(_failed(c).alias("failed"), *_votes(c))).alias("ballot"))
    patterns = cut_lineage(ballots.groupBy("ballot").agg(F.count("*").alias("n")))
    return fit(patterns.where("not ballot.failed").select("ballot.*", "n"))


def quality_report(docs: DataFrame) -> DataFrame:
    """One row for each document: its counts, base_failed, kept, and the
    posterior probability that it is good."""
    rows = cut_lineage(docs.select("doc_id", counts(F.col("text")).alias("stats")))
    c = F.col("stats")
    model = _learned(rows, c)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select(
        "doc_id", *(c[n].alias(n) for n in names), _failed(c).alias("base_failed"),
        (~_failed(c) & (_probability(c, model) > 0.5)).alias("kept"), _probability(c, model).alias("probability"))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without those that the rules reject. Counted twice, once to learn
    and once to decide, so that no text has to be stored or moved."""
    counted = counts(F.col(text))
    model = _learned(docs, counted)
    return docs.where(let(counted, lambda c: ~_failed(c) & (_probability(c, model) > 0.5)))
