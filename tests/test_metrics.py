import pandas as pd
import pytest
from pyspark.sql import functions as F

from quire.operators import metrics as mt, userfn
from quire.plans import queries_training

PRED = "rank int, batch_id int, y_pred array<int>, y_true array<int>, loss double"


def test_accuracy_forms(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 0, 3.0), (0, 0, 5.0)], "p int, t int, w double")
    score = lambda **o: mt.token_accuracy(df, "p", "t", **o).first()[0]
    assert score() == pytest.approx(2 / 3)
    assert score(normalize=False) == 2
    assert score(sample_weight="w") == pytest.approx(0.7)
    assert score(normalize=False, sample_weight="w") == 7


def test_shift_and_ignored_labels(spark):
    df = spark.createDataFrame([(0, 0, [1, 2, 3], [9, 1, 2], 0.0)], PRED)
    assert mt.causal_accuracy(df).first().accuracy == 1.0
    masked = spark.createDataFrame([(0, 0, [1, 2, 3], [-100, -100, 2], 0.0)], PRED)
    assert mt.causal_accuracy(masked).first().accuracy == 0.5
    assert mt.causal_accuracy(masked, ignore_index=-100).first().accuracy == 1.0


def test_groups_without_a_place_to_compare(spark, tmp_path):
    """Texts of at most one character have no pair: they end no run and give no row."""
    rows = [(1, "x"), (2, ""), (3, None), (4, "aab"), (5, "é")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries_training.causal_accuracy(spark, str(tmp_path)).collect()
    assert [(r.doc_id, r.accuracy) for r in got] == [(4, 1.0)]
    short = spark.createDataFrame([(0, 0, [5], [5], 0.0), (0, 0, None, None, 0.0), (1, 0, [1, 2], [3, 4], 0.0)], PRED)
    assert {r["rank"]: r.accuracy for r in mt.causal_accuracy(short, ["rank"]).collect()} == {0: None, 1: 0.0}


def test_places_are_counted_in_generated_code(spark):
    """No function on whole arrays is interpreted, and one row a group leaves a task."""
    df = spark.createDataFrame([(0, 0, [1, 2, 3], [9, 1, 2], 0.0)], PRED)
    plan = mt.causal_accuracy(df, ["rank"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan
    below = plan[plan.index("Exchange"):]
    assert "partial_count" in below and "Generate" in below


@pytest.mark.parametrize("ignore", [None, 2])
def test_accuracy_of_odd_rows(spark, ignore):
    """Null keys, labels and places, labels of other lengths and repeated rows
    count as the arrays of each row do."""
    rows = [
        (None, 0, [1, 2, 3], [9, 1, 2], 0.0), (None, 0, [1, 2, 3], [9, 1, 2], 0.0), (None, 1, None, [1, 2], 0.0),
        (0, 0, [1, None, 3, 4], [9, None, None, 3], 0.0), (0, 0, [2, 2, 2], [2, 2], 0.0), (0, 0, [7], [7, 7, 7], 0.0),
        (0, 0, [5, 6], [4, 5, 6, 7], 0.0), (0, 0, [1, 2], None, 0.0),
        (1, 0, [], [], 0.0), (2, 0, None, None, 0.0), (3, 0, [2, 2], [2, 2], 0.0),
    ]
    df = spark.createDataFrame(rows, PRED)
    hits, places = mt.causal_counts(F.col("y_pred"), F.col("y_true"), ignore)
    want = df.select("rank", hits.alias("h"), places.alias("n")).groupBy("rank").agg(
        F.try_divide(F.sum("h"), F.sum("n")).alias("accuracy"))
    got = mt.causal_accuracy(df, ["rank"], ignore)
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r["rank"]: r.accuracy for r in got.collect()}[1] is None
    assert mt.causal_accuracy(df.limit(0), (), ignore).first().accuracy is None


def test_mean_of_means(spark):
    rows = [
        (0, 0, [1, 1, 0], [0, 1, 1], 1.0), (0, 0, [5, 0], [0, 5], 1.0),
        (0, 1, [1, 0], [0, 2], 3.0),
        (1, 0, [1, 0], [0, 1], 5.0), (1, 1, [1, 0], [0, 1], 7.0),
    ]
    row = mt.eval_reduce(spark.createDataFrame(rows, PRED)).first()
    assert row.accuracy == pytest.approx((1 + 0 + 1 + 1) / 2 / 2)
    assert row.eval_loss == pytest.approx((1 + 3 + 5 + 7) / 2 / 2)


def plain_rollup(losses, accumulation, every):
    """[(epoch, loss)] lists -> logged (step, epoch, loss), by running the loop."""
    out, seen, steps = [], 0, 0
    for epoch, batch in losses:
        total = 0
        for loss in batch:
            total += loss / accumulation
            if (seen + 1) % accumulation == 0:
                steps += 1
                if steps % every == 0:
                    out.append((steps, epoch, round(total, 9)))
                total = 0
            seen += 1
    return out


@pytest.mark.parametrize("sizes,accumulation,every", [((5, 7, 4), 4, 1), ((10, 10), 3, 2), ((2, 2, 2), 8, 1)])
def test_loss_windows_cross_epochs(spark, sizes, accumulation, every):
    losses = [(e, [float(10 * e + b) for b in range(n)]) for e, n in enumerate(sizes)]
    rows = [(0, e, b, loss) for e, batch in losses for b, loss in enumerate(batch)]
    df = spark.createDataFrame(rows, "rank int, epoch int, batch_idx int, loss double")
    got = mt.loss_rollup(df, accumulation, every).orderBy("step").collect()
    assert [(r.step, r.epoch, round(r.loss, 9)) for r in got] == plain_rollup(losses, accumulation, every)


def test_events_and_log(spark):
    steps = mt.step_events(spark.range(1, 7).toDF("step"), 2, 3).orderBy("step").collect()
    assert [r.evaluates for r in steps] == [False, True] * 3
    assert [r.saves for r in steps] == [False, False, True] * 2
    log = spark.createDataFrame(list(enumerate([1, 3, 2, 3, 5, 4])), "k int, step int")
    kept = mt.monotonic_log(log, ["k"]).orderBy("k").collect()
    assert [r.step for r in kept] == [1, 3, 3, 5]


def test_user_functions(spark):
    df = spark.createDataFrame([(i, "x y" if i % 2 else "") for i in range(9)], "i int, text string")

    def split(frame):
        assert len(frame) <= 2
        frame = frame.assign(word=frame["text"].str.split()).explode("word")
        return frame[frame["word"].notna()]

    out = userfn.map_batches(df, split, "i int, word string", ["text"], batch_rows=2)
    assert sorted(tuple(r) for r in out.collect()) == [(i, w) for i in (1, 3, 5, 7) for w in "xy"]

    def score(pred, true):
        return {"hits": sum(p == t for p, t in zip(pred, true)), "n": len(true)}

    preds = spark.createDataFrame(
        [(0, 0, [1, 1, 0], [0, 1, 1], 1.0), (0, 0, [5, 0], [0, 5], 1.0), (0, 1, [1], [1], 0.0)], PRED
    )
    got = {r.batch_id: (r.hits, r.n) for r in userfn.evaluate(preds, score, ["hits", "n"]).collect()}
    assert got == {0: (3.0, 3.0), 1: (0.0, 0.0)}


def test_partial_states_equal_whole_batches(spark):
    """One state a task and batch, whatever the order and the number of tasks."""
    rows = [(r, b, [i % 3, 1, (i + b) % 4, r], [0, i % 3, 1, i % 4], 0.0) for r in range(2) for b in range(3) for i in range(40)]
    rows += [(0, 0, None, None, 0.0), (1, 9, [4], [4], 0.0)]
    preds = spark.createDataFrame(rows, PRED).repartition(5)

    def score(pred, true):
        return {"hits": (pred == true).sum(), "n": len(true)}

    update = lambda s, pred, true: [s[0] + (pred == true).sum(), s[1] + len(true)]
    merge = lambda a, b: [x + y for x, y in zip(a, b)]
    finish = lambda s: {"hits": s[0], "n": s[1], "other": 1.0}
    whole = userfn.evaluate(preds.where("y_pred is not null"), score, ["hits", "n"])
    want = sorted(map(tuple, whole.collect()))
    for most in (10_000, 2):
        parts = userfn.evaluate_partial(preds, lambda: [0.0, 0.0], update, merge, finish, ["hits", "n"], most_keys=most)
        assert sorted(map(tuple, parts.collect())) == want


class Runs:
    """Cuts a row's text into words, and tells at the end how many there were."""

    def __init__(self):
        self.n, self.last = 0, None

    def take(self, row):
        self.last = (row["k"],)
        for word in (row["text"] or "").split():
            self.n += 1
            yield self.n, word

    def finish(self):
        if self.last:
            yield self.last, (-self.n, "end")


class Words:
    def take(self, row):
        return enumerate((row["text"] or "").split())


def test_table_function_cuts_rows(spark):
    rows = [(k, i, "a b" if i % 2 else ("c" if i else None)) for k in "xyz" for i in range(4)]
    df = spark.createDataFrame(rows, "k string, i int, text string").repartition(3)
    out = userfn.cut_table(df, Runs, "n int, word string", ["k"], partition_by=["k"], order_by=["i"])
    assert out.schema.simpleString() == "struct<k:string,n:int,word:string>"
    want = [(k, n, w) for k in "xyz" for n, w in [(1, "a"), (2, "b"), (3, "c"), (4, "a"), (5, "b"), (-5, "end")]]
    assert sorted(map(tuple, out.collect())) == sorted(want)
    whole = userfn.cut_table(df, Words, "n int, word string", ["k", "i"])
    assert "Exchange hashpartitioning(k" not in whole._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.k, r.i, r.word) for r in whole.collect()) == sorted(
        (k, i, w) for k, i, t in rows for w in (t or "").split())
    with pytest.raises(Exception, match="no columns"):
        userfn.cut_table(df, Runs, "n int, word string", ["missing"]).collect()
