"""Accuracy and loss aggregates, and the training log."""

from pyspark.sql import Column, DataFrame, functions as F

from .ordering import running_before, with_global_index


def token_accuracy(
    df: DataFrame, pred="y_pred", true="y_true", normalize=True, sample_weight=None, by=()
) -> DataFrame:
    """Share of equal labels, or their (weighted) number when not normalized."""
    weight = F.lit(1.0) if sample_weight is None else F.col(sample_weight).cast("double")
    hit = F.when(F.col(pred) == F.col(true), weight).otherwise(0.0)
    score = F.sum(hit) / F.sum(weight) if normalize else F.sum(hit)
    return df.groupBy(*by).agg(score.alias("accuracy"))


def causal_pairs(pred: Column, true: Column) -> Column:
    """The compared places (p, t): prediction at i against label at i+1."""
    longest = F.greatest(F.size(pred) - 1, F.lit(0))
    return F.arrays_zip(F.slice(pred, 1, longest).alias("p"), F.slice(true, 2, longest).alias("t"))


def causal_counts(pred: Column, true: Column, ignore_index: int | None = None):
    """Hits and compared places of each row.

    Ignored labels count as wrong unless `ignore_index` names them.
    """
    pairs = causal_pairs(pred, true)
    if ignore_index is not None:
        pairs = F.filter(pairs, lambda x: x["t"] != ignore_index)
    hits = F.size(F.filter(pairs, lambda x: x["p"] == x["t"]))
    return hits.cast("bigint"), F.size(pairs).cast("bigint")


def causal_accuracy(df: DataFrame, by=(), ignore_index=None, pred="y_pred", true="y_true"):
    """Shifted accuracy over all rows of each group; null where a group has no
    place to compare.

    Places become rows only inside the task, where generated code folds them to
    one row for each group; functions on whole arrays would be interpreted.
    """
    places = df.select(*by, F.explode_outer(causal_pairs(F.col(pred), F.col(true))).alias("_pair"))
    p, t = F.col("_pair.p"), F.col("_pair.t")
    compared = F.col("_pair").isNotNull() if ignore_index is None else t != ignore_index
    share = F.try_divide(F.count_if(compared & (p == t)), F.count_if(compared))
    return places.groupBy(*by).agg(share.alias("accuracy"))


def eval_reduce(df: DataFrame, ignore_index=None) -> DataFrame:
    """Mean over batches, then over ranks, of batch accuracy and batch loss.

    Takes (rank, batch_id, y_pred, y_true, loss); `loss` repeats the batch's
    loss on each of its rows. Divides by the number of ranks and by the batch
    count of rank 0.
    """
    hits, places = causal_counts(F.col("y_pred"), F.col("y_true"), ignore_index)
    batches = (
        df.select("rank", "batch_id", hits.alias("h"), places.alias("n"), "loss")
        .groupBy("rank", "batch_id")
        .agg((F.sum("h") / F.sum("n")).alias("accuracy"), F.max("loss").alias("loss"))
    )
    return reduce_batches(batches)


def reduce_batches(batches: DataFrame) -> DataFrame:
    """The mean of means over (rank, batch_id, accuracy, loss)."""
    per_rank = batches.groupBy("rank").agg(
        F.sum("accuracy").alias("a"), F.sum("loss").alias("l"), F.count("*").alias("n")
    )
    divide = F.count("*") * F.max(F.when(F.col("rank") == 0, F.col("n")))
    return per_rank.agg(
        (F.sum("a") / divide).alias("accuracy"), (F.sum("l") / divide).alias("eval_loss")
    )


def loss_rollup(df: DataFrame, accumulation: int, logging_steps: int = 1) -> DataFrame:
    """Logged training loss of (rank, epoch, batch_idx, loss).

    Batches are numbered through all epochs; each full window of
    `accumulation` batches is one update, and its loss sums the window's
    batches that belong to the epoch in which the update happens.
    """
    numbered = with_global_index(df, ["epoch", "batch_idx"], ["rank"], "_n")
    window = numbered.withColumn("step", F.floor(F.col("_n") / accumulation) + 1)
    parts = window.groupBy("rank", "step", "epoch").agg(
        F.sum(F.col("loss") / accumulation).alias("loss"), F.count("*").alias("n")
    )
    updates = parts.groupBy("rank", "step").agg(
        F.max("epoch").alias("epoch"), F.max_by("loss", "epoch").alias("loss"), F.sum("n").alias("n")
    )
    full = updates.where(F.col("n") == accumulation)
    return full.where(F.pmod("step", F.lit(logging_steps)) == 0).select(
        "rank", "step", "epoch", "loss"
    )


def step_events(steps: DataFrame, eval_steps: int, save_steps: int) -> DataFrame:
    """Flag the updates after which evaluation and saving happen."""
    return steps.withColumn("evaluates", F.pmod("step", F.lit(eval_steps)) == 0).withColumn(
        "saves", F.pmod("step", F.lit(save_steps)) == 0
    )


def monotonic_log(df: DataFrame, order_by: list[str], run: list[str] = (), step="step") -> DataFrame:
    """Keep log rows whose step is not below the highest seen before in the run."""
    seen = running_before(df, order_by, F.col(step), "_highest", list(run), how="max")
    return seen.where(F.col("_highest").isNull() | (F.col(step) >= F.col("_highest"))).drop(
        "_highest"
    )
