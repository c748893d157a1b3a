"""Training-log aggregates on streams, by keyed state across micro-batches.

State belongs to a rank or a run and is a few numbers, whatever has streamed by.
Rows of a micro-batch are taken in the order of their keys; `read_stream` with
few files a trigger bounds what of one key meets in a task. What has been read
and the state lie in the checkpoint, so a second start goes on in the middle of
a window.

Late rows are those whose key is not above the highest of an earlier
micro-batch: they can't take their place any more. They are left out (`drop`),
or end the stream (`fail`).
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType

from .streams import _beside

LATE = ("drop", "fail")


def _check_late(late: str) -> None:
    if late not in LATE:
        raise ValueError(f"late must be one of {LATE}")


def rolled_losses(stream: DataFrame, accumulation: int, logging_steps: int = 1, late: str = "drop") -> DataFrame:
    """`metrics.loss_rollup` on a stream of (rank, epoch, batch_idx, loss) that
    arrives in the order of (epoch, batch_idx) within each rank.

    An update is given out when its window is full; an open one waits in the
    state, with the loss of its latest epoch.
    """
    _check_late(late)
    types = {f.name: f.dataType.simpleString() for f in stream.schema}

    def run(key, frames, state):
        seen, epoch, total, last_epoch, last_batch = state.get if state.exists else (0, -1, 0.0, None, None)
        rows = pd.concat(list(frames), ignore_index=True).sort_values(["epoch", "batch_idx"], kind="stable")
        if last_epoch is not None:
            new = (rows["epoch"] > last_epoch) | ((rows["epoch"] == last_epoch) & (rows["batch_idx"] > last_batch))
            if late == "fail" and not new.all():
                raise ValueError(f"{int((~new).sum())} late rows of rank {key[0]}")
            rows = rows[new]
        if not len(rows):
            return
        window = (seen + np.arange(len(rows))) // accumulation
        parts = pd.DataFrame({"window": window, "epoch": rows["epoch"].to_numpy(), "loss": rows["loss"].to_numpy() / accumulation})
        parts = parts.groupby(["window", "epoch"], as_index=False)["loss"].sum()
        # The window that was open goes on; its loss is that of its latest epoch.
        same = (parts["window"] == seen // accumulation) & (parts["epoch"] == epoch)
        if seen % accumulation:
            parts.loc[same, "loss"] += total
        latest = parts.groupby("window", as_index=False).last()
        seen += len(rows)
        full = latest[latest["window"] < seen // accumulation]
        open_ = latest[latest["window"] >= seen // accumulation]
        epoch, total = (int(open_["epoch"].iloc[0]), float(open_["loss"].iloc[0])) if len(open_) else (-1, 0.0)
        state.update((seen, epoch, total, int(rows["epoch"].iloc[-1]), int(rows["batch_idx"].iloc[-1])))
        out = pd.DataFrame({"rank": key[0], "step": full["window"] + 1, "epoch": full["epoch"], "loss": full["loss"]})
        yield out[out["step"] % logging_steps == 0]

    return stream.select("rank", "epoch", "batch_idx", "loss").groupBy("rank").applyInPandasWithState(
        run, f"rank {types['rank']}, step bigint, epoch {types['epoch']}, loss double",
        "seen bigint, epoch bigint, total double, last_epoch bigint, last_batch bigint",
        "append", GroupStateTimeout.NoTimeout)


def monotonic_rows(stream: DataFrame, order_by: list[str], run: list[str], step: str = "step") -> DataFrame:
    """`metrics.monotonic_log` on a stream: rows whose step is not below the
    highest that their run has had before. Rows arrive in the order of
    `order_by` from micro-batch to micro-batch; within one they are sorted."""

    kind = stream.schema[step].dataType.simpleString()
    whole = kind in ("tinyint", "smallint", "int", "bigint")

    def keep(key, frames, state):
        highest = state.get[0] if state.exists else None
        rows = pd.concat(list(frames), ignore_index=True).sort_values(list(order_by), kind="stable")
        steps = rows[step].astype("Float64" if rows[step].dtype.kind == "f" else "Int64")
        before = pd.concat([pd.Series([highest], dtype=steps.dtype), steps], ignore_index=True).cummax().ffill()[:-1]
        above = pd.Series(steps.to_numpy() >= before.to_numpy()).fillna(False)
        keep_ = (before.isna() | above).to_numpy(bool)
        now = pd.concat([pd.Series([highest], dtype=steps.dtype), steps], ignore_index=True).max()
        if not pd.isna(now):
            state.update((int(now) if whole else float(now),))
        yield rows[keep_]

    return stream.groupBy(*run).applyInPandasWithState(
        keep, stream.schema, f"highest {kind}", "append", GroupStateTimeout.NoTimeout)


def append_stream(stream: DataFrame, path: str, checkpoint: str | None = None):
    """Append what a stream gives to Parquet files; ends when all is read."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", _beside(path, checkpoint))
        .trigger(availableNow=True)
        .start(path)
    )
