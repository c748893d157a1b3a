"""Caller-supplied functions over batches."""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


#: Bytes of a frame that a caller's function is given at once.
FRAME_BYTES = 4 << 20


def map_batches(df: DataFrame, fn, schema, drop: list[str] = (), batch_rows: int | None = None):
    """Apply `fn(pandas frame) -> pandas frame` batch by batch; rows may change.

    `drop` names input columns that `fn`'s result must not carry on. Batches
    follow the session's Arrow batch size, in parts of some `FRAME_BYTES` where
    rows are large; pass `batch_rows` for parts of so many rows.
    """
    dropped = list(drop)

    def run(frames):
        for frame in frames:
            parts = -(-int(frame.memory_usage(deep=True).sum()) // FRAME_BYTES)
            step = batch_rows or max(1, -(-len(frame) // max(1, parts)))
            for start in range(0, len(frame), step):
                out = fn(frame.iloc[start : start + step].reset_index(drop=True))
                yield out.drop(columns=[c for c in dropped if c in out.columns])

    return df.mapInPandas(run, schema)


def evaluate(df: DataFrame, metric_fn, metrics: list[str], by=("rank", "batch_id")) -> DataFrame:
    """One row per batch from `metric_fn(pred, true) -> dict`.

    `pred` and `true` are flat numpy arrays, already shifted by one. A group is one
    batch, so it stays small.
    """
    by = list(by)
    kept = df.select(
        *by,
        F.slice("y_pred", 1, F.greatest(F.size("y_pred") - 1, F.lit(0))).alias("p"),
        F.slice("y_true", 2, F.greatest(F.size("y_true") - 1, F.lit(0))).alias("t"),
    )
    fields = [f"{c} {df.schema[c].dataType.simpleString()}" for c in by]
    schema = ", ".join(fields + [f"{m} double" for m in metrics])

    def run(key, frame):
        scores = metric_fn(np.concatenate(frame["p"].to_list()), np.concatenate(frame["t"].to_list()))
        return pd.DataFrame([dict(zip(by, key)) | {m: float(scores[m]) for m in metrics}])

    return kept.groupBy(*by).applyInPandas(run, schema)


def cut_table(df: DataFrame, make, fields: str, keep: list[str] = (), partition_by: list[str] = (),
              order_by: list[str] = ()) -> DataFrame:
    """One row to many by a table function over `df`.

    `make()` gives an object for each partition: `take(row)` returns the rows
    (tuples of `fields`) that a row is cut into, and `finish()`, if it has that,
    those that are left at the partition's end as (kept values, tuple) pairs.
    The result has the columns `keep` of the input, with their types there,
    before `fields`. With `partition_by` all rows of a key are one partition, in
    the order of `order_by`; choose keys of bounded size. Without it Spark's own
    partitions are used and nothing moves.
    """
    kept, added = list(keep), T.StructType.fromDDL(fields)
    parts, order = list(partition_by), list(order_by)

    class Cut:
        @staticmethod
        def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
            columns = {f.name: f for f in rows.dataType.fields}
            missing = [c for c in [*kept, *parts, *order] if c not in columns]
            if missing:
                raise ValueError(f"no columns {missing}")
            return AnalyzeResult(
                schema=T.StructType([columns[c] for c in kept] + added.fields),
                partitionBy=[PartitioningColumn(c) for c in parts],
                orderBy=[OrderingColumn(c) for c in order],
            )

        def __init__(self):
            self.handler = make()

        def eval(self, row: T.Row):
            head = tuple(row[c] for c in kept)
            for out in self.handler.take(row):
                yield (*head, *out)

        def terminate(self):
            if hasattr(self.handler, "finish"):
                for head, out in self.handler.finish():
                    yield (*head, *out)

    return F.udtf(Cut)(df.asTable())


def evaluate_partial(df: DataFrame, init, update, merge, finish, metrics: list[str], by=("rank", "batch_id"),
                     most_keys: int = 10_000) -> DataFrame:
    """One row per batch from a metric with partial states.

    `init()` gives a state (a list of numbers), `update(state, pred, true)` adds
    a sequence (flat arrays, already shifted by one), `merge(a, b)` joins two
    states and `finish(state)` gives the metrics. States are folded where the
    sequences lie, so a task sends one row for each batch that it holds, and no
    batch has to fit into one task. A task that meets more than `most_keys`
    batches sends what it has and begins anew.
    """
    by = list(by)
    kept = df.select(*by, F.col("y_pred").cast("array<bigint>").alias("p"), F.col("y_true").cast("array<bigint>").alias("t"))
    types = [f"{c} {df.schema[c].dataType.simpleString()}" for c in by]

    def fold(batches):
        states: dict = {}

        def send(schema):
            keys = list(states)
            columns = [pa.array([k[i] for k in keys], schema.field(c).type) for i, c in enumerate(by)]
            values = pa.array([[float(x) for x in states[k]] for k in keys], pa.list_(pa.float64()))
            states.clear()
            return pa.RecordBatch.from_arrays([*columns, values], [*by, "state"])

        schema = None
        for batch in batches:
            schema = batch.schema
            columns = [batch.column(c).to_pylist() for c in by]
            for i, key in enumerate(zip(*columns)):
                pred, true = (batch.column(c)[i].values for c in ("p", "t"))
                if pred is None or true is None:
                    continue
                state = states[key] if key in states else init()
                states[key] = update(state, pred.to_numpy(zero_copy_only=False)[:-1], true.to_numpy(zero_copy_only=False)[1:])
                if len(states) > most_keys:
                    yield send(schema)
        if states:
            yield send(schema)

    def join(key, frame):
        state = None
        for part in frame["state"]:
            state = list(part) if state is None else merge(state, list(part))
        return pd.DataFrame([dict(zip(by, key)) | {m: float(v) for m, v in finish(state).items() if m in metrics}])

    partial = kept.mapInArrow(fold, ", ".join([*types, "state array<double>"]))
    return partial.groupBy(*by).applyInPandas(join, ", ".join(types + [f"{m} double" for m in metrics]))
