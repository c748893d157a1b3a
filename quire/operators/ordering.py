"""Row positions and running values over a whole table, without ever sorting
the table into a single partition.

Spark rows have no order, so every ordered operator names its key. The key
must be unique inside a group, otherwise ties fall in any order; placing rows
in runs refuses a key that repeats.
"""

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

ROWS_PER_BUCKET = 200_000
SAMPLES_PER_BUCKET = 10
MAX_BUCKETS = 65_536


#: Key types whose text form reads back as the same value.
_EXACT_TEXT = (
    T.StringType, T.IntegralType, T.BooleanType, T.DateType, T.DecimalType, T.FloatType, T.DoubleType,
    T.TimestampNTZType,
)


def _comparable(column: Column, kind: T.DataType) -> tuple[Column, T.DataType]:
    """A key column as one of the same order whose text form is exact."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column), T.LongType()
    if isinstance(kind, T.BinaryType):
        return F.hex(column), T.StringType()
    if isinstance(kind, _EXACT_TEXT):
        return column, kind
    raise TypeError(f"rows can't be ordered by a key of type {kind.simpleString()}")


def _key_parts(keys: list[str], fields: list[T.StructField]):
    return [(f.name, *_comparable(F.col(k), f.dataType)) for k, f in zip(keys, fields)]


def key_text(keys: list[str], fields: list[T.StructField]) -> Column:
    """A key as JSON of its columns' exact text forms."""
    return F.to_json(F.struct(*(c.cast("string").alias(n) for n, c, _ in _key_parts(keys, fields))))


def search_bounds(bounds: list[str], keys: list[str], fields: list[T.StructField]) -> Column:
    """How many of the sorted `bounds` (texts of `key_text`) are <= the row's key.

    The bounds travel as one folded array literal and are searched by halving,
    so a row costs log2(len(bounds)) comparisons.
    """
    if not bounds:
        return F.lit(0)
    parts = _key_parts(keys, fields)
    text = T.StructType([T.StructField(n, T.StringType()) for n, _, _ in parts])
    typed = T.StructType([T.StructField(n, kind) for n, _, kind in parts])
    array = F.from_json(F.lit(f"[{','.join(bounds)}]"), T.ArrayType(text)).cast(T.ArrayType(typed))
    key = F.struct(*(c.alias(n) for n, c, _ in parts))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda low, step: F.when(F.get(array, low + step - 1) <= key, low + step).otherwise(low),
    )


def bucket_count(rows: int, df: DataFrame) -> int:
    width = df.sparkSession.sparkContext.defaultParallelism
    return min(MAX_BUCKETS, max(width, -(-rows // ROWS_PER_BUCKET)))


def range_buckets(
    df: DataFrame, keys: list[str], buckets: int | None = None, rows: int | None = None
) -> Column:
    """Key ranges of similar size, from a small sample of the key columns.

    Reads only the key columns, twice. The bounds become literals, so any later
    job (or a recomputed task) puts a row in the same bucket.
    """
    only = df.select(*keys)
    rows = only.count() if rows is None else rows
    if buckets is None:
        buckets = bucket_count(rows, df)
    if buckets <= 1 or rows <= 1:
        return F.lit(0)
    fraction = min(1.0, SAMPLES_PER_BUCKET * buckets / rows)
    sample = (
        only.sample(fraction, seed=17)
        .select(F.struct(*keys).alias("key"))
        .orderBy("key")
        .select(key_text([f"key.{k}" for k in keys], only.schema.fields).alias("key"))
        .collect()  # about SAMPLES_PER_BUCKET * buckets keys
    )
    picked = [sample[i * len(sample) // buckets].key for i in range(1, buckets)] if sample else []
    return search_bounds(list(dict.fromkeys(picked)), keys, only.schema.fields)


def run_rows(rows: int, unit: int, df: DataFrame, max_chunks: int = MAX_BUCKETS) -> int:
    """Rows of one run: whole units, sized for a task rather than by the unit.

    A few runs for each core as long as a run stays under ROWS_PER_BUCKET.
    """
    width = df.sparkSession.sparkContext.defaultParallelism
    wanted = max(min(ROWS_PER_BUCKET, rows // (4 * width)), -(-rows // max_chunks))
    return unit * max(1, -(-wanted // unit))


def hex_buckets(digest: str, buckets: int) -> Column:
    """Ranges of an evenly spread hex digest column; needs no sample."""
    ranges = min(buckets, MAX_BUCKETS)
    return F.floor(F.conv(F.substring(digest, 1, 4), 16, 10).cast("int") * ranges / 65536)


def running_before(
    df: DataFrame,
    order_by: list[str],
    value: Column,
    name: str,
    within: list[str] = (),
    how: str = "sum",
    total: str | None = None,
    bucket: Column | None = None,
    buckets: int | None = None,
    rows: int | None = None,
    repeats: bool = False,
) -> DataFrame:
    """Add `name`: the sum (or max) of `value` over all earlier rows of the group.

    Buckets cover consecutive key ranges. Each bucket is reduced to one number,
    those numbers are scanned, and rows are scanned inside their bucket only.
    The whole row moves once; joining the bucket offsets uses the same keys.
    With `repeats`, `_repeated` marks rows whose key an earlier row has, and
    `_repeats` counts them within their bucket.
    """
    within, order_by = list(within), list(order_by)
    if bucket is None:
        bucket = range_buckets(df, within + order_by, buckets, rows)
    fold = F.sum if how == "sum" else F.max
    # Never null, so the join below adds no second look at the bucket.
    bucket = F.coalesce(bucket.cast("int"), F.lit(0))
    marked = df.withColumn("_bucket", bucket).withColumn("_value", value)
    group = within + ["_bucket"]
    folded = marked.groupBy(*group).agg(fold("_value").alias("_fold"))
    order = W.partitionBy(*within).orderBy("_bucket")  # at most MAX_BUCKETS rows a group
    offsets = folded.select(
        *group,
        fold("_fold").over(order.rowsBetween(W.unboundedPreceding, -1)).alias("_offset"),
        fold("_fold").over(W.partitionBy(*within)).alias("_total"),
    )
    before = fold("_value").over(
        W.partitionBy(*group).orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1)
    )
    if how == "sum":
        result = F.coalesce(F.col("_offset"), F.lit(0)) + F.coalesce(before, F.lit(0))
    else:
        result = F.greatest(F.col("_offset"), before)
    columns = [F.col(c) for c in df.columns] + [result.alias(name)]
    if total:
        columns.append(F.col("_total").alias(total))
    joined = marked.join(offsets, group)
    if not repeats:
        return joined.select(*columns)
    in_order = W.partitionBy(*group).orderBy(*order_by)
    key = F.struct(*order_by)
    same = F.coalesce(F.lag(key).over(in_order).eqNullSafe(key) & (F.row_number().over(in_order) > 1), F.lit(False))
    upto = in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
    return joined.select(*columns, *group, same.alias("_repeated")).withColumn(
        "_repeats", F.sum(F.col("_repeated").cast("int")).over(upto)
    )


def with_global_index(
    df: DataFrame,
    order_by: list[str],
    within: list[str] = (),
    name: str = "position",
    total: str | None = None,
    **options,
) -> DataFrame:
    """Add the row's 0-based position in key order, per group if `within` is given."""
    return running_before(df, order_by, F.lit(1), name, within, total=total, **options)


def place_in_runs(
    df: DataFrame,
    order_by: list[str],
    within: list[str],
    starts_run,
    rows: int,
    marks: dict[str, Column] | None = None,
    digest: str | None = None,
) -> tuple[Column, list]:
    """Key ranges that begin exactly where `starts_run(position, total)` holds.

    Works on the key columns alone; `rows` is the table's size. `digest` names a
    leading key that spreads evenly and so needs no sample. Returns the row's range number ("chunk") as
    a column, and the collected starts: (position, total, and each of `marks`)
    per range, in key order. Rows grouped by chunk can then be numbered in
    place, so a table is put in order with one move of its full rows.
    """
    keys = [*within, *order_by]
    only = df.select(*keys)
    buckets = min(MAX_BUCKETS, -(-rows // ROWS_PER_BUCKET))  # keys are narrow: no minimum
    bucket = hex_buckets(digest, buckets) if digest else None
    placed = with_global_index(
        only, order_by, within, "_position", "_total", bucket=bucket, buckets=buckets, rows=rows,
        repeats=True,
    )
    position, total = F.col("_position"), F.col("_total")
    extra = [column.alias(name) for name, column in (marks or {}).items()]
    starts = (
        placed.where(starts_run(position, total) | (F.col("_repeats") == 1) & F.col("_repeated"))
        .select(F.struct(*keys).alias("_key"), position, total, "_repeated", *extra)
        .orderBy("_key")
        .withColumn("_key", key_text([f"_key.{k}" for k in keys], only.schema.fields))
        .collect()  # one row per range: callers choose runs so these stay few
    )
    if any(r["_repeated"] for r in starts):
        raise ValueError(f"keys must be unique: {keys} repeats")
    return search_bounds([r["_key"] for r in starts], keys, only.schema.fields) - 1, starts


def lookup(values: list, index: Column) -> Column:
    """The value of a bigint list at a row's index."""
    if not values:
        return F.lit(None).cast("bigint")
    return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>"), index)
