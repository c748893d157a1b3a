"""Queries on batches, metrics, user functions and streams."""

from pyspark.sql import functions as F

from ..functions import arrays as ar, text as tx
from ..operators import batches as bt, metrics as mt, packing as pk, userfn
from ..operators.tokenize import tokenize
from ..session import cut_lineage, drop_stored, new_path
from ..sources import processed
from ..streaming import streams
from . import preparation, sql_parts as q
from .fixtures import (
    batch_losses, documents, predictions, split_of, table, texts, word_vocabulary,
)
from .queries_tokens import TOKENS, _encoded_sql, encoded, word_tokens
from .registry import query

EPOCHS, SEED = 2, 11


def shuffled_sql(source="docs", key="doc_id", epochs=EPOCHS, by="split, epoch"):
    return f"""
epochs AS (SELECT *, unnest(range({epochs}))::INT AS epoch FROM {source}),
shuffled AS (
  SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY
      md5(concat_ws(':', {SEED}, epoch, {key})), {key}) - 1 AS position,
    count(*) OVER (PARTITION BY {by}) AS total FROM epochs)"""


def ranked_sql(world):
    return f"""
ranked AS (
  SELECT * EXCLUDE (slot), (slot % {world})::INT AS rank, slot // {world} AS rank_position
  FROM (SELECT *, unnest(range(position, rank_rows * {world}, total)) AS slot
        FROM (SELECT *, (total + {world - 1}) // {world} AS rank_rows FROM shuffled)))"""


def _shuffled(spark, sf_dir):
    docs = documents(spark, sf_dir).drop("text")
    return bt.epoch_shuffle(
        bt.expand_epochs(docs, EPOCHS), ["doc_id"], SEED, within=["split", "epoch"]
    )


@query(f"""WITH {q.DOCS}, epochs AS (SELECT doc_id, unnest(range(3))::INT AS epoch FROM docs)
SELECT doc_id, epoch FROM epochs""")
def expand_epochs(spark, sf_dir):
    return bt.expand_epochs(documents(spark, sf_dir).select("doc_id"), 2.5)


@query(f"""WITH {q.DOCS}, {shuffled_sql()}
SELECT doc_id, split, epoch, position, total FROM shuffled""")
def epoch_shuffle(spark, sf_dir):
    return _shuffled(spark, sf_dir)


@query(f"""WITH {q.DOCS}, {shuffled_sql()}, {ranked_sql(7)}
SELECT doc_id, split, epoch, rank, rank_position, rank_rows FROM ranked""")
def shard_ranks(spark, sf_dir):
    return bt.shard_ranks(_shuffled(spark, sf_dir), 7)


@query(f"""WITH {q.DOCS}, {shuffled_sql()}, {ranked_sql(3)}
SELECT doc_id, split, epoch, rank, rank_position // 7 AS batch, (rank_position % 7)::INT AS slot FROM ranked
WHERE (rank_position // 7 + 1) * 7 <= rank_rows""")
def train_batches(spark, sf_dir):
    placed = bt.make_batches(bt.shard_ranks(_shuffled(spark, sf_dir), 3), 7, drop_last=True)
    return placed.drop("rank_position", "rank_rows")


@query(f"""WITH {q.DOCS}, {shuffled_sql()}, {ranked_sql(3)}
SELECT doc_id, split, epoch, rank, rank_position // 7 AS batch, (rank_position % 7)::INT AS slot FROM ranked""")
def eval_batches(spark, sf_dir):
    placed = bt.make_batches(bt.shard_ranks(_shuffled(spark, sf_dir), 3), 7, drop_last=False)
    return placed.drop("rank_position", "rank_rows")


def stored(spark, rows):
    path = new_path(spark, "prepared")
    processed.write_processed(rows, path)
    return processed.read_processed(spark, path)


def stacked(column):
    rows = f"[array_to_string(r, ' ') FOR r IN {column}]"
    return f"array_to_string({rows}, '|')"


def _stacked(column):
    return F.array_join(F.transform(column, ar.joined), "|")


@query(f"""WITH {TOKENS}, {q.batches()}, {q.packed(512)},
rows AS (SELECT *, concat_ws('-', split, shard, batch, block) AS name FROM blocks),
{shuffled_sql('rows', 'name', 1, 'epoch')}, {ranked_sql(2)},
placed AS (SELECT * EXCLUDE (batch), rank_position AS batch FROM ranked)
SELECT epoch, rank, batch, {stacked('list(input_ids ORDER BY rank_position)')} AS ids,
  list_sum(flatten(list([1 FOR i IN input_ids])))::BIGINT AS mask_sum FROM placed GROUP BY ALL""")
def collate_fixed(spark, sf_dir):
    tokens = word_tokens(spark, sf_dir).select("split", "doc_id", "input_ids")
    packed = pk.pack_blocks(pk.assign_batches(tokens, ["doc_id"]), ["doc_id"])
    # Batches of one, as short blocks count too and only equal lengths stack.
    # They are cut from the stored blocks, as a trainer would read them.
    named = stored(spark, packed).select(
        F.concat_ws("-", "split", "shard", "batch", "block").alias("name"),
        "input_ids", "attention_mask", "label",
    )
    batches = preparation.epoch_batches(named, ["name"], 2, 1, seed=SEED)
    return batches.select(
        "epoch", "rank", "batch", _stacked("input_ids").alias("ids"),
        F.aggregate(
            F.flatten("attention_mask"), F.lit(0).cast("bigint"), lambda a, x: a + x
        ).alias("mask_sum"),
    )


@query(_encoded_sql(f""",
rows AS (SELECT conv_id * 1000 + turn AS k, input_ids, labels FROM seq),
{shuffled_sql('rows', 'k', EPOCHS, 'epoch')}, {ranked_sql(3)},
placed AS (SELECT *, rank_position // 4 AS batch FROM ranked),
sized AS (SELECT *, max(len(input_ids)) OVER (PARTITION BY epoch, rank, batch) AS longest FROM placed),
padded AS (
  SELECT epoch, rank, batch, rank_position,
    input_ids || [0 FOR i IN range(longest - len(input_ids))] AS input_ids,
    labels || [-100 FOR i IN range(longest - len(input_ids))] AS labels FROM sized)
SELECT epoch, rank, batch, {stacked('list(input_ids ORDER BY rank_position)')} AS ids,
  {stacked('list(labels ORDER BY rank_position)')} AS labels,
  sum(len([x FOR x IN input_ids IF x <> 0]))::BIGINT AS mask_sum FROM padded GROUP BY ALL""".lstrip()))
def collate_padded(spark, sf_dir):
    rows = stored(spark, encoded(spark, sf_dir).withColumn("split", F.lit("train")))
    rows = rows.drop("split").withColumn("k", F.col("conv_id") * 1000 + F.col("turn"))
    batches = preparation.epoch_batches(
        rows.drop("conv_id", "turn"), ["k"], 3, 4, EPOCHS, SEED, drop_last=False, pad_id=0
    )
    return batches.select(
        "epoch", "rank", "batch", _stacked("input_ids").alias("ids"),
        _stacked("labels").alias("labels"),
        F.size(F.filter(F.flatten("attention_mask"), lambda m: m)).cast("bigint").alias("mask_sum"),
    )


@query(f"""WITH {q.DOCS}, c AS (SELECT split, count(*) AS num_rows FROM docs GROUP BY split),
r AS (SELECT *, (num_rows + 1) // 2 AS rank_rows FROM c), b AS (SELECT *, rank_rows // 3 AS batches FROM r),
u AS (SELECT *, batches // 8 AS updates_per_epoch FROM b)
SELECT *, ceil((2.5 - 0) * greatest(updates_per_epoch, 1))::BIGINT AS total_steps FROM u""")
def step_plan(spark, sf_dir):
    return bt.step_plan(documents(spark, sf_dir), 2, 3, 8, 2.5)


@query("SELECT round(avg((quality = toxic)::INT), 12) AS accuracy FROM labels")
def token_accuracy(spark, sf_dir):
    result = mt.token_accuracy(table(spark, sf_dir, "labels"), "quality", "toxic")
    return result.select(F.round("accuracy", 12).alias("accuracy"))


@query("""SELECT lang, sum((quality = toxic)::INT * n_chars)::DOUBLE AS matched,
  round(sum((quality = toxic)::INT * n_chars) / sum(n_chars), 12) AS weighted
FROM labels JOIN documents USING (doc_id) GROUP BY lang""")
def weighted_accuracy(spark, sf_dir):
    scored = table(spark, sf_dir, "labels").join(
        table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars"), "doc_id"
    )
    count = mt.token_accuracy(scored, "quality", "toxic", False, "n_chars", ["lang"])
    share = mt.token_accuracy(scored, "quality", "toxic", True, "n_chars", ["lang"])
    return count.withColumnRenamed("accuracy", "matched").join(
        share.select("lang", F.round("accuracy", 12).alias("weighted")), "lang"
    )


PREDICTIONS = f"""
truth AS (
  SELECT (doc_id % 2)::INT AS rank, (doc_id // 16)::INT AS batch_id, doc_id,
    [unicode(c) FOR c IN {q.chars('text')}] AS y_true FROM documents),
predictions AS (
  SELECT *, [CASE WHEN i % 3 = 0 THEN y_true[i + 1] ELSE coalesce(y_true[i + 2], 0) END
             FOR i IN range(len(y_true))] AS y_pred FROM truth),
places AS (
  SELECT rank, batch_id, doc_id, unnest(y_pred[:len(y_pred) - 1]) AS p, unnest(y_true[2:]) AS t
  FROM predictions WHERE len(y_true) > 1)"""


@query(f"""WITH {PREDICTIONS}
SELECT doc_id, round(avg((p = t)::INT), 12) AS accuracy FROM places GROUP BY doc_id""")
def causal_accuracy(spark, sf_dir):
    result = mt.causal_accuracy(predictions(spark, sf_dir), ["doc_id"])
    return result.select("doc_id", F.round("accuracy", 12).alias("accuracy")).where(
        F.col("accuracy").isNotNull()
    )


@query(f"""WITH {PREDICTIONS}
SELECT round(avg((p = t)::INT), 12) AS accuracy FROM places WHERE t <> 32""")
def causal_accuracy_ignoring(spark, sf_dir):
    result = mt.causal_accuracy(predictions(spark, sf_dir), ignore_index=32)
    return result.select(F.round("accuracy", 12).alias("accuracy"))


@query(f"""WITH {PREDICTIONS}, b AS (
  SELECT rank, batch_id, avg((p = t)::INT) AS a, any_value(batch_id % 7 + 0.5) AS loss
  FROM places GROUP BY rank, batch_id)
SELECT round(sum(a) / (2 * count(*) FILTER (rank = 0)), 9) AS accuracy,
  round(sum(loss) / (2 * count(*) FILTER (rank = 0)), 9)::DOUBLE AS eval_loss FROM b""")
def eval_reduce(spark, sf_dir):
    result = preparation.evaluation(predictions(spark, sf_dir))
    return result.select(
        F.round("accuracy", 9).alias("accuracy"), F.round("eval_loss", 9).alias("eval_loss")
    )


LOSSES = """
losses AS (
  SELECT (event_id % 4)::INT AS rank, (event_id // 4 % 3)::INT AS epoch,
         (event_id // 12)::INT AS batch_idx, value AS loss FROM events),
ran AS (
  SELECT *, row_number() OVER (PARTITION BY rank ORDER BY epoch, batch_idx) - 1 AS n FROM losses),
windows AS (
  SELECT *, n // 8 + 1 AS step, max(epoch) OVER (PARTITION BY rank, n // 8) AS last_epoch,
    count(*) OVER (PARTITION BY rank, n // 8) AS size FROM ran),
updates AS (
  SELECT rank, step, last_epoch AS epoch, sum(loss / 8) AS loss FROM windows
  WHERE size = 8 AND epoch = last_epoch GROUP BY rank, step, last_epoch)"""


@query(f"""WITH {LOSSES} SELECT rank, step, epoch, round(loss, 9) AS loss FROM updates
WHERE step % 5 = 0""")
def loss_rollup(spark, sf_dir):
    result = mt.loss_rollup(batch_losses(spark, sf_dir), 8, 5)
    return result.withColumn("loss", F.round("loss", 9))


@query(f"""WITH {LOSSES} SELECT rank, step, epoch, step % 20 = 0 AS evaluates, step % 50 = 0 AS saves
FROM updates""")
def step_events(spark, sf_dir):
    steps = mt.loss_rollup(batch_losses(spark, sf_dir), 8).drop("loss")
    return mt.step_events(steps, 20, 50)


@query("""WITH seen AS (
  SELECT event_id, event_type, value::BIGINT AS step, max(value::BIGINT) OVER (
    PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high
  FROM (SELECT event_id, event_type, floor(value) AS value FROM events))
SELECT event_id, event_type, step FROM seen WHERE high IS NULL OR step >= high""")
def monotonic_log(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.floor("value").alias("step")
    )
    return mt.monotonic_log(rows, ["event_id"], ["event_type"])


@query(f"""SELECT doc_id, word FROM (
  SELECT doc_id, unnest({q.words('text')}) AS word FROM documents) WHERE length(word) > 20""")
def map_batches(spark, sf_dir):
    """A caller's function that returns more or fewer rows than it was given."""

    def long_words(frame):
        frame = frame.assign(word=frame["text"].str.split()).explode("word")
        return frame[frame["word"].str.len() > 20]

    docs = texts(spark, sf_dir, "doc_id", "text")
    return userfn.map_batches(docs, long_words, "doc_id bigint, word string", drop=["text"])


@query(f"""WITH {PREDICTIONS}
SELECT rank, batch_id, round(avg((p = t)::INT), 12) AS accuracy, count(*)::DOUBLE AS places
FROM places GROUP BY rank, batch_id""")
def evaluate_custom(spark, sf_dir):
    def score(pred, true):
        hits = sum(p == t for p, t in zip(pred, true))
        return {"accuracy": round(hits / len(true), 12), "places": len(true)}

    return userfn.evaluate(predictions(spark, sf_dir), score, ["accuracy", "places"])


def _stream(spark, sf_dir):
    schema = table(spark, sf_dir, "documents").schema
    return streams.read_stream(spark, f"{sf_dir}/documents.parquet", schema)


def _taken(df, path):
    """A stream's output kept apart from its files and its checkpoint, which then go."""
    kept = cut_lineage(df)
    for stored in (path, f"{path}.checkpoint"):
        drop_stored(kept.sparkSession, stored)
    return kept


STREAMED = f"WITH {q.DOCS}, {q.sentences(keys='doc_id')}"


@query(f"{STREAMED} SELECT doc_id, pos::INT AS pos, sentence FROM sentences")
def stream_sentences(spark, sf_dir):
    path = new_path(spark, "stream-sentences")
    stream = _stream(spark, sf_dir).select("doc_id", "text")
    streams.stream_sentences(stream, path, delimiters=tx.DELIMITERS + ".").awaitTermination()
    return _taken(spark.read.parquet(path), path)


@query(f"WITH {q.word_counts()} SELECT word, cnt AS count FROM wc")
def stream_word_counts(spark, sf_dir):
    path = new_path(spark, "stream-words")
    streams.stream_word_counts(_stream(spark, sf_dir), path, "text").awaitTermination()
    return _taken(spark.read.parquet(path), path)


@query(f"""WITH {TOKENS}, {q.batches(rows=100)}, {q.packed(256)}
SELECT split, shard::INT AS shard, batch::INT AS batch, block::INT AS block,
  {q.joined('input_ids')} AS ids FROM blocks""")
def stream_blocks(spark, sf_dir):
    vocab = word_vocabulary(spark, sf_dir)
    rows = _stream(spark, sf_dir).select("doc_id", "text", split_of(F.col("doc_id")).alias("split"))
    tokens = tokenize(rows, vocab, mode="whitespace").select("split", "doc_id", "input_ids")
    path = new_path(spark, "stream-blocks")
    streams.stream_blocks(tokens, path, ["doc_id"], 256, batch_rows=100).awaitTermination()
    blocks = spark.read.parquet(path)
    return _taken(blocks.select(
        "split", "shard", "batch", "block", ar.joined(F.col("input_ids")).alias("ids")
    ), path)
