"""Queries on files in the order given, state across micro-batches, table
functions, partial metrics, and vocabularies of full size."""

from pyspark.sql import functions as F

from ..operators import tokenize as tk, userfn, vocab as vb
from ..session import cut_lineage, drop_stored, new_path
from ..sources import files
from ..streaming import states, streams
from . import preparation, sql_parts as q
from .fixtures import batch_losses, documents, predictions, table, texts, word_vocabulary
from .queries_text import FULL_SIZE, sentence_vocabulary
from .queries_tokens import BLOCKS, _blocks
from .queries_training import LOSSES, PREDICTIONS
from .registry import query

#: Places of the train files in the list given; their names sort otherwise.
LISTED = {"c": 2, "a": 0, "b": 1}


def taken(df, *paths):
    """`df` kept apart from the stored files that it reads, which then go."""
    kept = cut_lineage(df)
    for path in paths:
        drop_stored(kept.sparkSession, path)
    return kept


@query(f"""WITH {q.DOCS}, {q.word_counts()}, {q.vocab()}, {q.BYTES},
ordered AS (SELECT split, text, row_number() OVER (ORDER BY
    CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END,
    CASE WHEN split = 'train' THEN [1, 2, 0][doc_id % 3 + 1] ELSE 0 END, doc_id) - 1 AS doc_id FROM docs),
{q.tokens('ordered')}, {q.batches()}, {q.packed(512)} SELECT {BLOCKS} FROM blocks""")
def packed_blocks_from_files(spark, sf_dir):
    """Files of texts alone, train files in the order listed, to packed blocks.
    The rows' only order is that of the files."""
    docs, root = documents(spark, sf_dir), new_path(spark, "listed")
    part = lambda rows, name: rows.orderBy("doc_id").select("text").write.json(f"{root}/{name}")
    for name, rest in LISTED.items():
        part(docs.where((F.col("split") == "train") & (F.pmod("doc_id", F.lit(3)) == rest)), name)
    for split in ("validation", "test"):
        part(docs.where(F.col("split") == split), split)
    listed = {"train": [f"{root}/{n}" for n in LISTED], "validation": f"{root}/validation", "test": f"{root}/test"}
    rows = files.with_row_ids(files.read_splits(spark, listed, "json", "text string", file_order=True))
    blocks = preparation.packed_blocks(rows, word_vocabulary(spark, sf_dir), ["row_id"], 512, mode="whitespace")
    return taken(_blocks(blocks, "split", "shard", "batch"), root)


def _arrived(spark, parts, out, make, per_trigger=1):
    """What a stream over `parts` gives, started once for each of them."""
    source = new_path(spark, "arriving")
    for part in parts:
        part.write.mode("append").parquet(source)
        stream = streams.read_stream(spark, source, part.schema, files_per_trigger=per_trigger)
        states.append_stream(make(stream), out).awaitTermination()
    return taken(spark.read.parquet(out), source, out, f"{out}.checkpoint")


@query(f"""WITH {LOSSES} SELECT rank, step, epoch, round(loss, 9) AS loss FROM updates
WHERE step % 5 = 0""")
def stream_loss_rollup(spark, sf_dir):
    """Losses that arrive in two starts, cut inside windows and epochs."""
    losses = batch_losses(spark, sf_dir)
    middle = losses.agg(F.max("batch_idx")).first()[0] // 2
    first = (F.col("epoch") == 0) | ((F.col("epoch") == 1) & (F.col("batch_idx") < middle))
    ordered = lambda rows: rows.repartitionByRange(4, "epoch", "batch_idx")
    parts = [ordered(losses.where(first)).coalesce(1), ordered(losses.where(~first)).coalesce(1)]
    rolled = _arrived(spark, parts, new_path(spark, "stream-losses"), lambda s: states.rolled_losses(s, 8, 5))
    return rolled.withColumn("loss", F.round("loss", 9))


@query("""WITH seen AS (
  SELECT event_id, event_type, value::BIGINT AS step, max(value::BIGINT) OVER (
    PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high
  FROM (SELECT event_id, event_type, floor(value) AS value FROM events))
SELECT event_id, event_type, step FROM seen WHERE high IS NULL OR step >= high""")
def stream_monotonic_log(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", F.floor("value").alias("step"))
    middle = rows.agg(F.max("event_id")).first()[0] // 2
    parts = [rows.where(F.col("event_id") <= middle).coalesce(1), rows.where(F.col("event_id") > middle).coalesce(1)]
    return _arrived(spark, parts, new_path(spark, "stream-log"), lambda s: states.monotonic_rows(s, ["event_id"], ["event_type"]))


class _Windows:
    """Cuts a record's text into windows of words that overlap."""

    SIZE, STEP = 40, 30

    def take(self, row):
        words = row["text"].split()
        for number, start in enumerate(range(0, max(1, len(words) - self.SIZE + self.STEP), self.STEP)):
            yield number, " ".join(words[start : start + self.SIZE])


@query(f"""WITH w AS (SELECT doc_id, lang, {q.words('text')} AS w FROM documents),
p AS (SELECT doc_id, lang, w, unnest(range(0, greatest(1, len(w) - 10), 30)) AS s FROM w)
SELECT doc_id, lang, (s // 30)::INT AS number, array_to_string(w[s + 1:s + 40], ' ') AS piece FROM p""")
def cut_records(spark, sf_dir):
    """One record to many by a table function; nothing moves."""
    docs = texts(spark, sf_dir, "doc_id", "lang", "text")
    return userfn.cut_table(docs, _Windows, "number int, piece string", ["doc_id", "lang"])


class _Exchanges:
    """Numbers a conversation's user turns and joins what follows each."""

    def __init__(self):
        self.number, self.turns, self.head = -1, [], None

    def take(self, row):
        if row["role"] == "user":
            yield from self._done()
            self.number, self.turns = self.number + 1, []
        self.head = (row["conv_id"],)
        self.turns.append(len(row["text"] or ""))

    def _done(self):
        if self.turns and self.number >= 0:
            yield self.number, len(self.turns), sum(self.turns)

    def finish(self):
        for out in self._done():
            yield self.head, out


@query("""WITH t AS (SELECT conv_id, text, sum((role = 'user')::INT) OVER (
  PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) - 1 AS number FROM conversations)
SELECT conv_id, number::INT AS number, count(*)::INT AS turns, sum(coalesce(length(text), 0))::BIGINT AS chars
FROM t WHERE number >= 0 GROUP BY conv_id, number""")
def cut_conversations(spark, sf_dir):
    """Conversations to exchanges, by a table function over partitions in order."""
    turns = table(spark, sf_dir, "conversations")
    return userfn.cut_table(turns, _Exchanges, "number int, turns int, chars bigint", ["conv_id"], ["conv_id"], ["turn"])


@query(f"""WITH {PREDICTIONS}
SELECT rank, batch_id, round(avg((p = t)::INT), 12) AS accuracy, count(*)::DOUBLE AS places
FROM places GROUP BY rank, batch_id""")
def evaluate_partial(spark, sf_dir):
    """A caller's metric from partial states, one for each task and batch."""
    return userfn.evaluate_partial(
        predictions(spark, sf_dir), lambda: [0.0, 0.0],
        lambda state, pred, true: [state[0] + (pred == true).sum(), state[1] + len(true)],
        lambda a, b: [x + y for x, y in zip(a, b)],
        lambda state: {"accuracy": round(state[0] / state[1], 12) if state[1] else float("nan"), "places": state[1]},
        ["accuracy", "places"]).where("places > 0")


def full_vocabulary(spark, sf_dir):
    """Pieces learned on the sentences of the documents, as many as a real run
    learns (or as many as the texts give)."""
    return sentence_vocabulary(spark, sf_dir, FULL_SIZE)


@query()
def train_bpe_full(spark, sf_dir):
    return full_vocabulary(spark, sf_dir).select("id", "piece", "score")


def full_merged(spark, sf_dir):
    return vb.merge_vocab(word_vocabulary(spark, sf_dir), full_vocabulary(spark, sf_dir))


@query()
def vocab_report_full(spark, sf_dir):
    """Sizes of a vocabulary of words with 30,000 learned pieces appended."""
    return vb.vocab_report(full_merged(spark, sf_dir))


@query()
def packed_blocks_full(spark, sf_dir):
    """Documents to 512-token blocks by 30,000 learned pieces."""
    blocks = preparation.packed_blocks(documents(spark, sf_dir), full_vocabulary(spark, sf_dir), ["doc_id"], 512)
    return _blocks(blocks, "split", "shard", "batch")


@query()
def compare_tokenizers_full(spark, sf_dir):
    """Tokens under the small learned vocabulary and under the full one."""
    docs = texts(spark, sf_dir, "doc_id", "text", "lang")
    return tk.compare_tokenizers(docs, sentence_vocabulary(spark, sf_dir), full_vocabulary(spark, sf_dir), by=["lang"])
