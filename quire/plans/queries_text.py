"""Queries on sources, sentences, subsets and vocabularies."""

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import pairs, sentences as sn, subsets, vocab as vb
from ..operators.ordering import with_global_index
from ..session import cut_lineage, drop_stored, new_path
from ..sources import files, processed, vocab_file
from . import preparation, sql_parts as q
from .fixtures import documents, stored_vocabulary, table, texts, word_vocabulary
from .registry import query

MARKS = tx.DELIMITERS + "."
TEXT_STATS = """count(*) AS n, sum(length(text))::BIGINT AS chars,
  sum(strlen(text))::BIGINT AS bytes, min(text) AS lowest, max(text) AS highest"""
_STATS = lambda: [
    F.count("*").alias("n"), F.sum(F.length("text")).cast("bigint").alias("chars"),
    F.sum(F.octet_length("text")).cast("bigint").alias("bytes"),
    F.min("text").alias("lowest"), F.max("text").alias("highest"),
]


def _aggregated(df, *paths):
    """A small result kept apart from the files that it reads, which then go."""
    kept = cut_lineage(df)
    for path in paths:
        drop_stored(kept.sparkSession, path)
    return kept


def _split_files(spark, sf_dir, fmt, folder=None):
    """The documents written as one folder per split; returns their paths."""
    folder = folder or new_path(spark, "files")
    docs, paths = documents(spark, sf_dir), {}
    for split in ("train", "validation", "test"):
        part = docs.where(F.col("split") == split).drop("split")
        paths[split] = f"{folder}/{split}.{fmt}"
        if fmt == "txt":
            part.select("text").write.text(paths[split])
        elif fmt == "csv":
            part.write.csv(paths[split], header=True, escape='"')
        else:
            part.write.json(paths[split])
    return paths


READ_BACK = f"WITH {q.DOCS} SELECT split, {TEXT_STATS} FROM docs GROUP BY split"


@query(READ_BACK)
def read_splits_json(spark, sf_dir):
    paths = _split_files(spark, sf_dir, "json")
    table = files.read_splits(spark, paths, "json", "doc_id bigint, text string")
    return _aggregated(table.groupBy("split").agg(*_STATS()), *paths.values())


@query(READ_BACK)
def read_splits_csv(spark, sf_dir):
    paths = _split_files(spark, sf_dir, "csv")
    # Texts hold line breaks.
    table = files.read_splits(spark, paths, "csv", "doc_id bigint, text string", multi_line=True)
    return _aggregated(table.groupBy("split").agg(*_STATS()), *paths.values())


@query(f"""WITH {q.DOCS}, lines AS (
  SELECT split, unnest(string_split(text, chr(10))) AS text FROM docs)
SELECT split, {TEXT_STATS} FROM lines GROUP BY split""")
def read_splits_text(spark, sf_dir):
    paths = _split_files(spark, sf_dir, "txt")
    return _aggregated(files.read_splits(spark, paths, "txt").groupBy("split").agg(*_STATS()), *paths.values())


@query(READ_BACK)
def read_named_dataset(spark, sf_dir):
    root = new_path(spark, "dataset")
    _split_files(spark, sf_dir, "json", f"{root}/pretrain")
    table = files.load_source(
        spark, dataset_dir=root, subset="pretrain", schema="doc_id bigint, text string"
    )
    return _aggregated(table.groupBy("split").agg(*_STATS()), root)


@query(READ_BACK)
def processed_round_trip(spark, sf_dir):
    path = new_path(spark, "processed")
    processed.write_processed(documents(spark, sf_dir), path, overwrite=True)
    return _aggregated(processed.read_processed(spark, path).groupBy("split").agg(*_STATS()), path)


@query(f"""WITH {q.DOCS} SELECT split, {TEXT_STATS} FROM docs WHERE split = 'validation'
GROUP BY split""")
def processed_reuse(spark, sf_dir):
    """The second call finds the stored result and does not compute."""
    path, settings = new_path(spark, "reuse"), {"sf_dir": sf_dir, "block_size": 512}

    def compute():
        return documents(spark, sf_dir)

    def fail():
        raise AssertionError("computed although stored")

    processed.reuse_or_compute(spark, path, settings, compute)
    stored = processed.reuse_or_compute(spark, path, settings, fail)
    return _aggregated(stored.where(F.col("split") == "validation").groupBy("split").agg(*_STATS()), path)


@query(f"""WITH {q.word_counts()}, {q.vocab()}
SELECT id, piece, (-(id - 259))::DOUBLE AS score FROM vocab
UNION ALL SELECT i::INT, ['<unk>', '<s>', '</s>'][i + 1], 0.0::DOUBLE FROM range(3) t(i)
UNION ALL SELECT (3 + b)::INT, printf('<0x%02X>', b), 0.0::DOUBLE FROM range(256) t(b)""")
def vocab_round_trip(spark, sf_dir):
    path = new_path(spark, "vocab")
    vocab_file.write_vocab(word_vocabulary(spark, sf_dir), path)
    return _aggregated(vocab_file.read_vocab(spark, path).select("id", "piece", "score"), path)


@query(f"""WITH {q.DOCS}, {q.sentences()}
SELECT line, count(*) AS n FROM (
  SELECT unnest(string_split(sentence, chr(10))) AS line FROM sentences) GROUP BY line""")
def write_sentence_lines(spark, sf_dir):
    path = new_path(spark, "lines")
    files.write_lines(sn.split_sentences(documents(spark, sf_dir), delimiters=MARKS), path)
    return _aggregated(spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n")), path)


def _sentence_sql(marks):
    return f"""WITH {q.DOCS}, {q.sentences(marks=marks)}
SELECT doc_id, split, pos::INT AS pos, sentence FROM sentences"""


@query(_sentence_sql(tx.DELIMITERS))
def sentences_default(spark, sf_dir):
    return sn.split_sentences(documents(spark, sf_dir))


@query(_sentence_sql(MARKS))
def sentences_with_stops(spark, sf_dir):
    return sn.split_sentences(documents(spark, sf_dir), delimiters=MARKS)


@query(f"""WITH {q.DOCS}, parts AS (
  SELECT doc_id, unnest([s FOR s IN string_split(
    regexp_replace(text, '([{MARKS}])', '\\1' || chr(1), 'g'), chr(1)) IF s <> '']) AS s FROM docs)
SELECT doc_id, count(*) AS n, sum(length(s))::BIGINT AS chars, sum(length({q.stripped('s')}))::BIGINT AS stripped
FROM parts GROUP BY doc_id""")
def sentences_keep_tail(spark, sf_dir):
    docs = documents(spark, sf_dir)
    cut = docs.select("doc_id", F.explode(tx.sentence_array(F.col("text"), MARKS, True)).alias("s"))
    return cut.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.sum(F.length("s")).alias("chars"),
        F.sum(F.length(tx.strip(F.col("s")))).alias("stripped"),
    )


@query(f"""WITH numbers AS (SELECT doc_id, n_chars::VARCHAR AS text FROM documents),
{q.sentences('numbers', 'doc_id', marks='5')}
SELECT doc_id, pos::INT AS pos, sentence FROM sentences""")
def sentences_of_numbers(spark, sf_dir):
    """Any column reads as text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return sn.split_sentences(docs, "n_chars", "5")


@query(f"""WITH {q.DOCS}, {q.sentences()},
numbered AS (
  SELECT row_number() OVER (ORDER BY doc_id, pos) - 1 AS position, doc_id, sentence FROM sentences)
SELECT doc_id, position, sentence FROM numbered WHERE position % 1000 = 0""")
def sample_every(spark, sf_dir):
    docs = texts(spark, sf_dir, "doc_id", "text")
    return sn.sample_every(docs, ["doc_id"], 1000, delimiters=MARKS)


@query(f"""WITH {q.DOCS}, ord AS (
  SELECT doc_id, split, CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 ELSE 2 END AS split_ord
  FROM docs)
SELECT doc_id, split, split_ord::INT AS split_ord,
  row_number() OVER (ORDER BY split_ord, doc_id) - 1 AS position FROM ord""")
def concat_splits(spark, sf_dir):
    """Train, then validation, then test, numbered through."""
    docs = documents(spark, sf_dir)
    parts = {s: docs.where(F.col("split") == s).select("doc_id") for s in sn.SPLIT_ORDER}
    return with_global_index(sn.concat_splits(parts), ["split_ord", "doc_id"])


@query(f"WITH {q.DOCS} SELECT doc_id, split FROM docs")
def drop_columns(spark, sf_dir):
    return subsets.drop_columns(documents(spark, sf_dir), "text")


@query(f"""WITH {q.DOCS}, r AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS k FROM docs)
SELECT doc_id, text, split FROM r
WHERE (split = 'train' AND k <= 20) OR (split = 'validation' AND k <= 10)""")
def head_per_split(spark, sf_dir):
    return subsets.head_per_split(documents(spark, sf_dir), ["doc_id"])


@query(f"WITH {q.DOCS} SELECT split, count(*) AS num_rows FROM docs GROUP BY split")
def split_counts(spark, sf_dir):
    return subsets.split_counts(documents(spark, sf_dir))


@query(f"WITH {q.word_counts()} SELECT word, cnt AS count FROM wc")
def word_counts(spark, sf_dir):
    return vb.word_counts(texts(spark, sf_dir, "text"), "text")


@query(f"""WITH {q.word_counts()},
cc AS (SELECT c, sum(cnt)::BIGINT AS n FROM (SELECT unnest({q.chars("'▁' || word")}) AS c, cnt FROM wc) GROUP BY c)
SELECT c AS char, n AS count,
  coalesce(sum(n) OVER (ORDER BY n DESC, c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    < 0.9995 * sum(n) OVER () AS kept FROM cc""")
def char_coverage(spark, sf_dir):
    words = vb.word_counts(texts(spark, sf_dir, "text"), "text")
    return vb.char_coverage(vb.char_counts(words))


@query(f"""WITH {q.DOCS}, {q.sentences()}
SELECT split, count(*) AS n, sum(strlen(sentence))::BIGINT AS bytes
FROM sentences WHERE strlen(sentence) <= 120 GROUP BY split""")
def within_bytes(spark, sf_dir):
    cut = sn.split_sentences(documents(spark, sf_dir), delimiters=MARKS)
    return vb.within_bytes(cut, 120).groupBy("split").agg(
        F.count("*").alias("n"), F.sum(F.octet_length("sentence")).cast("bigint").alias("bytes")
    )


@query(f"""WITH {q.word_counts()},
p AS (SELECT {q.chars("'▁' || word")} AS p, cnt FROM wc),
pairs AS (SELECT unnest(p[:len(p) - 1]) AS l, unnest(p[2:]) AS r, cnt FROM p WHERE len(p) > 1)
SELECT l AS "left", r AS "right", sum(cnt)::BIGINT AS pair_count FROM pairs GROUP BY l, r""")
def pair_counts(spark, sf_dir):
    words = vb.word_counts(texts(spark, sf_dir, "text"), "text")
    return pairs.pair_counts(pairs.start_symbols(words, split_scripts=False))


#: A small vocabulary, and the size of a real training run.
TRAINED_SIZE, FULL_SIZE = 420, 30_000


def sentence_vocabulary(spark, sf_dir, size=TRAINED_SIZE):
    def compute():
        cut = sn.split_sentences(documents(spark, sf_dir), delimiters=MARKS)
        # Vocabularies of all sizes learn from the same words, which are counted once.
        words = stored_vocabulary(
            spark, "sentence-words", {"sf_dir": sf_dir}, lambda: pairs.sentence_words(cut, normalize=False))
        return pairs.train_bpe(cut, size, layout="bytes", normalize=False, words=words)

    return stored_vocabulary(spark, "pieces", {"sf_dir": sf_dir, "size": size}, compute)


@query(f"""WITH RECURSIVE {q.DOCS}, {q.sentences()}, {q.trained_whole(FULL_SIZE)}
SELECT id, piece, score FROM bpe
UNION ALL SELECT i::INT, ['<unk>', '<s>', '</s>'][i + 1], 0.0::DOUBLE FROM range(3) t(i)
UNION ALL SELECT (3 + b)::INT, printf('<0x%02X>', b), 0.0::DOUBLE FROM range(256) t(b)""")
def train_bpe(spark, sf_dir):
    """As many pieces as a real run learns, or as the texts give."""
    return sentence_vocabulary(spark, sf_dir, FULL_SIZE).select("id", "piece", "score")


def _merge_sql(tail):
    return f"""WITH {q.word_counts()}, {q.vocab()},
bw AS (SELECT word, count(*) AS cnt FROM (SELECT unnest({q.words('text')}) AS word FROM benchmark) GROUP BY word),
base AS (
  SELECT i::INT AS id, ['<unk>', '<s>', '</s>'][i + 1] AS piece, 0.0::DOUBLE AS score FROM range(3) t(i)
  UNION ALL SELECT (3 + b)::INT, printf('<0x%02X>', b), 0.0::DOUBLE FROM range(256) t(b)
  UNION ALL SELECT (258 + k)::INT, word, -(k - 1)::DOUBLE
    FROM (SELECT word, row_number() OVER (ORDER BY cnt DESC, word) AS k FROM bw)),
fresh AS (SELECT id, piece FROM vocab ANTI JOIN base USING (piece)),
merged AS (
  SELECT id, piece, score, 'base' AS origin FROM base
  UNION ALL
  SELECT ((SELECT count(*) FROM base) + row_number() OVER (ORDER BY id) - 1)::INT, piece, 0.0, 'extra'
  FROM fresh)
{tail}"""


def benchmark_vocabulary(spark, sf_dir):
    def compute():
        counts = vb.word_counts(table(spark, sf_dir, "benchmark"), "text")
        return vb.top_word_vocab(cut_lineage(counts))

    return stored_vocabulary(spark, "benchmark", {"sf_dir": sf_dir}, compute)


def merged_vocabulary(spark, sf_dir):
    return vb.merge_vocab(benchmark_vocabulary(spark, sf_dir), word_vocabulary(spark, sf_dir))


@query(_merge_sql("SELECT id, piece, score, origin FROM merged"))
def merge_vocab(spark, sf_dir):
    return merged_vocabulary(spark, sf_dir)


@query(_merge_sql("""SELECT 'pieces' AS name, count(*) AS value FROM merged
UNION ALL SELECT 'distinct pieces', count(DISTINCT piece) FROM merged
UNION ALL SELECT 'added pieces', count(*) FILTER (origin = 'extra') FROM merged
UNION ALL SELECT piece, id FROM merged WHERE piece IN ('<unk>', '<s>', '</s>')"""))
def vocab_report(spark, sf_dir):
    return vb.vocab_report(merged_vocabulary(spark, sf_dir))


@query(f"""WITH RECURSIVE {q.word_counts(name='dw')}, {q.vocab(counts='dw')},
{q.sentences('benchmark', 'item_id')}, {q.trained(TRAINED_SIZE)},
reserved AS (
  SELECT i::INT AS id, ['<unk>', '<s>', '</s>'][i + 1] AS piece FROM range(3) t(i)
  UNION ALL SELECT (3 + b)::INT, printf('<0x%02X>', b) FROM range(256) t(b)),
base AS (SELECT id, piece, 'base' AS origin FROM reserved UNION ALL SELECT id, piece, 'base' FROM vocab)
SELECT * FROM base UNION ALL
SELECT ((SELECT count(*) FROM base) + row_number() OVER (ORDER BY id) - 1)::INT, piece, 'extra'
FROM bpe WHERE piece NOT IN (SELECT piece FROM base)""")
def extended_vocabulary(spark, sf_dir):
    """Sentences of the second corpus, pieces learned on them, appended to the
    first corpus' vocabulary."""
    base = word_vocabulary(spark, sf_dir)
    items = table(spark, sf_dir, "benchmark")
    grown = preparation.extended_vocabulary(
        items, base, TRAINED_SIZE, MARKS, layout="bytes", normalize=False
    )
    return grown.select("id", "piece", "origin")
