"""Queries on tokenizing, packing and instruction records."""

from pyspark.sql import functions as F

from ..functions import arrays as ar, text as tx
from ..operators import instructions as ins, packing as pk, tokenize as tk, vocab as vb
from ..session import cut_lineage
from . import preparation, sql_parts as q
from .fixtures import (
    documents, instruction_records, stored_vocabulary, table, texts, word_vocabulary,
)
from .queries_text import (
    TRAINED_SIZE, _merge_sql, benchmark_vocabulary, merged_vocabulary, sentence_vocabulary,
)
from .registry import query

WORDS = f"{q.word_counts()}, {q.vocab()}, {q.BYTES}"
TOKENS = f"{q.DOCS}, {WORDS}, {q.tokens()}"
IDS = f"len(ids)::INT AS n_tokens, {q.joined('ids')} AS ids"


def _ids(df, *keys):
    return df.select(
        *keys, F.size("input_ids").alias("n_tokens"), ar.joined(F.col("input_ids")).alias("ids")
    )


def word_tokens(spark, sf_dir):
    vocab = word_vocabulary(spark, sf_dir)
    return tk.tokenize(documents(spark, sf_dir), vocab, mode="whitespace")


@query(f"WITH {TOKENS} SELECT doc_id, {IDS} FROM tok")
def tokenize_whitespace(spark, sf_dir):
    return _ids(word_tokens(spark, sf_dir), "doc_id")


@query(f"WITH {TOKENS} SELECT doc_id, {IDS} FROM tok")
def tokenize_by_join(spark, sf_dir):
    """The same ids for a vocabulary of any size."""
    vocab = word_vocabulary(spark, sf_dir)
    docs = texts(spark, sf_dir, "doc_id", "text")
    return _ids(tk.tokenize_by_join(docs, vocab, ["doc_id"], hot_units=200), "doc_id")


CHAR_VOCAB = f"""
cc AS (SELECT c, sum(cnt)::BIGINT AS n FROM (SELECT unnest({q.chars('word')}) AS c, cnt FROM wc) GROUP BY c),
cover AS (
  SELECT c, n, coalesce(sum(n) OVER (ORDER BY n DESC, c ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0) < 0.98 * sum(n) OVER () AS kept FROM cc),
vocab AS (
  SELECT (258 + row_number() OVER (ORDER BY n DESC, c))::INT AS id, c AS piece FROM cover WHERE kept)"""


def char_vocabulary(spark, sf_dir):
    def compute():
        words = vb.word_counts(texts(spark, sf_dir, "text"), "text")
        kept = vb.char_coverage(vb.char_counts(words, mark_start=False), 0.98).where("kept")
        return vb.top_word_vocab(cut_lineage(kept.select(F.col("char").alias("word"), "count")))

    return stored_vocabulary(spark, "characters", {"sf_dir": sf_dir}, compute)


@query(f"""WITH {q.DOCS}, {q.word_counts()}, {CHAR_VOCAB}, {q.BYTES},
{q.tokens(unit_list=q.chars('text'))}
SELECT doc_id, len(ids)::INT AS n_tokens, md5({q.joined('ids')}) AS ids_md5 FROM tok""")
def tokenize_char(spark, sf_dir):
    vocab = char_vocabulary(spark, sf_dir)
    docs = texts(spark, sf_dir, "doc_id", "text")
    tokens = _ids(tk.tokenize(docs, vocab, mode="char"), "doc_id", )
    return tokens.select("doc_id", "n_tokens", F.md5("ids").alias("ids_md5"))


BPE_UNITS = """regexp_extract_all(' ' || text, ' *[^ ]+| +$')"""


def bpe_tokens(source, key, name, unit_list=BPE_UNITS, bos=True, vocab="bpe"):
    """Ids of texts without special pieces inside, by the learned pieces."""
    head = "[1]" if bos else "[]::INT[]"
    return f"""
{name}_units AS (
  SELECT {key}, unnest(us) AS unit, unnest(range(len(us))) AS pos
  FROM (SELECT {key}, {unit_list} AS us FROM {source})),
{name}_distinct AS (SELECT DISTINCT unit FROM {name}_units),
{q.merged_units(name + "_distinct", vocab, name + "_open")},
{name}_flat AS (
  SELECT unit AS word, unnest(parts) AS unit, unnest(range(len(parts))) AS k FROM {name}_open_done),
{name}_pieces AS (SELECT DISTINCT unit FROM {name}_flat),
{q.coded(name + "_pieces", vocab, name + "_coded")},
{name}_word AS (
  SELECT word, flatten(list(ids ORDER BY k)) AS ids
  FROM {name}_flat JOIN {name}_coded USING (unit) GROUP BY word),
{name}_lists AS (
  SELECT {key}, list_concat({head}, flatten(list(w.ids ORDER BY pos))) AS ids
  FROM {name}_units u JOIN {name}_word w ON u.unit = w.word GROUP BY {key})"""


BPE = f"{q.DOCS}, {q.sentences()}, {q.trained(TRAINED_SIZE)}, {q.BYTES}"


@query(f"""WITH RECURSIVE {BPE}, {bpe_tokens('docs', 'doc_id', 'tok')}
SELECT doc_id, {IDS} FROM tok_lists""")
def tokenize_bpe(spark, sf_dir):
    vocab = sentence_vocabulary(spark, sf_dir)
    docs = texts(spark, sf_dir, "doc_id", "text")
    return _ids(tk.tokenize(docs, vocab), "doc_id")


COMMON_WORDS = 300


def _compare_bpe_sql():
    byte = lambda c: f"len([i FOR i IN {c} IF i >= 3 AND i < 259])"
    return f"""WITH RECURSIVE {BPE},
bw AS (SELECT word, count(*) AS n FROM (SELECT unnest({q.words('text')}) AS word FROM benchmark) GROUP BY word),
extra AS (SELECT '▁' || word AS piece, row_number() OVER (ORDER BY n DESC, word) AS k
  FROM bw QUALIFY k <= {COMMON_WORDS}),
grown AS (
  SELECT id, piece, score FROM bpe
  UNION ALL
  SELECT (SELECT count(*) + 259 FROM bpe)::INT + (row_number() OVER (ORDER BY k) - 1)::INT, piece, 0.0
  FROM extra ANTI JOIN bpe USING (piece)),
{bpe_tokens('docs', 'doc_id', 'b', bos=False)}, {bpe_tokens('docs', 'doc_id', 'm', bos=False, vocab='grown')},
sizes AS (
  SELECT lang, len(b.ids) AS b, len(m.ids) AS m, {byte('b.ids')} AS bb, {byte('m.ids')} AS mb
  FROM docs JOIN b_lists b USING (doc_id) JOIN m_lists m USING (doc_id))
SELECT lang, count(*) AS texts, sum(b)::BIGINT AS base_tokens, sum(m)::BIGINT AS merged_tokens,
  round(avg(b), 6) AS base_mean, round(avg(m), 6) AS merged_mean,
  round(sum(bb) / sum(b), 9) AS base_byte_share, round(sum(mb) / sum(m), 9) AS merged_byte_share
FROM sizes GROUP BY lang"""


@query(_compare_bpe_sql())
def compare_tokenizers_bpe(spark, sf_dir):
    """Learned pieces before and after a second corpus' commonest words."""
    base = sentence_vocabulary(spark, sf_dir)
    counts = cut_lineage(vb.word_counts(table(spark, sf_dir, "benchmark"), "text"))
    words = vb.top_word_vocab(counts, vb.FIRST_WORD_ID + COMMON_WORDS).where("origin = 'word'")
    grown = vb.merge_vocab(base, words.withColumn("piece", F.concat(F.lit(tx.SPACE_MARK), "piece")))
    docs = texts(spark, sf_dir, "doc_id", "text", "lang")
    return _rounded(tk.compare_tokenizers(docs, base, grown, by=["lang"]))


def _rounded(result):
    for name, digits in (("base_mean", 6), ("merged_mean", 6),
                         ("base_byte_share", 9), ("merged_byte_share", 9)):
        result = result.withColumn(name, F.round(name, digits))
    return result


@query(f"""WITH {q.word_counts()}, cs AS (SELECT DISTINCT unnest({q.chars('word')}) AS char FROM wc)
SELECT char, array_to_string([printf('<0x%s>', h) FOR h IN
  regexp_extract_all(hex(encode(char)), '..')], ' ') AS pieces FROM cs""")
def byte_fallback(spark, sf_dir):
    words = vb.word_counts(texts(spark, sf_dir, "text"), "text")
    return vb.char_counts(words, mark_start=False).select(
        "char", F.array_join(tx.byte_pieces(F.col("char")), " ").alias("pieces")
    )


@query(f"""WITH {TOKENS} SELECT doc_id, len(ids)::INT AS mask_size,
  list_sum([1 FOR i IN ids])::BIGINT AS mask_sum, ids[1] AS first_id, 2::INT AS last_id FROM tok""")
def special_tokens_and_mask(spark, sf_dir):
    """BOS on, EOS on request; the mask is all ones."""
    vocab = word_vocabulary(spark, sf_dir)
    docs = documents(spark, sf_dir)
    with_eos = tk.tokenize(docs, vocab, mode="whitespace", eos=True)
    plain = tk.tokenize(with_eos, vocab, mode="whitespace", mask=True, out="plain_ids")
    return plain.select(
        "doc_id",
        F.size("attention_mask").alias("mask_size"),
        F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("mask_sum"),
        F.get("plain_ids", 0).alias("first_id"),
        F.element_at("input_ids", -1).alias("last_id"),
    )


def _compare_sql():
    byte = lambda c: f"len([i FOR i IN {c} IF i >= 3 AND i < 259])"
    return _merge_sql("").rstrip() + f""",
base_vocab AS (SELECT id, piece FROM base), merged_vocab AS (SELECT id, piece FROM merged),
{q.BYTES}, docs AS (SELECT doc_id, text, lang FROM documents),
{q.tokens(vocab='base_vocab', name='b', bos=False)}, {q.tokens(vocab='merged_vocab', name='m', bos=False)},
sizes AS (
  SELECT b.lang, len(b.ids) AS b, len(m.ids) AS m, {byte('b.ids')} AS bb, {byte('m.ids')} AS mb
  FROM b JOIN m USING (doc_id))
SELECT lang, count(*) AS texts, sum(b)::BIGINT AS base_tokens, sum(m)::BIGINT AS merged_tokens,
  round(avg(b), 6) AS base_mean, round(avg(m), 6) AS merged_mean,
  round(sum(bb) / sum(b), 9) AS base_byte_share, round(sum(mb) / sum(m), 9) AS merged_byte_share
FROM sizes GROUP BY lang"""


@query(_compare_sql())
def compare_tokenizers(spark, sf_dir):
    base = benchmark_vocabulary(spark, sf_dir)
    merged = merged_vocabulary(spark, sf_dir)
    docs = texts(spark, sf_dir, "doc_id", "text", "lang")
    return _rounded(tk.compare_tokenizers(docs, base, merged, mode="whitespace", by=["lang"]))


BLOCKS = f"""split, shard::INT AS shard, batch::INT AS batch, block::INT AS block,
  len(input_ids)::INT AS n_tokens, {q.joined('input_ids')} AS ids"""


def _blocks(df, *keys):
    return _ids(df, *keys, "block")


@query(f"WITH {TOKENS}, {q.batches()}, {q.packed(512)} SELECT {BLOCKS} FROM blocks")
def packed_blocks(spark, sf_dir):
    """Documents to 512-token blocks with the default batch sizes."""
    vocab = word_vocabulary(spark, sf_dir)
    blocks = preparation.packed_blocks(
        documents(spark, sf_dir), vocab, ["doc_id"], 512, mode="whitespace"
    )
    return _blocks(blocks, "split", "shard", "batch")


@query(f"""WITH RECURSIVE {BPE}, {bpe_tokens('docs', 'doc_id', 'learned_tok')},
tok AS (SELECT doc_id, split, ids FROM docs JOIN learned_tok_lists USING (doc_id)),
{q.batches()}, {q.packed(512)} SELECT {BLOCKS} FROM blocks""")
def packed_blocks_bpe(spark, sf_dir):
    """Flagship: documents to 512-token blocks by learned pieces."""
    vocab = sentence_vocabulary(spark, sf_dir)
    blocks = preparation.packed_blocks(documents(spark, sf_dir), vocab, ["doc_id"], 512)
    return _blocks(blocks, "split", "shard", "batch")


@query(f"WITH {TOKENS}, {q.batches(rows=7)}, {q.packed(2048)} SELECT {BLOCKS} FROM blocks")
def packed_blocks_small_batches(spark, sf_dir):
    """Many batches, some of them shorter than a block."""
    placed = pk.assign_batches(
        word_tokens(spark, sf_dir).select("split", "doc_id", "input_ids"), ["doc_id"], batch_rows=7
    )
    return _blocks(pk.pack_blocks(placed, ["doc_id"], 2048), "split", "shard", "batch")


BY_TIME = q.batches("timed", rows=50).replace("ORDER BY doc_id", "ORDER BY ts, event_id")


@query(f"""WITH timed AS (SELECT event_id, ts, event_type AS split FROM events), {BY_TIME}
SELECT event_id, split, shard::INT AS shard, batch::INT AS batch, row_in_shard FROM batched""")
def assign_batches_by_time(spark, sf_dir):
    """Rows in the order of a timestamp and an id."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", F.col("event_type").alias("split"))
    placed = pk.assign_batches(rows, ["ts", "event_id"], batch_rows=50)
    return placed.drop("chunk", "ts")


@query(f"""WITH {q.DOCS}, {q.batches('docs', rows=50)}
SELECT doc_id, split, shard::INT AS shard, batch::INT AS batch, row_in_shard FROM batched""")
def assign_batches(spark, sf_dir):
    docs = documents(spark, sf_dir).drop("text")
    return pk.assign_batches(docs, ["doc_id"], batch_rows=50).drop("chunk")


@query(f"""WITH {TOKENS}, {q.batches()}, {q.packed(512)}
SELECT split, shard::INT AS shard, batch::INT AS batch, block::INT AS block,
  md5({q.joined('input_ids')}) AS label_md5, true AS same FROM blocks""")
def block_labels(spark, sf_dir):
    placed = pk.assign_batches(
        word_tokens(spark, sf_dir).select("split", "doc_id", "input_ids"), ["doc_id"]
    )
    return pk.pack_blocks(placed, ["doc_id"]).select(
        "split", "shard", "batch", "block",
        F.md5(ar.joined(F.col("label"))).alias("label_md5"),
        (
            (F.col("label") == F.col("input_ids"))
            & (F.size("attention_mask") == F.size("input_ids"))
        ).alias("same"),
    )


@query(f"""WITH {TOKENS}, {q.batches(rows=40)}, t AS (
  SELECT split, shard, batch, count(*) AS num_rows, sum(len(ids))::BIGINT AS tokens_in
  FROM batched GROUP BY ALL),
k AS (SELECT *, CASE WHEN tokens_in >= 512 THEN tokens_in // 512 * 512 ELSE tokens_in END AS tokens_kept FROM t)
SELECT split, shard::INT AS shard, batch::INT AS batch, num_rows, tokens_in, tokens_kept,
  tokens_in - tokens_kept AS tokens_dropped, (tokens_kept + 511) // 512 AS blocks FROM k""")
def pack_report(spark, sf_dir):
    tokens = word_tokens(spark, sf_dir).select("split", "doc_id", "input_ids")
    return pk.pack_report(pk.assign_batches(tokens, ["doc_id"], batch_rows=40))


@query(f"""WITH {TOKENS}, flat AS (
  SELECT split, doc_id, unnest(ids) AS id, unnest(range(len(ids))) AS k FROM tok),
placed AS (
  SELECT split, id, row_number() OVER (PARTITION BY split ORDER BY doc_id, k) - 1 AS at_token,
    count(*) OVER (PARTITION BY split) AS n FROM flat)
SELECT split, (at_token // 512)::INT AS block, count(*)::INT AS n_tokens,
  string_agg(id, ' ' ORDER BY at_token) AS ids
FROM placed WHERE at_token // 512 < greatest(n // 512, 1) GROUP BY split, at_token // 512""")
def packed_global(spark, sf_dir):
    tokens = word_tokens(spark, sf_dir).select("split", "doc_id", "input_ids")
    # Lengths are read before the blocks are cut: store the tokens, make them once.
    return _blocks(pk.pack_global(cut_lineage(tokens), ["doc_id"]), "split")


@query(f"WITH {q.RECORDS}, {q.RENDERED} SELECT conv_id, turn, source FROM rendered")
def render_prompt(spark, sf_dir):
    return ins.render_prompt(instruction_records(spark, sf_dir)).select("conv_id", "turn", "source")


@query(f"WITH {q.RECORDS}, {q.RENDERED} SELECT conv_id, turn, target FROM rendered")
def render_target(spark, sf_dir):
    return ins.render_target(instruction_records(spark, sf_dir)).select("conv_id", "turn", "target")


GAPS = """
full_records AS (SELECT * FROM records),
gaps AS (
  SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN NULL ELSE instruction END AS instruction,
    CASE WHEN conv_id % 2 = 0 THEN input END AS input,
    CASE WHEN conv_id % 5 <> 0 THEN output END AS output FROM full_records)"""


def records_with_gaps(spark, sf_dir):
    """The records with some of their parts missing."""
    rows = instruction_records(spark, sf_dir)
    return rows.select(
        "conv_id", "turn", F.when(F.col("turn") % 3 != 0, F.col("instruction")).alias("instruction"),
        F.when(F.col("conv_id") % 2 == 0, F.col("input")).alias("input"),
        F.when(F.col("conv_id") % 5 != 0, F.col("output")).alias("output"),
    )


@query(f"""WITH {q.RECORDS}, {GAPS}, {q.RENDERED.replace('FROM records', 'FROM gaps')}
SELECT conv_id, turn, source, target FROM rendered""")
def render_with_gaps(spark, sf_dir):
    rows = ins.render_target(ins.render_prompt(records_with_gaps(spark, sf_dir)))
    return rows.select("conv_id", "turn", "source", "target")


@query(f"""WITH {q.RECORDS}, {GAPS}
SELECT count(*) FILTER (instruction IS NULL AND input <> '') AS dropped, count(*) AS records FROM gaps""")
def dropped_records(spark, sf_dir):
    return ins.dropped_records(records_with_gaps(spark, sf_dir))


def _encoded_sql(tail, max_len=512, ignore=-100):
    """Character mode: the end text is left empty and its id is added."""
    return f"""WITH {q.RECORDS}, {q.RENDERED}, {q.word_counts()}, {CHAR_VOCAB}, {q.BYTES},
src AS (SELECT conv_id * 1000 + turn AS k, conv_id, turn, source FROM rendered),
tgt AS (SELECT conv_id * 1000 + turn AS k, coalesce(output, 'None') AS target FROM rendered),
{q.tokens('src', 'k', q.chars('source'), name='s')},
{q.tokens('tgt', 'k', q.chars('target'), name='t', bos=False)},
seq AS (
  SELECT conv_id, turn, (s.ids || t.ids || [2])[:{max_len}] AS input_ids,
    ([{ignore} FOR i IN s.ids] || t.ids || [2])[:{max_len}] AS labels
  FROM s JOIN t USING (k))
{tail}"""


def encoded(spark, sf_dir, max_len=512, ignore=ins.IGNORE_ID):
    return preparation.masked_sequences(
        instruction_records(spark, sf_dir), char_vocabulary(spark, sf_dir), max_len,
        mode="char", eos_text="", eos_id=True, ignore=ignore,
    )


@query(_encoded_sql(f"""SELECT conv_id, turn, {q.joined('input_ids')} AS ids,
{q.joined('labels')} AS labels FROM seq""", 1000, 100))
def encode_instructions(spark, sf_dir):
    return encoded(spark, sf_dir, 1000, ins.PARITY_IGNORE_ID).select(
        "conv_id", "turn", ar.joined(F.col("input_ids")).alias("ids"),
        ar.joined(F.col("labels")).alias("labels"),
    )


@query(_encoded_sql("""SELECT count(*) AS sequences, sum(len(input_ids))::BIGINT AS tokens,
  sum(len([x FOR x IN labels IF x <> -100]))::BIGINT AS trained FROM seq""", 512))
def sequence_count(spark, sf_dir):
    rows = encoded(spark, sf_dir, 512)
    return rows.agg(
        F.count("*").alias("sequences"), F.sum(F.size("input_ids")).alias("tokens"),
        F.sum(F.size(F.filter("labels", lambda x: x != -100))).alias("trained"),
    )


def _bpe_records_sql():
    units = lambda c: f"regexp_extract_all(' ' || {c}, ' *[^ ]+| +$')"
    return f"""WITH RECURSIVE {BPE}, {q.RECORDS}, {q.RENDERED},
src AS (SELECT conv_id * 1000 + turn AS k, source FROM rendered),
tgt AS (SELECT conv_id * 1000 + turn AS k, target[:length(target) - 4] AS target FROM rendered),
{bpe_tokens('src', 'k', 's', units('source'))}, {bpe_tokens('tgt', 'k', 't', units('target'), False)}
SELECT k // 1000 AS conv_id, k % 1000 AS turn, {q.joined('(s.ids || t.ids || [2])[:512]')} AS ids,
  {q.joined('([-100 FOR i IN s.ids] || t.ids || [2])[:512]')} AS labels
FROM s_lists s JOIN t_lists t USING (k)"""


@query(_bpe_records_sql())
def encode_instructions_bpe(spark, sf_dir):
    """Both sides merged by learned pieces; the end text becomes its own id."""
    vocab = sentence_vocabulary(spark, sf_dir)
    rows = preparation.masked_sequences(instruction_records(spark, sf_dir), vocab)
    return rows.select(
        "conv_id", "turn", ar.joined(F.col("input_ids")).alias("ids"),
        ar.joined(F.col("labels")).alias("labels"),
    )
