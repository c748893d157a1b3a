"""SQL fragments shared by the comparison queries."""

from ..functions.text import DELIMITERS, WHITESPACE
from ..operators.instructions import PROMPT

SPACES = "[" + "".join("\\x{%x}" % ord(c) for c in WHITESPACE) + "]"
SPLIT = (
    "CASE doc_id % 10 WHEN 0 THEN 'validation' WHEN 1 THEN 'test' ELSE 'train' END"
)
DOCS = f"docs AS (SELECT doc_id, text, lang, {SPLIT} AS split FROM documents)"


def words(col):
    return f"[w FOR w IN string_split_regex({col}, '{SPACES}+') IF w <> '']"


def chars(col):
    return f"[c FOR c IN string_split({col}, '') IF c <> '']"


def joined(col):
    return f"array_to_string({col}, ' ')"


def stripped(col):
    trimmed = "".join(f" || chr({ord(c)})" for c in WHITESPACE)
    return f"trim({col}, ''{trimmed})"


def sentences(source="docs", keys="doc_id, split", text="text", marks=DELIMITERS + "."):
    """Kept sentences as (keys, pos, sentence)."""
    cut = f"string_split(regexp_replace({text}, '([{marks}])', '\\1' || chr(1), 'g'), chr(1))"
    return f"""
cut AS (SELECT {keys}, {cut} AS parts FROM {source}),
kept AS (SELECT {keys}, [s FOR s IN parts[:len(parts) - 1] IF length(s) >= 2] AS parts FROM cut),
sentences AS (
  SELECT {keys}, unnest(range(len(parts))) AS pos, {stripped('unnest(parts)')} AS sentence
  FROM kept)"""


def word_counts(source="documents", text="text", name="wc"):
    return f"""
{name} AS (
  SELECT word, count(*) AS cnt
  FROM (SELECT unnest({words(text)}) AS word FROM {source}) GROUP BY word)"""


BYTES = "bytes AS (SELECT printf('%02X', b) AS h, (b + 3)::INT AS id FROM range(256) t(b))"


def vocab(size=30000, counts="wc"):
    return f"""
vocab AS (
  SELECT (258 + row_number() OVER (ORDER BY cnt DESC, word))::INT AS id, word AS piece
  FROM {counts} ORDER BY cnt DESC, word LIMIT {size - 259})"""


def coded(units, vocab="vocab", name="coded"):
    """(unit, ids) of every distinct unit, bytes where it is no piece."""
    return f"""
{name}_miss AS (
  SELECT unit, unnest(regexp_extract_all(hex(encode(unit)), '..')) AS h,
         unnest(range(strlen(unit))) AS k
  FROM {units} ANTI JOIN {vocab} ON unit = piece),
{name} AS (
  SELECT unit, [id] AS ids FROM {units} JOIN {vocab} ON unit = piece
  UNION ALL
  SELECT unit, list(id ORDER BY k) FROM {name}_miss JOIN bytes USING (h) GROUP BY unit)"""


def tokens(source="docs", key="doc_id", unit_list=None, carry="", vocab="vocab", name="tok", bos=True):
    """(key, ids) of each text, in one list."""
    unit_list = unit_list or words("text")
    head = "[1]" if bos else "[]::INT[]"
    return f"""
{name}_units AS (
  SELECT {key}, unnest(us) AS unit, unnest(range(len(us))) AS pos
  FROM (SELECT {key}, {unit_list} AS us FROM {source})),
{name}_distinct AS (SELECT DISTINCT unit FROM {name}_units),
{coded(name + "_distinct", vocab, name + "_coded")},
{name}_lists AS (
  SELECT {key}, flatten(list(ids ORDER BY pos)) AS ids
  FROM {name}_units JOIN {name}_coded USING (unit) GROUP BY {key}),
{name} AS (
  SELECT s.*, list_concat({head}, coalesce(l.ids, [])) AS ids
  FROM {source} s LEFT JOIN {name}_lists l USING ({key}))"""


def batches(source="tok", shards=5, rows=1000):
    """Adds shard, row_in_shard and batch."""
    return f"""
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS position,
         count(*) OVER (PARTITION BY split) AS n FROM {source}),
sharded AS (
  SELECT *, CASE WHEN position < (n % {shards}) * (n // {shards} + 1)
                 THEN position // (n // {shards} + 1)
                 ELSE n % {shards} + (position - (n % {shards}) * (n // {shards} + 1))
                      // greatest(n // {shards}, 1) END AS shard FROM numbered),
batched AS (
  SELECT *, row_in_shard // {rows} AS batch FROM (
    SELECT *, row_number() OVER (PARTITION BY split, shard ORDER BY doc_id) - 1 AS row_in_shard
    FROM sharded))"""


def packed(block, source="batched", by="split, shard, batch"):
    return f"""
whole AS (SELECT {by}, flatten(list(ids ORDER BY doc_id)) AS t FROM {source} GROUP BY {by}),
blocks AS (
  SELECT {by}, block, t[block * {block} + 1 : (block + 1) * {block}] AS input_ids
  FROM (SELECT {by}, t, unnest(range(greatest(len(t) // {block}, 1))) AS block
        FROM whole WHERE len(t) > 0))"""


RECORDS = """
turns AS (
  SELECT conv_id, turn, role, text,
         lag(role) OVER w AS role_before, lag(text) OVER w AS text_before,
         lead(role) OVER w AS role_after, lead(text) OVER w AS text_after
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
records AS (
  SELECT conv_id, turn, text AS instruction,
         CASE WHEN role_before = 'system' THEN text_before END AS input, text_after AS output
  FROM turns WHERE role = 'user' AND role_after = 'assistant')"""

_HEAD, _TAIL = PROMPT.replace("\n", "' || chr(10) || '").split("{instruction}")
RENDERED = f"""
rendered AS (
  SELECT conv_id, turn, instruction, input, output,
         '{_HEAD}' || CASE WHEN input IS NOT NULL AND input <> ''
           THEN instruction || chr(10) || input ELSE coalesce(instruction, 'None') END || '{_TAIL}' AS source,
         coalesce(output, 'None') || '</s>' AS target
  FROM records WHERE instruction IS NOT NULL OR input IS NULL OR input = '')"""


# Marks around a symbol in the word table below.
OPEN, CLOSE = chr(0xFDD0), chr(0xFDD1)

# Letters of one script, or a stretch of anything else; enough for these texts.
_RUNS = "▁?(?:[\\p{Latin}\\p{Inherited}]+|[^\\p{Latin}▁]+)|▁"


def trained(vocab_size, source="sentences", text="sentence", coverage=0.9995):
    """Pair merging one at a time: merges(step, l, r, n) and bpe(id, piece, score)."""
    pair = f"'{OPEN}' || l || '{CLOSE}{OPEN}' || r || '{CLOSE}'"
    return f"""
{word_counts(f"(SELECT {text} FROM {source} WHERE strlen({text}) <= 6000)", text)},
cc AS (
  SELECT c, sum(cnt)::BIGINT AS n FROM (SELECT unnest({chars("'▁' || word")}) AS c, cnt FROM wc)
  GROUP BY c),
cover AS (
  SELECT c, n, coalesce(sum(n) OVER (ORDER BY n DESC, c ROWS BETWEEN UNBOUNDED PRECEDING
                                     AND 1 PRECEDING), 0) < {coverage} * sum(n) OVER () AS kept
  FROM cc),
known AS (
  SELECT unnest(flatten([regexp_extract_all(p, '{_RUNS}') FOR p IN string_split_regex(
           translate('▁' || word, (SELECT coalesce(string_agg(c, ''), '') FROM cover WHERE NOT kept),
                     (SELECT coalesce(string_agg('▅', ''), '') FROM cover WHERE NOT kept)), '▅+')]
         )) AS part, cnt FROM wc),
start AS (
  SELECT regexp_replace(part, '(?s)(.)', '{OPEN}\\1{CLOSE}', 'g') AS symbols, sum(cnt)::BIGINT AS cnt
  FROM known WHERE length(part) > 1 GROUP BY part),
room AS (SELECT greatest({vocab_size} - 259 - count(*), 0) AS merges FROM cover WHERE kept),
steps AS (
  SELECT 0 AS step, 'w' AS kind, symbols, cnt, NULL::VARCHAR AS l, NULL::VARCHAR AS r FROM start
  UNION ALL
  (WITH parts AS (
     SELECT string_split(symbols[2:length(symbols) - 1], '{CLOSE}{OPEN}') AS p, cnt
     FROM steps WHERE kind = 'w'),
   pairs AS (
     SELECT unnest(p[:len(p) - 1]) AS l, unnest(p[2:]) AS r, cnt FROM parts WHERE len(p) > 1),
   best AS (
     SELECT l, r, sum(cnt)::BIGINT AS n FROM pairs
     WHERE length(l || r) <= 16 AND l || r NOT IN (SELECT l || r FROM steps WHERE kind = 'm')
     GROUP BY l, r ORDER BY n DESC, length(l || r), l || r, length(l) LIMIT 1)
   SELECT step + 1, kind, replace(symbols, {pair.replace("l ||", "b.l ||").replace("r ||", "b.r ||")},
                                  '{OPEN}' || b.l || b.r || '{CLOSE}'), cnt, NULL, NULL
   FROM steps, best b WHERE kind = 'w' AND step < (SELECT merges FROM room)
   UNION ALL
   SELECT (SELECT max(step) + 1 FROM steps), 'm', NULL, n, l, r FROM best
   WHERE (SELECT max(step) FROM steps) < (SELECT merges FROM room)
   UNION ALL
   SELECT step, 'm', NULL, cnt, l, r FROM steps
   WHERE kind = 'm' AND (SELECT max(step) FROM steps) < (SELECT merges FROM room)
  )),
merges AS (SELECT DISTINCT step, l, r, cnt AS n FROM steps WHERE kind = 'm'),
learned AS (
  SELECT l || r AS piece, step - 1 AS rank FROM merges
  UNION ALL
  SELECT c, (SELECT count(*) FROM merges) + row_number() OVER (ORDER BY n DESC, c) - 1
  FROM cover WHERE kept),
bpe AS (SELECT (259 + rank)::INT AS id, piece, -rank::DOUBLE AS score FROM learned)"""


def trained_whole(vocab_size, source="sentences", text="sentence", coverage=0.9995, ahead=100):
    """bpe(id, piece, score) as `trained` gives it, for sizes of real runs: a step
    takes the leading pairs that single steps would also take next, and `steps` keeps
    each word and each merge once.

    Merging (l, r) changes only pairs that end in l or start with r, and a new pair is
    longer and never commoner than one of those. So a step ends before a pair that
    touches one of its pairs, or that is no commoner than a pair left out for its
    piece's sake (`made`) which touches one of them; of those as common as the next
    pair it takes the ones no longer than those before."""
    parts = trained(vocab_size, source, text, coverage)
    head = parts[: parts.index("steps AS (")]
    return f"""{head}
steps(kind, key, symbols, cnt, l, r) USING KEY (kind, key) AS (
  SELECT 'w', row_number() OVER (ORDER BY symbols), symbols, cnt, NULL::VARCHAR, NULL::VARCHAR FROM start
  UNION
  (WITH parts AS (
     SELECT key, string_split(symbols[2:length(symbols) - 1], '{CLOSE}{OPEN}') AS p, cnt
     FROM recurring.steps WHERE kind = 'w'),
   places AS MATERIALIZED (
     SELECT key, unnest(p[:len(p) - 1]) AS l, unnest(p[2:]) AS r, cnt FROM parts WHERE len(p) > 1),
   done AS MATERIALIZED (SELECT l || r AS piece FROM recurring.steps WHERE kind = 'm'),
   left_over AS (SELECT (SELECT merges FROM room) - count(*) AS n FROM done),
   pairs AS MATERIALIZED (
     SELECT l, r, l || r AS piece, n, l || r IN (SELECT piece FROM done) AS made
     FROM (SELECT l, r, sum(cnt)::BIGINT AS n FROM places GROUP BY l, r) WHERE length(l || r) <= 16),
   front AS MATERIALIZED (
     SELECT *, row_number() OVER (ORDER BY n DESC, length(piece), piece, length(l)) AS k FROM pairs
     WHERE NOT made ORDER BY k LIMIT {ahead + 1}),
   beside AS (
     SELECT k, greatest(
       (SELECT coalesce(max(b.n), 0) FROM pairs b WHERE b.made AND (b.r = a.l OR b.l = a.r)),
       CASE WHEN a.l = a.r THEN a.n ELSE 0 END) AS most FROM front a),
   ends AS (
     SELECT least(coalesce(min(k), {ahead + 1}), {ahead + 1}, (SELECT n + 1 FROM left_over)) AS k
     FROM (SELECT a.k FROM front a, front b
           WHERE b.k < a.k AND (b.l = a.r OR b.r = a.l OR b.piece = a.piece)
           UNION ALL
           SELECT k FROM (SELECT k, n, max(most) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING
                                                       AND 1 PRECEDING) AS most
                          FROM front JOIN beside USING (k)) WHERE n <= most)),
   taken AS MATERIALIZED (
     SELECT k, l, r, n FROM (
       SELECT *, min(length(piece)) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS short
       FROM front WHERE k < (SELECT k FROM ends))
     WHERE k = 1 OR n > coalesce((SELECT n FROM front WHERE k = (SELECT k FROM ends)), 0)
       OR length(piece) <= short),
   joins AS (
     SELECT coalesce(list({{'f': '{OPEN}' || l || '{CLOSE}{OPEN}' || r || '{CLOSE}',
                           't': '{OPEN}' || l || r || '{CLOSE}'}}), []) AS js FROM taken)
   SELECT 'w', key, list_reduce([{{'f': '', 't': symbols}}] || js,
            lambda a, j: {{'f': '', 't': replace(a.t, j.f, j.t)}}).t, cnt, NULL, NULL
   FROM recurring.steps, joins WHERE kind = 'w' AND key IN (SELECT key FROM places JOIN taken USING (l, r))
   UNION ALL
   SELECT 'm', (SELECT count(*) FROM done) + k, NULL, n, l, r FROM taken
  )),
merges AS (SELECT key AS step, l, r, cnt AS n FROM steps WHERE kind = 'm'),
{parts[parts.index("learned AS ("):]}"""


def merged_units(units, vocab="bpe", name="joinable"):
    """(unit, parts): best-scored neighbours joined until none is a piece."""
    return f"""
{name} AS (
  SELECT unit, [c FOR c IN string_split(replace(unit, ' ', '▁'), '') IF c <> ''] AS parts, true AS open
  FROM {units}
  UNION ALL
  (WITH spots AS (SELECT unit, parts, unnest(range(1, len(parts))) AS i FROM {name} WHERE open),
   found AS (
     SELECT unit, any_value(parts) AS parts, min_by(i, (-score, i)) AS i
     FROM spots JOIN {vocab} ON parts[i] || parts[i + 1] = piece GROUP BY unit)
   SELECT unit, parts[:i - 1] || [parts[i] || parts[i + 1]] || parts[i + 2:], true FROM found
   UNION ALL
   SELECT unit, parts, false FROM {name} WHERE open AND unit NOT IN (SELECT unit FROM found)
  )),
{name}_done AS (SELECT unit, parts FROM {name} WHERE NOT open)"""
