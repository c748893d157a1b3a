"""One query for each operator, over its whole table."""

from . import (
    alignment, collocations, decontamination, importance, language_model, languages, licences, mixing, near_duplicates,
    quality_rules, substrings, toxicity, warc,
)

QUERIES, SQL = {}, {}


def query(sql=None):
    """Register a function of (spark, sf_dir) under its own name."""

    def keep(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return keep


#: Where the vocabulary files of the public tokenizers lie.
TOKENIZERS = "/opt/tokenizers"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Words of a text in the SQL of these queries; A-Z lower-cased where asked.
LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
ALNUM = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""WITH d AS (SELECT doc_id, coalesce({ALNUM.format(text=LOWERED)}, []) AS w FROM documents),
b AS (SELECT item_id, {ALNUM.format(text=LOWERED)} AS w FROM benchmark),
pat AS (SELECT DISTINCT item_id, least(10, len(w)) AS m,
  w[i:i + least(10, len(w)) - 1] AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
widths AS (SELECT DISTINCT m FROM pat),
win AS (SELECT doc_id, m, i, w[i:i + m - 1] AS p FROM (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, widths WHERE len(w) >= m)),
hit AS (SELECT doc_id, i, m, item_id FROM win JOIN pat USING (m, p)),
cov AS (SELECT doc_id, count(DISTINCT k) AS n FROM (
  SELECT doc_id, unnest(range(i, i + m)) AS k FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS ids FROM (
  SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(cov.n, 0)::BIGINT AS n_hit,
  coalesce(its.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(cov.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)""")
def op4_decontamination(spark, sf_dir):
    return decontamination.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(f"""WITH d AS (SELECT doc_id, coalesce({SPACED.format(text='text')}, []) AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS p FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
least_doc AS (SELECT p, min(doc_id) AS m FROM win GROUP BY p),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS k FROM win JOIN least_doc USING (p) WHERE doc_id > m),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
each_word AS (SELECT doc_id, generate_subscripts(w, 1) AS k, unnest(w) AS word FROM d),
rest AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t FROM each_word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN rest USING (doc_id)""")
def op10_substring_dedup(spark, sf_dir):
    return substrings.substring_report(table(spark, sf_dir, "documents"))


@query(f"""WITH RECURSIVE d AS (SELECT doc_id, coalesce({SPACED.format(text=LOWERED)}, []) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]
    WHEN len(w) = 1 THEN w ELSE [] END) AS s FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, ways.b FROM reach JOIN ways ON reach.b = ways.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN n USING (doc_id)""")
def op1_near_duplicates(spark, sf_dir):
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@query(f"""WITH d AS (SELECT doc_id, source, len(coalesce({SPACED.format(text='text')}, []))::BIGINT AS size,
  ('0x' || substr(md5('17 ' || coalesce(doc_id::VARCHAR, 'text') || ' ' || coalesce(text, '')), 1, 15))::BIGINT AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
k AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
  source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM k),
lowest AS (SELECT arg_min(level, cap / weight) AS open FROM l WHERE level < cap / weight),
t AS (SELECT source, source_size, coalesce(least(cap, weight * open), cap) AS target FROM l LEFT JOIN lowest ON true),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t),
c AS (SELECT doc_id, d.source, size, source_size, target, whole, place, target - whole * source_size AS more
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
g AS (SELECT source, place, sum(size) AS words FROM c GROUP BY source, place),
h AS (SELECT source, place, words, coalesce(sum(words) OVER (PARTITION BY source ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g)
SELECT doc_id, size, source_size, target,
  size * (whole + CASE WHEN before + words / 2 <= more AND words > 0 THEN 1 ELSE 0 END)::BIGINT AS taken
FROM c JOIN h ON c.source IS NOT DISTINCT FROM h.source AND c.place = h.place""")
def op2_mixing(spark, sf_dir):
    return mixing.mixing_report(table(spark, sf_dir, "documents"))


@query()
def op7_quality_rules(spark, sf_dir):
    return quality_rules.quality_report(table(spark, sf_dir, "documents"))


@query()
def op6_language_model(spark, sf_dir):
    return language_model.score_texts(table(spark, sf_dir, "documents"))


@query()
def op8_importance(spark, sf_dir):
    return importance.quality_selection(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op9_language_id(spark, sf_dir):
    return languages.language_report(table(spark, sf_dir, "documents"))


def _template_rows():
    pairs = {k: licences.template_pairs(v) for k, v in licences.TEMPLATES.items()}
    listed = lambda v: "[" + ", ".join(f"'{x}'" for x in v) + "]"
    return ", ".join(f"('{k}', {listed(v)})" for k, v in pairs.items())


@query(f"""WITH t(licence, p) AS (VALUES {_template_rows()}),
w AS (SELECT doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents),
g AS (SELECT doc_id, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] AS g FROM w),
e AS (SELECT doc_id, unnest(g) AS pair, unnest(range(1, len(g) + 1)) AS i FROM g),
h AS (SELECT doc_id, licence, k, i, pair FROM e JOIN (SELECT licence, len(p) AS k, unnest(p) AS pair FROM t) USING (pair)),
many AS (SELECT doc_id, licence FROM h GROUP BY doc_id, licence, k HAVING 3 * count(DISTINCT pair) >= 2 * k),
runs AS (SELECT a.doc_id, a.licence, a.i, b.i AS j FROM many JOIN h a USING (doc_id, licence)
  JOIN h b ON b.doc_id = a.doc_id AND b.licence = a.licence AND b.i >= a.i AND b.i < a.i + 3 * a.k),
d AS (SELECT doc_id, licence, p, list_distinct(g[i:j]) AS d FROM runs JOIN g USING (doc_id) JOIN t USING (licence)),
m AS (SELECT doc_id, licence, max(2.0::DOUBLE * len(list_intersect(d, p)) / (len(d) + len(p))) AS dice FROM d
  WHERE 2 * len(d) <= 3 * len(p) GROUP BY ALL),
r AS (SELECT doc_id, count(*) AS n, string_agg(licence, ',' ORDER BY licence) AS l, max(dice) AS dice FROM m WHERE dice >= 0.8 GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_licences, coalesce(l, '') AS licences, coalesce(dice, 0.0)::DOUBLE AS dice
FROM documents LEFT JOIN r USING (doc_id)""")
def op3_licences(spark, sf_dir):
    return licences.licence_report(table(spark, sf_dir, "documents"))


@query()
def op5_toxicity(spark, sf_dir):
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The base32 letters of a hexadecimal SHA-1, five digits (four letters) at a time.
BASE32 = "array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr({h}, 1 + 5 * (i // 4), 5))::BIGINT // [32768, 1024, 32, 1][i % 4 + 1] % 32 + 1)::INT, 1) FOR i IN range(32)], '')"


@query(f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT html, max(page_id) AS first FROM p GROUP BY html)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, {BASE32.format(h='sha1(html)')} AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN g USING (html)""")
def op11_warc(spark, sf_dir):
    report = warc.archive_report(table(spark, sf_dir, "pages"))
    return report.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op12_token_alignment(spark, sf_dir):
    return alignment.alignment_report(table(spark, sf_dir, "documents"), TOKENIZERS)


@query(f"""WITH p AS (SELECT coalesce(lang, 'und') AS lang,
  unnest(regexp_split_to_array(coalesce({LOWERED}, ''), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (
  SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE m > 1 AND f >= 100),
cuts AS (SELECT lang, phrase, f, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM (SELECT lang, phrase, f, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM c)),
s AS (SELECT cuts.*, l.f AS l, r.f AS r, n, (1000::HUGEINT * cuts.f * n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = lp JOIN f r ON r.lang = cuts.lang AND r.phrase = rp JOIN t ON t.lang = cuts.lang),
lowest AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM lowest x WHERE NOT EXISTS (SELECT 1 FROM c d WHERE d.lang = x.lang AND 100 * d.f >= 100 * x.f
  AND len(d.phrase) > len(x.phrase) AND contains(' ' || d.phrase || ' ', ' ' || x.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase)::BIGINT AS rank, phrase,
  f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM kept QUALIFY rank <= 2000""")
def op13_collocations(spark, sf_dir):
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))
