"""Phrases whose words belong together, mined best first for each language.

A phrase of 2 to 5 words that occurs `least` times or more is a candidate. Cut
after k words into parts that occur l and r times it scores
floor(1000 * a * n / (l * r)); its lowest cut counts.

Bound. Each part occurs at least as often as the phrase, so whatever phrase
grows from a first word of count f scores at most floor(1000 * n / f). Rare
first words have the best bounds.

1. Words. Tasks deal counts of word hashes to buckets; a filter of fixed size
   names the hashes that reach `least`. Texts are then stored once as runs of
   such words (numbers into the slice's own list), which is what all later
   passes read. Exact counts go by the words themselves.
2. Waves. The frontier is taken in the order of its bounds: first the words of
   best bound, then more. A wave grows its prefixes a word at a time; one pass
   over the runs counts each step, and with it what is still asked for: the
   right parts of candidates, and the words before them. Only a bit filter of
   fixed size goes to the tasks; a full one counts more, never less.
3. Settle. A wave's candidates are scored, and those dropped that lie in a
   longer candidate that occurs (nearly) as often; a phrase that contains one
   further word on either side says so. The last of each language's best 2000
   survivors then closes every first word whose bound lies below its score; a
   wave takes the rest until none is open, so ties are settled too.

Counts are folded in tasks before they move, so the commonest word is one row
for each slice. No language meets in one task: its best are cut by a histogram
of scores first.

Defined cases: null texts are empty; a null language is `und`, together with
that name; every row counts, repeated ones and those without id; texts without
words add nothing; an empty table gives an empty result; other columns are not
read. Scores are exact whole numbers (38 digits inside); ties go by count, then
by the phrase's bytes.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage, drop_stored, store
from .substrings import _by, _heads, _planes, _unplanes
from .tables import buckets_for, text_bytes
from .words import Words, combine, mix, slices, tidy

LEAST, KEEP, LONGEST = 100, 2000, 5
#: A candidate goes when a longer one occurs this share of its times (percent).
SHARE = 100
#: Words of each language in the first wave; each further one takes so many times more.
FIRST_WORDS, MORE = 20_000, 8
#: Bits of a filter: so many for each phrase, within these bounds.
BITS_EACH, LEAST_BITS, MOST_BITS = 1024, 1 << 20, 1 << 27
#: Bits that one row of a filter holds.
PART_BITS = 1 << 17
#: Distinct words that a task holds before it sends their counts.
HELD = 1 << 19
PER_BUCKET = 32 << 20

BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
INSIDE = np.ones(256, bool)
INSIDE[list(BREAKS + b"\x20\x09")] = False
_break = np.zeros(256, bool)
_break[list(BREAKS)] = True
_plain = np.ones(256, bool)
_plain[0x20] = False

#: What a filter's phrase asks for: itself, what follows it, what stands before it.
ITSELF, AFTER, BEFORE = 0, 1, 2

_RUNS = "lang string, total bigint, words binary, counts binary, codes binary"
_COUNTS = "lang string, phrase string, m int, n bigint"
_FRAME = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("m", pa.int32()), ("n", pa.int64())])


def _lang_hash(lang: str) -> np.uint64:
    return Words(pa.array([lang]), np.ones(256, bool)).hashes(seed=7)[0] if lang else np.uint64(7)


def _hashes(words: Words, lang: str, seed: int = 0) -> np.ndarray:
    return combine(words.hashes(seed), _lang_hash(lang))


class _Filter:
    """Bits of phrases' hashes."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    def holds(self, h: np.ndarray, kind: int) -> np.ndarray:
        at = (mix(h + np.uint64(kind)) & self.mask).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _by_language(batches):
    """(language, texts) of slices of bounded size."""
    for batch in batches:
        langs, column = batch.column(0), batch.column(1)
        for start, stop in slices(column):
            part, texts = langs[start:stop].dictionary_encode(), column[start:stop]
            for k, lang in enumerate(part.dictionary.to_pylist()):
                yield lang, texts.filter(pc.equal(part.indices, k))


def _slim(docs, lang, text):
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))


def _deal_hashes(n_buckets):
    """Counts of word hashes, folded in the task."""

    def send(held):
        h, n = (np.concatenate(c) for c in zip(*held))
        h, place = np.unique(h, return_inverse=True)
        n = np.bincount(place, n).astype(np.uint64)
        rows = [(b, _planes(h[at], 8), _planes(n[at], 6)) for b, at in _by((h % np.uint64(n_buckets)).astype(np.int64))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.binary(), pa.binary()))],
                                          ["bucket", "hashes", "counts"])

    def run(batches):
        held, size = [], 0
        for lang, texts in _by_language(batches):
            words = Words(texts, INSIDE, lower=True)
            if not len(words):
                continue
            held.append(np.unique(_hashes(words, lang), return_counts=True))
            size += len(held[-1][0])
            if size >= HELD:
                yield send(held)
                held, size = [], 0
        if held:
            yield send(held)

    return run


def _often(least):
    def run(key, dealt):
        h = np.concatenate([_unplanes(x, 8) for x in dealt.column("hashes").to_pylist()])
        n = np.concatenate([_unplanes(x, 6) for x in dealt.column("counts").to_pylist()])
        h, place = np.unique(h, return_inverse=True)
        h = h[np.bincount(place, n.astype(np.float64)) >= least]
        return pa.table({"n": pa.array([len(h)], pa.int64()), "hashes": pa.array([h.tobytes()], pa.binary())})

    return run


def _fold_bits(rows: DataFrame, size: int) -> np.ndarray:
    """The filter of rows of packed hashes (`hashes`, mixed with their kind)."""

    def places(batches):
        for batch in batches:
            h = np.frombuffer(b"".join(x for x in batch.column(0).to_pylist()), np.uint64)
            at = (h & np.uint64(size - 1)).astype(np.int64)
            rows = [(p, (at[i] % PART_BITS).astype("<u4").tobytes()) for p, i in _by(at // PART_BITS)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())],
                                                 ["part", "places"])

    def fold(key, rows):
        bits = np.zeros(PART_BITS, np.uint8)
        for x in rows.column("places").to_pylist():
            bits[np.frombuffer(x, "<u4")] = 1
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    folded = rows.mapInArrow(places, "part bigint, places binary").groupBy("part").applyInArrow(fold, "part bigint, bits binary")
    out = np.zeros((max(1, size // PART_BITS), PART_BITS // 8), np.uint8)
    for row in folded.toLocalIterator():
        out[row.part] = np.frombuffer(row.bits, np.uint8)
    return out.reshape(-1)


def _filter_size(n: int) -> int:
    size = LEAST_BITS
    while size < min(MOST_BITS, n * BITS_EACH):
        size *= 2
    return size


def _runs_of(words: Words):
    """Whether each word goes on in the piece of the word before it."""
    breaks = np.cumsum(_break[words.data])
    at = breaks[words.starts]
    on = np.zeros(len(words), bool)
    on[1:] = at[1:] == at[:-1]
    first = words.first[:-1]
    on[first[first < len(words)]] = False
    return on


def _store_runs(sent):
    """Texts as runs of two or more words that the filter knows."""

    def run(batches):
        known = _Filter(sent.value)
        for lang, texts in _by_language(batches):
            words = Words(texts, INSIDE, lower=True)
            if not len(words):
                continue
            h = _hashes(words, lang)
            # A word is its 128 bits; the filter looks at 64 of them.
            often = np.flatnonzero(known.holds(h, ITSELF))
            one, first, place = np.unique(h[often], return_index=True, return_inverse=True)
            check = words.hashes(seed=99)[often]
            if not np.array_equal(check, check[first][place]):
                _, first, place = np.unique(np.stack([h[often], check], 1), axis=0, return_index=True, return_inverse=True)
                place = place.reshape(-1)
            code = np.zeros(len(words), np.int64)
            code[often] = place + 1
            on = _runs_of(words)
            on[1:] &= (code[1:] > 0) & (code[:-1] > 0)
            inside = on.copy()
            inside[:-1] |= on[1:]
            at = np.flatnonzero(inside)
            # A zero stands before each run.
            begin = ~on[at]
            out = np.zeros(len(at) + int(begin.sum()), np.uint64)
            out[np.arange(len(at)) + np.cumsum(begin)] = code[at]
            picked = often[first]
            listed = b"\n".join(words.data[i:j].tobytes() for i, j in zip(words.starts[picked], words.ends[picked]))
            packed = (listed, _planes(np.bincount(place, minlength=len(first)).astype(np.uint64), 4), _planes(out, 4))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]), pa.array([len(words)], pa.int64()), *(pa.array([_squeezed(x)], pa.binary()) for x in packed)],
                ["lang", "total", "words", "counts", "codes"])

    return run


def _squeezed(data: bytes) -> bytes:
    """Compressed, behind its length. An Arrow batch holds all slices of a task,
    so they come and stay compressed until their turn."""
    return len(data).to_bytes(8, "little") + (pa.compress(data, "zstd", asbytes=True) if data else b"")


def _unsqueezed(value: pa.Scalar) -> bytes:
    data = memoryview(value.as_buffer())
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""


def _unpacked(batches):
    """(language, all words, list of frequent words, their counts, codes) of each stored slice."""
    for batch in batches:
        for i in range(batch.num_rows):
            words, counts, codes = (_unsqueezed(batch.column(c)[i]) for c in ("words", "counts", "codes"))
            counts, codes = _unplanes(counts, 4), _unplanes(codes, 4).astype(np.int64)
            yield (batch.column("lang")[i].as_py(), batch.column("total")[i].as_py(),
                   words.decode("utf-8", "replace").split("\n") if len(counts) else [], counts, codes)


def _rows(lang, phrases, m, counts):
    n = len(counts)
    return pa.RecordBatch.from_arrays(
        [pa.repeat(pa.scalar(lang), n), phrases, pa.repeat(pa.scalar(m, pa.int32()), n), pa.array(counts.astype(np.int64))], schema=_FRAME)


def _word_rows(batches):
    """Counts of frequent words, and of all words under the empty phrase, folded
    in the task: a word is one row for each task that holds it (or `HELD` words)."""
    held, totals, size = {}, {}, 0

    def send():
        for lang, parts in held.items():
            folded = pa.table({"phrase": pa.concat_arrays([w for w, _ in parts]), "n": pa.concat_arrays([n for _, n in parts])})
            folded = folded.group_by("phrase").aggregate([("n", "sum")]).combine_chunks()
            held[lang] = [(pa.array(folded["phrase"].to_pylist(), pa.string()), pa.array(folded["n_sum"].to_numpy()))]

    def rows():
        for lang, [(words, counts)] in held.items():
            yield _rows(lang, words, 1, counts.to_numpy())

    for lang, total, words, counts, _ in _unpacked(batches):
        totals[lang] = totals.get(lang, 0) + total
        if words:
            held.setdefault(lang, []).append((pa.array(words, pa.string()), pa.array(counts.astype(np.int64))))
            size += len(words)
        if size >= HELD:
            send()
            size = sum(len(parts[0][0]) for parts in held.values())
            if size >= HELD // 2:
                yield from rows()
                held, size = {}, 0
    send()
    yield from rows()
    for lang, total in totals.items():
        yield _rows(lang, pa.array([""]), 0, np.array([total]))


def _distinct(columns: list[np.ndarray]):
    """(row of each distinct tuple, its count); tuples are compared whole."""
    key = columns[0]
    for column in columns[1:]:
        key = pa.array((key << 32) | column).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(key, kind="stable")
    head = _heads(key[order])
    return order[head], np.diff(np.append(head, len(key)))


def _count(sent, kinds):
    """Counts of the phrases that the filter asks for: `kinds` has what is asked
    of each length, and phrases of other lengths are neither looked up nor hashed
    beyond what longer ones need."""
    longest = max(kinds, default=0)

    def run(batches):
        asked = _Filter(sent.value)
        for lang, _, words, _, codes in _unpacked(batches):
            if not words:
                continue
            table = pa.array(words, pa.string())
            own = Words(table, _plain)
            one = np.zeros(len(words) + 1, np.uint64)
            one[1:] = _hashes(own, lang)
            each = one[codes]
            part, whole = each, codes > 0
            # What single words are asked for is looked up once for each word.
            single = {kind: asked.holds(one, kind)[codes] for kind in kinds.get(2, ()) if kind != ITSELF}
            for m in range(2, longest + 1):
                n = len(codes) - m + 1
                if n <= 0:
                    break
                whole = whole[:n] & (codes[m - 1 :] > 0)
                at = np.flatnonzero(whole)
                looks = kinds.get(m, ())
                grown = None
                if m < longest or ITSELF in looks:
                    grown = np.zeros(n, np.uint64)
                    grown[at] = combine(part[at], each[at + m - 1])
                if looks:
                    want = np.zeros(len(at), bool)
                    for kind in looks:
                        begin = at + 1 if kind == BEFORE else at
                        if kind in single and m == 2:
                            want |= single[kind][begin]
                        else:
                            want |= asked.holds((grown if kind == ITSELF else part)[begin], kind)
                    at = at[want]
                    if len(at):
                        columns = [codes[at + k] for k in range(m)]
                        rows, counts = _distinct(columns)
                        parts = [table.take(pa.array(c[rows] - 1)) for c in columns]
                        yield _rows(lang, pc.binary_join_element_wise(*parts, " "), m, counts)
                part = grown

    return run


def _phrase_hashes(batches):
    """Hashes of asked phrases, mixed with what is asked of them."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        kinds = batch.column(2).to_numpy(zero_copy_only=False)
        out = np.zeros(batch.num_rows, np.uint64)
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            at = np.flatnonzero(langs.indices.to_numpy(zero_copy_only=False) == k)
            words = Words(batch.column(1).take(pa.array(at)), _plain)
            each, n = _hashes(words, lang), words.counts()
            h = each[words.first[:-1]]
            for step in range(1, int(n.max(initial=1))):
                more = np.flatnonzero(n > step)
                h[more] = combine(h[more], each[words.first[:-1][more] + step])
            out[at] = h
        yield pa.RecordBatch.from_arrays([pa.array([mix(out + kinds.astype(np.uint64)).tobytes()], pa.binary())], ["hashes"])


class _Corpus:
    """Stored runs of words, and what has been counted in them."""

    def __init__(self, docs: DataFrame, least: int):
        self.spark, self.least, self.paths = docs.sparkSession, least, []
        n = buckets_for(self.spark, text_bytes(docs), PER_BUCKET, 1)
        dealt = docs.mapInArrow(tidy(_deal_hashes(n)), "bucket bigint, hashes binary, counts binary")
        often = self.keep(dealt.groupBy("bucket").applyInArrow(_often(least), "n bigint, hashes binary"), "often")
        size = _filter_size(often.agg(F.sum("n")).first()[0] or 0)

        def mixed(batches):
            for batch in batches:
                h = [mix(np.frombuffer(x, np.uint64) + np.uint64(ITSELF)).tobytes() for x in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.binary())], ["hashes"])

        bits = _fold_bits(often.select("hashes").mapInArrow(mixed, "hashes binary"), size)
        self.runs = self.passed(bits, lambda sent: docs.mapInArrow(tidy(_store_runs(sent)), _RUNS), "runs")
        folded = self.runs.mapInArrow(tidy(_word_rows), _COUNTS).groupBy("lang", "phrase", "m").agg(F.sum("n").alias("f"))
        counted = self.keep(folded.where(f"m = 0 or f >= {least}"), "words")
        self.totals = counted.where("m = 0").select("lang", F.col("f").alias("n"))
        self.words = counted.where("m = 1")
        self.counted = [self.words]

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        stored, path = store(df, name)
        self.paths.append(path)
        return stored

    def passed(self, bits: np.ndarray, make, name: str) -> DataFrame:
        sent = self.spark.sparkContext.broadcast(bits)
        try:
            return self.keep(make(sent), name)
        finally:
            sent.destroy()

    def count(self, asked: DataFrame, lengths: list[int]) -> DataFrame:
        """Counts of what `asked` (lang, phrase, kind) names, among phrases of
        these lengths; kept for `known`."""
        asked = self.keep(asked.select("lang", "phrase", F.col("kind").cast("int").alias("kind")).distinct(), "asked")
        # A neighbour of a phrase of m words makes one of m + 1.
        length = F.size(F.split("phrase", " ")) + F.when(F.col("kind") == ITSELF, 0).otherwise(1)
        groups = asked.groupBy("kind", length.alias("m")).agg(F.count("*").alias("n")).collect()  # kinds and lengths
        size = _filter_size(sum(r.n for r in groups))
        kinds = {m: sorted(r.kind for r in groups if r.m == m) for m in lengths if any(r.m == m for r in groups)}
        bits = _fold_bits(asked.mapInArrow(tidy(_phrase_hashes), "hashes binary"), size)
        make = lambda sent: self.runs.mapInArrow(tidy(_count(sent, kinds)), _COUNTS).groupBy("lang", "phrase", "m").agg(
            F.sum("n").alias("f")).where(F.col("f") >= self.least)
        self.counted.append(self.passed(bits, make, "counted"))
        return self.counted[-1]

    def known(self) -> DataFrame:
        """(lang, phrase, m, f) of everything counted so far."""
        every = functools.reduce(DataFrame.unionByName, self.counted)
        return every.groupBy("lang", "phrase").agg(F.first("m").alias("m"), F.max("f").alias("f"))

    def drop(self):
        for path in self.paths:
            drop_stored(self.spark, path)


def _part(phrase, start, n):
    return F.array_join(F.slice(F.split(phrase, " "), start, n), " ")


#: The score of a phrase of count f, in whole numbers of 38 digits.
SCORE = "(cast(f * 1000 as decimal(19,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"


def _cut_scores(candidates: DataFrame, known: DataFrame, totals: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, m, f) with their lowest cut."""
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.withColumn("left", _part("phrase", F.lit(1), F.col("k"))).withColumn(
        "right", _part("phrase", F.col("k") + 1, F.col("m") - F.col("k")))
    side = lambda name, count: known.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    rows = cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"]).join(totals, "lang")
    rows = rows.withColumn("score", F.expr(SCORE))
    lowest = rows.groupBy("lang", "phrase", "m", F.col("f").alias("a"), "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "m", "a", "n", "cut.l", "cut.r", "cut.score")


def _survivors(scored: DataFrame, known: DataFrame, share: int) -> DataFrame:
    """Those that no phrase with one further word on either side covers. A
    longer one that covers has such a phrase inside, of no smaller count."""
    longer = known.where("m > 2").withColumn("sub", F.explode(F.array(
        _part("phrase", F.lit(1), F.col("m") - 1), _part("phrase", F.lit(2), F.col("m") - 1))))
    covers = longer.groupBy("lang", F.col("sub").alias("phrase")).agg(F.max("f").alias("cover"))
    rows = scored.join(covers, ["lang", "phrase"], "left")
    return rows.where(F.col("cover").isNull() | (100 * F.col("cover") < share * F.col("a"))).drop("cover")


def _best(rows: DataFrame, keep: int) -> DataFrame:
    """The first `keep` of each language with their rank. A histogram of scores
    finds where they end, so no language's rows all meet in one task."""
    binned = rows.withColumn("bin", F.floor(16 * F.log2(F.col("score") + 1)))
    down = Window.partitionBy("lang").orderBy(F.col("bin").desc())
    ends = binned.groupBy("lang", "bin").count().withColumn("before", F.sum("count").over(down) - F.col("count"))
    ends = ends.where(F.col("before") < keep).groupBy("lang").agg(F.min("bin").alias("end"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    near = binned.join(ends, "lang").where("bin >= end").drop("bin", "end")
    return near.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= keep)


def _first_words(corpus: _Corpus, state: DataFrame, size: int) -> DataFrame:
    """(lang, cap): the frontier's next words are those whose count is above
    `done` and at most `cap`. Where a language has a last score, all whose bound
    reaches it; else about `size` words, by a histogram of counts."""
    open_ = corpus.words.join(state, "lang").where("f > done and (last is null or 1000 * n div f >= last)")
    binned = open_.withColumn("bin", F.floor(8 * F.log2("f")))
    bins = binned.groupBy("lang", "last", "bin").agg(F.count("*").alias("size"), F.max("f").alias("f"))
    up = Window.partitionBy("lang").orderBy("bin")
    bins = bins.withColumn("before", F.sum("size").over(up) - F.col("size"))
    return bins.where((F.col("before") < size) | F.col("last").isNotNull()).groupBy("lang").agg(F.max("f").alias("cap"))


def _hopeful(corpus: _Corpus, grown: DataFrame, state: DataFrame, m: int) -> DataFrame:
    """Phrases of m words whose last cut (its parts are known) reaches their language's last score."""
    ends = corpus.words.select("lang", F.col("phrase").alias("end"), F.col("f").alias("r"))
    begins = corpus.known().where(F.col("m") == m - 1).select("lang", F.col("phrase").alias("begin"), F.col("f").alias("l"))
    cut = grown.withColumn("end", F.element_at(F.split("phrase", " "), -1)).withColumn("begin", _part("phrase", F.lit(1), F.lit(m - 1)))
    rows = cut.join(ends, ["lang", "end"]).join(begins, ["lang", "begin"]).join(state, "lang")
    return rows.where(f"last is null or {SCORE} >= last").select("lang", "phrase", "m", "f")


def _asks(rows: DataFrame, kind: int) -> DataFrame:
    return rows.select("lang", "phrase", F.lit(kind).alias("kind"))


def mine_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, keep: int = KEEP,
                 longest: int = LONGEST, share: int = SHARE, first_words: int = FIRST_WORDS) -> DataFrame:
    """Each language's first `keep` phrases: lang, rank, phrase, a (its count),
    l and r (its parts' counts), n (all words of the language), score."""
    corpus = _Corpus(_slim(docs, lang, text), least)
    spark = docs.sparkSession
    try:
        state = corpus.keep(corpus.totals.select("lang", "n", F.lit(0).cast("bigint").alias("done"), F.lit(None).cast("bigint").alias("last")), "state")
        found, best, size = None, None, first_words
        while True:
            caps = corpus.keep(_first_words(corpus, state, size), "caps")
            if not caps.limit(1).count():
                break
            limited = state.where("last is not null").limit(1).count() > 0
            wave = corpus.words.join(state, "lang").join(caps, "lang").where(
                "f > done and f <= cap and (last is null or 1000 * n div f >= last)")
            grown, candidates = corpus.keep(wave.select("lang", "phrase", "m", "f"), "wave"), []
            asked = _asks(grown, AFTER)
            for m in range(2, longest + 1):
                counts = corpus.count(asked, list(range(2, m + 1)))
                # What has grown from the wave; the rest was asked for as a part.
                heads = grown.select("lang", F.col("phrase").alias("head"))
                grown = corpus.keep(counts.where(F.col("m") == m).join(
                    heads, (counts["lang"] == heads["lang"]) & (_part("phrase", F.lit(1), F.lit(m - 1)) == heads["head"]), "left_semi"), "grown")
                candidates.append(grown)
                # Those that could still be among the best, by the cut before
                # their last word, whose parts are known.
                hopeful = corpus.keep(_hopeful(corpus, grown, state, m), "hopeful") if limited else grown
                rights = hopeful.withColumn("k", F.explode(F.sequence(F.lit(2), F.lit(m - 1)))) if m > 2 else None
                asked = None
                if m < longest:
                    asked = _asks(grown, AFTER).union(_asks(hopeful, BEFORE))
                if rights is not None:
                    parts = rights.select("lang", _part("phrase", F.lit(m + 1) - F.col("k"), F.col("k")).alias("phrase"))
                    asked = _asks(parts, ITSELF) if asked is None else asked.union(_asks(parts, ITSELF))
            if asked is not None:
                corpus.count(asked, list(range(2, longest)))
            known = corpus.keep(corpus.known(), "known")
            scored = _cut_scores(functools.reduce(DataFrame.union, candidates), known, corpus.totals)
            kept = _survivors(scored, known, share)
            every = kept if found is None else kept.unionByName(found)
            best = corpus.keep(_best(every, keep), "best")
            found = best.drop("rank")
            lasts = best.where(F.col("rank") == keep).select("lang", F.col("score").alias("new_last"))
            state = corpus.keep(state.join(caps, "lang", "left").join(lasts, "lang", "left").select(
                "lang", "n", F.coalesce("cap", "done").alias("done"), F.coalesce("new_last", "last").alias("last")), "state")
            size *= MORE
        names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
        schema = "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"
        rows = best.select(*names) if best is not None else spark.createDataFrame([], schema)
        return cut_lineage(rows)
    finally:
        corpus.drop()
