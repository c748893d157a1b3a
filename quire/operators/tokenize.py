"""Text to token ids.

Tokenizing is a row-wise column operation: with a vocabulary of checked size
it needs no shuffle at all. Spark cuts the text into units; a small Arrow
function looks every distinct unit of a batch up once. Vocabularies too large
to send around are joined instead (`tokenize_by_join`).
"""

import hashlib
import heapq
from collections.abc import Iterator
from functools import cached_property, lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import arrays as ar, text as tx
from .vocab import FIRST_BYTE_ID, MAX_PIECES, SPECIAL_PIECES, check_bounded

MODES = ("bpe", "char", "whitespace")
_SPECIAL = "|".join(SPECIAL_PIECES)


def units(text: Column, mode: str) -> Column:
    """Cut a text into the units that are encoded on their own.

    For `bpe` every stretch between special pieces starts with one added space,
    and a word keeps the spaces before it. Joining merges never cross these
    cuts as long as no piece has a space mark after another character.
    """
    if mode == "whitespace":
        return tx.words(text)
    if mode == "char":
        return tx.characters(text)
    plain = F.split(F.concat(F.lit(" "), text), r"(?= )(?<! )")
    cut = F.split(_spaced(text), rf"(?= )(?<! )|(?={_SPECIAL})")
    return F.filter(F.when(_has_special(text), cut).when(text != "", plain), lambda u: u != "")


def stretches(text: Column) -> Column:
    """The text cut at special pieces only."""
    cut = F.split(_spaced(text), rf"(?<={_SPECIAL})|(?={_SPECIAL})")
    return F.filter(cut, lambda u: u != "")


def _has_special(text: Column) -> Column:
    return reduce(Column.__or__, [F.contains(text, F.lit(p)) for p in SPECIAL_PIECES])


def _spaced(text: Column) -> Column:
    """One space added at the start and after each special piece, unless
    another special piece or the end follows."""
    return F.regexp_replace(text, rf"(?:^|(?<={_SPECIAL}))(?!{_SPECIAL}|\z)", " ")


#: Units and segments that a worker remembers, and how long they may be: at most
#: some 100 MB together, whatever the texts are like.
CACHED_UNITS, CACHED_CHARS = 1 << 16, 64
#: Pieces of vocabularies whose pairs are held as a table, to code units all at once.
TABLE_PIECES = 100_000


class Vocabulary:
    """Piece lookup and score-ordered merging for one unit at a time."""

    def __init__(self, entries: list[tuple[int, str, float]]):
        self.entries = entries
        self.ids = {piece: i for i, piece, _ in entries}
        reserved = {f"<0x{b:02X}>" for b in range(256)} | set(SPECIAL_PIECES)
        self.bytes = [self.ids.get(f"<0x{b:02X}>", ar.UNK) for b in range(256)]
        self.special = {p: self.ids[p] for p in SPECIAL_PIECES if p in self.ids}
        self.scores = {piece: score for _, piece, score in entries if piece not in reserved}
        self.bigrams = {p[i : i + 2] for p in self.scores for i in range(len(p) - 1)}
        self._cached = lru_cache(maxsize=CACHED_UNITS)(self._segment)
        self.cuttable = not any(tx.SPACE_MARK in p.lstrip(tx.SPACE_MARK) for p in self.scores)

    def __reduce__(self):
        """Travels as its entries; a worker builds it once for each broadcast."""
        return Vocabulary, (self.entries,)

    def segment(self, text: str) -> list[int]:
        """Short segments are remembered; long ones hardly come again."""
        return self._cached(text) if len(text) <= CACHED_CHARS else self._segment(text)

    def lookup(self, unit: str) -> list[int]:
        found = self.ids.get(unit)
        return [self.bytes[b] for b in unit.encode()] if found is None else [found]

    def merge(self, unit: str) -> list[int]:
        """Ids of one unit. Two characters that stand side by side in no piece
        can never end up in one, so the unit is cut there and repeated segments
        are looked up; this is what keeps text without spaces fast."""
        if unit in self.special:
            return [self.special[unit]]
        text, ids, start = unit.replace(" ", tx.SPACE_MARK), [], 0
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in self.bigrams:
                ids += self.segment(text[start:i])
                start = i
        return ids + self.segment(text[start:])

    def _segment(self, text: str) -> list[int]:
        """Join the adjacent pair with the best score, leftmost first, until no
        pair forms a piece."""
        parts = list(text)
        joined = self._join_short(parts) if len(parts) <= 40 else self._join_long(parts)
        return [t for p in joined for t in self.lookup(p)]

    @cached_property
    def pairs(self):
        """Symbols (characters and pieces), the pairs of them that are pieces, and the
        ids of each symbol, as arrays; None for vocabularies too large for that."""
        if len(self.scores) > TABLE_PIECES:
            return None
        pieces = [p for p in self.scores if len(p) <= CACHED_CHARS]
        number = {c: n for n, c in enumerate(sorted(set("".join(pieces))))}
        points = np.array([ord(c) for c in number], np.int64)
        for p in pieces:
            number.setdefault(p, len(number))
        rank = {x: n for n, x in enumerate(sorted(set(self.scores.values()), reverse=True))}
        rows = [((left << 32) | right, number[p], rank[self.scores[p]]) for p in pieces for i in range(1, len(p))
                if (left := number.get(p[:i])) is not None and (right := number.get(p[i:])) is not None]
        keys, made, ranks = np.array(sorted(rows) or np.zeros((0, 3)), np.int64).reshape(-1, 3).T.copy()
        lists = [self.lookup(x) for x in number]
        return points, keys, made, ranks, lists

    def merge_all(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many units of at least one character, one after the other, and how
        many each has: `merge` for all at once, each joining its best pair a round."""
        points, keys, made, ranks, lists = self.pairs
        length = np.fromiter((len(u) for u in units), np.int64, len(units))
        text = np.frombuffer("".join(units).replace(" ", tx.SPACE_MARK).encode("utf-32-le"), "<i4").astype(np.int64)
        at = np.minimum(np.searchsorted(points, text), max(len(points) - 1, 0))
        known = (points[at] == text) if len(points) else np.zeros(len(text), bool)
        cells, word, none = np.where(known, at, -1 - text), np.repeat(np.arange(len(units)), length), len(keys)

        def best_at(i):
            """Places in `keys` of the pairs that begin at cells `i`, and their ranks."""
            i = np.minimum(i, len(cells) - 2)
            pair = (cells[i] << 32) | cells[i + 1]
            place = np.minimum(np.searchsorted(keys, pair), none - 1)
            fit = (keys[place] == pair) & (word[i] == word[i + 1]) & (cells[i + 1] >= 0)
            return np.where(fit, place, none)

        done, owners = [], []
        order = np.append(ranks, np.iinfo(np.int64).max)
        place = np.append(best_at(np.arange(len(cells) - 1)), none) if none and len(cells) > 1 else np.full(len(cells), none)
        while len(cells):
            rank, heads = order[place], np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank, heads)
            sizes = np.diff(heads, append=len(cells))
            shut = np.repeat(best == order[-1], sizes)
            if shut.any():
                done.append(cells[shut])
                owners.append(word[shut])
                cells, word, place, rank = cells[~shut], word[~shut], place[~shut], rank[~shut]
                if not len(cells):
                    break
                best, sizes = best[best != order[-1]], sizes[best != order[-1]]
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            hit = hit[np.diff(word[hit], prepend=-1) != 0]  # the leftmost of each word
            cells[hit] = made[place[hit]]
            left = np.ones(len(cells), bool)
            left[hit + 1] = False
            cells, word, place = cells[left], word[left], place[left]
            hit = hit - np.arange(len(hit))
            if len(cells) > 1:
                place[hit] = np.where(hit < len(cells) - 1, best_at(hit), none)
                before = hit[hit > 0] - 1
                place[before] = best_at(before)
            else:
                place[:] = none
        if not done:
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        cells, owners = np.concatenate(done), np.concatenate(owners)
        back = np.argsort(owners, kind="stable")
        cells, owners = cells[back], owners[back]
        strange, at = np.unique(cells[cells < 0], return_inverse=True)
        cells[cells < 0] = len(lists) + at
        coded = lists + [self.lookup(chr(-1 - c)) for c in strange.tolist()]
        used, at = np.unique(cells, return_inverse=True)
        coded = [coded[c] for c in used.tolist()]
        sizes = np.fromiter((len(x) for x in coded), np.int64, len(coded))
        flat = np.fromiter((t for x in coded for t in x), np.int32, int(sizes.sum()))
        own = sizes[at]
        ids = flat[np.repeat((np.cumsum(sizes) - sizes)[at] - (np.cumsum(own) - own), own) + np.arange(int(own.sum()))]
        return ids, np.bincount(owners, own, len(units)).astype(np.int32)

    def _join_short(self, parts):
        get, none = self.scores.get, float("-inf")
        scores = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) != none:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i < len(scores):
                scores[i] = get(parts[i] + parts[i + 1], none)
            if i:
                scores[i - 1] = get(parts[i - 1] + parts[i], none)
        return parts

    def _join_long(self, parts):
        """The same with a queue of candidates, near linear for long units."""
        count = len(parts)
        after, ahead, queue = list(range(1, count + 1)), list(range(-1, count - 1)), []

        def offer(i):
            j = after[i] if i >= 0 else count
            if j < count:
                score = self.scores.get(parts[i] + parts[j])
                if score is not None:
                    heapq.heappush(queue, (-score, i, parts[i], parts[j]))

        for i in range(count):
            offer(i)
        while queue:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if parts[i] != left or j >= count or parts[j] != right:
                continue  # one side was joined elsewhere meanwhile
            parts[i], parts[j] = left + right, ""
            after[i] = after[j]
            if after[i] < count:
                ahead[after[i]] = i
            offer(ahead[i])
            offer(i)
        return [p for p in parts if p]


#: Units that are coded, or spread to ids, at once: some 100 bytes each while that
#: lasts. Rows of any length come 10,000 at a time, so a batch is cut.
SLICE_UNITS = 1 << 17


def cut_runs(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(start, stop) of runs of rows of at most `most` units, or of one row."""
    if not len(sizes):
        yield 0, 0
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop
        start = stop


def _lengths(sizes: pa.Array) -> np.ndarray:
    return pa.compute.fill_null(sizes, 0).to_numpy(zero_copy_only=False)


def encoder(sent, mode: str):
    """Arrow function from arrays of units to arrays of ids."""

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = sent.value
        code = vocab.merge if mode == "bpe" else vocab.lookup
        short = lru_cache(maxsize=CACHED_UNITS)(code)
        for batch in batches:
            coded = batch.flatten().dictionary_encode()
            known = [ids_of(coded.dictionary.slice(at, SLICE_UNITS), code, short)
                     for at in range(0, max(1, len(coded.dictionary)), SLICE_UNITS)]
            flat, sizes = (np.concatenate(x) for x in zip(*known))
            starts = np.cumsum(sizes) - sizes
            lengths = _lengths(pa.compute.list_value_length(batch))
            before = np.append(0, np.cumsum(lengths))
            for start, stop in cut_runs(lengths, SLICE_UNITS):
                unit = coded.indices.slice(before[start], before[stop] - before[start]).to_numpy(zero_copy_only=False)
                yield _spread(flat, sizes, starts, unit, before[start : stop + 1] - before[start], batch.slice(start, stop - start))

    def ids_of(distinct, code, short):
        if mode == "bpe" and sent.value.pairs is not None:
            return ids_at_once(distinct.to_pylist(), sent.value)
        lists = [short(u) if len(u) <= CACHED_CHARS else code(u) for u in distinct.to_pylist()]
        sizes = np.fromiter((len(x) for x in lists), np.int32, len(lists))
        return np.fromiter((t for x in lists for t in x), np.int32, int(sizes.sum(dtype=np.int64))), sizes

    def ids_at_once(units, vocab):
        """Short units together, long and special ones each by itself."""
        short = np.fromiter((0 < len(u) <= CACHED_CHARS and u not in vocab.special for u in units), bool, len(units))
        some = [u for u, s in zip(units, short) if s]
        parts = [vocab.merge_all(some[at : at + CACHED_UNITS // 4]) for at in range(0, max(1, len(some)), CACHED_UNITS // 4)]
        ids, size = (np.concatenate(x) for x in zip(*parts))
        other = [vocab.merge(units[i]) if units[i] else [] for i in np.flatnonzero(~short)]
        sizes = np.zeros(len(units), np.int32)
        sizes[short], sizes[~short] = size, [len(x) for x in other]
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        flat = np.empty(int(sizes.sum(dtype=np.int64)), np.int32)
        flat[np.repeat(starts[short] - (np.cumsum(size, dtype=np.int64) - size), size) + np.arange(len(ids))] = ids
        for start, own in zip(starts[~short], other):
            flat[start : start + len(own)] = own
        return flat, sizes

    return F.arrow_udf(encode, "array<int>")


def _spread(flat, sizes, starts, unit, row_units, batch) -> pa.ListArray:
    """Ids of each row: `flat` holds the ids of distinct units one after the
    other, `sizes` how many each has, `starts` where they begin, `unit` the
    units in the rows' order, and `row_units` where each row's begin."""
    unit_sizes = sizes[unit].astype(np.int64) if len(unit) else np.zeros(0, np.int64)
    ends = np.cumsum(unit_sizes)
    # Where each output id sits in `flat`: its unit's start plus its rank there.
    begins = starts[unit] if len(unit) else unit_sizes
    shift = np.repeat(begins - (ends - unit_sizes), unit_sizes)
    ids = flat[shift + np.arange(len(shift))]
    offsets = np.concatenate([[0], ends])[row_units].astype(np.int32)
    mask = batch.is_null() if batch.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()), mask=mask)


def char_encoder(sent):
    """Arrow function from texts to arrays of ids, a unit for each character.
    Texts come whole: their code points are looked up as one array."""

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocab = sent.value
        for batch in batches:
            for start, stop in cut_runs(_lengths(pa.compute.binary_length(batch)), SLICE_UNITS):
                yield ids_of(batch.slice(start, stop - start), vocab)

    def ids_of(batch, vocab):
        texts = [t or "" for t in batch.to_pylist()]
        points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        known, unit = np.unique(points, return_inverse=True)
        lists = [vocab.lookup(chr(c)) for c in known.tolist()]
        sizes = np.fromiter((len(x) for x in lists), np.int64, len(lists))
        flat = np.fromiter((t for x in lists for t in x), np.int32, int(sizes.sum()))
        row_units = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        return _spread(flat, sizes, np.cumsum(sizes) - sizes, unit, row_units, batch)

    return F.arrow_udf(encode, "array<int>")


def tokenize(
    df: DataFrame,
    vocab: DataFrame,
    col: str = "text",
    mode: str = "bpe",
    bos: bool = True,
    eos: bool = False,
    mask: bool = False,
    out: str = "input_ids",
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Add `out` (and `attention_mask`) without a shuffle.

    The vocabulary is sent to every task, which is checked against `max_pieces`.
    """
    loaded = load_vocabulary(vocab, mode, max_pieces)
    return tokenize_with(df, loaded, col, mode, bos, eos, mask, out)


def load_vocabulary(vocab: DataFrame, mode: str = "bpe", max_pieces: int = MAX_PIECES):
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    rows = check_bounded(vocab.select("id", "piece", "score"), max_pieces)
    return Vocabulary([tuple(r) for r in rows])


def tokenize_with(
    df, vocabulary: Vocabulary, col="text", mode="bpe", bos=True, eos=False, mask=False,
    out="input_ids",
) -> DataFrame:
    text = tx.as_text(col)
    if mode == "bpe" and not vocabulary.cuttable:
        cut = stretches(text)  # a piece spans words
    else:
        cut = units(text, mode)
    sent = df.sparkSession.sparkContext.broadcast(vocabulary)  # size checked on loading
    if mode == "char":
        ids = char_encoder(sent)(F.coalesce(text, F.lit("")))
    else:
        none = F.array().cast("array<string>")  # a missing text has no units
        ids = encoder(sent, mode)(F.coalesce(cut, none))
    result = df.withColumn(out, ar.with_special(ids, bos, eos))
    return result.withColumn("attention_mask", ar.ones_mask(F.col(out))) if mask else result


#: Bytes of a piece that may be sent to all tasks, and over how many keys longer ones
#: are spread, of which there may be so many.
SHORT_BYTES, LONG_UNITS, SALTS = 64, 1000, 32
#: Text of one group of rows.
GROUP_BYTES = 8 << 20
#: Bits of the filter of pieces, and how many for each piece. A full filter lets more
#: units through, never fewer pieces.
FILTER_BITS, PIECE_BITS = 1 << 27, 16


def _digest(unit: str) -> bytes:
    return hashlib.md5(unit.encode()).digest()


def _bits(digests: list[bytes], size: int) -> np.ndarray:
    """Two bits of a filter of `size` bits for each digest."""
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2) & np.uint64(size - 1)


def piece_filter(pieces: DataFrame) -> np.ndarray:
    """A bit filter of (_unit), one byte for each bit; at most 8 tasks send theirs."""
    wanted = max(1 << 12, PIECE_BITS * pieces.count())
    size = min(FILTER_BITS, 1 << (wanted - 1).bit_length())

    def fold(batches):
        held = np.zeros(size, bool)
        for batch in batches:
            held[_bits(batch.column(0).to_pylist(), size).ravel()] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(held).tobytes()], pa.binary())], ["bits"])

    held = np.zeros(size // 8, np.uint8)
    for row in pieces.coalesce(8).mapInArrow(fold, "bits binary").toLocalIterator():
        held |= np.frombuffer(row.bits, np.uint8)
    return held


def _asked(sent):
    """(_group, _unit): each unit of a group once, if the filter holds it and it isn't
    among the pieces that all tasks have. Rows come by group."""

    def run(batches):
        held, hot = sent.value
        size, group, seen = 8 * len(held), None, set()
        for batch in batches:
            groups = batch.column("_group").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.diff(groups, prepend=groups[:1] - 1)) if len(groups) else []
            for start, stop in zip(starts, [*starts[1:], len(groups)]):
                if groups[start] != group:
                    group, seen = groups[start], set()
                units = batch.column("_units").slice(start, stop - start).flatten().unique()
                digests = [_digest(u) for u in units.to_pylist()]
                if not digests:
                    continue
                bits = _bits(digests, size)
                found = ((held[bits >> 3] >> (7 - (bits & 7)).astype(np.uint8)) & 1).all(axis=1)
                fresh = [d for d in (digests[i] for i in np.flatnonzero(found)) if d not in seen and d not in hot]
                seen.update(fresh)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fresh), group), pa.int64()), pa.array(fresh, pa.binary())], ["_group", "_unit"])

    return run


def _code_group(key: list[str], sent):
    """A group's rows with their ids, from the pieces that it was told of; units
    that are no piece are coded by their bytes."""

    def run(_, rows, told):
        every: dict = {}
        for d, i in zip(told.column("_unit").to_pylist(), told.column("id").to_pylist()):
            every.setdefault(d, []).append(i)
        hot = sent.value[1]
        units = rows.column("_units").combine_chunks()
        coded = units.flatten().dictionary_encode()
        # A piece that the vocabulary has more than once gives all its ids.
        flat = []
        sizes = np.zeros(len(coded.dictionary), np.int32)
        for i, unit in enumerate(coded.dictionary.to_pylist()):
            digest = _digest(unit)
            ids = every.get(digest) or hot.get(digest)
            own = sorted(ids) if ids else [b + FIRST_BYTE_ID for b in unit.encode()]
            flat += own
            sizes[i] = len(own)
        flat = np.array(flat, np.int32)
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        unit = coded.indices.to_numpy(zero_copy_only=False) if len(coded) else np.zeros(0, np.int64)
        row_units = np.append(0, np.cumsum(_lengths(pa.compute.list_value_length(units)), dtype=np.int64))
        lists = _spread(flat, sizes, starts, unit, row_units, units)
        keys = list(zip(*(rows.column(k).to_pylist() for k in key)))
        if len(set(keys)) < len(keys):  # rows of one key give their places in turn
            together: dict = {}
            for i, k in enumerate(keys):
                own = unit[row_units[i] : row_units[i + 1]]
                together.setdefault(k, []).extend((p, flat[starts[u] : starts[u] + sizes[u]].tolist()) for p, u in enumerate(own))
            joined = {k: [t for _, part in sorted(parts) for t in part] for k, parts in together.items()}
            lists = pa.array([joined[k] for k in keys], pa.list_(pa.int32()))
        kept = [c for c in rows.column_names if c not in ("_group", "_units")]
        return pa.table([*(rows.column(c) for c in kept), lists], [*kept, "_ids"])

    return run


def tokenize_by_join(
    df: DataFrame,
    vocab: DataFrame,
    key: list[str],
    col: str = "text",
    mode: str = "whitespace",
    bos: bool = True,
    eos: bool = False,
    out: str = "input_ids",
    hot_units: int = 10_000,
) -> DataFrame:
    """`char` and `whitespace` tokenizing against a vocabulary of any size.

    Rows are dealt once to groups of some `GROUP_BYTES` of text by the hash of their
    key; both steps after that read this one exchange. A group first asks for each of
    its distinct units once, by 128 bits of the unit, not its text, and only for those
    that a bit filter of the vocabulary holds; it then codes its rows from the answers,
    and other units by their bytes. So texts travel once, a unit's places never, and no
    unit is asked for by more rows than there are groups. The first `hot_units` short
    pieces by id are sent to all tasks; of the long ones the first `LONG_UNITS` are
    spread over `SALTS` keys. `key` must be unique.
    """
    if mode == "bpe":
        raise ValueError("bpe merging needs the vocabulary in memory")
    spark = df.sparkSession
    size = df.select(F.sum(F.octet_length(tx.as_text(col)))).first()[0] or 0
    n_groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // GROUP_BYTES)
    group = F.pmod(F.xxhash64(*key), F.lit(n_groups)).alias("_group")
    known = vocab.where(F.col("piece").isNotNull() & F.col("id").isNotNull())
    known = known.select(F.unhex(F.md5("piece")).alias("_unit"), "id", F.octet_length("piece").alias("_bytes"))
    is_short = F.col("_bytes") <= SHORT_BYTES
    first = known.where(is_short).orderBy("id").limit(hot_units).select("_unit").distinct()
    hot: dict = {}
    for r in known.join(F.broadcast(first), "_unit", "left_semi").select("_unit", "id").collect():  # hot_units short keys
        hot.setdefault(bytes(r["_unit"]), []).append(r["id"])
    sent = spark.sparkContext.broadcast((piece_filter(known.select("_unit")), hot))
    dealt = df.dropna(subset=key).select("*", group).repartition(n_groups, "_group")
    dealt = dealt.select("*", F.coalesce(units(tx.as_text(col), mode), F.array().cast("array<string>")).alias("_units"))
    asked = dealt.sortWithinPartitions("_group").mapInArrow(_asked(sent), "_group bigint, _unit binary")
    long_ = known.where(~is_short).orderBy("id").limit(LONG_UNITS).select("_unit", F.lit(True).alias("_long")).distinct()
    salt = F.when(F.col("_long"), F.pmod("_group", F.lit(SALTS))).otherwise(0).cast("int")
    left = asked.join(F.broadcast(long_), "_unit", "left").withColumn("_salt", salt).drop("_long")  # LONG_UNITS keys
    salts = F.when(F.col("_long"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    right = known.join(F.broadcast(long_), "_unit", "left").select("_unit", "id", F.explode(salts).alias("_salt"))
    told = left.join(right, ["_unit", "_salt"]).select(F.col("_group").alias("_asker"), "_unit", "id")
    schema = T.StructType([*df.schema.fields, T.StructField("_ids", T.ArrayType(T.IntegerType()))])
    coded = dealt.groupBy("_group").cogroup(told.groupBy("_asker")).applyInArrow(_code_group(key, sent), schema)
    none = F.array().cast("array<int>")
    lost = reduce(Column.__or__, [F.col(k).isNull() for k in key])
    rest = df.where(lost).withColumn("_ids", none)
    return coded.unionByName(rest).withColumn(out, ar.with_special(F.col("_ids"), bos, eos)).drop("_ids")


def compare_tokenizers(
    df: DataFrame, base: DataFrame, merged: DataFrame, col: str = "text", mode: str = "bpe",
    by: list[str] = (),
) -> DataFrame:
    """Tokens under both vocabularies per group: totals, means, byte-piece share."""
    both = tokenize(df, base, col, mode, bos=False, out="_base")
    both = tokenize(both, merged, col, mode, bos=False, out="_merged")
    low, high = FIRST_BYTE_ID, FIRST_BYTE_ID + 256

    def byte_count(ids):
        return F.size(F.filter(ids, lambda i: (i >= low) & (i < high)))

    sizes = both.select(
        *by,
        F.size("_base").alias("b"), F.size("_merged").alias("m"),
        byte_count("_base").alias("bb"), byte_count("_merged").alias("mb"),
    )
    return sizes.groupBy(*by).agg(
        F.count("*").alias("texts"),
        F.sum("b").alias("base_tokens"),
        F.sum("m").alias("merged_tokens"),
        F.avg("b").alias("base_mean"),
        F.avg("m").alias("merged_mean"),
        (F.sum("bb") / F.sum("b")).alias("base_byte_share"),
        (F.sum("mb") / F.sum("m")).alias("merged_byte_share"),
    )
