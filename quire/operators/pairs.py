"""Subword training by repeated pair merging (byte-pair encoding).

Only the table of distinct words is iterated, each word an array of symbol
numbers. Spark partitions, counts and stores it; within a task a batch of words
is one flat array, so a merge is a comparison and a shift.
"""

import base64
import ctypes
import heapq
import logging
import zlib

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions import text as tx
from ..session import cut_lineage, drop_stored, store
from .vocab import (
    FIRST_WORD_ID, SPECIAL_PIECES, UNKNOWN_CHAR, char_counts, char_coverage, reserved_pieces, within_bytes,
    word_counts,
)

# Fixed value: the longest piece learned.
MAX_PIECE_CHARS = 16
CHECKPOINT_MERGES, CHECKPOINT_ROUNDS = 512, 8
WATCHED_PAIRS = 20_000
# Symbols of the words that a round brings, and of how many pairs it asks for words.
MOST_SYMBOLS = 1 << 21
FIRST_REACH, MOST_REACH = 64, 4096
MOST_WAIT, FEW_MERGES = 8, 8
# Symbols up to which one task learns alone, as an exchange between tasks takes a second,
# and most that each of several holds (some 10 bytes each); pairs whose counts each of them keeps, merges made between
# two exchanges, pairs that a task sends at once.
ALONE, MOST_HELD = 1 << 26, 1 << 26
KEPT_PAIRS, BATCH_MERGES, SENT_PAIRS = 1 << 17, 256, 1 << 16
# How many reserved pieces come before the learned ones.
LAYOUTS = {"none": 0, "special": len(SPECIAL_PIECES), "bytes": FIRST_WORD_ID}
FIRST_MADE = 0x110000  # numbers below are code points, from here on made pieces

# Scripts whose letters never share a piece. Han and kana count as one.
SCRIPTS = [
    "Latin", "Han", "Cyrillic", "Greek", "Arabic", "Hebrew", "Hangul", "Thai", "Devanagari",
    "Bengali", "Tamil", "Telugu", "Georgian", "Armenian", "Common",
]


def script_runs(word: Column) -> Column:
    """Cut a word where the script changes; a leading space mark stays on."""
    named = "".join(rf"\p{{Is{s}}}" for s in SCRIPTS)
    kinds = [
        r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー\p{IsInherited}]+" if s == "Han"
        else rf"[\p{{Is{s}}}\p{{IsInherited}}&&[^{tx.SPACE_MARK}ー]]+"
        for s in SCRIPTS
    ]
    kinds.append(rf"[^{named}\p{{IsHiragana}}\p{{IsKatakana}}]+")
    pattern = f"({tx.SPACE_MARK}?(?:{'|'.join(kinds)})|{tx.SPACE_MARK})"
    return F.regexp_extract_all(word, F.lit(pattern), F.lit(1))


def start_symbols(words: DataFrame, split_scripts: bool = True) -> DataFrame:
    """(symbols, count): every word cut into single characters.

    Words are cut at unknown characters, which never join anything, and equal
    stretches are folded together.
    """
    known = F.flatten(
        F.transform(
            F.split(F.concat(F.lit(tx.SPACE_MARK), "word"), UNKNOWN_CHAR + "+"),
            lambda part: script_runs(part) if split_scripts else F.array(part),
        )
    )
    return (
        words.select(F.explode(known).alias("part"), "count")
        .where(F.length("part") > 1)
        .groupBy("part")
        .agg(F.sum("count").alias("count"))
        .select(tx.characters(F.col("part")).alias("symbols"), "count")
    )


def pair_counts(words: DataFrame) -> DataFrame:
    """(left, right, pair_count) of neighbouring symbols over (symbols, count)."""
    lefts = F.slice("symbols", 1, F.greatest(F.size("symbols") - 1, F.lit(0)))
    rights = F.slice("symbols", 2, F.size("symbols"))
    pairs = F.arrays_zip(lefts.alias("left"), rights.alias("right"))
    return (
        words.select(F.explode(pairs).alias("pair"), "count")
        .groupBy("pair.left", "pair.right")
        .agg(F.sum("count").alias("pair_count"))
    )


def _flat(symbols: pa.ListArray) -> np.ndarray:
    """All words of a batch in one array, -1 after each word."""
    values = symbols.flatten().to_numpy(zero_copy_only=False)
    sizes = symbols.value_lengths().to_numpy(zero_copy_only=False)
    flat = np.full(len(values) + len(sizes), -1, np.int32)
    flat[np.arange(len(values)) + np.repeat(np.arange(len(sizes)), sizes)] = values
    return flat


def _join(flat: np.ndarray, merges: list[tuple[int, int, int]]) -> np.ndarray:
    """Make (left, right, made) merges in order, leftmost first.

    A merge only makes pairs of later merges, so each word takes the earliest of
    its own pairs until none is left. All words do so at once, and only those
    that still hold one stay in hand: the work follows the merges made, not
    their number times the table."""
    if not merges or not len(flat):
        return flat.copy()
    left, right, made = np.array(merges, np.int64).T
    keys = (left << 32) | right
    order = np.argsort(keys, kind="stable")
    keys, after = keys[order], len(merges)
    sizes = _sizes(flat)

    def ranks(part):
        """Place in `merges` of each pair that begins here."""
        pairs = (part[:-1].astype(np.int64) << 32) | part[1:]
        at = np.minimum(np.searchsorted(keys, pairs), after - 1)
        return np.append(np.where(keys[at] == pairs, order[at], after), after)

    def first_hits(rank, part):
        """Each word's earliest pair."""
        heads = np.append(0, np.flatnonzero(part == -1)[:-1] + 1)
        return np.minimum.reduceat(rank, heads)

    part, word = flat, np.arange(len(sizes))
    rank = ranks(part)
    best = first_hits(rank, part)
    done, owners = [], []
    while True:
        open_ = best < after
        if not open_.all():
            lengths = _sizes(part) + 1
            shut = np.repeat(~open_, lengths)
            done.append(part[shut])
            owners.append(np.repeat(word[~open_], lengths[~open_]))
            part, rank, word, best = part[~shut], rank[~shut], word[open_], best[open_]
        if not len(word):
            break
        lengths = _sizes(part) + 1
        hit = np.flatnonzero(rank == np.repeat(best, lengths))
        # Of overlapping hits (equal symbols) take every other one.
        first = np.flatnonzero(np.diff(hit, prepend=-9) != 1)
        run = np.repeat(first, np.diff(first, append=len(hit)))
        twin = part[hit] == part[hit + 1]
        hit = hit[~twin | ((np.arange(len(hit)) - run) % 2 == 0)]
        part = part.copy()
        part[hit] = made[rank[hit]]
        part = np.delete(part, hit + 1)
        rank = ranks(part)
        best = first_hits(rank, part)
    done, owners = np.concatenate(done), np.concatenate(owners)
    return done[np.argsort(owners, kind="stable")]


def _sizes(flat: np.ndarray) -> np.ndarray:
    return np.diff(np.flatnonzero(flat == -1), prepend=-1) - 1


def _weighted_pairs(flat: np.ndarray, counts: np.ndarray):
    """Pairs as left * 2^32 + right, and the count of the word each is in."""
    left, right = flat[:-1], flat[1:]
    inside = (left >= 0) & (right >= 0)
    word = np.repeat(np.arange(len(counts)), _sizes(flat) + 1)[:-1]
    return (left[inside].astype(np.int64) << 32) | right[inside], counts[word[inside]]


def pair_changes(words: DataFrame, done: list, merges: list, floor: int, watched: np.ndarray) -> DataFrame:
    """How counts change when `merges` are made after `done`: of the `watched`
    pairs (left * 2^32 + right, sorted), and of new ones that exceed `floor`.

    The whole table is read and the merges not stored yet are made again; pairs
    are counted in the words that hold one of `merges` only.
    """
    newest = min(made for _, _, made in merges)

    def run(batches):
        for batch in batches:
            counts = batch.column(1).to_numpy(zero_copy_only=False)
            before = _join(_flat(batch.column(0)), done)
            after = _join(before, merges)
            hit = _sizes(before) != _sizes(after)
            keys, weights = [], []
            for flat, sign in ((before, -1), (after, 1)):
                kept = flat[np.repeat(hit, _sizes(flat) + 1)]
                pairs, count = _weighted_pairs(kept, counts[hit])
                keys.append(pairs)
                weights.append(sign * count)
            keys, weights = np.concatenate(keys), np.concatenate(weights)
            at = np.minimum(np.searchsorted(watched, keys), max(len(watched) - 1, 0))
            asked = (watched[at] == keys) if len(watched) else np.zeros(len(keys), bool)
            asked |= ((keys >> 32) >= newest) | ((keys & 0xFFFFFFFF) >= newest)
            keys, at = np.unique(keys[asked], return_inverse=True)
            change = np.zeros(len(keys), np.int64)
            np.add.at(change, at, weights[asked])
            yield pa.RecordBatch.from_arrays(
                [pa.array((keys >> 32).astype(np.int32)),
                 pa.array((keys & 0xFFFFFFFF).astype(np.int32)), pa.array(change)],
                names=["left", "right", "n"],
            )

    return (
        words.select("symbols", "count")
        .mapInArrow(run, "left int, right int, n bigint")
        .groupBy("left", "right")
        .agg(F.sum("n").alias("pair_count"))
        .where((F.col("pair_count") < 0) | (F.col("pair_count") > floor))
    )


def join_symbols(words: DataFrame, merges: list) -> DataFrame:
    """Words after the merges; words with nothing left to join are done."""
    if not merges:
        return words

    def run(batches):
        for batch in batches:
            flat = _join(_flat(batch.column(0)), merges)
            sizes = _sizes(flat)
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            symbols = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[flat >= 0]))
            out = pa.RecordBatch.from_arrays([symbols, batch.column(1)], names=["symbols", "count"])
            yield out.filter(pa.array(sizes > 1))

    return words.select("symbols", "count").mapInArrow(run, "symbols array<int>, count bigint")


def held_words(table: DataFrame, pending: list, wanted: np.ndarray, most: int) -> list | None:
    """The words that hold one of the `wanted` pairs (left * 2^32 + right,
    sorted) after the pending merges, as (flat symbols, counts) of each part of
    the table; None if they have more than `most` symbols.

    The whole table is opened where it lies; what leaves a task is the wanted
    words, and no more of them than its share of the bound allows."""
    share = -(-most // max(1, table.rdd.getNumPartitions()))

    def run(batches):
        room = 2 * share  # parts may be uneven
        for batch in batches:
            flat = _join(_flat(batch.column(0)), pending)
            counts = batch.column(1).to_numpy(zero_copy_only=False)
            keys = (flat[:-1].astype(np.int64) << 32) | flat[1:]
            at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
            found = (wanted[at] == keys) & (flat[:-1] >= 0) & (flat[1:] >= 0)
            sizes = _sizes(flat)
            word = np.repeat(np.arange(len(sizes)), sizes + 1)
            hit = np.zeros(len(sizes), bool)
            hit[word[:-1][found]] = True
            kept = flat[np.repeat(hit, sizes + 1)]
            room -= len(kept)
            if room < 0:
                yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([None], pa.binary())], ["symbols", "counts"])
                return
            if len(kept):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kept.astype("<i4").tobytes()]), pa.array([counts[hit].astype("<i8").tobytes()])], ["symbols", "counts"])

    parts, size = [], 0
    for row in table.select("symbols", "count").mapInArrow(run, "symbols binary, counts binary").collect():
        if row.symbols is None:
            return None
        parts.append((np.frombuffer(row.symbols, "<i4"), np.frombuffer(row["counts"], "<i8")))
        size += len(parts[-1][0])
    return parts if size <= most else None


def held_segments(table: DataFrame, pending: list, wanted: np.ndarray, most: int) -> list | None:
    """The words after the pending merges, cut between symbols that are no
    `wanted` pair (left * 2^32 + right, sorted), equal segments folded, as (flat
    symbols, counts) of each part; None if they have more than `most` symbols."""

    def cut(batches):
        for batch in batches:
            flat = _join(_flat(batch.column(0)), pending)
            counts = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), _sizes(flat) + 1)
            keys = (flat[:-1].astype(np.int64) << 32) | flat[1:]
            at = np.minimum(np.searchsorted(wanted, keys), len(wanted) - 1)
            tied = np.append((wanted[at] == keys) & (flat[:-1] >= 0) & (flat[1:] >= 0), False)
            heads = np.flatnonzero(tied & ~np.append(False, tied[:-1]))
            kept = tied | np.append(False, tied[:-1])
            ends = np.flatnonzero(kept & ~tied) + 1
            offsets = np.append(0, np.cumsum(ends - heads)).astype(np.int32)
            symbols = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[kept], pa.int32()))
            yield pa.RecordBatch.from_arrays([symbols, pa.array(counts[heads], pa.int64())], names=["symbols", "count"])

    def pack(batches):
        for batch in batches:
            flat, counts = _flat(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array([flat.astype("<i4").tobytes()]), pa.array([counts.astype("<i8").tobytes()])], ["symbols", "counts"])

    cuts = table.select("symbols", "count").mapInArrow(cut, "symbols array<int>, count bigint")
    folded, path = store(cuts.groupBy("symbols").agg(F.sum("count").alias("count")), "segments")
    size, parts = folded.select(F.sum(F.size("symbols") + 1)).first()[0] or 0, None
    if size <= most:
        rows = folded.select("symbols", "count").mapInArrow(pack, "symbols binary, counts binary").collect()
        parts = [(np.frombuffer(r.symbols, "<i4"), np.frombuffer(r["counts"], "<i8")) for r in rows]
    drop_stored(table.sparkSession, path)
    return parts


class _Replay:
    """Merges among the words that hold one of the wanted pairs.

    All words with a wanted pair, or with a pair made here, are at hand, so
    their counts stay exact, and so do those of other pairs that these words
    hold. Only when another pair turns out best must more words be opened.
    """

    def __init__(self, parts, wanted: set, counts: dict, floor: int, names: dict, made: set, longest: int):
        self.counts, self.floor, self.names, self.made, self.longest = counts, floor, names, made, longest
        self.wanted, self.words, self.weight, self.holders = wanted, [], [], {}
        for flat, weights in parts:
            for word in np.split(flat, np.flatnonzero(flat == -1) + 1)[:-1]:
                self.words.append(word[:-1].tolist())
            self.weight += weights.tolist()
        for at, word in enumerate(self.words):
            for pair in set(zip(word, word[1:])) & wanted:
                self.holders.setdefault(pair, set()).add(at)
        self.heap = [(*self._order(p), p) for p, n in counts.items() if n > floor]
        heapq.heapify(self.heap)

    def _order(self, pair):
        """Best first: count, then shorter piece, then its text, then shorter left."""
        left, right = self.names[pair[0]], self.names[pair[1]]
        return -self.counts[pair], len(left + right), left + right, len(left)

    def best(self):
        """The best pair whose piece is new; None if it lies elsewhere or none is left."""
        while self.heap:
            count, _, piece, _, pair = self.heap[0]
            if self.counts.get(pair) != -count or -count <= self.floor or piece in self.made:
                heapq.heappop(self.heap)
                continue
            return pair if pair in self.wanted else None
        return None

    def merge(self, pair, symbol: int) -> None:
        """Join `pair` to `symbol` in its words; all counts follow."""
        change, touched = {}, {}
        for at in self.holders.pop(pair, ()):
            old, weight = self.words[at], self.weight[at]
            new, i = [], 0
            while i < len(old):
                if i + 1 < len(old) and (old[i], old[i + 1]) == pair:
                    new.append(symbol)
                    i += 2
                else:
                    new.append(old[i])
                    i += 1
            if len(new) == len(old):
                continue
            for p in zip(old, old[1:]):
                change[p] = change.get(p, 0) - weight
            for p in zip(new, new[1:]):
                change[p] = change.get(p, 0) + weight
                if symbol in p:
                    touched.setdefault(p, set()).add(at)
            self.words[at] = new
        for p, n in change.items():
            if not n:
                continue
            if p in self.counts:
                self.counts[p] += n
            elif n > self.floor and symbol in p and len(self.names[p[0]] + self.names[p[1]]) <= self.longest:
                self.counts[p] = n
                self.wanted.add(p)
                self.holders[p] = touched[p]
            else:
                continue
            if self.counts[p] > self.floor:
                heapq.heappush(self.heap, (*self._order(p), p))


class _Cells:
    """The words of one task, a cell for each character and 0 around each word.

    A symbol's number stands in its first and in its last cell, so its neighbours
    are found from its place and its length; cells inside hold `inside`. `places` has
    where each symbol began when it was made; those that are part of another since are
    left out when they are next read. Letters are numbered from 1, made symbols from
    `first`, so that cells are of two bytes where that suffices."""

    def __init__(self, batches, merges: int, tasks=None):
        """`batches` of words and their counts, as Arrow arrays."""
        number, known, parts = np.zeros(0x110000, np.int32), [], []
        sizes, counts = [np.zeros(1, np.int64)], [np.zeros(0, np.int64)]
        for words, n in batches:
            texts = words.to_pylist()
            size = np.fromiter((len(t) for t in texts), np.int64, len(texts))
            points = np.frombuffer("".join(texts).encode("utf-32-le"), "<i4")
            new = np.unique(points[number[points] == 0])
            number[new] = len(known) + 1 + np.arange(len(new))
            known += new.tolist()
            kind = np.uint16 if len(known) + merges < 65_000 else np.uint32
            part = np.zeros(len(points) + len(texts), kind)
            inside = np.ones(len(part), bool)
            inside[np.cumsum(size + 1) - 1] = False
            part[inside] = number[points]
            parts.append(part)
            sizes.append(size + 1)
            counts.append(n.to_numpy(zero_copy_only=False))
        own = np.array(known, np.int64)
        self.letters = _exchange(tasks, own, np.ones(len(own), np.int64))[0]
        self.first = len(self.letters) + 1
        kind = np.uint16 if self.first + merges < 65_000 else np.uint32
        self.inside = np.iinfo(kind).max
        renumbered = np.append(0, np.searchsorted(self.letters, own) + 1).astype(kind)
        self.cells = np.zeros(1 + sum(map(len, parts)), kind)
        at = 1
        for i, part in enumerate(parts):
            self.cells[at : at + len(part)] = renumbered[part]
            at, parts[i] = at + len(part), None
        self.borders, self.counts, self.places = np.cumsum(np.concatenate(sizes)), np.concatenate(counts), {}
        found: list = [[] for _ in range(self.first)]
        for at in range(0, len(self.cells), 1 << 22):
            part = self.cells[at : at + (1 << 22)]
            ends = np.cumsum(np.bincount(part, minlength=self.first))
            order = np.argsort(part, kind="stable").astype(np.int32) + np.int32(at)
            for n in range(1, self.first):
                found[n].append(order[ends[n - 1] : ends[n]].copy())
        for n in range(1, self.first):
            self.places[n], found[n] = np.concatenate([np.zeros(0, np.int32), *found[n]]), None

    def _where(self, symbol):
        at = self.places.get(symbol)
        if at is None:
            return np.zeros(0, np.int32)
        valid = self.cells[at] == symbol
        if not valid.all():
            at = self.places[symbol] = at[valid]
        return at

    def _pairs(self, heads):
        return (self.cells[heads - 1].astype(np.int64) << 32) | self.cells[heads]

    def _tally(self, heads) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose right symbols begin at `heads`, and their words' counts."""
        parts = []
        for at in range(0, max(len(heads), 1), SENT_PAIRS):
            part = heads[at : at + SENT_PAIRS]
            keys, weight = self._pairs(part), self.counts[np.searchsorted(self.borders, part, side="right") - 1]
            parts.append(_summed(keys, weight) if len(heads) > SENT_PAIRS else (keys, weight))
        return parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts))

    def merge(self, pair, made: int, lengths) -> tuple[np.ndarray, np.ndarray]:
        """Join `pair` to `made`, leftmost first; the pairs (left * 2^32 + right)
        whose counts change, and by how much."""
        (a, b), cells = pair, self.cells
        before, size = int(lengths[a]), int(lengths[a] + lengths[b])
        left, right = self._where(a), self._where(b)
        if len(left) <= len(right):
            at = left[cells[left + before] == b]
        else:
            at = right[cells[right - 1] == a] - before
        if a == b and len(at):  # of overlapping ones take every other one
            first = np.flatnonzero(np.diff(at, prepend=-99) != before)
            run = np.repeat(first, np.diff(first, append=len(at)))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        apart = np.append(at[1:] - at[:-1] != size, True)
        heads = np.concatenate([at, at[apart] + size])
        heads = heads[(cells[heads - 1] > 0) & (cells[heads] > 0)]
        gone, less = self._tally(heads)
        cells[at + (before - 1)] = self.inside
        cells[at + before] = self.inside
        cells[at] = made
        cells[at + (size - 1)] = made
        self.places[made] = at
        come, more = self._tally(heads)
        return np.concatenate([gone, come]), np.concatenate([-less, more])

    def all_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs with their counts, sorted by pair."""
        sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for at in range(0, len(self.borders) - 1, SENT_PAIRS):
            start, stop = self.borders[at], self.borders[min(at + SENT_PAIRS, len(self.borders) - 1)]
            part = self.cells[start : stop + 1]
            part = np.flatnonzero(part != self.inside) + start
            # A symbol of more than one character stands in two of these cells.
            ids = self.cells[part]
            twice = np.append(False, (ids[1:] == ids[:-1]) & (ids[1:] >= self.first))
            if twice.any():
                runs = np.flatnonzero(~twice)
                run = np.repeat(runs, np.diff(runs, append=len(ids)))
                twice = (np.arange(len(ids)) - run) % 2 == 1
            heads = part[~twice]
            heads = heads[(heads > start) & (self.cells[heads] > 0)]
            heads = heads[self.cells[heads - 1] > 0]
            weight = self.counts[np.searchsorted(self.borders, heads, side="right") - 1]
            sums = _summed(np.append(sums[0], self._pairs(heads)), np.append(sums[1], weight))
        return sums


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[first], np.add.reduceat(values, first)


def _exchange(tasks, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sums over all tasks, which each of them gets."""
    if tasks is None:
        return _summed(keys, values)
    keys, values = _summed(keys, values)
    own = base64.b64encode(zlib.compress(keys.astype("<i8").tobytes() + values.astype("<i8").tobytes(), 1)).decode()
    told = [np.frombuffer(zlib.decompress(base64.b64decode(m)), "<i8") for m in tasks.allGather(own)]
    return _summed(np.concatenate([t[: len(t) // 2] for t in told]), np.concatenate([t[len(t) // 2 :] for t in told]))


class _Watch:
    """Counts of the commonest pairs, the same in all tasks, and what is learned.

    Counts never grow, so the queue holds each pair once, by a count that may be
    too high, which is put right when it comes up. Pairs that aren't kept have
    counts of at most `floor`."""

    def __init__(self, letters, merges: int, made: set, longest: int, watched: int):
        self.merges, self.made, self.longest, self.watched = merges, set(made), longest, watched
        self.names, self.first = ["", *map(chr, letters.tolist())], len(letters) + 1
        self.learned, self.counts, self.queue, self.floor = [], {}, [], 0
        # Pairs whose piece exists, which are never taken, by their left and right symbol.
        self.starts, self.ends = {}, {}
        self.lengths = np.ones(self.first + merges, np.int64)

    def order(self, key: int, count: int) -> tuple:
        left, right = self.names[key >> 32], self.names[key & 0xFFFFFFFF]
        return -count, len(left) + len(right), left + right, len(left), key

    def short(self, keys: np.ndarray) -> np.ndarray:
        return self.lengths[keys >> 32] + self.lengths[keys & 0xFFFFFFFF] <= self.longest

    def begin(self, slices) -> None:
        """Counts of all pairs, in parts; the commonest are kept."""
        keys, values, self.floor, best = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, None
        for k, v in slices:
            fit = self.short(k) & (v > self.floor)
            keys, values = np.append(keys, k[fit]), np.append(values, v[fit])
            top = int(v[fit].max(initial=0))
            ties = k[fit & (v == top)].tolist() if top and (best is None or top >= -best[0]) else []
            orders = [o for o in (self.order(x, top) for x in ties) if o[2] not in self.made]
            if not orders and top and (best is None or top >= -best[0]):  # pieces that exist: look below
                orders = [o for o in (self.order(x, n) for x, n in zip(k[fit].tolist(), v[fit].tolist())) if o[2] not in self.made]
            best = min([*orders, *([best] if best else [])], default=None)
            if len(keys) > self.watched:
                self.floor = max(self.floor, int(np.partition(values, -self.watched)[-self.watched]))
                keys, values = keys[values > self.floor], values[values > self.floor]
        self.counts = dict(zip(keys.tolist(), values.tolist()))
        if best is not None and -best[0] <= self.floor:  # as common as others that aren't kept: it stands alone
            self.counts[best[4]], self.floor = -best[0], -best[0] - 1
            self.alone = True
        else:
            self.alone = False
        self.starts, self.ends = {}, {}
        self.queue = [self.order(k, n) for k, n in self.counts.items()]
        heapq.heapify(self.queue)

    def _bar(self, key):
        self.starts.setdefault(key >> 32, set()).add(key)
        self.ends.setdefault(key & 0xFFFFFFFF, set()).add(key)

    def batch(self, room: int) -> list:
        """The leading pairs that one-at-a-time merging would also take next.

        Joining (a, b) changes only counts of pairs that end in a or start with b,
        and a new pair is never commoner than one of those; its piece is longer.
        So pairs are taken until one of them comes up, or one that a new pair could
        come before."""
        chosen, lefts, rights, pieces, bound, least = [], set(), set(), set(), 0, 0
        last = self.floor
        while self.queue:
            entry = self.queue[0]
            key, count = entry[4], self.counts.get(entry[4], 0)
            if count <= self.floor:
                heapq.heappop(self.queue)
                continue
            if count != -entry[0]:
                heapq.heapreplace(self.queue, (-count, *entry[1:]))
                continue
            left, right = key >> 32, key & 0xFFFFFFFF
            if entry[2] in self.made or entry[2] in pieces:
                heapq.heappop(self.queue)
                self._bar(key)
                if right in lefts or left in rights:
                    bound = max(bound, count)
                continue
            if len(chosen) == room or right in lefts or left in rights or count < bound or count == bound and entry[1] > least:
                last = count
                break
            heapq.heappop(self.queue)
            chosen.append(entry)
            lefts.add(left)
            rights.add(right)
            pieces.add(entry[2])
            least = min(least or entry[1], entry[1])
            near = [self.counts.get(k, 0) for k in (*self.ends.get(left, ()), *self.starts.get(right, ()))]
            bound = max(bound, min(count, max(near, default=0)), count if left == right else 0)
            if self.alone:
                break
        least = 0
        for i, entry in enumerate(chosen):
            if i and -entry[0] <= last and entry[1] > least:
                for e in chosen[i:]:
                    heapq.heappush(self.queue, e)
                return chosen[:i]
            least = min(least or entry[1], entry[1])
        return chosen

    def note(self, entry) -> tuple:
        """A pair is taken; its piece gets the next number."""
        key, made = entry[4], len(self.names)
        left, right = key >> 32, key & 0xFFFFFFFF
        self.learned.append((self.names[left], self.names[right], -entry[0]))
        self.names.append(entry[2])
        self.lengths[made] = entry[1]
        self.made.add(entry[2])
        self.counts.pop(key, None)
        return (left, right), made

    def change(self, keys: np.ndarray, values: np.ndarray, newest: int) -> None:
        """Counts change by `values`; pairs with symbols from `newest` on are new."""
        new = ((keys >> 32) >= newest) | ((keys & 0xFFFFFFFF) >= newest)
        for k, v in zip(keys[~new].tolist(), values[~new].tolist()):
            if k in self.counts:
                self.counts[k] += v
        fit = new & (values > self.floor)
        for k, v in zip(keys[fit].tolist(), values[fit].tolist()):
            self.counts[k] = v
            heapq.heappush(self.queue, self.order(k, v))
        if len(self.counts) > 2 * max(self.watched, self.merges):
            some = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            self.floor = max(self.floor, int(np.partition(some, -self.watched)[-self.watched]))
            self.counts = {k: n for k, n in self.counts.items() if n > self.floor}
            self.queue = [e for e in self.queue if e[4] in self.counts]
            heapq.heapify(self.queue)


def _learn(cells: _Cells, watch: _Watch, tasks) -> int:
    """Merges until there are enough or none is left; how many exchanges it took."""
    exchanges = 0

    def recount():
        keys, values = cells.all_pairs()
        most = _exchange(tasks, np.zeros(1, np.int64), np.array([len(keys)]))[1][0]
        parts = -(-int(most) // SENT_PAIRS) if tasks else 1
        for part in range(max(parts, 1)):
            own = (keys ^ (keys >> 32)) % max(parts, 1) == part
            yield _exchange(tasks, keys[own], values[own])

    watch.begin(recount())
    while len(watch.learned) < watch.merges:
        chosen = watch.batch(min(BATCH_MERGES, watch.merges - len(watch.learned)))
        if not chosen:
            if not watch.floor:
                break
            watch.begin(recount())
            chosen = watch.batch(min(BATCH_MERGES, watch.merges - len(watch.learned)))
            if not chosen:
                break
        newest, changes = len(watch.names), []
        for entry in chosen:
            changes.append(cells.merge(*watch.note(entry), watch.lengths))
        keys, values = (np.concatenate(x) for x in zip(*changes))
        fit = watch.short(keys)
        watch.change(*_exchange(tasks, keys[fit], values[fit]), newest)
        exchanges += 1
        if watch.alone:
            watch.begin(recount())
    return exchanges


def _slots(spark: SparkSession) -> int:
    """Tasks that run at once; 0 where stages whose tasks wait for one another can't."""
    if spark.conf.get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    context = spark.sparkContext._jsc.sc()
    return context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())


def _give_back() -> None:
    """Return what this worker has freed to the system: it is kept for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def learn_among_tasks(words: DataFrame, merges: int, made: set, longest: int, watched: int, tasks: int) -> list:
    """The merges of `words` (word, count), which `tasks` tasks hold in memory.

    Each task has its share of the words and makes every merge there at once where
    its pair stands. Tasks tell one another how counts change and each keeps the same
    counts of the commonest pairs, so all choose the same merges, a batch between two
    exchanges (`_Watch.batch`), each exactly the next one."""
    made = sorted(made)

    def run(batches):
        context = BarrierTaskContext.get() if tasks > 1 else None
        cells = _Cells(((b.column(0), b.column(1)) for b in batches), merges, context)
        watch = _Watch(cells.letters, merges, made, longest, watched)
        exchanges, learned = _learn(cells, watch, context), watch.learned
        del cells, watch
        _give_back()
        if context is None or context.partitionId() == 0:
            columns = list(zip(*learned)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64()),
                 pa.array(range(len(learned)), pa.int64()), pa.array([exchanges] * len(learned), pa.int64())],
                ["left", "right", "n", "at", "exchanges"])

    dealt = words.coalesce(1) if tasks == 1 else words.repartition(tasks, "word")
    rows = dealt.mapInArrow(run, "left string, right string, n bigint, at bigint, exchanges bigint", barrier=tasks > 1).collect()
    rows.sort(key=lambda r: r["at"])
    logging.getLogger(__name__).info(
        "%d merges by %d tasks in %d rounds", len(rows), tasks, 1 if tasks == 1 or not rows else rows[0].exchanges)
    return [((r.left, r.right), r.n) for r in rows]


def _order(pair):
    """Best pair first: count, then shorter piece, then its text, then shorter left."""
    (left, right), count = pair
    return -count, len(left + right), left + right, len(left)


def ranked(pairs: DataFrame, limit: int, max_piece_chars: int = MAX_PIECE_CHARS) -> list:
    """The best `limit` pairs as ((left, right), count)."""
    piece = F.concat("left", "right")
    rows = (
        pairs.where(F.length(piece) <= max_piece_chars)
        .orderBy(F.desc("pair_count"), F.length(piece), piece, F.length("left"))
        .limit(limit)
        .collect()
    )
    return [((r.left, r.right), r.pair_count) for r in rows]


def safe_merges(best: list, made: set, room: int) -> list:
    """The leading pairs that one-at-a-time merging would also take next.

    Joining (a, b) changes only counts of pairs that end in a or start with b,
    and a new pair is never commoner than one of those. So as long as chosen
    pairs are not neighbours of one another, and are strictly commoner than the
    first pair left out, taking them together changes nothing. Pairs whose
    piece exists already are never taken, but count as neighbours.
    """
    chosen, barred, floor = [], [], 0
    for (left, right), count in best:
        taken = left + right in made or any(left + right == a + b for (a, b), _ in chosen)
        near = chosen if taken else chosen + barred
        if any(a == right or b == left for (a, b), _ in near) or len(chosen) == room:
            floor = count
            break
        if taken:
            barred.append(((left, right), count))
            continue
        chosen.append(((left, right), count))
        if left == right:  # its own neighbour: nothing may follow
            floor = count
            break
    else:
        floor = best[-1][1] if best else 0
    return [c for i, c in enumerate(chosen) if i == 0 or c[1] > floor]


def cover_words(words: DataFrame, rare: list[str]) -> DataFrame:
    """Put the unknown mark in place of `rare` characters, those outside the coverage."""
    if not rare:
        return words
    covered = F.translate("word", "".join(rare), UNKNOWN_CHAR * len(rare))
    return words.select(covered.alias("word"), "count")


def learn_merges(
    words: DataFrame,
    merges: int,
    made: set = frozenset(),
    max_piece_chars: int = MAX_PIECE_CHARS,
    per_round: int = 64,
    watched: int | None = None,
    most_symbols: int = MOST_SYMBOLS,
    most_held: int = MOST_HELD,
) -> list[tuple[tuple[str, str], int]]:
    """Up to `merges` of ((left, right), count), in the order they are learned.

    Takes (symbols, count) with single characters as symbols. Where the tasks that
    run at once can hold all words (`most_held` symbols each), they learn together
    (`learn_among_tasks`). Where they can't, or can't wait for one another, a round
    is a job, as follows.

    The driver watches the commonest pairs only. A pair's count never grows after the merge that
    creates it, so pairs outside the watched ones stay at or below `floor`, and
    watching is exact until the best one sinks to it.

    Each round is one job over the word table. Where the words that hold the
    best `reach` pairs are few (`MOST_SYMBOLS`), the round brings them and makes
    merges until the best pair is one whose words aren't there: hundreds of
    merges, each exactly the next one. Where they are many, words are cut where a
    pair stands that is no commoner than the merges of this round: a pair across
    the cut never gets commoner than the pair there, so the segments, most of them
    equal, give the same merges; all pairs are counted again after them. Where
    segments too are many, a round takes the merges that don't touch one another
    and brings the changes of counts only; words are then asked for again after 1, 2, 4, ... `MOST_WAIT` such rounds, as
    they are when many words gave fewer than `FEW_MERGES`.
    `reach` follows the size of what came. The word table is stored in the
    shared folder every `CHECKPOINT_MERGES` merges or `CHECKPOINT_ROUNDS` rounds.
    """
    spark = words.sparkSession
    words = words.select(F.array_join("symbols", "").alias("word"), F.col("count").cast("bigint").alias("count"))
    # Sized while they are written, not by reading them again.
    measured = Observation()
    words, kept = store(words.observe(measured, F.sum(F.length("word") + 1).alias("symbols")), "words")
    size = measured.get.get("symbols") or 0
    tasks = 1 if size <= min(ALONE, most_held) else _slots(spark)
    if size <= tasks * most_held:
        learned = learn_among_tasks(words, merges, set(made), max_piece_chars, watched or KEPT_PAIRS, tasks)
        drop_stored(spark, kept)
        return learned
    watched = watched or WATCHED_PAIRS
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbers = F.transform(tx.characters(F.col("word")), lambda c: F.ascii(c))  # code point
    table = words.select(numbers.alias("symbols"), "count")
    table = table.repartition(max(width, spark.sparkContext.defaultParallelism))
    table, path = _keep(table)
    drop_stored(spark, kept)
    letters = table.select(F.explode("symbols").alias("n")).distinct().collect()  # <= Unicode
    names = {r.n: chr(r.n) for r in letters}
    number = {piece: n for n, piece in names.items()}
    made, learned, pending, counts, floor = set(made) | set(number), [], [], {}, 0
    rounds, kept_at, reach = 0, 0, FIRST_REACH
    span = 0  # of how many pairs segments are made
    wait, skip = 0, 1  # rounds until words are asked for again, and after a vain one

    def all_pairs():
        known = spark.createDataFrame(list(names.items()), "n int, piece string")
        known = F.broadcast(known)  # letters and made pieces: Unicode and vocabulary size
        pairs = pair_counts(table)
        for side in ("left", "right"):
            pairs = pairs.join(known.withColumnsRenamed({"n": side, "piece": f"{side}_piece"}), side)
        return pairs.select(
            F.col("left_piece").alias("left"), F.col("right_piece").alias("right"), "pair_count"
        )

    def note(pair, count):
        """A pair of numbers is taken; its piece gets the next number."""
        piece = names[pair[0]] + names[pair[1]]
        number[piece] = FIRST_MADE + len(learned)
        names[number[piece]] = piece
        learned.append(((names[pair[0]], names[pair[1]]), count))
        made.add(piece)
        pending.append((*pair, number[piece]))
        return number[piece]

    while len(learned) < merges:
        room = min(per_round, merges - len(learned))
        above = [((names[a], names[b]), n) for (a, b), n in counts.items() if n > floor and names[a] + names[b] not in made]
        best = heapq.nsmallest(max(reach, per_round * 4), above, key=_order)
        if not best:
            (table, path), pending = _keep(join_symbols(table, pending), table, path), []
            above = ranked(all_pairs(), watched, max_piece_chars)
            counts = {(number[a], number[b]): n for (a, b), n in above}
            floor = above[-1][1] if len(above) == watched else 0
            best = [p for p in above if p[0][0] + p[0][1] not in made and p[1] > floor]
        if not best:  # everything watched is a piece already, or as common as what isn't watched
            best = ranked(_without(all_pairs(), made), 1, max_piece_chars)
            counts |= {(number[a], number[b]): n for (a, b), n in best}
        if not best:
            break
        rounds += 1
        wanted = {(number[a], number[b]) for (a, b), _ in best[:reach]}
        keys = np.sort(np.array([(a << 32) | b for a, b in wanted], np.int64))
        parts = held_words(table, pending, keys, most_symbols) if wait <= 0 else None
        if parts is not None:
            had = len(learned)
            came = sum(len(flat) for flat, _ in parts)
            # A best pair at the floor stands alone: it is one merge.
            replay = _Replay(parts, wanted, counts, min(floor, best[0][1] - 1), names, made, max_piece_chars)
            while len(learned) < merges:
                pair = replay.best()
                if pair is None:
                    break
                replay.merge(pair, note(pair, counts[pair]))
                if counts[pair] > 0:  # overlapping ones are left
                    counts[pair] = 0
                if replay.floor < floor:
                    break
            reach = max(1, min(MOST_REACH, 2 * reach, reach * most_symbols // (2 * max(came, 1))))
            if len(learned) - had < FEW_MERGES and came > most_symbols // 16:
                wait, skip = skip, min(2 * skip, MOST_WAIT)  # many words for few merges
            else:
                skip = 1
        else:
            if wait <= 0:
                reach = max(1, reach // 4)
                wait, skip = skip, min(2 * skip, MOST_WAIT)
            else:
                wait -= 1
            span, done = span or 4 * merges, len(learned)
            while span >= FEW_MERGES:
                ranks = sorted((n for n in counts.values() if n > floor), reverse=True)
                cut = max(floor, ranks[span] if span < len(ranks) else 0)
                some = {p: n for p, n in counts.items() if n > cut}
                if best[0][1] <= cut:
                    break
                keys = np.sort(np.array([(a << 32) | b for a, b in some], np.int64))
                parts = held_segments(table, pending, keys, most_symbols)
                if parts is None:
                    span //= 4
                    continue
                replay = _Replay(parts, set(some), some, cut, names, made, max_piece_chars)
                while len(learned) < merges and (pair := replay.best()) is not None:
                    replay.merge(pair, note(pair, some[pair]))
                    if some[pair] > 0:  # overlapping ones are left
                        some[pair] = 0
                break
            if len(learned) > done:
                counts, kept_at = {}, rounds  # counted again, and the table stored
                continue
            every = [((names[a], names[b]), n) for (a, b), n in counts.items() if n > floor]
            fresh = safe_merges(heapq.nsmallest(per_round * 4, every, key=_order), made, room) or best[:1]
            asked = np.sort(np.array([(a << 32) | b for a, b in counts], np.int64))
            before = list(pending)
            chosen = [(number[a], number[b], note((number[a], number[b]), n)) for (a, b), n in fresh]
            # Watched pairs and new ones above the floor: some WATCHED_PAIRS rows.
            for r in pair_changes(table, before, chosen, floor, asked).collect():
                pair = r.left, r.right
                if pair in counts:
                    counts[pair] += r.pair_count
                elif r.pair_count > 0 and len(names[r.left] + names[r.right]) <= max_piece_chars:
                    counts[pair] = r.pair_count
        counts = {p: n for p, n in counts.items() if n > 0}
        if len(pending) >= CHECKPOINT_MERGES or rounds - kept_at >= CHECKPOINT_ROUNDS:
            (table, path), pending = _keep(join_symbols(table, pending), table, path), []
            kept_at = rounds
    table.unpersist()
    drop_stored(spark, path)
    logging.getLogger(__name__).info("%d merges in %d rounds", len(learned), rounds)
    return learned


def _keep(table: DataFrame, before: DataFrame | None = None, path: str | None = None):
    """Store the table in the shared folder in place of the one before, and
    cache it: rounds read memory, and a lost executor's part is read again."""
    stored, new = store(table, "words")
    if before is not None:
        before.unpersist()
        drop_stored(table.sparkSession, path)
    return stored.persist(), new


def _without(pairs: DataFrame, made: set) -> DataFrame:
    spark = pairs.sparkSession
    known = spark.createDataFrame([(p,) for p in made], "piece string")  # at most vocab_size
    return pairs.join(
        F.broadcast(known), F.concat("left", "right") == F.col("piece"), "left_anti"
    )


def sentence_words(sentences: DataFrame, max_bytes: int = 6000, col: str = "sentence", normalize: bool = True) -> DataFrame:
    """(word, count) of the sentences that training reads."""
    if normalize:
        sentences = sentences.withColumn(col, tx.compatible(F.col(col)))
    return word_counts(within_bytes(sentences, max_bytes, col), col)


def train_bpe(
    sentences: DataFrame,
    vocab_size: int = 30000,
    coverage: float = 0.9995,
    max_bytes: int = 6000,
    col: str = "sentence",
    split_scripts: bool = True,
    max_piece_chars: int = MAX_PIECE_CHARS,
    layout: str = "special",
    normalize: bool = True,
    words: DataFrame | None = None,
) -> DataFrame:
    """Learn a vocabulary: reserved pieces, merges in order, then characters.

    `layout` says which pieces come first: `special` the three special ones,
    `bytes` these and the 256 byte pieces, `none` no others. Texts are brought to
    compatible forms first unless `normalize` is off. Scores are minus the rank
    among learned pieces. No piece is longer than `max_piece_chars`, which is
    also the usual trainer's limit. `words` are the `sentence_words` of these
    sentences, where they are stored already.
    """
    spark = sentences.sparkSession
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {sorted(LAYOUTS)}")
    if words is None:
        words = cut_lineage(sentence_words(sentences, max_bytes, col, normalize))
    # All characters come at once, so the words are read for them once.
    chars = char_coverage(char_counts(words), coverage).orderBy(F.desc("count"), "char").collect()  # <= Unicode
    alphabet, rare = ([r.char for r in chars if r.kept == kept] for kept in (True, False))
    head = LAYOUTS[layout]
    merges = max(0, vocab_size - head - len(alphabet))
    table = start_symbols(cover_words(words, rare), split_scripts)
    learned = learn_merges(table, merges, set(alphabet), max_piece_chars)
    pieces = [left + right for (left, right), _ in learned] + alphabet
    rows = [(head + i, p, -float(i), "trained") for i, p in enumerate(pieces)]
    trained = spark.createDataFrame(rows, "id int, piece string, score double, origin string")
    return reserved_pieces(spark).where(F.col("id") < head).unionByName(trained)
