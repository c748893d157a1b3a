"""Scores of texts under a hashed maximum-entropy model of words.

A word is predicted in two steps: its class given the words before it, and the
word given its class (class-factored softmax). Classes are a hash of a word's
last bytes, so every word, seen or not, has one. The first step is a maximum-
entropy model over hashed features of the history: the word before (n-gram),
the two words before together (n-gram), and the word before that alone (skip).
The second step is the word's share of its class's tokens, smoothed like the
base, with one share for all unseen words of the class.

Features see the history only through its hash. The slots of the word before
grow in number with the text (`NEAR_BYTES` of text each), the corpus enters
training as counts of (slot, slot of the word before that, class), and these are
dealt over buckets of slots like the words are. Training has two steps. The
weights that all histories share (of a class, of the word before that, and of
`NEAR` coarse slots of the word before, a mean for their fine ones) are found on
a table of fixed size, with a Spark job for each round: tasks hold parts of it
and return the gradient over their part; each weight's step is its gradient over
its curvature. Then each bucket finds the weights of its own fine slots, alone
and together with the word before that, by as many rounds of the same steps; no
other bucket has a say in them, so they never travel. Every training token
counts in every round. A bucket answers with the shares of the (history, class)
pairs that the groups hold.

Word counts grow with the corpus and never meet in one place. A group of
documents (a share of the ids' hash) asks for each distinct word that it holds
once, in the bucket of the word's hash; the bucket adds up what the groups
count and answers every group with packed numbers, in the order asked. Groups and buckets grow in
number with the text, and a very common word is one entry for each group.

Words are told apart by 64 bits of hash.

Defined cases: a null or empty text is one end token; repeated rows count each
time; rows without doc_id are scored and count as training rows (they have no
remainder that is 0); with no training rows every token is unknown; very long
texts are one row of their group; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, drop_stored, store
from .substrings import _by, _heads, _planes, _undeltas, _unplanes, _deltas
from .tables import buckets_for, text_bytes
from .words import NON_SPACE, Words, mix, slices, tidy, tidy_group

CLASSES = 256
#: Coarse hash slots of the word before, and those of the word before that.
NEAR, FAR = 1 << 10, 1 << 5
#: Text for each fine slot of the word before.
NEAR_BYTES = 24 << 10
ROUNDS = 24
#: Precision of the Gaussian prior on each weight.
PRIOR = 12.0
#: Text of one group of documents.
GROUP_BYTES = 8 << 20
#: Text of a group that is cut into words at once.
SLICE_BYTES = 1 << 20
#: Parts of the coarse table: tasks of a training round.
PARTS = 16
#: Slots that are trained at once: 0.5 MB an array.
SLOTS_AT_ONCE = 16
SMOOTH = 0.1
END = np.uint64(0x1D5C3A7E9B2F4681)
START = np.uint64(0x7F4A9C1E2B6D8035)


class Tokens:
    """Word hashes of the texts with an end token each, their classes and the
    hashed histories."""

    def __init__(self, column: pa.Array):
        words = Words(column, NON_SPACE, lower=True)
        n = words.counts()
        self.n = n + 1
        self.first = np.concatenate([[0], np.cumsum(self.n)])
        ends = self.first[1:] - 1
        inner = np.ones(self.first[-1], bool)
        inner[ends] = False
        self.h = np.full(self.first[-1], END)
        self.h[inner] = words.hashes()
        tails = np.zeros(self.first[-1], np.uint64)
        if len(words):
            size = np.minimum(words.ends - words.starts, 3)
            padded = np.concatenate([np.zeros(3, np.uint8), words.data])
            at = words.ends + 2
            for k in range(3):
                part = padded[at - k].astype(np.uint64) << np.uint64(8 * k)
                tails[inner] |= np.where(size > k, part, np.uint64(0))
        self.classes = (mix(tails + np.uint64(1)) % np.uint64(CLASSES - 1)).astype(np.int64)
        self.classes[ends] = CLASSES - 1
        one = np.concatenate([[START], self.h[:-1]])
        two = np.concatenate([[START, START], self.h[:-2]])[: len(self.h)]
        heads = self.first[:-1]
        one[heads] = START
        two[heads] = START
        second = heads[self.n > 1] + 1
        two[second] = START
        self.near, self.far = mix(one), (mix(two ^ START) % np.uint64(FAR)).astype(np.int64)

    def owners(self):
        return np.repeat(np.arange(len(self.n)), self.n)

    def cells(self, n_slots):
        """(slot, slot of the word before that, class) as one number."""
        return ((self.near % np.uint64(n_slots)).astype(np.int64) * FAR + self.far) * CLASSES + self.classes


def held_out(id: str, share: int = 10):
    """Documents that the model doesn't learn from."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % share == 0, F.lit(False))


def _texts(rows: pa.Table):
    column = rows.column("text").combine_chunks()
    for start, stop in slices(column, SLICE_BYTES):
        yield start, stop, Tokens(column.slice(start, stop - start))


def _table(schema, rows):
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.table({n: pa.array([r[i] for r in rows], kinds[k]) for i, (n, k) in enumerate(fields)})


_ASKED = "bucket bigint, owner bigint, words binary, classes binary, uses binary"
_ANSWERED = "owner bigint, words binary, uses binary"
#: Owner of rows that hold a bucket's sums for each class.
CLASS_SUMS = -1
WIDE = FAR * CLASSES


def slots_for(size: int) -> int:
    """Fine slots of the word before, a power of two like `NEAR`."""
    return max(NEAR, 1 << max(0, (size // NEAR_BYTES) - 1).bit_length())


def _fold(keys, uses):
    """Distinct keys, in order, and what they count together."""
    order = np.argsort(keys, kind="stable")
    head = _heads(keys[order])
    return keys[order][head], np.add.reduceat(uses[order], head)


def _ask(n_buckets, n_slots, n_parts):
    """One group of documents to its distinct words by bucket; in rows of a
    negative bucket, its distinct (history, class) cells by slot. A cell stands
    under its slot's place in the bucket."""

    def run(key, rows):
        learn = ~rows.column("held_out").to_numpy()
        words, kinds, uses, cells, known = [], [], [], [], []
        for start, stop, t in _texts(rows):
            mine = learn[start:stop][t.owners()]
            order = np.argsort(t.h, kind="stable")
            head = _heads(t.h[order])
            words.append(t.h[order][head])
            kinds.append(t.classes[order][head])
            uses.append(np.add.reduceat(mine[order].astype(np.int64), head))
            at = 2 * t.cells(n_slots) + mine
            at.sort()
            head = _heads(at >> 1)
            cells.append(at[head] >> 1)
            known.append(np.add.reduceat((at & 1).astype(np.int32), head))
        words, kinds, uses = (np.concatenate(x) for x in (words, kinds, uses))
        order = np.argsort(words, kind="stable")
        head = _heads(words[order])
        words, kinds, uses = words[order][head], kinds[order][head], np.add.reduceat(uses[order], head)
        group = key[0].as_py()
        out = [(b, group, _planes(words[at], 8), kinds[at].astype(np.uint8).tobytes(), _planes(uses[at].astype(np.uint64), 8))
               for b, at in _by((mix(words) % np.uint64(n_buckets)).astype(np.int64))]
        cells, known = _fold(np.concatenate(cells), np.concatenate(known).astype(np.int64))
        slot = cells // WIDE
        for part, at in _by(slot % n_parts):
            inside = slot[at] // n_parts * WIDE + cells[at] % WIDE
            out.append((-1 - part, group, _deltas(inside), None, _planes(known[at].astype(np.uint64), 4)))
        return _table(_ASKED, out)

    return run


def _answer(key, asked):
    """One bucket's words: each group gets the training count of the words that
    it asked for; a row of no group holds tokens and distinct words of each
    class."""
    columns = [asked.column(c).to_pylist() for c in ("owner", "words", "classes", "uses")]
    words = [_unplanes(w, 8) for w in columns[1]]
    every = np.concatenate(words)
    kinds = np.frombuffer(b"".join(columns[2]), np.uint8)
    uses = np.concatenate([_unplanes(u, 8) for u in columns[3]]).astype(np.int64)
    order = np.argsort(every, kind="stable")
    head = _heads(every[order])
    known, count, kinds = every[order][head], np.add.reduceat(uses[order], head), kinds[order][head]
    bucket = np.int64(key[0].as_py()).tobytes()
    out = [(owner, bucket, _planes(count[np.searchsorted(known, mine)].astype(np.uint64), 8))
           for owner, mine in zip(columns[0], words)]
    tokens = np.bincount(kinds, count, CLASSES).astype("<i8")
    distinct = np.bincount(kinds[count > 0], minlength=CLASSES).astype("<i8")
    out.append((CLASS_SUMS, tokens.tobytes(), distinct.tobytes()))
    return _table(_ANSWERED, out)


def _add_classes(batches):
    """Buckets' sums for each class, added up to one row for each task."""
    total = np.zeros((2, CLASSES), np.int64)
    for batch in batches:
        for tokens, distinct in zip(batch.column("words").to_pylist(), batch.column("uses").to_pylist()):
            total += np.stack([np.frombuffer(tokens, "<i8"), np.frombuffer(distinct, "<i8")])
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])


def _counted(asked, width):
    """A bucket's training counts: a row of far x classes for each of its slots."""
    cells = np.zeros(width * WIDE, np.int32)
    for at, n in zip(asked.column("words").to_pylist(), asked.column("uses").to_pylist()):
        cells[_undeltas(at)] += _unplanes(n, 4).astype(np.int32)
    return cells.reshape(width, FAR, CLASSES)


def _coarse(n_slots, n_parts):
    """A bucket's counts by coarse slot, for the parts that hold these."""

    def run(key, asked):
        part = -1 - key[0].as_py()
        cells = _counted(asked, n_slots // n_parts)
        coarse = (part + n_parts * np.arange(len(cells))) % NEAR
        out = []
        for slot, at in _by(coarse):
            seen = cells[at].sum(0, dtype=np.int64).ravel()
            some = np.flatnonzero(seen)
            out.append((slot // (NEAR // PARTS), slot, _deltas(some), _planes(seen[some].astype(np.uint64), 8)))
        return _table(_CELLS, out)

    return run


_CELLS = "part bigint, slot bigint, cells binary, counts binary"
_PARTS = "part bigint, cells binary, counts binary"


def _add_cells(key, coarse):
    """One part of the coarse table, added up."""
    width = NEAR // PARTS
    cells = np.zeros((width, WIDE), np.int64)
    for slot, at, n in zip(*(coarse.column(c).to_pylist() for c in ("slot", "cells", "counts"))):
        cells[slot % width, _undeltas(at)] += _unplanes(n, 8).astype(np.int64)
    cells = cells.ravel()
    some = np.flatnonzero(cells)
    return _table(_PARTS, [(key[0].as_py(), _deltas(some), _planes(cells[some].astype(np.uint64), 8))])


class Weights:
    """Weights of the features: each class, the word before, the one before
    that, both. A history is a row of near x far."""

    def __init__(self, classes, near: int = NEAR):
        total = classes.sum()
        self.own = np.log((classes + SMOOTH) / (total + SMOOTH * CLASSES))
        self.near, self.far = np.zeros((near, CLASSES)), np.zeros((FAR, CLASSES))
        self.both = np.zeros((near, FAR, CLASSES), np.float32)

    def _height(self):
        x = self.both + self.far.astype(np.float32)
        x += (self.own + self.near).astype(np.float32)[:, None, :]
        x -= x.max(2, keepdims=True)
        return x

    def log_share(self):
        """ln of each class's share for each history."""
        x = self._height()
        return x - np.log(np.exp(x).sum(2, keepdims=True))

    def lean(self, seen):
        """Observed less expected counts, and their sums as curvature."""
        due = self._height()
        np.exp(due, out=due)
        due *= seen.sum(2, keepdims=True) / due.sum(2, keepdims=True)
        lean = seen - due
        due += seen
        return lean, due

    def part(self, slots):
        """The weights for histories of some coarse slots only."""
        mine = Weights(np.ones(CLASSES), 0)
        mine.own, mine.far, mine.near = self.own, self.far, self.near[slots]
        mine.both = np.zeros((len(slots), FAR, CLASSES), np.float32)
        return mine

    def __reduce__(self):
        """Travels without weights of both, which only buckets learn."""
        return _weights, (self.own, self.near.astype(np.float32), self.far.astype(np.float32))


def _weights(own, near, far):
    weights = Weights(np.ones(CLASSES), len(near))
    weights.own, weights.near, weights.far = own, near.astype(float), far.astype(float)
    return weights


def _step(weight, lean, bend, mean=None):
    """The change of a weight; uses up `lean` and `bend`."""
    lean -= PRIOR * (weight if mean is None else weight - mean)
    bend += 2 * PRIOR
    lean /= bend
    return np.clip(lean, -1, 1, out=lean)


def _gradient(sent):
    """Observed less expected counts of one part, and their sums as curvature,
    for the coarse slots of the part and for the word before that."""

    def run(batches):
        weights, width = sent.value, NEAR // PARTS
        for batch in batches:
            for part, cells, counts in zip(*(batch.column(c).to_pylist() for c in ("part", "cells", "counts"))):
                seen = np.zeros(width * WIDE, np.float32)
                seen[_undeltas(cells)] = _unplanes(counts, 8)
                seen = seen.reshape(width, FAR, CLASSES)
                near, far = np.zeros((2, width, CLASSES)), np.zeros((2, FAR, CLASSES))
                for low in range(0, width, SLOTS_AT_ONCE):
                    at = slice(low, low + SLOTS_AT_ONCE)
                    both = weights.part(part * width + np.arange(width)[at]).lean(seen[at])
                    near[:, at] = [x.sum(1, dtype=float) for x in both]
                    far += [x.sum(0, dtype=float) for x in both]
                packed = [pa.array([x.tobytes()], pa.binary()) for x in (near, far)]
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *packed], ["part", "near", "far"])

    return run


def train(spark, cells: DataFrame, classes: np.ndarray, rounds: int = ROUNDS) -> Weights:
    """Weights that all histories share, after `rounds` distributed gradient
    steps over all counts, each divided by its curvature."""
    weights = Weights(classes)
    for _ in range(rounds if classes.sum() else 0):
        sent = spark.sparkContext.broadcast(weights)
        near, far = np.zeros((2, NEAR, CLASSES)), np.zeros((2, FAR, CLASSES))
        width = NEAR // PARTS
        for row in cells.mapInArrow(tidy(_gradient(sent)), "part bigint, near binary, far binary").collect():  # PARTS rows of fixed size
            low = row["part"] * width
            near[:, low : low + width] = np.frombuffer(row["near"]).reshape(2, width, CLASSES)
            far += np.frombuffer(row["far"]).reshape(2, FAR, CLASSES)
        sent.destroy()
        lean, bend = far.sum(1)
        weights.own += np.clip(lean / (bend + 1), -1, 1)
        weights.near += _step(weights.near, *near)
        weights.far += _step(weights.far, *far)
    return weights


def _shares(sent, n_slots, n_parts, rounds):
    """A bucket's fine slots: their weights, found here, and the log10 shares of
    the cells that each group asked for."""

    def run(key, asked):
        part = -1 - key[0].as_py()
        counts = _counted(asked, n_slots // n_parts)
        share = np.empty(counts.shape, np.float32)
        for low in range(0, len(counts), SLOTS_AT_ONCE):
            seen = counts[low : low + SLOTS_AT_ONCE].astype(np.float32)
            weights = sent.value.part((part + n_parts * (low + np.arange(len(seen)))) % NEAR)
            mean = weights.near.copy()
            for _ in range(rounds if seen.any() else 0):
                lean, bend = weights.lean(seen)
                weights.near += _step(weights.near, lean.sum(1, dtype=float), bend.sum(1, dtype=float), mean)
                weights.both += _step(weights.both, lean, bend)
            share[low : low + SLOTS_AT_ONCE] = weights.log_share() / np.float32(np.log(10))
        flat = share.reshape(-1)
        bucket = np.int64(part).tobytes()
        out = [(owner, bucket, flat[_undeltas(at)].astype("<f4").tobytes())
               for owner, at in zip(asked.column("owner").to_pylist(), asked.column("words").to_pylist())]
        return _table(_ANSWERED, out)

    return run


def _told(buckets, rows, read):
    """What the buckets answered, for a group's sorted keys: each bucket keeps
    the order of the keys that it was asked for."""
    rows = sorted((np.frombuffer(bucket, np.int64)[0], told) for bucket, told in rows)
    out = np.concatenate([read(told) for _, told in rows])
    values = np.empty_like(out)
    values[np.argsort(buckets, kind="stable")] = out
    return values


def _score(sent, n_buckets, n_slots, n_parts):
    """A group's documents and answers to one row of scores for each document."""

    def run(key, rows, answers):
        rest, total = sent.value
        told = list(zip(*(answers.column(c).to_pylist() for c in ("cells", "words", "uses"))))
        texts = [(t.n, t.first[:-1], t.h, t.cells(n_slots)) for _, _, t in _texts(rows)]
        words, cells = (np.unique(np.concatenate([np.unique(t[k]) for t in texts])) for k in (2, 3))
        uses = _told((mix(words) % np.uint64(n_buckets)).astype(np.int64), [r[1:] for r in told if not r[0]],
                     lambda n: _unplanes(n, 8).astype(np.int64))
        share = _told(cells // WIDE % n_parts, [r[1:] for r in told if r[0]], lambda x: np.frombuffer(x, "<f4"))
        out = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
        for n, heads, h, cell in texts:
            count = uses[np.searchsorted(words, h)]
            own = np.log10(count + SMOOTH)
            out["n_tokens"].append(n)
            out["n_known"].append(np.add.reduceat((count > 0).astype(np.int64), heads))
            out["base_score"].append(np.add.reduceat(own - total, heads))
            out["score"].append(np.add.reduceat(own - rest[cell % CLASSES] + share[np.searchsorted(cells, cell)], heads))
        done = {k: pa.array(np.concatenate(v)) for k, v in out.items()}
        return pa.table({"doc_id": rows.column("doc_id"), "held_out": rows.column("held_out"), **done})

    return run


def score_texts(docs: DataFrame, id: str = "doc_id", text: str = "text", share: int = 10, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    of every document. Scores are log10 probabilities of the whole text."""
    spark = docs.sparkSession
    size = text_bytes(docs, text)
    n, n_groups = buckets_for(spark, size, GROUP_BYTES), buckets_for(spark, size, GROUP_BYTES, 1)
    rows = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), held_out(id, share).alias("held_out"),
        F.pmod(F.xxhash64(F.col(id), F.col(text)), F.lit(n_groups)).alias("owner"))
    n_slots = slots_for(size)
    n_parts = min(NEAR, 1 << max(PARTS, n_groups).bit_length() - 1)
    asked, asked_path = store(rows.groupBy("owner").applyInArrow(tidy_group(_ask(n, n_slots, n_parts)), _ASKED), "asked")
    answers, answers_path = store(
        asked.where("bucket >= 0").groupBy("bucket").applyInArrow(tidy_group(_answer), _ANSWERED), "answers")
    by_slot = asked.where("bucket < 0").groupBy("bucket")
    coarse = by_slot.applyInArrow(tidy_group(_coarse(n_slots, n_parts)), _CELLS)
    cells = coarse.repartition(PARTS, "part").groupBy("part").applyInArrow(tidy_group(_add_cells), _PARTS)
    cells, cells_path = store(cells, "cells")

    sums = answers.where(F.col("owner") == CLASS_SUMS).select("words", "uses").mapInArrow(_add_classes, "total binary")
    tokens, distinct = sum((np.frombuffer(r["total"], np.int64).reshape(2, -1) for r in sums.toLocalIterator()),
                           np.zeros((2, CLASSES), np.int64))
    weights = spark.sparkContext.broadcast(train(spark, cells, tokens, rounds))
    drop_stored(spark, cells_path)
    shares, shares_path = store(by_slot.applyInArrow(tidy_group(_shares(weights, n_slots, n_parts, rounds)), _ANSWERED), "shares")
    drop_stored(spark, asked_path)
    weights.destroy()
    total = float(np.log10(tokens.sum() + SMOOTH * (distinct.sum() + 1)))
    rest = np.log10(tokens + SMOOTH * (distinct + 1))
    sent = spark.sparkContext.broadcast((rest, total))
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    told = answers.where("owner >= 0").withColumn("cells", F.lit(False)).unionByName(shares.withColumn("cells", F.lit(True)))
    scored = rows.groupBy("owner").cogroup(told.groupBy("owner")).applyInArrow(tidy_group(_score(sent, n, n_slots, n_parts)), schema)
    scored = cut_lineage(scored.withColumn("train_tokens", F.lit(int(tokens.sum())).cast("bigint")))
    drop_stored(spark, answers_path)
    drop_stored(spark, shares_path)
    return scored
