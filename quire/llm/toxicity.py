"""Toxicity categories by a chain of linear classifiers.

Categories are predicted one after the other. Each is a logistic model over
hashed words of the text and their first letters, and over the probabilities of the
categories before it. In training those earlier probabilities come from models
that haven't seen the row: rows are dealt to folds by hash, each category is
trained once without each fold and once on all rows, and a training row gets
its earlier probabilities from the models of its own fold.

Training takes at most `most_rows` labelled rows, picked by hash, and one of
each set of copies among them: rows of equal labels with the same features, or
with the same least word pair and `LIKE` of their `SIGNS` minima in common. The
pair alone says little, as unrelated texts share common pairs. Features are
stored once, and every training step is a Spark job that adds up gradients of
all folds at once. The first step only counts, over the features that occur
in rows of a category: those that don't go with it by `APART` deviations get no
weight, so a long clean text gathers no score by its length. First letters are for stems with many endings.
Features are told apart by 32 bits of hash.

Scoring is a map over all texts and moves nothing.

Defined cases: a null or empty text has the probabilities of a text without
features and isn't toxic; repeated rows are scored alike; labelled rows without
a document don't count; without labelled rows, or where a category never
occurs, its probability is 0; a probability of just one half is not toxic; very
long texts are a slice of their own in a task; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import drop_stored, store
from .words import ALNUM, Words, combine, mix, slices, within

#: Hashes of features.
SLOTS = 1 << 32
MOST_ROWS = 12_000
FOLDS = 3
ROUNDS = 6
#: Deviations by which a feature must be more common in a category than by
#: chance, rows that it must be in, and their least share in the category, to
#: get a weight.
APART, LEAST_ROWS, PURE = 5.0, 6, 0.88
#: Precision of the Gaussian prior on each weight.
PRIOR = 0.3
#: Letters (bytes) of a word's beginning that are features.
STEMS = (4, 5, 6)
#: Tasks of a training step.
SAMPLE_TASKS = 8
#: Minima of a text's word pairs, and their least common share in near copies.
SIGNS, LIKE = 64, 0.8
_EMPTY = np.uint32(0xFFFFFFFF)

#: Words that place a toxic document in a category, for labels that only say
#: whether it is toxic. Fixed values.
CATEGORY_WORDS = {
    "insult": ["clown", "idiot", "loser", "moron", "scum", "trash"],
    "contempt": ["disgusting", "pathetic", "stupid", "worthless"],
}


def text_features(words: Words):
    """Distinct features of each text, as hashes and the texts they belong to."""
    h, owner = words.hashes(), words.owners()
    kinds, owners = [mix(h)], [owner]
    eight = np.ndarray(len(words.data) + 1, "<u8", np.concatenate([words.data, np.zeros(8, np.uint8)]), 0, (1,))
    for size in STEMS:
        at = np.flatnonzero(words.ends - words.starts >= size)
        stem = eight[words.starts[at]] & np.uint64((1 << 8 * size) - 1)
        kinds.append(combine(stem, np.full(len(at), size, np.uint64)))
        owners.append(owner[at])
    slot = np.concatenate(kinds) % np.uint64(SLOTS)
    both = np.unique(np.concatenate(owners) * SLOTS + slot.astype(np.int64))
    return both % SLOTS, both // SLOTS


def twins(words: Words) -> np.ndarray:
    """A number for each text that near copies mostly share: the least hash of
    its word pairs (of its words, if it has no pair)."""
    h, owner = words.hashes(), words.owners()
    pair = within(words.first, 2)
    least = np.full(len(words.first) - 1, np.iinfo(np.uint64).max)
    np.minimum.at(least, owner, mix(h) | np.uint64(1 << 63))
    np.minimum.at(least, owner[pair], combine(h[pair], h[pair + 1]) >> np.uint64(1))
    return least.view(np.int64)


def signatures(words: Words) -> np.ndarray:
    """The least word pair of each of `SIGNS` bins of each text (of its words,
    if it has no pair); `_EMPTY` where a bin has none."""
    h, owner, n = words.hashes(), words.owners(), len(words.first) - 1
    pair, alone = within(words.first, 2), np.flatnonzero(words.counts()[owner] < 2)
    value = np.concatenate([combine(h[pair], h[pair + 1]), mix(h[alone])])
    at = np.concatenate([owner[pair], owner[alone]]) * SIGNS + (value % np.uint64(SIGNS)).astype(np.int64)
    least = np.full(n * SIGNS, _EMPTY)
    np.minimum.at(least, at, (value >> np.uint64(32)).astype(np.uint32))
    return least.reshape(n, SIGNS)


def near_copies(groups, signs: np.ndarray) -> list[int]:
    """Numbers of the rows that have a near copy before them in their group
    that stays. `groups`: a key for each row; only rows of one are compared."""
    mine, gone = {}, []
    for i, group in enumerate(groups):
        mine.setdefault(group, []).append(i)
    for rows in mine.values():
        kept, n = np.empty((len(rows), SIGNS), np.uint32), 0
        for i in rows:
            used = (kept[:n] != _EMPTY) | (signs[i] != _EMPTY)
            same = (kept[:n] == signs[i]) & used
            if (same.sum(1) >= LIKE * np.maximum(used.sum(1), 1)).any():
                gone.append(i)
            else:
                kept[n] = signs[i]
                n += 1
    return gone


def _featurize(batches):
    for batch in batches:
        column = batch.column("text")
        for start, stop in slices(column):
            n = stop - start
            words = Words(column.slice(start, n), ALNUM, lower=True)
            slot, owner = text_features(words)
            cut = np.split(slot.astype("<u4"), np.cumsum(np.bincount(owner, minlength=n))[:-1])
            part = batch.slice(start, n)
            yield pa.RecordBatch.from_arrays(
                [part.column("fold"), part.column("labels"), pa.array([c.tobytes() for c in cut], pa.binary()),
                 pa.array(twins(words)), pa.array([x.tobytes() for x in signatures(words)], pa.binary())],
                ["fold", "labels", "slots", "twin", "signs"])


def _one_of_copies(features: DataFrame):
    """The sample's rows, stored, without copies, and where they are. The
    sample is bounded, and so are the minima that the driver compares."""
    spark = features.sparkSession
    single, path = store(features.withColumn("key", F.xxhash64("slots", "labels")).dropDuplicates(["slots", "labels"]), "single")
    marks = single.select("twin", "labels", "key", "signs").orderBy("twin", "key").collect()
    signs = np.frombuffer(b"".join(r["signs"] for r in marks), np.uint32).reshape(-1, SIGNS)
    gone = near_copies([(r["twin"], tuple(r["labels"])) for r in marks], signs)
    rows = single
    if gone:
        keys = spark.createDataFrame([(marks[i]["key"],) for i in gone], "key bigint")
        rows = single.join(F.broadcast(keys), "key", "left_anti")
    sample, sample_path = store(rows.select("fold", "labels", "slots").repartition(SAMPLE_TASKS), "sample")
    drop_stored(spark, path)
    return sample, sample_path


def _rows(batch):
    """Features, owners, folds and labels of stored rows."""
    blobs = batch.column("slots").to_pylist()
    size = np.array([len(b) // 4 for b in blobs], np.int64)
    slot = np.frombuffer(b"".join(blobs), "<u4").astype(np.int64)
    labels = np.array(batch.column("labels").to_pylist(), float).reshape(len(blobs), -1)
    return slot, np.repeat(np.arange(len(blobs)), size), batch.column("fold").to_numpy(), labels


def _known(ids, slot, owner):
    """Numbers of the features that are in the sorted `ids`, and their owners."""
    if not len(ids):
        return slot[:0], owner[:0]
    at = np.minimum(np.searchsorted(ids, slot), len(ids) - 1)
    known = ids[at] == slot
    return at[known], owner[known]


def _of_category(batches):
    """How many rows of any category each feature is in."""
    held = [np.zeros(0, np.int64)]
    for batch in batches:
        slot, owner, _, labels = _rows(batch)
        held.append(slot[(labels.max(1) > 0)[owner]])
    slot, n = np.unique(np.concatenate(held), return_counts=True)
    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n, pa.int64())], ["slot", "n"])


class Model:
    """Weights of one category: `words` (models x features), and for each model a
    constant and weights of the earlier categories. Model FOLDS learned from all
    rows, model f from all but fold f."""

    def __init__(self, earlier: int, features: int = 0):
        self.words = np.zeros((FOLDS + 1, features))
        self.active = np.ones((FOLDS + 1, features), bool)
        self.rest = np.zeros((FOLDS + 1, 1 + earlier))

    def odds(self, number, slot, owner, n, before):
        """Log odds of n rows under one model; `before`: rows x earlier."""
        rest = self.rest[number]
        return np.bincount(owner, self.words[number][slot], n) + rest[0] + before @ rest[1:]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _before_out_of_fold(chain, slot, owner, fold):
    """Earlier categories' probabilities of training rows, each from models that
    haven't seen it."""
    n = len(fold)
    before = np.zeros((n, len(chain)))
    for c, model in enumerate(chain):
        for f in range(FOLDS):
            odds = model.odds(f, slot, owner, n, before[:, :c])
            before[fold == f, c] = sigmoid(odds[fold == f])
    return before


def _gradient(sent):
    def run(batches):
        ids, chain, model, category = sent.value
        lean, bend = np.zeros(model.words.shape), np.zeros(model.words.shape)
        rest, counting = np.zeros((2, *model.rest.shape)), not model.rest.any()
        for batch in batches:
            slot, owner, fold, labels = _rows(batch)
            slot, owner = _known(ids, slot, owner)
            before = _before_out_of_fold(chain, slot, owner, fold)
            given = np.concatenate([np.ones((len(fold), 1)), before], 1)
            for number in range(FOLDS + 1):
                # Features of a row share its step, so their number joins the curvature.
                shared = np.ones(len(fold)) if counting else 1 + np.bincount(owner, model.active[number][slot], len(fold))
                p = sigmoid(model.odds(number, slot, owner, len(fold), before))
                mine = fold != number
                off = np.where(mine, labels[:, category] - p, 0.0)
                # At most a quarter for each row, whatever its probability.
                turn = np.where(mine, 0.25 * shared, 0.0)
                lean[number] += np.bincount(slot, off[owner], len(ids))
                bend[number] += np.bincount(slot, turn[owner], len(ids))
                rest[0, number] += off @ given
                rest[1, number] += turn @ given**2
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (lean, bend, rest)], ["lean", "bend", "rest"])

    return run


def _step(sample, ids, chain, model, category):
    """Sums of one gradient job."""
    sent = sample.sparkSession.sparkContext.broadcast((ids, chain, model, category))
    lean, bend, rest = np.zeros(model.words.shape), np.zeros(model.words.shape), np.zeros((2, *model.rest.shape))
    for row in sample.mapInArrow(_gradient(sent), "lean binary, bend binary, rest binary").toLocalIterator():
        lean += np.frombuffer(row["lean"]).reshape(lean.shape)
        bend += np.frombuffer(row["bend"]).reshape(bend.shape)
        rest += np.frombuffer(row["rest"]).reshape(rest.shape)
    sent.unpersist()
    return lean, bend, rest


def _screened(model, lean, bend, rest):
    """Choose the features that get weights, from sums with all odds even: then
    they are counts, and `lean` is half of how many more rows are of the
    category than not."""
    n, total = 4 * bend, 4 * rest[1, :, :1]
    share = np.clip((rest[0, :, :1] + total / 2) / np.maximum(total, 1), 1e-6, 1 - 1e-6)
    off = lean + n / 2 - n * share
    model.active = (n >= LEAST_ROWS) & (lean >= (PURE - 0.5) * n) & (off >= APART * np.sqrt(n * share * (1 - share)))
    model.rest[:, 0] = np.log(share / (1 - share))[:, 0]
    # Start from each feature's own log odds; further steps settle who counts.
    odds = np.log((n / 2 + lean + 1) / (n / 2 - lean + 1)) - model.rest[:, :1]
    model.words = np.where(model.active, odds, 0.0)


def train(sample: DataFrame, n_labels: int, rounds: int = ROUNDS) -> tuple[np.ndarray, list[Model]]:
    """Features with weights, and one model for each category in order, from
    stored feature rows."""
    # The sample is bounded, and so are its features.
    often = sample.mapInArrow(_of_category, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
    ids = np.array(sorted(r[0] for r in often.where(F.col("n") >= LEAST_ROWS * PURE).select("slot").collect()), np.int64)
    models = []
    for category in range(n_labels):
        model = Model(0, len(ids))
        _screened(model, *_step(sample, ids, [], model, category))
        models.append(model)
    kept = np.flatnonzero(np.any([m.active.any(0) for m in models], 0)) if models else ids
    chain = []
    for category, found in enumerate(models):
        model = Model(category, len(kept))
        model.words, model.active = found.words[:, kept], found.active[:, kept]
        model.rest[:, 0] = found.rest[:, 0]
        for _ in range(rounds):
            lean, bend, rest = _step(sample, ids[kept], chain, model, category)
            # A step along the gradient over its curvature, and the prior's pull.
            model.words += model.active * (lean - PRIOR * model.words) / (bend + PRIOR)
            model.rest += np.clip(rest[0] / (rest[1] + 1.0), -1, 1)
        chain.append(model)
    return ids[kept], chain


def _score(sent, names):
    def run(batches):
        for batch in batches:
            ids, chain, seen = sent.value
            column, out = batch.column("text"), []
            for start, stop in slices(column):
                found = text_features(Words(column.slice(start, stop - start), ALNUM, lower=True))
                slot, owner = _known(ids, *found)
                p = np.zeros((stop - start, len(names)))
                for c, model in enumerate(chain):
                    if seen[c]:
                        p[:, c] = sigmoid(model.odds(FOLDS, slot, owner, len(p), p[:, :c]))
                out.append(p)
            p = np.concatenate(out) if out else np.zeros((0, len(names)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(p[:, c]) for c in range(len(names)))], ["doc_id", *names])

    return run


def score_chain(docs: DataFrame, labelled: DataFrame, categories: dict[str, Column], most_rows: int = MOST_ROWS,
                rounds: int = ROUNDS) -> DataFrame:
    """doc_id and the probability of each category. `labelled`: doc_id, label
    columns; `categories`: in chain order, a 0/1 column over the joined rows of
    documents (doc_id, text) and `labelled`."""
    spark, names = docs.sparkSession, list(categories)
    total = labelled.count()
    part = min(1.0, most_rows / max(1, total))
    draw = F.xxhash64(F.col("doc_id"), F.lit(41))
    picked = labelled.where(F.pmod(draw, F.lit(1 << 30)) < int(part * (1 << 30)))
    rows = docs.join(F.broadcast(picked), "doc_id").select(
        F.pmod(F.shiftright(draw, 32), F.lit(FOLDS)).cast("int").alias("fold"),
        F.array(*(c.cast("int") for c in categories.values())).alias("labels"), "text")
    features = rows.mapInArrow(_featurize, "fold int, labels array<int>, slots binary, twin bigint, signs binary")
    # Copies of one text would make all its words look telling.
    sample, path = _one_of_copies(features)
    seen = [n or 0 for n in sample.agg(*(F.sum(F.col("labels")[i]) for i in range(len(names)))).first()]
    ids, chain = train(sample, len(names), rounds) if any(seen) else (np.zeros(0, np.int64), [])
    drop_stored(spark, path)
    sent = spark.sparkContext.broadcast((ids, chain, seen))
    return docs.select("doc_id", "text").mapInArrow(
        _score(sent, names), ", ".join(["doc_id bigint", *(f"{n} double" for n in names)]))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_insult, p_contempt, p_toxic and toxic (p_toxic over one half).
    The labels say whether a document is toxic; its finer categories follow
    from the words it is toxic with."""
    toxic = F.col("toxic") == 1
    holds = lambda some: F.lower("text").rlike(r"(?<!\p{L})(" + "|".join(some) + r")(?!\p{L})")
    categories = {f"p_{name}": F.coalesce(toxic & holds(some), F.lit(False)) for name, some in CATEGORY_WORDS.items()}
    categories["p_toxic"] = toxic
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).select("doc_id", "toxic")
    scored = score_chain(docs.select("doc_id", "text"), known, categories)
    return scored.withColumn("toxic", F.col("p_toxic") > 0.5)
