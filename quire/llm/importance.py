"""Quality selection by importance resampling.

Two generative models of hashed word unigrams and bigrams are counted: one of
target text, one of all text. A document's weight is the log ratio of its
features' probabilities under both. Gumbel noise drawn from its id is added,
and the documents with the largest sums are taken: a sample without
replacement in proportion to the weights.

The model of all text counts every feature of every document. The target model
counts at most `target_rows` of the documents labelled good, picked by hash.
Counts are folded by task before they meet. The last place in the selection is
found by counting documents in ever narrower ranges of the sum, so no task and
no driver holds them in order.

Defined cases: a null or empty text has no features and weight 0; repeated rows
of one id draw the same noise, and rows level with the last place are all
taken; rows without doc_id draw from their text; without good labels the ratio
is 1 everywhere; an empty table selects nothing; very long texts are a slice of
their own in a task; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .words import NON_SPACE, Words, combine, mix, slices, within

SLOTS = 1 << 14
TARGET_ROWS = 20_000
SEED = 29
#: Ranges counted at once when the last place is looked for.
RANGES = 4096
SMOOTH = 0.5


def features(words: Words):
    """Slots of the words and word pairs of a slice, and the word at which each
    begins."""
    h = words.hashes()
    pair = within(words.first, 2)
    slot = np.concatenate([mix(h), combine(h[pair], h[pair + 1])]) % np.uint64(SLOTS)
    return slot.astype(np.int64), np.concatenate([np.arange(len(h)), pair])


def _count(batches):
    """Features of all rows and of target rows, one row for each slot and task."""
    seen = np.zeros((2, SLOTS), np.int64)
    for batch in batches:
        target = batch.column("target").to_numpy(zero_copy_only=False)
        for start, stop in slices(batch.column("text")):
            words = Words(batch.column("text").slice(start, stop - start), NON_SPACE, lower=True)
            slot, at = features(words)
            seen[0] += np.bincount(slot, minlength=SLOTS)
            seen[1] += np.bincount(slot[target[start:stop][words.owners()[at]]], minlength=SLOTS)
    slots = np.flatnonzero(seen[0])
    yield pa.RecordBatch.from_arrays([pa.array(x[slots] if x.ndim else x, pa.int64()) for x in (np.arange(SLOTS), *seen)], ["slot", "everything", "target"])


def _weigh(sent):
    def run(batches):
        ratio = sent.value
        for batch in batches:
            weight = np.zeros(batch.num_rows)
            for start, stop in slices(batch.column("text")):
                words = Words(batch.column("text").slice(start, stop - start), NON_SPACE, lower=True)
                slot, at = features(words)
                weight[start:stop] = np.bincount(words.owners()[at], ratio[slot], stop - start)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("draw"), pa.array(weight)], ["doc_id", "draw", "log_weight"])

    return run


def ratio(docs: DataFrame, good_ids: DataFrame, target_rows: int = TARGET_ROWS) -> np.ndarray:
    """ln of target share over overall share for each slot. `docs`: doc_id,
    text. `good_ids`: doc_id of target documents."""
    total = good_ids.count()
    part = min(1.0, target_rows / max(1, total))
    place = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30))
    chosen = good_ids.where(place < int(part * (1 << 30))).select("doc_id", F.lit(True).alias("good"))
    marked = docs.join(F.broadcast(chosen.distinct()), "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("target"))
    counted = marked.mapInArrow(_count, "slot bigint, everything bigint, target bigint")
    seen = np.zeros((2, SLOTS))
    for row in counted.groupBy("slot").agg(F.sum("everything").alias("e"), F.sum("target").alias("t")).collect():
        seen[:, row["slot"]] = row["e"], row["t"]
    if not seen[1].sum():
        return np.zeros(SLOTS)
    share = (seen + SMOOTH) / (seen.sum(1, keepdims=True) + SMOOTH * SLOTS)
    return np.log(share[1] / share[0])


def _last_place(rows: DataFrame, k: int) -> float:
    """The k-th largest `place` of `rows`, by counting in narrower ranges."""
    low, high, n = rows.agg(F.min("place"), F.max("place"), F.count("place")).first()
    if k <= 0 or not n:
        return math.inf
    if k >= n:
        return low
    above = 0
    while True:
        width = (high - low) / RANGES
        inside = rows.where((F.col("place") >= low) & (F.col("place") <= high))
        if width <= abs(high) * 1e-12:
            return low
        box = F.least(F.floor((F.col("place") - F.lit(low)) / F.lit(width)), F.lit(RANGES - 1))
        for number, count in sorted(inside.groupBy(box.alias("box")).count().collect(), reverse=True):
            if above + count >= k:
                break
            above += count
        if count <= RANGES:
            found = inside.where(box == number).select("place").collect()
            return sorted((r[0] for r in found), reverse=True)[k - above - 1]
        low, high = low + number * width, low + (number + 1) * width


def resample(docs: DataFrame, good_ids: DataFrame, share: float, id: str = "doc_id", text: str = "text",
             target_rows: int = TARGET_ROWS, seed: int = SEED) -> DataFrame:
    """doc_id, log_weight, place (with noise) and kept: `share` of the rows."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sent = spark.sparkContext.broadcast(ratio(slim, good_ids, target_rows))
    # A number in (0, 1) from the id, or from the text where there is none.
    draw = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    weighed = slim.withColumn("draw", draw).mapInArrow(_weigh(sent), "doc_id bigint, draw double, log_weight double")
    placed = cut_lineage(weighed.select("doc_id", "log_weight", (F.col("log_weight") - F.log(-F.log("draw"))).alias("place")))
    return placed.withColumn("kept", F.col("place") >= F.lit(_last_place(placed, round(share * placed.count()))))


def quality_selection(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents like those labelled good, as many as the good labels' share."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    share = known.agg(F.avg("quality")).first()[0]
    return resample(docs, known.where("quality = 1").select("doc_id"), 0.0 if share is None else float(share))
