"""Benchmark decontamination by Wu-Manber search over words.

Every run of `window` words of a benchmark item is a pattern; an item with
fewer words is one pattern. Patterns of one length share a shift table over
blocks of two words: a block found at a window's end says how far the window
may move on without missing a pattern, so most positions are never looked at.
Where the shift is zero, the patterns that end in the same block are compared
with the text, first by word hashes and then byte by byte.

The search is a map over the documents and moves no row. Patterns travel to
the tasks in blocks of at most `block_bytes` of benchmark text; a larger
benchmark is searched in several passes.

Defined cases: a null or empty text has no words and no hits; a null or empty
item, or one without an id, has no patterns; repeated rows are searched one
by one; equal items are all named; an empty benchmark hits nothing; very long
texts are a slice of their own in a task; an empty table gives an empty result;
other columns stay, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .tables import fresh, text_bytes
from .words import ALNUM, Words, combine, slices, tidy

WINDOW = 10
#: Benchmark text that one pass sends to the tasks.
BLOCK_BYTES = 8 << 20
#: Window ends that one cursor walks over.
LANE = 256

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("mask", T.BinaryType()),
])


class PatternSet:
    """Patterns of one length with their shift table and suffix buckets."""

    def __init__(self, width, texts, hashes, owners):
        self.width, self.texts, self.owners = width, texts, owners
        self.block = min(2, width)
        self.hashes = np.array(hashes, np.uint64).reshape(len(texts), width)
        bits = int(np.ceil(np.log2(max(64, 16 * len(texts) * width))))
        self.mask = np.uint64((1 << min(bits, 24)) - 1)
        most = width - self.block + 1
        self.shift = np.full(int(self.mask) + 1, most, np.int16)
        for end in range(self.block - 1, width):
            slot = self._blocks(self.hashes, end) & self.mask
            np.minimum.at(self.shift, slot, np.int16(width - 1 - end))
        suffix = self._blocks(self.hashes, width - 1)
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]

    def _blocks(self, rows, end):
        last = rows[:, end]
        return combine(rows[:, end - 1], last) if self.block == 2 else last

    def find(self, words: Words, h: np.ndarray):
        """(first word, pattern) of each occurrence in the texts of a slice."""
        ends = self._candidates(words, h)
        block = combine(h[ends - 1], h[ends]) if self.block == 2 else h[ends]
        low = np.searchsorted(self.suffix, block, "left")
        n = np.searchsorted(self.suffix, block, "right") - low
        at = np.repeat(ends - self.width + 1, n)
        step = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        pattern = self.order[np.repeat(low, n) + step]
        for k in range(self.width):
            same = h[at + k] == self.hashes[pattern, k]
            at, pattern = at[same], pattern[same]
        same = [words.bytes_of(i, i + self.width) == self.texts[p]
                for i, p in zip(at.tolist(), pattern.tolist())]
        same = np.array(same, bool)
        return at[same], pattern[same]

    def _candidates(self, words, h):
        """Window ends with shift 0. Cursors jump by the shift table, all lanes
        of the slice side by side."""
        first, last = words.first[:-1] + self.width - 1, words.first[1:]
        lanes = np.maximum(0, -(-(last - first) // LANE))
        text = np.repeat(np.arange(len(lanes)), lanes)
        number = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        cursor = first[text] + number * LANE
        stop = np.minimum(cursor + LANE, last[text])
        found = []
        while len(cursor):
            block = combine(h[cursor - 1], h[cursor]) if self.block == 2 else h[cursor]
            jump = self.shift[block & self.mask]
            found.append(cursor[jump == 0])
            cursor = cursor + np.maximum(jump, 1)
            go = cursor < stop
            cursor, stop = cursor[go], stop[go]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def pattern_sets(items: list[tuple[str, str]], window: int = WINDOW) -> list[PatternSet]:
    """Patterns of (item id, text) pairs, one set for each length."""
    words = Words(pa.array([t for _, t in items], pa.string()), ALNUM, lower=True)
    h, by_width = words.hashes(), {}
    for (name, _), i, j in zip(items, words.first[:-1].tolist(), words.first[1:].tolist()):
        width = min(window, j - i)
        for at in range(i, j - width + 1) if width else ():
            known = by_width.setdefault(width, {})
            known.setdefault(words.bytes_of(at, at + width), (h[at : at + width], set()))[1].add(name)
    return [
        PatternSet(width, list(known), [v[0] for v in known.values()], [sorted(v[1]) for v in known.values()])
        for width, known in by_width.items()
    ]


def search(sets: list[PatternSet], column: pa.Array, before: pa.Array | None) -> pa.Array:
    """The result structs of a batch of texts, joined with an earlier pass's."""
    out = {k: [] for k in ("n_words", "n_hit", "item_ids", "mask")}
    for start, stop in slices(column):
        words = Words(column.slice(start, stop - start), ALNUM, lower=True)
        h, n = words.hashes(), words.counts()
        change, names = np.zeros(len(words) + 1, np.int64), {}
        for patterns in sets:
            at, pattern = patterns.find(words, h)
            np.add.at(change, at, 1)
            np.add.at(change, at + patterns.width, -1)
            text = np.searchsorted(words.first, at, "right") - 1
            for t, p in np.unique(np.stack([text, pattern], 1), axis=0).tolist():
                names.setdefault(t, set()).update(patterns.owners[p])
        hit = np.cumsum(change[:-1]) > 0
        for t in range(stop - start):
            mine = hit[words.first[t] : words.first[t + 1]]
            if before is not None:
                earlier = before[start + t].as_py()
                if earlier["mask"]:
                    mine = mine | np.unpackbits(np.frombuffer(earlier["mask"], np.uint8), count=len(mine)).astype(bool)
                if earlier["item_ids"]:
                    names.setdefault(t, set()).update(earlier["item_ids"])
            out["n_hit"].append(int(mine.sum()))
            out["item_ids"].append(sorted(names.get(t, ())))
            out["mask"].append(np.packbits(mine).tobytes() if out["n_hit"][-1] else b"")
        out["n_words"].extend(n.tolist())
    fields = {"n_words": pa.int64(), "n_hit": pa.int64(), "item_ids": pa.list_(pa.string()), "mask": pa.binary()}
    return pa.StructArray.from_arrays([pa.array(out[k], t) for k, t in fields.items()], list(fields))


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int):
    """Benchmark items as lists of at most about `block_bytes` of text."""
    items = benchmark.where(F.col(item_id).isNotNull() & F.col(text).isNotNull()).select(
        F.col(item_id).cast("string").alias("item"), F.col(text).alias("body"))
    n = -(-text_bytes(items, "body") // block_bytes)
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "body"), F.lit(n)) == k)
        yield [(r["item"], r["body"]) for r in part.toLocalIterator()]


def mark_contamination(docs: DataFrame, benchmark: DataFrame, out: str, text: str = "text",
                       item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` with a struct column `out`: n_words, n_hit (words inside an
    occurrence), item_ids (items that occur, as sorted strings) and mask (one
    bit for each word, packed; empty without hits)."""
    spark = docs.sparkSession
    result, passes = docs.withColumn(out, F.lit(None).cast(RESULT)), 0
    for items in _blocks(benchmark, item_id, item_text, block_bytes):
        sent = spark.sparkContext.broadcast(pattern_sets(items, window))
        result, passes = _search_pass(result, sent, text, out, passes > 0), passes + 1
    return result if passes else _search_pass(result, spark.sparkContext.broadcast([]), text, out, False)


def _search_pass(docs, sent, text, out, again):
    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(out)
            found = search(sent.value, batch.column(text), batch.column(at) if again else None)
            yield pa.RecordBatch.from_arrays(
                [found if i == at else c for i, c in enumerate(batch.columns)],
                [f.name for f in batch.schema])

    return docs.mapInArrow(tidy(run), docs.schema)


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document: counts, a digest of the items, the verdict."""
    found = mark_contamination(docs.select("doc_id", "text"), benchmark, "found")
    names = F.array_join("found.item_ids", ",")
    return found.select(
        "doc_id", "found.n_words", "found.n_hit",
        F.size("found.item_ids").cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` without the documents that hold a benchmark passage."""
    out = fresh(docs, "contamination")
    return mark_contamination(docs, benchmark, out).where(F.col(f"{out}.n_hit") == 0).drop(out)
