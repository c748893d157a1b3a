"""Repeated passages, found through difference-cover anchors.

A window is `width` consecutive words. Every pair of equal windows shares an
anchor: with period p and a difference cover D of p (every remainder is a
difference of two members of D), whatever the windows' positions are, within
their first p words there is a step at which both stand on a position whose
remainder is in D. So only runs of `width - p + 1` words that start on such
positions are hashed and dealt out: 3 of 7 positions for 13 words.

1. Anchors are dealt to hash buckets. A bucket notes those that lie in two or
   more documents as bits of its slice of a filter. The filter has a fixed
   size (`FILTER_BITS`), whatever the corpus holds, and is all that the driver
   sees. A full filter makes step 2 send more, never less.
2. Windows around anchors that the filter knows are extended to their full
   width and dealt to buckets by 80 bits of hash. A bucket names the windows
   that also lie in a smaller document.

Both deals pack anchors and windows as bytes, and the number of buckets grows
with the text. A passage in very many documents doesn't gather in its bucket:
a task first settles the repeats among the documents it holds, and sends one
copy of the rest.

Defined cases: a null text has no words; shorter texts than a window are kept
whole; rows of one doc_id never repeat each other and each lose what earlier
documents hold; rows without doc_id stay whole and no document counts them as
earlier. Windows are judged on the input, not on what is left. Places belong to
a doc_id and a hash of the text, so rows that share an id but not a text keep
theirs apart; which document is earlier is told by doc_id alone. Very long texts
are a slice of their own in a task; an empty table gives an empty result; other
columns stay in `drop_repeats`, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from .tables import buckets_for, fresh, text_bytes
from .words import Words, combine, mix, slices, tidy, tidy_group, windows

WIDTH = 13
#: Text bytes whose anchors share a bucket; some 1.3 million anchors.
BUCKET_BYTES = 20 << 20
#: Anchors or windows that a task holds before it sends them on.
HELD = 1 << 19
#: Bits of the filter over shared anchors: 16 MB.
FILTER_BITS = 1 << 27

_ANCHORS = "bucket bigint, docs binary, owners binary, keys binary"
_WINDOWS = "bucket bigint, docs binary, owners binary, places binary, keys binary, rest binary"
_FOUND = "part bigint, docs binary, sizes binary, starts binary"
_HITS = "doc_id bigint, text_key bigint, starts binary"


def difference_cover(period: int) -> list[int]:
    """A small set with every remainder of `period` as a difference: the
    smallest one for short periods, else two combs."""
    if period <= 13:
        for size in range(1, period + 1):
            for cover in itertools.combinations(range(period), size):
                if len({(a - b) % period for a in cover for b in cover}) == period:
                    return list(cover)
    step = math.isqrt(period - 1) + 1
    return sorted({*range(step), *range(0, period, step)})


class Scheme:
    """Period, cover and anchor length for windows of `width` words."""

    def __init__(self, width: int):
        self.width = width
        self.period = (width + 1) // 2
        self.anchor = width - self.period + 1
        self.inside = np.isin(np.arange(self.period), difference_cover(self.period))

    def anchors(self, words: Words, h: np.ndarray):
        """Word numbers and hashes of the anchors of texts that hold a window."""
        n, owner = words.counts(), words.owners()
        place = np.arange(len(h)) - words.first[owner]
        ok = self.inside[place % self.period] & (n[owner] - place >= self.anchor) & (n[owner] >= self.width)
        at = np.flatnonzero(ok)
        return at, windows(h, self.anchor)[at]


def _pieces(batches, *columns):
    """(values of the first columns, words, word hashes) of slices of the rows
    that have an id. `columns`: the id first, the text last."""
    *numbers, text = columns
    for batch in batches:
        known = batch.filter(pa.compute.is_valid(batch.column(numbers[0])))
        values = [known.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in numbers]
        for start, stop in slices(known.column(text)):
            words = Words(known.column(text).slice(start, stop - start))
            yield *(v[start:stop] for v in values), words, words.hashes()


def _by(key: np.ndarray):
    """(value, row numbers in order) of each value."""
    order = np.argsort(key, kind="stable")
    for i, j in _runs(key[order]):
        yield int(key[order[i]]), order[i:j]


def _heads(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new key begins."""
    new = np.zeros(len(sorted_keys[0]), bool)
    new[:1] = True
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _runs(sorted_key):
    head = _heads(sorted_key).tolist()
    return zip(head, [*head[1:], len(sorted_key)])


def _planes(values: np.ndarray, n_bytes: int) -> bytes:
    """The low bytes of each value, byte by byte, so that like ones lie together."""
    return b"".join((values >> np.uint64(8 * k)).astype(np.uint8).tobytes() for k in range(n_bytes))


def _unplanes(data: bytes, n_bytes: int) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(n_bytes, -1)
    return sum(r.astype(np.uint64) << np.uint64(8 * k) for k, r in enumerate(rows))


def _deltas(values: np.ndarray) -> bytes:
    """Differences of neighbours: mostly zero bytes, which the shuffle's
    compression removes."""
    return _planes(np.diff(values, prepend=0).astype(np.int64).astype(np.uint64), 4)


def _undeltas(data: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(data, 4).astype(np.uint32).astype(np.int32).astype(np.int64))


def _owners(doc: np.ndarray):
    docs, owner = np.unique(doc, return_inverse=True)
    return docs.astype("<i8").tobytes(), _deltas(owner)


def _by_row(doc: np.ndarray, text_key: np.ndarray):
    """(doc, text key, row numbers in order) of each pair."""
    order = np.lexsort((text_key, doc))
    head = _heads(doc[order], text_key[order]).tolist()
    for i, j in zip(head, [*head[1:], len(order)]):
        yield int(doc[order[i]]), int(text_key[order[i]]), order[i:j]


def _row_owners(doc: np.ndarray, text_key: np.ndarray):
    """As `_owners`, for pairs that stand in order."""
    head = _heads(doc, text_key)
    owner = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(doc))))
    return _row_bytes(doc[head], text_key[head]), _deltas(owner)


def _row_bytes(doc, text_key) -> bytes:
    return np.stack([doc, text_key], 1).astype("<i8").tobytes()


def _rows_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8").reshape(-1, 2)


def _spread(doc, text_key) -> np.ndarray:
    """A hash of each pair: neither an id nor a text in many rows gathers."""
    return combine(np.asarray(doc, np.int64).view(np.uint64), np.asarray(text_key, np.int64).view(np.uint64))


def _batch(rows, schema):
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], [n for n, _ in fields])


def _deal_anchors(scheme, n_buckets, id, text):
    def send(held):
        doc, h = (np.concatenate(c) for c in zip(*held))
        # Equal anchors of this task: two documents say all there is to say.
        order = np.lexsort((doc, h))
        doc, h = doc[order], h[order]
        head = _heads(h)
        last = np.append(head[1:], len(h)) - 1
        keep = np.unique(np.concatenate([head, last]))
        keep = keep[np.argsort(doc[keep], kind="stable")]
        doc, h = doc[keep], h[keep]
        rows = [(b, *_owners(doc[at]), _planes(h[at], 6)) for b, at in _by((mix(h) % np.uint64(n_buckets)).astype(np.int64))]
        return _batch(rows, _ANCHORS)

    def run(batches):
        held, n = [], 0
        for ids, words, h in _pieces(batches, id, text):
            at, anchors = scheme.anchors(words, h)
            if len(at):
                held.append((ids[np.searchsorted(words.first, at, "right") - 1], anchors))
                n += len(at)
            if n >= HELD:
                yield send(held)
                held, n = [], 0
        if held:
            yield send(held)

    return run


def _bits(h: np.ndarray, size: int):
    """Two bit numbers below `size` for each anchor's low 48 bits."""
    x = mix(h & np.uint64((1 << 48) - 1))
    return (x >> np.uint64(32)) % np.uint64(size), (x & np.uint64(0xFFFFFFFF)) % np.uint64(size)


def _note_shared(size):
    """A bucket's anchors to its slice of the filter."""

    def run(key, packed):
        doc, h = [], []
        for docs, owners, keys in zip(*(packed.column(c).to_pylist() for c in ("docs", "owners", "keys"))):
            doc.append(np.frombuffer(docs, "<i8")[_undeltas(owners)])
            h.append(_unplanes(keys, 6))
        doc, h = np.concatenate(doc), np.concatenate(h)
        order = np.argsort(h, kind="stable")
        head = _heads(h[order])
        doc = doc[order]
        shared = h[order][head][np.minimum.reduceat(doc, head) < np.maximum.reduceat(doc, head)]
        bits = np.zeros(size, bool)
        for at in _bits(shared, size):
            bits[at] = True
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits).tobytes()])})

    return run


def _deal_windows(scheme, n_buckets, sent, size, id, text_key, text):
    """Windows around shared anchors to buckets; in rows of a negative bucket,
    the repeats that this task has settled itself."""

    def send(held):
        doc, of, place, a, b = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((doc, b, a))
        doc, of, place, a, b = doc[order], of[order], place[order], a[order], b[order]
        head = _heads(a, b)
        least = np.repeat(doc[head], np.diff(np.append(head, len(doc))))
        late = doc > least
        rows = []
        if late.any():
            docs, keys, starts = zip(*_starts(doc[late], of[late], place[late]))
            rows.append((-1 - int(_spread(docs[:1], keys[:1])[0]) % n_buckets, _row_bytes(docs, keys),
                         np.array([len(x) for x in starts], "<i8").tobytes(), b"".join(starts), b"", b""))
        # What is late is settled; the smallest document's copy goes on for all.
        keep = np.flatnonzero(~late)
        keep = keep[np.lexsort((place[keep], of[keep], doc[keep]))]
        for bucket, at in _by((mix(a[keep]) % np.uint64(n_buckets)).astype(np.int64)):
            at = keep[at]
            rows.append((bucket, *_row_owners(doc[at], of[at]), _deltas(place[at]), _planes(a[at], 8), _planes(b[at], 2)))
        return _batch(rows, _WINDOWS)

    def run(batches):
        table = sent.value
        held, n = [], 0
        for ids, text_keys, words, h in _pieces(batches, id, text_key, text):
            at, anchors = scheme.anchors(words, h)
            slot = (mix(anchors) % np.uint64(n_buckets)) * np.uint64(size)
            known = np.ones(len(at), bool)
            for bit in _bits(anchors, size):
                bit = bit + slot
                known &= (table[(bit >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (bit & np.uint64(7))).astype(np.uint8)) & 1 > 0
            at = at[known]
            if len(at):
                near = np.zeros(len(h) + 1, np.int64)
                np.add.at(near, np.maximum(at - scheme.period + 1, 0), 1)
                np.add.at(near, at + 1, -1)
                owner = words.owners()
                start = np.flatnonzero(np.cumsum(near[:-1]) > 0)
                start = start[start + scheme.width <= words.first[owner[start] + 1]]
                whole = windows(h, scheme.width)[start]
                again = windows(combine(h, h), scheme.width)[start] & np.uint64(0xFFFF)
                held.append((ids[owner[start]], text_keys[owner[start]], start - words.first[owner[start]], whole, again))
                n += len(start)
            if n >= HELD:
                yield send(held)
                held, n = [], 0
        if held:
            yield send(held)

    return run


def _starts(doc, text_key, place):
    for d, k, rows in _by_row(doc, text_key):
        yield d, k, np.unique(place[rows]).astype("<i4").tobytes()


def _name_repeats(n_parts):
    """One bucket's windows to repeats, packed by part of the documents."""

    def run(key, packed):
        columns = [packed.column(c).to_pylist() for c in ("docs", "owners", "places", "keys", "rest")]
        docs, starts = [], []
        if key[0].as_py() < 0:
            for d, sizes, data, *_ in zip(*columns):
                docs.extend(_rows_of(d).tolist())
                starts.extend(_cut(sizes, data))
        else:
            parts = [(*_rows_of(d)[_undeltas(o)].T, _undeltas(p), _unplanes(k, 8), _unplanes(r, 2))
                     for d, o, p, k, r in zip(*columns)]
            doc, of, place, a, b = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((b, a))
            doc, of, place, a, b = doc[order], of[order], place[order], a[order], b[order]
            head = _heads(a, b)
            late = doc > np.repeat(np.minimum.reduceat(doc, head), np.diff(np.append(head, len(doc)))) if len(doc) else []
            for d, k, data in _starts(doc[late], of[late], place[late]):
                docs.append((d, k))
                starts.append(data)
        docs = np.array(docs, np.int64).reshape(-1, 2)
        rows = []
        for part, at in _by((_spread(docs[:, 0].copy(), docs[:, 1].copy()) % np.uint64(n_parts)).astype(np.int64)):
            mine = [starts[i] for i in at]
            rows.append((part, docs[at].astype("<i8").tobytes(), np.array([len(x) for x in mine], "<i8").tobytes(), b"".join(mine)))
        return pa.Table.from_batches([_batch(rows, _FOUND)])

    return run


def _cut(sizes: bytes, data: bytes):
    ends = np.cumsum(np.frombuffer(sizes, "<i8")).tolist()
    return [data[i:j] for i, j in zip([0, *ends], ends)]


def _by_document(key, found):
    """All repeats of one part of the documents, a row for each document and text."""
    docs = [_rows_of(d) for d in found.column("docs").to_pylist()]
    starts = [x for s, d in zip(found.column("sizes").to_pylist(), found.column("starts").to_pylist()) for x in _cut(s, d)]
    docs = np.concatenate(docs)
    once = lambda at: np.unique(np.frombuffer(b"".join(starts[i] for i in at), "<i4")).tobytes()
    out = [(d, k, once(at)) for d, k, at in _by_row(docs[:, 0], docs[:, 1])]
    return pa.Table.from_batches([_batch(out, _HITS)])


def text_key(text: str):
    """Tells the texts of one doc_id apart, by 64 bits."""
    return F.xxhash64(F.col(text).cast("binary"))


def repeated_windows(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH,
                     filter_bits: int = FILTER_BITS) -> DataFrame:
    """doc_id, text_key (`text_key` of the text) and `starts`: little-endian int32
    places, each the first word of a window that also lies in a document with a
    smaller id. One row for each document and text that has any."""
    spark, scheme = docs.sparkSession, Scheme(width)
    text_size = text_bytes(docs, text)
    n = buckets_for(spark, text_size, BUCKET_BYTES)
    parts = buckets_for(spark, text_size, BUCKET_BYTES, 1)
    size = max(64, filter_bits // n // 8 * 8)
    slim = docs.select(F.col(id).cast("bigint").alias("doc_id"), text_key(text).alias("text_key"), F.col(text).alias("text"))
    anchors = slim.drop("text_key").mapInArrow(tidy(_deal_anchors(scheme, n, "doc_id", "text")), _ANCHORS)
    shared = np.zeros(n * size // 8, np.uint8)
    for row in anchors.groupBy("bucket").applyInArrow(tidy_group(_note_shared(size)), "bucket bigint, bits binary").collect():
        at = row["bucket"] * size // 8
        shared[at : at + size // 8] = np.frombuffer(row["bits"], np.uint8)
    sent = spark.sparkContext.broadcast(shared)
    found = slim.mapInArrow(tidy(_deal_windows(scheme, n, sent, size, "doc_id", "text_key", "text")), _WINDOWS)
    found = found.groupBy("bucket").applyInArrow(tidy_group(_name_repeats(parts)), _FOUND)
    return found.groupBy("part").applyInArrow(tidy_group(_by_document), _HITS)


def _removed(words: Words, starts: list, width: int) -> np.ndarray:
    """Words of a slice that a repeated window covers. `starts`: for each text
    the packed places, or None."""
    change = np.zeros(len(words) + width + 1, np.int32)
    for t, places in enumerate(starts):
        if places:
            at = words.first[t] + np.unique(np.frombuffer(places, "<i4"))
            # Were two texts of an id to share a key, no other text loses words.
            at = at[at + width <= words.first[t + 1]]
            np.add.at(change, at, 1)
            np.add.at(change, at + width, -1)
    return np.cumsum(change)[: len(words)] > 0


def kept_texts(words: Words, keep: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Ends and bytes of the texts' kept words, joined by one space."""
    rows = np.flatnonzero(keep)
    size = words.ends[rows] - words.starts[rows] + 1
    to = np.cumsum(size)
    at = np.repeat(words.starts[rows] - (to - size), size) + np.arange(to[-1] if len(to) else 0)
    data = np.append(words.data, np.uint8(32))[np.minimum(at, len(words.data))]
    data[to - 1] = 32
    n = np.searchsorted(rows, words.first[1:])
    return np.where(n > 0, np.append(0, to)[n], 0), data.tobytes()


def _apply(text, starts, width, finish):
    def run(batches):
        for batch in batches:
            column, hits = batch.column(text), batch.column(starts)
            for start, stop in slices(column):
                part = batch.slice(start, stop - start)
                words = Words(column.slice(start, stop - start))
                gone = _removed(words, hits.slice(start, stop - start).to_pylist(), width)
                ends, data = kept_texts(words, ~gone)
                begins = [0, *ends[:-1].tolist()]
                texts = [data[i : max(i, j - 1)] for i, j in zip(begins, ends.tolist())]
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[words.first])
                yield finish(part, words, removed, texts)

    return run


def _with_starts(docs: DataFrame, id: str, text: str, width: int, name: str) -> DataFrame:
    hits = repeated_windows(docs, id, text, width).select(
        F.col("doc_id").alias(f"{name}_id"), F.col("text_key").alias(f"{name}_key"), F.col("starts").alias(name))
    same = (F.col(id).cast("bigint") == F.col(f"{name}_id")) & (text_key(text) == F.col(f"{name}_key"))
    return docs.join(hits, same, "left").drop(f"{name}_id", f"{name}_key")


def substring_report(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row for each document: words, removed words, SHA-256 of the rest."""
    slim = docs.select("doc_id", "text")

    def finish(part, words, removed, texts):
        digest = [hashlib.sha256(t).hexdigest() for t in texts]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(words.counts(), pa.int64()), pa.array(removed, pa.int64()), pa.array(digest)],
            ["doc_id", "n_words", "n_removed", "kept_sha256"])

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    rows = _with_starts(slim, "doc_id", "text", width, "starts")
    return rows.mapInArrow(tidy(_apply("text", "starts", width, finish)), schema)


def drop_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """`docs` with repeated passages cut out of their texts: the kept words
    joined by one space. Texts that lose nothing stay as they are; a text that
    loses everything becomes empty."""
    name = fresh(docs, "starts")
    rows = _with_starts(docs, id, text, width, name)

    def finish(part, words, removed, texts):
        old = part.column(text).to_pylist()
        new = pa.array([t.decode("utf-8", "replace") if n else o for t, n, o in zip(texts, removed.tolist(), old)], pa.string())
        return pa.RecordBatch.from_arrays(
            [new if f.name == text else part.column(i) for i, f in enumerate(part.schema) if f.name != name],
            [f.name for f in part.schema if f.name != name])

    return rows.mapInArrow(tidy(_apply(text, name, width, finish)), docs.schema)
