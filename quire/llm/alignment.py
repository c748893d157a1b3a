"""Tokens of two tokenizers over the same bytes: common cuts, overlaps, id pairs.

1. Encode. Texts are cut where neither tokenizer can join anything (before a
   lone space inside a text) and a task codes each distinct piece once, as long
   as it keeps it.
   A text with a piece whose bytes don't come back is coded whole, and has no
   tokens if its bytes still don't come back.
2. Meet. Token ends of each side are ascending byte offsets. The shorter list
   drives: each of its ends gallops through the longer list (steps that double,
   then halving), from where the end before it stopped. Lanes of neighbouring
   ends do so side by side. Ends found in both lists cut the tokens into
   groups; the rank of an end and of the one before it give the range of tokens
   of the other side that overlap.
3. Count. A document's distinct id pairs are numbered within a group of
   documents of one task. Each pair of a group asks one bucket, chosen by the
   first id, so a bucket knows all pairs of its ids: it adds up in how many
   documents the pair occurs, finds each id's highest count, and answers.
4. Finish. Answers and stored documents of a group meet in order (answers
   first), so a task holds one group's counts and one slice of documents.

A pair is one row's entry for each group and bucket however many documents hold
it, so frequent pairs don't gather. Texts move once (as numbers of pairs) and
are coded once. Tokenizer files are read by the driver (their size is checked)
and sent as they are.

Defined cases: texts that are null, empty, or whose bytes don't come back have
no tokens and zero counts; special tokens' strings are plain text; every row
counts as one document, repeated rows and rows without id too; a text without
spaces is one piece; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage, drop_stored, store
from .substrings import _by, _heads, _planes, _unplanes
from .tables import buckets_for, text_bytes
from .words import mix, slices

#: Names of the vocabulary files in their folder.
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A vocabulary file may have so many bytes; its tokenizer is sent to all tasks.
MOST_BYTES = 64 << 20
#: Distinct pairs of a group of documents.
GROUP_PAIRS = 1 << 20
#: Bytes of text whose pairs meet in one bucket.
PER_BUCKET = 32 << 20
#: Pieces that a task keeps coded, beyond which it begins anew, and pieces coded at once.
KNOWN_PIECES, AT_ONCE = 250_000, 8192
#: Bytes of text that a task turns into arrays at once.
SLICE_BYTES = 2 << 20
#: Neighbouring ends that one lane looks up.
LANE = 64

BAR = "▁"
_STORED = ("group bigint, bucket bigint, pairs binary, places binary, numbers binary, "
           "docs array<bigint>, cuts array<string>, stats binary, links binary")
_ANSWERS = "group bigint, counts binary, best binary, places binary"
_REPORT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
           "count_sum bigint, groups_sha256 string")
_ALIGNED = "doc_id bigint, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"

# Bytes that stand for themselves in byte-level vocabularies.
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: itself, or for the
    others in order the letters from 256 on."""
    rest = [b for b in range(256) if b not in PLAIN_BYTES]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, from the bytes of their files."""

    def __init__(self, file_a: bytes, file_b: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.files = file_a, file_b
        self.a = Tokenizer.from_str(file_a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        letters = byte_letters()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for piece, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.table_a, self.table_b = (pa.array(v, pa.large_binary()) for v in (self.bytes_a, self.bytes_b))
        self.length_a, self.length_b = (np.array([len(x) for x in v], np.int64) for v in (self.bytes_a, self.bytes_b))
        # Texts may be cut where no piece of B crosses and where A's pattern ends.
        shape = json.loads(file_a)
        split = shape.get("pre_tokenizer") or {}
        crossing = any(BAR in self.b.id_to_piece(i).lstrip(BAR) for i in range(self.b.get_piece_size()))
        self.cuts = split.get("type") == "ByteLevel" and bool(split.get("use_regex")) and not shape.get("normalizer") and not crossing

    def __reduce__(self):
        # A pickled tokenizer forgets that special tokens' strings are plain text.
        return Tokenizers, self.files

    def _piece(self, i):
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace(BAR, " ").encode()

    def encode(self, pieces: pa.Array):
        """For each side (ids end to end, ids per piece), and whether the bytes
        of both come back; every piece begins with a space."""
        runs = []
        for start in range(0, len(pieces), AT_ONCE):
            texts = [p.decode("utf-8", "replace") for p in pieces[start : start + AT_ONCE].to_pylist()]
            runs.append((_flat([e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]),
                         _flat(self.b.encode([t[1:] for t in texts], num_threads=1))))
        ids_a, ids_b = (tuple(np.concatenate(c) for c in zip(*side)) for side in zip(*runs))
        good = self._back(pieces, *ids_a, self.table_a) & self._back(pieces, *ids_b, self.table_b)
        return ids_a, ids_b, good

    def _back(self, pieces, ids, sizes, table):
        """Whether each piece's tokens have just its bytes."""
        tokens = table.take(pa.array(ids))
        ends = np.append(0, np.cumsum(_lengths(tokens)))[np.append(0, np.cumsum(sizes))]
        got, want = _data(tokens), _data(pieces)
        if np.array_equal(np.diff(ends), _lengths(pieces)) and np.array_equal(got, want):
            return np.ones(len(pieces), bool)
        return np.array([got[i:j].tobytes() == p for i, j, p in zip(ends, ends[1:], pieces.to_pylist())], bool)


def _lengths(array: pa.Array) -> np.ndarray:
    return np.diff(np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1])


def _data(array: pa.Array) -> np.ndarray:
    places = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = array.buffers()[2]
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]] if data else np.zeros(0, np.uint8)


_LOADED: dict = {}


def _tokenizers(sent) -> Tokenizers:
    """The worker's copy of the tokenizers that were sent."""
    files = sent.value
    key = hashlib.sha256(files[0] + files[1]).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Tokenizers(*files)
    return _LOADED[key]


def send_files(spark: SparkSession, folder: str):
    """The tokenizers' files, sent to the tasks."""
    files = []
    for name in (FILE_A, FILE_B):
        with open(os.path.join(folder, name), "rb") as file:
            files.append(file.read())
        if len(files[-1]) > MOST_BYTES:
            raise ValueError(f"{name} has {len(files[-1])} bytes, more than {MOST_BYTES}")
    return spark.sparkContext.broadcast(tuple(files))


# Bytes before and after a space where a text may be cut: no space or bar
# before, no white space (ASCII or the first byte of a wider one) after.
_BEFORE = np.ones(256, bool)
_BEFORE[[0x20, 0x81]] = False
_AFTER = np.ones(256, bool)
_AFTER[[*range(0x21), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3]] = False


def _pieces(parts: list[bytes], cut: bool):
    """(the texts' bytes end to end, where pieces start, where texts start)."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    first = np.cumsum([0, *map(len, parts)])[:-1]
    at = np.zeros(len(data), bool)
    if cut:
        at[1:-1] = (data[1:-1] == 0x20) & _BEFORE[data[:-2]] & _AFTER[data[2:]]
    at[first] = True
    return data, np.flatnonzero(at), first


def _flat(lists):
    sizes = np.fromiter((len(x) for x in lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes


def _gather(values, sizes, index):
    """The runs `index` of `values`, one after the other, and their sizes."""
    begin = np.cumsum(sizes) - sizes
    n = sizes[index]
    shift = begin[index] - (np.cumsum(n) - n)
    return values[np.repeat(shift, n) + np.arange(n.sum())], n


class _Known:
    """Pieces that a task has coded, and their ids by both sides end to end."""

    def __init__(self, tools: Tokenizers):
        self.tools = tools
        self.clear()

    def clear(self):
        none = np.zeros(0, np.int64)
        self.pieces, self.good = pa.array([], pa.large_binary()), np.zeros(0, bool)
        self.sides = [(none, none), (none, none)]

    def places(self, pieces: pa.Array) -> np.ndarray:
        """Where distinct pieces stand among the known ones; new ones are coded."""
        if len(self.pieces) > KNOWN_PIECES:
            self.clear()
        at = pc.index_in(pieces, value_set=self.pieces)
        new = pieces.filter(at.is_null())
        at = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        at[at < 0] = len(self.pieces) + np.arange(len(new))
        if len(new):
            ids_a, ids_b, good = self.tools.encode(new)
            self.pieces = pa.concat_arrays([self.pieces, new])
            self.good = np.concatenate([self.good, good])
            self.sides = [tuple(np.concatenate(x) for x in zip(side, ids)) for side, ids in zip(self.sides, (ids_a, ids_b))]
        return at


def _coded(known: _Known, parts: list[bytes], cut: bool):
    """Tokens and tokens per text of both sides, and which texts came back."""
    data, start, first = _pieces(parts, cut)
    offsets = np.append(start, len(data)).astype(np.int64)
    array = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = array.dictionary_encode()
    number = known.places(coded.dictionary)[coded.indices.to_numpy(zero_copy_only=False)]
    heads = np.searchsorted(start, first)
    fine = np.logical_and.reduceat(known.good[number], heads)
    out = []
    for side in known.sides:
        tokens, n = _gather(*side, number)
        out.append((tokens, np.add.reduceat(n, heads)))
    return *out, fine


class Coded:
    """Tokens of texts: of text `rows[t]` the tokens that `first_a[t]` and
    `first_b[t]` cut out of `a` and `b`; ends are byte offsets over all texts."""

    def __init__(self, known: _Known, texts: list):
        tools = known.tools
        todo = [(i, b" " + t.encode()) for i, t in enumerate(texts) if t]
        runs, rows = [], []
        for cut in ([True, False] if tools.cuts else [False]):
            if not todo:
                break
            a, b, fine = _coded(known if cut else _Known(tools), [p for _, p in todo], cut)
            runs.append(tuple((v[np.repeat(fine, n)], n[fine]) for v, n in (a, b)))
            rows += [i for (i, _), f in zip(todo, fine) if f]
            todo = [x for x, f in zip(todo, fine) if not f]
        self.rows = np.array(rows, np.int64)
        empty = np.zeros(0, np.int64)
        join = lambda side, k: np.concatenate([empty, *(r[side][k] for r in runs)])  # as 64 bits
        self.a, self.b = join(0, 0), join(1, 0)
        self.first_a, self.first_b = (np.concatenate([[0], np.cumsum(join(s, 1))]) for s in (0, 1))
        self.ends_a, self.ends_b = np.cumsum(tools.length_a[self.a]), np.cumsum(tools.length_b[self.b])


def gallop(short: np.ndarray, long: np.ndarray, lane: int = LANE) -> np.ndarray:
    """How many values of `long` lie below each value of `short`; both ascend.

    Each lane of neighbours goes on from the place of the value before: steps
    double until they pass the value, then the last step is halved."""
    n, m = len(short), len(long)
    if not n:
        return np.zeros(0, np.int64)
    lanes = -(-n // lane)
    goals = np.full(lanes * lane, short[-1])
    goals[:n] = short
    goals = goals.reshape(lanes, lane)
    long = np.append(long, np.iinfo(np.int64).max)
    out = np.empty((lanes, lane), np.int64)
    # Lanes begin where the lanes' first values gallop to from each other.
    at = gallop(goals[:, 0].copy(), long[:-1], lane) if lanes > 1 else np.zeros(1, np.int64)
    for step in range(lane):
        goal = goals[:, step].copy()
        open_ = np.flatnonzero(long[at] < goal)
        if len(open_):
            low, aim = at[open_], goal[open_]
            high, stride, todo = np.minimum(low + 1, m), 1, np.arange(len(open_))
            while len(todo):
                todo = todo[long[high[todo]] < aim[todo]]
                stride *= 2
                low[todo] = high[todo]
                high[todo] = np.minimum(high[todo] + stride, m)
            todo = np.flatnonzero(high - low > 1)
            while len(todo):
                middle = (low[todo] + high[todo]) >> 1
                below = long[middle] < aim[todo]
                low[todo[below]] = middle[below]
                high[todo[~below]] = middle[~below]
                todo = todo[high[todo] - low[todo] > 1]
            at[open_] = high
        out[:, step] = at
    return out.reshape(-1)[:n]


def align(coded: Coded):
    """(cut_a, cut_b, link_a, link_b): token numbers of both sides at which
    groups end (exclusive), and the token numbers of each overlapping pair."""
    ends_a, ends_b = coded.ends_a, coded.ends_b
    swap = len(ends_b) < len(ends_a)
    short, long = (ends_b, ends_a) if swap else (ends_a, ends_b)
    rank = gallop(short, long)
    common = np.append(long, -1)[rank] == short
    at = np.flatnonzero(common)
    cut_short, cut_long = at + 1, rank[at] + 1
    low = np.zeros(len(short), np.int64)
    low[1:] = rank[:-1] + common[:-1]
    n = rank - low + 1
    one = np.repeat(np.arange(len(short)), n)
    two = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(len(one))
    return (cut_long, cut_short, two, one) if swap else (cut_short, cut_long, one, two)


def _cut_words(coded: Coded, cut_a, cut_b, table: pa.Array, offset_b: int):
    """For each text `a1,a2|b1;...`, as bytes. `table` holds each id of both
    sides with a comma and with its closing mark."""
    n_a, n_b = len(coded.a), len(coded.b)
    closes_a, closes_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    closes_a[cut_a - 1] = 1
    closes_b[cut_b - 1] = 1
    group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
    order = np.empty(n_a + n_b, np.int64)
    order[np.arange(n_a) + np.concatenate([[0], cut_b])[group_a]] = 2 * coded.a + closes_a
    order[np.arange(n_b) + cut_a[group_b]] = 2 * (coded.b + offset_b) + closes_b
    words = table.take(pa.array(order))
    places = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1)
    data = words.buffers()[2]
    ends = places[coded.first_a + coded.first_b]
    return [data[int(i) : int(j) - 1] for i, j in zip(ends[:-1], ends[1:])]


def _id_table(tools: Tokenizers) -> pa.Array:
    names = []
    for size, close in ((len(tools.bytes_a), "|"), (len(tools.bytes_b), ";")):
        names += [f"{i}{mark}" for i in range(size) for mark in (",", close)]
    return pa.array(names, pa.large_string())


def _texts(batches):
    """(ids, texts) of slices of bounded size."""
    for batch in batches:
        column = batch.column(1)
        for start, stop in slices(column, SLICE_BYTES):
            part = slice(start, stop)
            yield batch.column(0)[part], column[part].to_pylist()


class _Group:
    """Distinct pairs of the documents that a task has seen since it last sent."""

    def __init__(self, number):
        self.number, self.pairs, self.counts = number, pa.array([], pa.int64()), np.zeros(0, np.int64)

    def add(self, pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Note distinct pairs of a slice; their places in the group."""
        both = pa.chunked_array([self.pairs, pa.array(pairs)]).combine_chunks().dictionary_encode()
        place = both.indices.to_numpy(zero_copy_only=False)[len(self.pairs) :]
        grown = np.zeros(len(both.dictionary), np.int64)
        grown[: len(self.counts)] = self.counts
        grown[place] += counts
        self.pairs, self.counts = both.dictionary, grown
        return place

    def rows(self, n_buckets):
        pairs = self.pairs.to_numpy()
        bucket = (mix((pairs >> 32).view(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
        for b, at in _by(bucket):
            yield (self.number, b, _planes(pairs[at].view(np.uint64), 8), _planes(at.astype(np.uint64), 4),
                   _planes(self.counts[at].astype(np.uint64), 4), None, None, None, None)


_SCHEMA = pa.schema([
    ("group", pa.int64()), ("bucket", pa.int64()), ("pairs", pa.binary()), ("places", pa.binary()), ("numbers", pa.binary()),
    ("docs", pa.list_(pa.int64())), ("cuts", pa.list_(pa.string())), ("stats", pa.binary()), ("links", pa.binary())])


def _stored(rows):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def _encode(sent, n_buckets):
    """Slices of documents as numbers of pairs, and what groups ask of buckets."""

    def run(batches):
        tools = _tokenizers(sent)
        known = _Known(tools)
        table = _id_table(tools)
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        group = _Group(number)
        for ids, texts in _texts(batches):
            coded = Coded(known, texts)
            stats = np.zeros((len(texts), 5), np.int64)
            cuts, links = [""] * len(texts), b""
            if len(coded.rows):
                cut_a, cut_b, one, two = align(coded)
                owner = np.repeat(np.arange(len(coded.rows)), np.diff(coded.first_a))[one]
                pairs = pa.array((coded.a[one] << 32) | coded.b[two]).dictionary_encode()
                distinct = pairs.dictionary.to_numpy()
                held = owner * len(distinct) + pairs.indices.to_numpy(zero_copy_only=False)
                held.sort()
                head = _heads(held)
                times = np.diff(np.append(head, len(held)))
                doc, pair = np.divmod(held[head], len(distinct))
                place = group.add(distinct, np.bincount(pair, minlength=len(distinct)))
                links = _planes(place[pair].astype(np.uint64), 4) + _planes(times.astype(np.uint64), 4)
                n_docs = len(coded.rows)
                stats[coded.rows] = np.stack([
                    np.diff(coded.first_a), np.diff(coded.first_b),
                    np.diff(np.searchsorted(cut_a, coded.first_a, "right")),
                    np.bincount(owner, minlength=n_docs), np.bincount(doc, minlength=n_docs)], 1)
                for row, data in zip(coded.rows.tolist(), _cut_words(coded, cut_a, cut_b, table, len(tools.bytes_a))):
                    cuts[row] = hashlib.sha256(data).hexdigest()
            order = coded.rows.astype("<i8").tobytes()
            yield _stored([(group.number, None, None, None, order, ids.to_pylist(), cuts, stats.astype("<i8").tobytes(), links)])
            if len(group.pairs) >= GROUP_PAIRS:
                yield _stored(list(group.rows(n_buckets)) or [])
                number += 1
                group = _Group(number)
        if len(group.pairs):
            yield _stored(list(group.rows(n_buckets)))

    return run


def _answer(key, asked):
    """A bucket's counts of documents, and whether a count is its first id's highest."""
    columns = [asked.column(c).to_pylist() for c in ("group", "pairs", "places", "numbers")]
    pairs = [_unplanes(p, 8) for p in columns[1]]
    sizes = [len(p) for p in pairs]
    distinct, place = np.unique(np.concatenate(pairs), return_inverse=True)
    counts = np.bincount(place, np.concatenate([_unplanes(n, 4) for n in columns[3]]).astype(np.float64)).astype(np.int64)
    first = (distinct >> np.uint64(32)).astype(np.int64)
    head = _heads(first)
    highest = np.repeat(np.maximum.reduceat(counts, head), np.diff(np.append(head, len(first))))
    best = counts == highest
    rows = []
    for group, places, part in zip(columns[0], columns[2], np.split(place, np.cumsum(sizes)[:-1])):
        rows.append((group, _planes(counts[part].astype(np.uint64), 8), best[part].tobytes(), places))
    return pa.table({n: pa.array(c, k) for (n, k), c in zip(
        (("group", pa.int64()), ("counts", pa.binary()), ("best", pa.binary()), ("places", pa.binary())), zip(*rows))})


def _finish(batches):
    """Rows in order: a group's answers, then its slices of documents."""
    group, answers, counts, best = None, [], None, None
    for batch in batches:
        for i in range(batch.num_rows):
            at = {n: batch.column(n)[i].as_py() for n in ("group", "counts", "best", "places")}
            if at["group"] != group:
                group, answers, counts = at["group"], [], None
            if at["counts"] is not None:
                answers.append((_unplanes(at["places"], 4).astype(np.int64), _unplanes(at["counts"], 8).astype(np.int64),
                                np.frombuffer(at["best"], bool)))
                continue
            if counts is None:
                n = sum(len(p) for p, _, _ in answers)
                counts, best = np.zeros(n, np.int64), np.zeros(n, bool)
                for places, c, b in answers:
                    counts[places], best[places] = c, b
                answers = []
            docs, cuts, stats, links, numbers = (batch.column(n)[i].as_py() for n in ("docs", "cuts", "stats", "links", "numbers"))
            stats, rows = np.frombuffer(stats, "<i8").reshape(-1, 5), np.frombuffer(numbers, "<i8")
            half = len(links) // 2
            place, times = _unplanes(links[:half], 4).astype(np.int64), _unplanes(links[half:], 4).astype(np.int64)
            sums = np.zeros((2, len(docs)), np.int64)
            owner = np.repeat(rows, stats[rows, 4])
            np.add.at(sums[0], owner, times * best[place])
            np.add.at(sums[1], owner, times * counts[place])
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), *(pa.array(stats[:, k]) for k in range(4)), pa.array(sums[0]), pa.array(sums[1]),
                 pa.array(cuts)],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def _slim(docs, id, text):
    return docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))


def alignment_report(docs: DataFrame, folder: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of `docs`: tokens of both sides, groups, links, how
    many links carry the count that is their first id's highest, the sum of the
    links' counts, and a digest of the groups. `folder` holds the vocabularies."""
    spark = docs.sparkSession
    slim = _slim(docs, id, text)
    n = buckets_for(spark, text_bytes(slim), PER_BUCKET, 1)
    sent, paths = send_files(spark, folder), []
    try:
        stored, path = store(slim.mapInArrow(_encode(sent, n), _STORED), "aligned")
        paths.append(path)
        answers = stored.where("bucket is not null").select("group", "bucket", "pairs", "places", "numbers").groupBy(
            "bucket").applyInArrow(_answer, _ANSWERS)
        empty = lambda names, kind: [F.lit(None).cast(kind).alias(x) for x in names.split()]
        told = answers.select("group", F.lit(0).alias("kind"), "counts", "best", "places", *empty("docs", "array<bigint>"),
                              *empty("cuts", "array<string>"), *empty("stats links numbers", "binary"))
        parts = stored.where("bucket is null").select("group", F.lit(1).alias("kind"), *empty("counts best places", "binary"),
                                                      "docs", "cuts", "stats", "links", "numbers")
        met = told.unionByName(parts).repartition("group").sortWithinPartitions("group", "kind")
        return cut_lineage(met.mapInArrow(_finish, _REPORT))
    finally:
        for path in paths:
            drop_stored(spark, path)
        sent.destroy()


def align_tokens(docs: DataFrame, folder: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of both sides for each document, and where its groups end:
    group g holds the tokens from cut g-1 to cut g of each side."""
    sent = send_files(docs.sparkSession, folder)

    def run(batches):
        known = _Known(_tokenizers(sent))
        for ids, texts in _texts(batches):
            coded = Coded(known, texts)
            cut_a, cut_b, _, _ = align(coded)
            out = [([], [], [], []) for _ in texts]
            at = np.searchsorted(cut_a, coded.first_a, "right")
            for t, row in enumerate(coded.rows.tolist()):
                i, j, k, m = coded.first_a[t], coded.first_a[t + 1], coded.first_b[t], coded.first_b[t + 1]
                out[row] = (coded.a[i:j], coded.b[k:m], cut_a[at[t] : at[t + 1]] - i, cut_b[at[t] : at[t + 1]] - k)
            lists = [pa.array([o[s] for o in out], pa.list_(pa.int32())) for s in range(4)]
            yield pa.RecordBatch.from_arrays([ids, *lists], ["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"])

    return _slim(docs, id, text).mapInArrow(run, _ALIGNED)


def id_pairs(docs: DataFrame, folder: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b, n_docs): in how many documents tokens of these ids overlap."""
    sent = send_files(docs.sparkSession, folder)

    def run(batches):
        known = _Known(_tokenizers(sent))
        for _, texts in _texts(batches):
            coded = Coded(known, texts)
            _, _, one, two = align(coded)
            owner = np.repeat(np.arange(len(coded.rows)), np.diff(coded.first_a))[one]
            pairs = pa.array((coded.a[one] << 32) | coded.b[two]).dictionary_encode()
            distinct = pairs.dictionary.to_numpy()
            held = np.unique(owner * max(1, len(distinct)) + pairs.indices.to_numpy(zero_copy_only=False))
            n = np.bincount(held % max(1, len(distinct)), minlength=len(distinct))
            yield pa.RecordBatch.from_arrays(
                [pa.array(distinct >> 32), pa.array(distinct & 0xFFFFFFFF), pa.array(n)], ["a", "b", "n"])

    parts = _slim(docs, id, text).mapInArrow(run, "a bigint, b bigint, n bigint")
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n_docs"))
