"""Near-duplicate documents by one-permutation MinHash.

1. Sign. A document's set is its distinct word shingles. One hash of each
   shingle gives its bin (the top bits) and its value; the least value of each
   bin is kept, and an empty bin takes the value of a bin that is filled,
   found by a fixed random walk over the bins (optimal densification). The
   rows of signatures are stored once.
2. Bands. Signatures are cut into bands. Documents that agree on a band share
   a bucket. Equal sets count once, as a class.
3. Stars. A bucket links its members to one hub only. Each task settles the
   buckets among the documents that it holds and sends on one hub for each,
   so a bucket never receives more than one row from a task.
4. Span. A member keeps the link to the hub that it shares most buckets with,
   if the full sets agree; what that joins is one node from then on, and of the
   links that are left each node again keeps its best few (`PER_NODE`), twice.
   So links are as many as documents, however many buckets they share.
5. Rest. Where a bucket's members still lie in different components, those
   outside its largest component meet all members of other components in tiles
   of bounded size, dealt over the tasks; of the bands that a pair shares only
   the first one looks at it. Pairs with like signatures stay packed in their
   tile and are confirmed there on full sets, skipping those that the tile has
   joined by then; a tile sends on the links of a forest. So no pair that shares
   a bucket is left unjudged, however large the bucket, and pairs never become rows.

With 51 bands of 5 bins a pair at similarity 0.8 shares no bucket with a chance
of 2e-9. The signature test in steps 4 and 5 drops a pair at 0.8 with a chance
of 1e-6.

Defined cases: a null text, an empty one, or one of whitespace has an empty set
and is linked with nothing; texts of fewer words than a shingle are one
shingle; equal rows are linked; rows of one doc_id with different texts are one
node, linked by whichever of their sets agrees; rows without doc_id get no
component and stay; very long texts are one set of their own in a task; an empty
table gives an empty result; other columns are not read, and stay in
`drop_near_duplicates`, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage, drop_stored, store
from .components import PER_TASK, components
from .substrings import _by, _heads, _planes, _unplanes
from .tables import buckets_for, fresh
from .words import NON_SPACE, Words, combine, mix, slices, tidy, tidy_group, windows

BINS, BANDS, ROWS = 256, 51, 5
#: Share of equal bins below which a pair is not confirmed: 5 deviations
#: below a similarity of 0.8.
LIKELY = 0.675
#: Bucket rows that a task holds before it settles and sends them.
HELD = 1 << 20
#: Rows (documents times bands) that meet in one task.
PER_BUCKET = 1 << 20
#: Ids that may travel to every task; more are joined by a shuffle.
SENT_IDS = 500_000
#: Bytes of sets or signatures that may travel to every task.
SENT_BYTES = 16 << 20
#: Links that a node keeps for confirmation: the best of each class of other nodes.
PER_NODE = 4
#: Members on one side of a tile, and rows of tiles that meet in one task.
TILE_DOCS, TILE_ROWS = 1024, 4096
#: Signature bytes compared at once.
AT_ONCE = 64 << 20

_SIGNED = "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, keys binary, signature binary"
_STARS = "key bigint, hub bigint, member bigint"
_DEALT = "bucket bigint, keys binary, hubs binary, members binary"


def shingle_sets(words: Words, size: int):
    """Sorted distinct shingle hashes of each text and where each text begins."""
    h, n = words.hashes(), words.counts()
    runs = windows(h, size)
    first = np.concatenate([[0], np.cumsum(np.where(n >= size, n - size + 1, n > 0))])
    out = np.empty(first[-1], np.uint64)
    for t in range(len(n)):
        i, j = words.first[t], words.first[t + 1]
        if n[t] >= size:
            part = runs[i : j - size + 1]
        elif n[t]:
            part = windows(h[i:j], int(n[t])) ^ np.uint64(0x5555555555555555)
        else:
            continue
        out[first[t] : first[t + 1]] = np.sort(part)
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[first[:-1][first[:-1] < len(out)]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[first]


def _walk():
    """For each bin the other bins in a fixed random order."""
    rng = np.random.default_rng(20240229)
    return np.stack([rng.permutation(BINS) for _ in range(BINS)]).astype(np.int16)


_ORDER = _walk()


def signatures(sets: np.ndarray, first: np.ndarray):
    """Densified bins (texts x BINS, uint32) of sorted shingle sets."""
    n = len(first) - 1
    owner = np.repeat(np.arange(n), np.diff(first))
    scrambled = mix(sets)
    order = np.lexsort((scrambled, owner))
    scrambled = scrambled[order]
    slot = owner * BINS + (scrambled >> np.uint64(56)).astype(np.int64)
    head = _heads(slot)
    bins = np.zeros(n * BINS, np.uint32)
    filled = np.zeros(n * BINS, bool)
    bins[slot[head]] = (scrambled[head] >> np.uint64(20)).astype(np.uint32)
    filled[slot[head]] = True
    some = np.repeat(np.diff(first) > 0, BINS)
    todo = np.flatnonzero(some & ~filled)
    source = np.arange(n * BINS)
    for step in range(BINS):
        if not len(todo):
            break
        look = todo // BINS * BINS + _ORDER[todo % BINS, step]
        ok = filled[look]
        source[todo[ok]] = look[ok]
        todo = todo[~ok]
    return bins[source].reshape(n, BINS)


def _sign(size):
    def run(batches):
        for batch in batches:
            column = batch.column(1)
            for start, stop in slices(column):
                words = Words(column.slice(start, stop - start), NON_SPACE, lower=True)
                sets, first = shingle_sets(words, size)
                n = np.diff(first)
                bins = signatures(sets, first).astype(np.uint64)
                keys = np.empty((len(n), BANDS), np.uint64)
                for band in range(BANDS):
                    key = np.full(len(n), band, np.uint64)
                    for k in range(band * ROWS, band * ROWS + ROWS):
                        key = combine(key, bins[:, k])
                    keys[:, band] = key
                short = np.concatenate([mix(bins).astype(np.uint8), keys.astype("<u4").view(np.uint8)], 1)
                total = lambda v: np.diff(np.concatenate([np.zeros(1, np.uint64), np.cumsum(v)])[first]).view(np.int64)
                some = n > 0
                blob = lambda rows: pa.array([r.tobytes() if s else None for r, s in zip(rows, some)], pa.binary())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, stop - start), pa.array(n, pa.int64()),
                    pa.array(total(mix(sets))), pa.array(total(mix(sets ^ np.uint64(0x9E3779B97F4A7C15)))),
                    blob(keys), blob(short)],
                    ["doc_id", "n_shingles", "s1", "s2", "keys", "signature"])

    return run


def _rank(key, member):
    """Which of a bucket's members becomes its hub. One of two orders, chosen by
    the bucket, so that the hubs of a group are few but not the same everywhere."""
    return mix(member ^ ((key >> np.uint64(7)) & np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def _star(key, member):
    """(key, hub, member) of all rows sorted by key; the hub stands first."""
    order = np.lexsort((_rank(key, member), key))
    key, member = key[order], member[order]
    once = _heads(key, member)
    key, member = key[once], member[once]
    head = _heads(key)
    size = np.diff(np.append(head, len(key)))
    return key, np.repeat(member[head], size), member, head, np.repeat(size, size)


def _deal(n_buckets):
    def send(held):
        key, member = (np.concatenate(c) for c in zip(*held))
        key, hub, member, head, size = _star(key, member)
        rows = [(b, _planes(key[at], 8), None, _planes(member[at], 8))
                for b, at in _by((mix(key[head]) % np.uint64(n_buckets)).astype(np.int64)) for at in [head[at]]]
        many = size > 1
        if many.any():
            b = -1 - int(key[0] % np.uint64(n_buckets))
            rows.append((b, *(_planes(x[many], 8) for x in (key, hub, member))))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3))],
            ["bucket", "keys", "hubs", "members"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64)
            members = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            held.append((keys, np.repeat(members, BANDS)))
            n += len(keys)
            if n >= HELD:
                yield send(held)
                held, n = [], 0
        if n:
            yield send(held)

    return run


def _signed_column(values):
    return pa.array(values.view(np.int64), pa.int64())


def _meet(key, dealt):
    """A bucket of band keys to the stars of those with two or more members."""
    columns = [dealt.column(c).to_pylist() for c in ("keys", "hubs", "members")]
    if key[0].as_py() < 0:
        parts = [tuple(_unplanes(x, 8) for x in row) for row in zip(*columns)]
        keys, hubs, members = (np.concatenate(c) for c in zip(*parts))
    else:
        parts = [(_unplanes(k, 8), _unplanes(m, 8)) for k, _, m in zip(*columns)]
        keys, hubs, members, _, size = _star(*(np.concatenate(c) for c in zip(*parts)))
        keys, hubs, members = keys[size > 1], hubs[size > 1], members[size > 1]
    return pa.table({n: _signed_column(v) for n, v in (("key", keys), ("hub", hubs), ("member", members))})


def _to_reps(links, classes):
    """Links between classes, and how many buckets each stands for, as links
    between the classes' least documents."""
    reps = classes.select("s1", "rep")
    a = reps.select(F.col("s1").alias("hub"), F.col("rep").alias("x"))
    b = reps.select(F.col("s1").alias("member"), F.col("rep").alias("y"))
    both = links.join(a, "hub").join(b, "member").where(F.col("x") != F.col("y"))
    return both.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.sum("n").alias("n"))


def _marks(column):
    """A byte of each bin, and 32 bits of each band's key, of stored signatures."""
    rows = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS + 4 * BANDS)
    return rows[:, :BINS], np.ascontiguousarray(rows[:, BINS:]).view("<u4")


def _likely(one: str, two: str):
    """Pairs whose signatures agree often enough, row by row."""

    def run(batches):
        for batch in batches:
            x, y = (_marks(batch.column(c))[0] for c in (one, two))
            ok = (x == y).sum(1) >= LIKELY * BINS
            yield batch.filter(pa.array(ok)).select(["a", "b"])

    return run


def _reach(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _alike(percent: int):
    """Pairs whose full sets reach the similarity."""

    def run(batches):
        for batch in batches:
            ok = [_reach(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                  for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())]
            yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    return run


def _confirm(pairs, sets, percent):
    x = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"), F.col("n").alias("nx"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"), F.col("n").alias("ny"))
    close = F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent
    rows = pairs.join(x, "a").join(y, "b").where(close).select("a", "b", "x", "y")
    return rows.mapInArrow(tidy(_alike(percent)), "a bigint, b bigint")


def _set_rows(size):
    def run(batches):
        for batch in batches:
            column = batch.column(1)
            for start, stop in slices(column):
                sets, first = shingle_sets(Words(column.slice(start, stop - start), NON_SPACE, lower=True), size)
                blobs = [sets[i:j].tobytes() for i, j in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(np.diff(first), pa.int64()), pa.array(blobs, pa.binary())],
                    ["doc_id", "n", "shingles"])

    return run


def _mixed_keys(members: DataFrame) -> DataFrame:
    """Buckets with two or more components, the largest of them, and in how many
    blocks the members outside it (`n_x`) and all members (`n_y`) are cut."""
    parts = members.groupBy("key", "component").count()
    keys = parts.groupBy("key").agg(
        F.max_by("component", F.struct("count", "component")).alias("largest"), F.max("count").alias("inside"),
        F.sum("count").alias("all"), F.count("*").alias("parts")).where("parts > 1")
    blocks = lambda n: F.ceil(n / F.lit(TILE_DOCS)).cast("int")
    keys = keys.withColumn("n_x", blocks(F.col("all") - F.col("inside"))).withColumn("n_y", blocks(F.col("all")))
    return keys.select("key", "largest", "n_x", "n_y", ((F.col("all") - F.col("inside")) * F.col("n_y") + F.col("all") * F.col("n_x")).alias("rows"))


def _tiles(members: DataFrame, keys: DataFrame, signs: DataFrame) -> DataFrame:
    """Rows of tiles. Those of side 0 are the members (key, doc_id, component)
    outside the largest component, those of side 1 all members; each block of
    one side meets each block of the other."""
    rows = members.join(keys.drop("rows"), "key")
    own = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    x = rows.where("component <> largest").withColumn("i", own("n_x")).withColumn("j", each("n_y")).withColumn("side", F.lit(0))
    y = rows.withColumn("j", own("n_y")).withColumn("i", each("n_x")).withColumn("side", F.lit(1))
    names = ["key", "i", "j", "side", "doc_id", "component", "largest"]
    return x.select(*names).union(y.select(*names)).join(signs, "doc_id")


def _likely_tiles(key, rows):
    """Pairs of the tiles of one bucket that lie in different components and
    have like signatures: their documents and components, and the pairs as
    numbers into them. A pair of two outside the largest component is looked at
    from its smaller side; the first band that a pair shares speaks for it."""
    names = ("key", "i", "j", "side", "doc_id")
    columns = {n: rows.column(n).to_numpy() for n in names}
    order = np.lexsort([columns[n] for n in reversed(names)])
    rows = rows.take(pa.array(order))
    keys, tile_i, tile_j, side, docs, parts, largest = (
        rows.column(c).to_numpy() for c in ("key", "i", "j", "side", "doc_id", "component", "largest"))
    signs, bands = _marks(rows.column("signature"))
    found = []
    head = _heads(keys, tile_i, tile_j).tolist()
    for i, j in zip(head, [*head[1:], len(keys)]):
        k = i + int(np.searchsorted(side[i:j], 1))
        if k in (i, j):
            continue
        this = int(np.flatnonzero(bands[i] == np.uint32(int(keys[i]) & 0xFFFFFFFF))[0])
        step = max(1, AT_ONCE // (BINS * (j - k)))
        for start in range(i, k, step):
            mine = np.arange(start, min(k, start + step))
            y = np.arange(k, j)
            ask = parts[mine][:, None] != parts[None, y]
            ask &= (parts[None, y] == largest[i]) | (docs[mine][:, None] < docs[None, y])
            ask &= (signs[mine][:, None, :] == signs[None, y, :]).sum(2) >= LIKELY * BINS
            a, b = np.nonzero(ask)
            a, b = mine[a], y[b]
            own = bands[a, this] == bands[b, this]
            for earlier in range(this):
                own &= bands[a, earlier] != bands[b, earlier]
            found.append(np.stack([a[own], b[own]]))
    pairs = np.concatenate([np.zeros((2, 0), np.int64), *found], 1)
    used, first = np.unique(docs[pairs], return_index=True)
    if not len(used):
        return pa.table({n: pa.array([], t) for n, t in _TILE})
    numbers = np.searchsorted(used, docs[pairs])
    of = parts[pairs.reshape(-1)[first]]
    blob = (used.astype("<i8").tobytes(), of.astype("<i8").tobytes(), np.unique(numbers, axis=1).astype("<u4").tobytes())
    return pa.table({n: pa.array([v], t) for (n, t), v in zip(_TILE, (key[0].as_py(), *blob))})


_TILE = [("bucket", pa.int64()), ("docs", pa.binary()), ("parts", pa.binary()), ("pairs", pa.binary())]


def _tile_docs(batches):
    """The documents that each bucket's pairs name."""
    for batch in batches:
        for bucket, docs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            docs = np.frombuffer(docs, "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(docs), bucket)), pa.array(docs)], ["bucket", "doc_id"])


def _join_tiles(percent):
    """A forest over the components of a bucket: those that a pair whose full
    sets reach the similarity joins."""

    def run(key, tiles, sets):
        if not tiles.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        docs, parts = (np.frombuffer(tiles.column(c)[0].as_py(), "<i8") for c in ("docs", "parts"))
        x, y = np.frombuffer(tiles.column("pairs")[0].as_py(), "<u4").reshape(2, -1).astype(np.int64)
        # Rows of one doc_id may hold several sets; each of them may agree.
        at = np.searchsorted(docs, sets.column("doc_id").to_numpy())
        blobs = sets.column("shingles").to_pylist()
        order = np.argsort(at, kind="stable")
        blobs, at = [blobs[k] for k in order], at[order]
        sizes = np.array([len(b) // 8 for b in blobs], np.int64)
        begin = np.cumsum(sizes) - sizes
        first = np.searchsorted(at, np.arange(len(docs) + 1))
        values, number = np.unique(np.frombuffer(b"".join(blobs), np.uint64), return_inverse=True)
        marked = np.zeros(len(values), bool)
        _, part = np.unique(parts, return_inverse=True)
        links = []
        head = _heads(x).tolist()
        for i, j in zip(head, [*head[1:], len(x)]):
            one = int(x[i])
            others = y[i:j][part[y[i:j]] != part[one]]
            for mine in range(first[one], first[one + 1]):
                if not len(others):
                    break
                n_sets = np.diff(first)[others]
                theirs = np.repeat(first[others] - (np.cumsum(n_sets) - n_sets), n_sets) + np.arange(n_sets.sum())
                owner = np.repeat(others, n_sets)
                near = 100 * np.minimum(sizes[theirs], sizes[mine]) >= percent * np.maximum(sizes[theirs], sizes[mine])
                theirs, owner = theirs[near], owner[near]
                if not len(theirs):
                    continue
                own = number[begin[mine] : begin[mine] + sizes[mine]]
                marked[own] = True
                n = sizes[theirs]
                starts = np.cumsum(n) - n
                common = np.add.reduceat(marked[number[np.repeat(begin[theirs] - starts, n) + np.arange(n.sum())]].astype(np.int64), starts)
                marked[own] = False
                for other in owner[100 * common >= percent * (sizes[mine] + n - common)].tolist():
                    if part[other] != part[one]:
                        links.append((parts[one], parts[other]))
                        part[part == part[other]] = part[one]
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def _joined(labels: DataFrame, links: DataFrame, keep, tasks: int = 1) -> DataFrame:
    """Labels (node, component) after the links between nodes; what is one
    component already counts as one node. `labels` itself if nothing joins."""
    a = labels.select(F.col("node").alias("a"), F.col("component").alias("x"))
    b = labels.select(F.col("node").alias("b"), F.col("component").alias("y"))
    over = links.join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    over = keep(over, "over")
    if not over.limit(1).count():
        return labels
    found, path = components(over)
    further = found.select(F.col("node").alias("component"), F.col("component").alias("further"))
    new = keep(labels.join(further, "component", "left").select("node", F.coalesce("further", "component").alias("component")).coalesce(tasks), "labels")
    drop_stored(labels.sparkSession, path)
    return new


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_shingles (set size),
    component_id (the least doc_id reachable over links, itself included) and
    kept. Two documents are linked when 100 * intersection >= percent * union
    of their sets of word shingles."""
    spark, paths = docs.sparkSession, []

    def keep(df, name):
        stored, path = store(df, name)
        paths.append(path)
        return stored

    try:
        return _components_of(docs, id, text, shingle, percent, keep)
    finally:
        for path in paths:
            drop_stored(spark, path)


def _components_of(docs, id, text, shingle, percent, keep) -> DataFrame:
    spark = docs.sparkSession
    slim = docs.select(F.col(id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = keep(slim.mapInArrow(tidy(_sign(shingle)), _SIGNED), "signed")
    full = signed.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = keep(full.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep")), "classes")
    n = buckets_for(spark, classes.count() * BANDS, PER_BUCKET)
    stars = keep(full.select("s1", "keys").mapInArrow(tidy(_deal(n)), _DEALT).groupBy("bucket").applyInArrow(tidy_group(_meet), _STARS), "stars")

    involved = keep(stars.select(F.col("member").alias("s1")).distinct().join(classes, "s1").select(
        F.col("rep").alias("doc_id")).distinct(), "involved")
    n_involved = involved.count()
    chosen = F.broadcast(involved) if n_involved <= SENT_IDS else involved
    sets = keep(slim.join(chosen, "doc_id", "left_semi").mapInArrow(tidy(_set_rows(shingle)), "doc_id bigint, n bigint, shingles binary"), "sets")
    sets = sets.dropDuplicates(["doc_id", "shingles"])
    signs = full.join(chosen, "doc_id", "left_semi").select("doc_id", "signature").dropDuplicates()
    # Both go to every task where they are measured small; else they are shuffled.
    if (sets.agg(F.sum("n")).first()[0] or 0) * 8 <= SENT_BYTES:
        sets = F.broadcast(sets)
    if n_involved * (BINS + 4 * BANDS) <= SENT_BYTES:
        signs = F.broadcast(signs)

    def confirmed(edges):
        signed_edges = edges.join(signs.select(F.col("doc_id").alias("a"), F.col("signature").alias("x")), "a").join(
            signs.select(F.col("doc_id").alias("b"), F.col("signature").alias("y")), "b")
        likely = signed_edges.select("a", "b", "x", "y").mapInArrow(tidy(_likely("x", "y")), "a bigint, b bigint")
        return _confirm(likely, sets, percent)

    # Each member's best hub, then twice the best links of each node that that has made.
    edges = keep(stars.where("hub <> member").groupBy("hub", "member").agg(F.count("*").alias("n")), "edges")
    nearest = edges.groupBy("member").agg(F.max_by("hub", F.struct("n", "hub")).alias("hub"), F.max("n").alias("n"))
    labels = involved.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("component"))
    tasks = 1 + n_involved // PER_TASK
    labels = _joined(labels, confirmed(_to_reps(nearest, classes).select("a", "b")), keep, tasks)
    between = keep(_to_reps(edges, classes), "between")
    for _ in range(2):
        a, b = (labels.select(F.col("node").alias(n), F.col("component").alias(c)) for n, c in (("a", "x"), ("b", "y")))
        left = between.join(a, "a").join(b, "b").where("x <> y")
        ways = left.select("x", "y", "a", "b", "n").union(left.select(F.col("y").alias("x"), F.col("x").alias("y"), "a", "b", "n"))
        best = ways.groupBy("x", F.pmod(F.xxhash64("y"), F.lit(PER_NODE))).agg(
            F.max_by(F.struct("a", "b"), F.struct("n", "a", "b")).alias("e")).select("e.a", "e.b").distinct()
        before, labels = labels, _joined(labels, confirmed(best), keep, tasks)
        if labels is before:
            break

    members = stars.select("key", F.col("member").alias("s1")).distinct().join(classes.select("s1", F.col("rep").alias("doc_id")), "s1")
    members = keep(members.select("key", "doc_id").distinct().join(labels.withColumnRenamed("node", "doc_id"), "doc_id"), "members")
    mixed = keep(_mixed_keys(members), "mixed")
    n_tiles = buckets_for(spark, mixed.agg(F.sum("rows")).first()[0] or 0, TILE_ROWS, 1)
    dealt = _tiles(members, mixed, signs).withColumn("bucket", F.pmod(F.xxhash64("key", "i", "j"), F.lit(n_tiles)))
    pairs = keep(dealt.groupBy("bucket").applyInArrow(tidy_group(_likely_tiles), "bucket bigint, docs binary, parts binary, pairs binary"), "pairs")
    needed = pairs.select("bucket", "docs").mapInArrow(_tile_docs, "bucket bigint, doc_id bigint").join(sets.drop("n"), "doc_id")
    links = pairs.groupBy("bucket").cogroup(needed.groupBy("bucket")).applyInArrow(tidy_group(_join_tiles(percent)), "a bigint, b bigint")
    labels = _joined(labels, keep(links.distinct(), "links"), keep, tasks)

    rows = signed.select("doc_id", "n_shingles", "s1", "s2").join(classes, ["s1", "s2"], "left")
    rows = rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return cut_lineage(rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one document of each component: the least doc_id. Rows that
    share that id stay together."""
    name = fresh(docs, "gone")
    gone = near_duplicates(docs, shingle=shingle, percent=percent).where(~F.col("kept")).select(
        F.col("doc_id").alias(name)).distinct()
    few = gone.limit(SENT_IDS + 1).count() <= SENT_IDS
    return docs.join(F.broadcast(gone) if few else gone, docs["doc_id"] == gone[name], "left_anti")
