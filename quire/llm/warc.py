"""Pages as WARC records in seekable Zstandard archives.

Write. A task turns its pages into records and groups them into frames that
are compressed on their own. An archive is

    frames of records | one skippable frame with the map | one with the seek table

The map names for each record identifier its frame, its place in the frame and
its length. The seek table (the last bytes of the archive) holds both sizes of
each frame, so one record is read by opening one frame. Every frame is valid
Zstandard, so any reader of the format reads the whole stream of records, and
the first record (warcinfo) names the archive.

Archives are written by Spark's own writer, so any store that Spark reaches can
hold them, a task that is lost and run again leaves no half file, and the
driver sees none of it. That writer ends each row with a separator; the
separator chosen is the magic number that ends a seek table.

Repeats. Of records with equal payloads the one with the largest page_id is the
response; the others are revisits: they name it and carry the headers only.
Payloads are told apart by SHA-256. Only digests are shuffled to find repeats,
with partial folding, so a payload that a third of all pages share is one row
for each task. Those that repeat travel to the tasks where they are measured
few; else pages and repeats are joined by digest, and Spark splits hot ones.

Read. Archives are read as whole files by Spark, then frame by frame; of the
frames only those asked for are opened.

Defined cases: a null payload is empty, a null url is an empty target; equal
payloads whose ids are all null are all responses; rows that repeat the
response's page_id and payload are responses too and share its identifier; a
null page_id elsewhere in a group is a revisit; very long pages get a frame,
and where needed an archive, of their own; an empty table gives no archive;
other columns of the table are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage, drop_stored, new_path, store

#: Bytes of records in a frame, and of frames and waiting records in an archive.
FRAME_BYTES, ARCHIVE_BYTES = 1 << 20, 32 << 20
LEVEL = 3
#: Repeated payloads that may travel to every task; more are joined by a shuffle.
SENT_REPEATS = 100_000

# Fixed values of the formats.
SKIPPABLE_SEEK, SKIPPABLE_MAP = 0x184D2A5E, 0x184D2A50
SEEKABLE_END = bytes([0xB1, 0xEA, 0x92, 0x8F])
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HEADER_END = b"\r\n\r\n"

_INDEX = "record_id string, path string, frame int, frame_offset bigint, frame_bytes bigint, offset bigint, length bigint"
_RECORDS = ("record_id string, record_type string, page_id bigint, url string, payload_bytes bigint, "
            "payload_digest string, refers_to bigint, payload binary")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id, digest, row=None) -> str:
    """A record's identifier; `row` tells revisits and pages without id apart."""
    named = f"urn:page:{'' if page_id is None else page_id}:{digest}"
    return named if row is None else f"{named}:{row}"


def _page_of(record_id: str):
    page = record_id.split(":")[2]
    return int(page) if page else None


def _target(url) -> str:
    """A URI may hold no white space or control character."""
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")


def _record(kind, record_id, date, kind_of_block, block, more=()) -> bytes:
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date), *more,
              ("Content-Type", kind_of_block), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + HEADER_END


def page_record(page_id, url, payload, first, alone, row, date):
    """(identifier, record) of a page whose payload is held by page `first`."""
    digest = payload_digest(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    more = [("WARC-Target-URI", _target(url)), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if alone or page_id == first:
        record_id = _name(page_id, digest, row if page_id is None else None)
        return record_id, _record("response", record_id, date, "application/http;msgtype=response", http + payload, more)
    record_id = _name(page_id, digest, row)
    more += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{_name(first, digest)}>")]
    return record_id, _record("revisit", record_id, date, "application/http;msgtype=response", http, more)


class _Archive:
    """One archive in the making: finished frames, and records that wait."""

    def __init__(self, name, date, frame_bytes, packer):
        self.frames, self.sizes, self.places = [], [], []
        self.waiting, self.n, self.done, self.packed = [], 0, 0, 0
        self.frame_bytes, self.packer = frame_bytes, packer
        about = f"software: quire\r\nformat: WARC File Format 1.1\r\nisPartOf: {name}\r\n".encode()
        record_id = f"urn:archive:{name}"
        self.add(record_id, _record("warcinfo", record_id, date, "application/warc-fields", about, [("WARC-Filename", name)]))

    def add(self, record_id, record):
        if self.waiting and self.n + len(record) > self.frame_bytes:
            self._close_frame()
        self.places.append((record_id, len(self.frames), self.n, len(record)))
        self.waiting.append(record)
        self.n += len(record)

    def _close_frame(self):
        plain = b"".join(self.waiting)
        frame = self.packer.compress(plain)
        self.frames.append(frame)
        self.sizes.append((len(frame), len(plain)))
        self.packed += len(frame)
        self.done += len(plain)
        self.waiting, self.n = [], 0

    def size(self):
        return self.done + self.n

    def close(self) -> bytes:
        """The whole archive but for the magic number that ends it."""
        if self.waiting:
            self._close_frame()
        listed = "".join(f"{i}\t{frame}\t{offset}\t{n}\n" for i, frame, offset, n in self.places).encode()
        mapped = self.packer.compress(listed)
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        tail = table + struct.pack("<IB", len(self.sizes), 0)
        return b"".join([
            *self.frames, struct.pack("<II", SKIPPABLE_MAP, len(mapped)), mapped,
            struct.pack("<II", SKIPPABLE_SEEK, len(tail) + len(SEEKABLE_END)), tail])


def _bundle(date, frame_bytes, archive_bytes):
    def run(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        task, made, archive = TaskContext.get(), 0, None
        part = f"{task.partitionId() if task else 0:06d}"
        whole = lambda a: pa.RecordBatch.from_arrays([pa.array([a.close()], pa.binary())], ["archive"])
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "first", "alone", "row")]
            for i in range(batch.num_rows):
                row = [c[i].as_py() for c in columns]
                record_id, record = page_record(*row, date)
                if archive and archive.size() + len(record) > archive_bytes:
                    yield whole(archive)
                    archive = None
                if archive is None:
                    archive = _Archive(f"{part}-{made:06d}.warc.zst", date, frame_bytes, packer)
                    made += 1
                archive.add(record_id, record)
        if archive:
            yield whole(archive)

    return run


def _repeats(rows: DataFrame, least: int) -> tuple[DataFrame, str]:
    """(key, first) of payloads that two or more rows hold, and their folder."""
    keys = rows.where(F.octet_length("payload") >= least).select("key", "page_id")
    folded = keys.groupBy("key").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    return store(folded.where("n > 1").select("key", "first"), "repeats")


def write_archives(pages: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html",
                   least: int = 0, date: str = "1970-01-01T00:00:00Z", frame_bytes: int = FRAME_BYTES,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write a record for each row of `pages` to archives in `path`. Payloads
    under `least` bytes are never revisits."""
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload).cast("string").cast("binary"), F.lit("").cast("binary"))
    rows = pages.select(F.col(id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumn("key", F.unhex(F.sha2("payload", 256)))
    repeats, repeats_path = _repeats(rows, least)
    try:
        few = repeats.limit(SENT_REPEATS + 1).count() <= SENT_REPEATS
        joined = rows.join(F.broadcast(repeats) if few else repeats, "key", "left").select(
            "page_id", "url", "payload", F.coalesce("first", "page_id").alias("first"),
            F.col("first").isNull().alias("alone"), F.monotonically_increasing_id().alias("row"))
        archives = joined.mapInArrow(_bundle(date, frame_bytes, archive_bytes), "archive binary")
        # The text writer puts bytes down as they are and ends each row with
        # the separator. One row is one file.
        archives.select(F.col("archive").cast("string")).write.option("maxRecordsPerFile", 1).option(
            "encoding", "ISO-8859-1").option("lineSep", SEEKABLE_END.decode("latin-1")).text(path)
    finally:
        drop_stored(spark, repeats_path)


def seek_table(archive: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, size) of each frame of records."""
    if archive[-4:] != SEEKABLE_END:
        raise ValueError("no seek table at the end of the archive")
    n, _ = struct.unpack("<IB", archive[-9:-4])
    out, at = [], 0
    for packed, plain in struct.iter_unpack("<II", archive[-9 - 8 * n : -9]):
        out.append((at, packed, plain))
        at += packed
    return out


def record_map(archive: bytes) -> list[tuple[str, int, int, int]]:
    """(identifier, frame, offset in the frame, length) of each record."""
    import zstandard

    offset, packed, _ = seek_table(archive)[-1]
    kind, size = struct.unpack_from("<II", archive, offset + packed)
    if kind != SKIPPABLE_MAP:
        raise ValueError("no map of records behind the frames")
    start = offset + packed + 8
    listed = zstandard.ZstdDecompressor().decompress(archive[start : start + size]).decode()
    rows = (line.split("\t") for line in listed.splitlines())
    return [(i, int(frame), int(at), int(n)) for i, frame, at, n in rows]


def open_frame(archive: bytes, frame: tuple[int, int, int]) -> bytes:
    import zstandard

    offset, packed, plain = frame
    return zstandard.ZstdDecompressor().decompress(archive[offset : offset + packed], max_output_size=plain)


def parse_record(record: bytes):
    """The fields of one record, as a row of `read_records`; None for warcinfo."""
    end = record.index(HEADER_END)
    fields = dict(line.split(": ", 1) for line in record[:end].decode().split("\r\n")[1:])
    if fields["WARC-Type"] == "warcinfo":
        return None
    block = record[end + 4 : end + 4 + int(fields["Content-Length"])]
    cut = block.index(HEADER_END)
    http = dict(line.split(": ", 1) for line in block[:cut].decode().split("\r\n")[1:])
    record_id, size = fields["WARC-Record-ID"][1:-1], int(http["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload, refers = None, None
    if fields["WARC-Type"] == "response":
        payload = block[cut + 4 :]
        if len(payload) != size or payload_digest(payload) != digest:
            raise ValueError(f"record {record_id} is damaged")
    else:
        refers = _page_of(fields["WARC-Refers-To"][1:-1])
    return (record_id, fields["WARC-Type"], _page_of(record_id), fields["WARC-Target-URI"], size, digest, refers, payload)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record identifier: archive, frame (its number, offset
    and compressed size) and the record's place and length in the frame."""

    def run(batches):
        for batch in batches:
            for path, archive in zip(batch.column(0).to_pylist(), batch.column(1)):
                archive = archive.as_buffer().to_pybytes()
                frames = seek_table(archive)
                rows = [(i, path, f, frames[f][0], frames[f][1], at, n) for i, f, at, n in record_map(archive)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string()] * 2 + [pa.int32()] + [pa.int64()] * 4)],
                    ["record_id", "path", "frame", "frame_offset", "frame_bytes", "offset", "length"])

    return _files(spark, path).mapInArrow(run, _INDEX)


_ARROW = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _rows(archive: bytes, places, frames, payloads: bool):
    """Batches of the records at `places`, one frame at a time."""
    by_frame = {}
    for place in places:
        by_frame.setdefault(place[1], []).append(place)
    for frame, inside in by_frame.items():
        plain = open_frame(archive, frames[frame])
        rows = [parse_record(plain[at : at + n]) for _, _, at, n in inside]
        rows = [r if payloads else (*r[:-1], None) for r in rows if r]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives in `path`, checked against their digests."""

    def run(batches):
        for batch in batches:
            for archive in batch.column("content"):
                archive = archive.as_buffer().to_pybytes()
                yield from _rows(archive, record_map(archive), seek_table(archive), payloads)

    return _files(spark, path).mapInArrow(run, _RECORDS)


def fetch_records(spark: SparkSession, path: str, wanted: DataFrame, id: str = "record_id") -> DataFrame:
    """The records that `wanted` names. Wanted identifiers meet the index in
    their archive's row, so only frames that hold one of them are opened."""
    names = wanted.select(F.col(id).alias("record_id")).distinct()
    places = read_index(spark, path).join(names, "record_id").groupBy("path").agg(
        F.collect_list(F.struct("record_id", "frame", "offset", "length")).alias("places"))

    def run(batches):
        for batch in batches:
            for archive, places in zip(batch.column("content"), batch.column("places").to_pylist()):
                archive = archive.as_buffer().to_pybytes()
                rows = sorted((p["record_id"], p["frame"], p["offset"], p["length"]) for p in places)
                yield from _rows(archive, rows, seek_table(archive), True)

    return _files(spark, path).join(places, "path").select("content", "places").mapInArrow(run, _RECORDS)


def archive_report(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write `pages` to archives, read them back, and return for each page its
    record: page_id, payload_bytes, payload_digest, record_type, refers_to, and
    the record's identifier and target. The archives are dropped at the end."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    try:
        write_archives(pages, path, least=least)
        return cut_lineage(read_records(spark, path, payloads=False).select(
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url"))
    finally:
        drop_stored(spark, path)
