import base64
import hashlib
import io
import random

import pytest
import zstandard

from quire.llm import warc

PAGES = "page_id bigint, url string, html string, payload string, path string"


def odd_pages():
    rng = random.Random(9)
    texts = ["", None, "é你\U0001f600 \r\n\r\nWARC/1.1\r\n", "x" * 300_000, "same", "same", "a\x00b\n"]
    rows = [(i, f"http://h/{i}?a b\n", t) for i, t in enumerate(texts)]
    rows += [(100 + i, None if i % 3 else "", "copy") for i in range(60)]
    rows += [(None, "u", "copy"), (None, "u", "only without id"), (None, "v", "only without id"), (500, "w", "rep"), (500, "w", "rep"),
             (500, "w", "other text of one id")]
    rows += [(1000 + i, f"u{i}", "".join(rng.choice("abcdef \n") for _ in range(rng.randrange(2000)))) for i in range(200)]
    return rows


def plain(rows):
    """(page_id, bytes, digest, type, refers_to) of every page."""
    body = [(i, (t or "").encode()) for i, _, t in rows]
    most = {}
    for i, b in body:
        most.setdefault(b, []).append(i)
    out = []
    for i, b in body:
        ids = [x for x in most[b] if x is not None]
        first = max(ids) if ids else i
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        out.append((i, len(b), digest, *(("response", None) if i == first else ("revisit", first))))
    return sorted(out, key=repr)


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], PAGES).repartition(3)


def seen(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_report_equals_plain_version(spark):
    rows = odd_pages()
    assert seen(warc.archive_report(frame_of(spark, rows))) == plain(rows)


def test_shuffled_repeats_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(warc, "SENT_REPEATS", 0)
    rows = odd_pages()
    assert seen(warc.archive_report(frame_of(spark, rows))) == plain(rows)


def test_short_payloads_are_responses(spark):
    rows = [(1, "a", "ab"), (2, "a", "ab"), (3, "a", "long one"), (4, "a", "long one")]
    got = seen(warc.archive_report(frame_of(spark, rows), least=3))
    assert [(r[0], r[3], r[4]) for r in got] == [
        (1, "response", None), (2, "response", None), (3, "revisit", 4), (4, "response", None)]


def test_empty_table(spark):
    assert seen(warc.archive_report(frame_of(spark, []))) == []


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Archives of several small frames, some with a single long record."""
    path = str(tmp_path_factory.mktemp("warc") / "out")
    warc.write_archives(frame_of(spark, odd_pages()), path, frame_bytes=4000, archive_bytes=60_000)
    return path


def test_archives_are_plain_zstandard(spark, stored):
    files = [bytes(r.content) for r in warc._files(spark, stored).collect()]
    assert len(files) > 3
    whole = b""
    for archive in files:
        frames = warc.seek_table(archive)
        stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(archive), read_across_frames=True).read()
        assert stream == b"".join(warc.open_frame(archive, f) for f in frames)
        assert stream.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        # Records lie where the map says, one after the other.
        joined = b"".join(warc.open_frame(archive, frames[f])[at : at + n] for _, f, at, n in warc.record_map(archive))
        assert joined == stream
        whole += stream
    assert whole.count(b"WARC-Record-ID: ") >= len(odd_pages())


def test_one_record_needs_one_frame(spark, stored):
    index = {r.record_id: r for r in warc.read_index(spark, stored).collect()}
    files = {r.path: bytes(r.content) for r in warc._files(spark, stored).collect()}
    digest = warc.payload_digest(b"x" * 300_000)
    at = index[f"urn:page:3:{digest}"]
    with io.BytesIO(files[at.path]) as file:
        file.seek(at.frame_offset)
        frame = zstandard.ZstdDecompressor().decompress(file.read(at.frame_bytes))
    row = warc.parse_record(frame[at.offset : at.offset + at.length])
    assert row[2] == 3 and row[7] == b"x" * 300_000


def test_fetch_by_identifier(spark, stored):
    index = warc.read_index(spark, stored)
    wanted = index.where("record_id like 'urn:page:10%'")
    got = warc.fetch_records(spark, stored, wanted).collect()
    assert len(got) == wanted.count() and {r.record_id for r in got} == {r.record_id for r in wanted.collect()}
    texts = {i: (t or "").encode() for i, _, t in odd_pages()}
    assert all(bytes(r.payload) == texts[r.page_id] for r in got if r.record_type == "response")
    assert any(r.record_type == "revisit" for r in got)
    assert warc.fetch_records(spark, stored, wanted.where("false")).collect() == []


def test_damage_is_noticed():
    archive = warc._Archive("a", "d", 1000, zstandard.ZstdCompressor(write_checksum=True))
    archive.add(*warc.page_record(1, "u", b"payload", 1, False, 0, "d"))
    whole = archive.close() + warc.SEEKABLE_END
    assert warc.record_map(whole)[1][0].startswith("urn:page:1:")
    with pytest.raises(ValueError):
        warc.seek_table(whole[:-1])
    record = warc.page_record(1, "u", b"payload", 1, False, 0, "d")[1]
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload\r\n\r\n", b"paYload\r\n\r\n"))


def test_digests_of_the_query_sql(spark, tmp_path):
    """The query's SQL agrees on odd pages too."""
    import duckdb

    from quire.llm.queries import QUERIES, SQL

    rows = [r for r in odd_pages() if r[0] is not None and r[0] != 500]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = db.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({SQL['op11_warc']})").fetchall()
    assert seen(QUERIES["op11_warc"](spark, str(tmp_path))) == sorted(want, key=repr)
