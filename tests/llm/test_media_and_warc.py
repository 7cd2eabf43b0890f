"""Transport streams and WARC bundles: round trips, formats, and the oracle."""

import hashlib
import random
import zlib

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from tallyloom.llm.transport_stream import PACKET, UNIT, crc32_mpeg, demux, mux, op10_mpeg_ts, store_texts
from tallyloom.llm.warc import OP5_SQL, Bundle, Reader, op5_warc_bundles, parse, read_archive, record, record_id, write_archive


def test_crc_of_the_standard_check_value():
    assert crc32_mpeg(b"123456789") == 0x0376E6E7


@pytest.mark.parametrize("n", [1, 16, 161, 162, 163, 176, 192, 345, 346, 347, 184 * 3, 5000, UNIT, UNIT + 1, 3 * UNIT + 77])
def test_stream_round_trip(n):
    data = random.Random(n).randbytes(n)
    stored = mux(data)
    s = demux(stored)
    assert s.payload == data and len(stored) % PACKET == 0 and s.lost == 0
    assert len(s.units) == len(s.points) == -(-n // UNIT) and s.units == [k * 3600 for k in range(len(s.units))]


def test_faults_are_seen():
    stored = mux(bytes(range(256)) * 40)
    cut = stored[: 5 * PACKET] + stored[6 * PACKET :]
    assert demux(cut).lost == 1
    with pytest.raises(ValueError):
        demux(stored[:-1])
    with pytest.raises(ValueError):
        demux(b"x" + stored[1:])
    bad = bytearray(stored)
    bad[8] ^= 1
    with pytest.raises(ValueError):
        demux(bytes(bad))


def check_media(rows, docs):
    by = {}
    for r in rows:
        by.setdefault(r.payload_sha256, set()).add((r.media_bytes, r.media_sha256, r.feature))
    assert all(len(x) == 1 for x in by.values())
    want = []
    for d in docs:
        data = (d.text or "").encode()
        p = data.ljust(max(192, -(-len(data) // 192) * 192), b" ")
        want.append((d.doc_id, len(data), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])))
    order = lambda x: (x[0] is not None, x[0] or 0, x[3])
    assert sorted(((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows), key=order) == sorted(want, key=order)


def test_op10(spark, sf, docs, none):
    check_media(op10_mpeg_ts(spark, sf).collect(), spark.read.parquet(f"{sf}/documents.parquet").collect())
    rows = store_texts(docs).collect()
    check_media(rows, docs.collect())
    assert all(hashlib.sha256(r.media).hexdigest() == r.media_sha256 and demux(bytes(r.media)).points for r in rows)
    assert store_texts(none).collect() == []


def test_seek_table_and_lookup(tmp_path):
    bundle = Bundle(frame_bytes=500)
    for k in range(40):
        bundle.add(record_id(k), record(k, "http://x/" + str(k), b"payload %d" % k, "D", 9, None))
    body, index = bundle.finish()
    (tmp_path / "b.warc.zst").write_bytes(b"".join(body))
    (tmp_path / "b.idx").write_bytes(index)
    reader = Reader(str(tmp_path), "b")
    assert len(reader.sizes) > 5
    # a plain decoder reads all frames and skips the seek table
    plain = zstandard.ZstdDecompressor().stream_reader(b"".join(body), read_across_frames=True).read()
    assert plain == b"".join(reader.frame(k) for k in range(len(reader.sizes)))
    headers, block = reader.find(record_id(17))
    assert headers["X-Page-ID"] == "17" and block.endswith(b"payload 17") and reader.find(record_id(99)) is None
    assert parse(plain)[0]["WARC-Type"] == "response"


def test_op5_equals_its_sql(spark, sf):
    got = op5_warc_bundles(spark, sf)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    cols = "page_id, payload_bytes, payload_digest, record_type, refers_to"
    want = con.execute(f"SELECT {cols} FROM ({OP5_SQL})").fetchall()
    assert sorted(map(tuple, got.selectExpr(*cols.split(", ")).collect()), key=str) == sorted(map(tuple, want), key=str)


def test_archive_of_odd_rows(spark, tmp_path):
    rows = [(1, "u\r\n1", "<p>a</p>"), (2, None, "<p>a</p>"), (7, "u", None), (8, "u", ""), (None, "u", "<p>a</p>"), (3, "é", "x" * 400_000), (1, "u", "<p>a</p>")] + [(100 + k, "u", "copy") for k in range(3000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record_type", F.lit("clash"))
    folder = str(tmp_path / "w")
    got = read_archive(write_archive(pages, folder), folder, payloads=True).collect()
    assert len(got) == len(rows)
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in got}
    assert {(1, "response", None), (2, "revisit", 1), (7, "response", None), (8, "revisit", 7), (None, "response", None), (100, "response", None), (101, "revisit", 100)} <= kinds
    assert next(r for r in got if r.page_id == 3).payload == b"x" * 400_000
    assert all(r.payload_bytes == 4 for r in got if (r.page_id or 0) >= 100)
    few = read_archive(write_archive(pages, folder + "2", min_revisit_bytes=5), folder + "2").collect()
    assert len(few) == len(rows)
    assert {(8, "response", None), (101, "response", None), (2, "revisit", 1)} <= {(r.page_id, r.record_type, r.refers_to) for r in few}
    assert read_archive(write_archive(pages.where("false"), folder + "3"), folder + "3").collect() == []
