"""WARC 1.1 archives as seekable Zstandard bundles.

A bundle ``p.warc.zst`` is a run of independent Zstandard frames, each of some whole records, then a
skippable frame with a seek table in the public seekable format (compressed and decompressed size of
each frame, their number, magic 0x8F92EAB1). Beside it ``p.idx`` maps record ids to (frame, offset in the
decompressed frame, length); so one record costs the footer, one index entry and one frame.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, filesystem, join_by_hot_key, local_path, publish, shared_dir, slices, table, written

#: Fixed by the seekable format.
SKIPPABLE, SEEKABLE, ENTRY, FOOTER = 0x184D2A5E, 0x8F92EAB1, struct.Struct("<II"), struct.Struct("<IBI")
#: Record ids are name-based UUIDs of page ids.
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tallyloom:page")
DATE = "1970-01-01T00:00:00Z"
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 26


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, str(page_id))}>"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str, payload: bytes, digest: str, length: int, refers_to: int | None) -> bytes:
    """A response, or (with refers_to) a revisit: its block is the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", "WARC-Target-URI: " + " ".join(url.split()), f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-ID: {'' if page_id is None else page_id}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-ID: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at ``at``, and where it ends."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record here")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    start = end + 4
    stop = start + int(headers["Content-Length"])
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("a record's end is missing")
    return headers, data[start:stop], stop + 4


class Bundle:
    """Collects records into frames; ``finish`` gives the archive's bytes and the index's."""

    def __init__(self, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.frame_bytes, self.codec = frame_bytes, zstandard.ZstdCompressor(level=level)
        self.frames, self.sizes, self.index, self.open, self.fill = [], [], [], [], 0

    def add(self, name: str, data: bytes) -> None:
        if self.open and self.fill + len(data) > self.frame_bytes:
            self.close_frame()
        self.index.append((uuid.UUID(name[10:-1]).bytes, len(self.frames), self.fill, len(data)))
        self.open.append(data)
        self.fill += len(data)

    def close_frame(self) -> None:
        frame = self.codec.compress(b"".join(self.open))
        self.sizes.append((len(frame), self.fill))
        self.frames.append(frame)
        self.open, self.fill = [], 0

    def bytes_held(self) -> int:
        return sum(a for a, _ in self.sizes) + self.fill

    def finish(self) -> tuple[list[bytes], bytes]:
        if self.open:
            self.close_frame()
        body = b"".join(ENTRY.pack(*s) for s in self.sizes) + FOOTER.pack(len(self.sizes), 0, SEEKABLE)
        index = np.array(sorted(self.index), INDEX)
        return [*self.frames, struct.pack("<II", SKIPPABLE, len(body)), body], index.tobytes()


INDEX = np.dtype([("id", "V16"), ("frame", "<u4"), ("offset", "<u4"), ("length", "<u4")])


class Reader:
    """A bundle read by its footer; frames are fetched one at a time."""

    def __init__(self, folder: str, name: str):
        self.store, root = filesystem(folder)
        self.file = self.store.open_input_file(f"{root}/{name}.warc.zst")
        self.index_path, self.index_uri = f"{root}/{name}.idx", f"{folder}/{name}.idx"
        size = self.file.size()
        count, flags, magic = FOOTER.unpack(self.at(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE:
            raise ValueError("no seek table")
        width = ENTRY.size + 4 * (flags >> 7)
        table_at = size - FOOTER.size - count * width
        entries = self.at(table_at, count * width)
        self.sizes = [ENTRY.unpack_from(entries, i * width) for i in range(count)]
        self.starts = np.concatenate([[0], np.cumsum([a for a, _ in self.sizes])]).astype(int).tolist()

    def at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def frame(self, k: int) -> bytes:
        packed, plain = self.sizes[k]
        return zstandard.ZstdDecompressor().decompress(self.at(self.starts[k], packed), max_output_size=plain)

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        for k in range(len(self.sizes)):
            data, at = self.frame(k), 0
            while at < len(data):
                headers, block, at = parse(data, at)
                yield headers, block

    def find(self, name: str) -> tuple[dict[str, str], bytes] | None:
        """One record by its id, through the sorted index and one frame."""
        index, key = self.index(), uuid.UUID(name[10:-1]).bytes
        low, high = 0, len(index)
        while low < high:
            middle = (low + high) // 2
            if index["id"][middle].tobytes() < key:
                low = middle + 1
            else:
                high = middle
        if low == len(index) or index["id"][low].tobytes() != key:
            return None
        headers, block, _ = parse(self.frame(int(index["frame"][low])), int(index["offset"][low]))
        return headers, block

    def index(self) -> np.ndarray:
        """The sorted index, memory-mapped where its folder is mounted."""
        if path := local_path(self.index_uri):
            return np.memmap(path, INDEX, "r")
        return np.frombuffer(self.store.open_input_file(self.index_path).read(), INDEX)


def write_archive(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_revisit_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write a record per row and return the list of bundles (name, records).

    Payload: the text in UTF-8, null as empty. Of records with equal payloads of at least
    ``min_revisit_bytes`` bytes, that with the smallest id is a response and others revisit it; repeated
    rows with that smallest id are all responses. A row without id is a response that nothing refers to.
    Null urls are empty. Other columns are ignored. No rows: no bundles.

    Equal payloads are found by SHA-1 on rows of id and digest, apart from the payloads; payloads that many rows hold meet
    their first id by a bounded broadcast. The wide rows then meet the list of revisits by (id, digest), which repeats
    for repeated rows alone; they stay where they are if the list is small.
    """
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    sha = F.when(F.octet_length("_html") >= min_revisit_bytes, F.sha1(F.col("_html").cast("binary")))
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), url.alias("_url"), html.alias("_html")).withColumn("_sha", sha)
    narrow = rows.where("_sha IS NOT NULL AND _id IS NOT NULL").select("_id", "_sha").distinct()
    first = narrow.groupBy("_sha").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    first = written(first.select("_sha", "_first"), "warc-first")
    # only payloads met twice matter: the others drop out before anything is joined
    met = written(narrow.join(first.select("_sha"), "_sha", "left_semi"), "warc-met")
    again = join_by_hot_key(met, first, "_sha").where("_id > _first").select("_id", "_sha", F.col("_first").alias("_refers"))
    again = written(again, "warc-revisits")
    joined = rows.join(again, ["_id", "_sha"], "left").select("_id", "_url", "_html", "_refers")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, bundle, count = TaskContext.get().partitionId(), 0, Bundle(frame_bytes), 0

        def close() -> pa.RecordBatch:
            nonlocal number, bundle, count
            name = f"{part:06d}-{number:04d}"
            body, index = bundle.finish()
            publish(folder, f"{name}.warc.zst", body)
            publish(folder, f"{name}.idx", index)
            done = pa.RecordBatch.from_pydict({"bundle": [name], "records": pa.array([count], pa.int64())})
            number, bundle, count = number + 1, Bundle(frame_bytes), 0
            return done

        parts = (part for batch in batches for part in slices(batch, "_html"))
        for rows in parts:
            for page_id, url, html, refers in zip(*(rows[c].to_pylist() for c in ("_id", "_url", "_html", "_refers")), strict=True):
                payload = html.encode()
                body = b"" if refers is not None else payload
                bundle.add(record_id(page_id), record(page_id, url, body, base32_sha1(payload), len(payload), refers))
                count += 1
                if bundle.bytes_held() >= bundle_bytes:
                    yield close()
        if count:
            yield close()

    bundles = written(joined.mapInArrow(write, "bundle string, records long"), "warc-bundles")
    discard(first, met, again)
    return bundles


def read_archive(bundles: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """A row for each record of the bundles: page_id, url, payload_bytes, payload_digest, record_type, refers_to, and payload on demand.

    A response's length and digest are computed from its block and held against its header; a revisit's
    are in its HTTP header and its WARC header.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * payloads

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("bundle").to_pylist():
                out: list[tuple] = []
                for headers, block in Reader(folder, name).records():
                    head, payload = block.split(b"\r\n\r\n", 1)
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and base32_sha1(payload) != digest:
                        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
                    length = len(payload) if kind == "response" else int(head.rsplit(b": ", 1)[1])
                    number = lambda key, h=headers: int(h[key]) if h.get(key) else None
                    out.append((number("X-Page-ID"), headers["WARC-Target-URI"], length, digest, kind, number("X-Refers-To-Page-ID"), payload)[: 6 + payloads])
                    if len(out) == 2000:
                        yield _rows(out, payloads)
                        out = []
                if out:
                    yield _rows(out, payloads)

    return bundles.repartition(max(1, min(bundles.count(), 4096))).mapInArrow(read, schema)


def _rows(out: list[tuple], payloads: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: 6 + payloads]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"][: 6 + payloads]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written to bundles and read back."""
    folder = shared_dir(spark, "warc")
    bundles = write_archive(table(spark, sf_dir, "pages"), folder)
    return read_archive(bundles, folder).drop("url")


OP5_SQL = """
WITH p AS (SELECT page_id, sha1(encode(coalesce(html, ''))) AS sha, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first_id FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(sha, 1 + (5 * g) // 4, 2))::INT >> (3 - ((5 * g) % 4)::INT)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM f
"""
