"""Bytes as MPEG transport streams: one programme, one private-data stream, timestamps and random-access points.

Written and read by this module: 188-byte packets; a programme association and a programme map table
before each access unit; packetised elementary units of at most ``UNIT`` bytes with a 90 kHz
presentation timestamp; the random-access flag on each unit's first packet; continuity counters.
"""

from __future__ import annotations

import hashlib
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_name, map_slices, raw, table

#: Fixed by the format.
PACKET, SYNC, PAT_PID, STREAM_ID, PRIVATE_DATA, CLOCK = 188, 0x47, 0, 0xBD, 0x06, 90_000
MAP_PID, DATA_PID, PROGRAMME = 0x100, 0x101, 1
#: Payload bytes of an access unit, and its duration in clock ticks.
UNIT, TICKS = 184 * 256, 3_600


def crc32_mpeg(data: bytes) -> int:
    """CRC-32/MPEG-2: polynomial 0x04C11DB7, start of all ones, not reflected."""
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte << 24
        for _ in range(8):
            crc = (crc << 1 ^ 0x04C11DB7 if crc & 0x80000000 else crc << 1) & 0xFFFFFFFF
    return crc


def section(table_id: int, number: int, body: bytes) -> bytes:
    head = bytes([table_id, 0xB0 | (len(body) + 9) >> 8, (len(body) + 9) & 0xFF, number >> 8, number & 0xFF, 0xC1, 0, 0])
    return head + body + crc32_mpeg(head + body).to_bytes(4, "big")


def table_packet(pid: int, part: bytes) -> np.ndarray:
    data = bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10, 0]) + part
    return np.frombuffer(data.ljust(PACKET, b"\xff"), "u1")


PAT = table_packet(PAT_PID, section(0, 1, PROGRAMME.to_bytes(2, "big") + (0xE000 | MAP_PID).to_bytes(2, "big")))
PMT = table_packet(MAP_PID, section(2, PROGRAMME, (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00" + bytes([PRIVATE_DATA]) + (0xE000 | DATA_PID).to_bytes(2, "big") + b"\xf0\x00"))


def stamp(pts: int) -> bytes:
    """A presentation timestamp's five bytes."""
    return bytes([0x21 | pts >> 29 & 0x0E, pts >> 22 & 0xFF, 0x01 | pts >> 14 & 0xFE, pts >> 7 & 0xFF, 0x01 | pts << 1 & 0xFE])


def mux(payload: bytes, unit: int = UNIT) -> bytes:
    """The stream that holds ``payload``; each unit starts with the two tables and a random-access point."""
    out, counter, tables = [], 0, 0
    for k, start in enumerate(range(0, len(payload), unit)):
        pts = k * TICKS & (1 << 33) - 1
        piece = payload[start : start + unit]
        pes = b"\x00\x00\x01" + bytes([STREAM_ID]) + (len(piece) + 8).to_bytes(2, "big") + b"\x84\x80\x05" + stamp(pts) + piece
        # the first packet: an adaptation field of flags and clock reference (8 bytes), then 176 of the unit
        clock = pts << 15 | 0x7E00
        first, rest = pes[:176], pes[176:]
        stuffing = 176 - len(first)
        n = -(-len(rest) // 184)
        packets = np.full((1 + n, PACKET), 0xFF, "u1")
        packets[:, 0], packets[:, 1], packets[:, 2] = SYNC, DATA_PID >> 8, DATA_PID & 0xFF
        packets[:, 3] = 0x10 | (counter + np.arange(1 + n)) & 15
        packets[0, 1] |= 0x40
        packets[0, 3] |= 0x20
        packets[0, 4:12] = np.frombuffer(bytes([7 + stuffing, 0x50]) + clock.to_bytes(6, "big"), "u1")
        packets[0, 12 + stuffing :] = np.frombuffer(first, "u1")
        if full := len(rest) // 184:
            packets[1 : 1 + full, 4:] = np.frombuffer(rest[: full * 184], "u1").reshape(full, 184)
        if tail := len(rest) % 184:
            gap = 184 - tail  # stuffed by an adaptation field of that size
            packets[n, 3] |= 0x20
            packets[n, 4] = gap - 1
            if gap > 1:
                packets[n, 5] = 0
            packets[n, 4 + gap :] = np.frombuffer(rest[-tail:], "u1")
        counter += 1 + n
        marks = np.stack([PAT, PMT])
        marks[:, 3] |= tables & 15
        tables += 1
        out += [marks.tobytes(), packets.tobytes()]
    return b"".join(out)


@dataclass
class Stream:
    """What a transport stream holds. points: (packet, timestamp) of units that start at a random-access flag."""

    payload: bytes = b""
    packets: int = 0
    lost: int = 0
    pids: dict[int, int] = field(default_factory=dict)
    units: list[int] = field(default_factory=list)
    points: list[tuple[int, int]] = field(default_factory=list)


def checked(packet: np.ndarray) -> bytes:
    """The body of a table's section, its CRC verified."""
    data = packet[4:].tobytes()
    data = data[1 + data[0] :]
    size = 3 + ((data[1] & 0x0F) << 8 | data[2])
    if data[:size] not in _sound and crc32_mpeg(data[:size]):
        raise ValueError("a table's checksum is wrong")
    if len(_sound) < 64:
        _sound.add(data[:size])
    return data[8 : size - 4]


_sound: set[bytes] = set()


def demux(data: bytes) -> Stream:
    """Parse tables, check continuity, reassemble units. Bytes that aren't whole packets or lack the sync byte raise ValueError."""
    if len(data) % PACKET:
        raise ValueError("not whole packets")
    packets = np.frombuffer(data, "u1").reshape(-1, PACKET)
    if (packets[:, 0] != SYNC).any():
        raise ValueError("sync byte missing")
    out = Stream(packets=len(packets))
    pids = (packets[:, 1].astype("u2") & 0x1F) << 8 | packets[:, 2]
    control = packets[:, 3] >> 4 & 3
    for pid in np.unique(pids).tolist():
        mine = np.flatnonzero(pids == pid)
        out.pids[pid] = len(mine)
        counters = packets[mine[control[mine] & 1 > 0], 3] & 15
        out.lost += int(((counters[1:] - counters[:-1]) % 16 != 1).sum())
    maps = {}
    for k in np.flatnonzero(pids == PAT_PID).tolist():
        body = checked(packets[k])
        for i in range(0, len(body), 4):
            if number := body[i] << 8 | body[i + 1]:
                maps[number] = (body[i + 2] & 0x1F) << 8 | body[i + 3]
    streams = {}
    for pid in set(maps.values()):
        for k in np.flatnonzero(pids == pid).tolist():
            body = checked(packets[k])
            at = 4 + ((body[2] & 0x0F) << 8 | body[3])
            while at < len(body):
                streams[(body[at + 1] & 0x1F) << 8 | body[at + 2]] = body[at]
                at += 5 + ((body[at + 3] & 0x0F) << 8 | body[at + 4])
    pieces = []
    for pid in sorted(p for p, kind in streams.items() if kind == PRIVATE_DATA):
        mine = np.flatnonzero(pids == pid)
        starts = np.flatnonzero(packets[mine, 1] & 0x40)
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(mine)], strict=True):
            rows = packets[mine[a:b]]
            skip = np.where(rows[:, 3] & 0x20, 1 + rows[:, 4].astype("i4"), 0)
            plain = (skip == 0) & (rows[:, 3] & 0x10 > 0)
            if plain[1:-1].all() and b - a > 2:
                body = rows[0, 4 + skip[0] :].tobytes() + rows[1:-1, 4:].tobytes() + rows[-1, 4 + skip[-1] :].tobytes()
            else:
                body = b"".join(r[4 + s :].tobytes() for r, s in zip(rows, skip.tolist(), strict=True) if r[3] & 0x10)
            if body[:3] != b"\x00\x00\x01":
                raise ValueError("no unit starts here")
            size, head = body[4] << 8 | body[5], body[8]
            pts = 0
            if body[7] & 0x80:
                x = body[9:14]
                pts = (x[0] & 0x0E) << 29 | x[1] << 22 | (x[2] & 0xFE) << 14 | x[3] << 7 | x[4] >> 1
            pieces.append(body[9 + head : 6 + size])
            out.units.append(pts)
            if rows[0, 3] & 0x20 and rows[0, 4] and rows[0, 5] & 0x40:
                out.points.append((int(mine[a]), pts))
    out.payload = b"".join(pieces)
    return out


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", multiple: int = 192, media: bool = True) -> DataFrame:
    """Each whole text's UTF-8 (null: empty), filled with spaces to a positive multiple, as a transport stream, read back.

    id, n_bytes, payload_bytes, payload_sha256, tail_crc32 (of the last 16 bytes read back), media_bytes,
    media_sha256, feature (packets, units, continuity faults, first and last timestamp, random-access
    points), points (array of packet and timestamp), and media itself on demand. Rows and ids are kept as
    they are; equal texts give equal values; no rows: no rows. Texts go through a worker by slices bounded in bytes, so long ones
    don't add up. Other columns are ignored; an id named like an output has ``_input`` behind its name.
    """
    point = pa.list_(pa.struct([("packet", pa.int64()), ("pts", pa.int64())]))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), point, pa.binary()]
    fields = ["n_bytes long", "payload_bytes long", "payload_sha256 string", "tail_crc32 long", "media_bytes long"]
    fields += ["media_sha256 string", "feature string", "points array<struct<packet: long, pts: long>>", "media binary"]
    fields = fields[: 8 + media]
    names = [f.split(" ", 1)[0] for f in fields]
    own_id = id_name(id_col, names)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in names]
        for data in raw(batch, "text"):
            payload = data.ljust(max(multiple, -(-len(data) // multiple) * multiple), b" ")
            stored = mux(payload)
            s = demux(stored)
            feature = f"packets={s.packets};units={len(s.units)};lost={s.lost};pts={min(s.units)}-{max(s.units)}"
            row = [len(data), len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-16:]), len(stored)]
            row += [hashlib.sha256(stored).hexdigest(), f"{feature};random_access={len(s.points)}"]
            row.append([{"packet": a, "pts": b} for a, b in s.points])
            for column, value in zip(columns, [*row, stored][: len(names)], strict=True):
                column.append(value)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
        return pa.RecordBatch.from_arrays([batch.column("id"), *arrays], [own_id, *names])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = ", ".join([f"`{own_id}` {docs.schema[id_col].dataType.simpleString()}", *fields])
    return map_slices(rows, "text", run, schema)


def op10_mpeg_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as transport streams; the digest columns of the contract."""
    return store_texts(table(spark, sf_dir, "documents"), media=False).withColumn("n_points", F.size("points").cast("long")).drop("points")
