"""MPEG transport streams: payloads as 188-byte packets, and back.

A stream has one program: a PAT on PID 0, a PMT, and one private elementary
stream. The payload is cut into access units; each is a PES packet with a
presentation time stamp, and every few of them begin at a random-access point.
Reading goes by the tables: PAT to PMT to the elementary stream's PID, section
CRCs and continuity counters checked, PES packets put together again. A stream
that lacks packets is an error, never a shorter payload.

Beside each stream stands a table of its access units, as parsed from it: time
stamp, whether a decoder can begin there, and where its packet and its payload
begin. So a reader finds a random-access point without opening the stream.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quern.llm.common import as_bytes, small_batches, stage

PACKET = 188
PMT_PID = 0x1000
DATA_PID = 0x0100
UNIT = 16_384
TICKS = 3_600
RANDOM_ACCESS = 8
PAD = 64


def _crc_table() -> list[int]:
    table = []
    for i in range(256):
        c = i << 24
        for _ in range(8):
            c = (c << 1 ^ 0x04C11DB7) & 0xFFFFFFFF if c >> 31 else c << 1
        table.append(c)
    return table


_CRC = _crc_table()


def crc32_mpeg(data: bytes) -> int:
    c = 0xFFFFFFFF
    for b in data:
        c = (c << 8 & 0xFFFFFFFF) ^ _CRC[c >> 24 ^ b]
    return c


def _section(table_id: int, number: int, body: bytes) -> bytes:
    head = struct.pack(">BHHBBB", table_id, 0xB000 | len(body) + 9, number, 0xC1, 0, 0)
    return head + body + struct.pack(">I", crc32_mpeg(head + body))


def _table_packet(pid: int, section: bytes) -> bytes:
    return (struct.pack(">BHB", 0x47, 0x4000 | pid, 0x10) + b"\0" + section).ljust(PACKET, b"\xff")


#: The tables are the same for every stream: program 1 with one private stream.
_TABLES = _table_packet(0, _section(0x00, 1, struct.pack(">HH", 1, 0xE000 | PMT_PID))) + _table_packet(
    PMT_PID, _section(0x02, 1, struct.pack(">HHBHH", 0xE000 | DATA_PID, 0xF000, 0x06, 0xE000 | DATA_PID, 0xF000)))


def _pes(unit: bytes, stamp: int) -> bytes:
    pts = bytes([0x21 | stamp >> 29 & 0x0E]) + struct.pack(">HH", (stamp >> 15 & 0x7FFF) << 1 | 1, (stamp & 0x7FFF) << 1 | 1)
    return b"\0\0\1\xbd" + struct.pack(">H", len(unit) + 8) + b"\x84\x80\x05" + pts + unit


def _adapted(cc: int, start: bool, flags: int, part: bytes) -> bytes:
    """A packet whose adaptation field fills what the part leaves; part has 182 bytes at most, or 183 without flags."""
    room = 183 - len(part)
    field = bytes([room]) + (bytes([flags]) + b"\xff" * (room - 1) if room else b"")
    return struct.pack(">BHB", 0x47, (0x4000 if start else 0) | DATA_PID, 0x30 | cc) + field + part


def mux(payload: bytes) -> bytes:
    """The transport stream of a payload of one or more bytes."""
    out = [_TABLES]
    cc = 0
    for k, at in enumerate(range(0, len(payload), UNIT)):
        pes = _pes(payload[at : at + UNIT], k * TICKS & (1 << 33) - 1)
        out.append(_adapted(cc, True, 0x40 if k % RANDOM_ACCESS == 0 else 0, pes[:182]))
        cc = cc + 1 & 15
        rest = pes[182:]
        full = len(rest) // 184
        if full:
            block = np.empty((full, PACKET), np.uint8)
            block[:, 0], block[:, 1], block[:, 2] = 0x47, DATA_PID >> 8, DATA_PID & 255
            block[:, 3] = 0x10 | (cc + np.arange(full)) & 15
            block[:, 4:] = np.frombuffer(rest, np.uint8, full * 184).reshape(full, 184)
            out.append(block.tobytes())
            cc = cc + full & 15
        if tail := rest[full * 184 :]:
            out.append(_adapted(cc, False, 0, tail))
            cc = cc + 1 & 15
    return b"".join(out)


@dataclass
class Stream:
    """payload, number of packets, and the access units (pts, random_access, packet_offset, payload_offset)."""

    payload: bytes
    packets: int
    units: list[tuple[int, bool, int, int]]

    @property
    def feature(self) -> str:
        ends = f"{self.units[0][0]}-{self.units[-1][0]}" if self.units else "none"
        points = ".".join(str(u[0]) for u in self.units if u[1])
        return f"packets={self.packets};pes={len(self.units)};pts={ends};random_access={points}"


def _read_section(packet: bytes, table_id: int) -> bytes:
    body = packet[5 + packet[4] :]
    end = 3 + (struct.unpack(">H", body[1:3])[0] & 0xFFF)
    if body[0] != table_id or crc32_mpeg(body[:end]):
        raise ValueError("a program table is damaged")
    return body[8 : end - 4]


def demux(media: bytes) -> Stream:
    """Reads a stream with one elementary stream. Repeated packets are passed over; lost ones, damaged tables and short units are errors."""
    if not media or len(media) % PACKET:
        raise ValueError("not whole packets")
    rows = np.frombuffer(media, np.uint8).reshape(-1, PACKET)
    if (rows[:, 0] != 0x47).any():
        raise ValueError("a sync byte is missing")
    if (rows[:, 1] & 0x80).any():
        raise ValueError("a packet is marked as damaged")
    pid = (rows[:, 1].astype(np.int32) & 0x1F) << 8 | rows[:, 2]

    def table(want: int, kind: int) -> bytes:
        at = np.flatnonzero(pid == want)
        if not len(at):
            raise ValueError(f"no packet with PID {want}")
        return _read_section(rows[at[0]].tobytes(), kind)

    pmt_pid = struct.unpack(">HH", table(0, 0x00)[:4])[1] & 0x1FFF
    pmt = table(pmt_pid, 0x02)
    skip = 4 + (struct.unpack(">H", pmt[2:4])[0] & 0xFFF)
    data_pid = struct.unpack(">H", pmt[skip + 1 : skip + 3])[0] & 0x1FFF
    place = np.flatnonzero((pid == data_pid) & (rows[:, 3] & 0x10 > 0))
    data = rows[place]
    adapted = data[:, 3] & 0x20 > 0
    flags = np.where(adapted & (data[:, 4] > 0), data[:, 5], 0)
    step = data[1:, 3] - data[:-1, 3] & 15
    again = np.concatenate([[False], (step == 0) & (data[1:] == data[:-1]).all(axis=1)])
    if ((step != 1) & ~again[1:] & (flags[1:] & 0x80 == 0)).any():
        raise ValueError("packets are lost: the continuity counter breaks")
    place, data, adapted, flags = place[~again], data[~again], adapted[~again], flags[~again]
    field = np.where(adapted, data[:, 4].astype(np.int64) + 1, 0)
    raw = data[:, 4:][np.arange(184) >= field[:, None]].tobytes()
    ends = np.cumsum(184 - field)
    starts = np.flatnonzero(data[:, 1] & 0x40)
    parts, units, at = [], [], 0
    for i, s in enumerate(starts.tolist()):
        a = int(ends[s] - (184 - field[s]))
        b = int(ends[starts[i + 1] - 1]) if i + 1 < len(starts) else len(raw)
        if raw[a : a + 3] != b"\0\0\1":
            raise ValueError("a PES packet does not begin with its start code")
        end = a + 6 + struct.unpack(">H", raw[a + 4 : a + 6])[0]
        if end > b:
            raise ValueError("a PES packet is short")
        p = raw[a + 9 : a + 14]
        stamp = (p[0] & 0x0E) << 29 | p[1] << 22 | (p[2] & 0xFE) << 14 | p[3] << 7 | p[4] >> 1
        units.append((stamp, bool(flags[s] & 0x40), int(place[s]) * PACKET, at))
        parts.append(raw[a + 9 + raw[a + 8] : end])
        at += len(parts[-1])
    return Stream(b"".join(parts), len(rows), units)


def padded(text: bytes) -> bytes:
    """The text with zeros up to a positive multiple of PAD bytes."""
    return text.ljust(max(PAD, -(-len(text) // PAD) * PAD), b"\0")


UNITS = pa.list_(pa.struct([("pts", pa.int64()), ("random_access", pa.bool_()), ("packet_offset", pa.int64()), ("payload_offset", pa.int64())]))
UNITS_DDL = "array<struct<pts:bigint,random_access:boolean,packet_offset:bigint,payload_offset:bigint>>"


def _units(streams: list[Stream]) -> pa.Array:
    names = [f.name for f in UNITS.value_type]
    return pa.array([[dict(zip(names, u, strict=True)) for u in s.units] for s in streams], UNITS)


def store(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media, units) of every row of docs (doc_id, text), written to the shared folder; null text is empty.

    units come from parsing the stream that is written. Other columns are ignored.
    """
    small_batches(docs.sparkSession)

    def encode(batches):
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            media = [mux(padded(x)) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in texts], pa.int64()), pa.array(media, pa.binary()), _units([demux(x) for x in media])],
                ["doc_id", "n_bytes", "media", "units"])

    return stage(docs.select("doc_id", "text").mapInArrow(encode, f"doc_id long, n_bytes long, media binary, units {UNITS_DDL}"))


def features(stored: DataFrame) -> DataFrame:
    """Figures of each stored stream, from its bytes: those of the payload, of the stream, and its timing as text; and its units.

    Repeated rows and ties give equal rows; an empty table gives an empty result.
    A damaged stream, one that lacks packets, or one whose units are not those
    that stand beside it fails the task.
    """
    small_batches(stored.sparkSession)

    def decode(batches):
        for batch in batches:
            media = batch.column("media").to_pylist()
            read = [demux(x) for x in media]
            units = _units(read)
            if not batch.column("units").equals(units):
                raise ValueError("a stream's units are not those stored with it")
            sha = lambda xs: pa.array([hashlib.sha256(x).hexdigest() for x in xs], pa.string())
            longs = lambda xs: pa.array(list(xs), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), longs(len(r.payload) for r in read), sha(r.payload for r in read),
                 longs(zlib.crc32(r.payload[-PAD:]) for r in read), longs(map(len, media)), sha(media), pa.array([r.feature for r in read], pa.string()), units],
                ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "units"])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return stored.select("doc_id", "n_bytes", "media", "units").mapInArrow(decode, f"{schema}, units {UNITS_DDL}")
