"""Media columns: byte payloads kept as MPEG transport streams (ISO/IEC 13818-1).

`mux` stores each payload as 8-bit samples in one elementary stream: PAT, PMT, then one PES packet for each access
unit, whose first transport packet carries a program clock reference and the random-access flag. `demux` reads stored
streams back: it follows PAT and PMT, checks their CRCs and every continuity counter, reassembles the elementary
packets, and gives timestamps with random-access points. Both work on whole Arrow batches of rows, one row at a time,
so no task holds more than a batch; there is no shuffle.

Null text counts as empty; an empty payload is one block of zero bytes, so it is still one access unit.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import record_batch, text_batches

# Fixed values of the format.
SYNC, PACKET, BODY = 0x47, 188, 184
PAT_PID, PMT_PID, ES_PID = 0x0000, 0x1000, 0x0100
STREAM_TYPE, STREAM_ID = 0x06, 0xBD
CLOCK, PES_HEADER = 90_000, 14

BLOCK, UNIT, RATE = 64, 4096, 8_000
"""Payloads are padded to BLOCK bytes; an access unit has UNIT samples, played at RATE a second."""

MEDIA_TYPE = pa.schema([("n_bytes", pa.int64()), ("media", pa.binary())])
AU_TYPE = pa.struct([("pts", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()), ("random_access", pa.bool_())])


@lru_cache(1)
def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32) << np.uint32(24)
    for _ in range(8):
        c = np.where(c & 0x80000000, (c << np.uint32(1)) ^ np.uint32(0x04C11DB7), c << np.uint32(1)).astype(np.uint32)
    return c


def crc_mpeg(data: bytes) -> int:
    """CRC-32 of program tables: polynomial 04C11DB7, most significant bit first, no final inversion."""
    t, c = _crc_table(), 0xFFFFFFFF
    for b in data:
        c = ((c << 8) & 0xFFFFFFFF) ^ int(t[(c >> 24) ^ b])
    return c


def _section(table_id: int, ident: int, body: bytes) -> bytes:
    head = bytes([table_id, 0xB0 | (len(body) + 9) >> 8, (len(body) + 9) & 0xFF, ident >> 8, ident & 0xFF, 0xC1, 0, 0])
    return head + body + crc_mpeg(head + body).to_bytes(4, "big")


@lru_cache(1)
def _tables() -> np.ndarray:
    pat = _section(0x00, 1, bytes([0, 1, 0xE0 | PMT_PID >> 8, PMT_PID & 0xFF]))
    pmt = _section(0x02, 1, bytes([0xE0 | ES_PID >> 8, ES_PID & 0xFF, 0xF0, 0, STREAM_TYPE, 0xE0 | ES_PID >> 8, ES_PID & 0xFF, 0xF0, 0]))
    packets = [bytes([SYNC, 0x40 | pid >> 8, pid & 0xFF, 0x10, 0]) + s for pid, s in ((PAT_PID, pat), (PMT_PID, pmt))]
    return np.frombuffer(b"".join(p.ljust(PACKET, b"\xff") for p in packets), dtype=np.uint8).reshape(2, PACKET)


def _units(samples: np.ndarray, first: int) -> np.ndarray:
    """Transport packets of access units, one for each row of `samples`; `first` is the number of the first unit."""
    k, size = samples.shape
    head_room = BODY - 8  # the first packet's adaptation field: length, flags, clock reference
    pes = size + PES_HEADER
    rest = max(0, pes - head_room)
    n = 1 + -(-rest // BODY)
    out = np.zeros((k, n, PACKET), dtype=np.uint8)
    out[:, :, 0], out[:, :, 1], out[:, :, 2], out[:, :, 3] = SYNC, ES_PID >> 8, ES_PID & 0xFF, 0x10
    out[:, 0, 1] |= 0x40
    pts = (np.arange(first, first + k, dtype=np.int64) * (UNIT * CLOCK // RATE)) & ((1 << 33) - 1)
    body = np.empty((k, pes), dtype=np.uint8)
    length = pes - 6
    body[:, :9] = [0, 0, 1, STREAM_ID, length >> 8, length & 0xFF, 0x84, 0x80, 5]
    body[:, 9], body[:, 10], body[:, 11] = 0x21 | (pts >> 30 & 7) << 1, pts >> 22 & 0xFF, 1 | (pts >> 15 & 0x7F) << 1
    body[:, 12], body[:, 13] = pts >> 7 & 0xFF, 1 | (pts & 0x7F) << 1
    body[:, PES_HEADER:] = samples
    # First packet: adaptation field of 8 bytes or, when everything fits, longer with stuffing.
    take = min(pes, head_room)
    field = BODY - take
    out[:, 0, 3] = 0x30
    out[:, 0, 4], out[:, 0, 5] = field - 1, 0x50
    for i, shift in enumerate((25, 17, 9, 1)):
        out[:, 0, 6 + i] = pts >> shift & 0xFF
    out[:, 0, 10] = (pts & 1) << 7 | 0x7E
    out[:, 0, 12 : 4 + field] = 0xFF
    out[:, 0, 4 + field :] = body[:, :take]
    full = rest // BODY
    out[:, 1 : 1 + full, 4:] = body[:, take : take + full * BODY].reshape(k, full, BODY)
    if left := rest - full * BODY:
        field = BODY - left
        out[:, -1, 3], out[:, -1, 4] = 0x30, field - 1
        if field > 1:
            out[:, -1, 5] = 0
            out[:, -1, 6 : 4 + field] = 0xFF
        out[:, -1, 4 + field :] = body[:, pes - left :]
    return out.reshape(k * n, PACKET)


def mux_bytes(payload: bytes) -> bytes:
    """A transport stream that holds the payload, any number of bytes of it."""
    data = np.frombuffer(payload, dtype=np.uint8)
    full = len(data) // UNIT
    parts = [_tables()]
    if full:
        parts.append(_units(data[: full * UNIT].reshape(full, UNIT), 0))
    if len(data) > full * UNIT:
        parts.append(_units(data[full * UNIT :].reshape(1, -1), full))
    packets = np.concatenate(parts)
    packets[2:, 3] |= (np.arange(len(packets) - 2) & 0xF).astype(np.uint8)
    return packets.tobytes()


def _read_section(packet: np.ndarray, start: int) -> bytes:
    raw = packet[start:].tobytes()
    raw = raw[1 + raw[0] :]
    size = 3 + ((raw[1] & 0xF) << 8 | raw[2])
    if size > len(raw) or crc_mpeg(raw[:size]):
        raise ValueError("a program table fails its CRC")
    return raw[:size]


def demux_bytes(media: bytes) -> dict:
    """Payload, access units and error counts of a stream with one program; ValueError if it is not a transport stream."""
    if not media or len(media) % PACKET:
        raise ValueError("not a whole number of transport packets")
    p = np.frombuffer(media, dtype=np.uint8).reshape(-1, PACKET)
    if (p[:, 0] != SYNC).any():
        raise ValueError("sync byte missing")
    pid = (p[:, 1].astype(np.int64) & 0x1F) << 8 | p[:, 2]
    starts, control = (p[:, 1] & 0x40) > 0, p[:, 3] >> 4 & 3
    begin = np.where(control & 2, 5 + p[:, 4].astype(np.int64), 4)
    has = (control & 1) > 0
    pmt_pid = es_pid = None
    if len(at := np.flatnonzero((pid == PAT_PID) & starts)):
        s = _read_section(p[at[0]], begin[at[0]])
        pmt_pid = next(((s[i + 2] & 0x1F) << 8 | s[i + 3] for i in range(8, len(s) - 4, 4) if s[i] << 8 | s[i + 1]), None)
    if pmt_pid is not None and len(at := np.flatnonzero((pid == pmt_pid) & starts)):
        s = _read_section(p[at[0]], begin[at[0]])
        i = 12 + ((s[10] & 0xF) << 8 | s[11])
        es_pid = (s[i + 1] & 0x1F) << 8 | s[i + 2]
    if es_pid is None:
        raise ValueError("no elementary stream in the program tables")
    flags = np.where((control & 2 > 0) & (p[:, 4] > 0), p[:, 5], 0)
    gaps, keep = 0, np.ones(len(p), dtype=bool)
    for own in (PAT_PID, pmt_pid, es_pid):
        rows = np.flatnonzero((pid == own) & has)
        step = np.diff((p[rows, 3] & 0xF).astype(np.int64)) % 16
        # A packet may be sent twice: the second has the counter and the payload of the first, and is left out.
        twice = step == 0
        twice[twice] = [bool((p[a, begin[a] :] == p[b, begin[b] :]).all()) if begin[a] == begin[b] else False for a, b in zip(rows[:-1][twice], rows[1:][twice], strict=True)]
        twice[1:] &= ~twice[:-1]
        keep[rows[1:][twice]] = False
        # A counter may jump where the packet says so.
        gaps += int(((step != 1) & ~twice & (flags[rows[1:]] & 0x80 == 0)).sum())
    es = np.flatnonzero((pid == es_pid) & has & keep)
    q, b = p[es], begin[es]
    mask = np.arange(PACKET) >= b[:, None]
    data = q[mask]
    ends = np.cumsum(PACKET - b)
    at = np.flatnonzero(starts[es])
    random = (flags[es] & 0x40) > 0
    lo = np.concatenate(([0], ends))[at]
    hi = np.append(lo[1:], len(data))
    units, pieces, offset = [], [], 0
    for i, x, y in zip(at.tolist(), lo.tolist(), hi.tolist(), strict=True):
        h = data[x : x + PES_HEADER].tobytes()
        if h[:3] != b"\0\0\1":
            raise ValueError("no PES start code")
        size = h[4] << 8 | h[5]
        pts = (h[9] >> 1 & 7) << 30 | h[10] << 22 | (h[11] >> 1) << 15 | h[12] << 7 | h[13] >> 1 if h[7] & 0x80 else None
        piece = data[x + 9 + h[8] : min(y, x + 6 + size) if size else y]
        units.append((pts, offset, len(piece), bool(random[i])))
        pieces.append(piece)
        offset += len(piece)
    samples = np.concatenate(pieces) if pieces else np.zeros(0, dtype=np.uint8)
    return {"samples": samples, "units": units, "packets": len(p), "gaps": gaps, "pmt_pid": pmt_pid, "es_pid": es_pid}


def mux(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, media): the text's UTF-8 with zero bytes up to a positive multiple of 64, as a transport stream."""
    id_type = docs.select(id_col).schema[0]

    def run(batches):
        for part, texts in text_batches(batches, rows=128):
            raw = [t.encode() for t in texts]
            made = [mux_bytes(r.ljust(max(1, -(-len(r) // BLOCK)) * BLOCK, b"\0")) for r in raw]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(r) for r in raw], pa.int64()), pa.array(made, pa.binary())], names=[id_col, "n_bytes", "media"])

    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, f"`{id_col}` {id_type.dataType.simpleString()}, n_bytes long, media binary")


def demux(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Reads stored streams of `mux` back.

    Rows (id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, units): units are
    the access units (pts, offset, size, random_access) in stream order; feature sums up stream and samples.
    """
    id_type = media.select(id_col).schema[0]
    names = [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "units"]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = []
                for stored in part.column("media").to_pylist():
                    d = demux_bytes(stored)
                    s, u = d["samples"], d["units"]
                    data = s.tobytes()
                    flips = int(((s[1:] >= 128) != (s[:-1] >= 128)).sum())
                    points = sum(x[3] for x in u)
                    feature = f"packets={d['packets']};units={len(u)};random_access={points};gaps={d['gaps']};first_pts={u[0][0]};last_pts={u[-1][0]};sum={int(s.sum(dtype=np.int64))};peak={int(s.max())};crossings={flips}"
                    rows.append((len(s), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-BLOCK:]), len(stored), hashlib.sha256(stored).hexdigest(), feature, [dict(zip(("pts", "offset", "size", "random_access"), x, strict=True)) for x in u]))
                cols = list(zip(*rows, strict=True))
                types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(AU_TYPE)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

    schema = f"`{id_col}` {id_type.dataType.simpleString()}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, units array<struct<pts: long, offset: long, size: long, random_access: boolean>>"
    return media.select(id_col, "n_bytes", "media").mapInArrow(run, schema)
