"""Media columns in the Ogg container.

Writer: packets are laced into pages, a checksum is put on each page, and the
pages of several logical streams are interleaved in granule order.  Reader: page
checksums are verified (a broken page is skipped up to the next capture pattern
and the packet it cut is dropped), packets are reassembled from lacing values
across pages, logical streams are demultiplexed by serial number, and timestamps
are derived from granule positions.

Defined results: a null text is empty; an empty text is stored as 64 zero bytes;
equal texts give equal stored forms (serial numbers come from the payload);
repeated rows are handled one by one; a very long text fills as many pages as it
takes; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import rows_of, table, text_slices

CAPTURE = b"OggS"
HEADER = struct.Struct("<4sBBqIIIB")
CONTINUED, FIRST, LAST = 1, 2, 4
NO_GRANULE = -1
RATE = 8000
PACKET = 4000
ALIGN = 64
PCM_MAGIC, MARK_MAGIC = b"QFPCM8\0\0", b"QFMARK\0\0"
_REVERSED = bytes(int(f"{b:08b}"[::-1], 2) for b in range(256))


def page_crc(data: bytes) -> int:
    """The container's checksum: polynomial 04c11db7, most significant bit first, from zero.

    zlib's CRC has the same polynomial with bits reversed, so it is taken over
    bit-reversed bytes, without its own initial and final inversion, and reversed.
    """
    x = zlib.crc32(data.translate(_REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(x.to_bytes(4, "little").translate(_REVERSED), "big")


@dataclass
class Page:
    serial: int
    number: int
    granule: int
    flags: int
    lacing: bytes
    body: bytes
    ok: bool = True

    def pack(self) -> bytes:
        head = HEADER.pack(CAPTURE, 0, self.flags, self.granule, self.serial, self.number, 0, len(self.lacing)) + self.lacing
        crc = page_crc(head + self.body)
        return head[:22] + crc.to_bytes(4, "little") + head[26:] + self.body


@dataclass
class Packet:
    serial: int
    number: int
    granule: int  # of the page on which it ends; NO_GRANULE if another packet ends later on that page
    data: bytes


def to_pages(serial: int, packets: list[tuple[bytes, int]]) -> list[Page]:
    """Laces (data, granule at its end) packets of one stream into pages of up to 255 segments.

    The first packet, a stream's header, has the first page for itself.
    """
    pages: list[Page] = []
    lacing, body, granule, continued = bytearray(), bytearray(), NO_GRANULE, 0

    def flush(last: bool = False) -> None:
        nonlocal lacing, body, granule
        flags = continued | (FIRST if not pages else 0) | (LAST if last else 0)
        pages.append(Page(serial, len(pages), granule, flags, bytes(lacing), bytes(body)))
        lacing, body, granule = bytearray(), bytearray(), NO_GRANULE

    for k, (data, end) in enumerate(packets):
        segments = b"\xff" * (len(data) // 255) + bytes([len(data) % 255])
        at = pos = 0
        while at < len(segments):
            if len(lacing) == 255:
                flush()
                continued = CONTINUED if at else 0
            take = segments[at : at + 255 - len(lacing)]
            size = sum(take) if take[-1] != 255 else 255 * len(take)
            lacing += take
            body += data[pos : pos + size]
            at, pos = at + len(take), pos + size
        granule = end
        if k == 0 and len(packets) > 1:
            flush()
            continued = 0
    if packets:
        flush(last=True)
    return pages


def multiplex(streams: list[list[Page]]) -> bytes:
    """One physical stream: every stream's first page, then the others by granule."""
    heads = [s[0] for s in streams if s]
    rest = []
    for k, s in enumerate(streams):
        due = 0
        for p in s[1:]:
            due = max(due, p.granule)
            rest.append((due, k, p.number, p))
    rest.sort(key=lambda x: x[:3])
    return b"".join(p.pack() for p in [*heads, *(x[3] for x in rest)])


def read_pages(media: bytes) -> Iterator[Page]:
    """Pages in file order; one that fails its checksum comes with ``ok`` false and without a body."""
    at = media.find(CAPTURE)
    while 0 <= at and at + HEADER.size <= len(media):
        _, version, flags, granule, serial, number, crc, n = HEADER.unpack_from(media, at)
        start = at + HEADER.size
        lacing = media[start : start + n]
        end = start + n + sum(lacing)
        if version == 0 and len(lacing) == n and end <= len(media) and page_crc(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : end]) == crc:
            yield Page(serial, number, granule, flags, lacing, media[start + n : end])
            at = media.find(CAPTURE, end) if media[end : end + 4] != CAPTURE else end
        else:
            yield Page(serial, number, granule, flags, lacing, b"", False)
            at = media.find(CAPTURE, at + 4)


def read_packets(pages: Iterator[Page]) -> Iterator[Packet]:
    """Whole packets of all logical streams; a packet that lost a part is dropped."""
    open_part: dict[int, bytearray | None] = {}
    expected: dict[int, int] = {}
    counts: dict[int, int] = {}
    for p in pages:
        if not p.ok:
            continue
        serial = p.serial
        part = open_part.get(serial)
        if not p.flags & CONTINUED or expected.get(serial, p.number) != p.number:
            part = None
        skip = bool(p.flags & CONTINUED) and part is None
        expected[serial] = p.number + 1
        done, pos, run = [], 0, 0
        for x in p.lacing:
            run += x
            if x < 255:
                data = p.body[pos : pos + run]
                pos, run = pos + run, 0
                if part is not None:
                    data, part = bytes(part) + data, None
                if skip:
                    skip = False
                    continue
                done.append(data)
        if run:
            tail = p.body[pos : pos + run]
            part = part + tail if part is not None else (None if skip else bytearray(tail))
        open_part[serial] = part
        for k, data in enumerate(done):
            n = counts.get(serial, 0)
            counts[serial] = n + 1
            yield Packet(serial, n, p.granule if k == len(done) - 1 else NO_GRANULE, data)


def seconds(granule: int, rate: int) -> float | None:
    return None if granule == NO_GRANULE else granule / rate


def store(payload: bytes, *, rate: int = RATE, packet: int = PACKET) -> bytes:
    """8-bit samples in one logical stream, and in a second the checksum of each sample packet."""
    digest = zlib.crc32(payload)
    packets, marks = [(PCM_MAGIC + struct.pack("<IQ", rate, len(payload)), 0)], [(MARK_MAGIC + struct.pack("<I", packet), 0)]
    sums = []
    for at in range(0, len(payload), packet):
        data = payload[at : at + packet]
        packets.append((data, at + len(data)))
        sums.append(zlib.crc32(data))
        if len(sums) == 64 or at + packet >= len(payload):
            marks.append((struct.pack(f"<{len(sums)}I", *sums), at + len(data)))
            sums = []
    serial = digest & 0x7FFFFFFF
    return multiplex([to_pages(serial, packets), to_pages(serial | 0x80000000, marks)])


def load(media: bytes) -> tuple[bytes, dict]:
    """The samples read back, and what the container says of them; raises ValueError on damage."""
    pages = list(read_pages(media))
    bad = sum(not p.ok for p in pages)
    packets = list(read_packets(iter(pages)))
    heads = {p.serial: p.data[:8] for p in packets if p.number == 0}
    pcm = next((s for s, m in heads.items() if m == PCM_MAGIC), None)
    marks = next((s for s, m in heads.items() if m == MARK_MAGIC), None)
    if pcm is None or marks is None:
        raise ValueError("a logical stream is missing")
    data = [p.data for p in packets if p.serial == pcm]
    rate, size = struct.unpack_from("<IQ", data[0], 8)
    sums = b"".join(p.data for p in packets if p.serial == marks and p.number)
    payload = b"".join(data[1:])
    if bad or len(payload) != size or sums != b"".join(zlib.crc32(x).to_bytes(4, "little") for x in data[1:]):
        raise ValueError("the stored stream is damaged")
    times = [p.granule for p in packets if p.serial == pcm and p.granule != NO_GRANULE]
    return payload, {"pages": len(pages), "packets": len(packets), "streams": len(heads), "rate": rate, "seconds": seconds(times[-1], rate)}


def feature(payload: bytes, facts: dict) -> str:
    """Stream facts and level statistics of the samples about their middle value."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return (
        f"streams={facts['streams']};pages={facts['pages']};packets={facts['packets']};seconds={facts['seconds']:.6f}"
        f";sum={int(x.sum())};energy={int((x * x).sum())};peak={int(np.abs(x).max())};crossings={crossings}"
    )


def write_column(df: DataFrame, *, id_col: str, payload_col: str) -> DataFrame:
    """(id, media binary): each binary payload as an Ogg file of its own; null gives null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            media = [None if v is None else store(v) for v in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(media, pa.binary())], [id_col, "media"])

    picked = df.select(id_col, payload_col)
    return picked.mapInArrow(run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, media binary")


def packet_rows(df: DataFrame, *, id_col: str, media_col: str = "media", rate: int = RATE) -> DataFrame:
    """(id, serial, packet, granule, seconds, data) for every whole packet of every logical stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, media in enumerate(b.column(1).to_pylist()):
                found = list(read_packets(read_pages(media or b"")))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array([i] * len(found), pa.int64())),
                        pa.array([p.serial for p in found], pa.int64()),
                        pa.array([p.number for p in found], pa.int32()),
                        pa.array([None if p.granule == NO_GRANULE else p.granule for p in found], pa.int64()),
                        pa.array([seconds(p.granule, rate) for p in found], pa.float64()),
                        pa.array([p.data for p in found], pa.binary()),
                    ],
                    [id_col, "serial", "packet", "granule", "seconds", "data"],
                )

    picked = df.select(id_col, media_col)
    return picked.mapInArrow(run, f"`{id_col}` {picked.schema[0].dataType.simpleString()}, serial long, packet int, granule long, seconds double, data binary")


def round_trip(docs: DataFrame) -> DataFrame:
    """Stores each text's bytes, reads them back and describes them, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in text_slices(batch):
                out: list[list] = [[] for _ in range(7)]
                for text in texts:
                    raw = text.encode()
                    padded = raw + bytes(-len(raw) % ALIGN or (0 if raw else ALIGN))
                    media = store(padded)
                    back, facts = load(media)
                    row = (len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-ALIGN:]), len(media), hashlib.sha256(media).hexdigest(), feature(back, facts))
                    for col, v in zip(out, row, strict=True):
                        col.append(v)
                yield pa.RecordBatch.from_arrays([rows_of(batch, start, len(texts), "doc_id"), *map(pa.array, out)], NAMES)

    picked = docs.select("doc_id", "text")
    kinds = [picked.schema["doc_id"].dataType.simpleString(), "long", "long", "string", "long", "long", "string", "string"]
    return picked.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(NAMES, kinds, strict=True)))


NAMES = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]


def op2_ogg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` stored as 8-bit samples in Ogg and read back."""
    return round_trip(table(spark, sf_dir, "documents"))
