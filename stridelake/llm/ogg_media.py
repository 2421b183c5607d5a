"""Media columns in Ogg: payloads are multiplexed into a bitstream of pages and read back from it.

Reading verifies each page's checksum and sequence number, puts packets together from lacing values
(across pages too), separates logical streams by serial number, and gives each packet its start and end
time from the granule positions of pages.

A text is stored as 8-bit samples: stream 1 holds a header packet and packets of 576 samples whose granule
position counts samples; stream 2 holds one packet with the number of unpadded bytes.

Defined cases: a null or empty text is one block of padding; a text of any length is stored whole; equal
texts give equal media; repeated rows give repeated rows; an empty table gives an empty result; a null or
damaged media value is reported in the column `error`, with the other columns null.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.common import prepare, read, text_bytes

BLOCK, PAD, RATE = 576, 255, 48_000
SAMPLES, ABOUT = 1, 2
MAGIC = b"\x80pcm-u8"
#: The byte with its bits in reverse order.
REVERSED = bytes(int(f"{i:08b}"[::-1], 2) for i in range(256))
CONTINUED, FIRST, LAST = 1, 2, 4


class OggError(ValueError):
    pass


def page_checksum(page: bytes) -> int:
    """CRC-32 with polynomial 0x04c11db7, bits in plain order, from 0 and without a final inversion.

    zlib has the same polynomial with bits reversed, so bytes and result are reversed around it."""
    c = zlib.crc32(page.translate(REVERSED), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(c.to_bytes(4, "little").translate(REVERSED), "big")


def _page(flags: int, granule: int, serial: int, number: int, lacing: bytes, body: bytes) -> bytes:
    head = struct.pack("<4sBBqIIIB", b"OggS", 0, flags, granule, serial, number, 0, len(lacing))
    page = head + lacing + body
    return page[:22] + struct.pack("<I", page_checksum(page)) + page[26:]


def write_stream(serial: int, packets: list[tuple[bytes, int]]) -> list[bytes]:
    """Pages of one logical stream from (packet, granule position at its end). The first packet has a page of its own."""
    pages: list[bytes] = []

    def flush(lacing: bytearray, body: list[bytes], flags: int, granule: int, last: bool) -> None:
        pages.append(_page(flags | FIRST * (not pages) | LAST * last, granule, serial, len(pages), bytes(lacing), b"".join(body)))

    lacing, body, flags, granule = bytearray(), [], 0, -1
    for i, (packet, at) in enumerate(packets):
        values = b"\xff" * (len(packet) // 255) + bytes([len(packet) % 255])
        if len(values) > 255 - len(lacing) and len(values) <= 255 and lacing:
            flush(lacing, body, flags, granule, False)
            lacing, body, flags, granule = bytearray(), [], 0, -1
        done = 0
        while True:
            part = values[done : done + 255 - len(lacing)]
            lacing += part
            body.append(packet[255 * done : 255 * (done + len(part))])
            done += len(part)
            if done == len(values):
                granule = at
                break
            flush(lacing, body, flags, granule, False)
            lacing, body, flags, granule = bytearray(), [], CONTINUED, -1
        if i == 0 or i == len(packets) - 1:
            flush(lacing, body, flags, granule, i == len(packets) - 1)
            lacing, body, flags, granule = bytearray(), [], 0, -1
    return pages


def multiplex(streams: list[list[bytes]]) -> bytes:
    """Pages of several streams: all first pages, then the rest in turn."""
    out = [s[0] for s in streams]
    for k in range(1, max(map(len, streams))):
        out += [s[k] for s in streams if k < len(s)]
    return b"".join(out)


@dataclass
class Stream:
    """packets, the granule position at the end of each (-1: unknown), and whether the last page was seen."""

    packets: list[bytes] = field(default_factory=list)
    granules: list[int] = field(default_factory=list)
    pages: int = 0
    ended: bool = False

    def times(self, samples: list[int], rate: int = RATE) -> list[tuple[float, float]]:
        """Start and end in seconds of each packet, given its number of samples. A page's granule position is
        that of its last complete packet; earlier packets count back from it."""
        ends, at = [0] * len(self.packets), None
        for i in range(len(self.packets) - 1, -1, -1):
            at = self.granules[i] if self.granules[i] >= 0 else at
            if at is None:
                raise OggError("no granule position after the last packet")
            ends[i] = at
            at -= samples[i]
        return [((e - n) / rate, e / rate) for e, n in zip(ends, samples, strict=True)]


def demultiplex(data: bytes) -> dict[int, Stream]:
    """Logical streams by serial number; raises OggError on damage, gaps, or a packet that doesn't end."""
    streams: dict[int, Stream] = {}
    unfinished: dict[int, list[bytes]] = {}
    at, view = 0, memoryview(data)
    while at < len(data):
        if len(data) < at + 27 or data[at : at + 4] != b"OggS":
            raise OggError(f"no page at byte {at}")
        _, version, flags, granule, serial, number, checksum, n = struct.unpack_from("<4sBBqIIIB", data, at)
        lacing = data[at + 27 : at + 27 + n]
        end = at + 27 + n + sum(lacing)
        if version or len(lacing) < n or end > len(data):
            raise OggError(f"bad page header at byte {at}")
        if page_checksum(data[at : at + 22] + b"\0\0\0\0" + data[at + 26 : end]) != checksum:
            raise OggError(f"checksum of the page at byte {at}")
        stream = streams.setdefault(serial, Stream())
        if number != stream.pages or bool(flags & FIRST) != (number == 0) or stream.ended or bool(flags & CONTINUED) != (serial in unfinished):
            raise OggError(f"page {number} of stream {serial} is out of order")
        stream.pages += 1
        stream.ended = bool(flags & LAST)
        body, length, first = at + 27 + n, 0, len(stream.packets)
        for value in lacing:
            length += value
            if value < 255:
                packet = bytes(view[body : body + length])
                if serial in unfinished:
                    packet = b"".join(unfinished.pop(serial)) + packet
                stream.packets.append(packet)
                stream.granules.append(-1)
                body, length = body + length, 0
        if length or n and lacing[-1] == 255:
            unfinished.setdefault(serial, []).append(bytes(view[body : body + length]))
        if len(stream.packets) > first:
            stream.granules[-1] = granule
        at = end
    if unfinished:
        raise OggError("a packet doesn't end")
    return streams


def encode(raw: bytes) -> bytes:
    """Media of the given bytes."""
    blocks = max(1, -(-len(raw) // BLOCK))
    payload = raw + bytes([PAD]) * (blocks * BLOCK - len(raw))
    head = MAGIC + struct.pack("<IH", RATE, BLOCK)
    samples = [(head, 0)] + [(payload[i * BLOCK : (i + 1) * BLOCK], (i + 1) * BLOCK) for i in range(blocks)]
    about = [(b"\x80about" + struct.pack("<Q", len(raw)), 0)]
    return multiplex([write_stream(SAMPLES, samples), write_stream(ABOUT, about)])


@dataclass
class Media:
    n_bytes: int
    payload: bytes
    streams: int
    packets: int
    pages: int
    seconds: float


def decode(data: bytes) -> Media:
    streams = demultiplex(data)
    if set(streams) != {SAMPLES, ABOUT} or not all(s.ended for s in streams.values()):
        raise OggError("a stream is missing or doesn't end")
    s, about = streams[SAMPLES], streams[ABOUT].packets[0]
    if s.packets[0][: len(MAGIC)] != MAGIC or about[:6] != b"\x80about":
        raise OggError("unknown headers")
    rate, _ = struct.unpack("<IH", s.packets[0][len(MAGIC) :])
    times = s.times([0] + [len(p) for p in s.packets[1:]], rate)
    return Media(struct.unpack("<Q", about[6:])[0], b"".join(s.packets[1:]), len(streams), len(s.packets) - 1, sum(x.pages for x in streams.values()), times[-1][1])


def feature(m: Media) -> str:
    """Counts, duration, mean, deviation and crossings of the middle, of the samples read back."""
    x = np.frombuffer(m.payload, np.uint8)
    total, squares = int(x.sum(dtype=np.int64)), int(np.dot(x.astype(np.float32), x.astype(np.float32)) if len(x) < 256 else np.einsum("i,i->", x, x, dtype=np.int64))
    mean = total / len(x)
    above = x >= 128
    return f"streams={m.streams};pages={m.pages};packets={m.packets};seconds={m.seconds:.6f};mean={mean:.4f};std={max(0.0, squares / len(x) - mean * mean) ** 0.5:.4f};crossings={int(np.count_nonzero(above[1:] != above[:-1]))}"


def with_media(docs: DataFrame) -> DataFrame:
    """doc_id, media (binary): each text in Ogg."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            raw, cut = data.tobytes(), offsets.tolist()
            media = [encode(raw[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(media, pa.binary())], ["doc_id", "media"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, media binary")


READ = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"


def read_media(media: DataFrame, with_payload: bool = False) -> DataFrame:
    """From doc_id and media: what is read back, its digests and features; with the payload if asked for."""
    prepare(media.sparkSession)
    schema = READ + ", payload binary" * with_payload
    names = [c.split()[0] for c in schema.split(", ")]

    def one(data: bytes | None) -> tuple:
        try:
            if data is None:
                raise OggError("null")
            m = decode(data)
        except OggError as e:
            return (None,) * 7 + (str(e), None)
        return m.n_bytes, len(m.payload), hashlib.sha256(m.payload).hexdigest(), zlib.crc32(m.payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature(m), None, m.payload if with_payload else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
        for batch in batches:
            rows = [one(x.as_py()) for x in batch.column("media")]
            columns = [batch.column("doc_id"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))]
            yield pa.RecordBatch.from_arrays(columns[: len(names)], names)

    return media.select(F.col("doc_id").cast("long"), "media").mapInArrow(run, schema)


def op5_ogg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_media(with_media(read(spark, sf_dir, "documents"))).drop("error")
