"""Media column: MPEG audio streams; Layer III streams are written that carry bytes losslessly.

``compose`` makes a stream: an ID3v2 tag, a header frame with a variable-
bitrate table, then silent frames whose ancillary area holds the payload. Each
payload frame has a CRC-16 over its header and side information; the header
frame has a CRC-16 over all later frames and one over itself. The last frame
uses the smallest bitrate that fits, so the stream is of variable bitrate.

``parse`` reads streams of MPEG-1, 2 and 2.5 in Layers I, II and III: it parses
tags in front (ID3v2.2 to 2.4) and behind (ID3v1, APEv2), resynchronises on
frame headers that are confirmed by a like header after them or the end,
parses Xing, Info and VBRI tables, verifies all checksums, and gives the exact
duration and each frame's offset. Frames of free bitrate state no size and are
skipped like foreign bytes.

Defined cases: a null text is an empty one, whose payload is 64 zero bytes;
equal texts give equal streams; an empty table gives no rows; damaged or
foreign bytes between frames are skipped and counted; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass, field
from fractions import Fraction
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from candela.llm.common import map_batches

# Fixed values of the format: kbit/s by index for MPEG-1 Layer III, and for the other versions and layers;
# Hz by index; subbands and bits of their allocations in Layer II.
BITRATES = (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320)
BITRATES_1_1 = (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448)
BITRATES_1_2 = (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384)
BITRATES_2_1 = (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256)
BITRATES_2 = (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160)
SAMPLE_RATES = (44100, 48000, 32000)
ALLOCATION_HIGH = ((11, 4), (12, 3), (7, 2))
ALLOCATION_LOW = ((2, 4), (10, 3))
ALLOCATION_2 = ((4, 4), (7, 3), (19, 2))
#: Written streams: 48 kHz mono; header, CRC and side information of a frame.
RATE_INDEX = 1
LEAD = 4 + 2 + 17
TABLE_BITRATE = 5
UNIT = 64
#: Bytes in a slice of the stream checksum.
SLICE = 256


def _crc_table(poly: int, reflected: bool) -> np.ndarray:
    out = np.arange(256, dtype="uint32") << (0 if reflected else 8)
    for _ in range(8):
        if reflected:
            out = np.where(out & 1, out >> 1 ^ poly, out >> 1)
        else:
            out = np.where(out & 0x8000, out << 1 ^ poly, out << 1) & 0xFFFF
    return out.astype("uint16")


#: CRC-16 with x^16 + x^15 + x^2 + 1: high bit first in frames, low bit first in the table's checksums.
FRAME_TABLE = _crc_table(0x8005, False).tolist()
STREAM_TABLE = _crc_table(0xA001, True)


@lru_cache(4096)
def frame_crc(protected: bytes) -> int:
    """CRC of a frame's last two header bytes and its side information."""
    crc = 0xFFFF
    for byte in protected:
        crc = (crc << 8 & 0xFFFF) ^ FRAME_TABLE[crc >> 8 ^ byte]
    return crc


@lru_cache(1)
def _shift() -> tuple[list[int], list[int]]:
    """What SLICE zero bytes make of a checksum, by its low and its high byte."""

    def zeros(crc: np.ndarray) -> np.ndarray:
        for _ in range(SLICE):
            crc = crc >> 8 ^ STREAM_TABLE[crc & 0xFF]
        return crc

    low = np.arange(256, dtype="uint16")
    return zeros(low).tolist(), zeros(low << 8).tolist()


def stream_crcs(parts: list[bytes]) -> list[int]:
    """CRC-16, low bit first, of each byte string: all slices go through the table together."""
    slices = [-(-len(p) // SLICE) for p in parts]
    # zero bytes in front do not change a checksum that starts at zero
    flat = b"".join(p.rjust(k * SLICE, b"\0") for p, k in zip(parts, slices, strict=True))
    columns = np.frombuffer(flat, "uint8").reshape(-1, SLICE).T.copy()
    crc = np.zeros(columns.shape[1], "uint16")
    for column in columns:
        crc = crc >> 8 ^ STREAM_TABLE[(crc & 0xFF).astype("uint8") ^ column]
    low, high = _shift()
    out, at, each = [], 0, crc.tolist()
    for k in slices:
        value = 0
        for own in each[at : at + k]:
            value = low[value & 0xFF] ^ high[value >> 8] ^ own
        out.append(value)
        at += k
    return out


def frame_size(bitrate: int, rate: int, padding: int = 0) -> int:
    return 144 * bitrate * 1000 // rate + padding


@lru_cache(32)
def _lead(index: int) -> bytes:
    """Header, CRC and side information of a written payload frame."""
    header = bytes((0xFF, 0xFA, index << 4 | RATE_INDEX << 2, 0xC0))
    side = bytes(17)
    return header + frame_crc(header[2:] + side).to_bytes(2, "big") + side


def capacity(index: int) -> int:
    return frame_size(BITRATES[index], SAMPLE_RATES[RATE_INDEX]) - LEAD


@dataclass
class _Draft:
    tag: bytes
    head: bytes
    audio: bytes
    frames: int


def _draft(payload: bytes) -> _Draft:
    top = len(BITRATES) - 1
    room = capacity(top)
    whole, rest = divmod(len(payload), room)
    body = np.zeros((whole, LEAD + room), "uint8")
    body[:, :LEAD] = np.frombuffer(_lead(top), "uint8")
    body[:, LEAD:] = np.frombuffer(payload, "uint8", whole * room).reshape(whole, room)
    audio, sizes = body.tobytes(), [LEAD + room] * whole
    if rest:
        index = next(k for k in range(1, top + 1) if capacity(k) >= rest)
        audio += _lead(index) + payload[whole * room :].ljust(capacity(index), b"\0")
        sizes.append(LEAD + capacity(index))
    text = b"\0payload_bytes\0" + str(len(payload)).encode()
    frame = b"TXXX" + struct.pack(">IH", len(text), 0) + text
    n = len(frame)
    tag = b"ID3\3\0\0" + bytes((n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127)) + frame
    head_size = frame_size(BITRATES[TABLE_BITRATE], SAMPLE_RATES[RATE_INDEX])
    total = head_size + len(audio)
    ends = np.concatenate([[0], np.cumsum([head_size, *sizes])])
    places = ends[np.arange(100) * (len(sizes) + 1) // 100] * 256 // total
    head = bytes((0xFF, 0xFB, TABLE_BITRATE << 4 | RATE_INDEX << 2, 0xC0)) + bytes(17)
    head += b"Xing" + struct.pack(">III", 15, len(sizes), total) + bytes(places.astype("uint8")) + struct.pack(">I", 0)
    return _Draft(tag, head, audio, len(sizes))


def compose(payloads: list[bytes]) -> list[bytes]:
    """A stream for each payload."""
    drafts = [_draft(p) for p in payloads]
    crcs = stream_crcs([d.audio for d in drafts])
    heads = []
    for d, crc in zip(drafts, crcs, strict=True):
        size = frame_size(BITRATES[TABLE_BITRATE], SAMPLE_RATES[RATE_INDEX])
        info = b"LAME3.100" + bytes((0x03,)) + bytes(18) + struct.pack(">IH", size + len(d.audio), crc)
        heads.append(d.head + info)
    checks = stream_crcs(heads)
    size = frame_size(BITRATES[TABLE_BITRATE], SAMPLE_RATES[RATE_INDEX])
    return [
        d.tag + (head + check.to_bytes(2, "big")).ljust(size, b"\0") + d.audio
        for d, head, check in zip(drafts, heads, checks, strict=True)
    ]


class Header(NamedTuple):
    """What the four bytes of a frame header say."""

    version: str  # "1", "2" or "2.5"
    layer: int
    rate: int
    kbps: int
    mode: int  # 3: one channel, 1: joint stereo
    extension: int
    guarded: bool  # a CRC follows
    size: int  # of the frame, in bytes
    samples: int

    @property
    def kind(self) -> tuple[str, int, int]:
        """What does not change within a stream."""
        return self[:3]

    @property
    def side(self) -> int:
        """Bytes of side information; Layer III only."""
        if self.layer != 3:
            return 0
        one, two = (17, 32) if self.version == "1" else (9, 17)
        return one if self.mode == 3 else two

    @property
    def bound(self) -> int:
        """The subband from which on the channels of Layers I and II share allocations."""
        return 4 * (self.extension + 1) if self.mode == 1 else 32


def _header(data: bytes, at: int) -> Header | None:
    """The frame header that stands there, if one does."""
    if at + 4 > len(data) or data[at] != 0xFF or data[at + 1] < 0xE0:
        return None
    return _decoded(data[at + 1], data[at + 2], data[at + 3])


@lru_cache(65536)
def _decoded(second: int, third: int, fourth: int) -> Header | None:
    version = {0: "2.5", 2: "2", 3: "1"}.get(second >> 3 & 3)
    layer, index, rate = 4 - (second >> 1 & 3), third >> 4, third >> 2 & 3
    if version is None or layer == 4 or index in (0, 15) or rate == 3 or fourth & 3 == 2:
        return None
    hz = SAMPLE_RATES[rate] // {"1": 1, "2": 2, "2.5": 4}[version]
    if version == "1":
        kbps = (BITRATES_1_1, BITRATES_1_2, BITRATES)[layer - 1][index]
    else:
        kbps = (BITRATES_2_1, BITRATES_2, BITRATES_2)[layer - 1][index]
    samples = 384 if layer == 1 else 576 if layer == 3 and version != "1" else 1152
    slot = 4 if layer == 1 else 1  # bytes that padding adds
    size = (samples // 8 // slot * kbps * 1000 // hz + (third >> 1 & 1)) * slot
    return Header(version, layer, hz, kbps, fourth >> 6, fourth >> 4 & 3, not second & 1, size, samples)


def allocations(head: Header) -> list[int]:
    """Bits of each subband's allocation in Layer II."""
    if head.version != "1":
        groups, most = ALLOCATION_2, 30
    else:
        each = head.kbps if head.mode == 3 else head.kbps // 2
        if each < 56:
            groups, most = ALLOCATION_LOW, 12 if head.rate == 32000 else 8
        else:
            groups, most = ALLOCATION_HIGH, 30 if each >= 96 and head.rate != 48000 else 27
    return [bits for n, bits in groups for _ in range(n)][:most]


def guarded_bits(head: Header, frame: bytes) -> tuple[bytes, int]:
    """What a frame's CRC covers: bytes from the header's third on without the CRC itself, and how many of their bits."""
    rest, channels = frame[6:], 1 if head.mode == 3 else 2
    if head.layer == 3:
        bits = 8 * head.side
    elif head.layer == 1:
        bits = 4 * (min(32, head.bound) * channels + 32 - head.bound)
    else:
        number, width = int.from_bytes(rest[:64].ljust(64, b"\0"), "big"), 512
        bits = chosen = 0
        for band, n in enumerate(allocations(head)):
            own = channels if band < head.bound else 1
            for _ in range(own):
                bits += n
                # an allocation that both channels share selects scale factors for both
                chosen += (number >> (width - bits) & (1 << n) - 1 > 0) * (channels if own == 1 else 1)
        bits += 2 * chosen
    return frame[2:4] + rest[: -(-bits // 8)], 16 + bits


def frame_is_whole(head: Header, frame: bytes) -> bool:
    """Whether a guarded frame's CRC is what its bits give."""
    covered, bits = guarded_bits(head, frame)
    whole = bits // 8
    crc = frame_crc(covered[:whole])
    for k in range(bits % 8):
        crc = (crc << 1 & 0xFFFF) ^ (0x8005 if (crc >> 15) ^ (covered[whole] >> (7 - k) & 1) else 0)
    return crc == frame[4] << 8 | frame[5]


@dataclass
class Parsed:
    tags: dict[str, str] = field(default_factory=dict)
    version: str = ""  # of the first frame
    layer: int = 0
    offsets: list[int] = field(default_factory=list)  # of audio frames
    sizes: list[int] = field(default_factory=list)
    by_rate: dict[int, int] = field(default_factory=dict)  # samples
    rate: int = 0  # of the last frame
    skipped: int = 0  # bytes that belong to no frame and no tag
    frame_crc_good: int = 0
    frame_crc_bad: int = 0
    table_frames: int | None = None
    table_bytes: int | None = None
    toc: bytes = b""
    seek: list[int] = field(default_factory=list)  # bytes of each entry of a VBRI table
    stream_crc_good: bool | None = None
    table_crc_good: bool | None = None
    payload: bytes = b""
    stated: tuple[bytes, int, int] | None = None  # checked part of the table, its checksum, the stream's
    end: int = 0  # of the audio, where tags begin that stand behind it

    @property
    def samples(self) -> int:
        return sum(self.by_rate.values())

    @property
    def seconds(self) -> Fraction:
        return sum((Fraction(n, rate) for rate, n in self.by_rate.items()), Fraction(0))

    @property
    def duration(self) -> float:
        return float(self.seconds)


def _synchsafe(data: bytes) -> int:
    """Seven bits of each byte."""
    out = 0
    for byte in data:
        out = out << 7 | byte & 127
    return out


def _text(data: bytes) -> list[str]:
    """The strings of a tag's text entry, by its encoding byte."""
    name = {0: "latin-1", 1: "utf-16", 2: "utf-16-be", 3: "utf-8"}.get(data[0], "latin-1") if data else "latin-1"
    # every string of UTF-16 may begin with its own byte order mark
    return [part.strip("\ufeff") for part in data[1:].decode(name, "replace").split("\0")]


def _tags(data: bytes) -> tuple[dict[str, str], int]:
    """Text entries of an ID3v2 tag in front, user entries by their description, and where the tag ends."""
    if data[:3] != b"ID3" or len(data) < 10:
        return {}, 0
    version, flags = data[3], data[5]
    end = 10 + _synchsafe(data[6:10])
    body = data[10:end]
    if flags & 0x80 and version < 4:
        body = body.replace(b"\xff\0", b"\xff")
    found, at = {}, 0
    if flags & 0x40 and version >= 3 and len(body) >= 4:
        at = _synchsafe(body[:4]) if version >= 4 else 4 + int.from_bytes(body[:4], "big")
    lead, name_size = (6, 3) if version == 2 else (10, 4)
    while at + lead <= len(body) and body[at] != 0:
        name, size = body[at : at + name_size].decode("latin-1"), body[at + name_size : at + 2 * name_size]
        n = _synchsafe(size) if version >= 4 else int.from_bytes(size, "big")
        value = body[at + lead : at + lead + n]
        if version >= 4:
            if body[at + 9] & 1:  # four bytes of length come first
                value = value[4:]
            if body[at + 9] & 2 or flags & 0x80:
                value = value.replace(b"\xff\0", b"\xff")
        if name in ("TXXX", "TXX"):
            key, *rest = _text(value)
            found[key] = rest[0] if rest else ""
        elif name.startswith("T"):
            found[name] = _text(value)[0]
        at += lead + n
    return found, end + 10 * (version >= 4 and flags & 0x10 > 0)


def _tags_behind(data: bytes, start: int) -> tuple[dict[str, str], int]:
    """Entries of ID3v1 and APEv2 tags at the end, and where the first of them begins."""
    found, end = {}, len(data)
    if end - 128 >= start and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        for name, at, n in (("title", 3, 30), ("artist", 33, 30), ("album", 63, 30), ("year", 93, 4), ("comment", 97, 30)):
            found[name] = data[end + at : end + at + n].split(b"\0")[0].rstrip().decode("latin-1")
    if end - 32 >= start and data[end - 32 : end - 24] == b"APETAGEX":
        _, size, count, flags = struct.unpack("<IIII", data[end - 24 : end - 8])
        at = end - size
        if start <= at <= end - 32:
            stop, end = end - 32, at - 32 * (flags >> 31)
            for _ in range(count):
                if at + 8 > stop:
                    break
                n, item = struct.unpack("<II", data[at : at + 8])
                key, _, _ = data[at + 8 : stop].partition(b"\0")
                at += 9 + len(key)
                if item >> 1 & 3 == 0:  # text
                    found[key.decode("latin-1")] = data[at : at + n].decode("utf-8", "replace")
                at += n
            end = max(end, start)
    return found, end


def _parse(data: bytes) -> Parsed:
    """What a stream holds, but for the checksums that the table states."""
    out = Parsed()
    front, at = _tags(data)
    behind, n = _tags_behind(data, min(at, len(data)))
    out.tags, out.end = {**behind, **front}, n
    bodies: list[bytes] = []
    first, synced = True, None  # the kind of the frame that ends here
    while at + 4 <= n:
        head = _header(data, at)
        if head is not None:
            stop = at + head.size
            if stop > n:
                head = None
            elif head.kind != synced and stop < n:
                following = _header(data, stop)
                if following is None or following.kind != head.kind:
                    head = None
        if head is None:
            following = data.find(b"\xff", at + 1)
            following = n if following < 0 else min(following, n)
            out.skipped += following - at
            at, synced = following, None
            continue
        synced = head.kind
        body = at + 4 + 2 * head.guarded + head.side
        if first:
            out.version, out.layer = head.version, head.layer
        if first and head.layer == 3 and data[body : body + 4] in (b"Xing", b"Info"):
            _table(out, data[:stop], at, body)
        elif first and head.layer == 3 and data[at + 36 : at + 40] == b"VBRI":
            _sums(out, data[at + 40 : stop])
        else:
            if head.guarded:
                good = frame_is_whole(head, data[at:stop])
                out.frame_crc_good += good
                out.frame_crc_bad += not good
            out.offsets.append(at)
            out.sizes.append(head.size)
            out.by_rate[head.rate] = out.by_rate.get(head.rate, 0) + head.samples
            bodies.append(data[body:stop])
        out.rate = head.rate
        first = False
        at = stop
    out.skipped += max(0, n - at)
    out.payload = b"".join(bodies)
    if (stated := out.tags.get("payload_bytes", "")).isdigit():
        out.payload = out.payload[: int(stated)]
    return out


def _sums(out: Parsed, table: bytes) -> None:
    """Reads a VBRI table, which states the bytes of equal numbers of frames."""
    if len(table) < 22:
        return
    out.table_bytes, out.table_frames, entries, scale, width = struct.unpack(">IIHHH", table[6:20])
    places = range(22, 22 + entries * width, width) if width else ()
    out.seek = [scale * int.from_bytes(table[k : k + width], "big") for k in places if k + width <= len(table)]


def _table(out: Parsed, data: bytes, start: int, at: int) -> None:
    """Reads the variable-bitrate table of the header frame; a table that is cut short is left out."""
    if at + 8 > len(data):
        return
    (flags,) = struct.unpack(">I", data[at + 4 : at + 8])
    at += 8
    if at + 4 * (flags & 1) + 2 * (flags & 2) + 25 * (flags & 4) + (flags >> 1 & 4) > len(data):
        return
    if flags & 1:
        (out.table_frames,) = struct.unpack(">I", data[at : at + 4])
        at += 4
    if flags & 2:
        (out.table_bytes,) = struct.unpack(">I", data[at : at + 4])
        at += 4
    if flags & 4:
        out.toc = data[at : at + 100]
        at += 100
    if flags & 8:
        at += 4
    if data[at : at + 4] == b"LAME" and at + 36 <= len(data):
        out.stated = data[start : at + 34], *struct.unpack(">HH", data[at + 34 : at + 36] + data[at + 32 : at + 34])


def parse_all(streams: list[bytes]) -> list[Parsed]:
    """Every stream parsed, with the stated checksums of stream and table verified."""
    found = [_parse(s) for s in streams]
    stating = [(s, p) for s, p in zip(streams, found, strict=True) if p.stated]
    audio = stream_crcs([s[p.offsets[0] : p.end] if p.offsets else b"" for s, p in stating])
    tables = stream_crcs([p.stated[0] for _, p in stating])
    for (_, p), of_audio, of_table in zip(stating, audio, tables, strict=True):
        p.table_crc_good, p.stream_crc_good = of_table == p.stated[1], of_audio == p.stated[2]
    return found


def parse(data: bytes) -> Parsed:
    return parse_all([data])[0]


def feature(p: Parsed) -> str:
    """Exact duration, counts and checks in one string."""
    checks = p.frame_crc_bad == 0 and p.table_crc_good is not False and p.stream_crc_good is not False
    kbps = int(8 * sum(p.sizes) / (1000 * p.seconds)) if p.samples else 0
    return (
        f"mpeg{p.version}-layer{p.layer};hz={p.rate};frames={len(p.offsets)};samples={p.samples};us={int(p.seconds * 1_000_000)};"
        f"kbps={kbps};table_frames={p.table_frames};toc={p.toc.hex()};skipped={p.skipped};checks={'ok' if checks else 'bad'}"
    )


def padded(raw: bytes) -> bytes:
    """Zero bytes up to a positive multiple of the unit."""
    return raw.ljust(max(UNIT, -(-len(raw) // UNIT) * UNIT), b"\0")


def store_documents(docs: DataFrame, keep_media: bool = False) -> DataFrame:
    """What storing each text as a stream and reading it back gives; with ``keep_media`` also the stream."""
    kinds = {
        "n_bytes": ("long", pa.int64()),
        "payload_bytes": ("long", pa.int64()),
        "payload_sha256": ("string", pa.string()),
        "tail_crc32": ("long", pa.int64()),
        "media_bytes": ("long", pa.int64()),
        "media_sha256": ("string", pa.string()),
        "feature": ("string", pa.string()),
        "duration_s": ("double", pa.float64()),
        "frame_offsets": (None, pa.list_(pa.int64())),
    }
    if keep_media:
        kinds["media"] = ("binary", pa.binary())
    from pyspark.sql.types import ArrayType, LongType

    schema = docs.select("doc_id").schema
    for name, (kind, _) in kinds.items():
        schema = schema.add(name, kind or ArrayType(LongType()))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw = [(t or "").encode() for t in batch.column(1).to_pylist()]
        streams = compose([padded(r) for r in raw])
        rows = []
        for r, stream, p in zip(raw, streams, parse_all(streams), strict=True):
            row = (len(r), len(p.payload), hashlib.sha256(p.payload).hexdigest(), zlib.crc32(p.payload[-UNIT:]))
            row += (len(stream), hashlib.sha256(stream).hexdigest(), feature(p), p.duration, p.offsets)
            rows.append(row + (stream,) if keep_media else row)
        columns = zip(zip(*rows, strict=True), kinds.values(), strict=True)
        arrays = [pa.array(c, kind) for c, (_, kind) in columns]
        return pa.RecordBatch.from_arrays([batch.column(0), *arrays], schema.names)

    return map_batches(docs.select("doc_id", "text"), schema, work)
