from __future__ import annotations

import hashlib
import os
import struct
import zlib

from candela.llm import mpeg


def slow_crc(data):
    crc = 0
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ 0xA001 if crc & 1 else crc >> 1
    return crc


def test_stream_checksum():
    parts = [b"", b"1", b"123456789", os.urandom(255), os.urandom(256), os.urandom(1000)]
    assert mpeg.stream_crcs(parts) == [slow_crc(p) for p in parts]
    assert slow_crc(b"123456789") == 0xBB3D


def test_round_trip():
    payloads = [bytes(64), b"\xff\xfb\x90\xc0" * 800, *[os.urandom(64 * k) for k in range(1, 60)]]
    for payload, stream, p in zip(payloads, mpeg.compose(payloads), mpeg.parse_all(mpeg.compose(payloads)), strict=True):
        assert p.payload == payload
        assert p.skipped == p.frame_crc_bad == 0 and p.stream_crc_good and p.table_crc_good
        assert p.table_frames == len(p.offsets) == p.frame_crc_good
        assert p.samples == 1152 * len(p.offsets) and p.duration == p.samples / 48000
        assert all(stream[o] == 0xFF for o in p.offsets)


def test_damage_is_noticed():
    stream = mpeg.compose([os.urandom(6400)])[0]
    clean = mpeg.parse(stream)
    at = clean.offsets[2]
    torn = mpeg.parse(stream[:at] + b"junk\xff\xfb" + stream[at:])
    assert torn.skipped == 6 and len(torn.offsets) == len(clean.offsets) and torn.stream_crc_good is False
    flipped = bytearray(stream)
    flipped[at + 10] ^= 1
    assert mpeg.parse(bytes(flipped)).frame_crc_bad == 1
    assert mpeg.parse(b"").offsets == [] and mpeg.parse(os.urandom(500)).payload is not None


def test_rows(odd, none):
    rows = mpeg.store_documents(odd, keep_media=True).collect()
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id is None:
            continue
        raw = (texts[r.doc_id] or "").encode()
        padded = raw + bytes(-len(raw) % 64 or 0) if raw else bytes(64)
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(padded))
        assert r.payload_sha256 == hashlib.sha256(padded).hexdigest() and r.tail_crc32 == zlib.crc32(padded[-64:])
        assert r.media_sha256 == hashlib.sha256(r.media).hexdigest() and r.media_bytes == len(r.media)
        assert r.feature.endswith("checks=ok")
    assert mpeg.store_documents(none).count() == 0


def bitwise_crc(bits):
    crc = 0xFFFF
    for bit in bits:
        crc, out = crc << 1 & 0xFFFF, crc >> 15
        crc ^= 0x8005 if out != int(bit) else 0
    return crc


def bits_of(data):
    return "".join(f"{byte:08b}" for byte in data)


def frame(r, version, layer, index, rate, mode, extension=0, size=0, covered=None):
    """A guarded frame whose checksum covers the bits ``covered`` after the header."""
    second = 0xE0 | {"1": 3, "2": 2, "2.5": 0}[version] << 3 | (4 - layer) << 1
    header = bytes((0xFF, second, index << 4 | rate << 2, mode << 6 | extension << 4))
    stuff = covered + "0" * (-len(covered) % 8)
    body = int(stuff, 2).to_bytes(len(stuff) // 8, "big")
    crc = bitwise_crc(bits_of(header[2:]) + covered).to_bytes(2, "big")
    out = header + crc + body
    return out + bytes(r.randrange(255) for _ in range(size - len(out)))  # no byte of a false header


def layer_two(r, groups, channels, bound):
    """Allocations and selections of random channels, as the standard lays them out."""
    out, chosen, band = "", 0, 0
    for number, width in groups:
        for _ in range(number):
            for _ in range(channels if band < bound else 1):
                value = r.choice((0, r.randrange(1 << width)))
                out += f"{value:0{width}b}"
                chosen += (value > 0) * (1 if band < bound else channels)
            band += 1
    return out + "".join(r.choice("01") for _ in range(2 * chosen))


def kinds(r):
    """Version, layer, bitrate and rate index, mode, extension, frame bytes, samples, Hz, a maker of the covered bits."""
    random_bits = lambda n: lambda: f"{r.getrandbits(n):0{n}b}"
    two = lambda *x: lambda: layer_two(r, *x)
    high, low, later = [(11, 4), (12, 3), (4, 2)], [(2, 4), (6, 3)], [(4, 4), (7, 3), (19, 2)]
    return [
        ("1", 3, 9, 0, 3, 0, 417, 1152, 44100, random_bits(8 * 17)),
        ("1", 3, 9, 1, 0, 0, 384, 1152, 48000, random_bits(8 * 32)),
        ("2", 3, 8, 0, 0, 0, 208, 576, 22050, random_bits(8 * 17)),
        ("2.5", 3, 1, 2, 3, 0, 72, 576, 8000, random_bits(8 * 9)),
        ("1", 1, 12, 1, 0, 0, 384, 384, 48000, random_bits(4 * 64)),
        ("1", 1, 12, 1, 1, 1, 384, 384, 48000, random_bits(4 * (8 * 2 + 24))),
        ("2", 1, 1, 1, 3, 0, 64, 384, 24000, random_bits(4 * 32)),
        ("1", 2, 10, 1, 0, 0, 576, 1152, 48000, two(high, 2, 32)),
        ("1", 2, 10, 1, 1, 2, 576, 1152, 48000, two(high, 2, 12)),
        ("1", 2, 1, 1, 3, 0, 96, 1152, 48000, two(low, 1, 32)),
        ("1", 2, 1, 2, 3, 0, 144, 1152, 32000, two([(2, 4), (10, 3)], 1, 32)),
        ("1", 2, 10, 2, 0, 0, 864, 1152, 32000, two([(11, 4), (12, 3), (7, 2)], 2, 32)),
        ("2", 2, 8, 1, 1, 0, 384, 1152, 24000, two(later, 2, 4)),
    ]


def test_every_version_and_layer():
    import random
    from fractions import Fraction

    r = random.Random(3)
    for version, layer, index, rate, mode, extension, size, samples, hz, covered in kinds(r):
        frames = [frame(r, version, layer, index, rate, mode, extension, size, covered()) for _ in range(7)]
        p = mpeg.parse(b"junk" + b"".join(frames[:3]) + b"\xff\xfbx" + b"".join(frames[3:]))
        what = (version, layer, size)
        assert (p.version, p.layer, p.rate, p.frame_crc_good, p.frame_crc_bad, p.skipped) == (version, layer, hz, 7, 0, 7), what
        assert p.offsets == [4 + k * size + 3 * (k >= 3) for k in range(7)] and p.sizes == [size] * 7, what
        assert p.seconds == Fraction(7 * samples, hz), what
        torn = bytearray(b"".join(frames))
        torn[3 * size + 6] ^= 0x10  # within what the checksum covers
        p = mpeg.parse(bytes(torn))
        assert p.frame_crc_bad == 1 and p.frame_crc_good == 6, what


def synchsafe(n):
    return bytes((n >> 21 & 127, n >> 14 & 127, n >> 7 & 127, n & 127))


def test_tags_in_front_and_behind():
    audio = mpeg.parse(mpeg.compose([bytes(6400)])[0])
    stream = mpeg.compose([bytes(6400)])[0]
    bare = stream[stream.index(b"\xff\xfb") :]
    entries = [("TIT2", 1, "Lied ü".encode("utf-16")), ("TXXX", 3, "mood\0helle Nächte".encode()), ("TPE1", 0, b"x" * 200)]
    body = b"".join(n.encode() + synchsafe(len(v) + 1) + b"\0\0" + bytes((e,)) + v for n, e, v in entries)
    front = b"ID3\4\0\x10" + synchsafe(len(body)) + body + b"3DI\4\0\x10" + synchsafe(len(body))
    item = struct.pack("<II", 4, 0) + b"Genre\0" + b"Folk"
    state = struct.pack("<IIII", 2000, len(item) + 32, 1, 1 << 31) + bytes(8)
    ape = b"APETAGEX" + state + item + b"APETAGEX" + state
    old = b"TAG" + b"Title".ljust(30, b"\0") + b"Someone".ljust(30) + bytes(30) + b"1999" + bytes(31)
    p = mpeg.parse(front + bare + ape + old)
    assert p.tags == {
        "TIT2": "Lied ü", "mood": "helle Nächte", "TPE1": "x" * 200, "Genre": "Folk",
        "title": "Title", "artist": "Someone", "album": "", "year": "1999", "comment": "",
    }
    assert p.skipped == 0 and p.stream_crc_good and p.seconds == audio.seconds and len(p.offsets) == len(audio.offsets)
    second = b"TT2" + (6).to_bytes(3, "big") + b"\0Early"
    p = mpeg.parse(b"ID3\2\0\0" + synchsafe(len(second)) + second + bare)
    assert p.tags == {"TT2": "Early"} and p.skipped == 0
    for tag in (front, ape, old, second):  # cut short, or alone
        for cut in (1, 5, len(tag) // 2, len(tag)):
            assert mpeg.parse(tag[:cut]).offsets == []


def test_table_of_equal_spans():
    import random

    r = random.Random(4)
    frames = [frame(r, "1", 3, 9, 0, 0, 0, 417, f"{r.getrandbits(256):0256b}") for _ in range(12)]
    spans = [5 * 417, 5 * 417, 2 * 417]
    table = b"VBRI" + struct.pack(">HHHIIHHHH", 1, 0, 75, 13 * 417, 12, len(spans), 1, 2, 5) + struct.pack(">3H", *spans)
    head = (bytes((0xFF, 0xFB, 0x90, 0)) + bytes(32) + table).ljust(417, b"\0")
    p = mpeg.parse(head + b"".join(frames))
    assert (p.table_frames, p.table_bytes, p.seek, len(p.offsets)) == (12, 13 * 417, spans, 12)
    assert mpeg.parse(head[:60].ljust(417, b"\0") + b"".join(frames)).offsets[0] == 417


def test_hostile_streams_are_read_to_the_end():
    import random

    r = random.Random(6)
    stream = mpeg.compose([r.randbytes(3000)])[0]
    for _ in range(300):
        torn = bytearray(stream)
        for _ in range(r.randint(1, 40)):
            torn[r.randrange(len(torn))] = r.choice((0, 0xFF, r.randrange(256)))
        p = mpeg.parse(bytes(torn[: r.randint(0, len(torn))]))
        assert all(a + n <= b for a, n, b in zip(p.offsets, p.sizes, p.offsets[1:], strict=False))
