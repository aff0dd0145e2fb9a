"""Secret scans: keyword automaton, anchored patterns near its hits, checksums in the found strings.

One pass of an Aho-Corasick automaton finds the keywords; each hit then tries
one anchored pattern at the hit. Runs of hexadecimal digits, which have no
keyword, are found as runs in a byte-class image of the text. Kinds with an
embedded checksum (CRC-32 in base 62, double SHA-256 in base 58) count only if
it agrees. Offsets are in code points: the text is taken as Latin-1 with one
byte for each code point, and characters beyond Latin-1 take part in no kind.

Defined cases: a null text is an empty one; matches of one kind never overlap,
those of different kinds may; copies and ties give equal rows; other columns
are ignored by ``scan_documents`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from candela.llm.common import map_batches

#: Kinds in their listed order. The first three are the base, the others carry checksums.
KINDS = ("assign", "access", "hex", "github", "npm", "xprv")
#: Keywords in lower case, and the kind that each starts.
KEYWORDS = {
    "password": "assign",
    "passwd": "assign",
    "secret": "assign",
    "token": "assign",
    "apikey": "assign",
    "api_key": "assign",
    "akia": "access",
    "ghp_": "github",
    "gho_": "github",
    "ghu_": "github",
    "ghs_": "github",
    "ghr_": "github",
    "npm_": "npm",
    "xprv": "xprv",
}
ANCHORED = {
    "assign": re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(rb"AKIA[A-Z0-9]+"),
    "github": re.compile(rb"gh[pousr]_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    "npm": re.compile(rb"npm_([0-9A-Za-z]{36})(?![0-9A-Za-z])"),
    "xprv": re.compile(rb"xprv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])"),
}
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE58 = b"123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
HEX_IMAGE = bytes(ord("h") if chr(c) in "0123456789abcdef" else ord(".") for c in range(256))
HEX_RUN = re.compile(rb"h{24,}")


def crc62(body: bytes) -> bytes:
    """CRC-32 of the body in six base-62 digits."""
    value, out = zlib.crc32(body), b""
    while value:
        value, digit = divmod(value, 62)
        out = BASE62[digit : digit + 1] + out
    return out.rjust(6, b"0")


def base58_checks(text: bytes) -> bool:
    """Whether the last four of the decoded bytes are the double SHA-256 of the others."""
    value = 0
    for c in text:
        value = value * 58 + BASE58.index(c)
    raw = value.to_bytes(82, "big") if value < 1 << 656 else b""
    return bool(raw) and hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def holds(kind: str, found: re.Match[bytes]) -> bool:
    """Whether a match is long enough, or its embedded checksum agrees."""
    if kind == "assign":
        return len(found[1]) >= 6
    if kind == "access":
        return len(found[0]) >= 20
    if kind == "xprv":
        return base58_checks(found[0])
    return crc62(found[1][:-6]) == found[1][-6:]


@lru_cache(1)
def automaton():
    import ahocorasick

    made = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        made.add_word(word, (len(word), kind))
    made.make_automaton()
    return made


def spans(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then in the order of KINDS; code points, end exclusive."""
    if not text:
        return []
    raw = text.encode("latin-1", "replace")
    hits = sorted((end + 1 - n, kind) for end, (n, kind) in automaton().iter(raw.lower().decode("latin-1")))
    found, free = [], dict.fromkeys(KINDS, 0)
    for start, kind in hits:
        if start >= free[kind] and (m := ANCHORED[kind].match(raw, start)):
            free[kind] = m.end()  # a match that fails below is still passed over
            if holds(kind, m):
                found.append((start, m.end(), kind))
    found += [(*m.span(), "hex") for m in HEX_RUN.finditer(raw.translate(HEX_IMAGE))]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_checked for every document."""
    schema = docs.select("doc_id").schema
    for name in ("n_assign", "n_access", "n_hex"):
        schema = schema.add(name, "long")
    schema = schema.add("base_sha256", "string").add("spans", "string").add("n_checked", "long")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column(1).to_pylist():
            found = spans(text)
            base = [s for s in found if s[2] in KINDS[:3]]
            n = [sum(s[2] == kind for s in base) for kind in KINDS[:3]]
            rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(found), len(found) - len(base)))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], [f.name for f in schema])

    return map_batches(docs.select("doc_id", "text"), schema, work)


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with each found stretch, overlapping ones as one, replaced by the mark."""
    found = spans(text)
    if not found:
        return text
    out, at = [], 0
    for start, end, _ in found:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns; secrets in text are replaced, and n_chars, if present, follows."""
    names = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index("text")
        before = batch.column(at).to_pylist()
        texts = [redacted(t, mark) for t in before]
        out = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
        if (k := batch.schema.get_field_index("n_chars")) >= 0:
            old = batch.column(k).to_pylist()
            new = [n if t is b else len(t) for n, t, b in zip(old, texts, before, strict=True)]
            out = out.set_column(k, batch.schema.field(k), pa.array(new, batch.schema.field(k).type))
        return out

    return map_batches(docs.select(*names), docs.schema, work)
