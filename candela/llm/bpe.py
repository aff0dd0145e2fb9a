"""Byte-level BPE encoding and decoding.

Each byte of a piece becomes one Latin-1 character, so that the character trie
of an Aho-Corasick automaton finds vocabulary tokens in byte strings. The longest
match at each place is tried first; a choice stands only if the pair of
adjacent tokens could stand beside each other in a merge result, which is
remembered per pair. Backtracking drops a choice that leads nowhere. The
outcome is the one sequence in which all adjacent pairs are compatible, and
this is what rank-ordered merging gives, in time linear in the piece.

A text is cut at single spaces between two non-space characters, where the
split pattern always has a boundary; each chunk is encoded once per worker
and remembered in a dictionary of bounded size.

Defined cases: a null or empty text has no tokens; columns other than the two
that are named pass through in ``encode`` and are ignored elsewhere.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from candela.llm.common import map_batches

#: Chunks, and pieces and pairs, remembered per worker.
REMEMBERED, REMEMBERED_PIECES = 400_000, 100_000


class ByteBPE:
    """Encoder and decoder for one rank file, exact in the sense of rank-ordered merges."""

    def __init__(self, path: str, pattern: str) -> None:
        import ahocorasick
        import regex

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pattern = regex.compile(pattern)
        self.clean_space = regex.compile(r"(?<=\S) (?=\S)")
        self.automaton = ahocorasick.Automaton()
        self.names = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        for name, rank in self.names.items():
            self.automaton.add_word(name, rank)
        self.sizes = [len(token) for token in self.tokens]
        self.most = max(self.sizes)
        self.halves = self._halves()
        self.shorter = self._shorter()
        self.pairs: dict[int, bool] = {}
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _halves(self) -> list[tuple[int, int] | None]:
        """The two tokens that were merged last in making each token; None for single bytes."""
        halves: list[tuple[int, int] | None] = [None] * len(self.tokens)
        for token, rank in self.ranks.items():
            if len(token) > 1:
                parts = self._merged(token, rank)
                if len(parts) == 2:
                    halves[rank] = (self.ranks[parts[0]], self.ranks[parts[1]])
        return halves

    def _merged(self, piece: bytes, below: int) -> list[bytes]:
        """Rank-ordered merging with the ranks below a bound, used only on the vocabulary itself."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        ranks = self.ranks
        while len(parts) > 1:
            rank, at = min((ranks.get(parts[i] + parts[i + 1], below), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _shorter(self) -> list[int]:
        """For each token, its longest proper prefix that is a token; -1 if there is none."""
        found = [-1] * len(self.tokens)
        for token, rank in self.ranks.items():
            for n in range(len(token) - 1, 0, -1):
                if (shorter := self.ranks.get(token[:n])) is not None:
                    found[rank] = shorter
                    break
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging keeps these two apart: no earlier merge crosses their border.

        Walks down the halves along the border. At each step the pair that
        touches the border must not be a token that ranks below the merge that
        hides it.
        """
        ranks, tokens, halves = self.ranks, self.tokens, self.halves
        bound = len(tokens)
        while True:
            crossing = ranks.get(tokens[left] + tokens[right])
            if crossing is not None and crossing < bound:
                return False
            # the later merge is undone first; of equal merges the left one comes first
            if halves[right] is not None and (right >= left or halves[left] is None):
                bound = right + 1
                right = halves[right][0]
            elif halves[left] is not None:
                bound = left
                left = halves[left][1]
            else:
                return True

    def encode_piece(self, piece: bytes) -> list[int]:
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        text = piece.decode("latin-1")
        n, most, sizes, names = len(piece), self.most, self.sizes, self.names
        longest, pairs = self.automaton.longest_prefix, self.pairs
        dead: set[int] = set()  # ends from which no way leads on
        out: list[int] = []
        at = 0
        rest, token = text[:most], None
        while True:
            if token is None:  # the longest token that starts here; the trie may go further than any token
                size = longest(rest)
                while (token := names.get(rest[:size])) is None:
                    size -= 1
            stop = at + sizes[token]
            fits = stop not in dead
            if fits and out:
                key = out[-1] << 32 | token
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) > REMEMBERED_PIECES:
                        pairs.clear()
                    fits = pairs[key] = self.compatible(out[-1], token)
            if fits:
                out.append(token)
                at = stop
                if at == n:
                    return out
                rest, token = text[at : at + most], None
                continue
            token = self.shorter[token]
            while token < 0:  # nothing fits here: take the last choice back
                dead.add(at)
                last = out.pop()
                at -= sizes[last]
                token = self.shorter[last]

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a text; special tokens are ordinary text."""
        if not text:
            return np.empty(0, "<u4")
        chunks = self.clean_space.split(text)
        known = self.chunks
        if len(known) > REMEMBERED:
            known.clear()
        parts = []
        lead = ""
        for chunk in chunks:
            chunk = lead + chunk
            ids = known.get(chunk)
            if ids is None:
                ids = self._chunk(chunk)
                if len(chunk) < 200:
                    known[chunk] = ids
            parts.append(ids)
            lead = " "
        return np.frombuffer(b"".join(parts), "<u4")

    def _chunk(self, chunk: str) -> bytes:
        parts: list[bytes] = []
        known = self.pieces
        if len(known) > REMEMBERED_PIECES:
            known.clear()
        for piece in self.pattern.findall(chunk):
            found = known.get(piece)
            if found is None:
                ids = self.encode_piece(piece.encode())
                found = struct.pack(f"<{len(ids)}I", *ids)
                if len(piece) < 200:
                    known[piece] = found
            parts.append(found)
        return b"".join(parts)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(4)
def encoder(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with a column of token ids (array<long>); a null text gives an empty list."""
    kept = [c for c in docs.columns if c != ids]
    schema = docs.select(*kept).schema.add(ids, ArrayType(LongType()))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(path, pattern)
        column = [bpe.encode(t or "") for t in batch.column(text).to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in column])]).astype("int32")
        flat = np.concatenate(column) if column else np.empty(0, "<u4")
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype("int64")))
        return pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, ids])

    return map_batches(docs.select(*kept), schema, work)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the bytes that the ids stand for; a null list gives no bytes."""
    kept = [c for c in docs.columns if c != out]
    schema = docs.select(*kept).schema.add(out, "binary")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens = encoder(path, pattern).tokens
        made = [b"".join([tokens[i] for i in x or ()]) for x in batch.column(ids).to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], [*batch.schema.names, out])

    return map_batches(docs.select(*kept), schema, work)


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what encoding gives, and what decoding these ids gives."""
    schema = docs.select("doc_id").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        bpe = encoder(path, pattern)
        rows = []
        for t in batch.column(1).to_pylist():
            ids = bpe.encode(t or "")
            rows.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()))
        n, a, b = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return map_batches(docs.select("doc_id", F.col(text)), schema, work)
