"""Byte-level BPE: encoding by backtracking over longest matches, and decoding.

A piece's bytes are read as Latin-1 characters by an Aho-Corasick automaton of all tokens, which gives the longest token
at each place. The encoder takes longest matches from left to right; where two neighbours could not stand side by side
after merging by rank, it falls back to the next shorter token, and from there to the token before. Whether two tokens
may be neighbours is kept per pair, and an end from which no way led on is never tried again, so the work is linear in
the piece. The result is that of merging by rank.
"""

from __future__ import annotations

import base64
import re
import struct
from functools import lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import id_text, pieces

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Entries after which a worker forgets the pieces or pairs that it has seen.
MEMO = 500_000
_RUN = re.compile(r"\s | \s")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Encoder:
    """Tables made from a vocabulary's ranks, whose size is fixed, not the corpus's."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.split: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            parts = self._parts(token, rank)
            self.split[rank] = parts
            if parts[0] != rank:
                self.joined.setdefault(parts, rank)
        self.lengths = [0] * (max(ranks.values()) + 1)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.shorter: dict[int, int] = {}
        for token, rank in ranks.items():
            for n in range(len(token) - 1, 0, -1):
                if (r := ranks.get(token[:n])) is not None:
                    self.shorter[rank] = r
                    break
        self.pairs: dict[int, bool] = {}
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _parts(self, token: bytes, rank: int) -> tuple[int, int]:
        """The two tokens whose merge made this one; for a single byte, or one that no merge makes, itself twice."""
        if len(token) == 1:
            return rank, rank
        ids = [self.ranks[token[i : i + 1]] for i in range(len(token))]
        while len(ids) > 2:
            best = min(((self.joined.get(p, rank), i) for i, p in enumerate(zip(ids, ids[1:], strict=False))))
            if best[0] >= rank:
                return rank, rank
            ids[best[1] : best[1] + 2] = [best[0]]
        return ids[0], ids[1]

    def compatible(self, left: int, right: int) -> bool:
        """True if merging by rank leaves left and right side by side: undoing their merges from the latest, no pair
        across the border would have merged before what was undone."""
        if len(self.pairs) > MEMO:
            self.pairs.clear()
        known = self.pairs[left << 32 | right] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        before = 1 << 62  # merges across the border must come earlier than this to count
        while True:
            made = self.joined.get((left, right))
            if made is not None and made < before:
                return False
            # Undo the later merge. Of equal ranks the left one was made first, so a merge across may tie with the right.
            for side in ("left", "right") if left > right else ("right", "left"):
                if side == "left":
                    before, inner = left, self.split[left][1]
                    if inner != left:
                        left = inner
                        break
                else:
                    before, inner = right + 1, self.split[right][0]
                    if inner != right:
                        right = inner
                        break
            else:
                return True

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        lengths, pairs, shorter, size = self.lengths, self.pairs, self.shorter, len(data)
        longest = [-1] * size
        for end, rank in self.automaton.iter(data.decode("latin-1")):
            longest[end + 1 - lengths[rank]] = rank  # of one start, a later end is a longer token
        if -1 in longest and any(data[i : i + 1] not in self.ranks for i, r in enumerate(longest) if r < 0):
            raise ValueError("a byte has no token")
        out: list[int] = []
        dead: set[int] = set()
        at, token, last = 0, longest[0], -1
        while True:
            end = at + lengths[token]
            if end not in dead:
                fits = True
                if last >= 0:
                    fits = pairs.get(last << 32 | token)
                    if fits is None:
                        fits = self.compatible(last, token)
                if fits:
                    if end == size:
                        out.append(token)
                        return out
                    out.append(token)
                    at, last, token = end, token, longest[end]
                    continue
            token = shorter.get(token, -1)
            if token < 0:
                # The token before fitted its place but leads nowhere: its end is dead now, so its shorter ones come next.
                dead.add(at)
                token = out.pop()
                at -= lengths[token]
                last = out[-1] if out else -1

    def _encoded_pieces(self, text: str) -> bytes:
        memo, out = self.pieces, []
        for piece in self.pattern.findall(text):
            ids = memo.get(piece)
            if ids is None:
                found = self.encode_piece(piece.encode())
                ids = struct.pack(f"<{len(found)}I", *found)
                if len(piece) <= 64:
                    if len(memo) > MEMO:
                        memo.clear()
                    memo[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit integers.

        A space between two other characters that are no white space always starts a piece, so a text is cut there and
        the parts are looked up; a space beside white space can belong to a run, and then the text is taken in one.
        """
        if _RUN.search(text):
            return self._encoded_pieces(text)
        memo, out, lead = self.words, [], ""
        for word in text.split(" "):
            ids = memo.get(word)
            if ids is None or not lead:
                ids = self._encoded_pieces(lead + word)
                if lead and len(word) <= 64:
                    if len(memo) > MEMO:
                        memo.clear()
                    memo[word] = ids
            out.append(ids)
            lead = " "
        return b"".join(out)


@lru_cache(2)
def encoder(path: str, pattern: str) -> Encoder:
    """One per worker process and vocabulary."""
    return Encoder(load_ranks(path), pattern)


def _encoded(path: str, pattern: str):
    def run(batches):
        coder = encoder(path, pattern)
        for whole in batches:
            for batch in pieces(whole):
                ids = [coder.encode(t) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): each whole text's token ids, little-endian unsigned 32 bits each.

    path: a vocabulary of `base64 rank` lines, which every executor has at that place. A narrow map; no special tokens.
    Null and empty texts have no ids; a null id stays null.
    """
    return id_text(docs, id_col, text_col).mapInArrow(_encoded(path, pattern), "doc_id long, ids binary")


@lru_cache(2)
def token_table(path: str) -> dict[int, bytes]:
    """Of a vocabulary: the bytes of each rank. All that decoding needs."""
    return {r: t for t, r in load_ranks(path).items()}


def decoded(tokens: dict[int, bytes], ids: bytes) -> bytes:
    return b"".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _decoded(path: str):
    def run(batches):
        tokens = token_table(path)
        for batch in (p for whole in batches for p in pieces(whole)):
            data = [decoded(tokens, x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(data, pa.binary())], ["doc_id", "ids", "decoded"])

    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encode's rows with the bytes that the ids stand for. An id that the vocabulary lacks fails the task."""
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(path), "doc_id long, ids binary, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    return decoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
