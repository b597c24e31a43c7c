"""Byte-level BPE by a tree reduction over a monoid of token lists, and decoding up the same tree."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quern.llm.common import arrow_map, kept, slices

#: Pieces up to so many bytes are merged directly; longer ones are halved.
LEAF = 16
#: Encoded pieces that a worker remembers before it starts anew; this bounds memory and changes no result.
REMEMBERED = 600_000
#: Tokens that are joined directly when decoding; longer lists are halved.
DECODE_LEAF = 4096
NO_RANK = 1 << 30


class Encoder(dict):
    """Maps a piece of text to its ids as little-endian 32-bit integers.

    The tokens of two neighbours form a monoid under join(): a list of tokens is the encoding of its bytes if and
    only if each pair of neighbours is (merges never reach across a pair that encodes to itself). So a join has to
    encode anew only a window at the seam, and may stop growing it as soon as the pairs at both its edges hold.
    """

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN, leaf: int = LEAF):
        super().__init__()
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.vocab = np.full(max(self.ranks.values()) + 1, b"", dtype=object)
        for token, rank in self.ranks.items():
            self.vocab[rank] = token
        self.split, self.leaf, self.pairs = regex.compile(pattern).findall, leaf, {}

    def merge(self, piece: bytes) -> list[int]:
        """Tokens of a short piece: the leftmost pair of the lowest rank is merged until no pair has a rank."""
        parts, rank = [piece[i : i + 1] for i in range(len(piece))], self.ranks.get
        pairs = [rank(a + b, NO_RANK) for a, b in zip(parts, parts[1:])]
        while pairs and (least := min(pairs)) != NO_RANK:
            at = pairs.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], NO_RANK)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], NO_RANK)
        return [self.ranks[p] for p in parts]

    def holds(self, left: int, right: int) -> bool:
        """Whether these two neighbours stay as they are."""
        if (known := self.pairs.get((left, right))) is None:
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            known = self.pairs[left, right] = self.merge(self.vocab[left] + self.vocab[right]) == [left, right]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        reach = 1
        while True:
            i, j = min(reach, len(left)), min(reach, len(right))
            window = self.merge(b"".join(self.vocab[t] for t in [*left[len(left) - i :], *right[:j]]))
            if (i == len(left) or self.holds(left[-i - 1], window[0])) and (j == len(right) or self.holds(window[-1], right[j])):
                return left[: len(left) - i] + window + right[j:]
            reach *= 2

    def tree(self, piece: bytes) -> list[int]:
        if len(piece) <= self.leaf:
            return self.merge(piece)
        half = len(piece) // 2
        return self.join(self.tree(piece[:half]), self.tree(piece[half:]))

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        whole = self.ranks.get(raw)
        ids = np.array(self.tree(raw) if whole is None else [whole], dtype="<u4").tobytes()
        if len(raw) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.split(text)))

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= DECODE_LEAF:
            return b"".join(self.vocab[ids])
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@kept
def encoder(path: str, pattern: str = public_tokenizers.PATTERN) -> Encoder:
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every text; a null text has no ids. Other columns are ignored; repeated rows stay."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        own = encoder(path)
        for part in slices(batch, 4 << 20):
            texts = part.column(1).to_pylist()
            yield {"doc_id": part.column(0), "ids": [np.frombuffer(own.encode(x or ""), "<i4") for x in texts]}

    return arrow_map(docs.select(id_col, text_col), step, f"doc_id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the number of tokens and the digests of its ids and of the bytes that they decode to.

    A null or empty text has no tokens, and the digests of nothing. Repeated rows give repeated rows, an empty table
    none; texts of any length are encoded whole. Other columns are ignored, whatever their names.
    """

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        own = encoder(path)
        for part in slices(batch):
            counts, ids_sha, text_sha = [], [], []
            for text in part.column(1).to_pylist():
                ids = own.encode(text or "")
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(own.decode(np.frombuffer(ids, "<u4"))).hexdigest())
            yield {"doc_id": part.column(0), "n_tokens": counts, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(id_col, text_col), step, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
