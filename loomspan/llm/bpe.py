"""Byte-level BPE with a segment tree over byte positions.

A pre-token's leaf i holds the rank of the pair that starts at byte i with its live right neighbour, and an inner node
the leftmost minimum of its children. A merge takes the root's pair, joins it and updates the leaves of the merged
pair, the dropped byte and the left neighbour: O(log n) each, so a pre-token of n bytes takes O(n log n) however long.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens whose ids a task remembers; beyond, it forgets all and starts anew.
REMEMBERED = 500_000
NONE = 1 << 62


def load(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: merge the leftmost pair of lowest rank until no pair has one."""
    n = len(piece)
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    get = ranks.get
    size = 1
    while size < n - 1:
        size *= 2
    shift = size.bit_length()
    # value: rank above position, so that the minimum is the leftmost of the lowest rank
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        r = get(piece[i : i + 2])
        if r is not None:
            tree[size + i] = (r << shift) | i
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    end = list(range(1, n + 1))  # end[i]: where the live token that starts at byte i ends
    before = list(range(-1, n))  # before[i]: start of the live token to the left of i
    low = (1 << shift) - 1
    while (top := tree[1]) < NONE:
        i = top & low
        j = end[i]
        e = end[j]
        end[i] = e
        r = None
        if e < n:
            before[e] = i
            r = get(piece[i : end[e]])
        tree[size + i] = NONE if r is None else (r << shift) | i
        if j < size:
            tree[size + j] = NONE
        b = before[i]
        if b >= 0:
            r = get(piece[b:e])
            tree[size + b] = NONE if r is None else (r << shift) | b
        else:
            b = i
        # the paths from the three leaves to the root, each node once
        p, q, u = size + b >> 1, size + i >> 1, size + (j if j < size else i) >> 1
        while p:
            x, y = tree[2 * p], tree[2 * p + 1]
            tree[p] = x if x < y else y
            if q != p:
                x, y = tree[2 * q], tree[2 * q + 1]
                tree[q] = x if x < y else y
            if u != q:
                x, y = tree[2 * u], tree[2 * u + 1]
                tree[u] = x if x < y else y
            p, q, u = p >> 1, q >> 1, u >> 1
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Codec:
    """Encoder and decoder of one vocabulary. Every single byte must be a token."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.pieces = ranks, regex.compile(pattern)
        self.token = {i: t for t, i in ranks.items()}
        self.seen: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        seen = self.seen
        for piece in self.pieces.findall(text):
            ids = seen.get(piece)
            if ids is None:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                ids = merge(piece.encode(), self.ranks)
                if len(piece) <= 64:
                    seen[piece] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids (array of int) of docs (doc_id, text). A null or empty text has no ids. Rows keep their number; columns besides are ignored.

    path names a rank file that every executor can open.
    """

    def run(batches):
        codec = Codec(load(path), pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([codec.encode(t or "") for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, data (binary) of rows of ids; a null array decodes to no bytes."""

    def run(batches):
        token = {i: t for t, i in load(path).items()}
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([b"".join(map(token.__getitem__, x or ())) for x in batch.column("ids").to_pylist()], pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The op8 query: encodes, then decodes the ids, in one task for each partition: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches):
        codec = Codec(load(path), pattern)
        name = {i: str(i) for i in codec.token}
        for batch in batches:
            n, a, b = [], [], []
            for t in batch.column("text").to_pylist():
                ids = codec.encode(t or "")
                n.append(len(ids))
                a.append(hashlib.sha256(" ".join(map(name.__getitem__, ids)).encode()).hexdigest())
                b.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
