"""SimHash near-duplicates with Golay-code fuzzy hashing.

A 64-bit fingerprint is cut in segments of 23, 23 and 18 bits (the last padded to 23). The binary Golay code of length
23 is perfect: every word lies within 3 bits of exactly one codeword. near(x) are the codewords nearest to x and to
the words one bit from it: one key if x is within 2 bits of its codeword, else six.

Of three segments with at most 4 wrong bits together, some two have at most 2 together (pigeonhole). For such two
(i, j) the wrong bits are (0, <=2), (<=2, 0) or (1, 1), and fingerprints meet in a key made of
  segment i as it is and near(j)        two words within 2 bits share a word one bit from both
  near(i) and segment j as it is
  code(i) and near(j), on one side; near(i) and code(j) on the other: words one bit apart have each other's codeword among their near ones.
Every key names its pair and form, and carries 24 to 41 bits of content. Members of a key are compared exactly.

Equal fingerprints are merged before any of this. Within a key no pair is emitted: a task links members to a
spanning forest of their key. Keys with more than HOT members are dealt to pairs of chunks, so that each of several
tasks compares two chunks, and every pair of members is still compared in one of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import arrow_rows, cut, slices, small, strings
from .components import components

DISTANCE = 4
SHINGLE = 4
SEED = 42
HOT = 4096
#: Fixed value: generator polynomial of the binary Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101
CUTS = ((0, 23), (23, 23), (46, 18))


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    r = words.astype(np.int64)
    for bit in range(22, 10, -1):
        r = np.where(r >> bit & 1, r ^ (GENERATOR << (bit - 11)), r)
    return r


def decoding_tables() -> tuple[np.ndarray, np.ndarray]:
    """Error pattern of each of the 2,048 syndromes, and which of the 23 unit errors has which syndrome."""
    unit = syndromes(1 << np.arange(23))
    error = np.zeros(2048, np.int64)
    for a in range(23):
        error[unit[a]] = 1 << a
        for b in range(a):
            error[unit[a] ^ unit[b]] = 1 << a | 1 << b
            for c in range(b):
                error[unit[a] ^ unit[b] ^ unit[c]] = 1 << a | 1 << b | 1 << c
    return error, unit


def near(words: np.ndarray, error: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """12-bit codeword index of each word (n), and of the word and its 23 neighbours (n, 24). A codeword's index is its information part: the upper 12 bits."""
    s = syndromes(words)
    code = (words ^ error[s]) >> 11
    flipped = words[:, None] ^ (1 << np.arange(23))
    others = (flipped ^ error[s[:, None] ^ unit]) >> 11
    return code, np.concatenate([code[:, None], others], 1)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, side, row) of fingerprints; side 0 meets side 0, sides 1 and 2 meet each other. Keys of a row aren't repeated."""
    error, unit = decoding_tables()
    seg = [((prints >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in CUTS]
    code, around = [], []
    for x in seg:
        c, every = near(x, error, unit)
        every = np.sort(every, 1)
        first = np.concatenate([np.ones((len(x), 1), bool), every[:, 1:] != every[:, :-1]], 1)
        row, col = np.nonzero(first)
        code.append(c)
        around.append((row, every[row, col]))
    out = []
    for p, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        for form, exact, (row, k), side in ((0, seg[i], around[j], 0), (1, seg[j], around[i], 0), (2, code[i], around[j], 1), (3, code[j], around[i], 2)):
            if form == 3:  # near(i) and code(j), laid out like form 2
                content, form = (k << 12) | exact[row], 2
            else:
                content = (exact[row] << 12) | k
            out.append(((np.int64(p * 4 + form) << 40) | content, np.full(len(row), side, np.int8), row))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, print (long, the 64 bits) of docs (doc_id, text); null, empty and blank texts have 0. Rows keep their number."""

    def run(batches):
        import xxhash

        digest = xxhash.xxh64_intdigest
        for batch in slices(batches):
            data, off = strings(batch.column("text"))
            raw = data.tobytes()
            prints = np.zeros(len(off) - 1, np.uint64)
            held, owner, n_of = [], [], []

            def settle():
                if not held:
                    return
                h = np.array(held, np.uint64)
                at = np.concatenate(([0], np.cumsum(n_of)[:-1]))
                for bit in range(64):
                    ones = np.add.reduceat(((h >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), at)
                    prints[owner] |= (2 * ones > np.array(n_of)).astype(np.uint64) << np.uint64(bit)
                held.clear(), owner.clear(), n_of.clear()

            for i in range(len(off) - 1):
                words = raw[off[i] : off[i + 1]].lower().split()
                if not words:
                    continue
                line = b" ".join(words)
                if len(words) <= SHINGLE:
                    held.append(digest(line, SEED))
                    n_of.append(1)
                else:
                    size = np.fromiter(map(len, words), np.int64, len(words))
                    end = np.cumsum(size + 1) - 1
                    first = end - size
                    held.extend([digest(line[a:b], SEED) for a, b in zip(first[: 1 - SHINGLE].tolist(), end[SHINGLE - 1 :].tolist(), strict=True)])
                    n_of.append(len(words) - SHINGLE + 1)
                owner.append(i)
                if len(held) > 200_000:
                    settle()
            settle()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, print long")


def emit_keys(batches):
    for batch in batches:
        prints = batch.column("print").to_numpy().view(np.uint64)
        for lo in range(0, len(prints), 20_000):
            some = prints[lo : lo + 20_000]
            key, side, row = keys_of(some)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(side), pa.array(some[row].view(np.int64))], ["key", "side", "print"])


def forest(prints: np.ndarray, side: np.ndarray, chunk: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the members of one key that are within the distance."""
    n = len(prints)
    root = np.arange(n)
    edges = []
    for i in range(n - 1):
        rest = slice(i + 1, n)
        ok = np.bitwise_count(prints[rest] ^ prints[i]) <= distance
        for j in np.flatnonzero(ok & (root[rest] != root[i])) + i + 1:
            if root[j] != root[i]:
                root[root == root[j]] = root[i]
                edges.append((int(prints[i].view(np.int64)), int(prints[j].view(np.int64))))
    return edges


def link(distance: int):
    """Reads rows sorted by key and links each key's members; a key's rows may span batches."""

    def run(batches):
        def whole(key, c1, c2, side, prints):
            if not len(key):
                return None
            edges = set()
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])))
            at = np.flatnonzero(new)
            size = np.diff(np.append(at, len(key)))
            for a, m in zip(at[size > 1].tolist(), size[size > 1].tolist(), strict=True):
                p = prints[a : a + m]
                if m == 2:
                    if p[0] != p[1] and bin(int(p[0] ^ p[1])).count("1") <= distance:
                        edges.add((int(p[0].view(np.int64)), int(p[1].view(np.int64))))
                else:
                    edges.update(forest(np.unique(p), side, c1, distance))
            if not edges:
                return None
            x, y = zip(*edges, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

        held = None
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "c1", "c2", "side", "print")]
            cols[4] = cols[4].view(np.uint64)
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
            key, c1, c2 = cols[:3]
            last = np.flatnonzero((key != key[-1]) | (c1 != c1[-1]) | (c2 != c2[-1])) if len(key) else np.zeros(0, np.int64)
            done = int(last[-1]) + 1 if len(last) else 0
            if done and (out := whole(*(c[:done] for c in cols))) is not None:
                yield out
            held = [c[done:] for c in cols]
        if held is not None and (out := whole(*held)) is not None:
            yield out

    return run


def links(prints: DataFrame, distance: int = DISTANCE, hot: int = HOT) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (column print) within the distance (4 at most): a spanning forest of each key."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError("keys cover distances up to 4")
    keys = prints.select("print").distinct().mapInArrow(emit_keys, "key long, side byte, print long")
    many = small(keys.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > hot))
    chunks = F.ceil(F.col("m") / F.lit(hot)).cast("int")
    mine = F.pmod(F.xxhash64("print"), chunks).cast("int")
    dealt = keys.join(many, "key", "left").withColumn("mine", F.when(F.col("m").isNull(), F.lit(0)).otherwise(mine))
    pairs = F.when(F.col("m").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), chunks - 1))
    dealt = dealt.select("key", "side", "print", "mine", F.explode(pairs).alias("other"))
    dealt = dealt.select("key", F.least("mine", "other").alias("c1"), F.greatest("mine", "other").alias("c2"), "side", "print")
    spread = dealt.repartition("key", "c1", "c2").sortWithinPartitions("key", "c1", "c2", "print")
    return spread.mapInArrow(link(distance), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the least doc_id that links of at most `distance` bits lead to.

    One row for each row of docs (doc_id, text). Texts without words have fingerprint 0 and are linked like any other. A null doc_id is never a component's id unless no other is there.
    """
    with arrow_rows(docs.sparkSession, 1000):
        rows = cut(fingerprints(docs))
    classes = rows.groupBy("print").agg(F.min("doc_id").alias("least"))
    roots = components(links(classes, distance))
    rooted = classes.join(roots, F.col("print") == F.col("node"), "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(ids, "root").select("print", "component_id")
    return rows.join(named, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
