"""Language-model scoring by context-tree weighting.

Each byte is eight binary decisions; a decision's node is (context of the d preceding bytes, bits of the byte so
far). Every node keeps Krichevsky-Trofimov counts, and the block probabilities of the nodes give the weight between a
node's own estimate and its children's, bottom-up over depths DEPTH to 0. Scoring mixes the estimates along the path
of contexts with these weights, a bit at a time; their logarithms add up to a byte's code length. A node without
counts lets its parent's estimate stand, so probabilities of the two bit values still add up to one.

The tree is never whole in one place, and no node of it is dropped:

1. Blocks (some BLOCK_BYTES of texts of a map task) count their (DEPTH+1)-grams, the nearest context byte first, and
   keep their texts. A gram's bucket is that of its three nearest context bytes, so a bucket holds whole subtrees.
2. Buckets merge the blocks' counts as they stream by and weigh depths DEPTH to 3.
3. Depth 2 is added up by its two context bytes and returned to the buckets that hold children of it; depth 1 by its
   one byte. Depths 1 and 0 are at most 65,280 + 255 nodes whatever the corpus: these alone go to the driver and back.
4. Buckets answer each block with its grams' log probabilities; the block adds them up text by text.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import arrow_rows, bucket_count, cut, expand, give_back, groups, mix64, pack, sent, shared_dir, shrink, spans_of, strings, text_bytes, unpack

DEPTH = 5
CHUNK = 1 << 19
#: Text bytes and rows of a block.
BLOCK_BYTES, BLOCK_ROWS = 8 << 20, 60_000
#: Text bytes whose square root counts buckets, and text bytes that one reader of a bucket answers for.
BUCKET_UNIT, ANSWERS = 1 << 20, 1 << 30
#: Entries that are held before they are merged.
MERGE = 500_000
#: Grams whose nodes are weighed at a time.
SLICE = 60_000
#: Texts that a task holds at a time.
ROWS = 1000
#: Bytes of a row group of binaries: writers and readers hold one whole.
ROW_GROUP = 8 << 20
#: Postings that travel as one binary.
PIECE = 150_000
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KEY, CTX = np.uint64(8), np.uint64(255)
NO_ID = -(2**63)


def grams(data: np.ndarray, off: np.ndarray, lo: int, hi: int, depth: int):
    """(depth+1)-gram of every position of the laid-out texts, and each text's first position and length with its end byte.

    Texts are lower-cased, preceded by `depth` zero bytes as context and ended by one zero byte. A gram is the nearest byte before, the next nearest and so on, then the byte itself: in the order of grams subtrees are runs.
    """
    size = off[lo + 1 : hi + 1] - off[lo:hi]
    first = depth + np.concatenate(([0], np.cumsum(size + depth)[:-1])) if hi > lo else np.zeros(0, np.int64)
    laid = np.zeros(int(size.sum()) + depth * (hi - lo) + depth + 1, np.uint8)
    for at, a, n in zip(first.tolist(), off[lo:hi].tolist(), size.tolist(), strict=True):
        laid[at : at + n] = LOWER[data[a : a + n]]
    wide = laid.astype(np.uint64)
    m = len(laid) - depth
    key = np.zeros(m, np.uint64)
    for j in (*range(depth - 1, -1, -1), depth):
        key = (key << KEY) | wide[j : m + j]
    return key, first - depth, size + 1  # key[i] ends at laid[i + depth]


def in_texts(n: int, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether each of n positions is one of a text's."""
    use = np.zeros(n + 1, np.int8)
    np.add.at(use, first, 1)
    np.add.at(use, first + size, -1)
    return np.cumsum(use[:-1]).astype(bool)


def bucket_of(key: np.ndarray, depth: int, n_buckets: int) -> np.ndarray:
    return (mix64(key >> np.uint64(8 * (depth - 2))) % np.uint64(n_buckets)).astype(np.int64)


def merged(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in their order with the sums of their counts."""
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    at = groups(k)
    return k[at], np.add.reduceat(n, at) if len(at) else n


def count_grams(depth: int, n_buckets: int):
    """Blocks: their rows and texts in pieces (buckets -1, -2, ...: large binaries crowd a JVM's heap), and for each bucket their distinct grams with the counts of training texts."""

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 20
        ids, hashes, sizes, texts, keys, counts, held = [], [], [], [], [], [], 0

        def send():
            k, n = merged(keys, counts)
            to = bucket_of(k, depth, n_buckets)
            order = np.argsort(to, kind="stable")
            k, n, to = k[order], n[order], to[order]
            at = groups(to)
            rows = [(-1 - i, block, pack(*(shrink(x) for x in piece))) for i, piece in enumerate(zip(ids, hashes, sizes, texts, strict=True))]
            rows += [(int(to[a]), block, pack(shrink(k[a:b], True), shrink(n[a:b]))) for a, b in zip(at, [*at[1:], len(to)], strict=True)]
            for x in (ids, hashes, sizes, texts, keys, counts):
                x.clear()
            return sent(["bucket", "block", "payload"], [pa.int32(), pa.int64(), pa.binary()], rows)

        for batch in batches:
            data, off = strings(batch.column("text"))
            doc, h, train = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "h", "train"))
            for lo, hi in spans_of(off, CHUNK):
                key, first, size = grams(data, off, lo, hi, depth)
                learn = np.zeros(len(key) + 1, np.int8)
                np.add.at(learn, first[train[lo:hi]], 1)
                np.add.at(learn, (first + size)[train[lo:hi]], -1)
                key = (key << np.uint64(1)) | np.cumsum(learn[:-1]).astype(np.uint64)
                found = pc.value_counts(pa.array(key[in_texts(len(key), first, size)]))
                k, n = found.field(0).to_numpy(), found.field(1).to_numpy()
                keys.append(k >> np.uint64(1))
                counts.append(np.where(k & np.uint64(1), n, 0))
                ids.append(doc[lo:hi])
                hashes.append(h[lo:hi])
                sizes.append(off[lo + 1 : hi + 1] - off[lo:hi])
                texts.append(data[off[lo] : off[hi]])
                if sum(map(len, keys)) > max(MERGE, 2 * len(keys[0])):
                    k, n = merged(keys, counts)
                    keys[:], counts[:] = [k], [n]
                held += int(off[hi] - off[lo]) + BLOCK_BYTES // BLOCK_ROWS * (hi - lo)
                if held >= BLOCK_BYTES:
                    yield from send()
                    held, block = 0, block + 1
        if ids:
            yield from send()
        give_back()

    return run


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x >= 0.5: Stirling's series eight steps up, error below 1e-11."""
    y = x + 8
    s = (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    prod = np.ones_like(x)
    for j in range(8):
        prod = prod * (x + j)
    return s - np.log(prod)


def kt_block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov block probability of so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - math.log(math.pi) - log_gamma(zeros + ones + 1.0)


def weigh(key, zeros, ones, below):
    """Nodes merged by key (key, zeros, ones, weight, ln weighted probability), and each given node's place among them. below: its children's ln probability, None at the deepest level."""
    order = np.argsort(key, kind="stable")
    key, zeros, ones = key[order], zeros[order], ones[order]
    at = groups(key)
    place = np.empty(len(key), np.int64)
    place[order] = np.cumsum(np.concatenate(([True], key[1:] != key[:-1]))) - 1 if len(key) else 0
    key, zeros, ones = key[at], np.add.reduceat(zeros, at), np.add.reduceat(ones, at)
    own = kt_block(zeros, ones)
    if below is None:
        return (key, zeros, ones, np.ones(len(key)), own), place
    both = np.logaddexp(own, np.add.reduceat(below[order], at)) - math.log(2)
    return (key, zeros, ones, np.exp(own - both - math.log(2)), both), place


def above(node: np.ndarray, levels: int = 1) -> np.ndarray:
    """The node so many levels up: its farthest context bytes dropped."""
    return ((node >> np.uint64(8 + 8 * levels)) << KEY) | (node & CTX)


def slices_of(k: np.ndarray, depth: int):
    """Runs of about SLICE sorted grams, the same three nearest context bytes never apart."""
    c = k >> np.uint64(8 * (depth - 2))
    at, lo = groups(c), 0
    while lo < len(k):
        i = np.searchsorted(at, lo + SLICE)
        hi = int(at[i]) if i < len(at) else len(k)
        yield lo, hi
        lo = hi


def subtrees(k: np.ndarray, n: np.ndarray, depth: int):
    """Levels `depth` to 3 of the nodes of sorted distinct grams, each with its nodes' places in the level above; and the leaf of each gram's eight decisions."""
    context, byte = k >> KEY, k & CTX
    node, zeros, ones = [], [], []
    for b in range(8):
        bit = ((byte >> np.uint64(7 - b)) & np.uint64(1)).astype(np.float64)
        node.append((context << KEY) | (byte >> np.uint64(8 - b)) | np.uint64(1 << b))
        zeros.append(n * (1 - bit))
        ones.append(n * bit)
    level, leaf = weigh(np.concatenate(node), np.concatenate(zeros), np.concatenate(ones), None)
    levels, ups = [level], []
    for _ in range(depth - 3):
        level, up = weigh(above(level[0]), level[1], level[2], level[4])
        levels.append(level)
        ups.append(up)
    return levels, ups, leaf.reshape(8, -1)


def estimate(zeros, ones):
    return (ones + 0.5) / (zeros + ones + 1)


def log10_of(k: np.ndarray, n: np.ndarray, depth: int, second, top) -> np.ndarray:
    """log10 probability of each gram's byte. k, n: a bucket's sorted grams and training counts; second: (node, estimate, weight) of depth 2; top: the same of depths 0 and 1 as arrays by node, weight -1 where there is none."""
    out = np.zeros(len(k))
    for lo, hi in slices_of(k, depth):
        levels, ups, leaf = subtrees(k[lo:hi], n[lo:hi].astype(np.float64), depth)
        at = np.arange(len(levels[0][0]))
        p, known = np.full(len(at), 0.5), np.zeros(len(at), bool)

        def mix(own, weight, here, p, known):
            return np.where(here, np.where(known, weight * own + (1 - weight) * p, own), p), known | here

        for level, up in zip(levels, [None, *ups], strict=True):
            at = at if up is None else up[at]
            _, zeros, ones, weight, _ = level
            p, known = mix(estimate(zeros, ones)[at], weight[at], (zeros + ones > 0)[at], p, known)
        node = levels[0][0]
        if len(second[0]):
            two = above(node, depth - 2)
            i = np.searchsorted(second[0], two).clip(0, len(second[0]) - 1)
            p, known = mix(second[1][i], second[2][i], second[0][i] == two, p, known)
        for d, (own, weight) in ((1, top[1]), (0, top[0])):
            i = above(node, depth - d).astype(np.int64)
            p, known = mix(own[i], weight[i], weight[i] >= 0, p, known)
        byte = k[lo:hi] & CTX
        for b in range(8):
            bit = ((byte >> np.uint64(7 - b)) & np.uint64(1)).astype(bool)
            out[lo:hi] += np.log10(np.where(bit, p[leaf[b]], 1 - p[leaf[b]]))
    return out


def merge_counts(batches):
    """Merges the grams of each bucket and salt as its rows stream by in order: bucket, payload."""
    last, keys, counts, held = None, [], [], 0

    def rows():
        k, n = merged(keys, counts)
        return pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int32()), pa.array([pack(shrink(k, True), shrink(n))], pa.binary())], ["bucket", "payload"])

    for batch in batches:
        for *at, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "salt", "payload")), strict=True):
            if at != last:
                if keys:
                    yield rows()
                last, keys, counts, held = at, [], [], 0
            k, n = unpack(blob, np.uint8, np.uint8)
            keys.append(expand(k, np.uint64, True))
            counts.append(expand(n, np.int64))
            held += len(keys[-1])
            if held > max(MERGE, 2 * len(keys[0])):
                k, n = merged(keys, counts)
                keys, counts, held = [k], [n], len(k)
    if keys:
        yield rows()
    give_back()


def read_counts(blobs) -> tuple[np.ndarray, np.ndarray]:
    parts = [unpack(x, np.uint8, np.uint8) for x in blobs]
    return merged([expand(k, np.uint64, True) for k, _ in parts], [expand(n, np.int64) for _, n in parts])


def depth_two(depth: int, n_groups: int):
    """Reduces a bucket: sums over its subtrees for the nodes of depth 2 by group of their context (side, bucket, payload)."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        k, n = read_counts(table.column("payload").to_pylist())
        found = []
        for lo, hi in slices_of(k, depth):
            key, zeros, ones, _, both = subtrees(k[lo:hi], n[lo:hi].astype(np.float64), depth)[0][-1]
            found.append((above(key), zeros, ones, both))  # nodes without counts too: another bucket may have some
        key, *sums = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(key, kind="stable")
        at = groups(key[order])
        key, sums = key[order][at], [np.add.reduceat(x[order], at) if len(at) else x for x in sums]
        to = mix64(key >> KEY) % np.uint64(n_groups)
        sides = np.unique(to)
        return pa.table({"side": pa.array(sides.astype(np.int32)), "bucket": pa.array([bucket] * len(sides), pa.int32()), "payload": pa.array([pack(key[to == s], *(x[to == s] for x in sums)) for s in sides], pa.binary())})

    return run


def weigh_two(table: pa.Table) -> pa.Table:
    """Reduces a group of depth-2 nodes: returns the estimates and weights of those with counts to each bucket that sent them, and their sums for depth 1 by its context byte c (bucket -1 - c)."""
    parts = [unpack(x, np.uint64, np.float64, np.float64, np.float64) for x in table.column("payload").to_pylist()]
    (key, zeros, ones, weight, both), place = weigh(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    to, blobs, lo, seen = [], [], 0, zeros + ones > 0
    for bucket, (k, *_) in zip(table.column("bucket").to_pylist(), parts, strict=True):
        i = place[lo : lo + len(k)]
        i = i[seen[i]]
        lo += len(k)
        to.append(bucket)
        blobs.append(pack(key[i], estimate(zeros[i], ones[i]), weight[i]))
    up = above(key)
    for c in np.unique(up[seen] >> KEY):
        i = seen & (up >> KEY == c)
        to.append(-1 - int(c))
        blobs.append(pack(up[i], zeros[i], ones[i], both[i]))
    return pa.table({"bucket": pa.array(to, pa.int32()), "payload": pa.array(blobs, pa.binary())})


def add_one(table: pa.Table) -> pa.Table:
    """Reduces the sums of one context byte: its nodes of depth 1, 255 at most."""
    parts = [unpack(x, np.uint64, np.float64, np.float64, np.float64) for x in table.column("payload").to_pylist()]
    (key, zeros, ones, weight, both), _ = weigh(*(np.concatenate(x) for x in zip(*parts, strict=True)))
    return pa.table({"bucket": table.column("bucket").slice(0, 1), "payload": pa.array([pack(key, zeros, ones, weight, both)], pa.binary())})


def top_levels(rows) -> list:
    """Estimates and weights of depths 0 and 1 by node, from the rows of add_one."""
    top = [(np.full(1 << bits, 0.5), np.full(1 << bits, -1.0)) for bits in (8, 16)]
    parts = [unpack(bytes(r.payload), np.uint64, np.float64, np.float64, np.float64, np.float64) for r in rows]
    if parts:
        key, zeros, ones, weight, both = (np.concatenate(x) for x in zip(*parts, strict=True))
        top[1][0][key.astype(np.int64)], top[1][1][key.astype(np.int64)] = estimate(zeros, ones), weight
        (key, zeros, ones, weight, _), _ = weigh(above(key), zeros, ones, both)
        top[0][0][key.astype(np.int64)], top[0][1][key.astype(np.int64)] = estimate(zeros, ones), weight
    return top


def answer(depth: int, shared):
    """Rows in order of bucket, salt and kind: the bucket's grams (0), its nodes of depth 2 (1), then each block's grams (2), which get their log probabilities."""

    def run(batches):
        last, grams_of, second, k, value = None, [], [], None, None
        for batch in batches:
            out = []
            for *at, kind, block, blob in zip(*(batch.column(c).to_pylist() for c in ("bucket", "salt", "kind", "block", "payload")), strict=True):
                if at != last:
                    last, grams_of, second, k = at, [], [], None
                if kind == 0:
                    grams_of.append(blob)
                elif kind == 1:
                    second.append(unpack(blob, np.uint64, np.float64, np.float64))
                else:
                    if k is None:
                        k, n = read_counts(grams_of)
                        two = [np.concatenate(x) for x in zip(*second, strict=True)] if second else [np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)]
                        order = np.argsort(two[0])
                        value = log10_of(k, n, depth, [x[order] for x in two], shared.value).astype(np.float32)
                        grams_of, second = [], []
                    asked = expand(unpack(blob, np.uint8, np.uint8)[0], np.uint64, True)
                    out.append((at[0], block, pack(shrink(value[np.searchsorted(k, asked)]))))
            yield from sent(["bucket", "block", "payload"], [pa.int32(), pa.int64(), pa.binary()], out)
        k = value = None
        give_back()

    return run


def score_block(depth: int, n_buckets: int):
    """Reduces a block: its texts with the answers of the buckets give each row's sum of log10 probabilities."""

    def run(table: pa.Table) -> pa.Table:
        rows = dict(zip(table.column("bucket").to_pylist(), table.column("payload").to_pylist(), strict=True))
        value = np.concatenate([expand(unpack(rows[b], np.uint8)[0], np.float32) for b in sorted(rows) if b >= 0])
        parts, told = [], []
        for b in sorted((b for b in rows if b < 0), reverse=True):
            *row, data = (expand(z, t) for z, t in zip(unpack(rows.pop(b), *[np.uint8] * 4), (np.int64, np.int64, np.int64, np.uint8), strict=True))
            key, first, n = grams(data, np.concatenate(([0], np.cumsum(row[2]))), 0, len(row[2]), depth)
            key[~in_texts(len(key), first, n)] = key[first[0]]
            coded = pa.array(key).dictionary_encode()
            parts.append((coded.dictionary.to_numpy(), coded.indices.to_numpy(), first, n))
            told.append(row)
        ids, hashes, size = (np.concatenate(x) for x in zip(*told, strict=True))
        k = np.unique(np.concatenate([x[0] for x in parts]))
        by_key = np.empty(len(k), np.float64)
        by_key[np.argsort(bucket_of(k, depth, n_buckets), kind="stable")] = value
        # summed text by text, so that equal texts have equal scores wherever they stand
        logs = [np.add.reduceat(np.append(by_key[np.searchsorted(k, d)][i], 0.0), np.stack([first, first + n], 1).ravel())[::2] for d, i, first, n in parts]
        return pa.table({"doc": pa.array(ids), "h": pa.array(hashes), "n_bytes": pa.array(size), "score": pa.array(np.concatenate(logs))})

    return run


def gram_scores(slim: DataFrame, depth: int, size: int) -> DataFrame:
    """doc, h, n_bytes, score of every row of slim (doc, h, train, text)."""
    spark = slim.sparkSession
    n_buckets = max(1, math.isqrt(size // BUCKET_UNIT))
    salts = max(1, size // (n_buckets * ANSWERS))
    table = f"{shared_dir(spark)}/grams"
    slim.mapInArrow(count_grams(depth, n_buckets), "bucket int, block long, payload binary").write.option("parquet.block.size", ROW_GROUP).parquet(table)
    blobs = spark.read.parquet(table)
    asked = blobs.where("bucket >= 0").withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int"))
    by_bucket = ["bucket", "salt"]
    counts = cut(asked.select("bucket", "salt", "payload").repartition(*by_bucket).sortWithinPartitions(*by_bucket).mapInArrow(merge_counts, "bucket int, payload binary"))
    sums = counts.groupBy("bucket").applyInArrow(depth_two(depth, max(1, n_buckets // 8)), "side int, bucket int, payload binary")
    second = cut(sums.groupBy("side").applyInArrow(weigh_two, "bucket int, payload binary"))
    one = second.where("bucket < 0").groupBy("bucket").applyInArrow(add_one, "bucket int, payload binary")
    top = spark.sparkContext.broadcast(top_levels(one.toLocalIterator()))  # 256 rows of 255 nodes at most
    to_all = lambda df, kind: df.select("bucket", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(kind).alias("kind"), F.lit(0).cast("long").alias("block"), "payload")
    told = to_all(counts, 0).unionByName(to_all(second.where("bucket >= 0"), 1)).unionByName(asked.select("bucket", "salt", F.lit(2).alias("kind"), "block", "payload"))
    answers = told.repartition(*by_bucket).sortWithinPartitions(*by_bucket, "kind").mapInArrow(answer(depth, top), "bucket int, block long, payload binary")
    return blobs.where("bucket < 0").unionByName(answers).groupBy("block").applyInArrow(score_block(depth, n_buckets), "doc long, h long, n_bytes long, score double")


def count_tokens(n_buckets: int):
    """Blocks of token counts. To each bucket of words: the block's words in it with their training counts (bucket, block). To the block itself: its rows (bucket -1), and the postings (row, count) of its words in the order of their buckets, in pieces (-2, -3, ...)."""

    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 20

        def send(codes, counts, sizes, ids, hashes, train):
            code, n, row = np.concatenate(codes), np.concatenate(counts), np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
            words = [b""] * len(known)
            for w, c in known.items():
                words[c] = w
            to = np.array([zlib.crc32(w) % n_buckets for w in words], np.int32)
            place = np.empty(len(words), np.int32)  # a word's place when words are in the order of their buckets
            by_bucket = np.argsort(to, kind="stable")
            place[by_bucket] = np.arange(len(words), dtype=np.int32)
            order = np.argsort(place[code], kind="stable")
            code, n, row = place[code[order]], n[order], row[order]
            at = groups(code)
            total = np.add.reduceat(np.where(train[row], n, 0).astype(np.int64), at)
            size = np.diff(np.append(at, len(code)))
            row = row.astype(np.uint16 if len(ids) <= 65536 else np.uint32)
            rows = [(-1, block, pack(np.array(ids, np.int64), np.array(hashes, np.int64)))]
            for j, (lo, hi) in enumerate(spans_of(np.append(at, len(code)).astype(np.int64), PIECE)):
                a, b = int(at[lo]), int(at[lo] + size[lo:hi].sum())
                rows.append((-2 - j, block, pack(shrink(size[lo:hi].astype(np.uint32)), shrink(row[a:b]), shrink(n[a:b].astype(np.uint32)))))
            order = to[by_bucket]
            cuts = groups(order)
            for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
                rows.append((int(order[a]), block, pack(shrink(np.frombuffer(b"\n".join(words[i] for i in by_bucket[a:b]), np.uint8)), shrink(total[a:b]))))
            return sent(["bucket", "block", "payload"], [pa.int32(), pa.int64(), pa.binary()], rows)

        known: dict[bytes, int] = {b"": 0}  # the empty word stands for the end
        codes, counts, sizes, ids, hashes, train, held = [], [], [], [], [], [], 0
        for batch in batches:
            data, off = strings(batch.column("text"))
            raw = data.tobytes()
            for i, (doc, h, learn) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc", "h", "train")), strict=True)):
                words = raw[off[i] : off[i + 1]].lower().split()
                words.append(b"")
                code, n = np.unique(np.array([known.setdefault(w, len(known)) for w in words], np.int32), return_counts=True)
                codes.append(code)
                counts.append(n.astype(np.int32))
                sizes.append(len(code))
                ids.append(doc)
                hashes.append(h)
                train.append(learn)
                held += len(code)
                if held > 800_000:
                    yield from send(codes, counts, sizes, ids, hashes, np.array(train))
                    known = {b"": 0}
                    codes, counts, sizes, ids, hashes, train, held, block = [], [], [], [], [], [], 0, block + 1
        if held:
            yield from send(codes, counts, sizes, ids, hashes, np.array(train))
        known, codes, counts, sizes, ids, hashes, train = {}, [], [], [], [], [], []
        give_back()

    return run


def total_tokens(table: pa.Table) -> pa.Table:
    """Reduces a bucket of words: returns each block the corpus counts of the words it sent, in its order; and (block -1) the bucket's tokens and distinct words of training."""
    bucket = table.column("bucket")[0].as_py()
    totals: dict[bytes, int] = {}
    parts = []
    for blob in table.column("payload"):
        words, n = unpack(blob.as_py(), np.uint8, np.uint8)
        words, n = expand(words, np.uint8).tobytes().split(b"\n"), expand(n, np.int64)
        parts.append(words)
        for w, c in zip(words, n.tolist(), strict=True):
            totals[w] = totals.get(w, 0) + c
    c = np.fromiter(totals.values(), np.int64, len(totals))
    blobs = [pack(shrink(np.fromiter((totals[w] for w in words), np.int64, len(words)))) for words in parts]
    blobs.append(pack(shrink(np.array([c.sum(), (c > 0).sum()], np.int64))))
    return pa.table({"bucket": pa.array([bucket] * len(blobs), pa.int32()), "block": pa.array([*table.column("block").to_pylist(), -1], pa.int64()), "payload": pa.array(blobs, pa.binary())})


def sum_block(table: pa.Table) -> pa.Table:
    """Reduces a block: its postings with the corpus counts of its words give each row's sum of logarithms, known tokens and tokens."""
    rows = dict(zip(table.column("bucket").to_pylist(), table.column("payload").to_pylist(), strict=True))
    ids, hashes = unpack(rows.pop(-1), np.int64, np.int64)
    c = np.concatenate([expand(unpack(rows[b], np.uint8)[0], np.int64) for b in sorted(rows) if b >= 0])
    logs, known, tokens, lo = np.zeros(len(ids)), np.zeros(len(ids)), np.zeros(len(ids)), 0
    for b in sorted((b for b in rows if b < 0), reverse=True):
        size, row, n = unpack(rows[b], np.uint8, np.uint8, np.uint8)
        size, row, n = expand(size, np.uint32), expand(row, np.uint16 if len(ids) <= 65536 else np.uint32).astype(np.int64), expand(n, np.uint32).astype(np.float64)
        of, lo = c[lo : lo + len(size)], lo + len(size)
        logs += np.bincount(row, n * np.repeat(np.log10(of + 0.5), size), len(ids))
        known += np.bincount(row, n * np.repeat(of > 0, size), len(ids))
        tokens += np.bincount(row, n, len(ids))
    return pa.table({"doc": pa.array(ids), "h": pa.array(hashes), "logs": pa.array(logs), "known": pa.array(known.astype(np.int64)), "tokens": pa.array(tokens.astype(np.int64))})


def score(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Scores every row of docs (doc_id, text; further columns are ignored): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from the rows whose crc32 of the id as text doesn't leave 1 modulo 5; a null doc_id trains. Null texts count as empty. Rows with the same doc_id and text get equal results; each stays a row. No rows: no rows.
    base_score is the smoothed unigram score of the words; score is the model's log10 probability of the lower-cased text with its end; bits_per_byte is its code length over the bytes with the end. Without training rows every bit has probability 1/2.
    """
    if not 3 <= depth <= 6:
        raise ValueError("depth must be from 3 to 6")
    spark = docs.sparkSession
    held_out = lambda c: F.coalesce(F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(5)) == 1, F.lit(False))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    slim = slim.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("h"), (~held_out("doc_id")).alias("train"), "text")
    size = text_bytes(slim, "text")
    table = f"{shared_dir(spark)}/tokens"
    with arrow_rows(spark, ROWS):
        slim.mapInArrow(count_tokens(bucket_count(size)), "bucket int, block long, payload binary").write.option("parquet.block.size", ROW_GROUP).parquet(table)
    blobs = spark.read.parquet(table)
    totals = cut(blobs.where("bucket >= 0").groupBy("bucket").applyInArrow(total_tokens, "bucket int, block long, payload binary"))
    n, v = 0, 0
    for r in totals.where("block < 0").toLocalIterator():  # one row a bucket
        stat = expand(unpack(bytes(r.payload), np.uint8)[0], np.int64)
        n, v = n + int(stat[0]), v + int(stat[1])
    # equal rows have equal sums, so one of them will do
    base = blobs.where("bucket < 0").unionByName(totals.where("block >= 0")).groupBy("block").applyInArrow(sum_block, "doc long, h long, logs double, known long, tokens long").dropDuplicates(["doc", "h"])
    # cut, so that scoring doesn't share an executor's memory with the exchange of postings
    with arrow_rows(spark, ROWS):
        scored = cut(gram_scores(slim, depth, size))
    rows = scored.join(base, ["doc", "h"]).withColumn("doc_id", F.nullif("doc", F.lit(NO_ID)))
    return rows.select(
        "doc_id", held_out("doc_id").alias("held_out"), F.col("tokens").alias("n_tokens"), F.col("known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("tokens") * F.lit(math.log10(n + 0.5 * (v + 1)))).alias("base_score"), "score", (F.col("score") * F.lit(-math.log2(10)) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
