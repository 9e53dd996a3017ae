"""Removal of repeated passages by merging shard Burrows-Wheeler transforms.

A byte goes if a string of LENGTH bytes that covers it also starts earlier (smaller doc_id, or earlier in the same
document). The corpus is sharded by content, then shards of suffixes are merged by interleave refinement:

1. Anchors. Every window of LENGTH bytes elects the least hashed K-gram in it (the leftmost of equal ones). Runs of
   windows with the same elected place form a segment of LENGTH to LENGTH+W-1 bytes. The election depends on the
   window's bytes only, so equal windows lie in segments with equal anchors, whose hash is the segment's shard.
2. A block (one map task's texts) merges its equal segments; all but the first are repeats. What it sends to a shard is
   a segment's anchor, hash, place and number of windows, so a passage that every document holds sends a row a block.
3. A shard merges equal segments again. Anchors that keep several different segments contest: their texts are fetched.
4. Contested texts are cut in shards; a BWT is built for each, and the interleave of the shards is refined two
   characters a round: a round deals the interleave stably by the two characters before each suffix, so after LENGTH/2
   rounds suffixes with LENGTH common characters are next to each other and their intervals are the blocks of the
   order. Each interval's first window in (doc_id, place) order stays; the others are repeats. Nothing is sorted anew.
   An anchor with more than CROWD contested segments (the edge of a passage that a third of all documents hold) is cut
   in its single windows, which are merged on the map side and dealt over tasks by a hash of all their bytes.
5. Covered ranges go back to their documents.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .blocks import arrow_rows, bucket_count, cut, give_back, groups, mix64, pack, sent, slices, small, spans_of, strings, text_bytes, unpack

LENGTH = 100
K = 40
CHUNK = 4 << 20
#: Bytes of one shard's BWT and shards of one merge.
SHARD_BYTES = 128 << 10
CROWD = 20_000
#: Repeats that travel as one binary.
PIECE = 50_000
HELD_WINDOWS = 200_000
#: Bits for a place in a chunk: an Arrow array of texts is below 2 GB.
PLACE_BITS = np.uint64(31)
NO_ID = -(2**63)
BASE = 0x9E3779B97F4A7C15 | 1
TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i up to n."""
    up, down = np.full(n + 1, BASE, np.uint64), np.full(n + 1, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values: two running minima over blocks of w."""
    n = len(x)
    padded = np.full(-(-n // w) * w, 2**64 - 1, np.uint64)
    padded[:n] = x
    rows = padded.reshape(-1, w)
    head = np.minimum.accumulate(rows, 1).ravel()
    tail = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(tail[: n - w + 1], head[w - 1 : n])


def segments(data: np.ndarray, off: np.ndarray, lo: int, hi: int, length: int, k: int, power):
    """Segments of texts lo to hi: (anchor hash, segment hash, row, first window, windows, anchor's place in the segment)."""
    base = int(off[lo])
    b = data[base : int(off[hi])]
    n = len(b)
    none = np.zeros(0, np.int64)
    if n < length:
        return none.view(np.uint64), none.view(np.uint64), none, none, none, none
    up, down = power
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(TABLE[b] * up[:n], out=total[1:])
    gram = mix64((total[k:] - total[: n - k + 1]) * down[: n - k + 1])
    # as many bits for the place in any chunk, so that a window elects the same gram wherever it stands
    ballot = ((gram >> PLACE_BITS) << PLACE_BITS) | np.arange(len(gram), dtype=np.uint64)
    elected = (sliding_least(ballot, length - k + 1) & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    starts = np.full(len(elected) + 1, 0, np.int8)
    size = off[lo + 1 : hi + 1] - off[lo:hi]
    fits = np.flatnonzero(size >= length)
    first = (off[lo:hi] - base)[fits]
    np.add.at(starts, first, 1)
    np.add.at(starts, first + size[fits] - length + 1, -1)
    valid = np.cumsum(starts[:-1]).astype(bool)
    turn = np.ones(len(elected), bool)
    turn[1:] = (elected[1:] != elected[:-1]) | (valid[1:] != valid[:-1])
    turn[first] = True
    at = np.flatnonzero(turn)
    count = np.diff(np.append(at, len(elected)))
    use = valid[at]
    at, count = at[use], count[use]
    ends = at + count + length - 1
    whole = mix64((total[ends] - total[at]) * down[at] + count.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    row = np.searchsorted(off[lo : hi + 1] - base, at, "right") - 1 + lo
    return gram[elected[at]], whole, row, at - (off[row] - base), count, elected[at] - at


def elsewhere(new: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows that start elsewhere than the first of their class; classes are runs that begin where new is true. A row at the first's own place is a repeated row of the table, not a repeat."""
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    return (doc != doc[first]) | (at != at[first])


def block_segments(length: int, k: int, n_buckets: int):
    """A block's segments by shard, and its own repeats (bucket -1): the block's first of each kind is sent, by (doc_id, place)."""

    def run(batches):
        held = []

        def send():
            a, h, doc, at, n, o = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((at, doc, h, a))
            a, h, doc, at, n, o = a[order], h[order], doc[order], at[order], n[order], o[order]
            first = np.ones(len(a), bool)
            first[1:] = (a[1:] != a[:-1]) | (h[1:] != h[:-1])
            rows = []
            again = elsewhere(first, doc, at)
            for lo in range(0, int(again.sum()), PIECE):
                i = np.flatnonzero(again)[lo : lo + PIECE]
                rows.append((-1, pack(doc[i], at[i].astype(np.uint32), n[i].astype(np.uint32))))
            a, h, doc, at, n, o = a[first], h[first], doc[first], at[first], n[first], o[first]
            to = (mix64(a ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(n_buckets)).astype(np.int64)
            order = np.lexsort((at, doc, to))  # in the documents' order, so that their ids compress
            to = to[order]
            cuts = groups(to)
            for lo, hi in zip(cuts, [*cuts[1:], len(to)], strict=True):
                i = order[lo:hi]
                rows.append((int(to[lo]), pack(a[i], h[i], doc[i], at[i].astype(np.uint32), n[i].astype(np.uint8), o[i].astype(np.uint8))))
            return sent(["bucket", "payload"], [pa.int32(), pa.binary()], rows)

        power, size = powers(CHUNK), 0
        for batch in batches:
            data, off = strings(batch.column("text"))
            ids = batch.column("_doc").to_numpy()
            for lo, hi in spans_of(off, CHUNK):
                n = int(off[hi] - off[lo])
                power = power if n < len(power[0]) else powers(n)
                a, h, row, at, c, o = segments(data, off, lo, hi, length, k, power)
                if len(a):
                    held.append((a, h, ids[row], at, c, o))
                    size += len(a)
                if size > 2_500_000:
                    yield from send()
                    held, size = [], 0
        if held:
            yield from send()
        held = []
        give_back()

    return run


def contest(table: pa.Table) -> pa.Table:
    """Reduces a shard: repeats of equal segments (kind 0), and one segment of each kind of anchors with several kinds (kind 1)."""
    bucket = table.column("bucket")[0].as_py()
    if bucket < 0:
        parts = [unpack(x.as_py(), np.int64, np.uint32, np.uint32) for x in table.column("payload")]
        doc, at, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        kind, a, o = np.zeros(len(doc), np.int8), np.zeros(len(doc), np.int64), np.zeros(len(doc), np.uint8)
    else:
        parts = [unpack(x.as_py(), np.uint64, np.uint64, np.int64, np.uint32, np.uint8, np.uint8) for x in table.column("payload")]
        a, h, doc, at, n, o = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((at, doc, h, a))
        a, h, doc, at, n, o = a[order], h[order], doc[order], at[order], n[order], o[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (h[1:] != h[:-1])
        start = groups(a)
        kinds = np.repeat(np.add.reduceat(new.astype(np.int64), start), np.diff(np.append(start, len(a)))) if len(a) else new
        keep = elsewhere(new, doc, at) | new & (kinds > 1)
        kind, a, doc, at, n, o = new[keep].astype(np.int8), a[keep].view(np.int64), doc[keep], at[keep], n[keep], o[keep]
    return pa.table({"doc": pa.array(doc), "kind": pa.array(kind), "anchor": pa.array(a), "at": pa.array(at.astype(np.int64)), "n": pa.array(n.astype(np.int64)), "o": pa.array(o.astype(np.int64))})


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of a circular text's suffixes, by prefix doubling until all differ or `depth` characters have been seen."""
    n = len(text)
    rank, seen = text.astype(np.int64), 1
    if n > 4:  # four characters at once to begin with
        t = text.astype(np.int64)
        rank, seen = (t << 24) | (np.roll(t, -1) << 16) | (np.roll(t, -2) << 8) | np.roll(t, -3), 4
    order = np.argsort(rank, kind="stable")
    while True:
        s = rank[order]
        new = np.concatenate(([0], np.cumsum(s[1:] != s[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if seen >= depth or new[-1] == n - 1:
            return order
        rank = rank * n + np.roll(rank, -(seen % n))
        seen *= 2
        order = np.argsort(rank, kind="stable")


def merged_intervals(shards: list[np.ndarray], length: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Merges the shards' BWTs: each shard's suffix order, the interleave (shard of each merged rank), and the interval number of each merged rank: ranks whose suffixes share `length` characters.

    A shard is a text over the characters 1 to 255 whose parts each end in 0; suffixes that reach a 0 within `length` characters are in intervals of no use to the caller.
    """
    orders = [suffix_order(t, 2 * length) for t in shards]
    pairs = np.concatenate([(t[o - 2].astype(np.uint16) << 8) | t[o - 1] for t, o in zip(shards, orders, strict=True)])
    z = np.concatenate([np.full(len(t), i, np.uint8) for i, t in enumerate(shards)])
    interval = np.zeros(len(z), np.int32)
    for _ in range(length // 2):
        came = np.empty(len(z), np.uint16)
        came[np.argsort(z, kind="stable")] = pairs
        deal = np.argsort(came, kind="stable")
        came, before = came[deal], interval[deal]
        z = z[deal]
        interval = np.concatenate(([0], np.cumsum((came[1:] != came[:-1]) | (before[1:] != before[:-1]), dtype=np.int32)))
    return orders, z, interval


def settle(texts: list[np.ndarray], doc: np.ndarray, at: np.ndarray, n: np.ndarray, length: int, shard_bytes: int = SHARD_BYTES):
    """Runs of windows of contested segments that also start earlier: (doc, first start, windows). texts[i] holds the bytes of n[i] windows from `at[i]` on."""
    size = np.array([len(t) for t in texts], np.int64) + 1
    flat = np.zeros(int(size.sum()), np.uint8)
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    for f, t in zip(first.tolist(), texts, strict=True):
        flat[f : f + len(t)] = t + 1  # 0 parts segments; UTF-8 has no byte 255
    n_shards = int(np.clip(-(-len(flat) // shard_bytes), 2, 255)) if len(texts) > 1 else 1
    bounds = np.unique(np.concatenate(([0], first[np.searchsorted(first, np.arange(1, n_shards) * len(flat) / n_shards).clip(0, len(first) - 1)], [len(flat)])))
    shards = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    orders, z, interval = merged_intervals(shards, length)
    place = np.empty(len(flat), np.int64)
    place[np.argsort(z, kind="stable")] = np.concatenate([o + a for o, a in zip(orders, bounds[:-1], strict=True)])
    seg = np.searchsorted(first, place, "right") - 1
    inside = place - first[seg]
    use = inside < n[seg]
    interval, seg, inside = interval[use], seg[use], inside[use]
    # intervals of one window are first occurrences
    starts = groups(interval)
    many = np.repeat(np.diff(np.append(starts, len(interval))) > 1, np.diff(np.append(starts, len(interval)))) if len(interval) else np.zeros(0, bool)
    interval, d, s = interval[many], doc[seg[many]], (at[seg] + inside)[many]
    order = np.lexsort((s, d, interval))
    new = np.zeros(len(order), bool)
    new[groups(interval[order])] = True
    later = elsewhere(new, d[order], s[order])
    d, s = d[order][later], s[order][later]
    order = np.lexsort((s, d))
    d, s = d[order], s[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] > s[:-1] + 1)
    at = np.flatnonzero(new)
    return d[at], s[at], (s[np.append(at[1:], len(d)) - 1] - s[at] + 1) if len(at) else s[at]


def fetch(length: int):
    """Texts of contested segments from rows of documents with their packed places: (anchor, part, payload). Part -1: a segment. From 0 on: a window of a crowded anchor, the task's first of its kind; part -2: a window that a task saw start earlier."""

    def run(batches):
        windows: dict[tuple[int, int, bytes], tuple[int, int]] = {}
        rows: list[tuple[int, int, bytes]] = []

        def send():
            rows.extend((a, part, pack(np.array([*place, 1, 0], np.int64), np.frombuffer(w, np.uint8))) for (a, part, w), place in windows.items())
            windows.clear()
            anchors, parts, blobs = zip(*rows, strict=True) if rows else ((), (), ())
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], ["anchor", "part", "payload"])

        for batch in slices(batches):
            data, off = strings(batch.column("text"))
            doc = batch.column("_doc").to_numpy()
            for i, spots in enumerate(batch.column("spots").to_pylist()):
                for s in spots:
                    a = int(off[i]) + s["at"]
                    text = data[a : a + s["n"] + length - 1]
                    if s["parts"] <= 1:
                        rows.append((s["anchor"], -1, pack(np.array([doc[i], s["at"], s["n"], s["o"]], np.int64), text)))
                        continue
                    raw = text.tobytes()
                    for k in range(s["n"]):
                        w, place = raw[k : k + length], (int(doc[i]), s["at"] + k)
                        key = (s["anchor"], zlib.crc32(w) % s["parts"], w)
                        first = windows.setdefault(key, place)
                        if first != place:
                            windows[key] = min(first, place)
                            rows.append((int(doc[i]), -2, pack(np.array([*max(first, place), 1, 0], np.int64), np.zeros(0, np.uint8))))
                if len(windows) > HELD_WINDOWS:
                    yield send()
            yield send()

    return run


def contenders(texts: list[bytes], o: list[int], n: list[int], length: int, k: int, step: int = 5) -> list[tuple[int, int]]:
    """For each segment of one anchor, the range of windows that can equal another's: (first, last), first > last if none can.

    A window that repeats shares what lies left and right of the anchor with the other, so both reach at least as far as it does. Reach is found by counting the segments with equal bytes up to each `step`; what the step leaves open counts as shared.
    """
    reach = []
    for left in (True, False):
        far = [0] * len(texts)
        alive = range(len(texts))
        for t in range(step, length - k + step, step):
            t = min(t, length - k)
            cut = {}
            for i in alive:
                if left and o[i] >= t:
                    cut.setdefault(texts[i][o[i] - t : o[i]], []).append(i)
                elif not left and o[i] + k + t <= len(texts[i]):
                    cut.setdefault(texts[i][o[i] + k : o[i] + k + t], []).append(i)
            alive = [i for same in cut.values() if len(same) > 1 for i in same]
            for i in alive:
                far[i] = t
            if not alive:
                break
        reach.append([x + step - 1 for x in far])
    return [(max(0, o[i] - lf), min(n[i] - 1, o[i] + k + rt - length)) for i, (lf, rt) in enumerate(zip(*reach, strict=True))]


def settle_groups(length: int, k: int, most: int = 384 << 10):
    """Settles rows that come sorted by anchor and part, some bytes of whole groups at a time. A group of any size is settled at once: it takes some 60 times its contenders' bytes. CROWD bounds the segments of a group, and about bounds the windows of a crowded anchor's part, which a hash of whole windows deals."""

    def run(batches):
        ready, held, group, last = [], 0, [], None

        def close():
            if last and last[1] >= 0:  # single windows of a crowded anchor
                out = [(int(w[0]), int(w[1]), 1, t) for w, t in group]
            else:
                texts, o, n = [t.tobytes() for _, t in group], [int(w[3]) for w, _ in group], [int(w[2]) for w, _ in group]
                out = [(int(w[0]), int(w[1]) + a, b - a + 1, t[a : b + length]) for (w, t), (a, b) in zip(group, contenders(texts, o, n, length, k), strict=True) if a <= b]
            return out if len(out) > 1 else []

        def settled():
            doc, at, n, texts = zip(*ready, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in settle(texts, np.array(doc, np.int64), np.array(at, np.int64), np.array(n, np.int64), length)], ["doc", "at", "n"])

        for batch in batches:
            seen = []
            for *of, blob in zip(batch.column("anchor").to_pylist(), batch.column("part").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                if of[1] == -2:
                    seen.append(unpack(blob, np.int64, np.uint8)[0][:3])
                    continue
                if of != last:
                    new = close()
                    ready += new
                    held += sum(len(x[3]) for x in new)
                    group, last = [], of
                    if held > most:
                        yield settled()
                        ready, held = [], 0
                group.append(unpack(blob, np.int64, np.uint8))
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.array(seen, np.int64).T.copy()], ["doc", "at", "n"])
        ready += close()
        if ready:
            yield settled()

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """docs with _doc, a row's place in the order of documents: its doc_id, the least long for null. Rows whose doc_id has several texts come before all others, in the order of a hash of both, so that each row has ranges of its own; only rows equal in both share a place."""
    named = docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_h": F.xxhash64(F.coalesce("text", F.lit("")))})
    several = small(named.groupBy("_id").agg(F.min("_h").alias("a"), F.max("_h").alias("b")).where("a <> b").select("_id", F.lit(True).alias("_several")))
    own = F.shiftrightunsigned(F.xxhash64("_id", "_h"), 2) + F.lit(NO_ID)
    found = named.join(several, "_id", "left").withColumn("_doc", F.when(F.col("_several"), own).otherwise(F.col("_id")))
    return found.select(*docs.columns, "_doc")


def repeats(docs: DataFrame, length: int = LENGTH, k: int = K, crowd: int = CROWD) -> DataFrame:
    """docs (as keyed returns them) with ranges: covered byte ranges as a sorted array of disjoint (a, b), null without repeats."""
    if length % 2 or not 8 <= k <= length:
        raise ValueError("length must be even and k from 8 to length")
    size = text_bytes(docs, "text")
    blobs = docs.select("_doc", "text").mapInArrow(block_segments(length, k, bucket_count(size, 16 << 20)), "bucket int, payload binary")
    rows = blobs.groupBy("bucket", F.when(F.col("bucket") < 0, F.xxhash64("payload"))).applyInArrow(contest, "doc long, kind byte, anchor long, at long, n long, o long")
    with arrow_rows(docs.sparkSession, 1000):
        rows = cut(rows)
    contested = rows.where("kind = 1")
    crowds = contested.groupBy("anchor").agg(F.sum("n").alias("m"), F.count("*").alias("c")).where(F.col("c") > crowd).select("anchor", F.ceil(F.col("m") / F.lit(crowd)).cast("int").alias("parts"))
    spots = contested.join(crowds, "anchor", "left").groupBy(F.col("doc").alias("_doc")).agg(F.collect_list(F.struct("anchor", "at", "n", "o", F.coalesce("parts", F.lit(1)).alias("parts"))).alias("spots"))
    dealt = docs.repartition("_doc")  # both joins take all its columns, so that they read one exchange of texts
    texts = dealt.join(spots.hint("shuffle_merge"), "_doc").mapInArrow(fetch(length), "anchor long, part int, payload binary")
    settled = texts.repartition("anchor", "part").sortWithinPartitions("anchor", "part").mapInArrow(settle_groups(length, k), "doc long, at long, n long")
    every = rows.where("kind = 0").select("doc", "at", "n").unionByName(settled)
    runs = every.groupBy(F.col("doc").alias("_doc")).agg(F.array_sort(F.collect_list(F.struct("at", (F.col("at") + F.col("n") + F.lit(length - 1)).alias("end")))).alias("r"))
    ranges = runs.mapInArrow(join_ranges, "_doc long, ranges array<struct<a:long,b:long>>")
    return dealt.join(ranges.hint("shuffle_merge"), "_doc", "left")


def join_ranges(batches):
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    for batch in batches:
        out = []
        for r in batch.column("r").to_pylist():
            runs = []
            for x in r:
                if runs and x["at"] <= runs[-1]["b"]:
                    runs[-1]["b"] = max(runs[-1]["b"], x["end"])
                else:
                    runs.append({"a": x["at"], "b": x["end"]})
            out.append(runs)
        yield pa.RecordBatch.from_arrays([batch.column("_doc"), pa.array(out, kind)], ["_doc", "ranges"])


def deduplicate(docs: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of docs (doc_id, text).

    Documents are in the order of doc_id, null least. Rows of one doc_id with different texts come before all others and are judged apart; rows equal in both are one document that comes several times, and get equal results. Null texts are empty. Texts below `length` bytes keep all. No rows: no rows.
    """
    rows = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    found = repeats(rows, length, k)

    def run(batches):
        for batch in slices(batches):
            data, off = strings(batch.column("text"))
            n, gone, spans, sha = [], [], [], []
            for i, ranges in enumerate(batch.column("ranges").to_pylist()):
                raw = data[off[i] : off[i + 1]].tobytes()
                ranges = ranges or ()
                h, at, removed = hashlib.sha256(), 0, 0
                for r in ranges:
                    h.update(raw[at : r["a"]])
                    at = r["b"]
                    removed += r["b"] - r["a"]
                h.update(raw[at:])
                n.append(len(raw))
                gone.append(removed)
                spans.append(len(ranges))
                sha.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return found.select("doc_id", "text", "ranges").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def keep_text(raw: bytes, ranges) -> str:
    """What is left of a text: a code point goes if all its bytes are covered."""
    out, at = [], 0
    for r in ranges:
        a, b = r["a"], r["b"]
        while a < len(raw) and raw[a] & 0xC0 == 0x80:
            a += 1
        while b < len(raw) and b > a and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append(raw[at:a])
            at = b
    return b"".join([*out, raw[at:]]).decode()


def strip(docs: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """docs with repeated passages cut from text and n_chars (if there) recounted. Only whole code points go; null texts stay null. Order, repeated rows and ids as in deduplicate; further columns may have any name."""
    rest = F.struct(*(c for c in docs.columns if c != "text"))
    found = repeats(keyed(docs.select("doc_id", "text", rest.alias("rest"))), length, k)

    def run(batches):
        for batch in slices(batches):
            texts = [t if t is None or not r else keep_text(t.encode(), r) for t, r in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(texts, pa.string()), pa.array([None if t is None else len(t) for t in texts], pa.int64())], ["rest", "text", "n"])

    made = found.select("text", "rest", "ranges").mapInArrow(run, StructType([found.schema["rest"], StructField("text", StringType()), StructField("n", LongType())]))
    value = {"text": F.col("text"), "n_chars": F.col("n")}
    return made.select(*((value[c].cast(docs.schema[c].dataType) if c in value else F.col("rest").getField(c)).alias(c) for c in docs.columns))
