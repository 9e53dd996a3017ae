"""Near copies of texts: Golay-keyed SimHash fingerprints first, then an exact join on word shingles for what they miss.

Near copies are texts whose sets of distinct SHINGLE-word shingles have a Jaccard similarity of 0.8 or more. At 0.8 some
10 of a fingerprint's 64 bits differ, more than the Golay keys of `simhash` reach (4), so the fingerprints of five-word
shingles join the closest copies, and large groups of them, without pairs; a prefix join over shingles finds the rest:
in one order of all shingles, two sets this similar share one of the first n - ceil(0.8 n) + 1 of each, so no such pair
is missed. The order puts shingles that a sample of the corpus holds twice late; any order finds the same pairs, so it
goes by a shingle's slot, one byte of a table whose size is fixed, and not by a list of shingles that the driver would hold.

Every link is verified by whole sets. Before that, pairs that can't reach 0.8 are put out by bounds: what may follow
their first shared shingle, and how many of their shingles fall in the same ranges of the hash space.

Equal sets are merged first. Of each shingle a member is compared with one of another component, once a set and round;
only members that are in different components after ROUNDS are compared in pairs, inside the tasks of their shingles: a
pair is left to an earlier shingle if both have it among the BEFORE shingles that precede this one in their prefixes, and
may be sent on only if the counts of its sets' shingles in BUCKETS ranges of the hash space allow 0.8. A row carries these
few numbers, not its set. Shingles with many members are cut in pairs of chunks. In each of CLOSEST turns a set sends on
one pair, that whose counts allow most, so as many pairs at most as there are sets; what these link needs no other pair,
and a set that has none takes no part any more. The last turn sends on all pairs that are in different components still.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import simhash
from .blocks import arrow_rows, cut, fresh, shuffles_freed, slices, small, strings
from .components import components

SHINGLE = 5
SEED = 42
#: Texts that the order of shingles is sampled from, about, and how many of them have to hold a shingle for it to be late.
SAMPLE = 20_000
OFTEN = 2
#: Slots that shingles fall in by their last bits, and how many of them a row takes to the driver; powers of two.
SLOTS, SLOTS_A_ROW = 1 << 22, 1 << 16
#: Shingles in a range of the hash space, about.
PER_RANGE = 6
#: Rounds of stars, ranges that a set is counted in before pairs are sent on, and members of a shingle that a task compares at once.
ROUNDS, BUCKETS, HOT = 1, 512, 2048
#: Turns in which a set sends on one pair, before the one that sends on all.
CLOSEST = 2
#: Links, of two numbers each, whose components are found in one task: more are dealt out.
ALONE = 20_000
#: Shingles of its prefix that a member carries, those right before.
BEFORE = 8
NO_ID = -(2**63)


def shingles(batch):
    """Hashes of each text's shingles, repeats included; a text of fewer words is one shingle, one without words has none."""
    import xxhash

    data, off = strings(batch.column("text"))
    raw = data.tobytes()
    for i in range(len(off) - 1):
        words = raw[off[i] : off[i + 1]].lower().split()
        lines = [b" ".join(words[j : j + SHINGLE]) for j in range(max(1, len(words) - SHINGLE + 1))] if words else []
        yield np.array([xxhash.xxh64_intdigest(x, SEED) for x in lines], np.uint64)


def set_hash(grams: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(grams.tobytes(), SEED) if len(grams) else 0


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half the hashes."""
    if not len(hashes):
        return 0
    ones = sum(np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64) for some in np.array_split(hashes, len(hashes) // 100_000 + 1))
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def ranges(grams: np.ndarray) -> np.ndarray:
    """How many of a set's shingles fall in each of 2**r equal ranges of the hash space."""
    r = max(0, (len(grams) // PER_RANGE).bit_length() - 1)
    return np.bincount((grams >> np.uint64(64 - r)).astype(np.int64) if r else np.zeros(len(grams), np.int64), minlength=1 << r).astype(np.uint16)


def most_shared(a: np.ndarray, b: np.ndarray) -> int:
    """No two sets with these ranges share more shingles than that."""
    if len(a) > len(b):
        a, b = b, a
    return int(np.minimum(a, b.reshape(len(a), -1).sum(1, dtype=np.int64)).sum())


def describe(docs: DataFrame) -> DataFrame:
    """h (hash of the text), s (hash of its set; 0 without words), print (its fingerprint), ranges of each text of docs (h, text)."""

    def run(batches):
        for batch in slices(batches):
            s, prints, parts = [], [], []
            for hashes in shingles(batch):
                grams = np.unique(hashes)
                s.append(set_hash(grams))
                prints.append(fingerprint(hashes))
                parts.append(ranges(grams).tobytes())
            cols = [batch.column("doc"), batch.column("h"), *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (s, prints)), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["doc", "h", "s", "print", "ranges"])

    return docs.mapInArrow(run, "doc long, h long, s long, print long, ranges binary")


def sets(texts: DataFrame) -> DataFrame:
    """s and grams of each text (column text)."""

    def run(batches):
        for batch in slices(batches):
            grams = [np.unique(x) for x in shingles(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array([set_hash(g) for g in grams], np.uint64).view(np.int64)), pa.array([g.view(np.int64) for g in grams], pa.list_(pa.int64()))], ["s", "grams"])

    return texts.select("text").mapInArrow(run, "s long, grams array<long>")


def prefix_of(grams: np.ndarray, late) -> np.ndarray:
    """The first of a set's shingles in the order of all shingles, so many that similar sets share one. late: what order() broadcasts."""
    n = len(grams)
    turn = late[(grams & np.uint64(len(late) - 1)).astype(np.int64)]
    return grams[np.lexsort((grams, turn))][: n - -(-4 * n // 5) + 1]


def prefixes(texts: DataFrame, late) -> DataFrame:
    """gram, s, n (size of the set), at (place in the order) of each set's prefix; a task sends a set once."""

    def run(batches):
        seen = set()
        for batch in slices(batches):
            out = [[], [], [], []]
            for hashes in shingles(batch):
                grams = np.unique(hashes)
                n, s = len(grams), set_hash(grams)
                if not n or s in seen:
                    continue
                seen.add(s)
                first = prefix_of(grams, late.value)
                for c, x in zip(out, (first.view(np.int64), np.full(len(first), s, np.uint64).view(np.int64), np.full(len(first), n), np.arange(len(first))), strict=True):
                    c.append(x.astype(np.int64))
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["gram", "s", "n", "at"])

    return texts.select("text").mapInArrow(run, "gram long, s long, n long, at long")


def profiles(texts: DataFrame, late) -> DataFrame:
    """s, prefix and counts (of BUCKETS ranges of the hash space; none where one exceeds a byte) of each text's set."""

    def run(batches):
        for batch in slices(batches):
            s, first, counts = [], [], []
            for hashes in shingles(batch):
                grams = np.unique(hashes)
                s.append(set_hash(grams))
                first.append(prefix_of(grams, late.value).view(np.int64))
                n = np.bincount((grams >> np.uint64(65 - BUCKETS.bit_length())).astype(np.int64), minlength=BUCKETS)
                counts.append(n.astype(np.uint8).tobytes() if n.max() < 256 else b"")
            yield pa.RecordBatch.from_arrays([pa.array(np.array(s, np.uint64).view(np.int64)), pa.array(first, pa.list_(pa.int64())), pa.array(counts, pa.binary())], ["s", "prefix", "counts"])

    return texts.select("text").mapInArrow(run, "s long, prefix array<long>, counts binary")


def runs(batches, keys: list[str]):
    """Tables of the rows of one key each, of batches sorted by the keys."""
    held = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in keys]
        at = [0, *(np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], 0)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(at, at[1:], strict=False):
            part = batch.slice(lo, hi - lo)
            if held and any(held[-1].column(k)[0] != part.column(k)[0] for k in keys):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def meet_before(before: list[np.ndarray]) -> np.ndarray:
    """Which members share a shingle that comes before this one, as a matrix."""
    m = len(before)
    grams, row = np.concatenate(before), np.repeat(np.arange(m), [len(x) for x in before])
    _, i, n = np.unique(grams, return_inverse=True, return_counts=True)
    row, i = row[n[i] > 1], i[n[i] > 1]
    _, i = np.unique(i, return_inverse=True)
    out = np.zeros((m, m), bool)
    for lo in range(0, int(i.max(initial=-1)) + 1, 4096):
        mine = (i >= lo) & (i < lo + 4096)
        has = np.zeros((m, 4096), np.float32)
        has[row[mine], i[mine] - lo] = 1
        out |= (has @ has.T) > 0
    return out


def pairs_of(closest: bool):
    """Pairs of a shingle's members that are in different components, that aren't left to an earlier shingle and that may be similar; of each member all, or the one that may share most (may: of how many in 10,000)."""

    def run(batches):
        for t in runs(batches, ["gram", "c1", "c2"]):
            if t.num_rows < 2:
                continue
            s, n, at, root, mine, c1, c2 = (t.column(c).to_numpy() for c in ("s", "n", "at", "root", "mine", "c1", "c2"))
            before = t.column("before").combine_chunks()
            off, flat = before.offsets.to_numpy(), before.values.to_numpy()
            full = np.full(BUCKETS, 65535, np.uint16)
            counts = np.stack([np.frombuffer(x, np.uint8).astype(np.uint16) if x else full for x in t.column("counts").to_pylist()])
            met = meet_before([flat[a:b] for a, b in zip(off, off[1:], strict=False)])
            out, best, of = [], np.zeros(len(s), np.int64), np.zeros(len(s), np.int64)
            for i in range(len(s)):
                j = np.flatnonzero((s > s[i]) & (root != root[i]) & ~met[i] & (5 * np.minimum(n, n[i]) >= 4 * np.maximum(n, n[i])) & (9 * np.minimum(n - at, n[i] - at[i]) >= 4 * (n + n[i])))
                if c1[0] != c2[0]:
                    j = j[mine[j] != mine[i]]
                if not len(j):
                    continue
                most = np.minimum(counts[j], counts[i]).sum(1, dtype=np.int64)
                keep = 9 * most >= 4 * (n[j] + n[i])
                j, may = j[keep], 20_000 * most[keep] // (n[j] + n[i])[keep]
                if not closest:
                    out.append((np.full(len(j), s[i]), s[j], may))
                elif len(j):
                    more = may > best[j]
                    best[j[more]], of[j[more]] = may[more], s[i]
                    if may.max() > best[i]:
                        best[i], of[i] = may.max(), s[j[may.argmax()]]
            if best.any():
                out.append((s[best > 0], of[best > 0], best[best > 0]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], ["a", "b", "may"])

    return run


def able_to_pair(member: DataFrame) -> DataFrame:
    """Members of a shingle (gram, s, n, ...) that have another one near in size."""
    of = Window.partitionBy("gram").orderBy("n", "s")
    fits = lambda other: F.coalesce(5 * F.least("n", other) >= 4 * F.greatest("n", other), F.lit(False))
    return cut(member.withColumns({"_a": F.lag("n").over(of), "_b": F.lead("n").over(of)}).where(fits(F.col("_a")) | fits(F.col("_b"))).drop("_a", "_b"))


def known_of(member: DataFrame, docs: DataFrame, rows: DataFrame, late) -> DataFrame:
    """profiles() of the members' sets."""
    one = small(rows.join(member.select("s").distinct(), "s", "left_semi").groupBy("s").agg(F.min("h").alias("h")).select("h"))
    return cut(profiles(docs.join(one, "h", "left_semi").dropDuplicates(["h"]), late).dropDuplicates(["s"]))


def near_pairs(member: DataFrame, known: DataFrame, closest: bool) -> DataFrame:
    """Pairs (a, b) of sets that share a shingle of their prefixes, lie in different components and may be similar; closest: for each set that has any one, with the set as a. member: gram, s, n, at, root; known: what known_of says of them."""
    many = small(member.groupBy("gram").agg(F.count("*").alias("m")).where(F.col("m") > HOT))
    chunks = F.ceil(F.col("m") / F.lit(HOT)).cast("int")
    dealt = member.join(many, "gram", "left").withColumn("mine", F.when(F.col("m").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("s"), chunks).cast("int")))
    at = F.col("at").cast("int")
    full = dealt.join(known, "s").withColumn("before", F.slice("prefix", F.greatest(at - BEFORE, F.lit(0)) + 1, F.least(at, F.lit(BEFORE))))
    others = F.when(F.col("m").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), chunks - 1))
    full = full.select("*", F.explode(others).alias("other")).withColumns({"c1": F.least("mine", "other"), "c2": F.greatest("mine", "other")})
    keys = ["gram", "c1", "c2"]
    pairs = full.select(*keys, "s", "n", "at", "root", "mine", "before", "counts").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(pairs_of(closest), "a long, b long, may long")
    if closest:
        return pairs.groupBy("a").agg(F.max(F.struct("may", "b")).alias("best")).select("a", "best.b")
    return pairs.select("a", "b").distinct()


def slots(batches):
    """Of rows (part, slot, count), all of a part in one task: each part's slots as bytes, the most of each slot's counts, 255 at most."""
    parts: dict[int, np.ndarray] = {}
    for batch in batches:
        part, slot, count = (batch.column(c).to_numpy() for c in ("part", "slot", "count"))
        for p in np.unique(part).tolist():
            mine = part == p
            held = parts.setdefault(p, np.zeros(SLOTS_A_ROW, np.uint8))
            np.maximum.at(held, slot[mine], np.minimum(count[mine], 255).astype(np.uint8))
    for p, held in parts.items():
        yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([held.tobytes()], pa.binary())], ["part", "held"])


def order(docs: DataFrame):
    """Broadcasts SLOTS bytes: of each slot how many texts of a sample hold that of its shingles which most hold, 0 if none is held by OFTEN or more. The driver gets these bytes, however many shingles there are."""
    rate = max(1, docs.count() // SAMPLE)
    some = docs.where(F.pmod("h", F.lit(rate)) == 0).select("text").dropDuplicates(["text"])
    often = sets(some).select(F.explode("grams").alias("g")).groupBy("g").count().where(F.col("count") >= OFTEN)
    slot = F.col("g").bitwiseAND(F.lit(SLOTS - 1))
    dealt = often.select(F.floor(slot / F.lit(SLOTS_A_ROW)).alias("part"), (slot % F.lit(SLOTS_A_ROW)).alias("slot"), "count").repartition("part")
    late = np.zeros(SLOTS, np.uint8)
    for part, held in dealt.mapInArrow(slots, "part long, held binary").collect():
        late[part * SLOTS_A_ROW : (part + 1) * SLOTS_A_ROW] = np.frombuffer(held, np.uint8)[:SLOTS]
    return docs.sparkSession.sparkContext.broadcast(late)


def able(batches):
    """Pairs whose ranges allow a similarity of 0.8."""
    for batch in batches:
        a, b = ([np.frombuffer(x, np.uint16) for x in batch.column(c).to_pylist()] for c in ("ra", "rb"))
        keep = pa.array([9 * most_shared(x, y) >= 4 * (int(x.sum()) + int(y.sum())) for x, y in zip(a, b, strict=True)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def similar(pairs: DataFrame, docs: DataFrame, rows: DataFrame, bound: bool = True) -> DataFrame:
    """Those of pairs (a, b) of set hashes whose sets have a Jaccard similarity of at least 0.8. rows: what describe says of docs. bound: pairs whose ranges don't allow it go first; what near_pairs finds has been through BUCKETS ranges."""
    left = pairs.select("a", "b")
    if bound:
        held = rows.select("s", "ranges").dropDuplicates(["s"])
        both = pairs.join(held.toDF("a", "ra"), "a").join(held.toDF("b", "rb"), "b")
        left = both.select("a", "b", "ra", "rb").mapInArrow(able, "a long, b long")
    left = cut(left)
    wanted = left.select(F.explode(F.array("a", "b")).alias("s")).distinct()
    one = small(rows.join(wanted, "s", "left_semi").groupBy("s").agg(F.min("h").alias("h")).select("h"))
    grams = sets(docs.join(one, "h", "left_semi").dropDuplicates(["h"])).dropDuplicates(["s"])
    full = left.join(grams.toDF("a", "x"), "a").join(grams.toDF("b", "y"), "b")
    full = full.select("a", "b", F.size("x").alias("n"), F.size("y").alias("m"), F.size(F.array_intersect("x", "y")).alias("c"))
    return cut(full.where("5 * c >= 4 * (n + m - c)").select("a", "b"))


def close(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets with fingerprints within simhash.DISTANCE bits: each set and the least one of its fingerprint, and the least ones of linked fingerprints."""
    named = rows.where("s <> 0").groupBy("print").agg(F.min("s").alias("least"))
    same = rows.where("s <> 0").select("s", "print").distinct().join(named, "print").where("s <> least").select(F.col("least").alias("a"), F.col("s").alias("b"))
    found = simhash.links(named).toDF("p", "q")
    linked = found.join(named.toDF("p", "a"), "p").join(named.toDF("q", "b"), "q").select("a", "b")
    return same.unionByName(linked)


def merged(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """roots (node, root; a node that isn't there is its own root) after more edges (a, b): only what these link is solved."""
    of = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"of_{c}"))
    apart = edges.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    moved = small(components(apart, alone=ALONE))
    known = roots.join(moved.toDF("root", "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return small(known.unionByName(moved.join(roots.select("node"), "node", "left_anti")))


def rooted_sets(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, root) of set hashes: the least of all that links of a similarity of at least 0.8 lead to; sets without any are left out. docs: h, text; rows: what describe says of them."""
    roots, late = small(components(similar(close(rows), docs, rows), alone=ALONE)), order(docs)
    by = Window.partitionBy("gram")
    found = prefixes(docs, late).repartition("gram").dropDuplicates(["gram", "s"]).withColumns({"least": F.min("s").over(by), "most": F.max("s").over(by)})
    shared = cut(found.where("least <> most").select("gram", "s", "n", "at"))
    may = "5 * least(n, first.n) >= 4 * greatest(n, first.n) AND 9 * least(n - at, first.n - first.at) >= 4 * (n + first.n)"

    def apart():
        """Members with their components, of shingles whose members are in several."""
        member = shared.join(roots, F.col("s") == F.col("node"), "left").select("gram", "s", "n", "at", F.coalesce("root", "s").alias("root"))
        return member.withColumn("several", F.min("root").over(by) != F.max("root").over(by)).where("several").drop("several")

    for k in range(ROUNDS):
        mark = F.struct(F.xxhash64("root", F.lit(k)).alias("k"), "root", "s", "n", "at")
        first = apart().withColumn("first", F.min(mark).over(by))
        star = first.where("root <> first.root AND " + may).groupBy(F.col("s").alias("b")).agg(F.min("first.s").alias("a"))
        roots = merged(roots, similar(star.select("a", "b"), docs, rows))
    member = able_to_pair(apart())
    known = known_of(member, docs, rows, late)
    for _ in range(CLOSEST):
        best = cut(near_pairs(member, known, True))
        roots = merged(roots, similar(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), docs, rows, False))
        member = able_to_pair(apart().join(small(best.select(F.col("a").alias("s"))), "s", "left_semi"))
    return merged(roots, similar(near_pairs(member, known, False), docs, rows, False))


def keep_first(docs: DataFrame) -> DataFrame:
    """The first row, by (doc_id, hash of the text), of each group that links of at least 0.8 connect.

    Null, empty and blank texts have no words and are one group. A null doc_id is the least. Rows equal in doc_id and text stand or go together. No rows: no rows.
    """
    doc, h = fresh(docs, "doc"), fresh(docs, "h")
    keys = {doc: F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), h: F.xxhash64(F.coalesce("text", F.lit("")))}
    slim = docs.select(keys[doc].alias("doc"), keys[h].alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    with arrow_rows(docs.sparkSession, 1000), shuffles_freed(docs.sparkSession):
        rows = cut(describe(slim))
        roots = rooted_sets(slim.select("h", "text"), rows)
        rooted = rows.join(roots, F.col("s") == F.col("node"), "left").select("doc", "h", F.coalesce("root", "s").alias("root"))
        kept = rooted.groupBy("root").agg(F.min(F.struct("doc", "h")).alias("kept"))
        drop = small(rooted.join(kept, "root").where("doc <> kept.doc OR h <> kept.h").select(F.col("doc").alias(doc), F.col("h").alias(h)).distinct())
    return docs.withColumns(keys).join(drop, [doc, h], "left_anti").select(*docs.columns)
