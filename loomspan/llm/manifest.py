"""Merkle manifest of a table: leaves, subroots of groups, a root, and proofs that lead from a leaf to the root.

A leaf hashes a row's fields. In each group, leaves ascend by a key; every FANOUT consecutive nodes become the hash of
their digests until one is left, the group's subroot; the subroots, ordered by group, likewise give the root.

Levels are windows: nodes are partitioned by group and parent index, and an ordered full-frame collect_list gives each
node its run, which is the parent's preimage and, without the node itself, its siblings. The first node of a run stands
for the parent, so parents are distinct before the next level. A run has FANOUT nodes, so no window is large however
large its group is. Proofs go down again by joins of a level with the one above: all levels have twice the leaves' rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import cut, small

FANOUT = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<before:array<binary>,after:array<binary>>"
#: Levels that are joined in one plan on the way down.
JOINS = 6


def digest(preimage: Column) -> Column:
    return F.unhex(F.sha2(preimage, 256))


def shown(d: Column) -> Column:
    """A digest as text."""
    return F.lower(F.hex(d))


def of_run(digests: Column) -> Column:
    """The digest of digests, concatenated as text."""
    return digest(F.array_join(F.transform(digests, shown), ""))


def field(value: Column) -> Column:
    """A field in a leaf's preimage: - for null, else its bytes' number, a colon and itself."""
    v = value.cast("string")
    return F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))


def leaf(fields: list[Column]) -> Column:
    return digest(F.concat(*map(field, fields)))


def fold(start: Column, proof: Column) -> Column:
    """The digest that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda d, s: of_run(F.concat(s["before"], F.array(d), s["after"])))


def siblings(proof: Column) -> Column:
    """A proof's digests, level by level, left to right."""
    return F.flatten(F.transform(proof, lambda s: F.concat(s["before"], s["after"])))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (grp and others) with idx, their place in their grp by `order` from 0, and n, the rows of the grp.

    Rows are dealt by ranges of (grp, *order); a place is that in the range and the rows of the grp in earlier ranges, so no task needs a whole grp. Rows that tie are interchangeable.
    """
    dealt = cut(rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order).withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33).alias("_part")
    held = dealt.groupBy("grp", part).agg(F.min("_m").alias("_first"), F.count("*").alias("_c"))
    by = Window.partitionBy("grp")
    before = F.coalesce(F.sum("_c").over(by.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = small(held.select("grp", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_c").over(by).alias("n")))
    return dealt.withColumn("_part", F.shiftright("_m", 33)).join(starts, ["grp", "_part"]).withColumn("idx", F.col("_m") + F.col("_shift")).drop("_m", "_part", "_shift")


def levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(tables of the levels below a top, lowest first: the nodes with parent and step; tops: grp, top) of leaves (grp, idx, n, digest and others)."""
    run = Window.partitionBy("grp", "parent").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = (F.col("idx") % FANOUT).cast("int")
    most = nodes.agg(F.max("n")).first()[0] or 0
    tops, tables = [nodes.where("n = 1").select("grp", F.col("digest").alias("top"))], []
    while most > 1:
        held = nodes.where("n > 1").withColumn("parent", F.floor(F.col("idx") / FANOUT)).withColumn("run", F.collect_list("digest").over(run))
        step = F.struct(F.slice("run", F.lit(1), place).alias("before"), F.slice("run", place + 2, F.lit(FANOUT)).alias("after"))
        up = F.when(F.col("idx") % FANOUT == 0, of_run(F.col("run")))
        held = cut(held.select(*nodes.columns, "parent", step.alias("step"), up.alias("up")))
        tables.append(held.drop("up"))
        nodes = held.where("up IS NOT NULL").select("grp", F.col("parent").alias("idx"), F.ceil(F.col("n") / FANOUT).alias("n"), F.col("up").alias("digest"))
        tops.append(nodes.where("n = 1").select("grp", F.col("digest").alias("top")))
        most = -(-most // FANOUT)
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return tables, out


def prove(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(leaves with proof, a list of steps from the lowest; tops) of leaves (grp, idx, n, digest and others)."""
    tables, tops = levels(leaves)
    none = F.array().cast(f"array<{STEP}>")
    above = None
    for i, table in enumerate(reversed(tables)):
        own = F.array(F.col("step").cast(STEP))
        if above is None:
            above = table.withColumn("proof", own)
        else:
            up = above.select("grp", F.col("idx").alias("parent"), F.col("proof").alias("_rest"))
            above = table.join(up, ["grp", "parent"], "left").withColumn("proof", F.concat(own, F.coalesce("_rest", none))).drop("_rest")
        if i % JOINS == JOINS - 1:
            above = cut(above)
    lone = leaves.where("n = 1").withColumn("proof", none)
    return (lone if above is None else lone.unionByName(above.drop("parent", "step"))), tops


def group_key(group: Column) -> Column:
    """A group as text that orders null first, then by bytes."""
    g = group.cast("string")
    return F.when(g.isNull(), F.lit("")).otherwise(F.concat(F.lit("1"), g))


def manifest(docs: DataFrame, group: str = "lang", key: str = "doc_id", fields: tuple[str, ...] = FIELDS, keep: dict[str, Column] | None = None) -> DataFrame:
    """key, leaf, subroot, root (binary) and proof of every row of docs, with the columns of `keep` (expressions over docs).

    Null keys come first in their group; rows of one key go by their leaves; rows equal in all fields are leaves of their own. A null group is a group. A lone leaf is its subroot, a lone subroot the root. No rows: no rows.
    """
    keep = keep or {}
    rows = docs.select(F.col(key).alias("key"), group_key(F.col(group)).alias("grp"), leaf([F.col(f) for f in fields]).alias("digest"), *(c.alias(f"keep_{n}") for n, c in keep.items()))
    leaves, tops = prove(ranked(cut(rows), ["key", "digest"]))
    groups, root = prove(ranked(tops.select("grp", F.col("grp").alias("name"), F.col("top").alias("digest")).withColumn("grp", F.lit("")), ["name"]))
    whole = root.first()
    subroots = small(groups.select(F.col("name").alias("grp"), F.col("digest").alias("subroot"), F.col("proof").alias("rest")))
    out = leaves.join(subroots, "grp").withColumn("proof", F.concat("proof", "rest"))
    return out.select(F.col("key").alias(key), F.col("digest").alias("leaf"), "subroot", F.lit(bytes(whole["top"]) if whole else None).cast("binary").alias("root"), "proof", *(F.col(f"keep_{n}").alias(n) for n in keep))


def tampered(docs: DataFrame) -> Column:
    """The leaf of a document after n_chars has grown by 1 where 7 divides the crc32 of doc_id; null elsewhere. A null n_chars stays; a null doc_id isn't tampered with."""
    grown = {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, leaf([grown.get(f, F.col(f)) for f in FIELDS]))


def audit(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (text) and verified of docs (doc_id, source, lang, n_chars, text), some of which are tampered with before they are verified. See manifest for nulls, ties, repeats and empty tables."""
    found = manifest(docs, keep={"changed": tampered(docs)})
    folded = found.withColumn("folded", fold(F.coalesce("changed", "leaf"), F.col("proof")))
    return folded.select(
        "doc_id", *(shown(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")), shown(of_run(siblings(F.col("proof")))).alias("proof_sha256"),
        shown(F.col("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


def _sql_leaf(n_chars: str) -> str:
    each = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode(({x})::VARCHAR)) || ':' || ({x})::VARCHAR, '-')" for x in each) + ")"


ORACLE = f"""WITH RECURSIVE bits AS (SELECT i AS k, i AS c, 0 AS n FROM range(256) t(i) UNION ALL SELECT k, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n + 1 FROM bits WHERE n < 8),
tab AS (SELECT list(c ORDER BY k) AS t FROM bits WHERE n = 8),
d AS (SELECT doc_id, lang, {_sql_leaf("n_chars")} AS leaf,
  CASE WHEN doc_id IS NOT NULL AND xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % 7 = 0
    THEN {_sql_leaf("n_chars::HUGEINT + 1")} END AS changed FROM documents, tab),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
nodes AS (SELECT lang, 0 AS lvl, i, n, leaf AS h FROM leaves
  UNION ALL SELECT lang, lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY lang, lvl, i // 2, n),
subs AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS lvl, i, n, subroot AS h FROM subs
  UNION ALL SELECT lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY lvl, i // 2, n),
low AS (SELECT l.lang, l.i AS i0, x.lvl, (l.i >> x.lvl) & 1 AS side, s.h FROM leaves l JOIN (SELECT DISTINCT lang, lvl FROM nodes WHERE n > 1) x ON l.lang IS NOT DISTINCT FROM x.lang
  LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM l.lang AND s.lvl = x.lvl AND s.i = xor(l.i >> x.lvl, 1)),
high AS (SELECT u.lang, x.lvl + 1000 AS lvl, (u.i >> x.lvl) & 1 AS side, s.h FROM subs u, (SELECT DISTINCT lvl FROM tops WHERE n > 1) x LEFT JOIN tops s ON s.lvl = x.lvl AND s.i = xor(u.i >> x.lvl, 1)),
steps AS (SELECT * FROM low UNION ALL SELECT l.lang, l.i, h.lvl, h.side, h.h FROM leaves l JOIN high h ON l.lang IS NOT DISTINCT FROM h.lang),
proofs AS (SELECT lang, i0, coalesce(string_agg(h, '' ORDER BY lvl), '') AS sibs, list(CASE WHEN h IS NULL THEN '2' WHEN side = 0 THEN '0' || h ELSE '1' || h END ORDER BY lvl) AS way FROM steps GROUP BY lang, i0),
f AS (SELECT l.doc_id, l.leaf, u.subroot, (SELECT h FROM tops WHERE n = 1) AS root, sha256(coalesce(p.sibs, '')) AS proof_sha256,
  list_reduce(list_prepend(coalesce(l.changed, l.leaf), coalesce(p.way, []::VARCHAR[])), lambda a, s: sha256(CASE s[1] WHEN '0' THEN a || s[2:] WHEN '1' THEN s[2:] || a ELSE a END)) AS folded_root
  FROM leaves l JOIN subs u ON l.lang IS NOT DISTINCT FROM u.lang LEFT JOIN proofs p ON p.lang IS NOT DISTINCT FROM l.lang AND p.i0 = l.i)
SELECT *, folded_root = root AS verified FROM f"""
