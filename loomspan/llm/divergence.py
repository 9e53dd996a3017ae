"""Divergence of sources: how far the term shares of two sources of a language lie apart, and which terms stand out.

Tasks count terms of whole texts and send sums. A language keeps the terms that enough of its documents hold; kept terms
are dealt to chunks of the vocabulary, and a group (a source of a language) has one packed vector of counts for each
chunk. Groups stand in blocks of BLOCK; a task of the pair tiling has one block by another: the blocks' vectors are
replicated to all tiles of their row and column, and a task goes through its chunks one after the other, so it holds
2 * BLOCK vectors of about CHUNK terms at a time, however many groups and terms there are. A tile with many chunks is cut
in stripes, whose submatrices are summed.

All arithmetic is in integers: shares are parts of SCALE by long division.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import cut, give_back, slices, small

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
LEAST_DOCS, SCALE, TOP = 10, 1_000_000_000, 10
#: Groups in a block, terms in a chunk of the vocabulary (about), chunks in a stripe of a tile.
BLOCK, CHUNK, STRIPE = 32, 4096, 16
#: Distinct terms that a task sums before it sends them on.
HELD = 300_000


def count_terms(batches):
    """lang, source, term, n (occurrences), docs (documents that hold it) of texts; a term may come several times."""
    held: dict = {}
    size = 0

    def send():
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            for lo in range(0, len(terms), 50_000):
                some = terms[lo : lo + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some)), pa.array([source] * len(some)), pa.array(some, pa.binary()).cast(pa.string()), pa.array([n[x] for x in some], pa.int64()), pa.array([docs[x] for x in some], pa.int64())],
                    ["lang", "source", "term", "n", "docs"],
                )

    for batch in slices(batches):
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text")), strict=True):
            found = Counter(TERM.findall(text.as_buffer().to_pybytes().lower()))
            n, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            size -= len(n)
            n.update(found)
            docs.update(found.keys())
            size += len(n)
        if size > HELD:
            yield from send()
            held, size = {}, 0
    yield from send()
    give_back()


def plain(docs: DataFrame) -> DataFrame:
    """lang, source and text of docs, nulls as ''."""
    return docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, source, term, n of the terms that `least` or more documents of the language hold, with total (n of the language) and lead (one row of a language's term has it)."""
    parts = plain(docs).mapInArrow(count_terms, "lang string, source string, term string, n long, docs long")
    each = parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by = Window.partitionBy("lang", "term")
    both = each.withColumns({"held": F.sum("docs").over(by), "total": F.sum("n").over(by), "lead": F.row_number().over(by.orderBy("source")) == 1})
    return both.where(F.col("held") >= least).drop("docs", "held")


def group_table(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, g (place in the language), groups (of it), n_group (N), n_lang, v (V), chunks of every group that occurs."""
    every = plain(docs).select("lang", "source").distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("n_group"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.count_if("lead").alias("v"))
    of = Window.partitionBy("lang")
    out = every.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["n_group", "n_lang", "v"])
    out = out.withColumns({"g": (F.row_number().over(of.orderBy("source")) - 1).cast("int"), "groups": F.count("*").over(of).cast("int")})
    return small(out.withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.col("v") / CHUNK)).cast("int")))


def vectors(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, chunk, g, d (N + 2V), size (terms of the chunk), counts (list of id and n) of every group and chunk, a chunk without its terms included."""
    chunks = groups.groupBy("lang").agg(F.max("chunks").alias("chunks"))
    terms = kept.where("lead").select("lang", "term").join(small(chunks), "lang")
    terms = terms.withColumn("chunk", F.pmod(F.xxhash64("lang", "term"), F.col("chunks")).cast("int"))
    by = Window.partitionBy("lang", "chunk")
    ids = terms.select("lang", "term", "chunk", (F.row_number().over(by.orderBy("term")) - 1).cast("int").alias("id"))
    named = groups.select("lang", "source", "g", (F.col("n_group") + 2 * F.col("v")).alias("d"), "chunks")
    held = kept.join(ids, ["lang", "term"]).join(named, ["lang", "source"]).select("lang", "chunk", "g", "d", F.struct("id", "n").alias("e"))
    empty = named.select("lang", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "g", "d", F.lit(None).cast("struct<id:int,n:bigint>").alias("e"))
    packed = held.unionByName(empty).groupBy("lang", "chunk", "g").agg(F.max("d").alias("d"), F.collect_list("e").alias("counts"))
    sizes = ids.groupBy("lang", "chunk").agg((F.max("id") + 1).alias("size"))
    return packed.join(small(sizes), ["lang", "chunk"], "left").fillna(0, ["size"])


def shares(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (n + 2) / d), by long division in base 1000; exact for d below 9 * 10**15."""
    q, r = np.divmod(n + 2, d)
    for _ in range(3):
        r *= 1000
        q *= 1000
        q += r // d
        r %= d
    return q + 1


def tile(batches):
    """lang, a, b, value: sums of the divergence of groups a < b over a stripe, from vectors sorted by tile, stripe and chunk."""
    at = chunk = None
    rows: list = []
    sums: dict = {}

    def add():
        if rows and rows[0][3]:
            p = np.zeros((len(rows), rows[0][3]), np.int64)
            for i, (_, _, counts, _) in enumerate(rows):
                p[i, counts[0]] = counts[1]
            p = shares(p, np.array([[r[1]] for r in rows], np.int64))
        else:
            p = np.zeros((len(rows), 0), np.int64)
        g = np.array([r[0] for r in rows])
        left, right = np.flatnonzero(g // BLOCK == at[1]), np.flatnonzero(g // BLOCK == at[2])
        for i in left:
            js = right[right > i]
            if len(js):
                d, s = p[js] - p[i], p[js] + p[i]
                for j, v in zip(js, (d * d // s).sum(1), strict=True):
                    pair = int(g[i]), int(g[j])
                    sums[pair] = sums.get(pair, 0) + int(v)

    def send():
        if sums:
            a, b = zip(*sums, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([at[0]] * len(a)), pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(list(sums.values()), pa.int64())], ["lang", "a", "b", "value"])

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("lang", "i", "j", "stripe", "chunk", "g", "d", "size")]
        counts = batch.column("counts")
        for k, (lang, i, j, stripe, c, g, d, size) in enumerate(zip(*cols, strict=True)):
            if (lang, i, j, stripe, c) != (*(at or ()), chunk):
                if at is not None:
                    add()
                rows, chunk = [], c
                if (lang, i, j, stripe) != at:
                    yield from send()
                    at, sums = (lang, i, j, stripe), {}
            e = counts[k].values
            rows.append((g, d, (e.field("id").to_numpy(), e.field("n").to_numpy()), size))
    if at is not None:
        add()
        yield from send()


def pairs(packed: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b, value of every two groups a < b of a language."""
    blocks = F.ceil(F.col("groups") / BLOCK).cast("int")
    wide = packed.join(groups.select("lang", "g", "groups"), ["lang", "g"]).withColumn("own", F.floor(F.col("g") / BLOCK).cast("int"))
    wide = wide.select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    keys = ["lang", "i", "j", "stripe"]
    tiles = wide.select("lang", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.floor(F.col("chunk") / STRIPE).cast("int").alias("stripe"), "chunk", "g", "d", "size", "counts")
    found = tiles.repartition(*keys).sortWithinPartitions(*keys, "chunk", "g").mapInArrow(tile, "lang string, a int, b int, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def standing_out(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item (term), value, rank of the terms that a group uses more than its language, the `top` furthest."""
    share = lambda n, d: F.expr(f"1 + (CAST({n} + 2 AS DECIMAL(20, 0)) * {SCALE}BD) DIV CAST({d} + 2 * v AS DECIMAL(20, 0))")
    both = kept.join(groups.select("lang", "source", "n_group", "n_lang", "v"), ["lang", "source"]).withColumns({"p": share("n", "n_group"), "q": share("total", "n_lang")})
    over = both.where("n > 0 AND p > q").select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) DIV (p + q)").alias("value"))
    return over.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))).where(F.col("rank") <= top)


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank of docs (lang, source, text).

    Nulls are ''. Every group that occurs has a row for each other source of its language, one without terms too; a language without kept terms has values of 0. Ties go by the item's bytes. Repeated rows are documents of their own. No rows: no rows.
    """
    kept = cut(kept_terms(docs, least))
    groups = group_table(docs, kept)
    found = pairs(vectors(kept, groups), groups)
    both = found.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("g"), F.col("b").alias("h")), F.struct(F.col("b").alias("g"), F.col("a").alias("h")))).alias("e")).select("lang", "e.*", "value")
    name = lambda g, c: groups.select("lang", F.col("g").alias(g), F.col("source").alias(c))
    pair = both.join(name("g", "source"), ["lang", "g"]).join(name("h", "item"), ["lang", "h"])
    pair = pair.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))
    cols = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
    return cols(pair, "pair").unionByName(cols(standing_out(kept, groups, top), "term"))


ORACLE = f"""WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
u AS (SELECT rid, lang, source, unnest(ws) AS term FROM d),
k AS (SELECT lang, term FROM u GROUP BY lang, term HAVING count(DISTINCT rid) >= {LEAST_DOCS}),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM u JOIN k USING (lang, term) GROUP BY ALL),
vs AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
m AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS ng, v FROM g JOIN k USING (lang) JOIN vs USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, n, (1 + 1000000000::HUGEINT * (n + 2) // (ng + 2 * v))::BIGINT AS p,
  (1 + 1000000000::HUGEINT * (sum(n) OVER (PARTITION BY lang, term) + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * v))::BIGINT AS q FROM m),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT * FROM (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM f) WHERE part = 'pair' OR rank <= {TOP}"""
