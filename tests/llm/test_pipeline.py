"""The pipeline's stages against each other and against brute force where that is short."""

import random
import time
from pathlib import Path

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loomspan.llm import pii, quality, similar, suffix
from loomspan.llm.components import components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out.append(docs.collect())
    return out


def test_columns_and_rows(stages):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(list(x[0].asDict()) == names for x in stages[:-1])
    ids = [[r.doc_id for r in x] for x in stages]
    for before, after in zip(ids, ids[1:-1], strict=False):
        assert set(after) <= set(before) and len(set(after)) == len(after)
    assert set(ids[-1]) == set(ids[-2])
    assert len(ids[0]) > len(ids[1]) > len(ids[2]) >= len(ids[3]) == len(ids[4]) > 50


def test_decisions_take_effect(spark, stages):
    kept = {r.doc_id for r in quality.judge(spark.createDataFrame(stages[0])).where("kept").collect()}
    assert {r.doc_id for r in stages[1]} == kept
    left = {r.doc_id: r.n_bytes - r.n_removed for r in suffix.deduplicate(spark.createDataFrame(stages[2])).collect()}
    assert all(len(r.text.encode()) >= left[r.doc_id] for r in stages[3]) and sum(len(r.text) for r in stages[3]) < sum(len(r.text) for r in stages[2])
    anchors = pii.automaton()
    assert any("<" in r.text for r in stages[4]) and not any(k < 4 for r in stages[4] for _, k, _ in pii.find(r.text, anchors))


@pytest.mark.parametrize("hot", [2048, 4])
def test_near_dup_is_the_join(spark, monkeypatch, hot):
    """The stage keeps the least id of each component of a brute-force join at 0.8, edited copies of 0.8 to 0.95 and large groups among them."""
    monkeypatch.setattr(similar, "HOT", hot)
    rng = random.Random(11)
    rows, passage = [], [f"p{i}" for i in range(30)]
    for g in range(30):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 12, 60, 150]))] + passage * (g % 2)
        for _ in range(40 if g == 0 else 5):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            rows.append(" ".join(copy))
    rows += ["", None, " \n", "One Two  three", "one two three"]
    rng.shuffle(rows)

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    have, root = [shingles(t) for t in rows], list(range(len(rows)))
    shares = []
    for i, a in enumerate(have):
        for j in range(i):
            share = len(a & have[j]) / len(a | have[j]) if a | have[j] else 1
            if share >= 0.8:
                shares.append(share)
                x, y = sorted((root[i], root[j]))
                root = [x if r == y else r for r in root]
    assert sum(s < 0.95 for s in shares) > 20
    docs = spark.createDataFrame([(i, t, "en", "src", 0) for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = {r.doc_id for r in corpus_pipeline.near_dup_stage(spark, docs, SF).collect()}
    assert got == set(root)


def test_near_dup_of_a_large_group(spark):
    """2,000 edited copies of one text, most of them less than 0.8 alike, and planted copies of 0.80 to 0.95: every link of a brute-force join is found, so recall is 1."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(2000):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 3, 4, 6])):
            copy[rng.randrange(len(copy))] = f"x{i}y{rng.randrange(10**6)}"
        rows.append(" ".join(copy))
    planted = []
    for i in range(300):
        words = [f"p{i}w{j}" for j in range(100)]
        copy = words[: rng.randrange(87, 99)] + [f"q{i}w{j}" for j in range(2)]
        planted.append((len(rows), len(rows) + 1))
        rows += [" ".join(words), " ".join(copy)]
    ids: dict = {}
    sets = [sorted({ids.setdefault(tuple(w[i : i + 5]), len(ids)) for i in range(len(w) - 4)}) for w in map(str.split, rows)]
    n = np.array([len(x) for x in sets])
    shared = np.zeros((len(rows), len(rows)), np.int32)
    for lo in range(0, len(ids), 8192):
        has = np.zeros((len(rows), 8192), np.float32)
        for i, x in enumerate(sets):
            has[i, [k - lo for k in x if lo <= k < lo + 8192]] = 1
        shared += (has @ has.T).astype(np.int32)
    alike = 5 * shared >= 4 * (n[:, None] + n[None, :] - shared)
    root = np.arange(len(rows))
    while True:
        low = np.where(alike, root[None, :], len(rows)).min(1)
        if (low == root).all():
            break
        root = low
    share = np.array([shared[a, b] / (n[a] + n[b] - shared[a, b]) for a, b in planted])
    assert ((share >= 0.8) & (share < 0.95)).sum() > 200 and len(set(root[:2000])) > 5
    docs = spark.createDataFrame([(i, t, "en", "src", 0) for i, t in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    assert {r.doc_id for r in corpus_pipeline.near_dup_stage(spark, docs, SF).collect()} == set(root.tolist())


def test_near_dup_compares_few_pairs_of_a_large_group(spark, monkeypatch):
    """Of 500 edited copies of one text, nearly all pairs of them 0.8 alike, few more pairs than copies are compared by whole sets."""
    monkeypatch.setattr(similar, "close", lambda rows: rows.select(F.col("s").alias("a"), F.col("s").alias("b")).limit(0))
    whole, sent = similar.similar, []
    monkeypatch.setattr(similar, "similar", lambda pairs, *rest: (sent.append(pairs.count()), whole(pairs, *rest))[1])
    monkeypatch.setattr(similar, "ROUNDS", 0)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(500):
        copy = list(base)
        for _ in range(3):
            copy[rng.randrange(200)] = f"x{i}y{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy), "en", "src", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    assert [r.doc_id for r in corpus_pipeline.near_dup_stage(spark, docs, SF).collect()] == [0]
    assert sum(sent) <= 5 * len(rows), sent


def test_near_dup_sends_the_driver_a_table_of_fixed_size(spark, monkeypatch):
    """However many shingles texts have in common, the driver gets SLOTS bytes, no rows of shingles; those held twice come late in a prefix."""
    monkeypatch.setattr(similar, "SLOTS", 1 << 17)
    sizes = []
    for n in (200, 40_000):
        words = [f"w{i}" for i in range(n)]
        texts = [" ".join(words + [f"x{k}y{i}" for i in range(n)]) for k in range(2)]
        docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "h long, text string")
        late = similar.order(docs)
        sizes.append(late.value.nbytes)
        often, once = (next(similar.shingles(pa.RecordBatch.from_pydict({"text": [" ".join(x)]}))) for x in (words, [f"x0y{i}" for i in range(n)]))
        first = set(similar.prefix_of(np.unique(np.concatenate([often, once])), late.value).tolist())
        slots = {int(x) % (1 << 17) for x in often}
        assert {int(x) % (1 << 17) for x in np.flatnonzero(late.value == 2)} == slots
        assert n > 200 or (first <= set(once.tolist()) and len(first) > 70)
    assert sizes == [1 << 17, 1 << 17]


@pytest.mark.parametrize("slots", [1 << 4, 1 << 10])
def test_near_dup_with_few_slots(spark, monkeypatch, slots):
    """Any order of shingles finds the same: with nearly all shingles in common slots the kept rows are those of the join."""
    monkeypatch.setattr(similar, "SLOTS", slots)
    test_near_dup_is_the_join(spark, monkeypatch, 2048)


@pytest.mark.parametrize("alone", [0, 3, 1000])
def test_components_alone(spark, alone):
    """Graphs in one partition and graphs dealt out have the same components."""
    edges = spark.createDataFrame([(1, 2), (3, 2), (9, 7), (7, 7), (5, 4), (4, 6), (3, 8), (8, 1)], "a long, b long").repartition(4)
    got = components(edges, alone=alone)
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 4), (7, 7), (8, 1), (9, 7)]


def test_near_dup_leaves_no_shuffle_files(spark):
    """The stage's rounds take disk one after another: when its rows are ready to be read, no shuffle file of its jobs is left."""

    def files():
        return {p.name for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs() for p in Path(d.toString()).rglob("shuffle_*")}

    docs = spark.createDataFrame([(i, " ".join(f"w{i // 2 * 7 + j}" for j in range(20 + i % 2)), "en", "src", 0) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long").repartition(4).localCheckpoint()
    before = files()
    kept, end = corpus_pipeline.near_dup_stage(spark, docs, SF), time.time() + 10
    while (left := files() - before) and time.time() < end:  # they are removed in the background
        time.sleep(0.1)
    assert not left, len(left)
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 40, 2))


def test_components_merged(spark):
    """Roots of edges that come in turns are those of all edges at once."""
    rng = random.Random(3)
    turns = [[(rng.randrange(300), rng.randrange(300)) for _ in range(n)] for n in (60, 0, 40, 80)]
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long").repartition(4)
    roots = components(frame(turns[0]))
    for edges in turns[1:]:
        roots = similar.merged(roots, frame(edges))
    got = {r.node: r.root for r in roots.collect()}
    assert got == {r.node: r.root for r in components(frame(sum(turns, []))).collect()} and roots.count() == len(got)


def test_stages_take_awkward_tables(spark):
    """Each stage on an empty table, and on null ids, null texts, repeated rows and columns with clashing names: it doesn't fail and keeps the columns."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _host string, _w int, _lines int, h int, doc int, bin int"
    text = "one plain sentence of several words that a reader would keep as it stands, " * 3
    rows = [(i, f"{text} {i} {'tail words ' * (i % 3)}end", "en", "s", 0, "a", 1, 2, 3, 4, 5) for i in range(12)]
    rows += [(None, None, None, None, None, None, None, None, None, None, None), (None, text, None, None, None, "b", 1, 2, 3, 4, 5), (3, rows[3][1], "en", "s", 0, "a", 1, 2, 3, 4, 5), (99, "", "en", "s", 0, "a", 1, 2, 3, 4, 5)]
    for some in ([], rows):
        docs = spark.createDataFrame(some, schema)
        for name, f in corpus_pipeline.STAGES:
            out = f(spark, docs, SF)
            assert name == "packing" or out.columns == docs.columns
            assert len(out.collect()) > 0 or not some or name == "quality"


def test_run(spark, stages):
    got = {(r.doc_id, r.piece, r.size) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == {(r.doc_id, r.piece, r.size) for r in stages[5]}
