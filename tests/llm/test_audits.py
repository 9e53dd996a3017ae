"""Licenses, divergence and manifest against brute force and SQL, on awkward rows: nulls, blanks, ties, repeats, long texts, clashing names, empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from loomspan.llm import divergence, licenses, manifest

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, label string, n int, key int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    some = "alpha beta GAMMA Delta été ÉTÉ straße x9y 日本 license gnu public".split()
    out = []
    for i in range(400):
        lang = rng.choice(["en", "en", "de", "", None, "fr"])
        source = rng.choice(["hot", "hot", "hot", None, "", *[f"s{k}" for k in range(60)]])
        out.append((i, " ".join(rng.choice(some) for _ in range(rng.randrange(0, 40))), lang, source, rng.choice([None, 5, 2**63 - 1])))
    notices = [t.text for t in licenses.TEMPLATES] + ["MIT License mit license MIT-LICENSE", "the Apache License; Version 2.0", "CC BY", "GNU General Public", "gnu general  public\nlicense"]
    for i, t in enumerate(notices):
        words = t.split()
        out.append((1000 + i, f"Some. {t.upper()}!", "en", "hot", 1))
        out.append((1100 + i, " ".join(w for j, w in enumerate(words) if j != 1), "en", "lone", 1))
        out.append((1200 + i, " ".join([*words[:3], "inserted", *words[3:], *words]), "it", "s1", 1))
    out += [(None, None, None, None, None), (None, "a b c", "en", "hot", 3), (5, "tie", "en", "hot", 3), (5, "tie", "en", "hot", 3), (5, "another tie", "en", "hot", 3)]
    out += [(3000 + i, None if i % 2 else "", "xx", f"e{i}", 0) for i in range(5)]
    out += [(4000, "long " * 60_000 + "released under the MIT license. " * 3000, "en", "hot", 0), (4001, "one", "zz", "only", 0)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "grp", "label", 7, 8) for r in rows], SCHEMA).repartition(6).persist()


def brute_licenses(text, rare):
    words = WORD.findall((text or "").translate(UPPER))
    at = lambda p, i: words[i : i + len(p)] == p
    base = [(i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if at(p.split(), i)]
    starts = Counter((t, i - p) for i, w in enumerate(words) for t, p in rare.get(w, []))
    found = []
    for (t, a), n in starts.items():
        own, ok = licenses.TEMPLATES[t].text.split(), n >= licenses.NEED
        for phrase in licenses.TEMPLATES[t].phrases:
            k = phrase.split()
            place = next(j for j in range(len(own)) if own[j : j + len(k)] == k)
            ok = ok and any(at(k, i) for i in range(max(0, a + place - licenses.SLACK), a + place + licenses.SLACK + 1))
        if ok:
            found.append((licenses.TEMPLATES[t].label, sum(0 <= a + j < len(words) and words[a + j] == w for j, w in enumerate(own)) / len(own)))
    score = max([s for _, s in found] + [licenses.BASE_SCORE if base else 0.0])
    i = [x for x, _ in base]
    join = lambda xs: ",".join(sorted(set(xs)))
    return len(words), len(base), min(i, default=None), max(i, default=None), join(x for _, x in base), join([*(x for _, x in base), *(x for x, _ in found)]), score


def test_licenses(docs, rows):
    df = Counter(w for r in rows for w in set(WORD.findall((r[1] or "").translate(UPPER))))
    rare = licenses.index(licenses.TEMPLATES, df)
    assert all(len({w for w, ps in rare.items() for t, _ in ps if t == k}) == licenses.ANCHORS for k in range(len(licenses.TEMPLATES)))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = sorted((tuple(r) for r in licenses.scan(docs).collect()), key=key)
    want = sorted(((r[0], *brute_licenses(r[1], rare)) for r in rows), key=key)
    assert got == want
    by = {r[0]: r for r in got}
    for i, t in enumerate(licenses.TEMPLATES):
        assert t.label in by[1000 + i][6].split(",") and by[1000 + i][7] == 1.0
    free = [i for i, ps in enumerate(licenses.places(licenses.TEMPLATES)) if all(not p <= 1 < p + len(x.split()) for x, p in ps)]
    assert len(free) > 12 and all(licenses.TEMPLATES[i].label in by[1100 + i][6].split(",") for i in free)  # the second word missing


def brute_divergence(rows, least, top):
    count, held, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(UPPER))
        groups[lang].add(source)
        count[lang, source].update(terms)
        held[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= least]
        n = {s: sum(count[lang, s][t] for t in kept) for s in sources}
        share = lambda c, d: 1 + 10**9 * (c + 2) // (d + 2 * len(kept))  # noqa: B023, E731
        p = {s: {t: share(count[lang, s][t], n[s]) for t in kept} for s in sources}
        q = {t: share(sum(count[lang, s][t] for s in sources), sum(n.values())) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pair = sorted(((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s))
            term = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if count[lang, s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, x.decode(), -v, i + 1) for part, found in (("pair", pair), ("term", term)) for i, (v, x) in enumerate(found)]
    return sorted(out)


def test_divergence(docs, rows, monkeypatch):
    for chunk, stripe, block, held in ((4096, 16, 32, 300_000), (3, 2, 7, 5)):
        for name, value in (("CHUNK", chunk), ("STRIPE", stripe), ("BLOCK", block), ("HELD", held)):
            monkeypatch.setattr(divergence, name, value)
        assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == brute_divergence(rows, 10, 10)


def test_shares_are_exact():
    import numpy as np

    rng = random.Random(3)
    for _ in range(300):
        d = rng.randrange(1, 10 ** rng.randrange(1, 16))
        n = rng.randrange(-2, d - 1)
        assert divergence.shares(np.array([n]), np.array([d]))[0] == 1 + 10**9 * (n + 2) // d


def h(*xs):
    return hashlib.sha256("".join(xs).encode()).hexdigest()


def brute_manifest(rows):
    def leaf(r, grown=0):
        n = r[4] if r[4] is None else r[4] + grown
        return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (r[0], r[3], r[2], n, r[1])))

    def tree(nodes):
        """(top, proof of each node: (before, after) for each level)."""
        proofs, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, i in enumerate(at):
                run = nodes[i // 2 * 2 : i // 2 * 2 + 2]
                proofs[k].append((run[: i % 2], run[i % 2 + 1 :]))
            nodes, at = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)], [i // 2 for i in at]
        return nodes[0], proofs

    langs = defaultdict(list)
    for r in rows:
        langs[r[2]].append(r)
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang, own in langs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = tree([leaf(r) for r in own])
    root, tops = tree([trees[x][0] for x in names])
    out = []
    for lang, top in zip(names, tops, strict=True):
        for r, proof in zip(langs[lang], trees[lang][1], strict=True):
            way = proof + top
            at = leaf(r, 1) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else leaf(r)
            for before, after in way:
                at = h(*before, at, *after)
            out.append((r[0], leaf(r), trees[lang][0], root, h(*(x for s in way for side in s for x in side)), at, at == root))
    return out


def test_manifest(docs, rows):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got, want = (sorted(x, key=key) for x in ([tuple(r) for r in manifest.audit(docs).collect()], brute_manifest(rows)))
    assert got == want and 0 < sum(not r[-1] for r in got) < len(got)
    for some in (rows[:1], rows[:2], [r for r in rows if r[2] == "de"]):
        got = [tuple(r) for r in manifest.audit(docs.sparkSession.createDataFrame([(*r, "", "", 0, 0) for r in some], SCHEMA)).collect()]
        assert sorted(got, key=key) == sorted(brute_manifest(some), key=key)


@pytest.mark.parametrize("f", [licenses.scan, divergence.audit, manifest.audit])
def test_empty(spark, docs, f):
    assert f(spark.createDataFrame([], docs.schema)).collect() == []


@pytest.mark.parametrize(("f", "sql"), [(licenses.scan, licenses.oracle()), (divergence.audit, divergence.ORACLE), (manifest.audit, manifest.ORACLE)])
def test_sql(spark, tmp_path, docs, f, sql):
    c = duckdb.connect()
    docs.coalesce(1).write.parquet(f"{tmp_path}/d")
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    for name in ("rows", None):
        if name is None:
            c.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
            df = f(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
        else:
            df = f(docs)
        assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, c.sql(f"SELECT {', '.join(df.columns)} FROM ({sql})").fetchall()))
