"""Each operator against a brute-force version, on driver rows and on awkward ones."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loomspan.llm import bpe, lm, packing, pii, quality, shard, similar, simhash, sketch, suffix, warc

SF = "/root/testdata/sf0.01"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LONG = "lorem ipsum " * 3000


@pytest.fixture(scope="module")
def docs(spark):
    """Rows of documents beside nulls, blanks, ties, repeats, one very long text, and columns with names the operators use."""
    some = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(150).collect()]
    odd = [(90001, None, None, None, None), (90002, "", "en", "src0", 0), (90003, " \t\n", "en", "src0", 3), (90004, LONG, "en", "hot", len(LONG)), (90005, "é😀ñ" * 60, "fr", "hot", 180)]
    odd += [(90010 + i, "one hot text that is repeated over and over, " * 4, "en", "hot", 180) for i in range(40)]
    rows = [(*r, "clash", 7) for r in [*some, *odd]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard string, n int").repartition(5, "doc_id").persist()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def test_empty_tables(spark, docs):
    import public_tokenizers as p

    none = spark.createDataFrame([], docs.schema)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    clusters = spark.createDataFrame([], "doc_id long, cluster long")
    every = (
        lambda d: lm.score(d), simhash.near_duplicates, lambda d: pii.digest(pii.scan(d)), packing.pack, lambda d: packing.pack(d, clusters=clusters), lambda d: shard.shard_documents(d, [1.0] * 3), quality.judge, suffix.deduplicate, sketch.fingerprints,
        pii.redact, suffix.strip, quality.keep, similar.keep_first, lambda d: bpe.round_trip(d, p.path("byte_bpe_50k.tiktoken"), p.PATTERN),
    )
    for f in every:
        assert f(none).collect() == []
    assert packing.fill(packing.pack(none)).first().bins == 0
    assert warc.round_trip(pages).collect() == []


def test_lm(docs, texts):
    got = {r.doc_id: r for r in lm.score(docs).collect()}
    words = {d: WORD.findall(t.encode().lower()) for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in texts}
    c = Counter(w for d in texts if not held[d] for w in [*words[d], b"\n"])
    n, v = sum(c.values()), len(c)
    assert set(got) == set(texts)
    for d, t in texts.items():
        every = [*words[d], b"\n"]
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in every)
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(every), sum(c[w] > 0 for w in every), n)
        assert r.base_score == pytest.approx(base, abs=1e-6)
        assert r.score < 0
    size = sum(len(t.encode()) for d, t in texts.items() if held[d])
    assert -sum(got[d].score for d in texts if held[d]) * math.log2(10) / size < 4  # bits a byte, of texts not seen


def naive_ctw(texts, train, depth):
    """log10 probability of each text by a tree of dicts, one node at a time."""
    from functools import cache

    def steps(t):
        data = bytes(depth) + bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode()) + b"\0"
        for i in range(depth, len(data)):
            for b in range(8):
                yield data[i - depth : i], (1 << b) | (data[i] >> (8 - b)), data[i] >> (7 - b) & 1

    count = {}
    for t, learn in zip(texts, train, strict=True):
        for context, bits, bit in steps(t) if learn else ():
            for d in range(depth + 1):
                count.setdefault((context[depth - d :], bits), [0, 0])[bit] += 1
    below = {}
    for context, bits in count:
        if context:
            below.setdefault((context[1:], bits), []).append((context, bits))

    def kt(n):
        return math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.log(math.pi) - math.lgamma(sum(n) + 1)

    @cache
    def both(node):
        own = kt(count[node])
        if len(node[0]) == depth:
            return own
        child = sum(map(both, below[node]))
        top = max(own, child)
        return top + math.log(math.exp(own - top) + math.exp(child - top)) - math.log(2)

    def log10(t):
        out = 0.0
        for context, bits, bit in steps(t):
            p = None
            for d in range(depth, -1, -1):
                node = context[depth - d :], bits
                if node in count:
                    own = (count[node][1] + 0.5) / (sum(count[node]) + 1)
                    w = math.exp(kt(count[node]) - math.log(2) - both(node))
                    p = own if p is None else w * own + (1 - w) * p
            p = 0.5 if p is None else p
            out += math.log10(p if bit else 1 - p)
        return out

    return [log10(t) for t in texts]


@pytest.mark.parametrize(("depth", "tiny"), [(3, False), (4, True), (5, True)])
def test_lm_is_context_tree_weighting(docs, texts, monkeypatch, depth, tiny):
    """Scores equal a tree that is built node by node, with few buckets and with many, each answering in several parts."""
    if tiny:
        for name, value in (("BUCKET_UNIT", 100), ("ANSWERS", 200)):
            monkeypatch.setattr(lm, name, value)
    some = docs.where("doc_id > 90000 OR doc_id % 5 = 0").where("doc_id <> 90004")
    ids = [r.doc_id for r in some.select("doc_id").collect()]
    want = naive_ctw([texts[d][:900] for d in ids], [zlib.crc32(str(d).encode()) % 5 != 1 for d in ids], depth)
    got = {r.doc_id: r for r in lm.score(some.withColumn("text", F.substring("text", 1, 900)), depth).collect()}
    for d, w in zip(ids, want, strict=True):
        assert got[d].score == pytest.approx(w, rel=1e-5)
        assert got[d].bits_per_byte == pytest.approx(-w * math.log2(10) / (len(texts[d][:900].encode()) + 1), rel=1e-5)


def test_lm_slices(monkeypatch):
    """A bucket's probabilities don't depend on how many nodes are weighed at a time, and those of all bytes add up to one."""
    import numpy as np

    rng = np.random.default_rng(3)
    k = np.unique(rng.integers(97, 101, (3000, 6)) @ (256 ** np.arange(5, -1, -1)).astype(np.int64)).astype(np.uint64)
    k = np.unique(np.concatenate([k, ((k[:1] >> np.uint64(8)) << np.uint64(8)) | np.arange(256, dtype=np.uint64)]))
    n = rng.integers(0, 4, len(k))
    none = [np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)], lm.top_levels([])
    whole = lm.log10_of(k, n, 5, *none)
    monkeypatch.setattr(lm, "SLICE", 7)
    assert np.allclose(whole, lm.log10_of(k, n, 5, *none), atol=1e-12)
    assert (10 ** whole[k >> np.uint64(8) == k[0] >> np.uint64(8)]).sum() == pytest.approx(1)


def test_lm_without_training_rows(spark):
    got = lm.score(spark.createDataFrame([(i, "ab") for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1], "doc_id long, text string")).collect()
    assert got and all(r.held_out and r.train_tokens == 0 and r.score == pytest.approx(-24 * math.log10(2)) for r in got)


def test_lm_block_probability():
    import numpy as np

    for a, b in ((0, 0), (1, 0), (3, 2), (40, 1)):
        p, n0, n1 = 1.0, 0, 0
        for x in [0] * a + [1] * b:
            p *= ((n1 if x else n0) + 0.5) / (n0 + n1 + 1)
            n0, n1 = n0 + (1 - x), n1 + x
        assert lm.kt_block(np.array([float(a)]), np.array([float(b)]))[0] == pytest.approx(math.log(p), abs=1e-10)


def fingerprint(text):
    import xxhash

    w = WORD.findall(text.encode().lower())
    s = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def reach(prints):
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in ids}


def test_simhash(docs, texts):
    prints = {d: fingerprint(t) for d, t in texts.items()}
    want = reach(prints)
    for r in simhash.near_duplicates(docs).collect():
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", want[r.doc_id])


@pytest.mark.parametrize("hot", [4096, 3])
def test_simhash_links(spark, hot):
    """Chains of fingerprints up to 4 bits apart, many under one key; hot=3 deals them to chunk pairs."""
    rng = random.Random(1)
    prints = {}
    for c in range(12):
        x = rng.getrandbits(64)
        for i in range(rng.randint(1, 40)):
            prints[c * 100 + i] = x
            for b in rng.sample(range(64), rng.choice([1, 2, 4, 5])):
                x ^= 1 << b
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(d, signed(x)) for d, x in prints.items()], "doc_id long, print long")
    classes = df.groupBy("print").agg({"doc_id": "min"}).collect()
    from loomspan.llm.components import components

    roots = {r.node: r.root for r in components(simhash.links(df, hot=hot)).collect()}
    least, want = {}, reach(prints)
    for p, d in classes:
        least[roots.get(p, p)] = min(least.get(roots.get(p, p), d), d)
    assert {d: least[roots.get(signed(x), signed(x))] for d, x in prints.items()} == want


def test_golay_keys():
    import numpy as np

    error, unit = simhash.decoding_tables()
    words = np.random.default_rng(1).integers(0, 1 << 23, 5000)
    code = words ^ error[simhash.syndromes(words)]
    assert (simhash.syndromes(code) == 0).all() and np.bitwise_count(code ^ words).max() <= 3
    rng = random.Random(2)
    for d in range(5):
        a = np.array([rng.getrandbits(64) for _ in range(500)], np.uint64)
        b = np.array([int(x) ^ sum(1 << i for i in rng.sample(range(64), d)) for x in a], np.uint64)
        ka, kb = [{} for _ in a], [{} for _ in b]
        for out, (key, _, row) in ((ka, simhash.keys_of(a)), (kb, simhash.keys_of(b))):
            for k, r in zip(key.tolist(), row.tolist(), strict=True):
                out[r][k] = 1
        assert all(x.keys() & y.keys() for x, y in zip(ka, kb, strict=True))


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (14 <= len(digits) <= 19 and pii.luhn(digits)) or kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii(docs, texts):
    rows = pii.digest(pii.scan(docs)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = base_spans(texts[r.doc_id])
        line = ",".join(f"{list(BASE)[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_pii_random():
    rng, anchors = random.Random(3), pii.automaton()
    for _ in range(20000):
        t = "".join(rng.choice("ab@@..+-- 0123456789()%é4") for _ in range(rng.randint(0, 80)))
        assert [s for s in pii.find(t, anchors) if s[1] < 4] == base_spans(t)


def test_pii_added_and_mask():
    a = pii.automaton()
    t = 'pay GB82 WEST 1234 5698 7654 32 now, token = "abc123def456", ssn 123-45-6789, ftp://me:pw@host.org/x and a@b.co'
    assert {pii.KINDS[k]: t[x:y] for x, k, y in pii.find(t, a)} == {"iban": "GB82 WEST 1234 5698 7654 32", "secret": "abc123def456", "ssn": "123-45-6789", "url": "ftp://me:pw@host.org", "email": "a@b.co"} | ({"email": "a@b.co"})
    assert pii.mask("x a@b.co y", [(2, 0, 8)]) == "x <EMAIL> y"
    assert pii.find("a quiet text about tokens: nothing here, 12 of 2019", a) == []


def test_redact(docs, texts):
    for r in pii.redact(docs).collect():
        if texts[r.doc_id]:
            assert base_spans(r.text) == [] and r.n_chars == len(r.text)


def brute_best_fit(pieces, capacity):
    bins, out = [], []
    for size, s, c in pieces:
        fit = [(b["left"], i) for i, b in enumerate(bins) if b["left"] >= size and s not in b["s"] and c not in b["c"]]
        if not fit:
            bins.append({"left": capacity, "s": set(), "c": set()})
            fit = [(capacity, len(bins) - 1)]
        left, i = min(fit)
        out.append((i, capacity - left))
        bins[i]["left"] -= size
        bins[i]["s"] |= {s} - {None}
        bins[i]["c"] |= {c} - {None}
    return out


def test_best_fit():
    rng = random.Random(4)
    for _ in range(100):
        pieces = [(rng.randint(0, 100), rng.choice([None, *range(5)]), rng.choice([None, *range(8)])) for _ in range(rng.randint(0, 80))]
        assert packing.best_fit(pieces, 100) == brute_best_fit(pieces, 100)


def test_pack(docs, texts):
    rows = packing.pack(docs, capacity=2048, group_bins=16).collect()
    whole, bins = Counter(), {}
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    for r in rows:
        whole[r.doc_id] += r.size
        bins.setdefault(r.bin, []).append(r)
    assert {d: whole[d] for d in texts} == {d: len(t.encode()) for d, t in texts.items()}
    for members in bins.values():
        spans = sorted((r["at"], r["at"] + r["size"]) for r in members)
        assert spans[-1][1] <= 2048 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
        named = [source[r.doc_id] for r in members if source[r.doc_id]]
        assert len(named) == len(set(named))
        clusters = [c for r in members if (c := " ".join(texts[r.doc_id].lower().split()))]
        assert len(clusters) == len(set(clusters))


def test_pack_fills(spark):
    """Bins of whole documents of many sources are filled, and rows without an id, or of one, don't make one large group."""
    rng = random.Random(10)
    rows = [(i if i % 3 else None, "x" * rng.randint(0, 3000), f"s{rng.randrange(400)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = packing.pack(df, group_bins=64)
    f = packing.fill(out).first()
    assert f.bytes == sum(len(r[1]) for r in rows) and f.filled > 0.95 and f.fewest <= f.bins
    sizes = Counter(r.bin.rpartition("-")[0] for r in out.collect())
    assert max(sizes.values()) < 3 * len(rows) / len(sizes)
    blank = packing.pack(spark.createDataFrame([(i, [None, "", " "][i % 3], None) for i in range(300)], "doc_id long, text string, source string"))
    assert blank.count() == 300 and blank.select("bin").distinct().count() == 1


def test_shard(spark, docs, texts):
    rows = shard.shard_documents(docs, [1.0] * 7).collect()
    slots = {}
    for r in rows:
        raw = texts[r.doc_id].encode()
        w = [-1 / math.log((int(hashlib.md5(f"{r.doc_id}:{s}".encode()).hexdigest()[:15], 16) + 0.5) / 2**60) for s in range(8)]
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 16, zlib.crc32(raw), "key")
        assert r.shard == w.index(max(w[:7])) and r.grown_shard == w.index(max(w))
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    n = Counter(r.shard for r in shard.assign(spark.range(20000), "id", [1.0, 3.0]).collect())
    assert n[1] / n[0] == pytest.approx(3, rel=0.1)


def test_quality(docs, texts):
    for r in quality.judge(docs).collect():
        t = texts[r.doc_id]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        hit = {i + j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(5)}
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 10 or 100 * len(hit) > 20 * len(w))
        assert r.kept <= (not r.base_failed) and (r.base_failed or r.n_soft_failures or r.kept)


def test_quality_keep(docs):
    kept = {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    rows = quality.keep(docs)
    assert rows.columns == docs.columns and {r.doc_id for r in rows.collect()} == kept and len(kept) > 50


def test_quality_hosts(spark):
    """A poor host's documents may fail no soft rule; the prior pulls a small host to the corpus."""
    good, soft = "a plain text of more than ten words that fails no rule here", "## $$ %% && a text of ten words with many ## signs $$ in it"
    rows = [(i, good, "fine") for i in range(200)] + [(1000 + i, soft, "poor") for i in range(200)] + [(2000, soft, "small"), (2001, good, "poor"), (2002, soft, "fine")]
    got = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0].kept and got[2002].kept and got[2001].kept and not got[1000].kept
    assert 0.4 < got[2000].host_rate < 1


def test_warc(spark):
    rows = [(i, f"http://{'a.' * (i % 3)}site{i % 4}.example/{i % 7}?q={i}", ["same", "pages", f"own {i}", "", None][i % 5]) for i in range(60)]
    rows += [(None, None, "same"), (3, "http://site3.example/3?q=3", "own x"), (3, "http://site3.example/3?q=3", "own x"), (99, "http://[bad", "é" * 50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    largest = {}
    for p, _, h in rows:
        largest[h or ""] = max(largest.get(h or "", -1), -1 if p is None else p)
    want = Counter()
    for p, _, h in rows:
        raw = (h or "").encode()
        first = largest[h or ""]
        mine = p == first or sum((x[2] or "") == (h or "") for x in rows) == 1
        want[p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if mine else "revisit", None if mine else first] += 1
    folder, directory = warc.write(pages)
    back = warc.read(spark, folder, directory, pages)
    assert Counter(tuple(r) for r in back.drop("payload").collect()) == want
    for u in (rows[7][1], rows[-2][1], None, "http://[bad", "http://nowhere.example/"):
        found = warc.read(spark, folder, directory, spark.createDataFrame([(u,)], "url string")).collect()
        assert Counter(x.page_id for x in found) == Counter(y[0] for y in rows if y[1] == u)
        assert all(bytes(x.payload) in [b"", *((y[2] or "").encode() for y in rows if y[1] == u)] for x in found)


def test_warc_key_of_many_blocks(spark, monkeypatch):
    """A URL whose captures fill blocks and segments is found whole, and so are its neighbours."""
    monkeypatch.setattr(warc, "BLOCK", 4)
    rows = [(i, "http://m.example/" if i % 3 else f"http://{'abcxyz'[i % 6]}{i % 5}.example/", f"page {i}") for i in range(150)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder, directory = warc.write(pages)
    got = Counter(r.page_id for r in warc.read(spark, folder, directory, pages).collect())
    assert got == Counter(r[0] for r in rows)


def test_urls_keys():
    assert warc.url_key("http://a.b.Example.com:80/x?y") == "com,example,b,a:80)/x?y"


def test_bpe(docs, texts):
    import public_tokenizers as p
    import tiktoken

    ranks = bpe.load(p.path("byte_bpe_50k.tiktoken"))
    ours = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.round_trip(docs, p.path("byte_bpe_50k.tiktoken"), p.PATTERN).collect():
        ids = ours.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    rng = random.Random(5)
    for _ in range(300):
        piece = "".join(rng.choice("abcé the") for _ in range(rng.randint(1, 200)))
        assert bpe.Codec(ranks, p.PATTERN).encode(piece) == ours.encode_ordinary(piece)
    assert len(bpe.merge(b"a" * 100_000, ranks)) > 0
    encoded = bpe.encode(docs, p.path("byte_bpe_50k.tiktoken"), p.PATTERN)
    assert {r.doc_id: bytes(r.data).decode() for r in bpe.decode(encoded, p.path("byte_bpe_50k.tiktoken")).collect()} == texts


def covered(texts, length):
    seen, out = set(), {}
    for d in sorted(texts):
        raw = texts[d].encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            w = raw[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            else:
                seen.add(w)
        out[d] = gone
    return out


def test_suffix(docs, texts):
    gone = covered(texts, 100)
    for r in suffix.deduplicate(docs).collect():
        raw, g = texts[r.doc_id].encode(), gone[r.doc_id]
        left = bytes(b for b, x in zip(raw, g, strict=True) if not x)
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(raw), sum(g), len(re.findall(b"\1+", bytes(g))))
        assert r.kept_sha256 == hashlib.sha256(left).hexdigest()


def test_suffix_random(spark):
    rng = random.Random(6)
    base = "".join(rng.choice("abc é") for _ in range(400))
    texts = {}
    for d in range(80):
        t = ""
        for _ in range(rng.randint(0, 6)):
            a = rng.randint(0, 380)
            t += rng.choice([base[a : a + rng.randint(1, 90)], "ab" * rng.randint(1, 40), "".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 50)))])
        texts[d * 3] = t
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    gone = covered(texts, 20)
    for r in suffix.deduplicate(df, length=20, k=8).collect():
        assert r.n_removed == sum(gone[r.doc_id])
    for crowd in (1, 3):  # crowded anchors go by their windows
        got = {r.doc_id: r.ranges for r in suffix.repeats(suffix.keyed(df), length=20, k=8, crowd=crowd).collect()}
        for d, g in gone.items():
            assert sum(x.b - x.a for x in got[d] or ()) == sum(g)


def test_suffix_election_is_the_window_s():
    """Segments' anchors don't depend on what else is in a chunk, nor on its size."""
    import numpy as np

    rng = random.Random(12)
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randint(100, 900))).encode() for _ in range(60)]

    def found(some, chunk):
        data, off = np.frombuffer(b"".join(some), np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in some])))
        out = Counter()
        for lo, hi in suffix.spans_of(off, chunk):
            a, h, row, at, n, o = suffix.segments(data, off, lo, hi, 100, 40, suffix.powers(1 << 20))
            out.update(zip(a.tolist(), h.tolist(), [some[r] for r in row], at.tolist(), n.tolist(), o.tolist(), strict=True))
        return out

    assert found(texts, 1 << 20) == found(texts[::-1], 1000) == sum((found([t], 1) for t in texts), Counter())


def test_suffix_rows_of_one_id(spark):
    """Texts under one id, or without one, are documents of their own: bytes that repeat nothing stay."""
    rng = random.Random(13)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = word(150)
    rows = [(7, shared + word(200)), (7, word(300)), (None, word(250)), (None, word(180) + shared), (9, word(400)), (9, word(400))]
    got = suffix.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in got if r.n_bytes not in (350, 330)) == [(250, 0), (300, 0), (400, 0), (400, 0)]
    assert sum(r.n_removed for r in got) == 150


def test_suffix_crowd_spreads():
    """Windows at the right edge of a shared passage begin alike and go on differently: they spread over all parts, and equal ones meet."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(100))
    texts = [passage + "".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(200)]
    texts += texts[:1]
    spot = {"anchor": 1, "at": 1, "n": 60, "o": 59, "parts": 500}
    kind = pa.list_(pa.struct([("anchor", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("o", pa.int64()), ("parts", pa.int32())]))
    rows = [pa.RecordBatch.from_arrays([pa.array([d], pa.int64()), pa.array([t]), pa.array([[spot]], kind)], ["_doc", "text", "spots"]) for d, t in enumerate(texts)]
    sizes, where = Counter(), {}
    for batch in suffix.fetch(100)(rows):
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("payload").to_pylist(), strict=True):
            sizes[part] += 1
            where.setdefault(suffix.unpack(blob, np.int64, np.uint8)[1].tobytes(), set()).add(part)
    assert sum(sizes.values()) == 201 * 60 and len(sizes) == 500 and max(sizes.values()) < 80
    assert all(len(parts) == 1 for parts in where.values())


def test_merge_is_a_sort():
    """The interleave of the merged transforms orders suffixes by their first characters, and intervals are their classes."""
    import numpy as np

    rng = np.random.default_rng(7)
    shards = [np.concatenate([np.append(rng.integers(1, 4, rng.integers(20, 60)), 0) for _ in range(4)]).astype(np.uint8) for _ in range(3)]
    orders, z, interval = suffix.merged_intervals(shards, 12)
    at = [0] * 3
    prefixes = []
    for s in z:
        t, o = shards[s], orders[s][at[s]]
        at[s] += 1
        prefixes.append(bytes(np.roll(t, -o)[:12]))
    assert prefixes == sorted(prefixes)
    assert [a != b for a, b in zip(prefixes, prefixes[1:], strict=False)] == [a != b for a, b in zip(interval, interval[1:], strict=False)]


def test_strip(docs, texts):
    for r in suffix.strip(docs).collect():
        assert r.text is None or (r.n_chars == len(r.text) and len(r.text) <= len(texts[r.doc_id]))


def test_sketch(docs, texts):
    rows = {r.doc_id: r for r in sketch.fingerprints(docs).collect()}
    ids = sorted(texts)
    pieces = {}
    for d, t in texts.items():
        pieces[d] = parts(t)
    for i, d in enumerate(ids):
        t, after = texts[d], texts[ids[(i + 1) % len(ids)]]
        q = len(t) // 4
        edited = t[: len(t) - q] + after[:q]
        r = rows[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        near = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        for got, other in ((r.near_edited, parts(edited)), (r.near_next, parts(after))):
            assert got == pytest.approx(near(pieces[d], other), abs=1e-12)
        assert (r.fingerprint, r.edited_fingerprint) == (brute_fingerprint(pieces[d]), brute_fingerprint(parts(edited)))
    same = {}
    for d in ids:
        assert same.setdefault(texts[d], rows[d].fingerprint) == rows[d].fingerprint
    again = docs.sparkSession.createDataFrame([(r.fingerprint, r.edited_fingerprint, r.near_edited) for r in rows.values()], "f string, e string, near_edited double")
    found = sketch.likeness(again, "f", "e", "c").select("near_edited", "c.likeness", "c.sure").collect()
    assert all(r.likeness == r.near_edited or not r.sure for r in found) and sum(r.sure for r in found) > 0.8 * len(found)  # of the two strings alone


def brute_fingerprint(paragraphs):
    """The sketch of paragraphs, cell by cell."""
    from xxhash import xxh64_intdigest as h

    digests = {h(x.encode(), 42) >> 24 for x in paragraphs}
    items = [d << 16 | h((7).to_bytes(4, "little"), h(d.to_bytes(8, "little"), 42)) >> 48 for d in digests]
    p = max(0, math.ceil(math.log2(max(1, len(items)) / sketch.PART)))
    cells = [[0, 0] for _ in range((1 << p) * 3 * sketch.WIDTH)]
    for x in items:
        for t in range(3):
            c = cells[(x >> (56 - p)) * 3 * sketch.WIDTH + t * sketch.WIDTH + (x >> (16 + 4 * t) & 15)]
            c[0] += 1
            c[1] ^= x
    line = base64.b64encode(b"".join(((n & 255) << 56 | x).to_bytes(8, "big") for n, x in cells)).decode()
    return "\r\n".join(line[i : i + 76] for i in range(0, len(line), 76))


def parts(text):
    out = set()
    for line in text.split("\n"):
        w = list(re.finditer(r"[^\x20\x09-\x0D]+", line))
        out |= {line[w[i].start() : w[min(i + sketch.RUN, len(w)) - 1].end()] for i in range(0, len(w), sketch.RUN)}
    return out


def test_sketch_peels(spark):
    """Sketches recover the differing digests; larger ones, of more parts, where one part can't."""
    rng = random.Random(8)
    rows = []
    for i in range(80):
        both = [rng.getrandbits(40) for _ in range(rng.choice([0, 5, 30, 400]))]
        rows.append((i, both + [rng.getrandbits(40) for _ in range(i % 9)], both + [rng.getrandbits(40) for _ in range(60 if i % 10 == 7 else i % 5)]))
    df = spark.createDataFrame(rows, "i int, p array<long>, q array<long>")
    items = lambda c: F.array_sort(F.array_distinct(F.transform(c, lambda d: F.shiftleft(d, 16).bitwiseOR(sketch.check(d)))))
    made = df.select("i", "p", "q", sketch.sketch(items(F.col("p"))).alias("x"), sketch.sketch(items(F.col("q"))).alias("y"))
    out = made.select("i", "p", "q", sketch.compare(F.col("x"), F.col("y")).alias("d")).collect()
    full = 0
    for r in out:
        p, q = set(r.p), set(r.q)
        if r.d.clear:
            assert {x >> 16 for x in r.d.only_x} == p - q and {x >> 16 for x in r.d.only_y} == q - p
            assert r.d.likeness == pytest.approx(len(p & q) / len(p | q) if p | q else 1)
            full += 1
        else:
            assert -1e-9 <= r.d.likeness <= len(p & q) / len(p | q) + 0.08
    assert full >= 72
    assert any(r.d.clear and len(set(r.p) ^ set(r.q)) > 60 for r in out)  # more than one part's cells


def test_likeness_of_unlike_texts(spark):
    """Texts of 32 and 100 paragraphs that share some, for which the stored sketches are too small: the retries give the exact likeness."""
    rng = random.Random(21)
    rows = []
    for i in range(40):
        n, share = rng.choice([32, 100, 400]), rng.choice([0, 0.1, 0.35, 0.6, 0.95])
        one = [f"paragraph {i} {j}" for j in range(n)]
        rows += [(2 * i, "\n".join(one)), (2 * i + 1, "\n".join(x if rng.random() < share else f"other {i} {j}" for j, x in enumerate(one)))]
    got = {r.doc_id: r for r in sketch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    for (d, a), (_, b) in zip(rows, rows[1:], strict=False):
        x, y = set(a.split("\n")), set(b.split("\n"))
        assert got[d].near_next == pytest.approx(len(x & y) / len(x | y), abs=1e-12)
    made = spark.createDataFrame([(a, b) for (_, a), (_, b) in zip(rows[::2], rows[1::2], strict=True)], "a string, b string").select(sketch.digests(F.col("a")).alias("p"), sketch.digests(F.col("b")).alias("q"))
    both = made.select("*", sketch.sketch(F.col("p")).alias("x"), sketch.sketch(F.col("q")).alias("y"))
    met = both.select("p", "q", sketch.compare(F.col("x"), F.col("y")).alias("c"))
    out = sketch.retried(met, "p", "q", "c", "near").select("p", "q", "c.sure", "near").collect()
    assert any(not r.sure for r in out) and any(r.sure for r in out)
    assert all(r.near == pytest.approx(len(set(r.p) & set(r.q)) / len(set(r.p) | set(r.q))) for r in out)


def test_null_ids_and_repeated_rows(spark):
    """Rows without an id, rows that come twice, two texts under one id: each row has its result, and nothing is lost."""
    import public_tokenizers as p

    long = "alpha beta gamma delta epsilon zeta eta theta iota kappa " * 8
    rows = [(None, long, "a"), (None, None, None), (5, long + "end", "a"), (5, long + "end", "a"), (6, "short", "b"), (7, "one text", "b"), (7, "another text", "b"), (8, long, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    per_row = (
        lambda d: lm.score(d), simhash.near_duplicates, lambda d: pii.digest(pii.scan(d)), lambda d: shard.shard_documents(d, [1.0, 2.0]), quality.judge, suffix.deduplicate, sketch.fingerprints, pii.redact, suffix.strip,
        lambda d: packing.pack(d), lambda d: bpe.round_trip(d, p.path("byte_bpe_50k.tiktoken"), p.PATTERN),
    )
    for f in per_row:
        assert Counter(r.doc_id for r in f(df).collect()) == Counter(r[0] for r in rows), f
    left = {(r.doc_id, r.n_bytes): r.n_bytes - r.n_removed for r in suffix.deduplicate(df).collect()}
    once = {(r.doc_id, r.n_bytes): r.n_bytes - r.n_removed for r in suffix.deduplicate(df.dropDuplicates()).collect()}
    assert left == once and left[None, len(long)] > 50 > left[8, len(long)] and left[None, 0] == 0 and left[6, 5] == 5
    scores = {}
    for r in lm.score(df).collect():
        scores.setdefault((r.doc_id, r.n_tokens), set()).add((r.base_score, r.score))
    assert all(len(v) == 1 for k, v in scores.items() if k[0] == 5)
    assert {r.component_id for r in simhash.near_duplicates(df).collect() if r.doc_id in (8,)} <= {5, 8}
