"""Document fingerprints: invertible Bloom lookup sketches, with DataFrame functions only.

A paragraph is a line, in runs of RUN words; its digest has 40 bits, beside 16 bits to check it by. A sketch has three
thirds of WIDTH cells; a digest goes to one cell of each third, and a cell holds how many digests it got and their sum
by exclusive or. A fingerprint is a text's sketch, made of 2**p parts by the digests' upper bits, about PART digests in
each: the text alone decides it, so it can be stored and sent, and parts add up to the parts of a coarser sketch.

Two fingerprints are compared without the texts. At the number of parts of the coarser, one minus the other holds only
the differing digests; cells with one digest are peeled until none is left, which recovers these digests. The sketches
are first summed to one part; if that doesn't peel, the comparison is made again with all parts. Where that fails too
(unlike texts), `fingerprints`, which has the digests at hand, retries with a sketch several times as large, parts of
FINE digests, of FINE_WIDTH cells in a third, into which one text's digests are put and from which the other's are
taken: their difference, made at once. The last size is that at which every digest has a cell of its own, so that
subtraction alone leaves the differing ones; it is reached where digests share all their cells. So likenesses are exact.
From two strings alone a part that doesn't peel counts as different throughout, and a likeness may be too low.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import cut, fresh
from .quality import let

RUN = 16
WORD, GAP = r"[^\x20\x09-\x0D]++", r"[\x20\x09\x0B-\x0D]++"
#: A run of at most RUN words of a line, white space between them included.
PARAGRAPH = f"{WORD}(?:{GAP}{WORD}){{0,{RUN - 1}}}+"
#: Cells in a third of a part (4 bits of the digest choose one), and digests of a part, at most on average.
WIDTH, PART = 16, 32
#: The same of the larger sketches that a failed comparison is made again with.
FINE_WIDTH, FINE = 8, 4
#: A difference with fewer empty cells is not peeled: it holds too many digests.
EMPTY = 3
#: Rounds of peeling at most; each peels all cells that are ripe. A comparison that needs more is made again with more cells.
ROUNDS = 24
CELL = "struct<c:int,x:bigint>"


def seq(n: Column) -> Column:
    """0 to n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def check(digest: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(digest, F.lit(7)), 48)


def digests(text: Column) -> Column:
    """Sorted distinct digests of a text's paragraphs, each above its check (56 bits); none for null and blank texts."""
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    item = lambda d: F.shiftleft(d, 16).bitwiseOR(check(d))
    return F.sort_array(F.array_distinct(F.transform(runs, lambda r: let(F.shiftrightunsigned(F.xxhash64(r), 24), item))))


def cell(c: Column, x: Column) -> Column:
    return F.struct(c.cast("int").alias("c"), x.alias("x"))


def places(x: Column, width: int) -> list[Column]:
    """A digest's cell in each third, by bits of its own for each."""
    bits = width.bit_length() - 1
    return [F.shiftrightunsigned(x, 16 + bits * t).bitwiseAND(F.lit(width - 1)).cast("int").alias(f"p{t}") for t in range(3)]


def thirds(rows: Column, one, width: int) -> Column:
    """Cells of three thirds: one(third, j, rows that go to cell j of it). rows: structs with p0, p1 and p2. Rows are dealt to four cells at once, then to each of these."""

    def third(t):
        four = lambda some, q: F.transform(F.sequence(q * 4, q * 4 + 3), lambda j: one(t, j, F.filter(some, lambda r: r[f"p{t}"] == j)))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(width // 4 - 1)), lambda q: let(F.filter(rows, lambda r: F.shiftright(r[f"p{t}"], 2) == q), lambda some: four(some, q))))

    return F.concat(*(third(t) for t in range(3)))


def rows_of(items: Column, width: int, count: int = 1) -> Column:
    """Digests with their cells, to be put in (count 1) or taken out (-1)."""
    return F.transform(items, lambda x: F.struct(F.lit(count).alias("c"), x.alias("x"), *places(x, width)))


def cells_of(rows: Column, width: int) -> Column:
    """Cells of a part's rows."""
    nothing = cell(F.lit(0), F.lit(0).cast("bigint"))
    one = lambda t, j, mine: F.aggregate(mine, nothing, lambda k, r: cell(k["c"] + r["c"], k["x"].bitwiseXOR(r["x"])))
    return let(rows, lambda some: thirds(some, one, width))


def bits_of(n: Column, part: int = PART) -> Column:
    """p for n digests: 2**p parts hold `part` each at most on average."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(n, F.lit(1)) / F.lit(part))).cast("int"))


def dealt(items: Column, p: Column) -> Column:
    """Sorted digests by their part: 2**p arrays."""
    n, many = F.size(items), F.call_function("shiftleft", F.lit(1), p)

    def below(bound):
        """How many digests are below a bound, by bisection."""
        def step(s, _):
            mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
            return F.when(s["lo"] >= s["hi"], s).when(F.get(items, mid) < bound, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))).otherwise(F.struct(s["lo"].alias("lo"), mid.alias("hi")))

        steps = seq(F.ceil(F.log2(n + 1)).cast("int") + 1)
        return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), n.alias("hi")), step, lambda s: s["lo"])

    cuts = F.transform(seq(many + 1), lambda i: below(F.call_function("shiftleft", i.cast("bigint"), 56 - p)))
    mine = lambda at, i: F.slice(items, F.get(at, i) + 1, F.get(at, i + 1) - F.get(at, i))
    return F.when(p == 0, F.array(items)).otherwise(let(cuts, lambda at: F.transform(seq(many), lambda i: mine(at, i))))


def sketch(found: Column, width: int = WIDTH, bits: Column | None = None) -> Column:
    """Parts (arrays of 3 * width cells) of sorted digests: as many as their number asks for, or 2**bits."""
    made = lambda items, p: F.transform(dealt(items, p), lambda mine: cells_of(rows_of(mine, width), width))
    return let(found, lambda items: let(bits_of(F.size(items)) if bits is None else bits, lambda p: made(items, p)))


def add(a: Column, b: Column, sign: int = 1) -> Column:
    return F.zip_with(a, b, lambda p, q: cell(p["c"] + q["c"] * sign, p["x"].bitwiseXOR(q["x"])))


def fold(parts: Column, n: Column) -> Column:
    """The sketch in n parts: neighbours summed."""

    def folded(r):
        sums = lambda some: F.aggregate(F.slice(some, F.lit(2), F.size(some)), F.get(some, 0), lambda a, b: add(a, b))
        return F.when(r == 1, parts).otherwise(F.transform(seq(n), lambda i: let(F.slice(parts, i * r + 1, r), sums)))

    return let((F.size(parts) / n).cast("int"), folded)


def peel(cells: Column, width: int = WIDTH) -> Column:
    """struct(cells, a, b): what is left, and the digests peeled from the first (a) and from the second (b) of the two sketches whose difference it is."""

    def ripe(cs):
        """Digests of cells that hold one, times two, plus one where it is the second sketch's."""
        found = F.filter(cs, lambda v: (F.abs(v["c"]) == 1) & (check(F.shiftrightunsigned(v["x"], 16)) == v["x"].bitwiseAND(F.lit(65535))))
        return F.array_distinct(F.transform(found, lambda v: F.shiftleft(v["x"], 1) + F.when(v["c"] < 0, 1).otherwise(0)))

    def round_(s, _):
        def step(found):
            sign = lambda v: 1 - 2 * v.bitwiseAND(F.lit(1))
            of = lambda c: F.transform(F.filter(found, lambda v: sign(v) == c), lambda v: F.shiftright(v, 1))
            taken = lambda t, j, mine: F.aggregate(mine, F.get(s["cells"], j + t * width), lambda u, f: cell(u["c"] - f["c"], u["x"].bitwiseXOR(f["x"])))
            rows = F.transform(found, lambda v: F.struct(sign(v).cast("int").alias("c"), F.shiftright(v, 1).alias("x"), *places(F.shiftright(v, 1), width)))
            left = let(rows, lambda rows: thirds(rows, taken, width))
            return F.struct(left.alias("cells"), F.concat(s["a"], of(1)).alias("a"), F.concat(s["b"], of(-1)).alias("b"), F.lit(True).alias("on"))

        done = F.struct(s["cells"].alias("cells"), s["a"].alias("a"), s["b"].alias("b"), F.lit(False).alias("on"))
        return F.when(s["on"], let(ripe(s["cells"]), lambda found: F.when(F.size(found) == 0, done).otherwise(step(found)))).otherwise(s)

    empty = F.size(F.filter(cells, lambda v: (v["c"] == 0) & (v["x"] == 0)))
    start = F.struct(cells.alias("cells"), none("bigint").alias("a"), none("bigint").alias("b"), (empty >= EMPTY).alias("on"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, round_, lambda s: F.struct(s["cells"].alias("cells"), s["a"].alias("a"), s["b"].alias("b")))


def held(part: Column, width: int = WIDTH) -> Column:
    """Digests in a part."""
    return F.aggregate(F.slice(part, 1, width), F.lit(0), lambda n, v: n + v["c"])


def left_over(cells: Column, width: int) -> Column:
    """How many digests are in these cells if all of them share theirs: 0; 2, where each third has one cell, of two digests that add up or cancel out; else -1."""
    n = F.aggregate(cells, F.lit(0), lambda k, v: k + F.when((v["c"] != 0) | (v["x"] != 0), 1).otherwise(0))
    third = lambda t: F.aggregate(F.slice(cells, t * width + 1, width), F.lit(0), lambda k, v: k + F.when((v["c"] == 0) & (v["x"] != 0), 2).otherwise(F.abs(v["c"])))
    return F.when(n == 0, F.lit(0)).when((n == 3) & (third(0) == 2) & (third(1) == 2) & (third(2) == 2), F.lit(2)).otherwise(F.lit(-1))


def peeled(cells: Column, width: int, every) -> Column:
    """struct(d, a, b, clear, sure) of a difference's cells: differing digests (every() where that isn't known), those recovered of each side, whether these are all, and whether d is sure."""

    def of(s):
        found = lambda left: F.when(left >= 0, F.size(s["a"]) + F.size(s["b"]) + left).otherwise(every())
        return let(left_over(s["cells"], width), lambda left: outcome(found(left), s["a"], s["b"], left == 0, left >= 0))

    return let(peel(cells, width), of)


def outcome(d: Column, x: Column, y: Column, clear: Column, sure: Column) -> Column:
    return F.struct(d.alias("d"), x.alias("a"), y.alias("b"), clear.alias("clear"), sure.alias("sure"))


def same() -> Column:
    """The outcome of two equal parts."""
    return outcome(F.lit(0), none("bigint"), none("bigint"), F.lit(True), F.lit(True))


def compare_parts(width: int):
    """The outcome of two parts of sketches."""
    return lambda a, b: F.when(a == b, same()).otherwise(peeled(add(a, b, -1), width, lambda: held(a, width) + held(b, width)))


def larger(own: Column, other: Column) -> Column:
    """struct(d, sure) of two sorted lists of digests by larger sketches, into which one list is put and from which the other is taken."""

    def part(a, b):
        return F.when(a == b, same()).otherwise(peeled(cells_of(F.concat(rows_of(a, FINE_WIDTH), rows_of(b, FINE_WIDTH, -1)), FINE_WIDTH), FINE_WIDTH, lambda: F.size(a) + F.size(b)))

    both = lambda p: F.zip_with(dealt(own, p), dealt(other, p), part)
    total = lambda each: F.struct(F.aggregate(each, F.lit(0), lambda n, e: n + e["d"]).alias("d"), F.forall(each, lambda e: e["sure"]).alias("sure"))
    return let(bits_of(F.greatest(F.size(own), F.size(other)), FINE), lambda p: let(both(p), total))


def ratio(total: Column, d: Column) -> Column:
    """Shared digests over all: `total` digests on both sides, of which d differ."""
    shared = (total - d) / F.lit(2.0)
    return F.when(total == 0, F.lit(1.0)).otherwise(shared / (total - shared))


def compare(x: Column, y: Column) -> Column:
    """struct(likeness, only_x, only_y, clear, sure) of two sketches (arrays of parts): shared digests over all, the recovered digests that only one has, whether these are all there are, and whether the likeness is sure. Two without digests are alike."""

    def joined(each):
        flat = lambda k: F.flatten(F.transform(each, lambda e: e[k]))
        every = lambda k: F.forall(each, lambda e: e[k])
        return outcome(F.aggregate(each, F.lit(0), lambda n, e: n + e["d"]), flat("a"), flat("b"), every("clear"), every("sure"))

    def done(total, r):
        return F.struct(ratio(total, r["d"]).alias("likeness"), r["a"].alias("only_x"), r["b"].alias("only_y"), r["clear"].alias("clear"), r["sure"].alias("sure"))

    def at(n):
        return let(F.zip_with(fold(x, n), fold(y, n), compare_parts(WIDTH)), joined)

    n = F.least(F.size(x), F.size(y))
    total = F.aggregate(x, F.lit(0), lambda k, p: k + held(p)) + F.aggregate(y, F.lit(0), lambda k, p: k + held(p))
    all_parts = lambda once: F.when(once["clear"] | (n == 1), once).otherwise(at(n))
    return let(let(at(F.lit(1)), all_parts), lambda r: let(total, lambda t: done(t, r)))


def retried(df: DataFrame, own: str, other: str, met: str, name: str) -> DataFrame:
    """df with name: the likeness of two texts by the comparison `met` of their fingerprints' sketches, made again with larger sketches of the same digests (own, other) until it is sure.

    The larger one is a step of its own, as expressions that hold each other are analysed slowly; where it isn't needed its column is null.
    """
    again = fresh(df, "_again")
    retry = df.withColumn(again, F.when(~F.col(met)["sure"], larger(F.col(own), F.col(other))))
    total = F.size(own) + F.size(other)
    # a cell for each digest: what the difference holds is what one side alone has
    single = ratio(total, F.size(F.array_except(own, other)) + F.size(F.array_except(other, own)))
    likeness = F.when(F.col(met)["sure"], F.col(met)["likeness"]).when(F.col(again)["sure"], ratio(total, F.col(again)["d"])).otherwise(single)
    return retry.withColumn(name, likeness).drop(again)


def encode(parts: Column) -> Column:
    """A sketch as a string: its cells, 8 bytes each, in base64."""
    each = F.transform(F.flatten(parts), lambda v: F.lpad(F.hex(F.shiftleft(v["c"].cast("bigint").bitwiseAND(F.lit(255)), 56).bitwiseOR(v["x"])), 16, "0"))
    return F.base64(F.unhex(F.array_join(each, "")))


def decode(fingerprint: Column) -> Column:
    """The sketch that a string holds."""

    def parts(h):
        def one(i):
            c = F.conv(F.substring(h, i * 16 + 1, F.lit(2)), 16, 10).cast("int")
            return cell(F.when(c > 127, c - 256).otherwise(c), F.conv(F.substring(h, i * 16 + 3, F.lit(14)), 16, 10).cast("bigint"))

        per = 3 * WIDTH
        return F.transform(seq((F.length(h) / (16 * per)).cast("int")), lambda p: F.transform(seq(F.lit(per)), lambda j: one(p * per + j)))

    return let(F.hex(F.unbase64(fingerprint)), parts)


def likeness(df: DataFrame, x: str, y: str, name: str) -> DataFrame:
    """df with name: what compare says of two fingerprints (columns of strings), of the strings alone."""
    p, q = fresh(df, "_p"), fresh(df, "_q")
    both = df.withColumns({p: decode(F.col(x)), q: decode(F.col(y))})
    return both.withColumn(name, compare(F.col(p), F.col(q))).drop(p, q)


def successors(docs: DataFrame, key: str) -> DataFrame:
    """(key, next_key) of distinct keys in ascending order, the last followed by the first.

    Keys are dealt by ranges; the only window without a partition runs over one row for each range, whose number is bounded by the session's partitions.
    """
    ranged = cut(docs.select(key).where(F.col(key).isNotNull()).distinct().repartitionByRange(key).withColumn("_r", F.spark_partition_id()))
    ends = ranged.groupBy("_r").agg(F.min(key).alias("_least"))
    firsts = ends.select("_r", F.coalesce(F.lead("_least").over(Window.orderBy("_r")), F.first("_least").over(Window.orderBy("_r"))).alias("_after"))
    inside = F.lead(key).over(Window.partitionBy("_r").orderBy(key))
    return ranged.withColumn("_in", inside).join(F.broadcast(firsts), "_r").select(key, F.coalesce("_in", "_after").alias("next_key"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of docs (doc_id, text; doc_id unique).

    The edited text ends in the next document's beginning: the last floor(n_chars/4) code points are replaced by the first as many (or all) of the next. Null texts are empty. near_edited and near_next are likenesses: shared digests over all digests of both (1 for two without any), from the returned fingerprints or, where these don't peel, from larger sketches of the same digests. A row with a null doc_id has no next: its edited text loses its end, and its next is the empty text. Rows that repeat a doc_id: each is compared, next is the least text of the next id. No rows: no rows.
    """
    # both joins read one exchange of (k, text); a filter on nulls or one more column would make two of it. The least long stands for null
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    after = successors(slim, "doc_id")
    sizes = slim.groupBy("doc_id").agg(F.max(F.length("text")).alias("_n"))
    key = lambda c, name: F.coalesce(c, F.lit(-(2**63))).alias(name)
    wanted = after.join(sizes, "doc_id").select(key("next_key", "k"), key("doc_id", "_of"), (F.col("_n") / 4).cast("int").alias("_q"))
    by_id = slim.select("k", "text", digests(F.col("text")).alias("own")).repartition("k")
    heads = by_id.join(wanted.hint("shuffle_merge"), "k").groupBy(F.col("_of").alias("k")).agg(F.min(F.struct(F.substring("text", F.lit(1), F.col("_q")).alias("head"), F.col("own").alias("after"))).alias("_next"))
    q = (F.length("text") / 4).cast("int")
    both = by_id.join(heads.hint("shuffle_merge"), "k", "left").select(
        F.nullif("k", F.lit(-(2**63))).alias("doc_id"), F.length("text").cast("long").alias("n_chars"), "own",
        F.concat(F.substring("text", F.lit(1), F.length("text") - q), F.substring(F.coalesce("_next.head", F.lit("")), F.lit(1), q)).alias("edited"), F.coalesce("_next.after", none("bigint")).alias("after"),
    )
    with_digests = both.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "own", digests(F.col("edited")).alias("edit"), "after")
    made = with_digests.select("*", *(sketch(F.col(c)).alias(f"{c}_sketch") for c in ("own", "edit", "after")))
    met = made.select("*", *(compare(F.col("own_sketch"), F.col(f"{c}_sketch")).alias(f"{c}_met") for c in ("edit", "after")))
    found = retried(retried(met, "own", "edit", "edit_met", "near_edited"), "own", "after", "after_met", "near_next")
    return found.select("doc_id", "n_chars", "edited_sha256", encode(F.col("own_sketch")).alias("fingerprint"), encode(F.col("edit_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")
