"""Quality rules with host-level verdicts, with DataFrame functions only.

Every text is measured whole. Rules are counted by host; a host's failure rate is shrunk towards the corpus by a beta
prior fitted to the hosts' rates (method of moments), and the host's verdict comes back to its documents: a document
of a host in good standing may fail one of the soft rules, a document of a poor host none. A document that fails no
rule is kept whatever its host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import cut, fresh

SPACE = r"[\x20\x09-\x0D]+"
BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Soft rules: shares and bounds above which they fail.
MAX_SYMBOLS_PER_WORD, MAX_DUP_LINE_SHARE, WORD_LENGTH = 0.1, 0.3, (2.0, 14.0)
#: A host is poor from this shrunken failure rate on.
POOR_RATE = 0.5


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once for each row, however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """Array of a text's words."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def repeated(words: Column) -> Column:
    """Words that lie in a window of WINDOW words found twice or more, first occurrence included.

    Windows are compared by a 64-bit hash chained over their words' hashes. Where all differ (the usual text) they aren't sorted.
    """

    def of_windows(hashes):
        # (hash, position) sorted: a window repeats if a neighbour has its hash; positions then come back in order
        def marked(rows):
            i = F.sequence(F.lit(1), F.size(rows))
            same = lambda j: F.coalesce(F.get(rows, j)["h"] == F.get(rows, j - 1)["h"], F.lit(False))
            hit = F.filter(i, lambda j: same(j - 1) | same(j))
            return F.array_sort(F.transform(hit, lambda j: F.get(rows, j - 1)["p"]))

        def covered(at):
            i = F.sequence(F.lit(1), F.size(at))
            step = F.transform(i, lambda j: F.coalesce(F.least(F.get(at, j) - F.get(at, j - 1), F.lit(WINDOW)), F.lit(WINDOW)))
            return F.aggregate(step, F.lit(0), lambda a, x: a + x)

        rows = F.array_sort(F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
        found = F.when(F.size(hashes) == 0, F.lit(0)).when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0))
        return found.otherwise(let(rows, lambda r: let(marked(r), covered)))

    def of_words(h):
        starts = F.when(F.size(h) >= WINDOW, F.sequence(F.lit(0), F.size(h) - WINDOW)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(WINDOW))))

    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(of_words(h), of_windows))


def measure(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, n_soft_failures, which replace columns of these names. A null text has no words; an empty or blank one neither. Repeated rows are measured each. No rows: no rows."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "")
    words = words_of(F.col("text"))
    both = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated(w).cast("long").alias("r")))
    out = docs.drop("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    w, l, count = (fresh(out, x) for x in ("_w", "_l", "_lines"))  # noqa: E741
    out = out.withColumns({
        w: both,
        "word_chars": F.length(F.translate(text, BLANK, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        l: let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), F.size(F.array_distinct(x)).cast("long").alias("u"))),
    })
    out = out.withColumns({"n_words": F.col(f"{w}.n"), "n_repeat_words": F.col(f"{w}.r"), "n_dup_lines": F.col(f"{l}.n") - F.col(f"{l}.u"), count: F.col(f"{l}.n")}).drop(w, l)
    n = F.greatest(F.col("n_words"), F.lit(1))
    length = F.col("word_chars") / n
    soft = [F.col("n_symbols") / n > MAX_SYMBOLS_PER_WORD, F.col("n_dup_lines") / F.greatest(F.col(count), F.lit(1)) > MAX_DUP_LINE_SHARE, (length < WORD_LENGTH[0]) | (length > WORD_LENGTH[1])]
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumns({"base_failed": failed, "n_soft_failures": sum((x.cast("int") for x in soft), F.lit(0))}).drop(count)


def host_rates(measured: DataFrame, host: str, name: str = "_host") -> DataFrame:
    """One row for each host (column `name`): host_rate, its failure rate shrunk by the beta prior. Rows are counted on the map side, so a hot host sends one row for each task.

    The prior's mean m is the corpus rate; its strength is m(1-m)/v - 1, v the variance of the hosts' rates beyond what sampling explains, weighted by size. Without such variance (one host, or hosts alike) every host has the corpus rate.
    """
    fails = (F.col("base_failed") | (F.col("n_soft_failures") > 0)).cast("long")
    hosts = measured.groupBy(F.col(host).alias(name)).agg(F.count("*").alias("n"), F.sum(fails).alias("f"))
    m = F.col("tf") / F.col("tn")
    total = hosts.agg(F.sum("n").alias("tn"), F.sum("f").alias("tf"), F.sum(F.col("f") * F.col("f") / F.col("n")).alias("sq"), F.count("*").alias("k"))
    v = (F.col("sq") - F.col("tn") * m * m - (F.col("k") - 1) * m * (1 - m)) / F.col("tn")
    prior = total.select(m.alias("m"), F.when((v > 0) & (m > 0) & (m < 1), F.greatest(m * (1 - m) / v - 1, F.lit(1.0))).alias("strength"))
    row = prior.first()  # two numbers
    rate, strength = F.lit(row["m"]).cast("double"), row["strength"]
    shrunk = rate if strength is None else (F.col("f") + F.lit(strength) * rate) / (F.col("n") + F.lit(strength))
    return hosts.select(name, shrunk.alias("host_rate"))


def judge(docs: DataFrame, host: str = "source") -> DataFrame:
    """docs without text but with the measures, host_rate and kept. A null host is a host of its own. No rows: no rows.

    Texts are measured once: the measures are cut in the shared folder, and hosts and verdicts are made of them.
    """
    measured = cut(measure(docs.drop("host_rate", "kept", "base_failed", "n_soft_failures")).drop("text"))
    name = fresh(measured, "_host")
    out = measured.join(host_rates(measured, host, name), F.col(host).eqNullSafe(F.col(name)), "left").drop(name)
    allowed = F.when(F.col("host_rate") >= POOR_RATE, F.lit(0)).otherwise(F.lit(1))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("n_soft_failures") <= allowed))


def keep(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of docs (doc_id, text and host among their columns) that judge() keeps. A verdict goes by doc_id and text; null, empty and blank texts have too few words and go. Rows equal in both are judged alike. No rows: no rows."""
    key = F.xxhash64("text")
    judged = judge(docs.select("doc_id", "text", host, key.alias("_text")), host)
    out = judged.where("NOT kept").select(F.col("doc_id").alias("_doc"), "_text").distinct()
    return docs.join(out, docs["doc_id"].eqNullSafe(out["_doc"]) & (F.xxhash64(docs["text"]) == out["_text"]), "left_anti")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, i, list_slice(ws, i, i + 4) AS k FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1))) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g) WHERE c > 1),
rc AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, i + unnest(range(0, 5)) AS p FROM r) GROUP BY doc_id),
m AS (SELECT w.doc_id, source, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS lines,
  coalesce(rc.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN rc USING (doc_id)),
s AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  (n_symbols / greatest(n_words, 1) > 0.1)::INT + (n_dup_lines / greatest(lines, 1) > 0.3)::INT + (word_chars / greatest(n_words, 1) < 2.0 OR word_chars / greatest(n_words, 1) > 14.0)::INT AS soft FROM m),
h AS (SELECT source, count(*)::DOUBLE AS n, sum((base_failed OR soft > 0)::INT)::DOUBLE AS f FROM s GROUP BY source),
p AS (SELECT sum(f) / sum(n) AS m, sum(n) AS tn, sum(f * f / n) AS sq, count(*) AS k FROM h),
q AS (SELECT m, (sq - tn * m * m - (k - 1) * m * (1 - m)) / tn AS v FROM p),
st AS (SELECT m, CASE WHEN v > 0 AND m > 0 AND m < 1 THEN greatest(m * (1 - m) / v - 1, 1.0) END AS strength FROM q),
hr AS (SELECT source, CASE WHEN strength IS NULL THEN m ELSE (f + strength * m) / (n + strength) END AS rate FROM h, st)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND soft <= CASE WHEN rate >= 0.5 THEN 0 ELSE 1 END AS kept
FROM s JOIN hr ON s.source IS NOT DISTINCT FROM hr.source
"""

