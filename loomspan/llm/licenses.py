"""License scans by a positional index of rare words, with DataFrame functions only.

The index holds, for each license template, its ANCHORS words that fewest documents of the corpus hold (highest inverse
document frequency), with their places in the template. A file's words are looked up in it; a posting's place taken from
the word's place in the file says where the template would start, and postings of a template that agree on the start are
its intersection by relative position. Where NEED of them agree, the template's mandatory phrases are verified at their
places, SLACK words more or less. The share of the template's words that stand in place is the match's score.

The vocabulary of the templates bounds what is broadcast or sent to the driver; document frequencies count all documents.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .quality import let

ANCHORS, NEED, SLACK = 5, 2, 4
#: The score of a text that holds a base phrase but no template.
BASE_SCORE = 0.5
#: Characters below 128 that aren't in words; capitals are lowered before.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Template(NamedTuple):
    label: str
    text: str
    phrases: tuple[str, ...]


# Phrases that name a license, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Notices of public licenses, as words, with the phrases that have to stand in them.
TEMPLATES = (
    Template("agpl", "it under the terms of the gnu affero general public license as published by the free software foundation", ("affero general public license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("in compliance with the license",)),
    Template("boost-1.0", "distributed under the boost software license version 1 0", ("boost software license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms", "following conditions are met")),
    Template("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc", "4 0")),
    Template("cc-by-sa-4.0", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike 4 0",)),
    Template("cc0", "the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright", "neighboring rights")),
    Template("epl-2.0", "made available under the terms of the eclipse public license 2 0", ("eclipse public license",)),
    Template("gpl", "it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license", "free software foundation")),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    Template("lgpl", "it under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("hereby granted free of charge", "associated documentation files")),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
)


def words_of(text: Column) -> Column:
    """Array of a text's words."""
    bare = F.btrim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP, " "))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, " "))


def texts(items) -> Column:
    return F.array(*map(F.lit, items)).cast("array<string>")


def frequencies(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each word of the vocabulary stands; words that stand in none are left out."""
    held = docs.select(F.explode(F.array_intersect(words_of(F.col("text")), texts(vocabulary))).alias("word"))
    return {r.word: r.n for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}


def index(templates, df: dict[str, int], anchors: int = ANCHORS) -> dict[str, list[tuple[int, int]]]:
    """word -> (template, place) of each template's rarest words that occur at all."""
    out: dict = {}
    for t, template in enumerate(templates):
        words = template.text.split()
        rare = sorted((df[w], w) for w in set(words) if w in df)[:anchors]
        for _, w in rare:
            out.setdefault(w, []).extend((t, i) for i, x in enumerate(words) if x == w)
    return out


def phrase_at(words: Column, phrase: str, i: Column) -> Column:
    """Whether the words of a phrase stand consecutively from place i on."""
    out = F.lit(True)
    for j, w in enumerate(phrase.split()):
        out = out & F.coalesce(F.get(words, i + j) == w, F.lit(False))
    return out


def near(words: Column, phrase: str, i: Column) -> Column:
    """Whether a phrase stands at place i, SLACK words more or less."""
    lo = F.greatest(i - SLACK, F.lit(0))
    part = F.slice(words, lo + 1, F.greatest(i + len(phrase.split()) + SLACK - lo, F.lit(0)))
    return F.contains(F.concat(F.lit(" "), F.array_join(part, " "), F.lit(" ")), F.lit(f" {phrase} "))


def places(templates) -> list[list[tuple[str, int]]]:
    """Each template's phrases with their places in it."""
    return [[(p, f" {t.text} ".split(f" {p} ")[0].count(" ")) for p in t.phrases] for t in templates]


def found(words: Column, rare: dict[str, list[tuple[int, int]]], templates) -> Column:
    """struct(base, matches) of a text's words: base phrases' starts (i, label), verified templates (label, score)."""
    firsts = {p.split()[0] for p in BASE}
    wanted = sorted({*rare, *firsts})
    base_kind, kind = "array<struct<i:int,label:string>>", "array<struct<label:string,score:double>>"
    at = F.struct(F.lit(0).alias("t"), F.lit(0).alias("at"))
    postings = F.create_map(*(x for w, ps in rare.items() for x in (F.lit(w), F.array(*(F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in ps))))) if rare else None

    def base(hits):
        here = lambda h: F.coalesce(*(F.when((h["w"] == p.split()[0]) & phrase_at(words, p, h["i"]), F.lit(label)) for p, label in BASE.items()))
        return F.filter(F.transform(hits, lambda h: F.struct(h["i"].alias("i"), here(h).alias("label"))), lambda x: x["label"].isNotNull())

    def starts(hits):
        """Distinct (template, start) on which NEED postings agree: sorted, so those that agree are neighbours."""
        every = F.flatten(F.transform(hits, lambda h: F.transform(F.coalesce(postings[h["w"]], F.array(F.struct(F.lit(-1).alias("t"), F.lit(0).alias("p")))), lambda p: F.struct(p["t"].alias("t"), (h["i"] - p["p"]).alias("at")))))
        def agreed(rows):
            n = F.size(rows)
            i = F.when(n >= NEED, F.sequence(F.lit(0), n - NEED)).otherwise(F.array().cast("array<int>"))
            return F.array_distinct(F.transform(F.filter(i, lambda k: F.get(rows, k) == F.get(rows, k + NEED - 1)), lambda k: F.get(rows, k)))

        return let(F.array_sort(F.filter(every, lambda x: x["t"] >= 0)), agreed)

    def match(s):
        """label and score of a start; null where a phrase is missing."""
        out = F.lit(None).cast("struct<label:string,score:double>")
        for t, (template, phrases) in enumerate(zip(templates, places(templates), strict=True)):
            own = template.text.split()
            here = F.lit(True)
            for phrase, p in phrases:
                here = here & near(words, phrase, s["at"] + p)
            in_place = F.aggregate(F.transform(texts(own), lambda w, j: F.when(F.get(words, F.when(s["at"] + j >= 0, s["at"] + j)) == w, 1).otherwise(0)), F.lit(0), lambda a, x: a + x)  # noqa: B023
            out = F.when((s["t"] == t) & here, F.struct(F.lit(template.label).alias("label"), (in_place / F.lit(float(len(own)))).alias("score"))).otherwise(out)
        return out

    def of(hits):
        matches = F.filter(F.transform(starts(hits), match), lambda m: m.isNotNull()) if rare else F.array().cast(kind)
        return F.struct(base(hits).cast(base_kind).alias("base"), matches.cast(kind).alias("matches"))

    hits = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(*wanted))
    none = F.struct(F.array().cast(base_kind).alias("base"), F.array().cast(kind).alias("matches"))
    return F.when(F.arrays_overlap(words, texts(wanted)), let(hits, of)).otherwise(none)


def scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of docs (doc_id, text).

    Labels are distinct, sorted and joined by commas, '' where there are none. score is the best share of a verified template's words that stand in place, at least BASE_SCORE where a base phrase stands, else 0. A null text is empty; repeated rows are scanned each. No rows: no rows.
    """
    vocabulary = sorted({w for t in templates for w in t.text.split()})
    rare = index(templates, frequencies(docs, vocabulary))
    out = docs.select("doc_id", let(words_of(F.col("text")), lambda words: F.struct(F.size(words).cast("long").alias("n"), found(words, rare, templates).alias("f"))).alias("r"))
    base, matches = F.col("r.f.base"), F.col("r.f.matches")
    labels = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    best = F.coalesce(F.array_max(matches["score"]), F.lit(0.0))
    return out.select(
        "doc_id", F.col("r.n").alias("n_words"), F.size(base).cast("long").alias("n_base"), F.array_min(base["i"]).cast("long").alias("first_word"), F.array_max(base["i"]).cast("long").alias("last_word"),
        labels(base["label"]).alias("base_labels"), labels(F.concat(base["label"], matches["label"])).alias("labels"), F.when(F.size(base) > 0, F.greatest(best, F.lit(BASE_SCORE))).otherwise(best).alias("score"),
    )


def oracle(templates=TEMPLATES) -> str:
    rows = lambda xs: ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else f"'{x}'" for x in r) + ")" for r in xs)
    words = rows((t, i, w) for t, x in enumerate(templates) for i, w in enumerate(x.text.split()))
    keys = rows((t, p, i, len(p.split())) for t, ps in enumerate(places(templates)) for p, i in ps)
    base = rows((p, label, len(p.split())) for p, label in BASE.items())
    return rf"""WITH w AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
u AS (SELECT rid, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM w),
tw(t, pos, word) AS (VALUES {words}), ky(t, phrase, pos, n) AS (VALUES {keys}), bs(phrase, label, n) AS (VALUES {base}), tl(t, label) AS (VALUES {rows((t, x.label) for t, x in enumerate(templates))}),
df AS (SELECT word, count(DISTINCT rid) AS n FROM u WHERE word IN (SELECT word FROM tw) GROUP BY word),
an AS (SELECT t, word FROM (SELECT t, word, row_number() OVER (PARTITION BY t ORDER BY n, word) AS r FROM (SELECT DISTINCT t, word FROM tw) JOIN df USING (word)) WHERE r <= {ANCHORS}),
ca AS (SELECT u.rid, tw.t, u.i - tw.pos AS a FROM u JOIN tw USING (word) JOIN an ON an.t = tw.t AND an.word = tw.word GROUP BY ALL HAVING count(*) >= {NEED}),
ok AS (SELECT ca.rid, ca.t, ca.a FROM ca JOIN w USING (rid) JOIN ky USING (t) GROUP BY ALL
  HAVING bool_and(contains(' ' || array_to_string(ws[greatest(a + pos - {SLACK}, 0) + 1 : a + pos + n + {SLACK}], ' ') || ' ', ' ' || phrase || ' '))),
sc AS (SELECT ok.rid, ok.t, ok.a, (sum(CASE WHEN a + pos >= 0 AND ws[CASE WHEN a + pos >= 0 THEN a + pos + 1 ELSE 1 END] = word THEN 1 ELSE 0 END) / count(*))::DOUBLE AS s FROM ok JOIN w USING (rid) JOIN tw USING (t) GROUP BY ALL),
b AS (SELECT u.rid, u.i, bs.label FROM u JOIN bs ON u.word = split_part(bs.phrase, ' ', 1) JOIN w USING (rid) WHERE array_to_string(ws[u.i + 1 : u.i + bs.n], ' ') = bs.phrase),
bb AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word FROM b GROUP BY rid),
ll AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels
  FROM (SELECT rid, label, true AS base FROM b UNION ALL SELECT rid, label, false FROM sc JOIN tl USING (t)) GROUP BY rid),
ss AS (SELECT rid, max(s) AS s FROM sc GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  greatest(coalesce(s, 0.0), CASE WHEN n_base > 0 THEN {BASE_SCORE} ELSE 0.0 END)::DOUBLE AS score FROM w LEFT JOIN bb USING (rid) LEFT JOIN ll USING (rid) LEFT JOIN ss USING (rid)"""
