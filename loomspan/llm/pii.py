"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors (at-signs, digits, plus signs, schemes, identifier cues) in one pass over a
whole text; a deterministic parser expands each to the boundaries of what it belongs to and validates it. Parsers
start where the last span of their kind ended, so every character is walked a bounded number of times.
Kinds, in the order that breaks ties: email, ip, card, phone (the base kinds), then url (user name or password
inside), iban, ssn, secret (a value after an identifier cue).
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import slices

KINDS = ("email", "ip", "card", "phone", "url", "iban", "ssn", "secret")
#: Names whose assigned value is a credential or an account.
CUES = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "api-key", "access_key", "access-key", "private_key", "auth_key", "client_secret", "account", "iban", "ssn")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DIGITS = "0123456789"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+")
USERINFO = re.compile(r"://[^\s/?#@\"'<>]+@[A-Za-z0-9.-]+")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
ASSIGNED = re.compile(r"""["']?\s{0,4}[:=]\s{0,4}(["']?)([A-Za-z0-9_./+=\-]{8,})\1""")


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for d in DIGITS:
        a.add_word(d, ("digit", 1))
    for word, kind in (("@", "at"), ("+", "plus"), ("://", "scheme")):
        a.add_word(word, (kind, len(word)))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            a.add_word(form, ("cue", len(form)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if i % 2 == 0 else (v * 2 - 9 if v > 4 else v * 2)
    return total % 10 == 0


def iban_ok(value: str) -> bool:
    v = value.replace(" ", "")
    return 15 <= len(v) <= 34 and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def find(text: str, anchors) -> list[tuple[int, int, int]]:
    """Spans (start, kind's place in KINDS, end) of a text, sorted."""
    out = []
    email_end = at_end = number_end = card_end = iban_end = secret_end = 0
    for last, (kind, size) in anchors.iter(text):
        start = last - size + 1
        if kind == "digit":
            if start >= number_end:
                m = DOTTED.match(text, start)
                number_end = m.end()
                if text.find(".", start, number_end) >= 0:
                    parts, p = m.group().split("."), start
                    ends = []
                    for x in parts:
                        ends.append((p, p + len(x)))
                        p += len(x) + 1
                    for i in range(0, len(parts) - 3, 4):
                        if all(len(x.lstrip("0")) <= 3 and int(x[-3:]) <= 255 for x in parts[i : i + 4]):
                            out.append((ends[i][0], 1, ends[i + 3][1]))
            if start >= card_end:
                m = CARD.match(text, start)
                card_end = m.end()
                if card_end - start >= 14:
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        out.append((start, 2, card_end))
                if out[-1:] != [(start, 2, card_end)] and (m := SSN.match(text, start)) and text[start - 1 : start] not in ("-", "+") and text[start : start + 3] not in ("000", "666") and text[start] != "9":
                    out.append((start, 6, m.end()))
            if start >= iban_end and start >= 2 and text[start - 2 : start].isascii() and text[start - 2 : start].isupper() and not text[max(0, start - 3) : start - 2].isalnum():
                m = IBAN.match(text, start - 2)
                if m:
                    v = m.group()
                    while v and not iban_ok(v) and " " in v:  # words in capitals may follow
                        v = v.rpartition(" ")[0]
                    if iban_ok(v):
                        out.append((start - 2, 5, start - 2 + len(v)))
                        iban_end = start - 2 + len(v)
        elif kind == "at":
            floor = max(email_end, at_end)
            local = text[floor:start]
            begin = floor + len(local.rstrip(LOCAL))
            at_end = last + 1
            if begin < start and (m := DOMAIN.match(text, last + 1)):
                out.append((begin, 0, m.end()))
                email_end = m.end()
        elif kind == "plus":
            m = PHONE.match(text, start)
            if m:
                body = m.group().rstrip(" ().-")
                if len(body) >= 4 and 10 <= sum(c in DIGITS for c in body) <= 15:
                    out.append((start, 3, start + len(body)))
        elif kind == "scheme":
            if (m := USERINFO.match(text, start)) and start and text[start - 1].isalpha():
                begin = start
                while begin and text[begin - 1].isascii() and text[begin - 1].isalpha():
                    begin -= 1
                out.append((begin, 4, m.end()))
        elif start >= secret_end and (m := ASSIGNED.match(text, last + 1)):
            value = m.group(2)
            if any(c in DIGITS for c in value):
                out.append((m.start(2), 7, m.end(2)))
                secret_end = m.end(2)
    return sorted(set(out))


def render(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def mask(text: str, spans) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are masked as one, under the first's kind."""
    out, at = [], 0
    for a, k, b in spans:
        if a >= at:
            out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, spans (array of kind, start, end in code points), in the order of start and kind. Rows keep their order and number; a null text has no span."""

    def run(batches):
        anchors = automaton()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in slices(batches):
            found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in find(t, anchors)] if t else [] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:int,end:int>>")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the op3 query from scan()'s rows."""
    line = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS[:4]))
    of_kind = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [of_kind(k) for k in KINDS[:4]]
    return found.select("doc_id", *counts, F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span of text masked and n_chars (if there) recounted; null texts stay null."""
    schema = docs.schema

    def run(batches):
        anchors = automaton()
        for batch in slices(batches):
            texts = [None if t is None else mask(t, find(t, anchors)) for t in batch.column("text").to_pylist()]
            cols = {n: batch.column(n) for n in batch.schema.names}
            cols["text"] = pa.array(texts, batch.column("text").type)
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([None if t is None else len(t) for t in texts], batch.column("n_chars").type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return docs.mapInArrow(run, schema)

