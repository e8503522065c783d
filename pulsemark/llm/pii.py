"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust the score.

Base kinds are emails, addresses (ip), cards and phones: every leftmost, non-overlapping match that passes its
validator is kept whatever its score. Further kinds, ``iban`` (mod 97 must give 1) and ``ssn`` (valid number ranges), are
kept when their score reaches ``THRESHOLD``; an ssn needs a word of its context nearby for that. An iban ends where its
country's length says; for a country of unknown length every end of a word is tried, the longest first. The next one is
looked for right after what was accepted. All patterns run over the whole text where it lies, in time
proportional to its length, without a shuffle.

Defined results: a null or empty text has no spans and is returned as it is; offsets count code points, ends are
exclusive; ids may be null or repeated; other columns pass through, and one of the name of the result is replaced.
"""

from __future__ import annotations

import hashlib
import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import text as tx

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
THRESHOLD = 0.6
NEAR = 48  # code points on either side in which context words count

# A run is tried once, from its first character: a later start within it would end the same way.
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}")
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
_PLAIN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")

# characters of an account number without spaces, by country
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
IBAN_LENGTH = {country: n for n, countries in _IBAN_LENGTHS.items() for country in countries.split()}

# how sure a confirmed match is before its context is read
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4}
FOR = {
    "email": re.compile(r"\b(?:e-?mail|contact|write|correo|courriel)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|client)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|credit|debit|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|call|tel|mobile|fax|telefon)\b", re.I),
    "iban": re.compile(r"\b(?:iban|bank|account|konto|compte|cuenta)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social|security|taxpayer)\b", re.I),
}
AGAINST = re.compile(r"\b(?:version|isbn|order|invoice|example|build|serial)\b", re.I)


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether the check digit is right: doubled every second digit from the right, sums to a multiple of ten."""
    even = sum(map(int, digits[-1::-2]))
    odd = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return (even + odd) % 10 == 0


def mod97(text: str) -> bool:
    """Whether an account number's check digits are right: letters as 10 to 35, first four moved to the end."""
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _emails(text: str):
    """Each @ with a domain after it, and the run of address characters before it, as far as no match has taken them."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield start, done
        at = text.find("@", max(done, at + 1))


def _ibans(text: str):
    """At each start the end of a word that fits the country's length, or any if that is not known, the longest first."""
    done = 0
    for m in _IBAN_START.finditer(text):
        if m.start() < done or (run := _IBAN.match(text, m.start())) is None:
            continue
        usual = IBAN_LENGTH.get(m[0][:2])
        for end in range(run.end(), m.start() + 14, -1):
            if text[end - 1] == " " or text[end:end + 1] in _PLAIN:
                continue
            size = end - m.start() - text.count(" ", m.start(), end)
            if size >= 15 and size == (usual or size) and mod97(text[m.start():end]):
                yield m.start(), end
                done = end
                break


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _candidates(text: str):
    """Kind, start and end of every match that its validator confirms."""
    for start, end in _emails(text):
        yield "email", start, end
    if _DIGIT.search(text) is None:
        return
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            yield "phone", m.start(), m.end()
    for start, end in _ibans(text):
        yield "iban", start, end
    for m in _SSN.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", m.start(), m.end()


def find(text: str | None) -> list[Span]:
    """The spans of one text by start, then by kind as in ``KINDS``."""
    if not text:
        return []
    out = []
    for kind, start, end in _candidates(text):
        around = text[max(0, start - NEAR):start] + "\n" + text[end:end + NEAR]
        score = PRIOR[kind] + 0.3 * bool(FOR[kind].search(around)) - 0.3 * bool(AGAINST.search(around))
        if kind in BASE or score >= THRESHOLD:
            out.append(Span(kind, start, end, round(min(max(score, 0.0), 1.0), 2)))
    return sorted(out, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def redact(text: str, spans: list[Span]) -> str:
    """Each span replaced by its kind in brackets; of overlapping spans the whole union by the first one's kind."""
    parts, at, end, kind = [], 0, -1, ""
    for s in spans:
        if s.start < end:
            end = max(end, s.end)
            continue
        if end >= 0:
            parts.append(f"[{kind.upper()}]")
            at = end
        parts.append(text[at:s.start])
        end, kind = s.end, s.kind
    if end >= 0:
        parts.append(f"[{kind.upper()}]")
        at = end
    return "".join(parts) + text[at:]


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("score", T.DoubleType()),
]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def spans(docs: DataFrame, text: str = "text", to: str = "spans", keep_text: bool = True) -> DataFrame:
    """``docs`` with an array of spans (kind, start, end, score), and without the text if it is not kept."""
    fields = [f for f in docs.schema.fields if (keep_text or f.name != text) and f.name != to]

    def found(batches):
        for rows in (part.rows for part in tx.slices(batches, text)):
            made = [[s._asdict() for s in find(t)] for t in rows.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(rows.column(f.name) for f in fields), pa.array(made, _ARROW)],
                                             [*(f.name for f in fields), to])

    return docs.mapInArrow(found, T.StructType([*fields, T.StructField(to, SPANS)]))


def redacted(docs: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """``docs`` with every span replaced in the text; ``length`` names a column to hold its new length."""
    names = docs.columns

    def cleaned(batches):
        for rows in (part.rows for part in tx.slices(batches, text)):
            columns = dict(zip(names, rows.columns, strict=True))
            old = columns[text].to_pylist()
            new = [redact(t, s) if (s := find(t)) else t for t in old]
            columns[text] = pa.array(new, columns[text].type)
            if length:
                was = columns[length].to_pylist()
                now = [w if a == b else len(b) for w, a, b in zip(was, old, new, strict=True)]
                columns[length] = pa.array(now, columns[length].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return docs.mapInArrow(cleaned, docs.schema)


def joined(found: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in found)


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per base kind, the SHA-256 of the base spans and all spans as text."""
    kind = docs.schema[key].dataType.simpleString()

    def summed(batches):
        for rows in (part.rows for part in tx.slices(batches, text)):
            made = [find(t) for t in rows.column(text).to_pylist()]
            base = [[s for s in f if s.kind in BASE] for f in made]
            counts = [pa.array([sum(s.kind == k for s in f) for f in base], pa.int64()) for k in BASE]
            yield pa.RecordBatch.from_arrays([
                rows.column(key), *counts,
                pa.array([hashlib.sha256(joined(f).encode()).hexdigest() for f in base], pa.string()),
                pa.array([joined(f) for f in made], pa.string()),
            ], [key, *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    return docs.select(key, text).mapInArrow(
        summed, f"{key} {kind}, " + ", ".join(f"n_{k} bigint" for k in BASE) + ", base_sha256 string, spans string")
