"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from cyclograph.llm.columns import named, others

# The base patterns. The look-behinds only spare hopeless starts inside a run.
_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
_EMAIL_HERE = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Further kinds.
_IBAN = re.compile(
    r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
)
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]

CONTEXT = {
    "email": re.compile(r"(?i)mail|contact|correo|kontakt"),
    "ip": re.compile(r"(?i)\bip\b|host|server|address|adresse|login"),
    "card": re.compile(r"(?i)card|visa|credit|carte|karte|tarjeta|payment"),
    "phone": re.compile(r"(?i)phone|\btel|call|mobile|telefon|teléfono|téléphone|handy|fax"),
    "iban": re.compile(r"(?i)iban|account|bank|konto|compte|cuenta"),
    "ssn": re.compile(r"(?i)\bssn\b|social|insurance|sécurité|seguro|versicherung"),
}
CONTEXT_CHARS = 48
CONTEXT_WEIGHT = 0.3
CHECKED, UNCHECKED = 0.7, 0.3
THRESHOLD = 0.5
"""A further span counts from this score on: with a valid checksum, or without one near its words."""


class Span(NamedTuple):
    start: int
    kind: str
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number, spaces removed, leaves 1 once its first four characters stand last."""
    rest = 0
    for c in account[4:] + account[:4]:
        value = int(c, 36)
        rest = (rest * (10 if value < 10 else 100) + value) % 97
    return rest == 1


def _emails(text: str) -> Iterator[re.Match]:
    at = 0
    while found := (_EMAIL_HERE.match(text, at) if at else None) or _EMAIL.search(text, at):
        yield found
        at = found.end()


def _valid_ip(found: str) -> bool:
    return all(len(part := p.lstrip("0")) <= 3 and int(part or "0") <= 255 for p in found.split("."))


def _digits(found: str) -> str:
    return re.sub("[^0-9]", "", found)


def _valid_card(found: str) -> bool:
    return 12 <= len(digits := _digits(found)) <= 19 and luhn(digits)


def proposals(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, whether a checksum or a range confirms it); failing matches are dropped."""
    if "@" in text:
        for m in _emails(text):
            yield "email", m.start(), m.end(), True
    for m in _IP.finditer(text):
        if _valid_ip(m[0]):
            yield "ip", m.start(), m.end(), True
    for m in _CARD.finditer(text):
        if 12 <= m.end() - m.start() and _valid_card(m[0]):
            yield "card", m.start(), m.end(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end(), True
    for m in _IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            yield "iban", m.start(), m.end(), True
    for m in _SSN.finditer(text):
        yield "ssn", m.start(), m.end(), False


def find_spans(text: str) -> list[Span]:
    """All spans in the order of start, then kind as listed in KINDS.

    Base spans always stay, with a score; the further kinds need THRESHOLD.
    """
    found = []
    for kind, start, end, checked in proposals(text):
        around = f"{text[max(0, start - CONTEXT_CHARS) : start]} {text[end : end + CONTEXT_CHARS // 2]}"
        score = (CHECKED if checked else UNCHECKED) + CONTEXT_WEIGHT * bool(CONTEXT[kind].search(around))
        if kind in BASE_KINDS or score >= THRESHOLD:
            found.append(Span(start, kind, end, round(score, 2)))
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def with_spans(df: DataFrame, text: str = "text", into: str = "pii") -> DataFrame:
    """Add an array of (kind, start, end, score), in code points, for every whole text.

    A null or empty text has no spans. Every row and other column stays; a column already
    named ``into``, whatever its case, is replaced.
    """

    @arrow_udf("array<struct<kind: string, start: bigint, end: bigint, score: double>>")
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array(
            [[{"kind": s.kind, "start": s.start, "end": s.end, "score": s.score} for s in find_spans(t)] for t in _texts(texts)],
            pa.list_(_SPAN),
        )

    return df.select(*others(df, [into]), spans(named(text)).alias(into))


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""


def digest(df: DataFrame, spans: str = "pii") -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, all spans as kind:start:end, and their scores."""
    told = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    of_kind = lambda kind: F.filter(spans, lambda s: s["kind"] == kind)
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    return df.select(
        "doc_id",
        *[F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.array_join(F.transform(base, told), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(spans, told), ",").alias("spans"),
        F.array_join(F.transform(spans, lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
