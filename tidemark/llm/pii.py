"""Personal data: patterns propose spans, checksums confirm them, nearby words move the score.

Null and empty texts have no spans. Spans of one kind never overlap; kinds may.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds of the base contract, in their fixed order, then those the method adds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin at the start of a run of digits, so the look-behind changes nothing
# but the time spent on long runs.
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")

#: Confidence of a span by kind before the words around it are read. Fixed values.
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.3}
#: Words that raise (1) or lower (-1) confidence when they stand near a span. Fixed values.
CONTEXT = {
    "email": {"mail": 1, "email": 1, "contact": 1, "example": -1, "noreply": -1},
    "ip": {"ip": 1, "address": 1, "host": 1, "server": 1, "login": 1, "version": -1, "release": -1},
    "card": {"card": 1, "visa": 1, "credit": 1, "payment": 1, "paid": 1, "order": -1, "id": -1},
    "phone": {"phone": 1, "call": 1, "tel": 1, "mobile": 1, "fax": 1, "score": -1},
    "iban": {"iban": 1, "bank": 1, "account": 1, "transfer": 1},
    "ssn": {"ssn": 1, "social": 1, "security": 1, "taxpayer": 1, "part": -1, "serial": -1},
}
#: How far around a span context words count, in characters, and what each is worth.
CONTEXT_CHARS, CONTEXT_STEP = 40, 0.15
#: A weak kind becomes a span only from this confidence on.
LEAST_SCORE = 0.4

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if place % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(compact: str) -> bool:
    """Whether country, check digits and account agree (remainder 1)."""
    turned = compact[4:] + compact[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    taken = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > taken and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            taken = m.end()
            yield start, taken


def _confirmed(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end
    if _DIGIT.search(text) is None:
        return
    for m in _IP.finditer(text):
        parts = (m.group(0).split(".", 1)[0], *m.groups())
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        digits = _digits(m.group(0))
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m.group(0))) <= 15:
                yield "phone", m.start(), m.end()
    for m in _IBAN.finditer(text):
        compact = m.group(0).replace(" ", "")
        if 15 <= len(compact) <= 34 and mod97(compact):
            yield "iban", m.start(), m.end()
    for m in _SSN.finditer(text):
        area, group, serial = m.group(0).split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", m.start(), m.end()


def score_span(text: str, kind: str, start: int, end: int) -> float:
    around = f"{text[max(0, start - CONTEXT_CHARS):start]} {text[end:end + CONTEXT_CHARS]}"
    words = set(re.findall(r"[a-z]+", around.lower()))
    step = sum(sign for word, sign in CONTEXT[kind].items() if word in words)
    return round(min(1.0, max(0.0, PRIOR[kind] + CONTEXT_STEP * step)), 2)


def spans_of(text: str | None) -> list[Span]:
    """(kind, start, end, score) by kind, then start; code points, end exclusive."""
    out = []
    for kind, start, end in _confirmed(text or ""):
        score = score_span(text, kind, start, end)
        if kind in BASE_KINDS or score >= LEAST_SCORE:
            out.append((kind, start, end, score))
    return sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


def masked(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind; of overlapping ones the earlier, longer."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in spans)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id and ``spans``, an array of (kind, start, end, score)."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        kind = pa.list_(
            pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        )
        for batch in batches:
            found = [spans_of(t.as_py()) for t in batch.column(1)]
            rows = [[dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in x] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    key = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run, f"doc_id {key}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"
    )


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """The contract of ``op8``: counts, digest of the base spans, all spans, their best score."""
    found = find_personal_data(docs)
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    of = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.concat_ws(",", F.transform(base, text)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", text)).alias("spans"),
        F.array_max(F.transform("spans", lambda s: s["score"])).alias("best_score"),
    )


def mask_personal_data(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``; confirmed spans in the text become ``<kind>``."""

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [masked(t, spans_of(t)) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
