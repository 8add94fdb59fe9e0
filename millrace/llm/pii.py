"""Operator 9: personal data. Regular expressions propose spans, validators confirm them, nearby words score them.

Kinds email, ip, card, phone are the base: leftmost non-overlapping matches of their pattern per kind, those that
fail the check of the kind dropped without another try. Added kinds: iban (mod 97 is 1) and ssn (three groups of
digits that an authority could have issued, and a context word near by). Every span carries a score: what its kind
starts with, plus ``CONTEXT_BONUS`` if one of its context words stands within ``CONTEXT_CHARS`` before or after.

Defined cases: null and empty texts have no span; kinds are searched apart, so spans of two kinds may
overlap; repeated rows are each searched; null ids are carried along; other columns are left aside; an empty
table gives an empty result. Every search takes time in proportion to the text, whatever its words look like.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.spans import joined, over_texts, sha256

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
ORDER = {kind: i for i, kind in enumerate(KINDS)}
CONTEXT_CHARS = 40
CONTEXT_BONUS = 0.3
#: Score of a confirmed span without context.
SCORES = {"email": 0.7, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.7, "ssn": 0.2}
#: Spans of added kinds need this score.
THRESHOLD = 0.5
CONTEXT = {
    "email": ("mail", "contact", "write to", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "payment", "tarjeta", "carte", "karte"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social security"),
}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGITS = frozenset("0123456789")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP_CORE = re.compile(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){11,}")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")


def luhn(digits: str) -> bool:
    total = 0
    for i, char in enumerate(reversed(digits)):
        d = ord(char) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _run_start(text: str, end: int, least: int, allowed: frozenset) -> int:
    at = end
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def emails(text: str) -> list[tuple[int, int]]:
    """The leftmost start of a match is where the run before an @ starts, or where the match before ended."""
    found, after, at = [], 0, text.find("@")
    while at >= 0:
        start = _run_start(text, at, after, LOCAL)
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            after = domain.end()
            found.append((start, after))
        at = text.find("@", at + 1)
    return found


def ips(text: str) -> list[tuple[int, int]]:
    found, after = [], 0
    while core := IP_CORE.search(text, after):
        start = _run_start(text, core.start(), after, DIGITS)
        after = core.end()
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in text[start:after].split(".")):
            found.append((start, after))
    return found


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= sum(c in DIGITS for c in m.group()) <= 15]


def ibans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in IBAN.finditer(text) if mod97(m.group())]


def ssns(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in SSN.finditer(text) if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000"]


def score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS) : start].lower() + " " + text[end : end + CONTEXT_CHARS].lower()
    return SCORES[kind] + (CONTEXT_BONUS if any(word in near for word in CONTEXT[kind]) else 0.0)


def find(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text: (kind, start, end, score), base spans whatever their score."""
    spans: list[tuple[str, int, int]] = []
    if "@" in text:
        spans += [("email", *s) for s in emails(text)]
    spans += [("ip", *s) for s in ips(text)]
    spans += [("card", *s) for s in cards(text)]
    if "+" in text:
        spans += [("phone", *s) for s in phones(text)]
    spans += [("iban", *s) for s in ibans(text)]
    spans += [("ssn", *s) for s in ssns(text)]
    scored = [(*s, score(text, *s)) for s in spans]
    return [s for s in scored if s[0] in BASE or s[3] >= THRESHOLD]


def find_pii(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and the spans of each document as text: kind:start:end:score, comma-joined."""

    def row(text: str) -> tuple:
        ranked = sorted(find(text), key=lambda s: (s[1], ORDER[s[0]], s[2]))
        return (",".join(f"{k}:{a}:{b}:{p:.2f}" for k, a, b, p in ranked),)

    return over_texts(docs, columns, "pii string", row)


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, text) to doc_id, count per base kind, digest of the base spans, all spans as text."""

    def row(text: str) -> tuple:
        spans = find(text)
        base = [s for s in spans if s[0] in BASE]
        return (*[sum(s[0] == kind for s in base) for kind in BASE], sha256(joined(base, ORDER)), joined(spans, ORDER))

    counts = ", ".join(f"n_{kind} long" for kind in BASE)
    return over_texts(docs, ["doc_id"], f"{counts}, base_sha256 string, spans string", row)


def mask(text: str) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    for kind, start, end, _ in sorted(find(text), key=lambda s: (s[1], -s[2], ORDER[s[0]])):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*out, text[at:]]) if out else text


def redact(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` and ``text`` with all spans masked; a null text stays null."""
    flagged = docs.select(*columns, "text", F.col("text").isNull().alias("_gap"))
    out = over_texts(flagged.withColumnRenamed("_gap", "gap_"), [*columns, "gap_"], "masked string", lambda text: (mask(text),))
    return out.select(*columns, F.when(~F.col("gap_"), F.col("masked")).alias("text"))
