"""Personal data (operator 2): patterns propose, checksums confirm, context adjusts.

Base kinds and their rules are fixed by the contract; each pattern below matches exactly
what its plain form matches, leftmost and non-overlapping, but in time linear in the text
(an e-mail is grown from its ``@``; digit runs are taken possessively from their start).

Further kinds the method adds: ``iban`` (mod-97 must be 1), ``ssn`` and ``secret``. Every
proposal starts from its kind's prior; a passed checksum and nearby context words raise
its score, a counter-indicating word lowers it, and added kinds need ``MIN_SCORE``. Base
kinds are kept whatever their score, as the contract asks.

Defined results: a null or empty text has no spans; ties between kinds are kept as
overlapping spans of both kinds; rows are independent, so repeated rows repeat their
result; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from starmart.llm.textkit import arrow_map

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "secret")
MIN_SCORE = 0.6
WINDOW = 40                    # characters on either side searched for context words

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2})[0-9]{2}")
#: The length of an IBAN by country code (public registry of ISO 13616).
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
SECRET = re.compile(r"(?i:\b(?:token|api[_-]?key|secret|passw(?:or)?d|access[_-]?key)\b)[ \t]{0,3}[=:][ \t]{0,3}[\"']?([A-Za-z0-9_/+=-]{12,})")
#: Credentials that their issuers mark: a fixed prefix and length, or the line before a key.
MARKED = re.compile(r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}"
                    r"|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----)(?![A-Za-z0-9])")
DIGIT = re.compile(r"[0-9]")

# kind: (prior, words that raise the score, words that lower it)
CONTEXT = {
    "email": (0.9, ("mail", "contact", "write"), ()),
    "ip": (0.6, ("ip", "host", "server", "address"), ("version", "release", "section")),
    "card": (0.4, ("card", "visa", "credit", "payment", "amex"), ("isbn", "order", "serial")),
    "phone": (0.7, ("phone", "tel", "call", "mobile", "fax"), ("version",)),
    "iban": (0.3, ("iban", "account", "bank", "konto", "compte", "cuenta"), ()),
    "ssn": (0.4, ("ssn", "social", "security"), ("part", "model", "serial", "order")),
    "secret": (0.6, (), ("example", "placeholder")),
}
CHECKED = {"card", "iban"}     # kinds confirmed by a checksum: +0.4


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i & 1:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(code: str) -> bool:
    code = code.replace(" ", "")
    code = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in code)) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Spans of ``local@label(.label)+``: from each ``@`` the local part is grown to the
    left, never into the previous match, and the domain is matched to the right."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > done and LOCAL.match(text, lo - 1):
            lo -= 1
        m = DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append((lo, m.end()))
        done = m.end() if m else at + 1      # no match can cross an '@'
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's spans, by kind in their order, then by start."""
    out = [("email", a, z) for a, z in emails(text)] if "@" in text else []
    if DIGIT.search(text) is None:
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        n = m.end() - m.start()
        if 13 <= n <= 37:                      # 19 digits with a separator between each
            d = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def ibans(text: str) -> list[tuple[int, int]]:
    """Spans that start with a country code and two digits, have that country's length
    (single blanks between characters not counted) and pass mod-97."""
    out = []
    for m in IBAN.finditer(text):
        left, at = IBAN_LENGTH.get(m.group(1), 0) - 4, m.end()
        while left > 0 and at < len(text):
            if text[at] == " " and at + 1 < len(text) and text[at - 1] != " ":
                at += 1
            c = text[at]
            if not ("0" <= c <= "9" or "A" <= c <= "Z"):
                break
            left, at = left - 1, at + 1
        ends = at == len(text) or not (text[at].isascii() and text[at].isalnum())
        if left == 0 and ends and mod97(text[m.start():at]):
            out.append((m.start(), at))
    return out


def added_spans(text: str) -> list[tuple[str, int, int]]:
    """Proposals of the further kinds, before their score is taken."""
    out = []
    if DIGIT.search(text) is not None:
        out += [("iban", a, z) for a, z in ibans(text)]
        for m in SSN.finditer(text):
            area, group, serial = m.group().split("-")
            if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
                out.append(("ssn", m.start(), m.end()))
    if "=" in text or ":" in text:
        out += [("secret", m.start(1), m.end(1)) for m in SECRET.finditer(text)]
    if "-" in text or "_" in text or "AKIA" in text or "eyJ" in text:
        have = {(a, z) for k, a, z in out if k == "secret"}
        out += [("secret", m.start(), m.end()) for m in MARKED.finditer(text) if not any(a < m.end() and m.start() < z for a, z in have)]
    return out


def span_score(text: str, kind: str, start: int, end: int) -> float:
    """Prior of the kind, +0.4 for a passed checksum, +-0.3 for nearby context words."""
    prior, up, down = CONTEXT[kind]
    score = prior + 0.4 * (kind in CHECKED)
    near = (text[max(0, start - WINDOW):start] + " " + text[end:end + WINDOW]).lower()
    words = set(re.findall(r"[a-z]+", near))
    score += 0.3 * bool(words & set(up)) - 0.3 * bool(words & set(down))
    return min(1.0, max(0.0, score))


def find_spans(text: str | None) -> tuple[list, list]:
    """(base spans, all spans with scores) of one whole text."""
    if not text:
        return [], []
    base = base_spans(text)
    scored = [(k, a, z, span_score(text, k, a, z)) for k, a, z in base]
    for k, a, z in added_spans(text):
        s = span_score(text, k, a, z)
        if s >= MIN_SCORE:
            scored.append((k, a, z, s))
    return base, scored


def redact(text: str | None, spans) -> str | None:
    """The text with every span replaced by ``<KIND>``; overlapping spans become one,
    named after the one that starts first (the longest of those)."""
    if not text or not spans:
        return text
    merged: list[list] = []
    for k, a, z, *_ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], z)
        else:
            merged.append([k, a, z])
    out, at = [], 0
    for k, a, z in merged:
        out += [text[at:a], f"<{k.upper()}>"]
        at = z
    return "".join(out) + text[at:]


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z, *_ in spans)


def scan_batches(batches):
    """Worker: (doc_id, text) to one row of counts, digest, spans and scores a text."""
    for b in batches:
        rows = []
        for text in b.column("text").to_pylist():
            base, scored = find_spans(text)
            n = [sum(k == kind for k, *_ in base) for kind in BASE_KINDS]
            rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(scored),
                         ",".join(f"{s[3]:.2f}" for s in scored)))
        cols = list(zip(*rows)) or [()] * 7
        yield pa.record_batch(
            [b.column("doc_id")] + [pa.array(c, pa.int64()) for c in cols[:4]]
            + [pa.array(c, pa.string()) for c in cols[4:]],
            names=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "scores"])


def redact_batches(batches):
    """Worker: documents rows with their personal data replaced."""
    for b in batches:
        texts = [redact(t, find_spans(t)[1]) for t in b.column("text").to_pylist()]
        cols = {n: b.column(n) for n in b.schema.names}
        cols["text"] = pa.array(texts, pa.string())
        if "n_chars" in cols:
            cols["n_chars"] = pa.array([None if t is None else len(t) for t in texts], pa.int64())
        yield pa.record_batch(list(cols.values()), names=list(cols))


def detect(docs: DataFrame) -> DataFrame:
    """One row per document with its spans; one pass over the texts, no exchange."""
    schema = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
              "base_sha256 string, spans string, scores string")
    src = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return arrow_map(src, "starmart.llm.pii:scan_batches", schema)


def redacted(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with every detected span replaced in ``text`` and
    ``n_chars`` counted anew. No document is dropped."""
    src = docs.withColumn("n_chars", docs["n_chars"].cast("long")) if "n_chars" in docs.columns else docs
    return arrow_map(src, "starmart.llm.pii:redact_batches", src.schema)
