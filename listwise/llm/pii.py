"""Personal data: expressions propose spans, checksums confirm them, words nearby move the score.

Base kinds (``email``, ``ip``, ``card``, ``phone``) are always kept once their check passes; added
kinds need a score of at least ``threshold``: an ``iban`` passes mod 97 and has it unless words speak against it, a bank's
``routing`` number passes its weighted sum and a ``secret`` looks random, and both need a word that speaks for them; a
secret that carries a checksum of its own needs none. Every scan takes time in proportion to the
text: a local part is read back from its ``@``, and digit runs are entered only at their start.
"""

import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "routing", "secret")
SPAN = "kind string, start int, end int, score double"
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                             ("score", pa.float64())]))

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
#: What may follow the first four characters: groups of four, the last one shorter.
_GROUPS = re.compile(r"(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?")
_ROUTING = re.compile(r"(?<![0-9A-Za-z])[0-9]{9}(?![0-9A-Za-z])")
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9])")
#: Tokens whose last six characters are the crc32 of the rest after the prefix, in base 62.
_CHECKED = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}$")
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_WORD_CHAR = re.compile(r"[A-Za-z0-9]")
#: Characters of an IBAN by country; of other countries any length may be.
IBAN_SIZE = {x[:2]: int(x[2:]) for x in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 "
    "FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 "
    "ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 "
    "SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20").split()}

CONTEXT_CHARS = 40
CONTEXT = {
    "email": ({"mail", "email", "contact", "write", "reply"}, {"example", "git"}),
    "ip": ({"ip", "host", "server", "address", "client"}, {"version", "release", "section"}),
    "card": ({"card", "visa", "mastercard", "amex", "credit", "debit", "payment"}, {"isbn", "order", "serial", "tracking"}),
    "phone": ({"phone", "tel", "telephone", "call", "mobile", "fax"}, {"version", "sum", "score"}),
    "iban": ({"iban", "bank", "account", "transfer", "konto"}, {"serial", "part", "hash"}),
    "routing": ({"routing", "aba", "transit", "rtn", "wire"}, {"serial", "isbn", "order"}),
    "secret": ({"token", "secret", "key", "apikey", "password", "passwd", "bearer", "auth", "authorization", "credential", "credentials"},
               {"sha", "digest", "hash", "checksum", "commit", "uuid", "etag", "integrity"}),
}
START = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.7, "routing": 0.4, "secret": 0.4}
#: The score of a secret that its own checksum confirms, whatever stands nearby.
CHECKED = 0.95
_WORD = re.compile(r"[A-Za-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of an IBAN without spaces."""
    moved = iban[4:] + iban[:4]
    return 15 <= len(iban) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text):
    over = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > over and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            over = m.end()
            yield start, over


def _ips(text):
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        if all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts):
            yield m.span()


def _cards(text):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text):
    for m in _PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            yield m.span()


def _ibans(text):
    """Ends at the country's length, else the longest end at which the check holds; words that only look like further groups are left out.

    An end lies where no letter or digit follows; groups are at most 34 characters, so each start has
    a bounded number of ends. A start inside a span found before is part of it.
    """
    over = 0
    for m in _IBAN.finditer(text):
        start = m.start()
        if start < over or not (groups := _GROUPS.match(text, m.end())):
            continue
        size = IBAN_SIZE.get(text[start:start + 2])
        for end in range(groups.end(), m.end() + 7, -1):
            if text[end - 1] != " " and not _WORD_CHAR.match(text, end):
                whole = text[start:end].replace(" ", "")
                if size in (None, len(whole)) and mod97(whole):
                    over = end
                    yield start, end
                    break


def routing(digits: str) -> bool:
    """The check of a bank routing number: a prefix in use, and the sum with weights 3, 7, 1."""
    prefix = int(digits[:2])
    used = prefix <= 12 or 21 <= prefix <= 32 or 61 <= prefix <= 72 or prefix == 80
    return used and digits != "000000000" and sum(int(d) * w for d, w in zip(digits, (3, 7, 1) * 3)) % 10 == 0


def _routings(text):
    for m in _ROUTING.finditer(text):
        if routing(m.group()):
            yield m.span()


def checked_token(token: str) -> bool:
    if not _CHECKED.match(token):
        return False
    rest, value = zlib.crc32(token[4:-6].encode()), 0
    for c in token[-6:]:
        value = value * 62 + _BASE62.index(c)
    return value == rest


def _secrets(text):
    """Long runs that look random: letters and digits mixed, of ten characters or more."""
    for m in _SECRET.finditer(text):
        run = set(m.group())
        if len(run) >= 10 and _DIGIT.search(m.group()) and _WORD.search(m.group()):
            yield m.span()


FINDERS = (("email", "@", _emails), ("ip", ".", _ips), ("card", "", _cards), ("phone", "+", _phones), ("iban", "", _ibans),
           ("routing", "", _routings), ("secret", "", _secrets))
_DIGIT = re.compile("[0-9]")


def scored(text: str, kind: str, start: int, end: int) -> float:
    """The score of a confirmed span, moved by words just before and after it."""
    if kind == "secret" and checked_token(text[start:end]):
        return CHECKED
    near = set(w.lower() for w in _WORD.findall(text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]))
    good, bad = CONTEXT[kind]
    return round(min(1.0, max(0.0, START[kind] + 0.2 * bool(near & good) - 0.3 * bool(near & bad))), 3)


def spans_of(text: str | None, threshold: float = 0.5) -> list[dict]:
    """All spans of one text by start, then kind; none for null."""
    if not text:
        return []
    digits = _DIGIT.search(text) is not None
    out = []
    for order, (kind, needs, find) in enumerate(FINDERS):
        if (digits or kind == "email") and needs in text:
            for start, end in find(text):
                score = scored(text, kind, start, end)
                if kind in BASE or score >= threshold:
                    out.append((start, order, kind, end, score))
    return [{"kind": k, "start": s, "end": e, "score": x} for s, _, k, e, x in sorted(out)]


def find_pii(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per input row: the key and ``spans``, an array of (kind, start, end, score).

    Positions are code points, ``end`` exclusive. A null or empty text has an empty array, repeated
    rows are answered each, a null key stays null, and no other column is read, so names cannot clash.
    Nothing is shuffled; a task holds one Arrow batch.
    """
    kind = df.schema[key].dataType.simpleString()

    def scan(batches):
        for batch in batches:
            found = [spans_of(t, threshold) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _ARROW)], names=["key", "spans"])

    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return (source.mapInArrow(scan, f"key {kind}, spans array<struct<{SPAN.replace(' string', ':string').replace(' int', ':int').replace(' double', ':double')}>>")
            .withColumnRenamed("key", key))
