"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, schemes, digits and
plus signs, colons, and identifier cues in any case. Small local parsers then expand from each
anchor to the boundaries of an email, address or number and validate it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitlens.llm.common import released, slices_by_chars

#: Characters of texts that are searched at a time.
BATCH_CHARS = 1_000_000

BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds in the order that breaks ties between spans with one start.
KINDS = (*BASE_KINDS, "iban", "ssn", "account", "secret", "login_url", "ipv6")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_NUMBER_RUN = re.compile(r"[0-9 ().+-]")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# cue word -> kind and the value that follows it (optionally after : = # or a short word)
_LINK = r"[\x20\t]{0,3}(?:(?:no|nr|number|num|key|id)\b\.?)?[\x20\t]{0,3}[:=#]?[\x20\t]{0,3}[\"']?"
_VALUES = {
    "account": (re.compile(_LINK + r"([0-9](?:[\x20-]?[0-9]){5,19})(?![0-9A-Za-z])", re.I | re.A),
                ("account", "acct", "konto", "compte", "cuenta", "passport")),
    "ssn": (re.compile(_LINK + r"((?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9])", re.I | re.A),
            ("ssn", "social security")),
    "secret": (re.compile(r"[\x20\t]{0,3}[:=][\x20\t]{0,3}[\"']?([A-Za-z0-9_./+=-]{8,})", re.I | re.A),
               ("password", "passwd", "secret", "token", "api_key", "apikey", "api key")),
}
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", re.A)
_IBAN_CUED = re.compile(r"[\x20\t]{0,3}:?[\x20\t]{0,3}(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}))", re.I | re.A)
_KEY_ID = re.compile(r"(AKIA|ASIA)[0-9A-Z]{16}(?![0-9A-Za-z])")
_LOGIN_URL = re.compile(r"://([^\s/?#@:]+:[^\s/?#@]+)@")
_SCHEME = re.compile(r"[A-Za-z0-9+.-]")
_IPV6 = re.compile(r"[0-9A-Fa-f:.]")


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for c in "0123456789+":
        found.add_word(c, ("number", 1))
    found.add_word("@", ("email", 1))
    found.add_word("://", ("scheme", 3))
    found.add_word(":", ("ipv6", 1))
    found.add_word("iban", ("iban", 4))
    for c in ("akia", "asia"):
        found.add_word(c, ("key", 4))
    for kind, (_, cues) in _VALUES.items():
        for cue in cues:
            found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


_ANCHORS = None
_UPPER, _LOWER = (bytes(range(a, a + 26)) for a in (65, 97))


def lower_ascii(text: str) -> str:
    """``text`` with A-Z in lower case: as long as before, so places in it are places in the text."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").translate(bytes.maketrans(_UPPER, _LOWER)).decode("utf-8", "surrogatepass")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _expand(text: str, a: int, b: int, inside: re.Pattern, low: int = 0) -> tuple[int, int]:
    while a > low and inside.match(text, a - 1):
        a -= 1
    n = len(text)
    while b < n and inside.match(text, b):
        b += 1
    return a, b


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _numbers(text: str, a: int, b: int) -> Iterator[tuple[str, int, int]]:
    """ip, card and phone matches in a run of number characters that no match can leave."""
    for m in _IP.finditer(text, a, b):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text, a, b):
        if 12 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    for m in _PHONE.finditer(text, a, b):
        if 9 <= len(_digits(m.group())) <= 15:
            yield "phone", m.start(), m.end()


def _iban(text: str, a: int, b: int) -> int | None:
    """End of the longest IBAN from ``a`` that ends no later than ``b``, not inside a word."""
    value = text[a:b].replace(" ", "").upper()
    while len(value) >= 15:
        if not text[b:b + 1].isalnum() and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1:
            return b
        value = value[:-1]
        b -= 1 + (text[b - 2] == " ")
    return None


def _ipv6(value: str) -> bool:
    import ipaddress
    try:
        return ipaddress.ip_address(value).version == 6 and len(value) > 4
    except ValueError:
        return False


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of a text in code points, sorted by start, then kind."""
    global _ANCHORS
    if not text:
        return []
    _ANCHORS = _ANCHORS or _automaton()
    found: set[tuple[str, int, int]] = set()
    number_end = email_end = v6_end = 0
    for last, (kind, size) in _ANCHORS.iter(lower_ascii(text)):
        at, end = last + 1 - size, last + 1
        if kind == "number":
            if at >= number_end:
                a, number_end = _expand(text, at, end, _NUMBER_RUN, number_end)
                found.update(_numbers(text, a, number_end))
                # two letters at a word's start before the digits: an account number that has no cue
                if (at > 1 and (m := _IBAN.match(text, at - 2)) and not text[at - 3:at - 2].isalnum()
                        and (b := _iban(text, at - 2, m.end()))):
                    found.add(("iban", at - 2, b))
        elif kind == "email":
            a, _ = _expand(text, at, at, _LOCAL, email_end) if at > email_end else (at, at)
            if a < at and (m := _DOMAIN.match(text, end)):
                found.add(("email", a, m.end()))
                email_end = m.end()
        elif kind == "scheme":
            if m := _LOGIN_URL.match(text, at):
                a, _ = _expand(text, at, at, _SCHEME, max(0, at - 12))
                found.add(("login_url", a, m.end()))
        elif kind == "ipv6":
            if at >= v6_end:
                a, v6_end = _expand(text, at, end, _IPV6, v6_end)
                b = v6_end
                while b > a and (text[b - 1] == "." or text[b - 1] == ":" and text[b - 2:b] != "::"):
                    b -= 1
                if text[a:a + 1] == ":" and text[a:a + 2] != "::":
                    a += 1
                if b - a <= 45 and _ipv6(text[a:b]) and not (a and text[a - 1].isalnum()) and not text[b:b + 1].isalnum():
                    found.add(("ipv6", a, b))
        elif kind == "key":
            if (m := _KEY_ID.match(text, at)) and not (at and text[at - 1].isalnum()):
                found.add(("secret", m.start(), m.end()))
        elif kind == "iban":
            if (m := _IBAN_CUED.match(text, end)) and (b := _iban(text, m.start(1), m.end(1))):
                found.add(("iban", m.start(1), b))
        elif m := _VALUES[kind][0].match(text, end):
            value = m.group(1)
            if kind != "secret" or any(c.isdigit() for c in value):
                found.add((kind, m.start(1), m.start(1) + len(value.rstrip("."))))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redacted(text: str | None) -> str | None:
    """The text with each span, merged where they overlap, replaced by ``[KIND]`` of its first."""
    if not text or not (spans := spans_of(text)):
        return text
    parts, at, i = [], 0, 0
    while i < len(spans):
        kind, a, b = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < b:
            b = max(b, spans[i][2])
            i += 1
        parts += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join((*parts, text[at:]))


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, digest of the base spans, all spans.

    Null and empty texts have no spans (digest of the empty string, spans '').
    Null keys and repeated rows are kept; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [spans_of(t) for t in batch.column(1).to_pylist()]
            base = [[s for s in spans if s[0] in BASE_KINDS] for spans in every]
            counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in BASE_KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts,
                 pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
                 pa.array([joined(s) for s in every], pa.string())],
                [key, *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans"])

    rows = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(run, f"`{key}` {dict(docs.dtypes)[key]}, "
                           + ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string")


def redact(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with the spans of each text replaced; ``n_chars``, if there, counts the new text.

    Every row stays: null and empty texts, texts without spans, null keys and
    repeated rows as they are, other columns unchanged.
    """
    at = docs.columns.index(text)
    size = docs.columns.index(n_chars) if n_chars in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices_by_chars(whole, at, BATCH_CHARS):
                old = batch.column(at).to_pylist()
                new = [redacted(t) for t in old]
                columns = list(batch.columns)
                columns[at] = pa.array(new, batch.schema.field(at).type)
                if size is not None:
                    columns[size] = pa.array([n if a == b else len(b) for a, b, n in
                                              zip(old, new, batch.column(size).to_pylist())],
                                             batch.schema.field(size).type)
                del old, new
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(released(run), docs.schema)
