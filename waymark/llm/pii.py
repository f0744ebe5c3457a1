"""Operator 10, personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text in one scan: at-signs, plus signs, digits, URL schemes and cue words
for identifiers. From each anchor a small deterministic parser expands left and right to the boundaries of what the anchor
announces, and validates it:

* email: from the at-sign, local part to the left, labels to the right
* ip: from a digit, four groups joined by dots, each at most 255
* card: from a digit, digits with single spaces or hyphens, 16 to 19 of them, Luhn
* phone: from a plus sign, 8 to 15 digits among spaces, dots, hyphens and parentheses
* account: from a cue (iban, ssn, passport, account, token, secret, api key, password; in any case), over separators and filler words
  (number, no., is and the like) to an identifier: an IBAN with right check digits; after ssn, passport and account at least 8
  characters with 6 digits among them; after the cues for secrets that, or after a colon or an equals sign at least 8 characters
  to the next space or quote that aren't one plain word
* url: from a scheme, an address that names a user or a bare ip as its host

The first four are the base kinds and equal the leftmost non-overlapping matches of BASE; the last two are what the cues add.
Positions are code points, ends exclusive. Spans of different kinds may overlap; those of one kind don't.

Cases: null and empty texts hold none; texts of any length are scanned whole, each character by one expansion of a kind at most;
equal rows are scanned each; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import string
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import map_text, slices, texts

#: Fixed patterns of the base kinds.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*BASE, "account", "url")
CUES = ("iban", "ssn", "passport", "account", "acct", "token", "secret", "api_key", "apikey", "api key", "api-key", "password")
SCHEMES = ("http://", "https://", "ftp://", "ssh://")

_DIGITS = frozenset(string.digits)
_ALNUM = frozenset(string.ascii_letters + string.digits)
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_SEPARATOR = frozenset(" \t:=#\"'")
_IDENTIFIER = _ALNUM | frozenset("-_")
#: Words between a cue and what it announces.
FILLERS = frozenset(("number", "numbers", "no", "nr", "num", "nos", "id", "is", "was", "are", "key", "value", "code", "my", "the", "bearer"))
SECRETS = frozenset(("token", "secret", "api_key", "apikey", "api key", "api-key", "password"))
_SECRET_END = frozenset(" \t\r\n\v\f\"'`<>,;()[]{}")
#: Only ASCII, so that the length of a text and all positions stay.
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_URL_END = frozenset(" \t\r\n\v\f\"'<>")


def run_right(text: str, at: int, chars: frozenset) -> int:
    while at < len(text) and text[at] in chars:
        at += 1
    return at


def emails(text: str, anchors: list[int]) -> list[tuple[int, int]]:
    out, low = [], 0
    for a in anchors:
        start = a
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        stop = run_right(text, a + 1, _LABEL)
        if start == a or stop == a + 1:
            continue
        dots = 0
        while stop < len(text) and text[stop] == "." and (end := run_right(text, stop + 1, _LABEL)) > stop + 1:
            stop, dots = end, dots + 1
        if dots:
            out.append((start, stop))
            low = stop
    return out


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def ips(text: str, anchors: list[int]) -> list[tuple[int, int]]:
    out, low = [], 0
    for a in anchors:
        if a < low:
            continue
        ends = [run_right(text, a, _DIGITS)]
        starts = [a]
        while (e := ends[-1]) + 1 < len(text) and text[e] == "." and text[e + 1] in _DIGITS:
            starts.append(e + 1)
            ends.append(run_right(text, e + 1, _DIGITS))
        low = ends[-1]
        for k in range(0, len(starts) // 4 * 4, 4):
            if all(small(text[starts[i] : ends[i]]) for i in range(k, k + 4)):
                out.append((starts[k], ends[k + 3]))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def cards(text: str, anchors: list[int]) -> list[tuple[int, int]]:
    out, low = [], 0
    for a in anchors:
        if a < low:
            continue
        e = run_right(text, a, _DIGITS)
        while e + 1 < len(text) and text[e] in " -" and text[e + 1] in _DIGITS:
            e = run_right(text, e + 1, _DIGITS)
        low = e
        if e - a >= 16 and 16 <= len(digits := text[a:e].replace(" ", "").replace("-", "")) <= 19 and luhn(digits):
            out.append((a, e))
    return out


def phones(text: str, anchors: list[int]) -> list[tuple[int, int]]:
    out = []
    for a in anchors:
        if a + 1 < len(text) and text[a + 1] in _DIGITS:
            e = run_right(text, a + 2, _PHONE)
            while e > a + 2 and text[e - 1] not in _DIGITS:
                e -= 1
            if e >= a + 4 and 8 <= sum(c in _DIGITS for c in text[a:e]) <= 15:
                out.append((a, e))
    return out


def iban(s: str) -> bool:
    s = s.replace(" ", "").upper()
    return 15 <= len(s) <= 34 and s[:2].isalpha() and s[2:4].isdigit() and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def announced(text: str, at: int) -> tuple[int, bool]:
    """Where what a cue that ends at `at` announces begins, after separators and filler words, and whether a colon or an equals sign stands before it; the same place if nothing is announced."""
    if at < len(text) and text[at] == "s":  # a plural
        at += 1
    start, strong = at, False
    for _ in range(4):
        go = run_right(text, start, _SEPARATOR)
        if go == start or go - start > 8:
            return at, False
        strong = strong or ":" in text[start:go] or "=" in text[start:go]
        end = run_right(text, go, _ALNUM)
        if text[go:end].translate(_LOWER) not in FILLERS or end < len(text) and text[end] in "-_":
            return go, strong
        start = end + (end < len(text) and text[end] == ".")
    return at, False


def secret(s: str) -> bool:
    """At least 8 characters, not all of them letters of one word: digits, signs or capitals within."""
    classes = sum((any(c.islower() for c in s), any(c.isupper() for c in s[1:]), any(c.isdigit() for c in s), any(not c.isalnum() for c in s)))
    return len(s) >= 8 and classes >= 2 and any(c.isalnum() for c in s) and "://" not in s


def accounts(text: str, anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """anchors: starts and ends of cues."""
    out, low = [], 0
    for a, e in anchors:
        # a cue within a word is one only where a word of another form begins (myApiKey, db_password)
        if e < low or a and text[a - 1] in _ALNUM and not (text[a].isupper() and text[a - 1].islower()):
            continue
        start, strong = announced(text, e)
        if start == e or start >= len(text):
            continue
        stop = run_right(text, start, _IDENTIFIER)
        cue = text[a:e].translate(_LOWER)
        if cue == "iban":
            while stop + 1 < len(text) and text[stop] == " " and text[stop + 1] in _ALNUM and stop - start < 42 and not iban(text[start:stop]):
                stop = run_right(text, stop + 1, _ALNUM)
            if not iban(text[start:stop]):
                continue
        elif cue in SECRETS and strong:
            end = start
            while end < len(text) and text[end] not in _SECRET_END:
                end += 1
            while end > start and text[end - 1] in ".:!?":
                end -= 1
            if secret(text[start:end]):
                stop = end
            elif stop - start < 8 or sum(c in _DIGITS for c in text[start:stop]) < 6:
                continue
        elif stop - start < 8 or sum(c in _DIGITS for c in text[start:stop]) < 6:
            continue
        out.append((start, stop))
        low = stop
    return out


def urls(text: str, anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out, low = [], 0
    for a, e in anchors:
        if a < low:
            continue
        stop = e
        while stop < len(text) and text[stop] not in _URL_END:
            stop += 1
        while stop > e and text[stop - 1] in ".,;:!?)":
            stop -= 1
        authority = text[e:stop].replace("?", "/").replace("#", "/").partition("/")[0]
        host = authority.rpartition("@")[2].partition(":")[0].split(".")
        if "@" in authority or len(host) == 4 and all(p and p.isascii() and p.isdigit() and small(p) for p in host):
            out.append((a, stop))
        low = stop
    return out


@lru_cache(maxsize=1)
def _anchors():
    import ahocorasick

    found = ahocorasick.Automaton()
    for c in "@+" + string.digits:
        found.add_word(c, (c if c in "@+" else "0", 1))
    for kind, words in (("cue", CUES), ("scheme", SCHEMES)):
        for w in words:
            found.add_word(w, (kind, len(w)))
    found.make_automaton()
    return found


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, stop) by kind as in KINDS, then by start."""
    if not text:
        return []
    at: dict[str, list] = {"@": [], "+": [], "0": [], "cue": [], "scheme": []}
    for end, (kind, n) in _anchors().iter(text.translate(_LOWER)):
        at[kind].append(end if n == 1 else (end - n + 1, end + 1))
    out = []
    for kind, parse, where in (("email", emails, "@"), ("ip", ips, "0"), ("card", cards, "0"), ("phone", phones, "+"), ("account", accounts, "cue"), ("url", urls, "scheme")):
        if at[where]:
            out += [(kind, a, b) for a, b in parse(text, at[where])]
    return out


def redacted(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """text with each span replaced by its kind in brackets; overlapping spans are replaced as one, by the kind that starts first."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans, array of struct(kind, start, stop), for each row of docs. One narrow pass."""

    def make():
        def run(batch: list) -> dict:
            return {"spans": pa.array([[{"kind": k, "start": a, "stop": b} for k, a, b in find_spans(x)] for x in batch], _SPANS)}

        return run

    return map_text(texts(docs, id_col, text_col), make, "spans array<struct<kind:string,start:int,stop:int>>")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the personal data in text_col replaced by placeholders; all other columns and their order stay."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for lo, n in slices(batch.column(at)):
                part = batch.slice(lo, n)
                new = pa.array([redacted(x, find_spans(x)) for x in part.column(at).to_pylist()], batch.schema.field(at).type)
                yield pa.RecordBatch.from_arrays([new if i == at else part.column(i) for i in range(batch.num_columns)], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def spans_text(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end, comma-joined, of the spans of these kinds."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
