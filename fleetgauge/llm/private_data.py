"""Personal data by anchor expansion.

An Aho-Corasick automaton runs over each whole text once and finds anchors:
at-signs, plus signs before digits, digits, schemes and cue words. At each
anchor a parser walks outwards, as far as the characters of its kind go, and
checks what it has: labels of a host, parts of an address, check digits,
number of digits. Nothing but anchors is looked at, and every parser passes
over a character once, so a text of any length takes time in proportion.

Spans of the four base kinds are those that a left-to-right search for these
patterns finds, without overlaps within a kind, failing ones left out:

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, parts at most 255
* card ``[0-9]([\\x20-]?[0-9])+``, 13 to 19 digits that pass Luhn
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]``, 9 to 15 digits

Cues and schemes add further kinds, if they reach beyond the base spans:
account, iban, passport and ssn after a cue word, tel after ``tel:``, and url
for addresses that carry a user name. Cues are known in lower case, with a
capital and in capitals.

Defined results: a null or empty text has no spans. Every row has one result,
repeated rows and null ids too. Other columns are not read, so their names
can't clash. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.text import slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "iban", "passport", "ssn", "tel", "url")

CUES = {
    "account": ("account", "acct", "konto", "kontonummer", "compte", "cuenta"),
    "iban": ("iban",),
    "passport": ("passport", "passeport", "pasaporte", "reisepass"),
    "ssn": ("ssn", "social security"),
}
SCHEMES = ("http://", "https://", "ftp://", "ssh://")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_GROUPED = re.compile(r"[0-9](?:[\x20-]?[0-9])*+")
_DIALLED = re.compile(r"\+[0-9][\x20().0-9-]*+")
_ASIDE = r"(?:[\x20]?(?:number|no|nr|num)\b\.?)?[\x20:#=]{0,3}"
_ACCOUNT = re.compile(_ASIDE + r"([0-9](?:[\x20-]?[0-9]){5,16})(?![0-9A-Za-z])")
_IBAN = re.compile(_ASIDE + r"([A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30})(?![0-9A-Za-z])")
_PASSPORT = re.compile(_ASIDE + r"([A-Z]{0,2}[0-9]{7,9})(?![0-9A-Za-z])")
_SSN = re.compile(_ASIDE + r"([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9A-Za-z-])")
_TEL = re.compile(r"[0-9][().0-9-]{5,24}")
_USER = re.compile(r"[^\s/?#@<>\"']{1,256}@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++[^\s<>\"']*+")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _addresses(text: str, start: int, stop: int) -> Iterator[Span]:
    """Each four parts of a run of numbers and dots, if they make an address."""
    parts, at = text[start:stop].split("."), start
    for k in range(0, len(parts) - 3, 4):
        four = parts[k : k + 4]
        end = at + len(".".join(four))
        if all(len(p.lstrip("0")) < 3 or len(p.lstrip("0")) == 3 and int(p) <= 255 for p in four):
            yield at, end
        at = end + 1


def _card(text: str, start: int, stop: int) -> bool:
    if stop - start > 37:
        return False
    digits = _only_digits(text[start:stop])
    return 13 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, start: int) -> Span | None:
    found = _DIALLED.match(text, start)
    dialled = found[0].rstrip(" ().-") if found else ""
    # A sign, a digit, something, a digit.
    if len(dialled) >= 4 and 9 <= len(_only_digits(dialled)) <= 15:
        return start, start + len(dialled)
    return None


def _iban_holds(value: str) -> bool:
    plain = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _ssn_holds(value: str) -> bool:
    area, group, serial = value.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _after_cue(kind: str, text: str, stop: int) -> Span | None:
    pattern = {"account": _ACCOUNT, "iban": _IBAN, "passport": _PASSPORT, "ssn": _SSN}[kind]
    found = pattern.match(text, stop)
    if not found:
        return None
    if kind == "iban":
        # Words in capitals may follow; the longest part that holds is meant.
        value = found[1]
        while len(value.replace(" ", "")) >= 15 and not _iban_holds(value):
            value = value[:-1].rstrip(" ")
        if len(value.replace(" ", "")) < 15:
            return None
        return found.start(1), found.start(1) + len(value)
    if kind == "ssn" and not _ssn_holds(found[1]):
        return None
    return found.span(1)


def _expanded(kind: str, text: str, start: int, stop: int) -> Span | None:
    """What a scheme or cue at start:stop leads to."""
    if kind == "url":
        found = _USER.match(text, stop)
        return (start, found.end()) if found else None
    if start and text[start - 1].isalnum():
        return None
    if kind == "tel":
        found = _TEL.match(text, stop)
        dialled = found[0].rstrip(".-()") if found else ""
        return (stop, stop + len(dialled)) if 9 <= len(_only_digits(dialled)) <= 15 else None
    if text[stop : stop + 1].isalnum():
        return None
    return _after_cue(kind, text, stop)


@cache
def _anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    automaton.add_word("@", ("email", 1))
    for digit in "0123456789":
        automaton.add_word(digit, ("digit", 1))
        automaton.add_word("+" + digit, ("phone", 2))
    named = [(kind, cue) for kind, cues in CUES.items() for cue in cues]
    named += [("url", scheme) for scheme in SCHEMES] + [("tel", "tel:")]
    for kind, cue in named:
        for form in (cue, cue.capitalize(), cue.upper()):
            automaton.add_word(form, (kind, len(cue)))
    automaton.make_automaton()
    return automaton


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all personal data in a text, by kind and start."""
    base: list[tuple[str, int, int]] = []
    more: list[tuple[str, int, int]] = []
    email_from = email_end = dotted_end = grouped_end = 0
    for last, (kind, length) in _anchors().iter(text) if text else ():
        start = last + 1 - length
        if kind == "digit":
            if start >= dotted_end:
                dotted_end = _DOTTED.match(text, start).end()
                base += (("ip", a, b) for a, b in _addresses(text, start, dotted_end))
            if start >= grouped_end:
                grouped_end = _GROUPED.match(text, start).end()
                if _card(text, start, grouped_end):
                    base.append(("card", start, grouped_end))
        elif kind == "email":
            left = max(email_from, email_end)
            begin = left + len(text[left:start].rstrip(_LOCAL))
            email_from = start + 1
            if begin < start and (host := _HOST.match(text, start + 1)):
                email_end = host.end()
                base.append(("email", begin, email_end))
        elif kind == "phone":
            if span := _phone(text, start):
                base.append(("phone", *span))
        elif span := _expanded(kind, text, start, last + 1):
            more.append((kind, *span))
    found = set(base)
    if more:
        found.update(_beyond(more, base))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _beyond(more: list, base: list) -> Iterator[tuple[str, int, int]]:
    """Spans that don't lie within one base span."""
    widest, reach = [], -1
    for _, a, b in sorted(base, key=lambda s: (s[1], -s[2])):
        if b > reach:
            widest.append((a, b))
            reach = b
    at = 0
    for span in sorted(more, key=lambda s: (s[1], s[2])):
        while at + 1 < len(widest) and widest[at + 1][0] <= span[1]:
            at += 1
        inside = widest and widest[at][0] <= span[1] and span[2] <= widest[at][1]
        if not inside:
            yield span


SPANS = "array<struct<kind: string, start: long, stop: long>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            spans = [
                [{"kind": k, "start": a, "stop": b} for k, a, b in spans_of(text.as_py())]
                for text in part.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(spans, pa.list_(_SPAN))], names=["doc_id", "spans"]
            )


def find_private_data(docs: DataFrame) -> DataFrame:
    """doc_id and spans of every document; texts stay where they are."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(_found, f"doc_id long, spans {SPANS}")


def _masked(text: str | None) -> str | None:
    if text is None:
        return None
    out, done = [], 0
    for kind, start, stop in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += (text[done:start], f"<{kind}>")
        done = max(done, stop)
    return "".join(out) + text[done:]


def mask_private_data(docs: DataFrame) -> DataFrame:
    """doc_id and text, each span replaced by its kind in angle brackets, overlapping ones by one."""

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = pa.array([_masked(t.as_py()) for t in part.column("text")], pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), texts], names=["doc_id", "text"])

    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(masked, "doc_id long, text string")


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.stop)), ",")


def counted(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as one text."""

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s.kind.isin(*kinds))

    base = of(*BASE_KINDS)
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
