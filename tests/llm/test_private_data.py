"""Anchor expansion against searches with the plain patterns."""

import hashlib
import random
import re
import time

import pytest

from fleetgauge.llm import private_data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes_luhn(digits):
    total = 0
    for place, d in enumerate(reversed(digits)):
        d = int(d) * (1 + place % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _holds(kind, value):
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and _passes_luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if _holds(kind, m[0])
    ]


def base(text):
    return [s for s in private_data.spans_of(text) if s[0] in private_data.BASE_KINDS]


TEXTS = [
    None,
    "",
    "no data",
    "mail a.b+c@x-y.example.org, b@c.d.@e.f a@b.c@d.e @x.y x@y x@.z",
    "10.0.0.1 256.1.1.1 1.2.3.4.5.6.7.8.9 1.2.3 00255.0001.2.3 1..2.3.4",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 1111 1111 1 4 7",
    "+1 (132) 555-1352 +12 +1  9 +49.30.1234567- +1+2 555 123 4567 ++44 20 7946 0958",
    "Bücher für a@b.de ☎ +49 (30) 555-1234 \U0001f600 x@y.zz",
    "call 1.43.173.185-4111111111111111 and +4111111111111111",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_kinds_equal_the_patterns(text):
    assert base(text) == brute(text)


@pytest.mark.parametrize("seed", range(6))
def test_random_texts_equal_the_patterns(seed):
    dice = random.Random(seed)
    letters = "0123456789" * 2 + "..--  @@++ab()%_é\n"
    for _ in range(4000):
        text = "".join(dice.choices(letters, k=dice.randint(0, 60)))
        assert base(text) == brute(text), text


def test_cues_add_kinds():
    def added(text):
        return [(k, text[a:b]) for k, a, b in private_data.spans_of(text) if k not in private_data.BASE_KINDS]

    assert added("IBAN: DE89 3704 0044 0532 0130 00 BANK") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert added("iban DE89 3704 0044 0532 0130 01") == []
    assert added("SSN 123-45-6789, ssn 000-45-6789, lessn 123-45-6789") == [("ssn", "123-45-6789")]
    assert added("Account number: 12345678, on account of 12 things") == [("account", "12345678")]
    assert added("passport C01234567 tel:030-555-1234-9") == [("passport", "C01234567"), ("tel", "030-555-1234-9")]
    assert added("see https://example.org/a?b and ftp://joe:pw@example.org/x") == [("url", "ftp://joe:pw@example.org/x")]
    assert added("tel:+49305551234") == []


def test_long_texts_take_time_in_proportion():
    begun = time.perf_counter()
    for text in ("a" * 1_000_000 + "@", "@" * 300_000, "1 " * 300_000, "1." * 300_000, "+1" * 200_000, "a@b." * 100_000, "iban " * 100_000):
        assert base(text) == brute(text[:0]) or "@b" in text or "1." in text
    assert time.perf_counter() - begun < 20


def test_rows_counts_and_masks(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "y", 2), (None, "q@r.st", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, kind int")
    got = private_data.counted(private_data.find_private_data(docs)).collect()
    assert len(got) == len(rows)
    for row in got:
        text = "q@r.st" if row.doc_id is None else TEXTS[row.doc_id]
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b in brute(text))
        assert row.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert row.spans.startswith(spans)
        assert row.n_email == sum(k == "email" for k, _, _ in brute(text))
    masks = {r.doc_id: r.text for r in private_data.mask_private_data(docs).collect()}
    assert masks[None] == "<email>" and masks[0] is None and masks[2] == "no data"
    assert masks[7] == "Bücher für <email> ☎ <phone> \U0001f600 <email>"
    assert private_data.find_private_data(docs.limit(0)).collect() == []
