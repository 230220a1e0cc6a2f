"""Resampling and the radix sort against plain sorting of all rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fleetgauge.llm import radix_sort, resampling

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _features(text, longest=1):
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    words = re.findall(WORD, lower)
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute(docs, target, percent=10, longest=1):
    s = Counter(b for _, t in docs for b in _features(t, longest)[1])
    t = Counter(b for x in target for b in _features(x, longest)[1])
    held, aimed = sum(s.values()), sum(t.values())
    rows = []
    for i, text in docs:
        words, buckets = _features(text, longest)
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1) * (held + 10000) / ((s[b] + 1) * (aimed + 10000)))) for b in buckets
        )
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        luck = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(buckets), weight, weight + luck, None, len(words)])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.fixture(scope="module")
def tables(spark):
    dice = random.Random(3)
    words = ["alpha", "Beta", "gamma9", "Überß", "日本", "delta-x", "42", "e" * 90]
    texts = [" ".join(dice.choices(words, k=dice.randint(15, 60))) for _ in range(300)]
    docs = list(enumerate(texts)) + [(300, None), (301, ""), (302, " !?\x00\x7f "), (5, texts[5]), (None, texts[6])]
    docs += [(400 + i, "Beta " * 30) for i in range(150)] + [(900, "gamma9, " * 50_000)]
    target = ["gamma9 42 alpha " * 5, None, "", "日本 über"]
    frame = spark.createDataFrame(
        [(i, t, "x", 7) for i, t in docs], "doc_id long, text string, score string, rank int"
    )
    aim = spark.createDataFrame([(i, t, 0) for i, t in enumerate(target)], "item_id long, text string, bucket int")
    return docs, target, frame, aim


@pytest.mark.parametrize("longest, percent", [(1, 10), (3, 37)])
def test_equals_sorting_all_rows(tables, longest, percent):
    docs, target, frame, aim = tables
    got = resampling.resample(frame, aim, percent=percent, longest=longest)
    got = got.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, target, percent, longest)


def test_empty_tables(tables, spark):
    docs, _, frame, aim = tables
    assert resampling.resample(frame.limit(0), aim).collect() == []
    got = resampling.resample(frame, aim.limit(0)).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, [])


def test_crc_of_spans():
    words = [b"", b"a", b"abc" * 7, "ü日".encode(), b"x" * 64, b"y" * 65, b"z" * 9000]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    assert resampling.crc32_of_spans(data, starts, ends).tolist() == [zlib.crc32(w) for w in words]


@pytest.mark.parametrize(
    "values",
    [
        [(i * 7919 % 4000, i % 3) for i in range(9000)],
        [(2**63 - 1, 0), (-(2**63), 1), (0, 5), (-1, 5), (1, 5), (None, None), (1, 5)],
        [(-5, None), (None, 2), (7, 2), (7, None), (None, None), (7, -2)],
        [(4, 4)] * 3000,
        [],
    ],
)
def test_ranks(spark, values):
    rows = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(values)], "a long, b long, i long")
    got = radix_sort.ranked(rows.repartition(5), [("a", True), ("b", False)]).collect()
    assert [r.rank for r in sorted(got, key=lambda r: r.rank)] == list(range(1, len(values) + 1))
    order = sorted(values, key=lambda v: (v[0] is None, -(v[0] or 0), v[1] is None, v[1] or 0))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.rank)] == order
