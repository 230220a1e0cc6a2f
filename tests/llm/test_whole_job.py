"""Places where an operator once did less than its whole job."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from fleetgauge.llm import kneser_ney, mixing

public_tokenizers = pytest.importorskip("public_tokenizers")


def _worst_deviation(blocks, weights):
    """Largest distance of any source from its target, in blocks, in any slot of any phase."""
    exact, left = {s: Fraction(w) for s, w in weights.items()}, dict(blocks)
    served, worst, now, next_block = dict.fromkeys(blocks, 0), Fraction(0), 0, dict.fromkeys(blocks, 0)
    for s, i in mixing.dealt_slots(blocks, mixing.whole(weights)):
        assert i == next_block[s]
        next_block[s] += 1
        served[s], left[s], now = served[s] + 1, left[s] - 1, now + 1
        total = sum(exact[k] for k in served)
        worst = max(worst, *(abs(served[k] - now * exact[k] / total) for k in served))
        if not left[s]:
            served, now = {k: 0 for k in served if left[k]}, 0
    assert next_block == blocks
    return worst


def test_mixture_holds_the_given_weights_over_many_cycles():
    sizes = {"hot": 17_094} | {f"s{i}": 1_800 for i in range(19)}
    roots = {s: math.sqrt(n) for s, n in sizes.items()}
    assert _worst_deviation({s: -(-n // 16) for s, n in sizes.items()}, roots) < 1
    half = {"half": 0.5} | {f"s{i}": 0.5 / 99 for i in range(99)}
    assert _worst_deviation({s: 1000 if s == "half" else 11 for s in half}, half) < 1


def test_mixture_weighs_any_number_of_sources(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "'t' AS text", "IF(id < 3000, 'hot', concat('s', id % 1500)) AS source"
    )
    rows = mixing.schedule(docs, {"hot": 1500.0} | {f"s{i}": 1.0 for i in range(1500)}, block=1).collect()
    assert sorted(r.slot for r in rows) == list(range(6000))
    assert abs(sum(r.slot < 1000 and r.source == "hot" for r in rows) - 500) < 1


def _six(text):
    """The six bytes that end at each place and at the end, which is 255."""
    line = bytes(5) + text.encode() + b"\xff"
    return [line[i : i + 6] for i in range(len(line) - 5)]


def _plain_kneser_ney(texts):
    """Interpolated modified Kneser-Ney of six bytes over dictionaries."""
    levels, counts = {}, Counter(g for t in texts for g in _six(t))
    for length in range(6, 0, -1):
        times = Counter(counts.values())
        y = times[1] / max(times[1] + 2 * times[2], 1)
        cut = [min(max(k - (k + 1) * y * times[k + 1] / times[k], 0.1), k - 0.1) if times[k] else 0.5 for k in (1, 2, 3)]
        total, taken = defaultdict(float), defaultdict(float)
        for g, n in counts.items():
            total[g[:-1]] += n
            taken[g[:-1]] += cut[min(n, 3) - 1]
        levels[length] = counts, cut, total, taken
        counts = Counter(g[1:] for g in counts)

    def p(g):
        if not g:
            return 1 / 256
        counts, cut, total, taken = levels[len(g)]
        if g[:-1] not in total:
            return p(g[1:])
        n = counts.get(g, 0)
        own = n - cut[min(n, 3) - 1] if n else 0
        return (own + taken[g[:-1]] * p(g[1:])) / total[g[:-1]]

    return lambda text: 2 ** -(sum(math.log2(p(g)) for g in _six(text)) / len(_six(text)))


def _words(rng, n):
    return " ".join(rng.choice(["quality", "quantity", "équipe", "quiet", "thing", "nothing", "a"]) for _ in range(n))


def test_kneser_ney_uses_six_bytes_and_the_end(spark):
    rng = random.Random(5)
    texts = [None, "", "a", "a\0b", *(_words(rng, 1 + i % 30) for i in range(60))]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, len(texts), 2)], "doc_id long, quality int, toxic int")
    part = {r.doc_id: r.fold if r.doc_id % 2 else 0 for r in docs.select("doc_id", kneser_ney._part()).collect()}
    models = [
        _plain_kneser_ney([t for i, t in enumerate(texts) if t and i % 2 and part[i] != fold])
        for fold in range(kneser_ney.FOLDS)
    ]
    found = kneser_ney.classify(docs, labels).collect()
    assert len(found) == len(texts) and set(part.values()) == set(range(kneser_ney.FOLDS))
    for r in found:
        if texts[r.doc_id]:
            assert r.perplexity == pytest.approx(models[part[r.doc_id]](texts[r.doc_id]), rel=1e-5)
        else:
            assert r.perplexity is None and not r.kept


def test_kneser_ney_reads_long_texts_in_pieces():
    text = "ab\0é" * (kneser_ney.PART // 2)
    pieces = [keys for keys, _ in kneser_ney._places(pa.RecordBatch.from_pydict({"text": [text]}))]
    whole = kneser_ney.sequences(np.frombuffer(text.encode(), np.uint8))
    assert len(pieces) > 1 and len(whole) == len(text.encode()) + 1
    assert np.array_equal(np.concatenate(pieces), whole)


def test_kneser_ney_keeps_texts_like_the_trusted_ones(spark):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choices("abcdefgh", k=8)) for _ in range(3000)]
    texts = [" ".join(rng.choices(vocabulary, k=60)) for _ in range(300)] + ["".join(rng.choices("uvwxyz", k=500)) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in kneser_ney.classify(docs, labels).where("kept").collect()}
    assert len(kept & set(range(100, 300))) >= 190
    assert not kept & set(range(300, 320))
