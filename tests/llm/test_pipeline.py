"""The stages after each other, on a small table."""

import math
from collections import Counter

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline
from fleetgauge.llm import mixing

SF = "/root/testdata/sf0.001"


def test_slots_of_the_result_follow_the_schedule(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert len(rows) > 100 and len({r.doc_id for r in rows}) == len(rows)
    kept = Counter(r.source for r in rows)
    keys = {s: "" if s is None else f"={s}" for s in kept}
    blocks = {keys[s]: -(-n // mixing.BLOCK) for s, n in sorted(kept.items(), key=lambda x: keys[x[0]])}
    weights = {keys[s]: math.sqrt(n) for s, n in kept.items()}
    order = [s for s, _ in mixing.dealt_slots(blocks, mixing.whole(weights))]
    held = {}
    for r in rows:
        held.setdefault(r.slot, []).append((keys[r.source], r.place))
    assert sorted(held) == list(range(len(order)))
    for slot, members in held.items():
        assert {s for s, _ in members} == {order[slot]}
        assert sorted(p for _, p in members) == list(range(len(members)))


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
