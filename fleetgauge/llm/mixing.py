"""Mixing sources to target weights by a Pfair schedule.

Sources are cut into blocks. Weights are exact fractions, so a source with
weight w has in its i-th block a release slot floor((i - 1) / w) and a deadline
ceil(i / w). Earliest deadline first over released blocks meets every deadline,
and then no source is ever a whole block ahead of or behind its target, however
long the data. When a source has no blocks left, a new phase begins with the
weights of the others. Every document comes exactly once.

The order of the blocks is one after the other by nature: the driver deals the slots,
from a state of a few numbers for each source, and stores them a million at a time.
Documents are numbered and placed by Spark.

Defined results: a null source is a source of its own. A source without a
target weight gets the smallest one given. Repeated rows and ids are separate
documents; a null text weighs like any. Column names added by ``schedule``
replace equal ones. Neither the sources nor the rows are bounded.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge.session import fresh_path

CYCLE = 1000
BLOCK = 16
CHUNK = 20_000
SLOTS = 1_000_000


def shares(weights: Mapping[str, float], cycle: int = CYCLE) -> dict[str, int]:
    """Whole slots of a cycle by largest remainder, one at least for each source."""
    cycle = max(cycle, len(weights))
    total = sum(weights.values())
    exact = {s: w / total * (cycle - len(weights)) for s, w in sorted(weights.items())}
    slots = {s: 1 + math.floor(x) for s, x in exact.items()}
    left = cycle - sum(slots.values())
    for s in sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], s))[:left]:
        slots[s] += 1
    return slots


def cycle_order(slots: Mapping[str, int]) -> list[str]:
    """The source served in each slot of a cycle: earliest deadline first."""
    cycle = sum(slots.values())
    waiting = [(0, -(-cycle // w), s, 1) for s, w in sorted(slots.items())]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    order = []
    for now in range(cycle):
        while waiting and waiting[0][0] <= now:
            _, deadline, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, s, i))
        _, s, i = heapq.heappop(ready)
        order.append(s)
        if i < slots[s]:
            w = slots[s]
            heapq.heappush(waiting, (i * cycle // w, -(-(i + 1) * cycle // w), s, i + 1))
    return order


def whole(weights: Mapping[str, float]) -> dict[str, int]:
    """Weights as whole numbers in exactly the given ratio."""
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    return {s: int(x * scale) for s, x in exact.items()}


def dealt_slots(blocks: Mapping[str, int], weights: Mapping[str, int]) -> Iterator[tuple[str, int]]:
    """Source and block (from 0) of each slot: earliest deadline first over released blocks.

    A source's first block of a phase is released at once, so those wait in a
    list by weight, which needs no work when a phase begins.
    """
    by_weight = sorted((s for s in blocks if blocks[s] > 0), key=lambda s: (-weights[s], s))
    after = dict(zip([None, *by_weight], [*by_weight, None]))
    before = {s: p for p, s in after.items()}
    total = sum(weights[s] for s in by_weight)
    done = dict.fromkeys(by_weight, 0)
    now, fresh = 0, after[None]
    waiting: list[tuple[int, int, str, int]] = []
    ready: list[tuple[int, str, int]] = []
    while after[None] is not None:
        while waiting and waiting[0][0] <= now:
            heapq.heappush(ready, heapq.heappop(waiting)[1:])
        if fresh is not None and not (ready and ready[0][0] <= -(-total // weights[fresh])):
            s, i = fresh, 1
            fresh = after[fresh]
        else:
            _, s, i = heapq.heappop(ready)
        yield s, done[s]
        done[s] += 1
        now += 1
        if done[s] < blocks[s]:
            w = weights[s]
            heapq.heappush(waiting, (i * total // w, -(-(i + 1) * total // w), s, i + 1))
            continue
        p, n = before[s], after[s]
        after[p] = n
        before[n] = p
        total -= weights[s]
        now, fresh = 0, after[None]
        waiting, ready = [], []


def _stored_slots(spark: SparkSession, blocks: Mapping[str, int], weights: Mapping[str, int]) -> DataFrame:
    """A table of each block's slot, in which sources go by their number in ``blocks``."""
    number = {s: k for k, s in enumerate(blocks)}
    path, first = fresh_path(spark, "mixture-slots"), 0
    schema = pa.schema([("_number", pa.int64()), ("_block", pa.int64()), ("_slot", pa.int64())])
    slots = dealt_slots(blocks, weights)
    while True:
        part = list(itertools.islice(slots, SLOTS))
        columns = [[number[s] for s, _ in part], [i for _, i in part], range(first, first + len(part))]
        table = pa.table([pa.array(c, pa.int64()) for c in columns], schema=schema)
        spark.createDataFrame(table).write.mode("append").parquet(path)
        first += len(part)
        if len(part) < SLOTS:
            return spark.read.schema("_number long, _block long, _slot long").parquet(path)


_KEY = "coalesce(concat('=', CAST(source AS string)), '')"


def schedule(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    block: int = BLOCK,
    cycle: int | None = None,
) -> DataFrame:
    """Add slot (from 0, one for each block) and place (of a document in its block).

    Without weights, a source weighs as the root of its number of documents.
    With a cycle, weights are rounded to whole shares of it.
    Documents are numbered within chunks that a hash deals out, so a source
    with a third of all rows is many small windows; only the counts of the
    chunks are summed up per source.
    """
    named = docs.withColumns({"_source": F.expr(_KEY), "_hash": F.xxhash64("doc_id", "text")})
    total = docs.count()
    chunks = max(1, -(-total // CHUNK))
    dealt = named.withColumn("_chunk", F.pmod(F.xxhash64("_hash"), F.lit(chunks)))
    counts = dealt.groupBy("_source", "_chunk").agg(F.count("*").alias("_n"))
    sizes = {r["_source"]: r["n"] for r in counts.groupBy("_source").agg(F.sum("_n").alias("n")).collect()}
    if weights is None:
        chosen = {s: math.sqrt(n) for s, n in sizes.items()}
    else:
        given = {"" if s is None else f"={s}": w for s, w in weights.items() if w > 0}
        chosen = {s: given.get(s, min(given.values(), default=1.0)) for s in sizes}
    blocks = {s: -(-n // block) for s, n in sorted(sizes.items())}
    spark = docs.sparkSession
    plan = _stored_slots(spark, blocks, whole(chosen) if cycle is None else shares(chosen, cycle))
    numbers = spark.createDataFrame(list(zip(blocks, range(len(blocks)))), "_source string, _number long")
    earlier = "sum(_n) OVER (PARTITION BY _source ORDER BY _chunk) - _n AS _before"
    offsets = counts.selectExpr("_source", "_chunk", earlier).join(F.broadcast(numbers), "_source")
    numbered = (
        dealt.withColumn(
            "_row",
            F.expr("row_number() OVER (PARTITION BY _source, _chunk ORDER BY _hash, doc_id) - 1"),
        )
        .join(offsets, ["_source", "_chunk"])
        .withColumn("_index", F.col("_before") + F.col("_row"))
        .withColumn("_block", F.floor(F.col("_index") / block))
    )
    return (
        numbered.join(plan, ["_number", "_block"])
        .withColumns({"slot": F.col("_slot"), "place": (F.col("_index") % block).cast("int")})
        .select(*[c for c in docs.columns if c not in ("slot", "place")], "slot", "place")
    )


def placed(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """All documents with their slot and place, whatever their other columns are called."""
    kept = [c for c in docs.columns if c not in ("slot", "place")]
    rows = docs.select(F.struct(*kept).alias("_whole"), "doc_id", "text", "source")
    return schedule(rows, weights).select("_whole.*", "slot", "place")


def mixed(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """All documents in the order of the schedule."""
    rows = docs.select(F.struct(*docs.columns).alias("_whole"), "doc_id", "text", "source")
    return schedule(rows, weights).orderBy("slot", "place").select("_whole.*")
