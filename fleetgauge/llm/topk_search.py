"""Exact top-k inner products on a bit-sliced index.

Each component becomes floor(256 * x). A block of rows is stored as bitmaps,
one for each component and bit, over the rows of the block. For a query, the
scores of all rows at once are the sum of shifted bitmaps, added with carries
kept aside; negative weights take the complement of a slice. The lowest bits of
the attributes are left out of that sum. From the top slice of the sums
downward, bitmaps pick the best rows and so the k-th score; whatever could still
reach it with the omitted bits is scored exactly.

Blocks of queries meet blocks of rows; nothing is collected, and every row of
the index is searched. Defined results: vectors that are null or hold null or
non-finite components take no part, nor do empty ones; only vectors of one
length are compared. Rows with the query's id are its own. Repeated other rows
count each. Scores beyond a long become the largest or smallest long.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 5
ROWS = 4096
QUERIES = 2048
TOGETHER = 64
DROPPED = 2
WIDE = 24

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def bit_slices(values: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps [component, bit, word] of whole numbers [row, component] below 2**bits."""
    rows, width = values.shape
    words = -(-rows // 64)
    out = np.zeros((width, bits, words), np.uint64)
    for b in range(bits):
        plane = np.zeros((width, words * 64), bool)
        plane[:, :rows] = ((values >> b) & 1).T.astype(bool)
        out[:, b] = np.packbits(plane, axis=1, bitorder="little").view(np.uint64)
    return out


class Adder:
    """Sums of bitmaps with binary weights, two bitmaps at most waiting at each weight."""

    def __init__(self):
        self.waiting: list[list[np.ndarray]] = []

    def add(self, at: int, bitmap: np.ndarray) -> None:
        while True:
            while len(self.waiting) <= at:
                self.waiting.append([])
            column = self.waiting[at]
            column.append(bitmap)
            if len(column) < 3:
                return
            a, b, c = column
            half = a ^ b
            column[:] = [half ^ c]
            bitmap = (a & b) | (half & c)
            at += 1

    def total(self) -> list[np.ndarray]:
        """Slices of the sum, lowest first."""
        out, at = [], 0
        while at < len(self.waiting):
            column = self.waiting[at]
            if len(column) == 2:
                a, b = column
                column[:] = [a ^ b]
                self.add(at + 1, a & b)
            out.append(column[0] if column else None)
            at += 1
        return out


def slice_sums(slices: np.ndarray, queries: np.ndarray, dropped: int) -> list[np.ndarray]:
    """Sums over rows for several queries at once, as slices [query, word].

    Up to a constant of each query, a score is its sum shifted up by ``dropped``
    bits, plus at most the query's absolute sum times the largest dropped value.
    """
    width, bits, words = slices.shape
    size = np.abs(queries).astype(np.uint64)
    flip = np.where(queries < 0, _ALL, np.uint64(0))
    adder = Adder()
    for d in range(width):
        masks = []
        for j in range(int(size[:, d].max()).bit_length()):
            on = (size[:, d] >> np.uint64(j)) & np.uint64(1)
            if on.any():
                masks.append((j, (np.uint64(0) - on)[:, None]))
        for b in range(dropped, bits):
            plane = slices[d, b][None, :] ^ flip[:, d, None]
            for j, mask in masks:
                adder.add(b - dropped + j, plane & mask)
    blank = np.zeros((len(queries), words), np.uint64)
    return [s if s is not None else blank for s in adder.total()]


def best_bitmap(sums: list[np.ndarray], open_rows: np.ndarray, k: int) -> np.ndarray:
    """For each query the k-th largest sum among its open rows, or 0 if there are fewer."""
    sure = np.zeros_like(open_rows)
    k = np.minimum(k, np.bitwise_count(open_rows).sum(axis=1))
    level = open_rows.copy()
    kth = np.zeros(len(open_rows), np.int64)
    for at in range(len(sums) - 1, -1, -1):
        upper = level & sums[at]
        enough = np.bitwise_count(sure | upper).sum(axis=1) >= k
        kth += enough.astype(np.int64) << at
        level = np.where(enough[:, None], upper, level & ~sums[at])
        sure = np.where(enough[:, None], sure, sure | upper)
    return kth


def at_least(sums: list[np.ndarray], floor: np.ndarray) -> np.ndarray:
    """Rows whose sum is at least a number of each query, compared slice by slice."""
    above = np.zeros_like(sums[0])
    equal = np.full_like(sums[0], _ALL)
    floor = np.maximum(floor, 0)
    beyond = floor >> len(sums) > 0
    for at in range(len(sums) - 1, -1, -1):
        bit = np.where((floor >> at) & 1, _ALL, np.uint64(0))[:, None]
        above |= equal & sums[at] & ~bit
        equal &= ~(sums[at] ^ bit)
    out = above | equal
    out[beyond] = 0
    return out


def _whole(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, width)


def _exact(rows: np.ndarray, query: np.ndarray, wide: bool) -> np.ndarray:
    if not wide:
        return rows @ query
    sums = [sum(int(a) * int(b) for a, b in zip(r, query)) for r in rows]
    return np.array([max(-(2**63), min(2**63 - 1, s)) for s in sums], np.int64)


FOUND = "query_id long, vec_id long, score long"


def search_block(queries: pa.Table, rows: pa.Table, k: int = K, dropped: int = DROPPED) -> pa.Table:
    """The k best rows of one block for each query of another."""
    out = []
    if queries.num_rows and rows.num_rows:
        width = queries["width"][0].as_py()
        q, x = _whole(queries["whole"], width), _whole(rows["whole"], width)
        q_ids, x_ids = queries["vec_id"].to_numpy(), rows["vec_id"].to_numpy()
        order = np.argsort(x_ids, kind="stable")
        x, x_ids = x[order], x_ids[order]
        low = x.min(axis=0)
        span = int(x.max()) - int(x.min())
        wide = max(span, int(np.abs(q.astype(object)).max()), int(np.abs(x.astype(object)).max())) >> WIDE > 0
        if wide:
            out = [(i, np.arange(len(x))) for i in range(len(q))]
        else:
            bits = max(1, span.bit_length())
            cut = min(dropped, bits - 1)
            index = bit_slices(x - low, bits)
            for at in range(0, len(q), TOGETHER):
                out += _candidates(index, q[at : at + TOGETHER], q_ids[at : at + TOGETHER], x_ids, k, cut, at)
    ids, found, scores = [], [], []
    for i, picked in out:
        picked = picked[x_ids[picked] != q_ids[i]]
        score = _exact(x[picked], q[i], wide)
        best = np.lexsort((x_ids[picked], -score.astype(object) if wide else -score))[:k]
        ids.append(np.full(len(best), q_ids[i]))
        found.append(x_ids[picked][best])
        scores.append(score[best])
    parts = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in (ids, found, scores)]
    return pa.table(dict(zip(("query_id", "vec_id", "score"), parts)))


def _candidates(index, q, q_ids, x_ids, k, cut, first) -> list[tuple[int, np.ndarray]]:
    """Rows of the block that may be among each query's k best."""
    words = index.shape[2]
    valid = np.zeros((len(q), words * 64), bool)
    valid[:, : len(x_ids)] = x_ids[None, :] != q_ids[:, None]
    open_rows = np.packbits(valid, axis=1, bitorder="little").view(np.uint64)
    sums = slice_sums(index, q, cut)
    kth = best_bitmap(sums, open_rows, k)
    slack = np.abs(q).sum(axis=1) * ((1 << cut) - 1)
    picked = at_least(sums, kth - (slack >> cut) - 1) & open_rows
    bits = np.unpackbits(picked.view(np.uint8), axis=1, bitorder="little").astype(bool)
    return [(first + i, np.flatnonzero(bits[i])) for i in range(len(q))]


def whole_numbers(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id, whole numbers and length of every vector that takes part."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    fit = F.coalesce(
        F.forall("_numbers", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
        F.lit(False),
    )
    return (
        vectors.select("vec_id", numbers.alias("_numbers"))
        .where(fit & (F.size("_numbers") > 0) & F.col("vec_id").isNotNull())
        .select(
            "vec_id",
            F.transform("_numbers", lambda x: F.floor(256 * x)).alias("whole"),
            F.size("_numbers").alias("width"),
        )
    )


def top_k(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best rows.

    Blocks are dealt by a hash, so all have about the same number of rows. A row
    goes to as many places as there are blocks of queries, and the other way round.
    """
    whole = whole_numbers(vectors)
    counts = whole.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    row_blocks, query_blocks = max(1, -(-counts["n"] // ROWS)), max(1, -(-counts["q"] // QUERIES))
    spread = F.xxhash64("vec_id", "whole", F.monotonically_increasing_id())
    rows = whole.withColumn("_h", spread).select(
        "*",
        F.pmod("_h", F.lit(row_blocks).cast("long")).alias("row_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))).alias("query_block"),
    )
    asked = whole.where(is_query).withColumn("_h", spread).select(
        "*",
        F.pmod("_h", F.lit(query_blocks).cast("long")).alias("query_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(row_blocks - 1).cast("long"))).alias("row_block"),
    )
    place = ["width", "query_block", "row_block"]
    found = (
        asked.drop("_h")
        .groupBy(*place)
        .cogroup(rows.drop("_h").groupBy(*place))
        .applyInArrow(partial(search_block, k=k), FOUND)
    )
    ranked = F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)")
    return (
        found.withColumn("rank", ranked)
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )
