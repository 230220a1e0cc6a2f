"""Importance resampling of documents towards the words of a target text.

Word runs are hashed into buckets. One pass counts the buckets of all
documents and of all target texts; the log ratio of the two is a bucket's
gain, an array of fixed length that goes to every task. A second pass adds up
each document's gains and a Gumbel value drawn from its id, so that the
highest sums are a draw without replacement by weight. The documents are
ranked by a distributed radix sort; rank and draw cover all of them.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z. A
feature is a run of 1 to ``longest`` words joined by one space, its bucket the
unsigned crc32 of its UTF-8 bytes modulo 10000.

Defined results: a null or empty text has no features and weight 0. Every row
has one result, repeated rows too; rows with one score and id take ranks next
to each other in some order. A null id hashes as an empty one and comes after
others of its score. Without target texts the gains compare with an even
spread; no documents give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.radix_sort import ranked
from fleetgauge.llm.text import SLICE_BYTES, slices, utf8, word_bounds
from fleetgauge.session import stored

BUCKETS = 10_000
LEAST_WORDS = 20
SEED = 2024
_LONG_WORD = 64

_FOLDED = np.full(256, 32, np.uint8)
_FOLDED[128:] = np.arange(128, 256)
_FOLDED[48:58] = np.arange(48, 58)
_FOLDED[97:123] = _FOLDED[65:91] = np.arange(97, 123)


def _crc_steps() -> np.ndarray:
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(0xEDB88320), steps >> 1)
    return steps.astype(np.uint32)


_CRC = _crc_steps()


def crc32_of_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The crc32 of each span of bytes, all spans byte by byte at once."""
    out = np.empty(len(starts), np.uint32)
    lengths = ends - starts
    for i in np.flatnonzero(lengths > _LONG_WORD):
        out[i] = zlib.crc32(data[starts[i] : ends[i]].tobytes())
    short = np.flatnonzero(lengths <= _LONG_WORD)
    short = short[np.argsort(-lengths[short], kind="stable")]
    at, left = starts[short], -lengths[short]
    state = np.full(len(short), 0xFFFFFFFF, np.uint32)
    for k in range(-int(left.min(initial=0))):
        live = int(np.searchsorted(left, -k, side="left"))
        own = state[:live]
        state[:live] = _CRC[(own ^ data[at[:live] + k]) & np.uint32(255)] ^ (own >> np.uint32(8))
    out[short] = ~state
    return out


def _one_space_apart(data, starts, ends):
    """The words' bytes with one space after each, and where they are now."""
    lengths = ends - starts
    now = np.cumsum(lengths + 1) - lengths - 1
    total = int((lengths + 1).sum())
    out = np.full(total, 32, np.uint8)
    if len(starts):
        within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[within + np.repeat(now, lengths)] = data[within + np.repeat(starts, lengths)]
    return out, now, now + lengths


def _features(part: pa.RecordBatch, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, bucket) of every feature and (row) of every word, some megabytes at a time."""
    raw, offsets = utf8(part.column("text"))
    data = _FOLDED[raw]
    starts, ends = word_bounds(data, offsets)
    row = np.searchsorted(offsets, starts, side="right") - 1
    cuts = np.unique(np.r_[np.searchsorted(starts, np.arange(0, len(data), SLICE_BYTES)), len(starts)])
    for a, b in zip(cuts[:-1], cuts[1:]):
        c = min(b + longest - 1, len(starts))
        text, first, last = data, starts[a:c], ends[a:c]
        if longest > 1:
            text, first, last = _one_space_apart(data, first, last)
        for n in range(1, longest + 1):
            begin = np.arange(min(b - a, c - a - n + 1))
            begin = begin[row[a + begin] == row[a + begin + n - 1]]
            codes = crc32_of_spans(text, first[begin], last[begin + n - 1])
            words = row[a:b] if n == 1 else row[:0]
            yield row[a + begin], (codes % np.uint32(BUCKETS)).astype(np.int64), words


def _counted(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in slices(batch, "text"):
            for _, buckets, _ in _features(part, longest):
                counts += np.bincount(buckets, minlength=BUCKETS)
    held = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, longest: int = 1) -> np.ndarray:
    """How many features of all texts fall into each bucket; 10,000 numbers reach the driver."""
    own = texts.select(F.col("text").cast("string"))
    rows = own.mapInArrow(partial(_counted, longest=longest), "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of target to documents, by bucket, with one added to each."""
    held, aimed = int(documents.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (held + BUCKETS) / ((s + 1) * (aimed + BUCKETS))))
            for s, t in zip(documents.tolist(), target.tolist())
        ],
        np.int64,
    )


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """Whole thousandths of a Gumbel value that the id decides."""
    name = "" if doc_id is None else doc_id
    drawn = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def _scored(batches: Iterator[pa.RecordBatch], gain: np.ndarray, longest: int, seed: int):
    for batch in batches:
        for part in slices(batch, "text"):
            rows = part.num_rows
            n_features, n_words, weight = (np.zeros(rows, np.int64) for _ in range(3))
            for row, buckets, words in _features(part, longest):
                n_features += np.bincount(row, minlength=rows)
                n_words += np.bincount(words, minlength=rows)
                own = np.r_[0, np.cumsum(gain[buckets])]
                edges = np.searchsorted(row, np.arange(rows + 1))
                weight += own[edges[1:]] - own[edges[:-1]]
            ids = part.column("doc_id")
            luck = np.array([gumbel(i, seed) for i in ids.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [ids, *map(pa.array, (n_features, n_words, weight, weight + luck))],
                names=["doc_id", "n_features", "n_words", "weight", "score"],
            )


SCORED = "doc_id long, n_features long, n_words long, weight long, score long"


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = LEAST_WORDS,
    longest: int = 1,
    seed: int = SEED,
) -> DataFrame:
    """Every document's features, weight and score, and the rank of those drawn.

    Of the documents with ``least_words``, ``percent`` per cent are drawn, the
    fraction rounded down.
    """
    gain = gains(bucket_counts(docs, longest), bucket_counts(target, longest))
    own = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = own.mapInArrow(partial(_scored, gain=gain, longest=longest, seed=seed), SCORED)
    scored = stored(scored.withColumn("_row", F.monotonically_increasing_id()), "scored-documents")
    able = scored.where(F.col("n_words") >= least_words).select("_row", "score", "doc_id")
    order = ranked(able, [("score", True), ("doc_id", False)])
    drawn = order.where(F.col("rank") <= percent * able.count() // 100).select("_row", "rank")
    return scored.join(drawn, "_row", "left").drop("_row")
