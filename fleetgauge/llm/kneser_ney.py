"""Quality classifier: interpolated modified Kneser-Ney over bytes, trained on trusted text.

Trusted are all documents labelled good and not toxic. Counted are the sequences of six bytes
that end at each place of a text and at its end, which is a symbol of its own; shorter ones get
continuation counts, and each count a discount by how many sequences of its length occur once,
twice, three and four times. A document's perplexity, its end included, is compared with a high
quantile of the trusted documents of its language. As a model knows what it has learned from,
trusted documents are dealt to four parts by a hash of the text, and each part is read by a model
of the other three; all other documents are read by the model of all four.

Sequences are dealt to shards by the four bytes before the last. So a shard holds every sequence
of five and six bytes with its contexts, and all that precedes them; those up to four bytes go
to all tasks. Texts lie in blocks of some megabytes. A block asks each shard for its distinct
sequences, once, and its texts, all read by one model, against the answers. So the model grows
with the corpus, while a task holds one shard of it, or what one block can reach.

Defined results: a text that is null or empty has no perplexity and is not kept. A
null or unseen language is held to the quantile of all trusted documents; without trusted
documents all texts that are not empty stay. A model of nothing finds all bytes equally likely.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm import ppm
from fleetgauge.llm.text import mix, slices, utf8
from fleetgauge.operators.lookups import bounded_broadcast
from fleetgauge.session import MOST_PARTITIONS, stored

ORDER = 6
NEAR = 4  # sequences up to this length go to all tasks
END = 255  # no byte of UTF-8
QUANTILE = 0.99
MARGIN = 1.05
BLOCK = 32 << 20
PART = 1 << 18
SHARDS = 32
SHARED_BYTES = 1 << 29
FOLDS = 5  # what all trusted documents teach, and what those outside each of four parts do

_TEXTS = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("text", pa.large_string())])
_PACKED = "block long, shard int, size long, keys binary, numbers binary"


def sequences(text: np.ndarray, offsets: np.ndarray | None = None) -> np.ndarray:
    """The six bytes that end at each place of each text and at its end; before a text are zeros.

    Texts lie end to end and none is empty; without offsets there is one.
    """
    ends = np.array([len(text)]) if offsets is None else offsets[1:]
    count = len(ends)
    row = np.repeat(np.arange(count), np.diff(ends, prepend=0))
    line = np.zeros(len(text) + ORDER * count, np.int64)
    line[np.arange(len(text)) + ORDER * row + ORDER - 1] = text
    line[ends + ORDER * np.arange(1, count + 1) - 1] = END
    keys = line[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        keys |= line[ORDER - 1 - back : len(line) - back] << 8 * back
    inside = np.ones(len(keys), bool)
    inside[(ends[:-1] + ORDER * np.arange(count - 1))[:, None] + np.arange(1, ORDER)] = False
    return keys[inside]


def shorter(keys: np.ndarray, length: int) -> np.ndarray:
    """The last bytes of sequences."""
    return keys & ((1 << 8 * length) - 1)


def _places(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sequences of a column of texts and the row of each. One long text comes in pieces."""
    data, offsets = utf8(part.column("text"))
    if part.num_rows == 1:
        for start in range(0, len(data), PART):
            stop, lead = min(start + PART, len(data)), min(start, ORDER - 1)
            keys = sequences(data[start - lead : stop])[lead : None if stop == len(data) else -1]
            yield keys, np.zeros(len(keys), np.int64)
    elif len(data):
        rows = np.flatnonzero(np.diff(offsets))
        yield sequences(data, np.unique(offsets)), np.repeat(rows, np.diff(offsets)[rows] + 1)


def _by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """Where the sequences of each shard are."""
    shard = (mix(shorter(keys >> 8, NEAR).astype(np.uint64)) % np.uint64(shards)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    found, starts = np.unique(shard[order], return_index=True)
    yield from zip(found.tolist(), np.split(order, starts[1:]) if len(found) else [])


def _distinct(parts: list) -> np.ndarray:
    """Sorted, without repeats; np.unique would hash them, which takes longer."""
    keys = np.sort(np.concatenate([np.zeros(0, np.int64), *parts]))
    return keys[np.diff(keys, prepend=-1) != 0]


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.zeros(0, np.int64), *(k for k, _ in parts)])
    found, at = np.unique(keys, return_inverse=True)
    n = np.concatenate([np.zeros(0, np.int64), *(n for _, n in parts)])
    return found, np.bincount(at, n, len(found)).astype(np.int64)


def _row(block: int, shard: int, keys: np.ndarray, numbers: np.ndarray | None) -> pa.RecordBatch:
    packed = [ppm.packed_keys(keys)], [None if numbers is None else ppm.packed(numbers)]
    columns = [pa.array([block]), pa.array([shard], pa.int32()), pa.array([len(keys)]), *(pa.array(x, pa.binary()) for x in packed)]
    return pa.RecordBatch.from_arrays(columns, names=["block", "shard", "size", "keys", "numbers"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Block, shard, keys and packed numbers, row by row."""
    for batch in batches:
        for block, shard, size, keys, numbers in zip(*(c.to_pylist() for c in batch.columns)):
            yield block, shard, ppm.unpacked_keys(keys, size), numbers


def _taught(keys: np.ndarray, counts: np.ndarray, fold: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequences and their counts in a fold; given are keys that end with the fold that leaves them out."""
    use = keys & 7 != fold
    return _merged([(keys[use] >> 3, counts[use])])


def _count(shards: int) -> Callable:
    """How often each sequence occurs in each part of some megabytes of text, by shard."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0

        def counts() -> Iterator[pa.RecordBatch]:
            keys, n = _merged(parts)
            for shard, own in _by_shard(keys >> 3, shards):
                yield _row(-1, shard, keys[own], n[own])

        for batch in batches:
            for part in slices(batch, "text", PART):
                fold = part.column("fold").to_numpy()
                for keys, row in _places(part):
                    parts.append(np.unique(keys << 3 | fold[row], return_counts=True))
                    held += len(keys)
                    if len(parts) > 32:
                        parts = [_merged(parts)]
                    if held >= BLOCK:
                        yield from counts()
                        parts, held = [], 0
        yield from counts()

    return count


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each shard over all texts; rows of one shard come together."""
    now, waiting, held = None, [], 0
    for _, shard, keys, numbers in _rows(batches):
        if now is not None and now != shard:
            yield _row(-1, now, *_merged(waiting))
            waiting, held = [], 0
        now = shard
        waiting.append((keys, ppm.unpacked(numbers, len(keys), np.int64)))
        held += len(keys)
        if held > ppm.PENDING + 2 * len(waiting[0][0]):
            waiting = [_merged(waiting)]
            held = len(waiting[0][0])
    if now is not None:
        yield _row(-1, now, *_merged(waiting))


def _continued(keys: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shorter sequences, and how many of the given ones end with each."""
    keys, counts = np.unique(shorter(keys, length), return_counts=True)
    return keys, counts.astype(float)


def _tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sequences of each length occur once to four times, in each fold."""
    for _, _, keys, numbers in _rows(batches):
        counts = ppm.unpacked(numbers, len(keys), np.int64)
        for fold in range(FOLDS):
            own, n = _taught(keys, counts, fold)
            for length in range(ORDER, NEAR, -1):
                columns = [fold] * 4, [length] * 4, [1, 2, 3, 4], [int((n == k).sum()) for k in (1, 2, 3, 4)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["fold", "length", "times", "n"])
                own, n = _continued(own, length - 1)


def _near_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many longer sequences end with each near one, in each fold."""
    for _, _, keys, _ in _rows(batches):
        longer, at = np.unique(shorter(keys >> 3, NEAR + 1), return_inverse=True)
        near, end = np.unique(shorter(longer, NEAR), return_inverse=True)
        columns = [pa.array(near)]
        for fold in range(FOLDS):
            taught = np.bincount(at, keys & 7 != fold, len(longer)) > 0
            columns.append(pa.array(np.bincount(end, taught, len(near)).astype(np.int64)))
        yield pa.RecordBatch.from_arrays(columns, names=["key", *(f"n{fold}" for fold in range(FOLDS))])


class KneserNey:
    """Probabilities of sequences, by order from the longest to one byte.

    Shorter levels may be those of a model ``below``; then tallies are given, as there are more shards.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, length: int = ORDER, below: KneserNey | None = None, tallies: list | None = None):
        order = np.argsort(keys)
        keys, counts = keys[order].astype(np.int64), counts[order].astype(float)
        self.levels, self.length = [], length
        for size in range(length, below.length if below else 0, -1):
            tally = tallies[length - size] if below else [int((counts == k).sum()) for k in (1, 2, 3, 4)]
            self.levels.append(self._level(keys, counts, tally))
            keys, counts = _continued(keys, size - 1)
        own = len(self.levels)
        self.levels += below.levels if below else []
        for at in range(own - 1, -1, -1):
            keys, share, contexts, backoff = self.levels[at]
            lower = self._p(shorter(keys, length - at - 1), at + 1)
            share += backoff[np.searchsorted(contexts, keys >> 8)] * lower

    @staticmethod
    def _level(keys: np.ndarray, counts: np.ndarray, n: list) -> tuple:
        y = n[0] / max(n[0] + 2 * n[1], 1)
        cut = [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k - 0.1) if n[k - 1] else 0.5 for k in (1, 2, 3)]
        discount = np.choose(np.minimum(counts, 3).astype(int) - 1, cut) if len(counts) else counts
        contexts, at = np.unique(keys >> 8, return_inverse=True)
        total = np.bincount(at, counts, len(contexts))
        backoff = np.bincount(at, discount, len(contexts)) / np.maximum(total, 1)
        return keys, (counts - discount) / total[at] if len(keys) else counts, contexts, backoff

    def _p(self, keys: np.ndarray, at: int) -> np.ndarray:
        """Interpolated probability of the last byte after the others, level by level."""
        if at == self.length:
            return np.full(len(keys), 1 / 256)
        known, share, contexts, backoff = self.levels[at]
        if not len(known):
            return self._p(shorter(keys, self.length - at - 1), at + 1)
        place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        seen = known[place] == keys
        out = share[place]
        new = keys[~seen]
        if len(new):
            where = np.minimum(np.searchsorted(contexts, new >> 8), len(contexts) - 1)
            weight = np.where(contexts[where] == new >> 8, backoff[where], 1.0)
            out[~seen] = weight * self._p(shorter(new, self.length - at - 1), at + 1)
        return out

    def log2(self, keys: np.ndarray) -> np.ndarray:
        return np.log2(self._p(keys.astype(np.int64), 0))


class ShardedKneserNey(KneserNey):
    """Levels up to four bytes; the counts of longer sequences are a table with a row for each shard.

    The levels are those of all trusted documents; ``near`` has the counts of every fold.
    """

    def __init__(self, grams: DataFrame, shards: int):
        names = [f"n{fold}" for fold in range(FOLDS)]
        found = grams.mapInArrow(_near_counts, f"key long, {', '.join(f'{n} long' for n in names)}").groupBy("key")
        found = found.agg(*(F.sum(n).cast("int").alias(n) for n in names)).toArrow()
        order = np.argsort(found["key"].to_numpy())
        keys, *counts = (found[name].to_numpy()[order] for name in ("key", *names))
        near = [(keys[n > 0], n[n > 0]) for n in counts]
        rows = grams.mapInArrow(_tallies, "fold long, length long, times long, n long").groupBy("fold", "length", "times")
        tallies = np.zeros((FOLDS, ORDER - NEAR, 4), np.int64)
        for fold, length, times, n in rows.agg(F.sum("n")).collect():
            tallies[fold, ORDER - length, times - 1] = n
        self.grams = grams
        self._set(near, tallies, shards)

    def _set(self, near: list, tallies: np.ndarray, shards: int) -> None:
        self.near, self.tallies, self.shards = near, tallies, shards
        super().__init__(*near[0], NEAR)
        self.below = {0: self}

    def __getstate__(self) -> tuple:
        """What goes to tasks."""
        return [(ppm.packed_keys(keys), ppm.packed(n), len(n)) for keys, n in self.near], self.tallies, self.shards

    def __setstate__(self, state: tuple) -> None:
        near = [(ppm.unpacked_keys(keys, size), ppm.unpacked(n, size, np.int32)) for keys, n, size in state[0]]
        self._set(near, *state[1:])

    def shard(self, keys: np.ndarray, counts: np.ndarray, fold: int) -> KneserNey:
        """All levels of a fold, the longer ones for the sequences of one shard."""
        if fold not in self.below:
            self.below[fold] = KneserNey(*self.near[fold], NEAR)
        return KneserNey(*_taught(keys, counts, fold), ORDER, self.below[fold], self.tallies[fold].tolist())


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id").distinct()


def _bytes(texts: DataFrame) -> int:
    return texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def _part() -> Column:
    """The fold that leaves a trusted text out."""
    return (F.pmod(F.xxhash64("text"), F.lit(FOLDS - 1)) + 1).alias("fold")


def train(docs: DataFrame, ids: DataFrame) -> ShardedKneserNey:
    texts = docs.select("doc_id", "text").join(bounded_broadcast(ids), "doc_id", "left_semi").select("text", _part())
    # As in ppm, the number of shards grows with the root of the text.
    shards = SHARDS * max(1, math.ceil(math.sqrt(_bytes(docs) / SHARED_BYTES)))
    dealt = texts.mapInArrow(_count(shards), _PACKED).repartition("shard").sortWithinPartitions("shard")
    return ShardedKneserNey(stored(dealt.mapInArrow(_summed, _PACKED), "sequences"), shards)


def _into_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each block as one compressed value, some megabytes of text at a time."""
    parts, held = [], 0

    def packed() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        block = table["block"].to_numpy()
        order = np.argsort(block, kind="stable")
        found, starts = np.unique(block[order], return_index=True)
        for which, own in zip(found, np.split(order, starts[1:])):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _TEXTS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table.select(_TEXTS.names).take(own).cast(_TEXTS))
            yield pa.RecordBatch.from_arrays([pa.array([which]), pa.array([sink.getvalue().to_pybytes()])], names=["block", "texts"])

    for batch in batches:
        for part in slices(batch, "text", PART):
            part = part.set_column(part.schema.get_field_index("text"), "text", part.column("text").cast(pa.large_string()))
            parts.append(part)
            held += part.column("text").nbytes
            if held >= BLOCK:
                yield from packed()
                parts, held = [], 0
    if parts:
        yield from packed()


def _unpacked(texts: pa.Array | pa.ChunkedArray) -> Iterator[pa.RecordBatch]:
    """Parts of the rows of a block."""
    for blob in texts:
        for batch in pa.ipc.open_stream(blob.as_buffer()):
            yield from slices(batch, "text", PART)


def _wanted(shards: int) -> Callable:
    """Distinct sequences of each block, by shard; rows of one block come together."""

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def asked() -> Iterator[pa.RecordBatch]:
            keys = _distinct(parts)
            for shard, own in _by_shard(keys, shards):
                yield _row(now, shard, keys[own], None)

        for batch in batches:
            for at, block in enumerate(batch.column("block").to_pylist()):
                if block != now:
                    yield from asked()
                    now, parts = block, []
                for part in _unpacked(batch.column("texts").slice(at, 1)):
                    parts += [_distinct([keys]) for keys, _ in _places(part)]
                    if len(parts) > 32:
                        parts = [_distinct(parts)]
        yield from asked()

    return wanted


def _answers(shared) -> Callable:
    """log2 probabilities of each block's sequences; a shard's counts come before its blocks."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        now = fold = None
        for block, shard, keys, numbers in _rows(batches):
            if shard != now:
                now, fold, counts = shard, None, (none, none)
            if block < 0:
                counts = keys, ppm.unpacked(numbers, len(keys), np.int64)
                continue
            if block >> 32 != fold:
                fold = block >> 32
                model = shared.value.shard(*counts, fold)
            yield _row(block, shard, keys, model.log2(keys).astype(np.float32))

    return answer


def _read(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """Size and perplexity of every text of a block."""
    rows = list(_rows(answers.select(["block", "shard", "size", "keys", "numbers"]).to_batches()))
    known = np.concatenate([np.zeros(0, np.int64), *(keys for _, _, keys, _ in rows)])
    prices = np.concatenate([np.zeros(0, np.float32), *(ppm.unpacked(n, len(keys), np.float32) for _, _, keys, n in rows)])
    order = np.argsort(known)
    known, prices = known[order], prices[order]
    out = []
    for part in _unpacked(texts["texts"]):
        sums = np.zeros(part.num_rows)
        for keys, row in _places(part):
            found, at = np.unique(keys, return_inverse=True)
            sums += np.bincount(row, prices[np.searchsorted(known, found)][at], part.num_rows)
        size = np.diff(utf8(part.column("text"))[1])
        found = pa.array(np.exp2(-sums / (size + 1)), mask=size == 0)
        out.append([part.column("doc_id"), part.column("lang"), pa.array(size), found])
    return pa.table([pa.chunked_array(c) for c in zip(*out)], names=["doc_id", "lang", "n_bytes", "perplexity"])


def perplexities(docs: DataFrame, model: ShardedKneserNey, ids: DataFrame) -> DataFrame:
    """doc_id, lang, number of bytes and perplexity of every row; ids are those of the trusted documents."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", "lang", "text").join(bounded_broadcast(ids).withColumn("trusted", F.lit(1)), "doc_id", "left")
    rows = rows.withColumn("fold", F.when(F.col("trusted") == 1, _part()).otherwise(0))
    sizes = dict(rows.groupBy("fold").agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).collect())
    blocks = [math.ceil(sizes.get(fold, 0) / BLOCK) + 1 for fold in range(FOLDS)]
    among = F.element_at(F.array(*map(F.lit, blocks)), F.col("fold").cast("int") + 1)
    block = F.shiftleft("fold", 32) + F.pmod(F.xxhash64("doc_id", "text"), among)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text", block.alias("block"))
    # Read twice in one plan, so that the exchange is made once; the block of a row follows from the row alone.
    held = rows.mapInArrow(_into_blocks, "block long, texts binary").repartition(min(sum(blocks), MOST_PARTITIONS), "block").sortWithinPartitions("block")
    wanted = held.mapInArrow(_wanted(model.shards), _PACKED)
    ordered = model.grams.unionByName(wanted).repartition("shard").sortWithinPartitions("shard", "block")
    answers = ordered.mapInArrow(_answers(shared), _PACKED).withColumn("reader", F.col("block"))
    return held.groupBy("block").cogroup(answers.groupBy("reader")).applyInArrow(
        _read, "doc_id long, lang string, n_bytes long, perplexity double"
    )


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Perplexity of each row, the limit of its language, and whether it is kept."""
    good = stored(trusted_ids(labels), "trusted")
    scored = stored(perplexities(docs, train(docs, good), good), "perplexities")
    trusted = scored.join(good, "doc_id", "left_semi")
    limit = (F.percentile_approx("perplexity", QUANTILE, 10_000) * MARGIN).alias("own_limit")
    by_lang = trusted.where("lang IS NOT NULL").groupBy("lang").agg(limit)
    overall = trusted.agg((F.percentile_approx("perplexity", QUANTILE, 10_000) * MARGIN).alias("limit")).first()[0]
    threshold = F.coalesce("own_limit", F.lit(overall).cast("double"), F.lit(float("inf")))
    return (
        scored.join(by_lang, "lang", "left")
        .withColumn("limit", threshold)
        .withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("limit"), F.lit(False)))
        .select("doc_id", "lang", "n_bytes", "perplexity", "limit", "kept")
    )
