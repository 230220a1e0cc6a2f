"""Language-model scores: a word baseline, and prediction by partial matching over bytes.

The trie holds how often each byte, or the end, followed each context of up to five
bytes in all training texts. A symbol seen after a context costs its share; otherwise
an escape is paid (as likely as a new symbol was: method C) and the next shorter
context is asked, without the symbols just ruled out. What followed a context also
followed its suffixes, so a context's own symbols are all that its suffix excludes.

Texts lie in blocks of some megabytes. A block's distinct grams (five bytes and the
symbol after them) are counted once and dealt to shards by the last three bytes of the
context, packed. A shard adds its blocks' counts up: that is the trie, in which counts
of shorter contexts are sums over longer ones, and every context from three bytes up is
whole in one shard. The counts of shorter contexts go to all tasks, 65,536 pairs by 257
symbols at most. Then each shard prices its grams and answers the blocks one after the
other, and each block's texts are read against its answers. So the trie grows with the
corpus, while a task holds one shard of it, or the part that one block can reach. The
number of shards grows with the root of the text, as the number of grams does or less.
The words of the baseline go the same way, told apart by a 64-bit hash.

Defined results: a null text is empty and consists of its end. Before a text stand
five zero bytes. Repeated rows are scored each. Without training texts every symbol
is equally likely. A text longer than a block is a block, read in parts. An empty
table gives an empty one; other columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.language_id import remainder
from fleetgauge.llm.text import mix, slices, utf8, word_hashes
from fleetgauge.session import stored

ORDER = 5
NEAR = 2  # contexts up to this length go to all tasks
SYMBOLS = 257
END = 256
BLOCK = 16 << 20
PART = 1 << 20
PENDING = 1 << 20
SHARDS = 32
SHARED_BYTES = 1 << 29

_SYMBOL_BITS = 9
TEXT, WORD, GRAM = 0, 1, 2

_PACKED = [("block", pa.int64()), ("kind", pa.int8()), ("shard", pa.int32()), ("size", pa.int64()),
           ("keys", pa.binary()), ("numbers", pa.binary())]
_PACKED_DDL = "block long, kind byte, shard int, size long, keys binary, numbers binary"
_BLOCKS = pa.schema([*_PACKED, ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("text", pa.large_string())])
_TALLY = pa.schema([*_PACKED, ("total", pa.int64()), ("seen", pa.int64())])


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, all first bytes before all second ones."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(blob: bytes, size: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = pa.decompress(blob, decompressed_size=size * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(width, size).T).view(kind)[:, 0]


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys, as the steps between them."""
    return packed(np.diff(keys, prepend=np.int64(0)))


def unpacked_keys(blob: bytes, size: int) -> np.ndarray:
    return np.cumsum(unpacked(blob, size, np.int64))


def _rows(schema: pa.Schema, rows: int, **given) -> pa.RecordBatch:
    """A batch with the given columns (or one value for all rows), others null."""
    def column(field):
        value = given.get(field.name)
        if isinstance(value, list):
            return pa.array(value, field.type)
        if isinstance(value, pa.Array):
            return value.cast(field.type)
        return pa.nulls(rows, field.type) if value is None else pa.array([value] * rows, field.type)

    return pa.RecordBatch.from_arrays([column(f) for f in schema], schema=schema)


def context_of(keys: np.ndarray, length: int) -> np.ndarray:
    """The last bytes of the grams' contexts, the last one highest."""
    return keys >> (_SYMBOL_BITS + 8 * (ORDER - length))


def _keys(line: np.ndarray) -> np.ndarray:
    """The gram at each place of a line but its first five: nearest byte first, symbol last."""
    keys = line[ORDER:].copy()
    for back in range(1, ORDER + 1):
        keys |= line[ORDER - back : len(line) - back] << (_SYMBOL_BITS + 8 * (ORDER - back))
    return keys


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grams of texts laid end to end, and the text each is from. One long text comes in parts."""
    count = len(offsets) - 1
    if count == 1:
        for start in range(0, max(len(data), 1), PART):
            stop = min(start + PART, len(data))
            line = np.zeros(ORDER, np.int64)
            before = data[max(0, start - ORDER) : start]
            line[ORDER - len(before) :] = before
            line = np.r_[line, data[start:stop].astype(np.int64), [END] * (stop == len(data))]
            keys = _keys(line.astype(np.int64))
            yield keys, np.zeros(len(keys), np.int64)
        return
    lengths = np.diff(offsets)
    step = ORDER + 1
    line = np.zeros(len(data) + step * count, np.int64)
    rows = np.repeat(np.arange(count), lengths)
    at = np.arange(len(data)) + ORDER + step * rows
    line[at] = data
    ends = offsets[1:] + ORDER + step * np.arange(count)
    line[ends] = END
    places = np.r_[at, ends]
    yield _keys(line)[places - ORDER], np.r_[rows, np.arange(count)]


def _merged(parts: list) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return found, np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)


def _shard(kind: int, keys: np.ndarray, shards: int) -> np.ndarray:
    """Grams go by the last three bytes of their context, words by their hash."""
    spread = mix(context_of(keys, NEAR + 1).astype(np.uint64)) if kind == GRAM else keys.view(np.uint64)
    return (spread % np.uint64(shards)).astype(np.int32)


def _in_blocks(shards: int) -> Callable:
    """Texts with their block, and each block's words and grams by shard, with their training counts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, held = TaskContext.get().partitionId() << 32, 0
        parts: dict[int, list] = {WORD: [], GRAM: []}

        def counts() -> Iterator[pa.RecordBatch]:
            for kind in parts:
                keys, n = _merged(parts[kind])
                parts[kind] = []
                shard = _shard(kind, keys, shards)
                order = np.argsort(shard, kind="stable")
                found, starts = np.unique(shard[order], return_index=True)
                for which, own in zip(found, np.split(order, starts[1:])):
                    own_keys, own_n = packed_keys(keys[own]), packed(n[own])
                    yield _rows(_BLOCKS, 1, block=block, kind=kind, shard=which, size=len(own), keys=[own_keys], numbers=[own_n])

        for batch in batches:
            for part in slices(batch, "text", PART):
                data, offsets = utf8(part.column("text"))
                aside = part.column("held_out").to_numpy(zero_copy_only=False).astype(np.int64)
                hashes, where = word_hashes(data, offsets)
                words, at = np.unique(hashes.view(np.int64), return_inverse=True)
                train = np.repeat(1 - aside, np.diff(where))
                parts[WORD].append((words, np.bincount(at, train, len(words)).astype(np.int64)))
                for keys, row in grams(data, offsets):
                    found, n = np.unique(keys << 1 | aside[row], return_counts=True)
                    parts[GRAM].append((found >> 1, np.where(found & 1, 0, n)))
                    if len(parts[GRAM]) > 8:
                        parts[GRAM] = [_merged(parts[GRAM])]
                own = {name: part.column(name) for name in ("doc_id", "held_out", "text")}
                yield _rows(_BLOCKS, part.num_rows, block=block, kind=TEXT, **own)
                held += len(data)
                if held >= BLOCK:
                    yield from counts()
                    block, held = block + 1, 0
        yield from counts()

    return cut


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows one by one."""
    names = [name for name, _ in _PACKED]
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in names))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each shard over its blocks; rows of one shard come together."""
    now, waiting, held = None, [], 0

    def out() -> pa.RecordBatch:
        (keys, n), (kind, shard) = _merged(waiting), now
        sums = {"total": int(n.sum()), "seen": int((n > 0).sum())}
        return _rows(_TALLY, 1, block=-1, kind=kind, shard=shard, size=len(keys), keys=[packed_keys(keys)], numbers=[packed(n)], **sums)

    for _, kind, shard, size, keys, n in _by_shard(batches):
        if now is not None and now != (kind, shard):
            yield out()
            waiting, held = [], 0
        now = kind, shard
        waiting.append((unpacked_keys(keys, size), unpacked(n, size, np.int64)))
        held += size
        if held > PENDING + 2 * len(waiting[0][0]):
            waiting = [_merged(waiting)]
            held = len(waiting[0][0])
    if now is not None:
        yield out()


def _near_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each symbol followed each pair, within a shard."""
    for *_, size, keys, n in _by_shard(batches):
        keys, n = unpacked_keys(keys, size), unpacked(n, size, np.int64)
        pairs = context_of(keys, NEAR) * SYMBOLS + (keys & (2**_SYMBOL_BITS - 1))
        found, sums = _merged([(pairs[n > 0], n[n > 0])])
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums)], names=["key", "n"])


class Near:
    """Counts of symbols after contexts of two bytes, one and none."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        """Keys are a pair's number (the last byte highest) times 257 plus the symbol."""
        order = np.argsort(keys)
        self.keys, self.n = keys[order], n[order].astype(np.float64)
        pair, symbol = np.divmod(self.keys, SYMBOLS)
        self.one = np.bincount((pair >> 8) * SYMBOLS + symbol, self.n, 256 * SYMBOLS).reshape(256, SYMBOLS)
        self.none = self.one.sum(axis=0)
        self.total2 = np.bincount(pair, self.n, 1 << 16)
        self.kinds2 = np.bincount(pair, minlength=1 << 16).astype(np.float64)
        self.shut2 = np.bincount(pair, self.one[pair >> 8, symbol], 1 << 16)
        self.total1, self.kinds1 = self.one.sum(axis=1), (self.one > 0).sum(axis=1)
        self.shut1 = np.where(self.one > 0, self.none, 0).sum(axis=1)

    def after_pair(self, pair: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(pair))
        wanted = pair * SYMBOLS + symbol
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.n[at], 0.0)


def _step(below, n, total, kinds, full):
    """Method C at one context: a seen symbol by count, the escape spread as ``below``."""
    size = np.maximum(np.where(full, total, total + kinds), 1)
    escape = np.where(full, 0.0, np.where(total > 0, kinds / size, 1.0))
    return np.where(n > 0, n / size, escape * below)


def prices(keys: np.ndarray, counts: np.ndarray, near: Near) -> np.ndarray:
    """log10 probability of each gram's symbol after its context.

    Keys are sorted and distinct, and hold all grams with the contexts of three bytes
    that occur in them; a gram that only texts to be scored have counts 0.
    """
    symbol, pair = keys & (2**_SYMBOL_BITS - 1), context_of(keys, NEAR)
    byte = pair >> 8
    n = {0: near.none[symbol], 1: near.one[byte, symbol], NEAR: near.after_pair(pair, symbol)}
    total = {0: near.none.sum(), 1: near.total1[byte], NEAR: near.total2[pair]}
    kinds = {0: (near.none > 0).sum(), 1: near.kinds1[byte], NEAR: near.kinds2[pair]}
    # What the symbols of a context come to in the next shorter one.
    shut = {1: near.shut1[byte], NEAR: near.shut2[pair]}
    for k in range(NEAR + 1, ORDER + 1):
        context = context_of(keys, k)
        segment = np.cumsum(np.r_[0, context[1:] != context[:-1]])
        _, first, at = np.unique(segment * SYMBOLS + symbol, return_index=True, return_inverse=True)
        sums = np.bincount(at, counts)
        own = segment[first]
        n[k] = sums[at]
        total[k] = np.bincount(segment, counts)[segment]
        kinds[k] = np.bincount(own, sums > 0)[segment]
        shut[k] = np.bincount(own, np.where(sums > 0, n[k - 1][first], 0))[segment]
    p = np.full(len(keys), 1.0 / max(SYMBOLS - kinds[0], 1))
    for k in range(ORDER):
        p = _step(p, n[k], total[k] - shut[k + 1], kinds[k] - kinds[k + 1], kinds[k] == SYMBOLS)
    return np.log10(_step(p, n[ORDER], total[ORDER], kinds[ORDER], kinds[ORDER] == SYMBOLS))


def _answers(near) -> Callable:
    """Each block's counts of words and prices of grams; a shard's sums come before its blocks."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, kind, shard, size, blob, n in _by_shard(batches):
            keys = unpacked_keys(blob, size)
            if block < 0:
                held, values = keys, unpacked(n, size, np.int64)
                if kind == GRAM:
                    values = prices(keys, values, near.value).astype(np.float32)
                continue
            found = packed(values[np.searchsorted(held, keys)])
            yield _rows(pa.schema(_PACKED), 1, block=block, kind=kind, shard=shard, size=size, keys=[blob], numbers=[found])

    return answer


def _read(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """Tokens, known words and both sums of every text of a block."""
    tables = {}
    for kind, number in ((WORD, np.int64), (GRAM, np.float32)):
        rows = [r for r in _by_shard(answers.to_batches()) if r[1] == kind]
        keys = np.concatenate([np.zeros(0, np.int64), *(unpacked_keys(r[4], r[3]) for r in rows)])
        values = np.concatenate([np.zeros(0, number), *(unpacked(r[5], r[3], number) for r in rows)])
        order = np.argsort(keys)
        tables[kind] = keys[order], values[order]

    def found(kind, wanted):
        return tables[kind][1][np.searchsorted(tables[kind][0], wanted)]

    out = []
    for batch in texts.combine_chunks().to_batches():
        for part in slices(batch, "text", PART):
            data, offsets = utf8(part.column("text"))
            size = part.num_rows
            hashes, where = word_hashes(data, offsets)
            row = np.repeat(np.arange(size), np.diff(where))
            counts = found(WORD, hashes.view(np.int64))
            logs = np.bincount(row, np.log10(counts + 0.5), size).astype(float)
            score = np.zeros(size)
            for keys, rows in grams(data, offsets):
                score += np.bincount(rows, found(GRAM, keys), size)
            known = np.bincount(row, counts > 0, size).astype(np.int64)
            numbers = [np.diff(where) + 1, known, logs, score]
            out.append([part.column("doc_id"), part.column("held_out"), *map(pa.array, numbers)])
    columns = [pa.chunked_array(c) for c in zip(*out)]
    return pa.table(columns, names=["doc_id", "held_out", "n_tokens", "known", "logs", "score"])


def score_documents(docs: DataFrame) -> DataFrame:
    """Baseline and model score of every row, learning from four fifths of them by id."""
    held_out = F.coalesce(remainder("doc_id", 5) == 1, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"))
    ends, size = rows.agg(F.count_if(~F.col("held_out")), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    shards = SHARDS * max(1, math.ceil(math.sqrt(size / SHARED_BYTES)))
    ddl = f"{_PACKED_DDL}, doc_id long, held_out boolean, text string"
    blocks = stored(rows.mapInArrow(_in_blocks(shards), ddl), "lm-blocks")
    names = [name for name, _ in _PACKED]
    wanted = blocks.where(F.col("kind") != TEXT).select(*names)
    dealt = wanted.repartition("kind", "shard").sortWithinPartitions("kind", "shard")
    tally = stored(dealt.mapInArrow(_summed, f"{_PACKED_DDL}, total long, seen long"), "lm-counts")

    sums = tally.where(F.col("kind") == WORD).agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("seen"), F.lit(0))).first()
    total, kinds = sums[0] + ends, sums[1] + (ends > 0)
    near = tally.where(F.col("kind") == GRAM).select(*names).mapInArrow(_near_counts, "key long, n long")
    near = near.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    shared = docs.sparkSession.sparkContext.broadcast(Near(near["key"].to_numpy(), near["n"].to_numpy()))
    both = tally.select(*names).unionByName(wanted.withColumn("numbers", F.lit(None).cast("binary")))
    ordered = both.repartition("kind", "shard").sortWithinPartitions("kind", "shard", "block")
    answers = ordered.mapInArrow(_answers(shared), _PACKED_DDL).withColumnRenamed("block", "reader")

    texts = blocks.where(F.col("kind") == TEXT).select("block", "doc_id", "held_out", "text")
    answers = answers.select("reader", F.col("reader").alias("block"), "kind", "shard", "size", "keys", "numbers")
    scored = texts.groupBy("block").cogroup(answers.groupBy("reader")).applyInArrow(
        _read, "doc_id long, held_out boolean, n_tokens long, known long, logs double, score double"
    )
    below = float(np.log10(total + 0.5 * (kinds + 1)))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") + float(np.log10(ends + 0.5)) - F.col("n_tokens") * below).alias("base_score"),
        "score",
    )
