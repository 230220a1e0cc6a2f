"""Exact Jaccard join of documents on word shingles, through groups of similar sets.

Equal sets are one set from the start. What follows finds the components of
the graph in which two sets link when 100 * |A and B| >= 75 * |A or B|:

1. All shingles are counted over hash buckets. A set that shares less than
   three quarters of its shingles with any other set can't link: the union of
   all others is the first, widest group whose overlap is bounded. The number
   of shared shingles also bounds the size of any partner, its reach.
2. Sets that remain are linked, where the exact similarity allows, with the set
   of the widest reach that agrees with them in most of their MinHash values,
   and so fall into components of similar sets.
3. Components are cut into groups of at most about ``GROUP`` sets. The matrix
   of shingles and groups is probed with the rarest quarter of each set's
   shingles; one of them must lie in any group with a partner. A set leaves the
   shingles at which no set of another component is within its reach.
4. Groups that meet at a shingle, within reach of each other, are compared as
   a pair: for each set of one, the exact overlap with the other's shingle
   union bounds the similarity to all its members. Only groups that reach three
   quarters of the set are opened, and their members compared one by one.

Sets are compared exactly on 64-bit shingle hashes. The survey tells shingles
apart by fewer bits, which can only leave a set in. Nothing is capped or left
out; the sample that orders shingles by frequency only affects how many
groups are probed. No step emits the pairs within a component. Tables that a
later one replaces are removed once that is written.

Defined results: a null text, or one without words, has an empty set, no links
and itself as component. With fewer words than a shingle has, the whole
sequence is the only one. Repeated rows are in one component. A null doc_id is
never a component's id unless there is no other. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgauge import storage
from fleetgauge.llm.components import components
from fleetgauge.llm.text import mix, slices, utf8, word_hashes
from fleetgauge.session import fresh_path, stored

WORDS = 5
GROUP = 64
KEYS = 8
BUCKET_TOKENS = 2_000_000
DEAL_BYTES = 8 << 20
SAMPLE_SETS = 4096
OPEN_BITS = 1 << 27
COMMON_TOKENS = 1 << 20

_U = np.uint64
_PLACES = mix(np.arange(101, 101 + WORDS, dtype=np.uint64)) | _U(1)
_SEEDS = mix(np.arange(7, 7 + KEYS, dtype=np.uint64)) | _U(1)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the five-word sequences of one text."""
    count = len(hashes) - WORDS + 1
    if not len(hashes):
        return hashes
    if count < 1:
        whole = (hashes * _PLACES[: len(hashes)]).sum(dtype=np.uint64) + _U(len(hashes))
        return mix(np.array([whole], np.uint64))
    total = hashes[:count] * _PLACES[0]
    for k in range(1, WORDS):
        total = total + hashes[k : count + k] * _PLACES[k]
    total = np.sort(mix(total))
    return total[np.r_[True, total[1:] != total[:-1]]]


def signature(tokens: np.ndarray) -> int:
    return int(mix(mix(tokens ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True))[0].view(np.int64))


def _sets(part: pa.RecordBatch) -> list[np.ndarray]:
    hashes, where = word_hashes(*utf8(part.column("text")))
    return [shingles(hashes[a:b]) for a, b in zip(where[:-1], where[1:])]


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    starts = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    return starts, np.diff(np.r_[starts, len(sorted_values)])


_BINARY = ("doc_ids", "known", "marks", "sizes", "sigs", "tokens", "owners")
PACKED = "bucket int, batch long, " + ", ".join(f"{n} binary" for n in _BINARY)
_PACKED = pa.schema(
    [("bucket", pa.int32()), ("batch", pa.int64()), *[(n, pa.binary()) for n in _BINARY]]
)
REPLY = PACKED.removeprefix("bucket int, ")


def _packed(bucket: int, batch: int, **columns: np.ndarray) -> dict:
    values = {n: columns[n].tobytes() if n in columns else None for n in _BINARY}
    return {"bucket": bucket, "batch": batch} | values


def _deal(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Pack the shingles of each batch by bucket.

    A shingle that several sets of the batch have is counted here, and two of
    them stand for all, so a bucket gets no more than two rows of it from a batch.
    """
    first_batch = TaskContext.get().partitionId() << 32
    dealt = (part for batch in batches for part in slices(batch, "text", DEAL_BYTES))
    for number, batch in enumerate(dealt, first_batch):
        ids, marks, sizes, sigs, tokens, first = [], [], [], [], [], {}
        for part in slices(batch, "text"):
            ids.append(part.column("doc_id"))
            marks.append(part.column("mark"))
            for own in _sets(part):
                sig = signature(own) if len(own) else 0
                sizes.append(len(own))
                sigs.append(sig)
                if len(own) and sig not in first:
                    first[sig] = len(tokens)
                    tokens.append(own)
        doc_ids = pa.chunked_array(ids, pa.int64())
        rows = [
            _packed(
                (number * 7919 + len(sigs)) % buckets,
                number,
                doc_ids=doc_ids.fill_null(0).to_numpy(),
                known=doc_ids.is_valid().to_numpy(),
                marks=pa.chunked_array(marks, pa.int64()).to_numpy(),
                sizes=np.array(sizes, np.int64),
                sigs=np.array(sigs, np.int64),
            )
        ]
        if tokens:
            own_sigs = np.fromiter(first, np.int64, len(first))
            owner = np.repeat(np.arange(len(tokens), dtype=np.int32), [len(t) for t in tokens])
            flat = np.concatenate(tokens)
            tokens.clear()
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], owner[order]
            del order
            starts, lengths = _runs(flat)
            shared = np.repeat(lengths > 1, lengths)
            counts = np.bincount(owner[shared], minlength=len(own_sigs)).astype(np.int64)
            held = counts > 0
            # Without ids, but marked as this batch's own counts.
            rows.append(
                _packed(
                    (number * 104729 + 1) % buckets,
                    number,
                    sizes=counts[held],
                    sigs=own_sigs[held],
                    known=np.zeros(1, bool),
                )
            )
            keep = np.zeros(len(flat), bool)
            keep[starts] = True
            keep[starts[lengths > 1] + 1] = True
            flat, owner, shared = flat[keep], owner[keep], shared[keep]
            bucket = ((flat >> _U(32)) * _U(buckets)) >> _U(32)
            cuts = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                x = slice(cuts[b], cuts[b + 1])
                present, owners = np.unique(owner[x], return_inverse=True)
                rows.append(
                    _packed(
                        b,
                        number,
                        sigs=own_sigs[present],
                        tokens=flat[x].astype(np.uint32),
                        owners=(owners.astype(np.uint32) << np.uint32(1)) | shared[x],
                    )
                )
        yield pa.RecordBatch.from_pylist(rows, _PACKED)


def _counted(table: pa.Table) -> pa.Table:
    """For each batch, one row with the number of this bucket's shingles that sets share with others.

    Rows of documents, and of what a batch has counted itself, pass through.
    """
    read = lambda value, kind: np.frombuffer(value, kind)
    out, tokens, owners, flags, origins = [], [], [], [], []
    for row in table.to_pylist():
        if row["tokens"] is None:
            out.append(row)
            continue
        own = read(row["owners"], np.uint32)
        tokens.append(read(row["tokens"], np.uint32))
        owners.append(read(row["sigs"], np.int64)[own >> np.uint32(1)])
        flags.append((own & np.uint32(1)).astype(bool))
        origins.append(np.full(len(own), row["batch"], np.int64))
    if tokens:
        flat, owner, flag, origin = (np.concatenate(x) for x in (tokens, owners, flags, origins))
        order = np.lexsort((flag, owner, flat))
        flat, owner, flag, origin = flat[order], owner[order], flag[order], origin[order]
        # A set may come from several batches; where its row is not yet counted, it comes first.
        new = np.r_[True, (flat[1:] != flat[:-1]) | (owner[1:] != owner[:-1])]
        flat, owner, flag, origin = flat[new], owner[new], flag[new], origin[new]
        _, lengths = _runs(flat)
        here = np.repeat(lengths > 1, lengths) & ~flag
        owner, origin = owner[here], origin[here]
        order = np.lexsort((owner, origin))
        owner, origin = owner[order], origin[order]
        if len(owner):
            starts = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (origin[1:] != origin[:-1])])
            sigs, counts, of = owner[starts], np.diff(np.r_[starts, len(owner)]), origin[starts]
            edges = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            for a, b in zip(edges, np.r_[edges[1:], len(of)]):
                out.append(_packed(0, int(of[a]), sigs=sigs[a:b], sizes=counts[a:b].astype(np.uint32)))
    schema = pa.schema(list(_PACKED)[1:])
    return pa.Table.from_pylist(out, schema)


SURVEYED = "doc_id long, mark long, n long, sig long, local long, shared long"


def _summed(table: pa.Table) -> pa.Table:
    """Rows of a batch's documents, and of each of its sets the number of shared shingles."""
    out, sigs, counts = [], [], []
    for row in table.to_pylist():
        own = np.frombuffer(row["sigs"], np.int64)
        if row["known"] is None:
            sigs.append(own)
            counts.append(np.frombuffer(row["sizes"], np.uint32))
            continue
        sizes = np.frombuffer(row["sizes"], np.int64)
        if row["doc_ids"] is None:
            out.append(pa.table({"sig": own, "local": sizes}))
            continue
        ids = np.frombuffer(row["doc_ids"], np.int64)
        known = np.frombuffer(row["known"], bool)
        marks = np.frombuffer(row["marks"], np.int64)
        out.append(pa.table({"doc_id": pa.array(ids, mask=~known), "mark": marks, "n": sizes, "sig": own}))
    if sigs:
        found, where = np.unique(np.concatenate(sigs), return_inverse=True)
        shared = np.bincount(where, np.concatenate(counts), len(found)).astype(np.int64)
        out.append(pa.table({"sig": found, "shared": shared}))
    blank = pa.schema([(c.split()[0], pa.int64()) for c in SURVEYED.split(", ")]).empty_table()
    return pa.concat_tables([blank, *out], promote_options="default").select(blank.column_names)


def _survey(docs: DataFrame) -> DataFrame:
    """Each document's set, and how many shingles of each set other sets share."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(8, -(-size // (6 * BUCKET_TOKENS)))
    marked = docs.select(F.col("doc_id").cast("long"), "text", _mark().alias("mark"))
    dealt = marked.mapInArrow(partial(_deal, buckets=buckets), PACKED)
    counted = dealt.groupBy("bucket").applyInArrow(_counted, REPLY)
    return stored(counted.groupBy("batch").applyInArrow(_summed, SURVEYED), "shingle-counts")


def _mark() -> Column:
    """Tells rows of one id with different texts apart."""
    return F.xxhash64("text")


def _full_sets(batches: Iterator[pa.RecordBatch], wanted: Broadcast) -> Iterator[pa.RecordBatch]:
    """Shingles and MinHash values of the texts whose id may be wanted."""
    bits = wanted.value
    for batch in batches:
        place = batch.column("place").to_numpy()
        batch = batch.filter(pa.array((bits[place >> 3] >> (place & 7)) & 1 == 1))
        for part in slices(batch, "text"):
            own = [t for t in _sets(part) if len(t)]
            keys = [
                np.array([mix(t * s).min() for s in _SEEDS], np.uint64).view(np.int64) for t in own
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([signature(t) for t in own], pa.int64()),
                    pa.array([len(t) for t in own], pa.int64()),
                    pa.array([t.view(np.int64) for t in own], pa.list_(pa.int64())),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["sig", "n", "tokens", "keys"],
            )


def _place(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(OPEN_BITS))


def _open_bits(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size in which every id of the frame has its bit; others may share one."""
    placed = ids.select((_place("doc_id") + 1).alias("place"))  # buckets and bits count from 1
    maps = placed.groupBy(F.bitmap_bucket_number("place").alias("number")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    out = np.zeros(OPEN_BITS // 8, np.uint8)
    for row in maps.collect():
        own = np.frombuffer(row.bits, np.uint8)
        out[(row.number - 1) * len(own) : row.number * len(own)] = own
    return out


def _linked(overlap: str, left: str, right: str) -> Column:
    return F.expr(f"100 * {overlap} >= 75 * ({left} + {right} - {overlap})")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets that link, as found by comparing all their shingles."""
    left = sets.select(F.col("sig").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    right = sets.select(F.col("sig").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    both = pairs.join(left, "a").join(right, "b")
    overlap = both.withColumn("overlap", F.size(F.array_intersect("t_a", "t_b")))
    return overlap.where(_linked("overlap", "n_a", "n_b")).select("a", "b")


def _within_reach(a: str, b: str) -> str:
    """Neither set is larger than a partner of the other can be."""
    return f"{a}.n <= {b}.reach AND {b}.n <= {a}.reach"


def _leader_links(sets: DataFrame) -> DataFrame:
    """Links of sets with one that agrees with them in MinHash values.

    The set of the widest reach leads those with a value: it has least that
    no other set has, and so is closest to all that share its core. Of its
    leaders, a set is compared with the one that leads most of its values.
    """
    keyed = sets.select("sig", "n", "reach", F.posexplode("keys").alias("k", "value"))
    leaders = keyed.groupBy("k", "value").agg(
        F.max(F.struct("reach", (-F.col("n")).alias("less"), "sig")).alias("first"), F.count("*").alias("size")
    )
    leaders = leaders.where("size > 1").select(
        "k", "value", "first.sig", "first.reach", (-F.col("first.less")).alias("n")
    )
    pairs = (
        keyed.alias("x")
        .join(leaders.alias("y"), ["k", "value"])
        .where(f"x.sig <> y.sig AND {_within_reach('x', 'y')}")
        .groupBy(F.col("x.sig").alias("a"), F.col("y.sig").alias("b"), F.col("y.reach").alias("reach"))
        .agg(F.count("*").alias("agreed"))
    )
    best = pairs.groupBy("a").agg(F.max_by("b", F.struct("agreed", "reach", "b")).alias("b"))
    return _verified(best, sets)


def _common_tokens(sets: DataFrame) -> np.ndarray:
    """Shingles that several sets of a bounded sample have, the most frequent ones first.

    They only order shingles, from rare to frequent.
    """
    share = SAMPLE_SETS / max(sets.count(), 1)
    sample = sets.where(F.pmod(F.xxhash64("sig"), F.lit(1 << 20)) < int(min(1.0, share) * (1 << 20)))
    counts = (
        sample.select(F.explode("tokens").alias("token"))
        .groupBy("token")
        .count()
        .where("count > 2")
        .orderBy(F.desc("count"), "token")
        .limit(COMMON_TOKENS)
        .toArrow()
    )
    tokens, seen = counts["token"].to_numpy(), counts["count"].to_numpy()
    order = np.argsort(tokens)
    return np.stack([tokens[order], seen[order]])


def _prefixes(sets: DataFrame) -> DataFrame:
    """The rarest quarter of each set's shingles, of which a partner must have one."""
    shared = sets.sparkSession.sparkContext.broadcast(_common_tokens(sets))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, seen = shared.value
        for batch in batches:
            out = []
            for own in batch.column("tokens"):
                tokens = own.values.to_numpy()
                at = np.minimum(np.searchsorted(common, tokens), max(len(common) - 1, 0))
                rank = (
                    np.where(common[at] == tokens, seen[at], 0) if len(common) else np.zeros(len(tokens))
                )
                order = np.lexsort((tokens, rank))
                out.append(tokens[order[: len(tokens) - -(-3 * len(tokens) // 4) + 1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("sig"), pa.array(out, pa.list_(pa.int64()))], names=["sig", "prefix"]
            )

    cuts = sets.select("sig", "tokens").mapInArrow(cut, "sig long, prefix array<long>")
    return cuts.select("sig", F.posexplode("prefix").alias("before", "token"))


def _grouped(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Each set's component, and the number of its group within it; groups are of a bounded size."""
    named = roots.withColumnRenamed("node", "sig")
    placed = sets.select("sig", "n", "reach").join(named, "sig", "left")
    placed = placed.withColumn("root", F.coalesce("root", "sig"))
    sizes = placed.groupBy("root").agg(F.count("*").alias("size"))
    part = F.pmod(F.xxhash64("sig"), F.ceil(F.col("size") / GROUP)).cast("int")
    return placed.join(sizes, "root").withColumn("part", part).drop("size")


def _with_strangers(probes: DataFrame) -> DataFrame:
    """Probes at shingles where a set of another component may be within reach."""
    across = probes.groupBy("token").agg(
        F.min("root").alias("lo"),
        F.max("root").alias("hi"),
        F.min("n").alias("least"),
        F.max("reach").alias("most"),
    )
    alive = probes.join(across.where("lo <> hi"), "token").where("least <= reach AND n <= most")
    return alive.select(*probes.columns)


def _opened_links(sets: DataFrame, placed: DataFrame, scratch: Scratch) -> DataFrame:
    """Links between sets of different components, as components a and b."""
    probes = _prefixes(sets).join(placed, "sig")
    # If this is the rarest shingle of both, they share no more than what follows it.
    here = F.floor((4 * F.col("n") - 7 * F.col("before")) / 3)
    probes = probes.withColumn("reach", F.least("reach", here)).drop("before")
    # What the first round takes away may have been all that kept others.
    probes = scratch.keep("probes", _with_strangers(probes))
    probes = scratch.keep("near-probes", _with_strangers(probes), replaces="probes")
    matrix = probes.groupBy("token", "root", "part").agg(
        F.min("n").alias("n"), F.max("reach").alias("reach")
    )
    met = (
        matrix.alias("x")
        .join(matrix.alias("y"), "token")
        .where(f"x.root < y.root AND {_within_reach('x', 'y')}")
        .select(
            F.col("x.root").alias("root"),
            F.col("x.part").alias("part"),
            F.col("y.root").alias("other"),
            F.col("y.part").alias("open"),
        )
        .distinct()
    )
    met = scratch.keep("group-pairs", met, replaces="near-probes")
    group = placed.select("sig", "root", "part")
    wanted = group.join(
        met.select(F.col("other").alias("root"), F.col("open").alias("part")).distinct(), ["root", "part"], "left_semi"
    )
    unions = (
        sets.select("sig", "tokens")
        .join(wanted, "sig")
        .groupBy("root", "part")
        .agg(F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union"))
        .withColumnsRenamed({"root": "other", "part": "open"})
    )
    queries = met.join(group, ["root", "part"]).join(sets.select("sig", "n", "reach", "tokens"), "sig")
    bounded = (
        queries.join(unions, ["other", "open"])
        .where(4 * F.size(F.array_intersect("tokens", "union")) >= 3 * F.col("n"))
        .select("sig", "n", "reach", "root", "other", "open")
    )
    members = placed.select(
        F.col("root").alias("other"), F.col("part").alias("open"), F.col("sig").alias("b"), "n", "reach"
    )
    pairs = (
        bounded.alias("x")
        .join(members.alias("y"), ["other", "open"])
        .where(_within_reach("x", "y"))
        .select(F.col("x.sig").alias("a"), F.col("y.b"))
        .distinct()
    )
    pairs = scratch.keep("opened", pairs, replaces="group-pairs")
    root = placed.select("sig", "root")
    return (
        _verified(pairs, sets)
        .join(root.select(F.col("sig").alias("a"), F.col("root").alias("root_a")), "a")
        .join(root.select(F.col("sig").alias("b"), F.col("root").alias("root_b")), "b")
        .select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    )


class Scratch:
    """Tables in the shared folder that are removed once a later one replaces them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.paths = spark, {}

    def keep(self, name: str, frame: DataFrame, replaces: str | None = None) -> DataFrame:
        path = self.paths[name] = fresh_path(self.spark, name)
        frame.write.parquet(path)
        if replaces:
            self.drop(replaces)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            storage.drop_folder(self.spark, self.paths.pop(name))


def _joined(docs: DataFrame) -> DataFrame:
    """Each row's doc_id, mark, number of shingles and component, as the id of one of its sets."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    survey = _survey(docs)
    rows = survey.where("n IS NOT NULL").select("doc_id", "mark", "n", "sig")
    # What all of a set's batches count themselves is in each of their counts.
    both = F.coalesce(F.max("local"), F.lit(0)) + F.coalesce(F.sum("shared"), F.lit(0))
    counts = survey.where("n IS NULL").groupBy("sig").agg(both.alias("shared"))
    own = rows.where("n > 0").groupBy("sig").agg(F.first("n").alias("n"), F.min("doc_id").alias("doc_id"))
    # 7 * overlap >= 3 * (n + n of the other), and the overlap is no more than is shared.
    reach = F.floor((7 * F.least("shared", "n") - 3 * F.col("n")) / 3)
    able = own.join(counts, "sig").where("4 * shared >= 3 * n").withColumn("reach", reach)
    able = scratch.keep("open-sets", able.where("reach > 0"))
    bits = docs.sparkSession.sparkContext.broadcast(_open_bits(able))
    texts = docs.select("text", _place("doc_id").alias("place"))
    sets = texts.mapInArrow(
        partial(_full_sets, wanted=bits), "sig long, n long, tokens array<long>, keys array<long>"
    )
    sets = scratch.keep(
        "shingle-sets", sets.dropDuplicates(["sig"]).join(able.select("sig", "reach"), "sig"), "open-sets"
    )
    first = components(_leader_links(sets))
    placed = scratch.keep("groups", _grouped(sets, first))
    second = components(_opened_links(sets, placed, scratch))
    roots = (
        placed.select("sig", "root")
        .join(second.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
        .select("sig", F.coalesce("top", "root").alias("root"))
    )
    whole = rows.join(roots, "sig", "left").withColumn("root", F.when(F.col("n") > 0, F.coalesce("root", "sig")))
    whole = stored(whole.drop("sig"), "placed")
    scratch.drop("shingle-sets", "groups", "opened")
    return whole


def similar_documents(docs: DataFrame) -> DataFrame:
    """doc_id, number of shingles and component of every row."""
    placed = _joined(docs)
    least = placed.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    return placed.join(least, "root", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component: that with the smallest id, a null one last.

    Rows are told apart by id and text, so of different texts with one id both
    stay, and copies without an id are one. Rows without words all stay.
    """
    placed = _joined(docs).where("n > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "mark")).alias("first")
    kept = placed.groupBy("root").agg(first).select("first.*")
    column = "_name"
    while column in docs.columns:
        column += "_"
    kept = kept.select(_name(F.col("mark")).alias(column))
    named = docs.withColumn(column, F.when(_has_words(), _name(_mark())))
    chosen = named.join(kept, column, "left_semi").dropDuplicates([column])
    return chosen.unionByName(named.where(F.col(column).isNull())).drop(column)


def _name(mark: Column) -> Column:
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), mark)


def _has_words() -> Column:
    return F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
