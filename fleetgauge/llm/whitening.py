"""Whitening of vectors by a covariance that is weighted with multiplicities.

Equal vectors are one vector with a count. All sums run over the distinct
vectors: the totals per dimension in whole numbers, then, with the mean known,
a weighted product of the centred vectors, d x d numbers from each task. The
d x d covariance is decomposed on the driver; d is the vectors' length, so
this is the same small matrix for any number of rows. Each distinct vector is
whitened once and joined back to the rows that have it. Adaptive execution
splits the rows of a vector that many rows share; nothing of that size is
gathered in one task.

A component c of a vector becomes x = floor(64 * c) + 1000000. The mean is
taken as a whole part and a remainder, so x minus the mean is exact to the
last bits of a double.

Defined results: vectors that are null or empty or hold null or non-finite
entries take no part and have no rows. If lengths differ, the most frequent
one counts (the longer, if there are two) and the others take no part.
Entries beyond 2**53 / 64 in size count as that. A component whose variance is
not above 1e-12 of the whole is null in every row and left out of the
identity error. A deviation too large for a long is null. Repeated rows and
null ids are rows like any other; no rows give no rows. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgauge.session import stored

SCALE = 64
SHIFT = 1_000_000
LARGEST = 2.0**53
LEAST_SHARE = 1e-12
_LONGEST = 2**63 - 1


def quantised(vector: Column) -> Column:
    """Whole numbers of a vector, null where it can take no part."""
    finite = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    whole = F.transform(
        vector,
        lambda c: F.floor(F.least(F.greatest(c.cast("double") * SCALE, F.lit(-LARGEST)), F.lit(LARGEST)))
        + F.lit(SHIFT).cast("long"),
    )
    return F.when(finite & (F.size(vector) > 0), whole)


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def _in_parts(batch: pa.RecordBatch, rows: int = 8192) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def _whole_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted totals of a task's vectors, exact, as (position, total)."""
    totals = None
    for batch in batches:
        for part in _in_parts(batch):
            x, weight = _matrix(part.column("x"), np.int64), part.column("weight").to_numpy()
            if float(np.abs(x).max(initial=0)) * float(weight.sum()) >= 2.0**62:
                x, weight = x.astype(object), weight.astype(object)
            own = (x * weight[:, None]).sum(axis=0)
            own = np.array([int(v) for v in own], dtype=object)
            totals = own if totals is None else totals + own
    if totals is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(totals), dtype=np.int32)), pa.array([str(t) for t in totals])],
            names=["place", "total"],
        )


def _centred_products(
    batches: Iterator[pa.RecordBatch], centred: Callable[[pa.RecordBatch], np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """Weighted sums of a task's centred vectors and of their products, as (cell, value).

    The sums come first, then the products row by row.
    """
    product = total = None
    for batch in batches:
        for part in _in_parts(batch):
            y, weight = centred(part), part.column("weight").to_numpy().astype(float)
            heavy = y * weight[:, None]
            product = heavy.T @ y if product is None else product + heavy.T @ y
            total = heavy.sum(axis=0) if total is None else total + heavy.sum(axis=0)
    if product is not None:
        values = np.concatenate([total, product.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["cell", "value"]
        )


def _summed(frame: DataFrame, width: int, centred: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Sums and products over all rows; width + width ** 2 numbers reach the driver."""
    cells = frame.mapInArrow(partial(_centred_products, centred=centred), "cell int, value double")
    rows = cells.groupBy("cell").agg(F.sum("value").alias("value")).collect()
    values = np.zeros(width + width * width)
    for row in rows:
        values[row.cell] = row.value
    return values[:width], values[width:].reshape(width, width)


def _centred(part: pa.RecordBatch, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (_matrix(part.column("x"), np.int64) - whole).astype(float) - rest


def _deviations(x: np.ndarray, n: int, whole: np.ndarray, over: np.ndarray) -> pa.Array:
    """Sum over dimensions of (n * x - S) ** 2, where S = n * whole + over."""
    far = x - whole
    most = (float(np.abs(far).max(initial=0)) + 1) * n
    if most * most * x.shape[1] < 2.0**62:
        return pa.array((((n * far) - over) ** 2).sum(axis=1), pa.int64())
    exact = (((n * far.astype(object)) - over.astype(object)) ** 2).sum(axis=1)
    return pa.array([int(v) if v <= _LONGEST else None for v in exact], pa.int64())


def _whitened(batches: Iterator[pa.RecordBatch], n, whole, over, axes) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _in_parts(batch):
            rest = over / n
            z = _centred(part, whole, rest.astype(float)) @ axes
            flat = pa.array(z.ravel())
            offsets = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("x"),
                    part.column("weight"),
                    _deviations(_matrix(part.column("x"), np.int64), n, whole, over),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                names=["x", "weight", "deviation", "whitened"],
            )


def _floats(part: pa.RecordBatch, mean: np.ndarray) -> np.ndarray:
    return _matrix(part.column("whitened"), float) - mean


OUT = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"


def whiten(vectors: DataFrame, components: int = 32, weights: str = "counts") -> DataFrame:
    """Id and whitened vector of each row that takes part.

    ``weights`` is ``counts`` if the fit list holds every row, or ``one`` if it
    holds each distinct vector once; rows are whitened either way. ``n`` is the
    length of the fit list, ``explained`` each component's share of the
    variance, ``identity_error`` the largest distance of the whitened
    vectors' measured covariance from the identity.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights are counts or one")
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long"), quantised(F.col("embedding")).alias("x"))
    rows = rows.where(F.col("x").isNotNull())
    distinct = stored(rows.groupBy("x").agg(F.count("*").alias("copies")), "distinct-vectors")
    lengths = distinct.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("rows"))
    first = lengths.orderBy(F.desc("rows"), F.desc("d")).first()
    if first is None:
        return spark.createDataFrame([], OUT)
    d = first.d
    weight = F.col("copies") if weights == "counts" else F.lit(1).cast("long")
    fit = distinct.where(F.size("x") == d).select("x", weight.alias("weight"))
    n = fit.agg(F.sum("weight")).first()[0]
    totals = (
        fit.mapInArrow(_whole_totals, "place int, total string")
        .groupBy("place")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        .collect()
    )
    sums = [int(t.total) for t in sorted(totals, key=lambda t: t.place)]
    whole, over = (np.array(v, np.int64) for v in zip(*(divmod(s, n) for s in sums)))
    centred = partial(_centred, whole=whole, rest=np.array([o / n for o in over.tolist()]))
    _, products = _summed(fit, d, centred)
    values, axes = np.linalg.eigh(products / n)
    order = np.argsort(-values, kind="stable")[:components]
    values, axes, trace = values[order], axes[:, order], float(np.trace(products / n))
    sound = values > LEAST_SHARE * trace
    axes = np.where(sound, axes / np.sqrt(np.where(sound, values, 1.0)), 0.0)
    done = stored(
        fit.mapInArrow(
            partial(_whitened, n=n, whole=whole, over=over, axes=axes),
            "x array<long>, weight long, deviation long, whitened array<double>",
        ),
        "whitened-vectors",
    )
    k = len(order)
    means, _ = _summed(done, k, partial(_floats, mean=np.zeros(k)))
    _, products = _summed(done, k, partial(_floats, mean=means / n))
    error = np.abs(products / n - np.eye(k))[np.ix_(sound, sound)].max(initial=0.0)
    kept = F.transform("whitened", lambda z, i: F.when(F.array(*map(F.lit, sound.tolist()))[i], z))
    shares = [float(v) / trace if trace else 0.0 for v in values]
    return (
        rows.join(done.select("x", "deviation", "whitened"), "x")
        .select(
            "vec_id",
            F.lit(n).cast("long").alias("n"),
            "deviation",
            (kept if not sound.all() else F.col("whitened")).alias("whitened"),
            F.array(*map(F.lit, shares)).alias("explained"),
            F.lit(float(error)).alias("identity_error"),
        )
    )


def by_component(whitened: DataFrame) -> DataFrame:
    """One row for each vector and component, numbered from 1."""
    one = whitened.select("*", F.posexplode("whitened").alias("place", "value"))
    return one.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        F.col("value").alias("whitened"),
        F.col("explained")[F.col("place")].alias("explained"),
        "identity_error",
    )
