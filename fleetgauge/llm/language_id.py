"""Language identification as a mixture, one set of proportions per document.

``learn`` counts hashed byte trigrams of every labelled text by language. For a
document, expectation-maximisation finds the proportions of the languages that
make its trigrams most likely. Languages are then left out one by one while the
likelihood, less a penalty for each language, does not fall.

Defined results: a text that is null or without letters is ``und`` with score 0,
and so is every text when nothing was learned. Ties go to the language that sorts first.
Rows may repeat; each is judged alone. Rows without a language teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm.text import LOWER, slices, utf8

CELLS = 1 << 16
UNKNOWN = "und"

# Everything but letters is a blank. Bytes of other scripts count as letters.
_LETTERS = np.where(
    (LOWER >= 97) & (LOWER <= 122) | (np.arange(256) >= 128), LOWER, 32
).astype(np.uint8)


def _trigrams(data: np.ndarray) -> np.ndarray:
    """Cells of the trigrams within words, with a blank on either side of a word."""
    letters = np.empty(len(data) + 2, np.uint8)
    letters[0] = letters[-1] = 32
    letters[1:-1] = _LETTERS[data]
    wide = letters.astype(np.uint32)
    codes = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]
    codes = codes[letters[1:-1] != 32]
    return (codes * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint16)


def _cell_counts(data: np.ndarray, step: int = 1 << 24) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cells of a text and their counts; long texts are counted in steps."""
    if len(data) <= step:
        return np.unique(_trigrams(data), return_counts=True)
    total = np.zeros(CELLS, np.int64)
    for at in range(0, len(data), step):
        total += np.bincount(_trigrams(data[at : at + step]), minlength=CELLS)
    cells = np.flatnonzero(total)
    return cells, total[cells]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in slices(batch, "text"):
            data, offsets = utf8(part.column("text"))
            for i, lang in enumerate(part.column("lang").to_pylist()):
                cells, n = _cell_counts(data[offsets[i] : offsets[i + 1]])
                if lang not in counts:
                    counts[lang] = np.zeros(CELLS, np.int64)
                counts[lang][cells] += n
    for lang, total in counts.items():
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(cells), pa.string()), pa.array(cells, pa.int32()), pa.array(total[cells])],
            names=["lang", "cell", "n"],
        )


@dataclass(frozen=True)
class Languages:
    """Log-likelihood of every cell in each language, languages in order of name.

    Its size is 65,536 cells for each language of the labels, whatever the corpus.
    """

    names: list[str]
    likelihood: np.ndarray


def learn(docs: DataFrame, smoothing: float = 0.5) -> Languages:
    """Cell likelihoods from the text and lang columns of all given rows."""
    labelled = docs.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    counts = (
        labelled.mapInArrow(_count_batches, "lang string, cell int, n long")
        .groupBy("lang", "cell")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    names = sorted(set(counts["lang"].to_pylist()))
    table = np.full((len(names), CELLS), smoothing)
    if names:
        rows = np.searchsorted(np.array(names, object), np.array(counts["lang"].to_pylist(), object))
        table[rows, counts["cell"].to_numpy()] += counts["n"].to_numpy()
    return Languages(names, table / table.sum(axis=1, keepdims=True))


def _proportions(p: np.ndarray, n: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Mixture weights by expectation-maximisation, and the log-likelihood."""
    total = n.sum()
    weights = start
    for _ in range(rounds):
        q = weights @ p
        fresh = weights * (p @ (n / q)) / total
        moved = np.abs(fresh - weights).max()
        weights = fresh
        if moved < 1e-4:
            break
    return weights, float(n @ np.log(weights @ p))


def mixture(
    model: Languages, data: np.ndarray, rounds: int = 30, overlap: float = 3.0
) -> tuple[np.ndarray, np.ndarray]:
    """Chosen languages of a text, largest part first, and their proportions.

    Neighbouring trigrams share letters, so the log-likelihood counts for a
    third; each language costs half the logarithm of the number of trigrams.
    """
    cells, n = _cell_counts(data)
    if not len(cells) or not model.names:
        return np.zeros(0, int), np.zeros(0)
    p, n = model.likelihood[:, cells], n.astype(float)
    chosen = np.arange(len(model.names))
    price = 0.5 * np.log(n.sum() + 1) * overlap
    weights, fit = _proportions(p, n, np.full(len(chosen), 1 / len(chosen)), rounds)
    while len(chosen) > 1:
        rest = _without_smallest(weights)
        start = np.maximum(weights[rest], 1e-9)
        fewer, fit_fewer = _proportions(p[chosen[rest]], n, start / start.sum(), rounds)
        if fit_fewer + price < fit:
            break
        chosen, weights, fit = chosen[rest], fewer, fit_fewer
    order = np.lexsort((chosen, -weights))
    return chosen[order], weights[order]


def _without_smallest(weights: np.ndarray) -> np.ndarray:
    """All but the languages with next to no part, or else all but the smallest."""
    negligible = weights < 1e-6
    if negligible.any():
        return ~negligible
    keep = np.ones(len(weights), bool)
    keep[len(weights) - 1 - np.argmin(weights[::-1])] = False
    return keep


PREDICTED = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("languages", T.ArrayType(T.StringType())),
        T.StructField("proportions", T.ArrayType(T.DoubleType())),
    ]
)


def identify(docs: DataFrame, model: Languages) -> DataFrame:
    """Add the language, its proportion as score, and the whole mixture to each row.

    ``docs`` needs a text column. Columns of the input that have a result's
    name are replaced.
    """
    kept = [c for c in docs.columns if c not in PREDICTED.names]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        F.struct(*kept).alias("row"),
        "text",
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letters"),
    )
    schema = T.StructType([T.StructField("row", rows.schema["row"].dataType), *PREDICTED.fields])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                data, offsets = utf8(part.column("text"))
                found = []
                for i, letters in enumerate(part.column("has_letters").to_pylist()):
                    found.append(
                        mixture(languages, data[offsets[i] : offsets[i + 1]])
                        if letters
                        else (np.zeros(0, int), np.zeros(0))
                    )
                names = [[languages.names[k] for k in chosen] for chosen, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.array([x[0] if x else UNKNOWN for x in names], pa.string()),
                        pa.array([min(1.0, float(w[0])) if len(w) else 0.0 for _, w in found]),
                        pa.array(names, pa.list_(pa.string())),
                        pa.array([w.tolist() for _, w in found], pa.list_(pa.float64())),
                    ],
                    names=["row", *PREDICTED.names],
                )

    return rows.mapInArrow(predict, schema).select("row.*", *PREDICTED.names)


def remainder(key: str, of: int) -> Column:
    """crc32 of an id as text, modulo a number; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % of


def held_out_identification(docs: DataFrame) -> DataFrame:
    """Learn from two thirds of the rows by id, predict all of them."""
    held_out = remainder("doc_id", 3) == 1
    rows = docs.select("doc_id", "text", "lang", held_out.alias("held_out"))
    model = learn(rows.where(~F.col("held_out")))
    return identify(rows.drop("lang"), model).select("doc_id", "held_out", *PREDICTED.names)


def keep_identified(docs: DataFrame, least: float = 0.3) -> DataFrame:
    """The documents of which one language has at least ``least`` of the text, learned from all of them."""
    model = learn(docs)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    sure = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)
    return identify(rows, model).where(sure).select("_row.*")
