"""Global ranks by a distributed radix sort, least significant digit first.

Whole-number keys are cut into digits. A pass sorts all rows, stably, by one
digit: rows lie in blocks of consecutive positions; the rows of each (block,
digit) are counted and numbered in their present order; prefix sums over the
counts, by digit and then by block, give where each such run begins, and with
it every row's new position. After the last digit the positions are the ranks.

A block holds about the square root of the number of rows, so neither a run
nor the list of blocks of one digit grows faster than that, whatever the keys.
Only the totals of the digit's values, 2048 at most, reach the driver. Digits
that no two rows differ in take no pass: keys are measured from their least or
largest value first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgauge.session import stored

DIGIT_BITS = 11
LEAST_BLOCK_BITS = 10
_SIGN = -(2**63)


def _key(name: str, descending: bool, least: int | None, most: int | None) -> tuple[Column, int]:
    """A key as a number of so many bits that sorts as asked, nulls last."""
    if least is None:
        return F.lit(0).cast("long"), 0
    if most - least >= 2**63 - 1:
        # Too wide to measure from an end, so in the order of unsigned numbers; a null is
        # as the last value then.
        last = F.lit(_SIGN if descending else ~_SIGN).cast("long")
        flipped = F.coalesce(F.col(name), last).bitwiseXOR(F.lit(_SIGN).cast("long"))
        return (F.bitwise_not(flipped) if descending else flipped), 64
    far = F.lit(most) - F.col(name) if descending else F.col(name) - F.lit(least)
    return F.coalesce(far, F.lit(most - least + 1)).cast("long"), (most - least + 1).bit_length()


def _passed(frame: DataFrame, key: str, shift: int, block_bits: int) -> DataFrame:
    """The frame in the order of one digit, rows alike in their present order."""
    digit = F.shiftrightunsigned(key, shift).bitwiseAND(F.lit(2**DIGIT_BITS - 1).cast("long")).cast("int")
    block = F.shiftright("_place", block_bits)
    dealt = frame.withColumns({"_digit": digit, "_block": block})
    counts = stored(dealt.groupBy("_digit", "_block").agg(F.count("*").alias("_rows")), "digit-counts")
    totals = counts.groupBy("_digit").agg(F.sum("_rows").alias("rows")).orderBy("_digit").collect()
    begins, at = [], 0
    for total in totals:
        begins.append((total._digit, at))
        at += total.rows
    begins = frame.sparkSession.createDataFrame(begins, "_digit int, _begin long")
    before = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    starts = counts.select("_digit", "_block", earlier.alias("_earlier")).join(F.broadcast(begins), "_digit")
    starts = starts.select("_digit", "_block", (F.col("_begin") + F.col("_earlier")).alias("_start"))
    within = F.row_number().over(Window.partitionBy("_digit", "_block").orderBy("_place")) - 1
    moved = dealt.withColumn("_within", within).join(starts, ["_digit", "_block"])
    placed = moved.withColumn("_place", F.col("_start") + F.col("_within"))
    return stored(placed.select(*frame.columns), "radix-pass")


def ranked(rows: DataFrame, by: Sequence[tuple[str, bool]]) -> DataFrame:
    """Rows with ``rank``, from 1 without gaps, by (column, descending) in order of weight.

    Columns are long, nulls come last. Rows alike in all of them keep some order.
    Names that begin with an underscore are taken for the work.
    """
    names = [name for name, _ in by]
    numbered = stored(rows.withColumn("_place", F.monotonically_increasing_id()), "radix-rows")
    ends = [f(name).alias(f"{f.__name__}{i}") for i, name in enumerate(names) for f in (F.min, F.max)]
    bounds = numbered.agg(F.count("*").alias("rows"), *ends).first()
    block_bits = max(LEAST_BLOCK_BITS, bounds.rows.bit_length() // 2)
    keys, passes = {}, []
    for i, (name, descending) in enumerate(by):
        key, bits = _key(name, descending, bounds[f"min{i}"], bounds[f"max{i}"])
        keys[f"_key{i}"] = key
        passes = [(f"_key{i}", shift) for shift in range(0, bits, DIGIT_BITS)] + passes
    frame = numbered.withColumns(keys)
    if not passes:
        passes = [(next(iter(keys)), 0)]
    for key, shift in passes:
        frame = _passed(frame, key, shift, block_bits)
    return frame.select(*rows.columns, (F.col("_place") + 1).alias("rank"))
