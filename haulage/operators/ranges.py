"""Order-dependent work without a single sorted partition.

A running sum or a neighbour lookup over a whole table (or over one key that holds a large share of it) must not
end in one task. The rows are cut into ranges of the sort order; each range is handled by its own task and a small
per-range table carries the missing part across the cuts. The cut points are constants of the plan, so retried
tasks see the same ranges, and any choice of cut points gives the same result: they only balance the work.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

SAMPLE_PER_RANGE = 24
# Rows that are worth a range of their own, and rows of a range at most.
LEAST_ROWS, MOST_ROWS = 250_000, 1_000_000
# Cut points travel as JSON; microseconds must survive (fixed values).
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _key(order: list[str]) -> Column:
    return F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(order)])


def ranges_for(total: int, partitions: int, rows_per_range: int | None = None) -> int:
    """How many ranges ``total`` rows are worth: one per partition of a shuffle, more where these would hold more than
    ``MOST_ROWS`` rows, fewer where they would hold less than ``LEAST_ROWS``."""
    if rows_per_range is not None:
        return max(1, math.ceil(total / rows_per_range))
    return max(1, min(max(partitions, math.ceil(total / MOST_ROWS)), math.ceil(total / LEAST_ROWS)))


def cut_points(df: DataFrame, order: list[str], rows_per_range: int | None = None, total: int | None = None) -> list[str]:
    """Order tuples (as JSON) that split ``df`` into about equal ranges; see ``ranges_for``. One range has none, and is not sampled.

    The sample brought to the driver has ``SAMPLE_PER_RANGE`` tuples a range in expectation.
    """
    total = df.count() if total is None else total
    wanted = ranges_for(total, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows_per_range)
    if wanted == 1:
        return []
    fraction = min(1.0, wanted * SAMPLE_PER_RANGE / max(total, 1))
    # One task sorts the bounded sample; a global ordering would read the input a second time to find its own ranges.
    sample = df.select(*order).sample(False, fraction, seed=11).repartition(1).sortWithinPartitions(*order)
    keys = [r.k for r in sample.select(F.to_json(_key(order), JSON_TIMES).alias("k")).collect()]
    return list(dict.fromkeys(keys[i * len(keys) // wanted] for i in range(1, wanted))) if keys else []


def _cut_type(df: DataFrame, order: list[str]) -> str:
    return "struct<" + ",".join(f"c{i}:{df.schema[c].dataType.simpleString()}" for i, c in enumerate(order)) + ">"


def _cut_table(df: DataFrame, order: list[str], cuts: list[str]) -> DataFrame:
    texts = df.sparkSession.createDataFrame([(c,) for c in cuts], "k string")
    return texts.select(F.from_json("k", _cut_type(df, order), JSON_TIMES).alias("k")).select("k.*")


def with_range(df: DataFrame, order: list[str], cuts: list[str]) -> DataFrame:
    """Add ``_range``: the number of cut points at or before the row.

    The cut points are one constant array; a row finds its place by halving, one projection per step, so that the
    generated code stays small and compiled.
    """
    points = F.from_json(F.lit("[" + ",".join(cuts) + "]"), f"array<{_cut_type(df, order)}>", JSON_TIMES)
    row = _key(order)
    out, at = df.withColumn("_range", F.lit(0)), F.col("_range")
    for bit in reversed(range(len(cuts).bit_length())):
        step = 1 << bit
        reached = F.coalesce(F.try_element_at(points, at + step) <= row, F.lit(False))
        out = out.withColumn("_range", F.when(reached, at + step).otherwise(at))
    return out


def running_sum(
    df: DataFrame, order: list[str], value: Column, out: str, rows_per_range: int | None = None, total: int | None = None
) -> DataFrame:
    """Add ``out`` = sum of ``value`` over all rows up to and including this one in the given total order."""
    cuts = cut_points(df, order, rows_per_range, total)
    if not cuts:
        upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.sum(value).over(upto))
    rows = with_range(df.withColumn("_value", value), order, cuts)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    offsets = rows.groupBy("_range").agg(F.sum("_value").alias("_total")).select(
        "_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    w = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("_inside", F.sum("_value").over(w))
        .join(F.broadcast(offsets), "_range")
        .withColumn(out, F.col("_inside") + F.col("_before"))
        .select(*df.columns, out)
    )


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, str] | None = None,
    following: dict[str, str] | None = None,
    rows_per_range: int | None = None,
    total: int | None = None,
) -> DataFrame:
    """``lag`` / ``lead`` by one row inside each key; a key of any size is spread over many tasks.

    ``previous`` and ``following`` map a new column to the column it is taken from. ``order`` must be unique
    inside a key.
    """
    previous, following = previous or {}, following or {}
    cuts = cut_points(df, keys + order, rows_per_range, total)
    if not cuts:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select(*df.columns, *[F.lag(c).over(w).alias(o) for o, c in previous.items()], *[F.lead(c).over(w).alias(o) for o, c in following.items()])
    rows = with_range(df, keys + order, cuts)
    w = Window.partitionBy("_range", *keys).orderBy(*order)
    inside = rows.select(
        "*",
        *[F.lag(c).over(w).alias(o) for o, c in previous.items()],
        *[F.lead(c).over(w).alias(o) for o, c in following.items()],
        F.lag(F.lit(1)).over(w).isNull().alias("_first"),
        F.lead(F.lit(1)).over(w).isNull().alias("_last"),
    )
    carried = [c for c in dict.fromkeys([*previous.values(), *following.values()])]
    payload = F.struct(F.lit(1).alias("_there"), *[F.col(c) for c in carried])
    # A key reaches over a cut only if the cut is one of its own rows, so the rows of all other keys stay out of this.
    cut_keys = _cut_table(df, keys + order, cuts).select(*[F.col(f"c{i}").alias(f"_c{i}") for i in range(len(keys))]).distinct()
    own = F.lit(True)
    for i, k in enumerate(keys):
        own = own & F.col(k).eqNullSafe(F.col(f"_c{i}"))
    edges = rows.join(F.broadcast(cut_keys), own, "left_semi").groupBy("_range", *keys).agg(
        F.min_by(payload, F.struct(*order)).alias("_head"), F.max_by(payload, F.struct(*order)).alias("_tail"))
    across = Window.partitionBy(*keys).orderBy("_range")
    # Only keys that cross a cut have a neighbour range, and a cut is crossed by one key at most:
    # no more than two rows per cut point remain.
    seams = (
        edges.select("_range", *[F.col(k).alias(f"_k_{k}") for k in keys],
                     F.lag("_tail").over(across).alias("_prev"), F.lead("_head").over(across).alias("_next"))
        .where(F.col("_prev").isNotNull() | F.col("_next").isNotNull())
        .withColumnRenamed("_range", "_seam")
    )
    match = F.col("_range") == F.col("_seam")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = inside.join(F.broadcast(seams), match, "left")
    fixed = [F.when(F.col("_first"), F.col(f"_prev.{c}")).otherwise(F.col(o)).alias(o) for o, c in previous.items()]
    fixed += [F.when(F.col("_last"), F.col(f"_next.{c}")).otherwise(F.col(o)).alias(o) for o, c in following.items()]
    return joined.select(*df.columns, *fixed)
