"""Data checks: counts, sums, content and checksums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from haulage.functions import text as X
from haulage.session import stored


def count_check(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: both counts and whether they agree."""
    n_target = target.agg(F.count("*")).scalar()
    return source.agg(F.count("*").alias("source_rows")).select(
        "source_rows", n_target.alias("target_rows"), (F.col("source_rows") == n_target).alias("is_equal"))


def sum_check(df: DataFrame, column: str, rows: int, total) -> DataFrame:
    """One row: count and sum against the expected values."""
    got = df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(column), F.lit(0)).alias("total"))
    return got.withColumn("is_ok", (F.col("n_rows") == rows) & (F.col("total") == total))


def difference(left: DataFrame, right: DataFrame, distinct: bool = False) -> DataFrame:
    """Contents that differ: the row, the ``side`` that has more of it and ``n_extra``, how many more.

    Each input is read once and equal rows are counted before the shuffle, so a content that is repeated any number of
    times costs one row. With ``distinct`` only presence counts.
    """
    sided = left.withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0)).unionByName(right.withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1)))
    counted = sided.groupBy(*left.columns).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    if distinct:
        counted = counted.withColumn("_l", F.least("_l", F.lit(1).cast("bigint"))).withColumn("_r", F.least("_r", F.lit(1).cast("bigint")))
    extra = F.col("_l") - F.col("_r")
    return counted.where(extra != 0).select(*left.columns, F.when(extra > 0, "left").otherwise("right").alias("side"), F.abs(extra).alias("n_extra"))


def same_content(left: DataFrame, right: DataFrame, distinct: bool = False) -> bool:
    return difference(left, right, distinct).isEmpty()


def row_hash(df: DataFrame) -> Column:
    # A NULL leaves the running hash unchanged, so its position is hashed as well.
    cols = [F.col(f"`{c}`") for c in df.columns]
    return F.xxhash64(*cols, *[c.isNull() for c in cols])


def table_checksum(df: DataFrame) -> DataFrame:
    """Order-free checksum and row count, in one map-side combined pass."""
    return df.agg(F.coalesce(F.sum(row_hash(df).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("checksum"),
                  F.count("*").alias("n_rows"))


def same_checksum(left: DataFrame, right: DataFrame) -> bool:
    return table_checksum(left).first() == table_checksum(right).first()


#: Ranges of the key's hash on the first level of the tree of checksums, and pieces of each of them on the second one.
RANGES, PIECES = 4096, 256


def _unequal(signed: DataFrame, mark: str, columns: list[str], by: dict[str, Column]) -> DataFrame:
    """Ranges in which the row hashes of the two sides, added with the side's sign, do not cancel out."""
    hashed = row_hash(signed.select(*columns)).cast("decimal(38,0)")
    sums = signed.groupBy(*[c.alias(name) for name, c in by.items()]).agg(F.sum(hashed * F.col(mark)).alias("_sum"), F.sum(mark).alias("_rows"))
    return sums.where((F.col("_sum") != 0) | (F.col("_rows") != 0)).drop("_sum", "_rows")


def difference_by_ranges(left: DataFrame, right: DataFrame, key: list[str] | None = None, distinct: bool = False) -> DataFrame:
    """The rows of ``difference``, found down a tree of checksums.

    Both sides are first added up per range of the hash of ``key`` (of all columns without one), then the ranges that differ per
    piece; rows are shuffled only from pieces that differ. Equal tables cost two scans and a shuffle of a sum per range and
    task. Differences that lie in every range cost two more scans. What travels are at most ``RANGES * PIECES`` small rows,
    whatever the tables hold. Sums are of 64-bit hashes: rows that differ go unseen where the hashes of a range cancel out, which
    happens about once in 2^64 comparisons. Nulls are values like any other, no rows are equal to no rows.
    """
    columns = left.columns
    mark, part, piece = "_mark", "_part", "_piece"
    while {mark, part, piece} & {c.lower() for c in columns}:
        mark, part, piece = mark + "_", part + "_", piece + "_"
    # the union gives both sides the same types, which the hash depends on
    signed = left.withColumn(mark, F.lit(1)).unionByName(right.withColumn(mark, F.lit(-1)))
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in key or columns])
    ranges = {part: F.pmod(hashed, F.lit(RANGES)).cast("int")}
    pieces = {**ranges, piece: F.pmod(F.shiftright(hashed, 32), F.lit(PIECES)).cast("int")}
    parts = stored(_unequal(signed, mark, columns, ranges), "unequal-ranges")
    if parts.isEmpty():
        return difference(left.where(F.lit(False)), right.where(F.lit(False)), distinct)

    def within(found: DataFrame) -> DataFrame:
        # at most RANGES * PIECES pairs of integers
        return signed.withColumns({n: c for n, c in pieces.items()}).join(F.broadcast(found), found.columns, "left_semi")

    found = stored(_unequal(within(parts), mark, columns, pieces), "unequal-pieces")
    rows = within(found)
    return difference(rows.where(F.col(mark) == 1).select(*columns), rows.where(F.col(mark) == -1).select(*columns), distinct)


def has_prefix(listing: DataFrame, prefix: str) -> bool:
    return not listing.where(F.col("path").startswith(prefix)).limit(1).isEmpty()


def bad_lines(lines: DataFrame, line: str, expected: int, sep: str = "\t") -> DataFrame:
    """Lines whose number of fields is not the expected one."""
    return lines.withColumn("n_columns", X.column_count(F.col(line), sep)).where(F.col("n_columns") != expected)


def bad_names(named: DataFrame, column: str) -> DataFrame:
    """Names that break the file-name rule."""
    return named.where(~X.file_name_ok(F.col(column)))
