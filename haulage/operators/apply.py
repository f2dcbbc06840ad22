"""Receiver rules: how a batch with ``ctl_action`` and ``ctl_validfrom`` changes a target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

STRATEGIES = ("FULL_UK", "FULL_NO_UK", "INC", "APPEND")


def newest_per_key(batch: DataFrame, uk: list[str]) -> DataFrame:
    """One row per key of a batch: the newest."""
    rest = [c for c in batch.columns if c not in uk]
    # Latest ctl_validfrom; equal times are settled by all columns so that the result does not depend on row order.
    order = F.struct("ctl_validfrom", *[c for c in rest if c != "ctl_validfrom"])
    best = batch.groupBy(*uk).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return best.select(*uk, "_row.*").select(*batch.columns)


def _kept(batch: DataFrame) -> DataFrame:
    return batch.where(F.coalesce(F.col("ctl_action"), F.lit("I")) != "D")


def full_by_key(batch: DataFrame, uk: list[str]) -> DataFrame:
    """Replace everything; deletions are dropped, then one row per key stays."""
    return newest_per_key(_kept(batch), uk).withColumn("ctl_action", F.lit("I"))


def full_without_key(batch: DataFrame) -> DataFrame:
    """Replace everything with all rows that are not deletions."""
    return _kept(batch).withColumn("ctl_action", F.lit("I"))


def incremental(target: DataFrame, batch: DataFrame, uk: list[str]) -> DataFrame:
    """Update, insert and delete by key. ``ctl_action`` tells what happened to a row; untouched rows keep theirs.

    NULL is a key like any other. Both sides have one row per key when they meet, so no key is hot in the join.
    """
    cols = target.columns
    change = newest_per_key(batch, uk).select(F.struct(*[F.col(c) for c in cols]).alias("_new"), *[F.col(k).alias(f"_k_{k}") for k in uk])
    old = target.select(F.struct(*[F.col(c) for c in cols]).alias("_old"), *[F.col(k).alias(f"_o_{k}") for k in uk])
    match = F.lit(True)
    for k in uk:
        match = match & F.col(f"_o_{k}").eqNullSafe(F.col(f"_k_{k}"))
    joined = old.join(change, match, "full_outer")
    alive = F.col("_new").isNull() | (F.coalesce(F.col("_new.ctl_action"), F.lit("I")) != "D")
    action = F.when(F.col("_new").isNull(), F.col("_old.ctl_action")).when(F.col("_old").isNull(), "I").otherwise("U")
    pick: Column = F.coalesce("_new", "_old")
    return joined.where(alive).select(pick.alias("_row"), action.alias("_action")).select(
        *[F.col("_action").alias(c) if c == "ctl_action" else F.col(f"_row.{c}").alias(c) for c in cols])


def appended(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Add every row; the incoming action does not count."""
    return target.unionByName(batch.withColumn("ctl_action", F.lit("I")))


def apply_batch(target: DataFrame, batch: DataFrame, strategy: str, uk: list[str] | None = None) -> DataFrame:
    """The new content of the target. Keys are needed for ``FULL_UK`` and ``INC``."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy in ("FULL_UK", "INC") and not uk:
        raise ValueError(f"{strategy} needs a unique key")
    if strategy == "FULL_UK":
        return full_by_key(batch, uk)
    if strategy == "FULL_NO_UK":
        return full_without_key(batch)
    if strategy == "INC":
        return incremental(target, batch, uk)
    return appended(target, batch)
