"""Retention: which rows of a table are too old to keep, and what a purge would do."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from haulage.functions import times as T
from haulage.operators.ranges import running_sum

MIN_RETENTION_DAYS = 30
BATCH_ROWS = 50_000


def cutoff(now, retention_days: int) -> Column:
    """``now`` less the retention; shorter than 30 days is refused."""
    if retention_days < MIN_RETENTION_DAYS:
        raise ValueError(f"retention_days={retention_days} is below the minimum of {MIN_RETENTION_DAYS}")
    return T.moment(now) - F.make_dt_interval(F.lit(retention_days))


@dataclass
class Rule:
    """How one table is purged. ``age`` is the time column; the other parts narrow what may go.

    ``parent``: rows go only with an old parent ``(frame, [(own, parent)], parent time column)``.
    ``keep_last``: ``(group column, condition)``; the newest row per group among those meeting the condition stays.
    ``referenced_by``: rows named in ``(frame, own column, frame column)`` stay.
    """

    age: str
    parent: tuple | None = None
    keep_last: tuple | None = None
    referenced_by: list[tuple] = field(default_factory=list)


def last_per_group(df: DataFrame, group: str, age: str, condition: Column) -> DataFrame:
    return df.where(condition).groupBy(group).agg(F.max(age).alias("_max"))


def candidates(df: DataFrame, rule: Rule, before: Column) -> DataFrame:
    """The rows a purge removes."""
    out = df.where(F.col(rule.age) < before)
    if rule.keep_last:
        group, condition = rule.keep_last
        last = last_per_group(df, group, rule.age, condition).select(F.col(group).alias("_g"), "_max")
        # Matched on (group, time), so a large group spreads over the join.
        out = out.join(last, (F.col(group) == F.col("_g")) & (F.col(rule.age) == F.col("_max")), "left_anti")
    if rule.parent:
        frame, keys, parent_age = rule.parent
        old = frame.where(F.col(parent_age) < before).select(*[F.col(p).alias(f"_p{i}") for i, (_, p) in enumerate(keys)])
        match = F.lit(True)
        for i, (own, _) in enumerate(keys):
            match = match & (F.col(own) == F.col(f"_p{i}"))
        out = out.join(old, match, "left_semi")
    for frame, own, theirs in rule.referenced_by:
        out = out.join(frame.select(F.col(theirs).alias("_r")), F.col(own) == F.col("_r"), "left_anti")
    return out


def kept(df: DataFrame, rule: Rule, before: Column, key: list[str]) -> DataFrame:
    """The rows left after a purge, to be written as the new version of the table. ``key`` is unique and not NULL."""
    if not rule.keep_last and not rule.parent and not rule.referenced_by:
        return df.where(F.col(rule.age).isNull() | (F.col(rule.age) >= before))
    return df.join(candidates(df, rule, before).select(*key), key, "left_anti")


def dry_run(df: DataFrame, rule: Rule, before: Column, name: str) -> DataFrame:
    """One report row: rows to go, their oldest and newest time."""
    return candidates(df, rule, before).agg(
        F.count("*").alias("n_rows"), F.min(rule.age).alias("min_at"), F.max(rule.age).alias("max_at")
    ).select(F.lit(name).alias("table_name"), "n_rows", "min_at", "max_at")


def purge_report(reports: list[DataFrame]) -> DataFrame:
    """All dry runs with a grand total (table_name NULL)."""
    union = reports[0]
    for r in reports[1:]:
        union = union.unionByName(r)
    return union.rollup("table_name").agg(F.sum("n_rows").alias("n_rows"), F.min("min_at").alias("min_at"), F.max("max_at").alias("max_at"))


def time_slices(rows: DataFrame, age: str, before: Column, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Add ``batch_id``: equal time slices from the oldest candidate to the cutoff, about ``batch_rows`` each.

    The last slice closes at the cutoff.
    """
    stats = rows.agg(F.count("*").alias("n"), F.min(age).cast("string").alias("lo")).first()
    n = F.lit(max(-(-stats.n // batch_rows), 1)).cast("bigint")
    lo = F.lit(stats.lo).cast(rows.schema[age].dataType)
    span = F.timestamp_diff("MICROSECOND", lo, before)
    offset = F.timestamp_diff("MICROSECOND", lo, F.col(age))
    # Exact whole-number arithmetic: offset · n div span.
    slot = F.floor((offset.cast("decimal(20,0)") * n.cast("decimal(10,0)")) / F.greatest(span, F.lit(1).cast("bigint")).cast("decimal(20,0)")).cast("bigint")
    return rows.withColumn("batch_id", F.least(slot, n - 1))


def key_batches(rows: DataFrame, key: list[str], batch_rows: int = BATCH_ROWS, rows_per_range: int | None = None) -> DataFrame:
    """Add ``batch_id``: batches of exactly ``batch_rows`` rows in key order. ``key`` must be unique."""
    numbered = running_sum(rows, key, F.lit(1).cast("bigint"), "_rn", rows_per_range)
    return numbered.withColumn("batch_id", F.floor((F.col("_rn") - 1) / F.lit(batch_rows)).cast("bigint")).drop("_rn")


def expired_objects(listing: DataFrame, now, days: int, at: str = "modificationTime") -> DataFrame:
    """Objects last changed at or before ``now - days``."""
    kind = listing.schema[at].dataType.simpleString()
    return listing.where(F.col(at) <= T.moment(now, kind) - F.make_dt_interval(F.lit(days)))


def orphan_versions(versions: DataFrame, live: DataFrame, ident: str) -> DataFrame:
    """All stored versions of ids that no longer exist."""
    return versions.join(live.select(ident).distinct(), ident, "left_anti").select(versions.columns)
