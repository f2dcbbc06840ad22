"""Counting reports: one scan each, conditional aggregates instead of one query per number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulage.functions import numbers as N, times as T

# Reporting periods, each one inside the one before it (fixed values).
PERIODS = [
    ("year", "INTERVAL '1' YEAR"),
    ("quarter", "INTERVAL '3' MONTH"),
    ("month", "INTERVAL '1' MONTH"),
    ("week", "INTERVAL '7' DAY"),
    ("day", "INTERVAL '1' DAY"),
    ("hour", "INTERVAL '1' HOUR"),
]


def period_counts(df: DataFrame, changed: Column, now, at_parse: Column) -> DataFrame:
    """One row: total, rows changed within each period before ``now``, rows changed at the last parse."""
    now = T.moment(now)
    return df.agg(
        F.count("*").alias("total"),
        *[F.count_if(changed > now - F.expr(span)).alias(f"last_{name}") for name, span in PERIODS],
        F.count_if(at_parse).alias("at_parse"))


def period_shares(counts: DataFrame) -> DataFrame:
    """``(period, n, pct)`` rows from :func:`period_counts`."""
    names = [f"last_{n}" for n, _ in PERIODS] + ["at_parse"]
    pairs = F.array(*[F.struct(F.lit(n).alias("period"), F.col(n).alias("n")) for n in names])
    return counts.select("total", F.inline(pairs)).select("period", "n", N.share(F.col("n"), F.col("total")).alias("pct"))


def size_totals(listing: DataFrame, groups: list[str], size: str, at: str) -> DataFrame:
    """Size, count, oldest and newest per group, subtotals and the grand total in one pass."""
    return listing.rollup(*groups).agg(
        F.sum(size).alias("total_size"), F.count("*").alias("n_objects"), F.min(at).alias("min_at"), F.max(at).alias("max_at"))


def type_totals(df: DataFrame, kind: str, aliases: dict[str, str] | None = None) -> DataFrame:
    """Rows per type and the total (type NULL); ``aliases`` renames types first."""
    col = F.col(kind)
    for old, new in (aliases or {}).items():
        col = F.when(F.col(kind) == old, new).otherwise(col)
    return df.withColumn(kind, col).rollup(kind).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def outliers(df: DataFrame, value: str, sigmas: float = 3, min_items: int = 5, timeout: float | None = None) -> DataFrame:
    """Rows above mean + ``sigmas`` · sample deviation, with ``threshold``; also rows past half of ``timeout``.

    No outliers exist for ``min_items`` rows or fewer or without any spread. Mean and deviation are one row; fetched
    first, they become constants that the second reading can push into the scan.
    """
    stats = df.agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sigma")).first()
    sigma = stats.sigma or 0.0
    threshold = float(stats.mean + sigmas * sigma) if stats.n else 0.0
    high = F.col(value) > threshold if stats.n > min_items and sigma > 0 else F.lit(False)
    near = F.col(value) > timeout / 2 if timeout is not None else F.lit(False)
    return df.where(high | near).select("*", F.lit(threshold).alias("threshold"), high.alias("is_outlier"), near.alias("is_near_timeout"))


def run_summary(tasks: DataFrame, run: str, state: str, seconds: str) -> DataFrame:
    """ok / fail / skip / none per run and the average of the non-zero durations."""
    s = F.col(state)
    return tasks.groupBy(run).agg(
        F.count_if(s == "success").alias("n_ok"),
        F.count_if(s.isin("failed", "upstream_failed")).alias("n_fail"),
        F.count_if(s.isNotNull() & ~s.isin("success", "failed", "upstream_failed")).alias("n_skip"),
        F.count_if(s.isNull()).alias("n_none"),
        F.coalesce(F.avg(F.when(F.col(seconds) != 0, F.col(seconds))), F.lit(0.0)).alias("avg_seconds"))


def operator_summary(tasks: DataFrame, run: str, name: str, state: str) -> DataFrame:
    """ok / skip / fail per run of a regression bench; service tasks do not count."""
    s = F.coalesce(F.col(state), F.lit("no_status"))
    skipped = s.isin("skipped", "upstream_failed", "removed")
    counted = tasks.where(~F.col(name).isin("summary", "cleanup") & ~F.col(name).startswith("gate_"))
    return counted.groupBy(run).agg(
        F.count_if(s == "success").alias("n_ok"), F.count_if(skipped).alias("n_skip"), F.count_if((s != "success") & ~skipped).alias("n_fail"))


def growth(sizes: DataFrame, table: str, run: str, value: str) -> DataFrame:
    """Change of a table's size against its previous run (NULL for the first).

    One row per table and run goes in, so a table holds as many rows as there were runs.
    """
    w = Window.partitionBy(table).orderBy(run)
    return sizes.withColumn("delta", F.col(value) - F.lag(value).over(w))


def growth_totals(deltas: DataFrame, run: str, columns: list[str]) -> DataFrame:
    """Sums over all tables per run; a missing previous value counts as no change."""
    return deltas.groupBy(run).agg(F.count("*").alias("n_tables"), *[F.sum(c).alias(f"total_{c}") for c in columns],
                                   F.coalesce(F.sum("delta"), F.lit(0)).alias("total_delta"))


def coverage(live: DataFrame, covered: DataFrame, ident: str, limit: int) -> DataFrame:
    """One row: live ids, covered live ids, whole percent, runs until everything is covered (``limit`` per run)."""
    done = covered.select(ident).distinct().withColumn("_done", F.lit(1))
    counts = live.select(ident).distinct().join(done, ident, "left").agg(
        F.count("*").alias("n_live"), F.count("_done").alias("n_covered"))
    left = F.col("n_live") - F.col("n_covered")
    return counts.select("*", N.share(F.col("n_covered"), F.greatest(F.col("n_live"), F.lit(1))).alias("pct"),
                         (F.ceil(left / F.lit(limit)) if limit else F.lit(0)).cast("bigint").alias("runs_left"))


def top(df: DataFrame, limit: int | None, *order) -> DataFrame:
    """The first ``limit`` rows, of which Spark keeps only that many per task; None means all, in order."""
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def random_order(df: DataFrame, seed: str, *key: str, limit: int | None = None) -> DataFrame:
    """A fair but repeatable order: by a hash of the key and the seed."""
    return top(df, limit, F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in key])), *key)
