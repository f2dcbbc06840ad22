"""Counting reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.functions import numbers as N, text as X, times as T
from haulage.operators import reports as RP
from haulage.plans.catalogue.base import KEY_SQL, NOW, key_of_props, newest, query, table

PERIOD_SQL = f"""
    SELECT count(*) AS total, count(*) FILTER (ts > {NOW} - INTERVAL 1 YEAR) AS last_year, count(*) FILTER (ts > {NOW} - INTERVAL 3 MONTH) AS last_quarter,
           count(*) FILTER (ts > {NOW} - INTERVAL 1 MONTH) AS last_month, count(*) FILTER (ts > {NOW} - INTERVAL 7 DAY) AS last_week,
           count(*) FILTER (ts > {NOW} - INTERVAL 1 DAY) AS last_day, count(*) FILTER (ts > {NOW} - INTERVAL 1 HOUR) AS last_hour,
           count(*) FILTER (ts >= p - INTERVAL 600 SECOND) AS at_parse
    FROM events LEFT JOIN (SELECT user_id AS u, max(ts) AS p FROM events GROUP BY 1) ON user_id = u WHERE left(event_type, 4) <> 'sign'"""


def period_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    parsed = ev.groupBy("user_id").agg(F.max("ts").alias("parsed_at"))
    joined = ev.where(X.without_prefixes(F.col("event_type"), ["sign"])).select("user_id", "ts").join(parsed, "user_id", "left")
    return RP.period_counts(joined, F.col("ts"), newest(ev, "ts"), F.col("ts") >= F.col("parsed_at") - T.seconds(600))


@query("period_counts", PERIOD_SQL)
def period_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return period_row(spark, sf_dir)


@query("period_shares", f"""
    WITH c AS ({PERIOD_SQL}), u AS (UNPIVOT c ON COLUMNS(* EXCLUDE total) INTO NAME period VALUE n)
    SELECT period, n, CAST(round_even(CAST(n AS DOUBLE) * 100 / total, 0) AS BIGINT) AS pct FROM u""")
def period_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.period_shares(period_row(spark, sf_dir))


@query("recent_changed", """
    SELECT event_id, ts, user_id FROM events JOIN (SELECT user_id AS u, max(ts) AS p FROM events GROUP BY 1) ON user_id = u
    WHERE ts >= p - INTERVAL 600 SECOND""")
def recent_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    parsed = ev.groupBy("user_id").agg(F.max("ts").alias("p"))
    late = ev.join(parsed, "user_id").where(F.col("ts") >= F.col("p") - T.seconds(600)).select("event_id", "ts", "user_id")
    return RP.top(late, None, F.col("ts").desc(), "event_id")


@query("size_rollup", """
    SELECT lang, source, CAST(sum(n_chars) AS BIGINT) AS total_size, count(*) AS n_objects, min(doc_id) AS min_at, max(doc_id) AS max_at FROM documents GROUP BY ROLLUP (lang, source)""")
def size_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.size_totals(table(spark, sf_dir, "documents"), ["lang", "source"], "n_chars", "doc_id")


@query("type_rollup", "SELECT CASE WHEN event_type = 'signup' THEN 'register' ELSE event_type END AS event_type, count(*) AS n FROM events GROUP BY ROLLUP (CASE WHEN event_type = 'signup' THEN 'register' ELSE event_type END)")
def type_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.type_totals(table(spark, sf_dir, "events").select("event_type"), "event_type", {"signup": "register"})


@query("status_histogram", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.histogram(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("outlier_3sigma", """
    WITH s AS (SELECT avg(n_chars) + 3 * stddev_samp(n_chars) AS threshold, count(*) > 5 AND stddev_samp(n_chars) > 0 AS enough FROM documents)
    SELECT doc_id, n_chars, round(threshold, 4) AS threshold, enough AND n_chars > threshold AS is_outlier, n_chars > 3000 AS is_near_timeout FROM documents, s
    WHERE (enough AND n_chars > threshold) OR n_chars > 3000""")
def outlier_3sigma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.outliers(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", timeout=6000).withColumn("threshold", F.round("threshold", 4))


@query("run_summary", """
    WITH t AS (SELECT o_custkey, CASE CAST(floor(o_totalprice) AS BIGINT) % 6 WHEN 0 THEN 'failed' WHEN 1 THEN 'upstream_failed' WHEN 2 THEN 'skipped' WHEN 3 THEN NULL ELSE 'success' END AS state, o_orderkey % 50 AS secs FROM orders)
    SELECT o_custkey, count(*) FILTER (state = 'success') AS n_ok, count(*) FILTER (state IN ('failed', 'upstream_failed')) AS n_fail, count(*) FILTER (state = 'skipped') AS n_skip,
           count(*) FILTER (state IS NULL) AS n_none, round(coalesce(avg(nullif(secs, 0)), 0), 6) AS avg_seconds FROM t GROUP BY o_custkey""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.floor("o_totalprice") % 6
    tasks = table(spark, sf_dir, "orders").select(
        "o_custkey", F.when(kind == 0, "failed").when(kind == 1, "upstream_failed").when(kind == 2, "skipped").when(kind > 3, "success").alias("state"),
        (F.col("o_orderkey") % 50).alias("secs"))
    return RP.run_summary(tasks, "o_custkey", "state", "secs").withColumn("avg_seconds", F.round("avg_seconds", 6))


@query("operator_summary", """
    WITH t AS (SELECT o_custkey, CASE o_orderkey % 7 WHEN 0 THEN 'summary' WHEN 1 THEN 'gate_pg' ELSE 'copy' END AS task, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'skipped' END AS state FROM orders)
    SELECT o_custkey, count(*) FILTER (state = 'success') AS n_ok, count(*) FILTER (state = 'skipped') AS n_skip, count(*) FILTER (state IS NULL) AS n_fail FROM t
    WHERE task NOT IN ('summary', 'cleanup') AND NOT starts_with(task, 'gate_') GROUP BY o_custkey""")
def operator_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.col("o_orderkey") % 7
    tasks = table(spark, sf_dir, "orders").select(
        "o_custkey", F.when(slot == 0, "summary").when(slot == 1, "gate_pg").otherwise("copy").alias("task"),
        F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "skipped").alias("state"))
    return RP.operator_summary(tasks, "o_custkey", "task", "state")


MONTHS_SQL = """
    SELECT o_orderpriority, date_trunc('month', o_orderdate)::TIMESTAMP AS run_at, count(*) AS n_rows, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)) * 100) AS BIGINT) AS size FROM orders GROUP BY ALL"""


def month_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("run_at")).agg(
        F.count("*").alias("n_rows"), (F.sum(F.col("o_totalprice").cast("decimal(18,2)")) * 100).cast("bigint").alias("size"))


@query("growth_delta", f"SELECT *, size - lag(size) OVER (PARTITION BY o_orderpriority ORDER BY run_at) AS delta FROM ({MONTHS_SQL})")
def growth_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.growth(month_sizes(spark, sf_dir), "o_orderpriority", "run_at", "size")


@query("growth_totals", f"""
    WITH g AS (SELECT *, size - lag(size) OVER (PARTITION BY o_orderpriority ORDER BY run_at) AS delta FROM ({MONTHS_SQL}))
    SELECT run_at, count(*) AS n_tables, CAST(sum(size) AS BIGINT) AS total_size, CAST(sum(n_rows) AS BIGINT) AS total_n_rows, CAST(coalesce(sum(delta), 0) AS BIGINT) AS total_delta FROM g GROUP BY run_at""")
def growth_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.growth_totals(RP.growth(month_sizes(spark, sf_dir), "o_orderpriority", "run_at", "size"), "run_at", ["size", "n_rows"])


@query("size_ranking", "SELECT source, CAST(sum(n_chars) AS BIGINT) AS total FROM documents GROUP BY source ORDER BY total DESC")
def size_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.top(table(spark, sf_dir, "documents").groupBy("source").agg(F.sum("n_chars").alias("total")), None, F.col("total").desc(), "source")


@query("coverage", """
    SELECT count(*) AS n_live, count(o_custkey) AS n_covered, CAST(round_even(CAST(count(o_custkey) AS DOUBLE) * 100 / count(*), 0) AS BIGINT) AS pct, CAST(ceil((count(*) - count(o_custkey)) / 25.0) AS BIGINT) AS runs_left
    FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey""")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id"))
    return RP.coverage(live, done, "id", 25)


@query("covered_ids", "SELECT c_custkey AS id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' UNION SELECT user_id FROM events)")
def covered_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id"))
    targets = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    return stored.union(targets).intersect(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")))


@query("fair_order", "SELECT event_id, user_id FROM events")
def fair_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RP.random_order(table(spark, sf_dir, "events").select("event_id", "user_id"), "s1", "event_id")


SIZE_CASE = "CASE WHEN v IS NULL OR v = 0 THEN '0{z}' ELSE CASE WHEN v < 0 THEN '-' ELSE '' END || {body} END"


def _size_sql(base: int, units: list[str]) -> str:
    cases = "".join(f"WHEN abs(v) >= {base ** p} THEN CAST(round_even(abs(v) / {float(base ** p)}, 2) AS VARCHAR) || '{' ' + u if u else ''}' " for p, u in reversed(list(enumerate(units))) if p)
    first = f"ELSE CAST(round_even(CAST(abs(v) AS DOUBLE), 2) AS VARCHAR) || '{' ' + units[0] if units[0] else ''}' END"
    return SIZE_CASE.format(z=f" {units[0]}" if units[0] else "", body=f"CASE {cases}{first}")


@query("readable_size", f"""
    WITH s AS (SELECT doc_id, CAST(n_chars * (doc_id % 1000) * CASE WHEN doc_id % 3 = 0 THEN -1 ELSE 1 END AS BIGINT) AS v FROM documents)
    SELECT doc_id, {_size_sql(1024, N.BYTE_UNITS)} AS bytes FROM s""")
def readable_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = (F.col("n_chars") * (F.col("doc_id") % 1000) * F.when(F.col("doc_id") % 3 == 0, -1).otherwise(1)).cast("bigint")
    return table(spark, sf_dir, "documents").select("doc_id", N.readable_size(v).alias("bytes"))


@query("readable_counts", f"""
    WITH s AS (SELECT o_custkey, CAST(count(*) AS BIGINT) * 1000 AS v FROM orders GROUP BY o_custkey) SELECT o_custkey, {_size_sql(1000, N.COUNT_UNITS)} AS n FROM s""")
def readable_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg((F.count("*") * 1000).alias("v")).select("o_custkey", N.readable_size(F.col("v"), 1000).alias("n"))


@query("stat_totals", f"SELECT {KEY_SQL} % 10 AS stat_id, count(*) AS n, CAST(ceil(count(*) / 7.0) AS BIGINT) AS batches FROM events GROUP BY 1")
def stat_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy((key_of_props() % 10).alias("stat_id")).agg(F.count("*").alias("n")).withColumn(
        "batches", N.ceil_div(F.col("n"), F.lit(7)))
