"""Registration of queries and the frames they share.

The supplied tables stand in for the tables of a production system: ``events`` plays the status log, the statistics
and the loadings, ``orders`` / ``lineitem`` / ``customer`` play exported and purged tables, ``pages`` and
``documents`` play object listings and text files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulage.operators.loadings import STATUSES
from haulage.session import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL only its rows are checked."""
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table for work that is costly per row."""
    return spread(table(spark, sf_dir, name).select(*columns))


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def newest(df: DataFrame, column: str) -> str:
    """The anchor "now" of a query: the newest time of a table, fetched once so that it reaches the scans as a constant."""
    return str(df.agg(F.max(column).cast("string")).first()[0])


NOW = "(SELECT max(ts) FROM events)"


def key_of_props() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


KEY_SQL = "CAST(json_extract_string(props, '$.k') AS INTEGER)"

STATUS_LIST_SQL = "[" + ", ".join(f"'{s}'" for s in STATUSES) + "]"

# Each event as one loading.
LOADINGS_SQL = f"""
    SELECT event_id AS lid, user_id AS wf_id, ts AS status_sdt, {KEY_SQL} AS k,
           {STATUS_LIST_SQL}[({KEY_SQL} + length(event_type)) % 13 + 1] AS status,
           CASE {KEY_SQL} % 5 WHEN 0 THEN '' WHEN 1 THEN 'RUN {{''try'': 1}}' WHEN 2 THEN 'TFS wait'
                WHEN 3 THEN 'Start scheduled on 2024-01-15 00:00:00' ELSE 'SUCCESS done' END AS log,
           event_id % 2 = 0 AS running, event_id % 3 = 0 AS abort_on_failure,
           CASE WHEN event_id % 7 = 0 THEN 'COMPLETED' ELSE 'ACTIVE' END AS alive,
           CASE WHEN event_id % 11 = 0 THEN 'other' ELSE 'main' END AS profile,
           CASE WHEN event_id % 6 = 0 THEN 0 ELSE event_id END AS loading_id
    FROM events"""


def loadings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.col("k")
    return ev.select("event_id", "user_id", "ts", "event_type", key_of_props().alias("k")).select(
        F.col("event_id").alias("lid"), F.col("user_id").alias("wf_id"), F.col("ts").alias("status_sdt"), "k",
        F.element_at(F.array(*[F.lit(s) for s in STATUSES]), (k + F.length("event_type")) % 13 + 1).alias("status"),
        F.when(k % 5 == 0, "").when(k % 5 == 1, "RUN {'try': 1}").when(k % 5 == 2, "TFS wait")
        .when(k % 5 == 3, "Start scheduled on 2024-01-15 00:00:00").otherwise("SUCCESS done").alias("log"),
        (F.col("event_id") % 2 == 0).alias("running"), (F.col("event_id") % 3 == 0).alias("abort_on_failure"),
        F.when(F.col("event_id") % 7 == 0, "COMPLETED").otherwise("ACTIVE").alias("alive"),
        F.when(F.col("event_id") % 11 == 0, "other").otherwise("main").alias("profile"),
        F.when(F.col("event_id") % 6 == 0, 0).otherwise(F.col("event_id")).cast("bigint").alias("loading_id"))


# Each event as one status of the loading ``user_id``.
STATUS_LOG_SQL = f"""
    SELECT user_id AS loading_id, ts AS effective_from, event_id,
           CASE event_type WHEN 'click' THEN 'RUNNING' WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'SUCCESS'
                WHEN 'signup' THEN 'TIME-WAIT' ELSE 'EVENT-WAIT' END AS status,
           'k=' || {KEY_SQL} AS log
    FROM events"""


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("loading_id"), F.col("ts").alias("effective_from"), "event_id",
        F.when(kind == "click", "RUNNING").when(kind == "error", "ERROR").when(kind == "purchase", "SUCCESS")
        .when(kind == "signup", "TIME-WAIT").otherwise("EVENT-WAIT").alias("status"),
        F.concat(F.lit("k="), key_of_props().cast("string")).alias("log"))


# Each event as one statistic value.
STATS_SQL = f"""
    SELECT CASE WHEN {KEY_SQL} % 4 = 0 THEN 0 ELSE event_id END AS loading_id, 'P' || (user_id % 3) AS profile, user_id AS entity_id,
           {KEY_SQL} % 10 AS stat_id, CAST({KEY_SQL} AS VARCHAR) AS value, ts AS published_at
    FROM events"""
LATEST_STATS_SQL = f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY profile, entity_id, stat_id ORDER BY published_at DESC, loading_id DESC, value DESC) AS rn
        FROM ({STATS_SQL})) WHERE rn = 1"""


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", key_of_props().alias("k"))
    return ev.select(
        F.when(F.col("k") % 4 == 0, 0).otherwise(F.col("event_id")).cast("bigint").alias("loading_id"),
        F.concat(F.lit("P"), (F.col("user_id") % 3).cast("string")).alias("profile"), F.col("user_id").alias("entity_id"),
        (F.col("k") % 10).alias("stat_id"), F.col("k").cast("string").alias("value"), F.col("ts").alias("published_at"))
