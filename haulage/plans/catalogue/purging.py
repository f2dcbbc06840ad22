"""Retention queries: what a purge removes, keeps and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.operators import retention as RT
from haulage.plans.catalogue.base import newest, query, table

CUT = "TIMESTAMP '2000-01-01 00:00:00'"
CUTOFF = "2000-06-29 00:00:00"  # 180 days later than the cut


def before() -> "F.Column":
    return RT.cutoff(CUTOFF, 180)


@query("purge_age", f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < {CUT}")
def purge_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RT.candidates(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), RT.Rule("o_orderdate"), before())


def line_rule(spark: SparkSession, sf_dir: str) -> RT.Rule:
    return RT.Rule("l_shipdate", parent=(table(spark, sf_dir, "orders"), [("l_orderkey", "o_orderkey")], "o_orderdate"))


@query("purge_parent", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE l_shipdate < {CUT}
      AND EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderdate < {CUT})""")
def purge_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RT.candidates(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"), line_rule(spark, sf_dir), before())


@query("purge_parent_pair", f"""
    SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_shipdate < {CUT}
      AND EXISTS (SELECT 1 FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey = l_orderkey AND c_nationkey = l_suppkey % 25 AND o_orderdate < {CUT})""")
def purge_parent_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = table(spark, sf_dir, "lineitem").withColumn("nation", (F.col("l_suppkey") % 25).cast("int"))
    rule = RT.Rule("l_shipdate", parent=(parent, [("l_orderkey", "o_orderkey"), ("nation", "c_nationkey")], "o_orderdate"))
    return RT.candidates(lines, rule, before()).select("l_orderkey", "l_linenumber", "l_suppkey")


def last_rule() -> RT.Rule:
    return RT.Rule("o_orderdate", keep_last=("o_custkey", F.col("o_orderstatus") != "P"))


KEEP_LAST = f"""
    SELECT o.o_orderkey, o.o_custkey, o.o_orderdate FROM orders o LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS m FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey) l
      ON o.o_custkey = l.o_custkey AND o.o_orderdate = l.m WHERE o.o_orderdate < {CUT} AND l.m IS NULL"""


@query("purge_keep_last", KEEP_LAST)
def purge_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RT.candidates(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"), last_rule(), before()).select(
        "o_orderkey", "o_custkey", "o_orderdate")


@query("purge_kept", f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({KEEP_LAST}))")
def purge_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return RT.kept(orders, last_rule(), before(), ["o_orderkey"]).select("o_orderkey", "o_orderdate")


def unreferenced_rule(spark: SparkSession, sf_dir: str) -> RT.Rule:
    lines = table(spark, sf_dir, "lineitem").where("l_quantity > 25")
    return RT.Rule("o_orderdate", referenced_by=[(lines, "o_orderkey", "l_orderkey")])


@query("purge_unreferenced", f"""
    SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < {CUT} AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_quantity > 25 AND l_orderkey = o_orderkey)""")
def purge_unreferenced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RT.candidates(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), unreferenced_rule(spark, sf_dir), before())


@query("purge_report", f"""
    WITH r AS (SELECT 'orders' AS table_name, count(*) AS n_rows, min(o_orderdate) AS min_at, max(o_orderdate) AS max_at FROM orders WHERE o_orderdate < {CUT}
        UNION ALL SELECT 'lineitem', count(*), min(l_shipdate), max(l_shipdate) FROM lineitem WHERE l_shipdate < {CUT} AND EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderdate < {CUT})
        UNION ALL SELECT 'last', count(*), min(o_orderdate), max(o_orderdate) FROM ({KEEP_LAST}))
    SELECT table_name, CAST(sum(n_rows) AS BIGINT) AS n_rows, min(min_at) AS min_at, max(max_at) AS max_at FROM r GROUP BY ROLLUP (table_name)""")
def purge_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return RT.purge_report([
        RT.dry_run(orders, RT.Rule("o_orderdate"), before(), "orders"),
        RT.dry_run(table(spark, sf_dir, "lineitem"), line_rule(spark, sf_dir), before(), "lineitem"),
        RT.dry_run(orders, last_rule(), before(), "last")])


@query("time_slices", f"""
    WITH c AS (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate < {CUT}),
    s AS (SELECT count(*) AS n, min(o_orderdate) AS lo FROM c), b AS (SELECT CAST(greatest(ceil(n / 500.0), 1) AS BIGINT) AS nb, lo FROM s)
    SELECT o_orderkey, least(CAST((CAST(date_diff('microsecond', lo, o_orderdate) AS HUGEINT) * nb) // date_diff('microsecond', lo, {CUT}) AS BIGINT), nb - 1) AS batch_id FROM c, b""")
def time_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = RT.candidates(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), RT.Rule("o_orderdate"), before())
    return RT.time_slices(rows, "o_orderdate", before(), 500).select("o_orderkey", "batch_id")


@query("key_batches", f"""
    SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS BIGINT) AS batch_id FROM orders WHERE o_orderdate < {CUT}""")
def key_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = RT.candidates(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), RT.Rule("o_orderdate"), before())
    return RT.key_batches(rows.select("o_orderkey"), ["o_orderkey"], 500)


@query("object_expiry", "SELECT event_id, ts FROM events WHERE ts <= (SELECT max(ts) FROM events) - INTERVAL 20 DAY")
def object_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return RT.expired_objects(ev.select("event_id", "ts"), newest(ev, "ts"), 20, "ts")


@query("orphan_versions", "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')")
def orphan_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return RT.orphan_versions(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), live, "l_orderkey")
