"""Receiver side: batches applied to a target."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.functions import times as T
from haulage.operators import apply as AP
from haulage.operators.apply import newest_per_key
from haulage.plans.catalogue.base import query, table
from haulage.session import run_folder
from haulage.sinks.keyed import KeyedTarget

# Target: two thirds of the orders and a row without key. Batch: updates, deletions, inserts, repeated keys, deletions without a match and
# two changes of the row without key.
TARGET_SQL = """
    SELECT o_orderkey, o_orderstatus, o_totalprice, 'I' AS ctl_action, TIMESTAMP '2024-01-01 00:00:00' AS ctl_validfrom FROM orders WHERE o_orderkey % 3 <> 0
    UNION ALL SELECT NULL, 'O', max(o_totalprice), 'I', TIMESTAMP '2024-01-01 00:00:00' FROM orders"""
BATCH_SQL = """
    SELECT o_orderkey, 'U' || o_orderstatus AS o_orderstatus, o_totalprice + 1 AS o_totalprice, CASE WHEN o_orderkey % 7 = 0 THEN 'D' ELSE 'U' END AS ctl_action,
           TIMESTAMP '2024-02-01 00:00:00' + to_minutes(CAST(o_custkey % 60 AS INTEGER)) AS ctl_validfrom FROM orders WHERE o_orderkey % 5 < 2
    UNION ALL
    SELECT o_orderkey, 'X', o_totalprice + 2, CASE WHEN o_orderkey % 11 = 0 THEN 'D' ELSE 'I' END, TIMESTAMP '2024-02-01 00:30:00' FROM orders WHERE o_orderkey % 5 = 0
    UNION ALL
    SELECT o_orderkey + 10000000, 'N', o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN 'D' ELSE 'I' END, TIMESTAMP '2024-02-02 00:00:00' FROM orders WHERE o_orderkey % 13 = 0
    UNION ALL SELECT NULL, 'E', max(o_totalprice) + 1, 'D', TIMESTAMP '2024-02-01 00:00:00' FROM orders
    UNION ALL SELECT NULL, 'L', max(o_totalprice) + 2, 'U', TIMESTAMP '2024-02-03 00:00:00' FROM orders"""
DEDUP_SQL = "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ctl_validfrom DESC, o_orderstatus DESC, o_totalprice DESC, ctl_action DESC) AS rn FROM ({})) WHERE rn = 1"


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = orders.where("o_orderkey % 3 <> 0").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", F.lit("I").alias("ctl_action"), T.moment("2024-01-01 00:00:00").alias("ctl_validfrom"))
    return rows.unionByName(without_key(orders, "O", 0, "I", "2024-01-01 00:00:00"))


def without_key(orders: DataFrame, status: str, more: int, action: str, at: str) -> DataFrame:
    """One row whose key is NULL."""
    most = orders.agg((F.max("o_totalprice") + more).alias("o_totalprice"))
    return most.select(F.lit(None).cast("bigint").alias("o_orderkey"), F.lit(status).alias("o_orderstatus"), "o_totalprice", F.lit(action).alias("ctl_action"), T.moment(at).alias("ctl_validfrom"))


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    changed = orders.where(key % 5 < 2).select(
        "o_orderkey", F.concat(F.lit("U"), "o_orderstatus").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.when(key % 7 == 0, "D").otherwise("U").alias("ctl_action"), (T.moment("2024-02-01 00:00:00") + T.seconds(F.col("o_custkey") % 60 * 60)).alias("ctl_validfrom"))
    again = orders.where(key % 5 == 0).select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 2).alias("o_totalprice"),
        F.when(key % 11 == 0, "D").otherwise("I").alias("ctl_action"), T.moment("2024-02-01 00:30:00").alias("ctl_validfrom"))
    fresh = orders.where(key % 13 == 0).select(
        (key + 10_000_000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_totalprice",
        F.when(key % 2 == 0, "D").otherwise("I").alias("ctl_action"), T.moment("2024-02-02 00:00:00").alias("ctl_validfrom"))
    early, late = without_key(orders, "E", 1, "D", "2024-02-01 00:00:00"), without_key(orders, "L", 2, "U", "2024-02-03 00:00:00")
    return changed.unionByName(again).unionByName(fresh).unionByName(early).unionByName(late)


@query("apply_full_uk", f"SELECT * REPLACE ('I' AS ctl_action) FROM ({DEDUP_SQL.format(f'SELECT * FROM ({BATCH_SQL}) WHERE ctl_action <> ' + chr(39) + 'D' + chr(39))})")
def apply_full_uk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AP.apply_batch(target(spark, sf_dir), batch(spark, sf_dir), "FULL_UK", ["o_orderkey"])


@query("apply_full_no_uk", f"SELECT * REPLACE ('I' AS ctl_action) FROM ({BATCH_SQL}) WHERE ctl_action <> 'D'")
def apply_full_no_uk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AP.apply_batch(target(spark, sf_dir), batch(spark, sf_dir), "FULL_NO_UK")


INC_SQL = f"""
    WITH t AS ({TARGET_SQL}), b AS ({DEDUP_SQL.format(BATCH_SQL)})
    SELECT b.* REPLACE (CASE WHEN there IS NULL THEN 'I' ELSE 'U' END AS ctl_action) FROM b LEFT JOIN (SELECT *, true AS there FROM t) t ON b.o_orderkey IS NOT DISTINCT FROM t.o_orderkey WHERE b.ctl_action <> 'D'
    UNION ALL SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.o_orderkey IS NOT DISTINCT FROM t.o_orderkey)"""


@query("apply_inc", INC_SQL)
def apply_inc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AP.apply_batch(target(spark, sf_dir), batch(spark, sf_dir), "INC", ["o_orderkey"])


@query("apply_append", f"SELECT * FROM ({TARGET_SQL}) UNION ALL SELECT * REPLACE ('I' AS ctl_action) FROM ({BATCH_SQL})")
def apply_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AP.apply_batch(target(spark, sf_dir), batch(spark, sf_dir), "APPEND")


@query("merge_inc", INC_SQL)
def merge_inc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch in two merges into a target of many files."""
    kept = KeyedTarget(spark, run_folder(spark, "merge-inc"), ["o_orderkey"])
    kept.create(target(spark, sf_dir), rows_per_file=500)
    whole = newest_per_key(batch(spark, sf_dir), ["o_orderkey"])
    for turn in range(2):
        kept.merge(whole.where(F.pmod(F.xxhash64("o_orderkey"), F.lit(2)) == turn))
    return kept.read()


@query("merge_touched", """
    WITH m AS (SELECT max(o_orderkey) AS m, count(*) AS n FROM orders), c AS (SELECT count(*) AS n FROM orders, m WHERE o_orderkey > m // 2 AND o_orderkey <= m // 2 + m // 100)
    SELECT s.step, CASE WHEN s.step = 'inserts' THEN m.n + c.n ELSE m.n END AS n_rows, CASE WHEN s.step = 'inserts' THEN CAST(0 AS BIGINT) ELSE c.n END AS n_changed, true AS is_bounded
    FROM (VALUES ('updates'), ('inserts')) s(step), m, c""")
def merge_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundredth of the keys updated, then as many new ones: rows after each merge, rows of the batch found in the files read, and
    whether the files read are at most a quarter of all (none for new keys)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.lit("I").alias("ctl_action"), T.moment("2024-01-01 00:00:00").alias("ctl_validfrom"))
    kept = KeyedTarget(spark, run_folder(spark, "merge-touched"), ["o_orderkey"])
    total = orders.count()
    kept.create(orders, rows_per_file=max(1, total // 160))
    most = orders.agg(F.max("o_orderkey")).first()[0]
    part = orders.where((F.col("o_orderkey") > most // 2) & (F.col("o_orderkey") <= most // 2 + most // 100)).withColumn("ctl_action", F.lit("U"))
    out = []
    for step, change in (("updates", part), ("inserts", part.withColumn("o_orderkey", F.col("o_orderkey") + 2 * most))):
        done = kept.merge(change)
        found = kept.read().join(part.select("o_orderkey"), "o_orderkey", "left_semi").where("ctl_action = 'U'").count() if done.files_read else 0
        out.append((step, kept.read().count(), found, done.files_read * 4 <= done.files_before))
    return spark.createDataFrame(out, "step string, n_rows long, n_changed long, is_bounded boolean")
