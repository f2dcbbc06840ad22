"""Time expressions over whole columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.functions import times as T
from haulage.plans.catalogue.base import KEY_SQL, key_of_props, newest, query, table


@query("delta_expression", """
    SELECT event_id, date_trunc('day', ts)::TIMESTAMP + INTERVAL 8 HOUR + INTERVAL 30 MINUTE AS at_time,
           date_trunc('second', date_trunc('day', ts) + to_days(CAST(2 - (isodow(ts) - 1) AS INTEGER)) + (ts - date_trunc('day', ts)) + INTERVAL 3 HOUR - INTERVAL 15 MINUTE)::TIMESTAMP AS on_weekday,
           date_trunc('second', ts + INTERVAL 1 HOUR + INTERVAL 5 MINUTE + INTERVAL 10 SECOND)::TIMESTAMP AS later,
           date_trunc('second', make_timestamp(2023, month(ts), 5, 0, 0, 0) + (ts - date_trunc('day', ts)) + INTERVAL 2 DAY)::TIMESTAMP AS on_date FROM events""")
def delta_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    month = T.shift(ts, "date=2023, 2 days")
    return table(spark, sf_dir, "events").select(
        "event_id", T.shift(ts, "time=8:30").alias("at_time"), T.shift(ts, "weekday=2, hours=+3,minutes=-15").alias("on_weekday"),
        T.shift(ts, "1:05:10").alias("later"), (month - F.make_dt_interval(F.dayofmonth(ts) - 5)).alias("on_date"))


@query("moment_default", """
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts)::TIMESTAMP ELSE TIMESTAMP '1970-01-01 00:00:00' END AS at FROM events""")
def moment_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(F.col("event_id") % 3 == 1, "no time")
    return table(spark, sf_dir, "events").select("event_id", T.moment_or_default(texts).alias("at"))


EXPRESSIONS = ["time=8:30", "weekday=0", "hours=+5", "2 days", "1:05:10", "date=2023-06-15,minutes=-1", "weeks=1, seconds=30", "", "unknown"]


@query("delta_per_row", f"""
    SELECT event_id, CASE {KEY_SQL} % 9
        WHEN 0 THEN date_trunc('day', ts) + INTERVAL 510 MINUTE WHEN 1 THEN date_trunc('second', ts - to_days(CAST(isodow(ts) - 1 AS INTEGER)))
        WHEN 2 THEN date_trunc('second', ts + INTERVAL 5 HOUR) WHEN 3 THEN date_trunc('second', ts + INTERVAL 2 DAY) WHEN 4 THEN date_trunc('second', ts + INTERVAL 3910 SECOND)
        WHEN 5 THEN date_trunc('second', TIMESTAMP '2023-06-15 00:00:00' + (ts - date_trunc('day', ts)) - INTERVAL 1 MINUTE) WHEN 6 THEN date_trunc('second', ts + INTERVAL 7 DAY + INTERVAL 30 SECOND)
        ELSE date_trunc('second', ts) END::TIMESTAMP AS moved FROM events""")
def delta_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = F.element_at(F.array(*[F.lit(e) for e in EXPRESSIONS]), key_of_props() % 9 + 1)
    # "unknown" adds int("unknown") hours in the clock form, which is no number and counts as 0.
    return table(spark, sf_dir, "events").select("event_id", T.shift_by_column(F.col("ts"), texts).alias("moved"))


@query("durations", """
    SELECT event_id, date_trunc('second', ts + INTERVAL 1 HOUR + to_minutes(CAST(user_id % 60 AS INTEGER)))::TIMESTAMP AS plus_text, date_trunc('second', ts + to_minutes(CAST(user_id AS INTEGER)))::TIMESTAMP AS plus_number FROM events""")
def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    text = F.concat(F.lit("H=1, junk=7, min="), (F.col("user_id") % 60).cast("string"), F.lit(",oops"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_trunc("second", F.col("ts") + T.minutes_or_duration(text)).cast("timestamp_ntz").alias("plus_text"),
        F.date_trunc("second", F.col("ts") + T.minutes_or_duration(user)).cast("timestamp_ntz").alias("plus_number"))


@query("time_formats", """
    WITH e AS (SELECT event_id, ts, (SELECT max(ts) FROM events) AS hi FROM events), d AS (SELECT *, date_sub('second', ts, hi) AS s FROM e)
    SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g+00:00') AS iso, strftime(ts, '%Y-%m-%d %H:%M:%S') AS clock,
           CASE WHEN s >= 86400 THEN (s // 86400) || ' d ' ELSE '' END || lpad((s % 86400 // 3600) || '', 2, '0') || ':' || lpad((s % 3600 // 60) || '', 2, '0') AS age,
           (date_trunc('day', ts) - INTERVAL 3 DAY)::TIMESTAMP AS window_start FROM d""")
def time_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev, ts = table(spark, sf_dir, "events"), F.col("ts")
    return ev.select(
        "event_id", T.stamp(ts).alias("stamp"), T.iso_millis(ts).alias("iso"), T.clock_text(ts).alias("clock"),
        T.elapsed_text(T.moment(newest(ev, "ts")), ts).alias("age"), T.day_window_start(ts, 3).alias("window_start"))
