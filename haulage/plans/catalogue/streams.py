"""Streaming queries, run over everything available."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.functions import times as T
from haulage.plans.catalogue.base import KEY_SQL, key_of_props, query, table
from haulage.session import run_folder, stored
from haulage.streaming import flows as ST, stateful as SF


@query("stream_arrivals", "SELECT event_id, ts, user_id, event_type FROM events")
def stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arriving day by day, 25 per cycle."""
    folder = run_folder(spark, "arrivals")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    ev.repartition(40, F.to_date("ts")).write.parquet(f"{folder}/in")
    return ST.drain(ST.arriving_rows(spark, f"{folder}/in", ev.schema, per_cycle=25), folder, "rows")


@query("stream_listing", "SELECT count(*) AS n_rows, count(DISTINCT CAST(ts AS DATE)) AS n_days FROM events")
def stream_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arriving files are listed first and read after; rows of files that were not listed do not count."""
    folder = run_folder(spark, "listing")
    ev = table(spark, sf_dir, "events").select("event_id", "ts")
    ev.repartition(30, F.to_date("ts")).write.parquet(f"{folder}/in")
    seen = ST.drain(ST.arriving_files(spark, f"{folder}/in", "*.parquet"), folder, "files")
    rows = spark.read.schema(ev.schema).parquet(f"{folder}/in").withColumn("_path", F.regexp_replace("_metadata.file_path", "^file:/*", "/"))
    listed = seen.select(F.regexp_replace("path", "^file:/*", "/").alias("_path")).distinct()
    return rows.join(listed, "_path", "left_semi").agg(F.count("*").alias("n_rows"), F.countDistinct(F.to_date("ts")).alias("n_days"))


@query("stream_events", "SELECT DISTINCT user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publications once per key."""
    source = table(spark, sf_dir, "events")
    stream = ST.arriving_rows(spark, sf_dir, source.schema, "events.parquet")
    keyed = ST.as_event_time(stream.select("ts", "user_id", "event_type", key_of_props().alias("k")), "ts")
    once = ST.first_publications(keyed, ["user_id", "event_type", "k"], "ts", "90 days")
    return ST.drain(once, run_folder(spark, "publications"), "rows").select("user_id", "event_type", "k")


@query("stream_receipts", """
    WITH q AS (SELECT event_id, ts FROM events WHERE event_type = 'purchase'), r AS (SELECT event_id - 1 AS event_id, ts, event_id % 3 AS code FROM events WHERE event_type = 'view'),
    e AS (SELECT least((SELECT max(ts) FROM q), (SELECT max(ts) FROM r)) - INTERVAL 1 MINUTE AS mark)
    SELECT CAST(q.event_id AS VARCHAR) AS rq_uid, code, CASE WHEN code IS NULL THEN 'timeout' WHEN code = 0 THEN 'confirmed' ELSE 'failed' END AS state
    FROM q CROSS JOIN e LEFT JOIN r ON q.event_id = r.event_id AND r.ts >= q.ts AND r.ts <= q.ts + INTERVAL 5 MINUTE
    WHERE code IS NOT NULL OR q.ts + INTERVAL 5 MINUTE < mark""")
def stream_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests matched with receipts within five minutes; the unanswered ones time out."""
    schema = table(spark, sf_dir, "events").schema

    def events(kind: str) -> DataFrame:
        return ST.as_event_time(ST.arriving_rows(spark, sf_dir, schema, "events.parquet").where(F.col("event_type") == kind), "ts")

    sent = events("purchase").select(F.col("event_id").cast("string").alias("rq_uid"), F.col("ts").alias("sent_at"))
    got = events("view").select((F.col("event_id") - 1).cast("string").alias("rq_uid"), F.col("ts").alias("received_at"), (F.col("event_id") % 3).alias("code"))
    out = ST.drain(ST.answered(sent, got, "5 MINUTES"), run_folder(spark, "receipts"), "rows")
    return out.select("rq_uid", "code", "state")


PUBLICATION_SQL = f"""
    WITH v AS (SELECT event_id, 'P' || user_id % 3 AS prf, CAST(user_id // 3 AS VARCHAR) AS eid, event_id || '/P' || user_id % 3 || '/' || user_id // 3 || '/' || {KEY_SQL} % 10 AS pub_key,
        date_trunc('milliseconds', ts) - to_seconds(CASE WHEN {KEY_SQL} % 9 = 0 THEN 86400 WHEN {KEY_SQL} % 9 = 1 THEN 50 ELSE 0 END) AS moment FROM events),
    m AS (SELECT *, max(moment) OVER (PARTITION BY prf, eid ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM v)
    SELECT prf, eid, pub_key, moment AS "at" FROM m WHERE last IS NULL OR moment >= last - INTERVAL 1 MINUTE"""


@query("stream_publications", PUBLICATION_SQL)
def stream_publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that arrive in the order of their ids, every value twice and some of them late: each is published once, stale ones are not."""
    folder = run_folder(spark, "values")
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", key_of_props().alias("k"))
    late = F.when(F.col("k") % 9 == 0, 86400).when(F.col("k") % 9 == 1, 50).otherwise(0)
    entity = F.floor(F.col("user_id") / 3).cast("string")
    values = ev.select(
        F.concat(F.lit("P"), (F.col("user_id") % 3).cast("string")).alias("prf"), entity.alias("eid"),
        F.concat_ws("/", F.col("event_id").cast("string"), F.concat(F.lit("P"), (F.col("user_id") % 3).cast("string")), entity, (F.col("k") % 10).cast("string")).alias("pub_key"),
        F.col("event_id").alias("arrival"), (F.date_trunc("millisecond", "ts") - T.seconds(late)).cast("timestamp").alias("at"))
    # Parts come in the order of the ids; every row of a part stands there twice.
    values.withColumn("arrival", F.explode(F.array("arrival", "arrival"))).repartitionByRange(6, "arrival").sortWithinPartitions("arrival").write.parquet(f"{folder}/in")
    stream = ST.arriving_rows(spark, f"{folder}/in", values.schema, per_cycle=None)
    out = ST.drain(SF.publications(stream, "30 days"), folder, "rows")
    return out.select("prf", "eid", "pub_key", F.col("at").cast("timestamp_ntz").alias("at"))


WAITS_SQL = """
    WITH e AS (SELECT event_id, user_id, event_type, date_trunc('milliseconds', ts) AS moment FROM events),
    s AS (SELECT user_id AS lid, min(moment) AS start, CASE WHEN user_id % 3 = 0 THEN 'or' ELSE 'and' END AS strategy, to_milliseconds(1 + (user_id % 5 + 1) * 7200000) AS term, user_id % 4 AS total_left FROM e GROUP BY user_id),
    v AS (SELECT user_id AS lid, moment, event_type AS ev, lead(moment) OVER (PARTITION BY user_id ORDER BY moment, event_id) AS following FROM e WHERE event_type IN ('click', 'purchase')),
    f AS (SELECT lid, start, strategy, term, total_left, min(moment) AS any_at, CASE WHEN strategy = 'or' THEN min(moment) ELSE greatest(min(moment) FILTER (ev = 'click'), min(moment) FILTER (ev = 'purchase')) END AS all_at,
        coalesce(count(DISTINCT ev), 0) AS kinds, greatest(max(moment), start) AS newest FROM s LEFT JOIN v USING (lid) GROUP BY lid, start, strategy, term, total_left),
    c AS (SELECT *, CASE WHEN strategy = 'or' OR kinds = 2 THEN all_at END AS full_at FROM f),
    d AS (SELECT *, i, start + i * term AS due FROM c, generate_series(1, 4) t(i) WHERE strategy = 'and' AND i <= total_left + 1),
    missed AS (SELECT *, any_at IS NULL OR any_at > due OR i = total_left + 1 AS ends FROM d WHERE full_at IS NULL OR full_at > due),
    dead AS (SELECT lid, min(i) AS last_i FROM missed WHERE ends GROUP BY lid),
    terms AS (SELECT lid, count(*) AS n FROM missed GROUP BY lid),
    out AS (
        SELECT lid, due AS moment, CASE WHEN ends THEN 'ERROR' ELSE 'EVENT-WAIT' END AS status, CASE WHEN ends THEN i ELSE i + 1 END AS tries, CASE WHEN ends THEN total_left - i + 1 ELSE total_left - i END AS remaining, CASE WHEN ends THEN -99 END AS res, newest
        FROM missed LEFT JOIN dead USING (lid) WHERE last_i IS NULL OR i <= last_i
        UNION ALL
        SELECT lid, min(v.moment) + INTERVAL 30 MINUTE, 'READY', 1 + coalesce(n, 0), total_left - coalesce(n, 0), NULL, newest
        FROM c JOIN v USING (lid) LEFT JOIN dead USING (lid) LEFT JOIN terms USING (lid) WHERE last_i IS NULL AND v.moment >= full_at AND (following IS NULL OR following > v.moment + INTERVAL 30 MINUTE) GROUP BY lid, total_left, n, newest),
    mark AS (SELECT max(moment) - INTERVAL 1 HOUR AS mark FROM e)
    SELECT lid AS loading_id, moment AS "at", status, CAST(tries AS INTEGER) AS tries, CAST(remaining AS INTEGER) AS "left", res FROM out, mark WHERE moment <= mark OR moment < newest"""


@query("stream_waits", WAITS_SQL)
def stream_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loading per user waits for clicks and purchases: ready once they have settled, retried or given up at its deadlines."""
    folder = run_folder(spark, "waits")
    ev = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("owner"), F.col("event_type").alias("event"), F.date_trunc("millisecond", "ts").cast("timestamp").alias("at"))
    ev.repartitionByRange(6, "at").sortWithinPartitions("at").write.parquet(f"{folder}/in")
    user = F.col("owner")
    subscriptions = stored(ev.groupBy("owner").agg(F.min_by("event_id", F.struct("at", "event_id")).alias("first_event")).select(
        "owner", user.alias("loading_id"), "first_event", F.when(user % 3 == 0, "or").otherwise("and").alias("strategy"), F.array(F.lit("click"), F.lit("purchase")).alias("wanted"),
        (1 + (user % 5 + 1) * 7_200_000).alias("expire_ms"), (user % 4).cast("int").alias("left")), "subscriptions")
    stream = ST.arriving_rows(spark, f"{folder}/in", ev.schema)
    out = ST.drain(SF.waits(SF.addressed(stream, subscriptions), "1 hour"), folder, "rows")
    return out.select("loading_id", F.col("at").cast("timestamp_ntz").alias("at"), "status", "tries", "left", "res")
