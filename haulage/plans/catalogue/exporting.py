"""Export side: registry, windows, package rows and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.functions import text as X, times as T
from haulage.operators import extract as EX, parts as PA, schema as SC, state as ST
from haulage.plans.catalogue.base import KEY_SQL, dealt, key_of_props, newest, query, table, views
from haulage.session import run_folder, stored
from haulage.sinks import notify as NO
from haulage.sources import registry as RG

LO, HI = "1997-01-01 00:00:00", "1998-06-30 00:00:00"
VALID = "2024-01-01 00:00:00"


@query("delta_window", f"""
    SELECT TIMESTAMP '{HI}' AS export_time, *, 'I' AS ctl_action, TIMESTAMP '{VALID}' AS ctl_validfrom FROM orders
    WHERE TIMESTAMP '{LO}' < o_orderdate AND o_orderdate <= TIMESTAMP '{HI}'""")
def delta_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = EX.delta_window(table(spark, sf_dir, "orders"), "o_orderdate", LO, HI)
    return EX.technical_columns(rows, HI, VALID)


@query("recent_window", """
    WITH e AS (SELECT date_trunc('second', max(ts)) AS hi FROM events)
    SELECT event_id, ts, user_id, event_type FROM events, e WHERE ts > hi - INTERVAL 3 DAY AND ts <= hi""")
def recent_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return EX.recent_window(ev, "ts", newest(ev, "ts"), 3 * 24 * 60).select("event_id", "ts", "user_id", "event_type")


START, UNTIL = "2024-01-01 00:00:00", "2024-01-29 06:00:00"
CATCH_UP = f"""
    SELECT CAST(s AS INTEGER) AS seq, TIMESTAMP '{START}' + s * INTERVAL 12 HOUR - INTERVAL 1 HOUR AS time_from,
           least(TIMESTAMP '{START}' + (s + 1) * INTERVAL 12 HOUR, TIMESTAMP '{UNTIL}') AS time_to
    FROM generate_series(0, 56) t(s)"""


@query("window_catchup", f"""
    WITH w AS ({CATCH_UP})
    SELECT seq, time_from, time_to, time_to = TIMESTAMP '{UNTIL}' AS is_current, count(ts) AS n_rows
    FROM w LEFT JOIN events ON ts > time_from AND ts <= time_to GROUP BY ALL""")
def window_catchup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ST.window_counts(table(spark, sf_dir, "events"), "ts", START, UNTIL, 720, 3600)


@query("overlap_dedup", f"""
    WITH w AS ({CATCH_UP})
    SELECT event_id, user_id, max(time_to) AS ctl_validfrom, 'I' AS ctl_action FROM events JOIN w ON ts > time_from AND ts <= time_to
    GROUP BY event_id, user_id""")
def overlap_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from haulage.operators.apply import full_by_key

    read = ST.window_rows(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "ts", START, UNTIL, 720, 3600)
    batch = read.select("event_id", "user_id", F.col("time_to").alias("ctl_validfrom"), F.lit("I").alias("ctl_action"))
    return full_by_key(batch, ["event_id"])


@query("window_state", f"""
    WITH h AS (SELECT user_id, event_type, date_trunc('hour', ts) AS time_to, event_id % 4 <> 0 AS is_confirmed FROM events WHERE event_type <> 'view'),
    last AS (SELECT user_id, event_type, max(time_to) AS last_to FROM h GROUP BY ALL),
    r AS (SELECT DISTINCT user_id, event_type FROM events),
    s AS (SELECT r.user_id, r.event_type, last_to IS NULL AS is_first, coalesce(last_to, TIMESTAMP '2024-01-01 00:00:00') AS base FROM r LEFT JOIN last USING (user_id, event_type))
    SELECT user_id || '.' || event_type AS extract_name, base - to_seconds(CAST(user_id % 3 * 60 AS INTEGER)) AS time_from,
           least(base + to_minutes(CAST(60 + user_id % 5 * 600 AS INTEGER)), TIMESTAMP '2024-01-31 00:00:00') AS time_to,
           least(base + to_minutes(CAST(60 + user_id % 5 * 600 AS INTEGER)), TIMESTAMP '2024-01-31 00:00:00') = TIMESTAMP '2024-01-31 00:00:00' AS is_current, is_first
    FROM s""")
def window_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    name = F.concat_ws(".", F.col("user_id").cast("string"), "event_type")
    at = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    history = ev.where(F.col("event_type") != "view").select(
        name.alias("extract_name"), at.alias("extract_time"), at.alias("time_to"), at.alias("loaded"), at.alias("sent"),
        F.when(F.col("event_id") % 4 != 0, at).alias("confirmed"), F.lit(0).cast("bigint").alias("extract_count"))
    registry = ev.select(
        name.alias("extract_name"), (60 + F.col("user_id") % 5 * 600).cast("int").alias("increment"),
        (F.col("user_id") % 3 * 60).cast("int").alias("overlap"), F.lit("2024-01-01 00:00:00").alias("lower_bound"), F.lit("ts").alias("time_field")).distinct()
    return ST.next_windows(registry, history, "2024-01-31 00:00:00").select("extract_name", "time_from", "time_to", "is_current", "is_first")


@query("auto_confirm", """
    SELECT o_custkey || '' AS extract_name, o_orderdate AS extract_time, count(*) AS n FROM orders o
    WHERE o_orderstatus = 'F' AND NOT EXISTS (SELECT 1 FROM orders c WHERE c.o_orderstatus = 'O' AND c.o_custkey = o.o_custkey AND c.o_orderdate = o.o_orderdate)
    GROUP BY ALL""")
def auto_confirm(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    history = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("extract_name"), F.col("o_orderdate").alias("extract_time"),
        F.when(status != "P", F.col("o_orderdate")).alias("sent"), F.when(status == "O", F.col("o_orderdate")).alias("confirmed"))
    return ST.auto_confirm(history, VALID).groupBy("extract_name", "extract_time").agg(F.count("confirmed").alias("n"))


@query("confirm_wait", """
    WITH s AS (SELECT event_id, ts, event_id % 5 <> 0 AS needs FROM events WHERE event_type = 'purchase'),
    r AS (SELECT event_id - 1 AS event_id, min(ts) AS got FROM events WHERE event_type = 'view' GROUP BY 1)
    SELECT CAST(s.event_id AS VARCHAR) AS rq_uid, CASE WHEN got >= ts AND got <= ts + INTERVAL 5 MINUTE THEN got END AS confirmed,
           CASE WHEN NOT needs THEN 'skipped' WHEN got >= ts AND got <= ts + INTERVAL 5 MINUTE THEN 'confirmed'
                WHEN ts + INTERVAL 5 MINUTE <= TIMESTAMP '2024-01-30 00:00:00' THEN 'timeout' ELSE 'waiting' END AS state
    FROM s LEFT JOIN r USING (event_id)""")
def confirm_wait(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    sent = ev.where("event_type = 'purchase'").select(
        F.col("event_id").cast("string").alias("rq_uid"), F.col("ts").alias("sent_at"),
        ST.needs_confirm(F.lit(False), F.lit(True), F.col("event_id") % 5).alias("needs_confirm"))
    got = ev.where("event_type = 'view'").select((F.col("event_id") - 1).cast("string").alias("rq_uid"), F.col("ts").alias("received_at"))
    return ST.confirmations(sent, got, 5, "2024-01-30 00:00:00").select("rq_uid", "confirmed", "state")


# Registry rows from events: one version per event.
REGISTRY_SQL = f"""
    SELECT 'db' || (user_id % 2) AS db_name, 'x' || user_id || '_' || event_type AS extract_name, event_id AS version, event_id % 3 <> 0 AS is_active,
           CASE WHEN {KEY_SQL} % 9 = 0 THEN '' ELSE 'src' END AS sql_from, 'r' || ({KEY_SQL} % 4) AS replica,
           CASE WHEN {KEY_SQL} % 2 = 0 THEN 'd' || {KEY_SQL} ELSE '' END AS description FROM events"""
ACTIVE_SQL = f"""
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY db_name, extract_name ORDER BY version DESC) AS rn FROM ({REGISTRY_SQL}))
    WHERE rn = 1 AND is_active"""


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", key_of_props().alias("k"))
    k = F.col("k")
    return ev.select(
        F.concat(F.lit("db"), (F.col("user_id") % 2).cast("string")).alias("db_name"),
        F.concat(F.lit("x"), F.col("user_id").cast("string"), F.lit("_"), "event_type").alias("extract_name"),
        F.col("event_id").alias("updated_at"), (F.col("event_id") % 3 != 0).cast("int").alias("is_active"),
        F.when(k % 9 == 0, "").otherwise("src").alias("sql_from"), F.concat(F.lit("r"), (k % 4).cast("string")).alias("replica"),
        F.when(k % 2 == 0, F.concat(F.lit("d"), k.cast("string"))).otherwise("").alias("description"))


def routes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("r0", "S-0", "out/a"), ("r1", "S-1", "out/b"), ("r2", "S-2", "out/c")], "replica string, scenario string, prefix string")


ROUTES_SQL = "(VALUES ('r0', 'S-0', 'out/a'), ('r1', 'S-1', 'out/b'), ('r2', 'S-2', 'out/c')) t(replica, scenario, prefix)"


@query("registry_latest", f"SELECT db_name, extract_name, version, replica, sql_from FROM ({ACTIVE_SQL})")
def registry_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RG.active_registry(registry(spark, sf_dir)).select("db_name", "extract_name", F.col("updated_at").alias("version"), "replica", "sql_from")


@query("registry_checked", f"""
    SELECT extract_name, replica, scenario, prefix,
           CASE WHEN sql_from = '' THEN 'sql_from is empty' WHEN scenario IS NULL THEN 'unknown replica' END AS reject_reason
    FROM ({ACTIVE_SQL}) a LEFT JOIN {ROUTES_SQL} USING (replica)""")
def registry_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = RG.checked_registry(RG.active_registry(registry(spark, sf_dir)), routes(spark))
    return checked.select("extract_name", "replica", "scenario", "prefix", "reject_reason")


@query("registry_published", f"""
    SELECT extract_name, scenario, prefix FROM ({ACTIVE_SQL}) a JOIN {ROUTES_SQL} USING (replica) WHERE sql_from <> ''""")
def registry_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return RG.valid_registry(RG.active_registry(registry(spark, sf_dir)), routes(spark)).select("extract_name", "scenario", "prefix")


@query("registry_described", f"""
    WITH c AS (SELECT DISTINCT 'db' || (user_id % 2) AS db_name, 'x' || user_id || '_click' AS extract_name, 'comment ' || user_id AS comment FROM events)
    SELECT db_name, extract_name, coalesce(nullif(description, ''), comment, '') AS description FROM ({ACTIVE_SQL}) a LEFT JOIN c USING (db_name, extract_name)""")
def registry_described(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    comments = table(spark, sf_dir, "events").select(
        F.concat(F.lit("db"), (F.col("user_id") % 2).cast("string")).alias("db_name"), F.concat(F.lit("x"), user, F.lit("_click")).alias("extract_name"),
        F.concat(F.lit("comment "), user).alias("comment")).distinct()
    return RG.described(RG.active_registry(registry(spark, sf_dir)), comments).select("db_name", "extract_name", "description")


@query("param_merge", f"""
    SELECT event_id, CASE WHEN {KEY_SQL} % 3 = 0 THEN CAST({KEY_SQL} AS VARCHAR) ELSE '60' END AS increment,
           CASE WHEN {KEY_SQL} % 5 = 0 THEN 'INC' WHEN {KEY_SQL} % 5 = 2 THEN 'APPEND' ELSE 'FULL_UK' END AS strategy,
           'extract_time' AS time_field, CASE WHEN {KEY_SQL} % 4 = 1 THEN '0' ELSE '1' END AS auto_confirm FROM events""")
def param_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    ev = dealt(spark, sf_dir, "events", "event_id", "props").select("event_id", key_of_props().alias("k"))
    own = F.to_json(F.struct(F.when(k % 3 == 0, k).alias("increment"), F.when(k % 5 == 0, "INC").alias("strategy"),
                             F.when(k % 4 == 1, 0).alias("auto_confirm")))
    run = F.to_json(F.struct(F.when(k % 5 == 2, "APPEND").when(k % 5 == 3, "None").when(k % 5 == 4, "").alias("strategy"), F.lit("").alias("increment")))
    return ev.select("event_id", RG.merged_params(own, run).alias("p")).select("event_id", "p.increment", "p.strategy", "p.time_field", "p.auto_confirm")


@query("param_fallback", """
    WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'default' WHEN c_custkey % 3 = 1 THEN 'DEFAULT' ELSE c_mktsegment END AS compression_type,
                      CASE WHEN c_custkey % 4 = 0 THEN 'default' ELSE c_custkey || ' MB' END AS max_file_size, c_nationkey AS selfrun_timeout FROM customer),
    d AS (SELECT n_name AS dt, n_regionkey || ' GB' AS dm FROM nation WHERE n_nationkey = 7)
    SELECT CAST(c_custkey AS VARCHAR) AS extract_name, selfrun_timeout, CASE WHEN lower(compression_type) <> 'default' THEN compression_type ELSE dt END AS compression_type,
           CASE WHEN lower(max_file_size) <> 'default' THEN max_file_size ELSE dm END AS max_file_size FROM p, d""")
def param_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    own = table(spark, sf_dir, "customer").select(
        key.cast("string").alias("extract_name"), F.when(key % 3 == 0, "default").when(key % 3 == 1, "DEFAULT").otherwise(F.col("c_mktsegment")).alias("compression_type"),
        F.when(key % 4 == 0, "default").otherwise(F.concat(key.cast("string"), F.lit(" MB"))).alias("max_file_size"), F.col("c_nationkey").alias("selfrun_timeout"))
    spare = table(spark, sf_dir, "nation").where("n_nationkey = 7").select(
        F.lit("default").alias("extract_name"), F.col("n_name").alias("compression_type"),
        F.concat(F.col("n_regionkey").cast("string"), F.lit(" GB")).alias("max_file_size"), F.lit(0).alias("selfrun_timeout"))
    return RG.with_fallback(own.unionByName(spare), shared=["compression_type", "max_file_size"], own=["selfrun_timeout"])


@query("param_priority", """
    WITH c AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS priority, event_type FROM events)
    SELECT user_id, max(CASE WHEN priority = 1 THEN event_type END) AS own_value,
           arg_min(event_type, priority) FILTER (WHERE lower(event_type) <> 'view') AS shared_value FROM c GROUP BY user_id""")
def param_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_id").alias("first_id"))
    rows = table(spark, sf_dir, "events").join(first, "user_id").select(
        "user_id", F.when(F.col("event_id") == F.col("first_id"), F.lit(1).cast("bigint")).otherwise(F.col("event_id") + 2).alias("priority"),
        F.col("event_type").alias("own_value"), F.when(F.col("event_type") == "view", "default").otherwise(F.col("event_type")).alias("shared_value"))
    return RG.fallback_by_priority(rows, "user_id", "priority", ["shared_value"], ["own_value"])


@query("column_split", """
    WITH s AS (SELECT p_partkey, string_split(p_name, ' ') || [p_brand, 'id'] AS u, CASE WHEN p_size % 4 <> 0 THEN ['id', p_brand, p_type] END AS l, ['id', p_type, p_brand] AS e FROM part)
    SELECT p_partkey, array_to_string([c FOR c IN u IF (l IS NULL OR list_contains(l, c)) AND list_contains(e, c)], ',') AS common,
           array_to_string([c FOR c IN u IF NOT ((l IS NULL OR list_contains(l, c)) AND list_contains(e, c))], ',') AS update_extra,
           array_to_string([c FOR c IN e IF NOT ((l IS NULL OR list_contains(l, c)) AND list_contains(u, c))], ',') AS export_extra FROM s""")
def column_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    split = RG.column_split(
        F.concat(F.split("p_name", " "), F.array("p_brand", F.lit("id"))),
        F.when(F.col("p_size") % 4 != 0, F.array(F.lit("id"), "p_brand", "p_type")), F.array(F.lit("id"), "p_type", "p_brand"))
    return part.select("p_partkey", split.alias("s")).select(
        "p_partkey", *[F.array_join(f"s.{c}", ",").alias(c) for c in ("common", "update_extra", "export_extra")])


@query("route_lookup", """
    SELECT s_suppkey, 'flow' || (s_nationkey % 4) AS flow, CASE WHEN s_nationkey % 4 < 3 THEN 'SC-' || (s_nationkey % 4) END AS scenario FROM supplier""")
def route_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.concat(F.lit("a__b__flow"), (F.col("s_nationkey") % 4).cast("string"), F.lit("__t")).alias("name_file"))
    known = spark.createDataFrame([(f"flow{i}", f"SC-{i}", env) for i in range(3) for env in ("prom",)] + [("flow3", "SC-3", "dev")], "flow string, scenario string, environment string")
    return RG.routed(files, known, "prom").select("s_suppkey", "flow", "scenario")


@query("export_join", f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders t1 LEFT JOIN customer t2 ON t1.o_custkey = t2.c_custkey AND t1.o_orderkey % 2 = t2.c_nationkey % 2
    WHERE TIMESTAMP '{LO}' < o_orderdate AND o_orderdate <= TIMESTAMP '{HI}' AND c_mktsegment IS DISTINCT FROM 'MACHINERY'""")
def export_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders", "customer")
    spec = {"from": "orders t1", "fields": ["t1.*"],
            "joins": "LEFT JOIN customer t2 ON t1.o_custkey = t2.c_custkey AND t1.o_orderkey % 2 = t2.c_nationkey % 2",
            "where": "{condition} AND c_mktsegment IS DISTINCT FROM 'MACHINERY'"}
    return EX.read_spec(spark, spec, "o_orderdate", LO, HI)


@query("export_cte", f"""
    WITH cte AS (SELECT o_custkey, max(o_orderdate) AS updated_at, count(*) AS n_orders FROM orders GROUP BY o_custkey)
    SELECT * FROM cte WHERE TIMESTAMP '{LO}' < updated_at AND updated_at <= TIMESTAMP '1999-06-30 00:00:00'""")
def export_cte(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders")
    spec = {"with": "WITH cte AS (SELECT o_custkey, max(o_orderdate) AS updated_at, count(*) AS n_orders FROM orders GROUP BY o_custkey)",
            "from": "cte", "where": "{condition}", "settings": "max_threads=2"}
    return EX.read_spec(spark, spec, "updated_at", LO, "1999-06-30 00:00:00")


@query("export_staged", f"""
    SELECT CAST(floor(o_totalprice) AS BIGINT) % 7 AS bucket, o_orderkey, o_custkey FROM orders WHERE TIMESTAMP '{LO}' < o_orderdate AND o_orderdate <= TIMESTAMP '{HI}' AND o_orderstatus = 'O'""")
def export_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    views(spark, sf_dir, "orders")
    stages = {
        "update_exp": {"from": "orders", "extra_columns": ["o_orderdate", "o_orderstatus", "CAST(floor(o_totalprice) AS BIGINT) % 7 AS bucket"]},
        "load_delta": {"from": "staged_update_exp", "extra_columns": ["o_orderstatus", "bucket"], "where": "{condition}"},
        "export_delta": {"from": "staged_load_delta", "extra_columns": ["bucket"], "where": "o_orderstatus = 'O'"},
    }
    return EX.staged(spark, ["o_orderkey", "o_custkey"], stages, "o_orderdate", LO, HI, "staged")


@query("row_cap", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100")
def row_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EX.sampled(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "UAT", 100, ["o_orderkey"])


SCHEMA_COUNTS = ", ".join(f"count({c}) AS {c}" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"))


@query("schema_descriptor", f"""
    WITH d AS (SELECT column_name, CASE column_type WHEN 'INTEGER' THEN 'INT' WHEN 'VARCHAR' THEN 'STRING' ELSE column_type END AS source_type FROM (DESCRIBE lineitem)),
    n AS (UNPIVOT (SELECT {SCHEMA_COUNTS} FROM lineitem) ON COLUMNS(*) INTO NAME column_name VALUE n_values)
    SELECT column_name, source_type, CAST(NULL AS INTEGER) AS length, n_values FROM d LEFT JOIN n USING (column_name)
    UNION ALL VALUES ('export_time', 'TIMESTAMP', NULL, NULL), ('ctl_action', 'VARCHAR', 10, NULL), ('ctl_validfrom', 'TIMESTAMP', NULL, NULL)""")
def schema_descriptor(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "lineitem")
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "n_values")
    return SC.descriptor(df).join(counts, "column_name", "left").select("column_name", "source_type", "length", "n_values")


@query("reserved_columns", """
    SELECT * FROM (VALUES ('export_time', 'TIMESTAMP', NULL, NULL), ('order_', 'INT', NULL, 1), ('user_', 'BIGINT', 'Calculated: o_custkey + 1', 2), ('price', 'DOUBLE', 'total price', 3),
        ('ctl_action', 'VARCHAR', NULL, NULL), ('ctl_validfrom', 'TIMESTAMP', NULL, NULL)) d(column_name, source_type, description, place)
    LEFT JOIN (SELECT 1 AS place, count(*) AS n_values FROM orders UNION ALL SELECT 2, count(o_custkey) FROM orders UNION ALL SELECT 3, count(o_totalprice) FROM orders) USING (place)""")
def reserved_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns named as the receiver's words get another name in data and descriptor; computed columns say how."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("int").alias("order"), (F.col("o_custkey") + 1).cast("bigint").alias("user"), F.col("o_totalprice").cast("double").alias("price"))
    words = ["ORDER", "user", "table"]
    sent = SC.renamed(orders, words)
    comments = spark.createDataFrame([("price", "total price")], "column_name string, comment string")
    columns = SC.descriptor(orders, comments, words, {"user": "o_custkey + 1"})
    counts = sent.agg(*[F.count(c).alias(c) for c in sent.columns]).unpivot([], sent.columns, "column_name", "n_values")
    places = spark.createDataFrame([(c, i) for i, c in enumerate(sent.columns, 1)], "column_name string, place int")
    return columns.select("column_name", "source_type", "description").join(counts, "column_name", "left").join(places, "column_name", "left")


@query("gate_switches", """
    SELECT CAST(c_custkey AS VARCHAR) AS extract_name, c_custkey % 3 = 0 AS is_active, c_custkey % 5 = 0 AS optimize_exp_table, c_custkey % 4 <> 1 AND c_nationkey > 10 AS auto_confirm_delta FROM customer""")
def gate_switches(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return RG.gated(table(spark, sf_dir, "customer").select(
        key.cast("string").alias("extract_name"), F.when(key % 3 == 0, True).alias("is_active"), (key % 5 == 0).alias("optimize_exp_table"),
        F.when(key % 4 != 1, F.col("c_nationkey") > 10).alias("auto_confirm_delta")))


@query("sent_names", "SELECT o_orderkey, 'a' || o_orderkey || '_' || o_custkey || ',' || 'b' || o_orderkey || '_1' AS names FROM orders")
def sent_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, n = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    pairs = F.array(*[F.array(F.concat(F.lit(x), key), F.concat(F.lit(x), key, F.lit("_"), counted)) for x, counted in (("a", n), ("b", F.lit("1")))])
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(PA.sent_names(pairs), ",").alias("names"))


@query("history_append", """
    WITH h AS (SELECT 'x' || user_id AS extract_name, max(ts) AS extract_time, count(*) AS extract_count FROM events GROUP BY 1)
    SELECT extract_name, count(*) AS n_rows, max(extract_time) AS extract_time, CAST(sum(extract_count) AS BIGINT) AS extract_count, count(confirmed) AS n_confirmed
    FROM (SELECT *, NULL AS confirmed FROM h UNION ALL SELECT *, 1 FROM h) GROUP BY 1""")
def history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state log of all users, appended to in two steps: sent rows, then their confirmed copies."""
    path = run_folder(spark, "history")
    sent = table(spark, sf_dir, "events").groupBy(F.concat(F.lit("x"), F.col("user_id").cast("string")).alias("extract_name")).agg(
        F.max("ts").cast("timestamp_ntz").alias("extract_time"), F.count("*").alias("extract_count"))
    given = sent.withColumn("sent", F.col("extract_time"))
    ST.append_history(given.select(*[(F.col(f.name) if f.name in given.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ST.HISTORY]), path)
    ST.append_history(ST.auto_confirm(spark.read.schema(ST.HISTORY).parquet(path), VALID), path)
    back = spark.read.schema(ST.HISTORY).parquet(path)
    return back.groupBy("extract_name").agg(F.count("*").alias("n_rows"), F.max("extract_time").alias("extract_time"), F.sum("extract_count").alias("extract_count"), F.count("confirmed").alias("n_confirmed"))


RUN_STATES_SQL = f"""
    WITH h AS (SELECT *, {KEY_SQL} AS k, 'x' || user_id AS name FROM events), m AS (SELECT max(ts) AS now FROM events),
    x AS (SELECT DISTINCT name, user_id, user_id % 7 <> 3 AS active, user_id % 3 = 0 AS gate, user_id % 5 = 0 AS auto FROM h UNION ALL SELECT 'y' || user_id, user_id, true, true, false FROM h GROUP BY user_id),
    l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ts DESC) AS rn FROM h) WHERE rn = 1),
    s AS (SELECT x.name, active, gate, ts, CASE WHEN NOT active THEN 'inactive' WHEN ts IS NULL THEN 'new' WHEN event_type = 'purchase' THEN 'confirmed' WHEN auto OR event_type = 'view' OR k % 5 = 0 THEN 'skipped'
            WHEN gate THEN 'auto' WHEN event_type = 'click' AND k <= 60 AND ts + to_minutes(k) <= now THEN CASE WHEN event_id % 3 = 0 THEN 'failed' ELSE 'received' END
            WHEN ts + INTERVAL 60 MINUTE <= now THEN 'timeout' ELSE 'waiting' END AS state FROM x LEFT JOIN l USING (name), m),
    o AS (SELECT name, count(*) AS n FROM h WHERE event_type NOT IN ('view', 'purchase') GROUP BY name)
    SELECT name AS extract_name, state, state IN ('new', 'confirmed', 'skipped', 'auto', 'received') AS may_run, ts AS extract_time,
        CASE WHEN active AND gate THEN coalesce(n, 0) WHEN state = 'received' THEN 1 ELSE 0 END AS n_confirmed FROM s LEFT JOIN o USING (name)"""


@query("run_states", RUN_STATES_SQL)
def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every extract over a log of all events as windows, and the windows that are confirmed because of it."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_type", key_of_props().alias("k"))
    name, kind, user = F.concat(F.lit("x"), F.col("user_id").cast("string")), F.col("event_type"), F.col("user_id")
    given = ev.select(name.alias("extract_name"), F.col("ts").alias("extract_time"), F.col("ts").alias("time_to"), (F.col("k") % 5).cast("bigint").alias("extract_count"), F.when(kind != "view", F.col("ts")).alias("sent"), kind.alias("kind"))
    log = given.unionByName(given.where("kind = 'purchase'").withColumn("confirmed", F.col("sent") + T.seconds(60)), allowMissingColumns=True)
    history = log.select(*[(F.col(f.name) if f.name in log.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in ST.HISTORY])
    receipts = ev.where("event_type = 'click'").select(
        name.alias("extract_name"), F.col("ts").alias("extract_time"), (F.col("ts") + T.seconds(F.col("k") * 60)).alias("received_at"), F.when(F.col("event_id") % 3 == 0, 104).otherwise(0).alias("code"))
    users = ev.select("user_id").distinct()
    switches = lambda prefix, active, gate, auto: users.select(
        F.concat(F.lit(prefix), user.cast("string")).alias("extract_name"), active.alias("is_active"), gate.alias("auto_confirm_delta"), auto.alias("auto_confirm"), F.lit(True).alias("notify"), F.lit(60).alias("confirm_timeout"))
    extracts = switches("x", user % 7 != 3, user % 3 == 0, user % 5 == 0).unionByName(switches("y", F.lit(True), F.lit(True), F.lit(False)))
    now = newest(ev, "ts")
    states = stored(ST.run_states(extracts, history, receipts, now), "run-states")
    copies = ST.confirmed_copies(history, states, now).groupBy("extract_name").agg(F.count("*").alias("n_confirmed"))
    return states.join(copies, "extract_name", "left").select("extract_name", "state", "may_run", "extract_time", F.coalesce("n_confirmed", F.lit(0)).cast("bigint").alias("n_confirmed"))


RULES = [(r"[\t\r\n]+", " "), (r"[0-9]{3,}", "#"), (r'"', "'"), (r" {2,}", " ")]


@query("sanitize_text", r"""
    SELECT doc_id, lang, source, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[\t\r\n]+', ' ', 'g'), '[0-9]{3,}', '#', 'g'), '"', '''', 'g'), ' {2,}', ' ', 'g')) AS text_md5
    FROM documents""")
def sanitize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dealt(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return X.sanitize_frame(docs, RULES, columns=["text"]).select("doc_id", "lang", "source", F.md5("text").alias("text_md5"))


@query("array_format", """
    WITH e AS (SELECT vec_id, [CAST(floor(CAST(x AS DOUBLE) * 1000) AS INTEGER) FOR x IN embedding] AS a FROM embeddings)
    SELECT vec_id, '{' || array_to_string(a, ',') || '}' AS pg, '[' || array_to_string(a, ',') || ']' AS ch FROM e""")
def array_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000).cast("int"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", ints.alias("a"))
    return rows.select("vec_id", X.array_text(F.col("a"), "int", "pg").alias("pg"), X.array_text(F.col("a"), "int", "ch").alias("ch"))


@query("text_array_format", r"""
    WITH w AS (SELECT doc_id, string_split(text, ' ') AS a FROM documents)
    SELECT doc_id, md5('{' || array_to_string([CASE WHEN x = '' OR upper(x) = 'NULL' OR regexp_matches(x, '[{}",\\\s]') THEN '"' || regexp_replace(x, '(["\\])', '\\\1', 'g') || '"' ELSE x END FOR x IN a], ',') || '}') AS pg_md5 FROM w""")
def text_array_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dealt(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.split("text", " ").alias("a"))
    return docs.select("doc_id", F.md5(X.array_text(F.col("a"), "string", "pg")).alias("pg_md5"))


PART_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]
PART_BYTES = 200_000
PART_HEAD = len("\t".join(PART_ORDER)) + 1
PARTS_SQL = f"""
    WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, 6 + length(l_orderkey || '') + length(l_partkey || '') + length(l_suppkey || '') + length(l_linenumber || '') + length(l_returnflag) + length(l_linestatus) AS row_size FROM lineitem),
    c AS (SELECT row_size, sum(row_size) OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus ROWS UNBOUNDED PRECEDING) AS upto, max(row_size) OVER () AS widest FROM s),
    p AS (SELECT CAST(floor((upto - row_size) / ({PART_BYTES} - {PART_HEAD} - widest)) AS BIGINT) AS part_no, count(*) AS n_rows, sum(row_size) + {PART_HEAD} AS n_bytes FROM c GROUP BY 1),
    m AS (SELECT part_no, dense_rank() OVER (ORDER BY part_no) AS part_index, count(*) OVER () AS part_total, n_rows, CAST(n_bytes AS BIGINT) AS n_bytes FROM p)"""


def lineitem_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(*PART_ORDER)
    return PA.with_parts(rows, PART_ORDER, PART_BYTES, head=PA.head_bytes(PART_ORDER))


def lineitem_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PA.named_manifest(lineitem_parts(spark, sf_dir), "Sales", "LineItem", "repl", "20240101000000", head=PA.head_bytes(PART_ORDER))


@query("part_manifest", PARTS_SQL + """
    SELECT part_no, part_index, part_total, n_rows, n_bytes, 'sales__lineitem__20240101000000__' || part_index || '_' || part_total || '_' || n_rows || '.csv' AS data_name,
           'repl__20240101000000__lineitem__' || part_index || '_' || part_total || '_' || n_rows || '.zip' AS archive_name FROM m""")
def part_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_manifest(spark, sf_dir).select("part_no", "part_index", "part_total", "n_rows", "n_bytes", "data_name", "archive_name")


@query("package_tickets", PARTS_SQL + """
    SELECT 'sales__lineitem__20240101000000__' || part_index || '_' || part_total || '_' || n_rows || '.csv;' || n_rows AS line, 'repl__20240101000000.tkt' AS ticket_name FROM m""")
def package_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PA.tickets(lineitem_manifest(spark, sf_dir)).select("line", "ticket_name")


@query("package_totals", PARTS_SQL + " SELECT CAST(sum(n_rows) AS BIGINT) AS total_rows, count(*) AS total_files FROM m")
def package_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return PA.package_totals(lineitem_manifest(spark, sf_dir))


@query("empty_package", """
    WITH w AS (SELECT max(o_orderdate) AS newest FROM orders), n AS (SELECT d.days, count(o_orderkey) AS n FROM w CROSS JOIN (VALUES (0), (400)) d(days) LEFT JOIN orders ON o_orderdate > newest - to_days(d.days) GROUP BY 1)
    SELECT days, CASE WHEN n = 0 THEN 'repl__20240101000000__orders__0_1_0.zip' ELSE 'repl__20240101000000__orders__1_1_' || n || '.zip' END AS archive_name, n AS n_rows FROM n""")
def empty_package(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packages of the orders since the newest one, which are none, and of the last 400 days."""
    orders = table(spark, sf_dir, "orders")
    last = T.moment(newest(orders, "o_orderdate"))
    out = None
    for days in (0, 400):
        parts = PA.with_parts(orders.where(F.col("o_orderdate") > last - F.make_dt_interval(F.lit(days))), ["o_orderkey"], 1 << 40)
        one = PA.package_manifest(parts, "sales", "orders", "repl", "20240101000000", True).select(F.lit(days).alias("days"), "archive_name", "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


NOTIFY_AT = "2024-01-01 10:20:30.123"
XML_SQL = """'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' || chr(10) || '<TransferFileCephRq>' || chr(10) || '    <RqUID>' || md5('repl__20240101000000|' || name) || '</RqUID>' || chr(10)
    || '    <RqTm>2024-01-01T10:20:30.123+00:00</RqTm>' || chr(10) || '    <ScenarioInfo>' || chr(10) || '        <ScenarioId>SC-1</ScenarioId>' || chr(10) || '    </ScenarioInfo>' || chr(10)
    || '    <File>' || chr(10) || '        <FileInfo>' || chr(10) || '            <Name>' || name || '</Name>' || chr(10) || '        </FileInfo>' || chr(10) || '    </File>' || chr(10) || '</TransferFileCephRq>'"""


@query("notify_xml", PARTS_SQL + f""", f AS (
        SELECT 0 AS position, 'repl__20240101000000.tkt' AS name UNION ALL
        SELECT part_index, 'repl__20240101000000__lineitem__' || part_index || '_' || part_total || '_' || n_rows || '.zip' FROM m)
    SELECT position, name, {XML_SQL} AS message FROM f""")
def notify_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = NO.package_files(lineitem_manifest(spark, sf_dir))
    return NO.notifications(files, "repl__20240101000000", "SC-1", NOTIFY_AT).select("position", "name", "message")


@query("package_names", """
    SELECT o_orderkey, 'out/x_' || o_orderkey || '_3_' || (o_custkey % 100) || '.csv.gz' AS listed, 'out/x_' || o_orderkey || '_' || (o_custkey % 100) || '.csv.gz' AS single,
           o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AND NOT contains(o_orderpriority, ' ') AND regexp_matches(o_orderpriority, '^[a-z0-9_-]+(\\.[a-z0-9]+)*$') AS name_ok FROM orders""")
def package_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lit("out/x_"), F.col("o_orderkey").cast("string"), F.lit(".csv.gz"))
    n = F.col("o_custkey") % 100
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", PA.counted_name(key, F.lit(3), n).alias("listed"), PA.counted_name(key, F.lit(3), n, listed=False).alias("single"),
        X.file_name_ok(F.col("o_orderpriority")).alias("name_ok"))
