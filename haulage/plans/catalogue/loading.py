"""Loadings: status history, monitor, launch, retry and workflow documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.functions import jsons as J, times as T
from haulage.operators import loadings as LD
from haulage.plans.catalogue.base import KEY_SQL, LOADINGS_SQL, NOW, STATUS_LOG_SQL, dealt, key_of_props, loadings, newest, query, status_log, table
from haulage.session import run_folder, spread
from haulage.sources import registry as RG

ACTION_SQL = f"""
    CASE WHEN status_sdt + INTERVAL 1 HOUR > {NOW} THEN 'New'
         WHEN status = 'RUNNING' AND log = '' THEN 'Skipped'
         WHEN status IN ('TIME-WAIT', 'EVENT-WAIT') AND running THEN 'Skipped'
         WHEN status IN ('PREREQ', 'PARAM', 'START') THEN 'reStarted'
         WHEN status = 'ERRORCHECK' THEN 'reRunned'
         WHEN status = 'ERROR' THEN CASE WHEN abort_on_failure THEN 'Aborted' ELSE 'Completed' END
         WHEN status = 'SUCCESS' THEN 'Completed'
         WHEN status = 'ABORTING' THEN CASE WHEN starts_with(log, 'SUCCESS') THEN 'SUCCESS' ELSE 'Aborted' END
         WHEN status IN ('LOCK-WAIT', 'LOCK') THEN CASE WHEN status_sdt + INTERVAL 5 HOUR <= {NOW} THEN 'reStarted' ELSE 'Skipped' END
         WHEN status = 'RUNNING' AND NOT starts_with(log, 'RUN') THEN 'reRunned'
         WHEN status = 'RUNNING' THEN CASE WHEN status_sdt + INTERVAL 6 HOUR <= {NOW} THEN 'reRunned' ELSE 'Skipped' END
         WHEN status = 'TIME-WAIT' THEN CASE WHEN starts_with(log, 'Start scheduled on ') THEN 'reStarted' ELSE 'Aborted' END
         WHEN status = 'EVENT-WAIT' THEN CASE WHEN k % 2 = 0 THEN 'reStarted' ELSE 'Skipped' END
         ELSE 'notFound' END"""
MONITOR_SQL = f"""
    SELECT lid, status, CASE WHEN a = 'Skipped' AND status_sdt + to_hours(CAST(6 + k AS INTEGER)) <= {NOW} THEN 'SLA' ELSE a END AS action
    FROM (SELECT *, {ACTION_SQL} AS a FROM ({LOADINGS_SQL})) WHERE alive = 'ACTIVE'"""


def monitored(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = newest(table(spark, sf_dir, "events"), "ts")
    return LD.monitor(loadings(spark, sf_dir), now, F.col("k") % 2 != 0, T.seconds((F.col("k") + 6) * 3600))


@query("monitor_action", f"SELECT lid, status, {ACTION_SQL} AS action FROM ({LOADINGS_SQL})")
def monitor_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = newest(table(spark, sf_dir, "events"), "ts")
    return loadings(spark, sf_dir).select("lid", "status", LD.monitor_action(now, F.col("k") % 2 != 0).alias("action"))


@query("sla_breach", MONITOR_SQL)
def sla_breach(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitored(spark, sf_dir).select("lid", "status", "action")


@query("action_histogram", f"SELECT action, status, count(*) AS n FROM ({MONITOR_SQL}) GROUP BY ALL")
def action_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    from haulage.operators.reports import histogram

    return histogram(monitored(spark, sf_dir), "action", "status")


@query("actionable", f"SELECT lid, action FROM ({MONITOR_SQL}) WHERE action NOT IN ('Skipped', 'New', 'notFound', 'SLA')")
def actionable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LD.actionable(monitored(spark, sf_dir)).select("lid", "action")


@query("launch_candidates", f"""
    WITH r AS (SELECT *, CASE WHEN alive <> 'ACTIVE' THEN 'not active' WHEN profile <> 'main' THEN 'not profile' WHEN lid = 0 THEN 'no id' WHEN wf_id = 0 THEN 'no wf_id'
        WHEN loading_id = 0 THEN 'no loading_id' WHEN status NOT IN ('RUNNING', 'TIME-WAIT', 'EVENT-WAIT') THEN 'not add status' WHEN status = 'RUNNING' AND log <> '' THEN 'already run' END AS reason FROM ({LOADINGS_SQL})),
    g AS (SELECT *, row_number() OVER (PARTITION BY wf_id ORDER BY lid) AS rn FROM r WHERE reason IS NULL),
    f AS (SELECT *, row_number() OVER (ORDER BY lid) AS no FROM g WHERE rn = 1), e AS (SELECT CASE WHEN count(*) >= 50 THEN max(lid) FILTER (no = 50) END AS full_at FROM f)
    SELECT r.lid, CASE WHEN reason IS NOT NULL THEN reason WHEN f.no <= 50 THEN NULL WHEN r.lid > full_at THEN 'limit 50 exceeded' ELSE 'wf already added' END AS reject_reason
    FROM r CROSS JOIN e LEFT JOIN (SELECT lid, no FROM f) f USING (lid)""")
def launch_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LD.launch_candidates(loadings(spark, sf_dir), "main", cap=50).select("lid", "reject_reason")


@query("stat_latest", f"""
    SELECT loading_id, max(effective_from) AS status_sdt, arg_max(status, effective_from) AS status FROM ({STATUS_LOG_SQL}) GROUP BY loading_id""")
def stat_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LD.status_now(status_log(spark, sf_dir))


@query("status_last", f"SELECT loading_id, status, max(effective_from) AS last_at FROM ({STATUS_LOG_SQL}) GROUP BY ALL")
def status_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LD.status_last(status_log(spark, sf_dir))


@query("status_history", f"SELECT DISTINCT loading_id, effective_from, status || ' ' || log AS entry FROM ({STATUS_LOG_SQL})")
def status_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LD.status_history(status_log(spark, sf_dir))


@query("run_type", f"""
    WITH f AS (SELECT loading_id, arg_min(status, effective_from) AS s FROM ({STATUS_LOG_SQL}) GROUP BY loading_id)
    SELECT loading_id, CASE WHEN loading_id % 9 = 0 THEN 'AF-EVENT' WHEN loading_id % 4 = 0 THEN 'MANUAL' WHEN s IN ('TIME-WAIT', 'EVENT-WAIT', 'MANUAL') THEN s ELSE 'NO-WAIT' END AS run_type FROM f""")
def run_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = status_log(spark, sf_dir)
    ident = F.col("loading_id")
    runs = log.select("loading_id").distinct().select(ident, (ident % 4 != 0).alias("auto"), F.when(ident % 9 == 0, "AF-EVENT").alias("given"))
    return LD.run_types(log, runs)


def documents_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a loading document with two statuses, some parameters and statistics."""
    at = T.clock_text(F.col("ts"))
    later = T.clock_text(F.col("ts") + T.seconds(F.col("k") * 60 + 60))
    rows = spread(loadings(spark, sf_dir).withColumnRenamed("status_sdt", "ts"))
    text = lambda c: F.col(c).cast("string")
    pair = lambda n, v: F.struct(F.lit(n).alias("param"), v.alias("value"))
    return rows.select(
        F.col("lid").alias("id"), "wf_id", "profile", "alive", (F.col("lid") % 4 != 0).alias("auto"), "status", F.col("log").alias("status_log"), at.alias("start_dttm"),
        F.array(pair("wf_b", text("k")), pair("other", F.lit("x")), pair("loading_id", text("lid")), pair("wf_b", F.concat(F.lit("v"), text("k")))).alias("params"),
        F.array(*[F.struct(F.col("lid").alias("loading_id"), F.lit("P").alias("profile"), F.col("wf_id").alias("entity_id"), F.lit(s).alias("stat_id"), v.alias("value"))
                  for s, v in ((2, F.lit("1")), (1, text("k")), (2, F.lit("0")))]).alias("stats"),
        F.array(F.struct(F.col("status").alias("status"), later.alias("effective_from"), F.col("log").alias("log")), F.struct(
            F.when(F.col("k") % 2 == 0, "TIME-WAIT").otherwise("START").alias("status"), at.alias("effective_from"), F.lit("first").alias("log"))).alias("loading_status"),
        F.struct(F.concat(F.lit("wf."), text("wf_id")).alias("name")).alias("workflow"))


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as JSON texts read back with the document schema."""
    return documents_of(spark, sf_dir).select(F.to_json(F.struct("*")).alias("doc")).select(F.from_json("doc", LD.LOADING).alias("d")).select("d.*")


NORM_SQL = f"""
    SELECT *, strftime(status_sdt, '%Y-%m-%d %H:%M:%S') AS at_first, strftime(status_sdt + to_minutes(CAST(k + 1 AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS later,
           CASE WHEN k % 2 = 0 THEN 'TIME-WAIT' ELSE 'START' END AS first_status FROM ({LOADINGS_SQL})"""


@query("loading_normalise", f"""
    SELECT lid AS id, 'wf.' || wf_id AS wf_name, 'loading_id=' || lid || ',wf_b=v' || k AS params, lid || '/P/' || wf_id || '/1=' || k || ',' || lid || '/P/' || wf_id || '/2=1' AS stats,
           CASE WHEN lid % 4 = 0 THEN 'MANUAL' WHEN k % 2 = 0 THEN 'TIME-WAIT' ELSE 'NO-WAIT' END AS run_type, later AS status_sdt,
           later || ' ' || status || ' ' || log || ',' || at_first || ' ' || first_status || ' first' AS history, CASE WHEN first_status = status THEN later ELSE at_first END AS first_at
    FROM ({NORM_SQL})""")
def loading_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    norm = LD.normalised(landed(spark, sf_dir))
    flat = lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    first = F.when(F.col("id").isNotNull(), F.element_at(F.col("history"), -1))
    return norm.select(
        "id", "wf_name", flat("params").alias("params"), flat("stats").alias("stats"), "run_type", "status_sdt",
        F.array_join(F.transform("history", lambda h: F.concat(h["effective_from"], F.lit(" "), h["text"])), ",").alias("history"),
        F.col("status_last")[F.split_part(first["text"], F.lit(" "), F.lit(1))].alias("first_at"))


@query("status_view", f"""
    SELECT lid, alive, status, CASE k % 5 WHEN 0 THEN '' WHEN 1 THEN 'RUN' WHEN 2 THEN 'TFS' WHEN 3 THEN 'Start' ELSE 'SUCCESS' END AS step,
           CASE k % 5 WHEN 1 THEN '{{"try": 1}}' ELSE '{{}}' END AS data, CASE k % 5 WHEN 2 THEN 'wait' WHEN 3 THEN 'scheduled on 2024-01-15 00:00:00' WHEN 4 THEN 'done' ELSE '' END AS msg,
           CASE WHEN status = 'START' THEN later WHEN first_status = 'START' THEN at_first ELSE '' END AS run_dttm FROM ({NORM_SQL})""")
def status_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return LD.status_view(LD.normalised(landed(spark, sf_dir))).select("lid", "alive", "status", "step", "data", "msg", "run_dttm")


@query("state_gate", f"""
    SELECT lid, CASE WHEN alive <> 'ACTIVE' THEN 'alive' WHEN status NOT IN ('RUNNING', 'TIME-WAIT', 'START') THEN 'status' WHEN k % 5 NOT IN (0, 1, 2) THEN 'step' WHEN k % 5 = 0 THEN 'log' END AS reason FROM ({LOADINGS_SQL})""")
def state_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = LD.status_view(LD.normalised(landed(spark, sf_dir)))
    return view.select("lid", LD.gate(["ACTIVE"], ["RUNNING", "TIME-WAIT", "START"], ["RUN", "TFS", ""], True).alias("reason"))


@query("loading_read", f"SELECT lid AS id, status FROM ({LOADINGS_SQL}) WHERE profile = 'main' AND status IN ('RUNNING', 'TIME-WAIT', 'EVENT-WAIT') AND status_sdt >= TIMESTAMP '2024-01-10 00:00:00'")
def loading_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "loading-docs")
    documents_of(spark, sf_dir).write.json(folder)
    return LD.loading_history(spark, folder, "main", ["RUNNING", "TIME-WAIT", "EVENT-WAIT"], "2024-01-10 00:00:00").select("id", "status")


RES_SQL = f"""
    SELECT event_id, {KEY_SQL} AS k, CASE {KEY_SQL} % 5 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN -1 WHEN 3 THEN -7 END AS res, user_id % 3 AS n_left, CASE WHEN {KEY_SQL} % 2 = 0 THEN 'no,-7' END AS on_text, user_id % 4 = 0 AS had_ok, event_id % 2 = 0 AS abort FROM events"""


@query("retry_outcome", f"""
    WITH r AS ({RES_SQL}), m AS (SELECT *, coalesce(res, -99) AS v FROM r), n AS (SELECT *, CASE WHEN v > 0 THEN 'ok' WHEN v = 0 THEN 'no' ELSE 'error' END AS res_msg FROM m),
    a AS (SELECT *, n_left > 0 AND (CASE WHEN on_text IS NULL THEN res_msg = 'error' ELSE res_msg = 'no' OR v = -7 END) AS again, v >= 0 OR had_ok AS good FROM n)
    SELECT event_id, res_msg, CASE WHEN again THEN 'ERRORCHECK' WHEN good THEN 'SUCCESS' ELSE 'ERROR' END AS status,
           CASE WHEN again THEN 'retry' WHEN good THEN 'Completed' WHEN abort THEN 'Aborted' ELSE 'Completed' END AS action, CAST(had_ok AS INTEGER) + CAST(v > 0 AS INTEGER) AS ok FROM a""")
def retry_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, user = F.col("k"), F.col("user_id")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", key_of_props().alias("k"))
    retry = F.struct(
        (user % 3).cast("int").alias("left"), F.when(k % 2 == 0, F.array(F.lit("no"), F.lit("-7"))).alias("on"),
        F.when(user % 4 == 0, 1).otherwise(0).alias("ok"), F.lit(0).alias("no"), F.lit(0).alias("err"))
    res = F.when(k % 5 == 0, 1).when(k % 5 == 1, 0).when(k % 5 == 2, -1).when(k % 5 == 3, -7)
    return ev.select("event_id", LD.outcome(res, retry, F.col("event_id") % 2 == 0).alias("o")).select("event_id", "o.res_msg", "o.status", "o.action", "o.ok")


@query("retry_next", f"""
    SELECT event_id, date_trunc('second', ts + to_minutes(CAST(5 + {KEY_SQL} AS INTEGER)) + to_seconds(CAST(90 * (user_id % 4) AS INTEGER)))::TIMESTAMP AS next_at FROM events""")
def retry_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    delay = F.concat(F.lit("minutes=+"), (key_of_props() + 5).cast("string"))
    return dealt(spark, sf_dir, "events", "event_id", "ts", "user_id", "props").select(
        "event_id", LD.next_retry(F.col("ts"), delay, F.lit("seconds=90"), (F.col("user_id") % 4 + 1).cast("int")).alias("next_at"))


@query("retry_config", f"""
    WITH e AS (SELECT event_id, {KEY_SQL} AS k, user_id FROM events)
    SELECT event_id, CASE WHEN k % 6 = 0 THEN 3 WHEN k % 6 = 1 THEN 4 WHEN k % 6 = 2 THEN 5 WHEN k % 6 = 3 OR user_id % 2 = 0 THEN 1 END AS try,
           CASE WHEN k % 6 = 0 THEN 2 WHEN k % 6 = 1 THEN 1 WHEN k % 6 = 2 THEN 7 WHEN k % 6 = 3 THEN 2 WHEN user_id % 2 = 0 THEN 4 END AS n_left,
           CASE WHEN k % 6 = 3 THEN 'minutes=5' WHEN k % 6 > 3 AND user_id % 2 = 0 THEN 'seconds=+30' END AS delay FROM e""")
def retry_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    ev = table(spark, sf_dir, "events").select("event_id", key_of_props().alias("k"), "user_id")
    none = F.lit(None).cast("string")
    fault = F.col("user_id") % 2 == 0
    config = LD.retry_config(
        F.when(k % 6 == 0, "{'try': 3, 'left': 2}"), F.when(k % 6 == 1, "{'try': 4, 'left': 1}"), F.when(k % 6 == 2, "RUN {'retry': {'try': 5, 'left': 7}, 'x': None}").otherwise("no dict"),
        F.lit("Error, no"), F.when(k % 6 == 3, 3), F.lit("minutes=5"), none, F.when(fault, 5).otherwise(1), F.when(fault, 30_500))
    return ev.select("event_id", config.alias("c")).select("event_id", F.col("c.try").alias("try"), F.col("c.left").alias("n_left"), F.col("c.delay").alias("delay"))


@query("stat_rows", f"""
    WITH e AS (SELECT event_id, user_id AS entity_id, {KEY_SQL} AS k FROM events)
    SELECT event_id, entity_id, 11 AS stat_id, '2024-02-01 00:00:00' AS value FROM e
    UNION ALL SELECT event_id, entity_id, 2, '1' FROM e WHERE k % 3 = 0 UNION ALL SELECT event_id, entity_id, 1, CAST(k AS VARCHAR) FROM e WHERE k % 3 = 0 AND k % 2 = 0
    UNION ALL SELECT event_id, entity_id, 56, '{{"dataBusiness":"d' || k || '"}}' FROM e WHERE k % 3 = 0 AND k % 5 = 0 UNION ALL SELECT event_id, entity_id, 55, '{{"dataBusiness":"d' || k || '"}}' FROM e WHERE k % 3 = 0 AND k % 5 = 0
    UNION ALL SELECT event_id, entity_id, 100 + k, 's' FROM e WHERE k % 4 = 0""")
def stat_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    text = k.cast("string")
    results = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("entity_id"), key_of_props().alias("k")).select(
        "event_id", "entity_id", F.when(k % 3 == 0, 1).when(k % 3 == 1, 0).alias("res"), F.when(k % 2 == 0, k).alias("cdc"),
        F.when(k % 5 == 0, F.concat(F.lit('{"dataBusiness":"d'), text, F.lit('"}'))).alias("hub"),
        F.when(k % 4 == 0, F.concat(F.lit('{"'), (k + 100).cast("string"), F.lit('":"s"}'))).alias("stat"))
    return LD.result_stats(results, "2024-02-01 00:00:00", "event_id")


@query("time_wait_due", f"""
    SELECT event_id, CAST({KEY_SQL} % 3 + 2 AS INTEGER) AS try, CAST(greatest({KEY_SQL} % 4 - 1, 0) AS INTEGER) AS n_left FROM events WHERE ts + INTERVAL 2 DAY <= {NOW}""")
def time_wait_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    waits = ev.select("event_id", (F.col("ts") + F.make_dt_interval(F.lit(2))).alias("time"), (key_of_props() % 3 + 1).alias("try"), (key_of_props() % 4).alias("left"))
    return LD.due_waits(waits, newest(ev, "ts")).select("event_id", "try", F.col("left").alias("n_left"))


@query("delayed_start", f"""
    SELECT event_id, CASE WHEN event_id % 2 = 0 AND {KEY_SQL} % 3 = 0 AND event_type = 'view' THEN date_trunc('second', ts + to_minutes({KEY_SQL}))::TIMESTAMP END AS start_at FROM events""")
def delayed_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = key_of_props()
    wait = F.when(k % 3 == 0, F.concat(F.lit("minutes="), k.cast("string")))
    kind = F.when(F.col("event_type") == "view", "EVENT-WAIT").otherwise("TIME-WAIT")
    return table(spark, sf_dir, "events").select("event_id", LD.delayed_start(F.col("event_id") % 2 == 0, wait, kind, F.col("ts")).alias("start_at"))


@query("recent_activity", f"SELECT lid, status_sdt FROM ({LOADINGS_SQL}) WHERE profile = 'other' AND status_sdt >= date_trunc('day', {NOW} - INTERVAL 7 DAY)")
def recent_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = newest(table(spark, sf_dir, "events"), "ts")
    return LD.recent_activity(loadings(spark, sf_dir), now, 7, "status_sdt", profile="other").select("lid", "status_sdt")


@query("schedule_tag", """
    SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN 'ARCHIVE' WHEN p_size % 2 = 0 AND p_partkey % 5 = 0 THEN 'AF_tfs-in' ELSE CASE WHEN p_size % 2 = 1 THEN 'CTL_' ELSE 'AF_' END
        || CASE WHEN p_size % 3 = 0 THEN 'event' WHEN p_size % 5 = 0 THEN 'time' WHEN p_size % 7 = 0 THEN 'condition' ELSE 'manual' END END AS tag FROM part""")
def schedule_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    tag = RG.schedule_tag(size % 2 == 1, F.col("p_type") == "SMALL", size % 3 == 0, size % 5 == 0, size % 7 == 0, F.col("p_partkey") % 5 == 0)
    return table(spark, sf_dir, "part").select("p_partkey", tag.alias("tag"))


@query("workflow_pick", "SELECT p_partkey, p_name FROM part WHERE p_partkey > 1500 OR p_partkey = 0 OR p_name IN ('small ring', 'red widget', 'no such')")
def workflow_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return RG.selected_workflows(rows, ["small ring", "red widget", "no such"], 1500).select(F.col("id").alias("p_partkey"), F.col("name").alias("p_name"))


@query("workflow_missing", "SELECT CAST(p_partkey AS VARCHAR) AS name FROM part WHERE p_size <= 45")
def workflow_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("name"), "p_size")
    return RG.missing_names(part.select("name"), part.where("p_size > 45").select("name"))


@query("workflow_normalise", """
    SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN array_to_string(list_sort(['P/' || s_suppkey || '/1=true', 'P/' || (s_suppkey + 1) || '/2=false']), ',') WHEN 1 THEN 'a/1/2=true,b/3/4=true' ELSE 'Q/5/6=true' END AS events,
           CASE WHEN s_suppkey % 2 = 0 THEN '3,' || (s_suppkey + 10) ELSE '1,2' END AS entities, 'm' || s_suppkey AS mail FROM supplier""")
def workflow_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    text = key.cast("string")
    event = lambda p, e, s, a: F.struct(F.lit(p).alias("profile"), e.alias("entity_id"), F.lit(s).alias("stat_id"), F.lit(a).cast("boolean").alias("active"))
    sched = F.when(key % 3 == 0, F.array(event("P", key, 1, None), event("P", key + 1, 2, False)))
    listed = F.when(key % 3 == 1, " a/1/2, b/3/4,").when(key % 3 == 2, "[{'profile': 'Q', 'entity_id': 5, 'stat_id': 6}]")
    param = lambda n, v: F.struct(F.lit(n).alias("param"), v.alias("prior_value"))
    docs = table(spark, sf_dir, "supplier").select(
        "s_suppkey", sched.alias("wf_event_sched"),
        F.array(param("wf_event_sched", listed), param("wf_entity", F.when(key % 2 == 0, F.concat((key + 10).cast("string"), F.lit(", 3,x,3"))))).alias("param"),
        F.array(F.struct(F.lit("ERROR").alias("status"), F.concat(F.lit("m"), text).alias("emails"))).alias("statusNotifications"),
        F.array(F.lit(2), F.lit(1), F.lit(2)).cast("array<bigint>").alias("connectedEntities"))
    norm = LD.workflow_normalised(docs)
    flat = F.array_join(F.transform(F.map_entries("events"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return norm.select("s_suppkey", flat.alias("events"), "entities", F.col("statusNotifications")["ERROR"].alias("mail"))


@query("log_parse", """
    SELECT event_id, 'S' || user_id AS step, '{"v": ' || user_id || ', "t": true}' AS data FROM events""")
def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    log = J.parse_log(F.concat(F.lit("S"), user, F.lit(" {'v': "), user, F.lit(", 't': True}")))
    return table(spark, sf_dir, "events").select("event_id", log["step"].alias("step"), log["data"].alias("data"))
