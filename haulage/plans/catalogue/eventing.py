"""Events, readiness, entities and trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.functions import text as X
from haulage.operators import events as EV, trees as TR
from haulage.plans.catalogue.base import KEY_SQL, LATEST_STATS_SQL, NOW, STATS_SQL, dealt, key_of_props, newest, query, stats, table


def text(name: str):
    return F.col(name).cast("string")


@query("event_group", f"""
    WITH e AS (SELECT event_id, user_id, ts, {KEY_SQL} AS k FROM events),
    k AS (SELECT 'P' || user_id % 3 || '/' || user_id || '/' || k % 4 AS event_key, 'P' || user_id % 3 AS prf, CAST(user_id AS VARCHAR) AS eid, CAST(k % 4 AS VARCHAR) AS sid, bool_or(k % 7 = 0) AS scheduled FROM e GROUP BY ALL),
    d AS (SELECT 'P' || user_id % 3 AS prf, CAST(user_id AS VARCHAR) AS eid, max(ts) AS updated_at FROM e WHERE event_id % 3 = 0 GROUP BY ALL)
    SELECT event_key, prf, eid, sid, scheduled, updated_at FROM k LEFT JOIN d USING (prf, eid)""")
def event_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", key_of_props().alias("k"))
    profile = F.concat(F.lit("P"), (F.col("user_id") % 3).cast("string"))
    key = F.concat_ws("/", profile, text("user_id"), (F.col("k") % 4).cast("string"))
    docs = ev.select(F.concat(F.lit('{"'), key, F.lit('": '), (F.col("k") % 7 == 0).cast("string"), F.lit(', "plain": true}')).alias("val"))
    datasets = ev.where("event_id % 3 = 0").select(F.concat_ws("/", F.lit("CTL"), profile, text("user_id"), F.lit("name")).alias("uri"), F.col("ts").alias("updated_at"))
    return EV.unnested_registry(docs).join(EV.latest_publications(datasets), ["prf", "eid"], "left").select("event_key", "prf", "eid", "sid", "scheduled", "updated_at")


@query("event_registry", f"SELECT 'P/' || user_id || '/' || {KEY_SQL} % 5 AS event_key, bool_and(event_id % 9 <> 0) AS scheduled FROM events GROUP BY 1")
def event_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        F.concat_ws("/", F.lit("P"), text("user_id"), (key_of_props() % 5).cast("string")).alias("event_key"), (F.col("event_id") % 9 != 0).alias("scheduled"))
    return EV.event_registry(rows)


PUB_KEY = "CASE WHEN loading_id <> 0 THEN loading_id || '/' || profile || '/' || entity_id || '/' || stat_id ELSE '0/' || profile || '/' || entity_id || '/dt=' || strftime(published_at, '%Y-%m-%d %H:%M:%S') END"
NEW_SQL = f"""
    SELECT {PUB_KEY} AS pub_key, profile AS prf, CAST(entity_id AS VARCHAR) AS eid, CAST(stat_id AS VARCHAR) AS sid, loading_id, value, published_at
    FROM ({LATEST_STATS_SQL}) l LEFT JOIN (SELECT profile AS p, entity_id AS e, max(published_at) - INTERVAL 4 DAY AS updated_at FROM ({STATS_SQL}) WHERE entity_id % 5 <> 0 GROUP BY ALL) u ON p = profile AND e = entity_id
    WHERE stat_id % 4 <> 0 AND profile <> 'P1' AND (updated_at IS NULL OR published_at >= updated_at - INTERVAL 1 MINUTE)
      AND {PUB_KEY} NOT IN (SELECT {PUB_KEY} FROM ({STATS_SQL}) WHERE minute(published_at) % 3 = 0)"""


def fresh_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = stats(spark, sf_dir)
    registry = values.select(
        F.concat_ws("/", "profile", text("entity_id"), text("stat_id")).alias("event_key"), F.col("profile").alias("prf"), text("entity_id").alias("eid"), text("stat_id").alias("sid"),
        (F.col("stat_id") % 4 == 0).alias("scheduled")).distinct()
    publications = values.where("entity_id % 5 <> 0").groupBy(F.col("profile").alias("prf"), text("entity_id").alias("eid")).agg(
        (F.max("published_at") - F.make_dt_interval(F.lit(4))).alias("updated_at"))
    sent = values.where(F.minute("published_at") % 3 == 0).select(
        EV.publication_key(F.col("loading_id"), F.col("profile"), F.col("entity_id"), F.col("stat_id"), F.col("published_at")).alias("pub_key"))
    return EV.new_events(registry, values, publications, sent, "P1")


@query("event_new", NEW_SQL)
def event_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fresh_events(spark, sf_dir).drop("event_key")


@query("event_cycle", f"""
    SELECT pub_key, prf || '/' || eid || '/' || sid AS event_key FROM ({NEW_SQL})""")
def event_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.cycle_events(fresh_events(spark, sf_dir), "c1").select("pub_key", "event_key")


PAYLOAD_SQL = f"""
    WITH n AS ({NEW_SQL})
    SELECT pub_key, loading_id || '/' || prf || '/' || eid || '/dt' AS name, strftime(published_at, '%Y-%m-%d %H:%M:%S') AS value FROM n
    UNION ALL SELECT pub_key, loading_id || '/' || prf || '/' || eid || '/url', 'http://h/#/loading/' || loading_id FROM n WHERE loading_id <> 0
    UNION ALL SELECT pub_key, '0/' || prf || '/' || eid || '/' || sid, value FROM n WHERE loading_id = 0
    UNION ALL SELECT pub_key, s.loading_id || '/' || s.profile || '/' || s.entity_id || '/' || s.stat_id, s.value FROM n JOIN ({STATS_SQL}) s ON s.loading_id = n.loading_id AND s.profile = prf AND CAST(s.entity_id AS VARCHAR) = eid WHERE n.loading_id <> 0"""


@query("event_payload", PAYLOAD_SQL)
def event_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.event_payload(fresh_events(spark, sf_dir), stats(spark, sf_dir), "http://h")


@query("event_payload_map", f"SELECT pub_key, string_agg(name || '=' || value, ';' ORDER BY name) AS payload FROM ({PAYLOAD_SQL}) GROUP BY pub_key")
def event_payload_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = EV.payload_map(EV.event_payload(fresh_events(spark, sf_dir), stats(spark, sf_dir), "http://h"))
    entries = F.sort_array(F.transform(F.map_entries("payload"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return maps.select("pub_key", F.array_join(entries, ";").alias("payload"))


# Each event waits for two statistics: its own one and one of the next user; the start lies some days back.
WAITS_SQL = f"""
    WITH e AS (SELECT event_id, user_id, ts - to_days(CAST({KEY_SQL} % 3 AS INTEGER)) AS start_at, {KEY_SQL} AS k, event_type FROM events)
    SELECT event_id AS loading_id, start_at, CASE WHEN event_id % 2 = 0 THEN 'and' ELSE 'or' END AS strategy, CASE event_type WHEN 'view' THEN 'EVENT-WAIT' WHEN 'click' THEN 'AF-EVENT' ELSE 'NO-WAIT' END AS run_type,
           'P' || user_id % 3 AS profile, user_id AS entity_id, k % 10 AS stat_id, k % 6 <> 0 AS active FROM e
    UNION ALL
    SELECT event_id, start_at, CASE WHEN event_id % 2 = 0 THEN 'and' ELSE 'or' END, CASE event_type WHEN 'view' THEN 'EVENT-WAIT' WHEN 'click' THEN 'AF-EVENT' ELSE 'NO-WAIT' END,
           'P' || (user_id + 1) % 3, user_id + 1, (k + 1) % 10, k % 5 <> 0 FROM e"""


def waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, user = F.col("k"), F.col("user_id")
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", key_of_props().alias("k"))

    def awaited(u, s, a):
        return F.struct(F.concat(F.lit("P"), (u % 3).cast("string")).alias("profile"), u.alias("entity_id"), s.alias("stat_id"), a.alias("active"))

    return ev.select(
        F.col("event_id").alias("loading_id"), (F.col("ts") - F.make_dt_interval(k % 3)).alias("start_at"), F.when(F.col("event_id") % 2 == 0, "and").otherwise("or").alias("strategy"),
        F.when(F.col("event_type") == "view", "EVENT-WAIT").when(F.col("event_type") == "click", "AF-EVENT").otherwise("NO-WAIT").alias("run_type"),
        F.inline(F.array(awaited(user, k % 10, k % 6 != 0), awaited(user + 1, (k + 1) % 10, k % 5 != 0))))


READY_SQL = f"""
    WITH j AS (SELECT w.loading_id, strategy, active, coalesce(published_at >= start_at, false) AS come, coalesce(published_at > {NOW} - INTERVAL 30 MINUTE, false) AS fresh
        FROM ({WAITS_SQL}) w LEFT JOIN ({LATEST_STATS_SQL}) l USING (profile, entity_id, stat_id)),
    g AS (SELECT loading_id, strategy, count(*) FILTER (active) AS n_active, count(*) FILTER (active AND come) AS n_ready, bool_or(active AND fresh) AS is_settling FROM j GROUP BY ALL)
    SELECT loading_id, n_active, n_ready, n_active > 0 AND NOT is_settling AND CASE strategy WHEN 'and' THEN n_ready = n_active ELSE n_ready > 0 END AS is_ready FROM g"""


def ready(spark: SparkSession, sf_dir: str, strategy: str) -> DataFrame:
    values = stats(spark, sf_dir)
    out = EV.readiness(waits(spark, sf_dir), values, newest(values, "published_at"))
    return out.where(F.col("strategy") == strategy).select("loading_id", "n_active", "n_ready", "is_ready")


@query("readiness_or", READY_SQL + " WHERE strategy = 'or'")
def readiness_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ready(spark, sf_dir, "or")


@query("readiness_and", READY_SQL + " WHERE strategy = 'and'")
def readiness_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ready(spark, sf_dir, "and")


@query("event_expiry", f"""
    WITH j AS (SELECT w.loading_id, strategy, run_type, active, published_at IS NULL OR published_at < date_trunc('day', start_at) AS stale
        FROM ({WAITS_SQL}) w LEFT JOIN ({LATEST_STATS_SQL}) l USING (profile, entity_id, stat_id)),
    g AS (SELECT loading_id, strategy, run_type, count(*) FILTER (active AND stale) AS n_stale, count(*) FILTER (active AND NOT stale) AS n_fresh FROM j GROUP BY ALL),
    v AS (SELECT *, CASE WHEN strategy <> 'and' OR run_type = 'NO-WAIT' OR n_stale = 0 THEN 'READY' WHEN n_fresh > 0 THEN 'EVENT-WAIT' ELSE 'ERROR' END AS verdict FROM g)
    SELECT loading_id, n_stale, n_fresh, verdict, CASE verdict WHEN 'ERROR' THEN -99 END AS res FROM v""")
def event_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return EV.expiry(waits(spark, sf_dir), stats(spark, sf_dir), "time=0:00")


@query("start_condition", """
    WITH c AS (SELECT c_custkey, c_acctbal > 2000 AS r FROM customer),
    t AS (SELECT o_orderkey, o_custkey % 3 AS m, coalesce(a.r, false) AS a, coalesce(b.r, false) AS b, coalesce(d.r, false) AS d FROM orders
        LEFT JOIN c a ON a.c_custkey = o_custkey LEFT JOIN c b ON b.c_custkey = o_custkey + 1 LEFT JOIN c d ON d.c_custkey = o_custkey + 2)
    SELECT o_orderkey AS tree_id, CASE m WHEN 0 THEN a AND (b OR d) WHEN 1 THEN a OR (b AND d) ELSE a OR (b OR d) END AS value FROM t""")
def start_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    mode = F.col("o_custkey") % 3

    def node(ident, parent, depth, op, shift):
        key = F.lit(None).cast("string") if shift is None else F.concat(F.lit("E"), (F.col("o_custkey") + shift).cast("string"))
        return F.struct(F.lit(ident).alias("node_id"), F.lit(parent).cast("int").alias("parent_id"), F.lit(depth).alias("depth"), op.alias("op"), key.alias("event_key"))

    leaf = F.lit("statVal")
    nodes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("tree_id"), F.inline(F.array(
        node(1, None, 0, F.when(mode == 0, "and").otherwise("or"), None), node(2, 1, 1, leaf, 0),
        node(3, 1, 1, F.when(mode == 1, "and").otherwise("or"), None), node(4, 3, 2, leaf, 1), node(5, 3, 2, leaf, 2))))
    known = table(spark, sf_dir, "customer").select(F.concat(F.lit("E"), text("c_custkey")).alias("event_key"), (F.col("c_acctbal") > 2000).alias("is_ready"))
    return TR.evaluate_conditions(nodes, known)


@query("trigger_fold", f"""
    WITH e AS (SELECT event_id, event_id // 10 AS run_id, 'CTL/P' || user_id % 3 || '/' || user_id AS uri, user_id, {KEY_SQL} AS k, strftime(ts, '%Y-%m-%d %H:%M:%S') AS dt FROM events),
    u AS (SELECT run_id, uri, max(CASE WHEN k % 4 % 2 = 0 THEN event_id || '/P' || user_id % 3 || '/' || user_id || '/' || k % 4 END) AS event_name, max(dt) AS dt, max('src' || event_id) AS source_run,
        max(CASE WHEN k % 10 = 0 THEN 'AF-TFS' END) AS t FROM e GROUP BY ALL)
    SELECT run_id, uri, event_name, dt, source_run, max(dt) OVER (PARTITION BY run_id) AS af_sdt, coalesce(max(t) OVER (PARTITION BY run_id), 'AF-EVENT') AS run_type FROM u""")
def trigger_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = dealt(spark, sf_dir, "events", "event_id", "user_id", "ts", "props").select("event_id", "user_id", "ts", key_of_props().alias("k"))
    entity = F.concat_ws("/", F.concat(F.lit("P"), (F.col("user_id") % 3).cast("string")), text("user_id"))
    ind = F.concat_ws("/", text("event_id"), entity)
    extra = F.concat(
        F.lit('{"'), ind, F.lit('/dt": "'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit('", "'), ind, F.lit("/"), (F.col("k") % 4).cast("string"), F.lit('": "v"'),
        F.when(F.col("k") % 10 == 0, ', "wfp_run_type": "AF-TFS"').otherwise(""), F.lit("}"))
    fired = ev.select(F.floor(F.col("event_id") / 10).alias("run_id"), F.concat(F.lit("CTL/"), entity).alias("uri"), F.concat(F.lit("src"), text("event_id")).alias("source_run"), extra.alias("extra"))
    awaited = ev.where(F.col("k") % 4 % 2 == 0).select(F.concat_ws("/", entity, (F.col("k") % 4).cast("string")).alias("event_key"))
    return EV.trigger_fold(fired, awaited)


@query("entity_names", r"""
    WITH n AS (SELECT l.doc_id AS entity_id, coalesce(d.name, '_Not_found_') AS name FROM labels l LEFT JOIN (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'été#é ' ELSE source || '#' || text END AS name FROM documents WHERE doc_id % 5 <> 0) d USING (doc_id)),
    s AS (SELECT entity_id, regexp_replace(regexp_replace(string_split(name, '#')[-1], '[^\x00-\x7F]', '', 'g'), '^\s+|\s+$', '', 'g') AS name FROM n)
    SELECT entity_id, CASE WHEN name = '' THEN CAST(entity_id AS VARCHAR) ELSE name END AS name FROM s""")
def entity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").where("doc_id % 5 <> 0").select(
        F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 7 == 0, "été#é ").otherwise(F.concat("source", F.lit("#"), "text")).alias("name"))
    return EV.entity_names(table(spark, sf_dir, "labels").select(F.col("doc_id").alias("entity_id")), docs)


@query("entity_sets", """
    WITH c AS (SELECT c_custkey, list_sort(list_distinct([c_custkey, c_nationkey, 7])) AS s FROM customer) SELECT c_custkey, array_to_string(s, ',') AS entities FROM c""")
def entity_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.concat(text("c_custkey"), F.lit(" , x9,,"), text("c_nationkey"), F.lit(",-3, 7,7"))
    return table(spark, sf_dir, "customer").select("c_custkey", X.digit_set(raw).alias("entities"))


@query("entity_ids", """
    SELECT DISTINCT id FROM (SELECT n_nationkey AS id FROM nation UNION ALL SELECT n_regionkey FROM nation UNION ALL SELECT user_id FROM events
        UNION ALL SELECT c_nationkey + 5000 FROM customer WHERE c_custkey IN (SELECT user_id FROM events)) WHERE id > 0""")
def entity_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_regionkey").cast("bigint").alias("parent_id"))
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_nationkey") + 5000).cast("bigint").alias("parent_id"))
    return EV.all_entity_ids(nations, table(spark, sf_dir, "events").select(F.col("user_id").alias("entity_id")), known)


@query("category_tree", """
    SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, CAST(0 AS BIGINT) AS parent_id, r_name AS name, NULL AS parent_name, 0 AS depth FROM region WHERE r_name = 'ASIA'
    UNION ALL SELECT n_nationkey + 100, n_regionkey + 1, n_name, r_name, 1 FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'
    UNION ALL SELECT c_custkey + 1000, c_nationkey + 100, c_name, n_name, 2 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""")
def category_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    def nodes(name, ident, parent, label):
        return table(spark, sf_dir, name).select(ident.cast("bigint").alias("id"), parent.cast("bigint").alias("parent_id"), F.col(label).alias("name"))

    tree = nodes("customer", F.col("c_custkey") + 1000, F.col("c_nationkey") + 100, "c_name").unionByName(
        nodes("nation", F.col("n_nationkey") + 100, F.col("n_regionkey") + 1, "n_name")).unionByName(nodes("region", F.col("r_regionkey") + 1, F.lit(0), "r_name"))
    return TR.subtree(tree, "ASIA")


@query("entity_flatten", """
    SELECT o_orderkey * 10 AS id, NULL AS parent_id, o_orderstatus AS name FROM orders UNION ALL SELECT o_orderkey * 10 + 1, o_orderkey * 10, 'kid' FROM orders
    UNION ALL SELECT o_orderkey * 10 + 2, o_orderkey * 10, 'leaf' FROM orders UNION ALL SELECT o_orderkey * 10 + 3, o_orderkey * 10 + 1, o_orderpriority FROM orders""")
def entity_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey") * 10

    def entity(ident, parent, name):
        return F.struct(ident.alias("id"), parent.cast("bigint").alias("parentId"), name.alias("name")).alias("entity")

    none = F.lit(None)
    grandchild = F.struct(entity(key + 3, key + 1, F.col("o_orderpriority")), F.array().cast("array<string>").alias("kidz"))
    child = F.struct(entity(key + 1, key, F.lit("kid")), F.array(grandchild).alias("kidz"))
    leaf = F.struct(entity(key + 2, key, F.lit("leaf")), F.filter(F.array(grandchild), lambda g: F.lit(False)).alias("kidz"))
    root = F.struct(entity(key, none, F.col("o_orderstatus")), F.array(child, leaf).alias("kidz"))
    return TR.flatten_entities(dealt(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority").select(F.to_json(root).alias("tree")))


@query("event_published", f"""
    SELECT pub_key, max(ts) AS published_at FROM (
        SELECT event_id || '/P/' || user_id || '/' || {KEY_SQL} % 5 AS pub_key, ts FROM events WHERE user_id % 4 <> 0 AND event_id % 2 = 0 AND event_id > 0
        UNION ALL SELECT '0/P/' || user_id || '/dt=' || strftime(ts, '%Y-%m-%d %H'), ts FROM events WHERE user_id % 4 <> 0 AND event_id % 2 = 1) GROUP BY pub_key""")
def event_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", key_of_props().alias("k"))
    ind = F.concat_ws("/", F.when(F.col("event_id") % 2 == 0, text("event_id")).otherwise("0"), F.lit("P"), text("user_id"))
    entry = F.when(F.col("event_id") % 2 == 0, F.concat(ind, F.lit("/"), (F.col("k") % 5).cast("string"))).otherwise(F.concat(ind, F.lit("/dt")))
    extra = F.concat(F.lit('{"'), entry, F.lit('": "'), F.date_format("ts", "yyyy-MM-dd HH"), F.lit('", "'), ind, F.lit('/url": "u"}'))
    log = ev.select(F.col("user_id").alias("dataset_id"), extra.alias("extra"), F.col("ts").alias("at"))
    datasets = ev.select(F.col("user_id").alias("id"), F.concat(F.when(F.col("user_id") % 4 == 0, "TFS/").otherwise("CTL/"), text("user_id")).alias("uri")).distinct()
    return EV.published_keys(log, datasets).withColumnRenamed("at", "published_at")
