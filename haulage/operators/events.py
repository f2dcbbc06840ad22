"""Events: registry, new statistics, publication and readiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from haulage.functions import jsons as J, text as X, times as T

SETTLE_SECONDS = 1800


def event_registry(workflow_events: DataFrame) -> DataFrame:
    """Per event key: true only when every workflow that waits for it is scheduled. Rows ``(event_key, scheduled)``."""
    return workflow_events.groupBy("event_key").agg(F.bool_and(F.coalesce("scheduled", F.lit(False))).alias("scheduled"))


def unnested_registry(docs: DataFrame, column: str = "val") -> DataFrame:
    """Rows ``(event_key, prf, eid, sid, scheduled)`` of JSON maps ``profile/entity/stat → bool``."""
    key = F.col("event_key")
    rows = J.json_each(docs.select(column), column, "event_key", "flag").where(key.rlike("^[^/]*/[^/]*/"))
    return rows.groupBy(
        "event_key", X.key_part(key, 1).alias("prf"), X.key_part(key, 2).alias("eid"), X.key_part(key, 3).alias("sid")
    ).agg(F.max(F.col("flag").cast("boolean")).alias("scheduled"))


def latest_publications(datasets: DataFrame) -> DataFrame:
    """Newest ``updated_at`` per ``(prf, eid)`` from uris ``CTL/prf/eid/name``; the parsed key replaces a pattern join."""
    return datasets.where(F.col("uri").rlike("^CTL/[^/]*/[^/]*/")).groupBy(
        X.key_part(F.col("uri"), 2).alias("prf"), X.key_part(F.col("uri"), 3).alias("eid")).agg(F.max("updated_at").alias("updated_at"))


def latest_stats(stats: DataFrame) -> DataFrame:
    """Last published value per ``(profile, entity_id, stat_id)``; equal times go to the higher loading."""
    best = stats.groupBy("profile", "entity_id", "stat_id").agg(
        F.max_by(F.struct("loading_id", "value", "published_at"), F.struct("published_at", "loading_id", "value")).alias("_s"))
    return best.select("profile", "entity_id", "stat_id", "_s.*")


def publication_key(loading: Column, profile: Column, entity: Column, stat: Column, at: Column) -> Column:
    """``loading/profile/entity/stat``, or ``0/profile/entity/dt`` and the time when there is no loading."""
    with_loading = F.concat_ws("/", loading.cast("string"), profile, entity.cast("string"), stat.cast("string"))
    without = F.concat_ws("/", F.lit("0"), profile, entity.cast("string"), F.concat(F.lit("dt="), T.clock_text(at)))
    return F.when(F.coalesce(loading, F.lit(0)) != 0, with_loading).otherwise(without)


def published_keys(dataset_events: DataFrame, datasets: DataFrame) -> DataFrame:
    """``(pub_key, at)``: the newest publication of every key in the event log.

    Log rows ``(dataset_id, extra JSON, at)`` belong to datasets ``(id, uri)``; only ``CTL/`` datasets count. An entry
    ``loading/profile/entity/stat`` is a key, ``0/profile/entity/dt`` is one together with its value.
    """
    mine = datasets.where(F.col("uri").startswith("CTL/")).select(F.col("id").alias("dataset_id"))
    entries = J.json_each(dataset_events.join(mine, "dataset_id", "left_semi").select("extra", "at"), "extra", "name", "value")
    dated = F.col("name").rlike(r"^0/[^/]*/[^/]*/dt$")
    plain = F.col("name").rlike(r"^[1-9][0-9]*/[^/]*/[^/]*/[0-9]+$")
    keyed = entries.where(dated | plain).select(F.when(dated, F.concat("name", F.lit("="), "value")).otherwise(F.col("name")).alias("pub_key"), "at")
    return keyed.groupBy("pub_key").agg(F.max("at").alias("at"))


def new_events(registry: DataFrame, stats: DataFrame, publications: DataFrame, published: DataFrame, profile: str,
               all_events: bool = False, tolerance_seconds: int = 60) -> DataFrame:
    """Events to publish.

    Keys that are scheduled elsewhere are skipped, own-profile keys too unless ``all_events``. A value older than the
    last publication less the tolerance is stale, a key already in ``published (pub_key)`` is not sent again.
    """
    # Keys take the types of the statistics, so that the join reuses their partitioning.
    open_keys = registry.where(~F.col("scheduled")).select(
        "event_key", "prf", "eid", "sid", F.col("prf").alias("profile"), F.col("eid").try_cast("bigint").alias("entity_id"), F.col("sid").try_cast("int").alias("stat_id"))
    if not all_events:
        open_keys = open_keys.where(F.col("prf") != profile)
    last = latest_stats(stats)
    joined = last.join(open_keys, ["profile", "entity_id", "stat_id"]).join(publications, ["prf", "eid"], "left")
    fresh = F.col("updated_at").isNull() | (F.col("published_at") >= F.col("updated_at") - T.seconds(tolerance_seconds))
    keyed = joined.where(fresh).withColumn(
        "pub_key", publication_key(F.col("loading_id"), F.col("prf"), F.col("eid"), F.col("sid"), F.col("published_at")))
    return keyed.join(published.select("pub_key").distinct(), "pub_key", "left_anti").select(
        "pub_key", "event_key", "prf", "eid", "sid", "loading_id", "value", "published_at")


def cycle_events(events: DataFrame, seed: str = "", cap: int | None = None) -> DataFrame:
    """Events in a fair, repeatable order; with a cap those of one cycle."""
    from haulage.operators.reports import random_order

    return random_order(events, seed, "event_key", limit=cap)


def event_payload(events: DataFrame, stats: DataFrame, base_url: str) -> DataFrame:
    """Payload rows ``(pub_key, name, value)``: dt, url and every statistic of the event's loading, profile and entity."""
    ind = F.concat_ws("/", F.coalesce("loading_id", F.lit(0)).cast("string"), "prf", "eid")
    has = F.coalesce(F.col("loading_id"), F.lit(0)) != 0
    own = events.select("pub_key", F.inline(F.array(
        F.struct(F.concat(ind, F.lit("/dt")).alias("name"), T.clock_text(F.col("published_at")).alias("value")),
        F.struct(F.when(has, F.concat(ind, F.lit("/url"))).otherwise(F.concat(ind, F.lit("/"), F.col("sid"))).alias("name"),
                 F.when(has, F.concat(F.lit(base_url), F.lit("/#/loading/"), F.col("loading_id").cast("string"))).otherwise(F.col("value")).alias("value")))))
    per_stat = stats.groupBy("loading_id", "profile", "entity_id", "stat_id").agg(F.max_by("value", F.struct("published_at", "value")).alias("value"))
    values = events.where(has).select("pub_key", F.col("loading_id"), F.col("prf").alias("profile"), F.col("eid").cast("bigint").alias("entity_id")).join(
        per_stat, ["loading_id", "profile", "entity_id"]).select(
        "pub_key", F.concat_ws("/", F.col("loading_id").cast("string"), "profile", F.col("entity_id").cast("string"), F.col("stat_id").cast("string")).alias("name"), "value")
    return own.unionByName(values)


def payload_map(payload: DataFrame) -> DataFrame:
    """One map per event. An event has as many entries as there are statistic ids, so the group is small by nature."""
    return payload.groupBy("pub_key").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "value")))).alias("payload"))


def readiness(waits: DataFrame, stats: DataFrame, now, settle_seconds: int = SETTLE_SECONDS) -> DataFrame:
    """Whether each waiting loading may go on.

    ``waits``: ``(loading_id, start_at, strategy, profile, entity_id, stat_id, active)``, one row per awaited event.
    OR needs one active event at or after the start, AND needs all of them. Inactive events are off; without active
    events, or while one is younger than the settle time, the loading keeps waiting.
    """
    now = T.moment(now)
    last = latest_stats(stats).select("profile", "entity_id", "stat_id", "published_at")
    joined = waits.join(last, ["profile", "entity_id", "stat_id"], "left")
    active = F.coalesce(F.col("active"), F.lit(True))
    come = F.coalesce(F.col("published_at") >= F.col("start_at"), F.lit(False))
    fresh = F.coalesce(F.col("published_at") > now - T.seconds(settle_seconds), F.lit(False))
    folded = joined.groupBy("loading_id", "strategy").agg(
        F.count_if(active).alias("n_active"), F.count_if(active & come).alias("n_ready"), F.coalesce(F.bool_or(active & fresh), F.lit(False)).alias("is_settling"))
    ready = F.when(F.col("strategy") == "and", F.col("n_ready") == F.col("n_active")).otherwise(F.col("n_ready") > 0)
    return folded.withColumn("is_ready", (F.col("n_active") > 0) & ~F.col("is_settling") & ready)


def expiry(waits: DataFrame, stats: DataFrame, expire: str | Column) -> DataFrame:
    """Verdict of AND waits of run type EVENT-WAIT / AF-EVENT; the others are READY.

    An active event older than the start moved by the ``expire`` text is stale. Stale with some ready keeps waiting,
    stale with none ready is an error with result -99.
    """
    last = latest_stats(stats).select("profile", "entity_id", "stat_id", "published_at")
    joined = waits.join(last, ["profile", "entity_id", "stat_id"], "left")
    limit = T.shift(F.col("start_at"), expire) if isinstance(expire, str) else T.shift_by_column(F.col("start_at"), expire)
    active = F.coalesce(F.col("active"), F.lit(True))
    stale = F.col("published_at").isNull() | (F.col("published_at") < limit)
    checked = (F.col("strategy") == "and") & F.col("run_type").isin("EVENT-WAIT", "AF-EVENT")
    folded = joined.groupBy("loading_id", "strategy", "run_type").agg(
        F.count_if(active & stale).alias("n_stale"), F.count_if(active & ~stale).alias("n_fresh"))
    verdict = F.when(~checked | (F.col("n_stale") == 0), "READY").when(F.col("n_fresh") > 0, "EVENT-WAIT").otherwise("ERROR")
    return folded.select("loading_id", "n_stale", "n_fresh", verdict.alias("verdict"), F.when(verdict == "ERROR", F.lit(-99)).alias("res"))


def trigger_fold(trigger_events: DataFrame, awaited: DataFrame, runs: str = "run_id") -> DataFrame:
    """Per run and dataset: matching event key, newest ``dt`` and source run; the run's newest ``dt`` and type.

    ``trigger_events``: ``(run_id, uri, source_run, extra JSON)``; ``awaited``: ``(event_key)`` of active events.
    """
    entries = J.json_each(trigger_events.select(runs, "uri", "source_run", "extra"), "extra", "name", "value")
    tail = F.regexp_extract("name", r"([^/]*/[^/]*/[^/]*)$", 1)
    matched = entries.join(awaited.select(F.col("event_key").alias("_e")).distinct(), tail == F.col("_e"), "left")
    dt = F.when(F.col("name").endswith("/dt"), F.col("value"))
    per_set = matched.groupBy(runs, "uri").agg(
        F.max(F.when(F.col("_e").isNotNull(), F.col("name"))).alias("event_name"), F.max(dt).alias("dt"), F.max("source_run").alias("source_run"),
        F.max(F.when(F.col("name") == "wfp_run_type", F.col("value"))).alias("_type"))
    per_run = per_set.groupBy(runs).agg(F.max("dt").alias("af_sdt"), F.coalesce(F.max("_type"), F.lit("AF-EVENT")).alias("run_type"))
    return per_set.drop("_type").join(per_run, runs)


def entity_names(ids: DataFrame, entities: DataFrame, ident: str = "entity_id") -> DataFrame:
    """ASCII name of each id, the id itself when it is unknown or its name has no ASCII part."""
    named = ids.join(entities.select(F.col("id").alias(ident), "name"), ident, "left")
    return named.withColumn("name", X.ascii_name(F.coalesce("name", F.lit("_Not_found_")), F.col(ident)))


def all_entity_ids(entities: DataFrame, events: DataFrame, everything: DataFrame | None = None, ident: str = "id", parent: str = "parent_id") -> DataFrame:
    """Entities, entities of events, and the parents of both; positive ids only.

    ``everything`` holds all known entities, where the parents of event entities are looked up.
    """
    event_ids = events.select(F.col("entity_id").cast("bigint").alias(ident)).distinct()
    known = entities if everything is None else everything
    parents = entities.select(F.col(parent).alias(ident)).union(known.join(event_ids, ident, "left_semi").select(F.col(parent).alias(ident)))
    return entities.select(ident).union(event_ids).union(parents).where(F.col(ident) > 0).distinct()
