"""Loadings: normalised documents, status history, monitor actions, retries and launch candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from haulage.functions import jsons as J, text as X, times as T

LOADING = (
    "id bigint, wf_id bigint, profile string, alive string, auto boolean, status string, status_log string, start_dttm string, "
    "params array<struct<param:string,value:string>>, "
    "stats array<struct<loading_id:bigint,profile:string,entity_id:bigint,stat_id:int,value:string>>, "
    "loading_status array<struct<status:string,effective_from:string,log:string>>, workflow struct<name:string>"
)

# Statuses of a loading in the order it passes them (fixed values).
STATUSES = ["INIT", "TIME-WAIT", "EVENT-WAIT", "LOCK-WAIT", "PREREQ", "LOCK", "PARAM", "START", "RUNNING", "SUCCESS", "ERROR", "ERRORCHECK", "ABORTING"]
WAITING_TYPES = ["TIME-WAIT", "EVENT-WAIT", "MANUAL"]
NO_RESULT = -99


def loading_history(spark, path: str, profile: str | None = None, statuses: list[str] | None = None, since: str | None = None) -> DataFrame:
    """Landed loading documents (one JSON object per line) with the filters of the run list."""
    df = spark.read.schema(LOADING).json(path)
    if profile:
        df = df.where(F.col("profile") == profile)
    if statuses:
        df = df.where(F.col("status").isin(statuses))
    return df.where(F.col("start_dttm") >= since) if since else df


def kept_params(params: Column) -> Column:
    """Name → value for parameters that start with ``wf`` or contain ``loading``; sorted, the last repeat wins."""
    kept = F.filter(params, lambda p: p["param"].startswith("wf") | p["param"].contains("loading"))
    return J.last_wins_map(F.transform(kept, lambda p: F.struct(p["param"].alias("key"), p["value"].alias("value"))))


def stats_map(stats: Column) -> Column:
    """``loading/profile/entity/stat`` → value; among repeats the highest value wins."""
    ordered = F.sort_array(F.transform(stats, lambda s: F.struct(
        s["stat_id"].alias("stat"), F.coalesce(s["value"], F.lit("")).alias("sort"),
        F.concat_ws("/", s["loading_id"].cast("string"), s["profile"], s["entity_id"].cast("string"), s["stat_id"].cast("string")).alias("key"),
        s["value"].alias("value"))))
    return J.last_wins_map(F.transform(ordered, lambda s: F.struct(s["key"], s["value"])))


def run_type(given: Column, auto: Column, first_status: Column) -> Column:
    """The given type, MANUAL when not automatic, else the first status if it is a waiting one, else NO-WAIT."""
    derived = F.when(~auto, "MANUAL").when(first_status.isin(WAITING_TYPES), first_status).otherwise("NO-WAIT")
    return F.coalesce(F.nullif(given, F.lit("")), derived)


def normalised(loadings: DataFrame) -> DataFrame:
    """One row per document: parameters, statistics, run type, current status time, last time per status, history."""
    # Sorted history and parameter map are columns of their own step: each is used several times below.
    history = F.transform("loading_status", lambda s: F.struct(s["effective_from"], s["status"], F.coalesce(s["log"], F.lit("")).alias("log")))
    step = loadings.select(
        "id", "wf_id", "profile", "alive", "auto", "status", "status_log", "start_dttm", F.col("workflow.name").alias("wf_name"),
        F.sort_array(history).alias("_history"), kept_params(F.col("params")).alias("_params"), F.col("stats").alias("_stats"))
    by_time, params = F.col("_history"), F.col("_params")
    last = J.last_wins_map(F.transform(by_time, lambda s: F.struct(s["status"].alias("key"), s["effective_from"].alias("value"))))
    past = F.transform(F.reverse(by_time), lambda s: F.struct(s["effective_from"], F.concat(s["status"], F.lit(" "), s["log"]).alias("text")))
    return step.select(
        "id", "wf_id", "profile", "alive", "auto", "status", "status_log", "start_dttm", "wf_name", params.alias("params"), stats_map(F.col("_stats")).alias("stats"),
        run_type(params["wfp_run_type"], F.col("auto"), F.get(by_time, F.lit(0))["status"]).alias("run_type"),
        F.coalesce(F.try_element_at(by_time, F.lit(-1))["effective_from"], F.col("start_dttm")).alias("status_sdt"),
        last.alias("status_last"), past.alias("history"))


def status_view(norm: DataFrame) -> DataFrame:
    """Loading id, state, parsed log (step, data, msg), last START and run type."""
    return norm.withColumn("_l", J.parse_log(F.col("status_log"))).select(
        F.col("id").alias("lid"), "start_dttm", "alive", "status_sdt", "status", "_l.step", "_l.data", "_l.msg",
        F.coalesce(F.col("status_last")["START"], F.lit("")).alias("run_dttm"), "run_type")


def gate(alive: list[str] | None = None, status: list[str] | None = None, step: list[str] | None = None, log_empty: bool | None = None) -> Column:
    """Why a row of :func:`status_view` fails the expected state; the first failing test wins, NULL when it passes.

    As in the source, ``log_empty=True`` rejects an empty log and ``log_empty=False`` rejects a filled one.
    """
    empty = (F.col("msg") == "") & (F.col("data").isin("{}", ""))
    reason = F.lit(None).cast("string")
    if log_empty is not None:
        reason = F.when(empty if log_empty else ~empty, "log").otherwise(reason)
    for name, allowed in (("step", step), ("status", status), ("alive", alive)):
        if allowed:
            reason = F.when(~F.col(name).isin(allowed), name).otherwise(reason)
    return reason


def status_now(log: DataFrame, ident: str = "loading_id", start: str | None = None) -> DataFrame:
    """Newest status per loading; the start time where there is no status."""
    out = log.groupBy(ident).agg(F.max("effective_from").alias("status_sdt"), F.max_by("status", F.struct("effective_from", "status")).alias("status"),
                                 *([F.min(start).alias("_start")] if start else []))
    return out.withColumn("status_sdt", F.coalesce("status_sdt", "_start")).drop("_start") if start else out


def status_last(log: DataFrame, ident: str = "loading_id") -> DataFrame:
    return log.groupBy(ident, "status").agg(F.max("effective_from").alias("last_at"))


def status_history(log: DataFrame, ident: str = "loading_id") -> DataFrame:
    """One row per loading, moment and text ``STATUS log``; a history of any length stays spread out."""
    return log.select(ident, "effective_from", F.concat("status", F.lit(" "), F.coalesce("log", F.lit(""))).alias("entry")).distinct()


def run_types(log: DataFrame, runs: DataFrame, ident: str = "loading_id") -> DataFrame:
    """Run type per loading from a status log and ``(id, auto, given)`` rows."""
    first = log.groupBy(ident).agg(F.min_by("status", F.struct("effective_from", "status")).alias("first_status"))
    return runs.join(first, ident, "left").select(ident, run_type(F.col("given"), F.col("auto"), F.col("first_status")).alias("run_type"))


# What the monitor does by status: (statuses, condition, hours that must have passed, action). The first line of a status
# that applies decides (statuses, actions and hours are fixed values); a status without a line is not known.
MONITOR = [
    (("PREREQ", "PARAM", "START"), "always", 0, "reStarted"),
    (("LOCK", "LOCK-WAIT"), "always", 5, "reStarted"),
    (("LOCK", "LOCK-WAIT"), "always", 0, "Skipped"),
    (("TIME-WAIT", "EVENT-WAIT"), "runs", 0, "Skipped"),
    (("TIME-WAIT",), "start is due", 0, "reStarted"),
    (("TIME-WAIT",), "start is planned", 0, "Skipped"),
    (("TIME-WAIT",), "always", 0, "Aborted"),
    (("EVENT-WAIT",), "events are missing", 0, "Skipped"),
    (("EVENT-WAIT",), "always", 0, "reStarted"),
    (("RUNNING",), "no text", 0, "Skipped"),
    (("RUNNING",), "text of the run", 6, "reRunned"),
    (("RUNNING",), "text of the run", 0, "Skipped"),
    (("RUNNING",), "always", 0, "reRunned"),
    (("ERROR",), "aborts on failure", 0, "Aborted"),
    (("ERROR", "SUCCESS"), "always", 0, "Completed"),
    (("ERRORCHECK",), "always", 0, "reRunned"),
    (("ABORTING",), "names a status", 0, None),
    (("ABORTING",), "always", 0, "Aborted"),
]


def monitor_action(now, events_wait: Column | None = None) -> Column:
    """What to do with an active loading.

    Row columns: ``status, log, status_sdt, running, abort_on_failure``. ``events_wait`` is true while the events of an
    EVENT-WAIT loading are not ready. Anything younger than an hour is New.
    """
    now = T.moment(now)
    log = F.coalesce(F.col("log"), F.lit(""))
    named = F.split_part(F.trim(log), F.lit(" "), F.lit(1))
    planned = F.try_to_timestamp(F.substr(log, F.lit(20)), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz")
    scheduled = log.startswith("Start scheduled on ")
    conditions = {
        "always": F.lit(True), "runs": F.col("running"), "no text": log == "", "text of the run": log.startswith("RUN"),
        "start is planned": scheduled, "start is due": scheduled & (planned + T.seconds(900) <= now), "aborts on failure": F.col("abort_on_failure"),
        "names a status": named.isin(STATUSES), "events are missing": F.lit(True) if events_wait is None else F.coalesce(events_wait, F.lit(True)),
    }

    def older(hours: int) -> Column:
        return F.col("status_sdt") + T.seconds(hours * 3600) <= now

    decided = None
    for statuses, condition, hours, action in MONITOR:
        applies = F.col("status").isin(*statuses) & conditions[condition] & (older(hours) if hours else F.lit(True))
        result = named if action is None else F.lit(action)
        decided = F.when(applies, result) if decided is None else decided.when(applies, result)
    return F.when(older(1), decided.otherwise("notFound")).otherwise("New")


def with_sla(action: Column, now, interval: Column | None = None) -> Column:
    """Skipped becomes SLA once the status is older than the allowed interval (one day when there is none)."""
    day = F.make_dt_interval(F.lit(1))
    allowed = F.coalesce(interval, day) if interval is not None else day
    return F.when((action == "Skipped") & (F.col("status_sdt") + allowed <= T.moment(now)), "SLA").otherwise(action)


def monitor(loadings: DataFrame, now, events_wait: Column | None = None, interval: Column | None = None) -> DataFrame:
    """Active loadings with their action and printed age."""
    active = loadings.where(F.col("alive") == "ACTIVE")
    return active.withColumn("action", with_sla(monitor_action(now, events_wait), now, interval)).withColumn(
        "age", T.elapsed_text(T.moment(now), F.col("status_sdt")))


def actionable(monitored: DataFrame, limit: int | None = None) -> DataFrame:
    """The loadings to act on; with a limit those of one cycle, lowest ids first."""
    due = monitored.where(~F.col("action").isin("Skipped", "New", "notFound", "SLA"))
    return due if limit is None else due.orderBy("lid").limit(limit)


def reject_reason(profile: str) -> Column:
    """First reason why a loading cannot be launched, NULL for a candidate."""
    return (
        F.when(F.coalesce(F.col("alive"), F.lit("")) != "ACTIVE", "not active")
        .when(F.coalesce(F.col("profile"), F.lit("")) != profile, "not profile")
        .when(F.coalesce(F.col("lid"), F.lit(0)) == 0, "no id")
        .when(F.coalesce(F.col("wf_id"), F.lit(0)) == 0, "no wf_id")
        .when(F.coalesce(F.col("loading_id"), F.lit(0)) == 0, "no loading_id")
        .when(~F.col("status").isin("RUNNING", "TIME-WAIT", "EVENT-WAIT"), "not add status")
        .when((F.col("status") == "RUNNING") & (F.coalesce(F.col("log"), F.lit("")) != ""), "already run"))


def launch_candidates(loadings: DataFrame, profile: str, cap: int) -> DataFrame:
    """Every loading with ``reject_reason`` (NULL = launched); ``cap`` is the number of workflows started in one cycle.

    Per workflow the lowest id wins; workflows are taken in id order up to the cap. Rows met after the cap is full
    are over the limit even when their workflow was taken.
    """
    marked = loadings.withColumn("reject_reason", reject_reason(profile))
    good = F.col("reject_reason").isNull()
    firsts = marked.where(good).groupBy("wf_id").agg(F.min("lid").alias("first_lid"))
    taken = firsts.orderBy("first_lid").limit(cap)
    # At most ``cap`` rows, so the closing id is one value.
    full_at = taken.agg(F.when(F.count("*") >= cap, F.max("first_lid"))).scalar()
    chosen = taken.select(F.col("wf_id").alias("_w"), F.col("first_lid").alias("_f"))
    joined = marked.join(chosen, F.col("wf_id") == F.col("_w"), "left")
    over = F.coalesce(F.col("lid") > full_at, F.lit(False))
    final = F.when(~good, F.col("reject_reason")).when(F.col("lid") == F.col("_f"), None).when(over, f"limit {cap} exceeded").otherwise("wf already added")
    return joined.withColumn("reject_reason", final).drop("_w", "_f")


def retry_config(explicit: Column, param: Column, log: Column, on: Column, count: Column, delay: Column, add: Column,
                 attempts: Column, delay_ms: Column) -> Column:
    """Retry settings: the explicit one, the parameter, the log, or built from counts; NULL without retries.

    The first three are printed dicts; a dict with a ``try`` wins. The result is a struct
    ``(try, left, delay, add, on)``.
    """
    kind = "struct<`try`:int,`left`:int,delay:string,`add`:string,`on`:array<string>>"

    def parsed(text: Column) -> Column:
        value = F.from_json(J.outer_object(text), kind)
        return F.when(F.coalesce(value["try"], F.lit(0)) != 0, value)

    nested = F.from_json(J.outer_object(log), f"struct<retry:{kind}>")["retry"]
    from_log = F.coalesce(F.when(F.coalesce(nested["try"], F.lit(0)) != 0, nested), parsed(log))
    names = F.when(F.coalesce(on, F.lit("")) != "", F.filter(F.transform(F.split(F.lower(on), ","), lambda x: F.trim(x)), lambda x: x != ""))
    by_count = F.coalesce(count, F.lit(1)) > 1
    by_fault = F.coalesce(attempts, F.lit(1)) > 1
    fault_delay = F.when(F.coalesce(delay_ms, F.lit(0)) != 0, F.concat(F.lit("seconds=+"), F.floor(delay_ms / 1000).cast("string")))
    built = F.when(by_count | by_fault, F.struct(
        F.lit(1).alias("try"), F.when(by_count, count - 1).otherwise(attempts - 1).cast("int").alias("left"),
        F.when(by_count, delay).otherwise(fault_delay).alias("delay"), F.when(by_count, add).alias("add"), names.alias("on")))
    return F.coalesce(parsed(explicit), parsed(param), from_log, built.cast(kind))


def outcome(res: Column, retry: Column, abort_on_failure: Column) -> Column:
    """``struct(res_msg, ok, no, err, status, action)`` of a finished attempt.

    ``retry`` is a struct with ``left, on, ok, no, err``. A missing result counts as an error.
    """
    value = F.coalesce(res, F.lit(NO_RESULT))
    msg = F.when(value > 0, "ok").when(value == 0, "no").otherwise("error")

    def counter(name: str, cond: Column) -> Column:
        return F.coalesce(retry[name], F.lit(0)) + cond.cast("int")

    ok, no, err = counter("ok", value > 0), counter("no", value == 0), counter("err", value < 0)
    on = F.coalesce(retry["on"], F.array(F.lit("error")))
    again = (F.coalesce(retry["left"], F.lit(0)) > 0) & (F.array_contains(on, msg) | F.array_contains(on, value.cast("string")))
    good = (ok > 0) | (no > 0)
    status = F.when(again, "ERRORCHECK").when(good, "SUCCESS").otherwise("ERROR")
    action = F.when(again, "retry").when(good, "Completed").when(abort_on_failure, "Aborted").otherwise("Completed")
    return F.struct(msg.alias("res_msg"), ok.alias("ok"), no.alias("no"), err.alias("err"), status.alias("status"), action.alias("action"))


def next_retry(now: Column, delay: Column, add: Column, attempt: Column) -> Column:
    """``now`` moved by the delay text and then ``attempt - 1`` times by the added one."""
    first = T.shift_by_column(now, delay)
    return F.aggregate(F.sequence(F.lit(0), F.greatest(attempt - 1, F.lit(0))), first,
                       lambda acc, i: F.when(i == 0, acc).otherwise(T.shift_by_column(acc, add)))


def resumed_retry(left: Column, attempt: Column) -> Column:
    """Counters after a time wait is over: one more attempt, one less left, never below 0."""
    return F.struct((F.coalesce(attempt, F.lit(1)) + 1).alias("try"), F.greatest(F.coalesce(left, F.lit(0)) - 1, F.lit(0)).alias("left"))


def due_waits(waits: DataFrame, now) -> DataFrame:
    """TIME-WAIT rows ``(time, try, left)`` whose time has come, with the counters moved on."""
    return waits.where(F.col("time") <= T.moment(now)).withColumn("_r", resumed_retry(F.col("left"), F.col("try"))).withColumn(
        "try", F.col("_r.try")).withColumn("left", F.col("_r.left")).drop("_r")


def delayed_start(is_new: Column, wait: Column, kind: Column, start: Column) -> Column:
    """Start time of a new EVENT-WAIT run with a waiting text; NULL when it is not delayed."""
    return F.when(is_new & wait.isNotNull() & (wait != "") & (kind == "EVENT-WAIT"), T.shift_by_column(start, wait))


def result_stats(results: DataFrame, now, ident: str = "loading_id") -> DataFrame:
    """Statistics published for result rows ``(id, entity_id, res, cdc, hub, stat)``; hub and stat are JSON texts."""
    good = F.coalesce(F.col("res"), F.lit(NO_RESULT)) > 0
    filled = good & (F.coalesce(F.col("hub"), F.lit("")).isin("", "{}") == F.lit(False))
    business = F.try_variant_get(F.try_parse_json("hub"), "$.dataBusiness", "variant")

    def entry(stat: int, value: Column, cond: Column) -> Column:
        return F.struct(F.lit(stat).alias("stat_id"), F.when(cond, value).alias("value"))

    fixed = F.array(
        entry(11, T.clock_text(T.moment(now)), F.lit(True)),
        entry(2, F.lit("1"), good),
        entry(1, F.col("cdc").cast("string"), good & (F.coalesce(F.col("cdc").cast("string"), F.lit("")) != "")),
        entry(56, F.col("hub"), filled),
        entry(55, F.to_json(F.struct(business.alias("dataBusiness"))), filled & ~F.coalesce(F.to_json(business), F.lit("null")).isin("null", '""', "0", "false", "{}", "[]")))
    given = F.transform(F.map_entries(F.coalesce(J.json_map(F.col("stat")), F.create_map().cast("map<string,string>"))),
                        lambda e: F.struct(e["key"].cast("int").alias("stat_id"), e["value"].alias("value")))
    return results.select(ident, "entity_id", F.inline(F.concat(fixed, given))).where(F.col("value").isNotNull())


def workflow_events(sched: Column, param: Column) -> Column:
    """Event key → active of a workflow: the scheduled list, else the parameter as a printed list or a comma list."""
    kind = "array<struct<profile:string,entity_id:string,stat_id:string,active:boolean>>"

    def keyed(events: Column) -> Column:
        return J.last_wins_map(F.transform(events, lambda e: F.struct(
            F.concat_ws("/", e["profile"], e["entity_id"], e["stat_id"]).alias("key"), F.coalesce(e["active"], F.lit(True)).alias("value"))))

    listed = F.from_json(J.literal_as_json(param), kind)
    names = F.filter(F.transform(F.split(param, ","), lambda x: F.trim(x)), lambda x: x != "")
    plain = J.last_wins_map(F.transform(names, lambda x: F.struct(x.alias("key"), F.lit(True).alias("value"))))
    return F.when(F.size(sched) > 0, keyed(sched)).when(F.ltrim(param).startswith("["), keyed(listed)).when(F.coalesce(param, F.lit("")) != "", plain)


def workflow_normalised(workflows: DataFrame) -> DataFrame:
    """Workflow documents with parameter map, notification map, event map and entity set."""
    params = J.last_wins_map(F.transform("param", lambda p: F.struct(p["param"].alias("key"), p["prior_value"].alias("value"))))
    notes = J.last_wins_map(F.transform("statusNotifications", lambda p: F.struct(p["status"].alias("key"), p["emails"].alias("value"))))
    own = X.digit_set(params["wf_entity"])
    linked = F.array_join(F.transform(F.sort_array(F.array_distinct("connectedEntities")), lambda x: x.cast("string")), ",")
    kind = "array<struct<profile:string,entity_id:string,stat_id:string,active:boolean>>"
    return workflows.withColumn("params", params).withColumn("statusNotifications", notes).withColumn(
        "events", workflow_events(F.col("wf_event_sched").cast(kind), F.col("params")["wf_event_sched"])).withColumn(
        "entities", F.coalesce(F.nullif(own, F.lit("")), linked, F.lit(""))).drop("param")


def recent_activity(loadings: DataFrame, now, days: int, at: str = "start_at", **equal) -> DataFrame:
    """Loadings of a profile or category started since midnight ``days`` days ago; 0 days means all."""
    out = loadings
    for column, value in equal.items():
        out = out.where(F.col(column) == value)
    return out.where(F.col(at) >= T.day_window_start(T.moment(now), days)) if days > 0 else out
