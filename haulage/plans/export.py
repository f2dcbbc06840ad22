"""One export run: registry row → window → rows → parts → package → notifications → history."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.functions import numbers as N, text as X
from haulage.operators import extract as EX, parts as PA, schema as SC, state as ST
from haulage.session import stored
from haulage.sinks import archive as AR, notify as NO
from haulage.sinks.delimited import Dialect
from haulage.sources import registry as RG

# The size of a part where the registry gives none: one file for a table of any size would be one task.
DEFAULT_PART_BYTES = 1024 ** 3


@dataclass
class Export:
    """What one run needs to know: a validated registry row, its merged parameters and where things go."""

    name: str
    schema: str
    replica: str
    scenario: str
    spec: dict | str
    params: dict
    key: list[str]
    root: str
    history_path: str
    is_recent: bool = False
    environment: str = "prom"
    sample_rows: int | None = None
    description: str | None = None
    reserved: list[str] | None = None
    # Switches of the registry; without them the extract is active and confirms nothing by itself.
    gates: dict | None = None
    optimize: Callable[[], None] | None = None
    extra: dict = field(default_factory=dict)

    def flag(self, name: str) -> bool:
        return str(self.params.get(name, "")).lower() in ("1", "true", "yes")


@dataclass
class Outcome:
    time_from: str
    time_to: str
    is_current: bool
    n_rows: int
    archives: list[str]
    manifest: DataFrame | None
    # Why nothing ran: the state of the last window, see ``state.run_states``.
    held: str | None = None


def export_of(registry_row, scenario: str, root: str, history_path: str, overrides: dict | None = None, **more) -> Export:
    """An :class:`Export` from one registry row; parameters are the registry's over the defaults, then the overrides."""
    given = json.loads(registry_row["params"] or "{}")
    params = {**RG.DEFAULTS, **{k: str(v) for k, v in given.items()}}
    params.update({k: str(v) for k, v in (overrides or {}).items() if v not in (None, "", "None")})
    if params["format"] != "TSVWithNames":
        raise ValueError("only TSVWithNames packages are written")
    return Export(
        name=registry_row["extract_name"], schema=registry_row["schema_name"], replica=registry_row["replica"], scenario=scenario,
        spec=RG.spec_of(registry_row), params=params, key=list(registry_row["uk"] or registry_row["pk"] or []), root=root,
        history_path=history_path, is_recent=bool(registry_row["is_recent"]), description=registry_row["description"] or None, **more)


def window_of(spark: SparkSession, job: Export, history: DataFrame, now: str):
    """``(time_from, time_to, is_current)`` of this run: the recent window or the next step of the history."""
    if job.is_recent:
        end = dt.datetime.fromisoformat(now).replace(microsecond=0)
        return str(end - dt.timedelta(minutes=int(job.params["recent_interval"]))), str(end), True
    registry = spark.createDataFrame(
        [(job.name, int(job.params["increment"]), int(job.params["overlap"]), job.params["lower_bound"], job.params["time_field"])],
        "extract_name string, increment int, overlap int, lower_bound string, time_field string")
    row = ST.next_windows(registry, history.where(F.col("extract_name") == job.name), now).first()
    return str(row.time_from), str(row.time_to), bool(row.is_current)


def extracted(spark: SparkSession, job: Export, start: str, end: str, valid_from: str) -> DataFrame:
    """The package rows: windowed spec, environment cap, technical columns, cleaned and rendered text."""
    rows = EX.read_spec(spark, job.spec, job.params["time_field"], start, end)
    rows = SC.renamed(EX.sampled(rows, job.environment, job.sample_rows, job.key), job.reserved)
    if job.flag("xstream_sanitize") and job.params["sanitize_list"]:
        rules = [tuple(pair) for pair in json.loads(job.params["sanitize_list"])]
        rows = X.sanitize_frame(rows, rules, arrays=job.flag("sanitize_array"))
    rows = X.arrays_as_text(rows, "pg" if job.flag("pg_array_format") else "ch")
    return EX.technical_columns(rows, end, valid_from)


def admitted(spark: SparkSession, job: Export, history: DataFrame, now: str, receipts: DataFrame | None = None, write: bool = True) -> tuple[str | None, DataFrame]:
    """Whether the next window may run, None or the state that holds it, and the log with what was confirmed by now.

    Receipts that came in time and the gate that confirms by itself become confirmed copies in the log, also where another
    window keeps the extract waiting.
    """
    gates = job.gates or {}
    extract = spark.createDataFrame(
        [(job.name, gates.get("is_active", True), gates.get("auto_confirm_delta", False), job.flag("auto_confirm"), job.flag("notify_kafka"), int(job.params["confirm_timeout"]))],
        "extract_name string, is_active boolean, auto_confirm_delta boolean, auto_confirm boolean, notify boolean, confirm_timeout int")
    own = history.where(F.col("extract_name") == job.name)
    came = receipts if receipts is not None else spark.createDataFrame([], ST.RECEIPTS)
    states = ST.run_states(extract, own, came, now)
    step = states.first()
    if step.confirms_all or step.state == "received":
        copies = stored(ST.confirmed_copies(own, states, now), "confirmed")
        history = history.unionByName(copies)
        if write:
            ST.append_history(copies, job.history_path)
    return None if step.may_run else step.state, history


def run_export(spark: SparkSession, job: Export, history: DataFrame, now: str, write: bool = True, run_at: str | None = None, receipts: DataFrame | None = None) -> Outcome:
    """Run one window of one export. ``run_at`` (``now`` by default) names the package, so every run needs its own.

    Before anything is read the log is asked whether the window may run: gates, confirmations and ``receipts`` decide. The gate
    ``optimize_exp_table`` calls ``job.optimize`` first.
    The rows are written once to the shared folder with their sizes after the window is read: cuts, manifest and
    archives all read that copy, so the source is scanned once and a lost executor costs no second read of it.
    """
    import ast

    run_at = run_at or now
    held, history = admitted(spark, job, history, now, receipts, write)
    if held:
        return Outcome("", "", False, 0, [], None, held)
    if job.optimize and (job.gates or {}).get("optimize_exp_table"):
        job.optimize()
    start, end, is_current = window_of(spark, job, history, now)
    package = extracted(spark, job, start, end, run_at)
    # The stored row number makes the order total, also where the key repeats: every later pass cuts at the same rows.
    dialect = Dialect.of(ast.literal_eval(job.params["csv_format_params"]) if job.params["csv_format_params"] else None)
    head = PA.head_bytes(package.columns, dialect)
    rows = stored(package.withColumn("row_size", PA.row_bytes(package, dialect)).withColumn("_row", F.monotonically_increasing_id()), "package-rows")
    order = [f"{k}_" if f"{k}_" in package.columns else k for k in job.key] + ["_row"]
    parts = PA.with_parts(rows, order, N.size_bytes(job.params["max_file_size"]) or DEFAULT_PART_BYTES, head=head)
    stamp = dt.datetime.fromisoformat(run_at).strftime("%Y%m%d%H%M%S")
    # The manifest reads the order columns and sizes only and is kept: names, tickets and messages all come from it.
    manifest = stored(PA.package_manifest(parts.select("part_no", "row_size"), job.schema, job.name, job.replica, stamp, job.flag("send_empty"), head=head), "manifest")
    totals = PA.package_totals(manifest).first()
    archives: list[str] = []
    if write and totals.total_files:
        plain = package.drop("export_time", "ctl_action", "ctl_validfrom")
        meta = SC.meta_json(SC.descriptor(plain, words=[]), job.schema, job.name, job.params["strategy"], [], job.key, job.description)
        if totals.total_rows:
            written = AR.write_archives(parts, manifest, package.columns, order, job.root, meta, stamp, dialect, tasks=totals.total_files)
            # Sorted here: an ordering in the plan would sample its input first, and so write every archive twice.
            archives = [name for _, name in sorted((r.part_no, r.archive_name) for r in written.collect())]
        else:
            archives = [AR.write_empty_archive(job.root, manifest.first(), package.columns, meta, stamp, dialect)]
        AR.write_summary_ticket(job.root, f"{job.replica}__{stamp}.tkt".lower(), archives)
        if job.flag("notify_kafka"):
            NO.send(NO.notifications(NO.package_files(manifest), f"{job.replica}__{stamp}", job.scenario, run_at), f"{job.root}/_outbox")
    if write:
        moment = dt.datetime.fromisoformat(run_at)
        sent = moment if archives else None
        ST.append_history(ST.history_row(
            spark, extract_name=job.name, extract_time=dt.datetime.fromisoformat(end), extract_count=int(totals.total_rows), loaded=moment, sent=sent,
            increment=int(job.params["increment"]), overlap=int(job.params["overlap"]),
            recent_interval=int(job.params["recent_interval"]) if job.is_recent else 0, time_field=job.params["time_field"],
            time_from=dt.datetime.fromisoformat(start), time_to=dt.datetime.fromisoformat(end), exported_files=archives), job.history_path)
    return Outcome(start, end, is_current, int(totals.total_rows), archives, manifest)


def catch_up(spark: SparkSession, job: Export, now: str, limit: int | None = None, receipts: Callable[[], DataFrame] | None = None) -> list[Outcome]:
    """Run window after window until the present is reached, a window is held, or ``limit`` windows were run. ``receipts`` gives
    those that have come so far.

    The runs count as started one second apart, which keeps their package names apart.
    """
    from pyspark.errors import AnalysisException

    done: list[Outcome] = []
    while True:
        try:
            history = spark.read.schema(ST.HISTORY).parquet(job.history_path)
        except AnalysisException:
            history = spark.createDataFrame([], ST.HISTORY)
        run_at = str(dt.datetime.fromisoformat(now) + dt.timedelta(seconds=len(done)))
        done.append(run_export(spark, job, history, now, run_at=run_at, receipts=receipts() if receipts else None))
        if done[-1].is_current or done[-1].held or (limit and len(done) >= limit):
            return done
