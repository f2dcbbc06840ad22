"""Extract state: the append-only history and the next window of every extract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as PT

from haulage.functions import times as T

_TIME, _TEXT, _INT = PT.TimestampNTZType(), PT.StringType(), PT.IntegerType()
HISTORY = PT.StructType([
    PT.StructField("extract_name", _TEXT),
    PT.StructField("extract_time", _TIME),
    PT.StructField("extract_count", PT.LongType()),
    PT.StructField("loaded", _TIME),
    PT.StructField("sent", _TIME),
    PT.StructField("confirmed", _TIME),
    PT.StructField("increment", _INT),
    PT.StructField("overlap", _INT),
    PT.StructField("recent_interval", _INT),
    PT.StructField("time_field", _TEXT),
    PT.StructField("time_from", _TIME),
    PT.StructField("time_to", _TIME),
    PT.StructField("exported_files", PT.ArrayType(_TEXT)),
])
EPOCH = "1970-01-01 00:00:00"


def latest_state(history: DataFrame) -> DataFrame:
    """Newest history row per extract; a confirmation row of the same window wins over the row it confirms."""
    newest = F.struct("time_to", "extract_time", F.col("confirmed").isNotNull(), F.coalesce("sent", "loaded"))
    return history.groupBy("extract_name").agg(
        F.max_by(F.struct("time_to", "confirmed", "sent", "extract_count"), newest).alias("last"))


def next_windows(registry: DataFrame, history: DataFrame, now, require_confirm: bool = False) -> DataFrame:
    """The next window per registry row ``(extract_name, increment min, overlap s, lower_bound, time_field)``.

    Starts at the end of the last window (or ``lower_bound``), moved back by the overlap; ends one increment later
    but not after ``now``. With ``require_confirm`` an unconfirmed window keeps its extract waiting.
    """
    now = T.moment(now)
    state = registry.join(latest_state(history), "extract_name", "left")
    base = F.coalesce(F.col("last.time_to"), F.nullif(F.col("lower_bound").cast("string"), F.lit("")).cast("timestamp_ntz"), T.moment(EPOCH))
    end = F.least(base + T.seconds(F.col("increment") * 60), now)
    waiting = F.col("last").isNotNull() & F.col("last.sent").isNotNull() & F.col("last.confirmed").isNull()
    out = state.select(
        "extract_name", "time_field", "increment", "overlap",
        (base - T.seconds(F.col("overlap"))).alias("time_from"), end.alias("time_to"), end.alias("extract_time"),
        (end == now).alias("is_current"), F.col("last").isNull().alias("is_first"), waiting.alias("is_waiting"))
    return out.where(~F.col("is_waiting")) if require_confirm else out


def catch_up_windows(spark, start, now, increment_minutes: int, overlap_seconds: int = 0) -> DataFrame:
    """All windows from ``start`` until ``now`` in order: ``(seq, time_from, time_to, is_current)``."""
    step = increment_minutes * 60
    span = T.elapsed_seconds(T.moment(now), T.moment(start))
    count = F.greatest(F.ceil(span / step), F.lit(1)).cast("int")
    first = spark.range(1).select(F.explode(F.sequence(F.lit(0), count - 1)).alias("seq"))
    lo = T.moment(start) + T.seconds(F.col("seq") * step)
    hi = F.least(lo + T.seconds(step), T.moment(now))
    return first.select("seq", (lo - T.seconds(overlap_seconds)).alias("time_from"), hi.alias("time_to"),
                        (hi == T.moment(now)).alias("is_current"))


def _window_hits(df: DataFrame, field: str, start, now, increment_minutes: int, overlap_seconds: int) -> DataFrame:
    """Rows with the ``seq`` of every catch-up window they belong to, by arithmetic instead of a range join."""
    kind = df.schema[field].dataType.simpleString()
    step = F.lit(increment_minutes * 60 * 1_000_000).cast("bigint")
    col = F.col(field)
    inside = df.where((col > T.moment(start, kind) - T.seconds(overlap_seconds)) & (col <= T.moment(now, kind)))
    offset = F.timestamp_diff("MICROSECOND", T.moment(start, kind), col)
    home = F.greatest(F.ceil(offset / step).cast("int") - 1, F.lit(0))
    if not overlap_seconds:
        return inside.withColumn("seq", home)
    last = F.ceil((offset + F.lit(overlap_seconds * 1_000_000).cast("bigint")) / step).cast("int") - 1
    return inside.withColumn("seq", F.explode(F.sequence(home, last)))


def window_rows(df: DataFrame, field: str, start, now, increment_minutes: int, overlap_seconds: int = 0) -> DataFrame:
    """All rows read by a catch-up with overlapping windows; a row of the overlap comes once per window.

    Adds ``seq`` and ``time_to``.
    """
    step = increment_minutes * 60
    hits = _window_hits(df, field, start, now, increment_minutes, overlap_seconds)
    lo = T.moment(start) + T.seconds(F.col("seq") * step)
    return hits.where(lo < T.moment(now)).withColumn("time_to", F.least(lo + T.seconds(step), T.moment(now)))


def window_counts(df: DataFrame, field: str, start, now, increment_minutes: int, overlap_seconds: int = 0) -> DataFrame:
    """Rows per catch-up window, empty windows included."""
    windows = catch_up_windows(df.sparkSession, start, now, increment_minutes, overlap_seconds)
    hits = _window_hits(df.select(field), field, start, now, increment_minutes, overlap_seconds)
    counts = hits.groupBy("seq").agg(F.count("*").alias("n_rows"))
    return windows.join(counts, "seq", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0).cast("bigint")))


def history_row(spark, **values) -> DataFrame:
    """One history row; the columns not given are NULL."""
    return spark.createDataFrame([tuple(values.get(f.name) for f in HISTORY)], HISTORY)


def append_history(rows: DataFrame, path: str) -> None:
    rows.select(*HISTORY.fieldNames()).write.mode("append").parquet(path)


def auto_confirm(history: DataFrame, now) -> DataFrame:
    """Copies of the sent but unconfirmed rows with the confirmation time set, to be appended.

    A window that has a confirmed copy already is left alone.
    """
    done = history.where(F.col("confirmed").isNotNull()).select("extract_name", "extract_time").distinct()
    open_rows = history.where(F.col("sent").isNotNull() & F.col("confirmed").isNull())
    return open_rows.join(done, ["extract_name", "extract_time"], "left_anti").select(history.columns).withColumn("confirmed", T.moment(now))


def confirmations(sent: DataFrame, receipts: DataFrame, timeout_minutes: int, now) -> DataFrame:
    """State of each sent request ``(rq_uid, sent_at, needs_confirm)`` against receipts ``(rq_uid, received_at)``.

    ``confirmed`` inside the time allowed, ``skipped`` when none is needed, ``timeout`` or ``waiting`` otherwise.
    """
    got = receipts.groupBy("rq_uid").agg(F.min("received_at").alias("received_at"))
    limit = F.col("sent_at") + T.seconds(timeout_minutes * 60)
    ok = F.col("received_at").isNotNull() & (F.col("received_at") >= F.col("sent_at")) & (F.col("received_at") <= limit)
    return sent.join(got, "rq_uid", "left").select(
        "rq_uid", "sent_at", F.when(ok, F.col("received_at")).alias("confirmed"),
        F.when(~F.col("needs_confirm"), "skipped").when(ok, "confirmed")
        .when(limit <= T.moment(now), "timeout").otherwise("waiting").alias("state"))


def needs_confirm(auto: Column, notify: Column, rows: Column) -> Column:
    """A receipt is awaited unless confirmation is automatic, nothing was notified or there was no data."""
    return ~auto & notify & (rows > 0)


RECEIPTS = "extract_name string, extract_time timestamp_ntz, received_at timestamp_ntz, code int"
# States in which an extract may run its next window.
RUNNABLE = ("new", "confirmed", "skipped", "auto", "received")


def run_states(extracts: DataFrame, history: DataFrame, receipts: DataFrame, now) -> DataFrame:
    """What every extract may do next, folded over its log: ``(extract_name, state, may_run, extract_time, sent_at, confirmed_at)``.

    ``extracts``: ``(extract_name, is_active, auto_confirm_delta, auto_confirm, notify, confirm_timeout min)``, the first two being the
    gates of the registry; ``receipts (extract_name, extract_time, received_at, code)``. The newest window decides:

    * ``inactive`` the gate is closed, ``new`` nothing has run, ``confirmed`` a confirmed copy is in the log;
    * ``skipped`` no receipt is awaited: confirmation is automatic, nothing was announced or there was no data;
    * ``auto`` the gate confirms what was sent; ``received`` a good receipt has come in time, ``failed`` a bad one;
    * ``timeout`` none has come in time, ``waiting`` there is time left.
    """
    now = T.moment(now)
    windows = history.groupBy("extract_name", "extract_time").agg(
        F.max("time_to").alias("time_to"), F.max("sent").alias("sent_at"), F.max("confirmed").alias("confirmed_at"), F.max("extract_count").alias("n_rows"))
    last = windows.groupBy(F.col("extract_name").alias("_name")).agg(F.max_by(F.struct("extract_time", "sent_at", "confirmed_at", "n_rows"), F.struct("time_to", "extract_time")).alias("w"))
    joined = extracts.join(last, F.col("extract_name") == F.col("_name"), "left").select(extracts.columns + ["w.*", F.col("w").isNotNull().alias("has_run")])
    limit = F.col("sent_at") + T.seconds(F.col("confirm_timeout") * 60)
    named = receipts.select(F.col("extract_name").alias("_name"), F.col("extract_time").alias("_time"), "received_at", "code")
    come = joined.join(named, (F.col("extract_name") == F.col("_name")) & (F.col("extract_time") == F.col("_time")), "left")
    counts = (F.col("received_at") >= F.col("sent_at")) & (F.col("received_at") <= limit) & (F.col("received_at") <= now)
    # The first receipt in time counts; of several at once the worst.
    first = F.min(F.when(counts, F.struct("received_at", (-F.col("code")).alias("bad")))).alias("receipt")
    kept = [F.first(c, ignorenulls=True).alias(c) for c in ("is_active", "auto_confirm_delta", "auto_confirm", "notify", "extract_time", "sent_at", "confirmed_at", "n_rows", "has_run", "confirm_timeout")]
    folded = come.groupBy("extract_name").agg(*kept, first)
    awaited = needs_confirm(F.col("auto_confirm"), F.col("notify") & F.col("sent_at").isNotNull(), F.coalesce("n_rows", F.lit(0)))
    state = (
        F.when(~F.coalesce("is_active", F.lit(False)), "inactive").when(~F.col("has_run"), "new").when(F.col("confirmed_at").isNotNull(), "confirmed").when(~awaited, "skipped")
        .when(F.coalesce("auto_confirm_delta", F.lit(False)), "auto").when(F.col("receipt.bad") == 0, "received").when(F.col("receipt").isNotNull(), "failed")
        .when(limit <= now, "timeout").otherwise("waiting"))
    return folded.select("extract_name", state.alias("state"), "extract_time", "sent_at", F.coalesce("confirmed_at", "receipt.received_at").alias("confirmed_at"), "is_active", "auto_confirm_delta").select(
        "extract_name", "state", F.col("state").isin(*RUNNABLE).alias("may_run"), "extract_time", "sent_at", F.when(F.col("state").isin("confirmed", "received"), F.col("confirmed_at")).alias("confirmed_at"),
        (F.coalesce("is_active", F.lit(False)) & F.coalesce("auto_confirm_delta", F.lit(False))).alias("confirms_all"))


def confirmed_copies(history: DataFrame, states: DataFrame, now) -> DataFrame:
    """Confirmed copies to be appended to the log: the window a receipt was received for, and every sent window of an extract whose
    gate confirms by itself."""
    marks = states.where("confirms_all OR state = 'received'").select("extract_name", "confirms_all", F.col("extract_time").alias("_time"), F.col("confirmed_at").alias("_at"))
    done = history.where(F.col("confirmed").isNotNull()).select("extract_name", "extract_time").distinct()
    open_rows = history.where(F.col("sent").isNotNull() & F.col("confirmed").isNull()).join(done, ["extract_name", "extract_time"], "left_anti")
    due = open_rows.join(marks, "extract_name").where(F.col("confirms_all") | (F.col("extract_time") == F.col("_time")))
    return due.withColumn("confirmed", F.when(F.col("confirms_all"), T.moment(now)).otherwise(F.col("_at"))).select(history.columns)


def next_run(windows: DataFrame, now, timeout: Column) -> DataFrame:
    """When the next cycle of an extract starts; NULL once its window has reached the present."""
    return windows.withColumn("next_run", F.when(~F.col("is_current"), T.moment(now) + T.seconds(timeout * 60)))
