"""Stateful event flows: publications and waiting loadings as keyed state with event-time timers.

The rules of a key are plain functions over its state; the processors feed them the rows of a micro-batch in the order of their
times and the timers that fall due. What is due before a row is settled before the row, so the result does not depend on where
one micro-batch ends and the next begins. A stream that uses these needs the RocksDB state store, see :func:`with_state_store`.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

# Values younger than this hold a loading back; older than the last publication by more than this they are stale (milliseconds).
SETTLE_MS, TOLERANCE_MS = 30 * 60_000, 60_000

PUBLISHED = "prf string, eid string, pub_key string, at timestamp"
SETTLED = "loading_id long, at timestamp, status string, tries int, left int, res int"


def with_state_store(spark: SparkSession) -> SparkSession:
    """Switch the session to the state store that keyed state with timers needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


def _ms(times: pd.Series) -> list[int]:
    """Milliseconds since 1970, rounded down."""
    return (pd.to_datetime(times, utc=True).dt.tz_localize(None).astype("datetime64[us]").astype("int64") // 1000).tolist()


def _times(ms: Iterable[int]) -> pd.Series:
    return pd.Series(pd.to_datetime(pd.Series(list(ms), dtype="int64"), unit="ms"))


# --- publications

def publish(state: dict, rows: list[tuple[int, str]], horizon_ms: int) -> list[tuple[int, str]]:
    """Rows ``(at, pub_key)`` in order of arrival that are published, by the state of their profile and entity: not older than the last
    publication less the tolerance, and not published before. Keys older than the horizon are forgotten."""
    out = []
    for at, key in rows:
        last = state.get("last")
        if (last is None or at >= last - TOLERANCE_MS) and key not in state["keys"]:
            out.append((at, key))
            state["last"] = at if last is None else max(last, at)
            state["keys"][key] = at
    state["keys"] = {k: t for k, t in state["keys"].items() if t >= (state.get("last") or 0) - horizon_ms}
    return out


class _Keyed(StatefulProcessor):
    """State of one key as a JSON text."""

    def init(self, handle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("state", "doc string")

    def load(self, fresh: dict) -> dict:
        return json.loads(self.kept.get()[0]) if self.kept.exists() else fresh

    def save(self, state: dict) -> None:
        self.kept.update((json.dumps(state),))

    def close(self) -> None:
        pass


class Publications(_Keyed):
    def __init__(self, horizon_ms: int):
        self.horizon_ms = horizon_ms

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.load({"keys": {}})
        found = pd.concat(list(rows)).sort_values("arrival", kind="stable")
        out = publish(state, list(zip(_ms(found["at"]), found["pub_key"])), self.horizon_ms)
        self.save(state)
        yield pd.DataFrame({"prf": [key[0]] * len(out), "eid": [key[1]] * len(out), "pub_key": [k for _, k in out], "at": _times(t for t, _ in out)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return iter(())


def publications(values: DataFrame, lateness: str, horizon_days: int = 90) -> DataFrame:
    """New events of a stream of values ``(prf, eid, pub_key, arrival, at)``, each published once: ``(prf, eid, pub_key, at)``.

    Values of a micro-batch are taken by ``arrival``. The state of a profile and entity is the time of its last publication and the
    keys of the last ``horizon_days``.
    """
    with_state_store(values.sparkSession)
    keyed = values.withWatermark("at", lateness).groupBy("prf", "eid")
    return keyed.transformWithStateInPandas(Publications(horizon_days * 86_400_000), PUBLISHED, "append", "eventTime")


# --- waiting loadings

def begun(at: int, strategy: str, wanted: list[str], expire_ms: int, left: int) -> dict:
    """The state of a loading that starts to wait for the events ``wanted``."""
    return {"start": at, "strategy": strategy, "wanted": sorted(set(wanted)), "expire": expire_ms, "deadline": at + expire_ms if strategy == "and" and expire_ms > 0 else None,
            "tries": 1, "left": left, "come": [], "last": None}


def ready(state: dict) -> bool:
    come = len(state["come"])
    return come == len(state["wanted"]) and come > 0 if state["strategy"] == "and" else come > 0


def due(state: dict) -> int | None:
    """When the state changes by itself: a ready loading when its newest event has settled, another one at its deadline."""
    return state["last"] + SETTLE_MS if ready(state) else state["deadline"]


def settle(state: dict, upto: int, strictly: bool) -> tuple[dict | None, list[tuple]]:
    """The state after everything that is due until ``upto`` and the rows ``(at, status, tries, left, res)`` of it; no state once
    the loading is READY or in ERROR.

    A deadline that finds some of the events keeps the loading waiting for another term while tries are left; one that finds none,
    or no try left, ends it with result -99.
    """
    out = []
    while (at := due(state)) is not None and (at < upto if strictly else at <= upto):
        if ready(state):
            return None, [*out, (at, "READY", state["tries"], state["left"], None)]
        if not state["come"] or state["left"] <= 0:
            return None, [*out, (at, "ERROR", state["tries"], state["left"], -99)]
        state = {**state, "tries": state["tries"] + 1, "left": state["left"] - 1, "deadline": at + state["expire"]}
        out.append((at, "EVENT-WAIT", state["tries"], state["left"], None))
    return state, out


def arrive(state: dict, at: int, event: str) -> dict:
    """The state after an event; events that are not awaited or older than the start do not count."""
    if event not in state["wanted"] or at < state["start"]:
        return state
    return {**state, "come": sorted({*state["come"], event}), "last": max(at, state["last"] or at)}


class Waits(_Keyed):
    def _finish(self, key, state: dict | None, out: list[tuple]) -> pd.DataFrame:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        if state is None:
            self.kept.clear()
        else:
            self.save(state)
            if (at := due(state)) is not None:
                self.handle.registerTimer(at)
        columns = list(zip(*out)) if out else [[]] * 5
        return pd.DataFrame({"loading_id": [key[0]] * len(out), "at": _times(columns[0]), "status": pd.Series(columns[1], dtype="object"), "tries": pd.Series(columns[2], dtype="Int32"),
                             "left": pd.Series(columns[3], dtype="Int32"), "res": pd.Series(columns[4], dtype="Int32")})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self.load({}) or None
        found = pd.concat(list(rows)).assign(ms=lambda f: _ms(f["at"])).sort_values(["ms", "kind"], kind="stable")
        out: list[tuple] = []
        for row in found.itertuples():
            if state is not None:
                state, more = settle(state, row.ms, strictly=True)
                out += more
            if row.kind == "start":
                state = state or begun(row.ms, row.strategy, list(row.wanted), int(row.expire_ms), int(row.left))
            elif state is not None:
                state = arrive(state, row.ms, row.event)
        yield self._finish(key, state, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.kept.exists():
            state, out = settle(self.load({}), expiredTimerInfo.getExpiryTimeInMs(), strictly=False)
            yield self._finish(key, state, out)


def waits(rows: DataFrame, lateness: str) -> DataFrame:
    """What becomes of waiting loadings: ``(loading_id, at, status, tries, left, res)``.

    The stream has rows ``(loading_id, kind, at, event, strategy, wanted, expire_ms, left)``: a ``start`` opens a wait (one that runs
    already goes on), a ``value`` is an event that has come for it. ``or`` needs one of the awaited events and never expires, ``and``
    needs all of them. READY comes when the newest event has been quiet for half an hour, EVENT-WAIT and ERROR at the deadlines.
    """
    with_state_store(rows.sparkSession)
    keyed = rows.withWatermark("at", lateness).groupBy("loading_id")
    return keyed.transformWithStateInPandas(Waits(), SETTLED, "append", "eventTime")


def addressed(values: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Stream rows for :func:`waits` out of values ``(event_id, owner, event, at)`` and the fixed table of ``subscriptions``
    ``(owner, loading_id, first_event, strategy, wanted, expire_ms, left)``; the first event of a subscription also starts its wait."""
    joined = values.join(subscriptions, "owner")
    kinds = F.when(F.col("event_id") == F.col("first_event"), F.array(F.lit("start"), F.lit("value"))).otherwise(F.array(F.lit("value")))
    return joined.select("loading_id", F.explode(kinds).alias("kind"), "at", "event", "strategy", "wanted", "expire_ms", "left")
