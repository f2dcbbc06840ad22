"""Named jobs: one function per workflow, run with parameters, giving one result row.

A job is ``fn(spark, params) -> DataFrame`` with the result columns ``res, msg, cdc, hub, stat`` (the missing ones are
NULL; ``hub`` and ``stat`` are JSON texts). What follows a result is data work again: its statistics and its outcome.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.operators import loadings as LD

RESULT = {"res": "int", "msg": "string", "cdc": "string", "hub": "string", "stat": "string"}
JOBS: dict[str, Callable[[SparkSession, dict], DataFrame]] = {}


def job(name: str):
    """Register a job under its workflow name."""
    def add(fn):
        JOBS[name] = fn
        return fn
    return add


def run_job(spark: SparkSession, name: str, params: dict, loading_id: int, entity_ids: list[int]) -> DataFrame:
    """The result rows of a job, for every entity of its workflow."""
    if name not in JOBS:
        raise KeyError(f"no job named {name!r}")
    result = JOBS[name](spark, params)
    shaped = result.select(*[(F.col(c) if c in result.columns else F.lit(None)).cast(kind).alias(c) for c, kind in RESULT.items()])
    entities = F.explode(F.array(*[F.lit(e).cast("bigint") for e in entity_ids])).alias("entity_id")
    return shaped.select(F.lit(loading_id).cast("bigint").alias("loading_id"), entities, *RESULT)


def finished(results: DataFrame, retry, abort_on_failure: bool = False) -> DataFrame:
    """Loading id with message, counters, next status and action; ``retry`` is the retry struct of the loading.

    A loading with several results is as good as the worst of them: one without a result, else the lowest.
    """
    one = results.groupBy("loading_id").agg(F.min(F.struct(F.col("res").isNotNull(), "res"))["res"].alias("res"))
    return one.select("loading_id", LD.outcome(F.col("res"), retry, F.lit(abort_on_failure)).alias("o")).select("loading_id", "o.*")
