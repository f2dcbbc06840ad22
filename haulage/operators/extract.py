"""Windowed extraction: which rows of a source go into a package, and how they look."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulage.functions import times as T

# Environments outside production, whose packages are samples (fixed values).
SAMPLED = ("uat", "qa", "ift", "dev")


def in_window(field: Column, start, end, kind: str = "timestamp_ntz") -> Column:
    """Open on the left, closed on the right. Constant bounds are pushed into the scan."""
    return (T.moment(start, kind) < field) & (field <= T.moment(end, kind))


def delta_window(df: DataFrame, field: str, start, end) -> DataFrame:
    return df.where(in_window(F.col(field), start, end, df.schema[field].dataType.simpleString()))


def recent_window(df: DataFrame, field: str, now, minutes: int) -> DataFrame:
    """The last ``minutes`` before ``now``, whole seconds; keeps no state."""
    kind = df.schema[field].dataType.simpleString()
    end = F.date_trunc("second", T.moment(now, kind)).cast(kind)
    return df.where(in_window(F.col(field), end - T.seconds(minutes * 60), end, kind))


def technical_columns(df: DataFrame, export_time, valid_from) -> DataFrame:
    """``export_time`` first, ``ctl_action`` and ``ctl_validfrom`` last."""
    return df.select(
        T.moment(export_time).alias("export_time"), "*",
        F.lit("I").alias("ctl_action"), T.moment(valid_from).alias("ctl_validfrom"))


def sampled(df: DataFrame, environment: str, rows: int | None, order: list[str]) -> DataFrame:
    """The first ``rows`` rows in the given order outside production, when a number is given; else all rows."""
    return df.orderBy(*order).limit(rows) if rows is not None and environment.strip().lower() in SAMPLED else df


def statement(spec: dict | str, lead: list[str] | None = None, tail: list[str] | None = None) -> str:
    """The SELECT of a spec ``{with, fields, from, joins, where, settings, tail}``; a text spec is used as it is.

    ``lead`` and ``tail`` are expressions put around the fields of a spec that does not list its own.
    """
    if isinstance(spec, str):
        return spec
    if "raw" in spec:
        return spec["raw"]
    fields = spec.get("fields") or ["*"]
    fields = [fields] if isinstance(fields, str) else list(fields)
    lines = [spec["with"]] if spec.get("with") else []
    lines.append("SELECT " + ", ".join([*(lead or []), *fields, *(tail or [])]))
    lines.append(f"FROM {spec['from']}")
    if spec.get("joins"):
        lines.append(spec["joins"])
    if spec.get("where"):
        lines.append(f"WHERE {spec['where']}")
    if spec.get("tail"):
        lines.append(spec["tail"])
    return "\n".join(lines)


def apply_settings(spark: SparkSession, settings: str | list[str] | None) -> dict[str, str]:
    """``name=value`` settings of a spec become session settings; names without a dot are not Spark's and are skipped."""
    items = settings.split(",") if isinstance(settings, str) else (settings or [])
    used = {}
    for item in items:
        name, eq, value = (x.strip() for x in item.partition("="))
        if eq and name.startswith("spark."):
            spark.conf.set(name, value)
            used[name] = value
    return used


def read_spec(spark: SparkSession, spec: dict | str, field: str, start, end, kind: str = "timestamp_ntz") -> DataFrame:
    """Run a spec over the session's tables with ``{condition}`` bound to the window.

    A spec without ``{condition}`` still gets the window, on its result.
    """
    if isinstance(spec, dict):
        apply_settings(spark, spec.get("settings"))
    text = statement(spec)
    lo, hi = f"CAST('{start}' AS {kind})", f"CAST('{end}' AS {kind})"
    if "{condition}" in text:
        return spark.sql(text.replace("{condition}", f"{lo} < {field} AND {field} <= {hi}"))
    return delta_window(spark.sql(text), field, start, end)


def staged(spark: SparkSession, columns: list[str], stages: dict[str, dict], field: str, start, end, name: str = "extract") -> DataFrame:
    """Up to three named statements over shared columns: ``update_exp`` → ``load_delta`` → ``export_delta``.

    Each stage sees the one before it as a view ``<name>_<stage>``; every stage may add ``extra_columns``.
    """
    out = None
    for stage in ("update_exp", "load_delta", "export_delta"):
        spec = stages.get(stage)
        if not spec:
            continue
        spec = spec if "raw" in spec else {**spec, "fields": [*spec.get("extra_columns", []), *columns]}
        text = statement(spec).replace("{condition}", f"CAST('{start}' AS timestamp_ntz) < {field} AND {field} <= CAST('{end}' AS timestamp_ntz)")
        out = spark.sql(text)
        out.createOrReplaceTempView(f"{name}_{stage}")
    if out is None:
        raise ValueError("no statement given")
    return out
