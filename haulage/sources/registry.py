"""The export registry: newest rows, validation, parameters and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Parameter defaults of an export (fixed values).
DEFAULTS = {
    "increment": "60",
    "selfrun_timeout": "60",
    "overlap": "0",
    "lower_bound": "",
    "time_field": "extract_time",
    "recent_interval": "60",
    "strategy": "FULL_UK",
    "notify_kafka": "1",
    "auto_confirm": "1",
    "confirm_timeout": "60",
    "export_timeout": "120",
    "notify_timeout": "30",
    "max_file_size": "",
    "send_empty": "0",
    "format": "TSVWithNames",
    "pg_array_format": "0",
    "csv_format_params": "",
    "xstream_sanitize": "0",
    "sanitize_array": "0",
    "sanitize_list": "",
}
DEFAULT_SCHEDULE = "55 0 * * *"

# Fields that may say ``default`` and then take the default row's value; the others never fall back (fixed values).
SHARED_FIELDS = ["compression_type", "compression_ext", "max_file_size", "sanitize_list", "csv_format_params"]
OWN_FIELDS = ["lower_bound", "selfrun_timeout", "xstream_sanitize", "sanitize_array", "pg_array_format"]


def newest(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """The row with the highest version per key, by a map-side combined aggregate instead of a sort."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*version)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def active_registry(registry: DataFrame) -> DataFrame:
    """Newest row per ``(db_name, extract_name)``, then the active ones: an inactive newest row hides older ones."""
    return newest(registry, ["db_name", "extract_name"], ["updated_at"]).where(F.col("is_active") == 1)


def checked_registry(active: DataFrame, routes: DataFrame, key: str = "replica") -> DataFrame:
    """Active rows with ``reject_reason`` (NULL for good rows) and their route columns."""
    known = routes.withColumn("_known", F.lit(True))
    joined = active.join(known, key, "left")
    reason = F.when(F.coalesce(F.col("sql_from"), F.lit("")) == "", "sql_from is empty").when(F.col("_known").isNull(), "unknown replica")
    return joined.withColumn("reject_reason", reason).drop("_known")


def valid_registry(active: DataFrame, routes: DataFrame) -> DataFrame:
    """The publishable rows; an empty result is an error so that a registry is never overwritten with nothing."""
    good = checked_registry(active, routes).where(F.col("reject_reason").isNull()).drop("reject_reason")
    if good.isEmpty():
        raise ValueError("no valid registry rows: nothing is published")
    return good


def with_schedule(active: DataFrame) -> DataFrame:
    """Empty schedules and parameters take their defaults."""
    return active.withColumn("schedule", F.coalesce(F.nullif(F.col("schedule"), F.lit("")), F.lit(DEFAULT_SCHEDULE))).withColumn(
        "params", F.coalesce(F.nullif(F.col("params"), F.lit("")), F.lit("{}")))


def described(active: DataFrame, comments: DataFrame) -> DataFrame:
    """Fill an empty description from table comments ``(db_name, extract_name, comment)``."""
    return active.join(comments, ["db_name", "extract_name"], "left").withColumn(
        "description", F.coalesce(F.nullif(F.col("description"), F.lit("")), F.col("comment"), F.lit(""))).drop("comment")


def spec_of(row) -> dict:
    """The statement spec of one registry row."""
    spec = {"from": row["sql_from"]}
    for field, name in (("sql_with", "with"), ("sql_join", "joins"), ("sql_where", "where"), ("sql_settings", "settings")):
        if row[field]:
            spec[name] = row[field]
    if row["fields"]:
        spec["fields"] = list(row["fields"])
    return spec


def merged_params(params: Column, overrides: Column | None = None) -> Column:
    """Registry JSON over the defaults, then run-time overrides; override values NULL, '' and 'None' do not count."""
    kind = "struct<" + ",".join(f"{name}:string" for name in DEFAULTS) + ">"
    own = F.from_json(F.coalesce(F.nullif(params, F.lit("")), F.lit("{}")), kind)
    run = F.from_json(F.coalesce(overrides, F.lit("{}")) if overrides is not None else F.lit("{}"), kind)

    def merge(both: Column) -> Column:
        def pick(name: str, default: str) -> Column:
            given = both["run"][name]
            return F.when(given.isNotNull() & ~given.isin("", "None"), given).otherwise(F.coalesce(both["own"][name], F.lit(default)))

        return F.struct(*[pick(n, d).alias(n) for n, d in DEFAULTS.items()])

    # Bound once through a one-element array, so that each text is parsed once and not once per parameter.
    return F.transform(F.array(F.struct(own.alias("own"), run.alias("run"))), merge)[0]


def with_fallback(registry: DataFrame, key: str = "extract_name", shared: list[str] = SHARED_FIELDS, own: list[str] = OWN_FIELDS,
                  default_key: str = "default") -> DataFrame:
    """Each registry row with its shared fields resolved: own value unless ``default``, then the default row's.

    The default row is one row; its values come in as scalar subqueries, so nothing is shuffled.
    """
    defaults = registry.where(F.col(key) == default_key)

    def resolved(name: str) -> Column:
        spare = defaults.agg(F.first(F.when(F.lower(F.col(name)) != "default", F.col(name)), ignorenulls=True)).scalar()
        return F.when(F.lower(F.col(name)) != "default", F.col(name)).otherwise(spare).alias(name)

    return registry.where(F.col(key) != default_key).select(key, *own, *[resolved(n) for n in shared])


def fallback_by_priority(rows: DataFrame, key: str, priority: str, shared: list[str], own: list[str]) -> DataFrame:
    """Same rule on a union of candidate rows: the value of the lowest priority that is not ``default``."""
    def first_of(name: str, cond: Column) -> Column:
        return F.min_by(F.when(cond, F.col(name)), F.when(cond, F.col(priority))).alias(name)

    return rows.groupBy(key).agg(
        *[first_of(n, F.col(priority) == 1) for n in own],
        *[first_of(n, F.lower(F.col(n)) != "default") for n in shared])


GATES = ["is_active", "optimize_exp_table", "auto_confirm_delta"]


def gated(registry: DataFrame) -> DataFrame:
    """The switches of every extract; one that is not set is off."""
    return registry.select("extract_name", *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in GATES])


def gates(registry: DataFrame, name: str) -> dict[str, bool]:
    """The switches of one extract, all off for an unknown one."""
    row = gated(registry.where(F.col("extract_name") == name)).first()
    return {f: bool(row[f]) if row else False for f in GATES}


def flow_of(file_name: Column) -> Column:
    """The third ``__`` part of a file name."""
    return F.split_part(file_name, F.lit("__"), F.lit(3))


def routed(df: DataFrame, routes: DataFrame, environment: str) -> DataFrame:
    """Attach ``(scenario, prefix, pool)`` by flow and environment; ``routes`` has an ``environment`` column."""
    mine = routes.where(F.col("environment") == environment).drop("environment")
    return df.withColumn("flow", flow_of(F.col("name_file"))).join(mine, "flow", "left")


def column_split(update: Column, load: Column, export: Column) -> Column:
    """Columns shared by all given statements and the extra ones of each; a NULL list is a missing statement."""
    base = F.coalesce(update, load, export)
    common = base
    for cols in (update, load, export):
        common = F.when(cols.isNull(), common).otherwise(F.filter(common, lambda c: F.array_contains(cols, c)))

    def extra(cols: Column) -> Column:
        return F.when(cols.isNotNull(), F.filter(cols, lambda c: ~F.array_contains(common, c)))

    return F.struct(common.alias("common"), extra(update).alias("update_extra"), extra(load).alias("load_extra"), extra(export).alias("export_extra"))


def selected_workflows(workflows: DataFrame, names: list[str], low: int = 999_999) -> DataFrame:
    """Workflows with an id above ``low``, id 0, or a wanted name."""
    return workflows.where((F.col("id") > low) | (F.col("id") == 0) | F.col("name").isin(names))


def missing_names(wanted: DataFrame, found: DataFrame) -> DataFrame:
    return wanted.join(found, "name", "left_anti")


def schedule_tag(scheduled: Column, archived: Column, has_events: Column, has_time: Column, has_condition: Column, has_files: Column) -> Column:
    """``CTL_``/``AF_`` plus event, time, condition or manual; ``AF_tfs-in`` and ``ARCHIVE`` come first."""
    kind = F.when(has_events, "event").when(has_time, "time").when(has_condition, "condition").otherwise("manual")
    return F.when(archived, "ARCHIVE").when(~scheduled & has_files, "AF_tfs-in").otherwise(
        F.concat(F.when(scheduled, "CTL_").otherwise("AF_"), kind))
