"""Schema descriptors of a package."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as PT

DESCRIPTOR = "position int, column_name string, source_type string, length int, notnull boolean, precision int, scale int, description string"

# Type names in a package by Spark type (fixed values); anything else is STRING.
PACKAGE_TYPES = {
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "string": "STRING",
    "tinyint": "INT",
    "smallint": "INT",
    "int": "INT",
    "bigint": "BIGINT",
    "float": "FLOAT",
    "double": "DOUBLE",
}
BEFORE = [("export_time", "TIMESTAMP", None)]
AFTER = [("ctl_action", "VARCHAR", 10), ("ctl_validfrom", "TIMESTAMP", None)]


def package_type(kind: PT.DataType) -> tuple[str, int | None, int | None, int | None]:
    """``(type, length, precision, scale)`` of a Spark type."""
    if isinstance(kind, PT.DecimalType):
        if kind.precision == 20 and kind.scale == 0:
            return "BIGINT", None, None, None
        return "NUMERIC", kind.precision, kind.precision, kind.scale
    if isinstance(kind, PT.CharType):
        return "STRING", kind.length, None, None
    return PACKAGE_TYPES.get(kind.simpleString(), "STRING"), None, None, None


def engine_keywords(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT lower(keyword) AS word FROM sql_keywords()")


def reserved_names(spark: SparkSession, names: list[str], words=None) -> set[str]:
    """Which of the names are reserved. ``words`` is the receiver's list; the engine's keyword table by default."""
    table = engine_keywords(spark) if words is None else spark.createDataFrame([(w.lower(),) for w in words], "word string")
    wanted = spark.createDataFrame([(n, n.lower()) for n in names], "name string, word string")
    return {r.name for r in wanted.join(table, "word", "left_semi").collect()}


def renamed(df: DataFrame, words=None) -> DataFrame:
    """Append ``_`` to reserved column names, in the data and therefore in every header made from it."""
    taken = reserved_names(df.sparkSession, df.columns, words)
    return df.withColumnsRenamed({c: f"{c}_" for c in taken})


def descriptor(df: DataFrame, comments: DataFrame | None = None, words=None, calculated: dict[str, str] | None = None) -> DataFrame:
    """One row per package column: technical, data, technical.

    Types come from the analyzed result. ``comments (column_name, comment)`` fill descriptions by name; columns
    computed by an expression are listed in ``calculated`` as name → expression.
    """
    spark = df.sparkSession
    calculated = calculated or {}
    taken = reserved_names(spark, df.columns, words)
    rows = [(0, n, n, t, ln, False, None, None, None) for n, t, ln in BEFORE]
    for f in df.schema:
        kind, length, precision, scale = package_type(f.dataType)
        note = f.metadata.get("comment") or (f"Calculated: {calculated[f.name]}" if f.name in calculated else None)
        rows.append((len(rows), f.name, f"{f.name}_" if f.name in taken else f.name, kind, length, not f.nullable, precision, scale, note))
    rows += [(len(rows) + i, n, n, t, ln, False, None, None, None) for i, (n, t, ln) in enumerate(AFTER)]
    out = spark.createDataFrame(
        rows, "position int, _raw string, column_name string, source_type string, length int, notnull boolean, precision int, scale int, description string")
    if comments is not None:
        out = out.join(comments.select(F.col("column_name").alias("_raw"), F.col("comment").alias("_comment")), "_raw", "left").withColumn(
            "description", F.coalesce("description", F.nullif(F.col("_comment"), F.lit(""))))
    return out.select("position", "column_name", "source_type", "length", "notnull", "precision", "scale", "description")


def meta_json(columns: DataFrame, schema_name: str, table: str, strategy: str, pk: list[str], uk: list[str], description: str | None = None) -> str:
    """The ``.meta`` text of a package; the descriptor has one row per column and is small by nature."""
    fields = ["column_name", "source_type", "length", "notnull", "precision", "scale", "description"]
    return json.dumps({
        "mask_file": None, "schema_name": schema_name, "table_name": table, "description": description or None,
        "strategy": strategy, "PK": pk, "UK": uk, "params": {"separation": "\t"},
        "columns": [{f: r[f] for f in fields} for r in columns.orderBy("position").collect()],
    }, ensure_ascii=False)
