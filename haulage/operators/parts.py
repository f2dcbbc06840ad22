"""Size-bounded package parts, their manifest and their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulage.operators.ranges import running_sum
from haulage.session import spread, stored
from haulage.sinks.delimited import Dialect, PLAIN_TSV, header_line, line_bytes


def row_bytes(df: DataFrame, dialect: Dialect = PLAIN_TSV) -> Column:
    """Bytes of a row as a written line, escapes, quotes and line end included."""
    return (line_bytes(df.schema.fields, dialect) + len(dialect.lineterminator.encode())).cast("bigint")


def head_bytes(columns: list[str], dialect: Dialect = PLAIN_TSV) -> int:
    """Bytes of the header line of every part."""
    return len((header_line(columns, dialect) + dialect.lineterminator).encode())


def with_parts(df: DataFrame, order: list[str], max_bytes: int, size: Column | None = None, rows_per_range: int | None = None, head: int = 0) -> DataFrame:
    """Add ``part_no`` (from 0, may have gaps) and ``row_size``; no part with its header of ``head`` bytes is larger than
    ``max_bytes``.

    Rows are laid end to end in ``order`` (unique) and cut every ``max_bytes`` less header and widest row, so the row that
    crosses a cut still fits. Rows wider than the bound get a part of their own. Rows are measured once and stored with their size;
    a frame that has ``row_size`` already is taken as stored, and its manifest then needs the order columns and the size only.
    """
    sized = df if "row_size" in df.columns else stored(spread(df).withColumn("row_size", size if size is not None else row_bytes(df)), "sized-rows")
    stats = sized.agg(F.max("row_size").alias("widest"), F.count("*").alias("n")).first()
    stride = max(max_bytes - head - (stats.widest or 0), 1)
    laid = running_sum(sized, order, F.col("row_size"), "_end", rows_per_range, stats.n)
    return laid.withColumn("part_no", F.floor((F.col("_end") - F.col("row_size")) / F.lit(stride)).cast("bigint")).drop("_end")


def manifest(parts: DataFrame, head: int = 0) -> DataFrame:
    """``(part_no, part_index, part_total, n_rows, n_bytes)``; indexes are dense and start at 1, bytes are those written.

    The layout is computed once: what follows reads one stored row per part.
    """
    counts = stored(parts.groupBy("part_no").agg(F.count("*").alias("n_rows"), (F.sum("row_size") + head).alias("n_bytes")), "part-counts")
    total = counts.count()
    placed = running_sum(counts, ["part_no"], F.lit(1).cast("bigint"), "part_index", total=total)
    return placed.select("part_no", "part_index", F.lit(total).cast("bigint").alias("part_total"), "n_rows", "n_bytes")


def named_manifest(parts: DataFrame, schema: str, table: str, replica: str, stamp: str, ext: str = "csv", head: int = 0) -> DataFrame:
    """Names of the data, descriptor, ticket and archive of every part; lower case, one time stamp per package."""
    tail = F.format_string("%d_%d_%d", "part_index", "part_total", "n_rows")
    data = F.concat(F.lit(f"{schema}__{table}__{stamp}__"), tail)
    return manifest(parts, head).select(
        "*", F.lower(F.concat(data, F.lit(f".{ext}"))).alias("data_name"), F.lower(F.concat(data, F.lit(".meta"))).alias("meta_name"),
        F.lower(F.lit(f"{replica}__{stamp}.tkt")).alias("ticket_name"),
        F.lower(F.concat(F.lit(f"{replica}__{stamp}__{table}__"), tail, F.lit(".zip"))).alias("archive_name"))


def counted_name(key: Column, n_parts: Column, n_rows: Column, listed: bool = True) -> Column:
    """``name_parts_rows.ext`` for listed parts, ``name_rows.ext`` for a single file; every suffix is the extension."""
    ext = F.regexp_extract(key, r"[^./]((?:\.[^./]*)+)$", 1)
    stem = F.left(key, F.length(key) - F.length(ext))
    counts = F.format_string("_%d_%d", n_parts, n_rows) if listed else F.format_string("_%d", n_rows)
    return F.concat(stem, counts, ext)


def sent_names(pairs: Column) -> Column:
    """The counted names out of ``array<array<string>>`` pairs of name and counted name, as one flat list."""
    return F.flatten(F.transform(pairs, lambda p: F.slice(p, 2, 1)))


def empty_manifest(spark: SparkSession, schema: str, table: str, replica: str, stamp: str, ext: str = "csv") -> DataFrame:
    """The single header-only part ``0_1_0`` sent when there are no rows."""
    data = f"{schema}__{table}__{stamp}__0_1_0".lower()
    return spark.createDataFrame(
        [(0, 0, 1, 0, 0, f"{data}.{ext}", f"{data}.meta", f"{replica}__{stamp}.tkt".lower(), f"{replica}__{stamp}__{table}__0_1_0.zip".lower())],
        "part_no bigint, part_index bigint, part_total bigint, n_rows bigint, n_bytes bigint, data_name string, meta_name string, "
        "ticket_name string, archive_name string")


def package_manifest(parts: DataFrame, schema: str, table: str, replica: str, stamp: str, send_empty: bool, ext: str = "csv", head: int = 0) -> DataFrame:
    """The named manifest, or the header-only one when there are no rows and empty packages are sent."""
    named = named_manifest(parts, schema, table, replica, stamp, ext, head)
    return empty_manifest(parts.sparkSession, schema, table, replica, stamp, ext) if send_empty and named.isEmpty() else named


def tickets(named: DataFrame) -> DataFrame:
    """Ticket line of every part: ``data file;rows``."""
    return named.select("archive_name", "ticket_name", F.concat_ws(";", "data_name", F.col("n_rows").cast("string")).alias("line"))


def package_totals(named: DataFrame) -> DataFrame:
    return named.agg(F.coalesce(F.sum("n_rows"), F.lit(0).cast("bigint")).alias("total_rows"), F.count("*").alias("total_files"))
