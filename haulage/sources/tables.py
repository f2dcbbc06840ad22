"""Tables: databases, copies and catalog comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def read_jdbc(spark: SparkSession, url: str, table: str, column: str, lower, upper, partitions: int, **options: str) -> DataFrame:
    """A database table or ``(query) alias`` read by ``partitions`` tasks, split on a numeric or time column."""
    return (
        spark.read.format("jdbc").option("url", url).option("dbtable", table).option("partitionColumn", column)
        .option("lowerBound", str(lower)).option("upperBound", str(upper)).option("numPartitions", str(partitions)).options(**options).load())


def write_jdbc(df: DataFrame, url: str, table: str, truncate: bool = False, **options: str) -> None:
    mode = "overwrite" if truncate else "append"
    df.write.format("jdbc").option("url", url).option("dbtable", table).option("truncate", str(truncate).lower()).options(**options).mode(mode).save()


def copy_table(source: DataFrame, target: str, truncate: bool = True, as_text: bool = False) -> DataFrame:
    """Copy a frame to the table at ``target`` and return the count check; ``as_text`` lands every column as text."""
    spark = source.sparkSession
    rows = all_text(source) if as_text else source
    before = 0 if truncate else _rows_at(spark, target)
    seen = Observation("copy_table")
    # The rows of the source are counted in the pass that copies them.
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite" if truncate else "append").parquet(target)
    landed = spark.read.schema(rows.schema).parquet(target).agg((F.count("*") - before).alias("target_rows"))
    return landed.select(F.lit(int(seen.get["n"])).cast("bigint").alias("source_rows"), "target_rows", (F.col("target_rows") == int(seen.get["n"])).alias("is_equal"))


def _rows_at(spark: SparkSession, path: str) -> int:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path).count()
    except AnalysisException:
        return 0


def all_text(df: DataFrame) -> DataFrame:
    """Every column as text; arrays in the bracket form."""
    from haulage.functions.text import arrays_as_text

    flat = arrays_as_text(df, "ch")
    return flat.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in flat.columns])


def export_table(source: DataFrame, path: str, fmt: str = "CSV", compression: str = "none") -> None:
    """A table or query result as files: ``CSV``, ``TSVWithNames`` or ``JSON``; codec ``none`` or ``gzip``."""
    from haulage.functions.text import arrays_as_text

    codec = "uncompressed" if compression in ("none", "", None) else compression
    if fmt == "JSON":
        source.write.mode("overwrite").option("compression", codec).option("ignoreNullFields", "false").json(path)
        return
    flat = arrays_as_text(source, "ch")
    writer = flat.write.mode("overwrite").option("header", "true").option("compression", codec).option("quote", '"').option("escape", '"')
    writer.option("sep", "\t" if fmt == "TSVWithNames" else ",").csv(path)


def truncate_and_load(df: DataFrame, path: str) -> int:
    """Replace a delta table and return its row count from the same pass."""
    from pyspark.sql import Observation

    seen = Observation("truncate_and_load")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return int(seen.get["n"])


def catalog_comments(spark: SparkSession, database: str) -> DataFrame:
    """``(db_name, extract_name, comment)`` of the session catalog's tables."""
    rows = [(database, t.name, t.description or "") for t in spark.catalog.listTables(database) if not t.isTemporary]
    return spark.createDataFrame(rows, "db_name string, extract_name string, comment string")


def comments_for(pairs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Comments of the wanted ``(db_name, extract_name)`` pairs, empty where there is none."""
    return pairs.join(catalog, ["db_name", "extract_name"], "left").withColumn("comment", F.coalesce("comment", F.lit("")))
