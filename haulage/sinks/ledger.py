"""Load ledger, file routing and switched tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.functions import paths as P, text as X, times as T


def ledger_rows(files: DataFrame, loaded_at, archive: str = "tfs-archive", errors: str = "tfs-errors") -> DataFrame:
    """Where each file ``(path, n_rows, failed)`` goes after its load: its whole key below the archive or the error prefix, with
    the time in the name. Of a URI the key is what follows the bucket or host.
    """
    name = F.regexp_replace(F.regexp_replace("path", r"^(?:file:/*|[^:/]+://[^/]*/+)", ""), "^/+", "")
    ext = F.regexp_extract(P.base_name(name), r"[^.](\.[^.]*)$", 1)
    stem = F.left(name, F.length(name) - F.length(ext))
    at = T.moment(loaded_at)
    prefix = F.when(F.col("failed"), F.lit(errors)).otherwise(F.lit(archive))
    return files.select(
        "path", X.table_from_file(F.col("path")).alias("table_name"), F.when(F.col("failed"), "failed").otherwise("loaded").alias("status"),
        F.when(F.col("failed"), F.lit(0).cast("bigint")).otherwise(F.col("n_rows")).alias("n_rows"),
        F.concat(prefix, F.lit("/"), stem, F.lit(" "), T.clock_text(at), ext).alias("new_path"), at.alias("loaded_at"))


def append_audit(payloads: DataFrame, path: str) -> None:
    """Keep API payloads ``(url, body)``."""
    payloads.select("url", "body").write.mode("append").json(path)


class SwitchedTable:
    """A table kept twice, as ``_0`` and ``_1``, with a pointer to the readable copy.

    A load replaces the other copy, checks its count and only then moves the pointer in one rename.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm

    def active(self) -> int | None:
        fs, jvm = self._fs()
        pointer = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_active")
        if not fs.exists(pointer):
            return None
        stream = fs.open(pointer)
        try:
            return int(chr(stream.read()))
        finally:
            stream.close()

    def read(self) -> DataFrame:
        side = self.active()
        if side is None:
            raise ValueError(f"nothing loaded at {self.root}")
        return self.spark.read.parquet(f"{self.root}/_{side}")

    def load(self, df: DataFrame, expected: int | None = None) -> int:
        """Replace the table's content; returns the rows loaded. A wrong count leaves the old content in place."""
        from haulage.sources.tables import truncate_and_load

        side = 1 - (self.active() or 0) if self.active() is not None else 0
        rows = truncate_and_load(df, f"{self.root}/_{side}")
        if expected is not None and rows != expected:
            raise ValueError(f"{rows} rows loaded, {expected} expected")
        fs, jvm = self._fs()
        fresh = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_active.new")
        out = fs.create(fresh, True)
        out.write(ord(str(side)))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
        rename = getattr(jvm, "org.apache.hadoop.fs.Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(fresh, jvm.org.apache.hadoop.fs.Path(f"{self.root}/_active"), options)
        return rows
