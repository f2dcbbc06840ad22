"""A target table that batches are merged into without rewriting it.

Rows lie in buckets of their key's hash, and inside a bucket in files of consecutive keys. A small index knows the first and the
last key of every file, and a Bloom filter of its keys. A batch is looked up in the index by bucket, range and filter: only files
that may hold one of its keys are read, joined and replaced. Every merge is a new version of the index; rows of older versions stay
readable until ``vacuum``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from haulage.operators.apply import incremental, newest_per_key
from haulage.session import stored

#: Files of a bucket when a target is created, and small files of a bucket that are put together when it changes.
FILES_PER_BUCKET, SMALL_FILES = 16, 8
#: Bits of one filter (what Spark's bitmaps have), and keys that share it.
FILTER_BITS, KEYS_PER_FILTER = 32_768, 3_000


@dataclass
class Merged:
    """What a merge did; all zero for one that was done before."""

    version: int
    files_before: int = 0
    files_read: int = 0
    rows_read: int = 0
    rows_written: int = 0


class KeyedTarget:
    """Rows with one row per ``uk`` below ``root``. ``rows_per_file`` and ``buckets`` are fixed when the target is created."""

    def __init__(self, spark: SparkSession, root: str, uk: list[str]):
        self.spark, self.root, self.uk = spark, root.rstrip("/"), list(uk)
        self._known: tuple | None = None

    # --- content

    def create(self, rows: DataFrame, rows_per_file: int = 1_000_000) -> Merged:
        """Write ``rows``, unique by key, as the first version."""
        if self.version() is not None:
            raise ValueError(f"{self.root} holds a target already")
        rows = stored(rows, "keyed-rows")
        total = rows.count()
        buckets = max(1, math.ceil(total / (rows_per_file * FILES_PER_BUCKET)))
        rows.limit(0).write.mode("overwrite").parquet(f"{self.root}/schema")
        self.spark.createDataFrame([(buckets, rows_per_file)], "buckets int, rows_per_file long").write.mode("overwrite").parquet(f"{self.root}/layout")
        self._write(rows, 0, None)
        return Merged(0, rows_written=total)

    def version(self) -> int | None:
        """The newest whole version, None without one."""
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/files")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return None
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        done = [int(n) for n in names if n.isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.root}/files/{n}/_SUCCESS"))]
        return max(done, default=None)

    def files(self, version: int | None = None) -> DataFrame:
        """The index: ``(path, bucket, first, last, n_rows)``."""
        return self._index(self._of(version))

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows_of([r.path for r in self.files(version).select("path").collect()])

    def merge(self, batch: DataFrame, version: int | None = None) -> Merged:
        """Apply a batch with ``ctl_action`` and ``ctl_validfrom`` by the rule ``INC``, as ``incremental`` does it.

        ``version`` numbers the merges of a stream: one that is there already is not done again.
        """
        now = self._of(None)
        version = now + 1 if version is None else version
        if version <= now:
            return Merged(now)
        index = self._index(now)
        changes = stored(newest_per_key(batch, self.uk), "keyed-batch")
        touched = stored(self._touched(changes, index), "keyed-touched")
        found = touched.collect()
        old = self._rows_of([r.path for r in found])
        self._write(incremental(old, changes.select(old.columns), self.uk), version, index.join(touched, "path", "left_anti"))
        size = F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n")
        before, rows_read = index.agg(size, F.count("*").alias("files")).first(), sum(r.n_rows for r in found)
        return Merged(version, before.files, len(found), rows_read, self._index(version).agg(size).first().n - before.n + rows_read)

    def vacuum(self, keep: int = 1) -> int:
        """Remove files that none of the last ``keep`` versions needs, and the indexes of the versions before; returns the files removed."""
        import pandas as pd

        newest = self._of(None)
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/files")
        fs = folder.getFileSystem(conf)
        versions = sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit())
        old = [v for v in versions if v <= newest - keep]
        if not old:
            return 0
        paths = lambda which: self._index(*which).select("path").distinct()
        gone = paths(old).join(paths([v for v in versions if v not in old]), "path", "left_anti")

        def remove(batches):
            from pyarrow import fs as arrow

            for frame in batches:
                for path in frame["path"]:
                    system, inner = arrow.FileSystem.from_uri(path)
                    if system.get_file_info(inner).type != arrow.FileType.NotFound:
                        system.delete_file(inner)
                yield pd.DataFrame({"path": frame["path"]})

        removed = stored(gone.mapInPandas(remove, "path string"), "keyed-gone").count()
        for v in old:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.root}/files/{v}"), True)
        return removed

    # --- layout

    def _of(self, version: int | None) -> int:
        version = self.version() if version is None else version
        if version is None:
            raise ValueError(f"no target at {self.root}")
        return version

    def _layout(self) -> tuple:
        """Buckets, rows of a file, and the columns."""
        if self._known is None:
            made = self.spark.read.schema("buckets int, rows_per_file long").parquet(f"{self.root}/layout").first()
            self._known = (made.buckets, made.rows_per_file, self.spark.read.parquet(f"{self.root}/schema").schema)
        return self._known

    def _index(self, *versions: int) -> DataFrame:
        schema = self._layout()[2]
        key = T.StructType([schema[k] for k in self.uk])
        fields = [("path", T.StringType()), ("bucket", T.IntegerType()), ("first", key), ("last", key), ("n_rows", T.LongType())]
        return self.spark.read.schema(T.StructType([T.StructField(*f) for f in fields])).parquet(*[f"{self.root}/files/{v}" for v in versions])

    def _rows_of(self, paths: list[str]) -> DataFrame:
        schema = self._layout()[2]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _hash(self, salt: str) -> Column:
        return F.xxhash64(F.lit(salt), *self.uk)

    def _key(self) -> Column:
        return F.struct(*self.uk)

    def _places(self, rows_per_file: int) -> list[Column]:
        """Filter of a key inside its file, and its two bits there."""
        filters = max(1, math.ceil(rows_per_file / KEYS_PER_FILTER))
        return [F.pmod(self._hash("filter"), F.lit(filters)).cast("int").alias("part"), F.pmod(self._hash("one"), F.lit(FILTER_BITS)).alias("one"), F.pmod(self._hash("two"), F.lit(FILTER_BITS)).alias("two")]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(self._hash("bucket"), F.lit(buckets)).cast("int")

    def _touched(self, changes: DataFrame, index: DataFrame) -> DataFrame:
        """``(path, n_rows)`` of the files that may hold a key of the batch, and of the small files of buckets that have too many."""
        buckets, rows_per_file, _ = self._layout()
        asked = changes.select(self._bucket(buckets).alias("bucket"), self._key().alias("key"), *self._places(rows_per_file))
        near = asked.join(index, "bucket").where((F.col("first") <= F.col("key")) & (F.col("key") <= F.col("last")))
        filters = self.spark.read.schema("path string, part int, bits binary").parquet(f"{self.root}/filters")
        bit = lambda place: F.call_function("shiftright", F.conv(F.hex(F.substring("bits", F.floor(F.col(place) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int"), (F.col(place) % 8).cast("int")).bitwiseAND(1) == 1
        hit = near.join(filters, ["path", "part"]).where(bit("one") & bit("two")).select("path", "n_rows")
        small = index.where(F.col("n_rows") * 2 < rows_per_file)
        crowded = small.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") >= SMALL_FILES).join(asked.select("bucket").distinct(), "bucket", "left_semi")
        return hit.union(small.join(crowded, "bucket", "left_semi").select("path", "n_rows")).distinct()

    def _write(self, rows: DataFrame, version: int, kept: DataFrame | None) -> None:
        """Write rows as new files, their filters, and last the index, which makes the version."""
        buckets, rows_per_file, _ = self._layout()
        folder = f"{self.root}/rows/{version}"
        placed = rows.withColumn("_bucket", self._bucket(buckets)).repartition("_bucket").sortWithinPartitions("_bucket", *self.uk)
        placed.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("_bucket").parquet(folder)
        # File names come percent-encoded; a plus sign stands for itself.
        path = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B")).alias("path")
        keys = self.spark.read.schema(rows.schema).parquet(folder).select(path, *self.uk)
        bits = keys.select("path", *self._places(rows_per_file)).select("path", "part", F.explode(F.array("one", "two")).alias("bit"))
        bits.groupBy("path", "part").agg(F.bitmap_construct_agg("bit").alias("bits")).write.mode("overwrite").parquet(f"{self.root}/filters/version={version}")
        fresh = keys.groupBy("path").agg(F.first(self._bucket(buckets)).alias("bucket"), F.min(self._key()).alias("first"), F.max(self._key()).alias("last"), F.count("*").alias("n_rows"))
        fresh = fresh.select("path", "bucket", "first", "last", "n_rows")
        (fresh if kept is None else kept.select(fresh.columns).unionByName(fresh)).write.mode("overwrite").parquet(f"{self.root}/files/{version}")
