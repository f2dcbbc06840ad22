"""Files: listings, gated arrival, delimited loads, archives and heads."""

from __future__ import annotations

import io
import math
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as PT

from haulage.functions import paths as P, text as X
from haulage.session import dealt_by, stored
from haulage.sinks.delimited import Dialect, FOREIGN_CSV, records_of

DONE = ".done"
RECORDS_PER_BATCH = 5_000
LISTED_PER_BATCH = MEMBERS_PER_BATCH = 10_000
# Unpacked bytes of archive members that are worth a task.
BYTES_PER_TASK = 128 << 20
# Lines of one file that stay together where its lines meet what is known of the file.
LINES_PER_BLOCK = 10_000


def listing(spark: SparkSession, root: str) -> DataFrame:
    """``(path, modificationTime, length)`` of all files below ``root``, empty marker files included.

    The file sources of Spark leave out empty files, and a marker is one. Folders are listed level by level, each folder
    by a task of its own and its files in slices; hidden files (``_`` or ``.`` in front, but for ``.done``) are left out.
    """
    from pyarrow import fs

    _, inner = fs.FileSystem.from_uri(root)
    head = _uri_head(root)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, _ = fs.FileSystem.from_uri(root)
        for batch in batches:
            for folder in batch["folder"]:
                found = source.get_file_info(fs.FileSelector(folder))
                found = [i for i in found if i.type == fs.FileType.Directory or i.type == fs.FileType.File and (i.base_name == DONE or i.base_name[:1] not in "_.")]
                for at in range(0, len(found), LISTED_PER_BATCH):
                    part = found[at:at + LISTED_PER_BATCH]
                    yield pd.DataFrame({"path": [i.path for i in part], "is_folder": [i.type == fs.FileType.Directory for i in part],
                                        "modificationTime": pd.to_datetime([i.mtime for i in part], utc=True), "length": [i.size or 0 for i in part]})

    level, files = spark.createDataFrame([(inner,)], "folder string"), None
    while True:
        found = stored(level.repartition("folder").mapInPandas(walk, "path string, is_folder boolean, modificationTime timestamp, length long"), "listing")
        own = found.where(~F.col("is_folder")).select(F.concat(F.lit(head), "path").alias("path"), "modificationTime", "length")
        files = own if files is None else files.unionByName(own)
        level = found.where("is_folder").select(F.col("path").alias("folder"))
        if level.isEmpty():
            return files


def _uri_head(root: str) -> str:
    """What stands before the inner path of a file system: nothing of it is lost when paths are put together again."""
    from urllib.parse import urlparse

    parts = urlparse(root)
    if parts.scheme in ("", "file"):
        return "file:"
    return f"hdfs://{parts.netloc}" if parts.scheme in ("hdfs", "viewfs") else f"{parts.scheme}://"


def matching(objects: DataFrame, mask: str, path: str = "path", cap: int | None = None) -> DataFrame:
    """Objects that match a mask, without folders and ``.error`` objects; with a cap the first ones."""
    name = F.col(path)
    out = objects.where(X.matches_glob(name, mask) & ~name.endswith("/") & ~name.endswith(".error"))
    return out.orderBy(path).limit(cap) if cap else out


def done_gated(objects: DataFrame, path: str = "path") -> DataFrame:
    """Data files whose marker ``<file>.done`` exists. The listing is read once: file and marker meet in one group of two."""
    marker = F.col(path).endswith(DONE)
    pairs = objects.groupBy(F.regexp_replace(path, r"\.done$", "").alias("_base")).agg(
        F.bool_or(marker).alias("_marked"), F.max(F.when(~marker, F.struct(*objects.columns))).alias("_file"))
    return pairs.where(F.col("_marked") & F.col("_file").isNotNull()).select("_file.*")


def folder_gated(objects: DataFrame, path: str = "path") -> DataFrame:
    """Data files whose folder holds a ``.done`` marker."""
    folder = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    markers = objects.where(F.col(path).endswith("/" + DONE)).select(folder.alias("_folder")).distinct()
    return objects.where(~F.col(path).endswith(DONE)).join(markers, folder == F.col("_folder"), "left_semi")


def used_markers(loaded: DataFrame, path: str = "path") -> DataFrame:
    """Markers to remove after their files were loaded."""
    return loaded.select(F.concat(F.col(path), F.lit(DONE)).alias("marker"))


def sorted_listing(objects: DataFrame, by: str = "Date", reverse: bool = False, items: int | None = None) -> DataFrame:
    """Objects by Date, Size, Key, Name or Ext, the first ``items`` on request; the key settles ties."""
    keys = {"Date": F.col("modificationTime"), "Size": F.col("length"), "Key": F.col("path"),
            "Name": P.base_name(F.col("path")), "Ext": X.last_segment(F.col("path"), ".")}
    key = keys[by]
    ordered = objects.orderBy(key.desc() if reverse else key.asc(), "path")
    return ordered if items is None else ordered.limit(items)


def oldest_first(objects: DataFrame, cap: int | None = None, newest: bool = False) -> DataFrame:
    """Files to take, by modification time; with a cap those of one cycle."""
    at = F.col("modificationTime")
    ordered = objects.orderBy(at.desc() if newest else at.asc(), "path")
    return ordered if cap is None else ordered.limit(cap)


def first_source(sources: list[DataFrame], cap: int | None = None) -> DataFrame | None:
    """Files of the first source that has any."""
    for objects in sources:
        if not objects.isEmpty():
            return oldest_first(objects, cap)
    return None


def csv_options(options: str | None = None) -> dict[str, str]:
    """Reader options of a load text such as ``CSV HEADER DELIMITER ';' QUOTE '"' NULL ''``."""
    text = options or "CSV HEADER DELIMITER ','"
    words, found = text.replace("\t", "\\t").split(" "), {"header": "false", "sep": ","}
    names = {"DELIMITER": "sep", "QUOTE": "quote", "ESCAPE": "escape", "NULL": "nullValue", "ENCODING": "encoding"}
    for i, word in enumerate(words):
        if word.upper() == "HEADER":
            found["header"] = "true"
        elif word.upper() in names and i + 1 < len(words):
            value = words[i + 1].strip()
            value = value[1:] if value.upper().startswith("E'") else value
            found[names[word.upper()]] = value.strip("'").replace("\\t", "\t")
    return found


def load_csv(spark: SparkSession, source: str | list[str], schema: str | PT.StructType, target: str, options: str | None = None,
             truncate: bool = False) -> int:
    """Load plain or gzip delimited files into the table at ``target``; returns the rows written, from the same pass."""
    rows = spark.read.schema(schema).options(**csv_options(options)).option("mode", "FAILFAST").csv(source)
    seen = Observation("load_csv")
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite" if truncate else "append").parquet(target)
    return int(seen.get["n"])


def parse_files(spark: SparkSession, source: str | list[str], schema: PT.StructType, options: str | None = None) -> DataFrame:
    """Rows of many files with ``_file`` and ``_corrupt``; a broken line is marked instead of failing the read."""
    wide = PT.StructType([*schema.fields, PT.StructField("_corrupt", PT.StringType())])
    reader = spark.read.schema(wide).options(**csv_options(options)).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_corrupt").option("columnPruning", "false")
    # File names come percent-encoded; a plus sign stands for itself.
    name = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    return reader.csv(source).select("*", name.alias("_file"))


def load_files(spark: SparkSession, source: str | list[str], schema: PT.StructType, target: str, loaded_at, options: str | None = None,
               truncate: bool = False, archive: str = "tfs-archive", errors: str = "tfs-errors") -> DataFrame:
    """Load every intact file and return the ledger ``(path, table_name, status, n_rows, new_path, loaded_at)``.

    A file with a broken line is not loaded at all and goes to the error prefix. The texts are parsed once; the
    ledger and the load read the parsed copy.
    """
    from haulage.sinks.ledger import ledger_rows

    rows = stored(parse_files(spark, source, schema, options), "parsed-files")
    per_file = rows.groupBy("_file").agg(F.count("*").alias("n_rows"), F.count("_corrupt").alias("n_bad"))
    ledger = ledger_rows(per_file.select(F.col("_file").alias("path"), "n_rows", (F.col("n_bad") > 0).alias("failed")), loaded_at, archive, errors)
    good = per_file.where(F.col("n_bad") == 0).select("_file")
    rows.join(good, "_file", "left_semi").select(*schema.fieldNames()).write.mode("overwrite" if truncate else "append").parquet(target)
    return ledger


def load_by_name(spark: SparkSession, objects: DataFrame, schemas: dict[str, PT.StructType], root: str, loaded_at, options: str | None = None,
                 truncate: bool = False) -> DataFrame:
    """Load listed files into tables named after the files; one read per table. Returns the ledger of all files: files of
    a table that is not in ``schemas`` are failed ones, like files with a broken line.
    """
    from haulage.sinks.ledger import ledger_rows

    named = objects.withColumn("table_name", X.table_from_file(F.col("path")))
    strange = named.where(F.col("table_name").isNull() | ~F.col("table_name").isin(*schemas)).select("path", F.lit(0).cast("bigint").alias("n_rows"), F.lit(True).alias("failed"))
    out = ledger_rows(strange, loaded_at)
    for table, schema in schemas.items():
        # Spark's own file index holds the paths of a read on the driver as well.
        files = [r.path for r in named.where(F.col("table_name") == table).select("path").collect()]
        if files:
            out = out.unionByName(load_files(spark, files, schema, f"{root}/{table}", loaded_at, options, truncate))
    return out


def _open(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _members(path: str):
    import zipfile

    archive = zipfile.ZipFile(_open(path), metadata_encoding="cp866")
    return archive, [m for m in archive.infolist() if not m.is_dir() and m.filename.strip("/")]


INDEX = "path string, member string, length long, packed long, start long, method int, crc long"


def zip_index(objects: DataFrame) -> DataFrame:
    """Where every archive member lies: ``(path, member, length, packed, start, method, crc)``; directories are left out.

    Only the central directory at the end of each archive is read. ``start`` is the first byte of the member's local header.
    """
    def list_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                archive, members = _members(path)
                with archive:
                    for at in range(0, len(members), MEMBERS_PER_BATCH):
                        some = members[at:at + MEMBERS_PER_BATCH]
                        if any(m.flag_bits & 1 for m in some):
                            raise ValueError(f"{path} has encrypted members")
                        yield pd.DataFrame({
                            "path": [path] * len(some), "member": [m.filename.strip("/") for m in some], "length": [m.file_size for m in some], "packed": [m.compress_size for m in some],
                            "start": [m.header_offset for m in some], "method": [m.compress_type for m in some], "crc": [m.CRC for m in some]})
    return dealt_by(objects.select("path"), "path").mapInPandas(list_members, INDEX)


def zip_contents(objects: DataFrame) -> DataFrame:
    """Table of contents of zip files: ``(path, member, length)``."""
    return zip_index(objects).select("path", "member", "length")


class _Member(io.RawIOBase):
    """One archive member as a stream, read from its own byte range; the checksum is compared at its end."""

    # Size of a local header, where the lengths of its name and extra field stand, and the two methods (fixed values).
    HEADER, NAME_AT, STORED, DEFLATED = 30, 26, 0, 8

    def __init__(self, source, start: int, packed: int, method: int, crc: int):
        if method not in (self.STORED, self.DEFLATED):
            raise ValueError(f"compression method {method} is not supported")
        source.seek(start)
        header = source.read(self.HEADER)
        if header[:4] != b"PK\x03\x04":
            raise ValueError("no archive member at this place")
        lengths = [int.from_bytes(header[at:at + 2], "little") for at in (self.NAME_AT, self.NAME_AT + 2)]
        source.seek(start + self.HEADER + sum(lengths))
        self.source, self.left, self.crc, self.seen = source, packed, crc, 0
        self.unpack = zlib.decompressobj(-zlib.MAX_WBITS) if method == self.DEFLATED else None

    def readable(self) -> bool:
        return True

    def _more(self, size: int) -> bytes:
        if self.unpack is None:
            data = self.source.read(min(size, self.left))
            self.left -= len(data)
            return data
        while True:
            given = self.unpack.unconsumed_tail
            if not given and self.left:
                given = self.source.read(min(1 << 20, self.left))
                self.left -= len(given)
                if not given:
                    raise EOFError("the archive ends inside a member")
            data = self.unpack.decompress(given, size)
            if data or self.unpack.eof or not (self.left or self.unpack.unconsumed_tail):
                return data

    def readinto(self, buffer) -> int:
        data = self._more(len(buffer))
        self.seen = zlib.crc32(data, self.seen)
        if not data and self.seen != self.crc:
            raise ValueError("an archive member is damaged")
        buffer[:len(data)] = data
        return len(data)


def zip_records(objects: DataFrame, dialect: Dialect = FOREIGN_CSV, encoding: str = "utf-8") -> DataFrame:
    """Delimited records of all archive members: ``(path, member, record_no, fields)``.

    ``dialect`` is the one the members were written in, see :mod:`haulage.sinks.delimited`. Members are dealt out one by one, so
    that many tasks read one archive, each its own byte ranges. A task streams one member after another, a batch of records at a
    time; line breaks that are quoted or escaped stay inside a field of any length.
    """
    index = stored(zip_index(objects), "zip-index")
    total = index.agg(F.count("*").alias("n"), F.sum("length").alias("bytes")).first()
    cores = objects.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(total.n, 1), max(cores, math.ceil((total.bytes or 0) / BYTES_PER_TASK)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import gzip
        from itertools import islice

        names = ["path", "member", "record_no", "fields"]
        for batch in batches:
            for m in batch.to_pylist():
                with _open(m["path"]) as source:
                    raw = io.BufferedReader(_Member(source, m["start"], m["packed"], m["method"], m["crc"]), 1 << 20)
                    stream = gzip.GzipFile(fileobj=raw) if m["member"].lower().endswith(".gz") else raw
                    records = records_of(io.TextIOWrapper(stream, encoding=encoding, newline=""), dialect)
                    start = 0
                    while found := list(islice(records, RECORDS_PER_BATCH)):
                        n = len(found)
                        yield pa.RecordBatch.from_arrays([
                            pa.array([m["path"]] * n, pa.string()), pa.array([m["member"]] * n, pa.string()), pa.array(range(start, start + n), pa.int64()),
                            pa.array(found, pa.list_(pa.string()))], names)
                        start += n

    return index.repartition(tasks, "path", "member").mapInArrow(read, "path string, member string, record_no long, fields array<string>")


def typed_records(records: DataFrame, schema: PT.StructType, header: bool = True) -> DataFrame:
    """Archive records as typed columns; an empty text is NULL."""
    rows = records.where(F.col("record_no") > 0) if header else records
    return rows.select(*[F.nullif(F.get("fields", F.lit(i)), F.lit("")).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)])


def text_lines(spark: SparkSession, source: str | list[str]) -> DataFrame:
    """``(path, line_no, value)`` of text files, plain or gzip, counted from 0 inside each file.

    A plain file of any size is read in splits. A first pass counts the lines of each split; the sums over the splits before it are
    what its own line numbers are moved by. Lines end with a line feed, a carriage return before it is not part of them.
    """
    # Rows of a split follow each other in one task, so their running ids do too; both passes read the same splits.
    lines = spark.read.option("lineSep", "\n").text(source).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_split"), "value", F.monotonically_increasing_id().alias("_id"))
    splits = lines.groupBy("path", "_split").agg(F.count("*").alias("n"), F.min("_id").alias("_first"))
    # One row per split.
    before = F.sum("n").over(Window.partitionBy("path").orderBy("_split")) - F.col("n")
    offsets = stored(splits.select("path", "_split", (before - F.col("_first")).alias("_shift")), "line-offsets")
    return lines.join(offsets, ["path", "_split"]).select("path", (F.col("_id") + F.col("_shift")).alias("line_no"), F.regexp_replace("value", "\r$", "").alias("value"))


def head(objects: DataFrame, lines: int, encoding: str = "utf-8") -> DataFrame:
    """The first ``lines`` lines of every listed file, plain or gzip: ``(path, line_no, value)``.

    A task opens one file after another and stops reading where the wanted lines end, whatever the size of the file.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip
        import io
        from itertools import islice

        for batch in batches:
            for path in batch["path"]:
                raw = _open(path)
                stream = gzip.GzipFile(fileobj=raw) if path.lower().endswith(".gz") else raw
                with io.TextIOWrapper(stream, encoding=encoding, errors="replace") as text:
                    found = [line.rstrip("\r\n") for line in islice(text, lines)]
                yield pd.DataFrame({"path": [path] * len(found), "line_no": range(len(found)), "value": found})
    return dealt_by(objects.select("path"), "path").mapInPandas(read, "path string, line_no int, value string")


def line_heads(df: DataFrame, ident: str, text: Column, lines: int) -> DataFrame:
    """The first ``lines`` lines of a text column, one row per line."""
    return df.select(ident, F.posexplode(F.slice(F.split(text, "\n"), 1, lines)).alias("line_no", "line"))


def with_file(lines: DataFrame, blocks: DataFrame, facts: DataFrame) -> DataFrame:
    """Lines ``(path, _block, ...)`` with what ``facts`` holds of their files, rows by ``path``; inner join.

    They meet by ``blocks``, the distinct pairs ``(path, _block)``: one long file is spread over many tasks, each of which keeps the
    facts of its blocks and streams the lines past them.
    """
    return lines.join(blocks.join(facts, "path").hint("shuffle_hash"), ["path", "_block"])


def package_parts(lines: DataFrame, rows_per_range: int | None = None) -> DataFrame:
    """Split lines ``(path, line_no, value)`` into parts: each repeat of a file's first line starts a new one.

    Adds ``part`` (from 1) without the header lines; the running count is taken in ranges of the line order.
    """
    from haulage.operators.ranges import running_sum

    blocked = lines.withColumn("_block", F.coalesce(F.floor(F.col("line_no") / LINES_PER_BLOCK), F.lit(0)))
    blocks = stored(blocked.select("path", "_block").distinct(), "line-blocks")
    header = lines.where(F.col("line_no") == 0).select("path", F.col("value").alias("_h"))
    marked = with_file(blocked, blocks, header).select(*blocked.columns, (F.col("value") == F.col("_h")).cast("bigint").alias("_is_header"))
    counted = running_sum(stored(marked, "marked-lines"), ["path", "line_no"], F.col("_is_header"), "_seen", rows_per_range)
    base = counted.groupBy("path").agg(F.min("_seen").alias("_base"))
    return with_file(counted, blocks, base).where(F.col("_is_header") == 0).select(
        "path", "line_no", "value", (F.col("_seen") - F.col("_base") + 1).alias("part"))
