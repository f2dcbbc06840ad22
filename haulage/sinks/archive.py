"""Packages: every part becomes one archive with ticket, descriptor and data, written where the rows are."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from haulage.session import dealt_by
from haulage.sinks.delimited import Dialect, PLAIN_TSV, as_lines, header_line

CHUNK = 8 * 1024 * 1024
RESULT = "part_no long, archive_name string, data_name string, n_rows long, n_bytes long"


def _sink(path: str):
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system, inner


def _publish(system, partial: str, final: str) -> None:
    """Give a complete file its name; a file left by an earlier attempt is replaced."""
    try:
        system.move(partial, final)
    except OSError:
        system.delete_file(final)
        system.move(partial, final)


class _TarLines:
    """A gzip tar whose data member is spooled first, because a tar header holds the size."""

    def __init__(self, raw, data_name: str, stamp):
        import tempfile

        self.raw, self.name, self.stamp = raw, data_name, stamp
        self.spool = tempfile.SpooledTemporaryFile(max_size=CHUNK)

    def write(self, data: bytes) -> None:
        self.spool.write(data)

    def finish(self, small: list[tuple[str, bytes]]) -> None:
        import calendar
        import io
        import tarfile

        with tarfile.open(fileobj=self.raw, mode="w|gz") as tar:
            for name, body in small:
                info = tarfile.TarInfo(name)
                info.size, info.mtime = len(body), calendar.timegm(self.stamp)
                tar.addfile(info, io.BytesIO(body))
            info = tarfile.TarInfo(self.name)
            info.size, info.mtime = self.spool.tell(), calendar.timegm(self.stamp)
            self.spool.seek(0)
            tar.addfile(info, self.spool)


class _ZipLines:
    """A zip streamed member by member."""

    def __init__(self, raw, data_name: str, stamp, small: list[tuple[str, bytes]]):
        import zipfile

        self.zip = zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED)
        for name, body in small:
            self.zip.writestr(zipfile.ZipInfo(name, stamp[:6]), body, zipfile.ZIP_DEFLATED)
        info = zipfile.ZipInfo(data_name, stamp[:6])
        info.compress_type = zipfile.ZIP_DEFLATED
        self.member = self.zip.open(info, "w", force_zip64=True)

    def write(self, data: bytes) -> None:
        self.member.write(data)

    def finish(self, small: list[tuple[str, bytes]]) -> None:
        self.member.close()
        self.zip.close()


def write_archives(parts: DataFrame, named: DataFrame, columns: list[str], order: list[str], root: str, meta: str, stamp: str,
                   dialect: Dialect = PLAIN_TSV, kind: str = "zip", tasks: int | None = None) -> DataFrame:
    """Write one archive per part below ``root`` and return ``(part_no, archive_name, data_name, n_rows, n_bytes)``.

    ``tasks`` spreads the parts over so many tasks (the cores of the cluster by default); the number of parts, up to
    some thousands, suits.

    Rows of a part meet in one task (parts are size-bounded) and stream through it batch by batch. Names do not
    depend on the attempt and a file appears only when it is complete, so a retried task writes the same package.
    """
    import time

    head = header_line(columns, dialect) + dialect.lineterminator
    end = dialect.lineterminator
    moment = tuple(time.strptime(stamp, "%Y%m%d%H%M%S"))
    # Every part begins with one row that carries its names: no join, and no name travels with the data rows.
    labels = named.select("part_no", F.lit(0).alias("_kind"), F.to_json(F.struct("data_name", "meta_name", "ticket_name", "archive_name", "n_rows")).alias("_names"))
    extra = [c for c in order if c not in columns]
    rows = parts.select("part_no", F.lit(1).alias("_kind"), *columns, *extra)
    dealt = dealt_by(rows.unionByName(labels, allowMissingColumns=True), "part_no", tasks).sortWithinPartitions("part_no", "_kind", *order)
    # Lines are rendered after the rows are spread, where all tasks share the work.
    lines = as_lines(dealt.drop(*extra), dialect, ["part_no", "_kind", "_names"])
    ready = lines.select("part_no", F.when(F.col("_kind") == 1, F.col("value")).alias("value"), "_names")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json
        import uuid

        system, base = _sink(root)
        system.create_dir(base, recursive=True)
        current = None

        def begin(no: int, names: dict) -> dict:
            if kind != "zip":
                names["archive_name"] = names["archive_name"].replace(".zip", ".tar.gz")
            small = [(names["ticket_name"], f"{names['data_name']};{names['n_rows']}".encode()), (names["meta_name"], meta.encode())]
            partial = f"{base}/_{names['archive_name']}.{uuid.uuid4().hex}"
            raw = system.open_output_stream(partial)
            out = _ZipLines(raw, names["data_name"], moment, small) if kind == "zip" else _TarLines(raw, names["data_name"], moment)
            out.write(head.encode())
            return {"no": no, "names": names, "small": small, "partial": partial, "raw": raw, "out": out, "size": len(head.encode())}

        def close() -> pd.DataFrame:
            names = current["names"]
            current["out"].finish(current["small"])
            current["raw"].close()
            _publish(system, current["partial"], f"{base}/{names['archive_name']}")
            return pd.DataFrame({"part_no": [current["no"]], "archive_name": [names["archive_name"]], "data_name": [names["data_name"]],
                                 "n_rows": [names["n_rows"]], "n_bytes": [current["size"]]})

        for batch in batches:
            for no, rows in batch.groupby("part_no", sort=False):
                if current is None or current["no"] != no:
                    if current is not None:
                        yield close()
                    current = begin(int(no), json.loads(rows["_names"].iloc[0]))
                    rows = rows.iloc[1:]
                if len(rows):
                    body = (end.join(rows["value"]) + end).encode()
                    current["out"].write(body)
                    current["size"] += len(body)
        if current is not None:
            yield close()

    return ready.mapInPandas(pack, RESULT)


def write_empty_archive(root: str, named, columns: list[str], meta: str, stamp: str, dialect: Dialect = PLAIN_TSV) -> str:
    """The header-only archive of an empty package; ``named`` is its manifest row."""
    import time

    system, base = _sink(root)
    system.create_dir(base, recursive=True)
    with system.open_output_stream(f"{base}/{named.archive_name}") as raw:
        out = _ZipLines(raw, named.data_name, tuple(time.strptime(stamp, "%Y%m%d%H%M%S")),
                        [(named.ticket_name, f"{named.data_name};0".encode()), (named.meta_name, meta.encode())])
        out.write((header_line(columns, dialect) + dialect.lineterminator).encode())
        out.finish([])
    return named.archive_name


def write_summary_ticket(root: str, ticket_name: str, archives: list[str]) -> str:
    """The ticket beside the archives: one archive name per line."""
    system, base = _sink(root)
    with system.open_output_stream(f"{base}/{ticket_name}") as raw:
        raw.write("\n".join(archives).encode())
    return ticket_name


def _copies(objects: DataFrame, root: str, below: str, new_key) -> DataFrame:
    """``(path, key)`` of the files to copy, the key below the listed root; two files for one key are an error."""
    from pyarrow import fs

    inside = fs.FileSystem.from_uri(below)[1].rstrip("/") + "/"
    key = F.substring_index("path", inside, -1)
    todo = objects.select("path", new_key(key).alias("key"))
    if not objects.where(~F.col("path").contains(inside)).isEmpty():
        raise ValueError(f"files outside {below}")
    twice = todo.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").first()
    if twice:
        raise ValueError(f"{twice.n} files for {root}/{twice.key}")
    return todo


def copy_objects(objects: DataFrame, root: str, below: str, compress: bool = False) -> DataFrame:
    """Copy listed files below ``root`` as byte streams, under the key they have below ``below``; with gzip on request, but
    packed files are never compressed again.

    Returns ``(path, new_path, n_bytes)``.
    """
    from haulage.functions.paths import packed

    todo = _copies(objects, root, below, lambda key: F.when(F.lit(compress) & ~packed(F.col("path")), F.concat(key, F.lit(".gz"))).otherwise(key))
    todo = todo.withColumn("pack", F.lit(compress) & ~packed(F.col("path")))

    def move(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip

        for batch in batches:
            for path, key, pack in zip(batch["path"], batch["key"], batch["pack"]):
                source, inner = _sink(path)
                size = 0
                with source.open_input_stream(inner, compression=None) as src, _published(root, key) as raw:
                    out = gzip.GzipFile(fileobj=raw, mode="wb", mtime=0) if pack else raw
                    while chunk := src.read(CHUNK):
                        out.write(chunk)
                        size += len(chunk)
                    if pack:
                        out.close()
                yield pd.DataFrame({"path": [path], "new_path": [f"{root}/{key}"], "n_bytes": [size]})

    return dealt_by(todo, "path").mapInPandas(move, "path string, new_path string, n_bytes long")


def join_objects(objects: DataFrame, order: list[Column], root: str, key: str) -> DataFrame:
    """Put listed files one behind the other, in the given order, into the file ``key`` below ``root``; no byte comes between.

    One task writes, as a file has one writer; it holds a chunk at a time, whatever the sizes. Returns ``(new_path, n_files, n_bytes)``.
    """
    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = size = 0
        with _published(root, key) as raw:
            for batch in batches:
                for path in batch["path"]:
                    source, inner = _sink(path)
                    with source.open_input_stream(inner, compression=None) as src:
                        for chunk in _chunks(src):
                            raw.write(chunk)
                            size += len(chunk)
                    files += 1
        yield pd.DataFrame({"new_path": [f"{root}/{key}"], "n_files": [files], "n_bytes": [size]})

    return objects.repartition(1).sortWithinPartitions(*order).select("path").mapInPandas(join, "new_path string, n_files long, n_bytes long")


@contextmanager
def _published(root: str, key: str):
    """A file that gets its name below ``root`` when it is complete."""
    import uuid

    system, base = _sink(root)
    folder, _, name = f"{base}/{key}".rpartition("/")
    system.create_dir(folder, recursive=True)
    partial = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(partial, compression=None) as raw:
        yield raw
    _publish(system, partial, f"{folder}/{name}")


# Codecs by the end of a name.
CODECS = {".tar.gz": "tar.gz", ".tgz": "tar.gz", ".zip": "zip", ".gz": "gz"}


def codec_of(name: str) -> tuple[str, str]:
    """The name without the end that tells its codec, and the codec (``none`` for any other end)."""
    for end, codec in CODECS.items():
        if name.lower().endswith(end):
            return name[:-len(end)], codec
    return name, "none"


@contextmanager
def _unpacked(path: str):
    """``[(member name, open function)]`` of a file: its members, or the file itself."""
    import gzip
    import tarfile
    import zipfile

    source, inner = _sink(path)
    stem, codec = codec_of(path.rsplit("/", 1)[-1])
    with source.open_input_file(inner) as raw:
        if codec == "zip":
            with zipfile.ZipFile(raw) as archive:
                yield [(m.filename, lambda m=m: archive.open(m)) for m in archive.infolist() if not m.is_dir()]
        elif codec == "tar.gz":
            with tarfile.open(fileobj=raw, mode="r:gz") as archive:
                yield [(m.name, lambda m=m: archive.extractfile(m)) for m in archive.getmembers() if m.isfile()]
        else:
            def again():
                raw.seek(0)
                return gzip.GzipFile(fileobj=raw) if codec == "gz" else raw
            yield [(stem, again)]


def write_texts(texts: DataFrame) -> DataFrame:
    """Every row ``(path, text)`` as a file of its own; returns ``(path, n_bytes)``."""
    first, body = texts.columns

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = []
            for path, value in zip(batch[first], batch[body]):
                root, _, key = path.rpartition("/")
                with _published(root, key) as raw:
                    raw.write(value.encode())
                sizes.append(len(value.encode()))
            yield pd.DataFrame({"path": batch[first].to_numpy(), "n_bytes": sizes})

    return dealt_by(texts, first).mapInPandas(write, "path string, n_bytes long")


def _chunks(stream):
    while chunk := stream.read(CHUNK):
        yield chunk


def convert_objects(objects: DataFrame, root: str, below: str, codec: str) -> DataFrame:
    """Listed files under their keys below ``root``, converted to ``gz``, ``zip``, ``tar.gz`` or ``none``.

    An archive becomes an archive of the same members; for ``gz`` and ``none`` each member becomes a file, in a folder named
    after an archive. Members are streamed; a tar header needs a length, so a member without one is read twice instead of
    being kept. A file that has the codec already is copied. Returns ``(path, new_path, n_bytes)``, bytes unpacked.
    """
    if codec not in ("gz", "zip", "tar.gz", "none"):
        raise ValueError(f"no codec {codec!r}")
    todo = _copies(objects, root, below, lambda key: key)

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import gzip
        import tarfile
        import zipfile

        for batch in batches:
            for path, key in zip(batch["path"], batch["key"]):
                stem, own = codec_of(key)
                made = []
                if own == codec:
                    source, inner = _sink(path)
                    size = 0
                    with source.open_input_stream(inner, compression=None) as src, _published(root, key) as raw:
                        for chunk in _chunks(src):
                            raw.write(chunk)
                            size += len(chunk)
                    made.append((f"{root}/{key}", size))
                else:
                    with _unpacked(path) as members:
                        if codec in ("gz", "none"):
                            for name, read in members:
                                target = (f"{stem}/{name}" if own in ("zip", "tar.gz") else stem) + (".gz" if codec == "gz" else "")
                                size = 0
                                with _published(root, target) as raw:
                                    out = gzip.GzipFile(fileobj=raw, mode="wb", mtime=0) if codec == "gz" else raw
                                    for chunk in _chunks(read()):
                                        out.write(chunk)
                                        size += len(chunk)
                                    if codec == "gz":
                                        out.close()
                                made.append((f"{root}/{target}", size))
                        else:
                            size = 0
                            with _published(root, f"{stem}.{codec}") as raw:
                                if codec == "zip":
                                    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as archive:
                                        for name, read in members:
                                            with archive.open(zipfile.ZipInfo(name), "w", force_zip64=True) as out:
                                                for chunk in _chunks(read()):
                                                    out.write(chunk)
                                                    size += len(chunk)
                                else:
                                    with tarfile.open(fileobj=raw, mode="w|gz") as archive:
                                        for name, read in members:
                                            info = tarfile.TarInfo(name)
                                            info.size = sum(map(len, _chunks(read())))
                                            archive.addfile(info, read())
                                            size += info.size
                            made.append((f"{root}/{stem}.{codec}", size))
                yield pd.DataFrame({"path": [path] * len(made), "new_path": [m[0] for m in made], "n_bytes": [m[1] for m in made]})

    return dealt_by(todo, "path").mapInPandas(convert, "path string, new_path string, n_bytes long")
