"""Line deduplication with two Bloom filters.

A first pass over the texts fills two filters of line hashes per task, one of lines seen once and one of lines seen twice.
Merged over the tasks, the second one holds every line that may occur in two documents. The second pass probes it, and only
what it suspects is shuffled: digests of suspected lines, to confirm them and to choose the first occurrence, and the texts
of documents that hold suspected lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from haulage.llm.base import free_names, query, table, tasks_for, whole_text
from haulage.llm.bloom import PER_TASK, SHARD, has, put, size_for
from haulage.session import stored

#: Code points from which a line counts.
LEAST_CHARS = 10
#: Groups into which the documents of a line are dealt when its first occurrence is told to them.
SALTS = 16


def keys_of(data: bytes) -> list[bytes | None]:
    """The key of every line: stripped, A-Z in lower case; None where it is too short to count."""
    keys = [line.strip().lower() for line in data.split(b"\n")]
    return [k if len(k) >= 4 * LEAST_CHARS or len(k) >= LEAST_CHARS and len(k.decode()) >= LEAST_CHARS else None for k in keys]


def line_hashes(keys) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


def twice_seen(docs: DataFrame, bits: int, n_lines: int) -> np.ndarray:
    """The merged filter of lines that may occur in two documents, as bytes."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        any_line = False
        for batch in batches:
            found = [np.unique(line_hashes({k for k in keys_of(t) if k})) for t in batch.column("text").to_pylist()]
            if not any(map(len, found)):
                continue
            any_line = True
            hashes, counts = np.unique(np.concatenate(found), return_counts=True)
            put(twice, hashes[(counts > 1) | has(once, hashes, bits)], bits)
            put(once, hashes, bits)
        if any_line:
            for shard in range(0, len(once), SHARD):
                if once[shard:shard + SHARD].any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard // SHARD], pa.int32()), pa.array([once[shard:shard + SHARD].tobytes()]), pa.array([twice[shard:shard + SHARD].tobytes()])], ["shard", "once", "twice"])

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        once, twice = np.zeros(SHARD, np.uint8), np.zeros(SHARD, np.uint8)
        for a, b in zip(parts["once"], parts["twice"]):
            new = np.frombuffer(a, np.uint8)
            twice |= np.frombuffer(b, np.uint8) | once & new
            once |= new
        return pd.DataFrame({"shard": [parts["shard"].iloc[0]], "twice": [twice.tobytes()]})

    # a filter per task is shuffled, so a task takes several splits
    tasks = tasks_for(docs.sparkSession, n_lines, PER_TASK)
    texts = docs.where(F.col("doc_id").isNotNull()).select(F.encode(whole_text(), "UTF-8").alias("text")).coalesce(tasks)
    merged = texts.mapInArrow(fill, "shard int, once binary, twice binary").groupBy("shard").applyInPandas(merge, "shard int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.collect():
        out[row.shard * SHARD:(row.shard + 1) * SHARD] = np.frombuffer(row.twice, np.uint8)
    return out


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` with repeated lines taken out of ``text``, and ``n_lines`` (before) and ``n_dropped``.

    A line whose key has at least 10 code points and stands in at least two documents stays only in the one with the
    smallest doc_id, there as often as it stands. Null texts are empty and become the empty text, which is one line. Rows
    with the same doc_id are one document; rows without doc_id stay whole and count for no other. No rows give no rows, lines and
    texts of any length are compared whole. Other columns are passed on as they are, whatever their names; columns named n_lines or
    n_dropped are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_lines", "n_dropped")
    columns = docs.columns
    n_lines = docs.agg(F.sum(F.length(whole_text()) - F.length(F.replace(whole_text(), F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    bits = size_for(n_lines)
    seen = spark.sparkContext.broadcast(twice_seen(docs, bits, n_lines))
    keys_name, drop_name, id_name = free_names(docs, "_keys", "_drop", "_doc_id")

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            suspected, lines = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                keys = keys_of(text)
                lines.append(len(keys))
                own = list({k for k in keys if k}) if doc_id is not None else []
                hit = has(seen.value, line_hashes(own), bits) if own else []
                suspected.append([hashlib.sha256(k).digest() for k, h in zip(own, hit) if h])
            out = batch.append_column("n_lines", pa.array(lines, pa.int64()))
            yield out.append_column(keys_name, pa.array(suspected, pa.list_(pa.binary())))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, dropped = [], []
            for text, gone in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column(drop_name).to_pylist()):
                if gone:
                    gone = set(gone)
                    lines = text.split(b"\n")
                    kept = [line for line, k in zip(lines, keys_of(text)) if k is None or hashlib.sha256(k).digest() not in gone]
                    texts.append(b"\n".join(kept))
                    dropped.append(len(lines) - len(kept))
                else:
                    texts.append(text)
                    dropped.append(0)
            at = batch.schema.get_field_index("text")
            out = batch.set_column(at, "text", pa.array(texts, pa.binary()).cast(pa.string()))
            yield out.drop_columns([drop_name]).append_column("n_dropped", pa.array(dropped, pa.int64()))

    filled = docs.withColumn("text", whole_text())
    probed_schema = T.StructType([*filled.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField(keys_name, T.ArrayType(T.BinaryType()))])
    probed = filled.mapInArrow(probe, probed_schema)
    clear = probed.where(F.size(keys_name) == 0).drop(keys_name).withColumn("n_dropped", F.lit(0).cast("long"))
    # only digests are stored; texts with suspected lines are probed once more when they are rewritten
    suspects = probed.where(F.size(keys_name) > 0)
    held = stored(suspects.select("doc_id", F.explode(keys_name).alias("key")), "line-suspects")
    first = held.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    # a line that many documents hold is told its first occurrence in several groups of documents
    salted = first.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    gone = held.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"]).where("doc_id > first").groupBy("doc_id").agg(F.collect_set("key").alias(drop_name)).withColumnRenamed("doc_id", id_name)
    joined = suspects.drop(keys_name).join(gone, F.col("doc_id") == F.col(id_name), "left").drop(id_name)
    done_schema = T.StructType([*filled.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return clear.unionByName(joined.mapInArrow(drop, done_schema)).select(*columns, "n_lines", "n_dropped")


_WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL = f"""
WITH lines AS (SELECT doc_id, i, l, translate(trim(l, {_WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM (SELECT doc_id, unnest(ls) AS l, unnest(range(len(ls))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
repeated AS (SELECT k, min(doc_id) AS first FROM lines WHERE length(k) >= {LEAST_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) > 1)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id > first) AS n_dropped,
    sha256(coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (first IS NULL OR doc_id = first), '')) AS kept_sha256
FROM lines LEFT JOIN repeated USING (k) GROUP BY doc_id"""


@query("op4_lines", SQL)
def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = without_repeated_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))
