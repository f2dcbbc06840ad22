"""Token ids in files of fixed-width bits, with block offsets for random access.

A file holds the documents of one range of the document order:

* header: magic ``HLTK``, format version, bits per id, ids per block, number of documents, blocks and ids;
* document table: id of each document, a byte that says whether it has an id, and its number of token ids;
* block offsets: first byte of each block, counted from the start of the data;
* data: blocks of bit-packed ids, the lowest bit first, each block starting at a whole byte.

Any run of ids is found from the block offsets without reading what stands before it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.llm.base import query, table, whole_text
from haulage.llm.words import TextIds, kept_with
from haulage.session import run_folder
from haulage.sinks.archive import _publish

HEADER = struct.Struct("<4sHHIQQQ")
MAGIC, VERSION = b"HLTK", 1
BLOCK = 65_536
#: Bytes of texts that are encoded in one go.
SLICE = 8 << 20


def width_of(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as ``bits`` bits each, lowest bit first, padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes, without a loop over ids."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    return (spread.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def layout(doc_ids: list, lengths: list[int], bits: int, block: int) -> tuple[bytes, np.ndarray]:
    """Everything before the data, and the block offsets."""
    total = int(sum(lengths))
    blocks = -(-total // block)
    offsets = np.arange(blocks, dtype="<u8") * ((block * bits + 7) // 8)
    known = np.array([0 if d is None else 1 for d in doc_ids], np.uint8)
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8")
    head = HEADER.pack(MAGIC, VERSION, bits, block, len(doc_ids), blocks, total)
    return head + ids.tobytes() + known.tobytes() + np.asarray(lengths, "<u8").tobytes() + offsets.tobytes(), offsets


class Reader:
    """Random access to a file of packed ids; ``source`` is an open seekable file."""

    def __init__(self, source):
        self.source = source
        magic, version, self.bits, self.block, docs, blocks, self.total = HEADER.unpack(source.read(HEADER.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a file of packed ids")
        ids = np.frombuffer(source.read(8 * docs), "<i8")
        known = np.frombuffer(source.read(docs), np.uint8)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known)]
        self.lengths = np.frombuffer(source.read(8 * docs), "<u8").astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])
        self.offsets = np.frombuffer(source.read(8 * blocks), "<u8")
        self.data = source.tell()

    def ids(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count`` of the file, reading only the blocks that hold them."""
        count = min(count, self.total - start)
        if count <= 0:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (start + count - 1) // self.block
        self.source.seek(self.data + int(self.offsets[first]))
        parts = []
        for k in range(first, last + 1):
            n = min(self.block, self.total - k * self.block)
            parts.append(unpack(self.source.read((n * self.bits + 7) // 8), self.bits, n))
        whole = parts[0] if len(parts) == 1 else np.concatenate(parts)
        return whole[start - first * self.block:][:count]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.lengths[k]))


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches again, in batches of at most ``size`` bytes of a column's texts, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, block: int = BLOCK) -> DataFrame:
    """Encode ``(doc_id, text)`` and write files below ``folder``, in ascending order of ``doc_id`` (null first, equal ids
    by text).

    ``tokenizer`` is the path of a tokenizers file whose pre-tokenizer splits at white space. Every document ends with
    ``end_id``; null and empty texts are that id alone. One shuffle brings the texts into order; a task encodes its range
    and writes one file under a name that depends on the range alone, first under a temporary name, so a repeated task
    replaces equal bytes. Returns a row per file: path, n_docs, n_ids, start (ids in the files before). Other columns are
    not looked at. No documents: no file.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        import tokenizers
        from pyarrow import fs
        from pyspark import TaskContext

        def made():
            tk = tokenizers.Tokenizer.from_file(tokenizer)
            wide = tk.get_vocab_size() > 65_536 or end_id > 65_535
            return TextIds(tk, "<u4" if wide else "<u2"), width_of(max(tk.get_vocab_size(), end_id + 1))

        texts, bits = kept_with(tokenizers, f"words {tokenizer} {end_id}", made)
        doc_ids, lengths, rest, packed = [], [], np.empty(0, texts.dtype), io.BytesIO()
        for rows in by_bytes(batches, "text", SLICE):
            counts, ids = texts.encode(rows.column("text"), end_id)
            doc_ids += rows.column("doc_id").to_pylist()
            lengths += counts.tolist()
            run_of = np.concatenate([rest, ids])
            whole = len(run_of) // block * block
            for at in range(0, whole, block):
                packed.write(pack(run_of[at:at + block], bits))
            rest = run_of[whole:]
        if not doc_ids:
            return
        packed.write(pack(rest, bits))
        head, _ = layout(doc_ids, lengths, bits, block)
        context = TaskContext.get()
        system, inner = fs.FileSystem.from_uri(folder)
        system.create_dir(inner, recursive=True)
        part = f"ids-{context.partitionId():06d}"
        partial = f"{inner}/_{part}-{context.taskAttemptId()}"
        with system.open_output_stream(partial) as sink:
            sink.write(head)
            sink.write(packed.getbuffer())
        _publish(system, partial, f"{inner}/{part}")
        yield pa.RecordBatch.from_pydict({"file_no": [context.partitionId()], "path": [f"{folder}/{part}"], "n_docs": [len(doc_ids)], "n_ids": [sum(lengths)]})

    ordered = docs.select("doc_id", whole_text().alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    written = ordered.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "file_no long, path string, n_docs long, n_ids long").collect()
    starts, at = [], 0
    for row in sorted(written, key=lambda r: r.file_no):
        starts.append((row.path, row.n_docs, row.n_ids, at))
        at += row.n_ids
    return docs.sparkSession.createDataFrame(starts, "path string, n_docs long, n_ids long, start long")


def read_ids(files: DataFrame) -> DataFrame:
    """Documents of the files that ``write_ids`` lists, read back: doc_id, start, n_tokens, ids_crc32."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for frame in batches:
            for path, start in zip(frame["path"], frame["start"]):
                system, inner = fs.FileSystem.from_uri(path)
                with system.open_input_file(inner) as source:
                    reader = Reader(source)
                    per = 4096
                    for a in range(0, len(reader.doc_ids), per):
                        b = min(a + per, len(reader.doc_ids))
                        ids = reader.ids(int(reader.starts[a]), int(reader.starts[b] - reader.starts[a])).astype("<u4")
                        cuts = reader.starts[a:b + 1] - reader.starts[a]
                        crc = [zlib.crc32(ids[cuts[k]:cuts[k + 1]]) for k in range(b - a)]
                        yield pd.DataFrame({"doc_id": pd.array(reader.doc_ids[a:b], "Int64"), "start": reader.starts[a:b] + start, "n_tokens": reader.lengths[a:b], "ids_crc32": crc})

    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.select("path", "start").repartition(max(cores, files.count())).mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op10_packed_ids")
def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return read_ids(write_ids(docs, run_folder(spark, "packed-ids"), word_tokenizer(), end_id=1))
