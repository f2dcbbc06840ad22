"""Bloom filters over 64-bit hashes, filled by tasks and merged over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from haulage.llm.base import tasks_for

#: Filter bits per entry, the fewest bits of a filter, and the most (128 MB): with more entries the filter gets fuller and
#: says yes more often, which every user of it can bear.
BITS_PER_ENTRY, FEWEST_BITS, MOST_BITS = 12, 1 << 20, 1 << 30
#: Bytes of a filter that are merged together.
SHARD = 8192
#: Entries that a task puts into its filter.
PER_TASK = 50_000_000


def size_for(entries: int) -> int:
    return min(max(1 << int(BITS_PER_ENTRY * entries).bit_length(), FEWEST_BITS), MOST_BITS)


def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a hash in a filter of ``bits`` (a power of two)."""
    mask = np.uint64(bits - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) * np.uint64(0x9E3779B1) & mask).astype(np.int64)


def has(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for at in places(hashes, bits):
        found &= bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0
    return found


def put(bitmap: np.ndarray, hashes: np.ndarray, bits: int) -> None:
    for at in places(hashes, bits):
        np.bitwise_or.at(bitmap, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))


def filter_of(rows: DataFrame, entries: int, hash_of) -> tuple[np.ndarray, int]:
    """Filter bytes and bits of about ``entries`` rows; ``hash_of`` gives the 64-bit hashes of a pandas frame of them.

    Every task fills a filter, so a task takes several splits, of ``PER_TASK`` entries at most.
    """
    bits = size_for(entries)

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bitmap = np.zeros(bits // 8, np.uint8)
        for frame in batches:
            put(bitmap, hash_of(frame), bits)
        shards = [i for i in range(0, len(bitmap), SHARD) if bitmap[i:i + SHARD].any()]
        if shards:
            yield pd.DataFrame({"shard": [i // SHARD for i in shards], "part": [bitmap[i:i + SHARD].tobytes() for i in shards]})

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        whole = np.zeros(SHARD, np.uint8)
        for part in parts["part"]:
            whole |= np.frombuffer(part, np.uint8)
        return pd.DataFrame({"shard": [parts["shard"].iloc[0]], "part": [whole.tobytes()]})

    tasks = tasks_for(rows.sparkSession, entries, PER_TASK)
    merged = rows.coalesce(tasks).mapInPandas(fill, "shard int, part binary").groupBy("shard").applyInPandas(merge, "shard int, part binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.collect():
        out[row.shard * SHARD:(row.shard + 1) * SHARD] = np.frombuffer(row.part, np.uint8)
    return out, bits
