"""Near-duplicate vectors by iterative quantisation.

A rotation of the principal axes is learnt so that the signs of the rotated vectors lose as little as possible, which gives
balanced binary codes. Codes are looked up in several tables, one for each run of their bits, in which two codes meet if
they differ in at most one bit of the run; codes within the radius always meet in some table. Pairs within the radius are
then ranked again by the cosine of the original vectors, in double precision.

Vectors of each length have a rotation and tables of their own. Equal vectors are one class, compared once. A table entry with many members is cut into blocks, and every pair of blocks
is a group of its own, so no task gets an unbounded entry and no pair is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.llm.base import id_back, id_text, query, table
from haulage.llm.graph import components
from haulage.session import settled, stored

SIMILAR = 0.95
#: Vectors of a length that its rotation is fitted on, in expectation at most, and rounds of fitting.
SAMPLE, ROUNDS = 20_000, 50
#: Bytes of rotations that are sent out at once; lengths beyond it come in turns.
AT_ONCE = 64 << 20
#: Bits of a code at most, tables, and the radius within which every pair meets: one bit in each table and one less in all.
BITS, TABLES = 64, 6
RADIUS = 2 * TABLES - 1
#: Members of a table entry that are compared as one block.
BLOCK = 4096


def fitted(sample: np.ndarray, bits: int = BITS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (axes times rotation) of unit vectors; the code of v is the signs of (v - mean) @ projection."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :bits]
    low = centred @ axes
    rotation = np.linalg.qr(np.random.default_rng(0).standard_normal((axes.shape[1], axes.shape[1])))[0]
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(np.where(low @ rotation >= 0, 1.0, -1.0).T @ low)
        rotation = (u @ vt).T
    return mean, axes @ rotation


def codes_of(unit: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    signs = (unit - mean) @ projection >= 0
    packed = np.zeros((len(unit), 8), np.uint8)
    own = np.packbits(signs, axis=1, bitorder="little")
    packed[:, :own.shape[1]] = own
    return packed.view("<u8").ravel()


def runs(bits: int, tables: int = TABLES) -> list[tuple[int, int]]:
    """First bit and length of each table's run."""
    cuts = np.linspace(0, bits, min(bits, tables) + 1).round().astype(int).tolist()
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def keys_of(codes: np.ndarray, bits: int) -> np.ndarray:
    """Entries of every code: in each table one for each bit of its run, with that bit masked out."""
    out, one = [], np.uint64(1)
    for t, (first, length) in enumerate(runs(bits)):
        part = (codes >> np.uint64(first)) & np.uint64((1 << length) - 1)
        for bit in range(length):
            out.append((part & ~(one << np.uint64(bit))) | np.uint64(t << 56 | bit << 48))
    return np.stack(out, axis=1) if out else np.zeros((len(codes), 0), np.uint64)


def first_meeting(differ: np.ndarray, bits: int) -> np.ndarray:
    """Table and bit of the first entry in which two codes meet, given the bits they differ in; 2^32 - 1 if in none."""
    out = np.full(len(differ), 2**32 - 1, np.int64)
    for t, (first, length) in reversed(list(enumerate(runs(bits)))):
        part = (differ >> np.uint64(first)) & np.uint64((1 << length) - 1)
        n = np.bitwise_count(part)
        bit = np.where(n == 1, np.bitwise_count(part - np.uint64(1)), 0)
        out = np.where(n <= 1, t << 8 | bit.astype(np.int64), out)
    return out


def meetings(codes: np.ndarray, sides: np.ndarray | None, entry: int, bits: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one group within the radius for which this entry is the first they meet in; with sides, only across them."""
    here = (entry >> 56) << 8 | (entry >> 48 & 255)
    xs, ys = [], []
    for a in range(0, len(codes), 512):
        differ = codes[a:a + 512, None] ^ codes[None, :]
        close = np.bitwise_count(differ) <= radius
        if sides is None:
            close &= np.arange(a, min(a + 512, len(codes)))[:, None] < np.arange(len(codes))[None, :]
        else:
            close &= ~sides[a:a + 512, None] & sides[None, :]
        x, y = np.nonzero(close)
        good = first_meeting(differ[x, y], bits) == here
        xs.append(x[good] + a)
        ys.append(y[good])
    return np.concatenate(xs), np.concatenate(ys)


def bits_of(size: int) -> int:
    return min(BITS, size)


def close_codes(coded: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Every pair (a, b) of classes in ``(cls, size, code)`` of one size whose codes differ in at most ``radius`` bits and meet in a table."""
    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for size, own in frame.groupby("size"):
                keys = keys_of(own["code"].to_numpy().view(np.uint64), bits_of(size))
                yield pd.DataFrame({"size": size, "entry": keys.ravel().view(np.int64), "cls": np.repeat(own["cls"].to_numpy(), keys.shape[1]), "code": np.repeat(own["code"].to_numpy(), keys.shape[1])})

    entries = stored(coded.mapInPandas(look, "size long, entry long, cls long, code long"), "vector-entries")
    full = entries.groupBy("size", "entry").agg(F.count("*").alias("n")).where(F.col("n") > block).select(F.col("size").alias("_size"), F.col("entry").alias("_entry"), F.ceil(F.col("n") / block).alias("blocks"))
    placed = entries.join(full, (F.col("entry") == F.col("_entry")) & (F.col("size") == F.col("_size")), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("cls"), "blocks"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "size", "entry", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") > F.col("other")).alias("upper"), "cls", "code")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in batches:
            frame = frame if rest is None or rest.empty else pd.concat([rest, frame], ignore_index=True)
            ids = frame[["size", "entry", "low", "high"]].to_numpy()
            cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            last = cuts[-1] if len(cuts) else 0
            yield from pairs_in(frame.iloc[:last], cuts)
            rest = frame.iloc[last:]
        if rest is not None and len(rest):
            yield from pairs_in(rest.reset_index(drop=True), np.array([], np.int64))

    def pairs_in(frame: pd.DataFrame, cuts: np.ndarray) -> Iterator[pd.DataFrame]:
        if frame.empty:
            return
        size, entry, low, high = (frame[c].to_numpy() for c in ("size", "entry", "low", "high"))
        upper, cls, code = frame["upper"].to_numpy(), frame["cls"].to_numpy(), frame["code"].to_numpy().view(np.uint64)
        bounds = [0, *[c for c in cuts.tolist() if c < len(frame)], len(frame)]
        found = []
        for s, e in zip(bounds, bounds[1:]):
            if e - s > 1:
                x, y = meetings(code[s:e], None if low[s] == high[s] else upper[s:e], int(entry[s]), bits_of(int(size[s])), radius)
                if len(x):
                    found.append((cls[s:e][x], cls[s:e][y]))
        if found:
            yield pd.DataFrame({"a": np.concatenate([f[0] for f in found]), "b": np.concatenate([f[1] for f in found])})

    dealt = spread.repartition("size", "entry", "low", "high").sortWithinPartitions("size", "entry", "low", "high")
    return dealt.mapInPandas(compare, "a long, b long")


def rotations(reps: DataFrame, sizes: dict[int, int], sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and projection of each of the ``sizes`` (with the number of its classes), fitted in a task each."""
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        vectors = unit(np.stack(group.sort_values("cls")["vector"].to_list()))
        mean, projection = fitted(vectors, bits_of(vectors.shape[1]))
        return pd.DataFrame({"size": [vectors.shape[1]], "mean": [mean], "projection": [projection.ravel()]})

    share = F.create_map(*[F.lit(x) for size, n in sizes.items() for x in (size, min(1.0, sample / n))])
    drawn = reps.where(F.pmod(F.xxhash64("cls", F.lit("drawn")), F.lit(1 << 20)) < share[F.col("size")] * (1 << 20))
    found = drawn.select("size", "cls", "vector").groupBy("size").applyInPandas(fit, "size long, mean array<double>, projection array<double>").collect()
    out = {r["size"]: (np.array(r["mean"]), np.array(r["projection"]).reshape(r["size"], -1)) for r in found}
    return {size: out.get(size) or (np.zeros(size), np.eye(size)[:, :bits_of(size)]) for size in sizes}


def near_vectors(vectors: DataFrame, similar: float = SIMILAR, sample: int = SAMPLE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``(vec_id, embedding)``.

    Two vectors of one length link when their cosine is at least ``similar``. Null, empty or zero vectors, and vectors with null or
    non-finite components link with nothing. ``n_links`` counts the other rows linked directly, equal ones included;
    ``component_id`` is the smallest vec_id that links lead to; ``kept`` says that it is the row's own (false for rows without an
    id). No rows give no rows. Other columns are not looked at. What is written on the way is removed when the result is.
    """
    return settled(vectors.sparkSession, "vector-result", lambda: _near_vectors(vectors, similar, sample))


def _near_vectors(vectors: DataFrame, similar: float, sample: int) -> DataFrame:
    spark = vectors.sparkSession

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        for frame in batches:
            cls, kept = [], []
            for v in frame["embedding"]:
                v = None if v is None else np.asarray(v, np.float64)
                good = v is not None and len(v) and np.isfinite(v).all() and v.any()
                cls.append(int(np.uint64(xxhash.xxh3_64_intdigest(v.tobytes())).astype(np.int64)) if good else None)
                kept.append(v if good else None)
            yield pd.DataFrame({"vec_id": frame["vec_id"].to_numpy(), "cls": pd.array(cls, "Int64"), "vector": kept})

    rows = stored(id_back(vectors.select(id_text("vec_id"), "embedding").mapInPandas(check, "vec_id string, cls long, vector array<double>"), "vec_id"), "vectors")
    classes = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    named = rows.select(F.col("cls").alias("_cls"), "vec_id", "vector")
    reps = stored(classes.join(named, (F.col("cls") == F.col("_cls")) & F.col("rep").eqNullSafe(F.col("vec_id"))).select("cls", "rep", "copies", "vector").dropDuplicates(["cls"]), "vector-classes")

    reps = reps.withColumn("size", F.size("vector").cast("long"))
    sizes = {r["size"]: r["n"] for r in reps.groupBy("size").agg(F.count("*").alias("n")).collect()}
    candidates, lot, room = None, {}, AT_ONCE
    for place, size in enumerate(sorted(sizes), 1):
        lot[size] = sizes[size]
        room -= 8 * size * bits_of(size)
        if room <= 0 or place == len(sizes):
            found = _candidates(reps, lot, sample)
            candidates = found if candidates is None else candidates.unionByName(found)
            lot, room = {}, AT_ONCE
    candidates = spark.createDataFrame([], "a long, b long") if candidates is None else candidates
    own = reps.select(F.col("cls").alias("a"), F.col("vector").alias("va"))
    other = reps.select(F.col("cls").alias("b"), F.col("vector").alias("vb"))

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for _, own in frame.groupby(frame["va"].map(len)):
                cosine = (unit(np.stack(own["va"].to_list())) * unit(np.stack(own["vb"].to_list()))).sum(axis=1)
                yield own.loc[cosine >= similar, ["a", "b"]]

    links = stored(candidates.join(own, "a").join(other, "b").select("a", "b", "va", "vb").mapInPandas(rank, "a long, b long"), "vector-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(reps.select(F.col("cls").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("linked"))
    joined = components(links, "vector-components")
    rooted = stored(reps.select("cls", "rep", "copies").join(joined, F.col("cls") == F.col("node"), "left").join(degree, F.col("cls") == F.col("a"), "left")
                    .select("cls", "rep", F.coalesce("root", "cls").alias("root"), (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "vector-roots")
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id")).withColumnRenamed("root", "_root")
    labels = rooted.join(smallest, F.col("root") == F.col("_root")).select(F.col("cls").alias("_cls"), "n_links", "component_id")
    held = rows.join(labels, F.col("cls") == F.col("_cls"), "left")
    out = held.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _candidates(reps: DataFrame, sizes: dict[int, int], sample: int) -> DataFrame:
    """Pairs of classes of these lengths whose codes are close."""
    model = reps.sparkSession.sparkContext.broadcast(rotations(reps, sizes, sample))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for size, own in frame.groupby("size"):
                codes = codes_of(unit(np.stack(own["vector"].to_list())), *model.value[size])
                yield pd.DataFrame({"cls": own["cls"].to_numpy(), "size": size, "code": codes.view(np.int64)})

    return close_codes(reps.where(F.col("size").isin(list(sizes))).select("cls", "size", "vector").mapInPandas(encode, "cls long, size long, code long"))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that no square overflows or vanishes."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


SQL = f"""
WITH RECURSIVE good AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= {SIMILAR}),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(y, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(y, vec_id)) AS kept
FROM embeddings LEFT JOIN degree d ON d.x = vec_id LEFT JOIN least_of l ON l.x = vec_id"""


@query("op6_vectors", SQL)
def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
