"""Near-duplicate join on word shingles by vertical partitioning.

All shingles stand in one global order: by how often they occur, in powers of two, then by their hash. Two sets that are
similar enough share a shingle among the first of each in this order, which gives candidate pairs. The order is cut into
fragments; the overlap of a candidate pair is counted in every fragment by itself and the counts are summed per pair.

Sets that are equal are one class with one representative, and only representatives are compared. In a posting list with
many sets all are first compared with a few hubs, in turns; sets that end up in one component need no further comparison, so
that a group of near copies costs about as many pairs as it has members. After that every pair of a list that may still join
two components is compared, so no link that matters for the components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from haulage.llm.base import id_back, id_text, in_slices, query, table, tasks_for, whole_text
from haulage.llm.bloom import filter_of, has
from haulage.llm.graph import components
from haulage.session import settled, stored, swept

#: Counters of the order, and how many of them are added up together.
COUNTERS, SHARD = 1 << 22, 4096
#: Bytes of text that a task counts into a table of its own.
PER_TASK = 1 << 30
#: Fragments of the order, hubs of a posting list in a turn, and turns at most before all that is left is compared.
FRAGMENTS, HUBS, TURNS = 8, 4, 2
WORDS, SIMILAR = 5, 80
#: Characters of text whose shingles are made at once.
SLICE = 2 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit fingerprints of the ``size``-word shingles of a text given as word hashes; with fewer words, of
    the whole sequence."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = words[:len(words) - size + 1] ^ np.uint64(size)
    for k in range(1, size):
        out = (out ^ (out >> np.uint64(29))) * _ODD + words[k:len(words) - size + 1 + k]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(out ^ (out >> np.uint64(29)))


def sets_of(texts: list[str], size: int) -> list[np.ndarray]:
    import xxhash

    split = [t.encode().lower().split() for t in texts]
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for s in split for w in s), np.uint64)
    cuts = np.cumsum([0, *map(len, split)])
    return [shingles(hashes[a:b], size) for a, b in zip(cuts, cuts[1:])]


def counters(docs: DataFrame, size: int) -> np.ndarray:
    """Level of every counter: how far it stands above the mean, in standard deviations of what unique shingles alone would give,
    one level more with each doubling. So a shingle that some tens of documents share is told from unique ones.

    Counts cover all documents. The table has a fixed size whatever the input, and every task fills one, so a task takes
    several splits, of ``PER_TASK`` bytes of text at most.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table_, any_text = np.zeros(COUNTERS, np.int64), False
        for frame in in_slices(batches, SLICE):
            found = [s for s in sets_of(frame["text"].tolist(), size) if len(s)]
            if found:
                any_text = True
                np.add.at(table_, (np.concatenate(found) & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        if any_text:
            table_ = np.minimum(table_, 2**31 - 1).astype("<i4")
            yield pd.DataFrame({"shard": np.arange(COUNTERS // SHARD, dtype=np.int32), "counts": [table_[i:i + SHARD].tobytes() for i in range(0, COUNTERS, SHARD)]})

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SHARD, np.int64)
        for counts in parts["counts"]:
            total += np.frombuffer(counts, "<i4")
        return pd.DataFrame({"shard": [parts["shard"].iloc[0]], "counts": [total.astype("<i8").tobytes()]})

    tasks = tasks_for(docs.sparkSession, docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0, PER_TASK)
    out = np.zeros(COUNTERS, np.int64)
    for row in docs.select(whole_text().alias("text")).coalesce(tasks).mapInPandas(count, "shard int, counts binary").groupBy("shard").applyInPandas(add, "shard int, counts binary").collect():
        out[row.shard * SHARD:(row.shard + 1) * SHARD] = np.frombuffer(row.counts, "<i8")
    mean = out.mean()
    return np.floor(np.log2(np.maximum(1, (out - mean) / (2 * mean ** 0.5 + 1)))).astype(np.uint8)


def level_of(tokens: np.ndarray, levels: np.ndarray) -> np.ndarray:
    return levels[(tokens & np.uint64(COUNTERS - 1)).astype(np.int64)]


def _may_link(percent: int, x: str, y: str) -> Column:
    """Whether sets whose first shared shingle this is can be similar enough, by their sizes and its places in them."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    left = F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos"))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (left * (100 + percent) >= percent * (n + m))


def _key(doc_ids: pd.Series) -> np.ndarray:
    """Hashes of documents."""
    key = doc_ids.to_numpy().astype(np.int64).view(np.uint64) * _ODD
    key = (key ^ (key >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return key ^ (key >> np.uint64(29))


def fragment_of(tokens: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Fragment of the global order in which every shingle lies: what stands out is the last one, the rest is cut by hash."""
    by_hash = (tokens >> np.uint64(32)) * np.uint64(FRAGMENTS - 1) >> np.uint64(32)
    return np.where(level_of(tokens, levels) > 0, FRAGMENTS - 1, by_hash.astype(np.int64))


def partial_overlaps(pairs: DataFrame, docs: DataFrame, reps: DataFrame, shared_levels, size: int, which: list[int], label: str) -> DataFrame:
    """One row for each of ``pairs`` and each fragment of ``which``: the columns of the pair, ``fragment``, how many shingles the
    sets of its classes ``a`` and ``b`` share there (``shared``) and how many each of them has (``own``, ``other``).

    A filter of the documents that stand for the classes in question, of bounded size, lets the pass over the texts leave out
    all others. So no text is shuffled, only the asked fragments of sets that have a candidate, each a row of its own: a very
    long document is spread over as many tasks as there are fragments.
    """
    involved = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    wanted = stored(reps.where("rep IS NOT NULL").join(involved, "cls").select("rep"), f"{label}-wanted")
    asked = docs.sparkSession.sparkContext.broadcast(filter_of(wanted, wanted.count(), lambda frame: _key(frame["rep"])))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        levels, (bitmap, bits) = shared_levels.value, asked.value
        for batch in batches:
            for frame in in_slices(iter([batch[has(bitmap, _key(batch["doc_id"]), bits)]]), SLICE):
                out = []
                for tokens in sets_of(frame["text"].tolist(), size):
                    place, cls = fragment_of(tokens, levels), class_of(tokens)
                    out += [(cls, k, tokens.view(np.int64)[place == k]) for k in which]
                yield pd.DataFrame(out, columns=["cls", "fragment", "tokens"])

    texts = docs.where("doc_id IS NOT NULL").select("doc_id", whole_text().alias("text"))
    # one shuffle serves both sides
    pieces = texts.mapInPandas(cut, "cls long, fragment int, tokens array<long>").repartition("cls", "fragment")
    left = pieces.select(F.col("cls").alias("a"), "fragment", F.col("tokens").alias("_own"))
    right = pieces.select(F.col("cls").alias("b"), "fragment", F.col("tokens").alias("_other"))
    each = pairs.withColumn("fragment", F.explode(F.array(*[F.lit(k) for k in which])))
    met = each.join(left, ["a", "fragment"]).join(right, ["b", "fragment"])
    counted = met.select(*pairs.columns, "fragment", F.size(F.array_intersect("_own", "_other")).alias("shared"), F.size("_own").alias("own"), F.size("_other").alias("other"))
    return counted.dropDuplicates(["a", "b", "fragment"])  # a class whose set was met twice


def verified(pairs: DataFrame, docs: DataFrame, reps: DataFrame, shared_levels, size: int, percent: int, label: str) -> DataFrame:
    """The pairs ``(a, b, n, m)`` of classes whose overlap, summed over the fragments, reaches the similarity.

    The first fragment is counted for all pairs. Those that could not reach the similarity even if all that is left of the
    smaller set were shared go; most pairs that only happen to share a shingle end here. For the others every further fragment
    is counted by itself, and the counts are summed per pair.
    """
    def reaches(overlap: Column) -> Column:
        return overlap * (100 + percent) >= percent * (F.col("n") + F.col("m"))

    begun = partial_overlaps(pairs, docs, reps, shared_levels, size, [0], f"{label}-first")
    at_most = F.col("shared") + F.least(F.col("n") - F.col("own"), F.col("m") - F.col("other"))
    left = stored(begun.where(reaches(at_most)).select("a", "b", "n", "m", F.col("shared").alias("begun")), f"{label}-left")
    further = partial_overlaps(left, docs, reps, shared_levels, size, list(range(1, FRAGMENTS)), f"{label}-further")
    summed = further.groupBy("a", "b", "n", "m", "begun").agg(F.sum("shared").alias("shared"))
    links = stored(summed.where(reaches(F.col("begun") + F.col("shared"))).select("a", "b"), f"{label}-links")
    del begun, further, summed
    swept(docs.sparkSession)  # the sets that were shuffled
    return links


def class_of(tokens: np.ndarray) -> int:
    """A 64-bit fingerprint of a set."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64))


def similar_groups(docs: DataFrame, size: int = WORDS, percent: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``(doc_id, text)``.

    Words are runs of anything but ASCII white space, with A-Z in lower case. Two documents link when their sets of
    ``size``-word shingles have a Jaccard similarity of at least ``percent`` %; ``component_id`` is the smallest doc_id that
    links lead to. Texts without words, and null, have the empty set and link with nothing. Repeated rows are one class.
    Rows without an id form no group (component_id is that of their class, if any). No rows give no rows, texts of any length are
    compared whole. Other columns are not looked at. What is written on the way is removed when the result is.
    """
    return settled(docs.sparkSession, "join-result", lambda: _similar_groups(docs, size, percent))


def _similar_groups(docs: DataFrame, size: int, percent: int) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    levels = spark.sparkContext.broadcast(counters(docs, size))

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in in_slices(batches, SLICE):
            sizes, classes, prefixes = [], [], []
            for tokens in sets_of(frame["text"].tolist(), size):
                n = len(tokens)
                first = n - -(-percent * n // 100) + 1 if n else 0
                order = np.lexsort((tokens, level_of(tokens, levels.value)))[:first]
                sizes.append(n)
                classes.append(class_of(tokens) if n else None)
                prefixes.append(tokens[order].view(np.int64))
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "n": sizes, "cls": pd.array(classes, "Int64"), "prefix": prefixes})

    sketched = docs.select(id_text("doc_id"), whole_text().alias("text")).mapInPandas(sketch, "doc_id string, n long, cls long, prefix array<long>")
    sets = stored(id_back(sketched, "doc_id"), "join-sets")
    reps = stored(sets.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("rep")), "join-classes")
    own = sets.join(reps.withColumnsRenamed({"cls": "_cls"}), (F.col("cls") == F.col("_cls")) & (F.col("doc_id") == F.col("rep")))
    postings = own.select("cls", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("pos", "token"))
    token = Window.partitionBy("token")
    counted = postings.withColumn("together", F.count("*").over(token)).withColumn("place", F.row_number().over(token.orderBy("pos", F.xxhash64("cls"), "cls")))
    rest = stored(counted.where("together > 1").drop("together").withColumn("label", F.col("cls")), "join-lists")

    edges, aside, rows = None, None, rest.count()
    for turn in range(TURNS):
        hubs, others = rest.where(F.col("place") <= HUBS).alias("x"), rest.alias("y")
        # a set with few shingles before the shared one has little of its own: it stands in the middle of its group
        met = hubs.join(others, (F.col("x.token") == F.col("y.token")) & (F.col("x.place") < F.col("y.place")) & (F.col("x.label") != F.col("y.label")) & _may_link(percent, "x", "y"))
        found = verified(_pairs(met, f"join-pairs-{turn}"), docs, reps, levels, size, percent, f"join-{turn}")
        edges = found if edges is None else edges.unionByName(found)
        near = components(edges, f"join-groups-{turn}").withColumnRenamed("node", "_cls")
        left = rest.where(F.col("place") > HUBS).drop("place", "label").join(near, F.col("cls") == F.col("_cls"), "left").withColumn("label", F.coalesce("root", "cls"))
        # hubs come first from what is not in the component of the list's first set
        ordered = left.withColumn("main", F.min_by("label", F.struct("pos", "cls")).over(token)).withColumn("last", F.max("label").over(token)).withColumn("least", F.min("label").over(token))
        ordered = ordered.withColumn("place", F.row_number().over(token.orderBy(F.col("label") == F.col("main"), "pos", F.xxhash64("cls"), "cls")))
        rest = stored(ordered.where(F.col("last") != F.col("least")).select("token", "cls", "n", "pos", "place", "label", "main"), f"join-rest-{turn}")
        before, aside = aside, rest.where(F.col("label") != F.col("main")).count()
        # few rows left outside the main component of their list, or no progress: the rest is compared at once
        if aside <= 0.1 * rows or before is not None and aside > 0.8 * before:
            break

    # one side is what is not in the component of the list's first set, so a large component is not compared with itself
    met = rest.where(F.col("label") != F.col("main")).alias("x").join(rest.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.label") != F.col("y.label")) & _may_link(percent, "x", "y"))
    found = verified(_pairs(met, "join-last-pairs"), docs, reps, levels, size, percent, "join-last")
    joined = components(edges.unionByName(found), "join-groups").withColumnsRenamed({"node": "_cls"})
    rooted = stored(reps.join(joined, F.col("cls") == F.col("_cls"), "left").select("cls", "rep", F.coalesce("root", "cls").alias("root")), "join-rooted")
    smallest = rooted.groupBy("root").agg(F.min("rep").alias("component_id")).withColumnRenamed("root", "_root")
    labels = rooted.join(smallest, F.col("root") == F.col("_root")).select(F.col("cls").alias("_cls"), "component_id")
    held = sets.select("doc_id", "n", "cls").join(labels, F.col("cls") == F.col("_cls"), "left")
    return held.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _pairs(met: DataFrame, label: str) -> DataFrame:
    x, y = F.col("x.cls"), F.col("y.cls")
    ordered = met.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"), F.when(x < y, F.col("x.n")).otherwise(F.col("y.n")).alias("n"), F.when(x < y, F.col("y.n")).otherwise(F.col("x.n")).alias("m"))
    return stored(ordered.where("a <> b").distinct(), label)


_TOKENS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
SQL = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, {_TOKENS} AS ws FROM documents),
grams AS (
    SELECT DISTINCT doc_id, hash(ws[i], ws[i + 1], ws[i + 2], ws[i + 3]) AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1))) AS i FROM docs)
    UNION ALL SELECT doc_id, hash(array_to_string(ws, ' '), len(ws)) FROM docs WHERE len(ws) BETWEEN 1 AND 3),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * k >= 85 * (p.n + q.n - k)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least_of AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of ON x = doc_id"""


@query("op7_jaccard", SQL)
def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents", "doc_id", "text"), size=4, percent=85)
