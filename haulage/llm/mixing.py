"""Mixing sources to target sizes.

Every source gets a target number of words. Whole rounds of a source are taken as often as they fit; what remains of the
target is met by choosing how many documents of each exact length to take: first the same share of every length, then large
lengths until little is left, and the rest by bounded-knapsack dynamic programming over the lengths that are left. Which
documents of a length are taken follows a seeded hash, so a rerun takes the same ones.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from haulage.llm.base import SPACE, query, table, whole_text
from haulage.session import settled, stored

WEIGHTS = (5, 2, 1)
#: Share of all words that the mix takes, in percent, and how often a source may be taken at most.
SHARE, MOST = 150, 2
#: Words of the rest of a target that the dynamic program fits, or twice the longest document if that is more.
ROOM = 1 << 17
#: Documents of one length and source that are ranked together.
RANKED = 1000


def fit(lengths: list[int], left: list[int], budget: int) -> dict[int, int]:
    """How many documents of each length make up ``budget``, or as much of it as can be reached, from ``left`` of each.

    Bounded knapsack over sums up to the budget, kept as bits of one integer; ends as soon as the budget is reached.
    """
    mask, reach = (1 << (budget + 1)) - 1, 1
    came = np.full(budget + 1, -1, np.int64)
    items: list[tuple[int, int]] = []
    for length, count in sorted(zip(lengths, left), reverse=True):
        chunk = 1
        while count > 0 and length * min(chunk, count) <= budget and not reach >> budget & 1:
            n = min(chunk, count)
            more = (reach << (length * n)) & mask & ~reach
            if more:
                found = np.unpackbits(np.frombuffer(more.to_bytes(budget // 8 + 1, "little"), np.uint8), bitorder="little")
                came[np.flatnonzero(found[:budget + 1])] = len(items)
                items.append((length, n))
                reach |= more
            count -= n
            chunk *= 2
    at, taken = reach.bit_length() - 1, {}
    while at > 0:
        length, n = items[came[at]]
        taken[length] = taken.get(length, 0) + n
        at -= length * n
    return taken


def choose(lengths: list[int], counts: list[int], target: float) -> tuple[int, list[int]]:
    """Whole rounds, and how many more documents of each length, for one source."""
    total = sum(n * c for n, c in zip(lengths, counts))
    if total == 0:
        return 0, [0] * len(lengths)
    full = min(MOST, int(target // total))
    rest = 0 if full == MOST else min(total, round(target - full * total))
    take = [c * rest // total if n else 0 for n, c in zip(lengths, counts)]
    rest -= sum(n * k for n, k in zip(lengths, take))
    room = max(2 * max(lengths), ROOM)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if lengths[i] and rest > room:
            more = min(counts[i] - take[i], (rest - room) // lengths[i])
            take[i] += more
            rest -= more * lengths[i]
    usable = [i for i in range(len(lengths)) if lengths[i] and counts[i] > take[i]]
    found = fit([lengths[i] for i in usable], [counts[i] - take[i] for i in usable], rest)
    return full, [k + found.get(n, 0) for n, k in zip(lengths, take)]


def targets(histogram: DataFrame) -> DataFrame:
    """(source, source_size, target): weights 5, 2, 1 in turn over the sources by code point, null last; the targets add up to
    150 % of all words, none above twice its source, what is above being shared again by weight.

    Sources whose cap per weight is below the common level stay at their cap; one pass over the sources in the order of
    that ratio finds the level. A row per source goes through these windows.
    """
    sources = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((place - 1) % len(WEIGHTS) + 1).cast("int")).cast("long"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(0, Window.unboundedFollowing)
    cap, budget = F.col("source_size") * MOST, F.sum("source_size").over(every) * SHARE / 100
    level = (budget - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum("weight").over(onward)
    capped = weighed.withColumn("capped", cap <= level * F.col("weight")).withColumn("budget", budget)
    spent = F.coalesce(F.sum(F.when(F.col("capped"), cap)).over(every), F.lit(0))
    common = (F.col("budget") - spent) / F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    return capped.select("source", "source_size", F.when(F.col("capped"), cap).otherwise(common * F.col("weight")).cast("double").alias("target"))


def planned(histogram: DataFrame) -> DataFrame:
    """(source, size, n, source_size, target, full, extra): rounds of the source, and documents of the size taken once more."""
    aims = targets(histogram).withColumnRenamed("source", "_source")
    joined = histogram.join(aims, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        full, take = choose([int(x) for x in group["size"]], [int(x) for x in group["n"]], float(group["target"].iloc[0]))
        return group.assign(full=full, extra=take)

    return joined.groupBy("source").applyInPandas(run, "source string, size long, n long, source_size long, target double, full long, extra long")


def n_words(column: str = "text"):
    """Words of a text: runs of anything but the white space of ASCII; null has none."""
    bare = F.btrim(whole_text(column), F.lit(SPACE))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+"))).cast("long")


def mixed(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Decision for every row of ``(doc_id, source, text)``: doc_id, text_hash, source, size, source_size, target, copies.

    Documents of a length compete by a hash of seed, id and text. A length with many documents is cut into hash ranges of
    about a thousand; ranges below the cut are taken whole and only the range at the cut is ranked, so neither a hot source
    nor one length that a third of all rows share meets in a task. Rows that are equal in id and text are interchangeable.
    Null texts have size 0 and are not taken; null sources are one source, the last; rows without an id are mixed like
    any other; no rows: no decisions. Other columns are not looked at.
    """
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    sized = stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words().alias("size"), F.xxhash64("text").alias("text_hash"), key.alias("key")), "mix-sizes")
    plan = stored(planned(sized.groupBy("source", "size").agg(F.count("*").alias("n"))), "mix-plan")
    known = plan.withColumnsRenamed({"source": "_source", "size": "_size"})
    rows = sized.join(known, (F.col("size") == F.col("_size")) & F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "_size")
    rows = rows.withColumn("contested", (F.col("extra") > 0) & (F.col("extra") < F.col("n")))
    ranges = F.ceil(F.col("n") / RANKED)
    # the share of the key's range below the key, so that range numbers ascend with the key
    rows = rows.withColumn("part", F.floor((F.shiftrightunsigned("key", 32) * ranges) / F.lit(2**32)))
    contested = rows.where("contested")
    up_to = Window.partitionBy("source", "size").orderBy("part")
    parts = contested.groupBy("source", "size", "part", "extra").agg(F.count("*").alias("here")).withColumn("below", F.sum("here").over(up_to) - F.col("here"))
    at_cut = parts.where((F.col("below") < F.col("extra")) & (F.col("below") + F.col("here") >= F.col("extra"))).select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("part").alias("cut"), (F.col("extra") - F.col("below")).alias("wanted"))
    held = contested.join(at_cut, (F.col("size") == F.col("_size")) & F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "_size")
    out = ["doc_id", "text_hash", "source", "size", "source_size", "target"]
    sure = rows.where(~F.col("contested")).select(*out, F.when(F.col("size") == 0, 0).otherwise(F.col("full") + (F.col("extra") > 0).cast("long")).alias("copies"))
    clear = held.where(F.col("part") != F.col("cut")).select(*out, (F.col("full") + (F.col("part") < F.col("cut")).cast("long")).alias("copies"))
    place = F.row_number().over(Window.partitionBy("source", "size").orderBy("key", "doc_id", "text_hash"))
    ranked = held.where(F.col("part") == F.col("cut")).withColumn("place", place).select(*out, (F.col("full") + (F.col("place") <= F.col("wanted")).cast("long")).alias("copies"))
    return sure.unionByName(clear).unionByName(ranked)


def taken(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns, whatever their names.

    Rows equal in id and text share their copies evenly. Null, empty and wordless texts are never taken, texts of any length are
    taken whole; rows without an id are taken like others, no rows give no rows.
    """
    spark = docs.sparkSession
    decided = settled(spark, "mix-copies", lambda: mixed(docs, seed).groupBy("doc_id", "text_hash").agg(F.sum("copies").alias("copies"), F.count("*").alias("n")).where("copies > 0"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    same = F.col("rows.doc_id").eqNullSafe(F.col("decided.doc_id")) & (F.col("rows.text_hash") == F.col("decided.text_hash"))
    joined = rows.alias("rows").join(decided.alias("decided"), same).select("row", "decided.*")
    # only repeated rows are numbered
    place = F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy(F.lit(0)))
    single = joined.where("n = 1").select("row", "copies")
    several = joined.where("n > 1").withColumn("place", place).select("row", (F.floor(F.col("copies") / F.col("n")) + (F.col("place") <= F.col("copies") % F.col("n")).cast("long")).alias("copies"))
    return single.unionByName(several).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


@query("op9_mixing")
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = mixed(table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return decided.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
