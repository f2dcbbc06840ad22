"""Personal data: four base kinds by pattern, and unseen identifiers by bootstrapped contexts.

All of it is DataFrame functions. Base entities are seeds. The words beside a seed are its lexical patterns; other tokens
that look like identifiers are instances that the same patterns may surround. Patterns and instances form a graph that is
scored in turns: a pattern is as good as the share of its instances that are known or believed, an instance is believed as
far as its patterns are good. Instances that confident patterns surround are added to the base spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from haulage.llm.base import SPACE, query, table, whole_text
from haulage.session import stored

KINDS = ("email", "ip", "card", "phone")

#: Patterns of the base kinds. They match what the plain patterns match, but never try again inside a run of characters
#: that has already failed as a whole, and give nothing back, so that a long run costs one pass.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Tokens that may be identifiers: six characters or more with a digit or an at sign among them.
INSTANCE = r"(?:\G|(?<![A-Za-z0-9@._%+/-]))(?=[A-Za-z._%+/-]*+[0-9@])[A-Za-z0-9@._%+/-]{6,}+"
#: Words on each side of an entity that patterns are made of.
BESIDE = 2
#: Rounds of scoring; seeds that a pattern needs; scores from which a pattern and an instance are trusted.
ROUNDS, LEAST_SEEDS, TRUSTED_PATTERN, TRUSTED_INSTANCE = 3, 3, 0.8, 0.8


def _parts(pattern: str, hint: Column) -> Column:
    """Matches of a pattern with the text before and after each: one struct a match, none where the hint says so."""
    pieces = F.split(F.col("text"), pattern, -1)
    hits = F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(0))
    plain = lambda piece: F.btrim(F.translate(F.lower(piece), SPACE, " " * len(SPACE)), F.lit(" "))
    before = lambda piece: F.btrim(F.substring_index(plain(piece), " ", -BESIDE), F.lit(" "))
    after = lambda piece: F.btrim(F.substring_index(plain(piece), " ", BESIDE), F.lit(" "))
    cut = F.transform(pieces, lambda p: F.struct(F.length(p).alias("gap"), before(p).alias("left"), after(p).alias("right")))
    n = F.size(hits)
    zipped = F.arrays_zip(hits.alias("hit"), F.slice(cut, 1, n).alias("at"), F.slice(cut, 2, n).alias("next"))
    found = F.transform(zipped, lambda z: F.struct(z["hit"].alias("hit"), z["at"]["gap"].alias("gap"), z["at"]["left"].alias("left"), z["next"]["right"].alias("right")))
    return F.when(hint, found)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(d.cast("int") > 4, 2 * d.cast("int") - 9).otherwise(2 * d.cast("int"))))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def _valid(kind: Column, hit: Column) -> Column:
    """Whether a match is an entity of its kind."""
    digits = _digits(hit)
    parts = F.transform(F.split(hit, r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))
    n = F.length(digits)
    return (F.when(kind == "email", F.lit(True)).when(kind == "ip", F.forall(parts, lambda p: p))
            .when(kind == "card", F.when(n.between(14, 19), _luhn(digits)).otherwise(F.lit(False))).otherwise(n.between(10, 15)))


def matches(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end, hit, left, right) for every match in the texts, kind ``other`` for instances; ``left``
    and ``right`` are the words beside it, however long they are and however far away.

    The gaps and lengths of the matches of a row add up to their places, in code points; only matches are shuffled for it, not
    texts. Rows equal in id and text give each match once.
    """
    some = F.col("text").rlike("[0-9]")
    hints = {"email": F.col("text").contains("@"), "ip": some, "card": some, "phone": F.col("text").contains("+"), "other": some | F.col("text").contains("@")}
    found = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), *[_parts(p, hints[k]).alias(k) for k, p in {**PATTERNS, "other": INSTANCE}.items()])
    found = stored(found.where(F.coalesce(*[F.when(F.size(k) > 0, F.lit(True)) for k in hints], F.lit(False))), "pii-matches")
    rows = None
    for kind in hints:
        own = found.select("doc_id", "text_hash", F.lit(kind).alias("kind"), F.posexplode(kind).alias("i", "m")).select("doc_id", "text_hash", "kind", "i", "m.*")
        rows = own if rows is None else rows.unionByName(own)
    rows = rows.distinct()
    end = F.sum(F.col("gap") + F.length("hit")).over(Window.partitionBy("doc_id", "text_hash", "kind").orderBy("i"))
    return rows.withColumn("end", end.cast("long")).withColumn("start", F.col("end") - F.length("hit")).drop("i", "gap")


def contexts() -> Column:
    """The lexical patterns around a match: the word and the two words on its left, on its right, and the word on both sides. The
    more words, the rarer the pattern and the less of a background it has."""
    left, right = F.substring_index("left", " ", -1), F.substring_index("right", " ", 1)
    said = lambda *texts: F.forall(F.array(*texts), lambda t: t != "")
    return F.array_compact(F.array(
        F.when(said(left), F.concat(F.lit("l "), left)), F.when(said(right), F.concat(F.lit("r "), right)), F.when(said(left, right), F.concat(F.lit("b "), left, F.lit(" _ "), right)),
        F.when(F.col("left").contains(" "), F.concat(F.lit("l "), "left")), F.when(F.col("right").contains(" "), F.concat(F.lit("r "), "right"))))


def learnt(base: DataFrame, others: DataFrame) -> DataFrame:
    """Instances (hit, kind) among ``others`` that the patterns of the base entities discover."""
    sides = F.explode(contexts()).alias("pattern")
    seeds = base.select("kind", "hit", sides).groupBy("kind", "pattern").agg(F.count("*").alias("seeds"), F.count_distinct("hit").alias("distinct_seeds"))
    edges = stored(others.select("hit", sides).groupBy("hit", "pattern").agg(F.count("*").alias("n")), "pii-edges")
    # the graph of a kind: patterns that enough different seeds have induced, with all instances beside them
    good = stored(seeds.where(F.col("distinct_seeds") >= LEAST_SEEDS), "pii-patterns")
    every = seeds.groupBy("pattern").agg(F.sum("seeds").alias("all_seeds"))
    graph = stored(edges.join(good, "pattern").join(every, "pattern"), "pii-graph")
    belief = graph.select("kind", "hit").distinct().withColumn("score", F.lit(0.0))
    weighed = None
    for _ in range(ROUNDS):
        believed = graph.join(belief, ["kind", "hit"])
        pattern = believed.groupBy("kind", "pattern").agg(((F.first("seeds") + F.sum(F.col("n") * F.col("score"))) / (F.first("all_seeds") + F.sum("n") + 1)).alias("worth"))
        weighed = graph.join(pattern, ["kind", "pattern"])
        belief = stored(weighed.groupBy("kind", "hit").agg((F.sum(F.col("n") * F.col("worth")) / F.sum("n")).alias("score")), "pii-belief")
    trusted = weighed.where(F.col("worth") >= TRUSTED_PATTERN).select("kind", "hit").distinct()
    return trusted.join(belief.where(F.col("score") >= TRUSTED_INSTANCE), ["kind", "hit"]).groupBy("hit").agg(F.max_by("kind", F.struct("score", "kind")).alias("kind"))


def entities(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end, hit, base) of all entities in ``(doc_id, text)``; ``base`` tells seeds from
    discovered ones. Null texts are empty; texts without digits and at signs cost a look for them and nothing else."""
    every = stored(matches(docs.select("doc_id", whole_text().alias("text"))), "pii-places")
    base = stored(every.where((F.col("kind") != "other") & _valid(F.col("kind"), F.col("hit"))), "pii-base")
    spans = base.select(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_hash"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    others = every.where("kind = 'other'").drop("kind")
    beside = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_hash")) & (F.col("start") < F.col("_end")) & (F.col("_start") < F.col("end"))
    free = stored(others.join(spans, beside, "left_anti"), "pii-instances")
    found = free.join(learnt(base, free), "hit").select("doc_id", "text_hash", "kind", "start", "end", "hit", F.lit(False).alias("base"))
    return base.select("doc_id", "text_hash", "kind", "start", "end", "hit", F.lit(True).alias("base")).unionByName(found)


def _joined(spans: Column) -> Column:
    """kind:start:end by start and kind as listed, joined by commas."""
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, and all spans, for every row of ``(doc_id, text)``.

    Counts and digest cover the base entities; ``spans`` also has the discovered ones. Rows without matches have zeros, the
    digest of the empty text and no spans. Repeated rows are each answered; rows without an id are answered by their text.
    """
    docs = docs.select("doc_id", whole_text().alias("text"))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", rank.alias("rank"), "end", "kind")
    per_row = entities(docs).groupBy("doc_id", "text_hash").agg(
        *[F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.collect_list(F.when(F.col("base"), span))), 256).alias("base_sha256"), _joined(F.collect_list(span)).alias("spans"))
    named = per_row.withColumnsRenamed({"doc_id": "_doc_id", "text_hash": "_hash"})
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"))
    held = rows.join(named, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    return held.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
                       F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents", "doc_id", "text"))
