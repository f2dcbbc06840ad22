"""Spelling variants: words one letter apart, found by bidirectional search schemes over an FM-index.

A word that is one error away from another leaves one half of it alone. So a word is searched twice: its first half is matched
exactly and the rest is extended with one error, and the same from the other end, over the reversed words. The vocabulary is cut
into groups by what the exact half fixes, the length and the first letters of a word (the last ones for the reversed search), so a
search only needs the groups of three lengths. Every group is an index of bounded size in one task. A beginning that many words
share is cut into blocks, and its searches into as many, and every pair of blocks is a group of its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulage.llm.base import in_slices, query, table, whole_text
from haulage.llm.fmindex import Index
from haulage.session import stored

#: Code points of a word at least, occurrences at least, and how many times more often than a word its form must occur.
LEAST_CHARS, LEAST_COUNT, RATIO = 5, 3, 2
#: One in so many (document, word) pairs loses a letter.
ONE_IN = 97
#: Words of one index in expectation, and of a block of words that share their beginning at most.
BLOCK = 20_000
#: Different words that a task counts before it passes the counts on.
COUNTED = 300_000

_WORD = re.compile("[A-Za-zÀ-ÿ]+")


def words_of(doc_id: str | None, text: str) -> Counter:
    """Words of a text and how often they stand there, one of ``ONE_IN`` with a letter left out."""
    counts: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.encode().lower().decode())).items():
        h = zlib.crc32(f"{doc_id or ''}:{word}".encode())
        if h % ONE_IN == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1:]
        if len(word) >= LEAST_CHARS:
            counts[word] += n
    return counts


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): how often each word stands in all of ``(doc_id, text)``, for words met often enough. Counts are added up in
    the tasks before they are shuffled."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for frame in in_slices(batches):
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                counts.update(words_of(doc_id, text))
                if len(counts) >= COUNTED:
                    yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})
                    counts = Counter()
        if counts:
            yield pd.DataFrame({"word": list(counts), "n": list(counts.values())})

    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), whole_text().alias("text"))
    counted = texts.mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT)


def _group(length: Column, word: Column) -> Column:
    """What a word of this length shares with every search that may find it: the length and the first letters."""
    return F.xxhash64("back", length, F.left(word, F.floor((length - 1) / 2).cast("int")))


def near(words: DataFrame) -> DataFrame:
    """(word, other, other_n): every ordered pair of different ``(word, n)`` one inserted, deleted or replaced letter apart."""
    both = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    both = both.withColumn("turned", F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))).withColumn("length", F.length("word"))
    both = stored(both, "variant-words")
    held = both.select(_group(F.col("length"), F.col("turned")).alias("group"), "back", "turned", "n")
    asked = both.withColumn("other", F.explode(F.sequence(F.col("length") - 1, F.col("length") + 1))).where(F.col("other") > 0)
    asked = asked.select(_group(F.col("other"), F.col("turned")).alias("group"), "back", "turned", F.lit(None).cast("long").alias("n"))
    sizes = stored(held.groupBy("group").agg(F.count("*").alias("members")), "variant-groups")
    indexes = F.lit(max(1, -(-2 * words.count() // BLOCK)))
    # few groups are larger than a block; all others are dealt to the indexes by their hash
    large = sizes.where(F.col("members") > BLOCK).select(F.col("group").alias("_group"), F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    rows = held.unionByName(asked).join(sizes.select(F.col("group").alias("_met")), F.col("group") == F.col("_met"), "left_semi")
    placed = rows.join(large, F.col("group") == F.col("_group"), "left").withColumn("own", F.pmod(F.xxhash64("turned"), "blocks").cast("int"))
    across = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("across")
    dealt = placed.select(F.when(F.col("blocks").isNull(), F.pmod("group", indexes)).otherwise(F.col("group")).alias("cell"), F.col("blocks").isNotNull().alias("split"),
                          F.coalesce("own", F.lit(0)).alias("own"), across, "back", "turned", "n")
    word_block = F.when(F.col("n").isNotNull(), F.col("own")).otherwise(F.col("across"))
    ask_block = F.when(F.col("n").isNotNull(), F.col("across")).otherwise(F.col("own"))
    cells = dealt.select("cell", "split", word_block.alias("word_block"), ask_block.alias("ask_block"), "back", "turned", "n")

    def search(group: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[str, str, int]] = []
        for back in (False, True):
            here = group[group["back"] == back]
            known = here["n"].notna()
            if known.any() and not known.all():
                found += pairs(here.loc[known, "turned"].tolist(), here.loc[known, "n"].astype("int64").tolist(), here.loc[~known, "turned"].drop_duplicates().tolist(), back)
        return pd.DataFrame(found, columns=["word", "other", "other_n"])

    return cells.groupBy("cell", "split", "word_block", "ask_block").applyInPandas(search, "word string, other string, other_n long")


def pairs(words: list[str], counts: list[int], asked: list[str], back: bool) -> list[tuple[str, str, int]]:
    """What the searches ``asked`` find among ``words``, all reversed if ``back``; pairs that also agree in the other half are
    left to the forward search."""
    at, found = Index(words).one_off(asked, np.fromiter(((len(a) + back) // 2 for a in asked), np.int64, len(asked)))
    met = ((asked[i], words[j], counts[j]) for i, j in zip(at.tolist(), found.tolist()))
    if not back:
        return list(met)
    turned = ((a[::-1], b[::-1], n) for a, b, n in met)
    return [(a, b, n) for a, b, n in turned if not b.startswith(a[:len(a) // 2])]


def rooted(forms: DataFrame) -> DataFrame:
    """(word, root) for every ``(word, form)``: the end of the way from form to form. Every round doubles the steps that are
    taken at once, and counts at least double along the way, so there are few rounds."""
    steps = stored(forms.select("word", F.col("form").alias("root")), "variant-steps")
    while True:
        ahead = steps.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = stored(steps.join(ahead, F.col("root") == F.col("_word"), "left").select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("on")), "variant-steps")
        steps = moved.select("word", "root")
        if moved.where("on").isEmpty():
            return steps


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``(doc_id, text)`` that is long and frequent enough.

    Words are runs of letters with A-Z in lower case, a few with a letter left out (see ``words_of``). ``form`` is the most
    frequent word one letter apart, by code points if several are, where it occurs at least ``RATIO`` times as often; null where
    there is none. ``root`` is where forms lead in the end, the word itself without a form. Null and empty texts have no words;
    texts and words of any length are counted whole; repeated rows count as often as they stand; rows without an id have an empty
    one; no words give no rows. Other columns are not looked at.
    """
    words = stored(vocabulary(docs.select("doc_id", "text")), "variant-vocabulary")
    best = near(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min_by("other", F.struct(-F.col("other_n"), F.col("other"))).alias("form"), F.max("other_n").alias("form_n"))
    good = F.col("form_n") >= RATIO * F.col("n")
    formed = stored(words.join(best.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left").select(
        "word", F.when(good, F.col("form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("form_n")).alias("form_n")), "variant-forms")
    ends = rooted(formed.where("form IS NOT NULL")).withColumnRenamed("word", "_word")
    return formed.join(ends, F.col("word") == F.col("_word"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_FLIP = "CASE WHEN {0} % 2 = 1 THEN xor(3988292384, {0} // 2) ELSE {0} // 2 END"
SQL = f"""
WITH RECURSIVE bits(b, k, v) AS (SELECT b, 0, CAST(b AS BIGINT) FROM range(256) t(b) UNION ALL SELECT b, k + 1, {_FLIP.format('v')} FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY b) AS t FROM bits WHERE k = 8),
runs AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents) GROUP BY doc_id, w),
hashed AS (SELECT w, n, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(doc_id || ':' || w, ''),
    lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [CAST(192 + ord(c) // 64 AS BIGINT), CAST(128 + ord(c) % 64 AS BIGINT)] END))),
    lambda a, b: xor(t[xor(a, b) % 256 + 1], a // 256))) AS h FROM runs CROSS JOIN crc),
cut AS (SELECT CASE WHEN h % {ONE_IN} = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= {LEAST_CHARS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
less AS (SELECT DISTINCT word, n, left(word, i - 1) || substr(word, i + 1) AS k FROM places),
gaps AS (SELECT word, n, i, left(word, i - 1) || ' ' || substr(word, i + 1) AS k FROM places),
near AS (SELECT l.word, w.word AS other, w.n AS other_n FROM less l JOIN words w ON l.k = w.word
    UNION ALL SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.k = w.word
    UNION ALL SELECT a.word, b.word, b.n FROM gaps a JOIN gaps b ON a.k = b.k AND a.word <> b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS form_n FROM near GROUP BY word),
named AS (SELECT b.word, n_near, form_n, min(other) AS form FROM best b JOIN near x ON x.word = b.word AND other_n = form_n GROUP BY b.word, n_near, form_n),
formed AS (SELECT w.word, CASE WHEN form_n >= {RATIO} * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {RATIO} * n THEN form_n END AS form_n FROM words w LEFT JOIN named USING (word)),
way(word, spot) AS (SELECT word, word FROM formed UNION ALL SELECT way.word, form FROM way JOIN formed f ON f.word = way.spot WHERE form IS NOT NULL)
SELECT f.word, f.form, spot AS root, f.n, f.n_near, f.form_n FROM formed f JOIN way ON way.word = f.word JOIN formed e ON e.word = way.spot WHERE e.form IS NULL"""


@query("op12_variants", SQL)
def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents", "doc_id", "text"))
