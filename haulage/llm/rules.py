"""Quality rules whose limits come from the corpus itself.

Per language and source every metric is summarised by a quantile sketch: counts by logarithmic bucket with 32 buckets to an
octave, so a quantile is right to about 3 %. Sketches are merged by adding counts, in any order and with equal results, which
is what partial aggregation does before the shuffle; a hot source costs one row per bucket and task. The limits per
language and source are then joined to the documents' metrics, not to their texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from haulage.llm.base import id_back, id_text, in_slices, query, table, whole_text
from haulage.session import stored

#: Fewest words, and largest share of words in repeated three-word windows in percent.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Rates that are held against limits: numerator, denominator, floor of the distance from the median (in thousandths).
RATES = {"letters": ("word_chars", "n_words", 4000), "symbols": ("n_symbols", "n_words", 150), "repeats": ("n_repeat_words", "n_words", 350), "dup_lines": ("n_dup_lines", "n_lines", 450)}
#: A rate may exceed the median by this many times the distance between the median and the upper quartile.
REACH = 8
#: Linear buckets below, and buckets to an octave above.
STEPS = 32

SYMBOLS = b"#*$%&|<>"
MEASURES = "doc_id string, lang string, source string, n_words long, n_lines long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def measure(text: str) -> tuple[int, int, int, int, int, int]:
    """n_words, n_lines, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    data = text.encode()
    words = data.split()
    n = len(words)
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    whole = b"".join(words)
    chars = len(whole) if whole.isascii() else len(whole.decode())
    lines, seen, dup = data.split(b"\n"), set(), 0
    for line in lines:
        if line in seen:
            dup += 1
        elif line and not line.isspace():
            seen.add(line)
    repeats = 0
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) < len(windows):
        reach = 0  # first word that is not yet counted
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeats += i + 3 - max(i, reach)
                reach = i + 3
    return n, len(lines), chars, symbols, dup, repeats


def measured(docs: DataFrame) -> DataFrame:
    """The base metrics of every document, row by row and without a shuffle."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["n_words", "n_lines", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        for frame in in_slices(batches, 16 << 20):
            found = pd.DataFrame([measure(t) for t in frame["text"]], columns=names, dtype=np.int64)
            yield pd.concat([frame.iloc[:, :3].reset_index(drop=True), found], axis=1)

    texts = docs.select(id_text("doc_id"), F.col("lang").cast("string"), F.col("source").cast("string"), whole_text().alias("text"))
    return id_back(texts.mapInPandas(run, MEASURES), "doc_id")


def bucket(rate: Column) -> Column:
    """The sketch's bucket of a whole number from 0: itself below 32, from there 32 buckets to each doubling."""
    octave = F.length(F.bin(rate)) - 6
    return F.when(rate < STEPS, rate).otherwise((octave + 1) * STEPS + F.call_function("shiftright", rate, octave.cast("int")) - STEPS)


def bucket_floor(number: Column) -> Column:
    """The smallest number of a bucket."""
    octave = F.floor(number / STEPS) - 1
    return F.when(number < STEPS, number).otherwise(F.call_function("shiftleft", F.pmod(number, F.lit(STEPS)) + STEPS, octave.cast("int")))


def rate(name: str) -> Column:
    over, under, _ = RATES[name]
    return F.floor(F.col(over) * 1000 / F.greatest(F.col(under), F.lit(1))).cast("long")


def sketches(metrics: DataFrame) -> DataFrame:
    """Mergeable quantile sketches: (lang, source, rate, bucket, n) over the documents that pass the base rules."""
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("rate"), bucket(rate(name)).cast("long").alias("bucket")) for name in RATES])).alias("r")
    return metrics.where(~F.col("base_failed")).select("lang", "source", each).groupBy("lang", "source", "r.rate", "r.bucket").agg(F.count("*").alias("n"))


def limits(sketch: DataFrame) -> DataFrame:
    """Limits per language and source, one column a rate: median + 8 times (upper quartile - median), with a floor for
    the distance, so that a source without any spread does not lose what differs by a hair."""
    group = Window.partitionBy("lang", "source", "rate")
    up_to = group.orderBy("bucket")
    summed = sketch.withColumn("below", F.sum("n").over(up_to)).withColumn("total", F.sum("n").over(group))
    quantile = lambda q: F.min(F.when(F.col("below") >= F.ceil(F.col("total") * q / 100), bucket_floor(F.col("bucket"))))
    per_rate = summed.groupBy("lang", "source", "rate").agg(quantile(50).alias("mid"), quantile(75).alias("high"))
    floors = F.create_map(*chain.from_iterable((F.lit(n), F.lit(f)) for n, (_, _, f) in RATES.items()))
    bound = F.col("mid") + F.greatest(REACH * (F.col("high") - F.col("mid")), floors[F.col("rate")])
    return per_rate.groupBy("lang", "source").agg(*[F.max(F.when(F.col("rate") == n, bound)).alias(f"most_{n}") for n in RATES])


def judged(docs: DataFrame) -> DataFrame:
    """Metrics and verdict of every row of ``(doc_id, lang, source, text)``.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated three-word windows. ``kept``: not base
    failed, and no rate above the limit of its language and source (null languages and sources are groups of their own; a
    group without a document that passes the base rules keeps none). Null texts are empty and fail. Repeated rows and
    rows without an id are judged like any other; other columns are not looked at.
    """
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    metrics = stored(measured(docs).withColumn("base_failed", failed), "rule-metrics")
    bounds = limits(sketches(metrics)).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    held = metrics.join(bounds, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    within = F.lit(True)
    for name in RATES:
        within = within & (rate(name) <= F.col(f"most_{name}"))
    return held.withColumn("kept", ~F.col("base_failed") & F.coalesce(within, F.lit(False)))


OUT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]

_W = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
_RATES_SQL = "\n    UNION ALL ".join(f"SELECT doc_id, rn, lang, source, base_failed, '{n}' AS rate, (({o} * 1000) // greatest({u}, 1)) AS v, {f} AS slack FROM base" for n, (o, u, f) in RATES.items())
SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS rn, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, {_W} AS ws, string_split(text, chr(10)) AS ls FROM docs),
windows AS (SELECT rn, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w FROM (SELECT rn, ws, unnest(range(1, greatest(len(ws) - 1, 1))) AS i FROM split)),
again AS (SELECT rn, i FROM (SELECT rn, i, count(*) OVER (PARTITION BY rn, w) AS c FROM windows) WHERE c > 1),
covered AS (SELECT rn, count(DISTINCT i + j) AS n FROM again, (VALUES (0), (1), (2)) AS t(j) GROUP BY rn),
lines AS (SELECT rn, unnest(ls) AS l FROM split),
dups AS (SELECT rn, sum(c - 1) AS n FROM (SELECT rn, l, count(*) AS c FROM lines WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rn, l) GROUP BY rn),
counted AS (
    SELECT s.rn, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ls) AS BIGINT) AS n_lines, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
    FROM split s LEFT JOIN dups d USING (rn) LEFT JOIN covered c USING (rn)),
base AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM counted),
rates AS ({_RATES_SQL}),
octaves AS (SELECT *, CASE WHEN v < {STEPS} THEN 0 ELSE length(bin(v)) - 6 END AS o FROM rates),
floored AS (SELECT *, CASE WHEN v < {STEPS} THEN v ELSE (v >> CAST(o AS INTEGER)) << CAST(o AS INTEGER) END AS f FROM octaves),
ranked AS (SELECT *, row_number() OVER g AS k, count(*) OVER (PARTITION BY lang, source, rate) AS total FROM floored WHERE NOT base_failed WINDOW g AS (PARTITION BY lang, source, rate ORDER BY f)),
bounds AS (SELECT lang, source, rate, max(slack) AS slack, min(f) FILTER (k >= ceil(total * 50 / 100)) AS mid, min(f) FILTER (k >= ceil(total * 75 / 100)) AS high FROM ranked GROUP BY lang, source, rate),
verdicts AS (SELECT r.rn, bool_and(coalesce(r.v <= b.mid + greatest({REACH} * (b.high - b.mid), b.slack), false)) AS ok FROM rates r LEFT JOIN bounds b
    ON r.lang IS NOT DISTINCT FROM b.lang AND r.source IS NOT DISTINCT FROM b.source AND r.rate = b.rate GROUP BY r.rn)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND ok AS kept FROM base JOIN verdicts USING (rn)"""


@query("op5_rules", SQL)
def op5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents", "doc_id", "lang", "source", "text")).select(*OUT)
