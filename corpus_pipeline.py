"""From raw documents to token ids: quality, repeated lines, near copies, source weights, encoding.

Every stage takes the documents that the stage before kept, applies one operator and returns the columns of ``documents``
(the last one returns the encoding). Between stages the documents are written as Parquet and read again.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.llm import jaccard, lines, mixing, pieces, quality
from haulage.llm.base import SPACE, table, whole_text
from haulage.session import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Rows that a Python worker is handed at once at most: texts may be long, and a worker keeps the memory that it once took.
ROWS_AT_ONCE = 1000


def in_small_batches(stage):
    """A stage whose Python workers get few rows at once; a smaller setting of the session stays."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        name = "spark.sql.execution.arrow.maxRecordsPerBatch"
        rows = int(spark.conf.get(name))
        if not 0 < rows <= ROWS_AT_ONCE:
            spark.conf.set(name, ROWS_AT_ONCE)
        return stage(spark, docs, sf_dir)
    return run_stage


@in_small_batches
def of_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of the input, does not reject. Null and empty texts are scored like
    others, repeated rows alike, long texts whole; no rows stay none where there are labels to learn from."""
    weights = quality.trained(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.good(docs.select(*COLUMNS), weights)


@in_small_batches
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; ``n_chars`` follows. A document that lost lines and has no
    words left goes."""
    done = lines.without_repeated_lines(docs.select(*COLUMNS))
    left = (F.col("n_dropped") == 0) | (F.btrim("text", F.lit(SPACE)) != "")
    return done.where(left).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@in_small_batches
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies (five-word shingles, similarity 0.8): the one with the smallest doc_id. Texts
    without words, rows without an id and rows with the same id stay."""
    groups = jaccard.similar_groups(docs.select("doc_id", "text"))
    gone = groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")


@in_small_batches
def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them; null sources are one source, texts without words are not taken."""
    return mixing.taken(docs.select(*COLUMNS))


@in_small_batches
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document as a digest, and whether they decode to the text; null texts are empty, repeated rows are
    answered each."""
    return pieces.digests(docs.select("doc_id", whole_text().alias("text")), pieces.piece_model())


STAGES = [
    ("quality classifier", of_good_quality),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_near_copies),
    ("mixing sources to target weights", mixed_to_weights),
    ("SentencePiece encoding and decoding", encoded),
]

#: The classifier's weights come from training, which SQL cannot express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.split(" ")[0].lower())
    return docs
