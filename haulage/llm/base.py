"""Registration of the queries of this folder, and what several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The white space that separates words and surrounds lines: space and the ASCII controls 9 to 13.
SPACE = " \t\n\x0b\x0c\r"


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is DuckDB SQL for the same rows where SQL can express them."""
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def whole_text(column: str = "text") -> Column:
    """A text with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def id_text(column: str) -> Column:
    """An id on its way through pandas: a long column with a null would arrive as floats, which are exact up to 2^53 only."""
    return F.col(column).cast("long").cast("string").alias(column)


def id_back(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("long"))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like these that ``df`` has no column of, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def tasks_for(spark: SparkSession, amount: int, per_task: int) -> int:
    """Tasks for a pass in which every task hands on a table of its own: two for each core, more where a task would get more than
    ``per_task``, so that they grow with the input."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-amount // per_task))


def in_slices(batches, size: int = 4 << 20):
    """The rows of Arrow-fed pandas frames again, in frames of about ``size`` characters of their last column.

    A batch has a fixed number of rows, which says nothing about the length of its texts.
    """
    for frame in batches:
        lengths = frame.iloc[:, -1].str.len().fillna(0).to_numpy()
        start = total = 0
        for i, n in enumerate(lengths):
            total += n
            if total >= size:
                yield frame.iloc[start:i + 1]
                start, total = i + 1, 0
        if start < len(frame):
            yield frame.iloc[start:]
