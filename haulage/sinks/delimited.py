"""Delimited text in several dialects."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

MINIMAL, ALL, NONNUMERIC, NONE = 0, 1, 2, 3
NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
# Types whose text has no other characters than these, and so nothing to escape in most dialects.
SIMPLE = (*NUMERIC, "boolean", "date", "timestamp")
SIMPLE_CHARS = frozenset("0123456789+-.: eETNaInfitytrulsb")


@dataclass(frozen=True)
class Dialect:
    """How fields are separated, quoted and escaped; the quoting numbers are those of the csv format."""

    delimiter: str = "\t"
    lineterminator: str = "\n"
    quotechar: str = '"'
    quoting: int = NONE
    escapechar: str | None = "\\"
    doublequote: bool = False

    @classmethod
    def of(cls, params: dict | None) -> "Dialect":
        return cls(**params) if params else cls()


PLAIN_TSV = Dialect()
# What other systems usually send.
FOREIGN_CSV = Dialect(delimiter=",", quoting=MINIMAL, escapechar=None, doublequote=True)


def _java(text: str) -> str:
    return text.replace("\\", "\\\\").replace("$", "\\$")


def field_text(value: Column, kind: str, d: Dialect) -> Column:
    """One field of the type ``kind`` as it appears in a line."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    numeric = kind.startswith(NUMERIC)
    marks = {d.delimiter, d.quotechar, "\r", "\n", *d.lineterminator, *([d.escapechar] if d.escapechar else [])}
    special = "".join(re.escape(c) for c in sorted(marks))
    if d.quoting == NONE:
        if not d.escapechar or kind.startswith(SIMPLE) and not marks & SIMPLE_CHARS:
            return text
        return F.regexp_replace(text, f"([{special}])", f"{_java(d.escapechar)}$1")
    body = text
    if d.escapechar:
        body = F.regexp_replace(body, re.escape(d.escapechar), _java(d.escapechar * 2))
    mark = d.quotechar * 2 if d.doublequote else f"{d.escapechar or ''}{d.quotechar}"
    body = F.regexp_replace(body, re.escape(d.quotechar), _java(mark))
    quoted = F.concat(F.lit(d.quotechar), body, F.lit(d.quotechar))
    if d.quoting == ALL:
        return quoted
    if d.quoting == NONNUMERIC:
        return F.when(value.isNull(), F.lit(d.quotechar * 2)).otherwise(text if numeric else quoted)
    return F.when(text.rlike(f"[{special}]"), quoted).otherwise(text)


def line_of(fields, dialect: Dialect = PLAIN_TSV) -> Column:
    """The given schema fields as one line without its terminator."""
    line = None
    for f in fields:
        text = field_text(F.col(f"`{f.name}`"), f.dataType.simpleString(), dialect)
        line = text if line is None else F.concat(line, F.lit(dialect.delimiter), text)
    return line


def line_bytes(fields, dialect: Dialect = PLAIN_TSV) -> Column:
    """Bytes of the line, without building it."""
    total = F.lit(len(dialect.delimiter.encode()) * (len(fields) - 1))
    for f in fields:
        total = total + F.octet_length(field_text(F.col(f"`{f.name}`"), f.dataType.simpleString(), dialect))
    return total


def as_lines(df: DataFrame, dialect: Dialect = PLAIN_TSV, keep: list[str] | None = None) -> DataFrame:
    """``value`` = the row as one line without its terminator; ``keep`` columns stay beside it."""
    keep = keep or []
    return df.select(*keep, line_of([f for f in df.schema if f.name not in keep], dialect).alias("value"))


def records_of(lines, dialect: Dialect = PLAIN_TSV):
    """Records of an open text file in the dialect it was written in; the other direction of :func:`line_of`."""
    import csv
    import sys

    csv.field_size_limit(sys.maxsize)
    return csv.reader(lines, delimiter=dialect.delimiter, quotechar=dialect.quotechar, quoting=csv.QUOTE_NONE if dialect.quoting == NONE else csv.QUOTE_MINIMAL,
                      escapechar=dialect.escapechar, doublequote=dialect.doublequote)


def header_line(columns: list[str], dialect: Dialect = PLAIN_TSV) -> str:
    import csv
    import io

    out = io.StringIO()
    csv.writer(out, delimiter=dialect.delimiter, lineterminator="", quotechar=dialect.quotechar, quoting=dialect.quoting,
               escapechar=dialect.escapechar, doublequote=dialect.doublequote).writerow(columns)
    return out.getvalue()


def with_headers(lines: DataFrame, header: str, dialect: Dialect) -> DataFrame:
    """Put the header line before the first line of every task, and so of every written file."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    return lines.select(F.when(first, F.concat(F.lit(header + dialect.lineterminator), "value")).otherwise(F.col("value")).alias("value"))


def write_csv(df: DataFrame, path: str, dialect: Dialect, compression: str = "none", header: bool = False) -> None:
    """Delimited files in any dialect, on request with a header line in each."""
    codec = "uncompressed" if compression == "none" else compression
    lines = as_lines(df, dialect)
    if header:
        lines = with_headers(lines, header_line(df.columns, dialect), dialect)
    lines.write.mode("overwrite").option("lineSep", dialect.lineterminator).option("compression", codec).text(path)


def write_tsv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Tab separated UTF-8 files, each with a header line; special characters are escaped, nothing is quoted."""
    write_csv(df, path, PLAIN_TSV, compression, header=True)
