"""Text expressions: keys, names, masks, cleaning and array rendering."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def key_part(key: Column, pos: int, sep: str = "/") -> Column:
    """Part ``pos`` (from 1) of ``a/b/c``; NULL when there is no such part."""
    return F.nullif(F.split_part(key, F.lit(sep), F.lit(pos)), F.lit(""))


def last_segment(text: Column, sep: str = ".") -> Column:
    return F.substring_index(text, sep, -1)


def ascii_name(name: Column, ident: Column) -> Column:
    """The part after ``#`` without non-ASCII characters; the id when nothing is left."""
    kept = F.regexp_replace(F.regexp_replace(last_segment(name, "#"), r"[^\x00-\x7F]", ""), r"^\s+|\s+$", "")
    return F.coalesce(F.nullif(kept, F.lit("")), ident.cast("string"))


def glob_regex(mask: str) -> str:
    """An anchored regex for ``*`` and ``?``; both also match ``/``."""
    return "(?s)^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in mask) + "$"


def matches_glob(text: Column, mask: str) -> Column:
    return text.rlike(glob_regex(mask))


def without_prefixes(ident: Column, prefixes: list[str]) -> Column:
    """True when ``ident`` starts with none of the prefixes (``_`` is an ordinary character here)."""
    keep = F.lit(True)
    for prefix in prefixes:
        keep = keep & ~ident.startswith(prefix)
    return keep


def file_name_ok(name: Column, max_bytes: int = 240) -> Column:
    """Lower case, only ``[a-z0-9_-]`` before the extension, at most ``max_bytes`` bytes."""
    return name.rlike(r"^[a-z0-9_-]+(\.[a-z0-9]+)*$") & (F.octet_length(name) <= max_bytes)


def table_from_file(name: Column) -> Column:
    """The file name cut at the first blank, quote, colon, semicolon or dot."""
    return F.regexp_extract(last_segment(name, "/"), r"""^[^ '":;.]*""", 0)


def sanitize(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Apply ``(pattern, replacement)`` pairs in order."""
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def sanitize_frame(df, rules: list[tuple[str, str]], arrays: bool = False, columns: list[str] | None = None):
    """Sanitize every string column (and, when asked, the elements of string arrays)."""
    out = []
    for field in df.schema:
        kind = field.dataType.simpleString()
        col = F.col(f"`{field.name}`")
        if columns is None or field.name in columns:
            if kind == "string":
                col = sanitize(col, rules)
            elif arrays and kind == "array<string>":
                col = F.transform(col, lambda x: sanitize(x, rules))
        out.append(col.alias(field.name))
    return df.select(*out)


def array_text(col: Column, element: str, style: str = "pg") -> Column:
    """An array as text: ``{a,b}`` (``pg``) or ``['a','b']`` (``ch``)."""
    is_text = element == "string"
    if style == "pg":
        def item(x: Column) -> Column:
            raw = x.cast("string")
            if not is_text:
                return F.coalesce(raw, F.lit("NULL"))
            quoted = F.concat(F.lit('"'), F.regexp_replace(raw, r'(["\\])', r"\\$1"), F.lit('"'))
            needs = (raw == "") | raw.rlike(r'[{}",\\\s]') | (F.upper(raw) == "NULL")
            return F.coalesce(F.when(needs, quoted).otherwise(raw), F.lit("NULL"))
        return F.concat(F.lit("{"), F.array_join(F.transform(col, item), ","), F.lit("}"))

    def item(x: Column) -> Column:
        raw = x.cast("string")
        if not is_text:
            return F.coalesce(raw, F.lit("NULL"))
        body = F.regexp_replace(raw, r"(['\\])", r"\\$1")
        for char, name in (("\n", "n"), ("\t", "t"), ("\r", "r")):
            body = F.regexp_replace(body, char, rf"\\{name}")
        return F.coalesce(F.concat(F.lit("'"), body, F.lit("'")), F.lit("NULL"))
    return F.concat(F.lit("["), F.array_join(F.transform(col, item), ","), F.lit("]"))


def arrays_as_text(df, style: str = "pg"):
    """Replace every array column by its text form."""
    out = []
    for field in df.schema:
        kind = field.dataType.simpleString()
        col = F.col(f"`{field.name}`")
        if kind.startswith("array<"):
            col = array_text(col, kind[6:-1], style)
        out.append(col.alias(field.name))
    return df.select(*out)


def column_count(line: Column, sep: str = "\t") -> Column:
    """Number of fields in a line, counted by the separator."""
    return F.size(F.split(line, re.escape(sep), -1))


def digit_set(text: Column) -> Column:
    """The whole numbers of a comma list, without repeats, sorted, joined by commas."""
    parts = F.transform(F.split(text, ","), lambda x: F.trim(x))
    numbers = F.transform(F.filter(parts, lambda x: x.rlike(r"^[0-9]+$")), lambda x: x.cast("bigint"))
    return F.array_join(F.transform(F.sort_array(F.array_distinct(numbers)), lambda x: x.cast("string")), ",")
