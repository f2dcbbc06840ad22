"""JSON and literal texts inside columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

TEXT_MAP = "map<string,string>"


def _sorted_keys(value: Column, kind: T.DataType) -> Column:
    """A value with the fields of every struct and the keys of every map in order, at any depth."""
    if isinstance(kind, T.StructType):
        fields = [_sorted_keys(value[f.name], f.dataType).alias(f.name) for f in sorted(kind, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _sorted_keys(v, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.array_sort(F.transform(F.map_keys(value), lambda k: F.struct(k.alias("key"), _sorted_keys(value[k], kind.valueType).alias("value"))))
        return F.map_from_entries(entries)
    return value


def canonical_hash(schema: T.StructType, *names: str) -> Column:
    """MD5 of the JSON text of the named columns, with sorted keys at every depth."""
    fields = [_sorted_keys(F.col(f"`{n}`"), schema[n].dataType).alias(n) for n in sorted(names)]
    return F.md5(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}))


def literal_as_json(text: Column) -> Column:
    """A printed dict or list (single quotes, ``None``, ``True``) as JSON text."""
    swapped = F.translate(text, "'", '"')
    for word, repl in (("None", "null"), ("True", "true"), ("False", "false")):
        swapped = F.regexp_replace(swapped, rf"\b{word}\b", repl)
    return swapped


def is_literal(text: Column) -> Column:
    """True for a printed dict, list, tuple, number, quoted text or constant."""
    t = F.trim(text)
    return (
        t.rlike(r"^\{[\s\S]*\}$") | t.rlike(r"^\[[\s\S]*\]$") | t.rlike(r"^\([\s\S]*\)$")
        | t.rlike(r"^[+-]?\d+(\.\d+)?$") | t.rlike(r"^'[^']*'$") | t.rlike(r'^"[^"]*"$') | t.rlike(r"^(None|True|False)$")
    )


def parse_log(log: Column) -> Column:
    """``struct(step, data, msg)`` of a status text.

    Tried in order: a literal, ``STEP literal``, ``STEP text``, a bare text (which becomes the step).
    ``data`` is JSON text.
    """
    log = F.coalesce(log, F.lit(""))
    head = F.regexp_extract(log, r"^([^ ]*) ", 1)
    tail = F.regexp_extract(log, r"^[^ ]* ([\s\S]*)$", 1)
    whole = is_literal(log)
    two = log.contains(" ")
    inner = two & is_literal(tail)
    step = F.when(whole, F.lit("")).when(two, head).otherwise(log)
    data = F.when(whole, literal_as_json(log)).when(inner, literal_as_json(tail)).otherwise(F.lit("{}"))
    msg = F.when(whole | inner, F.lit("")).when(two, tail).otherwise("")
    return F.struct(step.alias("step"), data.alias("data"), msg.alias("msg"))


def outer_object(text: Column) -> Column:
    """The outermost ``{…}`` of a text as JSON text, NULL when there is none."""
    found = F.regexp_extract(text, r"(\{[\s\S]*\})", 1)
    return F.when(found != "", literal_as_json(found))


def json_map(text: Column) -> Column:
    """A JSON object as a map of texts; scalars lose their quotes."""
    return F.from_json(text, TEXT_MAP)


def json_each(df, column: str, key: str = "key", value: str = "value"):
    """One row per entry of the JSON object in ``column``."""
    keep = [F.col(c) for c in df.columns]
    return df.select(*keep, F.explode(json_map(F.col(column))).alias(key, value))


def last_wins_map(entries: Column) -> Column:
    """A map from ``array<struct<key,value>>`` where a repeated key keeps its last value."""
    keys = F.transform(entries, lambda e: e["key"])
    kept = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(keys, i + F.lit(2), F.greatest(F.size(keys) - i - 1, F.lit(0))), e["key"]))
    return F.map_from_entries(F.sort_array(kept))
