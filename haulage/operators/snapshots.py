"""Versioned snapshots: what changed, which version follows which, and where two documents differ."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from haulage.functions import times as T
from haulage.operators.ranges import neighbours


def latest_versions(versions: DataFrame, ident: str = "id", extra: list[str] | None = None) -> DataFrame:
    """Newest version per id with its hash and the number of versions."""
    fields = F.struct("version", "hash", *(extra or []))
    return versions.groupBy(ident).agg(F.max_by(fields, "version").alias("_v"), F.count("*").alias("n_versions")).select(ident, "_v.*", "n_versions")


def compared(stored: DataFrame, current: DataFrame, ident: str = "id", hash_col: str = "hash") -> DataFrame:
    """``new`` / ``changed`` / ``unchanged`` / ``deleted`` per id; both sides have unique ids."""
    s = stored.select(F.col(ident), F.col(hash_col).alias("old_hash"), F.lit(True).alias("_s"))
    c = current.select(F.col(ident), F.col(hash_col).alias("new_hash"), F.lit(True).alias("_c"))
    state = F.when(F.col("_s").isNull(), "new").when(F.col("_c").isNull(), "deleted").when(
        F.col("old_hash").eqNullSafe(F.col("new_hash")), "unchanged").otherwise("changed")
    return s.join(c, ident, "full_outer").select(ident, "old_hash", "new_hash", state.alias("state"))


def new_versions(versions: DataFrame, current: DataFrame, captured_at, ident: str = "id") -> DataFrame:
    """Rows to append: only ids whose hash differs from the stored one; version + 1 and the previous hash."""
    last = latest_versions(versions, ident).select(F.col(ident), F.col("version").alias("_v"), F.col("hash").alias("prev_hash"))
    joined = current.join(last, ident, "left")
    return joined.where(F.col("prev_hash").isNull() | (F.col("hash") != F.col("prev_hash"))).withColumn(
        "version", F.coalesce(F.col("_v"), F.lit(0)) + 1).withColumn("captured_at", T.moment(captured_at)).drop("_v")


def carried_over(stored: DataFrame, current: DataFrame, ident: str = "id", hash_col: str = "hash") -> DataFrame:
    """The stored row where the hash is the same, the current row otherwise; ids only stored are gone."""
    cols = current.columns
    old = stored.select(F.col(ident), F.struct(*cols).alias("_old"))
    joined = current.select(F.col(ident), F.struct(*cols).alias("_new")).join(old, ident, "left")
    same = F.col(f"_old.{hash_col}") == F.col(f"_new.{hash_col}")
    return joined.select(F.when(F.coalesce(same, F.lit(False)), F.col("_old")).otherwise(F.col("_new")).alias("_row"),
                         (~F.coalesce(same, F.lit(False))).alias("is_changed")).select("_row.*", "is_changed")


def version_pairs(versions: DataFrame, ident: list[str], order: list[str], carried: dict[str, str], rows_per_range: int | None = None) -> DataFrame:
    """Each version next to the one before it; first versions are left out."""
    paired = neighbours(versions, ident, order, previous=carried, rows_per_range=rows_per_range)
    first = next(iter(carried))
    return paired.where(F.col(first).isNotNull())


def rotation(live: DataFrame, copies: DataFrame, changed: DataFrame, limit: int | None = None, ident: str = "id", at: str = "copied_at") -> DataFrame:
    """Who is copied next: changed ids, then ids without a copy, then the oldest copies; on request the first ones only."""
    joined = (
        live.select(ident).distinct()
        .join(changed.select(ident).distinct().withColumn("_ch", F.lit(0)), ident, "left")
        .join(copies.groupBy(ident).agg(F.max(at).alias(at)), ident, "left")
    )
    ordered = joined.select(ident, F.coalesce("_ch", F.lit(1)).alias("rank"), F.col(at).isNotNull().alias("has_copy"), at).orderBy("rank", "has_copy", at, ident)
    return ordered if limit is None else ordered.limit(limit)


def stability(observations: DataFrame, ident: str = "id", at: str = "parsed_at", hash_col: str = "hash", loc: str = "fileloc",
              tie: list[str] | None = None, rows_per_range: int | None = None) -> DataFrame:
    """Verdict of each observation by the next later one: stable, unstable, duplicate_id or no_parse."""
    seen = neighbours(observations, [ident], [at, *(tie or [])], following={"_at": at, "_hash": hash_col, "_loc": loc}, rows_per_range=rows_per_range)
    moved = F.col(loc).isNotNull() & F.col("_loc").isNotNull() & (F.col(loc) != F.col("_loc"))
    verdict = F.when(F.col("_at").isNull(), "no_parse").when(F.col("_hash") == F.col(hash_col), "stable").when(moved, "duplicate_id").otherwise("unstable")
    return seen.withColumn("verdict", verdict).drop("_at", "_hash", "_loc")


NODES = "array<struct<path:string,parent:string,in_list:boolean,kind:string,value:string,shown:string>>"


def json_nodes(text: Column) -> Column:
    """Every node of a JSON text, at any depth.

    ``value`` is what is compared (the length of a list, nothing for an object), ``shown`` what is printed. Built-in
    expressions cannot recurse, so this one step runs over Arrow batches; it stays inside its row.
    """
    @F.arrow_udf(NODES)
    def nodes(texts: pa.Array) -> pa.Array:
        import json

        dump = json.JSONEncoder(ensure_ascii=False, separators=(",", ":")).encode
        paths, parents, in_lists, kinds, values, shown = [], [], [], [], [], []
        offsets = [0]
        for doc in texts.to_pylist():
            todo = [] if doc is None else [("", None, False, json.loads(doc))]
            while todo:
                path, parent, in_list, node = todo.pop()
                kind = type(node).__name__
                text = dump(node) if kind in ("dict", "list", "bool") else str(node)
                paths.append(path)
                parents.append(parent)
                in_lists.append(in_list)
                kinds.append(kind)
                values.append(None if kind == "dict" else str(len(node)) if kind == "list" else text)
                shown.append(text)
                if kind == "dict":
                    todo += [(f"{path}.{key}", path, False, child) for key, child in node.items()]
                elif kind == "list":
                    todo += [(f"{path}[{i}]", path, True, child) for i, child in enumerate(node)]
            offsets.append(len(paths))
        text = pa.string()
        fields = [pa.array(paths, text), pa.array(parents, text), pa.array(in_lists, pa.bool_()), pa.array(kinds, text), pa.array(values, text), pa.array(shown, text)]
        rows = pa.StructArray.from_arrays(fields, ["path", "parent", "in_list", "kind", "value", "shown"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)

    return nodes(text)


def json_diff(pairs: DataFrame, ident: str, before: str, after: str, limit: int | None = None) -> DataFrame:
    """Differences of two JSON texts per id: ``(id, path, before, after)``, with a limit the first per id in path order.

    A type change shows both types and hides what lies below it, a missing key shows ``—``, lists of other length
    show both lengths under ``path[]`` and only their common positions are compared. Both texts sit in one row, so
    they are compared there: nothing is shuffled, whatever the size of the table.
    """
    def by_path(column: str) -> Column:
        return F.map_from_entries(F.transform(json_nodes(F.col(column)), lambda n: F.struct(n["path"], n)))

    changed = pairs.where(~F.col(before).eqNullSafe(F.col(after))).select(ident, by_path(before).alias("_a"), by_path(after).alias("_b"))
    both = changed.select(ident, F.map_zip_with("_a", "_b", lambda path, a, b: F.struct(a.alias("a"), b.alias("b"))).alias("_m"))

    def differs(path: Column, n: Column) -> Column:
        a, b = n["a"], n["b"]
        one_sided = a.isNull() | b.isNull()
        there = F.coalesce(~one_sided, F.lit(False))
        return F.coalesce((one_sided & ~F.coalesce(a["in_list"], b["in_list"])) | (there & (
            (a["kind"] != b["kind"]) | ((a["kind"] != "dict") & (a["value"] != b["value"])))), F.lit(False))

    def uncovered(e: Column) -> Column:
        # A node below a missing or retyped node belongs to that node's row.
        up = F.try_element_at("_m", F.coalesce(e["value"]["a"]["parent"], e["value"]["b"]["parent"]))
        both_sides = e["value"]["a"].isNotNull() & e["value"]["b"].isNotNull()
        return both_sides | (up.isNotNull() & F.coalesce(up["a"]["kind"] == up["b"]["kind"], F.lit(False)))

    found = both.select(ident, F.filter(F.map_entries(F.map_filter("_m", differs)), uncovered).alias("_d"), "_m")

    def cell(own: Column, other: Column) -> Column:
        retyped = F.coalesce(own["kind"] != other["kind"], F.lit(False))
        return F.when(own.isNull(), "—").when(retyped, F.concat(own["shown"], F.lit(" ("), own["kind"], F.lit(")"))).when(
            other.isNotNull() & (own["kind"] == "list"), own["value"]).otherwise(own["shown"])

    def row(e: Column) -> Column:
        a, b, path = e["value"]["a"], e["value"]["b"], e["key"]
        resized = F.coalesce((a["kind"] == "list") & (b["kind"] == "list"), F.lit(False))
        name = F.when(resized, F.concat(path, F.lit("[]"))).when(path == "", ".").otherwise(path)
        return F.struct(name.alias("path"), cell(a, b).alias("before"), cell(b, a).alias("after"))

    shown = F.transform("_d", row)
    return found.select(ident, F.inline(shown if limit is None else F.slice(F.sort_array(shown), 1, limit)))


def content_version(df: DataFrame) -> Column:
    """Marker used for write-if-changed: order-free checksum and count as one text."""
    from haulage.operators.checks import row_hash

    return F.concat_ws(":", F.sum(row_hash(df).cast("decimal(38,0)")).cast("string"), F.count("*").cast("string"))


def write_if_changed(df: DataFrame, path: str, previous: str | None) -> tuple[str, bool]:
    """Write ``df`` below ``path`` under its marker unless it equals ``previous``; returns the marker and whether it wrote."""
    marker = df.agg(F.coalesce(content_version(df), F.lit("0")).alias("m")).first()[0]
    if marker == previous:
        return marker, False
    df.write.mode("overwrite").parquet(f"{path}/{marker.replace(':', '_')}")
    return marker, True
