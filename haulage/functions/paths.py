"""Object paths of the form ``conn_id://bucket/prefix/mask``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from haulage.functions import text as X

# Extensions that are compressed already and never compressed again (fixed values).
PACKED = [".parquet", ".zip", ".gz"]


def parse_path(path: Column) -> Column:
    """``struct(path, conn_id, bucket, key, prefix, file, name, ext, is_mask)``.

    ``parse_url`` rejects schemes with an underscore, so the parts come from regular expressions.
    """
    conn = F.regexp_extract(path, r"^([^:/]+)://", 1)
    bucket = F.regexp_extract(path, r"^[^:/]+://([^/]*)", 1)
    key = F.regexp_extract(path, r"^[^:/]+://[^/]*/*(.*)$", 1)
    is_mask = key.rlike(r"[*?]")
    fixed = F.regexp_extract(key, r"^([^*?]*)", 1)
    prefix = F.regexp_extract(fixed, r"^(.*/)", 1)
    file = F.substr(key, F.length(prefix) + F.lit(1))
    ext = F.regexp_extract(file, r"[^./](\.[^./]*)$", 1)
    name = F.left(file, F.length(file) - F.length(ext))
    return F.struct(
        path.alias("path"), conn.alias("conn_id"), bucket.alias("bucket"), key.alias("key"), prefix.alias("prefix"),
        file.alias("file"), name.alias("name"), ext.alias("ext"), is_mask.alias("is_mask"),
    )


def target_key(key: Column, ext: Column, source_prefix: Column, target_prefix: Column, at: Column) -> Column:
    """Target name of an arriving file: source prefix swapped once, `` YYYY-MM-DD HH:MM:SS`` before the extension."""
    stem = F.left(key, F.length(key) - F.length(ext))
    at_pos = F.position(source_prefix, stem)
    swapped = F.when(
        (F.length(source_prefix) > 0) & (at_pos > 0),
        F.concat(F.left(stem, at_pos - 1), target_prefix, F.substr(stem, at_pos + F.length(source_prefix))),
    ).otherwise(F.when(F.length(source_prefix) == 0, F.concat(target_prefix, stem)).otherwise(stem))
    return F.concat(swapped, F.lit(" "), F.date_format(at, "yyyy-MM-dd HH:mm:ss"), ext)


def packed(key: Column) -> Column:
    """True for files that must not be compressed again."""
    out = F.lit(False)
    for ext in PACKED:
        out = out | F.lower(key).endswith(ext)
    return out


def base_name(key: Column) -> Column:
    return X.last_segment(key, "/")
