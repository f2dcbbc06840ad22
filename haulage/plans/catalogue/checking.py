"""Snapshots, comparisons and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from haulage.functions import jsons as J, text as X
from haulage.operators import checks as CK, snapshots as SN
from haulage.plans.catalogue.base import dealt, key_of_props, query, table
from haulage.session import run_folder

# "Altered" orders: some changed, some missing, some new.
ALTERED_SQL = """
    SELECT o_orderkey + CASE WHEN o_orderkey % 17 = 0 THEN 10000000 ELSE 0 END AS o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus
    FROM orders WHERE o_orderkey % 19 <> 0"""


def altered(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").where(key % 19 != 0).select(
        (key + F.when(key % 17 == 0, 10_000_000).otherwise(0)).alias("o_orderkey"), "o_custkey",
        F.when(key % 10 == 0, "Z").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))


def original(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


def hashed(df: DataFrame) -> DataFrame:
    return df.select(F.col("o_orderkey").alias("id"), F.md5(F.concat_ws("|", F.col("o_custkey").cast("string"), "o_orderstatus")).alias("hash"))


HASHED = "SELECT o_orderkey AS id, md5(o_custkey || '|' || o_orderstatus) AS hash FROM ({})"


@query("hash_compare", f"""
    SELECT id, s.hash AS old_hash, c.hash AS new_hash, CASE WHEN s.hash IS NULL THEN 'new' WHEN c.hash IS NULL THEN 'deleted' WHEN s.hash = c.hash THEN 'unchanged' ELSE 'changed' END AS state
    FROM ({HASHED.format('SELECT * FROM orders')}) s FULL JOIN ({HASHED.format(ALTERED_SQL)}) c USING (id)""")
def hash_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SN.compared(hashed(original(spark, sf_dir)), hashed(altered(spark, sf_dir)))


@query("carried_over", f"""
    SELECT c.id, c.hash, s.hash IS NULL OR s.hash <> c.hash AS is_changed FROM ({HASHED.format(ALTERED_SQL)}) c LEFT JOIN ({HASHED.format('SELECT * FROM orders')}) s USING (id)""")
def carried_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SN.carried_over(hashed(original(spark, sf_dir)), hashed(altered(spark, sf_dir)))


@query("except_compare", f"""
    SELECT *, count(*) AS n_extra FROM (SELECT *, 'left' AS side FROM (SELECT o_custkey, o_orderstatus FROM orders EXCEPT ALL SELECT o_custkey, o_orderstatus FROM ({ALTERED_SQL}))
    UNION ALL SELECT *, 'right' FROM (SELECT o_custkey, o_orderstatus FROM ({ALTERED_SQL}) EXCEPT ALL SELECT o_custkey, o_orderstatus FROM orders)) GROUP BY ALL""")
def except_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CK.difference(original(spark, sf_dir).drop("o_orderkey"), altered(spark, sf_dir).drop("o_orderkey"))


@query("except_distinct", f"""
    SELECT *, CAST(1 AS BIGINT) AS n_extra FROM (SELECT *, 'left' AS side FROM (SELECT o_custkey, o_orderstatus FROM orders EXCEPT SELECT o_custkey, o_orderstatus FROM ({ALTERED_SQL}))
    UNION ALL SELECT *, 'right' FROM (SELECT o_custkey, o_orderstatus FROM ({ALTERED_SQL}) EXCEPT SELECT o_custkey, o_orderstatus FROM orders))""")
def except_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CK.difference(original(spark, sf_dir).drop("o_orderkey"), altered(spark, sf_dir).drop("o_orderkey"), distinct=True)


# A copy in which few orders differ.
NEARLY_SQL = """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 499 = 0 THEN 'Z' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 997 <> 0"""


@query("range_compare", f"""
    SELECT *, CAST(1 AS BIGINT) AS n_extra FROM (SELECT *, 'left' AS side FROM (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders EXCEPT ALL SELECT * FROM ({NEARLY_SQL}))
    UNION ALL SELECT *, 'right' FROM (SELECT * FROM ({NEARLY_SQL}) EXCEPT ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM orders))""")
def range_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    copy = original(spark, sf_dir).where(key % 997 != 0).withColumn("o_orderstatus", F.when(key % 499 == 0, "Z").otherwise(F.col("o_orderstatus")))
    return CK.difference_by_ranges(original(spark, sf_dir), copy, ["o_orderkey"])


@query("table_checksum", f"""
    SELECT 'copy' AS compared, (SELECT count(*) FROM orders) AS n_rows, true AS is_same
    UNION ALL SELECT 'altered', (SELECT count(*) FROM ({ALTERED_SQL})), (SELECT count(*) FROM (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders EXCEPT ALL SELECT * FROM ({ALTERED_SQL}))) = 0""")
def table_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = original(spark, sf_dir)
    base = CK.table_checksum(rows).select(F.struct("checksum", "n_rows")).scalar()
    same = CK.table_checksum(rows.repartition(5, "o_custkey")).select(F.lit("copy").alias("compared"), "n_rows", F.struct("checksum", "n_rows").alias("c"))
    other = CK.table_checksum(altered(spark, sf_dir)).select(F.lit("altered").alias("compared"), "n_rows", F.struct("checksum", "n_rows").alias("c"))
    return same.unionByName(other).select("compared", "n_rows", (F.col("c") == base).alias("is_same"))


@query("copy_checks", f"""
    SELECT (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM ({ALTERED_SQL})) AS target_rows,
           (SELECT count(*) FROM orders) = (SELECT count(*) FROM ({ALTERED_SQL})) AS is_equal""")
def copy_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CK.count_check(original(spark, sf_dir), altered(spark, sf_dir))


@query("sum_check", """
    SELECT count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS total, count(*) = (SELECT count(*) FROM orders) AND sum(l_orderkey) = (SELECT sum(o_orderkey) FROM orders) AS is_ok
    FROM (SELECT DISTINCT l_orderkey FROM lineitem)""")
def sum_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of the line items against number and sum of the orders."""
    wanted = table(spark, sf_dir, "orders").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("total")).first()
    return CK.sum_check(table(spark, sf_dir, "lineitem").select("l_orderkey").distinct(), "l_orderkey", wanted.n, wanted.total)


# Versions of a user's document: one per event, the hash changes with the key of props.
VERSIONS_SQL = """
    SELECT user_id AS id, event_id AS version, md5(CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS VARCHAR)) AS hash, ts AS parsed_at, 'f' || (event_id % 40) // 39 AS fileloc FROM events"""


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.col("event_id").alias("version"), F.md5((key_of_props() % 3).cast("string")).alias("hash"), F.col("ts").alias("parsed_at"),
        F.concat(F.lit("f"), F.floor((F.col("event_id") % 40) / 39).cast("string")).alias("fileloc"))


@query("version_pairs", f"""
    SELECT * FROM (SELECT id, version, hash, lag(version) OVER w AS prev_version, lag(hash) OVER w AS prev_hash FROM ({VERSIONS_SQL}) WINDOW w AS (PARTITION BY id ORDER BY version)) WHERE prev_version IS NOT NULL""")
def version_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SN.version_pairs(versions(spark, sf_dir).select("id", "version", "hash"), ["id"], ["version"], {"prev_version": "version", "prev_hash": "hash"})


@query("latest_version", f"""
    SELECT id, version, hash, n_versions FROM (SELECT *, count(*) OVER (PARTITION BY id) AS n_versions, row_number() OVER (PARTITION BY id ORDER BY version DESC) AS rn FROM ({VERSIONS_SQL})) WHERE rn = 1""")
def latest_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SN.latest_versions(versions(spark, sf_dir).select("id", "version", "hash"))


@query("new_versions", f"""
    WITH v AS (SELECT * FROM ({VERSIONS_SQL}) WHERE version % 2 = 0), l AS (SELECT id, max(version) AS version, arg_max(hash, version) AS hash FROM v GROUP BY id),
    c AS (SELECT c_custkey AS id, md5(CAST(c_custkey % 3 AS VARCHAR)) AS hash FROM customer)
    SELECT c.id, c.hash, l.hash AS prev_hash, coalesce(l.version, 0) + 1 AS version FROM c LEFT JOIN l USING (id) WHERE l.hash IS NULL OR l.hash <> c.hash""")
def new_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = versions(spark, sf_dir).where("version % 2 = 0").select("id", "version", "hash")
    current = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.md5((F.col("c_custkey") % 3).cast("string")).alias("hash"))
    return SN.new_versions(stored, current, "2024-02-01 00:00:00").select("id", "hash", "prev_hash", "version")


@query("rotation_order", """
    SELECT c_custkey AS id, CASE WHEN c_custkey IN (SELECT user_id FROM events WHERE event_id % 500 = 0) THEN 0 ELSE 1 END AS rank, copied_at IS NOT NULL AS has_copy, copied_at
    FROM customer LEFT JOIN (SELECT user_id, max(ts) AS copied_at FROM events GROUP BY user_id) ON c_custkey = user_id
    """)
def rotation_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    live = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    copies = ev.select(F.col("user_id").alias("id"), F.col("ts").alias("copied_at"))
    changed = ev.where("event_id % 500 = 0").select(F.col("user_id").alias("id"))
    return SN.rotation(live, copies, changed)


@query("stability_verdict", f"""
    WITH n AS (SELECT *, lead(parsed_at) OVER w AS a, lead(hash) OVER w AS h, lead(fileloc) OVER w AS l FROM ({VERSIONS_SQL}) WINDOW w AS (PARTITION BY id ORDER BY parsed_at, version))
    SELECT id, version, CASE WHEN a IS NULL THEN 'no_parse' WHEN h = hash THEN 'stable' WHEN l <> fileloc THEN 'duplicate_id' ELSE 'unstable' END AS verdict FROM n""")
def stability_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SN.stability(versions(spark, sf_dir), tie=["version"]).select("id", "version", "verdict")


@query("json_diff", """
    WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, event_type FROM events)
    SELECT event_id, '.k' AS path, CAST(k AS VARCHAR) AS before, CAST(k + 1 AS VARCHAR) AS after FROM e
    UNION ALL SELECT event_id, '.list[]', '2', '3' FROM e WHERE k % 2 = 0
    UNION ALL SELECT event_id, '.list[1]', CAST(k AS VARCHAR), CAST(k + 5 AS VARCHAR) FROM e
    UNION ALL SELECT event_id, '.sub.type', event_type, '—' FROM e WHERE k % 3 = 0
    UNION ALL SELECT event_id, '.sub.kind', '1 (int)', '1 (str)' FROM e WHERE k % 5 = 0
    UNION ALL SELECT event_id, '.more', '—', '{"a":[1]}' FROM e WHERE k % 7 = 0""")
def json_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    ev = dealt(spark, sf_dir, "events", "event_id", "props", "event_type").select("event_id", key_of_props().alias("k"), "event_type")
    before = F.format_string('{"k":%d,"list":[1,%d],"sub":{"type":"%s","kind":1}}', k, k, F.col("event_type"))
    kept = F.when(k % 3 == 0, "").otherwise(F.concat(F.lit('"type":"'), "event_type", F.lit('",')))
    after = F.concat(
        F.format_string('{"k":%d,"list":[1,%d', k + 1, k + 5), F.when(k % 2 == 0, ",9").otherwise(""), F.lit('],"sub":{'), kept, F.lit('"kind":'),
        F.when(k % 5 == 0, '"1"').otherwise("1"), F.lit("}"), F.when(k % 7 == 0, ',"more":{"a":[1]}').otherwise(""), F.lit("}"))
    return SN.json_diff(ev.select("event_id", before.alias("b"), after.alias("a")), "event_id", "b", "a")


@query("json_diff_props", """
    WITH p AS (SELECT event_id, props, lag(props) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM events)
    SELECT event_id, '.k' AS path, json_extract_string(prev, '$.k') AS before, json_extract_string(props, '$.k') AS after FROM p
    WHERE json_extract_string(prev, '$.k') <> json_extract_string(props, '$.k')""")
def json_diff_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "props")
    pairs = SN.version_pairs(ev, ["user_id"], ["event_id"], {"prev": "props"})
    return SN.json_diff(pairs, "event_id", "prev", "props")


@query("canonical_hash", """
    SELECT event_id, md5('{"event_type":"' || event_type || '","nested":{"a":[{"x":1,"y":' || event_id || '}],"b":"' || event_type || '"},"user_id":' || user_id || '}') AS h FROM events""")
def canonical_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    inner = F.array(F.struct(F.col("event_id").alias("y"), F.lit(1).alias("x")))
    rows = table(spark, sf_dir, "events").withColumn("nested", F.struct(F.col("event_type").alias("b"), inner.alias("a")))
    return rows.select("event_id", J.canonical_hash(rows.schema, "user_id", "nested", "event_type").alias("h"))


@query("write_if_changed", f"""
    SELECT 'first' AS step, true AS written, (SELECT count(*) FROM orders) AS n_rows
    UNION ALL SELECT 'same', false, (SELECT count(*) FROM orders) UNION ALL SELECT 'altered', true, (SELECT count(*) FROM ({ALTERED_SQL}))""")
def write_if_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three writes: a first one, an equal one that is skipped, a changed one."""
    folder = run_folder(spark, "if-changed")
    first, wrote = SN.write_if_changed(original(spark, sf_dir), folder, None)
    same, again = SN.write_if_changed(original(spark, sf_dir).repartition(3), folder, first)
    other, third = SN.write_if_changed(altered(spark, sf_dir), folder, same)
    marks = spark.createDataFrame([("first", first, wrote), ("same", same, again), ("altered", other, third)], "step string, marker string, written boolean")
    counts = None
    for marker in (first, other):
        rows = spark.read.parquet(f"{folder}/{marker.replace(':', '_')}").agg(F.lit(marker).alias("marker"), F.count("*").alias("n_rows"))
        counts = rows if counts is None else counts.unionByName(rows)
    return marks.join(counts, "marker").select("step", "written", "n_rows")


@query("line_shape", """
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT doc_id, count(*) AS n_bad, CAST(sum(length(line) - length(replace(line, ',', '')) + 1) AS BIGINT) AS n_fields FROM l WHERE length(line) - length(replace(line, ',', '')) <> 2 GROUP BY doc_id""")
def line_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return CK.bad_lines(lines, "line", 3, ",").groupBy("doc_id").agg(F.count("*").alias("n_bad"), F.sum("n_columns").alias("n_fields"))


@query("bad_names", "SELECT url FROM (SELECT lower(url) AS url FROM pages) WHERE NOT (regexp_matches(url, '^[a-z0-9_-]+(\\.[a-z0-9]+)*$') AND strlen(url) <= 240)")
def bad_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CK.bad_names(table(spark, sf_dir, "pages").select(F.lower("url").alias("url")), "url")


@query("prefix_present", """
    SELECT p AS prefix, (SELECT count(*) FROM pages WHERE starts_with(url, p)) > 0 AS present FROM (SELECT regexp_extract(url, '^https?://[^/]*/', 0) AS p FROM pages WHERE page_id = 0 UNION ALL SELECT 'ftp://')""")
def prefix_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("path"))
    first = pages.where("page_id = 0").select(F.regexp_extract("path", "^https?://[^/]*/", 0)).first()[0]
    return spark.createDataFrame([(p, CK.has_prefix(pages, p)) for p in (first, "ftp://")], "prefix string, present boolean")


@query("prefix_check", "SELECT lang, count(*) AS n FROM documents WHERE starts_with(source, 'w') OR NOT starts_with(lang, 'e') GROUP BY lang")
def prefix_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    keep = F.col("source").startswith("w") | X.without_prefixes(F.col("lang"), ["e"])
    return table(spark, sf_dir, "documents").where(keep).groupBy("lang").agg(F.count("*").alias("n"))
