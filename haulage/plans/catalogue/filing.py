"""Files and messages: listings, gated arrival, packages, copies and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as PT

from haulage.functions import paths as P, text as X, times as T
from haulage.plans.catalogue.base import KEY_SQL, dealt, key_of_props, query, table
from haulage.plans.catalogue.exporting import PART_ORDER, PARTS_SQL, lineitem_parts
from haulage.operators import parts as PA
from haulage.session import run_folder, stored
from haulage.sinks import archive as AR, delimited as DL, ledger as LG, notify as NO
from haulage.sources import files as FI, messages as MS, tables as TB


def text(name: str):
    return F.col(name).cast("string")


@query("listing_mask", r"""
    SELECT url AS path FROM pages WHERE regexp_matches(url, '^https://.*\.example\...g/.*$', 's') AND NOT ends_with(url, '/') AND NOT ends_with(url, '.error')""")
def listing_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FI.matching(table(spark, sf_dir, "pages").select(F.col("url").alias("path")), "https://*.example.??g/*")


@query("done_gate", "SELECT url || '#' || page_id AS path FROM pages WHERE page_id % 3 = 0")
def done_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat_ws("#", "url", text("page_id")).alias("path"))
    markers = pages.where("page_id % 3 = 0").select(F.concat("path", F.lit(".done")).alias("path"))
    stray = pages.where("page_id % 7 = 1").select(F.concat(F.lit("gone"), "path", F.lit(".done")).alias("path"))
    return FI.done_gated(pages.select("path").unionByName(markers).unionByName(stray))


@query("folder_gate", """
    WITH l AS (SELECT doc_id, source || lang AS folder FROM documents) SELECT folder || '/' || doc_id || '.csv' AS path FROM l WHERE folder IN (SELECT folder FROM l WHERE doc_id % 50 = 1)""")
def folder_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("source", "lang").alias("folder"))
    files = docs.select(F.concat("folder", F.lit("/"), text("doc_id"), F.lit(".csv")).alias("path"))
    markers = docs.where("doc_id % 50 = 1").select(F.concat("folder", F.lit("/.done")).alias("path"))
    return FI.folder_gated(files.unionByName(markers))


LISTING_SQL = "SELECT source || '/' || lang || '/' || doc_id || '.' || lang AS path, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id % 977 AS INTEGER)) AS modificationTime, n_chars AS length FROM documents"


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.concat(F.concat_ws("/", "source", "lang", text("doc_id")), F.lit("."), "lang").alias("path"),
        (T.moment("2024-01-01 00:00:00") + T.seconds(F.col("doc_id") % 977 * 60)).alias("modificationTime"), F.col("n_chars").alias("length"))


@query("listing_top", f"SELECT * FROM ({LISTING_SQL}) ORDER BY length DESC, path LIMIT 10")
def listing_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FI.sorted_listing(listing(spark, sf_dir), "Size", reverse=True, items=10)


@query("listing_by_ext", f"SELECT path FROM ({LISTING_SQL})")
def listing_by_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FI.sorted_listing(listing(spark, sf_dir), "Ext").select("path")


@query("oldest_files", f"SELECT path, modificationTime FROM ({LISTING_SQL}) ORDER BY modificationTime, path")
def oldest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FI.oldest_first(listing(spark, sf_dir)).select("path", "modificationTime")


@query("path_parse", """
    SELECT doc_id, 's3_' || lang AS conn_id, 'b' || source AS bucket, 'in/' || doc_id || '/' AS prefix, CASE WHEN doc_id % 2 = 0 THEN '*_' || lang || '.csv' ELSE 'f' || doc_id || '.tar.gz' END AS file,
           CASE WHEN doc_id % 2 = 0 THEN '.csv' ELSE '.gz' END AS ext, doc_id % 2 = 0 AS is_mask FROM documents""")
def path_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.col("doc_id") % 2 == 0
    file = F.when(even, F.concat(F.lit("*_"), "lang", F.lit(".csv"))).otherwise(F.concat(F.lit("f"), text("doc_id"), F.lit(".tar.gz")))
    path = F.concat(F.lit("s3_"), "lang", F.lit("://b"), "source", F.lit("/in/"), text("doc_id"), F.lit("/"), file)
    return table(spark, sf_dir, "documents").select("doc_id", P.parse_path(path).alias("p")).select("doc_id", "p.conn_id", "p.bucket", "p.prefix", "p.file", "p.ext", "p.is_mask")


@query("target_key", "SELECT event_id, 'tfs1/' || event_type || '/' || user_id || ' ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '.csv' AS new_key FROM events")
def target_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat(F.lit("from/a/"), "event_type", F.lit("/"), text("user_id"), F.lit(".csv"))
    return table(spark, sf_dir, "events").select("event_id", P.target_key(key, F.lit(".csv"), F.lit("from/a/"), F.lit("tfs1/"), F.col("ts")).alias("new_key"))


@query("table_names", """SELECT doc_id, string_split(text, '/')[-1] AS tail, regexp_extract(string_split(text, '/')[-1], '^[^ ''":;.]*') AS table_name FROM documents""")
def table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", X.last_segment(text, "/").alias("tail"), X.table_from_file(text).alias("table_name"))


@query("load_ledger", """
    SELECT 'in/' || o_orderstatus || '/' || o_orderkey || '.csv' AS path, CAST(o_orderkey AS VARCHAR) AS table_name, CASE WHEN o_orderkey % 10 = 0 THEN 'failed' ELSE 'loaded' END AS status,
           CASE WHEN o_orderkey % 10 = 0 THEN 0 ELSE o_custkey END AS n_rows,
           CASE WHEN o_orderkey % 10 = 0 THEN 'tfs-errors/' ELSE 'tfs-archive/' END || 'in/' || o_orderstatus || '/' || o_orderkey || ' 2024-02-03 04:05:06.csv' AS new_path FROM orders""")
def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("in/"), "o_orderstatus", F.lit("/"), text("o_orderkey"), F.lit(".csv")).alias("path"), F.col("o_custkey").alias("n_rows"), (F.col("o_orderkey") % 10 == 0).alias("failed"))
    return LG.ledger_rows(files, "2024-02-03 04:05:06").drop("loaded_at")


@query("message_tail", f"SELECT user_id AS partition, event_id AS offset_no, props AS value FROM events JOIN (SELECT user_id, max(event_id) AS high FROM events GROUP BY 1) USING (user_id) WHERE event_id > high - 500")
def message_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "events").select(F.col("user_id").alias("partition"), F.col("event_id").alias("offset"), F.col("props").alias("value"))
    return MS.tail(messages, 500).select("partition", F.col("offset").alias("offset_no"), "value")


REQUEST_SQL = """
    SELECT o_orderkey, 'rq' || o_orderkey AS rq_uid, CASE WHEN o_orderkey % 5 = 0 THEN 'manual' ELSE 'SC-' || o_orderpriority END AS scenario_id, CAST(i AS INTEGER) AS file_no, 'f' || o_orderkey || '_' || i || '.csv' AS name,
           CASE WHEN i % 2 = 1 THEN 'in/sub' ELSE '' END AS folder, 'root/' || CASE WHEN i % 2 = 1 THEN 'in/sub/' ELSE '' END || 'f' || o_orderkey || '_' || i || '.csv' AS key
    FROM orders, generate_series(0, 29) g(i) WHERE i < CASE WHEN o_orderkey % 100 = 0 THEN 30 ELSE o_orderkey % 4 END"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request messages with 0 to 3 files, every hundredth with 30; half of them with a namespace."""
    wanted = F.when(F.col("o_orderkey") % 100 == 0, 30).otherwise(F.col("o_orderkey") % 4).cast("int")
    numbers = F.slice(F.sequence(F.lit(0), F.lit(29)), F.lit(1), wanted)

    def entry(i):
        folder = F.when(i % 2 == 1, "<FolderSource>/in/sub/</FolderSource>").otherwise("")
        return F.concat(F.lit("<FileInfo><Name> f"), text("o_orderkey"), F.lit("_"), i.cast("string"), F.lit(".csv</Name>"), folder, F.lit("</FileInfo>"))

    scenario = F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.concat(F.lit("<ScenarioId>SC-"), "o_orderpriority", F.lit("</ScenarioId>")))
    body = F.concat(F.lit("<RqUID>rq"), text("o_orderkey"), F.lit("</RqUID><ScenarioInfo>"), scenario, F.lit("</ScenarioInfo><File>"), F.array_join(F.transform(numbers, entry), ""), F.lit("</File>"))
    spaced = F.col("o_orderkey") % 2 == 0
    inner = F.when(spaced, F.regexp_replace(body, r"<(/?)(\w)", "<$1n:$2")).otherwise(body)
    xml = F.concat(F.when(spaced, '<n:TransferFileCephRq xmlns:n="urn:t">').otherwise("<TransferFileCephRq>"), inner, F.when(spaced, "</n:TransferFileCephRq>").otherwise("</TransferFileCephRq>"))
    return dealt(spark, sf_dir, "orders", "o_orderkey", "o_orderpriority").select("o_orderkey", xml.alias("xml"))


@query("request_parse", REQUEST_SQL)
def request_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MS.parse_requests(requests(spark, sf_dir), "xml", ["o_orderkey"], "root/")


COPY_SQL = f"SELECT rq_uid, name, (o_orderkey + file_no) % 7 = 0 AS failed FROM ({REQUEST_SQL}) WHERE (o_orderkey + file_no) % 11 <> 0"
RECEIPT_SQL = f"""
    SELECT r.rq_uid, CASE WHEN bool_or(coalesce(failed, false)) THEN 104 ELSE 0 END AS code, CASE WHEN bool_or(coalesce(failed, false)) THEN 'Transfer failed' ELSE 'Successful' END AS text
    FROM ({REQUEST_SQL}) r LEFT JOIN ({COPY_SQL}) c USING (rq_uid, name) GROUP BY r.rq_uid"""


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = MS.parse_requests(requests(spark, sf_dir), "xml", ["o_orderkey"])
    mark = F.col("o_orderkey") + F.col("file_no")
    return MS.receipt_status(files, files.where(mark % 11 != 0).select("rq_uid", "name", (mark % 7 == 0).alias("failed")))


@query("receipt_status", RECEIPT_SQL)
def receipt_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statuses(spark, sf_dir)


@query("receipt_xml", f"""
    SELECT rq_uid, '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>' || chr(10) || '<TransferFileCephRs>' || chr(10) || '    <RqUID>' || rq_uid || '</RqUID>' || chr(10) || '    <RqTm>2024-01-01T10:20:30.123+00:00</RqTm>' || chr(10)
           || '    <StatusCode>' || code || '</StatusCode>' || chr(10) || '    <StatusDesc>' || text || '</StatusDesc>' || chr(10) || '</TransferFileCephRs>' AS message FROM ({RECEIPT_SQL})""")
def receipt_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NO.receipts(statuses(spark, sf_dir), "2024-01-01 10:20:30.123").select("rq_uid", "message")


@query("receipt_parse", f"SELECT rq_uid, code, text FROM ({RECEIPT_SQL})")
def receipt_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MS.parse_receipts(NO.receipts(statuses(spark, sf_dir), "2024-01-01 10:20:30.123"), "message", []).select("rq_uid", "code", "text")


@query("file_head", "SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, string_split(text, chr(10))[i] AS line FROM documents, generate_series(1, 3) g(i) WHERE i <= len(string_split(text, chr(10)))")
def file_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FI.line_heads(table(spark, sf_dir, "documents"), "doc_id", F.col("text"), 3)


@query("package_lines", """
    WITH l AS (SELECT event_id, user_id, 'path' || event_id // 100 AS path, event_id % 100 AS line_no, CASE WHEN event_id % 100 = 0 OR user_id % 20 = 0 THEN 'head' ELSE 'r' || event_id END AS value FROM events),
    c AS (SELECT *, sum(CASE WHEN value = 'head' THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY line_no) AS part FROM l)
    SELECT path, CAST(part AS BIGINT) AS part, count(*) AS n_lines, min(value) AS first_value FROM c WHERE value <> 'head' GROUP BY ALL""")
def package_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    no = F.col("event_id") % 100
    lines = table(spark, sf_dir, "events").select(
        F.concat(F.lit("path"), F.floor(F.col("event_id") / 100).cast("string")).alias("path"), no.alias("line_no"),
        F.when((no == 0) | (F.col("user_id") % 20 == 0), "head").otherwise(F.concat(F.lit("r"), text("event_id"))).alias("value"))
    return FI.package_parts(lines).groupBy("path", "part").agg(F.count("*").alias("n_lines"), F.min("value").alias("first_value"))


@query("file_lines", """
    WITH l AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS line_no, CASE WHEN user_id % 50 = 0 OR event_id = (SELECT min(event_id) FROM events) THEN 'head' ELSE 'r' || event_id END AS value FROM events),
    c AS (SELECT *, sum(CASE WHEN value = 'head' THEN 1 ELSE 0 END) OVER (ORDER BY line_no) AS part FROM l)
    SELECT CAST(part AS BIGINT) AS part, count(*) AS n_lines, min(line_no) AS first_no, max(line_no) AS last_no FROM c WHERE value <> 'head' GROUP BY part""")
def file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of one text file with a line per event, read in splits."""
    folder, ev = run_folder(spark, "lines"), table(spark, sf_dir, "events").select("event_id", "user_id")
    least = ev.agg(F.min("event_id")).first()[0]
    value = F.when((F.col("user_id") % 50 == 0) | (F.col("event_id") == least), "head").otherwise(F.concat(F.lit("r"), text("event_id")))
    # one sorted file is what is to be read here; it is sorted in ranges, whose files are joined in the order of their tasks
    ev.orderBy("event_id").select(value.alias("value")).write.text(f"{folder}/ranges")
    task = F.regexp_extract("path", r"/part-(\d+)[^/]*$", 1).cast("bigint")
    AR.join_objects(FI.listing(spark, f"{folder}/ranges"), [task, F.col("path")], f"{folder}/in", "lines.txt").write.parquet(f"{folder}/log")
    parts = FI.package_parts(stored(FI.text_lines(spark, f"{folder}/in"), "lines"))
    return parts.groupBy("part").agg(F.count("*").alias("n_lines"), F.min("line_no").alias("first_no"), F.max("line_no").alias("last_no"))


def schema_of(df: DataFrame) -> PT.StructType:
    return PT.StructType([PT.StructField(f.name, f.dataType) for f in df.schema])


@query("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write as compressed text, load it back into a table."""
    folder, orders = run_folder(spark, "csv"), table(spark, sf_dir, "orders")
    DL.write_csv(orders, f"{folder}/files", DL.Dialect(delimiter=",", quoting=DL.MINIMAL, doublequote=True, escapechar=None), "gzip")
    FI.load_csv(spark, f"{folder}/files", schema_of(orders), f"{folder}/table", "CSV DELIMITER ','", truncate=True)
    return spark.read.schema(schema_of(orders)).parquet(f"{folder}/table")


@query("quoted_roundtrip", "SELECT doc_id, lang, md5(replace(text, chr(13), '')) AS text_md5 FROM documents")
def quoted_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes and line breaks through a fully quoted dialect."""
    folder = run_folder(spark, "quoted")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    DL.write_csv(docs, folder, DL.Dialect(delimiter=",", quoting=DL.ALL, doublequote=True, escapechar=None))
    back = spark.read.schema(schema_of(docs)).option("multiLine", "true").option("escape", '"').option("lineSep", "\n").option(
        "ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(folder)
    return back.select("doc_id", "lang", F.md5(F.regexp_replace("text", "\r", "")).alias("text_md5"))


@query("multi_file_load", """
    SELECT 'good' AS folder, 'loaded' AS status, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_table FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'bad', 'failed', 0, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O')""")
def multi_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intact files are loaded, files with a broken line go to the error prefix as a whole."""
    folder = run_folder(spark, "multi")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    dialect = DL.Dialect(delimiter=",", quoting=DL.MINIMAL, doublequote=True, escapechar=None)
    DL.write_csv(orders.where("o_orderstatus = 'O'"), f"{folder}/in/good", dialect)
    broken = orders.where("o_orderstatus = 'F'").select(F.concat(F.lit("x"), text("o_orderkey")).alias("o_orderkey"), "o_custkey", "o_orderstatus")
    DL.write_csv(broken, f"{folder}/in/bad", dialect)
    ledger = FI.load_files(spark, [f"{folder}/in/good", f"{folder}/in/bad"], schema_of(orders), f"{folder}/table", "2024-01-01 00:00:00", "CSV DELIMITER ','", truncate=True)
    loaded = spark.read.schema(schema_of(orders)).parquet(f"{folder}/table").agg(F.count("*")).scalar()
    return ledger.groupBy(F.regexp_extract("path", r"/in/(\w+)/", 1).alias("folder"), "status").agg(F.sum("n_rows").alias("n_rows")).withColumn("n_table", loaded)


def packed_lines(spark: SparkSession, sf_dir: str, kind: str = "zip") -> str:
    folder = run_folder(spark, "package")
    parts = stored(lineitem_parts(spark, sf_dir), "package-rows")
    named = PA.named_manifest(parts, "Sales", "LineItem", "repl", "20240101000000", head=PA.head_bytes(PART_ORDER))
    AR.write_archives(parts, named, PART_ORDER, PART_ORDER, folder, '{"columns": []}', "20240101000000", kind=kind).write.parquet(f"{folder}-log")
    return folder


TEXTS = ["doc_id", "lang", "source", "text"]
TEXT_PART_BYTES = 2_000_000
# Fields with everything a dialect has to carry, and one without a value.
ODD_TEXTS_SQL = r"""SELECT doc_id, nullif(lang, 'de') AS lang, source, CASE WHEN doc_id % 9 = 0 THEN 'a' || chr(9) || 'b"c' || chr(10) || '\d' || chr(13) || text ELSE text END AS text FROM documents"""


def odd_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    special = F.when(F.col("doc_id") % 9 == 0, F.concat(F.lit('a\tb"c\n\\d\r'), "text")).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.nullif("lang", F.lit("de")).alias("lang"), "source", special.alias("text"))


def packed_texts(spark: SparkSession, sf_dir: str, kind: str = "zip") -> tuple[str, DataFrame]:
    """The folder of packages of whole texts and the log of what was written."""
    folder, head = run_folder(spark, "package"), PA.head_bytes(TEXTS)
    parts = stored(PA.with_parts(odd_texts(spark, sf_dir), ["doc_id"], TEXT_PART_BYTES, head=head), "package-rows")
    named = PA.named_manifest(parts.select("part_no", "row_size"), "Corpus", "Texts", "repl", "20240101000000", head=head)
    AR.write_archives(parts, named, TEXTS, ["doc_id"], folder, '{"columns": []}', "20240101000000", kind=kind).write.parquet(f"{folder}-log")
    return folder, spark.read.parquet(f"{folder}-log").join(named.select("part_no", F.col("n_bytes").alias("planned")), "part_no")


@query("package_archives", ODD_TEXTS_SQL)
def package_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts packed into archives and ingested again, in one dialect both ways."""
    folder, _ = packed_texts(spark, sf_dir)
    records = FI.zip_records(FI.listing(spark, folder), DL.PLAIN_TSV).where(F.col("member").endswith(".csv"))
    return FI.typed_records(records, schema_of(table(spark, sf_dir, "documents").select(*TEXTS)))


@query("package_sizes", "SELECT true AS within, true AS as_planned, count(*) AS n_rows FROM documents")
def package_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written bytes of every tar.gz part against its bound and its manifest; a text wider than that is alone in its part."""
    _, log = packed_texts(spark, sf_dir, "tar.gz")
    within = (F.col("n_bytes") <= TEXT_PART_BYTES) | (F.col("n_rows") == 1)
    return log.agg(F.bool_and(within).alias("within"), F.bool_and(F.col("n_bytes") == F.col("planned")).alias("as_planned"), F.sum("n_rows").alias("n_rows"))


@query("tsv_roundtrip", ODD_TEXTS_SQL)
def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Escaped TSV files with header lines, gzip on the way, read back record by record."""
    folder = run_folder(spark, "tsv")
    DL.write_tsv(odd_texts(spark, sf_dir), f"{folder}/in", "gzip")
    AR.convert_objects(FI.listing(spark, f"{folder}/in").where(F.col("path").endswith(".gz")), f"{folder}/zip", f"{folder}/in", "zip").write.parquet(f"{folder}/log")
    return FI.typed_records(FI.zip_records(FI.listing(spark, f"{folder}/zip"), DL.PLAIN_TSV), schema_of(table(spark, sf_dir, "documents").select(*TEXTS)))


@query("zip_contents", PARTS_SQL + """, n AS (SELECT *, part_index || '_' || part_total || '_' || n_rows AS t FROM m)
    SELECT 'repl__20240101000000__lineitem__' || t || '.zip' AS archive, unnest(['repl__20240101000000.tkt', 'sales__lineitem__20240101000000__' || t || '.meta', 'sales__lineitem__20240101000000__' || t || '.csv']) AS member FROM n""")
def zip_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    toc = FI.zip_contents(FI.listing(spark, packed_lines(spark, sf_dir)))
    return toc.select(P.base_name(F.col("path")).alias("archive"), "member")


@query("object_copy", "SELECT o_orderstatus AS folder, count(*) AS n_lines FROM orders GROUP BY 1")
def object_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy text files of several folders, all with the same base name, with compression, and count their lines."""
    folder = run_folder(spark, "copy")
    orders = table(spark, sf_dir, "orders")
    orders.select("o_orderstatus", text("o_orderkey").alias("value")).repartition(1, "o_orderstatus").write.partitionBy("o_orderstatus").text(f"{folder}/in")
    files = FI.listing(spark, f"{folder}/in").where(F.col("path").endswith(".txt"))
    AR.copy_objects(files, f"{folder}/out", f"{folder}/in", compress=True).write.parquet(f"{folder}/log")
    return spark.read.text(f"{folder}/out").groupBy(F.col("o_orderstatus").alias("folder")).agg(F.count("*").alias("n_lines"))


@query("page_listing", "SELECT regexp_extract(url, '^https?://([^/]*)', 1) AS host, count(*) AS n_files, CAST(sum(strlen(html)) AS BIGINT) AS n_bytes FROM pages WHERE html <> '' GROUP BY 1")
def page_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as files in a folder of their host, some hosts without a file, and listed again."""
    folder = run_folder(spark, "pages")
    pages = table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^https?://([^/]*)", 1).alias("host"), "page_id", "html").where("html <> ''")
    keyed = pages.select(F.concat_ws("/", F.lit(f"{folder}/in"), "host", text("page_id")).alias("path"), "html")
    AR.write_texts(keyed).write.parquet(f"{folder}/log")
    host = F.regexp_extract("path", "/in/([^/]*)/", 1).alias("host")
    return FI.listing(spark, f"{folder}/in").groupBy(host).agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


@query("table_copy", "SELECT count(*) AS source_rows, count(*) AS target_rows, true AS is_equal FROM embeddings")
def table_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TB.copy_table(table(spark, sf_dir, "embeddings"), run_folder(spark, "table-copy"), as_text=True)


@query("table_export", "SELECT 'JSON' AS fmt, o_orderkey, o_totalprice FROM orders UNION ALL SELECT 'TSVWithNames', o_orderkey, o_totalprice FROM orders UNION ALL SELECT 'CSV', o_orderkey, o_totalprice FROM orders")
def table_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, rows = run_folder(spark, "export"), table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    out = None
    for fmt in ("JSON", "TSVWithNames", "CSV"):
        TB.export_table(rows, f"{folder}/{fmt}", fmt, "gzip")
        reader = spark.read.schema(schema_of(rows))
        back = reader.json(f"{folder}/{fmt}") if fmt == "JSON" else reader.option("header", "true").option("sep", "\t" if fmt.startswith("TSV") else ",").csv(f"{folder}/{fmt}")
        part = back.select(F.lit(fmt).alias("fmt"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query("switched_table", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def switched_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of a table kept twice; a third one with a wrong count changes nothing."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    double = LG.SwitchedTable(spark, run_folder(spark, "switched"))
    double.load(rows)
    double.load(rows.where("o_orderstatus <> 'F'"))
    try:
        double.load(rows.where("o_orderstatus = 'P'"), expected=-1)
    except ValueError:
        pass
    return double.read()


@query("audit_append", f"SELECT '/api/' || event_type AS url, count(*) AS n, CAST(sum({KEY_SQL}) AS BIGINT) AS total FROM events GROUP BY 1")
def audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_folder(spark, "audit")
    ev = table(spark, sf_dir, "events")
    for half in (0, 1):
        LG.append_audit(ev.where(F.col("event_id") % 2 == half).select(F.concat(F.lit("/api/"), "event_type").alias("url"), F.col("props").alias("body")), folder)
    back = spark.read.schema("url string, body string").json(folder).withColumnRenamed("body", "props")
    return back.groupBy("url").agg(F.count("*").alias("n"), F.sum(key_of_props()).alias("total"))
