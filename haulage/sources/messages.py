"""Requests and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FILE_INFO = "FileInfo: array<struct<Name:string, FolderSource:string>>"
REQUEST = f"RqUID string, RqTm string, ScenarioInfo struct<ScenarioId:string>, ScenarioId string, File array<struct<{FILE_INFO}>>"
RECEIPT = "RqUID string, RqTm string, StatusCode int, StatusDesc string"


def kafka_topic(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", stream: bool = False, **options: str) -> DataFrame:
    """A topic as ``(partition, offset, at, value)``; needs Spark's Kafka connector on the class path."""
    reader = (spark.readStream if stream else spark.read).format("kafka").option("kafka.bootstrap.servers", servers).option(
        "subscribe", topic).option("startingOffsets", starting).options(**options)
    return reader.load().select("partition", "offset", F.col("timestamp").alias("at"), F.col("value").cast("string").alias("value"))


def tail(messages: DataFrame, n: int) -> DataFrame:
    """The last ``n`` messages of every partition, counted from its highest offset; no sorting."""
    high = messages.groupBy("partition").agg(F.max("offset").alias("_high"))
    return messages.join(high, "partition").where(F.col("offset") > F.col("_high") - n).drop("_high")


def parse_requests(messages: DataFrame, xml: str, keep: list[str], prefix: str = "", fallback_id: str = "manual", max_files: int | None = None) -> DataFrame:
    """Files named by transfer requests: ``(keep…, rq_uid, scenario_id, file_no, name, folder, key)``.

    All entries of a request count; ``max_files`` keeps the first ones only, for an interface with such a rule. Entries without a
    name are skipped.
    """
    parsed = messages.select(*keep, F.from_xml(xml, REQUEST, {"ignoreNamespace": "true"}).alias("r"))
    infos = F.flatten(F.transform("r.File", lambda f: f["FileInfo"]))
    files = parsed.select(
        *keep, F.trim(F.coalesce("r.RqUID", F.lit(""))).alias("rq_uid"),
        F.coalesce(F.nullif(F.trim(F.coalesce("r.ScenarioInfo.ScenarioId", "r.ScenarioId")), F.lit("")), F.lit(fallback_id)).alias("scenario_id"),
        F.posexplode(infos if max_files is None else F.slice(infos, 1, max_files)).alias("file_no", "f"))
    name = F.trim(F.coalesce("f.Name", F.lit("")))
    folder = F.regexp_replace(F.coalesce("f.FolderSource", F.lit("")), "^/+|/+$", "")
    return files.select(
        *keep, "rq_uid", "scenario_id", "file_no", name.alias("name"), folder.alias("folder"),
        F.concat(F.lit(prefix), F.when(folder != "", F.concat(folder, F.lit("/"))).otherwise(""), name).alias("key")).where(F.col("name") != "")


def parse_receipts(messages: DataFrame, xml: str, keep: list[str]) -> DataFrame:
    parsed = messages.select(*keep, F.from_xml(xml, RECEIPT, {"ignoreNamespace": "true"}).alias("r"))
    return parsed.select(*keep, F.trim("r.RqUID").alias("rq_uid"), F.col("r.StatusCode").alias("code"), F.col("r.StatusDesc").alias("text"))


def receipt_status(request_files: DataFrame, copies: DataFrame) -> DataFrame:
    """``(rq_uid, code, text)`` per request: 104 when any copy ``(rq_uid, name, failed)`` failed, else 0."""
    joined = request_files.select("rq_uid", "name").join(copies, ["rq_uid", "name"], "left")
    failed: Column = F.bool_or(F.coalesce("failed", F.lit(False)))
    return joined.groupBy("rq_uid").agg(F.when(failed, 104).otherwise(0).alias("code")).withColumn(
        "text", F.when(F.col("code") == 0, "Successful").otherwise("Transfer failed"))
