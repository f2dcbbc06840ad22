"""Notifications about sent files and receipts about received ones, as XML rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from haulage.functions import times as T

DECLARATION = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def request_id(package: Column, file: Column) -> Column:
    """Same file, same id: a repeated run sends the same request."""
    return F.md5(F.concat_ws("|", package, file))


def notifications(files: DataFrame, package: str, scenario: str, at) -> DataFrame:
    """One request per file ``(position, name)``: ``(position, rq_uid, name, message)``, the summary ticket at position 0."""
    uid = request_id(F.lit(package), F.col("name"))
    body = F.struct(
        uid.alias("RqUID"), T.iso_millis(T.moment(at)).alias("RqTm"), F.struct(F.lit(scenario).alias("ScenarioId")).alias("ScenarioInfo"),
        F.struct(F.struct(F.col("name").alias("Name")).alias("FileInfo")).alias("File"))
    xml = F.to_xml(body, {"rowTag": "TransferFileCephRq"})
    return files.select("position", uid.alias("rq_uid"), "name", F.concat(F.lit(DECLARATION), xml).alias("message"))


def package_files(named: DataFrame) -> DataFrame:
    """Files to announce: the summary ticket, then the archives in part order."""
    ticket = named.select(F.lit(0).cast("bigint").alias("position"), F.col("ticket_name").alias("name")).distinct()
    return ticket.unionByName(named.select(F.col("part_index").alias("position"), F.col("archive_name").alias("name")))


def receipts(status: DataFrame, at) -> DataFrame:
    """XML receipts of ``(rq_uid, code, text)``."""
    body = F.struct(F.col("rq_uid").alias("RqUID"), T.iso_millis(T.moment(at)).alias("RqTm"), F.col("code").alias("StatusCode"), F.col("text").alias("StatusDesc"))
    return status.select("rq_uid", "code", F.concat(F.lit(DECLARATION), F.to_xml(body, {"rowTag": "TransferFileCephRs"})).alias("message"))


def send(messages: DataFrame, path: str) -> None:
    """Land messages as text, one JSON object per message; a Kafka writer takes the same ``value`` column."""
    messages.select(F.to_json(F.struct("rq_uid", "message")).alias("value")).write.mode("append").text(path)
