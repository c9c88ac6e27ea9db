"""Landed harvest pages: identifiers and paging state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions.ids import local_identifier
from shelfmark.functions.times import iso_utc


def read_harvest_pages(
    spark: SparkSession, path: str, fmt: str = "json", streaming: bool = False, **options: str
) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schemas.HARVEST_PAGES).format(fmt).options(**options).load(path)


def read_page_files(spark: SparkSession, path: str, source: str) -> DataFrame:
    """One page per XML file; the file's modification time stands for the request time."""
    files = spark.read.option("wholetext", True).text(path)
    modified = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.col("_metadata.file_modification_time").cast("timestamp_ntz")
    )
    number = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\D*$", 1).try_cast("bigint")
    return files.select(
        F.lit(source).alias("source"), number.alias("page_no"), modified.alias("request_at"),
        F.lit(200).alias("http_status"), F.col("value").alias("body"),
    )


def parse_pages(pages: DataFrame) -> DataFrame:
    """Add the parsed body and ``failed``: another status than 200, no body, or a body that is not well-formed."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    # Generated rather than projected, so that later filters on the result do not parse a second time.
    parsed = pages.select("*", F.explode(F.array(F.from_xml("body", schemas.HARVEST_BODY, options))).alias("_page"))
    expiration = F.col("_page.ListIdentifiers.resumptionToken._expirationDate")
    failed = (
        (F.coalesce(F.col("http_status"), F.lit(0)) != 200)
        | F.col("body").isNull()
        | F.col("_page._corrupt_record").isNotNull()
    )
    # An expiration date that cannot be read makes the page fail after its identifiers were taken.
    bad_date = F.coalesce((expiration != "") & iso_utc(expiration).isNull(), F.lit(False))
    return parsed.withColumn("failed", failed).withColumn("state_failed", failed | bad_date)


def explode_identifiers(pages: DataFrame) -> DataFrame:
    """One row per listed identifier of every usable page, with its local part and deletion mark."""
    headers = parse_pages(pages).where(~F.col("failed")).select(
        "source", "page_no", "request_at",
        F.posexplode("_page.ListIdentifiers.header").alias("position", "header"),
    )
    return headers.where(F.col("header.identifier").isNotNull()).select(
        "source", "page_no", "request_at", "position",
        F.col("header.identifier").alias("identifier"),
        local_identifier(F.col("header.identifier")).alias("pid"),
        F.coalesce(F.col("header._status") == "deleted", F.lit(False)).alias("deleted"),
    )


def page_state(pages: DataFrame) -> DataFrame:
    """Paging state per page: failed, token (``""`` when absent or empty) and expiration (null when absent)."""
    token = F.col("_page.ListIdentifiers.resumptionToken")
    ok = ~F.col("state_failed")
    return parse_pages(pages).select(
        "source", "page_no", "request_at",
        F.col("state_failed").alias("failed"),
        F.when(ok, F.coalesce(F.trim(token["_VALUE"]), F.lit(""))).otherwise("").alias("resumption_token"),
        F.when(ok, iso_utc(F.nullif(token["_expirationDate"], F.lit("")))).alias("expiration_date"),
    )
