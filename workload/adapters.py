"""The test tables seen as repository data.

Waits count in days here: the event table spans a month, and with seconds hardly any job would meet an equal one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.config import DSID_SCHEME, PipelineConfig
from shelfmark.functions.times import plus_seconds
from shelfmark.operators.index_tables import IndexTables
from shelfmark.operators.jobs import MESSAGE_FEED, sequence
from shelfmark.sources.repository import Repository

DAY_S = 86400
DOC_IDS_PER_PAGE = 500
ATOM = "http://www.w3.org/2005/Atom"


def config(mode: str = "reference", **changes) -> PipelineConfig:
    return PipelineConfig(mode=mode, delay_unit_s=DAY_S, **changes)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread rows with much work each over all cores when their files make fewer tasks; large inputs are left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def method_of(event_type: Column, event_id: Column) -> Column:
    return (
        F.when(event_type == "signup", "ingest")
        .when(event_type == "view", "getObjectXML")
        .when(event_type == "click", "modifyDatastreamByValue")
        .when((event_type == "purchase") & (event_id % 2 == 0), "addDatastream")
        .when(event_type == "purchase", "modifyObject")
        .when((event_type == "error") & (event_id % 8 == 0), "purgeObject")
        .when(event_type == "error", "purgeDatastream")
    )


def messages_from_events(events: DataFrame) -> DataFrame:
    """Messages with their datastream id at hand, without a body."""
    method = method_of(F.col("event_type"), F.col("event_id"))
    return events.select(
        F.col("event_id").alias("msg_id"),
        F.when(F.col("event_type") == "view", "fedora.apim.access").otherwise("fedora.apim.update").alias("topic"),
        F.concat(F.lit("conv:"), F.col("user_id")).alias("pid"),
        method.alias("method_name"),
        F.concat(F.lit("T"), F.col("event_id") % 4).alias("dsid"),
        F.col("ts").alias("arrival"),
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return messages_from_events(table(spark, sf, "events"))


def with_bodies(plain: DataFrame, damage: bool = False) -> DataFrame:
    """Replace ``dsid`` by an Atom body that carries it for datastream methods; ``damage`` breaks every 97th body."""
    carries = F.col("method_name").contains("Datastream")
    category = F.format_string('<category term="%s" scheme="%s" label="xsd:string"/>', F.col("dsid"), F.lit(DSID_SCHEME))
    body = F.concat(
        F.format_string('<?xml version="1.0" encoding="UTF-8"?><!-- %d --><entry xmlns="%s">', F.col("msg_id"), F.lit(ATOM)),
        F.format_string('<title type="text">%s</title><summary type="text">%s</summary>', F.col("method_name"), F.col("pid")),
        F.format_string('<category term="%s" scheme="fedora-types:pid" label="xsd:string"/>', F.col("pid")),
        F.when(carries, category).otherwise(""),
        F.lit("</entry>"),
    )
    if damage:
        body = F.when(F.col("msg_id") % 97 == 0, F.substring(body, 1, 120)).otherwise(body)
    return plain.select("msg_id", "topic", "pid", "method_name", body.alias("body"), "arrival")


def object_profiles(conversations: DataFrame) -> DataFrame:
    created = plus_seconds(F.expr("TIMESTAMP_NTZ '2024-01-01'"), F.col("conv_id") % DAY_S)
    return conversations.groupBy("conv_id").agg(F.min_by("role", "turn").alias("role"), F.max("turn").alias("last")).select(
        F.concat(F.lit("conv:"), F.col("conv_id")).alias("pid"),
        F.when(F.col("conv_id") % 5 == 0, "I").otherwise("A").alias("state"),
        F.concat(F.lit("conversation opened by "), F.col("role")).alias("label"),
        F.lit("archive").alias("owner_id"),
        created.alias("create_date"),
        plus_seconds(created, F.col("last")).alias("last_modified_date"),
    )


def datastream_profiles(conversations: DataFrame) -> DataFrame:
    dsid = F.concat(F.lit("T"), F.col("turn"))
    none = F.lit(None).cast("string")
    return conversations.select(
        F.concat(F.lit("conv:"), F.col("conv_id")).alias("pid"), dsid.alias("ds_id"), F.col("role").alias("ds_label"),
        F.concat(dsid, F.lit(".0")).alias("ds_version_id"),
        plus_seconds(F.expr("TIMESTAMP_NTZ '2024-01-01'"), F.col("turn")).alias("ds_create_date"),
        F.lit("A").alias("ds_state"), F.lit("text/plain").alias("ds_mime"), none.alias("ds_format_uri"),
        F.lit("M").alias("ds_control_group"), F.octet_length("text").cast("bigint").alias("ds_size"),
        F.when(F.col("turn") % 2 == 0, "true").otherwise("false").alias("ds_versionable"),
        none.alias("ds_info_type"), none.alias("ds_location"), none.alias("ds_location_type"),
        F.lit("DISABLED").alias("ds_checksum_type"), F.lit("none").alias("ds_checksum"),
    )


def contents(conversations: DataFrame) -> DataFrame:
    """Turn texts; some are not available."""
    lost = (F.col("conv_id") + F.col("turn")) % 13 == 0
    return conversations.select(
        F.concat(F.lit("conv:"), F.col("conv_id")).alias("pid"), F.concat(F.lit("T"), F.col("turn")).alias("ds_id"),
        F.when(lost, 404).otherwise(200).alias("status"), F.col("text").cast("binary").alias("content"),
    )


def disseminations(events: DataFrame) -> DataFrame:
    """Latest properties of every user as JSON; some services do not answer with 200, some answer with broken JSON."""
    latest = events.groupBy("user_id").agg(F.max_by("props", F.struct("ts", "event_id")).alias("props"))
    return latest.select(
        F.concat(F.lit("conv:"), F.col("user_id")).alias("pid"), F.lit("demo:SDef").alias("sdef_pid"),
        F.lit("getIndexDocument").alias("method"),
        F.when(F.col("user_id") % 7 == 0, 404).when(F.col("user_id") % 17 == 3, None).otherwise(200).alias("status"),
        F.when(F.col("user_id") % 11 == 0, F.lit('{"k": ')).otherwise(F.col("props")).alias("json"),
    )


def repository(spark: SparkSession, sf: str) -> Repository:
    conversations = table(spark, sf, "conversations")
    return Repository(
        object_profiles(conversations), datastream_profiles(conversations), contents(conversations),
        disseminations(table(spark, sf, "events")),
    )


def seed_tables(spark: SparkSession, sf: str) -> IndexTables:
    """Index tables as an earlier run left them, before the last turn of every conversation; and some errors."""
    conversations = table(spark, sf, "conversations")
    last = conversations.groupBy("conv_id").agg(F.max("turn").alias("_last"))
    earlier = conversations.join(last, "conv_id").where(F.col("turn") < F.col("_last"))
    pid = F.concat(F.lit("conv:"), F.col("conv_id"))
    dsid = F.concat(F.lit("T"), F.col("turn"))
    none, no_time = F.lit(None).cast("string"), F.lit(None).cast("timestamp_ntz")
    objects = earlier.select("conv_id").distinct().select(
        pid.alias("PID"), F.lit("A").alias("STATE"), F.lit("seed").alias("LABEL"), none.alias("OWNER_ID"),
        no_time.alias("CREATED_DATE"), no_time.alias("LAST_MODIFIED_DATE"),
        F.lit(None).cast("struct<_sdef_pid: string, _method: string, _content: variant>").alias("_dissemination"),
        pid.alias("doc_id"), F.lit(1).cast("bigint").alias("_version"),
    )
    datastreams = earlier.select(
        pid.alias("PID"), dsid.alias("DSID"), F.lit("seed").alias("LABEL"), none.alias("VERSION_ID"),
        no_time.alias("CREATED_DATE"), F.lit("A").alias("STATE"), F.lit("text/plain").alias("MIMETYPE"),
        none.alias("CONTROL_GROUP"), F.lit(0).cast("bigint").alias("SIZE"), F.lit(True).alias("VERSIONABLE"),
        none.alias("CHECKSUM_TYPE"), none.alias("CHECKSUM"),
        F.lit(None).cast("struct<_uri: string, _content: string>").alias("CONTENT"),
        F.concat_ws(":", pid, dsid).alias("doc_id"), F.lit(1).cast("bigint").alias("_version"),
    )
    return IndexTables(objects, datastreams, seed_errors(spark, sf))


def seed_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of earlier runs, one per user: of the object, or of its second turn."""
    users = table(spark, sf, "events").groupBy("user_id").agg(F.min("ts").alias("first"))
    of_turn = F.col("user_id") % 2 == 1
    pid = F.concat(F.lit("conv:"), F.col("user_id"))
    doc = F.when(of_turn, F.concat(pid, F.lit(":T1"))).otherwise(pid)
    return users.select(
        doc.alias("doc_id"), pid.alias("PID"), F.when(of_turn, "T1").otherwise("").alias("DSID"), F.format_string("[UPDATE] [%s]", doc).alias("job"),
        F.lit("seed").alias("message"),
        plus_seconds(F.col("first"), -(F.col("user_id") % 60) * DAY_S).alias("timestamp"),
    )


def large_parents(orders: DataFrame) -> DataFrame:
    """Released object CREATEs, one per order."""
    return orders.select(
        F.lit("object").alias("kind"), F.lit("CREATE").alias("op"),
        F.concat(F.lit("order:"), F.col("o_orderkey")).alias("pid"), F.lit("").alias("dsid"),
        F.col("o_orderdate").alias("arrival"), F.lit(0).alias("delay_s"), sequence(MESSAGE_FEED, F.lit(""), F.col("o_orderkey"), F.lit(0)).alias("seq"),
    )


def repeated_parents(lineitem: DataFrame) -> DataFrame:
    """Released object CREATEs of orders, one per line item: as many as the order has datastreams."""
    return lineitem.select(
        F.lit("object").alias("kind"), F.lit("CREATE").alias("op"), F.concat(F.lit("order:"), F.col("l_orderkey")).alias("pid"),
        F.lit("").alias("dsid"), F.col("l_shipdate").cast("timestamp_ntz").alias("arrival"), F.lit(0).alias("delay_s"),
        sequence(MESSAGE_FEED, F.lit(""), F.col("l_orderkey"), F.col("l_linenumber")).alias("seq"),
    )


def large_listing(lineitem: DataFrame) -> DataFrame:
    """Datastreams of orders; line numbers repeat in the table and count once."""
    return lineitem.select("l_orderkey", "l_linenumber").distinct().select(
        F.concat(F.lit("order:"), F.col("l_orderkey")).alias("pid"), F.concat(F.lit("L"), F.col("l_linenumber")).alias("dsid")
    )


def harvest_pages(documents: DataFrame) -> DataFrame:
    """Listings of at most 500 documents per source and page, as XML.

    A page covers a fixed range of ids, so no source is ever gathered in one group.
    """
    number = F.floor(F.col("doc_id") / DOC_IDS_PER_PAGE)
    grouped = documents.groupBy("source", number.alias("page_no")).agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    request_at = plus_seconds(F.expr("TIMESTAMP_NTZ '2024-02-01'"), F.col("page_no") * 60)
    header = F.transform(
        "ids",
        lambda i: F.concat(
            F.when(i % 10 == 0, '<header status="deleted">').otherwise("<header>"), F.lit("<identifier>oai:"), F.col("source"),
            F.lit(":doc:"), i, F.lit("</identifier><datestamp>2024-01-01T00:00:00Z</datestamp></header>"),
        ),
    )
    expires = F.date_format(plus_seconds(request_at, 3600), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    token = (
        F.when(F.col("page_no") % 4 == 3, "<resumptionToken/>")
        .when(F.col("page_no") % 4 == 2, F.lit(""))
        .when(
            F.col("page_no") % 4 == 1,
            F.format_string('<resumptionToken expirationDate="%s" cursor="0">tok-%s-%d</resumptionToken>', expires, "source", "page_no"),
        )
        .otherwise(F.format_string("<resumptionToken>tok-%s-%d</resumptionToken>", "source", "page_no"))
    )
    body = F.concat(
        F.lit('<?xml version="1.0"?><OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListIdentifiers>'),
        F.array_join(header, ""), token, F.lit("</ListIdentifiers></OAI-PMH>"),
    )
    lost = (F.substring("source", 4, 10).cast("bigint") + F.col("page_no")) % 7 == 3
    return grouped.select(
        "source", "page_no", request_at.alias("request_at"), F.when(lost, 503).otherwise(200).alias("http_status"),
        body.alias("body"),
    )


def last_run_raw(orders: DataFrame) -> DataFrame:
    """Stored harvest states as text, one per customer, with the gaps and damage such states show."""
    latest = orders.groupBy("o_custkey").agg(
        F.max("o_orderdate").alias("day"), F.max("o_orderkey").alias("order")
    )
    key = F.col("o_custkey")
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    ts = F.date_format(plus_seconds(F.col("day"), (key * 977) % DAY_S), iso)
    return latest.select(
        F.concat(F.lit("cust:"), key).alias("source"),
        F.when(key % 10 == 0, None).when(key % 10 == 1, "").otherwise(ts).alias("ts"),
        F.when(key % 6 == 0, "BAR")
        .when(key % 6 == 1, None)
        .when(key % 6 == 2, "")
        .otherwise(F.date_format(plus_seconds(F.col("day"), (key % 900) * DAY_S), iso))
        .alias("expiration_date"),
        F.when(key % 4 == 0, None).when(key % 4 == 1, "").otherwise(F.concat(F.lit("tok:"), F.col("order"))).alias("resumption_token"),
    )
