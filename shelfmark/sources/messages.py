"""Change messages: reading, topic and property filters, body parsing."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.config import CORRECTED, DEFAULT_RULES, DSID_SCHEME, JobRule, check_mode


def read_messages(
    spark: SparkSession, path: str, fmt: str = "json", streaming: bool = False, **options: str
) -> DataFrame:
    """Landed messages as a batch or a stream; messages without a text body are left out.

    ``fmt="kafka"`` reads key and value of a topic (``path`` is the topic) where the Kafka connector is installed.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        raw = reader.format("kafka").options(subscribe=path, **options).load()
        value = F.from_json(F.col("value").cast("string"), schemas.MESSAGES)
        messages = raw.select(value.alias("m")).select("m.*")
    else:
        messages = reader.schema(schemas.MESSAGES).format(fmt).options(**options).load(path)
    return text_messages(messages)


def text_messages(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("body").isNotNull())


def topic_pattern(pattern: str) -> str:
    """Regular expression for a dotted topic filter: ``*`` is one part, a final ``>`` any number of parts."""
    parts = pattern.split(".")
    rest = parts and parts[-1] == ">"
    fixed = [r"[^.]+" if p == "*" else re.escape(p) for p in (parts[:-1] if rest else parts)]
    body = r"\.".join(fixed)
    if rest:
        body = rf"{body}(?:\..*)?" if fixed else ".*"
    return rf"\A(?:{body})\z"


def topic_filter(messages: DataFrame, pattern: str) -> DataFrame:
    if not re.search(r"(?:^|\.)[*>](?:\.|$)", pattern):
        return messages.where(F.col("topic") == pattern)
    return messages.where(F.col("topic").rlike(topic_pattern(pattern)))


def message_selector(messages: DataFrame, condition: str | None) -> DataFrame:
    """SQL condition on the message properties ``pid`` and ``methodName``; empty means all messages."""
    if not condition or not condition.strip():
        return messages
    named = messages.withColumn("methodName", F.col("method_name"))
    return named.where(F.expr(condition)).drop("methodName")


def dsid_of(categories: Column) -> Column:
    """Term of the first datastream category, ``""`` without one."""
    own = F.filter(categories, lambda c: c["_scheme"] == DSID_SCHEME)
    return F.coalesce(F.get(own, F.lit(0))["_term"], F.lit(""))


def parse_atom(messages: DataFrame) -> DataFrame:
    """Add ``dsid`` and ``_corrupt_record`` (the text of a body that is not well-formed XML)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    # Generated rather than projected, so that later filters on the result do not parse a second time.
    parsed = messages.select("*", F.explode(F.array(F.from_xml("body", schemas.ATOM_BODY, options))).alias("_atom"))
    return parsed.select(
        *messages.columns, dsid_of(F.col("_atom.category")).alias("dsid"), F.col("_atom._corrupt_record")
    )


def _malformed(mode: str, rules: tuple[JobRule, ...]) -> Column:
    """Why a message cannot be used; null for a usable one."""
    broken = F.col("_corrupt_record").isNotNull()
    if check_mode(mode) == CORRECTED:
        # Methods whose jobs carry no datastream id do not depend on the body.
        needs_body = {r.method for r in rules if r.keep_dsid}
        independent = sorted({r.method for r in rules} - needs_body)
        broken = broken & ~F.col("method_name").isin(independent)
    return (
        F.when(F.col("method_name").isNull(), "no method name")
        .when(F.col("pid").isNull(), "no pid")
        .when(F.coalesce(broken, F.lit(True)), "body is not well-formed")
    )


def judge_messages(parsed: DataFrame, mode: str = "reference", rules: tuple[JobRule, ...] = DEFAULT_RULES) -> DataFrame:
    """Add the ``reason`` why a message cannot be used: a broken body, a missing method name or pid; null for a usable one."""
    return parsed.withColumn("reason", _malformed(mode, rules))


def split_malformed(
    parsed: DataFrame, mode: str = "reference", rules: tuple[JobRule, ...] = DEFAULT_RULES
) -> tuple[DataFrame, DataFrame]:
    """(usable, malformed) messages: a broken body, a missing method name or pid is set aside with its ``reason``, the rest goes on."""
    reason = _malformed(mode, rules)
    return parsed.where(reason.isNull()), judge_messages(parsed, mode, rules).where(F.col("reason").isNotNull())
