"""Documents to training tokens: the stages in order, each over all rows that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm.bpe import encode_and_decode
from shelfmark.llm.common import drop_scratch, in_scratch, materialize, table
from shelfmark.llm.decontaminate import find_contamination
from shelfmark.llm.line_dedup import dedup_lines
from shelfmark.llm.quality import judge
from shelfmark.llm.simhash import near_duplicates
from shelfmark.session import scratch_scope


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps, each row judged by itself; without labels of both kinds all of them.

    A null text is judged as an empty one and stays null; null sources and languages are sites of their own.
    """
    return judge(docs, table(spark, sf_dir, "labels"), carry=docs.columns).where("kept").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the repeated lines; ``n_chars``, where there is such a column, follows the text.

    A null text becomes an empty one. Rows that repeat an id, or have none, are one document and are each cleaned.
    """
    clean = dedup_lines(docs, carry=docs.columns)
    own = {c: F.col("row").getField(c) for c in docs.columns} | {"text": F.col("kept")}
    if "n_chars" in own:
        own["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return clean.select(*[own[c].alias(c) for c in docs.columns])


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group, null last; of rows that repeat the id, one.

    Rows are numbered and written, so that each has the same number wherever it is read. Texts without words, null ones among them, are a group.
    """
    rows = materialize(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("number")), "simhash-rows")
    place = F.struct(F.col("row.doc_id").isNull().alias("unknown"), F.col("row.doc_id").alias("doc_id"), "number")
    near = near_duplicates(rows.select(place.alias("place"), F.col("row.text").alias("text")), id_col="place")
    first = near.where(F.col("id") == F.col("component_id")).select(F.col("id.number").alias("number"))
    return rows.join(first, "number", "left_semi").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated, each row judged by itself; a null text has no words and stays."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), carry=docs.columns)
    return found.where(~F.col("contaminated")).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and digests of the ids and of the decoded text; a null text is an empty one. Other columns end here."""
    made = encode_and_decode(docs, carry=["doc_id", "text"], keep=("ids",))
    return made.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [("quality", quality), ("lines", lines), ("simhash", simhash), ("decontamination", decontamination), ("bpe", tokens)]

#: A trained classifier, a similarity closure and a tokenizer are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again as the next one's input.

    What a stage wrote for itself is deleted with its input as soon as its result is there.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = in_scratch(spark, f"pipeline-{name}")
        with scratch_scope(spark, name):
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        if before is not None:
            drop_scratch(spark, before)
        docs, before = spark.read.schema(made.schema).parquet(path), path
    return docs
