"""Jobs from messages, harvest pages and object listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.config import CORRECTED, DEFAULT_RULES, JobRule, check_mode
from shelfmark.functions import ids
from shelfmark.functions.times import ready_at
from shelfmark.operators.skew import salted_lookup
from shelfmark.schemas import JOB_COLUMNS

MESSAGE_FEED, PAGE_FEED = 0, 1


def sequence(feed: int, source: Column, number: Column, position: Column) -> Column:
    """Order key of a job: its feed and source, the message or page it comes from, and the place in it. No part is bounded."""
    return F.struct(
        F.lit(0).alias("generation"), F.lit(feed).alias("feed"), source.cast("string").alias("source"),
        number.cast("bigint").alias("number"), position.cast("bigint").alias("position"),
    )


def fan_out_sequence(seq: Column) -> Column:
    """Order key of the jobs that a job fans out to: after all jobs of the feeds at equal times."""
    return F.struct(
        (seq["generation"] + 1).alias("generation"), seq["feed"].alias("feed"), seq["source"].alias("source"),
        seq["number"].alias("number"), seq["position"].alias("position"),
    )


def with_identity(df: DataFrame) -> DataFrame:
    """Complete ``kind, op, pid, dsid, arrival, delay_s, seq`` to a job row."""
    return df.withColumns(
        {
            "doc_id": ids.doc_id(F.col("kind"), F.col("pid"), F.col("dsid")),
            "ready_at": ready_at(F.col("arrival"), F.col("delay_s")),
        }
    ).select(*JOB_COLUMNS)


def _rules_column(rules: tuple[JobRule, ...], delay_unit_s: int) -> Column:
    """Array of jobs for the message's method, null for unknown methods: a projection, no join."""
    by_method: dict[str, list[JobRule]] = {}
    for rule in rules:
        by_method.setdefault(rule.method, []).append(rule)
    choice = None
    for method, jobs in by_method.items():
        array = F.array(
            *[
                F.struct(
                    F.lit(i).alias("idx"), F.lit(r.kind).alias("kind"), F.lit(r.op).alias("op"),
                    F.lit(r.keep_dsid).alias("keep_dsid"), F.lit(r.delay_s * delay_unit_s).alias("delay_s"),
                )
                for i, r in enumerate(jobs)
            ]
        )
        condition = F.col("method_name") == method
        choice = F.when(condition, array) if choice is None else choice.when(condition, array)
    return choice


def derive_jobs(
    messages: DataFrame, rules: tuple[JobRule, ...] = DEFAULT_RULES, delay_unit_s: int = 1
) -> DataFrame:
    """Jobs of every message (``msg_id, pid, method_name, dsid, arrival``) by its method; unknown methods give none."""
    known = sorted({r.method for r in rules})
    jobs = messages.where(F.col("method_name").isin(known)).select(
        "msg_id", "pid", F.col("dsid").alias("_dsid"), "arrival", F.inline(_rules_column(rules, delay_unit_s))
    )
    return with_identity(
        jobs.select(
            "kind", "op", "pid", F.when(F.col("keep_dsid"), F.col("_dsid")).otherwise("").alias("dsid"),
            "arrival", "delay_s", sequence(MESSAGE_FEED, F.lit(""), F.col("msg_id"), F.col("idx")).alias("seq"),
        )
    )


def jobs_from_identifiers(identifiers: DataFrame, mode: str = "reference") -> DataFrame:
    """An immediate object CREATE per listed identifier; in ``corrected`` mode deleted records become DELETEs.

    Order among jobs of one page is the order of the list.
    """
    op = F.lit("CREATE")
    if check_mode(mode) == CORRECTED:
        op = F.when(F.col("deleted"), "DELETE").otherwise("CREATE")
    return with_identity(
        identifiers.select(
            F.lit("object").alias("kind"), op.alias("op"), "pid", F.lit("").alias("dsid"),
            F.col("request_at").alias("arrival"), F.lit(0).alias("delay_s"),
            sequence(PAGE_FEED, F.col("source"), F.col("page_no"), F.col("position")).alias("seq"),
        )
    )


def union_jobs(*feeds: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), feeds)


def fan_out(created: DataFrame, listing: DataFrame, salts: int = 8) -> DataFrame:
    """A datastream CREATE per listed datastream of each object CREATE among ``created``.

    ``created`` are released jobs whose object was built. The jobs arrive when their parent is done and wait no longer.
    """
    parents = created.where((F.col("kind") == "object") & (F.col("op") == "CREATE")).select(
        "pid", F.col("ready_at").alias("arrival"), fan_out_sequence(F.col("seq")).alias("seq")
    )
    children = salted_lookup(listing, parents, ["pid"], spread=["dsid"], how="inner", salts=salts)
    return with_identity(
        children.select(
            F.lit("datastream").alias("kind"), F.lit("CREATE").alias("op"), "pid", "dsid", "arrival",
            F.lit(0).alias("delay_s"), "seq",
        )
    )


def fan_out_counted(created: DataFrame, listing: DataFrame, salts: int = 8) -> DataFrame:
    """What ``fan_out`` gives, per listed datastream instead of per job: ``pid, dsid, doc_id, n`` jobs and the ``last`` of them
    (``arrival, seq``). The CREATEs of an object are counted before they meet its datastreams, so no pairs are formed.
    """
    last = F.struct(F.col("ready_at").alias("arrival"), fan_out_sequence(F.col("seq")).alias("seq"))
    parents = created.where((F.col("kind") == "object") & (F.col("op") == "CREATE")).groupBy("pid").agg(
        F.count(F.lit(1)).alias("n"), F.max(last).alias("last")
    )
    children = salted_lookup(listing, parents, ["pid"], spread=["dsid"], how="inner", salts=salts)
    return children.select("pid", "dsid", ids.doc_id(F.lit("datastream"), F.col("pid"), F.col("dsid")).alias("doc_id"), "n", "last")
