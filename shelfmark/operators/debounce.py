"""Keep-latest, debounce and release order of jobs.

A job waits ``delay_s`` after its arrival; an equal job arriving meanwhile replaces it. Both the number of equal jobs and
the share of one key in the feed are unbounded, so nothing here sorts all rows of a key in one task: time is cut into slices
no longer than the shortest wait, rows are reduced to one per key and slice before they are shuffled, and neighbouring slices
are compared within chunks of bounded length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.config import CORRECTED, check_mode
from shelfmark.functions.times import ntz, time_slice

REFERENCE_KEY = ("op", "pid", "dsid")
CORRECTED_KEY = ("kind", "op", "doc_id")
SLICES_PER_CHUNK = 4096


def job_key(mode: str) -> tuple[str, ...]:
    """What makes two jobs equal; ``reference`` does not tell object jobs from datastream jobs."""
    return CORRECTED_KEY if check_mode(mode) == CORRECTED else REFERENCE_KEY


def position() -> Column:
    return F.struct(F.col("arrival").alias("at"), "seq")


def keep_latest(jobs: DataFrame, key: tuple[str, ...] = REFERENCE_KEY) -> DataFrame:
    """The last of equal jobs, when all of them are pending together. Reduced per task before the shuffle."""
    latest = jobs.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(
        F.max_by(F.struct(*jobs.columns), position()).alias("job")
    )
    return latest.select("job.*")


def _checked_slice(min_delay_s: int, max_delay_s: int) -> Column:
    """Slice number of a job; a wait outside the announced bounds would break the slicing and is refused."""
    delay = F.col("delay_s")
    outside = (delay != 0) & ~delay.between(min_delay_s, max_delay_s)
    return F.when(outside, F.raise_error(F.lit("delay_s outside the given bounds")).cast("bigint")).otherwise(
        time_slice(F.col("arrival"), min_delay_s)
    )


def debounce(
    jobs: DataFrame, key: tuple[str, ...] = REFERENCE_KEY, min_delay_s: int = 1, max_delay_s: int = 5
) -> DataFrame:
    """Jobs that no equal job replaces: none arrives after them and before ``ready_at``.

    ``min_delay_s`` and ``max_delay_s`` bound the non-zero waits. A job without a wait is always released.
    """
    return _instant(jobs).unionByName(_outlasting(jobs, key, min_delay_s, max_delay_s))


def _instant(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("delay_s") == 0)


def _outlasting(jobs: DataFrame, key: tuple[str, ...], min_delay_s: int, max_delay_s: int) -> DataFrame:
    """Waiting jobs that are not replaced.

    At most the last job of a key and slice can be released, since a later one in the same slice arrives within the wait; it
    is released when the key's next arrival, in one of the following slices, is not before ``ready_at``.
    """
    keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]
    names = [f"_k{i}" for i in range(len(key))]
    waiting = F.when(F.col("delay_s") > 0, F.struct(*jobs.columns))
    per_slice = jobs.groupBy(*keys, _checked_slice(min_delay_s, max_delay_s).alias("_slice")).agg(
        F.min("arrival").alias("_first"), F.max_by(waiting, position()).alias("job")
    )
    # A chunk also sees the slices after it, as far as a job can wait.
    reach = math.ceil(max_delay_s / min_delay_s)
    size = max(SLICES_PER_CHUNK, reach)  # so that a slice lies in two chunks at most
    chunk = F.floor(F.col("_slice") / size)
    first_chunk = F.floor((F.col("_slice") - reach) / size)
    rows = per_slice.select("*", chunk.alias("_own"), F.explode(F.sequence(first_chunk, chunk)).alias("_chunk"))
    next_slice = Window.partitionBy(*names, "_chunk").orderBy("_slice")
    judged = rows.withColumn("_next", F.lead("_first").over(next_slice)).where(
        (F.col("_own") == F.col("_chunk")) & F.col("job").isNotNull()
    )
    released = judged.where(F.col("_next").isNull() | (F.col("_next") >= F.col("job.ready_at")))
    return released.select("job.*")


def mark_interrupted(
    jobs: DataFrame, events: DataFrame, on: str, min_delay_s: int = 1, max_delay_s: int = 5
) -> DataFrame:
    """Add ``interrupted``: an event (``on, at, seq``) of the same ``on`` falls between a job's position and ``ready_at``.

    Jobs fall into classes by wait: a class's slices are no longer than its waits and no shorter than half of them, so a job
    looks no further than two slices ahead, whatever the ratio of the longest to the shortest wait. Events are reduced per ``on``
    and shortest slice, then per class, and announced to the slices whose jobs can still be waiting for them. Jobs then look up
    one row of their own slice, so a crowded value of ``on`` is spread over its slices.
    """
    classes = [k for k in range(64) if k == 0 or min_delay_s << k <= max_delay_s]
    finest = events.groupBy(on, time_slice(F.col("at"), min_delay_s).alias("_fine")).agg(
        F.min("at").alias("first"), F.max(F.struct("at", "seq")).alias("last")
    )
    wider = F.explode(F.array(*[F.struct(F.lit(k).alias("_class"), F.floor(F.col("_fine") / (1 << k)).alias("_at_slice")) for k in classes]))
    per_slice = finest.select(on, "first", "last", wider.alias("_wider")).groupBy(on, "_wider._class", "_wider._at_slice").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    )
    announced = (
        per_slice.withColumn("_slice", F.explode(F.sequence(F.col("_at_slice") - 2, F.col("_at_slice"))))
        .groupBy(on, "_class", "_slice")
        .agg(
            F.max(F.when(F.col("_slice") == F.col("_at_slice"), F.col("last"))).alias("_same_slice"),
            F.min(F.when(F.col("_slice") < F.col("_at_slice"), F.col("first"))).alias("_later"),
        )
    )
    of_wait = sum(((F.col("delay_s") >= (min_delay_s << k)).cast("int") for k in classes[1:]), F.lit(0))
    sliced = jobs.withColumn("_class", of_wait).withColumn(
        "_slice", F.floor(_checked_slice(min_delay_s, max_delay_s) / F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_class")))
    )
    looked_up = sliced.join(announced, [on, "_class", "_slice"], "left")
    hit = (F.col("_same_slice") > position()) | (F.col("_later") < F.col("ready_at"))
    return looked_up.select(
        *jobs.columns, ((F.col("delay_s") > 0) & F.coalesce(hit, F.lit(False))).alias("interrupted")
    )


def cancel_deleted(
    waiting: DataFrame, feed: DataFrame, min_delay_s: int = 1, max_delay_s: int = 5
) -> DataFrame:
    """Drop waiting jobs whose object, or own datastream, is deleted before they are ready (``corrected`` mode).

    ``feed`` is the whole feed the jobs come from; only its DELETEs are read.
    """
    deletes = feed.where(F.col("op") == "DELETE")
    events = [F.col("arrival").alias("at"), "seq"]
    objects = deletes.where(F.col("kind") == "object").select("pid", *events)
    datastreams = deletes.where(F.col("kind") != "object").select("doc_id", *events)
    bounds = (min_delay_s, max_delay_s)
    kept = mark_interrupted(waiting, objects, "pid", *bounds).where(~F.col("interrupted")).drop("interrupted")
    marked = mark_interrupted(kept, datastreams, "doc_id", *bounds)
    return marked.where((F.col("kind") == "object") | ~F.col("interrupted")).select(*waiting.columns)


def settle(feed: DataFrame, mode: str = "reference", min_delay_s: int = 1, max_delay_s: int = 5) -> DataFrame:
    """Jobs of ``feed`` that are carried out: debounced with the mode's key and, if ``corrected``, cancelled by DELETEs."""
    waiting = _outlasting(feed, job_key(mode), min_delay_s, max_delay_s)
    if mode == CORRECTED:
        waiting = cancel_deleted(waiting, feed, min_delay_s, max_delay_s)
    return _instant(feed).unionByName(waiting)


def due(jobs: DataFrame, now) -> DataFrame:
    """Jobs whose wait is over."""
    return jobs.where(F.col("ready_at") <= ntz(now))


def remaining_s(now) -> Column:
    """Seconds a job still has to wait; negative when it is overdue."""
    return (F.col("ready_at") - ntz(now)).cast("interval second").cast("decimal(20,6)")


def release_order(jobs: DataFrame) -> DataFrame:
    return jobs.orderBy("ready_at", "seq")


def next_jobs(jobs: DataFrame, k: int) -> DataFrame:
    """The ``k`` jobs to be released next; planned as a distributed top-k, not a full sort."""
    return release_order(jobs).limit(k)
