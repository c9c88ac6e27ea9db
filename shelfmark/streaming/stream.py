"""Continuous debounce and indexing of landed messages.

The clock is the latest arrival seen when landed messages are replayed (``availableNow``), so a replay gives what the queue gave. With
any other trigger it is the wall clock: ticks make micro-batches also when no message comes, so the last jobs of a quiet repository
are released on time and a message dated ahead moves nothing. Jobs that are still waiting by the clock are kept between micro-batches in a small table
(they live no longer than the longest wait), so a micro-batch is the batch program over waiting and new jobs: it gives the same
result, spreads crowded keys in the same way and needs no Python state handling. A micro-batch becomes visible with one commit
that carries its id; a repeated one is recognised and skipped.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shelfmark import schemas
from shelfmark.config import PipelineConfig
from shelfmark.functions.times import ntz
from shelfmark.operators.debounce import settle
from shelfmark.operators.filters import JobPredicate
from shelfmark.operators.harvest import latest_page, save_last_run
from shelfmark.operators.jobs import union_jobs
from shelfmark.operators.index_tables import Change
from shelfmark.operators.postings import postings_change
from shelfmark.plans.batch import feed_jobs, malformed_rows, read_feed_once, run_jobs
from shelfmark.plans.store import Commit, IndexStore
from shelfmark.session import empty_frame, materialize, scratch_scope
from shelfmark.sources.pages import page_state
from shelfmark.sources.repository import Repository


ARRIVAL, WALL = "arrival", "wall"
TICK_S = 1


def clock_of(trigger: dict | None) -> str:
    return ARRIVAL if trigger is None or "availableNow" in trigger or "once" in trigger else WALL


def _next(
    store: IndexStore, jobs: DataFrame, batch_id: int, cfg: PipelineConfig, clock: str = ARRIVAL
) -> tuple[Commit, DataFrame, object, PipelineConfig] | None:
    """(previous commit, waiting and new jobs, clock, settings), or nothing when this micro-batch was committed before.

    Stored jobs may have waits that the rules no longer give; the settings' bounds include them.
    """
    previous = store.ensure()
    if previous.batch is not None and batch_id <= previous.batch:
        return None
    feed = materialize(store.read("pending", previous).unionByName(jobs), "feed")
    waits = F.when(F.col("delay_s") > 0, F.col("delay_s"))
    latest, *delays = feed.agg(F.max("arrival"), F.min(waits), F.max(waits)).first()
    if clock == WALL:
        latest = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    known = [t for t in (previous.clock, latest) if t is not None]
    cfg = replace(cfg, waiting_delays_s=tuple(d for d in delays if d is not None))
    return previous, feed, max(known) if known else None, cfg


def _ticks(spark: SparkSession, like: DataFrame, every_s: int) -> DataFrame:
    """A stream of empty rows, so that time passes without messages."""
    rows = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("advanceMillisPerBatch", 1000 * every_s).load()
    return rows.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields])


def _start(stream: DataFrame, step, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def debounce_stream(
    jobs: DataFrame, store: IndexStore, checkpoint: str, cfg: PipelineConfig, trigger: dict | None = None
) -> StreamingQuery:
    """Debounce a stream of job rows; ``released_jobs`` reads the result."""

    def step(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(store.spark, "debounce"):
            found = _next(store, batch.where(F.col("op").isNotNull()), batch_id, cfg, clock_of(trigger))
            if found is None or found[2] is None:
                return
            previous, feed, clock, own = found
            settled = materialize(settle(feed, own.mode, *own.delays_s), "settled")
            due = F.col("ready_at") <= ntz(clock)
            settled.where(due).write.mode("overwrite").parquet(f"{store.root}/released/batch={batch_id}")
            store.commit(previous, {"pending": (settled.where(~due), None)}, batch_id, clock)

    if clock_of(trigger) == WALL:
        jobs = jobs.unionByName(_ticks(store.spark, jobs, TICK_S))
    return _start(jobs, step, checkpoint, trigger)


def released_jobs(store: IndexStore) -> DataFrame:
    """Jobs released by all committed micro-batches."""
    commit = store.ensure()
    if commit.batch is None:
        return empty_frame(store.spark, schemas.JOBS)
    rows = store.spark.read.schema(f"{schemas.JOBS}, batch BIGINT").parquet(f"{store.root}/released")
    return rows.where(F.col("batch") <= commit.batch).drop("batch")


def index_batch(
    cfg: PipelineConfig,
    jobs: DataFrame,
    store: IndexStore,
    repository: Repository,
    batch_id: int,
    final: bool = False,
    page_states: DataFrame | None = None,
    clock: str = ARRIVAL,
    malformed: DataFrame | None = None,
    **options,
) -> Commit | None:
    """One micro-batch: settle waiting and new jobs, carry out the due ones, commit tables and waiting jobs together.

    ``page_states`` are the states of the harvest pages among the batch; the sources' last-run state moves with the commit. ``malformed``
    are the messages among it that could not be read; they are kept with it.
    ``final`` carries out everything, as when no further message is expected.

    Only the buckets of due jobs are read, only changes are written, and scratch rows are gone when the commit is made.
    """
    with scratch_scope(store.spark, "micro-batch"):
        found = _next(store, jobs, batch_id, cfg, clock)
        if found is None:
            return None
        previous, feed, clock, cfg = found
        whole, changes = {}, {}
        if page_states is not None:
            state = save_last_run(store.read("last_run", previous), latest_page(page_states), cfg.mode)
            whole["last_run"] = (state, None)
        if malformed is not None:
            changes["malformed"] = Change(malformed)
        if clock is not None:
            due = feed if final else feed.where(F.col("ready_at") <= ntz(clock))
            touched = store.touched(due)
            tables = store.tables(previous, touched)
            nearby = repository.only(touched, store.buckets)
            outcome = run_jobs(cfg, feed, tables, nearby, clock=None if final else clock, **options)
            changes |= outcome.changes
            if store.analysed:
                changes["postings"] = postings_change(tables, outcome.changes, materialize)
            whole["pending"] = (outcome.waiting, None)
        done = store.commit(previous, whole, batch_id, clock, changes)
    return store.maintain(done)


def index_backlog(
    cfg: PipelineConfig,
    store: IndexStore,
    repository: Repository,
    messages: DataFrame | None = None,
    pages: DataFrame | None = None,
    predicates: tuple[JobPredicate, ...] = (),
    **options,
) -> Commit:
    """Index all landed messages and pages in one commit, nothing left waiting; unreadable messages are kept with it, as in a stream."""
    before = store.ensure().batch
    return _index_feeds(cfg, store, repository, 0 if before is None else before + 1, messages, pages, predicates, final=True, **options)


def _index_feeds(
    cfg: PipelineConfig,
    store: IndexStore,
    repository: Repository,
    batch_id: int,
    messages: DataFrame | None,
    pages: DataFrame | None,
    predicates: tuple[JobPredicate, ...],
    **options,
) -> Commit | None:
    """``index_batch`` of raw messages and pages. Messages are read once, for their jobs and for those that are malformed."""
    previous = store.ensure().batch
    if previous is not None and batch_id <= previous:
        return None
    with scratch_scope(store.spark, "micro-batch-feeds"):
        usable, broken = read_feed_once(messages, cfg) if messages is not None else (None, None)
        jobs = feed_jobs(cfg, None, pages, predicates, usable)
        states = page_state(pages) if pages is not None else None
        kept = malformed_rows(broken) if broken is not None else None
        return index_batch(cfg, jobs, store, repository, batch_id, page_states=states, malformed=kept, **options)


def run_stream(
    cfg: PipelineConfig,
    store: IndexStore,
    repository: Repository,
    checkpoint: str,
    messages: DataFrame | None = None,
    pages: DataFrame | None = None,
    predicates: tuple[JobPredicate, ...] = (),
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Keep the store's index tables up to date with streams of messages, of harvest pages, or of both in one queue."""
    feeds = {"message": (messages, schemas.MESSAGES), "page": (pages, schemas.HARVEST_PAGES)}
    wrapped = []
    for name, (df, _) in feeds.items():
        if df is not None:
            absent = {n: F.lit(None).cast(StructType.fromDDL(schema)) for n, (_, schema) in feeds.items()}
            row = {**absent, name: F.struct(*df.columns)}
            wrapped.append(df.select(*[value.alias(n) for n, value in row.items()]))

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = {n: batch.where(F.col(n).isNotNull()).select(f"{n}.*") for n, (df, _) in feeds.items() if df is not None}
        _index_feeds(cfg, store, repository, batch_id, rows.get("message"), rows.get("page"), predicates, clock=clock_of(trigger), **options)

    if clock_of(trigger) == WALL:
        wrapped.append(_ticks(store.spark, wrapped[0], TICK_S))
    return _start(union_jobs(*wrapped), step, checkpoint, trigger)
