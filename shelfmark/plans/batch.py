"""One pass over a backlog of messages and harvest pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark import schemas
from shelfmark.config import PipelineConfig
from shelfmark.operators.apply import Handler, Outcome, apply_jobs
from shelfmark.operators.debounce import settle
from shelfmark.operators.filters import JobPredicate, filter_jobs, predicates_from_config
from shelfmark.operators.index_tables import IndexTables
from shelfmark.operators.jobs import derive_jobs, jobs_from_identifiers, union_jobs
from shelfmark.session import materialize
from shelfmark.sources import messages as msg
from shelfmark.sources.pages import explode_identifiers
from shelfmark.sources.repository import Repository


def read_feed(messages: DataFrame, cfg: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    """(usable, malformed) of the raw messages that pass the topic, selector and text filters."""
    return msg.split_malformed(_parsed(messages, cfg), cfg.mode, cfg.rules)


def _parsed(messages: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return msg.parse_atom(msg.message_selector(msg.topic_filter(msg.text_messages(messages), cfg.topic_filter), cfg.message_selector))


def read_feed_once(messages: DataFrame, cfg: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    """The same, with the messages read and their bodies parsed a single time: what is left of them is written to the scratch folder.

    Bodies are kept of malformed messages only.
    """
    judged = msg.judge_messages(_parsed(messages, cfg), cfg.mode, cfg.rules)
    body = F.when(F.col("reason").isNotNull(), F.col("body")).alias("body")
    kept = materialize(judged.select("msg_id", "topic", "pid", "method_name", body, "arrival", "dsid", "reason"), "messages")
    return kept.where(F.col("reason").isNull()), kept.where(F.col("reason").isNotNull())


def message_jobs(messages: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Jobs of raw messages: topic, selector and text filters, body parsing, derivation."""
    return derive_jobs(read_feed(messages, cfg)[0], cfg.rules, cfg.delay_unit_s)


def malformed_rows(malformed: DataFrame) -> DataFrame:
    """Malformed messages as they are kept, with the ``reason``."""
    return malformed.select(*StructType.fromDDL(schemas.MALFORMED).fieldNames())


def feed_jobs(
    cfg: PipelineConfig,
    messages: DataFrame | None = None,
    pages: DataFrame | None = None,
    predicates: tuple[JobPredicate, ...] = (),
    usable: DataFrame | None = None,
) -> DataFrame:
    """All jobs of both feeds that pass the configured and the given predicates; ``usable`` are messages whose bodies have been parsed."""
    feeds = []
    if usable is not None:
        feeds.append(derive_jobs(usable, cfg.rules, cfg.delay_unit_s))
    if messages is not None:
        feeds.append(message_jobs(messages, cfg))
    if pages is not None:
        feeds.append(jobs_from_identifiers(explode_identifiers(pages), cfg.mode))
    return filter_jobs(union_jobs(*feeds), *predicates_from_config(cfg), *predicates)


def run_jobs(
    cfg: PipelineConfig,
    feed: DataFrame,
    tables: IndexTables,
    repository: Repository,
    clock=None,
    handlers: dict[str, Handler] | None = None,
    transform=None,
    now=None,
    store: bool = True,
    **spreading,
) -> Outcome:
    """Debounce ``feed`` and carry out the jobs due by ``clock``, or all of them without a clock.

    ``store`` writes shared intermediate rows to the scratch folder so that the table writes do not recompute them.
    """
    keep = materialize if store else (lambda df, name: df)
    settled = keep(settle(feed, cfg.mode, *cfg.delays_s), "settled")
    return apply_jobs(tables, settled, repository, cfg, clock, handlers, transform, now, keep, **spreading)


def run_batch(
    cfg: PipelineConfig,
    tables: IndexTables,
    repository: Repository,
    messages: DataFrame | None = None,
    pages: DataFrame | None = None,
    predicates: tuple[JobPredicate, ...] = (),
    **options,
) -> IndexTables:
    """Index tables after all jobs of a backlog, fan-out included."""
    feed = feed_jobs(cfg, messages, pages, predicates)
    if options.get("store", True):
        feed = materialize(feed, "feed")
    return run_jobs(cfg, feed, tables, repository, **options).tables
