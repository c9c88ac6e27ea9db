"""Job predicates: functions of no argument that give a boolean column over job rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.config import PipelineConfig

JobPredicate = Callable[[], Column]


def match_pid(pattern: str) -> JobPredicate:
    """The whole pid must match."""
    return lambda: F.col("pid").rlike(rf"\A(?:{pattern})\z")


def exclude_datastreams(ids: Iterable[str]) -> JobPredicate:
    """Drop datastream jobs of the listed ids; object jobs pass."""
    return lambda: ~((F.col("kind") == "datastream") & F.col("dsid").isin(list(ids)))


def relevant_datastreams(ids: Iterable[str]) -> JobPredicate:
    """Object jobs that come from a datastream pass only when it is listed; all other jobs pass."""
    return lambda: (F.col("kind") != "object") | (F.col("dsid") == "") | F.col("dsid").isin(list(ids))


def filter_jobs(jobs: DataFrame, *predicates: JobPredicate) -> DataFrame:
    """Jobs for which every predicate holds; all jobs without predicates. Belongs before ``debounce``."""
    if not predicates:
        return jobs
    return jobs.where(reduce(lambda a, b: a & b, (p() for p in predicates)))


def predicates_from_config(cfg: PipelineConfig) -> list[JobPredicate]:
    """Only the predicates the configuration asks for."""
    predicates: list[JobPredicate] = []
    if cfg.pid_match:
        predicates.append(match_pid(cfg.pid_match))
    if cfg.exclude_datastreams:
        predicates.append(exclude_datastreams(cfg.exclude_datastreams))
    if cfg.relevant_datastreams:
        predicates.append(relevant_datastreams(cfg.relevant_datastreams))
    return predicates
