"""Debounce and ordered apply against the sequential model, on many random scenarios in one run."""

import random

import pytest
from pyspark.sql import functions as F

from model import Index, at, jobs_of, random_messages
from shelfmark import schemas
from shelfmark.config import PipelineConfig
from shelfmark.operators.debounce import settle
from shelfmark.operators.index_tables import IndexTables
from shelfmark.operators.jobs import derive_jobs
from shelfmark.plans.batch import run_jobs
from shelfmark.plans.store import IndexStore
from shelfmark.session import materialize, scratch_dir
from shelfmark.sources.repository import Repository
from shelfmark.streaming.stream import index_batch

SCENARIOS = 400
MESSAGE = "msg_id BIGINT, pid STRING, method_name STRING, dsid STRING, arrival TIMESTAMP_NTZ"


def world(mode, seed):
    rng = random.Random(seed)
    pids = [f"p:{s}" for s in range(SCENARIOS)]
    good = {p for p in pids if rng.random() < 0.7}
    listing = {p: [d for d in "ABD" if rng.random() < 0.6] for p in pids}
    profiled = {(p, d) for p, ds in listing.items() for d in ds}
    with_content = {k for k in sorted(profiled) if rng.random() < 0.8}
    objects = {p: rng.randint(1, 4) for p in pids if rng.random() < 0.4}
    datastreams = {f"{p}:{d}": (p, rng.randint(1, 4)) for p in pids for d in "ABX" if rng.random() < 0.3}
    errors = {}
    for p in pids:
        for d in ["", "A", "B", "X"]:
            if rng.random() < 0.3:
                doc = f"{p}:{d}" if d else p
                errors[doc] = (p, d, f"[UPDATE] [{doc}]", at(-100))
    index = Index(mode, good, {f"{p}:{d}" for p, d in with_content}, listing, objects, datastreams, errors)
    return index, profiled, with_content


def frames(spark, index, profiled, with_content):
    objects = spark.createDataFrame(
        [(p, None, "old", None, None, None, None, p, v) for p, v in index.objects.items()], schemas.OBJECTS
    )
    datastreams = spark.createDataFrame(
        [(p, d[len(p) + 1:], "old", *[None] * 9, None, d, v) for d, (p, v) in index.datastreams.items()], schemas.DATASTREAMS
    )
    errors = spark.createDataFrame(
        [(d, p, ds, job, "old", t) for d, (p, ds, job, t) in index.errors.items()], schemas.ERRORS
    )
    repository = Repository(
        spark.createDataFrame([(p, "A", f"L {p}", "o", at(0), at(0)) for p in sorted(index.good_objects)], schemas.OBJECT_PROFILES),
        spark.createDataFrame(
            [(p, d, "l", "v", at(0), "A", "text/plain", None, "M", 3, "true", *[None] * 5) for p, d in sorted(profiled)],
            schemas.DATASTREAM_PROFILES,
        ),
        spark.createDataFrame(
            [(p, d, 200 if (p, d) in with_content else 404, bytearray(b"abc")) for p, d in sorted(profiled)], schemas.CONTENTS
        ),
    )
    return IndexTables(objects, datastreams, errors), repository


def state(tables):
    objects = {r["doc_id"]: r["_version"] for r in tables.objects.select("doc_id", "_version").collect()}
    datastreams = {
        r["doc_id"]: (r["PID"], r["_version"]) for r in tables.datastreams.select("doc_id", "PID", "_version").collect()
    }
    errors = {r["doc_id"]: (r["PID"], r["DSID"], r["job"], r["timestamp"]) for r in tables.errors.collect()}
    return objects, datastreams, errors


def differences(got, expected):
    return [
        {k: (g.get(k), e.get(k)) for k in sorted({*g, *e}) if g.get(k) != e.get(k)} for g, e in zip(got, expected)
    ]


@pytest.mark.parametrize("mode", ["reference", "corrected"])
def test_settle_matches_the_queue(spark, mode):
    messages = random_messages(SCENARIOS, seed=3)
    expected = sorted(j["seq"] for j in Index(mode).run(jobs_of(messages)).released)
    jobs = derive_jobs(spark.createDataFrame(messages, MESSAGE))
    got = sorted(r["seq"] for r in settle(jobs, mode).select("seq").collect())
    assert got == expected


@pytest.mark.parametrize("mode", ["reference", "corrected"])
def test_batch_matches_the_model(spark, mode):
    index, profiled, with_content = world(mode, seed=11)
    tables, repository = frames(spark, index, profiled, with_content)
    messages = random_messages(SCENARIOS, seed=5)
    feed = materialize(derive_jobs(spark.createDataFrame(messages, MESSAGE)), "feed")
    outcome = run_jobs(PipelineConfig(mode=mode), feed, tables, repository, salts=2)
    index.run(jobs_of(messages))
    assert differences(state(outcome.tables), (index.objects, index.datastreams, index.errors)) == [{}, {}, {}]


@pytest.mark.parametrize("mode", ["reference", "corrected"])
def test_micro_batches_match_the_model(spark, mode):
    index, profiled, with_content = world(mode, seed=12)
    tables, repository = frames(spark, index, profiled, with_content)
    messages = random_messages(SCENARIOS, seed=6)
    store = IndexStore(spark, scratch_dir(spark, "store"), buckets=8)
    store.commit(store.ensure(), {k: (df, None) for k, df in tables.named().items()}, batch=-1)
    cfg = PipelineConfig(mode=mode)
    jobs = materialize(derive_jobs(spark.createDataFrame(messages, MESSAGE)), "jobs")
    cuts = [at(-1), at(4.5), at(11), at(100)]
    for i, (low, high) in enumerate(zip(cuts, cuts[1:])):
        part = jobs.where((F.col("arrival") > F.lit(low).cast("timestamp_ntz")) & (F.col("arrival") <= F.lit(high).cast("timestamp_ntz")))
        assert index_batch(cfg, part, store, repository, i, salts=2) is not None
    # A repeated micro-batch changes nothing.
    assert index_batch(cfg, jobs, store, repository, 1, salts=2) is None
    assert index_batch(cfg, jobs.limit(0), store, repository, 9, final=True, salts=2) is not None
    index.run(jobs_of(messages))
    assert differences(state(store.tables()), (index.objects, index.datastreams, index.errors)) == [{}, {}, {}]
    assert store.read("pending").count() == 0
