"""Merge on read, commits by one writer, upkeep, postings, retention and malformed messages of the store."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from model import at
from shelfmark import schemas
from shelfmark.config import PipelineConfig
from shelfmark.operators.index_tables import Change
from shelfmark.operators.postings import document_terms
from shelfmark.plans import store as st
from shelfmark.plans.store import ConcurrentWriter, IndexStore
from shelfmark.session import scratch_dir
from shelfmark.sources import messages as msg
from shelfmark.sources.messages import read_messages
from shelfmark.sources.repository import Repository
from shelfmark.streaming import stream
from shelfmark.streaming.stream import index_backlog, run_stream

NOTE = "PID STRING, doc_id STRING, note STRING, _version BIGINT"


def notes(spark, *rows):
    return spark.createDataFrame([(d.split(":")[0], d, n, 1) for d, n in rows], NOTE)


def gone(spark, *documents):
    return spark.createDataFrame([(d.split(":")[0], d) for d in documents], "PID string, doc_id string")


def pids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "PID string")


def content(store, commit=None, buckets=None):
    return {r["doc_id"]: r["note"] for r in store.read("note", commit, buckets).collect()}


def test_random_changes_match_a_dictionary(spark):
    """Upserts, tombstones of documents and of PIDs, with folds and rebases in between; whole, by bucket, and as of earlier commits."""
    rng = random.Random(4)
    store = IndexStore(spark, scratch_dir(spark, "store"), buckets=4, extra={"note": NOTE})
    commit, model, seen, past = store.ensure(), {}, set(), {}
    for step in range(9):
        removed = {f"p{rng.randrange(6)}" for _ in range(rng.randrange(2))}
        dropped = {f"p{rng.randrange(6)}:{rng.randrange(4)}" for _ in range(rng.randrange(3))}
        rows = {f"p{rng.randrange(6)}:{rng.randrange(4)}": f"n{step}-{rng.random()}" for _ in range(rng.randrange(1, 6))}
        model = {d: n for d, n in model.items() if d.split(":")[0] not in removed and d not in dropped} | rows
        change = Change(notes(spark, *rows.items()), gone(spark, *dropped), pids(spark, *removed))
        commit = store.commit(commit, changes={"note": change})
        if step % 3 == 2:
            before = commit
            commit = store.maintain(commit, fold_at=2, rebase_rows=10**9 if step < 6 else 1)
            assert len(commit.deltas["note"]) == (1 if step < 6 else 0) and commit.version == before.version + 1
        past[commit.version] = dict(model)
        seen |= set(rows)
    assert content(store) == model and seen - set(model)
    for version in list(past)[-3:]:
        assert content(store, store.at(version)) == past[version]
    split = [content(store, buckets={b}) for b in range(4)]
    assert sum(map(len, split)) == len(model) and {d: n for part in split for d, n in part.items()} == model
    assert {r["doc_id"] for r in store.lookup("note", "p1").collect()} == {d for d in model if d.startswith("p1:")}


def size(spark, path):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(path)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    summary = fs.getContentSummary(path)
    return summary.getLength(), summary.getFileCount()


def test_a_commit_writes_in_proportion_to_its_changes(spark):
    """1,024 buckets, all of them touched in turn: what is written follows the changes, not buckets or documents."""
    root = scratch_dir(spark, "store")
    store = IndexStore(spark, root, buckets=1024, extra={"note": NOTE})
    many = spark.range(20_000).select(
        F.concat(F.lit("p"), "id").alias("PID"), F.concat(F.lit("p"), "id", F.lit(":1")).alias("doc_id"), F.repeat(F.lit("long text "), 50).alias("note"),
        F.lit(1).cast("bigint").alias("_version"),
    )
    commit = store.commit(store.ensure(), changes={"note": Change(many)})
    whole, _ = size(spark, f"{root}/note")
    written = []
    for n in (10, 1000):
        few = many.limit(0).unionByName(many.where(F.col("PID").isin([f"p{i}" for i in range(n)])).withColumn("note", F.lit("new")))
        before, files = size(spark, f"{root}/note")
        commit = store.commit(commit, changes={"note": Change(few, None, pids(spark, "p19999"))})
        after, more = size(spark, f"{root}/note")
        written.append((after - before, more - files))
        assert not any(commit.dirs["note"].values())  # no bucket was written anew
    assert written[0][0] < whole / 20 and written[1][0] < whole / 5 and max(files for _, files in written) < 30
    assert store.read("note").where("note = 'new'").count() == 1000 and store.read("note").count() == 19_999


def test_of_two_writers_one_fails(spark):
    root = scratch_dir(spark, "store")
    one, other = (IndexStore(spark, root, buckets=2, extra={"note": NOTE}) for _ in range(2))
    start = one.ensure()
    assert other.ensure() == start
    done = one.commit(start, changes={"note": Change(notes(spark, ("p:1", "mine")))}, batch=3)
    with pytest.raises(ConcurrentWriter):
        other.commit(start, changes={"note": Change(notes(spark, ("p:1", "theirs")))}, batch=3)
    assert content(one) == content(other) == {"p:1": "mine"} and other.newest() == done
    assert content(other, other.commit(done, changes={"note": Change(notes(spark, ("p:2", "later")))})) == {"p:1": "mine", "p:2": "later"}


def test_the_log_stays_short_and_old_folders_go(spark):
    root = scratch_dir(spark, "store")
    store = IndexStore(spark, root, buckets=2, extra={"note": NOTE})
    commit = store.ensure()
    for i in range(st.KEEP + 4):
        commit = store.commit(commit, {"note": (notes(spark, ("p:1", f"{i}")), None)})
    assert len(store.logged()) == st.KEEP and store.newest() == commit
    assert len(store.files.names("note/base")) == st.KEEP and not [n for n in store.files.names("log") if n.endswith(".part")]
    assert content(store) == {"p:1": f"{st.KEEP + 3}"}
    assert content(store, store.at(commit.version - st.KEEP + 1)) == {"p:1": "4"}


def test_a_single_delta_of_rows_is_read_as_it_is(spark):
    """Its keys are not sorted to find the newest row of each; with tombstones or a second delta they are."""
    store = IndexStore(spark, scratch_dir(spark, "store"), buckets=4, extra={"note": NOTE})
    planned = lambda: store.read("note")._jdf.queryExecution().executedPlan().toString()
    commit = store.commit(store.ensure(), changes={"note": Change(notes(spark, ("p:1", "a"), ("p:2", "b")))})
    assert "Window" not in planned() and content(store) == {"p:1": "a", "p:2": "b"}
    commit = store.maintain(commit, rebase_rows=1)
    store.commit(commit, changes={"note": Change(notes(spark, ("p:2", "c"), ("p:3", "d")))})
    assert "Window" not in planned() and content(store) == {"p:1": "a", "p:2": "c", "p:3": "d"}
    store.commit(store.newest(), changes={"note": Change(notes(spark, ("p:3", "e")), gone(spark, "p:1"))})
    assert "Window" in planned() and content(store) == {"p:2": "c", "p:3": "e"}


def test_replaced_buckets_keep_what_deltas_say_of_others(spark):
    store = IndexStore(spark, scratch_dir(spark, "store"), buckets=8, extra={"note": NOTE})
    names = [f"p{i}:1" for i in range(12)]
    commit = store.commit(store.ensure(), {"note": (notes(spark, *[(n, "old") for n in names]), None)})
    commit = store.commit(commit, changes={"note": Change(notes(spark, *[(n, "new") for n in names[:6]]))})
    touched = store.touched(spark.createDataFrame([("p0",)], "pid string"))
    part = store.read("note", commit, touched).where("PID <> 'p0'")
    commit = store.commit(commit, {"note": (part, touched)})
    assert content(store) == {n: "new" if n in names[:6] else "old" for n in names[1:]} and not commit.deltas["note"]


def test_errors_expire_by_the_clock_of_the_commits(spark):
    store = IndexStore(spark, scratch_dir(spark, "store"), buckets=4)
    error = lambda name, day: (name, name, "", "j", "m", at(day * 86400))
    frame = lambda *rows: spark.createDataFrame(list(rows), schemas.ERRORS)
    left = lambda: sorted(r["doc_id"] for r in store.read("errors").collect())
    commit = store.commit(store.ensure(), changes={"errors": Change(frame(error("a", 0), error("b", 3)))}, batch=0, clock=at(3 * 86400))
    commit = store.commit(commit, changes={"errors": Change(frame(error("c", 20), error("a", 21)))}, batch=1, clock=at(21 * 86400))
    assert left() == ["a", "b", "c"]
    commit = store.commit(commit, batch=2, clock=at(46 * 86400))  # b is older than six weeks
    assert left() == ["a", "c"] and [d.version for d in commit.deltas["errors"]] == [2]
    commit = store.maintain(commit, rebase_rows=1)
    plan = store._base("errors", commit)._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "day" in plan
    assert left() == ["a", "c"] and not commit.deltas["errors"]
    commit = store.commit(commit, batch=3, clock=at(63 * 86400))  # the moment a's six weeks are over
    assert left() == []


def world(spark, texts):
    """A repository with one datastream ``T`` per object."""
    objects = [(p, "A", f"Label of {p[2:]}", "o", at(0), at(0)) for p in texts]
    streams = [(p, "T", "the text", "v", at(0), "A", "text/plain", None, "M", 3, "true", *[None] * 5) for p in texts]
    contents = [(p, "T", 200, bytearray(t.encode())) for p, t in texts.items()]
    return Repository(
        spark.createDataFrame(objects, schemas.OBJECT_PROFILES), spark.createDataFrame(streams, schemas.DATASTREAM_PROFILES),
        spark.createDataFrame(contents, schemas.CONTENTS),
    )


def test_every_message_is_accounted_for_and_terms_follow(spark):
    """Three runs of one stream: create, update, delete; postings are right after each, broken messages are kept with their reason."""
    root = scratch_dir(spark, "stream")
    store, cfg = IndexStore(spark, f"{root}/store", buckets=16, analysed=True), PipelineConfig(mode="corrected")
    category = '<entry><category term="T" scheme="fedora-types:dsID"/></entry>'
    runs = [
        ([("p:1", "ingest", "<entry/>"), ("p:2", "ingest", "<entry/>"), ("p:9", "modifyDatastreamByValue", "<broken"), (None, "ingest", "<entry/>")], {"p:1": "red green red", "p:2": "blue"}),
        ([("p:1", "modifyDatastreamByValue", category), ("p:2", None, "<entry/>")], {"p:1": "green green yellow", "p:2": "blue"}),
        ([("p:2", "purgeObject", "<entry/>"), ("p:3", "ingest", "<entry/>")], {"p:1": "green green yellow"}),
    ]
    number, terms = 0, []
    for i, (messages, texts) in enumerate(runs):
        rows = [(number + k, "fedora.apim.update", p, m, b, at(100 * i)) for k, (p, m, b) in enumerate(messages)]
        rows.append((number + len(rows), "fedora.apim.update", "p:0", "getObjectXML", "<entry/>", at(100 * i + 50)))
        # Something harmless that moves the clock on.
        rows.append((number + len(rows), "fedora.apim.update", "p:none", "purgeObject", "<entry/>", at(100 * i + 50)))
        number += len(rows)
        spark.createDataFrame(rows, schemas.MESSAGES).coalesce(1).write.mode("append").json(f"{root}/in")
        source = read_messages(spark, f"{root}/in", streaming=True)
        run_stream(cfg, store, world(spark, texts), f"{root}/checkpoint", messages=source).awaitTermination()
        terms.append({(r["field"], r["term"], r["doc_id"]): r["n"] for r in store.read("postings").collect()})
        tables = store.tables()
        rebuilt = document_terms("objects", tables.objects).unionByName(document_terms("datastreams", tables.datastreams))
        assert terms[-1] == {(r["field"], r["term"], r["doc_id"]): r["n"] for r in rebuilt.collect()}
    content = "datastreams.CONTENT"
    assert terms[0][content, "red", "p:1:T"] == 2 and (content, "blue", "p:2:T") in terms[0]
    assert (content, "red", "p:1:T") not in terms[1] and terms[1][content, "green", "p:1:T"] == 2
    assert all(key[2].startswith("p:1") for key in terms[2])
    found = store.lookup("postings", "green")
    assert [tuple(r) for r in found.collect()] == [(content, "green", "p:1:T", 2)]
    malformed = sorted((r["msg_id"], r["reason"]) for r in store.read("malformed").collect())
    assert malformed == [(2, "body is not well-formed"), (3, "no pid"), (7, "no method name")]
    assert {r["doc_id"] for r in store.read("errors").collect()} == {"p:3"}
    # Scratch rows of the micro-batches are gone.
    shared = spark.conf.get("spark.checkpoint.dir")
    jvm = spark.sparkContext._jvm
    here = jvm.org.apache.hadoop.fs.Path(f"{shared}/{spark.sparkContext.applicationId}")
    names = [s.getPath().getName() for s in here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(here)]
    assert not [n for n in names if n.startswith("micro-batch")]


def test_retention_is_a_parameter(spark):
    store = IndexStore(spark, scratch_dir(spark, "store"), buckets=2, retention=dt.timedelta(days=1))
    errors = spark.createDataFrame([("a", "a", "", "j", "m", at(0))], schemas.ERRORS)
    store.commit(store.ensure(), {"errors": (errors, None)}, clock=at(86399))
    assert store.read("errors").count() == 1
    store.commit(store.newest(), clock=at(86401))
    assert store.read("errors").count() == 0


def test_a_backlog_is_one_commit_with_everything_in_it(spark):
    """Messages and pages at once: documents, errors, harvest state, terms and the messages that could not be read."""
    store, cfg = IndexStore(spark, scratch_dir(spark, "backlog"), buckets=4, analysed=True), PipelineConfig(mode="corrected")
    messages = spark.createDataFrame(
        [(0, "fedora.apim.update", "p:1", "ingest", "<entry/>", at(0)), (1, "fedora.apim.update", "p:7", "ingest", "<entry/>", at(1)), (2, "fedora.apim.update", "p:1", "modifyDatastreamByValue", "<", at(2))],
        schemas.MESSAGES,
    )
    listing = "<OAI-PMH><ListIdentifiers><header><identifier>oai:x:p:2</identifier></header></ListIdentifiers></OAI-PMH>"
    pages = spark.createDataFrame([("s", 1, at(3), 200, listing)], schemas.HARVEST_PAGES)
    commit = index_backlog(cfg, store, world(spark, {"p:1": "one", "p:2": "two"}), messages, pages)
    assert commit.version == 1 and commit.batch == 0 and store.read("pending").count() == 0
    assert {r["doc_id"] for r in store.read("datastreams").collect()} == {"p:1:T", "p:2:T"}
    assert [r["doc_id"] for r in store.read("errors").collect()] == ["p:7"] and [r["msg_id"] for r in store.read("malformed").collect()] == [2]
    assert [r["source"] for r in store.read("last_run").collect()] == ["s"] and store.lookup("postings", "two").count() == 1


def test_bodies_are_parsed_once_and_versions_looked_up_once(spark, monkeypatch):
    """Jobs and malformed messages come from one parse; the written rows, on which errors and terms depend, from one look-up."""
    calls, outcomes, parse, run = [], [], msg.parse_atom, stream.run_jobs

    def counted(messages):
        calls.append(messages)
        return parse(messages)

    def seen(*args, **options):
        outcome = run(*args, **options)
        plans = [outcome.changes[t].rows._jdf.queryExecution().executedPlan().toString() for t in ("objects", "datastreams")]
        outcomes.append("Join" in "".join(plans))
        return outcome

    monkeypatch.setattr(msg, "parse_atom", counted)
    monkeypatch.setattr(stream, "run_jobs", seen)
    store, cfg = IndexStore(spark, scratch_dir(spark, "once"), buckets=4, analysed=True), PipelineConfig(mode="corrected")
    bodies = [("p:1", "ingest", "<entry/>"), ("p:2", "modifyDatastreamByValue", "<"), (None, "ingest", "<entry/>"), ("p:2", "ingest", "<")]
    rows = [(i, "fedora.apim.update", p, m, b, at(i)) for i, (p, m, b) in enumerate(bodies)]
    index_backlog(cfg, store, world(spark, {"p:1": "one", "p:2": "two"}), spark.createDataFrame(rows, schemas.MESSAGES))
    assert len(calls) == 1 and outcomes == [False]
    malformed = sorted((r["msg_id"], r["topic"], r["body"], r["reason"]) for r in store.read("malformed").collect())
    assert malformed == [(1, "fedora.apim.update", "<", "body is not well-formed"), (2, "fedora.apim.update", "<entry/>", "no pid")]
    assert {(r["doc_id"], r["_version"]) for r in store.read("datastreams").collect()} == {("p:1:T", 1), ("p:2:T", 1)}
    assert {r["doc_id"] for r in store.read("postings").where("term = 'two'").collect()} == {"p:2:T"}
