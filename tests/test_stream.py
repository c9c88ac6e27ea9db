"""Store, streaming debounce and streaming indexing over files that arrive one by one."""

import pytest
from pyspark.sql import functions as F

from model import Index, at, jobs_of, random_messages
from shelfmark import schemas
from shelfmark.config import JobRule, PipelineConfig
from shelfmark.functions.times import ntz
from shelfmark.operators.jobs import derive_jobs
from shelfmark.plans.store import IndexStore, object_schema
from shelfmark.session import scratch_dir
from shelfmark.sources.messages import read_messages
from shelfmark.sources.pages import read_harvest_pages
from shelfmark.sources.repository import TABLES, Repository
from shelfmark.streaming.stream import debounce_stream, index_batch, released_jobs, run_stream

MESSAGE = "msg_id BIGINT, pid STRING, method_name STRING, dsid STRING, arrival TIMESTAMP_NTZ"


@pytest.mark.parametrize("mode", ["reference", "corrected"])
def test_debounce_stream_equals_the_queue(spark, mode):
    """Several files, one per micro-batch, with a stop in between; what is still waiting at the end stays waiting."""
    messages = random_messages(60, seed=21)
    root = scratch_dir(spark, "stream")
    frame = spark.createDataFrame(messages, MESSAGE)
    store, cfg = IndexStore(spark, f"{root}/store", buckets=4), PipelineConfig(mode=mode)

    def run():
        source = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        debounce_stream(derive_jobs(source), store, f"{root}/checkpoint", cfg).awaitTermination()

    for low, high in [(-1, 3), (3, 8)]:
        part = frame.where((F.col("arrival") > ntz(at(low))) & (F.col("arrival") <= ntz(at(high))))
        part.coalesce(1).write.mode("append").parquet(f"{root}/in")
    run()
    frame.where(F.col("arrival") > ntz(at(8))).coalesce(1).write.mode("append").parquet(f"{root}/in")
    run()
    last = max(m[4] for m in messages)
    expected = sorted(j["seq"] for j in Index(mode).run(jobs_of(messages)).released if j["ready_at"] <= last)
    assert sorted(r["seq"] for r in released_jobs(store).collect()) == expected
    commit = store.newest()
    assert commit.clock == last and commit.batch == 2


def test_store_is_created_once_and_rewrites_touched_buckets_only(spark):
    store = IndexStore(spark, scratch_dir(spark, "store"), buckets=8)
    assert store.newest() is None
    first = store.ensure()
    assert store.ensure() == first and store.read("errors").count() == 0
    rows = [(f"p:{i}", f"p:{i}", "", "j", "m", at(i)) for i in range(40)]
    errors = spark.createDataFrame(rows, schemas.ERRORS)
    second = store.commit(first, {"errors": (errors, None)})
    touched = store.touched(spark.createDataFrame([("p:3",)], "pid string"))
    part = store.read("errors", second, touched).where("PID <> 'p:3'")
    third = store.commit(second, {"errors": (part, touched)})
    assert {b for b, d in third.dirs["errors"].items() if d == third.version} <= touched
    assert store.read("errors").count() == 39 and store.read("errors", second).count() == 40
    assert store.lookup("errors", "p:4").count() == 1 and store.lookup("errors", "p:3").count() == 0


def test_a_version_without_log_entry_stays_invisible(spark):
    store = IndexStore(spark, scratch_dir(spark, "store"), buckets=2)
    first = store.ensure()
    errors = spark.createDataFrame([("p:1", "p:1", "", "j", "m", at(0))], schemas.ERRORS)
    store._write("errors", errors, first.version + 1)  # as if the run had died before its log entry
    assert store.newest() == first and store.read("errors").count() == 0
    store.commit(first, {"errors": (errors, None)})
    assert store.read("errors").count() == 1


def test_object_schema_takes_user_properties(spark):
    schema = object_schema({"PUB_TYPE": {"type": "string"}, "YEAR": {"type": "integer"}, "LABEL": "string"})
    fields = {f.name: f.dataType.simpleString() for f in spark.createDataFrame([], schema).schema}
    assert fields["properties"] == "struct<PUB_TYPE:string,YEAR:int,LABEL:string>" and fields["_dissemination"].endswith("variant>")
    assert fields["LABEL"] == "string" and object_schema() == object_schema({}) == schemas.OBJECTS


def test_messages_and_pages_feed_one_index(spark):
    """Both feeds as streams; typed properties are stored and the harvest state moves with the commit."""
    root = scratch_dir(spark, "both")
    listing = '<OAI-PMH><ListIdentifiers><header><identifier>oai:x:p:1</identifier></header><resumptionToken>t1</resumptionToken></ListIdentifiers></OAI-PMH>'
    body = '<entry><category term="p:2" scheme="fedora-types:pid"/></entry>'
    spark.createDataFrame([(1, "fedora.apim.update", "p:2", "ingest", body, at(0)), (2, "fedora.apim.update", "p:3", "ingest", "<broken", at(9))], schemas.MESSAGES).write.json(f"{root}/messages")
    spark.createDataFrame([("s", 1, at(3), 200, listing)], schemas.HARVEST_PAGES).write.json(f"{root}/pages")
    pids = ["p:1", "p:2"]
    repository = Repository(
        spark.createDataFrame([(p, "A", "label", "o", at(0), at(0)) for p in pids], schemas.OBJECT_PROFILES),
        spark.createDataFrame([("p:1", "DC", "l", "v", at(0), "A", "text/plain", None, "M", 3, "true", *[None] * 5)], schemas.DATASTREAM_PROFILES),
        spark.createDataFrame([("p:1", "DC", 200, bytearray(b"abc"))], schemas.CONTENTS),
        spark.createDataFrame([(p, "s:1", "m", 200, '{"PUB_TYPE": "book", "LABEL": "inner"}') for p in pids], schemas.DISSEMINATIONS),
    )
    cfg = PipelineConfig(mode="corrected", sdef_pid="s:1", method="m", properties={"PUB_TYPE": {"type": "string"}, "LABEL": "string"})
    store = IndexStore(spark, f"{root}/store", buckets=4, properties=cfg.properties)
    feeds = {"messages": read_messages(spark, f"{root}/messages", streaming=True), "pages": read_harvest_pages(spark, f"{root}/pages", streaming=True)}
    run_stream(cfg, store, repository, f"{root}/checkpoint", **feeds).awaitTermination()
    tables = store.tables()
    # A property named like a field of the document disturbs neither.
    objects = {(r["doc_id"], r["properties"]["PUB_TYPE"], r["properties"]["LABEL"], r["LABEL"], r["_version"]) for r in tables.objects.collect()}
    assert objects == {("p:1", "book", "inner", "label", 1), ("p:2", "book", "inner", "label", 1)}
    one = store.tables(store.maintain(rebase_rows=1)).objects.select("properties.PUB_TYPE")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 2 and "ReadSchema: struct<properties:struct<PUB_TYPE:string>>" in plan
    assert {r["doc_id"]: r["CONTENT"]["_content"] for r in tables.datastreams.collect()} == {"p:1:DC": "abc"}
    assert [tuple(r) for r in store.read("last_run").collect()] == [("s", at(3), None, "t1")]
    # The broken ingest still makes an object job, which waits for its time.
    assert tables.errors.count() == 0 and [r["pid"] for r in store.read("pending").collect()] == ["p:3"]


def test_a_failure_without_a_message_is_a_failure(spark):
    """A user-defined kind that fails silently leaves an error row and no document."""
    cfg = PipelineConfig(rules=(JobRule("look", "visit", "UPDATE", True, 0),))

    def note(written):
        fails = F.col("pid") == "p:2"
        return written.withColumns({"doc": F.struct(F.lit("n").alias("note")), "error_message": F.lit(None).cast("string"), "failed": fails})

    repository = Repository(*[spark.createDataFrame([], s) for s in TABLES.values()])
    store = IndexStore(spark, scratch_dir(spark, "silent"), buckets=4, extra={"visit": "note STRING, doc_id STRING, _version BIGINT"})
    rows = [(1, "p:1", "look", "A", at(0)), (2, "p:2", "look", "A", at(0))]
    jobs = derive_jobs(spark.createDataFrame(rows, MESSAGE), cfg.rules)
    index_batch(cfg, jobs, store, repository, 0, final=True, handlers={"visit": note})
    assert [r["doc_id"] for r in store.read("visit").collect()] == ["p:1:A"]
    assert [(r["doc_id"], r["message"]) for r in store.read("errors").collect()] == [("p:2:A", None)]


def test_user_kind_tables_keep_their_rows(spark):
    """Tables of user-defined kinds: routed by PID when they have one, else rewritten whole."""
    root = scratch_dir(spark, "kinds")
    rules = (JobRule("look", "visit", "UPDATE", True, 1), JobRule("forget", "visit", "DELETE", True, 0))
    cfg = PipelineConfig(rules=rules)

    def note(written):
        doc = F.struct(F.concat(F.lit("n "), "doc_id").alias("note"))
        return written.withColumns({"doc": doc, "error_message": F.lit(None).cast("string")})

    repository = Repository(*[spark.createDataFrame([], s) for s in TABLES.values()])
    store = IndexStore(spark, root, buckets=8, extra={"visit": "note STRING, doc_id STRING, _version BIGINT"})
    batches = [
        [(i, f"p:{i}", "look", "A", at(0)) for i in range(12)],
        [(20, "p:3", "look", "A", at(10)), (21, "p:4", "forget", "A", at(11)), (22, "p:5", "look", "B", at(11))],
    ]
    for i, rows in enumerate(batches):
        jobs = derive_jobs(spark.createDataFrame(rows, MESSAGE), rules)
        index_batch(cfg, jobs, store, repository, i, final=True, handlers={"visit": note})
    versions = {r["doc_id"]: r["_version"] for r in store.read("visit").collect()}
    assert versions == {**{f"p:{i}:A": 1 for i in range(12) if i != 4}, "p:3:A": 2, "p:5:B": 1}
    with pytest.raises(ValueError, match="outside the buckets"):
        errors = spark.createDataFrame([(f"p:{i}", f"p:{i}", "", "j", "m", at(i)) for i in range(9)], schemas.ERRORS)
        store.commit(store.newest(), {"errors": (errors, {0})})
