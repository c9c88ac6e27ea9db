"""One query per operator, each over whole tables, with its SQL counterpart."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.config import DEFAULT_RULES, JobRule
from shelfmark.functions import ids, times
from shelfmark.functions.text import extract_text
from shelfmark.operators import debounce as db
from shelfmark.operators import documents as docs
from shelfmark.operators import filters, harvest, index_tables, jobs, postings
from shelfmark.operators.apply import build_datastream_docs
from shelfmark.operators.index_tables import IndexTables
from shelfmark.plans.batch import run_batch, run_jobs
from shelfmark.plans.store import IndexStore
from shelfmark.session import empty_frame, materialize, scratch_dir
from shelfmark.sources import messages as msg
from shelfmark.sources import pages
from shelfmark.streaming import stream
from workload import adapters as ad
from workload import oracles as sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

NOW = "2002-06-01"
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DAYS = {"min_delay_s": ad.DAY_S, "max_delay_s": 5 * ad.DAY_S}
UPDATES_ONLY = "methodName LIKE 'modify%' OR methodName LIKE 'add%' OR methodName LIKE 'purge%' OR methodName = 'ingest'"


def seq_number() -> Column:
    """The order key as one number, as the SQL counterparts have it: below 16 jobs a message, fan-outs after all others."""
    seq = F.col("seq")
    return seq["generation"].cast("bigint") * (1 << 62) + seq["number"] * 16 + seq["position"]


def numbered(fn: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = fn(spark, sf)
        return df.withColumn("seq", seq_number()) if "seq" in df.columns and "struct" in dict(df.dtypes)["seq"] else df

    return run


def query(name: str, oracle: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = numbered(fn)
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def feed(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.derive_jobs(ad.messages(spark, sf), delay_unit_s=ad.DAY_S)


def settled(spark: SparkSession, sf: str, mode: str = "reference") -> DataFrame:
    return db.settle(feed(spark, sf), mode, **DAYS)


def by_mode(make: Callable[[str], DataFrame]) -> DataFrame:
    frames = [make(m).select(F.lit(m).alias("mode"), "*") for m in ("reference", "corrected")]
    return frames[0].unionByName(frames[1])


# Messages


@query(
    "topic_and_selector",
    f"WITH {sql.MESSAGES} SELECT msg_id, pid, method_name FROM messages WHERE method_name <> 'getObjectXML'",
)
def topic_and_selector(spark, sf):
    on_topic = msg.topic_filter(ad.messages(spark, sf), "fedora.*.update")
    return msg.message_selector(on_topic, UPDATES_ONLY).select("msg_id", "pid", "method_name")


@query(
    "landed_messages",
    f"WITH {sql.MESSAGES} SELECT msg_id, topic, pid, method_name, arrival FROM (SELECT *, "
    "CASE WHEN method_name = 'getObjectXML' THEN 'fedora.apim.access' ELSE 'fedora.apim.update' END AS topic FROM messages) WHERE method_name <> 'purgeObject'",
)
def landed_messages(spark, sf):
    """Messages written as they land and read through their reader; those without a text body are left out."""
    path = scratch_dir(spark, "landed-messages")
    raw = ad.with_bodies(ad.messages(spark, sf))
    bare = raw.withColumn("body", F.when(F.col("method_name") != "purgeObject", F.col("body")))
    bare.write.option("timestampNTZFormat", MICROSECONDS).json(path)
    return msg.read_messages(spark, path).select("msg_id", "topic", "pid", "method_name", "arrival")


@query(
    "atom_dsid",
    f"""WITH {sql.MESSAGES} SELECT msg_id, CASE WHEN method_name LIKE '%Datastream%' THEN raw_dsid ELSE '' END AS dsid
    FROM messages WHERE msg_id % 97 <> 0""",
)
def atom_dsid(spark, sf):
    plain = ad.spread(ad.messages(spark, sf), "msg_id")
    usable, _ = msg.split_malformed(msg.parse_atom(ad.with_bodies(plain, damage=True)))
    return usable.select("msg_id", "dsid")


@query(
    "atom_malformed",
    f"""WITH {sql.MESSAGES} SELECT 'reference' AS mode, msg_id FROM messages WHERE msg_id % 97 = 0
    UNION ALL SELECT 'corrected', msg_id FROM messages WHERE msg_id % 97 = 0
      AND method_name NOT IN ('ingest', 'purgeObject', 'modifyObject')""",
)
def atom_malformed(spark, sf):
    parsed = msg.parse_atom(ad.with_bodies(ad.messages(spark, sf), damage=True))
    return by_mode(lambda m: msg.split_malformed(parsed, m)[1].select("msg_id"))


# Harvest


def harvest_pages(spark, sf):
    return ad.harvest_pages(ad.table(spark, sf, "documents"))


@query("oai_identifiers", sql.OAI_IDENTIFIERS)
def oai_identifiers(spark, sf):
    return pages.explode_identifiers(harvest_pages(spark, sf)).select("source", "page_no", "identifier", "deleted")


@query("landed_pages", sql.OAI_IDENTIFIERS)
def landed_pages(spark, sf):
    """The same pages written as they land and read through their reader."""
    path = scratch_dir(spark, "landed-pages")
    harvest_pages(spark, sf).write.option("timestampNTZFormat", MICROSECONDS).json(path)
    return pages.explode_identifiers(pages.read_harvest_pages(spark, path)).select("source", "page_no", "identifier", "deleted")


@query("oai_local_id", sql.OAI_LOCAL_ID)
def oai_local_id(spark, sf):
    return pages.explode_identifiers(harvest_pages(spark, sf)).select("identifier", "pid")


@query("oai_resume_state", sql.OAI_STATE)
def oai_resume_state(spark, sf):
    return pages.page_state(harvest_pages(spark, sf)).select(
        "source", "page_no", "failed", "resumption_token", "expiration_date"
    )


def last_run(spark, sf):
    return harvest.load_last_run(ad.last_run_raw(ad.table(spark, sf, "orders")))


@query("harvest_plan", sql.HARVEST_PLAN)
def harvest_plan(spark, sf):
    state = last_run(spark, sf)
    sources = ad.table(spark, sf, "customer").select(F.concat(F.lit("cust:"), F.col("c_custkey")).alias("source"))
    return by_mode(lambda m: harvest.plan_harvest(state, NOW, m, sources))


@query("harvest_next_run", sql.NEXT_RUN)
def harvest_next_run(spark, sf):
    return harvest.next_run_at(last_run(spark, sf), "2001-03-01", 300)


@query("last_run_merge", sql.MERGE)
def last_run_merge(spark, sf):
    state = last_run(spark, sf).withColumn("k", F.substring("source", 6, 20).cast("bigint"))
    new = state.where(F.col("k") % 3 != 1).select(
        "source",
        times.plus_seconds(times.ntz(NOW), F.col("k")).alias("request_at"),
        (F.col("k") % 5 == 0).alias("failed"),
        F.when(F.col("k") % 4 == 1, F.concat(F.lit("next:"), F.col("k"))).otherwise("").alias("resumption_token"),
        F.when(F.col("k") % 4 == 1, times.plus_seconds(times.ntz(NOW), ad.DAY_S)).alias("expiration_date"),
    )
    old = state.where(F.col("k") % 3 != 0).drop("k")
    return by_mode(lambda m: harvest.save_last_run(old, new, m))


@query("changed_since", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'")
def changed_since(spark, sf):
    return harvest.changed_since(ad.table(spark, sf, "orders"), "o_orderdate", "2000-01-01").select("o_orderkey", "o_orderdate")


@query("changed_since_plan", sql.CHANGED_SINCE_PLAN)
def changed_since_plan(spark, sf):
    orders = ad.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", F.concat(F.lit("cust:"), F.col("o_custkey")).alias("source")
    )
    plan = harvest.plan_harvest(last_run(spark, sf), NOW, "corrected")
    return harvest.changed_since(orders, "o_orderdate", plan).select("o_orderkey", "o_orderdate")


# Jobs


@query("derive_jobs", f"WITH {sql.JOBS} SELECT {sql.JOB_COLUMNS} FROM jobs")
def derive_jobs(spark, sf):
    return feed(spark, sf)


@query("job_ids_labels", f"WITH {sql.JOBS} SELECT seq, doc_id, '[' || op || '] [' || doc_id || ']' AS job FROM jobs")
def job_ids_labels(spark, sf):
    return feed(spark, sf).select("seq", "doc_id", ids.job_label(F.col("op"), F.col("doc_id")).alias("job"))


@query("union_feeds", sql.UNION_FEEDS)
def union_feeds(spark, sf):
    listed = jobs.jobs_from_identifiers(pages.explode_identifiers(harvest_pages(spark, sf)))
    seq = F.col("seq")
    return jobs.union_jobs(feed(spark, sf), listed).select(
        *[c for c in schemas.JOB_COLUMNS if c != "seq"], seq["generation"].alias("generation"), seq["feed"].alias("feed"),
        seq["source"].alias("source"), seq["number"].alias("number"), seq["position"].alias("position"),
    )


@query("fan_out", sql.FAN_OUT)
def fan_out(spark, sf):
    repository = ad.repository(spark, sf)
    created = settled(spark, sf).where((F.col("kind") == "object") & (F.col("op") == "CREATE"))
    good, _ = docs.split_failures(docs.build_objects(created, repository.object_profiles))
    return jobs.fan_out(good, repository.listing).select("pid", "dsid", "doc_id", "arrival", "seq")


@query("fan_out_large", sql.FAN_OUT_LARGE)
def fan_out_large(spark, sf):
    parents = jobs.with_identity(ad.large_parents(ad.table(spark, sf, "orders")))
    listing = ad.large_listing(ad.table(spark, sf, "lineitem"))
    return jobs.fan_out(parents, listing).select("pid", "dsid", "doc_id", "arrival")


@query("fan_out_counted", sql.FAN_OUT_COUNTED)
def fan_out_counted(spark, sf):
    """Every order is created as often as it has line items; one row per datastream all the same."""
    lineitem = ad.table(spark, sf, "lineitem")
    counted = jobs.fan_out_counted(jobs.with_identity(ad.repeated_parents(lineitem)), ad.large_listing(lineitem))
    return counted.select("doc_id", "n", F.col("last.arrival").alias("last_arrival"), F.col("last.seq.position").alias("last_position"))


# Filters

EVEN_PIDS = r"conv:\d*[02468]"


def filtered(*predicates):
    return lambda spark, sf: filters.filter_jobs(feed(spark, sf), *predicates).select("seq", "kind", "op", "pid", "dsid")


EVEN_SQL = r"regexp_full_match(pid, 'conv:\d*[02468]')"
EXCLUDE_SQL = "NOT (kind = 'datastream' AND dsid IN ('T0', 'T2'))"
RELEVANT_SQL = "(kind <> 'object' OR dsid = '' OR dsid IN ('T1'))"
query("filter_pid", sql.jobs_where(EVEN_SQL))(filtered(filters.match_pid(EVEN_PIDS)))
query("filter_exclude", sql.jobs_where(EXCLUDE_SQL))(filtered(filters.exclude_datastreams(["T0", "T2"])))
query("filter_relevant", sql.jobs_where(RELEVANT_SQL))(filtered(filters.relevant_datastreams(["T1"])))


@query("filter_all", sql.jobs_where(f"{EVEN_SQL} AND {EXCLUDE_SQL} AND {RELEVANT_SQL}"))
def filter_all(spark, sf):
    cfg = ad.config(pid_match=EVEN_PIDS, exclude_datastreams=("T0", "T2"), relevant_datastreams=("T1",))
    return filtered(*filters.predicates_from_config(cfg))(spark, sf)


@query("user_predicate", sql.jobs_where("op = 'DELETE' OR seq % 3 = 0"))
def user_predicate(spark, sf):
    return filtered(lambda: (F.col("op") == "DELETE") | (seq_number() % 3 == 0))(spark, sf)


# Debounce


@query("keep_latest", sql.KEEP_LATEST)
def keep_latest(spark, sf):
    return db.keep_latest(feed(spark, sf))


def _settled_sql(mode, condition="true", tail=""):
    return f"WITH {sql.JOBS},{sql.settled(mode)} SELECT {sql.JOB_COLUMNS} FROM settled WHERE {condition} {tail}"


query("debounce_reference", _settled_sql("reference"))(partial(settled, mode="reference"))
query("debounce_corrected", _settled_sql("corrected"))(partial(settled, mode="corrected"))


@query("due_jobs", _settled_sql("reference", "ready_at <= TIMESTAMP '2024-01-15'"))
def due_jobs(spark, sf):
    return db.due(settled(spark, sf), "2024-01-15")


@query("next_jobs", _settled_sql("reference", tail="ORDER BY ready_at, seq LIMIT 25"))
def next_jobs(spark, sf):
    return db.next_jobs(settled(spark, sf), 25)


def event_stream(spark, sf):
    """The event table as a stream; the glob makes a single file as readable as a folder of files."""
    schema = ad.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf}/event[s].parquet")


@query("debounce_stream", _settled_sql("reference", "ready_at <= (SELECT max(arrival) FROM jobs)"))
def debounce_stream(spark, sf):
    root = scratch_dir(spark, "debounce")
    store = IndexStore(spark, f"{root}/store", buckets=8)
    arriving = jobs.derive_jobs(ad.messages_from_events(event_stream(spark, sf)), delay_unit_s=ad.DAY_S)
    stream.debounce_stream(arriving, store, f"{root}/checkpoint", ad.config()).awaitTermination()
    return stream.released_jobs(store)


# Documents


def wanted_streams(spark, sf):
    upserts = settled(spark, sf).where((F.col("kind") == "datastream") & (F.col("op") != "DELETE"))
    return upserts.select("pid", "dsid", "doc_id").distinct()


@query("object_docs", sql.OBJECT_DOCS)
def object_docs(spark, sf):
    upserts = settled(spark, sf).where((F.col("kind") == "object") & (F.col("op") != "DELETE"))
    good, _ = docs.split_failures(docs.build_objects(upserts, ad.repository(spark, sf).object_profiles))
    return good.select(
        "seq", "pid", F.col("doc.STATE").alias("state"), F.col("doc.LABEL").alias("label"),
        F.col("doc.OWNER_ID").alias("owner_id"), F.col("doc.CREATED_DATE").alias("create_date"),
        F.col("doc.LAST_MODIFIED_DATE").alias("last_modified_date"),
    )


@query("object_failures", sql.OBJECT_FAILURES)
def object_failures(spark, sf):
    upserts = settled(spark, sf).where((F.col("kind") == "object") & (F.col("op") != "DELETE"))
    _, bad = docs.split_failures(docs.build_objects(upserts, ad.repository(spark, sf).object_profiles))
    return bad.select("seq", "pid", "error_message")


@query("datastream_docs", sql.DATASTREAM_DOCS)
def datastream_docs(spark, sf):
    built = docs.build_datastreams(wanted_streams(spark, sf), ad.repository(spark, sf).datastream_profiles)
    return docs.split_failures(built)[0].select(
        "doc_id", "dsid", F.col("doc.LABEL").alias("label"), F.col("doc.CREATED_DATE").alias("created"),
        F.col("doc.SIZE").alias("size"), F.col("doc.VERSIONABLE").alias("versionable"),
    )


@query("content_docs", sql.CONTENT_DOCS)
def content_docs(spark, sf):
    built = build_datastream_docs(wanted_streams(spark, sf), ad.repository(spark, sf))
    good = F.col("error_message").isNull()
    known = F.col("doc.PID").isNotNull()
    return built.select(
        "doc_id", F.when(known, F.col("doc.CONTENT._uri")).alias("uri"),
        F.when(good, F.col("doc.CONTENT._content")).alias("content"), "error_message",
    )


@query("extract_text", sql.EXTRACT_TEXT)
def extract_page_text(spark, sf):
    html = ad.spread(ad.table(spark, sf, "pages"), "page_id")
    return html.select("page_id", extract_text(F.col("html"), F.lit("text/html"), decoded=True).alias("content"))


@query("extract_xml_text", sql.XML_TEXT)
def extract_xml_text(spark, sf):
    bodies = ad.with_bodies(ad.spread(ad.messages(spark, sf), "msg_id"))
    return bodies.select("msg_id", extract_text(F.col("body"), F.lit("text/xml"), decoded=True).alias("content"))


def disseminated(spark, sf, transform=None):
    repository = ad.repository(spark, sf)
    pids = ad.table(spark, sf, "events").select(F.concat(F.lit("conv:"), F.col("user_id")).alias("pid")).distinct()
    built = docs.build_objects(pids, repository.object_profiles)
    return docs.attach_dissemination(built, repository.disseminations, "demo:SDef", "getIndexDocument", transform)


@query("dissemination_docs", sql.DISSEMINATION_DOCS)
def dissemination_docs(spark, sf):
    good = F.col("error_message").isNull()
    return disseminated(spark, sf).select(
        "pid", F.when(good, F.col("doc._dissemination._sdef_pid")).alias("sdef"),
        F.when(good, F.try_variant_get("doc._dissemination._content", "$.k", "bigint")).alias("k"), "error_message",
    )


@query("typed_properties", sql.TYPED_PROPERTIES)
def typed_properties(spark, sf):
    good, _ = docs.split_failures(disseminated(spark, sf))
    flat = good.select("pid", F.col("doc._dissemination._content").alias("json"))
    numbers = docs.typed_properties(flat, {"k": {"type": "long"}, "missing": {"type": "string"}}, "json")
    texts = docs.typed_properties(flat, {"k": {"type": "string"}}, "json").select("pid", F.col("k").alias("k_text"))
    return numbers.join(texts, "pid").select("pid", "k", "k_text", "missing")


@query("user_transform", sql.USER_TRANSFORM)
def user_transform(spark, sf):
    events = ad.table(spark, sf, "events")
    counts = events.groupBy(F.concat(F.lit("conv:"), F.col("user_id")).alias("pid")).agg(F.count(F.lit(1)).alias("n"))

    def count_events(objects: DataFrame) -> DataFrame:
        return objects.select("pid").join(counts, "pid").select(
            "pid", F.lit(200).alias("status"), F.to_json(F.struct("n")).alias("json")
        )

    profiles = ad.repository(spark, sf).object_profiles
    built = docs.build_objects(profiles.select("pid"), profiles)
    attached = docs.attach_dissemination(built, None, "demo:SDef", "countEvents", count_events)
    return attached.select("pid", F.try_variant_get("doc._dissemination._content", "$.n", "bigint").alias("events"))


# Index tables


@query("upsert_docs", sql.UPSERT)
def upsert_docs(spark, sf):
    current, repository = ad.seed_tables(spark, sf).datastreams, ad.repository(spark, sf)
    built = build_datastream_docs(repository.listing.withColumn("doc_id", F.concat_ws(":", "pid", "dsid")), repository)
    changes = docs.split_failures(built)[0].select("doc.*", "doc_id")
    table, result = index_tables.upsert(current, changes)
    return table.join(result.select("doc_id", "created"), "doc_id", "left").select(
        "doc_id", F.col("LABEL").alias("label"), F.col("_version").alias("version"), "created"
    )


def ids_of(tables: IndexTables, *names: str) -> DataFrame:
    named = tables.named()
    frames = [named[n].select(F.lit(n).alias("tbl"), "doc_id") for n in names]
    return jobs.union_jobs(*frames)


@query("delete_cascade", sql.DELETE_CASCADE)
def delete_cascade(spark, sf):
    pids = feed(spark, sf).where((F.col("kind") == "object") & (F.col("op") == "DELETE")).select("pid")
    return ids_of(index_tables.delete_cascade(ad.seed_tables(spark, sf), pids), "objects", "datastreams", "errors")


@query("delete_datastreams", sql.DELETE_DATASTREAMS)
def delete_datastreams(spark, sf):
    keys = feed(spark, sf).where((F.col("kind") == "datastream") & (F.col("op") == "DELETE")).select("doc_id")
    tables = ad.seed_tables(spark, sf)
    return by_mode(lambda m: ids_of(index_tables.delete_datastreams(tables, keys, m), "datastreams", "errors"))


@query("clear_errors", sql.CLEAR_ERRORS)
def clear_errors(spark, sf):
    tables, repository = ad.seed_tables(spark, sf), ad.repository(spark, sf)
    objects = repository.object_profiles.select(
        F.lit("object").alias("kind"), F.col("pid").alias("doc_id"), F.lit(False).alias("created")
    )
    streams = repository.listing.select(F.concat_ws(":", "pid", "dsid").alias("doc_id")).join(
        tables.datastreams.select("doc_id", F.lit(False).alias("_new")), "doc_id", "left"
    ).select(F.lit("datastream").alias("kind"), "doc_id", F.coalesce("_new", F.lit(True)).alias("created"))
    succeeded = objects.unionByName(streams)
    return by_mode(lambda m: index_tables.clear_errors(tables.errors, succeeded, m).select("doc_id"))


def flat_errors(errors: DataFrame) -> DataFrame:
    return errors.select(
        "doc_id", F.col("PID").alias("pid"), F.col("DSID").alias("dsid"), "job", "message", F.col("timestamp").alias("at_time")
    )


@query("write_errors", sql.WRITE_ERRORS)
def write_errors(spark, sf):
    upserts = settled(spark, sf).where((F.col("kind") == "object") & (F.col("op") != "DELETE"))
    _, bad = docs.split_failures(docs.build_objects(upserts, ad.repository(spark, sf).object_profiles))
    return flat_errors(index_tables.write_errors(ad.seed_errors(spark, sf), bad))


@query("expire_errors", sql.EXPIRE_ERRORS)
def expire_errors(spark, sf):
    return index_tables.expire_errors(ad.seed_errors(spark, sf), "2024-01-20").select("doc_id", F.col("timestamp").alias("at_time"))


def flat_tables(tables: IndexTables) -> DataFrame:
    """All index rows in one shape: ``tbl, doc_id, version, detail, at_time``."""
    no_time, no_version = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("bigint")
    label = [F.col("_version").alias("version"), F.col("LABEL").alias("detail"), no_time.alias("at_time")]
    error = [no_version.alias("version"), F.concat_ws(" ", "job", "message").alias("detail"), F.col("timestamp").alias("at_time")]
    parts = {"objects": (tables.objects, label), "datastreams": (tables.datastreams, label), "errors": (tables.errors, error)}
    return jobs.union_jobs(*[df.select(F.lit(n).alias("tbl"), "doc_id", *cols) for n, (df, cols) in parts.items()])


def applied(spark, sf, mode):
    tables = run_jobs(ad.config(mode), materialize(feed(spark, sf), "feed"), ad.seed_tables(spark, sf), ad.repository(spark, sf)).tables
    return flat_tables(tables)


query("apply_reference", sql.apply_sql("reference"))(partial(applied, mode="reference"))
query("apply_corrected", sql.apply_sql("corrected"))(partial(applied, mode="corrected"))


def empty_tables(spark: SparkSession) -> IndexTables:
    return IndexStore(spark, scratch_dir(spark, "empty")).tables()


@query("index_events", sql.apply_sql("corrected", sql.NO_SEEDS))
def index_events(spark, sf):
    """From message bodies to the finished index, starting from nothing."""
    raw = ad.with_bodies(ad.spread(ad.messages(spark, sf), "msg_id"))
    cfg = ad.config("corrected", message_selector=UPDATES_ONLY, topic_filter="fedora.apim.>")
    return flat_tables(run_batch(cfg, empty_tables(spark), ad.repository(spark, sf), messages=raw))


@query("restart_idempotent", sql.apply_sql("reference", sql.NO_SEEDS))
def restart_idempotent(spark, sf):
    """The stream of messages indexed into a store, restarted, repeated and brought to its end."""
    root = scratch_dir(spark, "restart")
    store, cfg, repository = IndexStore(spark, f"{root}/store", buckets=8), ad.config(), ad.repository(spark, sf)
    raw = ad.with_bodies(ad.messages_from_events(event_stream(spark, sf)))
    for _ in range(2):  # the second run finds nothing new behind its checkpoint
        stream.run_stream(cfg, store, repository, f"{root}/checkpoint", messages=raw).awaitTermination()
    stream.index_batch(cfg, feed(spark, sf), store, repository, batch_id=0)  # committed before, hence skipped
    stream.index_batch(cfg, feed(spark, sf).limit(0), store, repository, batch_id=1, final=True)
    return flat_tables(store.tables())


def streamed(spark, sf, **options) -> IndexStore:
    """A store after a stream that landed in four parts, each indexed by a run of its own, and what was still waiting in the end.

    Some bodies are damaged. The parts are days of the feed; messages are read from the files they landed in.
    """
    root, cfg, repository = scratch_dir(spark, "streamed"), ad.config(), ad.repository(spark, sf)
    store = IndexStore(spark, f"{root}/store", buckets=8, **options)
    raw = ad.with_bodies(ad.messages(spark, sf), damage=True)
    first, last = raw.agg(F.min("arrival"), F.max("arrival")).first()
    cuts = [first + (last - first) * k / STREAM_PARTS for k in range(STREAM_PARTS + 1)]
    for k, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
        since = F.col("arrival") > times.ntz(low) if k else F.lit(True)
        raw.where(since & (F.col("arrival") <= times.ntz(high))).write.mode("append").option("timestampNTZFormat", MICROSECONDS).json(f"{root}/in")
        arriving = msg.read_messages(spark, f"{root}/in", streaming=True)
        stream.run_stream(cfg, store, repository, f"{root}/checkpoint", messages=arriving).awaitTermination()
    stream.index_batch(cfg, feed(spark, sf).limit(0), store, repository, batch_id=STREAM_PARTS, final=True)
    return store


STREAM_PARTS = 4


@query("stream_batches", sql.STREAM_BATCHES)
def stream_batches(spark, sf):
    """Where every message of several micro-batches went: the index, error rows that are not too old, and the malformed ones."""
    store = streamed(spark, sf, retention=dt.timedelta(days=sql.RETENTION_DAYS))
    kept = store.read("malformed").select(
        F.lit("malformed").alias("tbl"), F.col("msg_id").cast("string").alias("doc_id"), F.lit(None).cast("bigint").alias("version"),
        F.col("reason").alias("detail"), F.col("arrival").alias("at_time"),
    )
    return flat_tables(store.tables()).unionByName(kept)


@query("stream_postings", sql.STREAM_POSTINGS)
def stream_postings(spark, sf):
    """Search terms as several micro-batches leave them, documents updated and removed meanwhile."""
    return streamed(spark, sf, analysed=True).read("postings")


@query("custom_kind", sql.CUSTOM_KIND)
def custom_kind(spark, sf):
    """A user-defined kind beside the built-in ones, all of the feed in one run."""
    cfg = ad.config("corrected", rules=(JobRule("getObjectXML", "access", "UPDATE", False, 1), *DEFAULT_RULES))
    every = materialize(jobs.derive_jobs(ad.messages(spark, sf), cfg.rules, ad.DAY_S), "feed")

    def note(written: DataFrame) -> DataFrame:
        return written.withColumns(
            {
                "doc": F.struct(F.concat(F.lit("seen "), F.col("pid")).alias("note")),
                "error_message": F.lit(None).cast("string"),
            }
        )

    empty = empty_tables(spark)
    access = empty_frame(spark, "note STRING, doc_id STRING, _version BIGINT")
    tables = IndexTables(empty.objects, empty.datastreams, empty.errors, {"access": access})
    after = run_jobs(cfg, every, tables, ad.repository(spark, sf), handlers={"access": note}).tables
    visits = after.extra["access"].select(
        F.lit("access").alias("tbl"), "doc_id", F.col("_version").alias("version"), F.col("note").alias("detail"), F.lit(None).cast("timestamp_ntz").alias("at_time")
    )
    return flat_tables(after).unionByName(visits)


def stored_conversations(spark, sf) -> IndexStore:
    """A store filled with every conversation as an object and every turn as a datastream."""
    repository = ad.repository(spark, sf)
    none = F.lit(None).cast("struct<_sdef_pid: string, _method: string, _content: variant>")
    one = F.lit(1).cast("bigint").alias("_version")
    objects = docs.build_objects(repository.object_profiles.select("pid"), repository.object_profiles).select(
        "doc.*", none.alias("_dissemination"), F.col("pid").alias("doc_id"), one
    )
    built = build_datastream_docs(repository.listing.withColumn("doc_id", F.concat_ws(":", "pid", "dsid")), repository)
    streams = docs.split_failures(built)[0].select("doc.*", "doc_id", one)
    store = IndexStore(spark, scratch_dir(spark, "conversations"), buckets=16)
    store.commit(store.ensure(), {"objects": (objects, None), "datastreams": (streams, None)})
    return store


STORED = "conversations WHERE (conv_id + turn) % 13 <> 0"


@query(
    "bootstrap_tables",
    f"""SELECT 'objects' AS tbl, count(DISTINCT conv_id) AS n FROM conversations
    UNION ALL SELECT 'datastreams', count(*) FROM {STORED} UNION ALL SELECT 'errors', 0""",
)
def bootstrap_tables(spark, sf):
    tables = stored_conversations(spark, sf).tables().named()
    return jobs.union_jobs(
        *[df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n") for name, df in tables.items()]
    )


@query(
    "routing_buckets",
    f"""SELECT 'conv:' || conv_id AS pid, count(*) + 1 AS n_docs, 1 AS n_buckets FROM {STORED} GROUP BY conv_id
    UNION ALL SELECT 'conv:' || conv_id, 1, 1 FROM conversations GROUP BY conv_id
      HAVING count(*) FILTER (WHERE (conv_id + turn) % 13 <> 0) = 0""",
)
def routing_buckets(spark, sf):
    """Objects and their datastreams lie in the same bucket: the bucket is read from the files' folders."""
    tables = stored_conversations(spark, sf).tables()
    folder = F.regexp_extract(F.input_file_name(), r"pid_bucket=(\d+)", 1)
    rows = [df.select(F.col("PID").alias("pid"), folder.alias("bucket")) for df in (tables.objects, tables.datastreams)]
    return rows[0].unionByName(rows[1]).groupBy("pid").agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_distinct("bucket").alias("n_buckets")
    )


@query(
    "term_lookup",
    f"""SELECT 'conv:' || conv_id || ':T' || turn AS doc_id, role AS label FROM {STORED} AND role = 'assistant'
    UNION ALL SELECT 'conv:' || conv_id || ':T' || turn, role FROM {STORED} AND conv_id = 5""",
)
def term_lookup(spark, sf):
    """Documents with an exact label, and the documents of one object (a single bucket is read)."""
    store = stored_conversations(spark, sf)
    exact = index_tables.term(store.read("datastreams"), "LABEL", "assistant")
    routed = store.lookup("datastreams", "conv:5")
    return exact.unionByName(routed).select("doc_id", F.col("LABEL").alias("label"))


@query("postings", sql.POSTINGS)
def term_postings(spark, sf):
    return postings.build_postings(ad.spread(ad.table(spark, sf, "documents"), "doc_id"), {"text": "text"})
