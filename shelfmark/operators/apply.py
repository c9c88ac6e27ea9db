"""Carry out released jobs on the index tables: dispatch by operation, fan-out, cascade, errors and versions.

Jobs of one document run in order of (``ready_at``, ``seq``). Documents are built from the repository as it is when the batch
starts, so all builds of a document in a batch have the same outcome. The end state then follows from counts and last
positions per document, and each document is built once, however many jobs it has: no group of jobs is ever collected or
sorted, and fan-out is counted per object instead of listing every (CREATE, datastream) pair.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.config import CORRECTED, PipelineConfig
from shelfmark.functions import ids
from shelfmark.functions.times import ntz
from shelfmark.operators import documents, index_tables
from shelfmark.operators.debounce import mark_interrupted
from shelfmark.operators.filters import JobPredicate, filter_jobs, predicates_from_config
from shelfmark.operators.index_tables import Change, IndexTables
from shelfmark.operators.jobs import fan_out_sequence
from shelfmark.operators.skew import LEAST_ROWS, Crowd, measure, salted_lookup
from shelfmark.schemas import DATASTREAM_COLUMNS, OBJECT_COLUMNS
from shelfmark.session import materialize
from shelfmark.sources.repository import Repository

# Builds documents of a user-defined kind: job rows -> the same rows with ``doc`` (struct), ``error_message``, and ``failed`` if it likes.
Handler = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Outcome:
    tables: IndexTables
    waiting: DataFrame  # jobs not yet due
    failed: DataFrame
    changes: dict[str, Change]  # the same new tables as what changes in each


def position(at: str = "ready_at") -> Column:
    return F.struct(F.col(at).alias("at"), F.col("seq"))


def fan_out_position() -> Column:
    return F.struct(F.col("ready_at").alias("at"), fan_out_sequence(F.col("seq")).alias("seq"))


def build_object_docs(jobs: DataFrame, repository: Repository, cfg: PipelineConfig, transform=None) -> DataFrame:
    built = documents.build_objects(jobs, repository.object_profiles)
    return documents.attach_dissemination(built, repository.disseminations, cfg.sdef_pid, cfg.method, transform)


def build_datastream_docs(jobs: DataFrame, repository: Repository) -> DataFrame:
    built = documents.build_datastreams(jobs, repository.datastream_profiles)
    return documents.attach_content(built, repository.contents)


def _listed(repository: Repository, predicates: list[JobPredicate]) -> DataFrame:
    """Datastreams a fan-out would create, after the job filters."""
    children = repository.listing.select(
        F.lit("datastream").alias("kind"), F.lit("CREATE").alias("op"), "pid", "dsid",
        ids.doc_id(F.lit("datastream"), F.col("pid"), F.col("dsid")).alias("doc_id"),
    )
    return filter_jobs(children, *predicates)


def replace_by_fan_out(
    jobs: DataFrame,
    done: DataFrame,
    good_parents: DataFrame,
    listed: DataFrame,
    delays_s: tuple[int, int],
    keep=lambda df, name: df,
    salts: int = 8,
    crowd: Crowd | None = None,
) -> DataFrame:
    """``jobs`` without the waiting datastream CREATEs that give way to the fan-out of their object.

    A fan-out job equals a CREATE of the same datastream and arrives when the object's CREATE, among ``done``, is finished.
    """
    candidate = (F.col("kind") == "datastream") & (F.col("op") == "CREATE") & (F.col("delay_s") > 0) & (F.col("dsid") != "")
    candidates, others = jobs.where(candidate), jobs.where(~candidate)
    parents = done.where((F.col("kind") == "object") & (F.col("op") == "CREATE")).select(
        "pid", F.col("ready_at").alias("at"), fan_out_sequence(F.col("seq")).alias("seq")
    )
    marked = mark_interrupted(candidates, parents, "pid", *delays_s)
    # Only a successful parent fans out, and only to the datastreams it lists. The listing is cut down to the candidates'
    # documents first, so that only few narrow rows are repeated for the salts.
    asked = candidates.select("doc_id").distinct()
    known = listed.join(asked, "doc_id", "left_semi").select("doc_id", F.lit(True).alias("_listed"))
    good = good_parents.select("pid", F.lit(True).alias("_good"))
    checked = salted_lookup(marked, known, ["doc_id"], spread=["seq"], salts=salts, crowd=crowd)
    checked = salted_lookup(checked, good, ["pid"], spread=["doc_id", "seq"], salts=salts, crowd=crowd)
    replaced = F.col("interrupted") & F.coalesce(F.col("_listed") & F.col("_good"), F.lit(False))
    return others.unionByName(keep(checked.where(~replaced).select(*jobs.columns), "datastream-creates"))


def count_after(events: DataFrame, probes: DataFrame, on: str, keep=materialize) -> DataFrame:
    """Per probe (``on, doc_id, pos``) the number of events (``on, pos``) after it, as ``n_after``.

    Prefix counts in two passes: rows are dealt by ranges of (``on``, ``pos``) and written by ``keep``, so that the ranges stay; each range counts by
    itself, and the events of the key's other ranges, one number each, are added. However many events a key has and however close they lie, they
    are spread over the ranges; no (event, probe) pairs are formed.
    """
    nothing = F.lit(None).cast("string").alias("doc_id")
    rows = events.select(on, "pos", nothing, F.lit(1).alias("_event")).unionByName(probes.select(on, "pos", "doc_id", F.lit(0).alias("_event")))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keep(rows.repartitionByRange(parts, on, "pos").withColumn("_range", F.spark_partition_id()), "count-after")
    # An event at the probe's place does not lie after it.
    later = Window.partitionBy("_range", on).orderBy(F.col("pos").desc(), "_event").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = dealt.withColumn("_within", F.sum("_event").over(later)).where(F.col("_event") == 0)
    later_ranges = Window.partitionBy(on).orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy(on, "_range").agg(F.sum("_event").alias("_n")).select(
        on, "_range", F.coalesce(F.sum("_n").over(later_ranges), F.lit(0)).alias("_later")
    )
    return within.join(ranges, [on, "_range"]).select("doc_id", (F.col("_within") + F.col("_later")).alias("n_after"))


def _last_deletes(released: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Last DELETE per object (``removed``) and per other document (``own``)."""
    is_object = F.col("kind") == "object"
    deletes = released.where(F.col("op") == "DELETE")
    return (
        deletes.where(is_object).groupBy("pid").agg(F.max(position()).alias("removed")),
        deletes.where(~is_object).groupBy("kind", "doc_id").agg(F.max(position()).alias("own")),
    )


def _standing_failures(outcomes: DataFrame, released: DataFrame) -> DataFrame:
    """Failures that nothing clears afterwards. Kinds share error rows by document id."""
    good, bad = documents.split_failures(outcomes)
    removed, own = _last_deletes(released)
    own = own.groupBy("doc_id").agg(F.max("own").alias("own"))
    success = good.groupBy("doc_id").agg(F.max("last.pos").alias("success"))
    judged = bad.join(removed, "pid", "left").join(own, "doc_id", "left").join(success, "doc_id", "left")
    cleared = F.greatest("removed", "own", "success")
    return judged.where(cleared.isNull() | (F.col("last.pos") > cleared)).select(
        F.col("last.op").alias("op"), "pid", F.col("last.job_dsid").alias("dsid"), "doc_id",
        F.col("last.pos.at").alias("ready_at"), F.col("last.pos.seq").alias("seq"), "error_message",
    )


def _direct_writes(
    released: DataFrame, removed: DataFrame, own: DataFrame, mode: str, custom: bool, salts: int, crowd: Crowd | None = None
) -> DataFrame:
    """Per document written by its own jobs: ``n`` writes since its last removal and the ``last`` write.

    Objects and datastreams are removed with their object, datastreams by their own DELETE only in ``corrected`` mode, and
    documents of user-defined kinds (``custom``) by their own DELETE alone. A look-up that cannot matter is left out.
    """
    is_object = F.col("kind") == "object"
    is_custom = ~F.col("kind").isin("object", "datastream")
    writes = released.where(F.col("op") != "DELETE").select("kind", "doc_id", "pid", "dsid", "op", "ready_at", "seq")
    placed = salted_lookup(writes, removed, ["pid"], spread=["doc_id", "seq"], salts=salts, crowd=crowd)
    removal = F.col("removed")
    if mode == CORRECTED or custom:
        placed = salted_lookup(placed, own, ["kind", "doc_id"], spread=["seq"], salts=salts, crowd=crowd)
        for_streams = F.greatest("removed", "own") if mode == CORRECTED else F.col("removed")
        removal = F.when(is_object, F.col("removed")).when(is_custom, F.col("own")).otherwise(for_streams)
    counts = (removal.isNull() | (position() > removal)).cast("bigint")
    # Jobs of one object may come from different datastreams; the document has no datastream id.
    dsid = F.when(is_object, "").otherwise(F.col("dsid"))
    return placed.groupBy("kind", "doc_id", "pid", dsid.alias("_dsid")).agg(
        F.sum(counts).alias("n"),
        F.max(F.struct(position().alias("pos"), "op", F.col("dsid").alias("job_dsid"))).alias("last"),
    ).withColumnRenamed("_dsid", "dsid")


def _fanned_out(
    released: DataFrame, good_parents: DataFrame, listed: DataFrame, removed: DataFrame, own: DataFrame, mode: str, salts: int,
    crowd: Crowd | None = None, crowd_listed: Crowd | None = None,
) -> DataFrame:
    """The same per datastream written by the fan-out of its object: counted per object, listed once per datastream."""
    is_create = (F.col("kind") == "object") & (F.col("op") == "CREATE")
    creates = released.where(is_create).select("pid", "seq", fan_out_position().alias("pos"))
    alive = salted_lookup(creates, removed, ["pid"], spread=["seq"], salts=salts, crowd=crowd).where(
        F.col("removed").isNull() | (F.col("pos") > F.col("removed"))
    )
    parents = (
        alive.groupBy("pid")
        .agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("pos"), F.min("pos").alias("_first"))
        .join(good_parents.select("pid"), "pid", "left_semi")
    )
    children = salted_lookup(listed, parents, ["pid"], spread=["dsid"], how="inner", salts=salts, crowd=crowd_listed)
    if mode == CORRECTED:
        # A datastream's own DELETE restarts its count; only where CREATEs lie on both sides of it they are counted again.
        deleted = children.join(own.where(F.col("kind") == "datastream").select("doc_id", "own"), "doc_id", "left")
        untouched = F.col("own").isNull() | (F.col("own") < F.col("_first"))
        split = ~untouched & (F.col("own") < F.col("pos"))
        probes = deleted.where(split).select("pid", "doc_id", F.col("own").alias("pos"))
        asked = alive.select("pid", "pos").join(probes.select("pid").distinct(), "pid", "left_semi")
        recount = count_after(asked, probes, "pid")
        n = F.when(untouched, F.col("n")).when(split, F.col("n_after")).otherwise(0)
        children = deleted.join(recount, "doc_id", "left").withColumn("n", n)
    return children.select(
        "kind", "doc_id", "pid", "dsid", "n",
        F.struct("pos", F.lit("CREATE").alias("op"), F.col("dsid").alias("job_dsid")).alias("last"),
    )


def _written(
    released: DataFrame, good_parents: DataFrame, listed: DataFrame, mode: str, custom: bool, salts: int, crowd: Crowd | None = None,
    crowd_listed: Crowd | None = None,
) -> DataFrame:
    """Per written document: writes since it was last removed (``n``) and its ``last`` write."""
    removed, own = _last_deletes(released)
    direct = _direct_writes(released, removed, own, mode, custom, salts, crowd)
    fanned = _fanned_out(released, good_parents, listed, removed, own, mode, salts, crowd, crowd_listed)
    return direct.unionByName(fanned).groupBy("kind", "doc_id", "pid", "dsid").agg(
        F.sum("n").alias("n"), F.max("last").alias("last")
    )


def apply_jobs(
    tables: IndexTables,
    settled: DataFrame,
    repository: Repository,
    cfg: PipelineConfig,
    clock=None,
    handlers: dict[str, Handler] | None = None,
    transform=None,
    now=None,
    keep=lambda df, name: df,
    salts: int = 8,
    least_crowd: int = LEAST_ROWS,
) -> Outcome:
    """New index tables after the ``settled`` jobs that are due by ``clock`` (all of them without a clock).

    ``handlers`` build documents of further job kinds into tables of their own; ``transform`` supplies disseminations;
    ``keep`` may store intermediate rows that several outputs read; ``now`` lets old errors expire; ``least_crowd`` is the number of jobs
    from which crowded keys are spread over ``salts``.
    """
    mode = cfg.mode
    listed = _listed(repository, predicates_from_config(cfg))
    is_due = F.lit(True) if clock is None else F.col("ready_at") <= ntz(clock)
    due = settled.where(is_due)

    # Objects first: only those that could be built fan out.
    object_jobs = due.where((F.col("kind") == "object") & (F.col("op") != "DELETE"))
    wanted = object_jobs.select("pid").distinct()
    objects = keep(build_object_docs(wanted, repository, cfg, transform), "objects")
    good_parents, _ = documents.split_failures(objects)

    # Keys that hold much of the jobs, or of the listing, are known before anything is joined on them.
    crowd, crowd_listed = measure(settled, ("pid",), ("doc_id",), least_rows=least_crowd), measure(repository.listing, ("pid",), least_rows=least_crowd)
    unreplaced = replace_by_fan_out(settled, due, good_parents, listed, cfg.delays_s, keep, salts, crowd)
    remaining = unreplaced.where(is_due)
    written = keep(_written(remaining, good_parents, listed, mode, bool(handlers), salts, crowd, crowd_listed), "written")

    # Stored, so that the planner knows how few documents change when it joins them with the tables.
    object_docs = keep(
        written.where(F.col("kind") == "object").join(objects.select("pid", "doc", "error_message"), "pid", "left"),
        "object-documents",
    )
    datastream_docs = keep(
        build_datastream_docs(written.where(F.col("kind") == "datastream"), repository), "datastream-documents"
    )
    built = {"object": object_docs, "datastream": datastream_docs}
    for kind, handler in (handlers or {}).items():
        built[kind] = handler(written.where(F.col("kind") == kind))

    # Everything after the last removal counts, so removals go first.
    deletes = remaining.where(F.col("op") == "DELETE")
    of_objects, of_streams = deletes.where(F.col("kind") == "object"), deletes.where(F.col("kind") == "datastream")
    after = index_tables.delete_cascade(tables, of_objects)
    after = index_tables.delete_datastreams(after, of_streams, mode)
    pids = of_objects.select(F.col("pid").alias("PID")).distinct()
    streams = of_streams.select(F.col("pid").alias("PID"), "doc_id").distinct()

    object_changes = _changes(object_docs, OBJECT_COLUMNS, "_dissemination")
    if "properties" in after.objects.columns:
        known = after.objects.schema["properties"].dataType.fieldNames()
        object_changes = documents.nested_properties(object_changes, {n: cfg.properties.get(n, "string") for n in known})
    datastream_changes = _changes(datastream_docs, DATASTREAM_COLUMNS, "CONTENT")
    # Stored, since tables, error rows and search terms all follow from them: the index is looked up once for their versions.
    rows = {
        "objects": keep(index_tables.upserted(after.objects, object_changes, writes="n"), "object-rows"),
        "datastreams": keep(index_tables.upserted(after.datastreams, datastream_changes, writes="n"), "datastream-rows"),
    }
    new_objects = index_tables.replaced(after.objects, rows["objects"])
    new_datastreams = index_tables.replaced(after.datastreams, rows["datastreams"])
    changes = {
        "objects": Change(rows["objects"], None, pids),
        "datastreams": Change(rows["datastreams"], streams if mode == CORRECTED else None, pids),
    }
    results = [(rows["objects"], "object", "PID"), (rows["datastreams"], "datastream", "PID")]
    extra = dict(after.extra)
    for kind in handlers or {}:
        gone = deletes.where(F.col("kind") == kind).select(F.col("pid").alias("PID"), "doc_id").distinct()
        kept = extra[kind].join(gone, "doc_id", "left_anti").select(*extra[kind].columns)
        fields = [c for c in kept.columns if c not in ("doc_id", "_version")]
        own = _changes(built[kind], fields)
        extra[kind], _ = index_tables.upsert(kept, own, writes="n")
        changes[kind] = Change(index_tables.upserted(kept, own, writes="n"), gone)
        pid = built[kind].select("doc_id", F.col("pid").alias("_of")).distinct()
        results.append((changes[kind].rows.join(pid, "doc_id"), kind, "_of"))

    succeeded = None
    for result, kind, pid in results:
        own = result.select("doc_id", F.col(pid).alias("PID"), "created", F.lit(kind).alias("kind"))
        succeeded = own if succeeded is None else succeeded.unionByName(own)
    outcomes = None
    for docs in built.values():
        own = docs.select("doc_id", "pid", "last", "error_message", documents.is_failure(docs).alias("failed"))
        outcomes = own if outcomes is None else outcomes.unionByName(own)
    failed = keep(_standing_failures(outcomes, remaining), "failed")
    errors = index_tables.clear_errors(after.errors, succeeded, mode)
    errors = index_tables.write_errors(errors, failed)
    if now is not None:
        errors = index_tables.expire_errors(errors, now)
    over = index_tables.clearing(succeeded, mode).select("PID", "doc_id").unionByName(streams.select("PID", "doc_id")).distinct()
    changes["errors"] = Change(index_tables.error_rows(failed), over, pids)
    done = replace(after, objects=new_objects, datastreams=new_datastreams, errors=errors, extra=extra)
    return Outcome(done, unreplaced.where(~is_due), failed, changes)


def _changes(docs: DataFrame, fields, nested: str | None = None) -> DataFrame:
    """Good documents that outlive the batch's removals, as rows of their table plus the number of writes."""
    good, _ = documents.split_failures(docs.where(F.col("n") > 0))
    names = [*fields, *([nested] if nested else [])]
    return good.select(*[F.col("doc")[c].alias(c) for c in names], "doc_id", "n")
