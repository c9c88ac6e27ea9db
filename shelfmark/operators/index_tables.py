"""Operations on the index tables as table -> table functions.

Changes are looked up from the table's side, so that a small set of changes is broadcast by adaptive execution (its size is
known at run time) and the large table is read without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.config import CORRECTED, ERROR_RETENTION_WEEKS, check_mode
from shelfmark.functions import ids
from shelfmark.functions.times import ntz, plus_seconds
from shelfmark.schemas import ERROR_COLUMNS


@dataclass(frozen=True)
class IndexTables:
    """Object, datastream and error documents; ``extra`` holds tables of user-defined job kinds by kind."""

    objects: DataFrame
    datastreams: DataFrame
    errors: DataFrame
    extra: dict[str, DataFrame] = field(default_factory=dict)

    def named(self) -> dict[str, DataFrame]:
        return {"objects": self.objects, "datastreams": self.datastreams, "errors": self.errors, **self.extra}


@dataclass(frozen=True)
class Change:
    """What becomes of a table: ``documents`` (key and routing columns) and everything below ``pids`` (``PID``) go, then ``rows`` replace those of
    their key. Without rows or documents to remove a part is left out."""

    rows: DataFrame | None = None
    documents: DataFrame | None = None
    pids: DataFrame | None = None


def upserted(current: DataFrame, changes: DataFrame, key: str = "doc_id", writes: str | None = None) -> DataFrame:
    """``changes`` with their new ``_version`` and ``created``; of ``current`` only keys and versions are read."""
    count = F.col(writes).cast("bigint") if writes else F.lit(1).cast("bigint")
    prior = current.select(key, F.col("_version").alias("_prior")).join(changes.select(key), key, "left_semi")
    return changes.join(prior, key, "left").withColumns(
        {"_version": F.coalesce(F.col("_prior"), F.lit(0)) + count, "created": F.col("_prior").isNull()}
    )


def upsert(
    current: DataFrame, changes: DataFrame, key: str = "doc_id", writes: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Replace whole rows by ``key`` and count versions.

    ``changes`` has one row per key and the columns of ``current`` without ``_version``; ``writes`` names a column with the
    number of writes the row stands for (1 without it). Returns the new table and ``(key, created, _version)`` per change.
    """
    written = upserted(current, changes, key, writes)
    return replaced(current, written, key), written.select(key, "created", "_version")


def replaced(current: DataFrame, written: DataFrame, key: str = "doc_id") -> DataFrame:
    """The table with the ``upserted`` rows in place of those of the same key."""
    columns = [c for c in current.columns if c != "_version"]
    # Full rows on the left keep their side unshuffled when the changed keys are few.
    kept = current.join(written.select(key), key, "left_anti").select(*columns, "_version")
    return kept.unionByName(written.select(*columns, "_version"))


def delete_cascade(tables: IndexTables, pids: DataFrame) -> IndexTables:
    """Remove object, datastream and error documents of the deleted objects (``pids`` has a column ``pid``)."""
    gone = pids.select(F.col("pid").alias("PID")).distinct()
    return replace(
        tables,
        objects=tables.objects.join(gone, "PID", "left_anti").select(*tables.objects.columns),
        datastreams=tables.datastreams.join(gone, "PID", "left_anti").select(*tables.datastreams.columns),
        errors=tables.errors.join(gone, "PID", "left_anti").select(*tables.errors.columns),
    )


def delete_datastreams(tables: IndexTables, keys: DataFrame, mode: str = "reference") -> IndexTables:
    """Carry out datastream DELETEs (``keys`` has ``doc_id``): the error row goes; the document only if ``corrected``."""
    gone = keys.select("doc_id").distinct()
    result = replace(
        tables, errors=tables.errors.join(gone, "doc_id", "left_anti").select(*tables.errors.columns)
    )
    if check_mode(mode) == CORRECTED:
        kept = tables.datastreams.join(gone, "doc_id", "left_anti").select(*tables.datastreams.columns)
        result = replace(result, datastreams=kept)
    return result


def clearing(succeeded: DataFrame, mode: str = "reference") -> DataFrame:
    """Of the documents that were written (``kind, doc_id, created``) those whose errors go.

    ``reference`` keeps the error of a datastream that was overwritten rather than created.
    """
    if check_mode(mode) == CORRECTED:
        return succeeded
    return succeeded.where((F.col("kind") == "object") | F.col("created"))


def clear_errors(errors: DataFrame, succeeded: DataFrame, mode: str = "reference") -> DataFrame:
    """Remove the error rows of documents that were written (``succeeded``: ``kind, doc_id, created``)."""
    clears = clearing(succeeded, mode)
    return errors.join(clears.select("doc_id").distinct(), "doc_id", "left_anti").select(*errors.columns)


def error_rows(failed: DataFrame, now=None) -> DataFrame:
    """One row per failed document, the last failure wins.

    ``failed``: ``op, pid, dsid, doc_id, ready_at, seq, error_message``. The time of failure is ``now``, or the job's own
    ``ready_at``, which a repeated run reproduces.
    """
    stamp = ntz(now) if now is not None else F.col("ready_at")
    rows = failed.groupBy("doc_id").agg(
        F.max_by(
            F.struct(
                F.col("pid").alias("PID"), F.col("dsid").alias("DSID"),
                ids.job_label(F.col("op"), F.col("doc_id")).alias("job"), F.col("error_message").alias("message"),
                stamp.alias("timestamp"),
            ),
            F.struct("ready_at", "seq"),
        ).alias("row")
    ).select("doc_id", "row.*")
    return rows.select(*ERROR_COLUMNS)


def write_errors(errors: DataFrame, failed: DataFrame, now=None) -> DataFrame:
    """The table with the ``error_rows`` of the failed documents in place of their earlier ones."""
    rows = error_rows(failed, now)
    kept = errors.join(rows.select("doc_id"), "doc_id", "left_anti")
    return kept.select(*ERROR_COLUMNS).unionByName(rows)


def expire_errors(errors: DataFrame, now, weeks: int = ERROR_RETENTION_WEEKS) -> DataFrame:
    """Error rows younger than the retention time; the bound is a literal that file filters see."""
    bound = plus_seconds(ntz(now), -weeks * 7 * 86400)
    return errors.where(F.col("timestamp") > bound)


def get_doc(table: DataFrame, document: str) -> DataFrame:
    return table.where(F.col("doc_id") == document)


def term(table: DataFrame, column: str, value: object) -> DataFrame:
    """Documents whose ``column`` holds exactly ``value``."""
    return table.where(F.col(column) == value)
