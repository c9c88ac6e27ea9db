"""Index tables as Parquet with merge on read, and one commit for all tables.

A table is a base, laid out by PID bucket, and deltas: whole rows that replace those of the same key, tombstones of single documents, and
tombstones of everything below a PID. Readers join the base with the few keys of the deltas; the newest row wins, and tombstones of a commit come before
its rows. What a commit writes therefore follows its changes, whatever buckets they touch and however large those are. ``maintain`` folds many
deltas into one, and works deltas into the buckets they touch once they hold a quarter of the base's rows, so a row is rewritten a few times at most.

Every commit is a log file of its own that says where all tables lie. It is created only if there is none of its number, so of two writers one
fails and leaves nothing visible; folders carry a mark of their writer. The newest commit is found by listing the log, which keeps the last
``KEEP`` files: a restart costs the same after ten commits and ten thousand. Folders that no kept commit names are deleted with the file that named
them last.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfmark import schemas
from shelfmark.config import ERROR_RETENTION_WEEKS
from shelfmark.functions.ids import pid_bucket
from shelfmark.functions.times import ntz
from shelfmark.operators.documents import property_type
from shelfmark.operators.index_tables import Change, IndexTables
from shelfmark.plans.files import Files
from shelfmark.session import empty_frame

TABLES = {"objects": schemas.OBJECTS, "datastreams": schemas.DATASTREAMS, "errors": schemas.ERRORS}
# Waiting jobs and harvest states; they are small, written whole, and committed together with the index tables.
STATE = {"pending": schemas.JOBS, "last_run": schemas.LAST_RUN}
# Search terms of analysed fields, and messages that could not be used.
FURTHER = {"postings": schemas.POSTINGS, "malformed": schemas.MALFORMED}
# Column that decides the bucket; user-defined tables use their PID column if they have one.
ROUTING = {"objects": "PID", "datastreams": "PID", "errors": "PID", "postings": "term", "malformed": "pid"}
# Columns that make a row; rows of tables without any only add up. All other tables have one row per document.
KEYS = {"postings": ("field", "term", "doc_id"), "malformed": ()}

ROW, GONE, CLEARED = "R", "D", "P"  # a row, a removed document, everything removed below a PID
DELTA_COLUMNS = "_op STRING, _v BIGINT, pid_bucket INT"
KEEP = 8
FOLD_AT, REBASE_ROWS, REBASE_SHARE = 16, 100_000, 4


class ConcurrentWriter(RuntimeError):
    """Another writer has made the commit that this one was about to make."""


@dataclass(frozen=True)
class Delta:
    version: int
    rows: int
    kinds: str  # which of ROW, GONE, CLEARED are in it
    last: str | None = None  # newest failure in it, for error rows


@dataclass(frozen=True)
class Commit:
    version: int
    batch: int | None
    clock: datetime | None
    dirs: dict[str, dict[int, int]]  # table -> bucket -> version of the folder that holds its base
    deltas: dict[str, tuple[Delta, ...]] = field(default_factory=dict)  # table -> what is merged into the base, oldest first
    rows: dict[str, int] = field(default_factory=dict)  # table -> rows of the base
    marks: dict[int, str] = field(default_factory=dict)  # version -> mark of its writer in folder names

    def folders(self) -> set[str]:
        """All data folders that this commit reads."""
        base = {f"{t}/base/{self.folder(v)}/pid_bucket={b}" for t, per_bucket in self.dirs.items() for b, v in per_bucket.items()}
        return base | {f"{t}/delta/{self.folder(d.version)}" for t, deltas in self.deltas.items() for d in deltas}

    def folder(self, version: int) -> str:
        return f"v={version}-{self.marks[version]}"

    def to_json(self) -> str:
        return json.dumps(
            {
                "version": self.version, "batch": self.batch, "clock": self.clock.isoformat() if self.clock else None,
                "dirs": self.dirs, "rows": self.rows, "marks": self.marks,
                "deltas": {t: [[d.version, d.rows, d.kinds, d.last] for d in deltas] for t, deltas in self.deltas.items()},
            }
        )

    @staticmethod
    def from_json(text: str) -> Commit:
        found = json.loads(text)
        clock = datetime.fromisoformat(found["clock"]) if found["clock"] else None
        dirs = {t: {int(b): v for b, v in per_bucket.items()} for t, per_bucket in found["dirs"].items()}
        deltas = {t: tuple(Delta(*d) for d in own) for t, own in found["deltas"].items()}
        return Commit(found["version"], found["batch"], clock, dirs, deltas, found["rows"], {int(v): m for v, m in found["marks"].items()})


class IndexStore:
    """``buckets`` is fixed per store; ``extra`` are schemas of tables of user-defined job kinds, ``properties`` the configured
    dissemination properties, which become typed fields of the object table. With ``analysed`` the search terms of objects and datastreams are
    kept as well. Error rows are forgotten ``retention`` after their failure, by the commits' clock."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int = 64,
        extra: dict[str, str] | None = None,
        properties: dict[str, object] | None = None,
        analysed: bool = False,
        retention: timedelta = timedelta(weeks=ERROR_RETENTION_WEEKS),
    ):
        self.spark, self.root, self.buckets, self.analysed, self.retention = spark, root.rstrip("/"), buckets, analysed, retention
        self.schemas = {**TABLES, **STATE, **FURTHER, **(extra or {}), "objects": object_schema(properties)}
        self.extra = tuple(extra or ())
        self.files = Files(spark, self.root)

    def names(self, table: str) -> list[str]:
        return StructType.fromDDL(self.schemas[table]).fieldNames()

    def routing(self, table: str) -> str | None:
        """Column whose bucket a row lies in; nothing for user-defined tables without a PID, which are routed by document, and for state."""
        return ROUTING.get(table) or ("PID" if table in self.extra and "PID" in self.names(table) else None)

    def bucket(self, table: str) -> Column:
        if table in STATE:
            return F.lit(0)
        return pid_bucket(F.col(self.routing(table) or "doc_id"), self.buckets)

    def key(self, table: str) -> tuple[str, ...]:
        return KEYS.get(table, ("doc_id",))

    # Commits

    def log_name(self, version: int) -> str:
        return f"log/{version:020d}.json"

    def logged(self) -> list[int]:
        return sorted(int(name[:-5]) for name in self.files.names("log") if name.endswith(".json"))

    def newest(self) -> Commit | None:
        """The visible commit, or nothing before the first one: one listing and one small file."""
        versions = self.logged()
        return self.at(versions[-1]) if versions else None

    def at(self, version: int) -> Commit:
        """A commit that is still kept."""
        found = Commit.from_json(self.files.read(self.log_name(version)))
        return replace(found, dirs={t: found.dirs.get(t, {}) for t in self.schemas}, deltas={t: found.deltas.get(t, ()) for t in self.schemas})

    def ensure(self) -> Commit:
        """Create empty tables where there are none; existing ones are left alone."""
        found = self.newest()
        if found is None:
            first = Commit(0, None, None, {t: {} for t in self.schemas}, {t: () for t in self.schemas})
            self.files.create(self.log_name(0), first.to_json())
            found = self.newest()
        return found

    def publish(self, commit: Commit) -> Commit:
        """Make a commit visible, unless there is one of its number; then forget the oldest."""
        used = {v for per_bucket in commit.dirs.values() for v in per_bucket.values()} | {d.version for own in commit.deltas.values() for d in own}
        commit = replace(commit, marks={v: m for v, m in commit.marks.items() if v in used})
        if not self.files.create(self.log_name(commit.version), commit.to_json()):
            raise ConcurrentWriter(f"another writer has made commit {commit.version} of {self.root}")
        versions = self.logged()
        if len(versions) > KEEP:
            kept = with_parents(self.at(versions[-KEEP]).folders())
            for version in versions[:-KEEP]:
                for folder in sorted(with_parents(self.at(version).folders()) - kept):
                    self.files.delete(folder)
                self.files.delete(self.log_name(version))
        return commit

    # Reading

    def read(self, table: str, commit: Commit | None = None, buckets: set[int] | None = None) -> DataFrame:
        """Rows of a table as of a commit, or of some of its buckets."""
        commit = commit or self.ensure()
        names, key = self.names(table), self.key(table)
        rows, deltas = self._base(table, commit, buckets), commit.deltas[table]
        if deltas:
            kinds = {k for d in deltas for k in d.kinds}
            changes = self._deltas(table, commit, buckets)
            if not key:
                rows = rows.unionByName(changes.select(*names))
            else:
                live, changed, cleared = newest_rows(changes, key, kinds, len(deltas))
                rows = rows.join(changed, list(key), "left_anti")
                if cleared is not None:
                    rows = rows.join(cleared.select("PID"), "PID", "left_anti")
                rows = rows.select(*names).unionByName(live.select(*names))
        if table == "errors" and commit.clock is not None:
            rows = rows.where(F.col("timestamp") > ntz(commit.clock - self.retention))
        return rows.select(*names)

    def _base(self, table: str, commit: Commit, buckets: set[int] | None = None) -> DataFrame:
        paths = [
            f"{self.root}/{table}/base/{commit.folder(v)}/pid_bucket={b}"
            for b, v in sorted(commit.dirs[table].items())
            if buckets is None or b in buckets
        ]
        if not paths:
            return empty_frame(self.spark, self.schemas[table])
        if table != "errors":
            return self.spark.read.schema(self.schemas[table]).parquet(*paths)
        rows = self.spark.read.option("basePath", f"{self.root}/{table}/base").schema(f"{self.schemas[table]}, day STRING").parquet(*paths)
        if commit.clock is not None:  # whole days that are over are not even opened
            rows = rows.where(F.col("day") >= day_of(commit.clock - self.retention))
        return rows.select(*self.names(table))

    def _deltas(self, table: str, commit: Commit, buckets: set[int] | None = None) -> DataFrame:
        paths = [f"{self.root}/{table}/delta/{commit.folder(d.version)}" for d in commit.deltas[table]]
        rows = self.spark.read.schema(f"{self.schemas[table]}, {DELTA_COLUMNS}").parquet(*paths)
        return rows if buckets is None else rows.where(F.col("pid_bucket").isin(sorted(buckets)))

    def lookup(self, table: str, pid: str, commit: Commit | None = None) -> DataFrame:
        """Documents of one object and its datastreams, or the postings of one term: reads a single bucket."""
        bucket = self.spark.range(1).select(pid_bucket(F.lit(pid), self.buckets)).first()[0]
        return self.read(table, commit, buckets={bucket}).where(F.col(self.routing(table)) == pid)

    def tables(self, commit: Commit | None = None, buckets: set[int] | None = None) -> IndexTables:
        commit = commit or self.ensure()
        read = {t: self.read(t, commit, buckets if self.routing(t) else None) for t in (*TABLES, *self.extra)}
        return IndexTables(
            read["objects"], read["datastreams"], read["errors"], {t: read[t] for t in self.extra}
        )

    def touched(self, jobs: DataFrame) -> set[int]:
        """Buckets that hold the jobs' PIDs; never more than ``buckets`` values."""
        rows = jobs.select(pid_bucket(F.col("pid"), self.buckets).alias("b")).distinct().collect()
        return {r["b"] for r in rows}

    # Writing

    def commit(
        self,
        previous: Commit,
        tables: dict[str, tuple[DataFrame, set[int] | None]] | None = None,
        batch: int | None = None,
        clock=None,
        changes: dict[str, Change] | None = None,
    ) -> Commit:
        """Write the next version: of ``tables`` the rows and the buckets they replace (``None``: the whole table), of ``changes`` only those."""
        version, mark = previous.version + 1, uuid.uuid4().hex[:12]
        dirs = {t: dict(d) for t, d in previous.dirs.items()}
        deltas, rows = dict(previous.deltas), dict(previous.rows)
        for name, (df, touched) in (tables or {}).items():
            if touched is not None and deltas[name] and (others := self.changed_buckets(name, previous) - touched):
                df, touched = df.unionByName(self.read(name, previous, others)), touched | others
            kept = {} if touched is None else {b: d for b, d in dirs[name].items() if b not in touched}
            written, n = self._write(name, df, version, mark)
            if touched is not None and not written <= touched:
                raise ValueError(f"{name}: rows outside the buckets to be replaced")
            dirs[name] = {**kept, **{b: version for b in written}}
            rows[name] = n + (previous.rows.get(name, 0) if touched is not None else 0)
            deltas[name] = ()
        for name, change in (changes or {}).items():
            written = self._write_delta(name, self._delta_rows(name, change, version), version, mark)
            if written is not None:
                deltas[name] = (*deltas[name], written)
        if clock is not None and not dirs["errors"]:
            # Nothing older is left that a dropped delta could have replaced.
            over = day_of(clock - self.retention)
            while deltas["errors"] and (ROW not in deltas["errors"][0].kinds or (deltas["errors"][0].last or "") < over):
                deltas["errors"] = deltas["errors"][1:]
        return self.publish(Commit(version, batch, clock, dirs, deltas, rows, {**previous.marks, version: mark}))

    def _write(self, name: str, df: DataFrame, version: int, mark: str = "0") -> tuple[set[int], int]:
        """Write base rows bucket by bucket, so that a document lies with its parent; gives the buckets and the number of rows.

        Rebalancing splits a crowded bucket over several tasks and files and joins small ones.
        """
        path = f"{self.root}/{name}/base/v={version}-{mark}"
        routed = df.select(*self.names(name)).withColumn("pid_bucket", self.bucket(name))
        folders = ["pid_bucket"]
        if name == "errors":
            routed, folders = routed.withColumn("day", day_of(F.col("timestamp"))), ["pid_bucket", "day"]
        routed.hint("rebalance", "pid_bucket").write.mode("overwrite").partitionBy(*folders).parquet(path)
        found = self.spark.read.schema("pid_bucket INT").parquet(path).groupBy("pid_bucket").count().collect()
        return {r["pid_bucket"] for r in found}, sum(r["count"] for r in found)

    def _delta_rows(self, name: str, change: Change, version: int) -> DataFrame:
        """Rows of a change as they are written: whole rows, and tombstones with nothing but their key and routing."""
        names, parts = self.names(name), []
        if change.rows is not None:
            parts.append(change.rows.select(*names, F.lit(ROW).alias("_op")))
        for gone, kind in ((change.documents, GONE), (change.pids, CLEARED)):
            if gone is not None:
                types = {f.name: f.dataType for f in StructType.fromDDL(self.schemas[name])}
                row = [F.col(c) if c in gone.columns else F.lit(None).cast(types[c]).alias(c) for c in names]
                parts.append(gone.select(*row, F.lit(kind).alias("_op")))
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more)
        return rows.withColumn("_v", F.lit(version).cast("bigint")).withColumn("pid_bucket", self.bucket(name))

    def _write_delta(self, name: str, rows: DataFrame, version: int, mark: str) -> Delta | None:
        """Write a delta, in order of buckets so that a reader of some skips the rest; nothing for no rows.

        Its files follow its size, not the buckets it touches.
        """
        path = f"{self.root}/{name}/delta/v={version}-{mark}"
        rows.hint("rebalance", "pid_bucket").sortWithinPartitions("pid_bucket").write.mode("overwrite").parquet(path)
        last = F.max("timestamp") if name == "errors" else F.lit(None)
        written = self.spark.read.schema(f"{self.schemas[name]}, {DELTA_COLUMNS}").parquet(path)
        found = written.groupBy("_op").agg(F.count(F.lit(1)).alias("n"), last.alias("last")).collect()
        if not found:
            return None
        lasts = [r["last"].date().isoformat() for r in found if r["last"] is not None]
        return Delta(version, sum(r["n"] for r in found), "".join(sorted(r["_op"] for r in found)), max(lasts, default=None))

    # Upkeep

    def changed_buckets(self, table: str, commit: Commit) -> set[int]:
        """Buckets that a table's deltas have rows of."""
        return {r["pid_bucket"] for r in self._deltas(table, commit).select("pid_bucket").distinct().collect()} if commit.deltas[table] else set()

    def maintain(self, commit: Commit | None = None, fold_at: int = FOLD_AT, rebase_rows: int = REBASE_ROWS) -> Commit:
        """Fold and rebase what has grown too much, in a commit of its own; decided from the log alone."""
        commit = commit or self.ensure()
        rebase, fold = [], []
        for name, deltas in commit.deltas.items():
            changed = sum(d.rows for d in deltas)
            if changed >= rebase_rows and changed * REBASE_SHARE >= commit.rows.get(name, 0):
                rebase.append(name)
            elif len(deltas) >= fold_at:
                fold.append(name)
        if not rebase and not fold:
            return commit
        version, mark = commit.version + 1, uuid.uuid4().hex[:12]
        dirs, deltas, rows = {t: dict(d) for t, d in commit.dirs.items()}, dict(commit.deltas), dict(commit.rows)
        for name in rebase:
            touched = self.changed_buckets(name, commit)
            written, _ = self._write(name, self.read(name, commit, touched), version, mark)
            dirs[name] = {**{b: v for b, v in dirs[name].items() if b not in touched}, **{b: version for b in written}}
            # Replaced rows count twice: enough for the next decision.
            rows[name] = rows.get(name, 0) + sum(d.rows for d in deltas[name] if ROW in d.kinds)
            deltas[name] = ()
        for name in fold:
            folded = self._write_delta(name, folded_rows(self._deltas(name, commit), self.key(name), self.names(name)), version, mark)
            deltas[name] = (folded,) if folded else ()
        return self.publish(Commit(version, commit.batch, commit.clock, dirs, deltas, rows, {**commit.marks, version: mark}))


def with_parents(folders: set[str]) -> set[str]:
    """The folders, and those of the commits that hold them."""
    return folders | {"/".join(f.split("/")[:3]) for f in folders}


def newest_rows(
    changes: DataFrame, key: tuple[str, ...], kinds: set[str], n_deltas: int = 2
) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Of the rows of some deltas: those that stand, the keys that were changed, and the PIDs that were cleared (``PID, _cleared``).

    Tombstones of a commit come before its rows. A delta has one row per key, so a single one without tombstones stands as it is.
    """
    if n_deltas == 1 and kinds == {ROW}:
        return changes, changes.select(*key), None
    own = changes.where(F.col("_op") != CLEARED)
    newest = Window.partitionBy(*key).orderBy(F.col("_v").desc(), F.col("_op").desc())
    live = own.withColumn("_turn", F.row_number().over(newest)).where((F.col("_turn") == 1) & (F.col("_op") == ROW))
    cleared = None
    if CLEARED in kinds:
        cleared = changes.where(F.col("_op") == CLEARED).groupBy("PID").agg(F.max("_v").alias("_cleared"))
        live = live.join(cleared, "PID", "left").where(F.col("_cleared").isNull() | (F.col("_v") >= F.col("_cleared")))
    return live, own.select(*key).distinct(), cleared


def folded_rows(changes: DataFrame, key: tuple[str, ...], names: list[str]) -> DataFrame:
    """Several deltas as one: the newest change of each key and PID, with the version it was made in."""
    columns = [*names, "_op", "_v", "pid_bucket"]
    if not key:
        return changes.select(*columns)
    own = changes.where(F.col("_op") != CLEARED)
    newest = Window.partitionBy(*key).orderBy(F.col("_v").desc(), F.col("_op").desc())
    kept = own.withColumn("_turn", F.row_number().over(newest)).where(F.col("_turn") == 1).select(*columns)
    if "PID" not in names:
        return kept
    newest_of_pid = Window.partitionBy("PID").orderBy(F.col("_v").desc())
    cleared = changes.where(F.col("_op") == CLEARED).withColumn("_turn", F.row_number().over(newest_of_pid))
    return kept.unionByName(cleared.where(F.col("_turn") == 1).select(*columns))


def day_of(moment) -> Column | str:
    """The day of a failure as text, which names a folder; times unknown lie in a folder after all others and never expire by day."""
    if isinstance(moment, datetime):
        return moment.date().isoformat()
    return F.coalesce(F.date_format(moment, "yyyy-MM-dd"), F.lit("unknown"))


def object_schema(properties: dict[str, object] | None = None) -> str:
    """Schema of the object table; configured dissemination properties are typed fields of one struct, ``properties``."""
    if not properties:
        return schemas.OBJECTS
    fields = ", ".join(f"`{name}`: {property_type(declared)}" for name, declared in properties.items())
    return f"{schemas.OBJECTS}, properties STRUCT<{fields}>"
