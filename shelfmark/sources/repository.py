"""The repository as tables: profiles, listings, contents and disseminations."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions.ids import pid_bucket


@dataclass(frozen=True)
class Repository:
    """Tables the indexing jobs look things up in, each unique on its key.

    ``object_profiles`` on ``pid``; ``datastream_profiles`` (also the listing of an object's datastreams) and ``contents``
    on (``pid``, ``ds_id``); ``disseminations`` on (``pid``, ``sdef_pid``, ``method``).
    """

    object_profiles: DataFrame
    datastream_profiles: DataFrame
    contents: DataFrame
    disseminations: DataFrame | None = None
    buckets: int | None = None  # number of PID buckets when the tables are partitioned by ``pid_bucket``

    def only(self, touched: set[int], buckets: int) -> Repository:
        """The same tables cut down to some PID buckets, when they are laid out in as many as the index is.

        A micro-batch then reads the folders of its own objects instead of every profile and content.
        """
        if self.buckets != buckets or len(touched) >= buckets:
            return self

        def cut(df: DataFrame | None) -> DataFrame | None:
            return None if df is None else df.where(F.col("pid_bucket").isin(sorted(touched)))

        return replace(
            self, object_profiles=cut(self.object_profiles), datastream_profiles=cut(self.datastream_profiles),
            contents=cut(self.contents), disseminations=cut(self.disseminations),
        )

    @property
    def listing(self) -> DataFrame:
        return self.datastream_profiles.select("pid", F.col("ds_id").alias("dsid"))


TABLES = {
    "object_profiles": schemas.OBJECT_PROFILES,
    "datastream_profiles": schemas.DATASTREAM_PROFILES,
    "contents": schemas.CONTENTS,
    "disseminations": schemas.DISSEMINATIONS,
}


def read_repository(spark: SparkSession, root: str, fmt: str = "parquet", buckets: int | None = None) -> Repository:
    """Repository tables under ``root``; ``buckets`` when ``write_repository`` laid them out by PID."""
    added = ", pid_bucket INT" if buckets else ""
    tables = {
        name: spark.read.schema(schema + added).format(fmt).load(f"{root.rstrip('/')}/{name}")
        for name, schema in TABLES.items()
    }
    return Repository(**tables, buckets=buckets)


def write_repository(repository: Repository, root: str, buckets: int) -> None:
    """Lay repository tables out in PID buckets, in as many folders as the index they feed."""
    for name in TABLES:
        df = getattr(repository, name)
        if df is not None:
            routed = df.withColumn("pid_bucket", pid_bucket(F.col("pid"), buckets))
            path = f"{root.rstrip('/')}/{name}"
            routed.hint("rebalance", "pid_bucket").write.mode("overwrite").partitionBy("pid_bucket").parquet(path)


def read_content_files(spark: SparkSession, path: str) -> DataFrame:
    """Contents from files laid out as ``<path>/<pid>/<dsid>``; file names may be percent-encoded."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    part = [F.try_url_decode(F.regexp_extract("path", r"([^/]+)/([^/]+)$", i)) for i in (1, 2)]
    return files.select(part[0].alias("pid"), part[1].alias("ds_id"), F.lit(200).alias("status"), "content")
