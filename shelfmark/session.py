"""Session defaults; what was submitted with the application (or set as a system default) wins over them."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split crowded join partitions even where that costs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def get_spark(app: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    submitted = SparkConf()
    defaults = {key: value for key, value in DEFAULTS.items() if not submitted.contains(key)}
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without: on a cluster every executor would write to a disk of its own, so that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="shelfmark-")
        spark.conf.set("spark.checkpoint.dir", root)
    inner = "".join(f"/{folder}" for folder in getattr(_scopes, "folders", ()))
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}{inner}/{name}-{uuid.uuid4().hex}"


_scopes = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession, name: str) -> Iterator[None]:
    """Scratch folders made inside, by this thread, are deleted at its end."""
    folder = scratch_dir(spark, name)
    _scopes.folders = (*getattr(_scopes, "folders", ()), folder.rsplit("/", 1)[1])
    try:
        yield
    finally:
        _scopes.folders = _scopes.folders[:-1]
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several later jobs need the same intermediate rows: the lineage is cut, lost executors re-read files,
    and the planner sees real sizes.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty_frame(spark: SparkSession, schema: str) -> DataFrame:
    """No rows of ``schema``; the optimizer drops joins with it."""
    fields = StructType.fromDDL(schema).fields
    return spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
