"""Embedding near-dedup by collision-counting projections.

Vectors of one label are linked when their cosine in double precision is at least ``threshold``. On unit vectors that is a distance of at most
r = sqrt(2 - 2 * threshold). ``PROJECTIONS`` random one-dimensional projections (normal components, so a pair at distance s differs by a normal with
deviation s) are sorted; a pair collides in one if one vector lies in the window of ``WINDOW`` * r around the other. Pairs are verified if they collide
at least as often as the calibrated count: the largest one that a pair at distance r misses with a probability of at most ``MISS``. A first,
unit-length direction moves no linked pair by more than r, so only blocks that lie within r along it meet.

Equal vectors are one representative with a multiplicity. A cell along the first direction is dealt over blocks of about ``BLOCK`` representatives, and
each pair of blocks that may hold links is one task group of bounded size, whatever share of the rows a label or a cluster has. Groups give
counts and labels, never pairs. The number of compared pairs still grows with the square of a label's vectors within r of each other along
the first direction; labels are what keeps that small.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and those without a label, link with nothing (no
links, own component, kept). Vectors of different lengths never link. Rows that repeat an id are vectors of their own. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_scratch
from .graph import components, smallest

THRESHOLD = 0.93
PROJECTIONS, WINDOW, MISS = 32, 2.0, 1e-6
BLOCK = 1024
SEED = 20


def calibrated_count(projections: int = PROJECTIONS, window: float = WINDOW, miss: float = MISS) -> int:
    """The largest count that a pair at distance r falls short of with probability ``miss`` at most."""
    p = math.erf(window / math.sqrt(2))
    below, count = 0.0, 0
    while count < projections:
        below += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if below > miss:
            break
        count += 1
    return count


@cache
def directions(dim: int, projections: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((projections + 1, dim))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Scaled by the largest component first, so that neither huge nor tiny ones overflow."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def first_place(vectors: np.ndarray) -> np.ndarray:
    lead = directions(vectors.shape[1])[0]
    return unit(vectors) @ (lead / np.linalg.norm(lead))


def linked(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked vectors: windows of each left vector over the sorted projections of the right ones, counted and verified."""
    need, reach = calibrated_count(), WINDOW * math.sqrt(2 - 2 * threshold)
    x, y = unit(left), unit(right)
    lines = directions(left.shape[1])[1:].T
    p, q = x @ lines, y @ lines
    count = np.zeros((len(x), len(y)), np.uint8)
    every = np.arange(len(x))
    for k in range(lines.shape[1]):
        order = np.argsort(q[:, k])
        line = q[order, k]
        edge = np.zeros((len(x), len(y) + 1), np.int8)
        edge[every, np.searchsorted(line, p[:, k] - reach, "left")] += 1
        edge[every, np.searchsorted(line, p[:, k] + reach, "right")] -= 1
        count[:, order] += np.cumsum(edge[:, :-1], axis=1, dtype=np.int8).view(np.uint8)
    a, b = np.nonzero(count >= need)
    near = np.concatenate([np.einsum("ij,ij->i", x[a[k : k + 65536]], y[b[k : k + 65536]]) >= threshold for k in range(0, len(a), 65536)] or [np.zeros(0, bool)])
    return a[near], b[near]


def labels_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest place that each of ``n`` places reaches over the links."""
    label = np.arange(n)
    while len(a):
        old = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == old).all():
            break
    return label


def representatives(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``id, label, dim, place, bin, node`` of the rows; ``bin`` is null for vectors that link with nothing."""
    own = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    types = {f.name: f.dataType.simpleString() for f in own.schema.fields}
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("label").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0.0)
    ready = own.withColumn("vector", F.when(F.coalesce(usable, F.lit(False)), F.col("vector")))

    def work(batches):
        for batch in batches:
            places, bins, dims = [], [], []
            for v in batch["vector"]:
                v = v.values
                x = None if v is None else v.to_numpy(zero_copy_only=False) + 0.0  # -0.0 becomes 0.0
                places.append(None if x is None else float(first_place(x[None])[0]))
                bins.append(None if x is None else x.astype("<f8").tobytes())
                dims.append(None if x is None else len(x))
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["label"], pa.array(dims, pa.int32()), pa.array(places, pa.float64()), pa.array(bins, pa.binary())],
                ["id", "label", "dim", "place", "bin"],
            )

    made = ready.mapInArrow(work, f"id {types['id']}, label {types['label']}, dim int, place double, bin binary")
    # A node is a 64-bit hash of label and vector.
    return made.withColumn("node", F.when(F.col("bin").isNotNull(), F.xxhash64("label", "bin")))


def block_pairs(reps: DataFrame, reach: float, block: int) -> DataFrame:
    """Each representative once for every pair of blocks that it belongs to: ``pair`` and ``side``."""
    cells = reps.groupBy("label", "dim", "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    own = reps.join(cells, ["label", "dim", "cell"]).withColumn("part", F.pmod(F.shiftright("node", 8), F.col("blocks").cast("bigint")).cast("int"))
    around = own.withColumn("other", F.explode(F.array(*[F.col("cell") + k for k in (-1, 0, 1)]))).drop("blocks")
    met = around.join(cells.withColumnRenamed("cell", "other"), ["label", "dim", "other"])
    met = met.withColumn("other_part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mine, theirs = F.struct(F.col("cell").alias("c"), F.col("part").alias("p")), F.struct(F.col("other").alias("c"), F.col("other_part").alias("p"))
    return met.select(
        F.struct("label", "dim", F.least(mine, theirs).alias("x"), F.greatest(mine, theirs).alias("y")).alias("pair"),
        F.when(mine == theirs, 0).when(mine < theirs, 1).otherwise(2).alias("side"), "node", "n", "bin",
    )


def near_duplicates(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """``id, n_links`` (other vectors linked directly), ``component_id`` (smallest id reachable), ``kept`` (id is the component's) of each row."""
    spark = vectors.sparkSession
    reach = math.sqrt(2 - 2 * threshold)
    path = in_scratch(spark, "vectors")
    representatives(vectors, id_col, vector_col, label_col).write.parquet(path)
    rows = spark.read.parquet(path)
    reps = rows.where("node is not null").groupBy("node", "label", "dim", "place", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
    rep_path = in_scratch(spark, "vector-representatives")
    reps.withColumn("cell", F.floor(F.col("place") / reach).cast("int")).write.parquet(rep_path)
    reps = spark.read.parquet(rep_path)

    def compare(table: pa.Table) -> pa.Table:
        side, node, n = (table[c].to_numpy() for c in ("side", "node", "n"))
        order = np.lexsort((node, side))
        x = np.frombuffer(b"".join(table["bin"].to_pylist()), "<f8").reshape(len(side), -1)[order]
        side, node, n = side[order], node[order], n[order]
        cut = int((side < 2).sum()) if side[0] else len(side)
        if side[0]:
            a, b = linked(x[:cut], x[cut:], threshold) if 0 < cut < len(x) else (np.zeros(0, int),) * 2
            b = b + cut
        else:
            a, b = linked(x, x, threshold)
            a, b = a[a < b], b[a < b]
        total = np.zeros(len(node), np.int64)
        np.add.at(total, a, n[b])
        np.add.at(total, b, n[a])
        label = labels_of(len(node), a, b)
        some = np.flatnonzero(total > 0)
        return pa.table({"node": node[some], "links": total[some], "label": node[label[some]]})

    pairs = block_pairs(reps, reach, block)
    found_path = in_scratch(spark, "vector-links")
    pairs.groupBy("pair").applyInArrow(compare, "node bigint, links bigint, label bigint").write.parquet(found_path)
    found = spark.read.parquet(found_path)
    labels = components(found.select(F.col("node").alias("a"), F.col("label").alias("b")))
    classes = smallest(labels, reps.select("node", "id"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    result = reps.select("node", "n").join(counts, "node", "left").join(classes, "node").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"
    )
    some = rows.where("node is not null").select("id", "node").join(result, "node").select("id", "n_links", "component_id")
    none = rows.where("node is null").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return some.unionByName(none).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
