"""SimHash near-dedup by the generalised pigeonhole principle.

Fingerprints are 64 bits over word shingles; those at most ``distance`` bits apart are linked. Only distinct fingerprints are searched:

1. Bits are cut into partitions; correlated bits come together, from co-occurrence counts over all fingerprints.
2. Partition i gets a threshold T_i of -1 or more with sum ``distance - partitions + 1``. If two fingerprints are near, some partition
   differs by at most its T_i. Dynamic programming takes the thresholds with the fewest estimated candidates, from the counts of all
   fingerprints' partition values.
3. A partition with threshold t gives one key for each choice of t of its bits left out (t = 0: the partition itself). Fingerprints that share
   a key are candidates; they are compared in blocks inside tasks, and a key passes on no more than a label for each fingerprint.
4. A key with more than ``LIMIT`` fingerprints is split by the same principle over the bits it leaves open, until it is small; when 8
   bits are open it must be, as fingerprints differ. So no task holds a large group and no link is lost.

Defined results: null and empty texts have fingerprint zero and are linked like others. Texts with fewer words than a shingle are one shingle.
Repeated rows have one fingerprint. Null ids count only if a component has no other. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, in_scratch, parts
from .graph import components, smallest
from .rows import as_rows, field, slices

SHINGLE, DISTANCE, PARTITIONS = 3, 2, 3
LIMIT = 256
BITS = 64
ALL = (1 << BITS) - 1


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()  # of bytes: A-Z only, and parted by ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        first = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
        last = (ends[shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], 42) for a, b in zip(first, last, strict=True)]
    bits = np.zeros(BITS, np.int64)
    array = np.array(hashes, "<u8")
    for k in range(0, len(array), 1 << 16):
        bits += np.unpackbits(array[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(array), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``id, fp`` of each row; ``fp`` is the fingerprint as a signed 64-bit integer."""

    def work(batches):
        for batch, texts in slices(batches, text_col):
            made = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([field(batch, id_col), pa.array(made)], ["id", "fp"])

    return as_rows(docs, [id_col, text_col]).mapInArrow(work, f"id {docs.schema[id_col].dataType.simpleString()}, fp bigint")


def co_occurrence(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how often each two bits are set together; tasks send 64 x 64 sums."""

    def work(batches):
        n, total = 0, np.zeros((BITS, BITS))
        for batch in batches:
            bits = np.unpackbits(batch["fp"].to_numpy().view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            n += len(bits)
            total += bits.T @ bits
        k = np.arange(BITS * BITS)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(k, -1)), pa.array(np.append(total.ravel(), n).astype(np.int64))], ["k", "n"])

    total, n = np.zeros(BITS * BITS), 0
    for r in distinct.select("fp").mapInArrow(work, "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).collect():
        if r.k < 0:
            n = r.n
        else:
            total[r.k] = r.n
    return n, total.reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray, partitions: int = PARTITIONS) -> list[list[int]]:
    """Cut the bits into equal parts; each part grows by the bit most correlated with it."""
    p = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(p, p)
    scale = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    corr = np.abs(np.divide(cov, scale, out=np.zeros_like(cov), where=scale > 0))
    free, groups = set(range(BITS)), []
    for k in range(partitions):
        size = len(free) // (partitions - k)
        group = [min(free)]
        free.discard(group[0])
        while len(group) < size:
            best = max(sorted(free), key=lambda b: corr[b, group].sum())
            group.append(best)
            free.discard(best)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], distance: int) -> list[int]:
    """Thresholds of -1 or more with sum ``distance - partitions + 1`` and the least sum of ``costs[i][t + 1]``, by dynamic programming."""
    budget = distance + 1  # each threshold plus one
    best = {0: (0.0, [])}
    for own in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(min(budget - used, len(own) - 1) + 1):
                new = (cost + own[t], [*chosen, t - 1])
                if used + t not in step or new < step[used + t]:
                    step[used + t] = new
        best = step
    return best[budget][1]


def mask(bits) -> int:
    return sum(1 << b for b in bits)


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def candidate_costs(distinct: DataFrame, groups: list[list[int]], n: int, together: np.ndarray, distance: int) -> list[list[float]]:
    """Estimated pairs that a partition's keys bring together, by threshold.

    Threshold 0: counted from all partition values. Higher ones: counts times the growth that independent bits would give. A key more costs as
    much as a pair.
    """
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(signed(mask(g)))).alias("v")) for i, g in enumerate(groups)]))
    sizes = distinct.select(values.alias("x")).groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("n"))
    pairs = {r.i: r.p for r in sizes.groupBy("i").agg(F.sum(F.col("n") * F.col("n")).cast("double").alias("p")).collect()}
    p = np.diag(together) / max(n, 1)
    costs = []
    for i, group in enumerate(groups):
        differ = np.clip(2 * p[group] * (1 - p[group]), 0.0, 0.5)
        odds, grown, own = differ / (1 - differ), 1.0, [0.0]
        term = 1.0
        for t in range(distance + 1):
            if t:
                term *= odds.sum() / t
                grown += term
            keys = len(list(combinations(group, t)))
            own.append(keys * n + pairs.get(i, 0.0) * grown)
        costs.append(own)
    return costs


def keys(paths: list[int]) -> Column:
    """A key for each mask of fixed bits; two keys that meet by chance only bring more candidates."""
    fixed = [F.col("fp").bitwiseAND(F.lit(signed(m))) for m in paths]
    return F.explode(F.array(*[F.struct(F.lit(k).alias("path"), F.xxhash64(F.lit(k), f).alias("key")) for k, f in enumerate(fixed)]))


def split_bits(fixed: int, chunks: int) -> list[int]:
    """The mask with one of equal chunks of its open bits added, for each chunk."""
    open_bits = [b for b in range(BITS) if not fixed >> b & 1]
    return [fixed | mask(open_bits[k::chunks]) for k in range(chunks)]


def links_of_sorted(fp: np.ndarray, key: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, its label) of linked fingerprints under one key; rows come sorted by key."""
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(begin, len(key)))
    left, right = [], []
    room = np.repeat(begin + size, size) - np.arange(len(key))  # rows from here to the end of the group
    at = np.flatnonzero(room > 1)
    lag = 1
    bits = fp.view(np.uint64)
    while len(at):
        near = np.bitwise_count(bits[at] ^ bits[at + lag]) <= distance
        left.append(at[near])
        right.append(at[near] + lag)
        lag += 1
        at = at[room[at] > lag]
    if not left:
        return fp[:0], fp[:0]
    a, b = np.concatenate(left), np.concatenate(right)
    label = np.arange(len(fp))
    while True:
        old = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == old).all():
            break
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return fp[moved], fp[label[moved]]


def near_links(distinct: DataFrame, distance: int = DISTANCE, partitions: int = PARTITIONS, limit: int = LIMIT) -> DataFrame:
    """``a, b`` fingerprints whose links connect just those that are linked through near ones."""
    spark = distinct.sparkSession
    n, together = co_occurrence(distinct)
    groups = group_bits(n, together, partitions)
    thresholds = allocate(candidate_costs(distinct, groups, n, together, distance), distance)
    paths = [mask(g) & ~mask(out) for g, t in zip(groups, thresholds, strict=True) if t >= 0 for out in combinations(g, t)]
    rows, out, olds = distinct.select("fp", keys(paths).alias("k")).select("fp", "k.*"), [], []

    def compare(batches):
        fp, key = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            fp, key = np.concatenate([fp, batch["fp"].to_numpy()]), np.concatenate([key, batch["key"].to_numpy()])
            last = np.searchsorted(key, key[-1]) if len(key) else 0  # the last group may go on in the next batch
            a, b = links_of_sorted(fp[:last], key[:last], distance)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
            fp, key = fp[last:], key[last:]
        a, b = links_of_sorted(fp, key, distance)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    while True:
        shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        at = in_scratch(spark, "simhash-keys")
        rows.join(shared, "key").write.parquet(at)
        olds.append(at)
        met = spark.read.parquet(at)
        cold = met.where(F.col("n") <= limit).select("fp", "key").repartition(parts(spark), "key").sortWithinPartitions("key", "fp")
        out.append(cold.mapInArrow(compare, "a bigint, b bigint"))
        hot = met.where(F.col("n") > limit)
        if hot.isEmpty():
            break
        children = [(k, child) for k, m in enumerate(paths) for child in split_bits(m, distance + 1)]
        fixed = [c for _, c in children]
        near = F.array(*[
            F.when(F.col("path") == k, F.struct(F.lit(j).alias("path"), F.xxhash64("key", F.lit(j), F.col("fp").bitwiseAND(F.lit(signed(c)))).alias("key")))
            for j, (k, c) in enumerate(children)
        ])
        rows, paths = hot.select("fp", F.explode(F.filter(near, F.isnotnull)).alias("k")).select("fp", "k.*"), fixed
    links = out[0]
    for more in out[1:]:
        links = links.unionByName(more)
    at = in_scratch(spark, "simhash-links")
    links.distinct().write.parquet(at)
    for old in olds:
        drop_scratch(spark, old)
    return spark.read.parquet(at)


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE,
    partitions: int = PARTITIONS, limit: int = LIMIT,
) -> DataFrame:
    """``id, fingerprint`` (16 hexadecimal digits) and ``component_id`` (smallest id reachable over links) of each row."""
    spark = docs.sparkSession
    path = in_scratch(spark, "simhash")
    fingerprints(docs, id_col, text_col, shingle).write.parquet(path)
    made = spark.read.parquet(path)
    one_path = in_scratch(spark, "simhash-distinct")
    made.groupBy("fp").agg(F.min("id").alias("id")).write.parquet(one_path)
    distinct = spark.read.parquet(one_path)
    labels = components(near_links(distinct, distance, partitions, limit))
    classes = smallest(labels, distinct.withColumnRenamed("fp", "node")).withColumnRenamed("node", "fp")
    return made.join(classes, "fp").select("id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
