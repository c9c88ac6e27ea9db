"""Exact top-k search by inner product with vector-approximation files.

Vectors become integers, floor(``SCALE`` * x). Equal vectors are one representative with the ``k`` + 1 smallest of its rows: no other of its
rows can be among the best ``k`` of a query, its own row left out. Representatives are written in blocks of at most ``BLOCK``; a block keeps the
smallest component of each dimension, the width of its cells, and one byte per component, the cell. A query's inner product with a vector lies
between bounds that follow from the cells.

* Scan: every block of queries meets every block of cells once, by an equi-join on block numbers; a task keeps the ``k`` + 1-th best lower bound of each
  query over the blocks that it has seen and passes on the vectors whose upper bound reaches it.
* Read: exact vectors are read in the order of their bounds (best first), ``CHUNK`` per query, then twice as many with every round; a query is done
  when the next bound lies below its ``k`` + 1-th exact score. Nothing that the bounds don't exclude is left out, whatever the number.

The compared pairs are queries times distinct vectors, as the task asks; what is shuffled for them are cells, one byte a component, once per block of
queries. A row is told apart from its like by a number given when the rows are written.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do those whose integer form is 2^31 or longer (their scores
need not fit a long). Vectors of different lengths aren't compared; an empty vector scores 0 with others. Ids that repeat are rows of their own, and
a query finds them; a null id is never a query, and the last among ties. Fewer than ``k`` others: all of them. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_scratch, in_scratch

K, SCALE = 5, 256
BLOCK, QUERY_BLOCK = 16384, 4096
BLOCK_ENTRIES = 1 << 20  # a block of long vectors holds fewer
BLOCKS_PER_GROUP = 8  # blocks of cells that a task goes through with the same queries
CELLS = 256
CHUNK = 24
SIDE = 256  # queries bounded at a time


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int, is_query: Column) -> DataFrame:
    """``id, row, asks, dim, vec`` of the rows that take part; ``vec`` holds little-endian 32-bit integers."""
    own = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.monotonically_increasing_id().alias("row"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = own.where(F.col("vector").isNotNull() & F.forall("vector", finite)).select("id", "row", F.coalesce(is_query, F.lit(False)).alias("asks"), "vector")

    def work(batches):
        for batch in batches:
            kept, dims, vecs = [], [], []
            for i, v in enumerate(batch["vector"]):
                with np.errstate(over="ignore"):
                    x = np.floor(np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64) * scale)
                    short = np.sqrt(np.sum(x * x)) < 2**31
                if short:
                    kept.append(i)
                    dims.append(len(x))
                    vecs.append(x.astype("<i4").tobytes())
            own = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [own["id"], own["row"], own["asks"], pa.array(dims, pa.int32()), pa.array(vecs, pa.binary())], ["id", "row", "asks", "dim", "vec"]
            )

    return rows.mapInArrow(work, f"id {own.schema['id'].dataType.simpleString()}, row bigint, asks boolean, dim int, vec binary")


def order(score: Column | None = None) -> list[Column]:
    """Best first: high scores, small ids, null last."""
    return [*([score.desc()] if score is not None else []), F.col("id").asc_nulls_last(), F.col("row").asc()]


def representatives(rows: DataFrame, keep: int) -> DataFrame:
    """``node, dim, vec, members``: distinct vectors; ``node`` is the row number of the first, ``members`` are the ``keep`` smallest rows."""
    place = F.row_number().over(Window.partitionBy("dim", "vec").orderBy(*order()))
    few = rows.select("id", "row", "dim", "vec", place.alias("place")).where(F.col("place") <= keep)
    first = F.min(F.struct("place", "row"))["row"]
    return few.groupBy("dim", "vec").agg(first.alias("node"), F.collect_list(F.struct("id", "row")).alias("members")).select("node", "dim", "vec", "members")


def blocks(reps: DataFrame, size: int, cells: bool) -> DataFrame:
    """``dim, nodes, low, width, data``: the vectors of a task in blocks; as cells, or as they are (then without ``low`` and ``width``)."""

    def pack(dim: int, nodes: list[int], vecs: list[bytes]) -> dict:
        x = np.frombuffer(b"".join(vecs), "<i4").reshape(len(nodes), dim)
        low, width, data = b"", b"", x.tobytes()
        if cells:
            least = x.min(axis=0).astype(np.int64)
            step = np.maximum(-(-(x.max(axis=0) - least + 1) // CELLS), 1)
            low, width, data = least.astype("<i8").tobytes(), step.astype("<i8").tobytes(), ((x - least) // step).astype(np.uint8).tobytes()
        return {"dim": dim, "nodes": np.array(nodes, "<i8").tobytes(), "low": low, "width": width, "data": data}

    schema = pa.schema([("dim", pa.int32()), ("nodes", pa.binary()), ("low", pa.binary()), ("width", pa.binary()), ("data", pa.binary())])

    def work(batches):
        held: dict[int, tuple[list[int], list[bytes]]] = {}
        rows = 0
        for batch in batches:
            for node, dim, vec in zip(*[batch[c].to_pylist() for c in ("node", "dim", "vec")], strict=True):
                nodes, vecs = held.setdefault(dim, ([], []))
                nodes.append(node)
                vecs.append(vec)
                rows += 1
                full = len(nodes) >= min(size, max(BLOCK_ENTRIES // max(dim, 1), 1))
                if full or rows >= 2 * size:  # the second with vectors of many lengths
                    for d in [dim] if full else list(held):
                        rows -= len(held[d][0])
                        yield pa.RecordBatch.from_pylist([pack(d, *held.pop(d))], schema=schema)
        for d, (nodes, vecs) in held.items():
            yield pa.RecordBatch.from_pylist([pack(d, nodes, vecs)], schema=schema)

    return reps.select("node", "dim", "vec").mapInArrow(work, "dim int, nodes binary, low binary, width binary, data binary")


def bounds(queries: np.ndarray, low: np.ndarray, width: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Middle of the bounds of each query's scores, and the distance of the bounds from it.

    A cell holds ``width`` integers, so its middle is off by (width - 1) / 2 at most; the last term covers rounding.
    """
    q = queries.astype(np.float64)
    half = (width - 1) / 2
    middle = (q * width) @ cell.astype(np.float64).T + (q @ (low + half))[:, None]
    most = np.abs(q) @ (np.abs(low) + CELLS * width)
    return middle, np.abs(q) @ half + most * (len(low) + 8) * 2.0**-52


def scan(pairs: DataFrame, keep: int) -> DataFrame:
    """``query, node, upper``: what the bounds leave of each pair of blocks."""
    schema = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("upper", pa.float64())])

    def work(batches):
        at, reached = None, None
        for batch in batches:
            for r in batch.to_pylist():
                dim, asking, nodes = r["dim"], np.frombuffer(r["asking"], "<i8"), np.frombuffer(r["nodes"], "<i8")
                if r["block"] != at:
                    at, reached = r["block"], np.full((len(asking), keep), -np.inf)
                matrix = np.frombuffer(r["queries"], "<i4").reshape(len(asking), dim)
                low, width = np.frombuffer(r["low"], "<i8"), np.frombuffer(r["width"], "<i8")
                cell = np.frombuffer(r["data"], np.uint8).reshape(len(nodes), dim)
                for a in range(0, len(asking), SIDE):
                    middle, off = bounds(matrix[a : a + SIDE], low, width, cell)
                    lower = middle - off[:, None]
                    some = np.partition(lower, len(nodes) - keep, axis=1)[:, -keep:] if len(nodes) > keep else lower
                    best = np.sort(np.concatenate([reached[a : a + SIDE], some], axis=1), axis=1)[:, -keep:]
                    reached[a : a + SIDE] = best
                    upper = middle + off[:, None]
                    i, j = np.nonzero(upper >= best[:, :1])
                    yield pa.RecordBatch.from_arrays([pa.array(asking[a + i]), pa.array(nodes[j]), pa.array(upper[i, j])], schema=schema)

    return pairs.mapInArrow(work, "query bigint, node bigint, upper double")


def exact_scores(pairs: DataFrame) -> DataFrame:
    """``query, node, score`` of rows that hold both vectors (``mine``, ``theirs``)."""
    schema = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("score", pa.int64())])

    def work(batches):
        for batch in batches:
            both = zip(batch["mine"].to_pylist(), batch["theirs"].to_pylist(), strict=True)
            scores = [int(np.frombuffer(a, "<i4").astype(np.int64) @ np.frombuffer(b, "<i4").astype(np.int64)) for a, b in both]
            yield pa.RecordBatch.from_arrays([batch["query"], batch["node"], pa.array(scores, pa.int64())], schema=schema)

    return pairs.mapInArrow(work, "query bigint, node bigint, score bigint")


def read_in_order(left: DataFrame, reps: DataFrame, keep: int, chunk: int) -> tuple[DataFrame, list[str]]:
    """Exact scores of all vectors that may be among a query's best ``keep``; and the scratch tables they are read from."""
    spark, used = left.sparkSession, []

    def written(df: DataFrame, name: str) -> DataFrame:
        path = in_scratch(spark, name)
        df.write.parquet(path)
        used.append(path)
        return spark.read.schema(df.schema).parquet(path)

    vec = reps.select("node", F.col("vec").alias("theirs"))
    asks = reps.select(F.col("node").alias("query"), F.col("vec").alias("mine"))
    turn = F.row_number().over(Window.partitionBy("query").orderBy(F.col("upper").desc(), "node"))
    ordered = written(left.withColumn("turn", turn), "topk-order")
    scored, low, high = None, 0, chunk
    now = ordered.where(F.col("turn") <= high)
    while True:
        more = written(exact_scores(now.select("query", "node").join(vec, "node").join(asks, "query").select("query", "node", "mine", "theirs")), "topk-scores")
        scored = more if scored is None else scored.unionByName(more)
        rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "node"))
        certain = scored.withColumn("rank", rank).where(F.col("rank") <= keep).groupBy("query").agg(F.min("score").alias("reached"))
        low, high = high, 2 * high
        # Fewer than ``keep`` scored so far: the query has no more, as a chunk holds at least that many.
        rest = written(ordered.where(F.col("turn") > low).join(certain, "query").where(F.col("upper") >= F.col("reached")).select("query", "node", "turn"), "topk-rest")
        if rest.isEmpty():
            return scored, used
        now = rest.where(F.col("turn") <= high)


def search(
    vectors: DataFrame, *, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE,
    block: int = BLOCK, query_block: int = QUERY_BLOCK, chunk: int = CHUNK,
) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` best other rows of each row for which ``is_query`` (a condition on the column ``id``) holds."""
    spark, keep, used = vectors.sparkSession, k + 1, []

    def written(df: DataFrame, name: str) -> DataFrame:
        path = in_scratch(spark, name)
        df.write.parquet(path)
        used.append(path)
        return spark.read.schema(df.schema).parquet(path)

    rows = written(integers(vectors, id_col, vector_col, scale, is_query), "topk-rows")
    reps = written(representatives(rows, keep), "topk-representatives")
    asking = written(rows.where("asks").select("id", "row", "dim", "vec").join(reps.select("node", "dim", "vec"), ["dim", "vec"]).select("id", "row", "node"), "topk-queries")
    nodes = asking.select("node").distinct()
    # Numbers of blocks, not blocks, reach the driver.
    n_blocks = -(-nodes.count() // query_block)
    asked = reps.join(nodes, "node", "left_semi").repartition(max(n_blocks, 1), "node")
    left = written(blocks(asked, query_block, cells=False).select("dim", F.col("nodes").alias("asking"), F.col("data").alias("queries")).withColumn("block", F.monotonically_increasing_id()), "topk-query-blocks")
    file = written(blocks(reps, block, cells=True).withColumn("number", F.monotonically_increasing_id()), "topk-cells")
    n_groups = max(-(-file.count() // BLOCKS_PER_GROUP), 1)
    numbers = left.select("dim", "block")
    right = file.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(n_groups))).join(numbers, "dim")
    copies = left.withColumn("group", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_groups - 1).cast("bigint"))))
    pairs = right.join(copies, ["dim", "block", "group"]).select("dim", "block", "asking", "queries", "nodes", "low", "width", "data")
    found, more = read_in_order(scan(pairs, keep), reps, keep, max(chunk, keep))
    members = found.join(reps.select("node", "members"), "node").select("query", "score", F.inline("members"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(*order(F.col("score"))))
    best = members.withColumn("place", place).where(F.col("place") <= keep).groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct("place", "id", "row", "score"))).alias("best")
    )
    others = F.slice(F.filter("best", lambda x: x["row"] != F.col("own")), 1, k)
    ranked = asking.select(F.col("id").alias("query_id"), F.col("row").alias("own"), F.col("node").alias("query")).join(best, "query").select(
        "query_id", F.posexplode(others).alias("at", "hit")
    )
    result = written(ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("id"), F.col("hit.score").alias("score")), "topk-result")
    for path in (*used[:-1], *more):
        drop_scratch(spark, path)
    return result
