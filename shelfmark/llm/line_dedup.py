"""Line dedup: two Bloom filters find suspected repeats; only those shuffle for exact confirmation.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case. Tasks note the keys of their documents in a
once-seen and a twice-seen filter; merged, the second one passes every key that two documents hold (and few others). Suspected keys, as
SHA-256 digests, are counted per document with map-side sums; a key in at least ``min_docs`` documents keeps its lines only in the
largest document id. The digests that a row loses return to it in one array, no longer than its own lines: rows are told apart by id and a hash of the
text, so an id with many rows, the null id too, gathers nothing. Both joins have a written, narrow side of one row a key, which leaves a crowded
key to be split.

The filters have a fixed largest size: with more lines than they hold well, more suspects shuffle and the result is the same.

Defined results: a null or empty text is one empty line. A null id counts as one document that is smaller than all others. Rows that
repeat an id count as one document and are each cleaned. Long texts and lines are taken whole. Other columns are carried or ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import TwoFilters, merge_sections, section_rows, words_for
from .common import drop_scratch, in_scratch, parts, text_of
from .rows import as_rows, binary_texts, field, row_type, slices

BLANK = b" \t\n\v\f\r"
MIN_CHARS, MIN_DOCS = 40, 5
FLUSH = 1 << 16


def keys_of(text: bytes, min_chars: int) -> list[bytes | None]:
    """The key of every line, or none where it is too short."""
    keys = []
    for line in text.split(b"\n"):
        key = line.strip(BLANK).lower()
        if len(key) < min_chars or (len(key) < 4 * min_chars and not key.isascii() and len(key.decode()) < min_chars):
            key = None
        keys.append(key)
    return keys


def line_count(docs: DataFrame, text_col: str) -> int:
    text = F.col(text_col).cast("string")
    n = F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))
    return docs.agg(F.sum(F.coalesce(n, F.lit(0)) + 1)).first()[0] or 0


def suspects(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``id, h, digest`` of each document's keys that the twice-seen filter passes; ``h`` is the hash of the text they come from."""
    spark = docs.sparkSession
    size = words_for(line_count(docs, text_col))
    own = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"), F.xxhash64(text_of(text_col)).alias("h"))
    texts = as_rows(own, ["id", "text", "h"])

    def note(batches):
        filters, held = TwoFilters(size), []
        for _, own in slices(batches, "text"):
            for text in own.to_pylist():
                held += {xxhash.xxh3_64_intdigest(k) for k in keys_of(text, min_chars) if k is not None}
            if len(held) > FLUSH:
                filters.add(np.array(held, np.uint64))
                held = []
        filters.add(np.array(held, np.uint64))
        yield section_rows(filters)

    shared = spark.sparkContext.broadcast(
        merge_sections(texts.mapInArrow(note, "start bigint, once binary, twice binary"), size, parts(spark))
    )

    def suspect(batches):
        seen = TwoFilters(1)
        seen.twice = shared.value
        for batch, own in slices(batches, "text"):
            at, digests = [], []
            for i, text in enumerate(own.to_pylist()):
                keys = list({k for k in keys_of(text, min_chars) if k is not None})
                passed = seen.maybe_twice(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64))
                own_digests = [hashlib.sha256(keys[j]).digest() for j in np.flatnonzero(passed)]
                at += [i] * len(own_digests)
                digests += own_digests
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([field(batch, "id").take(rows), field(batch, "h").take(rows), pa.array(digests, pa.binary())], ["id", "h", "digest"])

    kind = docs.schema[id_col].dataType.simpleString()
    return texts.mapInArrow(suspect, f"id {kind}, h bigint, digest binary")


def dedup_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", carry: list[str], min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """``row`` (the carried columns, which include id and text), ``n_lines, n_dropped`` long, ``kept`` string."""
    spark = docs.sparkSession

    used: list[str] = []

    def written(df: DataFrame, name: str) -> DataFrame:
        used.append(in_scratch(spark, name))
        df.write.parquet(used[-1])
        return spark.read.schema(df.schema).parquet(used[-1])

    pairs = written(suspects(docs, id_col, text_col, min_chars).distinct(), "line-suspects")
    # Of a struct, null sorts first and counts: a null id is the smallest document.
    holder = F.struct("id")
    repeated = pairs.groupBy("digest").agg(F.count_distinct(holder).alias("n"), F.max("id").alias("keeper")).where(F.col("n") >= min_docs)
    repeated = written(repeated.select("digest", "keeper"), "line-repeats")
    lost = written(
        pairs.join(repeated, "digest").where(~F.col("id").eqNullSafe(F.col("keeper"))).groupBy("id", "h").agg(F.collect_list("digest").alias("lost")),
        "line-losses",
    ).select(F.col("id").alias("lost_id"), F.col("h").alias("lost_h"), "lost")
    for path in used[:-1]:
        drop_scratch(spark, path)
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    rows = as_rows(docs, carry).withColumn("id", F.col("row").getField(id_col)).withColumn("h", F.xxhash64(text))
    joined = rows.join(lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("h") == F.col("lost_h")), "left").select("row", "lost")

    def clean(batches):
        for batch, texts in slices(batches, text_col):
            out = []
            for text, lost in zip(texts.to_pylist(), batch["lost"].to_pylist(), strict=True):
                lines = text.split(b"\n")
                if not lost:
                    out.append((len(lines), 0, text))
                    continue
                drop = set(lost)
                keys = keys_of(text, min_chars)
                kept = [x for x, k in zip(lines, keys, strict=True) if k is None or hashlib.sha256(k).digest() not in drop]
                out.append((len(lines), len(lines) - len(kept), b"\n".join(kept)))
            n, dropped, kept = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["row", "n_lines", "n_dropped", "kept"],
            )

    return joined.mapInArrow(clean, f"row {row_type(docs, carry)}, n_lines bigint, n_dropped bigint, kept string")
