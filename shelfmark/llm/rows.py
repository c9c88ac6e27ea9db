"""Rows handed to Python functions: a struct of the columns to keep, and whole texts in slices of bounded size."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 8 << 20
BATCH_BYTES, DEFAULT_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def as_rows(docs: DataFrame, columns: list[str]) -> DataFrame:
    """One column ``row`` with the named columns, so that no result column can clash with them.

    Rows are handed over in batches of bounded size, however long texts are; a bound that the session has set stays.
    """
    conf = docs.sparkSession.conf
    if conf.get(BATCH_BYTES) == DEFAULT_BATCH:
        conf.set(BATCH_BYTES, f"{SLICE_BYTES}b")
    return docs.select(F.struct(*columns).alias("row"))


def row_type(docs: DataFrame, columns: list[str]) -> str:
    return docs.select(F.struct(*columns).alias("row")).schema["row"].dataType.simpleString()


def column(rows: Column, name: str) -> Column:
    return rows.getField(name)


def field(batch: pa.RecordBatch, name: str) -> pa.Array:
    row = batch.column(0)
    return row.field(row.type.get_field_index(name))


def binary_texts(values: pa.Array) -> pa.Array:
    """Texts as UTF-8 bytes; null is empty."""
    return pc.fill_null(values.cast(pa.string()).cast(pa.binary()), b"")


def slices(batches, name: str, limit: int = SLICE_BYTES):
    """Cut batches so that a slice's texts hold about ``limit`` bytes at most, or one text; gives the slice and its texts."""
    for batch in batches:
        texts = binary_texts(field(batch, name))
        start, held = 0, 0
        for i, n in enumerate(pc.binary_length(texts).to_pylist()):
            if held + n > limit and i > start:
                yield batch.slice(start, i - start), texts.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start), texts.slice(start)
