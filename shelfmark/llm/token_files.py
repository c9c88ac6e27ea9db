"""Token ids in Parquet: documents in id order, list columns, controlled row groups and pages, and reading in parts.

A file set is a folder with ``tokens/`` and ``index/``. ``tokens/`` has a row per document: ``part, position, doc_id, part_start, n_tokens, tokens``; files and
rows lie in ascending order of the document id. Token lists are dictionary-encoded (a vocabulary fits one dictionary page, so ids take 16 bits
or less before compression), numbers are delta-encoded, and the page index lets a reader with a filter on ``doc_id`` skip pages and columns.
``index/`` has the first token's number of each part, so a document starts at ``base + part_start``.

Texts are range-partitioned by id once and encoded where they land; no second shuffle and no group holds more than its range. Spark's writer
commits files, so lost executors cost only their own tasks.

Defined results: a null or empty text is only the end id. A null document id comes first. Rows with the same id are all kept, ordered by a hash of
their text, and the range partitioning may split them. An empty table gives an empty file set. Other columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import parts, text_of, tokenizer_file
from .pieces import PieceEncoder
from .rows import slices

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
SLICE = 1 << 20
#: Row groups of 32 MB, pages of 256 KB or 2,000 rows; the second format version has delta encodings.
WRITER = {
    "compression": "zstd", "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": str(32 << 20), "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000", "parquet.enable.dictionary": "true",
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("part", "position", "doc_id", "part_start", "n_tokens")},
}


class LibraryEncoder:
    """The public tokenizers library; pieces that were met before are not encoded again."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bulk = PieceEncoder(self.pieces)

    def pieces(self, pieces: list[bytes]) -> list[list[int]]:
        found = self.tokenizer.encode([p.decode() for p in pieces], is_pretokenized=True, add_special_tokens=False)
        out: list[list[int]] = [[] for _ in pieces]
        for token, word in zip(found.ids, found.word_ids, strict=True):
            out[word].append(token)
        return out

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        plain = [b"" if any(s in t for s in self.special) else t for t in texts]
        ids, after = self.bulk(plain)
        out = [ids[a:b] for a, b in zip([0, *after[:-1].tolist()], after.tolist(), strict=True)]
        for i, (text, own) in enumerate(zip(texts, plain, strict=True)):
            if len(own) != len(text):  # a special token's text: the library sees the whole document
                out[i] = np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.int32)
        return out


@cache
def encoder_of(vocabulary: str) -> LibraryEncoder:
    return LibraryEncoder(tokenizer_file(vocabulary))


def write_tokens(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, end_id: int = END_ID) -> None:
    """Write the file set of ``docs`` to ``path``."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = own.repartitionByRange(parts(spark), *order).sortWithinPartitions(*order).select(F.struct("doc_id", "text").alias("row"))
    kind = own.schema["doc_id"].dataType.simpleString()

    def work(batches):
        encode, part, position, start = encoder_of(vocabulary), TaskContext.get().partitionId(), 0, 0
        for batch, texts in slices(batches, "text", SLICE):
            encoded = [np.append(e, np.int32(end_id)) for e in encode(texts.to_pylist())]
            sizes = np.array([len(e) for e in encoded], np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            n = len(encoded)
            tokens = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(encoded)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part, np.int32)), pa.array(np.arange(position, position + n)), batch.column(0).field(0),
                    pa.array(start + offsets[:-1]), pa.array(sizes), tokens,
                ],
                ["part", "position", "doc_id", "part_start", "n_tokens", "tokens"],
            )
            position, start = position + n, start + int(offsets[-1])

    made = rows.mapInArrow(work, f"part int, position bigint, doc_id {kind}, part_start bigint, n_tokens bigint, tokens array<int>")
    made.write.options(**WRITER).parquet(f"{path}/tokens")
    # One row a part: the driver adds up as many numbers as there are parts.
    sums = spark.read.parquet(f"{path}/tokens").groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    base, rows_ = 0, []
    for part, n in sorted((r.part, r.n) for r in sums):
        rows_.append((part, base, n))
        base += n
    spark.createDataFrame(rows_, "part int, base bigint, n_tokens bigint").coalesce(1).write.parquet(f"{path}/index")


def read_documents(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """``start`` and the named columns of each document; only these columns are read, and a filter on ``doc_id`` skips pages."""
    base = F.broadcast(spark.read.parquet(f"{path}/index").select("part", "base"))  # one row a part
    own = spark.read.parquet(f"{path}/tokens").select("part", "part_start", *columns)
    return own.join(base, "part").select((F.col("base") + F.col("part_start")).alias("start"), *columns)


def checksums(documents: DataFrame) -> DataFrame:
    """``ids_crc32`` in place of ``tokens``: CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def work(batches):
        for batch in batches:
            tokens = batch["tokens"]
            ids = tokens.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False))
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            keep = [c for c in batch.schema.names if c != "tokens"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(sums, pa.int64())], [*keep, "ids_crc32"])

    fields = [f for f in documents.schema.fields if f.name != "tokens"]
    return documents.mapInArrow(work, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", ids_crc32 bigint")
