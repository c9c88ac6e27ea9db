"""Language-model scores: a log-bilinear model trained in numpy with noise-contrastive estimation, normalised when it scores.

Tokens are the words of a text and one end. Training documents give, over the whole corpus, every word's count and the counts of neighbouring
classes; the ``CLASSES`` most frequent words (the end among them) are classes of their own, all others are the class "rest". The model scores
class w after class v as (R_v C) . Q_w + b_w. As it looks back one class, the table of class pairs holds all that training needs, so
training takes whole matrices: data pairs are told from noise drawn from the class frequencies. Its size depends on ``CLASSES`` only. Scores use
the softmax over all classes, computed once as a product of matrices; within "rest" a word has (c + 0.5) over the sum of these, with one
unknown word at 0.5. So probabilities over the known words and one unknown word add up to 1, as in the base.

Counts of the ``FREQUENT`` words are broadcast (a fixed number); rarer words of a document are joined with the count table on the word. No such word
can be hot, as more frequent ones never get there. Sums per document come back by a row number.

Defined results: null and empty texts are one end. A null id counts as an empty one (not held out). Repeated rows are learned from and scored
each. If no document is left to learn from, all counts are zero and the base divides by 0.5. Long texts are taken whole.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_scratch
from .rows import as_rows, field, slices

CLASSES, FREQUENT = 1024, 50_000
DIMENSION, STEPS, NOISE, RATE, SEED = 24, 120, 10, 0.05, 7
END = b"\n"  # no word holds a line feed
FLUSH = 200_000


def tokens_of(text: bytes) -> list[bytes]:
    words = text.lower().split()  # of bytes: A-Z only, parted by ASCII white space only
    words.append(END)
    return words


def word_counts(train: DataFrame, text_col: str) -> DataFrame:
    """``word, c`` over all training texts; tasks add up before the shuffle."""

    def work(batches):
        held: Counter = Counter()

        def rows():
            words = list(held)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([held[w] for w in words], pa.int64())], ["word", "c"])

        for _, texts in slices(batches, text_col):
            for text in texts.to_pylist():
                held.update(tokens_of(text))
                if len(held) > FLUSH:
                    yield rows()
                    held.clear()
        yield rows()

    return as_rows(train, [text_col]).mapInArrow(work, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def class_pairs(train: DataFrame, text_col: str, class_of, classes: int) -> np.ndarray:
    """How often class j follows class i; tasks send sums of at most ``classes`` squared cells."""

    def work(batches):
        get, rest = class_of.value.get, classes - 1
        total = np.zeros(classes * classes, np.int64)
        for _, texts in slices(batches, text_col):
            for text in texts.to_pylist():
                own = np.array([get(w, rest) for w in tokens_of(text)], np.int64)
                before = np.concatenate([[0], own[:-1]])  # a text begins after an end
                cells, n = np.unique(before * classes + own, return_counts=True)
                total[cells] += n
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], ["cell", "n"])

    made = as_rows(train, [text_col]).mapInArrow(work, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = made.toArrow()
    out = np.zeros(classes * classes)
    out[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return out.reshape(classes, classes)


def train_table(pairs: np.ndarray, dimension: int = DIMENSION, steps: int = STEPS, noise: int = NOISE, rate: float = RATE, seed: int = SEED) -> np.ndarray:
    """log10 P(class j after class i) of the trained model, for all pairs.

    The estimate's expectation over data and noise is taken in full: data pair counts against ``noise`` times the context's count times the noise
    probability. Steps are Adam's.
    """
    n = len(pairs)
    total = max(pairs.sum(), 1.0)
    data, context = pairs / total, pairs.sum(axis=1, keepdims=True) / total
    share = (pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * n)
    log_noise = np.log(noise * share)
    rng = np.random.default_rng(seed)
    weights = {"R": rng.normal(0, 0.1, (n, dimension)), "C": np.eye(dimension), "Q": rng.normal(0, 0.1, (n, dimension)), "b": np.log(share)}
    first = {k: np.zeros_like(w) for k, w in weights.items()}
    second = {k: np.zeros_like(w) for k, w in weights.items()}
    for step in range(1, steps + 1):
        predicted = weights["R"] @ weights["C"]
        delta = np.clip(predicted @ weights["Q"].T + weights["b"] - log_noise, -40, 40)
        is_data = 1.0 / (1.0 + np.exp(-delta))
        pull = data * (1.0 - is_data) - noise * context * share * is_data
        back = pull @ weights["Q"]
        slopes = {"R": back @ weights["C"].T, "C": weights["R"].T @ back, "Q": pull.T @ predicted, "b": pull.sum(axis=0)}
        for k, slope in slopes.items():
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            weights[k] += rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    scores = weights["R"] @ weights["C"] @ weights["Q"].T + weights["b"]
    top = scores.max(axis=1, keepdims=True)
    return (scores - top - np.log(np.exp(scores - top).sum(axis=1, keepdims=True))) / math.log(10)


@dataclass
class Model:
    """What scoring needs; all of it of fixed size."""

    frequent: dict[bytes, tuple[int, int]]  # word to class and count
    table: np.ndarray
    n: int
    v: int
    rest: float  # the sum of c + 0.5 within the rest, the unknown word included

    @property
    def log_base(self) -> float:
        return math.log10(self.n + 0.5 * (self.v + 1))


def fit(train: DataFrame, counts: DataFrame, text_col: str, classes: int = CLASSES, frequent: int = FREQUENT) -> Model:
    """Learn from ``train``, with its word counts at hand."""
    spark = train.sparkSession
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc(F.col("word") == F.lit(END)), F.desc("c"), "word").limit(frequent).collect()
    ranked = [(bytes(r.word), r.c) for r in top] or [(END, 0)]
    class_of = {w: k for k, (w, _) in enumerate(ranked[: classes - 1])}
    size = len(class_of) + 1
    table = train_table(class_pairs(train, text_col, spark.sparkContext.broadcast(class_of), size))
    own = ranked[: size - 1]
    rest = (n - sum(c for _, c in own)) + 0.5 * max(v - len(own), 0) + 0.5
    return Model({w: (class_of.get(w, size - 1), c) for w, c in ranked}, table, n, v, rest)


def score_texts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES, frequent: int = FREQUENT) -> DataFrame:
    """``id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row; base 10 logarithms."""
    spark = docs.sparkSession
    out = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1
    counts_path = in_scratch(spark, "word-counts")
    train = docs.where(~out)
    word_counts(train, text_col).write.parquet(counts_path)
    counts = spark.read.parquet(counts_path)
    shared = spark.sparkContext.broadcast(fit(train, counts, text_col, classes, frequent))

    def work(batches):
        model = shared.value
        rest, number = len(model.table) - 1, TaskContext.get().partitionId() << 40
        unseen = (rest, -1)
        for batch, texts in slices(batches, text_col):
            columns = [[], [], [], [], []]
            words, sizes, times = [], [], []
            for text in texts.to_pylist():
                tokens = tokens_of(text)
                found = np.array([model.frequent.get(w, unseen) for w in tokens], np.int64)
                kind, c = found[:, 0], found[:, 1]
                known = c >= 0
                logs = np.log10(c[known] + 0.5)
                score = model.table[np.concatenate([[0], kind[:-1]]), kind].sum() + logs[kind[known] == rest].sum() - math.log10(model.rest) * (kind == rest).sum()
                rare = Counter([tokens[i] for i in np.flatnonzero(~known)])
                words += rare
                times += rare.values()
                sizes.append(len(rare))
                for column, x in zip(columns, (number, len(tokens), int((c > 0).sum()), logs.sum() - len(tokens) * model.log_base, score), strict=True):
                    column.append(x)
                number += 1
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            rare = pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(times, pa.int64())], ["word", "times"])
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [field(batch, id_col), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)), pa.ListArray.from_arrays(offsets, rare)],
                ["id", "at", "n_tokens", "n_known", "base_score", "score", "rare"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    made_path = in_scratch(spark, "word-scores")
    as_rows(docs, [id_col, text_col]).mapInArrow(
        work, f"id {id_type}, at bigint, n_tokens bigint, n_known bigint, base_score double, score double, rare array<struct<word: binary, times: bigint>>"
    ).write.parquet(made_path)
    made = spark.read.parquet(made_path)
    rare = made.select("at", F.explode("rare").alias("r")).select("at", "r.word", "r.times").join(counts, "word", "left")
    c = F.coalesce("c", F.lit(0))
    sums = rare.groupBy("at").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more_known"), F.sum(F.col("times") * F.log10(c + 0.5)).alias("more"),
    )
    more = F.coalesce("more", F.lit(0.0))
    held_out = F.pmod(F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1
    return made.drop("rare").join(sums, "at", "left").select(
        "id", held_out.alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(shared.value.n).cast("bigint").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"),
    )
