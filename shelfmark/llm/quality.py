"""Quality classifier by hierarchical empirical Bayes.

A logistic model on at most ``SAMPLE`` labelled rows (a fixed bound; features are words, heads of words and the shape of the text) gives each document
evidence for "good": its log odds without the prior. Over all documents, hosts and paths get posteriors: a host's mean probability is shrunk towards
the global one, a path's towards its host's, each by a weight estimated from the spread between hosts or paths (method of moments), so sparse
sites stay near their prior. A document's log odds are its evidence plus its path's prior, from the sums without the document itself; below even odds it is rejected.

Site sums are grouped aggregations with map-side sums, so a host with a third of the rows is no burden. The site table is written out, so the
planner knows its size when it joins it to the documents: a small one is broadcast, a large one is joined by shuffle with skew splitting.

``FEATURES`` and ``LEAST_DEVIATIONS`` are parameters of the model, as its sample is: the words that part the labelled rows are few, and more of them
than the sample can tell apart from chance would not be learned.

Defined results: null and empty texts have the shape of an empty text. Null hosts and paths are a site of their own. Repeated rows count and are
judged each. Repeated labels of an id count as good only if all are; labels without an id or with nulls are left out. Without usable labels of both kinds
all evidence is zero and every document is kept. Other columns are carried or ignored as asked.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, in_scratch
from .decontaminate import words_of
from .rows import as_rows, field, row_type, slices

SAMPLE, FEATURES = 20_000, 1024
LEAST_DOCS, LEAST_DEVIATIONS = 3, 4.0
HEADS = (4, 5)
STEPS, RATE, DECAY = 400, 0.05, 1e-4
FLUSH = 200_000
EVIDENCE_LIMIT = 30.0

_MARKS = re.compile(rb"[!-/:-@\[-`{-~]{2,}")
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def word_features(text: bytes) -> set[bytes]:
    """Words and marked heads of words."""
    words = set(words_of(text))
    return words | {w[:n] + b"~" for w in words for n in HEADS if len(w) > n}


def shape(text: bytes) -> list[float]:
    """Shares of capitals, runs of marks, bare marks, repeated words and punctuation, each also on a log scale; the length."""
    tokens = text.split()
    n, size = max(len(tokens), 1), max(len(text), 1)
    capitals = len(text) - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    bare = sum(1 for t in tokens if len(t) <= 3 and not t.translate(None, _PUNCTUATION))
    again = sum(a == b for a, b in zip(tokens, tokens[1:], strict=False))
    marks = len(text) - len(text.translate(None, _PUNCTUATION))
    shares = [capitals / size, sum(1 for _ in _MARKS.finditer(text)) / n, bare / n, again / n, marks / size]
    return [*shares, *(math.log(s + 0.002) for s in shares), math.log1p(len(tokens))]


SHAPES = len(shape(b""))


class Classifier:
    """Weights of the chosen words and of the shape; of fixed size."""

    def __init__(self, words: list[bytes], weights: np.ndarray, mean: np.ndarray, scale: np.ndarray, prior: float):
        self.words = dict(zip(words, weights[: len(words)].tolist(), strict=True))
        self.shape, self.bias, self.mean, self.scale, self.prior = weights[len(words) : -1], float(weights[-1]), mean, scale, prior

    def evidence(self, text: bytes) -> float:
        get, total = self.words.get, 0.0
        for w in word_features(text):
            total += get(w, 0.0)
        z = np.clip((np.array(shape(text)) - self.mean) / self.scale, -10, 10)
        value = total + float(z @ self.shape) + self.bias - math.log(self.prior / (1 - self.prior))
        return min(max(value, -EVIDENCE_LIMIT), EVIDENCE_LIMIT)


def sample_of(docs: DataFrame, labels: DataFrame, good: Column, id_col: str, text_col: str, sample: int) -> DataFrame:
    """At most ``sample`` labelled documents, in the order of a hash of the id."""
    own = labels.select(F.col(id_col).alias("id"), good.cast("int").alias("good")).where("id is not null and good is not null")
    one = own.groupBy("id").agg(F.min("good").alias("good")).orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(one), "id")  # at most ``sample`` rows of two numbers
    # Rows that repeat an id give one: that with the smallest hash of its text. So the bound holds for rows as well.
    first = F.min(F.struct(F.xxhash64("text").alias("place"), "text"))
    return found.groupBy("id", "good").agg(first.alias("first")).select("first.text", "good")


def choose_words(rows: DataFrame, features: int, good: int, bad: int) -> list[bytes]:
    """At most ``features`` words whose document shares differ between good and bad by ``LEAST_DEVIATIONS`` or more."""

    def work(batches):
        held: Counter = Counter()

        def out():
            keys = list(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in keys], pa.binary()), pa.array([held[k] if k[1] else 0 for k in keys], pa.int64()), pa.array([0 if k[1] else held[k] for k in keys], pa.int64())],
                ["word", "good", "bad"],
            )

        for batch, texts in slices(batches, "text"):
            for text, kind in zip(texts.to_pylist(), field(batch, "good").to_pylist(), strict=True):
                held.update((w, kind) for w in word_features(text))
                if len(held) > FLUSH:
                    yield out()
                    held.clear()
        yield out()

    counts = as_rows(rows, ["text", "good"]).mapInArrow(work, "word binary, good bigint, bad bigint").groupBy("word").agg(F.sum("good").alias("a"), F.sum("bad").alias("b"))
    p = (F.col("a") + F.col("b") + 1.0) / (good + bad + 2.0)
    z = F.abs(F.col("a") / good - F.col("b") / bad) / F.sqrt(p * (1 - p) * (1 / good + 1 / bad))
    best = counts.where((F.col("a") + F.col("b") >= LEAST_DOCS) & (z >= LEAST_DEVIATIONS)).orderBy(z.desc(), "word").limit(features)
    return sorted(bytes(r.word) for r in best.collect())


def train(docs: DataFrame, labels: DataFrame, good: Column, id_col: str, text_col: str, sample: int = SAMPLE, features: int = FEATURES) -> Classifier | None:
    """The classifier, or none without labels of both kinds. The driver gets the numbers of the chosen features of the sample."""
    spark = docs.sparkSession
    path = in_scratch(spark, "quality-sample")
    sample_of(docs, labels, good, id_col, text_col, sample).write.parquet(path)
    rows = spark.read.parquet(path)
    kinds = {r.good: r["count"] for r in rows.groupBy("good").count().collect()}
    if len(kinds) < 2:
        drop_scratch(spark, path)
        return None
    words = choose_words(rows, features, kinds[1], kinds[0])
    place = spark.sparkContext.broadcast({w: k for k, w in enumerate(words)})

    def work(batches):
        get = place.value.get
        for batch, texts in slices(batches, "text"):
            own = texts.to_pylist()
            hits = [[k for w in word_features(t) if (k := get(w)) is not None] for t in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hits, pa.list_(pa.int32())), pa.array([shape(t) for t in own], pa.list_(pa.float64())), field(batch, "good").cast(pa.int32())],
                ["hits", "shape", "good"],
            )

    made = as_rows(rows, ["text", "good"]).mapInArrow(work, "hits array<int>, shape array<double>, good int").toArrow()
    drop_scratch(spark, path)
    y = made["good"].to_numpy().astype(float)
    hits = made["hits"].combine_chunks()
    column = hits.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(y)), hits.value_lengths().to_numpy(zero_copy_only=False))
    dense = made["shape"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), SHAPES)
    mean, scale = dense.mean(axis=0), dense.std(axis=0) + 1e-3
    dense = np.clip((dense - mean) / scale, -10, 10)
    n, prior = len(y), float(y.mean())
    w, first, second = (np.zeros(len(words) + SHAPES + 1) for _ in range(3))
    w[-1] = math.log(prior / (1 - prior))
    for step in range(1, STEPS + 1):
        score = np.bincount(row, w[column], n) + dense @ w[len(words) : -1] + w[-1]
        miss = 1 / (1 + np.exp(-np.clip(score, -40, 40))) - y
        slope = np.concatenate([np.bincount(column, miss[row], len(words)), dense.T @ miss, [miss.sum()]]) / n + DECAY * np.append(w[:-1], 0)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Classifier(words, w, mean, scale, prior)


def shrink_weight(mean_col: str, size_col: str, centre: Column) -> Column:
    """Method of moments: documents that the level above is worth, from the spread of means beyond what chance explains."""
    noise = F.avg(centre * (1 - centre) / F.col(size_col))
    spread = F.greatest(F.avg((F.col(mean_col) - centre) ** 2) - noise, F.lit(1e-6))
    return F.greatest(F.avg(centre * (1 - centre)) / spread - 1, F.lit(1.0))


@dataclass(frozen=True)
class Shrinkage:
    """The global mean, and how many documents it is worth to a host, and a host's mean to a path."""

    world: float
    host: float
    path: float


def shrinkage(paths: DataFrame) -> Shrinkage | None:
    """From the sums ``host, path, n, s`` over all documents: their number and the sum of their probabilities."""
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"))
    world = hosts.agg((F.sum("hs") / F.sum("hn")).alias("m")).first().m
    if world is None:
        return None
    world = min(max(world, 1e-6), 1 - 1e-6)
    w = hosts.withColumn("hm", F.col("hs") / F.col("hn")).agg(shrink_weight("hm", "hn", F.lit(world)).alias("w")).first().w
    means = hosts.select("host", ((F.col("hs") + w * world) / (F.col("hn") + w)).alias("hm"))
    both = paths.join(means, "host").withColumn("pm", F.col("s") / F.col("n"))
    return Shrinkage(world, w, both.agg(shrink_weight("pm", "n", F.col("hm")).alias("w")).first().w)


def with_hosts(paths: DataFrame) -> DataFrame:
    """The sums per path, and those of its host (``hn``, ``hs``)."""
    return paths.join(paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs")), "host")


def shrunk(by: Shrinkage, without: Column | None = None) -> Column:
    """A path's posterior mean from ``n, s, hn, hs``; ``without`` is the probability of one document that is left out of all four."""
    one, p = (F.lit(0), F.lit(0.0)) if without is None else (F.lit(1), without)
    host = (F.col("hs") - p + by.host * by.world) / (F.col("hn") - one + by.host)
    return (F.col("s") - p + by.path * host) / (F.col("n") - one + by.path)


def site_priors(paths: DataFrame) -> DataFrame:
    """``host, path, prior`` from the sums ``host, path, n, s``: what a further document of the site starts from."""
    by = shrinkage(paths)
    return with_hosts(paths).select("host", "path", (F.lit(0.5) if by is None else shrunk(by)).alias("prior"))


def judge(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", path_col: str = "lang",
    good: Column | None = None, carry: list[str], sample: int = SAMPLE, features: int = FEATURES,
) -> DataFrame:
    """``row`` (the carried columns, which include the text, host and path), ``evidence``, ``prior``, ``score`` (probability of good), ``kept``."""
    spark = docs.sparkSession
    good = (F.col("quality") == 1) & (F.col("toxic") == 0) if good is None else good
    model = spark.sparkContext.broadcast(train(docs, labels, good, id_col, text_col, sample, features))

    def work(batches):
        classifier = model.value
        for batch, texts in slices(batches, text_col):
            made = [classifier.evidence(t) if classifier is not None else 0.0 for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.float64())], ["row", "evidence"])

    # Evidence is written with its row: texts are classified once, and later passes read what they need.
    scores_path, sums_path = in_scratch(spark, "quality-scores"), in_scratch(spark, "quality-sums")
    site = lambda c: F.coalesce(F.col("row").getField(c).cast("string"), F.lit("\u0000null"))
    centre = 0.0 if model.value is None else math.log(model.value.prior / (1 - model.value.prior))
    made = as_rows(docs, carry).mapInArrow(work, f"row {row_type(docs, carry)}, evidence double")
    scored = made.select("row", "evidence", site(host_col).alias("host"), site(path_col).alias("path"), (1 / (1 + F.exp(-(F.col("evidence") + centre)))).alias("p"))
    scored.write.parquet(scores_path)
    scored = spark.read.schema(scored.schema).parquet(scores_path)
    scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s")).write.parquet(sums_path)
    sums = spark.read.schema("host string, path string, n bigint, s double").parquet(sums_path)
    by = shrinkage(sums)
    judged = scored.join(with_hosts(sums), ["host", "path"])
    # A document's own probability is in its evidence already, so its site's sums go without it.
    prior = F.lit(0.5) if by is None else shrunk(by, F.col("p"))
    prior = F.least(F.greatest(prior, F.lit(1e-6)), F.lit(1 - 1e-6))
    odds = F.col("evidence") + F.log(prior / (1 - prior))
    if model.value is None:
        odds = F.lit(0.0)
    return judged.select("row", "evidence", prior.alias("prior"), (1 / (1 + F.exp(-odds))).alias("score"), (odds >= 0).alias("kept"))
