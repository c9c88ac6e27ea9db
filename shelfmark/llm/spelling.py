"""Spelling variant grouping by finite-state composition.

A word is near another if exactly one inserted, deleted or replaced code point parts them. The pairs are what the minimised acceptor of the
vocabulary, a transducer that makes exactly one edit, and the acceptor again accept in composition. Before its edit the transducer holds both
acceptors in the same state, so an edit is an arc pair of one state (or an arc and the state itself); after it both walk in lockstep through
equal symbols. States with one arc that accept nothing allow no edit and are joined into labels, so long words cost their length.

The composition is cut by initial states: those that the first ``HEAD`` symbols lead to, of the words and of the reversed words. A near pair of
words of 7 or more code points shares its first three or its last three; pairs of the second kind are counted only where they don't share the
first three, so each pair is found once. A state with more than ``LIMIT`` words behind it is replaced by those one symbol beyond
the place where its words part first; pairs whose edit lies right there are then found by the symbols after the edit, in groups no larger than the
alphabet. So no group grows with the data. Partitions give sums and maxima per word, never pairs.

Words are counted per task before the shuffle. Roots are found by following forms, twice as far in every round; the counts grow tenfold with every
form, so the rounds are few.

Defined results: null texts have no words; a null id counts as the empty text before the colon. Rows that repeat an id are counted again.
Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, in_scratch, parts
from .rows import as_rows, field, slices

LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 7, 2, 10
DELETE_EVERY = 31
HEAD = 3
LIMIT = 4_000
WORDS_HELD = 1 << 18
PLAIN, EDGE = 0, 1

Found = tuple[int, int, str]  # near words, and the count and text of the best of them


def words_of(text: bytes, doc: str, runs: re.Pattern, least: int) -> list[tuple[str, int]]:
    """Words of a document with their counts; one run in 31 loses a code point."""
    seed = zlib.crc32(f"{doc}:".encode())
    out = []
    for run, n in Counter(runs.findall(text.lower().decode(errors="replace"))).items():  # of bytes: A-Z only
        h = zlib.crc32(run.encode(), seed)
        if h % DELETE_EVERY == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < least:
                continue
        out.append((run, n))
    return out


def count_words(docs: DataFrame, id_col: str, text_col: str, least: int = LEAST_LENGTH) -> DataFrame:
    """``word, n`` over all documents."""
    own = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))

    def work(batches):
        # Shorter runs give no words: a run never grows.
        runs, held = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}"), Counter()

        def flush():
            out = pa.RecordBatch.from_pydict({"word": list(held.keys()), "n": list(held.values())}, schema=pa.schema([("word", pa.string()), ("n", pa.int64())]))
            held.clear()
            return out

        for batch, texts in slices(batches, "text"):
            for doc, text in zip(field(batch, "id").to_pylist(), texts.to_pylist(), strict=True):
                for word, n in words_of(text, doc, runs, least):
                    held[word] += n
            if len(held) > WORDS_HELD:
                yield flush()
        yield flush()

    return as_rows(own, ["id", "text"]).mapInArrow(work, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def shared(a: str, b: str) -> int:
    """Length of the common beginning."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    k = 0
    while a[k] == b[k]:
        k += 1
    return k


class Acceptor:
    """Minimal acyclic acceptor of sorted, distinct texts; labels join states that have one arc and accept nothing.

    ``arcs[q]`` maps a first symbol to (rest of the label, target, number of the accepted texts that come before it), so a path numbers its text.
    """

    def __init__(self, texts: list[str]):
        self.final: list[bool] = []
        self.count: list[int] = []
        self.arcs: list[dict[str, tuple[str, int, int]]] = []
        self.known: dict[tuple, int] = {}
        open_: list[list] = [[0, False, []]]  # depth, accepting, arcs as (label, target)
        before = ""
        for text in texts:
            self.close(open_, before, shared(before, text))
            if len(text) == open_[-1][0]:
                open_[-1][1] = True
            else:
                open_.append([len(text), True, []])
            before = text
        self.close(open_, before, 0)
        self.start = self.state(open_[0])

    def close(self, open_: list[list], text: str, depth: int) -> None:
        """Close the states of ``text`` beyond ``depth``."""
        while open_[-1][0] > depth:
            node = open_.pop()
            if open_[-1][0] < depth:
                open_.append([depth, False, []])
            open_[-1][2].append((text[open_[-1][0] : node[0]], self.state(node)))

    def state(self, node: list) -> int:
        key = (node[1], tuple(node[2]))
        if (q := self.known.get(key)) is None:
            q = self.known[key] = len(self.final)
            number, arcs = int(node[1]), {}
            for label, target in node[2]:
                arcs[label[0]] = (label[1:], target, number)
                number += self.count[target]
            self.final.append(node[1])
            self.count.append(number)
            self.arcs.append(arcs)
        return q

    def lockstep(self, x: str, a: int, i: int, y: str, b: int, j: int) -> list[tuple[int, int]]:
        """Numbers of the texts that continue alike from the label rest ``x`` before state ``a`` and from ``y`` before ``b``."""
        out, todo = [], [(x, a, i, y, b, j)]
        while todo:
            x, a, i, y, b, j = todo.pop()
            if x and y:
                if x.startswith(y):
                    todo.append((x[len(y) :], a, i, "", b, j))
                elif y.startswith(x):
                    todo.append(("", a, i, y[len(x) :], b, j))
            elif x:
                if (arc := self.arcs[b].get(x[0])) is not None:
                    todo.append((x[1:], a, i, arc[0], arc[1], j + arc[2]))
            elif y:
                if (arc := self.arcs[a].get(y[0])) is not None:
                    todo.append((arc[0], arc[1], i + arc[2], y[1:], b, j))
            elif a == b:
                out += [(i + k, j + k) for k in range(self.count[a])]
            else:
                if self.final[a] and self.final[b]:
                    out.append((i, j))
                mine, theirs = self.arcs[a], self.arcs[b]
                for s in mine.keys() & theirs.keys():
                    todo.append((mine[s][0], mine[s][1], i + mine[s][2], theirs[s][0], theirs[s][1], j + theirs[s][2]))
        return out

    def edits(self, q: int) -> list[tuple[int, int]]:
        """Numbers, counted from state ``q``, of the pairs whose edit is made there; the edit comes as early as it can."""
        out, arcs = [], list(self.arcs[q].items())
        for k, (c, (x, a, i)) in enumerate(arcs):
            for _, (y, b, j) in arcs[k + 1 :]:  # replaced
                if x[:1] == y[:1] or not x or not y:
                    out += self.lockstep(x, a, i, y, b, j)
            # ``c`` inserted: what follows goes on from ``q`` with another symbol than ``c``, or ends.
            if not x and self.final[q] and self.final[a]:
                out.append((0, i))
            for s in (x[0],) if x else self.arcs[a].keys() & self.arcs[q].keys():
                if s != c and (arc := self.arcs[q].get(s)) is not None:
                    other = (x[1:], a, i) if x else (self.arcs[a][s][0], self.arcs[a][s][1], i + self.arcs[a][s][2])
                    out += self.lockstep(arc[0], arc[1], arc[2], *other)
        return out

    def near_pairs(self):
        """Numbers of all pairs of accepted texts that one edit parts, each once."""
        made: dict[int, list[tuple[int, int]]] = {}
        todo = [(self.start, 0)]
        while todo:
            q, base = todo.pop()
            if (pairs := made.get(q)) is None:
                pairs = made[q] = self.edits(q)
            for i, j in pairs:
                yield base + i, base + j
            todo += [(target, base + number) for _, target, number in self.arcs[q].values()]


def best_of(found: dict[str, Found], word: str, other: str, n: int) -> None:
    near, most, best = found.get(word, (0, 0, ""))
    if n > most or (n == most and other < best):
        most, best = n, other
    found[word] = (near + 1, most, best)


def plain_group(reverse: bool, key: str, texts: list[str], counts: list[int], found: dict[str, Found]) -> None:
    """Near pairs among the words behind one initial state; ``texts`` follow ``key`` and are sorted."""
    words = [(key + t)[::-1] if reverse else key + t for t in texts]
    for i, j in Acceptor(texts).near_pairs():
        a, b = words[i], words[j]
        if not reverse or a[:HEAD] != b[:HEAD]:
            best_of(found, a, b, counts[j])
            best_of(found, b, a, counts[i])


def edge_group(reverse: bool, key: str, tail: str, symbols: list[str], counts: list[int], found: dict[str, Found]) -> None:
    """The same for words that go on alike after an edit at a state: by one symbol each, or none. No more members than symbols, and one."""
    words = [(key + s + tail)[::-1] if reverse else key + s + tail for s in symbols]
    for j, b in enumerate(words):
        for i, a in enumerate(words[:j]):
            # A symbol inserted before its like is an edit further on, found there.
            if "" in (symbols[i], symbols[j]) and tail.startswith(symbols[i] + symbols[j]):
                continue
            if not reverse or a[:HEAD] != b[:HEAD]:
                best_of(found, a, b, counts[j])
                best_of(found, b, a, counts[i])


def groups(vocabulary: DataFrame, limit: int) -> tuple[DataFrame, list[str]]:
    """``kind, reverse, key, tail, symbol, rest, n``: the members of all groups; and the scratch tables they are read from."""
    spark, used = vocabulary.sparkSession, []

    def written(df: DataFrame, name: str) -> DataFrame:
        path = in_scratch(spark, name)
        df.write.parquet(path)
        used.append(path)
        return spark.read.schema(df.schema).parquet(path)

    def members(rows: DataFrame, kind: int, **columns: Column) -> DataFrame:
        none = F.lit("")
        made = {"tail": none, "symbol": none, "rest": none, **columns}
        return rows.select(F.lit(kind).alias("kind"), "reverse", "key", *[c.alias(name) for name, c in made.items()], "n")

    both = F.array(F.struct(F.lit(False).alias("reverse"), F.col("word").alias("text")), F.struct(F.lit(True).alias("reverse"), F.reverse("word").alias("text")))
    left, out = vocabulary.select("n", F.inline(both)).withColumn("depth", F.lit(HEAD)), None
    while True:
        keyed = left.withColumn("key", F.expr("substring(text, 1, depth)"))
        # What all words of a crowded state begin with: where they part first, and no edit lies before.
        parting = F.zip_with(F.split("low", ""), F.split("high", ""), lambda x, y: F.coalesce(x != y, F.lit(True)))
        counted = keyed.groupBy("reverse", "key").agg(F.count(F.lit(1)).alias("members"), F.min("text").alias("low"), F.max("text").alias("high"))
        crowded = written(counted.where(F.col("members") > limit).select("reverse", "key", (F.array_position(parting, True) - 1).cast("int").alias("common")), "spelling-crowded")
        few = keyed if crowded.isEmpty() else keyed.join(crowded, ["reverse", "key"], "left_anti")
        plain = members(few, PLAIN, rest=F.expr("substring(text, depth + 1)"))
        out = plain if out is None else out.unionByName(plain)
        if few is keyed:
            return out, used
        deeper = written(keyed.join(crowded, ["reverse", "key"]).select("reverse", F.expr("substring(text, 1, common)").alias("key"), "text", "n", "common"), "spelling-deeper")
        whole = F.struct(F.expr("substring(text, common + 1)").alias("tail"), F.lit("").alias("symbol"))
        one = F.struct(F.expr("substring(text, common + 2)").alias("tail"), F.expr("substring(text, common + 1, 1)").alias("symbol"))
        longer = F.length("text") > F.col("common")
        edge = deeper.select("reverse", "key", "n", F.inline(F.when(longer, F.array(whole, one)).otherwise(F.array(whole))))
        out = out.unionByName(members(edge, EDGE, tail=F.col("tail"), symbol=F.col("symbol")))
        left = deeper.where(longer).select("n", "reverse", "text", (F.col("common") + 1).alias("depth"))


def near_words(vocabulary: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, list[str]]:
    """``word, near, most, best`` in parts to be added up, for words with near ones; and the scratch tables they are read from."""
    members, used = groups(vocabulary, limit)
    key = ["kind", "reverse", "key", "tail"]
    dealt = members.repartition(parts(vocabulary.sparkSession), *key).sortWithinPartitions(*key, "rest", "symbol")
    out_schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("most", pa.int64()), ("best", pa.string())])

    def work(batches):
        at, texts, counts = None, [], []

        def finish():
            found: dict[str, Found] = {}
            if at is not None and len(texts) > 1:
                kind, reverse, head, tail = at
                if kind == PLAIN:
                    plain_group(reverse, head, texts, counts, found)
                else:
                    edge_group(reverse, head, tail, texts, counts, found)
            near, most, best = zip(*found.values(), strict=True) if found else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(near, pa.int64()), pa.array(most, pa.int64()), pa.array(best, pa.string())], schema=out_schema)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*key, "rest", "symbol", "n")]
            for kind, reverse, head, tail, rest, symbol, n in zip(*columns, strict=True):
                if (kind, reverse, head, tail) != at:
                    if len(texts) > 1 and (out := finish()).num_rows:
                        yield out
                    at, texts, counts = (kind, reverse, head, tail), [], []
                texts.append(rest if kind == PLAIN else symbol)
                counts.append(n)
        if (out := finish()).num_rows:
            yield out

    return dealt.mapInArrow(work, "word string, near bigint, most bigint, best string"), used


def with_roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form (``word, form``)."""
    spark, old = forms.sparkSession, None
    path = in_scratch(spark, "spelling-roots")
    forms.select("word", F.col("form").alias("root")).write.parquet(path)
    while True:
        up = spark.read.schema("word string, root string").parquet(path)
        if old is not None:
            drop_scratch(spark, old)
        above = up.select(F.col("word").alias("root"), F.col("root").alias("above"))
        step = up.join(above, "root", "left")
        if step.where("above is not null").isEmpty():
            return up
        old, path = path, in_scratch(spark, "spelling-roots")
        step.select("word", F.coalesce("above", "root").alias("root")).write.parquet(path)


def spelling_variants(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
    ratio: int = FORM_RATIO, limit: int = LIMIT,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs``. ``least_length`` is 7 or more, ``least_count`` counts occurrences."""
    if least_length < 2 * HEAD + 1:
        raise ValueError(f"least_length must be {2 * HEAD + 1} or more")
    spark = docs.sparkSession
    path = in_scratch(spark, "spelling-words")
    count_words(docs, id_col, text_col, least_length).where(F.col("n") >= least_count).write.parquet(path)
    vocabulary = spark.read.schema("word string, n bigint").parquet(path)
    near, used = near_words(vocabulary, limit)
    nothing = F.lit(None)
    own = vocabulary.select("word", "n", F.lit(0).cast("bigint").alias("near"), nothing.cast("bigint").alias("most"), nothing.cast("string").alias("best"))
    every = own.unionByName(near.select("word", nothing.cast("bigint").alias("n"), "near", "most", "best"))
    best = F.when(F.col("best").isNotNull(), F.struct((-F.col("most")).alias("less"), F.col("best").alias("best")))
    summed = every.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min(best).alias("best"))
    is_form = -F.col("best.less") >= ratio * F.col("n")
    chosen = summed.select("word", "n", "n_near", F.when(is_form, F.col("best.best")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"))
    chosen_path = in_scratch(spark, "spelling-forms")
    chosen.write.parquet(chosen_path)
    for done in (*used, path):
        drop_scratch(spark, done)
    chosen = spark.read.schema(chosen.schema).parquet(chosen_path)
    roots = with_roots(chosen.where("form is not null"))
    return chosen.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
