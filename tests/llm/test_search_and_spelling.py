"""Whitening, exact search and spelling variants against brute force, with nulls, empty and long inputs, ties, repeated rows and clashing columns."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import spelling, topk_search, whitening

CLASH = "row string, id string, n string, node string, vec string, dim string, x string, word string, data string, best string, key string"
VECTORS = "vec_id bigint, embedding array<float>, label int"


def clashing(df):
    """Extra columns whose names the operators use inside."""
    for f in CLASH.split(", "):
        name, kind = f.split(" ")
        df = df.withColumn(name, F.lit("7").cast(kind))
    return df


def vectors(seed=0, n=120, dim=6):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(v) for v in rng.normal(0, 0.2, dim).astype(np.float32)], i % 3) for i in range(n)]
    rows += [(n + i, rows[50][1], 0) for i in range(30)]  # a group of copies
    rows += [(200, None, 1), (201, [None] + [0.0] * (dim - 1), 1), (202, [float("nan")] * dim, 1), (203, [float("inf")] + [0.0] * (dim - 1), 1)]
    rows += [(204, [0.0] * dim, 1), (250, [0.5, 0.25], None), (251, [0.5, -0.25], None), (300, [], None), (350, [], 2), (None, rows[3][1], None)]
    return [*rows, rows[0], rows[50], rows[50]]


# Exact search


def brute_search(rows, k=5):
    usable = []
    for at, (i, v, _) in enumerate(rows):
        if v is not None and all(c is not None and np.isfinite(c) for c in v):
            usable.append((at, i, [int(np.floor(256 * c)) for c in v]))
    out = []
    for at, i, x in usable:
        if i is None or i % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(x, y, strict=True)), j is None, j or 0, there) for there, j, y in usable if there != at and len(y) == len(x)]
        for rank, (score, none, j, _) in enumerate(sorted(scored)[:k]):
            out.append((i, rank + 1, None if none else j, -score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sizes", [{}, {"block": 7, "query_block": 2, "chunk": 1}])
def test_search_equals_brute_force(spark, sizes):
    rows = vectors()
    got = topk_search.search(clashing(spark.createDataFrame(rows, VECTORS)), is_query=F.col("id") % 50 == 0, **sizes).collect()
    assert sorted(map(tuple, got), key=repr) == brute_search(rows)


def test_search_reads_on_until_the_last_result_is_certain(spark):
    """Cells too wide to tell vectors apart: everything lies within the bounds, and is read in rounds."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(0, 0.05, 4)] + [0.0], 0) for i in range(90)] + [(1001, [0.0, 0.0, 0.0, 0.0, 4000.0], 0), (1002, [-4000.0, 4000.0, 4000.0, 4000.0, 0.0], 0)]
    got = topk_search.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), is_query=F.col("id") % 50 == 0, chunk=1).collect()
    assert sorted(map(tuple, got), key=repr) == brute_search(rows)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-5000, 5000, (300, 9)), rng.integers(-300, 300, (20, 9)).astype("<i4")
    low = x.min(axis=0)
    width = -(-(x.max(axis=0) - low + 1) // topk_search.CELLS)
    middle, off = topk_search.bounds(q, low, width, ((x - low) // width).astype(np.uint8))
    assert (np.abs(q @ x.T - middle) <= off[:, None]).all() and width.max() > 1


def test_search_leaves_out_vectors_too_long_for_a_score(spark):
    rows = [(0, [1e30, 0.0], 0), (50, [1.0, 1.0], 0), (3, [2.0, 0.0], 0)]
    got = topk_search.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), is_query=F.col("id") % 50 == 0).collect()
    assert [tuple(r) for r in got] == [(50, 1, 3, 2 * 256 * 256)]


def test_search_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert topk_search.search(empty, is_query=F.col("id") % 50 == 0).collect() == []
    alone = spark.createDataFrame([(50, [1.0], 0), (1, [1.0], 0)], VECTORS)
    assert [tuple(r) for r in topk_search.search(alone, is_query=F.col("id") % 50 == 0).collect()] == [(50, 1, 1, 65536)]


# Whitening


def brute_whitening(rows, dim, components=16):
    own = [(i, np.floor(64 * np.array(v, np.float64)).astype(np.int64) + 1_000_000) for i, v, _ in rows if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.unique(np.array([x for _, x in own]), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    y = (n * fit - sums) / n
    values, u = np.linalg.eigh(y.T @ y / n)
    values, u = values[::-1][:components], u[:, ::-1][:, :components]
    return own, n, sums, values, u, np.trace(y.T @ y / n)


def test_whitening_equals_a_dense_solver(spark):
    rows = vectors()
    got = whitening.whiten(clashing(spark.createDataFrame(rows, VECTORS))).collect()
    own, n, sums, values, u, trace = brute_whitening(rows, 6)
    assert len(got) == 6 * len(own) and {r["n"] for r in got} == {n}
    for c in range(6):
        mine = sorted(((r["id"] is None, r["id"] or 0, r["whitened"], r["deviation"]) for r in got if r["component"] == c + 1), key=lambda r: r[:2])
        want = sorted(((i is None, i or 0, float((n * x - sums) / n @ u[:, c] / np.sqrt(values[c])), int(((n * x - sums) ** 2).sum())) for i, x in own), key=lambda r: r[:2])
        sign = np.sign(mine[0][2] * want[0][2])
        assert np.allclose([m[2] for m in mine], [sign * w[2] for w in want], atol=1e-9, rtol=0)
        assert [(m[:2], m[3]) for m in mine] == [(w[:2], w[3]) for w in want]
        assert {r["explained"] for r in got if r["component"] == c + 1}.pop() == pytest.approx(values[c] / trace, rel=1e-10)
    assert {r["identity_error"] for r in got}.pop() < 1e-10


@pytest.mark.parametrize("dim,n,spectrum", [(64, 500, 0.2), (200, 400, 0.02), (40, 10, 1.0), (64, 300, None)])
def test_solver_reaches_double_precision(dim, n, spectrum):
    rng = np.random.default_rng(dim)
    if spectrum is None:  # repeated eigenvalues
        cov = np.diag([5.0] * 8 + [1.0] * 40 + [0.0] * 16)
    else:
        x = rng.standard_normal((n, dim)) * np.linspace(1, spectrum, dim)
        cov = x.T @ x / n
    values, u = whitening.jacobi_davidson(lambda v: cov @ v, dim, 16)
    want = np.linalg.eigvalsh(cov)[::-1][: len(values)]
    assert np.abs(values - want).max() < 1e-13 * want[0]
    assert np.linalg.norm(cov @ u - u * values, axis=0).max() < 1e-12 * want[0]
    assert np.abs(u.T @ u - np.eye(len(values))).max() < 1e-13


def test_whitening_without_variance(spark):
    assert whitening.whiten(spark.createDataFrame([], VECTORS)).collect() == []
    one = spark.createDataFrame([(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0), (3, None, 0)], VECTORS)
    assert whitening.whiten(one).collect() == []
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], 0) for i in range(5)], VECTORS)
    got = whitening.whiten(line).collect()
    assert {r["component"] for r in got} == {1} and got[0]["explained"] == pytest.approx(1)
    assert sum(r["whitened"] ** 2 for r in got) / 5 == pytest.approx(1)


def test_whitening_of_large_entries_is_exact_or_null(spark):
    rows = [(1, [2.0**30, 0.0], 0), (2, [-(2.0**30), 1.0], 0), (3, [2.0**10, 5.0], 0), (4, [2.0**41, 0.0], 0)]
    got = {r["id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).where("component = 1").collect()}
    xs = {i: [int(64 * c) + 1_000_000 for c in v] for i, v, _ in rows[:3]}
    sums = [sum(c) for c in zip(*xs.values(), strict=True)]
    want = {i: sum((3 * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for i, x in xs.items()}
    assert got == {i: w if w < 1 << 63 else None for i, w in want.items()} and None in got.values() and any(got.values())


# Spelling variants


def near(words):
    """Pairs that one edit parts, by shared words with one code point deleted."""
    shorter = {}
    for w in words:
        for i in range(len(w)):
            shorter.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    out = set()
    for (a, b), some in shorter.items():
        out |= set(itertools.combinations(sorted(some), 2))
        if a + b in words:
            out |= {tuple(sorted((a + b, w))) for w in some}
    return out


def brute_spelling(rows):
    import re

    count = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                count[run] = count.get(run, 0) + 1
    count = {w: n for w, n in count.items() if n >= 2}
    others = {w: [] for w in count}
    for a, b in near(set(count)):
        others[a].append(b)
        others[b].append(a)
    form = {}
    for w, some in others.items():
        best = min(some, key=lambda o: (-count[o], o), default=None)
        form[w] = best if best is not None and count[best] >= 10 * count[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), count[w], len(others[w]), count[form[w]] if form[w] else 0) for w in count)


def spelled(df, **options):
    out = spelling.spelling_variants(df, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in out)


def prose(seed=2, n=80):
    rng = random.Random(seed)
    stems = ["strasse", "aaaaaaa", "aaaaaaaa", "abababab", "banana" * 2, "Überblick", "zoëtrope", "grammar", "grammars", "gramma", "naïvely", "mississippi", "qqqqqqqq"]

    def variant(w):
        k, at = rng.random(), rng.randrange(len(w))
        if k < 0.1:
            return w[:at] + rng.choice("abgÀ") + w[at:]
        if k < 0.2:
            return w[:at] + w[at + 1 :]
        return w[:at] + rng.choice("abgé") + w[at + 1 :] if k < 0.3 else w

    rows = [(i, " ".join(variant(rng.choice(stems[:3] * 8 + stems)) for _ in range(60))) for i in range(n)]
    long = "x" * 700 + "y" * 700
    rows += [(1000, None), (1001, ""), (1002, f"{long} {long} {long[:-1]}z, {long[:-1]}z {long[1:]} {long[1:]}"), (None, rows[0][1]), rows[1], rows[1]]
    # A chain of forms: each tenfold.
    rows += [(2000, " ".join(["lengthy"] * 200 + ["lengthi"] * 20 + ["lengthib"] * 2))] * 2
    return rows


@pytest.mark.parametrize("limit", [spelling.LIMIT, 3, 1])
def test_spelling_equals_brute_force(spark, limit):
    rows = prose()
    got = spelled(clashing(spark.createDataFrame(rows, "doc_id bigint, text string")), limit=limit)
    assert got == brute_spelling(rows)
    assert any(g[2] not in (g[0], g[1]) for g in got) and any(g[4] > 2 for g in got)


def test_composition_gives_each_pair_once():
    rng = random.Random(3)
    for _ in range(150):
        words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 120))})
        pairs = [tuple(sorted((words[i], words[j]))) for i, j in spelling.Acceptor(words).near_pairs()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == near(set(words))


def test_acceptor_is_minimal():
    """Equal right languages are one state: of all words over two letters only one state a length is left."""
    words = sorted("".join(w) for w in itertools.product("ab", repeat=8))
    assert len(spelling.Acceptor(words).final) == 9


def test_spelling_of_nothing(spark):
    assert spelled(spark.createDataFrame([], "doc_id bigint, text string")) == []
    assert spelled(spark.createDataFrame([(1, None), (2, "short words only")], "doc_id bigint, text string")) == []
    with pytest.raises(ValueError, match="least_length"):
        spelling.spelling_variants(spark.createDataFrame([], "doc_id bigint, text string"), least_length=6)
