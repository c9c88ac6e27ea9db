"""Vectors, language model, quality, URL filter and the pipeline: brute force, exact sums, held-out results and odd rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shelfmark.llm import embedding_dedup, lm_score, quality, url_filter
from tests.llm.brute import reach
from tests.llm.test_texts import frame, texts


def test_embedding_dedup(spark):
    rng = np.random.default_rng(4)
    rows = []
    for label in (1, 2):
        centers = rng.standard_normal((8, 16))
        for k in range(120):
            v = centers[k % 8] + rng.standard_normal(16) * rng.choice([0.0, 0.1, 0.25, 0.4])
            rows.append((len(rows), (v * rng.choice([1.0, 1e-3, 50.0])).tolist(), label))
    rows += [(1000, rows[0][1], 1), (1001, rows[0][1], None), (1002, None, 1), (1003, [], 1), (1004, [0.0] * 16, 1), (1005, [1.0] * 15 + [None], 1)]
    rows += [(1006, [1.0] * 15 + [float("nan")], 1), (1007, [float("inf")] * 16, 1), (1008, rows[0][1][:8], 1), (1009, rows[0][1], 2), (1010, [-0.0] + [1.0] * 15, 2), (1011, [0.0] + [1.0] * 15, 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("id", F.lit("x")).withColumn("node", F.lit(1)).withColumn("n", F.lit(2))
    usable = {i: (lab, np.array(v) / np.linalg.norm(v)) for i, v, lab in rows if lab is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a in usable for b in usable if a < b and usable[a][0] == usable[b][0] and len(usable[a][1]) == len(usable[b][1]) and usable[a][1] @ usable[b][1] >= 0.93]
    n = Counter(x for link in links for x in link)
    root = reach([i for i, _, _ in rows], links)
    for block in (1024, 16):
        got = {r.id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df, block=block).collect()}
        assert got == {i: (n[i], root[i], root[i] == i) for i, _, _ in rows}
    assert len(links) > 300
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_calibrated_count():
    need = embedding_dedup.calibrated_count()
    p = math.erf(2 / math.sqrt(2))
    below = lambda k: sum(math.comb(32, j) * p**j * (1 - p) ** (32 - j) for j in range(k))
    assert below(need) <= 1e-6 < below(need + 1)


def test_lm_score(spark):
    rows = texts(9, 150) + [(None, "ab ab")]
    got = {r.id: r for r in lm_score.score_texts(frame(spark, rows), classes=8, frequent=10).collect()}
    counts: Counter = Counter()
    own = {i: lm_score.tokens_of((t or "").encode()) for i, t in rows}
    out = {i: zlib.crc32(str("" if i is None else i).encode()) % 5 == 1 for i in own}
    for i, tokens in own.items():
        if not out[i]:
            counts.update(tokens)
    n, v = sum(counts.values()), len(counts)
    for i, tokens in own.items():
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    assert lm_score.score_texts(frame(spark, [])).count() == 0


def test_lm_is_normalised_and_learns():
    rng = np.random.default_rng(1)
    pairs = rng.integers(0, 5, (12, 12)).astype(float)
    pairs[np.arange(12), (np.arange(12) + 1) % 12] += 400  # a cycle
    table = lm_score.train_table(pairs)
    assert np.allclose((10**table).sum(axis=1), 1)
    share = np.log10(pairs.sum(axis=0) / pairs.sum())
    assert (pairs * table).sum() > 0.5 * (pairs * share).sum()
    assert np.allclose((10 ** lm_score.train_table(np.zeros((2, 2)))).sum(axis=1), 1)


def labelled(seed, n):
    rng = random.Random(seed)
    syllables = ["an", "er", "to", "li", "mo", "ka"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 80))]
        kind = rng.choice(["good"] * 6 + ["shout", "table", "insult"])
        if kind == "shout":
            words = [w.upper() + "!!" for w in words]
        elif kind == "table":
            words = [x for w in words for x in (w, "|")]
        elif kind == "insult":
            words[rng.randrange(len(words))] = rng.choice(["idiot", "moron"])
        docs.append((i, " ".join(words), rng.choice(["a", "a", "b", None]), rng.choice(["x", "y"])))
        labels.append((i, int(kind not in ("shout", "table")), int(kind == "insult")))
    return docs, labels


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(1, 900)
    docs += [(900, None, "sparse", "x"), (901, "", None, None)]
    known = [r for r in labels if r[0] % 2] + [(None, 1, 0), (3, None, 0)]
    df = frame(spark, docs, "doc_id bigint, text string, source string, lang string")
    out = quality.judge(df, spark.createDataFrame(known, "doc_id bigint, quality int, toxic int"), carry=["doc_id", "text", "source", "lang"])
    got = {r.doc_id: r for r in out.select("row.doc_id", "score", "prior", "kept").collect()}
    assert len(got) == len(docs)
    test = [(i, q == 1 and t == 0) for i, q, t in labels if i % 2 == 0]
    right = sum(got[i].kept == good for i, good in test)
    assert right / len(test) > 0.97
    assert all(got[i].kept for i, good in test if good) or sum(not got[i].kept for i, good in test if good) <= 3


def test_quality_equals_brute_force(spark):
    """Priors and scores from the evidence, with sparse and crowded sites, null sites, repeated rows and ids, a long text and clashing columns."""
    docs, labels = labelled(3, 300)
    docs = [(i, t, "hot" if i % 3 == 0 else h, p) for i, t, h, p in docs] + [(900, None, None, None), (901, "", "alone", "x"), (902, "word " * 30_000, "alone", "y"), docs[0], docs[0], (0, "other text", "a", "x")]
    df = frame(spark, docs, "doc_id bigint, text string, source string, lang string").withColumn("host", F.lit("h")).withColumn("p", F.lit(1)).withColumn("hn", F.lit(2))
    out = quality.judge(df, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), carry=["doc_id", "text", "source", "lang", "p"])
    got = out.select("row.doc_id", "row.source", "row.lang", "evidence", "prior", "score", "kept").collect()
    assert len(got) == len(docs)
    own = {r for r, *_ in docs if r < 300}
    good = {i for i, q, t in labels if q == 1 and t == 0}
    centre = math.log(len(good) / len(own) / (1 - len(good) / len(own)))
    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    p = [sigmoid(r.evidence + centre) for r in got]
    path_of, host_of = [(r.source, r.lang) for r in got], [r.source for r in got]
    sums = lambda keys: {k: (sum(1 for x in keys if x == k), sum(v for x, v in zip(keys, p, strict=True) if x == k)) for k in set(keys)}
    paths, hosts = sums(path_of), sums(host_of)
    world = sum(p) / len(p)

    def weight(rows):  # mean, number, centre
        noise = np.mean([c * (1 - c) / n for _, n, c in rows])
        spread = max(np.mean([(m - c) ** 2 for m, _, c in rows]) - noise, 1e-6)
        return max(np.mean([c * (1 - c) for _, _, c in rows]) / spread - 1, 1.0)

    w = weight([(s / n, n, world) for n, s in hosts.values()])
    means = {h: (s + w * world) / (n + w) for h, (n, s) in hosts.items()}
    v = weight([(s / n, n, means[k[0]]) for k, (n, s) in paths.items()])
    for r, own_p, k, h in zip(got, p, path_of, host_of, strict=True):
        host = (hosts[h][1] - own_p + w * world) / (hosts[h][0] - 1 + w)
        prior = (paths[k][1] - own_p + v * host) / (paths[k][0] - 1 + v)
        assert r.prior == pytest.approx(min(max(prior, 1e-6), 1 - 1e-6), rel=1e-6)
        odds = r.evidence + math.log(r.prior / (1 - r.prior))
        assert r.score == pytest.approx(sigmoid(odds), rel=1e-6) and r.kept == (odds >= 0)


def test_quality_sample_is_bounded_by_rows(spark):
    """Ids that repeat give one row each."""
    docs = spark.createDataFrame([(i % 4, f"text {i}") for i in range(400)] + [(None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0), (2, 1, 0), (2, 1, 0)], "doc_id bigint, quality int, toxic int")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    assert quality.sample_of(docs, labels, good, "doc_id", "text", 2).count() == 2
    rows = quality.sample_of(docs, labels, good, "doc_id", "text", 100).collect()
    assert sorted(r.good for r in rows) == [0, 1, 1]


def test_quality_without_labels(spark):
    docs, _ = labelled(2, 10)
    df = frame(spark, docs, "doc_id bigint, text string, source string, lang string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    keep = ["doc_id", "text", "source", "lang"]
    assert [r.kept for r in quality.judge(df, labels, carry=keep).collect()] == [True] * 10
    assert quality.judge(df.limit(0), labels, carry=keep).count() == 0


def test_site_priors_shrink_sparse_sites(spark):
    rows = [("big", "p", 1000, 900.0), ("big", "q", 2, 0.0), ("low", "p", 500, 100.0), ("new", "p", 1, 0.0)]
    got = {(r.host, r.path): r.prior for r in quality.site_priors(spark.createDataFrame(rows, "host string, path string, n bigint, s double")).collect()}
    assert abs(got["big", "p"] - 0.9) < 0.02 and abs(got["low", "p"] - 0.2) < 0.05
    assert got["new", "p"] > 0.02 and got["big", "q"] > 0.02  # not down at their own means of zero


def test_url_filter(spark):
    urls = [
        "http://A.Net/x", "https://www.example.net/en/1", "https://sub.example.com/de/2#f", "http://bad.example.com/en/9?q", "http://notexample.net", "x", None, "",
        "ftp://org/fr/", "http://a.org/fr", "http://m.bad.example.com:80/en/9/", "http://net?x/y", "http://h/a://b.net/",
    ]
    rows = [(i, u) for i, u in enumerate(urls)] + [(1, urls[1])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumn("host", F.lit("q")).withColumn("rule", F.lit(1)).withColumn("key", F.lit(2))
    listed = spark.createDataFrame([("bad.example.com/en/9",), ("bad.example.com/en/9",), (None,)], "canonical string")
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    got = {}
    for r in url_filter.filter_urls(pages, listed, rules).collect():
        got.setdefault(r.page_id, []).append((r.host, r.path, r.rule, r.verdict))
    assert got[0] == [("a.net", "/x", "net/", "block")]
    assert got[1] == [("www.example.net", "/en/1", "example.net/en/", "allow")] * 2
    assert got[2] == [("sub.example.com", "/de/2", "example.com/de/", "block")]
    assert got[3] == [("bad.example.com", "/en/9", None, "block")]
    assert got[4] == [("notexample.net", "", None, "allow")]
    assert got[5] == got[6] == got[7] == [("", "", None, "allow")]
    assert got[8] == [("org", "/fr/", "org/fr/", "allow")] and got[9] == [("a.org", "/fr", None, "allow")]
    assert got[10] == [("m.bad.example.com:80", "/en/9/", None, "block")]
    assert got[11] == [("net", "", None, "allow")] and got[12] == [("h", "/a://b.net/", None, "allow")]
    assert url_filter.filter_urls(pages.limit(0), listed.limit(0), []).count() == 0
    assert {r.verdict for r in url_filter.filter_urls(pages, listed.limit(0), []).collect()} == {"allow"}


def test_url_filter_when_the_filter_is_full(spark, monkeypatch):
    """With a filter far too small the join still removes all false hits."""
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 64)
    listed = spark.range(3000).select(F.concat(F.lit("h/"), F.col("id") * 2).alias("canonical"))
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"))
    got = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, listed, []).collect()}
    assert got == {i: "block" if i % 2 == 0 else "allow" for i in range(400)}


def test_pipeline_stages(spark, tmp_path):
    """Each stage against its operator's brute force, on rows that carry every column."""
    docs, labels = labelled(3, 400)
    line = "the very same line of boilerplate words in many documents here"
    docs = [(i, (line + "\n" if i % 3 == 0 else "") + t, s or "c", lang, len(t)) for i, t, s, lang in docs] + [(400, docs[0][1] + "!", "a", "x", 1), (401, None, None, None, None)]
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs += [(402, item, "a", "x", 5), (403, docs[8][1], "a", "x", 7)]
    schema = "doc_id bigint, text string, source string, lang string, n_chars bigint"
    for name, df in (
        ("documents", spark.createDataFrame(docs, schema)), ("labels", spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")),
        ("benchmark", spark.createDataFrame([(1, item)], "item_id bigint, text string")),
    ):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    frames = [spark.read.parquet(f"{tmp_path}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], str(tmp_path)).cache())
    assert all(f.columns == frames[0].columns for f in frames[:-1])
    kept = {r.doc_id for r in frames[1].collect()}
    good = {i for i, q, t in labels if q and not t}
    assert len(good - kept) <= 2 and len((kept & set(range(400))) - good) <= 4
    assert sum(line in (r.text or "") for r in frames[2].collect()) == 1
    assert all(r.n_chars == len(r.text) for r in frames[2].collect())
    ids = {r.doc_id for r in frames[3].collect()}
    assert 403 not in ids or 8 not in ids
    assert 402 in ids and 402 not in {r.doc_id for r in frames[4].collect()}
    assert {r.doc_id for r in frames[5].collect()} == ids - {402}
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, run.collect())) == sorted(map(str, frames[5].collect()))


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Empty documents, labels and benchmark; no ``n_chars``; columns named like those that the stages use inside."""
    schema = "doc_id bigint, text string, source string, lang string, row string, kept string, number int, `__kept` int"
    for name, kind in (("documents", schema), ("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    rows = [(1, "some words here", "a", None, "r", "k", 1, 2), (1, "some words here", "a", None, "r", "k", 1, 2), (None, None, None, None, None, None, None, None), (2, "other words entirely, and more", "b", "x", "s", "l", 3, 4)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "source", "lang", "row", "kept", "number", "__kept"], name
    assert sorted((r.doc_id or 0, r.text, r.row, r["__kept"]) for r in docs.collect()) == [(0, "", None, None), (1, "some words here", "r", 2), (2, "other words entirely, and more", "s", 4)]


def test_pipeline_keeps_one_row_of_each_group(spark, tmp_path):
    """Repeated rows, one id with two texts, and copies without an id."""
    rng = random.Random(8)
    a, b, c, d = (" ".join(str(rng.randrange(10**6)) for _ in range(40)) for _ in range(4))
    rows = [(1, a), (1, a), (2, b), (5, b), (None, b), (0, c), (2, c), (None, d), (None, d), (3, None), (3, ""), (None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents")
    docs = spark.read.parquet(f"{tmp_path}/documents").withColumn("n_chars", F.length("text"))
    out = corpus_pipeline.simhash(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    got = sorted((r.text or "", -1 if r.doc_id is None else r.doc_id) for r in out.collect())
    assert got == sorted([(a, 1), (b, 2), (c, 0), (d, -1), ("", 3)])


def test_url_filter_with_a_crowded_rule_and_a_crowded_url(spark):
    """Pages under a rule never reach the join, and one listed URL may have any number of pages."""
    rows = [(i, f"http://h{i}.net/x") for i in range(200)] + [(200 + i, "https://www.listed.com/a/") for i in range(200)] + [(400, "http://free.com/a")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    listed = spark.createDataFrame([("listed.com/a",), ("h5.net/x",)], "canonical string")
    out = url_filter.filter_urls(pages, listed, [("allow", "net", "/"), ("block", "net", "/")], default="allow")
    got = {r.page_id: (r.rule, r.verdict) for r in out.collect()}
    assert got == {**{i: ("net/", "block") for i in range(200)}, **{200 + i: (None, "block") for i in range(200)}, 400: (None, "allow")}
    assert url_filter.filter_urls(pages, listed.limit(0), []).where("verdict <> 'allow'").count() == 0
    assert url_filter.filter_urls(pages.limit(0), listed, []).count() == 0


def test_lm_score_without_anything_to_learn_from(spark):
    """All documents held out, with columns named like the results and a very long text."""
    out = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    rows = [(out[0], "a b"), (out[1], None), (out[2], "word " * 20_000)]
    df = frame(spark, rows).withColumn("score", F.lit("s")).withColumn("base_score", F.lit("b")).withColumn("at", F.lit("t")).withColumn("word", F.lit("w"))
    got = {r.id: r for r in lm_score.score_texts(df).collect()}
    assert all(r.held_out and r.n_known == 0 and r.train_tokens == 0 for r in got.values())
    assert {i: r.n_tokens for i, r in got.items()} == {out[0]: 3, out[1]: 1, out[2]: 20_001}
    # Nothing is known: each token has 0.5 of 0.5.
    assert all(abs(r.base_score) < 1e-9 and math.isfinite(r.score) for r in got.values())
