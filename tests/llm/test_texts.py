"""Operators on texts against brute force, with nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import bpe, decontaminate, line_dedup, simhash, suffix_dedup, token_files
from shelfmark.llm.common import in_scratch, tokenizer_file
from shelfmark.llm.graph import components, smallest
from shelfmark.llm.suffix_sort import sort_rows
from tests.llm import brute
from tests.llm.brute import reach

CLASH = "row string, id string, n_words int, kept string, component_id int, spans int, lost int, start int, h int"


def frame(spark, rows, schema="doc_id bigint, text string"):
    """Rows with extra columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, schema)
    for field in CLASH.split(", "):
        name, kind = field.split(" ")
        df = df.withColumn(name, F.lit("7").cast(kind))
    return df


def texts(seed=1, n=60):
    rng = random.Random(seed)
    words = ["ab", "The", "thé", "x", "Zoë", "13", "don't", "\u4e2d\u6587", "naïve", "lorem", "ipsum", "DOLOR"]
    line = lambda k: " ".join(rng.choice(words) for _ in range(k))
    shared = [line(30) for _ in range(4)]
    out = [(0, None), (1, ""), (2, "\n"), (3, " \t x"), (4, "<|endoftext|>a<|endoftext|>"), (5, "y " * 3000), (6, "a" * 700)]
    for i in range(7, n):
        parts = [rng.choice(shared) if rng.random() < 0.4 else line(rng.randint(0, 25)) for _ in range(rng.randint(1, 6))]
        out.append((i, rng.choice(["\n", " ", "\r\n", "\n\n "]).join(parts)))
    out.append((n, out[10][1]))
    out.append((n + 1, out[11][1] + " tail"))
    return out


def test_line_dedup(spark):
    rows = texts() + [(None, texts()[12][1])]
    rows += rows[:2]  # rows that repeat an id are one document, cleaned alike
    got = line_dedup.dedup_lines(frame(spark, rows), carry=["doc_id", "text"]).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    keys = lambda t: line_dedup.keys_of((t or "").encode(), 40)
    holders: dict = {}
    for i, t in rows:
        for k in keys(t):
            if k is not None:
                holders.setdefault(k, set()).add(-1 if i is None else i)
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [k is not None and len(holders[k]) >= 5 and max(holders[k]) != (-1 if i is None else i) for k in keys(t)]
        want.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    order = lambda r: (r[0] is not None, r[0] or 0, r[3])
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)
    assert sum(w[2] for w in want) > 0


def test_line_key():
    strip = line_dedup.keys_of(("\u00a0" + "é" * 39 + " \v\n" + "É" * 40 + "A\x1c").encode(), 40)
    assert strip == [("\u00a0" + "é" * 39).encode(), ("É" * 40 + "a\x1c").encode()]
    assert line_dedup.keys_of(("é" * 39).encode(), 40) == [None]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 200])
def test_decontamination(spark, block):
    docs = texts()
    items = [("b", docs[10][1]), ("a", "lorem ipsum"), ("c", None), ("d", "?!"), ("e", docs[5][1][:60]), ("f", docs[20][1]), ("f", docs[20][1]), (None, "x")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = decontaminate.find_contamination(frame(spark, docs + docs[9:12]), bench, carry=["doc_id", "text"], block_bytes=block)
    got = found.select("row.doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.array_join("items", ","), 256), "contaminated").collect()
    want = brute.contamination(docs + docs[9:12], [i for i in items if i[0] is not None])
    assert sorted(map(tuple, got)) == sorted(want)
    assert any(w[5] for w in want) and not all(w[5] for w in want)


def test_decontamination_of_long_strings():
    """Test strings of many lengths, at both ends, one inside another, next to look-alikes."""
    rng = random.Random(5)
    for _ in range(30):
        vocabulary = ["a", "b", "aa", "abc", "é"][: rng.randint(1, 5)]
        line = lambda k, v=vocabulary: " ".join(rng.choice(v) for _ in range(k))
        items = [(str(k), line(rng.randint(0, 40))) for k in range(8)]
        docs = [(k, line(rng.randint(0, 90))) for k in range(12)] + [(12, items[0][1]), (13, "b " + items[1][1])]
        hits = decontaminate.Tables([(i, t.encode()) for i, t in items]).hits([t.encode() for _, t in docs])
        for (_, n, hit, own, digest, _), (runs, found, words) in zip(brute.contamination(docs, items), hits, strict=True):
            assert (n, hit, own) == (words, sum(b - a for a, b in runs), len(found))
            assert digest == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_simhash(spark):
    docs = texts() + [(None, "x y z")]
    got = {r.id: r for r in simhash.near_duplicates(frame(spark, docs + docs[8:10])).collect()}
    prints = {i: simhash.fingerprint((t or "").encode()) for i, t in docs}
    ids = [i for i in prints if i is not None]
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    root = reach(ids, links)
    assert prints[0] == prints[1] == prints[2] == 0 and root[2] == 0
    for i in ids:
        assert (got[i].fingerprint, got[i].component_id) == (f"{prints[i]:016x}", root[i])
    assert len(got) == len(prints)


@pytest.mark.parametrize("limit", [256, 4])
def test_near_links_of_crowded_keys(spark, limit):
    """Chains and crowds of near fingerprints; a small limit splits nearly every key."""
    rng = random.Random(2)
    values = {0, (1 << 64) - 1}
    for _ in range(6):
        v = rng.getrandbits(64)
        for _ in range(40):
            values.add(v)
            v ^= 1 << rng.randrange(64) if rng.random() < 0.8 else (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    center = rng.getrandbits(64)
    values |= {center ^ (1 << a) for a in range(64)} | {rng.getrandbits(64) for _ in range(100)}
    signed = [simhash.signed(v) for v in values]
    distinct = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    labels = components(simhash.near_links(distinct, limit=limit))
    got = {r.node: r.component_id for r in smallest(labels, distinct.select(F.col("fp").alias("node"), F.col("fp").alias("id"))).collect()}
    links = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & simhash.ALL).bit_count() <= 2]
    assert got == reach(signed, links)


def test_thresholds():
    costs = [[0, 5, 50, 500], [0, 4, 9, 400], [0, 90, 100, 300]]
    assert simhash.allocate(costs, 2) == [0, 1, -1]
    assert sum(simhash.allocate(costs, 2)) == 2 - 3 + 1
    assert sorted(b for g in simhash.group_bits(0, np.zeros((64, 64))) for b in g) == list(range(64))


def test_bpe(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file(bpe.VOCABULARY))
    docs = texts()
    got = {r.doc_id: r for r in bpe.encode_and_decode(frame(spark, docs), carry=["doc_id", "text"], keep=("ids", "decoded")).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded").collect()}
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert (got[i].ids, got[i].n_tokens, got[i].decoded) == (ids, len(ids), t or "")
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_bpe_pieces_and_merges():
    """Odd characters, endings after apostrophes, white space of all kinds, long runs."""
    from tokenizers import Tokenizer

    path = tokenizer_file(bpe.VOCABULARY)
    library, own, other = Tokenizer.from_file(path), bpe.Bpe(path), token_files.LibraryEncoder(path)
    rng = random.Random(1)
    bits = ["a", "'", "s", "re", "ll", "d", " ", "  ", "\n", "\t", "!?", "12", "é", "\u4e2d", "\u00a0", "\u3000", "\u00bd", "\u216b", "_", "😀", "'S", "\x85", "\u200b", "the", " the", "ation", "\x1c", "\x00", "''", "\u1c89", "\ua7ce"]
    many = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + ["", "a" * 3000, "ab" * 900, " " * 2000, "'" * 40]
    want = [e.ids for e in library.encode_batch(many, add_special_tokens=False)]
    for encode in (own.encode, other):
        assert [e.tolist() for e in encode([t.encode() for t in many])] == want
    assert all(own.decode(np.array(ids, np.int64)).decode() == t for ids, t in zip(want, many, strict=True))
    assert own.decode(np.array([own.id_of[own.bytes_of.index(b"\xe9")]])).decode() == "\ufffd"


def test_token_files(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file(token_files.VOCABULARY))
    docs = texts()
    shuffled = docs[30:] + docs[:30]
    path = in_scratch(spark, "test-tokens")
    token_files.write_tokens(frame(spark, shuffled + [(None, "last")]), path)
    got = token_files.checksums(token_files.read_documents(spark, path, ["doc_id", "n_tokens", "tokens"])).collect()
    start, want = 0, []
    for i, t in [(None, "last"), *docs]:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        want.append((start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got)) == want
    one = token_files.read_documents(spark, path, ["doc_id", "n_tokens"]).where("doc_id = 9")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,9)" in plan and "tokens:array" not in plan
    assert one.count() == 1


@pytest.mark.parametrize("hot", [1000, 2])
def test_suffix_dedup(spark, hot):
    docs = [(i, (t or "")) for i, t in texts(3, 40)]
    docs += [(50, docs[5][1] + "q"), (51, docs[5][1]), (52, "éé" * 200), (53, "z" + "éé" * 150)]
    out = suffix_dedup.remove_repeats(frame(spark, [(i, t or None) for i, t in docs]), carry=["doc_id", "text"], hot=hot)
    got = out.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    want = brute.repeats([(i, t.encode()) for i, t in docs])
    assert sorted(map(tuple, got)) == want
    assert sum(w[2] for w in want) > 1000


def test_suffix_dedup_keeps_one_of_repeated_rows(spark):
    text = "".join(chr(97 + (i * i) % 23) for i in range(300))
    rows = [(None, text), (1, text), (1, text), (2, "x" + text)]
    out = suffix_dedup.remove_repeats(frame(spark, rows), carry=["doc_id", "text"]).select("row.doc_id", "n_removed").collect()
    assert sorted(tuple(r) for r in out if r.doc_id is not None) == [(1, 300), (1, 300), (2, 300)]
    assert [r.n_removed for r in out if r.doc_id is None] == suffix_removed_in_first(text)


@pytest.mark.parametrize("hot", [1000, 2])
def test_suffix_dedup_keeps_repeated_rows_of_two_tasks(spark, hot):
    """Rows that repeat id and text in two partitions, without any other copy: nothing goes, and what a text repeats of itself or of another goes once."""
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh") for _ in range(400))
    other = "".join(rng.choice("abcdefgh") for _ in range(300))
    rows = [(1, text), (None, other), (2, text[50:250] + "-" + text[50:250])]
    df = frame(spark, spark.sparkContext.parallelize(rows * 2, 2))
    out = suffix_dedup.remove_repeats(df, carry=["doc_id", "text"], hot=hot).select("row.doc_id", "n_removed").collect()
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, out), key=key) == [(None, 0)] * 2 + [(1, 0)] * 2 + [(2, 400)] * 2


def suffix_removed_in_first(text):
    return [brute.repeats([(0, text.encode())])[0][2]]


def test_deep_shallow_sort():
    rng = np.random.default_rng(1)
    for letters, n, shallow in ((2, 300, 40), (4, 300, 16), (1, 20, 8), (3, 200, 0)):
        rows = rng.integers(97, 97 + letters, (n, 100)).astype(np.uint8)
        rows[: n // 2, :60] = rows[0, :60]
        rows[: n // 4] = rows[n // 4 - 1]
        order, common = sort_rows(rows, shallow)
        got = [rows[i].tobytes() for i in order]
        assert got == sorted(r.tobytes() for r in rows)
        for k in range(1, n):
            a, b = got[k - 1], got[k]
            assert common[k] == next((j for j in range(100) if a[j] != b[j]), 100)


def test_empty_tables(spark):
    none = frame(spark, [])
    bench = spark.createDataFrame([], "item_id bigint, text string")
    carry = {"carry": ["doc_id", "text"]}
    path = in_scratch(spark, "test-empty")
    token_files.write_tokens(none, path)
    frames = [
        line_dedup.dedup_lines(none, **carry), decontaminate.find_contamination(none, bench, **carry), simhash.near_duplicates(none),
        bpe.encode_and_decode(none, **carry), token_files.read_documents(spark, path, ["doc_id"]), suffix_dedup.remove_repeats(none, **carry),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)
    assert decontaminate.find_contamination(frame(spark, [(1, "a b")]), bench, **carry).first().contaminated is False


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(1, 60)] + [(1000, 1000 + k) for k in range(1, 50)] + [(rng.randint(2000, 2100), rng.randint(2000, 2100)) for _ in range(70)] + [(7, 7)]
    nodes = {x for e in edges for x in e} | {1}
    ids = spark.createDataFrame([(x, x) for x in nodes], "node bigint, id bigint")
    labels = components(spark.createDataFrame(edges + edges[:9], "a bigint, b bigint"))
    assert {r.node: r.component_id for r in smallest(labels, ids).collect()} == reach(nodes, edges)


def test_pieces_that_share_a_hash():
    """A Thue-Morse word and its complement have equal polynomial hashes modulo 2^64, whatever the factor."""
    from tokenizers import Tokenizer

    swap = str.maketrans("ab", "ba")
    one = "a"
    for _ in range(10):
        one += one.translate(swap)
    other = one.translate(swap)
    rows = [f"{one}\n{other}", other, one, f"{other} {one} {other}", f"the {one}"]
    library = Tokenizer.from_file(tokenizer_file(bpe.VOCABULARY))
    want = [library.encode(t, add_special_tokens=False).ids for t in rows]
    for encode in (bpe.bpe_of(bpe.VOCABULARY).encode, token_files.encoder_of(bpe.VOCABULARY)):
        for _ in range(2):
            assert [e.tolist() for e in encode([t.encode() for t in rows])] == want
            assert [encode([t.encode()])[0].tolist() for t in rows] == want


def test_line_dedup_with_a_crowded_line_and_a_crowded_id(spark):
    """A third of the rows share a line, a third have no id; an id's rows lose only lines of their own."""
    line = "a line that a third of all documents have in common, word for word"
    own = [f"line number {i} which is long enough to be looked at and told apart" for i in range(300)]
    rows = [(i, f"{line}\n{own[i]}") for i in range(100)] + [(None, f"{own[i % 7]}\n{own[i]}") for i in range(100, 200)] + [(i, own[i]) for i in range(200, 300)]
    rows += [(300 + i, own[0]) for i in range(6)]
    df = frame(spark, rows).repartition(5)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.kept, r.n_dropped) for r in line_dedup.dedup_lines(df, carry=["doc_id", "text"]).select("row.doc_id", "kept", "n_dropped").collect())
    # Only the first of the seven lines is in five documents or more: those without an id are one.
    want = [(True, i, f"{line}\n{own[i]}" if i == 99 else own[i] if i else "", int(i < 99) + (i == 0)) for i in range(100)]
    want += [(False, 0, own[i] if i % 7 == 0 else f"{own[i % 7]}\n{own[i]}", int(i % 7 == 0)) for i in range(100, 200)]
    want += [(True, i, own[i], 0) for i in range(200, 300)] + [(True, 300 + i, own[0] if i == 5 else "", int(i < 5)) for i in range(6)]
    assert got == sorted(want)


def test_tokens_do_not_depend_on_slices(spark, monkeypatch):
    """Texts beyond one slice, and slices of many texts, with ids and rows that repeat: the same ids and files."""
    rows = texts(5, 30) + [(3, "again"), (3, "again"), (None, "no id"), (99, "long word " * 400)]
    df = frame(spark, rows)

    def made():
        out = bpe.encode_and_decode(df, carry=["doc_id", "text"]).select("row.doc_id", "row.text", "n_tokens", "ids_sha256", "decoded_sha256")
        path = in_scratch(spark, "sliced")
        token_files.write_tokens(df, path)
        files = token_files.checksums(token_files.read_documents(spark, path, ["doc_id", "n_tokens", "tokens"]))
        return sorted(map(str, out.collect())), sorted(map(str, files.collect()))

    whole = made()
    monkeypatch.setattr(bpe, "SLICE", 40)
    monkeypatch.setattr(token_files, "SLICE", 40)
    assert made() == whole and len(whole[0]) == len(whole[1]) == len(rows)
