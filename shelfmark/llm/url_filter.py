"""URL filter: a blocked Bloom filter of listed keys passes possible hits to an exact hash join.

Listed are canonical URLs (any number) and rules of a host and a path prefix (at most ``max_rules``). Every URL has few keys: its canonical form, and
each suffix of its host with each prefix of its path that is as long as some rule's path. The filter has one 64-bit block a key and a
fixed largest size, so it may be broadcast whatever the length of the list; a longer list only passes more false hits, which the
join removes. Rules go out with the filter and are settled where a page is read, however many pages a rule fits; only pages without a rule whose
canonical URL may be listed go to the join, against a written table of one row a URL, which leaves a crowded URL to be split.

Defined results: a null URL, or one without ``://``, has empty host and path and gets the default verdict. Repeated pages are judged
each. An empty list or an empty page table is fine. Other columns of the pages are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_scratch, lower_ascii

BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 18  # of 64 bits: 2 MB


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.``, ``m.`` and default ports, path without a slash at its end; scheme, query and fragment left out."""
    return F.concat(F.regexp_replace(F.regexp_replace(host, r"^(www|m)\.", ""), r":(80|443)$", ""), F.regexp_replace(path, "/+$", ""))


def block_of(h: Column, blocks: int) -> Column:
    return F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(blocks - 1))


def mask_of(h: Column) -> Column:
    """Four bits of the block."""
    one = F.lit(1).cast("bigint")
    bit = lambda k: F.call_function("shiftleft", one, F.shiftright(h, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
    return bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2)).bitwiseOR(bit(3))


def build_filter(keys: DataFrame, key: str) -> np.ndarray:
    """The filter's blocks: made by tasks, joined by a bitwise sum; at most ``MAX_BLOCKS`` rows reach the driver."""
    blocks = 64
    wanted = keys.count() * BITS_PER_KEY // 64
    while blocks < wanted and blocks < MAX_BLOCKS:
        blocks *= 2
    h = F.xxhash64(key)
    rows = keys.select(block_of(h, blocks).alias("b"), mask_of(h).alias("m")).groupBy("b").agg(F.bit_or("m").alias("m")).collect()
    words = np.zeros(blocks, np.int64)
    for r in rows:
        words[r.b] = r.m
    return words.view(np.uint64)


def possible(rows: DataFrame, shared) -> DataFrame:
    """``id, host, path`` of the rows with the ``rule`` and ``verdict`` that fit, or else the ``url`` if it may be listed.

    ``shared`` holds the filter's words and the rules by key. Of a row's ``keys`` (hashes ``h``) the last is its URL's.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def probe(batches):
        words, rules = shared.value
        for batch in batches:
            keys, hashes = batch["keys"], batch["h"]
            h = hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            word = words[(h >> np.uint64(32)) & np.uint64(len(words) - 1)]
            ok = np.ones(len(h), bool)
            for k in range(4):
                ok &= (word >> ((h >> np.uint64(6 * k)) & np.uint64(63))) & np.uint64(1) == 1
            ends = np.cumsum(hashes.value_lengths().to_numpy(zero_copy_only=False))
            hit = np.flatnonzero(ok)
            owner = np.searchsorted(ends, hit, "right")
            best: list[tuple | None] = [None] * batch.num_rows
            url: list[str | None] = [None] * batch.num_rows
            for i, last, key in zip(owner.tolist(), (hit == ends[owner] - 1).tolist(), keys.flatten().take(pa.array(hit)).to_pylist(), strict=True):
                if last:
                    url[i] = key
                elif (rule := rules.get(key)) is not None and (best[i] is None or rule > best[i]):
                    best[i] = rule
            rule = [b and b[1] for b in best]
            verdict = [b and b[2] for b in best]
            left = [None if b else u for b, u in zip(best, url, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["host"], batch["path"], *(pa.array(c, pa.string()) for c in (rule, verdict, left))], ["id", "host", "path", "rule", "verdict", "key"]
            )

    return rows.mapInArrow(probe, f"id {kind}, host string, path string, rule string, verdict string, key string")


def filter_urls(
    pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], *, id_col: str = "page_id", url_col: str = "url",
    listed_col: str = "canonical", listed_verdict: str = "block", default: str = "allow", max_rules: int = 10_000,
) -> DataFrame:
    """``id_col, host, path, rule, verdict`` of every page.

    ``listed`` holds canonical URLs (see ``canonical``). ``rules``: (verdict, host, path prefix), at most ``max_rules``; a rule fits its host
    and all subdomains if the path starts with the rule's; the longest wins, and a rule wins over the list.
    """
    if len(rules) > max_rules:
        raise ValueError(f"{len(rules)} rules; at most {max_rules}: put whole URLs in the list instead")
    spark = pages.sparkSession
    by_key: dict[str, tuple[int, str, str]] = {}
    for verdict, host, path in rules:
        rule = (len(host + path), host + path, verdict)
        by_key[f"rule {host}{path}"] = max(rule, by_key.get(f"rule {host}{path}", rule))
    listed_at = in_scratch(spark, "listed-urls")
    listed.select(F.concat(F.lit("url "), F.col(listed_col)).alias("key")).where("key is not null").distinct().write.parquet(listed_at)
    urls = spark.read.schema("key string").parquet(listed_at)
    known = spark.createDataFrame([(k,) for k in by_key] or [(None,)], "key string").where("key is not null")
    shared = spark.sparkContext.broadcast((build_filter(urls.unionByName(known), "key"), by_key))

    lengths = sorted({len(path) for _, _, path in rules})
    own = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    heads = F.filter(
        F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths] or [F.lit(None).cast("string")]), F.isnotnull
    )
    rule_keys = F.flatten(F.transform(suffixes, lambda s: F.transform(heads, lambda p: F.concat(F.lit("rule "), s, p))))
    keys = F.array_append(rule_keys, F.concat(F.lit("url "), canonical(F.col("host"), F.col("path"))))
    # The URL's key stays last: a rule's key never equals it.
    keyed = own.withColumn("keys", F.array_distinct(keys))
    # Written, so that texts are parsed and keys are tried once.
    tried_at = in_scratch(spark, "tried-urls")
    tried = possible(keyed.withColumn("h", F.transform("keys", lambda k: F.xxhash64(k))), shared)
    tried.write.parquet(tried_at)
    tried = spark.read.schema(tried.schema).parquet(tried_at)
    settled = tried.where("key is null").select("id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
    found = tried.where("key is not null").join(urls.withColumn("hit", F.lit(listed_verdict)), "key", "left").select(
        "id", "host", "path", "rule", F.coalesce("hit", F.lit(default)).alias("verdict")
    )
    return settled.unionByName(found).withColumnRenamed("id", id_col)
