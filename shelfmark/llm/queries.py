"""One query per operator, each over its whole table, and the SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import embedding_dedup, sql, token_files
from .bpe import encode_and_decode
from .common import in_scratch, table
from .decontaminate import find_contamination
from .line_dedup import dedup_lines
from .lm_score import score_texts
from .quality import judge
from .simhash import near_duplicates
from .spelling import spelling_variants
from .suffix_dedup import remove_repeats
from .topk_search import search
from .url_filter import canonical, filter_urls, host_of, path_of
from .whitening import whiten

QUERIES, ORACLES = {}, {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query("op6_url_filter", sql.URL_FILTER)
def op6_url_filter(spark, sf_dir):
    """Listed are the canonical URLs of pages on hosts with the label ``ads-track``."""
    pages = table(spark, sf_dir, "pages")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    listed = pages.where(F.array_contains(F.split(host, r"\."), "ads-track")).select(canonical(host, path).alias("canonical"))
    return filter_urls(pages, listed, URL_RULES)


@query("op8_decontamination", sql.DECONTAMINATION)
def op8_decontamination(spark, sf_dir):
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id", "text"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


@query("op2_line_dedup", sql.LINE_DEDUP)
def op2_line_dedup(spark, sf_dir):
    out = dedup_lines(table(spark, sf_dir, "documents"), carry=["doc_id", "text"])
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_simhash")
def op4_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op7_bpe")
def op7_bpe(spark, sf_dir):
    out = encode_and_decode(table(spark, sf_dir, "documents"), carry=["doc_id", "text"])
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


@query("op9_token_files")
def op9_token_files(spark, sf_dir):
    path = in_scratch(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.checksums(token_files.read_documents(spark, path, ["doc_id", "n_tokens", "tokens"]))


@query("op1_embedding_dedup", sql.EMBEDDING_DEDUP)
def op1_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op3_lm_score")
def op3_lm_score(spark, sf_dir):
    return score_texts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op5_quality")
def op5_quality(spark, sf_dir):
    """Good is what the labels call of quality and not toxic; sites are sources, and languages within them."""
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), carry=["doc_id", "text", "source", "lang"])
    return judged.select(F.col("row.doc_id").alias("doc_id"), "evidence", "prior", "score", "kept")


@query("op10_suffix_dedup", sql.SUFFIX_DEDUP)
def op10_suffix_dedup(spark, sf_dir):
    out = remove_repeats(table(spark, sf_dir, "documents"), carry=["doc_id", "text"])
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_whitening")
def op11_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op12_topk", sql.TOP_K)
def op12_topk(spark, sf_dir):
    """Queries are the rows whose id is divisible by 50; candidates are all rows."""
    return search(table(spark, sf_dir, "embeddings"), is_query=F.col("id") % 50 == 0).withColumnRenamed("id", "vec_id")


@query("op13_spelling", sql.SPELLING)
def op13_spelling(spark, sf_dir):
    return spelling_variants(table(spark, sf_dir, "documents"))
