"""Search terms of analysed fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import terms
from shelfmark.operators.index_tables import Change, IndexTables

# Analysed fields of the index tables: name of the field -> column.
ANALYSED = {"objects": {"objects.LABEL": "LABEL"}, "datastreams": {"datastreams.LABEL": "LABEL", "datastreams.CONTENT": "CONTENT._content"}}
KEY = ["field", "term", "doc_id"]


def _last_of_run(t: str) -> Column:
    """Last index of every run of equal terms in a sorted array; none for a text without terms."""
    return F.filter(
        F.sequence(F.lit(1), F.greatest(F.size(t), F.lit(1))),
        lambda i: (i == F.size(t)) | (F.get(F.col(t), i) != F.get(F.col(t), i - 1)),
    )


def _counted(t: str, end: str, **marks: Column) -> Column:
    """The runs of a sorted array as ``(term, *marks, n)``, in order."""
    return F.transform(
        F.col(end),
        lambda e, k: F.struct(
            F.get(F.col(t), e - 1).alias("term"), *[mark.alias(name) for name, mark in marks.items()],
            (e - F.coalesce(F.get(F.col(end), k - 1), F.lit(0))).cast("bigint").alias("n"),
        ),
    )


def build_postings(docs: DataFrame, fields: dict[str, str], doc_id: str = "doc_id") -> DataFrame:
    """``field, term, doc_id, n`` for the given ``{field name: text column}``; ``docs`` has one row per document.

    Terms are counted inside the row they come from (sorted, then cut where the term changes), so no token is shuffled.
    """
    texts = F.array(*[F.struct(F.lit(f).alias("field"), F.col(c).alias("text")) for f, c in fields.items()])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.explode(texts).alias("part"))
    ordered = rows.select("doc_id", "part.field", F.sort_array(terms(F.col("part.text"))).alias("t"))
    ends = ordered.select("doc_id", "field", "t", _last_of_run("t").alias("end"))
    return ends.select("field", "doc_id", F.inline(_counted("t", "end"))).select("field", "term", "doc_id", "n")


def document_terms(table: str, rows: DataFrame) -> DataFrame:
    """Postings of rows of an index table."""
    fields = ANALYSED[table]
    texts = [F.col(column).alias(f"_text{i}") for i, column in enumerate(fields.values())]
    return build_postings(rows.select("doc_id", *texts), {name: f"_text{i}" for i, name in enumerate(fields)})


def changed_terms(texts: DataFrame) -> DataFrame:
    """``field, term, doc_id, n`` of the terms that occur another number of times in ``after`` than in ``before`` (``doc_id, field, before,
    after``; null: no text), with n = 0 for those that are gone.

    Both texts of a field are counted and compared inside their row; equal texts are not even split.
    """
    none = F.array().cast("array<string>")
    differ = texts.where(~F.col("before").eqNullSafe(F.col("after")))
    sides = {"b": "before", "a": "after"}
    ordered = differ.select("doc_id", "field", *[F.sort_array(F.coalesce(terms(F.col(c)), none)).alias(t) for t, c in sides.items()])
    ends = ordered.select("*", *[_last_of_run(t).alias(f"{t}_end") for t in sides])
    runs = [_counted(t, f"{t}_end", late=F.lit(t == "a")) for t in sides]
    merged = ends.select("doc_id", "field", F.sort_array(F.concat(*runs)).alias("runs"))
    # A term of both texts makes two neighbours, the earlier text's first.
    beside = lambda k: F.get(F.col("runs"), k)

    def judged(run: Column, k: Column) -> Column:
        same = F.when(run["late"], (beside(k - 1)["term"] == run["term"]) & (beside(k - 1)["n"] == run["n"])).otherwise(
            beside(k + 1)["term"] == run["term"]
        )
        return F.struct(run["term"].alias("term"), F.when(run["late"], run["n"]).otherwise(0).alias("n"), F.coalesce(same, F.lit(False)).alias("same"))

    rows = merged.select("doc_id", "field", F.inline(F.transform("runs", judged)))
    return rows.where(~F.col("same")).select("field", "term", "doc_id", "n")


def postings_change(tables: IndexTables, changes: dict[str, Change], keep=lambda df, name: df) -> Change:
    """What becomes of the postings when the tables change: terms that are new or occur another number of times, and terms that are gone.

    Of the tables only the analysed fields of documents that change are read. The texts of a document before and after meet in one row, so
    terms are neither made of texts that stay as they are nor shuffled to be compared.
    """
    pairs = None
    for name, fields in ANALYSED.items():
        change, table = changes[name], tables.named()[name]
        texts = table.select("doc_id", "PID", *{c.split(".")[0] for c in fields.values()})
        written = change.rows.select("doc_id", F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate(fields.values())]).alias("_after"))
        documents = written.select("doc_id")
        if change.documents is not None:
            documents = documents.unionByName(change.documents.select("doc_id"))
        cleared = texts.join(change.pids.withColumn("_cleared", F.lit(True)), "PID", "left")
        touched = cleared.join(documents.distinct().withColumn("_changed", F.lit(True)), "doc_id", "left")
        before = touched.where(F.col("_cleared") | F.col("_changed")).select(
            "doc_id", F.struct(*[F.col(c).alias(f"t{i}") for i, c in enumerate(fields.values())]).alias("_before")
        )
        both = before.join(written, "doc_id", "full")
        parts = F.array(*[
            F.struct(F.lit(f).alias("field"), F.col(f"_before.t{i}").alias("before"), F.col(f"_after.t{i}").alias("after"))
            for i, f in enumerate(fields)
        ])
        own = both.select("doc_id", F.inline(parts))
        pairs = own if pairs is None else pairs.unionByName(own)
    changed = keep(changed_terms(pairs), "changed-terms")
    return Change(changed.where(F.col("n") > 0), changed.where(F.col("n") == 0).select(*KEY))
