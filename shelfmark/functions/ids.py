"""Identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# java.net.URI grammar as character classes: ASCII path characters, escapes, and non-ASCII that is neither control nor space.
_ESCAPE = r"%[0-9A-Fa-f]{2}"
_OTHER = r"[^\x00-\x7F\p{Cc}\p{Z}]"
_PATH = rf"(?:[A-Za-z0-9_\-!.~'()*,;:$&+=/@]|{_ESCAPE}|{_OTHER})*+"
_URIC = rf"(?:[A-Za-z0-9_\-!.~'()*,;:$&+=/@?\[\]]|{_ESCAPE}|{_OTHER})*+"
VALID_URI = rf"\A{_PATH}(?:\?{_URIC})?(?:#{_URIC})?\z"


def doc_id(kind: Column, pid: Column, dsid: Column) -> Column:
    """``pid`` for objects and for an empty ``dsid``, otherwise ``pid:dsid``; null without a pid."""
    own = F.coalesce(dsid, F.lit(""))
    return F.when((kind == "object") | (own == ""), pid).otherwise(F.concat(pid, F.lit(":"), own))


def job_label(op: Column, document: Column) -> Column:
    return F.format_string("[%s] [%s]", op, document)


def local_identifier(col: Column) -> Column:
    """Text after the first colon at or after the fifth character; the whole text without one."""
    return F.substring(col, F.locate(":", col, 5) + 1, F.length(col))


def versionable(col: Column) -> Column:
    return col == "true"


def raw_content_uri(pid: Column, dsid: Column) -> Column:
    return F.format_string("objects/%s/datastreams/%s/content", pid, dsid)


def is_valid_uri(uri: Column) -> Column:
    return uri.rlike(VALID_URI)


def content_uri(pid: Column, dsid: Column) -> Column:
    """Relative content address with non-ASCII characters percent-encoded; null when it is not a valid URI."""
    raw = raw_content_uri(pid, dsid)
    encoded = F.array_join(
        F.transform(F.split(raw, ""), lambda c: F.when(c.rlike(r"[^\x00-\x7F]"), F.url_encode(c)).otherwise(c)), ""
    )
    ascii_only = F.when(raw.rlike(r"[^\x00-\x7F]"), encoded).otherwise(raw)
    return F.when(is_valid_uri(raw), ascii_only)


def pid_bucket(pid: Column, buckets: int) -> Column:
    """Routing: a document and its parent share the bucket of their PID."""
    return F.pmod(F.xxhash64(pid), F.lit(buckets)).cast("int")
