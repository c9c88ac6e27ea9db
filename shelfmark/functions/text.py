"""Plain text and search terms from content, in built-in expressions only."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose tags do not separate words.
INLINE_TAGS = "a|abbr|b|big|cite|code|em|font|i|mark|small|span|strong|sub|sup|tt|u"

HTML_DROPPED = (
    r"(?is)<!--.*?(?:-->|\z)",
    r"(?is)<head(?:\s[^>]*)?>.*?(?:</head\s*>|\z)",
    r"(?is)<script(?:\s[^>]*)?>.*?(?:</script\s*>|\z)",
    r"(?is)<style(?:\s[^>]*)?>.*?(?:</style\s*>|\z)",
    rf"(?i)</?(?:{INLINE_TAGS})(?:\s[^>]*)?>",
)
ANY_TAG = r"(?s)<[!/?A-Za-z][^>]*>"
XML_DROPPED = (r"(?s)<!--.*?(?:-->|\z)", r"(?s)<\?.*?\?>", r"(?s)<!DOCTYPE[^>\[]*(?:\[.*?\]\s*)?>")
# One pass, so that markup inside a character-data section is kept as text.
XML_MARKUP = r"(?s)<!\[CDATA\[(.*?)\]\]>|<[!/?A-Za-z][^>]*>"

# Named character references: the standard table; some names also stand without a semicolon.
NAMES = {name.rstrip(";"): value for name, value in sorted(html5.items())}
OPEN_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
REFERENCE = rf"\A(?:#(?:0*([0-9]{{1,9}})|[xX]0*([0-9A-Fa-f]{{1,8}}))(?![0-9A-Fa-f]);?|([A-Za-z][A-Za-z0-9]*);|({'|'.join(OPEN_NAMES)}))"

# Declared charsets that are not UTF-8. Windows-1252 is what documents that declare ISO-8859-1 are read as.
WESTERN = ("iso-8859-1", "iso8859-1", "latin1", "latin-1", "windows-1252", "cp1252", "us-ascii", "ascii")
UTF_16 = {"utf-16": "UTF-16", "utf-16be": "UTF-16BE", "utf-16le": "UTF-16LE"}
_C1 = "".join(map(chr, range(0x80, 0xA0)))
_C1_WESTERN = "".join(bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(0x80, 0xA0))
GENERIC = ("", "application/octet-stream", "binary/octet-stream", "application/unknown", "unknown/unknown")


def _character(code: Column) -> Column:
    """The character of a Unicode code point; null outside the valid range."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unescape(text: Column) -> Column:
    """Replace named and numeric character references; unknown ones stay as they are."""
    names = F.from_json(F.lit(json.dumps(NAMES)), "map<string, string>")

    def decoded(part: Column) -> Column:
        group = [F.regexp_extract(part, REFERENCE, k).alias(f"g{k}") for k in range(5)]
        return _bound(F.struct(*group), lambda found: replaced(part, found))

    def replaced(part: Column, found: Column) -> Column:
        number = F.when(found["g1"] != "", found["g1"].cast("bigint")).when(found["g2"] != "", F.conv(found["g2"], 16, 10).cast("bigint"))
        name = F.nullif(F.concat(found["g3"], found["g4"]), F.lit(""))
        value = F.coalesce(_character(number), F.try_element_at(names, name))
        # A name with a semicolon that is unknown may still begin with one that needs none.
        open_name = F.nullif(F.regexp_extract(part, rf"\A({'|'.join(OPEN_NAMES)})", 1), F.lit(""))
        shorter = F.try_element_at(names, open_name)
        rest = F.substring(part, F.length(found["g0"]) + F.lit(1), F.length(part))
        return (
            F.when(value.isNotNull(), F.concat(value, rest))
            .when(shorter.isNotNull(), F.concat(shorter, F.substring(part, F.length(open_name) + F.lit(1), F.length(part))))
            .otherwise(F.concat(F.lit("&"), part))
        )

    def joined(parts: Column) -> Column:
        tail = F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), decoded)
        return F.concat(F.get(parts, F.lit(0)), F.array_join(tail, ""))

    return _bound(F.split(text, "&"), joined)


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\r\n\f\x{00A0}]+", " "))


def html_text(html: Column) -> Column:
    """Visible text of an HTML body: no head, scripts, styles, comments or tags."""
    for pattern in HTML_DROPPED:
        html = F.regexp_replace(html, pattern, "")
    return squeeze(unescape(F.regexp_replace(html, ANY_TAG, " ")))


def xml_text(xml: Column) -> Column:
    """Character data of an XML document, elements separated by a blank."""
    for pattern in XML_DROPPED:
        xml = F.regexp_replace(xml, pattern, "")
    return squeeze(unescape(F.regexp_replace(xml, XML_MARKUP, "$1 ")))


def charset_of(content: Column, mime: Column) -> Column:
    """Declared charset in lower case, ``""`` without one: of the media type, else of the XML declaration or an HTML meta element."""
    start = F.decode(F.substring(content.cast("binary"), 1, 1024), "ISO-8859-1")
    declared = F.regexp_extract(F.coalesce(mime, F.lit("")), r"(?i)charset\s*=\s*['\"]?([^'\"\s;]+)", 1)
    inside = F.regexp_extract(start, r"(?is)\A\s*<\?xml[^>]*?encoding\s*=\s*['\"]([^'\"]+)|<meta[^>]*?charset\s*=\s*['\"]?([^'\"\s;/>]+)", 0)
    own = F.regexp_extract(inside, r"(?is)(?:encoding|charset)\s*=\s*['\"]?([^'\"\s;/>]+)", 1)
    return F.lower(F.coalesce(F.nullif(declared, F.lit("")), own, F.lit("")))


def decoded_text(content: Column, mime: Column) -> Column:
    """``content`` by its declared charset; bytes that are not valid in UTF-8 become replacement characters instead of failing the job."""
    charset, raw = charset_of(content, mime), content.cast("binary")
    text = F.when(charset.isin(*WESTERN), F.translate(F.decode(raw, "ISO-8859-1"), _C1, _C1_WESTERN))
    for name, encoding in UTF_16.items():
        text = text.when((charset == name) & (F.length(raw) % 2 == 0), F.decode(raw, encoding))
    return text.otherwise(F.make_valid_utf8(content.cast("string")))


def media_type(mime: Column, text: Column) -> Column:
    """The declared media type, or what the text looks like where the type is missing or generic."""
    kind = F.coalesce(F.lower(F.trim(F.substring_index(mime, ";", 1))), F.lit(""))
    seen = (
        F.when(text.rlike(r"(?is)\A\s*(?:<!--.*?-->\s*)*<(?:!doctype\s+html|html[\s>])"), "text/html")
        .when(text.rlike(r"(?s)\A\s*<\?xml"), F.when(text.rlike(r"(?is)<html[\s>]"), "text/html").otherwise("text/xml"))
        .when(~text.rlike(r"[\x00-\x08\x0E-\x1A\x1C-\x1F\x{FFFD}]"), "text/plain")
    )
    return F.when(kind.isin(*GENERIC), seen).otherwise(kind)


def extract_text(content: Column, mime: Column, decoded: bool = False) -> Column:
    """Plain text of ``content`` by media type; null for types that have no text reader here.

    ``content`` may be binary, or text that is ``decoded`` already.
    """

    def read(text: Column) -> Column:
        return _bound(media_type(mime, text), lambda kind: by_kind(kind, text))

    def by_kind(kind: Column, text: Column) -> Column:
        return (
            F.when(kind.isin("text/html", "application/xhtml+xml"), html_text(text))
            .when(kind.isin("text/xml", "application/xml") | kind.endswith("+xml"), xml_text(text))
            .when(kind.startswith("text/") | kind.isin("application/json"), text)
        )

    return _bound(F.make_valid_utf8(content.cast("string")) if decoded else decoded_text(content, mime), read)


def terms(text: Column) -> Column:
    """Lower-case search terms in text order: runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")
