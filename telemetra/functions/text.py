"""Text extraction from markup and semi-structured documents."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# Fixed patterns, written in the subset that Java and RE2 share.
HIDDEN = [
    r"(?is)<script[^>]*>.*?</script>",
    r"(?is)<style[^>]*>.*?</style>",
    r"(?s)<!--.*?-->",
    r"(?is)<head[^>]*>.*?</head>",
]
BLOCK = r"(?i)</?(?:p|div|article|section|nav|ul|ol|li|h[1-6]|table|tr|br|body|html|footer|header)\b[^>]*>"
TAG = r"<[^>]*>"
SPACE = r"[ \t\r\n]+"

PAGE_FIELDS = {
    "lang": r'<html lang="([a-z]+)"',
    "charset": r'<meta charset="([^"]+)"',
    "title": r"<title>([^<]*)</title>",
    "heading": r"<h1>([^<]*)</h1>",
}


def visible(html: Column | str) -> Column:
    text = F.col(html) if isinstance(html, str) else html
    for pattern in HIDDEN:
        text = F.regexp_replace(text, pattern, " ")
    return text


def elements(html: Column | str) -> Column:
    """Text blocks of a page in order, inline markup removed, empty ones left out."""
    blocks = F.split(visible(html), BLOCK)
    plain = F.transform(
        blocks,
        lambda b: F.trim(F.regexp_replace(F.regexp_replace(b, TAG, ""), SPACE, " ")),
    )
    return F.transform(
        F.filter(plain, lambda b: F.length(b) > 0), lambda b: F.struct(b.alias("content"))
    )


def join_elements(items: Column | str, separator: str = "\n") -> Column:
    items = F.col(items) if isinstance(items, str) else items
    return F.array_join(F.transform(items, lambda e: e["content"]), separator)


def document_elements(document: Column | str) -> Column:
    """The element list inside a parsed document held as variant."""
    return F.try_variant_get(
        document, "$.document.elements", "array<struct<content:string>>"
    )


def extract_fields(text: Column | str, fields: Mapping[str, str] = PAGE_FIELDS) -> Column:
    """First group of each pattern as a struct; null where a pattern finds nothing."""
    return F.struct(
        *[F.nullif(F.regexp_extract(text, p, 1), F.lit("")).alias(n) for n, p in fields.items()]
    )


def page_elements(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per text block with its position."""
    return pages.select(key, F.posexplode(elements(html)).alias("position", "element")).select(
        key, "position", F.col("element.content").alias("content")
    )


def page_text(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    return pages.select(key, join_elements(elements(html)).alias("full_text"))
