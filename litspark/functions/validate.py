"""Validity of identifiers, addresses and files, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip


def pmid_reason(c: Column | str) -> Column:
    """Null for a valid identifier (5 to 10 digits), else why it is none."""
    x = strip(col(c))
    return (
        F.when(F.coalesce(col(c), F.lit("")) == "", "empty").when(~x.rlike(r"^\p{Nd}+$"), "not_numeric").when((F.length(x) < 5) | (F.length(x) > 10), "bad_length")
    )


def valid_pmid(c: Column | str) -> Column:
    return pmid_reason(c).isNull()


def downloadable_pmid(c: Column | str) -> Column:
    """The downloader's rule: digits, as many as there are."""
    return F.coalesce(strip(col(c)).rlike("^[0-9]+$"), F.lit(False))


# Forms of addresses.
URL = (
    r"(?i)^(https?|ftp)://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|localhost|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?::\d+)?(?:/?|[/?]\S+)$"
)
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def valid_url(c: Column | str) -> Column:
    return F.coalesce(col(c).rlike(URL), F.lit(False))


def valid_email(c: Column | str) -> Column:
    return F.coalesce(col(c).rlike(EMAIL), F.lit(False))


def pdf_reason(content: Column | str, size: Column | None = None) -> Column:
    """Null for a usable PDF, else why it is none."""
    x = col(content)
    n = F.octet_length(x) if size is None else size
    return (
        F.when(x.isNull(), "missing").when(n < 100, "too_small").when(n > 100 * 1024 * 1024, "too_large").when(F.substring(x, 1, 5) != F.lit(b"%PDF-"), "bad_header")
    )


def markdown_reason(c: Column | str) -> Column:
    """Null for a usable Markdown text, else why it is none."""
    x = col(c)
    head = F.left(x, F.lit(1000))
    return (
        F.when(x.isNull(), "missing").when(x == "", "empty").when(F.octet_length(x) > 10 * 1024 * 1024, "too_large").when(strip(head) == "", "blank")
        .when(F.length(F.regexp_replace(head, r"(?U)[^\p{L}\s]", "")) < 10, "too_little_text")
    )
