"""Finding the PDF behind a landing page: link finders over its HTML, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import main_url


def tags(html: Column, name: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)(<{name}\b[^>]*>)"), F.lit(1))


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value, null if the tag has none."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    found = tag.rlike(pattern)
    return F.when(found, F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)]))


def first(found: Column) -> Column:
    return F.get(found, F.lit(0))


def anchors(html: Column) -> Column:
    return tags(html, "a")


def generic_citation(url: Column, html: Column) -> Column:
    meta = F.filter(tags(html, "meta"), lambda t: attribute(t, "name") == "citation_pdf_url")
    return attribute(first(meta), "content")


def pubmed_central(url: Column, html: Column) -> Column:
    hrefs = F.filter(F.transform(anchors(html), lambda t: attribute(t, "href")), lambda h: h.contains("/pmc/articles"))
    elements = F.regexp_extract_all(html, F.lit(r"(?is)(<a\b[^>]*>[^<]*</a>)"), F.lit(1))
    named = F.filter(elements, lambda e: F.regexp_extract(e, "(?is)>([^<]*)<", 1).rlike("(?i)pdf"))
    links = F.filter(F.transform(named, lambda e: attribute(F.regexp_extract(e, "(?is)^(<[^>]*>)", 1), "href")), lambda h: F.lower(h).contains("pdf") & ~F.lower(h).contains("epdf"))
    return F.coalesce(F.concat(F.lit("https://www.ncbi.nlm.nih.gov"), first(hrefs)), F.concat(main_url(url), first(links)))


def by_attribute(url: Column, html: Column, test) -> Column:
    link = first(F.filter(anchors(html), test))
    return F.concat(main_url(url), attribute(link, "href"))


def acs(url: Column, html: Column) -> Column:
    return by_attribute(url, html, lambda t: F.lower(attribute(t, "title")).contains("high-res pdf") | F.lower(attribute(t, "title")).contains("low-res pdf"))


def nejm(url: Column, html: Column) -> Column:
    return by_attribute(url, html, lambda t: F.lower(attribute(t, "data-download-type")) == "article pdf")


def future_medicine(url: Column, html: Column) -> Column:
    return by_attribute(url, html, lambda t: attribute(t, "href").contains("/doi/pdf"))


def uchicago_press(url: Column, html: Column) -> Column:
    return by_attribute(url, html, lambda t: attribute(t, "href").contains("pdf") & attribute(t, "href").contains(".edu/doi/"))


def direct_pdf(url: Column, html: Column, content_type: Column | None = None) -> Column:
    kind = F.lit(False) if content_type is None else F.coalesce(content_type.contains("application/pdf"), F.lit(False))
    return F.when(kind | F.lower(url).endswith(".pdf"), url)


#: Finders by name. ``science_direct``, which asks further pages, is an adapter (``adapters.science_direct``).
FINDERS = {
    "generic_citation": generic_citation, "pubmed_central": pubmed_central, "acs": acs, "nejm": nejm, "future_medicine": future_medicine, "uchicago_press": uchicago_press, "direct_pdf": direct_pdf,
}
# The finders enabled by default, in order.
DEFAULT = ("generic_citation", "pubmed_central", "acs", "nejm", "science_direct")


def find_pdf(url: Column, html: Column, enabled: tuple[str, ...] = DEFAULT) -> Column:
    """Struct (finder, pdf_url) of the first enabled finder that finds a link; unknown names are
    skipped. Both are null if none does."""
    hits = [F.when(FINDERS[n](url, html).isNotNull(), F.struct(F.lit(n).alias("finder"), FINDERS[n](url, html).alias("pdf_url"))) for n in enabled if n in FINDERS]
    none = F.struct(F.lit(None).cast("string").alias("finder"), F.lit(None).cast("string").alias("pdf_url"))
    return F.coalesce(*hits, none)
