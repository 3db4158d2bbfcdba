"""Text functions as Column -> Column, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Headings after which references begin.
REFERENCE_HEADINGS = ("References", "Bibliography", "Cited Literature", "参考文献", "引用文献")

# Categories and the words that tell them, in order of precedence.
RULES = {
    "Keywords": ("keywords", "key words"),
    "Abstract": ("abstract", "summary"),
    "Introduction": ("introduction", "background"),
    "Methods": ("methods", "materials and methods", "methodology", "experimental", "participants", "subjects", "statistical"),
    "Results": ("results", "findings"),
    "Discussion": ("discussion", "conclusion", "limitations", "implications"),
    "References": ("references", "bibliography"),
    "Acknowledgements": ("acknowledg", "funding", "conflict of interest"),
    "Author": ("author", "affiliation"),
}

# The second rule set, for lists of headings.
LIST_RULES = {
    "Author": ("author", "by ", "et al", "&", "and "),
    "Abstract": ("abstract", "summary"),
    "Keywords": ("keyword", "key word"),
    "Introduction": ("introduction", "background"),
    "Methods": ("method", "material", "experiment", "procedure", "design", "subject", "participant", "data analysis"),
    "Results": ("result", "finding", "outcome"),
    "Discussion": ("discussion", "conclusion", "implication", "limitation", "future work"),
    "References": ("reference", "bibliography", "citation"),
    "Acknowledgements": ("acknowledgement", "acknowledgment", "thank", "funding"),
}

# Canonical parts of a paper, and those it must have.
CATEGORIES = ("Title", "Author", "Keywords", "Abstract", "Introduction", "Methods", "Results", "Discussion", "References", "Acknowledgements", "Other")
CORE = ("Introduction", "Methods", "Results", "Discussion", "References")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def clean_text(c: Column | str) -> Column:
    """Runs of white space, newlines too, become one blank; null is empty."""
    return F.coalesce(strip(F.regexp_replace(col(c), r"(?U)\s+", " ")), F.lit(""))


def sentences(c: Column | str, language: str = "en") -> Column:
    """Split at sentence ends; in 'zh' and 'mixed' texts a full stop is not one."""
    ends = "[。！？!?；;]" if language in ("zh", "mixed") else "[.!?;]"
    return F.filter(F.transform(F.split(clean_text(c), ends), strip), lambda s: s != "")


def normalize_text(c: Column | str) -> Column:
    """Newlines as LF, no other control characters (tabs too), single blanks, stripped."""
    x = F.regexp_replace(col(c), r"\r\n?", "\n")
    x = F.regexp_replace(x, r"[\x00-\x09\x0b-\x1f]", "")
    return F.coalesce(strip(F.regexp_replace(x, " +", " ")), F.lit(""))


def quote(literal: str) -> str:
    return "\\Q" + literal.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def extract_section(c: Column | str, title: str, following: str | None = None) -> Column:
    """From behind ``title`` to ``following`` or the end, whatever their case; else empty."""
    end = rf"(?={quote(following)}|\z)" if following else r"\z"
    return F.coalesce(strip(F.regexp_extract(col(c), rf"(?isu){quote(title)}(.*?){end}", 1)), F.lit(""))


def count_words(c: Column | str) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(col(c), F.lit(r"(?U)(\b\w+\b)"), F.lit(1))), F.lit(0))


def count_tokens(c: Column | str) -> Column:
    """Words between white space; not the same as :func:`count_words`."""
    return F.coalesce(F.size(F.filter(F.split(col(c), r"(?U)\s+"), lambda w: w != "")), F.lit(0))


def tokens(c: Column | str) -> Column:
    return F.filter(F.split(col(c), r"(?U)\s+"), lambda w: w != "")


def find_keywords(c: Column | str, keywords: list[str], case_sensitive: bool = False) -> Column:
    """The keywords contained, in their given order."""
    x = col(c) if case_sensitive else F.lower(col(c))
    hit = [F.when(x.contains(k if case_sensitive else k.lower()), F.lit(k)) for k in keywords]
    return F.array_compact(F.array(*hit)) if hit else F.array().cast("array<string>")


def remove_references(c: Column | str) -> Column:
    """Cut at the first occurrence of a reference heading, even within a sentence."""
    x = col(c)
    for heading in REFERENCE_HEADINGS:
        x = F.regexp_replace(x, f"(?isu){heading}.*", "")
    return F.coalesce(strip(x), F.lit(""))


def detect_language(c: Column | str) -> Column:
    sample = F.left(F.coalesce(col(c), F.lit("")), F.lit(1000))
    n = F.nullif(F.length(sample), F.lit(0))
    zh = F.length(F.regexp_replace(sample, r"[^一-鿿]", "")) / n
    en = F.length(F.regexp_replace(sample, "[^a-zA-Z]", "")) / n
    return F.when((zh > 0.3) & (en > 0.3), "mixed").when(zh > en, "zh").otherwise("en")


def normalize_heading(c: Column | str) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(F.lower(col(c)), r"(?U)^[\d.\-()\s]+", ""), r"(?U)\s+", " "))


def first_rule(x: Column, rules: dict[str, tuple[str, ...]], other: str = "Other") -> Column:
    out = None
    for name, words in rules.items():
        hit = F.lit(False)
        for w in words:
            hit = hit | x.contains(w)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(other)


def rule_category(heading: Column | str) -> Column:
    return first_rule(normalize_heading(heading), RULES)


def list_rule_category(heading: Column | str) -> Column:
    """For headings behind the first one of a list, which is the title."""
    return first_rule(F.lower(col(heading)), LIST_RULES)


def sanitize_filename(c: Column | str, most: int = 255) -> Column:
    x = F.regexp_replace(F.regexp_replace(col(c), r'[<>:"/\\|?*]', "_"), r"[\x00-\x1f]", "")
    ext = F.regexp_extract(x, r"(?s)^\.*[^.].*?(\.[^.]*)$", 1)
    cut = F.concat(F.substring(x, F.lit(1), F.least(F.lit(most) - F.length(ext), F.length(x) - F.length(ext))), ext)
    return strip(F.when(F.length(x) > most, cut).otherwise(x))


def file_extension(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(F.regexp_extract(col(c), r"([^/]*)/*$", 1), r"^.+?(\.[^./]+)$", 1))


def main_url(c: Column | str) -> Column:
    return F.substring_index(col(c), "/", 3)


def file_stem(c: Column | str, suffix: str) -> Column:
    return F.regexp_replace(F.regexp_extract(col(c), "([^/]*)$", 1), quote(suffix) + "$", "")


def digest(c: Column | str, algorithm: str = "md5") -> Column:
    x = col(c).cast("binary")
    return {"md5": F.md5, "sha1": F.sha1, "sha256": lambda v: F.sha2(v, 256)}[algorithm](x)


def manual_suggestions(pmid: Column | str, landings: Column | str, most: int = 10) -> Column:
    """Three fixed places to look, then the landing pages met, without repeats."""
    p = col(pmid)
    base = F.array(
        F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), p, F.lit("/")),
        F.concat(F.lit("https://www.ncbi.nlm.nih.gov/pmc/?term="), p),
        F.concat(F.lit("https://europepmc.org/search?query=EXT_ID:"), p, F.lit("%20SRC:MED")),
    )
    met = F.filter(F.coalesce(col(landings), F.array().cast("array<string>")), lambda u: F.coalesce(u, F.lit("")) != "")
    return F.slice(F.array_distinct(F.concat(base, met)), 1, most)


def service_urls(pmid: Column | str, pmcid: Column | str) -> Column:
    """Where the public services answer for a record."""
    p = col(pmid)
    # Addresses of the services.
    return F.struct(
        F.concat(F.lit("http://eutils.ncbi.nlm.nih.gov/entrez/eutils/elink.fcgi?dbfrom=pubmed&id="), p, F.lit("&retmode=ref&cmd=prlinks")).alias("elink"),
        F.concat(F.lit("https://www.ebi.ac.uk/europepmc/webservices/rest/search?query=EXT_ID:"), p, F.lit("%20AND%20SRC:MED&format=json&resultType=core")).alias("europe_pmc"),
        F.concat(F.lit("https://www.ncbi.nlm.nih.gov/pmc/utils/idconv/v1.0/?ids="), p, F.lit("&format=json")).alias("idconv"),
        F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/"), col(pmcid), F.lit("/pdf/")).alias("pmc_pdf"),
    )


def ocr_quality(c: Column | str, confidence: Column | None = None) -> tuple[Column, Column]:
    """Score and level: at most 30 for length, 30 for lines with text, 40 for confidence."""
    x = F.coalesce(col(c), F.lit(""))
    lines = F.split(x, "\n", -1)
    filled = F.size(F.filter(lines, lambda s: strip(s) != ""))
    score = F.least(F.lit(30.0), F.length(x) / 1000.0 * 3) + filled / F.size(lines) * 30 + (F.lit(0.0) if confidence is None else confidence) * 0.4
    score = F.when(x == "", 0.0).otherwise(score)
    level = F.when(score >= 90, "excellent").when(score >= 70, "good").when(score >= 50, "fair").otherwise("poor")
    return score, level


def quality_tag(score: Column, length: Column) -> Column:
    return F.when(length < 500, "too_short").when(score >= 80, "good").when(score >= 60, "medium").otherwise("poor")


def page_estimate(pages: Column, length: Column) -> Column:
    return F.coalesce(F.nullif(pages, F.lit(0)), F.greatest(F.lit(1), F.floor(length / 3000).cast("int")))


def unassigned_percent(unassigned: Column, total: Column) -> Column:
    return unassigned / F.nullif(total, F.lit(0)) * 100


def clean_csv_text(c: Column | str) -> Column:
    """The lines of a model's answer that look like CSV, up to the first that does not.

    Any line with a comma or one of the words counts, letters x, y and z among them.
    """
    # Words of a header.
    header = ("brain", "region", "x", "y", "z", "cluster", "statistic", "p_value", "task")
    x = F.regexp_replace(F.regexp_replace(col(c), "```[a-z]*\n", ""), "\n```", "")
    lines = F.split(x, "\n", -1)

    def csv(s: Column) -> Column:
        hit = s.contains(",")
        for w in header:
            hit = hit | F.lower(s).contains(w)
        return hit

    seen = F.transform(lines, lambda s: F.struct(s.alias("s"), csv(s).alias("csv"), ((strip(s) != "") & ~F.startswith(strip(s), F.lit('"'))).alias("other")))

    def kept(kinds: Column, start: Column) -> Column:
        end = F.filter(F.transform(kinds, lambda k, i: F.when((i + 1 > start) & ~k["csv"] & k["other"], i)), lambda i: i.isNotNull())
        rows = bound(F.coalesce(F.get(end, F.lit(0)), F.size(kinds)), lambda last: F.filter(kinds, lambda k, i: k["csv"] & (i < last)))
        return F.when(start > 0, F.array_join(F.transform(rows, lambda k: k["s"]), "\n")).otherwise("")

    return bound(seen, lambda kinds: bound(F.array_position(F.transform(kinds, lambda k: k["csv"]), True), lambda start: kept(kinds, start)))


def legacy_postprocess(c: Column | str) -> Column:
    """The old OCR clean-up, kept to compare with: it makes one line of a document, and of a line with
    a table rule it leaves rules only. Not for use on texts that matter."""
    x = normalize_text(clean_text(c))
    cells = F.transform(F.split(x, r"\|", -1), lambda p: F.when(strip(p).rlike("^[-=:]+$"), strip(p)).otherwise("---"))
    ruled = x.contains("|") & (x.contains("---") | x.contains("==="))
    return F.when(ruled, F.concat(F.lit("|"), F.array_join(cells, "|"), F.lit("|"))).otherwise(x)


def response_text(c: Column | str) -> Column:
    """The first text that is not blank among a JSON answer's usual fields; other text as it is."""
    # Fields of an OCR answer.
    fields = ("md_results", "markdown", "text", "content")
    v = F.try_parse_json(col(c))
    named = [F.when(strip(F.try_variant_get(v, f"$.{f}", "string")) != "", F.try_variant_get(v, f"$.{f}", "string")) for f in fields]
    return F.when(v.isNull(), col(c)).otherwise(F.coalesce(*named, F.lit("")))
