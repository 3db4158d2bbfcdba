"""The boundary to models, OCR engines and HTTP: Arrow batches in, rows with a result or an error out.

An adapter is made once for each task, so clients and models load lazily on the executors. A failed
call is a row, not a failed job. Answers are written to the shared folder right behind the adapter:
Spark may read a result on several branches, or run a stage again, and a paid call should not be
made twice for it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame

from .shared import written
from .shipping import send_package


def call(rows: DataFrame, make: Callable[[], Callable[[dict], str | None]], inputs: list[str], output: str = "answer", retries: int = 0, once: bool = True) -> DataFrame:
    """Adds ``output`` and ``error``: what ``make()`` returns for a dict of ``inputs``, as text.

    With ``once`` the calls are made here and now, one for each row (and retry), and their answers
    written out; without it, or on a stream, they are made whenever the result is read.
    """
    send_package(rows.sparkSession)
    schema = f"{rows._jdf.schema().toDDL()}, `{output}` string, `error` string"

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = make()

        def one(record: dict) -> tuple[str | None, str | None]:
            error = None
            for _ in range(retries + 1):
                try:
                    return ask(record), None
                except Exception as e:  # noqa: BLE001  the error is the row's result
                    error = f"{type(e).__name__}: {e}"
            return None, error

        for b in batches:
            found = [one(r) for r in b[inputs].to_dict("records")]
            yield b.assign(**{output: [f[0] for f in found], "error": [f[1] for f in found]})

    out = rows.mapInPandas(work, schema)
    return written(out, "answers") if once and not rows.isStreaming else out


def keyword_judge() -> Callable[[dict], str | None]:
    """Deterministic double of a screening model."""

    def ask(record: dict) -> str | None:
        text = (record.get("abstract") or "").lower()
        include = "fmri" in text and "language" in text
        labels = {"method": "fmri" if "fmri" in text else "unknown", "topic": "language" if "language" in text else "other"}
        return json.dumps({"include": include, "confidence": 0.92 if include else 0.25, "reason": "method+topic fit" if include else "not in scope", "labels": labels})

    return ask


def echo_ocr() -> Callable[[dict], str | None]:
    """Deterministic double of an OCR engine: one page for a path, an error for a blank one."""

    def ask(record: dict) -> str | None:
        path = record.get("pdf_path") or ""
        if not path:
            raise ValueError("no file")
        return f"# {path}\n\n## Page 1\n\ntext of {path}"

    return ask


def science_direct(fetch: Callable[[str], str]) -> Callable[[dict], str | None]:
    """A link finder that asks two more pages, for :func:`first_source`: the landing page's first input
    field names the article's page, whose citation address leads to a page with the link."""
    import re

    def first(pattern: str, page: str) -> str | None:
        found = re.search(pattern, page, re.I | re.S)
        return next((g for g in found.groups() if g is not None), None) if found else None

    def value(name: str, tag: str) -> str | None:
        return first(rf"""\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", tag)

    def science_direct(record: dict) -> str | None:
        field = first(r"(<input\b[^>]*>)", record.get("html") or "")
        landing = unquote(value("value", field) or "") if field else ""
        if not landing:
            return None
        metas = re.findall(r"<meta\b[^>]*>", fetch(landing), re.I | re.S)
        link = next((value("content", m) for m in metas if value("name", m) == "citation_pdf_url"), None)
        anchor = first(r"(<a\b[^>]*>)", fetch(link)) if link else None
        return value("href", anchor) if anchor else None

    return science_direct


def abstracts(fetch: Callable[[list[str]], dict[str, str | None]], size: int = 200, wait: float = 0.0) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For ``mapInPandas`` over (pmid): (pmid, abstract, error), asked for ``size`` at a time."""
    import time

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for i in range(0, len(b), size):
                ids = b["pmid"].iloc[i : i + size].tolist()
                try:
                    got, error = fetch(ids), None
                except Exception as e:  # noqa: BLE001
                    got, error = {}, f"{type(e).__name__}: {e}"
                yield pd.DataFrame({"pmid": ids, "abstract": [got.get(p) for p in ids], "error": [error or (None if got.get(p) else "no abstract") for p in ids]}, dtype=object)
                if wait:
                    time.sleep(wait)

    return work


def fetch_abstracts(ids: DataFrame, fetch: Callable[[list[str]], dict[str, str | None]], size: int = 200, wait: float = 0.0) -> DataFrame:
    """(pmid, abstract, error): the abstracts that a service has, in requests of ``size`` identifiers."""
    send_package(ids.sparkSession)
    return written(ids.select("pmid").mapInPandas(abstracts(fetch, size, wait), "pmid string, abstract string, error string"), "abstracts")


def download(rows: DataFrame, make: Callable[[], Callable[[dict], Iterator[bytes]]], inputs: list[str], key: str = "pmid", most: int = 100 << 20) -> DataFrame:
    """(key, content, error): files that come in chunks of bytes. A file that grows beyond ``most`` bytes
    or is no PDF leaves no content, as does one whose transfer fails."""
    send_package(rows.sparkSession)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get = make()
        for b in batches:
            for r in b[inputs].to_dict("records"):
                body, error = bytearray(), None
                try:
                    for chunk in get(r):
                        body += chunk
                        if len(body) > most:
                            raise ValueError("too large")
                    if len(body) < 100 or not body.startswith(b"%PDF-"):
                        raise ValueError("not a PDF")
                except Exception as e:  # noqa: BLE001
                    error = f"{type(e).__name__}: {e}"
                yield pd.DataFrame({"k": [str(r[key])], "content": [None if error else bytes(body)], "error": [error]})

    out = rows.select(*dict.fromkeys([key, *inputs])).mapInPandas(work, "k string, content binary, error string")
    return written(out.withColumnRenamed("k", key), "downloads")


def first_source(sources: list[Callable[[dict], str | None]]) -> Callable[[], Callable[[dict], str | None]]:
    """Ordered fallback as one adapter: JSON of the first hit and the attempts up to it."""

    def make() -> Callable[[dict], str | None]:
        def ask(record: dict) -> str | None:
            attempts = []
            for s in sources:
                try:
                    url = s(record)
                except Exception as e:  # noqa: BLE001
                    attempts.append({"source": s.__name__, "status": "error", "message": str(e)})
                    continue
                attempts.append({"source": s.__name__, "status": "hit" if url else "miss"})
                if url:
                    return json.dumps({"pdf_url": url, "attempts": attempts})
            return json.dumps({"pdf_url": None, "attempts": attempts})

        return ask

    return make


#: Pages and bytes of images that a renderer's task hands on at once, at most; a larger page goes alone.
PAGES, PAGE_BYTES = 2000, 16 << 20


def explode_pages(files: DataFrame, make: Callable[[], Callable[[dict], Iterator[bytes]]], inputs: list[str], key: str = "path") -> DataFrame:
    """(key, page_num, image, error): a renderer's pages of each file, streamed in batches of bounded size; a
    file that can't be rendered is one row with the error. A row is small and its file slow to render, so files
    are dealt over all tasks, however few the table's own are."""
    spark = files.sparkSession
    send_package(spark)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = make()

        def pages() -> Iterator[tuple]:
            for b in batches:
                for r in b[inputs].to_dict("records"):
                    n = 0
                    try:
                        for image in render(r):
                            n += 1
                            yield r[key], n, image, None
                    except Exception as e:  # noqa: BLE001
                        yield r[key], n + 1, None, f"{type(e).__name__}: {e}"

        def frame(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=["k", "page_num", "image", "error"], dtype=object)

        held, size = [], 0
        for row in pages():
            own = len(row[2] or b"") + len(row[3] or "")
            if held and (len(held) == PAGES or size + own > PAGE_BYTES):
                yield frame(held)
                held, size = [], 0
            held.append(row)
            size += own
        if held:
            yield frame(held)

    dealt = files.select(*inputs).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return dealt.mapInPandas(work, "k string, page_num int, image binary, error string").withColumnRenamed("k", key)
