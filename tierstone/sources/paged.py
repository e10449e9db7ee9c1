"""A paged JSON source, read on the executors.

A *fetcher* is any picklable callable ``fetch(page_number, per_page) -> str`` that
returns the text of one page. It runs inside tasks; the driver only plans ranges
of page numbers and never holds a record.
"""

from __future__ import annotations

import http.client
import json
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..errors import ApiResponseError, ExtractionError
from ..operators.paging import explode_pages
from ..session import path_exists, ship_package

Fetcher = Callable[[int, int], str]

PAGES_DDL = (
    "page_number BIGINT, n_records INT, records ARRAY<STRING>, error_class STRING, error STRING, "
    "asked_to BIGINT, per_page INT"
)
DEFAULT_PER_PAGE = 50


def page_records(text: str) -> list[str]:
    """The records of one page as JSON text; anything but a JSON list is refused."""
    try:
        data = json.loads(text)
    except ValueError as exc:
        raise ApiResponseError(f"the answer is not JSON: {exc}") from exc
    if not isinstance(data, list):
        raise ApiResponseError(f"the answer is a JSON {type(data).__name__}, not a list")
    return [json.dumps(record, ensure_ascii=False) for record in data]


@dataclass(frozen=True)
class HttpPages:
    """Pages of an HTTP endpoint. The two page parameters override ``params``.

    A list among ``params`` becomes a repeated key; ``None`` is left out.
    """

    endpoint: str
    page_param: str = "page"
    per_page_param: str = "per_page"
    timeout_seconds: float = 20
    params: Mapping[str, object] = field(default_factory=dict)
    headers: Mapping[str, str] = field(default_factory=dict)

    def url(self, page_number: int, per_page: int) -> str:
        given = {**self.params, self.page_param: page_number, self.per_page_param: per_page}
        query = {key: value for key, value in given.items() if value is not None}
        base = self.endpoint.rstrip("?")
        return f"{base}{'&' if '?' in base else '?'}{urllib.parse.urlencode(query, doseq=True)}"

    def __call__(self, page_number: int, per_page: int) -> str:
        request = urllib.request.Request(
            self.url(page_number, per_page), headers=dict(self.headers)
        )
        try:
            with urllib.request.urlopen(request, timeout=self.timeout_seconds) as answer:
                body = answer.read()
        except (OSError, http.client.HTTPException) as exc:  # status, network and timeout
            raise ExtractionError(f"request to {request.full_url} failed: {exc}") from exc
        try:
            return body.decode("utf-8")
        except UnicodeDecodeError as exc:
            raise ApiResponseError(f"the answer is not UTF-8: {exc}") from exc


@dataclass(frozen=True)
class StoredPages:
    """Pages kept as ``<root>/page_number=<n>/*.txt``, JSON arrays that join to the page.

    ``root`` may be any URI pyarrow can open, so it works on shared storage. A
    page that is not there is empty, as past the end of an API; a root that is not
    there is a failure. Pages were cut
    when written: a smaller ``per_page`` only makes sense for the first one.
    """

    root: str
    per_page: int

    def __call__(self, page_number: int, per_page: int) -> str:
        from pyarrow import fs

        if per_page != self.per_page and not (page_number == 1 and per_page < self.per_page):
            raise ExtractionError(f"pages of {self.per_page} cannot be read as pages of {per_page}")
        where = f"{self.root}/page_number={page_number}"
        if "://" in where or where.startswith("file:"):
            files, where = fs.FileSystem.from_uri(where)
        else:
            files = fs.LocalFileSystem()
        try:
            listed = files.get_file_info(fs.FileSelector(where, allow_not_found=True))
            names = sorted(info.path for info in listed if info.path.endswith(".txt"))
            if not names and files.get_file_info(where.rpartition("/")[0]).type != fs.FileType.Directory:
                raise ExtractionError(f"{self.root} is no folder")
            texts = []
            for name in names:
                with files.open_input_stream(name) as stream:
                    texts.append(stream.read().decode("utf-8"))
        except OSError as exc:
            raise ExtractionError(f"page {page_number} of {self.root}: {exc}") from exc
        if len(texts) == 1 and per_page == self.per_page:
            return texts[0]
        records = [record for text in texts for record in page_records(text)]
        return "[" + ", ".join(records[:per_page] if per_page < self.per_page else records) + "]"


@dataclass
class PageRange(InputPartition):
    first: int
    last: int


class PagedJsonReader(DataSourceReader):
    def __init__(self, fetch: Fetcher, options: Mapping[str, str]) -> None:
        self.fetch = fetch
        if options.get("pageRanges") is not None:
            self.ranges = [(int(low), int(high)) for low, high in json.loads(options["pageRanges"])]
        elif options.get("lastPage") is not None:
            self.ranges = [(int(options.get("firstPage", 1)), int(options["lastPage"]))]
        else:
            raise ValueError("paged_json needs the option lastPage or pageRanges")
        self.per_page = int(options.get("perPage", DEFAULT_PER_PAGE))
        self.pages_per_task = int(options.get("pagesPerTask", 1))

    def partitions(self) -> list[PageRange]:
        step = self.pages_per_task
        return [
            PageRange(first, min(first + step - 1, high))
            for low, high in self.ranges
            for first in range(low, high + 1, step)
        ]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        # No page after an empty or failed one can count yet, so a task stops there; each row
        # says how far its task was to go, which is what a later attempt has to make up for.
        asked = (partition.last, self.per_page)
        for page_number in range(partition.first, partition.last + 1):
            try:
                records = page_records(self.fetch(page_number, self.per_page))
            except Exception as exc:  # a fault past the end of the source must not end the job
                kind = type(exc).__name__
                said = str(exc) if isinstance(exc, ExtractionError) else f"{kind}: {exc}"
                yield (page_number, None, None, kind, said, *asked)
                return
            yield (page_number, len(records), records, None, None, *asked)
            if not records:
                return


class PagedJson(DataSource):
    """Format ``paged_json``: one row per page, with its records or its error.

    Options: ``lastPage`` and ``firstPage``, or ``pageRanges`` (a JSON list of first and last
    pages); ``perPage``, ``pagesPerTask``.
    """

    fetch: Fetcher

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return PAGES_DDL

    def reader(self, schema) -> PagedJsonReader:
        return PagedJsonReader(type(self).fetch, self.options)


def paged_json(fetch: Fetcher) -> type[PagedJson]:
    """The data source for one fetcher, ready for ``spark.dataSource.register``."""
    return type("BoundPagedJson", (PagedJson,), {"fetch": staticmethod(fetch)})


def read_pages(
    spark: SparkSession,
    fetch: Fetcher,
    *,
    last: int | None = None,
    first: int = 1,
    ranges: Sequence[tuple[int, int]] | None = None,
    per_page: int = DEFAULT_PER_PAGE,
    pages_per_task: int = 1,
) -> DataFrame:
    """Pages ``first`` to ``last``, or those of ``ranges``. Each action on the result fetches them again."""
    ship_package(spark)
    spark.dataSource.register(paged_json(fetch))
    ranges = [(first, last)] if ranges is None else ranges
    return (
        spark.read.format("paged_json")
        .options(pageRanges=json.dumps(ranges), perPage=per_page, pagesPerTask=pages_per_task)
        .load()
    )


def land_pages(
    spark: SparkSession,
    fetch: Fetcher,
    path: str,
    *,
    per_page: int = DEFAULT_PER_PAGE,
    max_pages: int | None = None,
    largest_wave: int | None = None,
    resume: bool = False,
) -> DataFrame:
    """Fetch pages into tables below ``path``, each at most once; the pages that count.

    Waves of pages, each twice the one before up to ``largest_wave`` (by default a
    thousand pages for each slot), are written until one holds the end of the source
    or ``max_pages`` is reached. The only thing the driver learns of a wave is its
    first empty and first failed page, observed while it is written. A failed page
    raises only if it comes before the first empty one: later pages would never have
    been asked for.

    ``resume`` goes on from what an attempt that failed has landed: only pages it did not
    get are asked for, first those that failed or that their task did not reach after a
    failure, then those beyond. A landing with the end of the source is asked for nothing.
    A wave is a folder that counts once its success mark is in it, so a wave whose write
    broke off is fetched anew. Without ``resume`` an earlier landing is replaced.
    """
    slots = spark.sparkContext.defaultParallelism
    largest_wave = largest_wave or 1000 * slots
    first, wave, end = 1, min(4 * slots, largest_wave), None
    waves = _landed_waves(spark, path) if resume else []
    if not waves:
        _clear(spark, path)

    def fetch_wave(ranges: list[tuple[int, int]]) -> tuple[int | None, dict | None]:
        total = sum(high - low + 1 for low, high in ranges)
        seen = Observation()
        pages = read_pages(
            spark, fetch, ranges=ranges, per_page=per_page, pages_per_task=-(-total // (4 * slots))
        ).observe(seen, _first_empty(), _first_failed())
        folder = _wave_path(path, len(waves))
        writer = pages.write.mode("overwrite")
        try:
            writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(folder)
        except Exception as exc:
            what = f"pages {ranges[0][0]} to {ranges[-1][1]}"
            raise ExtractionError(f"{what} could not be landed: {exc}") from exc
        waves.append(folder)
        return seen.get["empty"], json.loads(seen.get["failed"] or "null")

    if waves:
        end, asked, lost = _landed(spark, waves, per_page, max_pages)
        first, wave = asked + 1, min(max(asked, wave), largest_wave)
        if lost:
            fetch_wave([(page["page_number"], page["asked_to"]) for page in lost])
            end, _, lost = _landed(spark, waves, per_page, max_pages)
        if lost:
            raise _failure(lost[0])
    while end is None and (max_pages is None or first <= max_pages):
        last = first + wave - 1 if max_pages is None else min(first + wave - 1, max_pages)
        end, failure = fetch_wave([(first, last)])
        if failure and (end is None or failure["page_number"] < end):
            raise _failure(failure)
        first, wave = last + 1, min(2 * wave, largest_wave)
    if max_pages is not None:
        first = min(first, max(max_pages, 0) + 1)
        end = first if end is None else min(end, max_pages + 1)
    return _waves(spark, waves).where(F.col("page_number") < (first if end is None else end))


def _first_empty() -> Column:
    return F.min(F.when(F.col("n_records") == 0, F.col("page_number"))).alias("empty")


def _first_failed() -> Column:
    failed = F.when(F.col("error").isNotNull(), F.struct("page_number", "error_class", "error"))
    return F.to_json(F.min(failed)).alias("failed")


def _wave_path(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/wave={number}"


def _landed_waves(spark: SparkSession, path: str) -> list[str]:
    """Folders of the waves that were written to their end; they are numbered from 0."""
    done: list[str] = []
    while path_exists(spark, f"{_wave_path(path, len(done))}/_SUCCESS"):
        done.append(_wave_path(path, len(done)))
    return done


def _clear(spark: SparkSession, path: str) -> None:
    """Remove an earlier landing, so that none of its waves is taken for one of the new."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    number = 0
    while path_exists(spark, _wave_path(path, number)):
        files.delete(hadoop.Path(_wave_path(path, number)), True)
        number += 1


def _waves(spark: SparkSession, waves: list[str]) -> DataFrame:
    if not waves:
        return spark.createDataFrame([], PAGES_DDL)
    return spark.read.schema(PAGES_DDL).parquet(*waves)


def _landed(
    spark: SparkSession, waves: list[str], per_page: int, max_pages: int | None
) -> tuple[int | None, int, list[dict]]:
    """First empty page, last page asked for, and the failed pages before the end in page order.

    A failed page that a later wave has is not lost. One that failed again may have had a
    shorter range then, whose rest another task took over, so the shortest counts. Failed
    pages are at most one a task that the driver planned; page numbers alone are read here.
    """
    pages = _waves(spark, waves).drop("records")
    seen = pages.agg(
        _first_empty(), F.max("asked_to").alias("asked"),
        F.min("per_page").alias("least"), F.max("per_page").alias("most"),
    ).first()
    if seen["asked"] is not None and (seen["least"], seen["most"]) != (per_page, per_page):
        raise ExtractionError(
            f"the landing holds pages of {seen['least']} and cannot go on in pages of {per_page}"
        )
    failed = pages.where("error IS NOT NULL").groupBy("page_number").agg(
        F.min("asked_to").alias("asked_to"), F.max(F.struct("error_class", "error")).alias("e")
    )
    lost = failed.join(pages.where("error IS NULL").select("page_number"), "page_number", "left_anti")
    limits = [bound for bound in (seen["empty"], max_pages and max_pages + 1) if bound is not None]
    if limits:
        lost = lost.where(F.col("page_number") < min(limits))
    rows = lost.select("page_number", "asked_to", "e.*").orderBy("page_number").collect()
    return seen["empty"], seen["asked"] or 0, [row.asDict() for row in rows]


def fetch_all(
    spark: SparkSession,
    fetch: Fetcher,
    landing: str,
    *,
    per_page: int = DEFAULT_PER_PAGE,
    max_pages: int | None = None,
    resume: bool = False,
) -> DataFrame:
    """All records of the source as ``payload`` rows, by way of the tables below ``landing``.

    The waves have found the end of the source, so this is one scan of the landing.
    """
    return explode_pages(
        land_pages(spark, fetch, landing, per_page=per_page, max_pages=max_pages, resume=resume)
    )


def probe_pages(spark: SparkSession, fetch: Fetcher) -> None:
    """Ask for page 1 at size 1; raise unless it holds a record."""
    try:
        page = read_pages(spark, fetch, last=1, per_page=1).drop("records").first()
    except Exception as exc:
        raise ExtractionError(f"the source could not be asked: {exc}") from exc
    if page["error"] is not None:
        raise _failure(page.asDict())
    if not page["n_records"]:
        raise ExtractionError("the source answered with no record")


def _failure(page: Mapping[str, Any]) -> ExtractionError:
    kind = ApiResponseError if page["error_class"] == ApiResponseError.__name__ else ExtractionError
    return kind(f"page {page['page_number']}: {page['error']}")
