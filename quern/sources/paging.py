"""A paged service as a stream: spark.readStream.format("paged_stream").

The offset is the service's own cursor, so a stopped stream goes on where its
checkpoint stands and asks for no page twice; a page whose batch was planned but
not committed is asked for again by its cursor. One caller, paced, retries as the
service asks. A page's rows pass through the driver, one page a batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.error import HTTPError, URLError
from urllib.parse import urlencode
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from quern.sources.readers import Pacer, RetryLater

#: Fixed answers after which the service may be asked again.
AGAIN = (429, 500, 502, 503, 504)


class ServiceError(ValueError):
    """The service's answer is no page: no object, no list of records, a result code other than zero, or a cursor that came before."""


class Client:
    """One paced caller of one service. Options: url, records (name of the list), key (of the next cursor, in answers and requests), code
    (name of a result code that must be zero, if any), gap (seconds between calls), attempts, wait (seconds where the service names none), header.* (headers)."""

    def __init__(self, options: dict[str, str], pacer: Pacer | None = None):
        self.options = options
        self.pacer = pacer or Pacer(float(options.get("gap", 0.1)))
        self.headers = {k[7:]: v for k, v in options.items() if k.startswith("header.")}

    def _ask(self, target: str) -> dict:
        try:
            with urlopen(Request(target, headers=self.headers), timeout=60) as answer:
                return json.load(answer)
        except HTTPError as e:
            if e.code in AGAIN:
                named = e.headers.get("Retry-After") or ""
                raise RetryLater(float(named) if named.isdigit() else float(self.options.get("wait", 15))) from e
            raise
        except (URLError, TimeoutError) as e:
            raise RetryLater(float(self.options.get("wait", 5))) from e

    def page(self, cursor: str | None) -> tuple[list[dict], str | None]:
        """The records of the page at a cursor, and the next cursor."""
        url, name, key = self.options["url"], self.options.get("records", "data"), self.options.get("key", "pagination_key")
        target = url if cursor is None else f"{url}{'&' if '?' in url else '?'}{urlencode({key: cursor})}"
        for attempt in range(attempts := int(self.options.get("attempts", 5))):
            self.pacer.wait()
            try:
                body = self._ask(target)
                break
            except RetryLater as later:
                if attempt + 1 == attempts:
                    raise
                self.pacer.sleep(later.seconds)
        if not isinstance(body, dict) or not isinstance(body.get(name), list):
            raise ServiceError(f"the answer to {target} has no list {name!r}")
        if (code := self.options.get("code")) and str(body.get(code)) not in ("0", "00", "000"):
            raise ServiceError(f"the answer to {target} has the result code {body.get(code)!r}")
        return [r for r in body[name] if isinstance(r, dict)], str(body[key]) if body.get(key) else None


def advanced(offset: dict, following: str | None) -> dict:
    """The offset after a page. A cursor that comes again is an error: a mark is moved to each power of two of pages, so any cycle meets it, and
    the offset stays small however many pages there are."""
    if following is None:
        return {**offset, "page": offset["page"] + 1, "done": True}
    if following in (offset["cursor"], offset["mark"]):
        raise ServiceError(f"page key {following!r} came twice")
    page = offset["page"] + 1
    moved = page & (page - 1) == 0
    return {"cursor": following, "page": page, "done": False, "mark": following if moved else offset["mark"]}


class PagedStream(DataSource):
    """Rows (page, position, record): a record as canonical JSON. Options as of Client."""

    @classmethod
    def name(cls) -> str:
        return "paged_stream"

    def schema(self) -> str:
        return "page long, position int, record string"

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _Pages(dict(self.options))


class _Pages(SimpleDataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.client = Client(options)

    def initialOffset(self) -> dict:
        return {"cursor": None, "page": 0, "done": False, "mark": None}

    def _rows(self, offset: dict, records: list[dict]) -> list[tuple]:
        return [(offset["page"], i, json.dumps(r, sort_keys=True, ensure_ascii=False)) for i, r in enumerate(records)]

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if start["done"]:
            return iter(()), start
        records, following = self.client.page(start["cursor"])
        return iter(self._rows(start, records)), advanced(start, following)

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        """The pages from one offset up to another, asked for again after a failure."""
        while start["page"] < end["page"]:
            records, following = self.client.page(start["cursor"])
            yield from self._rows(start, records)
            start = advanced(start, following)

    def commit(self, end: dict) -> None:
        pass


def paged(spark, url: str, **options: str) -> DataFrame:
    """The stream of a paged service's records."""
    spark.dataSource.register(PagedStream)
    reader = spark.readStream.format("paged_stream").option("url", url)
    for name, value in options.items():
        reader = reader.option(name, str(value))
    return reader.load()


def last_of_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (page, position, ...) reduced to one for each of the keys, the last in order of pages: combined before the shuffle."""
    one = rows.groupBy(*keys).agg(F.max_by(F.struct(*(c for c in rows.columns if c not in keys)), F.struct("page", "position")).alias("_last"))
    return one.select(*keys, "_last.*")
