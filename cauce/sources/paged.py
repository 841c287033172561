"""Pages of a JSON API as a Spark data source: one range of pages per task, one row per page.

A row holds a page's text as it came. ``read_pages`` takes the records out of the
texts with the same expression that reads stored pages.

The class travels to the executors by value, so they need no installed copy of
this package, only Python and PyArrow.
"""

import json
import sys
import time
import urllib.error
import urllib.parse
import urllib.request
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from cauce.shared import shared_dir, written
from cauce.sources.records import page_records

# Fixed value: records per page.
PAGE_LIMIT = 50000
# Fixed value: seconds before a request is given up; the task then fails and Spark retries it.
TIMEOUT_SECONDS = 30
# Seconds between requests that the server refuses for their number.
WAIT_SECONDS = (1, 2, 4, 8, 16)
# What the data source gives: place counts the part's records before the page.
PAGE = "part int, place bigint, records bigint, body string"


def records_of(body: str, place: str) -> list:
    """The records of a page's text."""
    found = json.loads(body)
    if not isinstance(found, list):
        raise ValueError(f"page {place} is no JSON array")
    return found


def _literal(value) -> str:
    """A key as the API's query language writes it."""
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else json.dumps(value)


class HttpPages:
    """Pages of a REST endpoint that takes ``$limit``, ``$offset``, ``$order``, ``$where`` and ``$select``."""

    def __init__(self, url, order, opener=urllib.request.urlopen):
        if not order:
            raise ValueError("pages are read at once and need an order that ends in a unique column")
        self.url = url
        self.order = order
        self.opener = opener

    def _get(self, params):
        separator = "&" if "?" in self.url else "?"
        address = f"{self.url}{separator}{urllib.parse.urlencode(params)}"
        for wait in (*WAIT_SECONDS, None):
            try:
                with self.opener(address, timeout=TIMEOUT_SECONDS) as response:
                    return response.read().decode("utf-8-sig")
            except urllib.error.HTTPError as refused:
                if refused.code not in (429, 503) or wait is None:
                    raise
                time.sleep(wait)

    def fetch(self, offset, limit):
        """The text of the page that skips ``offset`` records."""
        return self._get({"$limit": limit, "$offset": offset, "$order": self.order})

    def count(self):
        row = json.loads(self._get({"$select": "count(*) as n"}))[0]
        return int(next(iter(row.values())))

    def _between(self, after, upto):
        bounds = [(">", after), ("<=", upto)]
        found = " and ".join(f"{self.order} {sign} {_literal(key)}" for sign, key in bounds if key is not None)
        return {"$where": found} if found else {}

    def next_key(self, after, step):
        """The key of the ``step``-th record after the key ``after``; None where there are fewer."""
        params = {"$select": self.order, "$order": self.order, "$limit": 1, "$offset": step - 1}
        found = json.loads(self._get(params | self._between(after, None)))
        return found[0][self.order] if found else None

    def fetch_after(self, after, upto, limit):
        """The text of the first records with ``after`` < key <= ``upto``, in the order of the key."""
        # System fields such as :id come only when they are asked for.
        fields = {"$select": ":*,*"} if self.order.startswith(":") else {}
        return self._get({"$limit": limit, "$order": self.order} | fields | self._between(after, upto))


@dataclass
class PageRange(InputPartition):
    offset: int
    records: int
    last: bool


def _batch(part, place, records, body):
    values = [[part], [place], [records], [body]]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in PAGE.split(", ")]
    return pa.record_batch([pa.array(v, t) for v, t in zip(values, types)], names)


class PageReader(DataSourceReader):
    """Ranges by position: a page is asked for by the number of records to skip."""

    def __init__(self, pages, limit, pages_per_task, total, first):
        self.pages = pages
        self.limit = limit
        self.pages_per_task = pages_per_task
        self.total = total
        self.first = first

    def partitions(self):
        total = self.pages.count() if self.total is None else self.total
        open_ended = self.first is None or self.first > total
        if not open_ended:
            total = self.first
        step = self.limit * self.pages_per_task
        starts = list(range(0, total, step)) or [0]
        return [
            PageRange(start, min(step, total - start), open_ended and start == starts[-1])
            for start in starts
        ]

    def read(self, partition):
        """The pages of the range.

        A page shorter than asked for is followed by a request for the rest. The
        last range goes on past the planned total until a short or empty page,
        so records added after the count are read too.
        """
        done = 0
        while partition.last or done < partition.records:
            left = partition.records - done
            asked = self.limit if left <= 0 else min(self.limit, left)
            if partition.last:
                asked = self.limit
            offset = partition.offset + done
            body = self.pages.fetch(offset, asked)
            records = len(records_of(body, f"at offset {offset}"))
            if records:
                yield _batch(0, offset, records, body)
            done += records
            if not records and done < partition.records:
                raise ValueError(
                    f"no records at offset {offset}; {partition.records - done} more were counted"
                )
            if partition.last and done >= partition.records and records < asked:
                return


@dataclass
class KeyRange(InputPartition):
    part: int
    after: object
    upto: object


class KeyReader(DataSourceReader):
    """Ranges by key: a page is asked for by the key of the record before it.

    No request skips more records than a task reads, and records that come or go
    during the read shift no page. The key must be unique and never NULL.
    """

    def __init__(self, pages, key, limit, pages_per_task, first):
        self.pages = pages
        self.key = key
        self.limit = limit
        self.step = limit * pages_per_task
        self.first = first

    def partitions(self):
        if self.first is not None:
            return [KeyRange(0, None, None)]
        bounds = [None]
        # Each bound is counted from the one before, so that bounds always ascend.
        while (bound := self.pages.next_key(bounds[-1], self.step)) is not None:
            bounds.append(bound)
        return [KeyRange(i, a, b) for i, (a, b) in enumerate(zip(bounds, [*bounds[1:], None]))]

    def read(self, partition):
        """The pages of the range, until an empty one."""
        done, after = 0, partition.after
        while self.first is None or done < self.first:
            asked = self.limit if self.first is None else min(self.limit, self.first - done)
            body = self.pages.fetch_after(after, partition.upto, asked)
            found = records_of(body, f"after key {after}")
            if not found:
                return
            keys = [record.get(self.key) for record in found]
            if None in keys or len({json.dumps(k) for k in keys}) < len(keys) or keys[0] == after:
                raise ValueError(f"the key {self.key} is missing or not unique after {after}")
            yield _batch(partition.part, done, len(found), body)
            done, after = done + len(found), keys[-1]


class PagedJson(DataSource):
    """``spark.read.format("paged_json")``: the pages of ``url``, as rows of ``PAGE``.

    Options: ``url``; ``order`` of pages by position, which ends in a unique
    column; or ``key``, one unique column, of pages by key. ``limit`` records per
    page; ``pagesPerTask``; ``total`` to spare the count request; ``first`` to read that
    many records from the start and no more pages than they take. A subclass may
    override ``pages``.
    """

    @classmethod
    def name(cls):
        return "paged_json"

    def schema(self):
        return PAGE

    def pages(self, limit):
        return HttpPages(self.options["url"], self.options.get("key") or self.options.get("order"))

    def reader(self, schema: StructType):
        limit = self._number("limit", PAGE_LIMIT)
        pages, key = self.pages(limit), self.options.get("key")
        per_task, first = self._number("pagesPerTask", 1), self._number("first", None)
        if key:
            return KeyReader(pages, key, limit, per_task, first)
        return PageReader(pages, limit, per_task, self._number("total", None), first)

    def _number(self, option, default):
        text = self.options.get(option)
        return default if text is None else int(text)


def count_records(source: type[DataSource] = PagedJson, **options) -> int:
    """How many records the server says it has."""
    return source(options).pages(int(options.get("limit", PAGE_LIMIT))).count()


def _numbered(pages: DataFrame) -> DataFrame:
    """Pages by key with ``place`` counted from the first part on; they are written once for that."""
    pages = written(pages, shared_dir(pages.sparkSession))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pages.groupBy("part").agg(F.sum("records").alias("rows"))
    # One row for each task of the read.
    starts = starts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return pages.join(F.broadcast(starts), "part").withColumn("place", F.col("start") + F.col("place"))


def read_pages(
    spark: SparkSession, schema: StructType, source: type[DataSource] = PagedJson, **options
) -> DataFrame:
    """All records of a paged source; ``options`` as for ``PagedJson``.

    The schema names the record fields, all STRING, and may hold ``id`` BIGINT,
    the position of the record from 1: the id is therefore contiguous. With ``key``
    the pages are read and written to the shared folder right away, each record
    once; fewer records than the server counted before are an error.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(source)
    pages = spark.read.format(source.name()).options(**options).load()
    if options.get("key"):
        counted = None if "first" in options else count_records(source, **options)
        pages = _numbered(pages)
        if counted is not None:
            found = pages.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]
            if found < counted:
                raise ValueError(f"{counted} records were counted and {found} read: records went, or the key is not unique")
    return page_records(pages, "place", "body", schema)
