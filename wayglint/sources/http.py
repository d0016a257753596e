"""A paged JSON service as a Spark data source: one partition a key, bounded retries, failures as rows."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "key string, page int, status string, error string, json string"


def fetch(url: str, timeout: float) -> tuple[int, str]:
    with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
        return r.status, r.read().decode()


def pages_of(url: str, key: str, page_size: int, retries: int = 3, pause: float = 1.0, timeout: float = 30.0, get: Callable = fetch, stale: int = 3, rate: float = 0.0) -> Iterator[tuple]:
    """Rows ``key, page, status, error, json`` of one key: pages until one is short, or ``stale`` in a row bring no new id.

    ``rate`` bounds the calls a second, if it is not zero.

    A page is tried ``retries`` times with doubling pauses; then a row with status ``failed`` ends the key.
    """
    seen: set = set()
    page = without = 0
    last = float("-inf")
    while True:
        error, text = None, None
        for attempt in range(retries):
            if rate and (early := last + 1 / rate - time.monotonic()) > 0:
                time.sleep(early)
            last = time.monotonic()
            try:
                status, text = get(url.format(key=key, page=page), timeout)
                if status == 200:
                    json.loads(text)
                    error = None
                    break
                error = f"status {status}"
            except (urllib.error.URLError, OSError, ValueError) as x:
                error = f"{type(x).__name__}: {x}"
            if attempt + 1 < retries:
                time.sleep(pause * 2**attempt)
        if error is not None:
            yield key, page, "failed", error, None
            return
        records = [r for r in json.loads(text).get("data") or [] if isinstance(r, dict)]
        new = {r.get("id") for r in records} - seen
        if new:
            yield key, page, "ok", None, text
        without = 0 if new else without + 1
        if len(records) < page_size or without >= stale:
            return
        seen |= new
        page += 1


class PagedJson(DataSource):
    """Options: url (with {key} and {page}), keys (comma-joined), page_size, retries, pause, timeout, stale, rate; tokens belong in the url from the environment."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(k) for k in self.options["keys"].split(",") if k]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        o = self.options
        return pages_of(o["url"], partition.value, int(o.get("page_size", 2000)), int(o.get("retries", 3)), float(o.get("pause", 1)), float(o.get("timeout", 30)), stale=int(o.get("stale", 3)), rate=float(o.get("rate", 0)))


def split_by_status(rows):
    """``(answered, failed)``; failed keys can be read again."""
    return rows.where("status = 'ok'"), rows.where("status <> 'ok'")
