"""A data source for dated resources: one partition, so that requests keep their distance; found and missing ones are cached."""

from __future__ import annotations

import importlib
import os
import time

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def http_get(url: str, timeout: int = 60) -> bytes | None:
    """The body, None for 404; other errors are raised."""
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, headers={"Accept": "application/xml", "User-Agent": "pliego"}), timeout=timeout) as r:
            return r.read()
    except HTTPError as e:
        if e.code == 404:
            return None
        raise


class GazetteSource(DataSource):
    """Options: urls (one a line), cache (folder), get ("module:function", for tests), pause (seconds between requests), negative (cache 404s too)."""

    @classmethod
    def name(cls) -> str:
        return "gazette"

    def schema(self) -> str:
        return "url string, body string"

    def reader(self, schema):
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        where, _, what = self.options.get("get", "pliego.sources.fetch:http_get").partition(":")
        get, cache, pause = getattr(importlib.import_module(where), what), self.options.get("cache"), float(self.options.get("pause", "1"))
        last = 0.0
        for url in filter(None, self.options.get("urls", "").split("\n")):
            path = os.path.join(cache, url.rsplit("/", 1)[-1]) if cache else None
            if path and os.path.exists(path):
                yield url, open(path, encoding="utf-8").read()
                continue
            if path and os.path.exists(path + ".404"):
                yield url, None
                continue
            time.sleep(max(0.0, pause - (time.monotonic() - last)))
            try:
                body = get(url)
            finally:
                last = time.monotonic()
            if path and (body is not None or self.options.get("negative", "true") == "true"):
                with open(path if body is not None else path + ".404", "wb") as f:
                    f.write(body or b"")
            yield url, None if body is None else body.decode("utf-8")
