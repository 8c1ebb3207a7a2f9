"""A connector as a Python data source: paged records of a landed dump, read in partitions by page.

Remote sources are landed as JSON lines first. The driver reads the file once and notes where each page of
`page_size` lines starts; a partition then seeks there and reads its page, so that every line comes once, however many there are.
The file has to lie in a folder that the driver and all workers see; for other file systems use connectors.read_landed.

By default a missing file or a line that isn't a JSON object fails the read. With lenient=true such a line comes as a row
with its text as payload and the reason as error, and the rest is read; a missing file still fails.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "id string, source string, payload string, error string"


class PagedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)


class Page(InputPartition):
    def __init__(self, start: int, lines: int):
        self.start, self.lines = start, lines


class PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.source = options["path"], options.get("source", "")
        self.page = max(1, int(options.get("page_size", 500)))
        self.lenient = str(options.get("lenient", "false")).lower() == "true"

    def partitions(self) -> list[Page]:
        starts, lines, at = [], 0, 0
        with open(self.path, "rb") as f:
            for line in f:
                if lines % self.page == 0:
                    starts.append(at)
                at += len(line)
                lines += 1
        return [Page(s, min(self.page, lines - k * self.page)) for k, s in enumerate(starts)] or [Page(0, 0)]

    def read(self, partition: Page) -> Iterator[tuple]:
        with open(self.path, "rb") as f:
            f.seek(partition.start)
            for _ in range(partition.lines):
                line = f.readline().decode("utf-8", "replace").strip()
                if line:
                    yield self.record(line)

    def record(self, line: str) -> tuple:
        try:
            doc = json.loads(line)
            if not isinstance(doc, dict):
                raise ValueError("not an object")
        except ValueError as e:
            if not self.lenient:
                raise
            return None, self.source, line, str(e)
        return None if doc.get("id") is None else str(doc["id"]), self.source or doc.get("source", ""), line, None
