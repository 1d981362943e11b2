"""Search results of a code host as a Spark data source: one partition per page, read where it is needed.

    spark.dataSource.register(RepositorySearch)
    spark.read.format("repository_search").option("url", "https://host/search/repositories?q=x").option("pages", 3).load()

The address may be any that ``urllib`` opens, a file's too; ``{page}`` in it is the page's number, else ``page=N`` is added.
The conditions of a search are then applied by ``readers.search``.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from urllib.request import Request, urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

FIELDS = "full_name string, description string, language string, license string, stars long, forks long, size long, archived boolean, fork boolean, created_at timestamp, default_branch string, page int"


class RepositorySearch(DataSource):
    """Options: ``url``; ``pages`` (1), the greatest number of pages; ``token``; ``pause`` (0), seconds before a request."""

    @classmethod
    def name(cls) -> str:
        return "repository_search"

    def schema(self) -> str:
        return FIELDS

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Pages(dict(self.options))


class _Pages(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(n) for n in range(1, int(self.options.get("pages", 1)) + 1)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        """The rows of a page; a page beyond the last is empty, other failures raise, so the task is tried again."""
        from datetime import datetime
        from urllib.error import HTTPError, URLError

        number, url = partition.value, self.options["url"]
        address = url.replace("{page}", str(number)) if "{page}" in url else f"{url}{'&' if '?' in url else '?'}page={number}"
        headers = {"Authorization": f"Bearer {self.options['token']}"} if self.options.get("token") else {}
        time.sleep(float(self.options.get("pause", 0)))
        try:
            with urlopen(Request(address, headers=headers), timeout=60) as reply:  # noqa: S310 - the address is the user's own option
                found = json.load(reply)
        except HTTPError as e:
            if e.code in (404, 422):
                return
            raise
        except URLError as e:
            if isinstance(e.reason, FileNotFoundError) or "No such file" in str(e.reason):
                return
            raise
        for x in found.get("items", found) if isinstance(found, dict) else found:
            made = x.get("created_at")
            yield (
                x.get("full_name"),
                x.get("description"),
                x.get("language"),
                (x.get("license") or {}).get("key"),
                x.get("stargazers_count"),
                x.get("forks_count"),
                x.get("size"),
                x.get("archived"),
                x.get("fork"),
                datetime.fromisoformat(made) if made else None,
                x.get("default_branch"),
                number,
            )
