"""A feed that is read page by page, each page naming the next, as a streaming source.

Pages lie under ``path`` as ``feed=<feed>/cursor=<cursor>/next=<cursor>/`` with files of one payload a
line, which is how Spark writes text by these three columns: see ``land_pages``. The chain of a feed
starts at the cursor ``first`` and goes on as far as pages have landed. The offset of the stream is the
last cursor taken of each feed, so a run, or a restart from a checkpoint, goes on behind it and every
page is given once.

The driver follows names of folders only. Each page is a partition of its own, which a task reads line
by line. A page must land whole: cursors that lead back to a page already taken end the chain.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "cursor_feed"
SCHEMA = "feed string, cursor string, payload string"
FIRST = "first"

# Fixed value: what Spark escapes in names of partition folders.
ESCAPED = r"""[\x00-\x1f\x7f"#%'*/:=?\\{\[\]^]"""


class _Page(InputPartition):
    def __init__(self, feed: str, cursor: str, folder: str):
        super().__init__(None)
        self.feed, self.cursor, self.folder = feed, cursor, folder


def _names(system: fs.FileSystem, folder: str, column: str) -> list[tuple[str, str]]:
    """Values of a column and their folders, in order; none where there is no folder."""
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    start = f"{column}="
    return sorted(
        (unquote(f.base_name[len(start):]), f.path)
        for f in found
        if f.type == fs.FileType.Directory and f.base_name.startswith(start)
    )


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def _root(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path)

    def _next(self, system: fs.FileSystem, root: str, feed: str, cursor: str) -> str | None:
        """The cursor that a landed page names, nothing if the page has not landed."""
        place = f"{root}/feed={_escaped(feed)}/cursor={_escaped(cursor)}"
        names = _names(system, place, "next")
        return names[0][0] if names else None

    def _chain(self, feed: str, taken: str | None) -> Iterator[tuple[str, str]]:
        """Cursors and folders of the landed pages behind the one that was taken last."""
        system, root = self._root()
        cursor = FIRST if taken is None else self._next(system, root, feed, taken)
        seen = {taken}
        while cursor is not None and cursor not in seen:
            after = self._next(system, root, feed, cursor)
            if after is None:
                return
            seen.add(cursor)
            yield cursor, f"{root}/feed={_escaped(feed)}/cursor={_escaped(cursor)}"
            cursor = after

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        system, root = self._root()
        known = getattr(self, "_known", {})
        for feed, _ in _names(system, root, "feed"):
            for cursor, _ in self._chain(feed, known.get(feed)):
                known[feed] = cursor
        self._known = known  # within a run the chain is followed on from here
        return dict(known)

    def partitions(self, start: dict, end: dict) -> list[_Page]:
        pages = []
        for feed in sorted(end):
            for cursor, folder in self._chain(feed, start.get(feed)):
                if start.get(feed) == end[feed]:
                    break
                pages.append(_Page(feed, cursor, folder))
                if cursor == end[feed]:
                    break
        return pages

    def read(self, partition: _Page) -> Iterator[tuple]:
        system, _ = self._root()
        found = system.get_file_info(fs.FileSelector(partition.folder, recursive=True))
        for file in sorted(f.path for f in found if f.type == fs.FileType.File):
            if file.rsplit("/", 1)[1].startswith(("_", ".")):
                continue
            with system.open_input_stream(file) as lines:
                for line in _lines(lines):
                    yield partition.feed, partition.cursor, line


def _lines(stream, size: int = 1 << 20) -> Iterator[str]:
    """The lines of a file that are not blank, read in pieces."""
    rest = b""
    while piece := stream.read(size):
        *whole, rest = (rest + piece).split(b"\n")
        yield from (line.decode() for line in whole if line.strip())
    if rest.strip():
        yield rest.decode()


def _escaped(value: str) -> str:
    """A value as it stands in the name of a folder."""
    return re.sub(ESCAPED, lambda c: f"%{ord(c[0]):02X}", value)


class CursorFeed(DataSource):
    """The format ``cursor_feed`` with the option ``path``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> _Reader:
        return _Reader(self.options["path"])


def stream_feed(spark: SparkSession, path: str) -> DataFrame:
    """``feed, cursor, payload``: the entries of all feeds under ``path``, each page once."""
    spark.dataSource.register(CursorFeed)
    return spark.readStream.format(FORMAT).option("path", path).load()


def land_pages(pages: DataFrame, path: str) -> None:
    """Write entries ``feed, cursor, next, payload`` as pages. A payload is one line of JSON."""
    plain = pages.select("feed", "cursor", "next", "payload")
    plain.repartition("feed", "cursor").write.mode("append").partitionBy(
        "feed", "cursor", "next"
    ).text(path)
