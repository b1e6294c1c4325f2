"""Pages as a data source: spark.read.format("attesta.pages").

Options: ``backend`` is "module:function", called with a URL and giving what a
provider gives (raw_markdown, html, metadata and so on), or "fixture" for pages of
a Parquet file or folder (``path``, columns url and html). ``urls`` names a file of
URLs, one a line, or holds them itself, one a line; a fixture without them gives
all its pages, each row its own, but for those without URL, numbered by their
place. ``lanes``: partitions of requests, ``retries``, ``limit``: the first so
many requests, or rows of a whole fixture.

A fixture is read in order, never searched: all of it by row groups, of which a
task has about PART_BYTES and the driver the footers alone; the URLs of a lane in
one pass, in which the first page of a URL answers.

Equality on url is pushed down to the requests, so that what isn't asked for isn't
fetched. As a stream, offsets are lines of the file of URLs, which may grow, or
rows of a fixture; ``batch`` bounds those of a micro-batch.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterable, Iterator, Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, InputPartition

from attesta.session import Stage

NAME = "attesta.pages"


#: Bytes of a fixture's row groups that a task reads (one group at least), and pages that it hands on at once.
PART_BYTES, AT_ONCE = 32 << 20, 64


def _whole(options: Mapping[str, str]) -> bool:
    """Whether all pages of a fixture are asked for."""
    return options.get("backend", "fixture") == "fixture" and "urls" not in options


def requests_of(options: Mapping[str, str]) -> list[str]:
    """The URLs asked for, in order."""
    given = options["urls"]
    if "://" in given.split("\n")[0] and not given.startswith("file://"):
        lines = given.split("\n")
    else:
        with open(given.removeprefix("file://"), encoding="utf-8") as f:
            lines = f.read().split("\n")[:-1]  # a line without its end is still being written
    return [x.strip() for x in lines if x.strip()]


class Requests(InputPartition):
    def __init__(self, rows: Sequence[tuple[int, str]]):
        self.rows = list(rows)


class Piece(NamedTuple):
    """Rows ``begin`` to ``end`` of a row group whose first row has the number ``first``."""

    files: object
    path: str
    group: int
    first: int
    begin: int
    end: int


class Pieces(InputPartition):
    def __init__(self, pieces: Sequence[Piece]):
        self.pieces = list(pieces)


def _groups(options: Mapping[str, str]) -> Iterator[tuple[Piece, int]]:
    """The row groups of a fixture, and the bytes of each."""
    import pyarrow.dataset as ds

    at, table = 0, ds.dataset(options["path"].removeprefix("file://"), format="parquet")
    for f in sorted(table.get_fragments(), key=lambda f: f.path):
        for g in f.row_groups:
            yield Piece(table.filesystem, f.path, g.id, at, 0, g.num_rows), g.total_byte_size
            at += g.num_rows


def fixture_partitions(options: Mapping[str, str], begin: int = 0, end: int | None = None) -> list[Pieces]:
    """The rows ``begin`` to ``end`` of a fixture, about PART_BYTES a partition."""
    out, size = [], PART_BYTES
    for p, n in _groups(options):
        p = p._replace(begin=max(0, begin - p.first), end=p.end if end is None else min(p.end, end - p.first))
        if p.begin < p.end:
            if size + n > PART_BYTES:
                out.append(Pieces([]))
                size = 0
            out[-1].pieces.append(p)
            size += n
    return out or [Pieces([])]


def _fixture_pages(pieces: Iterable[Piece], wanted: Iterable[str] | None = None) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
    """Numbers, URLs and HTML of the pages that have a URL, or one of those ``wanted``; HTML is read only of row groups that have some."""
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    among = None if wanted is None else pa.array(wanted, pa.string())
    for p in pieces:
        with p.files.open_input_file(p.path) as f:
            file, at = pq.ParquetFile(f), 0
            fits = lambda urls: urls.is_valid() if among is None else pc.is_in(urls.cast(pa.string()), among)
            if among is not None and not pc.any(fits(file.read_row_group(p.group, ["url"]).column("url"))).as_py():
                continue
            for batch in file.iter_batches(AT_ONCE, [p.group], ["url", "html"]):
                begin, end = max(0, p.begin - at), min(len(batch), p.end - at)
                if begin < end:
                    rows = batch.slice(begin, end - begin)
                    numbers = pa.array(range(p.first + at + begin, p.first + at + end), pa.int64())
                    keep = fits(rows.column("url"))
                    yield tuple(c.filter(keep) for c in (numbers, rows.column("url").cast(pa.string()), rows.column("html").cast(pa.string())))
                at += len(batch)


def _hits(numbers: pa.Array, urls: pa.Array, html: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
    n = len(urls)
    have = {"ord": numbers, "url": urls, "success": pa.repeat(True, n), "raw_markdown": html.fill_null(""), "html": html, "cache_status": pa.repeat("hit", n), "metadata": pa.array([[]] * n, schema.field("metadata").type)}
    return pa.RecordBatch.from_arrays([have[f.name] if f.name in have else pa.nulls(n, f.type) for f in schema], schema=schema)


def _rows(rows: Sequence[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    cols[-1] = [list(m.items()) for m in cols[-1]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _answers(rows: Sequence[tuple[int, str]], options: Mapping[str, str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """What a fixture has of the URLs asked for, in one pass over it; the rest failed."""
    waiting: dict[str, list[int]] = {}
    for o, url in rows:
        waiting.setdefault(url, []).append(o)
    if not waiting:
        return
    for _, urls, html in _fixture_pages((p for p, _ in _groups(options)), list(waiting)):
        found = [(o, i) for i, url in enumerate(urls.to_pylist()) for o in waiting.pop(url, ())]
        if found:
            at = pa.array([i for _, i in found], pa.int64())
            yield _hits(pa.array([o for o, _ in found], pa.int64()), urls.take(at), html.take(at), schema)
        if not waiting:
            return
    lost = [(o, url, None, False, "LookupError: not found", "", None, None, None, {}) for url, asked in waiting.items() for o in asked]
    for at in range(0, len(lost), AT_ONCE):
        yield _rows(lost[at : at + AT_ONCE], schema)


def _batches(partition: Requests | Pieces, options: Mapping[str, str], schema, url: str | None = None) -> Iterator[pa.RecordBatch]:
    from pyspark.sql.pandas.types import to_arrow_schema

    from attesta.sources.providers import fetched_row

    kinds = to_arrow_schema(schema)
    if isinstance(partition, Pieces):
        yield from (_hits(*page, kinds) for page in _fixture_pages(partition.pieces, None if url is None else [url]))
    elif options.get("backend", "fixture") == "fixture":
        yield from _answers(partition.rows, options, kinds)
    else:
        module, _, function = options["backend"].partition(":")
        fetch, retries = getattr(importlib.import_module(module), function), int(options.get("retries", 2))
        for at in range(0, len(partition.rows), AT_ONCE):
            yield _rows([fetched_row(o, url, fetch, retries) for o, url in partition.rows[at : at + AT_ONCE]], kinds)


class PagesReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str], schema):
        self.options, self.schema, self.url, self.none = dict(options), schema, None, False

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("url",):
                self.none |= self.url is not None and self.url != f.value
                self.url = f.value
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        most = int(self.options["limit"]) if "limit" in self.options else None
        if _whole(self.options):
            return [Pieces([])] if self.none else fixture_partitions(self.options, 0, most)
        rows = list(enumerate(requests_of(self.options)))[:most]
        rows = [r for r in rows if not self.none and self.url in (None, r[1])]
        lanes = max(1, min(int(self.options.get("lanes", 4)), len(rows)))
        return [Requests(rows[i::lanes]) for i in range(lanes)]

    def read(self, partition: Requests | Pieces) -> Iterator[pa.RecordBatch]:
        return _batches(partition, self.options, self.schema, self.url)


class PagesStream(DataSourceStreamReader):
    """Offsets are numbers of requests, or of a whole fixture's rows."""

    def __init__(self, options: Mapping[str, str], schema):
        self.options, self.schema, self.at = dict(options), schema, 0

    def initialOffset(self) -> dict:
        return {"line": 0}

    def latestOffset(self) -> dict:
        """``batch`` lines or rows beyond the last offset at most."""
        n = sum(p.end for p, _ in _groups(self.options)) if _whole(self.options) else len(requests_of(self.options))
        self.at = min(n, self.at + int(self.options.get("batch", 1000)))
        return {"line": self.at}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.at = max(self.at, end["line"])
        if _whole(self.options):
            return fixture_partitions(self.options, start["line"], end["line"])
        rows = list(enumerate(requests_of(self.options)))[start["line"] : end["line"]]
        lanes = max(1, min(int(self.options.get("lanes", 4)), len(rows)))
        return [Requests(rows[i::lanes]) for i in range(lanes)]

    def read(self, partition: Requests | Pieces) -> Iterator[pa.RecordBatch]:
        return _batches(partition, self.options, self.schema)

    def commit(self, end: dict) -> None:
        self.at = max(self.at, end["line"])


class Pages(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        from attesta.sources.providers import FETCHED

        return FETCHED

    def reader(self, schema) -> DataSourceReader:
        return PagesReader(self.options, schema)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PagesStream(self.options, schema)


def fixture(spark: SparkSession, path: str) -> str:
    """The path of a fixture, or of its copy in the shared folder if Spark reaches it and pyarrow doesn't."""
    from pyarrow import fs

    try:
        files, at = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
        if files.get_file_info(at).type != fs.FileType.NotFound:
            return path
    except (OSError, pa.ArrowInvalid, pa.ArrowNotImplementedError):
        pass
    stage = Stage(spark, "fixture")
    stage.put(spark.read.parquet(path).select("url", "html"), "pages")
    return stage.path("pages")


def register(spark: SparkSession) -> None:
    """Make the format known to a session, and let it have what is asked of it: its reader takes filters, which Spark allows by a setting."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Pages)
