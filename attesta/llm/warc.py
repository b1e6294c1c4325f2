"""WARC archives in which equal payloads are stored once.

Headers alone (id, URL, digest, place) are shuffled by payload digest to find
each digest's original; revisit records are joined to their originals, and the
archives are then written with fresh headers: one response record for each
payload, a revisit record without the payload for every other capture. What was
found meets the payloads by file and place. Files are dealt into passes whose
findings are about BROADCAST_BYTES, so that each file is read in one pass, with
the findings broadcast and no payload shuffled; a pass of more than twice as many
(a file that has most) joins its rows by shuffle.

Archives are written by Spark's own text writer, a record a row: the rows are
separated by the two line ends that close a WARC record. So the files reach any
store that Spark writes to, and a task that is repeated replaces its own file.
They are gzip files and are read as a stream of such rows, record by record.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.session import Stage, compact, with_row_keys

#: Payloads of fewer bytes are always stored.
MIN_REVISIT_BYTES = 100
#: Bytes of findings (FOUND_BYTES and a URL each) that are broadcast at once.
BROADCAST_BYTES, FOUND_BYTES = 64 << 20, 64
CRLF, GAP = "\r\n", "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: A fixed date keeps archives of equal input equal.
DATE = "2000-01-01T00:00:00Z"


def _record_id(page_id: Column, digest: Column, url: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("-")), digest, F.coalesce(url, F.lit(""))))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _clean(url: Column) -> Column:
    """A URL as a header value: control characters and blanks are escaped."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]", "%20")


def with_digests(pages: DataFrame, key: Column, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    body = F.coalesce(F.col(body_col), F.lit(""))
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), body.alias("body"), F.octet_length(body).cast("long").alias("n"), F.sha2(F.encode(body, "UTF-8"), 256).alias("digest"), key["file"].alias("file"), key["row"].alias("row"))


def revisits(stage: Stage, rows: DataFrame, min_bytes: int) -> DataFrame:
    """File, row and the original's id and URL of each record that is to be a revisit.

    The original of a payload is the record of its smallest id, null ids last,
    the first by file and place of equal ones.
    """
    heads = stage.keep(rows.where(F.col("n") >= min_bytes).select("page_id", "url", "digest", "file", "row"))
    first = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id", "file", "row", "url")
    originals = heads.groupBy("digest").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1").select("digest", "first")
    found = heads.join(originals, "digest").where("file <> first.file or row <> first.row")
    return stage.put(compact(found.select("file", "row", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"), F.lit(True).alias("again"))), "revisits")


def _passes(found: DataFrame, limit: int) -> Iterator[tuple[Column, bool]]:
    """A condition on ``file`` for each pass, and whether its findings may be broadcast."""
    size = F.sum(F.coalesce(F.octet_length("first_url"), F.lit(0)) + FOUND_BYTES)
    n = max(1, -(-(found.agg(size).first()[0] or 0) // limit))
    share = F.pmod("file", F.lit(n))
    sizes = {r[0]: r[1] for r in found.groupBy(share).agg(size).collect()} if n > 1 else {}
    for i in range(n):
        yield share == i, sizes.get(i, 0) <= 2 * limit


def record_text(rows: DataFrame) -> DataFrame:
    """One column, the record up to the line ends that close it."""
    is_revisit = F.coalesce("again", F.lit(False))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=UTF-8{CRLF}Content-Length: "), F.col("n").cast("string"), F.lit(GAP))
    field = lambda name, value: F.concat(F.lit(f"{CRLF}{name}: "), value)
    head = F.concat(
        F.lit("WARC/1.1"),
        field("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"), F.col("url"))),
        field("WARC-Date", F.lit(DATE)),
        field("WARC-Target-URI", _clean(F.col("url"))),
        F.when(F.col("page_id").isNotNull(), field("X-Page-ID", F.col("page_id").cast("string"))).otherwise(""),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(is_revisit, F.concat(
            field("WARC-Profile", F.lit(PROFILE)), field("WARC-Refers-To", _record_id(F.col("first_id"), F.col("digest"), F.col("first_url"))),
            field("WARC-Refers-To-Target-URI", _clean(F.col("first_url"))), F.coalesce(field("X-Refers-To-Page-ID", F.col("first_id").cast("string")), F.lit("")),
        )).otherwise(""),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", (F.octet_length(http) + F.when(is_revisit, 0).otherwise(F.col("n"))).cast("string")),
    )
    return rows.select(F.concat(head, F.lit(GAP), http, F.when(is_revisit, "").otherwise(F.col("body"))).alias("value"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", limit: int = BROADCAST_BYTES) -> None:
    """Write one record for each row, payloads in UTF-8, into gzip archives under ``path``.

    Of records with equal payloads of ``min_bytes`` or more, the one with the
    smallest id is a response and all others revisit it: those of null ids and
    those that repeat the id too, of which the first by file and place is the
    response if there is no smaller one. A null payload is empty. A null URL is
    empty in the header, a null id in none. Other columns are ignored; an empty
    table gives no record.
    """
    stage = Stage(pages.sparkSession, "warc")
    pages, key = with_row_keys(stage, pages)
    rows = with_digests(pages, key, id_col, url_col, body_col)
    found = revisits(stage, rows, min_bytes)
    stage.close("revisits", "rows")

    for k, (share, fits) in enumerate(_passes(found, limit)):
        some = found.where(share)
        marked = rows.where(share).join(F.broadcast(some) if fits else some, ["file", "row"], "left")
        record_text(marked).write.mode("append" if k else "overwrite").option("lineSep", GAP).option("compression", "gzip").text(path)
    stage.close()


def _records(blocks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record, from the pieces that a stream of archives falls into at GAP."""
    gap, held = GAP.encode(), b""
    while True:
        head = held or next(blocks, None)
        held = b""
        if head is None:
            return
        head = head.lstrip(b"\r\n")
        if not head:
            continue
        lines = head.decode().split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record begins with {lines[0][:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        need, parts, got = int(fields["Content-Length"]), [], 0
        while not parts or got < need:
            part = next(blocks, None)
            if part is None:
                raise ValueError("an archive ends within a record")
            got += len(part) + len(gap) * bool(parts)
            parts.append(part)
        data = gap.join(parts)
        data, held = data[:need], data[need:]
        yield fields, data


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def blocks() -> Iterator[bytes]:
        for batch in batches:
            for value in batch.column(0):
                yield value.as_py()

    def packed(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)], names)

    rows: list = []
    for fields, data in _records(blocks()):
        head, _, payload = data.partition(GAP.encode())
        n, digest = int(head.rpartition(b"Content-Length: ")[2]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
        if fields["WARC-Type"] == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
            raise ValueError(f"{fields['WARC-Record-ID']}: the payload is not what its header says")
        number = lambda name: int(fields[name]) if name in fields else None  # noqa: E731, B023
        rows.append((number("X-Page-ID"), n, digest, fields["WARC-Type"], number("X-Refers-To-Page-ID")))
        if len(rows) >= 10_000:
            yield packed(rows)
            rows = []
    if rows:
        yield packed(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record; each payload is checked against its digest."""
    text = spark.read.option("lineSep", GAP).text(path).select(F.col("value").cast("binary").alias("value"))
    return text.mapInArrow(_parse, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def warc_dedup(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write the archives into the shared folder and read them back."""
    path = Stage(pages.sparkSession, "archives").path("warc")
    write_archives(pages, path, min_bytes)
    return read_archives(pages.sparkSession, path)
