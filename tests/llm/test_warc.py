import gzip
import hashlib
from pathlib import Path

import pytest

from attesta.llm.warc import GAP, _records, read_archives, warc_dedup, write_archives

PAGES = "page_id long, url string, html string"
LONG = "é" * 60
ROWS = [
    (5, "http://a/5", LONG), (3, "http://a/3\r\nX: y", LONG), (9, None, LONG), (1, "http://a/1", "short"), (2, "http://a/2", "short"), (4, "u", None), (6, "u", ""), (7, "u", "x\r\n\r\nWARC/1.1\r\n\r\n" * 20), (8, "u", "x\r\n\r\nWARC/1.1\r\n\r\n" * 20),
    (10, "u", "y" * 100 + "\r\n"), (11, "u", "\r\n" + "z" * 99 + "\r"), (12, "u", "\n\r\n\r\n\r" * 40), (13, "u", "a" * 99), (14, "u", "a" * 99), (15, "u", "b" * 3_000_000),
]


def brute(rows):
    """Of equal payloads one record of the smallest id, null last, is the response; all others refer to it."""
    groups = {}
    for i, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(i)
    out = []
    for body, ids in groups.items():
        digest = hashlib.sha256(body).hexdigest()
        ids.sort(key=lambda i: (i is None, i))
        for k, i in enumerate(ids):
            again = k > 0 and len(body) >= 100
            out.append((i, len(body), digest, "revisit" if again else "response", ids[0] if again else None))
    return sorted(out, key=str)


def test_odd_pages(spark):
    assert sorted(map(tuple, warc_dedup(spark.createDataFrame(ROWS, PAGES)).collect()), key=str) == brute(ROWS)


def test_null_ids_repeats_and_clashing_columns(spark):
    rows = [(None, "u", LONG), (1, "u", LONG), (1, "u", LONG), (2, "v", LONG), (2, "v", LONG)]
    df = spark.createDataFrame([(*r, "d", 1) for r in rows], PAGES + ", digest string, n long")
    assert sorted(map(tuple, warc_dedup(df).collect()), key=str) == brute(rows)
    assert warc_dedup(spark.createDataFrame([], PAGES)).count() == 0
    lost = [(None, "u", LONG), (None, "v", LONG), (None, "w", "short")]
    assert sorted(map(tuple, warc_dedup(spark.createDataFrame(lost, PAGES)).collect()), key=str) == brute(lost)


@pytest.mark.parametrize(("limit", "files"), [(1000, 5), (1000, 1), (3000, 3)])
def test_findings_in_passes(spark, tmp_path, limit, files):
    rows = [(i, f"http://h/{i}", LONG + str(i % 7)) for i in range(60)]
    spark.createDataFrame(rows, PAGES).repartition(files).write.parquet(str(tmp_path / "in"))
    write_archives(spark.read.parquet(str(tmp_path / "in")), str(tmp_path / "out"), limit=limit)
    assert sorted(map(tuple, read_archives(spark, str(tmp_path / "out")).collect()), key=str) == brute(rows)


def test_any_store(spark, store, sf_dir):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    pages = spark.read.parquet(store(f"{sf_dir}/pages.parquet"))
    path = store.new("archives")
    write_archives(pages, path)
    assert sorted(map(tuple, read_archives(spark, path).collect()), key=str) == brute(rows)


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    pages = pages.union(pages.selectExpr("page_id + 100000", "url", "html"))
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    got = sorted(map(tuple, warc_dedup(pages).collect()), key=str)
    assert got == brute(rows) and sum(r[3] == "revisit" for r in got) >= len(rows) // 2


def test_files_are_warc(spark, tmp_path):
    write_archives(spark.createDataFrame(ROWS, PAGES).coalesce(1), str(tmp_path / "w"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path, "w").glob("part-*"))
    seen, at = {}, 0
    while at < len(data):  # by Content-Length alone
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        begin = at + len(head) + 4
        block = data[begin : begin + int(fields["Content-Length"])]
        at = begin + len(block)
        assert data[at : at + 4] == b"\r\n\r\n" and block.startswith(b"HTTP/1.1 200 OK\r\n")
        at += 4
        assert fields["WARC-Record-ID"] not in seen
        seen[fields["WARC-Record-ID"]] = fields
    assert len(seen) == len(ROWS)
    for fields in seen.values():
        if fields["WARC-Type"] == "revisit":
            of = seen[fields["WARC-Refers-To"]]
            assert of["WARC-Type"] == "response" and of["WARC-Payload-Digest"] == fields["WARC-Payload-Digest"] and of["WARC-Target-URI"] == fields["WARC-Refers-To-Target-URI"]


def test_damage_is_noticed(spark, tmp_path):
    write_archives(spark.createDataFrame(ROWS[:1], PAGES), str(tmp_path / "w"))
    for p in Path(tmp_path, "w").glob("part-*"):
        p.write_bytes(gzip.compress(gzip.decompress(p.read_bytes()).replace("éé".encode(), "èé".encode(), 1)))
        Path(p.parent, f".{p.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="not what its header says"):
        read_archives(spark, str(tmp_path / "w")).collect()
    with pytest.raises(ValueError, match="ends within"):
        list(_records(iter([b"WARC/1.1\r\nContent-Length: 9", b"x"])))
    assert GAP == "\r\n\r\n"
