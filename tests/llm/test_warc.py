import gzip
import hashlib

import pytest

from sessionscope.llm import warc
from sessionscope.llm.queries import op10_warc

from .conftest import SF01


def brute(pages, min_bytes=100):
    first = {}
    for p, html in pages:
        if p is not None:
            b = (html or "").encode()
            first[b] = min(first.get(b, p), p)
    out = []
    for p, html in pages:
        b = (html or "").encode()
        again = len(b) >= min_bytes and b in first and first[b] != p
        out.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response",
                    first[b] if again else None))
    return sorted(out, key=str)


def collected(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
                   .collect()), key=str)


def table(spark, pages):
    return spark.createDataFrame([(p, f"http://x/{p}", h) for p, h in pages], "page_id long, url string, html string")


PAGES = [(1, "a" * 99), (2, "a" * 99), (3, "é" * 50), (4, "é" * 50), (5, None), (6, ""), (7, "b\r\n\r\nWARC/1.1\r\n" * 40),
         (0, "b\r\n\r\nWARC/1.1\r\n" * 40), (9, "long " * 100000), (10, "long " * 100000), (9, "long " * 100000),
         (None, "long " * 100000), (None, "c" * 120), (None, "c" * 120), (12, "x" * 1000)]


def test_query_equals_brute_force(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF01}/pages.parquet").select("page_id", "html").collect()]
    assert collected(op10_warc(spark, SF01)) == brute(pages)


@pytest.mark.parametrize("chunk_bytes", [7, 1000, 1 << 20])
def test_edge_cases(spark, chunk_bytes):
    pages = [p for p in PAGES if chunk_bytes > 7 or len(p[1] or "") < 2000]
    df = table(spark, pages).withColumn("digest", warc.F.lit("clash")).withColumn("url", warc.F.lit(None).cast("string"))
    assert collected(warc.round_trip(df, chunk_bytes=chunk_bytes)) == brute(pages)


def test_empty_table(spark):
    assert collected(warc.round_trip(table(spark, []))) == []


def test_chunks_rebuild_the_payload_and_carry_digests(spark, tmp_path):
    archives = warc.write_archives(warc.classify(table(spark, PAGES)), str(tmp_path / "w"))
    got = warc.read_archives(archives, 1000).where("record_type = 'response'").orderBy("record_id", "chunk").collect()
    by_record = {}
    for r in got:
        by_record.setdefault(r.record_id, []).append(r)
    payloads = []
    for chunks in by_record.values():
        whole = b"".join(bytes(c.payload) for c in chunks)
        assert [c.chunk for c in chunks] == list(range(len(chunks))) and all(c.chunk_bytes <= 1000 for c in chunks)
        assert [c.is_last for c in chunks] == [False] * (len(chunks) - 1) + [True]
        for i, c in enumerate(chunks):
            assert c.running_digest == hashlib.sha256(whole[:(i + 1) * 1000]).hexdigest()
        assert chunks[-1].payload_digest == chunks[-1].running_digest
        payloads.append(whole)
    assert sorted(payloads) == sorted(
        (h or "").encode() for p, h in PAGES
        if len((h or "").encode()) < 100 or all(x is None for x, y in PAGES if y == h)
        or p == min(x for x, y in PAGES if y == h and x is not None))


def test_archives_are_gzip_members_in_warc_form(spark, tmp_path):
    archives = warc.write_archives(warc.classify(table(spark, PAGES[:4])).coalesce(1), str(tmp_path / "w")).collect()
    assert sum(r.n_records for r in archives) == 4
    data = b"".join(gzip.open(r.path).read() for r in archives)
    assert data.count(b"WARC/1.1\r\n") == 4 and data.endswith(b"\r\n\r\n")
    assert data.count(b"WARC-Type: revisit") == 1


def test_damaged_archives_fail(spark, tmp_path):
    (path,) = [r.path for r in warc.write_archives(
        warc.classify(table(spark, PAGES[:2])).coalesce(1), str(tmp_path / "w")).collect()]
    data = gzip.open(path).read()
    frame = spark.createDataFrame([(path,)], "path string")
    for bad in (data[:-20], data.replace(b"aaaa", b"aaab", 1)):
        with gzip.open(path, "wb") as out:
            out.write(bad)
        with pytest.raises(Exception, match="archive ends|does not match"):
            warc.read_archives(frame).collect()
