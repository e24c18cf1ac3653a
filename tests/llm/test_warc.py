import gzip
import hashlib
import os

import pytest

from recordloom.llm.warc import archive, read_warc, records_in, warc_files

PAGES = "page_id bigint, url string, html string, digest string, PAGE_ID string"


def rows_of(big):
    return [(1, "http://a/", big), (2, None, big), (9, "http://b/\r\nX: y", big), (3, "u", ""), (4, "u", None), (5, "u", "small"), (6, "u", "small"), (7, "ü", "é" * 700), (8, "u", "é" * 700),
            (None, "n", "é" * 700), (10, "u", "x" * 300_000)]


def test_revisits_and_payloads(spark):
    rows = rows_of("big " * 400)
    df = spark.createDataFrame([(*r, "d", "p") for r in rows], PAGES)
    _, files = archive(df)
    got = {r.record_id: r for r in read_warc(files).collect()}
    assert len(got) == len(rows)
    for i, url, html in rows:
        r = got[f"<urn:page:{'' if i is None else i}>"]
        raw = (html or "").encode()
        same = [x[0] or -1 for x in rows if (x[2] or "") == (html or "")] if len(raw) >= 1000 else [i or -1]
        first = max(same)
        assert (r.payload_bytes, r.payload_digest, r.digest_ok) == (len(raw), hashlib.sha1(raw).hexdigest(), True)
        assert r.record_type == ("response" if first == (i or -1) else "revisit")
        assert r.refers_to == (None if first == (i or -1) else f"<urn:page:{first}>")
        assert (r.payload is None) == (r.record_type == "revisit") and (r.payload is None or bytes(r.payload) == raw)
    assert read_warc(archive(df.limit(0))[1]).count() == 0


@pytest.mark.parametrize("step", [1, 7, 100, 4096])
def test_every_record_has_one_owner(spark, tmp_path, step):
    df = spark.createDataFrame([(i, "u", os.urandom(i * 37 % 900).hex(), "d", "p") for i in range(20)], PAGES).coalesce(1)
    path = archive(df)[1].first().path.removeprefix("file://")
    good = open(path, "rb").read()
    whole = list(records_in(path, 0, len(good), len(good)))
    assert len(whole) == 20
    hurt = tmp_path / "hurt.warc.gz"
    hurt.write_bytes(b"\x1f\x8b\x08junk" + good + b"\x1f\x8b" + gzip.compress(b"not a record") + good[: len(good) // 2 + 5])
    size = hurt.stat().st_size
    every = list(records_in(str(hurt), 0, size, size))
    assert len(every) >= 28
    parts = [r for a in range(0, size, step) for r in records_in(str(hurt), a, min(a + step, size), size)]
    assert parts == every


def test_files_by_glob(spark):
    folder, files = archive(spark.createDataFrame([(i, "u", f"p{i}", "d", "p") for i in range(5)], PAGES))
    listed = warc_files(spark, f"{folder}/*.warc.gz")
    assert listed.agg({"bytes": "sum"}).first()[0] == files.agg({"bytes": "sum"}).first()[0]
    assert read_warc(listed, range_bytes=50).count() == 5
