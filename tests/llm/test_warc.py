import base64
import hashlib
import random

import pytest

from rasterloom.llm import warc
from rasterloom.llm.common import fresh_folder


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def digest(x):
    return base64.b32encode(hashlib.sha1((x or "").encode()).digest()).decode()


def test_round_trip_and_seeks(spark):
    rng = random.Random(2)
    rows = [(k, f"http://h/{k}", rng.choice(["", "same", "é" * 5000, f"own {k} " * rng.randint(1, 4000)])) for k in range(300)]
    folder = fresh_folder(spark, "warc")
    index = warc.write_warc(pages(spark, rows).repartition(3), folder, frame_bytes=20_000, bundle_bytes=3_000)
    assert index.count() == 300 and index.select("bundle").distinct().count() > 3 and index.select("bundle", "frame").distinct().count() > 10
    first = {}
    for k, _, html in rows:
        first.setdefault(html, k)
    got = {int(r.id): r for r in warc.read_warc(spark, folder).collect()}
    for k, url, html in rows:
        r = got[k]
        assert (r.url, r.payload_bytes, r.payload_digest) == (url, len(html.encode()), digest(html))
        assert (r.record_type, r.refers_to) == (("response", None) if first[html] == k else ("revisit", str(first[html])))
        assert r.payload is None if r.refers_to else bytes(r.payload).decode() == html
    some = warc.fetch_records(index, folder, spark.createDataFrame([(5,), (250,), (999,)], "page_id long"), "page_id").collect()
    assert sorted(int(r.id) for r in some) == [5, 250] and all(got[int(r.id)].payload_digest == r.payload_digest for r in some)


def test_nulls_repeats_and_small_payloads(spark):
    rows = [(1, "a b\r\n", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""), (None, "u", "same"), (2, "v", "same"), (1, "w", "same")]
    folder = fresh_folder(spark, "warc")
    warc.write_warc(pages(spark, rows), folder)
    got = sorted((r.id or "", r.record_type, r.refers_to or "", r.payload_bytes) for r in warc.read_warc(spark, folder).collect())
    assert got == [("", "revisit", "1", 4), ("1", "response", "", 4), ("1", "response", "", 4), ("2", "revisit", "1", 4), ("2", "revisit", "1", 4), ("3", "response", "", 0), ("4", "revisit", "3", 0)]
    folder = fresh_folder(spark, "warc")
    warc.write_warc(pages(spark, rows), folder, least_bytes=5)
    assert {r.record_type for r in warc.read_warc(spark, folder).collect()} == {"response"}


def test_empty_table_and_wrong_bytes(spark, tmp_path):
    folder = fresh_folder(spark, "warc")
    assert warc.write_warc(pages(spark, []), folder).count() == 0 and warc.read_warc(spark, folder).count() == 0
    import pyarrow.fs as pafs

    (tmp_path / "x").write_bytes(b"0" * 40)
    with pafs.LocalFileSystem().open_input_file(str(tmp_path / "x")) as f, pytest.raises(ValueError):
        warc.seek_table(f)
    with pytest.raises(ValueError):
        list(warc.read_records(b"HTTP/1.1 200\r\n\r\n"))
