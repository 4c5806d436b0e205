import base64
import gzip
import hashlib

import pytest

from pyspark.sql import functions as F
from conftest_llm import collect
from sitelens.llm import warc
from sitelens.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, shard int, n int"


def pages(spark, rows, parts=3):
    return spark.createDataFrame([(i, u, h, "x", 1, 2) for i, u, h in rows], SCHEMA).repartition(parts)


def brute(rows, min_bytes=0):
    keep = {}
    for i, _, h in rows:
        h = h or ""
        if len(h.encode()) >= min_bytes and i is not None:
            keep[h] = max(keep.get(h, i), i)
    out = []
    for i, u, h in rows:
        data = (h or "").encode()
        first = keep.get(h or "", i) if len(data) >= min_bytes else i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if i == first else "revisit", None if i == first else first))
    return sorted(out, key=repr)


def answer(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=repr)


ROWS = [(1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>one</p>"), (3, None, None), (4, "http://c/\r\nX-Evil: 1", ""),
        (5, "http://d/é", "é\r\n\r\n" * 3000), (6, "u", "WARC/1.1\r\n\r\n"), (7, "", "last"), (7, "", "last"), (None, "n", "null id"), (None, "n", "last"),
        *[(100 + i, f"http://h/{i}", "hot") for i in range(200)], *[(400 + i, f"http://u/{i}", f"page {i} " * 50) for i in range(200)]]


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_round_trip(spark, min_bytes):
    manifest, out = warc.archive_pages(pages(spark, ROWS), min_bytes=min_bytes, shard_bytes=60_000, roll_bytes=6_000)
    back = warc.read_archives(manifest, out)
    assert answer(back) == brute(ROWS, min_bytes)
    urls = dict(collect(back.filter("page_id < 7"), "page_id", "url"))
    assert urls[5] == "http://d/é" and urls[3] is None and urls[4] == "http://c/%0D%0AX-Evil: 1"
    files = manifest.collect()
    assert len({r["shard"] for r in files}) > 1 and any(r["roll"] for r in files)
    assert all(r["bytes"] < 6_000 + 4_000 for r in files)


def read(manifest, out):
    fs, base = warc.open_store(out)
    return {r["name"]: fs.open_input_file(f"{base}/{r['name']}").read() for r in manifest.collect()}


def test_files_are_deterministic_and_plain_gzip(spark):
    a = read(*warc.archive_pages(pages(spark, ROWS, 2), shard_bytes=60_000, roll_bytes=6_000))
    b = read(*warc.archive_pages(pages(spark, ROWS[::-1], 5), shard_bytes=60_000, roll_bytes=6_000))
    assert a == b
    for data in a.values():
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")


def test_commit_repeats_and_hides_lost_attempts(spark):
    manifest, out = warc.archive_pages(pages(spark, ROWS))
    fs, base = warc.open_store(out)
    with fs.open_output_stream(f"{base}/_temporary/lost-pages-000000-0000.warc.gz") as f:
        f.write(b"half a file")
    again = warc.commit(spark.createDataFrame(manifest.collect(), warc.MANIFEST), out)
    assert answer(warc.read_archives(again, out)) == brute(ROWS)


def test_wrong_digest_and_cut_file_raise(spark):
    data = warc.record(1, "u", b"payload", None, False)
    assert warc.parse(data)["payload_bytes"] == 7
    with pytest.raises(OSError):
        warc.parse(data.replace(b"\r\npayload", b"\r\npayl0ad").replace(b"\r\n\r\npayload", b"\r\n\r\npayl0ad"))
    out = scratch_path(spark, "cut")
    fs, base = warc.open_store(out)
    fs.create_dir(base, recursive=True)
    with fs.open_output_stream(f"{base}/x.warc.gz", compression=None) as f:
        f.write(gzip.compress(data)[:-20])
    with pytest.raises(OSError):
        list(warc.members(fs, f"{base}/x.warc.gz"))


def test_empty_table(spark):
    manifest, out = warc.archive_pages(pages(spark, []))
    assert manifest.count() == 0 and warc.read_archives(manifest, out).count() == 0


def test_shards_follow_bytes_whatever_the_ids(spark, tmp_path):
    """Dense ids with one far off, a third of all rows without an id, one id
    on many rows: shards stay near their size, and nothing is lost."""
    html = "x" * 1000
    far = [(i, f"http://a/{i}", f"{i} {html}") for i in range(400)] + [(2 ** 60, "http://far", "far"), (-2 ** 62, "http://near", "near")]
    null = [(None, f"http://n/{i}", f"n{i} {html}") for i in range(200)]
    same = [(7, f"http://s/{i}", f"s{i % 90} {html}") for i in range(200)] + [(7, f"http://u/{i}", html) for i in range(100)]
    pages = spark.createDataFrame(far + null + same, "page_id long, url string, html string").repartition(4)
    rows = warc._shards(warc.mark_copies(pages), 20_000)
    sizes = {r["shard"]: r["n"] for r in rows.groupBy("shard").agg(F.sum(F.octet_length("payload") + 600).alias("n")).collect()}
    assert max(sizes.values()) <= 20_000 and len(sizes) <= 3 * sum(sizes.values()) / 20_000
    ranges = sorted((r["shard"], r["lo"], r["hi"]) for r in rows.filter("page_id IS NOT NULL").groupBy("shard").agg(
        F.min("page_id").alias("lo"), F.max("page_id").alias("hi")).collect())
    assert all(a[2] <= b[1] for a, b in zip(ranges, ranges[1:]))
    manifest, out = warc.archive_pages(pages, str(tmp_path / "w"), shard_bytes=20_000, roll_bytes=8_000)
    assert warc.read_archives(manifest, out).count() == len(far + null + same)
