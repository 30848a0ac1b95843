import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tallyline.llm import archives
from tallyline.sources.workspace import new_path


def plain(pages):
    """The result by grouping payloads in memory."""
    first = {}
    for i, _, html in pages:
        payload = (html or "").encode()
        if len(payload) >= 100:
            first[payload] = min(first.get(payload, i), i)
    out = []
    for i, _, html in pages:
        payload = (html or "").encode()
        keeper = first.get(payload, i)
        kind = "response" if keeper == i else "revisit"
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), kind, None if keeper == i else keeper))
    return out


def made(n=200, seed=1):
    rng = random.Random(seed)
    bodies = ["", None, "x" * 99, "y" * 100, "é" * 50, "WARC/1.1\r\n\r\nhttp://a 1.1.1.1 20200101000000 text/html 5\n" * 4]
    bodies += ["<p>" + "".join(rng.choice("ab \r\né😀") for _ in range(rng.randrange(300))) for _ in range(40)]
    urls = ["http://a.example/x y\nz", None, "", "https://b.example/?q=1"]
    return [(i, rng.choice(urls), rng.choice(bodies)) for i in range(n)] + [(n, "http://long.example", "ü" * 2_000_000)]


def rows_of(df):
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return [tuple(r) for r in df.select(names).collect()]


def test_round_trip(spark):
    pages = made()
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "1 as archive", "2 as uri", "3 as date")
    assert sorted(rows_of(archives.archive_pages(df.repartition(3), records=17))) == sorted(plain(pages), key=lambda r: r[0])


def test_repeated_rows_and_null_ids(spark):
    body = "z" * 200
    df = spark.createDataFrame([(3, "u", body), (3, "u", body), (None, "v", body), (4, "w", None)], "page_id long, url string, html string")
    rows = sorted(rows_of(archives.archive_pages(df)), key=str)
    digest = hashlib.sha256(body.encode()).hexdigest()
    none = hashlib.sha256(b"").hexdigest()
    expected = [(3, 200, digest, "response", None), (3, 200, digest, "revisit", 3), (None, 200, digest, "revisit", 3), (4, 0, none, "response", None)]
    assert rows == sorted(expected, key=str)


def test_empty_table(spark):
    assert archives.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


@pytest.mark.parametrize("version", [1, 2])
def test_records_of_either_version(version):
    body = b"no http\nhttp://x 1.2.3.4 20200101000000 text/plain 3\n"
    line = {
        1: b"ftp://host/a b 1.2.3.4 19990102030405 text/plain %d\n",
        2: b"ftp://host/a b 1.2.3.4 19990102030405 text/plain 200 abc - 77 x.arc %d\n",
    }[version]
    content = archives.version_block(version, "x.arc").encode() + b"\n" + line % len(body) + body + b"\n"
    for stored in (content, gzip.compress(content)):
        info, record = (archives.synthesised("x", r) for r in archives.arc_records("x", stored))
        assert info["warc_type"] == "warcinfo"
        assert (record["warc_type"], record["media_type"], record["ip"]) == ("resource", "text/plain", "1.2.3.4")
        assert (record["date"], record["block"]) == ("1999-01-02T03:04:05Z", body)
        assert record["uri"] == "ftp://host/a b"
        assert record["record_id"].startswith("urn:uuid:")


def test_broken_archives_raise():
    good = archives.version_block(1, "x.arc").encode()
    with pytest.raises(ValueError, match="ends after"):
        list(archives.arc_records("x", good + b"\nhttp://a 0.0.0.0 20200101000000 text/html 50\nshort"))
    with pytest.raises(ValueError, match="version 7"):
        list(archives.arc_records("x", good.replace(b"\n1 0", b"\n7 0", 1)))


def test_every_file_begins_with_its_version(spark):
    path = new_path(spark, "arc-test")
    df = spark.createDataFrame(made(60), "page_id long, url string, html string")
    archives.write_arc(df.repartition(2), path, records=5)
    read = archives.read_arc(spark, path)
    per_file = read.groupBy("archive").agg(F.min_by("warc_type", "offset").alias("first"), F.count("*").alias("n")).collect()
    assert len(per_file) >= 12
    assert {r["first"] for r in per_file} == {"warcinfo"} and max(r["n"] for r in per_file) <= 6


def test_files_are_full_by_bytes(spark):
    pages = [(k, f"http://{k}.example", chr(97 + k % 26) * (300_000 if k % 10 else 3_000_000)) for k in range(60)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(2)
    arc, warc = new_path(spark, "arc-bytes"), new_path(spark, "warc-bytes")
    archives.write_arc(df, arc, file_bytes=1_000_000)
    archives.write_warc(archives.read_arc(spark, arc).withColumn("refers_to_id", F.lit(None).cast("string")), warc, 1_000_000)
    for path, read in ((arc, archives.read_arc), (warc, archives.read_warc)):
        sizes = read(spark, path).groupBy("archive").agg(F.sum("payload_bytes").alias("bytes"), F.max("payload_bytes").alias("largest"))
        sizes = sizes.collect()
        # beyond the limit only by the record that reached it
        assert len(sizes) > 15 and all(r["bytes"] < 1_000_000 + r["largest"] + 1000 for r in sizes)
    found = archives.read_warc(spark, warc).where("record_type = 'response'").collect()
    assert sorted(r.page_id for r in found) == list(range(60))
