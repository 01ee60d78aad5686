import base64
import gzip
import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from termcluster.llm.warc_members import inflated, normalise, page_record, read_records, split_records, warc_round_trip, write_archives

PAGES = "page_id long, url string, html string"
COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def plain(rows, least=0):
    """The op11 contract."""
    ids = defaultdict(list)
    for i, _, html in rows:
        ids[(html or "").encode()].append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        known = [x for x in ids[data] if x is not None]
        first = min(known) if known and len(data) >= least else None
        again = first is not None and first != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def pages(n=120, seed=1):
    r = random.Random(seed)
    texts = ["<p>" + " ".join(r.choice("alpha beta gamma é 日本 \r\n\r\n WARC/1.1".split(" ")) for _ in range(r.randint(1, 90))) for _ in range(n // 2)]
    return [(i, f"http://h/{i}", r.choice(texts)) for i in range(n)]


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, PAGES).repartition(parts)


@pytest.mark.parametrize("size", [64 << 20, 2000])
def test_equals_the_contract(spark, size):
    rows = pages()
    assert result(warc_round_trip(frame(spark, rows), archive_bytes=size)) == plain(rows)


def test_odd_rows(spark):
    rows = pages(40) + [(500, None, None), (501, "u", ""), (502, "u", None), (None, "u", pages(40)[3][2]), (None, None, "only null ids"), (None, "x", "only null ids"),
                        (7, "again", pages(40)[7][2]), (503, "bad\r\nurl: x y", "\r\n\r\n"), (504, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n"), (505, "u", "long " * 900_000), (-3, "u", pages(40)[5][2])]
    docs = frame(spark, rows).withColumn("digest", F.lit(1)).withColumn("payload", F.lit("x")).withColumn("first", F.lit(0))
    got = warc_round_trip(docs, with_payload=True)
    assert result(got) == plain(rows)
    texts = defaultdict(set)
    for i, _, html in rows:
        texts[i].add((html or "").encode())
    for r in got.collect():
        assert (r.payload is None) == (r.record_type == "revisit")
        assert r.payload is None or bytes(r.payload) in texts[r.page_id]
    urls = {r.page_id: r.url for r in got.collect()}
    assert urls[500] is None and urls[503] == "bad%0D%0Aurl:%20x%20y"


def test_short_payloads_are_never_revisits(spark):
    rows = [(i, "u", "ab" if i % 2 else "abcdef") for i in range(10)]
    assert result(warc_round_trip(frame(spark, rows), least_bytes=3)) == plain(rows, 3)


def test_a_third_of_all_pages_are_copies(spark):
    rows = [(i, "u", "same" if i % 3 == 0 else f"page {i}") for i in range(3000)]
    assert result(warc_round_trip(frame(spark, rows, 16))) == plain(rows)


def test_empty_table(spark):
    assert warc_round_trip(frame(spark, [])).collect() == []


def test_members_and_index(spark, tmp_path):
    """Streams are one member each; afterwards every index entry is a member that
    inflates by itself to one record."""
    rows = pages(60)
    manifest = write_archives(frame(spark, rows, 2), str(tmp_path), archive_bytes=9000)
    streams = {r.path: r.records for r in manifest.collect()}
    assert len(streams) > 3
    members = normalise(manifest, str(tmp_path)).collect()
    assert sorted(r.records for r in members) == sorted(streams.values())
    whole = sorted(gzip.open(p).read() for p in streams)
    assert sorted(gzip.open(r.path).read() for r in members) == whole
    for r in members:
        data = open(r.path, "rb").read()
        places = np.fromfile(r["index"], "<u8").reshape(-1, 2).tolist()
        assert len(places) == r.records and places[0][0] == 0 and sum(places[-1]) == len(data)
        parts = [gzip.decompress(data[a:a + b]) for a, b in places]
        assert all(p.startswith(b"WARC/1.1\r\n") and p.endswith(b"\r\n\r\n") for p in parts)
        assert b"".join(parts) in whole


def test_foreign_archives_and_damage(spark, tmp_path):
    """Several members in a stream are read as one; damage is an error."""
    records = [page_record(i, "u", b"x" * i, hashlib.sha1(b"x" * i).digest(), False, None) for i in range(5)]
    path = tmp_path / "crawl.warc.gz"
    path.write_bytes(gzip.compress(b"".join(records[:2])) + gzip.compress(b"".join(records[2:])))
    found = read_records(normalise(spark.createDataFrame([(str(path),)], "path string"), str(tmp_path)), range_records=2)
    assert sorted((r.page_id, bytes(r.payload)) for r in found.collect()) == [(i, b"x" * i) for i in range(5)]

    def read(raw):
        p = tmp_path / "bad.gz"
        p.write_bytes(raw)
        with p.open("rb") as f:
            return list(split_records(inflated(f, "bad"), "bad"))

    good = gzip.compress(b"".join(records))
    assert read(good) == records and read(b"") == []
    big = [page_record(1, "u", b"z" * 30_000_000, hashlib.sha1(b"z" * 30_000_000).digest(), False, None)]
    assert read(gzip.compress(big[0])) == big
    for bad in (good[:-12], good + b"junk", gzip.compress(b"".join(records)[:-7]), gzip.compress(records[0] + b"WARC/1.1\r\nX: y"), gzip.compress(b"no record\r\n\r\n")):
        with pytest.raises(ValueError):
            read(bad)
