import random

import duckdb
import pytest

from sparkloom.llm import warc as W


def pages(spark):
    rng = random.Random(0)
    long = "".join(rng.choices("abcdé<> \n", k=40_000))
    rows = [(10, "http://a/x", "y" * 100), (3, "http://a/y", "y" * 100), (7, None, "y" * 100), (1, "u", "short"), (2, "u", "short"), (4, "u", None), (5, "u", ""), (6, "u\r\nEvil: 1", long), (8, "u", long)]
    rows += [(100 + i, "u", "p%d " % i * rng.randrange(1, 3000)) for i in range(30)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_round_trip(spark):
    df = pages(spark)
    pages_ = df.toPandas()
    con = duckdb.connect()
    con.register("pages", pages_)
    want = sorted(con.sql(W.ORACLE).fetchall(), key=repr)
    back = W.op8(df)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, back.select(*names).collect()), key=repr) == want
    assert {r[0] for r in want if r[3] == "revisit"} == {7, 10, 8}
    full = {r.page_id: r for r in W.read(W.written_archives(df, 100)).collect()}  # many segments
    for r in df.collect():
        got = full[str(r.page_id)]
        assert got.error is None and (got.record_type == "revisit" or got.payload == (r.html or "").encode())
    assert W.op8(df.limit(0)).count() == 0


def test_hot_payload(spark):
    df = spark.range(5000).selectExpr("id AS page_id", "'u' AS url", "repeat('z', 200) AS html", "1 AS first", "2 AS salt", "3 AS digest")
    got = W.op8(df)
    assert got.filter("record_type = 'revisit' AND refers_to = 0").count() == 4999


def test_segments():
    whole = bytes(range(200))
    parts = [(i + 1, len(whole) if i == 3 else None, whole[i * 50 : i * 50 + 50]) for i in range(4)]
    assert W.joined(parts[::-1]) == whole and W.joined([*parts, parts[1]]) == whole
    for bad in (parts[1:], parts[:3], [parts[0], *parts[2:]], [*parts[:3], (4, 999, parts[3][2])]):
        with pytest.raises(ValueError):
            W.joined(bad)


def test_chunks():
    for n in (0, 1, 4096, 10_000):
        body = random.Random(n).randbytes(n)
        assert W.unchunked(W.chunked(body)) == body
    assert W.unchunked(b"3;x=1\r\nabc\r\n0\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nab", b"zz\r\n", b"2\r\nabXX0\r\n\r\n"):
        with pytest.raises(ValueError):
            W.unchunked(bad)


def test_files_and_damage(spark, tmp_path):
    records = list(W.page_records("urn:x", 9, "http://a", b"b" * 500, "d", None, 500, 200))
    (tmp_path / "a.warc.gz").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(records[:-1]))
    got = sorted((r.page_id, r.payload_bytes, r.error) for r in W.read_files(spark, str(tmp_path / "a.warc.gz")).collect())
    assert got == [("9", 500, None)]
    lost = W.read_files(spark, str(tmp_path / "b.warc.gz")).collect()
    assert [(r.payload, r.error) for r in lost] == [(None, "total length differs")]
