import hashlib

import pytest

from cardspark.llm import warc
from cardspark.llm.common import scratch_path
from cardspark.llm.warc import (
    Directory, build_index, captures, lookup, parse_record, read_captures, read_range,
    read_record, round_trip, url_key, write_archives,
)

SCHEMA = "page_id long, url string, html string, digest string, block int"
BIG = "<p>" + "é long \r\n\r\n body " * 20


def rows():
    out = [(5, "http://a.example.com/x?y=1", BIG), (3, "http://a.example.com/x?y=1", BIG),
           (9, "https://b.example.com:81/", BIG), (1, None, "short"), (2, None, "short"),
           (4, "http://A.example.com", None), (6, "no url\tat\nall", ""), (None, "http://c/", BIG),
           (7, "http://u@d.example.com/p#f", "x" * 99), (8, "http://d.example.com/p", "x" * 99),
           (10, "http://d.example.com/p", "x" * 100), (11, "http://d.example.com/q", "x" * 100),
           (11, "http://d.example.com/q", "x" * 100)]
    out += [(100 + i, "http://hot.example.com/", f"page {i}") for i in range(50)]
    return [(*r, "z", 1) for r in out]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def want(r, least):
    payload = (r[2] or "").encode()
    same = [x[0] for x in rows() if (x[2] or "") == (r[2] or "") and x[0] is not None]
    first = min(same) if len(payload) >= 100 and sum(
        (x[2] or "") == (r[2] or "") for x in rows()) > 1 else None
    revisit = first is not None and r[0] != first
    return (r[0], len(payload), hashlib.sha256(payload).hexdigest(),
            "revisit" if revisit else "response", first if revisit else None)


def test_round_trip(pages):
    got = sorted(map(tuple, round_trip(pages).collect()), key=str)
    assert got == sorted((want(r, 100) for r in rows()), key=str)


def test_empty(spark):
    assert round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.fixture(scope="module")
def archive(spark, pages):
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    return path


def test_point_lookup_and_range_read(spark, pages, archive, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    index = build_index(captures(spark, archive))
    assert index.count() > 10
    directory = Directory(index)
    assert len(directory.blocks(url_key("http://hot.example.com/"))) > 5  # one key, many blocks
    assert directory.blocks("zzz") == []
    urls = spark.createDataFrame([("http://hot.example.com/",), (None,), ("http://nowhere/",)],
                                 "url string")
    found = lookup(index, urls)
    assert found.count() == 52
    by_page = {}
    for r in found.collect():
        rec = read_record(read_range(spark, r["file"], r["offset"], r["length"]))
        by_page[rec["page_id"]] = rec["payload"]
    assert by_page[1] == b"short" and by_page[117] == b"page 17"
    bodies = read_captures(spark, archive, found, bodies=True)
    assert {r["page_id"]: bytes(r["payload"]) for r in bodies.collect()} == by_page


def test_records_are_whole_files(spark, archive):
    """The files are WARC records one after another, and nothing else."""
    seen = 0
    for f in spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(archive).collect():
        data, at = bytes(f["content"]), 0
        while at < len(data):
            assert data[at:].startswith(b"WARC/1.1\r\n")
            _, body, size = parse_record(data, at)
            assert data[body + size:body + size + 4] == b"\r\n\r\n"
            at = body + size + 4
            seen += 1
    assert seen == len(rows())


def test_damage_is_found(spark, archive):
    r = captures(spark, archive).filter("page_id = 3").first()
    raw = read_range(spark, r["file"], r["offset"], r["length"])
    read_record(raw)
    with pytest.raises(ValueError):
        read_record(raw.replace(b"long", b"lung"))


def test_url_keys():
    assert url_key("http://www.Example.com/a/B?c") == "com,example,www)/a/B?c"
    assert url_key("https://u:p@x.org:8080") == "org,x)/"
    assert url_key(None) == "-" and url_key("plain") == "plain"
    assert url_key("//h.x/p#frag") == "x,h)/p"


def test_a_url_met_often_asks_for_its_blocks_once(spark, tmp_path, monkeypatch):
    from cardspark.llm import warc
    monkeypatch.setattr(warc, "BLOCK_LINES", 30)
    n = 10_000
    pages = spark.range(n).selectExpr("id AS page_id", "IF(id % 10 = 0, NULL, 'https://hot.example/x') AS url",
                                      "concat('<p>', CAST(id % 7 AS STRING)) AS html")
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    index = warc.build_index(warc.captures(spark, path))
    asked = []
    real = warc.Directory.blocks
    monkeypatch.setattr(warc.Directory, "blocks", lambda self, key: asked.append(key) or real(self, key))
    found = warc.lookup(index, pages.select("url"))
    assert found.count() == n and found.select("file", "offset").distinct().count() == n
    directory = warc.Directory(index)
    requests = sum(len(real(directory, k)) for k in ("-", warc.url_key("https://hot.example/x")))
    assert requests <= index.count() + 1
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [key") > plan.index("find(")  # distinct keys feed the directory
