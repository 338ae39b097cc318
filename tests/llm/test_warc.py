import gzip
import hashlib
from pathlib import Path

import pytest

from listwise.llm import warc
from listwise.llm.common import own_dir

SCHEMA = "page_id long, url string, html string"


def test_keys():
    assert warc.surt("https://WWW.a.example.com:8080/p/q?x=1#top") == "com,example,a,www:8080)/p/q?x=1"
    assert warc.surt(None) == "" and warc.surt("not a url") == "not a url" and warc.surt("http://[bad") == "http://[bad"


def corpus():
    big, other = "é" * 60, "<p>" + "x" * 300_000
    rows = [(i, f"http://h{i % 7}.example.org/{i}", f"<html>{i}" * 30) for i in range(200)]
    rows += [(300 + i, "http://hot.example.org/", big) for i in range(80)]
    return rows + [(2000, None, None), (2001, None, ""), (2002, "http://e.org/\r\nX: y", "short"), (2003, "u", "short"), (2004, "http://z.org", other),
                   (2005, "http://z.org", other), (2006, "http://z.org", "🙂\r\n\r\n"), (250, "http://late.example.org", big)]


def want(rows):
    first = {}
    for k, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100:
            first[body] = min(first.get(body, k), k)
    out = {}
    for k, _, html in rows:
        body = (html or "").encode()
        again = first.get(body, k) != k
        out[str(k)] = (len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", str(first[body]) if again else None)
    return out


def test_round_trip_through_the_index(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 8)
    rows = corpus()
    pages = spark.createDataFrame([r + (1, "c") for r in rows], SCHEMA + ", start int, digest string").repartition(3)
    folder = own_dir(spark, "warc-test")
    captures = warc.write(pages, folder)
    shards = warc.index(captures, folder)
    assert sum(r.blocks for r in shards.collect()) > 20
    got = warc.read(warc.lookup(warc.surts(pages), shards, folder), folder).collect()
    assert len(got) == len(rows)
    assert {r.page: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got} == want(rows)
    texts = {str(k): (html or "").encode() for k, _, html in rows}
    assert all(r.payload == texts[r.page] for r in got if r.record_type == "response")
    asked = warc.surts(spark.createDataFrame([("http://hot.example.org/",), ("http://h3.example.org/10",), ("http://never.org/",), ("",)], "url string"))
    some = warc.read(warc.lookup(asked, shards, folder), folder).collect()
    assert sorted(int(r.page) for r in some) == [10] + list(range(300, 380)) + [2000, 2001]
    first = next(Path(folder.removeprefix("file://")).glob("archives/*"))
    assert gzip.open(first).read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_damage_is_found():
    data = warc.page_record("1", "http://a.org", b"payload", "0" * 64, None)
    with pytest.raises(ValueError):
        warc.parsed(data)
    with pytest.raises(Exception):
        warc.parsed(data[:-9])


def test_odd_rows(spark):
    folder = own_dir(spark, "warc-test")
    body = "y" * 200
    pages = spark.createDataFrame([(None, "http://a.org", body), (5, "http://a.org", body), (5, "http://a.org", body), (9, "http://b.org", body)], SCHEMA)
    shards = warc.index(warc.write(pages, folder), folder)
    got = sorted((r.page, r.record_type, r.refers_to or "") for r in warc.read(warc.lookup(warc.surts(pages), shards, folder), folder).collect())
    assert got == [("", "revisit", "5"), ("5", "response", ""), ("5", "response", ""), ("9", "revisit", "5")]
    none = warc.index(warc.write(pages.limit(0), folder), folder)
    assert none.count() == 0 and warc.lookup(warc.surts(pages), none, folder).count() == 0
