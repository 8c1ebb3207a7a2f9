from __future__ import annotations

import base64
import hashlib
import random

import oracle

from tessera.llm import warc


def test_loser_tree():
    r = random.Random(1)
    for sizes in ((), (0,), (1,), (5, 0, 3), (30, 1, 17, 17, 2), (3,) * 40):
        runs = [sorted((r.randrange(20), k) for k in range(n)) for n in sizes]
        assert list(warc.LoserTree(iter(x) for x in runs)) == sorted(x for run in runs for x in run)


def want(rows):
    best = {}
    for p, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if p is None else p)
    for p, _, h in rows:
        h, own = h or "", -1 if p is None else p
        yield own, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "response" if best[h] == own else "revisit", None if best[h] == own else best[h]


def test_round_trip(spark, tmp_path):
    r = random.Random(2)
    rows = [(k, f"http://www.Site{k % 3}.org/p?q={k}", r.choice([None, "", "<p>é</p>", "dup\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n", f"only {k}"])) for k in range(300)]
    rows += [(300 + k, "http://a.b/x", "many") for k in range(200)] + [(None, None, "nul"), (None, None, "many"), (999, "u\nv", "same"), (999, "u", "same")]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5).write.parquet(f"{tmp_path}/pages.parquet")
    got = warc.op5_warc(spark, str(tmp_path)).collect()
    shape = sorted(((-1 if x.page_id is None else x.page_id, x.payload_bytes, x.payload_digest, x.record_type, x.refers_to) for x in got), key=str)
    assert shape == sorted(want(rows), key=str)
    assert all(x.intact for x in got)
    history = sorted((x for x in got if x.url_key == "b,a)/x"), key=lambda x: x.capture_no)
    assert [x.capture_no for x in history] == list(range(1, 201)) and [x.page_id for x in history] == list(range(300, 500))


def test_least_bytes(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "long text"), (4, "u", "long text")], "page_id long, url string, html string")
    rows = {x.page_id: x.record_type for x in warc.read_archives(spark, warc.write_archives(pages, least_bytes=5)).collect()}
    assert rows == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_order_of_ranges(spark):
    pages = spark.createDataFrame([(k, f"http://h{k * 7 % 50}.org/", f"x{k}") for k in range(400)], "page_id long, url string, html string")
    index = warc.merge_index(warc.read_archives(spark, warc.write_archives(pages))).collect()
    keys = [(x.range, x.url_key, x.captured, x.page_id) for x in index]
    assert [k[1:] for k in sorted(keys)] == sorted(k[1:] for k in keys) and len(keys) == 400


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(spark, warc.write_archives(pages)).count() == 0


def test_any_page_id(spark):
    ids = [-(1 << 63), -1, 0, 10**13, 1 << 62, (1 << 63) - 1, None]
    pages = spark.createDataFrame([(p, "http://a.b/" + "x" * 5000, f"h{p}", 1) for p in ids], "page_id long, url string, html string, place int")
    records = warc.read_archives(spark, warc.write_archives(pages))
    assert sorted(records.collect(), key=str) and {r.page_id for r in records.collect()} == set(ids) and all(r.intact and len(r.captured) == 20 for r in records.collect())
    history = sorted(warc.capture_histories(records).collect(), key=lambda r: r.capture_no)
    assert [r.capture_no for r in history] == list(range(1, 8)) and {r.page_id for r in history} == set(ids)
    assert history == sorted(history, key=lambda r: (r.captured, r.page_id is not None, r.page_id or 0))


def test_lines_seek(spark):
    """An index line's offset and length are the record's bytes in its file."""
    pages = spark.createDataFrame([(k, f"http://h{k % 3}.org/\u00e9\r\nx", "\u00e9\r\n\r\n" * k) for k in range(60)], "page_id long, url string, html string")
    path = warc.write_archives(pages)
    seen = 0
    for r in warc.capture_histories(warc.read_archives(spark, path)).collect():
        with open(f"{path.removeprefix('file:')}/{r.file}", "rb") as f:
            f.seek(r.offset)
            (_, _, headers, payload), = warc.records_of(f.read(r.length))
        seen += headers["warc-record-id"] == f"<urn:page:{r.page_id}>" and (headers["warc-type"] == "revisit" or payload == ("\u00e9\r\n\r\n" * r.page_id).encode())
    assert seen == 60


def test_size_classes_gzip_and_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(warc, "CLASSES", ((10, 7), (100, 3), (None, 1)))
    monkeypatch.setattr(warc, "RANGE_ROWS", 9)
    rows = [(k, "http://hot.org/" if k % 3 else f"http://h{k}.org/", "y" * (k * 37 % 300) + str(k)) for k in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    records = warc.read_archives(spark, warc.write_archives(pages, compression="gzip"))
    assert sorted((r.page_id, r.payload_bytes) for r in records.collect()) == [(k, len(h)) for k, _, h in rows]
    assert records.groupBy("file").count().join(records.where("payload_bytes > 100").select("file").distinct(), "file").agg({"count": "max"}).head()[0] == 1
    hot = sorted((r.capture_no, r.page_id) for r in warc.capture_histories(records).collect() if r.url_key == "org,hot)/")
    assert hot == list(enumerate((k for k, u, _ in rows if "hot" in u), 1))


def test_sql(spark, sf_dir):
    assert oracle.differences(warc.op5_warc(spark, sf_dir), oracle.connect(sf_dir), warc.SQL["op5_warc"]) == []
