import hashlib

from supplylake.llm import warc
from supplylake.llm.warc import lookup, read_warc, url_key, write_warc

from .cases import prose


def pages(spark):
    same = prose(1, 40)
    rows = [(9, "http://b.example.com/x?q=1#f", same), (3, "http://a.example.com/x", same), (4, None, same),
            (5, "http://a.example.com/x", "short"), (6, "http://a.example.com/x", "short"), (7, "", None), (8, "://", ""),
            (10, "http://Ü.com/é\r\nx: y", "é" * 60), (11, "http://c.com", "x" * 3_000_000), (11, "http://c.com", "x" * 3_000_000),
            (None, "http://n.com/", same), (None, "http://n.com/", prose(2, 50)), (2, "http://a.example.com/x", prose(3, 80))]
    rows += [(100 + i, f"http://h{i % 7}.example.org/p{i % 50}", prose(i % 60, 30)) for i in range(300)]
    return spark.createDataFrame([(i, u, h, "clash", 1) for i, u, h in rows],
                                 "page_id long, url string, html string, digest string, bytes int").repartition(4)


def brute(rows):
    first = {}
    for r in rows:
        body = (r.html or "").encode()
        if len(body) >= 100 and r.page_id is not None:
            first[body] = min(first.get(body, r.page_id), r.page_id)
    out = []
    for r in rows:
        body = (r.html or "").encode()
        refers = first.get(body)
        refers = None if refers == r.page_id else refers
        out.append((r.page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 16)
    table = pages(spark)
    folder, index = write_warc(table, f"file://{tmp_path}/w")
    got = read_warc(folder, index).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == brute(table.collect())
    html = {r.page_id: r.html for r in table.collect()}
    assert all(r.html == (html[r.page_id] or "") for r in got if r.record_type == "response" and r.page_id is not None)
    assert all(r.html is None for r in got if r.record_type == "revisit")


def test_records_found_by_binary_search(spark, tmp_path, monkeypatch):
    """Keys spread over blocks and files, a hot key in several of them, absent keys."""
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    hot = [(1000 + i, "http://hot.example.com/", prose(i, 8)) for i in range(60)]
    table = pages(spark).unionByName(spark.createDataFrame([(*r, "clash", 1) for r in hot], pages(spark).schema)).repartition(5)
    folder, index = write_warc(table, f"file://{tmp_path}/w")
    assert index.count() > 1
    every = sorted([tuple(r)[:5] for r in read_warc(folder, index).collect()], key=str)
    assert sorted([tuple(r)[:5] for r in read_warc(folder, index, table.select("url")).collect()], key=str) == every
    some = ["http://hot.example.com/", "http://h3.example.org/p10", "http://none.org/", None, "zzz", "http://a.example.com/x#frag"]
    keys = {url_key(u) for u in some}
    got = read_warc(folder, index, spark.createDataFrame([(u,) for u in some * 2], "url string")).collect()
    want = [r.page_id for r in table.collect() if url_key(r.url) in keys]
    assert sorted((r.page_id for r in got), key=str) == sorted(want, key=str)
    assert read_warc(folder, index, table.select("url").limit(0)).count() == 0


def test_lookup_by_url(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    table = pages(spark)
    folder, index = write_warc(table, f"{tmp_path}/w")
    want = {}
    for r in table.collect():
        want.setdefault(url_key(r.url), []).append(str(r.page_id))
    urls = ["http://a.example.com/x", "https://a.example.com/x#frag", "http://h3.example.org/p10", "http://none.org/", "http://c.com/", "zzz"]
    urls += [f"http://h{i % 7}.example.org/p{i}" for i in range(50) if i != 10]
    got = {}
    for r in lookup(folder, index, urls).collect():
        got.setdefault(r.asked, []).append(str(r.page_id))
    for u in urls:
        assert sorted(got.get(u, [])) == sorted(want.get(url_key(u), [])), u


def test_empty_table_and_keys(spark):
    folder, index = write_warc(pages(spark).limit(0))
    assert read_warc(folder, index).count() == 0
    assert read_warc(folder, index, pages(spark).select("url")).count() == 0
    assert url_key("http://www.Example.com:80/A?b#c") == "com:80,example,www)/A?b" and url_key(None) == ")/"
