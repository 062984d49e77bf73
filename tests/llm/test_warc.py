import gzip
import re

from pyspark.sql import Row

from tapewright.llm.warc import Page, derivatives, derive_records, digest, parse, plain_text, read_warc, responses, split_response, write_records

PAGE = "<html lang='de'><head><title>A &amp; B</title><style>p{}</style><script>var t='</p>'</script></head><body><!-- x --><p>One <b>two</b></p><p>3 &lt; 4<a href='/x'>link</a></body></html>"


def test_text_and_response():
    assert plain_text(PAGE) == "A & B\nOne two\n3 < 4link"
    status, fields, payload = split_response("HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-A: b: c\r\n\r\n" + PAGE)
    assert (status, fields, payload) == ("200", [("Content-Type", "text/html"), ("X-A", "b: c")], PAGE)


def test_records_link_to_their_response_and_hold_true_digests(spark, tmp_path):
    bodies = [PAGE, "HTTP/1.1 404 Not Found\r\nServer: s\r\n\r\n<p>gone", None, "", "x" * 300000]
    pages = spark.createDataFrame([Row(page_id=i, url=f"http://e.com/{i}", html=b, block="clash") for i, b in enumerate(bodies)] + [Row(page_id=None, url=None, html="<p>a", block=None)], "page_id long, url string, html string, block string")
    rows = derive_records(pages).collect()
    assert len(rows) == 12
    for r in rows:
        assert r["block_digest"] == digest(r["block"].encode()) and r["content_length"] == len(r["block"].encode())
        other = [x for x in rows if x["record_id"] == r["concurrent_to"]]
        assert len(other) == 1 and other[0]["refers_to"] == r["refers_to"] and other[0]["warc_type"] != r["warc_type"]
    meta = next(r for r in rows if r["page_id"] == "1" and r["warc_type"] == "metadata")
    assert "http-status: 404\r\n" in meta["block"] and "http-header-server: s\r\n" in meta["block"]
    assert f"payload-digest: {digest(b'<p>gone')}" in meta["block"] and meta["source_digest"] == digest(b"<p>gone")
    assert derive_records(pages.limit(0)).count() == 0
    write_records(derive_records(pages), str(tmp_path / "w"))
    data = b"".join(gzip.open(p).read() for p in (tmp_path / "w").glob("*.gz"))
    at = count = 0
    while at < len(data):
        head = data.index(b"\r\n\r\n", at) + 4
        size = int(re.search(rb"Content-Length: (\d+)", data[at:head])[1])
        assert data[at:].startswith(b"WARC/1.1\r\n") and data[head + size : head + size + 4] == b"\r\n\r\n"
        at, count = head + size + 4, count + 1
    assert count == 12


def test_files_keep_ids_dates_headers_and_digests(spark, tmp_path):
    """Files as crawlers write them: a member per record, foreign digests, folded fields, other record types, odd bytes."""
    latin = "<html><meta charset=iso-8859-1><title>Caf\u00e9</title><p>\u00fcber".encode("latin-1")
    http = b"HTTP/1.1 200 OK\r\nServer: s\r\nContent-Type: text/html; charset=ISO-8859-1\r\n\r\n" + latin
    page = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n<p>a\r\n\r\nb \xff\x00 c</p>"

    def record(kind, name, block, more=b"", version=b"WARC/1.0"):
        head = b"%s\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:uuid:%s>\r\nWARC-Date: 2024-05-0%sT00:00:00Z\r\n" % (version, kind, name, name)
        head += b"WARC-Target-URI: http://e.com/%s\r\n%sContent-Length: %d\r\n\r\n" % (name, more, len(block))
        return head + block + b"\r\n\r\n"

    records = [
        record(b"warcinfo", b"1", b"software: x\r\n"),
        record(b"request", b"2", b"GET / HTTP/1.1\r\nHost: e.com\r\n\r\n"),
        record(b"response", b"3", http, b"WARC-Payload-Digest: " + digest(latin).encode() + b"\r\n"),
        record(b"response", b"4", page, b"WARC-Payload-Digest: sha1:WRONG\r\nX-Long: one\r\n two\r\n", b"WARC/1.1"),
        record(b"response", b"5", b""),
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "in" / "b.warc").write_bytes(b"".join(records))
    read = read_warc(spark, str(tmp_path / "in"))
    found = read.collect()
    assert len(found) == 10 and all(r["whole"] for r in found)
    by_id = {r["record_id"]: r for r in found}
    assert bytes(by_id["<urn:uuid:3>"]["block"]) == http and bytes(by_id["<urn:uuid:4>"]["block"]) == page
    assert by_id["<urn:uuid:4>"]["fields"]["x-long"] == "one two"
    rows = [r for r in derivatives(read).collect()]
    assert len(rows) == 12 and {r["refers_to"] for r in rows} == {f"<urn:uuid:{k}>" for k in (3, 4, 5)}
    text = {r["refers_to"][10]: r for r in rows if r["warc_type"] == "conversion"}
    meta = {r["refers_to"][10]: r for r in rows if r["warc_type"] == "metadata"}
    assert text["3"]["block"] == "Caf\u00e9\n\u00fcber" and text["3"]["date"] == "2024-05-03T00:00:00Z" and text["3"]["digest_ok"]
    assert text["4"]["source_digest"] == "sha1:WRONG" and not text["4"]["digest_ok"] and text["4"]["target_uri"] == "http://e.com/4"
    assert "http-header-server: s\r\n" in meta["3"]["block"] and "title: Caf\u00e9\r\n" in meta["3"]["block"]
    write_records(derivatives(read), str(tmp_path / "out"), "none")
    again = {(r["record_id"], r["date"], bytes(r["block"]).decode()) for r in read_warc(spark, str(tmp_path / "out")).collect()}
    assert again == {(r["record_id"], r["date"], r["block"]) for r in rows}


def test_pages_survive_the_files(spark, tmp_path):
    bodies = [PAGE, "HTTP/1.1 404 Not Found\r\nServer: s\r\n\r\n<p>gone", None, "", "a\r\n\r\nb\n\nc \u4e2d" * 5]
    pages = spark.createDataFrame([(i, f"http://e.com/{i}", b) for i, b in enumerate(bodies)] + [(None, None, "x")], "page_id long, url string, html string")
    made = responses(pages)
    write_records(made, str(tmp_path / "w"))
    rows = {tuple(r) for r in derivatives(read_warc(spark, str(tmp_path / "w"))).drop("page_id").collect()}
    assert rows == {tuple(r) for r in derivatives(made).drop("page_id").collect()} and len(rows) == 12


def test_open_tags_take_linear_time():
    import time

    for unit in ("<a ", "<title>", "<script>", "<!--", "<", "</", "<p", "<a href=", "<style ", "&lt", "<title", "<html lang "):
        began = time.process_time()
        Page(unit * 200_000)
        assert time.process_time() - began < 5, unit
    assert Page("a < b <c").text == "a < b <c" and Page("<TITLE>x</TITLE><A HREF='/u'>v</a>").links == ["/u"]
    assert parse(b"nothing") is None and parse(b"WARC/1.0\r\n\r\n") is None


def _forging(k: int) -> str:
    mark = "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:forged>\r\nContent-Length: 9\r\n\r\n<p>after the mark</p>"
    return ("<p>before</p>" + mark + " " * k, "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:forged>\r\nContent-Length: 3\r\n\r\nxyz" + mark, mark * 3 + "\r\n\r\n")[k % 3]


def test_pages_cannot_make_records(spark, tmp_path):
    pages = spark.createDataFrame([(k, f"http://e.com/{k}", _forging(k) if k % 2 else f"<p>page {k}" + "x" * (k % 50)) for k in range(40)], "page_id long, url string, html string").coalesce(2)
    made = responses(pages)
    want = {(r["record_id"], bytes(r["block"])) for r in made.collect()}
    write_records(made, str(tmp_path / "gz"))
    write_records(made, str(tmp_path / "plain"), "none")
    for split in ("128m", "97", "333", "1000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            for name in ("gz", "plain"):
                read = read_warc(spark, str(tmp_path / name))
                rows = read.collect()
                assert {(r["record_id"], bytes(r["block"])) for r in rows} == want and len(rows) == 40 and all(r["whole"] for r in rows), (name, split)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {tuple(r) for r in derivatives(read_warc(spark, str(tmp_path / "gz"))).collect()} == {tuple(r) for r in derivatives(made).collect()}


def test_damaged_records_have_no_derivatives(spark, tmp_path):
    def record(name, block, length):
        return f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{name}>\r\n{length}\r\n\r\n{block}\r\n\r\n".encode()

    data = record("a", "<p>a", "Content-Length: 4") + record("short", "<p>abcd", "Content-Length: 4") + record("none", "<p>b", "X: y") + record("long", "<p>c", "Content-Length: 6")
    data += record("d", "<p>d", "Content-Length: 4") + record("cut", "<p>e", "Content-Length: 400") + record("inside", "<p>f", "Content-Length: 4")
    for name, raw in (("a.warc", data), ("b.warc.gz", gzip.compress(data))):
        (tmp_path / name).mkdir()
        (tmp_path / name / name).write_bytes(raw)
        read = read_warc(spark, str(tmp_path / name))
        assert [(r["record_id"][10:-1], r["whole"]) for r in read.collect()] == [("a", True), ("short", False), ("none", False), ("long", False), ("d", True), ("cut", False)]
        assert {r["refers_to"] for r in derivatives(read).collect()} == {"<urn:uuid:a>", "<urn:uuid:d>"}


def test_long_blocks_are_bounded(spark, monkeypatch):
    from tapewright.llm import warc as W

    monkeypatch.setattr(W, "MOST", 100)
    framer = W.Framer()
    block = b"x" * 60 + W._MARK + b"y" * 60 + W._MARK + b"z" * 60
    head = b"1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(block)
    found = [r for piece in (head + block).split(W._MARK) for r in framer.add(piece)]
    assert len(found) == 1 and not found[0][-2] and len(found[0][-1]) <= 100
    assert not framer.pieces and not list(framer.end())
