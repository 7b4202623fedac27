import gzip
import io
import json
import zipfile

from citespark.functions import html as H
from citespark.sources.wacz import decode, page_entries, read_capture, read_captures

PAGE = """<html lang="hu-HU"><head><title>T</title><script type="application/ld+json">{"@graph":[{"@type":"NewsArticle","headline":"Cím",
"datePublished":"2024-01-02","author":[{"name":"Kiss Anna"},"Lap"],"publisher":{"name":"Lap"},"keywords":"a, b,A"}]}</script></head><body>
<nav>menü</nav><article><h1>fent</h1><p>Első <b>bekezdés</b>.<p>Második <a href="https://www.lap.hu/x">itt</a> és <a href="https://m.hu/y">ott</a>.</p><h3>lent</h3>
<figure><img data-src="/k.jpg"><figcaption>Kép</figcaption></figure><blockquote><p>Idézett sor.</p><p>Vége.</p></blockquote>
<ul><li>alma</li><li>körte</li></ul><ul><li><a href="/a">címke</a></li><li><a href="/b">másik</a></li></ul><table><tr><td>1</td></tr></table></article><footer>f</footer></body></html>"""


def test_extract():
    x = H.extract(PAGE, "https://lap.hu/belfold/2024/cikk")
    assert (x["title"], x["authors"], x["tags"], x["language"], x["section"], x["published_at"]) == ("Cím", ["Kiss Anna"], ["a", "b"], "hu", "belfold", "2024-01-02")
    assert [(b["type"], b["text"]) for b in x["blocks"]] == [
        ("heading", "fent"), ("paragraph", "Első bekezdés."), ("paragraph", "Második itt és ott."), ("heading", "lent"), ("image", ""), ("quote", "Idézett sor. Vége."), ("list", "alma körte"),
    ]
    assert [b.get("level") for b in x["blocks"] if b["type"] == "heading"] == [2, 3]
    assert x["blocks"][1]["xpath"].endswith("/p[1]") and x["blocks"][3]["xpath"].endswith("/h3")
    assert [(link["url"], link["internal"]) for link in x["links"]] == [("https://www.lap.hu/x", True), ("https://m.hu/y", False)]
    assert x["images"] == [{"url": "https://lap.hu/k.jpg", "caption": "Kép"}] and x["quality"] == "partial_valid" and x["warnings"] == ["unsupported_table"]


def test_no_network_reference_survives():
    bad = '<p onclick="x()">a<img src="https://t/x.gif" srcset="//t/y 2x"><a href="javascript:1">b</a><iframe src="https://f"></iframe><link href="https://c"></p>'
    assert "https://" not in H.sanitise(H.parse(bad)) and "javascript" not in H.sanitise(H.parse(bad)) and "onclick" not in H.sanitise(H.parse(bad))
    out = H.neutralise(bad)
    assert ' src="' not in out and ' href="' not in out and "iframe" not in out and "no-referrer" in out


def _record(kind, uri, body, content="text/html", status=200, headers=()):
    if kind == "response":
        body = f"HTTP/1.1 {status} X\r\nContent-Type: {content}\r\n".encode() + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers) + b"\r\n" + body
    return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {uri}\r\nContent-Type: {content}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"


def _capture(*recs, pages='{"format":"x"}\n{"url":"http://h/a","ts":"2024","title":"x\u0085y"}\n'):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("pages/pages.jsonl", pages)
        z.writestr("archive/page.warc.gz", b"".join(gzip.compress(r) for r in recs))
    return raw.getvalue()


def test_captures(spark, tmp_path):
    moved = _capture(_record("response", "http://h/a", b"", status=301, headers=[("Location", "/b")]), _record("response", "http://h/b", "<p>ő".encode("iso8859-2"), "text/html; charset=iso-8859-2"), _record("resource", "urn:view:http://h/a", b"PNG", "image/png"), _record("response", "http://h/s.css", b"x", "text/css"))
    x = read_capture(moved)
    assert (x["html"], x["url"], x["captured_at"], x["screenshot"], x["error"]) == ("<p>ő", "http://h/a", "2024", b"PNG", None)
    loop = read_capture(_capture(_record("response", "http://h/a", b"", status=302, headers=[("Location", "/a")])))
    assert loop["error"] == "no_html_record"
    assert read_capture(b"not a zip")["error"].startswith("unreadable") and read_capture(moved[:200])["error"].startswith("unreadable")
    assert read_capture(_capture(_record("response", "http://h/a", b"<p>", status=404)))["error"] == "http_404"
    assert decode("é".encode(), "text/html; charset=nope") == "é" and len(page_entries('{"url":"a"}\nnot json\n{"x":1}')) == 1
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.wacz").write_bytes(moved)
    (tmp_path / "b.wacz").write_bytes(b"x")
    rows = {r.path.rsplit("/", 1)[1]: r for r in read_captures(spark, str(tmp_path)).collect()}
    assert rows["a.wacz"].http_status == 200 and rows["a.wacz"].has_screenshot and rows["b.wacz"].error
    assert json.dumps(sorted(rows)) == '["a.wacz", "b.wacz"]'


def test_deep_markup_and_wrong_charsets():
    deep = "<div>" * 3000 + "<p>Far below stands a line.</p>" + "</div>" * 3000
    x = H.extract(deep, "https://h.example/")
    assert [b["text"] for b in x["blocks"]] == ["Far below stands a line."]
    assert "Far below" in H.sanitise(H.parse(deep)) and "Far below" in H.neutralise(deep)
    many = "<div>" * 400 + "".join(f"<p>Line {i} of many in one place.</p>" for i in range(3000))
    assert len(H.extract(many, "")["blocks"]) == 3000
    assert decode("ő".encode(), "text/html; charset=us-ascii") == "ő" and decode("ő".encode("iso8859-2"), "text/html; charset=iso-8859-2") == "ő"


def test_quotes_inside_words(spark):
    """Needles of one word or more are found wherever the text holds them."""
    from citespark.operators.selectors import locate_quotes

    texts = ["xhello worldy and more", "hello", "say hello world twice: hello world", "one two three four", "é", ""]
    needles = ["hello world", "ello", "o", "two three", "one two three four", "ne two three f", "é", "zz", "", "hello"]
    blocks = spark.createDataFrame([(i, 1, t) for i, t in enumerate(texts)], "article_id long, block_index int, block_text string")
    wanted = sorted((i, k, t.index(n), t.index(n) + len(n)) for i, t in enumerate(texts) for k, n in enumerate(needles) if n and n in t)
    got = locate_quotes(blocks, spark.createDataFrame(list(enumerate(needles)), "item_id long, needle string")).collect()
    assert sorted((r.article_id, r.item_id, r.start, r.end) for r in got) == wanted


def test_derived_tables_follow_their_source(spark, tmp_path):
    from citespark.sources.tables import derived

    path, built = str(tmp_path / "t"), []

    def get():
        source = spark.read.parquet(path)
        return derived(spark, source, "test", lambda: built.append(1) or source.selectExpr("id + 1 as x"), lambda t, p: t.write.parquet(p)).count()

    spark.range(3).write.parquet(path)
    assert [get(), get(), len(built)] == [3, 3, 1]
    spark.range(5).write.mode("overwrite").parquet(path)
    assert [get(), len(built)] == [5, 2]
