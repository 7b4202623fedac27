import pytest
from pyspark.sql import functions as F

from citespark.functions import text as T
from citespark.functions import urls as U


def _one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>Rain <strong>fell</strong> over\n <em>hills</em>.</p>", "Rain fell over hills."),
        ("<p>egy <strong>Kiss Anna</strong>-kép</p>", "egy Kiss Anna-kép"), ("<p>left<br>right</p>", "left right"), ("<p>x<!-- unseen -->y</p>", "xy"),
        ("a\u00a0b", "a b"), ("a\u0085b", "a b"), ("a\u2003b", "a b"), ("a\ufeffb", "a b"), ("thin\u200bspace", "thin\u200bspace"), ("é e\u0301 ﬂ", "é e\u0301 ﬂ"), (None, ""), ("", ""),
    ],
)
def test_html_text(spark, html, text):
    from citespark.functions.html import parse, text_of

    assert _one(spark, T.html_text("h"), h=html) == text
    assert text_of(parse(html or "")) == text


def test_fold_is_one_way(spark):
    assert _one(spark, T.fold("x"), x="Zsófi Tűzön ß") == "zsofi tuzon ß"
    assert _one(spark, T.has_accent("x"), x="kép") and not _one(spark, T.has_accent("x"), x="KEP")


def test_compounds(spark):
    assert _one(spark, T.tokens("x"), x="Az észak-déli út 7") == ["az", "észak", "déli", "út", "7"]
    assert _one(spark, T.compounds("x"), x="észak-déli és észak–déli") == ["észak-déli"]


def test_boilerplate(spark):
    for line, want in (("Minden jog fenntartva.", True), ("SZTÁR", True), ("olvasson a haon.hu oldalon", True), ("A folyó megáradt.", False), ("", False)):
        assert _one(spark, T.is_boilerplate("x"), x=line) is want


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("https://h.hu/cikk/", "https://h.hu/cikk", True), ("https://h.hu/cikk#k", "https://h.hu/cikk", True), ("https://h.hu/c?utm_source=x&fbclid=y", "https://h.hu/c", True),
        ("HTTPS://H.hu:443/c?b=2&a=1", "https://h.hu/c?a=1&b=2", True), ("https://h.hu/c-2", "https://h.hu/c", False), ("https://h.hu/c/comments", "https://h.hu/c", False),
        ("https://h.hu/c?page=2&ref=x", "https://h.hu/c?page=2", True),
    ],
)
def test_identity(spark, a, b, same):
    assert (_one(spark, U.canonical_url(F.col("a")), a=a) == _one(spark, U.canonical_url(F.col("a")), a=b)) is same


def test_identity_by_the_standard_library(spark):
    """Against urllib: parameters decoded, sorted as pairs and encoded anew; the root keeps its slash."""
    from urllib.parse import parse_qsl, quote_plus, urlsplit

    def plain(u):
        x = urlsplit(u.strip())
        host = x.netloc.lower().removesuffix({"http": ":80", "https": ":443"}.get(x.scheme.lower(), "#"))
        pairs = sorted(p for p in parse_qsl(x.query, keep_blank_values=True) if p[0].lower() not in U.TRACKING)
        path = x.path or "/"
        query = "&".join(f"{quote_plus(k)}={quote_plus(v)}" for k, v in pairs)
        return f"{x.scheme.lower()}://{host}{path.rstrip('/') if len(path) > 1 else path}" + (f"?{query}" if query else "")

    urls = [
        "https://h.hu", "https://h.hu/", "http://H.hu:80/a//", "https://h.hu:443?b=1&B=0&a=2", "https://h.hu/x?UTM_Source=1&Ref=2&q=a%20b&q=a+a", "https://h.hu/x?b=10&b=9&a=%C3%A1&c", "https://h.hu/%41/?x=a~b*c-d_e.f#z",
        "https://h.hu/x?a=b=c&&d=%2F", "https://h.hu:8080/x?a;b=1",
    ]
    got = spark.createDataFrame([(u,) for u in urls], "a string").select("a", U.canonical_url(F.col("a")).alias("x")).collect()
    assert [(r.a, r.x) for r in got] == [(u, plain(u)) for u in urls]


def test_url_parts(spark):
    assert _one(spark, U.outlet_of(F.col("a")), a="https://www.news.co.uk/x") == "news.co.uk"
    assert _one(spark, U.outlet_of(F.col("a")), a="http://m.index.hu") == "index.hu"
    assert _one(spark, U.best_from_srcset(F.col("a")), a="a.jpg 100w, b.jpg 300w, c.jpg 300w") == "c.jpg"
    assert _one(spark, U.extension_for(F.lit("image/png; q=1"), F.col("a")), a="https://x/y") == ".png"
    for url, platform, video in (("https://www.youtube.com/watch?v=dQw4w9WgXcQ", "youtube", "dQw4w9WgXcQ"), ("https://player.vimeo.com/video/12345", "vimeo", "12345"), ("https://videa.hu/player?v=AbC1", "videa", "AbC1"), ("https://x.com/u/status/99", "twitter", "99"), ("https://example.org/x", None, "x")):
        assert _one(spark, U.platform_of(F.col("a")), a=url) == platform and _one(spark, U.video_id(F.col("a")), a=url) == video
