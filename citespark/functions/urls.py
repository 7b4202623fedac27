"""URL identity and match forms as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that never identify content, and public suffixes of two labels.
TRACKING = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "yclid", "mc_cid", "mc_eid", "igshid",
    "ref", "source", "_ga", "gclsrc", "dclid", "msclkid", "twclid",
)
MULTIPART_SUFFIXES = ("co.uk", "org.uk", "com.au", "co.jp", "com.br")


def _parts(url: Column) -> dict[str, Column]:
    u = F.trim(url)
    u = F.when(u.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), u).otherwise(F.concat(F.lit("https://"), F.regexp_replace(u, "^//", "")))
    get = lambda i: F.regexp_extract(u, r"^([^:/?#]+)://([^/?#]*)([^?#]*)(?:\?([^#]*))?", i)
    return {"scheme": F.lower(get(1)), "host": F.lower(get(2)), "path": get(3), "query": get(4)}


def _decoded(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), F.replace(x, F.lit("+"), F.lit(" ")))


def _encoded(x: Column) -> Column:
    return F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """The identity form: scheme and host in lower case, default ports and tracking parameters (in any case) dropped, the other
    parameters decoded, sorted by name and value and encoded anew, no fragment, no closing slash but that of the root.
    `ref` and `source` are tracking parameters. An empty URL stays empty; one without a scheme is taken as https."""
    get = lambda i: F.regexp_extract(F.trim(url), r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?", i)
    scheme = F.when(get(1) == "", "https").otherwise(F.lower(get(1)))
    host = F.lower(get(2))
    host = F.when(scheme == "http", F.regexp_replace(host, ":80$", "")).when(scheme == "https", F.regexp_replace(host, ":443$", "")).otherwise(host)
    pairs = F.transform(
        F.filter(F.split(get(4), "&"), lambda x: x != ""),
        lambda x: F.struct(_decoded(F.substring_index(x, "=", 1)).alias("k"), _decoded(F.when(F.instr(x, "=") > 0, F.regexp_replace(x, "^[^=]*=", "")).otherwise("")).alias("v")),
    )
    kept = F.array_sort(F.filter(pairs, lambda x: ~F.lower(x["k"]).isin(*TRACKING)))
    query = F.array_join(F.transform(kept, lambda x: F.concat(_encoded(x["k"]), F.lit("="), _encoded(x["v"]))), "&")
    path = F.when(F.length(get(3)) > 1, F.regexp_replace(get(3), "/+$", "")).when(get(3) == "", "/").otherwise(get(3))
    path = F.when((path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    return F.when(url == "", url).otherwise(F.concat(scheme, F.lit("://"), host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def archive_id(url: Column) -> Column:
    return F.sha2(canonical_url(url), 256)


def host_of(url: Column) -> Column:
    return F.regexp_replace(_parts(url)["host"], ":[0-9]+$", "")


def is_http(url: Column) -> Column:
    return F.coalesce(url.rlike("(?i)^https?://[^/?#]+"), F.lit(False))


def outlet_of(url: Column) -> Column:
    """The last two labels of the host, three under a two-label suffix."""
    labels = F.split(host_of(url), "\\.")
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), F.lit(k)), ".")
    return F.when(last(2).isin(*MULTIPART_SUFFIXES), last(3)).otherwise(last(2))


def match_url(url: Column) -> Column:
    """The form for matching captured resources: the query stays, fragment and closing slash go."""
    return F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "/+$", "")


def slugify(x: Column) -> Column:
    from citespark.functions.text import fold

    return F.substring(F.regexp_replace(F.regexp_replace(fold(x), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, 80)


def storage_path(url: Column) -> Column:
    h = archive_id(url)
    return F.concat_ws("/", outlet_of(url), F.substring(h, 1, 2), h)


def same_page_forms(url: Column) -> Column:
    """Identity forms of the page under https and http, without and with www, in order of preference."""
    bare = F.regexp_replace(F.regexp_replace(canonical_url(url), "^[a-z]+://", ""), "^www\\.", "")
    return F.array(*[F.concat(F.lit(s), bare) for s in ("https://", "https://www.", "http://", "http://www.")])


def best_from_srcset(srcset: Column) -> Column:
    """URL of the largest descriptor; of equals the last."""
    parts = F.filter(F.transform(F.split(srcset, ","), lambda x: F.trim(x)), lambda x: x != "")
    ranked = F.transform(parts, lambda x, i: F.struct(F.coalesce(F.regexp_extract(x, r"\s([0-9.]+)[wx]$", 1).try_cast("double"), F.lit(1.0)).alias("w"), i.alias("i"), F.split(x, r"\s+")[0].alias("url")))
    return F.array_max(ranked)["url"]


# File extensions by content type.
EXTENSIONS = (
    ("image/jpeg", ".jpg"), ("image/jpg", ".jpg"), ("image/png", ".png"), ("image/webp", ".webp"), ("image/gif", ".gif"), ("image/avif", ".avif"),
    ("image/svg+xml", ".svg"), ("video/mp4", ".mp4"), ("video/webm", ".webm"), ("video/ogg", ".ogv"), ("video/quicktime", ".mov"),
    ("application/vnd.apple.mpegurl", ".m3u8"), ("application/x-mpegurl", ".m3u8"),
)


def extension_for(content_type: Column, url: Column, default: str = ".bin") -> Column:
    kind = F.lower(F.trim(F.split(F.coalesce(content_type, F.lit("")), ";")[0]))
    table = F.create_map(*[F.lit(x) for pair in EXTENSIONS for x in pair])
    from_path = F.regexp_extract(_parts(url)["path"], r"(\.[A-Za-z0-9]{2,5})$", 1)
    return F.coalesce(F.try_element_at(table, kind), F.when(from_path != "", F.lower(from_path)), F.lit(default))


# Host endings of video platforms, first match wins.
PLATFORMS = (
    (r"(^|\.)youtube(-nocookie)?\.com$", "youtube"), (r"(^|\.)youtu\.be$", "youtube"), (r"(^|\.)vimeo\.com$", "vimeo"),
    (r"(^|\.)dailymotion\.com$", "dailymotion"), (r"(^|\.)facebook\.com$", "facebook"), (r"(^|\.)instagram\.com$", "instagram"),
    (r"(^|\.)tiktok\.com$", "tiktok"), (r"(^|\.)(twitter|x)\.com$", "twitter"), (r"(^|\.)indavideo\.hu$", "indavideo"),
    (r"(^|\.)t\.me$", "telegram"), (r"(^|\.)telegram\.org$", "telegram"), (r"(^|\.)videakid\.hu$", "videakid"), (r"(^|\.)videa\.hu$", "videa"),
)


def platform_of(url: Column) -> Column:
    host = host_of(url)
    out = F.lit(None).cast("string")
    for pattern, name in reversed(PLATFORMS):
        out = F.when(host.rlike(pattern), name).otherwise(out)
    return out


def video_id(url: Column) -> Column:
    """The platform's id of an embedded video, where its URL shows one."""
    p, path, query = platform_of(url), _parts(url)["path"], _parts(url)["query"]
    pick = lambda x, r: F.nullif(F.regexp_extract(x, r, 1), F.lit(""))
    return (
        F.when(p == "youtube", F.coalesce(pick(query, r"(?:^|&)v=([\w-]{6,})"), pick(path, r"^/(?:embed/|shorts/|v/)?([\w-]{6,})")))
        .when(p == "vimeo", pick(path, r"/(\d+)"))
        .when(p == "dailymotion", pick(path, r"/video/(\w+)"))
        .when(p == "tiktok", pick(path, r"/(?:video|embed(?:/v2)?)/(\d+)"))
        .when(p == "twitter", pick(path, r"/status/(\d+)"))
        .when(p == "instagram", pick(path, r"/(?:p|reel|tv)/([\w-]+)"))
        .when(p.isin("videa", "videakid"), F.coalesce(pick(query, r"(?:^|&)v=(\w+)"), pick(path, r"-(\w+)$")))
        .otherwise(pick(path, r"/([^/]+)/?$"))
    )
