"""Article extraction from arbitrary markup, in plain Python for Arrow batches: body, blocks, media, links, metadata, safe copies."""

from __future__ import annotations

import html as entities
import json
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

# White space, furniture tags and the id/class fragments of furniture.
_SPACE = re.compile("[\u0009-\u000d\u001c- \u0085   -     　﻿]+")
FURNITURE_TAGS = ("nav", "header", "footer", "aside", "form", "script", "style", "noscript", "svg", "button")
FURNITURE_NAMES = (
    "cookie", "consent", "gdpr", "privacy-banner", "iab", "age-gate", "agegate", "adult", "korhatar", "newsletter", "hirlevel", "related",
    "kapcsolodo", "ajanlo", "ajanljuk", "footer", "labrc", "lablec", "header", "fejlec", "nav", "menu", "navbar", "share", "social", "megosztas",
    "kovetes", "sidebar", "widget", "comment", "hozzaszolas", "komment", "advert", "reklam", "hirdetes", "banner", "subscribe", "elofizet",
    "breadcrumb", "morzsa", "tag-list", "cimke", "regional", "portfolio", "regionalis",
)
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "ul", "ol", "figure", "div", "section", "article", "table", "pre", "dl"}
UNSUPPORTED = {"table", "pre", "dl"}
SAFE_TAGS = {"p", "h2", "h3", "h4", "h5", "h6", "blockquote", "ul", "ol", "li", "a", "em", "strong", "b", "i", "u", "s", "sub", "sup", "span", "br", "figure", "figcaption", "img", "article", "div", "code", "q", "cite", "time"}
SAFE_ATTRIBUTES = {"a": {"href"}, "img": {"src", "alt", "width", "height"}, "time": {"datetime"}}


@dataclass
class Node:
    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # nodes and strings

    def walk(self):
        todo = [self]
        while todo:
            n = todo.pop()
            yield n
            todo.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def find(self, *tags: str):
        return [n for n in self.walk() if n.tag in tags]


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("document")
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK or tag == "li":  # implied ends
            inner = "li" if tag == "li" else "p"
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag == inner:
                    del self.stack[i:]
                    break
                if self.stack[i].tag in BLOCK:
                    break
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.stack[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse(markup: str) -> Node:
    builder = _Builder()
    builder.feed(markup or "")
    builder.close()
    return builder.root


def raw_text(node: Node) -> str:
    """textContent with <br> as a newline; comments were never part of the tree."""
    out, todo = [], [node]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out.append(n)
        elif n.tag == "br":
            out.append("\n")
        elif n.tag not in ("script", "style"):
            todo.extend(reversed(n.children))
    return "".join(out)


def text_of(node: Node) -> str:
    return _SPACE.sub(" ", raw_text(node)).strip()


def _names(node: Node) -> str:
    return f"{node.attrs.get('id', '')} {node.attrs.get('class', '')}".lower()


def strip_furniture(node: Node, keep_tags: tuple[str, ...] = ()) -> Node:
    """A copy without furniture by tag or by name."""
    out = Node(node.tag, node.attrs, [])
    todo = [(node, out)]
    while todo:
        old, new = todo.pop()
        for c in old.children:
            if not isinstance(c, Node):
                new.children.append(c)
            elif not ((c.tag in FURNITURE_TAGS and c.tag not in keep_tags) or (c.tag not in ("html", "body", "article") and any(f in _names(c) for f in FURNITURE_NAMES))):
                copy = Node(c.tag, c.attrs, [])
                new.children.append(copy)
                todo.append((c, copy))
    return out


def main_body(root: Node) -> Node:
    """The article element of most text; else the container of most paragraph text weighted against links."""
    articles = root.find("article")
    if articles:
        return max(articles, key=lambda n: len(text_of(n)))

    # letters below each node, in all and in links: children come after their parents in `walk`
    order = list(root.walk())
    total, linked = {}, {}
    for n in reversed(order):
        size = sum(total[id(c)] if isinstance(c, Node) else len("".join(c.split())) for c in n.children)
        total[id(n)] = size = 0 if n.tag in ("script", "style") else size
        linked[id(n)] = size if n.tag == "a" else sum(linked[id(c)] for c in n.children if isinstance(c, Node))

    def density(n: Node) -> float:
        prose = sum(total[id(c)] for c in n.children if isinstance(c, Node) and c.tag in ("p", "blockquote", "ul", "ol"))
        return prose * (1 - linked[id(n)] / (total[id(n)] or 1))

    places = [n for n in order if n.tag in ("div", "section", "main", "body")]
    return max(places, key=density, default=root)


def is_link_strip(node: Node) -> bool:
    anchors, text = node.find("a"), text_of(node)
    return len(anchors) >= 2 and sum(len(text_of(a)) for a in anchors) >= 0.8 * len(text) and not re.search("[.!?…]", text)


def blocks_of(body: Node) -> tuple[list[dict], list[str]]:
    """Ordered blocks of the flattened body, and warnings (unsupported tags, once each)."""
    out: list[dict] = []
    warnings: list[str] = []

    def add(kind: str, node: Node, tag: str, **more):
        inner = [c for c in node.children if isinstance(c, Node) and (c.tag in BLOCK or c.tag == "li")] if kind in ("quote", "list") else []
        text = " ".join(t for t in map(text_of, inner) if t) if inner else text_of(node)
        if kind in ("image", "video") or text:
            out.append({"type": kind, "tag": tag, "text": "" if kind in ("image", "video") else text, **more})

    def visit(top: Node):
        todo = list(reversed(top.children))
        while todo:
            c = todo.pop()
            if isinstance(c, str):
                if c.strip():
                    out.append({"type": "paragraph", "tag": "p", "text": _SPACE.sub(" ", c).strip()})
                continue
            if re.fullmatch("h[1-6]", c.tag):
                level = max(2, int(c.tag[1]))
                add("heading", c, f"h{level}", level=level)
            elif c.tag == "blockquote":
                add("quote", c, "blockquote")
            elif c.tag in ("ul", "ol"):
                if not is_link_strip(c):
                    add("list", c, c.tag, items=[text_of(i) for i in c.children if isinstance(i, Node) and i.tag == "li" and text_of(i)])
            elif c.tag in ("figure", "img"):
                for img in c.find("img"):
                    if image_url(img):
                        out.append({"type": "image", "tag": "figure", "text": "", "src": image_url(img), "caption": " ".join(text_of(x) for x in c.find("figcaption"))})
            elif c.tag == "iframe":
                out.append({"type": "video", "tag": "figure", "text": "", "src": c.attrs.get("src", "")})
            elif c.tag in UNSUPPORTED:
                warning = f"unsupported_{c.tag}"
                if warning not in warnings:
                    warnings.append(warning)
            elif c.tag == "p" or not blocky[id(c)]:
                if not is_link_strip(c):
                    add("paragraph", c, "p")
                for img in c.find("img"):
                    if image_url(img):
                        out.append({"type": "image", "tag": "figure", "text": "", "src": image_url(img), "caption": ""})
            else:
                todo.extend(reversed(c.children))

    blocky = {}  # whether a node holds blocks, images or frames, bottom-up
    for n in reversed(list(body.walk())):
        blocky[id(n)] = any(isinstance(x, Node) and (x.tag in BLOCK or x.tag in ("img", "iframe") or blocky[id(x)]) for x in n.children)
    visit(body)
    total: dict[str, int] = {}
    for b in out:
        total[b["tag"]] = total.get(b["tag"], 0) + 1
    seen: dict[str, int] = {}
    for i, b in enumerate(out, 1):
        seen[b["tag"]] = seen.get(b["tag"], 0) + 1
        place = f"[{seen[b['tag']]}]" if total[b["tag"]] > 1 else ""
        b["index"] = i
        b["xpath"] = f"/html/body/article/div/{b['tag']}{place}" + ("/img" if b["type"] == "image" else "")
    return out, warnings


def image_url(img: Node) -> str:
    for name in ("data-src", "data-original", "data-lazy-src", "src"):
        url = img.attrs.get(name, "").strip()
        if url and not url.startswith("data:"):
            return url
    sets = [x.strip().split() for x in img.attrs.get("srcset", "").split(",") if x.strip()]
    size = lambda x: float(x[1][:-1]) if len(x) > 1 and re.fullmatch(r"[0-9.]+[wx]", x[1]) else 1.0
    return max(enumerate(sets), key=lambda p: (size(p[1]), p[0]))[1][0] if sets else ""


def links_of(blocks: list[tuple[dict, Node]] | None, body: Node, page_url: str) -> list[dict]:
    """http(s) links once per (target, text), whether internal (same host or a subdomain)."""
    out, seen = [], set()
    host = (urlsplit(page_url).hostname or "").removeprefix("www.")
    for a in body.find("a"):
        href, text = a.attrs.get("href", "").strip(), text_of(a)
        if not re.match("(?i)https?://", href) or (href, text) in seen:
            continue
        seen.add((href, text))
        own = (urlsplit(href).hostname or "").removeprefix("www.")
        out.append({"url": href, "text": text, "internal": bool(host) and (own == host or own.endswith("." + host))})
    return out


def _ld_items(x):
    if isinstance(x, list):
        for y in x:
            yield from _ld_items(y)
    elif isinstance(x, dict):
        yield x
        yield from _ld_items(x.get("@graph", []))


def _ld_authors(x) -> list[str]:
    if isinstance(x, str):
        return [x.strip()] if x.strip() else []
    if isinstance(x, dict):
        return _ld_authors(x.get("name", ""))
    return [n for y in x for n in _ld_authors(y)] if isinstance(x, list) else []


def metadata_of(root: Node, page_url: str) -> dict:
    """Title, description, dates, authors, publisher, tags, language, section: first non-empty of JSON-LD, OpenGraph, plain tags."""
    ld: dict = {}
    for s in root.find("script"):
        if s.attrs.get("type", "").lower() == "application/ld+json":
            try:
                found = [x for x in _ld_items(json.loads("".join(c for c in s.children if isinstance(c, str)))) if "Article" in str(x.get("@type", ""))]
            except ValueError:
                continue
            if found and not ld:
                ld = found[0]
    meta = {}
    for m in root.find("meta"):
        name = (m.attrs.get("property") or m.attrs.get("name") or "").lower()
        if name and m.attrs.get("content", "").strip():
            meta.setdefault(name, m.attrs["content"].strip())
    first = lambda *xs: next((str(x).strip() for x in xs if x and str(x).strip()), None)
    titles, heads = root.find("title"), root.find("h1")
    lang = next((n.attrs.get("lang") for n in root.find("html") if n.attrs.get("lang")), None)
    publisher = ld.get("publisher") or {}
    publisher = first(publisher.get("name") if isinstance(publisher, dict) else publisher, meta.get("og:site_name"))
    authors = [a for a in dict.fromkeys(_ld_authors(ld.get("author")) or _ld_authors(meta.get("author"))) if a != publisher]
    path = [p for p in urlsplit(page_url).path.split("/") if p and not p[0].isdigit()]
    keywords = ld.get("keywords") or meta.get("keywords") or ""
    keywords = keywords if isinstance(keywords, list) else re.split("[,;]", str(keywords))
    tags: dict[str, str] = {}
    for k in keywords:
        if str(k).strip():
            tags.setdefault(str(k).strip().casefold(), str(k).strip())
    return {
        "title": first(ld.get("headline"), meta.get("og:title"), text_of(heads[0]) if heads else None, text_of(titles[0]) if titles else None),
        "description": first(ld.get("description"), meta.get("og:description"), meta.get("description")),
        "published_at": first(ld.get("datePublished"), meta.get("article:published_time")), "updated_at": first(ld.get("dateModified"), meta.get("article:modified_time")),
        "authors": authors, "publisher": publisher, "tags": list(tags.values()), "language": (lang or "").replace("_", "-").split("-")[0].lower() or None,
        "section": first(ld.get("articleSection"), meta.get("article:section"), path[0] if path else None),
    }


def _attributes(pairs: dict[str, str]) -> str:
    return "".join(f' {k}="{entities.escape(v)}"' for k, v in pairs.items())


def _written(node: Node, opened) -> str:
    """Markup of what is inside a node; `opened` gives a child's opening tag, "" to write only what is inside, None to leave it out."""
    out: list[str] = []
    todo: list = list(reversed(node.children))
    while todo:
        c = todo.pop()
        if isinstance(c, tuple):
            out.append(c[0])
        elif isinstance(c, str):
            out.append(entities.escape(c, quote=False))
        elif (tag := opened(c)) is not None:
            out.append(tag)
            if tag and c.tag not in VOID:
                todo.append((f"</{c.tag}>",))
            if not tag or c.tag not in VOID:
                todo.extend(reversed(c.children))
    return "".join(out)


def sanitise(node: Node) -> str:
    """Markup of allowed tags and attributes only; links keep http, https and mailto, images only local sources."""
    def opened(c: Node) -> str | None:
        if c.tag not in SAFE_TAGS:
            return ""
        keep = {k: v for k, v in c.attrs.items() if k in SAFE_ATTRIBUTES.get(c.tag, ())}
        if "href" in keep and not re.match("(?i)(https?:|mailto:)", keep["href"].strip()):
            del keep["href"]
        if "src" in keep and re.match(r"(?i)([a-z][a-z0-9+.-]*:|//)", keep["src"].strip()):
            del keep["src"]
        return f"<{c.tag}{_attributes(keep)}>"

    return _written(node, lambda c: None if c.tag in ("script", "style", "iframe", "object", "noscript") else opened(c))


_NETWORK = {"src", "srcset", "href", "action", "formaction", "poster", "data", "background", "ping", "style", "cite", "longdesc", "manifest", "codebase"}


def neutralise(markup: str) -> str:
    """The page with nothing in it that loads: scripts, frames and link, base and meta refresh go, every network attribute is renamed."""

    def opened(c: Node) -> str | None:
        if c.tag in ("script", "noscript", "base", "link", "style", "iframe", "object", "embed", "meta"):
            return None
        attrs = {(f"data-original-{k}" if k in _NETWORK or ":" in k else k): v for k, v in c.attrs.items() if not k.startswith("on")}
        return f"<{c.tag}{_attributes(attrs)}>"

    return '<!DOCTYPE html><meta charset="utf-8"><meta name="referrer" content="no-referrer">' + _written(parse(markup), opened)


def embedded_text(markup: str) -> str:
    """The longest article-like text in embedded application state (JSON scripts)."""
    best = ""

    def look(x):
        nonlocal best
        if isinstance(x, str) and len(x) > len(best) and "<p" in x:
            best = x
        for y in x.values() if isinstance(x, dict) else x if isinstance(x, list) else ():
            look(y)

    for s in parse(markup).find("script"):
        if "json" in s.attrs.get("type", "") and "ld+json" not in s.attrs.get("type", ""):
            try:
                look(json.loads("".join(c for c in s.children if isinstance(c, str))))
            except ValueError:
                continue
    return best


def extract(markup: str, page_url: str) -> dict:
    """One capture as an article: metadata, blocks, images, videos, links, warnings, quality."""
    root = parse(markup)
    body = main_body(strip_furniture(root))
    state = embedded_text(markup)
    if state:  # application state wins only if clearly longer
        other = parse(state)
        a, b = len(text_of(body)), len(text_of(other))
        if b > 1.10 * a and b >= a + 100:
            body = other
    meta = metadata_of(root, page_url)
    blocks, warnings = blocks_of(body)
    prose = [b for b in blocks if b["type"] in ("paragraph", "quote", "list")]
    reasons = ["no_content_blocks"] if not prose else [r for r, on in (("no_title", not meta["title"]), ("no_published_at", not meta["published_at"]), ("extraction_warnings", bool(warnings))) if on]
    return {
        **meta, "blocks": blocks, "images": [{"url": urljoin(page_url, b["src"]), "caption": b["caption"]} for b in blocks if b["type"] == "image"],
        "videos": [urljoin(page_url, b["src"]) for b in blocks if b["type"] == "video"], "links": links_of(None, body, page_url),
        "quality": "invalid" if not prose else "partial_valid" if reasons else "success", "reasons": reasons, "warnings": warnings,
    }
