"""Image references of HTML pages: img elements, links to images and CSS urls, with captions."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame

from vitrine.functions.url import IMAGE_EXTENSIONS, resolve
from vitrine.sources.webarchive import LOT_BYTES, LOT_ROWS, arrow_batch, arrow_schema

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MOST_IMAGES, MOST_CHARS, HALF = 10_000, 10_000, 125
CSS_URL = re.compile(r"url\(['\"]*(.*?)['\"]*\)", re.S)
SCHEMA = "page_url string, page_title string, images_in_page int, img_url string, img_title string, img_alt string, img_caption string, tag string, is_inline boolean, inline_data string"


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "_text")

    def __init__(self, tag: str, attrs=(), parent: Node | None = None):
        self.tag, self.attrs, self.parent, self.children, self._text = tag, dict(attrs), parent, [], None

    def elements(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(reversed(node.elements()))

    def text(self) -> str:
        """Text with white space normalised, computed once; without scripts and styles."""
        if self._text is None:
            if self.tag in ("script", "style"):
                self._text = ""
            else:
                self._text = " ".join(" ".join(c if isinstance(c, str) else " " + c.text() + " " for c in self.children).split())
        return self._text


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")

    def handle_starttag(self, tag, attrs):
        if tag in ("p", "li") and self.at.tag == tag:
            self.at = self.at.parent
        node = Node(tag, [(k, v or "") for k, v in attrs], self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse_html(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def _caption_text(node: Node) -> str:
    return "" if node.tag in ("html", "#root") else node.text()


def _from_siblings(node: Node) -> str:
    around = node.parent.elements() if node.parent else [node]
    at = next(i for i, x in enumerate(around) if x is node)
    before = next((t for x in reversed(around[:at]) if (t := _caption_text(x))), "")
    after = next((t for x in around[at + 1 :] if (t := _caption_text(x))), "")
    return (before + "\n" + after).strip()


def shorten(caption: str) -> str:
    if len(caption) <= 2 * HALF:
        return caption
    cut = caption[:HALF].rfind(" ")
    tail = len(caption) - HALF + caption[-HALF:].find(" ")
    return (caption[: cut if cut >= 0 else HALF].strip() + "\n" + caption[tail:].strip()).strip()


def caption_of(image: Node) -> str:
    """Text of the nearest ancestor that has any; of the siblings instead, where the climb passed the widest ancestor."""
    widest = steps = most = 0
    node = image
    while node is not None:
        if len(node.children) >= most:
            most, widest = len(node.children), steps
        node, steps = node.parent, steps + 1
    text, last, node, steps = "", image, image, 0
    while node is not None and not (text := _caption_text(node)):
        last, node, steps = node, node.parent, steps + 1
    return shorten(_from_siblings(last) if steps >= widest else text)


def links_to_image(url: str) -> bool:
    try:
        path = urlsplit(url).path
    except ValueError:
        return False
    return "." in path and path.rsplit(".", 1)[1].lower() in IMAGE_EXTENSIONS


def _sources(img: Node, base: str) -> list[str]:
    out = {v.strip() for k, v in img.attrs.items() if k in ("src", "lowsrc") and v.strip()}
    return sorted(out | {v for v in img.attrs.values() if v.startswith("data:image") or links_to_image(resolve(base, v))} - {""}, key=lambda v: v.encode())


def page_references(html: str, page_url: str) -> list[tuple]:
    """Rows of SCHEMA. A page that names too long or no URL loses that reference only."""
    raw_url = page_url
    page_url = page_url if page_url.startswith("http") else "http://" + page_url
    if len(page_url) > MOST_CHARS:
        return []
    root = parse_html(html)
    nodes = list(root.walk())
    images = [n for n in nodes if n.tag == "img"]
    title = next((n.text() for n in nodes if n.tag == "title"), "")
    base = next((n.attrs["href"] for n in nodes if n.tag == "base" and n.attrs.get("href")), raw_url)
    rows, seen = [], set()

    def add(url: str, title_: str, alt: str, caption: str, tag: str, data: str | None = None) -> None:
        if url and len(url) <= MOST_CHARS:
            rows.append((page_url, title, len(images), url, title_, alt, caption, tag, data is not None, data))

    for img in images[:MOST_IMAGES]:
        cut = lambda name, img=img: img.attrs.get(name, "")[:MOST_CHARS]
        caption = caption_of(img)
        for source in _sources(img, page_url):
            seen.add(source)
            if source.startswith("data:image"):
                add("hash:" + hashlib.md5(source.encode()).hexdigest(), cut("title"), cut("alt"), caption, "img", source)
            else:
                add(resolve(page_url, source), cut("title"), cut("alt"), caption, "img")
    for a in (n for n in nodes if n.tag == "a" and n.attrs.get("href")):
        target = resolve(base, a.attrs["href"])
        if links_to_image(target):
            seen.add(a.attrs["href"])
            add(target, "", "", a.text()[:MOST_CHARS], "a")
    for source in CSS_URL.findall(html):
        if source in seen:
            continue
        if source.startswith("data:image"):  # kept as a reference without a key: no capture is made of it
            rows.append((page_url, title, len(images), "", "", "", "", "css", False, None))
        elif links_to_image(source):
            add(resolve(page_url, source), "", "", "", "css")
    return rows


def html_references(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """page_url and html of pages -> one row per image reference, with the kept columns of its page."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema) if keep else ""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(SCHEMA)
        for part in parts:
            rows, of, size = [], [], 0
            for i, (u, h) in enumerate(zip(part["page_url"], part["html"])):
                url, html = u.as_py(), h.as_py()
                if url is not None and html is not None:
                    found = page_references(html, url)
                    rows += found
                    of += [i] * len(found)
                    size += len(html)
                if rows and (len(rows) >= LOT_ROWS or size >= LOT_BYTES or i == part.num_rows - 1):
                    out = arrow_batch(rows, schema)
                    own = [part[c].take(pa.array(of)) for c in keep]
                    yield pa.RecordBatch.from_arrays([*out.columns, *own], names=[*schema.names, *keep])
                    rows, of, size = [], [], 0

    return pages.select("page_url", "html", *keep).mapInArrow(run, SCHEMA + (f", {kept}" if kept else ""))
