"""HTML pages to one struct: text, links, frames, scripts, refreshes, tags. Each page is parsed once.

The tree is that of the standard library's parser: void elements hold nothing, an end tag closes the nearest open tag of
its name (and those within), one without any is passed over. The doctype's text, titles and noscript texts count as
displayed; styles, scripts, metas and comments don't.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lumenweb.functions.fixed import FORMAT_TAGS, LIMITS, TRIVIAL_TAGS

VOID = frozenset("area base br col embed hr img input link meta param source track wbr frame keygen command basefont bgsound".split())
_FORMAT = re.compile("</?(" + "|".join(FORMAT_TAGS) + ")>")
_LETTER = re.compile("[A-Za-z]")
# Scripts that send the visitor on, the page that a refresh names.
_WINDOW = re.compile(r"""window\.location(?:\.href*)* *=[\]*\["']([^"']+)[\]*\["']""")
_REFRESH = re.compile(r"""url\t* *=([^'"]*)""", re.I)
_EMPTY_PAGE = re.compile("blank|empty|notfound")
_PREFIX = re.compile(r"^(https://www\.)?")

_S, _A, _I, _B = T.StringType(), T.ArrayType, T.IntegerType(), T.BooleanType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


HTML_DATA = _struct(
    clean_text=_S, non_text=_S, title=_S,
    links=_A(_struct(link=_S, path=_S, tag=_S)), all_links=_A(_S),
    frames=_A(_struct(type=_S, link=_S, parent=_S, significance=_I, frames=_A(_struct(link=_S, type=_S, significance=_I)))),
    flag_iframe=_B, flag_js_found=_B, window_loc=_A(_S), meta_refresh=_S, n_lines_html=_I, tag_quantity=_I, no_script_text=_S, lg_inline_script=_I,
    libraries=_A(_S), has_open_graph=_B, has_twitter_card=_B, has_schema_tag=_B,
)


class Node:
    __slots__ = ("name", "attrs", "parent", "items", "place")

    def __init__(self, name: str, attrs: dict[str, str], parent: Node | None, place: int):
        self.name, self.attrs, self.parent, self.place = name, attrs, parent, place
        self.items: list[Node | tuple[str, str]] = []

    def text(self) -> str:
        out, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, Node):
                stack.extend(reversed(x.items))
            elif x[0] in ("text", "cdata"):
                out.append(x[1])
        return "".join(out)


class TreeBuilder(HTMLParser):
    """Nodes in the order of the page; a text is ("text" | "comment" | "doctype", value)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("[document]", {}, None, 0)
        self.nodes: list[Node] = []
        self.texts: list[tuple[Node, str, str]] = []
        self.open: dict[str, int] = {}
        self.words: list[str] = []

    def _flush(self) -> None:
        if self.words:
            self._put("text", "".join(self.words))
            self.words = []

    def _put(self, kind: str, value: str) -> None:
        self.at.items.append((kind, value))
        self.texts.append((self.at, kind, value))

    def handle_data(self, data: str) -> None:
        self.words.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()
        self._put("comment", data)

    def handle_decl(self, decl: str) -> None:
        self._flush()
        self._put("doctype", re.sub(r"(?i)^doctype\s*", "", decl))

    def unknown_decl(self, data: str) -> None:
        self._flush()
        self._put("cdata", data.removeprefix("CDATA["))

    def handle_pi(self, data: str) -> None:
        self._flush()
        self._put("text", data)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._flush()
        node = Node(tag, {k: "" if v is None else v for k, v in attrs}, self.at, len(self.at.items))
        self.at.items.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        if not self.open.get(tag):
            return
        while True:
            name = self.at.name
            self.open[name] -= 1
            self.at = self.at.parent
            if name == tag:
                return


def parse_tree(html: str) -> TreeBuilder:
    tree = TreeBuilder()
    tree.feed(html)
    tree.close()
    tree._flush()
    return tree


def dom_path(node: Node) -> str:
    """From the root on, the place of each ancestor among its siblings."""
    out = []
    at = node.parent
    while at is not None:
        out.append(str(at.place))
        at = at.parent
    return "_".join(reversed(out))


def trivial(link: str) -> bool:
    return not link or link.startswith(("#", "mailto")) or bool(_EMPTY_PAGE.search(link.rsplit("/", 1)[-1]))


def clean(link: str) -> str:
    link = link.replace("\\", "/")
    for p in ("https://www.", "http://www.", "https://", "http://", "//", "www."):
        link = link.removeprefix(p)
    return link.removesuffix("/")


def join(link: str, base: str) -> str:
    link = link.replace("\\", "/")
    if re.match("https?:", link, re.I) or link.startswith("//"):
        return link
    base = re.sub("^(https?:)?//", "", base, flags=re.I).removesuffix("/")
    link = "/" + link.removeprefix("./").removeprefix("/") if link.startswith(("./", "/")) and not link.startswith("//") else link
    return "http://" + base + ("" if link.startswith("/") else "/") + link


def displayed(raw: str) -> tuple[str, str]:
    """(clean_text, non_text): of the page without its formatting tags."""
    tree = parse_tree(_FORMAT.sub("", raw))
    seen = [v.strip() for node, kind, v in tree.texts if kind != "comment" and node.name not in ("style", "script", "meta")]
    attribute = lambda tag, key: ".".join(n.attrs[key] for n in tree.nodes if n.name == tag and key in n.attrs)
    about = next(("." + n.attrs["content"] for n in tree.nodes if n.name == "meta" and n.attrs.get("name") == "description" and "content" in n.attrs), "")
    text = ".".join([".".join(x for x in seen if x), attribute("a", "title"), attribute("img", "alt")]) + about
    rest, size = [], 0
    for n in tree.nodes:
        part = "__".join(f"{k}:{v}" for k, v in n.attrs.items()) + ("::" + n.text() if n.name == "script" else "")
        rest.append(part)
        size += len(part)
        if size >= LIMITS["non_text"]:
            break
    return text, "".join(rest)[: LIMITS["non_text"]]


def library(source: str) -> str:
    """A script's file name without its parameters and version."""
    return re.sub("-[0-9.]+", ".", re.split(r"[/\\]+", source)[-1].split("?")[0])


def extract(raw: str | None, url: str | None) -> dict | None:
    """All that is in HTML_DATA; null for a null page."""
    if raw is None:
        return None
    tree = parse_tree(raw)
    by: dict[str, list[Node]] = {}
    for n in tree.nodes:
        by.setdefault(n.name, []).append(n)
    base = next((n.attrs["href"] for n in by.get("base", []) if "href" in n.attrs), url or "")
    scripts = by.get("script", [])
    bodies = [s.text() for s in scripts]

    links = [(clean(join(n.attrs["href"], base)), dom_path(n), n.name) for tag in ("a", "area") for n in by.get(tag, []) if not trivial(n.attrs.get("href", ""))]
    found = [x[0] for x in links]

    refresh = [n for n in by.get("meta", []) if re.search("refresh", n.attrs.get("http-equiv", ""), re.I)]
    to = next((n.attrs["url"] for n in refresh if "url" in n.attrs), None)
    target = join(to, base) if to is not None and not trivial(to) else None
    if target is None and (content := next((n.attrs["content"] for n in refresh if "content" in n.attrs), None)) is not None:
        if (m := _REFRESH.search(content)) and not trivial(m[1].strip()):
            target = join(m[1].strip(), base)

    iframes, framesets = [], []
    for n in by.get("iframe", []):
        if "src" in n.attrs:
            own = not trivial(n.attrs["src"]) and "allowfullscreen" not in n.attrs
            if own:
                found.append(clean(n.attrs["src"]))
            iframes.append({"type": "iframe", "link": join(n.attrs["src"], base), "parent": n.parent.name, "significance": int(own), "frames": None})
    inner: dict[int, list[Node]] = {}
    for n in by.get("frame", []):
        at = n.parent
        while at is not None and "src" in n.attrs:
            if at.name == "frameset":
                inner.setdefault(id(at), []).append(n)
            at = at.parent
    for n in by.get("frameset", []):
        own = [{"link": join(f.attrs["src"], base), "type": "frame", "significance": int(not trivial(f.attrs["src"]))} for f in inner.get(id(n), [])]
        found += [clean(f.attrs["src"]) for f in inner.get(id(n), []) if not trivial(f.attrs["src"])]
        framesets.append({"type": "frameset", "link": None, "parent": n.parent.name, "significance": sum(f["significance"] for f in own), "frames": own})
    frames = framesets + iframes

    # Lines of the page as if each tag and each text had its own.
    lines = sum(1 if n.name in VOID else 2 for n in tree.nodes) + sum(1 + v.strip().count("\n") for _, _, v in tree.texts if v.strip())
    text, non_text = displayed(raw) if _LETTER.search(raw) else (None, None)
    meta = by.get("meta", [])
    return {
        "clean_text": text, "non_text": non_text, "title": by["title"][0].text().strip() if "title" in by else None,
        "links": [{"link": a, "path": b, "tag": c} for a, b, c in links], "all_links": found, "frames": frames,
        "flag_iframe": bool(frames), "flag_js_found": bool(scripts), "window_loc": [join(w, base) for b in bodies for w in _WINDOW.findall(b) if not trivial(w)], "meta_refresh": target,
        "n_lines_html": lines, "tag_quantity": sum(n.name not in TRIVIAL_TAGS for n in tree.nodes), "no_script_text": ".".join(n.text() for n in by.get("noscript", [])), "lg_inline_script": sum(map(len, bodies)),
        "libraries": sorted({library(s.attrs["src"]) for s in scripts if "." in s.attrs.get("src", "")}),
        "has_open_graph": any(n.attrs.get("property", "").startswith("og:") for n in meta), "has_twitter_card": any(n.attrs.get("name", "").startswith("twitter:") for n in meta), "has_schema_tag": any("itemprop" in n.attrs for n in meta),
    }


def _failed() -> dict:
    """A page that can't be parsed has no text and no links."""
    return {f.name: None for f in HTML_DATA.fields} | {"links": [], "all_links": [], "frames": [], "window_loc": [], "libraries": [], "flag_iframe": False, "flag_js_found": False, "has_open_graph": False, "has_twitter_card": False, "has_schema_tag": False, "n_lines_html": 0, "tag_quantity": 0, "no_script_text": "", "lg_inline_script": 0}


def parse_pages(df: DataFrame, html: str = "raw_text", url: str = "url", out: str = "html_data") -> DataFrame:
    """df with the struct out. A node of its own in the plan, so that no page is parsed twice however often out is used."""
    names, at, base = df.columns, df.columns.index(html), df.columns.index(url)
    kind = to_arrow_type(HTML_DATA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for raw, u in zip(batch.column(at), batch.column(base), strict=True):
                try:
                    rows.append(extract(raw.as_py(), u.as_py()))
                except (AssertionError, ValueError, RecursionError):  # the parser's own refusals
                    rows.append(_failed())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, kind)], [*names, out])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, HTML_DATA)]))
