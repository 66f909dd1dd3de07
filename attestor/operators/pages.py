"""Page extraction: one Arrow pass parses each page, the rest is DataFrame work."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from functools import partial, reduce
from html.parser import HTMLParser
from itertools import islice
from operator import or_
from urllib.parse import urljoin, urlsplit, urlunsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import expr as X
from ..shared import dealt
from .rank import first_wins, top_n_per_entity

#: kind -> words of path or anchor text. Fixed values.
PAGE_KINDS = (
    ("about", ("om-oss", "om oss", "about", "om-selskapet", "selskapet", "hvem-er-vi")),
    ("contact", ("kontakt", "contact")),
    ("team", ("team", "ansatte", "ledelse", "management", "people", "medarbeidere", "styret", "leadership")),
    ("careers", ("karriere", "career", "careers", "jobb", "ledige-stillinger", "jobs", "stillinger", "join-us")),
    ("news", ("nyheter", "news", "aktuelt", "blogg", "blog", "presse", "press", "media", "investor", "ir")),
)
#: Endings of files that are no pages, words of leading titles, the form of a person's name. Fixed values.
SKIPPED_ENDINGS = (".pdf", ".jpg", ".jpeg", ".png", ".gif", ".svg", ".webp", ".zip", ".doc", ".docx", ".xls", ".xlsx", ".xml", ".css", ".js", ".mp4", ".mp3", ".ics")
LEADER_TITLES = (
    "daglig leder", "administrerende", r"\bCEO\b", r"\bCFO\b", r"\bCTO\b", r"\bCOO\b", r"\bCMO\b", r"\bCCO\b", "styreleder", "styrets leder", "avdelingsleder",
    r"leder for\b", "konsernsjef", r"sjef\b", r"direkt[øo]r\b", "managing director", "general manager", "country manager", r"\bdirector\b", r"\bpartner\b",
    r"\bfounder\b", r"gr[üu]nder", r"\beier\b", r"\bowner\b", r"\bhead of\b", r"\bchief\b",
)
PERSON = r"[A-ZÆØÅ][a-zæøåé]+(?:[ -][A-ZÆØÅ][a-zæøåé]+){1,2}"
_HIDDEN, _BLOCK = {"script", "style", "noscript", "template"}, {"p", "div", "li", "br", "h1", "h2", "h3", "h4", "tr", "section", "article", "footer", "header", "ul", "address", "td"}
PARSED = (
    "page_id long, url string, host string, text string, title string, title_markup string, description string, site_name string, og_title string, links array<struct<pos:int,url:string,anchor:string,time:string>>, "
    "feeds array<string>, nodes array<struct<type:string,json:string>>, positions array<struct<label:string,text:string>>, strings array<string>"
)


#: Elements without content, and those that a start tag closes though their end tag is left out, up to a boundary. Fixed values of HTML.
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_CELLS, _ROWS = ("td", "th"), ("tr", "td", "th")
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "option": (("option",), ("select", "datalist")), "tr": (_ROWS, ("table",)),
    "td": (_CELLS, ("tr", "table")), "th": (_CELLS, ("tr", "table")), "tbody": (("thead", "tbody", "tfoot", *_ROWS), ("table",)), "tfoot": (("thead", "tbody", *_ROWS), ("table",)), "body": (("head",), ()),
}
_ENDS_P = {
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section",
    "table", "ul",
}
_P = (("p",), ("button", "td", "th", "caption", "object"))
_CLOSED_BY = {t: tuple(filter(None, (_P if t in _ENDS_P else None, _CLOSES.get(t)))) for t in {*_ENDS_P, *_CLOSES}}
#: What a text in an element of a tag counts as.
_COUNTED = dict.fromkeys(_HIDDEN, "hidden") | {"title": "title", "h1": "head", "h2": "head", "footer": "foot", "address": "foot"}
#: A start tag as most are written, its attributes, and tags whose content the standard parser reads in its own way.
_START, _ATTRIBUTE = re.compile(r'<([a-z][a-z0-9]*)((?: [a-z:_-]+="[^"&<>]*")*)>'), re.compile(r' ([a-z:_-]+)="([^"]*)"')
_OWN_CONTENT = {"script", "style", "title", "textarea", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
#: A path from the root without dots, which a join with a page's URL leaves as it is.
_ROOTED = re.compile(r"(/[\w-]+(?:/[\w-]+)*/?)(?:[?#][!-~]*)?", re.A)
#: Items inside items, and properties whose text is read, at most; deeper ones count as plain markup.
_DEEPEST = 60


class _Page(HTMLParser):
    """Visible text, links, metas, JSON-LD, microdata and the places where a page names itself.

    Open elements are a stack, with the places of each tag in it, so that an end tag finds its element at once and a stray one
    is told by its absence; each element is pushed and popped once. What a text lies in is told by counters.
    """

    def __init__(self, referred: frozenset[str] = frozenset()) -> None:
        super().__init__(convert_charrefs=True)
        self.text, self.title, self.meta, self.links, self.feeds, self.ld = [], [], {}, [], [], []
        self.stack, self.at, self.inside = [], {}, dict.fromkeys(("hidden", "title", "head", "foot"), 0)
        self.anchor, self.heads, self.foot = None, [], []
        self.scopes, self.props, self.referred, self.parts = [], [], referred, {}

    def updatepos(self, i: int, j: int) -> int:  # lines aren't counted, nobody asks for them
        return j

    def parse_starttag(self, i: int) -> int:
        m = _START.match(self.rawdata, i)
        if not m or m[1] in _OWN_CONTENT:
            return super().parse_starttag(i)
        self.handle_starttag(m[1], _ATTRIBUTE.findall(m[2]) if m[2] else [])
        return m.end()

    def _within(self, tag: str, by: int) -> None:
        if name := _COUNTED.get(tag):
            self.inside[name] += by

    def _place(self, tags: Sequence[str]) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def _end(self, to: int) -> None:
        """Close all elements from a place of the stack on."""
        while len(self.stack) > to:
            tag, _ = self.stack.pop()
            self.at[tag].pop()
            self._within(tag, -1)
            at = len(self.stack)
            if self.props and self.props[-1][0] == at:
                _, names, parts = self.props.pop()
                self._property(names, _squash("".join(parts)))
            while self.scopes and self.scopes[-1][0] == at:
                self.scopes.pop()

    def _property(self, names: list[str], value: object) -> None:
        for _, item, whole in reversed(self.scopes):
            for name in names:
                item["props"].setdefault(name, []).append(value)
            if whole:
                break

    def _microdata(self, a: dict, tag: str) -> None:
        if not (self.scopes or self.referred or "itemscope" in a):
            return
        at, names = len(self.stack), a.get("itemprop", "").split()
        deep = len(self.scopes) >= _DEEPEST or tag in _VOID
        if a.get("id") in self.referred and a["id"] not in self.parts and not deep:
            self.parts[a["id"]] = part = {"props": {}}
            self.scopes.append((at, part, False))
        if "itemscope" in a and not deep:
            item = {"types": a.get("itemtype", "").split(), "refs": a.get("itemref", "").split(), "props": {}}
            if names:
                self._property(names, item)
            if not names or not any(whole for _, _, whole in self.scopes):
                self.ld.append(item)
            self.scopes.append((at, item, True))
        elif names and self.scopes:
            value = a.get("content") or a.get("href") or a.get("src") or a.get("datetime")
            if value or tag in _VOID:
                self._property(names, value or "")
            elif len(self.props) < _DEEPEST:
                self.props.append((at, names, []))

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = {k: v or "" for k, v in attrs}
        for closed, bounds in _CLOSED_BY.get(tag, ()):
            bound = self._place(bounds)
            if left_open := [x for t in closed for x in self.at.get(t, ())[-1:] if x > bound]:
                self._end(min(left_open))
        if tag == "meta":
            key = (a.get("property") or a.get("name") or "").lower()
            if key and a.get("content"):
                self.meta.setdefault(key, a["content"].strip())
        elif tag == "link" and "alternate" in a.get("rel", "") and re.search("rss|atom", a.get("type", "")):
            self.feeds.append(a.get("href", ""))
        elif tag == "a":
            self._link()
            self.anchor = [a.get("href", ""), [], ""]
        elif tag == "time" and self.anchor and not self.anchor[2]:
            self.anchor[2] = a.get("datetime", "")
        if tag in _BLOCK:
            self.text.append("\n")
        self._microdata(a, tag)
        if tag not in _VOID:
            self.at.setdefault(tag, []).append(len(self.stack))
            self.stack.append((tag, a.get("type", "")))
            self._within(tag, 1)
            if tag in ("h1", "h2"):
                self.heads.append([])

    def _link(self) -> None:
        if self.anchor:
            self.links.append((self.anchor[0], "".join(self.anchor[1]), self.anchor[2]))
            self.anchor = None

    def handle_endtag(self, tag: str) -> None:
        if tag == "a":
            self._link()
        if tag in _BLOCK:
            self.text.append("\n")
        if self.at.get(tag):
            self._end(self.at[tag][-1])

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][0] == "script" and "ld+json" in self.stack[-1][1]:
            self.ld.append(data)
        if self.inside["hidden"]:
            return
        if self.inside["title"]:
            self.title.append(data)
        self.text.append(f" {data}")
        if self.anchor:
            self.anchor[1].append(data)
        if self.inside["head"] and self.heads:
            self.heads[-1].append(data)
        if self.inside["foot"]:
            self.foot.append(data)
        for _, _, parts in self.props:
            parts.append(data)

    def close(self) -> None:
        super().close()
        self._link()
        self._end(0)

    def items(self) -> Iterator[object]:
        """JSON-LD blocks and top-level items in the order of the page, an item in the shape of JSON-LD."""

        def shaped(item: dict, through: tuple) -> dict:
            props = dict(item["props"])
            for ref in item.get("refs", ()):
                if ref in self.parts and ref not in through:
                    props |= {k: [*props.get(k, ()), *v] for k, v in self.parts[ref]["props"].items()}
            through = (*through, *item.get("refs", ()))
            out = {k: [shaped(x, through) if isinstance(x, dict) else x for x in v] for k, v in props.items()}
            types = [t.rsplit("/", 1)[-1] for t in item.get("types", ())]
            return {"@type": types[0] if len(types) == 1 else types} | {k: v[0] if len(v) == 1 else v for k, v in out.items()}

        for block in self.ld:
            try:
                yield json.loads(block) if isinstance(block, str) else shaped(block, ())
            except (ValueError, RecursionError):
                continue


def _squash(text: str) -> str:
    return " ".join(text.split())


def typed_nodes(data: object) -> Iterator[dict]:
    """Every object with an @type, at any depth, outer ones first."""
    todo = [data]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if x.get("@type"):
                yield x
            todo += reversed(list(x.values()))
        elif isinstance(x, list):
            todo += reversed(x)


#: Types of nodes that name the page's own organisation. Fixed values.
ORG_TYPES = ("Organization", "LocalBusiness", "Corporation")


def _strings(node: dict, keys: Sequence[str]) -> list[str]:
    found = [x for k in keys for x in (node.get(k) if isinstance(node.get(k), list) else [node.get(k)])]
    return [x.strip() for x in found if isinstance(x, str) and x.strip()]


def _host(url: str | None) -> str | None:
    """Lower-case host without www., its punycode labels decoded where they can be; None for no URL."""
    try:
        host = (urlsplit(url or "").hostname or "").removeprefix("www.")
    except ValueError:
        return None
    try:
        return host.encode("ascii").decode("idna") or None
    except UnicodeError:
        return host or None


#: The start and the end tag of a title.
_TITLE, _TITLE_END = re.compile(r"<title(?:\s[^<>]*)?>", re.I), re.compile(r"</title", re.I)


def title_markup(html: str) -> str:
    """The first title as it is written, entities and all; empty without one or where it isn't closed."""
    start = _TITLE.search(html)
    end = _TITLE_END.search(html, start.end()) if start else None
    return html[start.end() : end.start()] if end else ""


#: Ids that an item refers to, and where a page says whose it is. Fixed values.
_REFERRED = re.compile(r"""(?i)\bitemref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WHOSE = re.compile(r"©|\(c\)\s*20\d\d|copyright|alle rettigheter|all rights reserved", re.I)


def _root(url: str | None) -> str | None:
    """Scheme and host of a web page's URL, for links from the root; None for other URLs."""
    try:
        at = urlsplit(url or "")
    except ValueError:
        return None
    return f"{at.scheme}://{at.netloc.lower()}" if at.scheme in ("http", "https") and at.netloc else None


def parse_page(url: str | None, html: str | None) -> dict:
    referred = {i for m in _REFERRED.finditer(html) for i in "".join(filter(None, m.groups())).split()} if html and "itemref" in html.lower() else ()
    p = _Page(frozenset(referred))
    try:
        p.feed(html or "")
        p.close()
    except (AssertionError, ValueError):  # what the standard parser can't go past ends the page, not the job
        p._link()
        p._end(0)
    raw = "".join(p.text)
    text, title = _squash(raw), _squash(" ".join(p.title))
    nodes = []
    for n in (n for block in p.items() for n in typed_nodes(block)):
        try:
            said = json.dumps(n, ensure_ascii=False, sort_keys=True)
        except RecursionError:
            continue
        for t in n["@type"] if isinstance(n["@type"], list) else [n["@type"]]:
            nodes.append({"type": re.split("[/:]", str(t))[-1], "json": said})
    links, root = [], _root(url)
    for href, anchor, time in p.links:
        if not href or href.startswith(("javascript:", "#")):
            continue
        if root and (rooted := _ROOTED.fullmatch(href)):
            links.append({"pos": len(links), "url": root + rooted[1], "anchor": _squash(anchor), "time": time})
            continue
        try:
            full = urlsplit(urljoin(url or "", href))
            # mail and phone links keep their all; pages lose query and fragment
            clean = urlunsplit((full.scheme, full.netloc.lower(), full.path or "/", "", "")) if full.scheme in ("http", "https") else href
        except ValueError:
            continue
        links.append({"pos": len(links), "url": clean, "anchor": _squash(anchor), "time": time})
    marks = [text[max(0, m.start() - 60) : m.end() + 60] for m in islice(_WHOSE.finditer(text), 3)]
    author = " ".join(p.meta[k] for k in ("author", "publisher", "copyright") if k in p.meta)
    names = [v for n in nodes if n["type"] in ORG_TYPES for v in _strings(json.loads(n["json"]), ("name", "legalName", "alternateName"))]
    named = [("title", title), ("og:site_name", p.meta.get("og:site_name", "")), ("og:title", p.meta.get("og:title", "")), *(("json-ld", v) for v in names), ("footer", _squash(" ".join(p.foot))[:2000]), ("headings", _squash(" ".join("".join(h) for h in p.heads[:8]))[:800]), ("author", author), ("copyright", " ".join(marks))]
    feeds = []
    for f in p.feeds:
        try:
            feeds.append(urljoin(url or "", f))
        except ValueError:
            continue
    return {
        "host": _host(url), "text": text, "title": title, "title_markup": title_markup(html or ""), "description": p.meta.get("description") or p.meta.get("og:description"), "site_name": p.meta.get("og:site_name"),
        "og_title": p.meta.get("og:title"), "links": links, "feeds": feeds, "nodes": nodes,
        "positions": [{"label": k, "text": v} for k, v in named if v], "strings": [s for s in map(_squash, raw.split("\n")) if s],
    }


#: Characters of HTML, and pages, that are parsed before what they gave leaves the worker. Fixed values.
_AT_ONCE, _PAGES = 1_000_000, 250


def _parse(batches: Iterator[pa.RecordBatch], columns: Sequence[str] = ()) -> Iterator[pa.RecordBatch]:
    """Pages by small groups: a worker holds one batch of HTML as Arrow has it, and the parts of a few pages."""
    node, pos = pa.struct([("type", pa.string()), ("json", pa.string())]), pa.struct([("label", pa.string()), ("text", pa.string())])
    link = pa.struct([("pos", pa.int32()), ("url", pa.string()), ("anchor", pa.string()), ("time", pa.string())])
    kinds = {"host": pa.string(), "text": pa.string(), "title": pa.string(), "title_markup": pa.string(), "description": pa.string(), "site_name": pa.string(), "og_title": pa.string(), "links": pa.list_(link), "feeds": pa.list_(pa.string()), "nodes": pa.list_(node), "positions": pa.list_(pos), "strings": pa.list_(pa.string())}
    kinds = {k: t for k, t in kinds.items() if not columns or k in columns}
    for batch in batches:
        urls, pages, start, made, size = batch.column("url"), batch.column("html"), 0, [], 0
        for i in range(batch.num_rows):
            html = pages[i].as_py()
            made.append(parse_page(urls[i].as_py(), html))
            size += len(html or "")
            if size >= _AT_ONCE or len(made) >= _PAGES or i + 1 == batch.num_rows:
                cols = [pa.array([m[k] for m in made], t) for k, t in kinds.items()]
                yield pa.RecordBatch.from_arrays([batch.column("page_id").slice(start, len(made)), urls.slice(start, len(made)), *cols], ["page_id", "url", *kinds])
                start, made, size = i + 1, [], 0


def parse_pages(pages: DataFrame, *columns: str) -> DataFrame:
    """pages(page_id, url, html) -> PARSED, one Arrow pass over pages dealt out by their ids.

    title is as a browser shows it, title_markup as the page writes it. Of PARSED only page_id, url and the named columns leave the
    worker, all where none is named: Spark can't tell a worker what is read of its result.
    """
    kinds = StructType.fromDDL(PARSED)
    if unknown := set(columns) - set(kinds.names):
        raise ValueError(f"no columns of a parsed page: {sorted(unknown)}")
    kinds = StructType([f for f in kinds if not columns or f.name in ("page_id", "url", *columns)])
    return dealt(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), "page_id").mapInArrow(partial(_parse, columns=columns), kinds)


def site_links(parsed: DataFrame, kinds: Sequence[tuple[str, Sequence[str]]] = PAGE_KINDS) -> DataFrame:
    """Links to pages of the same registered domain, with kind; files and other schemes go."""
    rows = parsed.select("page_id", X.registered_domain(X.host(F.col("url"))).alias("site"), F.explode("links").alias("l")).select("page_id", "site", "l.*")
    rows = rows.where(F.col("url").rlike("^https?://") & ~F.col("url").rlike("(?i)(?:" + "|".join(map(re.escape, SKIPPED_ENDINGS)) + ")$")).where(X.registered_domain(X.host(F.col("url"))) == F.col("site"))
    path = F.regexp_extract("url", r"^[a-z]+://[^/]*(.*)$", 1)
    return rows.withColumn("kind", X.page_kind(path, F.col("anchor"), kinds)).withColumn("depth", F.size(F.filter(F.split(path, "/"), lambda s: s != "")))


#: Hosts of consumer mail by a part of their name, and the form of an address. Fixed values.
FREEMAIL = ("gmail.", "hotmail.", "outlook.", "live.", "yahoo.", "icloud.", "online.no", "getmail.")
ADDRESS = r"^[\w.+-]+@[\w-]+(?:\.[\w-]+)+$"


def contacts(parsed: DataFrame) -> DataFrame:
    """(site, field, value, confidence, rank): linked addresses and numbers at 1.0, written ones at 0.8; three of each, own domain first.

    Consumer mail addresses, and what is no address or no Norwegian number, are left out.
    """
    site = X.registered_domain(X.host(F.col("url")))
    linked = parsed.select("page_id", site.alias("site"), F.explode("links").alias("l")).select("page_id", "site", F.col("l.url").alias("u"), F.col("l.pos").alias("pos"))
    mail = linked.where(F.col("u").rlike("(?i)^mailto:")).select("page_id", "site", F.lit("contact_email").alias("field"), F.lower(F.regexp_extract("u", r"(?i)^mailto:([^?]+)", 1)).alias("value"), F.lit(1.0).alias("confidence"), "pos")
    tel = linked.where(F.col("u").rlike("(?i)^tel:")).select("page_id", "site", F.lit("contact_phone").alias("field"), X.phone(F.substring(F.col("u"), 5, 100)).alias("value"), F.lit(1.0).alias("confidence"), "pos")
    text = lambda f, c: parsed.select("page_id", site.alias("site"), F.lit(f).alias("field"), F.posexplode(c).alias("pos", "value"), F.lit(0.8).alias("confidence")).select("page_id", "site", "field", "value", "confidence", F.col("pos") + 10_000)
    own = text("contact_email", X.emails(F.col("text"))).where(F.col("value").endswith(F.concat(F.lit("@"), F.col("site"))))
    mails = mail.union(own).withColumn("value", F.regexp_replace(F.trim("value"), r"\.+$", "")).where(F.col("value").rlike(ADDRESS))
    mails = mails.where(~reduce(or_, (F.contains(F.substring_index("value", "@", -1), F.lit(h)) for h in FREEMAIL)))
    rows = mails.union(tel.where("value is not null")).union(text("contact_phone", X.phones(F.col("text"))))
    rows = first_wins(rows, ["site", "field", "value"], ["page_id", "pos"])
    ours = (~F.coalesce(F.col("value").endswith(F.concat(F.lit("@"), F.col("site"))), F.lit(False))).cast("int")
    return top_n_per_entity(rows, ["site", "field"], [ours, F.col("value")], 3).select("site", "field", "value", "confidence", "rank")


def socials(parsed: DataFrame) -> DataFrame:
    """P5: first profile of each platform of a site, normalised and as published; links first, then sameAs of nodes."""
    site = X.registered_domain(X.host(F.col("url"))).alias("site")
    a = parsed.select("page_id", site, F.explode("links").alias("l")).select("page_id", "site", F.col("l.url").alias("published"), F.col("l.pos").alias("pos"))
    same = F.from_json(F.get_json_object("n.json", "$.sameAs"), "array<string>")
    one = F.get_json_object("n.json", "$.sameAs")
    b = parsed.select("page_id", site, F.explode("nodes").alias("n")).select("page_id", "site", F.posexplode(F.coalesce(same, F.array(one))).alias("pos", "published")).select("page_id", "site", "published", F.col("pos") + 10_000)
    rows = a.union(b).withColumn("platform", X.social_platform(F.col("published"))).where("platform is not null")
    out = first_wins(rows, ["site", "platform"], ["page_id", "pos"])
    return out.select("site", "platform", F.concat(F.lit("https://"), X.norm_url(F.col("published"))).alias("url"), F.col("published").alias("url_as_published"))


def typed(parsed: DataFrame, *types: str) -> DataFrame:
    """JSON-LD and microdata nodes of given types, by page."""
    rows = parsed.select("page_id", "url", F.posexplode("nodes").alias("pos", "n")).select("page_id", "url", "pos", "n.type", "n.json")
    return rows.where(F.col("type").isin(*types)) if types else rows


def org_facts(parsed: DataFrame) -> DataFrame:
    """(page_id, field, value) of organisations: name, phone, e-mail, address."""
    n = typed(parsed, *ORG_TYPES)
    j = lambda k: F.get_json_object("json", f"$.{k}")
    address = F.coalesce(F.nullif(F.concat_ws(", ", *(j(f"address.{k}") for k in ("streetAddress", "postalCode", "addressLocality", "addressCountry"))), F.lit("")), j("address"))
    facts = F.array(*(F.struct(F.lit(f).alias("field"), v.alias("value")) for f, v in (("name", j("name")), ("contact_phone", j("telephone")), ("contact_email", F.lower(j("email"))), ("site_location", address))))
    return n.select("page_id", F.explode(facts).alias("f")).select("page_id", "f.*").where("value is not null").distinct()


def leaders(parsed: DataFrame, most: int = 15) -> DataFrame:
    """(page_id, name, title): persons of nodes with a leading title, 'Name - Title' lines, a name and the line after it."""
    a = typed(parsed, "Person").select("page_id", "pos", F.get_json_object("json", "$.name").alias("name"), F.get_json_object("json", "$.jobTitle").alias("title"))
    s = parsed.select("page_id", F.posexplode("strings").alias("pos", "s"))
    split = rf"^({PERSON})\s*[,–\-|:/]\s*(.{{2,80}})$"
    b = s.where(F.col("s").rlike(split)).select("page_id", F.col("pos") + 1000, F.regexp_extract("s", split, 1), F.regexp_extract("s", split, 2))
    nxt = F.lead("s").over(W.partitionBy("page_id").orderBy("pos"))
    c = s.withColumn("n", nxt).where(F.col("s").rlike(f"^{PERSON}$") & (F.char_length("n") <= 80)).select("page_id", F.col("pos") + 1000, "s", "n")
    rows = a.union(b).union(c).where(F.col("title").rlike("(?iu)" + "|".join(LEADER_TITLES)) & (F.col("name") != ""))
    return top_n_per_entity(first_wins(rows, ["page_id", "name"], ["pos", "title"]), ["page_id"], [F.col("pos"), F.col("name")], most).select("page_id", "name", "title", "rank")


def job_postings(parsed: DataFrame) -> DataFrame:
    """Postings of nodes, one for each URL and title."""
    j = lambda k: F.get_json_object("json", f"$.{k}")
    rows = typed(parsed, "JobPosting").select("page_id", "pos", F.coalesce(j("url"), F.col("url")).alias("job_url"), j("title").alias("title"), F.left(j("datePosted"), F.lit(10)).alias("date_posted"), F.left(j("validThrough"), F.lit(10)).alias("valid_through"), F.coalesce(j("jobLocation.address.addressLocality"), j("jobLocation.name")).alias("location"))
    return first_wins(rows.where("title is not null"), ["job_url", "title"], ["page_id", "pos"]).drop("pos")


def news_items(parsed: DataFrame, feed: DataFrame | None = None, most: int = 10) -> DataFrame:
    """P10: dated articles of nodes, dated links of news pages and items of feed(site, title, link, date): the newest of a site.

    Links count on pages of kind news, to the site itself, with 8 characters of anchor or more; their date is in the anchor, in
    a time element of it, or in the path, there without the day too. date is text, of ten characters or seven.
    """
    domain, path = X.registered_domain(X.host(F.col("url"))), F.regexp_extract("url", r"^[a-z]+://[^/]*(.*)$", 1)
    site, iso = domain.alias("site"), lambda c: F.date_format(X.loose_date(c), "yyyy-MM-dd")
    j = lambda k: F.get_json_object("json", f"$.{k}")
    main = F.when(~F.coalesce(j("mainEntityOfPage"), F.lit("{")).startswith("{"), j("mainEntityOfPage"))
    a = typed(parsed, "NewsArticle", "Article", "BlogPosting").select(site, F.left(F.trim(F.coalesce(j("headline"), j("name"))), F.lit(200)).alias("title"), F.coalesce(j("url"), main).alias("link"), iso(j("datePublished")).alias("date"), F.lit(0).alias("pos"))
    links = parsed.where(X.page_kind(path, F.lit(""), PAGE_KINDS) == "news").select(site, F.explode("links").alias("l")).select("site", "l.*").where(F.char_length("anchor") >= 8)
    links = X.sealed(links, *map(F.col, ("site", "pos", "url", "anchor", "time")), domain.alias("_domain"), path.alias("_path")).where("_domain = site")
    part = lambda p, d: F.regexp_extract(p, rf"/(\d{{4}}/\d{{2}}{d})/", 1)
    month = lambda p: X.let(part(p, ""), lambda m: F.when(m != "", F.replace(m, F.lit("/"), F.lit("-"))))
    in_path = lambda p: X.let(part(p, r"/\d{2}"), lambda d: F.when(d != "", iso(F.replace(d, F.lit("/"), F.lit("-")))).otherwise(month(p)))
    said = X.let(F.struct("anchor", "time", "_path"), lambda x: F.coalesce(iso(x["anchor"]), iso(x["time"]), in_path(x["_path"])))
    b = links.select("site", F.left("anchor", F.lit(200)).alias("title"), F.col("url").alias("link"), said.alias("date"), (F.col("pos") + 1).alias("pos"))
    rows = a.union(b)
    if feed is not None:
        rows = rows.union(feed.select("site", "title", "link", F.col("date").cast("string"), F.lit(0).alias("pos")))
    # dates are made before the filter, which would make them twice
    rows = X.sealed(rows, *map(F.col, rows.columns)).where("date is not null and title <> '' and link is not null")
    rows = first_wins(rows, ["site", "link"], ["pos", "title", "date"])
    return top_n_per_entity(rows, ["site"], [F.desc("date"), F.col("link")], most).select("site", "rank", "date", "title", "link")


def careers_pages(parsed: DataFrame) -> DataFrame:
    """Careers pages without a machine-readable posting, with the cue they carry; a web fact, not a hiring fact."""
    cue = r"(ledige stillinger|open positions|vacancies|vi soker|we are hiring|join our team)"
    path = F.regexp_extract("url", r"^[a-z]+://[^/]*(.*)$", 1)
    rows = parsed.where(X.page_kind(path, F.lit(""), PAGE_KINDS) == "careers").select("page_id", "url", F.nullif(F.regexp_extract(X.fold_ascii(F.col("text")), cue, 1), F.lit("")).alias("cue"))
    return rows.join(typed(parsed, "JobPosting").select("page_id").distinct(), "page_id", "left_anti")


#: (section, field) that a read site always gets a row for. Fixed values.
REQUIRED = (("web", "social_profile"), ("web", "contact_email"), ("web", "contact_phone"), ("leadership", "site_leader"), ("activity", "news_item"), ("hiring", "job_posting"))


def fill_absence(claims: DataFrame, entities: DataFrame, required: Sequence[tuple[str, str]] = REQUIRED) -> DataFrame:
    """(entity_id, section, field, availability): found fields, and not_available for the required ones that were not."""
    want = entities.select("entity_id", F.explode(F.array(*(F.struct(F.lit(s).alias("section"), F.lit(f).alias("field")) for s, f in required))).alias("r")).select("entity_id", "r.*")
    have = claims.select("entity_id", "section", "field").distinct()
    return have.withColumn("availability", F.lit("available")).union(want.join(have, ["entity_id", "section", "field"], "left_anti").withColumn("availability", F.lit("not_available")))
