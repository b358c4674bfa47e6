"""Main text of web pages with a site style tree.

The pages of a host are merged into one tree of style nodes: a node is the chain of tags, classes and ids from the root,
with digits folded. Over the host's distinct pages a node has
- presentation importance: the entropy (base m, of its m pages) of the child sequences under it, and
- content importance: 1 minus the mean entropy of its texts over the pages; a text on one page has entropy 0, one on all
  m pages 1.
A branch's importance mixes its own with its children's mean, with the content's share growing towards the leaves. Tags
and roles that state a purpose (nav, footer, ...) fix a branch's importance at 0. A branch is removed from every page if
it and all that it holds are below the threshold.

Whole class tokens and ids ("advert", "sidebar"; not ids of headings) are evidence: a branch named so goes, but its texts stay
where their nodes have the importance asked for outside of main parts and the branch either lies in a main part or has
blocks of LONG characters on average. A named branch around a page's only main part has no effect on it.

A main part that a page marks (<article>, <main>) is a prior and no override. Inside, the mean is over distinct texts and
not over occurrences, so that near copies of a page don't make its paragraphs boilerplate, and the tree never takes a
page's whole main part. Outside, a text stays only if its node's content importance times ``outside`` reaches the threshold.

Tree statistics are sums of small rows (host, node, hash), so a host with a third of all pages is summed before it moves.
A host's tree meets its pages by a broadcast when all trees together are below a checked size, and by a salted join beyond.

Defined results: null or empty html gives an empty text; pages without a host share the host ''; repeated pages count once
in the tree and are extracted each; of nodes seen on fewer than three pages of a host the tree knows nothing: their text is
kept unless named or outside of a marked main part. Declarations are skipped as browsers do,
so no page fails: a comment without an end reaches to the end of the page. Extra columns pass through; a column called text is replaced, and names with a leading "_tree_" are refused.
"""

from __future__ import annotations

import html.parser
import re
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyframe.llm.work import Workspace

#: Elements without end tags.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements that begin and end a block of text.
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot",
    "th", "thead", "title", "tr", "ul",
}
#: Elements that an opening tag ends, and where the search for them stops.
CLOSES = {
    **dict.fromkeys(("p", "div", "ul", "ol", "dl", "table", "section", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "form", "aside", "nav", "footer", "header", "article", "main", "figure", "address", "fieldset", "hr"), {"p"}),
    "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"},
}
BARRIER = {"ul", "ol", "dl", "table", "div", "article", "section", "main", "aside", "nav", "body", "td", "blockquote", "form", "footer", "header"}
#: Names of parts that are not the article.
REMOVED_TAGS = {"head", "title", "script", "style", "noscript", "template", "nav", "footer", "aside", "form", "button", "select", "option", "textarea", "iframe", "svg", "canvas", "object", "dialog", "menu"}
REMOVED_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer",
    "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "popup", "promo", "promotion", "recommended", "related", "replies",
    "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
REMOVED_ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "navigation", "search"}
MAIN_TAGS = {"main", "article"}

#: Ids that say what a heading is about.
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Mean characters of a block from which a named branch outside of a main part counts as prose.
LONG = 200

REMOVED, OPEN = 0, -1
#: A path of so many characters goes on under its hash, so that deep nesting costs no more than its depth.
LONG_PATH = 2000
#: Where a text is: outside of a main part, in one below a named branch, in another one.
OUT, WRAPPED, MAIN = range(3)
#: Kinds of observations: a text outside of a main part, a child sequence, a text inside of one, a page with a text.
TEXT, SEQUENCE, INSIDE, PRESENT = range(4)
_GAP = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
#: Markup that browsers skip: a comment without an end, to the end of the page, and a marked section, to its first ">".
_DECLARED = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--(?:-?>|.*?--!?>)|(?P<gone><!--.*\Z|<!\[[^>]*(?:>|\Z))", re.S | re.I)


def _hash(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Block(NamedTuple):
    path: str
    raw: str
    main: int
    part: int  # the named branch that holds it, in its main part if it has one
    wrap: int  # the named branch around its main part
    group: int  # equal for the segments of one block of text, which named inline elements cut

    @property
    def text(self) -> str:
        return _GAP.sub(" ", self.raw).strip()


class _Node:
    __slots__ = ("tag", "path", "state", "main", "part", "wrap", "named", "children")

    def __init__(self, tag: str, path: str, state: int, main: int, part: int, wrap: int, named: bool):
        self.tag, self.path, self.state, self.main, self.part, self.wrap, self.named, self.children = tag, path, state, main, part, wrap, named, []


class Page(html.parser.HTMLParser):
    """Blocks of text with the style path that owns them, and the child sequences of each path.

    removed: paths whose branches are left out besides those with telling tags. cut: whether a main part lost text to them.
    """

    def __init__(self, removed: frozenset[str] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.removed = removed
        self.cut = False
        self.stack = [_Node("", "", OPEN, OUT, 0, 0, False)]
        self.blocks: list[Block] = []
        self.sequences: list[tuple[str, str]] = []
        self.parts: list[str] = []
        self.owner: _Node | None = None
        self.named = self.group = 0

    def _cut(self) -> None:
        """Ends a segment; the block goes on."""
        if self.owner is not None:
            o = self.owner
            self.blocks.append(Block(o.path, "".join(self.parts), o.main, o.part, o.wrap, self.group))
            self.parts, self.owner = [], None

    def _flush(self) -> None:
        self._cut()
        self.parts = []
        self.group += 1

    def _pop(self) -> None:
        node = self.stack.pop()
        if node.tag in BLOCK or node.state == REMOVED:
            self._flush() if node.tag in BLOCK else self._cut()
        elif node.named:
            self._cut()
        if node.state != REMOVED and node.children:
            self.sequences.append((node.path, " ".join(dict.fromkeys(node.children))))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br" or tag in VOID:
            self.parts.append(" ")
            if tag == "hr":
                self._flush()
            return
        closes = CLOSES.get(tag)
        if closes:
            for k in range(len(self.stack) - 1, 0, -1):
                name = self.stack[k].tag
                if name in closes:
                    while len(self.stack) > k:
                        self._pop()
                elif name in BARRIER:
                    break
        if tag in BLOCK:
            self._flush()
        above = self.stack[-1]
        named = dict(attrs)
        label = f"{named.get('class') or ''} {named.get('id') or ''}"
        style = _DIGITS.sub("0", f"{tag}.{'.'.join(sorted(label.split()))}")
        path = f"{above.path}/{style}" if len(above.path) < LONG_PATH else f"{_hash(above.path):x}/{style}"  # the same for all pages
        state = above.state
        tokens = named.get("class") or "" if tag in HEADINGS else label
        telling = tag not in ("html", "body") and not REMOVED_NAMES.isdisjoint(tokens.lower().split())
        main, part, wrap = above.main, above.part, above.wrap
        if not main and state != REMOVED and tag in MAIN_TAGS and not telling:
            main, part, wrap = WRAPPED if part else MAIN, 0, part
        elif telling and not part:
            self.named += 1
            part = self.named
        if (
            tag in REMOVED_TAGS
            or named.get("role") in REMOVED_ROLES
            or "hidden" in named
            or named.get("aria-hidden") == "true"
            or (tag == "header" and not above.main)
        ) and tag not in ("html", "body"):
            state = REMOVED
        elif state != REMOVED and path in self.removed:
            state = REMOVED
            self.cut |= main != OUT
        if tag in BLOCK:
            above.children.append(style)
        if state == REMOVED and above.state != REMOVED:
            self._flush() if tag in BLOCK else self.parts.append(" ")
        elif telling and state != REMOVED and tag not in BLOCK:
            self._cut()
        self.stack.append(_Node(tag, path, state, main, part, wrap, telling))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("script", "style", "iframe", "svg", "path", "rect", "circle", "use"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.parts.append(" ")
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                while len(self.stack) > k:
                    self._pop()
                return

    def handle_data(self, data: str) -> None:
        top = self.stack[-1]
        if top.state == REMOVED:
            return
        if self.owner is None:
            if not data.strip():
                self.parts.append(" ")
                return
            self.owner = next((n for n in reversed(self.stack) if n.tag in BLOCK or n.named or not n.tag), top)
        self.parts.append(data)

    def finish(self) -> Page:
        while len(self.stack) > 1:
            self._pop()
        self._flush()
        return self


def parse(source: str | None, removed: frozenset[str] = frozenset()) -> Page:
    source = _DECLARED.sub(lambda m: "" if m["gone"] else m[0], source or "")
    page = Page(removed)
    try:
        page.feed(source)
        page.close()
    except AssertionError:  # what else Python's parser takes for a declaration and doesn't know is text
        page = Page(removed)
        page.feed(source.replace("<!", "&lt;!"))
        page.close()
    return page.finish()


def _chosen(blocks: list[Block], trusted: frozenset[str]) -> list[Block]:
    marked = max((b.main for b in blocks), default=OUT)
    lengths: dict[int, list[int]] = {}
    for b in blocks:
        lengths.setdefault(b.part if b.main == marked else b.wrap or b.part, []).append(len(b.text))
    prose = {part for part, found in lengths.items() if sum(found) >= LONG * len(found)}
    out = []
    for b in blocks:
        inside = marked != OUT and b.main == marked
        part = b.part if inside else b.wrap or b.part
        if part:
            keep = b.path in trusted and (inside or part in prose)
        else:
            keep = inside or marked == OUT or b.path in trusted
        if keep:
            out.append(b)
    if marked != OUT and not any(b.main == marked for b in out):  # names don't take a whole main part either
        return [b for b in blocks if b.main == marked]
    return out


def main_text(source: str | None, removed: frozenset[str] = frozenset(), trusted: frozenset[str] = frozenset()) -> str:
    """trusted: paths whose texts stay outside of a marked main part or in a named branch."""
    page = parse(source, removed)
    if page.cut and not any(b.main for b in page.blocks):
        page = parse(source)  # the whole main part is never taken
    groups: dict[int, list[Block]] = {}
    chosen = set(_chosen(page.blocks, trusted))
    for b in page.blocks:
        groups.setdefault(b.group, []).append(b)
    texts = (_GAP.sub(" ", "".join(b.raw if b in chosen else " " for b in group)).strip() for group in groups.values())
    return "\n\n".join(t for t in texts if t)


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page its digest and the (node, kind, value) that it has."""
    for batch in batches:
        pages: dict[tuple[str, bytes], list[tuple]] = {}
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            name = host, blake2b(source.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            if name in pages:
                continue
            page = parse(source)
            rows = dict.fromkeys((b.path, INSIDE if b.main else TEXT, _hash(b.text)) for b in page.blocks)
            rows |= dict.fromkeys((b.path, PRESENT, 0) for b in page.blocks)
            rows |= dict.fromkeys((p, SEQUENCE, _hash(s)) for p, s in page.sequences)
            pages[name] = list(rows)
        ends = np.cumsum([0, *map(len, pages.values())])
        columns = list(zip(*(r for rows in pages.values() for r in rows), strict=True)) or [[], [], []]
        fields = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int64()), strict=True)]
        seen = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, ["path", "kind", "value"]))
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in pages], pa.string()), pa.array([d for _, d in pages], pa.binary()), seen], ["host", "page", "seen"])


def _low(threshold: float, decay: float, outside: float):
    def run(host: pa.Table) -> pa.Table:
        """The highest branches of one host's tree that are below the threshold throughout, and the nodes with trusted texts."""
        own = {r["path"]: r for r in host.to_pylist()}
        below: dict[str, list[str]] = {}
        for path in own:
            below.setdefault(path.rpartition("/")[0], []).append(path)
        importance: dict[str, float] = {}
        for path in sorted(own, key=lambda p: -p.count("/")):
            r, children = own[path], [importance[c] for c in below.get(path, ())]
            content = r["content"]
            shape = r["presentation"] or 0.0
            if path.rpartition("/")[2].split(".")[0] in ("", "html", "body"):
                importance[path] = 1.0
            elif children:
                share = decay ** (1 + path.count("/"))
                mean = (sum(children) + (content if content is not None else 0)) / (len(children) + (content is not None))
                importance[path] = (1 - share) * mean + share * shape if content is not None or shape == 0 else max(mean, shape)
            else:
                importance[path] = content if content is not None else 1.0
        low: set[str] = set()
        for path in importance:  # children first
            texts = own[path]["content"]
            if importance[path] < threshold and (texts is None or texts < threshold) and own[path]["pages"] >= 3 and low.issuperset(below.get(path, ())):
                low.add(path)
        removed = sorted(p for p in low if p.rpartition("/")[0] not in low)
        trusted = sorted(p for p, r in own.items() if r["content"] is not None and r["pages"] >= 3 and outside * r["content"] >= threshold)
        name = host.column("host")[0].as_py()
        return pa.table({"host": pa.array([name], pa.string()), "removed": pa.array([removed], pa.list_(pa.string())), "trusted": pa.array([trusted], pa.list_(pa.string()))})

    return run


def style_tree(pages: DataFrame, work: Workspace, *, threshold: float = 0.2, decay: float = 0.9, outside: float = 0.5) -> DataFrame:
    """(host, removed, trusted): for each host the branches to remove and the nodes whose texts stay against a prior.

    ``pages`` has host and html.
    """
    pages = pages.where("html IS NOT NULL AND html <> ''")
    once = pages.mapInArrow(_observe, "host string, page binary, seen array<struct<path: string, kind: int, value: long>>").dropDuplicates(["host", "page"])
    seen = once.select("host", F.inline("seen")).groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n"))
    weight = F.when(F.col("kind") == TEXT, F.col("n")).when(F.col("kind") == INSIDE, 1)
    shapes = F.when(F.col("kind") == SEQUENCE, F.col("n"))
    seen = work.save(seen, "seen")
    kinds = seen.groupBy("host", "path").agg(
        F.sum(weight).alias("texts"),
        F.sum(weight * F.log("n")).alias("text_logs"),
        F.sum(shapes).alias("shapes"),
        F.sum(shapes * F.log("n")).alias("shape_logs"),
        F.greatest(F.coalesce(F.sum(shapes), F.lit(0)), F.coalesce(F.max(F.when(F.col("kind") == PRESENT, F.col("n"))), F.lit(0))).alias("pages"),
    )
    log_m = F.log(F.greatest(F.max("pages").over(Window.partitionBy("host")), F.lit(2)))
    nodes = kinds.select(
        "host",
        "path",
        "pages",
        (1 - F.col("text_logs") / F.col("texts") / log_m).alias("content"),
        ((F.log("shapes") - F.col("shape_logs") / F.col("shapes")) / log_m).alias("presentation"),
    )
    return nodes.groupBy("host").applyInArrow(_low(threshold, decay, outside), "host string, removed array<string>, trusted array<string>")


def extract(pages: DataFrame, work: Workspace, *, url: str = "url", source: str = "html", broadcast_bytes: int = 32 << 20, salts: int = 32) -> DataFrame:
    """``pages`` with text, the main text of each page, in place of its html."""
    if clash := [c for c in pages.columns if c.startswith("_tree_")]:
        raise ValueError(f"reserved column names: {clash}")
    host = F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    tree = work.save(style_tree(pages.select(host.alias("host"), F.col(source).alias("html")), work).where("size(removed) + size(trusted) > 0"), "tree")
    size = tree.agg(F.sum(F.length("host") + F.aggregate(F.concat("removed", "trusted"), F.lit(0), lambda s, x: s + F.length(x)) + 64)).first()[0] or 0
    kept = [c for c in pages.columns if c not in (source, "text")]
    tree = tree.select(F.col("host").alias("_tree_host"), F.col("removed").alias("_tree_removed"), F.col("trusted").alias("_tree_trusted"))
    pages = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(source).alias("_tree_html"), host.alias("_tree_host"))
    if size <= broadcast_bytes:
        joined = pages.join(F.broadcast(tree), "_tree_host", "left")
    else:
        tree = tree.withColumn("_tree_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = pages.withColumn("_tree_salt", F.pmod(F.xxhash64("_tree_html"), F.lit(salts)).cast("int")).join(tree, ["_tree_host", "_tree_salt"], "left")
    lists = ("_tree_html", "_tree_removed", "_tree_trusted")
    joined = joined.select(*[F.col(f"`{c}`") for c in kept], *lists)
    schema = StructType([*[f for f in joined.schema if f.name not in lists], StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in lists]
            texts = [main_text(h, frozenset(r or ()), frozenset(t or ())) for h, r, t in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], pa.array(texts, pa.string())], [*kept, "text"])

    return joined.mapInArrow(run, schema)
