"""Main text of web pages, with a style tree for every site.

The pages of one host are merged into a tree of element paths. Spark counts, for every path of a host,
in how many distinct pages each presentation (sequence of child tags) and each content (text of a block)
occurs. A path's presentation importance is the entropy of its presentations, its content importance one
less the mean entropy of its contents over the pages; both are in [0, 1], and a branch's importance weighs
them as (1 - G**l) * presentation + G**l * content for l presentations. Branches below `LEAST` are noise
of that site and are cut from its pages.

A page's article or main element is content by declaration: what stands outside of it is no main text,
and the declaration weighs against cuts inside it, where only branches below `DECLARED * LEAST` go. The
element itself and what encloses it are never cut. Everywhere, branches that declare themselves as
something else (navigation, forms, scripts and so on, by tag, role, or a word of class or id) are cut.
On a page without such an element all that is left of the body is main text. A page whose content would
be cut as a whole keeps all of it.

Pages of a host with the same texts are one distinct page: copies are no repetition. Two distinct pages
show what a site repeats, by the same rule as any greater number; a single one shows nothing and is cut
only where it declares noise. A text that a site repeats in the very path of its paragraphs is not told
from them.

A null or empty page has no text. A page whose url has no host forms a site with the others of that
kind. Unclosed and stray tags are tolerated. Blocks keep their order and are never shortened. A path is made
of tags and classes, without ids and digits, which number pages rather than parts of a site. Elements nested more
than `DEEPEST` deep have the path of the last one that is not, so that a page of nothing but open tags costs no more than others.
"""

from __future__ import annotations

import hashlib
import html
import re
import sys
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST = 0.2
#: Share of LEAST that holds inside an article or main element.
DECLARED = 0.25
G = 0.9
SALTS = 16
DEEPEST = 256

# Element names and words that name the parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section select summary table tbody td tfoot th "
    "thead title tr ul".split()
)
NOISE_TAGS = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head iframe input label menu nav noscript object option script "
    "select style svg template textarea title video".split()
)
NOISE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo "
    "recommended related search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget".split()
)
NOISE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
MAIN_TAGS = frozenset(["article", "main"])
CLOSED_BY_BLOCK = frozenset(["p"])
#: An open element that a new one of the same group ends.
SIBLINGS = {"li": "li", "dt": "d", "dd": "d", "tr": "tr", "td": "t", "th": "t", "option": "option"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|textarea|svg|title)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.DOTALL | re.IGNORECASE,
)
_ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_DIGITS = re.compile(r"[\d>]+")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    """An element; root is the length of the path of the outermost article or main element around it, or 0."""

    __slots__ = ("tag", "path", "noise", "root", "children")

    def __init__(self, tag: str, path: str, noise: bool, root: int):
        self.tag, self.path, self.noise, self.root, self.children = tag, path, noise, root, []


class Page:
    """Elements of a page in order, and its blocks: (node, text)."""

    def __init__(self, source: str):
        self.root = Node("", "", False, 0)
        self.nodes: list[Node] = []
        self.blocks: list[tuple[Node, str]] = []
        self._stack = [self.root]
        self._tags: Counter[str] = Counter()  # of the elements on the stack
        self._open: list[str] = []
        for m in _TOKEN.finditer(source):
            if m["text"] is not None:
                self._open.append(m["text"])
            elif m["tag"]:
                self._element(m["tag"].lower(), bool(m["close"]), m["attrs"])
        self._flush()

    def _flush(self) -> None:
        if self._open:
            text = " ".join(html.unescape("".join(self._open)).split())
            if text:
                self.blocks.append((self._stack[-1], text))
            self._open = []

    def _end(self, depth: int) -> None:
        while len(self._stack) > depth:
            self._tags[self._stack.pop().tag] -= 1

    def _element(self, tag: str, closes: bool, attrs: str) -> None:
        if tag == "br":
            self._open.append(" ")
            return
        block = tag in BLOCK
        if not block and tag not in NOISE_TAGS:
            return  # inline markup
        self._flush()
        if closes:
            if not self._tags[tag]:
                return
            for depth in range(len(self._stack) - 1, 0, -1):
                if self._stack[depth].tag == tag:
                    self._end(depth)
                    break
            return
        top = self._stack[-1]
        group = SIBLINGS.get(tag)
        if block and top.tag in CLOSED_BY_BLOCK or group and SIBLINGS.get(top.tag) == group:
            self._end(len(self._stack) - 1)
            top = self._stack[-1]
        found = {a.lower(): b or c or d for a, b, c, d in _ATTR.findall(attrs)} if attrs.strip(" /") else {}
        named = f"{found.get('class', '')} {found.get('id', '')}".strip()
        own_words = {w.lower() for w in _WORD.findall(named)} if named else set()
        main = top.root > 0 or tag in MAIN_TAGS or found.get("role") == "main"
        noise = (
            top.noise
            or tag in NOISE_TAGS
            or tag == "header" and not main
            or bool(own_words & NOISE_WORDS) and tag not in ("html", "body")
            or found.get("role") in NOISE_ROLES
            or "hidden" in found
            or "display:none" in found.get("style", "").replace(" ", "").lower()
        )
        classes = sorted(filter(None, {_DIGITS.sub("", c) for c in found.get("class", "").split()})) if found else ()
        path = top.path if len(self._stack) > DEEPEST else ".".join([f"{top.path}>{tag}", *classes])
        node = Node(tag, path, noise, top.root or len(path) * main)
        top.children.append(tag)
        self.nodes.append(node)
        if tag not in VOID:
            self._stack.append(node)
            self._tags[tag] += 1

    def content(self) -> list[tuple[Node, str]]:
        """The blocks that declare no noise; of a page that declares its main text, those in there."""
        kept = [(n, t) for n, t in self.blocks if not n.noise]
        return [(n, t) for n, t in kept if n.root] or kept


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


_FEATURES = "host string, page bigint, paths array<string>, found array<struct<at:int,style:boolean,feature:bigint>>"


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: a number for its texts, its paths, and the presentations (style) and contents of each, once."""
    found_kind = pa.list_(pa.struct([("at", pa.int32()), ("style", pa.bool_()), ("feature", pa.int64())]))
    schema = pa.schema([("host", pa.string()), ("page", pa.int64()), ("paths", pa.list_(pa.string())), ("found", found_kind)])
    for batch in batches:
        rows = []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            page = Page(source or "")
            blocks = [(n.path, t) for n, t in page.blocks if not n.noise]
            styles = {(n.path, ",".join(dict.fromkeys(n.children))) for n in page.nodes}
            all_found = [(p, True, f) for p, f in styles] + [(p, False, f) for p, f in set(blocks)]
            all_found = [f for f in all_found if not f[0].startswith(">html>head")]
            paths = {p: i for i, p in enumerate(sorted({"", *(f[0] for f in all_found)}))}
            # the empty path's one presentation counts the pages
            found = sorted([(0, True, 0), *((paths[p], style, _number(f)) for p, style, f in all_found)])
            rows.append((host, _number("\n".join(t for _, t in blocks)), list(paths), [dict(zip(("at", "style", "feature"), f, strict=True)) for f in found]))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _host(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))


def style_trees(pages: DataFrame) -> DataFrame:
    """(host, path, pages, importance) of every element path of every site."""
    sites = pages.select(_host().alias("host"), F.col("html").cast("string").alias("html"))
    whole = F.struct("paths", "found")
    distinct = sites.mapInArrow(_features, _FEATURES).groupBy("host", "page").agg(F.min(whole).alias("one"))
    rows = distinct.select("host", "one.paths", F.explode("one.found").alias("f"))
    rows = rows.select("host", F.expr("paths[f.at]").alias("path"), "f.style", "f.feature")
    counts = rows.groupBy("host", "path", "style", "feature").agg(F.count("*").alias("n"))
    # a path's own presentations: share of pages and entropy; its contents: mean entropy over the pages
    own = cut_lineage(
        counts.groupBy("host", "path").agg(
            F.count(F.when(F.col("style"), 1)).alias("styles"),
            F.sum(F.when(F.col("style"), F.col("n"))).alias("styled"),
            F.sum(F.when(F.col("style"), F.col("n") * F.log("n"))).alias("styled_logs"),
            F.count(F.when(~F.col("style"), 1)).alias("contents"),
            F.sum(F.when(~F.col("style"), F.log("n"))).alias("content_logs"),
        )
    )
    per_site = own.where("path = ''").select("host", F.col("styled").alias("pages"))
    # contents count for every branch that they stand in
    steps = F.split("path", ">")
    above = F.transform(F.sequence(F.lit(2), F.greatest(F.size(steps), F.lit(2))), lambda i: F.array_join(F.slice(steps, 1, i), ">"))
    inside = own.where("contents > 0").select("host", F.explode(above).alias("path"), "contents", "content_logs")
    inside = inside.groupBy("host", "path").agg(F.sum("contents").alias("inner"), F.sum("content_logs").alias("inner_logs"))
    log_pages = F.log(F.greatest("pages", F.lit(2)))
    presentation = F.when(F.col("pages") < 2, 1.0).otherwise((F.log("styled") - F.col("styled_logs") / F.col("styled")) / log_pages)
    content = F.when(F.col("pages") < 2, 1.0).otherwise(1 - F.col("inner_logs") / F.col("inner") / log_pages)
    weight = F.pow(F.lit(G), F.col("styles"))
    importance = F.when(F.col("inner").isNull(), presentation).otherwise((1 - weight) * F.coalesce(presentation, F.lit(1.0)) + weight * content)
    found = own.where("path <> ''").join(inside, ["host", "path"], "left").join(per_site, "host")
    return found.select("host", "path", "pages", importance.alias("importance"))


def noisy_branches(pages: DataFrame) -> DataFrame:
    """(host, cut, cut_declared): the branches with contents whose importance is low, per site."""
    low = style_trees(pages).where((F.col("importance") < LEAST) & (F.col("pages") > 1))
    low = low.where("path not in ('>html', '>html>body', '>body')")
    declared = F.when(F.col("importance") < DECLARED * LEAST, F.col("path"))
    return low.groupBy("host").agg(F.collect_list("path").alias("cut"), F.collect_list(declared).alias("cut_declared"))


def _content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks of each page: distinct (path, root), the place of each block's among them, and the texts."""
    for batch in batches:
        paths, roots, at, texts = [], [], [], []
        for source in batch.column(4).to_pylist():
            blocks = Page(source or "").content()
            places: dict[tuple[str, int], int] = {}
            at.append([places.setdefault((n.path, n.root), len(places)) for n, _ in blocks])
            texts.append([t for _, t in blocks])
            paths.append([p for p, _ in places])
            roots.append([r for _, r in places])
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.string())
        made = [pa.array(c, pa.list_(k)) for c, k in zip((paths, roots, at, texts), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *made], names=["page_id", "url", "host", "salt", "paths", "roots", "at", "texts"])


def _is_cut(path: str, root: int, cut: set[str]) -> bool:
    """Whether the path or one above it is among those cut; inside a declared element, only those below it count."""
    end = len(path)
    while end > root:
        if path[:end] in cut:
            return True
        end = path.rfind(">", 0, end)
    return False


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for paths, roots, at, texts, cut, cut_declared in zip(*(batch.column(i).to_pylist() for i in range(2, 8)), strict=True):
            cuts = set(cut or ()), set(cut_declared or ())
            gone = [_is_cut(p, r, cuts[r > 0]) for p, r in zip(paths, roots, strict=True)]
            out.append("\n".join(t for i, t in zip(at, texts, strict=True) if not gone[i]) or "\n".join(texts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumns({"host": _host(), "salt": F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS))})
    kept = rows.select("page_id", "url", "host", "salt", "html").mapInArrow(
        _content, "page_id bigint, url string, host string, salt bigint, paths array<string>, roots array<int>, at array<int>, texts array<string>"
    )
    # a large site is dealt to several tasks; its branches go to each of them
    sites = noisy_branches(pages).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    joined = kept.join(sites, ["host", "salt"], "left").select("page_id", "url", "paths", "roots", "at", "texts", "cut", "cut_declared")
    return joined.mapInArrow(_extract, "page_id bigint, url string, text string, n_chars bigint")
