"""Main text of web pages: site templates and page furniture go, the article's blocks stay.

A page is parsed once, into the blocks of its main part without furniture and the element subtrees that hold them, each as a hash and the
range of its blocks. Spark counts, per host, with how many different bodies each subtree occurs (an article published
twice counts once); subtrees that recur on a good part of a host's pages are its template, and their blocks are deleted. Inside article
elements that asks for a second sign, that the pages around it differ otherwise. The same is counted per section of a host, where the pages that hold
a subtree differ otherwise.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from xxhash import xxh64_intdigest

from ..operators.joins import fits_broadcast, spread_left_join
from ..session import materialize
from .urls import host_of
from .workers import Batches, bounded, map_batches

#: A subtree is template if it occurs with so many bodies of a host, and on such a share of them; inside an article
#: element the share is higher, as near copies of one article share paragraphs.
LEAST_PAGES = 5
LEAST_SHARE = 0.3
LEAST_SHARE_IN_ARTICLE = 0.6
#: What recurs in articles goes if half of the bodies around it have so many times as much text of their own.
OWN_TIMES = 3
#: Sections (first folder of the path) of so many bodies are also counted by themselves, as sub-sites have layouts of their own.
LEAST_IN_SECTION = 10
BROADCAST_HOSTS = 100_000

#: Fixed names of the markup language.
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "textarea", "title", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
FURNITURE = {"nav", "header", "footer", "aside", "head", "button", "select", "dialog", "menu", "label", "fieldset", "input"} | RAW
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
#: Elements that an opening tag of the key ends, if they are open.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDED = set().union(*ENDS.values())
#: Words in a class or id that may mark furniture, and values of a role that do.
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumbs?|sidebar|side|footer|header|masthead|cookies?|consent|gdpr|notices?|popup|modal|overlay|"
    r"newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|widget|comments?|disqus|respond|replies|toolbar|skip|pagination|pager|legal|copyright)(?:$|[\s_-])",
    re.IGNORECASE,
)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "form"}
MAIN_ROLE = {"main", "article"}
#: Class of an article element that is a reader's comment.
COMMENT = re.compile(r"(?:^|\s)comment(?:$|[\s_-])", re.IGNORECASE)
#: How far an element's attributes mark furniture: a class or id word is doubtful, as layout wrappers carry them too.
DOUBTFUL, SURE = 1, 2

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"(?<![a-zA-Z_:-])([a-zA-Z_:-]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_BARE = re.compile(r"(?:^|\s)(hidden)(?:\s|/|$)")
_SPACE = re.compile(r"\s+")
_LONG_REFERENCE = re.compile(r"&#([0-9]{20,})")
_TELLING = re.compile(r"class|id|role|style|hidden", re.IGNORECASE)
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in RAW}


class Node:
    """An element: its tag, how far its name marks furniture, and its parts (texts and elements) in order.

    ``part``: "article" or "main", by tag or role. ``size``: characters outside links and furniture; ``holds``: an article or main element lies in it; ``cut``: it is deleted for a doubtful mark.
    """

    __slots__ = ("tag", "mark", "part", "comment", "parts", "code", "size", "holds", "cut")

    def __init__(self, tag: str, mark: int = 0, role: str = "", comment: bool = False):
        self.tag, self.mark, self.part, self.comment = tag, mark, tag if tag in MAIN_ROLE else role, comment
        self.parts: list[str | Node] = []
        self.code = self.size = 0
        self.holds = self.cut = False


def _attributes(text: str) -> tuple[int, str, bool]:
    """(mark of furniture, role if it is one of the main part, is of class comment) from an element's attributes."""
    if not text or not _TELLING.search(text):
        return 0, "", False
    named = marked = comment = False
    part = ""
    for m in _ATTRIBUTE.finditer(text):
        name, value = m.group(1).lower(), next((g for g in m.groups()[1:] if g is not None), "")
        if name in ("class", "id"):
            named |= bool(MARKED.search(value))
            comment |= name == "class" and bool(COMMENT.search(value))
        elif name == "role":
            marked |= value.strip().lower() in ROLES
            part = role if (role := value.strip().lower()) in MAIN_ROLE else part
        elif name == "style":
            marked |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE))
        elif name == "aria-hidden":
            marked |= value.lower() == "true"
    rest = _ATTRIBUTE.sub(" ", text)
    return SURE if marked or _BARE.search(rest) else DOUBTFUL if named else 0, part, comment


def parse(html: str) -> Node:
    """A tree from any text: unclosed elements end with their parent, stray end tags are skipped, a cut-off tag is markup."""
    root = Node("")
    stack = _Open(root)
    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            stack.top.parts.append(html[at:])
            break
        if m.start() > at:
            stack.top.parts.append(html[at:m.start()])
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            if stack.count.get(tag):
                while stack.pop().tag != tag:
                    pass
            continue
        stack.open(tag, m.group(3))
        if tag in RAW and not m.group(3).endswith("/"):
            # Their content is text up to the end tag, whatever it looks like.
            end = _RAW_END[tag].search(html, at)
            stack.pop()
            at = end.end() if end else n
        elif tag in VOID or m.group(3).endswith("/") and tag not in FURNITURE | INLINE | {"div", "p", "article", "section", "main", "form"}:
            stack.pop()
    return root


class _Open:
    """The open elements. Nothing is looked for that is not there, so that every element is passed once for each time it is closed.

    ``blocks``: depths of the open elements that are not inline; ``bounds``: of those that keep an end inside them.
    """

    BOUNDS = {"ul", "ol", "table", "dl", "select", "article", "div", "body"}

    def __init__(self, root: Node):
        self.nodes, self.count = [root], {}
        self.blocks, self.bounds, self.ended = [], [], []

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def pop(self) -> Node:
        node = self.nodes.pop()
        depth = len(self.nodes)
        self.count[node.tag] -= 1
        for depths in (self.blocks, self.bounds, self.ended):
            if depths and depths[-1] == depth:
                depths.pop()
        return node

    def close_to(self, depth: int) -> None:
        while len(self.nodes) > depth:
            self.pop()

    def open(self, tag: str, attributes: str) -> None:
        if tag not in INLINE and self.blocks and self.nodes[self.blocks[-1]].tag == "p":
            # A block ends the open paragraph, with what is open inside it.
            self.close_to(self.blocks[-1])
        ends = ENDS.get(tag)
        if ends:
            bound = self.bounds[-1] if self.bounds else 0
            for depth in reversed(self.ended):
                if depth <= bound:
                    break
                if self.nodes[depth].tag in ends:
                    self.close_to(depth)
                    break
        node, depth = Node(tag, *_attributes(attributes)), len(self.nodes)
        self.top.parts.append(node)
        self.nodes.append(node)
        self.count[tag] = self.count.get(tag, 0) + 1
        if tag not in INLINE:
            self.blocks.append(depth)
        if tag in self.BOUNDS:
            self.bounds.append(depth)
        if tag in ENDED:
            self.ended.append(depth)


def is_furniture(node: Node) -> bool:
    return node.cut or not node.part and (node.tag in FURNITURE or node.mark == SURE and not _exempt(node))


def _exempt(node: Node) -> bool:
    return bool(node.part) or node.tag in ("html", "body")


def _doubtful(node: Node) -> bool:
    return (node.mark == DOUBTFUL or node.tag == "form") and not _exempt(node)


def _inside(tops: list[Node]) -> list[Node]:
    """The elements of the subtrees, each before what it holds. Furniture is not entered."""
    order, todo = [], list(reversed(tops))
    while todo:
        node = todo.pop()
        order.append(node)
        if not is_furniture(node):
            todo += [p for p in reversed(node.parts) if isinstance(p, Node)]
    return order


def weigh(root: Node) -> None:
    """Sets ``size`` and ``holds``."""
    for node in reversed(_inside([root])):
        if is_furniture(node):
            continue
        below = [p for p in node.parts if isinstance(p, Node)]
        if node.tag == "a":  # of a link only blocks count, which are in it if it was never closed
            node.size = sum(p.size for p in below if p.tag not in INLINE)
        else:
            node.size = sum(p.size for p in below) + sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        node.holds = any(p.holds or p.part and not (p.part == "article" and p.comment) for p in below if not is_furniture(p))


def hash_subtrees(tops: list[Node]) -> None:
    """Sets ``code`` of every element outside furniture: a 62-bit hash of its tags and texts, white space apart."""
    for node in reversed(_inside(tops)):
        held = [node.tag.encode()]
        for part in node.parts:
            held.append(part.code.to_bytes(8, "little") if isinstance(part, Node) else b" ".join(part.encode().split()))
        node.code = xxh64_intdigest(b"\0".join(held)) >> 2


def _body(root: Node) -> list[Node]:
    """The outermost article elements, else main elements, else the whole page. Furniture is not searched, doubtful wrappers are.

    An element of role article stands with the articles, but only article elements displace a main element around them. Articles
    in doubtful wrappers may be teasers: alone they are the main part only if they hold half of the page or more.
    """
    articles, outermost, firm = [], [], []
    todo, plain = [(root, False, False)], False
    while todo:
        node, wrapped, in_main = todo.pop()
        if is_furniture(node) or wrapped and node.part == "article" and node.comment:
            continue
        if node.part:
            if not in_main:
                outermost.append(node)
                if node.part == "main" or not wrapped:
                    firm.append(node)
            if node.part == "article":
                plain |= node.tag == "article" and not wrapped
                articles.append(node)
                continue
            in_main = True
        wrapped |= _doubtful(node)
        todo += [(p, wrapped, in_main) for p in reversed(node.parts) if isinstance(p, Node)]
    if plain:
        return articles
    if firm and 2 * sum(n.size for n in firm) >= root.size:
        return firm
    return outermost if firm or outermost and 2 * sum(n.size for n in outermost) >= root.size else [root]


def judge(tops: list[Node]) -> None:
    """Sets ``cut`` of the elements in the main part that a doubtful mark deletes.

    It does not delete what holds an article or main element, or more than half of the main part; and if less than half
    were left, it deletes nothing: what recurs then goes by the count over the host's pages.
    """
    whole = sum(t.size for t in tops)
    cut, todo = [], [(t, t, t.part == "article") for t in tops]
    while todo:
        node, top, in_article = todo.pop()
        if is_furniture(node) and node is not top:
            continue
        if node is not top and _doubtful(node) and not (node.holds and not in_article or 2 * node.size > whole):
            cut.append(node)
            continue
        in_article |= node.part == "article"
        todo += [(p, top, in_article) for p in node.parts if isinstance(p, Node)]
    if 2 * sum(node.size for node in cut) <= whole:
        for node in cut:
            node.cut = True


Part = tuple[list[str], list[tuple[int, int, int]]]


def main_part(html: str) -> Part:
    """The blocks of the main part without furniture, in page order, and the subtrees that hold them: (hash, first block, block behind the last).

    The last bit of a subtree's hash says whether it lies in an article element. Time and memory follow the length of the page,
    however deep it is.
    """
    root = parse(html)
    weigh(root)
    tops = _body(root)
    judge(tops)
    hash_subtrees(tops)
    out: list[str] = []
    spans: list[tuple[int, int, int]] = []
    line: list[str] = []
    around: list[tuple[int, int, bool]] = []  # of the open elements: hash, first block, whether in an article element

    def close() -> None:
        # References of thousands of digits name no character either.
        text = _LONG_REFERENCE.sub(lambda m: f"&#{m[1].lstrip('0')[:20] or 0}", "".join(line))
        text = _SPACE.sub(" ", unescape(text)).strip()
        line.clear()
        if text:
            out.append(text)

    for top in tops:
        todo: list[Node | str | None] = [top]
        while todo:
            part = todo.pop()
            if part is None:
                close()
                code, first, _ = around.pop()
                if code >= 0 and first < len(out):
                    spans.append((code, first, len(out)))
            elif isinstance(part, str):
                line.append(part)
            elif part is not top and is_furniture(part):
                if part.tag not in INLINE:
                    close()
            elif part.tag == "br":
                line.append(" ")
            elif part.tag in INLINE:
                todo += reversed(part.parts)
            else:
                close()
                todo.append(None)
                in_article = part.part == "article" or bool(around and around[-1][2])
                # The main part as a whole, and what holds it, is no template.
                code = part.code << 1 | in_article if part is not top and part.tag not in ("html", "body") else -1
                around.append((code, len(out), in_article))
                todo += reversed(part.parts)
        close()
    return out, spans


def blocks(html: str) -> list[tuple[str, list[int]]]:
    """The blocks of :func:`main_part`, each with the hashes of the subtrees that hold it, from the outermost in."""
    texts, spans = main_part(html)
    held: list[list[int]] = [[] for _ in texts]
    for code, first, end in reversed(spans):
        for at in range(first, end):
            held[at].append(code)
    return list(zip(texts, held))


def _codes(spans: Column) -> Column:
    return F.array_distinct(F.transform(spans, lambda s: s["code"]))


def _left(texts: Column, spans: Column, gone: Column) -> Column:
    """The texts without those in subtrees of ``gone``."""
    cut = F.filter(spans, lambda s: F.array_contains(gone, s["code"]))
    inside = lambda i: F.exists(cut, lambda s: (s["first"] <= i) & (i < s["end"]))
    return F.when(F.size(cut) == 0, texts).otherwise(F.filter(texts, lambda _, i: ~inside(i)))


def _length(texts: Column) -> Column:
    return F.aggregate(texts, F.lit(0).cast("long"), lambda n, t: n + F.length(t))


def templates(pages: DataFrame) -> DataFrame:
    """(_host, template): hashes of the subtrees that recur across a host's pages. ``pages``: _host, _texts, _spans.

    Each task counts its own pages before anything moves, so a host with a third of all pages is no heavier than others.
    Near copies of one article share paragraphs: what recurs inside articles must be a small part of the pages that hold it.
    """
    codes = _codes(F.col("_spans"))
    seen = pages.select("_host", F.xxhash64("_texts").alias("body"), F.explode(F.concat(F.array(F.lit(-1).cast("bigint")), codes)).alias("code"))
    counts = seen.distinct().groupBy("_host", "code").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= LEAST_PAGES)
    counts = materialize(counts, "subtrees")
    hosts = counts.filter("code = -1").select("_host", F.col("c").alias("pages"))
    share = F.when(F.col("code") % 2 == 1, LEAST_SHARE_IN_ARTICLE).otherwise(LEAST_SHARE)
    often = counts.filter("code <> -1").join(hosts, "_host").filter(F.col("c") >= share * F.col("pages"))
    often = materialize(often.select("_host", "code", "c"), "often")
    inside = F.col("code") % 2 == 1
    per_host = often.groupBy("_host").agg(F.collect_list("code").alias("often"), F.collect_list(F.when(inside, F.col("code"))).alias("inside"))
    per_host = materialize(per_host.filter(F.size("inside") > 0), "often")
    if not per_host.isEmpty():
        rows = pages.join(_few(per_host), "_host").withColumn("codes", F.array_intersect(codes, "inside")).filter(F.size("codes") > 0)
        whole, own = _length(F.col("_texts")), _length(_left(F.col("_texts"), F.col("_spans"), F.col("often")))
        recurs = whole - _length(_left(F.col("_texts"), F.col("_spans"), F.col("inside")))
        differ = rows.filter(own >= OWN_TIMES * recurs).select("_host", F.xxhash64("_texts").alias("body"), F.explode("codes").alias("code"))
        held = differ.distinct().groupBy("_host", "code").agg(F.count(F.lit(1)).alias("d"))
        kept = often.filter(inside).join(held, ["_host", "code"]).filter(2 * F.col("d") >= F.col("c"))
        often = often.filter(~inside).select("_host", "code").unionByName(kept.select("_host", "code"))
    return often.groupBy("_host").agg(F.collect_list("code").alias("template"))


def _few(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if fits_broadcast(keys, BROADCAST_HOSTS) else keys


def section_templates(pages: DataFrame, found: DataFrame) -> DataFrame | None:
    """(_host, _section, section_template) like ``templates``, of what the templates ``found`` leave; None if there is nothing.

    Near copies of one page share most of their text: a subtree counts only if at least half of the bodies around it have as
    much text of their own as text that recurs.
    """
    key = ["_host", "_section"]
    sizes = pages.groupBy(*key).agg(F.count(F.lit(1)).alias("c"))
    sizes = materialize(sizes, "sizes")
    mixed = sizes.join(sizes.groupBy("_host").agg(F.sum("c").alias("all")), "_host").filter((F.col("c") >= LEAST_IN_SECTION) & (F.col("c") < F.col("all")))
    mixed = materialize(mixed.select(*key), "sections")
    if mixed.isEmpty():
        return None
    none = F.array().cast("array<bigint>")
    rows = pages.join(_few(mixed), key, "left_semi").join(_few(found), "_host", "left")
    # Subtrees all of whose blocks the templates take are no longer there.
    gone = F.coalesce("template", none)
    cut = F.filter("_spans", lambda s: F.array_contains(F.col("gone"), s["code"]))
    rows = rows.withColumn("gone", gone).withColumn("cut", cut)
    still = F.filter("_spans", lambda s: ~F.exists("cut", lambda t: (t["first"] <= s["first"]) & (s["end"] <= t["end"])))
    rows = rows.select(*key, F.xxhash64("_texts").alias("body"), "_texts", "_spans", "gone", still.alias("still"))
    codes = _codes(F.col("still"))
    seen = rows.select(*key, "body", F.explode(F.concat(F.array(F.lit(-1).cast("bigint")), codes)).alias("code"))
    counts = materialize(seen.distinct().groupBy(*key, "code").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= LEAST_IN_SECTION), "subtrees")
    share = F.when(F.col("code") % 2 == 1, LEAST_SHARE_IN_ARTICLE).otherwise(LEAST_SHARE)
    whole = counts.filter("code = -1").select(*key, F.col("c").alias("pages"))
    often = counts.filter("code <> -1").join(whole, key).filter(F.col("c") >= share * F.col("pages"))
    often = materialize(often.groupBy(*key).agg(F.collect_list("code").alias("often")), "often")
    if often.isEmpty():
        return None
    left = _length(_left(F.col("_texts"), F.col("_spans"), F.col("gone")))
    own = _length(_left(F.col("_texts"), F.col("_spans"), F.concat("gone", "often")))
    differ = rows.join(_few(often), key).filter(own >= left - own)
    held = differ.select(*key, "body", F.explode(F.array_intersect(codes, "often")).alias("code")).distinct().groupBy(*key, "code").agg(F.count(F.lit(1)).alias("d"))
    good = held.join(counts, [*key, "code"]).filter(2 * F.col("d") >= F.col("c"))
    return materialize(good.groupBy(*key).agg(F.collect_list("code").alias("section_template")), "templates")


def extract(pages: DataFrame, keep: list[str], html: str = "html", url: str = "url") -> DataFrame:
    """Columns ``keep`` of every row plus ``_text``: the blocks that are no template, joined by an empty line.

    Null and empty pages, and pages of nothing but furniture, give an empty text. Pages without a host count as one host of
    their own, of empty name. Repeated rows are equal pages and give equal texts.
    """
    rows = pages.select(
        F.struct(*[F.col(f"`{k}`") for k in keep]).alias("_row"), host_of(F.col(f"`{url}`")).alias("_host"),
        F.xxhash64(F.regexp_extract(F.col(f"`{url}`"), r"^[^/?#]*//[^/?#]*/([^/?#]+)/", 1)).alias("_section"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("_html"),
    )
    kind = T.ArrayType(T.StructType([T.StructField("code", T.LongType()), T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([
        rows.schema["_row"], T.StructField("_host", T.StringType()), T.StructField("_section", T.LongType()),
        T.StructField("_texts", T.ArrayType(T.StringType())), T.StructField("_spans", kind),
    ])

    def run(batches: Batches) -> Batches:
        for whole in batches:
            for batch in bounded(whole, "_html"):
                found = [main_part(h) for h in batch["_html"].to_pylist()]
                spans = np.array([s for _, held in found for s in held], np.int64).reshape(-1, 3)
                held = pa.StructArray.from_arrays(
                    [pa.array(spans[:, 0]), pa.array(spans[:, 1].astype(np.int32)), pa.array(spans[:, 2].astype(np.int32))], ["code", "first", "end"]
                )
                offsets = pa.array(np.concatenate(([0], np.cumsum([len(held) for _, held in found]))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch["_row"], batch["_host"], batch["_section"], pa.array([t for t, _ in found], pa.list_(pa.string())), pa.ListArray.from_arrays(offsets, held)],
                    names=["_row", "_host", "_section", "_texts", "_spans"],
                )

    parsed = materialize(map_batches(rows, run, schema), "blocks")
    found = materialize(templates(parsed), "templates")
    if fits_broadcast(found, BROADCAST_HOSTS):
        joined = parsed.join(F.broadcast(found), "_host", "left")
    else:
        joined = spread_left_join(parsed, found, ["_host"], ["_row"], counted=parsed)
    none = F.array().cast("array<bigint>")
    template = F.coalesce("template", none)
    sections = section_templates(parsed, found)
    if sections is not None:
        if fits_broadcast(sections, BROADCAST_HOSTS):
            joined = joined.join(F.broadcast(sections), ["_host", "_section"], "left")
        else:
            joined = spread_left_join(joined, sections, ["_host", "_section"], ["_row"], counted=parsed)
        template = F.concat(template, F.coalesce("section_template", none))
    joined = joined.withColumn("_gone", template)
    text = F.array_join(_left(F.col("_texts"), F.col("_spans"), F.col("_gone")), "\n\n")
    return joined.select(*[F.col(f"_row.`{k}`").alias(k) for k in keep], text.alias("_text"))


def digest(pages: DataFrame) -> DataFrame:
    """The columns of query op4."""
    return extract(pages, ["page_id", "url"]).select("page_id", "url", F.col("_text").alias("text"), F.length("_text").cast("bigint").alias("n_chars"))
