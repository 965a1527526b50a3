"""Main text of web pages by wrapper induction.

Pages of one host are aligned with a reference page of that host by simple tree matching of their block trees. Over all contents of the
host, a node of the reference whose text is the same on most pages that have it is constant, so it belongs to the template; nodes
whose text varies are slots. The wrapper's content region is induced from the slots: from the root, the path goes down as long as
one inner node holds most of the host's varying text (REGION) and doesn't leave a varying first-level headline behind. Content is
what varies inside the region; blocks that only some pages have belong to their nearest aligned ancestor. Element names, roles
and classes only rule out, inside the region, what varies but isn't main text (adverts, forms, comments and so on). They decide alone where
nothing can be induced: on a host with fewer than LEAST_PAGES different contents, without a region, or for a page that has nothing in it;
there, where a page has an article (or main) element, what is outside it is not content. A header inside an article is the article's own.

Pages count once for each content, the texts that names allow in order: copies of a page, whatever adverts or menus they show, make none
of its text constant. Counts are made over all contents of a host, pre-aggregated, so a host with a third of all pages is no task's
burden; only the reference page (one of the host's, by hash) and the region are sent to the host's pages.

Matching is optimal for pages of any size, by one rule: subtrees of equal shape are matched once, and wide nodes are aligned row by row with
numpy, in memory of about the root of the pairs. Time grows with the pairs of children. Trees of any depth are walked with stacks of their own.

Defined results: null or empty html gives an empty text; text outside any tag is a block; unclosed and stray tags are tolerated; a quote
that is never closed is no quote; a null url is a host of its own; repeated rows are extracted alike; an empty table gives an empty
result; other columns, whatever their names, are left alone.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import bounded, free, written

LEAST_PAGES = 4
CONSTANT = 0.5
REGION = 0.7  # of a host's varying text
FEW_CELLS = 400  # pairs of children that plain Python aligns faster than numpy; the alignment is the same
#: Elements that never hold main text.
DROPPED = {"nav", "header", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "svg", "button", "select", "head", "dialog", "menu", "object", "canvas"}
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "title"}
MAIN = ("article", "main")
CLOSES_P = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "div", "table", "section", "article", "aside", "nav", "footer", "header", "form", "blockquote", "pre"}
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th")}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
NAMED = re.compile(r"(?:^|[\s_-])(?:nav(?:bar|igation)?|menu|breadcrumbs?|(?:page|site|top)[_-]header|footer|masthead|side-?bar|rail|ads?|advert(?:s|isement)?|sponsor(?:ed)?|promo|banner|cookies?|consent|gdpr|notice|popup|modal|newsletter|subscribe|share|social|related|recommended|comments?|replies|disqus|respond|login|search|tags?|pagination|pager|skip)(?:$|[\s_-])", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
OPENING = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
TAG_END = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("children", "dropped", "last", "number", "parent", "tag")

    def __init__(self, tag: str, dropped: bool, parent: Node | None = None):
        self.tag, self.dropped, self.parent, self.children, self.number, self.last = tag, dropped, parent, [], -1, -1


def tags(page: str) -> Iterator[tuple[int, int, bool, str | None, str]]:
    """(start, end, closing, name, attributes) of tags, and of comments and declarations (name None). Linear in the page."""
    at, quotes = 0, True
    while m := OPENING.search(page, at):
        start = m.start()
        if m[1] or m[2]:
            end = page.find("-->" if m[1] else ">", m.end())
            if end < 0 and m[2]:
                at = m.end()
                if page.find(">", at) < 0:
                    return
                continue
            at = len(page) if end < 0 else end + (3 if m[1] else 1)
            yield start, at, False, None, ""
            continue
        end = m.end()
        while quotes:
            x = TAG_END.search(page, end)
            if x is None or x[0] == ">":
                end = x.start() if x else -1
                break
            end = page.find(x[0], x.end()) + 1
            if not end:
                break
        if not quotes or end <= 0:  # no end outside quotes: from here on quotes are characters like others
            quotes = False
            end = page.find(">", m.end())
            if end < 0:
                return
        at = end + 1
        yield start, at, bool(m[3]), m[4].lower(), page[m.end() : end]


def is_dropped(tag: str, attributes: str, inside: bool = False) -> bool:
    """Whether names rule an element out; inside an article (or main) a header is content."""
    if tag in DROPPED and not (tag == "header" and inside):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value.lower() in ROLES) or (name in ("class", "id") and NAMED.search(value)):
            return True
    return False


def parse(page: str, names: bool = True) -> tuple[Node, list[tuple[Node, str]]]:
    """The tree of block elements and the page's text blocks in order, each with its element. Without names, no element is ruled out by its name."""
    root = Node("#", False)
    stack = [(root, "#")]
    blocks: list[tuple[Node, str]] = []
    buffer: list[str] = []
    opened: Counter[str] = Counter()
    mains = 0  # article and main elements that are open

    def close(at: int) -> None:
        nonlocal mains
        for _, t in stack[at:]:
            opened[t] -= 1
            mains -= t in MAIN
        del stack[at:]

    def flush() -> None:
        if buffer:
            text = SPACE.sub(" ", entities.unescape("".join(buffer))).strip()
            buffer.clear()
            if text:
                blocks.append((stack[-1][0], text))

    at = 0
    for start, end, closing, tag, attributes in tags(page):
        if start < at:
            continue  # inside a raw element
        if start > at:
            buffer.append(page[at:start])
        at = end
        if tag is None:
            continue
        if closing:
            if tag in BLOCK:
                flush()
            if opened[tag]:
                i = len(stack) - 1
                while stack[i][1] != tag:
                    i -= 1
                if stack[-1][0] is not stack[i - 1][0]:
                    flush()
                close(i)
            continue
        if tag in RAW:
            closed = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = closed.end() if closed else len(page)
            continue
        if tag == "br" or tag in VOID:
            buffer.append(" ")
            continue
        block = tag in BLOCK
        if block:
            flush()
            if tag in CLOSES_P and opened["p"]:
                # An open paragraph, with what stands open in it, ends where a block begins.
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][1] == "p":
                        close(i)
                        break
                    if stack[i][1] in BLOCK:
                        break
            elif tag in SIBLINGS and any(opened[t] for t in SIBLINGS[tag]):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][1] in SIBLINGS[tag]:
                        close(i)
                        break
                    if stack[i][1] in ("ul", "ol", "dl", "table"):
                        break
        parent = stack[-1][0]
        if attributes.endswith("/"):
            continue
        dropped = parent.dropped or (names and is_dropped(tag, attributes, mains > 0))
        opened[tag] += 1
        mains += tag in MAIN
        if block or (dropped and not parent.dropped):
            flush()
            node = Node(tag, dropped, parent)
            parent.children.append(node)
            stack.append((node, tag))
        else:
            stack.append((parent, tag))
    if at < len(page):
        buffer.append(page[at:])
    flush()
    return root, blocks


def numbered(root: Node) -> list[Node]:
    """All nodes in page order, each with its number and that of the last node below it."""
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        n.number = n.last = len(out)
        out.append(n)
        todo += reversed(n.children)
    for n in reversed(out):
        if n.parent:
            n.parent.last = max(n.parent.last, n.last)
    return out


class Matching:
    """Simple tree matching of two trees: the largest number of node pairs of a top-down, order-keeping alignment. What two subtrees match depends on
    their shapes (tags and order) alone, so it is computed once for two shapes. Of best alignments, the one that matches the earliest is taken."""

    def __init__(self):
        self.shapes: dict[tuple, int] = {}
        self.nodes: list[int] = []  # of each shape, how many nodes it has
        self.found: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def shaped(self, root: Node) -> dict[Node, int]:
        """The shape of each node of a tree."""
        order, out = [root], {}
        for n in order:
            order += n.children
        for n in reversed(order):
            key = (n.tag, *[out[c] for c in n.children])
            if key not in self.shapes:
                self.shapes[key] = len(self.shapes)
                self.nodes.append(1 + sum(self.nodes[x] for x in key[1:]))
            out[n] = self.shapes[key]
        return out

    def pair(self, root: Node, other: Node, mine: dict[Node, int], its: dict[Node, int]) -> None:
        """Fills found for root and other and whatever their best alignment looks at, if their shapes differ."""
        todo = [(root, other, False)]
        while todo:
            a, b, ready = todo.pop()
            key = mine[a], its[b]
            if a.tag != b.tag or key[0] == key[1] or key in self.found:
                continue
            x, y, lead = a.children, b.children, 0
            # In some best alignment, first children of equal shape match.
            while lead < min(len(x), len(y)) and mine[x[lead]] == its[y[lead]]:
                lead += 1
            tags_x, tags_y = {mine[p]: p for p in x[lead:]}, {its[q]: q for q in y[lead:]}
            if not ready:
                todo.append((a, b, True))
                todo += [(p, q, False) for p in tags_x.values() for q in tags_y.values() if p.tag == q.tag]
                continue
            names = {**{s: p.tag for s, p in tags_x.items()}, **{s: q.tag for s, q in tags_y.items()}}
            best = self.best([mine[p] for p in x[lead:]], [its[q] for q in y[lead:]], names)
            pairs = [*((i, i) for i in range(lead)), *((lead + i, lead + j) for i, j in best)]
            self.found[key] = 1 + sum(self.size(mine[x[i]], its[y[j]]) for i, j in pairs), pairs

    def size(self, s: int, t: int) -> int:
        """How many nodes match, of two shapes of one tag."""
        return self.nodes[s] if s == t else self.found[s, t][0]

    def best(self, x: list[int], y: list[int], names: dict[int, str]) -> list[tuple[int, int]]:
        """The best alignment of two lists of shapes."""
        n, m = len(x), len(y)
        if not n or not m:
            return []
        classes = {t: j for j, t in enumerate(dict.fromkeys(y))}
        of = np.array([classes[t] for t in y])
        rows: dict[int, np.ndarray] = {}

        def sizes(i: int) -> np.ndarray:
            s = x[i]
            if s not in rows:
                rows[s] = np.array([self.size(s, t) if names[s] == names[t] else 0 for t in classes], np.int64)
            return rows[s][of]

        def above(i: int, below: np.ndarray) -> np.ndarray:
            """Row i of the table, from row i + 1: what children from i and from j on match at most."""
            out = np.zeros(m + 1, np.int64)
            out[:m] = np.maximum.accumulate(np.maximum(below[:-1], below[1:] + sizes(i))[::-1])[::-1]
            return out

        def plain(i: int, below: list[int]) -> list[int]:
            out, here = [0] * (m + 1), sizes(i).tolist()
            for j in range(m - 1, -1, -1):
                out[j] = max(below[j], out[j + 1], below[j + 1] + here[j])
            return out

        few = n * m <= FEW_CELLS
        step = plain if few else above
        # Every block-th row is kept; the others are made again where the way leads through them.
        block = max(1, int(n**0.5))
        row, kept = [0] * (m + 1) if few else np.zeros(m + 1, np.int64), {}
        kept[n] = row
        for i in range(n - 1, -1, -1):
            row = step(i, row)
            if i % block == 0:
                kept[i] = row
        out, i, j = [], 0, 0
        while i < n and j < m:
            end = min(n, i - i % block + block)
            table = {end: kept[end]}
            for r in range(end - 1, i - 1, -1):
                table[r] = step(r, table[r + 1])
            while i < end and j < m:
                here = int(rows[x[i]][of[j]])
                if here and table[i][j] == table[i + 1][j + 1] + here:
                    out.append((i, j))
                    i, j = i + 1, j + 1
                elif table[i][j] == table[i + 1][j]:
                    i += 1
                else:
                    j += 1
        return out


def aligned(root: Node, reference: Node) -> dict[int, int]:
    """For each of root's nodes that is matched, the number of the reference's node."""
    m = Matching()
    mine, its = m.shaped(root), m.shaped(reference)
    m.pair(root, reference, mine, its)
    out, todo = {}, [(root, reference)]
    while todo:
        a, b = todo.pop()
        if a.tag == b.tag:
            out[a.number] = b.number
            if mine[a] == its[b]:
                todo += zip(a.children, b.children, strict=True)
            else:
                todo += [(a.children[i], b.children[j]) for i, j in m.found[mine[a], its[b]][1]]
    return out


def slots(page: str, reference: Node | None, names: bool = True) -> list[tuple[str, int, int, bool, bool]]:
    """The page's text blocks in order: text, number of the reference's node (-1: none), that of the nearest aligned ancestor, whether names
    allow it, and whether it is in an article or main element where the page has one."""
    root, blocks = parse(page, names)
    nodes = numbered(root)
    to = aligned(root, reference) if reference else {}
    anchor: list[int] = []
    for n in nodes:  # parents come first
        anchor.append(to.get(n.number, anchor[n.parent.number] if n.parent else -1))
    main = [n for n in nodes if n.tag in MAIN and not n.dropped] if names else []
    inside = set()
    for n in main:
        if n.number not in inside:
            inside.update(range(n.number, n.last + 1))
    return [(text, to.get(n.number, -1), anchor[n.number], not n.dropped, not main or n.number in inside) for n, text in blocks]


def region(reference: Node, varying: dict[int, int], names: bool = True) -> tuple[int, int] | None:
    """The content region, as its first and last node of the reference, from the lengths of varying text at its (numbered) nodes."""
    nodes = numbered(reference)
    held = [varying.get(n.number, 0) for n in nodes]
    headline = [n.tag == "h1" and held[n.number] > 0 for n in nodes]
    for n in reversed(nodes):
        if n.parent:
            held[n.parent.number] += held[n.number]
            headline[n.parent.number] |= headline[n.number]
    at = reference
    while not (names and at.tag in MAIN):
        down = [c for c in at.children if c.children and held[c.number] >= REGION * held[0] > 0]
        if not down or any(headline[c.number] for c in at.children if c is not down[0]):
            break
        at = down[0]
    return None if at.tag in ("#", "html", "body") else (at.number, at.last)


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


SLOTS = "array<struct<text:string,node:int,anchor:int,hash:long,allowed:boolean,inside:boolean>>"


def _read(names: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees: dict[str, Node] = {}
        for b in batches:
            rows = []
            for page, host, ref in zip(b["html"], b["host"], b["reference"], strict=True):
                if ref and host not in trees:
                    if len(trees) > 200:
                        trees.clear()
                    trees[host] = parse(ref, names)[0]
                    numbered(trees[host])
                found = slots(page, trees[host] if ref else None, names)
                rows.append([{"text": t, "node": n, "anchor": a, "hash": digest(t), "allowed": ok, "inside": main} for t, n, a, ok, main in found])
            yield pd.DataFrame({"id": b["id"], "host": b["host"], "slots": rows})

    return run


def _regions(names: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for host, ref, varying in zip(b["host"], b["reference"], b["varying"], strict=True):
                found = region(parse(ref, names)[0], {int(v["anchor"]): int(v["n"]) for v in varying}, names)
                if found:
                    rows.append((host, *found))
            yield pd.DataFrame(rows, columns=["host", "first", "last"])

    return run


def host_of(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def extracted(pages: DataFrame, html: str = "html", url: str = "url", names: bool = True) -> DataFrame:
    """pages (without html) with __text. Without names the wrapper alone decides, and hosts that have none keep all text."""
    carried = [c for c in pages.columns if c != html]
    x = pages.select(F.struct(*[F.col(f"`{c}`") for c in carried]).alias("id"), host_of(url).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    hosts = x.groupBy("host").agg(F.count("*").alias("n_pages"), F.min(F.struct(F.xxhash64("html").alias("h"), "html"))["html"].alias("reference"))
    hosts = written(hosts.withColumn("reference", F.when(F.col("n_pages") >= LEAST_PAGES, F.col("reference"))), "pages-hosts")
    read = x.join(bounded(hosts, 64_000_000), "host").select("id", "host", "html", "reference").mapInPandas(_read(names), f"id {x.schema['id'].dataType.simpleString()}, host string, slots {SLOTS}")
    read = written(read, "pages-slots")
    # In how many different contents of a host each text stands at each node of its reference.
    content = F.xxhash64(F.transform(F.filter("slots", lambda s: s["allowed"] & s["inside"]), lambda s: s["hash"]))
    contents = read.select("host", content.alias("content")).distinct().groupBy("host").agg(F.count("*").alias("n_pages"))
    contents = written(contents.where(F.col("n_pages") >= LEAST_PAGES), "pages-contents")
    texts = read.select("host", content.alias("content"), F.explode(F.array_distinct(F.transform("slots", lambda s: F.struct(s["node"].alias("node"), s["hash"].alias("hash"))))).alias("s")).where("s.node >= 0")
    counts = texts.select("host", "content", "s.node", "s.hash").distinct().groupBy("host", "node", "hash").agg(F.count("*").alias("n")).where("n > 1")
    constant = counts.join(bounded(contents), "host").where(F.col("n") > CONSTANT * F.col("n_pages"))
    template = written(constant.groupBy("host").agg(F.collect_set(F.struct("node", "hash")).alias("template")), "pages-template")  # at most two texts a node
    fixed = read.join(bounded(template), "host", "left").withColumn("template", F.coalesce("template", F.array().cast("array<struct<node:int,hash:bigint>>")))
    varies = lambda s: ~F.array_contains(F.col("template"), F.struct(s["node"].alias("node"), s["hash"].alias("hash")))
    # How much text varies at each node of the reference.
    lengths = fixed.join(bounded(contents.select("host")), "host", "left_semi").select("host", F.explode(F.transform(F.filter("slots", varies), lambda s: F.struct(s["anchor"].alias("anchor"), F.length(s["text"]).alias("n")))).alias("v"))
    lengths = lengths.groupBy("host", "v.anchor").agg(F.sum("v.n").alias("n")).groupBy("host").agg(F.collect_list(F.struct("anchor", "n")).alias("varying"))
    regions = written(hosts.where("reference is not null").join(lengths, "host").select("host", "reference", "varying").mapInPandas(_regions(names), "host string, first int, last int"), "pages-regions")
    here = lambda s: s["allowed"] & F.col("first").isNotNull() & s["anchor"].between(F.col("first"), F.col("last"))
    found = fixed.join(bounded(regions), "host", "left").withColumn("induced", F.exists("slots", here))
    main = F.filter("slots", lambda s: F.when(F.col("induced"), here(s)).otherwise(s["allowed"] & s["inside"]) & varies(s))
    return found.select("id.*", F.array_join(F.transform(main, lambda s: s["text"]), "\n\n").alias(free("text", pages)))


def op4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = extracted(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return x.select("page_id", "url", F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars"))
