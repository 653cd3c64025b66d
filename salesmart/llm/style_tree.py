"""Main-text extraction with a site style tree.

The pages of one host are merged element by element: a node of the tree is the chain of
element names (with their classes and roles) from the root. Over all pages of the host that
show a node it gathers two things, each as plain grouped counts, so that no host meets in
one task:

* presentation: in how many pages each sequence of child elements occurs; its entropy (base:
  number of pages) is high where pages are built freely, low where a template repeats;
* content: in how many pages each text found below the node occurs; a text's entropy is that
  of its spread over the pages, and the node's content importance is one less their mean.

The importance of a node mixes both, presentation weighing more the more children a node
has. The published form weighs recursively over the children; here content is summed over
the whole branch, which needs no recursion. Elements whose names or classes say what they
are (navigation, forms, adverts, comments) are noise whatever the counts say; names on the
page's body or on what holds all its articles never are, and names that only hold such a word
among others are left to the counts. Any other branch
whose importance stays below the threshold is removed from its page, inside ``article`` and
``main`` below a stricter one and on more pages: their texts may well be copies of one another.
"""

from __future__ import annotations

import functools
import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.session import materialize

# Element names and class words of HTML, by what they mean.
NOISE_TAGS = frozenset(
    "head title script style noscript template svg canvas iframe object embed audio video map nav header footer "
    "aside menu form button select textarea input option dialog".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe template".split())
MAIN_TAGS = frozenset("article main".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo cookie cookies consent notice notices nav "
    "navbar navigation menu breadcrumb breadcrumbs sidebar aside header footer comment comments reply replies "
    "respond form search login signup subscribe newsletter popup modal share sharing social related widget "
    "toolbar pagination pager copyright".split())
# Before a noise word these say how an element looks or what it has, not what it is: has-sidebar, fixed-header.
STATE_WORDS = frozenset("has have with without no not non is fixed sticky show hide hidden open".split())
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form menu menubar alert dialog alertdialog".split())
INLINE_TAGS = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What an opening tag closes by itself, and where the search for it ends.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"']++)*+)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][^\s=/>]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")
MATTERS = re.compile(r"\b(?:class|id|role)\s*=", re.I)
GAMMA = 0.9
DEEPEST = 256  # elements nested deeper become siblings, as in browsers


@dataclass
class Node:
    """An element: its text pieces and children in page order; ``path`` is the hash of its chain of names."""

    tag: str
    path: int
    says: tuple[bool, bool, bool, str]  # noise by tag, by attributes, named header; and main, article or nothing
    parent: "Node | None"
    depth: int
    items: list = field(default_factory=list)
    kind: str = "open"  # noise, main, article or open


def _hash(text: str) -> int:
    digest = hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _names_noise(name: str) -> bool:
    """Whether a class or id says noise, as a whole or by its last part; a header needs more than the word."""
    parts = [w for w in re.split(r"[-_\d]+", name) if w]
    return bool(parts) and parts[-1] in NOISE_WORDS and parts[-1] != "header" and STATE_WORDS.isdisjoint(parts)


@functools.lru_cache(maxsize=100_000)
def _judge(tag: str, marks: str, path: int) -> tuple[int, tuple[bool, bool, bool, str]]:
    """Path of an element below ``path`` and what it says of itself; ``marks`` are its attributes, if any matter."""
    found = {k.lower(): v.strip("\"'").lower() for k, v in ATTRIBUTE.findall(marks)}
    classes, role = found.get("class", "").split(), found.get("role", "")
    names = (*classes, *found.get("id", "").split())
    noise = role in NOISE_ROLES or any(map(_names_noise, names))
    own = role if role in MAIN_TAGS else tag if tag in MAIN_TAGS else ""
    return _hash(f"{path}/{tag}{''.join('.' + c for c in sorted(classes))}@{role}"), (
        tag in NOISE_TAGS, noise, "header" in names, own)


def _open(tag: str, attributes: str, parent: Node) -> Node:
    marks = attributes if MATTERS.search(attributes) else ""
    return Node(tag, *_judge(tag, marks, parent.path), parent, parent.depth + 1)


def _settle(root: Node) -> Node:
    """Give every element its kind: what it says, and what stands above it."""
    around: dict[str, set[int]] = {}  # the elements that hold every main, and every article
    stack = [root]
    while stack:
        node = stack.pop()
        own = node.says[3]
        if own:
            above, up = set(), node.parent
            while up is not None:
                above.add(id(up))
                up = up.parent
            around[own] = around.get(own, above) & above
        if own != "article" and not node.says[0]:
            stack += [x for x in node.items if isinstance(x, Node)]
    wraps = set().union(*around.values())
    stack = [root]
    while stack:
        node = stack.pop()
        above = node.parent.kind if node.parent else "open"
        tag, named, header, own = node.says
        if above in ("main", "article"):  # the header of an article is part of it
            tag, header = tag and node.tag != "header", False
        if node.tag in ("html", "body") or own == "main" or id(node) in wraps:
            named = header = False
        noise = tag or named or header or above == "noise"
        node.kind = "noise" if noise else "main" if above == "main" else own or above
        stack += [x for x in node.items if isinstance(x, Node)]
    return root


def _place(tag: str, here: Node) -> Node:
    """The element a new ``tag`` goes into: a block ends an open paragraph, an item the item before it."""
    if tag in INLINE_TAGS:
        return here
    targets, ends = CLOSES.get(tag, ((), ()))
    up = here
    while up.parent is not None and up.tag not in ends:
        if up.tag == "p" or up.tag in targets:
            here = up.parent
        elif up.tag not in INLINE_TAGS and not targets:
            break
        up = up.parent
    return here


def parse(page: str) -> Node:
    """The element tree of a page; unclosed, misplaced and broken tags never fail."""
    root = here = Node("", 0, (False, False, False, ""), None, 0)
    at = 0
    while m := TOKEN.search(page, at):
        if m.start() > at:
            here.items.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            up = here
            while up.parent is not None and up.tag != tag:
                up = up.parent
            here = up.parent or here
            continue
        here = _place(tag, here)
        node = _open(tag, m[3], here)
        here.items.append(node)
        if tag in RAW_TAGS:  # what follows is no markup until its end
            end = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
            node.items.append(page[at : end.start() if end else len(page)])
            at = end.start() if end else len(page)
        if tag not in VOID_TAGS and not m[3].endswith("/") and node.depth < DEEPEST:
            here = node
    if at < len(page):
        here.items.append(page[at:])
    return _settle(root)


def text_blocks(root: Node, keep) -> list[tuple[Node, str]]:
    """The texts between block boundaries with the block element each stands in, where ``keep`` holds."""
    out: list[tuple[Node, list[str]]] = []
    stack: list = [(root, root, iter(root.items))]
    out.append((root, []))
    while stack:
        node, block, rest = stack[-1]
        item = next(rest, None)
        if item is None:
            stack.pop()
            if node.tag not in INLINE_TAGS and stack:
                out.append((stack[-1][1], []))
            continue
        if isinstance(item, str):
            out[-1][1].append(item)
        elif item.tag == "br":
            out[-1][1].append(" ")
        elif keep(item):
            own = item if item.tag not in INLINE_TAGS else block
            if own is item:
                out.append((item, []))
            stack.append((item, own, iter(item.items)))
    done = ((block, " ".join(html.unescape("".join(parts)).split())) for block, parts in out if parts)
    return [(block, text) for block, text in done if text]


def observations(page: str) -> list[tuple[int, bool, int]]:
    """What a page adds to its host's tree: (node, is content, style or text), each once."""
    root = parse(page)
    seen: dict[tuple[int, bool, int], None] = {}
    stack = [root]
    while stack:
        node = stack.pop()
        children = [x for x in node.items if isinstance(x, Node)]
        stack += children
        if node.kind != "noise" and node.tag not in INLINE_TAGS:
            names = []
            for x in children:  # a run of equal children counts as one
                if x.tag not in INLINE_TAGS and (not names or names[-1] != x.tag):
                    names.append(x.tag)
            seen[node.path, False, _hash(">".join(names)) >> 8 << 8 | min(len(names), 255)] = None
    for block, text in text_blocks(root, lambda n: n.kind != "noise"):
        mark = _hash(text)
        while block is not None:
            seen[block.path, True, mark] = None
            block = block.parent
    return list(seen)


def host_of(url: Column) -> Column:
    """The host of an address, without port or user, in lower case; null gives the empty host."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def low_branches(pages: DataFrame, threshold: float, least_pages: int) -> DataFrame:
    """The nodes whose importance over their host's pages is below ``threshold``: (host, node, importance, m pages)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, nodes, kinds, marks = [], [], [], []
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                for node, content, mark in observations(page or ""):
                    hosts.append(host)
                    nodes.append(node)
                    kinds.append(content)
                    marks.append(mark)
            counts = pd.DataFrame({"host": hosts, "node": np.array(nodes, np.int64), "content": np.array(kinds, bool),
                                   "mark": np.array(marks, np.int64)}).value_counts().rename("n").reset_index()
            yield pa.RecordBatch.from_pandas(counts.astype({"host": str, "n": "int64"}), preserve_index=False)

    seen = pages.mapInArrow(run, "host string, node long, content boolean, mark long, n long").groupBy(
        "host", "node", "content", "mark").agg(F.sum("n").alias("n"))
    n, style = F.col("n").cast("double"), ~F.col("content")
    per = seen.groupBy("host", "node").agg(
        F.sum(F.when(style, n)).alias("m"), F.sum(F.when(style, n * F.log(n))).alias("styles"),
        F.sum(F.when(style, n * F.col("mark").bitwiseAND(F.lit(255)))).alias("children"),
        F.sum(F.when(F.col("content"), F.log(n))).alias("spread"),
        F.sum(F.when(F.col("content"), 1.0)).alias("texts"))
    m = F.col("m")
    # -sum p log_m p with p = n / m, which is 1 - sum(n log n) / (m log m)
    presentation = 1 - F.col("styles") / (m * F.log(m))
    content = F.coalesce(1 - F.col("spread") / (F.col("texts") * F.log(m)), F.lit(0.0))
    weight = F.pow(F.lit(GAMMA), F.col("children") / m)
    return per.where(m >= max(least_pages, 2)).withColumn(
        "importance", (1 - weight) * presentation + weight * content).where(
        F.col("importance") < threshold).select("host", "node", "importance", "m")


def extract(pages: DataFrame, threshold: float = 0.2, least_pages: int = 5, broadcast_bytes: int = 8 << 20,
            inside_threshold: float = 0.1, inside_pages: int = 10,
            id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text (blocks joined by a blank line), n_chars.

    A branch is removed where its host's tree has it below ``threshold`` over at least
    ``least_pages`` pages; with fewer there is nothing to compare and only names decide. Inside
    article and main elements ``inside_threshold`` and ``inside_pages`` take their place.
    ``main_text`` says which of the remaining texts are the page's. A null or
    empty page has the empty text; a null address is a host of its own; a repeated page
    counts as often as it occurs; other columns are ignored.
    """
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                          F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    low = materialize(low_branches(source.select("host", "html"), threshold, least_pages), "style-tree")
    firm = (F.col("importance") < inside_threshold) & (F.col("m") >= inside_pages)
    noise = low.groupBy("host").agg(F.collect_list("node").alias("noise"),
                                    F.collect_list(F.when(firm, F.col("node"))).alias("firm"))
    # One row per low node: known after the write, and sent to all tasks only while it is small.
    if low.count() * 64 <= broadcast_bytes:
        noise = F.broadcast(noise)
    joined = source.join(noise, "host", "left").select("page_id", "url", "html", "noise", "firm")
    kind = source.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, low_nodes, firm_nodes in zip(*(batch.column(c).to_pylist() for c in ("html", "noise", "firm")), strict=True):
                texts.append(main_text(page or "", frozenset(low_nodes or ()), frozenset(firm_nodes or ())))
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")


def main_text(page: str, low: frozenset[int] = frozenset(), firm: frozenset[int] = frozenset()) -> str:
    """A page's text without noise elements and without branches in ``low``, inside article and main in ``firm``.

    What stands in main elements is the text, else what stands in articles. Articles shorter
    than the text around them are teasers: both are taken. Where nothing of the main elements,
    articles or page would be left, the branches stay: a page that is a copy throughout still
    has a text.
    """

    def keep(node: Node) -> bool:
        return node.kind != "noise" and (
            node.tag in INLINE_TAGS or node.path not in (low if node.kind == "open" else firm))

    root = parse(page)
    blocks = text_blocks(root, lambda node: node.kind != "noise")
    kept = text_blocks(root, keep) if low or firm else blocks
    of = lambda kind, found: [text for block, text in found if block.kind == kind]
    if main := of("main", kept) or of("main", blocks):
        return "\n\n".join(main)
    article, around = of("article", kept), of("open", kept)
    whole = article or of("article", blocks)
    if sum(map(len, whole)) >= sum(map(len, around)) and whole:
        return "\n\n".join(whole)
    return "\n\n".join(text for _, text in kept or blocks)
