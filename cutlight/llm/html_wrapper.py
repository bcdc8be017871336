"""Main text of web pages by wrapper induction: the pages of a host are aligned by simple tree matching.

Each page becomes a small tree: siblings of one tag and class are one node that repeats, with the texts of all its
occurrences. Each task merges its trees of a host pair by pair along the best alignment of simple tree matching; what the
tasks found is added up by host, node and text. Texts that most pages with the same parent node repeat are template; the
node under which the varying text gathers, outside menus, forms and the like, is the slot of the content.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cutlight.llm.scratch import materialise, ship

#: Elements without content, elements whose content is no text, and elements that never hold an article's text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg math iframe object textarea title select canvas audio video".split())
NOISE = frozenset("nav footer aside form button fieldset dialog menu".split())
#: Words in a class, id or role that mark what is no article.
NOISE_WORDS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets notice notices cookie cookies consent popup modal overlay alert comment comments respond reply replies disqus share sharing social related recommended recommendations newsletter subscribe subscription signup login form search pagination pager toolbar copyright legal disclaimer contentinfo complementary".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
#: Start tags that end an open paragraph; list-like elements that end their own kind.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li dd dt".split())
OWN_KIND = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Levels of a template: what lies deeper counts as part of its ancestor there (in texts nothing is cut).
DEPTH = 60
#: Counts of nodes and texts that a task holds before it hands them on.
MOST_HELD = 100_000
#: A text is template if this share of the pages with its parent node hold it; where those are fewer than FEW, if all do.
FEW, SHARE = 6, 0.5
#: The slot lies under a child that holds this share of the varying text.
CENTRE = 0.6
#: Characters of all templates that may go along with the tasks; beyond, pages meet their template in a join.
MOST_BROADCAST = 16_000_000


class Node:
    __slots__ = ("children", "noise", "parent", "sig", "tag")

    def __init__(self, tag: str, sig: str, noise: bool, parent: Node | None):
        self.tag, self.sig, self.noise, self.parent = tag, sig, noise, parent
        self.children: list = []  # nodes, and strings between them


def _noisy(tag: str, names: list[str], parent: Node | None) -> bool:
    if tag in NOISE or tag in RAW or tag == "head":
        return True
    if tag == "header":
        return not _inside(parent, ("article", "main"))
    return any(w in NOISE_WORDS for n in names for w in re.split(r"[^a-z]+", n))


def _inside(node: Node | None, tags: tuple[str, ...]) -> bool:
    while node is not None:
        if node.tag in tags:
            return True
        node = node.parent
    return False


def parse(page: str) -> Node:
    """The page's tree. Tags may be left open, overlap or be cut off at the end of the page."""
    root = Node("html", "html", False, None)
    at, here = 0, root
    find = _TAG.search
    while m := find(page, at):
        if m.start() > at:
            here.children.append(page[at : m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, closing = name.lower(), m[1] or m[4]
        if closing:
            node = here
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                here = node.parent
            continue
        if tag in ("html", "body"):
            continue
        attrs = {}
        for a in _ATTR.finditer(m[3] or m[6] or ""):
            attrs.setdefault(a[1].lower(), html.unescape(a[2] or a[3] or a[4] or ""))
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in ENDS_P:
            node = here
            while node is not None and node.tag != "p" and (node.tag in INLINE or node is here):
                node = node.parent
            if node is not None and node.tag == "p" and node.parent is not None:
                here = node.parent
        if tag in OWN_KIND:
            kinds, within = OWN_KIND[tag]
            node = here
            while node is not None and node.tag not in within:
                if node.tag in kinds.split():
                    here = node.parent
                    break
                node = node.parent
        names = [x.lower() for x in (attrs.get("class", "") + " " + attrs.get("id", "") + " " + attrs.get("role", "")).split()]
        first = attrs.get("class", "").split()[:1]
        sig = tag + ("." + re.sub(r"\d+", "0", first[0].lower()) if first else "")
        if tag in VOID or (m[3] or m[6] or "").endswith("/") and tag not in ENDS_P and tag not in INLINE:
            here.children.append(Node(tag, sig, False, here))
            continue
        node = Node(tag, sig, here.noise or _noisy(tag, names, here) or "hidden" in attrs or attrs.get("aria-hidden") == "true", here)
        here.children.append(node)
        here = node
    if at < len(page):
        here.children.append(page[at:])
    return root


def blocks(root: Node) -> list[tuple[tuple[str, ...], str, int, bool, str]]:
    """(path, text, characters inside links, noise, tag) of each block with text, in page order.

    A block is the text of an element up to the next block-level start or end tag, inline elements included.
    """
    out, path = [], []
    parts: list[str] = []
    linked = [0]

    def flush(noise: bool, tag: str) -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((tuple(path), text, min(linked[0], len(text)), noise, tag))
            parts.clear()
            linked[0] = 0

    # an explicit stack: pages may nest deeper than Python's own
    stack: list[tuple[Node, int, bool]] = [(root, 0, False)]
    path.append(root.sig)
    while stack:
        node, i, link = stack.pop()
        block = node.tag not in INLINE
        if i == len(node.children):
            if block:
                flush(node.noise, node.tag)
                path.pop()
            continue
        stack.append((node, i + 1, link))
        child = node.children[i]
        if isinstance(child, str):
            text = html.unescape(child)
            parts.append(text)
            if link:
                linked[0] += len(text.strip())
        elif child.tag == "br":
            parts.append("\n")
        elif child.tag in INLINE:
            if child.noise and not node.noise:
                continue  # an inline advert or the like: no block of its own, and no text of this one
            stack.append((child, 0, link or child.tag == "a"))
        else:
            owner = node
            while owner.tag in INLINE and owner.parent is not None:
                owner = owner.parent
            flush(owner.noise, owner.tag)
            path.append(child.sig)
            stack.append((child, 0, False))
    return out


# A template node: [sig, pages, characters, characters of the subtree, {text digest: [pages, characters]}, children]
_SIG, _PAGES, _CHARS, _BELOW, _TEXTS, _CHILDREN = range(6)


def digest(text: str) -> str:
    return hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=6).hexdigest()


def shape(found: list[tuple[tuple[str, ...], str, int, bool, str]]) -> list:
    """The template of one page: equal siblings in one node, without noise."""
    root = ["html", 1, 0, 0, {}, []]
    for path, text, _, noise, _ in found:
        if noise:
            continue
        node = root
        node[_BELOW] += len(text)
        for sig in path[1:DEPTH]:
            child = next((c for c in node[_CHILDREN] if c[_SIG] == sig), None)
            if child is None:
                child = [sig, 1, 0, 0, {}, []]
                node[_CHILDREN].append(child)
            node = child
            node[_BELOW] += len(text)
        node[_CHARS] += len(text)
        node[_TEXTS].setdefault(digest(text), [1, len(text)])
    return root


def match(a: list, b: list, memo: dict | None = None) -> int:
    """Simple tree matching: the size of the largest mapping that keeps order and parents, roots included."""
    if a[_SIG] != b[_SIG]:
        return 0
    memo = {} if memo is None else memo
    key = (id(a), id(b))
    if key not in memo:
        x, y = a[_CHILDREN], b[_CHILDREN]
        above = [0] * (len(y) + 1)
        for c in x:
            row = [0]
            for j, d in enumerate(y):
                row.append(max(row[-1], above[j + 1], above[j] + (match(c, d, memo) if c[_SIG] == d[_SIG] else 0)))
            above = row
        memo[key] = 1 + above[-1]
    return memo[key]


def align(x: list, y: list, memo: dict) -> list[tuple[list | None, list | None]]:
    """The children of two nodes in one order: matched pairs, and those of one side only."""
    if [c[_SIG] for c in x] == [d[_SIG] for d in y]:
        return list(zip(x, y, strict=True))
    score = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, c in enumerate(x):
        for j, d in enumerate(y):
            score[i + 1][j + 1] = max(score[i][j + 1], score[i + 1][j], score[i][j] + match(c, d, memo))
    out, i, j = [], len(x), len(y)
    while i and j:
        if score[i][j] == score[i - 1][j]:
            i -= 1
            out.append((x[i], None))
        elif score[i][j] == score[i][j - 1]:
            j -= 1
            out.append((None, y[j]))
        else:
            i, j = i - 1, j - 1
            out.append((x[i], y[j]))
    out += [(c, None) for c in reversed(x[:i])] + [(None, d) for d in reversed(y[:j])]
    out.reverse()
    # what stands elsewhere in the other tree is still one node
    moved = {d[_SIG]: d for c, d in out if c is None}
    lone = {c[_SIG] for c, d in out if d is None}
    out = [(c, moved.get(c[_SIG])) if d is None else (c, d) for c, d in out if c is not None or d[_SIG] not in lone]
    return out


def merge(a: list, b: list) -> list:
    """The template of the pages of both, in the place of a."""
    a[_CHILDREN] = [c if d is None else d if c is None else merge(c, d) for c, d in align(a[_CHILDREN], b[_CHILDREN], {})]
    for i in (_PAGES, _CHARS, _BELOW):
        a[i] += b[i]
    for k, v in b[_TEXTS].items():
        if k in a[_TEXTS]:
            a[_TEXTS][k][0] += v[0]
        else:
            a[_TEXTS][k] = v
    return a


def counts(root: list) -> Iterator[tuple[str, str, int, int, int]]:
    """(path, digest, pages, characters, characters of the subtree) of every node, its digest empty, and of every text."""
    stack = [(root, root[_SIG])]
    while stack:
        node, path = stack.pop()
        yield path, "", node[_PAGES], node[_CHARS], node[_BELOW]
        for text, (pages, chars) in node[_TEXTS].items():
            yield path, text, pages, pages * chars, 0
        stack += [(c, f"{path} {c[_SIG]}") for c in node[_CHILDREN]]


def finish(rows: list[tuple[str, str, int, int, int]]) -> dict:
    """What extraction needs of a host, from the counts of its nodes and constant texts.

    constant: pages that hold a text at a node. weight: of each node its pages, the characters of its subtree that are not
    template, and those of its own.
    """
    weight = {path: [pages, below, own] for path, text, pages, own, below in rows if not text}
    constant = {}
    for path, text, pages, chars, _ in rows:
        if text:
            constant[f"{path} {text}"] = pages
            weight[path][2] -= chars
            while path:
                weight[path][1] -= chars
                path = path.rpartition(" ")[0]
    return {"constant": constant, "weight": weight}


def slot(weight: dict[str, list[int]], found: list) -> tuple[str, ...]:
    """The node of a page under which varying text gathers, by the average that the host's pages have under each node.

    Only nodes that the page has compete, so every layout of a host finds its own slot. An <article> on the way down is
    taken whole.
    """
    below: dict[tuple[str, ...], dict[str, None]] = {}
    for path, *_ in (b for b in found if not b[3]):
        for i in range(1, min(len(path), DEPTH)):
            below.setdefault(path[:i], {})[path[i]] = None

    def average(path: tuple[str, ...], which: int) -> float:
        w = weight.get(" ".join(path))
        return w[which] / w[0] if w else 0.0

    path, whole = ("html",), None
    while path in below:
        parts = {sig: average((*path, sig), 1) for sig in below[path]}
        best = max(parts, key=parts.get)
        all_ = sum(parts.values()) + average(path, 2)
        if parts[best] <= 0 or parts[best] < CENTRE * all_ or best.split(".")[0] in ("p", "li", "td", "blockquote") or (*path, best) not in below:
            break
        path = (*path, best)
        if best.split(".")[0] == "article":
            whole = path
    return whole or path


def main_text(page: str | None, template: dict | None) -> str:
    """The content of a page: its blocks inside the host's slot that are neither noise nor template.

    Texts that fewer than FEW pages hold stay where more than half of the content would go: such a page is a copy of another.
    Tags decide only where the host does not: with one page, without varying text, or where no node of this page holds
    most of it, blocks inside <article> or <main> are taken, and without those the slot of the page itself.
    """
    if not page:
        return ""
    found = blocks(parse(page))
    open_ = [b for b in found if not b[3]]
    inside = []
    if template:
        at = slot(template["weight"], found)
        if len(at) > 1:
            # a title may stand beside the slot
            inside = [b for b in open_ if b[0][: len(at)] == at or b[4] == "h1" and len(b[0]) - 1 < len(at) and b[0][:-1] == at[: len(b[0]) - 1]]
    if not inside:
        inside = [b for b in open_ if any(s.split(".")[0] in ("article", "main") for s in b[0])]
    if not inside:
        at = slot(finish([c for c in counts(shape(found)) if not c[1]])["weight"], found)
        inside = [b for b in open_ if b[0][: len(at)] == at]
    inside = [b for b in inside if not (b[2] > 0.8 * len(b[1]) and b[4] not in HEADINGS and b[4] != "p")] or inside
    repeated = [template["constant"].get(" ".join((*b[0][:DEPTH], digest(b[1]))), 0) if template else 0 for b in inside]
    often = [b for b, n in zip(inside, repeated, strict=True) if n < FEW]
    kept = [b for b, n in zip(inside, repeated, strict=True) if not n]
    if 2 * sum(len(b[1]) for b in kept) < sum(len(b[1]) for b in often):
        kept = often
    return " ".join(b[1] for b in (kept or inside))


def host(url: str | None) -> str:
    m = re.match(r".*?://([^/?#]*)", url or "", re.S)
    return m[1].lower() if m else ""


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of each host's merged template, of all pages of the task or of as many as MOST_HELD lets it hold."""
    partial: dict[str, list] = {}
    held = 0

    def out() -> pa.RecordBatch:
        rows = [(h, *c) for h, t in partial.items() for c in counts(t)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), [pa.string()] * 3 + [pa.int64()] * 3, strict=True)], names=["host", "path", "digest", "pages", "chars", "below"])

    for batch in batches:
        for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if page:
                found = blocks(parse(page))
                h, one = host(url), shape(found)
                partial[h] = merge(partial[h], one) if h in partial else one
                held += 1 + 2 * len(found)
            if held > MOST_HELD:
                yield out()
                partial, held = {}, 0
    if partial:
        yield out()


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        said = [json.dumps(finish([tuple(r.values()) for r in rows])) for rows in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string())], names=["host", "template"])


def templates(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, template) of all hosts with two pages or more.

    Nodes and texts are counted by host over all tasks. What one page alone has tells nothing of the others and goes after that.
    """
    ship(pages.sparkSession)
    rows = pages.select(F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    part = rows.mapInArrow(_induce, "host string, path string, digest string, pages bigint, chars bigint, below bigint")
    sums = [F.sum(c).alias(c) for c in ("pages", "chars", "below")]
    found = materialise(part.groupBy("host", "path", "digest").agg(*sums).where("pages > 1"), "counts")
    nodes = found.where("digest = ''")
    parent = F.when(F.instr("path", " ") == 0, F.col("path")).otherwise(F.expr("left(path, length(path) - length(substring_index(path, ' ', -1)) - 1)"))
    above = nodes.select("host", F.col("path").alias("parent"), F.col("pages").alias("whole"))
    least = F.when(F.col("whole") < FEW, F.col("whole")).otherwise(F.greatest(F.lit(3.0), SHARE * F.col("whole")))
    texts = found.where("digest <> ''").withColumn("parent", parent).join(above, ["host", "parent"]).where(F.col("pages") >= least).select(*nodes.columns)
    of_host = nodes.unionAll(texts).groupBy("host").agg(F.sort_array(F.collect_list(F.struct("path", "digest", "pages", "chars", "below"))).alias("rows"))
    return of_host.mapInArrow(_finished, "host string, template string")


def _extract(known: dict[str, str] | None):
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, dict] = {}
        for batch in batches:
            ids, urls, pages = (batch.column(i).to_pylist() for i in range(3))
            given = batch.column(3).to_pylist() if known is None else [known.get(host(u)) for u in urls]
            texts = []
            for page, t in zip(pages, given, strict=True):
                if t is not None and t not in cache:
                    if len(cache) > 500:
                        cache.clear()
                    cache[t] = json.loads(t)
                texts.append(main_text(page, cache.get(t)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return extract


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars.

    text is the page's article, blocks in page order joined by one space; empty for null or empty pages and pages without
    content. Pages with a null url, or one without ://, form one host. Pages that repeat are aligned like any others.
    """
    found = materialise(templates(pages, url_col, html_col), "templates")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    kind = "page_id bigint, url string, text string"
    size = found.agg(F.coalesce(F.sum(F.length("template") + F.length("host")), F.lit(0))).first()[0]
    if size <= MOST_BROADCAST:
        out = rows.mapInArrow(_extract({r["host"]: r["template"] for r in found.collect()}), kind)
    else:
        name = F.lower(F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)", 1))
        joined = rows.withColumn("of", F.coalesce(name, F.lit(""))).join(found, F.col("of") == F.col("host"), "left")
        out = joined.select("page_id", "url", "html", "template").mapInArrow(_extract(None), kind)
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
