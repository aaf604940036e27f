"""Main text of web pages by wrapper induction: pages of one host are aligned, what stays the same is template.

A page's tree of block elements is folded into its label paths: siblings of one label become one node that holds the texts
of all of them.  So pages that differ only in how many paragraphs or links they have share one tree, and a host has few
distinct trees.  The tree that most pages of a host have is its wrapper; every other tree of the host is aligned to it by
simple tree matching (the largest order-preserving match of equal labels, level by level), and nodes without a match extend
it below the node that their parent is matched with.  A block whose text is on most pages that have its node is template, the
others are slots.  The content is the slots, less those that are set apart by their element or name (menus, headers,
footers, sidebars, notices, adverts, forms, comments) and those made of links; where pages mark their article, it is the
slots inside the article, and names there count only on hosts too small to tell by alignment.  Copies of a page count once.

Only trees are gathered by host; texts are counted by their hashes, and the html itself is read where it lies.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field
from functools import lru_cache

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from worklode.llm.common import cut_lineage, map_rows

# Elements of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr output picture progress q "
    "rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section table ul".split()
)
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table select menu article section div nav aside main body html form td th".split())
#: Elements, and words in classes, ids and roles, that set a part of a page apart from its article.
APART = frozenset("nav aside footer form head button select dialog svg canvas object audio video map menu".split()) | RAW
APART_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navigation navbar menu menubar "
    "breadcrumb breadcrumbs header masthead footer contentinfo sidebar aside complementary widget cookie cookies consent gdpr notice "
    "notices alert popup modal overlay dialog newsletter subscribe subscription signup login search share sharing social related "
    "recommended comment comments disqus respond reply replies toolbar pagination pager skip copyright disclaimer form".split()
)
MAIN = frozenset(["article", "main"])
MAIN_WORDS = frozenset("article main articlebody entry post".split())
#: Words that may stand beside those above in one class, id or role, as in site-footer or entry-content.
BESIDE_APART = frozenset("site page main top bottom primary secondary global area wrapper container section box bar list block inner outer".split())
BESIDE_MAIN = frozenset("content body text".split())
COMMENTS = frozenset("comment comments disqus respond reply replies".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LINKED = 0.5  # a slot with more of its text in links than this is a menu
SEVERAL = 3  # pages that must share a text for it to be template
MOSTLY = 0.5  # part of the pages with a node that must share a text for it to be template

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")


@dataclass
class Page:
    """A page folded into label paths: nodes in order of first sight, and its blocks of text in page order."""

    labels: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters inside links

    def tree(self) -> str:
        return "\n".join(f"{p} {label}" for p, label in zip(self.parents, self.labels))


def _label(tag: str, attributes: str) -> str:
    tokens = [t for m in _NAMED.finditer(attributes) for t in (m[2] or m[3] or m[4] or "").lower().split()] if attributes.strip() else []
    names = {"-".join(w for w in _WORD.findall(t) if not w.isdigit()) for t in tokens}
    return ".".join([tag, *sorted(names - {""})])


def fold(text: str | None) -> Page:
    """Read a page with a browser's leniency: unknown ends are skipped, missing ends are implied."""
    page, index = Page(), {}

    def node(parent: int, label: str) -> int:
        if (parent, label) not in index:
            index[parent, label] = len(page.labels)
            page.labels.append(label)
            page.parents.append(parent)
        return index[parent, label]

    root = node(-1, "root")
    open_: list[tuple[str, int]] = [("", root)]  # tag and block node it lies in
    pieces: list[str] = []
    linked = inside = 0

    def end_block() -> None:
        nonlocal linked
        if pieces:
            said = " ".join(entities.unescape("".join(pieces)).split())
            if said:
                page.blocks.append((open_[-1][1], said, linked))
            pieces.clear()
        linked = 0

    def close(tag: str, within: frozenset | set = frozenset()) -> None:
        """Close the innermost open ``tag`` and what is open inside it, but not beyond an element of ``within``."""
        nonlocal inside
        for k in range(len(open_) - 1, 0, -1):
            if open_[k][0] == tag:
                if any(t not in INLINE for t, _ in open_[k:]):
                    end_block()
                inside -= sum(t == "a" for t, _ in open_[k:])
                del open_[k:]
                return
            if open_[k][0] in within:
                return

    text, at = text or "", 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if m is None:  # a tag without an end: the rest of the page is none of its text
            break
        at = m.end()
        if m[4] is not None:
            pieces.append(m[4])
            linked += len(m[4]) if inside > 0 else 0
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in ("br", "p") and not any(t == tag for t, _ in open_):
                end_block()
            close(tag)
            continue
        if tag in CLOSES_P and any(t == "p" for t, _ in open_):
            close("p", HOLDS)
        for t in CLOSED_BY.get(tag, ()):
            close(t, HOLDS - {t})
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(text, at)
            at = end.end() if end else len(text)
            continue
        if tag == "br" or tag not in INLINE:
            end_block()
        if tag in VOID or m[3].rstrip().endswith("/") and tag not in INLINE and tag not in HOLDS:
            continue
        if tag in INLINE:
            inside += tag == "a"
            open_.append((tag, open_[-1][1]))
        else:
            open_.append((tag, node(open_[-1][1], _label(tag, m[3]))))
    end_block()
    return page


@lru_cache(maxsize=4096)
def read_tree(tree: str) -> tuple[tuple[int, ...], tuple[str, ...], tuple[tuple[int, ...], ...]]:
    """Parents, labels and children of the nodes."""
    rows = [line.partition(" ") for line in tree.split("\n")]
    parents, labels = tuple(int(r[0]) for r in rows), tuple(r[2] for r in rows)
    children: list[list[int]] = [[] for _ in rows]
    for k, p in enumerate(parents):
        if p >= 0:
            children[p].append(k)
    return parents, labels, tuple(map(tuple, children))


def align(tree: str, wrapper: str) -> list[int]:
    """Simple tree matching: for each node of ``tree`` the node of ``wrapper`` it is matched with, or -1.

    Two nodes match if their labels do; the children of matched nodes match in order, so that most nodes are matched.
    """
    _, a_labels, a_children = read_tree(tree)
    _, b_labels, b_children = read_tree(wrapper)
    memo: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def settle(a: int, b: int) -> None:
        """Nodes matched at and below a and b, and which children are matched; those of their children are known."""
        xs, ys = a_children[a], b_children[b]
        best = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, x in enumerate(xs):
            for j, y in enumerate(ys):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + (memo[x, y][0] if (x, y) in memo else 0))
        pairs, i, j = [], len(xs), len(ys)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((xs[i], ys[j]))
        memo[a, b] = (1 + best[-1][-1], pairs)

    # Pairs of nodes with one label, from the roots down, however deep; settled from the leaves up.
    met = [(0, 0)] if a_labels[0] == b_labels[0] else []
    seen = set(met)
    for a, b in met:
        for x in a_children[a]:
            for y in b_children[b]:
                if a_labels[x] == b_labels[y] and (x, y) not in seen:
                    seen.add((x, y))
                    met.append((x, y))
    for a, b in reversed(met):
        settle(a, b)

    out = [-1] * len(a_labels)
    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        out[a] = b
        todo += memo[a, b][1] if (a, b) in memo else []
    return out


def node_keys(tree: str, match: list[int]) -> list[int]:
    """Nodes of the extended wrapper: the matched one, or below zero a hash of the parent's and the label."""
    parents, labels, _ = read_tree(tree)
    out: list[int] = []
    for k, m in enumerate(match):
        out.append(m if m >= 0 else -1 - (_hash(f"{out[parents[k]]} {labels[k]}") >> 1 & (1 << 62) - 1))
    return out


def _says(names: list[str], words: frozenset, beside: frozenset = frozenset()) -> bool:
    """Whether a whole class, id or role is made of ``words``, and maybe ones that stand ``beside`` them."""
    split = [n.split("-") for n in names]
    return any(any(w in words for w in ws) and all(w in words or w in beside for w in ws) for ws in split)


def content_nodes(tree: str, decided: list[bool], linked: list[float]) -> tuple[list[int], list[int]]:
    """The nodes whose blocks are content unless they are template, for a page with this tree, and those to fall back on.

    ``decided``: node by node, whether enough pages have it to tell template from slots; ``linked``: the part of its text in links.
    """
    parents, labels, _ = read_tree(tree)
    n = len(labels)
    told = list(decided)
    for k in range(n - 1, 0, -1):
        told[parents[k]] |= told[k]
    main, apart, named = [False] * n, [False] * n, [False] * n
    for k in range(n):
        up = parents[k]
        tag, *names = labels[k].split(".")
        above, below = up >= 0 and main[up], up >= 0 and named[up]
        apart[k] = (up >= 0 and apart[up]) or tag in APART or (tag == "header" and not above)
        marked = tag in MAIN or tag in ("div", "section", "td") and not below and _says(names, MAIN_WORDS, BESIDE_MAIN)
        main[k] = not apart[k] and (above or marked)
        own = tag not in MAIN and tag not in ("html", "body", "p", "h1") and _says(names, APART_WORDS, BESIDE_APART)
        if own and above and told[k] and not _says(names, COMMENTS, APART_WORDS | BESIDE_APART):
            own = False  # the alignment tells
        named[k] = own or below and not (tag in MAIN and not above)
    menu = [linked[k] > LINKED and labels[k].partition(".")[0] not in HEADINGS for k in range(n)]
    if any(main):
        return [k for k in range(n) if main[k] and not named[k] and not menu[k]], [k for k in range(n) if main[k]]
    return [k for k in range(n) if not apart[k] and not named[k] and linked[k] <= LINKED], [k for k in range(n) if not apart[k]]


def _hash(text: str) -> int:
    return int.from_bytes(xxhash.xxh64_digest(text.encode(), 7), "big", signed=True)


def page_trees(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``_host``, ``_tree`` and the distinct blocks of every page, as arrays: ``_node``, ``_said`` (hash of the text), ``_chars``,
    ``_links``, and ``_first`` (one for the first block of each node); pages with equal ``_page`` have the same tree and texts."""

    def run(columns):
        out = [[] for _ in range(7)]
        for html in columns[1]:
            page = fold(html)
            seen: dict[tuple[int, int], list[int]] = {}
            for node, block, linked in page.blocks:
                sums = seen.setdefault((node, _hash(block)), [0, 0])
                sums[0] += len(block)
                sums[1] += min(linked, len(block))
            tree, nodes = page.tree(), [n for n, _ in seen]
            first = {n: i for i, n in reversed([*enumerate(nodes)])}
            row = [_hash(f"{tree} {[*seen]}"), tree, nodes, [h for _, h in seen], [c for c, _ in seen.values()], [x for _, x in seen.values()], [int(first[n] == i) for i, n in enumerate(nodes)]]
            for column, value in zip(out, row):
                column.append(value)
        return [columns[0], *out]

    schema = "_host string, _page bigint, _tree string, _node array<int>, _said array<bigint>, _chars array<bigint>, _links array<bigint>, _first array<int>"
    return map_rows(pages.select("_host", html_col), run, schema)


def host_of(url):
    """Lower-case host of a URL without a leading www; null or odd URLs share the empty host."""
    return F.coalesce(F.regexp_replace(F.lower(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), r"^www\.", ""), F.lit(""))


def induce(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """For each host and tree (``_host``, ``_tree``): ``nodes`` and ``others`` of `content_nodes`, and the blocks that are
    template by their nodes and hashes (``same_nodes``, ``same_texts``)."""
    rows = cut_lineage(page_trees(pages, html_col).dropDuplicates(["_host", "_page"]))
    trees = cut_lineage(rows.groupBy("_host", "_tree").agg(F.count("*").alias("n")))
    wrapper = trees.groupBy("_host").agg(F.max(F.struct("n", "_tree"))["_tree"].alias("_wrapper"))

    def aligned(columns):
        return [columns[0], columns[1], [node_keys(t, align(t, w)) for t, w in zip(columns[1], columns[2])]]

    matched = trees.join(wrapper, "_host").select("_host", "_tree", "_wrapper")
    matched = cut_lineage(map_rows(matched, aligned, "_host string, _tree string, _keys array<bigint>"))
    keyed = rows.join(matched, ["_host", "_tree"]).withColumn("_key", F.transform("_node", lambda n: F.col("_keys")[n]))
    found = keyed.select("_host", F.explode(F.arrays_zip("_key", "_said", "_chars", "_links", "_first")).alias("x"))
    found = found.select("_host", *[F.col(f"x._{c}").alias(c) for c in ("key", "said", "chars", "links", "first")])
    by_text = found.groupBy("_host", "key", "said").agg(F.count("*").alias("n"))
    by_node = found.groupBy("_host", "key").agg(F.sum("first").alias("pages"), (F.sum("links") / F.sum("chars")).alias("linked"))
    often = by_text.filter(F.col("n") >= SEVERAL).join(by_node, ["_host", "key"]).filter(F.col("n") >= MOSTLY * F.col("pages"))
    same = often.groupBy("_host", "key").agg(F.collect_list("said").alias("same"))  # at most 1 / MOSTLY times the blocks of a page
    known = by_node.join(same, ["_host", "key"], "left").groupBy("_host").agg(F.collect_list(F.struct("key", "pages", "linked", "same")).alias("known"))

    def chosen(columns):
        out = [[] for _ in range(4)]
        for tree, keys, known in zip(*columns[1:]):
            seen = {x["key"]: x for x in known or []}
            found = [seen.get(k) for k in keys]
            nodes, others = content_nodes(tree, [bool(x and x["pages"] >= SEVERAL) for x in found], [x["linked"] if x else 0.0 for x in found])
            blocks = [(k, h) for k, x in enumerate(found) if x for h in x["same"] or ()]
            for column, value in zip(out, (nodes, others, [k for k, _ in blocks], [h for _, h in blocks])):
                column.append(value)
        return [columns[0], columns[1], *out]

    schema = "_host string, _tree string, nodes array<int>, others array<int>, same_nodes array<int>, same_texts array<bigint>"
    return map_rows(matched.join(known, "_host", "left"), chosen, schema)


def page_text(html: str | None, nodes: list[int], others: list[int], same: set[tuple[int, int]]) -> str:
    """Blocks of ``nodes`` that are no template; if that leaves nothing, all of ``nodes``, and then of ``others``."""
    blocks, marked, kept = fold(html).blocks, {n for n, _ in same}, set(nodes)
    inside = [(n, b) for n, b, _ in blocks if n in kept]
    text = " ".join(b for n, b in inside if n not in marked or (n, _hash(b)) not in same) or " ".join(b for _, b in inside)
    return text or " ".join(b for n, b, _ in blocks if n in set(others))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page.  Columns: the id, the URL, ``text``, ``n_chars`` (code points); one row per row of ``pages``.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one space in page
    order.  Null and empty pages, and pages of markup only, have empty text; text without markup is one block.  Hosts with
    one page have no template; their content is told by elements and names.  Ids may be null or repeat.
    """
    # A page without a host has no pages to be aligned with but its own copies.
    host = F.when(F.coalesce(host_of(F.col(url_col)), F.lit("")) == "", F.concat(F.lit(" "), F.md5(F.coalesce(F.col(html_col), F.lit(""))))).otherwise(host_of(F.col(url_col)))
    pages = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), host.alias("_host"), F.col(html_col).alias("_html"))
    wrappers = induce(pages, "_html")

    def tree(columns):
        return [*columns, [fold(h).tree() for h in columns[3]]]

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    schema = ", ".join(f"{c} {t}" for c, t in kinds.items())
    treed = map_rows(pages, tree, f"{schema}, _tree string").join(wrappers, ["_host", "_tree"], "left")

    def text(columns):
        out = [page_text(h, n or [], o or [], set(zip(a or (), b or ()))) for h, n, o, a, b in zip(*columns[2:])]
        return [columns[0], columns[1], out, list(map(len, out))]

    made = map_rows(treed.select("_id", "_url", "_html", "nodes", "others", "same_nodes", "same_texts"), text, f"_id {kinds['_id']}, _url {kinds['_url']}, text string, n_chars long")
    return made.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", "n_chars")
