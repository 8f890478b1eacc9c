"""Main text of web pages by a site style tree.

The DOMs of all pages of a host are merged: nodes with the same path of labels (tag and classes)
are one node of the host's tree. A node's presentation importance is the entropy of the child sequences
it shows, in logs of the number of its pages m, so a node that always looks alike has none. The content
importance of a text block is 1 - log(n) / log(m) for a text that n of m pages show, 1 if only one
page shows it and 0 if all do. The composite importance of a node mixes both: with l child sequences,
(1 - g**l) times the mean importance of all blocks below it plus g**l times its own. A node is noise if
it and all nodes below it have a low composite importance; such branches are removed from each page. All hosts together make one more tree, in which
templates that many sites share stand out; a node counts by the lower of its two importances, and in
either tree only if ``MIN_PAGES`` pages have it. Numbers and the host's own name in a text do not count.

What HTML itself names as no part of an article (menus, headers, footers, sidebars, forms, scripts,
adverts, notices and comments, by tag, role or class) goes whatever its entropy, as comments differ on each page
like articles do. A class or id only says so by a token that begins or ends with such a word and does not deny it
(no-sidebar, has-comments), and never of a branch that holds the page's longest article or, on a page
without one, more than half of its text. Where a page has
an article or main element its text is what lies in there. Plain paragraphs and headings of an
article stay even if many pages repeat them, as mirrored pages do.

The trees stay distributed: counts per (host, path, feature), added up in the map tasks first, then per
node. Only the short list of a host's removed branches meets the pages.

Defined cases: a null or empty html has the empty text; a null or odd url counts as host ""; a
repeated page counts each time; unclosed tags end where HTML ends them, or with the page; an unfinished tag or
comment at the end of a page is no text; nodes deeper than ``MAX_DEPTH`` share their ancestor's path.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knownby.llm.tables import stored

MIN_PAGES = 8
LOW_IMPORTANCE = 0.75
PRESENTATION = 0.9
MAX_DEPTH = 32

# Fixed values of HTML: element names by what they mean for a block of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small "
    "span strike strong sub sup time tt u var wbr br".split()
)
ENDS_PARAGRAPH_NOT = INLINE | RAW | {"input", "select", "button", "option", "object", "audio", "video", "svg", "canvas", "map"}
#: A start tag closes an open element of the same group, up to the element that holds the group.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
NO_TEXT = frozenset(
    "head nav footer aside form menu button select datalist dialog object svg math canvas audio video applet "
    "fieldset".split()
)
NO_TEXT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog toolbar".split())
NO_TEXT_WORDS = frozenset(
    "ad ads advert adverts advertisement adsense banner sponsor sponsored promo sidebar aside nav navbar navigation menu breadcrumb "
    "breadcrumbs footer header masthead topbar cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup comment comments disqus respond reply replies related recommended share sharing social "
    "widget pagination pager toolbar login search skip disclaimer copyright".split()
)
#: A token with one of these says what is beside the element or missing, not what it is.
DENIALS = frozenset("no not non without with has have hide hides hidden layout".split())
#: The head of an entry holds its title.
HEADS, ENTRY = frozenset(("header", "masthead")), frozenset("entry post article story content title".split())
ARTICLE = frozenset(("article", "main"))
PLAIN = frozenset("article main p h1 h2 h3 h4 h5 h6 blockquote pre".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?P<closed>>?)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_WORD = re.compile(r"[a-z]+")
_DIGITS, _NUMBER = re.compile(r"\d+"), re.compile(r"\d{3,}")


@dataclass(slots=True)
class Node:
    tag: str
    path: str
    depth: int
    #: No text of an article in here, whatever the tree says.
    outside: bool
    in_article: bool
    children: list[str]
    #: Paths of this node and its ancestors that the tree may remove.
    removable: tuple[str, ...]
    #: The innermost node, this one or an ancestor, that is named like no part of an article.
    named: Node | None = None
    #: Of a node so named, the next one outside it.
    named_above: Node | None = None
    #: The outermost article that this node is in.
    article: Node | None = None


@dataclass(slots=True)
class Block:
    node: Node
    text: str


def _names_no_article(value: str) -> bool:
    for token in value.split():
        parts = _NAME_WORD.findall(token)
        if parts and DENIALS.isdisjoint(parts):
            if any(x in NO_TEXT_WORDS and not (x in HEADS and not ENTRY.isdisjoint(parts)) for x in (parts[0], parts[-1])):
                return True
    return False


def _open(tag: str, rest: str, parent: Node | None) -> Node:
    classes, role, named = [], "", False
    if "=" in rest:
        for name, *values in _ATTRIBUTE.findall(rest):
            value = next((v for v in values if v), "").lower()
            if name.lower() == "role":
                role = value.strip()
            else:
                named = named or _names_no_article(value)
                if name.lower() == "class":
                    classes = sorted(_NUMBER.sub("N", value).replace("/", "_").split())
    label = ".".join([tag, *classes])
    if parent is None:
        return Node(tag, label, 1, tag in NO_TEXT, tag in ARTICLE, [], ())
    parent.children.append(label)
    in_article = parent.in_article or tag in ARTICLE or role == "main"
    outside = (
        parent.outside or tag in NO_TEXT or role in NO_TEXT_ROLES or (tag == "header" and not parent.in_article)
    )
    named = named and tag not in ("html", "body")
    deep = parent.depth >= MAX_DEPTH
    path = parent.path if deep else f"{parent.path}/{label}"
    plain = tag in ("html", "body") or (in_article and tag in PLAIN)
    node = Node(tag, path, parent.depth + 1, outside, in_article, [], parent.removable if plain or deep else (*parent.removable, path))
    node.named, node.named_above = (node, parent.named) if named else (parent.named, None)
    node.article = parent.article or (node if in_article and not named else None)
    return node


def parse(html: str) -> tuple[list[Block], list[Node]]:
    """Blocks of text in page order, and all nodes that hold blocks or nodes."""
    root = Node("", "", 0, False, False, [], ())
    stack, nodes, blocks, run = [root], [root], [], []
    # Where in the stack each tag is open, and the open nodes that are no inline elements: nothing walks the stack.
    places: defaultdict[str, list[int]] = defaultdict(list)
    owners = [root]

    def innermost(tags: set[str]) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def flush() -> None:
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                # The innermost node that is no inline element owns the block.
                blocks.append(Block(owners[-1], text))

    def pop_to(index: int) -> None:
        if any(n.tag not in INLINE for n in stack[index:]):
            flush()
        while len(stack) > index:
            gone = stack.pop()
            places[gone.tag].pop()
            if gone is owners[-1]:
                owners.pop()

    at, lower = 0, None
    while True:
        found = _TOKEN.search(html, at)
        text = html[at : found.start() if found else len(html)]
        if text:
            run.append(entities.unescape(text) if "&" in text else text)
        if not found:
            break
        at, tag = found.end(), found["tag"]
        if tag is None:
            continue
        if not found["closed"]:
            # A tag that the page does not finish; anything else with '<' is text.
            if at < len(html):
                run.append(found[0])
            continue
        tag = tag.lower()
        if found["end"]:
            if places[tag]:
                pop_to(places[tag][-1])
            continue
        if tag in RAW:
            lower = html.lower() if lower is None else lower
            end = lower.find(f"</{tag}", at)
            while end >= 0 and lower[end + len(tag) + 2 : end + len(tag) + 3] not in ("", " ", ">", "/", "\t", "\n", "\r", "\f"):
                end = lower.find(f"</{tag}", end + 1)
            close = html.find(">", end) if end >= 0 else -1
            at = close + 1 if close >= 0 else len(html)
            continue
        if tag in VOID:
            if tag == "br":
                run.append(" ")
            elif tag not in INLINE:
                flush()
            continue
        if tag in SIBLINGS:
            same, limit = SIBLINGS[tag]
            while (index := innermost(same)) > innermost(limit):
                pop_to(index)
                if tag != "tr":
                    break
        if tag not in ENDS_PARAGRAPH_NOT:
            if places["p"]:
                pop_to(places["p"][-1])
            flush()
        if found["rest"].endswith("/") and tag in ("svg", "path", "math"):
            continue
        node = _open(tag, found["rest"], stack[-1])
        places[tag].append(len(stack))
        stack.append(node)
        if tag not in INLINE:
            nodes.append(node)
            owners.append(node)
    flush()
    return blocks, nodes


def _unnamed(blocks: list[Block]) -> list[Block]:
    """Without the branches that are named like no part of an article, unless they hold the page's article or most of its text."""
    if not any(b.node.named for b in blocks):
        return blocks
    articles: Counter[int] = Counter()
    held: Counter[int] = Counter()
    known: dict[int, Node] = {}
    for b in blocks:
        if b.node.article:
            articles[id(b.node.article)] += len(b.text)
            known[id(b.node.article)] = b.node.article
        if b.node.named:
            held[id(b.node.named)] += len(b.text)
    named = _named_above({id(b.node.named): b.node.named for b in blocks if b.node.named})
    if articles:
        article = known[articles.most_common(1)[0][0]]
        stay = {id(n) for n in _named_above({0: article.named} if article.named else {})}
    else:
        total = sum(len(b.text) for b in blocks)
        for node in reversed(named):
            if node.named_above:
                held[id(node.named_above)] += held[id(node)]
        stay = {k for k, n in held.items() if 2 * n > total}
    kept = {0}
    for node in named:
        if id(node) in stay and (id(node.named_above) if node.named_above else 0) in kept:
            kept.add(id(node))
    return [b for b in blocks if (id(b.node.named) if b.node.named else 0) in kept]


def _named_above(nodes: dict[int, Node]) -> list[Node]:
    """The nodes and all so named around them, outer ones first."""
    found: dict[int, Node] = {}
    for node in nodes.values():
        while node and id(node) not in found:
            found[id(node)] = node
            node = node.named_above
    return sorted(found.values(), key=lambda n: n.depth)


def article_text(html: str | None, removed: frozenset[str]) -> str:
    """The blocks that neither HTML nor the host's tree takes out, one per line."""
    if not html:
        return ""
    blocks = _unnamed([b for b in parse(html)[0] if not b.node.outside])
    inner = [b for b in blocks if b.node.in_article]
    return "\n".join(b.text for b in inner or blocks if removed.isdisjoint(b.node.removable))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def page_features(html: str, host: str = "") -> set[tuple[str, int, int]]:
    """(path, kind, feature) of one page: kind 0, the child sequences of a path's first node; kind 1, its texts."""
    blocks, nodes = parse(html)
    found, seen = set(), set()
    for node in nodes:
        if node.path not in seen:
            seen.add(node.path)
            shown = [c for i, c in enumerate(node.children) if i == 0 or c != node.children[i - 1]]
            found.add((node.path, 0, _hash(" ".join(shown))))
    for b in blocks:
        text = b.text.replace(host, "") if host else b.text
        found.add((b.node.path, 1, _hash(_DIGITS.sub("N", text))))
    return found


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts: Counter[tuple] = Counter()
        for host, html in zip(b["host"].to_pylist(), b["html"].to_pylist()):
            if html:
                counts.update((host, *f) for f in page_features(html, host))
        columns = list(zip(*counts)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int32()),
             pa.array(columns[3], pa.int64()), pa.array(list(counts.values()), pa.int64())],
            ["host", "path", "kind", "feature", "n"],
        )


def _importance(counts: DataFrame, tree: list[str]) -> DataFrame:
    """(tree..., path, pages, importance) of every node from (tree..., path, kind, feature, n)."""
    node = [*tree, "path"]
    n, total = F.col("n"), F.sum("n")
    shown = counts.where("kind = 0").groupBy(*node).agg(
        total.alias("pages"), F.count("*").alias("looks"), F.sum(n * F.log(n)).alias("n_log_n")
    )
    log_pages = F.log("pages")
    own = F.when(F.col("pages") > 1, (log_pages - F.col("n_log_n") / F.col("pages")) / log_pages).otherwise(1.0)
    shown = shown.select(*node, "pages", "looks", own.alias("own"))
    texts = counts.where("kind = 1").groupBy(*node).agg(total.alias("shows"), F.sum(n * F.log(n)).alias("n_log_n"))
    texts = texts.join(shown.select(*node, "pages"), node).withColumn(
        "worth", F.when(F.col("pages") > 1, F.col("shows") - F.col("n_log_n") / log_pages).otherwise(F.col("shows"))
    )
    below = texts.select(*tree, F.explode(_and_above("path")).alias("path"), "shows", "worth").groupBy(*node).agg(
        (F.sum("worth") / F.sum("shows")).alias("content")
    )
    weight = F.pow(F.lit(PRESENTATION), F.col("looks"))
    # Where a node never changes its looks, only content can tell.
    mixed = F.when(F.col("looks") == 1, F.col("content")).otherwise((1 - weight) * F.col("content") + weight * F.col("own"))
    return shown.join(below, node).select(*node, "pages", F.greatest(F.lit(0.0), mixed).alias("importance"))


def _and_above(path: str) -> Column:
    """The path of a node and those of all nodes above it."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))


def host_of(url: Column) -> Column:
    return F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1)


def low_branches(pages: DataFrame) -> DataFrame:
    """(host, removed): the paths of low importance of every host. ``pages``: url, html."""
    # Kept, because both trees read the counts twice, and each reading would parse all pages again.
    counts = stored(pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(
        _feature_batches, "host string, path string, kind int, feature bigint, n bigint"
    ).groupBy("host", "path", "kind", "feature").agg(F.sum("n").alias("n")))
    own = _importance(counts, ["host"])
    every = _importance(counts.groupBy("path", "kind", "feature").agg(F.sum("n").alias("n")), []).select(
        "path", F.col("pages").alias("all_pages"), F.col("importance").alias("all_importance")
    )
    enough = F.col("pages") >= MIN_PAGES
    low = F.least(
        F.when(enough, F.col("importance")).otherwise(1.0),
        F.when(F.col("all_pages") >= MIN_PAGES, F.col("all_importance")).otherwise(1.0),
    )
    highest = own.join(every, "path").select("host", F.explode(_and_above("path")).alias("path"), low.alias("low")).groupBy(
        "host", "path"
    ).agg(F.max("low").alias("highest"))
    return highest.where(F.col("highest") < LOW_IMPORTANCE).groupBy("host").agg(
        F.sort_array(F.collect_list("path")).alias("removed")
    )


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html)."""

    @F.arrow_udf("string")
    def text(html: pa.Array, removed: pa.Array) -> pa.Array:
        known: dict[tuple, frozenset] = {}
        out = []
        for page, paths in zip(html.to_pylist(), removed.to_pylist()):
            paths = tuple(paths or ())
            out.append(article_text(page, known.setdefault(paths, frozenset(paths))))
        return pa.array(out, pa.string())

    pages = pages.select("page_id", "url", "html")
    # Written first, so that Spark knows its size: small, it is broadcast and no page is shuffled.
    low = stored(low_branches(pages))
    joined = pages.withColumn("host", host_of(F.col("url"))).join(low, "host", "left")
    return joined.select("page_id", "url", text("html", "removed").alias("text")).withColumn(
        "n_chars", F.length("text").cast("bigint")
    )
