"""HTML extraction with site template removal.

1. A tolerant parser builds the element tree (void and raw-text elements, implied ends of p, li, td, ...;
   unclosed and truncated markup end where their parent ends; a tag with a stray quote ends at the next bracket), in
   time linear in the page however its tags are nested. Nothing is dropped yet.
2. Every subtree that could be a part of a site's template is hashed (name, own text, children, in order; the
   host salts the hash): menus, headers, footers, sidebars, forms, scripts, styles, adverts, blocks, lists. Spark
   counts, for each host, on how many pages with different main text each occurs. A copy of an article is no
   evidence of a template, so pages of equal main text count once. A block outside of articles whose text is all
   in links is hashed by its skeleton, too (names alone, runs of equal children once), so that a menu whose links
   change from page to page is found as well.
3. Subtrees on at least `least_pages` such pages of their host, and on a share of the host's pages, are the
   site's template and are deleted. The share is `least_share` for elements that hold no running text of a page
   by their nature (nav, footer, form, script, ..., not a header in an article; outside of articles, blocks whose text is all in links)
   and `large_share` for all others, skeletons included: a site may write its paragraphs as `div`. Never deleted alone: inline elements, headings, parts of lists and tables (but items of links outside
   of articles), articles, main; inside an article, anything but such elements and containers.
4. Pages whose host gives no evidence, and parts that occur once, are left to their own marks: elements that are no
   content by definition go, and elements of which a whole token of class, id or role names a menu, an advert, a
   notice, reader comments or the like. Names of headers and of related stories or searches count only where
   the element has neither a heading of the first level nor running text (`RUNNING` words in a block, outside
   links). A named element stays if it holds main, or an article while no article stands outside of such elements.
   A form stays that holds an article, main, or most of the page's text. The content root is the article (or main)
   elements where the page has any with text, else the body. An article named a comment is none.
5. Text: character references decoded, white space inside a block to one space, trimmed, blocks joined in
   page order by one space.

Counts combine before the shuffle and only hashes are shuffled, never pages. The template hashes of all hosts are
broadcast as one sorted array up to `BROADCAST_TEMPLATES` (8 bytes each); beyond, each page gets its own by a join
on two hashes of its url and html. Both ways give the same texts.

Defined results: null, empty or textless pages give an empty text; a page without a host belongs to the
host ""; null page ids stay null; repeated rows are pages each (and count once as evidence, being equal); an
empty table gives no rows; further columns are ignored; whole pages are read, however long or deep (no recursion).
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, read

LEAST_PAGES, LEAST_SHARE, LARGE_SHARE = 5, 0.02, 0.5
#: Template subtrees up to which they are broadcast.
BROADCAST_TEMPLATES = 4_000_000
#: Words in a block, outside links, that make running text.
RUNNING = 12
#: Words that a form must hold beside its labels and controls, and more than the rest of the page, to be the page.
FORM_WORDS = 25

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Never content. A form is none either, unless it is the page.
DROPPED = frozenset(
    "script style noscript template head title iframe noembed noframes object embed canvas svg annotation annotation-xml nav aside footer button select option textarea input label dialog menu audio video map".split()
)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr nobr".split())
#: Formulas stand in sentences.
INLINE |= frozenset("math semantics mrow mi mo mn ms mtext mspace mfrac msqrt mroot msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd mstyle mpadded mphantom menclose".split())
#: Elements that can be a template of their own.
CONTAINERS = frozenset("div section address details fieldset center hgroup search".split())
BLOCKS = CONTAINERS | frozenset("p blockquote pre ul ol dl table figure".split())
#: Never running text of a page, so little evidence is enough.
FRAME = frozenset("nav aside footer header form dialog menu script style noscript template iframe select object svg".split())
#: Start tags that end an open element of these names, up to the nearest of the limits.
ENDS = {
    **dict.fromkeys("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(), ({"p"}, {"article", "aside", "body", "div", "footer", "header", "main", "nav", "section", "td", "th", "li", "blockquote", "button"})),
    "li": ({"li", "p"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd", "p"}, {"dl"}),
    "dd": ({"dt", "dd", "p"}, {"dl"}),
    "tr": ({"tr", "td", "th", "p"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th", "p"}, {"tr"}),
    "th": ({"td", "th", "p"}, {"tr"}),
    "option": ({"option"}, {"select"}),
}
#: Tokens of class, id and role that name what is no content: a word, places before it, parts after it.
_WORD = (
    r"(?:ads?|adv|advert(?:s|isements?|ising)?|adsense|sponsor(?:ed)?|promo(?:tion)?s?|banner|cookies?|consent|gdpr|notices?|newsletter|subscribe|subscription|popup|modal|"
    r"side-?bar|menus?|nav|navbar|navigation|breadcrumbs?|toolbar|footer|foot|comments?|respond|disqus|replies|share|sharing|social|widgets?|skip-?link|contentinfo|complementary|paywall)"
)
#: Names that hold for elements without running text only.
_WEAK = r"(?:related|recommend(?:ed|ations)?|search|log-?in|sign-?(?:in|up))"
_BEFORE = r"(?:(?:site|page|main|top|bottom|left|right|primary|secondary|global|blog|post|entry|article|user|reader|sticky|mobile|google|wp|block|js)[-_]+)*"
_AFTER = r"(?:[-_]*(?:box|slot|unit|container|wrapper|wrap|area|list|bar|block|section|inner|outer|items?|links?|buttons?|icons?|form|posts?|articles?|stories|content|text|message|overlay|left|right|top|bottom|primary|secondary|[0-9]++(?:x[0-9]++)?))*"
NOISE = re.compile(rf"{_BEFORE}{_WORD}(?:[-_]+{_WORD})*{_AFTER}(?:--.*)?", re.S)
WEAK = re.compile(rf"{_BEFORE}{_WEAK}(?:[-_]+(?:{_WEAK}|{_WORD}))*{_AFTER}(?:--.*)?", re.S)
#: Tokens that name an article a reader's comment.
COMMENT = re.compile(r"(?:(?:user|reader)[-_]+)?(?:comments?|repl(?:y|ies))(?:[-_]*(?:body|item|box|text|content|wrap|inner|[0-9]++))*(?:--.*)?", re.S)
#: Tokens that name a page's header: like the header element, content inside an article.
HEADER = re.compile(r"(?:(?:site|page|main|top|global|blog)[-_]*)?(?:header|masthead)(?:[-_]*(?:container|wrapper|wrap|inner|outer|top|bottom))*(?:--.*)?", re.S)
#: Comments and the like, and tags. A quoted value ends at a quote that white space, a slash or the tag's end follows;
#: where there is none, a quote was stray and the tag ends at the next bracket.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"(?=[\s/>]|\Z)|'[^']*+'(?=[\s/>]|\Z)|(?![\"'])))*+(?=>|\Z)|[^>]*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"(?:^|[\s/])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: A slash before a tag's end that is no part of an unquoted value.
SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/\Z")
HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")


class Node:
    __slots__ = ("name", "noise", "weak", "headed", "parent", "children", "digest", "skeleton", "links", "plain")

    def __init__(self, name: str, parent, noise: bool = False, weak: bool = False, headed: bool = False):
        self.name, self.parent, self.children = name, parent, []
        self.noise, self.weak, self.headed = noise, weak, headed
        self.digest, self.skeleton, self.links, self.plain = 0, 0, 0, False


class _Open:
    """The elements that are open, outermost first, and the depths of those of each name: no walk goes up the tree."""

    def __init__(self, root: Node):
        self.nodes, self.depths = [root], defaultdict(list)

    def push(self, node: Node) -> None:
        self.depths[node.name].append(len(self.nodes))
        self.nodes.append(node)

    def close(self, depth: int) -> None:
        """Closes the element of that depth and all inside it."""
        while len(self.nodes) > depth:
            self.depths[self.nodes.pop().name].pop()

    def nearest(self, names) -> int:
        """Depth of the innermost element of these names, 0 if none is open."""
        return max((d[-1] for name in names if (d := self.depths.get(name))), default=0)

    def outermost(self, names, below: int) -> int:
        """Depth of the outermost element of these names that is deeper than below, 0 if there is none."""
        return min((d[k] for name in names if (d := self.depths.get(name)) and (k := bisect_right(d, below)) < len(d)), default=0)


_CELLS = ("td", "th", "table")


def parse(page: str) -> Node:
    """The tree; children are nodes and strings of raw text. Takes time in proportion to the page (times the logarithm of its depth)."""
    root = Node("#root", None)
    at, n, opened = 0, len(page), _Open(root)
    while at < n:
        here = opened.nodes[-1]
        m = TOKEN.search(page, at)
        if m is None:
            here.children.append(page[at:])
            break
        if m.start() > at:
            here.children.append(page[at : m.start()])
        at = max(m.end(), m.start() + 1)
        name = m[2]
        if name is None:
            continue
        name = name.lower()
        if m[1]:
            # an inline element is not closed from inside a table or a cell of one
            if (depth := opened.nearest((name,))) and not (name in INLINE and opened.nearest(_CELLS) > depth):
                opened.close(depth)
            continue
        if (rule := ENDS.get(name)) and (depth := opened.outermost(rule[0], opened.nearest(rule[1]))):
            opened.close(depth)
            here = opened.nodes[-1]
        attributes = m[3]
        node = Node(name, here)
        if attributes and name not in ("html", "body", "main") and (tokens := [t for a, b, c in ATTRIBUTE.findall(attributes) for t in (a or b or c).lower().split()]):
            if name == "article":
                node.noise = any(map(COMMENT.fullmatch, tokens))
            else:
                node.noise, node.weak, node.headed = any(map(NOISE.fullmatch, tokens)), any(map(WEAK.fullmatch, tokens)), any(map(HEADER.fullmatch, tokens))
        here.children.append(node)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*+(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
        elif name not in VOID and not SELF_CLOSED.search(attributes):
            opened.push(node)
    return root


def _dropped(node: Node, inside: bool, running: set[int]) -> bool:
    return node.name in DROPPED or node.noise or node.name == "header" and not inside or (node.weak or node.headed and not inside) and id(node) not in running


def _running(root: Node) -> set[int]:
    """The named elements (by id) that have running text in a block, outside links, or a heading of the first level."""
    stack, post = [root], []
    while stack:
        node = stack.pop()
        post.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    out: set[int] = set()
    if not any(node.weak or node.headed for node in post):
        return out
    # of what is inside an element: words up to its first block, after its last, most in a block between, whether there is a block, a heading
    inner: dict[int, tuple[int, int, int, bool, bool]] = {}
    for node in reversed(post):
        head, words, best, split, headed = 0, 0, 0, False, False
        for c in node.children:
            if isinstance(c, str):
                words += len(c.split())
            elif c.name == "h1":
                headed = True
            elif c.name != "a" and c.name not in DROPPED and not c.noise:
                first, last, most, parted, has = inner[id(c)]
                headed = headed or has
                if c.name in INLINE and not parted:
                    words += first
                    continue
                if c.name in INLINE:
                    words, after = words + first, last
                else:
                    most, after = max(most, first, last), 0
                head, best, split, words = head if split else words, max(best, words, most), True, after
        inner[id(node)] = (head if split else words, words if split else 0, best, split, headed)
        if (node.weak or node.headed) and (node.name == "h1" or node.name != "a" and (headed or max(head, words, best) >= RUNNING)):
            out.add(id(node))
    return out


def _forms(root: Node) -> None:
    """Marks the forms that are not the page: without article or main, and not with most of its text."""
    forms, todo, texts = [], [(root, None)], []
    held: dict[int, list] = {}
    while todo:
        node, form = todo.pop()
        for c in node.children:
            if isinstance(c, str):
                texts.append((c, form))
            elif c.name == "form":
                forms.append(c)
                held[id(c)] = [0, False]
                todo.append((c, c))
            elif c.name not in DROPPED:
                if form is not None and c.name in ("article", "main"):
                    held[id(form)][1] = True
                todo.append((c, form))
    if not forms:
        return
    every = 0
    for c, form in texts:
        n = len(c.split())
        every += n
        if form is not None:
            held[id(form)][0] += n
    for f in forms:
        words, article = held[id(f)]
        f.noise = not (article or words >= FORM_WORDS and 2 * words > every)


def _keep_around(root: Node) -> None:
    """Unmarks named elements that hold main, or an article while no article with text stands outside of them."""
    held: dict[str, list[Node]] = {"article": [], "main": []}
    outside, todo = False, [(root, False, False)]
    while todo:
        node, named, inside = todo.pop()
        for c in node.children:
            if isinstance(c, str) or c.name in DROPPED or c.name == "header" and not inside:
                continue
            below = named or c.noise or c.weak or c.headed and not inside
            if c.name in held and not c.noise:
                if below:
                    if not inside:
                        held[c.name].append(c)
                elif c.name == "article" and not inside:
                    outside = outside or _has_text(c)
            todo.append((c, below, inside or c.name == "article"))
    seen: set[int] = set()
    for c in held["main"] + ([] if outside else held["article"]):
        node = c.parent
        while node is not None and id(node) not in seen:
            seen.add(id(node))
            node.noise = node.weak = node.headed = False
            node = node.parent


def content(root: Node) -> list[Node]:
    """The content roots of a tree. It is pruned in place."""
    _forms(root)
    _keep_around(root)
    running = _running(root)
    articles, mains, todo = [], [], [(root, False, False)]
    while todo:
        node, in_article, in_main = todo.pop()
        kept = []
        for c in node.children:
            if isinstance(c, str):
                kept.append(c)
            elif not _dropped(c, in_article, running):
                kept.append(c)
                is_article, is_main = c.name == "article", c.name == "main"
                if is_article and not in_article:
                    articles.append(c)
                if is_main and not in_main:
                    mains.append(c)
                todo.append((c, in_article or is_article, in_main or is_main))
        node.children = kept
    articles, mains = _in_order(root, articles), _in_order(root, mains)
    for found in (articles, mains):
        if found := [x for x in found if _has_text(x)]:
            return found
    return [root]


def _in_order(root: Node, nodes: list[Node]) -> list[Node]:
    """Page order: the pruning walk goes backwards among siblings."""
    if len(nodes) < 2:
        return nodes
    wanted, out, todo = {id(x) for x in nodes}, [], [root]
    while todo:
        node = todo.pop()
        if id(node) in wanted:
            out.append(node)
            continue
        todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def _squeezed(text: str) -> str:
    """A string that is not empty, with each run of white space as one space."""
    words = " ".join(text.split())
    return f"{' ' * text[0].isspace()}{words}{' ' * text[-1].isspace()}" if words else " "


def digest(root: Node, host: str) -> None:
    """Sets the hashes of every element's subtree and skeleton, salted with the host, and what its text is like."""
    stack, post = [root], []
    while stack:
        node = stack.pop()
        post.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    for node in reversed(post):
        name = node.name
        parts, shape, last = [host, name], [host, name], None
        links, plain = 0, False
        for c in node.children:
            if isinstance(c, str):
                parts.append(_squeezed(c))
                plain = plain or not c.isspace()
            else:
                parts.append(f"\x00{c.digest:x}")
                links, plain = links + c.links, plain or c.plain
                if c.skeleton != last:
                    last = c.skeleton
                    shape.append(f"{last:x}")
        node.links, node.plain = (1, False) if name == "a" else (links, plain)
        node.digest = xxhash.xxh64_intdigest("\x01".join(parts)) - 2**63
        node.skeleton = xxhash.xxh64_intdigest("\x01".join(shape), 1) - 2**63


def template_keys(node: Node, inside: bool) -> tuple[int, ...]:
    """What is counted of a subtree that could be deleted: odd where the least share is enough, else even."""
    name = node.name
    if not node.children:
        return ()
    if name in FRAME:
        return (node.digest & -2 if inside and name == "header" else node.digest | 1,)
    if inside:
        return (node.digest & -2,) if name in CONTAINERS else ()
    if node.links and not node.plain:
        if name == "li":
            return (node.digest | 1,)
        return (node.digest | 1, node.skeleton & -2) if name in BLOCKS and node.links > 1 else (node.digest | 1,) if name in BLOCKS else ()
    return (node.digest & -2,) if name in BLOCKS else ()


def _elements(root: Node):
    """(element, its parent, whether it is in an article), parents first."""
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        for c in node.children:
            if isinstance(c, Node):
                yield c, node, inside
                todo.append((c, inside or c.name == "article"))


def delete(root: Node, host: str, template: np.ndarray) -> int:
    """Deletes the template's subtrees (a sorted array of their keys) from a tree; the number of those deleted."""
    digest(root, host)
    each = [(c, parent, k) for c, parent, inside in _elements(root) for k in template_keys(c, inside)]
    if not each:
        return 0
    keys = np.array([k for _, _, k in each], np.int64)
    at = np.searchsorted(template, keys)
    gone = {id(each[i][0]): each[i] for i in np.flatnonzero(template[np.minimum(at, len(template) - 1)] == keys)} if len(template) else {}
    for parent in {id(p): p for _, p, _ in gone.values()}.values():
        parent.children = [c for c in parent.children if id(c) not in gone]
    return len(gone)


def _closed(line: list[str]) -> str:
    """The text of a block; it starts anew."""
    text = " ".join(entities.unescape("".join(line)).split())
    line.clear()
    return text


def _blocks(roots: list[Node]) -> Iterator[str]:
    """Texts of the blocks, in page order, some of them empty."""
    line, todo = [], list(reversed(roots))
    while todo:
        c = todo.pop()
        if isinstance(c, str):
            line.append(c)
        elif c is None:
            yield _closed(line)
        elif c.name == "br":
            line.append(" ")
        elif c.name in INLINE:
            todo += reversed(c.children)
        else:
            yield _closed(line)
            todo.append(None)
            todo += reversed(c.children)
    yield _closed(line)


def _has_text(root: Node) -> bool:
    return any(_blocks([root]))


def blocks(roots: list[Node]) -> list[str]:
    """Texts of the blocks, in page order."""
    return [text for text in _blocks(roots) if text]


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else ""


def candidates(page: str | None, url: str | None) -> tuple[int, set[int]]:
    """A hash of the page's main text and the keys of its subtrees that could be deleted."""
    root = parse(page or "")
    digest(root, host_of(url))
    found = {k for c, _, inside in _elements(root) for k in template_keys(c, inside)}
    return xxhash.xxh64_intdigest(" ".join(blocks(content(root)))) - 2**63, found


def text_of(page: str | None, url: str | None, template: np.ndarray) -> str:
    root = parse(page or "")
    if len(template):
        delete(root, host_of(url), template)
    return " ".join(blocks(content(root)))


def subtrees(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep.., host, page, key): hashes of the host and of the main text with each key of a page; the key is null once a page. keep: columns of longs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {}  # equal ones once
            for url, page, *own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h, found = candidates(page, url)
                host = xxhash.xxh64_intdigest(host_of(url)) - 2**63
                for k in (None, *found):
                    rows[*own, host, h, k] = None
            columns = list(zip(*rows, strict=True)) or [()] * (len(keep) + 3)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[*keep, "host", "page", "key"])

    return pages.select("url", "html", *keep).mapInArrow(run, ", ".join(f"{c} long" for c in (*keep, "host", "page", "key")))


def templates(found: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, large_share: float = LARGE_SHARE) -> DataFrame:
    """(key) of all hosts' templates; the host is part of the hash."""
    once = found.select("host", "page", "key").distinct().groupBy("host", "key").agg(F.count(F.lit(1)).alias("n"))
    hosts = once.filter("key is null").select("host", F.col("n").alias("pages"))
    often = once.filter(f"key is not null and n >= {least_pages}")
    return often.join(hosts, "host").filter(F.col("n") >= F.when(F.col("key") % 2 == 0, large_share).otherwise(least_share) * F.col("pages")).select("key").distinct()


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE, broadcast_limit: int = BROADCAST_TEMPLATES, large_share: float = LARGE_SHARE) -> DataFrame:
    """(page_id, url, text) of every row of pages."""
    spark = pages.sparkSession
    scratch = Scratch(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    found = scratch.save(subtrees(rows), "subtrees")
    template = scratch.save(templates(found, least_pages, least_share, large_share), "templates")
    scratch.drop(found)
    if template.count() <= broadcast_limit:
        keys = np.sort(template.toArrow().column("key").to_numpy())  # broadcast_limit at most
        shared = spark.sparkContext.broadcast(keys)
        scratch.drop(template)
        own = rows
    else:
        shared = None
        marked = rows.withColumn("h0", F.xxhash64("url", "html")).withColumn("h1", F.xxhash64(F.lit(1), "url", "html"))
        of_page = subtrees(marked, ("h0", "h1")).join(template, "key").groupBy("h0", "h1").agg(F.sort_array(F.collect_set("key")).alias("template"))
        own = marked.join(of_page, ["h0", "h1"], "left").select("page_id", "url", "html", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls, texts, sets = batch.column(1).to_pylist(), [], batch.column(3).to_pylist() if shared is None else None
            for k, (url, page) in enumerate(zip(urls, batch.column(2).to_pylist(), strict=True)):
                texts.append(text_of(page, url, shared.value if sets is None else np.array(sets[k] or (), np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return own.mapInArrow(run, "page_id long, url string, text string")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page of pages."""
    return extract(read(spark, sf_dir, "pages")).select("page_id", "url", F.coalesce("text", F.lit("")).alias("text"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))


#: The fixture's pages: the article's paragraphs and heading, with the references that occur there.
OP4_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|$)', 1), '</?[a-zA-Z][^>]*$', '') AS a FROM pages),
b AS (SELECT page_id, url, list_transform(string_split_regex(replace(a, '<br>', ' '), '</?(?:p|h1)>'),
  lambda x: trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS b FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(b, lambda x: x <> ''), ' ') AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
"""
