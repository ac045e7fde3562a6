"""Main text of web pages by composite text density.

A page becomes a tree of its elements. Every element's density is its characters per tag, weighted by how few of them
are in links (composite text density); an element's sum is that of its children's densities. The element with the
largest sum in the page is the core of the article. The least density on its path to the body is the threshold: the core
grows to the closest element that holds all elements beside the path as dense as that, and no further than an
``article`` or ``main`` around it. Parts that markup declares to be something else (navigation, footers, forms, adverts,
comments and the like, by tag, role, class or id) are left out before densities are taken.

Rows: a null or empty page, and one without text, gives an empty text; repeated rows are worked alike; broken markup is
read as browsers do, roughly: a block ends an open paragraph, missing end tags end with their parents; a page is read in
one pass, in time proportional to its length; other columns stay, ``_text`` is replaced.
"""

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamarack.llm.workers import prepare

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Elements of HTML by how they are read.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
HEAD = set("title meta link script style base noscript template".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: These may be in a paragraph's place but do not end it.
IN_TABLES = set("option legend summary figcaption td th tr tbody thead tfoot".split())
#: A start tag ends an open one of these, up to the element that may hold both.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}), "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
# What is no part of an article.
OTHER_TAGS = set(
    "head script style noscript template iframe object embed svg canvas audio video nav footer aside form button select textarea input dialog menu noembed noframes xmp "
    "title datalist map search".split()
)
OTHER_ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist status".split())
OTHER_NAMES = set(
    "ad ads adv advert adverts advertisement advertisements advertising sponsor sponsors sponsored promo promos promotion promoted banner banners nav navbar navigation menu menus "
    "breadcrumb breadcrumbs sidebar sidebars aside widget widgets footer masthead toolbar pager pagination comment comments commentlist disqus reply replies respond reactions "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing shares social related recommended "
    "recommendations outbrain taboola skip disclaimer copyright legal privacy header topbar adbox adslot adunit".split()
)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


#: The share of link characters beyond which a part beside the core's path is a list of links.
LINKS = 0.5


class Page:
    """The elements of a page in order (parent, tag, whether markup says that it is no part of an article) and its texts."""

    def __init__(self, markup: str):
        self.parent, self.tag, self.other, self.named = [-1], ["body"], [False], [False]
        self.texts = []  # (element, block, text); a block ends where an element of BLOCKS starts or ends
        self.block, self.open, self.count = 0, [0], {}
        at = 0
        while token := TOKEN.search(markup, at):
            self._say(markup[at:token.start()])
            at = token.end()
            tag = (token[2] or "").lower()
            if token[1]:
                self._end(tag)
            elif tag:
                self._start(tag, token[3])
                if tag in RAW:  # up to its end tag, or the page's
                    end = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(markup, at)
                    self._say(markup[at:end.start() if end else len(markup)])
                    at = end.start() if end else len(markup)
        self._say(markup[at:])
        self._keep_wrappers()

    def _say(self, text: str) -> None:
        if text:
            self.texts.append((self.open[-1], self.block, html.unescape(text)))

    def _start(self, tag: str, attributes: str) -> None:
        if tag not in HEAD:
            self._close({"head"}, set())
        if tag in ("html", "body"):
            return
        if tag in BLOCKS and tag not in IN_TABLES:
            self._close({"p"}, BLOCKS)
        if tag in ENDS:
            self._close(*ENDS[tag])
        self.block += tag in BLOCKS
        if tag == "br":
            self._say(" ")
        by_tag, by_name = declared_other(tag, attributes, bool(self.count.get("article") or self.count.get("main")))
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        self.other.append(by_tag or by_name)
        self.named.append(by_name and not by_tag)
        if tag not in VOID:
            self.open.append(len(self.tag) - 1)
            self.count[tag] = self.count.get(tag, 0) + 1

    def _end(self, tag: str) -> None:
        self._close({tag}, set() if tag in BLOCKS else BLOCKS)  # an inline end tag ends no block

    def _close(self, tags: set, within: set) -> None:
        """Ends the innermost open element of ``tags`` and all in it, unless one of ``within`` lies between."""
        if not any(self.count.get(t) for t in tags):
            return
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.tag[self.open[i]]
            if tag in tags:
                for element in self.open[i:]:
                    self.count[self.tag[element]] -= 1
                del self.open[i:]
                self.block += 1 if tag in BLOCKS else 0
                return
            if tag in within:
                return

    def _keep_wrappers(self) -> None:
        """A class or id such as has-sidebar on what holds the article's own elements does not make it something else."""
        core = [t in ("main", "h1") or t == "article" and not n for t, n in zip(self.tag, self.named)]
        for i in range(len(core) - 1, 0, -1):
            if core[i]:
                core[self.parent[i]] = True
                if self.named[i]:
                    self.other[i] = False


def declared_other(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """Whether an element is no part of an article by its tag or state, and whether by its class or id."""
    if tag in OTHER_TAGS or tag == "header" and not in_article:
        return True, False
    if not attributes.strip() or tag == "main":
        return False, False
    given = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(attributes)}
    if "hidden" in given or HIDDEN.search(given.get("style", "").lower()) or given.get("role", "").lower() in OTHER_ROLES:
        return True, False
    names = f"{given.get('class', '')} {given.get('id', '')}"
    return False, any(part.lower() in OTHER_NAMES for part in NAME_PARTS.findall(names))


def density(chars: int, link_chars: int, tags: int, link_tags: int, body_ratio: float) -> float:
    """Composite text density: characters per tag, weighted by a logarithm that links make small."""
    if not chars:
        return 0.0
    base = math.log(chars * (link_chars or 1) / ((chars - link_chars) or 1) + body_ratio * chars + math.e)
    return chars / (tags or 1) * math.log(chars / (link_chars or 1) * (tags or 1) / (link_tags or 1)) / math.log(base)


def main_text(markup: str | None) -> str:
    page = Page(markup or "")
    parent, n = page.parent, len(page.parent)
    out, in_link = [False] * n, [False] * n  # by inheritance; parents come first
    for i in range(n):
        above = parent[i]
        out[i] = page.other[i] or above >= 0 and out[above]
        in_link[i] = page.tag[i] == "a" or above >= 0 and in_link[above]
    own = [0] * n
    for element, _, text in page.texts:
        if not out[element]:
            own[element] += len(" ".join(text.split()))
    chars, link_chars, tags, link_tags, headed = own[:], [c if a else 0 for c, a in zip(own, in_link)], [0] * n, [0] * n, [t == "h1" for t in page.tag]
    for i in range(n - 1, 0, -1):
        if not out[i]:
            above = parent[i]
            chars[above] += chars[i]
            link_chars[above] += link_chars[i]
            tags[above] += tags[i] + 1
            link_tags[above] += link_tags[i] + (page.tag[i] == "a")
            headed[above] |= headed[i]
    if not chars[0]:
        return ""
    ratio = link_chars[0] / chars[0]
    dense = [0.0 if out[i] else density(chars[i], link_chars[i], tags[i], link_tags[i], ratio) for i in range(n)]
    words = [density(own[i], own[i] if in_link[i] else 0, 1, int(in_link[i]), ratio) for i in range(n)]  # an element's own text, as one more child
    sums = words[:]
    for i in range(1, n):
        if not out[i]:
            sums[parent[i]] += dense[i]
    core = max((i for i in range(n) if not out[i]), key=lambda i: (sums[i], i))

    path = [core]
    while path[-1]:
        path.append(parent[path[-1]])
    least, on_path = min(dense[i] for i in path), set(path)
    beside = {i: [] for i in path[1:]}
    for i in range(1, n):
        if parent[i] in beside and i not in on_path and not out[i] and chars[i]:
            beside[parent[i]].append(i)
    top = core
    for below, above in zip(path, path[1:]):
        if page.tag[below] in ("article", "main"):
            break
        if words[above] >= least or any(dense[i] >= least or headed[i] for i in beside[above]):
            top = above
    lists = {i for a in path[1:path.index(top) + 1] for i in beside[a] if dense[i] < least and not headed[i] and link_chars[i] > LINKS * chars[i]}
    inside = [False] * n
    for i in range(n):
        inside[i] = not out[i] and i not in lists and (i == top or i > 0 and inside[parent[i]])
    blocks = {}
    for element, block, text in page.texts:
        if inside[element]:
            blocks.setdefault(block, []).append(text)
    return "\n".join(filter(None, (" ".join("".join(parts).split()) for parts in blocks.values())))


def with_main_text(pages: DataFrame) -> DataFrame:
    """The table with ``_text``, one pass over its ``html``."""
    prepare(pages.sparkSession)
    pages = pages.drop("_text")
    names = pages.columns

    def extract(batches):
        for batch in batches:
            texts = [main_text(markup) for markup in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "_text"])

    return pages.mapInArrow(extract, pages.select("*", F.lit("").alias("_text")).schema)
