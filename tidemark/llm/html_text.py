"""Main text of web pages by template deduction from equivalence classes.

Pages of one host share a template. A page's tokens are its elements by path and its text blocks, those inside an
article as long as they are short. Tokens with the same occurrence vector, i.e. found equally often on the same pages of the host, form a
class. A class is part of the template if many pages have it; it is applied to a page only where its tokens come
in the template's order, and classes nest in it by their places. Text blocks in the template are the site's own
words, and so are texts that differ by their numbers only and stand among such words in elements of one path. Inside
an article such blocks go where they are the smaller part of it; where they are the larger part, the pages have
copies of one article. The article is then all that is left in the remaining slots. What menus, headers,
footers, sidebars, notices, adverts, forms and reader comments are called is known beforehand, since a host with one
page has no template. A wrapper that is called so but holds most of the page's text and an article is none of these,
nor is a form around an article or most of the text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_of
from tidemark.operators.ordered import small_side
from tidemark.session import cut_lineage

#: Share of a host's pages, and number of pages, that a template class needs.
LEAST_SHARE, LEAST_PAGES = 0.5, 3
#: Characters of a block inside an article that may be the site's own.
SITE_CHARS = 300

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup td th time tt u var wbr".split())
P_ENDS = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre search section table ul".split())
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset(("ul", "ol", "dl", "table", "menu", "select"))
#: Elements whose content is never article text, whole names in class or id, and roles.
DROPPED = frozenset("head nav header footer aside form button select menu dialog title template noscript iframe object svg math canvas audio video datalist".split())
NAMES = frozenset(
    "ad ads advert advertisement adverts advertising banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies disqus footer form gdpr header masthead menu menus modal nav navbar navigation newsletter notice notices pagination popup "
    "promo promoted promotion related replies respond share sharing sidebar sidebars skip social sponsor sponsored subscribe toolbar widget "
    "widgets".split())
#: Names of what others wrote or of other articles: never a wrapper of the page's own article.
OTHERS = frozenset("comment comments commentlist disqus promoted related replies respond sponsored".split())
#: Words that may stand beside such a name in an id. An id with any other word is the slug of a title.
LAYOUT = frozenset(
    "area bar block body bottom box button buttons col column container content count desktop fixed float global group head holder inner "
    "item items layout left link links list logo main mobile outer overlay page panel primary right row secondary section site slot sticky "
    "text title top wrap wrapper".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
ARTICLE = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_PARTS = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<(script|style|textarea|xmp|noembed|noframes)\b[^>]*>(?:.*?</\1\s*>|.*\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>|<[!?][^>]*>|<[a-zA-Z/][^>]*\Z""", re.S | re.I)
#: One attribute; its value is consumed with it, so that nothing in a value is taken for an attribute.
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_WORD = re.compile(r"[a-z]+|[0-9]+")
_SPACE = re.compile(r"\s+")
_NUMBER = re.compile(r"[0-9]+")


#: How an element's attributes rule it out: for good, or unless it wraps the page's article.
BY_NAME, AS_OTHERS = 1, 2


class Element(NamedTuple):
    tag: str
    path: str
    dropped: bool
    article: bool
    gone: bool  #: inside an element that is never article text, whatever it holds
    within: int  #: place of the innermost ruled-out element around it that may yet be a wrapper, or -1


class Ruled:
    """An element that is ruled out by its attributes, or a form: what decides whether it is a wrapper."""

    def __init__(self, number: int, parent: int, out: int):
        self.number, self.parent, self.out = number, parent, out
        self.has_article, self.direct, self.chars, self.others = False, 0, 0, 0

    def may_wrap(self) -> bool:
        return not self.out or (self.out == BY_NAME and self.has_article)


class Block(NamedTuple):
    text: str
    path: str
    tag: str
    dropped: bool
    article: bool


def _named_out(tag: str, classes: list[str], slug: str, in_article: bool) -> int:
    """Whether and how an element's classes or id rule it out.

    Inside an article whole names count only, since classes and ids there may come from its words; the article's own
    header is part of it. Outside, a class counts by its words, and an id whose words all speak of the page's layout.
    A heading's id is the slug of its text and says nothing. That a form is called one says nothing either.
    """
    names = classes if tag in HEADINGS else [*classes, slug]
    known = NAMES - {"form"} if tag == "form" else NAMES
    if in_article:
        whole = {name for name in names if name in known and name != "header"}
        return AS_OTHERS if whole & OTHERS else BY_NAME if whole else 0
    out = 0
    for place, name in enumerate(names):
        words = {w for w in _WORD.findall(name) if not w.isdigit()}
        if not words.isdisjoint(known):
            all_layout = words <= NAMES | LAYOUT
            if all_layout or place < len(classes):
                out = max(out, AS_OTHERS if all_layout and words & OTHERS else BY_NAME)
    return out


def _attributes(tag: str, raw: str, in_article: bool) -> tuple[str, int]:
    """What names the element in a path, and whether its names, its role or ``hidden`` rule it out."""
    if not raw:
        return "", 0
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(raw):
        if value[:1] in ("'", '"') and value[-1:] == value[:1]:
            value = value[1:-1]
        found.setdefault(name.lower(), html.unescape(value).lower())
    label = "." + "-".join(_WORD.findall(found["class"])) if "class" in found else ""
    role = found.get("role", "").strip()
    out = "hidden" in found or (role in ROLES and role != tag)
    return label, max(BY_NAME if out else 0, _named_out(tag, found.get("class", "").split(), found.get("id", "").strip(), in_article))


def path_of(above: str, name: str) -> str:
    """An element's path as a digest of its parent's and its own name, so that a deep page costs no more per element."""
    return xxhash.xxh64_hexdigest(f"{above}>{name}")


class Page:
    """The elements of a page as (path, blocks before it), and its text blocks.

    Elements that need no end tag are closed as HTML says; an end tag without its start is ignored. Only the white
    space of a block changes: runs become one blank, and line breaks and cells are white space. ``wrappers`` are
    numbers of elements that stay although they would be ruled out.
    """

    def __init__(self, page: str, wrappers: frozenset[int] = frozenset()):
        self.stack = [Element("", "", False, False, False, -1)]
        self.keep = wrappers
        self.opened = self.free = 0
        self.tags: Counter[str] = Counter()  #: of the open elements
        self.ruled: list[Ruled] = []
        self.elements: list[tuple[str, int]] = []
        self.blocks: list[Block] = []
        self.words: list[str] = []
        at = 0
        for m in _PARTS.finditer(page):
            if m.start() > at:
                self.text(page[at:m.start()])
            at = m.end()
            if m[3]:
                self.tag(m[3].lower(), m[2] == "/", m[4])
            elif m[6]:
                self.tag(m[6].lower(), m[5] == "/", m[7])
        if at < len(page):
            self.text(page[at:])
        self.end_block()

    def holder(self) -> Element:
        return next((e for e in reversed(self.stack) if e.tag not in INLINE))

    def text(self, words: str) -> None:
        # Inside a block only an inline element can be ruled out on its own; the block goes on after it.
        self.words.append(" " if self.stack[-1].dropped and not self.holder().dropped else words)

    def end_block(self) -> None:
        if self.words:
            text = _SPACE.sub(" ", html.unescape("".join(self.words))).strip()
            if text:
                holder = self.holder()
                self.blocks.append(Block(text, holder.path, holder.tag, holder.dropped, holder.article))
                if holder.within >= 0:
                    self.ruled[holder.within].direct += len(text) * (not holder.gone)
                else:
                    self.free += len(text) * (not holder.gone)
            self.words.clear()

    def tag(self, tag: str, closing: bool, raw: str) -> None:
        if tag not in INLINE:
            self.end_block()
        elif tag in ("br", "td", "th"):
            self.words.append(" ")
        if closing:
            self.close({tag}, frozenset())
        elif tag not in VOID:
            if tag in P_ENDS:
                self.close({"p"}, P_ENDS - {"p"})
            elif tag in SAME_ENDS:
                self.close(SAME_ENDS[tag], LISTS)
            self.open(tag, raw)

    def close(self, tags: set[str], stops: frozenset[str]) -> None:
        if not any(self.tags[t] for t in tags):
            return
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in tags:
                for element in self.stack[depth:]:
                    self.tags[element.tag] -= 1
                del self.stack[depth:]
                return
            if self.stack[depth].tag in stops:
                return

    def open(self, tag: str, raw: str) -> None:
        above = self.stack[-1]
        self.opened += 1
        label, out = _attributes(tag, raw, above.article)
        dropped, gone, within = above.dropped, above.gone, above.within
        if tag in DROPPED and tag != "form" and not (tag == "header" and above.article and not out):
            dropped = gone = True
        elif (out and tag not in ("html", "body")) or tag == "form":
            if self.opened not in self.keep:
                dropped = True
                if not gone:
                    self.ruled.append(Ruled(self.opened, within, out))
                    within = len(self.ruled) - 1
        if tag in ARTICLE and not gone and within >= 0:
            self.ruled[within].has_article = True
        path = path_of(above.path, tag + label)
        self.tags[tag] += 1
        self.stack.append(Element(tag, path, dropped, above.article or (tag in ARTICLE and not dropped), gone, within))
        if tag not in INLINE:
            self.elements.append((path, len(self.blocks)))

    def wrappers(self) -> frozenset[int]:
        """Numbers of the ruled-out elements that hold most of the text of what may be the article, and of forms with an article."""
        rivals = self.free
        for one in reversed(self.ruled):
            one.chars += one.direct
            if one.parent >= 0:
                above = self.ruled[one.parent]
                above.chars += one.chars
                above.has_article |= one.has_article
                above.others += one.chars if one.may_wrap() else 0
            elif one.may_wrap():
                rivals += one.chars
        kept, totals = set(), {-1: rivals}
        for place, one in enumerate(self.ruled):
            total = totals.get(one.parent)
            if total is not None and one.may_wrap() and (2 * one.chars > total or (not one.out and one.has_article)):
                kept.add(one.number)
                totals[place] = total - one.chars + one.direct + one.others
        return frozenset(kept)


def parse(page: str) -> tuple[list[tuple[str, int]], list[Block]]:
    found = Page(page)
    wrappers = found.wrappers()
    if wrappers:
        found = Page(page, wrappers)
    return found.elements, found.blocks


def text_token(block: Block) -> str:
    return f"{block.path}={xxhash.xxh64_hexdigest(block.text)}"


def numbered_token(block: Block) -> str | None:
    """The token of a text without its numbers; none where it has no number, and for headings."""
    text = _NUMBER.sub("0", block.text)
    if not _NUMBER.search(text) or block.tag in HEADINGS:
        return None
    return f"{block.path}#={xxhash.xxh64_hexdigest(text)}"


def page_tokens(page: str) -> list[tuple[str, int, int]]:
    """(token, times, first place) of a page. Long texts inside an article are no tokens: no site repeats such of its own there."""
    elements, blocks = parse(page)
    times: dict[str, list[int]] = {}
    for place, (path, _) in enumerate(elements):
        times.setdefault(path, [0, place])[0] += 1
    for block in blocks:
        if not block.dropped and (not block.article or len(block.text) <= SITE_CHARS):
            for token in (text_token(block), None if block.article else numbered_token(block)):
                if token:
                    times.setdefault(token, [0, len(elements)])[0] += 1
    return [(token, *v) for token, v in times.items()]


def in_order(elements: list[tuple[str, int]], ordered: list[str]) -> bool:
    """Whether the template's once-per-page elements that the page has come in the template's order."""
    rank = {path: i for i, path in enumerate(ordered)}
    places = [rank[path] for path, _ in elements if path in rank]
    return all(a < b for a, b in zip(places, places[1:]))


def free_blocks(blocks: list[Block], own_texts: set[str], numbered: set[str]) -> list[Block]:
    """The blocks that are not the site's own words.

    A text with the template's words but other numbers, as a page's number in a footer, is the site's own where
    elements of its path hold one of the site's own texts and nothing but such texts.
    """
    own = [text_token(b) in own_texts for b in blocks]
    among = {b.path for b, o in zip(blocks, own) if o}
    varied = [not o and b.path in among and numbered_token(b) in numbered for b, o in zip(blocks, own)]
    among -= {b.path for b, o, v in zip(blocks, own, varied) if not o and not v}
    return [b for b, o, v in zip(blocks, own, varied) if not o and not (v and b.path in among)]


def main_text(page: str, ordered: list[str], own_texts: set[str], numbered: set[str] | None) -> str:
    """The article of a page: all that is left after what is ruled out and the template's own texts."""
    elements, blocks = parse(page)
    left = [b for b in blocks if not b.dropped]
    if ordered and in_order(elements, ordered):
        free = {id(b) for b in free_blocks([b for b in left if not b.article], own_texts, numbered or set())}
        inside = [b for b in left if b.article]
        own = {id(b) for b in inside if len(b.text) <= SITE_CHARS and text_token(b) in own_texts}
        if 2 * sum(len(b.text) for b in inside if id(b) in own) >= sum(len(b.text) for b in inside):
            own = set()  # pages with copies of one article
        left = [b for b in left if (id(b) not in own if b.article else id(b) in free)]
    return "\n\n".join(b.text for b in left)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _with_host(pages: DataFrame, url: str, page: str, *keep) -> DataFrame:
    host = F.arrow_udf(lambda urls: pa.array([host_of(u) for u in urls.to_pylist()], pa.string()), "string")
    return pages.select(*keep, host(F.col(f"`{url}`").cast("string")).alias("host"), text_of(page).alias("page"))


def _tokens(batches):
    for batch in batches:
        out = []
        for host, page in zip(*(c.to_pylist() for c in batch.columns)):
            mark = xxhash.xxh64_intdigest(page) >> 1
            out += [(host, mark, *token) for token in page_tokens(page)]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        for at in range(0, max(1, len(out)), 20_000):
            part = out[at:at + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in part], k) for i, k in enumerate(kinds)], names=["host", "mark", "token", "times", "place"])


def templates(hosted: DataFrame) -> DataFrame:
    """Per host its template: once (paths in order), texts (own text tokens), numbered (of texts whose numbers vary).

    ``hosted`` has host and page. A token's occurrence vector is held as a hash of its (page, times) pairs that
    does not depend on their order, so tokens are reduced before the shuffle and a host with a third of all pages
    costs a row per token and task. Hosts whose tokens reach no class have no row.
    """
    tokens = hosted.select("host", "page").mapInArrow(_tokens, "host string, mark long, token string, times long, place long")
    vector = F.sum(F.pmod(F.xxhash64("mark", "times"), F.lit(1 << 40)).cast("decimal(38,0)"))
    counted = tokens.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"), vector.alias("vector"), F.max("times").alias("most"), F.avg("place").alias("place"))
    frequent = cut_lineage(counted.where(F.col("pages") >= LEAST_PAGES))
    # Every page has at least one element that all pages of its host have, or else no class is frequent enough.
    # The most pages come from a partial aggregate, so no task gathers a host's tokens before they are filtered.
    known = frequent.join(frequent.groupBy("host").agg(F.max("pages").alias("all_pages")), "host")
    known = known.where(F.col("pages") >= LEAST_SHARE * F.col("all_pages"))
    classes = known.groupBy("host", "pages", "vector").agg(F.max("most").alias("most"), F.collect_list(F.struct("place", "token")).alias("tokens"))
    is_numbered = F.col("t.token").contains("#=")
    is_text = F.col("t.token").contains("=") & ~is_numbered
    once = F.col("most") == 1
    flat = classes.select("host", "most", F.explode("tokens").alias("t"))
    return flat.groupBy("host").agg(
        F.array_sort(F.collect_list(F.when(~is_text & ~is_numbered & once, F.struct("t.place", "t.token")))).alias("once"),
        F.collect_list(F.when(is_text, F.col("t.token"))).alias("texts"),
        F.collect_list(F.when(is_numbered & once, F.col("t.token"))).alias("numbered"),
    ).select("host", F.col("once.token").alias("once"), "texts", "numbered")


def _extract(batches):
    for batch in batches:
        ids, urls, pages, once, texts, numbered = (c.to_pylist() for c in batch.columns)
        made = [main_text(p, o or [], set(t or ()), set(n or ())) for p, o, t, n in zip(pages, once, texts, numbered)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(made, pa.string()), pa.array([len(t) for t in made], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars (code points).

    Blocks are joined by an empty line, in page order. Null html counts as empty and has an empty text; pages
    without a readable host share the template of the host "". Repeated rows give repeated rows.
    """
    hosted = _with_host(pages, url, page, F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"))
    # Templates go to the pages: broadcast where they are measured small, else an ordinary join that may split a hot host.
    known = small_side(templates(hosted))
    id_type = pages.schema[page_id].dataType.simpleString()
    joined = hosted.join(known, "host", "left").select("page_id", "url", "page", "once", "texts", "numbered")
    return joined.mapInArrow(_extract, f"page_id {id_type}, url string, text string, n_chars long")
