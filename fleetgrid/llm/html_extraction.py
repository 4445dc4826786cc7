"""Main text of pages from containers that the pages of a host agree on.

Pass one parses every page and scores its containers: a block of text speaks
for the element around it, half as loudly for the next one out, and so on,
less what of it is link text.  Each container is known by its generalised path
of tags and classes, digits made ``#``.  Spark adds the scores up per host and
path; a host that has a third of all pages is one pre-aggregated sum.  Pass two
extracts, from every page, the elements at the winning path of its host, or at the
next path in the host's order that the page has; a page with none of them
uses its own best container.  What is extracted is the whole article or main around
that element, or without one the outermost element below the body.

Menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out by tag, role, class or id at either pass.  A role, class, id or form
around the main or all articles of the page, or around most of its text, is the
layout's and drops nothing; neither do names such as has-sidebar, no-comments or
modal-open.  Inside an article or main a name says so for certain only when it is made of clear signs
alone, such as ad or social-share; behind any other, such as related-work, share-price or widgets, stands
noise when the text is mostly links, or when the element's path recurs on more than half of the host's
pages, of at least three.  When nothing is left, only tags that never hold an article are noise.

Defined cases: null or empty html gives empty text; null urls and urls without
a host vote together; a page without containers gives the text of its body; a tag that is
never closed ends with the page, and one that the page's end cuts off is text;
very long and deep pages take time and memory in proportion to their size; repeated rows give repeated rows; an empty
table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .tables import materialise
from .url_filters import host_of

PATHS = 8  # paths that a host offers in order; a page with none of them uses its own best

# Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
CONTAINERS = frozenset("article blockquote body center dd details div fieldset figure main section table tbody td tr ul ol dl".split())
SKIPPED = frozenset(
    "head nav aside footer form menu dialog script style noscript template iframe object embed svg math canvas audio video button select "
    "textarea input label noframes".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "noframes", "xmp")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
SIGNS = re.compile(
    r"nav|navbar|navigation|menu|menus|breadcrumbs?|sidebars?|aside|footers?|masthead|banners?|cookies?|consent|gdpr|notices?|alerts?|"
    r"ads?|advert|adverts|advertisements?|advertising|sponsor|sponsored|promo|promos|promotion|comments?|disqus|respond|replies|share|sharing|"
    r"social|related|recommended|newsletter|subscribe|signup|login|popup|modal|overlay|widgets?|pagination|pager|toolbar|skip|hidden|adsense|topbar")
# signs that name a kind of content, which may be most of a page and still be noise
CONTENT_SIGNS = re.compile(
    r"footers?|banners?|cookies?|consent|gdpr|notices?|alerts?|ads?|advert|adverts|advertisements?|advertising|sponsor|sponsored|promo|promos|promotion|"
    r"related|recommended|newsletter|subscribe|signup|login|adsense")
# signs that leave no doubt inside an article either
CLEAR_SIGNS = re.compile(
    r"nav|navbar|navigation|menu|menus|breadcrumbs?|sidebars?|footers?|cookies?|consent|gdpr|ads?|advert|adverts|advertisements?|advertising|"
    r"sponsored|adsense|newsletter|subscribe|signup|login|share|sharing|social|pagination|pager|toolbar|popup")
MODIFIERS = frozenset("has no non not with without hide show".split())  # before a sign: the element tells of noise elsewhere
STATES = frozenset("open opened closed enabled disabled active layout".split())  # the same as the last word of a name
READER_SIGNS = re.compile(r"comments?|disqus|respond|replies")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select".split())

# every part is possessive: a tag that never ends is tried once, not in all the ways its quotes may pair
_QUOTED = r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|(?P<cut>\Z))|<(?P<raw>" + "|".join(RAW) + r")\b" + _QUOTED + r">.*?(?:</(?P=raw)\s*+>|(?P<cut_raw>\Z))|"
    r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>" + _QUOTED + r")>|<(?P<odd_end>/?)(?P<odd>[a-zA-Z][^\s/>]*+)(?P<odd_attrs>[^>]*+)>|"
    r"<[!?][^>]*+>", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?", re.I)


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def generalised(tag: str, classes: str) -> str:
    """A tag with its classes, digits made #, as one step of a path."""
    return ".".join([tag, *sorted({re.sub(r"\d+", "#", c.lower()) for c in classes.split()})])


# noise by a name that may be the layout's; by a kind of content; reader comments; whatever it holds; if links or the host's pages say so
NAMED, CONTENT, READERS, HARD, SUSPECT = 1, 2, 3, 4, 5
HOST_PAGES = 3  # pages of a host from which on they can tell that a path recurs
SHARE = {NAMED: 0.5, CONTENT: 0.95, READERS: 2.0, HARD: 2.0, SUSPECT: 0.5}  # holding more of the page's text, an element is layout; comments may outweigh the article


def words_of(name: str) -> list[str]:
    return [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w]


def named_noise(names: list[str]) -> int:
    """What the classes and the id of an element say: 0, NAMED, CONTENT or READERS."""
    found = 0
    for name in names:
        words = words_of(name)
        if len(words) > 1 and words[-1] in STATES:
            continue
        for before, word in zip(["", *words], words, strict=False):
            if before not in MODIFIERS and SIGNS.fullmatch(word):
                found = max(found, READERS if READER_SIGNS.fullmatch(word) else CONTENT if CONTENT_SIGNS.fullmatch(word) else NAMED)
    return found


def certain(names: list[str]) -> bool:
    """Whether one of the names is made of signs alone, a clear one among them."""
    split = [words_of(n) for n in names]
    return any(all(map(SIGNS.fullmatch, words)) and any(map(CLEAR_SIGNS.fullmatch, words)) for words in split)


def noise_of(tag: str, given: dict[str, str], inside_article: bool) -> int:
    """0, or what kind of noise an element is by its tag and attributes."""
    if tag == "form":
        return NAMED
    if tag in SKIPPED:
        return HARD
    if tag == "header" and not inside_article:
        return CONTENT
    if not given or tag in ("html", "body", "article", "main"):
        return 0
    if "hidden" in given:
        return HARD
    names = [*given.get("class", "").split(), *given.get("id", "").split()]
    if given.get("role", "").lower() in ROLES or not inside_article and any("header" in re.split(r"[^a-z]+", n.lower()) for n in names):
        return max(CONTENT, named_noise(names))
    kind = max(named_noise(names), NAMED if given.get("aria-hidden", "").lower() == "true" else 0)
    return SUSPECT if inside_article and kind in (NAMED, CONTENT) and named_noise(names) and not certain(names) else kind


class Block:
    __slots__ = ("text", "links", "owner", "heading")

    def __init__(self, text: str, links: int, owner: int, heading: bool):
        self.text, self.links, self.owner, self.heading = text, links, owner, heading


class Element:
    __slots__ = ("tag", "path", "parent", "noise", "article", "link", "heading", "real", "size", "links", "mains", "articles", "spot")

    def __init__(self, tag: str, path: str, parent: int, up: Element | None, noise: int, article: bool, real: bool):
        self.tag, self.path, self.parent, self.noise, self.article = tag, path, parent, noise, article
        self.link = up is not None and up.link or tag == "a"
        self.heading = up is not None and up.heading or tag in HEADINGS
        self.real, self.size, self.links, self.mains, self.articles = real, 0, 0, 0, 0  # an article or main that no name says to be noise
        self.spot = ""  # of a suspect, its path with its own tag and names


class Containers:
    """The containers of a page that are no noise, outer ones first: path, tag and the container around each; the spots of its suspects."""

    def __init__(self):
        self.spots: set[str] = set()
        self.paths: list[str] = []
        self.tags: list[str] = []
        self.parents: list[int] = []

    def inherited(self, own) -> list:
        """For each container what its outermost ancestor with a value has, itself included; -1 for none."""
        out: list[int] = []
        for i, up in enumerate(self.parents):
            out.append(out[up] if up >= 0 and out[up] >= 0 else i if own(i) else -1)
        return out


def left_out(elements: list[Element], pieces: list[tuple[str, int]], recurring: frozenset[str]) -> list[bool]:
    """Whether each element is noise or lies in noise.

    A suspect is noise when it is mostly links or its spot is among the recurring ones.

    A name or role does not count where the element holds a main, every
    article of the page, or most of its text: it then belongs to the layout.
    When nothing is left, names and roles do not count at all.
    """
    hard: list[bool] = []
    for e in elements:
        hard.append(e.parent >= 0 and hard[e.parent] or e.noise == HARD)
    total = mains = articles = 0
    for text, at in pieces:
        if at < 0 or not hard[at]:
            size = len(text.strip())
            total += size
            if at >= 0:
                elements[at].size += size
                elements[at].links += size if elements[at].link else 0
    for i in range(len(elements) - 1, -1, -1):
        e = elements[i]
        if hard[i]:
            continue
        own = e.real and e.tag == "main", e.real and e.tag == "article"
        mains, articles = mains + own[0], articles + own[1]
        e.mains, e.articles = e.mains + own[0], e.articles + own[1]
        if e.parent >= 0:
            up = elements[e.parent]
            up.size, up.links, up.mains, up.articles = up.size + e.size, up.links + e.links, up.mains + e.mains, up.articles + e.articles
    out: list[bool] = []
    for e, h in zip(elements, hard, strict=True):
        spared = e.noise == SUSPECT and e.spot not in recurring and 2 * e.links <= e.size
        layout = not e.noise or spared or e.mains or e.articles and e.articles == articles or e.size > total * SHARE.get(e.noise, 0)
        out.append(h or e.parent >= 0 and out[e.parent] or not layout)
    return hard if all(at >= 0 and out[at] or not text.strip() for text, at in pieces) else out


def tokens(page: str):
    """The tags of a page as (end of the text before, start of the text behind, closing, tag, attributes); no tag for what only separates text.

    Nothing after the last ``>`` is a tag.  What an unclosed comment or script begins is never text.
    """
    last = page.rfind(">") + 1
    for m in TOKEN.finditer(page, 0, last):
        if m["cut"] is not None or m["cut_raw"] is not None:
            yield m.start(), len(page), "", "", ""
            return
        odd = m["tag"] is None
        yield m.start(), m.end(), m["odd_end"] if odd else m["end"], (m["odd"] if odd else m["tag"] or "") or "", (m["odd_attrs"] if odd else m["attrs"]) or ""
    declared = [at for at in (page.find("<!", last), page.find("<?", last)) if at >= 0]
    if declared:
        yield min(declared), len(page), "", "", ""


def parse(page: str | None, recurring: frozenset[str] = frozenset()) -> tuple[Containers, list[Block]]:
    """The containers, and the blocks of text, each with the innermost container around it (-1 for none)."""
    elements: list[Element] = []
    stack: list[int] = []
    opened: dict[str, int] = defaultdict(int)  # open elements by tag
    # of each block: its pieces of text with the element around each, and the innermost element that is open
    runs: list[tuple[list[tuple[str, int]], int]] = []
    words: list[tuple[str, int]] = []

    def flush() -> None:
        nonlocal words
        if words:
            runs.append((words, stack[-1] if stack else -1))
            words = []

    def close(at: int) -> None:
        if any(elements[x].tag in BLOCKS for x in stack[at:]):
            flush()
        for x in stack[at:]:
            opened[elements[x].tag] -= 1
        del stack[at:]

    def add(text: str) -> None:
        if text:
            words.append((html.unescape(text), stack[-1] if stack else -1))

    page, at = page or "", 0
    for before, behind, end, tag, attrs in tokens(page):
        add(page[at:before])
        at, tag = behind, tag.lower()
        if not tag:
            continue
        if end:
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if elements[stack[i]].tag == tag))
            elif tag == "p":
                flush()
            continue
        if tag == "br":
            words.append((" ", stack[-1] if stack else -1))
            continue
        if tag in BLOCKS:
            # a paragraph ends where a block begins, with what is open inside it; a list item where the next one does
            for i in range(len(stack) - 1, -1, -1) if opened["p"] else ():
                if elements[stack[i]].tag == "p":
                    close(i)
                elif elements[stack[i]].tag in BLOCKS:
                    break
            ends = CLOSED_BY.get(tag, ())
            for i in range(len(stack) - 1, -1, -1) if any(opened[t] for t in ends) else ():
                if elements[stack[i]].tag in ends:
                    close(i)
                elif elements[stack[i]].tag in SCOPES:
                    break
            flush()
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
            continue
        given = attributes(attrs)
        up = elements[stack[-1]] if stack else None
        article = up is not None and up.article or tag in ("article", "main")
        path = up.path if up else ""
        if tag in CONTAINERS:
            # a path is named by a hash of its steps, however deep it is
            path = hashlib.blake2b(f"{path}/{generalised(tag, given.get('class', ''))}".encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
        real = tag == "main" or tag == "article" and not named_noise([*given.get("class", "").split(), *given.get("id", "").split()])
        element = Element(tag, path, stack[-1] if stack else -1, up, noise_of(tag, given, article), article, real)
        if element.noise == SUSPECT:
            step = generalised(tag, f"{given.get('class', '')} {given.get('id', '')}")
            element.spot = hashlib.blake2b(f"{up.path if up else ''}//{step}".encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
        elements.append(element)
        stack.append(len(elements) - 1)
        opened[tag] += 1
    add(page[at:])
    flush()

    noise = left_out(elements, [w for run, _ in runs for w in run], recurring)
    found, numbers = Containers(), []
    found.spots = {e.spot for e in elements if e.spot}
    for i, e in enumerate(elements):
        around = numbers[e.parent] if e.parent >= 0 else -1
        if e.tag in CONTAINERS and not noise[i]:
            numbers.append(len(found.paths))
            found.paths.append(e.path)
            found.tags.append(e.tag)
            found.parents.append(around)
        else:
            numbers.append(around)
    blocks: list[Block] = []
    for run, inner in runs:
        kept = [(text, at) for text, at in run if at < 0 or not noise[at]]
        text = " ".join("".join(text for text, _ in kept).split())
        if text:
            links = sum(len(text) for text, at in kept if at >= 0 and elements[at].link)
            blocks.append(Block(text, links, numbers[inner] if inner >= 0 else -1, inner >= 0 and elements[inner].heading))
    return found, blocks


def container_scores(found: Containers, blocks: list[Block]) -> dict[str, float]:
    """Share of the page's score by path; all from the third container around a block on get the same of it."""
    own, far, used = [0.0] * len(found.paths), [0.0] * len(found.paths), [False] * len(found.paths)
    for block in blocks:
        n = len(block.text)
        worth = (1 + block.text.count(",") + min(n / 100, 3)) * max(0.0, 1 - block.links / max(1, n))
        at = block.owner
        if at >= 0:
            used[at] = True
        for part in (1, 2, 6):
            if at < 0:
                break
            own[at] += worth / part
            at = found.parents[at]
        if at >= 0:
            far[at] += worth / 9
    scores: dict[str, float] = defaultdict(float)
    for i in range(len(found.paths) - 1, -1, -1):
        up = found.parents[i]
        if up >= 0:
            far[up] += far[i]
            used[up] = used[up] or used[i]
        if used[i]:
            scores[found.paths[i]] += own[i] + far[i]
    total = sum(scores.values())
    return {p: s / total for p, s in scores.items()} if total > 0 else {}


def main_text(page: str | None, ranked: list[str], recurring: frozenset[str] = frozenset()) -> str:
    """The blocks around the first of the ranked paths that the page has, else around its own best container.

    All of the article or main around it is kept.  Without one, all of the
    outermost element below the body is, but for blocks that are mostly links and
    lie outside the path: menus without a name.
    """
    found, blocks = parse(page, recurring)
    own = container_scores(found, blocks)
    chosen = next((p for p in ranked if p in own), None) or max(own, key=lambda p: (own[p], p), default=None)
    if chosen is None:
        return "\n".join(b.text for b in blocks)
    at_path = found.inherited(lambda i: found.paths[i] == chosen)
    article = found.inherited(lambda i: found.tags[i] in ("article", "main"))
    outer = found.inherited(lambda i: found.tags[i] != "body")
    # of the outermost container at the path, the article around it, else what is below the body
    roots: dict[int, int] = {}
    for b in blocks:
        at = at_path[b.owner] if b.owner >= 0 else -1
        if at >= 0:
            if article[at] >= 0:
                roots[article[at]] = 2
            else:
                roots.setdefault(outer[at] if outer[at] >= 0 else at, 1)
    inside: list[int] = []
    for i, up in enumerate(found.parents):
        inside.append(max(inside[up] if up >= 0 else 0, roots.get(i, 0)))

    def kept(b: Block) -> bool:
        kind = inside[b.owner] if b.owner >= 0 else 0
        return kind == 2 or kind == 1 and (b.heading or 2 * b.links <= len(b.text) or at_path[b.owner] >= 0)

    return "\n".join(b.text for b in blocks if kept(b))


SCORE, SEEN, PAGE = range(3)  # kinds of votes: a container's share, the spot of a suspect, the page itself


def host_paths(pages: DataFrame) -> DataFrame:
    """host, its paths, best first, and the spots of suspects that recur on its pages."""
    def votes(batches):
        for batch in batches:
            out = []
            for host, page in zip(batch.host, batch.html, strict=True):
                found, blocks = parse(page)
                out += [(host, SCORE, path, share) for path, share in container_scores(found, blocks).items()]
                out += [(host, SEEN, spot, 1.0) for spot in found.spots]
                out.append((host, PAGE, "", 1.0))
            yield pd.DataFrame(out, columns=["host", "kind", "path", "share"])

    read = pages.select(host_of(F.coalesce("url", F.lit(""))).alias("host"), F.col("html").cast("string").alias("html"))
    # whole numbers add up to the same sum in any order
    summed = materialise(read.mapInPandas(votes, "host string, kind int, path string, share double").groupBy("host", "kind", "path").agg(
        F.sum(F.round(F.col("share") * 1_000_000).cast("long")).alias("votes")), "host-votes")
    order = Window.partitionBy("host").orderBy(F.col("votes").desc(), "path")
    best = summed.filter(F.col("kind") == SCORE).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= PATHS)
    ranked = best.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("place", "path"))).alias("ranked"))
    counted = summed.filter(F.col("kind") == PAGE).select("host", F.col("votes").alias("pages"))
    # at most twice as many of a host recur as a page of it has on average
    recurring = summed.filter(F.col("kind") == SEEN).join(counted, "host").filter(
        (F.col("pages") >= HOST_PAGES * 1_000_000) & (2 * F.col("votes") > F.col("pages"))).groupBy("host").agg(F.collect_list("path").alias("recurring"))
    known = ranked.join(recurring, "host", "left")
    return materialise(known.select(F.col("host").alias("_host"), F.col("ranked.path").alias("ranked"), F.coalesce("recurring", F.array().cast("array<string>")).alias("recurring")), "host-paths")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages``."""
    def texts(batches):
        for batch in batches:
            found = [main_text(page, list(ranked) if ranked is not None else [], frozenset(recurring) if recurring is not None else frozenset())
                     for page, ranked, recurring in zip(batch.html, batch.ranked, batch.recurring, strict=True)]
            yield pd.DataFrame({"page_id": batch.page_id, "url": batch.url, "text": found, "n_chars": [len(t) for t in found]})

    rows = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", F.col("html").cast("string").alias("html"), host_of(F.coalesce("url", F.lit(""))).alias("host"))
    joined = rows.join(host_paths(pages), F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "ranked", "recurring")
    return joined.mapInPandas(texts, "page_id string, url string, text string, n_chars long").withColumn("page_id", F.col("page_id").cast("long"))
