"""Main text of web pages by tag-path ratios.

A page is read as a sequence of blocks, each with its tag path, the names of its open elements
from the root to the leaf. Only what is no text of the page is left out while reading: scripts, styles, form controls (BOILERPLATE), and hidden elements (a
``hidden`` attribute, aria-hidden that is true, a style with display:none or visibility:hidden). All other blocks, boilerplate included, are scored:

1. Per tag path, text length and punctuation are summed over its blocks. The ratios of both to the number of blocks are smoothed over
   neighbouring blocks of one wrapper in page order, fused into one score that the share of text outside links weakens, and averaged per path.
2. The article is where the scores are: score times length, summed up the tree, finds the innermost wrapper (an ``article`` or ``main`` first) that
   has more than half of the page's. Its blocks count WITHIN times, so that short lines, lists and tables of an article stand beside long paragraphs.
3. Names weigh, they don't decide: blocks in elements that usually don't hold the article (UNLIKELY, or a class, id or role that
   _names_boilerplate) count NAMED times, unless they hold the article, see _Reader.kept.
4. A path is content if its weighed score reaches SHARE of the text-weighted mean; outside of the article that was found, OUTSIDE of it (OUTSIDE_CONTAINER
   if that is an ``article`` or ``main`` element), in a wrapper with PART of all score times length.
   Headings go with the content that follows them.

Defined results: a null or empty page has an empty text. Character references are decoded; white space inside a
block becomes one space; blocks are joined by a line feed in page order; unclosed elements end where their
parents or the page end. Very deep or long pages are read in one pass, in time linear in their size. Repeated
rows give repeated results. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches

SHARE = 0.12  # of the mean; the scores' square roots are compared
OUTSIDE, OUTSIDE_CONTAINER = 0.5, 4.0  # the same for what lies outside of the article; of one that is an article or main element
PART = 0.2
WITHIN, NAMED = 65536.0, 1e-4
LEAST_PLAIN = 0.05  # what a block of the article that is all links still counts
KERNEL = (0.25, 0.5, 1.0, 0.5, 0.25)
CACHED_NAME = 80  # longer names aren't kept in the cache

# Element names of HTML.
BOILERPLATE = frozenset("button select textarea option script style "
                        "noscript template iframe object svg math canvas audio video head title".split())
# Left out unless they hold the article; in those of SECONDARY, articles are often comments or teasers.
SECONDARY = frozenset("nav footer aside menu dialog".split())
UNLIKELY = SECONDARY | frozenset("header form fieldset".split())
RAW = frozenset("script style template iframe textarea title svg math canvas object".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FLOW = frozenset("p ul ol dl table blockquote pre figure".split())  # what an article consists of
WRAPPERS = BLOCKS - FLOW - HEADINGS - frozenset("li dt dd tr thead tbody tfoot summary figcaption".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",)}
# What starts inside these closes nothing outside them.
BARRIERS = frozenset("table button noscript select".split())
LISTS = frozenset("ul ol dl".split())
LINES = frozenset("p li dt dd td th caption figcaption blockquote pre summary h1 h2 h3 h4 h5 h6".split())  # a label in one of these is text
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript".split())  # and RAW; anything else ends an open head
# Words in a class, id or role that mark what isn't the article: alone or with words of PLAIN; those of HEADS also at the end of a class or
# before words of PLAIN there (ids may be the words of a heading).
HEADS = frozenset("comment comments respond disqus replies sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer footers "
                  "masthead mastheads banner banners cookie cookies popup popups modal modals pagination pager toolbar newsletter newsletters gdpr adsbygoogle outbrain taboola rail "
                  "ad ads advert adverts advertisement advertisements advertising sharing share social related recommended promo promos".split())
ROLE = HEADS | frozenset("sponsor sponsored promotion promotions header headers consent notice notices alert alerts overlay overlays "
                         "subscribe subscription signup login widget widgets copyright legal disclaimer "
                         "disclaimers skip search gdpr discussion adsbygoogle adsense dfp mpu outbrain taboola rail".split())
PLAIN = frozenset("site page main global top bottom left right primary secondary upper lower inner outer list box bar area slot unit buttons button "
                  "icons icon links link items item section block form posts articles stories text title wrapper wrap container".split())
# A name with one of these words tells of the page or its subject, not of the element: has-sidebar, no-comments, category-cookies.
NOT_OWN = frozenset("has no not non with without hide hides show shows is category cat tag term type format status".split())
COMMENTS = frozenset("comment comments respond disqus replies related recommended sidebar sidebars".split())
SPLIT = (("side-bar", "sidebar"), ("pop-up", "popup"), ("sign-up", "signup"), ("log-in", "login"))
WORD = re.compile(r"[a-z]+")
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？]")
SPACE = re.compile(r"\s+")
ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?""")
CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>?|([^<]++|<)""", re.S)


def _attributes(attrs: str) -> dict[str, str]:
    """Values by lower-case name; the first of a repeated name counts, as in browsers."""
    out: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(attrs):
        out.setdefault(name.lower(), html.unescape("".join(values)))
    return out


def _is_hidden(attributes: dict[str, str]) -> bool:
    if "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true":
        return True
    style: dict[str, tuple[bool, str]] = {}
    for declaration in CSS_COMMENT.sub(" ", attributes.get("style", "")).lower().split(";"):
        name, _, value = declaration.partition(":")
        value, important, _ = value.partition("!")
        if bool(important) >= style.get(name.strip(), (False, ""))[0]:  # the last one counts, important ones first
            style[name.strip()] = (bool(important), value.strip())
    return style.get("display", (0, ""))[1] == "none" or style.get("visibility", (0, ""))[1] == "hidden"


@lru_cache(maxsize=1 << 14)
def _names_boilerplate(token: str, is_class: bool, inside: bool) -> int:
    """0, or 1 if a token of a class, id or role marks what isn't the article, 2 if it has a word of COMMENTS."""
    token = token.replace("_", "-")
    for apart, joined in SPLIT:
        token = token.replace(apart, joined)
    words = [w for w in WORD.findall(token) if not (inside and w in ("header", "headers"))]
    if ":" in token or not NOT_OWN.isdisjoint(words) or ROLE.isdisjoint(words):
        return 0
    own = next(w for w in reversed(words) if w not in PLAIN)
    if (is_class and own in HEADS) or all(w in ROLE or w in PLAIN for w in words):
        return 1 if COMMENTS.isdisjoint(words) else 2
    return 0


def _kind(name: str, attrs: str, inside: bool) -> int:
    """0 for an element that is read, 1 if it is left out unless it holds the article, 2 if articles in it needn't be the article, 3 if
    it is left out. ``inside`` an article, headers hold its title."""
    if name in BOILERPLATE:
        return 3
    kind = 2 if name in SECONDARY else int(name in UNLIKELY and not (inside and name == "header"))
    if not attrs.strip() or name in ("html", "body", "article", "main"):
        return kind
    attributes = _attributes(attrs)
    if _is_hidden(attributes):
        return 3
    for k in ("class", "role") if name in HEADINGS else ("class", "id", "role"):
        for token in attributes.get(k, "").lower().split():
            tells = _names_boilerplate if len(token) <= CACHED_NAME else _names_boilerplate.__wrapped__
            kind = max(kind, tells(token, k == "class", inside))
    return kind


class _Reader:
    """Blocks of a page: (path, heading, text, characters inside links, innermost wrapper), and the element of each."""

    def __init__(self):
        self.blocks: list[tuple[int, bool, str, int, int]] = []
        self.paths: list[int] = [0]  # the numbers of the open elements' paths, after that of the page
        self.path_of: dict[tuple[int, str], int] = {}
        self.places: dict[str, list[int]] = defaultdict(list)  # where the elements of a name are open
        self.of: list[int] = []  # the innermost element of each block
        self.open: list[str] = []
        self.ids: list[int] = [0]  # the numbers of the open elements, after that of the page
        self.parent, self.kinds, self.tags = [0], [0], [""]  # by number; parents have smaller ones
        self.names: Counter = Counter()  # how many elements of a name are open
        self.skips = 0  # depth of the outermost element that is left out, 0 if none
        self.unlikely: list[int] = []  # depths of the open elements of kind 1 and 2
        self.parts: list[str] = []
        self.linked = self.container = self.links = self.element = 0
        self.heading = False
        self.path = self.wrapper = 0

    def kept(self) -> list[int]:
        """The blocks that stay when elements of kind 1 and 2 are left out, but for those that hold the article.

        An element of kind 1 holds it if it has text in an ``article`` or ``main``, or most of the page's text outside links.
        One of kind 2 (comments and teasers are articles, too) does if it has text in a ``main``, or if it has most of the text and no
        article outside it has any, nor, if it has no article either, more than a tenth of the text is in plain sight:
        it is a wrapper, or its end tag is missing.
        """
        size = len(self.parent)
        plain, open_, kinds, parent = [0] * size, 0, self.kinds, self.parent
        free = [True] * size  # outside all elements of kind 1 and 2
        for e in range(1, size):
            free[e] = free[parent[e]] and not kinds[e]
        if all(free):
            return list(range(len(self.blocks)))
        for (_, _, text, linked, _), e in zip(self.blocks, self.of):
            plain[e] += len(text) - linked
            open_ += free[e] * (len(text) - linked)
        whole, articles, mains = plain[:], [0] * size, [0] * size
        for e in range(size - 1, 0, -1):
            whole[parent[e]] += whole[e]
            articles[parent[e]] += whole[e] if self.tags[e] in ("article", "main") else articles[e]
        total, all_articles, within = whole[0], articles[0], articles
        out, articles = [False] * size, [0] * size
        for e in range(size - 1, 0, -1):
            if kinds[e] == 1:
                out[e] = not (articles[e] or 2 * plain[e] > total)
            elif kinds[e] == 2:
                most = 2 * whole[e] > total and within[e] == all_articles and (within[e] > 0 or 10 * open_ <= total)
                out[e] = not (mains[e] or most)
            if not out[e]:
                plain[parent[e]] += plain[e]
                articles[parent[e]] += plain[e] if self.tags[e] in ("article", "main") else articles[e]
                mains[parent[e]] += plain[e] if self.tags[e] == "main" else mains[e]
        for e in range(1, size):
            out[e] = out[e] or out[parent[e]]
        return [i for i, e in enumerate(self.of) if not out[e]]

    def article(self, mass: list[float]) -> tuple[list[bool] | None, float]:
        """Which blocks lie in the article, by the blocks' mass (score times length): in the outermost ``article`` with more than half of it, else
        in such a ``main``, else in all articles if they have it together, else beside the paragraphs that have it, in the
        innermost wrapper with more than half. None if nothing has. With it, the share of the mean that outside blocks need."""
        size, parent, tags = len(self.parent), self.parent, self.tags
        whole = [0.0] * size
        for m, e in zip(mass, self.of):
            whole[e] += m
        for e in range(size - 1, 0, -1):
            whole[parent[e]] += whole[e]
        large = [e for e in range(1, size) if 2 * whole[e] > whole[0]]  # each inside the one before
        one = next((e for tag in ("article", "main") for e in large if tags[e] == tag), 0)
        within, together = [False] * size, 0.0
        for e in range(1, size):
            within[e] = within[parent[e]] or (e == one if one else tags[e] == "article")
            together += whole[e] if within[e] and not within[parent[e]] else 0
        if 2 * together > whole[0]:
            return [within[e] for e in self.of], OUTSIDE_CONTAINER
        last = next((e for e in reversed(large) if tags[e] in WRAPPERS), 0)
        beside, flow = [False] * size, 0.0
        for e in range(1, size):
            beside[e] = tags[e] in FLOW if parent[e] == last else beside[parent[e]]
            flow += whole[e] if beside[e] and parent[e] == last else 0
        if 2 * flow <= whole[0]:
            return None, SHARE
        return [beside[e] and 2 * b[3] <= len(b[2]) for b, e in zip(self.blocks, self.of)], OUTSIDE

    def flush(self) -> None:
        if self.parts:
            text = SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
            if text:
                self.blocks.append((self.path, self.heading, text, min(self.linked, len(text)), self.wrapper))
                self.of.append(self.element)
            self.parts, self.linked = [], 0

    def text(self, raw: str) -> None:
        if self.skips and self.open[-1] == "head" and raw.strip():
            self.end("head")
        if self.skips:
            return
        if not self.parts:
            self.path, self.element = self.paths[-1], self.ids[-1]
            self.wrapper = max((self.ids[self.places[n][-1] + 1] for n in WRAPPERS if self.places.get(n)), default=0)
            self.heading = any(n in HEADINGS for n in self.open[-4:])
        self.parts.append(raw)
        if self.links:
            self.linked += len(raw.strip())

    def start(self, name: str, attrs: str) -> None:
        if self.names["head"] and (name == "body" or (self.open[-1] == "head" and name not in IN_HEAD)):
            self.end("head")
        if name == "br":
            if not self.skips:
                self.parts and self.parts.append(" ")
            return
        if name in VOID:
            if name == "hr" and not self.skips:
                self.flush()
            return
        if name in BLOCKS:
            if not self.skips:
                self.flush()
            self.close("p")  # a block ends an open paragraph, also one that is left out
        for other in CLOSES.get(name, ()):
            self.close(other)
        kind = 0 if self.skips else _kind(name, attrs, self.container > 0)
        if name == "label" and not kind and not (self.parts or any(n in LINES for n in self.open[-3:])):
            kind = 3  # of a form control
        self.places[name].append(len(self.open))
        path = self.path_of.setdefault((self.paths[-1], name), len(self.path_of) + 1)
        self.open.append(name)
        self.paths.append(path)
        self.names[name] += 1
        self.container += name in ("article", "main")
        self.links += name == "a"
        if kind:
            self.flush()
            if kind == 3:
                self.skips = len(self.open)
            else:
                self.unlikely.append(len(self.open))
        self.parent.append(self.ids[-1])
        self.ids.append(len(self.kinds))
        self.kinds.append(kind % 3)
        self.tags.append(name)

    def end(self, name: str) -> None:
        if name in BLOCKS and not self.skips:
            self.flush()
        if not self.names[name]:
            return
        at = len(self.open) - 1
        while self.open[at] != name:
            at -= 1
        if at < max(self.skips, *self.unlikely[-1:], 0) - 1 and name not in BLOCKS:
            return  # an inline end tag can't end the element that is left out
        self.pop_to(at)

    def close(self, name: str) -> None:
        """Close the innermost open ``name`` unless a barrier (for parts of lists, also a list) is open inside it."""
        if not self.places.get(name):
            return
        at = self.places[name][-1]
        stops = BARRIERS | LISTS if name in ("li", "dt", "dd") else BARRIERS
        if all(self.places[n][-1] < at for n in stops if self.places.get(n)):
            self.pop_to(at)

    def pop_to(self, at: int) -> None:
        if self.skips > at:
            self.skips = 0
        elif not self.skips:
            if (self.unlikely and self.unlikely[-1] > at) or any(n in BLOCKS for n in self.open[at:]):
                self.flush()
        for n in self.open[at:]:
            self.container -= n in ("article", "main")
            self.links -= n == "a"
            self.names[n] -= 1
            self.places[n].pop()
        del self.open[at:], self.ids[at + 1:], self.paths[at + 1:]
        while self.unlikely and self.unlikely[-1] > at:
            self.unlikely.pop()


def read(page: str) -> _Reader:
    """The page's blocks and elements."""
    reader, at, low = _Reader(), 0, None
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        if m[7] is not None:
            reader.text(m[7])
            continue
        name = m[2] or m[5]
        if not name:
            continue
        name, closing, attrs = name.lower(), m[1] or m[4], (m[3] or m[6] or "")
        if closing:
            reader.end(name)
        elif name in RAW:  # the content isn't markup
            low = page.lower() if low is None else low
            end = -1 if attrs.endswith("/") and name in ("svg", "math") else low.find(f"</{name}", at) if len(low) == len(page) else _find_end(page, name, at)
            if end >= 0:
                close = page.find(">", end)
                at = len(page) if close < 0 else close + 1
            elif name in ("script", "style"):
                at = len(page)
        else:
            reader.start(name, attrs)
    reader.flush()
    return reader


def _find_end(page: str, name: str, at: int) -> int:
    m = re.compile(f"</{name}", re.I).search(page, at)
    return m.start() if m else -1


def _scores(found: list[tuple], named: list[bool]) -> list[float]:
    """The fused ratios of each block's path; paths in named elements are paths of their own."""
    length, marks, count = defaultdict(float), defaultdict(float), defaultdict(int)
    keys = [(b[0], x) for b, x in zip(found, named)]
    for k, b in zip(keys, found):
        length[k] += len(b[2])
        marks[k] += len(PUNCTUATION.findall(b[2]))
        count[k] += 1
    half, out = len(KERNEL) // 2, []
    for i, k in enumerate(keys):
        near = [(KERNEL[d + half], keys[i + d]) for d in range(-half, half + 1) if 0 <= i + d < len(keys)
                and found[i + d][4] == found[i][4] and named[i + d] == named[i]]
        whole = sum(w for w, _ in near)
        out.append(sum(w * length[n] / count[n] for w, n in near) / whole * (1 + sum(w * marks[n] / count[n] for w, n in near) / whole))
    return out


def main_text(page: str | None) -> str:
    reader = read(page or "")
    found = reader.blocks
    kept = set(reader.kept())
    if not kept:
        return ""
    named = [i not in kept for i in range(len(found))]
    fused = _scores(found, named)
    plain = defaultdict(float)  # the share of a path's text outside links
    size = defaultdict(int)
    for b, x in zip(found, named):
        plain[b[0], x] += len(b[2]) - b[3]
        size[b[0], x] += len(b[2])
    free = [(plain[b[0], x] / size[b[0], x]) ** 2 for b, x in zip(found, named)]
    mass = [f * p * len(b[2]) * (NAMED if x else 1) for f, p, b, x in zip(fused, free, found, named)]
    article, share = reader.article(mass)
    within = [False] * len(found) if article is None else [a and not x for a, x in zip(article, named)]
    own = [(b[0], x, w) for b, x, w in zip(found, named, within)]
    score, count = defaultdict(float), defaultdict(int)
    for k, f, p, x, w in zip(own, fused, free, named, within):
        score[k] += f * (WITHIN * max(p, LEAST_PLAIN) if w else NAMED * p if x else p)
        count[k] += 1
    # square roots: a page with one very long block doesn't lose its shorter ones
    mean = sum((fused[i] * free[i]) ** 0.5 * len(found[i][2]) for i in kept) / sum(len(found[i][2]) for i in kept)
    of_wrapper = defaultdict(float)
    for m, b in zip(mass, found):
        of_wrapper[b[4]] += m
    whole = sum(mass)
    outside = [article is not None and not w for w in within]
    keep = [(score[k] / count[k]) ** 0.5 >= (share if o else SHARE) * mean and not (o and of_wrapper[b[4]] < PART * whole)
            for k, o, b in zip(own, outside, found)]
    for i in range(len(found) - 2, -1, -1):
        if found[i][1] and not named[i]:
            keep[i] = within[i] or keep[i + 1]
    return "\n".join(b[2] for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    short_batches(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))

    def texts(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([main_text(h) for h in b.column(2).to_pylist()], pa.string())],
                                             names=["page_id", "url", "text"])
    kinds = dict(rows.dtypes)
    out = rows.mapInArrow(texts, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


__all__ = ["extract", "main_text", "read"]
