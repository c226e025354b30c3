"""Main text of HTML pages by tree scoring.

1. A page is cut into tags and texts in one pass, and its elements become a
   tree (unclosed paragraphs, list items and cells end where the next one
   begins; a stray end tag is ignored).
2. Elements that are no part of an article are left out with all they hold: by
   tag (scripts, styles, navigation, forms, asides, ...), by role or hidden
   state, or by a word of their class or id (menu, sidebar, comments, cookie,
   ...). What is only named so, but holds the ``main`` or ``article``, stays.
3. Texts between block tags are paragraphs. Each gives points for its length
   and its commas to the element that holds it (a list's items to the one
   around the list), half of them to the next one, and less to those around it. A score is discounted by the share of link text.
4. The element of the best score is the container; inside an ``article``, that
   one. From there up to the body a sibling stays if its own points are enough
   beside the container's; so does a heading just before what stays.
5. What stays is decoded, white space inside a paragraph becomes one space, and
   paragraphs are joined in page order.

Pages are whole rows: Spark deals the work where pages are read, nothing is
shuffled. Every step is linear in the page, also for malformed ones.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.llm.common import fresh, table

#: Characters of pages worked at once (a larger page is a block by itself).
BLOCK_CHARS = 8_000_000

# name, attributes (a quoted value may hold >), end; possessive: never tried twice
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])))*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text goes on to their own end tag, whatever it looks like.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: The start of one ends an open ``p``.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of text: their points go to the element around them.
TEXT_TAGS = HEADINGS | frozenset("p pre li dt dd td th blockquote figcaption caption summary address".split())
LISTS = frozenset("ul ol dl blockquote".split())
#: Parts of running text: they stay beside the container and between what stays.
FLOW = frozenset("p pre blockquote ul ol dl table figure".split())
IN_HEAD = frozenset("title meta link script style base noscript template head".split())
#: Open elements that the start of another ends, if no element of the scope is between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}), "option": ({"option"}, {"select"}),
}
LOOK_UP = 32  # open elements that a rule looks through

#: Left out whatever they are called. ``form`` stays if it holds most of the page, with prose.
DROPPED_TAGS = RAW | frozenset(
    "head nav footer aside form button select option menu dialog object embed applet svg math canvas audio video map".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert status menu menubar toolbar form".split())
#: First or last words of a class or an id that tell what an element is.
BOILERPLATE = frozenset(
    "nav navbar navigation menu menus submenu topbar topnav subnav header masthead footer sidebar sidebars aside rail "
    "breadcrumb breadcrumbs pagination pager ad ads advert adverts advertisement advertisements advertising adsense "
    "sponsor sponsored sponsors promo promos promoted banner banners cookie cookies consent gdpr notice notices "
    "notification notifications alert alerts popup popups modal overlay toast newsletter subscribe subscription "
    "signup login signin share sharing social related recommended recommendations toolbar search searchform form "
    "disclaimer copyright paywall".split()
)
ADVERTS = frozenset("ad ads advert adverts advertisement advertisements sponsor sponsored".split())
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies responses discussion".split())
WHOLE_NAMES = frozenset("widget widgets widget-area textwidget skip-link adslot adbox outbrain taboola".split())
#: A class with one of these words tells a state or a topic, not what the element is.
NOT_A_NAME = frozenset("has with no not without is hide show open closed enabled disabled active on off tag category cat topic".split())
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
CONTENT = frozenset("article articlebody body content entry main post story text".split())

LONG_REFERENCE = re.compile(r"&#0*[0-9]{8,};?")  # beyond all code points; too long a number is an error to the decoder

LEAST_CHARS = 25  # of a paragraph that gets a point for being one
MOST_FOR_LENGTH = 3.0  # points for length, one per 100 characters
NAMED_CONTENT = 10.0  # points of an element whose name says that it is the content
LEVELS = (1.0, 1 / 2, 1 / 6, 1 / 9, 1 / 12)  # share of a paragraph's points, by steps up
KEEP_SHARE = 0.2  # of the container's points, for a sibling to stay
LINK_LIST = 0.9  # share of link text of a list that is a menu


def name_words(names: str) -> set[str]:
    """First and last words of the classes and ids that tell what an element is."""
    out = set()
    for token in names.split():
        words = [w.lower() for w in NAME_WORD.findall(token)]
        if token.lower() in WHOLE_NAMES:
            out.add("ad")
        elif words and not NOT_A_NAME.intersection(words):
            out.update((words[0], words[-1]))
    return out


class Page:
    """Elements (0 is the page) and pieces of text of one page, in page order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.words, self.out = ["#page"], [-1], [frozenset()], [""]
        self.block = [0]  # the element itself, or the one around a text style
        self.pieces: list[tuple[int, int, str, bool]] = []  # element, paragraph, text, link
        self.paragraph = 0
        self.stack, self.p_at, self.open = [0], [-1], {}
        self.link_at = 0  # how deep the open link is; 0: none
        self.unclosed: set[str] = set()
        self._cut(source)

    def _cut(self, s: str) -> None:
        pos, n, pattern = 0, len(s), TAG
        while pos < n:
            at = s.find("<", pos)
            self._text(s[pos : at if at >= 0 else n])
            if at < 0:
                return
            first = s[at + 1 : at + 2]
            letter = s[at + 2 : at + 3] if first == "/" else first
            if letter.isascii() and letter.isalpha():
                m = pattern.match(s, at)
                if m is None and pattern is TAG:  # an unclosed quote: from here on quotes do not count
                    pattern = LOOSE_TAG
                    m = pattern.match(s, at)
                if m is None:  # cut off inside a tag
                    return
                name, pos = m[2].lower(), m.end()
                if first == "/":
                    self._end(name)
                else:
                    self._start(name, m[3])
                    if name in RAW:
                        pos = self._raw_end(s, name, pos)
                        self._end(name)
            elif s.startswith("<![CDATA[", at):
                end = s.find("]]>", at)
                end = end if end >= 0 else n
                self._text(s[at + 9 : end])
                pos = end + 3
            elif first in ("!", "?", "/"):
                end = s.find("-->", at + 2) if s.startswith("<!--", at) and "-->" not in self.unclosed else -1
                if end >= 0:
                    pos = end + 3
                else:
                    if s.startswith("<!--", at):
                        self.unclosed.add("-->")
                    end = s.find(">", at)
                    pos = end + 1 if end >= 0 else n
            else:
                self._text("<")
                pos = at + 1

    def _raw_end(self, s: str, name: str, pos: int) -> int:
        """Past the end tag; without one a script or style goes on to the end,
        others hold nothing."""
        m = None if name in self.unclosed else re.compile(f"</{name}(?=[\\s/>])[^>]*+>?", re.I).search(s, pos)
        if m is None:
            self.unclosed.add(name)
            return len(s) if name in ("script", "style") else pos
        return m.end()

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._text(" ")
            return
        if name not in INLINE:
            self.paragraph += 1
        if self.open.get("head") and name not in IN_HEAD:
            self._close({"head"}, ())
        if name in ("main", "article") and not self.open.get("article"):  # no article is in a menu or a page's header
            for unclosed in ("nav", "header"):
                if self.open.get(unclosed):
                    self._close({unclosed}, ())
        if name in ENDS_P and self.p_at[-1] > 0:
            self._pop(self.p_at[-1])
        if name in CLOSES:
            self._close(*CLOSES[name])
        if name in VOID:
            return
        element = len(self.tag)
        values = {}
        if "=" in attributes or "hidden" in attributes:
            for m in ATTRIBUTE.finditer(attributes):
                values.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        self.tag.append(name)
        self.parent.append(self.stack[-1])
        self.block.append(self.block[self.stack[-1]] if name in INLINE else element)
        words = name_words(values.get("class", "") + " " + values.get("id", "")) if values else frozenset()
        if values.get("itemprop", "").lower() == "articlebody":
            words = words | {"articlebody"}
        self.words.append(words)
        self.out.append(self._reason(name, words, values))
        self.stack.append(element)
        self.open[name] = self.open.get(name, 0) + 1
        self.p_at.append(len(self.stack) - 1 if name == "p" else self.p_at[-1] if name in INLINE else -1)
        if name == "a":
            self.link_at = len(self.stack) - 1

    def _reason(self, name: str, words: set, values: dict) -> str:
        """Why an element is left out: by its tag, its name, or not at all."""
        role = values.get("role", "").lower().strip()
        if role in DROPPED_ROLES and name not in ("html", "body", "main", "article"):
            return "form" if role == "form" else "tag"
        if "hidden" in values or values.get("aria-hidden", "").lower() == "true" or HIDDEN_STYLE.search(values.get("style", "")):
            return "tag"
        if name in DROPPED_TAGS:
            return "form" if name == "form" else "tag"
        if name in ("html", "body", "main"):
            return ""
        if name in INLINE:
            return "tag" if words & ADVERTS else ""
        if words & COMMENTS:
            return "tag"
        if name == "header":
            return "header"
        return "name" if words & BOILERPLATE else ""

    def _close(self, names, scope) -> None:
        for depth in range(len(self.stack) - 1, max(0, len(self.stack) - 1 - LOOK_UP), -1):
            tag = self.tag[self.stack[depth]]
            if tag in names:
                self._pop(depth)
                return
            if tag in scope:
                return

    def _end(self, name: str) -> None:
        if name == "a":
            self.link_at = 0
        if name not in INLINE:
            self.paragraph += 1
        if not self.open.get(name):
            return
        if name not in INLINE:  # ends all that was left open inside it
            depth = len(self.stack) - 1
            while self.tag[self.stack[depth]] != name:
                depth -= 1
            self._pop(depth)
            return
        for depth in range(len(self.stack) - 1, max(0, len(self.stack) - 1 - LOOK_UP), -1):
            tag = self.tag[self.stack[depth]]
            if tag == name:
                self._pop(depth)
                return
            if tag not in INLINE:  # the end of a text style does not end a block
                return

    def _pop(self, depth: int) -> None:
        for element in self.stack[depth:]:
            self.open[self.tag[element]] -= 1
        del self.stack[depth:], self.p_at[depth:]
        if self.link_at >= depth:
            self.link_at = 0

    def _text(self, text: str) -> None:
        if text:
            self.pieces.append((self.stack[-1], self.paragraph, text, self.link_at > 0))


def _left_out(page: Page, names_count: bool) -> list[bool]:
    """Per element: is it, or an element around it, no part of an article?"""
    n = len(page.tag)
    holds = [False] * n  # the main element or an article
    length, prose = [0] * n, [0] * n  # prose: paragraphs and headings inside
    for element, _, text, _ in page.pieces:
        length[element] += len(text)
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        length[up] += length[i]
        prose[up] += prose[i] + (page.tag[i] == "p" or page.tag[i] in HEADINGS)
        if holds[i] or (page.tag[i] in ("main", "article") and not page.words[i] & COMMENTS and page.out[i] != "tag"):
            holds[up] = True
    # the article around each element, and the articles with a first heading of their own
    article, in_header, titled = [0] * n, [False] * n, set()
    for i in range(1, n):
        up = page.parent[i]
        article[i] = i if page.tag[i] == "article" else article[up]
        in_header[i] = in_header[up] or page.tag[i] == "header"
        if page.tag[i] == "h1" and not in_header[i]:
            titled.add(article[i])
    out = [False] * n
    for i in range(1, n):
        up, why = page.parent[i], page.out[i]
        if why == "header":  # of an article's header the headings stay, if it has no other title
            out[i] = not article[i] or article[i] in titled
        elif why == "name":
            out[i] = names_count and not holds[i]
        elif why == "form":
            out[i] = not holds[i] and (2 * length[i] <= length[0] or prose[i] < 2)
        else:
            out[i] = why == "tag"
        if not out[i] and page.out[up] == "header" and page.tag[i] not in HEADINGS and page.tag[i] != "hgroup":
            out[i] = names_count
        out[i] = out[i] or out[up]
    return out


def _paragraphs(page: Page, out: list[bool]) -> list[tuple[int, str, float]]:
    """(element, text, share of link text) of what is not left out, in page order."""
    found, i, pieces = [], 0, page.pieces
    while i < len(pieces):
        j, parts, linked, total, element = i, [], 0, 0, -1
        while j < len(pieces) and pieces[j][1] == pieces[i][1]:
            at, _, text, link = pieces[j]
            j += 1
            if out[at]:
                parts.append(" ")
                continue
            text = html.unescape(LONG_REFERENCE.sub("\ufffd", text)) if "&" in text else text
            parts.append(text)
            if not text.isspace():
                if element < 0:
                    element = at
                total += len(text)
                linked += len(text) if link else 0
        if element >= 0:
            found.append((page.block[element], " ".join("".join(parts).split()), linked / total))
        i = j
    return found


def points(text: str) -> float:
    """A paragraph's points: for being one, for commas, for length."""
    return (len(text) >= LEAST_CHARS) + text.count(",") + text.count("，") + text.count("、") + min(len(text) / 100, MOST_FOR_LENGTH)


def _chosen(page: Page, paragraphs: list) -> set[int]:
    """The container and the siblings that stay (roots of what is kept)."""
    n = len(page.tag)
    score = [0.0] * n
    own = [0.0] * n  # points of all paragraphs inside, each less its links
    length, linked = [0.0] * n, [0.0] * n
    for element, text, link in paragraphs:
        p = points(text)
        own[element] += p * (1 - link)
        length[element] += len(text)
        linked[element] += len(text) * link
        at = page.parent[element] if page.tag[element] in TEXT_TAGS else element
        if at > 0 and page.tag[at] in LISTS:
            at = page.parent[at]
        for share in LEVELS:
            if at < 0:
                break
            score[at] += p * share
            at = page.parent[at]
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        own[up] += own[i]
        length[up] += length[i]
        linked[up] += linked[i]
    share = [linked[i] / length[i] if length[i] else 0.0 for i in range(n)]
    best, best_score = 0, -1.0
    for i in range(n):
        if score[i]:
            named = NAMED_CONTENT if page.tag[i] in ("article", "main") or page.words[i] & CONTENT else 0.0
            s = (score[i] + named) * (1 - share[i])
            if s > best_score:
                best, best_score = i, s
    up, at = best, best
    while at > 0:
        if page.tag[at] == "article":
            up = at
        at = page.parent[at]
    best = up
    children: dict[int, list[int]] = {}
    above, at = set(), page.parent[best]
    while at >= 0:
        above.add(at)
        at = page.parent[at]
    for i in range(1, n):
        if page.parent[i] in above:
            children.setdefault(page.parent[i], []).append(i)
    roots, node, level = {best}, best, 0
    most = own[best]
    while (parent := page.parent[node]) >= 0:
        near = [i for i in children[parent] if length[i] or i == node]
        enough = [i == node or (own[i] >= KEEP_SHARE * most and share[i] < 0.5) for i in near]
        first, last = enough.index(True), len(enough) - 1 - enough[::-1].index(True)
        after = False  # does the next sibling stay?
        for k in range(len(near) - 1, -1, -1):
            i, stays = near[k], enough[k]
            if not stays and page.tag[i] in HEADINGS:
                stays = after and share[i] < 0.5
            elif not stays and page.tag[i] in FLOW:
                stays = (level == 0 or first < k < last) and share[i] < 0.25
            if stays and i != node:
                roots.add(i)
            after = stays
        if level == 0 and page.tag[best] != "article":
            roots.add(-parent - 1)  # its own texts, between its elements
        node, level = parent, level + 1
    return roots


def main_text(source: str | None) -> str:
    """The main text of a page; empty if it has none (or is null)."""
    if not source:
        return ""
    page = Page(source)
    for names_count in (True, False):
        out = _left_out(page, names_count)
        paragraphs = _paragraphs(page, out)
        if paragraphs:
            break
    else:
        return ""
    roots = _chosen(page, paragraphs)
    kept = [False] * len(page.tag)
    kept[0] = 0 in roots
    for i in range(1, len(kept)):
        kept[i] = kept[page.parent[i]] or i in roots
    menus = _menus(page, paragraphs)
    texts = [text for element, text, link in paragraphs if (kept[element] or (-element - 1 in roots and link < 0.5)) and not menus[element]]
    return " ".join(t for t in texts if t)


def _menus(page: Page, paragraphs: list) -> list[bool]:
    """Per element: is it in a list of at least three items that are all links?"""
    n = len(page.tag)
    length, linked, items = [0.0] * n, [0.0] * n, [0] * n
    for element, text, link in paragraphs:
        length[element] += len(text)
        linked[element] += len(text) * link
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        length[up] += length[i]
        linked[up] += linked[i]
        items[up] += page.tag[i] == "li"
    out = [False] * n
    for i in range(1, n):
        out[i] = out[page.parent[i]] or (page.tag[i] in ("ul", "ol") and items[i] >= 3 and linked[i] >= LINK_LIST * length[i] > 0)
    return out


def extract_main_text(pages: DataFrame, html_col: str = "html", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``pages`` with the last column ``main_text`` (renamed if taken).

    Every page gives one row: a null or empty page, one without text, or one of
    menus alone gives an empty text; malformed markup is read as far as it goes
    (see ``Page``). Ties of scores go to the first element in page order.
    Repeated rows, null ids and other columns pass through; an empty table
    gives an empty table.
    """
    (name,) = fresh(pages, "main_text")
    at = pages.columns.index(html_col)
    schema = T.StructType([*pages.schema.fields, T.StructField(name, T.StringType())])

    def extract(batches):
        for batch in batches:
            column, lo = batch.column(at), 0
            while lo < batch.num_rows:
                texts, chars, hi = [], 0, lo
                while hi < batch.num_rows and (hi == lo or chars < block_chars):
                    source = column[hi].as_py()
                    chars += len(source or "")
                    texts.append(main_text(source))
                    hi += 1
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, name])
                lo = hi

    return pages.mapInArrow(extract, schema)


def op13_html_extract(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
