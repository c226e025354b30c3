"""HTML -> rows: the only Python that runs per row in the library.

Spark has no HTML parser, so each page is parsed once in Python (stdlib
``html.parser``) and turned into rows; everything after that (class rules,
fallbacks, filters, counts) is column expressions. The DataFrame helpers
``elements`` / ``records`` run as ``mapInArrow`` over Arrow batches of pages.

* ``elements(pages, tags)`` -> one row per element of the listed tags:
  ``(pos, parent, tag, cls, attrs, text)``.
* ``records(pages, fields, container)`` -> one row per container element (or
  one for the whole page without ``container``) with a column per field, each
  the text / attribute / count of the first matching descendant.
* ``page_records(...)`` -> the same rows, and one row with a reason for every
  page that gives none, so that no page is lost and no page ends the job.

Every page is indexed once: sorted element positions per tag, class and
attribute. A container is an interval of positions, so a field is found by
binary search; texts are offsets into one joined string.

Text follows the usual "all descendant text, joined with no separator, no
trim" rule, entities decoded, script/style/comment text left out of the
enclosing elements. Unclosed tags end where an enclosing tag ends.

Selector specs are small JSON objects, e.g. ``{"tag": "li", "class": "a b"}``:
``class`` with a blank must equal the whole class attribute, one word
matches any one class; ``all_classes`` requires every listed class;
``attrs`` requires exact attribute values, ``has_attrs`` their presence, ``text`` an exact text; ``get`` is ``"text"`` (default),
``"@name"`` for an attribute, or ``"count"``.
"""

from __future__ import annotations

import functools
import html.parser
import re
from bisect import bisect_left
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ship_by_value() -> None:
    """Pickle this module's code by value into the Python workers.

    Only this module's functions run in executors' Python workers (the page
    parser and the ``mapInArrow`` functions).
    Shipping them by value means executors do not need this package
    installed or on their path.
    """
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # older cloudpickle: the package must then be installed on executors
        pass


_ship_by_value()

VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW_TEXT_TAGS = frozenset(["script", "style", "template"])

# why a page gives no record
PAGE_MISSING = "page:missing"  # no page text at all
PAGE_EMPTY = "page:empty"  # blanks only
PAGE_UNREADABLE = "page:unreadable"  # the parser fails on it; the error's name follows
PAGE_NO_MARKUP = "page:no_markup"  # not a single element
PAGE_NO_RECORDS = "page:no_records"  # no container


class _Tree(HTMLParser):
    """Elements of a page with parent links, text offsets and an index."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags: list[str] = []
        self.attrs: list[dict] = []
        self.parent: list[int] = []
        self.last: list[int] = []  # one past the last descendant
        self.cls: list[str] = []  # class attribute, blanks normalised
        self.start: list[tuple[int, int]] = []  # offsets into the visible text and into all text
        self.end: list[tuple[int, int]] = []
        self.by_tag: dict[str, list[int]] = {}
        self.by_class: dict[str, list[int]] = {}  # single words and whole attributes
        self.by_attr: dict[str, list[int]] = {}
        self.found: dict["_Selector", list[int]] = {}  # matches of each selector asked for
        self.stack: list[int] = []
        self.open: dict[str, int] = {}
        self.visible: list[str] = []
        self.all: list[str] = []
        self.at = (0, 0)
        self.no_comment_end = False

    # the stdlib parser raises on unknown marked sections; browsers read them as comments
    def parse_html_declaration(self, i):
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def parse_comment(self, i, report=1):
        if self.no_comment_end:  # searched for once, not for every comment start
            return -1
        end = super().parse_comment(i, report)
        self.no_comment_end = end < 0
        return end

    def _open(self, tag, attrs):
        i = len(self.tags)
        d = {}
        self.tags.append(tag)
        self.attrs.append(d)
        self.by_tag.setdefault(tag, []).append(i)
        cls = ""
        if attrs:
            for k, v in attrs:  # a repeated attribute keeps its last value
                d[k] = "" if v is None else v
            for k in d:
                self.by_attr.setdefault(k, []).append(i)
            words = d["class"].split() if "class" in d else []
            cls = " ".join(words)
            for word in {*words, cls} if words else ():
                self.by_class.setdefault(word, []).append(i)
        self.cls.append(cls)
        self.parent.append(self.stack[-1] if self.stack else -1)
        self.start.append(self.at)
        self.end.append(self.at)
        self.last.append(i + 1)
        return i

    def handle_starttag(self, tag, attrs):
        i = self._open(tag, attrs)
        if tag not in VOID_TAGS:
            self.stack.append(i)
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self._open(tag, attrs)

    def handle_endtag(self, tag):
        if not self.open.get(tag):
            return
        while True:
            j = self._close()
            if self.tags[j] == tag:
                return

    def _close(self) -> int:
        j = self.stack.pop()
        self.open[self.tags[j]] -= 1
        self.end[j] = self.at
        self.last[j] = len(self.tags)
        return j

    def handle_data(self, data):
        self.all.append(data)
        if self.stack and self.tags[self.stack[-1]] in RAW_TEXT_TAGS:
            self.at = (self.at[0], self.at[1] + len(data))
        else:
            self.visible.append(data)
            self.at = (self.at[0] + len(data), self.at[1] + len(data))

    def finish(self):
        self.close()
        while self.stack:
            self._close()
        self.visible, self.all = "".join(self.visible), "".join(self.all)
        return self

    def text(self, i: int) -> str:
        (v, a), (v_end, a_end) = self.start[i], self.end[i]
        return self.all[a:a_end] if self.tags[i] in RAW_TEXT_TAGS else self.visible[v:v_end]

    def has_text(self, i: int, text: str) -> bool:
        k = 1 if self.tags[i] in RAW_TEXT_TAGS else 0
        return self.end[i][k] - self.start[i][k] == len(text) and self.text(i) == text


# What nearly all pages are made of: a start tag with quoted attributes, an end tag,
# a doctype, a comment without dashes, or the text before the next tag.
_BLANK = r"[ \t\n\r\f]"
_PART = re.compile(
    rf'''<(?:([a-zA-Z][a-zA-Z0-9]*)((?:{_BLANK}+[a-zA-Z][a-zA-Z0-9_.:-]*="[^"<>]*")*){_BLANK}*(/?)>'''
    rf"|/([a-zA-Z][a-zA-Z0-9]*){_BLANK}*>|![dD][oO][cC][tT][yY][pP][eE] [^<>]*>|!--[^<>-]*-->)|[^<]+"
)
_ATTR = re.compile(r'''([a-zA-Z][a-zA-Z0-9_.:-]*)="([^"]*)"''')
_RAW_END = {tag: re.compile(rf"</\s*{tag}", re.I) for tag in ("script", "style")}
# elements that some versions of the stdlib parser read as raw text
_MAYBE_RAW = frozenset("title textarea iframe noembed noframes noscript xmp plaintext".split())
_unescape_attr = getattr(html.parser, "_unescape_attrvalue", html.unescape)
_unescape = html.unescape


def plain_tree(page: str) -> _Tree | None:
    """The tree that the stdlib parser builds, for pages of plain parts only
    (several times faster); None if there is anything else in the page."""
    t = _Tree()
    tags, dicts, cls, parents, starts, ends, last, stack, is_open = t.tags, t.attrs, t.cls, t.parent, t.start, t.end, t.last, t.stack, t.open
    by_tag, by_attr, by_class, match, visible, every = t.by_tag, t.by_attr, t.by_class, _PART.match, t.visible, t.all
    at, n, place, shown = 0, len(page), (0, 0), True  # ``shown``: text here is visible
    while at < n:
        m = match(page, at)
        if m is None:
            return None
        kind = m.lastindex
        if kind == 3:  # a start tag
            at = m.end()
            tag, attrs, slash = m.group(1, 2, 3)
            if not tag.islower():
                tag = tag.lower()
            if slash and (tag in _RAW_END or tag in _MAYBE_RAW):
                return None
            i = len(tags)
            tags.append(tag)
            if tag in by_tag:
                by_tag[tag].append(i)
            else:
                by_tag[tag] = [i]
            if attrs:
                d, words, whole = _attributes(attrs)
                for k in d:
                    by_attr.setdefault(k, []).append(i)
                for word in words:
                    by_class.setdefault(word, []).append(i)
            else:
                d, whole = {}, ""
            dicts.append(d)
            cls.append(whole)
            parents.append(stack[-1] if stack else -1)
            starts.append(place)
            ends.append(place)
            last.append(i + 1)
            if slash or tag in VOID_TAGS:
                continue
            stack.append(i)
            is_open[tag] = is_open.get(tag, 0) + 1
            shown = tag not in RAW_TEXT_TAGS
            if tag in _RAW_END:
                m = _RAW_END[tag].search(page, at)
                if m is None or page[m.start() : m.start() + len(tag) + 3].lower() != f"</{tag}>" or page.find("<!--", at, m.start()) >= 0:
                    return None
                every.append(page[at : m.start()])
                place = (place[0], place[1] + m.start() - at)
                at = m.start()
            elif tag in _MAYBE_RAW:
                lt = page.find("<", at)
                if lt < 0 or page[lt : lt + len(tag) + 3].lower() != f"</{tag}>" or (tag not in ("title", "textarea") and "&" in page[at:lt]):
                    return None
        elif kind == 4:  # an end tag
            at = m.end()
            tag = m.group(4)
            if not tag.islower():
                tag = tag.lower()
            if is_open.get(tag):
                while True:
                    j = stack.pop()
                    is_open[tags[j]] -= 1
                    ends[j] = place
                    last[j] = len(tags)
                    if tags[j] == tag:
                        break
                shown = not stack or tags[stack[-1]] not in RAW_TEXT_TAGS
        elif page[at] == "<":  # a doctype or comment
            at = m.end()
        else:
            at = m.end()
            text = m.group()
            if "&" in text:
                if at == n:
                    return None
                text = _unescape(text)
            every.append(text)
            if shown:
                visible.append(text)
                place = (place[0] + len(text), place[1] + len(text))
            else:
                place = (place[0], place[1] + len(text))
    t.at = place
    return t.finish()


@functools.lru_cache(maxsize=4096)
def _attributes(text: str) -> tuple[dict, tuple, str]:
    """(values by name, words of the class and the whole class, the whole class)
    of a start tag's attributes; tags repeat, within a page and between pages."""
    d = {}
    for k, v in _ATTR.findall(text):  # a repeated attribute keeps its last value
        d[k.lower()] = _unescape_attr(v) if "&" in v else v
    words = d["class"].split() if "class" in d else []
    whole = " ".join(words)
    return d, tuple({*words, whole}) if words else (), whole


def parse_tree(html: str) -> _Tree:
    html = html or ""
    t = plain_tree(html)
    if t is not None:
        return t
    t = _Tree()
    whole = html.rfind(">") + 1  # no tag is complete after the last one; what follows is text
    t.feed(html[:whole])
    t.feed(html[whole:].replace("<", "&lt;"))
    return t.finish()


class _Selector:
    """One selector spec, compiled once per task."""

    def __init__(self, spec: dict):
        self.spec = spec
        self.nth, self.up, self.how = spec.get("nth", 0), spec.get("up", 0), spec.get("get", "text")
        self.page = spec.get("scope") == "page"
        self.own = bool(spec.get("self"))
        self.find = _Selector({k: v for k, v in spec["find"].items() if k != "scope"}) if spec.get("find") else None
        if self.how not in ("text", "count") and not self.how.startswith("@"):
            raise ValueError(f"unknown get: {self.how}")

    def matches(self, tree: _Tree) -> list[int]:
        """Positions of all elements of the page that match, in order."""
        out = tree.found.get(self)
        if out is None:
            out = tree.found[self] = self._search(tree)
        return out

    def _search(self, tree: _Tree) -> list[int]:
        s = self.spec
        lists = [tree.by_tag.get(s["tag"], [])] if s.get("tag") else []
        classes = ([s["class"]] if s.get("class") is not None else []) + list(s.get("all_classes") or ())
        lists += [tree.by_class.get(c, []) for c in classes]
        attrs = s.get("attrs") or {}
        lists += [tree.by_attr.get(k, []) for k in [*attrs, *(s.get("has_attrs") or ())]]
        if not lists:
            out = range(len(tree.tags))
        else:
            lists.sort(key=len)
            out = lists[0]
            for other in lists[1:]:
                held = set(other)
                out = [i for i in out if i in held]
        if attrs:
            out = [i for i in out if all(tree.attrs[i].get(k) == v for k, v in attrs.items())]
        if s.get("text") is not None:
            out = [i for i in out if tree.has_text(i, s["text"])]
        return out

    def get(self, tree: _Tree, i: int) -> str | None:
        return tree.attrs[i].get(self.how[1:]) if self.how.startswith("@") else tree.text(i)

    def value(self, tree: _Tree, lo: int, hi: int) -> str | None:
        """The field's value over elements ``lo <= i < hi``."""
        if self.page:
            lo, hi = 0, len(tree.tags)
        hits = self.matches(tree)
        a, b = bisect_left(hits, lo), bisect_left(hits, hi)
        if self.how == "count" and self.find is None:
            return str(b - a)
        if a + self.nth >= b:
            return None
        i = hits[a + self.nth]
        for _ in range(self.up):
            i = tree.parent[i]
            if i < 0:
                return None
        if self.find is not None:
            return self.find.value(tree, i + 1, tree.last[i])
        return self.get(tree, i)


def page_tree(html: str | None) -> tuple[_Tree | None, str | None]:
    """(tree, None), or (None, the reason why there is none)."""
    if html is None:
        return None, PAGE_MISSING
    if not html.strip():
        return None, PAGE_EMPTY
    try:
        tree = parse_tree(html)
    except Exception as e:  # one bad page must not end the job
        return None, f"{PAGE_UNREADABLE}:{type(e).__name__}"
    return (tree, None) if tree.tags else (None, PAGE_NO_MARKUP)


class PageReader:
    """Records of pages, by a container and fields compiled once."""

    def __init__(self, container: dict | None, fields: dict):
        self.container = _Selector(container) if container else None
        self.fields = {k: _Selector(v) for k, v in fields.items()}

    def read(self, html: str | None) -> tuple[list[tuple[int, int, dict]], str | None, dict]:
        """((container pos, ordinal, fields) of each record, the reason if there
        is none, the page-level fields)."""
        tree, reason = page_tree(html)
        return self.rows(tree) if tree else ([], reason, dict.fromkeys(self.fields))

    def rows(self, tree: _Tree) -> tuple[list[tuple[int, int, dict]], str | None, dict]:
        """The same of a parsed page."""
        none = dict.fromkeys(self.fields)
        n = len(tree.tags)
        page = {k: f.value(tree, 0, n) for k, f in self.fields.items() if f.page}
        rows = []
        for ord_, root in enumerate([-1] if self.container is None else self.container.matches(tree)):
            lo, hi = (root + 1, tree.last[root]) if root >= 0 else (0, n)
            out = dict(page)
            for name, f in self.fields.items():
                if f.own and name not in page:
                    out[name] = f.get(tree, root) if root >= 0 else None
                elif name not in page:
                    out[name] = f.value(tree, lo, hi)
            rows.append((root, ord_, out))
        return rows, None if rows else PAGE_NO_RECORDS, none | page


class KindsReader:
    """Records of several kinds from one parse; the field ``kind`` names it, and
    the fields of the other kinds are None."""

    def __init__(self, kinds: dict[str, tuple[dict | None, dict]]):
        self.readers = {kind: PageReader(container, fields) for kind, (container, fields) in kinds.items()}
        self.none = dict.fromkeys(["kind", *[f for _, fields in kinds.values() for f in fields]])

    def read(self, html: str | None) -> tuple[list[tuple[int, int, dict]], str | None, dict]:
        tree, reason = page_tree(html)
        if tree is None:
            return [], reason, self.none
        rows = [(root, i, self.none | out | {"kind": kind}) for kind, r in self.readers.items() for root, i, out in r.rows(tree)[0]]
        return rows, None if rows else PAGE_NO_RECORDS, self.none


def iter_records(html: str, cont: dict | None, field_specs: dict):
    """(container pos, ordinal, {field: value}) for one page."""
    yield from PageReader(cont, field_specs).read(html)[0]


def iter_elements(html: str, tags: str | None, where: dict | None = None):
    """(pos, parent, tag, class, attrs, text) for the listed tags of one page
    (and of these, the elements that ``where`` selects)."""
    try:
        tree = parse_tree(html)
    except Exception:  # ``page_records`` says which pages these are
        return
    if tags in (None, "", "*"):
        at = range(len(tree.tags))
    else:
        at = sorted(i for t in {t.strip() for t in tags.split(",")} for i in tree.by_tag.get(t, ()))
    chosen = set(_Selector(where).matches(tree)) if where else None
    for i in at:
        if chosen is None or i in chosen:
            yield i, tree.parent[i], tree.tags[i], tree.cls[i], tree.attrs[i], tree.text(i)


def site_root(url_col) -> Column:
    """``https://host`` part of a URL (for making relative links absolute)."""
    c = F.col(url_col) if isinstance(url_col, str) else url_col
    return F.nullif(F.regexp_extract(c, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1), F.lit(""))


def join_root(root, href) -> Column:
    """H-5: absolute link = site root + relative link (plain concatenation)."""
    r = F.lit(root) if isinstance(root, str) and "://" in root else (F.col(root) if isinstance(root, str) else root)
    h = F.col(href) if isinstance(href, str) else href
    return F.concat(r, h)


OUT_PAGES = 256  # pages per output batch: bounds the records held at once
OUT_CHARS = 16_000_000  # and their text (the records of one page go out together)


def _arrow_records(keep: list[str], html_col: str, make_reader, names: list[str], rejects: tuple[str, str] | None):
    """Per-partition function for ``mapInArrow``: batches of pages in,
    batches of records out; page columns pass through by index (``take``).
    Output is emitted every ``OUT_PAGES`` pages or ``OUT_CHARS`` characters, so
    memory does not grow with the size of the input batch."""

    def run(batches):
        import pyarrow as pa

        reader = make_reader()
        for batch in batches:
            htmls = batch.column(html_col)
            schema = pa.schema(
                [batch.schema.field(k) for k in keep]
                + [pa.field("rec", pa.int32()), pa.field("ord", pa.int32())]
                + [pa.field(k, pa.string()) for k in [*names, *(rejects or ())]]
            )
            at = 0
            while at < batch.num_rows:
                src, recs, ords, reasons, pages = [], [], [], [], []
                vals = {k: [] for k in names}
                lo, chars = at, 0
                while at < batch.num_rows and at - lo < OUT_PAGES and chars < OUT_CHARS:
                    html = htmls[at].as_py()
                    rows, reason, page = reader.read(html)
                    if reason is not None and rejects:
                        rows = [(None, None, page)]
                        chars += len(html or "")
                    for rec, ord_, out in rows:
                        src.append(at)
                        recs.append(rec)
                        ords.append(ord_)
                        reasons.append(reason)
                        pages.append(html if reason is not None else None)
                        for k in names:
                            vals[k].append(out[k])
                            chars += len(out[k] or "")
                    at += 1
                idx = pa.array(src, type=pa.int64())
                arrays = [batch.column(k).take(idx) for k in keep]
                arrays += [pa.array(recs, type=pa.int32()), pa.array(ords, type=pa.int32())]
                arrays += [pa.array(vals[k], type=pa.string()) for k in names]
                if rejects:
                    arrays += [pa.array(reasons, type=pa.string()), pa.array(pages, type=pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def page_records(
    df: DataFrame,
    fields: dict,
    container: dict | None = None,
    html_col: str = "html",
    keep: list[str] | None = None,
    reject_cols: tuple[str, str] | None = ("page_reject", "page_html"),
) -> DataFrame:
    """``records`` with a channel for the pages that give none.

    Such a page has one row: ``rec`` and ``ord`` null, its page-level fields as
    far as they were read, the reason in the first of ``reject_cols`` and the
    whole page in the second (both null on records). Every page is so in
    exactly one of ``split_pages``'s two parts, and one pass gives both.
    """
    return _read_records(df, lambda: PageReader(container, fields), list(fields), html_col, keep, reject_cols)


def kind_records(df: DataFrame, kinds: dict[str, tuple[dict | None, dict]], html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``records`` of several kinds, ``{kind: (container, fields)}``, from one
    parse of each page: the column ``kind`` names it, and the columns of the
    other kinds' fields are null."""
    names = ["kind", *[f for _, fields in kinds.values() for f in fields]]
    return _read_records(df, lambda: KindsReader(kinds), names, html_col, keep, None)


def _read_records(df: DataFrame, make_reader, names: list[str], html_col: str, keep: list[str] | None, reject_cols: tuple[str, str] | None) -> DataFrame:
    from pyspark.sql import types as T

    keep = keep if keep is not None else [c for c in df.columns if c != html_col]
    df = df.select(*keep, html_col)
    out_schema = T.StructType(
        [df.schema[k] for k in keep]
        + [T.StructField("rec", T.IntegerType()), T.StructField("ord", T.IntegerType())]
        + [T.StructField(k, T.StringType()) for k in [*names, *(reject_cols or ())]]
    )
    return df.mapInArrow(_arrow_records(keep, html_col, make_reader, names, reject_cols), out_schema)


def split_pages(rows: DataFrame, reject_cols: tuple[str, str] = ("page_reject", "page_html")) -> tuple[DataFrame, DataFrame]:
    """Records, and the pages without one (with reason and whole page)."""
    reason = F.col(reject_cols[0])
    return rows.where(reason.isNull()).drop(*reject_cols), rows.where(reason.isNotNull()).drop("rec", "ord")


def records(
    df: DataFrame,
    fields: dict,
    container: dict | None = None,
    html_col: str = "html",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per container (or page) with one string column per field.

    Runs as ``mapInArrow`` where the pages are read: whole Arrow batches of
    pages per call, page columns carried through by index. Field specs may say
    ``up`` (go to the n-th ancestor of the match), ``find`` (then search inside
    it), ``scope: "page"`` (search the whole page, e.g. a page heading copied
    onto every card) and ``self`` (read the container element itself). Pages
    that give no record have no row here; ``page_records`` keeps them.
    """
    return page_records(df, fields, container, html_col, keep, reject_cols=None)


def _arrow_elements(keep: list[str], html_col: str, tags: str, where: dict | None):
    def run(batches):
        import pyarrow as pa

        map_type = pa.map_(pa.string(), pa.string())
        arrow_schema = None
        for batch in batches:
            htmls = batch.column(html_col)
            for lo in range(0, batch.num_rows, OUT_PAGES):
                part = htmls.slice(lo, OUT_PAGES).to_pylist()
                src, cols = [], [[] for _ in range(6)]
                for i, h in enumerate(part, start=lo):
                    for row in iter_elements(h, tags, where):
                        src.append(i)
                        for c, v in zip(cols, row):
                            c.append(v)
                idx = pa.array(src, type=pa.int64())
                arrays = [batch.column(k).take(idx) for k in keep]
                arrays += [
                    pa.array(cols[0], type=pa.int32()),
                    pa.array(cols[1], type=pa.int32()),
                    pa.array(cols[2], type=pa.string()),
                    pa.array(cols[3], type=pa.string()),
                    pa.array([list(d.items()) for d in cols[4]], type=map_type),
                    pa.array(cols[5], type=pa.string()),
                ]
                if arrow_schema is None:
                    arrow_schema = pa.schema(
                        [batch.schema.field(k) for k in keep]
                        + [
                            pa.field("pos", pa.int32()),
                            pa.field("parent", pa.int32()),
                            pa.field("tag", pa.string()),
                            pa.field("cls", pa.string()),
                            pa.field("attrs", map_type),
                            pa.field("text", pa.string()),
                        ]
                    )
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    return run


def elements(df: DataFrame, tags: str, html_col: str = "html", keep: list[str] | None = None, where: dict | None = None) -> DataFrame:
    """One row per element of the listed tags: ``pos, parent, tag, cls, attrs, text``.

    Runs as ``mapInArrow`` like ``records``. ``where`` is a selector that the
    elements must match; the texts of the others are never built. A page that
    cannot be parsed gives no element.
    """
    from pyspark.sql import types as T

    keep = keep if keep is not None else [c for c in df.columns if c != html_col]
    df = df.select(*keep, html_col)
    out_schema = T.StructType(
        [df.schema[k] for k in keep]
        + [
            T.StructField("pos", T.IntegerType()),
            T.StructField("parent", T.IntegerType()),
            T.StructField("tag", T.StringType()),
            T.StructField("cls", T.StringType()),
            T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
            T.StructField("text", T.StringType()),
        ]
    )
    return df.mapInArrow(_arrow_elements(keep, html_col, tags, where), out_schema)
