"""Works nested in pages: a table function from a page to rows of works, layers, stanzas, lines and tokens (SRC12-SRC14).

A page holds one work (its content escaped in an attribute) or several (a section for each). A layer is one script's
text of a work; lines carry the ids by which layers are aligned, tokens those by which words are. A page or a work
without what it needs is a row that says so, no error.
"""

from __future__ import annotations

import html
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The classes, ids and attributes that mark the parts, and views by script and mode.
SECTION, LAYER, STANZA, FAVORITE = "sherSection", "pMC", "w", "favorite"
RAW_ID, RAW_ATTRIBUTE, CONTENT_ID = "HtmlRawText", "data-html", "data-contentid"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
KINDS = "record int, content_id string, slug string, title string, layer int, roman_mode string, stanza_id string, line int, line_id string, token int, mapping_id string, text string, problem string"


class _Nodes(HTMLParser):
    """The page as a tree: each node a tag, its attributes, and its children (nodes and texts)."""

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.root = ("", {}, [])
        self.open = [self.root]
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = (tag, {k.lower(): v or "" for k, v in attrs}, [])
        self.open[-1][2].append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i][0] == tag), 0)
        if at:
            del self.open[at:]

    def handle_data(self, data):
        self.open[-1][2].append(data)


def _walk(node, ends=lambda n: False) -> Iterator[tuple]:
    """The nodes below in page order; not into those at which the walk ends."""
    waiting = [c for c in reversed(node[2]) if not isinstance(c, str)]
    while waiting:
        n = waiting.pop()
        yield n
        if not ends(n):
            waiting += [c for c in reversed(n[2]) if not isinstance(c, str)]


def _text(node) -> str:
    parts, waiting = [], [node]
    while waiting:
        n = waiting.pop()
        if isinstance(n, str):
            parts.append(n)
        else:
            waiting += reversed(n[2])
    return " ".join("".join(parts).split())


def _is(node, tag: str, name: str) -> bool:
    return node[0] == tag and name in node[1].get("class", "").split()


def _layers(node) -> Iterator[tuple]:
    """layer, mode, stanza, line, line id, token, mapping id, text of a node's layers; a line without tokens is a row of its text."""
    is_layer, is_stanza, is_line = (lambda n: _is(n, "div", LAYER)), (lambda n: _is(n, "div", STANZA)), (lambda n: n[0] == "p" and bool(n[1].get("data-l")))
    for number, layer in enumerate(n for n in _walk(node, is_layer) if is_layer(n)):
        parts = [n for n in _walk(layer, lambda n: is_stanza(n) or is_line(n)) if is_stanza(n) or is_line(n)]
        line = -1
        for part in parts:
            stanza = part[1].get("data-p", "") if is_stanza(part) else ""
            for p in [part] if is_line(part) else [n for n in _walk(part, is_line) if is_line(n)]:
                line += 1
                tokens = [n for n in _walk(p, lambda n: n[0] == "span") if n[0] == "span"]
                where = number, layer[1].get("data-roman", ""), stanza, line, p[1]["data-l"]
                for j, t in enumerate(tokens):
                    yield *where, j, t[1].get("data-m", ""), _text(t)
                if not tokens:
                    yield *where, None, None, _text(p)


def page_rows(page: str | None) -> Iterator[tuple]:
    """The rows of a page, as KINDS names them."""
    nothing = (None,) * 9
    root = _Nodes(page or "").root
    nodes = list(_walk(root))
    sections = [n for n in _walk(root, lambda n: _is(n, "div", SECTION)) if _is(n, "div", SECTION)]
    if sections:
        record = 0
        for s in sections:
            content = next((n[1]["data-id"] for n in _walk(s) if _is(n, "a", FAVORITE) and n[1].get("data-id")), "")
            rows = list(_layers(s))
            slug = s[1].get("id", "")
            if not content or not rows:
                yield record, content or None, slug, None, *nothing[:8], "no id" if not content else "no layers"
            else:
                title = next((" ".join(r[7] for r in rows if (r[0], r[3]) == (k, n)) for k, n in dict.fromkeys((r[0], r[3]) for r in rows) if any(r[7] for r in rows if (r[0], r[3]) == (k, n))), "")
                for r in rows:
                    yield record, content, slug, title, *r, None
            record += 1
        return
    title = next((_text(n) for n in nodes if n[0] == "h1"), "")
    content = next((n[1][CONTENT_ID] for n in nodes if n[1].get(CONTENT_ID)), "")
    raw = next((n[1][RAW_ATTRIBUTE] for n in nodes if n[0] == "input" and n[1].get("id") == RAW_ID and n[1].get(RAW_ATTRIBUTE)), "")
    rows = list(_layers(_Nodes(html.unescape(raw)).root)) if raw else []
    missing = "no title" if not title else "no content id" if not content else "no content" if not raw else "no layers" if not rows else None
    if missing:
        yield 0, content or None, None, title or None, *nothing[:8], missing
    for r in rows if not missing else ():
        yield 0, content, None, title, *r, None


class PageWorks:
    """The table function; a page that can't be read at all is one row with the reason."""

    def eval(self, page: str):
        try:
            rows = list(page_rows(page))
        except (AssertionError, RecursionError, ValueError) as e:
            rows = [(0, *(None,) * 11, f"{type(e).__name__}: {e}"[:200])]
        yield from rows


def three_references(page: Column) -> Column:
    """The page with every & spelt out that opens none of &lt; &gt; &amp;: read again, only these three are decoded."""
    return F.regexp_replace(page, "&(?!(?:lt|gt|amp);)", "&amp;")


def page_works(pages: DataFrame, column: str = "html") -> DataFrame:
    """All columns of pages beside the rows of their works: a lateral join with the table function."""
    works = F.udtf(PageWorks, returnType=KINDS, useArrow=False)
    return pages.lateralJoin(works(F.col(column).outer()))


def view_name(script: Column, roman_mode: Column) -> Column:
    """The view of a layer: Roman ones by their mode (off: with diacritics, else plain), others by script."""
    return F.when(script == "latin", F.when(roman_mode == "off", "roman_diacritic").otherwise("roman_plain")).when(script == "arabic", "urdu").otherwise(script)


def work_lines(rows: DataFrame, *keys: str) -> DataFrame:
    """keys, record, content_id, title, view, stanza_id, line, line_id, text, mappings (of its tokens, in order), one row per line.

    A layer's script is that of its whole text, its view follows from script and mode; of equal views of a work the
    first layer counts.
    """
    from ..functions import text as T

    own = [*keys, "record"]
    line = rows.where("problem is null").groupBy(*own, "content_id", "title", "layer", "roman_mode", "stanza_id", "line", "line_id")
    said = F.array_sort(F.collect_list(F.struct("token", "mapping_id", "text")))
    x = line.agg(said.alias("t")).withColumn("text", F.array_join(F.filter(F.col("t.text"), lambda s: s != ""), " ")).withColumn("mappings", F.filter(F.col("t.mapping_id"), lambda m: m != "")).drop("t")
    script = T.dominant_script(F.array_join(F.array_sort(F.collect_set("text")), " "))
    views = x.groupBy(*own, "layer", "roman_mode").agg(script.alias("script")).withColumn("view", view_name(F.col("script"), F.col("roman_mode")))
    first = views.withColumn("_r", F.row_number().over(Window.partitionBy(*own, "view").orderBy("layer"))).where("_r = 1").select(*own, "layer", "view")
    return x.join(first, [*own, "layer"]).select(*own, "content_id", "title", "view", "stanza_id", "line", "line_id", "text", "mappings")
