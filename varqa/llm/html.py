"""Main text of web pages by deducing each host's template from its pages.

A token is a tag or the text between two tags, told apart by the path of elements above it. Tokens that occur equally often on each page of
a host form an equivalence class. Classes that are large and frequent make up the template: members whose place in the
class's order changes from page to page are taken out, and so are those that don't keep to one gap of the outer class.
What lies between template tokens are slots. Slots inside menus, headers, footers and the like, slots of links, and
blocks that consist of template texts only are left out; the rest is the page's text.

No page meets another: occurrence vectors are compared by two sums, over pages, of 32 bits of a hash of page and count.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, texts

#: A class is large from so many tokens, frequent from so many pages and such a share of its host's pages.
LARGE, PAGES, SHARE = 3, 3, 0.3
#: A text is of the template on this share of a host's pages, not counting those of its commonest title, if it has so many titles.
EVERYWHERE, TITLES = 0.9, 5
#: A slot outside articles holds a menu if links hold more than this share of its characters.
LINKS = 0.5
#: Bytes of all hosts' templates up to which they are broadcast, and parts a host's pages are dealt to beyond that.
BROADCAST_BYTES, SALTS = 32 << 20, 16

# Elements without content, with text that isn't markup, that run on in a line, that aren't the main text,
# and words of classes, ids and roles that say so.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
OUTSIDE = frozenset("aside audio button canvas datalist dialog fieldset footer head iframe input label legend menu nav noembed noframes noscript object optgroup option script search select style svg template textarea title video".split())
OUTSIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status toolbar".split())
OUTSIDE_WORDS = frozenset("""ad ads adsbygoogle advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs comment comments
    consent cookie cookies copyright disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices notification overlay
    pager paginate pagination paywall popup promo promoted promotion recommended related replies reply respond search share sharebar sharing
    sidebar signin signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets""".split())
HEADER_WORDS = frozenset("header masthead".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre search section summary table ul".split())
#: Opened elements that end an open one of their kind, up to the element that holds both.
SIBLINGS = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "option": (("option",), ("select", "datalist"))}
P_SCOPE = frozenset("html table td th caption button object template".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
ARTICLE, MAIN = 2, 1
FORM, HARD = 1, 2


class Element:
    __slots__ = ("name", "path", "outside", "scope", "link", "block")

    def __init__(self, name, path, outside, scope, link, block):
        self.name, self.path, self.outside, self.scope, self.link, self.block = name, path, outside, scope, link, block


class Reader:
    """Reads pages into tokens and blocks; keeps the ids of paths and labels it has met. Ids of tags are even, those of texts odd."""

    def __init__(self):
        self.paths: dict[tuple[int, str], int] = {}
        self.labels: dict[tuple[str, str], tuple[str, int, int, bool]] = {}

    def _forget(self):
        if len(self.paths) + len(self.labels) > 200_000:
            self.__init__()

    def label(self, name: str, attributes: str) -> tuple[str, int, int, bool]:
        """The element's label in paths, whether it is outside the main text, its scope, and if so only outside articles."""
        known = self.labels.get((name, attributes))
        if known:
            return known
        found: dict[str, str] = {}
        for m in _ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
        roles = set(found.get("role", "").lower().split())
        scope = ARTICLE if name == "article" or "article" in roles or found.get("itemprop", "").lower() == "articlebody" else MAIN if name == "main" or "main" in roles else 0
        outside, soft = HARD if name in OUTSIDE or roles & (OUTSIDE_ROLES - {"banner"}) else FORM if name == "form" else 0, name == "header" or "banner" in roles
        if name not in ("html", "body", "main"):
            for word in f"{found.get('class', '')} {found.get('id', '')}".split():
                parts = [p.lower() for p in _PARTS.findall(word)]
                if parts and parts[0] not in ("has", "no", "with", "without"):
                    if scope and OUTSIDE_WORDS.issuperset(parts) or not scope and not OUTSIDE_WORDS.isdisjoint(parts):
                        outside = HARD
                    soft = soft or not scope and not HEADER_WORDS.isdisjoint(parts)
        classes = ".".join(sorted(re.sub(r"\d+", "", found.get("class", "")).split()))
        known = self.labels[name, attributes] = (f"{name}.{classes}" if classes else name, outside, scope, bool(soft))
        return known

    def read(self, page: str, template: "Template | None" = None):
        """Tokens in page order, blocks (slot, scope, text characters, those in links, template or not, text), the title."""
        self._forget()
        paths, root = self.paths, Element("", 0, 0, 0, False, 0)
        stack, stream, blocks, title = [root], [], [], ""
        pieces: list[str] = []
        state = [0, 0, 0, 0, True]  # of the open block: path, scope, link characters, slot, template texts only
        tags = template.tags if template else frozenset()
        fixed = template.texts if template else frozenset()
        last = 0

        def text(lo: int, hi: int) -> None:
            top = stack[-1]
            if top.outside:
                return
            piece = page[lo:hi]
            if "&" in piece:
                piece = entities.unescape(piece)
            plain = " ".join(piece.split())
            if plain:
                stream.append(known := xxhash.xxh3_64_intdigest(plain.encode("utf-8", "surrogatepass"), top.path) | 1)
                if not state[0]:
                    state[:] = [top.block or 1, top.scope, 0, xxhash.xxh3_64_intdigest(last.to_bytes(8, "little"), top.block), True]
                if top.link:
                    state[2] += len(plain)
                state[4] = state[4] and known in fixed
            pieces.append(piece)

        def end_block() -> None:
            if state[0]:
                whole = " ".join("".join(pieces).split())
                blocks.append((state[3], state[1], len(whole), state[2], state[4], whole))
                state[0] = 0
            pieces.clear()

        def close(names: tuple[str, ...], until) -> bool:
            """Ends the innermost of the named elements and all inside it, unless one of `until` comes first."""
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in names:
                    if any(e.name not in INLINE for e in stack[i:]):
                        end_block()
                    token(stack[i].path ^ 2)
                    del stack[i:]
                    return True
                if stack[i].name in until:
                    return False
            return False

        def token(at: int) -> None:
            nonlocal last
            stream.append(at)
            if at in tags:
                last = at

        at = 0
        while m := _TOKEN.search(page, at):
            if m.start() > at:
                text(at, m.start())
            at = m.end()
            if not m[2]:
                continue
            name = m[2].lower()
            if m[1]:
                close((name,), ())
                continue
            if name in CLOSES_P:
                close(("p",), P_SCOPE)
            if name in SIBLINGS:
                close(*SIBLINGS[name])
            label, outside, scope, soft = self.label(name, m[3])
            top = stack[-1]
            key = top.path, label
            path = paths.get(key)
            if path is None:
                path = paths[key] = xxhash.xxh3_64_intdigest(label.encode("utf-8", "surrogatepass"), top.path) & ~3
            if name not in INLINE:
                end_block()
            token(path)
            if name in VOID:
                continue
            if soft and top.scope < ARTICLE:
                outside = HARD
            inherited = 0 if top.outside == FORM and scope else top.outside
            here = Element(name, path, max(outside, inherited), max(scope, top.scope), top.link or name == "a", path if name not in INLINE else top.block)
            if name in RAW:
                end = _RAW_END[name].search(page, at)
                if name == "title" and not title:
                    title = " ".join(entities.unescape(page[at : end.start() if end else len(page)]).split())
                at = end.start() if end else len(page)
            stack.append(here)
        if at < len(page):
            text(at, len(page))
        end_block()
        return stream, blocks, title


#: Of a template: tokens of the outer class (kind 1) and of others (0), and slots judged to be menus (2) or not (3).
_PACKED = np.dtype([("token", "<u8"), ("cls", "<u4"), ("kind", "<u4")])
MENU, NO_MENU = 2, 3


class Template:
    """A host's template: its tokens (sorted), each one's class and whether that is the outer one, and its frequent slots."""

    def __init__(self, packed: bytes | None):
        rows = np.frombuffer(packed or b"", _PACKED)
        slots = rows[rows["kind"] >= MENU]
        self.menus = dict(zip(slots["token"].tolist(), (slots["kind"] == MENU).tolist()))
        rows = rows[rows["kind"] < MENU]
        self.tokens, self.cls, self.outer = rows["token"].copy(), rows["cls"].copy(), rows["kind"] == 1
        self.tags = frozenset(self.tokens[self.tokens & 1 == 0].tolist())
        self.texts = frozenset(self.tokens[self.tokens & 1 == 1].tolist())
        self.size = np.zeros(int(self.cls.max()) + 1 if len(rows) else 0, np.int64)  # tags in each class
        np.add.at(self.size, self.cls, (self.tokens & 1 == 0).astype(np.int64))

    def places(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each template token of a page: its index, its place in its class's order, and its gap of the outer class.

        A tag's place is its turn among the class's tags; a text's is the gap between those tags that it stands in.
        """
        if not len(self.tokens):
            return (np.zeros(0, np.int64),) * 3
        found = np.minimum(np.searchsorted(self.tokens, stream), len(self.tokens) - 1)
        at = np.flatnonzero(self.tokens[found] == stream)
        index = found[at]
        cls, tag = self.cls[index], self.tokens[index] & 1 == 0
        place = np.zeros(len(at), np.int64)
        for c in np.unique(cls):
            mine = np.flatnonzero(cls == c)
            if m := int(self.size[c]):
                tags = mine[tag[mine]]
                place[tags] = np.arange(len(tags)) % m
                rest = mine[~tag[mine]]
                place[rest] = np.searchsorted(tags, rest) % m
        outer = np.flatnonzero(self.outer[index] & tag)
        gap = np.searchsorted(outer, np.arange(len(at)))
        gap[self.outer[index]] = 0  # the outer class's own tokens have their places
        return index, place, gap


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _by_host(b: pa.RecordBatch) -> dict[str, list[int]]:
    rows: dict[str, list[int]] = {}
    for i, h in enumerate(b.column(0).to_pylist()):
        rows.setdefault(h, []).append(i)
    return rows


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.asarray(x).astype(np.uint64).view(np.int64))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) to sums over the batch's pages of each token's occurrences, and the number of pages of each title."""
    reader = Reader()
    for b in batches:
        pages = texts(b.column(1))
        for host, rows in _by_host(b).items():
            ids, counts, keys, titles = [], [], [], {}
            for i in rows:
                stream, _, title = reader.read(pages[i])
                t = xxhash.xxh3_64_intdigest((title or pages[i]).encode("utf-8", "surrogatepass"))
                titles[t] = titles.get(t, 0) + 1
                found, n = np.unique(np.array(stream, np.uint64), return_counts=True)
                ids.append(found)
                counts.append(n)
                keys.append(np.full(len(found), xxhash.xxh3_64_intdigest(pages[i].encode("utf-8", "surrogatepass")), np.uint64))
            token, n, key = np.concatenate(ids), np.concatenate(counts).astype(np.int64), np.concatenate(keys)
            h = _mixed(key ^ _mixed(n.astype(np.uint64)))
            order = np.argsort(token, kind="stable")
            token, n, h = token[order], n[order], h[order]
            first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, np.int64)
            total = lambda x: np.add.reduceat(x.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)  # noqa: E731, B023
            low, high = total(h & np.uint64(0xFFFFFFFF)), total(h >> np.uint64(32))
            support = np.diff(np.append(first, len(token)))
            k = len(titles)
            none = np.zeros(k, np.int64)
            yield pa.record_batch(
                [pa.array([host] * (len(first) + k), pa.string()), pa.array([False] * len(first) + [True] * k), _long(np.concatenate((token[first], np.array(list(titles), np.uint64)))),
                 *(pa.array(np.concatenate(x)) for x in ((low, none), (high, none), (support, np.array(list(titles.values()), np.int64)), (total(n), none)))],
                ["host", "is_title", "token", "low", "high", "support", "total"])


def _pack(t: pa.Table) -> pa.Table:
    """One host's tokens as bytes: classes are numbered, the outer one is that of most pages, fewest repeats, most tokens."""
    token = t["token"].to_numpy().view(np.uint64)
    keys, cls = np.unique(t["cls"].to_numpy(), return_inverse=True)
    support, total = t["support"].to_numpy(), t["total"].to_numpy()
    size = np.bincount(cls)
    first = np.unique(cls, return_index=True)[1]
    outer = max(range(len(keys)), key=lambda c: (support[first[c]], -total[first[c]], size[c], keys[c]))
    rows = np.zeros(len(token), _PACKED)
    rows["token"], rows["cls"], rows["kind"] = token, cls, cls == outer
    rows.sort(order="token")
    return pa.table({"host": t["host"].slice(0, 1), "template": pa.array([rows.tobytes()], pa.binary())})


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html, template) to the first and last place and gap of each template token over the batch's pages."""
    reader = Reader()
    for b in batches:
        pages, packed = texts(b.column(1)), b.column(2)
        for host, rows in _by_host(b).items():
            t = Template(packed[rows[0]].as_py())
            most = np.iinfo(np.int64).max
            ends = [np.full(len(t.tokens), most), np.full(len(t.tokens), -1), np.full(len(t.tokens), most), np.full(len(t.tokens), -1)]
            for i in rows:
                index, place, gap = t.places(np.array(reader.read(pages[i])[0], np.uint64))
                for j, x in enumerate((place, gap)):
                    np.minimum.at(ends[2 * j], index, x)
                    np.maximum.at(ends[2 * j + 1], index, x)
            met = ends[1] >= 0
            yield pa.record_batch([pa.array([host] * int(met.sum()), pa.string()), _long(t.tokens[met]), *(pa.array(x[met]) for x in ends)], ["host", "token", "p0", "p1", "g0", "g1"])


def deduce_templates(pages: DataFrame) -> DataFrame:
    """host, template for the pages (host, html): the valid tokens of each host that has large and frequent classes."""
    sums = pages.mapInArrow(_vectors, "host string, is_title boolean, token long, low long, high long, support long, total long")
    sums = materialize(sums.groupBy("host", "is_title", "token").agg(*[F.sum(c).alias(c) for c in ("low", "high", "support", "total")]), "vectors")
    hosts = sums.where("is_title").groupBy("host").agg(F.sum("support").alias("n"), F.max("support").alias("common"), F.count("*").alias("titles"))
    is_text = F.col("token").bitwiseAND(F.lit(1)) == 1
    spread = (F.col("titles") >= TITLES) & (F.col("support") - F.col("common") >= EVERYWHERE * (F.col("n") - F.col("common")))
    often = sums.where(~F.col("is_title") & (F.col("support") >= PAGES)).join(hosts, "host").where((F.col("support") >= SHARE * F.col("n")) & (~is_text | spread))
    vector = ["host", "low", "high", "support", "total"]
    large = often.withColumn("size", F.count("*").over(Window.partitionBy(*vector))).where(F.col("size") >= LARGE)
    classes = large.select("host", "token", F.xxhash64("low", "high", "support", "total").alias("cls"), "support", "total")
    first = materialize(classes.groupBy("host").applyInArrow(_pack, "host string, template binary"), "classes")
    ends = with_templates(pages, first).where("template is not null").mapInArrow(_places, "host string, token long, p0 long, p1 long, g0 long, g1 long")
    ends = ends.groupBy("host", "token").agg(F.min("p0").alias("p0"), F.max("p1").alias("p1"), F.min("g0").alias("g0"), F.max("g1").alias("g1"))
    valid = classes.join(ends.where("p0 = p1 and g0 = g1").select("host", "token"), ["host", "token"])
    return materialize(valid.groupBy("host").applyInArrow(_pack, "host string, template binary"), "templates")


def with_templates(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """Pages with the template of their host, or null. A host's tokens are on many of its pages, so a template is no larger
    than a few of them. All templates are broadcast if they are few bytes, else hosts meet theirs in parts."""
    n, size = templates.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("template")), F.lit(0))).first()
    if 200 * n + size <= BROADCAST_BYTES:
        return pages.join(F.broadcast(templates), "host", "left")
    parts = templates.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pages.withColumn("_salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int")).join(parts, ["host", "_salt"], "left").drop("_salt")


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html, template) to pages, characters and those in links of each slot, over the batch's pages without article
    and main part; slot 0 counts such pages."""
    reader = Reader()
    for b in batches:
        pages, packed = texts(b.column(1)), b.column(2)
        for host, rows in _by_host(b).items():
            t, sums = Template(packed[rows[0]].as_py()), {}
            for i in rows:
                found = reader.read(pages[i], t)[1]
                if any(x[1] for x in found):
                    continue
                one = {0: [1, 0, 0]}
                for slot, _, chars, linked, _, _ in found:
                    x = one.setdefault(slot, [1, 0, 0])
                    x[1] += chars
                    x[2] += linked
                for slot, x in one.items():
                    y = sums.setdefault(slot, [0, 0, 0])
                    y[:] = map(sum, zip(x, y))
            values = np.array(list(sums.values()), np.int64).reshape(-1, 3)
            yield pa.record_batch([pa.array([host] * len(sums), pa.string()), _long(np.array(list(sums), np.uint64)), *(pa.array(values[:, j]) for j in range(3))], ["host", "slot", "pages", "chars", "linked"])


def _pack_slots(t: pa.Table) -> pa.Table:
    rows = np.zeros(len(t), _PACKED)
    rows["token"], rows["kind"] = t["slot"].to_numpy().view(np.uint64), np.where(t["menu"].to_numpy(zero_copy_only=False), MENU, NO_MENU)
    return pa.table({"host": t["host"].slice(0, 1), "slots": pa.array([rows.tobytes()], pa.binary())})


def judge_slots(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """Templates with the slots that are frequent on their host's pages without article, and whether each holds a menu."""
    sums = with_templates(pages, templates).select("host", "html", "template").mapInArrow(_slots, "host string, slot long, pages long, chars long, linked long")
    sums = materialize(sums.groupBy("host", "slot").agg(*[F.sum(c).alias(c) for c in ("pages", "chars", "linked")]), "slots")
    n = sums.where("slot = 0").select("host", F.col("pages").alias("n"))
    often = sums.where(F.col("slot") != 0).join(n, "host").where((F.col("pages") >= PAGES) & (F.col("pages") >= SHARE * F.col("n")))
    slots = often.select("host", "slot", (F.col("linked") > LINKS * F.col("chars")).alias("menu")).groupBy("host").applyInArrow(_pack_slots, "host string, slots binary")
    empty = F.lit(b"")
    return materialize(templates.join(slots, "host", "full").select("host", F.concat(F.coalesce("template", empty), F.coalesce("slots", empty)).alias("template")), "judged")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html, template, page_id, url) to page_id, url, text: blocks of the page's articles only if it has some."""
    reader = Reader()
    for b in batches:
        pages, packed, known, out = texts(b.column(1)), b.column(2), {}, []
        for i, host in enumerate(b.column(0).to_pylist()):
            t = known.get(host)
            if t is None:
                t = known[host] = Template(packed[i].as_py())
            found = reader.read(pages[i], t)[1]
            scope = max((x[1] for x in found), default=0)
            keep = (x[5] for x in found if x[1] == scope and not x[4] and (scope or not t.menus.get(x[0], x[3] > LINKS * x[2])))
            out.append(" ".join(keep).encode("utf-8", "replace").decode())
        yield pa.record_batch([b.column(3), b.column(4), pa.array(out, pa.string())], ["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages.

    The text is that of the page's articles (else its main part, else its body) without menus, headers, footers, sidebars,
    notices, adverts, forms, scripts and comments, blocks joined by one blank; white space inside a block counts as one.
    Null and empty pages, and those that hold nothing else, have the empty text. A null url or one without a host is of
    the host ''. Repeated rows and ids are rows of their own; pages of a host with few pages have no template but are
    read the same; other columns are left behind, whatever their names.
    """
    host = F.coalesce(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))
    plain = pages.select(F.col("page_id"), F.col("url").cast("string"), F.col("html").cast("string")).select(host.alias("host"), "html", "page_id", "url")
    bare = plain.select("host", "html")
    judged = judge_slots(bare, deduce_templates(bare))
    kind = plain.schema["page_id"].dataType.simpleString()
    read = with_templates(plain, judged).select("host", "html", "template", "page_id", "url").mapInArrow(_texts, f"page_id {kind}, url string, text string")
    return read.withColumn("n_chars", F.length("text").cast("long"))
