import html as entities
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from varqa.llm import html as H
from varqa.llm.html import Reader, Template, deduce_templates, main_text

WORDS = "ka ti so ra me lu pi no da ve gor fel mun sil tar bex".split()


def sentence(r, n):
    return " ".join(r.choice(WORDS) + r.choice(WORDS) for _ in range(n)).capitalize() + "."


def page(r, i, article=True):
    """A page of a made-up site and its main text. Without article, only the template tells the parts from one another."""
    title, paras = sentence(r, 6), [sentence(r, r.randint(4, 40)) for _ in range(r.randint(1, 6))]
    links = "".join(f'<li><a href="/{w}">{w}{r.choice(WORDS)}</a></li>' for w in r.sample(WORDS, 5))
    body = f"<h1>{title}</h1>" + "".join(f"<p>{p[:5]}<b>{p[5:9]}</b>{p[9:]}<br>" for p in paras)
    notice, share = "Every visit to this site leaves crumbs with us", "Print or send this page to your friends"
    if article:
        inside = f'<article><div class="share-bar">{sentence(r, 4)}</div>{body}<aside>{sentence(r, 5)}</aside><section class="comments" id="c{i}"><p>{sentence(r, 9)}</p></section></article>'
        rest = f'<header><p>{sentence(r, 3)}</p></header><nav><ul>{links}</ul></nav>{inside}<form><label>{sentence(r, 2)}</label></form><div class="cookie-notice">{notice}</div><footer>{sentence(r, 5)}</footer>'
    else:
        rest = f'<div class="x1"><ul>{links}</ul></div><div class="x2">{notice}</div><div class="x3">{body}</div><div class="x4"><span>{share}</span></div>'
    head = f'<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t="</p>";f({i})</script></head><!-- {sentence(r, 3)} -->'
    return f"{head}<body>{rest}</body></html>", " ".join([title, *paras])


def extracted(spark, rows, schema="page_id long, url string, html string"):
    return {r.page_id: r for r in main_text(spark.createDataFrame(rows, schema)).collect()}


def test_articles_and_bare_templates(spark):
    r, rows, want = random.Random(7), [], {}
    for i in range(120):
        p, want[i] = page(r, i, article=i % 3 == 0)
        rows.append((i, f"https://{'one' if i % 3 == 0 else 'two' if i % 3 == 1 else 'three'}.example.org/{i}", p))
    got = extracted(spark, rows)
    assert {i: got[i].text for i in got} == want
    assert all(x.n_chars == len(x.text) and x.url == rows[x.page_id][1] for x in got.values())


def test_copies_do_not_become_a_template(spark):
    r, rows, want = random.Random(3), [], {}
    copy = page(r, 0, article=False)
    for i in range(60):
        p, want[i] = copy if i < 50 else page(r, i, article=False)
        rows.append((i, "http://h.example.com/", p.replace("</h1>", f" {i}</h1>") if i < 50 and i % 2 else p))
        want[i] = want[i].replace(".", f". {i}", 1) if i < 50 and i % 2 else want[i]
    assert {i: x.text for i, x in extracted(spark, rows).items()} == want


def brute_classes(pages):
    """Large and frequent classes of one host's pages from whole occurrence vectors: sets of tokens."""
    reads = [Reader().read(p) for p in pages]
    counts = [Counter(x[0]) for x in reads]
    titles = Counter(x[2] for x in reads)
    common = max(titles.values())
    by_vector = defaultdict(set)
    for t in set().union(*counts):
        vector = tuple(c[t] for c in counts)
        support = sum(v > 0 for v in vector)
        spread = len(titles) >= 5 and support - common >= 0.9 * (len(pages) - common)
        if support >= max(3, 0.3 * len(pages)) and (t % 2 == 0 or spread):
            by_vector[vector].add(t)
    return {frozenset(x) for x in by_vector.values() if len(x) >= 3}


def test_classes_equal_whole_vectors(spark, monkeypatch):
    r, seen = random.Random(11), {}
    monkeypatch.setattr(H, "materialize", lambda df, name: seen.setdefault(name, df.cache()))
    hosts = {"a": [page(r, i, True)[0] for i in range(9)], "b": [page(r, i, False)[0] for i in range(14)], "c": ["<p>x</p>"] * 2}
    docs = spark.createDataFrame([(h, p) for h, ps in hosts.items() for p in ps], "host string, html string")
    valid = {x.host: Template(bytes(x.template)) for x in deduce_templates(docs).collect()}
    first = {x.host: Template(bytes(x.template)) for x in seen["classes"].collect()}
    for h in "ab":
        t = first[h]
        got = {frozenset(t.tokens[t.cls == c].tolist()) for c in np.unique(t.cls)}
        assert got == brute_classes(hosts[h])
        assert set(valid[h].tokens.tolist()) <= set(t.tokens.tolist()) and len(valid[h].tags) >= 10
    assert "c" not in first
    assert any("crumbs" in p for p in hosts["b"]) and valid["b"].texts


def test_places_tell_order_and_nesting():
    rows = np.zeros(4, H._PACKED)
    rows["token"], rows["cls"], rows["kind"] = [2, 4, 6, 9], [0, 0, 1, 1], [1, 1, 0, 0]
    t = Template(rows.tobytes())
    index, place, gap = t.places(np.array([2, 50, 6, 9, 6, 9, 4, 77], np.uint64))
    assert (t.tokens[index].tolist(), place.tolist(), gap.tolist()) == ([2, 6, 9, 6, 9, 4], [0, 0, 0, 0, 0, 1], [0, 1, 1, 1, 1, 0])
    assert [len(x) for x in Template(None).places(np.array([1], np.uint64))] == [0, 0, 0]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article>a&amp;b &eacute;&#x41;&nbsp;c <b>d</b>e</article>", "a&b éA c de"),
        ("plain text, a < b and c", "plain text, a < b and c"),
        ("<p>one<p>two<ul><li>x<li>y</ul>", "one two x y"),
        ("<article><p>in</p></article>out", "in"),
        ("<main><h1>t</h1>m</main><div>out</div>", "t m"),
        ("<form><article>kept</article>field</form>", "kept"),
        ("<article><header><h1>Head</h1></header>x<footer>f</footer></article>", "Head x"),
        ("<div class='has-sidebar layout'>text</div><div class=sidebar>s</div>", "text"),
        ("a<!-- unclosed", "a"),
        ("<script>no</p>", ""),
        ("<p title='>'>q</p>", "q"),
        ("<b><i>x</b>y", "xy"),
        ("<div>" * 3000 + "deep", "deep"),
        ("</p></div>stray", "stray"),
        ("<svg><title>t</title></svg><title>no</title>z", "z"),
        ("\t \n", ""),
    ],
)
def test_single_pages(page, want):
    found = Reader().read(page)[1]
    scope = max((b[1] for b in found), default=0)
    assert " ".join(b[5] for b in found if b[1] == scope) == want


def test_odd_rows(spark):
    long = "<article>" + "<p>word &lt; <i>x</i>" * 60_000 + "</article>"
    rows = [(1, "http://a.b/", None), (2, "http://a.b/", ""), (None, None, "<p>no id</p>"), (3, "not a url", "<p>x</p>"), (4, "HTTP://u:p@A.B:80/x", long)]
    rows += [(5, "http://same/", "<article>twice</article>")] * 2
    df = main_text(spark.createDataFrame([(*x, "other", 1) for x in rows], "page_id long, url string, html string, text string, host int"))
    got = sorted((x.page_id is None, x.page_id or 0, x.text[:20], x.n_chars) for x in df.collect())
    assert df.columns == ["page_id", "url", "text", "n_chars"]
    assert got == [(False, 1, "", 0), (False, 2, "", 0), (False, 3, "x", 1), (False, 4, "word < x word < x wo", 60_000 * 9 - 1), (False, 5, "twice", 5), (False, 5, "twice", 5), (True, 0, "no id", 5)]
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_over_the_whole_table(spark, sf_dir):
    """The given pages have one article each: its text, cut out plainly."""
    from varqa.llm.queries import QUERIES

    got = {r.page_id: r for r in QUERIES["op11_html"](spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(got) == len(pages)
    for r in pages:
        inside = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", r.html, re.S)[1])
        want = " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", inside)).split())
        assert (got[r.page_id].text, got[r.page_id].n_chars) == (want, len(want))
