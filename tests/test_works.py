import html

import duckdb
from pyspark.sql import functions as F

from varqa.functions import text as T
from varqa.operators.works import ORACLE, src14_problems
from varqa.sources.works import page_works, view_name, work_lines

ROMAN = "<div class='pMC' data-roman='off'><div class='w' data-p='1'><p data-l='1'><span data-m='m1'>rāñjhā </span><span data-m='m2'>kardī</span></p></div></div><div class='x pMC' data-roman='on'><div class='w' data-p='1'><p data-l='1'><span data-m='m1'>ranjha </span><span data-m='m2'>kardi</span></p><p data-l='2'>no  tokens &amp; so</p></div></div>"
MANY = """<div class="sherSection" id="first"><div class="sherLines"><div class='pMC' data-roman='off'><div class='w' data-p='1'><p data-l='1'><span data-m='m1'>muñh </span></p></div></div>
<div class='pMC' data-roman='on'><div class='w' data-p='7'><p data-l='1'><span data-m='m1'>munh</span></p></div></div></div><a class="favorite" data-id="u1"></a></div>
<div class="sherSection" id="second"><div class='pMC' data-roman='off'><div class='w' data-p='1'><p data-l='1'><span data-m='m3'>خدا</span></p></div></div><a class="favorite" data-id="u2"></a></div>
<div class="sherSection" id="third"><a class="favorite" data-id="u3"></a></div><div class="sherSection" id="fourth"><div class='pMC'><p data-l='9'>x</p></div></div>"""


def rows(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    return page_works(df).drop("html")


def test_one_work_in_an_attribute(spark):
    page = f"<h1>An <b>Example</b></h1><div data-contentId='uuid-1'></div><input id='HtmlRawText' data-html=\"{html.escape(ROMAN, quote=True)}\">"
    got = [(r.content_id, r.title, r.layer, r.roman_mode, r.stanza_id, r.line, r.line_id, r.token, r.mapping_id, r.text, r.problem) for r in rows(spark, page).collect()]
    head = ("uuid-1", "An Example")
    assert got == [
        (*head, 0, "off", "1", 0, "1", 0, "m1", "rāñjhā", None), (*head, 0, "off", "1", 0, "1", 1, "m2", "kardī", None),
        (*head, 1, "on", "1", 0, "1", 0, "m1", "ranjha", None), (*head, 1, "on", "1", 0, "1", 1, "m2", "kardi", None), (*head, 1, "on", "1", 1, "2", None, None, "no tokens & so", None),
    ]
    lines = {(r["view"], r.line_id): (r.stanza_id, r.text, r.mappings) for r in work_lines(rows(spark, page), "page_id").collect()}
    assert lines == {("roman_diacritic", "1"): ("1", "rāñjhā kardī", ["m1", "m2"]), ("roman_plain", "1"): ("1", "ranjha kardi", ["m1", "m2"]), ("roman_plain", "2"): ("1", "no tokens & so", [])}


def test_several_works_of_a_page(spark):
    x = rows(spark, MANY)
    got = [(r.record, r.content_id, r.slug, r.title, r.text, r.problem) for r in x.collect()]
    assert got == [(0, "u1", "first", "muñh", "muñh", None), (0, "u1", "first", "muñh", "munh", None), (1, "u2", "second", "خدا", "خدا", None), (2, "u3", "third", None, None, "no layers"), (3, None, "fourth", None, None, "no id")]
    assert {(r.content_id, r["view"], r.stanza_id) for r in work_lines(x, "page_id").collect()} == {("u1", "roman_diacritic", "1"), ("u1", "roman_plain", "7"), ("u2", "urdu", "1")}


def test_broken_pages_are_rows(spark):
    got = [(r.page_id, r.problem) for r in rows(spark, None, "", "<h1>t</h1>", "<h1>t</h1><i data-contentid=1>", "<h1>t</h1><i data-contentid=1><input id=HtmlRawText data-html='&lt;p&gt;'>", "<p" * 50 + "<![x", "<div>" * 5000).collect()]
    assert got == [(0, "no title"), (1, "no title"), (2, "no content id"), (3, "no content"), (4, "no layers"), (5, "no title"), (6, "no title")]


def test_views(spark):
    x = spark.createDataFrame([("abc", "off", "roman_diacritic"), ("abc", "", "roman_plain"), ("خدا", "off", "urdu"), ("क", "", "devanagari")], "t string, m string, want string")
    assert all(r.v == r.want for r in x.select("want", view_name(T.dominant_script(F.col("t")), F.col("m")).alias("v")).collect())


def test_problems_decode_what_their_sql_does(spark, tmp_path):
    """Titles cut inside a reference, and references that the SQL leaves as they are."""
    titles = ["a &amp;&amp", "say &quot;x&quot;", "&lt;b&gt; &amp;lt; &#65; &eacute; & c", "plain"]
    page = [(i, f"<html><h1>{t}</h1><p>&quot;</p></html>") for i, t in enumerate(titles)]
    spark.createDataFrame(page, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {(r.page_id, r.title, r.problem) for r in src14_problems(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert got == set(con.sql(ORACLE["src14_problems"]).fetchall())
