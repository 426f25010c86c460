import json
import os

from pyspark.sql import functions as F

from varqa.operators.evaluation import augment, call_model, verdict
from varqa.functions import keys as K
from varqa.operators.matching import combine_signals, line_similarity, propose_status, score_items, short_text_leaks, top_matches
from varqa.sources import readers as R
from varqa.sources import sinks as S
from varqa.streaming.events import read_events, run_available, windowed


def test_jsonl_names_bad_lines(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"id": "a", "n": 1}\n\n[1]\n{bad\n{"id": "é"}\n', encoding="utf-8")
    rows, errors = R.read_jsonl(spark, str(p), "id string, n int")
    assert [(r.line, r.id, r.n) for r in rows.orderBy("line").collect()] == [(1, "a", 1), (5, "é", None)]
    assert [(e.line, e.problem) for e in errors.orderBy("line").collect()] == [(3, "not an object"), (4, "invalid JSON")]
    rows, errors = R.read_jsonl(spark, str(tmp_path / "none.jsonl"), "id string")
    assert rows.count() == errors.count() == 0


def test_lines_of_large_files_are_numbered_in_parts(spark, tmp_path):
    import json
    import random

    r, want = random.Random(4), {}
    for name, n in (("a.jsonl", 4000), ("b.jsonl", 1), ("c.jsonl", 700), ("empty.jsonl", 0)):
        lines = [r.choice(["", json.dumps({"id": f"é{i}", "t": "x" * r.randint(0, 300)}, ensure_ascii=False), "{broken", "[1]"]) for i in range(n)]
        (tmp_path / name).write_bytes(("\ufeff" + "\n".join(lines)).encode() if n else b"")
        want |= {(name, i): s for i, s in enumerate(lines, 1) if s}
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        rows, errors = R.read_jsonl(spark, str(tmp_path), "id string, t string")
        assert R.numbered_lines(spark, str(tmp_path)).select("path", "line").distinct().count() >= len(want)
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
        bad = {(os.path.basename(e.path), e.line): e.problem for e in errors.collect()}
        assert bad == {k: "invalid JSON" if s == "{broken" else "not an object" for k, s in want.items() if not s.startswith('{"')}
        got = sorted((x.line, x.id, x.t) for x in rows.collect())
        assert got == sorted((k[1], json.loads(s)["id"], json.loads(s)["t"]) for k, s in want.items() if s.startswith('{"'))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_markdown(spark, tmp_path):
    for name in ("b.md", "a.md", "README.md", "x_template.md"):
        (tmp_path / name).write_text("﻿---\nid: 'p1'\nsources:\n- s1\n- \"s2\"\nempty:\n---\n# Original\nline\n\n# Literal Gloss\ng1\n# Literal translation\ng2\n# My Part\nx\n", encoding="utf-8")
    files = R.markdown_paths(spark, str(tmp_path)).collect()
    assert [os.path.basename(f.path) for f in files] == ["a.md", "b.md"]
    fields, rest, error = R.front_matter(files[0].value)
    assert error is None and fields == {"id": ["p1"], "sources": ["s1", "s2"], "empty": []}
    assert R.front_matter("---\nid: x\n")[2] == "front matter is not closed"
    aliases = {"original": "original", "literal gloss": "literal_gloss", "literal translation": "literal_gloss"}
    got = spark.createDataFrame([(rest,)], "t string").select(R.sections(F.col("t"), aliases).alias("s")).first().s
    assert got == {"original": "line", "literal_gloss": "g1\ng2", "my_part": "x"}


def test_bullets(spark):
    t = "- Rights: ok\n- trainable? yes\n- Bare\n- rights: later\nno\n- ishq: love; do not flatten to: romance, desire\n- [placeholder]"
    r = spark.createDataFrame([(t,)], "t string").select(R.bullet_map(F.col("t")).alias("m"), R.bullet_values(F.col("t")).alias("v"), R.key_terms(F.col("t")).alias("k")).first()
    assert r.m["rights"] == "later" and r.m["trainable?"] == "yes" and r.m["bare"] == ""
    assert r.v == ["Rights", "trainable? yes", "Bare", "rights", "ishq", "[placeholder]"]
    assert [x.headword for x in r.k] == ["Rights", "rights", "ishq"]
    assert (r.k[-1].headword, r.k[-1].meaning, r.k[-1].do_not_flatten_to) == ("ishq", "love", ["romance", "desire"])


def test_bullets_at_colons_and_questions(spark):
    t = "- is it ok? no: x\n- why?now\n  -  no\n- a? b? c\n-no\n- : y\n- Ünder : 1:2\n- [slot]: kept\n- "
    r = spark.createDataFrame([(t,), (None,)], "t string").select(R.bullet_map(F.col("t")).alias("m"), R.bullet_values(F.col("t")).alias("v"), R.theme_values(F.col("t")).alias("h")).collect()
    assert r[0].m == {"is it ok? no": "x", "why?now": "", "no": "", "a?": "b? c", "": "y", "ünder": "1:2", "[slot]": "kept"}
    assert r[0].v == ["is it ok? no", "why?now", "no", "a? b? c", "Ünder", "[slot]"]
    assert r[0].h == ["is it ok? no: x", "why?now", "no", "a? b? c", ": y", "Ünder : 1:2"] and r[1].m == {} and r[1].v == r[1].h == []


def test_section_names_of_other_scripts(spark):
    t = "before\n# Été\n a\n\n# ترجمہ\nu1\n # no heading\n# ETE \r\nb\n# Empty\n# ete\n\n# 文\n\nu2\n"
    got = spark.createDataFrame([(t,), (None,)], "t string").select(R.sections(F.col("t"), {}).alias("s")).collect()
    assert got[0].s == {"ete": "a\n\nb", "untitled": "u1\n # no heading\n\nu2", "empty": ""} and got[1].s == {}


def test_html_and_fetch(spark):
    pages = spark.createDataFrame([(1, "<h1>A &amp; B</h1><p>x <a href='/u'>link</a></p>"), (2, None), (3, "<p>only")], "page_id long, html string")
    e = R.html_elements(pages)
    assert {(r.page_id, r.tag, r.ref, r.text) for r in e.collect()} >= {(1, "h1", None, "A & B"), (1, "a", "/u", "link")}
    assert R.catalog(e).where("page_id = 1").first().n_links == 1

    def get(url):
        if url == "bad":
            raise OSError("down")
        return url.upper()

    items = spark.createDataFrame([("a",), ("bad",)], "url string")
    assert {(r.url, r.html, r.failed) for r in R.fetch(items, get).collect()} == {("a", "A", None), ("bad", None, "OSError: down")}
    cache = spark.createDataFrame([("a", "cached")], "url string, html string")
    assert {(r.url, r.html) for r in R.through_cache(items, cache, get, ["url"]).collect()} == {("a", "cached"), ("bad", None)}


def test_segments_and_logs(spark):
    pages = spark.createDataFrame([(1, "front"), (2, "1. One\na"), (3, "b\n2. Two\nc"), (4, "\n")], "page int, text string")
    got = {(r.ordinal, r.title, r.page_start, r.page_end, r.text) for r in R.segments(pages).collect()}
    assert got == {(1, "One", 2, 3, "a\nb"), (2, "Two", 3, 3, "c")}
    log = spark.createDataFrame([("Iter 25: Val loss 1.305, took",), ("Iter 30: Train loss 2.5.",), ("x",)], "value string")
    assert [(r.iter, r.kind, r.loss) for r in R.training_log(log).orderBy("iter").collect()] == [(25, "val", 1.305), (30, "train", 2.5)]
    lines = spark.createDataFrame([("d", 1, "URDU"), ("d", 2, "x"), ("d", 3, "english"), ("d", 4, "y")], "doc string, seq int, s string")
    assert [(r.s, r.mode) for r in R.mode_blocks(lines, {"URDU": "u", "ENGLISH": "e"}).orderBy("seq").collect()] == [("x", "u"), ("y", "e")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, None), (1, "é")], "id int, t string")
    S.write_jsonl(df, str(tmp_path / "o"), "id", files=1)
    (part,) = [f for f in os.listdir(tmp_path / "o") if f.startswith("part")]
    assert [json.loads(x) for x in (tmp_path / "o" / part).read_text(encoding="utf-8").splitlines()] == [{"id": 1, "t": "é"}, {"id": 2, "t": None}]
    assert S.markdown_table(df, "id") == "| id | t |\n|---|---|\n| 1 | é |\n| 2 |  |\n"
    assert {(r.id, r.t) for r in S.upsert(df, spark.createDataFrame([(1, "new")], "id int, t string"), "id").collect()} == {(1, "new"), (2, None)}
    assert S.replace_section("# A\nx\n# B\ny\n", "a", "z") == "# A\nz\n# B\ny\n"
    assert S.rename_heading("# A\r\n# AB\n", "A", "C") == "# C\r\n# AB\n"
    wrote = []
    assert len(S.gated_write(df, df.where("id = 1"), wrote.append)) == 1 and not wrote
    assert S.gated_write(df, df.limit(0), wrote.append) == [] and wrote
    out, same = S.resume(df.limit(0), df, "id", lambda x: x)
    assert same and out.count() == 2
    a, b = (S.bundle_manifest({"t": x}).first() for x in (df, df.orderBy("id")))
    assert a == b and a.rows == 2
    old = spark.createDataFrame([("out_00007", "x")], "id string, t string")
    assert {r.id for r in S.append_numbered(old, spark.createDataFrame([("y",)], "t string"), "out_", F.col("t")).collect()} == {"out_00007", "out_00008"}


def test_status_proposals(spark):
    cases = [(False, 0, 0, 0, 0, 0, "unmatched"), (True, 0.0, 0.0, 0.0, 0.0, 0, "unmatched"), (True, 1.0, 0.95, 1.0, 1.0, 0, "exact_witness"), (True, 0.4, 0.3, 0.8, 0.9, 0, "variant"), (True, 0.9, 0.2, 0.9, 0.3, 0, "excerpt"), (True, 0.0, 0.0, 0.4, 0.2, 0, "possible")]
    df = spark.createDataFrame([(c[0], *map(float, c[1:5]), c[5], c[6]) for c in cases], "ch boolean, a double, b double, c double, d double, e int, want string")
    assert all(r.s == r.want for r in df.select("want", propose_status(*[F.col(x) for x in ("ch", "a", "b", "c", "d", "e")]).alias("s")).collect())


def test_score_combination(spark):
    rows = [(0.8, 0.8, 0.0, 0, 0.85), (0.5, 0.0, 1.0, 0, 0.98), (0.1, 0.2, 0.0, 1, 1.0), (0.96, 0.96, 0.0, 0, 1.0)]
    df = spark.createDataFrame(rows, "r double, u double, a double, e int, want double")
    assert all(x.s == x.want for x in df.select("want", combine_signals([F.col("r")], [F.col("u")], [F.col("a")], F.col("e")).alias("s")).collect())


def test_line_similarity_is_lossless(spark):
    from varqa.functions.keys import latin_key, similarity

    a = [(1, "the cat sat on the mat\nanother line here"), (2, "The cat sat on a mat"), (3, "zzz")]
    b = [(10, "the cat sat upon the mat\nanother lime here"), (11, "q")]
    got = {(r.k, r.pos, r.o, r.other_pos) for r in line_similarity(spark.createDataFrame(a, "k int, text string"), "k", spark.createDataFrame(b, "o int, text string"), "o", 0.8).collect()}
    want = {(k, i, o, j) for k, t in a for i, x in enumerate(t.split("\n")) for o, s in b for j, y in enumerate(s.split("\n")) if similarity(latin_key(x), latin_key(y)) >= 0.8}
    assert got == want and want


def test_short_leaks(spark):
    texts = spark.createDataFrame([(1, "see divine love endures here"), (2, "nothing"), (3, "overdivine love endurester")], "k int, text string")
    short = spark.createDataFrame([(7, "Divine love endures"), (8, "thing")], "p int, text string")
    assert {(r.k, r.p) for r in short_text_leaks(texts, "k", short, "p").collect()} == {(1, 7), (3, 7), (2, 8)}


def test_model_calls_and_verdict(spark):
    df = spark.createDataFrame([(1, "train", "f", "good?"), (2, "train", "f", "bad?"), (3, "train", "f", "third?"), (4, "eval", "f", "eval?")], "seq int, split string, family string, question string")

    def para(q):
        if "bad" in q:
            raise ValueError("no")
        return q + " indeed"

    got = augment(df, para, lambda p: "Yes", 2).collect()
    assert {(r.seq, r.accepted) for r in got} == {(1, True), (2, False)}
    assert call_model(df, "question", para).where("seq = 2").first().failed == "ValueError: no"
    runs = spark.createDataFrame([("base", 0.2, 0.3), ("base_rag", 0.4, 0.9), ("tuned", 0.3, 0.3), ("tuned_rag", 0.4, 0.8)], "name string, factual double, honesty double")
    assert verdict(runs).first().verdict == "pass" and verdict(runs.where("name <> 'base'")).first().verdict == "incomplete"


def test_streams_resume(spark, sf_dir, tmp_path):
    src = tmp_path / "in"
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(2).write.parquet(str(src))
    seen = []
    run_available(read_events(spark, str(src)), str(tmp_path / "cp"), lambda df, i: seen.append(df.count()))
    run_available(read_events(spark, str(src)), str(tmp_path / "cp"), lambda df, i: seen.append(df.count()))
    assert sum(seen) == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    q = windowed(read_events(spark, str(src)), "1 day", late="1 day").writeStream.format("memory").queryName("w").outputMode("append").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert 0 < spark.table("w").count()


def test_item_scores_match_brute_force(spark):
    roman = ["ilmon bas kari o yaar", "ikko alif tere darkaar", "raanjha raanjha kardi ni main", "aape raanjha hoi", "ki jaana main kaun", "bulleya ki jaana"]
    urdu = ["علموں بس کریں او یار", "اکو الف تیرے درکار", "رانجھا رانجھا کردی", "کی جاناں میں کون"]
    items = [
        ("a", "Ilmon bas kari", "ilmõ bas karī o yār\nikko alif tere darkār", None, urdu[0], None, None),
        ("b", "Ranjha", None, "رانجھا", "رانجھا کردی نی\n", "राँझा", "राँझा राँझा करदी"),
        ("c", "", "", "", "", "", "बुल्ल्हिआ की जाणां मैं कौण"),
        ("d", "nothing like it 999", "zz top\nqq", None, None, None, None),
    ]
    entries = [("e1", "Ilmon bas", "\n".join(roman[:2]), "\n".join(urdu[:2])), ("e2", "Ranjha ranjha", "\n".join(roman[2:4]), urdu[2]), ("e3", "Ki jana", "\n".join(roman[4:]), urdu[3]), ("e4", None, None, None)]
    keyed = lambda make, text: [k for k in (make(x) for x in (text or "").split("\n")) if k]
    least, want = 0.5, {}

    def best(left, right):
        return max((x for x in (K.similarity(p, q) for p in left for q in right) if x >= least), default=0.0)

    for i, rt, rx, ut, ux, dt, dx in items:
        for e, title, er, eu in entries:
            t, r, u = keyed(K.latin_key, title), keyed(K.latin_key, er), keyed(K.arabic_key, eu)
            rl, ul = keyed(K.latin_key, rx), keyed(K.arabic_key, ux)
            s = [best(keyed(K.latin_key, rt), t), best(keyed(K.latin_key, rt), t + r), best(rl, r), best(keyed(K.arabic_key, ut), u), best(ul, u), best(keyed(K.devanagari_key, dt), t + r), best(keyed(K.devanagari_key, dx), r)]
            exact = len(set(rl) & set(r)) + len(set(ul) & set(u))
            a, b, score = max(s[1:3]), max(s[3:5]), max(s[:5])
            score = max(score, min(1.0, (a + b) / 2 + 0.05)) if a >= 0.75 and b >= 0.75 else score
            score = 1.0 if exact else max(score, min(0.98, max(s[5:])))
            if score > 0:
                want[i, e] = (round(score, 4), sorted(round(x, 4) for x in s if x > 0), exact)
    kinds = "item_id string, roman_title string, roman_text string, urdu_title string, urdu_text string, devanagari_title string, devanagari_text string"
    scored = score_items(spark.createDataFrame(items, kinds), spark.createDataFrame(entries, "entry_id string, title string, roman_text string, urdu_text string"), least)
    got = {(r.item_id, r.entry_id): (r.score, sorted(r.signals.values()), r.exact_roman + r.exact_urdu) for r in scored.collect()}
    assert got == want and len({i for i, _ in got}) >= 3 and any(x[2] for x in got.values())
    first = {r.item_id: r.entry_id for r in top_matches(scored, "item_id", "entry_id", 1).collect()}
    assert first["a"] == "e1" and first["b"] == "e2"
    assert score_items(spark.createDataFrame([], kinds), spark.createDataFrame([], "entry_id string, title string, roman_text string, urdu_text string")).count() == 0


def test_elements_go_on_in_pieces(spark, monkeypatch):
    """A task holds no more than a piece of the elements of its pages, and loses none."""
    rows, batches, most = (spark.sparkContext.accumulator(0) for _ in range(3))
    make = R._element_batch

    def watched(out, key):
        rows.add(len(out))
        batches.add(1)
        most.add(int(len(out) > 5))
        return make(out, key)

    monkeypatch.setattr(R, "PIECE", 1000)
    monkeypatch.setattr(R, "_element_batch", watched)
    pages = spark.range(400).selectExpr("id AS page_id", "concat('<h1>t', id, '</h1>', repeat(concat('<p>', repeat('x', 200), '</p>'), 7)) AS html").coalesce(1)
    got = R.html_elements(pages.union(spark.createDataFrame([(400, None), (401, "")], "page_id long, html string"))).collect()
    assert len(got) == rows.value == 3200 and batches.value >= 640 and most.value == 0
    assert sorted((r.page_id, r.pos) for r in got) == [(i, j) for i in range(400) for j in range(8)]
