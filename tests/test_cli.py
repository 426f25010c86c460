import pytest

from varqa.__main__ import main


def test_build_and_validate(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "e1.md").write_text("---\nid: p1\ntitle: One\nlanguage: pa / ur\n---\n# Original\nline a\nline b\n# Literary Translation\nT\n", encoding="utf-8")
    (tmp_path / "in" / "e2.md").write_text("---\nid: p2\n---\n# Original\n[Paste or type here]\n", encoding="utf-8")
    out = str(tmp_path / "out")
    assert main(["build-data", "--data", str(tmp_path / "in"), "--out", out], spark) == 0
    (r,) = spark.read.parquet(f"{out}/records.parquet").collect()
    assert r.id == "p1" and [x.segment_id for x in r.segmentation] == ["p1_l1", "p1_l2"] and r.original.language == "pa"
    assert [t.kind for t in r.translations] == ["ai_translation", "literary_translation"]
    assert main(["build-data", "--data", str(tmp_path / "in"), "--out", out, "--include-placeholders"], spark) == 0
    assert spark.read.parquet(f"{out}/records.parquet").count() == 2
    assert main(["status", "--data", out, "--out", out], spark) == 0
    assert spark.read.parquet(f"{out}/status.parquet").first().records == 2


def test_a_leak_keeps_the_corpus_from_being_written(spark, tmp_path):
    kinds = "id string, original string, transliteration string, rights string, translations array<struct<kind: string, text: string, rights: string, trainable: boolean>>, tashreeh array<struct<text: string, rights: string, trainable: boolean>>"
    text = "one two three four five six seven eight nine"
    spark.createDataFrame([("p", "o", None, "r", [("literary", text, "r", True), ("x", "kept out", "r", None)], [])], kinds).write.parquet(str(tmp_path / "poems.parquet"))
    spark.createDataFrame([(f"0 {text} 10",)], "text string").write.parquet(str(tmp_path / "safe.parquet"))
    args = ["export-training-corpus", "--data", str(tmp_path), "--out", str(tmp_path / "o")]
    assert main([*args, "--protected", str(tmp_path / "safe.parquet")], spark) == 1 and not (tmp_path / "o").exists()
    assert main(args, spark) == 0
    assert {r.kind for r in spark.read.parquet(str(tmp_path / "o" / "layers.parquet")).collect()} == {"original", "literary"}


def test_validate_writes_its_report_and_fails_on_errors(spark, tmp_path):
    kinds = "id string, text string, published boolean, rights string"
    spark.createDataFrame([("a", "fine", True, "public-domain"), ("b", None, False, "x")], kinds).write.parquet(str(tmp_path / "records.parquet"))
    assert main(["validate", "--data", str(tmp_path), "--out", str(tmp_path / "o")], spark) == 1
    assert [(r.record_id, r.rule) for r in spark.read.parquet(str(tmp_path / "o" / "violations.parquet")).collect()] == [("b", "no text")]
    spark.createDataFrame([("a", "fine", True, "public-domain")], kinds).write.mode("overwrite").parquet(str(tmp_path / "records.parquet"))
    assert main(["validate", "--data", str(tmp_path), "--out", str(tmp_path / "o")], spark) == 0


def test_a_broken_entry_fails_the_step(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "e1.md").write_text("---\nid: p1\n# Original\nx\n", encoding="utf-8")
    with pytest.raises(Exception, match="front matter is not closed"):
        main(["build-data", "--data", str(tmp_path / "in"), "--out", str(tmp_path / "o")], spark)
    assert not (tmp_path / "o" / "records.parquet").exists() or not list((tmp_path / "o" / "records.parquet").glob("*.parquet"))


def test_gates_of_the_corpus_and_examples_fail_closed(spark, tmp_path):
    kinds = "id string, original string, transliteration string, rights string, translations array<struct<kind: string, text: string, rights: string, trainable: boolean>>, tashreeh array<struct<text: string, rights: string, trainable: boolean>>"
    own = [("reference_translation", "Love burns", "copyrighted", False), ("literary", "They say: love burns bright", "r", True)]
    spark.createDataFrame([("p", "o", None, "r", own, [])], kinds).write.parquet(str(tmp_path / "poems.parquet"))
    args = ["export-training-corpus", "--data", str(tmp_path), "--out", str(tmp_path / "o")]
    assert main(args, spark) == 1 and not (tmp_path / "o").exists()  # a short reference text, without being asked for
    assert main([*args, "--include-reference"], spark) == 0

    poems = "id string, title string, original string, translation string, transliteration string, note string, uncertain boolean"
    d = tmp_path / "g"
    spark.createDataFrame([(f"p{i}", f"T{i}", f"line {i} of many", "a b" if i else "one two three four five six seven eight nine", "", "", False) for i in range(12)], poems).write.parquet(str(d / "poems.parquet"))
    spark.createDataFrame([], "kb_id string, kind string, text string, titles array<string>").write.parquet(str(d / "knowledge_base.parquet"))
    args = ["generate-training-data", "--data", str(d), "--out", str(tmp_path / "e")]
    with pytest.raises(SystemExit, match="no texts to protect"):
        main(args, spark)
    spark.createDataFrame([("x two three four five six seven eight nine",)], "text string").write.parquet(str(tmp_path / "safe.parquet"))
    assert main([*args, "--protected", str(tmp_path / "safe.parquet")], spark) == 1 and not (tmp_path / "e").exists()
    assert main([*args, "--include-reference"], spark) == 0


def test_example_gates(spark):
    from varqa.operators.evaluation import example_violations

    kinds = "id string, seq long, messages array<struct<role: string, content: string>>, question string, answer string, uncertain boolean, split string, work string"
    e = lambda i, q, a, u, s, w: (f"e{i}", i, [("system", "s"), ("user", q), ("assistant", a)], q, a, u, s, w)
    x = spark.createDataFrame([e(1, "What is it?", "This.", False, "train", "w1"), e(2, "what IS it", "That, uncertain.", True, "eval", "w2"), e(3, "Why?", "So.", True, "train", "w2"), e(4, "How?", "Love burns here", None, "train", "")], kinds)
    safe = spark.createDataFrame([("k", "love burns")], "protected string, text string")
    got = {(r.id, r.rule, r.other) for r in example_violations(x, safe).collect()}
    assert got == {("e2", "repeated question", "e1"), ("e3", "unhedged", None), ("e2", "work in both splits", "w2"), ("e4", "repeats a protected text", "k")}
    assert {r.rule for r in example_violations(x, None, holdout=False).collect()} == {"repeated question", "unhedged"}
