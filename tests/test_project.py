from pyspark.sql import functions as F

from varqa.operators.project import dashboard, poem_rules, record_rules, validate_project, violations, write_observed

KINDS = "id string, poet_id string, title string, work_type string, source_ids array<string>, rights_status string, original struct<text: string>, transliteration struct<text: string>, translations array<struct<kind: string, text: string, trainable: boolean>>, tashreeh array<string>, review string, publication struct<include_on_website: boolean>"
BOTH = [("literal_gloss", "g", True), ("literary_translation", "l", True)]


def work(i, **more):
    x = {"id": i, "poet_id": "p", "title": "t", "work_type": "w", "source_ids": ["s"], "rights_status": "public-domain", "original": ("o",), "transliteration": ("tr",), "translations": BOTH, "tashreeh": [], "review": "r", "publication": (False,)}
    return tuple((x | more).values())


def found(df):
    return {(r.level, r.record_id, r.rule) for r in df.collect()}


def test_rules_of_works(spark):
    ref = ("reference_translation", "r", None)
    x = spark.createDataFrame(
        [
            work("fine"), work(None), work("twice"), work("twice"), work("a", poet_id=None, title=None, original=None), work("b", original=(" ",), transliteration=None), work("c", translations=BOTH[:1]), work("d", translations=[BOTH[0], BOTH[0]]),
            work("e", translations=[BOTH[1], ref]), work("f", translations=[BOTH[1], (*ref[:2], False)]), work("g", translations=[BOTH[1], ("x", "[todo: fill]", True)]), work("h", publication=(True,), rights_status="unknown"),
            work("i", publication=(True,), rights_status=None), work("j", transliteration=("aa ṁ 'ain",)), work("k", transliteration=("[add aa]",)), work("l", translations=None),
        ], KINDS)
    assert found(violations(x, poem_rules(x.columns), "works")) == {
        ("error", None, "no id"), ("error", "twice", "repeated id"), ("error", "a", "no poet_id"), ("error", "a", "no title"), ("error", "a", "no original"), ("warning", "a", "no original text"), ("warning", "b", "no original text"),
        ("error", "b", "no transliteration"), ("warning", "b", "no transliteration text"), ("warning", "c", "fewer than two translations"), ("warning", "d", "no literary translation"), ("error", "e", "trainable reference translation"),
        ("warning", "g", "no literal translation"), ("warning", "g", "placeholder"), ("error", "h", "published without rights"), ("error", "i", "no rights_status"), ("error", "i", "published without rights"),
        ("warning", "j", "style: doubled"), ("warning", "j", "style: nasal"), ("warning", "j", "style: ain"), ("warning", "k", "placeholder"), ("error", "l", "no translations"), ("warning", "l", "fewer than two translations"),
    }
    bare = spark.createDataFrame([("z",)], "id string")
    assert {r for _, _, r in found(violations(bare, poem_rules(bare.columns), "works"))} >= {"no poet_id", "no publication", "no original text", "fewer than two translations"}
    assert violations(x.limit(0), poem_rules(x.columns), "works").count() == 0


def test_counts_while_writing(spark, tmp_path):
    x = spark.createDataFrame([("a", "x"), (None, "[paste here]"), ("", None), ("a", "y")], "id string, text string")
    got = write_observed(x, str(tmp_path / "t"), record_rules(F.col("text")), {"characters": F.sum(F.length("text"))})
    assert got == {"rows": 4, "error: no id": 2, "warning: placeholder": 1, "characters": 14, "errors": 2, "warnings": 1}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4


def test_dashboard_reads_each_table_once(spark, tmp_path):
    for name in ("a", "b"):
        spark.createDataFrame([(str(i % 3), f"t{i}") for i in range(5)], "id string, text string").write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    one = dashboard({"a": (a, {"rows": F.count("*"), "ids": F.countDistinct("id"), "sum": F.sum(F.lit(2))}), "b": (b.limit(0), {"none": F.sum(F.lit(1))})})
    assert {r.metric: r.n for r in one.collect()} == {"rows": 5, "ids": 3, "sum": 10, "none": 0}
    plan = dashboard({"a": (a, {"rows": F.count("*"), "ids": F.countDistinct("id"), "t0": F.count_if(F.col("text") == "t0")})})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    both = validate_project({"a": (a, record_rules()), "b": (b, record_rules())})
    full = dashboard({"a": (a, {"rows": F.count("*")})}, both)
    assert {r.metric: r.n for r in full.collect()} == {"rows": 5, "validation_errors": 4, "validation_warnings": 0}
