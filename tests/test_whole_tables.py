"""Queries over tables that are larger than the smallest ones in what they count."""

from varqa.functions import keys
from varqa.plans import registry


def test_views_of_all_pages(spark, tmp_path):
    spark.createDataFrame([(i, f"http://h/{i}", "x" * (2990 + i % 20)) for i in range(0, 1001, 2)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.status for r in registry.queries()["join18_views"](spark, str(tmp_path)).collect()}
    assert got == {i: "error" if i % 2 else "unavailable" if i % 20 < 10 else "ok" for i in range(1001)}


def test_keys_of_all_lines(spark, tmp_path):
    spark.createDataFrame([(1, "  Été Aa \n\n \tshaah دِل\r\nनमक"), (2, " \n"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.line): r for r in registry.queries()["fn09_keys"](spark, str(tmp_path)).collect()}
    lines = {(1, 1): "Été Aa", (1, 2): "shaah دِل", (1, 3): "नमक", (2, 1): "", (3, 1): ""}
    assert got.keys() == lines.keys()
    for k, t in lines.items():
        assert (got[k].slug, got[k].latin_key, got[k].plain, got[k].arabic_key, got[k].devanagari_key) == (keys.slugify(t), keys.latin_key(t), keys.strip_marks(t), keys.arabic_key(t), keys.devanagari_key(t))
