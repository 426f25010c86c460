import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from tests.llm.test_mixing import targets
from tests.llm.test_simhash import brute as brute_simhash
from varqa.llm.decontam import _norm_one
from varqa.llm.mixing import mix_copies
from varqa.llm.toxicity import train_toxicity


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    base = tmp_path_factory.mktemp("stages")
    for i, (_, stage) in enumerate(P.STAGES):
        df = stage(spark, docs, sf_dir)
        df.write.parquet(f"{base}/{i}")
        out.append((docs, spark.read.parquet(f"{base}/{i}")))
        docs = out[-1][1]
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(spark, sf_dir, stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near duplicates", "decontamination", "mixing", "tokens"]
    want = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert all(after.columns == want for _, after in stages[:-1])


def test_toxicity_stage(spark, sf_dir, stages):
    before, after = stages[0]
    m = train_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = m.scorer()
    assert set(rows(after)) == {d for d, r in rows(before).items() if score(r.text) < 0.5}


def test_near_duplicates_stage(stages):
    before, after = stages[1]
    comp = {d: c for d, _, c in brute_simhash([(r.doc_id, r.text) for r in before.collect()])}
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, c in comp.items() if d == c)


def test_decontamination_stage(spark, sf_dir, stages):
    before, after = stages[2]
    items = [_norm_one(r.text).tobytes() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {d for d, r in rows(before).items() if not any(i in _norm_one(r.text).tobytes() for i in items)}
    assert set(rows(after)) == clean


def test_mixing_stage(stages):
    before, after = stages[3]
    want = {r.doc_id: r.copies for r in mix_copies(before).collect() if r.copies}
    got = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert got == want
    texts = rows(before)
    assert all(r.text == texts[r.doc_id].text and r.source == texts[r.doc_id].source for r in after.collect())


def test_mixing_stage_meets_targets_worked_out_plainly(stages):
    before, after = stages[3]
    words = lambda t: len((t or "").encode().split())
    sizes, longest, copies = Counter(), Counter(), Counter(r.doc_id for r in after.collect())
    for r in before.collect():
        sizes[r.source] += words(r.text)
        longest[r.source] = max(longest[r.source], words(r.text))
    want, taken = targets(sizes), Counter()
    for r in before.collect():
        expected = want[r.source] / sizes[r.source] if words(r.text) else 0
        assert math.floor(expected + 1e-9) <= copies[r.doc_id] <= math.ceil(expected - 1e-9)
        taken[r.source] += copies[r.doc_id] * words(r.text)
    assert all(abs(taken[s] - want[s]) <= longest[s] for s in want)


def test_tokens_stage(stages):
    before, after = stages[4]
    t, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for r in sorted(before.collect(), key=lambda r: r.doc_id):
        ids = np.array([*t.encode(r.text, add_special_tokens=False).ids, 2], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in after.collect()) == want


def test_run_gives_the_last_stage_and_agrees_with_itself(spark, sf_dir, stages):
    assert sorted(map(tuple, P.run(spark, sf_dir).collect())) == sorted(map(tuple, stages[4][1].collect()))


@pytest.fixture(scope="module")
def odd_tables(spark, tmp_path_factory):
    """Tables with nulls, empty and long texts, repeated rows and columns of names that operators use themselves."""
    base = tmp_path_factory.mktemp("odd")
    words = "the quick brown fox jumps over the lazy dog while many other animals sleep under old trees tonight".split()
    rows = [(i, " ".join(words[(i * k) % len(words)] + str(i) for k in range(1, 30)), "en", f"s{i % 3}", i) for i in range(12)]
    rows += [(None, "you idiot " * 9, "en", "s1", 100), (None, rows[3][1], None, None, 101), (20, None, None, "s1", 102), (21, "", "en", None, 103), (22, "w " * 60_000, "en", "s0", 104)]
    rows += [(5, rows[5][1], "en", "s2", 105), (23, "x " + " ".join(words), "en", "s0", 106)]
    names = ("_n", "_copies", "_first", "row", "h", "id", "none", "n", "score", "batch")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *(f"n_chars as `{x}`" for x in (*names, "a.b")))
    docs.write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(1, " ".join(words)), (None, "never asked before"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return str(base)


def test_odd_rows_pass_every_stage(spark, odd_tables, tmp_path):
    docs = spark.read.parquet(f"{odd_tables}/documents.parquet")
    columns, kept = docs.columns, []
    for i, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, odd_tables).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept.append(docs)
    assert all(x.columns == columns for x in kept[:-1])
    assert all(r[c] == r.n_chars for x in kept[:-1] for r in x.collect() for c in columns[5:])
    assert kept[0].count() == 19  # labels of no toxic row teach nothing
    ids = [r.doc_id for r in kept[1].collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [*range(12), 20, 22, 23, None]))  # 21 is blank like 20; the row near 3 has no id
    assert 23 not in {r.doc_id for r in kept[2].collect()} and kept[2].count() == len(ids) - 1
    assert {r.doc_id for r in kept[3].collect()} <= {r.doc_id for r in kept[2].collect()} - {20}
    got, start = sorted(kept[4].collect(), key=lambda r: r.start), 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert len(got) == kept[3].count()


def test_an_empty_table_passes_every_stage(spark, odd_tables):
    docs = spark.read.parquet(f"{odd_tables}/documents.parquet").limit(0)
    for name, stage in P.STAGES[:-1]:
        got = stage(spark, docs, odd_tables)
        assert got.columns == docs.columns and got.count() == 0, name
    assert P.STAGES[-1][1](spark, docs, odd_tables).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert P.STAGES[-1][1](spark, docs, odd_tables).count() == 0
