import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from varqa.llm import fim
from varqa.llm.fim import Runs, digests, fill_in_middle


def brute(doc_id, text):
    """The contract, read plainly: doc_id, n, form, prefix_chars, middle_chars, output."""
    text = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab<PSM>é文😀\0\n"), max_size=40), max_size=6))
def test_runs_are_maximal_and_exact(texts):
    flat = np.frombuffer("".join(texts).encode(), np.uint8)
    for chunk in (1 << 20, 3):
        fim.CHUNK, kept = chunk, fim.CHUNK
        r, fim.CHUNK = Runs(flat), kept
        assert (r.width[1:] != r.width[:-1]).all()
        at = np.cumsum([0, *[len(c.encode()) for t in texts for c in t]])
        units = np.arange(len(at))
        assert r.byte_of(units).tolist() == at.tolist() and r.unit_of(at).tolist() == units.tolist()


def check(spark, rows, schema="doc_id long, text string"):
    docs = spark.createDataFrame(rows, schema)
    made = fill_in_middle(docs)
    key = lambda r: repr(tuple(r))
    got = sorted((tuple(r) for r in made.collect()), key=key)
    assert got == sorted((brute(r[0], r[1]) for r in rows), key=key)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    back = sorted((r.doc_id is None, r.doc_id or 0, r.output_sha256, r.restored_sha256) for r in digests(made).collect())
    assert back == sorted((r[0] is None, r[0] or 0, sha(brute(r[0], r[1])[5]), sha(r[1])) for r in rows)


def test_odd_rows_equal_brute_force(spark):
    mixed = "añ文😀\n\t<P" * 7
    rows = [(i, mixed[: i % 50] + "<S" * (i % 3)) for i in range(400)]
    rows += [(None, "no id, é"), (None, None), (7, None), (8, ""), (9, "has <M> inside"), (10, "<"), (10, "<"), (11, "P>文<S"), (-5, "below zero"), (12, "long é😀 " * 200_000)]
    check(spark, rows)


def test_other_columns_and_empty_tables(spark):
    check(spark, [(1, "abc", "x", 5, None)], "doc_id long, text string, form string, n long, output string")
    assert fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("slice_bytes", [1, 64, 1 << 20])
def test_slices_do_not_matter(spark, monkeypatch, slice_bytes):
    import pyarrow as pa

    monkeypatch.setattr(fim, "SLICE", slice_bytes)
    texts = ["é" * i + "a文" * (i % 4) for i in range(30)]
    b = pa.record_batch([pa.array(range(30), pa.int64()), pa.array(texts)], ["doc_id", "text"])

    class Docs:  # the function that the workers run, without workers
        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    rows = [tuple(r.values()) for out in fill_in_middle(Docs())(iter([b])) for r in out.to_pylist()]
    assert rows == [brute(i, t) for i, t in enumerate(texts)]


def test_query_over_the_whole_table(spark, sf_dir):
    from varqa.llm.queries import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op12_fim"](spark, sf_dir).collect()
    assert len(got) == len(docs) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        assert (r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars) == brute(r.doc_id, docs[r.doc_id])[:5]
        assert r.output_sha256 == hashlib.sha256(brute(r.doc_id, docs[r.doc_id])[5].encode()).hexdigest()
