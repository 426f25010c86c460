import random
import zlib

import numpy as np
import public_tokenizers
from py4j.java_gateway import get_field
from tokenizers import Tokenizer

from varqa.llm.tokens import Encoder, lookup, read_tokens, token_table, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def brute(rows):
    t, out, start = Tokenizer.from_file(PATH), [], 0
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_pieces_encode_as_the_library_does():
    e, t = Encoder(PATH), Tokenizer.from_file(PATH)
    for text in ("", " ", "a  b", "a \n b", "x\ny z\n", " lead", "trail ", "it's we'll 12 3.4 ÉTÉ ß 😀 日本 a b  c", "un***\tdos <|endoftext|> tres", "a b", "\x1c \x85", "it's. don't!! (isn't). ab***, é... x\" y]} 12. a1.", "a. a, a.b. b'. 's. ''. .a."):
        want = t.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(e.encode(text), "<u4").tolist() == want, text


def test_files_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(tuple(r) for r in token_table(docs.repartition(7), PATH).collect())
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_lookup_reads_back_the_ids_and_prunes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = write_tokens(docs, PATH)
    (row,) = lookup(spark, path, [17]).collect()
    text = docs.where("doc_id = 17").first().text
    assert row.ids == [*Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids, 2] and row.n_tokens == len(row.ids)
    assert "doc_id" in lookup(spark, path, [17])._jdf.queryExecution().toString().split("PushedFilters")[1][:80]
    assert read_tokens(spark, path).count() == docs.count()


def test_nulls_ties_and_other_columns(spark):
    rows = [(3, "a b", 1), (3, "a b", 2), (1, None, 3), (2, "", 4), (None, "x", 5), (9, "long text " * 30000, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int")
    got = token_table(docs, PATH).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == brute([r[:2] for r in rows])
    assert token_table(docs.limit(0), PATH).count() == 0


def test_the_stripes_hold_run_lengths_indexes_and_bloom_filters(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    first = 1 << 33
    path = write_tokens(docs.withColumn("doc_id", 3 * docs.doc_id + first), PATH, stripe_bytes=1 << 20)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = [f.getPath() for f in folder.getFileSystem(conf).listStatus(folder) if f.getPath().getName().endswith(".orc")]
    orc = getattr(jvm.org.apache.orc, "OrcFile")
    readers = [orc.createReader(f, orc.readerOptions(conf)) for f in files]
    assert sum(r.getNumberOfRows() for r in readers) == 10_000
    reader = max(readers, key=lambda r: r.getStripes().size())
    assert reader.getStripes().size() >= 2 and reader.getRowIndexStride() == 1000
    rows = reader.rows()
    column = reader.getSchema().findSubtype("doc_id").getId()
    wanted = spark.sparkContext._gateway.new_array(jvm.boolean, reader.getSchema().getMaximumId() + 1)
    wanted[column] = True
    index = rows.readRowIndex(0, wanted, wanted)
    assert index.getRowGroupIndex()[column].getEntryCount() >= 1
    assert index.getBloomFilterIndex()[column].getBloomFilterCount() == index.getRowGroupIndex()[column].getEntryCount()
    footer = rows.readStripeFooter(reader.getStripes().get(0))
    kinds = {str(footer.getColumns(i).getKind()) for i in range(1, footer.getColumnsCount())}
    assert kinds <= {"DIRECT_V2", "DICTIONARY_V2", "DIRECT"} and "DIRECT_V2" in kinds  # integer run lengths, version 2

    def read(doc_id):  # rows that the reader doesn't skip for this doc_id
        kind = jvm.java.lang.Class.forName("org.apache.hadoop.hive.ql.io.sarg.PredicateLeaf$Type").getField("LONG").get(None)
        builder = jvm.org.apache.hadoop.hive.ql.io.sarg.SearchArgumentFactory.newBuilder()
        wanted = builder.equals("doc_id", kind, first + doc_id).build()
        n = 0
        for r in readers:
            found = r.rows(r.options().searchArgument(wanted, spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)).allowSARGToFilter(False))
            batch = r.getSchema().createRowBatch()
            while found.nextBatch(batch):
                n += get_field(batch, "size")
        return n

    assert 0 < read(3 * 4321) <= 1100  # one row group of ten
    assert read(3 * 4321 + 1) == 0  # between two ids: only the Bloom filter can tell
    assert read(10**9) == 0


def test_a_tokenizer_that_does_not_split_by_bytes_encodes_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    e, t = Encoder(path), Tokenizer.from_file(path)
    assert not e.cuts and Encoder(PATH).cuts
    for text in ("", "Some Words, here. And  more\n\nwords's", "été <|endoftext|> x"):
        assert np.frombuffer(e.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_random_texts_encode_as_the_library_does():
    rng, e, t = random.Random(1), Encoder(PATH), Tokenizer.from_file(PATH)
    parts = [*"aBz03' \n\t.,-(é日\u00a0\u3000\u2003\x85\x1c\u0107ñ×÷stl'«»я", "<|endoftext|>", "'s", " ", " ", " word"]
    for _ in range(3000):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3)]
        raw = [x.encode() for x in texts]
        ids, at = e.encode_block(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        assert [ids[s:x].tolist() for s, x in zip(at, at[1:])] == [t.encode(x, add_special_tokens=False).ids for x in texts], texts


def test_known_pieces_are_forgotten_within_their_bound(monkeypatch):
    monkeypatch.setattr("varqa.llm.tokens._CACHE", 20_000)
    e, t = Encoder(PATH), Tokenizer.from_file(PATH)
    for i in range(40):
        text = " ".join(f"w{i}x{j} the same" for j in range(60))
        assert np.frombuffer(e.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
        assert e.size <= 20_000 + 60 * 400 and sum(len(x) for x in e.known) <= e.size
