import hashlib
import random
import zlib

import numpy as np
import pytest

from varqa.llm.tiff import DEFLATE, LZW, NONE, PACKBITS, encode_tiff, lzw, media_digests, packbits, read_pages, text_to_tiff, texts_to_media, tiff_pages, unlzw, unpackbits


def samples():
    rng = random.Random(8)
    yield from (b"", b"a", b"aa", b"aaa" * 200, bytes(range(256)) * 3, b"TOBEORNOTTOBEORTOBEORNOT" * 9)
    for n in (1, 500, 511, 512, 5000, 70000):
        yield bytes(rng.choice(b"abcde ") for _ in range(n))
        yield rng.randbytes(n)


def test_codecs_round_trip():
    for data in samples():
        assert unpackbits(packbits(data), len(data)) == data
        assert unlzw(lzw(data), len(data)) == data


def test_lzw_known_stream():
    assert lzw(bytes([7, 7, 7, 8, 8, 7, 7, 6, 6])) == np.packbits([int(b) for c in (256, 7, 258, 8, 8, 258, 6, 6, 257) for b in f"{c:09b}"]).tobytes()


@pytest.mark.parametrize("codec", [NONE, LZW, DEFLATE, PACKBITS])
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [0, 16])
def test_pages_round_trip(codec, predictor, tile):
    rng = np.random.default_rng(1)
    pages = [rng.integers(0, 256, s, dtype=np.uint8) for s in ((1, 1), (33, 17), (100, 64), (5, 200))]
    back = [s[:, :, 0] for _, s in read_pages(encode_tiff(pages, codec, predictor, tile, 7))]
    assert len(back) == 4 and all((a == b).all() for a, b in zip(pages, back))


def test_query_columns_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = media_digests(texts_to_media(docs)).collect()
    assert len(rows) == len(text)
    for r in rows:
        raw = text[r.doc_id].encode()
        padded = raw + b"\0" * (-len(raw) % 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-64:]))
        assert r.media_sha256 == hashlib.sha256(text_to_tiff(text[r.doc_id])[1]).hexdigest()


def test_nulls_long_texts_and_broken_files(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "é" * 600_000, 1), (3, "x", 1), (None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, media int")
    media = texts_to_media(docs)
    got = media_digests(media).collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.payload_bytes, r.pages) for r in got) == [(0, 1, 64, 1), (1, 0, 64, 1), (2, 0, 64, 1), (3, 1, 64, 1), (3, 1200000, 1200000, 2)]
    pages = tiff_pages(media).where("doc_id = 3").collect()
    assert len(pages) == 3 and sum(len(p.samples) for p in pages) == 1_200_064
    bad = spark.createDataFrame([(1, None), (2, bytearray(b"II*\0\xff\0\0\0")), (3, bytearray(b"GIF"))], "doc_id long, media binary")
    assert {(r.doc_id, r.page, r.error is None) for r in tiff_pages(bad).collect()} == {(1, None, False), (2, None, False), (3, None, False)}
    assert media_digests(texts_to_media(docs.limit(0))).count() == 0


def test_hostile_files_are_error_rows(spark):
    import struct

    def file(*tags):
        return b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, 4, 1, v) for t, v in tags) + b"\0\0\0\0"

    strips = ((273, 8), (279, 4))
    bad = {
        1: file((257, 5), *strips),  # no width
        2: file((256, 2**31), (257, 2**31), *strips),  # huge
        3: file((256, 4), (257, 4)),  # no strips
        4: file((256, 4), (257, 4), (322, 0), (323, 0), (324, 8), (325, 4)),  # tiles of nothing
        5: file((256, 4), (257, 4), (322, 2**30), (323, 2**30), (324, 8), (325, 4)),
        6: file((256, 4), (257, 4), (259, 5), (273, 0), (279, 3)),  # too few codes
        7: b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", 1) + struct.pack("<HHII", 256, 4, 2**31, 8),
        8: text_to_tiff("fine")[1][:-9],
    }
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in bad.items()] + [(9, bytearray(text_to_tiff("fine")[1])), (9, None)], "doc_id long, media binary")
    got = tiff_pages(df).collect()
    assert {(r.doc_id, r.page) for r in got} == {(k, None) for k in bad} | {(9, 0), (9, None)} and all((r.error is None) == (r.page == 0) for r in got)
    digests = media_digests(df).collect()
    assert len(digests) == 10 and sum(r.error is None for r in digests) == 1 and all((r.payload_sha256 is None) == (r.error is not None) for r in digests)


def test_digests_are_those_of_the_page_rows(spark):
    docs = spark.createDataFrame([(i % 3, "x" * (i * 700_000)) for i in range(5)], "doc_id long, text string").coalesce(1)
    media = texts_to_media(docs)
    pages = tiff_pages(media).collect()
    assert [(r.doc_id, r.page) for r in pages] == [(0, 0), (1, 0), (2, 0), (2, 1), (0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2)]
    got = media_digests(media).collect()
    assert [r.pages for r in got] == [1, 1, 2, 3, 3] and [r.payload_bytes for r in got] == [64] + [-(-i * 700_000 // 64) * 64 for i in range(1, 5)]
