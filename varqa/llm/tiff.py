"""TIFF as a media column: files written and read with PackBits, LZW or deflate, strips or tiles, and predictors.

Reading walks the chain of image directories and gives one row for each page.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the format: tags and compression codes.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC = 256, 257, 258, 259, 262
STRIP_AT, SAMPLES, ROWS, STRIP_BYTES, PLANAR, PREDICTOR = 273, 277, 278, 279, 284, 317
TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_BYTES = 322, 323, 324, 325
NONE, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
#: Bytes of a value by field type.
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8}

PAGE = 1 << 20
#: Bytes of samples that a page may have; a directory that claims more is an error.
MOST = 1 << 28
_BROKEN = (ValueError, KeyError, IndexError, TypeError, OverflowError, MemoryError, struct.error, zlib.error)


def packbits(data: bytes) -> bytes:
    """Runs of three or more equal bytes as repeats, all else as literals, 128 at most."""
    x = np.frombuffer(data, np.uint8)
    out, n = bytearray(), len(x)
    if not n:
        return b""
    cut = np.r_[0, np.flatnonzero(x[1:] != x[:-1]) + 1, n]
    size = np.diff(cut)
    at = 0
    for k in np.flatnonzero(size >= 3).tolist():
        _literals(out, data, at, int(cut[k]))
        left, byte = int(size[k]), data[cut[k]]
        while left:
            m = min(left, 128)
            out += bytes((257 - m if m > 1 else 0, byte))
            left -= m
        at = int(cut[k + 1])
    _literals(out, data, at, n)
    return bytes(out)


def _literals(out: bytearray, data: bytes, lo: int, hi: int) -> None:
    for s in range(lo, hi, 128):
        e = min(s + 128, hi)
        out.append(e - s - 1)
        out += data[s:e]


def unpackbits(data: bytes, size: int) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n and len(out) < size:
        c = data[i]
        if c < 128:
            out += data[i + 1 : i + 2 + c]
            i += 2 + c
        elif c > 128:
            out += data[i + 1 : i + 2] * (257 - c)
            i += 2
        else:
            i += 1
    return bytes(out[:size])


def lzw(data: bytes) -> bytes:
    """Variable-width codes of 9 to 12 bits, most significant bit first; the width grows one code early."""
    first = {bytes((i,)): i for i in range(256)}
    table, nxt, width = dict(first), 258, 9
    codes, widths, prefix = [256], [9], b""
    for i in range(len(data)):
        longer = prefix + data[i : i + 1]
        if longer in table:
            prefix = longer
            continue
        codes.append(table[prefix])
        widths.append(width)
        table[longer] = nxt
        nxt += 1
        prefix = data[i : i + 1]
        if nxt == 4094:
            codes.append(256)
            widths.append(12)
            table, nxt, width = dict(first), 258, 9
        elif nxt + 1 > 1 << width:
            width += 1
    if prefix:
        codes.append(table[prefix])
        widths.append(width)
        if nxt + 2 > 1 << width and width < 12:
            width += 1
    codes.append(257)
    widths.append(width)
    c, w = np.array(codes, np.int64), np.array(widths, np.int64)
    bits = np.arange(11, -1, -1)
    use = bits[None, :] < w[:, None]
    return np.packbits(((c[:, None] >> bits[None, :]) & 1).astype(np.uint8)[use]).tobytes()


def unlzw(data: bytes, size: int) -> bytes:
    singles = [bytes((i,)) for i in range(256)] + [b"", b""]
    table, width, old, out, held, bits, got = list(singles), 9, None, [], 0, 0, 0
    for byte in data:
        held = (held << 8 | byte) & 0xFFFFFF
        bits += 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & ((1 << width) - 1)
        if code == 256:
            table, width, old = list(singles), 9, None
            continue
        if code == 257:
            break
        if old is None:
            entry = table[code]
        else:
            entry = table[code] if code < len(table) else old + old[:1]
            table.append(old + entry[:1])
            n = len(table)
            if n >= 511 and width < 12:
                width = 9 if n < 511 else 10 if n < 1023 else 11 if n < 2047 else 12
        out.append(entry)
        old = entry
        got += len(entry)
        if got >= size:
            break
    return b"".join(out)[:size]


def _compress(raw: bytes, codec: int) -> bytes:
    match codec:
        case 32773:
            return packbits(raw)
        case 5:
            return lzw(raw)
        case 8:
            return zlib.compress(raw, 1)
    return raw


def _expand(raw: bytes, codec: int, size: int) -> bytes:
    match codec:
        case 1:
            return raw[:size]
        case 5:
            return unlzw(raw, size)
        case 8 | 32946:
            return zlib.decompressobj().decompress(raw, size)
        case 32773:
            return unpackbits(raw, size)
    raise ValueError(f"compression {codec} is not supported")


def encode_tiff(pages: list[np.ndarray], codec: int = DEFLATE, predictor: int = 1, tile: int = 0, strip_rows: int = 1024) -> bytes:
    """A little-endian TIFF of 8-bit grey pages (height, width), in strips, or in tiles of tile x tile if given."""
    out, link = bytearray(b"II*\0\0\0\0\0"), 4
    for page in pages:
        h, w = page.shape
        if tile:
            blocks = [np.pad(page[y : y + tile, x : x + tile], ((0, max(0, y + tile - h)), (0, max(0, x + tile - w)))) for y in range(0, h, tile) for x in range(0, w, tile)]
        else:
            blocks = [page[y : y + strip_rows] for y in range(0, h, strip_rows)]
        at, size = [], []
        for b in blocks:
            if predictor == 2:
                b = np.concatenate([b[:, :1], np.diff(b, axis=1)], 1)  # wraps at 256
            data = _compress(b.tobytes(), codec)
            at.append(len(out))
            size.append(len(data))
            out += data + b"\0" * (len(data) % 2)
        layout = [(TILE_WIDTH, 4, [tile]), (TILE_HEIGHT, 4, [tile]), (TILE_AT, 4, at), (TILE_BYTES, 4, size)] if tile else [(STRIP_AT, 4, at), (ROWS, 4, [strip_rows]), (STRIP_BYTES, 4, size)]
        fields = sorted([(WIDTH, 4, [w]), (HEIGHT, 4, [h]), (BITS, 3, [8]), (COMPRESSION, 3, [codec]), (PHOTOMETRIC, 3, [1]), (SAMPLES, 3, [1]), (PLANAR, 3, [1]), (PREDICTOR, 3, [predictor]), *layout])
        entries = b""
        for tag, kind, values in fields:
            data = struct.pack(f"<{len(values)}{'H' if kind == 3 else 'I'}", *values)
            if len(data) > 4:
                where = len(out)
                out += data
                data = struct.pack("<I", where)
            entries += struct.pack("<HHI", tag, kind, len(values)) + data.ljust(4, b"\0")
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(fields)) + entries
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def read_pages(data: bytes):
    """(tags, samples) of each page: samples are (height, width, samples per pixel), predictors undone."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    at, seen = struct.unpack_from(order + "I", data, 4)[0], set()
    while at:
        if at in seen or at + 2 > len(data):
            raise ValueError("the image directories are broken")
        seen.add(at)
        n = struct.unpack_from(order + "H", data, at)[0]
        tags = {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
            size, where = SIZES.get(kind, 1) * count, at + 10 + 12 * i
            if size > 4:
                where = struct.unpack_from(order + "I", data, where)[0]
            if kind in (1, 3, 4):
                tags[tag] = struct.unpack_from(f"{order}{count}{ {1: 'B', 3: 'H', 4: 'I'}[kind]}", data, where)
        yield tags, _samples(data, tags, order)
        at = struct.unpack_from(order + "I", data, at + 2 + 12 * n)[0]


def _samples(data: bytes, tags: dict, order: str) -> np.ndarray:
    one = lambda tag, default=None: tags.get(tag, (default,))[0]
    w, h, depth, codec = one(WIDTH), one(HEIGHT), one(SAMPLES, 1), one(COMPRESSION, 1)
    bits = one(BITS, 8)
    if not w or not h or not depth:
        raise ValueError("a page without width, height or samples")
    if w * h * depth > MOST:
        raise ValueError(f"a page of {w} x {h} x {depth} samples")
    if bits not in (8, 16) or one(PLANAR, 1) != 1:
        raise ValueError(f"{bits} bits or separate planes are not supported")
    kind = np.dtype("u1" if bits == 8 else order + "u2")
    out = np.zeros((h, w, depth), kind.newbyteorder("="))
    if TILE_AT in tags:
        bw, bh, starts, sizes = one(TILE_WIDTH, 0), one(TILE_HEIGHT, 0), tags[TILE_AT], tags[TILE_BYTES]
    else:
        bw, bh, starts, sizes = w, min(one(ROWS, h), h), tags[STRIP_AT], tags[STRIP_BYTES]
    if bw < 1 or bh < 1 or bw * bh * depth > MOST:
        raise ValueError(f"blocks of {bw} x {bh}")
    across = -(-w // bw)
    for i, (s, n) in enumerate(zip(starts, sizes)):
        y, x = i // across * bh, i % across * bw
        rows = bh if TILE_AT in tags else min(bh, h - y)
        raw = _expand(data[s : s + n], codec, rows * bw * depth * kind.itemsize)
        block = np.frombuffer(raw, kind).astype(out.dtype).reshape(rows, bw, depth)
        if one(PREDICTOR, 1) == 2:
            block = np.cumsum(block, axis=1, dtype=out.dtype)
        out[y : y + bh, x : x + bw] = block[: h - y, : w - x]
    return out


def page_feature(samples: np.ndarray) -> str:
    """Mean, deviation and a 64-bit average hash over an 8 x 8 grid."""
    h, w = samples.shape[:2]
    if not h or not w:
        return "0.00:0.00:0000000000000000"
    flat = samples.reshape(h, -1)
    ys, xs = np.linspace(0, h, 9).astype(int), np.linspace(0, flat.shape[1], 9).astype(int)
    sums = np.zeros((8, 8))
    for j in range(8):
        band = flat[ys[j] : max(ys[j + 1], ys[j] + 1)].mean(0)
        sums[j] = [band[a : max(b, a + 1)].mean() for a, b in zip(xs[:-1], xs[1:])]
    bits = int("".join("1" if v > sums.mean() else "0" for v in sums.ravel()), 2)
    return f"{flat.mean():.2f}:{flat.std():.2f}:{bits:016x}"


def text_to_tiff(text: str) -> tuple[int, bytes]:
    """(UTF-8 bytes, TIFF file): the bytes, padded with 0 to a positive multiple of 64, as 64-sample rows of pages.

    The layout follows from the payload alone: deflate with or without predictor, LZW in strips, or PackBits in tiles.
    """
    raw = text.encode()
    payload = np.frombuffer(raw + b"\0" * ((-len(raw)) % 64 or (0 if raw else 64)), np.uint8).reshape(-1, 64)
    pages = [payload[i : i + PAGE // 64] for i in range(0, len(payload), PAGE // 64)]
    kind = zlib.crc32(raw) % 4
    codec, predictor, tile = ((DEFLATE, 1, 0), (DEFLATE, 2, 64), (LZW, 1, 0), (PACKBITS, 1, 64))[kind]
    return len(raw), encode_tiff(pages, codec, predictor, tile, 4096)


def texts_to_media(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, media (a TIFF file) of every whole text; a null text is empty. Other columns are ignored."""

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                made = [text_to_tiff(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in made], pa.int64()), pa.array([m for _, m in made], pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


_PAGES = "doc_id long, n_bytes long, media_bytes long, media_sha256 string, page long, width long, height long, codec long, samples binary, feature string, error string"
_PAGE_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string()]
_PAGE_NAMES = [x.split()[0] for x in _PAGES.split(", ")]


def tiff_pages(media: DataFrame) -> DataFrame:
    """One row for each page of the media, a file's pages in order and one after the other: doc_id, n_bytes (if media has
    it), media_bytes, media_sha256, page, width, height, codec, samples (binary), feature, error.

    A null, empty or broken file, or one whose pages claim more than MOST bytes, gives one row with its error and page
    null, and no other. Other columns are ignored; an empty table gives no rows.
    """

    def run(batches):
        rows, held = [], 0
        for b in batches:
            for doc, n, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                data = data.as_py() or b""
                file, mine = (doc, n, len(data), hashlib.sha256(data).hexdigest()), []
                try:
                    for i, (tags, x) in enumerate(read_pages(data)):
                        mine.append((*file, i, x.shape[1], x.shape[0], tags.get(COMPRESSION, (1,))[0], x.tobytes(), page_feature(x), None))
                except _BROKEN as e:
                    mine = []
                    why = str(e) or type(e).__name__
                else:
                    why = "no page"
                rows += mine or [(*file, None, None, None, None, None, None, why)]
                held += sum(len(r[8]) for r in mine)
                if held > 4 * PAGE or len(rows) > 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _PAGE_KINDS)], _PAGE_NAMES)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _PAGE_KINDS)], _PAGE_NAMES)

    n = F.col("n_bytes").cast("long") if "n_bytes" in media.columns else F.lit(None).cast("long")
    return media.select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("n_bytes"), "media").mapInArrow(run, _PAGES)


def media_digests(media: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, pages, error of stored files.

    Read from tiff_pages, whose rows of one file follow one another: the payload is all samples in order, the feature is
    that of the pages, joined by a comma. A null or broken file has nulls for what can't be read, and its error.
    """
    names = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pages", "error"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def run(batches):
        file = None  # doc_id, n_bytes, media_bytes, media_sha256, digest, size, last samples, features: of the file being read

        def done():
            doc, n, size, sha, digest, read, tail, said = file
            return doc, n, read, digest.hexdigest(), zlib.crc32(tail), size, sha, ",".join(said), len(said), None

        for b in batches:
            out = []
            c = dict(zip(_PAGE_NAMES, b.columns))
            small = zip(*(c[k].to_pylist() for k in ("doc_id", "n_bytes", "media_bytes", "media_sha256", "page", "feature", "error")))
            for (doc, n, size, sha, page, feature, error), data in zip(small, c["samples"]):
                if not page and file is not None:
                    out.append(done())
                    file = None
                if page is None:
                    out.append((doc, n, None, None, None, size, sha, None, 0, error))
                    continue
                if page == 0:
                    file = (doc, n, size, sha, hashlib.sha256(), 0, b"", [])
                data = data.as_py()
                file[4].update(data)
                file[7].append(feature)
                file = (*file[:5], file[5] + len(data), (file[6] + data[-64:])[-64:], file[7])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names)
        if file is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(done(), kinds)], names)

    return tiff_pages(media).mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, pages long, error string")
