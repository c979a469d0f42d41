"""TIFF media columns: files in a binary column become one row per page, and back.

Reading walks the chain of image directories (both byte orders, a chain that loops ends there), gathers
strips or tiles, undoes none, PackBits, LZW or deflate coding and the horizontal predictor, and gives
the samples as bytes in row order. Writing makes single-page or multi-page files of 8-bit samples.

Defined cases: a null or empty file gives one row of page 0 with an error and null pixels, as does a file
that isn't TIFF or is damaged; a damaged directory gives its error in its own row and ends the walk; a
page that declares more samples than its strips or tiles can unpack to is an error, so a forged header can't
claim memory, and no page that can be read is refused for its size; a null or empty payload is stored as no
file (null); repeated rows give repeated pages; an empty table gives no rows.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

NONE, LZW, DEFLATE, PACKBITS = 1, 5, 8, 32773
#: Fixed values of the format: tag numbers and bytes by field type.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_AT, SAMPLES, STRIP_ROWS, STRIP_LEN, PLANAR, PREDICTOR, TILE_W, TILE_H, TILE_AT, TILE_LEN = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317, 322, 323, 324, 325
#: Most bytes that a byte of each coding unpacks to: a run of 128 from two, a code of nine bits for a string of the
#: table's 4,096 at most, and deflate's 258 from two bits.
UNPACKS = {NONE: 1, PACKBITS: 64, LZW: 4096, DEFLATE: 1040, 32946: 1040}
TYPE_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}


class TiffError(ValueError):
    pass


def packbits_encode(data: bytes) -> bytes:
    a = np.frombuffer(data, np.uint8)
    if not len(a):
        return b""
    starts = np.concatenate(([0], np.flatnonzero(a[1:] != a[:-1]) + 1))
    lengths = np.diff(np.concatenate((starts, [len(a)])))
    out, at = bytearray(), 0

    def literal(to: int) -> None:
        for i in range(at, to, 128):
            part = data[i : min(i + 128, to)]
            out.append(len(part) - 1)
            out.extend(part)

    for s, n in zip(starts[lengths >= 3].tolist(), lengths[lengths >= 3].tolist()):
        literal(s)
        at = s + n
        while n > 1:
            k = min(n, 128)
            out += bytes((257 - k, data[s]))
            n -= k
        if n:
            out += bytes((0, data[s]))
    literal(len(data))
    return bytes(out)


def packbits_decode(data: bytes) -> bytes:
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        k = data[i]
        if k < 128:
            if i + 2 + k > n:
                raise TiffError("PackBits literal beyond the end")
            out += data[i + 1 : i + 2 + k]
            i += k + 2
        elif k > 128:
            if i + 1 >= n:
                raise TiffError("PackBits run beyond the end")
            out += data[i + 1 : i + 2] * (257 - k)
            i += 2
        else:
            i += 1
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, high bit first; widths change one code early, as the format asks."""
    fresh = {bytes((i,)): i for i in range(256)}
    table, bits, acc, held, out = dict(fresh), 9, 256, 9, bytearray()
    w, code = b"", 258
    for i in range(len(data)):
        wc = w + data[i : i + 1]
        if wc in table:
            w = wc
            continue
        acc, held = (acc << bits) | table[w], held + bits
        table[wc] = code
        code += 1
        w = data[i : i + 1]
        if code == 4095:
            acc, held = (acc << bits) | 256, held + bits
            table, bits, code = dict(fresh), 9, 258
        elif code in (512, 1024, 2048):
            bits += 1
        if held > 256:
            keep = held & 7
            out += (acc >> keep).to_bytes(held >> 3, "big")
            acc, held = acc & ((1 << keep) - 1), keep
    if w:
        acc, held = (acc << bits) | table[w], held + bits
        code += 1
        if code in (512, 1024, 2048):
            bits += 1
    acc, held = (acc << bits) | 257, held + bits
    pad = -held % 8
    return bytes(out + (acc << pad).to_bytes((held + pad) >> 3, "big"))


def lzw_decode(data: bytes, most: int) -> bytes:
    base = [bytes((i,)) for i in range(256)] + [b"", b""]
    table, bits, out = list(base), 9, bytearray()
    acc = held = at = 0
    old = b""
    while True:
        while held < bits:
            if at >= len(data):
                return bytes(out)  # writers may leave the end code out
            acc, held, at = ((acc << 8) | data[at]) & 0xFFFFFF, held + 8, at + 1
        held -= bits
        code = (acc >> held) & ((1 << bits) - 1)
        if code == 257:
            return bytes(out)
        if code == 256:
            table, bits, old = list(base), 9, b""
            continue
        if code < len(table):
            s = table[code]
        elif code == len(table) and old:
            s = old + old[:1]
        else:
            raise TiffError("LZW code out of range")
        out += s
        if len(out) > most:
            raise TiffError("LZW data beyond the page")
        if old and len(table) < 4096:
            table.append(old + s[:1])
        old = s
        bits = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12


def _pack(kind: int, data: bytes) -> bytes:
    return {NONE: bytes, LZW: lzw_encode, DEFLATE: lambda d: zlib.compress(d, 1), PACKBITS: packbits_encode}[kind](data)


def _unpack(kind: int, data: bytes, most: int) -> bytes:
    if kind == NONE:
        return data
    if kind == PACKBITS:
        return packbits_decode(data)
    if kind == LZW:
        return lzw_decode(data, most)
    if kind in (DEFLATE, 32946):
        z = zlib.decompressobj()
        try:
            return z.decompress(data, max(most, 1))
        except zlib.error as e:
            raise TiffError(f"deflate: {e}") from None
    raise TiffError(f"compression {kind} is not supported")


def write_tiff(pages: list[np.ndarray], compression: int = DEFLATE, predictor: int = 1, tile: int = 0, strip_rows: int = 256) -> bytes:
    """A little-endian file; each page is an array (height, width) or (height, width, samples) of uint8."""
    out, link = bytearray(struct.pack("<2sHI", b"II", 42, 0)), 4
    for page in pages:
        a = page if page.ndim == 3 else page[:, :, None]
        h, w, spp = a.shape
        blocks = []
        if tile:
            full = np.zeros((-(-h // tile) * tile, -(-w // tile) * tile, spp), np.uint8)
            full[:h, :w] = a
            parts = [full[y : y + tile, x : x + tile] for y in range(0, full.shape[0], tile) for x in range(0, full.shape[1], tile)]
        else:
            parts = [a[y : y + strip_rows] for y in range(0, h, strip_rows)]
        for p in parts:
            if predictor == 2:
                p = np.concatenate((p[:, :1], p[:, 1:] - p[:, :-1]), axis=1)
            blocks.append(_pack(compression, p.tobytes()))
        at = []
        for b in blocks:
            at.append(len(out))
            out += b
        fields = {WIDTH: (4, [w]), HEIGHT: (4, [h]), BITS: (3, [8] * spp), COMPRESSION: (3, [compression]), PHOTOMETRIC: (3, [1 if spp < 3 else 2]), SAMPLES: (3, [spp]), PREDICTOR: (3, [predictor])}
        fields |= {TILE_W: (4, [tile]), TILE_H: (4, [tile]), TILE_AT: (4, at), TILE_LEN: (4, [len(b) for b in blocks])} if tile else {STRIP_AT: (4, at), STRIP_ROWS: (4, [strip_rows]), STRIP_LEN: (4, [len(b) for b in blocks])}
        entries = []
        for tag, (kind, values) in sorted(fields.items()):
            raw = struct.pack(f"<{len(values)}{'H' if kind == 3 else 'I'}", *values)
            if len(raw) > 4:
                out += b"\0" * (len(out) % 2)
                place, raw = len(out), raw
                out += raw
                raw = struct.pack("<I", place)
            entries.append(struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0"))
        out += b"\0" * (len(out) % 2)
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(entries)) + b"".join(entries)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def _fields(data: bytes, at: int, e: str) -> tuple[dict[int, list[int]], int]:
    def cut(a: int, n: int) -> bytes:
        if a < 0 or a + n > len(data):
            raise TiffError("a directory points beyond the file")
        return data[a : a + n]

    (n,) = struct.unpack(e + "H", cut(at, 2))
    found = {}
    for i in range(n):
        tag, kind, count = struct.unpack(e + "HHI", cut(at + 2 + 12 * i, 8))
        size = TYPE_BYTES.get(kind, 0) * count
        if kind not in (1, 3, 4) or not size:
            continue
        place = at + 10 + 12 * i if size <= 4 else struct.unpack(e + "I", cut(at + 10 + 12 * i, 4))[0]
        found[tag] = list(struct.unpack(f"{e}{count}{ {1: 'B', 3: 'H', 4: 'I'}[kind]}", cut(place, size)))
    return found, struct.unpack(e + "I", cut(at + 2 + 12 * n, 4))[0]


def _page(data: bytes, f: dict[int, list[int]], e: str) -> dict:
    get = lambda tag, default=None: f[tag][0] if f.get(tag) else default
    w, h, spp, kind, pred = get(WIDTH), get(HEIGHT), get(SAMPLES, 1), get(COMPRESSION, 1), get(PREDICTOR, 1)
    bits = f.get(BITS, [1])
    if not w or not h or not spp:
        raise TiffError("a page without width or height")
    if len(set(bits)) != 1 or bits[0] not in (8, 16):
        raise TiffError(f"samples of {bits[0]} bits are not supported")
    if pred not in (1, 2):
        raise TiffError(f"predictor {pred} is not supported")
    b = bits[0] // 8
    planar = get(PLANAR, 1) == 2 and spp > 1
    s = 1 if planar else spp
    tiled = TILE_W in f
    tw, th = (get(TILE_W), get(TILE_H)) if tiled else (w, min(h, get(STRIP_ROWS, h)))
    at, size = (f.get(TILE_AT), f.get(TILE_LEN)) if tiled else (f.get(STRIP_AT), f.get(STRIP_LEN))
    if not at or not size or not tw or not th:
        raise TiffError("a page without strips or tiles")
    across, down = -(-w // tw), -(-h // th)
    if len(at) < across * down * (spp if planar else 1) or len(size) < len(at):
        raise TiffError("too few strips or tiles")
    if kind not in UNPACKS:
        raise TiffError(f"compression {kind} is not supported")
    held = [min(n, max(len(data) - a, 0)) * UNPACKS[kind] for a, n in zip(at, size)]
    if w * h * spp * b > sum(held) or tw * min(th, h if not tiled else th) * s * b > max(held) and (tiled or down == 1):
        raise TiffError("a page larger than its strips or tiles unpack to")
    kind_of = np.dtype("u1" if b == 1 else e + "u2")
    img = np.zeros((h, w, spp), kind_of)
    for k in range(across * down * (spp if planar else 1)):
        plane, i = divmod(k, across * down)
        y, x = i // across * th, i % across * tw
        rows = th if tiled else min(th, h - y)
        need = rows * tw * s * b
        raw = _unpack(kind, data[at[k] : at[k] + size[k]], need) if need <= held[k] else b""
        if len(raw) < need:
            raise TiffError("a strip or tile is too short")
        block = np.frombuffer(raw, kind_of, rows * tw * s).reshape(rows, tw, s)
        if pred == 2:
            block = np.cumsum(block, axis=1, dtype=kind_of.newbyteorder("="))
        part = block[: h - y, : w - x]
        img[y : y + part.shape[0], x : x + part.shape[1], plane : plane + s] = part
    return {"width": w, "height": h, "samples": spp, "bits": bits[0], "compression": kind, "predictor": pred, "tiled": tiled, "pixels": img.tobytes()}


def read_tiff(data: bytes | None) -> Iterator[dict]:
    """The pages in order; the last may be {"error": ...}."""
    seen: set[int] = set()
    try:
        if not data or len(data) < 8 or data[:2] not in (b"II", b"MM"):
            raise TiffError("not a TIFF file")
        e = "<" if data[:2] == b"II" else ">"
        magic, at = struct.unpack(e + "HI", data[2:8])
        if magic != 42:
            raise TiffError("not a TIFF file")
        while at and at not in seen:
            seen.add(at)
            f, after = _fields(data, at, e)
            yield _page(data, f, e)
            at = after
        if not seen:
            raise TiffError("a file without pages")
    except (TiffError, struct.error) as x:
        yield {"error": str(x)}


def feature(p: dict) -> str:
    """Dimensions, mean, spread and entropy of a page's samples, and the mean of four quarters of its rows."""
    a = np.frombuffer(p["pixels"], np.uint8)
    share = np.bincount(a, minlength=256) / max(len(a), 1)
    mean = float(share @ np.arange(256))
    var = float(share @ (np.arange(256) - mean) ** 2)
    bits = -sum(x * math.log2(x) for x in share[share > 0].tolist())
    quarters = ",".join(f"{q.mean():.3f}" if len(q) else "-" for q in np.array_split(a, 4))
    return f"{p['width']}x{p['height']}x{p['samples']};mean={mean:.4f};sd={math.sqrt(max(var, 0)):.4f};bits={bits:.4f};quarters={quarters}"


PAGE = "page int, width int, height int, samples int, bits int, compression int, predictor int, tiled boolean, pixels binary, feature string, error string"


def read_pages(files: DataFrame, content: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per page: the columns in keep, then PAGE's."""
    clash = set(keep) & {x.split()[0] for x in PAGE.split(", ")}
    if clash:
        raise ValueError(f"rename {sorted(clash)}: the pages have columns of these names")
    schema = T.StructType([files.schema[k] for k in keep] + T.StructType.fromDDL(PAGE).fields)
    names = [f.name for f in schema.fields][len(keep) :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = None
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows, took = [], []
                for i, v in enumerate(part.column(len(keep))):
                    for n, p in enumerate(read_tiff(v.as_py())):
                        rows.append(p | {"page": n, "feature": feature(p) if "pixels" in p else None})
                        took.append(i)
                kept = [part.column(k).take(pa.array(took, pa.int64())) for k in range(len(keep))]
                kinds = shape or [pa.int32()] * 7 + [pa.bool_(), pa.binary(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(kept + [pa.array([r.get(c) for r in rows], t) for c, t in zip(names, kinds)], names=[*keep, *names])

    return files.select(*keep, content).mapInArrow(run, schema)


def store_bytes(rows: DataFrame, payload: str, keep: tuple[str, ...], media: str = "media", width: int = 64) -> DataFrame:
    """keep and media: each payload as a single-page file, `width` samples wide or 1 where its length is no multiple.

    The coding follows from the payload's checksum, so equal payloads give equal files, and payloads of all
    sizes meet every coding: LZW for one of 32, PackBits for two, deflate for the others, in strips or tiles,
    with or without the predictor.
    """
    if media in keep:
        raise ValueError(f"rename {media}: the files have a column of this name")
    schema = T.StructType([rows.schema[k] for k in keep] + [T.StructField(media, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                made = []
                for v in part.column(len(keep)):
                    data = v.as_py()
                    if not data:
                        made.append(None)
                        continue
                    mark = zlib.crc32(data)
                    page = np.frombuffer(data, np.uint8).reshape(-1, 1 if len(data) % width else width)
                    kind = {0: LZW, 1: PACKBITS, 2: PACKBITS}.get(mark >> 5 & 31, DEFLATE)
                    made.append(write_tiff([page], kind, 2 if mark & 6 == 6 else 1, tile=page.shape[1] if mark & 24 == 24 else 0))
                yield pa.RecordBatch.from_arrays([part.column(k) for k in range(len(keep))] + [pa.array(made, pa.binary())], names=[*keep, media])

    return rows.select(*keep, payload).mapInArrow(run, schema)
