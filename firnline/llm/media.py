"""Media columns: Netpbm (PGM, PPM) and BMP images decoded to numpy arrays, area-resized by integral images,
kept as NPY tiles and described by difference hashes.

The query stores every document's UTF-8 bytes losslessly as the samples of an 8-bit PGM image, decodes that
file again and derives digest and features from the decoded samples.

Defined cases: a null text is an empty one; an empty text is one row of 192 blanks; texts of any length are
one image each (height grows, width stays); repeated rows give equal rows; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from firnline.llm.common import bounded, load

WIDTH = 192
TILE = 16  # side of the NPY tile
HASH_W, HASH_H = 9, 8


def encode_pgm(samples: np.ndarray) -> bytes:
    """samples: (height, width) uint8."""
    h, w = samples.shape
    return b"P5\n%d %d\n255\n" % (w, h) + samples.tobytes()


def encode_ppm(samples: np.ndarray) -> bytes:
    """samples: (height, width, 3) uint8."""
    h, w, _ = samples.shape
    return b"P6\n%d %d\n255\n" % (w, h) + samples.tobytes()


def encode_bmp(samples: np.ndarray) -> bytes:
    """Grey (height, width) or RGB (height, width, 3) uint8 as an uncompressed BMP, bottom row first."""
    h, w = samples.shape[:2]
    grey = samples.ndim == 2
    row = w * (1 if grey else 3)
    pad = -row % 4
    body = samples if grey else samples[:, :, ::-1]
    body = np.pad(body.reshape(h, row)[::-1], ((0, 0), (0, pad))).tobytes()
    palette = b"".join(bytes((i, i, i, 0)) for i in range(256)) if grey else b""
    start = 54 + len(palette)
    head = struct.pack("<2sIHHI", b"BM", start + len(body), 0, 0, start)
    info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 8 if grey else 24, 0, len(body), 2835, 2835, len(palette) // 4, 0)
    return head + info + palette + body


def _netpbm_numbers(data: bytes, at: int, count: int) -> tuple[list[int], int]:
    out = []
    while len(out) < count:
        while data[at : at + 1].isspace() or data[at : at + 1] == b"#":
            if data[at : at + 1] == b"#":
                at = data.index(b"\n", at)
            at += 1
        end = at
        while data[end : end + 1].isdigit():
            end += 1
        if end == at:
            raise ValueError("Netpbm header: a number is missing")
        out.append(int(data[at:end]))
        at = end
    return out, at


def decode(data: bytes) -> np.ndarray:
    """P2, P3, P5, P6 (8 or 16 bits) or BMP (8-bit palette, 24 or 32 bits, either row order) to an array of
    (height, width) for grey or (height, width, 3) for RGB."""
    kind = data[:2]
    if kind in (b"P2", b"P3", b"P5", b"P6"):
        (w, h, top), at = _netpbm_numbers(data, 2, 3)
        planes = 3 if kind in (b"P3", b"P6") else 1
        n = w * h * planes
        if kind in (b"P5", b"P6"):
            flat = np.frombuffer(data, np.uint8 if top < 256 else ">u2", n, at + 1)
        else:
            flat = np.array(_netpbm_numbers(data, at, n)[0], np.uint8 if top < 256 else np.uint16)
        return flat.reshape((h, w, 3) if planes == 3 else (h, w))
    if kind == b"BM":
        (start,) = struct.unpack_from("<I", data, 10)
        size, w, h, _, bits, packing = struct.unpack_from("<IiiHHI", data, 14)
        if packing or bits not in (8, 24, 32):
            raise ValueError(f"BMP with {bits} bits and compression {packing}")
        planes = bits // 8
        stride = -(-w * planes // 4) * 4
        rows = np.frombuffer(data, np.uint8, stride * abs(h), start).reshape(abs(h), stride)[:, : w * planes]
        rows = rows[::-1] if h > 0 else rows
        if bits == 8:
            (used,) = struct.unpack_from("<I", data, 46)
            palette = np.frombuffer(data, np.uint8, 4 * (used or 256), 14 + size).reshape(-1, 4)[:, 2::-1]
            rgb = palette[rows]
            grey = (palette[:, 0] == palette[:, 1]).all() and (palette[:, 1] == palette[:, 2]).all()
            return rgb[:, :, 0] if grey else rgb
        return rows.reshape(abs(h), w, planes)[:, :, 2::-1]
    raise ValueError("neither Netpbm nor BMP")


def _edge_sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Integral along axis 0 up to each (fractional) cut."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    whole = np.minimum(cuts.astype(np.int64), len(values))
    part = cuts - whole
    more = np.concatenate([values, np.zeros((1, *values.shape[1:]))])[whole]
    return total[whole] + more * part.reshape(-1, *[1] * (values.ndim - 1))


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over each target cell's exact area, by integral images: first along the rows, then the columns."""
    h, w = image.shape[:2]
    rows = np.diff(_edge_sums(image, np.arange(height + 1) * (h / height)), axis=0)
    cols = np.diff(_edge_sums(np.swapaxes(rows, 0, 1), np.arange(width + 1) * (w / width)), axis=0)
    return np.swapaxes(cols, 0, 1) / ((h / height) * (w / width))


def difference_hash(image: np.ndarray) -> str:
    """64 bits as hex: whether each cell of a 9 x 8 area reduction is darker than its right neighbour."""
    small = np.round(area_resize(image, HASH_H, HASH_W), 6)
    return np.packbits(small[:, :-1] < small[:, 1:]).tobytes().hex()


def npy_tile(image: np.ndarray, side: int = TILE) -> bytes:
    out = io.BytesIO()
    np.save(out, np.floor(area_resize(image, side, side) + 0.5).astype(np.uint8), allow_pickle=False)
    return out.getvalue()


def text_to_media(raw: bytes) -> bytes:
    """The bytes, padded with blanks to a positive multiple of WIDTH, as the samples of a PGM file."""
    size = max(1, -(-len(raw) // WIDTH)) * WIDTH
    return encode_pgm(np.frombuffer(raw.ljust(size, b" "), np.uint8).reshape(-1, WIDTH))


_OUT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()),
    ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()),
    ("media", pa.binary()), ("tile", pa.binary()),
])
DDL = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, "
    "media_sha256 string, feature string, media binary, tile binary"
)


def _row(doc_id, raw: bytes) -> tuple:
    media = text_to_media(raw)
    image = decode(media)
    payload = image.tobytes()
    return (
        doc_id, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media),
        hashlib.sha256(media).hexdigest(), difference_hash(image), media, npy_tile(image),
    )


def _mapper(with_media: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = _OUT if with_media else pa.schema([f for f in _OUT if f.name != "media"])
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = part.column("doc_id").to_pylist()
                rows = [_row(i, raw or b"") for i, raw in zip(ids, part.column("raw").to_pylist())]
                cols = [c for c, f in zip(zip(*rows), _OUT) if with_media or f.name != "media"]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, fields)], schema=fields)

    return run


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_media: bool = True) -> DataFrame:
    """One row per document: digests read back from the stored image, its difference hash, the NPY tile and
    (with_media) the stored image itself."""
    slim = docs.selectExpr(f"cast({id_col} as long) as doc_id", f"cast({text_col} as binary) as raw")
    return slim.mapInArrow(_mapper(with_media), DDL if with_media else DDL.replace("media binary, ", ""))


@bounded
def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = media_columns(load(spark, sf_dir, "documents"), with_media=False)
    return out.selectExpr(
        "doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256",
        "feature", "sha2(tile, 256) as tile_sha256",
    )
