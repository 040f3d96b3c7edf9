"""Media columns: lossless PNG in binary columns, read back with checksum tests, and low-frequency cosine hashes.

encode_png writes 8-bit grey samples through zlib chunks; decode_png tests every chunk's CRC-32 and the image data's
Adler-32 (zlib's own), and undoes all five row filters with numpy. A feature is a 64-bit hash: the image's mean over a
32 x 32 grid, its two-dimensional cosine transform, the signs of the 8 x 8 lowest frequencies against their median.
"""

from __future__ import annotations

import struct
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, pieces

# Fixed values of the PNG format.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
NONE, SUB, UP, AVERAGE, PAETH = range(5)

WIDTH, GRID, LOW = 64, 32, 8
MEDIA_SCHEMA = "doc_id long, n_bytes long, media binary"
FEATURE_SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

_k = np.arange(GRID)
_COSINES = np.cos(np.pi * (2 * _k[None, :] + 1) * _k[:LOW, None] / (2 * GRID))


def padded(data: bytes, unit: int = WIDTH) -> bytes:
    """data with zero bytes up to a positive multiple of unit."""
    return data + bytes(max(unit, -(-len(data) // unit) * unit) - len(data))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode_png(samples: np.ndarray, level: int = 1, part: int = 1 << 20) -> bytes:
    """A grey image (rows x columns, uint8) as PNG. All rows take the filter, of none, sub and up, whose result has the
    smallest sum of absolute signed bytes; the compressed stream is cut into IDAT chunks of part bytes."""
    rows, width = samples.shape
    up = samples.copy()
    up[1:] -= samples[:-1]
    sub = samples.copy()
    sub[:, 1:] -= samples[:, :-1]
    forms = (samples, sub, up)
    best = min(range(3), key=lambda f: int(np.abs(forms[f].view(np.int8).astype(np.int16)).sum()))
    lines = np.empty((rows, width + 1), np.uint8)
    lines[:, 0] = best
    lines[:, 1:] = forms[best]
    stream = zlib.compress(lines.tobytes(), level)
    data = b"".join(_chunk(b"IDAT", stream[i : i + part]) for i in range(0, len(stream), part))
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, rows, 8, 0, 0, 0, 0)) + data + _chunk(b"IEND", b"")


def decode_png(media: bytes) -> np.ndarray:
    """The samples of an 8-bit grey PNG. ValueError: bad signature, chunk checksum, order, kind of image or size."""
    if media[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, size, stream, ended = 8, None, [], False
    while at < len(media):
        if at + 12 > len(media):
            raise ValueError("cut short")
        (n,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + n]
        if len(media) < at + 12 + n or zlib.crc32(kind + body) != struct.unpack_from(">I", media, at + 8 + n)[0]:
            raise ValueError("a chunk's checksum fails")
        at += 12 + n
        if kind == b"IHDR":
            width, rows, *rest = struct.unpack(">IIBBBBB", body)
            if rest != [8, 0, 0, 0, 0] or not width or not rows:
                raise ValueError("not 8-bit grey without interlacing")
            size = rows, width
        elif kind == b"IDAT":
            stream.append(body)
        elif kind == b"IEND":
            ended = True
            break
    if size is None or not ended:
        raise ValueError("no header or end")
    rows, width = size
    try:
        lines = np.frombuffer(zlib.decompress(b"".join(stream)), np.uint8)
    except zlib.error as e:
        raise ValueError(f"image data: {e}") from None
    if len(lines) != rows * (width + 1):
        raise ValueError("image data of another size")
    lines = lines.reshape(rows, width + 1)
    return unfilter(lines[:, 0], lines[:, 1:])


def unfilter(kinds: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Samples of one byte a pixel from filtered rows. Runs of rows of one kind are undone at once where they can be."""
    if len(kinds) and kinds.max() > PAETH:
        raise ValueError("unknown filter")
    out = np.empty_like(lines)
    above = np.zeros(lines.shape[1], np.uint8)
    edges = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1], True])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        kind = kinds[a]
        if kind == NONE:
            out[a:b] = lines[a:b]
        elif kind == SUB:
            np.cumsum(lines[a:b], axis=1, dtype=np.uint8, out=out[a:b])
        elif kind == UP:
            np.cumsum(lines[a:b], axis=0, dtype=np.uint8, out=out[a:b])
            out[a:b] += above
        else:
            for r in range(a, b):
                _undo_row(kind, lines[r], above, out[r])
                above = out[r]
        above = out[b - 1]
    return out


def _undo_row(kind: int, line: np.ndarray, above: np.ndarray, out: np.ndarray) -> None:
    left = corner = 0
    for i, (x, up) in enumerate(zip(line.tolist(), above.tolist(), strict=True)):
        if kind == AVERAGE:
            guess = (left + up) >> 1
        else:
            near = left + up - corner
            guess = min((abs(near - left), 0, left), (abs(near - up), 1, up), (abs(near - corner), 2, corner))[2]
        out[i] = left = (x + guess) & 255
        corner = up


def cosine_hash(samples: np.ndarray) -> str:
    """64 bits in hex: signs of the lowest frequencies against their median, without the constant one."""
    rows, width = samples.shape
    grid = samples.astype(np.float64)
    for axis, n in ((0, rows), (1, width)):
        if n >= GRID:
            cut = np.arange(GRID) * n // GRID
            sizes = np.diff(np.r_[cut, n]).astype(np.float64)
            grid = np.add.reduceat(grid, cut, axis=axis) / (sizes[:, None] if axis == 0 else sizes[None, :])
        else:
            grid = np.take(grid, np.arange(GRID) * n // GRID, axis=axis)
    low = np.round(_COSINES @ grid @ _COSINES.T, 6).ravel()
    bits = low > np.median(low[1:])
    bits[0] = False
    return np.packbits(bits).tobytes().hex()


def _encode(batches):
    for whole in batches:
        for batch in pieces(whole):
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            media = [encode_png(np.frombuffer(padded(t), np.uint8).reshape(-1, WIDTH)) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])


def with_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text's UTF-8 bytes, padded with zeros, as a PNG of 64 columns.

    A narrow map in slices of a few MB; one document at a time is held beside its slice. Null and empty texts give one
    row of zeros, equal texts equal media; a null id stays null.
    """
    return id_text(docs, id_col, text_col).mapInArrow(_encode, MEDIA_SCHEMA)


def _features(batches):
    for batch in (p for whole in batches for p in pieces(whole)):
        rows = []
        for media in batch.column(2).to_pylist():
            samples = decode_png(media)
            payload = samples.tobytes()
            rows.append((len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(media), sha256(media).hexdigest(), cosine_hash(samples)))
        cols = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [x.split()[0] for x in FEATURE_SCHEMA.split(", ")])


def media_features(media: DataFrame) -> DataFrame:
    """Sizes, checksums and cosine hash of with_media's column, all from the bytes read back. A damaged image fails the
    task with ValueError rather than giving a wrong row."""
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_features, FEATURE_SCHEMA)
