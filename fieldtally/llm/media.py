"""Media columns: Netpbm and BMP images to arrays, tiles and hashes."""

from __future__ import annotations

import hashlib
import io
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table, slices

_HEADER = re.compile(rb"(?:\s|#[^\n]*\n)*([0-9]+)")


def decode_netpbm(data: bytes) -> np.ndarray:
    """P1 to P6 as (height, width) or (height, width, 3) of uint8 or uint16.

    Samples that are no numbers or beyond the stated largest one, and images that
    are empty or cut short, raise ValueError.
    """
    kind = data[:2]
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("not a Netpbm image")
    at, numbers = 2, []
    for _ in range(2 if kind in (b"P1", b"P4") else 3):
        m = _HEADER.match(data, at)
        if not m:
            raise ValueError("a Netpbm header is cut short")
        numbers.append(int(m[1]))
        at = m.end()
    width, height = numbers[:2]
    most = numbers[2] if len(numbers) > 2 else 1
    if not 0 < most < 65536:
        raise ValueError("the largest sample is out of range")
    depth = 3 if kind in (b"P3", b"P6") else 1
    count = width * height * depth
    if not count:
        raise ValueError("a Netpbm image has no samples")
    if count > len(data) * (8 if kind == b"P4" else 1):
        raise ValueError("a Netpbm image is cut short")
    if kind == b"P4":
        rows = np.frombuffer(data, np.uint8, height * (-(-width // 8)), at + 1).reshape(height, -1)
        samples = 1 - np.unpackbits(rows, axis=1)[:, :width]
    elif kind == b"P1":
        digits = np.frombuffer(re.sub(rb"#[^\n]*|\s", b"", data[at:])[:count], np.uint8)
        if not np.isin(digits, (48, 49)).all():
            raise ValueError("a bit is neither 0 nor 1")
        samples = 49 - digits
    elif kind in (b"P2", b"P3"):
        texts = re.sub(rb"#[^\n]*", b"", data[at:]).split()[:count]
        if not all(t.isdigit() and len(t.lstrip(b"0")) <= 5 for t in texts):
            raise ValueError("a sample is not a number in range")
        samples = np.array(list(map(int, texts)), np.int64)
    else:
        samples = np.frombuffer(data, np.uint8 if most < 256 else ">u2", count, at + 1)
    if samples.size != count:
        raise ValueError("a Netpbm image is cut short")
    if samples.max() > most:
        raise ValueError("a sample is beyond the largest one")
    shape = (height, width, 3) if depth == 3 else (height, width)
    return samples.reshape(shape).astype(np.uint8 if most < 256 else np.uint16, copy=False)


def encode_pgm(samples: np.ndarray) -> bytes:
    return b"P5\n%d %d\n255\n" % (samples.shape[1], samples.shape[0]) + samples.tobytes()


def _masked(pixels: np.ndarray, mask: int) -> np.ndarray:
    """The part of each pixel under a mask of bits, from 0 to 255."""
    if not mask:
        raise ValueError("a colour has no bits")
    low = (mask & -mask).bit_length() - 1
    return (((pixels & np.uint64(mask)) >> np.uint64(low)) * np.uint64(255) // np.uint64(mask >> low)).astype(np.uint8)


def decode_bmp(data: bytes) -> np.ndarray:
    """Uncompressed BMP of 1, 4, 8, 24 or 32 bits, the last also with masks for
    red, green and blue, as (height, width, 3) of uint8."""
    if data[:2] != b"BM":
        raise ValueError("not a BMP image")
    first, header, width, height, _, bits, packed = struct.unpack_from("<IIiiHHI", data, 10)
    if (packed, bits) not in ((0, 1), (0, 4), (0, 8), (0, 24), (0, 32), (3, 32)) or width <= 0 or not height:
        raise ValueError("this kind of BMP isn't supported")
    stride = (width * bits + 31) // 32 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(height), first).reshape(abs(height), stride)
    rows = rows[::-1] if height > 0 else rows
    if packed == 3:
        masks = struct.unpack_from("<III", data, 54)
        pixels = np.ascontiguousarray(rows[:, : width * 4]).view("<u4").astype(np.uint64)
        return np.stack([_masked(pixels, m) for m in masks], axis=2)
    if bits >= 24:
        return np.ascontiguousarray(rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)[:, :, 2::-1])
    used = struct.unpack_from("<I", data, 46)[0] or 1 << bits
    palette = np.frombuffer(data, np.uint8, used * 4, 14 + header).reshape(-1, 4)[:, 2::-1]
    bit = np.unpackbits(rows, axis=1)[:, : width * bits].reshape(abs(height), width, bits)
    return palette[(bit * (1 << np.arange(bits - 1, -1, -1))).sum(2)]


def decode(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else image.astype(np.float64) @ np.array([0.299, 0.587, 0.114])


def _strips(lines: np.ndarray, parts: int) -> np.ndarray:
    """The mean of each of ``parts`` equal strips of axis 0, from its integral."""
    total = np.concatenate([np.zeros((1, *lines.shape[1:])), np.cumsum(lines, axis=0, dtype=np.float64)])
    edges = np.linspace(0, len(lines), parts + 1)
    low = np.minimum(edges.astype(np.int64), len(lines) - 1)
    share = (edges - low).reshape(-1, *[1] * (lines.ndim - 1))
    at = total[low] * (1 - share) + total[low + 1] * share
    return np.diff(at, axis=0) / (len(lines) / parts)


def area_resize(image: np.ndarray, height: int, width: int, rows: int = 1 << 16) -> np.ndarray:
    """Means of equal areas, by integral images.

    The integral is taken along each axis in turn, across in runs of ``rows``
    lines, so a tall image needs little more memory than its own.
    """
    if 0 in image.shape:
        return np.zeros((height, width))
    across = np.concatenate([_strips(image[i : i + rows].T, width).T for i in range(0, len(image), rows)])
    return _strips(across, height)


def difference_hash(image: np.ndarray) -> str:
    """64 bits in hex: whether each of 8 x 8 areas is brighter than the next."""
    small = area_resize(grey(image), 8, 9)
    return np.packbits(small[:, :-1] > small[:, 1:]).tobytes().hex()


def to_tiles(image: np.ndarray, lines: int) -> list[bytes]:
    """NPY files of up to ``lines`` lines each."""
    out = []
    for i in range(0, max(1, len(image)), lines):
        np.save(f := io.BytesIO(), np.ascontiguousarray(image[i : i + lines]), allow_pickle=False)
        out.append(f.getvalue())
    return out


def from_tiles(tiles: list[bytes]) -> np.ndarray:
    return np.concatenate([np.load(io.BytesIO(t), allow_pickle=False) for t in tiles])


def media_tiles(media: DataFrame, id_col: str, media_col: str, lines: int = 4096, batch_bytes: int = 1 << 22) -> DataFrame:
    """For each row: ``id_col``, ``height``, ``width``, ``dhash``, ``tiles`` (NPY
    files, in order) and ``error``.

    A null or undecodable image has null results and the reason in ``error``;
    it does not stop the job.  Repeated rows give repeated results; other
    columns are ignored; an empty table gives an empty result.  No shuffle.
    """
    rows = media.select(F.col(id_col).alias("id"), F.col(media_col).alias("media"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", batch_bytes):
            out = []
            for data in batch.column(1).to_pylist():
                try:
                    if data is None:
                        raise ValueError("no image")
                    image = decode(data)
                    out.append((image.shape[0], image.shape[1], difference_hash(image), to_tiles(image, lines), None))
                except (ValueError, OverflowError, struct.error, IndexError) as e:
                    out.append((None, None, None, None, str(e)[:200]))
            h, w, d, t, e = zip(*out)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(h, pa.int64()), pa.array(w, pa.int64()), pa.array(d, pa.string()), pa.array(t, pa.list_(pa.binary())), pa.array(e, pa.string())], ["id", "height", "width", "dhash", "tiles", "error"])

    return rows.mapInArrow(run, f"id {kind}, height long, width long, dhash string, tiles array<binary>, error string").withColumnRenamed("id", id_col)


def text_images(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 64, batch_bytes: int = 1 << 22) -> DataFrame:
    """Each text's UTF-8 bytes, padded with 0 to a positive multiple of
    ``width``, as the samples of a PGM image: ``id_col``, ``n_bytes``, ``media``.
    A null text is an empty one."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", batch_bytes):
            data = batch.column(1).cast(pa.binary()).to_pylist()
            images = [encode_pgm(np.frombuffer(x + bytes(-len(x) % width if x else width), np.uint8).reshape(-1, width)) for x in data]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in data], pa.int64()), pa.array(images, pa.binary())], ["id", "n_bytes", "media"])

    return rows.mapInArrow(run, f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id_col)


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 64, tail: int = 64) -> DataFrame:
    """Store texts as images in NPY tiles in the shared folder, read the tiles
    back and describe them: ``id_col``, ``n_bytes``, ``payload_bytes``,
    ``payload_sha256``, ``tail_crc32`` (last ``tail`` payload bytes),
    ``media_bytes`` and ``media_sha256`` of the tiles in order, ``feature``
    (difference hash and shape).  Nulls and edges as in the functions above.
    """
    images = text_images(docs, id_col, text_col, width)
    pictures = images.select(F.struct(F.col(id_col).alias("id"), "n_bytes").alias("key"), "media")
    stored = Table(media_tiles(pictures, "key", "media"), "media").read()
    kind = stored.schema["key"].dataType["id"].dataType.simpleString()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tiles in batch.column(2).to_pylist():
                image = from_tiles(tiles)
                payload = image.tobytes()
                whole = hashlib.sha256()
                for t in tiles:
                    whole.update(t)
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-tail:]), sum(map(len, tiles)), whole.hexdigest(), f"{difference_hash(image)}:{image.shape[1]}x{image.shape[0]}"))
            n, sha, crc, size, media, feature = zip(*out)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sha), pa.array(crc, pa.int64()), pa.array(size, pa.int64()), pa.array(media), pa.array(feature)], ["id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    back = stored.select(F.col("key.id").alias("id"), F.col("key.n_bytes").alias("n_bytes"), "tiles")
    return back.mapInArrow(describe, f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string").withColumnRenamed("id", id_col)
