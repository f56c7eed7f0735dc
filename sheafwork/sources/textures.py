"""Block-compressed textures as texels, without an image codec.

A texture is decoded by itself inside a task, all its blocks at once: palettes and index planes are arrays.  Formats are BC1 (``DXT1``),
BC3 (``DXT5``) and uncompressed 24 or 32 bits with channel masks; only the first mip level is read.  What can't be decoded goes to
a ledger with its reason, never to texels."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The header's length and magic, the bits of its flags, and bytes of a block by format.
HEADER, MAGIC = 128, b"DDS "
FOURCC_FLAG, ALPHA_FLAG = 0x4, 0x1
BLOCK_BYTES = {b"DXT1": 8, b"DXT5": 16}
#: Images, and bytes of their texels, that decoded hands on together.
MOST_ROWS, MOST_BYTES = 1 << 12, 1 << 22


class TextureError(ValueError):
    pass


def rgb565(c: np.ndarray) -> np.ndarray:
    """(n, 3) channels of packed colours, the upper bits repeated below."""
    r, g, b = c >> 11 & 31, c >> 5 & 63, c & 31
    return np.stack([r << 3 | r >> 2, g << 2 | g >> 4, b << 3 | b >> 2], axis=-1).astype(np.uint16)


def palettes(first: np.ndarray, second: np.ndarray, always_four: bool) -> np.ndarray:
    """(n, 4, 4) RGBA palettes of blocks: two colours and two between them, or one between them and nothing."""
    a, b = rgb565(first), rgb565(second)
    four = np.stack([a, b, (2 * a + b) // 3, (a + 2 * b) // 3], axis=1)
    three = np.stack([a, b, (a + b) // 2, np.zeros_like(a)], axis=1)
    full = (first > second)[:, None, None] | np.bool_(always_four)
    alpha = np.full((len(first), 4, 1), 255, np.uint16)
    alpha[~full[:, 0, 0], 3] = 0
    return np.concatenate([np.where(full, four, three), alpha], axis=2).astype(np.uint8)


def alphas(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """(n, 8) palettes of alpha blocks."""
    a, b = first[:, None].astype(np.int32), second[:, None].astype(np.int32)
    k = np.arange(1, 7)
    eight = np.concatenate([a, b, ((7 - k) * a + k * b) // 7], axis=1)
    k = np.arange(1, 5)
    six = np.concatenate([a, b, ((5 - k) * a + k * b) // 5, np.zeros_like(a), np.full_like(a, 255)], axis=1)
    return np.where(a > b, eight, six).astype(np.uint8)


def blocks_to_rows(texels: np.ndarray, across: int, down: int, width: int, height: int) -> np.ndarray:
    """(height, width, channels) of (blocks, 16, channels), blocks in rows."""
    n = texels.shape[2]
    return texels.reshape(down, across, 4, 4, n).transpose(0, 2, 1, 3, 4).reshape(down * 4, across * 4, n)[:height, :width]


def decode_texture(data: bytes, opaque: bool = True) -> np.ndarray:
    """(height, width, 4) RGBA of a texture; alpha is 255 everywhere, or with opaque=False what the texture says."""
    if len(data) < HEADER or data[:4] != MAGIC:
        raise TextureError("no texture")
    height, width = struct.unpack_from("<II", data, 12)
    flags, four, bits, *masks = struct.unpack_from("<I4sI4I", data, 80)
    if not 0 < width <= 1 << 16 or not 0 < height <= 1 << 16:
        raise TextureError(f"{width} x {height} texels")
    body = memoryview(data)[HEADER:]
    if flags & FOURCC_FLAG:
        if four not in BLOCK_BYTES:
            raise TextureError(f"format {four!r}")
        across, down, size = -(-width // 4), -(-height // 4), BLOCK_BYTES[four]
        if len(body) < across * down * size:
            raise TextureError("shorter than its texels")
        raw = np.frombuffer(body, np.uint8, across * down * size).reshape(-1, size)
        colour = raw[:, size - 8 :]
        ends = np.ascontiguousarray(colour[:, :4]).view("<u2")
        index = np.ascontiguousarray(colour[:, 4:]).view("<u4")[:, :1] >> np.arange(0, 32, 2, dtype=np.uint32) & 3
        texels = np.take_along_axis(palettes(ends[:, 0], ends[:, 1], size == 16), index[:, :, None].astype(np.intp), axis=1)
        if size == 16:
            planes = np.zeros((len(raw), 8), np.uint8)
            planes[:, :6] = raw[:, 2:8]
            which = planes.view("<u8")[:, :1] >> np.arange(0, 48, 3, dtype=np.uint64) & np.uint64(7)
            texels[:, :, 3] = np.take_along_axis(alphas(raw[:, 0], raw[:, 1]), which.astype(np.intp), axis=1)
        out = blocks_to_rows(texels, across, down, width, height).copy()
    else:
        if bits not in (24, 32):
            raise TextureError(f"{bits} bits a texel")
        if len(body) < width * height * bits // 8:
            raise TextureError("shorter than its texels")
        wide = np.zeros((width * height, 4), np.uint8)
        wide[:, : bits // 8] = np.frombuffer(body, np.uint8, width * height * bits // 8).reshape(-1, bits // 8)
        word = wide.view("<u4")[:, 0]
        out = np.full((height, width, 4), 255, np.uint8)
        for c, mask in enumerate(masks):
            if mask and (c < 3 or flags & ALPHA_FLAG):
                low = (mask & -mask).bit_length() - 1
                top = mask >> low
                out[..., c] = ((word & mask) >> low).astype(np.uint64).reshape(height, width) * 255 // top
            elif c < 3:
                out[..., c] = 0
    if opaque:
        out[..., 3] = 255
    return out


def decoded(files: DataFrame, opaque: bool = True) -> DataFrame:
    """(path, width, height, rgba, problem) of files (path, content): rgba is height * width * 4 bytes, or problem says why not.

    Each file is decoded by itself.  Images are handed on together, up to MOST_BYTES or one larger image in a batch."""
    kinds = {"path": pa.string(), "width": pa.int32(), "height": pa.int32(), "rgba": pa.binary(), "problem": pa.string()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        put = lambda some: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some), kinds.values())], names=list(kinds))
        some: list[tuple] = []
        size = 0
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                width = height = rgba = problem = None
                try:
                    texels = decode_texture(content.as_py() or b"", opaque)
                    (height, width), rgba = texels.shape[:2], texels.tobytes()
                except TextureError as e:
                    problem = str(e)
                more = len(rgba or b"")
                if some and (len(some) >= MOST_ROWS or size + more > MOST_BYTES):
                    yield put(some)
                    some, size = [], 0
                some.append((path.as_py(), width, height, rgba, problem))
                size += more
        if some:
            yield put(some)

    return files.select(F.col("path").cast("string"), "content").mapInArrow(work, "path string, width int, height int, rgba binary, problem string")


def texels(images: DataFrame) -> DataFrame:
    """(path, row, col, r, g, b, a) of decoded images."""
    at = images.where("rgba IS NOT NULL").select("path", "width", "rgba", F.explode(F.sequence(F.lit(0), F.col("width") * F.col("height") - 1)).alias("k"))
    byte = lambda c: F.conv(F.hex(F.call_function("substring", "rgba", F.col("k") * 4 + c + 1, F.lit(1))), 16, 10).cast("int")
    return at.select("path", F.expr("k DIV width").cast("int").alias("row"), (F.col("k") % F.col("width")).alias("col"), *[byte(i).alias(c) for i, c in enumerate("rgba")])
