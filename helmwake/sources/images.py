"""Images: listing by name, PNG decoding, sizes and statistics."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helmwake.operators.consolidate import PNG_HEAD, entries

#: Endings by preference, where one frame has several files.
ENDINGS = ("png", "jpg", "jpeg", "bmp")


#: Bytes per diagonal from which undoing filters along diagonals is faster than byte by byte.
DIAGONALS = 300


class CodecUnavailable(RuntimeError):
    """No decoder or encoder for a format is installed."""


def png_size(data: bytes) -> tuple[int, int, int, int] | None:
    """(width, height, bit depth, colour type) from the header; None for anything else."""
    if data is None or len(data) < 26 or data[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    return struct.unpack(">IIBB", data[16:26])


def decode_png(data: bytes) -> np.ndarray | None:
    """Pixels of a grey or RGB(A) PNG of 8 or 16 bits, not interlaced; None when the bytes are incomplete or broken."""
    head = png_size(data)
    if head is None:
        return None
    w, h, bits, colour = head
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if channels is None or bits not in (8, 16) or len(data) < 29 or data[28]:
        return None
    at, parts = 8, []
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IDAT":
            parts.append(data[at + 8 : at + 8 + n])
        at += 12 + n
    try:
        raw = zlib.decompress(b"".join(parts))
    except zlib.error:
        return None
    step = channels * bits // 8
    stride = w * step
    if len(raw) < h * (stride + 1):
        return None
    rows = np.frombuffer(raw[: h * (stride + 1)], np.uint8).reshape(h, stride + 1)
    if rows[:, 0].max(initial=0) > 4:
        return None
    slow = int(np.isin(rows[:, 0], (3, 4)).sum())
    # along diagonals all rows go on at once, which pays where many rows need the pixel to the left
    out = _along_diagonals(rows, step) if slow * stride > DIAGONALS * (h + w) else np.zeros((h, stride), np.uint8)
    for y in range(h if slow * stride <= DIAGONALS * (h + w) else 0):
        f, line = int(rows[y, 0]), rows[y, 1:].copy()
        up = out[y - 1] if y else np.zeros(stride, np.uint8)
        if f == 1:
            line = np.add.accumulate(line.reshape(w, step), axis=0, dtype=np.uint8).reshape(-1)
        elif f == 2:
            line = line + up
        elif f in (3, 4):
            line = _unfilter(line, up, step, f)
        out[y] = line
    px = out.reshape(h, w, channels, bits // 8)
    px = (px[..., 0].astype(np.uint16) << 8 | px[..., 1]) if bits == 16 else px[..., 0]
    return px[..., 0] if channels == 1 else px


def _along_diagonals(rows: np.ndarray, step: int) -> np.ndarray:
    """Undoes the filters of all rows: a pixel needs those to the left, above and between, so every diagonal is done at once."""
    h, w = len(rows), (rows.shape[1] - 1) // step
    kind, x = rows[:, 0], rows[:, 1:].reshape(h, w, step).astype(np.int16)
    out = np.zeros((h + 1, w + 1, step), np.int16)
    for d in range(h + w - 1):
        y = np.arange(max(0, d - w + 1), min(h, d + 1))
        u = d - y
        a, b, c, k = out[y + 1, u], out[y, u + 1], out[y, u], kind[y][:, None]
        da, db, dc = np.abs(b - c), np.abs(a - c), np.abs(a + b - 2 * c)
        near = np.where((da <= db) & (da <= dc), a, np.where(db <= dc, b, c))
        out[y + 1, u + 1] = (x[y, u] + np.select([k == 1, k == 2, k == 3, k == 4], [a, b, (a + b) >> 1, near], 0)) & 255
    return out[1:, 1:].reshape(h, -1).astype(np.uint8)


def resized(px: np.ndarray, width: int, height: int) -> np.ndarray:
    """The image at another size, bilinear with pixel centres kept in place."""
    def axis(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        lo = np.floor(at).astype(int)
        return lo, np.minimum(lo + 1, n - 1), at - lo

    (y0, y1, fy), (x0, x1, fx) = axis(px.shape[0], height), axis(px.shape[1], width)
    p = px.astype(float)
    more = (1,) * (px.ndim - 2)
    fy, fx = fy.reshape(-1, 1, *more), fx.reshape(1, -1, *more)
    rows = p[y0] * (1 - fy) + p[y1] * fy
    out = rows[:, x0] * (1 - fx) + rows[:, x1] * fx
    return np.rint(out).astype(px.dtype) if px.dtype.kind in "iu" else out.astype(px.dtype)


def header_size(data: Column) -> tuple[Column, Column]:
    """(width, height) from a PNG's header, without decoding; null for anything else."""
    png = (F.hex(F.substring(data, 1, 8)) == PNG_HEAD) & (F.octet_length(data) >= 26)
    number = lambda at: F.when(png, F.conv(F.hex(F.substring(data, at, 4)), 16, 10).cast("int"))
    return number(17), number(21)


def _unfilter(line: np.ndarray, up: np.ndarray, step: int, kind: int) -> np.ndarray:
    """Undoes the filters that need the pixel to the left as it comes out: the average (3) and the nearest predictor (4)."""
    left, corner, cur = [0] * step, [0] * step, line.tolist()
    above = up.tolist()
    for i in range(len(cur)):
        a, b, c = left[i % step], above[i], corner[i % step]
        if kind == 3:
            p = (a + b) >> 1
        else:
            da, db, dc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            p = a if da <= db and da <= dc else b if db <= dc else c
        cur[i] = (cur[i] + p) & 255
        left[i % step], corner[i % step] = cur[i], b
    return np.array(cur, np.uint8)


def depth_metres(px: np.ndarray, mode: str = "scale", scale: float = 0.0001, lo: float = 0.0, hi: float = 10.0) -> np.ndarray:
    """Depth of 16-bit pixels: times ``scale``, or linear from lo to hi over the whole range."""
    if mode == "scale":
        return px.astype(np.float64) * scale
    if mode == "linear":
        return lo + px.astype(np.float64) / 65535.0 * (hi - lo)
    raise ValueError(f"no such mode: {mode}")


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """Images below a folder: path, image_key, episode_index, frame_index, ending. Only names are read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "modificationTime", "length")
    stem = F.regexp_extract("path", r"([^/]*)$", 1)
    return f.select("path", F.regexp_extract("path", r"observation\.images\.(\w+)", 1).alias("image_key"), F.regexp_extract(stem, r"episode_0*(\d+)", 1).try_cast("bigint").alias("episode_index"), F.regexp_extract(stem, r"_0*(\d+)\.[^.]*$", 1).try_cast("bigint").alias("frame_index"), F.lower(F.regexp_extract(stem, r"\.([^.]*)$", 1)).alias("ending"))


def preferred(images: DataFrame) -> DataFrame:
    """One file per image, by preference of the ending, with its place in the episode in order of frame numbers."""
    keys = ["image_key", "episode_index", "frame_index"]
    rank = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(e) for e in ENDINGS]), F.col("ending")), F.lit(0)), F.lit(99))
    one = images.groupBy(*keys).agg(F.min_by("path", F.struct(rank.alias("r"), "path")).alias("path"))
    return one.withColumn("place", (F.row_number().over(Window.partitionBy("image_key", "episode_index").orderBy("frame_index", "path")) - 1).cast("bigint"))


def _moments(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        rows = []
        for e, d in zip(pdf["episode_index"], pdf["data"]):
            px = decode_png(bytes(d)) if d is not None else None
            if px is None or px.ndim != 3:
                continue
            x = px[..., :3].reshape(-1, 3).astype(np.float64) / 255.0
            rows.extend((e, c, len(x), float(x[:, c].sum()), float((x[:, c] ** 2).sum()), float(x[:, c].min()), float(x[:, c].max()), 1) for c in range(3))
        yield pd.DataFrame(rows, columns=["episode_index", "channel", "n", "s", "ss", "lo", "hi", "images"])


def channel_stats(files: DataFrame, column: str) -> DataFrame:
    """Per episode and channel of all decodable images, values from 0 to 1: min, max, mean, population std, count of images.

    Tasks decode and send sums only; incomplete images are left out.
    """
    e = entries(files).where(F.col("image_key") == column.rsplit(".", 1)[-1]).where("complete AND episode_index IS NOT NULL").select("episode_index", "data")
    p = e.mapInPandas(_moments, "episode_index bigint, channel int, n bigint, s double, ss double, lo double, hi double, images bigint")
    g = p.groupBy("episode_index", "channel").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.min("lo").alias("min"), F.max("hi").alias("max"), F.sum("images").alias("count"))
    mean = F.col("s") / F.col("n")
    return g.select("episode_index", "channel", "min", "max", mean.alias("mean"), F.sqrt(F.greatest(F.col("ss") / F.col("n") - mean * mean, F.lit(0.0))).alias("std"), "count")


def _depths(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        rows = []
        for i, d in zip(pdf["file_id"], pdf["data"]):
            px = decode_png(bytes(d)) if d is not None else None
            if px is not None and px.ndim == 2:
                m = depth_metres(px)
                rows.append((i, px.shape[1], px.shape[0], float(m.min()), float(m.max()), float(m.mean())))
        yield pd.DataFrame(rows, columns=["file_id", "width", "height", "nearest", "farthest", "mean"])


def depth_stats(files: DataFrame, column: str) -> DataFrame:
    """file_id, width, height, nearest, farthest and mean depth in metres of each decodable depth image."""
    e = entries(files).where(F.col("image_key") == column.rsplit(".", 1)[-1]).where("complete").select("file_id", "data")
    return e.mapInPandas(_depths, "file_id bigint, width int, height int, nearest double, farthest double, mean double")


#: Pixels that a task sends on at a time.
PIXELS = 1 << 18


def _pixels(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts, held = [], 0

    def take() -> pd.DataFrame:
        ids, pxs = [i for i, _ in parts], [px for _, px in parts]
        v, u = (np.concatenate([np.indices(px.shape)[k].ravel() for px in pxs]) for k in (0, 1))
        return pd.DataFrame({"file_id": np.repeat(ids, [px.size for px in pxs]), "v": v, "u": u, "depth": np.concatenate([depth_metres(px).ravel() for px in pxs])})

    for pdf in it:
        for i, d in zip(pdf["file_id"], pdf["data"]):
            px = decode_png(bytes(d)) if d is not None else None
            if px is None or px.ndim != 2:
                continue
            parts.append((i, px))
            held += px.size
            if held >= PIXELS:
                yield take()
                parts, held = [], 0
    if parts:
        yield take()


def depth_pixels(files: DataFrame, column: str) -> DataFrame:
    """file_id, v, u and depth in metres of every pixel of each complete, decodable depth image."""
    e = entries(files).where(F.col("image_key") == column.rsplit(".", 1)[-1]).where("complete").select("file_id", "data")
    return e.mapInPandas(_pixels, "file_id bigint, v bigint, u bigint, depth double")
