"""Small outputs: point clouds, reports and image folders."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helmwake.operators.runs import write_bytes
from helmwake.sinks import fs


def ply_bytes(points: pd.DataFrame) -> bytes:
    """A binary PLY file of x, y, z and, where given, red, green, blue from 0 to 1."""
    colour = {"red", "green", "blue"} <= set(points.columns)
    kinds = [(c, "<f8") for c in "xyz"] + ([(c, "u1") for c in ("red", "green", "blue")] if colour else [])
    a = np.zeros(len(points), kinds)
    for c in "xyz":
        a[c] = points[c]
    for c in ("red", "green", "blue") if colour else ():
        a[c] = np.clip(np.rint(points[c].fillna(0) * 255), 0, 255)
    head = ["ply", "format binary_little_endian 1.0", f"element vertex {len(points)}", *[f"property {'double' if t == '<f8' else 'uchar'} {c}" for c, t in kinds], "end_header\n"]
    return "\n".join(head).encode() + a.tobytes()


def write_clouds(points: DataFrame, folder: str, scene: str = "scene") -> DataFrame:
    """One PLY file per scene, written by the executors into a shared folder; returns (scene, path, n_points).

    A scene's cloud must fit one task; downsample it first (A15).
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        name = str(pdf[scene].iloc[0])
        path = f"{folder}/{name}.ply"
        write_bytes(path, ply_bytes(pdf))
        return pd.DataFrame({"scene": [name], "path": [path], "n_points": [len(pdf)]})

    return points.groupBy(scene).applyInPandas(run, "scene string, path string, n_points bigint")


def write_report(rows: DataFrame, folder: str, order: list) -> None:
    """A CSV report with a header, ordered, as the one file report.csv of the folder (K09); the rows are sorted and written in parts."""
    spark = rows.sparkSession
    rows.orderBy(*order).write.mode("overwrite").csv(f"{folder}.parts")
    head = ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n') else c for c in rows.columns)
    fs.write_text(spark, f"{folder}.parts/part-!header", head + "\n")
    fs.make_folder(spark, folder)
    fs.join_parts(spark, f"{folder}.parts", f"{folder}/report.csv")


def png_bytes(px: np.ndarray) -> bytes:
    """A PNG of a grey (8 or 16 bit) or RGB array."""
    h, w = px.shape[:2]
    bits, colour = (16, 0) if px.dtype == np.uint16 else (8, 0 if px.ndim == 2 else 2)
    raw = px.astype(">u2" if bits == 16 else np.uint8).reshape(h, -1).view(np.uint8).reshape(h, -1)
    body = zlib.compress(np.c_[np.zeros((h, 1), np.uint8), raw].tobytes())
    part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, bits, colour, 0, 0, 0)) + part(b"IDAT", body) + part(b"IEND", b"")


def normalise_image(px: np.ndarray) -> np.ndarray:
    """Height x width x channels, uint8: channels first are moved, floats from 0 to 1 are scaled."""
    if px.ndim == 3 and px.shape[0] in (1, 3) and px.shape[2] not in (1, 3):
        px = px.transpose(1, 2, 0)
    return np.rint(np.clip(px, 0, 1) * 255).astype(np.uint8) if px.dtype.kind == "f" else px.astype(np.uint8)


def write_images(images: DataFrame, folder: str) -> DataFrame:
    """Writes (path, data) rows below a shared folder from the executors (K02); returns (path, n_bytes)."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for p, d in zip(pdf["path"], pdf["data"]):
                write_bytes(f"{folder}/{p}", bytes(d))
            yield pd.DataFrame({"path": pdf["path"], "n_bytes": pdf["data"].map(len)})

    return images.where(F.col("path").isNotNull() & F.col("data").isNotNull()).select("path", "data").mapInPandas(run, "path string, n_bytes bigint")
