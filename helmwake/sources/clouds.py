"""Point clouds: PLY files and delimited text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# PLY's number types.
TYPES = {"char": "i1", "int8": "i1", "uchar": "u1", "uint8": "u1", "short": "i2", "int16": "i2", "ushort": "u2", "uint16": "u2", "int": "i4", "int32": "i4", "uint": "u4", "uint32": "u4", "float": "f4", "float32": "f4", "double": "f8", "float64": "f8"}


def parse_ply(data: bytes) -> pd.DataFrame:
    """x, y, z (and red, green, blue from 0 to 1, where given) of a PLY file's vertices, in ASCII or binary.

    A file without vertices gives no rows; one that is no PLY is an error.
    """
    end = data.find(b"end_header")
    if not data.startswith(b"ply") or end < 0:
        raise ValueError("not a PLY file")
    head = data[:end].decode("ascii", "replace").split("\n")
    body = data[data.index(b"\n", end) + 1 :]
    fmt, count, props, inside = "ascii", 0, [], False
    for line in head:
        w = line.split()
        if w[:1] == ["format"]:
            fmt = w[1]
        elif w[:1] == ["element"]:
            inside = w[1] == "vertex"
            count = int(w[2]) if inside else count
        elif w[:1] == ["property"] and inside:
            props.append((w[2], TYPES[w[1]]))
    if fmt == "ascii":
        rows = [line.split() for line in body.decode("ascii", "replace").split("\n")[:count] if line.strip()]
        v = pd.DataFrame(np.array(rows, float).reshape(-1, len(props)) if rows else np.zeros((0, len(props))), columns=[p for p, _ in props])
    else:
        order = ">" if "big" in fmt else "<"
        v = pd.DataFrame(np.frombuffer(body, np.dtype([(p, order + t) for p, t in props]), count).astype([(p, "f8") for p, _ in props]))
    out = pd.DataFrame({c: v[c].astype(float) for c in "xyz"})
    for c in ("red", "green", "blue"):
        out[c] = v[c].astype(float) / 255.0 if c in v else np.nan
    return out


def _parse(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        for path, content in zip(pdf["path"], pdf["content"]):
            yield parse_ply(bytes(content)).assign(path=path)[["path", "x", "y", "z", "red", "green", "blue"]]


def read_ply(spark: SparkSession, path: str) -> DataFrame:
    """The points of all PLY files below a path: scene, x, y, z, red, green, blue, path. One file is one task's work."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", "*.ply").option("recursiveFileLookup", "true").load(path).select("path", "content")
    p = f.mapInPandas(_parse, "path string, x double, y double, z double, red double, green double, blue double")
    return p.select(F.regexp_extract("path", r"([^/]+)/(?:meta/)?[^/]*$", 1).alias("scene"), "x", "y", "z", "red", "green", "blue", "path")


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """x, y, z of text files, separated by commas or by white space (S16); lines without three numbers are left out."""
    parts = F.split(F.trim("value"), r"\s*,\s*|\s+")
    cols = [F.try_element_at(parts, F.lit(i)).try_cast("double").alias(c) for i, c in enumerate("xyz", 1)]
    return spark.read.text(path).select(*cols).where("x IS NOT NULL AND y IS NOT NULL AND z IS NOT NULL")
