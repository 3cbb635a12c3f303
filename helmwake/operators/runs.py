"""Sorted runs in the shared folder and their k-way merge.

A run is one or more Parquet files sorted by (o, id), with disjoint key ranges.
Every input task writes one. The merge of a key range reads each run's row groups
that overlap it, batch by batch: all rows up to the smallest of the last keys in
memory are final and are put out in order, so memory holds a batch per run.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group of a run, and rows of a batch of one.
GROUP_BYTES, BATCH = 8 << 20, 8192
#: One key range: rows with lo <= o < hi; a hot key is split into parts, which take some of the runs each.
RANGE = "no bigint, lo bigint, hi bigint, part bigint, parts bigint"
FIRST, LAST = -(1 << 63), (1 << 63) - 1


def _fs(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class writer:
    """A Parquet file that has its name only once it is whole."""

    def __init__(self, path: str, schema: pa.Schema):
        self.fs, self.path = _fs(path)
        self.tmp = f"{self.path}.{os.getpid()}.tmp"
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.out = pq.ParquetWriter(self.tmp, schema.remove_metadata(), filesystem=self.fs)

    def write(self, t: pa.Table) -> None:
        self.out.write_table(t.replace_schema_metadata(None))

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.tmp, self.path)


def write_bytes(path: str, data: bytes) -> None:
    """A small file that has its name only once it is whole."""
    where, at = _fs(path)
    where.create_dir(os.path.dirname(at), recursive=True)
    tmp = f"{at}.{os.getpid()}.tmp"
    with where.open_output_stream(tmp) as f:
        f.write(data)
    where.move(tmp, at)


def clear(spark: SparkSession, folder: str) -> None:
    """Removes a folder of the shared file system, if it is there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_runs(rows: DataFrame, order: Sequence[str], folder: str) -> list[list[str]]:
    """Every task's rows, sorted, as one run; returns the runs' files."""
    rows.sortWithinPartitions(*order).write.mode("overwrite").option("parquet.block.size", GROUP_BYTES).parquet(folder)
    return [[f] for f in sorted(rows.sparkSession.read.parquet(folder).inputFiles())]


def cut(spark: SparkSession, runs: list[list[str]], each: int, most: int, size: str | None = None) -> list[dict]:
    """Key ranges of about ``each`` rows, or bytes of the column ``size``, at quantiles of all rows' keys; at least one per core of a large table.

    A key that fills several ranges is a hot one: it becomes a range of its own, in parts.
    """
    t = spark.read.parquet(*[f for r in runs for f in r])
    total, rows = t.agg(F.sum(size) if size else F.count("*"), F.count("*")).first()
    n = min(most, max(-(-int(total or 0) // each), 1 if size else min(spark.sparkContext.defaultParallelism, (rows or 0) // 20_000), 1))
    cuts = t.agg(F.percentile_approx("o", [k / n for k in range(1, n)], 20 * n)).first()[0] if n > 1 else []
    edges = sorted(set(cuts or []))
    hot = {c: list(cuts).count(c) for c in edges if list(cuts).count(c) > 1}
    bounds = sorted({FIRST, LAST, *edges, *[c + 1 for c in hot]})
    out: list[dict] = []
    for lo, hi in zip(bounds, bounds[1:]):
        parts = min(hot[lo], sum(map(len, runs))) if lo in hot and hi == lo + 1 else 1
        out += [{"no": len(out) + k, "lo": lo, "hi": hi, "part": k, "parts": parts} for k in range(parts)]
    return out


def spread(spark: SparkSession, ranges: list[dict]) -> DataFrame:
    """The ranges as rows, one task each."""
    return spark.createDataFrame([tuple(r[c.split()[0]] for c in RANGE.split(", ")) for r in ranges], RANGE).repartitionByRange(len(ranges), "no")


def rows_of(it: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in it:
        yield from b.to_pylist()


def _batches(files: list[str], lo: int, hi: int) -> Iterator[pa.Table]:
    """The rows of one run with lo <= o < hi, in order; row groups outside are not read."""
    for f in files:
        system, path = _fs(f)
        p = pq.ParquetFile(path, filesystem=system, coerce_int96_timestamp_unit="us")
        col = p.schema_arrow.get_field_index("o")
        groups = []
        for g in range(p.num_row_groups):
            st = p.metadata.row_group(g).column(col).statistics
            if st is None or not st.has_min_max or (st.max >= lo and st.min < hi):
                groups.append(g)
        for b in p.iter_batches(BATCH, row_groups=groups) if groups else ():
            o = b.column(col).to_numpy()
            a, z = np.searchsorted(o, [lo, hi])
            if z > a:
                yield pa.Table.from_batches([b.slice(a, z - a)])


def merge(runs: list[list[str]], r: dict) -> Iterator[pa.Table]:
    """The rows of a range from all runs, or from those of its part, merged in order of (o, id); none is dropped."""
    its = [_batches(f, r["lo"], r["hi"]) for k, f in enumerate(runs) if k % r["parts"] == r["part"]]
    live = {k: t for k, i in enumerate(its) if (t := next(i, None)) is not None}
    while live:
        ends = {k: (t["o"][-1].as_py(), t["id"][-1].as_py()) for k, t in live.items()}
        eo, ei = min(ends.values())
        final = []
        for k, t in list(live.items()):
            o = t["o"].to_numpy()
            a, z = np.searchsorted(o, eo, "left"), np.searchsorted(o, eo, "right")
            n = a + int(np.searchsorted(t["id"].to_numpy()[a:z], ei, "right"))
            final.append(t.slice(0, n))
            rest = t.slice(n)
            if not len(rest):
                rest = next(its[k], None)
            if rest is None:
                del live[k]
            else:
                live[k] = rest
        t = pa.concat_tables(final)
        yield t.take(pa.array(np.lexsort((t["id"].to_numpy(), t["o"].to_numpy()))))


def levelled(spark: SparkSession, runs: list[list[str]], ranges: list[dict], fan_in: int, folder: str) -> list[list[str]]:
    """At most ``fan_in`` runs: groups of that many are merged to one run each, in a file per key range, as often as needed."""
    level = 0
    while len(runs) > fan_in:
        level += 1
        groups = [runs[k : k + fan_in] for k in range(0, len(runs), fan_in)]
        whole = [x for x in ranges if x["part"] == 0]
        at = f"{folder}/{level}"

        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r in rows_of(it):
                out = None
                name = f"{at}/{r['part']:06d}-{r['no']:06d}.parquet"
                for t in merge(groups[r["part"]], r | {"part": 0, "parts": 1}):
                    out = out or writer(name, t.schema)
                    out.write(t)
                if out:
                    out.close()
                    yield pa.RecordBatch.from_pylist([{"grp": r["part"], "path": name}])

        todo = [x | {"part": g} for g in range(len(groups)) for x in whole]
        done = spread(spark, [x | {"no": x["no"]} for x in todo]).repartition(len(todo), "no", "part").mapInArrow(run, "grp bigint, path string").collect()
        runs = [sorted(d["path"] for d in done if d["grp"] == g) for g in range(len(groups))]
    return runs
