"""References to rows that do not exist.

A blocked Bloom filter of the parent keys is built with bit_or: every key sets
four bits in one 64-bit word. The filter has a fixed number of words (at most
``MAX_WORDS``), so it may be broadcast whatever the parents' size; more keys only
fill it and pass more references on. A reference it rejects is an orphan for
certain; only the rest are joined with the parents exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the broadcast filter: 2**21 words of 8 bytes, which suit some 12 million parents. Only words that hold a bit are rows of it.
MAX_WORDS = 1 << 21


def _slot(key: str, words: int) -> tuple[Column, Column]:
    h, g = f"xxhash64(`{key}`)", f"xxhash64(`{key}`, 7)"
    bits = " | ".join(f"shiftleft(cast(1 AS bigint), cast(shiftrightunsigned({g}, {6 * i}) & 63 AS int))" for i in range(4))
    return F.expr(f"{h} & {words - 1}").cast("bigint"), F.expr(bits)


def bloom_words(parents: DataFrame, key: str, words: int) -> DataFrame:
    """(w, bits): the filter's words that hold any bit; at most ``words`` rows."""
    w, bits = _slot(key, words)
    return parents.where(F.col(f"`{key}`").isNotNull()).select(w.alias("w"), bits.alias("b")).groupBy("w").agg(F.bit_or("b").alias("bits"))


def _probed(rows: DataFrame, key: str, filt: DataFrame, words: int) -> DataFrame:
    """The rows with ``__maybe``: may the key be among those of the filter? False is certain."""
    w, bits = _slot(key, words)
    f = F.broadcast(filt.select(F.col("w").alias("__w"), F.col("bits").alias("__bits")))
    p = rows.withColumn("__rw", w).withColumn("__rb", bits).join(f, F.col("__rw") == F.col("__w"), "left")
    return p.withColumn("__maybe", F.coalesce(F.col("__bits").bitwiseAND(F.col("__rb")) == F.col("__rb"), F.lit(False)))


def maybe_among(rows: DataFrame, key: str, filt: DataFrame, words: int = MAX_WORDS) -> DataFrame:
    """The rows whose key may be among those of the filter's words; all that are, and a few others."""
    return _probed(rows, key, filt, words).where("__maybe").select(*[F.col(f"`{c}`") for c in rows.columns])


def orphan_keys(refs: DataFrame, parents: DataFrame, ref_key: str = "ref_key", parent_key: str = "key", words: int = MAX_WORDS) -> DataFrame:
    """The rows of ``refs`` whose key is not among the parents' keys.

    Null keys of either side never match and are never orphans; repeated rows
    are kept; with no parents every reference is an orphan.
    """
    r = refs.where(F.col(f"`{ref_key}`").isNotNull())
    p = parents.select(F.col(f"`{parent_key}`").alias("__p"))
    probed = _probed(r, ref_key, bloom_words(p, "__p", words), words)
    cols = [F.col(f"`{c}`") for c in refs.columns]
    certain = probed.where(~F.col("__maybe")).select(*cols)
    # only filter-positive references are joined exactly
    checked = probed.where("__maybe").select(*cols).join(p.where("__p IS NOT NULL").distinct(), F.col(f"`{ref_key}`") == F.col("__p"), "left_anti")
    return certain.unionByName(checked)


def frame_references(frames: DataFrame) -> DataFrame:
    """Distinct (child_table, ref_column, ref_key, period) of the frames; -1 and null are no references."""
    month = F.date_format("recorded_at", "yyyy-MM")
    both = F.array(*[F.struct(F.lit(c).alias("ref_column"), F.col(c).alias("ref_key")) for c in ("episode_index", "task_index")])
    r = frames.select(month.alias("period"), F.inline(both)).where("ref_key IS NOT NULL AND ref_key <> -1")
    return r.distinct().select(F.lit("frames").alias("child_table"), "ref_column", "ref_key", "period")


def document_references(documents: DataFrame) -> DataFrame:
    """Distinct references of the documents to episodes, per month of writing."""
    r = documents.select(F.lit("documents").alias("child_table"), F.lit("episode_index").alias("ref_column"), F.col("episode_index").alias("ref_key"), F.date_format("written_at", "yyyy-MM").alias("period"))
    return r.where("ref_key IS NOT NULL AND ref_key <> -1").distinct()


def orphans(frames: DataFrame, documents: DataFrame, episodes: DataFrame, tasks: DataFrame) -> DataFrame:
    """Every distinct orphan reference with its table, column and month.

    A reference is orphaned when no row of its target with that key has a null
    deleted_at; late arrival does not matter. A null recorded_at or written_at
    gives a null period.
    """
    live_e = episodes.where("deleted_at IS NULL").select(F.col("episode_index").alias("key"))
    live_t = tasks.where("deleted_at IS NULL").select(F.col("task_index").alias("key"))
    of_frames = frame_references(frames)
    refs_e = of_frames.where("ref_column = 'episode_index'").unionByName(document_references(documents))
    refs_t = of_frames.where("ref_column = 'task_index'")
    found = orphan_keys(refs_e, live_e).unionByName(orphan_keys(refs_t, live_t))
    return found.select("child_table", "ref_column", "ref_key", "period")


def orphan_report(found: DataFrame, by: Sequence[str] = ("child_table", "ref_column", "period")) -> DataFrame:
    """Number of orphaned keys per table, column and period."""
    return found.groupBy(*by).agg(F.countDistinct("ref_key").alias("n_orphans"))
