"""Queries of the llm operators; each takes (spark, data directory)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helmwake.llm import duplicates, mixing, quantiles, sentences, tokenizer
from helmwake.session import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.copies(table(spark, d, "tasks"))


def p1_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.collapse(table(spark, d, "tasks"))


def p2_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return quantiles.frame_percentiles(table(spark, d, "frames"))


def p2_within(spark: SparkSession, d: str) -> DataFrame:
    """The percentiles per scene against exact ranks: the number of readings, and whether the rank error is kept."""
    frames = table(spark, d, "frames")
    got = quantiles.frame_percentiles(frames).where("source_kind = 'scene'").withColumnRenamed("source", "scene")
    g = got.groupBy("scene", "field_name", "dim").agg(F.array_sort(F.collect_list(F.struct("q", "value", "n", "rank_error"))).alias("p"))
    fields = F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(f"`{c}`").alias("v")) for c in quantiles.FIELDS])
    one = frames.select("scene", "robot", "episode_index", "frame_index", "recorded_at", F.inline(fields)).distinct()
    x = one.select("scene", "field_name", F.posexplode("v").alias("dim", "x")).where("x IS NOT NULL AND NOT isnan(x)")
    # 36 scenes with a few dimensions: the percentiles are small, and each reading meets those of its own key only
    j = x.join(F.broadcast(g), ["scene", "field_name", "dim"])
    n = len(quantiles.PERCENTILES)
    s = j.groupBy("scene", "field_name", "dim").agg(F.first("p").alias("p"), F.count("*").alias("k"), *[F.sum((F.col("x") < F.col("p")[i]["value"]).cast("bigint")).alias(f"lo{i}") for i in range(n)], *[F.sum((F.col("x") <= F.col("p")[i]["value"]).cast("bigint")).alias(f"hi{i}") for i in range(n)])
    off = [F.greatest(F.col(f"lo{i}") - F.col("p")[i]["q"] * F.col("k"), F.col("p")[i]["q"] * F.col("k") - F.col(f"hi{i}"), F.lit(0.0)) for i in range(n)]
    rows = F.array(*[F.struct(F.col("p")[i]["q"].alias("q"), F.col("p")[i]["n"].alias("n"), (off[i] <= F.col("p")[i]["rank_error"] + 1).alias("within")) for i in range(n)])
    return s.select("scene", "field_name", "dim", F.inline(rows))


def p1_totals(spark: SparkSession, d: str) -> DataFrame:
    """Records before and after the collapse: every record is counted once among the copies."""
    c = duplicates.collapse(table(spark, d, "tasks"))
    return c.agg(F.sum("n_copies").alias("n_records"), (F.sum((F.col("n_copies") > 1).cast("int")) > 0).alias("has_copies"), F.min("task_index").alias("first"))


def p9_caps(spark: SparkSession, d: str) -> DataFrame:
    """Per source: no document more often than allowed, and the share reached as near the target as whole documents allow.

    A source misses its budget by half its last document at most, so shares are off by
    no more than half the largest document, once for the source and once for the total.
    """
    targets = table(spark, d, "mix_targets")
    mix = mixing.mix_documents(table(spark, d, "documents"), targets)
    s = mixing.shares(mix, targets)
    largest = mix.agg(F.max("n_tokens").alias("x")).scalar()
    whole = mix.agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("x")).scalar()
    n = targets.select("source").distinct().agg(F.count("*").alias("n")).scalar()
    slack = largest / 2 * (1 + n * F.col("target_share")) / whole + 1e-6
    return s.select("source", (F.col("most_copies") <= F.col("max_repeats")).alias("within_cap"), (F.abs(F.col("reached_share") - F.col("target_share")) <= slack).alias("near_target"))


def p10_cover(spark: SparkSession, d: str) -> DataFrame:
    """Per document: do its sentences hold all its visible characters, and are they apart from each other?"""
    docs = table(spark, d, "documents").select("doc_id", "text")
    visible = lambda t: F.length(F.regexp_replace(t, r"[\s\p{Z}\x1c-\x1f\x85]+", ""))
    u = sentences.sentence_units(docs).groupBy("doc_id").agg(F.sum(visible(F.col("sentence"))).alias("n"), F.array_sort(F.collect_list(F.struct("sent_start", "sent_end"))).alias("s"))
    apart = F.forall(F.sequence(F.lit(1), F.size("s")), lambda i: (i == 1) | (F.get("s", i - 1)["sent_start"] >= F.get("s", i - 2)["sent_end"]))
    j = docs.where("text IS NOT NULL").withColumn("all", visible(F.col("text"))).where(F.col("all") > 0).join(u, "doc_id", "left")
    return j.select("doc_id", F.coalesce(F.col("n") == F.col("all"), F.lit(False)).alias("covered"), F.coalesce(apart, F.lit(False)).alias("apart"))


def p2_days(spark: SparkSession, d: str) -> DataFrame:
    """The digests of single days, combined into those of all days: per scene."""
    frames = table(spark, d, "frames")
    days = quantiles.digests(quantiles.distinct_readings(frames), by_day=True)
    keys = ["scene", "field_name", "dim"]
    # a key has a digest per day and task at most
    n_days = frames.agg(F.approx_count_distinct(F.to_date("recorded_at"), 0.02).alias("n")).first()["n"]
    most = n_days * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return quantiles.percentiles(quantiles.merge(days, keys, most=most), keys, (0.5,))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.document_ids(table(spark, d, "documents"))


def p8_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Documents per language, and how many come back unchanged from their ids."""
    docs = tokenizer.with_ids(table(spark, d, "documents").select("doc_id", "lang", "text"))
    back = tokenizer.decode(docs, "ids", "back")
    same = (F.col("back") == F.coalesce("text", F.lit(""))).cast("bigint")
    return back.groupBy("lang").agg(F.count("*").alias("n_docs"), F.sum(same).alias("n_same"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_documents(table(spark, d, "documents"), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "mix_targets")
    return mixing.shares(mixing.mix_documents(table(spark, d, "documents"), targets), targets)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.document_sentences(table(spark, d, "documents"))


def p10_units(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentence_units(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fs = [p1_found, p1_collapsed, p1_totals, p2_percentiles, p2_days, p2_within, p8_ids, p8_roundtrip, p9_mix, p9_shares, p9_caps, p10_found, p10_units, p10_cover]
    return {f.__name__: f for f in fs}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the result: invariants that hold whatever the data."""
    reading = " UNION ALL ".join(f"""SELECT scene, '{c}' AS field_name, unnest("{c}") AS x, generate_subscripts("{c}", 1) - 1 AS dim FROM (SELECT DISTINCT scene, robot, episode_index, frame_index, recorded_at, "{c}" FROM frames)""" for c in quantiles.FIELDS)
    return {
        "p1_totals": "SELECT CAST(count(*) AS BIGINT) AS n_records, true AS has_copies, min(task_index) AS first FROM tasks",
        "p2_within": f"WITH r AS ({reading}), n AS (SELECT scene, field_name, CAST(dim AS INTEGER) AS dim, count(*) AS n FROM r WHERE x IS NOT NULL AND NOT isnan(x) GROUP BY ALL) SELECT scene, field_name, dim, q, n, true AS within FROM n, (SELECT unnest([{', '.join(map(str, quantiles.PERCENTILES))}]::DOUBLE[]) AS q)",
        "p8_roundtrip": "SELECT lang, count(*) AS n_docs, count(*) AS n_same FROM documents GROUP BY lang",
        "p9_caps": "SELECT source, true AS within_cap, true AS near_target FROM mix_targets",
        "p10_cover": r"SELECT doc_id, true AS covered, true AS apart FROM documents WHERE regexp_matches(text, '[^\s\pZ\x1c-\x1f\x{85}]')",
    }
