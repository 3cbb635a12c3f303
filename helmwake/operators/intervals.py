"""Union of closed integer ranges per entity, and the holes between them.

A range is cut into 64-unit words. Its ragged ends become bit masks (literal
words), the full words between them one fill run, as in word-aligned compressed
bitmaps. Masks of the same word are united with bit_or, so the cost after the
first aggregation follows the covered words and not the rows. Set runs are then
read off the words and joined across words, per entity and time shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helmwake.operators.prefix import join_null_safe

#: Units per shard, as a power of two.
SHARD_BITS = 22


def valid_pair(c: Column) -> Column:
    """A pair counts when it has exactly two numbers, none null, the first not above the second."""
    a, b = F.get(c, F.lit(0)), F.get(c, F.lit(1))
    return F.coalesce((F.size(c) == 2) & a.isNotNull() & b.isNotNull() & (a <= b), F.lit(False))


def _words(ranges: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """One row per (entity, word): the united mask of the literals and the longest fill that starts there."""
    r = ranges.select(*keys, F.col(first).cast("bigint").alias("__a"), F.col(last).cast("bigint").alias("__z"))
    r = r.selectExpr(*[f"`{k}`" for k in keys], "__a", "__z", "shiftright(__a, 6) AS __wa", "shiftright(__z, 6) AS __wz", "cast(__a & 63 AS int) AS __ba", "cast(__z & 63 AS int) AS __bz")
    ones = "cast(-1 AS bigint)"
    head, tail = f"shiftleft({ones}, __ba)", f"shiftrightunsigned({ones}, 63 - __bz)"
    piece = "named_struct('w', {w}, 'm', {m}, 'f', {f})".format
    none = "cast(null AS bigint)"
    parts = (
        f"CASE WHEN __wa = __wz THEN array({piece(w='__wa', m=f'{head} & {tail}', f=none)}) "
        f"ELSE concat(array({piece(w='__wa', m=head, f=none)}, {piece(w='__wz', m=tail, f=none)}), "
        f"IF(__wz - __wa > 1, array({piece(w='__wa + 1', m='cast(0 AS bigint)', f='__wz - 1')}), array())) END"
    )
    e = r.selectExpr(*[f"`{k}`" for k in keys], f"inline({parts})")
    return e.groupBy(*keys, "w").agg(F.bit_or("m").alias("m"), F.max("f").alias("f"))


def _runs(words: DataFrame, keys: list[str]) -> DataFrame:
    """The set runs of each word, and its fill, as closed ranges in units."""
    bit = "(shiftrightunsigned(m, {0}) & 1) = 1".format
    off = "(shiftrightunsigned(m, {0}) & 1) = 0".format
    starts = f"filter(sequence(0, 63), i -> {bit('i')} AND (i = 0 OR {off('i - 1')}))"
    ends = f"filter(sequence(0, 63), i -> {bit('i')} AND (i = 63 OR {off('i + 1')}))"
    runs = f"CASE WHEN m = 0 THEN array() ELSE zip_with({starts}, {ends}, (s, e) -> named_struct('a', w * 64 + s, 'z', w * 64 + e)) END"
    fill = "IF(f IS NULL, array(), array(named_struct('a', w * 64, 'z', f * 64 + 63)))"
    return words.selectExpr(*[f"`{k}`" for k in keys], f"inline(concat({runs}, {fill}))")


def _boundaries(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, start, reach): a period starts at ``start``; all before it ends at ``reach`` (null for the first).

    A running maximum is taken inside each time shard and over one summary row
    per shard, so no entity has to be scanned by one task as a whole.
    """
    ks = [F.col(f"`{k}`") for k in keys]
    r = runs.withColumn("__s", F.expr(f"shiftright(a, {SHARD_BITS})"))
    inside = Window.partitionBy(*ks, "__s").orderBy("a", "z").rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("__in", F.max("z").over(inside))
    across = Window.partitionBy(*ks).orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    shards = runs.withColumn("__s", F.expr(f"shiftright(a, {SHARD_BITS})")).groupBy(*ks, "__s").agg(F.max("z").alias("__m"))
    shards = shards.select(*ks, "__s", F.max("__m").over(across).alias("__out"))
    j = join_null_safe(r, shards, [*keys, "__s"]).withColumn("reach", F.greatest("__in", "__out"))
    return j.where(F.col("reach").isNull() | (F.col("a") > F.col("reach") + 1)).select(*ks, "__s", F.col("a").alias("start"), "reach")


def periods_and_gaps(ranges: DataFrame, entity: Sequence[str], first: str, last: str) -> DataFrame:
    """Continuous periods of each entity's closed ranges, and the gaps between successive periods.

    Returns the entity columns, ``kind`` ('period' or 'gap'), ``first_unit`` and
    ``last_unit``. Ranges that overlap or follow each other without a unit between
    them form one period. Rows whose bounds are null or reversed are left out;
    repeated rows and ties change nothing; null entity values form an entity of
    their own; an empty table gives an empty result. Other columns are ignored,
    whatever their names.
    """
    keys = [f"__k{i}" for i in range(len(entity))]
    r = ranges.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(entity, keys)], F.col(f"`{first}`").alias("__f"), F.col(f"`{last}`").alias("__l"))
    r = r.where(F.col("__f").isNotNull() & F.col("__l").isNotNull() & (F.col("__f") <= F.col("__l")))
    runs = _runs(_words(r, keys, "__f", "__l"), keys)
    b = _boundaries(runs, keys)
    # each start's end is the reach at the next start, or the entity's last unit
    b = b.withColumn("__n", F.lead("reach").over(Window.partitionBy(*keys, "__s").orderBy("start")))
    after = Window.partitionBy(*keys).orderBy("__s").rowsBetween(1, Window.unboundedFollowing)
    firsts = b.groupBy(*keys, "__s").agg(F.min_by("reach", "start").alias("__r"))
    firsts = firsts.select(*keys, "__s", F.first("__r", ignorenulls=True).over(after).alias("__next"))
    ends = runs.groupBy(*keys).agg(F.max("z").alias("__end"))
    b = join_null_safe(join_null_safe(b, firsts, [*keys, "__s"]), ends, keys)
    rows = F.array(
        F.struct(F.lit("period").alias("kind"), F.col("start").alias("first_unit"), F.coalesce("__n", "__next", "__end").alias("last_unit")),
        F.struct(F.lit("gap").alias("kind"), (F.col("reach") + 1).alias("first_unit"), (F.col("start") - 1).alias("last_unit")),
    )
    e = b.select(*keys, F.inline(rows)).where(F.col("first_unit").isNotNull())
    return e.select(*[F.col(k).alias(c) for c, k in zip(entity, keys)], "kind", "first_unit", "last_unit")


def episode_layers(episodes: DataFrame) -> DataFrame:
    """(episode_index, layer, first_frame, last_frame) of every valid index pair of ``tasks``.

    ``sub`` comes from sub_indexes, ``sum`` from sum_indexes. Null or empty task
    lists, null steps and malformed pairs give no row.
    """
    step = episodes.select("episode_index", F.explode("tasks").alias("t"))
    pair = F.array(F.struct(F.lit("sub").alias("layer"), F.col("t.sub_indexes").alias("p")), F.struct(F.lit("sum").alias("layer"), F.col("t.sum_indexes").alias("p")))
    p = step.select("episode_index", F.inline(pair)).where(valid_pair(F.col("p")))
    return p.select("episode_index", "layer", F.col("p")[0].alias("first_frame"), F.col("p")[1].alias("last_frame"))


def episode_periods(episodes: DataFrame) -> DataFrame:
    """Periods and gaps of each episode and layer: episode_index, layer, kind, first_frame, last_frame."""
    r = periods_and_gaps(episode_layers(episodes), ["episode_index", "layer"], "first_frame", "last_frame")
    return r.select("episode_index", "layer", "kind", F.col("first_unit").alias("first_frame"), F.col("last_unit").alias("last_frame"))
