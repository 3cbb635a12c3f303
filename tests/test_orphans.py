from pyspark.sql import functions as F

from helmwake.operators.orphans import MAX_WORDS, bloom_words, orphan_keys, orphans
from helmwake.session import table


def test_filter_never_loses_an_orphan(spark):
    parents = spark.range(0, 20000, 2).select(F.col("id").alias("key"))
    refs = spark.range(0, 3000).select(F.col("id").alias("ref_key"))
    for words in (1024, 1 << 14):  # saturated and roomy
        got = {r[0] for r in orphan_keys(refs, parents, words=words).collect()}
        assert got == set(range(1, 3000, 2))
        assert bloom_words(parents, "key", words).count() <= words


def test_nulls_repeats_and_empty(spark):
    refs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, "c")], "ref_key bigint, x string")
    parents = spark.createDataFrame([(2,), (None,)], "key bigint")
    assert sorted(map(tuple, orphan_keys(refs, parents, words=1024).collect())) == [(1, "a"), (1, "a")]
    assert orphan_keys(refs, parents.limit(0), words=1024).count() == 3
    assert orphan_keys(refs.limit(0), parents, words=1024).count() == 0


def test_size_of_the_filter_is_bounded(spark):
    assert MAX_WORDS == 1 << 21 and bloom_words(spark.range(200_000).select(F.col("id").alias("key")), "key", 1 << 10).count() == 1 << 10


def test_deleted_restored_and_late(spark):
    ts = "timestamp'2024-03-05 00:00:00'"
    frames = spark.sql(f"SELECT * FROM VALUES (1, 10), (2, -1), (3, NULL), (4, 11) AS f(episode_index, task_index)").select(F.col("episode_index").cast("bigint"), F.col("task_index").cast("bigint"), F.expr(ts).alias("recorded_at"))
    episodes = spark.sql(f"SELECT * FROM VALUES (1L, NULL), (2L, {ts}), (3L, {ts}), (3L, NULL) AS e(episode_index, deleted_at)")
    tasks = spark.sql(f"SELECT * FROM VALUES (10L, {ts}) AS t(task_index, deleted_at)")
    docs = spark.sql(f"SELECT * FROM VALUES (9L, {ts}), (NULL, {ts}) AS d(episode_index, written_at)")
    got = {tuple(r) for r in orphans(frames, docs, episodes, tasks).collect()}
    assert got == {("frames", "episode_index", 2, "2024-03"), ("frames", "episode_index", 4, "2024-03"), ("frames", "task_index", 10, "2024-03"), ("frames", "task_index", 11, "2024-03"), ("documents", "episode_index", 9, "2024-03")}


def test_clashing_columns(spark, data, clashing):
    t = [table(spark, data, x) for x in ("frames", "documents", "episodes", "tasks")]
    assert {tuple(r) for r in orphans(*map(clashing, t)).collect()} == {tuple(r) for r in orphans(*t).collect()}
