from pyspark.sql import functions as F

from helmwake.streaming import new_episodes, run_groups_stream, windowed_counts


def stream(spark, tmp_path, name, batches, schema):
    d = str(tmp_path / name)
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(d)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)


def collect(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    try:
        q.awaitTermination(20)
    finally:
        q.stop()
    return df.sparkSession.table(name).collect()


def test_runs_across_batches(spark, tmp_path):
    import time

    d = str(tmp_path / "r")
    schema = "source string, id string, seq bigint"
    for rows in ([("f", "a", 0), ("f", "a", 1)], [("f", "a", 2), ("f", "b", 3)], [("f", "c", 4)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(d)
        time.sleep(1.1)  # files are read in order of their times
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    got = sorted(tuple(r) for r in collect(run_groups_stream(s), "runs"))
    assert got == [("f", 0, "a", 0, 2, 3), ("f", 1, "b", 3, 3, 1)]


def test_windows_and_anti_join(spark, tmp_path):
    rows = [("2024-01-01 00:00:00", "a"), ("2024-01-01 00:09:00", "a"), ("2024-01-01 02:00:00", "b")]
    s = stream(spark, tmp_path, "w", [rows], "at string, k string").withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = collect(windowed_counts(s, "at", "k"), "wins", "update")
    assert sorted((r["k"], r["n"]) for r in got) == [("a", 2), ("b", 1)]
    e = stream(spark, tmp_path, "e", [[(1,), (2,), (3,)]], "episode_index bigint")
    assert {r[0] for r in collect(new_episodes(e, spark.createDataFrame([(2,)], "episode_index bigint")), "eps")} == {1, 3}
