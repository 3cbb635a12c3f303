from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helmwake.operators.intervals import episode_periods, periods_and_gaps
from helmwake.session import table

SCHEMA = "e bigint, a bigint, z bigint"


def brute(rows):
    out = set()
    for e in {r[0] for r in rows}:
        rs = sorted((a, z) for x, a, z in rows if x == e and a is not None and z is not None and a <= z)
        merged = []
        for a, z in rs:
            if merged and a <= merged[-1][1] + 1:
                merged[-1][1] = max(merged[-1][1], z)
            else:
                merged.append([a, z])
        out |= {(e, "period", a, z) for a, z in merged}
        out |= {(e, "gap", x[1] + 1, y[0] - 1) for x, y in zip(merged, merged[1:])}
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {tuple(r) for r in periods_and_gaps(df, ["e"], "a", "z").collect()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-70, 400), st.integers(0, 150)), min_size=1, max_size=40))
def test_against_brute_force(spark, rows):
    rows = [(e, a, a + n) for e, a, n in rows]
    assert run(spark, rows) == brute(rows)


def test_word_and_shard_borders(spark):
    s = 1 << 22
    rows = [(1, 0, 63), (1, 64, 127), (1, 129, 129), (2, s - 1, s), (2, s + 1, 3 * s + 5), (2, 3 * s + 7, 3 * s + 7), (3, 10, 10**12), (3, 5 * s, 5 * s + 3), (3, 10**12 + 2, 10**12 + 2), (4, -5, -1), (4, 0, 0)]
    assert run(spark, rows) == brute(rows)


def test_nulls_ties_repeats_and_reversed(spark):
    rows = [(None, 1, 3), (None, 5, 6), (1, None, 4), (1, 4, None), (1, 9, 2), (1, 7, 7), (1, 7, 7), (2, None, None)]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == set()


def test_episodes_with_clashing_columns(spark, data, clashing):
    e = table(spark, data, "episodes")
    want = {tuple(r) for r in episode_periods(e).collect()}
    assert want and {tuple(r) for r in episode_periods(clashing(e)).collect()} == want
    assert episode_periods(e.limit(0)).count() == 0
    assert episode_periods(e.withColumn("tasks", F.lit(None).cast(e.schema["tasks"].dataType))).count() == 0


def test_one_entity_with_most_rows_keeps_all(spark):
    rows = [(1, 3 * i, 3 * i + 1) for i in range(3000)] + [(2, 0, 1)]
    assert run(spark, rows) == brute(rows)
