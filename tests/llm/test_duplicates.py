import json

from pyspark.sql import functions as F

from helmwake.llm.duplicates import cheap_key, collapse, copies
from helmwake.session import table

SCHEMA = "task_index bigint, task string"


def run(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    return {tuple(r) for r in copies(df).collect()}


def test_formatting_does_not_count(spark):
    base = "Turn left-hand side at 2.5 m, then stop!"
    same = [base, base.upper(), "turn left hand side at 2.5 m then stop", "  turn　left\nhand side: at 2.5 m / then; stop...", base, '"Turn left – hand side", at 2.5m; then stop?', "* Turn left hand​side at 2.5 m then stop"]
    assert run(spark, same) == {(0, i) for i in range(1, len(same))}


def test_content_counts(spark):
    other = ["go 2.5 m", "go 25 m", "go 2 5 m", "go 2,5 m", "go 5.2 m", "go 2.5 n", "og 2.5 m", "go 2.55 m", "", None, "  ", "​", "!!", "go -2.5"]
    assert run(spark, other) == set()


def test_sharp_s_and_final_sigma(spark):
    assert run(spark, ["Straße ΟΔΟΣ", "STRASSE οδος", "strasse οδοσ"]) == {(0, 1), (0, 2)}


def test_json(spark):
    a = [{"sub_instruction": "Café: turn 2.5 m", "sub_indexes": [0, 17], "x": None}, {"b": True, "a": {"z": 1, "y": "q"}}]
    b = [{"x": None, "sub_indexes": [0, 17], "sub_instruction": "CAFÉ turn\t2.5　m!"}, {"a": {"y": "Q", "z": 1}, "b": True}]
    texts = [json.dumps(a), json.dumps(b, indent=2), json.dumps(a, ensure_ascii=False, separators=(",", ":")), " " + json.dumps(b) + "\n"]
    other = [json.dumps(a[::-1]), json.dumps([{**a[0], "sub_indexes": [17, 0]}, a[1]]), json.dumps([{**a[0], "sub_indexes": [0, 1, 7]}, a[1]]), json.dumps([{"sub_instruction": "Café: turn", "sub_indexes": [0, 17], "x": "2.5 m"}, a[1]]), '{"a": 1', '{"a": 1, "a": 1}']
    assert run(spark, texts + other) == {(0, 1), (0, 2), (0, 3)}
    escaped = '["\\u0054urn left"]'
    assert run(spark, ['["turn left"]', escaped, "turn left"]) == {(0, 1)}


def test_large_group_empty_repeats_and_clashes(spark, data, clashing):
    texts = ["Same task!" if i % 2 else "same  task" for i in range(3000)] + [f"task {i}" for i in range(50)]
    assert run(spark, texts) == {(0, i) for i in range(1, 3000)}
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "A-B"), (None, "a b")], SCHEMA)
    assert {tuple(r) for r in copies(df).collect()} == {(1, 2)}
    assert copies(df.limit(0)).count() == 0
    t = table(spark, data, "tasks")
    assert {tuple(r) for r in copies(clashing(t)).collect()} == {tuple(r) for r in copies(t).collect()}


def test_long_texts(spark):
    long = "word 1.5, " * 50_000
    assert run(spark, [long, long.upper(), long + "x"]) == {(0, 1)}


def test_collapse_counts_every_record(spark):
    df = spark.createDataFrame(list(enumerate(["a b", "A B", "c", None, "a-b", ""])), SCHEMA)
    rows = {r["task_index"]: r["n_copies"] for r in collapse(df).collect()}
    assert rows == {0: 3, 2: 1, 3: 1, 5: 1} and sum(rows.values()) == 6
    assert collapse(df).agg(F.sum("n_copies")).first()[0] == 6


def test_cheap_key_refines_every_script(spark):
    """Level 1 tells texts of any script apart and is the same for every form of one record."""
    words = ["飞向红塔然后右转", "飞向蓝塔然后右转", "飞向红塔然后左转", "летит к башне", "летит к бочке", "πέτα στον πύργο", "fly to the tower", "fly to the towel", "turn north"]
    texts = words + [w.upper() + "。 !" for w in words] + [json.dumps([{"a": w}]) for w in words] + [json.dumps([{"a": w}], ensure_ascii=False, indent=1) for w in words]
    df = spark.createDataFrame(list(enumerate(texts)), "i bigint, t string").select("i", cheap_key(F.col("t")).alias("c"))
    c = [r["c"] for r in df.orderBy("i").collect()]
    n = len(words)
    assert c[:n] == c[n : 2 * n] and c[2 * n : 3 * n] == c[3 * n :] and len(set(c)) == 2 * n


def test_a_backslash_in_plain_text_is_punctuation(spark):
    assert run(spark, ["[go\\north now", "go north NOW", "[go/north] now"]) == {(0, 1), (0, 2)}
