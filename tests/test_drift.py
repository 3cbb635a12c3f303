import json
from collections import Counter, defaultdict

from helmwake.operators.drift import ALIASES, changes, consistent_table, lifespans
from helmwake.session import table

SCHEMA = "file_id bigint, stream string, line_no bigint, recorded_at timestamp_ntz, arrived_at timestamp_ntz, payload string"


def kind(v):
    if isinstance(v, (int, float)):
        return "number"
    if isinstance(v, str):
        return "text"
    if isinstance(v, dict):
        return "object"
    return "list " + ("lists" if isinstance(v[0], list) else kind(v[0]))


def brute(rows):
    group = {n: q for q, ns in ALIASES.items() for n in ns}
    files = defaultdict(dict)
    for r in rows:
        key = (r["stream"], r["recorded_at"], r["file_id"])
        f = files[key]
        try:
            o = json.loads(r["payload"])
        except (TypeError, ValueError):
            continue
        if isinstance(o, dict):
            for k, v in o.items():
                if v is not None:
                    f.setdefault(k, Counter())[kind(v)] += 1
    out = set()
    by = defaultdict(list)
    for (s, t, i), f in sorted(files.items()):
        by[s].append((i, {k: c.most_common(1)[0][0] for k, c in f.items()}))
    for v in by.values():
        for (_, a), (i, b) in zip(v, v[1:]):
            gone, new = sorted(set(a) - set(b)), sorted(set(b) - set(a))
            for g in list(gone):
                m = [n for n in new if group.get(n, n) == group.get(g, g)]
                if m:
                    out.add((i, "renamed", g, m[0]))
                    gone.remove(g)
                    new.remove(m[0])
            out |= {(i, "removed", g, "") for g in gone} | {(i, "added", "", n) for n in new}
            out |= {(i, "retyped", k, k) for k in set(a) & set(b) if a[k] != b[k]}
    return out


def test_against_brute_force(spark, data, clashing):
    for d in (data, data.replace("0.001", "0.01")):
        t = table(spark, d, "raw_records")
        want = brute([r.asDict() for r in t.collect()])
        assert want and {tuple(r) for r in changes(t).collect()} == want
    assert {tuple(r) for r in changes(clashing(t)).collect()} == want


def lines(spark, files):
    rows = []
    for i, (stream, at, payloads) in enumerate(files):
        rows += [(i, stream, n, f"2024-01-01 00:00:{at:02d}", None, p) for n, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, SCHEMA.replace("timestamp_ntz", "string"))
    return df.selectExpr("file_id", "stream", "line_no", "cast(recorded_at AS timestamp_ntz) AS recorded_at", "cast(arrived_at AS timestamp_ntz) AS arrived_at", "payload")


def test_cases(spark):
    df = lines(
        spark,
        [
            ("s", 1, ['{"action": [1], "a": 1}', "", None, '{"broken', "[1]"]),
            ("s", 3, ['{"Action": [[1, 2]], "a": 2.5, "b": null}', '{"a": "x", "Action": [[1, 2]]}', '{"a": 1}']),
            ("s", 2, ['{"actions": [1], "a": null}', '{"actions": null, "a": 3}']),  # between the two
            ("s", 5, ['{"Action": ["1"], "c": {"d": 1}, "odd": [1,2,3]}']),
            ("s", 6, ['{"Action": ["1"], "c": {"d": 1}, "strange": [4,5,6]}']),
            ("t", 1, ['{"x": 1}']),
        ],
    )
    got = {tuple(r) for r in changes(df).collect()}
    assert got == {
        (2, "renamed", "action", "actions"), (1, "renamed", "actions", "Action"),
        (3, "removed", "a", ""), (3, "added", "", "c"), (3, "added", "", "odd"), (3, "retyped", "Action", "Action"),
        (4, "renamed", "odd", "strange"),
    }
    spans = {tuple(r) for r in lifespans(df).collect()}
    assert ("s", "a", "number", 1, 3) in spans and ("s", "Action", "list of texts", 4, 5) in spans


def test_unknown_names_are_renamed_by_shape_and_range(spark):
    """Same number of commas, but other shapes or ranges: no renaming."""
    pairs = [([1, 2, 3], [2.5, 3.5, 1]), ([1, 2, 3], [100, 200, 300]), ([1, 2, 3], [-1, 2, 3]), ([[1, 2], [3, 4]], [1, 2, 3, 4]), ("a,b", "c,d"), ([5.0], {"x": 5.0})]
    df = lines(spark, [(f"s{i}", t, [json.dumps({name: v})]) for i, (a, b) in enumerate(pairs) for t, name, v in ((1, "older", a), (2, "newer", b))])
    got = {tuple(r) for r in changes(df).collect()}
    kept = {i: {k for f, k, *_ in got if f == 2 * i + 1} for i in range(len(pairs))}
    assert kept == {0: {"renamed"}, 1: {"removed", "added"}, 2: {"removed", "added"}, 3: {"removed", "added"}, 4: {"renamed"}, 5: {"removed", "added"}}


def test_changes_are_the_ends_of_lifespans(spark, data):
    t = table(spark, data, "raw_records")
    spans = [tuple(r) for r in lifespans(t).collect()]
    last = {}
    for s, _, _, _, z in spans:
        last[s] = max(last.get(s, 0), z)
    starts = sum(a > 1 for *_, a, _ in spans)
    ends = sum(z < last[s] for s, *_, z in spans)
    n = Counter(r["change_kind"] for r in changes(t).collect())
    assert n["added"] + n["renamed"] + n["retyped"] == starts and n["removed"] + n["renamed"] + n["retyped"] == ends


def test_empty_and_unreadable(spark):
    df = lines(spark, [("s", 1, ["x", None])])
    assert changes(df).count() == 0 and consistent_table(df).count() == 0 and changes(df.limit(0)).count() == 0


def test_consistent_table(spark):
    pose = {"t": [7, 8, 9], "rot": [1, 2, 3, 4, 5, 6, 0, 0, 1]}
    flat = [1, 2, 3, 7, 4, 5, 6, 8, 0, 0, 1, 9, 0, 0, 0, 1]
    k = [5, 0, 2, 0, 6, 3, 0, 0, 1]
    df = lines(
        spark,
        [
            ("s", 1, [json.dumps({"frame_index": 0, "timestamp": "0.5", "Action": pose, "K": {"fx": 5, "fy": 6, "cx": 2, "cy": 3}})] * 2),
            ("s", 2, [json.dumps({"frame_index": 1, "timestamp": 1, "T_w_c": [flat[i : i + 4] for i in (0, 4, 8, 12)], "cam_matrix": [str(x) for x in k], "new": [1]})]),
            ("s", 3, [json.dumps({"frame_index": 2, "action": str(flat), "camera_intrinsic": None})]),
        ],
    )
    rows = sorted(consistent_table(df).collect(), key=lambda r: (r["file_id"], r["line_no"]))
    assert [r["action"] for r in rows] == [[float(x) for x in flat]] * 4
    assert [r["observation.camera_intrinsic"] for r in rows] == [[float(x) for x in k]] * 3 + [None]
    assert [r["timestamp"] for r in rows] == [0.5, 0.5, 1.0, None] and rows[2]["other"] == {"new": "[1]"}
