from helmwake.sources import plugin


def test_own_source(spark, tmp_path, monkeypatch):
    (tmp_path / "my_line_source.py").write_text("class Line:\n    name = 'line'\n    def __init__(self, path): self.path = path\n    def episodes(self): return ['a', 'b']\n    def frames(self, e): return [(self.path + ' ' + e, [i], [1]) for i in range(3 if e == 'a' else 0)]\n")
    spark.sparkContext.addPyFile(str(tmp_path / "my_line_source.py"))
    plugin.register(spark)
    monkeypatch.syspath_prepend(str(tmp_path))
    r = plugin.EpisodeSource({"class": "my_line_source.Line", "path": "p"}).reader(None)
    rows = [x for part in r.partitions() for x in r.read(part)]
    want = [("line", "a", i, "p a", [float(i)], [1.0]) for i in range(3)]
    assert rows == want
    df = spark.read.format("episodes").option("class", "my_line_source.Line").option("path", "p").load()
    assert sorted(map(tuple, df.collect())) == want


def test_generator(spark):
    names = spark.createDataFrame([("a",), ("b",)], "source_episode string")
    got = plugin.from_generator(names, lambda n: [(n, [i], [0]) for i in range(2)]).orderBy("source_episode", "frame_index").collect()
    assert [(r["source_episode"], r["frame_index"], r["task"], r["state"]) for r in got] == [(n, i, n, [float(i)]) for n in "ab" for i in range(2)]
