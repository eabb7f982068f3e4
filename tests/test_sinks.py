"""Sinks write to the session's shared checkpoint folder and read back."""

from shelfscope.sources import sinks as S


def test_feature_store_roundtrip(spark):
    fs = S.FeatureStore(spark, S.shared_root(spark, "test-features"))
    df = spark.createDataFrame([(1, 2.0), (2, 3.5)], "k long, x double")
    fs.save("t1", df)
    fs.save("t2", df.where("k = 1"))
    assert sorted(r["k"] for r in fs.load("t1").collect()) == [1, 2]
    man = {r["name"]: (r["n_rows"], r["n_columns"]) for r in fs.manifest().collect()}
    assert man == {"t1": (2, 2), "t2": (1, 2)}


def test_lineage_records_and_json_sink(spark):
    t = {"a": spark.createDataFrame([(1,), (2,)], "x int"), "b": spark.createDataFrame([(1, "z")], "x int, y string")}
    path = S.write_json(S.lineage_records(t, {"a": "src/a", "b": "src/b"}, "v1"), S.shared_root(spark, "test-lineage"))
    rows = {r["table_name"]: r for r in spark.read.json(path).collect()}
    assert (rows["a"]["n_rows"], rows["a"]["n_columns"], rows["b"]["n_columns"]) == (2, 1, 2)
    assert rows["a"]["source"] == "src/a" and rows["b"]["version"] == "v1"
