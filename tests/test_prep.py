import pytest
from pyspark.sql import functions as F

from tabloom.functions import encode, half_even, nan_to_null
from tabloom.operators import folds, stats
from tabloom.session import scratch_path
from tabloom.sources import tables


def test_bins_close_on_the_right(spark):
    frame = spark.createDataFrame([(7.0,), (7.01,), (80.0,), (512.3,), (None,)], "v double")
    assert [r[0] for r in frame.select(encode.bin_upper(F.col("v"), [7, 15, 32, 50, 80])).collect()] == [1, 2, 5, 6, None]


def test_half_even_matches_numpy(spark):
    import numpy as np

    values = [0.00005, 0.00015, 2.5, -1.00025, 6.94505, 123456.00005]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in frame.select(half_even(F.col("v"), 4)).collect()] == list(np.round(values, 4))


def test_one_hot_uses_the_training_domain(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    encoder = encode.fit_one_hot(train, ["c"])
    assert encoder.new_columns() == ["c_a", "c_b", "c_nan"]
    test = spark.createDataFrame([(9, "z")], "id int, c string")
    assert encoder.apply(test).columns == ["id", "c_a", "c_b", "c_nan"]
    assert tuple(encoder.apply(test).first()) == (9, 0, 0, 0)
    assert tuple(encoder.apply(train).orderBy("id").collect()[2]) == (3, 0, 0, 1)


def test_fill_rules(spark):
    frame = spark.createDataFrame([(1, "x", None), (None, "y", 2.0), (4, "y", 4.0), (None, None, None)], "a int, b string, c double")
    filled = encode.fit_fill(frame, {"a": 0, "b": "mode", "c": "mean"}).apply(frame)
    assert [tuple(r) for r in filled.collect()] == [(1, "x", 3.0), (0, "y", 2.0), (4, "y", 4.0), (0, "y", 3.0)]


def test_scaler_centres_a_constant_column(spark):
    frame = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaled = encode.fit_scaler(frame, ["a", "b"]).apply(frame).collect()
    assert [tuple(r) for r in scaled] == [(-1.0, 0.0), (1.0, 0.0)]


def test_large_label_domains_are_ranked_by_parts(spark):
    frame = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("value"))
    small = {r["value"]: r["code"] for r in encode.label_codes([frame, frame], "value").collect()}
    parts = {r["value"]: r["code"] for r in encode.ranked_by_parts(frame.distinct(), "value", "code").collect()}
    assert parts == small and sorted(small.values()) == list(range(500))


def test_nan_becomes_null(spark):
    frame = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "a double, b int")
    assert [r["a"] for r in nan_to_null(frame).collect()] == [None, 2.0]


def test_csv_keeps_names_and_values(spark):
    path = scratch_path(spark, "test-csv")
    tables.write_csv(spark.createDataFrame([(1, "a b", 2.5), (2, None, None)], "k int, s string, v double"), path)
    back = tables.read_csv(spark, path)
    assert back.columns == ["k", "s", "v"]
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a b", 2.5), (2, None, None)]


def test_constant_columns_go_and_the_label_stays(spark):
    frame = spark.createDataFrame([(1, 7, None, 0), (2, 7, "x", 0)], "a int, b int, c string, y int")
    assert stats.drop_constant(frame, "y").columns == ["a", "c", "y"]


def test_rule_text_round_trip(spark):
    frame = spark.createDataFrame([("rm", "<=", 6.945), ("a b", ">", 1.0)], "f string, op string, v double")
    rule = encode.build_rule(F.col("f"), F.col("op"), F.col("v"))
    parts = encode.parse_rule(F.col("rule"))
    back = frame.select("*", rule.alias("rule")).select("f", "op", "v", *[p.alias(f"p{i}") for i, p in enumerate(parts)])
    for r in back.collect():
        assert (r["f"], r["op"], r["v"]) == (r["p0"], r["p1"], float(r["p2"]))


def test_submission_keeps_the_sample_keys(spark):
    sample = spark.createDataFrame([(1, 22.7), (2, 22.7)], "ID int, medv double")
    scored = spark.createDataFrame([(2, 5.0), (3, 6.0)], "ID int, p double")
    filled = tables.fill_submission(sample, "ID", "medv", scored, "p")
    assert sorted((r["ID"], r["medv"]) for r in filled.collect()) == [(1, None), (2, 5.0)]


def test_stratified_folds_are_even_within_a_class(spark):
    frame = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    sizes = folds.stratified_folds(frame, "k", "y", 4).groupBy("y", "fold").count().collect()
    for label, total in ((0, 900), (1, 100)):
        counts = [r["count"] for r in sizes if r["y"] == label]
        assert sum(counts) == total and max(counts) - min(counts) <= 1


def test_holdout_depends_on_the_key_alone(spark):
    one = spark.range(0, 2000, 1, 1).select("id", folds.in_holdout(F.col("id"), 0.4).alias("t"))
    many = spark.range(0, 2000, 1, 9).select("id", folds.in_holdout(F.col("id"), 0.4).alias("t"))
    assert one.exceptAll(many).count() == 0
    assert one.filter("t").count() == pytest.approx(800, abs=80)
