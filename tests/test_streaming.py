import pytest

from tabloom.plans.trees import fit_class_tree
from tabloom.session import scratch_path
from tabloom.streaming import score_stream
from test_trees import noisy


def test_stream_scores_equal_batch_scores(spark):
    source, sink, checkpoint = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-state"))
    frame = noisy(spark)
    frame.write.parquet(source)
    tree = fit_class_tree(frame, ["a", "b"], "y")
    stream = spark.readStream.schema(frame.schema).parquet(source)
    score_stream(stream, tree, sink, checkpoint).awaitTermination(120)
    written = spark.read.parquet(sink).select("id", "prediction")
    assert written.exceptAll(tree.score(frame).select("id", "prediction")).count() == 0
    assert written.count() == 400


def test_a_batch_table_is_refused(spark):
    with pytest.raises(ValueError):
        score_stream(noisy(spark), None, "x", "y")
