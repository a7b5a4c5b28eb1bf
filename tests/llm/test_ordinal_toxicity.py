import os

import numpy as np
import pytest

from tabloom.llm.ordinal_toxicity import fit_ordinal, grade, score_toxicity

BASE = [f"word{i % 7} plain text number{i % 11} here" for i in range(120)]
ROWS = (
    [(t, 0, 1.0) for t in BASE] + [(t + " nasty", 1, 1.0) for t in BASE[:30]] + [(t + " nasty vile", 2, 1.0) for t in BASE[:20]]
)


def test_severity_follows_the_grades():
    model = fit_ordinal(ROWS)
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 2
    clean, mild, severe = model.severities(["plain text here", "nasty text here", "nasty vile text here"])
    assert clean < model.cut <= mild < severe


def test_nothing_to_learn_from():
    assert fit_ordinal([]).severities(["x"]) == [0.0]
    assert fit_ordinal([("a", 0, 1.0)]).severities(["x"]) == [0.0]


def test_grades(spark):
    rows = [(0, 0), (0, 1), (1, 1), (1, 0), (None, 1), (1, None)]
    frame = spark.createDataFrame(rows, "toxic int, quality int")
    assert [r[0] for r in frame.select(grade(frame["toxic"], frame["quality"])).collect()] == [0, 0, 1, 2, None, 2]


def test_awkward_table(spark, awkward, no_documents):
    labels = spark.createDataFrame(
        [(1, 1, 0), (5, 0, 1), (3, 1, 1), (None, 1, 1), (77, 0, 1), (9, None, None)], "doc_id long, quality int, toxic int"
    )
    rows = score_toxicity(spark, awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r["severity"] <= 2 for r in rows)
    assert score_toxicity(spark, no_documents, labels).count() == 0
    assert {r["severity"] for r in score_toxicity(spark, awkward, labels.where("false")).collect()} == {0.0}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="driver tables not present")
def test_held_out_rows(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
    labels = read("labels")
    rows = score_toxicity(spark, read("documents"), labels.where("doc_id % 2 = 0"))
    held = labels.where("doc_id % 2 = 1").select("doc_id", labels["toxic"].alias("truth"))
    pairs = [(r["toxic"], r["truth"] == 1) for r in rows.join(held, "doc_id").collect()]
    hits = sum(a and b for a, b in pairs)
    assert hits / sum(b for _, b in pairs) > 0.7 and hits / sum(a for a, _ in pairs) > 0.85
    assert np.mean([a == b for a, b in pairs]) > 0.95
