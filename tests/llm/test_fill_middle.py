import random
import re
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm.fill_middle import RankBits, WaveletMatrix, class_matrix, locate, restored, transform, units_before


def expected(doc_id, text):
    """The contract, unit by unit."""
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text, text
    if h4 % 100 < 20:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def got(frame):
    return sorted((tuple(r) for r in transform(frame).withColumn("restored", restored()).collect()), key=str)


def test_equals_the_contract(spark, awkward, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert got(awkward) == sorted((expected(i, t) for i, t in rows), key=str)
    assert transform(no_documents).count() == 0


def test_random_texts(spark):
    rng = random.Random(2)
    alphabet = "aZz[`{@ \n\t<>PSM019éßК中🎉İK"
    rows = [(i, "".join(rng.choices(alphabet, k=rng.choice((1, 2, 3, 9, 70, 130, 1000))))) for i in range(600)]
    rows += [(600 + i, t) for i, t in enumerate(("a", "ab", "<", "<S", "><", "x<P>y", "<M>", "<P<S<M", "S>P>M>"))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = got(frame)
    assert found == sorted((expected(i, t) for i, t in rows), key=str)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}
    assert all(r[-1] == dict(rows)[r[0]] for r in found)


@pytest.mark.parametrize("size", [0, 1, 63, 64, 65, 1000])
def test_ranks_count(size):
    rng = np.random.default_rng(size)
    bits, symbols = rng.random(size) < 0.4, rng.integers(0, 8, size).astype(np.uint8)
    at = np.arange(size + 1)
    assert RankBits(bits).rank(at).tolist() == [int(bits[:i].sum()) for i in at]
    matrix = WaveletMatrix(symbols, 3)
    for s in range(8):
        assert matrix.rank(s, at).tolist() == [int((symbols[:i] == s).sum()) for i in at]


def test_a_run_ends_with_its_text():
    texts = ["ab", "", "cd e", "f"]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    starts = np.concatenate(([0], ends[:-1]))
    matrix = class_matrix(points, ends)
    assert (units_before(matrix, ends) - units_before(matrix, starts)).tolist() == [1, 0, 3, 1]
    assert locate(matrix, starts, ends, np.array([1, 0, 2, 0])).tolist() == [2, 2, 5, 6]


def test_shares_are_parameters(spark):
    frame = spark.createDataFrame([(i, "some words here") for i in range(50)], "doc_id long, text string")
    forms = lambda **share: {r["form"] for r in transform(frame, **share).collect()}
    assert forms(plain_percent=100) == {"plain"}
    assert forms(plain_percent=0, spm_percent=100) == {"spm"}
    assert forms(plain_percent=0, spm_percent=0) == {"psm"}
    assert transform(frame).where(F.col("output").isNull()).count() == 0
