import os
from itertools import product
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from tabloom.llm import crf_language
from tabloom.llm.common import slices
from tabloom.llm.crf_language import (
    UNKNOWN, features, fit_field, forward_backward, keep_known_languages, letters, predict_languages,
)

SAMPLES = [(t, "xx") for t in ("kata wira soka lani mera", "wira lani kata", "soka mera wira kata")] + [
    (t, "yy") for t in ("strümpf ächz stolz krass", "krass stolz brumm", "brumm ächz strümpf stolz")
]


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    emissions, transitions = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3))
    valid = np.array([[True] * 4, [True, True, False, False]])
    marginals, expected = forward_backward(emissions, valid, transitions)
    want_transitions = np.zeros((3, 3))
    for row, size in enumerate(valid.sum(1)):
        want, total = np.zeros((size, 3)), 0.0
        pairs = np.zeros((3, 3))
        for path in product(range(3), repeat=int(size)):
            weight = np.exp(sum(emissions[row, t, y] for t, y in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:])))
            total += weight
            for t, y in enumerate(path):
                want[t, y] += weight
            for a, b in zip(path, path[1:]):
                pairs[a, b] += weight
        assert np.allclose(marginals[row, :size], want / total)
        want_transitions += pairs / total
    assert np.allclose(expected, want_transitions)


def test_words_of_switched_text_get_their_own_language():
    model = fit_field(SAMPLES * 10)
    probabilities, _ = model.word_probabilities(["kata wira lani soka krass stolz brumm ächz"])
    assert [model.labels[i] for i in probabilities.argmax(1)] == ["xx"] * 4 + ["yy"] * 4
    assert model.predict(["", "12 !!", "wira soka"]) [0] == [UNKNOWN, UNKNOWN, "xx"]
    assert fit_field([]).predict(["wira"]) == ([UNKNOWN], [0.0])


def test_a_long_text_is_one_chain():
    """Spans with messages against the same words as one long sequence, which the enumeration above vouches for."""
    rng = np.random.default_rng(4)
    model = fit_field(SAMPLES * 10)
    model.transitions = rng.normal(size=(2, 2)) * 2
    spellings = [w for t, _ in SAMPLES for w in t.split()] + ["lukra", "x", "ächa"]
    texts = [" ".join(rng.choice(spellings, n)) for n in (150, 1, 32, 33, 0, 64, 1000, 31)]
    found, owner = model.word_probabilities(texts)
    for i, text in enumerate(texts):
        words = text.split()
        if words:
            emissions = model.emissions([letters(w) for w in words])[None]
            whole, _ = forward_backward(emissions, np.ones((1, len(words)), bool), model.transitions)
            assert np.allclose(found[owner == i], whole[0], atol=1e-12)


def test_certainty_of_mixed_text():
    model = fit_field(SAMPLES * 10)
    names, scores, certain = model.judge(["kata wira lani soka krass stolz brumm ächz", ""])
    assert scores[0] < 0.7 < certain[0] and certain[1] == 0 and names[1] == UNKNOWN


def test_features_of_a_word_do_not_depend_on_others():
    alone, _ = features(["wira"])
    together, starts = features(["x", "wira", "strümpf"])
    assert together[starts[1] : starts[2]].tolist() == alone.tolist()
    assert letters("Don't!") == "dont" and letters("42%") == ""


def test_awkward_table(spark, awkward, no_documents):
    rows = predict_languages(spark, awkward).collect()
    assert len(rows) == awkward.count() and {r["lang_pred"] for r in rows} == {UNKNOWN}
    assert predict_languages(spark, no_documents).count() == 0
    taught = awkward.unionByName(
        spark.createDataFrame([(100 + i, t, l) for i, (t, l) in enumerate(SAMPLES * 4)], "doc_id long, text string, lang string"),
        allowMissingColumns=True,
    )
    rows = predict_languages(spark, taught).collect()
    assert all(r["held_out"] == (r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    texts = {r["doc_id"]: r["text"] for r in taught.collect() if r["doc_id"] is not None}
    for r in rows:
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == UNKNOWN) == (not any(map(str.isalpha, texts[r["doc_id"]] or "")))
    kept = keep_known_languages(spark, taught, 0.0)
    assert kept.columns == taught.columns
    assert kept.count() == sum(any(map(str.isalpha, r["text"] or "")) for r in taught.collect())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="driver tables not present")
def test_held_out_accuracy(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    rows = [r for r in predict_languages(spark, documents).collect() if r["held_out"]]
    assert len(rows) > 200
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in rows]) > 0.98


def test_new_words_are_worked_on_in_bounded_groups(monkeypatch):
    """The rows of words do not depend on the words beside them, and no group is larger than the bound."""
    words = [f"w{'aeiou'[i % 5] * (i % 7 + 1)}{chr(97 + i % 26)}" for i in range(100)]
    weights = np.random.default_rng(1).standard_normal((1 << crf_language.BITS, 3))
    model = crf_language.Field(["a", "b", "c"], weights, np.zeros((3, 3)))
    whole, sizes, plain = model.emissions(words), [], crf_language.features
    monkeypatch.setattr(crf_language, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(crf_language, "features", lambda some: sizes.append(len(some)) or plain(some))
    assert (model.emissions(words) == whole).all()
    assert max(sizes) <= 7 and sum(sizes) == len(words)


def test_slices_are_small_and_lose_no_row():
    texts = ["x" * 300_000] * 20 + [None, "", "y" * 3_000_000]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    found = list(slices(iter([batch]), 0))
    assert [t for b in found for t in b.column(0).to_pylist()] == texts
    assert max(sum(len(t or "") for t in b.column(0).to_pylist()) for b in found if b.num_rows > 1) <= 1_000_000
