import numpy as np
import pytest
from llm.test_ngram_join import brute, got, near_copies

from tabloom.llm.minhash_dedup import (
    FUNCTIONS, band_keys, different, different_sql, estimate, minima, most_different, near_duplicates, packed,
)
from tabloom.llm.ngram_join import shingles


def expected(rows):
    found = [(d, n, d if n == 0 else c) for d, n, c in brute(rows, words=4, percent=80)]
    return sorted(((d, n, c, d == c) for d, n, c in found), key=str)


@pytest.mark.parametrize("block", [2, 256])
def test_groups_equal_brute_force(spark, block):
    rows = near_copies(1, 12, 12, 60, 4) + [(1000 + i, t) for i, t in near_copies(2, 4, 30, 25, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(near_duplicates(spark, frame, block=block)) == expected(rows)


def test_awkward_table(spark, awkward, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert got(near_duplicates(spark, awkward)) == expected(rows)
    assert near_duplicates(spark, no_documents).count() == 0


def pair(rng, size, similarity):
    """Two random sets of hashes with about this similarity."""
    both = round(size * 2 * similarity / (1 + similarity))
    base = np.unique(rng.integers(0, 2**64, 2 * size - both, dtype=np.uint64))
    rng.shuffle(base)
    return base[:size], base[size - both :]


def test_estimates_are_unbiased():
    rng = np.random.default_rng(7)
    for similarity in (0.0, 0.3, 0.8, 0.95):
        found = []
        for _ in range(150):
            a, b = pair(rng, 200, similarity)
            found.append(estimate(different(packed(minima(a)), packed(minima(b)))))
        assert abs(np.mean(found) - similarity) < 0.02
    assert estimate(0) == 1


def test_links_meet_in_a_band_and_pass_the_estimate():
    rng = np.random.default_rng(9)
    for size in (9, 18, 45, 306):  # exactly 0.8
        for _ in range(100):
            a, b = pair(rng, size, 0.8)
            one, two = minima(a), minima(b)
            assert (band_keys(one) == band_keys(two)).any()
            assert different(packed(one), packed(two)) <= most_different(80) < FUNCTIONS / 2


def test_bit_counts_are_the_same_in_sql(spark):
    rng = np.random.default_rng(3)
    rows = [(packed(minima(a)), packed(minima(b))) for a, b in (pair(rng, 30, s) for s in (0, 0.2, 0.5, 0.9, 1.0))]
    frame = spark.createDataFrame([(a.tolist(), b.tolist()) for a, b in rows], "a array<long>, b array<long>")
    assert [r[0] for r in frame.select(different_sql("a", "b")).collect()] == [int(different(a, b)) for a, b in rows]


def test_long_sets_are_hashed_whole():
    hashes = shingles(" ".join(f"w{i}" for i in range(5000)), 4)
    assert (minima(hashes) == np.minimum(minima(hashes[:2500]), minima(hashes[2500:]))).all()
