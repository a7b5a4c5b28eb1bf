import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.conftest_llm import ascii_lower

from tabloom.llm.ngram_join import (
    drop_near_duplicates, may_link, may_link_by_row, near_duplicate_groups, prefix_length, shingles, sketch_of,
)


def grams(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < n else frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def brute(rows, words=5, percent=75):
    sets = [grams(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for g in s for j in holders[g] if j > i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(j)] = root(i)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(rows[i][0])
    least = {r: min((d for d in ids if d is not None), default=None) for r, ids in members.items()}
    return sorted(((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def got(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def near_copies(seed, families, copies, words, edits):
    """Families of edited copies that share a passage with each other."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    passage = [word() for _ in range(30)]
    texts = []
    for _ in range(families):
        base = [word() for _ in range(rng.randint(words // 2, words))] + passage
        for _ in range(rng.randint(1, copies)):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("block", [2, 256])
def test_groups_equal_brute_force(spark, block):
    rows = near_copies(1, 12, 12, 60, 4) + [(1000 + i, t) for i, t in near_copies(2, 4, 30, 25, 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(near_duplicate_groups(spark, frame, block=block)) == brute(rows)


def test_a_region_wider_than_a_block(spark):
    """Documents that share rare passages but differ: new pivots, rings and blocks all have work, links cross them."""
    rng = random.Random(8)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    passage, rows = words(40), []
    for _ in range(40):
        base = words(12)
        texts = [base + passage + words(rng.randint(0, 2)) for _ in range(3)]
        texts.append(base + passage + words(18))
        rows += [" ".join(t) for t in texts]
    for _ in range(30):
        rows.append(" ".join(words(150) + passage))
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(near_duplicate_groups(spark, frame, block=4)) == brute(rows)


def test_a_set_linked_through_its_second_pivot_only(spark):
    """Chains of edited copies: most sets meet several pivots, of which some are too far."""
    rng = random.Random(21)
    rows = []
    for _ in range(25):
        text = [f"t{rng.randrange(10**9)}" for _ in range(60)]
        for _ in range(7):
            at = rng.randrange(len(text) - 2)
            text = text[:at] + [f"t{rng.randrange(10**9)}"] + text[at + rng.randint(0, 1) :]
            rows.append(" ".join(text))
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(near_duplicate_groups(spark, frame)) == brute(rows)


def test_awkward_table(spark, awkward, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    want = [(d, n, d if n == 0 else c) for d, n, c in brute(rows)]
    assert got(near_duplicate_groups(spark, awkward)) == sorted(want, key=str)
    assert near_duplicate_groups(spark, no_documents).count() == 0
    kept = drop_near_duplicates(spark, awkward)
    assert kept.columns == awkward.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in want}


def test_shingles_count_what_python_counts():
    for text in ("", " ", "a b", "a b c d e", "a b c d e f a b c d e f", "É É é A a\x0bB\x1cC d e", "x" * 5000 + " a b c d"):
        assert len(shingles(text)) == len(grams(text))
    assert shingles("A B c d e").tolist() == shingles("a b C D E").tolist()
    assert len(np.intersect1d(shingles("a b c"), shingles("a b c d"))) == 0


def test_sketches_never_part_links():
    rng = np.random.default_rng(3)
    for size in (1, 5, 20, 60, 63, 64, 65, 130, 700, 5000):
        base = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        sets = [base]
        for share in (0.05, 0.14, 0.2, 0.5):
            more = rng.integers(0, 2**64, int(size * share) + 1, dtype=np.uint64)
            sets += [np.unique(np.concatenate((base, more))), np.unique(np.concatenate((base[len(more) :], more)))]
        sizes = np.array([len(s) for s in sets])
        every = np.arange(len(sets))
        sketches = [sketch_of(s) for s in sets]
        may = may_link(sketches, sizes, every, every, 75)
        rows = [(i, j) for i in every for j in every]
        a, b = (np.array(side) for side in zip(*rows))
        by_row = may_link_by_row(sizes[a], [sketches[i] for i in a], sizes[b], [sketches[j] for j in b], 75)
        assert (by_row.reshape(may.shape) == may).all()
        for i in every:
            for j in every:
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 75 * (sizes[i] + sizes[j] - both):
                    assert may[i, j]


def test_prefix_length():
    assert [prefix_length(n) for n in (1, 4, 5, 8, 100)] == [1, 2, 2, 3, 26]


def test_a_row_of_each_group_stays(spark):
    words = lambda name: " ".join(f"{name}{i}" for i in range(40))
    one, two, three = words("one"), words("two"), words("three")
    rows = [(None, one), (None, two), (None, two + " more"), (None, three), (None, three), (7, three + " end")]
    rows += [(5, words("x")), (5, words("y")), (5, words("z")), (6, words("z") + " end"), (None, ""), (None, None), (5, " ")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in drop_near_duplicates(spark, frame).collect()]
    assert sum(t in (two, two + " more") for _, t in kept) == 1
    rest = [(None, one), (7, three + " end"), (5, words("x")), (5, words("y")), (5, words("z"))]
    rest += [(None, ""), (None, None), (5, " ")]
    assert sorted((r for r in kept if "two" not in (r[1] or "")), key=str) == sorted(rest, key=str)
