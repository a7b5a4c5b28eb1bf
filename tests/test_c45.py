import math
import random
from collections import Counter

import pytest

from tabloom.plans.c45 import fit_c45_tree


def table(seed=5, n=500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        c, d = rng.choice("uvw"), rng.choice(["k", "l", None])
        x, z = float(rng.randint(0, 20)), rng.choice([None, 0.5, 1.5, 2.5])
        y = int(5 < x < 12) if c != "w" else int((z or 0) > 1)
        rows.append((i, c, d, x, z, y if rng.random() < 0.9 else 1 - y))
    return rows


def entropy(labels):
    return -sum(k / len(labels) * math.log2(k / len(labels)) for k in Counter(labels).values())


def naive(rows, cats, nums, delta, depth, least, heuristic):
    """Paths of rules with sizes and majorities."""
    domains = {c: sorted({r[c] for r in rows if r[c] is not None}) for c in cats}
    out = []

    def gain(groups):
        labels = [r[5] for g in groups for r in g]
        n = len(labels)
        inner = sum(len(g) / n * entropy([r[5] for r in g]) for g in groups)
        worth = -sum(len(g) / n * math.log2(len(g) / n) for g in groups)
        return entropy(labels) - inner, worth

    def grow(here, path, used, level, guess):
        labels = [r[5] for r in here]
        guess = guess if not here else min(Counter(labels).items(), key=lambda x: (-x[1], x[0]))[0]
        out.append((path, guess, len(here)))
        if level == depth or len(set(labels)) < 2:
            return
        options = []
        for c in cats:
            groups = [g for v in domains[c] if (g := [r for r in here if r[c] == v])]
            if c not in used and groups:
                g, iv = gain(groups)
                options.append((c, g, 0 if round(iv, 12) == 0 else g / iv, None))
        for c in nums:
            cuts = []
            values = sorted({r[c] for r in here if r[c] is not None})
            for a, b in zip(values, values[1:]):
                sides = [r for r in here if r[c] is not None and r[c] <= a], [r for r in here if r[c] is not None and r[c] > a]
                if min(map(len, sides)) >= least:
                    g, iv = gain(sides)
                    cuts.append((round(g, 10), -(a + b) / 2, g, iv))
            if cuts:
                _, t, g, iv = max(cuts)
                options.append((c, g, 0 if round(iv, 12) == 0 else g / iv, -t))
        mean = sum(o[1] for o in options) / max(len(options), 1)
        options = [o for o in options if not heuristic or o[1] >= mean - 1e-12]
        if not options:
            return
        c, _, ratio, t = max(options, key=lambda o: (round(o[2], 10), -o[0]))
        if ratio < delta:
            return
        if t is None:
            for v in domains[c]:
                grow([r for r in here if r[c] == v], (*path, (c, "=", v)), used | {c}, level + 1, guess)
        else:
            grow([r for r in here if r[c] is not None and r[c] <= t], (*path, (c, "<=", t)), used, level + 1, guess)
            grow([r for r in here if r[c] is not None and r[c] > t], (*path, (c, ">", t)), used, level + 1, guess)

    grow(rows, (), frozenset(), 0, 0)
    return sorted(out, key=str)


NAMES = {"c": 1, "d": 2, "x": 3, "z": 4}


@pytest.mark.parametrize("heuristic", [True, False])
def test_equals_the_naive_tree(spark, heuristic):
    rows = table()
    frame = spark.createDataFrame(rows, "id long, c string, d string, x double, z double, y int")
    options = dict(delta=0.01, max_depth=4, min_samples_leaf=8, above_average_gain=heuristic)
    tree = fit_c45_tree(frame, ["c", "d"], ["x", "z"], "y", **options)
    paths, found = {None: ()}, []
    for node in tree.nodes:
        paths[node.node_id] = () if node.feature is None else (*paths[node.parent_id], (NAMES[node.feature], node.op, node.value))
        found.append((paths[node.node_id], node.prediction, node.n))
    assert sorted(found, key=str) == naive(rows, [1, 2], [3, 4], 0.01, 4, 8, heuristic)
    used = [[step[0] for step in p] for p in paths.values()]
    assert any(p.count(3) > 1 for p in used) and all(p.count(1) < 2 for p in used)
    wrong = tree.score(frame).where("prediction IS NOT NULL AND prediction <> y").count()
    assert wrong < 90


def test_only_numbers_only_categories_and_bins(spark):
    frame = spark.createDataFrame(table(), "id long, c string, d string, x double, z double, y int")
    assert {n.op for n in fit_c45_tree(frame, [], ["x"], "y").nodes} == {None, "<=", ">"}
    assert {n.op for n in fit_c45_tree(frame, ["c"], [], "y", delta=0.0).nodes} == {None, "="}
    wide = frame.selectExpr("*", "x + id / 1000D AS fine")
    tree = fit_c45_tree(wide, ["c"], ["fine"], "y", max_bins=10, max_depth=3)
    scored = tree.score(wide)
    sizes = {n.node_id: n.n for n in tree.leaves()}
    assert scored.where("prediction IS NOT NULL").count() == sum(sizes.values()) == 500
    with pytest.raises(ValueError, match="no labelled rows"):
        fit_c45_tree(frame.where("false"), ["c"], ["x"], "y")
