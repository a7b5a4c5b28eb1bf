import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from tabloom.llm import merkle_manifest
from tabloom.llm.merkle_manifest import manifest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, more=0):
    doc_id, text, lang, source, n_chars = row
    return h(*map(field, (doc_id, source, lang, n_chars if n_chars is None else n_chars + more, text)))


def grown(digests, arity):
    """The root, and for each leaf its runs: (place in the run, run)."""
    runs = [[] for _ in digests]
    owners = [[i] for i in range(len(digests))]
    while len(digests) > 1:
        cut = range(0, len(digests), arity)
        for i in cut:
            for slot, members in enumerate(owners[i : i + arity]):
                for leaf in members:
                    runs[leaf].append((slot, digests[i : i + arity]))
        owners = [sum(owners[i : i + arity], []) for i in cut]
        digests = [h(*digests[i : i + arity]) for i in cut]
    return digests[0], runs


def brute(rows, arity=2, every=7):
    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append(r)
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    built = {}
    for t in order:
        trees[t].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        built[t] = grown([leaf_of(r) for r in trees[t]], arity)
    root, top = grown([built[t][0] for t in order], arity)
    out = []
    for k, t in enumerate(order):
        for r, runs in zip(trees[t], built[t][1]):
            steps = runs + top[k]
            proof = [d for slot, run in steps for i, d in enumerate(run) if i != slot]
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % every == 0
            folded = leaf_of(r, int(changed))
            for slot, run in steps:
                folded = h(*run[:slot], folded, *run[slot + 1 :])
            out.append((r[0], leaf_of(r), built[t][0], root, h(*proof), folded, folded == root))
    return sorted(out, key=str)


def got(spark, frame, **settings):
    names = "doc_id leaf subroot root proof_sha256 folded_root verified".split()
    return sorted((tuple(r) for r in manifest(spark, frame, **settings).select(*names).collect()), key=str)


def table(n, langs, seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcé 中", k=rng.randint(0, 9)))
    return [(rng.randrange(n), word(), rng.choice(langs), rng.choice([None, "s", "t"]), rng.choice([None, 3, 7])) for _ in range(n)]


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_equals_brute_force(spark, arity):
    rows = table(130, ["de", "en", "en", "en", "en", None, "", "é", "zz"]) + [(9999, "alone", "one", "s", 5)]
    assert got(spark, spark.createDataFrame(rows, COLUMNS).repartition(5), arity=arity) == brute(rows, arity)


def test_joins_by_shuffle_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "SMALL", 3)
    rows = table(75, ["de", "en", None])
    assert got(spark, spark.createDataFrame(rows, COLUMNS)) == brute(rows)


def test_awkward_table(spark, awkward):
    frame = awkward.drop("lang", "n").selectExpr("*", "CAST(NULL AS string) lang", "'s' source", "doc_id n_chars", "1L AS n", "2L AS at", "3L AS size")
    rows = [(r["doc_id"], r["text"], None, "s", r["n_chars"]) for r in frame.collect()]
    assert got(spark, frame) == brute(rows)
    assert got(spark, frame.where("false")) == []


def test_one_row_and_the_largest_counter(spark):
    tampered = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 0)
    rows = [(tampered, "x", "en", "s", 2**63 - 1)]
    found = got(spark, spark.createDataFrame(rows, COLUMNS))
    assert found == brute(rows)
    assert found[0][1] == found[0][2] == found[0][3] and not found[0][-1]


def test_paths_verify_rows(spark):
    rows = table(20, ["a", "b"])
    for r in manifest(spark, spark.createDataFrame(rows, COLUMNS), tamper_every=2**40).collect():
        digest = r["leaf"]
        for s in r["path"]:
            digest = h(bytes(s["before"]).hex(), digest, bytes(s["after"]).hex())
        assert digest == r["root"] and r["verified"]


def test_a_run_has_two_nodes_at_least(spark):
    with pytest.raises(ValueError):
        manifest(spark, spark.createDataFrame([], COLUMNS), arity=1)


def test_no_plan_holds_all_levels(spark, monkeypatch):
    """Levels are not broadcast, and the joins of a plan do not grow with the levels; Spark may broadcast one small table."""
    plans = []
    plain = merkle_manifest.written

    def seen(spark, frame, label):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return plain(spark, frame, label)

    monkeypatch.setattr(merkle_manifest, "written", seen)
    last = manifest(spark, spark.createDataFrame(table(300, ["de", "en", None]), COLUMNS))
    plans.append(last._jdf.queryExecution().executedPlan().toString())
    assert sum("Join" in p for p in plans) > 8
    assert max(p.count("SortMergeJoin") for p in plans) <= merkle_manifest.LEVELS_A_PLAN
    assert max(p.count("BroadcastExchange") for p in plans) <= 1
