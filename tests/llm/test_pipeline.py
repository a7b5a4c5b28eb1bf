import sys
from pathlib import Path

import pytest
from llm.conftest_llm import ascii_lower
from llm.test_curve_packing import check, ids_of
from llm.test_ngram_join import brute, near_copies

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

from tabloom.llm.deobfuscate import masked  # noqa: E402


@pytest.fixture(scope="module")
def folder(tmp_path_factory, spark):
    texts = [t for _, t in near_copies(9, 8, 6, 50, 3)]
    texts += [texts[0].upper(), texts[1], texts[1], "", None, "12 34 !!", texts[2] + " write to a.b@example.com"]
    rows = [(i, t, "en", "s", 1, 5) for i, t in enumerate(texts)] + [(None, "quite alone with words here", None, None, 1, 5)]
    path = tmp_path_factory.mktemp("tables")
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _row long")
    frame.write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == columns
        kept.append(sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str))
    language = [(i, t) for i, t in rows if any(map(str.isalpha, t or ""))]
    assert kept[0] == sorted(language, key=str)
    last = {}
    for i, t in sorted(language, key=lambda x: (x[0] is not None, x[0] or 0)):
        last[ascii_lower(t)] = (i, t)
    assert kept[1] == sorted(last.values(), key=str)
    ids = {c for _, _, c in brute(list(last.values()))}
    assert kept[2] == sorted(((i, t) for i, t in last.values() if i in ids), key=str)
    assert kept[3] == sorted(((i, masked(t)) for i, t in kept[2]), key=str)
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert check(pieces, list(zip([i for i, _ in kept[3]], ids_of([t for _, t in kept[3]])))) == 0


def test_mixed_languages_very_long_texts_and_empty_tables(spark, folder):
    import os

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), folder).count() == 0
    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("driver tables not present")
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    words = {}
    for r in given.where("lang IS NOT NULL AND text IS NOT NULL").limit(400).collect():
        words.setdefault(r["lang"], []).extend(w for w in r["text"].split() if w.isalpha())
    runs = [" ".join(some[i : i + 5]) for i in range(0, 40, 5) for _, some in sorted(words.items())]
    mixed, long = " ".join(runs), " ".join(words["en"] * 40)
    more = spark.createDataFrame([(10**9, mixed), (10**9 + 1, long)], "doc_id long, text string")
    kept = corpus_pipeline.known_language(spark, given.unionByName(more, allowMissingColumns=True), folder)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert {10**9, 10**9 + 1} <= ids
    lettered = {r["doc_id"] for r in given.collect() if any(map(str.isalpha, r["text"] or ""))}
    assert lettered <= ids


def test_stages_are_the_named_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "PII", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
