import hashlib
from collections import defaultdict

from llm.conftest_llm import ascii_lower

from tabloom.llm.exact_dedup import LARGEST, SMALLEST, cuts, drop_copies, exact_groups


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[ascii_lower(text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for i in sorted(ids, key=lambda x: (x is None, x)):
            kept = i == keep and first
            first = first and not kept
            out.append((i, keep, len(ids), kept, digest))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted((tuple(r)[:5] for r in frame.collect()), key=str)


def test_groups_equal_brute_force(spark, awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert rows_of(exact_groups(spark, awkward)) == brute(rows)


def test_empty_table(spark, no_documents):
    assert exact_groups(spark, no_documents).count() == 0
    assert drop_copies(spark, no_documents).columns == no_documents.columns


def test_cuts_follow_content():
    import random

    random.seed(1)
    data = bytes(random.randrange(97, 123) for _ in range(300_000))
    ends = cuts(data)
    assert ends[-1] == len(data) and all(0 < b - a <= LARGEST for a, b in zip([0, *ends], ends))
    assert len(ends) > 30
    chunks = {data[a:b] for a, b in zip([0, *ends], ends)}
    moved = b"x" * 77 + data
    again = {moved[a:b] for a, b in zip([0, *cuts(moved)], cuts(moved))}
    assert len(chunks & again) > 0.9 * len(chunks)
    assert cuts(b"") == [0] and cuts(b"a" * SMALLEST) == [SMALLEST]


def test_drop_copies_keeps_all_columns(spark, awkward):
    kept = drop_copies(spark, awkward)
    assert kept.columns == awkward.columns
    want = {(i, d) for i, _, _, k, d in brute([(r["doc_id"], r["text"]) for r in awkward.collect()]) if k}
    got = [(r["doc_id"], hashlib.sha256(ascii_lower(r["text"] or "").encode()).hexdigest()) for r in kept.collect()]
    assert len(got) == len(set(got)) and set(got) == want
