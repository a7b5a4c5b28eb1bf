import re

import pytest
from hypothesis import given, settings, strategies as st

from tabloom.llm.deobfuscate import (
    KINDS, all_spans, base_spans, find_personal_data, luhn, mask_documents, masked, rewrites,
)

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    find = lambda pattern, ok: [m.span() for m in re.finditer(pattern, text) if ok(m.group())]
    return {
        "email": find(EMAIL, lambda s: True),
        "ip": find(IP, lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": find(CARD, lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
        "phone": find(PHONE, lambda s: 8 <= len(digits(s)) <= 15),
    }


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1.4@+- ()059%_é\n", max_size=60))
def test_plain_spans_equal_patterns(text):
    assert base_spans(text) == plain(text)


@pytest.mark.parametrize(
    "text, kind, source",
    [
        ("write to john dot doe at mail dot com now", "email", "john dot doe at mail dot com"),
        ("x [at] y (dot) org", "email", "x [at] y (dot) org"),
        ("call plus four nine one two three four five six seven eight", "phone",
         "plus four nine one two three four five six seven eight"),
        ("４１１１ 1111 1111 1111", "card", "４１１１ 1111 1111 1111"),
        ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("one two seven dot zero dot zero dot one", "ip", "one two seven dot zero dot zero dot one"),
        ("1​92.168.0.1", "ip", "1​92.168.0.1"),
    ],
)
def test_disguises_map_back(text, kind, source):
    base, every = all_spans(text)
    start = text.index(source)
    assert (start, start + len(source)) in every[kind]
    assert all(set(base[k]) <= set(every[k]) for k in KINDS)
    assert f"[{kind.upper()}]" in masked(text)


@pytest.mark.parametrize("text", ["I look at the cat. One or two dots.", "un deux trois", "the point at hand", "Über é"])
def test_clean_text_stays(text):
    assert not any(all_spans(text)[1].values()) and masked(text) == text


def test_rewrites_do_not_overlap():
    edits = rewrites("jоhn [at] exаmple (dot) com plus one two three four five six seven eight")
    assert all(a[1] <= b[0] for a, b in zip(edits, edits[1:])) and len(edits) >= 4


def test_long_runs_take_linear_time():
    import time

    started = time.time()
    for text in ("a" * 300_000, "1" * 300_000, "+1" * 100_000, "a." * 100_000, "@" * 100_000, "1." * 100_000,
                 "one " * 50_000, " dot a" * 30_000, "[at]" * 50_000):
        all_spans(text)
    assert time.time() - started < 60


def test_awkward_table(spark, awkward, no_documents):
    rows = find_personal_data(awkward).collect()
    assert len(rows) == awkward.count()
    assert {r["n_email"] for r in rows if r["doc_id"] is None} == {0, 1}
    assert find_personal_data(no_documents).count() == 0
    clean = mask_documents(awkward)
    assert clean.columns == awkward.columns
    assert sorted(r["text"] or "" for r in clean.collect() if r["doc_id"] is None) == ["", "mail [EMAIL] now", "one two three"]


@pytest.mark.parametrize(
    "text, kind, source",
    [
        ("to john [at] example dot com now", "email", "john [at] example dot com"),
        ("to john at example (dot) com now", "email", "john at example (dot) com"),
        ("to john.doe at example.com now", "email", "john.doe at example.com"),
        ("to john＠example dot com now", "email", "john＠example dot com"),
        ("to john at exаmple dot com now", "email", "john at exаmple dot com"),
        ("call +1 555 one two three 4567 now", "phone", "+1 555 one two three 4567"),
        ("call +1 555 one 234 4567 now", "phone", "+1 555 one 234 4567"),
        ("host one two seven (dot) zero dot 0 dot one up", "ip", "one two seven (dot) zero dot 0 dot one"),
    ],
)
def test_mixed_disguises_map_back(text, kind, source):
    start = text.index(source)
    assert (start, start + len(source)) in all_spans(text)[1][kind]
    assert masked(text) == text.replace(source, f"[{kind.upper()}]")


@pytest.mark.parametrize("text", ["It is available at example.com for one or two days.", "2 plus one is 3, at most"])
def test_clean_text_beside_bare_at_stays(text):
    assert masked(text) == text
