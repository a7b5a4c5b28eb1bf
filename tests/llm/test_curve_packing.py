import tracemalloc
from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tabloom.llm.curve_packing import SEQUENCE, hilbert, merge_ranks, pack_documents, range_partitions, runs_of


def ids_of(texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    return [e.ids + [0] for e in library.encode_batch(texts, add_special_tokens=False)]


def check(pieces, documents):
    """Every id lies in one piece, sequences are gapless and of the right length; returns the share of padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"], p["doc_tokens"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    assert sum(p["length"] for p in pieces) == sum(len(ids) for _, ids in documents)
    want = sorted((str(d), len(ids)) for d, ids in documents)
    begun = sorted((str(p["doc_id"]), p["doc_tokens"]) for p in pieces if p["start"] == 0)
    assert begun == want
    checks = defaultdict(set)
    for d, ids in documents:
        for p in by_doc[d, len(ids)]:
            part = np.array(ids[p["start"] : p["start"] + p["length"]], "<u4").tobytes()
            checks[id(p)].add(crc32(part))
    assert all(p["ids_crc32"] in checks[id(p)] for p in pieces)
    padding = total = 0
    for some in by_sequence.values():
        at = 0
        for p in sorted(some, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= SEQUENCE
        padding += 0 if at & (at - 1) == 0 else SEQUENCE - at
        total += at
    return padding / max(total, 1)


def test_runs_equal_the_library():
    texts = ["", " ", "a  b c", "x \n y", "The  end. ", "é ü 日本 🎉", "don't stop 123", "tail ", " lead", "a" * 3000]
    runs = runs_of(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    got = [np.frombuffer(x, runs.kind).tolist() + [0] for x in runs.encode_batch(texts + texts)]
    assert got == ids_of(texts + texts)
    assert len(merge_ranks(public_tokenizers.path("byte_bpe_50k.json"))) == 50256


def test_nothing_is_remembered_of_texts():
    runs = runs_of(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    runs.encode_batch(["one two"])
    tracemalloc.start()
    try:
        for start in range(0, 40_000, 4_000):
            runs.encode_batch([" ".join(f"word{i}" for i in range(start, start + 4_000))])
        assert tracemalloc.get_traced_memory()[0] < 1_000_000
    finally:
        tracemalloc.stop()


def test_hilbert_visits_every_cell_by_unit_steps():
    for dimensions, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
        key = hilbert(grid, bits)
        assert sorted(key.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_pieces_of_awkward_table(spark, awkward, no_documents):
    rows = awkward.collect()
    documents = list(zip([r["doc_id"] for r in rows], ids_of([r["text"] or "" for r in rows])))
    assert check(pack_documents(spark, awkward).collect(), documents) == 0
    assert pack_documents(spark, no_documents).count() == 0


def test_many_partitions_and_neighbours(spark, monkeypatch):
    from tabloom.llm import curve_packing

    monkeypatch.setattr(curve_packing, "PARTITION_BYTES", 2000)
    texts = [f"alpha beta gamma delta {i} " * (i % 40 + 1) if i % 2 else f"uno dos tres cuatro {i} " * (i % 30 + 1) for i in range(200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = pack_documents(spark, frame).collect()
    assert check(pieces, list(zip(range(200), ids_of(texts)))) == 0
    assert len({p["sequence_id"] >> 36 for p in pieces}) > 5


def test_partitions_grow_with_the_total():
    assert [range_partitions(n) for n in (0, 1, 16_000_000, 16_000_001, 10**9)] == [1, 1, 1, 2, 63]
    assert range_partitions(10**12) == 20_000 and range_partitions(5 * 10**13) == 195_313
