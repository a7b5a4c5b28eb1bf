"""Byte-level BPE with a sentencepiece model that is written straight from a rank vocabulary.

Each byte stands as one character (its value above ``FIRST``), each token as a piece of such characters with its negative
rank as score, so the piece that sentencepiece merges first is the one of lowest rank. The model has no normalisation
and no dummy prefix. Texts are split by the vocabulary's pattern, each match is encoded by itself, and ids are decoded
through the pieces. Nothing is trained.

Defined cases: a null text is empty and has no ids; null doc_ids pass through; repeated rows each return a row; an empty
table gives an empty result; other columns are ignored; special tokens in a text are ordinary text.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2 as proto

from tabloom.llm.common import batch_of, slices, texts_of

FIRST = 0x4E00
TO_CHARACTERS = [chr(FIRST + b) for b in range(256)]
BETWEEN = chr(256)  # no byte stands as this
CHARACTERS = "".join(TO_CHARACTERS) + BETWEEN
MOST_KNOWN = 1_000_000  # spellings a worker remembers before it starts anew; bounds memory, not results
SPACED = regex.compile(r" \s| $")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The vocabulary as a sentencepiece BPE model whose ids are the ranks; the unknown piece comes last."""
    model = proto.ModelProto()
    by_rank = {rank: token for token, rank in ranks.items()}
    for rank in range(max(by_rank) + 1):
        piece = model.pieces.add()
        if rank in by_rank:
            piece.piece = "".join(TO_CHARACTERS[b] for b in by_rank[rank])
            piece.score = -float(rank)
        else:  # a gap in the ranks is a piece that never matches
            piece.piece, piece.type = f"<gap{rank}>", proto.ModelProto.SentencePiece.UNUSED
    unknown = model.pieces.add()
    unknown.piece, unknown.type = "<unk>", proto.ModelProto.SentencePiece.UNKNOWN
    model.trainer_spec.model_type = proto.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(model.pieces)
    model.trainer_spec.unk_id = len(model.pieces) - 1
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encode texts to little-endian 32-bit ids and back, with the model of ``sentencepiece_model``."""

    def __init__(self, model: bytes, pattern: str):
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pattern = regex.compile(pattern)
        unknown = self.pieces.unk_id()
        self.bytes_of = [
            b"" if i == unknown or self.pieces.is_unused(i)
            else bytes(ord(c) - FIRST for c in self.pieces.id_to_piece(i))
            for i in range(self.pieces.get_piece_size())
        ]
        self.whole = {token: i for i, token in enumerate(self.bytes_of) if token}
        self.known: dict[str, bytes] = {}  # ids of a run of text between two blanks, or of one match

    def _learn(self, runs: list[str]) -> None:
        """Ids of runs that were not met before; every match of the pattern is encoded once, by itself."""
        known = self.known
        # a blank and letters only, or letters only, are one match
        matches = [[run] if (run[1:] if run[:1] == " " else run).isalpha() else self.pattern.findall(run) for run in runs]
        merged = []
        for match in {m for some in matches for m in some}:
            if match not in known:
                data = match.encode()
                if data in self.whole:  # a token as it stands needs no merges
                    known[match] = pack("<I", self.whole[data])
                else:
                    merged.append((match, data.decode("latin-1")))
        spelled = BETWEEN.join(s for _, s in merged).translate(CHARACTERS).split(BETWEEN)
        for (match, _), ids in zip(merged, self.pieces.encode(spelled, num_threads=1), strict=False):
            known[match] = pack(f"<{len(ids)}I", *ids)
        for run, some in zip(runs, matches, strict=True):
            if len(some) != 1:
                known[run] = b"".join([known[m] for m in some])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Blanks before a character that isn't white space always begin a match, so runs are independent."""
        split = []
        for text in texts:
            if SPACED.search(text):
                split.append([text])  # blanks in a row: such a text is one run
            else:
                first, *rest = text.split(" ")
                split.append([first, *[" " + r for r in rest]])
        if len(self.known) > MOST_KNOWN:
            self.known.clear()
        self._learn(list(set().union(*split).difference(self.known)))
        return [b"".join(map(self.known.__getitem__, runs)) for runs in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def codec(model: bytes, pattern: str) -> Codec:
    return Codec(model, pattern)


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
)


def encode_decode(
    documents: DataFrame, vocabulary: str | None = None, pattern: str | None = None,
    id_column="doc_id", text_column="text",
) -> DataFrame:
    """One row per document: number of ids, digest of the ids, digest of the decoded bytes."""
    model = sentencepiece_model(read_ranks(vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")))
    pattern = pattern or public_tokenizers.PATTERN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = codec(model, pattern)
        for batch in slices(batches, 1, 2_000_000):
            ids = both.encode_batch(batch.column(1).to_pylist())
            yield batch_of(
                RESULT, batch.column(0), [len(x) // 4 for x in ids], [sha256(x).hexdigest() for x in ids],
                [sha256(both.decode(x)).hexdigest() for x in ids],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts_of(documents, id_column, text_column).mapInArrow(run, schema)
