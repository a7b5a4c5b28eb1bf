"""Fill-in-middle transformation with cuts found by a wavelet matrix over character classes.

A unit is a run of A-Z and a-z, or one other code point. Every code point is of one of three classes: a letter with a
letter after it, the last letter of a run, anything else. The classes of all texts of a batch, one after another, are
one wavelet matrix; the ranks of the last two classes add up to the number of units that end before a position. A cut
after so many units of a text is found by bisection on these ranks, for all texts of the batch at once, so no list of
units is ever made. The work is one pass over the texts without a shuffle.

Defined cases: a null text is empty and stays plain, as does one that holds a marker; a null doc_id hashes as if it had
no digits; repeated rows each return a row; a very long text is one row of a batch of its own, at some twenty bytes a
code point while it is cut; an empty table gives an empty result; columns other than the two named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.common import batch_of, slices, texts_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1:"
PLAIN_PERCENT, SPM_PERCENT = 10, 20
WITHIN, LAST, OTHER = 0, 1, 2  # classes of code points
CLASS_BITS = 2
FORMS = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
FORMS_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
     ("middle_chars", pa.int64()), ("output", pa.string())]
)


class RankBits:
    """Bits in words, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
        packed[: -(-len(bits) // 8)] = np.packbits(bits, bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def rank(self, positions):
        """Ones before each position."""
        word, bit = positions >> 6, (positions & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)


class WaveletMatrix:
    """Bit planes of a sequence, the highest first; below each plane its zeros come first, then its ones."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.planes = []
        for level in reversed(range(bits)):
            ones = (symbols >> level & 1).astype(bool)
            self.planes.append((level, RankBits(ones), len(ones) - int(ones.sum())))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def rank(self, symbol: int, positions: np.ndarray) -> np.ndarray:
        """How often the symbol occurs before each position."""
        ends = np.concatenate(([0], positions))
        for level, plane, zeros in self.planes:
            ones = plane.rank(ends)
            ends = zeros + ones if symbol >> level & 1 else ends - ones
        return ends[1:] - ends[0]


def class_matrix(points: np.ndarray, ends: np.ndarray) -> WaveletMatrix:
    """The matrix of the classes of code points; texts end at ``ends``."""
    folded = points | 32  # the two cases of a letter differ in this bit
    letter = (folded >= 97) & (folded <= 122)
    goes_on = np.zeros(len(points), bool)
    goes_on[:-1] = letter[1:]
    goes_on[ends[ends > 0] - 1] = False
    classes = np.where(letter, np.where(goes_on, WITHIN, LAST), OTHER).astype(np.uint8)
    return WaveletMatrix(classes, CLASS_BITS)


def units_before(matrix: WaveletMatrix, positions: np.ndarray) -> np.ndarray:
    """Units that end before each position."""
    return matrix.rank(LAST, positions) + matrix.rank(OTHER, positions)


def locate(matrix: WaveletMatrix, starts: np.ndarray, ends: np.ndarray, units: np.ndarray) -> np.ndarray:
    """The first position from each start with so many units since it, by bisection on ranks."""
    wanted = units_before(matrix, starts) + units
    low, high = starts.copy(), ends.copy()
    while (low < high).any():
        middle = (low + high) // 2
        short = (units_before(matrix, middle) < wanted) & (low < high)
        low, high = np.where(short, middle + 1, low), np.where(short, high, middle)
    return low


def draws(doc_id: int | None, seed: str) -> tuple[int, int, int, int]:
    digest = sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def _rows_of(seed: str, plain_percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            starts = np.concatenate(([0], ends[:-1]))
            matrix = class_matrix(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), ends)
            n = units_before(matrix, ends) - units_before(matrix, starts)
            drawn = np.array([draws(i, seed) for i in ids], np.int64).reshape(-1, 4)
            cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
            first = (locate(matrix, starts, ends, cuts[:, 0]) - starts).tolist()
            second = (locate(matrix, starts, ends, cuts[:, 1]) - starts).tolist()
            forms, prefixes, middles, outputs = [], [], [], []
            for text, a, b, (_, _, h3, h4) in zip(texts, first, second, drawn.tolist(), strict=True):
                if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= 100 - plain_percent:
                    row = "plain", None, None, text
                elif h4 % 100 < spm_percent:
                    row = "spm", a, b - a, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"
                else:
                    row = "psm", a, b - a, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"
                for column, value in zip((forms, prefixes, middles, outputs), row, strict=True):
                    column.append(value)
            yield batch_of(FORMS_ARROW, batch.column(0), n.tolist(), forms, prefixes, middles, outputs)

    return run


def transform(
    documents: DataFrame, id_column="doc_id", text_column="text", seed: str = SEED,
    plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document."""
    rows = texts_of(documents, id_column, text_column)
    return rows.mapInArrow(_rows_of(seed, plain_percent, spm_percent), FORMS)


def restored(form: str = "form", output: str = "output") -> Column:
    """The text that an output of a form was made from; parts of a text hold no marker, so each is found once."""
    out = F.col(output)
    before = lambda text, mark: F.substring_index(text, mark, 1)
    after = lambda text, mark: F.substring_index(text, mark, -1)
    middle, outer = after(out, MIDDLE), before(out, MIDDLE)
    return (
        F.when(F.col(form) == "psm", F.concat(after(before(outer, SUFFIX), PREFIX), middle, after(outer, SUFFIX)))
        .when(F.col(form) == "spm", F.concat(after(outer, PREFIX), middle, after(before(outer, PREFIX), SUFFIX)))
        .otherwise(out)
    )
