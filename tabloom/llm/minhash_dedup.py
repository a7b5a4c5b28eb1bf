"""Near-duplicate groups by b-bit MinHash.

A document is its set of word 4-grams. Its minima under 128 hash functions are made once. Runs of four whole minima are
its 32 bands, which find the candidates: two sets at the threshold of 0.8 miss each other in all bands once in
twenty million times, closer ones less often. Of the minima only the lowest two bits are kept, packed into four words. The
share of equal bit pairs, corrected for the quarter that is equal by chance, estimates the similarity, by XOR and bit
counts. Candidates whose estimate is six standard deviations below the threshold are dropped; all others are confirmed
on their full sets of 64-bit hashes, so every link is exact.

The least set of a band is the pivot of all sets that share it, so a large group is compared with one set and not with
itself. Pivots, connected components and the blocks for what pivots leave open are those of the module for the join in
metric space, with estimates from bits in place of its sketches. Equal sets are one class from the start.

Defined cases: a null or blank text has the empty set and is a group of its own; null doc_ids take part, and a group
gets its smallest doc_id that isn't null (null if there is none, and its rows are kept then); repeated rows each return
a row; a text of any length is hashed whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.llm.common import batch_of, slices, texts_of, written
from tabloom.llm.ngram_join import BLOCK, as_class, linked_regions, mix, sets_of, shingles, signature

WORDS = 4
PERCENT = 80  # two sets link when 100 * intersection >= PERCENT * union
FUNCTIONS, BAND_ROWS, BITS = 128, 4, 2
DEVIATIONS = 6
HASHES_AT_ONCE = 1024

_random = np.random.default_rng(13)
FACTORS = (_random.integers(0, 2**64, FUNCTIONS, dtype=np.uint64) | np.uint64(1))[:, None]
BAND_FACTORS = _random.integers(0, 2**64, (FUNCTIONS // BAND_ROWS, BAND_ROWS), dtype=np.uint64) | np.uint64(1)
LANES = 64 // BITS  # kept minima in a word
LOWEST = np.uint64(sum(1 << (BITS * i) for i in range(LANES)))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least hash of a set under every function."""
    least = np.full(FUNCTIONS, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        np.minimum(least, (hashes[None, at : at + HASHES_AT_ONCE] * FACTORS).min(1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    """A key for each band from its whole minima and its number."""
    runs = mix(least).reshape(BAND_FACTORS.shape) * BAND_FACTORS
    return mix(runs.sum(1) + np.arange(len(runs), dtype=np.uint64)).view(np.int64)


def packed(least: np.ndarray) -> np.ndarray:
    """The lowest bits of the minima, side by side in words."""
    low = (mix(least) & np.uint64(2**BITS - 1)).reshape(-1, LANES)
    return (low << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS))).sum(1, dtype=np.uint64).view(np.int64)


def different(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the kept minima differ, for words along the last axis."""
    apart = a.view(np.uint64) ^ b.view(np.uint64)
    step = 1
    while step < BITS:
        apart = apart | (apart >> np.uint64(step))
        step *= 2
    return np.bitwise_count(apart & LOWEST).sum(-1, dtype=np.int64)


def different_sql(a: str, b: str) -> Column:
    """The same on two columns of words."""
    lowest = F.lit(int(LOWEST.astype(np.int64)))

    def one(i: int) -> Column:
        apart = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        step = 1
        while step < BITS:
            apart = apart.bitwiseOR(F.shiftrightunsigned(apart, step))
            step *= 2
        return F.bit_count(apart.bitwiseAND(lowest))

    return sum((one(i) for i in range(1, FUNCTIONS // LANES)), one(0))


def estimate(n_different):
    """The similarity that so many different minima speak for: chance makes 2 ** -BITS of the others equal."""
    by_chance = 2.0**-BITS
    return ((1 - n_different / FUNCTIONS) - by_chance) / (1 - by_chance)


def most_different(percent: int) -> int:
    """So many minima of two sets at the threshold may differ, ``DEVIATIONS`` standard deviations included."""
    by_chance = 2.0**-BITS
    equal = by_chance + (1 - by_chance) * percent / 100
    return int(FUNCTIONS * (1 - equal + DEVIATIONS * sqrt(equal * (1 - equal) / FUNCTIONS)))


SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary()), ("cls", pa.int64()),
     ("bits", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))]
)
SIGNED_SQL = "doc_id long, n long, sig binary, cls long, bits array<long>, bands array<long>"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document; bits and bands once for each set of a task."""
    seen = set()
    for batch in slices(batches, 1):
        sizes, sigs, bits, bands = [], [], [], []
        for text in batch.column(1).to_pylist():
            hashes = shingles(text, WORDS)
            sig = signature(hashes) if len(hashes) else None
            fresh = sig is not None and sig not in seen
            seen.add(sig)
            least = minima(hashes) if fresh else None
            sizes.append(len(hashes))
            sigs.append(sig)
            bits.append(packed(least) if fresh else None)
            bands.append(band_keys(least) if fresh else None)
        yield batch_of(SIGNED, batch.column(0), sizes, sigs, [s and as_class(s) for s in sigs], bits, bands)


def candidates(signed: DataFrame) -> DataFrame:
    """(cls, pivot): every set with the least set of each of its bands, where they differ."""
    entries = signed.where("bands IS NOT NULL").select("cls", F.explode("bands").alias("band"))
    pivots = entries.groupBy("band").agg(F.min("cls").alias("pivot"), F.max("cls").alias("last"))
    pivots = pivots.where("pivot <> last").select("band", "pivot")
    return entries.join(pivots, "band").where("cls <> pivot").select("cls", "pivot").distinct()


def _by_bits(percent: int):
    most = most_different(percent)

    def may(rows: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        words = np.array(rows.column("bits").to_pylist(), np.int64)
        out = np.zeros((len(left), len(right)), bool)
        for at in range(0, len(left), 256):
            out[at : at + 256] = different(words[left[at : at + 256], None], words[right][None]) <= most
        return out

    return may


def near_duplicates(
    spark: SparkSession, documents: DataFrame, percent: int = PERCENT, id_column="doc_id", text_column="text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows = texts_of(documents, id_column, text_column)
    signed = written(spark, rows.mapInArrow(_signed, SIGNED_SQL), "signed")
    members = written(spark, candidates(signed), "candidates")
    classes = signed.where("n > 0").groupBy("sig", "cls").agg(F.min("doc_id").alias("holder"), F.max("bits").alias("bits"))
    named = members.select("cls").union(members.select(F.col("pivot").alias("cls"))).distinct()
    classes = written(spark, classes.join(named, "cls", "left_semi"), "classes")
    side = lambda name, sig, bits: classes.select(
        F.col("cls").alias(name), F.col("sig").alias(sig), F.col("bits").alias(bits)
    )
    met = members.join(side("cls", "sig", "bits"), "cls").join(side("pivot", "pivot_sig", "pivot_bits"), "pivot")
    near = different_sql("bits", "pivot_bits") <= most_different(percent)
    met = written(spark, met.select(F.col("pivot_sig").alias("pivot"), "sig", "bits", near.alias("near")), "met")
    held = lambda sigs: classes.join(sigs.distinct(), "sig", "left_semi").select("holder")
    roots = linked_regions(
        spark, met, lambda sigs: sets_of(spark, rows, held(sigs), WORDS), _by_bits(percent), ("bits",), percent, block
    )
    roots = roots.select(F.col("node").alias("sig"), "root")
    grouped = signed.where("n > 0").join(roots, "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    least = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    grouped = grouped.join(least, "root").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = signed.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return grouped.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
