"""Hold-out and fold assignment from the row's key, never from row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.functions import hash_bucket, quoted

PARTS_PER_UNIT = 10_000
PREFIX_DIGITS = 4  # 65536 parts of a class; more digits for classes beyond some 10^11 rows


def in_holdout(key: Column, share: float, salt: str = "") -> Column:
    """True for about ``share`` of the keys; the same keys on any cluster."""
    return hash_bucket(key, PARTS_PER_UNIT, salt) < int(round(share * PARTS_PER_UNIT))


def fold_of(key: Column, folds: int, salt: str = "", otherwise: Column | None = None) -> Column:
    """The fold of a key; rows without one are dealt by ``otherwise``, such as a hash of the row."""
    if otherwise is not None:
        key = F.coalesce(key.cast("string"), otherwise.cast("string"))
    return hash_bucket(key, folds, salt)


def row_hash(frame: DataFrame) -> Column:
    """A hash of the whole row, in place of a key that is null."""
    plain = [quoted(f.name) for f in frame.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*plain)


def stratified_folds(
    frame: DataFrame, key: str, label: str, folds: int, prefix_digits: int = PREFIX_DIGITS
) -> DataFrame:
    """Add ``fold``: rows of a class in md5 order, dealt out 0, 1, .., folds-1, 0, ..

    Rows without a label are a class of their own; a row without a key takes the hash of
    the row in its place.  Every row stays.  One class may hold most rows, so the md5 order
    is cut by its first hex digits: rows are numbered inside (class, prefix) and shifted by
    the sizes of the smaller prefixes, a table of at most classes x prefixes rows.
    """
    taken = "__fold_"  # in front of the names of this function's own columns
    named = F.coalesce(F.col(quoted(key)).cast("string"), row_hash(frame).cast("string"))
    rows = frame.select("*", F.md5(named).alias(f"{taken}digest"))
    rows = rows.withColumn(f"{taken}prefix", F.substring(f"{taken}digest", 1, prefix_digits))
    sizes = rows.groupBy(F.col(quoted(label)).alias(f"{taken}label"), F.col(f"{taken}prefix").alias(f"{taken}part")).agg(
        F.count(F.lit(1)).alias(f"{taken}size")
    )
    before = (
        Window.partitionBy(f"{taken}label").orderBy(f"{taken}part").rowsBetween(Window.unboundedPreceding, -1)
    )
    shift = F.coalesce(F.sum(f"{taken}size").over(before), F.lit(0)).alias(f"{taken}shift")
    shifts = sizes.select(f"{taken}label", f"{taken}part", shift)
    order = Window.partitionBy(quoted(label), f"{taken}prefix").orderBy(f"{taken}digest", quoted(key))
    rows = rows.withColumn(f"{taken}place", F.row_number().over(order) - 1)
    same = F.col(quoted(label)).eqNullSafe(F.col(f"{taken}label")) & (F.col(f"{taken}prefix") == F.col(f"{taken}part"))
    fold = ((F.col(f"{taken}place") + F.col(f"{taken}shift")) % folds).cast("int").alias("fold")
    return rows.join(shifts, same).select(*[quoted(c) for c in frame.columns], fold)
