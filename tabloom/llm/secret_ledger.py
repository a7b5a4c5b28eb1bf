"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of a text is addressed by its SHA-256. A ledger, a Parquet table that only grows, has one row for each
(blob, rule, rule version) that has been scanned, with the spans found. A scan reads only the blobs that lack a row for
a current rule, once each however many paths hold them, and joins the ledger back to all paths.

Defined cases: a null text is the empty blob; rows with a null path are rows as any other; repeated rows each return a
row; an empty table gives an empty result and leaves the ledger as it was; other columns are ignored. Spans count code
points, the end is exclusive; an empty span list gives the empty string and its digest.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.llm.common import batch_of, slices, texts_of
from tabloom.session import scratch_path

# fixed values: the three kinds, in the order that breaks ties of position
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal, so the length can be asked for while matching


def assign_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]


def access_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]


def hex_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in HEX.finditer(text)]


@dataclass(frozen=True)
class Rule:
    """A detector; a change of ``find`` needs a new ``version``, which makes every blob unseen for it."""

    kind: str
    version: int
    find: Callable[[str], list[tuple[int, int]]]


RULES = (Rule("assign", 1, assign_spans), Rule("access", 1, access_spans), Rule("hex", 1, hex_spans))
LEDGER = "blob binary, kind string, version int, starts array<int>, ends array<int>"
FOUND = pa.schema(
    [
        ("blob", pa.binary()),
        ("kind", pa.string()),
        ("version", pa.int32()),
        ("starts", pa.list_(pa.int32())),
        ("ends", pa.list_(pa.int32())),
    ]
)


def open_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at a path, made empty where there is none."""
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def _addressed(versions: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return texts_of(versions, id_column, text_column).withColumn("blob", F.unhex(F.sha2("text", 256)))


def _scanner(rules: tuple[Rule, ...]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_kind = {r.kind: r for r in rules}
        for batch in slices(batches, 1):
            rows = []
            for blob, text, kinds in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for kind in kinds:
                    spans = by_kind[kind].find(text)
                    rows.append((blob, kind, by_kind[kind].version, [s for s, _ in spans], [e for _, e in spans]))
            yield batch_of(FOUND, *(zip(*rows, strict=True) if rows else [[]] * 5))

    return scan


def update_ledger(
    spark: SparkSession, versions: DataFrame, path: str, rules=RULES, id_column="doc_id", text_column="text"
) -> None:
    """Scan each blob for the rules that the ledger lacks it for, and append what was found."""
    ledger = open_ledger(spark, path)
    rows = _addressed(versions, id_column, text_column)
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    # one row of each blob is read; which one is settled on digests alone, so no text is gathered by blob
    holders = rows.groupBy("blob").agg(F.min("doc_id").alias("holder"))
    unseen = (
        holders.withColumn("rule", F.explode(wanted))
        .select("blob", "holder", "rule.kind", "rule.version")
        .join(ledger.select("blob", "kind", "version"), ["blob", "kind", "version"], "left_anti")
        .groupBy("blob", "holder")
        .agg(F.collect_list("kind").alias("kinds"))
    )
    unseen = unseen.select(F.col("blob").alias("unseen_blob"), "holder", "kinds")
    pending = rows.join(
        unseen, (F.col("blob") == F.col("unseen_blob")) & F.col("doc_id").eqNullSafe(F.col("holder"))
    ).select("blob", "text", "kinds")
    found = pending.mapInArrow(_scanner(tuple(rules)), LEDGER)
    # a row that is repeated as it stands is scanned again; its finding is the same
    found.dropDuplicates(["blob", "kind", "version"]).write.mode("append").parquet(path)


def findings(
    spark: SparkSession, versions: DataFrame, path: str, rules=RULES, id_column="doc_id", text_column="text"
) -> DataFrame:
    """(doc_id, blob, spans): for every path, its blob's spans as sorted structs (start, rank, kind, end)."""
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    current = None
    for r in rules:
        this = (F.col("kind") == r.kind) & (F.col("version") == r.version)
        current = this if current is None else current | this
    spans = (
        spark.read.schema(LEDGER).parquet(path)
        .where(current & (F.size("starts") > 0))
        .withColumn("rank", rank[F.col("kind")])
        .select("blob", F.transform(
            F.arrays_zip("starts", "ends"),
            lambda s: F.struct(s["starts"].alias("start"), "rank", "kind", s["ends"].alias("end")),
        ).alias("some"))
        .groupBy("blob")
        .agg(F.array_sort(F.flatten(F.collect_list("some"))).alias("spans"))
    )
    paths = _addressed(versions, id_column, text_column).select("doc_id", "blob")
    return paths.join(spans, "blob", "left").select("doc_id", "blob", "spans")


def scan_secrets(
    spark: SparkSession, versions: DataFrame, path: str | None = None, id_column="doc_id", text_column="text"
) -> DataFrame:
    """Bring the ledger up to date and return one row per version: counts by kind, digest, spans, blob.

    Without a path a new ledger is begun in the shared folder.
    """
    path = path or scratch_path(spark, "secret-ledger")
    update_ledger(spark, versions, path, RULES, id_column, text_column)
    rows = findings(spark, versions, path, RULES, id_column, text_column)
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int>>")
    rows = rows.withColumn("spans", F.coalesce("spans", none))
    joined = F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return rows.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in RULES],
        F.sha2(joined, 256).alias("base_sha256"),
        joined.alias("spans"),
        F.lower(F.hex("blob")).alias("blob"),
    )
