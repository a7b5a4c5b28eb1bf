"""The operators as registered queries over whole tables, beside the SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabloom.llm.byte_bpe import encode_decode
from tabloom.llm.common import table
from tabloom.llm.crf_language import predict_languages
from tabloom.llm.curve_packing import pack_documents
from tabloom.llm.deobfuscate import find_personal_data
from tabloom.llm.exact_dedup import exact_groups
from tabloom.llm.fill_middle import restored, transform
from tabloom.llm.kd_search import top_inner_products
from tabloom.llm.license_scan import find_licenses
from tabloom.llm.merkle_manifest import manifest
from tabloom.llm.minhash_dedup import near_duplicates
from tabloom.llm.ngram_join import near_duplicate_groups
from tabloom.llm.ordinal_toxicity import score_toxicity
from tabloom.llm.secret_ledger import scan_secrets


def ordinal_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(spark, table(spark, folder, "documents"), table(spark, folder, "labels"))


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return find_licenses(table(spark, folder, "documents"))


def secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(spark, table(spark, folder, "documents"))


def curve_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(spark, table(spark, folder, "documents"))


def crf_language(spark: SparkSession, folder: str) -> DataFrame:
    return predict_languages(spark, table(spark, folder, "documents"))


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encode_decode(table(spark, folder, "documents"))


def kd_search(spark: SparkSession, folder: str) -> DataFrame:
    return top_inner_products(spark, table(spark, folder, "embeddings"))


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    columns = "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    return exact_groups(spark, table(spark, folder, "documents")).select(*columns)


def pii_deobfuscation(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(table(spark, folder, "documents"))


def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicate_groups(spark, table(spark, folder, "documents"))


def fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return transform(table(spark, folder, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"),
    )


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    columns = "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    return manifest(spark, table(spark, folder, "documents")).select(*columns)


def minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(spark, table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ordinal_toxicity": ordinal_toxicity,
    "op2_secret_ledger": secret_ledger,
    "op3_curve_packing": curve_packing,
    "op4_jaccard_join": jaccard_join,
    "op5_license_scan": license_scan,
    "op6_crf_language": crf_language,
    "op7_byte_bpe": byte_bpe,
    "op8_kd_search": kd_search,
    "op9_exact_dedup": exact_dedup,
    "op10_pii_deobfuscation": pii_deobfuscation,
    "op11_fill_middle": fill_middle,
    "op12_merkle_manifest": merkle_manifest,
    "op13_minhash_dedup": minhash_dedup,
}

EXACT_DEDUP_SQL = """
WITH d AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""

KD_SEARCH_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.row_id AS query_row, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.row_id <> c.row_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

FILL_MIDDLE_SQL = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex,
        regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units FROM documents),
h AS (
    SELECT doc_id, text, units, len(units) AS n, CAST('0x' || hex[1:8] AS BIGINT) AS h1,
        CAST('0x' || hex[9:16] AS BIGINT) AS h2, CAST('0x' || hex[17:24] AS BIGINT) AS h3,
        CAST('0x' || hex[25:32] AS BIGINT) AS h4 FROM d),
c AS (
    SELECT doc_id, text, units, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
    SELECT doc_id, text, n, form, array_to_string(units[:a], '') AS prefix,
        array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p
"""




def _near_duplicates_sql(n_words: int, percent: int, columns: str) -> str:
    """All pairs that share a shingle, then what links reach."""
    return f"""
WITH RECURSIVE
w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
d AS (
    SELECT row_number() OVER () AS row_id, doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(
        range(1, greatest(len(words) - {n_words - 1}, 1) + 1),
        lambda i: array_to_string(words[i:i + {n_words - 1}], ' '))) END AS grams FROM w),
sets AS (SELECT grams, min(row_id) AS cls, len(grams) AS n FROM (SELECT row_id, list_sort(grams) AS grams FROM d) GROUP BY grams),
g AS (SELECT cls, n, unnest(grams) AS gram FROM sets WHERE n > 0),
pairs AS (
    SELECT a.cls AS a, b.cls AS b FROM g a JOIN g b ON a.gram = b.gram AND a.cls <> b.cls
    GROUP BY a.cls, b.cls, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
reach AS (SELECT cls AS a, cls AS b FROM sets UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b),
ids AS (SELECT s.cls, min(d.doc_id) AS least FROM d JOIN sets s ON list_sort(d.grams) = s.grams WHERE s.n > 0 GROUP BY s.cls),
least AS (SELECT r.a AS cls, min(i.least) AS component_id FROM reach r JOIN ids i ON i.cls = r.b GROUP BY r.a),
found AS (
    SELECT d.doc_id, len(d.grams) AS n_shingles, CASE WHEN s.n = 0 THEN d.doc_id ELSE l.component_id END AS component_id
    FROM d JOIN sets s ON list_sort(d.grams) = s.grams LEFT JOIN least l ON l.cls = s.cls)
SELECT {columns} FROM found
"""


def _bytes_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(_bytes_sql(v) for v in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


# a tree a value of lang, then one tree of their roots; CRC-32 by a table of its 256 steps
MERKLE_SQL = f"""
WITH RECURSIVE
steps AS (
    SELECT 0 AS bit, i, i AS c FROM range(256) t(i)
    UNION ALL
    SELECT bit + 1, i, xor(c >> 1, (c & 1) * 3988292384) FROM steps WHERE bit < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE bit = 8),
d AS (
    SELECT lang AS tree, doc_id, {_leaf_sql("n_chars")} AS leaf, {_leaf_sql("(CAST(n_chars AS HUGEINT) + 1)")} AS raised,
        xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
            string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 7 = 0 AS changed
    FROM documents, crc),
leaves AS (
    SELECT tree, doc_id, leaf, CASE WHEN changed THEN raised ELSE leaf END AS shown, count(*) OVER (PARTITION BY tree) AS size,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d),
nodes AS (
    SELECT tree, 0 AS level, place, size, leaf AS digest FROM leaves
    UNION ALL
    SELECT tree, level + 1, place // 2, (min(size) + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
    FROM nodes WHERE size > 1 GROUP BY tree, level, place // 2),
subroots AS (
    SELECT tree, digest AS subroot, count(*) OVER () AS size, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place
    FROM nodes WHERE size = 1),
top AS (
    SELECT 0 AS level, place, size, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, (min(size) + 1) // 2, sha256(string_agg(digest, '' ORDER BY place))
    FROM top WHERE size > 1 GROUP BY level, place // 2),
low_fold AS (
    SELECT tree, doc_id, leaf, 0 AS level, place, size, shown AS folded, '' AS proof FROM leaves
    UNION ALL
    SELECT f.tree, doc_id, leaf, f.level + 1, f.place // 2, (f.size + 1) // 2,
        sha256(CASE WHEN f.place % 2 = 0 THEN folded || coalesce(s.digest, '') ELSE s.digest || folded END),
        proof || coalesce(s.digest, '')
    FROM low_fold f LEFT JOIN nodes s ON s.tree IS NOT DISTINCT FROM f.tree AND s.level = f.level AND s.place = xor(f.place, 1)
    WHERE f.size > 1),
top_fold AS (
    SELECT doc_id, leaf, subroot, 0 AS level, s.place, s.size, folded, proof
    FROM low_fold f JOIN subroots s ON s.tree IS NOT DISTINCT FROM f.tree WHERE f.size = 1
    UNION ALL
    SELECT doc_id, leaf, subroot, f.level + 1, f.place // 2, (f.size + 1) // 2,
        sha256(CASE WHEN f.place % 2 = 0 THEN folded || coalesce(s.digest, '') ELSE s.digest || folded END),
        proof || coalesce(s.digest, '')
    FROM top_fold f LEFT JOIN top s ON s.level = f.level AND s.place = xor(f.place, 1) WHERE f.size > 1)
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
    folded = digest AS verified
FROM top_fold f, (SELECT digest FROM top WHERE size = 1) WHERE f.size = 1
"""

ORACLES: dict[str, str] = {
    "op4_jaccard_join": _near_duplicates_sql(5, 75, "doc_id, n_shingles, component_id"),
    "op8_kd_search": KD_SEARCH_SQL,
    "op9_exact_dedup": EXACT_DEDUP_SQL,
    "op11_fill_middle": FILL_MIDDLE_SQL,
    "op12_merkle_manifest": MERKLE_SQL,
    "op13_minhash_dedup": _near_duplicates_sql(
        4, 80, "doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept"
    ),
}
