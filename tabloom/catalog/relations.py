"""Joins, unions, splits and table statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog import EVENTS_WITH_GAPS, events_with_gaps, query, r6, table
from tabloom.functions import hash_bucket
from tabloom.functions.encode import mode_row
from tabloom.operators import criteria, ordered, stats
from tabloom.sources import tables


@query(
    "union_tagged",
    """SELECT 'train' AS "set", c_custkey AS key, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT 'test', s_suppkey, s_acctbal, NULL FROM supplier""",
)
def union_tagged(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("key")
    )
    return stats.union_tagged({"train": customers, "test": suppliers}, "set")


@query(
    "split_by_tag",
    """SELECT c_custkey AS key, c_acctbal AS balance FROM customer""",
)
def split_by_tag(spark, folder):
    return union_tagged(spark, folder).filter("set = 'train'").select("key", "balance")


@query(
    "labelled_split",
    """SELECT lang, quality IS NOT NULL AS labelled, count(*) AS documents, sum(n_chars)::BIGINT AS chars
       FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL""",
)
def labelled_split(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    whole = documents.join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id", "left")
    parts = {"yes": whole.filter("quality IS NOT NULL"), "no": whole.filter("quality IS NULL")}
    return (
        stats.union_tagged(parts, "part")
        .groupBy("lang", (F.col("part") == "yes").alias("labelled"))
        .agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("chars"))
    )


@query(
    "branch_filter",
    """SELECT 'l_quantity > 25.5' AS rule, count(*) AS rows, round_even(avg(l_tax), 6) AS tax FROM lineitem WHERE l_quantity > 25.5
       UNION ALL SELECT 'l_quantity <= 25.5', count(*), round_even(avg(l_tax), 6) FROM lineitem WHERE l_quantity <= 25.5
       UNION ALL SELECT 'l_returnflag = A', count(*), round_even(avg(l_tax), 6) FROM lineitem WHERE l_returnflag = 'A'""",
)
def branch_filter(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_quantity", "l_returnflag", "l_tax")
    branches = {
        "l_quantity > 25.5": rows.filter("l_quantity > 25.5"),
        "l_quantity <= 25.5": rows.filter("l_quantity <= 25.5"),
        "l_returnflag = A": rows.filter("l_returnflag = 'A'").drop("l_returnflag"),
    }
    whole = None
    for rule, branch in branches.items():
        part = branch.agg(F.count(F.lit(1)).alias("rows"), r6(F.avg("l_tax")).alias("tax")).select(
            F.lit(rule).alias("rule"), "rows", "tax"
        )
        whole = part if whole is None else whole.unionByName(part)
    return whole


@query(
    "bind_scores",
    "SELECT doc_id, lang, n_chars, quality, toxic FROM documents FULL JOIN labels USING (doc_id)",
)
def bind_scores(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    return stats.bind(documents, table(spark, folder, "labels"), "doc_id")


@query(
    "fill_submission",
    """SELECT doc_id, l.score FROM documents d LEFT JOIN (SELECT doc_id AS id, 0.25::DOUBLE + 0.5::DOUBLE * quality AS score
       FROM labels) l ON d.doc_id = l.id""",
)
def fill_submission(spark, folder):
    sample = table(spark, folder, "documents").select("doc_id", F.lit(22.5).alias("score"))
    scored = table(spark, folder, "labels").select("doc_id", (0.25 + 0.5 * F.col("quality")).alias("p"))
    return tables.fill_submission(sample, "doc_id", "score", scored, "p")


@query(
    "value_counts",
    f"""SELECT event_type AS "value", count(*) AS "count" FROM {EVENTS_WITH_GAPS}
        WHERE event_type IS NOT NULL GROUP BY event_type""",
)
def value_counts(spark, folder):
    return stats.value_counts(events_with_gaps(spark, folder), "event_type")


@query(
    "mode_value",
    f"""SELECT event_type AS "value", count(*) AS "count" FROM {EVENTS_WITH_GAPS} WHERE event_type IS NOT NULL
        GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1""",
)
def mode_value(spark, folder):
    return mode_row(events_with_gaps(spark, folder), "event_type")


DESCRIBED = ("l_quantity", "l_extendedprice", "l_tax")


@query(
    "describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS "count", round_even(avg({c}), 4) AS mean,
        round_even(stddev_samp({c}), 4) AS std, min({c}) AS "min", round_even(quantile_cont({c}, 0.25), 4) AS q25,
        round_even(quantile_cont({c}, 0.5), 4) AS q50, round_even(quantile_cont({c}, 0.75), 4) AS q75, max({c}) AS "max"
        FROM lineitem"""
        for c in DESCRIBED
    ),
)
def describe(spark, folder):
    table_of = stats.describe(table(spark, folder, "lineitem").select(*DESCRIBED), list(DESCRIBED))
    rounded = [r6(F.col(c), 4).alias(c) for c in ("mean", "std", "q25", "q50", "q75")]
    return table_of.select("column", "count", "min", "max", *rounded)


@query(
    "class_domain",
    """SELECT o_orderstatus AS status, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY o_orderstatus""",
)
def class_domain(spark, folder):
    # two groupings instead of one distinct set per status: a status may hold most rows
    pairs = table(spark, folder, "orders").select(F.col("o_orderstatus").alias("status"), "o_custkey").distinct()
    return pairs.groupBy("status").agg(F.count("o_custkey").alias("customers"))


@query("shape", "SELECT count(*) AS \"rows\", 11 AS \"columns\" FROM lineitem")
def shape(spark, folder):
    return stats.shape(table(spark, folder, "lineitem"))


def importances(spark, folder):
    """Account balances per (segment, nation) and fold, standing for feature importances."""
    customers = table(spark, folder, "customer")
    return customers.groupBy(
        F.concat_ws("_", "c_mktsegment", "c_nationkey").alias("feature"),
        (hash_bucket(F.col("c_custkey"), 5) + 1).alias("fold"),
    ).agg(F.avg("c_acctbal").alias("importance"))


@query(
    "importance_top40",
    """WITH i AS (SELECT c_mktsegment || '_' || c_nationkey AS feature,
         (('0x' || substr(md5(c_custkey::VARCHAR), 1, 8))::BIGINT % 5 + 1)::INTEGER AS fold,
         avg(c_acctbal) AS importance FROM customer GROUP BY ALL),
       top AS (SELECT feature FROM i GROUP BY feature ORDER BY avg(importance) DESC, feature LIMIT 40)
       SELECT feature, fold, round_even(importance, 4) AS importance FROM i WHERE feature IN (SELECT feature FROM top)""",
)
def importance_top40(spark, folder):
    best = stats.top_importance(importances(spark, folder), 40)
    return best.select("feature", "fold", r6(F.col("importance"), 4).alias("importance"))


@query(
    "fold_average",
    """WITH s AS (SELECT o_orderkey, o_totalprice, f.fold, o_totalprice * (f.fold + 1) / 1000 AS p
         FROM orders, (VALUES (0), (1), (2)) f(fold))
       SELECT o_orderkey, round_even(avg(p), 4) AS p FROM s GROUP BY o_orderkey""",
)
def fold_average(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    folds = orders.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("fold"))
    scored = folds.withColumn("p", F.col("o_totalprice") * (F.col("fold") + 1) / 1000)
    return scored.groupBy("o_orderkey").agg(r6(F.avg("p"), 4).alias("p"))


@query(
    "candidate_points",
    """WITH v AS (SELECT DISTINCT 0 AS feature, l_quantity AS x FROM lineitem UNION ALL SELECT DISTINCT 1, l_extendedprice FROM lineitem)
       SELECT feature, threshold FROM (SELECT feature, round_even((x + lead(x) OVER (PARTITION BY feature ORDER BY x)) / 2, 4)
       AS threshold FROM v) WHERE threshold IS NOT NULL""",
)
def candidate_points(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    layout = ordered.lay_out(rows, rows.columns)
    values = criteria.melt_numeric(ordered.add_slices(rows, layout), rows.columns, [], layout)
    counted = ordered.histogram(values, [], layout, [F.expr("count(1) AS n")])
    paired = ordered.running_totals(
        counted.values,
        ["feature"],
        ["x"],
        ["n"],
        slice_column=layout.slice_column,
        by_slice=counted.by_slice,
        following="x_next",
    )
    return paired.filter("x_next IS NOT NULL").select(
        "feature", r6((F.col("x") + F.col("x_next")) / 2, 4).alias("threshold")
    )
