"""Split statistics and the best split under each criterion."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog import LINE_FEATURES, PLANTED_LABEL, PLANTED_TARGET, lines, query, r6
from tabloom.functions import encode
from tabloom.operators import criteria, ordered
from tabloom.plans.boosting import Stump, StumpBooster
from tabloom.plans.compact import category_rows
from tabloom.plans.trees import category_domains

CATEGORIES = ["flag", "status", "quantity", "discount", "tax"]

CATEGORY_ROWS = f"""(SELECT l_returnflag AS flag, l_linestatus AS status,
    CASE WHEN l_quantity <= 10 THEN 1 WHEN l_quantity <= 25 THEN 2 WHEN l_quantity <= 40 THEN 3 ELSE 4 END AS quantity,
    CASE WHEN l_discount <= 0.025 THEN 1 WHEN l_discount <= 0.055 THEN 2 ELSE 3 END AS discount,
    CASE WHEN l_tax <= 0.035 THEN 1 WHEN l_tax <= 0.065 THEN 2 ELSE 3 END AS tax,
    {PLANTED_LABEL} AS y FROM lineitem)"""

CATEGORY_LONG = " UNION ALL ".join(
    f"SELECT {i} AS feature, {c}::VARCHAR AS value, y FROM {CATEGORY_ROWS}" for i, c in enumerate(CATEGORIES)
)


def categories(spark, folder):
    """lineitem as five categorical columns and the planted label."""
    return lines(spark, folder).select(
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        encode.bin_upper(F.col("l_quantity"), [10, 25, 40]).alias("quantity"),
        encode.bin_upper(F.col("l_discount"), [0.025, 0.055]).alias("discount"),
        encode.bin_upper(F.col("l_tax"), [0.035, 0.065]).alias("tax"),
        "y",
    )


def category_counts(rows, label, weight):
    """Class counts per (feature, value)."""
    melted = criteria.melt_text(rows, CATEGORIES, [F.col(label).alias("label"), weight.alias("n")])
    return melted.groupBy("feature", "value").agg(*criteria.class_measures(F.col("label"), [0, 1], F.col("n")))


@query(
    "class_counts",
    f"""WITH l AS ({CATEGORY_LONG}), d AS (SELECT DISTINCT feature, value FROM l)
        SELECT d.feature, d.value, count(l.y) FILTER (l.y = 0) AS c0, count(l.y) FILTER (l.y = 1) AS c1
        FROM d LEFT JOIN l ON d.feature = l.feature AND d.value = l.value AND l.y IS NOT NULL GROUP BY ALL""",
)
def class_counts(spark, folder):
    folded = category_rows(categories(spark, folder), CATEGORIES, "y")
    domains = category_domains(folded, CATEGORIES)
    declared = [(i, v) for i, c in enumerate(CATEGORIES) for v in domains[c]]
    domain = spark.createDataFrame(declared, "feature int, value string")
    counts = category_counts(folded, "label", F.col("n"))
    return domain.join(counts, ["feature", "value"], "left").select(
        "feature",
        "value",
        F.coalesce("c0", F.lit(0)).cast("long").alias("c0"),
        F.coalesce("c1", F.lit(0)).cast("long").alias("c1"),
    )


def gains(spark, folder):
    # one aggregation over the rows: folding would only add a pass
    counts = category_counts(categories(spark, folder), "y", F.lit(1.0))
    return criteria.category_gains(counts, [], 2)


GAINS = f"""WITH l AS ({CATEGORY_LONG}),
    cell AS (SELECT feature, value, y, count(*) AS n FROM l GROUP BY ALL),
    val AS (SELECT feature, value, sum(n) AS n FROM cell GROUP BY ALL),
    ent AS (SELECT c.feature, c.value, v.n, -sum(c.n / v.n * log2(c.n / v.n)) AS h
            FROM cell c JOIN val v ON c.feature = v.feature AND c.value = v.value GROUP BY ALL),
    tot AS (SELECT feature, sum(n) AS n FROM val GROUP BY ALL),
    base AS (SELECT -sum(p * log2(p)) AS h FROM (SELECT count(*) / sum(count(*)) OVER () AS p FROM l WHERE feature = 0 GROUP BY y)),
    cond AS (SELECT e.feature, sum(e.n / t.n * e.h) AS ce, -sum(e.n / t.n * log2(e.n / t.n)) AS iv
             FROM ent e JOIN tot t USING (feature) GROUP BY ALL),
    gain AS (SELECT feature, base.h AS entropy, ce, iv, base.h - ce AS gain,
             CASE WHEN iv = 0 THEN 0 ELSE (base.h - ce) / iv END AS ratio FROM cond, base)"""


@query("conditional_entropy", GAINS + " SELECT feature, round_even(ce, 6) + 0.0 AS conditional_entropy FROM gain")
def conditional_entropy(spark, folder):
    return gains(spark, folder).select("feature", r6(F.col("conditional_entropy")).alias("conditional_entropy"))


@query(
    "info_gain",
    GAINS + " SELECT feature, round_even(entropy, 6) AS entropy, round_even(gain, 6) + 0.0 AS gain FROM gain",
)
def info_gain(spark, folder):
    return gains(spark, folder).select(
        "feature", r6(F.col("entropy")).alias("entropy"), r6(F.col("gain")).alias("gain")
    )


@query(
    "info_gain_ratio",
    GAINS
    + " SELECT feature, round_even(iv, 6) AS intrinsic_value, round_even(ratio, 6) + 0.0 AS gain_ratio FROM gain",
)
def info_gain_ratio(spark, folder):
    return gains(spark, folder).select(
        "feature", r6(F.col("intrinsic_value")).alias("intrinsic_value"), r6(F.col("gain_ratio")).alias("gain_ratio")
    )


@query(
    "best_split_gain",
    GAINS + " SELECT feature, round_even(gain, 6) + 0.0 AS gain FROM gain ORDER BY round_even(gain, 10) DESC, feature LIMIT 1",
)
def best_split_gain(spark, folder):
    best = criteria.best_per_node(
        gains(spark, folder), [], ["feature", "gain"], ["-round(gain, 10)", "feature"]
    )
    return best.select("feature", r6(F.col("gain")).alias("gain"))


NUMERIC_LONG = " UNION ALL ".join(
    f"SELECT {i} AS feature, {c} AS x, {PLANTED_LABEL} AS y, {PLANTED_TARGET} AS z, l_returnflag AS part FROM lineitem"
    for i, c in enumerate(LINE_FEATURES)
)

# candidates are joined to every value of their feature: slow, and nothing like running totals
SPLITS = f"""WITH l AS ({NUMERIC_LONG}),
    vals AS (SELECT feature, x, count(*) AS n, sum(y) AS s, sum(z) AS zs, sum(z * z) AS zq FROM l GROUP BY ALL),
    cand AS (SELECT DISTINCT feature, t FROM (SELECT feature, round_even((x + lead(x) OVER
             (PARTITION BY feature ORDER BY x)) / 2, 4) AS t FROM vals) WHERE t IS NOT NULL),
    side AS (SELECT c.feature, c.t, sum(v.n) FILTER (v.x <= c.t) AS nl, sum(v.n) FILTER (v.x > c.t) AS nh,
             sum(v.s) FILTER (v.x <= c.t) AS sl, sum(v.s) FILTER (v.x > c.t) AS sh,
             sum(v.zs) FILTER (v.x <= c.t) AS zl, sum(v.zs) FILTER (v.x > c.t) AS zh,
             sum(v.zq) FILTER (v.x <= c.t) AS ql, sum(v.zq) FILTER (v.x > c.t) AS qh
             FROM cand c JOIN vals v USING (feature) GROUP BY ALL)"""
GINI_LOW = "(1 - (sl / nl) * (sl / nl) - (1 - sl / nl) * (1 - sl / nl))"
GINI_HIGH = "(1 - (sh / nh) * (sh / nh) - (1 - sh / nh) * (1 - sh / nh))"
GINI = f"((nl * {GINI_LOW} + nh * {GINI_HIGH}) / (nl + nh))"
LOSS = "(ql - zl * zl / nl + qh - zh * zh / nh)"


def numeric_lines(spark, folder, features=tuple(LINE_FEATURES)):
    """The melted features of lineitem with label and target, and their layout."""
    rows = lines(spark, folder).select(*features, "y", "z")
    layout = ordered.lay_out(rows, features)
    return criteria.melt_numeric(ordered.add_slices(rows, layout), features, ["y", "z"], layout), layout


def class_histogram(spark, folder):
    rows, layout = numeric_lines(spark, folder)
    counts = criteria.class_measures(F.col("y"), [0, 1], F.lit(1.0))
    return ordered.histogram(rows, [], layout, counts), layout


def target_histogram(spark, folder, features=tuple(LINE_FEATURES)):
    rows, layout = numeric_lines(spark, folder, features)
    sums = [F.expr(e) for e in ("CAST(count(1) AS DOUBLE) AS n", "sum(z) AS s", "sum(z * z) AS q")]
    return ordered.histogram(rows, [], layout, sums), layout


@query(
    "threshold_counts",
    SPLITS
    + """ SELECT feature, t AS threshold, (nl - sl)::BIGINT AS c0_low, sl::BIGINT AS c1_low,
          (nh - sh)::BIGINT AS c0_high, sh::BIGINT AS c1_high FROM side""",
)
def threshold_counts(spark, folder):
    histogram, layout = class_histogram(spark, folder)
    totals = criteria.threshold_totals(histogram, [], ["c0", "c1"], digits=4, layout=layout)
    return totals.select(
        "feature", "threshold", *[F.col(c).cast("long").alias(c) for c in ("c0_low", "c1_low", "c0_high", "c1_high")]
    )


@query(
    "threshold_sse",
    SPLITS
    + f""" SELECT feature, t AS threshold, round_even(zl / nl, 6) + 0.0 AS mean_low, round_even(zh / nh, 6) + 0.0 AS mean_high,
           round_even({LOSS}, 2) + 0.0 AS loss FROM side""",
)
def threshold_sse(spark, folder):
    histogram, layout = target_histogram(spark, folder)
    return criteria.loss_candidates(histogram, [], layout=layout).select(
        "feature",
        "threshold",
        r6(F.col("s_low") / F.col("n_low")).alias("mean_low"),
        r6(F.col("s_high") / F.col("n_high")).alias("mean_high"),
        r6(F.col("loss"), 2).alias("loss"),
    )


# sums of two columns, such as 0.07 + 0.03, are often doubles next to each other
NEAR_ROWS = f"(SELECT l_discount + l_tax AS x, {PLANTED_LABEL} AS y FROM lineitem)"


@query(
    "split_near_values",
    f"""WITH r AS (SELECT * FROM {NEAR_ROWS}), v AS (SELECT DISTINCT x FROM r),
        t AS (SELECT DISTINCT round_even((x + n) / 2, 4) AS t FROM (SELECT x, lead(x) OVER (ORDER BY x) AS n FROM v) WHERE n IS NOT NULL)
        SELECT t AS threshold, sum((x <= t)::INTEGER)::BIGINT AS n_low, sum((x <= t AND y = 1)::INTEGER)::BIGINT AS c1_low,
          count(*) AS n_all FROM t, r GROUP BY t""",
)
def split_near_values(spark, folder):
    """Totals at every threshold are those of the rows that the threshold sends to either side."""
    rows = lines(spark, folder).select((F.col("l_discount") + F.col("l_tax")).alias("x"), "y")
    layout = ordered.lay_out(rows, ["x"])
    melted = criteria.melt_numeric(ordered.add_slices(rows, layout), ["x"], ["y"], layout)
    histogram = ordered.histogram(melted, [], layout, criteria.class_measures(F.col("y"), [0, 1], F.lit(1.0)))
    totals = criteria.threshold_totals(histogram, [], ["c0", "c1"], digits=4, layout=layout)
    return totals.select(
        "threshold",
        (F.col("c0_low") + F.col("c1_low")).cast("long").alias("n_low"),
        F.col("c1_low").cast("long").alias("c1_low"),
        (F.col("c0_low") + F.col("c1_low") + F.col("c0_high") + F.col("c1_high")).cast("long").alias("n_all"),
    ).distinct()


# most rows are zero, the rest has many values
TAIL = "CASE WHEN l_quantity > 1 THEN 0 ELSE l_extendedprice END"


@query(
    "split_zero_inflated",
    f"""WITH r AS (SELECT {TAIL} AS x, {PLANTED_LABEL} AS y FROM lineitem),
        g AS (SELECT x, count(*) AS n, sum(y) AS s FROM r GROUP BY x),
        w AS (SELECT x, lead(x) OVER (ORDER BY x) AS nx, sum(n) OVER (ORDER BY x) AS nl, sum(s) OVER (ORDER BY x) AS sl,
          sum(n) OVER () AS na, sum(s) OVER () AS sa FROM g)
        SELECT round_even((x + nx) / 2, 4) AS threshold, nl::BIGINT AS n_low, sl::BIGINT AS c1_low FROM w WHERE nx IS NOT NULL""",
)
def split_zero_inflated(spark, folder):
    rows = lines(spark, folder).select(F.expr(f"CAST({TAIL} AS DOUBLE)").alias("x"), "y")
    layout = ordered.lay_out(rows, ["x"], small_domain=100)
    melted = criteria.melt_numeric(ordered.add_slices(rows, layout), ["x"], ["y"], layout)
    histogram = ordered.histogram(melted, [], layout, criteria.class_measures(F.col("y"), [0, 1], F.lit(1.0)))
    totals = criteria.threshold_totals(histogram, [], ["c0", "c1"], digits=4, layout=layout)
    return totals.select(
        "threshold",
        (F.col("c0_low") + F.col("c1_low")).cast("long").alias("n_low"),
        F.col("c1_low").cast("long").alias("c1_low"),
    )


@query("threshold_gini", SPLITS + f" SELECT feature, t AS threshold, round_even({GINI}, 8) + 0.0 AS gini FROM side")
def threshold_gini(spark, folder):
    histogram, layout = class_histogram(spark, folder)
    return criteria.gini_candidates(histogram, [], 2, layout=layout).select(
        "feature", "threshold", r6(F.col("gini"), 8).alias("gini")
    )


@query(
    "gini",
    f"""SELECT flag, round_even(1 - p * p - (1 - p) * (1 - p), 8) + 0.0 AS gini
        FROM (SELECT flag, avg(y) AS p FROM {CATEGORY_ROWS} GROUP BY flag)""",
)
def gini(spark, folder):
    counts = (
        categories(spark, folder)
        .groupBy("flag")
        .agg(*criteria.class_measures(F.col("y"), [0, 1], F.lit(1.0)))
    )
    return counts.select("flag", r6(criteria.gini(["c0", "c1"]), 8).alias("gini"))


@query(
    "best_split_gini",
    SPLITS
    + f""" SELECT feature, t AS threshold, round_even({GINI}, 8) AS gini FROM side
           ORDER BY round_even({GINI}, 12), feature, t LIMIT 1""",
)
def best_split_gini(spark, folder):
    histogram, layout = class_histogram(spark, folder)
    table = criteria.gini_candidates(histogram, [], 2, layout=layout)
    best = criteria.best_per_node(
        table, [], ["feature", "threshold", "gini"], ["gini", "feature", "threshold"]
    )
    return best.select("feature", "threshold", r6(F.col("gini"), 8).alias("gini"))


@query(
    "best_split_sse",
    SPLITS
    + f""" SELECT feature, t AS threshold, round_even({LOSS}, 2) AS loss FROM side
           ORDER BY round_even({LOSS}, 2), feature DESC, t LIMIT 1""",
)
def best_split_sse(spark, folder):
    histogram, layout = target_histogram(spark, folder)
    table = criteria.loss_candidates(histogram, [], layout=layout)
    best = criteria.best_per_node(
        table, [], ["feature", "threshold", "loss"], ["share", "-feature", "threshold"]
    )
    return best.select("feature", "threshold", r6(F.col("loss"), 2).alias("loss"))


# a continuous column: one candidate per pair of neighbouring prices, totals through slices
@query(
    "best_split_wide",
    f"""WITH v AS (SELECT l_extendedprice AS x, count(*) AS n, sum({PLANTED_TARGET}) AS s,
          sum(({PLANTED_TARGET}) * ({PLANTED_TARGET})) AS q FROM lineitem GROUP BY ALL),
        r AS (SELECT x, round_even((x + lead(x) OVER o) / 2, 4) AS t, sum(n) OVER o AS nl, sum(s) OVER o AS zl,
          sum(q) OVER o AS ql FROM v WINDOW o AS (ORDER BY x)),
        side AS (SELECT t, nl, zl, ql, (SELECT sum(n) FROM v) - nl AS nh, (SELECT sum(s) FROM v) - zl AS zh,
          (SELECT sum(q) FROM v) - ql AS qh FROM r WHERE t IS NOT NULL)
        SELECT t AS threshold, nl::BIGINT AS n_low, nh::BIGINT AS n_high, round_even({LOSS}, 1) AS loss FROM side
        ORDER BY {LOSS}, t LIMIT 1""",
)
def best_split_wide(spark, folder):
    histogram, layout = target_histogram(spark, folder, ("l_extendedprice",))
    table = criteria.loss_candidates(histogram, [], layout=layout)
    best = criteria.best_per_node(
        table, [], ["threshold", "n_low", "n_high", "loss"], ["share", "threshold"]
    )
    return best.select(
        "threshold",
        F.col("n_low").cast("long").alias("n_low"),
        F.col("n_high").cast("long").alias("n_high"),
        r6(F.col("loss"), 1).alias("loss"),
    )


STUMPS = f"""WITH l AS ({NUMERIC_LONG}),
    vals AS (SELECT feature, x, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS m FROM l GROUP BY ALL),
    cand AS (SELECT DISTINCT feature, t FROM (SELECT feature, round_even((x + lead(x) OVER
             (PARTITION BY feature ORDER BY x)) / 2, 8) AS t FROM vals) WHERE t IS NOT NULL),
    err AS (SELECT c.feature, c.t, (coalesce(sum(v.m) FILTER (v.x >= c.t), 0) + coalesce(sum(v.p) FILTER (v.x < c.t), 0))
            / sum(v.m + v.p) AS e FROM cand c JOIN vals v USING (feature) GROUP BY ALL),
    both_signs AS (SELECT feature, t, 1 AS polarity, round_even(e, 12) AS e FROM err
             UNION ALL SELECT feature, t, -1, round_even(1 - e, 12) FROM err)"""


@query(
    "stump_best",
    STUMPS
    + """ SELECT feature, t AS threshold, polarity, round_even(e, 8) AS error FROM both_signs
          ORDER BY e, feature, t, polarity DESC LIMIT 1""",
)
def stump_best(spark, folder):
    rows, layout = numeric_lines(spark, folder)
    sides = ("sum(IF(y = 1, 1D, 0D)) AS wp", "sum(IF(y = 1, 0D, 1D)) AS wn")
    histogram = ordered.histogram(rows, [], layout, [F.expr(e) for e in sides])
    best = criteria.best_per_node(
        criteria.stump_candidates(histogram, [], layout=layout),
        [],
        ["feature", "threshold", "polarity", "error"],
        ["error", "feature", "threshold", "-polarity"],
    )
    return best.select("feature", "threshold", "polarity", r6(F.col("error"), 8).alias("error"))


@query(
    "weighted_error",
    f"""SELECT round_even(sum(w * (CASE WHEN (CASE WHEN l_tax >= 0.045 THEN 1 ELSE 0 END) <> y THEN 1 ELSE 0 END)) / sum(w), 8)
        AS error FROM (SELECT l_quantity AS w, l_tax, {PLANTED_LABEL} AS y FROM lineitem)""",
)
def weighted_error(spark, folder):
    stump = StumpBooster((Stump(1, "l_tax", 0.045, 1, 0.3, 1.0, 1.0),))
    scored = stump.score(lines(spark, folder), "guess")
    wrong = (F.col("guess") != F.col("y")).cast("double")
    return scored.agg(
        r6(F.sum(F.col("l_quantity") * wrong) / F.sum("l_quantity"), 8).alias("error")
    )
