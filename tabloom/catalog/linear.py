"""Linear and logistic fits, the perceptron and the library learners."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog import PLANTED_LABEL, PLANTED_TARGET, lines, query, r6, table
from tabloom.functions.encode import first_argmax
from tabloom.plans import linear
from tabloom.plans.learners import (
    ForestLearner,
    GbtLearner,
    fit_library_linear,
    fit_library_logistic,
    fit_one_vs_rest,
)
from tabloom.sources import tables

SCALED = ["quantity", "discount", "tax"]
SCALED_ROWS = f"""(SELECT l_quantity / 50 AS quantity, l_discount * 10 AS discount, l_tax * 10 AS tax,
    {PLANTED_LABEL} AS y, {PLANTED_TARGET} AS z, l_shipdate FROM lineitem)"""


def scaled(spark, folder):
    return lines(spark, folder).select(
        (F.col("l_quantity") / 50).alias("quantity"),
        (F.col("l_discount") * 10).alias("discount"),
        (F.col("l_tax") * 10).alias("tax"),
        "y",
        "z",
        "l_shipdate",
    )


@query(
    "gram_matrix",
    f"""SELECT round_even(sum(quantity), 4) AS g_0_1, round_even(sum(discount), 4) AS g_0_2, count(*)::DOUBLE AS g_0_0,
        round_even(sum(quantity * quantity), 4) AS g_1_1, round_even(sum(quantity * discount), 4) AS g_1_2,
        round_even(sum(discount * discount), 4) AS g_2_2, round_even(sum(z), 2) AS b_0, round_even(sum(quantity * z), 2) AS b_1,
        round_even(sum(discount * z), 2) AS b_2, round_even(sum(z * z), 0) AS yy, count(*) AS "rows" FROM {SCALED_ROWS}""",
)
def gram_matrix(spark, folder):
    sums = linear.moment_table(scaled(spark, folder), ["quantity", "discount"], "z")
    digits = {"b_0": 2, "b_1": 2, "b_2": 2, "yy": 0}
    return sums.select(
        *[r6(F.col(c), digits.get(c, 4)).alias(c) for c in sums.columns if c != "rows"], "rows"
    )


@query(
    "linreg_normal",
    f"""WITH m AS (SELECT covar_pop(quantity, quantity) AS a, covar_pop(quantity, discount) AS b, covar_pop(discount, discount) AS d,
          covar_pop(quantity, z) AS p, covar_pop(discount, z) AS q, avg(quantity) AS mq, avg(discount) AS md, avg(z) AS mz FROM {SCALED_ROWS}),
        w AS (SELECT (d * p - b * q) / (a * d - b * b) AS w1, (a * q - b * p) / (a * d - b * b) AS w2, mq, md, mz FROM m)
        SELECT '(intercept)' AS term, round_even(mz - w1 * mq - w2 * md, 5) + 0.0 AS weight FROM w
        UNION ALL SELECT 'quantity', round_even(w1, 5) FROM w UNION ALL SELECT 'discount', round_even(w2, 5) FROM w""",
)
def linreg_normal(spark, folder):
    model = linear.fit_normal_equation(scaled(spark, folder), ["quantity", "discount"], "z")
    return model.table(spark).select("term", r6(F.col("weight"), 5).alias("weight"))


DESCENT_ETA, DESCENT_DELTA = 0.1, 1e-6


def descent_sql(eta: float, delta: float) -> str:
    """Gradient steps on the one-row table of sums, until the squared error falls by less than delta."""
    gaps = "n * a + g01 * b + g02 * c - b0", "g01 * a + g11 * b + g12 * c - b1", "g02 * a + g12 * b + g22 * c - b2"
    return f"""WITH RECURSIVE m AS (SELECT count(*)::DOUBLE AS n, sum(quantity) AS g01, sum(discount) AS g02,
          sum(quantity * quantity) AS g11, sum(quantity * discount) AS g12, sum(discount * discount) AS g22, sum(z) AS b0,
          sum(quantity * z) AS b1, sum(discount * z) AS b2 FROM {SCALED_ROWS}),
        t AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0.0::DOUBLE AS c, 1e300::DOUBLE AS fell, 0 AS k
          UNION ALL SELECT a + d0, b + d1, c + d2, -(d0 * (n * d0 + g01 * d1 + g02 * d2) + d1 * (g01 * d0 + g11 * d1 + g12 * d2)
            + d2 * (g02 * d0 + g12 * d1 + g22 * d2) + 2 * (d0 * e0 + d1 * e1 + d2 * e2)), k + 1
          FROM (SELECT *, -{eta}::DOUBLE / n * e0 AS d0, -{eta}::DOUBLE / n * e1 AS d1, -{eta}::DOUBLE / n * e2 AS d2 FROM
            (SELECT *, {gaps[0]} AS e0, {gaps[1]} AS e1, {gaps[2]} AS e2 FROM t, m WHERE fell >= {delta}))),
        last AS (SELECT * FROM t ORDER BY k DESC LIMIT 1)
        SELECT '(intercept)' AS term, round_even(a, 4) + 0.0 AS weight FROM last
        UNION ALL SELECT 'quantity', round_even(b, 4) + 0.0 FROM last UNION ALL SELECT 'discount', round_even(c, 4) + 0.0 FROM last"""


@query("linreg_gd", descent_sql(DESCENT_ETA, DESCENT_DELTA))
def linreg_gd(spark, folder):
    model = linear.fit_linear_descent(
        scaled(spark, folder), ["quantity", "discount"], "z", eta=DESCENT_ETA, delta=DESCENT_DELTA
    )
    return model.table(spark).select("term", r6(F.col("weight"), 4).alias("weight"))


@query(
    "gram_wide",
    """WITH v AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
       SELECT a.i::INTEGER AS i, b.i::INTEGER AS j, round_even(sum(a.x * b.x), 4) + 0.0 AS product
       FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY a.i, b.i""",
)
def gram_wide(spark, folder):
    names = [f"x{i}" for i in range(64)]
    rows = table(spark, folder, "embeddings").select(
        *[F.get("embedding", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)], "label"
    )
    gram = linear.moments(rows, names, "label").gram
    cells = [(i, j, float(gram[i + 1, j + 1])) for i in range(64) for j in range(i, 64)]
    frame = spark.createDataFrame(cells, "i int, j int, product double")
    return frame.select("i", "j", r6(F.col("product"), 4).alias("product"))


ITERATIONS, ETA, L1, L2 = 10, 0.5, 3.0, 5.0


def logistic_ctes() -> str:
    z = "(quantity * w.w1 + discount * w.w2 + tax * w.w3)"
    p = f"(1 / (1 + exp(-{z})))"
    ctes = [
        f"train AS (SELECT * FROM {SCALED_ROWS} WHERE l_shipdate < '1998-01-01')",
        f"test AS (SELECT * FROM {SCALED_ROWS} WHERE l_shipdate >= '1998-01-01')",
        "w0 AS (SELECT 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, 0.0::DOUBLE AS w3)",
    ]
    penalty = f"({L1} * (abs(w1) + abs(w2) + abs(w3)) + 0.5 * {L2} * (w1 * w1 + w2 * w2 + w3 * w3))"
    for k in range(ITERATIONS):
        loss = f"-sum(y * ln({p}) + (1 - y) * ln(1 - {p}))"
        ctes.append(
            f"""s{k} AS (SELECT count(*) AS n, {loss} AS loss, sum(({p} - y) * quantity) AS g1, sum(({p} - y) * discount) AS g2,
                sum(({p} - y) * tax) AS g3 FROM train, w{k} w)"""
        )
        ctes.append(f"v{k} AS (SELECT count(*) AS n, {loss} AS loss FROM test, w{k} w)")
        step = ", ".join(
            f"w{i} - {ETA} * (g{i} + CASE WHEN w{i} >= 0 THEN {L1} ELSE -{L1} END + {L2} * w{i}) / n AS w{i}"
            for i in (1, 2, 3)
        )
        ctes.append(f"w{k + 1} AS (SELECT {step} FROM w{k}, s{k})")
        ctes.append(
            f"""curve{k} AS (SELECT {k} AS iter, (s{k}.loss + {penalty}) / s{k}.n AS cost, (v{k}.loss + {penalty}) / v{k}.n AS cost_test
                FROM s{k}, v{k}, w{k})"""
        )
    return "WITH " + ", ".join(ctes)


def logistic(spark, folder):
    rows = scaled(spark, folder)
    return linear.fit_logistic(
        rows.filter("l_shipdate < '1998-01-01'"),
        SCALED,
        "y",
        eta=ETA,
        rounds=ITERATIONS,
        l1=L1,
        l2=L2,
        test=rows.filter("l_shipdate >= '1998-01-01'"),
    )


@query(
    "logreg_gd",
    logistic_ctes()
    + " UNION ALL ".join(
        f" SELECT '{name}' AS term, round_even(w{i}, 8) + 0.0 AS weight FROM w{ITERATIONS - 1}"
        for i, name in enumerate(SCALED, start=1)
    )
    + " UNION ALL SELECT '(intercept)', 0.0",
)
def logreg_gd(spark, folder):
    return logistic(spark, folder).model.table(spark).select("term", r6(F.col("weight"), 8).alias("weight"))


@query(
    "logreg_curve",
    logistic_ctes()
    + " UNION ALL ".join(
        f" SELECT iter, round_even(cost, 8) AS cost, round_even(cost_test, 8) AS cost_test FROM curve{k}"
        for k in range(ITERATIONS)
    ),
)
def logreg_curve(spark, folder):
    curve = logistic(spark, folder).curve_table(spark)
    return curve.select("iter", r6(F.col("cost"), 8).alias("cost"), r6(F.col("cost_test"), 8).alias("cost_test"))


GAP = 0.004
POINTS = f"""(SELECT row_id, x1 + y * {GAP * 2}::DOUBLE AS x1, x2 + y * {GAP * 3}::DOUBLE AS x2, y FROM
    (SELECT *, CASE WHEN 0.0 + x1 * 2.0::DOUBLE + x2 * 3.0::DOUBLE <= 0 THEN -1 ELSE 1 END AS y FROM (SELECT o_orderkey AS row_id,
     ('0x' || substr(md5('x1:' || o_orderkey), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE * 20 - 10 AS x1,
     ('0x' || substr(md5('x2:' || o_orderkey), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE * 20 - 10 AS x2 FROM orders)))"""


# the loop itself: the first row on the wrong side moves the weights, until there is none
PERCEPTRON_SQL = f"""WITH RECURSIVE pts AS MATERIALIZED (SELECT * FROM {POINTS}),
    fit AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, 0 AS updates
      UNION ALL SELECT a + p.y * p.x1, b + p.y * p.x2, updates + 1 FROM
        (SELECT any_value(a) AS a, any_value(b) AS b, any_value(updates) AS updates,
          arg_min(struct_pack(y := y, x1 := x1, x2 := x2), row_id) FILTER (y * (x1 * a + x2 * b) <= 0) AS p FROM pts, fit)
      WHERE p IS NOT NULL),
    done AS (SELECT * FROM fit ORDER BY updates DESC LIMIT 1),
    wrong AS (SELECT count(*) AS n FROM pts, done WHERE y * (x1 * a + x2 * b) <= 0)
    SELECT 'x1' AS feature, round_even(a, 6) AS weight, updates, n = 0 AS separated FROM done, wrong
    UNION ALL SELECT 'x2', round_even(b, 6), updates, n = 0 FROM done, wrong"""


@query("perceptron_fit", PERCEPTRON_SQL)
def perceptron_fit(spark, folder):
    points = tables.separable_points(table(spark, folder, "orders"), "o_orderkey", [2.0, 3.0], gap=GAP)
    model = linear.fit_perceptron(points, ["x1", "x2"], "label", "row_id")
    return model.table(spark).select("feature", r6(F.col("weight")).alias("weight"), "updates", "separated")


@query(
    "log_loss",
    f"""SELECT count(*) AS "rows", round_even((-sum(y * ln(p) + (1 - y) * ln(1 - p)) + 2.0 * (0.4 + 1.5 + 2.5)
        + 0.5 * 3.0 * (0.4 * 0.4 + 1.5 * 1.5 + 2.5 * 2.5)) / count(*), 8) AS cost FROM
        (SELECT y, 1 / (1 + exp(-(-2.0::DOUBLE + quantity * 0.4::DOUBLE + discount * 1.5::DOUBLE + tax * 2.5::DOUBLE))) AS p FROM {SCALED_ROWS})""",
)
def log_loss(spark, folder):
    model = linear.LinearModel(tuple(SCALED), -2.0, (0.4, 1.5, 2.5), link="logit")
    cost = linear.logistic_cost(scaled(spark, folder), model, "y", l1=2.0, l2=3.0)
    return cost.select("rows", r6(F.col("cost"), 8).alias("cost"))


# the planted target is linear in its columns, so least squares must give it back
@query(
    "ml_linreg",
    f"""SELECT l_quantity, count(*) AS n, round_even(avg({PLANTED_TARGET}), 4) + 0.0 AS prediction FROM lineitem GROUP BY l_quantity""",
)
def ml_linreg(spark, folder):
    features = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]
    rows = lines(spark, folder).select(*features, "z")
    scored = fit_library_linear(rows, features, "z").score(rows)
    return scored.groupBy("l_quantity").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("prediction"), 4).alias("prediction")
    )


# a converged fit without a penalty gives each class its own share of the probability
@query(
    "ml_logreg",
    f"""SELECT count(*) AS n, round_even(1 - avg(y), 4) + 0.0 AS p0, round_even(avg(y), 4) + 0.0 AS p1 FROM {SCALED_ROWS}""",
)
def ml_logreg(spark, folder):
    rows = scaled(spark, folder).select(*SCALED, "y")
    scored = fit_library_logistic(rows, SCALED, "y").score(rows)
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        r6(F.avg(F.get("prediction", F.lit(0))), 4).alias("p0"),
        r6(F.avg(F.get("prediction", F.lit(1))), 4).alias("p1"),
    )


# labels of two features each, which a learner must combine; the third feature tells nothing
PLANTED = "(doc_id % 3 = 1) <> (length(source) = 5)"
PLANTED_CLASS = "(doc_id % 3 + CASE WHEN length(source) = 5 THEN 1 ELSE 0 END) % 3"


def labelled_documents(spark, folder):
    """All documents with the labels ``planted`` and ``class``."""
    return table(spark, folder, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        (F.col("doc_id") % 3).cast("double").alias("third"),
        F.length("source").cast("double").alias("source_length"),
        F.expr(PLANTED).cast("int").alias("planted"),
        F.expr(PLANTED_CLASS).cast("int").alias("class"),
    )


DOCUMENT_FEATURES = ["n_chars", "third", "source_length"]


@query("ml_gbt", f"SELECT doc_id, ({PLANTED})::INTEGER AS planted, ({PLANTED})::INTEGER AS predicted FROM documents")
def ml_gbt(spark, folder):
    rows = labelled_documents(spark, folder)
    learner = GbtLearner({"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3, "random_state": 7}, key="doc_id")
    scored = learner.fit(rows, DOCUMENT_FEATURES, "planted").score(rows, "p")
    return scored.select("doc_id", "planted", (F.col("p") > 0.5).cast("int").alias("predicted"))


@query(
    "ml_multiclass",
    f"""SELECT doc_id, ({PLANTED_CLASS})::INTEGER AS "class", ({PLANTED_CLASS})::INTEGER AS likeliest,
        ({PLANTED_CLASS})::INTEGER AS boosted FROM documents""",
)
def ml_multiclass(spark, folder):
    rows = labelled_documents(spark, folder)
    forest = ForestLearner({"numTrees": 15, "maxDepth": 5, "seed": 7, "featureSubsetStrategy": "all"}).fit(rows, DOCUMENT_FEATURES, "class")
    boosted = fit_one_vs_rest(rows, DOCUMENT_FEATURES, "class", n_estimators=4, max_depth=5, random_state=7)
    return boosted.score(forest.score(rows, "probabilities"), "boosted").select(
        "doc_id", "class", first_argmax(F.col("probabilities")).cast("int").alias("likeliest"),
        F.col("boosted").cast("int").alias("boosted"),
    )
