"""Logistic regression by Newton steps and by stochastic steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog import query, r6
from tabloom.catalog.linear import scaled, SCALED_ROWS
from tabloom.catalog.newton import NOISY_ROWS, noisy_orders
from tabloom.plans.logistic import first_time, fit_newton_logistic, fit_sgd_logistic

L2, STEPS = 2.0, 9
TERMS = {"(intercept)": "w0", "quantity": "w1", "discount": "w2"}


def newton_sql() -> str:
    """Newton steps with Cramer's rule; they are at the optimum long before the last."""
    p = "(1 / (1 + exp(-(w0 + w1 * quantity + w2 * discount))))"
    ctes = [f"pts AS MATERIALIZED (SELECT quantity, discount, y FROM {SCALED_ROWS})",
            "s0 AS (SELECT 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2)"]
    for k in range(STEPS):
        curve = ", ".join(
            f"sum({p} * (1 - {p}) * {x}) AS {n}"
            for n, x in (("a", "1"), ("b", "quantity"), ("c", "discount"), ("d", "quantity * quantity"),
                         ("e", "quantity * discount"), ("f", "discount * discount"))
        )
        slope = ", ".join(f"sum(({p} - y) * {x}) AS g{i}" for i, x in enumerate(("1", "quantity", "discount")))
        ctes.append(f"t{k} AS (SELECT w0, w1, w2, {curve}, {slope} FROM pts, s{k} GROUP BY ALL)")
        ctes.append(
            f"""u{k} AS (SELECT w0, w1, w2, a, b, c, d + {L2} AS d, e, f + {L2} AS f, g0, g1 + {L2} * w1 AS g1, g2 + {L2} * w2 AS g2 FROM t{k})"""
        )
        det = "(a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c))"
        ctes.append(
            f"""s{k + 1} AS MATERIALIZED (SELECT
                w0 - (g0 * (d * f - e * e) - b * (g1 * f - e * g2) + c * (g1 * e - d * g2)) / {det} AS w0,
                w1 - (a * (g1 * f - e * g2) - g0 * (b * f - e * c) + c * (b * g2 - g1 * c)) / {det} AS w1,
                w2 - (a * (d * g2 - g1 * e) - b * (b * g2 - g1 * c) + g0 * (b * e - d * c)) / {det} AS w2 FROM u{k})"""
        )
    return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(
        f"SELECT '{term}' AS term, round_even({w}, 6) + 0.0 AS weight FROM s{STEPS}" for term, w in TERMS.items()
    )


@query("logreg_newton", newton_sql())
def logreg_newton(spark, folder):
    model = fit_newton_logistic(scaled(spark, folder), ["quantity", "discount"], "y", l2=L2)
    return model.table(spark).select("term", r6(F.col("weight")).alias("weight"))


ALPHA, EPOCHS, SHARDS = 0.01, 2, 8


def sgd_sql() -> str:
    ctes = [
        f"""pts AS MATERIALIZED (SELECT shard, price / 50 AS p, month / 12 AS m, y, row_number() OVER (PARTITION BY shard
            ORDER BY md5('order:' || o_orderkey)) AS i, count(*) OVER (PARTITION BY shard) AS n FROM
            (SELECT *, ('0x' || substr(md5('shard:' || o_orderkey), 1, 8))::BIGINT % {SHARDS} AS shard FROM {NOISY_ROWS.format(folds=1)}))""",
        "w0 AS (SELECT 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2)",
    ]
    for k in range(EPOCHS):
        eta = f"(1 / ({ALPHA}::DOUBLE * ({first_time(ALPHA)!r}::DOUBLE + {k} * n + x.i - 1)))"
        ctes.append(
            f"""e{k} AS (SELECT shard, 0::BIGINT AS i, w0, w1, w2 FROM (SELECT DISTINCT shard FROM pts), w{k}
              UNION ALL SELECT shard, i, w0 - eta * g, w1 * (1 - eta * {ALPHA}) - eta * g * p, w2 * (1 - eta * {ALPHA}) - eta * g * m FROM
              (SELECT x.shard, x.i, w0, w1, w2, p, m, {eta} AS eta, 1 / (1 + exp(-(p * w1 + m * w2 + w0))) - y AS g
               FROM e{k} JOIN pts x ON x.shard = e{k}.shard AND x.i = e{k}.i + 1))"""
        )
        means = ", ".join(f"sum({w} * (n / total)) AS {w}" for w in ("w0", "w1", "w2"))
        ctes.append(
            f"""w{k + 1} AS MATERIALIZED (SELECT {means} FROM e{k} JOIN (SELECT DISTINCT shard, n FROM pts) s ON s.shard = e{k}.shard
                AND e{k}.i = s.n, (SELECT count(*) AS total FROM pts))"""
        )
    names = {"(intercept)": "w0", "price": "w1", "month": "w2"}
    return f"WITH RECURSIVE {', '.join(ctes)} " + " UNION ALL ".join(
        f"SELECT '{term}' AS term, round_even({w}, 6) + 0.0 AS weight FROM w{EPOCHS}" for term, w in names.items()
    )


@query("logreg_sgd", sgd_sql())
def logreg_sgd(spark, folder):
    rows = noisy_orders(spark, folder).select("o_orderkey", "y", (F.col("price") / 50).alias("price"), (F.col("month") / 12).alias("month"))
    model = fit_sgd_logistic(rows, ["price", "month"], "y", "o_orderkey", alpha=ALPHA, epochs=EPOCHS, shards=SHARDS)
    return model.table(spark).select("term", r6(F.col("weight")).alias("weight"))
