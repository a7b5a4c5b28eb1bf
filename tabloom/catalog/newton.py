"""Boosters with Newton leaves: single models, stacks stopped by their own folds, and a search in step."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog import query, r6
from tabloom.catalog.selection import FEATURES, orders
from tabloom.functions import hash_bucket
from tabloom.plans.newton import BETTER, GAIN_DIGITS, SCORE_STEPS, fit_newton_booster
from tabloom.plans.selection import search_boosters, stack_boosters

# labels that no booster can learn whole: a rule, turned over for a fifth of the keys
NOISE, CLASSES = 20, 3
BUCKET = "('0x' || substr(md5('{salt}' || o_orderkey), 1, 8))::BIGINT % {parts}"
NOISY_ROWS = f"""(SELECT o_orderkey, o_orderstatus, price, month, priority,
    {BUCKET.format(salt="", parts="{folds}")} AS fold,
    (((price > 25 AND priority <= 2) OR month > 10) <> ({BUCKET.format(salt="noise:", parts=100)} < {NOISE}))::INTEGER AS y,
    ((price > 18) <> (month > 6) AND {BUCKET.format(salt="noise:", parts=100)} >= {NOISE})::INTEGER AS either,
    CASE WHEN {BUCKET.format(salt="noise:", parts=100)} < {NOISE} THEN {BUCKET.format(salt="class:", parts=CLASSES)}
         WHEN price > 30 THEN 2 WHEN month > 6 THEN 1 ELSE 0 END AS kind
    FROM (SELECT o_orderkey, o_orderstatus, floor(o_totalprice / 10000)::DOUBLE AS price, month(o_orderdate)::DOUBLE AS month,
          substr(o_orderpriority, 1, 1)::DOUBLE AS priority FROM orders))"""
X = ", ".join(FEATURES)


def noisy_orders(spark, folder):
    noise, key = hash_bucket(F.col("o_orderkey"), 100, "noise:") < NOISE, F.col("o_orderkey")
    rule = F.expr("(price > 25 AND priority <= 2) OR month > 10")
    kind = F.expr("CASE WHEN price > 30 THEN 2 WHEN month > 6 THEN 1 ELSE 0 END")
    return orders(spark, folder).withColumns(
        {
            "y": (rule != noise).cast("int"),
            "either": (F.expr("(price > 18) <> (month > 6)") & ~noise).cast("int"),
            "kind": F.when(noise, hash_bucket(key, CLASSES, "class:")).otherwise(kind).cast("int"),
        }
    )


class Sql:
    """CTEs of a boosting run: rows keep a margin per class, trees are fitted on the rows where ``fit`` holds."""

    def __init__(self, folds: int, label: str, *, rate: float, penalty: float, depth: int, rounds: int, fewest: int = 20):
        self.label, self.rate, self.penalty, self.depth, self.rounds, self.fewest = label, rate, penalty, depth, rounds, fewest
        self.parts = [
            f"o AS MATERIALIZED {NOISY_ROWS.format(folds=folds)}",
            f"""xs AS (SELECT DISTINCT feature, x FROM (SELECT unnest([0, 1, 2]) AS feature, unnest([{X}]) AS x
                FROM o WHERE o_orderstatus <> 'P'))""",
            "mids AS MATERIALIZED (SELECT feature, x, (x + lead(x) OVER (PARTITION BY feature ORDER BY x)) / 2 AS mid FROM xs)",
        ]

    def text(self) -> str:
        return "WITH " + ", ".join(self.parts)

    def tree(self, p: str, rows: str, depth: int) -> str:
        """Grow on columns g and h of the rows to fit, route all rows; the relation with their ``node`` and ``v``."""
        self.parts.append(f"{p}_r0 AS MATERIALIZED (SELECT *, 1 AS node FROM {rows})")
        for k in range(depth):
            worth = lambda g, h: f"({g}) * ({g}) / ({h} + {self.penalty})"
            self.parts += [
                f"""{p}_c{k} AS (SELECT node, feature, x, sum(g) AS g, sum(h) AS h, count(*) AS n FROM (SELECT node, g, h,
                    unnest([0, 1, 2]) AS feature, unnest([{X}]) AS x FROM {p}_r{k} WHERE fit) GROUP BY ALL)""",
                f"""{p}_w{k} AS (SELECT node, feature, x, {', '.join(f'sum({m}) OVER u AS {m}l, sum({m}) OVER a AS {m}a' for m in 'ghn')}
                    FROM {p}_c{k} WINDOW u AS (PARTITION BY node, feature ORDER BY x ROWS UNBOUNDED PRECEDING),
                    a AS (PARTITION BY node, feature))""",
                f"""{p}_b{k} AS MATERIALIZED (SELECT node, feature, x, mid, gain FROM (SELECT *, {worth('gl', 'hl')}
                    + {worth('ga - gl', 'ha - hl')} - {worth('ga', 'ha')} AS gain FROM {p}_w{k} JOIN mids USING (feature, x))
                    WHERE nl >= {self.fewest} AND na - nl >= {self.fewest} AND round(gain, {GAIN_DIGITS}) > 0
                    QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, {GAIN_DIGITS}) DESC, feature, x) = 1)""",
                f"""{p}_r{k + 1} AS MATERIALIZED (SELECT r.* REPLACE (CASE WHEN b.mid IS NULL THEN r.node ELSE 2 * r.node
                    + (CASE b.feature WHEN 0 THEN price WHEN 1 THEN month ELSE priority END > b.mid)::INTEGER END AS node)
                    FROM {p}_r{k} r LEFT JOIN {p}_b{k} b ON b.node = r.node)""",
            ]
        self.parts += [
            f"""{p}_leaf AS MATERIALIZED (SELECT node, -{self.rate}::DOUBLE * sum(g) / (sum(h) + {self.penalty}) AS v,
                count(*) AS n FROM {p}_r{depth} WHERE fit GROUP BY node)""",
            f"{p} AS MATERIALIZED (SELECT r.*, v FROM {p}_r{depth} r JOIN {p}_leaf USING (node))",
        ]
        return p

    def binary(self, p: str, fit: str, depth: int | None = None) -> None:
        """Relations ``{p}_0 .. {p}_{rounds}`` with the margin f after so many rounds."""
        keep = f"o_orderkey, o_orderstatus, fold, {X}, t, fit"
        self.parts += [
            f"{p}_in AS MATERIALIZED (SELECT o_orderkey, o_orderstatus, fold, {X}, {self.label} AS t, {fit} AS fit FROM o)",
            f"{p}_0 AS (SELECT *, (SELECT ln(sum(t) / sum(1 - t)) FROM {p}_in WHERE fit) AS f FROM {p}_in)",
        ]
        for k in range(1, self.rounds + 1):
            self.parts.append(f"{p}_p{k} AS (SELECT *, 1 / (1 + exp(-f)) AS q FROM {p}_{k - 1})")
            self.parts.append(f"{p}_g{k} AS (SELECT *, q - t AS g, q * (1 - q) AS h FROM {p}_p{k})")
            grown = self.tree(f"{p}_t{k}", f"{p}_g{k}", depth or self.depth)
            self.parts.append(f"{p}_{k} AS MATERIALIZED (SELECT {keep}, f + v AS f FROM {grown})")

    def multi(self, p: str, fit: str) -> None:
        """As ``binary`` with margins f0, f1, .. of all classes."""
        keep = f"o_orderkey, o_orderstatus, fold, {X}, t, fit"
        starts = ", ".join(
            f"(SELECT ln(count(*) FILTER (t = {c}) / count(*)) FROM {p}_in WHERE fit) AS f{c}" for c in range(CLASSES)
        )
        fs = ", ".join(f"f{c}" for c in range(CLASSES))
        self.parts += [
            f"{p}_in AS MATERIALIZED (SELECT o_orderkey, o_orderstatus, fold, {X}, {self.label} AS t, {fit} AS fit FROM o)",
            f"{p}_0 AS (SELECT *, {starts} FROM {p}_in)",
        ]
        for k in range(1, self.rounds + 1):
            total = " + ".join(f"exp(f{c} - greatest({fs}))" for c in range(CLASSES))
            qs = ", ".join(f"exp(f{c} - greatest({fs})) / ({total}) AS q{c}" for c in range(CLASSES))
            rows = f"{p}_p{k}"
            self.parts.append(f"{rows} AS MATERIALIZED (SELECT *, {qs} FROM {p}_{k - 1})")
            for c in range(CLASSES):
                given = f"{p}_g{k}_{c}"
                self.parts.append(f"{given} AS (SELECT *, q{c} - (t = {c})::INTEGER AS g, q{c} * (1 - q{c}) AS h FROM {rows})")
                grown = self.tree(f"{p}_t{k}_{c}", given, self.depth)
                rows = f"{grown}_v"
                self.parts.append(f"{rows} AS (SELECT * EXCLUDE (node, g, h, v), v AS v{c} FROM {grown})")
            self.parts.append(
                f"{p}_{k} AS MATERIALIZED (SELECT {keep}, {', '.join(f'f{c} + v{c} AS f{c}' for c in range(CLASSES))} FROM {rows})"
            )

    def stopped(self, models: list[str], value: str, patience: int) -> None:
        """``best`` (model, best): rounds are judged by ``value`` of ({p}, {k}) until ``patience`` have not been better."""
        judged = " UNION ALL ".join(
            f"SELECT {i} AS model, {k} AS k, {value.format(p=p, k=k, i=i)} AS value"
            for i, p in enumerate(models) for k in range(1, self.rounds + 1)
        )
        self.parts += [
            f"judged AS MATERIALIZED ({judged})",
            f"""records AS (SELECT *, coalesce(value > max(value) OVER (PARTITION BY model ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING
                AND 1 PRECEDING) + {BETTER}, true) AS record FROM judged)""",
            """upto AS (SELECT *, max(CASE WHEN record THEN k END) OVER (PARTITION BY model ORDER BY k) AS best FROM records)""",
            f"""ends AS (SELECT model, coalesce(min(k) FILTER (k - best >= {patience}), {self.rounds}) AS stop FROM upto GROUP BY model)""",
            "best AS MATERIALIZED (SELECT model, best, stop FROM upto JOIN ends USING (model) WHERE k = stop)",
        ]


def stopping_auc(held: str) -> str:
    """Share of ordered pairs over probabilities at the resolution of the stopping metric."""
    cells = f"""SELECT round(q * {SCORE_STEPS}) AS s, sum(t) AS pos, sum(1 - t) AS neg FROM
        (SELECT t, 1 / (1 + exp(-f)) AS q FROM {{p}}_{{k}} WHERE {held}) GROUP BY s"""
    return f"""(SELECT sum(pos * (below - neg / 2)) / (sum(pos) * sum(neg))
        FROM (SELECT *, sum(neg) OVER (ORDER BY s) AS below FROM ({cells})))"""


def macro_f1(held: str) -> str:
    guess = "CASE WHEN f0 >= f1 AND f0 >= f2 THEN 0 WHEN f1 >= f2 THEN 1 ELSE 2 END"
    cells = f"SELECT t, {guess} AS c FROM {{p}}_{{k}} WHERE {held}"
    sides = f"""SELECT t AS class, (t = c)::INTEGER AS tp, 0 AS fp, (t <> c)::INTEGER AS fn FROM ({cells})
        UNION ALL SELECT c, 0, (t <> c)::INTEGER, 0 FROM ({cells})"""
    return f"(SELECT avg(f1) FROM (SELECT 2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) AS f1 FROM ({sides}) GROUP BY class))"


ONE = {"n_estimators": 2, "learning_rate": 0.3, "max_depth": 2, "num_leaves": 4, "reg_lambda": 1.0, "min_child_samples": 20}


def leaves_sql(names: list[tuple[int, int, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT {k} AS round, {c} AS class, node, round_even(v, 6) + 0.0 AS step, n FROM {name}_leaf" for k, c, name in names
    )


def leaf_rows(model, spark):
    nodes = model.table(spark).where("is_leaf")
    return nodes.select(
        "round", "class", F.col("node_id").alias("node"), r6(F.col("prediction").cast("double")).alias("step"), "n"
    )


def binary_sql() -> str:
    sql = Sql(1, "y", rate=0.3, penalty=1.0, depth=2, rounds=2)
    sql.binary("m", "o_orderstatus <> 'P'")
    return sql.text() + " " + leaves_sql([(k, 0, f"m_t{k}") for k in (1, 2)])


@query("boosted_binary", binary_sql())
def boosted_binary(spark, folder):
    rows = noisy_orders(spark, folder).where("o_orderstatus <> 'P'")
    return leaf_rows(fit_newton_booster(rows, FEATURES, "y", "binary", **ONE), spark)


def multi_sql() -> str:
    sql = Sql(1, "kind", rate=0.3, penalty=1.0, depth=2, rounds=2)
    sql.multi("m", "o_orderstatus <> 'P'")
    return sql.text() + " " + leaves_sql([(k, c, f"m_t{k}_{c}") for k in (1, 2) for c in range(CLASSES)])


@query("boosted_multi", multi_sql())
def boosted_multi(spark, folder):
    rows = noisy_orders(spark, folder).where("o_orderstatus <> 'P'")
    return leaf_rows(fit_newton_booster(rows, FEATURES, "kind", "multiclass", **ONE), spark)


FOLDS, PATIENCE, ROUNDS = 3, 2, 8
STOPPED = {**ONE, "n_estimators": ROUNDS, "learning_rate": 0.8, "early_stopping_rounds": PATIENCE}


def oof_binary_sql() -> str:
    sql = Sql(FOLDS, "y", rate=0.8, penalty=1.0, depth=2, rounds=ROUNDS)
    models = [f"m{fold}" for fold in range(FOLDS)]
    for fold, p in enumerate(models):
        sql.binary(p, f"o_orderstatus <> 'P' AND fold <> {fold}")
    sql.stopped(models, stopping_auc("o_orderstatus <> 'P' AND fold = {i}"), PATIENCE)
    return sql.text()


def every_round(models: list[str], rounds: int, columns: str) -> str:
    return " UNION ALL ".join(
        f"SELECT o_orderkey, o_orderstatus, fold, {i} AS model, {k} AS k, {columns} FROM {p}_{k}"
        for i, p in enumerate(models) for k in range(1, rounds + 1)
    )


@query(
    "oof_boosted_binary",
    oof_binary_sql()
    + f""", scores AS (SELECT * FROM ({every_round([f'm{f}' for f in range(FOLDS)], ROUNDS, '1 / (1 + exp(-f)) AS p')}) JOIN best
          USING (model) WHERE k = best)
        SELECT o_orderkey, fold::INTEGER AS fold, best::INTEGER AS best_round, round_even(p, 6) AS score FROM scores
          WHERE o_orderstatus <> 'P' AND model = fold
        UNION ALL SELECT o_orderkey, -1, NULL, round_even(avg(p), 6) FROM scores WHERE o_orderstatus = 'P' GROUP BY o_orderkey""",
)
def oof_boosted_binary(spark, folder):
    rows = noisy_orders(spark, folder)
    stack = stack_boosters(
        rows.where("o_orderstatus <> 'P'"), rows.where("o_orderstatus = 'P'"), FEATURES, "y", "o_orderkey",
        folds=FOLDS, **STOPPED,
    )
    best = F.element_at(F.array(*[F.lit(len(m.rounds)) for m in stack.models]), F.col("fold") + 1)
    train = stack.oof.select("o_orderkey", "fold", best.alias("best_round"), r6(F.col("score")).alias("score"))
    none = F.lit(None).cast("int").alias("best_round")
    test = stack.test.select("o_orderkey", F.lit(-1).alias("fold"), none, r6(F.col("score")).alias("score"))
    return train.unionByName(test)


@query(
    "oof_boosted_rounds",
    oof_binary_sql()
    + """ SELECT (model + 1)::INTEGER AS fold, k::INTEGER AS round, round_even(value, 8) AS value, k = b.best AS best
          FROM judged JOIN best b USING (model) WHERE k <= stop""",
)
def oof_boosted_rounds(spark, folder):
    rows = noisy_orders(spark, folder).where("o_orderstatus <> 'P'")
    stack = stack_boosters(rows, rows.limit(0), FEATURES, "y", "o_orderkey", folds=FOLDS, **STOPPED)
    return stack.rounds(spark).select("fold", "round", r6(F.col("value"), 8).alias("value"), "best")


MULTI_FOLDS, MULTI_ROUNDS = 2, 4
MULTI = {**STOPPED, "n_estimators": MULTI_ROUNDS, "early_stopping_rounds": 1}


def oof_multi_sql() -> str:
    sql = Sql(MULTI_FOLDS, "kind", rate=0.8, penalty=1.0, depth=2, rounds=MULTI_ROUNDS)
    models = [f"m{fold}" for fold in range(MULTI_FOLDS)]
    for fold, p in enumerate(models):
        sql.multi(p, f"o_orderstatus <> 'P' AND fold <> {fold}")
    sql.stopped(models, macro_f1("o_orderstatus <> 'P' AND fold = {i}"), 1)
    total = " + ".join(f"exp(f{c})" for c in range(CLASSES))
    columns = ", ".join(f"exp(f{c}) / ({total}) AS p{c}" for c in range(CLASSES))
    shown = ", ".join(f"round_even(p{c}, 6) + 0.0 AS p{c}" for c in range(CLASSES))
    means = ", ".join(f"round_even(avg(p{c}), 6) + 0.0" for c in range(CLASSES))
    guess = "CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END"
    return (
        sql.text()
        + f""", scores AS (SELECT * FROM ({every_round(models, MULTI_ROUNDS, columns)}) JOIN best USING (model) WHERE k = best)
        SELECT o_orderkey, fold::INTEGER AS fold, best::INTEGER AS best_round, {shown}, {guess} AS predicted FROM scores
          WHERE o_orderstatus <> 'P' AND model = fold
        UNION ALL SELECT o_orderkey, -1, NULL, {means}, -1 FROM scores WHERE o_orderstatus = 'P' GROUP BY o_orderkey"""
    )


@query("oof_boosted_multi", oof_multi_sql())
def oof_boosted_multi(spark, folder):
    rows = noisy_orders(spark, folder)
    stack = stack_boosters(
        rows.where("o_orderstatus <> 'P'"), rows.where("o_orderstatus = 'P'"), FEATURES, "kind", "o_orderkey",
        objective="multiclass", folds=MULTI_FOLDS, **MULTI,
    )
    best = F.element_at(F.array(*[F.lit(len(m.rounds)) for m in stack.models]), F.col("fold") + 1)
    shares = [r6(F.get("score", F.lit(c))).alias(f"p{c}") for c in range(CLASSES)]
    train = stack.oof.select("o_orderkey", "fold", best.alias("best_round"), *shares, "predicted")
    none = F.lit(None).cast("int").alias("best_round")
    test = stack.test.select("o_orderkey", F.lit(-1).alias("fold"), none, *shares, F.lit(-1).alias("predicted"))
    return train.unionByName(test)


# the label is true where one of two conditions holds but not both: trees of depth 1 cannot tell, so the trials differ
TRIAL_DEPTHS, TRIAL_FOLDS = (1, 2), 2


def search_sql() -> str:
    sql = Sql(TRIAL_FOLDS, "either", rate=0.3, penalty=1.0, depth=2, rounds=2)
    values = []
    for i, depth in enumerate(TRIAL_DEPTHS, start=1):
        for fold in range(TRIAL_FOLDS):
            p = f"m{i}_{fold}"
            sql.binary(p, f"fold <> {fold}", depth)
            cells = f"SELECT f AS s, sum(t) AS pos, sum(1 - t) AS neg FROM {p}_2 WHERE fold = {fold} GROUP BY f"
            values.append(
                f"""SELECT {i} AS trial, {depth} AS depth, (SELECT sum(pos * (below - neg / 2)) / (sum(pos) * sum(neg)) FROM
                    (SELECT *, sum(neg) OVER (ORDER BY s) AS below FROM ({cells}))) AS value"""
            )
    sql.parts = [x.replace("FROM o WHERE o_orderstatus <> 'P'", "FROM o") for x in sql.parts]
    return f"""{sql.text()} SELECT trial, depth::DOUBLE AS max_depth, round_even(avg(value), 6) AS value
        FROM ({' UNION ALL '.join(values)}) GROUP BY trial, depth"""


@query("boosted_search", search_sql())
def boosted_search(spark, folder):
    settings = [{**ONE, "max_depth": depth} for depth in TRIAL_DEPTHS]
    found = search_boosters(noisy_orders(spark, folder), FEATURES, "either", "o_orderkey", settings, folds=TRIAL_FOLDS)
    return found.select("trial", F.col("setting")["max_depth"].alias("max_depth"), r6(F.col("value")).alias("value"))
