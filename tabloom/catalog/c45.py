"""C4.5 over categorical and numeric columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabloom.catalog import query
from tabloom.catalog.newton import NOISY_ROWS, noisy_orders
from tabloom.plans.c45 import fit_c45_tree

CATEGORIES, NUMBERS = ["status", "priority"], ["price", "month"]
DEPTH, DELTA, FEWEST = 3, 0.005, 10
ROWS = f"""(SELECT o_orderstatus AS status, priority::INTEGER::VARCHAR AS priority, price, month, y FROM {NOISY_ROWS.format(folds=1)})"""
NAMES = [*CATEGORIES, *NUMBERS]


def entropy(pos: str, n: str) -> str:
    return f"(CASE WHEN {pos} IN (0, {n}) THEN 0 ELSE -({pos} / {n}) * log2({pos} / {n}) - (1 - {pos} / {n}) * log2(1 - {pos} / {n}) END)"


def c45_sql() -> str:
    cats = ", ".join(str(i) for i in range(len(CATEGORIES)))
    nums = ", ".join(str(i + len(CATEGORIES)) for i in range(len(NUMBERS)))
    name = f"CASE feature {' '.join(f'''WHEN {i} THEN '{n}' ''' for i, n in enumerate(NAMES))} END"
    ctes = [
        f"base AS MATERIALIZED (SELECT * FROM {ROWS})",
        f"""domain AS (SELECT DISTINCT feature, value FROM (SELECT unnest([{cats}]) AS feature, unnest([{', '.join(CATEGORIES)}]) AS value FROM base))""",
        "nodes0 AS (SELECT '' AS path, '' AS parent, 0 AS depth, (2 * sum(y) > count(*))::INTEGER AS guess, count(*) AS n, sum(y) AS pos FROM base)",
        "rows0 AS (SELECT '' AS path, [-1] AS used, * FROM base)",
    ]
    for k in range(DEPTH):
        ctes += [
            f"open{k} AS MATERIALIZED (SELECT path, n, pos FROM nodes{k} WHERE pos > 0 AND pos < n AND n >= 2)",
            f"""val{k} AS MATERIALIZED (SELECT path, feature, value, count(*) AS n, sum(y) AS pos FROM (SELECT path, used, y,
                unnest([{cats}]) AS feature, unnest([{', '.join(CATEGORIES)}]) AS value FROM rows{k})
                WHERE NOT list_contains(used, feature) GROUP BY ALL)""",
            f"""cat{k} AS (SELECT path, feature, {entropy('any_value(o.pos)', 'any_value(o.n)')} - sum(v.n / o.n * {entropy('v.pos', 'v.n')}) AS g,
                -sum(v.n / o.n * log2(v.n / o.n)) AS iv, NULL::DOUBLE AS t FROM val{k} v JOIN open{k} o USING (path) GROUP BY path, feature)""",
            f"""num{k} AS (SELECT path, feature, x, count(*) AS n, sum(y) AS pos FROM (SELECT path, y, unnest([{nums}]) AS feature,
                unnest([{', '.join(NUMBERS)}]) AS x FROM rows{k}) GROUP BY ALL)""",
            f"""cum{k} AS (SELECT path, feature, (x + lead(x) OVER w) / 2 AS t, sum(n) OVER w AS nl, sum(pos) OVER w AS pl FROM num{k}
                WINDOW w AS (PARTITION BY path, feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
            f"""cut{k} AS (SELECT path, feature, t, nl, pl, o.n - nl AS nh, o.pos - pl AS ph, {entropy('o.pos', 'o.n')}
                - nl / o.n * {entropy('pl', 'nl')} - (o.n - nl) / o.n * {entropy('(o.pos - pl)', '(o.n - nl)')} AS g,
                -(nl / o.n) * log2(nl / o.n) - ((o.n - nl) / o.n) * log2((o.n - nl) / o.n) AS iv
                FROM cum{k} JOIN open{k} o USING (path) WHERE t IS NOT NULL AND nl >= {FEWEST} AND o.n - nl >= {FEWEST})""",
            f"""top{k} AS MATERIALIZED (SELECT * FROM cut{k} QUALIFY row_number() OVER (PARTITION BY path, feature ORDER BY round_even(g, 10) DESC, t) = 1)""",
            f"""opt{k} AS (SELECT *, CASE WHEN round_even(iv, 12) = 0 THEN 0 ELSE g / iv END AS ratio, avg(g) OVER (PARTITION BY path) AS average
                FROM (SELECT path, feature, g, iv, t FROM cat{k} UNION ALL SELECT path, feature, g, iv, t FROM top{k}))""",
            f"""best{k} AS MATERIALIZED (SELECT path, feature, t, {name} AS name FROM (SELECT * FROM opt{k} WHERE g >= average - 1e-12
                QUALIFY row_number() OVER (PARTITION BY path ORDER BY round_even(ratio, 10) DESC, feature) = 1) WHERE ratio >= {DELTA})""",
            f"""nodes{k + 1} AS MATERIALIZED (SELECT b.path || '/' || b.name || '=' || d.value AS path, b.path AS parent, {k + 1} AS depth,
                CASE WHEN v.n IS NULL THEN p.guess ELSE (2 * v.pos > v.n)::INTEGER END AS guess, coalesce(v.n, 0) AS n, coalesce(v.pos, 0) AS pos
                FROM best{k} b JOIN domain d ON d.feature = b.feature JOIN nodes{k} p ON p.path = b.path
                LEFT JOIN val{k} v ON v.path = b.path AND v.feature = b.feature AND v.value = d.value WHERE b.t IS NULL
                UNION ALL SELECT b.path || '/' || b.name || '<=' || printf('%.2f', b.t), b.path, {k + 1}, (2 * pl > nl)::INTEGER, nl, pl
                FROM best{k} b JOIN top{k} c ON c.path = b.path AND c.feature = b.feature WHERE b.t IS NOT NULL
                UNION ALL SELECT b.path || '/' || b.name || '>' || printf('%.2f', b.t), b.path, {k + 1}, (2 * ph > nh)::INTEGER, nh, ph
                FROM best{k} b JOIN top{k} c ON c.path = b.path AND c.feature = b.feature WHERE b.t IS NOT NULL)""",
            f"""rows{k + 1} AS MATERIALIZED (SELECT r.path || '/' || b.name || CASE WHEN b.t IS NULL THEN '=' || (CASE b.feature
                {' '.join(f'WHEN {i} THEN r.{c}' for i, c in enumerate(CATEGORIES))} END)
                WHEN (CASE b.feature {' '.join(f'WHEN {i + len(CATEGORIES)} THEN r.{c}' for i, c in enumerate(NUMBERS))} END) <= b.t
                THEN '<=' || printf('%.2f', b.t) ELSE '>' || printf('%.2f', b.t) END AS path,
                CASE WHEN b.t IS NULL THEN list_append(r.used, b.feature) ELSE r.used END AS used, r.* EXCLUDE (path, used)
                FROM rows{k} r JOIN best{k} b ON b.path = r.path)""",
        ]
    everything = " UNION ALL ".join(f"SELECT * FROM nodes{k}" for k in range(DEPTH + 1))
    return f"""WITH {', '.join(ctes)}, everything AS ({everything}) SELECT path, depth, guess AS prediction, n::BIGINT AS n,
        NOT EXISTS (SELECT 1 FROM everything c WHERE c.parent = a.path AND c.depth > 0) AS is_leaf FROM everything a"""


def fitted(spark, folder):
    rows = noisy_orders(spark, folder).select(
        F.col("o_orderstatus").alias("status"), F.col("priority").cast("string").alias("priority"), "price", "month", "y"
    )
    return fit_c45_tree(rows, CATEGORIES, NUMBERS, "y", delta=DELTA, max_depth=DEPTH, min_samples_leaf=FEWEST)


@query("c45_mixed", c45_sql())
def c45_mixed(spark, folder):
    tree, paths, rows = fitted(spark, folder), {}, []
    for node in tree.nodes:
        value = f"{node.value:.2f}" if isinstance(node.value, float) else node.value
        step = "" if node.feature is None else f"/{node.feature}{node.op}{value}"
        paths[node.node_id] = paths.get(node.parent_id, "") + step
        rows.append((paths[node.node_id], node.depth, node.prediction, node.n, not tree.children(node)))
    return spark.createDataFrame(rows, "path string, depth int, prediction int, n long, is_leaf boolean")
