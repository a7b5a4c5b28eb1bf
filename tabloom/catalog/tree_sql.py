"""SQL that grows trees and boosters level by level, as a check on the Spark fits.

It shares no code with them: every candidate is joined to every value of its feature
and all sums are taken anew.
"""

from __future__ import annotations

from collections.abc import Sequence


def cart_levels(
    prefix: str,
    rows: str,
    features: Sequence[str],
    target: str,
    depth: int,
    kind: str,
    min_split: int = 5,
    min_leaf: int = 1,
    impurity: float = 0.005,
) -> list[str]:
    """CTEs ``<prefix>_rows<k>`` (rows with heap node ids) and ``<prefix>_best<k>`` (splits).

    ``rows`` names a relation with a key-free set of columns that includes the features
    and the target; its columns are carried along.
    """
    ctes = [f"{prefix}_rows0 AS (SELECT 1::BIGINT AS node, * FROM {rows})"]
    for level in range(depth):
        here = f"{prefix}_rows{level}"
        long = " UNION ALL ".join(
            f"SELECT node, {i} AS feature, {f}::DOUBLE AS x, {target}::DOUBLE AS t_ FROM {here} WHERE node >= {2 ** level}"
            for i, f in enumerate(features)
        )
        p = f"{prefix}{level}"
        ctes.append(
            f"{p}_vals AS (SELECT node, feature, x, count(*) AS n, sum(t_) AS s, sum(t_ * t_) AS q FROM ({long}) GROUP BY ALL)"
        )
        ctes.append(
            f"""{p}_cand AS (SELECT DISTINCT node, feature, t FROM (SELECT node, feature, round_even((x + lead(x) OVER
                (PARTITION BY node, feature ORDER BY x)) / 2, 4) AS t FROM {p}_vals) WHERE t IS NOT NULL)"""
        )
        ctes.append(
            f"""{p}_side AS (SELECT c.node, c.feature, c.t,
                sum(v.n) FILTER (v.x <= c.t) AS nl, sum(v.n) FILTER (v.x > c.t) AS nh,
                sum(v.s) FILTER (v.x <= c.t) AS sl, sum(v.s) FILTER (v.x > c.t) AS sh,
                sum(v.q) FILTER (v.x <= c.t) AS ql, sum(v.q) FILTER (v.x > c.t) AS qh
                FROM {p}_cand c JOIN {p}_vals v USING (node, feature) GROUP BY ALL HAVING nl > 0 AND nh > 0)"""
        )
        if kind == "class":
            g = "(1 - ({s} / {n}) * ({s} / {n}) - (1 - {s} / {n}) * (1 - {s} / {n}))"
            low, high = g.format(s="sl", n="nl"), g.format(s="sh", n="nh")
            node_impurity = g.format(s="(sl + sh)", n="(nl + nh)")
            metric = f"round_even((nl * {low} + nh * {high}) / (nl + nh), 12)"
            order, allowed = "metric, feature, t", f"node_metric >= {impurity} AND node_metric > 0"
        else:
            node_impurity = "(ql + qh - (sl + sh) * (sl + sh) / (nl + nh))"
            metric = f"round_even((ql - sl * sl / nl + qh - sh * sh / nh) / {node_impurity}, 10)"
            order, allowed = "metric, feature DESC, t", "node_metric > 1e-6"
        ctes.append(
            f"""{p}_rank AS (SELECT *, row_number() OVER (PARTITION BY node ORDER BY {order}) AS place FROM
                (SELECT *, {metric} AS metric, {node_impurity} AS node_metric FROM {p}_side))"""
        )
        ctes.append(
            f"""{prefix}_best{level} AS (SELECT * FROM {p}_rank WHERE place = 1 AND nl + nh >= {min_split}
                AND least(nl, nh) >= {min_leaf} AND {allowed})"""
        )
        value = "CASE b.feature " + " ".join(f"WHEN {i} THEN r.{f}" for i, f in enumerate(features)) + " END"
        ctes.append(
            f"""{prefix}_rows{level + 1} AS (SELECT CASE WHEN b.node IS NULL THEN r.node
                WHEN {value} <= b.t THEN 2 * r.node ELSE 2 * r.node + 1 END AS node, r.* EXCLUDE (node)
                FROM {here} r LEFT JOIN {prefix}_best{level} b ON r.node = b.node)"""
        )
    return ctes


def cart_nodes(prefix: str, features: Sequence[str], target: str, depth: int, kind: str) -> str:
    """SELECT of the node table of a grown tree."""
    names = "CASE feature " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(features)) + " END"
    split = " UNION ALL ".join(f"SELECT node FROM {prefix}_best{level}" for level in range(depth))
    if kind == "class":
        guess = "CASE WHEN {s} > {n} - {s} THEN 1 ELSE 0 END::DOUBLE"
    else:
        guess = "round_even(round({s} / {n}, 8), 6) + 0.0"
    parts = [
        f"""SELECT 1::BIGINT AS node_id, 0::BIGINT AS parent_id, 0 AS depth, '' AS feature, '' AS op, 0.0::DOUBLE AS value,
            {guess.format(s=f"sum({target})", n="count(*)")} AS prediction, count(*)::BIGINT AS n FROM {prefix}_rows0"""
    ]
    for level in range(depth):
        for step, op, side in ((0, "<=", "l"), (1, ">", "h")):
            parts.append(
                f"""SELECT 2 * node + {step}, node, {level + 1}, {names}, '{op}', t,
                    {guess.format(s="s" + side, n="n" + side)}, n{side}::BIGINT FROM {prefix}_best{level}"""
            )
    return f"""SELECT a.*, NOT EXISTS (SELECT 1 FROM ({split}) s WHERE s.node = a.node_id) AS is_leaf
               FROM ({' UNION ALL '.join(parts)}) a"""


def cart_tree(rows: str, features: Sequence[str], target: str, depth: int, kind: str, **stops) -> str:
    ctes = cart_levels("t", rows, features, target, depth, kind, **stops)
    return f"WITH {', '.join(ctes)} {cart_nodes('t', features, target, depth, kind)}"


def category_tree(rows: str, features: Sequence[str], levels: int, method: str, delta: float) -> str:
    """Multiway tree; a node is named by its path of ``/feature=value`` steps."""
    long = " UNION ALL ".join(
        f"SELECT {i} AS feature, '{f}' AS name, {f}::VARCHAR AS value FROM base" for i, f in enumerate(features)
    )
    ctes = [
        f"base AS (SELECT * FROM {rows})",
        f"domain AS (SELECT DISTINCT feature, name, value FROM ({long}))",
        """root AS (SELECT '' AS path, '' AS parent, 0 AS depth, CASE WHEN 2 * sum(y) > count(*) THEN 1 ELSE 0 END AS guess,
           count(*) AS n, sum(y) AS pos FROM base)""",
        "nodes0 AS (SELECT * FROM root)",
        "rows0 AS (SELECT '' AS path, [-1] AS used, * FROM base)",
    ]
    for k in range(levels):
        cells = " UNION ALL ".join(
            f"SELECT path, {i} AS feature, {f}::VARCHAR AS value, y FROM rows{k} WHERE NOT list_contains(used, {i})"
            for i, f in enumerate(features)
        )
        score = "g" if method == "ID3" else "CASE WHEN round_even(iv, 12) = 0 THEN 0 ELSE g / iv END"
        left = "" if k == 0 else f"AND {len(features) - k} > 1"
        ctes += [
            f"val{k} AS (SELECT path, feature, value, count(*) AS n, sum(y) AS pos FROM ({cells}) GROUP BY ALL)",
            f"""open{k} AS (SELECT path, n, pos FROM nodes{k} WHERE pos > 0 AND pos < n)""",
            f"""term{k} AS (SELECT v.*, o.n AS total, o.pos AS total_pos,
                CASE WHEN v.pos IN (0, v.n) THEN 0 ELSE -(v.pos / v.n) * log2(v.pos / v.n)
                - (1 - v.pos / v.n) * log2(1 - v.pos / v.n) END AS h FROM val{k} v JOIN open{k} o ON v.path = o.path)""",
            f"""gain{k} AS (SELECT path, feature, -(any_value(total_pos / total)) * log2(any_value(total_pos / total))
                - (1 - any_value(total_pos / total)) * log2(1 - any_value(total_pos / total)) - sum(n / total * h) AS g,
                -sum(n / total * log2(n / total)) AS iv FROM term{k} GROUP BY ALL)""",
            f"""best{k} AS (SELECT path, feature, score FROM (SELECT path, feature, {score} AS score, row_number() OVER
                (PARTITION BY path ORDER BY round_even({score}, 10) DESC, feature) AS place FROM gain{k})
                WHERE place = 1 AND score >= {delta} {left})""",
            f"""nodes{k + 1} AS (SELECT b.path || '/' || d.name || '=' || d.value AS path, b.path AS parent, {k + 1} AS depth,
                CASE WHEN v.n IS NULL THEN p.guess WHEN 2 * v.pos > v.n THEN 1 ELSE 0 END AS guess,
                coalesce(v.n, 0) AS n, coalesce(v.pos, 0) AS pos FROM best{k} b JOIN domain d ON b.feature = d.feature
                JOIN nodes{k} p ON p.path = b.path
                LEFT JOIN val{k} v ON v.path = b.path AND v.feature = b.feature AND v.value = d.value)""",
            f"""rows{k + 1} AS (SELECT r.path || '/' || d.name || '=' || d.value AS path, list_append(r.used, b.feature) AS used,
                r.* EXCLUDE (path, used) FROM rows{k} r JOIN best{k} b ON r.path = b.path JOIN domain d ON d.feature = b.feature
                AND d.value = CASE b.feature {' '.join(f'WHEN {i} THEN r.{f}::VARCHAR' for i, f in enumerate(features))} END)""",
        ]
    everything = " UNION ALL ".join(f"SELECT * FROM nodes{k}" for k in range(levels + 1))
    return f"""WITH {', '.join(ctes)}, everything AS ({everything})
        SELECT path, depth, guess AS prediction, n::BIGINT AS n,
        NOT EXISTS (SELECT 1 FROM everything c WHERE c.parent = a.path AND c.depth > 0) AS is_leaf FROM everything a"""


def stump_rounds(rows: str, features: Sequence[str], rounds: int, rate: float = 1.0) -> list[str]:
    """CTEs ``best<k>`` (stump, error, alpha) and ``w<k>`` (rows with normalised weights w
    and margin f); ``rows`` has the features and y in -1/+1."""
    ctes = [f"w0 AS (SELECT *, 1.0::DOUBLE / count(*) OVER () AS w, 0.0::DOUBLE AS f FROM {rows})"]
    for k in range(1, rounds + 1):
        long = " UNION ALL ".join(
            f"SELECT {i} AS feature, {f}::DOUBLE AS x, y, w FROM w{k - 1}" for i, f in enumerate(features)
        )
        value = f"CASE b.feature {' '.join(f'WHEN {i} THEN r.{f}' for i, f in enumerate(features))} END"
        vote = f"(CASE WHEN {value} >= b.t THEN b.polarity ELSE -b.polarity END)"
        ctes += [
            f"""v{k} AS (SELECT feature, x, coalesce(sum(w) FILTER (y = 1), 0) AS p, coalesce(sum(w) FILTER (y = -1), 0) AS m
                FROM ({long}) GROUP BY ALL)""",
            f"""c{k} AS (SELECT DISTINCT feature, t FROM (SELECT feature, round_even((x + lead(x) OVER (PARTITION BY feature
                ORDER BY x)) / 2, 8) AS t FROM v{k}) WHERE t IS NOT NULL)""",
            f"""e{k} AS (SELECT c.feature, c.t, (coalesce(sum(v.m) FILTER (v.x >= c.t), 0) + coalesce(sum(v.p) FILTER (v.x < c.t), 0))
                / sum(v.m + v.p) AS e FROM c{k} c JOIN v{k} v USING (feature) GROUP BY ALL)""",
            f"""best{k} AS (SELECT feature, t, polarity, e, {rate}::DOUBLE * 0.5 * ln((1 - e) / e) AS alpha FROM
                (SELECT feature, t, 1 AS polarity, round_even(e, 12) AS e FROM e{k} UNION ALL
                 SELECT feature, t, -1, round_even(1 - e, 12) FROM e{k}) ORDER BY e, feature, t, polarity DESC LIMIT 1)""",
            f"""u{k} AS (SELECT r.* EXCLUDE (w, f), r.w * exp(-b.alpha * r.y * {vote}) AS w, r.f + b.alpha * {vote} AS f
                FROM w{k - 1} r, best{k} b)""",
            f"w{k} AS (SELECT * EXCLUDE (w), w / (SELECT sum(w) FROM u{k}) AS w FROM u{k})",
        ]
    return ctes


def boosted_trees(rows: str, features: Sequence[str], rounds: int, depth: int) -> tuple[list[str], str]:
    """CTEs of a gradient booster and the name of the relation that holds the scores ``f``;
    ``rows`` has the features and the target z."""
    ctes = [f"g0 AS (SELECT *, (SELECT avg(z) FROM {rows}) AS f, 0.0::DOUBLE AS fit FROM {rows})"]
    for k in range(1, rounds + 1):
        ctes.append(f"res{k} AS (SELECT *, z - f AS r FROM g{k - 1})")
        ctes += cart_levels(f"b{k}", f"res{k}", features, "r", depth, "target")
        ctes.append(f"leaf{k} AS (SELECT node, round(avg(r), 8) AS leaf FROM b{k}_rows{depth} GROUP BY node)")
        ctes.append(
            f"""fit{k} AS (SELECT x.* EXCLUDE (node, fit), l.leaf AS fit FROM b{k}_rows{depth} x JOIN leaf{k} l USING (node))"""
        )
        ctes.append(
            f"""step{k} AS (SELECT 0.5 + 0.05 * i AS p FROM (SELECT unnest(range(90)) AS i), (SELECT sum(r * r) AS rr,
                sum(r * fit) AS rf, sum(fit * fit) AS ff FROM fit{k}) ORDER BY rr - 2 * p * rf + p * p * ff, p DESC LIMIT 1)"""
        )
        ctes.append(
            f"g{k} AS (SELECT * EXCLUDE (f, r, fit), f + (SELECT p FROM step{k})::DOUBLE * fit AS f, fit FROM fit{k})"
        )
    return ctes, f"g{rounds}"


def route(prefix: str, name: str, rows: str, features: Sequence[str], depth: int) -> list[str]:
    """CTEs that send other rows down a grown tree; ``<name>_<depth>`` has their nodes."""
    ctes = [f"{name}_0 AS (SELECT 1::BIGINT AS node, * FROM {rows})"]
    value = "CASE b.feature " + " ".join(f"WHEN {i} THEN r.{f}" for i, f in enumerate(features)) + " END"
    for level in range(depth):
        ctes.append(
            f"""{name}_{level + 1} AS (SELECT CASE WHEN b.node IS NULL THEN r.node WHEN {value} <= b.t THEN 2 * r.node
                ELSE 2 * r.node + 1 END AS node, r.* EXCLUDE (node)
                FROM {name}_{level} r LEFT JOIN {prefix}_best{level} b ON r.node = b.node)"""
        )
    return ctes
