"""Sources, projections, fills, bins, encodings and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from tabloom.catalog import EVENTS_WITH_GAPS, events_with_gaps, lines, query, r6, table
from tabloom.functions import encode, entropy_term
from tabloom.operators import stats
from tabloom.plans.linear import LinearModel, check_columns
from tabloom.session import scratch_path
from tabloom.sources import tables


@query(
    "scan_project",
    """SELECT l_orderkey AS order_key, l_linenumber AS line, l_quantity AS quantity, l_returnflag AS flag
       FROM lineitem""",
)
def scan_project(spark, folder):
    return (
        tables.read_parquet(spark, folder, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_tax")
        .drop("l_tax")
        .withColumnsRenamed(
            {"l_orderkey": "order_key", "l_linenumber": "line", "l_quantity": "quantity", "l_returnflag": "flag"}
        )
    )


CUSTOMER_SCHEMA = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)


@query("sink_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sink_roundtrip(spark, folder):
    path = scratch_path(spark, "customer-csv")
    tables.write_csv(table(spark, folder, "customer"), path)
    return tables.read_csv(spark, path, CUSTOMER_SCHEMA)


# fixed values: rank of each order priority
PRIORITY_RANK = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("4-NOT SPECIFIED", 4), ("5-LOW", 5)]


@query(
    "literal_table",
    """SELECT p.rank AS rank, count(*) AS orders, round_even(avg(o_totalprice), 6) + 0.0 AS mean_price
       FROM orders JOIN (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4),
       ('5-LOW', 5)) p(priority, rank) ON o_orderpriority = p.priority GROUP BY p.rank""",
)
def literal_table(spark, folder):
    ranks = tables.literal_table(spark, PRIORITY_RANK, "priority string, rank int")
    joined = table(spark, folder, "orders").join(ranks, F.col("o_orderpriority") == F.col("priority"))
    return joined.groupBy("rank").agg(
        F.count(F.lit(1)).alias("orders"), r6(F.avg("o_totalprice")).alias("mean_price")
    )


@query(
    "gen_separable",
    """SELECT row_id, round_even(x1, 6) + 0.0 AS x1, round_even(x2, 6) + 0.0 AS x2,
       CASE WHEN 0.0 + x1 * 2.0::DOUBLE + x2 * 3.0::DOUBLE <= 0 THEN -1 ELSE 1 END AS label
       FROM (SELECT o_orderkey AS row_id,
         ('0x' || substr(md5('x1:' || o_orderkey), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE * 20 - 10 AS x1,
         ('0x' || substr(md5('x2:' || o_orderkey), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE * 20 - 10 AS x2
         FROM orders)""",
)
def gen_separable(spark, folder):
    points = tables.separable_points(table(spark, folder, "orders"), "o_orderkey", [2.0, 3.0])
    return points.select("row_id", r6(F.col("x1")).alias("x1"), r6(F.col("x2")).alias("x2"), "label")


@query(
    "binary_subset",
    """SELECT o_totalprice, o_custkey, CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 1 END AS label
       FROM orders WHERE o_orderstatus IN ('F', 'O')""",
)
def binary_subset(spark, folder):
    return tables.binary_subset(
        table(spark, folder, "orders"), ["o_totalprice", "o_custkey"], "o_orderstatus", "F", "O"
    )


BALANCE_MODEL = LinearModel(("c_acctbal", "c_nationkey"), -0.5, (0.0001, 0.02), link="logit")
BALANCE_Z = "(-0.5::DOUBLE + c_acctbal * 0.0001::DOUBLE + c_nationkey * 0.02::DOUBLE)"


@query(
    "submission",
    f"""SELECT c_custkey, CASE WHEN 1 / (1 + exp(-{BALANCE_Z})) >= 0.5 THEN 1 ELSE 0 END AS outcome
        FROM customer""",
)
def submission(spark, folder):
    scored = BALANCE_MODEL.score(table(spark, folder, "customer"), "p")
    return tables.submission(scored, "c_custkey", (F.col("p") >= 0.5).cast("int"), "outcome")


@query(
    "linear_score",
    f"""SELECT c_custkey, 1.0::DOUBLE AS x0, round_even({BALANCE_Z}, 6) + 0.0 AS z,
        round_even(1 / (1 + exp(-{BALANCE_Z})), 6) + 0.0 AS p FROM customer""",
)
def linear_score(spark, folder):
    customers = table(spark, folder, "customer").withColumn("x0", F.lit(1.0))
    line = LinearModel(BALANCE_MODEL.features, BALANCE_MODEL.intercept, BALANCE_MODEL.weights)
    return BALANCE_MODEL.score(line.score(customers, "z"), "p").select(
        "c_custkey", "x0", r6(F.col("z")).alias("z"), r6(F.col("p")).alias("p")
    )


@query(
    "schema_check",
    f"SELECT c_custkey, round_even({BALANCE_Z}, 6) + 0.0 AS z FROM customer",
)
def schema_check(spark, folder):
    shuffled = table(spark, folder, "customer").select("c_nationkey", "c_custkey", "c_acctbal")
    check_columns(BALANCE_MODEL.features, shuffled.columns)
    line = LinearModel(BALANCE_MODEL.features, BALANCE_MODEL.intercept, BALANCE_MODEL.weights)
    return line.score(shuffled, "z").select("c_custkey", r6(F.col("z")).alias("z"))


@query(
    "null_profile",
    f"""SELECT 'value' AS "column", bool_or(value IS NULL) AS has_null FROM {EVENTS_WITH_GAPS}
        UNION ALL SELECT 'event_type', bool_or(event_type IS NULL) FROM {EVENTS_WITH_GAPS}
        UNION ALL SELECT 'user_id', bool_or(user_id IS NULL) FROM {EVENTS_WITH_GAPS}""",
)
def null_profile(spark, folder):
    return stats.null_profile(events_with_gaps(spark, folder), ["value", "event_type", "user_id"])


@query(
    "recode",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 2 END AS flag,
       CASE WHEN l_returnflag = 'N' THEN 1 WHEN l_returnflag = 'A' THEN 2 ELSE 3 END AS flag3,
       CASE WHEN l_linestatus = 'F' THEN 1 WHEN l_linestatus = 'O' THEN 0 END AS status FROM lineitem""",
)
def recode(spark, folder):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        encode.recode(flag, {"R": 1}, 2).alias("flag"),
        encode.recode(flag, {"N": 1, "A": 2}, 3).alias("flag3"),
        encode.recode(status, {"F": 1, "O": 0}).alias("status"),
    )


@query(
    "cast_domain",
    """SELECT DISTINCT CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS category,
       CAST(l_quantity AS INTEGER) AS code FROM lineitem""",
)
def cast_domain(spark, folder):
    code = F.col("l_quantity").cast("int")
    return table(spark, folder, "lineitem").select(code.cast("string").alias("category"), code.alias("code")).distinct()


@query("drop_constant", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def drop_constant(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.lit(7).alias("always"), "o_orderstatus", "o_totalprice"
    )
    return stats.drop_constant(orders, "o_orderstatus")


@query(
    "row_slice",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def row_slice(spark, folder):
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(5)
    )


@query(
    "impute_mean",
    f"""SELECT event_id, round_even(coalesce(value, (SELECT avg(value) FROM {EVENTS_WITH_GAPS})), 6) + 0.0 AS value
        FROM {EVENTS_WITH_GAPS}""",
)
def impute_mean(spark, folder):
    events = events_with_gaps(spark, folder)
    filled = encode.fit_fill(events, {"value": "mean"}).apply(events)
    return filled.select("event_id", r6(F.col("value")).alias("value"))


@query(
    "impute_mode",
    f"""SELECT event_id, coalesce(event_type, (SELECT event_type FROM {EVENTS_WITH_GAPS}
        WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)) AS event_type
        FROM {EVENTS_WITH_GAPS}""",
)
def impute_mode(spark, folder):
    events = events_with_gaps(spark, folder)
    return encode.fit_fill(events, {"event_type": "mode"}).apply(events).select("event_id", "event_type")


@query(
    "impute_zero",
    f"""SELECT event_id, coalesce(value, 0) AS value, coalesce(event_type, 'none') AS event_type
        FROM {EVENTS_WITH_GAPS}""",
)
def impute_zero(spark, folder):
    events = events_with_gaps(spark, folder)
    filled = encode.fit_fill(events, {"value": 0, "event_type": "none"}).apply(events)
    return filled.select("event_id", "value", "event_type")


@query(
    "bin_edges",
    f"""SELECT event_id, CASE WHEN value <= 7 THEN 1 WHEN value <= 15 THEN 2 WHEN value <= 32 THEN 3
        WHEN value <= 50 THEN 4 WHEN value <= 80 THEN 5 WHEN value > 80 THEN 6 END AS bin
        FROM {EVENTS_WITH_GAPS}""",
)
def bin_edges(spark, folder):
    events = events_with_gaps(spark, folder)
    return events.select("event_id", encode.bin_upper(F.col("value"), [7, 15, 32, 50, 80]).alias("bin"))


@query(
    "one_hot",
    f"""SELECT event_id, {', '.join(f"CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END AS event_type_{t}"
        for t in ('click', 'error', 'purchase', 'signup', 'view'))},
        CASE WHEN event_type IS NULL THEN 1 ELSE 0 END AS event_type_nan FROM {EVENTS_WITH_GAPS}""",
)
def one_hot(spark, folder):
    events = events_with_gaps(spark, folder).select("event_id", "event_type")
    return encode.one_hot_encoder(events, ["event_type"], null_dummy=True)[0]


@query(
    "zscore",
    """SELECT p_partkey, round_even((p_retailprice - m) / s, 6) + 0.0 AS price, round_even((p_size - n) / q, 6) + 0.0 AS size
       FROM part, (SELECT avg(p_retailprice) m, stddev_pop(p_retailprice) s, avg(p_size) n, stddev_pop(p_size) q FROM part)""",
)
def zscore(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_retailprice", "p_size")
    scaled = encode.fit_scaler(parts, ["p_retailprice", "p_size"]).apply(parts)
    return scaled.select("p_partkey", r6(F.col("p_retailprice")).alias("price"), r6(F.col("p_size")).alias("size"))


@query(
    "zscore_fit_apply",
    """SELECT o_orderkey, round_even((o_totalprice - m) / s, 6) + 0.0 AS price
       FROM orders, (SELECT avg(o_totalprice) m, stddev_pop(o_totalprice) s FROM orders WHERE o_orderdate < '1998-01-01')
       WHERE o_orderdate >= '1998-01-01'""",
)
def zscore_fit_apply(spark, folder):
    orders = table(spark, folder, "orders")
    train = orders.filter("o_orderdate < '1998-01-01'")
    test = orders.filter("o_orderdate >= '1998-01-01'").select("o_orderkey", "o_totalprice")
    scaled = encode.fit_scaler(train, ["o_totalprice"]).apply(test)
    return scaled.select("o_orderkey", r6(F.col("o_totalprice")).alias("price"))


@query(
    "label_encode",
    """SELECT c_custkey, code FROM customer JOIN (SELECT v, (dense_rank() OVER (ORDER BY v) - 1)::INTEGER AS code
       FROM (SELECT c_name AS v FROM customer UNION SELECT s_name FROM supplier)) ON v = c_name""",
)
def label_encode(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("name"))
    suppliers = table(spark, folder, "supplier").select(F.col("s_name").alias("name"))
    codes = encode.label_codes([customers, suppliers], "name")
    return encode.label_encode(customers, "name", codes).withColumnRenamed("name", "code")


@query(
    "date_parts",
    """SELECT o_orderkey, year(o_orderdate)::INTEGER AS "Year", month(o_orderdate)::INTEGER AS "Month",
       (isodow(o_orderdate) - 1)::INTEGER AS weekday FROM orders""",
)
def date_parts(spark, folder):
    days = table(spark, folder, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    )
    return encode.date_parts(days, "day")


@query(
    "entropy",
    """SELECT 'l_returnflag' AS "column", round_even(-sum(p * log2(p)), 6) + 0.0 AS entropy FROM
       (SELECT count(*) / sum(count(*)) OVER () AS p FROM lineitem GROUP BY l_returnflag)
       UNION ALL SELECT 'l_linestatus', round_even(-sum(p * log2(p)), 6) + 0.0 FROM
       (SELECT count(*) / sum(count(*)) OVER () AS p FROM lineitem GROUP BY l_linestatus)""",
)
def entropy(spark, folder):
    rows = table(spark, folder, "lineitem")
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in ("l_returnflag", "l_linestatus")]
    counts = rows.select(F.inline(F.array(*pairs))).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return (
        counts.join(totals, "column")
        .groupBy("column")
        .agg(r6(F.sum(entropy_term(F.col("n") / F.col("total")))).alias("entropy"))
    )


@query(
    "scalar_math",
    """SELECT l_orderkey, l_linenumber, l_partkey, round_even(exp(l_discount), 6) AS e, round_even(ln(l_quantity), 6) + 0.0 AS l,
       abs(l_discount - l_tax) > 0.02 AS far, l_quantity * l_quantity AS square, round_even(sqrt(l_extendedprice), 6) AS root,
       round_even(power(l_tax + 1, 3), 6) AS cube, round_even(l_extendedprice / 7, 4) AS rounded FROM lineitem""",
)
def scalar_math(spark, folder):
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        r6(F.exp("l_discount")).alias("e"),
        r6(F.log("l_quantity")).alias("l"),
        (F.abs(F.col("l_discount") - F.col("l_tax")) > 0.02).alias("far"),
        (F.col("l_quantity") * F.col("l_quantity")).alias("square"),
        r6(F.sqrt("l_extendedprice")).alias("root"),
        r6(F.pow(F.col("l_tax") + 1, F.lit(3.0))).alias("cube"),
        r6(F.col("l_extendedprice") / 7, 4).alias("rounded"),
    )


@query(
    "rule_table",
    """SELECT DISTINCT p_brand || ' <= ' || p_size AS rule, p_brand AS feature, '<=' AS op, p_size AS value FROM part
       UNION ALL SELECT DISTINCT p_brand || ' > ' || p_size, p_brand, '>', p_size FROM part""",
)
def rule_table(spark, folder):
    cuts = table(spark, folder, "part").select("p_brand", "p_size").distinct()
    sided = cuts.select("*", F.explode(F.array(F.lit("<="), F.lit(">"))).alias("op"))
    rule = encode.build_rule(F.col("p_brand"), F.col("op"), F.col("p_size"))
    return sided.select(rule.alias("rule"), F.col("p_brand").alias("feature"), "op", F.col("p_size").alias("value"))


@query(
    "rule_parse",
    """SELECT p_partkey, p_brand AS feature, CASE WHEN p_size > 25 THEN '>' ELSE '<=' END AS op,
       p_retailprice AS value FROM part""",
)
def rule_parse(spark, folder):
    op = F.when(F.col("p_size") > 25, ">").otherwise("<=")
    rules = table(spark, folder, "part").select(
        "p_partkey", encode.build_rule(F.col("p_brand"), op, F.col("p_retailprice")).alias("rule")
    )
    feature, found, value = encode.parse_rule(F.col("rule"))
    return rules.select(
        "p_partkey", feature.alias("feature"), found.alias("op"), value.cast("double").alias("value")
    )


@query(
    "argmax_class",
    "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::INTEGER AS class FROM embeddings",
)
def argmax_class(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", encode.first_argmax(F.col("embedding")).alias("class"))


@query(
    "prepare_lines",
    """SELECT l_orderkey, l_linenumber, l_partkey, y,
       CASE WHEN l_quantity <= 10 THEN 1 WHEN l_quantity <= 20 THEN 2 WHEN l_quantity <= 30 THEN 3
       WHEN l_quantity <= 40 THEN 4 ELSE 5 END AS quantity,
       CASE WHEN l_returnflag = 'N' THEN 1 WHEN l_returnflag = 'A' THEN 2 ELSE 3 END AS flag
       FROM (SELECT *, CASE WHEN (l_quantity > 25 AND l_discount > 0.05) OR l_tax > 0.06 THEN 1 ELSE 0 END AS y FROM lineitem)""",
)
def prepare_lines(spark, folder):
    return lines(spark, folder).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "y",
        encode.bin_upper(F.col("l_quantity"), [10, 20, 30, 40]).alias("quantity"),
        encode.recode(F.col("l_returnflag"), {"N": 1, "A": 2}, 3).alias("flag"),
    )
