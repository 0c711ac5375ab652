"""Projection and conditional-update queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions import numeric as N
from tallyweave.functions import text as X
from tallyweave.operators import columns as C
from tallyweave.operators.ordered import repair_by_group_median
from tallyweave.sources.nulls import normalise_missing
from tallyweave.suite.registry import query


@query("prj_drop", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def prj_drop(t):
    return t.orders.drop("o_orderdate", "o_orderpriority", "not_there")


@query("prj_drop_suffix", "SELECT c_name, c_acctbal, c_mktsegment FROM customer")
def prj_drop_suffix(t):
    return C.drop_by_suffix(t.customer, ("key", "_url", "_t"))


@query("prj_keep", "SELECT p_partkey, p_brand, p_type, p_name FROM part")
def prj_keep(t):
    return C.keep_columns(t.part, exact=("p_partkey", "p_brand"), prefixes=("p_t", "p_n"))


@query("prj_rename", "SELECT n_nationkey AS code, n_name AS country, n_regionkey AS region FROM nation")
def prj_rename(t):
    return t.nation.withColumnsRenamed({"n_nationkey": "code", "n_name": "country", "n_regionkey": "region"})


@query("prj_copy", "SELECT o_orderkey, o_totalprice, o_totalprice AS price_copy FROM orders")
def prj_copy(t):
    return t.orders.select("o_orderkey", "o_totalprice").withColumn("price_copy", F.col("o_totalprice"))


@query(
    "prj_cast_float",
    """SELECT p_partkey, CAST(p_size AS DOUBLE) AS size_f, TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS brand_f,
              TRY_CAST(p_name AS DOUBLE) AS name_f FROM part""",
)
def prj_cast_float(t):
    return t.part.select(
        "p_partkey",
        F.col("p_size").cast("double").alias("size_f"),
        F.split("p_brand", "#")[1].try_cast("double").alias("brand_f"),
        F.col("p_name").try_cast("double").alias("name_f"),
    )


@query(
    "prj_cast_ts",
    """SELECT o_orderkey, strftime(CAST(strftime(o_orderdate, '%Y-%m-%d') AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ts,
              CAST(NULL AS VARCHAR) AS bad FROM orders""",
)
def prj_cast_ts(t):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return t.orders.select(
        "o_orderkey",
        F.date_format(F.to_timestamp(day), "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.col("o_orderpriority").try_cast("timestamp").cast("string").alias("bad"),
    )


@query("prj_sub", "SELECT p_partkey, p_retailprice - p_size AS difference FROM part")
def prj_sub(t):
    return t.part.select("p_partkey", (F.col("p_retailprice") - F.col("p_size")).alias("difference"))


@query("prj_mul", "SELECT o_orderkey, o_totalprice * 0.25::DOUBLE AS scaled FROM orders")
def prj_mul(t):
    return t.orders.select("o_orderkey", (F.col("o_totalprice") * 0.25).alias("scaled"))


@query(
    "prj_ratio",
    """SELECT l_orderkey, l_linenumber, l_extendedprice / NULLIF(l_discount, 0) AS per_discount,
              l_tax / l_quantity AS tax_share FROM lineitem""",
)
def prj_ratio(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        N.ratio("l_extendedprice", "l_discount").alias("per_discount"),
        N.ratio("l_tax", "l_quantity").alias("tax_share"),
    )


@query(
    "prj_clip0",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS credit,
              CASE WHEN -c_acctbal > 0 THEN -c_acctbal ELSE 0 END AS debit FROM customer""",
)
def prj_clip0(t):
    return t.customer.select(
        "c_custkey",
        N.positive_part("c_acctbal").alias("credit"),
        N.positive_part(-F.col("c_acctbal")).alias("debit"),
    )


@query("prj_clip", "SELECT o_orderkey, LEAST(GREATEST(o_totalprice, 50000), 300000) AS clipped FROM orders")
def prj_clip(t):
    return t.orders.select("o_orderkey", N.clip("o_totalprice", 50000.0, 300000.0).alias("clipped"))


@query(
    "prj_population_split",
    """WITH s AS (SELECT n_regionkey, COUNT(*) AS total,
                         COUNT(*) FILTER (WHERE c_acctbal < 0) AS young,
                         COUNT(*) FILTER (WHERE c_acctbal >= 0 AND c_acctbal < 2000) AS teen
                  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey)
       SELECT n_regionkey, total, young, teen, total - young - teen AS adult FROM s""",
)
def prj_population_split(t):
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    sums = people.groupBy("n_regionkey").agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.when(F.col("c_acctbal") < 0, 1)).alias("young"),
        F.count(F.when(F.col("c_acctbal").between(0, 1999.999999), 1)).alias("teen"),
    )
    return sums.withColumn("adult", F.col("total") - F.col("young") - F.col("teen"))


def nation_indicators(t):
    """Per nation: share of two customer groups (percent), mean order value, adult and young counts."""
    people = t.customer.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("people"),
        (F.count(F.when(F.col("c_mktsegment") == "BUILDING", 1)) * 100.0 / F.count(F.lit(1))).alias("pc"),
        (F.count(F.when(F.col("c_acctbal") > 0, 1)) * 100.0 / F.count(F.lit(1))).alias("net"),
        F.count(F.when(F.col("c_acctbal") >= 2000, 1)).alias("adult"),
    )
    value = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(N.exact_avg("o_totalprice").alias("gdp"))
    )
    return people.join(value, "c_nationkey").withColumn("young", F.col("people") - F.col("adult"))


NATION_INDICATORS = """
    p AS (SELECT c_nationkey, COUNT(*) AS people,
                 COUNT(*) FILTER (WHERE c_mktsegment = 'BUILDING') * 100.0::DOUBLE / COUNT(*) AS pc,
                 COUNT(*) FILTER (WHERE c_acctbal > 0) * 100.0::DOUBLE / COUNT(*) AS net,
                 COUNT(*) FILTER (WHERE c_acctbal >= 2000) AS adult
          FROM customer GROUP BY c_nationkey),
    v AS (SELECT c_nationkey,
                 CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) / COUNT(o_totalprice) AS gdp
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey),
    ind AS (SELECT p.*, v.gdp, people - adult AS young FROM p JOIN v USING (c_nationkey))"""


@query(
    "prj_composite_index",
    f"""WITH {NATION_INDICATORS},
    a AS (SELECT *, pc * net + net * 100 * gdp / MAX(gdp) OVER () AS person_raw FROM ind),
    b AS (SELECT *, (person_raw - MIN(person_raw) OVER ()) / (MAX(person_raw) OVER () - MIN(person_raw) OVER ())
                    AS person_index FROM a),
    c AS (SELECT *, round_even(person_index * SQRT(adult + 0.25::DOUBLE * young), 0) AS overall_raw FROM b)
    SELECT c_nationkey, ROUND(person_index, 6) AS person_index,
           ROUND((overall_raw - MIN(overall_raw) OVER ()) / (MAX(overall_raw) OVER () - MIN(overall_raw) OVER ()), 6)
             AS overall_index FROM c""",
)
def prj_composite_index(t):
    out = C.composite_index(nation_indicators(t), "pc", "net", "gdp", "adult", "young")
    return out.select(
        "c_nationkey", F.round("person_index", 6).alias("person_index"), F.round("overall_index", 6).alias("overall_index")
    )


@query(
    "prj_energy_recompute",
    """WITH f AS (SELECT l_orderkey, l_linenumber, l_quantity * 21 AS kcal,
                         CASE WHEN l_returnflag <> 'N' THEN l_quantity * 21 * (4.05::DOUBLE + l_discount * 2) END AS kj,
                         l_discount * 300 AS fat, l_tax * 400 AS carb, l_quantity / 5 AS protein FROM lineitem),
       g AS (SELECT *, 9.0::DOUBLE * fat + 4.0::DOUBLE * carb + 4.0::DOUBLE * protein AS parts, kj / kcal AS quotient FROM f)
       SELECT l_orderkey, l_linenumber,
              CASE WHEN (quotient < 4.1::DOUBLE OR quotient > 4.2::DOUBLE) OR kcal > 1000 THEN parts ELSE kcal END AS kcal
       FROM g""",
)
def prj_energy_recompute(t):
    food = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") * 21).alias("kcal"),
        F.when(
            F.col("l_returnflag") != "N", F.col("l_quantity") * 21 * (F.lit(4.05) + F.col("l_discount") * 2)
        ).alias("kj"),
        (F.col("l_discount") * 300).alias("fat"),
        (F.col("l_tax") * 400).alias("carb"),
        (F.col("l_quantity") / 5).alias("protein"),
    )
    return food.select(
        "l_orderkey", "l_linenumber", N.energy_from_parts("kcal", "kj", "fat", "carb", "protein").alias("kcal")
    )


@query(
    "prj_mass_rescale",
    """WITH f AS (SELECT l_orderkey, l_linenumber, l_quantity AS a, l_discount * 300 AS b, l_tax * 400 AS c FROM lineitem),
       g AS (SELECT *, a + b + c AS m FROM f)
       SELECT l_orderkey, l_linenumber,
              CASE WHEN m > 100 AND m <= 105 THEN FLOOR(a * 1000 / m) / 10 ELSE a END AS a,
              CASE WHEN m > 100 AND m <= 105 THEN FLOOR(b * 1000 / m) / 10 ELSE b END AS b,
              CASE WHEN m > 100 AND m <= 105 THEN FLOOR(c * 1000 / m) / 10 ELSE c END AS c FROM g""",
)
def prj_mass_rescale(t):
    food = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("a"),
        (F.col("l_discount") * 300).alias("b"),
        (F.col("l_tax") * 400).alias("c"),
    )
    return C.rescale_components(food, ["a", "b", "c"])


@query(
    "prj_unit_fill",
    """SELECT o_orderkey, COALESCE(CASE WHEN o_totalprice <= 250000 THEN o_totalprice END, o_totalprice / 4 * 3.5::DOUBLE)
              AS price FROM orders""",
)
def prj_unit_fill(t):
    known = t.orders.select(
        "o_orderkey",
        N.within("o_totalprice", None, 250000).alias("price"),
        (F.col("o_totalprice") / 4).alias("other_unit"),
    )
    return known.select("o_orderkey", N.fill_scaled("price", "other_unit", 3.5).alias("price"))


@query(
    "prj_sum_fill",
    """SELECT l_orderkey, l_linenumber,
              COALESCE(CASE WHEN l_quantity <= 40 THEN l_quantity END, l_discount + l_tax) AS filled FROM lineitem""",
)
def prj_sum_fill(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        N.fill_sum(N.within("l_quantity", None, 40), ["l_discount", "l_tax"]).alias("filled"),
    )


@query(
    "prj_div_fill",
    """SELECT l_orderkey, l_linenumber,
              COALESCE(CASE WHEN l_tax >= 0.02::DOUBLE THEN l_tax END, l_extendedprice / NULLIF(l_discount, 0)) AS filled
       FROM lineitem""",
)
def prj_div_fill(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        N.fill_ratio(N.within("l_tax", 0.02), "l_extendedprice", "l_discount").alias("filled"),
    )


@query(
    "upd_bounds_null",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 AND c_acctbal <= 9000 THEN c_acctbal END AS c_acctbal FROM customer""",
)
def upd_bounds_null(t):
    return t.customer.select("c_custkey", N.within("c_acctbal", 0, 9000).alias("c_acctbal"))


@query(
    "upd_sentinel_null",
    """SELECT o_orderkey, CASE WHEN LOWER(TRIM(o_orderpriority)) NOT IN ('4-not specified') THEN o_orderpriority END
                AS priority,
              CASE WHEN o_totalprice >= 20000 THEN o_totalprice END AS price, CAST(NULL AS DOUBLE) AS inf FROM orders""",
)
def upd_sentinel_null(t):
    raw = t.orders.select(
        "o_orderkey",
        F.col("o_orderpriority").alias("priority"),
        N.within("o_totalprice", 20000).alias("price"),
        (F.col("o_totalprice") * float("inf")).alias("inf"),
    )
    return normalise_missing(raw, text_sentinels=["4-NOT SPECIFIED"])


@query(
    "upd_sentinel_scale",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 20000 THEN FLOOR(o_totalprice / 100) ELSE o_totalprice END AS days FROM orders",
)
def upd_sentinel_scale(t):
    return t.orders.select("o_orderkey", N.rescale_sentinel("o_totalprice").alias("days"))


@query(
    "upd_none2nan",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_tax > 0 THEN l_discount / l_tax END AS quotient FROM lineitem",
)
def upd_none2nan(t):
    nan = F.when(F.col("l_tax") > 0, F.col("l_discount") / F.col("l_tax")).otherwise(F.lit(float("nan")))
    return normalise_missing(t.lineitem.select("l_orderkey", "l_linenumber", nan.alias("quotient")))


@query(
    "upd_fill_const",
    """SELECT c_custkey, COALESCE(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, 0) AS balance,
              COALESCE(CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END, '') AS segment FROM customer""",
)
def upd_fill_const(t):
    holes = t.customer.select(
        "c_custkey",
        N.within("c_acctbal", 0).alias("balance"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("segment"),
    )
    return holes.fillna({"balance": 0.0, "segment": ""})


@query(
    "upd_value_group",
    """SELECT p_partkey, CASE WHEN UPPER(p_name) LIKE '%RING%' AND UPPER(p_name) NOT LIKE '%RED%' THEN 'RING'
                              WHEN UPPER(p_name) LIKE '%RED%' THEN 'RED' ELSE p_name END AS kind FROM part""",
)
def upd_value_group(t):
    return t.part.select("p_partkey", X.group_values("p_name", ["Red", "Ring"]).alias("kind"))


@query(
    "upd_gfa_consistency",
    """WITH f AS (SELECT l_orderkey, l_linenumber, 50.0::DOUBLE AS total, l_quantity AS building, l_quantity AS a,
                         l_discount * 200 AS b, l_tax * 100 AS c FROM lineitem),
       g AS (SELECT *, CASE WHEN total < a + b + c THEN a + b + c - total ELSE 0 END AS excess FROM f)
       SELECT l_orderkey, l_linenumber, total + excess AS total, building + excess AS building, a, b, c FROM g""",
)
def upd_gfa_consistency(t):
    areas = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.lit(50.0).alias("total"),
        F.col("l_quantity").alias("building"),
        F.col("l_quantity").alias("a"),
        (F.col("l_discount") * 200).alias("b"),
        (F.col("l_tax") * 100).alias("c"),
    )
    return C.raise_total(areas, "total", "building", ["a", "b", "c"])


@query(
    "upd_rule_domain",
    """WITH f AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_shipdate, l_partkey, l_suppkey,
                         l_discount AS fat, l_tax AS sat FROM lineitem),
       m AS (SELECT l_returnflag, quantile_cont(fat, 0.5) AS med_fat, quantile_cont(sat, 0.5) AS med_sat
             FROM f WHERE sat <= fat GROUP BY l_returnflag),
       r AS (SELECT l_orderkey, l_linenumber, CASE WHEN sat > fat THEN med_fat ELSE fat END AS fat,
                    CASE WHEN sat > fat THEN med_sat ELSE sat END AS sat FROM f JOIN m USING (l_returnflag))
       SELECT l_orderkey, l_linenumber, ROUND(fat, 6) AS fat, ROUND(sat, 6) AS sat FROM r WHERE sat <= fat""",
)
def upd_rule_domain(t):
    food = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_returnflag", F.col("l_discount").alias("fat"), F.col("l_tax").alias("sat")
    )
    off = F.col("sat") > F.col("fat")
    # Both columns are repaired from the state before any repair.
    fixed = repair_by_group_median(food, {"fat": off, "sat": off}, "l_returnflag")
    return fixed.filter(F.col("sat") <= F.col("fat")).select(
        "l_orderkey", "l_linenumber", F.round("fat", 6).alias("fat"), F.round("sat", 6).alias("sat")
    )


@query(
    "upd_post_join_fill",
    """WITH big AS (SELECT o_custkey, COUNT(*) AS n, AVG(o_totalprice / 1000) AS m, VAR_SAMP(o_totalprice / 1000) AS v
                    FROM orders WHERE o_totalprice > 400000 GROUP BY o_custkey)
       SELECT c_custkey, COALESCE(n, 0) AS "BIG_NB_ROWS", ROUND(m, 6) AS "BIG_price_mean",
              ROUND(CASE WHEN v IS NULL AND m IS NOT NULL THEN 0 ELSE v END, 6) AS "BIG_price_var"
       FROM customer LEFT JOIN big ON c_custkey = o_custkey""",
)
def upd_post_join_fill(t):
    big = (
        t.orders.filter(F.col("o_totalprice") > 400000)
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count(F.lit(1)).alias("BIG_NB_ROWS"),
            F.round(F.avg(F.col("o_totalprice") / 1000), 6).alias("BIG_price_mean"),
            F.round(F.var_samp(F.col("o_totalprice") / 1000), 6).alias("BIG_price_var"),
        )
    )
    return C.child_feature_nulls(t.customer.select("c_custkey").join(big, "c_custkey", "left"))


