"""Window, ordering, imputation, sampling and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions import numeric as N
from tallyweave.functions import text as X
from tallyweave.operators import ordered as O
from tallyweave.operators import sampling as P
from tallyweave.operators.features import GroupImpute
from tallyweave.operators.quantiles import exact_quantiles
from tallyweave.suite.aggregation import YEAR_INDICATORS, dec, year_indicators
from tallyweave.suite.filters import HOLED, holed_customers
from tallyweave.suite.projection import NATION_INDICATORS, nation_indicators
from tallyweave.suite.registry import query

WEEK = "CAST(o_orderdate AS DATE) + ((8 - isodow(o_orderdate)) % 7)::INT"
WEEK_EVENTS = "CAST(ts AS DATE) + ((8 - isodow(ts)) % 7)::INT"


@query(
    "win_week_tumbling",
    f"""WITH w AS (SELECT {WEEK} AS week, COUNT(*) AS n, {dec('o_totalprice')} AS total FROM orders GROUP BY 1),
        cal AS (SELECT CAST(unnest(generate_series(MIN(week), MAX(week), INTERVAL 7 DAY)) AS DATE) AS week FROM w)
        SELECT strftime(week, '%Y-%m-%d') AS week, COALESCE(n, 0) AS n, COALESCE(total, 0) AS total
        FROM cal LEFT JOIN w USING (week)""",
)
def win_week_tumbling(t):
    weekly = O.weekly_totals(t.orders, "o_orderdate", F.col("o_totalprice"))
    return weekly.withColumn("week", F.col("week").cast("string"))


@query(
    "win_cumsum",
    f"""WITH w AS (SELECT event_type, {WEEK_EVENTS} AS week, COUNT(*) AS n, {dec('value')} AS total FROM events GROUP BY 1, 2),
        r AS (SELECT event_type, MIN(week) AS lo, MAX(week) AS hi FROM w GROUP BY 1),
        cal AS (SELECT event_type, CAST(unnest(generate_series(lo, hi, INTERVAL 7 DAY)) AS DATE) AS week FROM r),
        f AS (SELECT event_type, week, COALESCE(n, 0) AS n, COALESCE(total, 0) AS total FROM cal LEFT JOIN w USING (event_type, week))
        SELECT event_type, strftime(week, '%Y-%m-%d') AS week, n, ROUND(total, 4) AS total,
               CAST(SUM(n) OVER o AS BIGINT) AS cum_n, ROUND(SUM(total) OVER o, 4) AS cum_total FROM f
        WINDOW o AS (PARTITION BY event_type ORDER BY week)""",
)
def win_cumsum(t):
    weekly = O.weekly_totals(t.events, "ts", F.col("value"), ["event_type"])
    out = O.running_totals(weekly, ["n", "total"], by=["event_type"])
    return out.select(
        "event_type",
        F.col("week").cast("string").alias("week"),
        "n",
        F.round("total", 4).alias("total"),
        "cum_n",
        F.round("cum_total", 4).alias("cum_total"),
    )


@query(
    "win_rank",
    """SELECT o_orderkey, o_totalprice, ROW_NUMBER() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders""",
)
def win_rank(t):
    return O.global_rank(t.orders.select("o_orderkey", "o_totalprice"), F.desc("o_totalprice"), "o_orderkey")


@query(
    "win_latest_nonnull",
    f"""WITH {YEAR_INDICATORS}, c AS (SELECT unnest(range(1995, 2002))::INT AS cutoff)
        SELECT c_nationkey, indicator, cutoff, arg_max(value, year) AS latest_value
        FROM yi JOIN c ON year <= cutoff WHERE value IS NOT NULL GROUP BY ALL""",
)
def win_latest_nonnull(t):
    return O.latest_non_null(year_indicators(t), ["c_nationkey", "indicator"], "year", "value", range(1995, 2002))


@query(
    "win_last_order",
    """SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders
       QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def win_last_order(t):
    last = O.last_row(t.orders, "o_custkey", ["o_orderdate", "o_orderkey"])
    return last.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")


@query(
    "win_first_ts",
    "SELECT user_id, strftime(MIN(ts), '%Y-%m-%d %H:%M:%S') AS first_ts FROM events GROUP BY user_id",
)
def win_first_ts(t):
    return t.events.groupBy("user_id").agg(F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first_ts"))


ORDER_COLS = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag")


@query(
    "win_dedup_coalesce",
    f"""WITH h AS (SELECT *, CASE WHEN l_discount <= 0.06 THEN l_discount END AS disc,
                          CASE WHEN l_tax >= 0.03 THEN l_tax END AS tax, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag
                   FROM lineitem),
        o AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(ORDER_COLS)}) AS rn FROM h)
        SELECT l_orderkey, l_linenumber, arg_min(disc, rn) FILTER (WHERE disc IS NOT NULL) AS disc,
               arg_min(tax, rn) FILTER (WHERE tax IS NOT NULL) AS tax,
               arg_min(flag, rn) FILTER (WHERE flag IS NOT NULL) AS flag FROM o GROUP BY ALL""",
)
def win_dedup_coalesce(t):
    holed = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        N.within("l_discount", None, 0.06).alias("disc"),
        N.within("l_tax", 0.03).alias("tax"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"),
        F.struct(*ORDER_COLS).alias("ord"),
    )
    return O.merge_duplicates(holed, ["l_orderkey", "l_linenumber"], [F.col("ord")]).drop("ord")


@query(
    "win_loo_median",
    """WITH m AS (SELECT p_type, quantile_cont(p_retailprice, 0.5) AS med FROM part WHERE p_size BETWEEN 5 AND 45 GROUP BY 1)
       SELECT p_partkey, ROUND(CASE WHEN p_size NOT BETWEEN 5 AND 45 THEN COALESCE(med, p_retailprice) ELSE p_retailprice END, 6)
              AS price FROM part LEFT JOIN m USING (p_type)""",
)
def win_loo_median(t):
    parts = t.part.select("p_partkey", "p_type", "p_size", F.col("p_retailprice").alias("price"))
    fixed = O.repair_by_group_median(parts, {"price": ~F.col("p_size").between(5, 45)}, "p_type")
    return fixed.select("p_partkey", F.round("price", 6).alias("price"))


@query(
    "win_word_median",
    """WITH p AS (SELECT p_partkey, p_retailprice AS price, p_size NOT BETWEEN 5 AND 45 AS bad,
                         list_distinct(string_split(LOWER(p_name), ' ')) AS words FROM part),
       f AS (SELECT w FROM (SELECT unnest(words) AS w FROM p) GROUP BY w HAVING COUNT(*) >= 150),
       s2 AS (SELECT p_partkey, price, bad, list_sort((SELECT COALESCE(list(u.w), []) FROM (SELECT unnest(p.words) AS w) u
              WHERE u.w IN (SELECT w FROM f))) AS ws FROM p),
       n AS (SELECT DISTINCT ws FROM s2 WHERE bad AND len(ws) > 0),
       m AS (SELECT n.ws, quantile_cont(g.price, 0.5) AS med FROM n JOIN s2 g ON NOT g.bad AND len(g.ws) > 0
             AND list_has_all(g.ws, n.ws) GROUP BY n.ws)
       SELECT p_partkey, ROUND(CASE WHEN bad THEN COALESCE(med, price) ELSE price END, 6) AS price
       FROM s2 LEFT JOIN m USING (ws)""",
)
def win_word_median(t):
    parts = t.part.select("p_partkey", "p_size", "p_name", F.col("p_retailprice").alias("price"))
    fixed = O.repair_by_word_median(parts, {"price": ~F.col("p_size").between(5, 45)}, X.terms("p_name", " "), 150)
    return fixed.select("p_partkey", F.round("price", 6).alias("price"))


LEVELS = [["c_nationkey", "c_mktsegment"], ["c_nationkey"], ["c_mktsegment"]]
CASCADE = """
    h AS (SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_acctbal >= 5000 AND c_nationkey <> 7 THEN c_acctbal END AS bal
          FROM customer),
    m0 AS (SELECT c_nationkey, c_mktsegment, quantile_cont(bal, 0.5) AS v0 FROM h WHERE bal IS NOT NULL GROUP BY 1, 2),
    m1 AS (SELECT c_nationkey, quantile_cont(bal, 0.5) AS v1 FROM h WHERE bal IS NOT NULL GROUP BY 1),
    m2 AS (SELECT c_mktsegment, quantile_cont(bal, 0.5) AS v2 FROM h WHERE bal IS NOT NULL GROUP BY 1)"""


def _holed_balances(t):
    bal = F.when((F.col("c_acctbal") >= 5000) & (F.col("c_nationkey") != 7), F.col("c_acctbal"))
    return t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", bal.alias("bal"))


@query(
    "win_cascade_impute",
    f"""WITH {CASCADE} SELECT c_custkey, ROUND(COALESCE(bal, v0, v1, v2), 6) AS bal FROM h
        LEFT JOIN m0 USING (c_nationkey, c_mktsegment) LEFT JOIN m1 USING (c_nationkey) LEFT JOIN m2 USING (c_mktsegment)""",
)
def win_cascade_impute(t):
    return O.cascade_impute(_holed_balances(t), "bal", LEVELS).select("c_custkey", F.round("bal", 6).alias("bal"))


@query(
    "win_group_impute_fitted",
    f"""WITH {CASCADE} SELECT c_custkey, ROUND(COALESCE(bal, v2, v1, v0), 6) AS bal FROM h
        LEFT JOIN m0 USING (c_nationkey, c_mktsegment) LEFT JOIN m1 USING (c_nationkey) LEFT JOIN m2 USING (c_mktsegment)""",
)
def win_group_impute_fitted(t):
    holed = _holed_balances(t)
    model = GroupImpute(["bal"], LEVELS, last_wins=True).fit(holed)
    return model.transform(holed).select("c_custkey", F.round("bal", 6).alias("bal"))


@query(
    "win_cascade_mode",
    """WITH h AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS seg FROM customer),
       n AS (SELECT c_nationkey, seg, COUNT(*) AS n FROM h WHERE seg IS NOT NULL GROUP BY 1, 2),
       m AS (SELECT c_nationkey, seg AS fill FROM n QUALIFY ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY n DESC, seg) = 1)
       SELECT c_custkey, COALESCE(seg, fill) AS seg FROM h LEFT JOIN m USING (c_nationkey)""",
)
def win_cascade_mode(t):
    holed = t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("seg"))
    return O.cascade_impute(holed, "seg", [["c_nationkey"]], "mode").select("c_custkey", "seg")


# --- sort, limit, sampling ---------------------------------------------------------------------


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_n(t):
    return P.first_rows(t.orders.select("o_orderkey", "o_totalprice"), 10, F.desc("o_totalprice"), "o_orderkey")


@query(
    "top_quantile",
    f"""WITH {NATION_INDICATORS} SELECT c_nationkey, ROUND(gdp, 6) AS gdp FROM ind
        WHERE gdp >= (SELECT quantile_cont(gdp, 0.8) FROM ind)""",
)
def top_quantile(t):
    ind = nation_indicators(t).select("c_nationkey", "gdp")
    cut = exact_quantiles(ind, [], ["gdp"], [0.8]).select(F.col("q")[0])
    return ind.filter(F.col("gdp") >= cut.scalar()).orderBy(F.desc("gdp")).withColumn("gdp", F.round("gdp", 6))


def _hash(key: str, salt: str) -> str:
    return f"(('0x' || SUBSTRING(md5({key}::VARCHAR || '{salt}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


@query("smp_fraction", f"SELECT o_orderkey FROM orders WHERE {_hash('o_orderkey', '42')} < 0.3")
def smp_fraction(t):
    return P.uniform_sample(t.orders, 0.3, "o_orderkey").select("o_orderkey")


@query(
    "smp_stratified",
    f"""SELECT doc_id, lang FROM documents WHERE {_hash('doc_id', 'strat')} <
        CASE lang WHEN 'en' THEN 0.25::DOUBLE WHEN 'fr' THEN 0.5::DOUBLE ELSE 0.75::DOUBLE END""",
)
def smp_stratified(t):
    return P.stratified_sample(t.documents, "doc_id", {"en": 0.25, "fr": 0.5}, "lang", 0.75).select("doc_id", "lang")


@query(
    "smp_split",
    f"SELECT c_custkey, CASE WHEN {_hash('c_custkey', 'split')} < 0.33 THEN 'test' ELSE 'train' END AS split FROM customer",
)
def smp_split(t):
    return P.hash_split(t.customer, "c_custkey", 0.33).select("c_custkey", "split")


@query(
    "smp_split_stratified",
    f"""WITH r AS (SELECT c_custkey, c_mktsegment, COUNT(*) OVER (PARTITION BY c_mktsegment) AS n,
                          ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY {_hash('c_custkey', 'split')}, c_custkey) AS k FROM customer)
        SELECT c_custkey, c_mktsegment, CASE WHEN k <= FLOOR(n * 0.33::DOUBLE + 0.5::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM r""",
)
def smp_split_stratified(t):
    return P.stratified_split(t.customer.select("c_custkey", "c_mktsegment"), "c_custkey", "c_mktsegment", 0.33)


@query("smp_limit", "SELECT event_id, event_type FROM events WHERE event_type = 'error' ORDER BY event_id LIMIT 10")
def smp_limit(t):
    return P.first_rows(t.events.filter("event_type = 'error'").select("event_id", "event_type"), 10, "event_id")


# --- set operations ----------------------------------------------------------------------------


@query(
    "set_union",
    """SELECT doc_id, quality, toxic FROM labels UNION ALL
       SELECT doc_id, NULL, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def set_union(t):
    unlabelled = t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id")
    return t.labels.unionByName(unlabelled, allowMissingColumns=True)


@query("set_distinct", "SELECT DISTINCT lang, source, n_chars FROM documents")
def set_distinct(t):
    return t.documents.select("lang", "source", "n_chars").dropDuplicates()


@query("set_distinct_vectors", "SELECT COUNT(*) AS vectors FROM (SELECT DISTINCT embedding FROM embeddings)")
def set_distinct_vectors(t):
    return t.embeddings.select("embedding").dropDuplicates().agg(F.count(F.lit(1)).alias("vectors"))


@query(
    "set_difference",
    """SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = 'A'
       EXCEPT SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'""",
)
def set_difference(t):
    pairs = lambda flag: t.lineitem.filter(F.col("l_returnflag") == flag).select("l_suppkey", "l_quantity")
    return pairs("A").subtract(pairs("R"))


@query("set_split_back", f"WITH {HOLED} SELECT segment IS NULL AS to_score, COUNT(*) AS n FROM holed GROUP BY ALL")
def set_split_back(t):
    both = holed_customers(t)
    known, unknown = both.filter(F.col("segment").isNotNull()), both.filter(F.col("segment").isNull())
    sizes = lambda d, flag: d.agg(F.lit(flag).alias("to_score"), F.count(F.lit(1)).alias("n"))
    return sizes(known, False).unionByName(sizes(unknown, True))
