"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions import numeric as N
from tallyweave.functions import text as X
from tallyweave.operators import aggregates as A
from tallyweave.operators import association as S
from tallyweave.operators import columns as C
from tallyweave.operators import quantiles as Q
from tallyweave.operators.features import corrected_moments
from tallyweave.suite.filters import HOLED, holed_customers
from tallyweave.suite.projection import NATION_INDICATORS, nation_indicators
from tallyweave.suite.registry import query


def dec(x: str) -> str:
    """SQL text of the order-independent sum."""
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


@query("agg_count_sorted", "SELECT c_nationkey, COUNT(*) AS n FROM customer GROUP BY c_nationkey ORDER BY n DESC, c_nationkey")
def agg_count_sorted(t):
    return t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "c_nationkey")


@query(
    "agg_sum_mean_size",
    f"""SELECT l_returnflag, l_linestatus, COUNT(*) AS n, {dec('l_quantity')} AS qty, {dec('l_extendedprice')} AS price,
        {dec('l_extendedprice * (1 - l_discount)')} AS revenue, {dec('l_discount')} / COUNT(l_discount) AS mean_discount
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
)
def agg_sum_mean_size(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        N.exact_sum("l_quantity").alias("qty"),
        N.exact_sum("l_extendedprice").alias("price"),
        N.exact_sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
        N.exact_avg("l_discount").alias("mean_discount"),
    )


@query(
    "agg_two_keys",
    f"SELECT o_orderstatus, o_orderpriority, {dec('o_totalprice')} AS total FROM orders GROUP BY ALL",
)
def agg_two_keys(t):
    return t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(N.exact_sum("o_totalprice").alias("total"))


def _profile_sql(table, columns):
    stats = ", ".join(
        f"""ROUND(MIN({c}), 6) AS "{table}_{c}_min", ROUND(MAX({c}), 6) AS "{table}_{c}_max",
            ROUND(AVG({c}), 6) AS "{table}_{c}_mean", ROUND(VAR_SAMP({c}), 6) AS "{table}_{c}_var",
            ROUND(SUM({c}), 6) AS "{table}_{c}_sum" """
        for c in columns
    )
    return f'COUNT(*) AS "{table}_NB_ROWS", {stats}'


@query(
    "agg_profile_by_key",
    f"""WITH l AS (SELECT o_custkey, l_quantity AS qty, l_extendedprice / 1000 AS price, l_discount AS disc
                   FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
        SELECT o_custkey, {_profile_sql('LINES', ['qty', 'price', 'disc'])} FROM l GROUP BY o_custkey""",
)
def agg_profile_by_key(t):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey",
        F.col("l_quantity").alias("qty"),
        (F.col("l_extendedprice") / 1000).alias("price"),
        F.col("l_discount").alias("disc"),
        "l_returnflag",
    )
    out = A.profile_by_key(lines, "o_custkey", "LINES")
    return out.select(*[F.round(c, 6).alias(c) if k == "double" else F.col(c) for c, k in out.dtypes])


@query(
    "agg_weighted_mean",
    f"""WITH {NATION_INDICATORS} SELECT n_regionkey, ROUND(SUM(pc * people) / SUM(people), 6) AS pc,
        ROUND(SUM(net * people) / SUM(people), 6) AS net, ROUND(SUM(gdp * people) / SUM(people), 6) AS gdp
        FROM ind JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey""",
)
def agg_weighted_mean(t):
    nations = nation_indicators(t).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    means = A.weighted_means(nations, "n_regionkey", ["pc", "net", "gdp"], "people")
    return means.select("n_regionkey", *[F.round(c, 6).alias(c) for c in ("pc", "net", "gdp")])


@query(
    "agg_group_sum",
    f"""SELECT n_regionkey, CAST(COUNT(*) AS BIGINT) AS people, {dec('c_acctbal')} AS balance
        FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_regionkey""",
)
def agg_group_sum(t):
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return people.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("people"), N.exact_sum("c_acctbal").alias("balance"))


@query(
    "agg_string_concat",
    """SELECT o_custkey, 0 AS part, string_agg(o_orderpriority || ':' || o_orderstatus, ',' ORDER BY o_orderdate, o_orderkey)
              AS items FROM orders GROUP BY o_custkey""",
)
def agg_string_concat(t):
    item = F.concat("o_orderpriority", F.lit(":"), "o_orderstatus")
    out = A.string_concat(t.orders, ["o_custkey"], item, ["o_orderdate", "o_orderkey"])
    return out.withColumnRenamed("text", "items")


@query(
    "agg_centroid",
    f"""SELECT SUBSTRING(CAST(c_custkey AS VARCHAR), 1, 2) AS zip, c_nationkey AS state,
        {dec('c_acctbal')} / COUNT(*) AS lat, {dec('-c_acctbal / 2')} / COUNT(*) AS lng FROM customer GROUP BY ALL""",
)
def agg_centroid(t):
    zip_code = F.substring(F.col("c_custkey").cast("string"), 1, 2)
    return t.customer.groupBy(zip_code.alias("zip"), F.col("c_nationkey").alias("state")).agg(
        N.exact_avg("c_acctbal").alias("lat"), N.exact_avg(-F.col("c_acctbal") / 2).alias("lng")
    )


@query(
    "agg_distinct_count",
    f"""WITH {HOLED} SELECT COUNT(DISTINCT c_nationkey) AS nations,
        COUNT(DISTINCT balance) + MAX((balance IS NULL)::INT) AS balances,
        COUNT(DISTINCT segment) + MAX((segment IS NULL)::INT) AS segments FROM holed""",
)
def agg_distinct_count(t):
    """A missing value counts as one value, so the counts come from the (column, value) table."""
    profile = A.fill_profile(holed_customers(t))
    pick = lambda c: F.max(F.when(F.col("column") == c, F.col("distinct_values")))
    return profile.agg(
        pick("c_nationkey").alias("nations"), pick("balance").alias("balances"), pick("segment").alias("segments")
    )


@query(
    "agg_fill_profile",
    f"""WITH {HOLED}, long AS (
          SELECT 'c_custkey' AS "column", 'bigint' AS type, c_custkey::VARCHAR AS v FROM holed
          UNION ALL SELECT 'c_nationkey', 'int', c_nationkey::VARCHAR FROM holed
          UNION ALL SELECT 'balance', 'double', balance::VARCHAR FROM holed
          UNION ALL SELECT 'segment', 'string', segment FROM holed)
        SELECT "column", type, COUNT(v) AS filled, COUNT(v) * 100.0::DOUBLE / COUNT(*) AS filled_pct,
               COUNT(DISTINCT v) + MAX((v IS NULL)::INT) AS distinct_values FROM long GROUP BY ALL""",
)
def agg_fill_profile(t):
    return A.fill_profile(holed_customers(t))


@query(
    "agg_describe",
    """WITH long AS (SELECT 'qty' AS "column", l_quantity AS v FROM lineitem
                     UNION ALL SELECT 'price', l_extendedprice / 1000 FROM lineitem
                     UNION ALL SELECT 'disc', l_discount FROM lineitem),
       m AS (SELECT "column" AS c, AVG(v) AS mu FROM long GROUP BY ALL),
       z AS (SELECT "column" AS c, SUM(POWER(v - mu, 3)) AS m3, SUM(POWER(v - mu, 2)) AS m2, SUM(POWER(v - mu, 4)) AS m4,
                    COUNT(v) AS n FROM long JOIN m ON m.c = long."column" GROUP BY ALL)
       SELECT "column", COUNT(v) AS count, ROUND(AVG(v), 9) AS mean, ROUND(STDDEV_SAMP(v), 6) AS std, ROUND(MIN(v), 6) AS min,
              ROUND(quantile_cont(v, 0.25), 6) AS q25, ROUND(quantile_cont(v, 0.5), 6) AS median,
              ROUND(quantile_cont(v, 0.75), 6) AS q75, ROUND(MAX(v), 6) AS max,
              ROUND(MAX((m3 / z.n) / POWER(m2 / z.n, 1.5)), 6) AS skewness,
              ROUND(MAX((m4 / z.n) / POWER(m2 / z.n, 2) - 3), 6) AS kurtosis
       FROM long JOIN z ON z.c = long."column" GROUP BY "column" """,
)
def agg_describe(t):
    lines = t.lineitem.select(
        F.col("l_quantity").alias("qty"), (F.col("l_extendedprice") / 1000).alias("price"), F.col("l_discount").alias("disc")
    )
    out = A.describe_columns(lines, ["qty", "price", "disc"])
    digits = lambda c: 9 if c == "mean" else 6
    return out.select(*[F.round(c, digits(c)).alias(c) if k == "double" else F.col(c) for c, k in out.dtypes])


@query(
    "agg_group_median_std",
    """SELECT c_nationkey, ROUND(AVG(o_totalprice / 1000), 6) AS mean, ROUND(quantile_cont(o_totalprice / 1000, 0.5), 6) AS median,
              ROUND(STDDEV_SAMP(o_totalprice / 1000), 6) AS std
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey""",
)
def agg_group_median_std(t):
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_nationkey", (F.col("o_totalprice") / 1000).alias("price")
    )
    medians = Q.group_medians(orders, ["c_nationkey"], ["price"]).withColumnRenamed("price", "median")
    moments = orders.groupBy("c_nationkey").agg(F.avg("price").alias("mean"), F.stddev_samp("price").alias("std"))
    out = moments.join(medians, "c_nationkey")
    return out.select("c_nationkey", *[F.round(c, 6).alias(c) for c in ("mean", "median", "std")])


@query(
    "agg_quantile",
    """SELECT ROUND(quantile_cont(o_totalprice, 0.8), 6) AS q80, ROUND(quantile_cont(o_totalprice, 0.05), 6) AS q05,
              ROUND(quantile_cont(o_totalprice, 0.999), 6) AS q999 FROM orders""",
)
def agg_quantile(t):
    out = Q.exact_quantiles(t.orders, [], ["o_totalprice"], [0.8, 0.05, 0.999])
    return out.select(*[F.round(F.col("q")[i], 6).alias(n) for i, n in enumerate(("q80", "q05", "q999"))])


@query(
    "agg_mode",
    """WITH n AS (SELECT l_suppkey, l_quantity, COUNT(*) AS n FROM lineitem GROUP BY ALL)
       SELECT l_suppkey, l_quantity FROM n
       QUALIFY ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_quantity) = 1""",
)
def agg_mode(t):
    return Q.group_modes(t.lineitem, ["l_suppkey"], "l_quantity")


@query(
    "agg_minmax_norm",
    """SELECT s_suppkey, (s_acctbal - MIN(s_acctbal) OVER ()) / (MAX(s_acctbal) OVER () - MIN(s_acctbal) OVER ())
              AS s_acctbal_scaled, s_acctbal / MAX(s_acctbal) OVER () AS s_acctbal_rel FROM supplier""",
)
def agg_minmax_norm(t):
    out = C.scaled_by_max(C.scaled_min_max(t.supplier, ["s_acctbal"]), ["s_acctbal"])
    return out.select("s_suppkey", "s_acctbal_scaled", "s_acctbal_rel")


def year_indicators(t):
    """Long (nation, year, indicator, value): yearly order sums per priority, even-numbered gaps left missing."""
    orders = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return (
        orders.filter(F.col("o_orderstatus") == "F")
        .groupBy("c_nationkey", F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("indicator"))
        .agg(N.exact_sum("o_totalprice").alias("raw"))
        .withColumn("value", N.within("raw", 300000))
        .drop("raw")
    )


YEAR_INDICATORS = """
    yi AS (SELECT c_nationkey, YEAR(o_orderdate) AS year, o_orderpriority AS indicator,
                  CASE WHEN CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) >= 300000
                       THEN CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) END AS value
           FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3)"""
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(
    "agg_pivot_indicator",
    f"""WITH {YEAR_INDICATORS} SELECT c_nationkey, year,
        {', '.join(f"MAX(value) FILTER (WHERE indicator = '{p}') AS \"{p}\"" for p in PRIORITIES)}
        FROM yi GROUP BY c_nationkey, year""",
)
def agg_pivot_indicator(t):
    return A.pivot_first(year_indicators(t), ["c_nationkey", "year"], "indicator", "value", PRIORITIES)


@query(
    "agg_indicator_coverage",
    f"""WITH {YEAR_INDICATORS}, e AS (SELECT year, c_nationkey, COUNT(DISTINCT indicator) AS indicators FROM yi
        WHERE value IS NOT NULL GROUP BY ALL) SELECT year, indicators, COUNT(*) AS entities FROM e GROUP BY ALL""",
)
def agg_indicator_coverage(t):
    return A.indicator_coverage(year_indicators(t), "year", "c_nationkey", "indicator", "value")


@query("agg_crosstab", "SELECT p_brand, p_type, COUNT(*) AS n FROM part GROUP BY ALL")
def agg_crosstab(t):
    return S.crosstab(t.part, "p_brand", "p_type")


@query(
    "agg_corr_matrix",
    """SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, ROUND(CORR(l_quantity, l_extendedprice), 6) AS corr FROM lineitem
       UNION ALL SELECT 'l_quantity', 'l_discount', ROUND(CORR(l_quantity, l_discount), 6) FROM lineitem
       UNION ALL SELECT 'l_quantity', 'l_tax', ROUND(CORR(l_quantity, l_tax), 6) FROM lineitem
       UNION ALL SELECT 'l_extendedprice', 'l_discount', ROUND(CORR(l_extendedprice, l_discount), 6) FROM lineitem
       UNION ALL SELECT 'l_extendedprice', 'l_tax', ROUND(CORR(l_extendedprice, l_tax), 6) FROM lineitem
       UNION ALL SELECT 'l_discount', 'l_tax', ROUND(CORR(l_discount, l_tax), 6) FROM lineitem""",
)
def agg_corr_matrix(t):
    pairs = S.correlation_pairs(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return pairs.withColumn("corr", F.round("corr", 6))


@query(
    "agg_eta_squared",
    """WITH long AS (SELECT event_type AS k, 'value' AS "column", value AS v FROM events
                     UNION ALL SELECT event_type, 'hour', hour(ts) FROM events),
       g AS (SELECT "column", AVG(v) AS gm, COUNT(*) AS rows FROM long GROUP BY ALL),
       c AS (SELECT "column", k, COUNT(*) AS n, AVG(v) AS m FROM long GROUP BY ALL),
       b AS (SELECT "column", SUM(n * POWER(m - gm, 2)) AS bss FROM c JOIN g USING ("column") GROUP BY ALL),
       w AS (SELECT "column", SUM(POWER(v - gm, 2)) AS tss, MAX(rows) AS rows FROM long JOIN g USING ("column") GROUP BY ALL)
       SELECT "column", rows, ROUND(bss / tss, 9) AS eta2, CASE WHEN bss / tss < 0.01 THEN 'negligible'
              WHEN bss / tss < 0.06 THEN 'small' WHEN bss / tss < 0.14 THEN 'medium' ELSE 'large' END AS effect
       FROM b JOIN w USING ("column")""",
)
def agg_eta_squared(t):
    events = t.events.select("event_type", "value", F.hour("ts").alias("hour"))
    return S.eta_squared(events, "event_type", ["value", "hour"]).withColumn("eta2", F.round("eta2", 9))


@query(
    "agg_chi2",
    """WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, COUNT(*) AS n FROM lineitem GROUP BY ALL),
       e AS (SELECT a, b, n, SUM(n) OVER (PARTITION BY a) * SUM(n) OVER (PARTITION BY b) / SUM(n) OVER () AS e FROM c)
       SELECT ROUND(SUM((n - e) * (n - e) / e), 6) AS chi2,
              CAST((COUNT(DISTINCT a) - 1) * (COUNT(DISTINCT b) - 1) AS BIGINT) AS dof, CAST(SUM(n) AS BIGINT) AS rows FROM e""",
)
def agg_chi2(t):
    """Statistic and degrees of freedom against SQL; the p-value is pinned in the unit tests."""
    out = S.chi_square(t.lineitem, "l_returnflag", "l_linestatus")
    return out.select(F.round("chi2", 6).alias("chi2"), "dof", "rows")


@query("agg_chi2_p_value")
def agg_chi2_p_value(t):
    return S.chi_square(t.events, "event_type", "user_id").withColumn("chi2", F.round("chi2", 6))


@query(
    "agg_term_doc_freq",
    """WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_split_to_array(LOWER(text), '[ \\.,]')) AS term FROM documents)
       SELECT TRIM(term, E' \\t\\n\\r') AS term, COUNT(DISTINCT doc_id) AS n FROM w
       WHERE LENGTH(TRIM(term, E' \\t\\n\\r')) >= 4 GROUP BY 1""",
)
def agg_term_doc_freq(t):
    return A.term_document_frequency(t.documents, X.terms("text", " .,", 4))


@query(
    "agg_term_freq",
    """WITH w AS (SELECT unnest(regexp_split_to_array(LOWER(text), '[^\\p{L}]+')) AS term FROM documents)
       SELECT term, COUNT(*) AS n, COUNT(*) > 500 AS stop FROM w WHERE LENGTH(term) >= 4 GROUP BY term""",
)
def agg_term_freq(t):
    counts = t.documents.select(F.explode(X.tokens("text")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("stop", F.col("n") > 500)


@query(
    "agg_tag_count",
    """SELECT page_id, len(list_distinct(list_filter(list_transform(string_split(url, '/'), lambda x: TRIM(LOWER(x))),
              lambda x: x <> ''))) AS tags FROM pages""",
)
def agg_tag_count(t):
    return t.pages.select("page_id", F.size(X.distinct_tags("url", "/")).cast("long").alias("tags"))


@query(
    "agg_dup_groups",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""",
)
def agg_dup_groups(t):
    return A.duplicate_groups(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "agg_share",
    f"""WITH w AS (SELECT {', '.join(f"{dec(f'''CASE WHEN p_type = '{k}' THEN l_extendedprice ELSE 0 END''')} AS {k}"
                                      for k in ('ECONOMY', 'LARGE', 'PROMO', 'SMALL'))}
                   FROM lineitem JOIN part ON l_partkey = p_partkey),
        l AS (SELECT unnest(['ECONOMY', 'LARGE', 'PROMO', 'SMALL']) AS category,
                     unnest([ECONOMY, LARGE, PROMO, SMALL]) AS total, ECONOMY + LARGE + PROMO + SMALL AS g FROM w)
        SELECT category, total, total / g AS share FROM l""",
)
def agg_share(t):
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    kinds = ["ECONOMY", "LARGE", "PROMO", "SMALL"]
    wide = lines.select(*[F.when(F.col("p_type") == k, F.col("l_extendedprice")).otherwise(0.0).alias(k) for k in kinds])
    return C.column_shares(wide, kinds)


@query(
    "agg_class_ratio",
    """SELECT COUNT(*) FILTER (WHERE toxic = 0) AS n0, COUNT(*) FILTER (WHERE toxic = 1) AS n1,
              COUNT(*) FILTER (WHERE toxic = 0)::DOUBLE / NULLIF(COUNT(*) FILTER (WHERE toxic = 1), 0) AS ratio FROM labels""",
)
def agg_class_ratio(t):
    sizes = t.labels.agg(
        F.count(F.when(F.col("toxic") == 0, 1)).alias("n0"), F.count(F.when(F.col("toxic") == 1, 1)).alias("n1")
    )
    return sizes.withColumn("ratio", N.ratio("n0", "n1"))


@query(
    "agg_visual_hist",
    """WITH c AS (SELECT l_suppkey, l_linenumber AS w, COUNT(*) AS n FROM lineitem GROUP BY ALL),
       s AS (SELECT l_suppkey, SUM(n) AS total FROM c GROUP BY ALL)
       SELECT s.l_suppkey, r.w::INT AS word, COALESCE(c.n, 0) / total::DOUBLE AS share
       FROM s, (SELECT unnest(range(0, 8)) AS w) r LEFT JOIN c ON c.l_suppkey = s.l_suppkey AND c.w = r.w""",
)
def agg_visual_hist(t):
    hist = A.visual_histogram(t.lineitem, "l_suppkey", "l_linenumber", 8)
    return hist.select("l_suppkey", F.posexplode("histogram").alias("word", "share"))


@query(
    "agg_corrected_moments",
    """SELECT 'value' AS "column", COUNT(value) AS n, ROUND(skewness(value), 6) AS skew, ROUND(kurtosis(value), 6) AS kurtosis
       FROM events""",
)
def agg_corrected_moments(t):
    out = corrected_moments(t.events, ["value"])
    return out.select("column", "n", F.round("skew", 6).alias("skew"), F.round("kurtosis", 6).alias("kurtosis"))
