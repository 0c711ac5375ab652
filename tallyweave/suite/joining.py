"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions import numeric as N
from tallyweave.operators import joins as J
from tallyweave.operators import neighbours as NB
from tallyweave.operators.aggregates import profile_by_key
from tallyweave.suite.aggregation import dec
from tallyweave.suite.registry import query


@query(
    "jn_left_chain",
    f"""SELECT c.c_custkey, COUNT(DISTINCT o_orderkey) AS orders, COUNT(l_orderkey) AS items,
        {dec('l_extendedprice')} AS amount, COUNT(DISTINCT p_type) AS types, COUNT(DISTINCT s_nationkey) AS from_nations
        FROM customer c LEFT JOIN orders ON c_custkey = o_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
        LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
        WHERE o_orderstatus NOT IN ('P') GROUP BY c.c_custkey""",
)
def jn_left_chain(t):
    chain = (
        t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(t.lineitem, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(t.part, F.col("p_partkey") == F.col("l_partkey"), "left")
        .join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"), "left")
        .filter("o_orderstatus NOT IN ('P')")
    )
    return chain.groupBy("c_custkey").agg(
        F.count_distinct("o_orderkey").alias("orders"),
        F.count("l_orderkey").alias("items"),
        N.exact_sum("l_extendedprice").alias("amount"),
        F.count_distinct("p_type").alias("types"),
        F.count_distinct("s_nationkey").alias("from_nations"),
    )


@query(
    "jn_left_merge",
    """WITH a AS (SELECT o_custkey AS k, COUNT(*) AS "ORD_NB_ROWS", MAX(o_totalprice) AS mx FROM orders
                  WHERE o_orderstatus = 'O' GROUP BY 1),
       b AS (SELECT o_custkey AS k, COUNT(*) AS n, SUM(l_quantity) AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey
             WHERE l_returnflag = 'R' GROUP BY 1)
       SELECT c_custkey, "ORD_NB_ROWS" AS open_orders, mx AS open_max, n AS returned, q AS returned_qty
       FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN b ON b.k = c_custkey""",
)
def jn_left_merge(t):
    opened = profile_by_key(
        t.orders.filter("o_orderstatus = 'O'").select("o_custkey", "o_totalprice"), "o_custkey", "ORD"
    )
    back = profile_by_key(
        t.lineitem.filter("l_returnflag = 'R'")
        .join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("o_custkey", "l_quantity"),
        "o_custkey",
        "RET",
    )
    main = t.customer.withColumnRenamed("c_custkey", "o_custkey").select("o_custkey")
    return (
        main.join(opened, "o_custkey", "left")
        .join(back, "o_custkey", "left")
        .select(
            F.col("o_custkey").alias("c_custkey"),
            F.col("ORD_NB_ROWS").alias("open_orders"),
            F.col("ORD_o_totalprice_max").alias("open_max"),
            F.col("RET_NB_ROWS").alias("returned"),
            F.col("RET_l_quantity_sum").alias("returned_qty"),
        )
    )


@query("jn_inner_merge", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def jn_inner_merge(t):
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query(
    "jn_implicit_inner",
    """SELECT o_orderkey, c_name, n_name FROM orders, customer, nation
       WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = 2""",
)
def jn_implicit_inner(t):
    for name in ("orders", "customer", "nation"):
        getattr(t, name).createOrReplaceTempView(f"ii_{name}")
    return t.spark.sql(
        """SELECT o_orderkey, c_name, n_name FROM ii_orders, ii_customer, ii_nation
           WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = 2"""
    )


@query(
    "jn_semi_isin",
    "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AND lang IN ('en','fr')",
)
def jn_semi_isin(t):
    return (
        t.documents.join(t.labels.filter("quality = 1"), "doc_id", "left_semi")
        .filter(F.col("lang").isin("en", "fr"))
        .select("doc_id", "lang")
    )


@query(
    "jn_semi_insubquery",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT MAX(o_orderkey) FROM orders GROUP BY o_custkey)",
)
def jn_semi_insubquery(t):
    last = t.orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("o_orderkey")).select("o_orderkey")
    return t.orders.join(last, "o_orderkey", "left_semi").select("o_orderkey", "o_custkey")


@query("jn_anti", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def jn_anti(t):
    return t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id", "source")


@query(
    "jn_corr_scalar",
    f"""SELECT c_custkey,
          (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) AS nb_orders,
          (SELECT {dec('o_totalprice')} / COUNT(*) FROM orders WHERE o_custkey = c_custkey) AS avg_order,
          (SELECT {dec('o_totalprice')} FROM orders WHERE o_custkey = c_custkey AND o_orderstatus <> 'P') AS settled,
          (SELECT {dec('l_quantity')} FROM lineitem, orders WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey) AS qty,
          (SELECT COUNT(*) FROM lineitem, orders WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey
             AND l_returnflag = 'R') AS returned,
          (SELECT COUNT(*) FROM supplier WHERE s_nationkey = c_nationkey) AS local_suppliers
        FROM customer""",
)
def jn_corr_scalar(t):
    """Correlated scalars as one grouped scan per fact table."""
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("nb_orders"),
        N.exact_avg("o_totalprice").alias("avg_order"),
        N.exact_sum(F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice"))).alias("settled"),
    )
    lines = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(N.exact_sum("l_quantity").alias("qty"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("returned"))
    )
    local = t.supplier.groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.count(F.lit(1)).alias("local_suppliers"))
    out = (
        t.customer.select("c_custkey", "c_nationkey")
        .join(orders, "c_custkey", "left")
        .join(lines, "c_custkey", "left")
        .join(local, "c_nationkey", "left")
    )
    return out.drop("c_nationkey").fillna(0, subset=["nb_orders", "returned", "local_suppliers"])


PREFIX_SQL = """
    g AS (SELECT CAST(s_suppkey AS VARCHAR) AS zip, s_nationkey AS state, s_acctbal AS lat FROM supplier),
    c AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS zip, c_nationkey AS state FROM customer)"""


def geo_tables(t):
    """Customers with a code, places with a code prefix, both within a nation."""
    places = t.supplier.select(
        F.col("s_suppkey").cast("string").alias("zip_prefix"),
        F.col("s_nationkey").alias("state"),
        F.col("s_acctbal").alias("lat"),
    )
    people = t.customer.select(
        "c_custkey", F.col("c_custkey").cast("string").alias("zip"), F.col("c_nationkey").alias("state")
    )
    return people, places


@query(
    "jn_prefix_theta",
    f"""WITH {PREFIX_SQL} SELECT c_custkey, c.zip, g.zip AS zip_prefix, g.lat
        FROM c JOIN g ON c.state = g.state AND starts_with(c.zip, g.zip)""",
)
def jn_prefix_theta(t):
    """All matches: a code has few prefixes, so it is cut into them and joined on equality."""
    people, places = geo_tables(t)
    cuts = people.withColumn(
        "zip_prefix",
        F.explode(F.transform(F.sequence(F.lit(1), F.length("zip")), lambda n: F.substring("zip", F.lit(1), n))),
    )
    return cuts.join(places, ["state", "zip_prefix"]).select("c_custkey", "zip", "zip_prefix", "lat")


@query(
    "jn_scalar_first",
    f"""WITH {PREFIX_SQL} SELECT c_custkey, (SELECT g.lat FROM g WHERE c.state = g.state AND starts_with(c.zip, g.zip)
        ORDER BY LENGTH(g.zip) DESC, g.lat LIMIT 1) AS lat FROM c""",
)
def jn_scalar_first(t):
    people, places = geo_tables(t)
    found = J.by_longest_prefix(people, "zip", places, "zip_prefix", ["state"], ["lat"])
    return found.select("c_custkey", "lat")


SEGMENT_GROUPS = {"BUILDING": "construction", "MACHINERY": "construction", "HOUSEHOLD": "home", "FURNITURE": "home"}


@query(
    "jn_lookup_map",
    """SELECT c_custkey, 'seg_' || CASE WHEN c_mktsegment IN ('BUILDING','MACHINERY') THEN 'construction'
              WHEN c_mktsegment IN ('HOUSEHOLD','FURNITURE') THEN 'home' ELSE 'NA' END AS grp FROM customer""",
)
def jn_lookup_map(t):
    return t.customer.select("c_custkey", J.map_codes("c_mktsegment", SEGMENT_GROUPS, "NA", "seg_").alias("grp"))


@query(
    "jn_lookup_derived",
    """WITH h AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal > 0 THEN n_regionkey END AS region
                  FROM customer JOIN nation ON c_nationkey = n_nationkey),
       l AS (SELECT c_nationkey, MIN(region) AS learned FROM h GROUP BY 1)
       SELECT c_custkey, COALESCE(region, learned) AS region FROM h LEFT JOIN l USING (c_nationkey)""",
)
def jn_lookup_derived(t):
    holed = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_nationkey", F.when(F.col("c_acctbal") > 0, F.col("n_regionkey")).alias("region")
    )
    return J.learned_parent(holed, "c_nationkey", "region").select("c_custkey", "region")


@query(
    "jn_lookup_prefix",
    """WITH names AS (SELECT DISTINCT p_name || '_' || LOWER(p_type) || '_mean' AS name FROM part),
       d AS (SELECT p_name AS prefix, MIN(p_brand) AS description FROM part GROUP BY p_name
             UNION ALL SELECT DISTINCT split_part(p_name, ' ', 1), 'colour ' || split_part(p_name, ' ', 1) FROM part)
       SELECT name, (SELECT description FROM d WHERE starts_with(name, prefix) ORDER BY LENGTH(prefix) DESC, description LIMIT 1)
              AS description FROM names""",
)
def jn_lookup_prefix(t):
    names = t.part.select(F.concat("p_name", F.lit("_"), F.lower("p_type"), F.lit("_mean")).alias("name")).distinct()
    colour = F.element_at(F.split("p_name", " "), 1)
    table = t.part.groupBy(F.col("p_name").alias("prefix")).agg(F.min("p_brand").alias("description")).unionByName(
        t.part.select(colour.alias("prefix"), F.concat(F.lit("colour "), colour).alias("description")).distinct()
    )
    return J.describe_names(names, "name", table, "prefix", "description")


@query(
    "jn_nearest_geo",
    """WITH p AS (SELECT c_custkey AS id, c_acctbal / 1000 AS x, c_nationkey::DOUBLE AS y,
                         CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS area FROM customer)
       SELECT a.id AS c_custkey, COALESCE(a.area, (SELECT b.area FROM p b WHERE b.area IS NOT NULL
              ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.id LIMIT 1)) AS area FROM p a""",
)
def jn_nearest_geo(t):
    points = t.customer.select(
        "c_custkey",
        (F.col("c_acctbal") / 1000).alias("x"),
        F.col("c_nationkey").cast("double").alias("y"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("area"),
    )
    return NB.impute_from_nearest(points, "c_custkey", "area", F.array("x", "y")).select("c_custkey", "area")


@query(
    "jn_nearest_string",
    """WITH a AS (SELECT DISTINCT LOWER(p_name) || ' ' || LOWER(p_brand) || ' ' || LOWER(p_type) AS s FROM part),
       qs AS (SELECT DISTINCT REPLACE(LOWER(s_name), 'supplier', 'red bolt brand') || ' small' AS s FROM supplier),
       m AS (SELECT qs.s AS text, a.s AS nearest, 1.0::DOUBLE - levenshtein(qs.s, a.s) / GREATEST(LENGTH(qs.s), LENGTH(a.s)) AS sim
             FROM qs, a)
       SELECT text, nearest, ROUND(sim, 6) AS similarity FROM m
       QUALIFY ROW_NUMBER() OVER (PARTITION BY text ORDER BY sim DESC, nearest) = 1""",
)
def jn_nearest_string(t):
    known = t.part.select(F.concat_ws(" ", F.lower("p_name"), F.lower("p_brand"), F.lower("p_type")).alias("text"))
    asked = t.supplier.select(
        F.concat(F.replace(F.lower("s_name"), F.lit("supplier"), F.lit("red bolt brand")), F.lit(" small")).alias("text")
    )
    return NB.nearest_text(asked, known).withColumn("similarity", F.round("similarity", 6))


@query(
    "jn_knn",
    """WITH d AS (SELECT a.vec_id AS id, b.vec_id AS other, b.label,
                         list_sum(list_transform(list_zip(a.embedding, b.embedding),
                           lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))) AS d2
                  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
       SELECT id AS vec_id, other, ROUND(d2, 6) AS dist2, rank FROM (
         SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY id ORDER BY d2, other) AS INT) AS rank FROM d) WHERE rank <= 3""",
)
def jn_knn(t):
    refs = t.embeddings.withColumnRenamed("vec_id", "other")
    out = NB.nearest(t.embeddings, refs, 3, "vec_id", "other", "embedding", skip_same_id=True)
    return out.withColumn("dist2", F.round("dist2", 6))


@query(
    "jn_knn_class",
    """WITH f AS (SELECT doc_id, quality, ARRAY[LN(1 + n_chars),
                     LN(1 + LENGTH(REGEXP_REPLACE(text, '[^ ]', '', 'g'))),
                     LN(1 + LENGTH(REGEXP_REPLACE(text, '[^,.]', '', 'g')))] AS v
                  FROM documents LEFT JOIN labels USING (doc_id)),
       m AS (SELECT a.doc_id, b.quality, ROW_NUMBER() OVER (PARTITION BY a.doc_id ORDER BY
                 ROUND(POWER(a.v[1]-b.v[1], 2) + POWER(a.v[2]-b.v[2], 2) + POWER(a.v[3]-b.v[3], 2), 12), b.doc_id) AS rank
             FROM f a JOIN f b ON a.quality IS NULL AND b.quality IS NOT NULL)
       SELECT doc_id, quality FROM m WHERE rank = 1 UNION ALL SELECT doc_id, quality FROM f WHERE quality IS NOT NULL""",
)
def jn_knn_class(t):
    """Documents without a label take that of the nearest labelled one by length measures."""
    docs = t.documents.join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    count = lambda p: F.length(F.regexp_replace("text", p, ""))
    v = F.array(F.log1p("n_chars"), F.log1p(count("[^ ]")), F.log1p(count("[^,.]")))
    return NB.impute_from_nearest(docs, "doc_id", "quality", v).select("doc_id", "quality")


@query(
    "jn_grid_complete",
    """WITH s AS (SELECT l_suppkey, l_quantity, COUNT(*) AS n FROM lineitem GROUP BY ALL)
       SELECT a.l_suppkey, b.l_quantity, COALESCE(n, 0) AS n FROM (SELECT DISTINCT l_suppkey FROM s) a
       CROSS JOIN (SELECT DISTINCT l_quantity FROM s) b LEFT JOIN s USING (l_suppkey, l_quantity)""",
)
def jn_grid_complete(t):
    counts = t.lineitem.groupBy("l_suppkey", "l_quantity").agg(F.count(F.lit(1)).alias("n"))
    return J.complete_grid(counts, "l_suppkey", "l_quantity", ["n"])


@query(
    "jn_cohort",
    f"""WITH s AS (SELECT o_custkey, COUNT(*) AS n, {dec('o_totalprice')} AS m FROM orders WHERE o_orderdate < '1998-01-01' GROUP BY 1),
        e AS (SELECT o_custkey, COUNT(*) AS n, {dec('o_totalprice')} AS m FROM orders GROUP BY 1)
        SELECT s.o_custkey, s.n AS n_a, e.n AS n_b, s.m AS m_a, e.m AS m_b FROM s JOIN e USING (o_custkey)""",
)
def jn_cohort(t):
    totals = lambda o: o.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), N.exact_sum("o_totalprice").alias("m")
    )
    early = totals(t.orders.filter(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")))
    return J.cohort(early, totals(t.orders), "o_custkey", ["n", "m"])
