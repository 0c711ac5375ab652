"""Feature-engineering, vector, text and model queries."""

from __future__ import annotations

import datetime as dt
import functools

import numpy as np
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tallyweave.functions import text as X
from tallyweave.operators import clustering as K
from tallyweave.operators import density as D
from tallyweave.operators import evaluation as E
from tallyweave.operators import features as FE
from tallyweave.operators import modelling as ML
from tallyweave.operators import pluggable as P
from tallyweave.operators import textfeatures as T
from tallyweave.operators.sampling import hash_split, unit_hash
from tallyweave.plans import catalogue as G
from tallyweave.plans import images as I
from tallyweave.plans import rfm as R
from tallyweave.plans import stability as ST
from tallyweave.session import scratch_path, spread, staged, staged_paths
from tallyweave.suite.filters import HOLED, holed_customers
from tallyweave.suite.ordering import _hash
from tallyweave.suite.registry import query
from tallyweave.suite.shop import EXCLUDED, GROUPS, PAYMENTS, shop

# --- imputation, scaling, encoding -----------------------------------------------------------------


@query(
    "ml_impute_simple",
    f"""WITH {HOLED}, m AS (SELECT quantile_cont(balance, 0.5) AS mb FROM holed),
        s AS (SELECT segment AS ms FROM holed WHERE segment IS NOT NULL GROUP BY segment ORDER BY COUNT(*) DESC, segment LIMIT 1)
        SELECT c_custkey, ROUND(COALESCE(balance, mb), 6) AS balance, COALESCE(segment, ms) AS segment FROM holed, m, s""",
)
def ml_impute_simple(t):
    holed = holed_customers(t)
    out = FE.SimpleImpute(columns=["balance", "segment"]).fit(holed).transform(holed)
    return out.select("c_custkey", F.round("balance", 6).alias("balance"), "segment")


def _knn_eval_sql():
    cols, parts = ["a", "b", "c"], []
    for c in cols:
        others = [o for o in cols if o != c]
        d = " + ".join(f"(x.{o} - y.{o}) * (x.{o} - y.{o})" for o in others)
        parts.append(
            f"""SELECT '{c}' AS "column", k, ROUND(AVG(ABS(fill - truth) / NULLIF(ABS(truth), 0)), 6) AS mean_error,
                ROUND(MAX(ABS(fill - truth) / NULLIF(ABS(truth), 0)), 6) AS max_error, COUNT(*) AS cells FROM (
                SELECT id, k, ANY_VALUE(truth) AS truth, AVG(value) FILTER (WHERE rank <= k) AS fill FROM (
                  SELECT x.id, x.r{c} AS truth, y.r{c} AS value, ROW_NUMBER() OVER (PARTITION BY x.id ORDER BY {d}, y.id) AS rank
                  FROM s x JOIN s y ON {_hash('x.id', c)} < 0.25 AND {_hash('y.id', c)} >= 0.25), (SELECT unnest([1, 3]) AS k)
                WHERE rank <= 3 GROUP BY id, k) GROUP BY k"""
        )
    return (
        """WITH f AS (SELECT s_suppkey AS id, s_acctbal AS a, AVG(l_quantity) AS b, COUNT(*)::DOUBLE AS c
             FROM supplier JOIN lineitem ON l_suppkey = s_suppkey GROUP BY 1, 2),
           s AS (SELECT id, a AS ra, b AS rb, c AS rc, (a - MIN(a) OVER ()) / (MAX(a) OVER () - MIN(a) OVER ()) AS a,
                 (b - MIN(b) OVER ()) / (MAX(b) OVER () - MIN(b) OVER ()) AS b, (c - MIN(c) OVER ()) / (MAX(c) OVER () - MIN(c) OVER ()) AS c
                 FROM f) """
        + " UNION ALL ".join(parts)
    )


@query("ml_knn_impute_eval", _knn_eval_sql())
def ml_knn_impute_eval(t):
    lines = t.lineitem.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.avg("l_quantity").alias("b"), F.count(F.lit(1)).cast("double").alias("c")
    )
    rows = staged(t.supplier.join(lines, "s_suppkey").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("a"), "b", "c"))
    out = G.imputation_error(rows, "id", ["a", "b", "c"], 0.25, [1, 3])
    return out.withColumns({c: F.round(c, 6) for c in ("mean_error", "max_error")})


@query(
    "ml_knn_class_eval",
    f"""WITH f AS (SELECT unnest([0.5, 1]::DOUBLE[]) AS fraction),
        s AS (SELECT vec_id AS id, embedding AS e, label, fraction, {_hash('vec_id', 'split')} < 0.25 AS test
              FROM embeddings JOIN f ON fraction >= 1 OR {_hash('vec_id', 'size')} < fraction),
        n AS (SELECT x.fraction, x.id, x.label AS truth, y.label AS vote, ROW_NUMBER() OVER (PARTITION BY x.fraction, x.id ORDER BY
                list_sum(list_transform(list_zip(x.e, y.e), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) * (p[1]::DOUBLE - p[2]::DOUBLE))), y.id) AS rank
              FROM s x JOIN s y ON x.fraction = y.fraction AND x.test AND NOT y.test),
        v AS (SELECT fraction, k, id, truth, vote, COUNT(*) FILTER (WHERE rank <= k) AS votes FROM n, (SELECT unnest([1, 5]) AS k)
              WHERE rank <= 5 GROUP BY ALL),
        c AS (SELECT fraction, k, id, truth, vote FROM v QUALIFY ROW_NUMBER() OVER (PARTITION BY fraction, k, id ORDER BY votes DESC, vote) = 1)
        SELECT fraction, k, ROUND(AVG((vote <> truth)::INT), 6) AS error, COUNT(*) AS tested FROM c GROUP BY fraction, k""",
)
def ml_knn_class_eval(t):
    out = E.knn_error_by_size(t.embeddings, "vec_id", "embedding", "label", [0.5, 1.0], [1, 5])
    return out.withColumn("error", F.round("error", 6))


@query(
    "ml_log_skewed",
    """WITH f AS (SELECT event_id, value, POWER(value, 3) / 1000 AS cubed, hour(ts)::DOUBLE AS hour FROM events),
       d AS (SELECT kurtosis(value) > 8 OR ABS(skewness(value)) > 1 AS l1, kurtosis(cubed) > 8 OR ABS(skewness(cubed)) > 1 AS l2,
                    kurtosis(hour) > 8 OR ABS(skewness(hour)) > 1 AS l3 FROM f)
       SELECT event_id, ROUND(CASE WHEN l1 THEN LN(1 + value) ELSE value END, 6) AS value,
              ROUND(CASE WHEN l2 THEN LN(1 + cubed) ELSE cubed END, 6) AS cubed,
              ROUND(CASE WHEN l3 THEN LN(1 + hour) ELSE hour END, 6) AS hour FROM f, d""",
)
def ml_log_skewed(t):
    events = t.events.select(
        "event_id", "value", (F.pow("value", F.lit(3)) / 1000).alias("cubed"), F.hour("ts").cast("double").alias("hour")
    )
    out = FE.LogSkewed(columns=["value", "cubed", "hour"]).fit(events).transform(events)
    return out.select("event_id", *[F.round(c, 6).alias(c) for c in ("value", "cubed", "hour")])


@query(
    "ml_scale_standard",
    """SELECT p_partkey, ROUND((p_size - AVG(p_size) OVER ()) / STDDEV_POP(p_size) OVER (), 6) AS p_size,
              ROUND((p_retailprice - AVG(p_retailprice) OVER ()) / STDDEV_POP(p_retailprice) OVER (), 6) AS p_retailprice,
              0.0::DOUBLE AS constant FROM part""",
)
def ml_scale_standard(t):
    rows = t.part.select("p_partkey", "p_size", "p_retailprice", F.lit(3.0).alias("constant"))
    cols = ["p_size", "p_retailprice", "constant"]
    out = FE.Scale(columns=cols, method="standard").fit(rows).transform(rows)
    return out.select("p_partkey", *[F.round(c, 6).alias(c) for c in cols])


@query(
    "ml_scale_minmax",
    """SELECT p_partkey, ROUND((p_size - MIN(p_size) OVER ()) / (MAX(p_size) OVER () - MIN(p_size) OVER ()), 6) AS scaled,
              p_size::DOUBLE AS restored FROM part""",
)
def ml_scale_minmax(t):
    rows = t.part.select("p_partkey", "p_size")
    model = FE.Scale(columns=["p_size"], method="minmax").fit(rows)
    scaled = model.transform(rows)
    back = model.inverse(scaled).withColumnRenamed("p_size", "restored")
    return scaled.withColumnRenamed("p_size", "scaled").join(back, "p_partkey").select(
        "p_partkey", F.round("scaled", 6).alias("scaled"), F.round("restored", 6).alias("restored")
    )


@query(
    "ml_onehot",
    """SELECT c_custkey, (c_mktsegment = 'AUTOMOBILE')::INT AS "seg[AUTOMOBILE]", (c_mktsegment = 'BUILDING')::INT AS "seg[BUILDING]",
              (c_mktsegment = 'HOUSEHOLD')::INT AS "seg[HOUSEHOLD]", (c_mktsegment = 'MACHINERY')::INT AS "seg[MACHINERY]" FROM customer""",
)
def ml_onehot(t):
    """Fitted without one segment: rows of that segment get all zeros."""
    rows = t.customer.select("c_custkey", F.col("c_mktsegment").alias("seg"))
    return FE.OneHot(columns=["seg"]).fit(rows.filter("seg <> 'FURNITURE'")).transform(rows)


@query(
    "ml_string_index",
    """WITH n AS (SELECT p_brand, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, p_brand) - 1 AS i FROM part GROUP BY p_brand)
       SELECT p_partkey, i::DOUBLE AS brand_index FROM part JOIN n USING (p_brand)""",
)
def ml_string_index(t):
    return StringIndexer(inputCol="p_brand", outputCol="brand_index").fit(t.part).transform(t.part).select("p_partkey", "brand_index")


# --- vectors ---------------------------------------------------------------------------------------


@query("ml_pca")
def ml_pca(t):
    return K.Projection("embedding", 10).fit(t.embeddings).variance(t.embeddings)


@query(
    "ml_pca_round_trip",
    "SELECT COUNT(*) AS n, TRUE AS restored FROM embeddings",
)
def ml_pca_round_trip(t):
    """All 64 components restore every vector."""
    projection = K.Projection("embedding", 64).fit(t.embeddings)
    back = projection.inverse(projection.transform(t.embeddings))
    far = F.exists(F.arrays_zip("embedding", "restored"), lambda p: F.abs(p["embedding"] - p["restored"]) > 1e-6)
    return back.agg(F.count(F.lit(1)).alias("n"), (~F.max(far)).alias("restored"))


@query("ml_kmeans")
def ml_kmeans(t):
    return K.kmeans_scan(t.embeddings, "embedding", range(2, 16))


@query(
    "ml_cluster_scores",
    """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
       p AS (SELECT a.vec_id, a.label AS la, b.label AS lb, SUM(list_sum(list_transform(list_zip(a.v, b.v),
                    lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS s, COUNT(*) AS n FROM e a, e b GROUP BY 1, 2, 3),
       own AS (SELECT vec_id, s / NULLIF(n - 1, 0) AS a FROM p WHERE la = lb),
       oth AS (SELECT vec_id, MIN(s / n) AS b FROM p WHERE la <> lb GROUP BY 1),
       sil AS (SELECT AVG(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / GREATEST(a, b) END) AS silhouette FROM own JOIN oth USING (vec_id)),
       l AS (SELECT label, unnest(v) AS x, unnest(range(64)) AS i FROM e),
       c AS (SELECT label, i, COUNT(*) AS n, AVG(x) AS m, VAR_POP(x) * COUNT(*) AS w FROM l GROUP BY 1, 2),
       g AS (SELECT i, SUM(n * m) / SUM(n) AS g, SUM(n) AS rows FROM c GROUP BY 1),
       t AS (SELECT SUM(w) AS inertia, SUM(n * (m - g) * (m - g)) AS between, MAX(rows) AS rows, COUNT(DISTINCT label) AS k
             FROM c JOIN g USING (i))
       SELECT ROUND(silhouette, 6) AS silhouette, ROUND((between / (k - 1)) / (inertia / (rows - k)), 6) AS calinski_harabasz,
              ROUND(inertia, 6) AS inertia FROM t, sil""",
)
def ml_cluster_scores(t):
    out = K.cluster_scores(t.embeddings, "embedding", "label")
    return out.select(*[F.round(c, 6).alias(c) for c in ("silhouette", "calinski_harabasz", "inertia")])


@query("ml_cluster_hier")
def ml_cluster_hier(t):
    out = K.hierarchical(t.embeddings, "embedding", micro=24, k=5)
    return out.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("micro").alias("micro_clusters"))


def _points(t):
    """Suppliers' neighbours in two dimensions: balance against order volume, both scaled."""
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = t.customer.join(orders, "c_custkey")
    return rows.select("c_custkey", F.array(F.col("c_acctbal") / 1000, F.col("n").cast("double")).alias("v"))


POINTS = """
    p AS (SELECT c_custkey AS id, c_acctbal / 1000 AS x, n::DOUBLE AS y FROM customer
          JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey)"""


@query(
    "ml_density",
    f"""WITH RECURSIVE {POINTS},
        e AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM p a JOIN p b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.0225),
        core AS MATERIALIZED (SELECT a AS id FROM e GROUP BY a HAVING COUNT(*) >= 5),
        ce AS MATERIALIZED (SELECT a, b FROM e WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
        r(id, root) AS (SELECT id, id FROM core UNION SELECT ce.b, r.root FROM r JOIN ce ON ce.a = r.id AND r.root < ce.b),
        cl AS (SELECT id, MIN(root) AS cluster FROM r GROUP BY id),
        bo AS (SELECT a.id, cl.cluster FROM p a JOIN e ON e.a = a.id JOIN cl ON cl.id = e.b JOIN p b ON b.id = e.b
               WHERE a.id NOT IN (SELECT id FROM core)
               QUALIFY ROW_NUMBER() OVER (PARTITION BY a.id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.id) = 1)
        SELECT p.id AS c_custkey, COALESCE(cl.cluster, bo.cluster) AS cluster FROM p LEFT JOIN cl USING (id) LEFT JOIN bo USING (id)""",
)
def ml_density(t):
    return D.density_clusters(_points(t), "c_custkey", "v", 2, 0.15, 5)


MEASURES = """
    m AS (SELECT c_custkey AS id, ARRAY[c_acctbal / 2000, COUNT(*) / 4.0, AVG(o_totalprice) / 40000, MIN(o_totalprice) / 40000,
                 MAX(o_totalprice) / 80000, c_nationkey / 5.0]::DOUBLE[] AS v
          FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_acctbal, c_nationkey)"""
APART = "list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


@query(
    "ml_density_measures",
    f"""WITH RECURSIVE {MEASURES},
        e AS MATERIALIZED (SELECT a.id AS a, b.id AS b, {APART} AS d FROM m a JOIN m b
              ON ABS(a.v[1] - b.v[1]) <= 0.9 AND ABS(a.v[6] - b.v[6]) <= 0.9 AND {APART} <= 0.81),
        core AS MATERIALIZED (SELECT a AS id FROM e GROUP BY a HAVING COUNT(*) >= 6),
        ce AS MATERIALIZED (SELECT a, b FROM e WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
        r(id, root) AS (SELECT id, id FROM core UNION SELECT ce.b, r.root FROM r JOIN ce ON ce.a = r.id AND r.root < ce.b),
        cl AS (SELECT id, MIN(root) AS cluster FROM r GROUP BY id),
        bo AS (SELECT e.a AS id, cl.cluster FROM e JOIN cl ON cl.id = e.b WHERE e.a NOT IN (SELECT id FROM core)
               QUALIFY ROW_NUMBER() OVER (PARTITION BY e.a ORDER BY d, e.b) = 1)
        SELECT m.id AS c_custkey, COALESCE(cl.cluster, bo.cluster) AS cluster FROM m LEFT JOIN cl USING (id) LEFT JOIN bo USING (id)""",
)
def ml_density_measures(t):
    """Density clusters of customers in six dimensions."""
    price = F.col("o_totalprice")
    m = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_custkey", "c_acctbal", "c_nationkey").agg(
        F.count(F.lit(1)).alias("n"), F.avg(price).alias("mean"), F.min(price).alias("low"), F.max(price).alias("high")
    )
    scaled = [("c_acctbal", 2000), ("n", 4), ("mean", 40000), ("low", 40000), ("high", 80000), ("c_nationkey", 5)]
    rows = m.select("c_custkey", F.array(*[(F.col(c) / d).cast("double") for c, d in scaled]).alias("v"))
    return D.density_clusters(rows, "c_custkey", "v", 6, 0.9, 6)


@query(
    "ml_k_distance",
    f"""WITH {POINTS} SELECT id AS c_custkey, ROUND(SQRT(d), 6) AS k_distance FROM (SELECT a.id, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d,
        ROW_NUMBER() OVER (PARTITION BY a.id ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y), b.id) AS k
        FROM p a JOIN p b ON a.id <> b.id) WHERE k = 4""",
)
def ml_k_distance(t):
    out = D.k_distance(_points(t), "c_custkey", "v", 4)
    return out.withColumn("k_distance", F.round("k_distance", 6))


@query(
    "ml_cluster_profile",
    """WITH l AS (SELECT label, 'first' AS "column", embedding[1]::DOUBLE AS v FROM embeddings
                  UNION ALL SELECT label, 'norm', list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)) FROM embeddings)
       SELECT label, "column", COUNT(*) AS n, ROUND(quantile_cont(v, 0.05), 6) AS q05, ROUND(quantile_cont(v, 0.5), 6) AS q50,
              ROUND(quantile_cont(v, 0.95), 6) AS q95 FROM l GROUP BY 1, 2""",
)
def ml_cluster_profile(t):
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = t.embeddings.select("label", F.col("embedding")[0].cast("double").alias("first"), norm.alias("norm"))
    out = K.cluster_profile(rows, "label", ["first", "norm"], (0.05, 0.5, 0.95))
    return out.select("label", "column", "n", *[F.round(c, 6).alias(c) for c in ("q05", "q50", "q95")])


# --- labelings -------------------------------------------------------------------------------------


@query(
    "ml_ari",
    """WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, COUNT(*)::DOUBLE AS n FROM lineitem GROUP BY ALL),
       s AS (SELECT SUM(n * (n - 1) / 2) AS bo, SUM(n) AS n FROM c),
       a AS (SELECT SUM(m * (m - 1) / 2) AS sa FROM (SELECT SUM(n) AS m FROM c GROUP BY a)),
       b AS (SELECT SUM(m * (m - 1) / 2) AS sb FROM (SELECT SUM(n) AS m FROM c GROUP BY b))
       SELECT ROUND((bo - sa * sb / (n * (n - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (n * (n - 1) / 2)), 9) AS ari,
              n::BIGINT AS n FROM s, a, b""",
)
def ml_ari(t):
    return E.adjusted_rand_index(t.lineitem, "l_returnflag", "l_linestatus").withColumn("ari", F.round("ari", 9))


@query(
    "ml_label_map",
    """WITH c AS (SELECT source, lang, COUNT(*) AS n FROM documents GROUP BY ALL)
       SELECT source, lang, ROUND(n / SUM(n) OVER (PARTITION BY source), 6) AS share FROM c
       QUALIFY ROW_NUMBER() OVER (PARTITION BY source ORDER BY n DESC, lang) = 1""",
)
def ml_label_map(t):
    return E.majority_map(t.documents, "source", "lang").withColumn("share", F.round("share", 6))


@query(
    "ml_confusion_report",
    """WITH d AS (SELECT quality AS y, (n_chars > 300)::INT AS p FROM labels JOIN documents USING (doc_id)),
       k AS (SELECT unnest([0, 1]) AS c),
       r AS (SELECT c, COUNT(*) FILTER (WHERE y = c AND p = c) AS tp, COUNT(*) FILTER (WHERE p = c) AS np,
                    COUNT(*) FILTER (WHERE y = c) AS ny FROM d, k GROUP BY c),
       e AS (SELECT c::VARCHAR AS class, COALESCE(tp / NULLIF(np, 0), 0) AS precision, COALESCE(tp / NULLIF(ny, 0), 0) AS recall,
                    COALESCE(2 * tp / NULLIF(np + ny, 0), 0) AS f1, ny AS support FROM r),
       a AS (SELECT * FROM e UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1), SUM(support) FROM e
             UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
                    SUM(f1 * support) / SUM(support), SUM(support) FROM e)
       SELECT class, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1, support::BIGINT AS support FROM a""",
)
def ml_confusion_report(t):
    rows = t.labels.join(t.documents, "doc_id").select("quality", (F.col("n_chars") > 300).cast("int").alias("p"))
    out = E.confusion_report(rows, "quality", "p")
    return out.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("ml_cluster_stability")
def ml_cluster_stability(t):
    tables, start, weeks = shop(t), dt.datetime(1999, 12, 31, 23, 59, 59), range(1, 30)
    history = functools.cache(lambda: R.rfm_history(tables, str(start + dt.timedelta(weeks=weeks[-1])), EXCLUDED))

    def until(date: dt.datetime):
        # The weeks share one table of orders, staged before the first of them; the base is gathered by itself.
        later = history()
        table = later(str(date)) if date > start else R.rfm_table(tables, to_date=str(date), excluded=EXCLUDED)
        return R.feature_table(table, prefixes=("all_cats_",), category_groups=GROUPS, payment_groups=PAYMENTS)

    return ST.cluster_stability(until, "customer_unique_id", start, weeks)


# --- text ------------------------------------------------------------------------------------------

TOKENS = """tk AS (SELECT doc_id, unnest(regexp_split_to_array(LOWER(text), '[^\\p{L}]+')) AS term FROM documents)"""


@query("ml_bow", f"WITH {TOKENS} SELECT doc_id, term, COUNT(*) AS n FROM tk WHERE LENGTH(term) >= 4 GROUP BY ALL")
def ml_bow(t):
    return T.bag_of_words(t.documents, "doc_id", X.tokens("text"))


@query(
    "ml_tfidf",
    f"""WITH {TOKENS}, b AS (SELECT doc_id, term, COUNT(*) AS n FROM tk WHERE LENGTH(term) >= 4 GROUP BY ALL),
        f AS (SELECT term, COUNT(*) AS df FROM b GROUP BY 1), d AS (SELECT COUNT(*) AS total FROM documents),
        w AS (SELECT doc_id, b.term, n * (LN((total + 1) / (df + 1)) + 1) AS w FROM b JOIN f USING (term), d)
        SELECT doc_id, term, ROUND(w / SQRT(SUM(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""",
)
def ml_tfidf(t):
    return T.tf_idf(t.documents, "doc_id", X.tokens("text")).withColumn("weight", F.round("weight", 6))


def _tokenised(t):
    return staged(spread(t.documents.select("doc_id", X.tokens("text").alias("tokens")), "doc_id"), "tokens")


TOPICS = 7


def _topics(t):
    return T.topic_model(T.bag_of_words(t.documents, "doc_id", X.tokens("text")), "doc_id", TOPICS, iterations=10)


@query("ml_lda")
def ml_lda(t):
    """Topic of each document; one without words has equal shares."""
    docs, _, _ = _topics(t)
    shares = F.coalesce("shares", F.array_repeat(F.lit(1.0 / TOPICS), TOPICS))
    out = t.documents.select("doc_id").join(docs, "doc_id", "left").select("doc_id", shares.alias("s"))
    return out.select("doc_id", (F.array_position("s", F.array_max("s")) - 1).alias("topic"), F.array_max("s").alias("share"))


@query("top_terms_per_topic")
def top_terms_per_topic(t):
    _, terms, _ = _topics(t)
    return T.heaviest_terms(terms, 10)


@query("ml_word2vec")
def ml_word2vec(t):
    tokens = _tokenised(t)
    _, docs = T.word_vectors(tokens, "tokens", size=100, spent=staged_paths()[-1:])
    return docs.select("doc_id", F.col("doc_vector").alias("v"))


def _letter_model(weights):
    """Toy text model: weighted counts of a few letters."""

    def predict(texts):
        counts = np.stack([texts.str.count(letter).to_numpy() for letter in "aeiou"], axis=1)
        return counts * np.asarray(weights)

    return predict


@query(
    "ml_text_embed",
    f"""SELECT doc_id, {', '.join(f"(LENGTH(text) - LENGTH(REPLACE(text, '{c}', ''))) * {w}::DOUBLE AS {c}" for c, w in zip('aeiou', (1, 2, 0.5, 1, 4), strict=True))}
        FROM documents""",
)
def ml_text_embed(t):
    out = P.embed_text(t.documents.select("doc_id", "text"), "text", _letter_model, (1, 2, 0.5, 1, 4))
    return out.select("doc_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("aeiou")])


def _byte_model(scale):
    """Toy image model: size, number of '<' bytes and number of '>' bytes."""

    def predict(blobs):
        return np.array([[len(b) * scale, b.count(b"<"), b.count(b">")] for b in blobs])

    return predict


def _files(t):
    """Pages as files: their address as path, their source as binary content."""
    return t.pages.select(F.col("url").alias("path"), F.encode("html", "UTF-8").alias("content"), "page_id")


@query(
    "ml_image_featurise",
    """SELECT page_id, list_extract(string_split(url, '/'), -2) AS label, (strlen(html) * 0.5)::DOUBLE AS f0,
              (LENGTH(html) - LENGTH(REPLACE(html, '<', '')))::DOUBLE AS f1, (LENGTH(html) - LENGTH(REPLACE(html, '>', '')))::DOUBLE AS f2
       FROM pages""",
)
def ml_image_featurise(t):
    out = I.featurised(_files(t), _byte_model, 0.5)
    return out.select("page_id", "label", *[F.col("features")[i].cast("double").alias(f"f{i}") for i in range(3)])


@query("image_projection")
def image_projection(t):
    _, projected = I.project(I.featurised(_files(t), _byte_model, 0.5), 2)
    return I.flat_table(projected, 2)


# --- models ----------------------------------------------------------------------------------------


@query(
    "ml_experiment_log",
    """WITH c AS (SELECT 'returnflag' AS algorithm, l_returnflag AS a, l_linestatus AS b, COUNT(*)::DOUBLE AS n FROM lineitem GROUP BY ALL
                  UNION ALL SELECT 'linestatus', l_linestatus, l_linestatus, COUNT(*)::DOUBLE FROM lineitem GROUP BY ALL),
       s AS (SELECT algorithm, SUM(n * (n - 1) / 2) AS bo, SUM(n) AS n FROM c GROUP BY 1),
       a AS (SELECT algorithm, SUM(m * (m - 1) / 2) AS sa FROM (SELECT algorithm, SUM(n) AS m FROM c GROUP BY algorithm, a) GROUP BY 1),
       b AS (SELECT algorithm, SUM(m * (m - 1) / 2) AS sb FROM (SELECT algorithm, SUM(n) AS m FROM c GROUP BY algorithm, b) GROUP BY 1)
       SELECT algorithm, 'lineitem' AS input, 'none' AS projection, '{}' AS params,
              ROUND((bo - sa * sb / (n * (n - 1) / 2)) / ((sa + sb) / 2 - sa * sb / (n * (n - 1) / 2)), 6) AS score
       FROM s JOIN a USING (algorithm) JOIN b USING (algorithm)""",
)
def ml_experiment_log(t):
    path = scratch_path(t.spark, "runs")
    for name, column in (("returnflag", "l_returnflag"), ("linestatus", "l_linestatus")):
        score = E.adjusted_rand_index(t.lineitem, column, "l_linestatus").first()["ari"]
        E.append_run(t.spark, path, name, "lineitem", "none", "{}", score)
    return E.ranked_runs(t.spark, path).withColumn("score", F.round("score", 6))


def _order_rows(t):
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("qty"), F.sum("l_extendedprice").alias("price"), F.count(F.lit(1)).cast("double").alias("lines")
    )
    rows = t.orders.join(lines, "o_orderkey").withColumn("month", F.month("o_orderdate").cast("double"))
    return staged(rows.select("o_orderkey", "o_totalprice", "qty", "price", "lines", "month"), "order-rows")


def _split(df, row_id):
    parts = hash_split(df, row_id, 0.25)
    return parts.filter("split = 'train'").drop("split"), parts.filter("split = 'test'").drop("split")


@query("ml_regress_grid")
def ml_regress_grid(t):
    train, test = _split(_order_rows(t), "o_orderkey")
    return ML.regression_grid(train, test, "o_orderkey", "price", ["qty", "lines", "month"], folds=5)


ORDER_ROWS = f"""
    r AS (SELECT o_orderkey AS id, SUM(l_quantity) AS qty, SUM(l_extendedprice) / 1000 AS price, COUNT(*)::DOUBLE AS lines,
                 {_hash('o_orderkey', 'split')} < 0.25 AS test FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)"""


@query(
    "ml_regress_baselines",
    f"""WITH {ORDER_ROWS}, m AS (SELECT quantile_cont(price, 0.5) AS p FROM r WHERE NOT test),
        d AS (SELECT a.id, a.price AS y, b.price AS z, ROW_NUMBER() OVER (PARTITION BY a.id ORDER BY
                (a.qty - b.qty) * (a.qty - b.qty) + (a.lines - b.lines) * (a.lines - b.lines), b.id) AS k
              FROM r a JOIN r b ON a.test AND NOT b.test),
        e AS (SELECT 'baseline' AS estimator, price AS y, p FROM r, m WHERE test
              UNION ALL SELECT 'knn', ANY_VALUE(y), AVG(z) FROM d WHERE k <= 5 GROUP BY id)
        SELECT estimator, ROUND(1 - AVG((y - p) * (y - p)) / VAR_POP(y), 6) AS r2, ROUND(SQRT(AVG((y - p) * (y - p))), 6) AS rmse,
               COUNT(*) AS n FROM e GROUP BY estimator""",
)
def ml_regress_baselines(t):
    """The two estimators of the grid whose result SQL can state."""
    rows = _order_rows(t).withColumn("price", F.col("price") / 1000)
    train, test = _split(rows, "o_orderkey")
    out = ML.regression_grid(train, test, "o_orderkey", "price", ["qty", "lines"], names=("baseline", "knn"), folds=5)
    return out.select("estimator", F.round("r2", 6).alias("r2"), F.round("rmse", 6).alias("rmse"), "n")


@query("ml_target_log")
def ml_target_log(t):
    train, test = _split(_order_rows(t), "o_orderkey")
    names = ("baseline", "linear")
    return ML.regression_grid(
        train, test, "o_orderkey", "price", ["qty", "lines"], use_log=True, bounds=(0.0, 1e6), names=names, folds=5
    )


@query("ml_stacked_feature")
def ml_stacked_feature(t):
    train, test = _split(_order_rows(t), "o_orderkey")
    out = ML.stacked(train, test, "qty", ["lines", "month"], "price", ["lines"])
    return ML.scores(out, "price", "prediction")


def _labelled_docs(t):
    count = lambda p: F.length(F.regexp_replace("text", p, "")).cast("double")
    return staged(
        t.labels.join(t.documents, "doc_id").select(
            "doc_id",
            "quality",
            F.col("n_chars").cast("double").alias("chars"),
            count("[^ ]").alias("blanks"),
            count("[^.]").alias("stops"),
            count("[^0-9]").alias("digits"),
        ),
        "labelled",
    )


@query(
    "ml_fold_costs",
    f"""WITH r AS (SELECT doc_id, lang, source, toxic AS y, CAST(FLOOR({_hash('doc_id', 'fold')} * 5) AS INT) AS fold
                   FROM labels JOIN documents USING (doc_id)),
        c AS (SELECT lang, source, fold, SUM(y) AS ones, COUNT(*) AS n FROM r GROUP BY ALL),
        t AS (SELECT fold, SUM(SUM(ones)) OVER () - SUM(ones) AS o1, SUM(SUM(n)) OVER () - SUM(n) AS o_n FROM c GROUP BY fold),
        k AS (SELECT lang, source, fold, SUM(ones) OVER w - ones AS k1, SUM(n) OVER w - n AS kn FROM c WINDOW w AS (PARTITION BY lang, source)),
        s AS (SELECT r.fold, y, COALESCE(k1::DOUBLE / NULLIF(kn, 0), o1::DOUBLE / o_n) AS score
              FROM r JOIN k USING (lang, source, fold) JOIN t USING (fold)),
        h AS (SELECT fold, LEAST(100, FLOOR(score * 100))::INT AS b, SUM(y) AS pos, SUM(1 - y) AS neg FROM s GROUP BY ALL),
        a AS (SELECT * FROM h UNION ALL SELECT NULL, b, SUM(pos), SUM(neg) FROM h GROUP BY b),
        e AS (SELECT fold, b FROM (SELECT DISTINCT fold FROM a), (SELECT unnest(range(0, 101))::INT AS b)),
        f AS (SELECT e.fold, e.b, COALESCE(pos, 0) AS pos, COALESCE(neg, 0) AS neg
              FROM e LEFT JOIN a ON e.b = a.b AND e.fold IS NOT DISTINCT FROM a.fold)
        SELECT fold, b / 100::DOUBLE AS threshold, CAST(SUM(pos) OVER w - pos AS BIGINT) AS missed,
               CAST(SUM(neg) OVER (PARTITION BY fold) - SUM(neg) OVER w + neg AS BIGINT) AS false_alarms,
               CAST(10 * (SUM(pos) OVER w - pos) + SUM(neg) OVER (PARTITION BY fold) - SUM(neg) OVER w + neg AS DOUBLE) AS cost
        FROM f WINDOW w AS (PARTITION BY fold ORDER BY b)""",
)
def ml_fold_costs(t):
    """Cost of every threshold over out-of-fold class rates by language and source, for each fold and for all."""
    rows = t.labels.join(t.documents, "doc_id").select(
        "lang", "source", "toxic", F.floor(unit_hash("doc_id", "fold") * 5).cast("int").alias("fold")
    )
    return E.fold_costs(E.out_of_fold_rates(rows, "fold", ["lang", "source"], "toxic"), "fold", "score", "toxic")


@query("ml_classify_weighted")
def ml_classify_weighted(t):
    return ML.cross_validated_auc(_labelled_docs(t), "doc_id", "quality", ["chars", "blanks", "stops", "digits"], folds=5)


SCORED = """sc AS (SELECT toxic AS y, LEAST(1.0::DOUBLE, n_chars / 1000.0::DOUBLE) AS s FROM labels JOIN documents USING (doc_id)),
       b AS (SELECT LEAST(100, FLOOR(s * 100))::INT AS k, SUM(y) AS pos, SUM(1 - y) AS neg FROM sc GROUP BY 1),
       f AS (SELECT r.k, COALESCE(pos, 0) AS pos, COALESCE(neg, 0) AS neg FROM (SELECT unnest(range(0, 101))::INT AS k) r LEFT JOIN b USING (k)),
       c AS (SELECT k / 100::DOUBLE AS threshold, CAST(SUM(pos) OVER (ORDER BY k) - pos AS BIGINT) AS missed,
                    CAST(SUM(neg) OVER () - SUM(neg) OVER (ORDER BY k) + neg AS BIGINT) AS false_alarms FROM f)"""


@query(
    "ml_business_cost",
    f"WITH {SCORED} SELECT *, (10 * missed + false_alarms)::BIGINT AS cost FROM c",
)
def ml_business_cost(t):
    scored = t.labels.join(t.documents, "doc_id").select(
        "toxic", F.least(F.lit(1.0), F.col("n_chars") / F.lit(1000.0)).alias("score")
    )
    costs = E.business_cost(scored, "score", "toxic")
    return costs.withColumn("cost", F.col("cost").cast("long"))


@query(
    "ml_drift",
    """WITH l AS (SELECT 'value' AS "column", value AS v, ts < TIMESTAMP '2024-01-16' AS a FROM events
                  UNION ALL SELECT 'hour', hour(ts)::DOUBLE, ts < TIMESTAMP '2024-01-16' FROM events),
       m AS (SELECT "column", MIN(v) AS lo, MAX(v) AS hi FROM l WHERE a GROUP BY 1),
       b AS (SELECT "column", LEAST(10, GREATEST(1, COALESCE(CEIL((v - lo) * 10 / NULLIF(hi - lo, 0)), 1))) AS bin,
                    COUNT(*) FILTER (WHERE a) AS na, COUNT(*) FILTER (WHERE NOT a) AS nb FROM l JOIN m USING ("column") GROUP BY 1, 2),
       p AS (SELECT "column", bin, GREATEST(na, 0.5) / SUM(na) OVER w AS pa, GREATEST(nb, 0.5) / SUM(nb) OVER w AS pb,
                    ABS(SUM(na) OVER o / SUM(na) OVER w - SUM(nb) OVER o / SUM(nb) OVER w) AS ks FROM b
             WINDOW w AS (PARTITION BY "column"), o AS (PARTITION BY "column" ORDER BY bin))
       SELECT "column", ROUND(SUM((pb - pa) * LN(pb / pa)), 9) AS psi, ROUND(MAX(ks), 9) AS ks FROM p GROUP BY 1""",
)
def ml_drift(t):
    rows = t.events.select("ts", "value", F.hour("ts").cast("double").alias("hour"))
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    out = E.drift(rows.filter(F.col("ts") < cut), rows.filter(F.col("ts") >= cut), ["value", "hour"])
    return out.select("column", F.round("psi", 9).alias("psi"), F.round("ks", 9).alias("ks"))


