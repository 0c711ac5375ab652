"""Scalar-function queries."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tallyweave.functions import dates as D
from tallyweave.functions import numeric as N
from tallyweave.functions import text as X
from tallyweave.operators import features as FE
from tallyweave.operators.association import effect_label
from tallyweave.suite.registry import query


@query(
    "fn_case_trim",
    """SELECT c_custkey, LOWER(c_mktsegment) AS lo, UPPER(c_name) AS up,
              TRIM('  ' || c_mktsegment || ' ') AS trimmed FROM customer""",
)
def fn_case_trim(t):
    padded = F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))
    return t.customer.select(
        "c_custkey", F.lower("c_mktsegment").alias("lo"), F.upper("c_name").alias("up"), F.trim(padded).alias("trimmed")
    )


@query(
    "fn_substring",
    """SELECT p_partkey, contains(p_name, 'ring') AS has, starts_with(p_name, 'red') AS starts,
              ends_with(p_name, 'bolt') AS ends, SUBSTRING(p_brand, 7) AS number,
              (instr(p_name, 'blue') = 1) AS at_start FROM part""",
)
def fn_substring(t):
    return t.part.select(
        "p_partkey",
        F.col("p_name").contains("ring").alias("has"),
        F.col("p_name").startswith("red").alias("starts"),
        F.col("p_name").endswith("bolt").alias("ends"),
        F.expr("substring(p_brand, 7)").alias("number"),
        (F.instr("p_name", "blue") == 1).alias("at_start"),
    )


@query(
    "fn_split_replace",
    """SELECT page_id, len(regexp_split_to_array(url, '[\\/\\.\\?]')) AS pieces, REPLACE(url, 'https://', '') AS bare,
              regexp_replace(url, '[0-9]+', '#', 'g') AS masked FROM pages""",
)
def fn_split_replace(t):
    return t.pages.select(
        "page_id",
        F.size(X.split_any("url", "/.?")).cast("long").alias("pieces"),
        F.replace("url", F.lit("https://"), F.lit("")).alias("bare"),
        F.regexp_replace("url", "[0-9]+", "#").alias("masked"),
    )


@query(
    "fn_concat",
    """SELECT conv_id, turn, role || ':' || turn AS pair, concat_ws(' ', role, text) AS joined,
              '[CLS] ' || REPLACE(text, '. ', '. [SEP] ') || ' [SEP]' AS marked FROM conversations""",
)
def fn_concat(t):
    return t.conversations.select(
        "conv_id",
        "turn",
        F.concat("role", F.lit(":"), F.col("turn").cast("string")).alias("pair"),
        F.concat_ws(" ", "role", "text").alias("joined"),
        X.mark_sentence("text").alias("marked"),
    )


@query(
    "fn_edit_ratio",
    """SELECT p_partkey, ROUND(1.0::DOUBLE - levenshtein(p_name, LOWER(p_type)) /
              GREATEST(LENGTH(p_name), LENGTH(p_type)), 6) AS similarity FROM part""",
)
def fn_edit_ratio(t):
    return t.part.select("p_partkey", F.round(X.edit_similarity("p_name", F.lower("p_type")), 6).alias("similarity"))


@query(
    "fn_url",
    """SELECT p_partkey, 'https://media.s3.eu-west-1.amazonaws.com/' || REPLACE(LOWER(p_type), ' ', '%20') || '/'
              || REPLACE(REPLACE(p_name, ' ', '%20'), '#', '%23') || '%20' || REPLACE(p_brand, '#', '%23') || '.jpg' AS url
       FROM part""",
)
def fn_url(t):
    uri = F.concat(
        F.lit("s3://media/"), F.lower("p_type"), F.lit("/"), "p_name", F.lit(" "), "p_brand", F.lit(".jpg")
    )
    return t.part.select("p_partkey", X.s3_to_https(uri, "eu-west-1").alias("url"))


@query(
    "fn_path_label",
    """SELECT page_id, list_extract(string_split(url, '/'), -2) AS label FROM pages""",
)
def fn_path_label(t):
    return t.pages.select("page_id", X.parent_folder("url").alias("label"))


@query("fn_category_level0", "SELECT p_partkey, p_type AS level0 FROM part")
def fn_category_level0(t):
    path = F.concat(F.lit('["'), "p_type", F.lit(" >> "), "p_brand", F.lit(" >> "), "p_name", F.lit('"]'))
    return t.part.select("p_partkey", X.first_level(path).alias("level0"))


STOP = ("that", "this", "with")  # sample stop list


@query(
    "fn_tokenise",
    """WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(LOWER(text), '[^\\p{L}]+')) AS tok FROM documents),
       s AS (SELECT doc_id, COUNT(*) AS n FROM w WHERE LENGTH(tok) >= 4 AND tok NOT IN ('that', 'this', 'with')
             GROUP BY doc_id)
       SELECT d.doc_id, COALESCE(n, 0) AS n FROM documents d LEFT JOIN s USING (doc_id)""",
)
def fn_tokenise(t):
    words = F.filter(X.tokens("text"), lambda w: ~w.isin(*STOP))
    return t.documents.select("doc_id", F.size(words).cast("long").alias("n"))


@query(
    "fn_date_diff",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              (epoch_us(l_shipdate) - epoch_us(TIMESTAMP '1998-01-01 06:00:00')) / 86400000000.0::DOUBLE AS days,
              CAST(FLOOR((epoch_us(TIMESTAMP '2002-01-01 18:00:00') - epoch_us(l_shipdate)) / 86400000000.0::DOUBLE)
                   AS BIGINT) AS age FROM lineitem""",
)
def fn_date_diff(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        D.days_between("l_shipdate", F.lit("1998-01-01 06:00:00").cast("timestamp_ntz")).alias("days"),
        D.age_in_days("l_shipdate", F.lit("2002-01-01 18:00:00").cast("timestamp_ntz")).alias("age"),
    )


@query(
    "fn_weekday",
    """WITH w AS (SELECT user_id, (isodow(ts) - 1)::INT AS d, COUNT(*) AS n FROM events GROUP BY ALL)
       SELECT user_id, d AS weekday, n FROM w
       QUALIFY ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY n DESC, d) = 1""",
)
def fn_weekday(t):
    counts = t.events.groupBy("user_id", D.weekday("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("user_id").agg(
        F.min_by("d", F.struct(-F.col("n"), F.col("d"))).alias("weekday"), F.max("n").alias("n")
    )


@query(
    "fn_math",
    """SELECT c_custkey, ROUND(LN(1 + ABS(c_acctbal)), 9) AS l1, ROUND(EXP(c_acctbal / 10000) - 1, 9) AS e1,
              ROUND(SQRT(ABS(c_acctbal)), 9) AS sq, CAST(FLOOR(c_acctbal) AS BIGINT) AS fl,
              round_even(c_acctbal / 4, 0) AS ri, ABS(c_acctbal) AS ab FROM customer""",
)
def fn_math(t):
    x = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey",
        F.round(F.log1p(F.abs(x)), 9).alias("l1"),
        F.round(F.expm1(x / 10000), 9).alias("e1"),
        F.round(F.sqrt(F.abs(x)), 9).alias("sq"),
        F.floor(x).alias("fl"),
        F.rint(x / 4).alias("ri"),
        F.abs(x).alias("ab"),
    )


@query(
    "fn_bucket_round",
    """SELECT o_orderkey, CAST(CAST(round_even(YEAR(o_orderdate) / 5.0::DOUBLE, 0) * 5 AS BIGINT) AS VARCHAR) AS half_decade,
              CAST(CAST(round_even(o_totalprice / 5000.0::DOUBLE, 0) * 5000 AS BIGINT) AS VARCHAR) AS price FROM orders""",
)
def fn_bucket_round(t):
    return t.orders.select(
        "o_orderkey",
        N.round_to_bucket(F.year("o_orderdate"), 5).alias("half_decade"),
        N.round_to_bucket("o_totalprice", 5000).alias("price"),
    )


@query(
    "fn_bin_equal",
    """WITH b AS (SELECT MIN(l_quantity) AS lo, MAX(l_quantity) AS hi FROM lineitem)
       SELECT CAST(LEAST(20, GREATEST(1, CEIL((l_quantity - lo) * 20 / (hi - lo)))) AS INT) AS bin, COUNT(*) AS n
       FROM lineitem, b GROUP BY ALL""",
)
def fn_bin_equal(t):
    low, high = t.lineitem.agg(F.min("l_quantity")).scalar(), t.lineitem.agg(F.max("l_quantity")).scalar()
    return (
        t.lineitem.groupBy(N.equal_width_bin("l_quantity", low, high).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "fn_null",
    """SELECT c_custkey, (c_acctbal < 0) AS missing, NOT (c_acctbal < 0) AS known,
              CASE WHEN c_acctbal < 0 THEN -1 ELSE c_acctbal END AS filled FROM customer""",
)
def fn_null(t):
    x = N.within("c_acctbal", 0)
    return t.customer.select(
        "c_custkey", x.isNull().alias("missing"), x.isNotNull().alias("known"), F.coalesce(x, F.lit(-1.0)).alias("filled")
    )


@query(
    "fn_effect_label",
    """SELECT l_discount, COUNT(*) AS n, CASE WHEN l_discount < 0.01::DOUBLE THEN 'negligible'
              WHEN l_discount < 0.06::DOUBLE THEN 'small' WHEN l_discount < 0.14::DOUBLE THEN 'medium' ELSE 'large' END AS label
       FROM lineitem GROUP BY l_discount""",
)
def fn_effect_label(t):
    return t.lineitem.groupBy("l_discount").agg(F.count(F.lit(1)).alias("n")).withColumn("label", effect_label("l_discount"))


KV_SQL = """
    raw AS (SELECT o_custkey, p_type AS k, l_extendedprice AS v FROM lineitem
            JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
    wide AS (SELECT o_custkey,
      CAST(COALESCE(SUM(CAST(v AS DECIMAL(18,4))) FILTER (WHERE k IN ('ECONOMY','PROMO')), 0) AS DOUBLE) AS cat_cheap,
      CAST(COALESCE(SUM(CAST(v AS DECIMAL(18,4))) FILTER (WHERE k IN ('SMALL','MEDIUM','LARGE')), 0) AS DOUBLE) AS cat_size,
      CAST(COALESCE(SUM(CAST(v AS DECIMAL(18,4)))
           FILTER (WHERE k NOT IN ('ECONOMY','PROMO','SMALL','MEDIUM','LARGE')), 0) AS DOUBLE) AS "cat_NA"
      FROM raw GROUP BY o_custkey)"""
GROUPS = {"ECONOMY": "cheap", "PROMO": "cheap", "SMALL": "size", "MEDIUM": "size", "LARGE": "size"}


def category_strings(t):
    """One ``type:price,type:price`` string per order, as an upstream system would deliver them."""
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey", "p_type").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,4)")).alias("v")
    )
    text = lines.groupBy("l_orderkey").agg(
        F.concat_ws(",", F.sort_array(F.collect_list(F.concat("p_type", F.lit(":"), F.col("v").cast("string"))))).alias("cats")
    )
    return text.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "cats")


@query("fn_kv_wide", f"WITH {KV_SQL} SELECT * FROM wide")
def fn_kv_wide(t):
    return FE.kv_wide(category_strings(t), "o_custkey", "cats", GROUPS, "NA", "cat_", ["cheap", "size", "NA"])


@query(
    "fn_argmax_col",
    f"""WITH {KV_SQL} SELECT o_custkey,
        CASE WHEN GREATEST("cat_NA", cat_cheap, cat_size) <= 0 THEN NULL
             WHEN "cat_NA" >= cat_cheap AND "cat_NA" >= cat_size THEN 'cat_NA'
             WHEN cat_cheap >= cat_size THEN 'cat_cheap' ELSE 'cat_size' END AS top FROM wide""",
)
def fn_argmax_col(t):
    wide = FE.kv_wide(category_strings(t), "o_custkey", "cats", GROUPS, "NA", "cat_", ["cheap", "size", "NA"])
    return wide.select("o_custkey", FE.argmax_column([c for c in wide.columns if c.startswith("cat_")]).alias("top"))


@query(
    "fn_array_vector",
    """SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS e_1, CAST(embedding[32] AS DOUBLE) AS e_32,
              CAST(embedding[64] AS DOUBLE) AS e_64 FROM embeddings""",
)
def fn_array_vector(t):
    back = vector_to_array(array_to_vector(F.col("embedding").cast("array<double>")))
    wide = FE.vector_columns(t.embeddings.withColumn("v", back), "v", 64, "e_")
    return wide.select("vec_id", "e_1", "e_32", "e_64")
