"""Source and sink queries: each writes a given table in a format and reads it back, or reads the files themselves."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from tallyweave.operators.features import GroupImpute
from tallyweave.session import scratch_path
from tallyweave.sources import readers as R
from tallyweave.sources import writers as W
from tallyweave.suite.aggregation import dec
from tallyweave.suite.ordering import _hash
from tallyweave.suite.registry import query


@query("src_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv(t):
    path = scratch_path(t.spark, "customer-csv")
    W.write_csv(t.customer, path)
    return R.read_csv(t.spark, path, t.customer.schema)


@query("src_tsv_typed", "SELECT doc_id, text, lang FROM documents")
def src_tsv_typed(t):
    """Typed TSV; texts hold tabs, quotes and line breaks, so they travel escaped on one line."""
    path = scratch_path(t.spark, "documents-tsv")
    W.write_csv(t.documents.select("doc_id", F.to_json(F.struct("text")).alias("text"), "lang"), path, sep="\t")
    back = R.read_csv(t.spark, path, "doc_id long, text string, lang string", sep="\t")
    return back.withColumn("text", F.from_json("text", "text string")["text"])


@query("src_csv_encoding", "SELECT s_suppkey, 'é' || s_name || 'ü' AS s_name FROM supplier")
def src_csv_encoding(t):
    path = scratch_path(t.spark, "supplier-latin1")
    named = t.supplier.select("s_suppkey", F.concat(F.lit("é"), "s_name", F.lit("ü")).alias("s_name"))
    W.write_csv(named, path, encoding="ISO-8859-1")
    return R.read_csv(t.spark, path, named.schema, encoding="ISO-8859-1")


@query("src_parquet", f"SELECT l_returnflag, COUNT(*) AS n, {dec('l_quantity')} AS qty FROM lineitem GROUP BY 1")
def src_parquet(t):
    from tallyweave.functions.numeric import exact_sum

    return t.lineitem.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), exact_sum("l_quantity").alias("qty"))


@query("src_parquet_parts", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def src_parquet_parts(t):
    paths = []
    for status in ("F", "O", "P"):
        path = scratch_path(t.spark, f"orders-{status}")
        W.write_parquet(t.orders.filter(F.col("o_orderstatus") == status), path)
        paths.append(path)
    return R.read_parts(t.spark, paths).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "src_csv_catalog",
    "SELECT n_name, r_name, COUNT(*) AS suppliers FROM nation JOIN region ON n_regionkey = r_regionkey "
    "JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL",
)
def src_csv_catalog(t):
    """A folder of files with repeated rows; the catalog lists it and its views are de-duplicated."""
    root, schemas = scratch_path(t.spark, "catalog"), {}
    for name in ("nation", "region", "supplier"):
        df = getattr(t, name)
        W.write_csv(df.unionByName(df), f"{root}/shop_{name}_dataset.csv")
        schemas[name] = df.schema
    R.register_csv_catalog(t.spark, root, prefix="shop_", schemas=schemas)
    return R.read_sql(
        t.spark,
        """SELECT n_name, r_name, COUNT(*) AS suppliers FROM nation JOIN region ON n_regionkey = r_regionkey
           JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name, r_name""",
    )


@query(
    "src_sql",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate <= '1999-06-30' AND o_orderdate >= '1997-02-01'""",
)
def src_sql(t):
    t.orders.createOrReplaceTempView("bound_orders")
    return R.read_sql(
        t.spark,
        "SELECT o_orderkey, o_totalprice FROM bound_orders WHERE o_orderdate <= CAST(:to_date AS TIMESTAMP_NTZ) "
        "AND o_orderdate >= CAST(:from_date AS TIMESTAMP_NTZ)",
        to_date="1999-06-30 00:00:00",
        from_date="1997-02-01 00:00:00",
    )


@query("src_cached_dataset", "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey")
def src_cached_dataset(t):
    path = scratch_path(t.spark, "cached")
    build = lambda: t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    R.cached_dataset(t.spark, path, build)
    return R.cached_dataset(t.spark, path, build)


@query(
    "src_binary",
    """SELECT c_mktsegment AS label, c_custkey::VARCHAR || '|' || c_name AS line, sha256(c_name) AS name_sha256
       FROM customer""",
)
def src_binary(t):
    """Files in one folder per label, read as binary rows; the lines come from the content, the label from the path."""
    path = scratch_path(t.spark, "binary")
    line = F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name").alias("line")
    rows = t.customer.select("c_mktsegment", line)
    # A file is one binary row, so its size is bounded.
    rows.write.partitionBy("c_mktsegment").option("maxRecordsPerFile", 100_000).text(path)
    files = R.read_binary(t.spark, path, "*.txt")
    lines = files.where("length = octet_length(content)").select(
        F.element_at(F.split(F.element_at(F.split("path", "/"), -2), "="), -1).alias("label"),
        F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line"),
    )
    name = F.element_at(F.split("line", r"\|"), 2)
    return lines.where("line <> ''").select("label", "line", F.sha2(name, 256).alias("name_sha256"))


def _answers(t):
    """One nested answer document per part: the part itself as parsed, its brand variant as hint."""
    small = F.col("p_size") > 10
    food = lambda suffix, contents: F.struct(
        F.struct(
            F.concat(F.col("p_partkey").cast("string"), F.lit(suffix)).alias("foodId"),
            F.col("p_name").alias("label"),
            F.col("p_type").alias("category"),
            contents.alias("foodContentsLabel"),
            F.concat(F.lit("http://img/"), F.col("p_partkey").cast("string")).alias("image"),
        ).alias("food")
    )
    doc = F.struct(
        F.array(food("", F.when(small, F.col("p_brand")))).alias("parsed"),
        F.when(F.col("p_size") != 7, F.array(food("h", F.col("p_brand")))).alias("hints"),
    )
    return t.part.select("p_partkey", F.to_json(doc).alias("json"))


@query(
    "src_json_nested",
    """SELECT p_partkey::VARCHAR AS "foodId", p_name AS label, p_type AS category, p_brand AS "foodContentsLabel",
              'http://img/' || p_partkey AS image FROM part WHERE p_size > 10
       UNION ALL SELECT p_partkey::VARCHAR || 'h', p_name, p_type, p_brand, 'http://img/' || p_partkey FROM part WHERE p_size <> 7""",
)
def src_json_nested(t):
    path = scratch_path(t.spark, "answers")
    _answers(t).select("json").write.mode("overwrite").text(path)
    return R.food_items(t.spark.read.text(path).withColumnRenamed("value", "json"))


@query(
    "src_json_props",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
)
def src_json_props(t):
    return t.events.select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("snk_parquet", "SELECT p_type, p_partkey, p_retailprice FROM part")
def snk_parquet(t):
    path = scratch_path(t.spark, "part-by-type")
    W.write_parquet(t.part.select("p_type", "p_partkey", "p_retailprice"), path, partition_by=("p_type",))
    return t.spark.read.parquet(path)


@query("snk_csv_single", "SELECT c_nationkey, COUNT(*) AS n FROM customer GROUP BY 1")
def snk_csv_single(t):
    path = scratch_path(t.spark, "summary-csv")
    W.write_csv_single(t.customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n")), path)
    return R.read_csv(t.spark, path, "c_nationkey int, n long")


@query("snk_json_dict", "SELECT DISTINCT p_name AS key, 'a ' || p_name AS value FROM part")
def snk_json_dict(t):
    path = scratch_path(t.spark, "names-json")
    names = t.part.select("p_name", F.concat(F.lit("a "), "p_name").alias("text")).distinct()
    W.write_json_dict(names, path, "p_name", "text")
    return t.spark.read.schema("key string, value string").json(path)


@query(
    "mdl_persist",
    """WITH n AS (SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1),
       i AS (SELECT c_mktsegment, ROW_NUMBER() OVER (ORDER BY n DESC, c_mktsegment) - 1 AS idx FROM n)
       SELECT c_custkey, CAST(idx AS DOUBLE) AS idx FROM customer JOIN i USING (c_mktsegment)""",
)
def mdl_persist(t):
    path = scratch_path(t.spark, "model")
    W.save_model(Pipeline(stages=[StringIndexer(inputCol="c_mktsegment", outputCol="idx")]).fit(t.customer), path)
    assert isinstance(W.load_pipeline(path), PipelineModel)
    return W.load_pipeline(path).transform(t.customer).select("c_custkey", "idx")


@query(
    "mdl_persist_imputer",
    """WITH h AS (SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_acctbal >= 5000 THEN c_acctbal END AS bal,
                     CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS seg FROM customer),
       b0 AS (SELECT c_nationkey, c_mktsegment, quantile_cont(bal, 0.5) AS v0 FROM h WHERE bal IS NOT NULL GROUP BY 1, 2),
       b1 AS (SELECT c_nationkey, quantile_cont(bal, 0.5) AS v1 FROM h WHERE bal IS NOT NULL GROUP BY 1),
       n0 AS (SELECT c_nationkey, c_mktsegment, seg, COUNT(*) AS n FROM h WHERE seg IS NOT NULL GROUP BY 1, 2, 3),
       s0 AS (SELECT c_nationkey, c_mktsegment, seg AS f0 FROM n0
              QUALIFY ROW_NUMBER() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY n DESC, seg) = 1),
       n1 AS (SELECT c_nationkey, seg, SUM(n) AS n FROM n0 GROUP BY 1, 2),
       s1 AS (SELECT c_nationkey, seg AS f1 FROM n1 QUALIFY ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY n DESC, seg) = 1)
       SELECT c_custkey, ROUND(COALESCE(bal, v0, v1), 6) AS bal, COALESCE(seg, f0, f1) AS seg FROM h
       LEFT JOIN b0 USING (c_nationkey, c_mktsegment) LEFT JOIN b1 USING (c_nationkey)
       LEFT JOIN s0 USING (c_nationkey, c_mktsegment) LEFT JOIN s1 USING (c_nationkey)""",
)
def mdl_persist_imputer(t):
    """A fitted group imputer, saved and loaded as a stage of a pipeline model with its fill tables."""
    holed = t.customer.select(
        "c_custkey",
        "c_nationkey",
        "c_mktsegment",
        F.when(F.col("c_acctbal") >= 5000, F.col("c_acctbal")).alias("bal"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("seg"),
    )
    path = scratch_path(t.spark, "imputer")
    levels = [["c_nationkey", "c_mktsegment"], ["c_nationkey"]]
    W.save_model(Pipeline(stages=[GroupImpute(["bal", "seg"], levels)]).fit(holed), path)
    out = W.load_pipeline(path).transform(holed)
    return out.select("c_custkey", F.round("bal", 6).alias("bal"), "seg")


@query(
    "snk_split_files",
    f"""WITH s AS (SELECT doc_id, quality, {_hash('doc_id', 'strat')} AS a, {_hash('doc_id', 'split')} AS b FROM labels),
        f AS (SELECT unnest(['0.1', '0.25', '1']) AS fraction, unnest([0.1, 0.25, 2]::DOUBLE[]) AS lim)
        SELECT fraction, CASE WHEN b < 0.33 THEN 'test' ELSE 'train' END AS side, COUNT(*) AS rows,
               CAST(SUM(quality) AS BIGINT) AS positive FROM s JOIN f ON a < lim GROUP BY ALL""",
)
def snk_split_files(t):
    path, out = scratch_path(t.spark, "splits"), None
    fractions = (0.1, 0.25, 1)
    W.write_splits(t.labels, path, "quality", "doc_id", fractions, 0.33)
    for fraction in fractions:
        for side in ("train", "test"):
            x = t.spark.read.parquet(f"{path}/{fraction}/X_{side}")
            y = t.spark.read.parquet(f"{path}/{fraction}/y_{side}")
            part = x.join(y, "doc_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("quality").alias("positive"))
            part = part.select(F.lit(str(fraction)).alias("fraction"), F.lit(side).alias("side"), "rows", "positive")
            out = part if out is None else out.unionByName(part)
    return out


