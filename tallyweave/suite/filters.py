"""Filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions import numeric as N
from tallyweave.functions import text as X
from tallyweave.operators import columns as C
from tallyweave.suite.registry import query


def holed_customers(t):
    """Customers with negative balances and one segment made missing (the data has no NULLs)."""
    return t.customer.select(
        "c_custkey",
        "c_nationkey",
        N.within("c_acctbal", 0).alias("balance"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("segment"),
    )


HOLED = """holed AS (SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
                            CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS segment FROM customer)"""


@query("flt_notnull", f"WITH {HOLED} SELECT c_custkey, segment FROM holed WHERE segment IS NOT NULL")
def flt_notnull(t):
    return holed_customers(t).filter(F.col("segment").isNotNull()).select("c_custkey", "segment")


@query(
    "flt_range",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
       WHERE l_quantity >= 10 AND l_quantity < 30 AND l_discount BETWEEN 0.03 AND 0.07""",
)
def flt_range(t):
    return t.lineitem.filter(
        (F.col("l_quantity") >= 10) & (F.col("l_quantity") < 30) & F.col("l_discount").between(0.03, 0.07)
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query(
    "flt_eq",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'",
)
def flt_eq(t):
    return t.orders.filter("o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'").select("o_orderkey", "o_orderpriority")


@query("flt_not_contains", "SELECT p_partkey, p_name FROM part WHERE LOWER(p_name) NOT LIKE '%ring%'")
def flt_not_contains(t):
    return t.part.filter(X.not_contains("p_name", "RING")).select("p_partkey", "p_name")


@query(
    "flt_tag_any",
    """SELECT page_id, url FROM pages
       WHERE LOWER(url) LIKE '%/fr/%' OR LOWER(url) LIKE '%example.org%' OR LOWER(url) LIKE '%ref=x%'""",
)
def flt_tag_any(t):
    return t.pages.filter(X.contains_any("url", ["/fr/", "Example.org", "ref=x"])).select("page_id", "url")


@query("flt_expr", "SELECT * FROM supplier WHERE s_acctbal > 1000 AND s_nationkey IN (1, 3, 5, 7, 11)")
def flt_expr(t):
    return t.supplier.filter("s_acctbal > 1000 AND s_nationkey IN (1, 3, 5, 7, 11)")


@query("flt_complete", f"WITH {HOLED} SELECT * FROM holed WHERE balance IS NOT NULL AND segment IS NOT NULL")
def flt_complete(t):
    return holed_customers(t).dropna("any")


@query(
    "flt_fillrate_cols",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 20 THEN l_quantity END AS mostly FROM lineitem""",
)
def flt_fillrate_cols(t):
    """The column filled below one half goes, the list learned on all rows is applied to the same table."""
    holed = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        N.within("l_quantity", 20.000001).alias("mostly"),
        N.within("l_discount", None, 0.03).alias("rarely"),
    )
    return holed.select(*C.well_filled(holed, 0.5))


