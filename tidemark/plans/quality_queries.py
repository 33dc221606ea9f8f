"""Registered data-quality and change-set queries (with their oracles)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.changes import apply_change_set, merge_updates
from tidemark.operators.quality import (domain_counts, foreign_key_summary, null_counts,
                                        unique_summary)
from tidemark.plans.queries import load

ORDER_STATUS = ["F", "O", "P"]


def q_dq_not_null(spark, sf_dir):
    """Every column of orders, after blanking some statuses by key."""
    o = load(spark, sf_dir, "orders")
    o = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")))
    o = o.withColumn("o_totalprice", F.when(F.col("o_custkey") % 5 != 0, F.col("o_totalprice")))
    return null_counts(o, "orders")


def q_dq_domain(spark, sf_dir):
    """Statuses outside the list: every fourth is made foreign, every ninth null."""
    o = load(spark, sf_dir, "orders").withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 4 == 0, F.lit("X"))
        .when(F.col("o_orderkey") % 9 != 0, F.col("o_orderstatus")))
    return domain_counts(o, "orders", {"o_orderstatus": ORDER_STATUS})


def q_dq_unique(spark, sf_dir):
    parts = [unique_summary(load(spark, sf_dir, "orders"), "orders", "o_orderkey"),
             unique_summary(load(spark, sf_dir, "customer"), "customer", "c_custkey"),
             unique_summary(load(spark, sf_dir, "customer"), "customer", "c_name"),
             # not keys: customers and parts repeat in orders and lineitem
             unique_summary(load(spark, sf_dir, "orders"), "orders", "o_custkey"),
             unique_summary(load(spark, sf_dir, "lineitem"), "lineitem", "l_partkey")]
    return reduce(DataFrame.unionByName, parts)


FK_RULES = [("orders", "o_custkey", "customer", "c_custkey"),
            ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("lineitem", "l_partkey", "part", "p_partkey"),
            ("lineitem", "l_suppkey", "supplier", "s_suppkey")]


def q_dq_foreign_key(spark, sf_dir):
    """Orphans once every eleventh parent key is taken away."""
    parts = [foreign_key_summary(load(spark, sf_dir, c),
                                 load(spark, sf_dir, p).where(F.col(pk) % 11 != 0), c, ck, p, pk)
             for c, ck, p, pk in FK_RULES]
    return reduce(DataFrame.unionByName, parts)


def q_apply_change_set(spark, sf_dir):
    """Customer table after a change set derived from the data:
    negative balances corrected to 0 (keyed updates) and every supplier
    added as a new customer (inserts, ids after the current max in
    supplier-key order)."""
    cust = load(spark, sf_dir, "customer")
    sup = load(spark, sf_dir, "supplier")
    updates = cust.where(F.col("c_acctbal") < 0).withColumn("c_acctbal", F.lit(0.0))
    inserts = sup.select(F.col("s_name").alias("c_name"), F.col("s_nationkey").alias(
        "c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
        F.lit("SUPPLIER").alias("c_mktsegment"), "s_suppkey")
    return apply_change_set(cust, updates, inserts, "c_custkey", ["s_suppkey"])


def q_insert_orders(spark, sf_dir):
    """Every order as a new customer: dense ids for a large insert."""
    cust, orders = load(spark, sf_dir, "customer"), load(spark, sf_dir, "orders")
    inserts = orders.select(F.lit("NEW").alias("c_mktsegment"), F.col("o_totalprice").alias(
        "c_acctbal"), "o_orderkey")
    out = apply_change_set(cust, cust.limit(0), inserts, "c_custkey", ["o_orderkey"])
    return out.where("change = 'insert'").select("c_custkey", "c_acctbal")


def q_partial_update(spark, sf_dir):
    """Updates that name some columns only, as ``UPDATE ... SET c = ... WHERE key``.

    Every seventh customer gets a new balance; of these, the even ones also lose their
    segment (set to NULL).  Name and nation are never given and stay.
    """
    cust = load(spark, sf_dir, "customer")
    updates = cust.where("c_custkey % 7 = 0").select(
        "c_custkey", (F.col("c_acctbal") + 100).alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"),
        F.when(F.col("c_custkey") % 2 == 1, F.array(F.lit("c_acctbal"))).alias("given"))
    done = merge_updates(cust, updates, "c_custkey", "given")
    return done.withColumn("c_acctbal", F.round("c_acctbal", 2)).withColumnRenamed(
        "_updated", "updated")


QUALITY_QUERIES = {
    "partial_update": q_partial_update,
    "insert_orders": q_insert_orders,
    "dq_not_null": q_dq_not_null,
    "dq_domain": q_dq_domain,
    "dq_unique": q_dq_unique,
    "dq_foreign_key": q_dq_foreign_key,
    "apply_change_set": q_apply_change_set,
}

_ORDERS_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                "o_orderpriority"]


def _uniq(table: str, col: str) -> str:
    return (f"SELECT '{table}' AS \"table\", '{col}' AS \"column\", count(*)::BIGINT AS "
            f"duplicate_keys, coalesce(sum(n), 0)::BIGINT AS duplicate_rows FROM "
            f"(SELECT {col}, count(*) AS n FROM {table} GROUP BY 1 HAVING count(*) > 1)")


def _fk(c, ck, p, pk) -> str:
    return (f"SELECT '{c}' AS child, '{ck}' AS child_key, '{p}' AS parent, count(*)::BIGINT "
            f"AS orphans FROM {c} WHERE {ck} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {p} WHERE {p}.{pk} = {c}.{ck} AND {p}.{pk} % 11 <> 0)")


_BLANKED = {"o_orderstatus": "CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END",
            "o_totalprice": "CASE WHEN o_custkey % 5 <> 0 THEN o_totalprice END"}

QUALITY_ORACLE = {
    "partial_update": """
SELECT c_custkey, c_name, c_nationkey,
       round(CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 100 ELSE c_acctbal END, 2) AS c_acctbal,
       CASE WHEN c_custkey % 14 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       c_custkey % 7 = 0 AS updated
FROM customer""",
    "insert_orders": """
SELECT ((SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY o_orderkey))::BIGINT
       AS c_custkey, o_totalprice AS c_acctbal FROM orders""",
    "dq_not_null": "\nUNION ALL\n".join(
        f"SELECT 'orders' AS \"table\", '{c}' AS \"column\", "
        f"(count(*) - count({_BLANKED.get(c, c)}))::BIGINT AS violations FROM orders"
        for c in _ORDERS_COLS),
    "dq_domain": """
SELECT 'orders' AS "table", 'o_orderstatus' AS "column",
       count(*) FILTER (WHERE o_orderkey % 4 = 0 OR o_orderkey % 9 = 0 OR o_orderstatus IS NULL
                        OR o_orderstatus NOT IN ('F', 'O', 'P'))::BIGINT
       AS violations FROM orders""",
    "dq_unique": "\nUNION ALL\n".join([_uniq("orders", "o_orderkey"),
                                       _uniq("customer", "c_custkey"),
                                       _uniq("customer", "c_name"),
                                       _uniq("orders", "o_custkey"),
                                       _uniq("lineitem", "l_partkey")]),
    "dq_foreign_key": "\nUNION ALL\n".join(_fk(*r) for r in FK_RULES),
    "apply_change_set": """
WITH m AS (SELECT coalesce(max(c_custkey), 0) AS m FROM customer)
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment,
       CASE WHEN c_acctbal < 0 THEN 'update' ELSE 'keep' END AS change
FROM customer
UNION ALL
SELECT (m.m + row_number() OVER (ORDER BY s_suppkey))::BIGINT, s_name, s_nationkey, s_acctbal,
       'SUPPLIER', 'insert'
FROM supplier, m""",
}
