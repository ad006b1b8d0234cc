"""Code checks, owners, supervisors, address compare."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollkeeper.functions import text
from rollkeeper.functions.compare import any_differs
from rollkeeper.operators import lookup as ops
from rollkeeper.queries.inputs import CODES_SQL, codes, sql, table


def exists_lookup(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return ops.exists_in(customer, "c_nationkey", codes(spark, d), "code")


def missing_lookup(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return ops.missing_in(customer, "c_nationkey", codes(spark, d), "code")


def lookup_default(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    named = ops.lookup(customer, "c_nationkey", codes(spark, d), "code", "descr", "descr", "")
    return ops.lookup(named, "c_nationkey", codes(spark, d), "code", "code", "code", 0)


def code_warnings(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    active = codes(spark, d).filter(F.col("inactive_date").isNull())
    checks = [("unknown_code", "c_nationkey", codes(spark, d), "code"), ("inactive_code", "c_nationkey", active, "code")]
    return ops.warnings_for(customer, checks, ["c_custkey"])


def needs_update(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    return ops.needs_update(nation, "n_nationkey", "n_name", codes(spark, d), "code", "descr")


def held_by_other(spark, d):
    """Every priority has very many owners: none of them is paired out."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return ops.held_by_other(
        orders, "o_orderpriority", "o_custkey", orders, "o_orderpriority", "o_custkey", "other"
    )


def held_by_other_rare(spark, d):
    """Customers asked for an amount on another customer's order of the same day."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.floor(F.col("o_totalprice")).alias("amount"))
    return ops.held_by_other(orders, "amount", "o_custkey", orders, "amount", "o_custkey", "other")


HELD_RARE_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(floor(o_totalprice) AS BIGINT) AS amount FROM orders)
SELECT a.o_orderkey, a.o_custkey, a.amount, coalesce(min(b.o_custkey), 0) AS other
FROM o a LEFT JOIN o b ON a.amount = b.amount AND b.o_custkey <> a.o_custkey
GROUP BY a.o_orderkey, a.o_custkey, a.amount
"""

HELD_SQL = """
WITH m AS (SELECT o_orderpriority AS p, min(o_custkey) AS m1 FROM orders GROUP BY 1),
n AS (SELECT p, m1, (SELECT min(o_custkey) FROM orders WHERE o_orderpriority = p AND o_custkey <> m1) AS m2 FROM m)
SELECT o_orderkey, o_custkey, o_orderpriority,
  coalesce(CASE WHEN m1 <> o_custkey THEN m1 ELSE m2 END, 0) AS other
FROM orders JOIN n ON o_orderpriority = p
"""


def supervisor_check(spark, d):
    supervisor = F.concat(F.lit("SUP"), F.lpad(F.col("c_custkey").cast("string"), 7, "0"), F.lit("Z"))
    supervisor = F.when(F.col("c_mktsegment") == "FURNITURE", "").otherwise(supervisor)
    customer = table(spark, d, "customer").select("c_custkey", text.supervisor_number(supervisor).alias("number"))
    people = table(spark, d, "supplier").select(F.lpad(F.col("s_suppkey").cast("string"), 9, "0").alias("adp_id"))
    return ops.known_supervisor(customer, "number", people, "adp_id", "supervisor_no")


SUPERVISOR_SQL = """
SELECT c_custkey, CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE lpad(CAST(c_custkey AS VARCHAR), 7, '0') END
    AS number,
  CAST(CASE WHEN c_mktsegment <> 'FURNITURE' AND c_custkey >= 1
    AND c_custkey IN (SELECT s_suppkey FROM supplier) THEN c_custkey ELSE 0 END AS INT) AS supervisor_no
FROM customer
"""


def address_changed(spark, d):
    customer = table(spark, d, "customer")
    stored = customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("line1"),
        F.when(F.col("c_mktsegment") == "BUILDING", "").alias("line2"),
        F.col("c_nationkey").cast("string").alias("zip"),
    )
    feed = customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lower("c_name")).otherwise(F.col("c_name")).alias("new1"),
        F.lit("").alias("new2"),
        F.when(F.col("c_nationkey") == 7, "7x").otherwise(F.col("c_nationkey").cast("string")).alias("new_zip"),
    )
    pairs = [(F.col("line1"), F.col("new1")), (F.col("line2"), F.col("new2")), (F.col("zip"), F.col("new_zip"))]
    return stored.join(feed, "id").filter(any_differs(pairs)).select("id", "new1", "new2", "new_zip")


ADDRESS_SQL = """
SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'MACHINERY' THEN lower(c_name) ELSE c_name END AS new1, '' AS new2,
  CASE WHEN c_nationkey = 7 THEN '7x' ELSE CAST(c_nationkey AS VARCHAR) END AS new_zip
FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_nationkey = 7
"""

QUERIES = {
    "exists_lookup": (
        exists_lookup,
        sql(CODES_SQL, "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT code FROM codes)"),
    ),
    "missing_lookup": (
        missing_lookup,
        sql(CODES_SQL, "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey NOT IN (SELECT code FROM codes)"),
    ),
    "lookup_default": (
        lookup_default,
        sql(
            CODES_SQL,
            "SELECT c_custkey, c_nationkey, coalesce(descr, '') AS descr, coalesce(code, 0) AS code "
            "FROM customer LEFT JOIN codes ON code = c_nationkey",
        ),
    ),
    "code_warnings": (
        code_warnings,
        sql(
            CODES_SQL,
            "SELECT c_custkey, 'unknown_code' AS warning, CAST(c_nationkey AS VARCHAR) AS value FROM customer "
            "WHERE c_nationkey NOT IN (SELECT code FROM codes) UNION ALL "
            "SELECT c_custkey, 'inactive_code', CAST(c_nationkey AS VARCHAR) FROM customer "
            "WHERE c_nationkey NOT IN (SELECT code FROM codes WHERE inactive_date IS NULL)",
        ),
    ),
    "needs_update": (
        needs_update,
        sql(
            CODES_SQL,
            "SELECT n_nationkey, n_name, CASE WHEN code IS NULL THEN 'insert' WHEN descr <> n_name THEN 'update' "
            "ELSE 'none' END AS action FROM nation LEFT JOIN codes ON code = n_nationkey",
        ),
    ),
    "held_by_other": (held_by_other, HELD_SQL),
    "held_by_other_rare": (held_by_other_rare, HELD_RARE_SQL),
    "supervisor_check": (supervisor_check, SUPERVISOR_SQL),
    "address_changed": (address_changed, ADDRESS_SQL),
}
