"""Gates, routes and row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollkeeper.functions import codes
from rollkeeper.operators import gate
from rollkeeper.queries.inputs import CODES_SQL, EVENT_DAY, codes as code_table, contacts, contacts_sql, sql, table


def _rows(spark, d):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    cheap = F.col("o_totalprice") < 50000
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.when(priority == "5-LOW", "").when(priority == "4-NOT SPECIFIED", " ").otherwise(priority).alias("title"),
        F.when(cheap, "").otherwise(F.col("o_custkey").cast("string")).alias("person"),
        F.when(status == "P", "").otherwise(F.col("o_orderkey").cast("string")).alias("file_no"),
        F.when(F.col("o_totalprice") > 450000, "13/1/2020").otherwise("1/13/2020").alias("day"),
    )


def _judged(spark, d):
    rules = [
        *gate.bad_date_rules(["day"]),
        gate.empty_rule(gate.SKIP + "no_title", "title"),
        gate.empty_rule("no_person", "person"),
        gate.empty_rule("no_file_no", "file_no"),
        gate.blank_rule("blank_title", "title"),
    ]
    return gate.judged(_rows(spark, d), rules)


JUDGED_SQL = """
rows AS (
  SELECT o_orderkey, o_totalprice,
    CASE o_orderpriority WHEN '5-LOW' THEN '' WHEN '4-NOT SPECIFIED' THEN ' ' ELSE o_orderpriority END AS title,
    CASE WHEN o_totalprice < 50000 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS person,
    CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS file_no
  FROM orders),
judged AS (
  SELECT *, CASE WHEN o_totalprice > 450000 THEN 'bad_value:day' WHEN title = '' THEN 'skip:no_title'
    WHEN person = '' THEN 'no_person' WHEN file_no = '' THEN 'no_file_no' WHEN trim(title) = '' THEN 'blank_title'
    END AS reject_reason
  FROM rows)
"""


def gate_rejects(spark, d):
    return gate.rejected(_judged(spark, d)).select("o_orderkey", "reject_reason")


def gate_accepted(spark, d):
    return gate.accepted(_judged(spark, d)).select("o_orderkey", "title", "person", "file_no")


def gate_skipped(spark, d):
    return gate.skipped(_judged(spark, d)).select("o_orderkey", "person")


def route_split(spark, d):
    segment = F.col("c_mktsegment")
    pay = F.when(segment == "BUILDING", codes.STUDENT_PAY_CODE).when(segment == "MACHINERY", "DPR")
    email = F.when(F.col("c_nationkey") > 12, F.concat("c_name", F.lit("@example.org"))).otherwise("")
    rows = table(spark, d, "customer").select("c_custkey", pay.alias("pay"), email.alias("email"))
    students, staff = gate.route(rows, "pay", codes.STUDENT_PAY_CODE)
    labelled = students.select("c_custkey", F.lit("student").alias("route"), "email").unionByName(
        staff.select("c_custkey", F.lit("staff").alias("route"), "email")
    )
    return gate.filled(labelled, "email")


def open_rows(spark, d):
    rows = contacts(spark, d).filter(gate.is_open() & gate.of_kinds("aa", ["PERM", "PREV", "SCND"]))
    return rows.select("aa_no", "id", "aa", "beg_date")


def active_rows(spark, d):
    return contacts(spark, d).filter(gate.is_active(F.lit(EVENT_DAY))).select("aa_no", "id", "aa", "end_date")


def active_codes(spark, d):
    return code_table(spark, d).filter(gate.is_open("inactive_date")).select("code", "descr")


def first_filled_slot(spark, d):
    segment, key = F.col("c_mktsegment"), F.col("c_custkey").cast("string")
    rows = table(spark, d, "customer").select(
        "c_custkey",
        F.when(segment == "BUILDING", key).otherwise("").alias("slot2"),
        F.when(segment.isin("BUILDING", "MACHINERY"), F.concat(key, F.lit("b"))).alias("slot3"),
        F.when(F.col("c_nationkey") > 12, F.concat(key, F.lit("c"))).otherwise("").alias("slot4"),
        F.col("c_nationkey").alias("from2"),
        (F.col("c_nationkey") + 100).alias("from3"),
        (F.col("c_nationkey") + 200).alias("from4"),
    )
    slots = [("slot2", 3, {"from2": "begins"}), ("slot3", 4, {"from3": "begins"}), ("slot4", 5, {"from4": "begins"})]
    return gate.first_filled_slot(rows, slots, "pcn_aggr", "title_rank")


SLOT_SQL = """
SELECT c_custkey, CASE title_rank WHEN 3 THEN k WHEN 4 THEN k || 'b' ELSE k || 'c' END AS pcn_aggr, title_rank,
  CAST(c_nationkey + (title_rank - 3) * 100 AS INT) AS begins
FROM (SELECT c_custkey, c_nationkey, CAST(c_custkey AS VARCHAR) AS k, CASE c_mktsegment WHEN 'BUILDING' THEN 3
  WHEN 'MACHINERY' THEN 4 ELSE CASE WHEN c_nationkey > 12 THEN 5 END END AS title_rank FROM customer)
WHERE title_rank IS NOT NULL
"""


def not_blank(spark, d):
    segment = F.col("c_mktsegment")
    country = F.when(segment == "BUILDING", " ").when(segment == "MACHINERY", "").when(segment == "FURNITURE", "USA")
    rows = table(spark, d, "customer").select("c_custkey", country.alias("country"))
    return gate.not_blank(rows, "country")


QUERIES = {
    "gate_rejects": (
        gate_rejects,
        sql(JUDGED_SQL, "SELECT o_orderkey, reject_reason FROM judged WHERE reject_reason NOT LIKE 'skip:%'"),
    ),
    "gate_accepted": (
        gate_accepted,
        sql(JUDGED_SQL, "SELECT o_orderkey, title, person, file_no FROM judged WHERE reject_reason IS NULL"),
    ),
    "gate_skipped": (
        gate_skipped,
        sql(JUDGED_SQL, "SELECT o_orderkey, person FROM judged WHERE reject_reason LIKE 'skip:%'"),
    ),
    "route_split": (
        route_split,
        "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'student' ELSE 'staff' END AS route, "
        "c_name || '@example.org' AS email FROM customer WHERE c_nationkey > 12",
    ),
    "open_rows": (
        open_rows,
        sql(
            contacts_sql(),
            "SELECT aa_no, id, aa, beg_date FROM contact WHERE end_date IS NULL AND aa IN ('PERM', 'PREV', 'SCND')",
        ),
    ),
    "active_rows": (
        active_rows,
        sql(
            contacts_sql(),
            f"SELECT aa_no, id, aa, end_date FROM contact WHERE end_date IS NULL OR end_date > DATE '{EVENT_DAY}'",
        ),
    ),
    "active_codes": (active_codes, sql(CODES_SQL, "SELECT code, descr FROM codes WHERE inactive_date IS NULL")),
    "first_filled_slot": (first_filled_slot, SLOT_SQL),
    "not_blank": (not_blank, "SELECT c_custkey, 'USA' AS country FROM customer WHERE c_mktsegment = 'FURNITURE'"),
}
