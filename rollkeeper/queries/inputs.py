"""Inputs derived from the test tables, once for Spark and once as SQL.

The derivations follow attributes of the rows (dates, statuses, values), so they
cover the whole tables and grow with them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER_DAY = date(2000, 2, 28)
EVENT_DAY = date(2024, 1, 28)
CUT_DAY = date(2000, 6, 1)
OPEN_ABOVE = 15


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fingerprint_sql(*columns: str) -> str:
    """The row fingerprint as SQL text (hex instead of binary, same order)."""
    parts = [
        f"coalesce(length(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in columns
    ]
    return "sha256(" + " || ',' || ".join(parts) + ")"


def phone_sql(c: str) -> str:
    t = f"regexp_replace({c}, '[() -]', '', 'g')"
    parts = f"substr({t}, 1, 3) || '-' || substr({t}, 4, 3) || '-' || substr({t}, 7, 4)"
    return f"case when {c} is null or {c} = '' then '' else {parts} end"


# Orders as snapshots: everything today, and what was known on the cut day, when
# finished urgent orders were still open.
def new_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )


def _was_open() -> Column:
    return (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")


def old_orders(spark: SparkSession, folder: str) -> DataFrame:
    before = table(spark, folder, "orders").filter(F.to_date("o_orderdate") < F.lit(CUT_DAY))
    status = F.when(_was_open(), "O").otherwise(F.col("o_orderstatus"))
    return before.select("o_orderkey", "o_custkey", status.alias("o_orderstatus"), "o_orderpriority")


ORDER_SNAPSHOTS_SQL = f"""
new_o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders),
old_o AS (
  SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'O' ELSE o_orderstatus END
      AS o_orderstatus,
    o_orderpriority
  FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '{CUT_DAY}')
"""


# Orders as a stamped history.
def history(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderdate").alias("stamp"),
        F.col("o_orderkey").alias("row_no"),
        F.col("o_orderstatus").alias("status"),
    )


HISTORY_SQL = """
hist AS (
  SELECT o_custkey AS id, o_orderpriority AS name, o_orderdate AS stamp,
    o_orderkey AS row_no, o_orderstatus AS status
  FROM orders)
"""


# Events as dated contact rows. A value above the limit leaves the row open.
KINDS = {"view": "PERM", "click": "PREV", "signup": "CELL", "purchase": "EML2", "error": "EML3"}
CONTACT_COLUMNS = [
    "aa_no", "id", "aa", "beg_date", "peren", "end_date", "line1", "line2", "line3", "city", "st",
    "zip", "ctry", "phone", "phone_ext", "ofc_add_by", "cell_carrier", "opt_out",
]


def contacts(spark: SparkSession, folder: str, kinds: dict[str, str] | None = None) -> DataFrame:
    kinds = kinds or KINDS
    kind = F.coalesce(*[F.when(F.col("event_type") == e, k) for e, k in kinds.items()])
    value = F.floor("value").cast("string")
    day = F.to_date("ts")
    blank = F.lit("")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("aa_no"),
        F.col("user_id").alias("id"),
        kind.alias("aa"),
        day.alias("beg_date"),
        F.lit("N").alias("peren"),
        F.when(F.col("value") <= OPEN_ABOVE, F.date_add(day, 1)).alias("end_date"),
        value.alias("line1"),
        blank.alias("line2"),
        F.lit("L").alias("line3"),
        blank.alias("city"),
        blank.alias("st"),
        F.lpad(value, 5, "0").alias("zip"),
        F.lit("USA").alias("ctry"),
        value.alias("phone"),
        blank.alias("phone_ext"),
        F.lit("HR").alias("ofc_add_by"),
        blank.alias("cell_carrier"),
        blank.alias("opt_out"),
    )


def contacts_sql(kinds: dict[str, str] | None = None) -> str:
    kinds = kinds or KINDS
    cases = " ".join(f"WHEN '{e}' THEN '{k}'" for e, k in kinds.items())
    return f"""
contact AS (
  SELECT event_id AS aa_no, user_id AS id, CASE event_type {cases} END AS aa,
    CAST(ts AS DATE) AS beg_date, 'N' AS peren,
    CASE WHEN value <= {OPEN_ABOVE} THEN CAST(ts AS DATE) + 1 END AS end_date,
    CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS line1, '' AS line2, 'L' AS line3,
    '' AS city, '' AS st, lpad(CAST(CAST(floor(value) AS BIGINT) AS VARCHAR), 5, '0') AS zip,
    'USA' AS ctry, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS phone, '' AS phone_ext,
    'HR' AS ofc_add_by, '' AS cell_carrier, '' AS opt_out
  FROM events)
"""


def incoming(spark: SparkSession, folder: str, unknown: str = "CELL") -> DataFrame:
    """The value of the newest event of a person and kind. Kind ``unknown`` comes in
    under a name the state does not have."""
    newest = (
        contacts(spark, folder)
        .groupBy("id", "aa")
        .agg(F.max_by("line1", F.struct("beg_date", "aa_no")).alias("value"))
    )
    return newest.withColumn("aa", F.when(F.col("aa") == unknown, "NEW").otherwise(F.col("aa")))


def incoming_sql(unknown: str = "CELL") -> str:
    return f"""
incoming AS (
  SELECT id, CASE WHEN aa = '{unknown}' THEN 'NEW' ELSE aa END AS aa, value FROM (
    SELECT id, aa, line1 AS value,
      row_number() OVER (PARTITION BY id, aa ORDER BY beg_date DESC, aa_no DESC) AS rn
    FROM contact) WHERE rn = 1)
"""


# Nations as a code table that lacks some codes and words others differently.
def codes(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    descr = F.when(F.col("n_regionkey") == 3, F.concat(F.lit("old "), "n_name")).otherwise(F.col("n_name"))
    return nation.filter(F.col("n_regionkey") != 0).select(
        F.col("n_nationkey").alias("code"),
        descr.alias("descr"),
        F.when(F.col("n_regionkey") == 2, F.lit(ORDER_DAY)).alias("inactive_date"),
    )


CODES_SQL = f"""
codes AS (
  SELECT n_nationkey AS code,
    CASE WHEN n_regionkey = 3 THEN 'old ' || n_name ELSE n_name END AS descr,
    CASE WHEN n_regionkey = 2 THEN DATE '{ORDER_DAY}' END AS inactive_date
  FROM nation WHERE n_regionkey <> 0)
"""


# Parts as positions: the smallest part of a key is the position.
def part_keys(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    size = F.lpad(F.col("p_size").cast("string"), 3, "0")
    return part.select("p_partkey", F.concat_ws("-", "p_brand", "p_type", size).alias("pcn_aggr"), "p_name")


def positions(spark: SparkSession, folder: str) -> DataFrame:
    return (
        part_keys(spark, folder)
        .groupBy("pcn_aggr")
        .agg(F.min("p_partkey").alias("tpos_no"), F.min_by("p_name", "p_partkey").alias("descr"))
    )


POSITIONS_SQL = """
part_key AS (
  SELECT p_partkey, p_brand || '-' || p_type || '-' || lpad(CAST(p_size AS VARCHAR), 3, '0') AS pcn_aggr,
    p_name FROM part),
pos AS (
  SELECT pcn_aggr, min(p_partkey) AS tpos_no, arg_min(p_name, p_partkey) AS descr
  FROM part_key GROUP BY pcn_aggr)
"""


# Orders as jobs: the position is the one of the order's smallest part.
def jobs(spark: SparkSession, folder: str) -> DataFrame:
    first = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("p_partkey"))
    placed = first.join(part_keys(spark, folder), "p_partkey").join(positions(spark, folder), "pcn_aggr")
    orders = table(spark, folder, "orders")
    day = F.to_date("o_orderdate")
    return placed.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("job_no"),
        "tpos_no",
        F.col("o_custkey").alias("id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("title_rank"),
        day.alias("beg_date"),
        F.when(F.col("o_orderstatus") != "O", F.date_add(day, 30)).alias("end_date"),
        F.col("p_name").alias("job_title"),
    )


JOBS_SQL = (
    POSITIONS_SQL
    + """,
job AS (
  SELECT o_orderkey AS job_no, pos.tpos_no, o_custkey AS id,
    CAST(substr(o_orderpriority, 1, 1) AS INT) AS title_rank, CAST(o_orderdate AS DATE) AS beg_date,
    CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 30 END AS end_date,
    p_name AS job_title
  FROM (SELECT l_orderkey, min(l_partkey) AS p_partkey FROM lineitem GROUP BY l_orderkey) l
  JOIN part_key USING (p_partkey) JOIN pos USING (pcn_aggr) JOIN orders ON l_orderkey = o_orderkey)
"""
)


def sql(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def flat(changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Changes as plain columns: what was hit, and what the row becomes."""
    return changes.select(
        "action",
        "reason",
        F.col(f"before.{key}").alias(f"old_{key}"),
        *[F.col(f"after.{c}").alias(c) for c in columns],
    )
