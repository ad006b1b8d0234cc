"""Sources and column functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from rollkeeper.functions import codes, compare, dates, text
from rollkeeper.queries.inputs import ORDER_DAY, phone_sql, table
from rollkeeper.session import shared_folder
from rollkeeper.sources.feed import read_csv, write_csv


def _scratch(spark) -> str:
    return f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"


def _texts(df):
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def csv_roundtrip(spark, d):
    odd = F.concat(F.lit('  "'), F.col("c_name"), F.lit('", x\ny '))
    customer = table(spark, d, "customer").withColumn("c_name", odd)
    path = _scratch(spark)
    write_csv(_texts(customer), path)
    back = read_csv(spark, path, customer.columns, multi_line=True)
    return back.select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"),
        "c_name",
        F.col("c_acctbal").cast("double").alias("c_acctbal"),
        "c_mktsegment",
        F.col("_corrupt_record").isNull().alias("whole"),
    )


def folder_scan(spark, d):
    customer = _texts(table(spark, d, "customer"))
    path = _scratch(spark)
    first = F.col("c_mktsegment") == "BUILDING"
    write_csv(customer.filter(first), f"{path}/drop_a")
    write_csv(customer.filter(~first), f"{path}/drop_b")
    back = read_csv(spark, f"{path}/drop_*", customer.columns)
    folder = F.regexp_extract(F.input_file_name(), "/(drop_[ab])/", 1)
    return back.select("c_custkey", "c_name", "c_mktsegment", folder.alias("folder"))


def rename_project(spark, d):
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("fullname"),
        F.col("c_mktsegment").alias("ofc"),
        F.lit("N").alias("decsd"),
        F.lit("HR").alias("ofc_add_by"),
        F.lit(0).alias("fte"),
    )


def trim_cut(spark, d):
    padded = F.concat(F.lit("  "), F.col("c_name"), F.lit(" "), F.col("c_mktsegment"), F.lit("   "))
    trimmed = text.trim(padded)
    return table(spark, d, "customer").select(
        "c_custkey", trimmed.alias("trimmed"), *[text.cut(trimmed, n).alias(f"cut_{n}") for n in (1, 4, 24, 64)]
    )


def zero_pad(spark, d):
    key, negative = F.col("o_orderkey").cast("string"), (-F.col("o_custkey")).cast("string")
    return table(spark, d, "orders").select(
        "o_orderkey",
        text.zero_pad(key, 3).alias("padded"),
        text.zero_pad(negative, 3).alias("padded_negative"),
        text.zero_pad(F.substring("o_orderstatus", 1, 0), 3).alias("padded_blank"),
    )


ZERO_PAD_SQL = """
SELECT o_orderkey,
  CASE WHEN length(k) >= 3 THEN k ELSE lpad(k, 3, '0') END AS padded,
  CASE WHEN length(n) >= 3 THEN n WHEN n LIKE '-%' THEN '-' || lpad(substr(n, 2), 2, '0')
    ELSE lpad(n, 3, '0') END AS padded_negative,
  '000' AS padded_blank
FROM (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS k, CAST(-o_custkey AS VARCHAR) AS n FROM orders)
"""


def _feed_days(spark, d):
    day, status, priority = F.col("o_orderdate"), F.col("o_orderstatus"), F.col("o_orderpriority")
    spelled = (
        F.when(status == "O", F.date_format(day, "M/d/yyyy"))
        .when(status == "F", F.date_format(day, "MM/dd/yyyy"))
        .when(priority == "1-URGENT", "")
        .when(priority == "2-HIGH", F.concat((F.month(day) + 12).cast("string"), F.date_format(day, "/d/yyyy")))
        .when(priority == "3-MEDIUM", F.concat(F.lit("2/30/"), F.date_format(day, "yyyy")))
        .when(priority == "4-NOT SPECIFIED", F.date_format(day, "MM/dd/yy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    return table(spark, d, "orders").select("o_orderkey", spelled.alias("day_text"))


FEED_DAYS_SQL = """
WITH spelled AS (
  SELECT o_orderkey, CASE
    WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%-m/%-d/%Y')
    WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN o_orderpriority = '1-URGENT' THEN ''
    WHEN o_orderpriority = '2-HIGH' THEN (month(o_orderdate) + 12) || strftime(o_orderdate, '/%-d/%Y')
    WHEN o_orderpriority = '3-MEDIUM' THEN '2/30/' || strftime(o_orderdate, '%Y')
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%m/%d/%y')
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day_text
  FROM orders),
parsed AS (
  SELECT *, CASE WHEN regexp_matches(day_text, '^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$')
    THEN CAST(try_strptime(day_text, '%m/%d/%Y') AS DATE) END AS day FROM spelled)
"""


def date_parse(spark, d):
    c = F.col("day_text")
    return _feed_days(spark, d).select(
        "o_orderkey", "day_text", dates.feed_date(c).alias("day"), dates.bad_feed_date(c).alias("bad")
    )


def date_format(spark, d):
    c = F.col("day_text")
    day = dates.feed_date(c)
    return _feed_days(spark, d).select(
        "o_orderkey",
        dates.us_text(day).alias("us"),
        dates.iso_text(day).alias("iso"),
        dates.normal_us_text(c).alias("normal_us"),
    )


def _phones(spark, d):
    key = F.lpad(F.col("c_custkey").cast("string"), 7, "5")
    segment = F.col("c_mktsegment")
    given = (
        F.when(segment == "BUILDING", F.concat(F.lit("(262) "), F.substring(key, 1, 3), F.lit("-"), F.substring(key, 4, 4)))
        .when(segment == "MACHINERY", F.concat(F.lit("262"), key, F.lit("99")))
        .when(segment == "FURNITURE", F.col("c_custkey").cast("string"))
        .when(segment == "HOUSEHOLD", "")
    )
    return table(spark, d, "customer").select("c_custkey", given.alias("given"))


def phone_format(spark, d):
    return _phones(spark, d).select("c_custkey", text.phone(F.col("given")).alias("phone"))


PHONE_SQL = f"""
SELECT c_custkey, {phone_sql("given")} AS phone FROM (
  SELECT c_custkey, CASE c_mktsegment
    WHEN 'BUILDING' THEN '(262) ' || substr(k, 1, 3) || '-' || substr(k, 4, 4)
    WHEN 'MACHINERY' THEN '262' || k || '99'
    WHEN 'FURNITURE' THEN CAST(c_custkey AS VARCHAR)
    WHEN 'HOUSEHOLD' THEN '' END AS given
  FROM (SELECT *, lpad(CAST(c_custkey AS VARCHAR), 7, '5') AS k FROM customer))
"""


def code_map(spark, d):
    segment = F.col("c_mktsegment")
    answer = F.when(segment == "BUILDING", "Hispanic or Latino").when(segment == "MACHINERY", "Not Hispanic or Latino").when(segment == "FURNITURE", "")
    return table(spark, d, "customer").select(
        "c_custkey",
        codes.race_code(F.col("c_nationkey").cast("string")).alias("race"),
        codes.hispanic_flag(answer).alias("hispanic"),
        codes.flag_or_no(answer).alias("flag"),
    )


CODE_MAP_SQL = """
SELECT c_custkey,
  CASE c_nationkey WHEN 1 THEN 'WH' WHEN 2 THEN 'BL' WHEN 4 THEN 'AS' WHEN 5 THEN 'AM' WHEN 6 THEN 'AP'
    WHEN 9 THEN 'MU' ELSE '' END AS race,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Y' WHEN 'MACHINERY' THEN 'N' ELSE '' END AS hispanic,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Hispanic or Latino' WHEN 'MACHINERY' THEN 'Not Hispanic or Latino'
    WHEN 'FURNITURE' THEN '' ELSE 'N' END AS flag
FROM customer
"""


def long_code_map(spark, d):
    segment = F.col("c_mktsegment")
    name = (
        F.when(segment == "BUILDING", "White")
        .when(segment == "MACHINERY", "Two or More Races")
        .when(segment == "FURNITURE", "Native Hawaiian or Other Pacific Islander")
        .otherwise(segment)
    )
    given = F.concat(name, F.lit(" (United States of America)"))
    return table(spark, d, "customer").select("c_custkey", codes.race_text_code(given).alias("race"))


LONG_CODE_MAP_SQL = """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'WH' WHEN 'MACHINERY' THEN 'MU'
  WHEN 'FURNITURE' THEN 'IS' ELSE '' END AS race FROM customer
"""


def location_text(spark, d):
    building = codes.building(F.col("c_nationkey").cast("string"))
    room = text.cut(F.col("c_custkey").cast("string"), 4)
    return table(spark, d, "customer").select(
        "c_custkey", building.alias("building"), text.location(building, room).alias("location")
    )


LOCATION_SQL = """
SELECT c_custkey, building, concat_ws(' ', building, left(CAST(c_custkey AS VARCHAR), 4)) AS location
FROM (SELECT c_custkey, CASE c_nationkey WHEN 1 THEN 'LH' WHEN 2 THEN 'CC' WHEN 3 THEN 'DSC' WHEN 4 THEN 'HL'
  WHEN 5 THEN 'JAC' WHEN 6 THEN 'TWC' WHEN 7 THEN 'TC' WHEN 11 THEN 'MADR' WHEN 15 THEN 'SC'
  WHEN 16 THEN 'TA' END AS building FROM customer)
"""


def age_years(spark, d):
    born = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(
        "o_orderkey",
        dates.age_years(born, F.lit(ORDER_DAY)).alias("age"),
        dates.age_years(F.lit(None).cast("date"), F.lit(ORDER_DAY)).alias("no_age"),
    )


AGE_SQL = f"""
SELECT o_orderkey, CAST(year(DATE '{ORDER_DAY}') - year(o_orderdate)
  - CASE WHEN strftime(o_orderdate, '%m%d') > '{ORDER_DAY:%m%d}' THEN 1 ELSE 0 END AS INT) AS age,
  CAST(NULL AS INT) AS no_age
FROM orders
"""


def key_build(spark, d):
    size = F.lpad(F.col("p_size").cast("string"), 5, "0")
    return table(spark, d, "part").select(
        "p_partkey",
        text.position_key(F.col("p_brand"), size, F.col("p_type"), F.col("p_name")).alias("pcn_aggr"),
        text.supervisor_number(F.col("p_name")).alias("number"),
    )


KEY_BUILD_SQL = """
SELECT p_partkey, p_brand || '-' || left(lpad(CAST(p_size AS VARCHAR), 5, '0'), 4) || '-' || left(p_type, 3)
  || '-' || p_name AS pcn_aggr, substr(p_name, 4, 7) AS number FROM part
"""


def key_split(spark, d):
    size = F.col("p_size")
    five = F.concat_ws("-", "p_brand", "p_type", size.cast("string"), "p_name", "p_type")
    key = F.when(size <= 10, F.concat_ws("-", "p_brand", "p_type")).otherwise(five)
    parts = text.split_position_key(key)
    return table(spark, d, "part").select(
        "p_partkey", *[parts.getField(n).alias(n) for n in ("pay", "unit", "dept", "title")]
    )


KEY_SPLIT_SQL = """
SELECT p_partkey, CASE WHEN p_size > 10 THEN p_brand END AS pay, CASE WHEN p_size > 10 THEN p_type END AS unit,
  CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) END AS dept,
  CASE WHEN p_size > 10 THEN p_name || '-' || p_type END AS title FROM part
"""


def rank_flag(spark, d):
    answer = F.when(F.col("o_orderpriority") == "1-URGENT", "Yes").when(F.col("o_orderpriority") == "2-HIGH", "No").otherwise("")
    return table(spark, d, "orders").select("o_orderkey", codes.primary_rank(answer).alias("title_rank"))


def tenure_flags(spark, d):
    segment = F.col("c_mktsegment")
    category = F.when(segment == "BUILDING", "T").when(segment == "MACHINERY", "TE").when(segment == "FURNITURE", "S")
    return table(spark, d, "customer").select(
        "c_custkey",
        codes.is_tenured(category).alias("is_tenured"),
        codes.is_tenure_track(category).alias("is_tenure_track"),
    )


TENURE_SQL = """
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Y' ELSE 'N' END AS is_tenured,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'Y' ELSE 'N' END AS is_tenure_track FROM customer
"""


def title_clean(spark, d):
    dotted = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit(". ")), F.lit("."))
    return table(spark, d, "part").select("p_partkey", text.title_key(dotted).alias("title"))


def null_blank(spark, d):
    day = F.to_date("o_orderdate")
    status = F.when(F.col("o_orderstatus") == "P", "").when(F.col("o_orderstatus") == "F", "F")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", "").when(F.col("o_orderpriority") == "2-HIGH", "F")
    return table(spark, d, "orders").select(
        "o_orderkey",
        text.blank_to_null(status).alias("blank_to_null"),
        text.null_to_blank(status).alias("null_to_blank"),
        dates.next_day(day).alias("next_day"),
        compare.same_or_both_blank(status, urgent).alias("same_in_snapshot"),
        compare.stored_equals(status, urgent).alias("same_in_verify"),
        compare.differs(status, urgent).alias("differs_in_row"),
    )


NULL_BLANK_SQL = """
SELECT o_orderkey, nullif(s, '') AS blank_to_null, coalesce(s, '') AS null_to_blank,
  CAST(o_orderdate AS DATE) + 1 AS next_day, coalesce(s, '') = coalesce(u, '') AS same_in_snapshot,
  s = u AS same_in_verify, s IS DISTINCT FROM u AS differs_in_row
FROM (SELECT *, CASE o_orderstatus WHEN 'P' THEN '' WHEN 'F' THEN 'F' END AS s,
  CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN 'F' END AS u FROM orders)
"""


def numeric_text_eq(spark, d):
    padded = F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    lettered = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("A"), padded)).otherwise(padded)
    plain = F.col("o_orderkey").cast("string")
    return table(spark, d, "orders").select(
        "o_orderkey",
        (compare.number_key(lettered) == compare.number_key(plain)).alias("same_number"),
        (lettered == plain).alias("same_text"),
    )


NUMERIC_SQL = """
SELECT o_orderkey, o_orderstatus <> 'P' AS same_number,
  o_orderstatus <> 'P' AND lpad(CAST(o_orderkey AS VARCHAR), 12, '0') = CAST(o_orderkey AS VARCHAR) AS same_text
FROM orders
"""

QUERIES = {
    "csv_roundtrip": (
        csv_roundtrip,
        "SELECT c_custkey, '  \"' || c_name || '\", x' || chr(10) || 'y ' AS c_name, c_acctbal, c_mktsegment, "
        "true AS whole FROM customer",
    ),
    "folder_scan": (
        folder_scan,
        "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment, "
        "CASE WHEN c_mktsegment = 'BUILDING' THEN 'drop_a' ELSE 'drop_b' END AS folder FROM customer",
    ),
    "rename_project": (
        rename_project,
        "SELECT c_custkey AS id, c_name AS fullname, c_mktsegment AS ofc, 'N' AS decsd, 'HR' AS ofc_add_by, "
        "0 AS fte FROM customer",
    ),
    "trim_cut": (
        trim_cut,
        "SELECT c_custkey, t AS trimmed, left(t, 1) AS cut_1, left(t, 4) AS cut_4, left(t, 24) AS cut_24, "
        "left(t, 64) AS cut_64 FROM (SELECT c_custkey, trim('  ' || c_name || ' ' || c_mktsegment || '   ') AS t "
        "FROM customer)",
    ),
    "zero_pad": (zero_pad, ZERO_PAD_SQL),
    "date_parse": (
        date_parse,
        FEED_DAYS_SQL + "SELECT o_orderkey, day_text, day, day_text <> '' AND day IS NULL AS bad FROM parsed",
    ),
    "date_format": (
        date_format,
        FEED_DAYS_SQL
        + "SELECT o_orderkey, coalesce(strftime(day, '%m/%d/%Y'), '') AS us, "
        + "coalesce(strftime(day, '%Y-%m-%d'), '') AS iso, strftime(day, '%m/%d/%Y') AS normal_us FROM parsed",
    ),
    "phone_format": (phone_format, PHONE_SQL),
    "code_map": (code_map, CODE_MAP_SQL),
    "long_code_map": (long_code_map, LONG_CODE_MAP_SQL),
    "location_text": (location_text, LOCATION_SQL),
    "age_years": (age_years, AGE_SQL),
    "key_build": (key_build, KEY_BUILD_SQL),
    "key_split": (key_split, KEY_SPLIT_SQL),
    "rank_flag": (
        rank_flag,
        "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 END AS title_rank "
        "FROM orders",
    ),
    "tenure_flags": (tenure_flags, TENURE_SQL),
    "title_clean": (title_clean, "SELECT p_partkey, upper(p_name) AS title FROM part"),
    "null_blank": (null_blank, NULL_BLANK_SQL),
    "numeric_text_eq": (numeric_text_eq, NUMERIC_SQL),
}
