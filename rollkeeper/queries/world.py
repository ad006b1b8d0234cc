"""A batch and all target tables, derived from the test tables.

Every order is one position row of its customer; customers, suppliers, nations and
events supply what the targets hold. Each definition stands once for Spark and
once as SQL, under the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollkeeper.plans.fan_out import PERSON_COLUMNS
from rollkeeper.queries.inputs import (
    CUT_DAY,
    EVENT_DAY,
    contacts,
    contacts_sql,
    fingerprint_sql,
    table,
)
from rollkeeper.session import written

# One expression per column of the batch, readable by both engines.
BATCH = {
    "carth_id": "CASE WHEN c_nationkey = 4 THEN '' ELSE CAST(c_custkey AS {text}) END",
    "file_number": "CASE WHEN c_nationkey = 7 THEN lpad(CAST(c_custkey + 1 AS {text}), 6, '0')"
    " ELSE lpad(CAST(c_custkey AS {text}), 6, '0') END",
    "payroll_name": "c_name",
    "last_name": "substr(c_name, 10, 9)",
    "first_name": "substr(c_name, 1, 8)",
    "middle_name": "CASE WHEN c_nationkey = 2 THEN 'M' ELSE '' END",
    "salutation": "concat(lower(substr(c_mktsegment, 1, 4)), '.')",
    "primary_address1": "concat(substr(c_name, 10, 9), ' Street')",
    "primary_address2": "''",
    "primary_address3": "''",
    "primary_city": "concat('City ', CAST(c_nationkey AS {text}))",
    "primary_state_code": "'WI'",
    "primary_zip": "lpad(CAST(c_nationkey AS {text}), 5, '0')",
    "primary_country_code": "CASE WHEN c_nationkey = 9 THEN ' '"
    " ELSE concat('C', lpad(CAST(c_nationkey AS {text}), 2, '0')) END",
    "home_phone": "concat('(262) ', lpad(CAST(c_custkey AS {text}), 7, '5'))",
    "mobile_phone": "CASE WHEN c_nationkey < 8 THEN concat('414', lpad(CAST(c_custkey AS {text}), 7, '1'))"
    " ELSE '' END",
    "personal_email": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN ''"
    " WHEN o_totalprice > 300000 THEN CAST(c_nationkey AS {text}) ELSE concat(c_name, '@home') END",
    "wc_work_email": "CASE WHEN c_mktsegment = 'FURNITURE' THEN '' ELSE concat(c_name, '@work') END",
    "ssn": "lpad(CAST(c_custkey AS {text}), 9, '0')",
    "gender": "CASE WHEN c_nationkey > 12 THEN 'F' ELSE 'M' END",
    "race": "CASE WHEN c_nationkey > 12 THEN 'WH' ELSE '' END",
    "ethnicity": "CASE WHEN c_nationkey > 18 THEN 'Y' WHEN c_nationkey > 12 THEN 'N' END",
    "birth_date": "CASE WHEN c_nationkey <> 5 THEN DATE '1980-02-29' END",
    "employee_assoc_id": "CASE WHEN c_nationkey = 8 THEN concat('A', CAST(c_custkey + 1 AS {text}))"
    " ELSE concat('A', CAST(c_custkey AS {text})) END",
    "location_code": "CAST(c_nationkey AS {text})",
    "room_number": "substr(c_name, 15, 4)",
    "payroll_comp_code": "CASE c_mktsegment WHEN 'BUILDING' THEN 'DPW' WHEN 'MACHINERY' THEN 'DPR' ELSE 'DPC' END",
    "pos_effective_date": "CAST(o_orderdate AS DATE)",
    "termination_date": "CASE WHEN o_totalprice < 100000 THEN CAST(o_orderdate AS DATE) END",
    "primary_position": "CASE o_orderpriority WHEN '1-URGENT' THEN 'Yes' WHEN '2-HIGH' THEN 'No' ELSE '' END",
    "business_unit_code": "lpad(CAST(c_nationkey AS {text}), 3, '0')",
    "business_unit_descr": "concat('unit ', CAST(c_nationkey AS {text}))",
    "home_dept_code": "lpad(CAST(c_nationkey AS {text}), 3, '0')",
    "home_dept_descr": "concat('dept ', CAST(c_nationkey AS {text}),"
    " CASE WHEN o_totalprice > 400000 THEN ' new' ELSE '' END)",
    "job_title_code": "CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE concat(substr(o_orderpriority, 1, 1), 'T') END",
    "job_title_descr": "concat(o_orderpriority, CASE WHEN o_totalprice > 400000 THEN ' senior' ELSE '' END)",
    "worker_cat_code": "CASE o_orderstatus WHEN 'O' THEN 'T' WHEN 'F' THEN 'TE' ELSE 'S' END",
    "worker_cat_descr": "concat('cat ', o_orderstatus)",
    "job_class_code": "CASE WHEN o_orderpriority = '3-MEDIUM' THEN ' ' ELSE substr(o_orderpriority, 1, 2) END",
    "job_class_descr": "concat('class ', substr(o_orderpriority, 3, 20))",
    "job_function_code": "o_orderstatus",
    "supervisor_id": "concat('SUP', lpad(CAST(c_nationkey AS {text}), 7, '0'))",
}

ID_REC = {
    "id": "CAST(c_custkey AS INT)",
    "fullname": "lower(c_name)",
    "lastname": "'old'",
    "firstname": "'old'",
    "middlename": "''",
    "title": "'MS'",
    "ss_no": "lpad(CAST(c_custkey AS {text}), 9, '0')",
    "decsd": "CASE WHEN c_nationkey = 1 THEN 'Y' ELSE 'N' END",
    "upd_date": "DATE '1999-01-01'",
    "ofc_add_by": "'X'",
    "addr_line1": "CASE WHEN c_nationkey IN (2, 6) THEN CAST(NULL AS {text})"
    " WHEN c_nationkey > 15 THEN concat(substr(c_name, 10, 9), ' Street')"
    " ELSE CAST(c_custkey AS {text}) END",
    "addr_line2": "''",
    "addr_line3": "''",
    "city": "concat('City ', CAST(c_nationkey AS {text}))",
    "st": "'WI'",
    "zip": "lpad(CAST(c_nationkey AS {text}), 5, '0')",
    "ctry": "concat('C', lpad(CAST(c_nationkey AS {text}), 2, '0'))",
    "aa": "'PERM'",
    "phone": "''",
}

PROFILE = {
    "id": "CAST(s_suppkey AS INT)",
    "sex": "'X'",
    "race": "'UN'",
    "hispanic": "'N'",
    "birth_date": "DATE '1970-01-01'",
    "age": "54",
    "prof_last_upd_date": "DATE '2020-01-01'",
}

# The cross-reference of a supplier's number; some hold a neighbour's ids.
XREF = {
    "old_id": "CAST(s_suppkey AS {text})",
    "old_id_num": "CAST(s_suppkey AS INT)",
    "adp_id": "lpad(CAST(s_suppkey AS {text}), 6, '0')",
    "ssn": "''",
    "cx_id": "CAST(s_suppkey AS INT)",
    "cx_id_char": "CAST(s_suppkey AS {text})",
    "adp_associate_id": "concat('A', CAST(s_suppkey AS {text}))",
}

DIVISION = {
    "hrdiv": "lpad(CAST(n_nationkey AS {text}), 3, '0')",
    "descr": "concat(CASE WHEN n_regionkey = 1 THEN 'old ' ELSE '' END, 'unit ', CAST(n_nationkey AS {text}))",
    "beg_date": "DATE '1999-01-01'",
    "end_date": "CAST(NULL AS DATE)",
}

DEPARTMENT = {
    "hrdept": "lpad(CAST(n_nationkey AS {text}), 3, '0')",
    "hrdiv": "CASE WHEN n_regionkey = 3 THEN 'XXX' ELSE lpad(CAST(n_nationkey AS {text}), 3, '0') END",
    "descr": "concat(CASE WHEN n_regionkey = 1 THEN 'old ' ELSE '' END, 'dept ', CAST(n_nationkey AS {text}))",
    "beg_date": "DATE '1999-01-01'",
    "end_date": "CAST(NULL AS DATE)",
}

POSITION_KEY = (
    "concat_ws('-', CASE c_mktsegment WHEN 'BUILDING' THEN 'DPW' WHEN 'MACHINERY' THEN 'DPR' ELSE 'DPC' END,"
    " lpad(CAST(c_nationkey AS {text}), 3, '0'), lpad(CAST(c_nationkey AS {text}), 3, '0'),"
    " concat(substr(o_orderpriority, 1, 1), 'T'))"
)

POSITION_COLUMNS = [
    "tpos_no", "pcn_aggr", "pcn_01", "pcn_02", "pcn_03", "pcn_04", "descr", "ofc", "func_area", "supervisor_no",
    "tenure_track", "fte", "max_jobs", "hrpay", "active_date", "inactive_date", "prev_pos",
]
JOB_COLUMNS = [
    "job_no", "tpos_no", "descr", "bjob_no", "id", "hrpay", "supervisor_no", "hrstat", "egp_type", "hrdiv", "hrdept",
    "comp_beg_date", "comp_end_date", "beg_date", "end_date", "active_ctrct", "ctrct_stat", "excl_srvc_hrs",
    "excl_web_time", "job_title", "title_rank", "worker_ctgry", "hrclass",
]

# Positions of the nations of regions 1 to 3, known by their older orders.
POSITION = {
    "tpos_no": "CAST(min(o_orderkey) AS INT)",
    "pcn_01": "substr(pcn_aggr, 1, 3)",
    "pcn_02": "substr(pcn_aggr, 5, 3)",
    "pcn_03": "substr(pcn_aggr, 9, 3)",
    "pcn_04": "substr(pcn_aggr, 13, 2)",
    "descr": "min(o_orderpriority)",
    "ofc": "'OFC'",
    "func_area": "substr(pcn_aggr, 9, 3)",
    "supervisor_no": "CAST(NULL AS INT)",
    "tenure_track": "'old'",
    "fte": "1",
    "max_jobs": "1",
    "hrpay": "substr(pcn_aggr, 1, 3)",
    "active_date": "DATE '1999-01-01'",
    "inactive_date": "CAST(NULL AS DATE)",
    "prev_pos": "'p'",
}

JOB = {
    "job_no": "CAST(o_orderkey AS INT)",
    "tpos_no": "tpos_no",
    "descr": "'old'",
    "bjob_no": "7",
    "id": "CAST(o_custkey AS INT)",
    "hrpay": "'OLD'",
    "supervisor_no": "0",
    "hrstat": "''",
    "egp_type": "'R'",
    "hrdiv": "''",
    "hrdept": "''",
    "comp_beg_date": "CAST(NULL AS DATE)",
    "comp_end_date": "CAST(NULL AS DATE)",
    "beg_date": "CAST(o_orderdate AS DATE)",
    "end_date": "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END",
    "active_ctrct": "'N'",
    "ctrct_stat": "'N/A'",
    "excl_srvc_hrs": "'N'",
    "excl_web_time": "'N'",
    "job_title": "o_orderpriority",
    "title_rank": "CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END",
    "worker_ctgry": "''",
    "hrclass": "''",
}

EMPLOYMENT = {
    "id": "CAST(s_suppkey AS INT)",
    "home_tpos_no": "0",
    "ss_first": "''",
    "ss_middle": "''",
    "ss_last": "''",
    "ss_suffix": "''",
    "tenure": "''",
    "tenure_date": "CAST(NULL AS DATE)",
    "is_tenured": "'N'",
    "is_tenure_track": "'N'",
}

# Second jobs: customers by nation, some with a malformed or an unknown key.
SECOND_JOB = {
    "id": "CAST(c_custkey AS INT)",
    "title_rank": "CASE WHEN c_nationkey > 12 THEN 3 ELSE 4 END",
    "pcn_aggr": "CASE WHEN c_mktsegment = 'FURNITURE' THEN 'DPR-001' WHEN c_mktsegment = 'HOUSEHOLD' THEN"
    " concat_ws('-', 'DPZ', '000', '000', '1T') ELSE concat_ws('-', 'DPR',"
    " lpad(CAST(c_nationkey AS {text}), 3, '0'), lpad(CAST(c_nationkey AS {text}), 3, '0'), '2T') END",
    "worker_cat_code": "'S'",
    "job_title_descr": "concat('second ', CAST(c_nationkey AS {text}))",
    "job_function_code": "'JF'",
    "position_start": "DATE '2023-01-01'",
    "position_end": "CASE WHEN c_nationkey > 20 THEN DATE '2025-01-01' END",
}

KEPT_KIND = {"view": "PERM", "click": "SCHL", "signup": "CELL", "purchase": "EML2", "error": "EML3"}


def _expressions(columns: dict[str, str], text: str) -> list[str]:
    return [f"{e.format(text=text)} AS {name}" for name, e in columns.items()]


def _spark(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*_expressions(columns, "STRING"))


def _sql(name: str, columns: dict[str, str], source: str) -> str:
    return f"{name} AS (SELECT {', '.join(_expressions(columns, 'VARCHAR'))} FROM {source})"


def orders(spark: SparkSession, folder: str) -> DataFrame:
    rows, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    return rows.join(customer, F.col("o_custkey") == F.col("c_custkey"))


ORDERS_SQL = "orders JOIN customer ON o_custkey = c_custkey"


def batch(spark: SparkSession, folder: str) -> DataFrame:
    # A small file is read by one task; its rows are spread out before they become wide.
    parts = spark.sparkContext.defaultParallelism
    return _spark(orders(spark, folder).repartition(parts, "o_orderkey"), BATCH)


def targets(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Positions and jobs, which take joins to derive, are stored once: a fan-out reads its targets many times."""

    def read(name):
        return table(spark, folder, name)

    placed = orders(spark, folder)
    nation = read("nation")
    old = placed.filter(
        (F.to_date("o_orderdate") < F.lit(CUT_DAY)) & F.col("c_nationkey").between(5, 19)
    ).withColumn("pcn_aggr", F.expr(POSITION_KEY.format(text="STRING")))
    position = old.groupBy("pcn_aggr").agg(
        *[F.expr(e.format(text="STRING")).alias(n) for n, e in POSITION.items()]
    )
    position = written(position.select(*POSITION_COLUMNS), "positions")
    job = old.join(position.select("pcn_aggr", "tpos_no"), "pcn_aggr").repartition(spark.sparkContext.defaultParallelism, "o_orderkey")
    status = F.col("o_orderstatus")
    kept = contacts(spark, folder, KEPT_KIND)
    return {
        "id_rec": _spark(read("customer").filter("c_nationkey <> 3"), ID_REC),
        "title_table": read("customer")
        .filter("c_mktsegment <> 'FURNITURE'")
        .select(F.substring("c_mktsegment", 1, 4).alias("title"))
        .distinct(),
        "ctry_table": nation.filter("n_regionkey <> 0").selectExpr(
            "concat('C', lpad(CAST(n_nationkey AS STRING), 2, '0')) AS ctry"
        ),
        "func_table": nation.filter("n_regionkey <> 0").selectExpr("lpad(CAST(n_nationkey AS STRING), 3, '0') AS func"),
        "hrpay_table": read("customer").filter("c_mktsegment = 'MACHINERY'").selectExpr("'DPR' AS hrpay").distinct(),
        "aa_rec": kept.withColumn("id", F.col("id").cast("int")).withColumn("aa_no", F.col("aa_no").cast("int")),
        "profile_rec": _spark(read("supplier"), PROFILE),
        "cvid_rec": _spark(read("supplier"), XREF),
        "cc_work_cat_table": read("orders")
        .filter(status != "P")
        .select(
            F.when(status == "O", "T").otherwise("TE").alias("work_cat_code"),
            F.when(status == "O", "cat O").otherwise("old").alias("work_cat_descr"),
            F.expr("DATE '1999-01-01'").alias("active_date"),
        )
        .distinct(),
        "hrclass_table": read("orders")
        .filter("o_orderpriority <> '4-NOT SPECIFIED'")
        .selectExpr(
            "substr(o_orderpriority, 1, 2) AS hrclass",
            "CASE o_orderpriority WHEN '1-URGENT' THEN 'class URGENT' ELSE 'old' END AS txt",
            "DATE '1999-01-01' AS active_date",
            "CASE WHEN o_orderpriority = '5-LOW' THEN DATE '2000-01-01' END AS inactive_date",
        )
        .distinct(),
        "hrdiv_table": _spark(nation.filter("n_regionkey <> 2"), DIVISION),
        "hrdept_table": _spark(nation.filter("n_regionkey <> 2"), DEPARTMENT),
        "pos_table": position,
        "job_rec": written(_spark(job, JOB), "jobs"),
        "hremp_rec": _spark(read("supplier"), EMPLOYMENT),
    }


def second_jobs(spark: SparkSession, folder: str) -> DataFrame:
    return _spark(table(spark, folder, "customer"), SECOND_JOB)


def persons(known: DataFrame) -> DataFrame:
    """Equal person rows once, as the fan-out folds them."""
    return known.groupBy(*PERSON_COLUMNS, "payroll_comp_code").agg(
        F.max("pos_effective_date").alias("pos_effective_date")
    )


_PERSON = [*PERSON_COLUMNS, "payroll_comp_code"]

WORLD_SQL = ",\n".join(
    [
        _sql("batch", BATCH, ORDERS_SQL),
        _sql("id_rec", ID_REC, "customer WHERE c_nationkey <> 3"),
        "title_table AS (SELECT DISTINCT left(c_mktsegment, 4) AS title FROM customer"
        " WHERE c_mktsegment <> 'FURNITURE')",
        "ctry_table AS (SELECT 'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS ctry FROM nation"
        " WHERE n_regionkey <> 0)",
        "func_table AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS func FROM nation WHERE n_regionkey <> 0)",
        "hrpay_table AS (SELECT DISTINCT 'DPR' AS hrpay FROM customer WHERE c_mktsegment = 'MACHINERY')",
        contacts_sql(KEPT_KIND).strip(),
        "aa_rec AS (SELECT * FROM contact)",
        _sql("profile_rec", PROFILE, "supplier"),
        _sql("cvid_rec", XREF, "supplier"),
        "cc_work_cat_table AS (SELECT DISTINCT CASE o_orderstatus WHEN 'O' THEN 'T' ELSE 'TE' END AS work_cat_code,"
        " CASE o_orderstatus WHEN 'O' THEN 'cat O' ELSE 'old' END AS work_cat_descr,"
        " DATE '1999-01-01' AS active_date FROM orders WHERE o_orderstatus <> 'P')",
        "hrclass_table AS (SELECT DISTINCT left(o_orderpriority, 2) AS hrclass,"
        " CASE o_orderpriority WHEN '1-URGENT' THEN 'class URGENT' ELSE 'old' END AS txt,"
        " DATE '1999-01-01' AS active_date,"
        " CASE WHEN o_orderpriority = '5-LOW' THEN DATE '2000-01-01' END AS inactive_date FROM orders"
        " WHERE o_orderpriority <> '4-NOT SPECIFIED')",
        _sql("hrdiv_table", DIVISION, "nation WHERE n_regionkey <> 2"),
        _sql("hrdept_table", DEPARTMENT, "nation WHERE n_regionkey <> 2"),
        f"old AS (SELECT *, {POSITION_KEY.format(text='VARCHAR')} AS pcn_aggr FROM {ORDERS_SQL}"
        f" WHERE CAST(o_orderdate AS DATE) < DATE '{CUT_DAY}' AND c_nationkey BETWEEN 5 AND 19)",
        _sql("pos_table", {"pcn_aggr": "pcn_aggr", **POSITION}, "old GROUP BY pcn_aggr"),
        _sql("job_rec", JOB, "old JOIN (SELECT pcn_aggr, tpos_no FROM pos_table) USING (pcn_aggr)"),
        _sql("hremp_rec", EMPLOYMENT, "supplier"),
        _sql("second_in", SECOND_JOB, "customer"),
        # What the fan-out makes of the batch before it turns to the targets.
        "known AS (SELECT *, CAST(carth_id AS INT) AS id FROM (SELECT * FROM batch WHERE carth_id <> '')"
        " WHERE CAST(carth_id AS INT) IN (SELECT id FROM id_rec))",
        f"persons AS (SELECT {', '.join(_PERSON)}, max(pos_effective_date) AS pos_effective_date FROM known"
        f" GROUP BY {', '.join(_PERSON)})",
        f"ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos_effective_date DESC,"
        f" {fingerprint_sql(*_PERSON, 'pos_effective_date')} DESC) AS rn FROM persons)",
        "person AS (SELECT * FROM ranked WHERE rn = 1)",
        "staff AS (SELECT * FROM person WHERE payroll_comp_code <> 'DPW')",
        "titled AS (SELECT *, left(business_unit_code, 4) AS unit, left(home_dept_code, 3) AS dept FROM known"
        " WHERE payroll_comp_code <> 'DPW' AND trim(job_title_code) <> '')",
    ]
)

TODAY = f"DATE '{EVENT_DAY}'"
