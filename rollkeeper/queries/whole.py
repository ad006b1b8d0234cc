"""Whole jobs: the nightly sync on the full contract, and the fan-out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollkeeper.contract import PEOPLE, STAMP
from rollkeeper.operators import gate
from rollkeeper.plans.fan_out import fan_out
from rollkeeper.plans.ingest import Ingest, clean, ingest
from rollkeeper.queries import target_sql as sqls
from rollkeeper.queries import world
from rollkeeper.queries.changing import _on_world
from rollkeeper.queries.inputs import CUT_DAY, EVENT_DAY, sql
from rollkeeper.session import written

MOMENT = datetime(2001, 9, 1, 1, 0, 0, 123456)

# Raw feed text per column where the rule below does not fit; both engines read it.
RAW = {
    "file_number": "CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN ''"
    " ELSE CAST(o_orderkey AS {text}) END",
    "carth_id": "CASE WHEN o_totalprice < 20000 THEN '' ELSE CAST(o_custkey AS {text}) END",
    "payroll_name": "c_name",
    "job_title_code": "CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE concat(o_orderpriority, 'T') END",
    "race": "CAST(c_nationkey AS {text})",
    "ethnicity": "CASE c_mktsegment WHEN 'BUILDING' THEN 'Hispanic or Latino'"
    " WHEN 'MACHINERY' THEN 'Not Hispanic or Latino' ELSE '' END",
    "business_unit_code": "CAST(c_nationkey AS {text})",
    "termination_date": "CASE WHEN o_totalprice > 480000 THEN '13/41/2001' ELSE '' END",
    "rehire_date": "''",
    "long_title": "concat(o_orderstatus, ' ', o_orderpriority)",
}


def _raw(text: str, day: str) -> dict[str, str]:
    """Raw text of each feed column: what ``RAW`` says, a spelled day, a spelled
    phone number, or a text that shows which column it is in, too long for a
    column that is cut."""
    made = {}
    for place, f in enumerate(PEOPLE.fields):
        if f.name in RAW:
            made[f.name] = RAW[f.name].format(text=text)
        elif f.cleanup == "date":
            made[f.name] = day.format(days=place)
        elif f.cleanup == "phone":
            made[f.name] = f"concat('(262) ', lpad(CAST(o_custkey + {place} AS {text}), 7, '5'))"
        elif f.cleanup.startswith("left"):
            made[f.name] = f"repeat(concat('{place} ', c_mktsegment, ' '), {int(f.cleanup[5:-1]) // 12 + 2})"
        else:
            made[f.name] = f"concat(c_mktsegment, ' {place}')"
    return made


def feed(spark, d) -> DataFrame:
    # The rows become some hundred times wider here, so they are spread out first.
    parts = spark.sparkContext.defaultParallelism
    orders = world.orders(spark, d).repartition(parts, "o_orderkey")
    raw = _raw("STRING", "date_format(date_add(CAST(o_orderdate AS DATE), {days}), 'M/d/yyyy')")
    return orders.select("o_orderdate", *[F.expr(e).alias(n) for n, e in raw.items()])


def stored(spark, d) -> DataFrame:
    """The history: cleaned rows of the orders before the cut day, each stamped with
    its day; finished urgent orders had another title then."""
    before = feed(spark, d).filter(F.to_date("o_orderdate") < F.lit(CUT_DAY))
    cleaned = before.select(*[f.clean(F.col(f.name)).alias(f.name) for f in PEOPLE.fields], "o_orderdate")
    title = F.when(F.col("long_title") == "F 1-URGENT", F.lit("O 1-URGENT")).otherwise(F.col("long_title"))
    known = cleaned.withColumn("long_title", title).filter(
        (F.col("carth_id") != "") & (F.col("file_number") != "") & (F.col("job_title_code") != "")
    )
    rows = [f.stored(F.col(f.name)).alias(f.history) for f in PEOPLE.fields]
    return known.select(*rows, F.col("o_orderdate").cast("timestamp").alias(STAMP))


def _run(spark, d) -> Ingest:
    # A history is a stored table: a run reads of it the columns that a step asks for.
    return ingest(feed(spark, d).drop("o_orderdate"), written(stored(spark, d), "history"), MOMENT)


def ingest_new_rows(spark, d):
    rows = _run(spark, d).new_rows
    return rows.withColumn(STAMP, F.col(STAMP).cast("timestamp_ntz"))


def ingest_rejects(spark, d):
    return _run(spark, d).rejects.select("payroll_name", "carth_id", "file_number", "long_title", gate.REASON)


def ingest_skipped(spark, d):
    return _run(spark, d).skipped.select("payroll_name", "carth_id", "file_number", "long_title")


def clean_feed(spark, d):
    return clean(feed(spark, d).drop("o_orderdate"))


def _cleaned_sql(f) -> str:
    c, kind = f.name, f.cleanup
    if kind.startswith("left"):
        return f"left({c}, {kind[5:-1]})"
    if kind == "date":
        return f"CAST(try_strptime(nullif({c}, ''), '%m/%d/%Y') AS DATE)"
    if kind == "phone":
        return sqls.phone_sql(c)
    if kind == "zero_pad(3)":
        return f"CASE WHEN length({c}) >= 3 THEN {c} ELSE lpad({c}, 3, '0') END"
    if kind == "race_code":
        return (
            f"CASE {c} WHEN '1' THEN 'WH' WHEN '2' THEN 'BL' WHEN '4' THEN 'AS' WHEN '5' THEN 'AM'"
            f" WHEN '6' THEN 'AP' WHEN '9' THEN 'MU' ELSE '' END"
        )
    if kind == "hispanic_flag":
        return f"CASE {c} WHEN 'Hispanic or Latino' THEN 'Y' WHEN 'Not Hispanic or Latino' THEN 'N' ELSE '' END"
    return c


def _stored_sql(f) -> str:
    if f.name == "long_title":
        return f"CASE WHEN {f.name} = 'F 1-URGENT' THEN 'O 1-URGENT' ELSE {f.name} END AS {f.name}"
    return f.name


def _listed(expression) -> str:
    return ", ".join(expression(f) for f in PEOPLE.fields)


_DAY = "strftime(CAST(o_orderdate AS DATE) + {days}, '%-m/%-d/%Y')"
_RAW_SQL = ", ".join(f"{e} AS {n}" for n, e in _raw("VARCHAR", _DAY).items())
_BAD = "CASE WHEN termination_raw NOT IN ('') AND termination_date IS NULL THEN 'bad_value:termination_date' END"


def _equal(f) -> str:
    if f.is_date:
        return f"h.{f.name} IS NOT DISTINCT FROM c.{f.name}"
    if f.type == "int" or f.history == "file_no":
        return f"CAST(h.{f.name} AS BIGINT) = CAST(c.{f.name} AS BIGINT)"
    return f"rtrim(h.{f.name}) = rtrim(c.{f.name})"


INGEST_CTES = f"""
raw AS (SELECT o_orderdate, {_RAW_SQL} FROM {world.ORDERS_SQL}),
cleaned AS (
  SELECT o_orderdate, termination_date AS termination_raw, {_listed(lambda f: f"{_cleaned_sql(f)} AS {f.name}")} FROM raw),
read AS (SELECT *, {_BAD} AS reject_reason FROM cleaned),
hist AS (
  SELECT {_listed(_stored_sql)}, o_orderdate AS date_stamp FROM read
  WHERE CAST(o_orderdate AS DATE) < DATE '{CUT_DAY}' AND carth_id <> '' AND file_number <> '' AND job_title_code <> ''),
view AS (
  SELECT * FROM hist WHERE date_stamp IN (SELECT max(date_stamp) FROM hist GROUP BY carth_id, payroll_name)),
diff AS (
  SELECT {_listed(lambda f: f.name)} FROM read WHERE reject_reason IS NULL
  EXCEPT SELECT {_listed(lambda f: f.name if f.is_date else f"trim({f.name})")} FROM view),
gated AS (
  SELECT *, CASE WHEN job_title_code = '' THEN 'skip' WHEN carth_id = '' THEN 'no_person_id'
    WHEN file_number = '' THEN 'no_file_number' END AS reject_reason FROM diff),
newest AS (SELECT *, max(date_stamp) OVER (PARTITION BY carth_id) AS top FROM hist),
latest AS (SELECT * FROM newest WHERE date_stamp = top)
"""
INGEST_SQL = sql(
    INGEST_CTES,
    f"""
SELECT {_listed(lambda f: (f"CAST({f.name} AS INT)" if f.type == "int" else f.name) + f" AS {f.history}")},
  TIMESTAMP '2001-09-01 01:00:00.12345' AS date_stamp
FROM gated c WHERE reject_reason IS NULL AND NOT EXISTS (
  SELECT 1 FROM latest h WHERE {" AND ".join(_equal(f) for f in PEOPLE.fields)})
""",
)
_NAMES = "payroll_name, carth_id, file_number, long_title"
REJECTS_SQL = sql(
    INGEST_CTES,
    f"""
SELECT {_NAMES}, reject_reason FROM read WHERE reject_reason IS NOT NULL
UNION ALL SELECT {_NAMES}, reject_reason FROM gated WHERE reject_reason <> 'skip'
""",
)


def fan_out_log(spark, d):
    """What a run does to every target: table, action, reason, key."""
    result = fan_out(world.batch(spark, d), world.targets(spark, d), EVENT_DAY)
    return result.log("2024-01-28").select("batch_id", "target", "action", "reason", "key")


def fan_out_counts(spark, d):
    result = fan_out(world.batch(spark, d), world.targets(spark, d), EVENT_DAY)
    return result.counts("2024-01-28")


def fan_out_rejects(spark, d):
    result = fan_out(world.batch(spark, d), world.targets(spark, d), EVENT_DAY)
    return result.rejects


def fan_out_warnings(spark, d):
    result = fan_out(world.batch(spark, d), world.targets(spark, d), EVENT_DAY)
    return result.warnings


_TARGETS = [
    ("id_rec", sqls.person(), "old_id"),
    ("aa_rec", sqls.contacts(), "old_aa_no"),
    ("profile_rec", sqls.profile(), "coalesce(old_id, id)"),
    ("cvid_rec", sqls.xref(), "coalesce(old_cx_id, cx_id)"),
    ("cc_work_cat_table", sqls.work_category(), "work_cat_code"),
    ("hrclass_table", sqls.job_class(), "hrclass"),
    ("hrdiv_table", sqls.division(), "hrdiv"),
    ("hrdept_table", sqls.department(), "hrdept"),
    ("pos_table", sqls.position(), "coalesce(old_tpos_no, tpos_no)"),
    ("job_rec", sqls.job(), "old_job_no"),
    ("hremp_rec", sqls.employment(), "coalesce(old_id, id)"),
]
_LOG = "\nUNION ALL\n".join(
    f"SELECT '2024-01-28' AS batch_id, '{target}' AS target, action, reason,"
    f" coalesce(CAST({key} AS VARCHAR), '') AS key FROM ({body})"
    for target, body, key in _TARGETS
)
_STEPS = sqls.PLACED_SQL + "," + sqls.JOBS_CTES

FAN_REJECTS_SQL = """
SELECT TRY_CAST(nullif(carth_id, '') AS INT) AS id, payroll_name, file_number,
  CASE WHEN carth_id = '' THEN 'no_person_id' ELSE 'unknown_person_id' END AS reject_reason
FROM batch WHERE carth_id = '' OR CAST(nullif(carth_id, '') AS INT) NOT IN (SELECT id FROM id_rec)
UNION ALL SELECT id, payroll_name, file_number, 'no_job_title_code' FROM known
WHERE payroll_comp_code <> 'DPW' AND trim(job_title_code) = ''
UNION ALL SELECT id, payroll_name, file_number, 'conflict_in_batch' FROM ranked WHERE rn > 1
"""
FAN_WARNINGS_SQL = """
SELECT id, payroll_name, 'unknown_function_code' AS warning, dept AS value FROM titled
WHERE dept NOT IN (SELECT func FROM func_table)
UNION ALL SELECT id, payroll_name, 'unknown_pay_code', payroll_comp_code FROM titled
WHERE payroll_comp_code NOT IN (SELECT hrpay FROM hrpay_table)
"""

QUERIES = {
    "clean_feed": (
        clean_feed,
        sql(INGEST_CTES, f"SELECT {_listed(lambda f: f.name)}, reject_reason FROM read"),
    ),
    "ingest": (ingest_new_rows, INGEST_SQL),
    "ingest_rejects": (ingest_rejects, REJECTS_SQL),
    "ingest_skipped": (ingest_skipped, sql(INGEST_CTES, f"SELECT {_NAMES} FROM gated WHERE reject_reason = 'skip'")),
    "fan_out": (fan_out_log, _on_world(_LOG, _STEPS)),
    "fan_out_counts": (
        fan_out_counts,
        _on_world(f"SELECT target, action, count(*) AS n FROM ({_LOG}) GROUP BY ALL", _STEPS),
    ),
    "fan_out_rejects": (fan_out_rejects, _on_world(FAN_REJECTS_SQL)),
    "fan_out_warnings": (fan_out_warnings, _on_world(FAN_WARNINGS_SQL)),
}
