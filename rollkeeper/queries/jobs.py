"""Positions, jobs, employment."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollkeeper.operators import positions as ops
from rollkeeper.operators.changes import apply_changes, number_inserts
from rollkeeper.operators.lookup import text_of_position
from rollkeeper.queries import inputs, world
from rollkeeper.queries import target_sql as sqls
from rollkeeper.queries.changing import _on_world, _titled, today
from rollkeeper.queries.inputs import JOBS_SQL, ORDER_DAY, flat, sql
from rollkeeper.session import written


def current_position(spark, d):
    """The active job of a person and rank, with the key of its position."""
    held = ops.current_jobs(inputs.jobs(spark, d), inputs.positions(spark, d), F.lit(ORDER_DAY))
    return held.select("id", "title_rank", F.col("before.job_no").alias("job_no"), F.col("_held_key").alias("pcn_aggr"))


CURRENT_SQL = f"""
SELECT id, title_rank, min(job_no) AS job_no, arg_min(pcn_aggr, job_no) AS pcn_aggr
FROM job JOIN pos USING (tpos_no) WHERE end_date IS NULL OR end_date > DATE '{ORDER_DAY}' GROUP BY id, title_rank
"""


def position_title(spark, d):
    """The job title recorded for a position, blank for none."""
    return text_of_position(inputs.positions(spark, d), "tpos_no", inputs.jobs(spark, d), "tpos_no", "job_title", "title")


def job_end(spark, d):
    """Ends the active job of a person and rank that is for another position than
    the person's newest order of that rank."""
    jobs, positions = inputs.jobs(spark, d), inputs.positions(spark, d)
    wanted = jobs.join(positions.select("tpos_no", "pcn_aggr"), "tpos_no")
    newest = wanted.groupBy("id", "title_rank").agg(F.max_by("pcn_aggr", F.struct("beg_date", "job_no")).alias("pcn_aggr"))
    return flat(ops.ended_jobs(newest, jobs, positions, F.lit(ORDER_DAY)), "job_no", ["id", "title_rank", "tpos_no", "end_date"])


JOB_END_SQL = f"""
SELECT 'end_date' AS action, CAST(NULL AS VARCHAR) AS reason, job_no AS old_job_no, id, title_rank, tpos_no,
  DATE '{ORDER_DAY}' AS end_date
FROM (SELECT id, title_rank, arg_min(j, job_no) AS j, arg_min(pcn_aggr, job_no) AS held FROM
    (SELECT * FROM job JOIN pos USING (tpos_no)) j WHERE end_date IS NULL OR end_date > DATE '{ORDER_DAY}'
    GROUP BY id, title_rank)
  JOIN (SELECT id, title_rank, arg_max(pcn_aggr, (beg_date, job_no)) AS wanted FROM job JOIN pos USING (tpos_no)
    GROUP BY id, title_rank) USING (id, title_rank), LATERAL (SELECT j.job_no, j.tpos_no)
WHERE held <> wanted
"""


def _placed(spark, d):
    targets, rows = _titled(spark, d)
    keyed = written(ops.with_position_key(rows, targets["func_table"]), "keyed")
    changes = ops.position_changes(keyed, targets["pos_table"], today())
    placed = number_inserts(changes, targets["pos_table"], "tpos_no", ["pcn_aggr"])
    return targets, keyed, placed, apply_changes(targets["pos_table"], placed, ["tpos_no"])


POSITION_OUT = [
    "tpos_no", "pcn_aggr", "pcn_01", "pcn_02", "pcn_03", "pcn_04", "descr", "ofc", "func_area", "tenure_track", "fte",
    "hrpay", "active_date", "prev_pos",
]


def position_upsert(spark, d):
    return flat(_placed(spark, d)[2], "tpos_no", POSITION_OUT)


def job_upsert(spark, d):
    targets, keyed, _, positions = _placed(spark, d)
    numbered = written(ops.with_position_number(keyed, positions), "numbered")
    changes = ops.job_changes(numbered, targets["job_rec"], positions, targets["cvid_rec"], today())
    return flat(changes, "job_no", sqls.JOB_OUT)


def employment_upsert(spark, d):
    targets, keyed, _, positions = _placed(spark, d)
    changes = ops.employment_changes(ops.with_position_number(keyed, positions), targets["hremp_rec"])
    columns = ["id", "home_tpos_no", "ss_first", "ss_middle", "ss_last", "is_tenured", "is_tenure_track"]
    return flat(changes, "id", columns)


def second_job(spark, d):
    targets, _, _, positions = _placed(spark, d)
    changes = ops.second_job_changes(
        world.second_jobs(spark, d), targets["job_rec"], positions, targets["func_table"], today()
    )
    return flat(changes, "job_no", sqls.JOB_OUT)


def _two_ranks(spark, d):
    """Every second job twice, in two ranks."""
    rows = world.second_jobs(spark, d)
    other = F.when(F.col("title_rank") == 3, 4).otherwise(3).cast("int")
    return rows.unionByName(rows.withColumn("title_rank", other))


TWO_RANKS_CTE = """
two_ranks AS (SELECT * FROM second_in UNION ALL
  SELECT * REPLACE (CASE title_rank WHEN 3 THEN 4 ELSE 3 END AS title_rank) FROM second_in)
"""


def second_job_two_ranks(spark, d):
    """Two ranks of a person in one position are one job; the larger rank is a reject."""
    targets, _, _, positions = _placed(spark, d)
    changes = ops.second_job_changes(
        _two_ranks(spark, d), targets["job_rec"], positions, targets["func_table"], today()
    )
    return flat(changes, "job_no", sqls.JOB_OUT)


def second_job_warnings(spark, d):
    return ops.second_job_warnings(world.second_jobs(spark, d), world.targets(spark, d), ["id"])


SECOND_WARNINGS_SQL = """
SELECT id, 'unknown_pay_code' AS warning, pay AS value FROM second_parts
  WHERE whole AND pay NOT IN (SELECT hrpay FROM hrpay_table)
UNION ALL SELECT id, 'unknown_function_code', dept FROM second_parts
  WHERE whole AND dept NOT IN (SELECT func FROM func_table)
UNION ALL SELECT id, 'unknown_division', unit FROM second_parts
  WHERE whole AND unit NOT IN (SELECT hrdiv FROM hrdiv_table)
UNION ALL SELECT id, 'unknown_department', dept FROM second_parts
  WHERE whole AND dept NOT IN (SELECT hrdept FROM hrdept_table)
"""


def second_job_slots(spark, d):
    """The first filled of three slots of a person."""
    return ops.second_job_slots(_slots(spark, d))


def _slots(spark, d):
    rows = world.second_jobs(spark, d)
    columns = ["id", "worker_cat_code", "job_title_descr", "job_function_code"]
    out = rows.select(*columns, "pcn_aggr", "position_start", "position_end")
    for n in (2, 3, 4):
        out = out.withColumn(f"home_cost_number{n}", F.when(F.col("id") % n == 0, F.col("pcn_aggr")).otherwise(""))
        out = out.withColumn(f"position_eff_date{n}", F.date_add("position_start", n))
        out = out.withColumn(f"position_end_date{n}", F.col("position_end"))
    return out.drop("pcn_aggr", "position_start", "position_end")


SLOTS_CTE = """
slots AS (
  SELECT id, worker_cat_code, job_title_descr, job_function_code, pcn_aggr,
    CASE WHEN id % 2 = 0 THEN 3 WHEN id % 3 = 0 THEN 4 END AS title_rank,
    CAST(position_start + CASE WHEN id % 2 = 0 THEN 2 ELSE 3 END AS DATE) AS position_start, position_end
  FROM second_in WHERE id % 2 = 0 OR id % 3 = 0)
"""


QUERIES = {
    "current_position": (current_position, sql(JOBS_SQL, CURRENT_SQL)),
    "position_title": (
        position_title,
        sql(
            JOBS_SQL,
            "SELECT pcn_aggr, tpos_no, descr, coalesce((SELECT min(job_title) FROM job WHERE job.tpos_no = pos.tpos_no), "
            "'') AS title FROM pos",
        ),
    ),
    "job_end": (job_end, sql(JOBS_SQL, JOB_END_SQL)),
    "position_upsert": (position_upsert, _on_world(sqls.position(), sqls.PLACED_SQL)),
    "job_upsert": (job_upsert, _on_world(sqls.job(), sqls.PLACED_SQL + "," + sqls.JOBS_CTES)),
    "employment_upsert": (employment_upsert, _on_world(sqls.employment(), sqls.PLACED_SQL)),
    "second_job_two_ranks": (
        second_job_two_ranks,
        _on_world(sqls.second_job(), ",".join([sqls.PLACED_SQL, TWO_RANKS_CTE, sqls.second_ctes("two_ranks")])),
    ),
    "second_job_warnings": (second_job_warnings, _on_world(SECOND_WARNINGS_SQL, sqls.PLACED_SQL + "," + sqls.SECOND_CTES)),
    "second_job_slots": (second_job_slots, _on_world("SELECT * FROM slots", SLOTS_CTE)),
    "second_job": (second_job, _on_world(sqls.second_job(), sqls.PLACED_SQL + "," + sqls.SECOND_CTES)),
}
